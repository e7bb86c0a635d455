"""Structure repair against an exhaustive search, in chunks of all sizes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from itemscope.llm import repair
from itemscope.llm.queries import QUERIES

BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")


def damage(rows):
    out = []
    for c, n, r, t in rows:
        word = lambda v: " " if v is None else str(v)
        k = zlib.crc32(f"{word(c)}:{word(n)}".encode()) % 20
        r, t = word(r), word(t)
        r, t = "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", t) if k == 2 else t
        out += [(c, n, r, t)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, r, t in rows:
        last = t.rstrip(" \t\n\x0b\f\r")[-1:]
        out.append("blank" if BLANK.match(t) else "duplicate" if (r, t) in seen else "truncated" if last not in (".", "!", "?") else "")
        seen.add((r, t))
    return out


def cheapest(rows, bad):
    """(cost, audit, repaired) by full search over positions and what was said last."""
    @lru_cache(None)
    def best(at, last, since):
        """since: rows inserted since the last row taken up."""
        ways = []
        if at == len(rows):
            if last in ("", "a"):
                ways.append((0, "", ()))
        else:
            _, _, r, t = rows[at]
            c, a, x = best(at + 1, last, 0)
            ways.append((c + 4, "D" + a, x))
            if bad[at] not in ("blank", "duplicate"):
                for role, edit, cost in ((r, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if role and last + role[0] in ("s", "u", "su", "au", "ua"):
                        c, a, x = best(at + 1, role[:1], 0)
                        ways.append((c + cost + 3 * (bad[at] == "truncated"), edit + a, (f"{role}:{t}",) + x))
        if since < 2:
            for role in ("user", "assistant"):
                if last + role[0] in ("u", "su", "au", "ua"):
                    c, a, x = best(at, role[0], since + 1)
                    ways.append((c + 3, "I" + a, (f"{role}:",) + x))
        return min(ways) if ways else (10 ** 9, "", ())

    return best(0, "", 0)


def brute(rows):
    by = defaultdict(list)
    for c in {r[0] for r in rows}:
        by[c] = []
    for r in damage(rows):
        by[r[0]].append(r)
    out = {}
    for c, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        bad = faults(own)
        numbers = [r[1] for r in own if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, kept = cheapest(tuple(own), tuple(bad))
        out[c] = (gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit,
                  hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(spark, folder, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS kind", "2 AS copy", "'x' AS k1", "0 AS cid")
    df.write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    out = QUERIES["op13_repair"](spark, str(folder)).select(*NAMES).collect()
    assert len({r[0] for r in out}) == len(out)
    return {r[0]: tuple(r)[1:] for r in out}


def conversations(seed, lengths):
    rnd = random.Random(seed)
    rows = []
    for c, n in enumerate(lengths):
        turn = 0
        for i in range(n):
            turn += rnd.choice([1, 1, 1, 1, 2, 0])
            role = rnd.choice(["system", "tool", "", "x", None]) if rnd.random() < .1 else ("user", "assistant")[i % 2]
            text = rnd.choice([None, "", " \n", "Yes.", "No", "Ünfinished"]) if rnd.random() < .3 else f"Row {c} {i} é" + rnd.choice([".", "!", "? \n", ""])
            rows.append((c, None if rnd.random() < .05 else turn, role, text))
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_query_against_search(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(repair, "STRETCH", 4)
    rows = conversations(chunk, [1, 2, 3, 5, 8, 13, 40, 90, 150])
    rows += [(100, i, "user", "Same.") for i in range(120)] + [(100, 120, "assistant", "End.")]  # rows that must go never make vectors converge
    rows += [(None, None, None, None), (None, 3, "user", "Hello."), (101, None, "user", "a."), (102, 5, "system", "b.")]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_every_conversation_is_reported(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, tmp_path, [(gone, 0, "user", "Hello.")]) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert found(spark, tmp_path, []) == {}


def test_long_texts_cut_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_BYTES", 1000)
    rows = [(1, i, ("user", "assistant")[i % 2], f"{i} " + "x" * 700 + ".") for i in range(30)]
    assert found(spark, tmp_path, rows) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.integers(0, 2)), max_size=30), st.integers(0, 30))
def test_runs_meet(rows, cut):
    """A rerun ends with the vector of a whole run, whatever the first guess was."""
    steps = repair.Steps()
    symbols = bytes(repair.symbol(*r) for r in rows)
    left, right = symbols[:cut], symbols[cut:]
    true = steps.run(right, repair.END)
    assert steps.rerun(left, repair.GUESS, true, steps.run(left, repair.GUESS)) == steps.run(symbols, repair.END)
