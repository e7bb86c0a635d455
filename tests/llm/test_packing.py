"""Sum-of-squares packing against its definition, the tokenizers library and the bound."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from itemscope.llm import packing
from itemscope.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def plain_sum_of_squares(lengths, size):
    """Every choice tried, the sum of squares counted anew."""
    gaps, out = [], []
    for i, s in enumerate(lengths):
        best = None
        for at in range(len(gaps) + 1):
            if at < len(gaps) and gaps[at] < s:
                continue
            trial = gaps[:] + ([size] if at == len(gaps) else [])
            gap, trial[at] = trial[at], trial[at] - s
            count = np.bincount([g for g in trial if g], minlength=size + 1)
            rank = (int((count.astype(int) ** 2).sum()), gap)
            if best is None or rank < best[0]:
                best = rank, at, trial
        gaps = best[2]
        out.append(best[0][0])
    return out, len(gaps)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 11), max_size=25))
def test_places_by_the_smallest_sum_of_squares(lengths):
    size = 12
    found = packing.sum_of_squares(np.array(lengths, dtype=np.int64), size)
    assert sorted(i for s in found for i in s) == list(range(len(lengths)))
    where = {i: n for n, s in enumerate(found) for i in s}
    gaps, sums = {}, []
    for i, s in enumerate(lengths):
        gaps[where[i]] = gaps.get(where[i], size) - s
        assert gaps[where[i]] >= 0
        count = np.bincount([g for g in gaps.values() if g], minlength=size + 1)
        sums.append(int((count.astype(int) ** 2).sum()))
    assert (sums, len(found)) == plain_sum_of_squares(lengths, size)


def test_rounds_come_close_to_the_bound():
    rng = np.random.default_rng(3)
    lengths = np.minimum(2047, rng.lognormal(6, 1, 5000).astype(np.int64) + 1)
    sequence, offset, settled = packing.pack_cell(lengths, 2048)
    assert len(set(sequence.tolist())) <= -(-int(lengths.sum()) // 2048) + 5
    for s in set(sequence.tolist()):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert (offset[own] == np.r_[0, np.cumsum(lengths[own])[:-1]]).all() and lengths[own].sum() <= 2048
        assert (settled[own] == (lengths[own].sum() == 2048)).all()


def held(rows, size):
    """Sequences hold no gaps, no overlaps and no more than their size."""
    for _, g in rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.r_[0, np.cumsum(g.length)[:-1]]).all() and g.length.sum() <= size


def test_query_against_the_library(spark, library):
    rows = QUERIES["op11_packing"](spark, SF).toPandas()
    held(rows, 2048)
    assert rows.sequence_id.nunique() <= 1.02 * rows.length.sum() / 2048 + 1
    by = {k: g.sort_values("piece") for k, g in rows.groupby("doc_id")}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = np.array(library.encode(d.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in by[d.doc_id].itertuples()] == [
            (n, lo, len(ids[lo:lo + 2048]), zlib.crc32(ids[lo:lo + 2048].tobytes())) for n, lo in enumerate(range(0, len(ids), 2048))]


def test_cells_and_levels_lose_nothing(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "1 + id * 7919 % 900 AS length", "0L AS ids_crc32", "id AS place")
    rows = packing.pack(rows, 1000, cell=1000).toPandas()
    assert sorted(rows.doc_id) == list(range(3000))
    held(rows, 1000)
    assert rows.sequence_id.nunique() <= 1.02 * rows.length.sum() / 1000 + 1


TEXTS = [None, "", " \n\t", "It's 12½ ²³ a_b --- ÀÉÎ ŠĐ İstanbul ﬁne", "日本語 текст 😀 x", "<|endoftext|> a <|startoftext|>b", "a\x85b\xa0c\xadd é",
         "x" * 3000, "word " * 4000, "\x1c\x1d mixed\x0bspace"]


def test_odd_texts(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_CHARS", 500)
    docs = spark.createDataFrame([(i % 7, t, 1, 2) for i, t in enumerate(TEXTS)], "doc_id int, text string, place int, length int")
    rows = packing.packed(docs, PATH, size=64).toPandas()
    held(rows, 64)
    expected = []
    for i, t in enumerate(TEXTS):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        expected += [(i % 7, n, lo, len(ids[lo:lo + 64]), zlib.crc32(ids[lo:lo + 64].tobytes())) for n, lo in enumerate(range(0, len(ids), 64))]
    assert sorted(rows[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(expected)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.packed(docs, PATH).count() == 0


def test_next_task_of_a_worker_learns_no_piece_again(library, monkeypatch):
    learned = []
    plain = packing.Coder._learn
    monkeypatch.setattr(packing.Coder, "_learn", lambda self, pieces: learned.extend(pieces) or plain(self, pieces))
    with open(PATH, encoding="utf-8") as f:
        content = f.read()
    packing._LOADED.clear()
    texts = ["Some words, it's some 'words' again 12", "naïve ½ words"]
    for _ in range(2):
        got = packing._coder(content).encode(texts)
        assert [np.frombuffer(g, "<i4").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(learned) == len(set(learned)) > 5
