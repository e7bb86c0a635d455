"""Benchmark decontamination by winnowing.

An item's windows are its runs of ``window`` consecutive words (the whole item
if it has fewer). Documents are reduced to winnowed fingerprints: of every
``window - gram + 1`` consecutive grams of ``gram`` words the one with the
smallest hash is kept, so any shared run of ``window`` words shares at least one
kept gram. Fingerprints of documents and of items meet in a join; every
hit is extended to the windows around it, and a window counts only if it equals
an item's window in all its words (two independent 64-bit hashes).

Items shorter than a window escape winnowing; there the gram is the whole item,
for each of the few lengths below ``window`` that occur.

Plan: texts are read twice, first narrow (fingerprints out, hits back: one
position list per text that has hits), then only the texts with hits. Texts
stand for themselves by two hashes, so copies are worked on once and rows
without or with repeated doc_ids are safe. Spark picks the join by the
size it measures: a small benchmark is broadcast, a large one shuffles.

Defined results: null and empty texts have no words and no hits; an item
without words has no window; items with equal texts all count; repeated rows
get equal results; empty tables on either side work; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemscope.llm.common import saved, text_key, word_windows

WINDOW, GRAM = 10, 5
#: A word: letters a-z, digits and everything outside ASCII; all else separates.
_SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _words(text: str | None, overlap: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place of the first word, 64-bit hashes of the words) for consecutive parts of a text."""
    data = (text or "").encode().lower().translate(_SEPARATORS)
    at = 0
    for words in word_windows(data, overlap):
        yield at, np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
        at += max(0, len(words) - overlap)


def _grams(h: np.ndarray, n: int, mix: np.uint64 = _MIX) -> np.ndarray:
    """A hash of every run of ``n`` words, sensitive to their order."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    count = len(h) - n + 1
    out = np.full(count, np.uint64(n), dtype=np.uint64)
    for i in range(n):
        out = (out ^ h[i:i + count]) * mix
        out ^= out >> np.uint64(29)
    return out


def _kept(grams: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest gram (the last of equals) of every ``span`` consecutive ones."""
    count = len(grams) - span + 1
    if count < 1:
        return np.zeros(0, dtype=np.int64)
    best, place = grams[:count].copy(), np.zeros(count, dtype=np.int64)
    for i in range(1, span):
        better = grams[i:i + count] <= best
        place[better] = i
        np.minimum(best, grams[i:i + count], out=best)
    place += np.arange(count)
    return np.unique(place)


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _longs(a: np.ndarray) -> pa.Array:
    return pa.array(a.astype(np.uint64, copy=False).view(np.int64), pa.int64())


def fingerprints(texts: DataFrame, text: str, window: int, gram: int, short: list[int]) -> DataFrame:
    """(k1, k2, n, hash, at): winnowed grams of every text (n = gram) and all its
    runs of the lengths in ``short`` (n = length)."""
    narrow = texts.select(*text_key(text), F.col(text))

    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            rows, ns, hashes, places = [], [], [], []

            def add(row, n, found, at):
                rows.append(np.full(len(found), row))
                ns.append(np.full(len(found), n, dtype=np.int32))
                hashes.append(found)
                places.append(at.astype(np.int64))

            for row, t in enumerate(batch.column(2)):
                for at, h in _words(t.as_py(), window - 1):
                    g = _grams(h, gram)
                    kept = _kept(g, window - gram + 1)
                    add(row, gram, g[kept], at + kept)
                    for n in short:
                        g = _grams(h, n)
                        add(row, -n, g, at + np.arange(len(g)))
            if rows:
                r = np.concatenate(rows)
                yield _batch({"k1": pa.array(k1[r]), "k2": pa.array(k2[r]), "n": pa.array(np.concatenate(ns), pa.int32()),
                              "hash": _longs(np.concatenate(hashes)), "at": pa.array(np.concatenate(places))})

    return narrow.mapInArrow(run, "k1 bigint, k2 bigint, n int, hash bigint, at bigint")


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, n, w1, w2): every window of every item, n its number of words."""
    narrow = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("t"))

    def run(batches):
        for batch in batches:
            rows, ns, w1, w2 = [], [], [], []
            for row, t in enumerate(batch.column(1)):
                for at, h in _words(t.as_py(), window - 1):
                    n = window if len(h) >= window else 0 if at else len(h)
                    if n:
                        a, b = _grams(h, n), _grams(h, n, _MIX2)
                        rows.append(np.full(len(a), row))
                        ns.append(np.full(len(a), n, dtype=np.int32))
                        w1.append(a)
                        w2.append(b)
            if rows:
                yield _batch({"item_id": batch.column(0).take(pa.array(np.concatenate(rows))), "n": pa.array(np.concatenate(ns)),
                              "w1": _longs(np.concatenate(w1)), "w2": _longs(np.concatenate(w2))})

    schema = f"item_id {items.select(item_id).dtypes[0][1]}, n int, w1 bigint, w2 bigint"
    return narrow.mapInArrow(run, schema).distinct()


def item_grams(items: DataFrame, text: str, window: int, gram: int) -> DataFrame:
    """(n, hash): the distinct grams of all windows: of ``gram`` words, or (n < 0) a whole short item."""

    def run(batches):
        for batch in batches:
            ns, hashes = [], []
            for t in batch.column(0):
                for at, h in _words(t.as_py(), window - 1):
                    short = not at and 0 < len(h) < window
                    g = _grams(h, len(h)) if short else _grams(h, gram)
                    ns.append(np.full(len(g), -len(h) if short else gram, dtype=np.int32))
                    hashes.append(g)
            if ns:
                yield _batch({"n": pa.array(np.concatenate(ns), pa.int32()), "hash": _longs(np.concatenate(hashes))})

    return items.select(F.col(text)).mapInArrow(run, "n int, hash bigint").distinct()


def _extended(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(k1, k2, start, n, w1, w2): the windows around the hits of (k1, k2, t, hits) rows."""

    def run(batches):
        for batch in batches:
            for k1, k2, t, hits in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ns = np.array([h["n"] for h in hits], dtype=np.int64)
                at = np.array([h["at"] for h in hits], dtype=np.int64)
                near = at[ns > 0][:, None] - np.arange(window - gram + 1)[None, :]
                starts = {window: np.unique(near[near >= 0])}
                starts.update({int(-n): np.unique(at[ns == n]) for n in np.unique(ns[ns < 0])})
                for first, h in _words(t, window - 1):
                    for n, at_n in starts.items():
                        # a part owns the starts it holds whole; those of the overlap come again, as equal rows
                        own = at_n[(at_n >= first) & (at_n + n <= first + len(h))] - first
                        if len(own):
                            a, b = _grams(h, n)[own], _grams(h, n, _MIX2)[own]
                            yield _batch({"k1": pa.array(np.full(len(own), k1)), "k2": pa.array(np.full(len(own), k2)),
                                          "start": pa.array(own + first), "n": pa.array(np.full(len(own), n), pa.int32()),
                                          "w1": _longs(a), "w2": _longs(b)})

    return texts.mapInArrow(run, "k1 bigint, k2 bigint, start bigint, n int, w1 bigint, w2 bigint")


def occurrences(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Where the items' windows occur: (k1, k2, start, n, w1, w2) and the items' windows.

    ``k1, k2`` are the ``text_key`` of the text; ``start`` is a word's place."""
    items = items.select(item_id, item_text)
    windows = saved(item_windows(items, item_id, item_text, window), "item-windows")
    short = [r[0] for r in windows.filter(F.col("n") < window).select("n").distinct().orderBy("n").collect()]  # at most window - 1 lengths
    grams = saved(item_grams(items, item_text, window, gram), "item-grams")
    # rows of a text lie together, so its hits are gathered before they shuffle
    hits = fingerprints(docs, text, window, gram, short).join(grams, ["n", "hash"], "left_semi") \
        .groupBy("k1", "k2").agg(F.collect_set(F.struct("n", "at")).alias("hits"))
    hits = saved(hits, "hits")
    keyed = docs.select(*text_key(text), F.col(text).alias("t"))
    found = keyed.join(hits, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("k1", "k2", "t", "hits")
    around = _extended(found, window, gram)
    return around.join(windows.select("n", "w1", "w2").distinct(), ["n", "w1", "w2"], "left_semi").distinct(), windows


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(k1, k2, n_hit, items): for every text with hits, its hit words and the
    ids (sorted as strings) of the items with a window in it."""
    at, windows = occurrences(docs, items, text, item_id, item_text, window, gram)
    at = saved(at, "occurrences")
    # the longest run that starts at a word; a word is counted once, by the part of its run before the next start
    runs = at.groupBy("k1", "k2", "start").agg(F.max(F.col("start") + F.col("n")).alias("stop"))
    spans = F.array_sort(F.collect_list(F.struct("start", "stop")))
    zero = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).cast("bigint").alias("until"))
    added = F.aggregate(spans, zero, lambda a, s: F.struct(
        (a["sum"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["until"]))).cast("bigint").alias("sum"),
        F.greatest(a["until"], s["stop"]).cast("bigint").alias("until")), lambda a: a["sum"])
    words = runs.groupBy("k1", "k2").agg(added.alias("n_hit"))
    named = at.select("k1", "k2", "n", "w1", "w2").distinct().join(windows, ["n", "w1", "w2"]) \
        .groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("items"))
    return words.join(named, ["k1", "k2"])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item's window."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    body = f"c{names.index(text)}"
    bad = saved(occurrences(inner, items, body, **options)[0].select("k1", "k2").distinct(), "contaminated")
    keyed = inner.select("*", *text_key(body, "_"))
    clean = keyed.join(bad, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")), "left_anti")
    return clean.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
