"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is read through a window of ``WINDOW`` words that slides by one word, so no phrase
of up to that many words is split. A window's bag holds the character
n-grams of its words (with word borders), each n-gram has an embedding, and the mean
of a bag's embeddings goes through a linear softmax of two classes; embeddings and
softmax are trained jointly in numpy. Misspellings never seen in training share
most n-grams with their word, and so its vectors. A text scores as its most toxic
window, so a few words in a long text are not diluted by the rest. n-grams are read once a word;
windows add up the sums of their words.

Training sees document labels only. Every window of a document labelled 0 is a
negative example; of a document labelled 1 first all windows weigh alike, then
the window that scores highest stands for it.

Plan: the classifier is fitted on the driver from a bounded sample of
labelled rows (``POSITIVES`` and ``NEGATIVES`` at most, chosen by a hash of the key; of their distinct
texts those of at most ``TEXT_BYTES`` bytes, in the order of a hash until ``SAMPLE_BYTES`` bytes are reached), whose
texts are fetched by a broadcast of the chosen keys. With two classes a window's
score is a mean of one number per n-gram: that table (``BUCKETS`` floats) is broadcast, and
one pass without shuffle scores every whole text.

Defined results: null and empty texts score like an empty bag (the learned prior); without
labels or with one class every text scores that class's smoothed share; repeated
rows score equally; extra columns pass through or are ignored, never used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemscope.llm.common import saved

#: Bounds of the training sample (rows).
POSITIVES, NEGATIVES = 1500, 2500
#: Bounds of the training sample (UTF-8 bytes of one text and of all); scoring reads every text whole.
TEXT_BYTES, SAMPLE_BYTES = 1 << 18, 1 << 25
WINDOW = 4
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
DIM = 8
#: Characters worked on at once.
PART_CHARS = 1 << 20


def _classes() -> np.ndarray:
    """By code point below U+0250: 1 for letters and digits, else 0; above, all characters count as letters."""
    return np.array([chr(c).isalnum() for c in range(0x250)], dtype=bool)


_ALNUM = _classes()


@dataclass
class Bags:
    """n-gram buckets of consecutive words: ``starts`` into ``ids``, ``owner`` (the text) of every word."""
    ids: np.ndarray
    starts: np.ndarray
    owner: np.ndarray


@dataclass
class Windows:
    """All windows of some words: the word each begins with, the word after its end, its text, its number of n-grams."""
    first: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    grams: np.ndarray
    width: int

    def sums(self, x: np.ndarray) -> np.ndarray:
        """The sum of a number per word over every window."""
        out = np.zeros(len(self.first), dtype=np.float64)
        for k in range(self.width):
            inside = self.first + k < self.end
            out[inside] += x[self.first[inside] + k]
        return out

    def spread(self, x: np.ndarray, words: int) -> np.ndarray:
        """The sum of a number per window over every word: the windows it is in."""
        out = np.zeros(words, dtype=np.float64)
        for k in range(self.width):
            inside = self.first + k < self.end
            out += np.bincount(self.first[inside] + k, x[inside], minlength=words)
        return out


def windows(b: Bags, width: int = WINDOW) -> Windows:
    """A window from every word that has ``width`` words of its text ahead; a text of fewer words is one window."""
    n = len(b.starts)
    place = np.arange(n)
    begins = np.flatnonzero(np.r_[True, b.owner[1:] != b.owner[:-1]]) if n else place
    sizes = np.diff(np.r_[begins, n])
    text_end = np.repeat(begins + sizes, sizes)
    first = np.flatnonzero((place + width <= text_end) | (place == np.repeat(begins, sizes)))
    w = Windows(first, np.minimum(first + width, text_end[first]), b.owner[first], np.zeros(0), width)
    w.grams = w.sums(np.diff(np.r_[b.starts, len(b.ids)]))
    return w


def groups(texts: list[str | None]) -> Iterator[list[int]]:
    """Places of consecutive texts of some PART_CHARS characters."""
    group: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        group.append(i)
        size += len(t or "")
        if size >= PART_CHARS or i + 1 == len(texts):
            yield group
            group, size = [], 0


def bags(texts: list[str | None]) -> Bags:
    """The words' bags of all texts; a text without words has none."""
    ids, starts, owner, base = [], [], [], 0
    for group in groups(texts):
        a, s, o = _bags([texts[j] or "" for j in group])
        ids.append(a)
        starts.append(s + base)
        owner.append(o + group[0])
        base += len(a)
    join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, dtype=kind)
    return Bags(join(ids, np.int32), join(starts, np.int64), join(owner, np.int64))


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    none = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    lowered = [f" {t.lower()} " for t in texts]
    chars = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(chars):
        return none
    text_of = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = np.ones(len(chars), dtype=bool)
    low = chars < 0x250
    letter[low] = _ALNUM[chars[low]]
    # runs of separators become one border
    stay = letter | np.r_[True, letter[:-1]]
    chars, letter, text_of = np.where(letter, chars, 32)[stay], letter[stay], text_of[stay]
    border = ~letter
    word = np.cumsum(letter & np.r_[True, border[:-1]]) - 1          # number of the word a letter is in
    if word[-1] < 0:
        return none
    first = np.flatnonzero(letter & np.r_[True, border[:-1]])        # where words begin
    word_text = text_of[first]
    inside = np.cumsum(border)
    ids, of = [], []
    for n in GRAMS:
        count = len(chars) - n + 1
        if count < 1:
            continue
        h = np.full(count, n, dtype=np.uint32)
        for i in range(n):
            h = (h ^ chars[i:i + count]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        # borders only at the ends: none at places 1 .. n - 2
        whole = inside[n - 2:n - 2 + count] == inside[:count]
        at = np.flatnonzero(whole)
        ids.append((h[at] * np.uint32(0x85EBCA6B) >> np.uint32(32 - 17)).astype(np.int32) % BUCKETS)
        of.append(word[at + 1])                                      # the second letter is always in the word
    if not ids:
        return none
    ids, of = np.concatenate(ids), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    ids, of = ids[order], of[order]
    cut = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    return ids, cut.astype(np.int64), word_text[of[cut]]


@dataclass
class Model:
    """One number per n-gram bucket (its embedding through the softmax's difference) and the offset."""
    weights: np.ndarray
    offset: float

    def margins(self, b: Bags, w: Windows) -> np.ndarray:
        if not len(b.starts):
            return np.zeros(0)
        return w.sums(np.add.reduceat(self.weights[b.ids], b.starts)) / w.grams + self.offset

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The probability of the most toxic window of every text."""
        best = np.full(len(texts), -np.inf)
        for group in groups(texts):
            b = bags([texts[j] for j in group])
            w = windows(b)
            np.maximum.at(best, w.owner + group[0], self.margins(b, w))
        return _sigmoid(np.where(np.isfinite(best), best, self.offset))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(texts: list[str | None], labels: list[int], epochs: int = 15, warm: int = 3, batch: int = 256, rate: float = 0.05,
        seed: int = 7) -> Model:
    """Embeddings (BUCKETS x DIM) and softmax (DIM x 2), trained jointly with Adam."""
    y = np.asarray(labels, dtype=np.float64)
    prior = (y.sum() + 0.5) / (len(y) + 1)
    offset = float(np.log(prior / (1 - prior)))
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, dtype=np.float32), offset)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 1 / np.sqrt(DIM), (DIM, 2)).astype(np.float32)
    bias = np.array([0.0, offset], dtype=np.float32)
    params = [emb, soft, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    step = 0
    order = rng.permutation(len(y))
    parts = [order[i:i + batch] for i in range(0, len(order), batch)]
    read = [(b, windows(b)) for b in (bags([texts[i] for i in part]) for part in parts)]
    for epoch in range(epochs):
        for k in rng.permutation(len(parts)):
            part, (b, w) = parts[k], read[k]
            if not len(b.starts):
                continue
            # softmax of (mean embedding) @ soft + bias: the class difference is a mean of one number per n-gram
            turn = soft[:, 1] - soft[:, 0]
            margin = w.sums(np.add.reduceat((emb @ turn)[b.ids], b.starts)) / w.grams + bias[1] - bias[0]
            target = y[part][w.owner]
            count = np.bincount(w.owner, minlength=len(part))[w.owner]
            top = np.full(len(part), -np.inf)
            np.maximum.at(top, w.owner, margin)
            is_top = margin >= top[w.owner]
            share = np.where(target == 0, 0.5 / count + 0.5 * is_top, is_top if epoch >= warm else 1 / count)
            residual = (_sigmoid(margin) - target) * share * weight[part][w.owner] / len(part)
            per_word = w.spread(residual / w.grams, len(b.starts))
            per_gram = np.bincount(b.ids, np.repeat(per_word, np.diff(np.r_[b.starts, len(b.ids)])), minlength=BUCKETS).astype(np.float32)
            d_turn = emb.T @ per_gram
            d_bias = residual.sum()
            grads = [per_gram[:, None] * turn[None, :], np.stack([-d_turn, d_turn], axis=1), np.array([-d_bias, d_bias], dtype=np.float32)]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-5)
    return Model((emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def is_held_out(key: str | Column) -> Column:
    """crc32 of the key as text, modulo 4, is 2; a null key is not held out."""
    k = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(k.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                    positives: int = POSITIVES, negatives: int = NEGATIVES, text_bytes: int = TEXT_BYTES,
                    sample_bytes: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """At most ``positives`` + ``negatives`` distinct labelled texts that are not held out, of at most
    ``text_bytes`` bytes each and ``sample_bytes`` in all: only those come to the driver."""
    known = labels.filter(~is_held_out(key) & F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_y"))
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = known.filter("_y = 1").distinct().orderBy(*order).limit(positives).unionAll(
        known.filter("_y = 0").distinct().orderBy(*order).limit(negatives))
    rows = docs.join(F.broadcast(chosen), F.col(key) == F.col("_id")).select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"), "_y")
    place = [F.xxhash64("_y", "_t").alias("_p"), F.xxhash64(F.lit(1), "_t", "_y").alias("_q")]
    texts = saved(rows.filter(F.octet_length("_t") <= text_bytes).distinct().select(*place, "_t", "_y"), "toxicity-sample")
    # numbers only, of a bounded number of rows: how far the bytes reach
    sizes = texts.select("_p", "_q", F.octet_length("_t").alias("_n")).orderBy("_p", "_q").limit(positives + negatives)
    sofar = F.sum("_n").over(Window.orderBy("_p", "_q").rowsBetween(Window.unboundedPreceding, 0))
    within = sizes.withColumn("_sum", sofar).filter(F.col("_sum") <= sample_bytes).select("_p", "_q")
    return [(r[0], r[1]) for r in texts.join(F.broadcast(within), ["_p", "_q"]).orderBy("_p", "_q").select("_t", "_y").collect()]


def train(docs: DataFrame, labels: DataFrame, **options) -> Model:
    sample = training_sample(docs, labels, **options)
    return fit([t for t, _ in sample], [y for _, y in sample])


def with_score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all by default) and the score of every whole text."""
    kept = docs.columns if carry is None else carry
    narrow = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(kept)], docs[text].cast("string").alias("t"))
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)] + [T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = shared.value.scores(batch.column(len(kept)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return narrow.mapInArrow(run, schema).toDF(*kept, out)
