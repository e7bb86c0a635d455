"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's fingerprint takes a bit where more than half of its shingle
hashes have it. Two fingerprints link at ``radius`` (an odd number, 3) or fewer
differing bits. Each fingerprint emits all variants within half the radius,
fingerprints shuffle on the variants, and colliding pairs are verified.

An odd radius has no exact half. The 64 bits are cut into ``BLOCKS`` blocks and
one block at a time is left out: a pair that differs at all differs in some
block, and without it at most ``radius - 1`` bits differ, so the two balls of
half that radius around the shortened fingerprints meet. With 4 blocks and
radius 3 that is 4 x 49 variants of 48 bits (a full ball of two bits would be
2081 of 64), and chance collisions stay below one a fingerprint up to some 10^10
distinct fingerprints.

Plan: texts are read once (a fingerprint per row, written to the shared
folder); only distinct fingerprints emit variants, so copies meet as one. A
variant's fingerprints are read as a sorted stream; within a bucket a spanning
forest of the verified links is kept (never all pairs), then links are made
distinct and joined into components by distributed union-find.

Defined results: a text without words (null, empty) has fingerprint zero and is
linked like any other; a text with fewer words than a shingle is one
shingle; repeated rows share fingerprint and component; a null doc_id is never
a component's smallest unless all are null; an empty table gives no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemscope.llm.common import saved, word_windows
from itemscope.llm.graph import components

BLOCKS = 4
SEED = 42
#: Pairs compared at once inside a bucket; buckets up to SMALL members are compared pair by pair.
COMPARED = 1 << 20
SMALL = 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    counts, n = np.zeros(64, dtype=np.int64), 0
    hashed = partial(xxhash.xxh64_intdigest, seed=SEED)
    for words in word_windows((text or "").encode().lower(), shingle - 1):
        whole = [b" ".join(words)] if words and not n and len(words) < shingle else []
        grams = whole or map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
        h = np.fromiter(map(hashed, grams), dtype="<u8")
        for lo in range(0, len(h), 1 << 16):
            part = h[lo:lo + (1 << 16)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", carry: list[str] | None = None,
                     shingle: int = 3) -> DataFrame:
    """The columns ``carry`` (all by default) and the fingerprint as a signed bigint."""
    kept = docs.columns if carry is None else carry
    narrow = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(kept)], docs[text].cast("string").alias("t"))
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)] + [T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(len(kept))], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps, pa.int64())], names=[*batch.schema.names[:-1], "fp"])

    return narrow.mapInArrow(run, schema).toDF(*kept, out)


def variants(fp: Column, radius: int = 3) -> Column:
    """The keys a fingerprint emits: for every block left out, the rest turned
    down to the low bits, every ball member, and the block's number on top."""
    width = 64 // BLOCKS
    if radius != 3:
        raise ValueError("the balls are laid out for a radius of 3 bits")
    flips = F.array(*[F.lit(0).cast("bigint"), *[F.lit(1 << i).cast("bigint") for i in range(64 - width)]])

    def ball(rest: Column) -> Column:
        return F.transform(flips, lambda flip: rest.bitwiseXOR(flip))

    balls = []
    for block in range(BLOCKS):
        turn = width * (block + 1) % 64
        turned = F.shiftrightunsigned(fp, turn).bitwiseOR(F.shiftleft(fp, 64 - turn)) if turn else fp
        rest = turned.bitwiseAND(F.lit((1 << (64 - width)) - 1)).bitwiseOR(F.lit(block << (64 - width)))
        balls.append(ball(rest))
    return F.flatten(F.array(*balls))


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what the verified pairs among ``fps`` connect."""
    links = []
    left = fps
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            step = max(1, COMPARED // len(left))
            near, rest = front[:step], front[step:]
            close = np.bitwise_count(near[:, None] ^ left[None, :]) <= radius
            hit = close.any(axis=0)
            links += zip(near[close.argmax(axis=0)[hit]].view("<i8").tolist(), left[hit].view("<i8").tolist())
            front, left = np.concatenate([rest, left[hit]]), left[~hit]
    return links


def _met_here(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (key, fp) rows: the fingerprint without its block, and the variant it meets in."""
    width = np.uint64(64 // BLOCKS)
    low = np.uint64((1 << (64 - 64 // BLOCKS)) - 1)
    k = keys.view("<u8")
    turn = width * ((k >> (np.uint64(64) - width)) + np.uint64(1)) % np.uint64(64)
    turned = np.where(turn == 0, fps, (fps >> turn) | (fps << ((np.uint64(64) - turn) % np.uint64(64))))
    return turned & low, k & low


def _bucket_pairs(keys: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """Verified links (n x 2) inside whole buckets of sorted (key, fp) rows.

    Fingerprints equal without the block meet in all variants of theirs; they
    are compared only in the variant that is their own. Pairs of small buckets are
    verified together, larger buckets give a forest."""
    if len(keys) < 2:
        return np.zeros((0, 2), dtype=np.int64)
    same = keys[1:] == keys[:-1]
    many = np.r_[False, same] | np.r_[same, False]
    keys, fps = keys[many], fps[many]
    if not len(keys):
        return np.zeros((0, 2), dtype=np.int64)
    rest, variant = _met_here(keys, fps)
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[cuts, len(keys)])
    large = np.repeat(size > SMALL, size)
    links = [np.zeros((0, 2), dtype=np.int64)]
    for d in range(1, SMALL):
        at = np.flatnonzero((keys[d:] == keys[:-d]) & ~large[d:])
        if not len(at):
            break
        new = (rest[at] != rest[at + d]) | (rest[at] == variant[at])
        at = at[new & (np.bitwise_count(fps[at] ^ fps[at + d]) <= radius)]
        links.append(np.stack([fps[at], fps[at + d]], axis=1).view("<i8"))
    for lo, n in zip(cuts[size > SMALL], size[size > SMALL]):
        part, r = fps[lo:lo + n], rest[lo:lo + n]
        if r[0] == variant[lo] or (r != r[0]).any():
            forest = _forest(part, radius)
            links.append(np.array(forest, dtype=np.int64).reshape(-1, 2))
    return np.unique(np.concatenate(links), axis=0)


def bucket_links(rows: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): verified links inside the buckets of (key, fp) rows."""

    def run(batches):
        key_left, fp_left = np.zeros(0, dtype=np.int64), np.zeros(0, dtype="<u8")
        for batch in batches:
            keys = np.concatenate([key_left, batch.column(0).to_numpy()])
            fps = np.concatenate([fp_left, batch.column(1).to_numpy().view("<u8")])
            if not len(keys):
                continue
            open_from = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
            yield _links_batch(_bucket_pairs(keys[:open_from], fps[:open_from], radius))
            key_left, fp_left = keys[open_from:], fps[open_from:]
        yield _links_batch(_bucket_pairs(key_left, fp_left, radius))

    # keys compress so well that sizes say nothing of the work: the number of partitions is not left to be merged
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def _links_batch(links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["a", "b"])


def near_duplicates(prints: DataFrame, doc_id: str = "doc_id", fp: str = "fp", radius: int = 3) -> DataFrame:
    """(fp, root, component_id): for every distinct fingerprint its component and the smallest doc_id there."""
    distinct = saved(prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("least")), "fingerprints")
    emitted = distinct.select(F.explode(variants(F.col("fp"), radius)).alias("key"), "fp")
    roots = components(bucket_links(emitted, radius))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return saved(rooted.join(smallest, "root").select("fp", "root", "component_id"), "components")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One document of every component, all columns: that with the smallest
    doc_id; of rows sharing it, one with the smallest content."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, body = f"c{names.index(doc_id)}", f"c{names.index(text)}"
    rows = inner.withColumn("_k", F.xxhash64(*inner.columns))
    prints = saved(with_fingerprint(rows, body, "_fp", [key, "_k"], shingle), "simhash")
    groups = near_duplicates(prints, key, "_fp", radius)
    first = F.min(F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("id"), F.col("_k").alias("k"))).alias("first")
    stay = prints.join(groups, F.col("_fp") == F.col("fp")).groupBy("root").agg(first).select(
        F.col("first.id").alias("_id"), F.col("first.k").alias("_stay"))
    kept = rows.join(stay, F.col(key).eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_stay")))
    return kept.dropDuplicates([key, "_k"]).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
