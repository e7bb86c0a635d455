"""Fuzzy line deduplication by MinHash.

Lines are compared in lower case with white space collapsed. Every line with a word
takes part, whatever its length: repeats go by an exact hash, and a line of at least one
shingle also gets a MinHash signature of its character shingles. (``min_chars`` leaves
shorter lines alone; it is off by default.) Signatures are cut into bands, lines that share a band are candidates, every candidate pair is
verified by the exact Jaccard similarity of its shingle sets, and distributed
union-find joins the links. Of every component (and of every exactly repeated
line) the first line stays: that of the smallest doc_id, then place.

Plan: texts are read once for hashes and bands (written to the shared folder;
a line repeated inside a batch emits its bands once), once for the texts of
candidate lines only, once to drop lines. Bands shuffle packed, thousands of (band, line) pairs
a row, by ranges of band keys; a task keeps one line a band and lets through buckets of two lines or more.
Pairs are not emitted within a bucket: all buckets with the same first line are one group, in which a
line stands once however many bands it shares. Unrelated lines that meet by chance grow with the square of the input, so
texts are read only of lines that a sketch of 128 bits, a few bytes beside their group, leaves possible. A group is compared inside a task (its pairs without a common band too)
and only links leave the task, so no link is lost. A group beyond one block is first met by its first
line alone, which joins a group of copies at the cost of its size; if different components are left in it, they are
compared in blocks of bounded size. Sides measured to be small are broadcast; others shuffle.

Two lines are near if the sets of their shingles of 5 characters reach the similarity, whatever
their lengths (a line shorter than a shingle is one shingle). Lines of one language share few
shingles of 5, so the bands meet few unrelated lines; one changed character leaves a
line of 49 characters or more at 0.8. With 18 bands of 6 rows a pair at 0.8 is a candidate with
probability 0.996, at 0.9 with 0.99999. Signatures take one hash a shingle: it falls into one of 108 bins, the least of a bin is
its row, and an empty bin borrows from another by a fixed order, equal for all lines.

Defined results: null stays null; an empty text stays; rows equal in
doc_id and text are one document here and stay equal; a document may end
with an empty text but is never dropped; an empty table gives an empty table;
all other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemscope.llm.common import join_measured, saved, text_key
from itemscope.llm.graph import components

#: Characters of the shortest line looked at; 1 is every line with a word.
MIN_CHARS = 1
SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 18, 6
#: Characters of a block in which the lines of a bucket are compared (some 2000 lines).
BLOCK_CHARS = 600_000
#: Characters whose hashes are held at once: arrays of half a MB stay in a core's cache.
SIGNED_CHARS = 1 << 16
#: Shorter lines have no sketch: too few shingles to tell by their signature.
SKETCH_CHARS = 128
#: A pair at the similarity differs in more bits only if it lies so many standard deviations off (1 of 10^9 pairs).
SKETCH_DEVIATIONS = 6
#: Lines of a group whose sketches are compared; larger groups keep all their lines.
SIFTED_LINES = 1 << 12
#: Groups of up to so many lines are compared pair by pair.
FEW_LINES = 5
#: Lines a task holds before it hands their rows on.
HELD_LINES = 1 << 16
#: (Band, line) pairs a task holds before it hands them on; pairs of a part, at most on average.
HELD_PAIRS = 1 << 20
PART_PAIRS = 1 << 19

_NODE = pa.struct([("h1", pa.int64()), ("h2", pa.int64())])
#: A shingle's hash is the sum of its characters times these odd numbers, mixed.
_FACTORS = np.random.default_rng(22).integers(1 << 62, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EMPTY = np.uint32(0xFFFFFFFF)
#: Where an empty bin looks for a value, try by try; then it takes the line's least.
_BORROW = np.random.default_rng(20).integers(0, BANDS * ROWS, (24, BANDS * ROWS))


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def shingles(line: str, n: int = SHINGLE) -> set[str]:
    return {line[i:i + n] for i in range(max(1, len(line) - n + 1))}


def hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all lines in a row, and where each line's start and end.
    A line shorter than a shingle is filled up with null characters."""
    lines = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum([len(x) for x in lines])
    starts = ends - [len(x) for x in lines]
    count = max(0, len(chars) - SHINGLE + 1)
    h = np.zeros(count, dtype=np.uint64)
    part = np.empty(count, dtype=np.uint64)
    for i, factor in enumerate(_FACTORS):
        np.multiply(chars[i:i + count], factor, out=part)
        np.add(h, part, out=h)
    np.right_shift(h, np.uint64(32), out=part)
    np.bitwise_xor(h, part, out=h)
    np.multiply(h, np.uint64(0x9E3779B97F4A7C15), out=h)
    np.right_shift(h, np.uint64(29), out=part)
    np.bitwise_xor(h, part, out=h)
    return h, starts, ends - SHINGLE + 1


def shingle_arrays(lines: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every line."""
    h, starts, ends = hashed(lines)
    return [_distinct(h[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]


def _distinct(x: np.ndarray) -> np.ndarray:
    """np.unique by sorting; on arrays of a few hundred numbers its hash table takes longer."""
    x = np.sort(x)
    repeated = x[1:] == x[:-1]
    return x[np.r_[True, ~repeated]] if repeated.any() else x


def similar(x: np.ndarray, y: np.ndarray, at_least: float = SIMILARITY) -> bool:
    """Exact Jaccard similarity of two shingle sets against the threshold."""
    small, large = sorted((len(x), len(y)))
    if small < at_least * large:
        return False
    z = np.concatenate([x, y])
    z.sort()
    both = int(np.count_nonzero(z[1:] == z[:-1]))
    return both >= at_least * (small + large - both)


def near(a: str, b: str, at_least: float = SIMILARITY) -> bool:
    """True if two normal lines reach the similarity."""
    return similar(*shingle_arrays([a, b]), at_least)


def _split(text: str) -> Iterator[str]:
    """The lines of a text, one at a time."""
    lo = 0
    while (hi := text.find("\n", lo)) >= 0:
        yield text[lo:hi]
        lo = hi + 1
    yield text[lo:]


def _groups(lines: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for line in lines:
        group.append(line)
        size += len(line)
        if size >= SIGNED_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def signatures(lines: list[str]) -> np.ndarray:
    """MinHash signatures (len(lines) x BANDS * ROWS) of normal lines, by one hash a shingle."""
    out, size = [], BANDS * ROWS
    for group in _groups(lines):
        h, starts, ends = hashed(group)
        # shingles that reach over a line's end go to a row of their own
        owner = np.repeat(np.arange(0, len(group) * size, size), np.diff(np.r_[starts, len(h) + SHINGLE - 1]))[:len(h)]
        across = (ends[:-1, None] + np.arange(SHINGLE - 1)).reshape(-1)
        owner[across] = len(group) * size
        bins = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        sig = np.full((len(group) + 1, size), _EMPTY, dtype=np.uint32)
        np.minimum.at(sig.reshape(-1), owner + bins, (h >> np.uint64(32)).astype(np.uint32))
        sig = sig[:-1]
        first = sig.copy()
        row, col = np.nonzero(sig == _EMPTY)
        for order in _BORROW:
            if not len(row):
                break
            lent = first[row, order[col]]
            sig[row, col] = lent
            short = lent == _EMPTY
            row, col = row[short], col[short]
        sig[row, col] = first.min(axis=1)[row]
        out.append(sig)
    return np.concatenate(out) if out else np.zeros((0, size), dtype=np.uint32)


def bands(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    count = sig.shape[1] // rows
    parts = sig.reshape(len(sig), count, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), (len(sig), count)).copy()
    for i in range(rows):
        key = (key ^ parts[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def sketches(sig: np.ndarray) -> np.ndarray:
    """The last bits of the values of a signature, filled up to two 64-bit numbers a line.
    Two lines of similarity s differ in (1 - s) / 2 of them on average."""
    bits = np.zeros((len(sig), 128), dtype=np.uint8)
    bits[:, :sig.shape[1]] = sig & 1
    return np.packbits(bits, axis=1).view(np.int64)


def most_bits(similarity: float = SIMILARITY) -> int:
    """The bits in which the sketches of two lines at the similarity may differ."""
    n, p = BANDS * ROWS, (1 - similarity) / 2
    return int(n * p + SKETCH_DEVIATIONS * (n * p * (1 - p)) ** 0.5)


def line_marks(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The band keys of all lines in a row, how many are each line's (none, if it is shorter than a shingle), and their sketches."""
    given = np.array([len(line) >= SHINGLE for line in lines], dtype=bool)
    sig = signatures([line for line, ok in zip(lines, given) if ok])
    sketch = np.zeros((len(lines), 2), dtype=np.int64)
    sketch[given] = sketches(sig)
    return bands(sig).reshape(-1), given * BANDS, sketch


def line_bands(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The band keys of all lines in a row, and how many are each line's."""
    return line_marks(lines)[:2]


def line_table(docs: DataFrame, doc_id: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, id, at, h1, h2, bands, s1, s2): every line with a word, its place and hashes; the bands and the
    sketch (null for lines under SKETCH_CHARS) stand on the first of equal lines of a batch."""
    narrow = docs.select(*text_key(text), F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t"))

    least, held, sketched = max(1, min_chars), HELD_LINES, max(SHINGLE, SKETCH_CHARS)

    def rows_of(batch, rows, places, digests, first, unique):
        """The rows of some lines; ``unique`` are the texts of those marked ``first``."""
        counts = np.zeros(len(rows), dtype=np.int32)
        sketch = np.zeros((len(rows), 2), dtype=np.int64)
        bare = np.ones(len(rows), dtype=bool)
        at = np.flatnonzero(first)
        keys, counts[at], sketch[at] = line_marks(unique)
        bare[at] = [len(line) < sketched for line in unique]
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(keys))
        h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
        take = pa.array(np.array(rows))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), pa.array(places, pa.int32()),
             pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), lists, pa.array(sketch[:, 0].copy(), mask=bare), pa.array(sketch[:, 1].copy(), mask=bare)],
            names=["k1", "k2", "id", "at", "h1", "h2", "bands", "s1", "s2"])

    def run(batches):
        for batch in batches:
            rows, places, digests, first, unique = [], [], [], [], []
            seen: set[bytes] = set()
            for row, t in enumerate(batch.column(3)):
                for at, line in enumerate(_split(t.as_py() or "")):
                    if len(line) < least:
                        continue
                    line = normal(line)
                    if len(line) < least:
                        continue
                    digest = xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))
                    rows.append(row)
                    places.append(at)
                    digests.append(digest)
                    first.append(digest not in seen)
                    if first[-1]:
                        seen.add(digest)
                        unique.append(line)
                    if len(rows) >= held:
                        yield rows_of(batch, rows, places, digests, first, unique)
                        rows, places, digests, first, unique = [], [], [], [], []
            if rows:
                yield rows_of(batch, rows, places, digests, first, unique)

    schema = T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
                           T.StructField("id", docs.schema[doc_id].dataType), T.StructField("at", T.IntegerType()),
                           T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()),
                           T.StructField("bands", T.ArrayType(T.LongType())),
                           T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType())])
    return narrow.mapInArrow(run, schema)


def packed_bands(table: DataFrame, parts: int) -> DataFrame:
    """(part, pairs): the (band, h1) pairs of many lines as one binary value a part.

    A part is a range of band keys, so equal bands meet in one part; a row of the
    shuffle carries thousands of pairs instead of one."""
    held_pairs = HELD_PAIRS

    def dealt(held):
        keys, lines = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(keys.view(np.uint64))
        pairs = np.stack([keys[order], lines[order]], axis=1)
        part = (pairs[:, 0].view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        offsets = (np.r_[starts, len(pairs)] * 16).astype(np.int32)
        data = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(pairs.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), data], names=["part", "pairs"])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            lists = batch.column(0)
            keys = lists.flatten().to_numpy()
            if len(keys):
                held.append((keys, np.repeat(batch.column(1).to_numpy(), lists.value_lengths().to_numpy())))
                count += len(keys)
            if count >= held_pairs:
                yield dealt(held)
                held, count = [], 0
        if held:
            yield dealt(held)

    return table.select("bands", "h1").mapInArrow(run, "part int, pairs binary")


def met_lines(table: DataFrame) -> DataFrame:
    """(band, h1, first): the lines whose band holds two lines or more, and the line kept of the band; rows may repeat.

    A task keeps one line of each band of its part: as soon as a band has met a second
    line, its rows are handed on and not kept, so a band that a third of all lines share
    needs no more memory than any other. The number of parts follows the number of lines."""
    parts = max(1, -(-table.count() * BANDS // PART_PAIRS))
    held_pairs = HELD_PAIRS

    def merged(state, held):
        """The rows to hand on, and the new state: bands, a line of each (the least it came with), whether it was handed on."""
        pairs = np.concatenate(held)
        keys = np.concatenate([state[0], pairs[:, 0]])
        own = np.concatenate([state[1], pairs[:, 1]])
        given = np.r_[state[2], np.zeros(len(pairs), dtype=bool)]
        order = np.argsort(keys, kind="stable")  # the line kept of a band comes first
        keys, own, given = keys[order], own[order], given[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        times = np.diff(np.r_[starts, len(keys)])
        many = np.logical_or.reduceat(given | (own != np.repeat(own[starts], times)), starts)
        first = np.where(order[starts] < len(state[0]), own[starts], np.minimum.reduceat(own, starts))
        out = np.stack([keys, own, np.repeat(first, times)], axis=1)[np.repeat(many, times) & ~given]
        out = out[np.lexsort((out[:, 1], out[:, 0]))]
        if len(out):
            out = out[np.r_[True, (out[1:] != out[:-1]).any(axis=1)]]
        return out, (keys[starts], first, many)

    def run(batches):
        state = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool))
        held, count = [], 0
        for batch in batches:
            for value in batch.column(0):
                held.append(np.frombuffer(value.as_buffer(), dtype=np.int64).reshape(-1, 2).copy())
                count += len(held[-1])
                if count >= held_pairs:
                    out, state = merged(state, held)
                    held, count = [], 0
                    yield _pairs_batch(out, ["band", "h1", "first"])
        if held:
            yield _pairs_batch(merged(state, held)[0], ["band", "h1", "first"])

    dealt = packed_bands(table, parts).repartitionById(parts, "part").select("pairs")
    return dealt.mapInArrow(run, "band bigint, h1 bigint, first bigint")


def shared_buckets(table: DataFrame) -> DataFrame:
    """The distinct (band, h1) rows of lines whose band holds two lines or more."""
    return met_lines(table).select("band", "h1").dropDuplicates(["band", "h1"])


def bucket_groups(table: DataFrame) -> DataFrame:
    """The distinct (band, h1) rows where the buckets with the same first line are one, named by it."""
    return met_lines(table).select(F.col("first").alias("band"), "h1").distinct()


def _pairs_batch(x: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x[:, i].copy()) for i in range(x.shape[1])], names=names)


def candidate_places(table: DataFrame, groups: DataFrame) -> DataFrame:
    """(k1, k2, at, h1, h2, s1, s2): where every line of a group first stands, and its sketch."""
    wanted = saved(groups.select("h1").distinct(), "candidates")
    places = join_measured(table.drop("id", "bands"), wanted, ["h1"], "left_semi", F.lit(24))
    first = places.groupBy("h1", "h2").agg(F.min(F.struct("k1", "k2", "at")).alias("p"), F.max("s1").alias("s1"), F.max("s2").alias("s2"))
    return saved(first.select("p.*", "h1", "h2", "s1", "s2"), "candidate-places")


def possible(group: np.ndarray, sketch: np.ndarray, bare: np.ndarray, most: int) -> np.ndarray:
    """Which lines have another one in their group whose sketch differs in ``most`` bits at most; a line without a
    sketch (``bare``) may be near to any. The lines of a group stand side by side."""
    keep = np.zeros(len(group), dtype=bool)
    sketch = sketch.view(np.uint64)
    x, step = np.arange(len(group)), 0
    while len(x):
        step += 1
        x = x[x + step < len(group)]
        x = x[group[x] == group[x + step]]
        y = x + step
        ok = (np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1) <= most) | bare[x] | bare[y]
        keep[x[ok]] = True
        keep[y[ok]] = True
    return keep


def sifted(groups: DataFrame, places: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The (band, h1) rows of ``groups`` without the lines that cannot be near to another one of their group.

    Only numbers are shuffled here. A group of more than SIFTED_LINES lines keeps them all, so that no task
    holds or compares more."""
    large = saved(groups.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SIFTED_LINES).select("band"), "unsifted-groups")
    none = large.isEmpty()
    small = groups if none else join_measured(groups, large, ["band"], "left_anti")
    most, held_rows = most_bits(similarity), HELD_LINES

    def left(rows):
        band, h1, s1, s2 = rows.columns
        sketch = np.stack([s.fill_null(0).to_numpy() for s in (s1, s2)], axis=1)
        keep = possible(band.to_numpy(), sketch, s1.is_null().to_numpy(zero_copy_only=False), most)
        return pa.RecordBatch.from_arrays([band, h1], names=["band", "h1"]).filter(pa.array(keep))

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= held_rows:  # the last group may go on
                rows = pa.concat_batches(held)
                band = rows.column(0).to_numpy()
                whole = int(np.searchsorted(band, band[-1]))
                if whole:
                    yield left(rows.slice(0, whole))
                held = [rows.slice(whole)]
                count = len(held[0])
        if held:
            yield left(pa.concat_batches(held))

    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = join_measured(small, places.select("h1", "s1", "s2"), ["h1"], "inner", F.lit(24)).select("band", "h1", "s1", "s2")
    kept = rows.repartition(n, "band").sortWithinPartitions("band").mapInArrow(run, "band bigint, h1 bigint")
    if not none:
        kept = kept.unionByName(join_measured(groups, large, ["band"], "left_semi"))
    return saved(kept, "sifted-groups")


def candidate_texts(docs: DataFrame, text: str, places: DataFrame, groups: DataFrame) -> DataFrame:
    """(h1, h2, line, n): the text of every line of a group, read where it first stands, and its length."""
    wanted = saved(groups.select("h1").distinct(), "candidates")
    first = join_measured(places.select("k1", "k2", "at", "h1", "h2"), wanted, ["h1"], "left_semi", F.lit(24))
    where = saved(first.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "h1", "h2")).alias("places")), "places")
    keyed = docs.select(*text_key(text), F.col(text).cast("string").alias("t"))
    found = join_measured(keyed, where, ["k1", "k2"], "inner", 64 + 24 * F.size("places"))

    def run(batches):
        for batch in batches:
            out = []
            seen: set[tuple[int, int]] = set()
            for k1, k2, t, places in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "t", "places"))):
                if (k1, k2) not in seen:
                    seen.add((k1, k2))
                    split = t.split("\n")
                    out += [(p["h1"], p["h2"], normal(split[p["at"]])) for p in places]
            if out:
                a, b, c = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string()),
                                                  pa.array([len(x) for x in c], pa.int64())], names=["h1", "h2", "line", "n"])

    lines = found.select("k1", "k2", "t", "places").mapInArrow(run, "h1 bigint, h2 bigint, line string, n bigint")
    return saved(lines.dropDuplicates(["h1", "h2"]), "candidate-lines")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): the pairs of lines (structs h1, h2) at the similarity or above."""
    side = lambda x: texts.select(F.col("h1").alias(x), F.struct("h1", "h2").alias(f"{x}_id"), F.col("line").alias(f"{x}_line"))

    def run(batches):
        for batch in batches:
            ok: list[bool] = []
            for lo in range(0, batch.num_rows, 256):
                left, right = (batch.column(i).slice(lo, 256).to_pylist() for i in (2, 3))
                texts = list({*left, *right})
                known = dict(zip(texts, shingle_arrays(texts)))
                ok += [similar(known[a], known[b], similarity) for a, b in zip(left, right)]
            keep = batch.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([keep.column(0), keep.column(1)], names=["a", "b"])

    both = pairs.join(side("a"), "a").join(side("b"), "b").filter("a_id <> b_id").select("a_id", "b_id", "a_line", "b_line")
    node = "struct<h1: bigint, h2: bigint>"
    return both.mapInArrow(run, f"a {node}, b {node}")


def line_components(docs: DataFrame, text: str, table: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root): the component of every line with a near-duplicate."""
    groups = saved(bucket_groups(table), "groups")
    places = candidate_places(table, groups)
    groups = sifted(groups, places, similarity)
    texts = candidate_texts(docs, text, places, groups)
    sizes = groups.join(texts.select("h1", "n"), "h1").groupBy("band").agg(F.sum("n").alias("n"))
    large = saved(sizes.filter(F.col("n") > BLOCK_CHARS).select("band", F.ceil(F.col("n") / BLOCK_CHARS).cast("int").alias("m")), "large-groups")
    named = texts.select("h1", F.struct("h1", "h2").alias("node"), "line")
    if large.isEmpty():
        links = cross_links(groups.withColumn("m", F.lit(1)).join(named.withColumn("root", F.col("node")), "h1"), similarity)
        return saved(components(saved(links, "links-found")), "roots")
    # large groups: what their first lines leave apart
    stars = join_measured(groups, large, ["band"], "inner").filter("h1 <> band").select(F.col("band").alias("a"), F.col("h1").alias("b"))
    roots = saved(components(saved(verified(stars, texts, similarity), "star-links")), "star-roots")
    named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    label = F.xxhash64("root")
    mixed = join_measured(groups, large, ["band"], "inner").join(named.select("h1", label.alias("root")), "h1").groupBy("band", "m") \
        .agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("band", "m")
    small = join_measured(groups, large, ["band"], "left_anti").withColumn("m", F.lit(1))
    apart = small.unionByName(join_measured(groups, saved(mixed, "mixed-groups"), ["band"], "inner")).join(named, "h1")
    more = saved(cross_links(apart, similarity), "cross-links")
    if more.isEmpty():
        return roots
    # components of components: links between their roots only
    again = saved(components(more), "cross-roots")
    alone = again.select("node").join(roots, "node", "left_anti").withColumn("root", F.col("node"))
    return roots.unionByName(alone).join(again.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left") \
        .select("node", F.coalesce("top", "root").alias("root"))


def cross_links(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): roots of two components that hold lines of one bucket at the similarity.

    ``rows`` are (band, m, node, root, line). A bucket is cut into ``m`` blocks of about
    BLOCK_CHARS characters, and every two blocks meet in a group of their own, so no
    group grows with its bucket; pairs are compared there and never leave the task."""
    block = F.pmod(F.xxhash64("node", F.lit(7)), F.col("m")).cast("int")
    each = rows.withColumn("mine", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    dealt = each.select("band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine",
                        F.col("root.h1").alias("r1"), F.col("root.h2").alias("r2"), "line")

    def compared(group):
        """group: (mine, root, shingles) rows, band, i and j alike. Every line meets all longer
        ones at once: their shingles are numbered, and those a line has are marked and counted."""
        if len(group) <= FEW_LINES:
            label = [g[1] for g in group]
            for x, y in combinations(range(len(group)), 2):
                if label[x] != label[y] and similar(group[x][2], group[y][2], similarity):
                    label = [label[x] if r == label[y] else r for r in label]
                    yield group[x][1], group[y][1]
            return
        group.sort(key=lambda g: len(g[2]))
        mine = np.array([g[0] for g in group])
        roots = list(dict.fromkeys(g[1] for g in group))
        number = {r: k for k, r in enumerate(roots)}
        root = np.array([number[g[1]] for g in group])
        label = root.copy()
        if len(roots) < 2:
            return
        sizes = np.array([len(g[2]) for g in group])
        ends = np.cumsum(sizes)
        names, flat = np.unique(np.concatenate([g[2] for g in group]), return_inverse=True)
        marks = np.zeros(len(names), dtype=np.int32)
        last = np.searchsorted(similarity * sizes, sizes, side="right")  # lines too long for this one
        apart = len({*mine.tolist()}) > 1  # two blocks: only across them
        for x in range(len(group) - 1):
            lo, hi = x + 1, int(last[x])
            open_ = label[lo:hi] != label[x]
            if apart:
                open_ &= mine[lo:hi] != mine[x]
            if not open_.any():
                continue
            own = flat[ends[x] - sizes[x]:ends[x]]
            marks[own] = 1
            both = np.add.reduceat(marks[flat[ends[x]:ends[hi - 1]]], ends[x:hi - 1] - ends[x])
            marks[own] = 0
            for y in (lo + np.flatnonzero(open_ & (both >= similarity * (sizes[x] + sizes[lo:hi] - both)))).tolist():
                if label[y] != label[x]:
                    label[label == label[y]] = label[x]
                    yield roots[root[x]], roots[root[y]]

    def run(batches):
        key, group = None, []
        for batch in batches:
            found = []
            *others, lines = (c.to_pylist() for c in batch.columns)
            sets = (x for part in _groups(lines) for x in shingle_arrays(part))
            for band, i, j, mine, r1, r2, own in zip(*others, sets):
                if (band, i, j) != key:
                    found += compared(group)
                    key, group = (band, i, j), []
                group.append((mine, (r1, r2), own))
            yield _links_batch(found)
        yield _links_batch(list(compared(group)))

    def _links_batch(found):
        return pa.RecordBatch.from_arrays([pa.array([dict(zip(("h1", "h2"), f[k])) for f in found], _NODE) for k in (0, 1)], names=["a", "b"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    node = "struct<h1: bigint, h2: bigint>"
    return dealt.repartition(n, "band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(run, f"a {node}, b {node}").distinct()


def dropped_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                  similarity: float = SIMILARITY) -> DataFrame:
    """(id, k1, k2, drop): for every document that loses lines, their places."""
    table = saved(line_table(docs, doc_id, text, min_chars), "lines")
    roots = line_components(docs, text, table, similarity)
    place = F.struct(F.col("id").isNull().alias("n"), "id", "k1", "k2", "at")
    # lines that stand once and are near to none keep their place
    times = table.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times"))
    near_ones = roots.select(F.col("node.h1").alias("h1"), F.col("node.h2").alias("h2"), "root")
    rooted = times.join(near_ones, ["h1", "h2"], "left").filter("times > 1 OR root IS NOT NULL") \
        .select("h1", "h2", F.coalesce("root", F.struct("h1", "h2")).alias("root"))
    again = saved(join_measured(table.drop("bands", "s1", "s2"), saved(rooted, "line-roots"), ["h1", "h2"], "inner", F.lit(64)), "shared-lines")
    stays = saved(again.groupBy("root").agg(F.min(place).alias("stay")), "first-lines")
    goes = join_measured(again, stays, ["root"], "inner", F.lit(96)).filter(place != F.col("stay"))
    return saved(goes.groupBy("id", "k1", "k2").agg(F.array_sort(F.collect_set("at")).alias("drop")), "dropped-lines")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: bool = False, **options) -> DataFrame:
    """All rows and columns of ``docs``, the texts without the dropped lines;
    with ``counts`` also n_lines (before) and n_dropped."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, body = f"c{names.index(doc_id)}", f"c{names.index(text)}"
    goes = dropped_lines(inner, key, body, **options).withColumn("_n", F.col("id").isNull()) \
        .withColumn("id", F.coalesce("id", F.lit(0).cast(inner.schema[key].dataType)))
    keyed = inner.select("*", *text_key(body), F.col(key).isNull().alias("_n"),
                         F.coalesce(key, F.lit(0).cast(inner.schema[key].dataType)).alias("id"))
    marked = join_measured(keyed, goes, ["id", "_n", "k1", "k2"], "left", 64 + 8 * F.size("drop"))
    marked = marked.withColumn("_l", F.when(F.col("drop").isNotNull(), F.split(body, "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("_l") - 1), F.col("drop"))
    rest = F.when(F.col("drop").isNull(), F.col(body)).otherwise(F.array_join(F.transform(left, lambda i: F.get(F.col("_l"), i)), "\n"))
    out = [(rest if f"c{i}" == body else F.col(f"c{i}")).alias(n) for i, n in enumerate(names)]
    if counts:
        breaks = F.octet_length(body) - F.octet_length(F.replace(F.col(body), F.lit("\n"), F.lit("")))
        out += [F.coalesce(breaks + 1, F.lit(0)).cast("bigint").alias("n_lines"),
                F.coalesce(F.size("drop"), F.lit(0)).cast("bigint").alias("n_dropped")]
    return marked.select(*out)
