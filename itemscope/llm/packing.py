"""Best-fit packing by sums of squares.

Documents become token ids with an end mark, those longer than a sequence are cut into
whole sequences and a rest, and the rests are packed. A piece goes where the
sum over all residual gaps of (number of open sequences with that gap) squared becomes
smallest; a full sequence counts nothing. This keeps the gaps varied, so that later pieces find
one that fits exactly. Pieces come by falling length; of equal sums the smaller gap is taken.

Sequences that end full are settled. The pieces of the others are packed again in further
rounds, which ends within a sequence or two of the bound (tokens / length) wherever lengths allow.

Plan: one pass over the texts writes one narrow row a piece; texts are never shuffled. Pieces are dealt by a
hash of their place, not of their content, into cells of about ``CELL`` pieces, each packed
by one task, so copies spread evenly. What a cell leaves open is dealt anew into fewer
cells until one is left or nothing settles any more. The driver sees counts only.

Token ids are those of the tokenizers library: pieces of text are split here where the file's
rules are known and the text is Latin, distinct pieces go through the library's model once as long as a Python worker remembers them; everything else goes through the library whole.

Defined results: a null text is empty; an empty text is the end mark alone; documents of equal key
are packed each for themselves; texts of any length are read in slices; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemscope.llm.common import Recent, saved

#: Pieces that one task packs at once.
CELL = 16_384
#: Characters whose pieces are held at once.
SLICE_CHARS = 1 << 20
#: Distinct pieces whose ids a Python worker remembers.
KNOWN_PIECES = 600_000
_SPACE = re.compile(r"[ \t\n\x0b\x0c\r]")

# The split pattern and the normalisation for which the short way below is right.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Characters that normalisation only lower-cases, one for one, with ASCII white space.
_LATIN = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\xa1-\xac\xae-įı-ɏ]*")
_NUMBERS = "0-9²³¹¼-¾"
_MARKS = "".join(re.escape(c) for c in map(chr, range(0x21, 0x250)) if c == "_" or not (c.isalnum() or c.isspace()))
# Letters first, as the most frequent: only a contraction and marks can begin alike.
_PIECES = re.compile(rf"[^\W_{_NUMBERS}]+|[{_NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[{_MARKS}]+")


class Coder:
    """Token ids (packed little-endian int32) of texts by one tokenizer file."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(content)
        suffix = spec["model"].get("end_of_word_suffix")
        rules = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0].get("pattern")
        self.short_way = bool(suffix) and rules == _NORMALIZERS and split == {"Regex": _PATTERN}
        self.known = Recent()
        if self.short_way:
            self.special = [t["content"] for t in spec["added_tokens"]]
            bytes_only = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
            spec |= {"normalizer": None, "added_tokens": [], "post_processor": None, "decoder": None, "truncation": None, "padding": None,
                     "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, bytes_only]}}
            self.model = Tokenizer.from_str(json.dumps(spec))
            vocabulary = spec["model"]["vocab"]
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of some pieces: the model reads them as the words of one text, and a word's last id ends it."""
        ids = np.array(self.model.encode(" ".join(pieces), add_special_tokens=False).ids, dtype="<i4")
        stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(stops) != len(pieces):
            raise ValueError("the tokenizer file does not end every word with its suffix")
        raw, at, known = ids.tobytes(), 0, self.known.now
        for piece, stop in zip(pieces, stops.tolist()):
            known[piece] = raw[at:stop]
            at = stop

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of texts of bounded total length."""
        found = [_PIECES.findall(t.lower()) if self.short_way and _LATIN.fullmatch(t) and not any(s in t for s in self.special) else None
                 for t in texts]
        new = self.known.missing(set().union(*(p for p in found if p is not None)), KNOWN_PIECES)
        if new:
            self._learn(list(new))
        known = self.known.now
        return [self._whole(t) if p is None else b"".join([known[x] for x in p]) for t, p in zip(texts, found)]


_LOADED: dict[str, Coder] = {}


def _coder(content: str) -> Coder:
    """One coder per Python worker."""
    if content not in _LOADED:
        _LOADED.clear()
        _LOADED[content] = Coder(content)
    return _LOADED[content]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, str]]:
    """(number of the text, a part of it): parts end at white space after SLICE_CHARS characters, or with the text."""
    for i, t in enumerate(texts):
        lo = 0
        while t and len(t) - lo > SLICE_CHARS and (m := _SPACE.search(t, lo + SLICE_CHARS)):
            yield i, t[lo:m.start()]
            lo = m.end()
        yield i, (t or "")[lo:]


def _encoded(coder: Coder, texts: list[str | None]) -> Iterator[tuple[int, bytes]]:
    """(number of the text, ids of all of it with the end mark)."""
    group: list[tuple[int, str]] = []
    size = at = 0
    parts: list[bytes] = []

    def done():
        nonlocal at, parts
        for (i, _), code in zip(group, coder.encode([s for _, s in group])):
            if i != at:
                yield at, b"".join([*parts, bytes(4)])
                at, parts = i, []
            parts.append(code)

    for i, part in _slices(texts):
        group.append((i, part))
        size += len(part)
        if size >= SLICE_CHARS:
            yield from done()
            group, size = [], 0
    yield from done()
    if texts:
        yield at, b"".join([*parts, bytes(4)])


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", length: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, place): every document's ids with an end mark, cut where
    they are longer than a sequence; ``place`` is different for all rows."""
    with open(path, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "place")]])

    def run(batches):
        coder = _coder(content.value)
        context = TaskContext.get()
        place = (context.partitionId() if context else 0) << 33
        for b in batches:
            rows: list[list[int]] = [[], [], [], [], []]
            for i, ids in _encoded(coder, b.column(1).to_pylist()):
                for n, lo in enumerate(range(0, len(ids), 4 * length)):
                    cut = ids[lo:lo + 4 * length]
                    for column, v in zip(rows, (i, n, lo // 4, len(cut) // 4, zlib.crc32(cut))):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *[pa.array(r, pa.int64()) for r in rows[2:]],
                 pa.array(np.arange(place, place + len(rows[0])))], names=["doc_id", "piece", "start", "length", "ids_crc32", "place"])
            place += len(rows[0])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Packs lengths below ``size`` in the given order; the sequences as lists of positions.

    ``count[g]`` open sequences have gap g. A piece of length s that turns gap g into g - s changes
    the sum of squares by 2 (count[g - s] - count[g]) + 2; closing a gap or opening a sequence, which
    has no gap to leave, by one less."""
    count = np.zeros(size + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    sequences: list[list[int]] = []
    never = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        change = 2 * (count[:size + 1 - s] - count[s:])
        change[0] -= 1
        change[-1] -= 1
        usable = count[s:] > 0
        usable[-1] = True          # a new sequence
        gap = int(np.where(usable, change, never).argmin()) + s
        if gap == size:
            at = len(sequences)
            sequences.append([])
        else:
            at = open_at[gap].pop()
            count[gap] -= 1
        sequences[at].append(i)
        if gap > s:
            open_at[gap - s].append(at)
            count[gap - s] += 1
    return sequences


def pack_cell(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset, settled) of every length: rounds of ``sum_of_squares``, each over the pieces
    of sequences not full so far, until the waste is less than a sequence or two rounds gain nothing."""
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    settled = np.zeros(len(lengths), dtype=bool)
    left, named, idle, least = np.arange(len(lengths)), 0, 0, None
    while len(left):
        left = left[np.argsort(-lengths[left], kind="stable")]
        found = [left[s] for s in sum_of_squares(lengths[left], size)]
        again, waste = [], 0
        for members in found:
            ends = np.cumsum(lengths[members])
            sequence[members], offset[members] = named, ends - lengths[members]
            named += 1
            if ends[-1] == size:
                settled[members] = True
            else:
                again.append(members)
                waste += size - int(ends[-1])
        idle = idle + 1 if least is not None and waste >= least else 0
        least = waste if least is None else min(least, waste)
        if waste < size or idle == 2:
            break
        left = np.concatenate(again)
    return sequence, offset, settled


def pack(cut: DataFrame, size: int = 2048, cell: int = CELL) -> DataFrame:
    """The rows of ``pieces`` (stored) with sequence_id and offset."""
    names = cut.columns
    whole = cut.filter(F.col("length") >= size).withColumns(
        {"sequence_id": -1 - F.col("place"), "offset": F.lit(0).cast("bigint")})
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
                           T.StructField("settled", T.BooleanType())])
    settled, left = [whole], cut.filter(F.col("length") < size)
    n, level = left.count(), 0
    while n:
        cells = -(-n // cell)
        placed = saved(_packed(left, names, schema, size, cells, level), "packed")
        open_ = placed.filter("not settled")
        more = open_.count() if cells > 1 else 0
        if not more or 2 * more > n:  # one cell is left, or too little settles
            settled.append(placed.drop("settled"))
            break
        settled.append(placed.filter("settled").drop("settled"))
        left, n, level = open_.select(*names), more, level + 1
    out = settled[0]
    for rows in settled[1:]:
        out = out.unionByName(rows)
    return out


def _packed(left: DataFrame, names: list[str], schema: T.StructType, size: int, cells: int, level: int) -> DataFrame:
    base = level << 56

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.select(names).combine_chunks()
        order = np.argsort(rows.column("place").to_numpy(), kind="stable")  # the same packing whatever order rows arrive in
        rows = rows.take(pa.array(order))
        sequence, offset, done = pack_cell(rows.column("length").to_numpy(), size)
        first = base + (key[0].as_py() << 28)
        return rows.append_column("sequence_id", pa.array(first + sequence)).append_column("offset", pa.array(offset)) \
            .append_column("settled", pa.array(done))

    dealt = left.withColumn("cell", F.pmod(F.xxhash64("place", F.lit(level)), F.lit(cells)))
    return dealt.groupBy("cell").applyInArrow(run, schema)


def packed(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = 2048, cell: int = CELL) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): the place of every piece of every document."""
    return pack(saved(pieces(docs, path, doc_id, text, size), "pieces"), size, cell).drop("place")
