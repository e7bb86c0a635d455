"""Gram matrix X'X of a sparse long-form matrix (row, col_idx, value), in square blocks.

One distributed pass over X. A task streams its rows, sorted by row, and adds the outer products of
thousands of rows at a time into an accumulator of which only touched memory pages exist; it emits the touched
column blocks of the upper triangle, BLOCK x BLOCK numbers each. Partitions are coalesced to the
cluster's slots first, so as many partial sums meet as tasks run at once, not as many as the
input has partitions. Partial blocks are added as a two-level tree of streams: a fold holds one block, whatever its fan-in.

The result has n_cols^2 numbers at most, whatever the number of rows: it is stored once, by
block row, and everything iterative (Lanczos steps, PCA) reads it instead of X. ``n_cols`` is a
bounded vocabulary; a task needs up to n_cols^2 * 8 bytes (200 MB at 5,000).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 128           # columns of a block: 128 KB of doubles
FANOUT = 32           # groups in which the partial sums of a block meet first
CHUNK_ENTRIES = 32_768  # non-zeros per vectorised chunk inside a task
CHUNK_ROWS = 512      # rows multiplied at once where they are dense
OUTER_ENTRIES = 1 << 19  # non-zeros whose outer products are added at once
BATCH = 32            # blocks handed to Spark at once


class Rows:
    """Whole rows of the matrix, sorted by row: a stretch of a task's stream."""

    def __init__(self, pdf: pd.DataFrame, row_id: str):
        ids = pdf[row_id].to_numpy()
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        self.ids = ids[first]
        self.rows = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(ids)]))
        self.cols = pdf["col_idx"].to_numpy().astype(np.int64)
        self.vals = pdf["value"].to_numpy().astype(float)

    def times(self, mat: np.ndarray) -> np.ndarray:
        """These rows times ``mat`` (one dense row per row), O(nnz * l)."""
        out = np.zeros((len(self.ids), mat.shape[1]))
        for lo in range(0, len(self.vals), CHUNK_ENTRIES):
            hi = min(lo + CHUNK_ENTRIES, len(self.vals))
            r = self.rows[lo:hi]
            prod = self.vals[lo:hi, None] * mat[self.cols[lo:hi]]
            starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            out[r[starts]] += np.add.reduceat(prod, starts, axis=0)
        return out

    def add_transpose_times(self, y: np.ndarray, out: np.ndarray) -> None:
        """out += (these rows)' @ y, O(nnz * l)."""
        for lo in range(0, len(self.vals), CHUNK_ENTRIES):
            hi = min(lo + CHUNK_ENTRIES, len(self.vals))
            o = np.argsort(self.cols[lo:hi], kind="stable")
            c = self.cols[lo:hi][o]
            prod = self.vals[lo:hi][o, None] * y[self.rows[lo:hi][o]]
            starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            out[c[starts]] += np.add.reduceat(prod, starts, axis=0)


def whole_rows(batches, row_id: str) -> Iterator[Rows]:
    """The stream of a task as stretches of whole rows; a row that a batch cuts
    goes over to the next stretch."""
    held = None
    for pdf in batches:
        if held is not None:
            pdf = pd.concat([held, pdf])
        if not len(pdf):
            continue
        last = pdf[row_id].to_numpy() == pdf[row_id].iloc[-1]
        held, whole = pdf[last], pdf[~last]
        if len(whole):
            yield Rows(whole, row_id)
    if held is not None and len(held):
        yield Rows(held, row_id)


def _stretches(parts: Iterator[Rows]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of many batches together, OUTER_ENTRIES at a time and a batch at most: where each row starts, columns, values."""
    held, count = [], 0

    def together():
        lengths = np.concatenate([np.diff(np.flatnonzero(np.r_[True, p.rows[1:] != p.rows[:-1], True])) for p in held])
        return np.r_[0, np.cumsum(lengths)], np.concatenate([p.cols for p in held]), np.concatenate([p.vals for p in held])

    for rows in parts:
        held.append(rows)
        count += len(rows.cols)
        if count >= OUTER_ENTRIES:
            yield together()
            held, count = [], 0
    if held:
        yield together()


def _add_outer(bounds: np.ndarray, cols: np.ndarray, vals: np.ndarray, acc: np.ndarray) -> None:
    """Adds the upper triangle of X'X to ``acc`` for the rows X that start at ``bounds`` (what is below the
    diagonal is not meant). Where rows fill an eighth of the touched columns, by dense products; else column by column:
    the rows that hold a column add up what they hold from there on, within one row of ``acc``, which stays in the cache."""
    n, touched = len(bounds) - 1, np.unique(cols)
    if 8 * len(cols) >= n * len(touched):
        for at in range(0, n, CHUNK_ROWS):
            part = bounds[at:at + CHUNK_ROWS + 1]
            dense = np.zeros((len(part) - 1, len(touched)))
            own = slice(part[0], part[-1])
            dense[np.repeat(np.arange(len(part) - 1), np.diff(part)), np.searchsorted(touched, cols[own])] = vals[own]
            acc[np.ix_(touched, touched)] += dense.T @ dense
        return
    row = np.repeat(np.arange(n), np.diff(bounds))
    order = np.lexsort((cols, row))
    cols, vals = cols[order], vals[order]
    left = bounds[1:][row] - np.arange(len(cols))       # entries of the row from this one on
    by_column = np.argsort(cols, kind="stable")
    ends = np.searchsorted(cols[by_column], touched, side="right")
    for column, lo, hi in zip(touched.tolist(), np.r_[0, ends[:-1]].tolist(), ends.tolist()):
        entries = by_column[lo:hi]
        lengths = left[entries]
        upto = np.cumsum(lengths)
        at = np.arange(upto[-1]) + np.repeat(entries - upto + lengths, lengths)
        acc[column, column:] += np.bincount(cols[at] - column, vals[at] * np.repeat(vals[entries], lengths), len(acc) - column)


def batches_of(items: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Tuples of ints and one array of doubles, as record batches."""
    held: list[tuple] = []

    def batch():
        columns = [pa.array([h[i] for h in held], pa.int32()) for i in range(len(names) - 1)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([h[-1].tobytes() for h in held], pa.binary())], names=names)

    for item in items:
        held.append(item)
        if len(held) == BATCH:
            yield batch()
            held = []
    if held:
        yield batch()


def folded(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The sums of ``data`` (doubles as bytes) by integer keys, each as a stream that holds one sum."""

    def run(batches):
        def sums():
            at, total = None, None
            for b in batches:
                for *key, data in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
                    if key != at:
                        if at is not None:
                            yield (*at, total)
                        at, total = key, np.frombuffer(data).copy()
                    else:
                        total += np.frombuffer(data)
            if at is not None:
                yield (*at, total)

        yield from batches_of(sums(), [*keys, "data"])

    schema = ", ".join(f"{k} int" for k in keys) + ", data binary"
    return parts.select(*keys, "data").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def slots(df: DataFrame) -> DataFrame:
    """``df`` in at most as many partitions as the cluster runs tasks at once (no shuffle)."""
    return df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism))


def tree(parts: DataFrame, keys: list[str], x: DataFrame) -> DataFrame:
    """The sums of the partial blocks that the slots of ``x`` emit: in one fold where FANOUT slots
    meet at most, else first within groups."""
    if x.sparkSession.sparkContext.defaultParallelism > FANOUT:
        parts = folded(parts, [*keys, "grp"])
    return folded(parts, keys)


def task_group() -> int:
    context = TaskContext.get()
    return (context.partitionId() if context else 0) % FANOUT


def blocks(x: DataFrame, row_id: str, n_cols: int) -> DataFrame:
    """(bi, bj, data): all blocks of X'X that are not zero, stored and partitioned by block row.
    The rows of ``x`` (row_id, col_idx, value) must be together and sorted."""
    from itemscope.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(x.sparkSession)
    side = -(-n_cols // BLOCK) * BLOCK

    def partial(batches):
        acc = np.zeros((side, side))
        for stretch in _stretches(whole_rows(batches, row_id)):
            _add_outer(*stretch, acc)
        group = task_group()

        def touched():
            for i in range(0, side, BLOCK):
                for j in range(i, side, BLOCK):
                    block = acc[i:i + BLOCK, j:j + BLOCK]
                    if i == j:
                        block = np.triu(block) + np.triu(block, 1).T
                    if block.any():
                        yield group, i // BLOCK, j // BLOCK, block

        for b in batches_of(touched(), ["grp", "bi", "bj", "data"]):
            yield b.to_pandas()

    parts = slots(x).mapInPandas(partial, "grp int, bi int, bj int, data binary")
    upper = tree(parts, ["bi", "bj"], x)

    def both(batches):
        def all_blocks():
            for b in batches:
                for i, j, data in zip(*(b.column(k).to_pylist() for k in range(3))):
                    block = np.frombuffer(data).reshape(BLOCK, BLOCK)
                    yield i, j, block
                    if i != j:
                        yield j, i, np.ascontiguousarray(block.T)

        yield from batches_of(all_blocks(), ["bi", "bj", "data"])

    whole = upper.mapInArrow(both, "bi int, bj int, data binary")
    return whole.repartition("bi").sortWithinPartitions("bi", "bj").checkpoint(eager=True)


def times(gram: DataFrame, z: np.ndarray) -> np.ndarray:
    """(X'X) z from the stored blocks: a task sends one BLOCK x l sum a block row."""
    n_cols, l = z.shape
    side = -(-n_cols // BLOCK) * BLOCK
    padded = np.zeros((side, l))
    padded[:n_cols] = z
    zb = gram.sparkSession.sparkContext.broadcast(padded)

    def run(batches):
        def sums():
            at, total = None, None
            for b in batches:
                for i, j, data in zip(*(b.column(k).to_pylist() for k in range(3))):
                    if i != at:
                        if at is not None:
                            yield at, total
                        at, total = i, np.zeros((BLOCK, l))
                    total += np.frombuffer(data).reshape(BLOCK, BLOCK) @ zb.value[j * BLOCK:(j + 1) * BLOCK]
            if at is not None:
                yield at, total

        yield from batches_of(sums(), ["bi", "data"])

    out = np.zeros((side, l))
    for r in gram.mapInArrow(run, "bi int, data binary").collect():
        out[r["bi"] * BLOCK:(r["bi"] + 1) * BLOCK] = np.frombuffer(r["data"]).reshape(BLOCK, l)
    zb.unpersist()
    return out[:n_cols]


def dense(gram: DataFrame, n_cols: int) -> np.ndarray:
    """The whole matrix on the driver, for a p x p eigenproblem."""
    side = -(-n_cols // BLOCK) * BLOCK
    out = np.zeros((side, side))
    for r in gram.toLocalIterator():
        out[r["bi"] * BLOCK:(r["bi"] + 1) * BLOCK, r["bj"] * BLOCK:(r["bj"] + 1) * BLOCK] = np.frombuffer(r["data"]).reshape(BLOCK, BLOCK)
    return out[:n_cols, :n_cols]


def norm2(gram: DataFrame) -> float:
    """The sum of the squares of all entries of X'X."""

    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([sum(float((np.frombuffer(d) ** 2).sum()) for b in batches for d in b.column(2).to_pylist())])], names=["s"])

    return float(gram.mapInArrow(run, "s double").agg(F.sum("s")).first()[0] or 0.0)
