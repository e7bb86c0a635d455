"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemscope.session import ensure_checkpoint_dir, prepare

#: ASCII white space, the separators of a "word" in these operators.
SPACES = " \t\n\x0b\f\r"
#: Arrow batches handed to Python tasks stay near this size, whatever the length of the texts.
BATCH_BYTES = 16 * 1024 * 1024


def ready(spark: SparkSession) -> SparkSession:
    """Package, settings and batch sizes for the operators' Python tasks."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage, survives lost executors, and keeps only compressed columns."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str | Column, prefix: str = "") -> list[Column]:
    """Two independent 64-bit hashes of a text: together they stand for it in joins."""
    c = F.col(text) if isinstance(text, str) else text
    return [F.xxhash64(c).alias(f"{prefix}k1"), F.xxhash64(F.lit(1), c).alias(f"{prefix}k2")]


def word_windows(data: bytes, overlap: int, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The white-space separated words of ``data`` in consecutive lists.

    Every list but the first starts with the last ``overlap`` words of the one
    before, so a window of overlap + 1 words lies in exactly one list. A list
    covers about ``size`` bytes: a text of any length needs bounded memory."""
    if len(data) <= size:
        yield data.split()
        return
    tail: list[bytes] = []
    rest = b""
    for lo in range(0, len(data), size):
        chunk = rest + data[lo:lo + size]
        last = lo + size >= len(data)
        words = chunk.split()
        rest = b""
        if not last and words and not chunk[-1:].isspace():
            rest = words.pop()
        words = tail + words
        if last or len(words) > 4 * overlap:
            yield words
            tail = words[len(words) - overlap:] if overlap else []
        else:
            tail = words


#: A join side measured to be at most this many bytes is broadcast; a greater one shuffles.
BROADCAST_BYTES = 32 * 1024 * 1024


def join_measured(left: DataFrame, right: DataFrame, on: list[str], how: str, width: Column | None = None,
                  limit: int = BROADCAST_BYTES) -> DataFrame:
    """``left.join(right)`` where ``right`` is a saved table: it is broadcast if
    its rows, ``width`` bytes each (64 by default), stay under the limit; beyond
    it both sides shuffle. The result is the same."""
    w = F.lit(64) if width is None else width
    size = right.agg(F.coalesce(F.sum(w), F.lit(0))).first()[0]
    return left.join(F.broadcast(right) if size <= limit else right, on, how)


class Recent:
    """What a Python worker remembers from batch to batch and from task to task: about ``size`` entries. When one half is
    full, what was not asked for since the last time is forgotten; it changes no result."""

    def __init__(self):
        self.now: dict = {}
        self.before: dict = {}

    def missing(self, keys: set, size: int) -> set:
        """The keys that ``now`` has to be given; it holds the others until the next call."""
        new = keys.difference(self.now)
        if 2 * (len(self.now) + len(new)) > size:
            self.before, self.now, new = self.now, {}, keys
        before = self.before
        kept = {k: before[k] for k in new if k in before}
        self.now.update(kept)
        return new.difference(kept)
