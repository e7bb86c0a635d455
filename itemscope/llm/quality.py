"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document. The ledger keeps the measurements
and one integer whose bit ``i`` is set when rule ``i`` fails. A policy is a
versioned set of rules; applying it, comparing versions or asking what a rule
alone costs (an ablation) are bitwise operations on that integer and never
look at a text again.

Plan: one narrow projection over the texts, no shuffle. An ablation shuffles
at most 2^rules partial counts per task.

Defined results: a null text has no words; an empty table gives an empty
ledger; repeated rows give repeated ledger rows; other columns of the input
are ignored by ``ledger`` and kept by ``keep``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemscope.llm.common import SPACES

WINDOW = 5
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
SPACE_CLASS = r"[\x20\x09-\x0D]+"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")

#: Rules in bit order: name -> the condition under which a document fails.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 4 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("shouting", "2 * n_upper > word_chars"),
)
BIT = {name: i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version and the rules that reject a document under it."""
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return reduce(lambda m, r: m | (1 << BIT[r]), self.rules, 0)


BASE = Policy(1, ("few_words", "repeated_windows"))
FULL = Policy(2, tuple(name for name, _ in RULES))


def _repeat_words(df: DataFrame, words: str) -> DataFrame:
    """Adds ``n_repeat_words``: words inside a window of WINDOW words that occurs twice or more.

    Most texts repeat no window: their distinct window hashes are as many as
    the windows. Only for the others the windows are sorted by (hash, place),
    equal neighbours are taken and the union of their spans is added up."""
    n_windows = F.size(words) - (WINDOW - 1)
    places = F.when(n_windows > 0, F.sequence(F.lit(0), n_windows - 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_h", F.transform(places, lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(WINDOW)])))
    df = df.withColumn("_p", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: ((x["h"] == F.get(F.col("_p"), k - 1)["h"]) | (x["h"] == F.get(F.col("_p"), k + 1)["h"]))
    df = df.withColumn("_r", F.sort_array(F.transform(
        F.filter("_p", lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"])))
    steps = F.transform("_r", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_r"), k + 1) - x, F.lit(WINDOW))))
    total = F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("bigint"))).drop("_h", "_p", "_r")


def _length_without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measure(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``carry`` and the measurements of every row's whole text."""
    df = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    bare = F.btrim("_t", F.lit(SPACES))
    df = df.withColumn("_w", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS)))
    df = df.withColumn("_l", F.filter(F.split("_t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    df = _repeat_words(df, "_w")
    return df.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.translate("_t", SPACES, "")).cast("bigint").alias("word_chars"),
        _length_without(F.col("_t"), SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_l").cast("bigint").alias("n_lines"),
        _length_without(F.col("_t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ").cast("bigint").alias("n_upper"),
    )


def ledger(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``carry``, the measurements, ``failures`` (bit i: rule i fails)."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, rule) in enumerate(RULES)]
    return measure(docs, text, carry).withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits))


def passes(policy: Policy, failures: str = "failures") -> Column:
    """True where no rule of the policy fails."""
    return F.col(failures).bitwiseAND(F.lit(policy.mask)) == 0


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """What every rule of a policy costs, from the ledger alone.

    (version, rule, failed: documents the rule rejects, only_this: documents
    kept again without it, kept: documents the whole policy keeps)."""
    by_mask = entries.groupBy(F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << BIT[r]).alias("bit")) for r in policy.rules])
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")
    return by_mask.select("m", "n", F.explode(rules).alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        total(F.col("m").bitwiseAND(F.col("r.bit")) != 0).alias("failed"),
        total(F.col("m") == F.col("r.bit")).alias("only_this"),
        total(F.col("m") == 0).alias("kept"),
    ).select(F.lit(policy.version).alias("version"), "rule", "failed", "only_this", "kept")


def keep(docs: DataFrame, policy: Policy = FULL, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that pass the policy."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    back = [F.col(a).alias(b) for a, b in zip(names, docs.columns)]
    entries = ledger(docs.toDF(*names), names[docs.columns.index(text)], tuple(names))
    # the optimiser would move the filter below the ledger and evaluate the measurements anew
    # inside each other; it does not move one that reads a row's number
    entries = entries.withColumn("_row", F.monotonically_increasing_id())
    return entries.filter((F.col("_row") >= 0) & passes(policy)).select(*back)
