"""TF-IDF in long form.

Rules (the reference's vectoriser): lower case; tokens are runs of two or
more word characters; stop words dropped; vocabulary = terms in at least
``min_df`` documents, the ``max_features`` most frequent by total corpus
count (ties alphabetical), indexed alphabetically; idf = ln((1+n)/(1+df)) + 1
(smoothed, with the +1 Spark's ``IDF`` lacks); weight = count * idf, then
every document row scaled to unit L2 norm.

Plan: tokenise (narrow), count (doc, term) (shuffle on both keys, so a hot
document spreads over its terms), document frequencies (shuffle on term with
map-side combine), top-``max_features`` vocabulary (bounded: a broadcast of
at most ``max_features`` rows), one window per document for the norm
(bounded by the vocabulary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from itemscope.functions.stopwords import ENGLISH

# Fixed value: a token is a run of at least two letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(corpus: DataFrame, id_col: str, text_col: str, pattern: str = TOKEN_PATTERN,
           stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """(id, term) for every token of every document (whole texts)."""
    stop = ENGLISH if stop_words is None else stop_words
    t = corpus.select(id_col, F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(pattern), F.lit(0)))
                      .alias("term"))
    return t.filter(~F.col("term").isin(list(stop))) if stop else t


def term_counts(corpus: DataFrame, id_col: str, text_col: str, **kw) -> DataFrame:
    return tokens(corpus, id_col, text_col, **kw).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(tf: DataFrame, id_col: str, n_docs: DataFrame, max_features: int = 5000, min_df: int = 2) -> DataFrame:
    """(term, term_idx, df, idf); at most ``max_features`` rows."""
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    top = stats.filter(F.col("df") >= min_df).orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    idx = F.row_number().over(Window.orderBy("term")) - 1
    n = n_docs.select("n_docs").scalar()
    return top.select("term", idx.cast("int").alias("term_idx"), F.col("df").cast("bigint").alias("df"),
                      (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"))


def tfidf(parts: DataFrame, id_col: str, text_col: str, max_features: int = 5000, min_df: int = 2,
          stop_words: tuple[str, ...] | None = None, all_ids: DataFrame | None = None,
          materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """Return (weights, vocabulary): weights = (id, term_idx, term, weight) for
    the non-zero entries; documents without vocabulary terms have no rows.

    ``parts`` may hold several text rows per document (e.g. a title and each
    distinct tag): a token never spans the blank that would join them, so the
    counts equal those of the joined text, without building one long string
    per document. ``all_ids`` lists every document (for n); default: the ids
    present in ``parts``. ``materialize`` writes the (id, term, count) table
    once to the checkpoint folder: both the vocabulary and the weights read it,
    so the corpus is tokenised one time."""
    tf = term_counts(parts, id_col, text_col, stop_words=stop_words)
    if materialize:
        from itemscope.session import stored
        tf = stored(tf, "term-counts")
    ids = all_ids if all_ids is not None else parts.select(id_col).distinct()
    n_docs = ids.agg(F.count(F.lit(1)).cast("double").alias("n_docs"))
    vocab = vocabulary(tf, id_col, n_docs, max_features, min_df)
    raw = tf.join(F.broadcast(vocab), "term").select(id_col, "term_idx", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term_idx", "term", (F.col("w") / norm).alias("weight")), vocab
