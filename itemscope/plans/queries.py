"""The registered queries: one per inventory item of the blueprint.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables of that folder. Results pass through ``present`` (rounded doubles,
lists as text) so they compare with the SQL twins in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemscope.operators import encoded as EN
from itemscope.operators import features as FE
from itemscope.plans.context import Tables
from itemscope.plans.present import present

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(Tables(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# --- phase 1: minimum slice ---------------------------------------------------

@query("rating_features")
def rating_features(t: Tables) -> DataFrame:
    """A3 per-item rating statistics on clean interactions."""
    return FE.rating_stats(t.ratings_clean)


@query("rating_features_script")
def rating_features_script(t: Tables) -> DataFrame:
    """A2/F2 with exact median and span in days."""
    return FE.rating_stats_script(t.ratings_clean)


# --- phase 2: cleaning --------------------------------------------------------------

@query("clean_catalog")
def clean_catalog(t: Tables) -> DataFrame:
    return t.catalog


@query("clean_interactions")
def clean_interactions(t: Tables) -> DataFrame:
    return t.ratings_clean


@query("clean_tags")
def clean_tags(t: Tables) -> DataFrame:
    return t.tags_clean


@query("item_categories")
def item_categories(t: Tables) -> DataFrame:
    return t.item_genres


# --- phase 4: features -----------------------------------------------------------------

@query("tag_features")
def tag_features(t: Tables) -> DataFrame:
    """A4 with the X9 token rule."""
    return FE.tag_stats(t.tags_clean)


@query("feature_frame")
def feature_frame(t: Tables) -> DataFrame:
    """F6, the flagship: 17 columns, one row per catalog item."""
    return t.feature_frame


@query("sanity_checks")
def sanity_checks(t: Tables) -> DataFrame:
    return FE.sanity_checks(t.feature_frame)


# --- phase 3: profile and audit --------------------------------------------------------

from itemscope.operators import clean as CL  # noqa: E402
from itemscope.operators import onepass as OP
from itemscope.operators import profile as PR  # noqa: E402
from itemscope.roles import ALL_TABLES  # noqa: E402


def _raw(t: Tables) -> dict[str, DataFrame]:
    return {name: t.raw(name) for name in ALL_TABLES}


def _clean(t: Tables) -> dict[str, DataFrame]:
    return {"catalog": t.catalog, "ratings_clean": t.ratings_clean,
            "tags_clean": t.tags_clean, "item_genres": t.item_genres}


#: The names the cleaned tables are stored and reported under.
STORED_NAMES = {"catalog": "movies_catalog", "ratings_clean": "ratings_clean", "tags_clean": "tags_clean",
                "item_genres": "movie_genres"}


def _stored(t: Tables) -> dict[str, DataFrame]:
    return {STORED_NAMES[k]: df for k, df in _clean(t).items()}


@query("table_shapes")
def table_shapes(t: Tables) -> DataFrame:
    """Q1: rows and columns of every input table."""
    return PR.table_shapes(_raw(t))


@query("load_summary")
def load_summary(t: Tables) -> DataFrame:
    """Rows and columns of the cleaned tables."""
    return PR.table_shapes(_stored(t), core=tuple(STORED_NAMES.values()))


@query("missing_profile")
def missing_profile(t: Tables) -> DataFrame:
    return PR.missing_profile(_raw(t))


@query("missing_nonzero")
def missing_nonzero(t: Tables) -> DataFrame:
    return PR.missing_nonzero(_raw(t))


@query("quality_checks")
def quality_checks(t: Tables) -> DataFrame:
    return PR.quality_checks(_raw(t))


@query("duplicate_members_single")
def duplicate_members_single(t: Tables) -> DataFrame:
    """A10 on a single key: catalog items in the raw interactions table."""
    from itemscope.operators.aggregates import duplicate_members
    return duplicate_members(t.ratings, ["movieId"])


@query("duplicate_members_composite")
def duplicate_members_composite(t: Tables) -> DataFrame:
    from itemscope.operators.aggregates import duplicate_members
    return duplicate_members(t.ratings, ["userId", "movieId"])


@query("duplicate_members_fullrow")
def duplicate_members_fullrow(t: Tables) -> DataFrame:
    from itemscope.operators.aggregates import duplicate_members
    return duplicate_members(t.tags)


@query("join_coverage")
def join_coverage(t: Tables) -> DataFrame:
    return PR.join_coverage(_raw(t))


@query("orphan_keys")
def orphan_keys(t: Tables) -> DataFrame:
    """Q12 after cleaning."""
    return PR.orphan_check(_clean(t))


@query("scale_metrics")
def scale_metrics(t: Tables) -> DataFrame:
    return PR.scale_metrics(t.ratings)


@query("score_distribution")
def score_distribution(t: Tables) -> DataFrame:
    return PR.score_distribution(t.ratings)


@query("top_categories_raw")
def top_categories_raw(t: Tables) -> DataFrame:
    return PR.top_categories_raw(t.movies, 15)


@query("event_time_range")
def event_time_range(t: Tables) -> DataFrame:
    return PR.event_time_range(t.ratings)


@query("data_dictionary")
def data_dictionary(t: Tables) -> DataFrame:
    return PR.data_dictionary(t.spark, _raw(t))


@query("processed_dictionary")
def processed_dictionary(t: Tables) -> DataFrame:
    return PR.processed_dictionary(_stored(t))


@query("rows_before_after")
def rows_before_after(t: Tables) -> DataFrame:
    return PR.rows_before_after(_raw(t), _clean(t))


@query("uniqueness_report")
def uniqueness_report(t: Tables) -> DataFrame:
    """Q13 in report mode: duplicates left after cleaning (never raises)."""
    return CL.uniqueness_report([("movies_catalog", t.catalog, ["movieId"]),
                                 ("ratings_clean", t.ratings_clean, ["userId", "movieId"])])


# --- phase 4: vocabularies, scaling, model matrix, script features ----------------------


def _spec(t: Tables) -> FE.ModelSpec:
    return FE.model_spec(t.item_genres, t.item_tokens_saved)


@query("category_vocab")
def category_vocab(t: Tables) -> DataFrame:
    """top-20 categories by item count."""
    return FE.category_vocab(t.item_genres, 20)


@query("tag_vocab")
def tag_vocab(t: Tables) -> DataFrame:
    """F8 + WN3: top-20 tokens by item frequency with feature names."""
    return FE.tag_vocab(FE.item_tokens(t.tags_clean, t.catalog), 20)


@query("scaling_stats")
def scaling_stats(t: Tables) -> DataFrame:
    return FE.scaling_stats(t.feature_frame)


@query("model_matrix")
def model_matrix(t: Tables) -> DataFrame:
    """F10 wide (column names depend on the vocabularies: rows-only check)."""
    return FE.model_matrix(t.model_frame_saved, _spec(t), t.item_genres, t.item_tokens_saved)


@query("model_matrix_long")
def model_matrix_long(t: Tables) -> DataFrame:
    return FE.model_matrix_long(t.model_frame_saved, t.item_genres, t.item_tokens_saved, _spec(t))


@query("feature_catalog")
def feature_catalog(t: Tables) -> DataFrame:
    return FE.feature_catalog(t.spark, _spec(t))


@query("feature_profile")
def feature_profile(t: Tables) -> DataFrame:
    spec = _spec(t)
    return FE.feature_profile(t.model_frame_saved, spec)


@query("category_pivot")
def category_pivot(t: Tables) -> DataFrame:
    """F1/A12 (one column per category value: rows-only check)."""
    return FE.category_pivot(t.item_genres, FE.category_values(t.item_genres))


@query("tag_text")
def tag_text(t: Tables) -> DataFrame:
    return FE.tag_text(t.tags_clean)


@query("text_corpus")
def text_corpus(t: Tables) -> DataFrame:
    return FE.text_corpus(t.catalog, FE.tag_text(t.tags_clean))


@query("numeric_feature_matrix")
def numeric_feature_matrix(t: Tables) -> DataFrame:
    """rated items only (one column per category value: rows-only check)."""
    return FE.numeric_feature_matrix(t.ratings_clean, t.item_genres, t.tags_clean,
                                     FE.category_values(t.item_genres))


# --- phase 5: PCA -------------------------------------------------------------------------

from itemscope.operators import decomposition as DC  # noqa: E402


def _notebook_pca(t: Tables) -> tuple[FE.ModelSpec, DC.PCAFit]:
    spec = _spec(t)
    mat = FE.model_matrix(t.model_frame_saved, spec, t.item_genres, t.item_tokens_saved) \
        .select("movieId", "title", *spec.feature_columns)
    return spec, DC.fit_pca(mat, spec.feature_columns)


def _script_pca(t: Tables) -> tuple[list[str], DC.PCAFit, int]:
    nm = FE.numeric_feature_matrix(t.ratings_clean, t.item_genres, t.tags_clean,
                                   FE.category_values(t.item_genres))
    cols = [c for c in nm.columns if c != "movieId"]
    fit = DC.fit_pca(nm, cols)
    return cols, fit, fit.components_for(0.9, strict=True)


@query("standardized_matrix")
def standardized_matrix(t: Tables) -> DataFrame:
    """M2: z-scores (ddof 0, zero std -> 1) of the model matrix, long form."""
    spec, fit = _notebook_pca(t)
    z = fit.matrix.select("movieId", *DC.standardized_columns(fit.features, fit.means, fit.stds))
    return z.select("movieId", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in fit.features
    ])).alias("kv")).select("movieId", "kv.feature", "kv.value")


@query("correlation_matrix")
def correlation_matrix(t: Tables) -> DataFrame:
    """Pearson correlation of every feature pair (NULL for constant features)."""
    _, fit = _notebook_pca(t)
    return DC.correlation_long(t.spark, fit)


@query("pca_summary")
def pca_summary(t: Tables) -> DataFrame:
    _, fit = _notebook_pca(t)
    return DC.variance_table(t.spark, fit)


@query("pca_thresholds")
def pca_thresholds(t: Tables) -> DataFrame:
    _, fit = _notebook_pca(t)
    return DC.thresholds_table(t.spark, fit)


@query("pca_profile")
def pca_profile(t: Tables) -> DataFrame:
    _, fit = _notebook_pca(t)
    return DC.pca_profile(t.spark, fit)


@query("pca_scores")
def pca_scores(t: Tables) -> DataFrame:
    """M6: pc1..pc3 per item (0.0 beyond the number of features)."""
    _, fit = _notebook_pca(t)
    return DC.pca_scores(fit, ["movieId", "title"], 3, pad_to=3)


@query("reconstruction_error")
def reconstruction_error(t: Tables) -> DataFrame:
    _, fit = _notebook_pca(t)
    return DC.reconstruction_error(t.spark, fit)


@query("top_loadings")
def top_loadings(t: Tables) -> DataFrame:
    _, fit = _notebook_pca(t)
    return DC.top_loadings(t.spark, fit, 12)


@query("loading_magnitude")
def loading_magnitude(t: Tables) -> DataFrame:
    _, fit = _notebook_pca(t)
    return DC.loading_magnitude(t.spark, fit, 5)


@query("feature_redundancy")
def feature_redundancy(t: Tables) -> DataFrame:
    _, fit = _notebook_pca(t)
    return DC.feature_redundancy(t.spark, fit)


@query("scree_points")
def scree_points(t: Tables) -> DataFrame:
    """The first min(50, p) components of the spectrum."""
    _, fit = _notebook_pca(t)
    return DC.variance_table(t.spark, fit, k=min(50, fit.p))


@query("scatter_sample")
def scatter_sample(t: Tables) -> DataFrame:
    """M17 + O4: seeded sample of min(10000, n) items: pc1, pc2, pc3, log1p(rating_count)."""
    _, fit = _notebook_pca(t)
    scores = DC.pca_scores(fit, ["movieId"], 3, pad_to=3)
    counts = t.model_frame_saved.select("movieId", F.log1p(F.col("rating_count").cast("double")).alias("rating_count"))
    return DC.scatter_sample(scores.join(counts, "movieId"), "movieId", 10000, 42)


@query("pca_target_variance")
def pca_target_variance(t: Tables) -> DataFrame:
    """M3: PCA of the script's numeric matrix keeping > 90 % of the variance."""
    _, fit, k = _script_pca(t)
    return DC.variance_table(t.spark, fit, k=k, cumulative_name="cumulative_variance")


@query("pca_target_scores")
def pca_target_scores(t: Tables) -> DataFrame:
    _, fit, k = _script_pca(t)
    return DC.pca_scores(fit, ["movieId"], k)


@query("pca_target_error")
def pca_target_error(t: Tables) -> DataFrame:
    """M9: mean squared error per cell of the > 90 % reconstruction."""
    _, fit, k = _script_pca(t)
    return DC.reconstruction_error(t.spark, fit, [k]).select("components", "mse")


# --- phase 6: TF-IDF, truncated SVD, comparison -------------------------------------------

from itemscope.operators import svd as SV  # noqa: E402
from itemscope.operators import text as TX  # noqa: E402

MAX_FEATURES, MIN_DF = 5000, 2


def _corpus(t: Tables) -> DataFrame:
    return FE.text_corpus(t.catalog, FE.tag_text(t.tags_clean))


def _text_parts(t: Tables) -> DataFrame:
    """The corpus of F4 as parts: each title and each distinct (item, tag) of the catalog's items."""
    titles = t.catalog.select("movieId", F.col("title").alias("text"))
    tags = t.tags_clean.select("movieId", F.col("tag").alias("text")).distinct()
    # the catalog's keys are hashed, so that the pairs need not be sorted to meet them; the titles are dealt like
    # the tags' items, so that the terms of an item are counted where they are
    return FX.spread_before_explode(titles, "movieId").unionByName(tags.join(titles.select("movieId").distinct().hint("shuffle_hash"), "movieId", "left_semi"))


def _tfidf(t: Tables) -> tuple[DataFrame, DataFrame]:
    return TX.tfidf(_text_parts(t), "movieId", "text", MAX_FEATURES, MIN_DF, all_ids=t.catalog.select("movieId"))


def _svd(t: Tables):
    """TF-IDF partitioned by item and checkpointed once, then
    k = min(200, vocabulary - 1) (1 if the vocabulary has at most one term)."""
    weights, _ = _tfidf(t)
    x = SV.prepare(weights.select("movieId", F.col("term_idx").alias("col_idx"), F.col("weight").alias("value")),
                   "movieId")
    n_cols = (x.agg(F.max("col_idx")).first()[0] or 0) + 1
    ids = t.catalog.select("movieId")
    n_rows = ids.count()
    k = min(200, n_cols - 1) if n_cols > 1 else 1
    fit = SV.truncated_svd(x, "movieId", n_rows, max(n_cols, 1), k)
    return fit, SV.embeddings(x, "movieId", ids, fit)


@query("tfidf_long")
def tfidf_long(t: Tables) -> DataFrame:
    """M1: non-zero TF-IDF weights (item, term index, term, weight)."""
    return _tfidf(t)[0]


@query("tfidf_vocab")
def tfidf_vocab(t: Tables) -> DataFrame:
    """The vocabulary with document frequency and idf."""
    return _tfidf(t)[1]


@query("svd_variance")
def svd_variance(t: Tables) -> DataFrame:
    """Explained variance ratio of every kept SVD component."""
    fit, _ = _svd(t)
    ratio = fit.explained_variance_ratio
    rows = [(j + 1, float(ratio[j]), float(ratio[: j + 1].sum())) for j in range(fit.k)]
    return t.spark.createDataFrame(rows, "component int, explained_variance_ratio double, cumulative_variance double")


@query("svd_embeddings")
def svd_embeddings(t: Tables) -> DataFrame:
    """U * Sigma for every item of the corpus."""
    return _svd(t)[1]


@query("svd_reconstruction_error")
def svd_reconstruction_error(t: Tables) -> DataFrame:
    """Squared error per row (closed form)."""
    fit, _ = _svd(t)
    return t.spark.createDataFrame([(fit.k, SV.reconstruction_error_per_row(fit))],
                                   "components int, error_per_row double")


def _comparison_rows(t: Tables):
    _, pfit, pk = _script_pca(t)
    sfit, _ = _svd(t)
    pca_err = float(pfit.tail_variance(pk) / pfit.p)
    return pfit, pk, sfit, pca_err, SV.reconstruction_error_per_row(sfit)


@query("method_comparison")
def method_comparison(t: Tables) -> DataFrame:
    """M12, with the unit of each error named."""
    pfit, pk, sfit, pca_err, svd_err = _comparison_rows(t)
    rows = [("PCA", pk, float(pfit.cumulative[pk - 1]), pca_err, "mean squared error per cell"),
            ("TruncatedSVD", sfit.k, float(sfit.explained_variance_ratio.sum()), svd_err,
             "squared error per row")]
    return t.spark.createDataFrame(rows, "method string, components int, cumulative_variance double, "
                                         "reconstruction_error double, error_unit string")


@query("run_summary")
def run_summary(t: Tables) -> DataFrame:
    """Sizes, components, variance and errors of the representation run."""
    pfit, pk, sfit, pca_err, svd_err = _comparison_rows(t)
    rows = [("numeric_features", "rows", float(pfit.n)), ("numeric_features", "columns", float(pfit.p + 1)),
            ("text_features", "rows", float(sfit.n_rows)), ("text_features", "columns", float(sfit.n_cols)),
            ("pca", "components", float(pk)), ("pca", "cumulative_variance", float(pfit.cumulative[pk - 1])),
            ("svd", "components", float(sfit.k)),
            ("svd", "cumulative_variance", float(sfit.explained_variance_ratio.sum())),
            ("reconstruction_error", "pca", pca_err), ("reconstruction_error", "svd", svd_err)]
    return t.spark.createDataFrame(rows, "section string, metric string, value double")


# --- sources, sizes and nested reports ------------------------------------------------------

from itemscope.operators import reports as RP  # noqa: E402
from itemscope.sources import fixtures as FX  # noqa: E402
from itemscope.sources import readers as RD  # noqa: E402


def _sizes(t: Tables) -> DataFrame:
    paths = FX.role_source_paths(t.sf_dir)
    RD.preflight(t.spark, {f"{r}/{i}": p for r, ps in paths.items() for i, p in enumerate(ps)})
    return RD.input_sizes(t.spark, paths)


@query("table_memory_estimate")
def table_memory_estimate(t: Tables) -> DataFrame:
    """Q1 complete: rows, columns, size and scope per input table."""
    return PR.table_shapes(_raw(t)).join(F.broadcast(_sizes(t)), "table") \
        .select("table", "rows", "cols", "size_mb", "scope")


@query("profile_report")
def profile_report(t: Tables) -> DataFrame:
    """Q16 (+ Q18): the nested profile summary, one row. Every table is scanned once for its facts and
    once more, narrow, for the keys that relations share; movies a third time for its categories."""
    raw = _raw(t)
    known = OP.facts(raw)
    shapes = OP.shapes(raw, known).join(F.broadcast(_sizes(t)), "table").select("table", "rows", "cols", "size_mb", "scope")
    missing = OP.missing(raw, known).filter(F.col("null_count") > 0)
    return RP.profile_report(t.spark, shapes, missing, OP.checks(known), OP.coverage(raw), OP.scale(known), shapes,
                             OP.distribution(known), PR.top_categories_raw(t.movies, 15))


@query("cleaning_report")
def cleaning_report(t: Tables) -> DataFrame:
    """Q15: input tables, row changes, join checks, decisions, outputs; one row."""
    raw = {k: t.raw(k) for k in ("ratings", "movies", "tags", "links")}
    inputs = PR.table_shapes(raw).join(F.broadcast(_sizes(t)), "table").select("table", "rows", "size_mb")
    return RP.cleaning_report(t.spark, inputs, PR.rows_before_after(_raw(t), _clean(t)), PR.orphan_check(_clean(t)),
                              list(_stored(t)))


# --- extra shapes of the same operators -----------------------------------------------------


@query("tag_features_events")
def tag_features_events(t: Tables) -> DataFrame:
    """A4 on the small-vocabulary tag role (events): a handful of tags, each
    holding a large share of all rows - the hot-key case of the tag plan."""
    return FE.tag_stats(CL.clean_tags(t.tags_events))


def _genome_pca(t: Tables) -> DC.PCAFit:
    index = DC.column_index(t.genome_tags, "tagId")
    cells = t.genome_scores.filter(F.col("relevance").isNotNull()).groupBy("movieId", "tagId").agg(F.max("relevance").alias("value"))
    n_rows = t.genome_scores.select("movieId").distinct().count()
    return DC.fit_pca_long(cells.join(F.broadcast(index), "tagId").select("movieId", "col_idx", "value"), "movieId", index.count(), n_rows)


@query("genome_pca_summary")
def genome_pca_summary(t: Tables) -> DataFrame:
    """M4 on the item x tag relevance matrix (genome scores), from its long form."""
    return DC.variance_table(t.spark, _genome_pca(t))


# --- certificates: what SQL can say of a spectrum --------------------------------------------


def _metrics(t: Tables, rows: list[tuple[str, float]]) -> DataFrame:
    return t.spark.createDataFrame(rows, "metric string, value double")


@query("genome_pca_certificate")
def genome_pca_certificate(t: Tables) -> DataFrame:
    """M4 on the genome matrix: traces of powers of its correlation matrix, residuals."""
    return _metrics(t, DC.certificate(_genome_pca(t)))


@query("pca_certificate")
def pca_certificate(t: Tables) -> DataFrame:
    """M3-M8 on the model matrix: spectrum, scores and errors."""
    _, fit = _notebook_pca(t)
    return _metrics(t, DC.certificate(fit) + DC.score_certificate(fit, 3))


@query("pca_target_certificate")
def pca_target_certificate(t: Tables) -> DataFrame:
    """M3, M6, M9 on the script's numeric matrix, with the components kept for > 90 %."""
    _, fit, k = _script_pca(t)
    return _metrics(t, DC.certificate(fit) + DC.score_certificate(fit, k))


@query("svd_certificate")
def svd_certificate(t: Tables) -> DataFrame:
    """Norms of the TF-IDF matrix and its X'X, residuals of triplets, embeddings and error."""
    import numpy as np
    from itemscope.operators import gram as GR
    fit, emb = _svd(t)
    v, sq = fit.components.T, fit.singular_values ** 2
    columns = [F.col(c) for c in emb.columns if c != "movieId"]
    kept = float(emb.agg(F.sum(sum((c * c for c in columns), F.lit(0.0)))).first()[0] or 0.0)
    error = SV.reconstruction_error_per_row(fit)
    return _metrics(t, [
        ("items", float(fit.n_rows)), ("terms", float(fit.n_cols)), ("components", float(fit.k)), ("norm2", fit.frob2), ("gram_norm2", GR.norm2(fit.gram)),
        ("triplet_residual", round(float(np.abs(GR.times(fit.gram, v) - v * sq).max() / max(float(sq.max()), 1e-300)), 3)),
        ("orthogonality_residual", float(np.abs(v.T @ v - np.eye(fit.k)).max())),
        ("embedding_residual", abs(kept - float(sq.sum()))), ("error_residual", abs(error * fit.n_rows + float(sq.sum()) - fit.frob2))])


# --- long forms whose columns do not depend on the data -----------------------------------------


@query("category_counts_long")
def category_counts_long(t: Tables) -> DataFrame:
    """A12 in long form: how often a category stands on an item (the non-zero pivot cells)."""
    from itemscope.operators.aggregates import group_count
    return group_count(t.item_genres, ["movieId", "genre"], "n")


def _numeric_cells(t: Tables) -> DataFrame:
    stats = FE.rating_stats_script(t.ratings_clean)
    names = [c for c in stats.columns if c != "movieId"]
    cells = stats.select("movieId", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value")) for c in names
    ])).alias("kv")).select("movieId", "kv.feature", "kv.value")
    counts = t.item_genres.groupBy("movieId", F.concat(F.lit("genre_"), "genre").alias("feature")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    tags = t.tags_clean.groupBy("movieId").agg(F.count(F.lit(1)).cast("double").alias("value")) \
        .select("movieId", F.lit("tag_count").alias("feature"), "value")
    return cells.unionByName(counts.unionByName(tags).join(stats.select("movieId"), "movieId", "left_semi"))


@query("numeric_features_long")
def numeric_features_long(t: Tables) -> DataFrame:
    """F5 in long form: (item, feature, value) of rated items, zero counts left out."""
    return _numeric_cells(t)


@query("category_vectors")
def category_vectors(t: Tables) -> DataFrame:
    """A12/F1 without a collected vocabulary: an item's category counts as one encoded vector."""
    cells = t.item_genres.groupBy("movieId", "genre").agg(F.count(F.lit(1)).alias("n"))
    return EN.encoded_vectors(cells, EN.vocabulary(cells, "genre"), "movieId", "genre", "n")


@query("numeric_feature_vectors")
def numeric_feature_vectors(t: Tables) -> DataFrame:
    """F5 without a collected vocabulary: the encoded vectors of rated items, decoded through the vocabulary table."""
    cells = _numeric_cells(t).checkpoint()
    vocab = EN.vocabulary(cells)
    return EN.decoded(EN.encoded_vectors(cells, vocab, "movieId"), vocab, "movieId")


@query("redundancy_check")
def redundancy_check(t: Tables) -> DataFrame:
    """M15 (X19, X20): correlation and label; the angle is held against the difference of the
    loadings' directions, taken by atan2, and the residual is 0."""
    _, fit = _notebook_pca(t)
    loads = DC.loadings_long(t.spark, fit, 2).groupBy("feature").agg(
        *[F.sum(F.when(F.col("component") == c, F.col("loading"))).alias(c) for c in ("pc1", "pc2")])
    way = loads.select("feature", F.degrees(F.atan2("pc2", "pc1")).alias("way"))
    found = DC.feature_redundancy(t.spark, fit)
    for side in ("a", "b"):
        found = found.join(way.select(F.col("feature").alias(f"feature_{side}"), F.col("way").alias(f"way_{side}")), f"feature_{side}")
    turn = F.abs(F.col("way_a") - F.col("way_b"))
    between = F.when(turn > 180, 360 - turn).otherwise(turn)
    return found.select("feature_a", "feature_b", "check", "correlation", "label",
                        F.round(F.abs(F.col("angle_deg") - between), 1).alias("angle_residual"))


@query("redundancy_correlation")
def redundancy_correlation(t: Tables) -> DataFrame:
    """The correlation part of the redundancy check."""
    _, fit = _notebook_pca(t)
    return DC.feature_redundancy(t.spark, fit).select("feature_a", "feature_b", "check", "correlation")


@query("scatter_sample_by_md5")
def scatter_sample_by_md5(t: Tables) -> DataFrame:
    """O4 on a hash that other engines have: min(10000, n) items, the first by
    md5 of the item and the seed, with log1p(rating_count) (the limit is the feature)."""
    frame = FE.rating_stats(t.ratings_clean).select("movieId", F.log1p(F.col("rating_count").cast("double")).alias("rating_count"))
    key = F.md5(F.concat_ws(":", F.col("movieId").cast("string"), F.lit("42")).cast("binary"))
    return frame.orderBy(key, "movieId").limit(10000)


@query("table_memory_rows")
def table_memory_rows(t: Tables) -> DataFrame:
    """Q1: the counted part of the memory estimate."""
    return table_memory_estimate(t).drop("size_mb")
