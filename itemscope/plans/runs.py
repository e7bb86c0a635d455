"""The two runs a user comes for, from files to files.

``clean_run``: raw CSV files -> cleaned, guarded tables, data dictionary, report.
``features_run``: cleaned tables -> feature tables, TF-IDF, PCA and SVD outputs, summary.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemscope.functions import scalars as X
from itemscope.operators import clean as CL
from itemscope.operators import decomposition as DC
from itemscope.operators import features as FE
from itemscope.operators import profile as PR
from itemscope.operators import reports as RP
from itemscope.operators import svd as SV
from itemscope.operators import text as TX
from itemscope.roles import DEFAULT_ROLES, RAW_SCHEMAS, Roles, first_available
from itemscope.session import ensure_checkpoint_dir, prepare
from itemscope.sources import readers as RD
from itemscope.sources import writers as WR

CLEANED = ("movies_catalog", "ratings_clean", "tags_clean", "movie_genres")


def clean_run(spark: SparkSession, inputs: dict[str, str], out: str, guard: str = "raise",
              decisions: list[str] = ()) -> dict[str, DataFrame]:
    """Read the raw CSV files (``inputs``: role -> path for movies, ratings, tags and
    links), clean them, check the keys and write everything under ``out``.

    Cells are read as text and cast leniently, so a bad cell drops its row instead
    of failing the run. With ``guard="raise"`` duplicate keys end the run before
    anything is written under ``out``; with ``"report"`` they are only counted. ``decisions`` go
    into the report as the caller words them.

    Every CSV is parsed once and every cleaning rule evaluated once: raw and cleaned rows are
    landed as parquet in a folder of this run under ``spark.checkpoint.dir``, guards and counts read
    only the columns they need there, and publishing copies the landed rows, sorted inside files.
    The folder is removed when the run ends, also by an error."""
    prepare(spark)
    RD.preflight(spark, inputs)
    stage = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clean-run-{uuid.uuid4().hex}"

    def landed(df: DataFrame, name: str) -> DataFrame:
        WR.write_table(df, f"{stage}/{name}")
        return spark.read.schema(df.schema).parquet(f"{stage}/{name}")

    try:
        raw = {role: landed(RD.read_csv_text(spark, inputs[role], RAW_SCHEMAS[role].fieldNames()), f"raw/{role}")
               for role in ("movies", "ratings", "tags", "links")}
        catalog = landed(CL.clean_catalog(raw["movies"], raw["links"]), "movies_catalog")
        CL.uniqueness_guard(catalog, ["movieId"], "catalog", guard)
        ratings = landed(CL.clean_interactions(raw["ratings"]), "ratings_clean")
        CL.uniqueness_guard(ratings, ["userId", "movieId"], "interactions", guard)
        tags = landed(CL.clean_tags(raw["tags"]), "tags_clean")
        tables = dict(zip(CLEANED, (catalog, ratings, tags, CL.item_categories(catalog))))
        sort = {"movies_catalog": ["movieId"], "ratings_clean": ["userId", "movieId"], "tags_clean": ["movieId", "userId"], "movie_genres": ["movieId"]}
        for name, df in tables.items():
            WR.write_table(df, f"{out}/{name}", sort_by=sort[name])
        stored = {name: RD.read_parquet(spark, f"{out}/{name}") for name in CLEANED}
        WR.write_report_csv(PR.processed_dictionary(stored), f"{out}/processed_dictionary", sort_by=["table", "column"], files=1)
        sizes = RD.input_sizes(spark, {role: [path] for role, path in inputs.items()})
        shapes = PR.table_shapes(raw).join(sizes, "table").select("table", "rows", "size_mb")
        clean = {"catalog": stored["movies_catalog"], "ratings_clean": stored["ratings_clean"], "tags_clean": stored["tags_clean"]}
        WR.write_report_json(RP.cleaning_report(spark, shapes, PR.rows_before_after(raw, clean), PR.orphan_check(clean),
                                                list(CLEANED), list(decisions)), f"{out}/cleaning_report")
    finally:
        RD.remove_folder(spark, stage)
    return stored


def category_source(catalog: DataFrame, bridge: DataFrame | None, r: Roles = DEFAULT_ROLES) -> DataFrame | None:
    """(item, genre) from the first place that has it: the bridge's ``genre``, its
    bar-separated column, the catalog's bar-separated column; None without any."""
    if bridge is not None and first_available(bridge, ["genre"]):
        return bridge.select(r.item, "genre").filter(F.col("genre").isNotNull())
    for df in (bridge, catalog):
        if df is not None and first_available(df, [r.categories]):
            pieces = df.select(r.item, F.explode(X.split_bar(r.categories)).alias("genre"))
            return pieces.filter(F.col("genre") != "")
    return None


def features_run(spark: SparkSession, tables: dict[str, DataFrame], out: str, max_features: int = 5000, min_df: int = 2,
                 components: int = 200, r: Roles = DEFAULT_ROLES) -> dict[str, float]:
    """Build the representation of a catalog and write it under ``out``.

    ``tables`` holds the cleaned tables by their stored names; tags may come in a
    column tag, tags or tag_text. Written: numeric_features, text_corpus, the
    sparse TF-IDF with its vocabulary, pca_scores, svd_embeddings and run_summary (which
    is also returned)."""
    prepare(spark)
    catalog, ratings = tables["movies_catalog"], tables["ratings_clean"]
    genres = category_source(catalog, tables.get("movie_genres"), r)
    tags = tables["tags_clean"]
    tag_column = first_available(tags, [r.tag, "tags", "tag_text"])
    tags = tags.select(r.item, F.col(tag_column).cast("string").alias(r.tag)) if tag_column else \
        spark.createDataFrame([], f"{r.item} bigint, {r.tag} string")
    if genres is None:
        genres = spark.createDataFrame([], f"{r.item} bigint, genre string")
    numeric = FE.numeric_feature_matrix(ratings, genres, tags, FE.category_values(genres), r)
    WR.write_table(numeric, f"{out}/numeric_features")
    numeric = RD.read_parquet(spark, f"{out}/numeric_features")
    columns = [c for c in numeric.columns if c != r.item]
    pca = DC.fit_pca(numeric, columns)
    kept = pca.components_for(0.9, strict=True)
    WR.write_table(DC.pca_scores(pca, [r.item], kept), f"{out}/pca_scores")

    WR.write_table(FE.text_corpus(catalog, FE.tag_text(tags, r), r), f"{out}/text_corpus")
    titles = catalog.select(r.item, F.col(r.title).alias("text"))
    words = tags.select(r.item, F.col(r.tag).alias("text")).distinct().join(catalog.select(r.item), r.item, "left_semi")
    weights, vocabulary = TX.tfidf(titles.unionByName(words), r.item, "text", max_features, min_df, all_ids=catalog.select(r.item))
    WR.write_sparse_matrix(weights, vocabulary, f"{out}/tfidf", r.item)
    weights, vocabulary = WR.read_sparse_matrix(spark, f"{out}/tfidf")
    n_terms, n_items = vocabulary.count(), catalog.count()
    x = SV.prepare(weights.select(r.item, F.col("term_idx").alias("col_idx"), F.col("weight").alias("value")), r.item)
    svd = SV.truncated_svd(x, r.item, n_items, max(n_terms, 1), min(components, n_terms - 1) if n_terms > 1 else 1)
    WR.write_table(SV.embeddings(x, r.item, catalog.select(r.item), svd), f"{out}/svd_embeddings")

    summary = {
        "numeric_rows": float(pca.n), "numeric_columns": float(len(columns)), "text_rows": float(n_items), "text_columns": float(n_terms),
        "pca_components": float(kept), "pca_cumulative_variance": float(pca.cumulative[kept - 1]),
        "pca_mean_squared_error": float(pca.tail_variance(kept) / pca.p),
        "svd_components": float(svd.k), "svd_cumulative_variance": float(svd.explained_variance_ratio.sum()),
        "svd_error_per_row": SV.reconstruction_error_per_row(svd),
    }
    WR.write_report_json(spark.createDataFrame([tuple(summary.values())], ", ".join(f"{k} double" for k in summary)), f"{out}/run_summary")
    return summary
