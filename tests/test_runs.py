"""The runs from files to files: every output is written and read back; guards raise."""

import json
import os

import pytest
from pyspark.sql import functions as F

from itemscope.operators.clean import DuplicateKeyError
from itemscope.plans import runs
from itemscope.plans.context import Tables
from itemscope.roles import RAW_SCHEMAS, first_available
from itemscope.session import ensure_checkpoint_dir

from conftest import SF001


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The driver's tables in the raw roles, written as CSV; one rating per (user, item)."""
    root = tmp_path_factory.mktemp("raw")
    t = Tables(spark, SF001)
    paths = {}
    for role in ("movies", "ratings", "tags", "links"):
        df = t.raw(role).select(*RAW_SCHEMAS[role].fieldNames())
        if role == "ratings":
            df = df.groupBy("userId", "movieId").agg(F.max("rating").alias("rating"), F.max("timestamp").alias("timestamp"))
        if role == "tags":
            df = df.filter("movieId < 60")
        paths[role] = str(root / role)
        df.write.option("header", True).option("escape", '"').csv(paths[role])
    return paths


@pytest.fixture(scope="module")
def cleaned(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("clean"))
    return out, runs.clean_run(spark, raw, out, decisions=["kept null ids"])


def test_clean_run(spark, raw, cleaned):
    out, tables = cleaned
    t = Tables(spark, SF001)
    assert set(tables) == set(runs.CLEANED)
    assert sorted(map(tuple, tables["movies_catalog"].collect()), key=str) == sorted(map(tuple, t.catalog.collect()), key=str)
    assert tables["ratings_clean"].count() == t.ratings_clean.select("userId", "movieId").distinct().count()
    dictionary = spark.read.option("header", True).csv(f"{out}/processed_dictionary").collect()
    assert {r["table"] for r in dictionary} == set(runs.CLEANED)
    name = next(n for n in os.listdir(f"{out}/cleaning_report") if n.endswith(".json"))
    with open(f"{out}/cleaning_report/{name}") as f:
        report = json.load(f)
    assert report["output_tables"] == list(runs.CLEANED) and report["key_decisions"] == ["kept null ids"]
    assert {r["table"]: r["clean_rows"] for r in report["row_changes"]}["ratings"] == tables["ratings_clean"].count()


def test_guard_raises_before_anything_is_written(spark, raw, tmp_path):
    twice = str(tmp_path / "ratings")
    df = spark.read.option("header", True).csv(raw["ratings"])
    df.union(df.limit(1)).write.option("header", True).csv(twice)
    with pytest.raises(DuplicateKeyError):
        runs.clean_run(spark, {**raw, "ratings": twice}, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    runs.clean_run(spark, {**raw, "ratings": twice}, str(tmp_path / "out"), guard="report")
    with pytest.raises(FileNotFoundError):
        runs.clean_run(spark, {**raw, "links": str(tmp_path / "none")}, str(tmp_path / "out2"))


def test_every_csv_is_parsed_once_and_the_landing_folder_goes(spark, raw, tmp_path, monkeypatch):
    read, seen = runs.RD.read_csv_text, {}

    def counting(session, path, columns):
        seen[path] = session.sparkContext.accumulator(0)
        passed = seen[path]

        def run(batches):
            for batch in batches:
                passed.add(batch.num_rows)
                yield batch

        df = read(session, path, columns)
        return df.mapInArrow(run, df.schema)

    folder = ensure_checkpoint_dir(spark)
    here = folder.removeprefix("file:")
    before = set(os.listdir(here))
    rows = {path: spark.read.option("header", True).option("escape", '"').csv(path).count() for path in raw.values()}
    monkeypatch.setattr(runs.RD, "read_csv_text", counting)
    runs.clean_run(spark, raw, str(tmp_path / "out"))
    assert {path: n.value for path, n in seen.items()} == rows
    assert not [x for x in set(os.listdir(here)) - before if x.startswith("clean-run")]
    twice = str(tmp_path / "ratings")
    df = spark.read.option("header", True).csv(raw["ratings"])
    df.union(df.limit(1)).write.option("header", True).csv(twice)
    with pytest.raises(DuplicateKeyError):
        runs.clean_run(spark, {**raw, "ratings": twice}, str(tmp_path / "out2"))
    assert not [x for x in set(os.listdir(here)) - before if x.startswith("clean-run")]


def test_features_run(spark, cleaned, tmp_path):
    _, tables = cleaned
    out = str(tmp_path / "features")
    summary = runs.features_run(spark, tables, out, max_features=200, components=20)
    n = tables["movies_catalog"].count()
    rated = tables["ratings_clean"].select("movieId").distinct().count()
    assert spark.read.parquet(f"{out}/numeric_features").count() == rated == summary["numeric_rows"]
    assert spark.read.parquet(f"{out}/pca_scores").count() == rated
    assert spark.read.parquet(f"{out}/text_corpus").count() == n
    emb = spark.read.parquet(f"{out}/svd_embeddings")
    assert emb.count() == n and len(emb.columns) == 1 + summary["svd_components"]
    assert spark.read.parquet(f"{out}/tfidf/vocabulary").count() == summary["text_columns"] <= 200
    assert spark.read.json(f"{out}/run_summary").first()["svd_components"] == summary["svd_components"]
    assert 0 < summary["pca_cumulative_variance"] <= 1 and summary["svd_error_per_row"] >= 0


def test_fallbacks(spark):
    catalog = spark.createDataFrame([(1, "A", "X|Y"), (2, "B", None)], "movieId bigint, title string, genres string")
    bridge = spark.createDataFrame([(1, "Z")], "movieId bigint, genre string")
    wide = spark.createDataFrame([(1, "P||Q")], "movieId bigint, genres string")
    got = lambda df: sorted((r.movieId, r.genre) for r in df.collect())
    assert got(runs.category_source(catalog, bridge)) == [(1, "Z")]
    assert got(runs.category_source(catalog, wide)) == [(1, "P"), (1, "Q")]
    assert got(runs.category_source(catalog, None)) == [(1, "X"), (1, "Y")]
    assert runs.category_source(catalog.drop("genres"), None) is None
    assert first_available(catalog, ["genre", "genres"]) == "genres" and first_available(catalog, ["x"]) is None
