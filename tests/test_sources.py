"""Readers and sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from itemscope.operators import text as TX
from itemscope.sources import fixtures as FX
from itemscope.sources import readers as RD
from itemscope.sources import writers as WR

from conftest import SF001


def test_write_table_sorted_within_files(spark, tmp_path):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k bigint, v string").repartition(1)
    WR.write_table(df, str(tmp_path / "t"), sort_by=["k"])
    assert [r.k for r in RD.read_parquet(spark, str(tmp_path / "t")).collect()] == [1, 2, 3]
    WR.write_table(df.repartition(3), str(tmp_path / "g"), sort_by=["k"], global_sort=True)
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "g")).collect()) == [1, 2, 3]


def test_bounded_reports(spark, tmp_path):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    WR.write_report_csv(df, str(tmp_path / "r"), sort_by=["id"], files=1)
    files = [f for f in os.listdir(tmp_path / "r") if f.endswith(".csv")]
    assert len(files) == 1
    lines = open(tmp_path / "r" / files[0]).read().splitlines()
    assert lines[0] == "id,x" and lines[1:] == [f"{i},{2 * i}" for i in range(5)]
    nested = WR.nest(df, "rows")
    WR.write_report_json(nested, str(tmp_path / "j"))
    jf = [f for f in os.listdir(tmp_path / "j") if f.endswith(".json")][0]
    rec = json.loads(open(tmp_path / "j" / jf).read().splitlines()[0])
    assert len(rec["rows"]) == 5


def test_sparse_matrix_roundtrip(spark, tmp_path):
    parts = spark.createDataFrame([(1, "red apple"), (2, "red pear"), (3, "green apple apple")], "id bigint, text string")
    w, vocab = TX.tfidf(parts, "id", "text", 10, 2)
    WR.write_sparse_matrix(w, vocab, str(tmp_path / "m"), "id")
    w2, v2 = WR.read_sparse_matrix(spark, str(tmp_path / "m"))
    assert sorted(w2.columns) == ["id", "term_idx", "weight"] and w2.count() == w.count()
    assert {r.term for r in v2.collect()} == {"apple", "red"}


def test_sizes_and_missing_path(spark):
    sizes = {r.table: r.size_mb for r in RD.input_sizes(spark, FX.role_source_paths(SF001)).collect()}
    assert set(sizes) == set(FX.ROLE_SOURCES) and all(v >= 0 for v in sizes.values())
    files = RD.file_sizes(spark.read.parquet(f"{SF001}/part.parquet")).collect()
    assert len(files) == 1 and files[0].file_size == os.path.getsize(f"{SF001}/part.parquet")
    with pytest.raises(Exception):
        RD.read_parquet(spark, f"{SF001}/no_such_table.parquet").count()


def test_spread_before_explode(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for layout in (spark.range(1000).coalesce(1), spark.range(1000).repartition(13)):
        spread = FX.spread_before_explode(layout, "id")
        assert spread.rdd.getNumPartitions() == n and spread.count() == 1000


def test_report_rows_of_any_length(spark, tmp_path):
    from itemscope.operators import onepass as OP
    from itemscope.operators import profile as PR
    from itemscope.operators import reports as RP
    from itemscope.plans.context import Tables
    from itemscope.plans.queries import _raw
    t = Tables(spark, SF001)
    raw = _raw(t)
    known = OP.facts(raw)
    many = spark.range(20_000).select((F.col("id") * 7919 % 20_000 / 8).alias("rating"), F.when(F.col("id") > 5, F.col("id")).alias("n"))
    sections = RP.profile_sections(OP.shapes(raw, known), OP.missing(raw, known).filter("null_count > 0"), OP.checks(known), OP.coverage(raw),
                                   OP.scale(known), many, PR.top_categories_raw(t.movies, 15))
    WR.write_report_rows(sections, str(tmp_path / "p"))
    assert set(os.listdir(tmp_path / "p")) == set(sections)

    def rows(name):
        folder = tmp_path / "p" / name
        return [json.loads(x) for f in sorted(os.listdir(folder)) if f.endswith(".json") for x in open(folder / f)]

    ratings = [r["rating"] for r in rows("rating_distribution")]
    assert len(ratings) == 20_000 and ratings == sorted(ratings) and sum(r["n"] is None for r in rows("rating_distribution")) == 6
    sizes = [r["rows"] for r in rows("table_shapes")]
    assert sizes == sorted(sizes, reverse=True) and len(rows("top_genres")) <= 15 and len(rows("scale_metrics")) == 1
