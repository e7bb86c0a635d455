"""WARC data source: round trips, revisits, pushed predicates, skipped payloads."""

import hashlib

import pytest
from pyspark.sql import functions as F

from itemscope.llm import warc


def _records(spark, rows):
    return spark.createDataFrame(rows, "record_type string, record_id string, warc_date string, target_uri string, payload_digest string, "
                                       "refers_to string, profile string, payload_length bigint, extra map<string,string>, payload binary")


ROWS = [("response", f"<urn:x:{i}>", "2024-01-01T00:00:00Z", f"http://h{i % 3}/é\r\nX: {i}", None, None, None, None, {"X-N": str(i)},
         bytearray(b"\r\n\r\nWARC/1.1\r\n" * i)) for i in range(40)]
ROWS += [("revisit", "<urn:x:r>", None, None, "sha1:ab", "<urn:x:3>", warc.REVISIT_PROFILE, 999, None, None),
         ("response", "<urn:x:n>", None, None, None, None, None, None, None, None)]


@pytest.mark.parametrize("options", [{}, {"compression": "gzip"}, {"maxFileBytes": "500"}])
def test_round_trip(spark, tmp_path, options):
    path = f"file://{tmp_path}/a"
    warc.register(spark)
    _records(spark, ROWS).write.format("warc").options(**options).mode("append").save(path)
    got = {r.record_id: r for r in spark.read.format("warc").load(path).collect()}
    assert len(got) == len(ROWS)
    for i in range(40):
        r = got[f"<urn:x:{i}>"]
        assert bytes(r.payload) == bytes(ROWS[i][9]) and r.payload_length == len(ROWS[i][9]) and r.extra["X-N"] == str(i)
        assert r.target_uri == f"http://h{i % 3}/é X: {i}"
    assert got["<urn:x:r>"].payload is None and got["<urn:x:r>"].payload_length == 999
    assert bytes(got["<urn:x:n>"].payload) == b"" and got["<urn:x:n>"].target_uri is None


def test_predicates_reach_the_scan_and_payloads_are_skipped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "b")
    warc.register(spark)
    _records(spark, ROWS).coalesce(1).write.format("warc").mode("append").save(path)
    df = spark.read.format("warc").load(path)
    assert df.filter("record_type = 'revisit'").count() == 1
    assert df.filter("record_type in ('revisit', 'response') and target_uri like 'http://h1/%'").count() == 13
    assert df.filter(F.col("refers_to").isNotNull() & (F.col("payload_length") > 5)).count() == 1
    assert spark.read.format("warc").option("payload", "false").load(path).filter("payload is not null").count() == 0

    from pyspark.sql.datasource import EqualTo, GreaterThan
    reader = warc._Reader({"path": path}, df.schema)
    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_length",), 5)]))
    assert [type(f) for f in rest] == [GreaterThan]
    monkeypatch.setattr(warc._Input, "block", lambda self, n=None: pytest.fail("a payload was decoded"))
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 1


def test_append_overwrite_and_uncommitted_files(spark, tmp_path):
    path = str(tmp_path / "c")
    warc.register(spark)
    df = _records(spark, ROWS[:3])
    df.write.format("warc").mode("append").save(path)
    df.write.format("warc").mode("append").save(path)
    (tmp_path / "c" / "part-lost.warc").write_bytes(warc.record_bytes({"record_type": "response", "payload": b"x"}))
    assert spark.read.format("warc").load(path).count() == 6
    df.write.format("warc").mode("overwrite").save(path)
    assert spark.read.format("warc").load(path).count() == 3


def test_folder_without_manifest_and_empty(spark, tmp_path):
    warc.register(spark)
    (tmp_path / "d").mkdir()
    assert spark.read.format("warc").load(str(tmp_path / "d")).count() == 0
    (tmp_path / "d" / "x.warc").write_bytes(warc.record_bytes({"record_type": "response", "payload": b"x"}) * 2)
    assert spark.read.format("warc").load(str(tmp_path / "d")).count() == 2
    _records(spark, []).write.format("warc").mode("append").save(str(tmp_path / "e"))
    assert spark.read.format("warc").load(str(tmp_path / "e")).count() == 0


def test_revisits(spark):
    big, small = "x" * 1000, "y" * 999
    rows = [(1, big), (5, big), (5, big), (None, big), (2, small), (3, small), (None, "z" * 2000), (None, "z" * 2000), (7, "")]
    df = spark.createDataFrame(rows, "page_id bigint, t string").select("page_id", F.encode("t", "UTF-8").alias("payload"))
    got = sorted(((r.page_id is None, r.page_id or 0, r.payload_length, r.record_type, r.refers_to) for r in warc.with_revisits(df, "page_id", "payload").collect()),
                 key=str)
    want = [(False, 1, 1000, "revisit", 5), (False, 5, 1000, "response", None), (False, 5, 1000, "response", None), (True, 0, 1000, "revisit", 5),
            (False, 2, 999, "response", None), (False, 3, 999, "response", None), (True, 0, 2000, "response", None),
            (True, 0, 2000, "response", None), (False, 7, 0, "response", None)]
    assert got == sorted(want, key=str)


def test_query_round_trip(spark):
    from itemscope.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    pages = {p.page_id: (p.html or "").encode() for p in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op3_warc"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.payload_bytes, r.payload_digest) == (len(pages[r.page_id]), hashlib.sha1(pages[r.page_id]).hexdigest())
