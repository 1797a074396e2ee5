import glob
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from docweave.operators import discover, insight
from docweave.plans import batch, catalog, job
from docweave.sources import landed
from docweave.sources.serp import SerpSource
from docweave.streaming import ingest
from tests.test_operators import TENDER

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def table(rows, columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in rows)


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = [dict(zip(want.columns, r, strict=True)) for r in want.fetchall()]
    assert table([r.asDict() for r in got.collect()], columns) == table(rows, columns)


@needs_data
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() >= 0


def test_entry_imports_without_a_session():
    import __spark_entry__

    assert catalog.FLAGSHIP in __spark_entry__.queries()


def test_batch(spark, tmp_path):
    page = "<html><body><main>" + "".join(f"<p>{x}</p>" for x in TENDER.replace("The consultant examines", "Selection of consultant who examines").split("\n")) + "<p>Tender notice inviting tender for structural consultancy services, selection of consultant for proof checking, peer review and design verification of the work.</p></main></body></html>"
    found = spark.createDataFrame([(i, f"http://h/{i}", "found title", "serp") for i in (1, 2, 2, 3)], "pos long, source_url string, title string, source string")
    fetches = spark.createDataFrame([("http://h/1", bytes(page, "utf-8"), 200), ("http://h/2", bytes(page, "utf-8"), 200), ("http://h/3", b"<html>404", 404)], "url string, content binary, status_code int").withColumn("content_type", F.lit("text/html"))
    from docweave.operators.gates import fetched

    counts = batch.run(spark, found, fetched(fetches), f"{tmp_path}/store", F.lit("2026-02-01").cast("date"), F.lit("now"))
    assert counts == {"found": 1, "processed": 1, "failed": 1, "saved": 1, "duplicates": 0, "invalid": 0}
    row = spark.read.parquet(f"{tmp_path}/store").first()
    assert row.Title.startswith("Structural audit") and row.Source == "serp" and row.Deadline == "2026-03-15"
    assert batch.reason(spark, counts) == "Opportunities saved successfully"
    again = job.daily(spark, found, fetched(fetches), f"{tmp_path}/store", f"{tmp_path}/log", "2026-02-01", "2026-02-02 08:00:00", 55)
    assert again["saved"] == 0 and again["reason"] == "All qualified opportunities were duplicates"
    audit = insight.run_audit(spark.read.parquet(f"{tmp_path}/log")).first()
    assert (audit.queries, audit.duplicates, audit.reason) == (55, 1, again["reason"])


def test_sources(spark, tmp_path):
    (tmp_path / "a.html").write_text("<html>x</html>")
    (tmp_path / "serp").mkdir()
    (tmp_path / "serp" / "q.json").write_text(json.dumps({"query": "q", "organic_results": [{"title": "t", "link": "http://x", "snippet": "s"}]}) + "\n")
    assert landed.documents(spark, str(tmp_path), "*.html").first().mime_type == "text/html"
    spark.dataSource.register(SerpSource)
    r = spark.read.format("serp").option("path", str(tmp_path / "serp")).load().first()
    assert (r.query, r.position, r.link) == ("q", 1, "http://x")
    landed.export_csv(spark.range(2), str(tmp_path / "csv"))
    assert landed.table(spark, str(tmp_path / "csv"), "csv").count() == 2


def test_stream(spark, tmp_path):
    rows = [(i, "Notice inviting tender for structural audit, proof checking", "selection of consultant", "PWD", "Delhi", "gem", f"http://gov.in/{i % 3}?utm_x=1", "2026-03-20") for i in range(6)]
    spark.createDataFrame(rows, "pos long, title string, description string, organization string, location string, source string, source_url string, deadline string").withColumn("ts", F.lit("2026-02-01 00:00:00").cast("timestamp")).write.parquet(f"{tmp_path}/in")
    stream = ingest.distinct_pages(spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")).drop("canonical_url", "ts")
    told = []
    run = ingest.saver(f"{tmp_path}/store", lambda: F.lit("2026-02-01").cast("date"), lambda: F.lit("now"), told=told.append)
    ingest.start(stream, run, f"{tmp_path}/ck").awaitTermination(150)
    assert sum(t["saved"] for t in told) == 1 and spark.read.parquet(f"{tmp_path}/store").count() == 1


def test_job_helpers():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("HTTP 429")
        return "ok"

    assert job.retried(flaky, when=job.over_quota, sleep=waits.append) == "ok" and waits == [15.0, 30.0]
    assert job.safely(lambda: 1 / 0)["status"] == "failed_safe_mode" and job.safely(lambda: 3) == {"status": "ok", "result": 3}
    assert job.budget({}).limit == 0 and job.budget({job.BUDGET: " 4 "}).limit == 4
    for bad in ("-1", "x", "1.5"):
        with pytest.raises(ValueError):
            job.budget({job.BUDGET: bad})


def test_select_sources_reads_every_supplier(spark, tmp_path):
    """Suppliers beyond the 10,000th count; the nations' keys occur in such names alone."""
    spark.range(1, 12_001).selectExpr("id AS s_suppkey", "concat('Supplier#', lpad(id, 9, '0')) AS s_name", "CAST(id % 25 AS INT) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([("FRANCE", 1150), ("PERU", 10990), ("KENYA", 7)], "n_name string, n_nationkey int").write.parquet(f"{tmp_path}/nation.parquet")
    con = duckdb.connect()
    for t in ("supplier", "nation"):
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(catalog.ORACLE_SQL["q_select_sources"])
    rows = [dict(zip(want.columns, r, strict=True)) for r in want.fetchall()]
    got = catalog.QUERIES["q_select_sources"](spark, str(tmp_path))
    assert any(int(r["url"].rsplit("/", 1)[1]) > 10_000 for r in rows)
    assert table([r.asDict() for r in got.collect()], want.columns) == table(rows, want.columns)


def test_select_sources_keeps_repeated_and_unfit_queries(spark):
    sources = spark.createDataFrame([(i, f"u{i}", "abc" if i == 40 else "x", 0) for i in range(50)], "pos long, url string, text string, priority int")
    got = discover.select_sources(spark.createDataFrame([("abc",), ("abc",), ("zzz",), (None,)], "query string"), sources, 2)
    assert sorted((r.query or "", r.n, r.url) for r in got.collect()) == [("", 0, "u0"), ("", 1, "u1"), ("abc", 0, "u40"), ("abc", 0, "u40"), ("zzz", 0, "u0"), ("zzz", 1, "u1")]
