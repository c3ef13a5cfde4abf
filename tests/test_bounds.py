"""What a query holds at one time, on disk, in the driver or in a stream's state, does not grow with its tables."""

import os
import random

import pytest

from inkledger.checks import queries, store_queries
from inkledger.model import JOB_TAG
from inkledger.operators import audit
from inkledger.streaming import audit as deltas
from inkledger.streaming.commits import read_state
from inkledger.streaming.routing import read_routes, start_routing

TIME = "timestamp_ntz'2025-01-01' + make_dt_interval(0, 0, at)"


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """300 orders of 20 customers and 10 suppliers."""
    d = str(tmp_path_factory.mktemp("star"))
    tables = {
        "orders": spark.range(300).selectExpr("id AS o_orderkey", "id % 20 AS o_custkey", "'O' AS o_orderstatus", "double(100 + id) AS o_totalprice",
                                              "timestamp_ntz'1998-02-06' AS o_orderdate", "'5-LOW' AS o_orderpriority"),
        "customer": spark.range(20).selectExpr("id AS c_custkey", "concat('Customer ', id) AS c_name"),
        "supplier": spark.range(10).selectExpr("id AS s_suppkey", "concat('Supplier ', id) AS s_name"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{d}/{name}.parquet")
    return d


def test_files_lie_on_the_disk_in_slices(spark, star, monkeypatch):
    seen = []
    read = store_queries.read_extractions

    def reading(session, folder, bucket):
        seen.append((folder, sum(len(files) for _, _, files in os.walk(folder))))
        return read(session, folder, bucket)

    monkeypatch.setattr(store_queries, "FILES_AT_ONCE", 60, raising=False)
    monkeypatch.setattr(store_queries, "read_extractions", reading)
    rows = queries.registry()["file_ingest"](spark, star).collect()
    assert sum(n for _, n in seen) == len(rows) == 300 and max(n for _, n in seen) < 100
    assert not any(os.path.exists(folder) for folder, _ in seen)
    results = {r.s3_key for r in rows if r.s3_bucket == "results"}
    assert results == {f"/job-{k}/0/custom_output/0/result.json" for k in range(300) if k % 11}
    assert {r.s3_key for r in rows if r.error == "Skipped"} == {f"/job-{k}/0/standard_output/0/result.json" for k in range(0, 300, 11)}
    assert {r.s3_key: r.invoice_number for r in rows if r.s3_key in results}["/job-1/0/custom_output/0/result.json"] == "INV-1"


def results_of(spark, rows):
    df = spark.createDataFrame(rows, "invoice_number string, job int, at int")
    return df.selectExpr("invoice_number", "'approved' AS status", "concat('/job-', job, '/0/custom_output/0/result.json') AS s3_key", TIME + " AS processed_at")


def files_of(spark, rows):
    df = spark.createDataFrame(rows, "key string, job int, at int")
    return df.selectExpr("key", f"map('{JOB_TAG}', concat('job-', job)) AS tags", TIME + " AS uploaded_at")


def test_routing_keeps_no_rows_in_a_stream_s_state(spark, tmp_path):
    work, draw, wait = str(tmp_path), random.Random(5), 15
    make = {"results": results_of, "files": files_of}
    arrived, closed, expected = {"results": [], "files": []}, -1000, set()
    for step in range(6):
        latest = []
        for kind in arrived:
            # some without a job, some older than what is still taken
            rows = [(f"{kind[0]}{step}-{i}", draw.choice([None, *range(12)]), draw.randrange(20 * step - 25, 20 * step + 20)) for i in range(20)]
            make[kind](spark, rows).write.mode("append").parquet(f"{work}/{kind}")
            arrived[kind] += [r for r in rows if r[2] > closed]
            latest.append(max(r[2] for r in rows if kind == "results" or r[1] is not None))
        near = [(r, f) for r in arrived["results"] for f in arrived["files"] if r[1] is not None and r[1] == f[1] and abs(r[2] - f[2]) <= wait]
        closed = max(closed, min(latest) - wait)
        expected |= {(r[0], f[0]) for r, f in near}
        expected |= {(r[0], None) for r in arrived["results"] if r[2] < closed - wait and r not in [n for n, _ in near]}
        streams = [spark.readStream.schema(spark.read.parquet(f"{work}/{kind}").schema).parquet(f"{work}/{kind}") for kind in arrived]
        query = start_routing(*streams, f"{work}/routes", f"{work}/ckpt", wait=f"{wait} minutes", **({"fan": 3} if step else {}))
        query.awaitTermination()
        assert query.exception() is None
        assert not query.lastProgress["stateOperators"] and not os.path.exists(f"{work}/ckpt/state")
        first = {}
        for number, key in expected:
            first[number] = min(k for n, k in expected if n == number) if key else None
        assert {r.invoice_number: r.source_key for r in read_routes(spark, f"{work}/routes", "in", "done", "bad").collect()} == first
    assert None in first.values() and len(arrived["results"]) < 120
    # what can meet nothing more has gone with a merge
    sizes = read_state(spark, f"{work}/routes").sizes("results")
    assert sum(sizes.values()) < len(arrived["results"])


def audited(spark, low, high):
    """Many rows of few values, as packed files have them: their size says nothing of their rows."""
    ids = spark.range(low, high, 1, 4)
    return {"vendors": ids.selectExpr("if(id % 7 = 0, null, id % 5) AS vendor_id", "concat('v', id % 5) AS vendor_name"),
            "invoices": ids.selectExpr("id AS invoice_id", "concat('n', id % 900) AS invoice_number", "if(id % 3 = 0, null, id % 9) AS vendor_id"),
            "invoice_line_items": ids.selectExpr("id AS line_item_id", "id + 300 AS invoice_id", "'x' AS description")}


def test_the_audit_of_references_broadcasts_no_table(spark, tmp_path):
    for name, df in audited(spark, 0, 2000).items():
        df.write.parquet(f"{tmp_path}/{name}")
    found = audit.audit_foreign_keys({name: spark.read.parquet(f"{tmp_path}/{name}") for name in audited(spark, 0, 1)})
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    lost = sum(k % 3 != 0 and k % 9 > 4 for k in range(2000))
    assert {(r.table_name, r.column_name): r.violations for r in found.collect()} == {
        ("invoices", "vendor_id"): lost, ("invoice_line_items", "invoice_id"): 300}


@pytest.mark.parametrize("few", [0, 10_000])
def test_large_and_small_batches_are_audited_alike(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(deltas, "FEW", few)
    for i, (low, high) in enumerate([(0, 900), (700, 1100), (1100, 1150)]):
        deltas.audit_batch(audited(spark, low, high), i, str(tmp_path))
        seen = {name: df.unionAll(audited(spark, 700, 1100)[name] if i else df.limit(0)) for name, df in audited(spark, 0, 900).items()}
        if i == 2:
            seen = {name: df.unionAll(audited(spark, 1100, 1150)[name]) for name, df in seen.items()}
        assert sorted(map(tuple, deltas.read_findings(spark, str(tmp_path)).collect())) == sorted(map(tuple, audit.constraint_audit(seen).collect()))
