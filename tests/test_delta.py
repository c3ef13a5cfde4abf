"""What is kept along streams: status history, routing, and the audit of growing tables, against their batch forms."""

import random

import pytest
from pyspark.sql import functions as F

from inkledger.model import JOB_TAG
from inkledger.operators import approvals, audit
from inkledger.operators.routing import routing_manifest
from inkledger.sources.tables import TABLES
from inkledger.streaming.audit import audit_batch, compact_audit, read_findings
from inkledger.streaming.history import compact_history, read_history, store_actions
from inkledger.streaming.routing import read_routes, start_routing

TIME = "timestamp_ntz'2025-01-01' + make_dt_interval(0, 0, {0})"


@pytest.fixture(scope="module")
def tables(spark):
    invoices = spark.range(12).selectExpr("id AS invoice_id", "id AS vendor_id", "concat('I', id) AS invoice_number", "cast(id AS decimal(12,2)) AS total_amount",
                                          "if(id % 2 = 0, 'approved', 'pending_review') AS status", TIME.format("0") + " AS processed_at")
    return invoices, spark.range(11).selectExpr("id AS vendor_id", "concat('V', id) AS vendor_name")


def actions(spark, rows):
    df = spark.createDataFrame(rows, "action_id long, minute int, invoice_id string, action string")
    return df.selectExpr("action_id", TIME.format("minute") + " AS action_time", "invoice_id", "action")


def shown(df):
    return sorted((r.action_id, r.invoice_id, r.previous_status, r.new_status) for r in df.collect())


@pytest.mark.parametrize("merge", [False, True])
def test_history_of_late_actions_equals_the_batch(spark, tables, tmp_path, merge):
    draw = random.Random(merge)
    # half of the actions are on one invoice, many at one time
    rows = [(i, draw.randrange(-5, 30), str(3 if i % 2 else draw.randrange(14)), draw.choice(["approve", "reject", "escalate"])) for i in range(160)]
    draw.shuffle(rows)
    out, seen = str(tmp_path), []
    for batch in range(4):
        part = rows[40 * batch:40 * batch + 40]
        seen += part
        store_actions(actions(spark, part), batch, out, *tables, "s")
        store_actions(actions(spark, part), batch, out, *tables, "s")
        if merge:
            compact_history(spark, out, fan=2)
        assert shown(read_history(spark, out)) == shown(approvals.status_history(*tables, actions(spark, seen)))


def test_in_order_actions_do_not_read_earlier_steps(spark, tables, tmp_path):
    out = str(tmp_path)
    for batch in range(3):
        store_actions(actions(spark, [(10 * batch + i, 10 * batch + i, str(i % 3), "approve") for i in range(6)]), batch, out, *tables, "s")
    steps = spark.read.parquet(f"{out}/steps")
    assert steps.count() == 18 and {r.revision for r in steps.select("revision").distinct().collect()} == {0, 1, 2}


def files_and_results(spark, low, high, kind):
    base = spark.range(low, high)
    if kind == "results":
        return base.selectExpr("concat('I', id) AS invoice_number", "if(id % 3 = 0, 'approved', 'failed') AS status",
                               "concat('/job-', id, '/0/custom_output/0/result.json') AS s3_key", TIME.format("id") + " AS processed_at")
    return base.filter("id % 4 <> 0").selectExpr("concat('f', id, '.pdf') AS key", f"map('{JOB_TAG}', concat('job-', id)) AS tags",
                                                 TIME.format("id - 1") + " AS uploaded_at")


def test_files_and_results_meet_in_either_order(spark, tmp_path):
    work = str(tmp_path)
    schemas = {k: files_and_results(spark, 0, 1, k).schema for k in ("results", "files")}

    def deliver(*parts):
        for kind, low, high in parts:
            files_and_results(spark, low, high, kind).write.mode("append").parquet(f"{work}/{kind}")
        streams = [spark.readStream.schema(schemas[k]).parquet(f"{work}/{k}") for k in ("results", "files")]
        query = start_routing(*streams, f"{work}/routes", f"{work}/ckpt", wait="15 minutes")
        query.awaitTermination()
        assert query.exception() is None
        return read_routes(spark, f"{work}/routes", "in", "done", "bad")

    deliver(("results", 0, 10), ("files", 100, 100))
    met = deliver(("files", 0, 20))
    # what has a file has met it, what has none still waits
    assert {r.invoice_number for r in met.collect()} == {f"I{i}" for i in range(10) if i % 4}
    deliver(("results", 10, 20))
    whole = deliver(("results", 101, 102), ("files", 101, 102))
    results, files = files_and_results(spark, 0, 20, "results"), files_and_results(spark, 0, 20, "files")
    late = {"I101"}
    assert sorted(map(str, (r for r in whole.collect() if r.invoice_number not in late))) == sorted(
        map(str, routing_manifest(results, files, "in", "done", "bad").select(whole.columns).collect()))
    assert sum(r.reason == "no source file" for r in whole.collect()) == 5


def broken(spark, part):
    """Rows with repeated keys, and references whose target comes in another part or never."""
    k = F.col("id")
    ids = spark.range(60).filter(F.pmod(F.xxhash64("id"), F.lit(3)) == part)
    return {
        "vendors": ids.select((k % 20).alias("vendor_id"), F.concat(F.lit("v"), k % 25).alias("vendor_name")),
        "invoices": ids.select(k.alias("invoice_id"), F.when(k % 7 > 0, F.concat(F.lit("n"), k % 50)).alias("invoice_number"), ((k * 7) % 31).alias("vendor_id"),
                               F.lit(None).cast("date").alias("invoice_date")),
        "invoice_line_items": ids.select(k.alias("line_item_id"), ((k * 11) % 80).alias("invoice_id"), F.rpad(F.lit("d"), 5, "d").alias("description")),
    }


def test_findings_equal_the_full_audit_after_each_batch(spark, tmp_path):
    out, seen = str(tmp_path), None
    for i in range(3):
        tables = broken(spark, i)
        audit_batch(tables, i, out)
        audit_batch(tables, i, out)
        seen = tables if seen is None else {n: df.unionAll(tables[n]) for n, df in seen.items()}
        assert sorted(map(tuple, read_findings(spark, out).collect())) == sorted(map(tuple, audit.constraint_audit(seen).collect()))
        if i == 1:
            assert compact_audit(spark, out, fan=2) > 0
    assert any(r.violations for r in read_findings(spark, out).collect()) and TABLES


def test_a_batch_reads_only_the_folders_of_its_values(spark, tmp_path):
    from inkledger.streaming.audit import _read
    out = str(tmp_path)
    audit_batch(broken(spark, 0), 0, out)
    from inkledger.streaming.commits import read_state
    folders = read_state(spark, out).folders("values")
    some = _read(spark, out, folders, [1, 2])
    assert 0 < some.count() < _read(spark, out, folders).count()
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
