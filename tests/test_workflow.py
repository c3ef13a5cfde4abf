import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from inkledger.operators import approvals, audit
from inkledger.operators.decide import dedupe_invoices, process_documents
from inkledger.operators.extract import extract_flatten
from inkledger.operators.notify import notifications
from inkledger.operators.routing import match_source_files, routing_manifest
from inkledger.operators.store import assign_keys
from inkledger.sources.extractions import filter_result_files, intake_manifest, skipped_files
from tests.helpers import document, documents

T0 = dt.datetime(2025, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def stored(spark):
    invoices = spark.createDataFrame(
        [(1, "A", 10, Decimal("100.00"), "pending_review", at(0)), (2, "B", 10, Decimal("5.00"), "failed", at(60)),
         (3, "C", None, Decimal("7.00"), "approved", at(0)), (4, "D", 99, Decimal("7.00"), "approved", at(0))],
        "invoice_id bigint, invoice_number string, vendor_id bigint, total_amount decimal(12,2), "
        "status string, processed_at timestamp")
    return invoices, spark.createDataFrame([(10, "V")], "vendor_id bigint, vendor_name string")


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        (1, at(1), "1", "approve"), (2, at(2), "1", "reject"), (3, at(2), "1", "approve"),
        (4, at(3), "1", "escalate"), (5, at(4), None, "approve"), (6, at(5), "", "approve"), (7, at(6), "1", None),
        (8, at(7), "x1", "approve"), (9, at(8), "77", "approve"), (10, at(9), "2", "approve"),
        (11, at(70), " 2 ", "reject"), (12, at(80), "3", "reject"), (13, at(81), "4", "reject"),
        (14, at(82), "99999999999999999999", "approve")]
    return spark.createDataFrame(rows, "action_id bigint, action_time timestamp, invoice_id string, action string")


def test_response_codes(stored, log):
    rows = approvals.approval_responses(log, *stored).collect()
    assert {r.action_id: r.status_code for r in rows} == {
        1: 200, 2: 200, 3: 200, 4: 400, 5: 400, 6: 400, 7: 400, 8: 500, 9: 404, 10: 404, 11: 200, 12: 404, 13: 404,
        14: 500}
    by_id = {r.action_id: r for r in rows}
    assert (by_id[1].title, by_id[1].amount, by_id[1].vendor_name) == ("Invoice Approved", "$100.00", "V")
    assert by_id[4].title == "Error: Action must be approve or reject"
    assert by_id[6].title == "Error: Missing invoice_id or action" and by_id[9].new_status is None


def test_missing_parameter_object(spark, stored, log):
    flagged = log.withColumn("no_parameters", F.col("action_id") == 1)
    codes = {r.action_id: r.status_code for r in approvals.classify_actions(flagged, *stored).collect()}
    assert codes[1] == 500 and codes[2] == 200


def test_last_action_wins_and_replaces_the_time(stored, log):
    rows = {r.invoice_id: r for r in approvals.apply_approvals(*stored, log).collect()}
    assert (rows[1].status, rows[1].processed_at) == ("approved", at(2))
    assert (rows[2].status, rows[2].processed_at) == ("rejected", at(70))
    assert rows[3].status == "approved" and rows[3].processed_at == at(0)
    assert rows[4].processed_at == at(0)
    trusted = {r.invoice_id: r.status for r in approvals.apply_approvals(stored[0], None, log).collect()}
    assert trusted[4] == "rejected" and trusted[3] == "approved"


def test_history_chains_statuses(stored, log):
    rows = approvals.status_history(*stored, log).orderBy("action_id").collect()
    assert [(r.action_id, r.previous_status, r.new_status) for r in rows] == [
        (1, "pending_review", "approved"), (2, "approved", "rejected"), (3, "rejected", "approved"),
        (11, "failed", "rejected")]


def test_history_takes_times_without_zone(stored, log):
    plain = log.withColumn("action_time", F.col("action_time").cast("timestamp_ntz"))
    expected = [tuple(r)[:5] for r in approvals.status_history(*stored, log).orderBy("action_id").collect()]
    got = [tuple(r)[:5] for r in approvals.status_history(*stored, plain).orderBy("action_id").collect()]
    assert got == expected


def accepted(spark, *texts):
    return assign_keys(dedupe_invoices(process_documents(extract_flatten(documents(spark, list(texts))))),
                       F.col("arrival"))


def test_notifications_follow_the_amount_not_the_status(spark):
    facts = accepted(
        spark, document(invoice_number="", total_amount="60000.005"), document(invoice_number="2", total_amount=50000),
        document(0.1, invoice_number="3", total_amount="70"), document(
            0.855, invoice_number="4", total_amount="1234567.8", due_date=None, po_number=None,
            invoice_date="Nov 20, 2025"))
    rows = {r.invoice_id: r for r in notifications(facts, "https://x/a").collect()}
    assert set(rows) == {0, 3}
    assert rows[0].subject == "🔔 High-Value Invoice Approval Required: "
    body = rows[3].body
    assert body.startswith("High-Value Invoice Requires Approval\n\nInvoice Number: 4\nVendor: Acme\n")
    assert "Amount: $1,234,567.80\nDate: Nov 20, 2025\nDue Date: None\nPO Number: None\n" in body
    assert "Confidence Score: 85.5%\n" in body and "exceeds the $50,000.00 threshold" in body
    assert "APPROVE: https://x/a?invoice_id=3&action=approve\n" in body
    assert body.endswith("approve or reject this invoice.")


def test_files_are_kept_skipped_and_listed(spark):
    keys = ["j/0/custom_output/0/result.json", "j/0/standard_output/0/result.json", "j/custom_output/x.json"]
    df = spark.createDataFrame([(k,) for k in keys], "s3_key string")
    assert [r.s3_key for r in filter_result_files(df).collect()] == keys[:1]
    assert {r.s3_key for r in skipped_files(df).collect()} == set(keys[1:])
    files = spark.createDataFrame([("in", "a.pdf", "arn:aws:x/job/77")], "bucket string, key string, invocation_arn string")
    row = intake_manifest(files).first()
    assert row.job_id == "77" and row.input_uri == "s3://in/a.pdf"
    assert row.tags == {"bedrock_job_id": "77", "processing_status": "in_progress"}


def test_routing(spark):
    invoices = spark.createDataFrame(
        [("1", "approved", "/j1/0/x"), ("2", "pending_review", "j2/0/x"), ("3", "failed", "j3/0")],
        "invoice_number string, status string, s3_key string")
    files = spark.createDataFrame(
        [("b.pdf", {"bedrock_job_id": "j1"}), ("a.pdf", {"bedrock_job_id": "j1"}), ("c.pdf", {"bedrock_job_id": "j2"}),
         ("d.pdf", {"other": "j3"})], "key string, tags map<string,string>")
    rows = {r.invoice_number: r for r in routing_manifest(invoices, files, "in", "done", "bad").collect()}
    assert rows["1"].source == "s3://in/a.pdf" and rows["1"].destination == "s3://done/a.pdf"
    assert rows["2"].destination == "s3://bad/c.pdf" and rows["2"].reason == "status: pending_review"
    assert rows["3"].destination is None and rows["3"].reason == "no source file"
    assert match_source_files(invoices, files).count() == 3


def test_audit_counts_violations(spark):
    money = "decimal(12,2)"
    invoices = spark.createDataFrame(
        [(1, "A", None, 10, 1, "x" * 51), (2, "A", dt.date(2025, 1, 1), 10, 2, "ok"), (3, None, None, 99, 3, "ok"),
         (4, "B", dt.date(2025, 1, 1), 99, 4, "ok"), (5, "C", dt.date(2025, 1, 1), None, 5, "ok")],
        "invoice_id int, invoice_number string, invoice_date date, vendor_id int, customer_id int, status string"
    ).withColumn("total_amount", F.lit("1").cast(money))
    tables = {
        "invoices": invoices, "vendors": spark.createDataFrame([(10, "V")], "vendor_id int, vendor_name string"),
        "customers": spark.range(1, 5).select(F.col("id").cast("int").alias("customer_id")),
        "invoice_line_items": spark.createDataFrame([(1, None), (8, "x")], "invoice_id int, description string"),
        "bank_details": spark.createDataFrame([(10,)], "vendor_id int")}
    found = {(r.rule, r.table_name, r.column_name): r.violations for r in audit.constraint_audit(tables).collect()}
    bad = {k: v for k, v in found.items() if v}
    assert bad == {
        ("not_null", "invoices", "invoice_number"): 1, ("not_null", "invoices", "invoice_date"): 2,
        ("max_length", "invoices", "status"): 1, ("unique", "invoices", "invoice_number"): 1,
        ("foreign_key", "invoices", "vendor_id"): 2, ("foreign_key", "invoices", "customer_id"): 1,
        ("not_null", "invoice_line_items", "description"): 1, ("foreign_key", "invoice_line_items", "invoice_id"): 1}


def test_reconcile(spark):
    invoices = spark.createDataFrame(
        [(1, "A", "100", "5", "8", "103"), (2, "B", "10", "0", "0", "10.03"), (3, "C", None, None, None, "0")],
        "invoice_id int, invoice_number string, subtotal string, discount string, tax_amount string, total_amount string")
    for c in ("subtotal", "discount", "tax_amount", "total_amount"):
        invoices = invoices.withColumn(c, F.col(c).cast("decimal(12,2)"))
    lines = spark.createDataFrame([(1, Decimal("60.01")), (1, Decimal("40.01"))], "invoice_id int, amount decimal(12,2)")
    rows = {r.invoice_id: r for r in audit.reconcile_totals(invoices, lines).collect()}
    assert (rows[1].lines_match, rows[1].total_matches) == (True, True)
    assert (rows[2].lines_match, rows[2].total_matches) == (False, False)
    assert rows[3].line_total == 0 and rows[3].lines_match
