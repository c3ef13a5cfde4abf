from decimal import Decimal

from pyspark.sql import functions as F

from inkledger import model as M
from inkledger.operators.decide import dedupe_invoices, process_documents
from inkledger.operators.extract import extract_flatten
from inkledger.operators.store import (
    assign_keys, merge_vendor_states, project_tables, vendor_state, vendors_of,
)
from inkledger.sources.tables import align_schema, read_tables, union_aligned, write_tables
from tests.helpers import document, documents


def accepted(spark, *texts):
    rows = dedupe_invoices(process_documents(extract_flatten(documents(spark, list(texts)))))
    at = F.timestamp_seconds(1700000000 + F.col("arrival"))
    return assign_keys(rows.withColumn("processed_at", at))


def test_vendor_keeps_first_terms_and_last_address(spark):
    facts = accepted(
        spark,
        document(invoice_number="1", company_name="V", company_address="old", payment_terms="NET-30"),
        document(invoice_number="2", company_name="V", company_address=None, payment_terms="NET-60"),
        # refused as a duplicate: must not touch the vendor
        document(invoice_number="2", company_name="V", company_address="leak", payment_terms="LEAK"),
        document(invoice_number="3", company_name="v", company_address="case"))
    vendors = {r.vendor_name: r for r in project_tables(facts)["vendors"].collect()}
    assert set(vendors) == {"V", "v"}
    assert vendors["V"].vendor_address is None and vendors["V"].payment_terms == "NET-30"
    assert vendors["V"].is_approved and vendors["V"].vendor_email is None
    assert vendors["V"].created_at.timestamp() == 1700000000


def test_vendor_states_merge(spark):
    facts = accepted(spark, *[document(invoice_number=str(i), company_name=f"V{i % 3}", company_address=None if i % 4 else str(i),
                                       payment_terms=str(i)) for i in range(20)])
    parts = [vendor_state(facts.filter(F.col("arrival") % 2 == i)) for i in (1, 0)]
    merged = vendors_of(merge_vendor_states(*parts))
    assert sorted(merged.collect()) == sorted(project_tables(facts)["vendors"].collect())


def test_projections(spark):
    items = [{"description": "a", "amount": "1"}, {"description": "b", "amount": "2.5"}]
    tables = project_tables(accepted(
        spark, document(invoice_number="1", invoice_items=items, discount="-1.25"),
        document(invoice_number="2", invoice_items=[], bank_details={"bank_name": ""})))
    assert {n: t.count() for n, t in tables.items()} == {
        "vendors": 1, "customers": 2, "invoices": 2, "invoice_line_items": 2, "bank_details": 1}
    lines = tables["invoice_line_items"].orderBy("line_number").collect()
    assert [(r.line_number, r.description, r.amount) for r in lines] == [
        (1, "a", Decimal("1.00")), (2, "b", Decimal("2.50"))]
    joined = tables["invoices"].join(tables["vendors"], "vendor_id").join(tables["customers"], "customer_id")
    assert joined.count() == 2
    first = tables["invoices"].filter("invoice_number = '1'").first()
    assert first.discount == Decimal("1.25") and first.status == "approved" and first.approved_at is None
    for name, schema in M.TABLES.items():
        assert {(f.name, f.dataType) for f in tables[name].schema} == {(f.name, f.dataType) for f in schema}


def test_trailing_spaces_are_cut_to_the_column(spark):
    terms = "x" * 50 + "   "
    tables = project_tables(accepted(spark, document(payment_terms=terms)))
    assert tables["vendors"].first().payment_terms == "x" * 50
    assert tables["invoices"].first().payment_terms == terms


def test_align_adds_defaults_once_and_keeps_values(spark):
    old = spark.createDataFrame([(1, "A")], "invoice_id int, invoice_number string")
    once = align_schema(old, M.INVOICES, M.DEFAULTS["invoices"])
    row = once.first()
    assert row.status == "pending" and row.discount == Decimal("0.00") and row.po_number is None
    twice = align_schema(once, M.INVOICES, M.DEFAULTS["invoices"])
    assert twice.schema == once.schema and twice.collect() == once.collect()
    new = spark.createDataFrame([(2, "B", "failed")], "invoice_id int, invoice_number string, status string")
    both = union_aligned(old, new, M.INVOICES, M.DEFAULTS["invoices"])
    assert sorted((r.invoice_id, r.status) for r in both.collect()) == [(1, "pending"), (2, "failed")]


def test_tables_round_trip_and_prune_by_month(spark, tmp_path):
    tables = project_tables(accepted(
        spark, document(invoice_number="1"), document(invoice_number="2", invoice_date="2025-01-05")))
    write_tables(tables, str(tmp_path))
    back = read_tables(spark, str(tmp_path))
    assert {n: t.count() for n, t in back.items()} == {n: t.count() for n, t in tables.items()}
    january = back["invoices"].filter("invoice_month = '2025-01'")
    assert january.count() == 1 and len(january.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(invoice_month" in january._jdf.queryExecution().executedPlan().toString()
