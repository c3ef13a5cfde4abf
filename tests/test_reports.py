import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from inkledger.plans import dashboard, detail
from inkledger.functions.display import fmt_money, fmt_ts, month_label, status_class
from inkledger.sources import generator
from inkledger.sources.summary_csv import read_summary_csv, write_summary_csv

# Ten invoices with known totals.
ROWS = """INV-0001,2025-11-20,28450.71,2276.06,4267.61,26459.16
INV-0002,2025-10-22,34401.57,2752.13,0.00,37153.69
INV-0003,2025-11-12,51885.24,4150.82,5188.52,50847.53
INV-0004,2025-12-15,44674.98,3574.00,6701.25,41547.73
INV-0005,2025-10-26,8467.44,677.39,0.00,9144.83
INV-0006,2025-12-05,71681.08,5734.49,7168.11,70247.45
INV-0007,2025-11-16,30998.97,2479.92,0.00,33478.89
INV-0008,2025-11-15,28694.12,2295.53,2869.41,28120.23
INV-0009,2025-12-04,32591.36,2607.31,3259.14,31939.53
INV-0010,2025-12-22,32413.71,2593.10,4862.06,30144.75"""


@pytest.fixture(scope="module")
def ten(spark):
    rows = []
    for i, line in enumerate(ROWS.split("\n")):
        number, day, *amounts = line.split(",")
        total = Decimal(amounts[-1])
        rows.append((i + 1, number, 1, dt.date.fromisoformat(day), total,
                     "pending_review" if total > 50000 else "approved", dt.datetime(2025, 12, 24, 0, i), *map(Decimal, amounts[:3])))
    return spark.createDataFrame(
        rows, "invoice_id int, invoice_number string, vendor_id int, invoice_date date, total_amount decimal(12,2), "
              "status string, processed_at timestamp, subtotal decimal(12,2), tax_amount decimal(12,2), "
              "discount decimal(12,2)"), spark.createDataFrame([(1, "ACME")], "vendor_id int, vendor_name string")


def test_summary(spark, ten):
    row = dashboard.summary_totals(ten[0]).first()
    assert (row.total_invoices, row.total_amount) == (10, Decimal("359083.79"))
    assert row.avg_amount == pytest.approx(35908.379)
    empty = dashboard.summary_totals(ten[0].limit(0)).first()
    assert (empty.total_invoices, empty.total_amount, empty.avg_amount) == (0, None, None)
    assert tuple(dashboard.summary_display(ten[0].limit(0)).first()) == (0, "$0.00", "$0.00")


def test_months(ten):
    rows = dashboard.monthly_trend(ten[0]).collect()
    assert [(r.month.month, r.invoice_count, r.total_amount) for r in rows] == [
        (12, 4, Decimal("173879.46")), (11, 4, Decimal("138905.81")), (10, 2, Decimal("46298.52"))]
    bars = dashboard.monthly_trend_bars(ten[0], 2).collect()
    assert [b.label for b in bars] == ["November 2025", "December 2025"]
    assert bars[1].width_pct == 100.0 and bars[0].bar_text == "$138,906"


def test_statuses_and_vendors(spark, ten):
    rows = dashboard.status_breakdown(ten[0]).collect()
    assert [(r.status, r.invoice_count) for r in rows] == [("approved", 8), ("pending_review", 2)]
    bars = dashboard.status_breakdown_bars(ten[0]).collect()
    assert [(b.label, b.css_class, b.width_pct) for b in bars] == [
        ("APPROVED", "status-approved", 100.0), ("PENDING_REVIEW", "status-pending", 25.0)]
    assert tuple(dashboard.top_vendors(*ten).first()) == ("ACME", 10, Decimal("359083.79"))


def test_recent_puts_missing_times_first_and_needs_a_vendor(spark, ten):
    invoices, vendors = ten
    late = invoices.withColumn("processed_at", F.when(F.col("invoice_id") != 3, F.col("processed_at"))).withColumn(
        "vendor_id", F.when(F.col("invoice_id") != 10, F.col("vendor_id")))
    rows = dashboard.recent_invoices(late, vendors, 3).collect()
    assert [r.invoice_number for r in rows] == ["INV-0003", "INV-0009", "INV-0008"]
    orphaned = late.withColumn("vendor_id", F.when(F.col("invoice_id") == 9, 77).otherwise(F.col("vendor_id")))
    rows = dashboard.recent_invoices(orphaned, vendors, 3).collect()
    assert [r.invoice_number for r in rows] == ["INV-0003", "INV-0008", "INV-0007"]
    assert dashboard.recent_invoices_display(late, vendors, 1).first().processed == "N/A"


def test_dashboard_is_written(spark, ten, tmp_path):
    tables = {"invoices": ten[0], "vendors": ten[1]}
    dashboard.write_dashboard(tables, str(tmp_path), F.lit("2025-12-31 01:02:03").cast("timestamp"))
    counts = {n: spark.read.json(str(tmp_path / n)).count() for n in ("summary", "monthly", "status", "vendors", "recent")}
    assert counts == {"summary": 1, "monthly": 3, "status": 2, "vendors": 1, "recent": 10}
    assert spark.read.json(str(tmp_path / "summary")).first().generated_on == "2025-12-31 01:02:03"


def test_latest_report(spark, ten):
    invoices, vendors = ten
    full = invoices.selectExpr("*", "date_add(invoice_date, 30) due_date", "cast(90.5 as decimal(5,2)) confidence_score",
                               "cast(null as string) po_number", "'NET' payment_terms")
    shown = detail.latest_invoice_display(full, vendors).first()
    assert shown.invoice_number == "INV-0010" and shown.discount == "-$4,862.06"
    assert shown.po_number == "None" and shown.confidence == "90.50%"
    lines = spark.createDataFrame(
        [(10, 2, "b", Decimal("2"), Decimal("1.5"), Decimal("3")), (10, 1, "a", Decimal("1"), None, Decimal("4")),
         (9, 1, "c", Decimal("1"), Decimal("1"), Decimal("1"))],
        "invoice_id int, line_number int, description string, quantity decimal(10,2), unit_price decimal(12,2), "
        "amount decimal(12,2)")
    texts = [r.display for r in detail.latest_lines_display(invoices, lines).collect()]
    assert texts == ["a: 1.00 x $0.00 = $4.00", "b: 2.00 x $1.50 = $3.00"]
    assert detail.latest_line_total(invoices, lines).first().shown_total == "$7.00"
    banks = spark.createDataFrame([(2, 1, "B2", "a", "r"), (1, 1, "B1", "a", "r")],
                                  "bank_id int, vendor_id int, bank_name string, account_number string, routing_number string")
    assert detail.latest_bank(invoices, banks).first().bank_name == "B1"


def test_money_keeps_the_digits_of_decimals(spark):
    row = spark.sql("select cast('123456789012345678.91' as decimal(38,2)) as d, cast(-1234.5 as double) as f").select(
        fmt_money(F.col("d")), fmt_money(F.col("f"))).first()
    assert tuple(row) == ("$123,456,789,012,345,678.91", "$-1,234.50")


def test_display_forms(spark):
    row = spark.range(1).select(
        fmt_money(F.lit(0.125)), fmt_money(F.lit(-1234.5)), fmt_money(F.lit(None).cast("double")),
        fmt_money(F.lit(2.5), 0), month_label(F.lit(None).cast("date")),
        fmt_ts(F.lit("2025-01-02 03:04:05").cast("timestamp"), True), status_class(F.lit("rejected"))).first()
    assert tuple(row) == ("$0.12", "$-1,234.50", "$0.00", "$2", "Unknown", "2025-01-02 03:04:05", "status-pending")


def test_generator_is_the_same_at_any_partitioning(spark):
    day = F.lit("2025-12-31").cast("date")
    one = generator.generate_extractions(spark, 300, day, seed=4, partitions=1)
    many = generator.generate_extractions(spark, 300, day, seed=4, partitions=7)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    other = generator.generate_extractions(spark, 300, day, seed=5)
    assert one.select("raw").intersect(other.select("raw")).count() == 0


def test_generated_invoices_follow_the_rules(spark):
    rows = generator.generate_invoices(spark.range(1, 2001), F.lit("2025-12-31").cast("date")).collect()
    assert {len(r.lines) for r in rows} == {3, 4, 5, 6, 7, 8}
    assert all((r.due_date - r.invoice_date).days == 30 and 1 <= (dt.date(2025, 12, 31) - r.invoice_date).days <= 90
               for r in rows)
    assert all(x.amount == x.quantity * x.unit_price and 1 <= x.quantity <= 100 and x.unit_price < 201
               for r in rows for x in r.lines)
    assert all(r.total == r.subtotal - r.discount + r.tax for r in rows)
    assert 0.25 < sum(r.discount > 0 for r in rows) / len(rows) < 0.35


def test_generated_documents_are_accepted(spark):
    from inkledger.operators.decide import process_documents
    from inkledger.operators.extract import extract_flatten
    docs = generator.generate_extractions(spark, 50, F.lit("2025-12-31").cast("date"))
    rows = process_documents(extract_flatten(docs)).collect()
    assert all(r.error is None and r.is_valid and len(r.lines) == len(r.line_items) for r in rows)


def test_summary_csv_round_trip_quotes_commas(spark, tmp_path):
    rows = generator.summary_rows(generator.generate_invoices(spark.range(1, 21), F.lit("2025-12-31").cast("date")))
    rows = rows.withColumn("Customer", F.lit('Smith, "Bob"'))
    write_summary_csv(rows, str(tmp_path / "s"))
    back = read_summary_csv(spark, str(tmp_path / "s"))
    assert back.exceptAll(rows).count() == 0 and back.count() == 20
    (tmp_path / "bad.csv").write_text("Invoice Number,Vendor\nINV-1,x,y,z,notadate\n")
    kept = read_summary_csv(spark, str(tmp_path / "bad.csv"), keep_corrupt=True).first()
    assert kept["_corrupt_record"] is not None
