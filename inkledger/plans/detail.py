"""Invoice listing and the report on the latest invoice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkledger.functions.display import fmt_money, line_display, shown
from inkledger.plans.dashboard import latest, latest_with_vendor


def invoice_listing(invoices: DataFrame, vendors: DataFrame, n: int = 10, enforced_keys: bool = False) -> DataFrame:
    return latest_with_vendor(invoices, vendors, n, enforced_keys).select(
        "invoice_id", "invoice_number", "vendor_name", "total_amount", "status", "processed_at")


def latest_invoice_detail(invoices: DataFrame, vendors: DataFrame, enforced_keys: bool = False) -> DataFrame:
    return latest_with_vendor(invoices, vendors, 1, enforced_keys).select(
        "invoice_number", "vendor_name", "invoice_date", "due_date", "subtotal", "discount",
        "tax_amount", "total_amount", "status", "confidence_score", "po_number", "payment_terms")


def latest_invoice_display(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """The detail as shown: money texts, the discount with a minus, the score in percent."""
    row = latest_invoice_detail(invoices, vendors)
    return row.select(
        "invoice_number", "vendor_name", "invoice_date", "due_date",
        shown(F.col("po_number")).alias("po_number"), shown(F.col("payment_terms")).alias("payment_terms"),
        fmt_money(F.col("subtotal")).alias("subtotal"),
        F.concat(F.lit("-"), fmt_money(F.abs("discount"))).alias("discount"),
        fmt_money(F.col("tax_amount")).alias("tax"), fmt_money(F.col("total_amount")).alias("total"),
        "status", F.concat(shown(F.col("confidence_score")), F.lit("%")).alias("confidence"))


def _latest_value(invoices: DataFrame, column: str):
    """The latest invoice's column as a scalar subquery, which reaches the scan as a filter."""
    return latest(invoices, 1).select(column).scalar()


def latest_lines(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    mine = lines.filter(F.col("invoice_id") == _latest_value(invoices, "invoice_id"))
    return mine.select("line_number", "description", "quantity", "unit_price", "amount").orderBy("line_number")


def latest_lines_display(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    return line_display(latest_lines(invoices, lines)).orderBy("line_number")


def latest_line_total(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Sum of the latest invoice's line amounts, 0 when it has none."""
    mine = lines.filter(F.col("invoice_id") == _latest_value(invoices, "invoice_id"))
    total = mine.agg(F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(38,2)").alias("line_total"),
                     F.count(F.lit(1)).alias("line_count"))
    return total.withColumn("shown_total", fmt_money(F.col("line_total")))


def latest_bank(invoices: DataFrame, banks: DataFrame) -> DataFrame:
    """One bank row of the latest invoice's vendor, the one with the smallest id."""
    mine = banks.filter(F.col("vendor_id") == _latest_value(invoices, "vendor_id"))
    return mine.orderBy("bank_id").limit(1).select("bank_name", "account_number", "routing_number")
