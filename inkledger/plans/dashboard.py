"""The dashboard: totals, monthly trend, status and vendor breakdowns, recent invoices."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkledger.functions.display import (
    fmt_money, fmt_ts, month_label, pct_of_max, status_class, status_label,
)

WIDE = "decimal(38,2)"


def _total() -> Column:
    return F.sum("total_amount").cast(WIDE)


def summary_totals(invoices: DataFrame) -> DataFrame:
    """Count, sum and average; an empty table gives 0, null, null."""
    return (invoices.agg(F.count(F.lit(1)).alias("total_invoices"), _total().alias("total_amount"),
                         F.count("total_amount").alias("_given"))
            .withColumn("avg_amount", F.when(
                F.col("_given") > 0, F.col("total_amount").cast("double") / F.col("_given")))
            .drop("_given"))


def summary_display(invoices: DataFrame) -> DataFrame:
    totals = summary_totals(invoices)
    return totals.select("total_invoices", fmt_money(F.col("total_amount")).alias("total_amount"),
                         fmt_money(F.col("avg_amount")).alias("avg_amount"))


def monthly_trend(invoices: DataFrame, n: int = 12) -> DataFrame:
    """Count and sum of the newest ``n`` months, newest first."""
    return (invoices.filter(F.col("invoice_date").isNotNull())
            .groupBy(F.trunc("invoice_date", "MM").alias("month"))
            .agg(F.count(F.lit(1)).alias("invoice_count"), _total().alias("total_amount"))
            .orderBy(F.desc("month")).limit(n))


def monthly_trend_bars(invoices: DataFrame, n: int = 12) -> DataFrame:
    """The same months oldest first, with label, bar width and money texts."""
    return pct_of_max(monthly_trend(invoices, n), "total_amount").orderBy("month").select(
        "month", month_label(F.col("month")).alias("label"), "invoice_count",
        fmt_money(F.col("total_amount")).alias("amount"),
        fmt_money(F.col("total_amount"), 0).alias("bar_text"), "width_pct")


def status_breakdown(invoices: DataFrame) -> DataFrame:
    """Count and sum per status, most frequent first; a missing status is a group."""
    return (invoices.groupBy("status")
            .agg(F.count(F.lit(1)).alias("invoice_count"), _total().alias("total_amount"))
            .orderBy(F.desc("invoice_count"), F.asc_nulls_first("status")))


def status_breakdown_bars(invoices: DataFrame) -> DataFrame:
    return pct_of_max(status_breakdown(invoices), "invoice_count").orderBy(
        F.desc("invoice_count"), F.asc_nulls_first("status")).select(
        status_label(F.col("status")).alias("label"), status_class(F.col("status")).alias("css_class"),
        "invoice_count", fmt_money(F.col("total_amount")).alias("amount"), "width_pct")


def top_vendors(invoices: DataFrame, vendors: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` vendors with the largest sums.

    Sums are made per vendor id before names are joined, so the join sees one row per
    vendor.  Vendor names are unique, which makes this the same as grouping by name.
    """
    sums = (invoices.filter(F.col("vendor_id").isNotNull()).groupBy("vendor_id")
            .agg(F.count("invoice_id").alias("invoice_count"), _total().alias("total_amount")))
    return (sums.join(vendors.select("vendor_id", "vendor_name"), "vendor_id")
            .select("vendor_name", "invoice_count", "total_amount")
            .orderBy(F.desc_nulls_first("total_amount"), F.asc("vendor_name")).limit(n))


def top_vendors_display(invoices: DataFrame, vendors: DataFrame, n: int = 5) -> DataFrame:
    return top_vendors(invoices, vendors, n).select(
        "vendor_name", "invoice_count", fmt_money(F.col("total_amount")).alias("amount"))


def with_vendor(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Inner join on vendor_id; Spark broadcasts vendors only when small by its own estimate."""
    return invoices.join(vendors.select("vendor_id", "vendor_name"), "vendor_id")


def latest(invoices: DataFrame, n: int) -> DataFrame:
    """The ``n`` most recently processed, missing times first, ties by id."""
    return invoices.orderBy(F.desc_nulls_first("processed_at"), F.asc("invoice_id")).limit(n)


def latest_with_vendor(invoices: DataFrame, vendors: DataFrame, n: int, enforced_keys: bool = False) -> DataFrame:
    """The ``n`` latest invoices that have a vendor, in order, with its name.

    Invoices are held to vendors that exist by a semi-join on the id alone; the top ``n`` of
    those are then joined to names.  Nothing in Spark enforces the foreign key; a caller who
    knows that it holds can say ``enforced_keys`` and spare the semi-join.
    """
    there = invoices.filter(F.col("vendor_id").isNotNull())
    if not enforced_keys:
        there = there.join(vendors.select("vendor_id"), "vendor_id", "left_semi")
    return latest(with_vendor(latest(there, n), vendors), n)


def recent_invoices(invoices: DataFrame, vendors: DataFrame, n: int = 10, enforced_keys: bool = False) -> DataFrame:
    return latest_with_vendor(invoices, vendors, n, enforced_keys).select(
        "invoice_number", "vendor_name", "total_amount", "status", "processed_at")


def recent_invoices_display(invoices: DataFrame, vendors: DataFrame, n: int = 10) -> DataFrame:
    return recent_invoices(invoices, vendors, n).select(
        "invoice_number", "vendor_name", fmt_money(F.col("total_amount")).alias("amount"),
        status_label(F.col("status")).alias("label"), status_class(F.col("status")).alias("css_class"),
        fmt_ts(F.col("processed_at")).alias("processed"))


def dashboard(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five result sets, lazy and independent of each other."""
    invoices, vendors = tables["invoices"], tables["vendors"]
    return {
        "summary": summary_totals(invoices),
        "monthly": monthly_trend(invoices),
        "status": status_breakdown(invoices),
        "vendors": top_vendors(invoices, vendors),
        "recent": recent_invoices(invoices, vendors),
    }


def write_dashboard(tables: Mapping[str, DataFrame], path: str, generated_at: Column | None = None) -> None:
    """The result sets as JSON folders; each has at most a few rows, bar the status domain's size."""
    stamp = fmt_ts(F.current_timestamp() if generated_at is None else generated_at, seconds=True)
    for name, df in dashboard(tables).items():
        df.withColumn("generated_on", stamp).write.mode("overwrite").json(f"{path}/{name}")
