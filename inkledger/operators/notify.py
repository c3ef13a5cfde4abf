"""Approval notifications for high-value invoices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkledger import model as M
from inkledger.functions.display import fmt_money, shown


def high_value(accepted: DataFrame, threshold: float = M.HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Every stored document above the threshold, whatever its status."""
    return accepted.filter(F.col("total_number") > threshold)


def notifications(accepted: DataFrame, endpoint: str, threshold: float = M.HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Subject and body per high-value document, with its approve and reject links."""
    def link(action: str):
        return F.concat(F.lit(f"{endpoint}?invoice_id="), F.col("invoice_id").cast("string"),
                        F.lit(f"&action={action}"))

    linked = (high_value(accepted, threshold)
              .withColumn("approve_url", link("approve")).withColumn("reject_url", link("reject")))
    limit = fmt_money(F.lit(float(threshold)))
    body = F.format_string(
        M.NOTICE_BODY, shown(F.col("invoice_number")), shown(F.col("company_name")),
        fmt_money(F.col("total_number")), shown(F.col("invoice_date")), shown(F.col("due_date")),
        shown(F.col("po_number")), shown(F.col("confidence_text")), limit,
        F.col("approve_url"), F.col("reject_url"))
    return linked.select(
        "invoice_id", "invoice_number",
        F.format_string(M.NOTICE_SUBJECT, shown(F.col("invoice_number"))).alias("subject"),
        body.alias("body"), "approve_url", "reject_url")
