"""Approve/reject actions against stored invoices.

Actions form an append-only log: ``action_id`` (bigint), ``action_time`` (timestamp),
``invoice_id`` (text), ``action`` (text).  The current state of an invoice is its initial
state overlaid with the last valid action; there is no guard on the previous state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkledger import model as M
from inkledger.functions.display import fmt_money, fmt_ts
from inkledger.functions.parse import new_status
from inkledger.operators.hot import left_join_spread, previous_within

ACTIONS = ("approve", "reject")
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def _blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def _target(invoices: DataFrame) -> Column:
    """The action's id text as the invoices' id type; null when it is no whole number."""
    dtype = invoices.schema["invoice_id"].dataType
    return F.when(F.col("invoice_id").rlike(WHOLE_NUMBER), F.trim("invoice_id").try_cast(dtype))


def _look_up(asked: DataFrame, invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Each request with its invoice and vendor; the vendor join sees request rows only."""
    stored = invoices.select(
        F.col("invoice_id").alias("_target"), "vendor_id", "invoice_number", "total_amount",
        F.col("status").alias("initial_status"), F.col("processed_at").alias("stored_at"))
    names = vendors.select("vendor_id", "vendor_name")
    # requests that ask for nothing, or find nothing, have no key to join on
    found = left_join_spread(asked, stored, "_target", "action_id")
    return left_join_spread(found, names, "vendor_id", "action_id").drop("vendor_id")


def classify_actions(actions: DataFrame, invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Response class per action: 400 bad request, 500 id is no number, 404 not found, 200 applied.

    An invoice stored after the action was not there to be found.  An optional boolean
    ``no_parameters`` marks requests without any parameter object (500).
    """
    # bad requests look nothing up, so they stay out of the join
    asked = actions.withColumn("_target", F.when(F.col("action").isin(*ACTIONS), _target(invoices)))
    found = _look_up(asked, invoices, vendors)
    missing = _blank(F.col("invoice_id")) | _blank(F.col("action"))
    present = F.col("vendor_name").isNotNull() & (F.col("action_time") >= F.col("stored_at"))
    no_parameters = F.col("no_parameters") if "no_parameters" in actions.columns else F.lit(False)
    code = (F.when(no_parameters, 500).when(missing, 400)
            .when(~F.col("action").isin(*ACTIONS), 400)
            .when(F.col("_target").isNull(), 500)
            .when(present, 200).otherwise(404))
    return found.withColumn("status_code", code)


def approval_responses(actions: DataFrame, invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """What each request is answered: code, title and, when applied, the invoice's facts."""
    answered = classify_actions(actions, invoices, vendors)
    applied = F.col("status_code") == 200
    missing = _blank(F.col("invoice_id")) | _blank(F.col("action"))
    title = (F.when(applied & (F.col("action") == "approve"), F.lit("Invoice Approved"))
             .when(applied, F.lit("Invoice Rejected"))
             .when(F.col("status_code") == 404, F.lit(M.INVOICE_NOT_FOUND))
             .when((F.col("status_code") == 400) & missing, F.lit(M.MISSING_PARAMETER))
             .when(F.col("status_code") == 400, F.lit(M.UNKNOWN_ACTION))
             .otherwise(F.lit("Error: invoice_id is not a number")))
    return answered.select(
        "action_id", "status_code", title.alias("title"),
        F.when(applied, F.col("invoice_number")).alias("invoice_number"),
        F.when(applied, F.col("vendor_name")).alias("vendor_name"),
        F.when(applied, fmt_money(F.col("total_amount"))).alias("amount"),
        F.when(applied, new_status(F.col("action"))).alias("new_status"),
        F.when(applied, F.col("action_time")).alias("action_time"))


def last_actions(actions: DataFrame, invoices: DataFrame) -> DataFrame:
    """The last approve/reject per invoice id, aggregated before it meets the invoices.

    If the last one came before the invoice was stored, so did all others.  The last time per
    invoice is found by hash aggregation; only the actions at that time are looked at further.
    """
    asked = (actions.filter(F.col("action").isin(*ACTIONS))
             .select(_target(invoices).alias("invoice_id"), "action", "action_time", "action_id")
             .filter(F.col("invoice_id").isNotNull()))
    newest = asked.groupBy("invoice_id").agg(F.max("action_time").alias("action_time"))
    return (asked.join(newest, ["invoice_id", "action_time"]).groupBy("invoice_id")
            .agg(F.max_by(F.struct("action", "action_time"), F.struct("action_time", "action_id")).alias("_last")))


def apply_approvals(invoices: DataFrame, vendors: DataFrame | None, actions: DataFrame) -> DataFrame:
    """Invoices with their current status; ``processed_at`` becomes the time of the last action.

    An invoice without vendor is never found.  Pass ``vendors=None`` where the foreign
    key is known to hold: a null ``vendor_id`` is then the only way to have none.
    """
    overlaid = invoices.join(last_actions(actions, invoices), "invoice_id", "left")
    if vendors is None:
        overlaid = overlaid.withColumn("_vendor", F.col("vendor_id").isNotNull())
    else:
        overlaid = overlaid.join(vendors.select("vendor_id", F.lit(True).alias("_vendor")), "vendor_id", "left")
    applies = F.col("_vendor") & (F.col("_last.action_time") >= F.col("processed_at"))
    current = {"status": new_status(F.col("_last.action")), "processed_at": F.col("_last.action_time")}
    return overlaid.select(*[
        F.when(applies, current[c]).otherwise(F.col(c)).alias(c) if c in current else F.col(c)
        for c in invoices.columns])


def _applied_in_order(invoices: DataFrame, vendors: DataFrame, actions: DataFrame) -> DataFrame:
    """Applied actions with ``previous_status`` and ``new_status``.

    The new status does not depend on the previous one, so only the neighbour is needed, whatever
    share of the actions one invoice has.
    """
    applied = (classify_actions(actions, invoices, vendors).filter(F.col("status_code") == 200)
               .select("action_id", "action_time", "action", F.col("_target").alias("invoice_id"), "invoice_number",
                       "vendor_name", "total_amount", "initial_status", new_status(F.col("action")).alias("new_status")))
    stepped = previous_within(applied, "invoice_id", ["action_time", "action_id"], "new_status", "_previous")
    return stepped.withColumn("previous_status", F.coalesce("_previous", "initial_status"))


def status_history(invoices: DataFrame, vendors: DataFrame, actions: DataFrame) -> DataFrame:
    """Previous and new status of every applied action, in the order of the log."""
    return _applied_in_order(invoices, vendors, actions).select(
        "action_id", "invoice_id", "invoice_number", "previous_status", "new_status", "action_time")


def approval_pages(invoices: DataFrame, vendors: DataFrame, actions: DataFrame) -> DataFrame:
    """What the page shown after each applied action says."""
    label = F.when(F.col("action") == "approve", F.lit("Approved")).otherwise(F.lit("Rejected"))
    return _applied_in_order(invoices, vendors, actions).select(
        "action_id", F.concat(F.lit("Invoice "), label).alias("title"), "invoice_number", "vendor_name",
        fmt_money(F.col("total_amount")).alias("amount"), "previous_status", "new_status",
        fmt_ts(F.col("action_time"), seconds=True).alias("action_time"))
