"""What a store keeps beside its documents, so that reports need not read them.

Each is a table of partial results per commit that merges with others of its kind: sums per status, month
and vendor; the newest invoices; and per vendor what its first document fixed and its last one set.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkledger.operators.store import merge_vendor_states, vendor_state
from inkledger.plans.dashboard import WIDE, latest

#: Newest invoices that a commit keeps; a report may show as many.
NEWEST = 100
SUMS = f"kind string, key string, name string, invoice_count bigint, given bigint, total_amount {WIDE}"


class Kept(NamedTuple):
    """Partial results: from accepted documents, and from several of their own kind."""

    build: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


def _sums(accepted: DataFrame) -> DataFrame:
    def entry(kind: str, key, name=None):
        shown = F.lit(None).cast("string") if name is None else F.col(name)
        return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), shown.alias("name"))

    entries = F.array(entry("status", F.col("status")), entry("month", F.trunc("invoice_day", "MM")),
                      entry("vendor", F.col("vendor_id"), "company_name"))
    return (accepted.select(F.inline(entries), "total_value").groupBy("kind", "key", "name")
            .agg(F.count(F.lit(1)).alias("invoice_count"), F.count("total_value").alias("given"),
                 F.sum("total_value").cast(WIDE).alias("total_amount")))


def _merged_sums(sums: DataFrame) -> DataFrame:
    return sums.groupBy("kind", "key", "name").agg(
        F.sum("invoice_count").alias("invoice_count"), F.sum("given").alias("given"), F.sum("total_amount").cast(WIDE).alias("total_amount"))


def _newest(accepted: DataFrame) -> DataFrame:
    return latest(accepted.select("invoice_id", "invoice_number", F.col("company_name").alias("vendor_name"),
                                  F.col("total_value").alias("total_amount"), "status", "processed_at"), NEWEST)


KEPT: dict[str, Kept] = {
    "sums": Kept(_sums, _merged_sums),
    "newest": Kept(_newest, lambda rows: latest(rows, NEWEST)),
    "vendors": Kept(vendor_state, lambda states: merge_vendor_states(states)),
}


def read_kept(spark: SparkSession, folders: list[str], name: str) -> DataFrame | None:
    """The merged partial results of these folders; None when there are none."""
    return KEPT[name].merge(spark.read.parquet(*folders)) if folders else None
