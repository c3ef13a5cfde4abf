"""The dashboard of a store as it grows: its results from the partial ones that each commit keeps, not from documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkledger.functions.display import fmt_ts
from inkledger.operators.store import vendors_of
from inkledger.plans.dashboard import WIDE, latest
from inkledger.streaming.commits import COMMIT, read_state
from inkledger.streaming.ingest import read_partial
from inkledger.streaming.kept import SUMS, read_kept

#: The five result sets, by the names of the batch dashboard.
RESULTS = ("summary", "monthly", "status", "vendors", "recent")


def _sums(spark: SparkSession, out: str) -> DataFrame:
    merged = read_kept(spark, read_state(spark, out).folders("sums"), "sums")
    return spark.createDataFrame([], SUMS) if merged is None else merged


def status_totals(spark: SparkSession, out: str) -> DataFrame:
    """Count and sum per status of a store."""
    return _sums(spark, out).filter("kind = 'status'").select(F.col("key").alias("status"), "invoice_count", "total_amount")


def stored_vendors(spark: SparkSession, out: str) -> DataFrame:
    """The vendor table of a store from its kept vendor states."""
    return vendors_of(read_partial(spark, out, "vendors"))


def live_dashboard(spark: SparkSession, out: str, months: int = 12, vendors: int = 5, recent: int = 10) -> dict[str, DataFrame]:
    """The five result sets of ``plans.dashboard.dashboard`` for a store with at least one batch.

    Sums are exact however many commits they come from: every vendor's partial sums are merged before the
    first ``vendors`` are taken.  ``recent`` may be up to ``kept.NEWEST``.
    """
    sums = _sums(spark, out)
    of = lambda kind: sums.filter(F.col("kind") == kind)
    summary = of("status").agg(
        F.coalesce(F.sum("invoice_count"), F.lit(0)).alias("total_invoices"), F.sum("total_amount").cast(WIDE).alias("total_amount"),
        F.sum("given").alias("_given")).withColumn("avg_amount", F.when(
            F.col("_given") > 0, F.col("total_amount").cast("double") / F.col("_given"))).drop("_given")
    newest = read_partial(spark, out, "newest")
    return {
        "summary": summary,
        "monthly": of("month").filter("key IS NOT NULL").select(F.col("key").cast("date").alias("month"), "invoice_count", "total_amount")
        .orderBy(F.desc("month")).limit(months),
        "status": of("status").select(F.col("key").alias("status"), "invoice_count", "total_amount")
        .orderBy(F.desc("invoice_count"), F.asc_nulls_first("status")),
        "vendors": of("vendor").filter("key IS NOT NULL").select(F.col("name").alias("vendor_name"), "invoice_count", "total_amount")
        .orderBy(F.desc_nulls_first("total_amount"), F.asc("vendor_name")).limit(vendors),
        "recent": latest(newest, recent).select("invoice_number", "vendor_name", "total_amount", "status", "processed_at"),
    }


def start_dashboard(spark: SparkSession, out: str, path: str, checkpoint: str, available_now: bool = True,
                    interval: str = "1 minute", generated_at: Column | None = None) -> StreamingQuery:
    """Publish the current five results of the store ``out`` at ``path`` whenever something was committed.

    The stream follows the log and only tells that there are commits; what is published is read from the
    parts as they are.  Updates take turns between two folders, so readers keep the previous one while
    the next is written; ``current`` is written last and names the complete one.
    """
    arrived = spark.readStream.schema(COMMIT).json(f"{out}/commits")

    def publish(batch: DataFrame, batch_id: int) -> None:
        session, turn = batch.sparkSession, f"turn={batch_id % 2}"
        if not read_state(session, out).folders("sums"):
            return
        stamp = fmt_ts(F.current_timestamp() if generated_at is None else generated_at, seconds=True)
        for name, df in live_dashboard(session, out).items():
            df.withColumn("generated_on", stamp).coalesce(1).write.mode("overwrite").parquet(f"{path}/{turn}/{name}")
        told = session.range(1).select(F.lit(batch_id).cast("bigint").alias("update"), F.lit(turn).alias("turn"))
        told.coalesce(1).write.mode("append").parquet(f"{path}/current")

    writer = arrived.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_published(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The five results as last published."""
    turn = spark.read.parquet(f"{path}/current").orderBy(F.desc("update")).first()["turn"]
    return {name: spark.read.parquet(f"{path}/{turn}/{name}").drop("generated_on") for name in RESULTS}


def read_dashboard(spark: SparkSession, path: str) -> DataFrame:
    """Count and sum per status as last published."""
    return read_published(spark, path)["status"]
