"""Approval actions as an append-only log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from inkledger.operators.approvals import apply_approvals, approval_responses
from inkledger.streaming.ingest import writer_of

ACTION_LOG = "action_id bigint, action_time timestamp_ntz, invoice_id string, action string"


def start_approvals(actions: DataFrame, log: str, checkpoint: str, available_now: bool = True,
                    interval: str = "1 minute") -> StreamingQuery:
    """Append arriving actions to the log, each once."""
    writer = (actions.writeStream.format("parquet").outputMode("append")
              .option("path", log).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_actions(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(ACTION_LOG).parquet(log)


def current_invoices(spark: SparkSession, invoices: DataFrame, vendors: DataFrame, log: str) -> DataFrame:
    """Invoices as the log leaves them."""
    return apply_approvals(invoices, vendors, read_actions(spark, log))


def start_answers(actions: DataFrame, tables: Callable[[], tuple[DataFrame, DataFrame]], out: str, checkpoint: str,
                  available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Answer every arriving action once, against invoices and vendors as ``tables()`` has them then.

    A batch's answers are a folder of its own, below the stream's name; a replayed batch
    replaces its folder.
    """
    source = writer_of(actions.sparkSession, checkpoint)

    def answer(batch: DataFrame, batch_id: int) -> None:
        invoices, vendors = tables()
        (approval_responses(batch, invoices, vendors).write.mode("overwrite")
         .parquet(f"{out}/source={source}/batch_id={batch_id}"))

    writer = actions.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_answers(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("source", "batch_id")
