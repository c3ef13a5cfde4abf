"""Which source file goes where once its invoice is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkledger.functions.parse import job_id_from_key
from inkledger.model import JOB_TAG


def source_of_job(files: DataFrame) -> DataFrame:
    """The first file key per job id tag; ``files`` has ``key`` and ``tags`` (map)."""
    return (files.select("key", F.col("tags")[JOB_TAG].alias("job_id"))
            .filter(F.col("job_id").isNotNull())
            .groupBy("job_id").agg(F.min("key").alias("source_key")))


def match_source_files(results: DataFrame, files: DataFrame) -> DataFrame:
    """Results with the source file that carries their job id, or none.

    The file side has one row per job, so AQE can split a job id that many results share.
    """
    return (results.withColumn("job_id", job_id_from_key(F.col("s3_key")))
            .join(source_of_job(files), "job_id", "left"))


def routing_manifest(invoices: DataFrame, files: DataFrame, incoming: str, processed: str, failed: str) -> DataFrame:
    """A move per stored invoice: approved to ``processed``, any other status to ``failed``.

    A result without source file gets a row without destination.
    """
    return moves(match_source_files(invoices, files), incoming, processed, failed)


def moves(matched: DataFrame, incoming: str, processed: str, failed: str) -> DataFrame:
    """The moves of results that are matched with their source file, or with none."""
    target = F.when(F.col("status") == "approved", F.lit(processed)).otherwise(F.lit(failed))
    have = F.col("source_key").isNotNull()
    return matched.select(
        "invoice_number", "status", "job_id", "source_key",
        F.when(have, F.concat(F.lit(f"s3://{incoming}/"), "source_key")).alias("source"),
        F.when(have, F.concat(F.lit("s3://"), target, F.lit("/"), "source_key")).alias("destination"),
        F.when(~have, F.lit("no source file")).when(F.col("status") == "approved", F.lit("approved"))
        .otherwise(F.concat(F.lit("status: "), "status")).alias("reason"))
