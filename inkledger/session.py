"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "inkledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    ``master`` is left to the launcher when None.  AQE with skew-join splitting is
    what cuts a hot join key into several tasks; RocksDB keeps streaming state off
    the JVM heap.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="inkledger-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


#: Bytes of a row group where rows are texts to be parsed: files of well packed texts still split among many tasks.
ROW_GROUP = 16 << 20


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a fresh shared folder and read again, for results that a query uses more than once."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by(df: DataFrame, column: str, path: str) -> None:
    """``df`` written below ``path`` by the few values of ``column``.

    Tasks keep a file open per value (at most eight) instead of sorting their wide rows by it; with more
    values Spark goes on with sorted rows.
    """
    spark, name = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "8")
    try:
        df.write.partitionBy(column).parquet(path)
    finally:
        spark.conf.set(name, before)
