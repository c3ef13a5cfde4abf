"""The invoice summary CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkledger.model import SUMMARY_CSV

CORRUPT = "_corrupt_record"


def read_summary_csv(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Eleven typed columns; with ``keep_corrupt`` unreadable rows stay, in ``_corrupt_record``."""
    schema = SUMMARY_CSV
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    mode = "PERMISSIVE" if keep_corrupt else "FAILFAST"
    return spark.read.csv(path, schema=schema, header=True, mode=mode, dateFormat="yyyy-MM-dd",
                          escape='"', columnNameOfCorruptRecord=CORRUPT)


def write_summary_csv(df: DataFrame, path: str) -> None:
    """Header and eleven columns, money with two decimals; values with commas are quoted."""
    out = df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in SUMMARY_CSV.fields])
    out.write.mode("overwrite").csv(path, header=True, dateFormat="yyyy-MM-dd", escape='"')
