"""Queries that look at one thing several times work it out once; what grows with a store stays small in a task."""

import pytest
from pyspark.sql import functions as F

from inkledger.checks import fixture as X
from inkledger.checks import queries, store_queries
from inkledger.operators.decide import ACCEPTED
from inkledger.session import write_by
from inkledger.streaming import numbers

SMALL = "/root/testdata/sf0.001"


def counted(spark, make):
    """``make`` with every row counted that tasks work out."""
    seen = spark.sparkContext.accumulator(0)

    def pass_on(value):
        seen.add(1)
        return True

    passed = F.udf(pass_on, "boolean").asNondeterministic()

    def counting(*args, **more):
        made = make(*args, **more)
        tables = made if isinstance(made, dict) else {"": made}
        tables = {name: df.filter(passed(F.col(df.columns[0]).cast("string"))) for name, df in tables.items()}
        return tables if isinstance(made, dict) else tables[""]

    return counting, seen


@pytest.mark.parametrize("name, module, source", [
    ("merge_vendors", X, "accepted"), ("stream_routing", X, "invoices"), ("constraint_audit", X, "extracted"), ("audit_delta", store_queries, "broken_tables")])
def test_sources_are_worked_out_once(spark, monkeypatch, name, module, source):
    made = getattr(module, source)(spark, SMALL)
    rows = sum(df.count() for df in made.values()) if isinstance(made, dict) else made.count()
    counting, seen = counted(spark, getattr(module, source))
    monkeypatch.setattr(module, source, counting)
    queries.registry()[name](spark, SMALL).collect()
    assert seen.value == rows


def test_filters_are_the_bits_of_their_numbers(spark, tmp_path):
    rows = 20_000
    numbers.write_numbers(spark.range(rows).select(F.concat(F.lit("N-"), "id").alias("invoice_number")), rows, str(tmp_path))
    kept = spark.read.schema(numbers.KEYS).parquet(f"{tmp_path}/keys").withColumn("level", F.lit(numbers.level_of(rows)))
    spots = kept.select("level", numbers._bucket(F.col("level")).alias("bucket"), F.explode(numbers._probes()).alias("spot"))
    expected = {(r.level, r.bucket): bytes(r.bits) for r in spots.groupBy("level", "bucket").agg(F.bitmap_construct_agg("spot").alias("bits")).collect()}
    got = spark.read.schema(numbers.FILTERS).parquet(f"{tmp_path}/filters").collect()
    assert len(got) == len(expected) > 8 and {(r.level, r.bucket): bytes(r.bits) for r in got} == expected


def test_a_part_of_the_history_is_many_files(spark, tmp_path):
    rows = 1_200_000
    numbers.write_numbers(spark.range(rows).select(F.col("id").cast("string").alias("invoice_number")), rows, str(tmp_path))
    assert len(spark.read.parquet(f"{tmp_path}/keys").inputFiles()) == 3
    held = numbers.suspects(spark, {str(tmp_path): rows}, spark.range(rows - 5, rows + 995).select(F.col("id").cast("string").alias("invoice_number")))
    assert 5 <= held.count() < 15


def test_outcomes_are_written_without_a_sort(spark, tmp_path):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(0, 1000, 1, 2).select("id", F.when(F.col("id") % 3 == 0, ACCEPTED).otherwise("error").alias("outcome"))
    write_by(rows, "outcome", str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    # a row stays where it was among its outcome's; one file a task and outcome
    assert sorted((r.id, r.outcome) for r in back.collect()) == sorted((r.id, r.outcome) for r in rows.collect())
    assert len(back.inputFiles()) == 4
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
