import random

import pytest

from inkledger.operators.hot import left_join_spread, number_within, previous_within, scanned_sizes


@pytest.fixture(scope="module")
def skewed(spark):
    """A key with half of the rows, all at one time, rows without key, and ordinary keys with many ties."""
    draw = random.Random(3)
    rows = [(7, 5, i, f"v{i}") if i % 2 else (None if i % 12 == 0 else i % 60 + 100, draw.randrange(40), i, f"v{i}") for i in range(4000)]
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k bigint, t bigint, id bigint, v string").repartition(5)


def brute(rows):
    place, previous, last, seen = {}, {}, {}, {}
    for k, _, i, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        seen[k] = seen.get(k, 0) + 1
        place[i], previous[i], last[k] = seen[k], last.get(k), v
    return place, previous


@pytest.mark.parametrize("tasks", [1, 3, 16])
@pytest.mark.parametrize("rows_a_batch", [10000, 7])
def test_numbers_and_neighbours_are_exact(spark, skewed, tasks, rows_a_batch):
    rows, df = skewed
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_a_batch))
    try:
        numbered = number_within(df, "k", ["t", "id"], "n")
        stepped = previous_within(df, "k", ["t", "id"], "v", "p")
        place, previous = brute(rows)
        assert {r.id: r.n for r in numbered.collect()} == place and numbered.columns == ["k", "t", "id", "v", "n"]
        assert {r.id: r.p for r in stepped.collect()} == previous and stepped.columns == ["k", "t", "id", "v", "p"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_key_with_half_of_all_rows_at_one_time_is_dealt_evenly(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = scanned_sizes(skewed[1], "k", ["t", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and sum(sizes) == 4000 and max(sizes) < 2 * 4000 / 4


def test_one_key_in_all_tasks_and_empty_tables(spark):
    df = spark.range(1000).selectExpr("1 AS k", "id AS t", "if(id % 3 = 0, NULL, id) AS v")
    assert {r.t: r.n for r in number_within(df, "k", ["t"], "n").collect()} == {i: i + 1 for i in range(1000)}
    assert {r.t: r.p for r in previous_within(df, "k", ["t"], "v", "p").collect()} == {
        i: None if i == 0 or (i - 1) % 3 == 0 else i - 1 for i in range(1000)}
    assert number_within(df.limit(0), "k", ["t"], "n").count() == 0
    decimals = df.selectExpr("cast(k AS decimal(38,0)) AS k", "t", "cast(v AS decimal(38,2)) AS v")
    assert previous_within(decimals, "k", ["t"], "v", "p").filter("p IS NULL").count() == 334


def test_left_join_spread_is_a_left_join(spark):
    left = spark.createDataFrame([(1, 5), (2, None), (3, None), (4, 6), (5, 5)], "id int, k int")
    right = spark.createDataFrame([(5, "a"), (7, "b"), (None, "c")], "k int, v string")
    got = {r.id: r.v for r in left_join_spread(left, right, "k", "id").collect()}
    assert got == {1: "a", 2: None, 3: None, 4: None, 5: "a"}
