"""The permutation, and shards and slots from it."""

import pytest
from pyspark.sql import functions as F

from inkledger.llm.sharding import grid, number_at, permuted, place_of, shard_rows


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 24, 97, 1000, 1009])
def test_permutation_inverse_and_driver_form(spark, rows):
    df = spark.range(rows).select("id", permuted(F.col("id"), rows, 5).alias("place"))
    places = {r["id"]: r["place"] for r in df.collect()}
    assert sorted(places.values()) == list(range(rows))
    for n in range(0, rows, max(1, rows // 50)):
        assert place_of(n, rows, 5) == places[n] and number_at(places[n], rows, 5) == n


def test_walks_come_back_below(spark):
    rows = next(n for n in range(50, 5000) if (lambda a, b: a * b - n > 0)(*grid(n)))
    df = spark.range(rows).select(permuted(F.col("id"), rows, 9).alias("p"))
    assert sorted(r["p"] for r in df.collect()) == list(range(rows))


def test_a_seed_is_another_shuffle(spark):
    one = [place_of(n, 1000, 1) for n in range(1000)]
    two = [place_of(n, 1000, 2) for n in range(1000)]
    assert sum(a == b for a, b in zip(one, two)) < 20
    assert abs(sum(p * n for n, p in enumerate(one)) / 1000 - 499.5 ** 2) < 8000  # near no correlation


def test_counts_slots_and_reruns(spark):
    rows = [(i % 40 if i % 3 else None, "x" * (i % 5), i, "s") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int, shard string").repartition(7)
    run = lambda d: sorted(map(tuple, shard_rows(d, [F.col("doc_id"), F.xxhash64("text"), F.col("n")], 24).collect()), key=str)
    got = run(df)
    assert got == run(df.repartition(3))
    assert len(got) == 500 and sorted(r[3] for r in got) == list(range(500))
    slots = {}
    for r in got:
        slots.setdefault(r[4], []).append(r[5])
    assert len(slots) == 24 and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_and_repeated_rows(spark):
    empty = shard_rows(spark.createDataFrame([], "doc_id bigint, text string"), [F.col("doc_id")], 24)
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "row_number", "shard", "slot"]
    same = shard_rows(spark.createDataFrame([(1, "a")] * 50, "doc_id bigint, text string"), [F.col("doc_id"), F.xxhash64("text")], 24)
    assert len({(r["shard"], r["slot"]) for r in same.collect()}) == 50
