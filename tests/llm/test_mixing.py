"""Targets by water-filling and the copies that meet them."""

import random

import pytest
from pyspark.sql import functions as F

from inkledger.llm import mixing
from inkledger.llm.mixing import mix, repeated, water_fill, word_count

WEIGHTS = [3.0, 1.0, 2.0]


def brute_targets(sizes, weights, total, cap):
    """Clamp whoever is above, deal the excess to the others, until none is above."""
    held, target = set(), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in held}
        rest = total - sum(cap * sizes[s] for s in held)
        target = {s: cap * sizes[s] if s in held else (rest * free[s] / sum(free.values())) for s in sizes}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        held |= over


def mixed(spark, rows, schema="doc_id bigint, text string, source string", **more):
    docs = spark.createDataFrame(rows, schema)
    return mix(docs, "source", word_count(F.col("text")), F.xxhash64(F.lit(1), "doc_id", "text"), WEIGHTS, **more)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "b", "a", "Z", "é", "ab"]
    rows = [(i, "w " * rng.randint(0, 40), names[min(int(rng.expovariate(0.6)), 6)]) for i in range(3000)]
    got = mixed(spark, rows).select("doc_id", "source", "mix.*").collect()
    assert len(got) == 3000
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    want = brute_targets(sizes, {s: WEIGHTS[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2.0)
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, r["target"])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 3, (source, taken[source], target)
    again = mixed(spark, rows).select("doc_id", "mix.copies").collect()
    assert {(r[0], r[1]) for r in again} == {(r["doc_id"], r["copies"]) for r in got}


def test_water_fill_when_limits_hold_too_little(spark):
    sources = spark.createDataFrame([("a", 10, 1.0), ("b", 0, 1.0)], "_key string, source_size bigint, weight double")
    assert {r["_key"]: r["target"] for r in water_fill(sources, 100.0, 2.0).collect()} == {"a": 20.0, "b": 0.0}


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (None, "z", "b"), (4, "q " * 5000, "b"), (4, "q " * 5000, "b")]
    got = mixed(spark, rows).select("doc_id", "mix.*").collect()
    assert len(got) == 6 and all(r["copies"] <= 2 for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert mixed(spark, []).count() == 0
    blank = mixed(spark, [(1, " ", "a")]).select("mix.*").first()
    assert (blank["target"], blank["copies"], blank["taken"]) == (0.0, 0, 0)


def test_word_count_is_ascii_white_space(spark):
    texts = ["a\x0bb\x0cc", "a\u00a0b", " ", "", None, "x\u2028y \x1f"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t")).alias("n"))
    assert [r["n"] for r in df.collect()] == [3, 1, 0, 0, 0, 2]


def test_repeated_rows_weights_table_and_clashing_columns(spark):
    schema = "doc_id bigint, text string, source string, target string, weight int, _key int, mix int"
    rows = [(i, "a b c", "s" if i % 2 else "t", "kept", 5, 6, 7) for i in range(100)]
    docs = spark.createDataFrame(rows, schema)
    weights = spark.createDataFrame([("s", 1.0)], "name string, w double")
    out = mix(docs, "source", word_count(F.col("text")), F.xxhash64("doc_id"), weights, 0.75, 2.0)
    assert out.columns == docs.columns
    full = repeated(out)
    assert full.columns == docs.columns[:-1]
    counts = {r["source"]: r["count"] for r in full.groupBy("source").count().collect()}
    assert counts == {"s": 75} and full.filter("target = 'kept' AND weight = 5 AND _key = 6").count() == 75


def rounds_of(rows, room, rounds):
    """The (hash, size) pairs taken by plain rounds along the hash; equal hashes go together."""
    taken = set()
    for _ in range(rounds):
        used, fitting = 0, room
        for h in sorted({h for h, s in rows if (h, s) not in taken and 0 < s <= room}):
            tied = [(x, s) for x, s in rows if x == h and (x, s) not in taken and 0 < s <= room]
            used += sum(s for _, s in tied)
            if used > room:
                break
            fitting = room - used
            last = h
        if fitting == room:
            break
        taken |= {(x, s) for x, s in rows if x <= last and 0 < s <= room}
        room = fitting
    return taken


@pytest.mark.parametrize("rounds", [1, 2, 8])
def test_rows_taken_are_those_of_plain_rounds(spark, monkeypatch, rounds):
    """Sizes from 1 to 3,000, hashes that tie, a source of many equal sizes; in small buckets, all rounds in one plan."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    rng = random.Random(rounds)
    rows = [(i, rng.choice([1, 2, 3, 50, 700]) if i % 3 else rng.randint(0, 3000), "abc"[i % 3], rng.randrange(900) << 50) for i in range(1500)]
    rows += rows[:200]
    docs = spark.createDataFrame(rows, "doc_id bigint, n bigint, source string, h bigint")
    staged, names = mixing.staged, []
    monkeypatch.setattr(mixing, "staged", lambda df, name: names.append(name) or staged(df, name))
    got = mix(docs, "source", F.col("n"), F.col("h"), WEIGHTS, 1.3, rounds=rounds).select("source", "n", "h", "mix.*").collect()
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        target, total = own[0]["target"], own[0]["source_size"]
        whole = int(target / total + 1e-9)
        want = rounds_of([(r["h"] >> 1, r["n"]) for r in own], round(target - whole * total), rounds)
        assert {(r["h"] >> 1, r["n"]) for r in own if r["copies"] > whole} == want
    # no step of its own for each round
    assert len(names) == 6
