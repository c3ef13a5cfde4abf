"""The forest against all pairs on small tables."""

import random

import numpy as np
import pytest

from inkledger.llm import common, near_dedup
from inkledger.llm.near_dedup import _regions, deduplicated, near_duplicates


def shingles(text, n):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").split()
    words = [w for w in words if w]
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n, threshold=80):
    """doc_id -> (size, component) by comparing all pairs; rows that share an id are one."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and 100 * len(s & t) >= threshold * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {(i, len(s)): root(i) for i, s in sets}


def corpus(rng, base, copies, words=60):
    rows = []
    for _ in range(base):
        text = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 2, 5, words, words * 3]))]
        rows.append(" ".join(text))
        for _ in range(rng.choice([0, 0, 1, copies])):
            other = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 12))):
                other[rng.randrange(len(other))] = f"x{rng.randint(0, 10 ** 6)}"
            rows.append(" ".join(other).upper() if rng.random() < 0.3 else " \n".join(other))
    rng.shuffle(rows)
    return list(enumerate(rows))


def found(spark, rows, n):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = near_duplicates(docs, words=n).collect()
    return out


@pytest.mark.parametrize("n", [2, 5])
def test_equals_all_pairs(spark, n):
    rows = corpus(random.Random(n), 120, 6)
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, rows[0][1]), (1004, rows[0][1].upper()), (1005, "one"), (1006, "ONE")]
    out = found(spark, rows, n)
    want = brute(rows, n)
    assert {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in out} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_a_large_dense_group(spark, monkeypatch):
    """Hundreds of different near copies: regions are cut deep, and the second search joins what that parts."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randint(1, 5)):
            text[rng.randrange(len(text))] = f"y{rng.randint(0, 10 ** 6)}"
        rows.append((i, " ".join(text)))
    rows += corpus(rng, 30, 2)[:0] + [(1000 + i, f"alone {i} " + " ".join(f"z{i}{j}" for j in range(30))) for i in range(20)]
    monkeypatch.setattr(near_dedup, "REGION", 16)
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in found(spark, rows, 2)}
    assert got == brute(rows, 2)


def test_regions_hold_no_more_than_they_may():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 12, 5000)
    region = _regions(common, 3, 32)
    sizes = np.bincount(region)
    assert sizes.max() <= 32 and (region >= 0).all()
    # rows of one region are neighbours that agree on three bytes at least
    same = region[1:] == region[:-1]
    assert (common[1:][same] >= 3).all()


def test_nulls_repeats_and_an_empty_table(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "g h i j k l"), (2, "a b c d e f"), (3, None)]
    out = found(spark, rows, 2)
    assert len(out) == 7
    assert [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(None, True)] * 2
    assert {r["component_id"] for r in out if r["doc_id"] in (1, 2)} == {1}
    assert [r["component_id"] for r in out if r["doc_id"] == 3] == [3]
    assert found(spark, [], 2) == []


def test_an_id_with_several_texts_ties_them(spark):
    """Two texts of one size under one id: what is near to either is linked through the id."""
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    out = found(spark, [(1, one), (1, two), (7, one + " x"), (8, two + " y"), (9, "c d e")], 2)
    assert sorted((r["doc_id"], r["component_id"]) for r in out) == [(1, 1), (1, 1), (7, 1), (8, 1), (9, 9)]


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text, "x", 1), (3, text + " more", "y", 2), (3, text + " more", "y", 2), (9, "else", "z", 3), (None, text, "n", 4), (8, None, "q", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rep string, sig int")
    out = deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        [(3, text + " more", "y", 2), (9, "else", "z", 3), (None, text, "n", 4), (8, None, "q", 5)], key=str)


def test_a_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    out = found(spark, [(1, long), (2, long + " end"), (3, "w1 w2")], 2)
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in out} == {1: (1, 59_999), 2: (1, 60_000), 3: (3, 1)}


def test_the_wide_look_finds_partners_that_small_regions_part():
    """Rows that share a beginning, in more than a small region: each asked row's best partner of all of them."""
    rng = np.random.default_rng(5)
    n = 700
    keys = rng.integers(0, 256, (n, near_dedup.HASHES), dtype=np.uint8)
    keys[:, :near_dedup.DEPTH] = 7
    keys[1::2, 12:] = keys[::2, 12:]  # pairs differ early, so they lie far apart when sorted
    order = np.lexsort(keys.T[::-1])
    keys, ids, sizes, tree = keys[order], order, np.where(order == 9, 10, 100), np.zeros(n, np.int64)
    asked = np.arange(0, n, 3)
    got = {}
    for rows, partners in near_dedup._wide_look(tree, keys, ids, sizes, asked, 80):
        got.update(zip(ids[rows].tolist(), ids[partners].tolist()))
    # the sizes of one pair alone are too different
    assert got == {int(i): int(i) ^ 1 for i in ids[asked] if int(i) not in (8, 9)}
    assert list(near_dedup._wide_look(tree, keys, ids, sizes, asked[:0], 80)) == []


def test_stars_are_told_by_one_aggregation(spark, monkeypatch):
    rng = random.Random(8)
    for turn in range(12):
        pairs = {(max(a, b), min(a, b)) for a, b in ((rng.randrange(9), rng.randrange(9)) for _ in range(rng.randint(0, 5))) if a != b}
        ups = [u for u, _ in pairs]
        want = len(ups) == len(set(ups)) and not {v for _, v in pairs} & set(ups)
        edges = spark.createDataFrame(sorted(pairs), "u bigint, v bigint")
        assert common._is_stars(edges) == want, pairs
    asked, whole = [], type(edges).isEmpty
    monkeypatch.setattr(type(edges), "isEmpty", lambda df: asked.append(df) or whole(df))
    common._is_stars(edges.sparkSession.createDataFrame([(2, 1), (3, 1)], "u bigint, v bigint"))
    assert len(asked) == 1
