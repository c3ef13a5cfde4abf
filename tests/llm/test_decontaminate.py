"""Containment search against comparing every pair."""

import random

from inkledger.llm import decontaminate
from inkledger.llm.decontaminate import ItemIndex, contamination, decontaminated
from tests.llm.test_near_dedup import shingles


def brute(docs, items, n=5, threshold=80):
    out = []
    for d, text in docs:
        have = shingles(text, n)
        for i, item in items:
            want = shingles(item, n)
            if want and 100 * len(want & have) >= threshold * len(want):
                out.append((d, i, len(want & have), len(want)))
    return sorted(out)


def tables(rng):
    word = lambda: f"w{rng.randint(0, 3000)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([5, 6, 9, 20, 33, 64, 150])))) for i in range(60)]
    items += [(100, "too short"), (101, None), (102, ""), (103, items[0][1]), (0, items[0][1])]
    docs = []
    for d in range(300):
        text = [word() for _ in range(rng.choice([3, 40, 400, 5000]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            passage = rng.choice(items[:60])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):  # some stay above the threshold, some fall below
                passage[rng.randrange(len(passage))] = word()
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
        docs.append((d, " ".join(text).title()))
    # an item in two halves, far apart, and its copies
    halves = items[5][1].split()
    docs.append((900, " ".join(halves[:len(halves) // 2] + [word() for _ in range(3000)] + halves[len(halves) // 2:])))
    return docs + [(901, None), (902, ""), (903, "Too SHORT"), (904, "too short but longer")], items


def test_equals_every_pair(spark, monkeypatch):
    docs, items = tables(random.Random(3))
    left, right = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(set(brute(docs, items)))
    assert sorted(map(tuple, contamination(left, right).collect())) == want and len(want) > 50
    hit = {d for d, *_ in want}
    assert {r["doc_id"] for r in decontaminated(left, right).collect()} == {d for d, _ in docs} - hit
    # more items than go in one pass: the same result in several
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 7)
    assert sorted(map(tuple, contamination(left, right).collect())) == want
    assert {r["doc_id"] for r in decontaminated(left, right).collect()} == {d for d, _ in docs} - hit


def test_windows_find_a_passage_anywhere():
    rng = random.Random(8)
    item = " ".join(f"q{i}" for i in range(20))
    index = ItemIndex([(1, item.encode())], 5)
    for at in range(0, 3000, 37):
        text = [f"w{rng.random()}" for _ in range(3000)]
        text[at:at] = item.split()
        assert index.matches(" ".join(text).encode(), 5, 80) == [(1, 16, 16)]


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 5)], "doc_id bigint, text string, item_id int")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(docs, none).count() == 0 and decontaminated(docs, none).collect() == docs.collect()
    some = spark.createDataFrame([(4, "a b c d e", "x")], "item_id bigint, text string, doc_id string")
    assert list(map(tuple, contamination(docs.unionAll(docs), some).collect())) == [(1, 4, 1, 1)] * 2
    assert decontaminated(docs, some).count() == 0
    assert contamination(docs.limit(0), some).count() == 0
