"""Ranked lexical search against a plain program; the registered query has an SQL twin besides."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from inkledger.llm import mask_ranking
from inkledger.llm.mask_ranking import FILTER_BITS, TERM, rank, term_filter


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top):
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    wanted = defaultdict(set)
    for key, text in items:
        if key is not None:
            wanted[key] |= set(terms(text))
    out = {}
    for key, own in wanted.items():
        scored = []
        for i, bag in bags:
            tf, m = Counter(bag), 10 + (90 * len(bag) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in own if t in tf)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for place, (score, _, _, i) in enumerate(sorted(scored)[:top], 1):
            out[key, place] = (i, -score)
    return out


def result(df):
    rows = df.collect()
    assert len({(r["item_id"], r["rank"]) for r in rows}) == len(rows)
    return {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows}


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


def test_ranking_equals_brute_force(spark, monkeypatch):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    some = lambda low, high: " ".join(words[int(draw.paretovariate(0.4)) % 400] for _ in range(draw.randrange(low, high)))
    docs = [(i, some(0, 120)) for i in range(700)]
    items = [(i, some(1, 90)) for i in range(40)] + [(99, " ".join(words))]  # more terms than one word of a mask has bits
    monkeypatch.setattr(mask_ranking, "GROUP", 7)
    for top in (1, 10):
        assert result(rank(*frames(spark, docs, items), top)) == brute(docs, items, top)


def test_ties_copies_nulls_and_blanks(spark):
    docs = [(5, "Red green"), (3, "red GREEN"), (3, "red green"), (None, "red-green"), (4, None), (6, ""), (7, "..."), (8, "blue"), (9, "é日 red"), (10, "Ünder ünder")]
    items = [(1, "red"), (1, "RED"), (2, None), (3, "nowhere"), (None, "red"), (4, "green, blue"), (5, "é日"), (6, "ünder Ünder")]
    got = result(rank(*frames(spark, docs, items)))
    assert got == brute(docs, items, 10)
    assert [got[1, k][0] for k in range(1, 6)] == [3, 3, 5, 9, None] or [got[1, k][0] for k in range(1, 6)][-1] is None


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert rank(docs.limit(0), items).count() == 0 and rank(docs, items.limit(0)).count() == 0
    assert rank(docs.withColumn("text", docs["text"].substr(1, 0)), items).count() == 0


def test_a_very_long_text_and_clashing_columns(spark):
    long = " ".join(f"t{i % 977}" for i in range(300_000))
    docs = [(1, long), (2, "t1 t2 t3"), (3, "t1")]
    items = [(1, "t1 t2"), (2, long)]
    d, i = frames(spark, docs, items)
    d, i = d.selectExpr("*", "'x' AS term", "1 AS block", "2 AS item"), i.selectExpr("*", "'y' AS term", "3 AS item", "4 AS rank")
    assert result(rank(d, i)) == brute(docs, items, 10)


def test_masks_end_early_without_loss(spark, monkeypatch):
    """A block of many documents: the search stops before it has scored them all."""
    draw = random.Random(9)
    docs = [(i, " ".join(draw.choice(["common"] * 50 + ["odd", "rare", "seldom"]) for _ in range(20))) for i in range(3000)]
    seen = []
    scores = mask_ranking.Block.scores

    def counted(self, docs, held):
        seen.append(len(docs))
        return scores(self, docs, held)

    items = [(1, "odd rare seldom common")]
    assert result(rank(*frames(spark, docs, items))) == brute(docs, items, 10)
    monkeypatch.setattr(mask_ranking.Block, "scores", counted)
    facts = mask_ranking.index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), np.full(FILTER_BITS // 8, 255, np.uint8))
    rows = facts.drop("n_docs").toArrow()
    weights = [{"common": 1}.get((t or b"").decode(), 900) for t in rows["term"].to_pylist()]
    import pyarrow as pa
    table = rows.append_column("weight", pa.array(weights)).append_column("items", pa.array([[0]] * len(rows)))
    block = mask_ranking.Block(table, 3000, 60_000)
    places, found = block.best(0, 10)
    every = scores(block, np.arange(3000), block.of[0])
    assert sum(seen) < 3000 and found.tolist() == sorted(every.tolist(), reverse=True)[:10]


def test_the_filter_lets_every_term_pass(spark):
    draw = random.Random(1)
    names = [f"{draw.random()}" for _ in range(3000)]
    bits = np.unpackbits(term_filter(spark.createDataFrame([(n.encode(),) for n in names], "term binary")))
    from zlib import crc32
    spots = {crc32(n.encode()) & (FILTER_BITS - 1) for n in names}
    assert set(np.flatnonzero(bits).tolist()) == spots
    # the ends of Spark's bitmaps
    rows = spark.sql("SELECT id AS spot FROM VALUES (0L), (1L), (32767L), (32768L), (32769L), (65536L), (8388607L) AS t(id)")
    assert rows.count() == 7
