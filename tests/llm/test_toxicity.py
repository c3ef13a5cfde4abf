"""The risk estimator, and held-out accuracy on invented text."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from inkledger.llm import toxicity
from inkledger.llm.queries import learnable
from inkledger.llm.toxicity import Model, fit, score, text_features, train, without_toxic

BAD = ["grobian", "lummel", "fiesling", "schuft"]


def corpus(rng, n=1500, share=0.15):
    rows, truth = [], {}
    for i in range(n):
        words = [f"w{rng.randint(0, 800)}" for _ in range(rng.randint(5, 120))]
        truth[i] = int(rng.random() < share)
        for _ in range(rng.randint(2, 5) * truth[i]):
            words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "e", "en", "haft"]))
        rows.append((i, " ".join(words).title()))
    return rows, truth


@pytest.fixture(scope="module")
def data(spark):
    rows, truth = corpus(random.Random(4))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, truth[i]) for i in truth if i % 2], "doc_id bigint, toxic int")
    return docs, labels, truth


def test_held_out_accuracy(spark, data):
    docs, labels, truth = data
    model = train(docs, labels, learn=learnable())
    got = {r["doc_id"]: r["score"] for r in score(docs, model).collect()}
    held = {r["doc_id"] for r in docs.filter(~learnable()).collect()}
    right = [(got[i] >= 0.5) == bool(truth[i]) for i in held]
    assert len(held) > 200 and np.mean(right) > 0.97
    assert {r["doc_id"] for r in without_toxic(docs, model).collect()} == {i for i in got if got[i] < 0.5}


def test_labels_of_held_out_rows_are_not_used(spark, data):
    docs, labels, _ = data
    from pyspark.sql import functions as F

    spoiled = labels.withColumn("toxic", F.when(learnable(), F.col("toxic")).otherwise(1 - F.col("toxic")))
    one, two = train(docs, labels, learn=learnable()), train(docs, spoiled, learn=learnable())
    assert one == two


def test_labels_on_every_row_still_teach(spark, data):
    docs, _, truth = data
    every = spark.createDataFrame(list(truth.items()), "doc_id bigint, toxic int")
    model = train(docs, every, learn=learnable())
    got = {r["doc_id"]: r["score"] for r in score(docs, model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(truth[i]) for i in got]) > 0.97


def test_rows_of_one_key_stay_within_the_bound(spark, data):
    docs, labels, _ = data
    from pyspark.sql import functions as F

    many = docs.unionAll(docs.filter("doc_id = 1").select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(3000))).alias("i")).select("doc_id", F.concat(F.lit("grobian x"), "i").alias("text")))
    sizes, own = [], toxicity.fit
    toxicity.fit = lambda p, u, prior: sizes.append((len(p), len(u))) or own(p, u, prior)
    try:
        train(many, labels.unionAll(spark.createDataFrame([(1, 1)], labels.schema)), max_positive=200, max_unlabelled=300)
    finally:
        toxicity.fit = own
    assert sizes == [(200, 300)]


@pytest.mark.parametrize("prior", [0.1, 0.9])
def test_risk_equals_a_plain_program(prior):
    rng = np.random.default_rng(3)
    seen = set()
    for _ in range(30):
        p, u = rng.integers(0, 2, (rng.integers(1, 5), 4)), rng.integers(0, 2, (rng.integers(1, 7), 4))
        w, b, decay = rng.normal(0, 2, 4), rng.normal(), 0.01
        loss = lambda rows, at, sign: np.mean([np.log1p(np.exp(-sign * (at[:4] @ r + at[4]))) for r in rows])
        bracket = lambda at: loss(u, at, -1) - prior * loss(p, at, -1)
        at = np.append(w, b)
        whole = lambda x: prior * loss(p, x, 1) + bracket(x) if bracket(at) >= 0 else -bracket(x)
        slope = [(whole(at + e) - whole(at - e)) / 2e-6 for e in np.eye(5) * 1e-6]
        side = lambda m: (*np.nonzero(m), len(m))
        value, grad = toxicity.risk(side(p), side(u), w, b, prior, decay)
        seen.add(value >= 0)
        assert value == pytest.approx(bracket(at)) and grad == pytest.approx(np.array(slope) + np.append(decay * w, 0), abs=1e-6)
    assert True in seen


def test_unlabelled_toxic_rows_are_not_learned_as_clean():
    """Half of the unlabelled rows are toxic: with the right prior they still score above one half."""
    rng = random.Random(2)
    toxic = lambda: text_features(f"w{rng.randint(0, 50)} grobian w{rng.randint(0, 50)}".encode())
    clean = lambda: text_features(f"w{rng.randint(0, 50)} w{rng.randint(0, 50)}".encode())
    model = fit([toxic() for _ in range(300)], [toxic() for _ in range(500)] + [clean() for _ in range(500)], 0.5)
    scores = model.probabilities([b"w1 Grobian w2", b"w1 w2"])
    assert scores[0] > 0.5 > scores[1]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = train(docs, labels)
    got = score(docs, model).collect()
    assert len(got) == 4 and len({r["score"] for r in got}) == 1 and 0 <= got[0]["score"] < 0.5
    assert score(docs.limit(0), model).count() == 0 and train(docs.limit(0), labels).bias == model.bias


def test_empty_texts_teach_nothing():
    none, some = text_features(b""), text_features(b"a word")
    for positive, unlabelled in (([none] * 9, [some] * 9), ([some] * 9, [none] * 9), ([none], [none])):
        assert all(0 < x < 1 for x in fit(positive, unlabelled, 0.1).probabilities([b"", b"a word"]))


def test_edges(spark, data):
    docs, labels, _ = data
    model = train(docs, labels.unionAll(labels).unionAll(spark.createDataFrame([(None, 1), (3, None)], labels.schema)))
    rows = [(1, None, "en", 9.0), (1, "", "de", 9.0), (2, "grobian schuft lummel " * 20_000, None, None), (2, "grobian schuft lummel " * 20_000, None, None)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    got = score(odd, model)
    assert got.columns == odd.columns
    values = [r["score"] for r in got.collect()]
    assert values[0] == values[1] and values[2] == values[3] > 0.5
    assert all(0 <= v <= 1 for v in values)


def test_sample_bounds_hold(data):
    docs, labels, _ = data
    model = train(docs, labels, max_positive=20, max_unlabelled=50)
    assert isinstance(model, Model) and toxicity.MAX_POSITIVE <= 10_000


def test_the_sample_is_not_copied_on_the_driver(spark, monkeypatch):
    """Training holds the sample as it came, not a second and third time."""
    docs = spark.createDataFrame([(i, " ".join(f"word{i}x{j}" for j in range(1500))) for i in range(300)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    given, kept = [], toxicity.fit

    def learned(positive, unlabelled, prior):
        # the most that was held until here
        given.append((tracemalloc.get_traced_memory()[1], sum(x.nbytes for x in positive + unlabelled)))
        return kept(positive, unlabelled, prior)

    monkeypatch.setattr(toxicity, "fit", learned)
    tracemalloc.start()
    try:
        train(docs, labels)
    finally:
        tracemalloc.stop()
    (held, size), = given
    assert size > 1_500_000 and held < 2 * size, (held, size)


def test_order_and_repeats_of_the_sample():
    rng = np.random.default_rng(5)
    rows = [rng.integers(0, 3, rng.integers(0, 12)).astype(np.int32) for _ in range(400)]
    order = toxicity._by_bytes(rows)
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows) and sorted(order) == list(range(400))
    assert [r.tobytes() for r in toxicity._different(rows)] == list(dict.fromkeys(r.tobytes() for r in rows))
    parts = pa.chunked_array([pa.array([r.tobytes() for r in part], pa.binary()) for part in (rows[:150], rows[150:])] + [pa.array([], pa.binary())])
    assert [r.tolist() for r in toxicity._slices(parts)] == [r.tolist() for r in rows]
