"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the distinct words of a text, each word standing for itself and its first
four and five characters.  It is fitted with numpy from confirmed toxic rows and unlabelled
rows by the non-negative estimate of the risk, which corrects the unlabelled rows by the class
prior; scoring is one pass over the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from xxhash import xxh3_64_intdigest

from inkledger.llm.blocks import flat
from inkledger.llm.words import as_bytes

#: Features are hashed to so many bits; a few million of them hardly ever meet.
BITS = 31
#: Documented bounds of the training sample: confirmed toxic rows and unlabelled rows.
MAX_POSITIVE = 4_000
MAX_UNLABELLED = 8_000
#: Words whose weight a task remembers before it starts over.
REMEMBERED = 500_000


def word_features(word: bytes) -> tuple[int, ...]:
    """The hashed features of one word: itself, its first four and its first five characters."""
    text = word.decode("utf-8", "replace").strip(".,;:!?()[]\"'|*#%")
    parts = {"w" + text, "4" + text[:4], "5" + text[:5]} if len(text) >= 4 else {"w" + text}
    return tuple(xxh3_64_intdigest(p.encode()) >> (64 - BITS) for p in parts)


def text_features(text: bytes) -> np.ndarray:
    words = set(text.lower().split())
    return np.unique(np.fromiter((f for w in words for f in word_features(w)), np.int32))


@dataclass(frozen=True)
class Model:
    """``weights`` by hashed feature, of the few that have one, and ``bias``."""

    weights: dict[int, float]
    bias: float

    def probabilities(self, texts: list[bytes], known: dict[bytes, float] | None = None) -> np.ndarray:
        """0 to 1 for each text.  A text's logit is the bias plus the weights of its distinct features."""
        known = {} if known is None else known
        weights, out = self.weights, np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            if len(known) > REMEMBERED:
                known.clear()
            found = set()
            for word in set(text.lower().split()):
                hits = known.get(word)
                if hits is None:
                    hits = known[word] = tuple(f for f in word_features(word) if f in weights)
                if hits:
                    found.update(hits)
            if found:
                out[i] += sum(weights[f] for f in sorted(found))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _columns(rows: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the features that ``chosen`` (sorted) has."""
    at, columns = [], []
    for i, features in enumerate(rows):
        column = np.searchsorted(chosen, features)
        hit = column[(column < len(chosen)) & (chosen[np.minimum(column, len(chosen) - 1)] == features)] if len(chosen) else column[:0]
        at.append(np.full(len(hit), i))
        columns.append(hit)
    return np.concatenate(at), np.concatenate(columns)


def _counts(features: np.ndarray, has: np.ndarray, often: np.ndarray) -> np.ndarray:
    """How often each of ``features`` occurs, 0 where ``has`` (sorted, with counts) has it not."""
    if not len(has):
        return np.zeros(len(features))
    at = np.minimum(np.searchsorted(has, features), len(has) - 1)
    return np.where(has[at] == features, often[at], 0)


def _different(rows: list[np.ndarray]) -> list[np.ndarray]:
    return list({sha256(np.ascontiguousarray(r)).digest(): r for r in rows}.values())


def _slices(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The features of each row of a binary column, where they lie in its buffers."""
    out = []
    for chunk in column.chunks:
        data, ends = flat(chunk)
        begin = 0
        for end in ends.tolist():
            out.append(np.frombuffer(data[begin:end], np.int32))
            begin = end
    return out


def _by_bytes(rows: list[np.ndarray]) -> list[int]:
    """Row numbers in the order of the rows' bytes; only those that begin alike are copied."""
    begin = lambda i: rows[i][:8].tobytes()
    out = []
    for _, same in groupby(sorted(range(len(rows)), key=begin), begin):
        same = list(same)
        out += same if len(same) == 1 else sorted(same, key=lambda i: rows[i].tobytes())
    return out


def risk(positive: tuple, unlabelled: tuple, w: np.ndarray, b: float, prior: float, decay: float) -> tuple[float, np.ndarray]:
    """The bracket of the estimate (the unlabelled rows' risk as clean without that of the toxic ones among them), and the gradient to follow.

    Either side is (row, column, number of rows) of its features.  The gradient, bias last, is that of the whole risk, or
    minus the bracket's where the bracket is negative.
    """
    (p_row, p_col, p_n), (u_row, u_col, u_n) = positive, unlabelled
    sigmoid = lambda g: 1 / (1 + np.exp(-np.clip(g, -30, 30)))
    g_p = b + np.bincount(p_row, w[p_col], p_n)
    g_u = b + np.bincount(u_row, w[u_col], u_n)
    clean = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
    # derivatives by each row's logit: as positive, and of the bracket
    d_p, d_u = -prior * sigmoid(-g_p) / p_n, np.zeros(u_n)
    bracket_p, bracket_u = -prior * sigmoid(g_p) / p_n, sigmoid(g_u) / u_n
    if clean >= 0:
        d_p, d_u = d_p + bracket_p, bracket_u
    else:
        d_p, d_u = -bracket_p, -bracket_u
    return clean, np.append(np.bincount(p_col, d_p[p_row], len(w)) + np.bincount(u_col, d_u[u_row], len(w)) + decay * w, d_p.sum() + d_u.sum())


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 1500, rate: float = 0.03,
        decay: float = 2e-5, min_z: float = 5.0, support: float = 0.02) -> Model:
    """Minimise prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)) with the logistic loss.

    Where the bracket is negative its gradient is followed upwards, as the non-negative
    estimator prescribes, so that unlabelled toxic rows are not learned by heart as clean.
    Features enter if their share among positives and among unlabelled rows differ by
    ``min_z`` standard errors, and if three positive rows and ``support`` of them have them, or as
    large a share of the unlabelled ones.  Rows with equal features count once.
    Without positives or unlabelled rows nothing can be learned: the model is its prior.
    """
    positive, unlabelled = _different(positive), _different(unlabelled)
    prior = min(max(prior, 1e-4), 0.9)
    if not positive or not unlabelled:
        return Model({}, float(np.log(prior / (1 - prior))))
    p_n, u_n = len(positive), len(unlabelled)
    least = max(3.0, support * p_n)
    # each side on its own: only features frequent enough on one of them are looked up on the other
    (p_has, p_often), (u_has, u_often) = (np.unique(np.concatenate(x), return_counts=True) for x in (positive, unlabelled))
    features = np.union1d(p_has[p_often >= least], u_has[u_often * p_n / u_n >= least])
    p_count, u_count = _counts(features, p_has, p_often), _counts(features, u_has, u_often)
    pooled = (p_count + u_count + 1) / (p_n + u_n + 2)
    z = (p_count / p_n - u_count / u_n) / np.sqrt(pooled * (1 - np.minimum(pooled, 0.9999)) * (1 / p_n + 1 / u_n))
    chosen = features[np.abs(z) >= min_z]
    (p_row, p_col), (u_row, u_col) = _columns(positive, chosen), _columns(unlabelled, chosen)

    w, b = np.zeros(len(chosen)), np.log(prior / (1 - prior))
    first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        _, grad = risk((p_row, p_col, p_n), (u_row, u_col, u_n), w, b, prior, decay)
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(dict(zip(chosen.tolist(), w.tolist())), float(b))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        features = [text_features(t).tobytes() for t in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(features, pa.binary())], ["positive", "features"])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          learn: Column | None = None, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """A model from the labelled toxic rows and a sample of all rows, whose labels are not looked at.

    ``learn`` (over ``key``) says from which rows labels may be learned.  The class prior is the
    toxic share of those labels.  The unlabelled side is a sample of all these rows, labelled or not, so it
    does not depend on how many have labels.  Either sample is the rows with the smallest hashes of ``key``, then the
    rows that differ in their features, at most ``max_positive`` and ``max_unlabelled``: however often a key
    or a text repeats, no more rows reach the driver, as hashed features.
    A key counts as toxic if any of its labels is; null keys and null labels are not used.
    """
    named = labels.select(F.col(key).alias("_key"), F.col(label).alias("_toxic")).dropna().groupBy("_key").agg(
        F.max((F.col("_toxic") == 1).cast("int")).alias("_toxic"))
    keys = docs.select(F.col(key).alias("_key")).filter(F.col("_key").isNotNull())
    if learn is not None:
        named = named.withColumnRenamed("_key", key).filter(learn).withColumnRenamed(key, "_key")
        keys = keys.withColumnRenamed("_key", key).filter(learn).withColumnRenamed(key, "_key")
    total = named.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_toxic"), F.lit(0)).alias("toxic")).first()
    prior = total["toxic"] / total["n"] if total["n"] else 0.0
    order = F.xxhash64(F.lit(17), "_key")
    toxic = named.filter("_toxic = 1").join(keys, "_key", "left_semi").orderBy(order, "_key").limit(max_positive)
    rest = keys.distinct().orderBy(F.xxhash64(F.lit(18), "_key"), "_key").limit(max_unlabelled)
    wanted = toxic.select("_key", F.lit(True).alias("positive")).unionAll(rest.select("_key", F.lit(False).alias("positive")))
    # bounded by the two limits above
    sample = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(wanted), "_key")
    found = sample.select("positive", "text").mapInArrow(_feature_rows, "positive boolean, features binary").distinct()
    place = F.row_number().over(Window.partitionBy("positive").orderBy(F.xxhash64("features"), "features"))
    bound = F.when(F.col("positive"), max_positive).otherwise(max_unlabelled)
    rows = found.withColumn("_place", place).filter(F.col("_place") <= bound).drop("_place").toArrow()
    # the sample stays in the buffers it came in, which go back to the system when the model is there
    features, flags = _slices(rows["features"]), rows["positive"].to_pylist()
    del rows
    # rows come in any order; sums of floats should not
    order_of = _by_bytes(features)
    model = fit([features[i] for i in order_of if flags[i]], [features[i] for i in order_of if not flags[i]], prior)
    del features
    pa.default_memory_pool().release_unused()
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, 0 to 1, from the whole text alone; null and empty texts get the bias' probability.

    A column of ``docs`` named ``out`` is replaced; all others pass through.
    """
    docs = docs.drop(out)
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        for batch in batches:
            found = model.probabilities(as_bytes(batch.column(text)), known)
            yield batch.append_column(out, pa.array(found, pa.float64()))

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def without_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score is below ``threshold``, unchanged; one pass, no shuffle."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        for batch in batches:
            found = model.probabilities(as_bytes(batch.column(text)), known)
            yield batch.filter(pc.less(pa.array(found), threshold))

    return docs.mapInArrow(kept, docs.schema)
