"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Native: DataFrame functions only.  A row's place in the shuffle is ``permuted(number)``; its
shard is the place modulo the number of shards and its slot the place divided by it, so counts
differ by one at most and both can be computed, and inverted, without looking at other rows.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from inkledger.llm.common import numbered

ROUNDS = 6


def grid(rows: int) -> tuple[int, int]:
    """Sides (a, b) of the permuted rectangle: a * b >= rows, with as few cells above as some nearly square one has."""
    root = max(1, isqrt(max(rows, 1) - 1) + 1)
    sides = ((-rows % a, a) for a in range(root, root + min(root, 1000) + 1))
    a = min(sides)[1]
    return a, max(1, -(-rows // a))


def round_keys(seed: int) -> list[int]:
    return [seed * ROUNDS + turn for turn in range(ROUNDS)]


def _cell(number: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network over a cell of the a x b rectangle; the two coordinates take turns."""
    right = number % b
    # an exact multiple divided as a double is exact below 2^53 rows
    left = ((number - right) / F.lit(b)).cast("bigint")
    for turn, key in enumerate(round_keys(seed)):
        noise = lambda x, side, key=key: F.pmod(F.xxhash64(F.lit(key).cast("bigint"), x), F.lit(side).cast("bigint"))
        if turn % 2 == 0:
            left = (left + noise(right, a)) % a
        else:
            right = (right + noise(left, b)) % b
    return left * b + right


def _noise(x: int, key: int, side: int) -> int:
    """The round function on the driver: the same chained 64-bit hash, as a signed number."""
    value = 42
    for part in (key, x):
        value = xxh64_intdigest(part.to_bytes(8, "little", signed=True), value)
    return (value - (1 << 64) if value >> 63 else value) % side


def permuted(number: Column, rows: int, seed: int) -> Column:
    """The place of row ``number`` (0 to rows - 1) in the shuffle: a permutation of the same range.

    Cells above ``rows`` are walked on from until the cycle comes back below; such cells are few
    (``a * b - rows``), and a walk visits each at most once, which bounds its steps exactly.
    """
    a, b = grid(rows)
    first = _cell(number, a, b, seed)
    spare = a * b - rows
    if spare <= 0:
        return first
    walk = lambda at, _: F.when(at >= rows, _cell(at, a, b, seed)).otherwise(at)
    return F.when(first < rows, first).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(spare)), first, walk))


def place_of(number: int, rows: int, seed: int) -> int:
    """``permuted`` for one number on the driver: where will row ``number`` be?"""
    a, b = grid(rows)
    while True:
        left, right = divmod(number, b)
        for turn, key in enumerate(round_keys(seed)):
            if turn % 2 == 0:
                left = (left + _noise(right, key, a)) % a
            else:
                right = (right + _noise(left, key, b)) % b
        number = left * b + right
        if number < rows:
            return number


def number_at(place: int, rows: int, seed: int) -> int:
    """The inverse: which row is at ``place`` (= slot * shards + shard)?"""
    a, b = grid(rows)
    while True:
        left, right = divmod(place, b)
        for turn, key in reversed(list(enumerate(round_keys(seed)))):
            if turn % 2 == 0:
                left = (left - _noise(right, key, a)) % a
            else:
                right = (right - _noise(left, key, b)) % b
        place = left * b + right
        if place < rows:
            return place


def shard_rows(df: DataFrame, order: list[Column], shards: int, seed: int = 1, number: str = "row_number",
               shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``df`` with its global row number along ``order``, shard (0 to shards - 1) and slot (from 0, gapless).

    Equal rows get numbers of their own.  Nulls in ``order`` come first.  An empty table stays
    empty.  Rows that tie in ``order`` but differ elsewhere may swap numbers between runs: let
    ``order`` tell rows apart, by narrow columns (a hash of a text, not the text).  Columns of
    ``df`` named like the three new ones are replaced; all others pass through.
    """
    kept = [c for c in df.columns if c not in (number, shard, slot)]
    keys = [f"_order{i}" for i in range(len(order))]
    packed = df.select(*[c.alias(k) for c, k in zip(order, keys)], F.struct(*kept).alias("_kept"))
    placed, rows = numbered(packed, keys, "_number", "shard")
    place = permuted(F.col("_number"), rows, seed)
    remainder = F.col("_place") % shards
    return (placed.withColumn("_place", place)
            .select("_kept.*", F.col("_number").alias(number), remainder.cast("int").alias(shard),
                    ((F.col("_place") - remainder) / shards).cast("bigint").alias(slot)))
