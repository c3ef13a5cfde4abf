"""Mix sources to target weights by capped water-filling; whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkledger.llm.common import numbered, staged

#: Rows of a source for each bucket of its seeded order, while sources are small.
BUCKET_ROWS = 1024


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def cyclic_weights(sources: DataFrame, weights: list[float], key: str = "_source") -> DataFrame:
    """``(key, weight)``: sources in code point order, null last, take ``weights`` in turn."""
    ranked, _ = numbered(sources.select(key, F.col(key).isNull().alias("_absent")), ["_absent", key], "_rank", "mix-rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return ranked.select(key, F.element_at(turn, (F.col("_rank") % len(weights) + 1).cast("int")).alias("weight"))


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """``sources`` (``source_size``, ``weight`` > 0) with ``target``: level * weight, held at ``max_epochs`` sizes.

    Sources above their limit are clamped and what they leave is dealt to the others by
    weight, until none is above.  A round is one aggregation; the driver holds two sums.  The
    level only rises, so a clamped source stays clamped and the loop ends after as many rounds
    as there are groups of newly clamped sources.  If even all limits together hold less than
    ``total``, every source gets its limit.
    """
    limit = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = -1.0, -1
    while True:
        over = F.col("weight") * F.lit(level) >= limit
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("free"),
            F.coalesce(F.sum(over.cast("bigint")), F.lit(0)).alias("n")).first()
        if row["n"] == clamped or row["free"] <= 0:
            break
        clamped, level = row["n"], (total - row["held"]) / row["free"]
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)) if row["free"] > 0 else limit)


def _cuts(rows: DataFrame) -> DataFrame:
    """``(_key, _cut, _used)``: the highest ``_h`` up to which a source's ``_size`` sum to ``_room`` at most.

    Each source's hash range is cut into ``_buckets``: bucket totals are summed
    along first, then rows inside a bucket, so no source is ordered in one task.
    """
    # the top 31 bits of the hash times the number of buckets, shifted back: ordered and even
    rows = rows.withColumn("_bucket", F.shiftright(F.shiftright("_h", 32) * F.col("_buckets"), 31))
    totals = rows.groupBy("_key", "_bucket").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_key", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    # a range frame: rows that tie in _h go in or stay out together
    inside = Window.partitionBy("_key", "_bucket").orderBy("_h")
    upto = F.sum("_size").over(inside) + F.col("_before")
    return (rows.join(totals, ["_key", "_bucket"]).withColumn("_upto", upto).filter("_upto <= _room")
            .groupBy("_key").agg(F.max("_h").alias("_cut"), F.max("_upto").alias("_used")))


def _later_cuts(rows: DataFrame, rounds: int) -> DataFrame:
    """``(_key, _later)``: the (room, cut) of ``rounds`` more rounds along the rows that the first one left.

    ``rows``: (_key, _size, _h, _room, _buckets), sizes from 1 to the room.  Rows of one size are taken along
    their hash, so of a size no more than room / size rows go in, and the row after them is the last that can
    end a round.  Only those rows are kept, first in each of the source's buckets, then in all: about
    room * log(room) of a source, however many it has.  All rounds run along them in the same order, with one exchange.
    """
    rows = (rows.groupBy("_key", "_size", "_h", "_room", "_buckets").agg(F.sum("_size").alias("_sum"))
            .withColumn("_part", F.pmod("_h", "_buckets")))
    for keys in (["_key", "_size", "_part"], ["_key", "_size"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))
        rows = rows.withColumn("_place", place).filter((F.col("_place") - 1) * F.col("_size") <= F.col("_room"))
    whole = Window.partitionBy("_key")
    # a range frame, as above
    along = whole.orderBy("_h")
    rows = rows.select("_key", "_size", "_h", "_sum", "_room", F.lit(True).alias("_free"), F.array().cast("array<struct<room:bigint,cut:bigint>>").alias("_later"))
    for _ in range(rounds):
        is_open = F.col("_free") & (F.col("_size") <= F.col("_room"))
        rows = rows.withColumn("_upto", F.sum(F.when(is_open, F.col("_sum")).otherwise(0)).over(along))
        fits = is_open & (F.col("_upto") <= F.col("_room"))
        rows = rows.withColumns({"_cut": F.coalesce(F.max(F.when(fits, F.col("_h"))).over(whole), F.lit(-1)),
                                 "_used": F.coalesce(F.max(F.when(fits, F.col("_upto"))).over(whole), F.lit(0))})
        rows = rows.select(
            "_key", "_size", "_h", "_sum", (F.col("_room") - F.col("_used")).alias("_room"),
            (F.col("_free") & ~((F.col("_size") <= F.col("_room")) & (F.col("_h") <= F.col("_cut")))).alias("_free"),
            F.concat("_later", F.array(F.struct(F.col("_room").alias("room"), F.col("_cut").alias("cut")))).alias("_later"))
    return rows.groupBy("_key").agg(F.first("_later").alias("_later"))


def _priced(sources: DataFrame, weights) -> DataFrame:
    if isinstance(weights, DataFrame):
        given = weights.select(F.col(weights.columns[0]).alias("_name"), F.col(weights.columns[1]).alias("weight"))
    else:
        given = cyclic_weights(sources, weights).withColumnRenamed("_source", "_name")
    matched = sources.join(given, F.col("_source").eqNullSafe(F.col("_name")), "left").drop("_name")
    return matched.withColumn("weight", F.coalesce("weight", F.lit(0.0)))


def mix(docs: DataFrame, source: str, size: Column, row_hash: Column, weights, total_share: float = 1.5,
        max_epochs: float = 2.0, rounds: int = 8, out: str = "mix") -> DataFrame:
    """``docs`` with a struct ``out`` (size, source_size, target, copies, taken): how often the mix takes each row.

    ``weights``: a list dealt to the sources in turn, or a DataFrame (source, weight).  A
    source's target is ``water_fill``'s.  Every row is taken floor(target / source size) times
    whole; the rest of the target is filled with one more copy of some rows along the seeded
    ``row_hash``, up to a cut found from sums over all rows.  What then is left is filled by
    further ``rounds`` among the rows small enough; they are one plan, whatever their number.  The decision on a
    row is a comparison with a few numbers of its source, so wide rows are never shuffled.

    Null sources are one source; null and empty texts have size 0 and get the whole copies
    only; a source without words gets none.  Sources missing from a ``weights`` table get target
    0.  Repeated rows have equal hashes and are treated alike.  An empty table stays empty.
    """
    # a null source needs a key that joins: a flag before the text
    key = F.concat(F.when(F.col(source).isNull(), "n").otherwise("s"), F.coalesce(F.col(source), F.lit("")))
    hashed = F.shiftrightunsigned(row_hash, 1)
    rows = staged(docs.select(key.alias("_key"), F.col(source).alias("_source"), size.alias("_size"), hashed.alias("_h")),
                  "mix-rows")
    sources = staged(rows.groupBy("_key", "_source").agg(
        F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("_n")), "mix-sources")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * total_share
    filled = water_fill(staged(_priced(sources, weights), "mix-priced"), total, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # a ratio a rounding error below a whole number is that number
    filled = filled.withColumn("_whole", F.floor(ratio + F.lit(1e-9)).cast("bigint"))
    room = F.greatest(F.lit(0.0), F.round(F.col("target") - F.col("_whole") * F.col("source_size"))).cast("bigint")
    # about sqrt(rows) buckets of a large source
    buckets = F.greatest(F.lit(1), F.least(F.ceil(F.col("_n") / BUCKET_ROWS), F.ceil(F.sqrt("_n")))).cast("bigint")
    rules = staged(filled.select("_key", "source_size", "target", "_whole", room.alias("_room0"), buckets.alias("_buckets")),
                   "mix-targets")
    if rounds > 0:
        fitting = rows.join(rules.select("_key", F.col("_room0").alias("_room"), "_buckets"), "_key").filter("_size BETWEEN 1 AND _room")
        cuts = _cuts(fitting.select("_key", "_size", "_h", "_room", "_buckets"))
        rules = staged(rules.join(cuts, "_key", "left").select(
            *rules.columns, F.coalesce("_cut", F.lit(-1)).alias("_cut0"), (F.col("_room0") - F.coalesce("_used", F.lit(0))).alias("_room1")),
            "mix-cuts")
    else:
        rules = rules.withColumns({"_cut0": F.lit(-1).cast("bigint"), "_room1": F.lit(0).cast("bigint")})
    # rows that fit into what is left also fitted before: they were taken if their hash is below the cut
    left = rows.join(rules.select("_key", F.col("_room1").alias("_room"), "_cut0", "_buckets"), "_key").filter(
        "_size BETWEEN 1 AND _room AND _h > _cut0")
    later = _later_cuts(left.select("_key", "_size", "_h", "_room", "_buckets"), max(0, rounds - 1))
    rules = staged(rules.join(later, "_key", "left"), "mix-rules")

    row_size, row_h = F.col("_row._size"), F.col("_row._h")
    taken = ((row_size <= F.col("_rule._room0")) & (row_h <= F.col("_rule._cut0"))) | F.exists(
        F.col("_rule._later"), lambda e: (row_size <= e["room"]) & (row_h <= e["cut"]))
    extra = F.when((row_size > 0) & taken, 1).otherwise(0)
    copies = (F.col("_rule._whole") + extra).cast("bigint")
    kept = [c for c in docs.columns if c != out]
    wide = docs.select(*kept, F.struct(key.alias("_key"), size.alias("_size"), hashed.alias("_h")).alias("_row"))
    # the rules' columns go below one name, so no column of the documents can clash with them
    rules = rules.select(F.col("_key").alias("_rule_key"), F.struct(*[c for c in rules.columns if c != "_key"]).alias("_rule"))
    joined = wide.join(rules, F.col("_row._key") == F.col("_rule_key"), "left")
    return joined.withColumn(out, F.struct(
        row_size.alias("size"), F.col("_rule.source_size").alias("source_size"), F.col("_rule.target").alias("target"),
        copies.alias("copies"), (copies * row_size).alias("taken"))).select(*kept, out)


def repeated(mixed: DataFrame, out: str = "mix") -> DataFrame:
    """The mixed table itself: each row as often as the mix takes it, without the ``out`` column."""
    often = mixed.filter(F.col(f"{out}.copies") > 0).withColumn(
        "_turn", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"{out}.copies"))))
    return often.drop("_turn", out)
