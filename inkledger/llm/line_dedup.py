"""Repeated runs of lines, found by winnowing over line hashes.

Native: DataFrame functions only.  A run is ``window`` lines or more, not all of them blank, or a single line of
``LONG`` words or more.  Each window of ``window`` lines selects its smallest line
hash, the first of equal ones, as a fingerprint.  Two equal windows select the same line at the
same offset, so every repeated run of that length shares a fingerprint.  A fingerprint carries
the hashes of the lines around it; a match is extended both ways as far as a window reaches, and
as every window of a run has a fingerprint of its own, the extended matches join up to the run.

A line that stands in very many places would be joined with itself in all pairs of them, so from ``FEW`` places on
a fingerprint's windows are taken whole: equal windows are counted, and all but the first are repeats.  That
gives the same lines.  Long single lines are counted in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkledger.llm.common import numbered, staged

#: Occurrences of a fingerprint up to which pairs are compared; beyond it whole windows are counted.
FEW = 6
#: A place in the corpus is document number * LINES + line number; a text of more lines is an error.
LINES = 1 << 24
#: Words of a line that is a run by itself.
LONG = 10
WORD = r"[^\x20\x09-\x0D]+"


def _blank():
    return F.xxhash64(F.lit(""))


def _fingerprints(docs: DataFrame, window: int) -> DataFrame:
    """``(n, at, fp, around)``: selected lines and the hashes from window - 1 lines before to as many after."""
    starts = F.filter(F.sequence(F.lit(0), F.size("hashes") - window),
                      lambda s: F.exists(F.slice("hashes", s + 1, F.lit(window)), lambda h: h != _blank()))
    selected = F.transform(starts, lambda s: (
        s + F.array_position(F.slice("hashes", s + 1, F.lit(window)), F.array_min(F.slice("hashes", s + 1, F.lit(window)))) - 1)
        .cast("int"))
    around = F.transform(F.sequence(F.col("at") - window + 1, F.col("at") + window - 1),
                         lambda i: F.when((i >= 0) & (i < F.size("hashes")), F.get("hashes", i)))
    return (docs.filter(F.size("hashes") >= window)
            .withColumn("at", F.explode(F.array_distinct(selected)))
            .select("n", "at", F.get("hashes", F.col("at")).alias("fp"), around.alias("around")))


def _equal_run(left: str, right: str, window: int, step: int):
    """Number of equal lines next to the middle of two surroundings, going one way."""
    total, alive = F.lit(0), F.lit(True)
    for k in range(1, window):
        place = window - 1 + step * k
        alive = alive & F.coalesce(F.get(left, F.lit(place)) == F.get(right, F.lit(place)), F.lit(False))
        total = total + alive.cast("int")
    return total


def repeated_runs(docs: DataFrame, window: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, runs)``: the lines (array of first, last, from 0) that repeat earlier ones.

    A line is in a run if it lies in ``window`` consecutive lines, not all blank, that stood, in the same order,
    at an earlier place: in a document with a smaller id, or earlier in the same one; or if it has ``LONG`` words and
    more and stood earlier itself.  Lines are
    compared without white space at their ends.  Of documents that share an id the one with the
    smaller hash counts as earlier; rows equal in id and text are one document.
    """
    # an empty document has one empty line; a null has none
    cut = F.split(F.col(text), "\n", -1)
    lines = F.transform(cut, lambda line: F.xxhash64(F.trim(line, F.lit(" \t\r"))))
    lines = F.when(F.size(cut) <= LINES, lines).otherwise(F.raise_error(F.lit(f"a text of more than {LINES} lines")))
    # a line of so many words has at least as many letters, and spaces between them
    long = F.filter(F.transform(cut, lambda line, i: F.when((F.length(line) >= 2 * LONG - 1) & (F.regexp_count(line, F.lit(WORD)) >= LONG), i)),
                    lambda i: i.isNotNull())
    hashed = (docs.filter(F.col(text).isNotNull())
              .select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), lines.alias("hashes"), long.alias("long"))
              .dropDuplicates(["doc_id", "text_hash"]))
    named, _ = numbered(staged(hashed, "lines-hashed"), ["doc_id", "text_hash"], "n", "lines")
    prints = staged(_fingerprints(named.select("n", "hashes"), window), "lines-fingerprints")
    # both sides of a join, and what is joined, are written: Spark can then split the rows of a frequent line
    counts = staged(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("times")).filter("times > 1"), "lines-counts")
    known = staged(prints.join(counts, "fp"), "lines-known")

    few = known.filter(F.col("times") <= FEW)
    before = few.select("fp", F.col("n").alias("n0"), F.col("at").alias("at0"), F.col("around").alias("around0"))
    pairs = few.join(before, "fp").filter((F.col("n0") < F.col("n")) | ((F.col("n0") == F.col("n")) & (F.col("at0") < F.col("at"))))
    pairs = pairs.withColumns({"left": _equal_run("around", "around0", window, -1), "right": _equal_run("around", "around0", window, 1)})
    # the windows around the line that lie in the match, but for blank ones
    offsets = F.array(*[F.lit(s) for s in range(window)])
    lines_of = lambda s: F.slice("around", s + 1, window)
    matched = (pairs.withColumn("s", F.explode(offsets))
               .filter((F.col("left") >= window - 1 - F.col("s")) & (F.col("right") >= F.col("s")) & F.exists(lines_of(F.col("s")), lambda h: h != _blank()))
               .select("n", (F.col("at") - (window - 1) + F.col("s")).alias("first"), (F.col("at") + F.col("s")).alias("last")))

    # a frequent line: its windows are counted whole, and all but the first of each are repeats
    many = known.filter(F.col("times") > FEW)
    whole = many.withColumn("s", F.explode(offsets)).withColumn("lines", lines_of(F.col("s"))).filter(
        F.forall("lines", lambda x: x.isNotNull()) & F.exists("lines", lambda h: h != _blank()) & (F.array_min("lines") == F.col("fp"))
        & (F.array_position("lines", F.col("fp")) == F.lit(window) - F.col("s")))
    place = F.col("n") * LINES + F.col("at") - (window - 1) + F.col("s")
    single = named.select("n", "hashes", F.explode("long").alias("at")).select(
        F.get("hashes", F.col("at")).alias("fp"), F.lit(0).cast("bigint").alias("key"), (F.col("n") * LINES + F.col("at")).alias("place"), F.lit(1).alias("size"))
    whole = whole.select("fp", F.xxhash64("lines").alias("key"), place.alias("place"), F.lit(window).alias("size")).unionAll(single)
    whole = staged(whole, "lines-windows")
    first = staged(whole.groupBy("fp", "key", "size").agg(F.min("place").alias("origin"), F.count(F.lit(1)).alias("times"))
                   .filter("times > 1"), "lines-firsts")
    start = F.col("place") % LINES
    again = whole.join(first, ["fp", "key", "size"]).filter("place > origin").select(
        ((F.col("place") - start) / LINES).cast("bigint").alias("n"), start.cast("int").alias("first"),
        (start + F.col("size") - 1).cast("int").alias("last"))

    spans = matched.unionAll(again).distinct()
    # touching and overlapping spans of a document become one run
    along = Window.partitionBy("n").orderBy("first", "last")
    reach = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", F.when(F.col("first") > reach + 1, 1).otherwise(F.when(reach.isNull(), 1).otherwise(0)))
    runs = (opened.withColumn("run", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("n", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .groupBy("n").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs")))
    return runs.join(named.select("n", "doc_id", "text_hash"), "n").select("doc_id", "text_hash", "runs")


def without_repeats(docs: DataFrame, window: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later repeated runs cut out of ``text``, and ``n_lines`` and ``n_removed``.

    Null texts stay null and have no lines; an empty text is one empty line.  A document whose
    every line repeats earlier ones becomes empty.  Columns named like the two new ones are
    replaced, all others pass through.  Null ids count as one id before all others.
    """
    runs = repeated_runs(docs, window, key, text).select(
        F.col("doc_id").alias("_run_id"), F.col("text_hash").alias("_run_hash"), F.col("runs").alias("_runs"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = docs.select(*kept).join(
        runs, F.col(key).eqNullSafe(F.col("_run_id")) & (F.xxhash64(F.col(text)) == F.col("_run_hash")), "left")
    lines = F.split(F.col(text), "\n", -1)
    # what lies between the sorted runs
    run = lambda i: F.get("_runs", i)
    begin = lambda i: F.coalesce(run(i - 1)["last"] + 1, F.lit(0))
    end = lambda i: F.coalesce(run(i)["first"], F.size(lines))
    left = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_runs")), lambda i: F.slice(lines, begin(i) + 1, end(i) - begin(i))))
    removed = F.aggregate(F.coalesce("_runs", F.array().cast("array<struct<first:int,last:int>>")), F.lit(0),
                          lambda sum_, r: sum_ + r["last"] - r["first"] + 1)
    return joined.select(
        *[F.when(F.col("_runs").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")).alias(text) if c == text else c
          for c in kept],
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), removed.alias("n_removed"))
