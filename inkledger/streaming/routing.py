"""Routing while source files and results arrive, each as a stream and in either order.

Parts of the store ``routes`` (see ``commits``):
  results, files  what has arrived in time, by its own time ``at``
  routes          results with each file they have met, and those that met none in time
  times           the time up to which no more rows are taken, a row a batch

No row is held in a stream's state.  A batch is joined with what is kept as tables are, so that memory is bounded by
a task's share however many rows still wait: new results meet all files, new files the results kept before.  As with
Spark's watermarks, the lesser of both streams' latest times since the start, less ``wait``, is a time that rises with the batches and
never falls.  Rows at or before it are too late; a result ``wait`` behind it can meet no further file, and if there is
none of its job near it among the files kept, it gets a row without one.
"""

from __future__ import annotations

import uuid
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkledger.functions.parse import job_id_from_key
from inkledger.model import JOB_TAG
from inkledger.operators.routing import moves
from inkledger.session import write_by
from inkledger.streaming.commits import Part, State, commit_batch, read_state
from inkledger.streaming.ingest import FAN, MERGED_ROWS, compact, prepare, writer_of

ROUTES = "job_id string, invoice_number string, status string, source_key string"
RESULTS = "job_id string, invoice_number string, status string, at timestamp"
FILES = "job_id string, source_key string, at timestamp"
TIMES = "closed bigint"
#: Rows up to which a side may be broadcast: keys pack so well that the size of their files says little of them in memory.
FEW = 100_000


def _millis(spark: SparkSession, wait: str) -> int:
    return spark.range(1).select(F.expr(f"unix_millis(timestamp'1970-01-01 00:00:00Z' + INTERVAL {wait})")).first()[0]


def _after(millis: int) -> Column:
    return F.col("at") > F.timestamp_millis(F.lit(millis))


def _read(spark: SparkSession, folders: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _closed(spark: SparkSession, state: State) -> int:
    """The time up to which no more rows are taken; it begins with 0."""
    return _read(spark, state.folders("times"), TIMES).agg(F.coalesce(F.max("closed"), F.lit(0))).first()[0]


def _past(closed: int, wait: int) -> int:
    """The time up to which a row can meet nothing that still may come."""
    return closed - wait - 1


def _with_file(results: DataFrame, files: DataFrame, rows: int, wait: str, how: str = "inner") -> DataFrame:
    """Results with the files of their job whose time is near; ``rows`` are those of the side that Spark might broadcast."""
    files = files if rows <= FEW else files.hint("merge")
    files = files.select(F.col("job_id").alias("file_job"), "source_key", F.col("at").alias("uploaded_at"))
    near = F.expr(f"uploaded_at BETWEEN at - INTERVAL {wait} AND at + INTERVAL {wait}")
    return results.join(files, (F.col("job_id") == F.col("file_job")) & near, how)


def route_batch(spark: SparkSession, arrived: DataFrame, batch_id: int, routes: str, wait: str, source: str, latest: dict[str, int]) -> None:
    """Route one batch of results and files (``side`` tells which); a batch that is in the log already is left alone.

    ``spark`` is the session that joins, ``latest`` the latest time of each stream since its start, which the batch brings up to date.
    """
    span = _millis(spark, wait)
    while True:
        state = read_state(spark, routes)
        if state.has(source, batch_id):
            return
        name = f"attempt={source}-{batch_id}-{uuid.uuid4().hex[:12]}"
        parts = _write_batch(spark, arrived, state, routes, name, wait, span, latest)
        if commit_batch(spark, routes, state.version, source, batch_id, parts):
            return


def _write_batch(spark: SparkSession, arrived: DataFrame, state: State, routes: str, name: str, wait: str, span: int,
                 latest: dict[str, int]) -> list[Part]:
    closed = _closed(spark, state)
    # a row without time meets nothing and is never past
    told, folder = Observation(), f"{routes}/arrived/{name}"
    counts = [f(F.when(F.col("side") == side, F.unix_millis("at"))).alias(f"{f.__name__}_{side}") for side in ("results", "files") for f in (F.count, F.max)]
    write_by(arrived.filter(_after(closed)).observe(told, *counts), "side", folder)
    got = told.get
    parts = [Part(side, f"{folder}/side={side}", got[f"count_{side}"]) for side in ("results", "files") if got[f"count_{side}"]]
    for part in parts:
        latest[part.name] = max(latest.get(part.name, 0), got[f"max_{part.name}"])
    rises = max(closed, min(latest.values()) - span) if len(latest) == 2 else closed
    spark.range(1).select(F.lit(rises).cast("bigint").alias("closed")).write.parquet(f"{routes}/times/{name}")
    old = {side: state.sizes(side) for side in ("results", "files")}
    new = {side: {p.folder: p.rows for p in parts if p.name == side} for side in old}
    schemas, past, then = {"results": RESULTS, "files": FILES}, _past(closed, span), _past(rises, span)

    def rows(side: str, sizes: dict[str, int], since: int = past) -> DataFrame:
        return _read(spark, list(sizes), schemas[side]).filter(_after(since))

    pairs, results, files = [], old["results"] | new["results"], old["files"] | new["files"]
    for some, others in ((new["results"], files), (old["results"], new["files"])):
        if some and others:
            pairs.append(_with_file(rows("results", some), rows("files", others), min(sum(some.values()), sum(others.values())), wait))
    if then > past and results:
        due = rows("results", results).filter(~_after(then))
        # who has no job needs no look, and would come to one task with all others that have none
        left = _with_file(due.filter(F.col("job_id").isNotNull()), rows("files", files, past - span), sum(files.values()), wait, "left_anti")
        pairs.append(left.unionAll(due.filter(F.col("job_id").isNull())).withColumn("source_key", F.lit(None).cast("string")))
    parts.append(Part("times", f"{routes}/times/{name}", 1))
    if pairs:
        routed = reduce(DataFrame.unionAll, [p.select("job_id", "invoice_number", "status", "source_key") for p in pairs])
        parts.append(_write(routed, "routes", f"{routes}/routes/{name}"))
    return parts


def _write(rows: DataFrame, name: str, folder: str) -> Part:
    told = Observation()
    rows.observe(told, F.count(F.lit(1)).alias("n")).write.parquet(folder)
    return Part(name, folder, told.get["n"])


def compact_routes(spark: SparkSession, routes: str, wait: str, fan: int = FAN) -> int:
    """Merge small parts; results and files that can meet nothing any more are left out."""
    span = _millis(spark, wait)

    def merge(session: SparkSession, name: str, parts: list[Part], where: str) -> Part:
        folder = f"{where}/{name}/attempt=merge-{len(parts)}-{uuid.uuid4().hex[:12]}"
        schema = {"results": RESULTS, "files": FILES, "routes": ROUTES, "times": TIMES}[name]
        rows = session.read.schema(schema).parquet(*[p.folder for p in parts])
        if name == "times":
            return _write(rows.agg(F.max("closed").alias("closed")), name, folder)
        if name != "routes":
            past = _past(_closed(session, read_state(session, where)), span)
            # whether a result has met a file is looked up among those near it, which may be ``wait`` before it
            rows = rows.filter(_after(past if name == "results" else past - span))
        return _write(rows.coalesce(ceil(max(sum(p.rows for p in parts), 1) / MERGED_ROWS)), name, folder)

    return compact(spark, routes, fan, merge)


def start_routing(results: DataFrame, files: DataFrame, routes: str, checkpoint: str, wait: str = "1 hour",
                  available_now: bool = True, interval: str = "1 minute", fan: int = FAN) -> StreamingQuery:
    """Join stored results with the files that carry their job id, as both arrive.

    ``results`` has ``invoice_number``, ``status``, ``s3_key`` and ``processed_at``, ``files`` has ``key``, ``tags`` and
    ``uploaded_at``.  A result and its file may be up to ``wait`` apart, by their own times, and either may come first.
    What has met no file when both streams are ``wait`` past it gets a row without one; a file later than that
    is no longer matched.  Both sides are kept only as long as they can still match; after every ``fan`` batches small parts are merged.
    """
    spark, none, latest = results.sparkSession, F.lit(None).cast("string"), {}
    source = writer_of(spark, checkpoint)
    prepare(spark, routes)
    left = results.select(F.lit("results").alias("side"), job_id_from_key(F.col("s3_key")).alias("job_id"), "invoice_number", "status",
                          none.alias("source_key"), F.col("processed_at").cast("timestamp").alias("at"))
    right = files.select(F.lit("files").alias("side"), F.col("tags")[JOB_TAG].alias("job_id"), none.alias("invoice_number"), none.alias("status"),
                         F.col("key").alias("source_key"), F.col("uploaded_at").cast("timestamp").alias("at")).filter(F.col("job_id").isNotNull())

    def route(batch: DataFrame, batch_id: int) -> None:
        # not the batch's own session, which may plan without AQE
        route_batch(spark, batch, batch_id, routes, wait, source, latest)
        if batch_id % fan == fan - 1:
            compact_routes(spark, routes, wait, fan)

    writer = left.unionAll(right).writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_routes(spark: SparkSession, routes: str, incoming: str, processed: str, failed: str) -> DataFrame:
    """The routing manifest so far; of several files of one job the first by key counts, as in the batch."""
    met = _read(spark, read_state(spark, routes).folders("routes"), ROUTES)
    first = met.groupBy("job_id", "invoice_number", "status").agg(F.min("source_key").alias("source_key"))
    return moves(first, incoming, processed, failed)
