"""Continuous ingestion of extraction documents into one append-only fact table.

Layout below ``out``:
  commits/                the log: which folders count (see ``commits``)
  outcomes/attempt=NAME/  a batch's documents with their final outcome
  numbers/attempt=NAME/   its accepted invoice numbers (see ``numbers``)
  sums|newest|vendors/    its partial results (see ``kept``)
  working/attempt=NAME/   staged rows, claims and refusals while it runs

A writer is a bulk load or a stream's checkpoint; its batches have ids.  A batch is stored once: it writes
its folders under the name of this attempt, then commits them together.  An attempt that
broke off is in no commit, so its numbers are free and its rows unseen; the same batch, or the
same documents under any other name, can be stored again.  A batch that is in the log already is left alone.

Writers run side by side.  Each decides on the store it has seen, and commits only if that is still
the newest version; else it looks at the numbers of the commits in between, gives up those it has lost
and tries again.  The commit decides who stored a number first, as the database's unique key did.

Staging cuts the lineage: the JSON is parsed once and row ids survive retries.  Claims and
refusals are narrow tables of known size, so Spark can tell whether to broadcast them;
with few refusals the documents themselves are never shuffled.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from math import ceil
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkledger.operators.decide import ACCEPTED, dedupe_invoices, process_documents, set_outcome
from inkledger.operators.extract import extract_flatten
from inkledger.operators.store import assign_keys
from inkledger.session import ROW_GROUP, write_by
from inkledger.sources.extractions import filter_result_files
from inkledger.streaming.commits import (
    Part, State, commit_batch, commit_merge, commits_after, names_below, read_state, remove,
)
from inkledger.streaming.kept import KEPT, read_kept
from inkledger.streaming.numbers import held, read_numbers, write_numbers

IDENTITY = ("arrival", "s3_key", "row_id")
#: The writer of batches whose caller names none.
BATCHES = "batches"
#: Parts of about one size that are merged into one.
FAN = 8
#: Documents in a file of a merged part, at least while it has so many.
MERGED_ROWS = 100_000


def _stage(documents: DataFrame, processed_at: Column, strict: bool, keys: dict[str, Column]) -> DataFrame:
    flat = extract_flatten(filter_result_files(documents), strict)
    processed = process_documents(flat).withColumn("processed_at", processed_at)
    return assign_keys(processed, **keys).withColumn("row_id", F.monotonically_increasing_id())


def read_outcomes(spark: SparkSession, out: str) -> DataFrame:
    """Everything decided so far, with the writer and batch that decided it; needs at least one stored batch."""
    return _read_rows(spark, out, read_state(spark, out).folders("outcomes"))


def _read_rows(spark: SparkSession, out: str, folders: list[str]) -> DataFrame:
    return spark.read.option("basePath", f"{out}/outcomes").parquet(*folders).drop("attempt")


def read_accepted(spark: SparkSession, out: str) -> DataFrame:
    return read_outcomes(spark, out).filter(F.col("outcome") == ACCEPTED)


def read_partial(spark: SparkSession, out: str, name: str) -> DataFrame:
    """One of the kept partial results (``kept.KEPT``) of the whole store, merged; reads no documents."""
    return read_kept(spark, read_state(spark, out).folders(name), name)


def taken_numbers(spark: SparkSession, state: State, claims: DataFrame, through: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    """Claimed numbers that the store has."""
    return held(spark, state.sizes("numbers"), claims, through)


class Attempt(NamedTuple):
    """A batch whose folders are written and not yet committed."""

    out: str
    source: str
    batch_id: int
    name: str
    #: The version of the store that the batch was decided on.
    seen: int
    parts: tuple[Part, ...]


def _through(spark: SparkSession, folder: str) -> Callable[[str, DataFrame], DataFrame]:
    def through(name: str, df: DataFrame) -> DataFrame:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    return through


def write_batch(documents: DataFrame, batch_id: int, out: str, processed_at: Column | None = None, strict: bool = False,
                keys: dict[str, Column] | None = None, source: str = BATCHES) -> Attempt | None:
    """Decide one batch on the store as it is now and write its folders; None when the log has the batch."""
    spark = documents.sparkSession
    clock = F.current_timestamp() if processed_at is None else processed_at
    state = read_state(spark, out)
    if state.has(source, batch_id):
        return None
    if not re.fullmatch(r"[\w-]+", source):
        raise ValueError(f"a writer's name is letters, digits, - and _: {source}")
    name = f"attempt={source}-{batch_id}-{uuid.uuid4().hex[:12]}"
    through = _through(spark, f"{out}/working/{name}")
    staged = through("staged", _stage(documents, clock, strict, keys or {}))
    candidates = staged.select("invoice_number", "error", *IDENTITY)
    claims = through("claims", dedupe_invoices(candidates, IDENTITY).select("invoice_number", "row_id"))
    won = through("won", claims.join(taken_numbers(spark, state, claims, through), "invoice_number", "left_anti"))
    return Attempt(out, source, batch_id, name, state.version, _write_parts(spark, out, name, name, source, batch_id, won))


def _write_parts(spark: SparkSession, out: str, work: str, name: str, source: str, batch_id: int, won: DataFrame) -> tuple[Part, ...]:
    """The folders of a batch whose documents in ``won`` have got their numbers."""
    through = _through(spark, f"{out}/working/{name}")
    staged = spark.read.parquet(f"{out}/working/{work}/staged")
    lost = staged.filter(F.col("error").isNull()).select("row_id").join(won.select("row_id"), "row_id", "left_anti")
    refused = through("refused", lost)
    marked = set_outcome(staged.join(refused.withColumn("_lost", F.lit(True)), "row_id", "left")).withColumns(
        {"source": F.lit(source), "batch_id": F.lit(batch_id).cast("bigint")})
    folder = {k: f"{out}/{k}/{name}" for k in ("outcomes", "numbers", *KEPT)}
    told = Observation()
    write_by(marked.observe(told, F.count(F.lit(1)).alias("n"), F.count_if(F.col("outcome") == ACCEPTED).alias("stored")),
             "outcome", folder["outcomes"])
    accepted = spark.read.schema(marked.schema).parquet(folder["outcomes"]).filter(F.col("outcome") == ACCEPTED)
    stored = told.get["stored"]

    def write(name: str) -> Part:
        if name == "numbers":
            write_numbers(won.select("invoice_number"), stored, folder[name])
            return Part(name, folder[name], stored)
        return _write_kept(KEPT[name].build(accepted), name, folder[name])

    # small tables that do not depend on each other
    with ThreadPoolExecutor(4) as pool:
        parts = list(pool.map(inheritable_thread_target(spark)(write), ("numbers", *KEPT)))
    parts.append(Part("outcomes", folder["outcomes"], told.get["n"]))
    return tuple(parts)


def _write_kept(rows: DataFrame, name: str, folder: str) -> Part:
    told = Observation()
    rows.observe(told, F.count(F.lit(1)).alias("n")).write.parquet(folder)
    return Part(name, folder, told.get["n"])


def commit_attempt(spark: SparkSession, attempt: Attempt) -> int | None:
    """Make an attempt part of the store and return its version; None when the batch got there by another attempt.

    Numbers that commits since the attempt's version have stored are lost to it: its folders are
    written again without them, from its staged rows.
    """
    out, seen, parts = attempt.out, attempt.seen, attempt.parts
    while not commit_batch(spark, out, seen, attempt.source, attempt.batch_id, parts):
        since = commits_after(spark, out, seen)
        if any((r["source"], r["batch_id"]) == (attempt.source, attempt.batch_id) for r in since):
            return None
        # what a merge puts together was there before, or is in one of the other commits
        fresh = {p["folder"]: p["rows"] for r in since if not r["whole"] for p in r["parts"] if p["name"] == "numbers"}
        mine = next(p.folder for p in parts if p.name == "numbers")
        again = f"{attempt.name}.{uuid.uuid4().hex[:12]}"
        through = _through(spark, f"{out}/working/{again}")
        lost = through("lost", held(spark, fresh, read_numbers(spark, [mine]), through))
        if not lost.isEmpty():
            still = read_numbers(spark, [mine]).select("invoice_number").join(lost, "invoice_number", "left_anti")
            claims = spark.read.schema("invoice_number string, row_id bigint").parquet(f"{out}/working/{attempt.name}/claims")
            won = through("won", claims.join(still, "invoice_number", "left_semi"))
            parts = _write_parts(spark, out, attempt.name, again, attempt.source, attempt.batch_id, won)
        seen = since[-1]["version"]
    remove(spark, f"{out}/working/{attempt.name}")
    return seen + 1


def store_batch(documents: DataFrame, batch_id: int, out: str, processed_at: Column | None = None,
                strict: bool = False, keys: dict[str, Column] | None = None, source: str = BATCHES) -> None:
    """Decide and store one batch of the writer ``source``; a batch that is stored already is left alone."""
    attempt = write_batch(documents, batch_id, out, processed_at, strict, keys, source)
    if attempt is not None:
        commit_attempt(documents.sparkSession, attempt)


def load_documents(documents: DataFrame, out: str, processed_at: Column | None = None, strict: bool = False,
                   keys: dict[str, Column] | None = None, name: str | None = None) -> str:
    """Store a finite set of documents as a writer of its own, whose name is returned.

    A load that broke off is resumed by calling it again, under its name or without one: nothing of it
    counts before its commit, and once it has one, the same name stores nothing more.  May run beside
    streams and other loads on one store.
    """
    source = f"load-{uuid.uuid4().hex}" if name is None else name
    store_batch(documents, 0, out, processed_at, strict, keys, source)
    return source


def unfinished(spark: SparkSession, out: str, source: str) -> list[str]:
    """Folders of attempts of a writer that no commit names."""
    named = {p.folder for p in read_state(spark, out).parts}
    below = [f"{out}/{kind}/{n}" for kind in ("outcomes", "numbers", *KEPT, "working") for n in names_below(spark, f"{out}/{kind}")
             if n.rsplit("-", 2)[0] == f"attempt={source}"]
    return [folder for folder in below if folder not in named]


def release(spark: SparkSession, out: str, source: str) -> int:
    """Remove what a writer's broken attempts have left; only while no run of that writer is going on."""
    left = unfinished(spark, out, source)
    for folder in left:
        remove(spark, folder)
    return len(left)


def _merge_part(spark: SparkSession, name: str, parts: list[Part], out: str) -> Part:
    folder = f"{out}/{name}/attempt=merge-{len(parts)}-{uuid.uuid4().hex[:12]}"
    if name == "numbers":
        rows = sum(p.rows for p in parts)
        write_numbers(read_numbers(spark, [p.folder for p in parts]).select("invoice_number"), rows, folder)
        return Part(name, folder, rows)
    if name == "outcomes":
        old = _read_rows(spark, out, [p.folder for p in parts])
        rows = sum(p.rows for p in parts)
        # files are put together as they are read: nothing is shuffled
        write_by(old.coalesce(ceil(max(rows, 1) / MERGED_ROWS)), "outcome", folder)
    else:
        return _write_kept(KEPT[name].merge(spark.read.parquet(*[p.folder for p in parts])), name, folder)
    return Part(name, folder, rows)


def compact(spark: SparkSession, out: str, fan: int = FAN,
            merge_part: Callable[[SparkSession, str, list[Part], str], Part] | None = None) -> int:
    """Merge parts of about one size, ``fan`` at least, until there are none; returns the number of merges.

    Sizes grow by ``fan`` from tier to tier, so a row is written again once a tier, and a store of
    many batches has some ``fan`` parts a tier.  Replaced folders stay for readers that have begun with them;
    writers may go on meanwhile, and a merge that another one has overtaken is dropped.  Stores that keep other
    things pass their own ``merge_part``.
    """
    merge, merges = merge_part or _merge_part, 0
    while True:
        state = read_state(spark, out)
        tiers: dict[tuple[str, int], list[Part]] = {}
        for part in state.parts:
            tier, size = 0, part.rows
            while size >= fan:
                tier, size = tier + 1, size // fan
            tiers.setdefault((part.name, tier), []).append(part)
        due = [parts for parts in tiers.values() if len(parts) >= fan]
        if not due:
            return merges
        parts = due[0]
        added = merge(spark, parts[0].name, parts, out)
        while not commit_merge(spark, out, state, [p.folder for p in parts], added):
            state = read_state(spark, out)
            if not {p.folder for p in parts} <= {p.folder for p in state.parts}:
                break
        else:
            merges += 1


def prepare(spark: SparkSession, out: str) -> None:
    """Make the log's folder, so that a stream may follow it before the first batch."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/commits")
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of a stream's writer, kept inside its checkpoint: a new checkpoint is a new writer."""
    path = f"{checkpoint}/writer"
    spark.range(1).select(F.lit(f"stream-{uuid.uuid4().hex}").alias("name")).write.mode("ignore").parquet(path)
    return spark.read.schema("name string").parquet(path).first()["name"]


def start_ingest(documents: DataFrame, out: str, checkpoint: str, processed_at: Column | None = None,
                 strict: bool = False, keys: dict[str, Column] | None = None,
                 available_now: bool = True, interval: str = "1 minute", fan: int = FAN) -> StreamingQuery:
    """Store every arriving document; with ``available_now`` stop when all present ones are stored.

    After every ``fan`` batches the store's small parts are merged.
    """
    spark = documents.sparkSession
    source = writer_of(spark, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, out, processed_at, strict, keys, source)
        if batch_id % fan == fan - 1:
            compact(batch.sparkSession, out, fan)

    writer = documents.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
