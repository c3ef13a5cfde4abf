"""The log of a store: which folders belong to it.

A batch writes its folders under names of its own and then commits: one JSON file below
``commits``, named by the next version and made only if no other writer has made it.  Readers
take the folders that commits name, so a batch is there as a whole or not at all, and what a
batch that broke off has left counts for nothing.  A merge is a commit too: it names the parts it
replaces, and carries all parts that are left, so that nobody has to read further back.

The file is made whole and exclusively: by a hard link below a local or mounted folder, elsewhere by
Hadoop's rename without overwriting, which stores with an atomic rename (HDFS among them) decide
for one writer.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import SparkSession

PART = "struct<name:string,folder:string,rows:bigint>"
SPAN = "struct<source:string,low:bigint,high:bigint>"
#: ``whole``: the parts are all there are, not those added.
COMMIT = f"version bigint, source string, batch_id bigint, parts array<{PART}>, replaced array<string>, whole boolean, done array<{SPAN}>"


class Part(NamedTuple):
    """A folder that holds ``rows`` rows of the kept thing ``name``."""

    name: str
    folder: str
    rows: int


class State(NamedTuple):
    """A store as of ``version`` (-1: empty): its parts, and the batches it has, as spans of ids per writer."""

    version: int
    parts: tuple[Part, ...]
    done: dict[str, list[tuple[int, int]]]

    def has(self, source: str, batch_id: int) -> bool:
        return any(low <= batch_id <= high for low, high in self.done.get(source, ()))

    def sizes(self, name: str) -> dict[str, int]:
        return {p.folder: p.rows for p in self.parts if p.name == name}

    def folders(self, name: str) -> list[str]:
        return list(self.sizes(name))


def _with(spans: list[tuple[int, int]], batch_id: int) -> list[tuple[int, int]]:
    """The spans with one more id, neighbours joined."""
    out: list[tuple[int, int]] = []
    for low, high in sorted([*spans, (batch_id, batch_id)]):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file with this text; False when there is one already.  Never seen half written."""
    target, fs = _hadoop(spark, path)
    fs.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    if fs.getUri().getScheme() == "file":
        here, there = draft.toUri().getPath(), target.toUri().getPath()
        with open(here, "w", encoding="utf-8") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(here, there)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(here)
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
        return True
    except Exception:
        if not fs.exists(target):
            raise
        fs.delete(draft, False)
        return False


def names_below(spark: SparkSession, folder: str) -> list[str]:
    where, fs = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _file(out: str, version: int) -> str:
    return f"{out}/commits/{version:020d}.json"


def _rows(spark: SparkSession, out: str, versions: list[int]) -> list:
    if not versions:
        return []
    rows = spark.read.schema(COMMIT).json([_file(out, v) for v in versions]).collect()
    return sorted(rows, key=lambda r: r["version"])


def _versions(spark: SparkSession, out: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in names_below(spark, f"{out}/commits") if n.endswith(".json")]


def commits_after(spark: SparkSession, out: str, version: int) -> list:
    """The rows of all commits since."""
    return _rows(spark, out, [v for v in _versions(spark, out) if v > version])


def read_state(spark: SparkSession, out: str) -> State:
    """The store as it is now: the newest merge, which names all parts, and the commits after it."""
    versions = _versions(spark, out)
    merged = [int(n.removesuffix(".merge")) for n in names_below(spark, f"{out}/merges")]
    start = max((v for v in merged if v in set(versions)), default=0)
    parts: dict[str, Part] = {}
    done: dict[str, list[tuple[int, int]]] = {}
    version = -1
    for row in _rows(spark, out, [v for v in versions if v >= start]):
        version = row["version"]
        if row["whole"]:
            parts, done = {}, {}
            for span in row["done"]:
                done.setdefault(span["source"], []).append((span["low"], span["high"]))
        for folder in row["replaced"] or ():
            parts.pop(folder, None)
        parts.update({p["folder"]: Part(p["name"], p["folder"], p["rows"]) for p in row["parts"]})
        if row["source"] is not None:
            done[row["source"]] = _with(done.get(row["source"], []), row["batch_id"])
    return State(version, tuple(parts.values()), done)


def commit_batch(spark: SparkSession, out: str, seen: int, source: str, batch_id: int, parts: Iterable[Part]) -> bool:
    """Add a batch's parts to the store as it was at version ``seen``; False when it has changed since."""
    row = {"version": seen + 1, "source": source, "batch_id": batch_id, "parts": [p._asdict() for p in parts]}
    return create_once(spark, _file(out, seen + 1), json.dumps(row))


def commit_merge(spark: SparkSession, out: str, state: State, replaced: Iterable[str], added: Part) -> bool:
    """Put one part in the place of others; False when the store has changed since ``state``."""
    gone = set(replaced)
    left = [p for p in state.parts if p.folder not in gone] + [added]
    done = [{"source": s, "low": low, "high": high} for s, spans in state.done.items() for low, high in spans]
    row = {"version": state.version + 1, "parts": [p._asdict() for p in left], "replaced": sorted(gone), "whole": True, "done": done}
    if not create_once(spark, _file(out, state.version + 1), json.dumps(row)):
        return False
    # only tells readers where to begin: without it they read more
    create_once(spark, f"{out}/merges/{state.version + 1:020d}.merge", "")
    return True


def remove(spark: SparkSession, folder: str) -> None:
    where, fs = _hadoop(spark, folder)
    fs.delete(where, True)

