"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are partitioned by the size of their shingle sets (powers of two).  A MinHash of a
long document says nothing about a short passage inside it, so for each size class documents
are seen through windows of a width fitted to the class, each overlapping the next by half.
An item is a candidate for a document when one of its minima is the minimum of a window, under
the same function; the similarity of a passage and its window is at least a fifth, so that
64 functions miss one in a million.  Candidates are verified on whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkledger.llm.words import as_bytes, permutations, shared, shingle_run

FUNCTIONS = 64
#: Items sent to the tasks at once, by number and by bytes of text; more items take several passes.
ITEMS_AT_ONCE = 20_000
BYTES_AT_ONCE = 32 << 20
A, B = permutations(FUNCTIONS, 8)
MAP_BITS = 20


@dataclass(frozen=True)
class Item:
    """A test item: its id, shingle set and size class."""

    item_id: int
    shingles: np.ndarray
    size_class: int

    @property
    def window(self) -> int:
        """Shingles in a window of this class: twice the largest item's, in steps of that size."""
        return 4 << self.size_class


class ItemIndex:
    """The items of one pass: which shingle is the minimum of which item under which function."""

    def __init__(self, rows: list[tuple[int, bytes]], words: int):
        self.items, entries = [], {}
        for item_id, text in rows:
            shingles = np.unique(shingle_run(text, words))
            if len(shingles):
                self.items.append(Item(item_id, shingles, int(len(shingles)).bit_length() - 1))
        for at, item in enumerate(self.items):
            least = (A[:, None] * item.shingles[None, :] + B[:, None]).argmin(axis=1)
            for function, place in enumerate(least):
                entries.setdefault(int(item.shingles[place]), []).append((at, function))
        self.keys = np.array(sorted(entries), np.uint64)
        self.entries = [entries[int(k)] for k in self.keys]
        # a map of the keys' leading bits spares most shingles the search
        self.map = np.zeros(1 << MAP_BITS, bool)
        self.map[(self.keys >> np.uint64(64 - MAP_BITS)).astype(np.int64)] = True

    def matches(self, text: bytes, words: int, threshold: int) -> list[tuple[int, int, int]]:
        """(item_id, shared, size) of every item whose shingles the text has to ``threshold`` percent."""
        run = shingle_run(text, words)
        if not len(run) or not len(self.keys):
            return []
        maybe = np.flatnonzero(self.map[(run >> np.uint64(64 - MAP_BITS)).astype(np.int64)])
        if not len(maybe):
            return []
        found = np.minimum(np.searchsorted(self.keys, run[maybe]), len(self.keys) - 1)
        hit = self.keys[found] == run[maybe]
        candidates: set[int] = set()
        seen: dict[tuple[int, int, int], int] = {}
        for place, key in zip(maybe[hit], found[hit]):
            for at, function in self.entries[key]:
                if at in candidates:
                    continue
                item = self.items[at]
                half = item.window // 2
                # the two windows over this place; the last ones end with the text
                for start in ((place // half) * half, (place // half - 1) * half):
                    if start < 0:
                        continue
                    window = (start, item.window, function)
                    low = seen.get(window)
                    if low is None:
                        part = run[start:start + item.window]
                        low = seen[window] = int((A[function] * part + B[function]).min())
                    if low == int((A[function] * run[place:place + 1] + B[function])[0]):
                        candidates.add(at)
                        break
        if not candidates:
            return []
        whole, out = np.unique(run), []
        for at in sorted(candidates):
            item = self.items[at]
            both = shared(item.shingles, whole)
            if 100 * both >= threshold * len(item.shingles):
                out.append((item.item_id, both, len(item.shingles)))
        return out


def item_passes(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, bytes]]]:
    """The items in groups whose number and size are bounded; each group goes to the tasks as a whole."""
    rows = benchmark.select(F.col(key).cast("bigint").alias("item_id"), F.col(text).alias("text")).dropna().distinct()
    group, size = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        data = row["text"].encode()
        if group and (len(group) >= ITEMS_AT_ONCE or size + len(data) > BYTES_AT_ONCE):
            yield group
            group, size = [], 0
        group.append((row["item_id"], data))
        size += len(data)
    if group:
        yield group


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                  threshold: int = 80) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_item)``: items of whose ``words``-word shingles a document has ``threshold`` percent.

    Null and empty texts on either side match nothing; items without an id are left out.  A text
    of fewer than ``words`` words is one shingle and matches a text that has just those words.
    Items that repeat with the same id and text count once; an id with several texts gives a row
    for each that matches.  Rows of ``docs`` that repeat are reported each.
    """
    out = None
    for group in item_passes(benchmark):
        def search(batches: Iterator[pa.RecordBatch], group=group) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(group, words)
            for batch in batches:
                ids, rows = batch.column("doc_id").to_pylist(), []
                for doc_id, data in zip(ids, as_bytes(batch.column("text"))):
                    rows += [(doc_id, *match) for match in index.matches(data, words, threshold)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else
                                                 [pa.array([], pa.int64())] * 4, ["doc_id", "item_id", "n_shared", "n_item"])

        named = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        found = named.mapInArrow(search, "doc_id bigint, item_id bigint, n_shared bigint, n_item bigint")
        out = found if out is None else out.unionAll(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, n_shared bigint, n_item bigint")
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", words: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs`` that hold no test item, unchanged; a pass for each group of items, no shuffle."""
    for group in item_passes(benchmark):
        def clean(batches: Iterator[pa.RecordBatch], group=group) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(group, words)
            for batch in batches:
                keep = [not index.matches(data, words, threshold) for data in as_bytes(batch.column(text))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
