"""Ranked lexical search: documents grouped by which of an item's terms they hold.

Terms are runs of ASCII letters and digits and of characters from U+0080 on, A-Z lower-cased.
A term's weight falls with the number of documents that hold it; what one occurrence adds is
damped by the number of occurrences and by the document's length; a score sums the item's
terms, once each.  All of it is 64-bit integer arithmetic, but for the logarithm in a weight.

How it runs
  index    each task cuts its documents into blocks and writes, per block and term, the places of
           the documents that hold the term and how often.  Only terms that some item may hold are
           kept: a bitmap of term hashes, one megabyte however many items there are, is sent to
           the tasks; what passes by accident is left by the join with the items' terms.
  search   items are dealt to groups of at most ``GROUP``; a block's postings meet a group's items by
           an equi-join on the term.  Inside one (block, group) an item's terms are laid over each
           other as bit planes: every document gets the mask of terms it holds.  Distinct masks are
           taken by falling maximum score (each held term at the most it adds in this block) until
           the next one cannot reach the last place any more.
  ranking  the best of each block are merged per item by a window with a limit.

No item, term list or posting passes through the driver.  A term in all documents is one row a
block; a block and a group are both bounded, so no task holds an unbounded group.

Defined results: a null or blank text has no term and is in no count; a null ``doc_id`` ranks after
other ids of its score; every row is a document of its own, so repeated rows take places of their own.
Rows of ``benchmark`` with one item_id are one item with the terms of all; a null item_id is left out.
Items without terms, or without documents, have no rows.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkledger.llm.blocks import Numbers, binaries, flat, text_blocks
from inkledger.llm.common import numbered, staged
from inkledger.llm.words import as_bytes

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Every byte as a term has it; what is in no term becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
BLOCK_DOCS, BLOCK_BYTES = 8192, 16 << 20
#: Items of one search group.
GROUP = 256
#: Bits of the filter over term hashes, and how many of them Spark keeps in one bitmap.
FILTER_BITS, BITMAP_BITS = 1 << 23, 32768
#: Terms laid over each other in one word of a mask.
PLANES = 63
INDEX = "block bigint, term binary, n_docs bigint, places binary, counts binary, ids array<bigint>, lengths array<bigint>"
FOUND = "item int, doc_id bigint, score bigint"


def item_terms(items: DataFrame) -> tuple[DataFrame, int]:
    """Each item's distinct terms as ``(item_id, item, term)``, staged; ``item`` counts from 0.  And the number of items."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for key, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                own = set(text.translate(FOLD).split())
                ids += [key] * len(own)
                terms += own
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])

    known = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("item_id IS NOT NULL")
    pairs = staged(known.mapInArrow(split, "item_id bigint, term binary").distinct(), "rank-items")
    keyed, n = numbered(pairs.select("item_id").distinct(), ["item_id"], "item", "rank-numbers")
    return staged(pairs.join(keyed, "item_id").select("item_id", F.col("item").cast("int").alias("item"), "term"), "rank-terms"), n


def term_filter(terms: DataFrame) -> np.ndarray:
    """A bit for each hash that a term of ``terms`` has: ``FILTER_BITS`` bits, whatever there is."""
    spot = F.crc32("term").bitwiseAND(FILTER_BITS - 1)
    maps = terms.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    bits = np.zeros(FILTER_BITS + BITMAP_BITS, bool)
    for row in maps.collect():  # at most FILTER_BITS / BITMAP_BITS + 1 rows of 4 KB
        # Spark counts buckets from 1 for positive numbers; number 0 is in bucket 0, at bit 0
        held = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little").astype(bool)
        first = (row["bucket"] - 1) * BITMAP_BITS + 1 if row["bucket"] else 0
        bits[first:first + len(held)] |= held
    return np.packbits(bits[:FILTER_BITS])


def index(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Blocks of all documents: a row per block and wanted term, and one per block (``term`` null) with ids and lengths."""
    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(wanted).astype(bool)
        for block, keys, texts in text_blocks(batches, BLOCK_DOCS, BLOCK_BYTES):
            vocabulary = Numbers()
            runs = []
            for text in texts:
                words = text.translate(FOLD).split()
                runs.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
            lengths = np.fromiter(map(len, runs), np.int64, len(runs))
            names = list(vocabulary)
            hashes = np.fromiter(map(crc32, names), np.int64, len(names)) & (FILTER_BITS - 1)
            flow = np.concatenate(runs)
            kept = bits[hashes][flow] if len(names) else np.zeros(0, bool)
            held = flow[kept].astype(np.int64) * len(runs) + np.repeat(np.arange(len(runs)), lengths)[kept]
            pairs, counts = np.unique(held, return_counts=True)
            which, first, n = np.unique(pairs // len(runs), return_index=True, return_counts=True)
            places, ends = (pairs % len(runs)).astype("<u2"), first + n
            none = pa.nulls
            yield pa.record_batch([
                pa.array([block]), none(1, pa.binary()), pa.array([int((lengths > 0).sum())]), none(1, pa.binary()), none(1, pa.binary()),
                pa.array([keys], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64()))], names=_names())
            yield pa.record_batch([
                pa.array(np.full(len(which), block)), pa.array([names[i] for i in which], pa.binary()), pa.array(n.astype(np.int64)),
                binaries(places.view(np.uint8), ends * 2), binaries(counts.astype("<u4").view(np.uint8), ends * 4),
                none(len(which), pa.list_(pa.int64())), none(len(which), pa.list_(pa.int64()))], names=_names())

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return staged(rows.mapInArrow(invert, INDEX), "rank-index")


def _names() -> list[str]:
    return [part.split()[0] for part in INDEX.split(", ")]


def weighted(terms: DataFrame, postings: DataFrame, n_docs: int) -> DataFrame:
    """Per term and group the items of the group that hold the term, at most ``GROUP``, and its weight."""
    frequency = postings.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.ln((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    return (terms.groupBy("term", F.floor(F.col("item") / GROUP).cast("int").alias("part")).agg(F.collect_list("item").alias("items"))
            .join(frequency, "term").select("term", "part", "items", weight.alias("weight")))


class Block:
    """One block's documents with the postings of one group's terms."""

    def __init__(self, table: pa.Table, n_docs: int, n_terms: int):
        facts = table.filter(pc.is_null(table["term"]))
        ids, lengths = facts["ids"][0].values, facts["lengths"][0].values.to_numpy()
        self.nameless = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        damping = 10 + (90 * lengths * n_docs) // n_terms
        rows = table.filter(pc.is_valid(table["term"]))
        (places, ends), (counts, _) = flat(rows["places"]), flat(rows["counts"])
        places, counts, ends = places.view("<u2").astype(np.int64), counts.view("<u4").astype(np.int64), ends // 2
        gains = (1_000_000_000 * counts) // (1000 * counts + 8 * damping[places])
        starts = ends - np.diff(ends, prepend=0)
        self.terms = [(places[a:b], gains[a:b]) for a, b in zip(starts, ends)]
        self.weights = rows["weight"].to_pylist()
        self.of: dict[int, list[int]] = {}
        for i, items in enumerate(rows["items"].to_pylist()):
            for item in items:
                self.of.setdefault(item, []).append(i)

    def masks(self, held: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The documents with any of the terms, the number of each one's mask, and the masks as rows of bits."""
        planes = np.zeros((len(self.ids), -(-len(held) // PLANES)), np.uint64)
        for at, i in enumerate(held):
            planes[self.terms[i][0], at // PLANES] |= np.uint64(1 << at % PLANES)
        docs = np.flatnonzero(planes.any(axis=1))
        if planes.shape[1] == 1:
            distinct, mask = np.unique(planes[docs, 0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            distinct, mask = np.unique(planes[docs], axis=0, return_inverse=True)
        at = np.arange(len(held))
        return docs, mask.reshape(-1), (distinct[:, at // PLANES] >> (at % PLANES).astype(np.uint64)) & np.uint64(1) > 0

    def scores(self, docs: np.ndarray, held: list[int]) -> np.ndarray:
        total = np.zeros(len(docs), np.int64)
        for i in held:
            places, gains = self.terms[i]
            at = np.minimum(np.searchsorted(places, docs), len(places) - 1)
            total += np.where(places[at] == docs, gains[at] * self.weights[i], 0)
        return total

    def best(self, item: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the item's ``top`` documents in this block."""
        held = self.of[item]
        docs, mask, bits = self.masks(held)
        most = bits @ np.array([int(self.terms[i][1].max()) * self.weights[i] for i in held], np.int64)
        order = np.argsort(-most, kind="stable")
        # the documents of each mask, masks by falling maximum
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        by_mask = np.argsort(rank[mask], kind="stable")
        ends = np.cumsum(np.bincount(rank[mask], minlength=len(order)))
        places, scores, done = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        step = 4 * top
        while done < len(order):
            # masks that hold at least ``step`` more documents
            seen = int(ends[done - 1]) if done else 0
            upto = min(int(np.searchsorted(ends, seen + step)) + 1, len(order))
            fresh = np.sort(docs[by_mask[seen:ends[upto - 1]]])
            got = self.scores(fresh, held)
            places, scores = np.concatenate([places, fresh[got > 0]]), np.concatenate([scores, got[got > 0]])
            kept = np.lexsort((self.ids[places], self.nameless[places], -scores))[:top]
            places, scores, done, step = places[kept], scores[kept], upto, step * 2
            if done < len(order) and len(places) == top and most[order[done]] < scores[-1]:
                break
        return places, scores


def rank(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """Each item's ``top`` documents by score: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``; equal scores by id."""
    terms, n_items = item_terms(items)
    blocks = index(docs, term_filter(terms))
    facts = blocks.filter("term IS NULL")
    n_docs, n_terms = facts.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(
        F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)), F.lit(0))).first()

    def search(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if table["term"].null_count < len(table):
            block = Block(table, n_docs, n_terms)
            for item in block.of:
                places, scores = block.best(item, top)
                out += [(item, None if block.nameless[p] else int(block.ids[p]), int(s)) for p, s in zip(places, scores)]
        columns = list(zip(*out)) or [[], [], []]
        return pa.table([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
                        names=["item", "doc_id", "score"])

    postings = blocks.drop("n_docs").join(weighted(terms, blocks, n_docs), "term")
    parts = F.explode(F.sequence(F.lit(0), F.lit(max(n_items - 1, 0) // GROUP)))
    every = postings.unionByName(facts.drop("n_docs").withColumn("part", parts), allowMissingColumns=True)
    found = every.groupBy("block", "part").applyInArrow(search, FOUND)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ids = terms.select("item", "item_id").distinct()
    return (found.withColumn("rank", place).filter(F.col("rank") <= top).join(ids, "item")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
