"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on full shingle sets.

A signature is 128 minima cut to a byte each.  Every tree is the same set of signatures sorted
after a rotation of its own; rows with a long common prefix lie next to each other.  A region
is the run of rows that agree on as few leading bytes as leave at most ``REGION`` rows, so
dense parts of the data are cut deeper than thin ones.  Candidates are the rows of a region and
the sorted neighbours of rows in dense parts.  In dense parts, where there would be very many,
only each row's best partner is a candidate at first; they are gone through a second time in far
larger regions, in which full sets are compared of rows that are not yet in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkledger.llm.common import components, staged, tasks_for
from inkledger.llm.words import as_bytes, minima, permutations, shared, shingle_run

HASHES = 128
TREES = 16
#: Least common prefix of a candidate, in bytes, and the most rows of a region.
DEPTH = 3
REGION = 64
WIDE_REGION = 1024
#: Sorted neighbours that rows of dense parts are compared with besides their region.
BESIDE = 2
#: Standard errors by which a signature's estimate may fall short of the threshold.
SLACK = 4.75
A, B = permutations(HASHES, 20240229)
#: Texts on either side of a block of pairs that are confirmed together.
BLOCK = 512
#: A partition's rows that may meet those of the next one in a region.
EDGE = REGION


def signature(shingles: np.ndarray) -> bytes:
    low = minima(shingles, A, B)
    return ((low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes()


def _sketches(words: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, highs, lows, signatures = [], [], [], []
            for text in as_bytes(batch.column("text")):
                shingles = np.unique(shingle_run(text, words))
                sizes.append(len(shingles))
                # two sums over different mixes name the set: 128 bits
                highs.append(int((shingles * (shingles >> np.uint64(32) | np.uint64(1))).sum().astype(np.int64)))
                lows.append(int((shingles ^ (shingles * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(17))).sum().astype(np.int64)))
                signatures.append(signature(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(highs, pa.int64()), pa.array(lows, pa.int64()),
                 pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "hi", "lo", "sig"])
    return sketch


def _regions(common: np.ndarray, depth: int, most: int) -> np.ndarray:
    """Region of each sorted row (-1: none) from the common prefix with the row before it."""
    region = np.full(len(common), -1)
    todo = np.arange(len(common))
    level, named = depth, 0
    while len(todo) and level <= HASHES:
        # runs of rows that share ``level`` bytes; rows already placed break runs only where runs end anyway
        run = np.cumsum(common[todo] < level)
        count = np.bincount(run)
        small = count[run] <= most
        region[todo[small]] = named + run[small]
        named += len(count)
        todo, level = todo[~small], level + 1
    if len(todo):  # equal signatures beyond ``most``: blocks, tied together by their neighbours
        region[todo] = named + np.arange(len(todo)) // most
    return region


def _common(tree: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Leading bytes that each sorted row shares with the one before it."""
    differs = keys[1:] != keys[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), HASHES)
    return np.append(0, np.where(tree[1:] == tree[:-1], common, 0))


def _pairs(tree: np.ndarray, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray, threshold: int,
           apart_by: np.ndarray | None = None):
    """Pairs (i, j) of sorted rows that may be similar enough, their estimates, and which rows lie in dense parts.

    With ``apart_by`` only pairs that differ there.
    """
    n = len(ids)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(n, bool)
    if n < 2:
        return none
    common = _common(tree, keys)
    region = _regions(common, DEPTH, REGION)
    run = np.cumsum(common < DEPTH)
    dense = np.bincount(run)[run] > REGION
    reach = np.bincount(region[region >= 0]).max(initial=1)
    t = threshold / 100
    least = t - SLACK * np.sqrt(t * (1 - t) / HASHES)
    found = []
    lowest = common.copy()
    for gap in range(1, min(n, max(reach, BESIDE + 1))):
        i = np.arange(gap, n)
        same = region[gap:] == region[:-gap]
        if gap <= BESIDE:
            # the least common prefix between the two is the least along the way
            lowest = common[gap:] if gap == 1 else np.minimum(lowest[1:], common[gap:])
            same |= lowest >= DEPTH
        if apart_by is not None:
            same &= apart_by[gap:] != apart_by[:-gap]
        i = i[same]
        j = i - gap
        apart = (ids[i] != ids[j]) & (100 * np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]))
        i, j = i[apart], j[apart]
        for at in range(0, len(i), 50_000):
            a, b = i[at:at + 50_000], j[at:at + 50_000]
            equal = (keys[a] == keys[b]).mean(axis=1)
            estimate = (equal - 1 / 256) / (1 - 1 / 256)
            near = estimate >= least
            found.append((a[near], b[near], estimate[near]))
    if not found:
        return *none[:3], dense
    return *(np.concatenate(x) for x in zip(*found)), dense


def _wide_look(tree: np.ndarray, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray, asked: np.ndarray,
               threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The best partner of each asked row among the rows of its wide region, by signatures, if any is similar enough."""
    if not len(asked):
        return
    region = _regions(_common(tree, keys), DEPTH, WIDE_REGION)
    starts = np.append(0, np.flatnonzero(region[1:] != region[:-1]) + 1)
    ends = np.append(starts[1:], len(region))
    t = threshold / 100
    least = (t - SLACK * np.sqrt(t * (1 - t) / HASHES)) * (1 - 1 / 256) + 1 / 256
    run = np.searchsorted(starts, asked, side="right") - 1
    for k in np.unique(run):
        rows, own = np.arange(starts[k], ends[k]), asked[run == k]
        if len(rows) < 2 or region[rows[0]] < 0:
            continue
        for at in range(0, len(own), 32):
            one = own[at:at + 32]
            equal = (keys[one][:, None, :] == keys[rows][None, :, :]).sum(axis=2, dtype=np.uint8).astype(np.int16)
            low, high = np.minimum(sizes[one][:, None], sizes[rows]), np.maximum(sizes[one][:, None], sizes[rows])
            equal[(ids[one][:, None] == ids[rows]) | (100 * low < threshold * high)] = -1
            best = equal.argmax(axis=1)
            good = equal[np.arange(len(one)), best] >= least * HASHES
            if good.any():
                yield one[good], rows[best[good]]


def _best_of(row: np.ndarray, partner: np.ndarray, estimate: np.ndarray) -> np.ndarray:
    """Which entries are their row's best, the first of equal ones."""
    best = np.zeros(len(row), bool)
    if len(row):
        order = np.lexsort((partner, -estimate, row))
        best[order[np.append(True, row[order][1:] != row[order][:-1])]] = True
    return best


_FOUND = "kind string, a bigint, b bigint, best boolean, border int, side int, tree int, key binary, n_shingles bigint"
_NAMES = ["kind", "a", "b", "best", "border", "side", "tree", "key", "n_shingles"]


def _found(a: np.ndarray, b: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(["pair"] * n, pa.string()), pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64()),
         pa.array(best, pa.bool_()), *[pa.nulls(n, kind) for kind in (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64())]],
        _NAMES)


def _passed_on(table: pa.Table, at: np.ndarray, kind: str, border: int | None = None, side: int | None = None) -> pa.RecordBatch:
    """Rows of a partition for a later search: ``border`` rows or the rows of ``dense`` parts."""
    cut = table.take(pa.array(at, pa.int64())).combine_chunks()
    n = cut.num_rows
    column = lambda name, kind: pa.concat_arrays(cut[name].chunks).cast(kind) if n else pa.array([], kind)
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * n, pa.string()), column("rep", pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()),
         pa.array([border] * n, pa.int32()), pa.array([side] * n, pa.int32()), column("tree", pa.int32()),
         column("key", pa.binary()), column("n_shingles", pa.int64())], _NAMES)


def _unpacked(batches: Iterator[pa.RecordBatch]):
    """A partition's rows as one table and its columns as arrays; None without rows."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return None
    table = pa.Table.from_batches(rows)
    keys = np.frombuffer(b"".join(table["key"].to_pylist()), np.uint8).reshape(-1, HASHES)
    return table, table["tree"].to_numpy().astype(np.int64), keys, table["rep"].to_numpy(), table["n_shingles"].to_numpy()


def _search(threshold: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One sorted partition: its pairs, its rows at either end, and its rows in dense parts."""
        from pyspark import TaskContext

        part, rows = TaskContext.get().partitionId(), _unpacked(batches)
        if rows is None:
            return
        table, tree, keys, rep, sizes = rows
        i, j, estimate, dense = _pairs(tree, keys, rep, sizes, threshold)
        best = _best_of(i, j, estimate)
        # rows of dense parts are paired with their best partner only: they are searched again
        keep = best | ~dense[i]
        yield _found(rep[i][keep], rep[j][keep], best[keep])
        near = np.zeros(len(rep), bool)
        near[i], near[j] = True, True
        # a row of a dense part that found nothing may have been cut away from its partner by the deeper prefix
        for lone, partner in _wide_look(tree, keys, rep, sizes, np.flatnonzero(dense & ~near), threshold):
            yield _found(rep[lone], rep[partner], np.ones(len(lone), bool))
        n, dense = table.num_rows, np.flatnonzero(dense & near)
        yield _passed_on(table, np.arange(min(EDGE, n)), "border", part, 1)
        yield _passed_on(table, np.arange(max(0, n - EDGE), n), "border", part + 1, 0)
        for at in range(0, len(dense), 50_000):
            yield _passed_on(table, dense[at:at + 50_000], "dense")
    return search


def _search_borders(threshold: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows on both sides of partition borders, sorted by border: the pairs that cross one."""
        rows = _unpacked(batches)
        if rows is None:
            return
        table, tree, keys, rep, sizes = rows
        # a border is told apart like a tree, and pairs of one side have been seen before
        place = table["border"].to_numpy().astype(np.int64) * TREES + tree
        i, j, estimate, _ = _pairs(place, keys, rep, sizes, threshold, table["side"].to_numpy())
        yield _found(rep[i], rep[j], _best_of(i, j, estimate))
    return search


_PAIR = "a bigint, b bigint"


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])


def _region_links(sets: list[np.ndarray], component: np.ndarray, threshold: int) -> Iterator[tuple[int, int]]:
    """Pairs of rows of one region, from different components, whose sets are similar enough.

    Rows of the component most rows are in are not compared with one another.  Every other row
    looks its shingles up in those of all, which counts the intersections with all at once.
    """
    names, place, counts = np.unique(component, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return
    sizes = np.array([len(x) for x in sets])
    members, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(members, kind="stable")
    members, owner = members[order], owner[order]
    for row in np.flatnonzero(place != counts.argmax()):
        low, high = np.searchsorted(members, sets[row], "left"), np.searchsorted(members, sets[row], "right")
        spans = high - low
        at = np.repeat(low - np.append(0, np.cumsum(spans)[:-1]), spans) + np.arange(spans.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        similar = (100 * both >= threshold * (sizes[row] + sizes - both)) & (place != place[row])
        # one link to each other component says all
        found = np.flatnonzero(similar)
        for k in np.unique(place[found], return_index=True)[1]:
            yield row, int(found[k])


def _search_dense(threshold: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of dense parts with components and full sets: the links between components, by wide regions."""
        rows = _unpacked(batches)
        if rows is None:
            return
        table, tree, keys, rep, _ = rows
        component, packed = table["component"].to_numpy(), table["shingles"]
        region = _regions(_common(tree, keys), DEPTH, WIDE_REGION)
        for at in np.split(np.arange(len(rep)), np.flatnonzero(region[1:] != region[:-1]) + 1):
            if len(np.unique(component[at])) < 2:
                continue
            sets = [np.frombuffer(packed[int(k)].as_py(), np.uint64) for k in at]
            links = np.array(list(_region_links(sets, component[at], threshold)), np.int64).reshape(-1, 2)
            yield _pair_batch(rep[at][links[:, 0]], rep[at][links[:, 1]])
    return search


def _packed_sets(words: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_run(text, words)) for text in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.array(map(len, sets), pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
                ["rep", "n_shingles", "shingles"])
    return pack


def _sorted_trees(rows: DataFrame, tasks: int) -> DataFrame:
    order = ["tree", "key", "rep"]
    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def _candidates(reps: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Distinct candidate pairs ``(a, b, best)`` of ``reps`` (rep, n_shingles, sig), and the tree rows of dense parts; staged."""
    step = HASHES // TREES
    rotated = F.expr(f"concat(substring(sig, tree * {step} + 1, {HASHES}), substring(sig, 1, tree * {step}))")
    trees = (reps.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in range(TREES)])))
             .select("tree", rotated.alias("key"), "rep", "n_shingles"))
    tasks = tasks_for(reps.sparkSession, reps.count() * TREES, 100_000)
    found = staged(_sorted_trees(trees, tasks).mapInArrow(_search(threshold), _FOUND), "dedup-found")
    borders = (found.filter("kind = 'border'").select("border", "side", "tree", "key", F.col("a").alias("rep"), "n_shingles")
               .repartition("border").sortWithinPartitions("border", "tree", "key", "rep", "side")
               .mapInArrow(_search_borders(threshold), _FOUND))
    pairs = found.filter("kind = 'pair'").select("a", "b", "best").unionAll(borders.select("a", "b", "best"))
    dense = found.filter("kind = 'dense'").select("tree", "key", F.col("a").alias("rep"), "n_shingles")
    return staged(pairs.groupBy("a", "b").agg(F.max("best").alias("best")), "dedup-pairs"), dense


def _dense_links(dense: DataFrame, found: DataFrame, named: DataFrame, words: int, threshold: int) -> DataFrame:
    """Links between rows of dense parts that lie in different components of ``found``, staged."""
    # written first, so that their size is known before the texts are read: few ids are sent to the texts
    ids = staged(dense.select("rep").distinct(), "dedup-dense-ids")
    sets = (named.withColumnRenamed("doc_id", "rep").join(ids, "rep", "left_semi")
            .mapInArrow(_packed_sets(words), "rep bigint, n_shingles bigint, shingles binary")
            .dropDuplicates(["rep", "n_shingles"]))
    told = (dense.join(found.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep")).join(sets, ["rep", "n_shingles"]))
    # tasks of several whole regions each: more tasks would cut regions
    tasks = -(-dense.count() // (8 * WIDE_REGION)) or 1
    return staged(_sorted_trees(told, tasks).mapInArrow(_search_dense(threshold), _PAIR).distinct(), "dedup-dense")


def _confirm(words: int, threshold: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks in a row: first each block's texts (a, text), then its pairs (a, b)."""
        block, sets = None, {}
        for batch in batches:
            kept_a, kept_b = [], []
            for at, a, b, text in zip(*(batch.column(c).to_pylist() for c in ("block", "a", "b")), batch.column("text").cast(pa.large_binary())):
                if at != block:
                    block, sets = at, {}
                if b is None:
                    # an id with several texts stands for all their sets
                    sets.setdefault(a, []).append(np.unique(shingle_run(text.as_py(), words)))
                    continue
                for one in sets.get(a, []):
                    if any(_similar(one, two, threshold) for two in sets.get(b, [])):
                        kept_a.append(a)
                        kept_b.append(b)
                        break
            yield _pair_batch(np.array(kept_a, np.int64), np.array(kept_b, np.int64))
    return confirm


def _similar(one: np.ndarray, two: np.ndarray, threshold: int) -> bool:
    both = shared(one, two)
    return both > 0 and 100 * both >= threshold * (len(one) + len(two) - both)


def _confirmed(pairs: DataFrame, named: DataFrame, words: int, threshold: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough, staged.

    Pairs are dealt to blocks by the hashes of both ends, about ``BLOCK`` texts a side, and a
    text goes once to each block that needs it: many pairs among few texts move those few.
    """
    pairs = staged(pairs.select("a", "b"), "dedup-confirm")
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "dedup-ids")
    groups = -(-ids.count() // BLOCK) or 1
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups).cast("bigint"))
    low, high = F.least(group("a"), group("b")), F.greatest(group("a"), group("b"))
    placed = pairs.select((low * groups + high).alias("block"), "a", "b")
    texts = named.withColumnRenamed("doc_id", "rep").join(ids, "rep", "left_semi").filter(F.col("text").isNotNull())
    needed = placed.select("block", F.explode(F.array("a", "b")).alias("rep")).distinct()
    sent = needed.join(texts, "rep").select("block", F.col("rep").alias("a"), F.lit(None).cast("bigint").alias("b"), "text")
    asked = placed.select("block", "a", "b", F.lit(None).cast("string").alias("text"))
    return staged(sent.unionByName(asked).repartition("block").sortWithinPartitions("block", F.asc_nulls_first("b"))
                  .mapInArrow(_confirm(words, threshold), _PAIR), "dedup-links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                    threshold: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``.

    Documents whose sets of distinct ``words``-word shingles have 100 * intersection >=
    ``threshold`` * union are linked; a component is named by its smallest id and kept there.

    Rows with equal sets are one class from the start, named by its smallest id, so copies cost
    one row each.  Every class enters the forest.  Each row's best partner in each tree is
    confirmed first, then rows of dense parts that are not yet in one component are compared;
    of the other candidates only pairs between different components of what is linked so far can
    change anything, and all of those are confirmed last.

    Null and empty texts have no shingles, link with nothing and are kept.  Rows without an id
    are counted but link with nothing and are kept, with a null component.  Rows that share an id
    count as one document.  Texts shorter than ``words`` words are one shingle.
    """
    named = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sketches = staged(named.mapInArrow(_sketches(words), "doc_id bigint, n_shingles bigint, hi bigint, lo bigint, sig binary"),
                      "dedup-sketches")
    able = sketches.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = staged(able.groupBy("n_shingles", "hi", "lo").agg(F.min("doc_id").alias("rep")), "dedup-classes")
    # one row a class: of equal rows any signature, they agree
    reps = staged(able.join(classes.withColumnRenamed("rep", "_rep"), ["n_shingles", "hi", "lo"])
                  .filter("doc_id = _rep").select(F.col("doc_id").alias("rep"), "n_shingles", "hi", "lo", "sig")
                  .dropDuplicates(["rep", "n_shingles", "hi", "lo"]).drop("hi", "lo"), "dedup-reps")
    pairs, dense = _candidates(reps, threshold)
    links = _confirmed(pairs.filter("best"), named, words, threshold)
    # rows that share an id tie their classes together
    twice = (able.join(classes.withColumnRenamed("rep", "_rep"), ["n_shingles", "hi", "lo"]).filter("doc_id != _rep")
             .select(F.col("doc_id").alias("a"), F.col("_rep").alias("b"))
             .join(reps.select(F.col("rep").alias("a")), "a", "left_semi"))
    found = components(links.unionAll(twice), "a", "b", "dedup-components")

    def joined_by(more: DataFrame) -> DataFrame:
        return components(found.toDF("a", "b").unionAll(more), "a", "b", "dedup-components")

    found = joined_by(_dense_links(dense, found, named, words, threshold))
    of = lambda side: found.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
    rest = (pairs.filter("NOT best").join(of("a"), "a", "left").join(of("b"), "b", "left")
            .filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")))
    more = _confirmed(rest, named, words, threshold)
    if not more.isEmpty():
        found = joined_by(more)
    joined = (sketches.join(classes, ["n_shingles", "hi", "lo"], "left")
              .join(found.withColumnRenamed("node", "rep"), "rep", "left"))
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"),
                         F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, threshold: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the rows ``near_duplicates`` keeps, and of rows equal in id and text one."""
    found = staged(near_duplicates(docs, key, text, words, threshold), "dedup-result")
    named = found.filter("doc_id IS NOT NULL")
    gone = named.filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    # an id on several rows is rare: only those rows are looked at again
    twice = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col("doc_id").alias("_gone"))
    id_ = F.col(key).cast("bigint")
    plain = docs.join(gone.unionAll(twice).distinct(), id_ == F.col("_gone"), "left_anti")
    if twice.isEmpty():
        return plain
    again = docs.join(twice.join(gone, "_gone", "left_anti"), id_ == F.col("_gone"), "left_semi")
    return plain.unionAll(again.dropDuplicates([key]))
