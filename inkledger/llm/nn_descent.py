"""Nearest neighbours by inner product: an NN-descent graph and greedy search along it.

Vectors get one more coordinate that makes all of one length, so that near in the graph means a
large inner product.  The graph starts from neighbours in a few sorted orders of random
hyperplane codes and is improved by local joins: the neighbours and reverse neighbours of a
vector meet, and each keeps the nearest it meets.  A query has 0 as its added coordinate, so its
walk goes by the inner product itself.  What is shuffled is a byte a coordinate, on a scale of
the vector's own; results are scored again on the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkledger.llm.common import staged, tasks_for

#: Neighbours a vector keeps in the graph.
NEIGHBOURS = 40
#: Sorted orders the graph starts from, bits of their codes, and rows that are compared in one.
ORDERS, BITS, CHUNK = 6, 24, 2048
#: Local joins end when no more than this share of neighbours changes; the rounds are a guard far above that.
STILL, ROUNDS = 0.01, 50
#: Members of a local join; a vector with more reverse neighbours has several.
MEMBERS = 96
#: Best partners a member takes away from one local join.
TAKEN = 8
#: A search's list of nearest found and how many of them are expanded in a step; the steps are a guard, a
#: search ends when its whole list is expanded.
BEAM, EXPANDED, STEPS = 160, 40, 100

_PACKED = "rep bigint, code binary, scale float, rest float"


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """The rows of a binary column of equal lengths as a matrix."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1) if rows else np.zeros((0, 1), kind)


def _decoded(codes: pa.Array, scales: pa.Array, rests: pa.Array | None = None) -> np.ndarray:
    """The vectors, with their added coordinate where ``rests`` has it."""
    given = _matrix(codes, np.int8).astype(np.float32) * np.asarray(scales, np.float32)[:, None]
    return given if rests is None else np.column_stack([given, np.asarray(rests, np.float32)])


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    rows = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(rows).combine_chunks() if rows else None


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, raw)``: rows with an id and a finite, non-zero vector, as bytes of doubles.

    Vectors of another length than most have cannot be compared and take no part either.
    """
    values = F.col(vector).cast("array<double>")
    good = (vectors.select(F.col(key).cast("bigint").alias("vec_id"), values.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                    & F.exists("v", lambda x: x != 0)))
    lengths = good.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), "n").limit(1).collect()
    good = good.filter(F.size("v") == (common[0]["n"] if common else 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            rows = flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in rows], pa.binary())],
                                             ["vec_id", "raw"])

    return staged(good.mapInArrow(pack, "vec_id bigint, raw binary"), "ann-rows")


def _packed(classes: DataFrame) -> DataFrame:
    """``(rep, code, scale, rest)``: each distinct vector, a byte a coordinate, and its added coordinate."""
    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("raw"), np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.linalg.norm(rows, axis=1), pa.float64())], ["norm"])

    longest = classes.select("raw").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0] or 1.0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("raw"), np.float64) / longest
            rest = np.sqrt(np.maximum(0, 1 - (rows * rows).sum(axis=1)))
            scale = np.maximum(np.abs(rows).max(axis=1, initial=0), 1e-30) / 127
            codes = np.rint(rows / scale[:, None]).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale, pa.float32()),
                 pa.array(rest, pa.float32())], ["rep", "code", "scale", "rest"])

    return staged(classes.select("rep", "raw").mapInArrow(pack, _PACKED), "ann-vectors")


_LISTS = "rep bigint, ids array<bigint>, sims array<float>, fresh array<boolean>"


def _lists(rep: np.ndarray, ids: np.ndarray, sims: np.ndarray, fresh: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(starts, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(rep, pa.int64()), *[pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in (
            (ids, pa.int64()), (sims, pa.float32()), (fresh, pa.bool_()))]], ["rep", "ids", "sims", "fresh"])


def _best(owner: np.ndarray, ids: np.ndarray, sims: np.ndarray, fresh: np.ndarray, most: int) -> pa.RecordBatch:
    """Each owner's ``most`` nearest distinct ids; what was known before is not fresh again."""
    order = np.lexsort((fresh, ids, owner))
    owner, ids, sims, fresh = owner[order], ids[order], sims[order], fresh[order]
    first = np.append(True, (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])) if len(owner) else np.zeros(0, bool)
    owner, ids, sims, fresh = owner[first], ids[first], sims[first], fresh[first]
    order = np.lexsort((ids, -sims, owner))
    owner, ids, sims, fresh = owner[order], ids[order], sims[order], fresh[order]
    heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, int)
    rank = np.arange(len(owner)) - np.repeat(heads, np.diff(np.append(heads, len(owner))))
    keep = rank < most
    owner, ids, sims, fresh = owner[keep], ids[keep], sims[keep], fresh[keep]
    heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, int)
    return _lists(owner[heads], ids, sims, fresh, np.append(heads, len(owner)))


def _merged(rows: DataFrame, most: int, tasks: int, column: str = "rep") -> DataFrame:
    """Rows of lists put together by ``rep``: each one's ``most`` nearest."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        lists = [_one(table[c]) for c in ("ids", "sims", "fresh")]
        lengths = np.diff(lists[0].offsets.to_numpy())
        owner = np.repeat(table["rep"].to_numpy(), lengths)
        yield _best(owner, *[x.flatten().to_numpy(zero_copy_only=False) for x in lists], most)

    return rows.repartition(tasks, column).mapInArrow(merge, _LISTS)


def _top_in(similar: np.ndarray, most: int) -> np.ndarray:
    """Column numbers of each row's largest values."""
    if similar.shape[-1] <= most:
        return np.broadcast_to(np.arange(similar.shape[-1]), similar.shape)
    return np.argpartition(-similar, most - 1, axis=-1)[..., :most]


def _start(vectors: DataFrame, rows: int) -> DataFrame:
    """First neighbours: in each sorted order, the nearest among ``CHUNK`` rows in a row."""
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # by the given coordinates alone, which tell rows apart whatever the longest vector is
            full = _decoded(batch.column("code"), batch.column("scale"))
            rng = np.random.default_rng(11)
            for turn in range(ORDERS):
                planes = rng.standard_normal((full.shape[1], BITS)).astype(np.float32)
                place = ((full @ planes) > 0) @ (1 << np.arange(BITS - 1, -1, -1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(full), turn), pa.int32()), pa.array(place, pa.int64()), *batch.columns],
                    ["turn", "place", "rep", "code", "scale", "rest"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        full, rep = _decoded(*(_one(table[c]) for c in ("code", "scale", "rest"))), table["rep"].to_numpy()
        turn = table["turn"].to_numpy()
        for order in np.unique(turn):
            rows_of = np.flatnonzero(turn == order)
            pieces = max(1, round(len(rows_of) / CHUNK))
            for at in np.array_split(rows_of, pieces):
                if len(at) < 2:
                    continue
                similar = full[at] @ full[at].T
                np.fill_diagonal(similar, -np.inf)
                best = _top_in(similar, NEIGHBOURS)
                best = best[:, :len(at)]
                sims = np.take_along_axis(similar, best, axis=1)
                ids = rep[at][best]
                good = np.isfinite(sims)
                counts = good.sum(axis=1)
                yield _lists(rep[at], ids[good], sims[good], np.ones(int(counts.sum()), bool), np.append(0, np.cumsum(counts)))

    tasks = tasks_for(vectors.sparkSession, rows * ORDERS, 4 * CHUNK)
    # few large tasks when rows are few: a chunk needs its rows together
    tasks = max(1, min(tasks, rows * ORDERS // CHUNK))
    keys = ["turn", "place", "rep"]
    placed = vectors.mapInArrow(codes, "turn int, place bigint, " + _PACKED)
    return placed.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).mapInArrow(near, _LISTS)


def _new_edges(graph: DataFrame) -> DataFrame:
    """``(rep, id)``: the edges that came in with the last round, all of them at the start."""
    fresh = F.filter(F.arrays_zip("ids", "fresh"), lambda e: e["fresh"])
    return graph.select("rep", F.explode(fresh).alias("e")).select("rep", F.col("e.ids").alias("id"))


def _arrivals(graph: DataFrame, vectors: DataFrame, log: DataFrame | None, turn: int) -> DataFrame:
    """``(center, salt, turn, backs, members)``: who is new at each vector in this round, with the vectors.

    A new edge brings either end to the other.  It is dealt and joined with vectors in this round alone: who came
    earlier is in the ``log``, the arrivals of the rounds before, and stays there when its edge is dropped.
    """
    edges = _new_edges(graph)
    back = edges.select(F.col("id").alias("center"), F.col("rep").alias("member"))
    # a vector that is a neighbour of very many has several joins, its members dealt among them
    counts = back.groupBy("center").agg(F.count(F.lit(1)).alias("n"))
    if log is not None:
        counts = (counts.unionByName(log.select("center", F.col("backs").alias("n")))
                  .groupBy("center").agg(F.sum("n").alias("n")))
    crowded = counts.filter(F.col("n") > MEMBERS)
    back = (back.join(crowded, "center", "left")
            .withColumn("salt", F.pmod(F.xxhash64("member"), F.coalesce(F.ceil(F.col("n") / MEMBERS), F.lit(1))))
            .withColumn("back", F.lit(1)).drop("n"))
    ahead = edges.select(F.col("rep").alias("center"), F.col("id").alias("member"), F.lit(0).cast("bigint").alias("salt"),
                         F.lit(0).alias("back"))
    members = back.unionByName(ahead).groupBy("center", "salt", "member").agg(F.max("back").alias("back"))
    least = graph.select("rep", F.when(F.size("sims") >= NEIGHBOURS, F.array_min("sims")).alias("least"))
    known = vectors.join(least, "rep").withColumnRenamed("rep", "member")
    return (members.join(known, "member").groupBy("center", "salt")
            .agg(F.sum("back").alias("backs"), F.collect_list(F.struct("member", "code", "scale", "rest", "least")).alias("members"))
            .select("center", "salt", F.lit(turn).alias("turn"), "backs", "members"))


def _local_joins(log: DataFrame, turn: int, tasks: int) -> DataFrame:
    """Lists of the nearest that members of each vector's neighbourhood find among one another, one of the two new in ``turn``."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        lists = _one(table["members"])
        lengths = np.diff(lists.offsets.to_numpy())
        center, salt = table["center"].to_numpy(), table["salt"].to_numpy()
        hood = np.cumsum(np.append(0, (center[1:] != center[:-1]) | (salt[1:] != salt[:-1])))
        came = np.repeat(table["turn"].to_numpy(), lengths)
        hood = np.repeat(hood, lengths)
        ids, codes, scales, rests, least = lists.flatten().flatten()
        ids, full = ids.to_numpy(), _decoded(codes, scales, rests)
        # what a list must beat never falls: the latest value here is the highest
        low = np.nan_to_num(np.asarray(least.fill_null(-2.0), np.float32), nan=-2.0)
        names, place = np.unique(ids, return_inverse=True)
        highest = np.full(len(names), -2.0, np.float32)
        np.maximum.at(highest, place, low)
        low = highest[place]
        # a neighbour that comes again by the other end was there before
        order = np.lexsort((came, ids, hood))
        order = order[np.append(True, (hood[order][1:] != hood[order][:-1]) | (ids[order][1:] != ids[order][:-1]))]
        hood, ids, full, low, fresh = hood[order], ids[order], full[order], low[order], came[order] == turn
        heads = np.flatnonzero(np.append(True, hood[1:] != hood[:-1]))
        sizes = np.diff(np.append(heads, len(hood)))
        active = np.logical_or.reduceat(fresh, heads)
        order = np.argsort(sizes, kind="stable")
        order = order[active[order]]
        for at in range(0, len(order), 256):
            group = order[at:at + 256]
            group = group[sizes[group] > 1]
            if not len(group):
                continue
            width = int(sizes[group].max())
            slot = np.arange(width)
            real = slot[None, :] < sizes[group][:, None]
            place = np.where(real, heads[group][:, None] + slot[None, :], heads[group][:, None])
            block = full[place]
            similar = block @ block.transpose(0, 2, 1)
            new = fresh[place]
            bad = ~(real[:, :, None] & real[:, None, :]) | ~(new[:, :, None] | new[:, None, :])
            bad |= similar <= low[place][:, :, None]
            bad[:, slot, slot] = True
            similar[bad] = -np.inf
            best = _top_in(similar, TAKEN)
            sims = np.take_along_axis(similar, best, axis=2)
            found = ids[np.take_along_axis(np.broadcast_to(place[:, None, :], similar.shape), best, axis=2)]
            good = np.isfinite(sims).reshape(-1, sims.shape[2])
            counts = good.sum(axis=1)
            some = counts > 0
            if some.any():
                yield _lists(ids[place].reshape(-1)[some], found.reshape(good.shape)[good], sims.reshape(good.shape)[good],
                             np.ones(int(counts.sum()), bool), np.append(0, np.cumsum(counts[some])))

    return (log.select("center", "salt", "turn", "members").repartition(tasks, "center", "salt")
            .sortWithinPartitions("center", "salt").mapInArrow(meet, _LISTS))


def build_graph(vectors: DataFrame) -> DataFrame:
    """``(rep, ids, sims, fresh)``: each vector's nearest found, nearest first, staged."""
    rows = vectors.count()
    tasks = tasks_for(vectors.sparkSession, rows, 5_000)
    graph = staged(_merged(_start(vectors, rows), NEIGHBOURS, tasks), "ann-start")
    log = None
    for turn in range(ROUNDS):
        arrivals = staged(_arrivals(graph, vectors, log, turn), f"ann-members{turn}")
        log = arrivals if log is None else log.unionByName(arrivals)
        found = _local_joins(log, turn, tasks)
        used = graph.withColumn("fresh", F.transform("fresh", lambda _: F.lit(False)))
        graph = staged(_merged(used.unionByName(found), NEIGHBOURS, tasks), f"ann-graph{turn}")
        changed = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x))).alias("new"), F.sum(F.size("ids")).alias("all")).first()
        if (changed["new"] or 0) <= STILL * (changed["all"] or 0):
            break
    return graph


def _measured(pairs: DataFrame) -> DataFrame:
    """Rows (query, id, query_code, query_scale, code, scale) as single-entry lists by query."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left = _decoded(batch.column("query_code"), batch.column("query_scale"))
                right = _decoded(batch.column("code"), batch.column("scale"))
                sims = np.einsum("ij,ij->i", left, right)
                yield _lists(batch.column("query").to_numpy(), batch.column("id").to_numpy(), sims,
                             np.ones(len(sims), bool), np.arange(len(sims) + 1))
    return pairs.select("query", "id", "query_code", "query_scale", "code", "scale").mapInArrow(measure, _LISTS)


def greedy_search(graph: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """``(rep, ids, sims, fresh)`` by query: the best found walking the graph from each query's entry.

    ``queries``: (query, entry, query_code, query_scale).  A step expands the nearest not yet
    expanded of each query's list; a query is done when its whole list is expanded.
    """
    tasks = tasks_for(vectors.sparkSession, queries.count(), 5_000)
    asked = queries.select("query", "query_code", "query_scale")
    targets = vectors.select(F.col("rep").alias("id"), "code", "scale")
    first = queries.select("query", F.col("entry").alias("id")).join(targets, "id").join(asked, "query")
    beams = staged(_merged(_measured(first), BEAM, tasks), "ann-beams")
    for step in range(STEPS):
        waiting = F.slice(F.filter(F.arrays_zip("ids", "fresh"), lambda e: e["fresh"]), 1, EXPANDED)
        frontier = beams.select(F.col("rep").alias("query"), F.explode(waiting).alias("e")).select("query", F.col("e.ids").alias("id"))
        if frontier.isEmpty():
            break
        reached = (frontier.join(graph.select(F.col("rep").alias("id"), F.col("ids").alias("next")), "id")
                   .select("query", F.explode("next").alias("id")).distinct())
        seen = beams.select(F.col("rep").alias("query"), F.explode("ids").alias("id"))
        new = reached.join(seen, ["query", "id"], "left_anti")
        found = _measured(new.join(targets, "id").join(asked, "query"))
        # the list stays sorted: its first fresh ones are those just expanded
        expanded = F.transform(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.get("fresh", i) & (
            F.size(F.filter(F.slice("fresh", 1, i + 1), lambda x: x)) > EXPANDED))
        beams = staged(_merged(beams.withColumn("fresh", expanded).unionByName(found), BEAM, tasks), f"ann-step{step}")
    return beams


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row whose id is divisible by ``every``.

    Nearness is the inner product of the original vectors in double precision; a row is no
    candidate for itself; ties go to smaller ids.  Fewer than ``k`` other rows: all of them.

    Equal vectors are one vertex of the graph, named by their smallest id, so copies neither crowd
    its lists nor meet in pairs; a result row stands for the ``k + 1`` smallest ids of its
    vector, which are all that can be asked for.  Rows that repeat an id count once.
    """
    rows = usable(vectors, key, vector)
    rows = rows.dropDuplicates(["vec_id"])
    classes = staged(rows.groupBy("raw").agg(F.min("vec_id").alias("rep")), "ann-classes")
    packed = _packed(classes)
    graph = build_graph(packed)
    named = staged(rows.join(classes, "raw"), "ann-named")
    wanted = named.filter(F.col("vec_id") % every == 0)
    entries = wanted.select("rep").distinct()
    asked = entries.join(packed, "rep").select(
        F.col("rep").alias("query"), F.col("rep").alias("entry"), F.col("code").alias("query_code"), F.col("scale").alias("query_scale"))
    beams = greedy_search(graph, packed, asked)
    # the distinct vectors found, and the query's own for its copies
    found = beams.select(F.col("rep").alias("query"), F.explode("ids").alias("rep"))
    scored = _scored(found.join(classes, "rep").withColumnRenamed("raw", "right")
                     .join(classes.select(F.col("rep").alias("query"), F.col("raw").alias("left")), "query"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    scored = scored.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1).drop("_r")
    few = Window.partitionBy("rep").orderBy("vec_id")
    members = named.select("rep", "vec_id").withColumn("_r", F.row_number().over(few)).filter(F.col("_r") <= k + 1).drop("_r")
    rows_found = scored.join(members, "rep")
    # k + 1 rows serve every query of one vector: each leaves itself out
    top = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    rows_found = rows_found.withColumn("_r", F.row_number().over(top)).filter(F.col("_r") <= k + 1).drop("_r", "rep")
    result = (wanted.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query")).join(rows_found, "query")
              .filter("query_id != vec_id"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (result.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _scored(pairs: DataFrame) -> DataFrame:
    """(query, rep, score) from the original vectors."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = _matrix(batch.column("left"), np.float64), _matrix(batch.column("right"), np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query"), batch.column("rep"), pa.array(np.einsum("ij,ij->i", left, right), pa.float64())],
                    ["query", "rep", "score"])
    return pairs.select("query", "rep", "left", "right").mapInArrow(score, "query bigint, rep bigint, score double")
