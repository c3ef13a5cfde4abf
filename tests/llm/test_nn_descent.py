"""Search results against brute force."""

import numpy as np
import pytest

from inkledger.llm import nn_descent
from inkledger.llm.nn_descent import nearest


def brute(ids, rows, k, every):
    out = {}
    for q, v in zip(ids, rows):
        if q % every == 0:
            scored = sorted(((-float(np.dot(v.astype(float), r.astype(float))), i) for i, r in zip(ids, rows) if i != q))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def table(spark, ids, rows):
    return spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in zip(ids, rows)], "vec_id bigint, embedding array<float>")


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("unit", [True, False])
def test_recall(spark, monkeypatch, unit):
    """With chunks far smaller than the table, so the graph and the walk do the work."""
    monkeypatch.setattr(nn_descent, "CHUNK", 128)
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((12, 24))
    rows = np.concatenate([centers[rng.integers(0, 12, 1500)] + 0.15 * rng.standard_normal((1500, 24)), rng.standard_normal((500, 24))])
    rows = (rows / np.linalg.norm(rows, axis=1)[:, None] if unit else rows).astype(np.float32)
    ids = rng.permutation(5000)[:2000]
    got, want = lists(nearest(table(spark, ids, rows), 20, 20)), brute(ids, rows, 20, 20)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.95, recall
    exact = {i: r.astype(float) for i, r in zip(ids, rows)}
    for q, found in got.items():
        assert all(abs(s - exact[q] @ exact[i]) < 1e-12 for i, s in found) and found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_copies_ties_and_useless_vectors(spark):
    one, two = [1.0, 0.0, 0.0], [0.6, 0.8, 0.0]
    rows = [(i, one) for i in range(100)] + [(i, two) for i in range(100, 130)] + [(200, [0.0] * 3), (220, None), (240, [1.0, None, 0.0]),
            (260, [float("nan"), 0.0, 0.0]), (280, [float("inf"), 0.0, 0.0]), (300, [1.0, 0.0]), (None, one), (0, one)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, raw string")
    got = lists(nearest(df, 20, 20))
    assert set(got) == {0, 20, 40, 60, 80, 100, 120}
    assert [i for i, _ in got[0]] == list(range(1, 21)) and [i for i, _ in got[20]] == [*range(0, 20)]
    assert [i for i, _ in got[60]] == list(range(20)) and all(abs(s - 1) < 1e-12 for _, s in got[60])
    assert [i for i, _ in got[100]] == list(range(101, 121)) and [i for i, _ in got[120]] == list(range(100, 120))


def test_few_rows_and_none(spark):
    got = lists(nearest(table(spark, [0, 7, 20], np.array([[1, 0], [0, 1], [-1, 0]])), 20, 20))
    assert got == {0: [(7, 0.0), (20, -1.0)], 20: [(7, 0.0), (0, -1.0)]}
    assert nearest(table(spark, [20], np.array([[1, 0]])), 20, 20).count() == 0
    assert nearest(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), 20, 20).count() == 0


def test_a_hub_is_shared_by_several_joins(spark, monkeypatch):
    """One long vector is everyone's neighbour; its members are dealt among joins, and results stay right."""
    monkeypatch.setattr(nn_descent, "MEMBERS", 40)
    rng = np.random.default_rng(9)
    rows = rng.standard_normal((600, 8)).astype(np.float32)
    rows[0] *= 1
    rows[1] = 30
    ids = np.arange(600)
    got, want = lists(nearest(table(spark, ids, rows), 10, 20)), brute(ids, rows, 10, 20)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_joins_and_walks_go_on_until_nothing_changes(spark, monkeypatch):
    """Lists and steps so short that three rounds and six steps are not enough."""
    for name, value in (("CHUNK", 16), ("ORDERS", 2), ("NEIGHBOURS", 8), ("TAKEN", 4), ("EXPANDED", 8)):
        monkeypatch.setattr(nn_descent, name, value)
    rows = nn_descent.usable(table(spark, range(1500), np.random.default_rng(4).standard_normal((1500, 6))))
    packed = nn_descent._packed(rows.withColumnRenamed("vec_id", "rep"))
    graph = nn_descent.build_graph(packed)
    lists_ = [r["fresh"] for r in graph.select("fresh").collect()]
    assert sum(map(sum, lists_)) <= nn_descent.STILL * sum(map(len, lists_))
    asked = packed.filter("rep % 50 = 0").selectExpr("rep AS query", "rep AS entry", "code AS query_code", "scale AS query_scale")
    assert not any(any(r["fresh"]) for r in nn_descent.greedy_search(graph, packed, asked).collect())


def test_a_round_deals_new_edges_alone(spark, monkeypatch):
    """Each edge is exploded and joined with vectors in the round it came in, not in all that follow."""
    for name, value in (("CHUNK", 16), ("ORDERS", 2), ("NEIGHBOURS", 8), ("TAKEN", 4)):
        monkeypatch.setattr(nn_descent, name, value)
    rounds, arrivals = [], nn_descent._arrivals

    def noted(graph, vectors, log, turn):
        out = arrivals(graph, vectors, log, turn)
        edges = [(r["rep"], i, f) for r in graph.collect() for i, f in zip(r["ids"], r["fresh"])]
        rounds.append((edges, nn_descent._new_edges(graph).count(), [(r["center"], m["member"]) for r in out.collect() for m in r["members"]]))
        return out

    monkeypatch.setattr(nn_descent, "_arrivals", noted)
    rows = nn_descent.usable(table(spark, range(900), np.random.default_rng(4).standard_normal((900, 6))))
    nn_descent.build_graph(nn_descent._packed(rows.withColumnRenamed("vec_id", "rep")))
    assert len(rounds) > 3 and all(f for _, _, f in rounds[0][0])
    met = set()
    for edges, exploded, members in rounds:
        new = {(a, b) for a, b, f in edges if f}
        assert exploded == len(new) and set(members) >= new | {(b, a) for a, b in new} and len(members) <= 2 * len(new)
        # who came earlier is still there: both ends of every edge have been brought together
        met |= set(members)
        assert all((a, b) in met and (b, a) in met for a, b, _ in edges)
    assert sum(x for _, x, _ in rounds) < sum(len(x) for x, _, _ in rounds) / 2


def test_new_members_meet_earlier_ones(spark):
    packed = nn_descent._packed(nn_descent.usable(table(spark, range(4), np.eye(4) + 0.1)).withColumnRenamed("vec_id", "rep"))
    first = spark.createDataFrame([(0, [1, 2], [0.2, 0.1], [True, True])], nn_descent._LISTS)
    # 2 was dropped, 3 is new, 1 lists 0 as well and so comes again by its own edge
    second = spark.createDataFrame([(0, [3, 1], [0.3, 0.2], [True, False]), (1, [0], [0.2], [True]), (2, [3], [0.1], [False]),
                                    (3, [2], [0.1], [False])], nn_descent._LISTS)
    vertices = spark.createDataFrame([(i, [], [], []) for i in range(1, 4)], nn_descent._LISTS)
    log = nn_descent._arrivals(first.unionByName(vertices), packed, None, 0)
    at_first = {r["rep"]: set(r["ids"]) for r in nn_descent._local_joins(log, 0, 2).collect()}
    assert at_first == {1: {2}, 2: {1}}
    log = log.unionByName(nn_descent._arrivals(second, packed, log, 1))
    then = {r["rep"]: set(r["ids"]) for r in nn_descent._local_joins(log, 1, 2).collect()}
    assert then == {1: {3}, 2: {3}, 3: {1, 2}}
