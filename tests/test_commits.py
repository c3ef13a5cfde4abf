"""Stores: the log, broken loads, writers side by side, the history of numbers, and merges."""

import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from inkledger.operators.store import project_tables, upsert_vendors
from inkledger.plans.dashboard import dashboard
from inkledger.streaming import ingest
from inkledger.streaming.commits import Part, commit_batch, commit_merge, create_once, read_state
from inkledger.streaming.dashboard import live_dashboard, status_totals, stored_vendors
from inkledger.streaming.ingest import (
    commit_attempt, compact, load_documents, read_accepted, read_outcomes, release, store_batch, unfinished, write_batch,
)
from inkledger.streaming.numbers import KEYS, held, narrowed, suspects, write_numbers
from tests.helpers import document, documents


def numbered(spark, numbers):
    return documents(spark, [document(invoice_number=n) for n in numbers])


def stored_numbers(spark, out):
    return sorted(r.invoice_number for r in read_accepted(spark, out).collect())


def through(spark, folder):
    def write(name, df):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    return write


# --- the log -------------------------------------------------------------------

def test_one_of_many_makes_the_file(spark, tmp_path):
    path, made = str(tmp_path / "log" / "1.json"), []
    threads = [threading.Thread(target=lambda i=i: made.append((create_once(spark, path, f"writer {i}"), i))) for i in range(16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [i for ok, i in made if ok]
    assert len(winners) == 1 and (tmp_path / "log" / "1.json").read_text() == f"writer {winners[0]}"
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["1.json"]


def test_the_state_follows_commits_and_merges(spark, tmp_path):
    out = str(tmp_path)
    assert read_state(spark, out).version == -1 and not read_state(spark, out).has("a", 0)
    for i in (0, 1, 3):
        state = read_state(spark, out)
        assert commit_batch(spark, out, state.version, "a", i, [Part("outcomes", f"f{i}", 5), Part("sums", f"s{i}", 1)])
        assert not commit_batch(spark, out, state.version, "b", 0, [])
    state = read_state(spark, out)
    assert state.folders("outcomes") == ["f0", "f1", "f3"] and [state.has("a", i) for i in range(5)] == [True, True, False, True, False]
    assert commit_merge(spark, out, state, ["f0", "f1"], Part("outcomes", "m", 10))
    merged = read_state(spark, out)
    assert sorted(merged.folders("outcomes")) == ["f3", "m"] and merged.folders("sums") == ["s0", "s1", "s3"] and merged.done == state.done
    assert not commit_merge(spark, out, state, ["f3"], Part("outcomes", "n", 10))
    # what lies before the newest merge is not read
    (tmp_path / "commits" / f"{0:020d}.json").write_text(json.dumps({"version": 0, "parts": "broken"}))
    assert read_state(spark, out) == merged


# --- loads that break off ---------------------------------------------------------

@pytest.mark.parametrize("step", ["write_numbers", "commit_batch"])
def test_a_load_that_breaks_off_can_be_called_again(spark, tmp_path, monkeypatch, step):
    out, docs = str(tmp_path), numbered(spark, [str(i) for i in range(10)])

    def fail(*args, **kwargs):
        raise RuntimeError("gone")

    monkeypatch.setattr(ingest, step, fail)
    with pytest.raises(RuntimeError):
        load_documents(docs, out, name="nightly")
    monkeypatch.undo()
    assert unfinished(spark, out, "nightly") and not unfinished(spark, out, "night")
    load_documents(docs, out, name="nightly")
    load_documents(docs, out, name="nightly")
    rows = read_outcomes(spark, out).collect()
    assert len(rows) == 10 and {r.outcome for r in rows} == {"persisted"}
    assert release(spark, out, "nightly") > 0 and unfinished(spark, out, "nightly") == []
    assert read_outcomes(spark, out).count() == 10
    # a load under another name finds them stored
    load_documents(docs, out)
    assert read_accepted(spark, out).count() == 10 and read_outcomes(spark, out).count() == 20


def test_what_is_not_committed_is_not_seen(spark, tmp_path):
    out = str(tmp_path)
    store_batch(numbered(spark, ["a", "b"]), 0, out)
    attempt = write_batch(numbered(spark, ["b", "c"]), 1, out)
    assert stored_numbers(spark, out) == ["a", "b"] and status_totals(spark, out).first()["invoice_count"] == 2
    commit_attempt(spark, attempt)
    assert stored_numbers(spark, out) == ["a", "b", "c"] and status_totals(spark, out).first()["invoice_count"] == 3


def test_the_same_batch_twice_at_once_is_stored_once(spark, tmp_path):
    out, docs = str(tmp_path), numbered(spark, ["a", "b"])
    first, second = write_batch(docs, 0, out), write_batch(docs, 0, out)
    assert commit_attempt(spark, first) == 0 and commit_attempt(spark, second) is None
    assert read_outcomes(spark, out).count() == 2 and write_batch(docs, 0, out) is None


def test_names_that_are_no_folder_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        load_documents(numbered(spark, ["a"]), str(tmp_path), name="a/b")


# --- two writers -------------------------------------------------------------------

def test_the_second_to_commit_gives_up_what_it_lost(spark, tmp_path):
    out = str(tmp_path)
    one = write_batch(numbered(spark, ["a", "b", "c"]), 0, out, source="one")
    two = write_batch(numbered(spark, ["b", "c", "d"]), 0, out, source="two")
    three = write_batch(numbered(spark, ["x", "y"]), 0, out, source="three")
    assert [commit_attempt(spark, a) for a in (one, two, three)] == [0, 1, 2]
    rows = {(r.source, r.invoice_number): r.outcome for r in read_outcomes(spark, out).collect()}
    assert {k for k, v in rows.items() if v == "persisted"} == {("one", "a"), ("one", "b"), ("one", "c"), ("two", "d"), ("three", "x"), ("three", "y")}
    assert len(rows) == 8 and status_totals(spark, out).first()["invoice_count"] == 6
    load_documents(numbered(spark, ["d", "x", "z"]), out)
    assert stored_numbers(spark, out) == ["a", "b", "c", "d", "x", "y", "z"]


def test_two_threads_on_one_store(spark, tmp_path):
    out, failed = str(tmp_path), []

    def writer(name, low):
        try:
            for batch in range(3):
                store_batch(numbered(spark, [str(low + 4 * batch + i) for i in range(6)]), batch, out, source=name)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=writer, args=a) for a in (("one", 0), ("two", 3))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    every = {str(i) for i in range(3 + 4 * 2 + 6)}
    got = stored_numbers(spark, out)
    assert len(got) == len(set(got)) and set(got) == every
    assert read_outcomes(spark, out).count() == 2 * 3 * 6 and read_state(spark, out).version == 5


# --- the history of numbers -----------------------------------------------------------

def scanned_rows(df):
    """Rows that came out of the file scans of an executed plan."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if "FileSourceScan" in name:
            total += node.metrics().get("numOutputRows").get().value()
        if "QueryStage" in name:
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_batch_reads_little_of_a_long_history(spark, tmp_path):
    n, asked = 1_000_000, 5_000
    folders = {}
    for i, (low, high) in enumerate([(0, 900_000), (900_000, n)]):
        numbers = spark.range(low, high).select(F.concat(F.lit("INV-"), "id").alias("invoice_number"))
        folders[str(tmp_path / f"part{i}")] = high - low
        write_numbers(numbers, high - low, str(tmp_path / f"part{i}"))
    draw = random.Random(8)
    known = [f"INV-{draw.randrange(n)}" for _ in range(50)]
    fresh = [f"NEW-{draw.random()}" for _ in range(asked - 50)]
    claims = spark.createDataFrame([(x,) for x in known + fresh], "invoice_number string")
    claims.write.parquet(str(tmp_path / "claims"))
    claims = spark.read.parquet(str(tmp_path / "claims"))
    passing = suspects(spark, folders, claims)
    names = {r.invoice_number for r in passing.collect()}
    assert set(known) <= names and len(names) < 50 + 30
    found = through(spark, str(tmp_path / "w"))("suspects", passing)
    keys = narrowed(spark, list(folders), found)
    around = keys.groupBy().count()
    around.collect()
    filters = spark.read.parquet(*[f"{f}/filters" for f in folders]).count()
    read = scanned_rows(around) + filters
    assert 0 < read < 0.05 * n
    got = held(spark, folders, claims, through(spark, str(tmp_path / "v")))
    assert sorted(r.invoice_number for r in got.collect()) == sorted(set(known))


def test_small_and_empty_histories(spark, tmp_path):
    claims = spark.createDataFrame([("a",), ("",), ("b",), ("b",)], "invoice_number string")
    assert held(spark, {}, claims, through(spark, str(tmp_path / "none"))).count() == 0
    for name, numbers in (("empty", []), ("blank", [("",), ("a",)])):
        write_numbers(spark.createDataFrame(numbers, "invoice_number string"), len(numbers), str(tmp_path / name))
    folders = {str(tmp_path / "empty"): 0, str(tmp_path / "blank"): 2}
    got = held(spark, folders, claims, through(spark, str(tmp_path / "some")))
    assert sorted(r.invoice_number for r in got.collect()) == ["", "a"]
    assert held(spark, {str(tmp_path / "empty"): 0}, claims, through(spark, str(tmp_path / "less"))).count() == 0
    assert spark.read.parquet(str(tmp_path / "blank" / "keys")).count() == 2 and KEYS


# --- merges ------------------------------------------------------------------------------

def shown(results):
    return {name: [tuple(map(str, r)) for r in df.collect()] for name, df in results.items()}


def test_merged_parts_tell_the_same(spark, tmp_path):
    out, draw = str(tmp_path), random.Random(6)
    texts = [document(invoice_number=str(draw.randrange(40)), company_name=f"V{draw.randrange(5)}", company_address=f"road {i}",
                      total_amount=str(draw.choice([10, 60000, "N/A"])), invoice_date=f"2025-{draw.randrange(1, 13):02d}-05") for i in range(60)]
    docs = documents(spark, texts)
    clock = F.timestamp_seconds(F.col("arrival"))
    for i in range(6):
        store_batch(docs.filter(F.col("arrival").between(10 * i, 10 * i + 9)), i, out, clock)
    rows = lambda: sorted((r.arrival, r.outcome, r.batch_id) for r in read_outcomes(spark, out).collect())
    before, results = rows(), shown(live_dashboard(spark, out))
    tables = project_tables(read_accepted(spark, out))
    assert results == shown(dashboard(tables))
    many = len(read_state(spark, out).parts)
    assert compact(spark, out, fan=2) > 0
    state = read_state(spark, out)
    assert len(state.parts) < many / 2 and rows() == before and shown(live_dashboard(spark, out)) == results
    whole = lambda df: sorted(map(str, df.collect()))
    assert whole(stored_vendors(spark, out)) == whole(upsert_vendors(read_accepted(spark, out)))
    # batches are still known, numbers still taken
    store_batch(docs.filter("arrival < 10"), 0, out, clock)
    assert rows() == before
    load_documents(docs, out, clock)
    assert read_accepted(spark, out).count() == sum(o == "persisted" for _, o, _ in before)


def test_the_live_dashboard_reads_no_outcomes(spark, tmp_path):
    out = str(tmp_path)
    store_batch(numbered(spark, ["a", "b"]), 0, out)
    for df in [*live_dashboard(spark, out).values(), stored_vendors(spark, out)]:
        files = df.inputFiles()
        assert files and not any("/outcomes/" in f for f in files)


def test_a_merge_that_was_overtaken_is_dropped(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    for i in range(2):
        store_batch(numbered(spark, [str(i)]), i, out)
    merge = ingest._merge_part
    inside = []

    def overtaken(*args):
        if not inside:
            inside.append(True)
            compact(spark, out, fan=2)
        return merge(*args)

    monkeypatch.setattr(ingest, "_merge_part", overtaken)
    compact(spark, out, fan=2)
    assert stored_numbers(spark, out) == ["0", "1"] and len(read_state(spark, out).folders("outcomes")) == 1
    assert status_totals(spark, out).first()["invoice_count"] == 2
