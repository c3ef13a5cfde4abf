import time

import pytest
from pyspark.sql import functions as F

from inkledger.operators.decide import mark_duplicates, process_documents
from inkledger.operators.extract import extract_flatten
from inkledger.operators.store import project_tables
from inkledger.sources.extractions import hidden_results, list_files, read_extractions, skipped_files, stream_extractions
from inkledger.streaming.approvals import ACTION_LOG, read_actions, start_approvals
from inkledger.streaming.dashboard import read_dashboard, start_dashboard, status_totals
from inkledger.streaming.ingest import (
    compact, load_documents, prepare, read_accepted, read_outcomes, start_ingest, store_batch, writer_of,
)
from tests.helpers import document, documents


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def deliver(folder, job, text):
    path = folder / job / "0" / "custom_output" / "0"
    path.mkdir(parents=True)
    (path / "result.json").write_text(text)


def test_files_are_ingested_once_first_arrival_wins(spark, tmp_path):
    arriving, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")

    def ingest():
        stream = stream_extractions(spark, str(arriving), "b", max_files=1)
        run(start_ingest(stream, out, checkpoint))

    deliver(arriving, "j1", document(company_name="First"))
    ingest()
    for job, text in [("j2", document(company_name="Late")), ("j3", document(invoice_number="B")),
                      ("j4", document(total_amount="N/A", invoice_number="C")), ("j5", "broken"),
                      ("j6", document(invoice_number="C", total_amount=60000))]:
        time.sleep(0.05)
        deliver(arriving, job, text)
    other = arriving / "j7" / "0" / "standard_output"
    other.mkdir(parents=True)
    (other / "result.json").write_text(document(invoice_number="Z"))
    ingest()
    ingest()
    rows = {r.s3_key.split("/")[1]: r for r in read_outcomes(spark, out).collect()}
    assert set(rows) == {"j1", "j2", "j3", "j4", "j5", "j6"}
    assert {k for k, r in rows.items() if r.outcome == "persisted"} == {"j1", "j3", "j6"}
    assert rows["j2"].error == "duplicate invoice_number" and rows["j5"].error == "document shape"
    assert rows["j6"].status == "pending_review"
    tables = project_tables(read_accepted(spark, out))
    assert {r.vendor_name for r in tables["vendors"].collect()} == {"First", "Acme"}
    assert read_extractions(spark, str(arriving), "b").count() == 7

    run(start_dashboard(spark, out, str(tmp_path / "dash"), str(tmp_path / "dash_ckpt")))
    assert {(r.status, r.invoice_count) for r in read_dashboard(spark, str(tmp_path / "dash")).collect()} == {
        ("approved", 2), ("pending_review", 1)}


def test_any_split_gives_the_batch_result_and_replay_changes_nothing(spark, tmp_path):
    texts = [document(invoice_number=str(i % 7), total_amount="N/A" if i % 5 == 0 else str(100 + i)) for i in range(24)]
    docs = documents(spark, texts)
    whole = mark_duplicates(process_documents(extract_flatten(docs)))
    expected = {(r.arrival, r.error) for r in whole.collect()}
    for name, bounds in [("a", [0, 24]), ("b", [0, 3, 11, 12, 24])]:
        out = str(tmp_path / name)
        prepare(spark, out)
        parts = list(zip(bounds, bounds[1:]))
        for batch, (low, high) in enumerate(parts):
            store_batch(docs.filter(F.col("arrival").between(low, high - 1)), batch, out)
        assert {(r.arrival, r.error) for r in read_outcomes(spark, out).collect()} == expected
        low, high = parts[-1]
        store_batch(docs.filter(F.col("arrival").between(low, high - 1)), len(parts) - 1, out)
        assert {(r.arrival, r.error) for r in read_outcomes(spark, out).collect()} == expected
        assert read_outcomes(spark, out).count() == 24


def test_a_repeated_delivery_is_refused(spark, tmp_path):
    out = str(tmp_path / "out")
    prepare(spark, out)
    docs = documents(spark, [document()])
    store_batch(docs.union(docs), 0, out)
    store_batch(docs, 1, out)
    assert sorted(r.outcome for r in read_outcomes(spark, out).collect()) == ["error", "error", "persisted"]


def test_names_that_end_like_a_result_are_read_and_the_rest_is_listed(spark, tmp_path):
    folder = tmp_path / "in" / "job" / "0" / "custom_output" / "0"
    folder.mkdir(parents=True)
    for name in ("result.json", "page_result.json", "final-result.json", "result+1 result.json", "result.json.tmp", "other.json"):
        (folder / name).write_text(document(invoice_number=name))
    read = read_extractions(spark, str(tmp_path / "in"), "b")
    names = {r.s3_key.rsplit("/", 1)[1] for r in read.collect()}
    assert names == {"result.json", "page_result.json", "final-result.json", "result+1 result.json"}
    listed = list_files(spark, str(tmp_path / "in"), "b")
    assert listed.count() == 6 and {r.s3_key.rsplit("/", 1)[1] for r in skipped_files(listed).collect()} == {"result.json.tmp", "other.json"}
    out = str(tmp_path / "out")
    run(start_ingest(stream_extractions(spark, str(tmp_path / "in"), "b"), out, str(tmp_path / "ckpt")))
    assert read_accepted(spark, out).count() == 4


def test_many_files_do_not_make_many_tasks(spark, tmp_path):
    for i in range(300):
        deliver(tmp_path, f"j{i}", document(invoice_number=str(i)))
    read, listed = read_extractions(spark, str(tmp_path), "b"), list_files(spark, f"file://{tmp_path}/", "b")
    # Spark's own readers plan a task for 32 files
    assert read.rdd.getNumPartitions() == listed.rdd.getNumPartitions() == 4
    texts = {r.s3_key: r.raw for r in read.collect()}
    assert len(texts) == 300 and all((tmp_path / key[1:]).read_text() == raw for key, raw in texts.items())
    own = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    times = {r.s3_key: r.arrival for r in listed.collect()}
    assert {r.path.removeprefix(f"file:{tmp_path}"): r.at for r in own.selectExpr("path", "unix_micros(modificationTime) AS at").collect()} == times
    assert {r.s3_key: r.arrival for r in read.collect()} == times


@pytest.mark.parametrize("name", ["_result.json", ".result.json", "_j3/0/custom_output/0/result.json", "j/.x/result.json"])
def test_result_files_that_spark_would_pass_over_are_refused(spark, tmp_path, name):
    deliver(tmp_path, "j1", document())
    assert read_extractions(spark, str(tmp_path)).count() == 1 and hidden_results(spark, str(tmp_path)) == []
    (tmp_path / "_SUCCESS").write_text("")
    assert hidden_results(spark, str(tmp_path)) == []
    hidden = tmp_path / "j2" / "custom_output" / name if "/" not in name else tmp_path / name
    hidden.parent.mkdir(parents=True)
    hidden.write_text(document())
    for read in (read_extractions, stream_extractions):
        with pytest.raises(ValueError, match="result.json"):
            read(spark, str(tmp_path))


def test_writers_do_not_replace_each_other(spark, tmp_path):
    out, landed = str(tmp_path / "out"), str(tmp_path / "landed")
    docs = documents(spark, [document(invoice_number=str(i)) for i in range(13)])
    load_documents(docs.filter("arrival < 10"), out)
    docs.filter("arrival >= 8").write.parquet(landed)
    for checkpoint in ("one", "two"):  # the second has lost its checkpoint: all it brings is known
        run(start_ingest(stream_extractions(spark, landed, landed=True), out, str(tmp_path / checkpoint)))
    rows = read_outcomes(spark, out).collect()
    assert len(rows) == 10 + 5 + 5 and sum(r.outcome == "persisted" for r in rows) == 13
    assert writer_of(spark, str(tmp_path / "one")) == writer_of(spark, str(tmp_path / "one")) != writer_of(spark, str(tmp_path / "two"))


def test_a_replayed_batch_counts_once(spark, tmp_path):
    out, dash = str(tmp_path / "out"), str(tmp_path / "dash")
    prepare(spark, out)
    docs = documents(spark, [document(invoice_number=str(i)) for i in range(10)])
    for _ in range(2):
        store_batch(docs, 0, out)
        run(start_dashboard(spark, out, dash, str(tmp_path / "ckpt")))
    assert [tuple(r) for r in read_dashboard(spark, dash).collect()] == [tuple(r) for r in status_totals(spark, out).collect()]
    assert read_dashboard(spark, dash).agg(F.sum("invoice_count")).first()[0] == 10


def test_names_are_compared_as_they_are_stored(spark, tmp_path):
    out = str(tmp_path / "out")
    prepare(spark, out)
    long = "x" * 100
    store_batch(documents(spark, [document(invoice_number=long), document(invoice_number=long + " ")]), 0, out)
    store_batch(documents(spark, [document(invoice_number=long + "  ")]), 1, out)
    rows = read_outcomes(spark, out).collect()
    assert sorted(r.outcome for r in rows) == ["error", "error", "persisted"]


def test_blank_and_outer_numbers_are_found_in_the_history(spark, tmp_path):
    out = str(tmp_path / "out")
    prepare(spark, out)
    store_batch(documents(spark, [document(invoice_number=n) for n in ("", "M", "A", "Z")]), 0, out)
    store_batch(documents(spark, [document(invoice_number=n) for n in ("", "M")]), 1, out)
    store_batch(documents(spark, [document(invoice_number="")]), 2, out)
    store_batch(documents(spark, [document(invoice_number="N")]), 3, out)
    store_batch(documents(spark, [document(total_amount="N/A")]), 4, out)
    stored = sorted((r.batch_id, r.invoice_number) for r in read_accepted(spark, out).collect())
    assert stored == [(0, ""), (0, "A"), (0, "M"), (0, "Z"), (3, "N")]


def test_action_log_takes_each_request_once(spark, tmp_path):
    rows = spark.sql("select id as action_id, timestamp_ntz'2025-01-01' as action_time, '1' as invoice_id, "
                     "'approve' as action from range(10)")
    for part in (0, 1):
        rows.filter(F.col("action_id") % 2 == part).write.mode("append").parquet(str(tmp_path / "requests"))
        for _ in range(2):
            stream = spark.readStream.schema(ACTION_LOG).parquet(str(tmp_path / "requests"))
            run(start_approvals(stream, str(tmp_path / "log"), str(tmp_path / "ckpt")))
    assert read_actions(spark, str(tmp_path / "log")).count() == 10
