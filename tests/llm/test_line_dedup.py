"""Winnowed runs against every window of every document."""

import random

import pytest

from inkledger.llm import line_dedup
from inkledger.llm.line_dedup import repeated_runs, without_repeats


def brute(rows, w):
    """doc_id -> lines that lie in a window seen before; ids are distinct here."""
    seen, out = set(), {}
    for doc, text in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = [x.strip(" \t\r") for x in text.split("\n")]
        gone = set()
        for s in range(len(lines) - w + 1):
            window = tuple(lines[s:s + w])
            if any(window) and window in seen:
                gone.update(range(s, s + w))
            seen.add(window)
        for i, line in enumerate(lines):
            if len(line.split()) >= line_dedup.LONG and ("long", line) in seen:
                gone.add(i)
            seen.add(("long", line))
        out[doc] = [x for i, x in enumerate(text.split("\n")) if i not in gone]
    return out


def corpus(rng, lines=30, docs=150):
    rows = []
    for d in range(docs):
        body = []
        while len(body) < rng.choice([1, 2, 5, 40]):
            if rng.random() < 0.5:
                at = rng.randrange(lines)
                body += [f"line {i} " for i in range(at, min(lines, at + rng.randint(1, 6)))]  # runs that recur
            else:
                body.append(rng.choice([f"line {rng.randrange(lines)}", f"own {rng.random()}", "", " ", f"{rng.randrange(9)} b c d e f g h i j",
                                        f"{rng.randrange(9)} b\tc d e f g h  i"]))
        rows.append((d, "\n".join(body)))
    return rows


@pytest.mark.parametrize("w", [1, 2, 3])
@pytest.mark.parametrize("few", [0, 6, 10_000])
def test_equals_every_window(spark, monkeypatch, w, few):
    monkeypatch.setattr(line_dedup, "FEW", few)
    rows = corpus(random.Random(w))
    got = without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), w).collect()
    want = brute(rows, w)
    assert {r["doc_id"]: r["text"] for r in got} == {d: "\n".join(x) for d, x in want.items()}
    assert all(r["n_removed"] == r["n_lines"] - len(want[r["doc_id"]]) for r in got)


def test_long_lines_go_alone_and_blank_ones_stay(spark):
    long, short = " ".join(f"w{i}" for i in range(10)), " ".join(f"w{i}" for i in range(9))
    rows = [(1, f"a\n\n\nb\n{long}\n{short}"), (2, f"c\n\n\nd\n{long} \ne\n{short}"), (3, long), (4, f"{long}\nx\n{long}")]
    got = {r["doc_id"]: r["text"] for r in without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    assert got == {1: rows[0][1], 2: f"c\n\n\nd\ne\n{short}", 3: "", 4: "x"}


def test_a_text_of_very_many_runs(spark):
    body = "\n".join(f"p\nq\nown {i}" for i in range(30_000))
    rows = [(1, "p\nq"), (2, body)]
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    assert got[2] == (60_000, "\n".join(f"own {i}" for i in range(30_000)))


def test_one_line_over_and_over(spark):
    rows = [(1, "x\n" * 500 + "end"), (2, "a\nx\nx\nb")]
    got = {r["doc_id"]: r["text"] for r in without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    assert got == {1: "x\nend", 2: "a\nb"}


def test_edge_rows(spark):
    rows = [(1, "a\nb\nc", "u", 1), (None, "a\nb", "v", 2), (2, None, "w", 3), (3, "", "x", 4), (4, "b\nc \r\nd", "y", 5), (4, "b\nc \r\nd", "y", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, n int")
    got = without_repeats(docs, 2)
    assert got.columns == ["doc_id", "text", "runs", "n", "n_lines", "n_removed"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([
        (None, "a\nb", "v", 2, 2, 0),  # a null id is the earliest
        (1, "c", "u", 1, 3, 2), (2, None, "w", 3, 0, 0), (3, "", "x", 4, 1, 0),
        (4, "d", "y", 5, 3, 2), (4, "d", "y", 5, 3, 2)], key=str)  # rows equal in id and text are one document
    assert without_repeats(docs.limit(0), 2).count() == 0


def test_runs_are_merged(spark):
    text = "\n".join(f"l{i}" for i in range(50))
    runs = repeated_runs(spark.createDataFrame([(1, text), (2, "x\n" + text + "\ny")], "doc_id bigint, text string"), 3).collect()
    assert [(r["doc_id"], [tuple(x) for x in r["runs"]]) for r in runs] == [(2, [(1, 50)])]
