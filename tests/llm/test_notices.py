"""License scans against a plain program over all places and all numbers of words."""

import random
import re
from pathlib import Path

import pytest
import regex

from inkledger.llm import notices, queries
from inkledger.llm.notices import FIRM, Notice, Scanner, pattern, pieces, scan, summary

SF = "/root/testdata/sf0.001"
FEW = [Notice("mit license", "mit", 1), Notice("general public license", "gpl", 2), Notice("all rights reserved", "reserved", 2), Notice("bsd", "bsd", 0)]


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def exact(words, phrase):
    own = phrase.split()
    return [i for i in range(len(words) - len(own) + 1) if words[i:i + len(own)] == own]


def fuzzy(words, notice):
    """Whether any run of words matches the notice's pattern, without seeds."""
    test = regex.compile(pattern(notice))
    size = len(notice.words.split())
    for i in range(len(words)):
        for n in range(max(size - notice.errors, 1), size + notice.errors + 1):
            found = test.fullmatch(" " + " ".join(words[i:i + n]) + " ")
            if found and sum(found.fuzzy_counts) <= notice.errors:
                return True
    return False


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def damaged(draw, text):
    letters = list(text)
    for _ in range(draw.randrange(4)):
        at = draw.randrange(len(letters))
        draw.choice([lambda: letters.insert(at, draw.choice("abz e")), lambda: letters.__setitem__(at, draw.choice("xyzé ")), lambda: len(letters) > 2 and letters.pop(at)])()
    return "".join(letters)


def test_pieces_cover_the_notice():
    for n in (1, 2, 3, 7):
        cut = pieces("general public license", n)
        assert "".join(x for _, x in cut) == "general public license" and [at for at, _ in cut] == [sum(len(x) for _, x in cut[:k]) for k in range(n)]


def test_matches_equal_brute_force():
    draw = random.Random(11)
    filler = ["the", "license", "public", "general", "mit", "gnu", "rights", "all", "é", "licensed", "x1"]
    scanner = Scanner(tuple(FEW))
    met = set()
    for _ in range(400):
        parts = [draw.choice(filler) for _ in range(draw.randrange(6))]
        for _ in range(draw.randrange(4)):
            parts.insert(draw.randrange(len(parts) + 1), damaged(draw, draw.choice(FEW).words))
        text = draw.choice([" ", ", ", "\n"]).join(parts)
        words = words_of(text)
        n, hits = scanner.scan(text.encode())
        assert n == len(words)
        for notice in FEW:
            own = [h for h in hits if h["notice"] == notice.words]
            assert sorted(h["first_word"] for h in own if h["errors"] == 0) == exact(words, notice.words)
            assert bool(own) == fuzzy(words, notice), (text, notice)
            for h in own:
                seen = " ".join(words[h["first_word"]:h["last_word"] + 1])
                assert distance(seen, notice.words) <= h["errors"] <= notice.errors
                assert words_of(text.encode()[h["first_byte"]:h["end_byte"]].decode()) == seen.split()
                assert all(w in seen.split() for w in notice.words.split() if len(w) <= FIRM)
                met.add((notice.label, h["errors"]))
    assert {("mit", 0), ("mit", 1), ("gpl", 0), ("gpl", 1), ("gpl", 2), ("reserved", 2)} <= met


def test_overlapping_exact_places_are_all_found():
    scanner = Scanner((Notice("again and again", "a", 2),))
    hits = scanner.scan(b"again and again and again, agian and again")[1]
    assert [(h["first_word"], h["errors"]) for h in hits] == [(0, 0), (2, 0), (5, 2)]


def test_odd_rows(spark):
    long = "word " * 200_000 + "MIT  License"
    rows = [(None, "MIT license"), (1, None), (2, ""), (3, " .,"), (4, long), (5, "mit-license; Mit\nLicense"), (5, "mit-license; Mit\nLicense"), (6, "omit license"), (7, "mit licence")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS hits", "'x' AS n_words", "2 AS label")
    got = sorted(summary(scan(docs, FEW), ["mit license"]).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    shown = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in got]
    assert shown == [(1, 0, 0, None, None, "", ""), (2, 0, 0, None, None, "", ""), (3, 0, 0, None, None, "", ""), (4, 200_002, 1, 200_000, 200_000, "mit", "mit"),
                     (5, 4, 2, 0, 2, "mit", "mit"), (5, 4, 2, 0, 2, "mit", "mit"), (6, 2, 0, None, None, "", ""), (7, 2, 0, None, None, "", "mit"), (None, 2, 1, 0, 0, "mit", "mit")]
    assert [r["score"] for r in got][:4] == [0.0, 0.0, 0.0, 1.0] and 0.9 < got[7]["score"] < 1
    assert scan(docs.limit(0), FEW).count() == 0


def test_one_word_many_times_is_linear():
    n, hits = Scanner(tuple(FEW)).scan(b"license " * 100_000 + b"mit license")
    assert n == 100_002 and [h["first_word"] for h in hits] == [100_000]


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables not there")
def test_the_registered_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_fuzzy_notices(spark, SF)
    assert [t for c, t in got.dtypes[:8]] == ["bigint"] * 5 + ["string", "string", "double"]
    rows = {r["doc_id"]: r for r in got.collect()}
    every = queries.BASE_NOTICES + queries.MORE_NOTICES
    for d in docs:
        words, r = words_of(d["text"]), rows[d["doc_id"]]
        places = {n.label: exact(words, n.words) for n in queries.BASE_NOTICES}
        starts = sum(places.values(), [])
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(starts), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted(k for k, v in places.items() if v))
        sure = {n.label for n in every if exact(words, n.words)}
        assert sure <= set(r["labels"].split(",")) | {""} and (r["score"] == 1) == bool(sure) and 0 <= r["score"] <= 1


def test_more_errors_than_letters_are_refused():
    with pytest.raises(AssertionError):
        notices.Scanner((Notice("ab", "x", 5),))
