"""License scans: short notices found in whole texts although some letters are wrong.

Words are runs of ASCII letters and digits and of characters from U+0080 on, A-Z lower-cased.
A text is looked at as its words with one space between, so marks and line ends cost nothing.

How a notice is found
  seeds     a notice that may have ``k`` errors is split into ``k + 1`` pieces: k errors touch at
            most k of them, so every place holds one piece unharmed (pigeonhole).  The pieces
            of all notices are searched in one pass by an Aho-Corasick automaton.
  verify    around each seed the notice is tried without errors at the place the seed gives, and else
            the ``regex`` library matches it with at most ``k`` insertions, deletions and
            substitutions, best match first.  A match begins and ends at words, and words of up to
            ``FIRM`` letters, too short for an error, must stand as they are.
  spans     of each match: first and last word, bytes of the original text, errors.

All exact places are reported.  A match with errors is reported where it overlaps neither an exact
place nor a better match of its notice.

Each text is worked on where it lies: there is no shuffle.  Defined results: a null, empty or
blank text has no words and no match; repeated rows are reported each; other columns than
``doc_id`` and ``text``, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkledger.llm.words import as_bytes

#: Every byte as a word has it; what is in no word becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Words up to this length take no error.
FIRM = 3
#: Verified surroundings that a task keeps, since notices come in the same words again and again.
REMEMBERED = 1 << 16
HITS = "array<struct<notice:string,label:string,first_word:bigint,last_word:bigint,first_byte:bigint,end_byte:bigint,errors:int>>"
SCANNED = f"doc_id bigint, n_words bigint, hits {HITS}"


class Notice(NamedTuple):
    """Words to look for, lower case with single spaces; the label they give; the errors they may have."""

    words: str
    label: str
    errors: int = 0


def pieces(text: str, n: int) -> list[tuple[int, str]]:
    """``text`` cut into ``n`` pieces of about equal length, with their places."""
    cuts = [len(text) * i // n for i in range(n + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def pattern(notice: Notice) -> str:
    """The notice between spaces: firm words as they are, what is between them with errors; the sum is checked on the match."""
    runs: list[list] = []
    for word in notice.words.split(" "):
        firm = len(word) <= FIRM
        if runs and not runs[-1][0] and not firm:
            runs[-1][1] += " " + word
        else:
            runs.append([firm, word])
    parts = [regex.escape(x) if firm else f"(?:{regex.escape(x)}){{e<={notice.errors}}}" for firm, x in runs]
    return "(?b) (" + " ".join(parts) + ") "


class Scanner:
    """The notices' automaton and patterns; one for all texts of a task."""

    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        self.automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            cut = pieces(notice.words, notice.errors + 1)
            assert min(len(x) for _, x in cut) > 0, f"more errors than letters: {notice}"
            for at, x in cut:
                seeds.setdefault(x, []).append((i, at))
        for x, uses in seeds.items():
            self.automaton.add_word(x, (len(x), uses))
        self.automaton.make_automaton()
        self.patterns = [regex.compile(pattern(n)) if n.errors else None for n in notices]
        self.around = lru_cache(REMEMBERED)(self._around)

    def _around(self, i: int, window: str) -> tuple[int, int, int] | None:
        """Start, end and errors of the best match in a window."""
        found = self.patterns[i].search(window)
        if found is None or sum(found.fuzzy_counts) > self.notices[i].errors:
            return None
        return (*found.span(1), sum(found.fuzzy_counts))

    def places(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, errors) of every match in ``text``, which has a space before and after each word."""
        exact, inexact = set(), set()
        for last, (size, uses) in self.automaton.iter(text):
            for i, at in uses:
                words, k = self.notices[i].words, self.notices[i].errors
                start = last + 1 - size - at
                if start > 0 and text.startswith(words, start) and text[start - 1] == " " == text[start + len(words)]:
                    exact.add((i, start, start + len(words), 0))
                elif k:
                    low = max(start - k - 1, 0)
                    if hit := self.around(i, text[low:start + len(words) + k + 1]):
                        inexact.add((i, low + hit[0], low + hit[1], hit[2]))
        taken: dict[int, list[tuple[int, int]]] = {}
        for i, start, end, _ in sorted(exact):
            taken.setdefault(i, []).append((start, end))
        kept = list(exact)
        for i, start, end, errors in sorted(inexact, key=lambda x: (x[3], x[1:3], x[0])):
            spans = taken.setdefault(i, [])
            at = bisect_left(spans, (start, end))
            # accepted spans of a notice differ little in length, so neighbours tell
            near = spans[max(at - 2, 0):at + 2]
            if errors and not any(a < end and start < b for a, b in near):
                insort(spans, (start, end))
                kept.append((i, start, end, errors))
        return sorted(kept, key=lambda x: (x[1], x[2], x[0]))

    def scan(self, data: bytes) -> tuple[int, list[dict]]:
        """Number of words and the matches of one text."""
        words = data.translate(FOLD).split()
        text = " " + b" ".join(words).decode("utf-8", "replace") + " "
        places = self.places(text)
        if not places:
            return len(words), []
        # the word that begins at each place, and each word's bytes in the text as it is
        begins = [m.end() for m in re.finditer(" ", text)]
        spans = [m.span() for m in WORD.finditer(data)]
        hits = []
        for i, start, end, errors in places:
            first, last = bisect_left(begins, start), bisect_left(begins, end) - 1
            hits.append({"notice": self.notices[i].words, "label": self.notices[i].label, "first_word": first, "last_word": last,
                         "first_byte": spans[first][0], "end_byte": spans[last][1], "errors": errors})
        return len(words), hits


@lru_cache(4)
def _scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


def scan(docs: DataFrame, notices: list[Notice]) -> DataFrame:
    """Per document its number of words and every match of a notice, in order: ``doc_id``, ``n_words``, ``hits``."""
    wanted = tuple(notices)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(wanted)
        kind = pa.list_(pa.struct([("notice", pa.string()), ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                                   ("first_byte", pa.int64()), ("end_byte", pa.int64()), ("errors", pa.int32())]))
        for batch in batches:
            counts, hits = [], []
            for data in as_bytes(batch.column(1)):
                n, found = scanner.scan(data)
                counts.append(n)
                hits.append(found)
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(hits, kind)], ["doc_id", "n_words", "hits"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(search, SCANNED)


def joined_labels(hits: Column) -> Column:
    """The distinct labels of matches, sorted and joined by commas; empty without matches."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda x: x["label"]))), ",")


def likeness(hits: Column) -> Column:
    """1 for a match without errors, less by the share of wrong letters of the best one, 0 without matches."""
    each = F.transform(hits, lambda x: F.lit(1.0) - x["errors"] / F.length(x["notice"]))
    return F.coalesce(F.array_max(each), F.lit(0.0))


def summary(scanned: DataFrame, base: list[str]) -> DataFrame:
    """The matches in one row per document; ``base`` names the notices whose exact places are counted by themselves."""
    own = F.filter("hits", lambda x: (x["errors"] == 0) & x["notice"].isin(*base))
    starts = F.transform(F.col("_base"), lambda x: x["first_word"])
    return scanned.withColumn("_base", own).select(
        "doc_id", "n_words", F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined_labels(F.col("_base")).alias("base_labels"), joined_labels(F.col("hits")).alias("labels"),
        likeness(F.col("hits")).alias("score"), F.size("hits").cast("bigint").alias("n_hits"))
