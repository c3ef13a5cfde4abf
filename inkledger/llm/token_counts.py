"""Token counts under a unigram vocabulary by dynamic programming shared along a trie.

A text's tokens are those of its pre-tokens: runs of anything but ASCII white space, each led by
the word mark.  A pre-token is cut into the pieces with the largest sum of scores; of equal sums
the one with the fewest pieces counts.  The distinct pre-tokens of a batch form a trie, which is
walked depth first: in sorted order, a pre-token's shared prefix with the one before is where
their paths part.  A node has the best score and piece count of its prefix, worked out once
from the nodes above it, and the node a pre-token ends at gives its count.  Only the current
path is in memory.

A vocabulary file may hold scores that are no log probabilities (those of a BPE model are merge
ranks).  ``estimated`` keeps its pieces and gives them the log probabilities of a unigram model,
by expected counts over the distinct pre-tokens of all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from inkledger.llm.common import staged
from inkledger.llm.lattices import Lattice, chunks, piece_ends
from inkledger.llm.words import as_bytes

MARK = "▁"
#: Counts of pre-tokens that a task remembers before it starts over.
REMEMBERED = 100_000
#: Estimation ends when a round raises the log likelihood by less than this share; the rounds are a guard far above.
STILL, ROUNDS = 0.001, 100
#: Expected count of a piece that occurs nowhere.
LEAST = 1e-6
#: Words and bytes of one trie, and the longest word in it; counts are summed in units of ``1 / UNIT``.
CHUNK, CHUNK_BYTES, LONG, UNIT = 50_000, 4 << 20, 64, 1 << 20
_MISSING = object()


class Vocabulary:
    """Pieces and their scores; a character in no piece costs one token per UTF-8 byte and ``unknown`` each."""

    def __init__(self, scores: dict[str, float], unknown: float | None = None):
        self.scores = scores
        self.unknown = min(scores.values(), default=0.0) - 10.0 if unknown is None else unknown
        # every end of a piece, with its score if it is one: looking backwards stops where no piece goes on
        self.ends = {piece[i:]: None for piece in scores for i in range(1, len(piece))} | scores

    @staticmethod
    def read(path: str) -> Vocabulary:
        """The pieces of a sentencepiece model file, without control, unknown and byte pieces."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = (i for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
        return Vocabulary({model.id_to_piece(i): model.get_score(i) for i in plain})

    def without_mark_runs(self) -> list[str]:
        """The pieces but for runs of two and more marks, which no pre-token needs; the single mark stays."""
        return [piece for piece in self.scores if piece == MARK or piece.strip(MARK)]


class Trie:
    """Counts of pre-tokens (in UTF-8, without their mark); ``nodes`` counts the prefixes scored."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.counts, self.nodes = vocabulary, {}, 0

    def learn(self, words: Iterable[bytes]) -> None:
        """Find the counts of distinct words that are not known yet."""
        if len(self.counts) > REMEMBERED:
            self.counts.clear()
        new = sorted((MARK + word.decode("utf-8", "replace"), word) for word in words if word not in self.counts)
        look, pieces_of, unknown = self.vocabulary.ends.get, self.vocabulary.scores, self.vocabulary.unknown
        # the current path: a score and a number of pieces for each prefix, the empty one first
        scores, pieces, before = [0.0], [0], ""
        for text, word in new:
            size, shared, most = len(text), 0, min(len(text), len(before))
            while shared < most and text[shared] == before[shared]:
                shared += 1
            del scores[shared + 1:], pieces[shared + 1:]
            self.nodes += size - shared
            for end in range(shared + 1, size + 1):
                best, fewest = None, 0
                start = end - 1
                while start >= 0:
                    value = look(text[start:end], _MISSING)
                    if value is _MISSING:
                        break
                    if value is not None:
                        value += scores[start]
                        if best is None or value > best or value == best and pieces[start] + 1 < fewest:
                            best, fewest = value, pieces[start] + 1
                    start -= 1
                if text[end - 1] not in pieces_of:
                    # the bytes of a character that is no piece
                    count = len(text[end - 1].encode("utf-8", "replace"))
                    value, count = scores[end - 1] + unknown * count, pieces[end - 1] + count
                    if best is None or value > best or value == best and count < fewest:
                        best, fewest = value, count
                scores.append(best)
                pieces.append(fewest)
            self.counts[word] = pieces[-1]
            before = text

    def count(self, word: bytes) -> int:
        if word not in self.counts:
            self.learn([word])
        return self.counts[word]


def _edges(vocabulary: Vocabulary, text: str, end: int) -> Iterator[tuple[int, float, str | None]]:
    """``(start, score, piece)`` of what can end at ``end``; the bytes of a character in no piece have none."""
    start = end - 1
    while start >= 0:
        value = vocabulary.ends.get(text[start:end], _MISSING)
        if value is _MISSING:
            break
        if value is not None:
            yield start, value, text[start:end]
        start -= 1
    if text[end - 1] not in vocabulary.scores:
        yield end - 1, vocabulary.unknown * len(text[end - 1].encode("utf-8", "replace")), None


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b))) if min(a, b) > -math.inf else max(a, b)


def expected_counts(vocabulary: Vocabulary, word: bytes, times: int, counts: dict[str, float]) -> float:
    """Add to ``counts`` how often each piece is expected in ``times`` words; their log likelihood."""
    text = MARK + word.decode("utf-8", "replace")
    size = len(text)
    ahead, back = [0.0] + [-math.inf] * size, [-math.inf] * size + [0.0]
    for end in range(1, size + 1):
        for start, value, _ in _edges(vocabulary, text, end):
            ahead[end] = _log_add(ahead[end], ahead[start] + value)
    for end in range(size, 0, -1):
        for start, value, piece in _edges(vocabulary, text, end):
            back[start] = _log_add(back[start], back[end] + value)
            if piece is not None:
                share = math.exp(min(0.0, ahead[start] + value + back[end] - ahead[size]))
                counts[piece] = counts.get(piece, 0.0) + times * share
    return times * ahead[size]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "n"])

    found: Counter = Counter()
    for batch in batches:
        for value in as_bytes(batch.column("text")):
            found.update(value.split())
        if len(found) > REMEMBERED:
            yield packed(found)
            found.clear()
    yield packed(found)


def estimated(docs: DataFrame, pieces: Iterable[str], text: str = "text") -> Vocabulary:
    """``pieces`` with the log probabilities of a unigram model of all pre-tokens of ``docs``.

    All pieces start alike; each round aggregates, by piece, the expected counts over the distinct pre-tokens.  These
    are sorted and cut into chunks, whose tries are built once and written (``lattices``); a word of more than
    ``LONG`` characters goes by itself.  The driver gets one row a piece.  Counts are summed as whole numbers of
    2**-20, and a chunk is the same in each round, so sums do not depend on the order they come in.
    """
    words = docs.select(F.col(text).alias("text")).mapInArrow(_word_counts, "word binary, n bigint")
    words = words.groupBy("word").agg(F.sum("n").alias("n"))
    words = words.repartitionByRange("word").sortWithinPartitions("word")
    pieces = sorted(set(pieces))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = piece_ends(pieces)
        rows = (row for batch in batches for row in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()))
        for chunk in chunks(rows, CHUNK, CHUNK_BYTES):
            told = sorted((MARK + word.decode("utf-8", "replace"), word, n) for word, n in chunk)
            short = [x for x in told if len(x[0]) <= LONG]
            long = [x[1:] for x in told if len(x[0]) > LONG]
            packed = Lattice.build(*map(list, zip(*short)), ends).pack() if short else None
            yield pa.record_batch([pa.array([packed, *[None] * len(long)], pa.binary()), pa.array([None, *[w for w, _ in long]], pa.binary()),
                                   pa.array([None, *[n for _, n in long]], pa.int64())], ["lattice", "word", "n"])

    lattices = staged(words.mapInArrow(build, "lattice binary, word binary, n bigint"), "tokens-lattices")
    scores, before, per_character = np.full(len(pieces), -math.log(max(1, len(pieces)))), None, 4.0
    for _ in range(ROUNDS):
        unknown = float(scores.min(initial=0.0)) - 10.0

        def expect(batches: Iterator[pa.RecordBatch], scores=scores, unknown=unknown, per_character=per_character) -> Iterator[pa.RecordBatch]:
            vocabulary, number = None, {p: i for i, p in enumerate(pieces)}
            total, fit, letters = np.zeros(len(pieces), np.int64), 0, 0
            for batch in batches:
                for packed, word, n in zip(*(batch.column(c).to_pylist() for c in ("lattice", "word", "n"))):
                    alone = [(word, n)] if word is not None else []
                    if packed is not None:
                        lattice = Lattice.unpack(packed)
                        counts, gain, lost = lattice.expect(scores, unknown, per_character)
                        total += np.rint(counts * UNIT).astype(np.int64)
                        fit += round(gain * 1024)
                        letters += int((lattice.times * lattice.known[lattice.ends]).sum())
                        alone += lost
                    for one, times in alone:
                        vocabulary = vocabulary or Vocabulary(dict(zip(pieces, scores.tolist())), unknown)
                        own: dict[str, float] = {}
                        fit += round(expected_counts(vocabulary, one, times, own) * 1024)
                        for p, count in own.items():
                            total[number[p]] += round(count * UNIT)
            held = np.flatnonzero(total)
            yield pa.record_batch([pa.array(np.concatenate([[-1, -2], held])), pa.array(np.concatenate([[fit, letters], total[held]]))], ["piece", "n"])

        rows = lattices.mapInArrow(expect, "piece bigint, n bigint").groupBy("piece").agg(F.sum("n")).collect()
        told = {k: v for k, v in map(tuple, rows)}
        fit, letters = told.pop(-1, 0) / 1024, told.pop(-2, 0)
        if not told or before is not None and fit - before < STILL * abs(before):
            break
        counts = np.full(len(pieces), LEAST)
        for k, v in told.items():
            counts[k] = max(v / UNIT, LEAST)
        before = fit
        scores = np.round(np.log(counts / counts.sum()), 6)
        per_character = min(max(-fit / letters, 1.0), 9.0) if letters else 4.0
    return Vocabulary(dict(zip(pieces, scores.tolist())))


def count_tokens(docs: DataFrame, vocabulary: str | Vocabulary, text: str = "text", out: str = "n_tokens",
                 distinct: str = "n_words") -> DataFrame:
    """``docs`` with ``out``, the tokens of the whole text, and ``distinct``, its number of pre-tokens.

    A pass without a shuffle; what a task holds is bounded by a batch.  The vocabulary, or the file it
    is read from with its scores as they are, is on the driver and travels with the tasks.  Null and empty texts, and
    texts of white space only, have 0 tokens.  Columns named like the new ones are replaced.
    """
    docs = docs.drop(out, distinct)
    # a few ten thousand pieces, whatever the data
    scores = (Vocabulary.read(vocabulary) if isinstance(vocabulary, str) else vocabulary).scores

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(Vocabulary(scores))
        for batch in batches:
            texts = as_bytes(batch.column(text))
            known: set[bytes] = set()
            for value in texts:  # one after the other: only distinct words are held
                known.update(value.split())
            trie.learn(known)
            tokens, words = [], []
            for value in texts:
                parts = value.split()
                tokens.append(sum(map(trie.counts.__getitem__, parts)))
                words.append(len(parts))
            yield (batch.append_column(out, pa.array(tokens, pa.int64()))
                   .append_column(distinct, pa.array(words, pa.int64())))

    schema = StructType([*docs.schema.fields, StructField(out, LongType()), StructField(distinct, LongType())])
    return docs.mapInArrow(count, schema)
