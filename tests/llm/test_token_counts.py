"""The trie against a plain dynamic program, and against a public library's unigram model."""

import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from inkledger.llm import token_counts
from inkledger.llm.lattices import Lattice, piece_ends
from inkledger.llm.queries import VOCABULARY, op6_trie_token_counts
from inkledger.llm.token_counts import MARK, Trie, Vocabulary, count_tokens

needs_file = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="vocabulary file not there")


def plain(vocabulary, word):
    """Best (score, pieces) of every prefix, each on its own."""
    text, best = MARK + word, [(0.0, 0)]
    for end in range(1, len(text) + 1):
        options = [(best[s][0] + vocabulary.scores[text[s:end]], -best[s][1] - 1) for s in range(end) if text[s:end] in vocabulary.scores]
        if text[end - 1] not in vocabulary.scores:
            size = len(text[end - 1].encode())
            options.append((best[end - 1][0] + vocabulary.unknown * size, -best[end - 1][1] - size))
        score, pieces = max(options)
        best.append((score, -pieces))
    return best[-1][1]


def test_trie_equals_plain_program():
    rng = random.Random(6)
    letters = "abé"
    pieces = {MARK: -3.0} | {"".join(rng.choice(MARK + letters) for _ in range(rng.randint(1, 4))): -float(rng.randint(1, 9)) for _ in range(60)}
    vocabulary = Vocabulary(pieces)
    trie = Trie(vocabulary)
    words = ["".join(rng.choice(letters + "z漢") for _ in range(rng.randint(0, 90))) for _ in range(1500)]
    assert [trie.count(w.encode()) for w in words] == [plain(vocabulary, w) for w in words]


def test_prefixes_are_scored_once():
    trie = Trie(Vocabulary({MARK: -1.0, "a": -1.0, "b": -1.0}))
    trie.learn([b"aaab", b"aaaa", b"aa", b"aab"])
    assert trie.nodes == len({MARK, MARK + "a", MARK + "aa", MARK + "aaa", MARK + "aaaa", MARK + "aaab", MARK + "aab"})
    trie.learn([b"aaab"])
    assert trie.nodes == 7


def test_remembered_counts_start_over(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 20)
    vocabulary = Vocabulary({MARK: -1.0, "a": -2.0, "ab": -2.5, "b": -2.0})
    trie, rng = Trie(vocabulary), random.Random(1)
    for _ in range(20):
        words = {"".join(rng.choice("ab") for _ in range(9)) for _ in range(15)}
        trie.learn(w.encode() for w in words)
        assert all(trie.counts[w.encode()] == plain(vocabulary, w) for w in words) and len(trie.counts) <= 36


@needs_file
def test_library_agrees_on_best_scores(spark):
    """The library breaks ties its own way, so the sums of scores are compared, and counts where they are unique."""
    from tokenizers import Tokenizer, models

    vocabulary = Vocabulary.read(VOCABULARY)
    pieces = [("<unk>", -1e6), *vocabulary.scores.items()]
    library = Tokenizer(models.Unigram(pieces, 0, False))
    trie = Trie(vocabulary)
    for word in ["the", "International", "thtionst", "Straße", "éçmentelle", "a" * 30, "queoneau", "the,the", "xyzzy"]:
        tokens = library.encode(MARK + word).tokens
        ours = trie.count(word.encode())
        assert ours <= len(tokens) and (sum(vocabulary.scores[t] for t in tokens) == pytest.approx(_score(vocabulary, word)))


def _score(vocabulary, word):
    text, best = MARK + word, [0.0]
    for end in range(1, len(text) + 1):
        best.append(max(best[s] + vocabulary.scores[text[s:end]] for s in range(end) if text[s:end] in vocabulary.scores))
    return best[-1]


@needs_file
def test_whole_texts_and_edges(spark):
    texts = [None, "", " \n\t", "the the\x0bthe", "the the", "漢字 \U0001F600", "ab " * 50_000, "q" * 5000]
    rows = [(i, t, "kept") for i, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = count_tokens(docs, VOCABULARY)
    assert got.columns == ["doc_id", "text", "n_tokens", "n_words"]
    vocabulary = Vocabulary.read(VOCABULARY)
    counts = {r["doc_id"]: (r["n_tokens"], r["n_words"]) for r in got.collect()}
    assert got.count() == 16 and counts[0] == counts[1] == counts[2] == (0, 0)
    for i in range(3, 8):
        words = [w.decode() for w in texts[i].encode().split()]
        per = {w: plain(vocabulary, w) for w in set(words)}
        assert counts[i] == (sum(per[w] for w in words), len(words))
    assert count_tokens(docs.limit(0), VOCABULARY).count() == 0


def test_expected_counts_equal_all_cuts():
    vocabulary = Vocabulary({MARK: -2.0, "a": -1.5, "b": -2.5, "ab": -3.0, MARK + "a": -2.2, "ba": -4.0})
    text, cuts = MARK + "abab", []

    def cut(at, pieces):
        if at == len(text):
            cuts.append(pieces)
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in vocabulary.scores:
                cut(end, [*pieces, text[at:end]])

    cut(0, [])
    weights = [math.exp(sum(vocabulary.scores[p] for p in c)) for c in cuts]
    counts = {}
    assert token_counts.expected_counts(vocabulary, b"abab", 3, counts) == pytest.approx(3 * math.log(sum(weights)))
    for piece in vocabulary.scores:
        want = 3 * sum(w * c.count(piece) for w, c in zip(weights, cuts)) / sum(weights)
        assert counts.get(piece, 0.0) == pytest.approx(want)


def test_a_trie_of_words_counts_as_each_word_by_itself():
    rng = random.Random(4)
    letters = "abcdé"
    pieces = sorted({MARK, *letters, "zz", *("".join(rng.choice(MARK + letters) for _ in range(rng.randint(1, 4))) for _ in range(80))})
    scores = np.array([-rng.uniform(1, 12) for _ in pieces])
    vocabulary = Vocabulary(dict(zip(pieces, scores.tolist())))
    # z stands in a longer piece only, the others in none
    words = sorted({"".join(rng.choice(letters + "z漢q") for _ in range(rng.randint(0, 30))).encode() for _ in range(600)})
    texts = sorted((MARK + w.decode(), w, rng.randint(1, 9)) for w in words)
    lattice = Lattice.unpack(Lattice.build(*map(list, zip(*texts)), piece_ends(pieces)).pack())
    want, fit = {}, 0.0
    for _, word, n in texts:
        fit += token_counts.expected_counts(vocabulary, word, n, want)
    counts, got, lost = lattice.expect(scores, vocabulary.unknown, 3.0)
    assert lost == [] and got == pytest.approx(fit)
    assert dict(zip(pieces, counts)) == pytest.approx({p: want.get(p, 0.0) for p in pieces}, abs=1e-9)
    # a scale far off: what leaves the range of doubles is handed back, the rest is right
    counts, got, lost = lattice.expect(scores, vocabulary.unknown, 60.0)
    assert lost and len(lost) < len(texts)
    for word, n in lost:
        own = {}
        got += token_counts.expected_counts(vocabulary, word, n, own)
        for p, c in own.items():
            counts[pieces.index(p)] += c
    assert got == pytest.approx(fit) and dict(zip(pieces, counts)) == pytest.approx({p: want.get(p, 0.0) for p in pieces}, abs=1e-9)


def test_estimated_scores_equal_a_plain_estimation(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.choice([1, 2, 5, 90]))) for _ in range(rng.randrange(12))) for _ in range(60)] + [None, "", "漢 a"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    pieces = sorted({MARK, "a", "b", "c", "ab", "bc", MARK + "a", "abc", "never"})
    words = Counter(w for t in texts if t for w in t.encode().split())
    scores, before = dict.fromkeys(pieces, -math.log(len(pieces))), None
    while True:
        counts, vocabulary = {}, Vocabulary(scores)
        fit = sum(token_counts.expected_counts(vocabulary, w, n, counts) for w, n in words.items())
        if before is not None and fit - before < token_counts.STILL * abs(before):
            break
        before, total = fit, sum(max(counts.get(p, 0.0), token_counts.LEAST) for p in pieces)
        scores = {p: math.log(max(counts.get(p, 0.0), token_counts.LEAST) / total) for p in pieces}
    for chunk in (50_000, 7):
        monkeypatch.setattr(token_counts, "CHUNK", chunk)
        got = token_counts.estimated(docs, pieces)
        assert got.scores == pytest.approx(scores, abs=1e-3)
    assert token_counts.estimated(docs.limit(0), pieces).scores == pytest.approx(dict.fromkeys(pieces, -math.log(len(pieces))))


@needs_file
def test_the_query_counts_common_words_as_whole_pieces(spark, tmp_path):
    """Merge ranks as scores cut them: 4 tokens for one word and 2 for the other."""
    rows = [(i, "the information the of the information") for i in range(30)] + [(90, "information"), (91, "the"), (92, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["n_tokens"] for r in op6_trie_token_counts(spark, str(tmp_path)).collect()}
    assert (got[90], got[91], got[92], got[0]) == (1, 1, 0, 6)
