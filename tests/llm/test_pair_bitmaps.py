"""Cross-tokenizer alignment against a plain program that encodes whole texts."""

import random
from collections import Counter
from hashlib import sha256
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from inkledger.llm import pair_bitmaps, queries
from inkledger.llm.pair_bitmaps import byte_alphabet, containers, members, piece_bytes, postings

pytestmark = pytest.mark.skipif(not Path(queries.BYTE_BPE).exists(), reason="vocabularies not there")
SF = "/root/testdata/sf0.001"


def brute(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, digest)."""
    a = Tokenizer.from_file(queries.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    letters = byte_alphabet()
    names = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    rows, counts = [], Counter()
    for text in texts:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        x, y = [(i, names[i]) for i in x], [(i, piece_bytes(b.id_to_piece(i))) for i in y]
        whole = (" " + text).encode() if text else b""
        if b"".join(t for _, t in x) != whole or b"".join(t for _, t in y) != whole:
            x, y = [], []
        at = lambda side: {end: k for k, end in enumerate(np.cumsum([len(t) for _, t in side]).tolist())}
        ends_x, ends_y = at(x), at(y)
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_x) & set(ends_y)):
            u, v = ends_x[end] + 1, ends_y[end] + 1
            groups.append(",".join(str(t) for t, _ in x[i:u]) + "|" + ",".join(str(t) for t, _ in y[j:v]))
            links.append((x[u - 1][0], y[v - 1][0]))
            i, j = u, v
        counts.update(links)
        rows.append((len(x), len(y), groups, links))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [(n, m, len(g), len(k), sum(counts[p] == most[p[1]] for p in k), sum(counts[p] for p in k),
             sha256(";".join(g).encode()).hexdigest() if g else "") for n, m, g, k in rows], counts


ODD = ["", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n b", "a \nb", "a\n\n  b \t c  d", "\u3000x  y", "foo\x00bar \x1c baz", "it's we'll  'tis",
       "<|endoftext|> <s> </s> <unk> <0x41>", "naïve café 日本語 テスト 🙂🙂 ▁ mark", "▁", "x▁y", "tab\tsep  \r\n end ", "12345 6,789.00 e=mc^2", "ﬁ ligature Å",
       " ".join("abcdefghij"[i % 10] * (i % 17) for i in range(3000)), "a" * 50_000, " " * 3000 + "x", "\x85 next line"]


def test_pieces_give_the_tokens_of_whole_texts(spark):
    draw = random.Random(5)
    alphabet = ["a", "b", " ", " ", "\n", "\t", "é", "日", "'s", "1", "-", "\u2003", "\xa0", "\x1c", "the", " of "]
    texts = ODD + ["".join(draw.choice(alphabet) for _ in range(draw.randrange(1, 40))) for _ in range(400)] + ["▁".join(draw.choice(alphabet) for _ in range(9)) for _ in range(9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got, pairs = pair_bitmaps.align(docs, queries.BYTE_BPE, queries.PIECE_BPE)
    want, counts = brute(texts)
    rows = {r["doc_id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in got.collect()}
    assert {i: (texts[i], r) for i, r in rows.items() if r != want[i]} == {} and len(rows) == len(texts)
    assert any(w[0] == 0 for w in want) and sum(w[0] > 0 for w in want) > 300
    assert {(r["a"], r["b"]): r["n_links"] for r in pairs.collect()} == counts


def test_the_registered_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want, counts = brute([r["text"] or "" for r in docs])
    got = queries.op12_pair_bitmaps(spark, SF)
    assert dict(got.dtypes) == {**{c: "bigint" for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}, "groups_sha256": "string"}
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == {r["doc_id"]: w for r, w in zip(docs, want)}


def test_counts_do_not_depend_on_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    files = [Path(p).read_bytes() for p in (queries.BYTE_BPE, queries.PIECE_BPE)]
    whole = pair_bitmaps.pair_counts(pair_bitmaps.index(docs.coalesce(1), *files))
    parts = pair_bitmaps.pair_counts(pair_bitmaps.index(docs.repartition(7), *files))
    assert sorted(whole.collect()) == sorted(parts.collect())


def test_planes_hold_documents_and_multiplicities():
    draw = random.Random(2)
    for n_docs in (1, 7, 600):
        links = [(draw.choice([3, 3, 3, 5, 9, 11]), draw.randrange(n_docs)) for _ in range(2500)] + [(20, 0)]
        pair, doc = (np.array(x, np.int64) for x in zip(*links))
        held, n_docs_of, n_links, planes = postings(pair, doc, n_docs)
        counts = Counter(links)
        assert held.tolist() == sorted({p for p, _ in links})
        for p, many, total, lists in zip(held.tolist(), n_docs_of, n_links, planes.to_pylist()):
            got = Counter()
            for j, plane in enumerate(lists):
                if plane:
                    got.update({int(x): 1 << j for x in members(np.frombuffer(plane, np.uint8), np.array([len(plane)]))[0]})
            assert got == {d: c for (q, d), c in counts.items() if q == p} and many == len(got) and total == sum(got.values())


def test_bitmaps_take_the_shorter_form():
    pair, place = np.array([1] * 3 + [2] * 90, np.int64), np.array([0, 5, 99, *range(90)], np.int64)
    which, data, ends = containers(pair, place, 100)
    assert which.tolist() == [1, 2] and ends.tolist() == [7, 7 + 1 + 13] and data[0] == 0 and data[7] == 1
    got, sizes = members(data, ends)
    assert got.tolist() == place.tolist() and sizes.tolist() == [3, 90]


def test_nulls_repeats_bytes_and_clashing_columns(spark):
    rows = [(None, "one two", "x", 1, 5), (1, None, None, None, None), (2, "one two", "y", 2, 6), (2, "one two", "y", 2, 6), (3, "", "z", 3, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a string, block long, planes int")
    docs = docs.unionByName(spark.sql("SELECT 4L AS doc_id, CAST(X'61FF62' AS STRING) AS text, 'q' AS a, 1L AS block, 0 AS planes"))
    got, _ = pair_bitmaps.align(docs, queries.BYTE_BPE, queries.PIECE_BPE)
    found = sorted(got.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    assert [r["doc_id"] for r in found] == [1, 2, 2, 3, 4, None]
    assert [r["n_a"] for r in found] == [0, 2, 2, 0, 0, 2] and [r["count_sum"] for r in found] == [0, 6, 6, 0, 0, 6]
    assert [r["groups_sha256"] == "" for r in found] == [True, False, False, True, True, False]
    empty, pairs = pair_bitmaps.align(docs.limit(0), queries.BYTE_BPE, queries.PIECE_BPE)
    assert empty.count() == 0 and pairs.count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        pair_bitmaps.byte_level(b'{"model": {"type": "BPE", "vocab": {}, "merges": []}, "pre_tokenizer": {"type": "Whitespace"}, "normalizer": null}')
