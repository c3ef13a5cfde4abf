"""Cross-tokenizer alignment: which tokens of two tokenizers end together, counted over all documents.

A document is encoded by a byte-level BPE (A) and by a sentencepiece model (B); both see its text
with one space before it.  Where a token of either ends at the same byte, the tokens since the
last such byte are a group, and the two tokens that end there are linked.  (Tokens are never
empty, so one of each ends there.)  A pair of ids scores by its number of links in all documents.

How it runs
  encode   texts are cut before spaces that follow another character than white space; neither tokenizer has a
           token across such a cut, so a piece of text has the same tokens wherever it stands.
           Each distinct piece of a block is encoded and aligned once; documents are put together
           from their pieces.  A piece whose tokens do not give its bytes back leaves its documents
           without tokens.
  invert   per block and pair, the places of the documents that hold the link, as bit planes:
           plane j holds the documents whose number of links has bit j.  A plane is a compressed
           bitmap: a list of 16-bit places, or bits where that is shorter.  The planes' union is the set
           of documents that hold the pair; its bits count documents, planes weighted by powers of two
           count links.
  score    these counts are summed over blocks, whose documents are disjoint; postings are joined
           with their pair's sum, and inside each block give it back to the documents.

Texts are encoded once: documents' own facts and postings are written by the same job.  A pair that all
documents hold is one row a block, and a block is bounded, so no key gathers an unbounded group.

Defined results: texts null, empty, not UTF-8, or not given back byte by byte by both tokenizers have no
tokens (zeros, and '' for the digest); rows are documents, also when ids are null or repeat; other columns
than ``doc_id`` and ``text``, whatever their names, are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkledger.llm.blocks import Numbers, binaries, flat, ragged, text_blocks
from inkledger.llm.common import staged

BLOCK_DOCS, BLOCK_BYTES = 4096, 8 << 20
#: Letters of distinct pieces that are encoded in one call.
RUN = 20_000
# White space as both tokenizers' patterns know it (fixed values, Unicode's White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A space that follows another character than white space and is followed by one, perhaps after more white space.
CUT = re.compile(f"(?<=[^{WHITE}]) (?=[{WHITE}]*[^{WHITE}])")
UNEVEN = re.compile(f"(?:^|[{WHITE}]) |[{WHITE}]$")
# The split into words of the byte-level tokenizer (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
INDEX = ("block bigint, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
         "a int, b int, pair_docs bigint, pair_links bigint, planes array<binary>")
NAMES = [part.split()[0] for part in INDEX.split(", ")]
SCORED = "block bigint, place int, n_best bigint, count_sum bigint"


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(file: bytes) -> dict[bytes, int]:
    """The tokens' bytes and ids of a byte-level BPE file whose ids follow its merges."""
    told = json.loads(file)
    vocabulary, merges = told["model"]["vocab"], told["model"]["merges"]
    if told["model"]["type"] != "BPE" or told["pre_tokenizer"]["type"] != "ByteLevel" or told["pre_tokenizer"]["add_prefix_space"] or told["normalizer"]:
        raise ValueError("not a plain byte-level BPE")
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    if made != sorted(made) or len(made) + 256 != len(vocabulary):
        raise ValueError("ids do not follow the merges")
    alphabet = byte_alphabet()
    return {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items()}


def piece_bytes(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Side:
    """One tokenizer: encodes text, and knows each token's bytes and its id as text before ``,`` and before its group's end."""

    def __init__(self, encode, tokens: list[bytes], end: str):
        self.encode, self.tokens = encode, tokens
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.inner = np.array([f"{i}," for i in range(len(tokens))], object)
        self.widths = np.fromiter(map(len, self.inner), np.int64, len(tokens))
        self.last = np.array([f"{i}{end}" for i in range(len(tokens))], object)


@lru_cache(2)
def sides(a_file: bytes, b_file: bytes) -> tuple[Side, Side]:
    ranks = byte_level(a_file)
    coder = tiktoken.Encoding("pairs", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    names = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        names[i] = token
    model = sentencepiece.SentencePieceProcessor(model_proto=b_file)
    own = [piece_bytes(model.id_to_piece(i)) for i in range(model.get_piece_size())]
    # the model puts the space before its text itself
    return Side(coder.encode_ordinary, names, "|"), Side(lambda text: model.encode(text[1:]), own, ";")


def cut(text: str) -> list[str]:
    """``text`` with a space before it, in pieces that each lack the space they begin with."""
    return CUT.split(text) if UNEVEN.search(text) else text.split(" ")


class Pieces:
    """Distinct pieces, encoded by both tokenizers and aligned."""

    def __init__(self, texts: list[str], a: Side, b: Side):
        n = len(texts)
        self.sound = np.ones(n, bool)
        sizes = np.fromiter((len(x.encode()) + 1 for x in texts), np.int64, n)
        order, a_ids, b_ids = self._encoded(texts, sizes, a, b)
        ends = np.cumsum(sizes[order])
        a_end, b_end = np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids])
        # groups end where both have an end; every piece ends with one
        at = np.searchsorted(b_end, a_end)
        a_last = np.flatnonzero(b_end[at] == a_end)
        b_last, joint = at[a_last], a_end[a_last]
        self.links_a, self.links_b = a_ids[a_last], b_ids[b_last]
        a_stop, b_stop, group_stop = (np.searchsorted(x, ends, side="right") for x in (a_end, b_end, joint))
        # each token's place in the text of all groups: behind the other side's tokens of groups before
        a_many, b_many = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
        shown = np.empty(len(a_ids) + len(b_ids), object)
        a_at = np.arange(len(a_ids)) + np.repeat(b_last + 1 - b_many, a_many)
        b_at = np.arange(len(b_ids)) + np.repeat(a_last + 1, b_many)
        shown[a_at], shown[b_at] = a.inner[a_ids], b.inner[b_ids]
        shown[a_at[a_last]], shown[b_at[b_last]] = a.last[self.links_a], b.last[self.links_b]
        # an id is as long before a comma as before another mark
        told = np.empty(len(shown), np.int64)
        told[a_at], told[b_at] = a.widths[a_ids], b.widths[b_ids]
        text, stops = "".join(shown.tolist()), np.cumsum(told)[a_stop + b_stop - 1].tolist() if len(order) else []

        def by_piece(stop: np.ndarray) -> np.ndarray:
            out = np.zeros(n, np.int64)
            out[order] = np.diff(stop, prepend=0)
            return out

        self.n_a, self.n_b, self.n_links = by_piece(a_stop), by_piece(b_stop), by_piece(group_stop)
        self.first_link = np.zeros(n, np.int64)
        self.first_link[order] = group_stop - np.diff(group_stop, prepend=0)
        self.groups = [""] * n
        for i, start, stop in zip(order.tolist(), [0, *stops], stops):
            self.groups[i] = text[start:stop - 1]

    def _encoded(self, texts: list[str], sizes: np.ndarray, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces in the order they were encoded in, many at once, and all their tokens."""
        # a piece that ends in white space is the last of its text, so nothing may follow it
        lonely = np.fromiter((not x or x[-1].isspace() for x in texts), bool, len(texts))
        joint = np.flatnonzero(~lonely)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes[joint]) // RUN)) + 1
        runs = [run for run in np.split(joint, cuts) if len(run)] + [np.array([i]) for i in np.flatnonzero(lonely)]
        order, a_ids, b_ids = [], [], []
        while runs:
            again = []
            for run in runs:
                text = " " + " ".join([texts[i] for i in run])
                x, y, data = a.encode(text), b.encode(text), text.encode()
                if b"".join(map(a.tokens.__getitem__, x)) == data == b"".join(map(b.tokens.__getitem__, y)):
                    order.append(run)
                    a_ids.append(np.array(x, np.int64))
                    b_ids.append(np.array(y, np.int64))
                elif len(run) > 1:
                    again += [run[i:i + 1] for i in range(len(run))]
                else:
                    self.sound[run] = False
            runs = again
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *x]) for x in (order, a_ids, b_ids))


def pieces_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """All texts' pieces in order, as numbers: the numbers, where each text's begin, the distinct pieces, and which texts are UTF-8."""
    sound = np.ones(len(texts), bool)
    flow, lengths = [], np.zeros(len(texts), np.int64)
    numbers = Numbers()
    for i, data in enumerate(texts):
        try:
            parts = cut(data.decode()) if data else []
        except UnicodeDecodeError:
            parts, sound[i] = [], False
        flow += map(numbers.__getitem__, parts)
        lengths[i] = len(parts)
    return np.array(flow, np.int64), np.concatenate([[0], np.cumsum(lengths)]), list(numbers), sound


def containers(pair: np.ndarray, place: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (pair, place) rows as one bitmap a pair: its pairs, all bytes, and where each bitmap ends.

    The first byte is 0 before a list of places and 1 before bits.
    """
    which, first, n = np.unique(pair, return_index=True, return_counts=True)
    wide = -(-n_docs // 8)
    dense = 2 * n > wide
    ends = np.cumsum(1 + np.where(dense, wide, 2 * n))
    starts = ends - np.diff(ends, prepend=0)
    data = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    data[starts[dense]] = 1
    listed = ragged(first[~dense], n[~dense])
    at = ragged(starts[~dense] + 1, 2 * n[~dense])
    data[at] = place[listed].astype("<u2").view(np.uint8)
    for i in np.flatnonzero(dense):
        bits = np.zeros(n_docs, bool)
        bits[place[first[i]:first[i] + n[i]]] = True
        data[starts[i] + 1:ends[i]] = np.packbits(bits, bitorder="little")
    return which, data, ends


def members(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in bitmaps that lie one after the other, and how many each bitmap has."""
    starts = ends - np.diff(ends, prepend=0)
    dense = data[starts] == 1
    n = (ends - starts - 1) // 2
    for i in np.flatnonzero(dense):
        n[i] = int(np.bitwise_count(data[starts[i] + 1:ends[i]]).sum())
    out = np.empty(n.sum(), np.int64)
    into = np.cumsum(n) - n
    listed = np.ascontiguousarray(data[ragged(starts[~dense] + 1, 2 * n[~dense])]).view("<u2")
    out[ragged(into[~dense], n[~dense])] = listed
    for i in np.flatnonzero(dense):
        out[into[i]:into[i] + n[i]] = np.flatnonzero(np.unpackbits(data[starts[i] + 1:ends[i]], bitorder="little"))
    return out, n


def postings(pair: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """From one row per link: the pairs, their numbers of documents and of links, and their planes."""
    key = pair * n_docs + doc
    if len(key) and (int(pair.max()) + 1) * n_docs < 1 << 31:
        key = key.astype(np.int32)  # sorted faster
    key.sort()
    fresh = np.flatnonzero(np.diff(key, prepend=-1))
    held, times = key[fresh].astype(np.int64), np.diff(fresh, append=len(key))
    pairs, place = held // n_docs, held % n_docs
    n_planes = int(times.max()).bit_length() if len(times) else 0
    keys, spots = [], []
    for j in range(n_planes):
        has = times >> j & 1 > 0
        keys.append(pairs[has] * 64 + j)
        spots.append(place[has])
    key, spot = np.concatenate([*keys, np.zeros(0, np.int64)]), np.concatenate([*spots, np.zeros(0, np.int64)])
    order = np.lexsort((spot, key))
    which, data, ends = containers(key[order], spot[order], n_docs)
    # the planes between a pair's first and last are all there, so that a plane's place tells its weight
    distinct, first, sizes = np.unique(pairs, return_index=True, return_counts=True)
    links = np.add.reduceat(times, first) if len(first) else times
    top = np.zeros(len(distinct), np.int64)
    owner = np.searchsorted(distinct, which // 64)
    np.maximum.at(top, owner, which % 64)
    at = np.cumsum(top + 1) - (top + 1)
    slot_ends = np.zeros(int((top + 1).sum()), np.int64)
    slot_ends[at[owner] + which % 64] = ends
    slot_ends = np.maximum.accumulate(slot_ends) if len(slot_ends) else slot_ends
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(top + 1)]), pa.int32()), binaries(data, slot_ends))
    return distinct, sizes, links, lists


def index(docs: DataFrame, a_file: bytes, b_file: bytes) -> DataFrame:
    """Blocks of all documents: a row per document (``a`` null) with its facts, and one per block and pair with its planes."""
    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(a_file, b_file)
        for block, keys, texts in text_blocks(batches, BLOCK_DOCS, BLOCK_BYTES):
            flow, starts, distinct, sound = pieces_of(texts)
            pieces = Pieces(distinct, a, b)
            owner = np.repeat(np.arange(len(texts)), np.diff(starts))
            sound[owner[~pieces.sound[flow]]] = False
            digests, bounds, told = [], starts.tolist(), pieces.groups.__getitem__
            for first, end, good in zip(bounds, bounds[1:], sound.tolist()):
                digests.append(sha256(";".join(map(told, flow[first:end].tolist())).encode()).hexdigest() if good and end > first else "")
            kept = sound[owner]
            flow, owner = flow[kept], owner[kept]

            def total(each: np.ndarray) -> pa.Array:
                out = np.zeros(len(texts), np.int64)
                np.add.at(out, owner, each[flow])
                return pa.array(out)

            none, links = pa.nulls, total(pieces.n_links)
            yield pa.record_batch([
                pa.array(np.full(len(texts), block)), pa.array(np.arange(len(texts)), pa.int32()), pa.array(keys, pa.int64()),
                total(pieces.n_a), total(pieces.n_b), links, links, pa.array(digests, pa.string()), none(len(texts), pa.int32()),
                none(len(texts), pa.int32()), none(len(texts), pa.int64()), none(len(texts), pa.int64()), none(len(texts), pa.list_(pa.binary()))], names=NAMES)

            width = len(b.tokens)
            pairs, local = np.unique(pieces.links_a * width + pieces.links_b, return_inverse=True)
            spread = local[ragged(pieces.first_link[flow], pieces.n_links[flow])]
            held, n_docs, n_links, planes = postings(spread, np.repeat(owner, pieces.n_links[flow]), len(texts))
            n = len(held)
            yield pa.record_batch([
                pa.array(np.full(n, block)), none(n, pa.int32()), none(n, pa.int64()), none(n, pa.int64()), none(n, pa.int64()), none(n, pa.int64()),
                none(n, pa.int64()), none(n, pa.string()), pa.array((pairs[held] // width).astype(np.int32)),
                pa.array((pairs[held] % width).astype(np.int32)), pa.array(n_docs.astype(np.int64)), pa.array(n_links.astype(np.int64)), planes],
                names=NAMES)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return staged(rows.mapInArrow(invert, INDEX), "pairs-index")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Every pair that is linked: ``a``, ``b``, its documents, its links, and whether no pair of its ``b`` has more; staged."""
    summed = staged(blocks.filter("a IS NOT NULL").groupBy("a", "b").agg(
        F.sum("pair_docs").alias("n_docs"), F.sum("pair_links").alias("n_links")), "pairs-counts")
    most = summed.groupBy("b").agg(F.max("n_links").alias("_most"))
    return summed.join(most, "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("_most")).alias("best"))


def give_back(table: pa.Table) -> pa.Table:
    """One block's pair rows, with their scores: what each document gathers."""
    lists = table["planes"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    data, ends = flat(lists.flatten())
    plane = np.arange(len(ends)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    there = np.diff(ends, prepend=0) > 0
    places, n = members(data, ends[there])
    weight = np.left_shift(np.int64(1), plane[there])
    score = table["n_links"].to_numpy()[row[there]] * weight
    best = table["best"].to_numpy()[row[there]].astype(np.int64) * weight
    size = int(places.max()) + 1
    count_sum, n_best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(count_sum, places, np.repeat(score, n))
    np.add.at(n_best, places, np.repeat(best, n))
    held = np.flatnonzero(count_sum)
    return pa.table([pa.array(np.full(len(held), table["block"][0].as_py())), pa.array(held, pa.int32()), pa.array(n_best[held]),
                     pa.array(count_sum[held])], names=["block", "place", "n_best", "count_sum"])


def align(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """Per document its tokens, groups and links with what they gather from all documents; and the table of pairs.

    The two vocabulary files are read here and travel with the tasks: their size does not depend on the data.
    """
    blocks = index(docs, Path(a_path).read_bytes(), Path(b_path).read_bytes())
    pairs = pair_counts(blocks)
    held = blocks.filter("a IS NOT NULL").select("block", "a", "b", "planes").join(pairs.select("a", "b", "n_links", "best"), ["a", "b"])
    scored = held.groupBy("block").applyInArrow(give_back, SCORED)
    facts = blocks.filter("a IS NULL").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    nothing = F.lit(0).cast("bigint")
    return facts.join(scored, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", nothing).alias("n_best"),
        F.coalesce("count_sum", nothing).alias("count_sum"), "groups_sha256"), pairs
