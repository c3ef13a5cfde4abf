"""Expected counts of pieces over many distinct words at once, along a trie that the words share.

A node is a prefix, an edge a piece between two prefixes.  The weight that reaches a node is the same for all
words through it and is summed once (forward); how much each node matters to the words below it is the
derivative of their log likelihood, summed once on the way back.  An edge's share of both is the expected count
of its piece.  Edges do not change from round to round: a trie is built once, kept as arrays, and a
round is a few array operations a depth.

Weights are held near 1: each character is scaled by about what it costs (``per_character``), a character in no
piece by exactly what it costs.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import zstandard

_MISSING = object()


def piece_ends(pieces: list[str]) -> dict[str, int | None]:
    """Every end of a piece, with the piece's number if it is one: looking backwards stops where no piece goes on."""
    ends: dict[str, int | None] = {piece[i:]: None for piece in pieces for i in range(1, len(piece))}
    ends.update((piece, i) for i, piece in enumerate(pieces))
    return ends


class Lattice:
    """The trie of some words: edges ``source``, ``target``, ``piece`` by depth of their target.

    ``piece`` is negative for the bytes of a character that is no piece: minus their number.  ``known`` and
    ``unknown`` count, per node, characters in pieces and bytes of others.  ``ends`` is each word's node.
    """

    NAMES = ("source", "target", "piece", "levels", "known", "unknown", "ends", "times")

    def __init__(self, words: list[bytes], **arrays: np.ndarray):
        self.words = words
        for name in self.NAMES:
            setattr(self, name, arrays[name])

    @staticmethod
    def build(texts: list[str], words: list[bytes], times: list[int], ends: dict[str, int | None]) -> Lattice:
        """From sorted texts, whose shared beginnings are one path."""
        source, target, piece, depth, known, unknown, at_end = [], [], [], [0], [0], [0], []
        path, before, nodes, look = [0], "", 1, ends.get
        for text in texts:
            size, shared, most = len(text), 0, min(len(text), len(before))
            while shared < most and text[shared] == before[shared]:
                shared += 1
            del path[shared + 1:]
            for end in range(shared + 1, size + 1):
                start = end - 1
                while start >= 0:
                    value = look(text[start:end], _MISSING)
                    if value is _MISSING:
                        break
                    if value is not None:
                        source.append(path[start])
                        target.append(nodes)
                        piece.append(value)
                    start -= 1
                letter = text[end - 1]
                cost = 0 if letter in ends else len(letter.encode("utf-8", "replace"))
                if look(letter) is None:
                    # in no piece, or in longer ones only
                    source.append(path[end - 1])
                    target.append(nodes)
                    piece.append(-len(letter.encode("utf-8", "replace")))
                known.append(known[path[-1]] + (cost == 0))
                unknown.append(unknown[path[-1]] + cost)
                depth.append(end)
                path.append(nodes)
                nodes += 1
            at_end.append(path[-1])
            before = text
        ints = lambda x: np.array(x, np.int32)
        target, depth = ints(target), ints(depth)
        order = np.argsort(depth[target], kind="stable")
        levels = np.concatenate([[0], np.cumsum(np.bincount(depth[target], minlength=2)[1:])])
        return Lattice(words, source=ints(source)[order], target=target[order], piece=ints(piece)[order], levels=ints(levels),
                       known=ints(known), unknown=ints(unknown), ends=ints(at_end), times=np.array(times, np.int64))

    def pack(self) -> bytes:
        out = io.BytesIO()
        # neighbouring nodes have neighbouring numbers, so differences are small
        np.savez(out, **{n: np.diff(getattr(self, n), prepend=0).astype(getattr(self, n).dtype) if n in ("target", "source") else getattr(self, n)
                         for n in self.NAMES}, words=np.frombuffer(b"\n".join(self.words), np.uint8))
        return zstandard.ZstdCompressor(level=1).compress(out.getvalue())

    @staticmethod
    def unpack(data: bytes) -> Lattice:
        held = np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(data)))
        arrays = {n: held[n] for n in Lattice.NAMES}
        for n in ("target", "source"):
            arrays[n] = np.cumsum(arrays[n], dtype=np.int32)
        return Lattice(held["words"].tobytes().split(b"\n"), **arrays)

    def expect(self, scores: np.ndarray, unknown: float, per_character: float) -> tuple[np.ndarray, float, list[tuple[bytes, int]]]:
        """Expected count per piece, log likelihood, and the words whose weight left the range of doubles (in neither)."""
        scale = self.known * per_character - self.unknown * unknown
        plain = self.piece >= 0
        value = np.where(plain, scores[np.maximum(self.piece, 0)], -self.piece * unknown)
        with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
            weight = np.exp(value + scale[self.target] - scale[self.source])
            ahead = np.zeros(len(scale))
            ahead[0] = 1.0
            spans = list(zip(self.levels[:-1].tolist(), self.levels[1:].tolist()))
            for a, b in spans:
                np.add.at(ahead, self.target[a:b], ahead[self.source[a:b]] * weight[a:b])
            reached = ahead[self.ends]
            good = np.isfinite(reached) & (reached > 1e-280) & (reached < 1e280)
            times = np.where(good, self.times, 0)
            back = np.zeros(len(scale))
            np.add.at(back, self.ends, np.where(good, times / reached, 0.0))
            flow = np.zeros(len(weight))
            for a, b in reversed(spans):
                passed = back[self.target[a:b]] * weight[a:b]
                np.add.at(back, self.source[a:b], passed)
                flow[a:b] = ahead[self.source[a:b]] * passed
            flow = np.where(np.isfinite(flow), flow, 0.0)
            counts = np.bincount(self.piece[plain], flow[plain], len(scores))
            fit = float((times * np.where(good, np.log(reached) - scale[self.ends], 0.0)).sum())
        lost = [(self.words[i], int(self.times[i])) for i in np.flatnonzero(~good)]
        return counts, fit, lost


def chunks(rows: Iterator[tuple[bytes, int]], most: int, size: int) -> Iterator[list[tuple[bytes, int]]]:
    """Rows in lists of at most ``most`` words and about ``size`` bytes."""
    held, length = [], 0
    for row in rows:
        held.append(row)
        length += len(row[0])
        if len(held) == most or length > size:
            yield held
            held, length = [], 0
    if held:
        yield held
