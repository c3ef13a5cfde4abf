"""Texts in blocks: consecutive rows of one task, bounded in number and size, that are worked on together.

Where a block begins and ends depends on the task alone; results never do, since what tells
blocks apart is only used to bring a block's own rows together again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from inkledger.llm.words import as_bytes

#: Places inside a block are 16-bit numbers.
MOST_DOCS = 1 << 16


def text_blocks(batches: Iterator[pa.RecordBatch], docs: int, size: int) -> Iterator[tuple[int, list, list[bytes]]]:
    """(block, keys, texts) of the batches' columns key and text; null texts are empty.

    A block ends at ``docs`` rows or before ``size`` bytes of text are exceeded; a longer text is a
    block of its own.  Block numbers are unique within one run of the job: stage what carries them.
    """
    assert docs <= MOST_DOCS
    number = TaskContext.get().partitionId() << 32
    keys: list = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            if texts and (len(texts) == docs or held + len(text) > size):
                yield number, keys, texts
                number, keys, texts, held = number + 1, [], [], 0
            keys.append(key)
            texts.append(text)
            held += len(text)
    if texts:
        yield number, keys, texts


class Numbers(dict):
    """Numbers things 0, 1, 2, ... in the order they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of slices ``starts[i] : starts[i] + lengths[i]``, one slice after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column whose values lie one after the other in ``data`` and end at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and the end of each value in them."""
    joined = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    _, offsets, data = joined.buffers()
    if not len(joined):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    ends = np.frombuffer(offsets, np.int64)[joined.offset:joined.offset + len(joined) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0]:ends[-1]], ends[1:] - ends[0]
