"""Removal of repeated word windows with fixed-block anchors.

Every document is cut into reference blocks of half a window, one after the other without overlap; their hashes are the
index. Every rolling window of that many words, in all documents, probes the index. Whichever way two equal windows of the
full width lie, one of them holds a whole reference block of its document, and the other the same words at the same
distance from its start, so the probes at both places hit. Around each hit the text is extended to the repeat: the windows of full width
that hold the hit are compared with each other, and the earliest place of each stays. Runs of neighbouring
repeats make up the maximal exact repeats.

Probes go out as four bytes each, beside the partition they fall into: a chance hit only costs a comparison.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as bl
from .blocks import Block, Fields, Replies

_U = np.uint64
SPACE = 32


def spaced(text: bytes) -> bytes:
    """Words (runs of other bytes than space and \\x09-\\x0D) joined by one space."""
    return b" ".join(text.split())


class _Words:
    """Words of a block: first byte and end of each, document, and number within the document."""

    def __init__(self, block: Block):
        is_space = block.data == SPACE
        lead = np.r_[True, is_space[:-1]] if len(block.data) else np.zeros(0, bool)
        starts = block.starts
        lead[starts[starts < len(block.data)]] = True
        lead &= ~is_space
        self.starts = np.flatnonzero(lead)
        self.owner = block.owners(self.starts)
        self.counts = np.bincount(self.owner, minlength=len(block.ids))
        ends = np.r_[self.starts[1:] - 1, 0]
        last = np.flatnonzero(np.r_[self.owner[1:] != self.owner[:-1], True]) if len(self.starts) else np.zeros(0, np.int64)
        if len(last):
            ends[last] = block.ends[self.owner[last]]
        self.ends = ends[: len(self.starts)]
        self.first = (np.cumsum(self.counts) - self.counts)[self.owner]  # first word of the document
        self.number = np.arange(len(self.starts)) - self.first
        self.left = self.counts[self.owner] - self.number  # words from here to the document's end

    def windows(self, width: int) -> np.ndarray:
        """Words at which a window of ``width`` words of one document begins."""
        return np.flatnonzero(self.left >= width)


class _Probes:
    """Distinct keys of a block's rolling windows: how often each occurs, and whether at a reference block."""

    def __init__(self, block: Block, words: _Words, size: int, n_parts: int):
        self.at = words.windows(size)
        h = bl.Hashes(block.data).of(words.starts[self.at], words.ends[self.at + size - 1])
        part, short = (h >> _U(32)) % _U(n_parts), h & _U(0xFFFFFFFF)
        whole = part << _U(32) | short
        whole, self.entry = np.unique(whole, return_inverse=True)
        self.part, self.key = (whole >> _U(32)).astype(np.int64), whole & _U(0xFFFFFFFF)
        fixed = words.number[self.at] % size == 0
        n = len(whole)
        times = np.minimum(np.bincount(self.entry, minlength=n), 2)
        # bit 0: a reference block; bit 1: more than one place
        self.mark = (np.bincount(self.entry[fixed], minlength=n) > 0) | (times > 1) << 1


def _decide_hits(fields: Fields, _numbers: np.ndarray) -> np.ndarray:
    """1 for keys that occur at two places or more, one of them a reference block."""
    key, mark = fields["key"], fields["mark"]
    distinct, at = np.unique(key, return_inverse=True)
    fixed = np.bincount(at, mark & 1, len(distinct)) > 0
    places = np.bincount(at, 1 + (mark >> 1), len(distinct))
    return (fixed & (places > 1))[at].astype(np.uint8)


def _open_windows(words: _Words, probes: _Probes, state: np.ndarray, size: int, width: int) -> np.ndarray:
    """Words at which the windows of full width begin that hold a hit."""
    n = len(words.starts)
    hit = probes.at[state[probes.entry] == 1]
    delta = np.zeros(n + 2, np.int64)
    np.add.at(delta, np.maximum(hit - (width - size), words.first[hit]), 1)
    np.add.at(delta, hit + 1, -1)
    return np.flatnonzero((np.cumsum(delta[:n]) > 0) & (words.left >= width))


def drop_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 20) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_removed`` and ``kept`` (the other words joined by one space, as bytes).

    Every word is removed that a window of ``width`` words covers whose words also start at an earlier place: in a row with a
    smaller id, or earlier in the same document; windows are judged on the input. Rows that repeat an id are ordered by a hash
    of their texts, equal rows among themselves in any order; rows without an id come first. Null and blank texts have no words, texts
    shorter than ``width`` lose none. An empty table gives no rows. ``width`` is even, or its last word is left out of the blocks.
    """
    size = width // 2
    if size < 1:
        raise ValueError("windows of at least two words")
    packed = bl.pack(docs, id_column, text_column, spaced)
    n_parts = bl.parts_for(packed)

    def probe(block: Block, _: Replies) -> tuple[np.ndarray, Fields]:
        found = _Probes(block, _Words(block), size, n_parts)
        return found.part, {"key": found.key, "mark": found.mark}

    hits = bl.ask(packed, [], n_parts, {"key": "<u4", "mark": "u1"}, probe, _decide_hits)

    def places(block: Block, replies: Replies) -> tuple[_Words, np.ndarray]:
        words = _Words(block)
        if not replies[0]:
            return words, np.zeros(0, np.int64)
        probes = _Probes(block, words, size, n_parts)
        return words, _open_windows(words, probes, bl.states(probes.part, n_parts, replies[0]), size, width)

    def extend(block: Block, replies: Replies) -> tuple[np.ndarray, Fields]:
        words, at = places(block, replies)
        _, part, fields = bl.window_round(words.starts[at], words.ends[at + width - 1], block, n_parts)
        return part, fields

    later = bl.ask(packed, [hits], n_parts, bl.WINDOW_FIELDS, extend, bl.later_windows)

    def finish(block: Block, replies: Replies) -> pa.RecordBatch:
        words, at = places(block, replies)
        gone = np.zeros(len(words.starts), bool)
        if len(at):
            first, part, _ = bl.window_round(words.starts[at], words.ends[at + width - 1], block, n_parts)
            late = ~first
            late[np.flatnonzero(first)[bl.states(part, n_parts, replies[1]) == 1]] = True
            delta = np.zeros(len(gone) + width + 1, np.int64)
            np.add.at(delta, at[late], 1)
            np.add.at(delta, at[late] + width, -1)
            gone = np.cumsum(delta[: len(gone)]) > 0
        removed = np.bincount(words.owner[gone], minlength=len(block.ids))
        raw, kept, begin = block.data.tobytes(), [], np.cumsum(words.counts) - words.counts
        for k, (a, b) in enumerate(zip(block.starts.tolist(), block.ends.tolist(), strict=True)):
            if removed[k]:
                own = begin[k] + np.flatnonzero(~gone[begin[k] : begin[k] + words.counts[k]])
                kept.append(b" ".join([raw[s:e] for s, e in zip(words.starts[own].tolist(), words.ends[own].tolist(), strict=True)]))
            else:
                kept.append(raw[a:b])
        ids = pa.array(block.ids, mask=block.ids == bl.NO_ID)
        return pa.RecordBatch.from_arrays([ids, pa.array(words.counts), pa.array(removed), pa.array(kept, pa.binary())], names=["id", "n_words", "n_removed", "kept"])

    return bl.answer(packed, [hits, later], finish, "id long, n_words long, n_removed long, kept binary")
