"""Removal of repeated byte strings by prefix-free parsing.

Triggers cut the corpus into phrases: a place is a trigger if the rolling hash of the eight bytes there is the least
in some stretch, so that triggers depend on the content around them only, equal texts are cut alike, and every string of the asked
length holds a trigger with the bytes that follow it. A phrase is the run of starting places whose strings share their
first trigger; its text, with the bytes that the last of these strings needs beyond the phrase, is an entry of the
dictionary, and the phrases of a document in order are its parse.

Order in the corpus is found in two steps, as suffixes of dictionary and parse combine. First whole entries: those with the same
text at and after the trigger meet, the earliest of equal entries represents it, and all strings that start in another copy
repeat an earlier one. Highly repetitive text collapses here, phrase by phrase. Second the suffixes of the distinct
entries that share a trigger with a different entry: their strings of the asked length meet and the earliest place stays.
Where a suffix array would compare ranks, suffixes are compared up to the asked length by 128 or 96 bits of hash: the result asks
which suffixes are equal up to that length, not which is smaller.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as bl
from .blocks import Block, Fields, Replies

_U = np.uint64
GRAM = 8


def triggers(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of a block's documents: first and last starting place, and the trigger they share."""
    n, reach = len(data), width - width // 4 + 1
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none
    sizes = np.diff(np.r_[0, ends])
    starts = np.flatnonzero(np.repeat(ends, sizes) - np.arange(n) >= width)
    if not len(starts):
        return none, none, none
    word = data.astype(np.uint64)
    for shift in (1, 2, 4):
        word = word[:-shift] | word[shift:] << _U(8 * shift)
    # hash in the upper half, place in the lower: the least is the leftmost of the least hashes
    least = (bl.mix(word) & _U(0xFFFFFFFF00000000)) | np.arange(len(word), dtype=np.uint64)
    size = 1
    while 2 * size <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach:
        least = np.minimum(least[: len(least) - (reach - size)], least[reach - size :])
    at = (least[starts] & _U(0xFFFFFFFF)).astype(np.int64)
    lead = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[lead[1:], len(at)] - 1
    return starts[lead], starts[last], at[lead]


class _Parse:
    """Dictionary entries of a block: fingerprints, and which is the first of equal ones in the block."""

    def __init__(self, block: Block, width: int, n_parts: int):
        self.first, self.last, self.at = triggers(block.data, block.ends, width)
        hashes = bl.Hashes(block.data)
        self.key = hashes.of(self.at, self.at + width // 4)
        place = (self.at - self.first).astype(np.uint64) * _U(0x9E3779B97F4A7C15)
        self.text = bl.mix(hashes.of(self.first, self.last + width) + place)
        self.fresh = bl.first_in_order([self.key, self.text])
        self.entries = np.flatnonzero(self.fresh)
        self.part = ((self.key[self.entries] >> _U(32)) % _U(n_parts)).astype(np.int64)

    def open_places(self, state: np.ndarray) -> np.ndarray:
        """Starting places of the entries that a different entry shares its trigger with."""
        chosen = self.entries[state == 2]
        sizes = self.last[chosen] - self.first[chosen] + 1
        return np.repeat(self.first[chosen] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _decide_entries(fields: Fields, numbers: np.ndarray) -> np.ndarray:
    """1 for an entry that repeats an earlier one, 2 for the earliest of its text if its trigger has other texts too."""
    key, text = fields["key"], fields["text"]
    first = bl.earliest([key, text], fields, numbers)
    distinct, texts = np.unique(key[first], return_counts=True)
    shared = texts[np.searchsorted(distinct, key)] > 1
    return np.where(first, np.where(shared, 2, 0), 1).astype(np.uint8)


def drop_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 100) -> DataFrame:
    """Per row: ``id``, ``n_bytes``, ``kept`` (bytes) and the removed stretches ``span_starts``, ``span_ends`` (bytes).

    Every byte is removed that a string of ``width`` bytes covers which also starts at an earlier place: in a row with a smaller
    id, or earlier in the same document; strings are judged on the input. Rows that repeat an id are ordered by a hash of
    their texts, equal rows among themselves in any order; rows without an id come first. Null and empty texts, and
    texts shorter than ``width``, lose nothing. Bytes are removed singly, so ``kept`` may cut a character. An empty table gives no
    rows. ``width`` is at least 32.
    """
    if width < 32:
        raise ValueError("strings of at least 32 bytes")
    packed = bl.pack(docs, id_column, text_column)
    n_parts = bl.parts_for(packed)

    def entries(block: Block, _: Replies) -> tuple[np.ndarray, Fields]:
        parse = _Parse(block, width, n_parts)
        first = parse.first[parse.entries]
        owner = block.owners(first)
        fields = {"key": parse.key[parse.entries], "text": parse.text[parse.entries]}
        return parse.part, fields | {"doc": block.ids[owner], "tie": block.ties[owner], "off": first - block.starts[owner]}

    kinds = {"key": "<u8", "text": "<u8", "doc": "<i8", "tie": "<i8", "off": "<i4"}
    said = bl.ask(packed, [], n_parts, kinds, entries, _decide_entries)

    def suffixes(block: Block, replies: Replies) -> tuple[np.ndarray, Fields]:
        parse = _Parse(block, width, n_parts)
        places = parse.open_places(bl.states(parse.part, n_parts, replies[0]))
        _, part, fields = bl.window_round(places, places + width, block, n_parts)
        return part, fields

    again = bl.ask(packed, [said], n_parts, bl.WINDOW_FIELDS, suffixes, bl.later_windows)

    def finish(block: Block, replies: Replies) -> pa.RecordBatch:
        parse = _Parse(block, width, n_parts)
        state = bl.states(parse.part, n_parts, replies[0])
        repeat = ~parse.fresh
        repeat[parse.entries[state == 1]] = True
        delta = np.zeros(len(block.data) + width + 1, np.int64)
        np.add.at(delta, parse.first[repeat], 1)
        np.add.at(delta, parse.last[repeat] + width, -1)
        places = parse.open_places(state)
        if len(places):
            first, part, _ = bl.window_round(places, places + width, block, n_parts)
            late = ~first
            late[np.flatnonzero(first)[bl.states(part, n_parts, replies[1]) == 1]] = True
            np.add.at(delta, places[late], 1)
            np.add.at(delta, places[late] + width, -1)
        return _rows(block, np.cumsum(delta[: len(block.data)]) > 0)

    return bl.answer(packed, [said, again], finish, "id long, n_bytes long, kept binary, span_starts array<long>, span_ends array<long>")


def _rows(block: Block, gone: np.ndarray) -> pa.RecordBatch:
    opens = np.r_[gone[:1], gone[1:] & ~gone[:-1]] if len(gone) else gone
    opens[block.starts[block.starts < len(gone)]] = gone[block.starts[block.starts < len(gone)]]  # a document ends a stretch
    closes = np.r_[gone[:-1] & ~gone[1:], gone[-1:]] if len(gone) else gone
    last = block.ends[block.ends > 0] - 1
    closes[last] = gone[last]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    kept, starts, ends = [], [], []
    where = np.searchsorted(begin, np.r_[block.starts, len(gone)])
    for k, (a, b) in enumerate(zip(block.starts.tolist(), block.ends.tolist(), strict=True)):
        own = slice(where[k], where[k + 1])
        kept.append(block.data[a:b][~gone[a:b]].tobytes() if where[k + 1] > where[k] else block.data[a:b].tobytes())
        starts.append(begin[own] - a)
        ends.append(end[own] - a)
    ids = pa.array(block.ids, mask=block.ids == bl.NO_ID)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(np.r_[0, block.ends])), pa.array(kept, pa.binary()), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
        names=["id", "n_bytes", "kept", "span_starts", "span_ends"],
    )
