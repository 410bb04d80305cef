"""Blocks of documents and a compact exchange of fingerprints, for operators on repeated passages.

Documents are packed into blocks of about a megabyte that the tasks handle as arrays. A block sends fingerprints with their
places, one small binary row for each partition of the fingerprint space; a partition decides about all places
with equal fingerprints and answers each block with the places that it has decided about. Equal fingerprints of a block are
folded before they are sent, so that a partition gets at most one of each from a block, however often a text repeats.

Places are ordered by document id (rows without an id first), then by text where rows repeat an id, then by offset.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, materialise, shuffle_parts

BLOCK_BYTES = 1 << 20
NO_ID = np.iinfo(np.int64).min

_U = np.uint64
_rng = np.random.default_rng(20240229)
#: Byte values and odd multipliers of two independent polynomial hashes modulo 2^64.
_TABLES = _rng.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_BASES = [int(x) | 1 for x in _rng.integers(1 << 62, 1 << 63, 2, dtype=np.uint64)]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit over all others."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a multiplier and of its inverse, at least ``n`` of them."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        base = _BASES[which]
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _POWERS[which] = (both[0], both[1])
    up, down = _POWERS[which]
    return up[:n], down[:n]


class Hashes:
    """Hash of any stretch of an array of bytes in constant time, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = _powers(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[which][data] * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Block:
    number: int
    ids: np.ndarray  # int64, sorted; NO_ID for none
    ties: np.ndarray  # int64, order of rows that repeat an id
    ends: np.ndarray  # end of each document in the data
    data: np.ndarray  # bytes of all documents, one after the other

    @property
    def starts(self) -> np.ndarray:
        return np.r_[0, self.ends[:-1]]

    def owners(self, at: np.ndarray) -> np.ndarray:
        """Document number of each place in the data."""
        return np.searchsorted(self.ends, at, side="right")


def pack(docs: DataFrame, id_column: str, text_column: str, prepare: Callable[[bytes], bytes] = bytes) -> DataFrame:
    """Written table of blocks of the documents' prepared texts, compressed. Null texts are empty; ids are integers.

    No shuffle. Only where some id occurs twice, which one count of the ids finds out, the order of such rows is taken
    from a hash of their texts.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    repeated = rows.where("id is not null").groupBy("id").count().where("count > 1").limit(1).count() > 0
    repeated = repeated or rows.where("id is null").limit(2).count() > 1
    rows = rows.withColumn("tie", F.xxhash64("text") if repeated else F.lit(0).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() << 32) - 1
        packer = zstandard.ZstdCompressor(level=1)
        held, size = [], 0

        def close() -> pa.RecordBatch:
            nonlocal held, size, number
            held.sort(key=lambda r: r[:2])
            number += 1
            data = b"".join(r[2] for r in held)
            column = lambda values: pa.array([np.array(values, "<i8").tobytes()], pa.binary())
            made = pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(data)]), column([r[0] for r in held]), column([r[1] for r in held]), column([len(r[2]) for r in held]), pa.array([packer.compress(data)])],
                names=["block", "n_bytes", "ids", "ties", "sizes", "data"],
            )
            held, size = [], 0
            return made

        for batch in batches:
            ids, ties = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for id_, tie, text in zip(ids, ties, as_bytes(batch.column(1)), strict=True):
                text = prepare(text)
                held.append((NO_ID if id_ is None else id_, tie, text))
                size += len(text) + 64
                if size >= BLOCK_BYTES:
                    yield close()
        if held:
            yield close()

    return materialise(rows.mapInArrow(run, "block long, n_bytes long, ids binary, ties binary, sizes binary, data binary"), "blocks")


def _block(batch: pa.RecordBatch, row: int) -> Block:
    number, _, ids, ties, sizes, data = (batch.column(k)[row].as_py() for k in range(6))
    raw = zstandard.ZstdDecompressor().decompress(data)
    ends = np.cumsum(np.frombuffer(sizes, "<i8"))
    return Block(number, np.frombuffer(ids, "<i8"), np.frombuffer(ties, "<i8"), ends, np.frombuffer(raw, np.uint8))


def parts_for(blocks: DataFrame) -> int:
    """Partitions of the fingerprint space: the session's shuffle partitions, more for large corpora."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return shuffle_parts(blocks.sparkSession, total)


Fields = dict[str, np.ndarray]
#: reply rounds of a block: for each round, partition -> (entry numbers, states)
Replies = list[dict[int, tuple[np.ndarray, np.ndarray]]]


def spread(part: np.ndarray, n_parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Numbers of the entries of each partition that has any, in their order."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(n_parts + 1))
    for p in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        yield p, order[cuts[p] : cuts[p + 1]]


def _replies(batch: pa.RecordBatch, row: int, rounds: int) -> Replies:
    out: Replies = []
    for k in range(rounds):
        found = batch.column(6 + k)[row].as_py() or []
        out.append({r["part"]: (np.frombuffer(r["at"], "<i4"), np.frombuffer(r["state"], np.uint8)) for r in found})
    return out


def states(entries_part: np.ndarray, n_parts: int, replies: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """State of each entry as answered; 0 where a partition had nothing to say."""
    state = np.zeros(len(entries_part), np.uint8)
    for p, at in spread(entries_part, n_parts):
        if p in replies:
            numbers, said = replies[p]
            state[at[numbers]] = said
    return state


def joined(blocks: DataFrame, rounds: list[DataFrame], how: str = "left") -> DataFrame:
    """Blocks with the replies that each has got, one column for each round."""
    out = blocks
    for k, replies in enumerate(rounds):
        got = replies.groupBy("block").agg(F.collect_list(F.struct("part", "at", "state")).alias(f"r{k}"))
        out = out.join(got, "block", how)
    return out.select("block", "n_bytes", "ids", "ties", "sizes", "data", *[f"r{k}" for k in range(len(rounds))])


def ask(
    blocks: DataFrame, rounds: list[DataFrame], n_parts: int, fields: dict[str, str],
    send: Callable[[Block, Replies], tuple[np.ndarray, Fields]], decide: Callable[[Fields, np.ndarray], np.ndarray], how: str = "inner",
) -> DataFrame:
    """One exchange; a written table of the replies (``block``, ``part``, ``at``, ``state``).

    ``send`` gives a block's entries as (partition of each, fields); ``decide`` gives the state of each of a partition's entries,
    0 for none, from their fields and block numbers. A partition's entries are bounded by the corpus divided by ``n_parts``.
    """
    n_rounds, names = len(rounds), list(fields)

    def out_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = _block(batch, row)
                part, values = send(block, _replies(batch, row, n_rounds))
                rows = [(p, *(values[f][at].astype(fields[f]).tobytes() for f in names)) for p, at in spread(part, n_parts)]
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], pa.int32()), pa.array([block.number] * len(rows)), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["part", "block", *names]
                    )

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if whole is None or not whole.num_rows:
            return
        got = {f: [np.frombuffer(x, fields[f]) for x in whole.column(f).to_pylist()] for f in names}
        sizes = np.array([len(x) for x in got[names[0]]])
        numbers = np.array(whole.column("block").to_pylist())
        parts = whole.column("part").to_pylist()
        state = decide({f: np.concatenate(x) for f, x in got.items()}, np.repeat(numbers, sizes))
        rows = []
        for k, end in enumerate(np.cumsum(sizes).tolist()):
            own = state[end - sizes[k] : end]
            at = np.flatnonzero(own)
            if len(at):
                rows.append((int(numbers[k]), parts[k], at.astype("<i4").tobytes(), own[at].tobytes()))
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())], names=["block", "part", "at", "state"]
            )

    kind = "part int, block long, " + ", ".join(f"{f} binary" for f in names)
    sent = joined(blocks, rounds, how).mapInArrow(out_of, kind).repartitionById(n_parts, F.col("part"))
    return materialise(sent.mapInArrow(reduce, "block long, part int, at binary, state binary"), "replies")


def answer(blocks: DataFrame, rounds: list[DataFrame], finish: Callable[[Block, Replies], pa.RecordBatch], schema: str) -> DataFrame:
    """Rows that ``finish`` makes of every block with its replies."""
    n_rounds = len(rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield finish(_block(batch, row), _replies(batch, row, n_rounds))

    return joined(blocks, rounds).mapInArrow(run, schema)


def first_in_order(keys: list[np.ndarray]) -> np.ndarray:
    """Whether each entry is the first in order among those with equal keys."""
    order = np.lexsort(keys[::-1])
    fresh = np.ones(len(order), bool)
    if len(order):
        same = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
        fresh[1:] = ~same
    out = np.zeros(len(order), bool)
    out[order[fresh]] = True
    return out


def earliest(keys: list[np.ndarray], fields: Fields, numbers: np.ndarray) -> np.ndarray:
    """Whether each entry is the earliest place among those with equal keys; places are id, tie, block, offset."""
    order = np.lexsort([fields["off"], numbers, fields["tie"], fields["doc"], *keys[::-1]])
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = ~np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
    out = np.zeros(len(order), bool)
    out[order[fresh]] = True
    return out


def window_round(starts: np.ndarray, ends: np.ndarray, block: Block, n_parts: int) -> tuple[np.ndarray, np.ndarray, Fields]:
    """Entries for given windows of a block: whether each window is its block's first, partition and fields of those that are."""
    h, g = Hashes(block.data).of(starts, ends), Hashes(block.data, 1).of(starts, ends)
    first = first_in_order([h, g])
    owner = block.owners(starts[first])
    fields = {"h": h[first], "g": g[first] >> _U(32), "doc": block.ids[owner], "tie": block.ties[owner], "off": starts[first] - block.starts[owner]}
    return first, ((h[first] >> _U(32)) % _U(n_parts)).astype(np.int64), fields


WINDOW_FIELDS = {"h": "<u8", "g": "<u4", "doc": "<i8", "tie": "<i8", "off": "<i4"}


def later_windows(fields: Fields, numbers: np.ndarray) -> np.ndarray:
    """State 1 for windows that also start at an earlier place."""
    return (~earliest([fields["h"], fields["g"]], fields, numbers)).astype(np.uint8)
