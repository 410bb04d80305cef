"""Periodic runs of words by recompression: a run-length grammar answers extensions of harmonic-grid candidates.

``Grammar`` compresses a sequence in alternate rounds until little is left: block compression names every maximal repeat of one
symbol, pair compression every neighbouring pair whose first symbol is in the left half of the alphabet and whose second is in the
right half. Equal names of a level stand for equal stretches, and whether a name ends between two symbols follows from these two symbols
alone; so two positions are compared by stepping up the levels while both are at the start of a name, and down again
from the first names that differ, with a bounded number of steps on a level.

A run of period q and length 4 q or more covers four places in a row of the grid 0, q, 2 q, ... So the candidates are the places of
each grid with four equal words in a row, one of every three where more than four are in line; over all periods they are harmonic in number. Both
extensions of a candidate are exact common extensions of two positions, forward in the grammar and backward in
that of the reversed sequence.

Documents are handled in batches, set apart by symbols that occur once, so that no run crosses from one into the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import mix
from .common import as_bytes, narrow

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Words that are searched together; a longer document is searched alone.
BATCH_WORDS = 1 << 18
#: A grammar is not compressed below this many symbols.
TOP = 32


@dataclass
class Level:
    symbols: np.ndarray
    ahead: np.ndarray  # equal symbols from here to the end of their block
    first: np.ndarray | None = None  # whether a symbol is the first of a name of the next level
    up: np.ndarray | None = None  # the name of the next level that holds it
    down: np.ndarray | None = None  # first symbol of each name of the next level


class Grammar:
    """Run-length grammar of symbols from 0, the last of which occurs nowhere else."""

    def __init__(self, symbols: np.ndarray):
        now, fresh, turn = symbols.astype(np.int64), int(symbols.max(initial=0)) + 1, 0
        self.levels: list[Level] = []
        while len(now) > TOP:
            blocks = turn % 2 == 0
            first, ahead = self._blocks(now) if blocks else self._pairs(now, turn)
            down = np.flatnonzero(first)
            self.levels.append(Level(now, ahead, first, np.cumsum(first) - 1, down))
            width = np.diff(np.r_[down, len(now)])
            many = width > 1
            if blocks:
                key = now[down[many]] * (len(now) + 1) + width[many]
            else:
                key = now[down[many]] * fresh + now[down[many] + 1]
            names, which = np.unique(key, return_inverse=True)
            now = now[down]
            now[many] = fresh + which
            fresh += len(names)
            turn += 1
        self.levels.append(Level(now, self._blocks(now)[1] if len(now) else now))

    @staticmethod
    def _blocks(now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.ones(len(now), bool)
        first[1:] = now[1:] != now[:-1]
        at = np.flatnonzero(first)
        return first, np.repeat(np.r_[at[1:], len(now)], np.diff(np.r_[at, len(now)])) - np.arange(len(now))

    @staticmethod
    def _pairs(now: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        left = (mix(now.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1)).astype(bool)
        one, other = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        first = np.ones(len(now), bool)
        first[1:] = ~(one if one.sum() >= other.sum() else other)
        return first, np.ones(len(now), np.int64)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal symbols from places ``a`` and ``b`` on, for arrays with a != b everywhere."""
        a, b, begin = a.copy(), b.copy(), a
        highest = np.full(len(a), len(self.levels) - 1)
        going = np.arange(len(a))
        for k, level in enumerate(self.levels[:-1]):
            open_ = going
            while len(open_):  # up to the next name, or to a difference
                x, y = a[open_], b[open_]
                open_ = open_[~(level.first[x] & level.first[y])]
                differ = self._step(level, a, b, open_)
                highest[open_[differ]] = k
                open_ = open_[~differ]
            going = going[highest[going] != k]
            a[going], b[going] = level.up[a[going]], level.up[b[going]]
        for k in range(len(self.levels) - 1, -1, -1):
            level, open_ = self.levels[k], np.flatnonzero(highest >= k)
            below = open_[highest[open_] > k]
            if k < len(self.levels) - 1:
                a[below], b[below] = level.down[a[below]], level.down[b[below]]
            while len(open_):
                open_ = open_[~self._step(level, a, b, open_)]
        return a - begin

    @staticmethod
    def _step(level: Level, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Move the pairs numbered ``at`` over the symbols that they share next; whether there were none."""
        x, y = a[at], b[at]
        differ = level.symbols[x] != level.symbols[y]
        by = np.where(differ, 0, np.minimum(level.ahead[x], level.ahead[y]))
        a[at], b[at] = x + by, y + by
        return differ


def candidates(symbols: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of the grids: place and place + period hold equal symbols, and so do two more steps before them.

    The documents lie in falling order of their ``sizes``, so that those long enough for a period are a prefix.
    """
    places, periods = [], []
    longest = int(sizes[0]) if len(sizes) else 0
    reach = np.searchsorted(-sizes, -MIN_EXPONENT * np.arange(1, longest // MIN_EXPONENT + 1), side="right")
    ends = (starts + sizes)[reach - 1] if len(reach) else []
    for q, end in enumerate(ends, 1):
        grid = symbols[:end:q]
        same = grid[1:] == grid[:-1]
        row = same[:-2] & same[1:-1] & same[2:]
        if row.any():
            at = np.flatnonzero(row)
            fresh = np.ones(len(at), bool)
            fresh[1:] = np.diff(at) != 1
            since = at - at[fresh][np.cumsum(fresh) - 1]
            places.append((at[since % 3 == 0] + 2) * q)
            periods.append(np.full(len(places[-1]), q))
    none = np.zeros(0, np.int64)
    return (np.concatenate(places), np.concatenate(periods)) if places else (none, none)


def find_runs(documents: list[np.ndarray], min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of arrays of symbols: document, start, length and smallest period, by document, start and period."""
    order = sorted(range(len(documents)), key=lambda k: -len(documents[k]))
    sizes = np.array([len(documents[k]) for k in order], np.int64)
    starts = np.cumsum(np.r_[1, sizes + 1])[:-1]
    own = 1 + max((int(d.max()) for d in documents if len(d)), default=0)
    parts = [np.array([own])]
    for k, number in enumerate(order):
        parts += [documents[number], np.array([own + 1 + k])]
    symbols = np.concatenate(parts).astype(np.int64)
    place, q = candidates(symbols, sizes, starts)
    none = np.zeros(0, np.int64)
    if not len(place):
        return none, none, none, none
    n = len(symbols)
    after = Grammar(symbols).common(place, place + q)
    before = Grammar(symbols[::-1]).common(n - place, n - place - q)
    begin, end = place - before, place + q + after
    long = end - begin >= np.maximum(min_length, MIN_EXPONENT * q)
    begin, end, q = begin[long], end[long], q[long]
    # a stretch is found with multiples of its period too; the least is its own
    by = np.lexsort((q, end, begin))
    begin, end, q = begin[by], end[by], q[by]
    least = np.ones(len(begin), bool)
    least[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end, q = begin[least], end[least], q[least]
    owner = np.searchsorted(starts, begin, side="right") - 1
    found = np.array(order, np.int64)[owner], begin - starts[owner], end - begin, q
    by = np.lexsort((found[3], found[1], found[0]))
    return found[0][by], found[1][by], found[2][by], found[3][by]


def _numbered(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Words as numbers, equal for equal words."""
    codes: dict[bytes, int] = {}
    for words in texts:
        codes.update(zip((fresh := [w for w in dict.fromkeys(words) if w not in codes]), range(len(codes), len(codes) + len(fresh)), strict=True))
    return [np.fromiter(map(codes.__getitem__, words), np.int64, len(words)) for words in texts]


def _batches(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        words = text.split()  # bytes: exactly the separators \\x20 \\x09-\\x0D
        if held and size + len(words) > BATCH_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def collapse(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """Columns ``id_column``, ``n_words``, ``runs`` and ``collapsed`` for every row of ``docs``.

    ``runs`` are the maximal periodic stretches of words, an array of (start, length, period) by start, then period: the words a
    period apart are equal, the period is the smallest, the length is at least ``min_length`` and four periods, and no neighbouring word
    continues it. ``collapsed`` are the words that no run holds after its first period, joined by a space.

    Every row is searched alone and whole, where it is read: no shuffle, and repeated rows and rows without an id are rows like
    others. Null, empty and blank texts have no words and no runs. Other columns are not read. A document must fit a task.
    """
    kept = narrow(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _batches(as_bytes(batch.column(1))):
                owner, *columns = find_runs(_numbered(texts), min_length)
                begin, length, period = columns
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                left = []
                for k, words in enumerate(texts):
                    own = slice(cuts[k], cuts[k + 1])
                    if cuts[k] < cuts[k + 1]:
                        change = np.zeros(len(words) + 1, np.int64)
                        np.add.at(change, begin[own] + period[own], 1)
                        np.add.at(change, begin[own] + length[own], -1)
                        words = compress(words, (np.cumsum(change[:-1]) == 0).tolist())
                    left.append(b" ".join(words))
                runs = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)), pa.array([len(w) for w in texts], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs), pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    names=[id_column, "n_words", "runs", "collapsed"],
                )
                at += len(texts)

    kind = kept.schema[id_column].dataType.simpleString()
    made = kept.mapInArrow(run, f"`{id_column}` {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return made


def longest_run(runs: Column) -> Column:
    """The run with the greatest length, of those with the smallest start, of those with the smallest period; null without runs."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    top = F.array_max(ranked)
    return F.when(top.isNotNull(), F.struct((-top["s"]).alias("start"), top["l"].alias("length"), (-top["p"]).alias("period")))


def run_lines(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    each = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return F.array_join(each, "")
