"""Benchmark decontamination by latent semantic retrieval.

The terms are those of the benchmark passages; their weights come from passage counts over the whole corpus. A
randomised SVD of the passages' TF-IDF matrix, computed by Spark jobs over the passage table, gives the latent space of
the benchmark. Every overlapping passage of every document is projected into it and compared with all
benchmark passages by cosine. Candidates are then checked in the text: the longest common subsequence of words must
cover most of the item, and of its answer (its last words), within a stretch of the document of about the item's length.

The latent space of a large block keeps only a part of each item, so a second, exact gate completes the candidates. A match
needs ``need`` of an item's ``n`` words; of its ``n - need + k`` rarest words it then holds ``k`` at least. An index
of these words counts them in windows that overlap so far that every stretch lies whole in one. Agreement in frequent
words alone is chance: without a cosine over the gate, the stretch must also hold a share of the item's weight, the sum of
its words' corpus weights. So such a pair is found whatever the rank and the other items of the block.
"""

from __future__ import annotations

import math
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import as_bytes, narrow

_SPACES = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


@dataclass(frozen=True)
class Settings:
    rank: int = 128  # latent dimensions, at most
    oversample: int = 16
    half: int = 32  # words of half a passage; passages overlap by half
    min_cosine: float = 0.3
    min_idf: float = 0.7  # terms in about half of all passages or more carry no weight
    min_overlap: float = 0.6  # of an item's words, in order
    min_answer: float = 0.4  # of its answer's words, in order
    answer_share: float = 0.2
    min_share: float = 0.3  # of an item's weight, for candidates of the exact gate
    stretch: float = 1.6  # words of the document that the match may span, times those of the item
    block_items: int = 1000  # benchmark items that are broadcast together

    def need(self, n: int) -> int:
        """Words of an item of ``n`` words that a match holds at least."""
        return max(1, math.ceil(self.min_overlap * n - 1e-9))

    def reach(self, n: int) -> int:
        """Words of a document that a match with an item of ``n`` words may span."""
        return max(n + 4, int(n * self.stretch))


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words; ASCII punctuation parts words."""
    return text.decode().lower().encode().translate(_SPACES).split()


@dataclass
class Index:
    """Rare words of the items whose stretches fit windows of two cells of ``size`` words."""

    size: int
    first: np.ndarray  # of each term, and one more: where its postings begin
    item: np.ndarray
    times: np.ndarray  # how often the item's rare words hold the term
    least: np.ndarray  # of each item of the block: rare words that a match holds at least


@dataclass
class Items:
    """A bounded block of benchmark items, with the latent space fitted to their passages."""

    ids: list
    words: list[np.ndarray]  # term numbers of each item
    vocab: dict[bytes, int]
    passages: list[tuple[int, np.ndarray]]  # (item, term numbers)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    space: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # terms x rank
    targets: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # passages x rank, unit length
    rare: list[Index] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of each term; small, not zero, for frequent ones


def _items(rows: list, half: int) -> Items:
    vocab: dict[bytes, int] = {}
    ids, words, passages = [], [], []
    for item, text in rows:
        found = np.array([vocab.setdefault(w, len(vocab)) for w in words_of((text or "").encode())], np.int64)
        if len(found):
            size = 2 * half
            cuts = range(0, max(1, len(found) - half), size)
            passages.extend((len(ids), found[c : c + size]) for c in cuts)
            ids.append(item)
            words.append(found)
    return Items(ids, words, vocab, passages)


def _numbers(text: bytes, vocab: dict[bytes, int]) -> np.ndarray:
    found = words_of(text)
    return np.fromiter(map(vocab.get, found, repeat(-1)), np.int64, len(found))


def rare_words(items: Items, counts: np.ndarray, settings: Settings) -> list[Index]:
    """The exact gate: one index for each size of windows, by the terms' passage counts in the corpus."""
    n_terms, least = len(items.vocab), np.ones(len(items.ids), np.int64)
    found: dict[int, list[np.ndarray]] = {}
    for item, words in enumerate(items.words):
        n = len(words)
        need = settings.need(n)
        least[item] = max(1, need // 2)
        rare = words[np.lexsort((words, counts[words]))][: n - need + least[item]]
        terms, times = np.unique(rare, return_counts=True)
        size = 1 << (max(settings.half, settings.reach(n)) - 1).bit_length()
        found.setdefault(size, []).append(np.stack([terms, np.full(len(terms), item), times]))
    out = []
    for size, parts in sorted(found.items()):
        terms, item, times = np.concatenate(parts, axis=1)
        order = np.argsort(terms, kind="stable")
        out.append(Index(size, np.searchsorted(terms[order], np.arange(n_terms + 1)), item[order], times[order], least))
    return out


def shared_words(at: np.ndarray, found: np.ndarray, index: Index, n_items: int) -> Iterator[tuple[int, int]]:
    """(first word, item) of every window that holds enough of an item's rare words; ``at`` has the places of the terms ``found``."""
    n_terms, size, step = len(index.first) - 1, index.size, max(1, (1 << 17) // index.size)
    held = index.first[found + 1] > index.first[found]
    at, found = at[held], found[held]
    for begin in range(0, int(at[-1]) // size + 1 if len(at) else 0, step):  # bounded memory for very long texts
        part = slice(*np.searchsorted(at, (begin * size, (begin + step + 1) * size)))
        cell, terms = at[part] // size, found[part]
        windows = np.concatenate([cell, cell - 1])
        inside = (windows >= begin) & (windows < begin + step)
        keys, counts = np.unique((windows * n_terms + np.concatenate([terms, terms]))[inside], return_counts=True)
        window, term = keys // n_terms, keys % n_terms
        n = index.first[term + 1] - index.first[term]
        place = np.repeat(index.first[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        held = np.minimum(np.repeat(counts, n), index.times[place])
        pairs, inverse = np.unique(np.repeat(window, n) * n_items + index.item[place], return_inverse=True)
        total = np.bincount(inverse, held, len(pairs))
        for pair in pairs[total >= index.least[pairs % n_items]].tolist():
            yield pair // n_items * size, pair % n_items


def windows(founds: list[np.ndarray], items: Items) -> list[list[tuple[int, int, int]]]:
    """(size, first word, item) of the exact gate's windows for each of some documents, which lie too far apart to share one."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in founds]
    if not items.rare:
        return out
    pad = items.rare[-1].size  # all sizes are powers of two
    starts = np.cumsum([0] + [(-(-len(f) // pad) + 1) * pad for f in founds])
    places = [np.flatnonzero(f >= 0) for f in founds]
    at = np.concatenate([p + s for p, s in zip(places, starts[:-1].tolist(), strict=True)])
    terms = np.concatenate([f[p] for f, p in zip(founds, places, strict=True)])
    for index in items.rare:
        for place, item in shared_words(at, terms, index, len(items.ids)):
            doc = int(np.searchsorted(starts, place, "right")) - 1
            if (first := place - int(starts[doc])) < len(founds[doc]):  # otherwise the next document's first cell, again
                out[doc].append((2 * index.size, first, item))
    return out


def passage_counts(docs: DataFrame, items: Items, half: int, text_column: str) -> tuple[int, np.ndarray]:
    """Number of passages of the corpus, and of those that hold each term; folded in the tasks, then summed by term."""
    size, n_terms = 2 * half, len(items.vocab)
    held = docs.sparkSession.sparkContext.broadcast(items.vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(n_terms, np.int64), 0
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                found = _numbers(text, held.value)
                total += -(-len(found) // size)
                at = np.flatnonzero(found >= 0)
                keys = np.unique(at // size * n_terms + found[at])
                counts += np.bincount(keys % n_terms, minlength=n_terms)
        terms = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": np.append(terms, -1), "n": np.append(counts[terms], total)})

    found = docs.select(text_column).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(n_terms, np.int64)
    total = 0
    for term, n in found:  # one row for each term of the benchmark block
        if term < 0:
            total = n
        else:
            counts[term] = n
    return total, counts


def _sparse(passages: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the unit-length TF-IDF rows."""
    rows, columns, values = [], [], []
    for row, found in enumerate(passages):
        terms, counts = np.unique(found, return_counts=True)
        x = counts * idf[terms]
        length = math.sqrt(float((x * x).sum()))
        if length:
            rows.append(np.full(len(terms), row))
            columns.append(terms)
            values.append(x / length)
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return join(rows, np.int64), join(columns, np.int64), join(values, np.float64)


def _times(entries: tuple, n_rows: int, dense: np.ndarray) -> np.ndarray:
    rows, columns, values = entries
    out = np.zeros((n_rows, dense.shape[1]))
    np.add.at(out, rows, dense[columns] * values[:, None])
    return out


def randomised_svd(passages: DataFrame, idf: np.ndarray, rank: int, oversample: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (terms x rank) and singular values of a passage table with a column ``terms`` (array of longs).

    Two passes: the tasks sketch A'(A G) for a Gaussian G that all draw from the same seed, and the sketches are summed by term;
    with Q an orthonormal basis of the sum, the tasks give (A Q)'(A Q). Only matrices of the size terms x rank and
    rank x rank reach the driver, whatever the number of passages.
    """
    n_terms, width = len(idf), rank + oversample

    def rows_of(batch: pa.RecordBatch) -> tuple[tuple, int]:
        found = [np.array(x, np.int64) for x in batch.column(0).to_pylist()]
        return _sparse(found, idf), len(found)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(seed).standard_normal((n_terms, width))
        total = np.zeros((n_terms, width))
        for batch in batches:
            entries, n = rows_of(batch)
            y = _times(entries, n, draw)
            np.add.at(total, entries[1], y[entries[0]] * entries[2][:, None])
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_pydict({"term": pa.array(used, pa.int64()), "v": pa.array([total[t].tobytes() for t in used], pa.binary())})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[term] = sums.get(term, 0) + np.frombuffer(raw)
        yield pa.RecordBatch.from_pydict({"term": pa.array(sums.keys(), pa.int64()), "v": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    kind = "term long, v binary"
    parts = passages.select("terms").mapInArrow(sketch, kind)
    rows = parts.repartition("term").mapInArrow(fold, kind).collect()
    sketched = np.zeros((n_terms, width))
    for term, raw in rows:
        sketched[term] = np.frombuffer(bytes(raw))
    basis, _ = np.linalg.qr(sketched)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((basis.shape[1],) * 2)
        for batch in batches:
            y = _times(*rows_of(batch), basis)
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary())})

    total = sum(np.frombuffer(bytes(r["v"])) for r in passages.select("terms").mapInArrow(gram, "v binary").collect())
    values, vectors = np.linalg.eigh(np.reshape(total, (basis.shape[1],) * 2))
    order = np.argsort(values)[::-1][:rank]
    order = order[values[order] > 1e-9]
    return basis @ vectors[:, order], np.sqrt(values[order])


def fit(docs: DataFrame, rows: list, settings: Settings, text_column: str = "text") -> Items:
    """Count the corpus for a block of benchmark rows and fit the latent space of their passages."""
    items = _items(rows, settings.half)
    total, counts = passage_counts(docs, items, settings.half, text_column)
    idf = np.log((total + 1) / (counts + 1)) + 1e-9
    items.weights = idf
    items.idf = np.where(idf < settings.min_idf, 0.0, idf)
    found = [p for _, p in items.passages]
    spark = docs.sparkSession
    table = spark.createDataFrame([(p.tolist(),) for p in found], "terms array<bigint>")
    space, _ = randomised_svd(table, items.idf, min(settings.rank, len(found)), settings.oversample)
    targets = _times(_sparse(found, items.idf), len(found), space)
    length = np.linalg.norm(targets, axis=1, keepdims=True)
    items.space = (space * items.idf[:, None]).astype(np.float32)
    items.targets = np.divide(targets, length, out=np.zeros_like(targets), where=length > 0).astype(np.float32)
    items.rare = rare_words(items, counts, settings)
    return items


def common_subsequence(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in words:
        if m := masks.get(w):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


def _weight(words: Counter, weights: np.ndarray) -> float:
    return float(sum(weights[w] * n for w, n in words.items()))


def best_overlap(item: np.ndarray, found: np.ndarray, at: int, size: int, settings: Settings, weights: np.ndarray | None = None) -> tuple[float, float]:
    """Largest share of an item's words, and of its answer's, in order within any stretch near a passage of a document.

    Stretches that hold enough of both come before those that hold more words without the answer. With ``weights``,
    stretches with less than the least share of the item's weight do not count.
    """
    n = len(item)
    span = settings.reach(n)
    start, stop = max(0, at - span), min(len(found), at + size + span)
    near = found[start:stop]
    held = np.zeros(max(int(item.max()), int(near.max(initial=0))) + 2, bool)
    held[item] = True  # the last place, which is that of unknown words, stays free
    hits = np.flatnonzero(held[near])
    need = settings.need(n)
    if len(hits) < need:
        return 0.0, 0.0
    # a quarter of an item apart at least; the steps in between lie in the second stretch
    step = max(1, n // 4)
    before, after, beyond, following = np.searchsorted(hits, np.stack([hits - step, hits + span, hits + step + span, hits + step]))
    places = np.arange(len(hits))
    if max((after - before).max(), (beyond - places).max()) < need:
        return 0.0, 0.0
    target, tail = item.tolist(), item[n - max(1, math.ceil(n * settings.answer_share)) :].tolist()
    best, at_hit = (False, 0, 0), 0
    words = near[hits].tolist()
    before, after, beyond, following = before.tolist(), after.tolist(), beyond.tolist(), following.tolist()
    while at_hit < len(words):
        for low, high in ((before[at_hit], after[at_hit]), (at_hit, beyond[at_hit])):
            if high - low < need:
                continue
            part = words[low:high]
            got = common_subsequence(target, part)
            if got < need:
                continue
            if weights is not None and _weight(Counter(part) & Counter(target), weights) < settings.min_share * _weight(Counter(target), weights):
                continue
            answer = common_subsequence(tail, part)
            best = max(best, (answer >= settings.min_answer * len(tail), got, answer))
        at_hit = following[at_hit]
    return best[1] / n, best[2] / len(tail)


def all_matches(texts: list[bytes], items: Items, settings: Settings) -> Iterator[dict[int, tuple[float, float]]]:
    """``matches`` of every text, in order; the exact gate takes some texts at a time."""
    founds, held = [], 0
    for k, text in enumerate(texts):
        founds.append(_numbers(text, items.vocab))
        held += len(founds[-1])
        if held > 1 << 17 or k == len(texts) - 1:
            for found, near in zip(founds, windows(founds, items), strict=True):
                yield matches(found, near, items, settings)
            founds, held = [], 0


def matches(found: np.ndarray, near: list[tuple[int, int, int]], items: Items, settings: Settings) -> dict[int, tuple[float, float]]:
    """Items that a document holds: overlap and best cosine, by the item's place in the block; ``near`` has its windows."""
    half = settings.half
    out: dict[int, tuple[float, float]] = {}
    known = np.flatnonzero(found >= 0)
    if not len(known):
        return out

    def check(item: int, at: int, size: int, cosine: float, weights: np.ndarray | None = None) -> None:
        overlap, answer = best_overlap(items.words[item], found, at, size, settings, weights)
        if overlap >= settings.min_overlap and answer >= settings.min_answer:
            was = out.get(item, (0.0, 0.0))
            out[item] = (max(was[0], overlap), max(was[1], cosine))

    n_halves = -(-len(found) // half)
    hit = known[items.idf[found[known]] > 0]
    part = hit // half
    lead = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(hit) else hit
    terms = found[hit]
    sums = np.zeros((n_halves + 1, items.space.shape[1]), np.float32)
    if len(hit):
        sums[part[lead]] = np.add.reduceat(items.space[terms], lead, axis=0)
    # squared length in term space: counts of a term within a passage
    keys = np.concatenate([part * len(items.idf) + terms, (part - 1) * len(items.idf) + terms])
    keys = keys[keys >= 0]
    keys, counts = np.unique(keys, return_counts=True)
    x = counts * items.idf[keys % len(items.idf)]
    squares = np.bincount(keys // len(items.idf), x * x, n_halves)
    passages = sums[:-1] + sums[1:]
    length = np.sqrt(np.maximum(squares[:n_halves], 1e-12))
    for begin in range(0, n_halves, 4096):
        cosines = (passages[begin : begin + 4096] @ items.targets.T) / length[begin : begin + 4096, None]
        rows, columns = np.nonzero(cosines >= settings.min_cosine)
        for row, column in zip(rows.tolist(), columns.tolist(), strict=True):
            check(items.passages[column][0], (begin + row) * half, 2 * half, float(cosines[row, column]))
    for size, at, item in near:
        first = bisect_left(items.passages, item, key=lambda p: p[0])
        last = bisect_left(items.passages, item + 1, key=lambda p: p[0])
        rows = slice(at // half, (at + size) // half)
        cosines = (passages[rows] @ items.targets[first:last].T) / length[rows, None]
        check(item, at, size, float(cosines.max(initial=0.0)), items.weights)
    return out


def _blocks(benchmark: DataFrame, id_column: str, text_column: str, size: int) -> Iterator[list]:
    """The benchmark's rows in blocks of ``size`` at most, in a fixed order; the driver holds one block at a time."""
    rows = benchmark.select(F.col(id_column).alias("i"), F.col(text_column).alias("t")).where("t is not null").orderBy("i", "t")
    block = []
    for row in rows.toLocalIterator():
        block.append((row["i"], row["t"]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", settings: Settings = Settings(),
) -> DataFrame:
    """Pairs of document and benchmark item: ``id_column``, ``item_column``, ``overlap`` (share of the item's words), ``cosine``.

    Every passage of every document is searched, and every stretch that holds enough of an item's words and weight is found. The benchmark is the query set; it is sent to the tasks in blocks of
    ``block_items`` items, one scan of the documents each. Null and blank texts match nothing; items without words are left
    out. Rows that repeat an id, or lack one, each give their own pairs. An empty corpus or benchmark gives no rows.
    """
    kept = narrow(docs, id_column, text_column)
    kind = T.StructType([docs.schema[id_column], benchmark.schema[item_column], T.StructField("overlap", T.DoubleType()), T.StructField("cosine", T.DoubleType())])
    out = docs.sparkSession.createDataFrame([], kind)
    item_type = to_arrow_type(kind[item_column].dataType)
    for rows in _blocks(benchmark, item_column, text_column, settings.block_items):
        held = docs.sparkSession.sparkContext.broadcast(fit(kept, rows, settings, text_column))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items = held.value
            for batch in batches:
                docs_at, item_ids, overlaps, cosines = [], [], [], []
                for row, found in enumerate(all_matches(as_bytes(batch.column(1)), items, settings)):
                    for item, (overlap, cosine) in found.items():
                        docs_at.append(row)
                        item_ids.append(items.ids[item])
                        overlaps.append(overlap)
                        cosines.append(cosine)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(docs_at, pa.int64())), pa.array(item_ids, item_type), pa.array(overlaps, pa.float64()), pa.array(cosines, pa.float64())],
                    names=kind.names,
                )

        out = out.unionByName(kept.mapInArrow(run, kind))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", settings: Settings = Settings()) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no item of the benchmark: those that ``contaminated`` has no pair for.

    Every block of the benchmark is fitted to all of ``docs``; then one pass decides where a document is read, without a join. A row that a block
    has found leaves, so later blocks look at the others only.
    """
    names, at = docs.columns, docs.columns.index(text_column)
    texts = docs.select(text_column)
    blocks = _blocks(benchmark, item_column, text_column, settings.block_items)
    held = [docs.sparkSession.sparkContext.broadcast(fit(texts, rows, settings, text_column)) for rows in blocks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in held:
                keep = [not found for found in all_matches(as_bytes(batch.column(at)), block.value, settings)]
                batch = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    return docs.mapInArrow(run, docs.schema)
