"""Ranked lexical search by NRA: impact-sorted lists are read in sequence until the best documents are certain.

Documents are searched in shards. A shard holds, for each term of the items, its documents with the impact of the term, the greatest impact
first. For an item the lists of its terms are read side by side, in growing steps. What was read of a document is the lower end of its
score; the upper end adds, for each list in which it was not met yet, the next impact of that list. A document leaves when its upper end is under the
k-th best lower end, of this shard or of those that the task has searched before. Reading goes on until no unread document can
enter and both ends of every remaining document are equal, so that membership, ties and scores are final. There is no random access.

The best documents of every shard are exact, so the best of all shards are the result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import as_bytes, materialise

#: Most items that are searched together, and most bytes of their texts; more items take more passes over the documents.
BLOCK_ITEMS, BLOCK_TEXT = 1_000, 4 << 20
#: Postings of a shard, about 24 bytes each while it is searched.
SHARD_POSTINGS = 2 << 20
FIRST_STEP = 64

# Signs that part terms: ASCII but for digits and letters; capitals become small letters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased, in UTF-8."""
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Share of a term in a document's score, in 64-bit integers."""
    m = 10 + (90 * length * n_docs) // n_terms
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass
class Lists:
    """Impact-sorted lists of a shard: those of term t are the places from ``cuts[t]`` to ``cuts[t + 1]``."""

    docs: np.ndarray
    impact: np.ndarray
    cuts: np.ndarray
    n_docs: int

    @classmethod
    def of(cls, docs: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int) -> Lists:
        order = np.lexsort((docs, -impact, terms))
        return cls(docs[order], impact[order], np.searchsorted(terms[order], np.arange(n_terms + 1)), n_docs)


def nra(lists: Lists, terms: np.ndarray, k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores of the k best for a set of terms, best first, equal scores by number; only scores of at least ``floor``."""
    begin, end = lists.cuts[terms], lists.cuts[terms + 1]
    begin, end = begin[begin < end], end[begin < end]
    low = np.zeros(lists.n_docs, np.int64)
    met = np.zeros((len(begin), lists.n_docs), bool)
    left: np.ndarray | None = None  # documents that may still be among the best; all, until no unread one can enter
    wanted = np.zeros(lists.n_docs, bool)
    at, step = begin.copy(), FIRST_STEP
    while True:
        upto = np.minimum(at + step, end)
        for j in np.flatnonzero(at < upto):
            docs, gain = lists.docs[at[j] : upto[j]], lists.impact[at[j] : upto[j]]
            if left is not None:
                mine = wanted[docs]
                docs, gain = docs[mine], gain[mine]
            low[docs] += gain
            met[j, docs] = True
        at, step = upto, step * 2
        ahead = np.where(at < end, lists.impact[np.minimum(at, len(lists.impact) - 1)], 0) if len(begin) else np.zeros(0, np.int64)
        ends = low if left is None else low[left]
        least = max(floor, int(np.partition(ends, -k)[-k])) if len(ends) >= k else floor
        rest = int(ahead.sum())
        if left is None and rest and rest >= least:
            continue
        left = np.flatnonzero(low + rest >= least) if left is None else left
        high = low[left] + ahead @ ~met[:, left] if rest else low[left]
        stays = high >= least
        left, high = left[stays], high[stays]
        if not len(left) or bool((high == low[left]).all()):
            break
        wanted[:] = False
        wanted[left] = True
    best = left[np.lexsort((left, -low[left]))][:k]
    return best, low[best]


def _forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Written table of the documents with at least one term: id, number of terms, and the terms of the vocabulary with their counts."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in as_bytes(batch.column(1)):
                words = terms_of(text)
                seen = Counter(words)
                mine = [w for w in seen if w in known]
                sizes.append(len(words))
                terms.append(np.array([known[w] for w in mine], "<i4").tobytes())
                counts.append(np.array([seen[w] for w in mine], "<i4").tobytes())
            made = pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], names=["id", "n", "terms", "counts"])
            yield made.filter(pa.array(np.array(sizes, np.int64) > 0))

    kind = docs.schema["id"].dataType.simpleString()
    return materialise(docs.mapInArrow(run, f"id {kind}, n long, terms binary, counts binary"), "forward")


def _numbers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").astype(np.int64)


def _frequencies(forward: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term; every task adds its own up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0)), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for row in forward.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


def _ordered(ids: list) -> list[int]:
    """Row numbers in the order of their ids, null ids last; strings by their UTF-8 bytes."""
    key = lambda k: (ids[k] is None, ids[k].encode() if isinstance(ids[k], str) else ids[k] if ids[k] is not None else 0)
    return sorted(range(len(ids)), key=key)


def _hits(forward: DataFrame, queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The k best documents of every shard for each query (its terms): ``item``, ``id``, ``score``."""
    held = forward.sparkSession.sparkContext.broadcast((queries, weights))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        kept, size = [], 0
        for batch in batches:
            kept.append(batch)
            size += batch.column(2).nbytes // 4
            if size >= SHARD_POSTINGS:
                yield pa.Table.from_batches(kept)
                kept, size = [], 0
        if kept:
            yield pa.Table.from_batches(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight_of = held.value
        best: list[list[int]] = [[] for _ in asked]  # the k best scores of each query so far
        for shard in shards(batches):
            shard = shard.take(pa.array(_ordered(shard.column(0).to_pylist())))
            length = shard.column(1).to_numpy()
            owner = np.repeat(np.arange(len(length)), [len(x) // 4 for x in shard.column(2).to_pylist()])
            terms, tf = _numbers(shard.column(2)), _numbers(shard.column(3))
            gain = impacts(weight_of[terms], tf, length[owner], n_docs, n_terms)
            lists = Lists.of(owner, terms, gain, len(length), len(weight_of))
            items, rows, scores = [], [], []
            for number, query in enumerate(asked):
                held_best = best[number]
                found, score = nra(lists, query, k, max(1, held_best[0]) if len(held_best) == k else 1)
                items.append(np.full(len(found), number))
                rows.append(found)
                scores.append(score)
                for s in score.tolist():
                    (heapq.heappushpop if len(held_best) == k else heapq.heappush)(held_best, s)
            at = pa.array(np.concatenate(rows))
            ids = shard.column(0).take(at).combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(items), pa.int32()), ids, pa.array(np.concatenate(scores), pa.int64())], names=["item", "id", "score"])

    kind = forward.schema["id"].dataType.simpleString()
    return forward.mapInArrow(run, f"item int, id {kind}, score long")


def _item_blocks(items: DataFrame) -> Iterator[list]:
    block, size = [], 0
    for row in items.toLocalIterator(prefetchPartitions=False):
        block.append(row)
        size += len(row[1] or "")
        if len(block) == BLOCK_ITEMS or size >= BLOCK_TEXT:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Columns ``item_column``, ``rank`` (from 1), ``id_column`` and ``score``: every item's k best documents with a score above 0.

    Every row of ``docs`` is a document, every row of ``items`` an item, also where rows repeat each other or an id. A document's score
    sums, over the distinct terms of the item, the floored weight 1000 ln((2N + 2) / (2 df + 1)) times (10^9 tf) div (1000 tf + 8 m), where m is 10 +
    (90 n N) div L; N counts the documents with a term, L all terms, df the documents with this term. Equal scores rank by id,
    rows without an id last. Null and empty texts have no terms; such items give no rows, such documents are not counted. Other columns are not read.

    Items come to the driver in blocks of bounded size; a block's terms, with their weights, go to the tasks. For each block the documents are read
    once, and what is kept of them for the block's terms is written and searched. Runs jobs.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    asked = items.select(F.col(item_column).alias("item_id"), F.col(item_text).alias("text"))
    id_kind, item_kind = plain.schema["id"].dataType.simpleString(), asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_kind}, rank int, id {id_kind}, score long")
    for block in _item_blocks(asked):
        wanted = [list(dict.fromkeys(terms_of((row[1] or "").encode()))) for row in block]
        vocabulary = {w: t for t, w in enumerate(dict.fromkeys(w for words in wanted for w in words))}
        forward = _forward(plain, vocabulary)
        total = forward.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            continue
        df = _frequencies(forward, len(vocabulary))
        weights = np.array([weight(total["docs"], int(d)) for d in df], np.int64)
        queries = [np.array([vocabulary[w] for w in words], np.int64) for words in wanted]
        hits = _hits(forward, queries, weights, total["docs"], total["terms"], k)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(n, row[0]) for n, row in enumerate(block)], f"item int, item_id {item_kind}")
        out = out.unionByName(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "id", "score"))
    return out.toDF(item_column, "rank", id_column, "score")
