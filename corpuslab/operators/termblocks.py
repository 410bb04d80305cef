"""Term counts of documents in blocks, and the sums of Naive Bayes over them.

Documents are packed into blocks of about a million tokens and written once, one row a block. A block folds equal terms and sends
its distinct terms, one small binary row, to each part of the terms; the part counts the documents and answers each
block with numbers for the terms that some configuration uses. From there on no term is moved as a string, and a term that no configuration uses is not moved
at all. Parts are chosen by a hash of the term, terms are compared as strings.

For a set of parameters a block sends its class sums to the parts, a part adds them and answers the test blocks with the sums of the terms that they
hold. So a word of nearly every document costs a part one entry a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from ..session import materialise, ship
from .features import TfidfParams, document_tokens

#: Tokens of a block; a document is never cut.
BLOCK_TOKENS = 1 << 20
#: Distinct terms of all blocks that a part gets.
PART_TERMS = 1 << 20
#: Terms that are paired with classes at once.
STEP = 1 << 21


def _pack(values: np.ndarray) -> bytes:
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unpack(data: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b"", kind)


def _narrow(values: np.ndarray) -> np.ndarray:
    """Four-byte counts and places."""
    return values.astype("<i4")


def _bytes_of(terms: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array of strings without nulls."""
    buffers = terms.buffers()
    at = np.frombuffer(buffers[1], "<i4")[terms.offset : terms.offset + len(terms) + 1].astype(np.int64)
    whole = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return at - at[0], whole[at[0] : at[-1]]


def _strings(lengths: np.ndarray, data: np.ndarray) -> pa.StringArray:
    at = np.concatenate([[0], np.cumsum(lengths)]).astype("<i4")
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(at.tobytes()), pa.py_buffer(data.tobytes()))


def _term_hash(terms: pa.StringArray) -> np.ndarray:
    """A hash of the bytes of every string, with wrapping arithmetic."""
    at, data = _bytes_of(terms)
    sizes = np.diff(at)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(data)) - np.repeat(at[:-1], sizes)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place], dtype=np.uint64)])
    out = running[at[1:]] - running[at[:-1]]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ out >> np.uint64(32)


def _block(flat: pa.StringArray, lengths: np.ndarray, low: int, high: int, parts: int) -> tuple[dict, list[dict]]:
    """Postings of a block, ordered by group and term, and what it sends to each group of terms.

    A group is a part of the n-grams of one size: number ``(n - 1) * parts + part``.
    """
    docs = len(lengths)
    doc, ends = np.repeat(np.arange(docs), lengths), np.cumsum(lengths)
    coded = flat.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    names = coded.dictionary.take(pa.array(order))
    word = rank[coded.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
    ids, terms, found = word, names, []
    for n in range(1, high + 1):
        starts = np.nonzero(np.arange(len(word)) + (n - 1) < ends[doc])[0]
        if n > 1:
            pairs, at = np.unique(ids[starts] * max(len(names), 1) + word[starts + (n - 1)], return_inverse=True)
            joined = pc.binary_join_element_wise(terms.take(pa.array(pairs // max(len(names), 1))), names.take(pa.array(pairs % max(len(names), 1))), " ")
            again = joined.dictionary_encode()
            if len(again.dictionary) < len(joined):  # tokens that hold spaces
                joined, at = again.dictionary, again.indices.to_numpy()[at]
            ids, terms = np.zeros(len(word), np.int64), joined
            ids[starts] = at
        if n >= low:
            found.append((n, terms, ids[starts], doc[starts]))
    terms = pa.concat_arrays([t for _, t, _, _ in found])
    group = np.concatenate([np.full(len(t), (n - 1) * parts) for n, t, _, _ in found]) + (_term_hash(terms) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    base = np.cumsum([0, *[len(t) for _, t, _, _ in found]])
    keys = np.concatenate([place[i + b] * docs + d for (_, _, i, d), b in zip(found, base, strict=False)])
    keys, tfs = np.unique(keys, return_counts=True)
    counts = np.bincount(keys // max(docs, 1), minlength=len(order))
    groups, sizes = np.unique(group, return_counts=True)
    at, data = _bytes_of(terms.take(pa.array(order)))
    sent, first = [], 0
    for g, size in zip(groups.tolist(), sizes.tolist(), strict=True):
        own = at[first : first + size + 1]
        sent.append({"g": g, "lengths": _pack(_narrow(np.diff(own))), "terms": _pack(data[own[0] : own[-1]]), "dfs": _pack(_narrow(counts[first : first + size]))})
        first += size
    postings = {"groups": _narrow(groups), "sizes": _narrow(sizes), "counts": _narrow(counts), "docs": _narrow(keys % max(docs, 1)), "tfs": _narrow(tfs)}
    return {k: _pack(v) for k, v in postings.items()}, sent


_POSTINGS = ("groups", "sizes", "counts", "docs", "tfs")


def _binary(*names: str) -> list[StructField]:
    return [StructField(n, BinaryType()) for n in names]


def _tables(schema: StructType, rows: dict[str, list]) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    return pa.table([pa.array(rows[f.name], f.type) for f in kinds], schema=kinds)


def _blocks(side: DataFrame, is_train: bool, params: TfidfParams, low: int, high: int, parts: int) -> DataFrame:
    """``block``, ``train``, ``ids``, ``labels``, the postings and ``sent`` of a side's documents."""
    documents = side.select("record_id", "label", document_tokens(F.col("text"), params).alias("tokens"))
    sent = StructType([StructField("g", IntegerType()), *_binary("lengths", "terms", "dfs")])
    schema = StructType(
        [
            StructField("block", LongType()), StructField("train", BooleanType()), StructField("ids", ArrayType(documents.schema["record_id"].dataType)),
            StructField("labels", ArrayType(documents.schema["label"].dataType)), *_binary(*_POSTINGS), StructField("sent", ArrayType(sent)), StructField("terms", LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n_held = TaskContext.get().partitionId() << 24, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, held, n_held
            table = pa.Table.from_batches(held).combine_chunks()
            tokens = pa.concat_arrays(table.column(2).chunks)
            lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
            postings, out = _block(tokens.flatten().cast(pa.string()), lengths, low, high, parts)
            row = {"block": number * 2 + (not is_train), "train": is_train, "ids": table.column(0).to_pylist(), "labels": table.column(1).to_pylist(), **postings}
            row |= {"sent": out, "terms": int(_unpack(postings["sizes"], "<i4").sum())}
            number, held, n_held = number + 1, [], 0
            yield from _tables(schema, {k: [v] for k, v in row.items()}).to_batches()

        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                before = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + BLOCK_TOKENS - n_held, "right")))
                held.append(batch.slice(start, stop - start))
                n_held += int(ends[stop - 1]) - before
                start = stop
                if start < batch.num_rows or n_held >= BLOCK_TOKENS:
                    yield from close()
        if held:
            yield from close()

    return documents.mapInArrow(run, schema)


#: Smallest and greatest size of n-gram and number of documents of the terms that a configuration uses.
Bounds = tuple[int, int, float, float]


def _uses(bounds: Bounds, n: np.ndarray | int, df: np.ndarray) -> np.ndarray:
    low, high, least, most = bounds
    return (n >= low) & (n <= high) & (df >= least) & (df <= most)


@dataclass(frozen=True)
class Numbered:
    """Blocks of a training and a test side whose terms are numbered: written tables."""

    table: DataFrame  # block, train, ids, labels, postings, numbers, dfs
    labels: list  # of the training side, sorted
    n_docs: int
    parts: int
    repeated: bool  # whether ids of the training side repeat


def number_terms(train: DataFrame, test: DataFrame, params: TfidfParams, low: int, high: int, bounds: Callable[[int], list[Bounds]]) -> Numbered:
    """Count the terms of both sides and number those that one of ``bounds`` (of a number of training documents) lets pass. Runs jobs."""
    spark = train.sparkSession
    ship(spark)
    # a first guess; parts grow with the texts, whose number of terms is known after the blocks are made
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, _text_terms(train, test) // PART_TERMS)
    both = _blocks(train, True, params, low, high, parts).unionByName(_blocks(test, False, params, low, high, parts))
    blocks = materialise(both, "blocks")
    in_train = blocks.where("train")
    n_docs = in_train.agg(F.sum(F.size("ids"))).first()[0] or 0
    labels = sorted(r[0] for r in in_train.select(F.explode("labels").alias("label")).distinct().collect())
    repeated = in_train.select(F.explode("ids").alias("id")).groupBy("id").count().where("count > 1").limit(1).count() > 0
    wanted = bounds(n_docs)
    answer = StructType([StructField("block", LongType()), StructField("g", IntegerType()), *_binary("numbers", "dfs")])

    def count(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")  # so that a repeated task numbers alike
        n = rows.column("g")[0].as_py() // parts + 1
        texts = [_strings(_unpack(a, "<i4"), _unpack(b, "u1")) for a, b in zip(rows.column("lengths").to_pylist(), rows.column("terms").to_pylist(), strict=True)]
        ids = pa.concat_arrays(texts).dictionary_encode()
        sizes, ids = [len(t) for t in texts], ids.indices.to_numpy()
        own = np.concatenate([_unpack(d, "<i4") * t for d, t in zip(rows.column("dfs").to_pylist(), rows.column("train").to_pylist(), strict=True)])
        df = np.bincount(ids, weights=own).astype(np.int64)
        used = (df > 0) & np.any([_uses(b, n, df) for b in wanted], axis=0)
        number = np.where(used, np.cumsum(used) - 1, -1)
        out = {k: [] for k in answer.names}
        for block, part in zip(rows.column("block").to_pylist(), np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
            mine = number[part]
            for k, v in zip(answer.names, (block, rows.column("g")[0].as_py(), _pack(_narrow(mine)), _pack(df[part][mine >= 0])), strict=True):
                out[k].append(v)
        return _tables(answer, out)

    asked = blocks.select("block", "train", F.inline("sent"))
    answers = asked.groupBy("g").applyInArrow(count, answer)
    plain = blocks.drop("sent", "terms")
    kept_columns, numbered = plain.columns, StructType([*plain.schema.fields, *_binary("numbers", "dfs")])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _tables(numbered, {k: [] for k in numbered.names})
        row = {k: left.column(k)[0].as_py() for k in kept_columns}
        right = right.sort_by("g")  # the order of the block's own terms
        empty = np.zeros(0, "<i4")
        numbers = np.concatenate([empty, *[_unpack(x, "<i4") for x in right.column("numbers").to_pylist()]])
        dfs = np.concatenate([np.zeros(0, "<i8"), *[_unpack(x, "<i8") for x in right.column("dfs").to_pylist()]])
        counts, sizes = _unpack(row["counts"], "<i4"), _unpack(row["sizes"], "<i4")
        kept = numbers >= 0
        postings = np.repeat(kept, counts)
        groups = np.repeat(np.arange(len(sizes)), sizes)[kept]
        row |= {"sizes": _pack(_narrow(np.bincount(groups, minlength=len(sizes)))), "counts": _pack(counts[kept]), "numbers": _pack(numbers[kept]), "dfs": _pack(dfs)}
        row |= {k: _pack(_unpack(row[k], "<i4")[postings]) for k in ("docs", "tfs")}
        return _tables(numbered, {k: [v] for k, v in row.items()})

    table = materialise(plain.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(meet, numbered), "numbered")
    return Numbered(table, labels, n_docs, parts, repeated)


def _text_terms(*sides: DataFrame) -> int:
    """Not fewer than the distinct terms of all blocks, by the length of the texts."""
    return sum((side.agg(F.sum(F.length("text"))).first()[0] or 0) for side in sides) // 4


@dataclass(frozen=True)
class _View:
    """The postings of a numbered block under a set of parameters, without terms that none of its configurations uses."""

    pos: np.ndarray  # of every posting the place of its term
    doc: np.ndarray
    weight: np.ndarray
    used: np.ndarray  # configurations by terms
    groups: np.ndarray
    ends: np.ndarray  # of the groups' terms
    numbers: np.ndarray
    dfs: np.ndarray


def _view(row: dict, params: TfidfParams, bounds: Sequence[Bounds], n_docs: int, parts: int) -> _View:
    groups, sizes, counts, doc, tf, numbers = (_unpack(row[k], "<i4") for k in (*_POSTINGS, "numbers"))
    dfs = _unpack(row["dfs"], "<i8")
    group = np.repeat(np.arange(len(groups)), sizes)
    used = np.array([_uses(b, groups[group] // parts + 1, dfs) for b in bounds]).reshape(len(bounds), len(dfs))
    some = used.any(axis=0)
    own = np.repeat(some, counts)
    used, numbers, dfs, counts, doc, tf = used[:, some], numbers[some], dfs[some], counts[some], doc[own], tf[own]
    sizes = np.bincount(group[some], minlength=len(groups))
    if not params.use_idf:
        idf = np.ones(len(dfs))
    else:
        idf = np.log((1.0 + n_docs) / (1.0 + dfs)) + 1.0 if params.smooth_idf else np.log(n_docs / dfs) + 1.0
    value = np.ones(len(tf)) if params.binary else 1.0 + np.log(tf) if params.sublinear_tf else tf.astype(float)
    pos = np.repeat(np.arange(len(dfs)), counts)
    return _View(pos, doc, value * idf[pos], used, groups, np.cumsum(sizes), numbers, dfs)


def _squares(view: _View, norm: str, docs: int) -> np.ndarray:
    """What the documents' norms are made of, by configuration and document."""
    own = np.abs(view.weight) if norm == "l1" else view.weight * view.weight
    return np.array([np.bincount(view.doc, weights=own * used[view.pos], minlength=docs) for used in view.used]).reshape(len(view.used), docs)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield {k: c[0].as_py() for k, c in zip(batch.schema.names, batch.slice(at, 1).columns, strict=True)}


def class_sums(known: Numbered, params: TfidfParams, bounds: Sequence[Bounds], alphas: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """Totals ``(config, label_id, n_c)`` with rows ``(config, null, null, v)``, and the sums of the test documents; a written table is made. Runs jobs.

    The second table has ``(record_id, config, label_id, s, sq)``: for each configuration by number the gains of a document's terms by class, and with a null
    class its weights and their squares. A document may have several rows of one kind.
    """
    parts, n_docs, k, labels = known.parts, known.n_docs, len(bounds), {c: i for i, c in enumerate(known.labels)}
    n_labels = max(1, len(labels))
    train, test = known.table.where("train"), known.table.where("not train")
    message = StructType([StructField("g", IntegerType()), StructField("block", LongType()), *_binary("numbers", "label_ids", "dfs", "sums")])

    if params.norm is not None and known.repeated:  # rows that share an id share a norm
        shared_id = StructType([StructField("v", train.schema["ids"].dataType.elementType)])  # a struct, so that null meets null
        piece = StructType([StructField("id", shared_id), StructField("block", LongType()), StructField("doc", IntegerType()), StructField("q", ArrayType(DoubleType()))])

        def parts_of_norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                docs = len(row["ids"])
                q = _squares(_view(row, params, bounds, n_docs, parts), params.norm, docs).T.tolist()
                yield from _tables(piece, {"id": [{"v": x} for x in row["ids"]], "block": [row["block"]] * docs, "doc": list(range(docs)), "q": q}).to_batches()

        pieces = materialise(train.mapInArrow(parts_of_norms, piece), "norms")
        whole = pieces.groupBy("id").agg(F.array(*[F.sum(F.get("q", F.lit(i))) for i in range(k)]).alias("q"))
        listed = F.transform(F.array_sort(F.collect_list(F.struct("doc", "q"))), lambda x: x["q"]).alias("squares")
        norms = pieces.drop("q").join(whole, "id").groupBy("block").agg(listed)
        train = train.join(norms, "block", "left")
    else:
        train = train.withColumn("squares", F.lit(None).cast("array<array<double>>"))

    def own_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            view, docs = _view(row, params, bounds, n_docs, parts), len(row["ids"])
            if params.norm is None:
                size = np.ones((k, docs))
            else:
                size = _squares(view, params.norm, docs) if row["squares"] is None else np.array(row["squares"]).reshape(docs, k).T
                size = np.where(size > 0, size if params.norm == "l1" else np.sqrt(size), 1.0)
            label = np.array([labels[c] for c in row["labels"]], np.int64)
            keys, at = np.unique(view.pos * n_labels + label[view.doc], return_inverse=True)
            sums = np.array([np.bincount(at, weights=view.weight * used[view.pos] / size[i][view.doc], minlength=len(keys)) for i, used in enumerate(view.used)])
            pos, label_id = keys // n_labels, _narrow(keys % n_labels)
            cuts = np.searchsorted(pos, view.ends)
            out, first = {f: [] for f in message.names}, 0
            for g, end in zip(view.groups.tolist(), cuts.tolist(), strict=True):
                if end > first:
                    own = pos[first:end]
                    values = (g, row["block"], _pack(view.numbers[own]), _pack(label_id[first:end]), _pack(view.dfs[own]), _pack(np.ascontiguousarray(sums[:, first:end])))
                    for f, v in zip(message.names, values, strict=True):
                        out[f].append(v)
                first = end
            yield from _tables(message, out).to_batches()

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            view = _view(row, params, bounds, n_docs, parts)
            asked = [(g, _pack(x)) for g, x in zip(view.groups.tolist(), np.split(view.numbers, view.ends), strict=False) if len(x)]
            out = {f: [None] * len(asked) for f in message.names}
            out |= {"g": [g for g, _ in asked], "block": [row["block"]] * len(asked), "numbers": [x for _, x in asked]}
            yield from _tables(message, out).to_batches()

    total = StructType([StructField("config", IntegerType()), StructField("label_id", IntegerType()), StructField("n_c", DoubleType()), StructField("v", LongType())])
    answer = StructType([StructField("block", LongType()), StructField("g", IntegerType()), *_binary("widths", "label_ids", "sums"), StructField("totals", ArrayType(total))])

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        g = rows.column("g")[0].as_py()
        got = [r for r in rows.to_pylist() if r["sums"] is not None]
        empty = {"<i4": np.zeros(0, "<i4"), "<i8": np.zeros(0, "<i8")}
        number = np.concatenate([empty["<i4"], *[_unpack(r["numbers"], "<i4") for r in got]]).astype(np.int64)
        label = np.concatenate([empty["<i4"], *[_unpack(r["label_ids"], "<i4") for r in got]])
        dfs = np.concatenate([empty["<i8"], *[_unpack(r["dfs"], "<i8") for r in got]])
        parted = np.concatenate([np.zeros((k, 0)), *[_unpack(r["sums"], "<f8").reshape(k, -1) for r in got]], axis=1)
        keys, first, at = np.unique(number * n_labels + label, return_index=True, return_inverse=True)
        sums = np.array([np.bincount(at, weights=x, minlength=len(keys)) for x in parted]).reshape(k, len(keys))
        own, label = keys // n_labels, _narrow(keys % n_labels)
        _, one = np.unique(own, return_index=True)
        totals = []
        for i, b in enumerate(bounds):
            each = np.bincount(label, weights=sums[i], minlength=n_labels)
            totals.append({"config": i, "label_id": None, "n_c": None, "v": int(_uses(b, g // parts + 1, dfs[first[one]]).sum())})
            totals += [{"config": i, "label_id": int(c), "n_c": float(each[c]), "v": None} for c in np.nonzero(each)[0]]
        out = {f: [] for f in answer.names}
        for r in [{"block": None}, *[r for r in rows.to_pylist() if r["sums"] is None]]:
            values = (None, g, None, None, None, totals)
            if r["block"] is not None:
                asked = _unpack(r["numbers"], "<i4")
                begin, end = np.searchsorted(own, asked), np.searchsorted(own, asked, "right")
                pick = _ranges(begin, end - begin)
                values = (r["block"], g, _pack(_narrow(end - begin)), _pack(label[pick]), _pack(np.ascontiguousarray(sums[:, pick])), None)
            for f, v in zip(answer.names, values, strict=True):
                out[f].append(v)
        return _tables(answer, out)

    sent = train.mapInArrow(own_sums, message).unionByName(test.mapInArrow(questions, message))
    answers = materialise(sent.groupBy("g").applyInArrow(add, answer), "sums")
    totals = answers.where("block is null").select(F.inline("totals")).groupBy("config", "label_id").agg(F.sum("n_c").alias("n_c"), F.sum("v").alias("v"))

    found = StructType(
        [StructField("record_id", test.schema["ids"].dataType.elementType), StructField("config", IntegerType()), StructField("label_id", IntegerType())]
        + [StructField(f, DoubleType()) for f in ("s", "sq")]
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _tables(found, {f: [] for f in found.names})
        row = {f: left.column(f)[0].as_py() for f in left.column_names}
        view, docs = _view(row, params, bounds, n_docs, parts), len(row["ids"])
        right = right.sort_by("g").to_pylist()
        widths = np.concatenate([np.zeros(0, "<i4"), *[_unpack(r["widths"], "<i4") for r in right]]).astype(np.int64)
        label = np.concatenate([np.zeros(0, "<i4"), *[_unpack(r["label_ids"], "<i4") for r in right]]).astype(np.int64)
        sums = np.concatenate([np.zeros((k, 0)), *[_unpack(r["sums"], "<f8").reshape(k, -1) for r in right]], axis=1)
        begin = np.cumsum(widths) - widths
        gains = np.zeros((k, docs * n_labels))
        entries = np.cumsum(widths[view.pos])
        first = 0
        while first < len(view.pos):  # postings and classes of their terms, some at once
            stop = max(first + 1, int(np.searchsorted(entries, (entries[first - 1] if first else 0) + STEP, "right")))
            pos, w = view.pos[first:stop], view.weight[first:stop]
            pick = _ranges(begin[pos], widths[pos])
            to = np.repeat(view.doc[first:stop].astype(np.int64) * n_labels, widths[pos]) + label[pick]
            w = np.repeat(w, widths[pos])
            for i, alpha in enumerate(alphas):
                gains[i] += np.bincount(to, weights=w * (np.log(sums[i][pick] + alpha) - np.log(alpha)), minlength=docs * n_labels)
            first = stop
        ids, out = np.arange(docs), []
        for i, used in enumerate(view.used):
            hit = used[view.pos]
            w, d = view.weight[hit], view.doc[hit]
            some = np.nonzero(np.bincount(d, minlength=docs))[0]
            out.append((some, np.full(len(some), i), np.full(len(some), -1), np.bincount(d, weights=w, minlength=docs)[some], np.bincount(d, weights=w * w, minlength=docs)[some]))
            at = np.nonzero(gains[i])[0]
            out.append((ids[at // n_labels], np.full(len(at), i), at % n_labels, gains[i][at], np.zeros(len(at))))
        doc, config, label_id, s, sq = (np.concatenate(x) for x in zip(*out, strict=True))
        columns = [left.column("ids").combine_chunks().flatten().take(pa.array(doc)), pa.array(config, pa.int32()), pa.array(label_id, pa.int32(), mask=label_id < 0), pa.array(s), pa.array(sq)]
        return pa.table(columns, names=found.names)

    hits = test.groupBy("block").cogroup(answers.where("block is not null").drop("totals").groupBy("block")).applyInArrow(score, found)
    return totals, hits


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges of the given starts and sizes, one after another."""
    return np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
