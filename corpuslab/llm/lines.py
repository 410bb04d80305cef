"""Removal of lines that many documents share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import as_bytes, materialise

BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """Normalised line: white space stripped at both ends, A-Z lower-cased (other letters unchanged)."""
    return line.strip(BLANK).lower()


def key_hashes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every line's key; zero in both marks an empty key."""
    n, keys = len(lines), [line_key(x) for x in lines]
    whole = b"".join(xxhash.xxh3_128_digest(k) if k else bytes(16) for k in keys)
    both = np.frombuffer(whole, "<i8").reshape(n, 2)
    return both[:, 0], both[:, 1]


def line_keys(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Columns ``id``, ``tie``, ``h1``, ``h2``: the distinct non-empty keys of every document, one row each; ``tie`` is a hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, rows = [], []
            for row, text in enumerate(as_bytes(batch.column(1))):
                found = {k for k in map(line_key, text.split(b"\n")) if k}
                parts.extend(map(xxhash.xxh3_128_digest, found))
                rows.append(len(found))
            both = np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)
            owners = pa.array(np.repeat(np.arange(batch.num_rows), rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owners), batch.column(2).take(owners), pa.array(both[:, 0]), pa.array(both[:, 1])], names=["id", "tie", "h1", "h2"]
            )

    kept = docs.select(id_column, text_column, F.xxhash64(text_column).alias("tie"))
    return kept.mapInArrow(run, f"id {kept.schema[id_column].dataType.simpleString()}, tie long, h1 long, h2 long")


def drop_frequent_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_docs: int = 10, min_chars: int = 1
) -> DataFrame:
    """Every row of ``docs`` with its text freed of lines whose key at least ``min_docs`` documents hold.

    Adds ``_kept_text`` (the other lines in their order, joined by line breaks), ``_n_lines`` and ``_n_dropped``; all columns of
    ``docs`` are kept as they are, but for columns of these three names, which are replaced. Lines are split at ``\\n`` only. A null or empty text is one empty line. Empty keys, and those
    under ``min_chars`` code points, never count. A document counts once for a line however often it repeats it; every
    row counts as a document, also where rows repeat an id or lack one.

    Keys are counted by 128-bit hash with a fold before the shuffle. Only ids and hashes are joined with the
    frequent keys, a join that may split a hot key; every document then gets the few frequent keys it holds, by its id and
    a hash of its text, so that rows that share an id or lack one don't meet.
    """
    if min_chars < 1:
        raise ValueError("empty lines are never keys")
    docs = docs.drop("_kept_text", "_n_lines", "_n_dropped")
    keys = line_keys(docs, id_column, text_column)
    frequent = keys.groupBy("h1", "h2").count().where(F.col("count") >= min_docs).select("h1", "h2")
    frequent = materialise(frequent, "frequent")
    hits = keys.join(frequent, ["h1", "h2"], "left_semi").groupBy("id", "tie").agg(F.collect_set(F.struct("h1", "h2")).alias("_keys"))
    hits = hits.select("id", "tie", F.col("_keys.h1").alias("_h1"), F.col("_keys.h2").alias("_h2"))
    same = docs[id_column].eqNullSafe(hits["id"]) & (F.xxhash64(docs[text_column]) == hits["tie"])
    joined = docs.join(hits, same, "left").drop(hits["id"], hits["tie"])
    at = docs.columns.index(text_column)
    # positions of columns, not names: the table may have columns of any name
    width = len(docs.columns)
    names = [*docs.columns, "_kept_text", "_n_lines", "_n_dropped"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, dropped = [], [], []
            h1, h2 = batch.column(width), batch.column(width + 1)
            for row, text in enumerate(as_bytes(batch.column(at))):
                lines = text.split(b"\n")
                counts.append(len(lines))
                if h1[row].is_valid:
                    bad = set(zip(h1[row].as_py(), h2[row].as_py(), strict=True))
                    a, b = key_hashes(lines)
                    keep = [
                        x
                        for x, k in zip(lines, zip(a.tolist(), b.tolist(), strict=True), strict=True)
                        if k not in bad or (min_chars > 1 and len(line_key(x).decode()) < min_chars)
                    ]
                else:
                    keep = lines
                dropped.append(counts[-1] - len(keep))
                texts.append(b"\n".join(keep).decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                names=names,
            )

    added = T.StructType().add("_kept_text", "string").add("_n_lines", "long").add("_n_dropped", "long")
    schema = T.StructType([*docs.schema.fields, *added.fields])
    return joined.mapInArrow(run, schema)
