"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise part is computed in time linear in the
number of features by the sum-of-squares identity: half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2, summed over factors.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import as_bytes, narrow

WORD_BUCKETS = 1 << 14
BINS = 16
STATISTICS = (
    "bytes", "words", "upper", "digits", "marks", "symbols", "wide", "word_length", "distinct", "top_word",
    "lines", "repeated_lines", "closed_words", "bare_marks", "runs", "n_chars",
)
N_FEATURES = WORD_BUCKETS + BINS * len(STATISTICS)
#: Most labelled rows that a fit uses, those with the smallest hash of their id. Scores cover every row.
MAX_ROWS = 20_000

_MARKS = string.punctuation.encode()
_SYMBOLS = bytes(set(_MARKS) - set(b".,;:!?'\"()-"))
_UPPER, _DIGITS, _WIDE = string.ascii_uppercase.encode(), string.digits.encode(), bytes(range(128, 256))


def _share(part: int, whole: int) -> int:
    """Bin of a share, finer near zero: 0 for none, then by square root."""
    return 0 if part <= 0 or whole <= 0 else 1 + min(BINS - 2, int(math.sqrt(min(1.0, part / whole)) * (BINS - 1)))


def _size(n: int) -> int:
    return min(BINS - 1, int(n).bit_length() * 2 // 3)


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: words with l2-normalised counts, one bin of value one for each statistic."""
    tokens = text.split()
    counts: dict[bytes, int] = {}
    for t in text.lower().split():
        counts[t] = counts.get(t, 0) + 1
    cores: dict[int, int] = {}
    closed = bare = 0
    for word, n in counts.items():
        core = word.strip(_MARKS)
        if not core:
            bare += n
        elif len(word) - len(core) > 1:
            closed += n
        at = xxhash.xxh32_intdigest(core or word) % WORD_BUCKETS
        cores[at] = cores.get(at, 0) + n
    lines = text.split(b"\n")
    missing = lambda chars: len(text) - len(text.translate(None, chars))
    size, n_words = len(text), len(tokens)
    bins = (
        _size(size), _size(n_words), _share(missing(_UPPER), size), _share(missing(_DIGITS), size), _share(missing(_MARKS), size),
        _share(missing(_SYMBOLS), size), _share(missing(_WIDE), size), min(BINS - 1, size // max(1, n_words)), _share(len(counts), n_words),
        _share(max(counts.values(), default=0), n_words), _share(len(lines), n_words), _share(len(lines) - len(set(lines)), len(lines)),
        _share(closed, n_words), _share(bare, n_words), _share(sum(map(eq, tokens, tokens[1:])), n_words), BINS - 1 if n_chars is None else min(BINS - 2, _size(max(0, n_chars))),
    )
    ids = np.fromiter(cores.keys(), np.int32, len(cores))
    values = np.fromiter(cores.values(), np.float64, len(cores))
    if len(values):
        values /= np.sqrt((values * values).sum())
    structure = WORD_BUCKETS + np.arange(len(bins), dtype=np.int32) * BINS + np.array(bins, np.int32)
    return np.concatenate([ids, structure]).astype(np.int32), np.concatenate([values, np.ones(len(bins))])


@dataclass
class Machine:
    bias: float
    linear: np.ndarray  # (features,)
    factors: np.ndarray  # (features, k)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Probability of label 1 for each (feature numbers, values)."""
        out = np.empty(len(rows))
        for at in range(0, len(rows), 256):
            part = rows[at : at + 256]
            ids, x = np.concatenate([i for i, _ in part]), np.concatenate([v for _, v in part])
            starts = np.cumsum([0, *(len(i) for i, _ in part[:-1])])
            out[at : at + len(part)] = self._logits(ids, x, starts)[0]
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))

    def _logits(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vx = self.factors[ids] * x[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), starts)
        logits = self.bias + np.add.reduceat(self.linear[ids] * x, starts) + 0.5 * ((sums * sums).sum(axis=1) - squares)
        return logits, sums, vx

    def pack(self) -> bytes:
        return np.concatenate([[self.bias], self.linear, self.factors.ravel()]).astype("<f4").tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> Machine:
        flat = np.frombuffer(raw, "<f4").astype(np.float64)
        return cls(flat[0], flat[1 : 1 + N_FEATURES], flat[1 + N_FEATURES :].reshape(N_FEATURES, -1))

    @classmethod
    def blank(cls, k: int = 8, seed: int = 7) -> Machine:
        return cls(0.0, np.zeros(N_FEATURES), np.random.default_rng(seed).normal(0, 0.02, (N_FEATURES, k)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int = 8, epochs: int = 5, rate: float = 0.1, decay: float = 1e-5) -> Machine:
    """Logistic loss by AdaGrad over small batches in a fixed order."""
    model, rng = Machine.blank(k), np.random.default_rng(11)
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3) if len(labels) else 0.5
    model.bias = math.log(share / (1 - share))
    seen_w, seen_v = np.full(N_FEATURES, 1e-2), np.full((N_FEATURES, k), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 128):
            part = order[at : at + 128]
            ids, x = np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part])
            sizes = np.array([len(rows[i][0]) for i in part])
            logits, sums, vx = model._logits(ids, x, np.cumsum(sizes) - sizes)
            error = (1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels[part]) / len(part)
            gx = np.repeat(error, sizes) * x
            used, inverse = np.unique(ids, return_inverse=True)
            grad_w = np.bincount(inverse, gx, len(used)) + decay * model.linear[used]
            each = gx[:, None] * (np.repeat(sums, sizes, axis=0) - vx)
            grad_v = np.stack([np.bincount(inverse, each[:, f], len(used)) for f in range(k)], axis=1) + decay * model.factors[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            model.linear[used] -= rate * grad_w / np.sqrt(seen_w[used])
            model.factors[used] -= rate * grad_v / np.sqrt(seen_v[used])
            model.bias -= rate * error.sum()
    return model


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches whose first two columns are text and number of characters, with their rows' features."""
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            yield batch, [features(t, n) for t, n in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True)]


def _columns(docs: DataFrame, text_column: str, chars_column: str | None) -> list:
    chars = F.col(chars_column).cast("long") if chars_column and chars_column in docs.columns else F.lit(None).cast("long")
    return [F.col(text_column).alias("_text"), chars.alias("_chars")]


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", chars_column: str | None = "n_chars",
    label_column: str = "quality", max_rows: int = MAX_ROWS, k: int = 8, epochs: int = 5,
) -> Machine:
    """Fit on at most ``max_rows`` labelled documents, whole texts each.

    Labels other than 0 and 1 and labels without a document are left out; of several labels of an id the largest counts. The
    labelled ids are chosen by hash and, being bounded by ``max_rows``, broadcast to the scan of the documents; of rows that repeat a chosen id the one with
    the smallest hash of its text counts. The features of the chosen rows meet in one task, which ``max_rows`` bounds as well. Without any labelled document every score is 0.5.
    """
    asked = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
    asked = asked.groupBy(F.col(id_column).alias("_id")).agg(F.max(label_column).cast("double").alias("_label"))
    asked = asked.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    plain = docs.select(F.col(id_column).alias("_id"), *_columns(docs, text_column, chars_column))
    rows = plain.join(F.broadcast(asked), "_id").select("_text", "_chars", F.col("_id").cast("string"), "_label", F.xxhash64("_text", "_chars").alias("_tie"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _feature_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(3), batch.column(4), pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())],
                names=["id", "label", "tie", "ids", "x"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        got.sort(key=lambda r: (r[0], r[2]))
        rows = [(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], "<f4").astype(np.float64)) for r in got]
        model = train(rows, np.array([r[1] for r in got]), k, epochs) if got else Machine(0.0, np.zeros(N_FEATURES), np.zeros((N_FEATURES, k)))
        yield pa.RecordBatch.from_pydict({"model": pa.array([model.pack()], pa.binary())})

    found = rows.mapInArrow(extract, "id string, label double, tie long, ids binary, x binary")
    found = found.groupBy("id").agg(F.min_by(F.struct("label", "ids", "x"), F.struct("tie", "ids")).alias("r")).select("id", "r.label", "r.ids", "r.x")
    model = found.repartition(1).mapInArrow(learn, "model binary").first()
    return Machine.unpack(bytes(model["model"]))


def score(docs: DataFrame, model: Machine, text_column: str = "text", chars_column: str | None = "n_chars") -> DataFrame:
    """All columns of ``docs`` and ``_score``, the probability that a text is good. Null and empty texts are scored too.

    The model has a fixed size and goes to the tasks; rows are scored where they are read. No id, language or source takes part,
    so rows that repeat each other get equal scores. A column ``_score`` of the table is replaced.
    """
    docs = docs.drop("_score")
    spark: SparkSession = docs.sparkSession
    held = spark.sparkContext.broadcast(model.pack())
    names, n = [*docs.columns, "_score"], len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.unpack(held.value)
        for batch, found in _feature_batches(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[2 : 2 + n], pa.array(machine.score(found), pa.float64())], names=names)

    text, chars = _columns(docs, text_column, chars_column)
    placed = docs.select(text.alias("_text of the scorer"), chars.alias("_chars of the scorer"), *[docs[c] for c in docs.columns])
    return placed.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def held_in(column: str = "doc_id"):
    """Rows that may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col(column).cast("string")) % 3 != 1
