"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import materialise, new_run_dir, ship  # noqa: F401  (re-used by the operators)
from ..sources.tables import read_table  # noqa: F401


def shuffle_parts(spark: SparkSession, n_bytes: int = 0, each: int = 64 << 20) -> int:
    """Partitions for a hand-made exchange: the session's number, more where ``n_bytes`` asks for them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // each))


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that other columns of the table can't clash with an operator's own."""
    return docs.select(*columns)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Values of a string or binary Arrow column as bytes; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]
