"""Small helpers shared by the text operators.

Text is handled as UTF-8 bytes inside tasks: ``bytes.lower`` and ``bytes.split``
touch exactly ``A-Z`` and the white space ``[\\x20\\x09-\\x0D]`` of the contracts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: str, mod: int) -> Column:
    """``crc32(id as text) mod m``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def hash_share(col: str, salt: str) -> Column:
    """A number in [0, 1) from the hash of a column: rows below a share are a sample of that share."""
    return F.pmod(F.xxhash64(F.col(col), F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)


def map_rows(df: DataFrame, schema: str, fn: Callable[[dict], dict], max_bytes: int = 4 << 20) -> DataFrame:
    """Run ``fn`` over column slices of at most ``max_bytes`` of text each.

    ``fn`` takes a dict of Python lists and returns one of the output columns.
    Only one slice is held in Python objects at a time, so memory does not
    follow Spark's Arrow batch size; a longer text makes a slice of its own.
    """
    target = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, max_bytes):
            out = fn({n: piece.column(i).to_pylist() for i, n in enumerate(piece.schema.names)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in target], schema=target
            )

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of at most ``max_bytes`` (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.zeros(n, dtype=np.int64)
        for col in batch.columns:
            if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
                sizes += np.diff(np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset : col.offset + n + 1])
        group = np.cumsum(sizes) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def keep_rows(docs: DataFrame, text: str, decide: Callable[[list], list], max_bytes: int = 4 << 20) -> DataFrame:
    """Keep the rows whose text ``decide`` answers with True; every column passes as it is."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, max_bytes):
            yield piece.filter(pa.array(decide(piece.column(at).to_pylist()), type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_POWERS = {"n": 0}
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, kept per worker."""
    if _POWERS["n"] < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            column = np.full(n, base, dtype=np.uint64)
            column[0] = 1
            _POWERS[name] = np.multiply.accumulate(column)
        _POWERS["n"] = n
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, over unsigned 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``buf[starts:ends]``, from one prefix sum."""
    up, down = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(buf: np.ndarray, blank: int = 0x20) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs that are not ``blank``."""
    edge = np.diff(np.concatenate(([0], (buf != blank).view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
