"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.session import checkpoint_dir

#: Arrow batches that Python tasks get hold at most about this many bytes (a longer row comes alone).
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns the operators work on, so that no other column can clash with theirs."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows, unless the session already does."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, str(2**63 - 1), str(2**31 - 1)):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id's text modulo ``m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % m


def crc_mod_py(doc_id, m: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs do not recompute it and
    it outlives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_of(spark: SparkSession, files: list[str], schema) -> DataFrame:
    """Some of a table's files."""
    return spark.read.schema(schema).parquet(*files)


def binaries(column: pa.Array) -> list:
    """UTF-8 bytes of a string column, ``None`` for null; no decoding."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return column.to_pylist()


def shards(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.Table]:
    """Consecutive batches joined up to about ``max_bytes``."""
    held, size = [], 0
    for b in batches:
        if b.num_rows == 0:
            continue
        if held and size + b.nbytes > max_bytes:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
        held.append(b)
        size += b.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads the bits of ``uint64`` values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def packed(records: np.ndarray, key: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Records (a structured array) packed by bucket, ``key`` modulo ``buckets``: (bucket, records)."""
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    records, edge = records[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
    some = np.flatnonzero(np.diff(edge))
    return rows({"bucket": pa.array(some, pa.int32()), "records": pa.array([records[edge[b] : edge[b + 1]].tobytes() for b in some], pa.binary())})


def unpacked(table: pa.Table, kind: np.dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in table.column("records").to_pylist())])


def vector_blocks(vector: np.ndarray, blocks: int) -> pa.RecordBatch:
    """A task's share of a vector of counts in blocks (block, counts), for ``vector_sum``."""
    parts = vector.astype(np.int64).reshape(blocks, -1)
    return rows({"block": pa.array(range(blocks), pa.int32()), "counts": pa.array([p.tobytes() for p in parts], pa.binary())})


def vector_sum(parts: DataFrame, n: int, blocks: int) -> np.ndarray:
    """The sum of all tasks' vectors, added block by block on the executors; the driver gets ``n`` counts."""

    def add(key, table):
        total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((blocks, n // blocks), np.int64)
    for r in parts.groupBy("block").applyInArrow(add, "block int, counts binary").collect():
        out[r["block"]] = np.frombuffer(r["counts"], np.int64)
    return out.reshape(-1)
