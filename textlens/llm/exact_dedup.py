"""Exact duplicates by two-pass Bloom filtering.

The first pass puts 64 bits of every text's digest into a Bloom filter whose bits know two states beside
"never": met once, met again. A text that occurs twice has met all its bits again, so the second pass lets
a row through as unique when one of its bits has not. Only the other rows are shuffled and grouped by the
whole digest; the filter decides nothing else, so its false alarms cost work and never a result.

The filter is cut into blocks of ``BLOCK_BITS`` by the leading bits of the hash; a task sends each of its
distinct hashes to its block once (eight bytes a text, and a flag if the task met it again), and the block's
bits are set there. Blocks reach the rows as a broadcast table of at most ``max_filter_bytes``. A corpus
that needs a larger filter is read in so many rounds, each for one range of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm.common import binaries, id_text, packed, rows, small_batches, unpacked, written

#: Bits of a block of the filter, bits a text gets, and bits each hash sets.
BLOCK_BITS, BITS_PER_TEXT, PROBES = 1 << 15, 16, 3
WORDS = BLOCK_BITS // 64
#: Largest filter that is broadcast at once.
MAX_FILTER_BYTES = 256 << 20
#: Hashes a task holds before it sends them, and about how many meet in one task that sets bits.
HELD, PER_BUCKET = 1 << 20, 1 << 20
#: Groups of more than one in ``HOT_SHARE`` of the rows are joined by broadcast: there are at most ``HOT_SHARE``.
HOT_SHARE = 10_000
#: Repeated rows of one id and text that are unrolled at once.
UNROLLED = 1 << 16

_lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_record = np.dtype([("hash", "<u8"), ("again", "<u8")])


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, hash) of ``docs`` (doc_id, text): SHA-256 of the text in UTF-8 with A-Z as a-z,
    and its first 64 bits."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [hashlib.sha256((t or b"").translate(_lower)).digest() for t in binaries(b.column(1))]
            heads = np.frombuffer(b"".join(d[:8] for d in found), "<i8")
            yield rows({"doc_id": b.column(0), "digest": pa.array(found, pa.binary()), "hash": pa.array(heads, pa.int64())})

    return docs.mapInArrow(digest, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest binary, hash long")


def _bits(hashes: np.ndarray) -> np.ndarray:
    """The places of each hash in its block, from its low bits (the block comes from the others)."""
    size = BLOCK_BITS.bit_length() - 1
    return np.stack([(hashes >> np.uint64(size * i)) & np.uint64(BLOCK_BITS - 1) for i in range(PROBES)], 1).astype(np.int64)


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """``blocks`` is a power of two of at most 2**18, so block and places use different bits."""
    return (hashes >> np.uint64(64 - 18)) & np.uint64(blocks - 1)


def filter_blocks(hashes: DataFrame, n: int, blocks: int) -> DataFrame:
    """(block, words): the bits that were met again, 64 to a word, of every block that has any.

    ``hashes`` has one column, and about ``n`` rows. A hash that fills a third of the rows comes once from
    each task, so no block's group grows with it.
    """
    buckets = max(1, min(blocks, -(-n // PER_BUCKET)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            found, count = np.unique(np.concatenate(held), return_counts=True)
            records = np.zeros(len(found), _record)
            records["hash"], records["again"] = found, count > 1
            return packed(records, _block(found, blocks), buckets)

        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += b.num_rows
            if size >= HELD:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, again = {}, {}
        for b in batches:
            records = unpacked(pa.table({"records": b.column("records")}), _record)
            records = records[np.argsort(_block(records["hash"], blocks), kind="stable")]
            block = _block(records["hash"], blocks)
            for part in np.split(records, np.flatnonzero(np.diff(block)) + 1):
                k = int(_block(part["hash"][:1], blocks)[0])
                if k not in once:
                    once[k], again[k] = np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool)
                places = _bits(part["hash"])
                met = np.bincount(places.reshape(-1), minlength=BLOCK_BITS)
                again[k] |= (met > 1) | (once[k] & (met > 0))
                again[k][places[part["again"] > 0]] = True
                once[k] |= met > 0
        found = [k for k in again if again[k].any()]
        words = [np.packbits(again[k], bitorder="little").view("<i8") for k in found]
        yield rows({"block": pa.array(found, pa.int64()), "words": pa.array(list(words), pa.list_(pa.int64()))})

    sent = hashes.mapInArrow(send, "bucket int, records binary")
    return sent.groupBy("bucket").applyInArrow(build, "block long, words array<bigint>")


def maybe_repeated(digested: DataFrame, n: int, max_filter_bytes: int = MAX_FILTER_BYTES) -> list[DataFrame]:
    """``digested`` with the column ``maybe`` (all bits of the row's hash were met again), in as many
    parts as filters of ``max_filter_bytes`` are needed: a part has the rows of one range of hashes."""
    limit = 1 << max(0, min(18, (max_filter_bytes * 8 // BLOCK_BITS).bit_length() - 1))
    need = 1 << max(0, (-(-n * BITS_PER_TEXT // BLOCK_BITS) - 1).bit_length())
    rounds, blocks = max(1, need // limit), min(need, limit)
    size = BLOCK_BITS.bit_length() - 1
    parts = []
    for r in range(rounds):
        part = digested.where(F.pmod(F.xxhash64("digest"), F.lit(rounds)) == r) if rounds > 1 else digested
        filled = filter_blocks(part.select("hash"), -(-n // rounds), blocks).select(F.col("block").alias("b"), "words")
        filled = written(filled, "bloom")
        block = F.shiftrightunsigned("hash", 64 - 18).bitwiseAND(F.lit(blocks - 1))
        seen = part.join(F.broadcast(filled), block == F.col("b"), "left")  # at most max_filter_bytes
        met = F.col("words").isNotNull()
        for i in range(PROBES):
            place = F.shiftrightunsigned("hash", size * i).bitwiseAND(F.lit(BLOCK_BITS - 1))
            word = F.get("words", F.shiftright(place, 6).cast("int"))
            met = met & F.coalesce(F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))
        parts.append(seen.select(*digested.columns, met.alias("maybe")))
    return parts


def exact_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """For each row of ``docs``: doc_id, keep_id (the largest doc_id among rows of equal text),
    group_size (rows of equal text), kept and text_sha256.

    Texts are equal when they are identical after lower-casing A-Z only; a null text counts as empty.
    Null ids are smaller than all others: such a row is kept only in a group without other ids, with a
    null keep_id. Of repeated rows with the id that stays one is kept. Only the id and text columns are
    read, so no other column can clash. An empty table gives no rows.
    """
    small_batches(spark)
    digested = written(digests(id_text(docs, id_col, text_col)), "digests")
    n = digested.count()
    out = None
    for part in maybe_repeated(digested, n, max_filter_bytes):
        part = written(part, "maybe")
        alone = part.where("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
        both = alone.unionByName(_grouped(part.where("maybe").select("doc_id", "digest"), n))
        out = both if out is None else out.unionByName(both)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _grouped(suspects: DataFrame, n: int) -> DataFrame:
    """The same columns for the rows that may be repeated, by their whole digests."""
    # equal rows become one with a count; a large group stays spread by its ids
    counted = written(suspects.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("times")), "counted")
    groups = counted.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size"))
    hot = F.col("group_size") > max(1, n // HOT_SHARE)
    some = counted.join(F.broadcast(groups.where(hot).select(F.col("digest").alias("d"), F.lit(True).alias("hot"))), F.col("digest") == F.col("d"), "left").drop("d")
    shared = some.where("hot").drop("hot").join(F.broadcast(groups.where(hot)), "digest")
    rest = some.where("hot is null").drop("hot").join(groups.where(~hot), "digest")
    every = shared.unionByName(rest)
    # unroll the counts again, in two steps so that no array is long
    turns = every.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {UNROLLED}"))))
    last = F.least(F.lit(UNROLLED - 1).cast("long"), F.col("times") - 1 - F.col("turn") * UNROLLED)
    each = turns.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 0) & (F.col("at") == 0)
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")
