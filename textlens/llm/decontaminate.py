"""Benchmark decontamination with suffix arrays over the training texts.

Documents are read in shards. In each shard the words become numbers (0 for words that no
benchmark item has) and a suffix array is built: the places, sorted by the words that follow.
Every test suffix is then binary-searched in it; the places that share its first words form one
range, and consecutive places of one item are the longest verbatim matches, with their locations.
A place whose next words occur in no benchmark item can match no test suffix, so it is left out
of the array before sorting; nothing else is left out. Each document lies whole in one shard, so
its answer is complete there and no row is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm.common import binaries, id_text, shards, small_batches

#: Text in one suffix array (a longer document has one alone), and benchmark text broadcast at once:
#: a larger benchmark is taken in several blocks, each against all documents.
SHARD_BYTES, BLOCK_BYTES = 6 << 20, 32 << 20

#: Byte to byte: A-Z lower-cased, 0-9, a-z and all of non-ASCII kept, the rest made spaces.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
SPAN = "struct<start:int,end:int>"
MATCH = "struct<item_id:string,start:int,item_start:int,n_words:int>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Windows:
    """The distinct windows of some benchmark items, as word numbers, and where the items have them."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        rows, self.n = [], n
        found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        self.ids = [item_id for item_id, _ in items]
        for k, (_, text) in enumerate(items):
            w = [number.setdefault(x, len(number) + 1) for x in words_of(text)]
            for j in range(max(1, len(w) - n + 1) if w else 0):
                found.setdefault(tuple(w[j : j + n]), []).append((k, j))
        rows = sorted(found)
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.low = _keys(np.array([(*r, *[0] * (n - len(r))) for r in rows], np.uint32).reshape(-1, n))
        top = 2**32 - 1
        self.high = _keys(np.array([(*r, *[top] * (n - len(r))) for r in rows], np.uint32).reshape(-1, n))
        # the owners of window i are owners[first[i]:first[i + 1]], each an (item, place in the item)
        self.owners = np.array([o for r in rows for o in found[r]], np.int64).reshape(-1, 2)
        self.first = np.concatenate([[0], np.cumsum([len(found[r]) for r in rows])]).astype(np.int64)
        # what a matching place starts with: a word alone, or the pairs of words 1-2 and 2-3
        self.single = np.array(sorted({r[0] for r in rows if len(r) == 1}), np.int64)
        size = len(number) + 1
        self.pairs = np.array(sorted({r[0] * size + r[1] for r in rows if len(r) > 1}), np.int64)
        self.pairs2 = np.array(sorted({r[1] * size + r[2] for r in rows if len(r) > 2}), np.int64)
        self.short = bool((self.sizes == 2).any())


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings that sort as the rows do."""
    width = rows.shape[1]
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * width}").reshape(-1)


def _in(values: np.ndarray, members: np.ndarray) -> np.ndarray:
    if not len(members):
        return np.zeros(len(values), bool)
    at = np.searchsorted(members, values)
    at[at == len(members)] = 0
    return members[at] == values


def suffix_array(words: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the suffixes that can match, and their places. ``words`` ends with ``w.n`` zeros."""
    n, size = w.n, len(w.vocabulary) + 1
    a, b, c = words[: -n or None], words[1 : len(words) - n + 1], words[2 : len(words) - n + 2] if n > 1 else None
    may = _in(a * size + b, w.pairs) & (a > 0) & (b > 0)
    if n > 2 and not w.short:
        at = np.flatnonzero(may)
        may[at[~_in(b[at] * size + c[at], w.pairs2)]] = False
    may |= _in(a, w.single) & (a > 0)
    at = np.flatnonzero(may)
    keys = _keys(words[at[:, None] + np.arange(n)].astype(np.uint32))
    order = np.argsort(keys, kind="stable")
    return keys[order], at[order]


def occurrences(words: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Every (place, window) where a window of the benchmark stands."""
    keys, places = suffix_array(words, w)
    low, high = np.searchsorted(keys, w.low, "left"), np.searchsorted(keys, w.high, "right")
    count = high - low
    window = np.repeat(np.arange(len(count)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return places[at], window


def longest(places: np.ndarray, window: np.ndarray, w: Windows) -> tuple[np.ndarray, ...]:
    """Maximal verbatim matches (item, place, place in the item, words): runs of windows that follow
    each other both in the text and in the item."""
    count = w.first[window + 1] - w.first[window]
    each = np.repeat(np.arange(len(window)), count)
    own = w.owners[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(w.first[window], count)]
    place, size = places[each], w.sizes[window[each]]
    item, j = own[:, 0], own[:, 1]
    order = np.lexsort((place, place - j, item))
    item, j, place, size = item[order], j[order], place[order], size[order]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1) | (j[1:] != j[:-1] + 1)
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(item)))
    return item[at], place[at], j[at], size[at] + run - 1


def _numbers(shard: pa.Table, w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a shard's texts as numbers, a 0 after each text; the texts' word counts and starts."""
    get = w.vocabulary.get
    numbers, sizes = [], []
    for text in binaries(shard.column("text").combine_chunks()):
        x = list(map(get, words_of(text), repeat(0)))
        sizes.append(len(x))
        numbers.append(np.array(x, np.int64))
        numbers.append(np.zeros(1, np.int64))
    sizes = np.array(sizes, np.int64)
    return np.concatenate([*numbers, np.zeros(w.n, np.int64)]), sizes, np.concatenate([[0], np.cumsum(sizes + 1)])


def _matches(shard: pa.Table, w: Windows) -> Iterator[pa.RecordBatch]:
    words, sizes, starts = _numbers(shard, w)
    places, window = occurrences(words, w)
    # covered words: +1 where a window starts, -1 where it ends
    edge = np.bincount(places, minlength=len(words) + 1) - np.bincount(places + w.sizes[window], minlength=len(words) + 1)
    hit = np.concatenate([[0], np.cumsum(edge) > 0, [0]]).astype(np.int8)
    turn = np.diff(hit)
    begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    item, place, j, length = longest(places, window, w)
    spans, matches = [[] for _ in sizes], [[] for _ in sizes]
    for d, b, e in zip(np.searchsorted(starts, begin, "right") - 1, begin.tolist(), end.tolist()):
        spans[d].append({"start": b - int(starts[d]), "end": e - int(starts[d])})
    for d, k, p, q, m in zip(np.searchsorted(starts, place, "right") - 1, item.tolist(), place.tolist(), j.tolist(), length.tolist()):
        matches[d].append({"item_id": w.ids[k], "start": p - int(starts[d]), "item_start": q, "n_words": m})
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    match = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int32()), ("item_start", pa.int32()), ("n_words", pa.int32())]))
    columns = [shard.column("doc_id").combine_chunks(), shard.column("row").combine_chunks(), pa.array(sizes), pa.array(spans, span), pa.array(matches, match)]
    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_words", "spans", "matches"])


def _blocks(spark: SparkSession, benchmark: DataFrame, n: int) -> Iterator:
    """Broadcast windows of the benchmark, in blocks of about ``BLOCK_BYTES`` of text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()
        block = sorted(((r["item_id"], r["text"].encode()) for r in block if r["text"]), key=lambda x: (x[0] or "", x[1]))
        yield spark.sparkContext.broadcast(Windows(block, n))


def verbatim_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (a hash of the text), n_words, spans (disjoint word ranges inside occurrences of
    benchmark windows) and matches (maximal verbatim matches: item_id, start, item_start, n_words)
    for each row of ``docs``.

    A window is ``n`` consecutive words of an item, or the whole item if it has fewer (and some).
    Null and empty texts have no words; items without words match nothing; an empty benchmark
    gives no spans, an empty ``docs`` no rows. A null item id takes part but has a null id in
    ``matches``. Repeated rows and ids stay one row each. Only the id and text columns are read.
    """
    small_batches(spark)
    docs = id_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row long, n_words long, spans array<{SPAN}>, matches array<{MATCH}>"
    found = None
    blocks = 0
    for windows in _blocks(spark, benchmark, n):
        blocks += 1

        def match(batches, windows=windows):
            for shard in shards(batches, SHARD_BYTES):
                yield from _matches(shard, windows.value)

        part = docs.mapInArrow(match, schema)
        found = part if found is None else found.unionByName(part)
    if blocks == 1:
        return found
    return _merged(found, blocks)


def _merged(found: DataFrame, blocks: int) -> DataFrame:
    """One row for each row of the documents again, from the rows of the blocks. Equal rows have
    equal answers, so a group of them is made one row and then as many as they are."""
    one = found.groupBy("doc_id", "row").agg(
        F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("raw"),
        F.array_distinct(F.flatten(F.collect_set("matches"))).alias("matches"),
    )
    spans = F.expr(
        "aggregate(raw, cast(array() as array<struct<start:int,end:int>>), (a, s) -> "
        "if(size(a) > 0 and s.start <= element_at(a, -1).end, "
        "concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end)))), "
        "concat(a, array(s))))"
    )
    one = one.withColumn("spans", spans).withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("copies") / blocks).cast("int"))))
    return one.select("doc_id", "row", "n_words", "spans", "matches")


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, n_words, n_hit (words inside an occurrence of a window), items (distinct non-null
    ids of the items that occur, as strings in order), longest (words of the longest verbatim match,
    0 if none) and contaminated (n_hit > 0), one row for each row of ``docs``; other cases as in
    ``verbatim_matches``."""
    found = verbatim_matches(spark, docs, benchmark, n, id_col, text_col)
    return found.select(
        "doc_id",
        "row",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"),
        F.array_sort(F.array_distinct(F.filter("matches.item_id", lambda x: x.isNotNull()))).alias("items"),
        F.coalesce(F.array_max("matches.n_words"), F.lit(0)).alias("longest"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The rows of ``docs`` (all columns, as they are) whose ``text`` holds no window of the benchmark.
    Rows without words stay."""
    small_batches(spark)
    for windows in _blocks(spark, benchmark, n):

        def keep(batches, windows=windows):
            for shard in shards(batches, SHARD_BYTES):
                words, sizes, starts = _numbers(shard, windows.value)
                clean = np.ones(len(sizes), bool)
                clean[np.searchsorted(starts, occurrences(words, windows.value)[0], "right") - 1] = False
                yield from shard.filter(pa.array(clean)).to_batches()

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
