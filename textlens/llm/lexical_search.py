"""Ranked lexical search with a document FP-tree and branch-and-bound.

One pass over the documents keeps of each its restricted vector: the terms that some item asks for, with
their counts. Document frequencies over all documents then order the terms, the most frequent first. A shard
of documents becomes a tree: vectors in that order, sorted, share their leading terms, so a node of the tree is
a range of documents with a common path. A node knows the largest count of each term among its documents and
the smallest ``m``; with both put into the score's formula no document below it can score more. The search
goes depth first and leaves a subtree out for each item whose tenth best score so far it cannot reach; leaves of
at most ``LEAF`` documents are scored exactly. Items share one walk: each node is tried for those still open.

A first walk over one shard in ``SEED`` gives every item a score that its tenth best document reaches at
least, so the tasks of the second walk send almost only documents that matter.

Scores are sums of integers. They are added as doubles while every possible sum is below 2**53, where that is
exact, else as 64-bit integers.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlens.llm.common import binaries, rows, small_batches, table_of, written

#: Documents listed for each item.
TOP = 10
#: Documents of a leaf that are scored at once, and pairs of document and term in a shard's tree.
LEAF, SHARD_PAIRS = 16, 2_000_000
#: Distinct terms and items of a block of items: its table of weights has at most that product's entries.
BLOCK_TERMS, BLOCK_ITEMS = 1 << 14, 1 << 8
#: Blocks whose vectors are gathered in one pass over the documents.
PASS_TERMS = 1 << 17
#: One file in so many is searched first, for thresholds.
SEED = 32
#: Fixed values of the score.
SCALE, K1000, SLOPE = 1_000_000_000, 1000, 75

_terms_only = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
VECTORS = "n long, terms binary, counts binary"


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters (A-Z as a-z), digits and all other characters from U+0080 on."""
    return (text or b"").translate(_terms_only).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one unit of a term's weight is worth in a document: grows with tf, falls with m."""
    return SCALE * tf // (K1000 * tf + 8 * m)


# ---------------------------------------------------------------- items


def item_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Blocks of (item_id, term counts); each has bounded numbers of items and terms. One item with more
    terms than a block has a block of its own."""
    block, terms = [], set()
    for r in items.toLocalIterator():
        counts = Counter(terms_of(bytes(r["text"])) if r["text"] is not None else ())
        if not counts:
            continue
        if block and (len(block) >= BLOCK_ITEMS or len(terms | counts.keys()) > BLOCK_TERMS):
            yield block
            block, terms = [], set()
        block.append((r["item_id"], counts))
        terms |= counts.keys()
    if block:
        yield block


def passes(blocks: Iterator[list[tuple]]) -> Iterator[list[list[tuple]]]:
    """Blocks whose terms are looked up together."""
    held, size = [], 0
    for block in blocks:
        n = len({t for _, counts in block for t in counts})
        if held and size + n > PASS_TERMS:
            yield held
            held, size = [], 0
        held.append(block)
        size += n
    if held:
        yield held


# ---------------------------------------------------------------- vectors


def restricted_vectors(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: all its terms are counted in n, those in
    ``number`` are listed by their numbers (int32) with their counts (int64)."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(number)  # at most PASS_TERMS terms, or those of one item

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        for b in batches:
            ids, sizes, terms, counts = [], [], [], []
            for i, text in enumerate(binaries(b.column(1))):
                found = terms_of(text)
                if found:
                    some = Counter(x for x in map(known.get, found) if x is not None)
                    ids.append(i)
                    sizes.append(len(found))
                    terms.append(np.fromiter(some.keys(), np.int32, len(some)).tobytes())
                    counts.append(np.fromiter(some.values(), np.int64, len(some)).tobytes())
            yield rows({"doc_id": b.column(0).take(pa.array(ids, pa.int64())), "n": pa.array(sizes, pa.int64()), "terms": pa.array(terms, pa.binary()), "counts": pa.array(counts, pa.binary())})

    return docs.mapInArrow(restrict, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {VECTORS}")


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; tasks add up their own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32), minlength=size)
        some = np.flatnonzero(total)
        yield rows({"term": pa.array(some, pa.int64()), "df": pa.array(total[some], pa.int64())})

    out = np.zeros(size, np.int64)
    for r in vectors.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["term"]] = r["df"]
    return out


# ---------------------------------------------------------------- tree


class Tree:
    """The documents of a shard, sorted by their restricted vectors (rank numbers, ascending)."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: list, m: list[int], leaf: int = LEAF):
        self.leaf = leaf
        order = sorted(range(len(vectors)), key=lambda i: vectors[i][0].astype(">u4").tobytes())
        self.ids = [ids[i] for i in order]
        self.m = np.array([m[i] for i in order], np.int64)
        self.size = np.array([len(vectors[i][0]) for i in order], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.terms = np.concatenate([np.zeros(0, np.int64), *(vectors[i][0] for i in order)]).astype(np.int64)
        self.counts = np.concatenate([np.zeros(0, np.int64), *(vectors[i][1] for i in order)])
        self.gains = gain(self.counts, np.repeat(self.m, self.size)) if len(order) else self.counts

    def children(self, lo: int, hi: int, depth: int) -> Iterator[tuple[int, int, int]]:
        """(lo, hi, depth) of the nodes below the node of ``depth`` shared terms; small neighbours come
        together as leaves, and so do vectors that end here. A stretch without branches is passed at once."""
        while True:
            here, ends = np.full(hi - lo, -1, np.int64), self.size[lo:hi] > depth
            here[ends] = self.terms[self.first[lo:hi][ends] + depth]
            if here[0] < 0 or here[0] != here[-1]:  # sorted: the ends differ if any two do
                break
            depth += 1
        edges = [lo, *(np.flatnonzero(np.diff(here)) + lo + 1).tolist(), hi]
        start = lo
        for a, b in zip(edges, edges[1:]):
            if b - a > self.leaf:
                if a > start:
                    yield from self.leaves(start, a)
                if here[a - lo] < 0:
                    yield from self.leaves(a, b)  # equal vectors
                else:
                    yield a, b, depth + 1
                start = b
        if hi > start:
            yield from self.leaves(start, hi)

    def leaves(self, lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
        for a in range(lo, hi, self.leaf):
            yield a, min(hi, a + self.leaf), -1

    def bounds(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The terms below a node and the most that a unit of weight can be worth there."""
        a, b = self.first[lo], self.first[hi]
        most = np.zeros(int(self.terms[a:b].max()) + 1, np.int64)
        np.maximum.at(most, self.terms[a:b], self.counts[a:b])
        terms = np.flatnonzero(most)
        return terms, gain(most[terms], self.m[lo:hi].min())


class Best:
    """The best documents of each item so far, and the score that a further one has to reach."""

    def __init__(self, least: np.ndarray):
        self.heaps: list[list] = [[] for _ in least]
        self.least = least.copy()

    def add(self, item: int, score: int, doc_id) -> None:
        heap, entry = self.heaps[item], (score, _Later(doc_id))
        if len(heap) < TOP:
            heapq.heappush(heap, entry)
        elif heap[0] < entry:
            heapq.heapreplace(heap, entry)
        if len(heap) == TOP:
            self.least[item] = max(self.least[item], heap[0][0])


class _Later:
    """Ids in descending order, null as the largest: of equal scores the smallest id is the best."""

    __slots__ = ("id", "key")

    def __init__(self, doc_id):
        self.id, self.key = doc_id, (doc_id is None, 0 if doc_id is None else doc_id)

    def __lt__(self, other):
        return self.key > other.key

    def __eq__(self, other):
        return self.key == other.key


def search(tree: Tree, weights: np.ndarray, best: Best) -> None:
    """Depth first through the tree, for all items (columns of ``weights``, rows are terms) at once."""
    stack = [(0, len(tree.ids), 0, np.arange(weights.shape[1]))]
    while stack:
        lo, hi, depth, items = stack.pop()
        if hi - lo > 1:
            terms, most = tree.bounds(lo, hi)
            reach = most.astype(weights.dtype) @ weights[np.ix_(terms, items)]
            items = items[reach >= best.least[items]]
            if not len(items):
                continue
        if depth < 0 or hi - lo == 1:
            _score(tree, lo, hi, items, weights, best)
        else:
            stack.extend((a, b, d, items) for a, b, d in reversed(list(tree.children(lo, hi, depth))))


def _score(tree: Tree, lo: int, hi: int, items: np.ndarray, weights: np.ndarray, best: Best) -> None:
    for i in range(lo, hi):
        a, b = tree.first[i], tree.first[i + 1]
        score = tree.gains[a:b].astype(weights.dtype) @ weights[np.ix_(tree.terms[a:b], items)]
        for j in np.flatnonzero(score >= best.least[items]).tolist():
            best.add(int(items[j]), int(score[j]), tree.ids[i])


# ---------------------------------------------------------------- operator


def _weights(block: list[tuple], rank: dict[bytes, int], weight_of: dict[bytes, int]) -> np.ndarray:
    """Weight times repeats by term's rank and item; doubles if all sums of them are exact."""
    most = max(sum(weight_of[t] * k for t, k in counts.items()) for _, counts in block) * (SCALE // K1000)
    out = np.zeros((len(rank), len(block)), np.float64 if most < 2**53 else np.int64)
    for j, (_, counts) in enumerate(block):
        for t, k in counts.items():
            out[rank[t], j] = weight_of[t] * k
    return out


def _search_block(vectors: DataFrame, block: list[tuple], number: dict[bytes, int], df: np.ndarray, n_docs: int, n_terms: int, least: np.ndarray, leaf: int, shard_pairs: int) -> DataFrame:
    """(item, score, doc_id): the best documents of each task that reach the items' ``least`` scores."""
    names = sorted({t for _, counts in block for t in counts}, key=lambda t: (-df[number[t]], t))
    rank = {t: i for i, t in enumerate(names)}
    of_number = np.full(len(df), -1, np.int32)
    of_number[[number[t] for t in names]] = np.arange(len(names))
    weights = _weights(block, rank, {t: weight(n_docs, int(df[number[t]])) for t in names})
    shared = vectors.sparkSession.sparkContext.broadcast((of_number, weights))  # bounded by the block

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_number, weights = shared.value
        best = Best(least)
        held, ids, ms, pairs = [], [], [], 0
        id_type = None
        for b in batches:
            id_type = b.column(0).type
            for doc_id, n, t, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                terms, counts = of_number[np.frombuffer(t, np.int32)], np.frombuffer(c, np.int64)
                known = terms >= 0
                terms, counts = terms[known], counts[known]
                if not len(terms):
                    continue
                order = np.argsort(terms)
                held.append((terms[order], counts[order]))
                ids.append(doc_id)
                ms.append(100 - SLOPE + SLOPE * n * n_docs // n_terms)
                pairs += len(terms)
                if pairs >= shard_pairs:
                    search(Tree(held, ids, ms, leaf), weights, best)
                    held, ids, ms, pairs = [], [], [], 0
        if held:
            search(Tree(held, ids, ms, leaf), weights, best)
        found = [(j, s, d.id) for j, heap in enumerate(best.heaps) for s, d in heap]
        if found:
            item, score, doc_id = zip(*found)
            yield rows({"item": pa.array(item, pa.int64()), "score": pa.array(score, pa.int64()), "doc_id": pa.array(doc_id, id_type)})

    return vectors.mapInArrow(walk, f"item long, score long, doc_id {vectors.schema['doc_id'].dataType.simpleString()}")


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def lexical_search(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", leaf: int = LEAF, shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """item_id, rank, doc_id and score of the ten best documents of ``docs`` for each row of ``items``.

    With N documents that have a term, L terms in them, n terms in a document, df documents with a term and tf
    occurrences in one: a term's weight w is floor(1000*ln((2*N+2)/(2*df+1))), m is 25 + 75*n*N div L, and the
    score is the sum of w*(10**9*tf div (1000*tf+8*m)) over the item's terms, repeats included. Equal scores
    come by ascending doc_id, null last. Only scores above 0 are listed; an item with fewer such documents, or
    without terms, has fewer rows or none. Each row of a repeated item_id or doc_id counts for itself. Only
    the ids and texts are read. Empty tables give no rows.
    """
    small_batches(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").cast("binary").alias("text"))
    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long"
    out = spark.createDataFrame([], schema)
    for blocks in passes(item_blocks(items)):
        number = {t: i for i, t in enumerate(sorted({t for b in blocks for _, counts in b for t in counts}))}
        vectors = written(restricted_vectors(docs, number), "vectors")
        n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            return out
        df = document_frequencies(vectors, len(number))
        some = table_of(spark, sorted(vectors.inputFiles())[::SEED], vectors.schema)
        for block in blocks:
            least = np.ones(len(block), np.int64)
            seeds = _ranked(_search_block(some, block, number, df, n_docs, n_terms, least, leaf, shard_pairs)).where(F.col("rank") == TOP)
            for r in seeds.select("item", "score").collect():  # at most one for each item of the block
                least[r["item"]] = r["score"]
            found = written(_ranked(_search_block(vectors, block, number, df, n_docs, n_terms, least, leaf, shard_pairs)), "found")
            name = spark.createDataFrame([(j, item_id) for j, (item_id, _) in enumerate(block)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
            out = out.unionByName(found.join(F.broadcast(name), "item").select("item_id", "rank", "doc_id", "score"))
    return out
