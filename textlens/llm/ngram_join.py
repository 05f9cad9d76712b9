"""N-gram Jaccard join with set-relation skipping.

Every document becomes the set of its hashed word shingles; equal sets are one set from then on.
A set is indexed under its rarest shingles (the prefix that any partner above the threshold must
meet), so lists of common passages and lines stay out of the index. Index lists are sorted by size
and cut in blocks; within a block, and by the shingles' positions in the two sets, entries that cannot
reach the threshold are skipped.

Links are then found from set relations instead of from all pairs of a list:

1. In each block every set is compared with one leader only. Sets that link to their leader form
   its star, whose members' differences from the leader are known.
2. Leaders whose stars meet in a list and are not yet connected are compared once. The overlap of two
   members differs from their leaders' overlap by at most the members' own differences, so for
   nearly all stars this one number decides about all their pairs: linked, or none can be.
3. Only where it does not decide, members that meet in a list are compared, again behind that bound.

All numbers that move grow with the sets that share rare shingles, never with the square of a
group of copies. Overlaps are computed from whole sets, so links are exact (up to equality of
64-bit hashes).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textlens.llm.common import binaries, id_text, mix64, shards, small_batches, written
from textlens.llm.graph import components
from textlens.llm.hashing import U64, shingle_sets

SHARD_BYTES = 6 << 20
#: Bytes of text for each bucket of index lists at most; a bucket's entries are about as large.
BUCKET_BYTES = 64 << 20
#: Counters of the shingle count sketch: about one for this many shingles, within these powers of two.
PER_COUNTER, LEAST_LOG, MOST_LOG = 128, 16, 21
SKETCH_BLOCKS = 64
#: A shingle counts as common if its counter is this many deviations above the mean.
DEVIATIONS = 8
#: Bits of the filter that picks the sets to compare: this many for each, within these powers of two.
PER_SET, LEAST_BITS, MOST_BITS = 16, 16, 27

POSTING = np.dtype([("token", "<i8"), ("set", "<i8"), ("size", "<i4"), ("at", "<i4")])
LONG, INT = pa.int64(), pa.int32()


def needed(a, b, percent: int):
    """The least overlap of linked sets of sizes ``a`` and ``b``: the threshold as whole numbers."""
    return -((-percent * (a + b)) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


def set_id(s: np.ndarray) -> int:
    """One number for a set of shingle hashes; equal sets have equal ones. 0 for the empty set."""
    if not len(s):
        return 0
    total = mix64(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64, keepdims=True)
    return int(mix64(total + U64(len(s))).view(np.int64)[0])


def _sets(texts, k: int) -> Iterator[np.ndarray]:
    return shingle_sets([t or b"" for t in texts], k)


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _survey(docs: DataFrame, k: int, log: int) -> DataFrame:
    """Rows of two kinds. For each document: doc_id, row, size, set. For each block of the sketch and task:
    block, counts (one byte each, at most 255, compressed by the shuffle)."""

    def survey(batches):
        counts = np.zeros(1 << log, np.int64)
        for shard in shards(batches, SHARD_BYTES):
            size, sid, all_sets = [], [], []
            for s in _sets(binaries(shard.column("text").combine_chunks()), k):
                size.append(len(s))
                sid.append(set_id(s))
                all_sets.append(s)
            counts += np.bincount((np.concatenate(all_sets) >> U64(64 - log)).astype(np.int64), minlength=1 << log)
            n = len(size)
            yield _batch({"doc_id": shard.column("doc_id").combine_chunks(), "row": shard.column("row").combine_chunks(), "size": pa.array(size, INT), "set": pa.array(sid, LONG), "block": pa.nulls(n, INT), "counts": pa.nulls(n, pa.binary())})
        if counts.any():
            blocks = np.minimum(counts, 255).astype(np.uint8).reshape(SKETCH_BLOCKS, -1)
            none = pa.nulls(SKETCH_BLOCKS, INT)
            yield _batch({"doc_id": none.cast(doc_type), "row": none.cast(LONG), "size": none, "set": none.cast(LONG), "block": pa.array(range(SKETCH_BLOCKS), INT), "counts": pa.array([b.tobytes() for b in blocks], pa.binary())})

    kind = docs.schema["doc_id"].dataType
    doc_type = to_arrow_type(kind)
    return docs.mapInArrow(survey, f"doc_id {kind.simpleString()}, row long, size int, set long, block int, counts binary")


def _ranks(survey: DataFrame, log: int) -> np.ndarray:
    """For each counter how common its shingles are: 0 for all but the far outliers, then by powers of
    two. ``1 << MOST_LOG`` bytes at most, whatever the corpus."""

    def add(key, table):
        total = sum(np.frombuffer(c.as_py(), np.uint8).astype(np.int64) for c in table.column("counts"))
        return pa.table({"block": pa.array([key[0].as_py()], INT), "counts": pa.array([total.tobytes()], pa.binary())})

    rows = survey.where("block is not null").select("block", "counts").groupBy("block").applyInArrow(add, "block int, counts binary").collect()
    counts = np.zeros((SKETCH_BLOCKS, (1 << log) // SKETCH_BLOCKS))
    for r in rows:
        counts[r["block"]] = np.frombuffer(r["counts"], np.int64)
    usual = np.median(counts)
    limit = DEVIATIONS * max(np.sqrt(usual), 2)
    over = (counts.reshape(-1) - usual) / limit
    return np.where(over > 1, np.ceil(np.log2(np.maximum(over, 1))) + 1, 0).astype(np.uint8)


def _postings(docs: DataFrame, k: int, percent: int, log: int, ranks, buckets: int) -> DataFrame:
    """(bucket, postings): the prefix entries of all distinct sets of a shard, packed by bucket."""

    def index(batches):
        rank = ranks.value
        for shard in shards(batches, SHARD_BYTES):
            seen, parts = set(), []
            for s in _sets(binaries(shard.column("text").combine_chunks()), k):
                sid, n = set_id(s), len(s)
                if not n or sid in seen:
                    continue
                seen.add(sid)
                r = rank[(s >> U64(64 - log)).astype(np.int64)]
                if r.any():
                    s = s[np.argsort(r, kind="stable")]
                m = prefix_length(n, percent)
                p = np.empty(m, POSTING)
                p["token"], p["set"], p["size"], p["at"] = s[:m].view(np.int64), sid, n, np.arange(m)
                parts.append(p)
            if not parts:
                continue
            p = np.concatenate(parts)
            bucket = (p["token"].view(U64) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            p, edge = p[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(edge))
            yield _batch({"bucket": pa.array(some, INT), "postings": pa.array([p[edge[b] : edge[b + 1]].tobytes() for b in some], pa.binary())})

    return docs.mapInArrow(index, "bucket int, postings binary")


LIST = "token long, set long, size int, at int, leader long, leader_size int"


def _lists(postings: DataFrame, percent: int) -> DataFrame:
    """Index lists with at least two sets, an entry a row. leader: the set of the entry's block to
    compare it with (null: the leader itself, or by position or size the two cannot link here)."""

    def join(key, table):
        p = np.concatenate([np.frombuffer(x, POSTING) for x in table.column("postings").to_pylist()])
        p = p[np.argsort(p["token"], kind="stable")]
        same = p["token"][1:] == p["token"][:-1]
        p = p[np.append(same, False) | np.append(False, same)]
        p = p[np.lexsort((p["set"], p["size"], p["token"]))]
        if len(p):  # copies of one set from several shards are one entry
            p = p[np.append(True, (p["token"][1:] != p["token"][:-1]) | (p["set"][1:] != p["set"][:-1]))]
            same = p["token"][1:] == p["token"][:-1]
            p = p[np.append(same, False) | np.append(False, same)]
        size = p["size"].astype(np.int64)
        # a block: sizes of one list that the smallest of them could link with
        block, start = np.zeros(len(p), np.int64), 0
        token = p["token"]
        ends = np.append(np.flatnonzero(token[1:] != token[:-1]) + 1, len(p)) if len(p) else []
        n = 0
        for end in ends:
            while start < end:
                stop = start + int(np.searchsorted(size[start:end], size[start] * 100 // percent, "right"))
                block[start:stop] = n
                n, start = n + 1, stop
        # every list has a leader of its own, so a set meets many and a dense group is soon connected
        order = np.lexsort((mix64((p["set"] ^ p["token"]).view(U64)), block))
        head = order[np.searchsorted(block[order], block)] if len(p) else block
        at, least = p["at"].astype(np.int64), needed(size, size[head], percent)
        can = (head != np.arange(len(p))) & (at <= size - least) & (at[head] <= size[head] - least)
        return pa.table(
            {x: pa.array(p[x]) for x in ("token", "set", "size", "at")}
            | {"leader": pa.array(p["set"][head], LONG, mask=~can), "leader_size": pa.array(p["size"][head], INT, mask=~can)}
        )

    return postings.groupBy("bucket").applyInArrow(join, LIST)


def _picked_sets(docs: DataFrame, k: int, sets: DataFrame) -> DataFrame:
    """(set, shingles) of the given sets and, by a filter of bounded size, of a few others."""
    n = sets.count()
    log = int(np.clip(np.ceil(np.log2(max(n, 1) * PER_SET)), LEAST_BITS, MOST_BITS))
    blocks = 64

    def bits(batches):
        field = np.zeros(1 << log, bool)
        for b in batches:
            field[(b.column(0).to_numpy(zero_copy_only=False).view(U64) >> U64(64 - log)).astype(np.int64)] = True
        if field.any():
            packed = np.packbits(field).reshape(blocks, -1)
            yield _batch({"block": pa.array(range(blocks), INT), "field": pa.array([x.tobytes() for x in packed], pa.binary())})

    def either(key, table):
        x = np.bitwise_or.reduce([np.frombuffer(c.as_py(), np.uint8) for c in table.column("field")])
        return pa.table({"block": pa.array([key[0].as_py()], INT), "field": pa.array([x.tobytes()], pa.binary())})

    field = np.zeros((blocks, (1 << log) // 8 // blocks), np.uint8)
    for r in sets.select("set").mapInArrow(bits, "block int, field binary").groupBy("block").applyInArrow(either, "block int, field binary").collect():
        field[r["block"]] = np.frombuffer(r["field"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(field.tobytes())

    def pick(batches):
        field = np.unpackbits(np.frombuffer(shared.value, np.uint8))
        seen = set()
        for shard in shards(batches, SHARD_BYTES):
            found = []
            for s in _sets(binaries(shard.column("text").combine_chunks()), k):
                if len(s) and (sid := set_id(s)) not in seen and field[(sid % (1 << 64)) >> (64 - log)]:
                    seen.add(sid)
                    found.append((sid, s.tobytes()))
            yield _batch({"set": pa.array([x for x, _ in found], LONG), "shingles": pa.array([x for _, x in found], pa.binary())})

    # a set that several tasks hold comes from each; the smallest number of the task stays
    return docs.mapInArrow(pick, "set long, shingles binary").groupBy("set").agg(F.first("shingles").alias("shingles"))


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with both sets' sizes and their overlap."""
    both = pairs.join(sets.select(F.col("set").alias("b"), F.col("shingles").alias("in_b")), "b")
    both = both.join(sets.select(F.col("set").alias("a"), F.col("shingles").alias("in_a")), "a")

    def count(batches):
        for b in batches:
            x, y = ([np.frombuffer(t, U64) for t in b.column(i).to_pylist()] for i in (2, 3))
            n = [len(np.intersect1d(s, t, assume_unique=True)) for s, t in zip(x, y)]
            yield _batch({"a": b.column(0), "b": b.column(1), "size_a": pa.array(map(len, x), INT), "size_b": pa.array(map(len, y), INT), "overlap": pa.array(n, INT)})

    return both.select("a", "b", "in_a", "in_b").mapInArrow(count, "a long, b long, size_a int, size_b int, overlap int")


def _linked(percent: int, a: str, b: str, overlap: str) -> F.Column:
    return F.expr(f"{100 + percent} * cast({overlap} as long) >= {percent} * (cast({a} as long) + {b})")


def jaccard_components(
    spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, row (a hash of the text), n_shingles, component_id and first for each row of ``docs``: the
    size of its set of ``k``-word shingles, the smallest doc_id that it reaches by links, itself
    included, and whether it is the one row that can stand for all of these (repeated rows are alike).
    Two rows link when their sets' Jaccard similarity is ``percent`` percent or more.

    A text of fewer words is one shingle; null, empty and blank texts have size 0 and link with
    nothing. Repeated rows and ids stay one row each; equal texts are in one component. A null id
    counts as no id: its row links others, but it is named by the smallest id that is not null. Only the
    id and text columns are read. An empty table gives no rows.
    """
    small_batches(spark)
    docs = id_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    log = int(np.clip(np.ceil(np.log2(max(size / 6 / PER_COUNTER, 1))), LEAST_LOG, MOST_LOG))
    survey = written(_survey(docs, k, log), "survey")
    members = survey.where("block is null").select("doc_id", "row", F.col("size").cast("long").alias("n_shingles"), "set")
    ranks = spark.sparkContext.broadcast(_ranks(survey, log))
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    lists = written(_lists(_postings(docs, k, percent, log, ranks, buckets), percent), "lists")
    links = _links(docs, lists, k, percent)
    roots = components(links).select(F.col("node").alias("set"), "root")
    # every set's own component, named by its smallest doc_id; the empty set is no set
    some = members.where("n_shingles > 0").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    some = some.withColumn("rank", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    least = some.groupBy("root").agg(F.min("rank").alias("least"))
    named = some.join(least, "root").select("doc_id", "row", "n_shingles", F.col("least.doc_id").alias("component_id"), (F.col("rank") == F.col("least")).alias("first"))
    alone = members.where("n_shingles = 0").select("doc_id", "row", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return named.unionByName(alone)


def one_of_each(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` (all columns) with one row of each component, the one with the smallest doc_id; equal rows
    (id and text) are one. Rows without words are no copies of each other unless they are equal."""
    found = jaccard_components(spark, docs, k, percent).where("first").select(F.col("doc_id").alias("__join_id"), F.col("row").alias("__join_row")).distinct()
    row = F.xxhash64(docs["text"].cast("string"))
    kept = docs.join(found, docs["doc_id"].eqNullSafe(F.col("__join_id")) & (row == F.col("__join_row")))
    return kept.dropDuplicates(["__join_id", "__join_row"]).select(*[docs[c] for c in docs.columns])


def _may_link(percent: int, overlap: str, a: str, b: str) -> F.Column:
    """Sets of at least sizes ``a`` and ``b`` that share at most ``overlap`` shingles can link."""
    return F.expr(f"{100 + percent} * cast({overlap} as long) >= {percent} * (cast({a} as long) + {b})")


def _rest(size: str, percent: int) -> str:
    """Shingles of a set beyond its prefix."""
    return f"(({percent}L * {size} + 99) div 100 - 1)"


def _compared(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    pairs = written(pairs, "pairs")
    sets = pairs.select(F.col("a").alias("set")).union(pairs.select(F.col("b").alias("set"))).distinct()
    return written(_overlaps(pairs, _picked_sets(docs, k, sets)), "compared")


#: After the last shingle that two prefixes share, at most the rest of the shorter remainder can be common.
TAIL = "least(size_a - at_a, size_b - at_b)"


def _promising(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) out of their common index entries (a, b, size_a, at_a, size_b, at_b): those that
    start early enough and share enough of their prefixes to link."""
    start = F.max(F.expr(f"{100 + percent}L * {TAIL} >= {percent}L * (cast(size_a as long) + size_b)")).alias("start")
    met = entries.groupBy("a", "b", "size_a", "size_b").agg(F.count(F.lit(1)).alias("common"), F.min(F.expr(TAIL)).alias("tail"), start)
    most = f"common + least(tail - 1, greatest({_rest('size_a', percent)}, {_rest('size_b', percent)}))"
    return met.where("start").where(_may_link(percent, most, "size_a", "size_b")).select("a", "b")


def _leader_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(leader, set) pairs of the blocks that share enough of their prefixes."""
    pairs = written(lists.where("leader is not null").select(F.least("leader", "set").alias("a"), F.greatest("leader", "set").alias("b")).distinct(), "pairs")
    one, two = (lists.select("token", F.col("set").alias(c), F.col("size").alias(f"size_{c}"), F.col("at").alias(f"at_{c}")) for c in "ab")
    return _promising(pairs.join(two, "b").join(one, ["token", "a"]), percent)


def _stars(links: DataFrame) -> DataFrame:
    """(set, leader, out, least, most, star_out): for each linked set the leader that it overlaps most
    and how many of its shingles the leader lacks; leaders lead themselves. least, most, star_out:
    over the leader's star."""
    leaders = links.select(F.col("a").alias("set"), F.col("size_a").alias("size")).distinct()
    members = links.groupBy("b").agg(F.max(F.struct("overlap", "a", "size_b")).alias("m"))
    members = members.select(F.col("b").alias("set"), F.col("m.a").alias("leader"), F.col("m.size_b").alias("size"), (F.col("m.size_b") - F.col("m.overlap")).alias("out"))
    members = members.join(leaders.select("set"), "set", "left_anti")
    every = members.unionByName(leaders.select("set", F.col("set").alias("leader"), "size", F.lit(0).alias("out")))
    span = every.groupBy("leader").agg(F.min("size").alias("least"), F.max("size").alias("most"), F.max("out").alias("star_out"))
    return written(every.join(span, "leader"), "stars")


def _apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) that links do not connect yet."""
    roots, columns = components(links), pairs.columns
    for c in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    return pairs.where("root_a != root_b").select(*columns)


def _links(docs: DataFrame, lists: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) of sets that connect whatever all links connect."""
    won = _linked(percent, "size_a", "size_b", "overlap")
    # 1. leaders and their blocks
    first = _compared(docs, _leader_pairs(lists, percent), k)
    links = first.where(won)
    roots = components(links.select("a", "b")).withColumnRenamed("node", "set")
    stars = _stars(links.select("a", "b", "size_a", "size_b", "overlap"))
    entry = lists.select("token", "set", "size", "at").join(stars.drop("size"), "set", "left").join(roots, "set", "left")
    entry = entry.select(
        "token", "set", "size", "at", F.coalesce("leader", "set").alias("leader"), F.coalesce("root", "set").alias("root"),
        F.coalesce("out", F.lit(0)).alias("out"), F.coalesce("star_out", F.lit(0)).alias("star_out"),
        F.coalesce("least", "size").alias("least"), F.coalesce("most", "size").alias("most"), F.col("leader").isNull().alias("single"),
    )
    open_lists = entry.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 != r2").select("token")
    entry = written(entry.join(open_lists, "token"), "entries")
    # 2. leaders of different components whose stars meet in lists
    heads = entry.groupBy("token", "leader", "root", "least", "most", "star_out", "single").agg(F.max(F.col("size") - F.col("at")).alias("from"))
    x, y = heads.alias("x"), heads.alias("y")
    meet = x.join(y, F.expr(f"x.token = y.token and x.leader < y.leader and x.root != y.root and x.most * 100L >= y.least * {percent}L and y.most * 100L >= x.least * {percent}L"))
    # a shingle can be the first that linked members share if it and all after it are enough
    can_start = F.expr(f"{100 + percent}L * least(x.from, y.from) >= {percent}L * (x.least + y.least)")
    met = meet.groupBy(
        F.col("x.leader").alias("a"), F.col("y.leader").alias("b"), F.col("x.least").alias("least_a"), F.col("y.least").alias("least_b"),
        F.col("x.most").alias("most_a"), F.col("y.most").alias("most_b"), (F.col("x.star_out") + F.col("y.star_out")).alias("out"),
        F.expr("x.single and y.single").alias("single"),
    ).agg(F.count(F.lit(1)).alias("common"), F.max(can_start).alias("can_start"), F.min(F.expr("least(x.from, y.from)")).alias("tail"))
    # the tail after the last common shingle is known for single sets, for stars that of the prefixes
    rest = f"greatest({_rest('most_a', percent)}, {_rest('most_b', percent)})"
    most = f"common + if(single, least(tail - 1, {rest}), {rest})"
    met = written(met.where("can_start").where(_may_link(percent, most, "least_a", "least_b")).select("a", "b", "least_a", "least_b", "out", "single", "common"), "met")
    rest = met.select("a", "b", "common").join(first, ["a", "b"], "left_anti")
    pool = written(_picked_sets(docs, k, rest.select(F.col("a").alias("set")).union(rest.select("b")).distinct()), "sets")
    links, second = links.select("a", "b"), first.join(met.select("a", "b"), ["a", "b"], "left_semi")
    for last in (False, False, True):
        # at first each leader's likeliest partner only, then all pairs that this has not connected
        part = rest
        if not last:
            part = rest.groupBy("a").agg(F.max(F.struct("common", "b")).alias("m")).select("a", "m.b", "m.common")
            part = part.union(rest.groupBy("b").agg(F.max(F.struct("common", "a")).alias("m")).select("m.a", "b", "m.common")).distinct()
        got = written(_overlaps(part.select("a", "b"), pool), "compared")
        second = second.unionByName(got)
        links = links.union(got.where(won).select("a", "b"))
        if not last:
            links = written(links.distinct(), "links")
            rest = written(_apart(rest.join(got, ["a", "b"], "left_anti"), links), "rest")
    # 3. what the leaders' overlap leaves open, member by member, as far as still not connected
    undecided = met.join(second.where(~won).select("a", "b", "overlap"), ["a", "b"]).where("not single").where(_may_link(percent, "overlap + out", "least_a", "least_b"))
    undecided = written(undecided.select("a", "b", "overlap"), "undecided")
    if undecided.isEmpty():
        return links
    links = written(links.distinct(), "links")
    undecided = _apart(undecided, links)
    # members against the other leader: as many comparisons as the two stars have members, not pairs of them
    sizes = lists.select(F.col("set").alias("leader"), "size").distinct()
    people = stars.where("set != leader").select("leader", "set", "size", "out").unionByName(sizes.select("leader", F.col("leader").alias("set"), "size", F.lit(0).alias("out")))

    def sides(pairs):
        """Each member of either star of the pairs, with the other leader: (leader, other, set, size, out, overlap)."""
        ways = pairs.select(F.col("a").alias("leader"), F.col("b").alias("other"), "overlap").union(pairs.select("b", "a", "overlap"))
        return ways.join(people, "leader")

    def ordered(x, y):
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    def members_compared(pairs):
        ways = sides(pairs).where("set != leader").join(sizes.select(F.col("leader").alias("other"), F.col("size").alias("other_size")), "other")
        return _compared(docs, ways.where(_may_link(percent, "overlap + out", "size", "other_size")).select(*ordered("set", "other")).distinct(), k)

    closer = members_compared(undecided)
    links = written(links.union(closer.where(won).select("a", "b")).distinct(), "links")
    undecided = written(_apart(undecided, links), "undecided")
    # what is common to two members is common to one of them and the other's leader, or the leader lacks it
    near = closer.select("a", "b", F.col("overlap").alias("near"))
    side = sides(undecided).select("*", *ordered("set", "other")).join(near, ["a", "b"], "left")
    side = side.withColumn("near", F.when(F.col("set") == F.col("leader"), F.col("overlap")).otherwise(F.coalesce("near", F.col("overlap") + F.col("out"))))
    x, y = side.alias("x"), side.alias("y")
    both = x.join(y, F.expr("x.leader = y.other and x.other = y.leader and x.leader < y.leader"))
    both = both.where(_may_link(percent, "least(x.near + y.out, y.near + x.out)", "x.size", "y.size"))
    third = _compared(docs, both.select(*ordered("x.set", "y.set")).distinct(), k)
    return links.union(third.where(won).select("a", "b"))
