"""Class sizes, quotas and splits.

The per-class "take the first n" of the original is a rank within a class.
A window ``partitionBy(class)`` would put a whole class into one task, and a
class may hold a third of all rows, so ``rank_within`` cuts every class into
buckets of neighbouring keys: a summary of the keys gives each class its
splitters (saved as a table), a row finds its bucket by binary search among
them, a small table of bucket sizes gives each bucket its offset (a running sum
over the buckets of a class), and a ``row_number`` inside (class, bucket) adds
the rest. The splitters are keys that occur, chosen by their hash, so buckets
hold about equally many rows whatever the keys look like: names with a common
prefix, sparse ids and far outliers spread as dense ids do. Everything is a
deterministic function of the data, so a recomputed task (after an executor
loss) gets the same ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.session import saved

TRAIN = "train"
TEST = "test"


#: About so many splitters at most over all groups: they are broadcast to the rows.
MAX_SPLITTERS = 1 << 18
#: Buckets need not be smaller than about so many rows.
BUCKET_ROWS = 1 << 12
#: The same where only keys are ranked.
KEY_ROWS = 1 << 16

MAX_BUCKETS_BITS = 20  # a seeded order has at most 2**20 buckets per class in the offset table
SHUFFLE_BITS = 52  # bits of a seeded order value: exact as a double


def seeded_order(seed: int, *cols) -> Column:
    """A repeatable order value in ``[0, 2**52)`` from the seed and the row's key. It depends on
    nothing else, so neither the partition layout nor a recomputed task changes it."""
    key = F.concat_ws("|", F.lit(str(int(seed))), *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, SHUFFLE_BITS // 4), 16, 10).cast("long")


def _same(df: DataFrame, cols, other: str) -> Column:
    """Null-safe equality of ``cols`` with the columns ``other0``, ``other1``, ..."""
    same = F.lit(True)
    for i, c in enumerate(cols):
        same = same & df[c].eqNullSafe(F.col(f"{other}{i}"))
    return same


def _key(order_cols) -> Column:
    """The ordering columns as one comparable value (nulls first)."""
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_cols)])


def splitters(df: DataFrame, part_cols, order_cols, bucket_rows: int | None = None, least: int = BUCKET_ROWS) -> DataFrame | None:
    """``(..part_cols, cuts)``: for each group with more than about ``bucket_rows`` rows the sorted keys
    that cut it into buckets of about that size, saved in the shared folder.

    A key is a splitter by its hash, one in ``bucket_rows`` of them; more than ``MAX_SPLITTERS`` over all
    groups are not expected, as the buckets grow with the table. None if all rows fit into one bucket.
    """
    if bucket_rows is None:
        n = df.count()
        if n <= least:
            return None
        bucket_rows = max(least, n // MAX_SPLITTERS)
    chosen = df.where(F.pmod(F.xxhash64(*order_cols, *part_cols), F.lit(int(bucket_rows))) == 0)
    keys = chosen.select(*part_cols, _key(order_cols).alias("key"))
    cuts = keys.groupBy(*part_cols).agg(F.sort_array(F.collect_set("key")).alias("cuts"))
    return saved(cuts.withColumn("zero", F.lit(0)), "splitters")


def _bucket(cuts: Column, key: Column) -> Column:
    """How many of the sorted ``cuts`` are at most ``key``, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in range(MAX_SPLITTERS.bit_length() + 1, -1, -1)])

    def step(at, n):
        here = at + n
        return F.when((here <= F.size(cuts)) & (F.get(cuts, here - 1) <= key), here).otherwise(at)

    return F.when(cuts.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), step))


def rank_within(df: DataFrame, part_cols, order_cols, bucket_bits: int | None = None, bucket_rows: int | None = None, least: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``rn`` (1-based) = rank of each row inside its ``part_cols`` group by ``order_cols``.

    The ordering columns are of any type that Spark orders (strings by their bytes, nulls first); the
    following ones break ties of the first. Exact; rows with a null group or key are ranked too.
    ``bucket_bits`` cuts a first column of integers that are spread evenly over their range (a seeded
    order) by its high bits instead of looking for splitters.
    """
    part_cols = [part_cols] if isinstance(part_cols, str) else list(part_cols)
    order_cols = list(order_cols)
    if bucket_bits is not None:
        x = df.withColumn("_b", F.shiftright(F.col(order_cols[0]).cast("long"), int(bucket_bits)))
    elif (cuts := splitters(df, part_cols, order_cols, bucket_rows, least)) is None:
        x = df.withColumn("_b", F.pmod(F.hash(*order_cols), F.lit(1)))  # one bucket, and still a key to join by
    else:
        cuts = cuts.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(part_cols)], F.col("cuts").alias("_cuts"), F.col("zero").alias("_zero"))
        # about MAX_SPLITTERS keys in all; the zero keeps this a hash join where all rows are one constant group
        same = _same(df, part_cols, "_s") & (F.pmod(F.hash(*order_cols), F.lit(1)) == F.col("_zero"))
        x = df.join(F.broadcast(cuts), same, "left")
        x = x.withColumn("_b", _bucket(F.col("_cuts"), _key(order_cols))).drop("_cuts", "_zero", *[f"_s{i}" for i in range(len(part_cols))])
    sizes = x.groupBy(*part_cols, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*part_cols, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*part_cols, "_b").orderBy(*order_cols)
    keys = [*part_cols, "_b"]
    offsets = offsets.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(keys)], "_off")
    out = x.join(offsets, _same(x, keys, "_o")).withColumn("rn", F.col("_off") + F.row_number().over(inside))
    return out.drop("_b", "_off", *[f"_o{i}" for i in range(len(keys))])


def class_sizes(corpus: DataFrame) -> DataFrame:
    """``(class, n)`` documents per class."""
    return corpus.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def quotas(corpus: DataFrame, pick_pct: int = 100, balanced: bool = False, cap: int | None = None) -> DataFrame:
    """``(class, n, quota)``.

    Proportional: ``n * pct div 100``. Balanced: every class gets
    ``smallest class * pct div 100``; with ``cap`` at most ``cap * pct div 100``.
    """
    sizes = class_sizes(corpus)
    if balanced:
        # K rows: a global window over the class table is one small task
        smallest = F.min("n").over(Window.partitionBy())
        most = "_m" if cap is None else f"least({int(cap)}, _m)"
        quota = F.expr(f"cast({most} * {int(pick_pct)} div 100 as long)")
        return sizes.withColumn("_m", smallest).withColumn("quota", quota).drop("_m")
    return sizes.withColumn("quota", F.expr(f"cast(n * {int(pick_pct)} div 100 as long)"))


def split_by_ratio(
    corpus: DataFrame,
    pick_pct: int = 100,
    ratio: int = 75,
    balanced: bool = False,
    shuffle_seed: int | None = None,
    order_cols=("doc_id",),
    cap: int | None = None,
) -> DataFrame:
    """P4+P5+P6: take ``quota`` docs per class in order, first ``ratio*quota div 100`` are train.

    Order is ``order_cols``; with ``shuffle_seed`` it is a seeded hash of class
    and doc id (repeatable shuffle). ``cap`` bounds balanced quotas. Adds ``rn`` (1-based), ``quota`` and ``split``.
    Docs past the quota are dropped: they are not part of the sample.
    """
    q = quotas(corpus, pick_pct, balanced, cap)
    order, bits = list(order_cols), None
    if shuffle_seed is not None:
        corpus = corpus.withColumn("_ord", seeded_order(shuffle_seed, "class", "doc_id"))
        order, bits = ["_ord", *order], SHUFFLE_BITS - MAX_BUCKETS_BITS
    split = _ranked_split(corpus, q, ratio, order, bits)
    return split.drop("_ord") if shuffle_seed is not None else split


def _quota_of(ranked: DataFrame, q: DataFrame, ratio: int) -> DataFrame:
    """``ranked`` with its class's ``quota`` and number of train rows ``_train`` (null classes too)."""
    q = F.broadcast(q.select(F.col("class").alias("_q0"), "quota", F.expr(f"{int(ratio)} * quota div 100").alias("_train")))  # a row a class
    return ranked.join(q, _same(ranked, ["class"], "_q")).drop("_q0")


def _ranked_split(corpus: DataFrame, q: DataFrame, ratio: int, order, bits: int | None) -> DataFrame:
    out = _quota_of(rank_within(corpus, "class", order, bucket_bits=bits), q, ratio).where(F.col("rn") <= F.col("quota"))
    return out.withColumn("split", F.when(F.col("rn") <= F.col("_train"), F.lit(TRAIN)).otherwise(F.lit(TEST))).drop("_train")


def split_in_place(
    corpus: DataFrame,
    pick_pct: int = 100,
    ratio: int = 75,
    balanced: bool = False,
    shuffle_seed: int | None = None,
    order_cols=("doc_id",),
    cap: int | None = None,
) -> DataFrame:
    """The ``split`` of ``split_by_ratio``, without ranks: only the ordering keys are ranked, and each
    class's last train key and last key of the quota (a row a class) are broadcast to the rows, which
    compare their own. No text is shuffled. Where rows with equal keys lie on both sides of a cut, only
    ranks can tell them apart, and the rows are ranked.
    """
    q = quotas(corpus, pick_pct, balanced, cap)
    order, bits = list(order_cols), None
    if shuffle_seed is not None:
        corpus = corpus.withColumn("_ord", seeded_order(shuffle_seed, "class", "doc_id"))
        order, bits = ["_ord", *order], SHUFFLE_BITS - MAX_BUCKETS_BITS
    ranked = _quota_of(rank_within(corpus.select("class", *order), "class", order, bucket_bits=bits, least=KEY_ROWS), q, ratio)

    def at(rank):
        return F.max(F.when(F.col("rn") == rank, _key(order)))

    cuts = ranked.groupBy("class").agg(
        at(F.col("_train")).alias("_last"), at(F.col("_train") + 1).alias("_then"), at(F.col("quota")).alias("_end"), at(F.col("quota") + 1).alias("_past")
    )
    cuts = saved(cuts, "cuts")
    if not cuts.where((F.col("_last") == F.col("_then")) | (F.col("_end") == F.col("_past"))).isEmpty():
        out = _ranked_split(corpus, q, ratio, order, bits).drop("rn", "quota")
    else:
        cuts = cuts.select(F.col("class").alias("_c0"), "_last", "_end")
        out = corpus.join(F.broadcast(cuts), _same(corpus, ["class"], "_c"))
        out = out.withColumn("split", F.when(_key(order) <= F.col("_last"), F.lit(TRAIN)).when(_key(order) <= F.col("_end"), F.lit(TEST)))
        out = out.where(F.col("split").isNotNull()).drop("_c0", "_last", "_end")
    return out.drop("_ord") if shuffle_seed is not None else out


def random_split(corpus: DataFrame, pick: float = 1.0, ratio_pct: float = 75.0, seed: int = 42) -> DataFrame:
    """Random train/test fractions ``r = pick*ratio/100`` and ``pick - r`` (rest unused).

    The uniform value is a hash of the seed and the sample (class, doc_id), so a sample is on the same
    side in every evaluation and layout."""
    r = pick * ratio_pct / 100.0
    u = seeded_order(seed, "class", "doc_id") / F.lit(float(1 << SHUFFLE_BITS))
    return corpus.withColumn(
        "split", F.when(u < r, F.lit(TRAIN)).when(u < pick, F.lit(TEST)).otherwise(F.lit(None))
    ).where(F.col("split").isNotNull())


def restrict_classes(df: DataFrame, classes) -> DataFrame:
    """Keep only the chosen classes (pushed down as an ``IN`` filter)."""
    return df.where(F.col("class").isin(list(classes)))


def preferred_fallback(chosen, preferred):
    """P10: exactly three chosen classes; an unset or unchosen preferred class
    falls back to the last chosen one. Returns ``(preferred, others)``; the
    others keep their order. Runs on the driver over the three names only.
    """
    chosen = list(chosen)
    if len(chosen) != 3:
        raise ValueError("exactly three classes must be chosen")
    others = [c for c in chosen if c != preferred]
    if len(others) == 3:
        preferred = others.pop()
    return preferred, others


def line_split(lines: DataFrame, train_amount: int, test_amount: int, mode: str = "clean") -> DataFrame:
    """Position split of labelled lines ``(line_no, ...)``.

    ``clean``: lines ``[0, T)`` train, ``[T, T+test)`` test.
    ``as_coded``: the original reader loses line ``T`` and its test rows are
    entries ``0..test-1`` of (train lines, then the lines after ``T``), never
    more than the lines left after ``T``. Test rows get ``sample = i``.
    Adds ``split`` and ``sample``.
    """
    T, S = int(train_amount), int(test_amount)
    train = lines.where(F.col("line_no") < T).withColumn("split", F.lit(TRAIN)).withColumn("sample", F.col("line_no"))
    if mode == "clean":
        test = (
            lines.where((F.col("line_no") >= T) & (F.col("line_no") < T + S))
            .withColumn("split", F.lit(TEST))
            .withColumn("sample", F.col("line_no"))
        )
        return train.unionByName(test)
    if mode != "as_coded":
        raise ValueError(f"unknown split mode {mode!r}")
    # remaining lines after the lost one bound the number of test iterations
    remaining = F.greatest(F.col("_total") - F.lit(T + 1), F.lit(0))
    total = lines.groupBy("source").agg(F.count(F.lit(1)).alias("_total"))
    with_total = lines.join(F.broadcast(total), "source")
    # entry i of the shared list is line i for i < T, else line i + 1
    sample = F.when(F.col("line_no") < T, F.col("line_no")).otherwise(F.col("line_no") - 1)
    test = (
        with_total.where(F.col("line_no") != T)
        .withColumn("sample", sample)
        .where((F.col("sample") < F.lit(S)) & (F.col("sample") < remaining))
        .withColumn("split", F.lit(TEST))
        .drop("_total")
    )
    return train.unionByName(test)
