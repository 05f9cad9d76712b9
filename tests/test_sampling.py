"""Ranks, quotas and splits against brute force."""

import random

from pyspark.sql import functions as F

from textlens.operators.sampling import line_split, preferred_fallback, quotas, random_split, rank_within, split_by_ratio, split_in_place, splitters


def test_rank_within_many_buckets_and_skew(spark):
    rnd = random.Random(3)
    rows = [(i, "hot" if rnd.random() < 0.6 else f"c{rnd.randrange(4)}") for i in rnd.sample(range(100000), 3000)]
    df = spark.createDataFrame(rows, "doc_id long, class string")
    got = {r["doc_id"]: r["rn"] for r in rank_within(df, "class", ["doc_id"], bucket_rows=20).collect()}
    by_class = {}
    for d, c in rows:
        by_class.setdefault(c, []).append(d)
    for c, ids in by_class.items():
        for k, d in enumerate(sorted(ids), start=1):
            assert got[d] == k


def test_rank_within_is_stable_across_evaluations(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("class"))
    r = rank_within(df, "class", ["doc_id"], bucket_rows=50)
    a = sorted(map(tuple, r.collect()))
    b = sorted(map(tuple, r.collect()))
    assert a == b


def test_quotas_and_split(spark):
    rows = [(i, "a") for i in range(10)] + [(100 + i, "b") for i in range(7)]
    df = spark.createDataFrame([(d, c, "x") for d, c in rows], "doc_id long, class string, text string")
    q = {r["class"]: r["quota"] for r in quotas(df, 50).collect()}
    assert q == {"a": 5, "b": 3}
    qb = {r["class"]: r["quota"] for r in quotas(df, 50, balanced=True).collect()}
    assert qb == {"a": 3, "b": 3}
    s = split_by_ratio(df, pick_pct=100, ratio=75)
    got = {(r["class"], r["split"]): r["n"] for r in s.groupBy("class", "split").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", "train"): 7, ("a", "test"): 3, ("b", "train"): 5, ("b", "test"): 2}
    first_test = s.where("class = 'a' and split = 'test'").agg(F.min("doc_id")).first()[0]
    assert first_test == 7


def test_line_split_as_coded(spark):
    # worked by hand: line T is lost; entry i is line i before it and line i + 1 after it; there are
    # at most as many entries as lines after T
    cases = {
        (20, 15, 5): [(0, 0), (1, 1), (2, 2), (3, 3)],
        (20, 5, 30): [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 6), (6, 7), (7, 8), (8, 9), (9, 10), (10, 11), (11, 12), (12, 13), (13, 14)],
        (10, 12, 3): [],
        (12, 4, 4): [(0, 0), (1, 1), (2, 2), (3, 3)],
    }
    for (n, t, s), expected in cases.items():
        df = spark.range(0, n).select(F.lit("f").alias("source"), F.col("id").alias("line_no"))
        test = line_split(df, t, s, "as_coded").where("split = 'test'")
        assert sorted((r["sample"], r["line_no"]) for r in test.collect()) == expected, (n, t, s)


def test_preferred_fallback():
    assert preferred_fallback(["a", "b", "c"], "b") == ("b", ["a", "c"])
    assert preferred_fallback(["a", "b", "c"], None) == ("c", ["a", "b"])
    assert preferred_fallback(["a", "b", "c"], "z") == ("c", ["a", "b"])


def test_rank_within_sparse_ids(spark):
    rnd = random.Random(5)
    ids = list({rnd.getrandbits(63) - 2**62 for _ in range(2000)})
    rows = [(i, "a" if k % 3 else "b") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, class string")
    got = {r["doc_id"]: r["rn"] for r in rank_within(df, "class", ["doc_id"]).collect()}
    for c in ("a", "b"):
        for k, d in enumerate(sorted(i for i, cc in rows if cc == c), start=1):
            assert got[d] == k


def test_rank_within_names(spark):
    rnd = random.Random(9)
    names = [f"s {rnd.randrange(10**6)}.txt" for _ in range(300)] + ["", "a", "ä", "zzzzzzzzzz", "zzzzzzzzza"]
    rows = [(n, "x" if k % 2 else None) for k, n in enumerate(dict.fromkeys(names))]
    df = spark.createDataFrame(rows, "doc_id string, class string")
    got = {(r["class"], r["doc_id"]): r["rn"] for r in rank_within(df, "class", ["doc_id"]).collect()}
    assert len(got) == len(rows)
    for c in ("x", None):
        for k, n in enumerate(sorted((n for n, cc in rows if cc == c), key=str.encode), start=1):
            assert got[c, n] == k


def test_random_split_does_not_depend_on_the_layout(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("doc_id"), (F.col("id") % 4).cast("string").alias("class"))
    one, two = (sorted(map(tuple, random_split(x, 0.9, 75.0, 3).collect())) for x in (df.repartition(3), df.coalesce(1).orderBy(F.desc("doc_id"))))
    assert one == two
    share = sum(r[2] == "train" for r in one) / 3000
    assert abs(share - 0.675) < 0.03


def test_cap_is_optional(spark):
    df = spark.createDataFrame([(i, "a" if i < 30 else "b") for i in range(80)], "doc_id long, class string")
    assert {r["quota"] for r in quotas(df, balanced=True).collect()} == {30}
    assert {r["quota"] for r in quotas(df, balanced=True, cap=20).collect()} == {20}


def _largest_bucket(df, order, bucket_rows):
    """Rows of the largest bucket, and how many buckets there are."""
    from textlens.operators.sampling import _bucket, _key

    cuts = splitters(df, ["class"], order, bucket_rows).select("class", "cuts")
    sizes = df.join(cuts, "class").groupBy("class", _bucket(F.col("cuts"), _key(order)).alias("b")).count().collect()
    return max(r["count"] for r in sizes), len(sizes)


def test_buckets_of_any_keys(spark):
    """Names with one common prefix, a far outlier, and a first column that does not tell rows apart."""
    ids = spark.range(20_000).select(F.lit("a").alias("class"), F.col("id"))
    names = ids.select("class", F.format_string("message-%010d", "id").alias("doc_id"))
    far = ids.select("class", "id").union(spark.createDataFrame([("a", 2**62)], "class string, id long")).withColumnRenamed("id", "doc_id")
    same = ids.select("class", F.lit(7).alias("x"), F.col("id").alias("doc_id"))
    for df, order in ((names, ["doc_id"]), (far, ["doc_id"]), (same, ["x", "doc_id"])):
        largest, n = _largest_bucket(df, order, 200)
        assert 50 < n < 200 and largest < 3000
        ranks = {r["doc_id"]: r["rn"] for r in rank_within(df, "class", order, bucket_rows=200).collect()}
        assert [ranks[d] for d in sorted(ranks)] == list(range(1, len(ranks) + 1))


def _splits(df):
    return sorted(((r["class"], r["doc_id"], r["split"]) for r in df.collect()), key=repr)


def test_split_in_place_is_the_ranked_split(spark):
    rows = [(i, ["a", "b", None][i % 3]) for i in range(1, 900)] + [(5000, "one")]
    df = spark.createDataFrame(rows, "doc_id long, class string").repartition(3)
    for options in ({}, {"pick_pct": 40, "ratio": 60}, {"balanced": True}, {"shuffle_seed": 3}, {"pick_pct": 1}, {"ratio": 0}, {"balanced": True, "cap": 20, "shuffle_seed": 9}):
        ranked = split_by_ratio(df, **options)
        assert _splits(split_in_place(df, **options)) == _splits(ranked)
    assert {r["class"] for r in split_by_ratio(df).collect()} == {"a", "b", None, "one"}  # null is a class too
    assert split_in_place(df.limit(0)).count() == 0


def test_split_in_place_with_equal_keys_on_a_cut(spark):
    df = spark.createDataFrame([(1, "a")] * 6 + [(2, "a")] * 6, "doc_id long, class string")
    got = split_in_place(df, ratio=25).groupBy("split", "doc_id").count().collect()
    assert sorted(map(tuple, got)) == [("test", 1, 3), ("test", 2, 6), ("train", 1, 3)]
