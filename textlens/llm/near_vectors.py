"""Near-duplicate vectors by counting collisions in sorted one-dimensional projections.

Every unit vector is projected on ``PROJECTIONS`` random directions. Two vectors collide in a projection
if one lies in the window of half-width ``WINDOW`` around the other; vectors at the threshold collide
in a known share of all projections, so the least count that all but ``MISSED`` of such pairs reach is
a binomial quantile. Only pairs with that count are verified, in double precision.

The first projection is sorted into blocks of bounded size, and blocks of a label meet only where
their ranges come within the widest window. Equal vectors are one vector with a number of copies, and
a block pair returns counts of links and a spanning set of them, so a large group of near
copies never becomes rows for all its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm.common import rows, small_batches, written
from textlens.llm.graph import components

PROJECTIONS, WINDOW, MISSED, SEED = 40, 0.3, 0.0005, 5
#: Vectors in a block, about; rows of the per-block tables that may be broadcast.
BLOCK, BROADCAST_ROWS = 1024, 20_000


def threshold_distance(cosine: float) -> float:
    return math.sqrt(2 - 2 * cosine)


def least_count(cosine: float) -> int:
    """The collisions that all but ``MISSED`` of the pairs at the threshold have."""
    p = math.erf(WINDOW / threshold_distance(cosine) / math.sqrt(2))
    below, count = 0.0, 0
    while below + (chance := math.comb(PROJECTIONS, count) * p**count * (1 - p) ** (PROJECTIONS - count)) <= MISSED:
        below += chance
        count += 1
    return count


def widest(cosine: float) -> float:
    """Vectors at the threshold are nearer than this in one projection, but for ``MISSED`` / 10 of them."""
    x = 3.0
    while math.erfc(x / math.sqrt(2)) > MISSED / 10:
        x += 0.1
    return x * threshold_distance(cosine)


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, PROJECTIONS))


def collisions(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many projections (columns) put each pair of rows of ``x`` and ``y`` within the window."""
    count = np.zeros((len(x), len(y)), np.uint8)
    order = np.argsort(x[:, 0], kind="stable")
    for p in range(x.shape[1]):
        count += np.abs(x[order, p][:, None] - y[:, p]) <= WINDOW
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return count[back]


def _links(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Which pairs of unit rows are linked: counted, then verified."""
    a = directions(x.shape[1])
    px, py = ((v @ a).astype(np.float32) for v in (x, y))
    candidate = collisions(px, py) >= least_count(cosine)
    if candidate.mean() > 0.05:
        return candidate & (x @ y.T >= cosine)
    i, j = np.nonzero(candidate)
    link = np.zeros_like(candidate)
    link[i, j] = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
    return link


def _roots(link: np.ndarray, ids_x: np.ndarray, ids_y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and each column reaches by links."""
    x, y, top = ids_x.copy(), ids_y.copy(), np.iinfo(np.int64).max
    while True:
        new_y = np.minimum(y, np.where(link, x[:, None], top).min(0, initial=top))
        new_x = np.minimum(x, np.where(link, new_y, top).min(1, initial=top))
        if (new_x == x).all() and (new_y == y).all():
            return x, y
        x, y = new_x, new_y


def _with_small(df: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    return df.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, on)


def _blocks(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """Blocks of distinct vectors of one label and length, near each other in the first projection."""

    def project(batches):
        for b in batches:
            for dim in sorted(set(b.column("dim").to_pylist())):
                t = b.filter(pa.compute.equal(b.column("dim"), dim))
                v = np.array(t.column("vector").flatten().to_numpy(zero_copy_only=False)).reshape(-1, dim)
                v = v / np.linalg.norm(v / np.abs(v).max(1, keepdims=True), axis=1, keepdims=True) / np.abs(v).max(1, keepdims=True)
                yield rows({"label": t.column("label"), "dim": t.column("dim"), "class": t.column("class"), "copies": t.column("copies"), "place": pa.array(v @ directions(dim)[:, 0]), "unit": pa.array([x.tobytes() for x in v], pa.binary())})

    placed = written(vectors.mapInArrow(project, "label string, dim int, class long, copies long, place double, unit binary"), "placed")
    sizes = placed.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("slabs"))
    # projections of unit vectors spread about as the normal law does; where they do not, slabs are split
    share = 1 / (1 + F.exp(-1.702 * F.col("place")))
    placed = _with_small(placed, written(sizes, "sizes"), ["label", "dim"]).withColumn("slab", F.floor(share * F.col("slabs")))
    parts = placed.groupBy("label", "dim", "slab").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    placed = _with_small(placed, written(parts, "parts"), ["label", "dim", "slab"]).withColumn("part", F.pmod(F.xxhash64("class"), "parts"))

    def pack(key, table):
        table = table.sort_by("class")
        place = table.column("place").to_numpy()
        one = {"label": key[0], "dim": key[1], "slab": key[2], "part": key[3], "lo": place.min(), "hi": place.max()}
        packed = {c: table.column(c).to_numpy().astype(np.int64).tobytes() for c in ("class", "copies")}
        kinds = {"label": pa.string(), "dim": pa.int32(), "slab": pa.int64(), "part": pa.int64(), "lo": pa.float64(), "hi": pa.float64()}
        columns = {c: pa.array([v.as_py() if isinstance(v, pa.Scalar) else v], kinds[c]) for c, v in one.items()}
        return pa.table(columns | {"classes": pa.array([packed["class"]], pa.binary()), "copies": pa.array([packed["copies"]], pa.binary()), "units": pa.array([b"".join(table.column("unit").to_pylist())], pa.large_binary()).cast(pa.binary())})

    schema = "label string, dim int, slab long, part long, lo double, hi double, classes binary, copies binary, units binary"
    packed = placed.select("label", "dim", "slab", "part", "class", "copies", "place", "unit").groupBy("label", "dim", "slab", "part").applyInArrow(pack, schema)
    return written(packed.withColumn("block", F.xxhash64("label", "dim", "slab", "part")), "blocks")


def near_vectors(
    spark: SparkSession, embeddings: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """For each row of ``embeddings``: vec_id, n_links (other rows linked directly), component_id (the
    smallest vec_id reachable by links, itself included) and kept (vec_id = component_id).

    Rows with equal labels link when their vectors' cosine is ``cosine`` or more; vectors of different
    lengths never do. A null label, a null, empty or zero vector, and one with a null or non-finite
    component link with nothing. Repeated rows link with each other; a repeated id is one node for
    component_id. Rows with a null id count as links, and are named by the smallest id that is not null.
    Only the three columns are read. An empty table gives no rows.
    """
    small_batches(spark)
    vector = F.col(vector_col).cast("array<double>")
    each = embeddings.select(F.col(id_col).alias("vec_id"), vector.alias("vector"), F.col(label_col).cast("string").alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("label").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    # zeros of either sign are the same component
    same = F.transform("vector", lambda x: x + F.lit(0.0))
    each = each.withColumn("class", F.when(good, F.xxhash64("label", same)))
    classes = each.where("class is not null").groupBy("class").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"))
    blocks = _blocks(spark, classes.withColumn("dim", F.size("vector")))
    meta = blocks.select("block", "label", "dim", "lo", "hi")
    a, b = meta.alias("a"), meta.alias("b")
    reach = widest(cosine)
    meet = a.join(b, F.expr(f"a.label = b.label and a.dim = b.dim and a.block <= b.block and b.lo <= a.hi + {reach} and a.lo <= b.hi + {reach}"))
    data = blocks.select("block", "dim", "classes", "copies", "units")
    one, two = (data.select(*[F.col(c).alias(f"{c}_{s}") for c in data.columns]) for s in "ab")
    meet = meet.select(F.col("a.block").alias("block_a"), F.col("b.block").alias("block_b")).join(one, "block_a").join(two, "block_b")

    def compare(batches):
        for batch in batches:
            for r in batch.to_pylist():
                x, y = (np.frombuffer(r[f"units_{s}"], np.float64).reshape(-1, r["dim_a"]) for s in "ab")
                cx, cy, nx, ny = (np.frombuffer(r[f"{c}_{s}"], np.int64) for c in ("classes", "copies") for s in "ab")
                own = r["block_a"] == r["block_b"]
                link = _links(x, y, cosine)
                if own:
                    np.fill_diagonal(link, False)
                    link |= link.T
                root_x, root_y = _roots(link, cx, cy)
                n = link.astype(np.float64) @ ny
                found = [(cx, root_x, n)] if own else [(cx, root_x, n), (cy, root_y, nx @ link)]
                for c, root, n in found:
                    some = n > 0
                    yield rows({"a": pa.array(c[some]), "b": pa.array(root[some]), "n": pa.array(np.round(n[some]).astype(np.int64))})

    pairs = meet.select("block_a", "block_b", "dim_a", *[f"{c}_{s}" for c in ("classes", "copies", "units") for s in "ab"]).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block_a", "block_b")
    found = written(pairs.mapInArrow(compare, "a long, b long, n long"), "found")
    counts = found.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    roots = components(found.select("a", "b")).select(F.col("node").alias("class"), "root")
    linked = each.select("vec_id", "class").where("class is not null").join(counts, "class", "left").join(roots, "class", "left")
    linked = linked.join(classes.select("class", "copies"), "class").withColumn("root", F.coalesce("root", "class"))
    least = linked.groupBy("root").agg(F.min("vec_id").alias("least"))
    named = linked.join(least, "root").select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    alone = each.where("class is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
