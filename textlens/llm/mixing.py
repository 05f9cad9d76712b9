"""Mixing documents to target token weights by soft membership.

A classifier fitted on a labelled table gives every document a probability for each domain. The
document's tokens count for each domain by these, and every document gets a rate (how often it is
drawn, 0 or more) so that the expected tokens of each domain meet their targets. The rates are the
least-squares solution near given first rates. At the solution a document's rate follows from its own
row and one price for each domain, so the prices are all that is searched for, by Newton's method on
the dual: a round is one aggregate over all documents (expected tokens by domain, and how they change
with the prices). Newton's method does not depend on the scale of the documents' lengths, and it goes
on until the prices agree with the tokens they give. No table of rates is rewritten, and a lost
executor costs only its share of one round.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm.common import binaries, rows, shards, small_batches, written
from textlens.llm.hashing import word_hashes

#: Features of the classifier (hashed words), and about how many labelled documents of each domain it is fitted on.
FEATURES_LOG, DOCS_PER_DOMAIN = 16, 2000
STEPS, RATE, DECAY, SEED = 60, 0.1, 3e-4, 3
#: The rounds end when every domain's share of the tokens is within ENOUGH of itself of what its price
#: stands for; without that after ROUNDS, the run fails.
ROUNDS, ENOUGH = 200, 1e-6
#: Weight of staying near the first rates against meeting the targets.
STAY = 0.005
SHARD_BYTES = 4 << 20
#: Domains are few: a row of the working table holds a number for each.
MOST_DOMAINS = 1000

FEATURES = 1 << FEATURES_LOG

log = logging.getLogger(__name__)


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray  # features x domains
    bias: np.ndarray
    emphasis: np.ndarray  # how unevenly the domains of the sample use each feature


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The hashed words of the texts, each once a text: (text, slot, 1 + ln of its count); and the
    texts' words."""
    hashes, sizes = word_hashes(texts)
    of = np.repeat(np.arange(len(texts)), sizes)
    pairs, n = np.unique(of * FEATURES + (hashes >> np.uint64(64 - FEATURES_LOG)).astype(np.int64), return_counts=True)
    return pairs // FEATURES, pairs % FEATURES, 1 + np.log(n), sizes


def weighted(of: np.ndarray, slot: np.ndarray, value: np.ndarray, emphasis: np.ndarray, n: int) -> np.ndarray:
    """Values by the features' emphasis, of unit length for each text."""
    v = value * emphasis[slot]
    return v / np.sqrt(np.bincount(of, v * v, n) + 1e-12)[of]


def posteriors(m: Classifier, of: np.ndarray, slot: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return softmax(np.stack([np.bincount(of, value * m.weights[slot, d], n) for d in range(len(m.domains))], 1) + m.bias)


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]]) -> Classifier:
    """Multinomial logistic regression on (domain, slots, values) of texts, by full-batch gradients.
    Domains count as often as they are labelled. Without samples there is one domain, the empty name."""
    domains = sorted({s[0] for s in samples}) or [""]
    m = Classifier(domains, np.zeros((FEATURES, len(domains))), np.zeros(len(domains)), np.ones(FEATURES))
    if len(domains) == 1:
        return m
    samples = sorted(samples, key=lambda s: (s[0], s[1].tobytes(), s[2].tobytes()))
    n = len(samples)
    of = np.repeat(np.arange(n), [len(s[1]) for s in samples])
    slot, value = (np.concatenate([s[i] for s in samples]) for i in (1, 2))
    label = np.array([domains.index(s[0]) for s in samples])
    size = np.bincount(label, minlength=len(domains))
    used = np.stack([np.bincount(slot[label[of] == d], minlength=FEATURES) for d in range(len(domains))], 1)
    # the largest log ratio of a feature's use inside and outside a domain
    inside, outside = (used + 2) / (size + 4), (used.sum(1, keepdims=True) - used + 2) / (n - size + 4)
    m.emphasis = np.abs(np.log(inside / outside)).max(1)
    value = weighted(of, slot, value, m.emphasis, n)
    m.bias = np.log(size / n)
    one, two = np.zeros_like(m.weights), np.zeros_like(m.weights)
    for step in range(1, STEPS + 1):
        off = posteriors(m, of, slot, value, n)
        off[np.arange(n), label] -= 1
        g = np.stack([np.bincount(slot, value * off[of, d], FEATURES) for d in range(len(domains))], 1) / n + DECAY * m.weights
        one, two = 0.9 * one + 0.1 * g, 0.99 * two + 0.01 * g * g
        m.weights = m.weights - RATE * one / (1 - 0.9**step) / (np.sqrt(two / (1 - 0.99**step)) + 1e-6)
    return m


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def labelled_sample(docs: DataFrame, labels: DataFrame, domain: Column) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(domain, slots, values) of about ``DOCS_PER_DOMAIN`` labelled documents of each domain, chosen by a
    hash of the id: what the driver gets is bounded by them and ``FEATURES``."""
    known = labels.select(F.col("doc_id"), domain.cast("string").alias("domain")).where("domain is not null and doc_id is not null").distinct()
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().limit(MOST_DOMAINS + 1).collect()}
    if len(sizes) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains")
    if not sizes:
        return []
    of = F.create_map(*[x for d, n in sizes.items() for x in (F.lit(d), F.lit(float(n)))])
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < (1 << 30) * DOCS_PER_DOMAIN / F.try_element_at(of, F.col("domain")))
    # at most about domains x DOCS_PER_DOMAIN ids
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null").join(F.broadcast(picked), "doc_id")

    def pack(batches):
        for b in batches:
            of, slot, value, _ = features(binaries(b.column(1)))
            edge = np.searchsorted(of, np.arange(b.num_rows + 1))
            slots, values = ([x[i:j].tobytes() for i, j in zip(edge[:-1], edge[1:])] for x in (slot.astype(np.int32), value.astype(np.float32)))
            yield rows({"domain": b.column(0), "slots": pa.array(slots, pa.binary()), "values": pa.array(values, pa.binary())})

    got = found.select("domain", "text").mapInArrow(pack, "domain string, slots binary, values binary").collect()
    return [(r["domain"], np.frombuffer(r["slots"], np.int32), np.frombuffer(r["values"], np.float32)) for r in got]


def memberships(spark: SparkSession, docs: DataFrame, model: Classifier) -> DataFrame:
    """For each row of ``docs``: doc_id, row (a hash of the text), tokens (words) and posterior (a
    probability for each of the model's domains)."""
    shared = spark.sparkContext.broadcast(model)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, SHARD_BYTES):
            m, texts = shared.value, [t or b"" for t in binaries(shard.column("text").combine_chunks())]
            of, slot, value, sizes = features(texts)
            p = posteriors(m, of, slot, weighted(of, slot, value, m.emphasis, len(texts)), len(texts))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * p.shape[1], pa.int32()), pa.array(p.reshape(-1)))
            yield rows({"doc_id": shard.column("doc_id").combine_chunks(), "row": shard.column("row").combine_chunks(), "tokens": pa.array(sizes), "posterior": flat})

    text = F.col("text").cast("string")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("row")).mapInArrow(assign, f"doc_id {kind}, row long, tokens long, posterior array<double>")


def priced(tokens: np.ndarray, posterior: np.ndarray, prices: np.ndarray) -> np.ndarray:
    """Each document's rate: 1 less its tokens at the domains' prices, cut off at 0."""
    return np.maximum(0, 1 - tokens * (posterior @ prices))


def _columns(batch: pa.RecordBatch, domains: int) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("tokens").to_numpy(), batch.column("posterior").flatten().to_numpy().reshape(-1, domains)


def rates(members: DataFrame, domains: int, targets: np.ndarray) -> tuple[DataFrame, dict]:
    """``members`` with each document's rate, and what was reached: tokens by domain before and after,
    targets, rounds, and how far the prices are from agreeing with the tokens (at most ENOUGH).

    Least: half the squared errors of the domains' expected tokens against ``targets``, as shares of all
    tokens and each over the domain's own share (so that a small domain weighs as much), plus STAY / 2
    times the mean squared distance of the rates from 1. ``members`` is read once a round and should be a
    written table. Raises if ROUNDS rounds do not reach the least.
    """
    upper = np.triu_indices(domains)

    def totals(prices):
        """Sums over the documents at the prices: documents, tokens, squared rates, expected tokens by domain,
        and products of the tokens by domain of documents with a rate (a matrix). A row for each task and sum."""

        def add(batches):
            sums = np.zeros(3 + domains + len(upper[0]))
            for b in batches:
                n, p = _columns(b, domains)
                rate, own = priced(n, p, prices), n[:, None] * p
                some = own[rate > 0]
                sums += np.concatenate([[len(n), n.sum(), rate @ rate], rate @ own, (some.T @ some)[upper]])
            if sums[0]:
                yield rows({"place": pa.array(np.arange(len(sums)), pa.int32()), "s": pa.array(sums)})

        found = members.select("tokens", "posterior").mapInArrow(add, "place int, s double").groupBy("place").agg(F.sum("s").alias("s")).toArrow()
        s = np.zeros(3 + domains + len(upper[0]))
        s[found.column("place").to_numpy()] = found.column("s").to_numpy()
        products = np.zeros((domains, domains))
        products[upper] = s[3 + domains :]
        return s[0], s[1], s[2], s[3 : 3 + domains], products + np.triu(products, 1).T

    prices = np.zeros(domains)
    n, all_tokens, squares, first, products = totals(prices)
    info = {"before": first, "after": first, "targets": targets, "rounds": 0, "off": 0.0}
    if not all_tokens:
        return members.withColumn("rate", F.lit(1.0)), info
    mean = all_tokens / n
    own = np.maximum(first, targets) / all_tokens
    own = np.where(own > 0, own, 1.0)  # a domain that no document can have
    aim = targets / all_tokens

    # prices are for the tokens of the mean document from here on
    def state(squares, reached, products, x):
        """Of the dual: value, gradient, curvature."""
        reached = reached / all_tokens
        gradient = STAY * own * x + aim - reached
        off = np.abs(gradient) - 1e-13 * (STAY * own * np.abs(x) + aim + reached)  # less what sums are rounded by
        return STAY / 2 * (own * x) @ x + aim @ x + squares / n / 2, gradient, np.diag(STAY * own) + products / n / mean**2, (off / own).max()

    x = np.zeros(domains)
    value, gradient, curvature, off = state(squares, first, products, x)
    after, step, reach = first, None, 1.0
    rounds = 0
    while off > ENOUGH:
        if rounds == ROUNDS:
            raise RuntimeError(f"rates: {ROUNDS} rounds leave a domain's share {off:.3g} of itself from its least; tokens {after.tolist()}, targets {targets.tolist()}")
        if step is None:
            # scaled by the diagonal: domains may differ by many orders of magnitude
            d = 1 / np.sqrt(np.diag(curvature))
            step, reach = -d * np.linalg.solve(curvature * d[:, None] * d, d * gradient), 1.0
        slope = gradient @ step
        _, _, squares, tried, products = totals((x + reach * step) / mean)
        rounds += 1
        found = state(squares, tried, products, x + reach * step)
        rise = found[0] - value
        if rise <= 1e-4 * reach * slope + 1e-14 * (abs(value) + 1) or found[3] <= ENOUGH:
            x, after, step = x + reach * step, tried, None
            value, gradient, curvature, off = found
        else:  # too far: the least of the parabola through both ends
            reach *= min(0.5, max(0.1, -slope * reach / (2 * (rise - slope * reach))))
    prices = x / mean

    def rated(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(priced(*_columns(b, domains), prices))], [*b.schema.names, "rate"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in members.schema)
    return members.mapInArrow(rated, f"{fields}, rate double"), info | {"after": after, "rounds": rounds, "off": off}


def mixture(spark: SparkSession, docs: DataFrame, labels: DataFrame, domain: Column, weights: dict[str, float]) -> DataFrame:
    """doc_id, n_tokens, domain (the most probable one), probability (of that) and rate for each
    row of ``docs``; expected tokens by domain approach ``weights`` (normalised; domains not named get
    nothing) times all tokens.

    ``domain`` is a column over ``labels`` (with doc_id); rows without it are not learned from. Null and
    empty texts have no tokens: they keep rate 1 and the domains' shares. Without labelled rows there is
    one domain with the empty name and every rate is 1. Repeated rows and ids stay one row each. Only
    doc_id and text are read. An empty table gives no rows.
    """
    small_batches(spark)
    model = fit(labelled_sample(docs, labels, domain))
    members = written(memberships(spark, docs, model), "members")
    total = members.agg(F.sum("tokens")).first()[0] or 0
    share = np.array([max(weights.get(d, 0.0), 0.0) for d in model.domains])
    share = share / share.sum() if share.sum() else np.full(len(share), 1 / len(share))
    members, info = rates(members, len(model.domains), share * total)
    for d, *tokens in zip(model.domains, info["before"], info["after"], info["targets"]):
        log.info("domain %r: %.0f tokens, %.0f expected at the rates, target %.0f", d, *tokens)
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    return members.select(
        "doc_id",
        F.col("tokens").alias("n_tokens"),
        F.get(F.array(*map(F.lit, model.domains)), best - 1).alias("domain"),
        F.array_max("posterior").alias("probability"),
        "rate",
    )
