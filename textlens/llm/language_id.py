"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time. Two recurrent layers read
a window of bytes, one from each end; at every byte a linear layer on both states gives a
probability for each language, and a document's probabilities are the mean over all its bytes.
Texts are read whole, as consecutive windows that all run at once, one byte of each per step.

The recurrent unit has one gate that both resets and updates. Its functions are rational,
s(x) = x / (1 + |x|) for the candidate and (1 + s(x)) / 2 for the gate, because they cost a tenth of
the exponential ones and training adapts to them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm.common import binaries, shards, small_batches, written

#: Bytes in a window, units in each direction, windows that run at once.
WINDOW, HIDDEN, TOGETHER = 64, 8, 2048
#: The bounded training sample: about this many documents of each language, windows of each.
DOCS_PER_LANG, WINDOWS_PER_DOC = 400, 6
#: More languages than this are joined by a shuffle, not broadcast.
MOST_LANGS = 10_000
STEPS, BATCH, RATE, SEED = 240, 160, 0.02, 7
SHARD_BYTES = 2 << 20
UNDETERMINED = "und"

_ascii_letter = re.compile(rb"[A-Za-z]").search
F32 = np.float32


@dataclass
class Network:
    langs: list[str]
    params: dict[str, np.ndarray]  # Xf, Uf: forward; Xb, Ub: backward; W, b: output


def _steps(X, U, windows):
    """The states after each byte, for windows of shape (bytes, n): a pass without records."""
    n, H = windows.shape[1], U.shape[0]
    h = np.zeros((n, H), F32)
    x, r = np.empty((n, 2 * H), F32), np.empty((n, 2 * H), F32)
    f, c, t = np.empty((n, H), F32), np.empty((n, H), F32), np.empty((n, H), F32)
    for byte in windows:
        np.take(X, byte, axis=0, out=x, mode="clip")
        np.matmul(h, U, out=r)
        np.add(x[:, :H], r[:, :H], out=f)
        np.abs(f, out=t)
        t += 1
        f /= t
        f *= 0.5
        f += 0.5
        np.multiply(f, r[:, H:], out=c)
        c += x[:, H:]
        np.abs(c, out=t)
        t += 1
        c /= t
        c -= h
        c *= f
        h += c
        yield h


def position_probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    """Probabilities of the languages at every byte: (languages, bytes, n) for ``windows`` (bytes, n)."""
    p, H = net.params, net.params["Uf"].shape[0]
    W, b = p["W"], p["b"]
    ahead, behind = (np.empty((*windows.shape, len(net.langs)), F32) for _ in range(2))
    for t, h in enumerate(_steps(p["Xf"], p["Uf"], windows)):
        np.matmul(h, W[:H], out=ahead[t])
    for t, h in enumerate(_steps(p["Xb"], p["Ub"], windows[::-1])):
        np.matmul(h, W[H:], out=behind[len(windows) - 1 - t])
    ahead += behind
    q = np.ascontiguousarray(np.moveaxis(ahead, 2, 0))  # then all that follows runs over long rows
    q += b[:, None, None]
    q -= q.max(0)
    np.exp(q, out=q)
    q /= q.sum(0)
    return q


def _slope(x):
    return 1 / (1 + np.abs(x)) ** 2


def _forward(X, U, windows):
    """States after each byte, and what the way back needs."""
    H = U.shape[0]
    h, kept, states = np.zeros((windows.shape[1], H), F32), [], []
    for byte in windows:
        x, r = X[byte], h @ U
        a = x[:, :H] + r[:, :H]
        f = 0.5 + 0.5 * a / (1 + np.abs(a))
        e = x[:, H:] + f * r[:, H:]
        c = e / (1 + np.abs(e))
        kept.append((h, a, f, r[:, H:], e, c))
        h = h + f * (c - h)
        states.append(h)
    return states, kept


def _backward(U, windows, kept, up):
    """Gradients of the byte table and the recurrent weights; ``up``: of the loss by each state."""
    H = U.shape[0]
    dU, dx, dh = np.zeros_like(U), [None] * len(windows), 0
    for t in range(len(windows) - 1, -1, -1):
        h, a, f, r, e, c = kept[t]
        dh = dh + up[t]
        de = dh * f * _slope(e)
        da = (dh * (c - h) + de * r) * 0.5 * _slope(a)
        dr = np.concatenate([da, de * f], 1)
        dx[t] = np.concatenate([da, de], 1)
        dU += h.T @ dr
        dh = dh * (1 - f) + dr @ U.T
    hot = np.zeros((windows.size, 256), F32)
    hot[np.arange(windows.size), windows.reshape(-1)] = 1
    return hot.T @ np.concatenate(dx), dU


def train(samples: list[tuple[str, bytes]], steps: int = STEPS) -> Network | None:
    """A network from (language, window of bytes) pairs; ``None`` without any. The result depends
    on the set of samples alone, not on their order."""
    samples = sorted(samples)
    langs = sorted({lang for lang, _ in samples})
    if not langs:
        return None
    rng = np.random.default_rng(SEED)
    H, L = HIDDEN, len(langs)
    data = np.zeros((WINDOW, len(samples)), np.uint8)
    valid = np.zeros((WINDOW, len(samples)), F32)
    for i, (_, text) in enumerate(samples):
        data[: len(text), i] = np.frombuffer(text, np.uint8)
        valid[: len(text), i] = 1
    of = [np.array([i for i, (lang, _) in enumerate(samples) if lang == x]) for x in langs]
    label = np.array([langs.index(lang) for lang, _ in samples])
    p = {k: (rng.standard_normal(s) * v).astype(F32) for k, s, v in (("Xf", (256, 2 * H), 0.5), ("Uf", (H, 2 * H), H**-0.5), ("Xb", (256, 2 * H), 0.5), ("Ub", (H, 2 * H), H**-0.5), ("W", (2 * H, L), 0.3), ("b", (L,), 0))}
    m1, m2 = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        # every language has the same share of a batch, however many documents it has
        pick = np.concatenate([rng.choice(x, -(-BATCH // L)) for x in of])
        windows, mask = data[:, pick], valid[:, pick]
        ahead, kept_f = _forward(p["Xf"], p["Uf"], windows)
        behind, kept_b = _forward(p["Xb"], p["Ub"], windows[::-1])
        states = np.concatenate([np.stack(ahead), np.stack(behind)[::-1]], 2)
        logits = states @ p["W"] + p["b"]
        q = np.exp(logits - logits.max(2, keepdims=True))
        q /= q.sum(2, keepdims=True)
        q[:, np.arange(len(pick)), label[pick]] -= 1
        q *= (mask / max(mask.sum(), 1))[:, :, None]
        up = q @ p["W"].T
        g = {"W": states.reshape(-1, 2 * H).T @ q.reshape(-1, L), "b": q.sum((0, 1))}
        g["Xf"], g["Uf"] = _backward(p["Uf"], windows, kept_f, up[:, :, :H])
        g["Xb"], g["Ub"] = _backward(p["Ub"], windows[::-1], kept_b, up[::-1, :, H:])
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for k, v in g.items():
            m1[k] = 0.9 * m1[k] + 0.1 * v
            m2[k] = 0.99 * m2[k] + 0.01 * v * v
            p[k] -= (rate * m1[k] / (1 - 0.9**step) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-7)).astype(F32)
    return Network(langs, {k: np.ascontiguousarray(v, F32) for k, v in p.items()})


def training_windows(docs: DataFrame, lang: Column, usable: Column) -> list[tuple[str, bytes]]:
    """(language, window) pairs from about ``DOCS_PER_LANG`` documents of each language, chosen by a
    hash of the id; ``WINDOWS_PER_DOC`` windows from anywhere in each. This bounds what the driver
    holds by languages x documents x windows."""
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), lang.cast("string").alias("lang")).where(usable & lang.isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("of")), "langs")
    # one row for each language: broadcast, so that no text is shuffled, if they are as few as they should be
    picked = rows.join(F.broadcast(sizes) if sizes.count() <= MOST_LANGS else sizes, "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < F.lit((1 << 30) * DOCS_PER_LANG) / F.col("of"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, out = [], []
            for x, lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), binaries(b.column(2))):
                rng = np.random.default_rng(zlib.crc32(str(x).encode()))
                starts = rng.integers(0, max(1, len(text) - WINDOW + 1), WINDOWS_PER_DOC)
                for s in starts if len(text) > WINDOW else [0]:
                    langs.append(lang)
                    out.append(text[s : s + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["lang", "piece"])

    return [(r["lang"], bytes(r["piece"])) for r in picked.select("doc_id", "lang", "text").mapInArrow(cut, "lang string, piece binary").collect()]


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (_ascii_letter(text) is not None or any(map(str.isalpha, text.decode("utf-8", "replace"))))


def _document_probabilities(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each text (none empty): mean probabilities, and the share of bytes each language labels."""
    L = len(net.langs)
    sizes = np.array([len(t) for t in texts])
    count = -(-sizes // WINDOW)
    first = np.concatenate([[0], np.cumsum(count)])
    flat = np.zeros(first[-1] * WINDOW, np.uint8)
    for t, s in zip(texts, first * WINDOW):
        flat[s : s + len(t)] = np.frombuffer(t, np.uint8)
    windows = flat.reshape(-1, WINDOW)
    valid = np.full(first[-1], WINDOW)
    valid[first[1:] - 1] = sizes - (count - 1) * WINDOW
    sums, labels = np.zeros((first[-1], L)), np.zeros((first[-1], L))
    for a in range(0, len(windows), TOGETHER):
        part = np.ascontiguousarray(windows[a : a + TOGETHER].T)
        q = position_probabilities(net, part)
        ends = valid[a : a + TOGETHER]
        if ends.min() < WINDOW:
            q *= (np.arange(WINDOW)[:, None] < ends).astype(F32)
        sums[a : a + TOGETHER] = q.sum(1).T
        most = q.max(0)
        free = most > 0  # a byte's label is its first most probable language
        for k in range(L):
            own = free & (q[k] == most)
            labels[a : a + TOGETHER, k] = own.sum(0)
            free ^= own
    pooled = np.add.reduceat(sums, first[:-1], axis=0) / sizes[:, None]
    return pooled, np.add.reduceat(labels, first[:-1], axis=0) / sizes[:, None]


def identify(spark: SparkSession, docs: DataFrame, net: Network | None, keep=None) -> DataFrame:
    """doc_id, lang_pred, score (the label's mean probability, 0 to 1) and share (of the bytes that
    carry this label themselves) for each row of ``docs``.

    Null texts and texts without a letter get ``und`` with score 0, as does everything if nothing
    was learned. With ``keep``, a function from (label, score) to bool, the rows of ``docs`` for which
    it holds are returned instead, with all their columns. Only doc_id and text are read.
    """
    small_batches(spark)
    if keep is None:
        docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
        schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, share double"
    else:
        schema = docs.schema
    model = spark.sparkContext.broadcast(net)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, SHARD_BYTES):
            net = model.value
            texts = binaries(shard.column("text").combine_chunks())
            langs, scores, shares = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if has_letter(t)] if net else []
            if at:
                q, s = _document_probabilities(net, [texts[i] for i in at])
                best = q.argmax(1)
                scores[at], shares[at] = np.clip(q[np.arange(len(at)), best], 0, 1), s[np.arange(len(at)), best]
                for i, k in zip(at, best):
                    langs[i] = net.langs[k]
            if keep is None:
                yield pa.RecordBatch.from_arrays([shard.column("doc_id").combine_chunks(), pa.array(langs, pa.string()), pa.array(scores), pa.array(shares)], ["doc_id", "lang_pred", "score", "share"])
            else:
                yield from shard.filter(pa.array([bool(keep(x, y)) for x, y in zip(langs, scores)], pa.bool_())).to_batches()

    return docs.mapInArrow(label, schema)
