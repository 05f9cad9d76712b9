"""Expected values for hand-made fixtures, from the stated rules: vectors over words and candidates."""

from __future__ import annotations

import re
import string
from collections import Counter

import numpy as np

_punctuation = re.compile(f"[{re.escape(string.punctuation)}]")


def words(text, stop=()):
    stripped = (_punctuation.sub("", token).lower() for token in text.split())
    return [w for w in stripped if w and w not in stop]


def train(docs):
    """(class, text) pairs -> documents per class, and word counts per class."""
    pairs = Counter((c, w) for c, text in docs for w in words(text))
    counts = {c: Counter({w: n for (k, w), n in pairs.items() if k == c}) for c in sorted({c for c, _ in pairs})}
    return Counter(c for c, _ in docs), counts


def _in_order(start, steps, op):
    """``start`` combined with the steps one after the other, as a scan rounds."""
    return op.accumulate(np.concatenate([[float(start)], steps]))[-1]


def score(ws, priors, lik, mode, zero_fix=1e-8, classes=None):
    """A candidate's total: its prior and a term for each word, as a vector formula over the counts.

    product: prior * prod((n_w + 1) / n). floor: ln prior + sum ln max(zero_fix, n_w / n).
    add-one: ln prior + sum ln((n_w + 1) / n); as coded, with the prior twice and without the last word.
    """
    totals = {}
    for c in classes or sorted(lik):
        n_w, n = np.array([lik[c][w] for w in ws], float), float(sum(lik[c].values()))
        if mode == "product":
            totals[c] = _in_order(priors[c], (n_w + 1) / n, np.multiply)
        else:
            terms = np.log(np.maximum(zero_fix, n_w / n) if mode == "floor" else (n_w + 1) / n)
            prior = np.log(priors[c])
            totals[c] = _in_order(prior, [prior, *terms[:-1]] if mode == "addone_as_coded" else terms, np.add)
    return totals


def argmax(totals, reject=-1e6):
    """The first candidate with the largest total, none if that is not above the limit."""
    best = max(totals.values())
    return [c for c, v in totals.items() if v == best][0] if best > reject else ""


def pmap(values, prior=False):
    """Shares of 99.99 (three values: 33.33 each) about the mean; log scores are mirrored at it."""
    v = np.asarray(values, float)
    mean, unit = v.sum() / len(v), 33.33 if len(v) == 3 else 99.99 / len(v)
    return ((v if prior else 2 * mean - v) * unit / mean).tolist()


def running(term_rows, start, end, chunk):
    """Percents of the sums so far at each word of [start, end), and those at the reset points.

    The sums restart after the words at distance chunk, 2 chunk, ... from the start: the first stretch
    has chunk + 1 words, the others chunk."""
    terms = np.asarray(term_rows[start:end], float)
    stretches = np.split(terms, range(chunk + 1, len(terms), chunk))
    percents = [pmap(sums) for s in stretches if len(s) for sums in s.cumsum(axis=0)]
    return percents, [(start + i, percents[i]) for i in range(chunk, len(terms), chunk)]


def top_second(values):
    """The largest value if positive (else 0 and no index) and the second. The second is the largest
    other value; but with nothing positive before the largest, values before it do not count, and
    without a value after it the second is 0."""
    v = np.asarray(values, float)
    i = int(v.argmax())
    if v[i] <= 0:
        return 0, v[i], -1
    others = np.delete(v, i) if (v[:i] > 0).any() else v[i + 1 :]
    return v[i], others.max(initial=-np.inf) if len(others) else 0, i
