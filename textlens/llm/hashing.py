"""Words and word shingles of whole shards as 64-bit hashes, by arithmetic on byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from textlens.llm.common import mix64

U64 = np.uint64
#: Bytes hashed at once; a longer run is cut at white space, so a word is always whole.
CHUNK = 1 << 20
#: Odd, so that its powers have inverses modulo 2**64.
BASE = 0x2545F4914F6CDD1B
#: One odd multiplier for each place of a shingle.
PLACES = mix64(np.arange(1, 65, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)

_letters = mix64(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_letters[65:91] = _letters[97:123]  # A-Z as a-z
_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i below ``n``."""
    if n not in _powers:
        _powers.clear()
        _powers[n] = tuple(np.cumprod(np.append(U64(1), np.full(n - 1, x, U64)), dtype=U64) for x in (BASE, pow(BASE, -1, 1 << 64)))
    return _powers[n]


def _chunks(data: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        end, size = min(at + CHUNK, len(data)), CHUNK
        while end < len(data):
            gaps = np.flatnonzero(_space[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            size *= 2  # one word fills the chunk
            end = min(at + size, len(data))
        yield at, end
        at = end


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space, A-Z as a-z) of the texts in order, and how
    many each text has."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    hashes, starts = [], []
    for a, b in _chunks(data):
        part = data[a:b]
        gap = np.concatenate([[True], _space[part], [True]])
        turn = np.flatnonzero(gap[1:] != gap[:-1])
        begin, end = turn[::2], turn[1::2]
        if not len(begin):
            continue
        up, down = _power_tables(max(CHUNK, len(part)))
        total = np.concatenate([np.zeros(1, U64), np.cumsum(_letters[part] * up[: len(part)], dtype=U64)])
        hashes.append(mix64((total[end] - total[begin]) * down[begin] + (end - begin).astype(U64)))
        starts.append(begin + a)
    if not hashes:
        return np.zeros(0, U64), np.zeros(len(texts), np.int64)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(starts), ends), prepend=0)


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``k``-word shingles: one for the whole sequence
    if it has fewer words, none without words."""
    words, sizes = word_hashes(texts)
    first = np.concatenate([[0], np.cumsum(sizes)])
    whole = np.zeros(max(0, len(words) - k + 1), U64)
    for i in range(k if len(whole) else 0):
        whole += words[i : i + len(whole)] * PLACES[i]
    whole = mix64(whole)
    for a, n in zip(first.tolist(), sizes.tolist()):
        if n >= k:
            x = np.sort(whole[a : a + n - k + 1])
            yield x[np.concatenate([[True], x[1:] != x[:-1]])]
        elif n:
            yield mix64(np.array([(words[a : a + n] * PLACES[:n]).sum(dtype=U64) + U64(n)]))
        else:
            yield np.zeros(0, U64)
