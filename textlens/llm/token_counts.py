"""Token counts by a map-side two-tier lookup.

Tier one is a broadcast hash table: the token counts of the corpus's most frequent
pre-tokens. Tier two is a cache in each Python worker, filled by encoding the
pre-tokens that the table misses. No pre-token is shuffled: the only exchange merges
the tasks' short lists of frequent words (at most ``TASK_WORDS`` rows each).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm.common import id_text, small_batches

#: Most words in the broadcast table, and most that one task proposes for it. They bound memory only.
TABLE_WORDS, TASK_WORDS = 50_000, 10_000
#: Distinct words a task counts at once before it drops the rare ones, and entries a worker's cache holds.
COUNTED, CACHED = 200_000, 400_000
#: Longer pre-tokens are encoded each time they occur and are not kept.
LONGEST = 48

# The byte-level pre-token pattern, with the library's own white space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

_pieces = regex.compile(PRE_TOKEN).findall
#: In these ranges the pattern and the library put every character in the same class; elsewhere
#: their Unicode versions may differ, so texts with other characters are split by the library.
_settled = regex.compile(
    r"[\x00-\u052f\u0590-\u087f\u0900-\u0c3f\u0d00-\u206f\u20a0-\ua7bf\uac00-\uffff\U0001f000-\U0001faff\U00020000-\U0002a6df]*+"
).fullmatch


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others for the letters from U+0100 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Lengths:
    """Token counts of pre-tokens: the frequent ones by table, the rest by encoding, then from a cache."""

    _by_path: dict = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if type(self.tokenizer.pre_tokenizer).__name__ != "ByteLevel" or type(self.tokenizer.model).__name__ != "BPE" or self.tokenizer.normalizer:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        self.tokenize, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.specials = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, self.specials))).split if self.specials else lambda s: [s]
        self.cache: dict[str, int] = {}

    @classmethod
    def of(cls, path: str) -> Lengths:
        """One per worker process."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def pieces(self, text: str) -> list[str]:
        if _settled(text):
            return _pieces(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, pieces: list[str]) -> list[int]:
        tokenize, letters = self.tokenize, self.letters
        return [len(tokenize(p.encode().decode("latin-1").translate(letters))) for p in pieces]

    def count(self, text: str, frequent: dict[str, int]) -> int:
        parts = self.split(text)
        total = len(parts) - 1  # each special string is one token
        cache = self.cache
        for part in parts:
            found = [frequent.get(p) or cache.get(p) or p for p in self.pieces(part)]
            missed = [p for p in found if p.__class__ is str]
            if missed:
                new = list(dict.fromkeys(missed))
                lengths = dict(zip(new, self.encode(new)))
                total += sum(lengths[p] for p in missed)
                if len(cache) + len(lengths) > CACHED:
                    cache.clear()
                cache.update((p, n) for p, n in lengths.items() if len(p) <= LONGEST)
                found = [n for n in found if n.__class__ is int]
            total += sum(found)
        return total


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for b in batches:
        for text in b.column(0).to_pylist():
            if text:
                seen.update(text.split())
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 4)))
    top = [(w, n) for w, n in seen.most_common(TASK_WORDS) if n > 1 and len(w) <= LONGEST]
    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])


def frequent_lengths(docs: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the pre-tokens in the most frequent words of all documents (at most
    ``TABLE_WORDS`` words, so the result's size is bounded)."""
    top = docs.select("text").mapInArrow(_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = [r["word"] for r in top.orderBy(F.desc("n"), "word").limit(TABLE_WORDS).select("word").collect()]
    lengths = Lengths(path)
    pieces = list(dict.fromkeys(p for w in words for p in lengths.pieces(" " + w)))
    return dict(zip(pieces, lengths.encode(pieces)))


def token_counts(spark: SparkSession, docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) for each row of ``docs``.

    Counts are those of the tokenizer file at ``path`` without added special tokens. A null
    text counts as empty: 0 bytes, 0 tokens. Repeated rows and ids stay one row each; other
    columns are not read. An empty table gives no rows.
    """
    small_batches(spark)
    docs = id_text(docs, id_col, text_col)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, frequent = Lengths.of(path), table.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = pa.array([lengths.count(t, frequent) for t in texts], pa.int64())
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, n], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.mapInArrow(count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
