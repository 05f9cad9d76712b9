"""Spelling variants by permuterm rotations.

A word ``w`` with the terminator ``$`` has one rotation for each way to cut it: ``B$A`` for ``w = AB``.
If ``w = AxB``, its rotation that ends with ``x`` is ``B$Ax``: without the last letter it is ``B$A``, the
prefix that every word ``AyB`` shares (a replaced letter), and the whole rotation of ``AB`` itself (a letter
less). So one sort of all whole rotations, and of those short of their last letter, puts words of edit
distance one next to each other; a group holds at most one word for each letter of the alphabet and the
word without it. Groups are scanned in sorted order and each member learns how many neighbours it has there
and the most frequent of them; no pairs are made.

A word may meet the same shorter word in several groups, when the dropped letter stands in a run of equal
ones (``aab`` and ``ab``); it counts only at the first letter of the run. A replacement has one place.

Rotations longer than ``LONGEST`` letters would take the square of their length. Their keys are 127-bit
polynomial hashes of the same strings, and their words are named by digests until the end.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlens.llm.common import binaries, id_text, rows, small_batches, written

#: Words have at least so many letters and occurrences.
MIN_LETTERS, MIN_COUNT = 5, 3
#: A form is at least so many times as frequent as the word.
RATIO = 2
#: One word in ``DROPPED`` of a document loses a letter, by the crc32 of document and word.
DROPPED = 97
#: Rotations of at most so many letters, beside the terminator, are kept as text.
LONGEST = 64
#: Distinct words, and bytes of them, that a task counts before it sends them.
HELD_WORDS, HELD_BYTES = 400_000, 32 << 20
PRIME, BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F

_lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_runs = re.compile(rf"[a-zÀ-ÿ]{{{MIN_LETTERS},}}").findall


def _written_as(word: str, start: int) -> str:
    """The word as it counts: without one letter for one in ``DROPPED`` of the hashes."""
    h = zlib.crc32(word.encode(), start)
    return word if h % DROPPED else word[: h % len(word)] + word[h % len(word) + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts of ``docs`` (doc_id, text) with enough letters and occurrences.
    Words are counted in the tasks first, so a frequent one is shuffled once for each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = Counter(), 0

        def flush():
            return rows({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), binaries(b.column(1))):
                start = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
                for run, k in Counter(_runs((text or b"").translate(_lower).decode())).items():
                    word = _written_as(run, start)
                    if word not in seen:
                        size += len(word)
                    seen[word] += k
                if len(seen) >= HELD_WORDS or size >= HELD_BYTES:
                    yield flush()
                    seen, size = Counter(), 0
        yield flush()

    counted = docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= MIN_COUNT) & (F.char_length("word") >= MIN_LETTERS))


RECORD = "key string, id string, n long, kind int, place long"
#: What a rotation stands for: the whole word; the word without its last letter, the first of a run of
#: equal ones; without another letter of a run.
WHOLE, SHORT, SHORT_AGAIN = 0, 1, 2


def _text_rotations(words: DataFrame, longest: int) -> DataFrame:
    """The rotations that are kept as text; their groups are ordered by the words themselves."""
    size = F.char_length("word")

    def letters(start, n):
        return F.substr("word", start, n)

    def whole(i):
        return F.struct(F.concat(letters(i + 1, size), F.lit("$"), letters(F.lit(1), i)).alias("key"), F.lit(WHOLE).alias("kind"))

    def short(i):
        first = (i == 1) | (letters(i, F.lit(1)) != letters(i - 1, F.lit(1)))
        kind = F.when(first, SHORT).otherwise(SHORT_AGAIN)
        return F.struct(F.concat(letters(i + 1, size), F.lit("$"), letters(F.lit(1), i - 1)).alias("key"), kind.alias("kind"))

    wholes = F.when(size <= longest, F.transform(F.sequence(F.lit(0), size), whole)).otherwise(F.array())
    shorts = F.transform(F.sequence(F.lit(1), size), short)
    some = words.where(size <= longest + 1)
    each = some.select(F.col("word").alias("id"), "n", F.explode(F.concat(wholes, shorts)).alias("r"))
    return each.select("r.key", "id", "n", "r.kind", F.lit(None).cast("long").alias("place"))


def word_id(word: str, longest: int) -> str:
    """The word, or the digest of one with rotations that are hashed only (it has digits, a word none)."""
    return word if len(word) <= longest + 1 else hashlib.sha256(word.encode()).hexdigest()


def _hashed(word: str, longest: int) -> Iterator[tuple]:
    """(key, kind, place) of the rotations of one long word, by prefix hashes. ``place`` orders the words
    of a group: a letter's code twice; beside it the word without the letter, by where it sorts."""
    n, head, power = len(word), [0], [1]
    for c in word:
        head.append((head[-1] * BASE + ord(c)) % PRIME)
        power.append(power[-1] * BASE % PRIME)
    power.append(power[-1] * BASE % PRIME)
    after = [0] * n  # the letter behind the run that starts here, 0 at the end
    for i in range(n - 2, -1, -1):
        after[i] = after[i + 1] if word[i + 1] == word[i] else ord(word[i + 1])

    def key(i, j):  # word[i:] + "$" + word[:j]
        tail = (head[n] - head[i] * power[n - i]) % PRIME
        return f"#{(tail * power[j + 1] + 36 * power[j] + head[j]) % PRIME:032x}{n - i + j}"

    for i in range(n + 1):
        here = ord(word[i]) if i < n else 0
        yield key(i, i), WHOLE, 2 * here + (1 if i < n and after[i] > here else -1)
    if n > longest + 1:
        for i in range(n):
            yield key(i + 1, i), SHORT_AGAIN if i and word[i] == word[i - 1] else SHORT, 2 * ord(word[i])


def _hashed_rotations(words: DataFrame, longest: int) -> DataFrame:
    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys, kinds, places = zip(*_hashed(word, longest))
                yield pa.RecordBatch.from_pydict(
                    {"key": keys, "id": [word_id(word, longest)] * len(keys), "n": [n] * len(keys), "kind": kinds, "place": places},
                    pa.schema([("key", pa.string()), ("id", pa.string()), ("n", pa.int64()), ("kind", pa.int32()), ("place", pa.int64())]),
                )

    return words.where(F.char_length("word") > longest).mapInArrow(rotate, RECORD)


def _neighbours(records: DataFrame) -> DataFrame:
    """(id, near, best_n, best): for each record with company in its group, how many neighbours count
    there, and the most frequent other member (of equal ones the first word)."""
    group = Window.partitionBy("key").orderBy(F.desc("n"), "place", "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = F.struct("n", "id")
    seen = records.select(
        "id",
        "kind",
        F.count(F.lit(1)).over(group).alias("members"),
        F.sum(F.when(F.col("kind") == SHORT, 1).otherwise(0)).over(group).alias("firsts"),
        F.sum(F.when(F.col("kind") == WHOLE, 1).otherwise(0)).over(group).alias("wholes"),
        F.first(one).over(group).alias("top"),
        F.nth_value(one, 2).over(group).alias("next"),
    ).where("members > 1")
    replaced = F.col("members") - F.col("wholes") - 1
    near = F.when(F.col("kind") == WHOLE, F.col("firsts")).when(F.col("kind") == SHORT, replaced + F.col("wholes")).otherwise(replaced)
    best = F.when(F.col("top.id") == F.col("id"), F.col("next")).otherwise(F.col("top"))
    return seen.select("id", near.alias("near"), best["n"].alias("best_n"), best["id"].alias("best"))


def _forms(words: DataFrame, near: DataFrame, long_words: DataFrame | None) -> DataFrame:
    """(id, n, n_near, form, form_n), by ids. Among equally frequent neighbours the smallest word counts;
    where ids are no words, those words are fetched for the comparison."""
    if long_words is not None:
        least = near.groupBy("id").agg(F.max("best_n").alias("most"))
        tied = near.join(least, "id").where("best_n = most or near > 0").join(long_words.select(F.col("id").alias("best"), F.col("word").alias("best_word")), "best", "left")
        by = F.struct((-F.col("best_n")).alias("n"), F.coalesce("best_word", "best").alias("word"), F.col("best").alias("id"))
    else:
        tied, by = near, F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"), F.col("best").alias("id"))
    found = tied.groupBy("id").agg(F.sum("near").alias("n_near"), F.min(by).alias("b"))
    enough = -F.col("b.n") >= RATIO * F.col("n")
    return words.join(found, "id", "left").select(
        "id",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("b.id")).alias("form"),
        F.when(enough, -F.col("b.n")).alias("form_n"),
    )


def _roots(forms: DataFrame) -> DataFrame | None:
    """(id, root) of the words with a form, level by level from the roots down. A form is at least twice
    as frequent, so there are fewer levels than bits in the largest count, and a word has a bounded
    number of neighbours, so no key of a join is hot."""
    links = forms.where("form is not null").select("id", "form")
    level = forms.where("form is null").select(F.col("id").alias("form"), F.col("id").alias("root"))
    found = None
    while True:
        level = written(links.join(level, "form").select("id", "root"), "level")
        if level.isEmpty():
            return found
        found = level if found is None else found.unionByName(level)
        level = level.withColumnRenamed("id", "form")


def spelling_variants(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs``.

    Words are runs of letters (A-Z as a-z) with at least ``MIN_LETTERS`` letters and ``MIN_COUNT``
    occurrences (n); the crc32 of ``<doc_id>:<word>`` takes a letter from one in ``DROPPED``. n_near counts
    the words one inserted, deleted or replaced letter away. form is the most frequent of them (of equal
    ones the smallest) if it is at least ``RATIO`` times as frequent, else null, and form_n its count; root
    is the end of the chain of forms, the word itself without one.

    Null and empty texts have no words; a null id counts as the empty text. Repeated rows count again.
    Only the id and text columns are read. An empty table, or one without such words, gives no rows.
    Words of more than ``longest`` letters are exact up to equal 127-bit hashes.
    """
    small_batches(spark)
    words = written(word_counts(id_text(docs, id_col, text_col)), "words")
    size = F.char_length("word")
    words = words.withColumn("id", F.when(size > longest + 1, F.sha2(F.col("word").cast("binary"), 256)).otherwise(F.col("word")))
    any_long = not words.where(size > longest).isEmpty()
    records = _text_rotations(words, longest)
    if any_long:
        records = records.unionByName(_hashed_rotations(words.select("word", "n"), longest))
    long_words = words.where(size > longest + 1).select("id", "word") if any_long else None
    forms = written(_forms(words.select("id", "n"), _neighbours(records), long_words), "forms")
    roots = _roots(forms)
    out = forms.withColumn("root", F.col("id")) if roots is None else forms.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    out = out.withColumnRenamed("id", "word")
    if long_words is not None:
        for c in ("word", "form", "root"):
            named = long_words.select(F.col("id").alias(c), F.col("word").alias("_text"))
            out = out.join(named, c, "left").withColumn(c, F.coalesce("_text", c)).drop("_text")
    return out.select("word", "form", "root", "n", "n_near", "form_n")
