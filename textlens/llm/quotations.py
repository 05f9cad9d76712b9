"""Quotation linking: which earlier message does a message quote, and so reply to?

Each message's lines are parsed into its own passages and quoted passages with their nesting level.
Passages are normalised and hashed as whole blocks, as paragraphs and as lines. Quoted hashes are joined
to the latest earlier message of the conversation that has the passage itself, outside quotes; the
longest unit that finds one decides. Messages that reply to each other form threads, and a conversation
in reply order is its messages by thread and turn, without their quotes.

Quotes and originals are never paired: the latest original before a quote is a running maximum over
turns, taken in chunks of turns, so one passage that fills a long conversation is split as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlens.llm.common import rows, small_batches, written
from textlens.llm.graph import components

#: Turns in one chunk of the running maximum.
CHUNK = 512
LINE, PARAGRAPH, BLOCK = 1, 2, 3

_mark = re.compile(r"^[ \t]*((?:>[ \t]?)+)(.*)$", re.DOTALL)
_intro = re.compile(r"^\s*(on\b.*\bwrote|am\b.*\bschrieb.*|le\b.*\ba écrit|el\b.*\bescribió)\s*:\s*$", re.IGNORECASE)
_word = re.compile(r"\w+")


def parse(text: str | None) -> list[tuple[int, list[str]]]:
    """Blocks of consecutive lines at one quote level: (level, lines). Level 0 is the message's own text.
    The line that introduces a quote ("On ... wrote:") belongs to no block."""
    lines = []
    for line in (text or "").split("\n"):
        m = _mark.match(line)
        lines.append((m[1].count(">"), m[2]) if m else (0, line))
    blocks: list[tuple[int, list[str]]] = []
    for i, (level, line) in enumerate(lines):
        if level == 0 and _intro.match(line) and any(x for x, _ in lines[i + 1 : i + 3]):
            continue
        if blocks and blocks[-1][0] == level:
            blocks[-1][1].append(line)
        else:
            blocks.append((level, [line]))
    return blocks


def unquoted(text: str | None) -> str | None:
    """The message's own lines; the text itself if it has no quote."""
    if text is None:
        return None
    blocks = parse(text)
    if all(level == 0 for level, _ in blocks) and sum(len(x) for _, x in blocks) == text.count("\n") + 1:
        return text
    return "\n".join("\n".join(x) for level, x in blocks if level == 0).strip("\n")


def passage_hash(text: str) -> int | None:
    """A hash of the words in lower case; ``None`` without words."""
    words = _word.findall(text.lower())
    return int.from_bytes(hashlib.blake2b(" ".join(words).encode(), digest_size=8).digest(), "little", signed=True) if words else None


def units(lines: list[str]) -> Iterator[tuple[int, int]]:
    """(kind, hash) of a block, its paragraphs and its lines, as far as they have words."""
    paragraphs = re.split(r"\n[ \t]*\n", "\n".join(lines))
    for kind, texts in ((BLOCK, ["\n".join(lines)]), (PARAGRAPH, paragraphs), (LINE, lines)):
        for t in texts:
            if (h := passage_hash(t)) is not None:
                yield kind, h


def _passages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, passage (its number in the message), kind and hash of every unit."""

    def cut(batches):
        for b in batches:
            at, out = [], {"level": [], "passage": [], "kind": [], "hash": []}
            for i, text in enumerate(b.column(2).to_pylist()):
                blocks = parse(text)
                # a quoted message may have been answered in pieces, so its own text is one block as well
                own = [line for level, x in blocks if level == 0 for line in x]
                for p, (level, x) in enumerate([*((n, x) for n, x in blocks if n), (0, own)]):
                    for kind, h in dict.fromkeys(units(x)):
                        at.append(i)
                        for c, v in zip(out, (level, p, kind, h)):
                            out[c].append(v)
            kinds = {"level": pa.int32(), "passage": pa.int32(), "kind": pa.int32(), "hash": pa.int64()}
            where = pa.array(at, pa.int64())
            yield rows({"conv_id": b.column(0).take(where), "turn": b.column(1).take(where)} | {c: pa.array(v, kinds[c]) for c, v in out.items()})

    conv, turn = (messages.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    return messages.mapInArrow(cut, f"conv_id {conv}, turn {turn}, level int, passage int, kind int, hash long")


def _latest_before(quotes: DataFrame, originals: DataFrame) -> DataFrame:
    """``quotes`` (conv_id, hash, turn, ...) with the latest turn below theirs among ``originals``."""
    key = ["conv_id", "hash"]
    wanted = originals.select(*key, "turn").distinct().join(quotes.select(*key).distinct(), key, "left_semi")
    events = quotes.withColumn("own", F.lit(None).cast("long")).unionByName(wanted.withColumn("own", F.col("turn")), allowMissingColumns=True)
    events = events.withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    tops = events.groupBy(*key, "chunk").agg(F.max("own").alias("top"))
    before = Window.partitionBy(*key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*key, "chunk", F.max("top").over(before).alias("carried"))
    near = Window.partitionBy(*key, "chunk").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = events.withColumn("near", F.max("own").over(near)).where("own is null").join(tops, [*key, "chunk"])
    return found.withColumn("original", F.coalesce("near", "carried")).drop("own", "chunk", "near", "carried")


def linked_messages(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """For each row of ``conversations`` (conv_id, turn, role, text): conv_id, turn, role, n_quotes (its
    quoted passages), n_linked (those with an original), reply_to (the turn it replies to, null if it
    quotes nothing found), thread (the first turn of its thread) and text without quotes. Ordered by
    conv_id, thread and turn, a conversation is in reply order.

    An outer quote decides before a nested one, then the longer unit, then the later original. Null and
    empty texts quote nothing and are no original. Rows with a null conv_id or turn are threads of their
    own with a null thread. Repeated (conv_id, turn) are one message for links and keep their rows.
    Only the four columns are read. An empty table gives no rows.
    """
    small_batches(spark)
    messages = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    known = messages.where("conv_id is not null and turn is not null").select("conv_id", "turn", "text")
    units = written(_passages(known), "passages")
    quotes, originals = units.where("level > 0"), units.where("level = 0")
    found = _latest_before(quotes, originals)
    # each passage by its longest unit that has an original
    passages = found.groupBy("conv_id", "turn", "passage").agg(F.min("level").alias("level"), F.max(F.when(F.col("original").isNotNull(), F.struct("kind", "original"))).alias("best"))
    replies = passages.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n_quotes"),
        F.count("best").alias("n_linked"),
        F.max(F.when(F.col("best").isNotNull(), F.struct((-F.col("level")).alias("outer"), "best.kind", "best.original"))).alias("parent"),
    )
    replies = written(replies.select("conv_id", "turn", "n_quotes", "n_linked", F.col("parent.original").alias("reply_to")), "replies")
    node = [F.struct("conv_id", F.col(c).alias("turn")) for c in ("turn", "reply_to")]
    threads = components(replies.where("reply_to is not null").select(node[0].alias("a"), node[1].alias("b")))
    threads = threads.select("node.conv_id", "node.turn", F.col("root.turn").alias("thread"))

    def clean(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([unquoted(t) for t in b.column(3).to_pylist()], pa.string())], b.schema.names)

    every = messages.mapInArrow(clean, messages.schema).join(replies, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_quotes", "n_linked")]
    own = F.when(F.col("conv_id").isNotNull(), F.coalesce("thread", "turn")).alias("thread")
    return every.select("conv_id", "turn", "role", *counts, "reply_to", own, "text")


def in_reply_order(messages: DataFrame) -> DataFrame:
    """The messages sorted for reading or writing; ranges of rows, so a long conversation is split."""
    return messages.repartitionByRange("conv_id", "thread", "turn").sortWithinPartitions("conv_id", "thread", "turn")
