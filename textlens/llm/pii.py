"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Seeds are the matches of four formats (e-mail, IP, card, phone). The words around a seed make lexical
patterns: the two words before it, and the word on either side. Every other token with a digit or
an at sign is a candidate instance; patterns and instances form a graph. In each round a pattern's
confidence in a kind is the share of its instances that are of that kind (seeds count 1, candidates
their score so far), and a candidate's score is the noisy-or of its patterns' confidences. Candidates
that end with a high score, and look like the kind, are added to the seeds' spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textlens.llm.common import id_text, written

#: Distinct seeds that a pattern needs, rounds of scoring, and the score at which a candidate is added.
MIN_SEEDS, ROUNDS, MIN_SCORE = 4, 3, 0.75
#: Characters of context kept on either side of a match.
LEFT, RIGHT = 64, 32

# The formats, in the order in which kinds are listed. Possessive, and anchored at the
# start of a run, so that they match the same but take linear time and constant stack.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to occur at all.
GUARDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [(0-9][0-9().-]*+)*+"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
SPANS = "array<struct<start:int,kind:string,end:int,base:boolean>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _valid(kind: str, m: Column) -> Column:
    """A match of the format that is no false one."""
    if kind == "ip":
        return m.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$")
    if kind == "card":
        return F.length(m).between(14, 37) & F.length(_digits(m)).between(14, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


MATCHES = "array<struct<kind:string,i:int,match:string,gap:int,left:string,right:string>>"


def _matches(df: DataFrame, n: int, kind: str, pattern: str) -> tuple[DataFrame, Column]:
    """``df`` with the matches of a pattern and the text between them, and both as ``MATCHES``."""
    matches, gaps = f"m_{n}", f"g_{n}"
    guard = F.lit(True) if GUARDS.get(kind) is None else F.contains("text", F.lit(GUARDS[kind]))
    found = F.when(guard, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    if kind != "?":
        found = F.when(F.exists(found, lambda m: _valid(kind, m)), found)
    df = df.withColumn(matches, found)
    df = df.withColumn(gaps, F.when(F.size(matches) > 0, F.split("text", pattern, -1)))

    def around(m, i):
        gap = F.get(gaps, i)
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            m.alias("match"),
            F.char_length(gap).alias("gap"),
            F.right(gap, F.lit(LEFT)).alias("left"),
            F.left(F.get(gaps, i + 1), F.lit(RIGHT)).alias("right"),
        )

    return df, F.coalesce(F.transform(matches, around).cast(MATCHES), F.array().cast(MATCHES))


def _found(docs: DataFrame) -> DataFrame:
    """Matches of the formats and candidates, a row each: doc_id, row, kind (``?`` for candidates),
    start and end in code points, match, valid, and the text around it up to the kind's next match."""
    some, lists = docs.where(F.col("text").rlike("[0-9@]")), []
    for n, (kind, pattern) in enumerate((*KINDS.items(), ("?", CANDIDATE))):
        some, matches = _matches(some, n, kind, pattern)
        lists.append(matches)
    rows = some.select("doc_id", "row", F.explode(F.concat(*lists)).alias("f")).select("doc_id", "row", "f.*")
    # equal rows (id and text) find the same; they are one here
    rows = rows.dropDuplicates(["doc_id", "row", "kind", "i"])
    before = Window.partitionBy("doc_id", "row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.char_length("match")).over(before).cast("int"))
    rows = rows.withColumn("start", (F.col("end") - F.char_length("match")).cast("int"))
    valid = F.lit(False)
    for kind in KINDS:
        valid = F.when(F.col("kind") == kind, _valid(kind, F.col("match"))).otherwise(valid)
    # a candidate stands without the brackets and stops around it
    front = F.char_length(F.regexp_extract("match", r"^[(\[{<\"']*", 0))
    core = F.when(F.col("kind") == "?", F.regexp_replace(F.col("match").substr(front + 1, F.char_length("match")), r"[.,;:!?)\]}>\"']+$", "")).otherwise(F.col("match"))
    rows = rows.withColumn("valid", valid).withColumn("core", core).withColumn("front", F.when(F.col("kind") == "?", front).otherwise(0))
    rows = rows.withColumn("start", F.col("start") + F.col("front")).withColumn("end", F.col("start") + F.char_length("core"))
    return rows.where((F.col("kind") == "?") & (F.char_length("core") > 3) | F.col("valid")).select("doc_id", "row", "kind", "start", "end", "core", "left", "right")


def _patterns(rows: DataFrame) -> DataFrame:
    """One row for each lexical pattern that a match stands in."""
    words = F.regexp_extract_all(F.lower("left"), F.lit(r"\S+"), F.lit(0))
    after = F.regexp_extract(F.lower("right"), r"^\s*(\S+)", 1)
    one, two = F.try_element_at(words, F.lit(-1)), F.try_element_at(words, F.lit(-2))
    both = F.array(F.concat(F.lit("before|"), two, F.lit(" "), one), F.when(after != "", F.concat(F.lit("around|"), one, F.lit(" "), after)))
    return rows.withColumn("instance", F.lower("core")).withColumn("pattern", F.explode(F.filter(both, lambda p: p.isNotNull())))


def _looks_like(kind: Column, core: Column) -> Column:
    n = F.length(_digits(core))
    return (
        F.when(kind == "email", core.contains("@"))
        .when(kind == "ip", (n >= 3) & core.rlike(r"[.:].*[.:]"))
        .when(kind == "card", n.between(12, 19))
        .otherwise(n.between(7, 15))
    )


def _additions(found: DataFrame) -> DataFrame:
    """Candidate spans that the bootstrapping accepts, with their kind."""
    # a candidate that touches a seed is none
    near = Window.partitionBy("doc_id", "row").orderBy("start", "end")
    seed_end, seed_start = (F.when(F.col("kind") != "?", F.col(c)) for c in ("end", "start"))
    free = found.withColumn("till", F.max(seed_end).over(near.rowsBetween(Window.unboundedPreceding, -1)))
    free = free.withColumn("from", F.min(seed_start).over(near.rowsBetween(1, Window.unboundedFollowing)))
    free = free.where((F.col("kind") == "?") & (F.coalesce("till", F.lit(-1)) <= F.col("start")) & (F.coalesce("from", F.col("end")) >= F.col("end")))
    seeds = _patterns(found.where("kind != '?'")).select("pattern", "kind", "instance").distinct()
    of = seeds.groupBy("pattern").agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in KINDS], F.count(F.lit(1)).alias("seeds"))
    strong = of.where(F.greatest(*KINDS) >= MIN_SEEDS)
    edges = written(_patterns(free).select("pattern", "instance").distinct().join(strong, "pattern"), "edges")
    schema = T.StructType([T.StructField("instance", T.StringType()), *[T.StructField(f"s_{k}", T.DoubleType()) for k in KINDS]])
    scores = found.sparkSession.createDataFrame([], schema)
    for _ in range(ROUNDS):
        known = edges.join(scores, "instance", "left")
        sure = known.groupBy("pattern", "seeds", *KINDS).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.coalesce(f"s_{k}", F.lit(0.0))).alias(f"t_{k}") for k in KINDS])
        sure = sure.select("pattern", *[F.when(F.col(k) >= MIN_SEEDS, (F.col(k) + F.col(f"t_{k}")) / (F.col("seeds") + F.col("n") + 1)).otherwise(0.0).alias(f"c_{k}") for k in KINDS])
        scored = edges.select("pattern", "instance").join(sure, "pattern").groupBy("instance")
        scores = scored.agg(*[(1 - F.exp(F.sum(F.log1p(-F.col(f"c_{k}"))))).alias(f"s_{k}") for k in KINDS])
    best = F.array_max(F.array(*[F.struct(F.col(f"s_{k}").alias("score"), (-F.lit(i)).alias("i"), F.lit(k).alias("kind")) for i, k in enumerate(KINDS)]))
    accepted = scores.select("instance", best.alias("best")).where(F.col("best.score") >= MIN_SCORE).select("instance", F.col("best.kind").alias("as_kind"))
    spans = free.withColumn("instance", F.lower("core")).join(accepted, "instance").where(_looks_like(F.col("as_kind"), F.col("core")))
    return spans.select("doc_id", "row", F.col("as_kind").alias("kind"), "start", "end")


def personal_data(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (a hash of the text) and spans for each document with personal data: its spans by
    start, kind and end, in code points, end exclusive, base true for the formats' own matches.

    One row for each distinct (id, text). Null and empty texts have none. Matches of one kind never
    overlap, those of different kinds may. Only the id and text columns are read.
    """
    docs = id_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    found = written(_found(docs), "found")
    base = found.where("kind != '?'").select("doc_id", "row", "kind", "start", "end", F.lit(True).alias("base"))
    spans = base.unionByName(_additions(found).withColumn("base", F.lit(False)))
    spans = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", _order(F.col("kind")).alias("k"), "end", "kind", "base")).alias("spans"))
    return spans.select("doc_id", "row", F.transform(F.array_sort("spans"), lambda s: F.struct(s["start"], s["kind"], s["end"], s["base"])).cast(SPANS).alias("spans"))


def with_spans(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans for every row of ``docs``, an empty array without any; repeated rows stay."""
    found = personal_data(spark, docs, id_col, text_col)
    each = id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("row"))
    same = each["doc_id"].eqNullSafe(found["doc_id"]) & (each["row"] == found["row"])
    return each.join(found, same, "left").select(each["doc_id"], F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def redacted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; overlapping spans become
    one, named by the first. All columns and rows stay."""
    found = personal_data(spark, docs)
    merged = F.expr(
        "aggregate(spans, cast(array() as array<struct<start:int,kind:string,end:int>>), (a, s) -> "
        "if(size(a) > 0 and s.start < element_at(a, -1).end, "
        "concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'kind', element_at(a, -1).kind, 'end', greatest(element_at(a, -1).end, s.end)))), "
        "concat(a, array(named_struct('start', s.start, 'kind', s.kind, 'end', s.end)))))"
    )
    cuts = found.select(F.col("doc_id").alias("__pii_id"), F.col("row").alias("__pii_row"), merged.alias("__pii_spans"))
    same = docs["doc_id"].eqNullSafe(cuts["__pii_id"]) & (F.xxhash64(docs["text"].cast("string")) == cuts["__pii_row"])
    joined = docs.join(cuts, same, "left")

    def piece(s, i):
        start = F.coalesce(F.get("__pii_spans", i - 1)["end"], F.lit(0))
        return F.concat(F.substring(docs["text"], start + 1, s["start"] - start), F.lit("["), F.upper(s["kind"]), F.lit("]"))

    pieces = F.transform("__pii_spans", piece)
    last = F.substring(docs["text"], F.element_at("__pii_spans", -1)["end"] + 1, F.char_length(docs["text"]))
    text = F.when(F.col("__pii_spans").isNull(), docs["text"]).otherwise(F.concat(F.array_join(pieces, ""), last))
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])
