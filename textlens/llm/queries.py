"""The registered queries of this package: ``QUERIES[name](spark, sf_dir)`` and, where SQL
can express the result, ``ORACLE[name]`` for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.llm.common import crc_mod, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

#: Tokenizer files are found by name in this public package, or given as a path.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_token_counts(spark, sf_dir):
    from textlens.llm.token_counts import token_counts

    return token_counts(spark, table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op6_decontaminate(spark, sf_dir):
    from textlens.llm.decontaminate import contamination

    found = contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
        "longest",
    )


@query
def op10_language_id(spark, sf_dir):
    from textlens.llm.language_id import identify, train, training_windows

    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    net = train(training_windows(docs, F.col("lang"), ~held_out))
    return identify(spark, docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "share")


@query
def op9_ngram_join(spark, sf_dir):
    from textlens.llm.ngram_join import jaccard_components

    return jaccard_components(spark, table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op3_lm_score(spark, sf_dir):
    from textlens.llm.lm_score import lm_scores

    return lm_scores(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


@query
def op1_pii(spark, sf_dir):
    from textlens.llm.pii import KINDS, with_spans

    found = with_spans(spark, table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )


@query
def op4_license_scan(spark, sf_dir):
    from textlens.llm.licenses import licenses

    found = licenses(spark, table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


@query
def op7_near_vectors(spark, sf_dir):
    from textlens.llm.near_vectors import near_vectors

    return near_vectors(spark, table(spark, sf_dir, "embeddings"))


@query
def op2_quotations(spark, sf_dir):
    from textlens.llm.quotations import in_reply_order, linked_messages

    return in_reply_order(linked_messages(spark, table(spark, sf_dir, "conversations")))


#: The registered mixture: domains from the labels table, and the shares of tokens to reach.
MIX = {"good": 0.7, "plain": 0.3, "toxic": 0.0}


def label_domain():
    """toxic, else good or plain by quality; null without labels."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "plain")


@query
def op8_mixing(spark, sf_dir):
    from textlens.llm.mixing import mixture

    return mixture(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label_domain(), MIX)


@query
def op11_exact_dedup(spark, sf_dir):
    from textlens.llm.exact_dedup import exact_duplicates

    return exact_duplicates(spark, table(spark, sf_dir, "documents"))


ORACLE["op11_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (
  SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""


@query
def op12_spelling_variants(spark, sf_dir):
    from textlens.llm.spelling import spelling_variants

    return spelling_variants(spark, table(spark, sf_dir, "documents"))


@query
def op13_lexical_search(spark, sf_dir):
    from textlens.llm.lexical_search import lexical_search

    return lexical_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_lexical_search"] = """
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), sizes AS (
  SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), whole AS (
  SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM sizes
), asked AS (
  SELECT item_id, term, count(*) AS k FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM benchmark
  ) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, whole WHERE term IN (SELECT term FROM asked) GROUP BY term, big_n
), scored AS (
  SELECT item_id, doc_id, sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
