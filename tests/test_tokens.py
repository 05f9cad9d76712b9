"""Tokeniser parity with Python's split / translate / lower, and stop words."""

from pyspark.sql import functions as F

from pyref import words as py_words
from textlens.functions.stopwords import STOP_WORDS
from textlens.functions.text import clean_words, rebuild_text, sample_id_from_label, word_slice, zero_fix_text

TEXTS = [
    "Hello, World! well-known",
    "tab\tseparated\fform feed",
    "nbsp here em space fs\u001csep",
    "  leading and trailing  ",
    "!!! ... ---",
    "",
    "UPPER lower MiXeD don't",
    "line\nbreaks\r\nand more　ideographic",
]


def test_clean_words_matches_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r["i"]: r["w"] for r in df.select("i", clean_words(F.col("t")).alias("w")).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == py_words(t), t


def test_stop_words(spark):
    assert len(STOP_WORDS) == 136 and len(set(STOP_WORDS)) == 136
    df = spark.createDataFrame([("The cat and the hat don't sit",)], "t string")
    got = df.select(clean_words(F.col("t"), list(STOP_WORDS)).alias("w")).first()["w"]
    assert got == py_words("The cat and the hat don't sit", set(STOP_WORDS))
    assert "dont" in got  # the list holds "don", not "dont"


def test_digit_label_tokens(spark):
    df = spark.createDataFrame([("a 0 b 1 10 c\t1",)], "t string")
    got = df.select(clean_words(F.col("t"), drop_digit_labels=True).alias("w")).first()["w"]
    assert got == ["a", "b", "10", "c"]


def test_slices_and_text(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],)], "w array<string>")
    r = df.select(
        rebuild_text(word_slice(F.col("w"), 1, 3)).alias("mid"),
        rebuild_text(word_slice(F.col("w"), 2, 2)).alias("empty"),
        rebuild_text(word_slice(F.col("w"), 0, 4)).alias("all"),
    ).first()
    assert r["mid"] == "b c " and r["empty"] == "" and r["all"] == "a b c d "


def test_labels(spark):
    df = spark.createDataFrame([("104359, words: 20", 8.0, 4.5)], "l string, v double, w double")
    r = df.select(
        sample_id_from_label(F.col("l")).alias("id"), zero_fix_text(F.col("v")).alias("z"), zero_fix_text(F.col("w")).alias("z2")
    ).first()
    assert r["id"] == "104359"
    assert r["z"] == "Value: 1 / 100000000"
    assert r["z2"] == "Value: 1 / " + str(round(10 ** 4.5))


def test_random_texts_match_python(spark):
    import random
    import string

    from textlens.functions.text import WHITESPACE_CHARS

    rnd = random.Random(11)
    alphabet = string.ascii_letters + "éÉßøÅ" + string.punctuation + WHITESPACE_CHARS + "01"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["w"] for r in df.select("i", clean_words(F.col("t")).alias("w")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_words(t), repr(t)
