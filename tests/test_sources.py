"""Class-folder and labelled-line sources read from files."""

import os

from textlens.operators.lines import line_tokens, read_lines
from textlens.operators.model import tokenize
from textlens.sources.corpus import folder_corpus, folder_target, text_lines


def test_folder_corpus(spark, tmp_path):
    docs = {"sport": {"a1": "Goal! A great goal.", "a2": "match\nwon"}, "tech": {"b1": "new chip, fast chip"}}
    for c, files in docs.items():
        os.makedirs(tmp_path / c)
        for name, text in files.items():
            (tmp_path / c / name).write_text(text)
    fc = folder_corpus(spark, str(tmp_path))
    got = {(r["class"], r["doc_id"]): r["text"] for r in fc.collect()}
    assert got == {(c, n): t for c, files in docs.items() for n, t in files.items()}
    words = {r["doc_id"]: r["words"] for r in tokenize(fc).collect()}
    assert words["a2"] == ["match", "won"] and words["b1"] == ["new", "chip", "fast", "chip"]
    tgt = {r["class"]: r["target"] for r in folder_target(fc).select("class", "target").distinct().collect()}
    assert tgt == {"sport": 0.0, "tech": 1.0}


def test_labelled_lines_from_file(spark, tmp_path):
    lines = ["Great phone, works 1", "Battery died in 1 day 0", "", "Love it\t1", "Broken  0"]
    f = tmp_path / "amazon_cells_labelled.txt"
    f.write_text("\n".join(lines) + "\n")
    tl = text_lines(spark, str(f))
    got = {r["line_no"]: r["line"] for r in tl.collect()}
    assert got == {i: t for i, t in enumerate(lines)}
    toks = {r["line_no"]: r for r in line_tokens(tl).collect()}
    assert 2 not in toks  # blank line has no label
    assert toks[0]["class"] == "revs-amazon 1" and toks[0]["words"] == ["great", "phone", "works"]
    assert toks[1]["label"] == "0" and toks[1]["words"] == ["battery", "died", "in", "day"]
    split = read_lines(tl, 3, 2, "clean")
    assert {r["doc_id"]: r["split"] for r in split.collect()} == {0: "train", 1: "train", 3: "test", 4: "test"}


def test_plain_class_folders_train_and_score(spark, tmp_path):
    """``<class>/<sample>`` files whose names are no numbers, hold spaces and repeat between classes."""
    from textlens.plans.classify import classify
    from textlens.sources.corpus import folder_corpus

    words = {"revs-yelp 1": "good food", "a+b 50%": "loud music"}
    for c, text in words.items():
        (tmp_path / c).mkdir()
        for i in range(8):
            (tmp_path / c / f"s {i}.txt").write_text(f"{text} number{i}")
    corpus = folder_corpus(spark, str(tmp_path))
    assert {(r["class"], r["doc_id"]) for r in corpus.collect()} == {(c, f"s {i}.txt") for c in words for i in range(8)}
    run = classify(corpus)
    report = {r["class"]: r for r in run.report().collect()}
    assert report["revs-yelp 1"]["recall"] == report["a+b 50%"]["recall"] == 1
    run.release()


def test_line_numbers_do_not_depend_on_the_split_size(spark, tmp_path):
    """Three files, blank lines included, cut into few and into many byte ranges."""
    want = {}
    for f, name in enumerate(("yelp_labelled.txt", "imdb labelled+.txt", "amazon_cells_labelled.txt")):
        lines = ["" if i % 7 == 3 else f"line {i} of {name} " + "x" * (i * 37 % 90) for i in range(400 + 50 * f)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        want |= {(name, i): t for i, t in enumerate(lines)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "1k", "300b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = text_lines(spark, str(tmp_path)).collect()
            assert len(got) == len(want) and {(r["source"], r["line_no"]): r["line"] for r in got} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_written_in_parts(spark, tmp_path):
    from pyspark.sql import functions as F

    from textlens.sources.corpus import write_lines

    lines = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("source"), F.expr("id div 2").alias("line_no"))
    lines = lines.withColumn("line", F.when(F.col("line_no") % 5 == 0, "").otherwise(F.concat_ws(" ", "source", "line_no")))
    write_lines(lines, str(tmp_path / "out"))
    got = text_lines(spark, str(tmp_path / "out" / "*"), parts=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, lines.collect()))
