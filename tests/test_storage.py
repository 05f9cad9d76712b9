"""The payload document, the run log, the sample store and class folders on storage."""

import json
import random

import pytest
from pyspark.sql import functions as F

from textlens.operators import evaluate as ev
from textlens.operators import explain as X
from textlens.plans.classify import classify
from textlens.sources import model_io as M
from textlens.sources.corpus import folder_corpus, write_plain_folders
from textlens.sources.document import document_lines, read_document, write_document

NAMES = ['a"b', "c\\d", "é 1", "10", "2"]


@pytest.fixture(scope="module")
def run(spark):
    draw = random.Random(3)
    rows = [(f"{n} {i}", c, " ".join(draw.choice("uno dos tres  ein zwei one two".split(" ")) for _ in range(draw.randrange(1, 9)))) for c in ("x y", "b", 'q"') for i, n in enumerate(NAMES * 3)]
    r = classify(spark.createDataFrame(rows, "doc_id string, class string, text string"), zero_fix=1e-3, classes=["x y", "b", 'q"'])
    return r, X.position_terms(r.test, r.model, r.header, zero_fix=1e-3).persist()


def test_document_is_one_json_document(spark, run, tmp_path):
    r, pt = run
    path = str(tmp_path / "doc")
    write_document(document_lines(r.model, pt, r.report(), r.accuracy(), r.header).repartition(5), path)
    with open(f"{path}/commit.json") as f:
        parts = json.load(f)["parts"]
    text = "".join(open(f"{path}/parts/{p}").read() for p in sorted(parts))
    doc = json.loads(text)
    assert list(doc) == ["x y", "b", 'q"', "Avg/total", "accuracy"]
    priors = {x["class"]: x["n_docs"] for x in r.model.priors.collect()}
    reports = {x["class"]: [x[c] for c in M.REPORT_FIELDS] for x in r.report().collect()}
    samples = pt.collect()
    for k, (c, _, _) in enumerate(r.header):
        assert doc[c]["sampleAmount"] == priors[c] and doc[c]["report"] == reports[c]
        assert doc[c]["wordFreqs"] == {x["word"]: x["cnt"] for x in r.model.likelihood.where(F.col("class") == c).collect()}
        mine = {x["doc_id"]: x for x in samples if x["class"] == c}
        assert doc[c]["testSamps"] == {d: x["words"] for d, x in mine.items()} and mine
        for d, x in mine.items():
            assert doc[c]["testSampsProbs"][d] == {n: [x["lps"][i], *[t[i] for t in x["pterms"]], x["totals"][i]] for i, (n, _, _) in enumerate(r.header)}
    a = r.accuracy().first()
    assert doc["accuracy"] == [a["correct"], a["total"]] and doc["Avg/total"] == reports[ev.AVG_TOTAL]
    entries, values = read_document(spark, path)
    back = {}
    for e in entries.collect():
        back.setdefault((e["class"], e["section"]), {})[e["key"]] = json.loads(e["json"])
    assert back == {(c, s): doc[c][s] for c in ("x y", "b", 'q"') for s in ("wordFreqs", "testSamps", "testSampsProbs")}
    assert {(v["class"], v["name"]): json.loads(v["json"]) for v in values.collect()} == {
        **{(c, n): doc[c][n] for c in ("x y", "b", 'q"') for n in ("sampleAmount", "report")},
        **{(None, n): doc[n] for n in ("Avg/total", "accuracy")},
    }


def test_an_uncommitted_document_is_not_read(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_document(spark, str(tmp_path))


def test_run_log_holds_each_run_once(spark, tmp_path):
    path = str(tmp_path / "log")
    one = spark.createDataFrame([(50.0, 0.5, 3, "d", 1.5)], "pick_pct double, mean_accuracy double, runs long, dataset string, seconds double")
    for run_id in ("a", "b", "a", "a"):
        M.append_run(one, path, run_id)
    assert sorted(x["run"] for x in M.read_runs(spark, path).collect()) == ["a", "b"]
    # an attempt that died before its commit, and one that committed beside another
    one.select("*", F.lit("c").alias("run"), F.lit("dead").alias("attempt")).write.mode("append").parquet(f"{path}/rows")
    one.select("*", F.lit("b").alias("run"), F.lit("~late").alias("attempt")).write.mode("append").parquet(f"{path}/rows")
    spark.createDataFrame([("b", "~late")], "run string, attempt string").write.mode("append").parquet(f"{path}/commits")
    assert sorted(x["run"] for x in M.read_runs(spark, path).collect()) == ["a", "b"]


def test_sample_lookup_reads_the_named_buckets(spark, run, tmp_path):
    r, pt = run
    path = str(tmp_path / "samples")
    M.save_samples(pt, path)
    some = r.test.select("class", "doc_id").limit(2).collect()
    found = M.find_samples(spark, path, [(x["class"], x["doc_id"]) for x in some] + [("b", "nobody")])
    assert sorted((x["class"], x["doc_id"]) for x in found.collect()) == sorted((x["class"], x["doc_id"]) for x in some)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert M.find_samples(spark, path, []).count() == 0


def test_plain_folders_and_hidden_names(spark, tmp_path):
    rows = [("a b.txt", "c+d", "one\ntwo"), ("50%", "c+d", ""), ("x", "é", None)]
    root = str(tmp_path / "root")
    write_plain_folders(spark.createDataFrame(rows, "doc_id string, class string, text string"), root)
    got = sorted(tuple(x) for x in folder_corpus(spark, root).select("doc_id", "class", "text").collect())
    assert got == sorted((n, c, t or "") for n, c, t in rows)
    (tmp_path / "root" / "é" / "_draft").write_text("lost?")
    with pytest.raises(ValueError, match="_draft"):
        folder_corpus(spark, root)


def test_two_places_as_the_report_shows_them(spark):
    draw = random.Random(6)
    xs = [a / b for b in range(1, 60) for a in range(b + 1)] + [k / 200 for k in range(201)] + [0.125, 0.375, 1e-18, 0.005, 0.015] + [draw.random() for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert all(x["r"] == round(x["x"], 2) for x in df.select("x", ev.round2(F.col("x")).alias("r")).collect())


def test_partition_folders_are_spark_s_own_and_no_driver_lists_the_files(spark, tmp_path):
    from textlens.sources.corpus import write_folder_corpus

    rows = [(n, c, t) for c in ("a=b", "50% é", None) for n, t in (("x/y [1]", "one\ntwo"), ("it's:{2}", None), ("+ ?", ""), (None, "three"))]
    df = spark.createDataFrame(rows + rows[:2], "doc_id string, class string, text string").coalesce(1)
    mine, theirs = str(tmp_path / "mine"), str(tmp_path / "theirs")
    write_folder_corpus(df, mine)
    df.select("class", "doc_id", "text").write.partitionBy("class", "doc_id").text(theirs)

    def folders(root):
        return sorted(str(p.relative_to(root)) for p in type(tmp_path)(root).rglob("doc_id=*"))

    assert folders(mine) == folders(theirs)
    got, same = folder_corpus(spark, mine, True), folder_corpus(spark, theirs, True)
    for back in (got, same):
        none = "__HIVE_DEFAULT_PARTITION__"
        want = {}
        for n, c, t in rows + rows[:2]:
            want[n or none, c or none] = want.get((n or none, c or none), "") + (t or "") + "\n"
        assert {(r["doc_id"], r["class"]): r["text"] for r in back.collect()} == want and back.count() == len(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "MapInArrow" in plan
    write_folder_corpus(df.limit(0), mine)  # over what was there
    assert folder_corpus(spark, mine, True).count() == 0
