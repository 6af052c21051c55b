"""Quality: held-out accuracy, shrinkage of sparse sites, and odd rows."""
import random

import numpy as np
from pyspark.sql import functions as F

from barloom.llm import quality

DDL = "doc_id long, text string, source string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def run(spark, rows, labels, host="source", path="lang"):
    return quality.classify(spark.createDataFrame(rows, DDL), spark.createDataFrame(labels, LABELS), F.col(host), F.col(path))


def corpus(rng, n, bad_share=lambda site: 0.2):
    rows, truth = [], {}
    for i in range(n):
        site = f"s{int(rng.paretovariate(1)) % 30}"
        words = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(15, 200))]
        bad, toxic = rng.random() < bad_share(site), rng.random() < 0.15
        if bad:
            words = [w.upper() + "!!" for w in words] if rng.random() < 0.5 else [w for w in words for _ in range(6)]
        if toxic:
            for w in rng.sample(["grum", "frizz", "glob", "snark"], 2):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), site, "xy"[i % 2]))
        truth[i] = (int(not bad), int(toxic))
    return rows, truth


def test_held_out_documents(spark):
    rng = random.Random(8)
    rows, truth = corpus(rng, 1500)
    out = run(spark, rows, [(i, *truth[i]) for i in range(0, 1500, 2)]).collect()
    held = [r for r in out if r["doc_id"] % 2]
    clean = [r for r in held if truth[r["doc_id"]] == (1, 0)]
    assert len(out) == 1500 and np.mean([r["__kept"] for r in clean]) > 0.99
    assert np.mean([not r["__kept"] for r in held if truth[r["doc_id"]] != (1, 0)]) > 0.95


def test_held_out_documents_of_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source", "lang")
    some = [tuple(labels[i]) for i in labels if i % 3]
    got = quality.classify(docs, spark.createDataFrame(some, LABELS), F.col("source"), F.col("lang")).collect()
    held = [(r["__quality"] >= 0.5, labels[r["doc_id"]]) for r in got if r["doc_id"] in labels and r["doc_id"] % 3 == 0]
    assert np.mean([a == bool(l["quality"]) for a, l in held]) > 0.95


def test_sparse_sites_are_drawn_to_the_level_above(spark):
    ev = [("big", "p", 8.0)] * 400 + [("worse", "p", -8.0)] * 300 + [("worse", "p", 8.0)] * 100 + [("tiny", "p", -8.0)] + [("worse", "q", -8.0)] * 2
    df = spark.createDataFrame(ev, "host string, path string, quality double")
    sites, strength, inner = quality.site_posteriors(df, "quality", 0.5)
    got = {(r["host"], r["path"]): r for r in sites.collect()}
    assert strength >= 1 and inner >= 1
    tiny, worse, big = got["tiny", "p"]["host_mean"], got["worse", "p"]["host_mean"], got["big", "p"]["host_mean"]
    assert 0.0 < tiny < 0.5 and abs(worse - 0.25) < 0.02 and big > 0.97
    assert got["worse", "q"]["host_mean"] == worse


def test_a_bad_site_tips_documents_without_evidence(spark):
    rng = random.Random(9)
    rows, truth = corpus(rng, 900, lambda site: 0.95 if site == "s1" else 0.02)
    rows += [(5000, "", "s1", "x"), (5001, None, "s2", "x"), (5002, " \n", "s1", "y")]
    got = {r["doc_id"]: r for r in run(spark, rows, [(i, *truth[i]) for i in range(900)]).collect()}
    assert got[5000]["__evidence"]["quality"] == 0 and not got[5000]["__kept"] and not got[5002]["__kept"] and got[5001]["__kept"]


def test_odd_rows(spark):
    labels = [(1, 1, 0), (2, 0, 0), (2, 0, 0), (None, 1, 1), (3, None, None), (4, 1, None), (5, None, 1)]
    rows = [(i, t, s, l) for i, t, s, l in [(1, "a b", "s", None), (2, "X!! Y!!", None, "x"), (2, "X!! Y!!", None, "x"), (None, "c d", None, None), (4, "w " * 100_000, "s", "x"), (5, "", "s", "x")]]
    got = run(spark, rows, labels).collect()
    assert len(got) == len(rows) and all(r["__kept"] is not None for r in got)
    assert run(spark, [], labels).count() == 0
    assert all(r["__kept"] for r in run(spark, rows, []).collect())


def test_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", "s", "x", 5, "q", 1.0)], DDL + ", quality int, host string, n double")
    out = quality.classify(df, spark.createDataFrame([(1, 1, 0)], LABELS), F.col("source"), F.col("lang"))
    assert out.select(*df.columns).first() == df.first()
