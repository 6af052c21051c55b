"""The pipeline: each stage on its own input against a plain version, and tables of the odd kind."""
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from barloom.llm import packing
from barloom.llm.common import ORACLES, QUERIES
from tests.llm import test_minhash, test_mixing, test_packing, test_pii
from tools.check import TABLES, canonical

SMALL = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_one_after_another(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = [tuple(r) for r in docs.collect()]
        out = str(tmp_path / name.replace(" ", "-"))
        stage(spark, docs, SMALL).write.parquet(out)
        docs = spark.read.parquet(out)
        assert name == "packing" or docs.columns == columns
    start, kept, once, clean, mixed = (seen[n] for n, _ in corpus_pipeline.STAGES)
    ids = {r[0] for r in kept}
    assert ids < {r[0] for r in start} and {r for r in kept} <= {r for r in start}
    assert sum((labels[i][0] == 1) == (i in ids) for i in labels if not labels[i][1]) > 0.9 * sum(not labels[i][1] for i in labels)
    want = test_minhash.plain([(r[0], r[1]) for r in kept], 5)
    assert sorted(r[0] for r in once) == sorted(w[0] for w in want if w[3])
    texts = {r[0]: r for r in clean}
    for i, text, lang, source, _ in once:
        for start_, _, end, kind in reversed(test_pii.plain(text)):
            text = text[:start_] + f"<{kind.upper()}>" + text[end:]
        if len(re.findall("<[A-Z]+>", texts[i][1])) == len(re.findall("<[A-Z]+>", text)):
            assert texts[i] == (i, text, lang, source, len(text))
    sizes = {}
    for r in clean:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    order = sorted(sizes)
    target = test_mixing.plain_targets(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)})
    for r in clean:
        rate = target[r[3]] / sizes[r[3]]
        assert mixed.count(r) == int(rate) + (test_mixing.draw(r[0]) < rate - int(rate))
    total = sum(len(test_packing.ids(r[1])) + 1 for r in mixed)
    assert docs.agg(F.sum("length")).first()[0] == total
    assert corpus_pipeline.run(spark, SMALL).agg(F.sum("length")).first()[0] == total


def test_odd_tables(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    odd = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some words here", None, "a", 15), (4, "long " * 40_000, "en", None, 5), (4, "long " * 40_000, "en", None, 5)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, DDL)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            docs.count()


def test_the_stages_keep_extra_columns(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([(1, "a b c d e f a@b.co", "en", "s", 18, 7, "r", "q")], DDL + ", copies long, rep string, quality string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.columns[5:] == ["copies", "rep", "quality"] and {r["copies"] for r in docs.collect()} <= {7}


def test_every_query_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and {"pipeline", *QUERIES} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = entry.queries()[name](spark, SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cur.fetchall(), names)


def test_the_tokenizer_is_the_given_one():
    assert packing.tokenizer_path().endswith("word_bpe_49k.json")
