"""Exact duplicates against a plain grouping."""
import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from barloom.llm import exact

DDL = "doc_id long, text string"


def plain(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in sorted(ids, key=lambda i: (i is not None, i)):
            stays = i == top and not kept
            kept = kept or stays
            out.append((i, top, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def compare(spark, rows, parts=5, **settings):
    got = exact.exact_duplicates(spark.createDataFrame(rows, DDL).repartition(parts), **settings).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


ROWS = [(i, "the same" if i % 3 == 0 else f"text {i % 41}") for i in range(600)] + [(1000, None), (1001, ""), (1002, " "), (1003, "Á" * 200_000), (1004, "Á" * 200_000)]


def test_groups_of_copies(spark):
    compare(spark, ROWS)


def test_heavy_digests_are_salted(spark):
    compare(spark, ROWS, parts=16, heavy_copies=10, salts=4)


def test_texts_that_share_a_digest_are_told_apart(spark):
    compare(spark, ROWS, digest=lambda text: F.length(text))
    compare(spark, ROWS, parts=16, digest=lambda text: F.length(text), heavy_copies=10, salts=3)


def test_repeated_and_null_ids(spark):
    compare(spark, [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "c"), (None, "c"), (2, "d"), (2, "d"), (2, "d"), (None, None)])


def test_empty_table(spark):
    compare(spark, [])


def test_normalised_texts(spark):
    rows = [(1, "Ab"), (2, "aB"), (3, "b")]
    got = exact.exact_duplicates(spark.createDataFrame(rows, DDL), normalised=F.lower).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == {(1, 2, 2), (2, 2, 2), (3, 3, 1)}


def test_other_columns_stay_as_they_are(spark):
    rows = [(1, "a", 7, "x", None), (2, "a", 8, "y", 1.5), (3, None, 9, "z", None)]
    df = spark.createDataFrame(rows, DDL + ", keep long, digest string, row double")
    got = exact.without_exact_duplicates(df)
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == rows[1:]
    assert exact.without_exact_duplicates(df, copies=1, salts=2).count() == 2
