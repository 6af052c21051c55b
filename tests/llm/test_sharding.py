"""Shards: near-equal bytes, gapless slots, hot keys, and odd tables."""
import zlib

from pyspark.sql import functions as F

from barloom.llm import sharding

DDL = "id long, size long, k long"


def check(df, shards, most_row):
    rows = df.collect()
    total, by = sum(max(1, r["size"] or 1) for r in rows), {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for s, own in by.items():
        assert 0 <= s < shards
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(max(1, r["size"] or 1) for r in own) - total / shards) <= most_row
    return rows


def run(spark, rows, shards=8, **options):
    df = spark.createDataFrame(rows, DDL).repartition(4)
    return sharding.shard(df, F.col("size"), F.col("k"), F.xxhash64("id"), shards=shards, **options)


def test_sizes_are_near_equal_and_order_is_kept(spark):
    rows = [(i, 1 + i * i % 97, i * 2654435761 % 2**32) for i in range(3000)]
    got = check(run(spark, rows), 8, 98)
    got.sort(key=lambda r: (r["shard"], r["slot"]))
    assert len(got) == 3000 and len({r["id"] for r in got}) == 3000


def test_a_key_with_a_third_of_all_rows_is_cut(spark):
    rows = [(i, 10, 7 if i % 3 == 0 else i) for i in range(6000)]
    got = check(run(spark, rows), 8, 10)
    assert len({r["shard"] for r in got if r["k"] == 7}) >= 3


def test_ranges_stay_small_by_the_byte_limit(spark):
    check(run(spark, [(i, 5, i % 11) for i in range(2000)], shards=4, range_bytes=50), 4, 5)


def test_odd_tables(spark):
    assert run(spark, []).count() == 0
    check(run(spark, [(1, 5, 1)]), 8, 8)
    got = check(run(spark, [(None, None, None), (None, 3, 2), (4, 1, None), (4, 1, None)], shards=2), 2, 4)
    assert len(got) == 4
    huge = check(run(spark, [(1, 1_000_000, 1), *[(i, 1, i) for i in range(2, 400)]], shards=4), 4, 1_000_000)
    assert len(huge) == 399


def test_columns_named_alike_are_replaced(spark):
    df = spark.createDataFrame([(i, 2, i, "old", "x") for i in range(40)], DDL + ", slot string, other string")
    out = sharding.shard(df, F.col("size"), F.col("k"), F.col("id"), shards=2)
    assert out.columns == ["id", "size", "k", "other", "shard", "slot"] and out.select("slot").distinct().count() == 20


def test_the_query_over_whole_documents(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = sharding.op6_sharding(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    assert all(r["size"] == len(docs[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(docs[r["doc_id"]].encode()) and r["law"] == "bytes" for r in got)


def test_shards_are_written_in_slot_order(spark, tmp_path):
    df = run(spark, [(i, 3, i) for i in range(200)], shards=4)
    sharding.write_shards(df, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 4
