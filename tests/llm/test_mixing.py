"""Mixing: targets against plain water filling, copies against the draw, and the edges."""
import hashlib
import math
import random

from barloom.llm import mixing
from barloom.llm.common import staged


def plain_targets(sizes, weights, budget=1.5, most=2.0):
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in capped]
        left = budget * total - sum(capped.values())
        out = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = [s for s in open_ if out[s] > most * sizes[s]]
        if not over:
            return capped | out
        capped |= {s: most * sizes[s] for s in over}


def run(spark, rows):
    docs = staged(spark.createDataFrame(rows, "doc_id long, source string, text string").select("doc_id", "source", mixing.word_count("text").alias("size")))
    targets = mixing.source_targets(mixing.cyclic_weights(mixing.source_sizes(docs)))
    return mixing.with_copies(docs, targets), targets


def draw(doc):
    return int(hashlib.md5(f"mix:{'null' if doc is None else doc}".encode()).hexdigest()[:13], 16) / 2**52


def test_targets_and_copies(spark):
    rng = random.Random(5)
    names = [None, "a", "Z", "é", "b", "tiny", "zz"]
    rows = [(i, names[min(6, int(rng.expovariate(0.6)))], " ".join(["w"] * rng.randint(0, 30))) for i in range(400)]
    out, targets = run(spark, rows)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    want = plain_targets(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    got = {r["source"]: r["target"] for r in targets.collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-12) for s in want)
    assert math.isclose(sum(got.values()), 1.5 * sum(sizes.values()))
    for r in out.collect():
        rate = want[r["source"]] / sizes[r["source"]]
        assert r["copies"] == math.floor(rate) + (draw(r["doc_id"]) < rate - math.floor(rate)) and r["copies"] <= 2


def test_a_source_with_most_words_comes_near_its_target(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 5}", "one two three four") for i in range(6000)]
    out, targets = run(spark, rows)
    taken = {r["source"]: r["t"] for r in out.groupBy("source").agg({"copies": "sum"}).withColumnRenamed("sum(copies)", "t").collect()}
    for r in targets.collect():
        assert abs(taken[r["source"]] * 4 - r["target"]) < 0.1 * r["target"]


def test_edges(spark):
    out, targets = run(spark, [])
    assert out.count() == 0 and targets.count() == 0
    out, targets = run(spark, [(1, None, None), (None, "a", ""), (2, "a", "\x0b \t")])
    assert {r["copies"] for r in out.collect()} == {0} and {r["target"] for r in targets.collect()} == {0.0}
    out, _ = run(spark, [(None, "a", "x y"), (None, "a", "x y"), (3, "b", "x")])
    assert len({r["copies"] for r in out.where("doc_id IS NULL").collect()}) == 1


def test_documents_are_emitted_with_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "s" + str(i % 2), "a b", i, -i, "t") for i in range(50)], "doc_id long, source string, text string, copies long, target long, source_size string")
    sizes = mixing.source_sizes(docs.withColumn("size", mixing.word_count(docs["text"])))
    targets = mixing.source_targets(mixing.cyclic_weights(sizes))
    got = mixing.mix(docs, targets)
    assert got.columns == docs.columns
    want = {r["doc_id"]: r["copies"] for r in mixing.with_copies(docs.select("doc_id", "source"), targets).collect()}
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in want.items() if v}
    assert all(r["copies"] == r["doc_id"] for r in got.collect())


def test_word_count_takes_only_ascii_blanks(spark):
    df = spark.createDataFrame([("a b\x1cc d e",), (" \r\n",), (None,)], "t string")
    assert [r[0] for r in df.select(mixing.word_count(df["t"])).collect()] == [2, 0, 0]
