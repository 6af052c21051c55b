"""Near duplicates against all pairs of plain shingle sets; the sketch's properties."""
import random

import numpy as np
import pytest

from barloom.llm import minhash

DDL = "doc_id long, text string"


def shingles(text, k):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ")
             .replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}


def plain(rows, k, percent=80):
    sets, parent = [shingles(t, k) for _, t in rows], {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                p, q = root(rows[a][0]), root(rows[b][0])
                parent[max(p, q)] = min(p, q)
    return sorted((i, len(s), root(i), i == root(i)) for (i, _), s in zip(rows, sets))


def edited(rng, words, share):
    return " ".join(rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words)


@pytest.mark.parametrize("k", [2, 5])
def test_groups_of_near_copies(spark, monkeypatch, k):
    monkeypatch.setattr(minhash, "GROUP_DOCS", 8)  # so that groups are dealt to several blocks
    rng = random.Random(k)
    rows = []
    for size, share in ((70, 0.03), (40, 0.06), (30, 0.0), (5, 0.02)):
        words = [f"w{rng.randint(0, 400)}" for _ in range(150)]
        rows += [edited(rng, words, share * rng.random() * 2) for _ in range(size)]
    rows += [" ".join(f"w{rng.randint(0, 60)}" for _ in range(rng.randint(0, 40))) for _ in range(80)]
    rng.shuffle(rows)
    rows = [(i * 3 + 1, t) for i, t in enumerate(rows)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, DDL).repartition(3), k=k)
    assert sorted(map(tuple, got.collect())) == plain(rows, k)


def test_whole_table_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(tuple, minhash.near_duplicates(docs, k=2).collect())) == plain(rows, 2)


def test_a_chain_is_one_component(spark):
    words = [f"t{i}" for i in range(200)]
    rows = [(i, " ".join(words[3 * i:3 * i + 100])) for i in range(30)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, DDL), k=1)
    assert sorted(map(tuple, got.collect())) == plain(rows, 1)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE "), (6, "É"), (7, "é"), (8, "x " * 50_000), (9, "X " * 49_000)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, DDL), k=2)
    assert sorted(map(tuple, got.collect())) == plain(rows, 2)
    assert minhash.near_duplicates(spark.createDataFrame([], DDL)).count() == 0


def test_rows_without_or_with_the_same_id(spark):
    rows = [(None, "a b c"), (None, "a b c"), (5, "a b c"), (5, "q r s"), (9, "q r s"), (7, "a b c")]
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(spark.createDataFrame(rows, DDL), k=2).collect()}
    assert got == {(None, None, True), (5, 5, True), (9, 5, False), (7, 5, False)}


def test_one_stays_with_its_columns(spark):
    df = spark.createDataFrame([(1, "a b c", 10, "x"), (1, "a b c", 10, "x"), (2, "a b c", 20, "y"), (3, "d e f", 30, "z"), (None, "a b c", 40, "w")],
                               DDL + ", n long, component_id string")
    got = sorted(map(tuple, minhash.without_near_duplicates(df, k=2).collect()), key=str)
    assert got == sorted([(1, "a b c", 10, "x"), (3, "d e f", 30, "z")], key=str)


def test_no_text_is_lost_to_a_shared_or_missing_id(spark):
    rows = [(1, "a b c"), (1, "d e f"), (None, "g h i"), (None, "g h i"), (None, "j k l"), (2, "d e f"), (3, None), (3, ""), (None, " ")]
    got = sorted(map(tuple, minhash.without_near_duplicates(spark.createDataFrame(rows, DDL), k=2).collect()), key=str)
    assert got == sorted([(1, "a b c"), (1, "d e f"), (None, "g h i"), (None, "j k l"), (3, None), (3, ""), (None, " ")], key=str)


def test_a_column_with_an_inner_name(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "p"), (2, "a b c", 6, "q")], DDL + ", __id long, row string")
    assert [tuple(r) for r in minhash.without_near_duplicates(df, k=2).collect()] == [(1, "a b c", 5, "p")]


def test_the_sketch_fills_and_agrees_like_the_similarity():
    rng = np.random.default_rng(1)
    for n, shared in ((1, 1), (3, 2), (60, 45), (3000, 2500)):
        agree = []
        for _ in range(30):
            both = rng.integers(0, 2**63, shared, dtype=np.uint64)
            a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, n - shared, dtype=np.uint64)])) for _ in range(2))
            x, y = minhash.sketches([a, b])
            assert (x != minhash.FULL).all() and (y != minhash.FULL).all()
            agree.append((x == y).mean())
        assert abs(np.mean(agree) - shared / (2 * n - shared)) < 0.06
    assert (minhash.sketches([np.zeros(0, np.uint64)]) == minhash.FULL).all()


def test_texts_are_staged_once_and_merged(spark, monkeypatch):
    """The rows that wait for their verdict hold each text once; texts meet their groups by a merge on small tables too."""
    staged, seen = minhash.staged, []
    monkeypatch.setattr(minhash, "staged", lambda df, name="step": seen.append((name, df.columns)) or staged(df, name))
    docs = spark.createDataFrame([(1, "a b c d e f", 5), (2, "a b c d e f", 6), (3, "g", 7), (4, None, 8)], "doc_id long, text string, size int")
    assert sorted(map(tuple, minhash.without_near_duplicates(docs).collect())) == [(1, "a b c d e f", 5), (3, "g", 7), (4, None, 8)]
    assert dict(seen)["rows"] == ["row", "id", "doc"]
    groups = spark.createDataFrame([(1, "0", 0, 1, 1), (1, "0", 1, 2, 2)], "g1 long, g2 string, side int, id long, component long")
    compared = minhash._compared(groups, docs.select(docs.doc_id.alias("id"), "text"), 2, 80)
    assert "SortMergeJoin" in compared._jdf.queryExecution().toString()
