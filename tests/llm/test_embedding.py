"""Near-duplicate embeddings against all pairs."""
import numpy as np

from barloom.llm import embedding

DDL = "vec_id long, embedding array<float>, label int"


def plain(rows, least=0.93):
    parent = {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    good = []
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.asarray(v, np.float32).astype(float)
            good.append((k, i, x, label))
    links = [0] * len(rows)
    for a in range(len(good)):
        for b in range(a):
            (k, i, x, l), (m, j, y, n) = good[a], good[b]
            if l == n and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                links[k] += 1
                links[m] += 1
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return sorted((i, n, root(i), i == root(i)) for (i, _, _), n in zip(rows, links))


def compare(spark, rows):
    got = embedding.near_duplicates(spark.createDataFrame(rows, DDL).repartition(3))
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_groups_of_copies_and_near_copies(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 16)  # so that groups are dealt to several blocks
    rng = np.random.default_rng(3)
    rows = []
    for g, (size, noise) in enumerate([(60, 0.02), (40, 0.03), (25, 0.0), (3, 0.05)]):
        centre = rng.standard_normal(32)
        rows += [(0, (centre + noise * rng.standard_normal(32)).astype(np.float32).tolist(), g % 2) for _ in range(size)]
    rows += [(0, rng.standard_normal(32).astype(np.float32).tolist(), int(rng.integers(0, 3))) for _ in range(120)]
    order = rng.permutation(len(rows))
    compare(spark, [(int(order[i]) * 7, v, l) for i, (_, v, l) in enumerate(rows)])


def test_unusable_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [0.0, 0.0, 0.0], 1),
            (9, [1.0, None, 3.0], 1), (10, [1.0, float("nan"), 3.0], 1), (11, [1.0, float("inf"), 3.0], 1), (12, [2.0, 4.0, 6.0], 1), (13, [1.0, 2.0], 1)]
    compare(spark, rows)


def test_empty_table_and_rows_without_an_id(spark):
    assert embedding.near_duplicates(spark.createDataFrame([], DDL)).count() == 0
    got = embedding.near_duplicates(spark.createDataFrame([(None, [1.0], 1), (None, [1.0], 1), (1, [1.0], 1)], DDL)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 0, None, True), (None, 0, None, True), (1, 0, 1, True)], key=str)


def test_rows_that_repeat_an_id(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (6, [1.0, 0.01], 1), (7, [0.01, 1.0], 1)]
    got = {(r["vec_id"], r["component_id"]) for r in embedding.near_duplicates(spark.createDataFrame(rows, DDL)).collect()}
    assert got == {(5, 5), (6, 5), (7, 5)}


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, [1.0], 1, 2, "x"), (2, [1.0], 1, 3, "y")], DDL + ", rep long, keys string")
    assert sorted(r["n_links"] for r in embedding.near_duplicates(df).collect()) == [1, 1]


def test_doubles_of_any_finite_size(spark):
    v = [1.0, 2.0, -3.0]
    rows = [(i, [x * f for x in v], 1) for i, f in enumerate([1.0, 1e200, 1e-200, 1e300, 1e-310, -1e200])] + [(9, [1e-320, 0.0, 0.0], 1), (10, [5e-324, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding.near_duplicates(df).collect()}
    assert got == {**{i: (4, 0) for i in range(5)}, 5: (0, 5), 9: (1, 9), 10: (1, 9)}


def test_recall_on_pairs_of_all_degrees(spark):
    """Pairs at cosines from 0.93 on, planted in a label of strangers; at 0.93 itself at least 0.95 is aimed at, in all far more."""
    rng = np.random.default_rng(11)
    rows = [(10_000 + i, rng.standard_normal(64).tolist(), 1) for i in range(3000)]
    for i in range(600):
        a, b = rng.standard_normal((2, 64))
        a, cosine = a / np.linalg.norm(a), 0.931 + 0.069 * i / 600
        b = b - (b @ a) * a
        b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (7 * b).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embedding.near_duplicates(df).collect()}
    found = [got[2 * i] == 1 and got[2 * i + 1] == 1 for i in range(600)]
    assert np.mean(found[:100]) >= 0.9 and np.mean(found) >= 0.97 and not any(n for i, n in got.items() if i >= 10_000)


def test_shapes_grow_slowly_with_the_label():
    shapes = [embedding.shape(n) for n in (0, 1, 200, 5000, 10**6, 10**9)]
    assert all(tables <= embedding.MOST_TABLES for tables, _ in shapes) and shapes == sorted(shapes)
    for tables, rows in shapes:
        assert 1 - (1 - embedding.AGREE**rows) ** tables >= 0.95
