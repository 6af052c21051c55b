"""Near-duplicate embeddings: Euclidean p-stable hashing of normalised vectors, then exact cosine checks.

A table's key is a number of quantised random projections, floor((a . x + b) / width) with normal a. Unit vectors at a
cosine of 0.93 are 0.374 apart, where one projection agrees with probability AGREE; unrelated ones are 1.41 apart, where it
agrees with probability STRANGE. As many projections are taken as leave a vector STRAY strangers of its label in a table on
average, and as many tables as let a pair at exactly 0.93 share one of them with probability 1 - MISSED (closer pairs far
more surely). So the work for a vector grows with a small power of a label's size. Pairs that share a table's key are
compared exactly, whatever the bucket's size.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import components, dropped, query, staged, table

WIDTH, AGREE, STRANGE = 2.2, 0.864, 0.521
STRAY, MISSED = 1 / 30, 0.05
MOST_TABLES = 512
SEED = 20_240_601
#: Vectors of one side of a comparing group; larger buckets are dealt to pairs of blocks.
BLOCK = 512

_PLANES: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}


def shape(largest: int) -> tuple[int, int]:
    """(tables, projections of a key) for labels of up to so many different vectors."""
    rows = max(4, math.ceil(math.log(max(largest, 2) / STRAY) / -math.log(STRANGE)))
    tables = math.ceil(math.log(MISSED) / math.log1p(-AGREE**rows))
    while tables > MOST_TABLES:
        rows -= 1
        tables = math.ceil(math.log(MISSED) / math.log1p(-AGREE**rows))
    return tables, rows


def keys(unit: np.ndarray, tables: int, rows: int) -> np.ndarray:
    """32-bit keys, a column for each table, of unit vectors of one dimension."""
    d = unit.shape[1]
    if (d, tables, rows) not in _PLANES:
        rng = np.random.default_rng([SEED, d])
        _PLANES.clear()
        _PLANES[d, tables, rows] = rng.standard_normal((d, tables * rows)), rng.uniform(0, WIDTH, tables * rows)
    a, b = _PLANES[d, tables, rows]
    cells = np.floor((unit @ a + b) / WIDTH).astype(np.int64).reshape(len(unit), tables, rows).view(np.uint64)
    h = np.zeros((len(unit), tables), np.uint64)
    for j in range(rows):
        h = (h ^ cells[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _scaled(v: list | None) -> np.ndarray | None:
    """The vector times the power of two that brings its largest entry below 1; None where it cannot be compared."""
    if v is None or None in v or not len(v):
        return None
    x = np.asarray(v, np.float64)
    top = np.abs(x).max()
    return np.ldexp(x, -int(np.frexp(top)[1])) if np.isfinite(top) and top > 0 else None


def _packed(x: np.ndarray) -> bytes:
    """Bytes of single precision where that loses nothing, else of double."""
    narrow = x.astype(np.float32)
    return narrow.tobytes() if (narrow == x).all() else x.tobytes()


def _unpacked(raw: bytes, d: int) -> np.ndarray:
    return np.frombuffer(raw, "<f4" if len(raw) == 4 * d else "<f8").astype(np.float64)


#: Vectors hashed at once.
BATCH = 256


def _hashed(vectors: DataFrame, tables: int, rows: int) -> DataFrame:
    """vectors(rep, label, copies, embedding) -> the same with dimension, raw bytes and keys; unusable vectors go."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                values = [_scaled(v) for v in batch["embedding"].to_pylist()]
                for d in sorted({len(v) for v in values if v is not None}):
                    some = [i for i, v in enumerate(values) if v is not None and len(v) == d]
                    unit = np.array([values[i] / np.sqrt(values[i] @ values[i]) for i in some])
                    part = batch.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([part["rep"], part["label"], part["copies"], pa.array([d] * len(some), pa.int32()),
                                                      pa.array([_packed(values[i]) for i in some], pa.binary()),
                                                      pa.array(list(keys(unit, tables, rows)), pa.list_(pa.int32()))], names=["rep", "label", "copies", "dim", "raw", "keys"])
    return vectors.select("rep", F.col("label").cast("string").alias("label"), "copies", "embedding").mapInArrow(
        run, "rep long, label string, copies long, dim int, raw binary, keys array<int>")


def _group_links(rows: list[tuple], at: int, d: int, least: float):
    """rows(side, rep, copies, raw, keys) of a comparing group of table `at` and dimension d -> link counts by rep, and edges (root, rep).

    A pair is counted in the first table whose key it shares, so each link counts once. Edges join what is linked here.
    """
    left = [r for r in rows if r[0] == 0]
    right = [r for r in rows if r[0] == 1]
    within = not right
    right = right or left
    if not left or len(left) + len(right) < 2:
        return [], []
    x, y = (np.array([_unpacked(r[3], d) for r in side]) for side in (left, right))
    cosine = (x @ y.T) / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((y * y).sum(1))[None, :]
    linked = cosine >= least
    if within:
        np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    if not len(i):
        return [], []
    a, b = np.array([r[4] for r in left]), np.array([r[4] for r in right])
    first = ~(a[i, :at] == b[j, :at]).any(1)
    copies_a, copies_b = np.array([r[2] for r in left]), np.array([r[2] for r in right])
    counts = {}
    for side, k, other, weight in ((left, i, j, copies_b),) + (() if within else ((right, j, i, copies_a),)):
        got = np.bincount(k[first], weight[other[first]], len(side)).astype(np.int64)
        for n in np.flatnonzero(got):
            counts[side[n][1]] = counts.get(side[n][1], 0) + int(got[n])
    n, m = len(left), len(right)
    size = n if within else n + m
    shift = 0 if within else n
    label = np.arange(size)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j + shift])
        np.minimum.at(new, j + shift, label[i])
        new = new[new]
        if (new == label).all():
            break
        label = new
    names = [r[1] for r in left] + ([] if within else [r[1] for r in right])
    return list(counts.items()), [(names[label[k]], names[k]) for k in range(size) if label[k] != k]


def links(vectors: DataFrame, least: float) -> DataFrame:
    """vectors(cid, rep, label, copies, dim, raw, keys), cid being unique -> rows (u, v, c): an edge where v is given, else a count of links for u.

    Only (bucket, vector) pairs are shuffled to find the buckets of two or more; the vectors themselves go to these alone.
    """
    place = vectors.select("cid", "label", "dim", F.posexplode("keys").alias("t", "key"))
    place = place.select("cid", "t", "key", F.xxhash64("label", "dim", "t", "key").alias("g"))
    full = staged(place.groupBy("g").count().where("count > 1").select("g", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "buckets")
    members = staged(place.join(full, "g"), "members")
    dealt = members.join(vectors, "cid").withColumn("own", F.pmod(F.xxhash64("cid", F.lit("block")), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    by = ["g", "t", "label", "dim", "key", "low", "high"]
    placed = dealt.select("g", "t", "label", "dim", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                          F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "rep", "copies", "raw", "keys")
    placed = placed.repartition("g", "low", "high").sortWithinPartitions(*by, "side")

    def run(batches):
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("c", pa.int64())])
        held, now, out = [], None, []

        def close():
            counts, edges = _group_links(held, now[1], now[3], least) if now else ([], [])
            out.extend((u, None, c) for u, c in counts)
            out.extend((u, v, 0) for u, v in edges)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in (*by, "side", "rep", "copies", "raw", "keys")]
            for row in zip(*columns, strict=True):
                if row[:7] != now:
                    close()
                    held, now = [], row[:7]
                held.append(row[7:])
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=schema)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=schema)
    return placed.select(*by, "side", "rep", "copies", "raw", "keys").mapInArrow(run, "u long, v long, c long")


def near_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vectors(vec_id, embedding, label) -> a row for each: vec_id, n_links, component_id, kept.

    Vectors are linked where labels are equal and not null, dimensions are equal and the cosine (in doubles) is `least` or
    more. Equal vectors of a label are one class from the start, counted by its size. Null, empty or zero vectors, vectors
    with null or non-finite components, and rows without an id are linked with nothing (without an id: component_id null,
    kept). Rows that share an id are one vertex in components and count as vectors each. An empty table gives an empty one.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.lit(7), "embedding"))
    usable = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    classes = usable.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    classes = staged(classes, "vectors")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    hashed = staged(_hashed(classes, *shape(largest)).withColumn("cid", F.monotonically_increasing_id()), "hashed")
    found = staged(links(hashed, least), "links")
    counts = found.where("v IS NULL").groupBy(F.col("u").alias("rep")).agg(F.sum("c").alias("others"))
    usable_reps = hashed.select("rep").distinct().withColumn("ok", F.lit(True))
    known = staged(classes.select("label", "h1", "h2", "rep", "copies").join(usable_reps, "rep").join(counts, "rep", "left")
                   .select("label", "h1", "h2", "rep", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n")), "classes")
    named = rows.select("vec_id", "label", "h1", "h2").join(known, ["label", "h1", "h2"], "left")
    edges = found.where("v IS NOT NULL").select("u", "v")
    named = staged(named, "named")
    repeats = named.where("rep IS NOT NULL").groupBy("vec_id").agg(F.min("rep").alias("u"), F.max("rep").alias("__last")).where("u < __last").select("vec_id", "u")
    edges = edges.union(named.join(repeats, "vec_id").where("rep <> u").select("u", F.col("rep").alias("v")))
    labels = components(edges)
    out = named.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "rep", "vec_id"))
    out = staged(out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")), "near")
    dropped(classes, hashed, found, known, named)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


@query("op3_embedding")
def op3_embedding(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
