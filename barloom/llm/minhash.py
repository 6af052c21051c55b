"""Near duplicates by word shingles: fast similarity sketches, banding, and exact checks of whole sets.

The sketch fills its t coordinates in rounds: in each round every shingle is hashed to one coordinate, and a coordinate
keeps the smallest value of the first round that reached it; from round t on, round t + i sends all shingles to
coordinate i, so every coordinate is filled. Large sets need about one round. Two sets agree in a coordinate with
probability J, and the number of agreements is concentrated like that of t independent ones.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import claim_memory, components, dropped, give_back, query, staged, table

#: Bands and rows of a band. At a similarity of 0.8 all bands of a pair differ with a probability of 5e-5.
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Members, and shingles of all its members, that one side of a comparing group has at most (one member always fits).
GROUP_DOCS, GROUP_SHINGLES = 256, 1_000_000
#: Words whose codes a worker remembers, about 200 bytes each; full, it starts anew.
REMEMBERED = 200_000
BATCH_BYTES = 4 << 20
FULL = np.uint64(2**64 - 1)

_WORDS: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(i: int) -> np.uint64:
    return np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles, A-Z lower-cased; fewer words: the whole sequence as one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    claim_memory("minhash", _WORDS.clear)
    if len(_WORDS) > REMEMBERED:
        _WORDS.clear()
    for w in set(words).difference(_WORDS):
        _WORDS[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    m = max(1, len(h) - k + 1)
    out = np.full(m, len(h) if len(h) < k else k, np.uint64)
    for j in range(min(k, len(h))):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[j:j + m]
    return np.unique(_mix(out))


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """A row of t coordinates for each set; an empty set keeps unfilled ones."""
    values, owner = np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cells = np.full(len(sets) * t, FULL)
    for i in range(2 * t):
        if not len(values):
            break
        h = _mix(values ^ _salt(i))
        to = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(cells, owner * t + to, np.uint64(i << 55) | (_mix(h) >> np.uint64(9)))
        open_ = (cells.reshape(-1, t) == FULL).any(1)[owner]
        values, owner = values[open_], owner[open_]
    return cells.reshape(-1, t)


def _rows_by_bytes(batches, column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with at most about BATCH_BYTES of text, with the texts."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            texts, size, upto = [], 0, at
            while upto < batch.num_rows and size < BATCH_BYTES:
                texts.append(batch[column][upto].as_py())
                size += len(texts[-1] or "")
                upto += 1
            yield batch.slice(at, upto - at), texts
            at = upto


def described(docs: DataFrame, k: int) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n (set size), h1 and h2 (128 bits of the whole set), bands (hashed, one a band)."""
    def run(batches):
        for batch, texts in _rows_by_bytes(batches, "text"):
            sets = [shingle_set(t, k) for t in texts]
            n = np.array([len(s) for s in sets])
            h1 = np.array([int(_mix(s ^ _salt(1001)).sum()) for s in sets], np.uint64).view(np.int64)
            h2 = np.array([int(_mix(s ^ _salt(1002)).sum()) for s in sets], np.uint64).view(np.int64)
            cells = sketches(sets).reshape(len(sets), BANDS, ROWS)
            bands = np.zeros((len(sets), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for j in range(ROWS):
                bands = _mix(bands * np.uint64(0xD6E8FEB86659FD93) + cells[:, :, j])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(h1), pa.array(h2),
                                              pa.array(list(bands.view(np.int64)), pa.list_(pa.int64()))], names=["doc_id", "n", "h1", "h2", "bands"])
        give_back()
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, h1 long, h2 long, bands array<long>")


def _group_links(rows: list[tuple], k: int, percent: int) -> list[tuple[int, int]]:
    """rows(side, id, component, text) of a comparing group -> links that join components not joined yet.

    Side 0 is compared with side 1, or with itself where there is no side 1, by the exact sizes of the whole sets.
    """
    sides: tuple[list, list] = ([], [])
    for side, node, component, text in rows:
        if len(s := shingle_set(text, k)):
            sides[side].append((node, component, s))
    left = sides[0]
    right = sides[1] or left
    if not left or not right:
        return []
    sizes = np.array([len(s) for _, _, s in right])
    values, owner = np.concatenate([s for _, _, s in right]), np.repeat(np.arange(len(right)), sizes)
    parent: dict = {}

    def root(c):
        while (p := parent.get(c, c)) != c:
            c = p
        return c
    links = []
    for node, component, own in left:
        at = np.minimum(np.searchsorted(own, values), len(own) - 1)
        common = np.bincount(owner[own[at] == values], minlength=len(right))
        for j in np.flatnonzero(100 * common >= percent * (len(own) + sizes - common)):
            other, c = right[j][0], right[j][1]
            a, b = root(component), root(c)
            if node != other and a != b:
                parent[max(a, b)] = min(a, b)
                links.append((node, other))
    return links


def _compared(groups: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """groups(g1, g2, side, id, component) -> links (u, v). Each group is bounded and is read as a run of sorted rows.

    Texts are merged at every size, so that a small table's plan tells what a large one needs.
    """
    placed = groups.join(texts.hint("merge"), "id").repartition("g1", "g2").sortWithinPartitions("g1", "g2", "side", "id")

    def run(batches):
        held, key, out = [], None, []
        for batch in batches:
            for i in range(batch.num_rows):
                now = (batch["g1"][i].as_py(), batch["g2"][i].as_py())
                if now != key:
                    out += _group_links(held, k, percent)
                    held, key = [], now
                held.append((batch["side"][i].as_py(), batch["id"][i].as_py(), batch["component"][i].as_py(), batch["text"][i].as_py()))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["u", "v"])
                out = []
        out += _group_links(held, k, percent)
        held = []
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["u", "v"])
    return placed.select("g1", "g2", "side", "id", "component", "text").mapInArrow(run, "u long, v long")


def _blocks(count, shingles):
    return F.greatest(F.ceil(count / GROUP_DOCS), F.ceil(shingles / GROUP_SHINGLES)).cast("int")


def _block_of(column, blocks, salt: str):
    return F.pmod(F.xxhash64(column, F.lit(salt)), blocks).cast("int")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs(doc_id, text) -> a row for each: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * intersection >= percent * union of their shingle sets. Equal sets are one class from
    the start. Classes that share a band are candidates: first all of a bucket are checked against its smallest; then,
    where a bucket still holds several components, all pairs of different components in it, in bounded groups. So no
    candidate pair is left out unless it is connected already, and neither pairs nor links of a group are listed.
    Null or wordless texts have n_shingles 0 and are linked with nothing. Rows that share a doc_id are one document: what
    is linked with one is linked with all. A null doc_id is linked with nothing, its component_id is null and it is kept.
    An empty table gives an empty one. Sets are compared by 64-bit hashes of shingles, classes by 128 bits and the size.
    """
    rows = staged(described(docs, k), "sets")
    usable = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = staged(usable.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")
    spread = classes.select("rep", "n", F.explode("bands").alias("band"))
    # Both sides of a join by band are staged tables: only such joins are split where a band is shared by very many.
    stars = staged(spread.groupBy("band").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last").select("band", "leader"), "stars")
    members = staged(spread.join(stars, "band").where("rep <> leader").select("band", "leader", "rep", "n"), "members")
    pairs = members.select("leader", "rep", "n").distinct()
    needed = members.select(F.col("rep").alias("id")).union(members.select("leader")).distinct()
    # Merged at every size, so that a small table's plan tells what a large one needs.
    texts = staged(docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(needed.hint("merge"), "id"), "texts")

    # every member against the bucket's smallest
    sizes = pairs.groupBy("leader").agg(_blocks(F.count("*"), F.sum("n")).alias("blocks"))
    dealt = staged(pairs.join(sizes, "leader").select("leader", "rep", "blocks"), "dealt")
    groups = dealt.select(F.col("leader").alias("g1"), _block_of("rep", F.col("blocks"), "star").cast("string").alias("g2"), F.lit(1).alias("side"), F.col("rep").alias("id"))
    heads = groups.select("g1", "g2").distinct().select("g1", "g2", F.lit(0).alias("side"), F.col("g1").alias("id"))
    first = staged(_compared(groups.union(heads).withColumn("component", F.col("id")), texts, k, percent), "links")
    shared = usable.join(classes.select("h1", "h2", "n", "rep"), ["h1", "h2", "n"]).select("doc_id", "rep") if _has_repeats(usable) else None
    if shared is not None:  # rows that share a doc_id
        ends = shared.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("__last")).where("u < __last").drop("__last")
        first = staged(first.union(shared.join(ends, "doc_id").select("u", F.col("rep").alias("v")).where("u <> v")), "links")
    labels = components(first)

    # different components that are left in a bucket
    known = labels.select(F.col("node").alias("rep"), "component")
    there = staged(members.join(known, "rep", "left").select("band", "rep", "n", F.coalesce("component", "rep").alias("component")), "there")
    by_part = there.groupBy("band", "component").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    open_ = staged(by_part.groupBy("band").agg(F.max(F.struct("c", "s", "component")).alias("main"), F.sum("c").alias("c"), F.sum("s").alias("s"), F.count("*").alias("parts")) \
        .where("parts > 1").select("band", F.col("main.component").alias("main"), _blocks(F.col("main.c"), F.col("main.s")).alias("mains"),
                                   _blocks(F.col("c") - F.col("main.c"), F.col("s") - F.col("main.s")).alias("rests")), "open")
    split = staged(there.join(open_, "band"), "split")
    main, rest = split.where("component = main"), split.where("component <> main")
    band = F.col("band").alias("g1")
    own = _block_of("rep", F.col("rests"), "rest")
    tail = (F.col("rep").alias("id"), F.col("component"))
    most = main.withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rests") - 1))).select(
        band, F.concat_ws(":", "r", F.lit("m"), _block_of("rep", F.col("mains"), "main")).alias("g2"), F.lit(1).alias("side"), *tail)
    against = rest.withColumn("m", F.explode(F.sequence(F.lit(0), F.col("mains") - 1))).select(
        band, F.concat_ws(":", own, F.lit("m"), "m").alias("g2"), F.lit(0).alias("side"), *tail)
    inner = rest.withColumn("own", own).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("rests") - 1))).select(
        band, F.concat_ws(":", F.least("own", "o"), F.lit("r"), F.greatest("own", "o")).alias("g2"), F.when(F.col("own") > F.col("o"), 1).otherwise(0).alias("side"), *tail)
    second = staged(_compared(most.union(against).union(inner), texts, k, percent), "links")
    if second.limit(1).count():
        labels = components(first.select("u", "v").union(second))
    joined = rows.select("doc_id", "n", "h1", "h2").join(classes.select("h1", "h2", "n", "rep"), ["h1", "h2", "n"], "left")
    named = staged(joined.select("doc_id", "n", "rep"), "named").join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    out = staged(named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id")), "near")
    dropped(rows, classes, stars, members, texts, dealt, first, there, open_, split, second)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _has_repeats(rows: DataFrame) -> bool:
    return rows.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component stays, with all its columns: the one with the smallest doc_id, null ids last.

    Rows are told apart by a number of their own, not by doc_id: documents of different texts that share an id both stay,
    and rows without an id are compared like all others. Of a component's rows that share the smallest id one stays.
    """
    whole = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("id"),
                               F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "rows")
    near = near_duplicates(whole.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), k, percent).select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    grouped = near.groupBy("component").count().where("count > 1").select("component")
    members = staged(near.join(grouped, "component").join(whole.select("row", "id"), "row"), "members")
    best = members.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "row")).alias("best")).select(F.col("best.row").alias("row"))
    gone = staged(members.select("row").join(best, "row", "left_anti"), "gone")
    out = staged(whole.join(gone, "row", "left_anti").select("doc.*"), "once")
    dropped(whole, members, gone)
    return out


@query("op4_minhash")
def op4_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=2)
