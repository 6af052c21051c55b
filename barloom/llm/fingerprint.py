"""Context-triggered piecewise fingerprints, and texts compared by them.

A rolling hash of the last WINDOW bytes cuts a text wherever its value meets the block size; each piece gives one base-64
letter. An edit changes only the letters near it. The block size is 3 * 2^k, chosen by length, and a fingerprint holds
the letters for it and for its double, so that texts whose sizes differ up to twofold can be compared.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import query, table

WINDOW = 7
#: Expected letters of a fingerprint: more than half of LETTERS and at most so many. The block size follows from the
#: length alone, so texts of up to twice the length can always be compared; texts that repeat themselves get few letters.
LETTERS = 64
LEAST_BLOCK = 3
#: Letters that two fingerprints must have in a row to be alike at all (fewer for short ones).
COMMON = 7
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)

_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^n as 64-bit numbers; kept and grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        size = 1 << max(12, n.bit_length())
        have = np.full(size + 1, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 24:
            _POWERS[base] = have
    return have[:n + 1]


def _letters(sums: np.ndarray, marks: np.ndarray, n: int, inverse: np.ndarray) -> str:
    """A letter for each piece: pieces end after the marks, and at the end of the text."""
    ends = marks + 1
    if not len(ends) or ends[-1] != n:
        ends = np.append(ends, n)
    starts = np.concatenate([[0], ends[:-1]])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ALPHABET[(h >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str) -> str:
    """block size : letters : letters at twice the block size. The empty text: 3::"""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(raw)
    if not n:
        return f"{LEAST_BLOCK}::"
    rolled = np.zeros(n, np.uint32)
    for j in range(min(WINDOW, n)):
        rolled[j:] += (raw[:n - j].astype(np.uint32) + np.uint32(1)) * np.uint32(pow(0x01000193, j + 1, 2**32))
    rolled = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    rolled ^= rolled >> np.uint32(13)
    powers, inverse = _powers(BASE, n), _powers(INVERSE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    block = LEAST_BLOCK
    while block * LETTERS < n:
        block *= 2
    marks = np.flatnonzero(rolled % np.uint32(block) == np.uint32(block - 1))
    wide = marks[rolled[marks] % np.uint32(2 * block) == np.uint32(2 * block - 1)]
    return f"{block}:{_letters(sums, marks, n, inverse)}:{_letters(sums, wide, n, inverse)}"


def _short_runs(s: str) -> str:
    """Runs of one letter cut to three: repetition says little."""
    return "".join(c for i, c in enumerate(s) if i < 3 or not s[i - 3] == s[i - 2] == s[i - 1] == c)


def _alike(a: str, b: str) -> float:
    """1 - edit distance / both lengths (a replaced letter is one taken out and one put in); 0 without a common run."""
    a, b = _short_runs(a), _short_runs(b)
    if not a or not b:
        return 0.0
    run = min(COMMON, max(1, min(len(a), len(b)) // 3))
    if {a[i:i + run] for i in range(len(a) - run + 1)}.isdisjoint(b[i:i + run] for i in range(len(b) - run + 1)):
        return 0.0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    row = every
    for c in b:  # longest common subsequence, all of a at once: a zero bit is a step taken
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & every
    common = len(a) - row.bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1. Equal fingerprints: 1. Otherwise letters of the same block size are compared, the better of two counts."""
    if a == b:
        return 1.0
    (size_a, a1, a2), (size_b, b1, b2) = a.split(":"), b.split(":")
    size_a, size_b = int(size_a), int(size_b)
    if size_a == size_b:
        return max(_alike(a1, b1), _alike(a2, b2))
    if size_a == 2 * size_b:
        return _alike(a1, b2)
    if size_b == 2 * size_a:
        return _alike(a2, b1)
    return 0.0


RESULT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """docs(doc_id, text) dealt to ranges of doc_id: (range, last, doc_id, text), sorted, each range ending with a copy
    (last = 1) of the first row of the range after it, and the final one with the first row of all.

    Ids are long; nulls come before all others and rows with one id in the order of their texts. Boundaries are quantiles
    (`ranges` - 1 numbers); the smallest id of each range comes from one pass over the ids. The texts are shuffled once.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = -(2**63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select(F.coalesce("doc_id", F.lit(low)).alias("id"))
    cuts = ids.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)] or [0.5], 100 * ranges).alias("c")).first()["c"] or []
    cuts = np.unique(np.array(cuts, np.int64))

    def smallest(batches):
        for batch in batches:
            got = batch["id"].to_numpy()
            to = np.searchsorted(cuts, got, "right")
            order = np.lexsort((got, to))
            keep = order[np.concatenate([[True], np.diff(to[order]) > 0])] if len(got) else order
            yield pa.RecordBatch.from_arrays([pa.array(to[keep], pa.int32()), pa.array(got[keep], pa.int64())], names=["range", "id"])
    firsts = {r["range"]: r["id"] for r in ids.mapInArrow(smallest, "range int, id long").groupBy("range").agg(F.min("id").alias("id")).collect()}  # a row a range
    order = sorted(firsts)
    before = {firsts[r]: order[k - 1] for k, r in enumerate(order)}  # where the first row of a range is also needed

    def deal(batches):
        for batch in batches:
            got = np.array([low if x is None else x for x in batch["doc_id"].to_pylist()], np.int64)
            to = np.searchsorted(cuts, got, "right")
            again = np.array([i for i, x in enumerate(got.tolist()) if x in before], np.int64)
            take = pa.array(np.concatenate([np.arange(len(got)), again]).astype(np.int64))
            where = np.concatenate([to, [before[int(got[i])] for i in again]]).astype(np.int32)
            last = np.concatenate([np.zeros(len(got)), np.ones(len(again))]).astype(np.int32)
            part = batch.take(take)
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(last), part["doc_id"], part["text"]], names=["range", "last", "doc_id", "text"])
    dealt = rows.mapInArrow(deal, "range int, last int, doc_id long, text string")
    return dealt.repartition(ranges, "range").sortWithinPartitions("range", "last", F.col("doc_id").asc_nulls_first(), "text")


def compared(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """A row for each of docs(doc_id, text): its fingerprint, that of its edited text, and how alike they and the next's are.

    Null texts count as empty. The next document is the next row by doc_id (nulls first), then text; after the last comes
    the first, so a single row is its own next. An empty table gives an empty one.
    """
    def run(batches):
        held, now, out = None, None, []
        for batch in batches:
            for i in range(batch.num_rows):
                where, last, doc, text = (batch[c][i].as_py() for c in ("range", "last", "doc_id", "text"))
                mark = fingerprint(text)
                if held is not None and where == now:
                    out.append(_row(*held, text, mark))
                held, now = (None if last else (doc, text, mark)), where
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=RESULT)
                out = []
    return with_next(docs, ranges).mapInArrow(run, RESULT_DDL)


def _row(doc, text: str, mark: str, following: str, next_mark: str) -> dict:
    half = len(text) // 2
    edited = text[:len(text) - half] + following[:half]
    edited_mark = fingerprint(edited)
    return {"doc_id": doc, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), "fingerprint": mark,
            "edited_fingerprint": edited_mark, "near_edited": likeness(mark, edited_mark), "near_next": likeness(mark, next_mark)}


@query("op5_fingerprint")
def op5_fingerprint(spark, sf_dir):
    return compared(table(spark, sf_dir, "documents"))
