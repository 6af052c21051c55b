"""Block bootstrap of a difference of means, on per-block sums.

Spark reduces the rows to sums per 20-date block (a few dozen per series); the draws need
the exact sequence of Python's generator, so they run in an Arrow UDF over those sums.
"""
from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, udtf

from barloom.contracts import BOOTSTRAP_BLOCK, BOOTSTRAP_DRAWS

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def draw_blocks(seed_key: str, hex_digits: int, blocks: int) -> np.ndarray:
    """Block numbers of every draw: one row per draw, as many blocks as the series has.

    The numbers are those of `random.Random(seed).randrange(blocks)`, taken in bulk: both
    run the same generator, seeded by the 32-bit words of the seed, and a draw keeps the
    top bits of a word and rejects numbers that are too large.
    """
    seed = int(hashlib.sha256(seed_key.encode()).hexdigest()[:hex_digits], 16)
    words = [seed & 0xFFFFFFFF] + ([seed >> 32] if seed >> 32 else [])
    generator = np.random.RandomState(words)  # a list of words seeds word by word
    bits, wanted, picks = blocks.bit_length(), BOOTSTRAP_DRAWS * blocks, []
    while wanted > 0:
        raw = generator.randint(0, 1 << 32, size=2 * wanted + 64, dtype=np.uint32) >> np.uint32(32 - bits)
        kept = raw[raw < blocks][:wanted]
        picks.append(kept)
        wanted -= len(kept)
    return np.concatenate(picks).astype(np.int64).reshape(BOOTSTRAP_DRAWS, blocks)


@udtf(returnType="draw int, pos int, block int")
class BlockDraws:
    """Table function (seed_key, hex_digits, blocks) -> a row for each pick of each draw."""

    def eval(self, seed_key: str, hex_digits: int, blocks: int):
        for draw, picks in enumerate(draw_blocks(seed_key, hex_digits, blocks).tolist() if blocks else []):
            for pos, block in enumerate(picks):
                yield draw, pos, block


def interval(draws: np.ndarray) -> tuple[float | None, float | None]:
    """2.5 and 97.5 percentiles, linear between the neighbouring order statistics."""
    if not len(draws):
        return None, None
    low, high = np.percentile(draws, (2.5, 97.5))
    return float(low), float(high)


INTERVAL = T.StructType([T.StructField(n, T.DoubleType()) for n in ("low", "high")])
PAIRED = T.StructType([T.StructField(n, INTERVAL) for n in ("own", "bench", "delta")])


def delta_interval(seed_key, dates, signal_sum, signal_n, base_sum, base_n,
                   cut_signal_sum, cut_signal_n, cut_base_sum, cut_base_n):
    """Interval of mean(signal) - mean(base); the drawn dates are cut to the series length.

    The cut bites only when a draw misses the partial last block: then exactly its last
    drawn block loses its tail, and the `cut_` sums (first dates of each block) count.
    """
    blocks = len(base_n)
    if not blocks or not sum(signal_n) or not sum(base_n):
        return None, None
    picks = draw_blocks(seed_key, 8, blocks)
    partial = dates % BOOTSTRAP_BLOCK
    last = picks[:, -1]
    shortened = (partial > 0) & ~(picks == blocks - 1).any(axis=1)

    def total(full, cut):
        full, cut = np.asarray(full, float), np.asarray(cut, float)
        return full[picks].sum(axis=1) - np.where(shortened, full[last] - cut[last], 0.0)

    s, sn = total(signal_sum, cut_signal_sum), total(signal_n, cut_signal_n)
    b, bn = total(base_sum, cut_base_sum), total(base_n, cut_base_n)
    usable = (sn > 0) & (bn > 0)
    return interval(s[usable] / sn[usable] - b[usable] / bn[usable])


def paired_intervals(seed_key, own_sum, bench_sum, rows):
    """Intervals of the own mean, the benchmark mean and their difference; no cut."""
    blocks = len(rows)
    if not blocks:
        return (None, None), (None, None), (None, None)
    picks = draw_blocks(seed_key, 16, blocks)
    n = np.asarray(rows, float)[picks].sum(axis=1)
    usable = n > 0
    own = np.asarray(own_sum, float)[picks].sum(axis=1)[usable] / n[usable]
    bench = np.asarray(bench_sum, float)[picks].sum(axis=1)[usable] / n[usable]
    return interval(own), interval(bench), interval(own - bench)


@arrow_udf(INTERVAL)
def delta_interval_udf(*columns: pa.Array) -> pa.Array:
    rows = zip(*[c.to_pylist() for c in columns])
    return pa.array([dict(zip(("low", "high"), delta_interval(*row))) for row in rows],
                    pa.struct([("low", pa.float64()), ("high", pa.float64())]))


@arrow_udf(PAIRED)
def paired_intervals_udf(*columns: pa.Array) -> pa.Array:
    side = pa.struct([("low", pa.float64()), ("high", pa.float64())])
    rows = zip(*[c.to_pylist() for c in columns])
    return pa.array([{name: dict(zip(("low", "high"), pair))
                      for name, pair in zip(("own", "bench", "delta"), paired_intervals(*row))}
                     for row in rows], pa.struct([("own", side), ("bench", side), ("delta", side)]))
