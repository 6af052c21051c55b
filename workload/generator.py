"""Draws of the bootstrap in SQL: the Mersenne Twister seeded by an array of words, as recursive queries.

The constants and the recurrence are those of the published generator (Matsumoto and Nishimura, 2002); Python's `random`
seeds it by the 32-bit words of a whole number and takes the top bits of an output, rejecting numbers that are too large.
"""
from __future__ import annotations

from barloom.contracts import BOOTSTRAP_BLOCK as BLOCK
from barloom.contracts import BOOTSTRAP_DRAWS

#: Outputs of one step: the recurrence looks 397 of 624 ahead.
STEP = 227
LOW = 4294967295


def _scramble(current: str, previous: str, factor: int) -> str:
    return f"xor({current}, (xor({previous}, {previous} >> 30) * {factor}) & {LOW})"


def picks(series: str, p: str, draws: int = BOOTSTRAP_DRAWS) -> str:
    """CTEs (for WITH RECURSIVE) up to `<p>picks` (seed_key, draw, pos, block), out of `series` (seed_key, digits, blocks).

    digits: hex digits of the key's SHA-256 that make the seed, 8 or 16. `p` keeps the names of several uses apart.
    """
    return f"""
{p}base AS (SELECT 0::BIGINT AS i, 19650218::BIGINT AS v
  UNION ALL SELECT i + 1, (1812433253 * xor(v, v >> 30) + i + 1) & {LOW} FROM {p}base WHERE i < 623),
{p}start AS (SELECT list(v ORDER BY i) AS b FROM {p}base),
{p}keys AS (SELECT DISTINCT seed_key, blocks, digits // 8 AS words, [('0x' || substr(sha256(seed_key), digits - 7, 8))::BIGINT, ('0x' || substr(sha256(seed_key), 1, 8))::BIGINT] AS w FROM {series}),
{p}one AS (SELECT seed_key, words, w, b, 0::BIGINT AS k, {_scramble('b[2]', 'b[1]', 1664525)} + w[1] & {LOW} AS v, {_scramble('b[2]', 'b[1]', 1664525)} + w[1] & {LOW} AS first FROM {p}keys, {p}start
  UNION ALL SELECT seed_key, words, w, b, k + 1, {_scramble('CASE WHEN k < 622 THEN b[k + 3] ELSE first END', 'v', 1664525)} + w[1 + (k + 1) % words] + (k + 1) % words & {LOW}, first FROM {p}one WHERE k < 623),
{p}mid AS (SELECT seed_key, list(v ORDER BY k) AS v FROM {p}one GROUP BY seed_key),
{p}two AS (SELECT seed_key, v AS m, 0::BIGINT AS k, {_scramble('v[2]', 'v[624]', 1566083941)} - 2 + {LOW + 1} & {LOW} AS u FROM {p}mid
  UNION ALL SELECT seed_key, m, k + 1, {_scramble('CASE WHEN k < 621 THEN m[k + 3] ELSE m[624] END', 'u', 1566083941)} - CASE WHEN k < 621 THEN k + 3 ELSE 1 END + {LOW + 1} & {LOW} FROM {p}two WHERE k < 622),
{p}state AS (SELECT seed_key, list(u ORDER BY k) AS u FROM {p}two GROUP BY seed_key),
{p}ready AS (SELECT seed_key, blocks, CAST(floor(log2(blocks)) AS BIGINT) + 1 AS bits, list_concat([2147483648::BIGINT, u[623]], u[1:622]) AS x FROM {p}state JOIN {p}keys USING (seed_key)),
{p}run AS (SELECT seed_key, blocks, bits, 0::BIGINT AS step, x, NULL::BIGINT[] AS fresh FROM {p}ready
  UNION ALL SELECT seed_key, blocks, bits, step + 1, list_concat(x[{STEP + 1}:624], fresh), fresh FROM (
    SELECT seed_key, blocks, bits, step, x, list_transform(range(1, {STEP + 1}), lambda i: xor(xor(x[i + 397], ((x[i] & 2147483648) | (x[i + 1] & 2147483647)) >> 1), (x[i + 1] & 1) * 2567483615)) AS fresh
    FROM {p}run WHERE step * {STEP} < {draws} * (1 << bits) * 1.05 + 2000) a),
{p}out AS (SELECT seed_key, blocks, bits, step, unnest(range(1, {STEP + 1})) AS i, unnest(fresh) AS y FROM {p}run WHERE step > 0),
{p}t1 AS (SELECT * REPLACE (xor(y, y >> 11) AS y) FROM {p}out),
{p}t2 AS (SELECT * REPLACE (xor(y, (y << 7) & 2636928640) AS y) FROM {p}t1),
{p}t3 AS (SELECT * REPLACE (xor(y, (y << 15) & 4022730752) AS y) FROM {p}t2),
{p}kept AS (SELECT seed_key, blocks, xor(y, y >> 18) >> (32 - bits) AS block, row_number() OVER (PARTITION BY seed_key ORDER BY step, i) - 1 AS n FROM {p}t3 WHERE (xor(y, y >> 18) >> (32 - bits)) < blocks),
{p}picks AS (SELECT seed_key, n // blocks AS draw, n % blocks AS pos, block FROM {p}kept WHERE n < {draws} * blocks)"""


def _blocks(dated: str, p: str, digits: int, sums: list[str]) -> str:
    """CTEs up to `<p>block`: sums of each block of dates, and of its first dates, as many as the last block has."""
    full = ", ".join(f"sum({c}) AS {c}" for c in sums)
    cut = ", ".join(f"sum({c}) - coalesce(sum({c}) FILTER (i % {BLOCK} < dates % {BLOCK}), 0) AS {c}_lost" for c in sums)
    return f"""
{p}series AS (SELECT seed_key, {digits} AS digits, (count(*) + {BLOCK - 1}) // {BLOCK} AS blocks, count(*) AS dates FROM {dated} GROUP BY 1),{picks(p + "series", p)},
{p}placed AS (SELECT *, row_number() OVER (PARTITION BY seed_key ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY seed_key) AS dates FROM {dated}),
{p}block AS (SELECT seed_key, i // {BLOCK} AS block, {full}, {cut} FROM {p}placed GROUP BY 1, 2)"""


def delta_interval(dated: str, name: str, p: str) -> str:
    """CTEs up to `name` (seed_key, low, high): interval of mean(s / sn) - mean(b / bn), out of `dated` (seed_key, date, s, sn, b, bn).

    A draw that misses the partial last block loses what its last block has beyond the series' length.
    """
    sums = ["s", "sn", "b", "bn"]
    drawn = ", ".join(f"sum({c}) AS {c}, arg_max({c}_lost, pos) AS {c}_lost" for c in sums)
    cut = ", ".join(f"{c} - CASE WHEN short THEN {c}_lost ELSE 0 END AS {c}" for c in sums)
    return f"""{_blocks(dated, p, 8, sums)},
{p}drawn AS (SELECT k.seed_key, k.draw, any_value(q.dates) % {BLOCK} > 0 AND max(k.block) < any_value(q.blocks) - 1 AS short, {drawn}
  FROM {p}picks k JOIN {p}block t ON t.seed_key = k.seed_key AND t.block = k.block JOIN {p}series q ON q.seed_key = k.seed_key GROUP BY 1, 2),
{name} AS (SELECT seed_key, quantile_cont(s / sn - b / bn, 0.025) AS low, quantile_cont(s / sn - b / bn, 0.975) AS high
  FROM (SELECT seed_key, {cut} FROM {p}drawn) t WHERE sn > 0 AND bn > 0 GROUP BY 1)"""


def paired_interval(dated: str, name: str, p: str) -> str:
    """CTEs up to `name` (seed_key, own_low, ..., delta_high), out of `dated` (seed_key, date, own, bench, n); no draw is cut."""
    bands = ", ".join(f"quantile_cont({c}, {q}) AS {n}_{e}" for n, c in (("own", "own / n"), ("bench", "bench / n"), ("delta", "own / n - bench / n"))
                      for e, q in (("low", 0.025), ("high", 0.975)))
    return f"""{_blocks(dated, p, 16, ["own", "bench", "n"])},
{name} AS (SELECT seed_key, {bands} FROM (SELECT k.seed_key, k.draw, sum(own) AS own, sum(bench) AS bench, sum(n) AS n
  FROM {p}picks k JOIN {p}block t ON t.seed_key = k.seed_key AND t.block = k.block GROUP BY 1, 2) d WHERE n > 0 GROUP BY 1)"""
