"""Secret scans by a trigram index: Boolean trigram queries from each rule's pattern, postings, and exact checks.

DataFrame functions only. A rule's pattern is turned into alternatives of trigrams that any match must contain. The index
holds, for each trigram that some rule asks for, the texts that contain it; an alternative's postings are intersected,
alternatives are united, and the texts that are left are searched with the pattern itself. A rule of which some
alternative has no trigram is searched in all texts.
"""
from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import dropped, query, staged, table
from barloom.llm.spans import KINDS, found, joined, kept, labelled


@dataclass(frozen=True)
class Rule:
    """pattern: understood alike by Java, RE2 and Python. group: the part that must have `least` characters or more."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0


KEYWORDS = "password|passwd|secret|token|api_?key"
_EITHER = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in KEYWORDS)
#: Base rules first, in the order in which spans of one start are listed; then public credential formats.
RULES = (
    Rule("assign", rf"""(?:{_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 1),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", "[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


def literals(pattern: str) -> list[list[str]]:
    """Alternatives, each with the lower-case literal runs that a match contains whole; '' stands for a gap.

    Characters, classes of one letter in both cases, groups, branches and optional parts are followed; a repeated part
    counts once with gaps around it; anything else is a gap.
    """
    def join(heads: list[list[str]], tails: list[list[str]]) -> list[list[str]]:
        return [[*h[:-1], h[-1] + t[0], *t[1:]] for h in heads for t in tails]

    def walk(nodes) -> list[list[str]]:
        out = [[""]]
        for op, arg in nodes:
            if op is rc.LITERAL:
                part = [[chr(arg).lower()]]
            elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg) and len({chr(a).lower() for _, a in arg}) == 1:
                part = [[chr(arg[0][1]).lower()]]
            elif op is rc.SUBPATTERN:
                part = walk(arg[3])
            elif op is rc.BRANCH:
                part = [x for branch in arg[1] for x in walk(branch)]
            elif op is rc.MAX_REPEAT and arg[:2] == (0, 1):
                part = [[""], *walk(arg[2])]
            elif op is rc.MAX_REPEAT and arg[0] >= 1:
                part = [["", *x, ""] for x in walk(arg[2])]
            else:
                part = [["", ""]]
            out = join(out, part)
        return out
    return walk(rp.parse(pattern))


def trigram_query(pattern: str) -> list[tuple[str, ...]] | None:
    """Alternatives of trigrams that all must occur (in ASCII lower case); None: the rule has to search every text."""
    out = []
    for runs in literals(pattern):
        grams = sorted({r[i:i + 3] for r in runs for i in range(len(r) - 2)})
        if not grams:
            return None
        out.append(tuple(grams))
    return sorted(set(out))


def _keyed(docs: DataFrame) -> DataFrame:
    """Null texts as empty, and 128 bits of each text: equal texts share postings and results."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(7), F.col("text"))})


def trigram_index(keyed: DataFrame, grams: list[str]) -> DataFrame:
    """Postings (gram, k1, k2) of the given trigrams in the whole texts."""
    present = F.transform(F.array(F.lower("text")), lambda low: F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(low, g)))[0]  # lower once
    return keyed.select("k1", "k2", F.explode(present).alias("gram"))


def _long_enough(rule: Rule):
    part = "part" if rule.group else "value"
    return lambda s: F.length(s[part]) >= rule.least


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def _all_spans(rules, guard_of):
    """Spans of (place, rule) pairs in the column text, where a rule's guard holds."""
    arrays = []
    for place, rule in rules:
        spans = found(F.col("text"), rule.pattern, rule.group)
        arrays.append(labelled(kept(guard_of(rule), spans, _long_enough(rule)), rule.kind, place))
    return F.concat(F.array().cast(KINDS), *arrays)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs(doc_id, text) -> a row for each: doc_id, spans (start, place of the rule, end, kind), sorted.

    Null texts count as empty. Rows that repeat, null ids and empty tables need no care: rows are never matched by id.
    Other columns of docs are not read. A text that copies a third of all rows is one posting and one check a task.
    """
    keyed = _keyed(docs)
    numbered = list(enumerate(rules))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = [(p, r) for p, r in numbered if queries[r.kind] is not None]
    plain = [(p, r) for p, r in numbered if queries[r.kind] is None]
    base = keyed.select("doc_id", "k1", "k2", _all_spans(plain, lambda r: F.col("text").rlike(r.pattern)).alias("__plain"))
    if not indexed:
        return base.select("doc_id", F.array_sort("__plain").alias("spans"))
    grams = sorted({g for _, r in indexed for alternative in queries[r.kind] for g in alternative})
    postings = staged(trigram_index(keyed, grams), "postings")
    wanted = docs.sparkSession.createDataFrame(  # a row a trigram of a rule's alternative: as many as the rules say
        [(p, a, g, len(alternative)) for p, r in indexed for a, alternative in enumerate(queries[r.kind]) for g in alternative],
        "rule int, alternative int, gram string, need int")
    candidates = postings.join(F.broadcast(wanted), "gram").groupBy("k1", "k2", "rule", "alternative", "need").agg(F.collect_set("gram").alias("has")) \
        .where(F.size("has") == F.col("need")).groupBy("k1", "k2").agg(F.collect_set("rule").alias("rules"))
    candidates = staged(candidates, "candidates")
    place = {r.kind: p for p, r in indexed}
    checked = staged(keyed.select("k1", "k2", "text").join(candidates, ["k1", "k2"])
                     .select("k1", "k2", _all_spans(indexed, lambda r: F.array_contains("rules", place[r.kind])).alias("__found")).where(F.size("__found") > 0), "checked")
    once = staged(checked.groupBy("k1", "k2").agg(F.first("__found").alias("__found")), "found")
    out = staged(base, "plain").join(once, ["k1", "k2"], "left")
    dropped(postings, candidates, checked)
    return out.select("doc_id", F.array_sort(F.concat("__plain", F.coalesce("__found", F.array().cast(KINDS)))).alias("spans"))


def _sql() -> str:
    """The same rules in SQL: places from the pieces between matches."""
    parts = []
    for place, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT row, {place} AS place, '{rule.kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
      'start': CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
      'size': length(m[i]), 'part': length(p[i])}})) AS span
  FROM (SELECT row, regexp_extract_all(text, '{pattern}') AS m, regexp_split_to_array(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}', {rule.group}) AS p FROM texts)""")
    least = " ".join(f"WHEN {p} THEN {r.least}" for p, r in enumerate(RULES))
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), spans AS ({" UNION ALL ".join(parts)}
), good AS (
  SELECT row, place, kind, span.start AS start, span.start + span.size AS stop FROM spans WHERE span.part >= CASE place {least} END
), by_row AS (
  SELECT row, CAST(count(*) FILTER (WHERE kind = 'assign') AS BIGINT) AS n_assign, CAST(count(*) FILTER (WHERE kind = 'access') AS BIGINT) AS n_access,
    CAST(count(*) FILTER (WHERE kind = 'hex') AS BIGINT) AS n_hex,
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (WHERE place < {len(BASE)}), '') AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM good GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN by_row USING (row)
"""


@query("op7_secrets", _sql())
def op7_secrets(spark, sf_dir):
    out = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return out.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
