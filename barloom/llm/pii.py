"""Personal data: base patterns as seeds, and identifiers found by the words before them.

DataFrame functions only. Base entities are seed instances. The two words before an entity, with its outline, are a
lexical pattern; pattern and instance form a graph. Rounds of grouped scoring weigh a pattern's known instances against
instances whose shape contradicts it (one as common where no pattern has a seed), and raise an instance by its best
pattern; instances that are merely unknown count neither way. Patterns that stay sure then point out identifiers that no
base pattern describes: words with digits, runs of them joined by single spaces, and words with an at sign.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import dropped, query, staged, table
from barloom.llm.spans import KINDS, SPANS, blocks, bound, cut, folded, found, joined, kept, labelled

BASE = ("email", "ip", "card", "phone")
#: The base patterns, possessive where that changes no match; a start inside a run is left out where the run's own start has failed.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Stands for the characters of base spans, which no candidate may touch.
MASK = "\x00"
_WITH_DIGIT = r"[^\x20\x09-\x0D0-9@\x00]*+[0-9][^\x20\x09-\x0D@\x00]*+(?![^\x20\x09-\x0D])"
_WITH_AT = r"[^\x20\x09-\x0D@\x00]*+@[^\x20\x09-\x0D\x00]*+(?![^\x20\x09-\x0D])"
#: A word with an at sign, or words with digits joined by single spaces up to one that ends in punctuation; whole words only.
CANDIDATES = rf"(?<![^\x20\x09-\x0D])(?:{_WITH_AT}|{_WITH_DIGIT}(?:(?<![.,;:!?])\x20{_WITH_DIGIT})*+)"
#: From so many digits on an identifier is told by its value alone; characters that are looked at before an entity, rounds of scoring.
SPECIFIC_DIGITS, BEFORE, ROUNDS = 6, 100, 3
#: One word of SPECIFIC_DIGITS or more.
SPECIFIC_WORDS = rf"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D0-9@\x00]*+[0-9]){{{SPECIFIC_DIGITS}}}+[^\x20\x09-\x0D@\x00]*+(?![^\x20\x09-\x0D])"
#: A pattern is sure if the lower bound of its support (two standard errors) is at least so much.
SURE = 0.8
#: A shape belongs to a pattern if it is at least so many times as common there as in patterns without seeds.
BELONGS = 2.0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _of(kind: str) -> Column:
    text = F.col("text")
    if kind == "email":
        return kept(F.contains(text, F.lit("@")), found(text, EMAIL), lambda s: F.lit(True))
    if kind == "ip":
        return kept(text.rlike(r"[0-9]\.[0-9]"), found(text, IP), lambda s: F.forall(F.split(s["value"], r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))))
    if kind == "card":
        return kept(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), found(text, CARD),
                    lambda s: F.length(_digits(s["value"])).between(12, 19) & F.when(F.length(_digits(s["value"])).between(12, 19), F.call_function("luhn_check", _digits(s["value"]))).otherwise(F.lit(False)))
    return kept(F.contains(text, F.lit("+")), found(text, PHONE), lambda s: F.length(_digits(s["value"])).between(9, 15))


def _base_spans() -> Column:
    return F.concat(F.array().cast(KINDS), *[labelled(_of(k), k, p) for p, k in enumerate(BASE)])


def _masked() -> Column:
    """The text with the characters of base spans replaced by MASK, so that places stay."""
    text = F.translate("text", MASK, "x")

    def by_blocks(parts):
        def step(at, x):
            begin, end = F.greatest(at, x["start"]), F.greatest(at, x["end"])
            return end, F.array(cut(parts, at, begin - at), F.repeat(F.lit(MASK), end - begin))
        end = F.array_max(F.transform("__base", lambda b: b["end"]))
        done = folded(F.array_sort("__base"), F.lit(0), step, "string")
        return F.concat(F.array_join(done, ""), F.substr(text, end + 1))
    return F.when(F.size("__base") > 0, bound(blocks(text), by_blocks)).otherwise(text)


def _shape(value: Column) -> Column:
    """Letters in a run are one a, digits 0 each; with an at sign, letters and digits in a run are one a."""
    return F.when(F.contains(value, F.lit("@")), F.regexp_replace(value, r"[\p{L}0-9]+", "a")).otherwise(
        F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]", "0"))


def _specific(shape: Column) -> Column:
    return F.contains(shape, F.lit("@")) | (F.length(F.regexp_replace(shape, "[^0]", "")) >= SPECIFIC_DIGITS)


def _mention(parts: Column, start: Column, end: Column, known: Column) -> Column:
    """start, end, pattern (the two words before, bare and in lower case, and the outline) and the instance itself, bare."""
    first = F.greatest(F.lit(0), start - BEFORE)
    ahead = cut(parts, first, start - first)
    words = F.filter(F.split(F.lower(ahead), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    near = F.transform(F.slice(F.concat(F.array(F.lit(""), F.lit("")), words), -2, 2), lambda w: F.regexp_replace(w, r"^[\p{Punct}]+|[\p{Punct}]+$", ""))
    value = cut(parts, start, end - start)
    outline = F.when(F.contains(value, F.lit("@")), "@").otherwise("0")
    bare = F.regexp_replace(F.lower(value), r"^[\p{Punct}&&[^@+]]++|(?<![\p{Punct}&&[^@+]])[\p{Punct}&&[^@+]]++$", "")
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.concat_ws(" ", near, outline).alias("pattern"), bare.alias("value"), known.alias("known"))


def annotated(docs: DataFrame) -> DataFrame:
    """docs(text, ...) with __base (spans of the base kinds) and __mentions (base entities and candidates).

    A word of SPECIFIC_DIGITS or more inside a run is a candidate of its own too, after the words that stand before it.
    """
    base = docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("__base", _base_spans()).withColumn("__masked", _masked())
    masked, none = F.col("__masked"), F.array().cast(SPANS)
    runs = F.filter(F.when(masked.rlike("[0-9@]"), found(masked, CANDIDATES)).otherwise(none), lambda w: w["value"].rlike(r"[\p{L}0-9]"))
    base = base.withColumn("__runs", runs)
    several = F.exists("__runs", lambda w: F.contains(w["value"], F.lit(" ")) & (F.length(_digits(w["value"])) >= SPECIFIC_DIGITS))
    words = F.when(several, found(masked, SPECIFIC_WORDS)).otherwise(none)

    def place(w):  # one number for start and end, as distinct numbers are hashed
        return F.shiftleft(w["start"].cast("long"), 32) + w["end"]
    others = F.array_distinct(F.concat(F.transform("__runs", place), F.transform(words, place)))

    def mentions(parts):
        return F.concat(F.transform("__base", lambda b: _mention(parts, b["start"], b["end"], F.lit(True))),
                        F.transform("__others", lambda p: _mention(parts, F.shiftright(p, 32).cast("int"), p.bitwiseAND(F.lit(2**32 - 1)).cast("int"), F.lit(False))))
    some = (F.size("__base") > 0) | (F.size("__others") > 0)
    return base.withColumn("__others", others).withColumn("__mentions", bound(F.when(some, blocks(F.col("text"))).otherwise(F.array().cast("array<string>")), mentions)) \
        .drop("__masked", "__runs", "__others")


def sure_patterns(mentions: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> DataFrame:
    """mentions(pattern, value, known) -> (pattern, shape): the shapes that point to identifiers in patterns that are sure.

    Distinct values count, so copies add nothing. For a pattern speak its known values and those that stand in other sure
    patterns too; against it speak unknown values whose shape does not belong to it, that is, is not BELONGS times as
    common as in the patterns without seeds. One number in ten passes a card's check by chance, so nine that fail it take
    one that passes from the pattern's support. Only values that are specific (an at sign or SPECIFIC_DIGITS) raise other
    patterns; shorter ones are identifiers where their shape belongs to the pattern. Every round joins and groups the
    graph's edges, and is written.
    """
    shape = _shape(F.col("value"))
    card_like = F.col("value").rlike(r"^[0-9](?:[\x20-]?[0-9]){11,18}$")
    edges = staged(mentions.groupBy("pattern", "value").agg(F.max("known").alias("known")).select("*", shape.alias("shape"), card_like.alias("card_like")), "edges")
    seen = edges.groupBy("pattern", "shape").agg(F.count("*").alias("n"), F.count_if(~F.col("known")).alias("unknown"))
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("size"), (~F.bool_or("known")).alias("seedless"))
    pairs = staged(seen.join(sizes, "pattern").withColumn("outline", F.contains("shape", F.lit("@"))), "pairs")
    common = pairs.where("seedless").groupBy("outline", "shape").agg(F.sum("n").alias("times"))
    totals = common.groupBy("outline").agg(F.sum("times").alias("total"))
    rates = common.join(F.broadcast(totals), "outline").select("shape", (F.col("times") / F.col("total")).alias("rate"))
    belongs = F.col("unknown") >= BELONGS * F.col("size") * F.coalesce("rate", F.lit(0.0))
    judged = staged(pairs.join(rates, "shape", "left").select("pattern", "shape", "unknown", belongs.alias("belongs")), "judged")
    against = judged.where("NOT belongs").groupBy("pattern").agg(F.sum("unknown").alias("against"))
    dropped(pairs)
    values, result = staged(edges.groupBy("value").agg(F.max(F.col("known").cast("double")).alias("score")), "values"), None
    for last in [False] * (rounds - 1) + [True]:
        met = edges.join(values.where("score > 0"), "value", "left").select("pattern", "known", "card_like", F.coalesce("score", F.lit(0.0)).alias("score"))
        failed, passed = F.count_if(F.col("card_like") & ~F.col("known")), F.sum(F.when(F.col("card_like") & F.col("known"), 1.0).otherwise(0.0))
        support = met.groupBy("pattern").agg((F.sum("score") - F.least(passed, failed / 9)).alias("s")).where("s > 0")
        n = F.col("s") + F.coalesce("against", F.lit(0))
        share = (F.col("s") + 1) / (n + 2)
        patterns = staged(support.join(against, "pattern", "left").select("pattern", (share - 2 * F.sqrt(share * (1 - share) / (n + 3))).alias("sure")).where(F.col("sure") >= sure), "patterns")
        dropped(values)
        if last:
            result = staged(judged.join(patterns, "pattern").where(F.col("belongs") | _specific(F.col("shape"))).select("pattern", "shape"), "sure")
            dropped(edges, judged, patterns)
        else:
            raised = edges.join(patterns, "pattern", "left").select("value", F.greatest(F.col("known").cast("double"), F.when(_specific(F.col("shape")), F.coalesce("sure", F.lit(0.0))).otherwise(0.0)).alias("score"))
            values = staged(raised.groupBy("value").agg(F.max("score").alias("score")), "values")
            dropped(patterns)
    return result


def _apart(spans: Column) -> Column:
    """The spans in order without those that begin inside one that is kept; of equal starts the longest is kept."""
    ordered = F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back")))), lambda s: F.struct(s["start"].alias("start"), (-s["back"]).alias("end")))

    def step(at, x):
        span = F.struct(x["start"].alias("start"), F.lit(len(BASE)).alias("place"), x["end"].alias("end"), F.lit("context").alias("kind"))
        inside = x["start"] < at
        return F.when(inside, at).otherwise(x["end"]), F.when(inside, F.array().cast(KINDS)).otherwise(F.array(span).cast(KINDS))
    return folded(ordered, F.lit(0), step, KINDS.removeprefix("array<")[:-1])


def find_personal(docs: DataFrame, keep: list[str]) -> DataFrame:
    """docs(text, ...) -> a row for each, with the columns named in keep and `__spans` (start, place, end, kind), sorted.

    Base spans stay; `context` spans are added where a sure pattern stands before an identifier that overlaps none of
    them. Null texts count as empty. Rows are told apart by a number that is written with them, so null or repeated ids
    and repeated rows are kept apart. An empty table gives an empty one. Columns __row, __base, __masked, __runs,
    __others, __mentions, __spans are the operator's own.
    """
    rows = staged(annotated(docs).select(F.monotonically_increasing_id().alias("__row"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__kept"), "__base", "__mentions"), "mentions")
    each = rows.select("__row", F.explode("__mentions").alias("m")).select("__row", "m.*")
    patterns = sure_patterns(each.select("pattern", "value", "known"))
    hits = staged(each.where("NOT known").select("__row", "start", "end", "pattern", _shape(F.col("value")).alias("shape")).join(patterns, ["pattern", "shape"]), "hits")
    more = hits.groupBy("__row").agg(_apart(F.collect_set(F.struct("start", "end"))).alias("__more"))
    out = rows.join(staged(more, "more"), "__row", "left")
    dropped(hits, patterns)
    return out.select("__kept.*", F.array_sort(F.concat("__base", F.coalesce("__more", F.array().cast(KINDS)))).alias("__spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of spans that overlap, the first in order counts."""
    def by_blocks(parts):
        def step(at, x):
            inside = x["start"] < at
            piece = F.concat(cut(parts, at, x["start"] - at), F.lit("<"), F.upper(x["kind"]), F.lit(">"))
            return F.greatest(at, x["end"]), F.when(inside, F.array().cast("array<string>")).otherwise(F.array(piece))
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(folded(spans, F.lit(0), step, "string"), ""), F.substr(text, end + 1))
    return F.when(F.size(spans) > 0, bound(blocks(text), by_blocks)).otherwise(text)


def without_personal(docs: DataFrame) -> DataFrame:
    """docs with the personal data in `text` redacted and n_chars counted anew; all else, null texts too, as it was."""
    names = docs.columns
    out = find_personal(docs.withColumn("__text", F.col("text")), [*[c for c in names if c != "text"], "__text"])
    text = redacted(F.col("__text"), F.col("__spans"))
    return out.withColumn("text", text).select(*[
        F.when(F.col("__text").isNull() | (F.size("__spans") == 0), F.col(c)).otherwise(F.length("text")).cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in names])


@query("op8_pii")
def op8_pii(spark, sf_dir):
    out = find_personal(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    base = F.filter("__spans", lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"))
