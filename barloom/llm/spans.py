"""Spans of regular expressions in texts, as column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: start and end in code points (end exclusive), the matched text and its first group (the match, where there is none).
SPANS = "array<struct<start:int,end:int,value:string,part:string>>"
#: start, place of the kind in its list, end, kind: sorts by start, then kind as listed.
KINDS = "array<struct<start:int,place:int,end:int,kind:string>>"


#: Elements that a fold adds to one list before it starts the next; characters of a block of text.
CHUNK, BLOCK = 512, 1024


def bound(value: Column, use) -> Column:
    """use(v) with the value worked out once, however often v occurs."""
    return F.element_at(F.transform(F.array(value), use), 1)


def folded(items: Column, at: Column, step, kind: str) -> Column:
    """The elements that a walk over items gives, `kind` being their type; step(at, x) -> (next at, array of elements).

    An array is copied each time it grows, so a plain fold takes quadratic time. Here elements are gathered in lists of at
    most CHUNK items and the lists are flattened once.
    """
    none, lists = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def inner(s, x):
        after, more = step(s["at"], x)
        return F.struct(after.alias("at"), F.concat(s["out"], more).alias("out"))

    def walk(all_items):
        chunks = F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / CHUNK).cast("int"))

        def outer(s, c):
            part = F.aggregate(F.slice(all_items, c * CHUNK + 1, CHUNK), F.struct(s["at"].alias("at"), none.alias("out")), inner)
            return bound(part, lambda got: F.struct(got["at"].alias("at"), F.array_append(s["out"], got["out"]).alias("out")))
        full = F.aggregate(chunks, F.struct(at.alias("at"), lists.alias("out")), outer, lambda s: F.flatten(s["out"]))
        return F.when(F.size(all_items) > 0, full).otherwise(none)
    return bound(items, walk)


def blocks(text: Column) -> Column:
    """The text in blocks of BLOCK code points, for `cut`: finding a place in a long text means counting from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut(parts: Column, start: Column, size: Column) -> Column:
    """`size` code points from `start` (from 0) of the text whose blocks are given."""
    first = F.floor(start / BLOCK).cast("int")
    last = F.floor((start + F.greatest(size, F.lit(1)) - 1) / BLOCK).cast("int")
    return F.substr(F.array_join(F.slice(parts, first + 1, last - first + 1), ""), start - first * BLOCK + 1, size)


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches of a Java pattern, in order.

    The pieces between the matches give their places, so a text is searched twice and measured once. Patterns should
    repeat groups possessively: then a match of any length needs no stack.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("value"), parts.alias("part"))

    def step(at, x):
        begin = at + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["value"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"), x["part"].alias("part"))
        return end, F.when(x["value"].isNull(), F.array().cast(SPANS)).otherwise(F.array(span).cast(SPANS))
    return folded(zipped, F.lit(0), step, SPANS.removeprefix("array<")[:-1])


def kept(guard: Column, spans: Column, check) -> Column:
    """The spans that pass the check; none where the guard says that there can be none."""
    return F.when(guard, F.filter(spans, check)).otherwise(F.array().cast(SPANS))


def labelled(spans: Column, kind: str, place: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind"))).cast(KINDS)


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
