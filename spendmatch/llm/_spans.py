"""Regex matches with positions, as column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CHUNK = 64  # prefix sums go by chunks, so a text with many matches costs far less than their square

SPANS = "array<struct<start:int,end:int,value:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as structs (start, end, value); code points, end exclusive.

    The text between matches comes from ``split`` and the matches from
    ``regexp_extract_all``, so a start is the sum of the lengths before it.
    The pattern must not match the empty string.  NULL gives an empty array.
    """
    none = F.array().cast(SPANS)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
        lens = F.transform(found, lambda m: F.length(m))
        steps = F.zip_with(F.slice(gaps, 1, F.size(found)), lens, lambda g, m: g + m)
        return _let(F.struct(found.alias("found"), gaps.alias("gaps"), steps.alias("steps")), _place)

    return F.when(text.rlike(pattern), _let(found, placed)).otherwise(none)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _place(m: Column) -> Column:
    n = F.size(m["found"])
    chunk_sums = F.transform(F.sequence(F.lit(0), ((n - 1) / CHUNK).cast("int")),
                             lambda c: _sum(F.slice(m["steps"], c * CHUNK + 1, CHUNK)))

    def starts(sums: Column) -> Column:
        before = F.transform(F.sequence(F.lit(0), F.size(sums) - 1),
                             lambda c: F.when(c > 0, _sum(F.slice(sums, 1, F.greatest(c, F.lit(1))))).otherwise(F.lit(0)))
        return _let(before, lambda b: F.transform(m["found"], lambda v, i: _span(m, b, v, i)))

    return _let(chunk_sums, starts)


def _span(m: Column, before: Column, value: Column, i: Column) -> Column:
    c, r = (i / CHUNK).cast("int"), i % CHUNK
    start = F.element_at(before, c + 1) + F.when(r > 0, _sum(F.slice(m["steps"], c * CHUNK + 1, F.greatest(r, F.lit(1))))).otherwise(
        F.lit(0)) + F.element_at(m["gaps"], i + 1)
    return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"))


def tagged(spans: Column, order: int, kind: str) -> Column:
    """Structs (start, rank, end, kind, value), which sort by start and then by kind as listed."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))


def by_rank(spans: Column) -> Column:
    """The same spans by kind as listed, then start."""
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["rank"], s["start"], s["end"], s["kind"], s["value"])))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(text: Column, spans: Column, mark: str) -> Column:
    """The text with every span (sorted by start; they may overlap) replaced by ``mark``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"),
                        F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
