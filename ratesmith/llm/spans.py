"""Regular-expression matches with their code-point offsets, as expressions.

Everything here stays inside the row: matches come from one function, the
text between them from another, and running sums of their lengths give the
offsets.  No shuffle, no row ids, no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,match:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def running_before(values: Column) -> Column:
    """For each element of an int array, the sum of those before it.

    Sums run within blocks of about the square root of the size, then over
    the blocks, so long arrays cost size^1.5 steps rather than size^2.
    """
    def blocks(v: Column) -> Column:
        width = F.greatest(F.lit(1), F.floor(F.sqrt(F.size(v)))).cast("int")
        return let(F.struct(v.alias("v"), width.alias("w")), lambda s: let(
            F.transform(F.sequence(F.lit(0), F.floor((F.size(s["v"]) - 1) / s["w"]).cast("int")),
                        lambda k: _total(F.slice(s["v"], k * s["w"] + 1, s["w"]))),
            lambda sums: let(
                F.transform(sums, lambda _, k: _total(F.slice(sums, F.lit(1), k))),
                lambda base: F.transform(s["v"], lambda _, i: F.get(
                    base, F.floor(i / s["w"]).cast("int")) + _total(F.slice(
                        s["v"], F.floor(i / s["w"]).cast("int") * s["w"] + 1, i % s["w"]))))))

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(let(values, blocks))


def locate(text: Column, pattern: str, only_if: Column | None = None) -> Column:
    """Leftmost non-overlapping matches (never empty ones) as SPAN.

    ``only_if`` is a cheap condition that any text with a match fulfils.
    Patterns repeat groups possessively, as deep recursion would overflow the
    stack on very long matches.
    """
    def offsets(s: Column) -> Column:
        gaps = F.slice(s["gaps"], F.lit(1), F.size(s["found"]))
        steps = F.zip_with(s["found"], gaps, lambda m, g: F.length(m) + F.length(g))
        ends = F.zip_with(running_before(steps), steps, lambda a, b: a + b)
        return F.zip_with(s["found"], ends, lambda m, e: F.struct(
            (e - F.length(m)).alias("start"), e.alias("end"), m.alias("match")))

    none = F.array().cast(SPAN)
    found = let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
                         F.split(text, pattern, -1).alias("gaps")),
                lambda s: F.when(F.size(s["found"]) == 0, none).otherwise(offsets(s)))
    return found if only_if is None else F.when(only_if, found).otherwise(none)


def join_spans(kinds: Sequence[tuple[str, Column]]) -> Column:
    """"kind:start:end" of all spans, by kind as listed, then start, joined by
    commas; the arrays are in order already."""
    def shown(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.concat(
            F.lit(kind + ":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))

    return F.array_join(F.concat(*[shown(kind, spans) for kind, spans in kinds]), ",")


#: Characters of a block of a text (see :func:`blocks_of`).
BLOCK_CHARS = 1024


def blocks_of(text: Column) -> Column:
    """The text cut into blocks, so that pieces are found without counting
    characters from its beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))


def piece_of(blocks: Column, start: Column, length: Column) -> Column:
    """``length`` characters of a text from ``start`` (of zero) on."""
    first = F.floor(start / BLOCK_CHARS).cast("int")
    last = F.floor((start + length) / BLOCK_CHARS).cast("int")
    return F.substr(F.array_join(F.slice(blocks, first + 1, last - first + 1), ""),
                    start - first * BLOCK_CHARS + 1, F.greatest(length, F.lit(0)))


def count_before(spans: Column, is_before) -> Column:
    """How many of the first spans fulfil ``is_before``, which holds for a
    beginning of the array: a binary search, so long arrays cost little."""
    n = F.size(spans)

    def halve(state: Column, _: Column) -> Column:
        mid = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        return let(mid, lambda m: let(F.get(spans, m), lambda s: F.when(
            s.isNotNull() & is_before(s), F.struct((m + 1).alias("lo"), state["hi"].alias("hi"))
        ).otherwise(F.struct(state["lo"].alias("lo"), m.alias("hi")))))

    steps = F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int"))
    return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(
        steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), halve, lambda s: s["lo"]))


def overlaps_any(span: Column, others: Sequence[Column]) -> Column:
    """Does the span share a character with a span of the other arrays, each
    in order and without overlaps?  Only the last one that begins before the
    span's end can."""
    hit = F.lit(False)
    for spans in others:
        last = let(count_before(spans, lambda o: o["start"] < span["end"]), lambda k: (k > 0) & (
            F.get(spans, k - 1)["end"] > span["start"]))
        hit = hit | F.coalesce(last, F.lit(False))
    return hit
