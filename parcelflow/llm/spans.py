"""Regex matches with their places, by SQL functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, also where lambdas use it again and again."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running totals of a non-empty array<int>: blocks of about sqrt(n) values, so long arrays cost n * sqrt(n)."""

    def total(a: Column) -> Column:
        return F.aggregate(F.slice(a, 2, F.size(a)), a[0], lambda x, y: step(x, y))

    def cut(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.size(v) - 1, width), lambda at: F.slice(v, at + 1, width))

    def block(b: Column, i: Column, sums: Column) -> Column:
        first = F.when(i == 0, b[0]).otherwise(step(total(F.slice(sums, 1, F.greatest(i, F.lit(1)))), b[0]))
        return F.aggregate(F.slice(b, 2, F.size(b)), F.array(first), lambda acc, x: F.array_append(acc, step(F.element_at(acc, -1), x)))

    def of(blocks: Column) -> Column:
        return let(F.transform(blocks, lambda b: total(b)), lambda sums: F.flatten(F.transform(blocks, lambda b, i: block(b, i, sums))))

    return let(values, lambda v: let(cut(v), of))


def with_spans(df: DataFrame, name: str, text: str, pattern: str, valid: Callable[[Column], Column] | None = None, where: Column | None = None) -> DataFrame:
    """Adds `name`: the leftmost non-overlapping matches that are valid, places in code points, end exclusive.

    The text is cut at the matches, so a match ends where the lengths of all gaps and matches up to it
    add up.  `where` says which rows may match at all.
    """
    m, g = f"__{name}_m", f"__{name}_g"
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    if where is not None:
        found = F.when(where, found).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(m, found).withColumn(g, F.when(F.size(m) > 0, F.split(F.col(text), pattern, -1)))
    steps = F.zip_with(F.slice(F.col(g), 1, F.size(m)), F.col(m), lambda a, b: F.length(a) + F.length(b))
    df = df.withColumn(g, F.when(F.size(m) > 0, running(steps, lambda a, b: a + b)))
    out = F.zip_with(F.col(m), F.col(g), lambda v, e: F.struct((e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")))
    if valid is not None:
        out = F.filter(out, lambda s: valid(s["value"]))
    return df.withColumn(name, F.when(F.size(m) > 0, out).otherwise(F.array().cast(SPAN))).drop(m, g)


def labelled(kind: str, spans: Column) -> Column:
    """kind:start:end of each span."""
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"], F.lit(":"), s["end"]))


def replaced(text: Column, spans: Column) -> Column:
    """The text with each span (start, end, put) replaced; where spans overlap the first one stands for all of them."""

    def whole(order: Column, ends: Column) -> Column:
        pieces = F.transform(order, lambda s, i: F.when(s["start"] >= ends[i], F.concat(F.substring(text, ends[i] + 1, s["start"] - ends[i]), s["put"])).otherwise(""))
        return F.concat(F.array_join(pieces, ""), F.substring(text, F.element_at(ends, -1) + 1, F.length(text)))

    def ended(order: Column) -> Column:
        tops = running(F.transform(order, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        return let(F.concat(F.array(F.lit(0)), tops), lambda ends: whole(order, ends))

    done = let(F.array_sort(spans), ended)
    return F.when(F.size(spans) > 0, done).otherwise(text)
