"""Spans of regular expressions in code points, by built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsieve.functions.exprs import let

#: A span: code points, end exclusive. ``token`` is the matched text, ``before`` and ``after`` the text beside it.
SPAN = "array<struct<start:int,end:int,token:string,before:string,after:string>>"
#: Items of a block of ``prefixes``.
BLOCK = 64


def prefixes(items: Column, value: Callable[[Column], Column], plus: Callable[[Column, Column], Column], zero: Column | None = None) -> Column:
    """For each item, ``plus`` folded from ``zero`` (0) over the values of all items before it.

    Folds here carry one number each, since Spark copies a fold's whole state at every step. Blocks are folded first,
    then what comes before each block, then the items of a block up to each of its items.
    """

    def over(list_: Column, start: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(list_, start, lambda acc, x: plus(acc, of(x)))

    zero = F.lit(0) if zero is None else zero
    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    blocks = F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))).otherwise(F.slice(F.array(items), 1, 0))

    def folded(v: Column) -> Column:
        starts = F.transform(v["totals"], lambda _, b: over(F.slice(v["totals"], F.lit(1), b), zero, lambda x: x))
        inner = F.zip_with(v["blocks"], starts, lambda block, start: F.transform(block, lambda _, i: over(F.slice(block, F.lit(1), i), start, value)))
        return F.flatten(inner)

    return let({"blocks": blocks}, lambda v: let({"blocks": v["blocks"], "totals": F.transform(v["blocks"], lambda block: over(block, zero, value))}, folded))


def regex_spans(text: Column, pattern: str, context: int = 0) -> Column:
    """All leftmost non-overlapping matches of ``pattern``, with up to ``context`` code points on either side.

    ``split`` and ``regexp_extract_all`` walk the same matches, so the lengths of what lies between the matches
    and of the matches themselves add up to positions. Texts without a match do no more than one search.
    """

    def parted(v: Column) -> Column:
        ahead = F.zip_with(F.slice(v["gaps"], F.lit(1), F.size(v["found"])), v["found"], lambda gap, token: F.struct(F.length(gap).alias("gap"), F.length(token).alias("size"), token.alias("token"), F.right(gap, F.lit(context)).alias("before")))
        return F.zip_with(ahead, F.slice(v["gaps"], F.lit(2), F.size(v["found"])), lambda part, after: F.struct(part["gap"].alias("gap"), part["size"].alias("size"), part["token"].alias("token"), part["before"].alias("before"), F.substring(after, 1, context).alias("after")))

    def placed(v: Column) -> Column:
        offsets = prefixes(v["parts"], lambda p: p["gap"] + p["size"], lambda a, b: a + b)
        return F.zip_with(
            v["parts"],
            offsets,
            lambda p, at: F.struct((at + p["gap"]).alias("start"), (at + p["gap"] + p["size"]).alias("end"), p["token"].alias("token"), p["before"].alias("before"), p["after"].alias("after")),
        )

    parts = let({"gaps": F.split(text, pattern, -1), "found": F.regexp_extract_all(text, F.lit(pattern), F.lit(0))}, parted)
    return F.when(text.rlike(pattern), let({"parts": parts}, placed)).otherwise(F.array().cast(SPAN))


def kinded(spans: Column, kind: str | None, rank: int) -> Column:
    """Spans as (start, rank, end, kind, token), which sorts by start and then by the order of the kinds."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), (F.lit(kind) if kind else s["kind"]).alias("kind"), s["token"].alias("token")))


def joined(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
