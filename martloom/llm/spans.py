"""Positions of regular-expression matches, with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int>"
# Running sums go over blocks of so many matches, so that appending to an array
# costs little however many there are.
_BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(lengths: Column, first: Column) -> Column:
    """Where each piece starts, if the pieces follow each other from ``first`` on."""
    state = F.struct(first.alias("at"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(
        lengths,
        state,
        lambda s, n: F.struct(
            (s["at"] + n).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")
        ),
        lambda s: s["starts"],
    )


def match_spans(text: Column, pattern: str | Column, group: int = 0, at_least: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches, as an array of ``SPAN`` in code points.

    Matches whose ``group`` has fewer than ``at_least`` characters are dropped
    after matching, so they still use up their text. NULL text has no spans.
    """
    text, regex = F.coalesce(text, F.lit("")), F.lit(pattern)

    def sizes(matches: Column) -> Column:
        """Of each match: characters before it, in it, and in its group."""
        groups = F.regexp_extract_all(text, regex, F.lit(group)) if group else matches
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
        own = F.zip_with(matches, groups, lambda m, g: F.struct(F.length(m).alias("whole"), F.length(g).alias("group")))
        return F.zip_with(
            gaps, own, lambda p, m: F.struct(F.length(p).alias("gap"), m["whole"].alias("whole"), m["group"].alias("group"))
        )

    def blocks(sizes: Column) -> Column:
        last = F.floor((F.size(sizes) - 1) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * _BLOCK + 1, F.lit(_BLOCK)))

    def place(block: Column, first: Column) -> Column:
        starts = _running(F.transform(block, lambda x: x["gap"] + x["whole"]), first)
        return F.zip_with(
            block,
            starts,
            lambda x, at: F.struct(
                (at + x["gap"]).alias("start"), (at + x["gap"] + x["whole"]).alias("end"), x["group"].alias("group")
            ),
        )

    def spans(blocks: Column) -> Column:
        total = lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + x["whole"])
        placed = F.flatten(F.zip_with(blocks, _running(F.transform(blocks, total), F.lit(0)), place))
        kept = F.filter(placed, lambda x: x["group"] >= at_least) if at_least else placed
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    none = F.array().cast(f"array<{SPAN}>")
    found = lambda matches: let(sizes(matches), lambda s: let(blocks(s), spans))
    return let(
        F.regexp_extract_all(text, regex, F.lit(0)), lambda m: F.when(F.size(m) == 0, none).otherwise(found(m))
    )


def merged(spans: Column) -> Column:
    """Sorted spans with those that overlap or touch made one."""
    none = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"))
    state = F.struct(none.alias("open"), F.array().cast(f"array<{SPAN}>").alias("done"))
    joins = lambda s, x: x["start"] <= s["open"]["end"]
    grown = lambda s, x: F.struct(s["open"]["start"].alias("start"), F.greatest(s["open"]["end"], x["end"]).alias("end"))
    return F.aggregate(
        F.array_sort(spans),
        state,
        lambda s, x: F.struct(
            F.when(joins(s, x), grown(s, x)).otherwise(F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("open"),
            F.when(joins(s, x) | (s["open"]["start"] < 0), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))).alias("done"),
        ),
        lambda s: F.when(s["open"]["start"] < 0, s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))),
    )


def replaced(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with each of the merged ``spans`` replaced by ``mask``."""
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at(spans, i)["end"])
    kept = F.transform(
        spans, lambda x, i: F.concat(F.substring(text, before(i) + 1, x["start"] - before(i)), F.lit(mask))
    )
    rest = F.substring(text, F.element_at(spans, -1)["end"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(kept, ""), rest)).otherwise(text)
