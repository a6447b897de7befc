"""Elements of a page found by the depth of their tags, as native column expressions.

A page is cut at the tags of the elements in question. A running sum over these tags, one up for a start tag and one down for
an end tag, is the depth of each part, so an element ends where its own depth closes, whatever lies inside it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _tag(names: list[str]) -> str:
    return rf"(?i)</?(?:{'|'.join(names)})\b[^>]*>"


def _step(tag: Column) -> Column:
    return F.when(F.startswith(tag, F.lit("</")), F.lit(-1)).otherwise(F.lit(1))


def first_element(body: Column, name: str) -> Column:
    """Markup inside the first element of that name, to the end tag that closes it; null where there is none.

    Elements of the same name may lie inside; their own tags are left out. An element that is never closed ends with the page.
    """
    tag = _tag([name])

    def walk(at: Column, found: Column) -> Column:
        step = _step(found)
        depth = F.greatest(at["depth"] + step, F.lit(0))
        begin = F.when(at["begin"] > 0, at["begin"]).otherwise(F.when(step > 0, at["place"] + 1).otherwise(F.lit(0)))
        end = F.when(at["end"] > 0, at["end"]).otherwise(F.when((begin > 0) & (depth == 0), at["place"] + 1).otherwise(F.lit(0)))
        return F.struct((at["place"] + 1).alias("place"), depth.alias("depth"), begin.alias("begin"), end.alias("end"))

    def inside(at: Column) -> Column:
        parts = F.split(body, tag)
        size = F.when(at["end"] > 0, at["end"]).otherwise(F.size(parts)) - at["begin"]
        return F.when(at["begin"] > 0, F.array_join(F.slice(parts, at["begin"] + 1, size), " "))

    start = F.struct(*[F.lit(0).alias(c) for c in ("place", "depth", "begin", "end")])
    return F.aggregate(F.regexp_extract_all(body, F.lit(tag), F.lit(0)), start, walk, inside)


def _running(values: Column, start: Column, step) -> Column:
    """`start` and what `step(last, value)` makes of it, value by value."""
    return F.aggregate(values, F.array(start), lambda done, v: F.concat(done, F.array(step(F.element_at(done, -1), v))))


def outside(body: Column, names: list[str], mark: str) -> Column:
    """The page without the elements of these names; each tag of theirs leaves a `mark`.

    A part is dropped if the depth falls below its own later on, so a start tag that is never closed hides nothing, and an
    end tag too many changes nothing. The lists are of these few tags, not of all tags of the page.
    """
    tag = _tag(names)

    def kept(parts: Column, tags: Column) -> Column:
        depth = _running(tags, F.lit(0), lambda last, t: F.greatest(last + _step(t), F.lit(0)))
        back = F.reverse(depth)
        least = F.reverse(_running(F.slice(back, F.lit(2), F.size(tags)), F.element_at(back, 1), lambda last, d: F.least(last, d)))
        rows = F.arrays_zip(parts.alias("part"), depth.alias("depth"), least.alias("least"))
        return F.array_join(F.transform(F.filter(rows, lambda r: r["depth"] <= r["least"]), lambda r: r["part"]), mark)

    tags = F.regexp_extract_all(body, F.lit(tag), F.lit(0))
    return F.get(F.transform(F.array(tags), lambda t: F.when(F.size(t) == 0, body).otherwise(kept(F.split(body, tag), t))), F.lit(0))
