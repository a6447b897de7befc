"""Metadata that a page states for machines: JSON-LD blocks and microdata, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wirelake.functions.html import attribute

BLOCK = r"""(?is)<script\b[^>]*\stype\s*=\s*["']?application/ld\+json\b[^>]*>(.*?)</script\s*>"""
# An element with that item name; its own name is the first group.
ITEM = r"""(?is)<([a-z][a-z0-9]*)\b[^>]*\sitemprop\s*=\s*["']?{name}(?=["'\s/>])[^>]*>"""


def linked_nodes(html: Column) -> Column:
    """The objects of all JSON-LD blocks of a page in page order: a block is an object, a list of objects, or an object with
    a `@graph` of them. A block that is not JSON has none; a page without blocks, or a null page, gives null."""
    def nodes(block: Column) -> Column:
        value = F.try_parse_json(block)
        return F.coalesce(
            F.try_variant_get(value, "$['@graph']", "array<variant>"), F.try_variant_get(value, "$", "array<variant>"),
            F.when(value.isNotNull(), F.array(value)), F.array().cast("array<variant>"))

    blocks = F.regexp_extract_all(html, F.lit(BLOCK), F.lit(1))
    return F.when(F.contains(html, F.lit("ld+json")), F.flatten(F.transform(blocks, nodes)))


def linked_value(nodes: Column, name: str) -> Column:
    """The first text of that name among the nodes; a list of texts is joined by ", "."""
    def value(node: Column) -> Column:
        many = F.array_join(F.try_variant_get(node, f"$.{name}", "array<string>"), ", ")
        return F.nullif(F.trim(F.coalesce(many, F.try_variant_get(node, f"$.{name}", "string"))), F.lit(""))

    found = F.filter(F.transform(nodes, value), lambda v: v.isNotNull())
    return F.get(found, F.lit(0))


def item_markup(body: Column, name: str) -> Column:
    """Markup of the first microdata item of that name: its `content` or `datetime`, else what stands before the next end tag
    of its kind; null for none."""
    item = ITEM.format(name=name)
    start = F.regexp_extract(body, item, 0)
    inside = F.nullif(F.regexp_extract(body, rf"{item}(.*?)</\1\s*>", 2), F.lit(""))
    return F.when(F.contains(body, F.lit("itemprop")), F.coalesce(attribute(start, "content"), attribute(start, "datetime"), inside))
