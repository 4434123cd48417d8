"""JSON feed parsing with ``from_json``, all-or-nothing per feed.

A feed is ``{"data": {"children": [{"data": {"title": .., "selftext": ..}}, ..]}}``.
Rules for one child field (title or selftext):

* string                -> the value
* number / boolean      -> its text
* JSON null             -> NULL (the post is kept and later dropped by the filter)
* missing               -> the whole feed is rejected
* object / array        -> the whole feed is rejected

A feed whose content is not JSON, or has no ``data.children`` array, is
rejected too. Rejected feeds yield no posts but were still downloaded. A key
given twice counts once, with its last value; text after the JSON is ignored.

The content is parsed once. A field is read as a VARIANT, which keeps its kind:
a missing field is a NULL, a JSON null is a null VARIANT, a string that begins
with a bracket is still a string. A number with a fraction or an exponent is
written as a double, a whole number by its digits (up to 38; longer ones are
doubles). One field holds up to 128 MiB, a feed any number of them. Every
expression here is a built-in (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: No limit of the parser's own on strings (the JVM's is the only one left).
UNLIMITED = {"maxStringLen": str(2**31 - 1)}


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


FIELDS = "struct<title:variant,selftext:variant>"


def _kind(field: Column) -> Column:
    return F.schema_of_variant(field)


def field_ok(field: Column) -> Column:
    """The field is there and is a scalar or JSON null."""
    return F.coalesce(~_kind(field).startswith("OBJECT") & ~_kind(field).startswith("ARRAY"), F.lit(False))


def field_text(field: Column) -> Column:
    """A scalar's text; NULL for JSON null. A DECIMAL that is a bigint too was written with a
    fraction, as a whole number of that size is a BIGINT."""
    fraction = _kind(field).startswith("DECIMAL") & (~_kind(field).endswith(",0)") | F.try_variant_get(field, "$", "bigint").isNotNull())
    return F.when(fraction, F.try_variant_get(field, "$", "double").cast("string")).otherwise(F.try_variant_get(field, "$", "string"))


def plain(text: Column) -> Column:
    """Surely a JSON scalar: not NULL and no text of an object or array."""
    return F.coalesce(~text.startswith("{") & ~text.startswith("["), F.lit(False))


def feed_children(content: Column | str) -> Column:
    """The feed's children, ``array<struct<data:struct<title,selftext>>>`` of VARIANT fields;
    NULL when unparsable or absent."""
    schema = f"data struct<children:array<struct<data:{FIELDS}>>>"
    return F.from_json(_c(content), schema, UNLIMITED)["data"]["children"]


def children_ok(children: Column | str) -> Column:
    """True when there is a children array and every child has valid fields."""
    valid = F.forall(_c(children), lambda c: field_ok(c["data"]["title"]) & field_ok(c["data"]["selftext"]))
    return F.coalesce(valid, F.lit(False))


def children_posts(children: Column | str) -> Column:
    """``array<struct<title, selftext>>`` extracted from each child."""
    return F.transform(_c(children), lambda c: post_text(c["data"]))


def post_text(post: Column) -> Column:
    """``struct<title, selftext>`` of strings."""
    return F.struct(*(field_text(post[name]).alias(name) for name in ("title", "selftext")))


def read_post(text: Column | str) -> Column:
    """One post object's fields as VARIANTs (``post_ok``, ``post_text``)."""
    return F.from_json(_c(text), "title variant, selftext variant", UNLIMITED)


def post_ok(post: Column) -> Column:
    """The same rules as for a feed's child."""
    return field_ok(post["title"]) & field_ok(post["selftext"])
