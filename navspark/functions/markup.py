"""Tags, attributes and character references of HTML, as built-in expressions.

A page is cut before each tag of some names; a piece is the tag and what follows
it. Operators give the pieces a running depth, so that elements may nest, and end
those whose end tag is left out where HTML ends them.
"""

from __future__ import annotations

import html
import json
import re

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_QUOTE = r"\x22[^\x22]*+\x22|\x27[^\x27]*+\x27"
_TAG = rf"(?s)^</?[A-Za-z][A-Za-z0-9]*(?:[^>\x22\x27]++|{_QUOTE})*+>?"

#: Names of references that need no semicolon, and the text of those with one, as the standard library has them.
_BARE = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
_NAMED = json.dumps({n.removesuffix(";"): t for n, t in html.entities.html5.items() if n.endswith(";")})
_REFERENCE = rf"&(?:#[0-9]{{1,9}};?|#[xX][0-9A-Fa-f]{{1,8}};?|[A-Za-z][A-Za-z0-9]*;|(?:{'|'.join(_BARE)}))"
#: References to the control characters from 128 on stand for the Windows characters of these numbers.
_WINDOWS = [(chr(b), bytes([b]).decode("cp1252")) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]


def _decoded(reference: Column) -> Column:
    """The text of one reference; a name that nobody knows stays as it is."""
    body = F.rtrim(F.substr(reference, F.lit(2)), F.lit(";"))
    digits = F.regexp_extract(body, r"^#[xX]?([0-9A-Fa-f]+)$", 1)
    number = F.when(body.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
    good = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(good, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    windows = F.translate(char, "".join(a for a, _ in _WINDOWS), "".join(b for _, b in _WINDOWS))
    names = F.from_json(F.lit(_NAMED), "map<string,string>")
    return F.when(body.startswith("#"), windows).otherwise(F.coalesce(F.try_element_at(names, body), reference))


def decode_references(c: Column) -> Column:
    """Text with its numeric and named character references decoded, each of them once."""
    found = F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))
    between = F.split(c, _REFERENCE, -1)
    whole = F.array_join(F.zip_with(between, found, lambda t, r: F.concat(t, F.when(r.isNull(), "").otherwise(_decoded(r)))), "")
    return F.when(c.contains("&"), whole).otherwise(c)


def visible(page: Column) -> Column:
    """The page without comments, scripts and styles; one that does not end takes the rest."""
    hidden = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)"
    return F.when(page.rlike(r"(?i)<!--|<(?:script|style)\b"), F.regexp_replace(page, hidden, "")).otherwise(page)


def pieces(page: Column, opened: list[str], closed: list[str]) -> Column:
    """A page, cut before each start tag of ``opened`` and each end tag of ``closed``."""
    ends = [rf"</(?:{'|'.join(closed)})[\s/>]"] if closed else []
    return F.split(page, "(?i)(?=" + "|".join([rf"<(?:{'|'.join(opened)})[\s/>]", *ends]) + ")", -1)


def tag_name(piece: Column) -> Column:
    """Lower-case name of a piece's tag, an end tag's with its slash; empty if the piece begins with none."""
    return F.lower(F.regexp_extract(piece, r"^<(/?[A-Za-z][A-Za-z0-9]*)", 1))


def tag(piece: Column) -> Column:
    return F.regexp_extract(piece, _TAG, 0)


def after_tag(piece: Column) -> Column:
    return F.substr(piece, F.length(tag(piece)) + 1)


def without_tags(c: Column) -> Column:
    return F.when(c.contains("<"), F.regexp_replace(c, r"(?s)</?[A-Za-z!](?:[^>\x22\x27]++|\x22[^\x22]*+\x22|\x27[^\x27]*+\x27)*+>", "")).otherwise(c)


def attribute(piece: Column, name: str) -> Column:
    """Value of an attribute of the piece's tag, quoted or not; empty if it has no value, null if there is no such attribute."""
    value = rf"(?:\s*=\s*(?:{_QUOTE}|[^\s\x22\x27>]*+))?+"
    others = rf"(?:[\s/]+(?!{re.escape(name)}[\s=/>])[^\s=>/\x22\x27]++{value})*+"
    found = rf"(?is)^<[A-Za-z][A-Za-z0-9]*+{others}[\s/]+{re.escape(name)}(?=[\s=/>])(?:\s*=\s*(?:\x22([^\x22]*+)\x22|\x27([^\x27]*+)\x27|([^\s\x22\x27>]*+)))?"
    text = F.concat(*[F.regexp_extract(piece, found, k) for k in (1, 2, 3)])
    return F.when(piece.rlike(found), decode_references(text))


def has_class(piece: Column, name: str) -> Column:
    return F.array_contains(F.split(attribute(piece, "class"), r"\s+"), name)


def pages_with_ids(pages: DataFrame) -> DataFrame:
    """``pages`` with nv_page, a number of each row: rows with equal keys stay apart."""
    return pages.withColumn("nv_page", F.monotonically_increasing_id())


def so_far() -> WindowSpec:
    """The pieces of a page up to and with the current one."""
    return Window.partitionBy("nv_page").orderBy("nv_pos").rowsBetween(Window.unboundedPreceding, 0)


def before() -> WindowSpec:
    return Window.partitionBy("nv_page").orderBy("nv_pos").rowsBetween(Window.unboundedPreceding, -1)


def with_depth(tokens: DataFrame, step: Column, name: str = "nv_depth") -> DataFrame:
    """``tokens`` (nv_page, nv_pos) with the running sum of ``step``; end tags without a start count for nothing."""
    summed = tokens.withColumn("nv_sum", F.sum(step).over(so_far()))
    return summed.withColumn(name, F.col("nv_sum") - F.least(F.lit(0), F.min("nv_sum").over(so_far()))).drop("nv_sum")
