"""Links of HTML pages, of sections and of table cells, however elements are nested."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navspark.functions import markup as M
from navspark.functions.text import strip

NO_TITLE = "No Title"
_ROW_PARTS = ["tr", "thead", "tbody", "tfoot"]
#: Elements whose end tag may be left out: what they stand in, and the tags that end them there.
_ENDED_BY = {
    "td": (["table"], ["td", "th", *_ROW_PARTS]),
    "th": (["table"], ["td", "th", *_ROW_PARTS]),
    "tr": (["table"], _ROW_PARTS),
    "li": (["ul", "ol", "menu"], ["li"]),
    "dt": (["dl"], ["dt", "dd"]),
    "dd": (["dl"], ["dt", "dd"]),
    "option": (["select"], ["option", "optgroup"]),
}


def _link(rows: DataFrame, tag: Column, *kept: str) -> DataFrame:
    title = strip(F.coalesce(M.attribute(tag, "title"), F.lit(NO_TITLE)))
    out = rows.select(*kept, title.alias("title"), strip(M.attribute(tag, "href")).alias("href"))
    return out.where("title != '' AND href != ''")


def page_links(pages: DataFrame, key: str, html: Column) -> DataFrame:
    """(key, pos, title, href) of every anchor with a link, both stripped and non-empty."""
    cut = F.filter(M.pieces(M.visible(html), ["a"], []), lambda p: M.attribute(p, "href").isNotNull())
    linked = pages.select(key, F.transform(cut, M.tag).alias("nv_tags")).select(key, F.posexplode_outer("nv_tags").alias("pos", "nv_tag"))
    return _link(linked.where("pos IS NOT NULL"), F.col("nv_tag"), key, "pos")


def page_first_link(pages: DataFrame, key: str, html: Column) -> DataFrame:
    """(key, href) of the first anchor with a link; pages without one are left out."""
    cut = F.filter(M.pieces(M.visible(html), ["a"], []), lambda p: M.attribute(p, "href").isNotNull())
    first = pages.select(key, F.get(cut, F.lit(0)).alias("nv_tag")).where("nv_tag IS NOT NULL")
    return first.select(key, M.attribute(F.col("nv_tag"), "href").alias("href"))


def _tokens(pages: DataFrame, key: str, html: Column, opened: list[str], closed: list[str]) -> DataFrame:
    """(key, nv_page, nv_pos, nv_tag, nv_name) of the tags of some names, in order."""
    cut = F.filter(M.pieces(M.visible(html), opened, closed), lambda p: p.startswith("<"))
    tags = M.pages_with_ids(pages).select(key, "nv_page", F.transform(cut, M.tag).alias("nv_tags"))
    rows = tags.select(key, "nv_page", F.posexplode_outer("nv_tags").alias("nv_pos", "nv_tag")).where("nv_pos IS NOT NULL")
    return rows.withColumn("nv_name", M.tag_name(F.col("nv_tag")))


def _any_end(name: Column, tags: list[str]) -> Column:
    return name.isin([*tags, *(f"/{t}" for t in tags)])


def _step(name: Column, tags: list[str]) -> Column:
    return F.when(name.isin(tags), 1).when(name.isin([f"/{t}" for t in tags]), -1).otherwise(0)


def _inside(tokens: DataFrame, starts: Column, ended_by: list[str]) -> DataFrame:
    """The tokens (with nv_depth) inside the first element of each page that ``starts`` marks."""
    page = Window.partitionBy("nv_page")
    begun = tokens.withColumn("nv_start", F.min(F.when(starts, F.col("nv_pos"))).over(page)).where("nv_pos >= nv_start")
    depth = begun.withColumn("nv_d0", F.max(F.when(F.col("nv_pos") == F.col("nv_start"), F.col("nv_depth"))).over(page))
    ends = (F.col("nv_depth") < F.col("nv_d0")) | ((F.col("nv_depth") == F.col("nv_d0")) & _any_end(F.col("nv_name"), ended_by))
    end = F.min(F.when((F.col("nv_pos") > F.col("nv_start")) & ends, F.col("nv_pos"))).over(page)
    return depth.withColumn("nv_end", end).where("nv_end IS NULL OR nv_pos < nv_end").drop("nv_end")


def _section(pages: DataFrame, key: str, html: Column, tag: str, section_id: str, within: str | None = None) -> DataFrame:
    """(key, nv_page, nv_pos, nv_tag) of the anchors with a link in the first element ``tag`` with the id, in order; of those inside ``within``, if it is given."""
    holders, ended_by = _ENDED_BY.get(tag, ([tag], []))
    names = sorted({*holders, *ended_by, tag, *([within] if within else [])})
    tokens = M.with_depth(_tokens(pages, key, html, [*names, "a"], names), _step(F.col("nv_name"), holders))
    starts = (F.col("nv_name") == tag) & (M.attribute(F.col("nv_tag"), "id") == section_id)
    inside = _inside(tokens, starts, ended_by)
    if within:
        inside = M.with_depth(inside, _step(F.col("nv_name"), [within]), "nv_within").where("nv_within > 0")
    return inside.where((F.col("nv_name") == "a") & M.attribute(F.col("nv_tag"), "href").isNotNull())


def section_links(pages: DataFrame, key: str, html: Column, tag: str, section_id: str) -> DataFrame:
    """(key, pos, title, href) of every anchor with a link in the section, both stripped and non-empty.

    The section is the first element ``tag`` with the id, up to its own end,
    whatever elements of the same kind it holds; where its end tag may be left
    out, up to where HTML ends it.
    """
    found = _section(pages, key, html, tag, section_id)
    number = F.row_number().over(Window.partitionBy("nv_page").orderBy("nv_pos")) - 1
    return _link(found.withColumn("pos", number), F.col("nv_tag"), key, "pos")


def section_first_link(pages: DataFrame, key: str, html: Column, tag: str, section_id: str, within: str | None = None) -> DataFrame:
    """(key, href) of the first anchor with a link in the section (inside ``within``, a tag); pages without one are left out."""
    found = _section(pages, key, html, tag, section_id, within)
    first = found.groupBy("nv_page", key).agg(F.min_by("nv_tag", "nv_pos").alias("nv_tag"))
    return first.select(key, M.attribute(F.col("nv_tag"), "href").alias("href"))


def cell_first_links(pages: DataFrame, key: str, html: Column, table_class: str, cell_class: str) -> DataFrame:
    """(key, cell, href) of the first anchor with a link in each cell of the class, in the first table of the class; cells count from 0.

    Cells of tables inside cells count too, and an anchor in one belongs to the
    cells around it as well. Each level of tables has its own run of events: a
    cell begins, or whatever stands there ends.
    """
    parts = ["td", "th", *_ROW_PARTS]
    name, tag, depth = F.col("nv_name"), F.col("nv_tag"), F.col("nv_depth")
    tokens = M.with_depth(_tokens(pages, key, html, ["table", *parts, "a"], ["table", *parts]), _step(name, ["table"]))
    inside = _inside(tokens, (name == "table") & M.has_class(tag, table_class), [])
    wanted = (name == "td") & M.has_class(tag, cell_class)
    counted = inside.withColumn("cell", F.when(wanted, F.sum(wanted.cast("int")).over(M.so_far()) - 1))
    linked = (name == "a") & M.attribute(tag, "href").isNotNull()
    levels = F.when(name == "a", F.sequence(F.col("nv_d0"), depth)).when(name == "/table", F.array(depth + 1)).otherwise(F.array(depth))
    events = counted.where((name != "a") | linked).withColumn("nv_level", F.explode(levels))
    level = Window.partitionBy("nv_page", "nv_level").orderBy("nv_pos").rowsBetween(Window.unboundedPreceding, 0)
    open_cell = F.last(F.when(name != "a", F.coalesce("cell", F.lit(-1))), ignorenulls=True).over(level)
    placed = events.withColumn("nv_cell", open_cell).where((name == "a") & (F.col("nv_cell") >= 0))
    first = placed.groupBy("nv_page", key, F.col("nv_cell").alias("cell")).agg(F.min_by("nv_tag", "nv_pos").alias("nv_tag"))
    return first.select(key, F.col("cell").cast("int").alias("cell"), M.attribute(F.col("nv_tag"), "href").alias("href"))
