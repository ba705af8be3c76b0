"""Chat records of many layouts as formatted conversations with a loss mask.

A record is a JSON text. Its fingerprint is a hash of the nested paths of its
fields (a list adds ``[]``), of those that any layout reads; other fields, in
whatever number, change nothing. The fingerprint selects a declared layout,
which says where turns stand: in single fields with a role each, in a list of
items with a role and a text, or in both. The layout's fields are read by one
built-in expression, so a new layout is a declaration and no code. Each record
becomes canonical turns (role, text).

A template writes a turn as ``open role head text close``. Control strings
inside roles and texts are escaped: a backslash is doubled, and one is put
behind the first character of each control string (overlapping ones too), so no
control string is left and the text can be read back. The loss mask is a list of
spans of code points that cover the texts of the learned role and nothing else.

Defined results: a null record, text that is no JSON object, and a record whose
fingerprint no layout has (so also one that fits two layouts at once) have null
turns and the reject_reason ``not_an_object`` or ``unknown_layout``. A null text
or role is empty; an optional field that is absent or null gives no turn, nor
does a null item of a list. An empty list has no turns. Roles that a layout does
not name stay as they are. Columns of the input named like the new ones are
replaced. Each record is judged by itself, so rows that repeat, ties and hot
keys need nothing, and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spark's JSON reader takes no strings above 20 million characters unless told to.
JSON_OPTIONS = {"maxStringLen": str((1 << 31) - 1), "maxNestingDepth": "1000000"}
TURN = "struct<role: string, text: string>"
_EMPTY = "[] empty"


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    ``fields`` are (role, paths) in order: the texts at the paths, the empty ones
    but the first left out, are joined by an empty line. ``listed`` is (path of a
    list, its items' role field, their text field); the list follows the fields.
    ``optional`` paths may be absent. ``roles`` are other names of roles.
    """

    name: str
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    listed: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        own = [p for _, paths in self.fields for p in paths]
        return own if self.listed is None else [*own, *(f"{self.listed[0]}[].{f}" for f in self.listed[1:])]

    def fingerprints(self) -> list[int]:
        """Of records with each choice of the optional paths, and with an empty list."""
        must = [p for p in self.paths() if p not in self.optional]
        forms = [must] if self.listed is None else [must, [*(p for p in must if not p.startswith(f"{self.listed[0]}[]")), self.listed[0] + _EMPTY]]
        choices = [c for n in range(len(self.optional) + 1) for c in itertools.combinations(self.optional, n)]
        return [path_hash({*form, *chosen}) for form in forms for chosen in choices]

    def schema(self) -> str:
        """What is read of a record, as DDL."""
        tree: dict = {}
        for path in [*(p for _, paths in self.fields for p in paths), *([self.listed[0]] if self.listed else [])]:
            at = tree
            *outer, last = path.split(".")
            for step in outer:
                at = at.setdefault(step, {})
            at[last] = "string"
            if self.listed and path == self.listed[0]:
                at[last] = f"array<struct<`{self.listed[1]}`: string, `{self.listed[2]}`: string>>"
        kind = lambda x: x if isinstance(x, str) else "struct<" + ", ".join(f"`{k}`: {kind(v)}" for k, v in x.items()) + ">"
        return kind(tree)

    def turns(self, read: Column) -> Column:
        """Turns of what was read with ``schema``."""
        at = lambda path: _step(read, path)
        named = F.create_map(*[F.lit(x) for pair in self.roles for x in pair]) if self.roles else None
        turn = lambda role, text: F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
        parts = []
        for role, (first, *rest) in self.fields:
            more = F.filter(F.array(*[at(p) for p in rest]), lambda t: t.isNotNull() & (t != "")) if rest else F.array().cast("array<string>")
            own = F.array(turn(F.lit(role), F.array_join(F.concat(F.array(F.coalesce(at(first), F.lit(""))), more), "\n\n")))
            none = F.array().cast(f"array<{TURN}>")
            parts.append(F.when(at(first).isNull(), none).otherwise(own) if first in self.optional else own)
        if self.listed:
            path, role, text = self.listed
            known = lambda r: r if named is None else F.coalesce(F.try_element_at(named, r), r)
            items = F.filter(F.coalesce(at(path), F.array().cast(f"array<struct<`{role}`: string, `{text}`: string>>")), lambda i: i.isNotNull())
            parts.append(F.transform(items, lambda i: turn(known(i[role]), i[text])))
        return F.concat(*parts)


def _step(read: Column, path: str) -> Column:
    for step in path.split("."):
        read = read[step]
    return read


_OTHER_ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
#: The layouts that are known without being declared by the caller.
LAYOUTS = (
    Layout("messages", listed=("messages", "role", "content")),
    Layout("conversations", (("system", ("system",)),), ("conversations", "from", "value"), ("system",), _OTHER_ROLES),
    Layout("prompt", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Layout("completion", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Layout("instruction", (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), optional=("system", "input")),
    Layout("dialogue", listed=("data.dialogue", "speaker", "utterance"), roles=_OTHER_ROLES),
)


def path_hash(paths: set[str]) -> int:
    return int.from_bytes(hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).digest()[:8], "big", signed=True)


def field_paths(value: object, path: str = "") -> Iterator[str]:
    """The paths of a record's fields that hold no other fields."""
    if isinstance(value, dict) and value:
        for key, inner in value.items():
            yield from field_paths(inner, f"{path}.{key}" if path else key)
    elif isinstance(value, list):
        for inner in value:
            yield from field_paths(inner, f"{path}[]")
        if not value:
            yield path + _EMPTY
    else:
        yield path


def fingerprint(layouts: tuple[Layout, ...] = LAYOUTS) -> Callable[[Column], Column]:
    """The function that gives the fingerprint of a JSON record; null for what is no object."""
    known = {p for layout in layouts for p in layout.paths()} | {layout.listed[0] + _EMPTY for layout in layouts if layout.listed}
    stems = tuple(p + end for p in known for end in (".", "["))

    def one(record: str | None) -> int | None:
        try:
            value = json.loads(record or "")
            return path_hash({p for p in field_paths(value) if p in known or p.startswith(stems)}) if isinstance(value, dict) else None
        except (ValueError, RecursionError):
            return None

    @F.arrow_udf("long")
    def run(records: pa.Array) -> pa.Array:
        return pa.array([one(r) for r in records.to_pylist()], pa.int64())

    return run


def canonical_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with layout, turns (of role and text) and reject_reason."""
    by_hash: dict[int, Layout] = {}
    for layout in layouts:
        for h in layout.fingerprints():
            if by_hash.setdefault(h, layout) is not layout:
                raise ValueError(f"the layouts {by_hash[h].name!r} and {layout.name!r} have the same paths")
    marked = records.withColumn("nv_fingerprint", fingerprint(layouts)(F.col(record)))
    hits = [F.col("nv_fingerprint").isin(layout.fingerprints()) for layout in layouts]
    read = marked.withColumns({f"nv_read_{k}": F.when(hit, F.from_json(F.col(record), layout.schema(), JSON_OPTIONS)) for k, (hit, layout) in enumerate(zip(hits, layouts, strict=True))})
    name, turns = F.when(F.lit(False), ""), F.when(F.lit(False), F.array().cast(f"array<{TURN}>"))
    for k, (hit, layout) in enumerate(zip(hits, layouts, strict=True)):
        name, turns = name.when(hit, layout.name), turns.when(hit, layout.turns(F.col(f"nv_read_{k}")))
    reason = F.when(F.col("nv_fingerprint").isNull(), "not_an_object").when(name.isNull(), "unknown_layout")
    return read.withColumns({"layout": name, "turns": turns, "reject_reason": reason}).drop("nv_fingerprint", *[f"nv_read_{k}" for k in range(len(layouts))])


@dataclass(frozen=True)
class Template:
    """A turn is ``open role head text close``; what is learned is the text of the role ``learned``."""

    open: str = "<s>[INST]"
    head: str = "[/INST]"
    close: str = "</s>"
    # Control strings of public chat templates.
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    learned: str = "assistant"

    def __post_init__(self):
        for marker in (self.head, self.close):
            if marker not in self.controls or any(marker.startswith(marker[k:]) for k in range(1, len(marker))):
                raise ValueError(f"{marker!r} must be a control string that no end of it begins")
        if any(len(c) < 2 or "\\" in c for c in (self.open, *self.controls)):
            raise ValueError("control strings have two characters or more, none of them a backslash")

    def escape(self, text: Column) -> Column:
        first: dict[str, list[str]] = {}
        for c in self.controls:
            first.setdefault(c[0], []).append(re.escape(c[1:]))
        found = "|".join(f"{re.escape(k)}(?={'|'.join(rest)})" for k, rest in first.items())
        doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return F.regexp_replace(doubled, f"({found})", "$1\\\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_turns(rows: DataFrame, template: Template = Template(), turns: str = "turns") -> DataFrame:
    """``rows`` with formatted and loss_spans (start, end in code points, end exclusive); null turns have neither."""
    pieces = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(template.open), template.escape(t["role"]), F.lit(template.head)).alias("head"),
            template.escape(t["text"]).alias("body"),
            (t["role"] == template.learned).alias("learned"),
        ),
    )
    rows = rows.withColumn("nv_pieces", pieces)
    formatted = F.array_join(F.transform("nv_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(template.close))), "")
    span = "struct<start: bigint, end: bigint>"

    def add(done: Column, p: Column) -> Column:
        start = done["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(p["learned"], F.concat(done["spans"], own)).otherwise(done["spans"])
        return F.struct((end + len(template.close)).alias("at"), spans.alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))
    spans = F.aggregate("nv_pieces", zero, add, lambda done: done["spans"])
    return rows.withColumns({"formatted": formatted, "loss_spans": spans}).drop("nv_pieces")


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) that a formatted conversation was made of."""
    parts = F.split(formatted, re.escape(template.close), -1)
    whole = F.slice(parts, 1, F.size(parts) - 1)
    halves = F.transform(whole, lambda p: F.split(F.substr(p, F.lit(len(template.open) + 1)), re.escape(template.head), 2))
    return F.transform(halves, lambda h: F.struct(template.unescape(h[0]).alias("role"), template.unescape(h[1]).alias("text")))


def loss_texts(formatted: Column, spans: Column, template: Template = Template()) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(spans, lambda s: template.unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def format_records(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS, template: Template = Template()) -> DataFrame:
    """``records`` with layout, turns, reject_reason, formatted and loss_spans."""
    return format_turns(canonical_turns(records, record, layouts), template)
