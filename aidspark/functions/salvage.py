"""Salvage of malformed records (S15): markup that a strict parser refuses is
closed or dropped, so that a record keeps every field that can be read.

The record's text is cut into tokens (tags, text, comments) and the tags are
folded over a stack of open elements. What the fold finds are edits of single
tokens, a few for each break; all other tokens stay as they are. The schema says
which element each tag belongs to, so

* a tag that opens closes what stands open inside its parent: an element that
  was never closed ends before the next one;
* a closing tag closes what stands open inside its element; one that closes
  nothing is dropped;
* broken attributes are dropped, a ``<`` that begins no tag becomes text;
* at the end everything open is closed, and what follows the record is cut off.

Everything is built-in expressions on one row; only records that did not parse
come here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

# A comment, a CDATA section, an instruction, a tag, a lone '<', or text.
TOKEN = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|</?[A-Za-z_][^<>]*>|<|[^<]+"
# A tag whose attributes, if any, are well formed.
SOUND_TAG = r"""(?s)^</?[A-Za-z_][\w.\-]*(?:\s+[A-Za-z_][\w.:\-]*\s*=\s*(?:"[^"]*"|'[^']*'))*\s*/?>$"""
_NAME = r"^</?([^\s/<>]+)"
_EDITS = "array<struct<at: int, text: string>>"


def parents(schema: StructType, root: str) -> dict[str, str]:
    """The element that each tag of a parse schema belongs to."""
    out = {}
    for field in schema.fields:
        kind = field.dataType
        while isinstance(kind, ArrayType):
            kind = kind.elementType
        out[field.name] = root
        if isinstance(kind, StructType):
            out.update(parents(kind, field.name))
    return out


def _leaves(known: dict[str, str]) -> list[str]:
    return sorted(set(known) - set(known.values()))


def _closing(stack: Column, keep: Column) -> Column:
    """Closing tags of the open elements behind the first ``keep``, innermost first."""
    inner = F.reverse(F.slice(stack, keep + 1, F.greatest(F.size(stack) - keep, F.lit(0))))
    return F.array_join(F.transform(inner, lambda n: F.concat(F.lit("</"), n, F.lit(">"))), "")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once: a lambda's argument is bound,
    while an expression that is named twice is evaluated twice."""
    return F.transform(F.array(value), use)[0]


def salvage_xml(record: Column, tag: str, schema: StructType) -> Column:
    """The text of a record ``<tag>`` with its markup closed."""
    known = parents(schema, tag)
    parent_of = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    leaves = F.array(*map(F.lit, _leaves(known)))
    found = F.regexp_extract_all(record, F.lit(TOKEN), F.lit(0))

    def item(t, i):
        kind = (F.when(t == "<", "lone").when(t.startswith("</"), "close").when(t.startswith("<!") | t.startswith("<?"), "text")
                .when(~t.startswith("<"), "text").when(t.endswith("/>"), "empty").otherwise("open"))
        return F.struct(i.alias("at"), t.alias("t"), kind.alias("kind"))

    def named(x):
        """A tag's name, its text in sound form, the element it belongs to and whether that has no elements of its own."""
        kind = x["kind"]

        def rest(name):
            sound = F.when(x["t"].rlike(SOUND_TAG), x["t"]).when(kind == "close", F.concat(F.lit("</"), name, F.lit(">"))).otherwise(
                F.concat(F.lit("<"), name, F.when(kind == "empty", "/>").otherwise(">")))
            return F.struct(x["at"].alias("at"), x["t"].alias("t"), name.alias("name"), kind.alias("kind"), sound.alias("sound"),
                            F.try_element_at(parent_of, name).alias("parent"))
        return _let(F.regexp_extract(x["t"], _NAME, 1), rest)

    def place(stack, x, own):
        """How many open elements stay open when ``x`` comes."""
        parent = F.coalesce(F.array_position(stack, x["parent"]), F.lit(0))
        top = F.try_element_at(stack, F.lit(-1))
        opens = _let(parent, lambda p: F.when(p > 0, p).when(own > 0, own - 1)
                     .when(F.coalesce(F.array_contains(leaves, top), F.lit(False)), F.size(stack) - 1).otherwise(F.size(stack)))
        return F.when(x["kind"] == "close", F.when(own > 0, own).otherwise(F.size(stack))).otherwise(opens).cast("int")

    def step(s, x):
        # every part that is named more than once is bound
        return _let(F.array_position(s["stack"], x["name"]), lambda own: _let(
            place(s["stack"], x, own), lambda keep: _after(s, x, keep, own > 0)))

    def _after(s, x, keep, is_open):
        stack, over = s["stack"], (F.size(s["stack"]) == 0) & (x["at"] > 0)
        closing = F.when(F.size(stack) > keep, _closing(stack, keep)).otherwise("")
        text = (F.when(over, "").when(x["kind"] == "lone", "&lt;")
                .when((x["kind"] == "close") & ~is_open, "").otherwise(F.concat(closing, x["sound"])))
        kept = F.slice(stack, F.lit(1), keep)
        after = (F.when(over | (x["kind"] == "lone"), stack)
                 .when(x["kind"] == "open", F.concat(kept, F.array(x["name"])))
                 .when((x["kind"] == "close") & is_open, F.slice(stack, F.lit(1), keep - 1))
                 .when(x["kind"] == "empty", kept).otherwise(stack))
        return _let(F.struct(text.alias("text"), after.alias("after")), lambda n: F.struct(
            n["after"].alias("stack"),
            F.when(n["text"] == x["t"], s["edits"]).otherwise(
                F.concat(s["edits"], F.array(F.struct(x["at"].alias("at"), n["text"].alias("text"))))).alias("edits"),
            F.when((s["end"] < 0) & ~over & (F.size(n["after"]) == 0), x["at"]).otherwise(s["end"]).alias("end")))

    start = F.struct(F.array().cast("array<string>").alias("stack"), F.array().cast(_EDITS).alias("edits"), F.lit(-1).alias("end"))

    def write(tokens, state):
        edited = _let(F.map_from_entries(state["edits"]), lambda edits: F.array_join(F.transform(
            tokens, lambda t, i: F.when((state["end"] >= 0) & (i > state["end"]), "").otherwise(F.coalesce(F.try_element_at(edits, i), t))), ""))
        return F.concat(edited, _closing(state["stack"], F.lit(0)))

    def fold(tokens):
        tags = F.transform(F.filter(F.transform(tokens, item), lambda x: x["kind"] != "text"), named)
        return F.aggregate(tags, start, step, lambda state: write(tokens, state))

    return _let(found, fold)
