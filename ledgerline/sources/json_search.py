"""Search in JSON texts of any shape: what stands under a key, at any depth, in the order it is written.

A text is opened level by level, each level by one explode of what the level before left open, so that
the search is a chain of narrow steps in the JVM. Objects and arrays travel as text, which keeps the
order of their keys; VARIANT tells of each value what it is. What can't hold a hit isn't opened. Texts
that aren't JSON, or that repeat a key within one object, hold nothing; so do null and empty texts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from json import dumps as as_json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What is no bracket: whole strings, and runs of anything else.
_NO_BRACKETS = r'"(?:[^"\\]++|\\.)*+"|[^\[\]{}"]++'
#: What stands before a comma or colon outside strings, from where the last one ended.
_TO_SIGN = r'\G((?:[^",:]++|"(?:[^"\\]++|\\.)*+")*+)([,:])'


def depth(text: Column | str) -> Column:
    """How deep objects and arrays are nested in a JSON text, or in the beginning of one: 0 for a bare value."""
    text = F.col(text) if isinstance(text, str) else text
    signs = F.split(F.regexp_replace(text, _NO_BRACKETS, ""), "")
    step = lambda c: F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.aggregate(signs, start, lambda s, c: F.struct((s["now"] + step(c)).alias("now"),
        F.greatest(s["most"], s["now"] + step(c)).alias("most")), lambda s: s["most"])


def spaced(text: Column) -> Column:
    """A compact JSON text with a blank after each comma and colon outside strings."""
    return F.regexp_replace(text, _TO_SIGN, "$1$2 ")


def _children(kind: Column, text: Column, hit: Callable, markers: list[str], scalars: bool) -> Column:
    """Of an object or array, those values that are hits or may hold some: place, step (.key or [place]),
    kind ({ and [, or scalar), value (compact JSON), is_hit. Strings come bare as text, so a value
    that looks like an object or array is one only if its variant is. Where scalars are no hits and no string
    of the text begins like an object or array, the look is enough, and no variants are made."""

    def read(t: Column, i: Column, key: Column, step: Column, v: Column | None) -> Column:
        is_a = lambda sign, of: t.startswith(sign) & (F.lit(True) if v is None else F.try_variant_get(v, "$", of).isNotNull())
        sort = F.when(is_a("{", "map<string,variant>"), "{").when(is_a("[", "array<variant>"), "[").otherwise("scalar")
        value = t if v is None else F.when(sort != "scalar", t).otherwise(F.coalesce(F.to_json(v), F.lit("null")))
        return F.struct(i.alias("place"), step.alias("step"), sort.alias("kind"), value.alias("value"), key.alias("key"), t.alias("t"))

    def judged(x: Column) -> Column:
        is_hit = x["key"].isNotNull() & (F.lit(scalars) | (x["kind"] != "scalar")) & hit(x["key"], x["value"])
        return F.struct(x["place"], x["step"], x["kind"], x["value"], is_hit.alias("is_hit"))

    def children(fields: Column, places: Column) -> Column:
        both = F.when(kind == "{", fields).when(kind == "[", places)
        some = F.filter(both, lambda x: (F.lit(scalars) & x["key"].isNotNull()) | (x["kind"] != "scalar") & (x["key"].isNotNull() | _may(x["t"], markers)))
        return F.filter(F.transform(some, judged), lambda c: c["is_hit"] | (c["kind"] != "scalar") & _may(c["value"], markers))

    dot, at, no_key = lambda k: F.concat(F.lit("."), k), lambda i: F.concat(F.lit("["), i.cast("string"), F.lit("]")), F.lit(None).cast("string")
    named, typed = F.from_json(text, "map<string,string>"), F.from_json(text, "map<string,variant>")
    items, kinds = F.from_json(text, "array<string>"), F.from_json(text, "array<variant>")
    told = children(
        F.transform(F.arrays_zip(F.map_keys(named).alias("k"), F.map_values(named).alias("t"), F.map_values(typed).alias("v")),
            lambda x, i: read(x["t"], i, x["k"], dot(x["k"]), x["v"])),
        F.transform(F.arrays_zip(items.alias("t"), kinds.alias("v")), lambda x, i: read(x["t"], i, no_key, at(i), x["v"])),
    )
    if scalars:
        return told
    seen = children(F.transform(F.map_entries(named), lambda x, i: read(x["value"], i, x["key"], dot(x["key"]), None)),
        F.transform(items, lambda x, i: read(x, i, no_key, at(i), None)))
    looks = text.contains('"{') | text.contains('"[') | text.contains('"\\u')
    return F.when(looks, told).otherwise(seen)


def _may(text: Column, markers: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(m)) for m in markers])


#: Up to so many levels are opened without a look whether brackets stand inside strings.
FEW_LEVELS = 3


def _levels(texts: DataFrame, text: Column, markers: list[str]) -> int:
    """How deep a marker can stand in any of the texts, at most: the depth of the text before its last marker, or of all
    of it where characters are written by their numbers. Texts that aren't JSON don't count. No more brackets are open
    than stand there, so where a text holds one marker after few brackets, they aren't followed one by one."""
    rows = texts.select(F.lower(text).alias("low"), text.contains("\\u").alias("coded"), text.alias("text"))
    first = F.substring_index("low", markers[0], 1) if len(markers) == 1 else F.lit(None).cast("string")
    rows = rows.select("*", first.alias("first"))
    rows = rows.select("*", (F.length("first") - F.length(F.replace(F.replace("first", F.lit("{"), F.lit("")), F.lit("["), F.lit("")))).alias("brackets"),
        F.contains(F.substring(F.col("low"), F.length("first") + 2, F.length("low")), F.lit(markers[0])).alias("again"))
    ends = [F.length("low") - F.length(F.substring_index("low", m, -1)) for m in markers]
    end = ends[0] if len(ends) == 1 else F.greatest(*ends)
    exact = depth(F.when(F.col("coded"), F.col("low")).otherwise(F.substring(F.col("low"), F.lit(1), end)))
    few = ~F.col("coded") & ~F.col("again") & (F.col("brackets") <= FEW_LEVELS)
    return rows.agg(F.max(F.when(few, F.col("brackets")).when(F.try_parse_json("text").isNotNull(), exact))).first()[0] or 0


def found(texts: DataFrame, hit: Callable[[Column, Column], Column], markers: list[str], inside: bool, json: str = "json", scalars: bool = True) -> DataFrame:
    """The columns of texts but json, and of each hit: path (root.a.b[0].c), at (its places from the root
    on: sorted by it, hits come as written), and value, compact JSON text with keys as written. hit gets
    a key and the compact JSON under it. markers: in lower case, as written in JSON; one of them stands in
    each text that holds a hit, others stay closed. inside: hits are searched, too. scalars: can hits be other
    than objects and arrays? The number of levels is at least that of the deepest marker, which is counted first, so
    none is left out."""
    keep = [F.col(f"`{c}`") for c in texts.columns if c != json]
    text, is_json = F.col(json), F.try_parse_json(json).isNotNull()
    rows = texts.where(_may(text, markers) | text.contains("\\u"))
    levels = _levels(rows, text, markers)
    rows = rows.where(is_json).select(F.struct(*keep).alias("_own"), F.lit("root").alias("path"), F.array().cast("array<int>").alias("at"),
        text.alias("text"), F.substring(F.regexp_extract(text, r"^\s*(.)", 1), 1, 1).alias("kind"), F.lit(False).alias("is_hit"))
    for _ in range(levels):
        inner = F.when(~F.col("is_hit"), _children(F.col("kind"), F.col("text"), hit, markers, scalars))
        opened = rows.select("*", F.explode_outer(inner).alias("c")).where("c is not null or is_hit")
        new = F.col("c").isNotNull()
        stays = new & (F.col("c.kind") != "scalar") & _may(F.col("c.value"), markers) & (~F.col("c.is_hit") | F.lit(inside))
        ways = F.when(~new, F.array(F.lit(True))).when(F.col("c.is_hit") & stays, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.col("c.is_hit")))
        told = lambda fresh, old: F.when(F.col("c").isNotNull(), fresh).otherwise(F.col(old)).alias(old)
        rows = opened.select("*", F.explode(ways).alias("way")).select("_own", told(F.concat("path", "c.step"), "path"),
            told(F.concat("at", F.array("c.place")), "at"), told(F.col("c.value"), "text"), told(F.col("c.kind"), "kind"), F.col("way").alias("is_hit"))
    return rows.where("is_hit").select("_own.*", "path", "at", F.col("text").alias("value"))


def _within(word: str) -> str:
    """A word as it stands within a JSON string."""
    return as_json(word, ensure_ascii=False)[1:-1]


def found_lists(texts: DataFrame, key: str, json: str = "json") -> DataFrame:
    """Every array whose first item is an object, under a key of the given name (lower case), at any depth."""
    quoted = f'"{_within(key)}"'
    return found(texts, lambda k, v: (F.lower(k) == key) & v.startswith("[{"), [quoted], True, json, scalars=False)


def found_keys(texts: DataFrame, words: list[str], width: int, json: str = "json") -> DataFrame:
    """The values under keys that hold one of the words (lower case), whatever the case of the key, as path and
    snippet: the first width characters of the value as JSON. Their insides aren't searched."""
    some = lambda text, ws: reduce(lambda a, b: a | b, [F.lower(text).contains(w) for w in ws])
    hits = found(texts, lambda k, v: some(k, words), [_within(w) for w in words], False, json)
    return hits.select(*[F.col(f"`{c}`") for c in texts.columns if c != json], "path", F.substring(spaced(F.col("value")), 1, width).alias("snippet"))
