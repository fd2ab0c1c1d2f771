"""Parsers for ids, URLs, vendor values and JSON payloads."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import DEFAULT_MOOD, MOOD_ALIASES, MOOD_CODE, MOODS, TRACK_URL_PATTERN, TRACK_URL_PREFIX
from .const import mapping
from .numeric import clip

JSON_DEPTH = 6  # levels of nested JSON that are searched in the JVM


def mood_alias(c: Column) -> Column:
    key = F.lower(F.trim(c.cast("string")))
    return F.coalesce(F.element_at(mapping(MOOD_ALIASES), key), F.lit(DEFAULT_MOOD))


def mood_name(code: Column) -> Column:
    return F.element_at(mapping(dict(enumerate(MOODS))), code.cast("int"))


def mood_code(name: Column) -> Column:
    return F.element_at(mapping(MOOD_CODE), name)


def track_id_from_url(url: Column, pattern: str = TRACK_URL_PATTERN) -> Column:
    """The id inside a track URL; NULL when the URL is not one."""
    found = F.regexp_extract(F.trim(url), pattern, 1)
    return F.when(found != "", found)


def track_url(track_id: Column, prefix: str = TRACK_URL_PREFIX) -> Column:
    return F.concat(F.lit(prefix), track_id)


def _number(text: Column) -> Column:
    d = F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(~F.isnan(d), d)


def unit_value(text: Column) -> Column:
    """Percent or fraction to [0, 1]; comma decimals allowed; anything bad is 0."""
    n = _number(text)
    return F.coalesce(
        F.when(n < 0, 0.0).when(n > 1.0, F.least(n / 100.0, F.lit(1.0))).otherwise(n), F.lit(0.0)
    )


def loudness_db(text: Column, is_text: Column | bool) -> Column:
    """Text such as "-7 dB" is decibels; a bare number in 0..1 or 0..100 maps to -60..0 dB."""
    as_text = F.trim(F.replace(F.lower(text), F.lit("db"), F.lit(""))).try_cast("double")
    n = text.try_cast("double")
    pct = F.when(n.between(0.0, 1.0), n * 100.0).otherwise(n)
    as_number = F.when(pct.between(0.0, 100.0), pct / 100.0 * 60.0 - 60.0).otherwise(pct)
    flag = F.lit(is_text) if isinstance(is_text, bool) else is_text
    return F.coalesce(F.when(flag, as_text).otherwise(as_number), F.lit(0.0))


def duration_ms(text: Column) -> Column:
    """``mm:ss``, ``hh:mm:ss``, seconds (below 1000) or milliseconds, to milliseconds."""
    parts = F.filter(F.transform(F.split(F.trim(text), ":"), lambda x: F.trim(x)), lambda x: x != "")
    clock_ok = F.trim(text).contains(":") & F.forall(parts, lambda x: x.rlike("^[0-9]+$"))
    at = lambda i: F.get(parts, F.lit(i)).try_cast("bigint")
    clock = F.when(F.size(parts) == 2, at(0) * 60 + at(1)).when(
        F.size(parts) == 3, at(0) * 3600 + at(1) * 60 + at(2)
    )
    n = _number(text)
    plain = F.when(n <= 0, 0).when(n < 1000, (n * 1000).try_cast("bigint")).otherwise(n.try_cast("bigint"))
    return F.coalesce(F.when(clock_ok, clock * 1000), plain, F.lit(0)).cast("bigint")


def popularity_100(text: Column) -> Column:
    """A fraction becomes a percentage; clamped to 0..100 and rounded half-even."""
    n = _number(text)
    pct = F.when((n > 0) & (n < 1), n * 100.0).otherwise(n)
    return F.coalesce(F.bround(clip(pct, 0.0, 100.0), 0), F.lit(0.0)).cast("int")


def format_duration(ms: Column) -> Column:
    """``m:ss``; "-" when there is no positive duration."""
    total = F.bround(ms / F.lit(1000.0), 0).cast("bigint")
    shown = F.concat(
        F.floor(total / 60).cast("string"), F.lit(":"), F.lpad((total % 60).cast("string"), 2, "0")
    )
    return F.when(ms > 0, shown).otherwise(F.lit("-"))


def object_key(key: Column) -> Column:
    """A URL-encoded object key split into ``struct<layer, dataset, key>``."""
    plain = F.url_decode(key)
    parts = F.split(plain, "/")
    full = F.size(parts) >= 2
    part = lambda i: F.when(
        full & (F.get(parts, F.lit(i)) != ""), F.get(parts, F.lit(i))
    ).otherwise(F.lit("unknown"))
    return F.struct(part(0).alias("layer"), part(1).alias("dataset"), plain.alias("key"))


def json_first(payload: Column, paths: list[str]) -> Column:
    """First non-empty value over candidate paths of a JSON text (known nesting)."""
    return F.coalesce(*[F.nullif(F.get_json_object(payload, p), F.lit("")) for p in paths])


def _json_members(text: Column) -> Column:
    """Members of a JSON object or array in document order: ``key`` (lower case; null in arrays), ``value`` (JSON), ``text``.

    The variant tells a text from a number; a nested object's ``text`` keeps the order of its keys, which a variant sorts.
    """
    strict = {"allowSingleQuotes": "false"}
    member = lambda key, value, own: F.struct(key.alias("key"), F.to_json(value).alias("value"), own.alias("text"))
    named = F.zip_with(
        F.map_entries(F.from_json(text, "map<string,string>", strict)), F.map_values(F.from_json(text, "map<string,variant>", strict)),
        lambda e, v: member(F.lower(e["key"]), v, e["value"]),
    )
    listed = F.zip_with(
        F.from_json(text, "array<string>", strict), F.from_json(text, "array<variant>", strict), lambda t, v: member(F.lit(None).cast("string"), v, t)
    )
    return F.when(text.startswith("{"), named).when(text.startswith("["), listed)


def json_entries(payload: Column, depth: int = JSON_DEPTH) -> Column:
    """``array<struct<key, value>>``: all non-empty members of a JSON text, each object's own before those nested in it.

    The first entry under a key is what a depth-first search for it finds.  Members nested deeper than
    ``depth`` are not listed (``json_beyond`` tells where there are any).
    """

    def walk(text: Column, left: int) -> Column:
        if left == 0:
            return F.array().cast("array<struct<key:string,value:string>>")

        def entries(members: Column) -> Column:
            own = F.filter(members, lambda m: m["key"].isNotNull() & ~m["value"].isin("null", '""'))
            nested = F.filter(members, lambda m: m["value"].startswith("{") | m["value"].startswith("["))
            return F.concat(
                F.transform(own, lambda m: F.struct(m["key"].alias("key"), m["value"].alias("value"))),
                F.flatten(F.transform(nested, lambda m: walk(m["text"], left - 1))),
            )

        return F.get(F.transform(F.array(_json_members(text)), entries), F.lit(0))  # members are worked out once

    return walk(F.ltrim(payload), depth)


def json_first_entry(entries: Column, keys: tuple[str, ...]) -> Column:
    """JSON text of the first entry under one of the keys."""
    return F.get(F.filter(entries, lambda e: e["key"].isin(*[k.lower() for k in keys])), F.lit(0))["value"]


def json_beyond(payload: Column, depth: int = JSON_DEPTH) -> Column:
    """True where ``json_entries`` does not tell all: no JSON to Spark (repeated keys, too long), or nested too deeply."""
    # inside brackets whatever follows the first value shows, which the parser would ignore
    parsed = F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]")))
    odd = parsed.isNull() | F.try_variant_get(parsed, "$[1]", "variant").isNotNull()
    brackets = F.regexp_replace(F.regexp_replace(payload, r'"(?:\\.|[^"\\])*+"', ""), r"[^\[\]{}]+", "")
    for _ in range(depth):  # every turn takes the innermost level away
        brackets = F.regexp_replace(brackets, r"\[\]|\{\}", "")
    return F.coalesce((F.trim(payload) != "") & (odd | (brackets != "")), F.lit(False))


def find_json_udf(fields: dict[str, tuple[str, ...]]):
    """Arrow-batched search of a JSON text of unknown nesting, one pass for all fields.

    Returns a function from the payload column to ``struct<field: string>``; each value is the
    JSON text of the first match (own keys before nested ones), so a later step can tell text
    from numbers.
    """
    wanted = {f: frozenset(k.lower() for k in ks) for f, ks in fields.items()}

    def empty(v) -> bool:
        return v is None or v == ""

    def find(node, keys):
        children = node if isinstance(node, list) else []
        if isinstance(node, dict):
            own = (v for k, v in node.items() if str(k).lower() in keys and not empty(v))
            hit = next(own, None)
            if hit is not None:
                return hit
            children = node.values()
        return next((v for v in (find(c, keys) for c in children) if not empty(v)), None)

    def parse(text):
        try:
            return json.loads(text) if text else None
        except ValueError:
            return None

    def search(payloads: pd.Series) -> pd.DataFrame:
        nodes = [parse(t) for t in payloads]
        hit = lambda node, ks: None if (v := find(node, ks)) is None else json.dumps(v, ensure_ascii=False)
        return pd.DataFrame({f: pd.Series([hit(n, ks) for n in nodes], dtype=object) for f, ks in wanted.items()})

    return F.pandas_udf(search, T.StructType([T.StructField(f, T.StringType()) for f in wanted]))


def json_is_text(value: Column) -> Column:
    return value.startswith('"')


def json_text(value: Column) -> Column:
    """Plain text of a JSON scalar (quotes and escapes removed)."""
    return F.when(json_is_text(value), F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")).otherwise(value)


def json_names(value: Column) -> Column:
    """Artists given as text, object or list, as one ", "-joined text."""
    item = "struct<name: string, artist: string>"
    objects = F.from_json(value, f"array<{item}>")
    texts = F.from_json(value, "array<string>")
    one = F.from_json(value, item)
    from_objects = F.transform(objects, lambda o: F.coalesce(o["name"], o["artist"]))
    from_list = F.when(value.rlike(r"^\[\s*\{"), from_objects).otherwise(texts)
    names = (
        F.when(value.startswith("["), from_list)
        .when(value.startswith("{"), F.array(F.coalesce(one["name"], one["artist"])))
        .otherwise(F.array(json_text(value)))
    )
    joined = F.array_join(F.filter(names, lambda x: x.isNotNull() & (x != "")), ", ")
    return F.nullif(joined, F.lit(""))
