"""Vendor JSON payloads -> track metadata and feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import LYRICS_GENRE, METADATA_DEFAULTS, PAYLOAD_KEYS, RECOMMENDER_FEATURES, SHARED_FEATURES, UNIT_FEATURES
from ..functions import numeric as N
from ..functions import parse as P
from . import columns as C
from . import filters as Q
from . import prepare as R

NO_DATE = "-"
META_FIELDS = {k: PAYLOAD_KEYS[k] for k in ("track_name", "artists", "genres", "popularity", "album", "album_name", "release_date", "cover", "duration")}
FEATURE_FIELDS = {k: PAYLOAD_KEYS[k] for k in (*UNIT_FEATURES, "tempo", "loudness", "duration", "id")}


def find_fields(df: DataFrame, payload: str, fields: dict, to: str = "_f") -> DataFrame:
    """``struct<field: string>``: JSON text of the first member under one of a field's keys, at any depth.

    Found in the JVM; only payloads that its parser refuses or that nest too deeply are searched in
    Python.  A null or blank payload has no field.
    """
    text, beyond = F.col(payload), P.json_beyond(F.col(payload))
    entries = df.filter(~beyond).withColumn("_e", P.json_entries(text))
    found = entries.withColumn(to, F.struct(*[P.json_first_entry(F.col("_e"), keys).alias(f) for f, keys in fields.items()])).drop("_e")
    rest = df.filter(beyond).withColumn(to, P.find_json_udf(fields)(text))
    return found.unionByName(rest)


def _first_genre(value: Column) -> Column:
    listed = F.get(F.from_json(value, "array<string>"), F.lit(0))
    return F.when(value.startswith("["), listed).otherwise(P.json_text(value))


def _cover(value: Column) -> Column:
    inner = lambda v: P.json_first(v, [f"$.{k}" for k in ("url", "image", "image_url", "cover", "cover_url", "thumbnail", "thumbnail_url")])
    item = F.get_json_object(value, "$[0]")
    of_item = F.when(item.startswith("{"), inner(item)).otherwise(item)
    return F.when(value.startswith("["), of_item).when(value.startswith("{"), inner(value)).otherwise(P.json_text(value))


def track_metadata(df: DataFrame, payload: str, with_defaults: bool = True) -> DataFrame:
    """name, artists, genre, popularity, album, release date, cover and duration of a payload."""
    f = lambda name: F.col(f"_f.{name}")
    album = f("album")
    in_album = lambda *keys: F.when(album.startswith("{"), P.json_first(album, [f"$.{k}" for k in keys]))
    album_text = F.when(~album.startswith("{") & ~album.startswith("["), P.json_text(album))
    out = find_fields(df, payload, META_FIELDS).withColumns(
        {
            "track_name": P.json_text(f("track_name")),
            "artists": P.json_names(f("artists")),
            "track_genre": _first_genre(f("genres")),
            "popularity": F.when(f("popularity").isNotNull(), P.popularity_100(P.json_text(f("popularity")))),
            "album_name": F.coalesce(in_album("name", "title"), album_text, P.json_text(f("album_name"))),
            "release_date": F.coalesce(in_album("release_date", "release"), P.json_text(f("release_date"))),
            "cover_url": F.coalesce(_cover(f("cover")), _cover(F.when(album.startswith("{"), F.get_json_object(album, "$.images")))),
            "duration_ms": P.duration_ms(P.json_text(f("duration"))),
        }
    ).drop("_f")
    return fill_metadata(out) if with_defaults else out


def fill_metadata(df: DataFrame) -> DataFrame:
    d = {k: METADATA_DEFAULTS[k] for k in ("track_name", "artists", "album_name", "popularity")}
    return C.with_defaults(df, {**d, "track_genre": LYRICS_GENRE, "release_date": NO_DATE, "duration_ms": 0})


def enrich(meta: DataFrame, later: list[DataFrame], key: str) -> DataFrame:
    """Fill fields that are still missing from later payload tables, in order (one row per key)."""
    fields = ["track_name", "artists", "track_genre", "popularity", "duration_ms"]
    out = meta
    for i, table in enumerate(later):
        out = out.join(table.select(key, *[F.col(c).alias(f"_{i}_{c}") for c in fields]), key, "left")
    sources = lambda c: [F.col(c), *[F.col(f"_{i}_{c}") for i in range(len(later))]]
    some = lambda c, x: F.when(x > 0, x) if c in ("popularity", "duration_ms") else F.nullif(x, F.lit(""))
    filled = {c: F.coalesce(*[some(c, x) for x in sources(c)]) for c in fields}
    out = out.withColumns(filled).drop(*[f"_{i}_{c}" for i in range(len(later)) for c in fields])
    return fill_metadata(out)


def audio_features(df: DataFrame, payload: str) -> DataFrame:
    """Feature columns of a vendor payload in any of its notations."""
    f = lambda name: F.col(f"_f.{name}")
    text = lambda name: P.json_text(f(name))
    tempo = F.coalesce(F.replace(text("tempo"), F.lit(","), F.lit(".")).try_cast("double"), F.lit(0.0))
    out = find_fields(df, payload, FEATURE_FIELDS).withColumns(
        {
            **{c: P.unit_value(text(c)) for c in UNIT_FEATURES},
            "tempo": tempo,
            "loudness": P.loudness_db(text("loudness"), F.coalesce(P.json_is_text(f("loudness")), F.lit(False))),
            "duration_ms": P.duration_ms(text("duration")),
            "payload_id": F.coalesce(text("id"), F.lit("")),
        }
    ).drop("_f")
    return out.withColumn("spec_rate", N.spec_rate(F.col("speechiness"), F.col("duration_ms")))


def prepare_upload(df: DataFrame, features: list[str] = list(SHARED_FEATURES), url: str = "spotify_url") -> DataFrame:
    """Uploaded rows made ready for a model, with a ``violations`` column (empty = accepted)."""
    out = C.normalise_upload_names(df)
    missing = [c for c in (*[f for f in features if f in SHARED_FEATURES], url) if c not in out.columns]
    if missing:
        raise ValueError("Faltan columnas obligatorias para el modelo: " + ", ".join(missing))
    numbers = [c for c in dict.fromkeys((*SHARED_FEATURES, *features)) if c in out.columns]
    out = C.cast_safely(out, {c: "double" for c in numbers})
    out = R.engineered(out)
    out = Q.with_violations(out, [c for c in features if c in out.columns], url)
    from_url = P.track_id_from_url(F.col(url))
    own = F.nullif(F.trim(F.col("track_id").cast("string")), F.lit("")) if "track_id" in out.columns else F.lit(None).cast("string")
    out = out.withColumn("track_id", F.coalesce(own, from_url))
    out = C.ensure_numeric(out, list(RECOMMENDER_FEATURES))
    spoken = N.truthy(F.col("explicit")) if "explicit" in out.columns else F.lit(False)
    pop = F.coalesce(N.clip(N.safe_double(F.col("popularity")), 0, 100), F.lit(0.0)) if "popularity" in out.columns else F.lit(0.0)
    text = {k: v for k, v in METADATA_DEFAULTS.items() if isinstance(v, str)}
    return C.with_defaults(out, text).withColumns({"explicit": spoken, "popularity": pop})
