"""Bronze -> Silver -> Gold for the three datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import LYRICS_GENRE, UNIT_FEATURES
from ..functions import parse as P
from ..functions import rules as R
from ..functions import text as X
from . import columns as C
from . import filters as Q
from . import ranking as K

DOUBLES = {c: "double" for c in (*UNIT_FEATURES, "loudness", "tempo", "spec_rate")}


def _dedup(df: DataFrame, key: str) -> DataFrame:
    """Deterministic survivor: the smallest row by all its values."""
    return K.keep_one(df, [key], [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c != key])


def _finish(df: DataFrame, key: str, text: list[str], numbers: list[str], compat: bool) -> DataFrame:
    """Fill, drop null keys, dedup, range filter.

    ``compat=True`` fills first, so all rows without a key share one "unknown" row.
    """
    if not compat:
        df = df.dropna(subset=[key])
    df = C.fill_by_type(df, text, numbers)
    return Q.in_audio_range(_dedup(df, key))


def silver_mood(raw: DataFrame, compat: bool = False) -> DataFrame:
    df = raw.drop("Unnamed: 0", "Unnamed: 0.1").withColumnsRenamed(
        {"duration (ms)": "duration_ms", "labels": "mood_label"}
    )
    df = C.cast_safely(df, {**DOUBLES, "duration_ms": "bigint", "mood_label": "int"})
    fill = ["duration_ms", *DOUBLES] + (["mood_label"] if compat else [])
    out = _finish(df, "uri", ["uri"], fill, compat)
    return out if compat else out.filter(F.col("mood_label").isNotNull())


def silver_tracks(raw: DataFrame, compat: bool = False) -> DataFrame:
    ints = {"popularity": "int", "duration_ms": "bigint", "key": "int", "mode": "int", "time_signature": "int"}
    text = ["track_id", "artists", "album_name", "track_name", "track_genre"]
    df = C.cast_safely(raw.drop("Unnamed: 0"), {**DOUBLES, **ints, "explicit": "boolean"})
    df = C.squash_text(df, text)
    return _finish(df, "track_id", text, [*ints, *DOUBLES], compat)


def silver_lyrics(raw: DataFrame, compat: bool = False) -> DataFrame:
    ints = {"duration_ms": "bigint", "key": "int", "mode": "int"}
    text = ["track_id", "track_name", "artists", "album_name", "lyrics"]
    df = C.cast_safely(raw.withColumnsRenamed({"id": "track_id", "name": "track_name"}), {**DOUBLES, **ints})
    df = C.squash_text(df, text)
    fill = text if compat else [c for c in text if c != "lyrics"]  # a missing lyric stays missing
    return _finish(df, "track_id", fill, [*ints, *DOUBLES], compat)


def gold_mood(silver: DataFrame) -> DataFrame:
    kept = C.keep_existing(silver, ["uri", "duration_ms", *DOUBLES, "mood_label"])
    return kept.withColumn("mood_name", P.mood_name(F.col("mood_label")))


def gold_tracks(silver: DataFrame) -> DataFrame:
    return silver.withColumns(
        {
            "context_tag": R.context_tag(F.col("energy"), F.col("valence"), F.col("acousticness")),
            "predicted_mood": F.lit(None).cast("string"),
            "recommendation_score": R.base_score(F.col("popularity"), F.col("valence"), F.col("energy")),
        }
    )


def gold_lyrics(silver: DataFrame, compat: bool = False) -> DataFrame:
    length = X.text_length(F.col("lyrics"))
    return silver.withColumns(
        {
            "track_genre": F.lit(LYRICS_GENRE),
            "popularity": F.lit(0),
            "explicit": F.lit(False),
            "lyrics_word_count": X.word_count(F.col("lyrics"), empty_is_one=compat),
            "lyrics_length": length,
            "has_lyrics": (length > 0).cast("int"),
        }
    )


SILVER = {"mood_dataset": silver_mood, "tracks_dataset": silver_tracks, "lyrics_dataset": silver_lyrics}
GOLD = {"mood_dataset": gold_mood, "tracks_dataset": gold_tracks, "lyrics_dataset": gold_lyrics}
