"""The three datasets of the lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from .fixed_values import UNIT_FEATURES


@dataclass(frozen=True)
class Dataset:
    name: str
    id_column: str
    columns: tuple[str, ...]  # raw column names, all read as text

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def topic(self) -> str:
        return self.name


MOOD = Dataset(
    "mood_dataset",
    "uri",
    ("Unnamed: 0", "Unnamed: 0.1", "duration (ms)", *UNIT_FEATURES, "loudness", "tempo", "spec_rate", "labels", "uri"),
)
TRACKS = Dataset(
    "tracks_dataset",
    "track_id",
    (
        "Unnamed: 0", "track_id", "artists", "album_name", "track_name", "popularity", "duration_ms",
        "explicit", "key", "mode", "time_signature", "track_genre", *UNIT_FEATURES, "loudness", "tempo",
    ),
)
LYRICS = Dataset(
    "lyrics_dataset",
    "id",
    (
        "id", "name", "album_name", "artists", "key", "mode", "duration_ms", "lyrics",
        *UNIT_FEATURES, "loudness", "tempo",
    ),
)
DATASETS = {d.name: d for d in (MOOD, TRACKS, LYRICS)}
