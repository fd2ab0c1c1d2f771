"""Mood distribution: model output, lyrics distribution, fusion, calm calibration, final label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import MOODS, REALTIME_SOURCE
from ..functions import numeric as N
from ..functions import parse as P
from ..functions import rules as R

AUDIO_WEIGHT, LYRICS_WEIGHT = 0.65, 0.35
LEXICON_SMOOTHING = 0.001


def spread_probability(df: DataFrame, vector: str = "probability", prefix: str = "proba_") -> DataFrame:
    """A model's probability vector as one column per mood."""
    from pyspark.ml.functions import vector_to_array

    values = vector_to_array(F.col(vector))
    return df.withColumns({f"{prefix}{m}": F.get(values, F.lit(i)) for i, m in enumerate(MOODS)})


def audio_distribution(df: DataFrame, probabilities: dict[str, str]) -> DataFrame:
    """Model probabilities as audio_proba_*, proba_* and the audio label."""
    cols = [F.col(probabilities[m]) for m in MOODS]
    name = N.argmax_name(cols, list(MOODS))
    out = {f"audio_proba_{m}": c for m, c in zip(MOODS, cols)}
    out.update({f"proba_{m}": c for m, c in zip(MOODS, cols)})
    return df.withColumns({**out, "audio_predicted_mood": name, "audio_predicted_mood_label": P.mood_code(name)})


def lyrics_distribution(df: DataFrame) -> DataFrame:
    """Smoothed, normalised lexicon rates as lyrics_proba_*, with the lyrics label."""
    raw = [F.greatest(N.zero_if_null(F.col(f"lyrics_{m}_lexicon_rate")), F.lit(0.0)) + LEXICON_SMOOTHING for m in MOODS]
    out = df.withColumns({f"lyrics_proba_{m}": p for m, p in zip(MOODS, N.normalise(raw))})
    return out.withColumn("lyrics_predicted_mood", N.argmax_name([F.col(f"lyrics_proba_{m}") for m in MOODS], list(MOODS)))


def fuse(df: DataFrame) -> DataFrame:
    """Audio and lyrics mixed and renormalised, with the contrast flag."""
    mixed = [AUDIO_WEIGHT * F.col(f"audio_proba_{m}") + LYRICS_WEIGHT * F.col(f"lyrics_proba_{m}") for m in MOODS]
    out = df.withColumns({f"proba_{m}": p for m, p in zip(MOODS, N.normalise(mixed))})
    return out.withColumn("mood_contrast", F.col("audio_predicted_mood") != F.col("lyrics_predicted_mood"))


def without_lyrics(df: DataFrame) -> DataFrame:
    return df.withColumns({"lyrics_predicted_mood": F.lit(None).cast("string"), "mood_contrast": F.lit(False)})


def calibrate_calm(df: DataFrame) -> DataFrame:
    """Lift the calm share to the calm signal, renormalise, keep the model's own value."""
    keep = df if "model_proba_calm" in df.columns else df.withColumn("model_proba_calm", F.col("proba_calm"))
    lifted = keep.withColumn("calm_signal", R.calm_signal(keep.columns))
    calm = F.greatest(F.coalesce(F.col("proba_calm"), F.lit(0.0)), F.col("calm_signal"))
    parts = [calm if m == "calm" else F.col(f"proba_{m}") for m in MOODS]
    return lifted.withColumns({f"proba_{m}": p for m, p in zip(MOODS, N.normalise(parts))})


def final_label(df: DataFrame) -> DataFrame:
    cols = [F.col(f"proba_{m}") for m in MOODS]
    name = N.argmax_name(cols, list(MOODS))
    return df.withColumns({"predicted_mood": name, "predicted_mood_label": P.mood_code(name), "mood_confidence": F.greatest(*cols)})


def classify(df: DataFrame, probabilities: dict[str, str]) -> DataFrame:
    """The whole chain; lyrics are fused in when their rates are present."""
    out = audio_distribution(df, probabilities)
    has_lyrics = all(f"lyrics_{m}_lexicon_rate" in df.columns for m in MOODS)
    out = fuse(lyrics_distribution(out)) if has_lyrics else without_lyrics(out)
    return final_label(calibrate_calm(out))


def realtime_tags(df: DataFrame) -> DataFrame:
    """Constant columns of an online prediction."""
    cols = [F.col(f"proba_{m}") for m in MOODS]
    return without_lyrics(df).withColumns(
        {
            **{f"audio_proba_{m}": c for m, c in zip(MOODS, cols)},
            "predicted_mood": F.col("audio_predicted_mood"),
            "predicted_mood_label": F.col("audio_predicted_mood_label"),
            "mood_confidence": F.greatest(*cols),
            "source": F.lit(REALTIME_SOURCE),
            "ingested_at": F.current_timestamp(),
        }
    )
