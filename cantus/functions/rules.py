"""Small decision rules: context tag, reason text, calm signal, mood weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import GENERAL_ACTIVITY, MOODS, REASONS


def context_tag(energy: Column, valence: Column, acousticness: Column) -> Column:
    return (
        F.when((energy >= 0.65) & (valence >= 0.55), "active_positive")
        .when((energy < 0.45) & (valence < 0.45), "calm_sad_candidate")
        .when(acousticness >= 0.65, "acoustic")
        .otherwise("general")
    )


def base_score(popularity: Column, valence: Column, energy: Column) -> Column:
    zero = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return (zero(popularity) / 100.0 + zero(valence) + zero(energy)) / 3.0


def reason_text(mood: Column, activity: Column, texts: dict[str, str] = REASONS) -> Column:
    sad = mood == "sad"
    return (
        F.when(sad & (activity == "desahogo_emocional"), texts["sad_release"])
        .when(sad & activity.isin("entrenamiento_intenso", "correr"), texts["sad_workout"])
        .when(activity == "limpieza_domestica", texts["limpieza_domestica"])
        .when(activity == "alimentacion", texts["alimentacion"])
        .when(activity == "relajacion", texts["relajacion"])
        .when(activity == GENERAL_ACTIVITY, texts["actividad_general"])
        .otherwise(texts["default"])
    )


# feature -> (sign, shift, slope, weight): weight * sigmoid(slope * (sign * x - shift))
CALM_TERMS = {
    "energy": (-1, 0.25, 2.0, 0.25),
    "acousticness": (1, 0.10, 1.8, 0.22),
    "loudness": (-1, 0.20, 1.5, 0.18),
    "danceability": (-1, 0.15, 1.3, 0.12),
    "speechiness": (-1, 0.10, 1.2, 0.08),
    "instrumentalness": (1, 0.30, 1.8, 0.05),
}
CALM_LYRICS_WEIGHT = 0.10


def calm_signal(columns: list[str]) -> Column:
    """How calm a (scaled) track sounds, in [0, 1]; a missing column or value counts as 0."""
    value = lambda c: f"nanvl(coalesce(try_cast(`{c}` AS DOUBLE), 0D), 0D)" if c in columns else "0D"
    term = lambda c, sign, shift, slope, weight: (
        f"{weight}D / (1D + exp(-greatest(least({slope}D * ({sign} * {value(c)} - {shift}D), 20D), -20D)))"
    )
    terms = [term(c, *spec) for c, spec in CALM_TERMS.items()]
    lyrics = f"{CALM_LYRICS_WEIGHT}D * least(greatest({value('lyrics_proba_calm')}, 0D), 1D)"
    return F.expr(f"least(greatest({' + '.join([*terms, lyrics])}, 0D), 1D)")


def _floor_and_scale(w: dict[str, Column]) -> dict[str, Column]:
    floored = {m: F.greatest(c, F.lit(0.0)) for m, c in w.items()}
    total = sum((floored[m] for m in MOODS[1:]), floored[MOODS[0]])
    return {m: c / total for m, c in floored.items()}


def serving_weights(mood: Column, energy: Column, calm: Column, positivity: Column) -> dict[str, Column]:
    """Mood weights at serving time; only the first matching branch applies."""
    base = {m: 0.04 + F.when(mood == m, 0.78).otherwise(0.0) for m in MOODS}
    branch = (
        F.when((mood == "sad") & (calm > 0.70) & (energy < 0.25), "release")
        .when((mood == "sad") & (energy > 0.65), "sad_active")
        .when((mood == "calm") & (energy > 0.65), "calm_active")
        .when(mood == "calm", "calm")
        .when(calm > 0.65, "calm_need")
        .when(energy > 0.65, "active_need")
        .otherwise("none")
    )
    add = {
        "sad": {"release": 0.45, "sad_active": 0.25},
        "happy": {},
        "energetic": {"sad_active": 0.22, "calm_active": 0.08, "active_need": 0.22},
        "calm": {"release": 0.25, "calm": 0.25, "calm_active": 0.45, "calm_need": 0.22},
    }
    times = {
        "sad": {},
        "happy": {"release": 0.20, "sad_active": 0.40},
        "energetic": {"release": 0.15, "calm_need": 0.45},
        "calm": {},
    }
    pick = lambda table, default: _pick(branch, table, default)
    out = {m: base[m] * pick(times[m], 1.0) + pick(add[m], 0.0) for m in MOODS}
    out["happy"] = out["happy"] + F.when((positivity > 0.70) & (mood == "happy"), 0.20).otherwise(0.0)
    return _floor_and_scale(out)


def _pick(branch: Column, table: dict[str, float], default: float) -> Column:
    expr = None
    for name, value in table.items():
        expr = F.when(branch == name, value) if expr is None else expr.when(branch == name, value)
    return F.lit(default) if expr is None else expr.otherwise(default)


# need -> (threshold, {mood: change}); every rule whose need exceeds its threshold adds up
TRAINING_START = {"sad": 0.05, "happy": 0.25, "energetic": 0.25, "calm": 0.20}
TRAINING_ASKED = 0.35
TRAINING_RULES = {
    "activity_energy": (0.65, {"energetic": 0.35, "happy": 0.20, "calm": -0.10}),
    "activity_calm": (0.65, {"calm": 0.35, "energetic": -0.15}),
    "activity_positivity": (0.70, {"happy": 0.25, "sad": -0.05}),
}
TRAINING_SAD_ACTIVE = 0.10  # added to sad when a sad listener is active


def training_weights(mood: str, profile: dict[str, float]) -> dict[str, float]:
    """Mood weights of one cell of the training grid (constants, so worked out on the driver)."""
    active = profile["activity_energy"] > TRAINING_RULES["activity_energy"][0]
    changes = [ch for need, (limit, ch) in TRAINING_RULES.items() if profile[need] > limit]
    changes.append({mood: TRAINING_ASKED})
    if mood == "sad" and active:
        changes.append({"sad": TRAINING_SAD_ACTIVE})
    raw = {m: max(base + sum(ch.get(m, 0.0) for ch in changes), 0.0) for m, base in TRAINING_START.items()}
    scale = sum(raw.values())
    return {m: v / scale for m, v in raw.items()}
