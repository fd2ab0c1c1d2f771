"""An uploaded table, end to end: checks, engineered columns, scaling, a model's classes, tags."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import MOODS, SHARED_FEATURES
from . import filters as Q
from . import mood as M
from . import payloads as PL
from . import prepare as R


def classify_upload(df: DataFrame, score: Callable[[DataFrame], DataFrame], stats: DataFrame | None = None,
                    features: list[str] = list(SHARED_FEATURES)) -> tuple[DataFrame, DataFrame]:
    """(classified rows, rejected rows with their ``violations``).

    ``score`` adds one share per mood, named ``p_<mood>``; it sees the features scaled by ``stats``
    (the tall table), while the result keeps them as they were uploaded.
    """
    accepted, rejected = Q.split_valid(PL.prepare_upload(df, features))
    ready = accepted.withColumn("_raw", F.struct(*features))
    scored = score(R.apply_scaler(ready, stats, features) if stats is not None else ready)
    back = scored.withColumns({c: F.col(f"_raw.{c}") for c in features}).drop("_raw")
    tagged = M.realtime_tags(M.audio_distribution(back, {m: f"p_{m}" for m in MOODS}))
    return tagged.drop(*[f"p_{m}" for m in MOODS]), rejected
