"""Joins: catalog assembly, metadata conflicts, train/test overlap, unseen rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import LYRICS_GENRE
from . import columns as C
from . import ranking as K

METADATA = ["track_id", "track_name", "artists", "album_name", "track_genre", "popularity", "explicit"]


def one_per_key(meta: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Listed columns that exist, one row per key (the smallest by its values)."""
    kept = C.keep_existing(meta, columns)
    return K.keep_one(kept, [key], [F.col(c).asc_nulls_first() for c in kept.columns if c != key])


def left_with_suffix(left: DataFrame, right: DataFrame, key: str, suffix: str = "_meta") -> DataFrame:
    """Left join; right columns that collide get a suffix."""
    clash = {c: c + suffix for c in right.columns if c != key and c in left.columns}
    return left.join(right.withColumnsRenamed(clash), key, "left")


def with_metadata(features: DataFrame, meta: DataFrame, key: str = "track_id", columns: list[str] = METADATA) -> DataFrame:
    return left_with_suffix(features, one_per_key(meta, key, columns), key)


def assemble_catalog(tracks: DataFrame, tracks_meta: DataFrame, lyrics: DataFrame | None = None,
                     lyrics_meta: DataFrame | None = None) -> DataFrame:
    """Scaled tracks with metadata, plus lyrics tracks not already present."""
    catalog = with_metadata(tracks, tracks_meta)
    if lyrics is None:
        return catalog
    if lyrics_meta is not None:
        lyrics = with_metadata(lyrics, lyrics_meta)
    lyrics = C.fill_missing_text(lyrics, {"track_genre": LYRICS_GENRE}, {"track_genre": {"lyrics_dataset": LYRICS_GENRE}})
    lyrics = C.with_defaults(lyrics, {"popularity": 0, "explicit": False})
    return K.first_source_wins([catalog, lyrics], ["track_id"])


def hot_catalog(base: DataFrame, delta: DataFrame, newest: list[Column]) -> DataFrame:
    """Catalog base plus appended rows; the newest row of a track wins."""
    union = base.withColumn("_src", F.lit(0)).unionByName(delta.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    return K.keep_latest(union, ["track_id"], [F.col("_src").desc(), *newest]).drop("_src")


def metadata_conflicts(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per field, how many keys carry different values in two sources (keys unique per source)."""
    a = left.select(key, *[F.col(f).alias(f"l_{f}") for f in fields])
    b = right.select(key, *[F.col(f).alias(f"r_{f}") for f in fields])
    return a.join(b, key).agg(*[F.count_if(F.col(f"l_{f}") != F.col(f"r_{f}")).alias(f) for f in fields])


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])


def split_report(train: DataFrame, test: DataFrame, features: list[str], label: str) -> DataFrame:
    """Rows, duplicates and train/test leakage; one row.

    Both sides are counted per feature combination first, so copies never multiply in the join;
    missing values match each other.
    """
    n = F.count("*")
    tr = train.groupBy(*features, label).agg(n.alias("same"))
    te = test.groupBy(*features, label).agg(n.alias("n_test"))
    tr_any = tr.groupBy(*features).agg(F.sum("same").alias("n_train"))
    hit = te.join(tr_any, _same(te, tr_any, features)).select(*[te[c] for c in features], te[label], "n_test", "n_train")
    full = [*features, label]
    agree = F.when(F.col("same").isNull(), 0).otherwise(F.col("same"))
    matched = hit.join(tr, _same(hit, tr, full), "left").select("n_test", "n_train", agree.alias("same"))
    overlap = matched.agg(
        F.coalesce(F.sum("n_test"), F.lit(0)).alias("test_rows_with_feature_overlap"),
        F.try_divide(F.sum(F.col("n_test") * F.col("same")), F.sum(F.col("n_test") * F.col("n_train"))).alias("feature_overlap_label_agreement"),
    )

    def counts(per_label: DataFrame, count: str, side: str) -> DataFrame:
        by_features = per_label.groupBy(*features).agg(F.sum(count).alias("n"))
        return by_features.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias(f"{side}_rows"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(f"{side}_duplicate_feature_rows"),
        )

    both = C.attach(C.attach(overlap, counts(tr, "same", "train"), "_a"), counts(te, "n_test", "test"), "_b")
    return both.select(*overlap.columns, "_a.*", "_b.*")


def unseen(pool: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    return pool.join(seen.select(*key).distinct(), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: list[str], newest: list[Column] = ()) -> DataFrame:
    """Insert or update by key: incoming rows win, later ones first."""
    return K.last_source_wins([old, new], key, list(newest))


def replace_by_key(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Delete the keys present in ``new``, then insert all of ``new``."""
    return unseen(old, new, key).unionByName(new, allowMissingColumns=True)
