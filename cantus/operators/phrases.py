"""Text classification by nearest training phrases: TF-IDF over word 1-2-grams and in-word
character 3-5-grams, cosine distance, k = 3, distance weights.

The training phrases are a parameter (a list, size-checked), so their index is a small table of
proven size and is broadcast.  The texts are partitioned by id once; every later step (scoring,
ranking, voting) reuses that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..fixed_values import DEFAULT_PHRASES, PROFILE, PROTOTYPES
from ..functions import const
from ..functions import text as X
from . import activity as A

MAX_PHRASES = 5_000
EXACT_MATCH = 1e-12
GROUP_CHARS = 250_000  # texts that ask together for the document frequencies of their terms
PART_CHARS = 1_000_000  # a text has three to four terms per character, each a row until it is counted


def word_grams(text: Column) -> Column:
    """Words of two or more letters, and pairs of neighbours."""
    w = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda t: F.length(t) >= 2)

    def with_pairs(own: Column) -> Column:
        pairs = F.when(
            F.size(own) >= 2, F.transform(F.slice(own, F.lit(1), F.size(own) - 1), lambda t, i: F.concat_ws(" ", t, F.get(own, i + 1)))
        ).otherwise(F.array().cast("array<string>"))
        return F.concat(own, pairs)

    # bound once by the lambda: inside the pairs the text would be split again for every word
    return F.get(F.transform(F.array(w), with_pairs), F.lit(0))


def char_grams(text: Column, lo: int = 3, hi: int = 5) -> Column:
    """Substrings of length 3 to 5 of each blank-padded word; a short word appears once."""
    padded = F.transform(F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != ""), lambda t: F.concat(F.lit(" "), t, F.lit(" ")))

    def cut(word: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(word) - n + 1, F.lit(1)))
        grams = F.transform(starts, lambda i: F.substring(word, i, F.lit(n)))
        return F.when(F.length(word) >= n, grams).otherwise(F.array().cast("array<string>"))

    per_word = F.transform(padded, lambda w: F.concat(*[cut(w, n) for n in range(lo, hi + 1)]))
    return F.flatten(per_word)


def terms(df: DataFrame, key: str, text: str, also: list[str] = ()) -> DataFrame:
    """``(also, key, kind, term, tf)``: kind 0 words, kind 1 character grams; ``also`` names columns that follow from the key."""
    both = F.concat(
        F.transform(word_grams(F.col(text)), lambda t: F.struct(F.lit(0).alias("kind"), t.alias("term"))),
        F.transform(char_grams(F.col(text)), lambda t: F.struct(F.lit(1).alias("kind"), t.alias("term"))),
    )
    listed = df.select(*also, key, F.inline_outer(both)).filter("term IS NOT NULL")
    return listed.groupBy(*also, key, "kind", "term").agg(F.count("*").cast("double").alias("tf"))


def tf_idf(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, kind, term, weight)``: smoothed idf over all texts, each text's kind of unit length.

    The texts are dealt to groups, of about ``GROUP_CHARS`` characters, which are the partitions of all that
    follows: terms are counted and weighed where their text is, and only the distinct terms of a group travel, to be counted over
    all groups and back.  The vocabulary grows with the texts, so it is never broadcast: a broadcast would pass through the driver.
    """
    told = df.agg(F.sum(F.length(text)).alias("chars"), F.count("*").alias("n")).first()
    groups = max(df.sparkSession.sparkContext.defaultParallelism, -(-(told["chars"] or 0) // GROUP_CHARS))
    dealt = df.select(F.pmod(F.xxhash64(key), F.lit(groups)).alias("_group"), key, text).repartition(groups, "_group")
    counted = terms(dealt, key, text, ["_group"])
    asked = counted.groupBy("_group", "kind", "term").agg(F.count("*").alias("n"))
    idf = F.ln((1.0 + told["n"]) / (1.0 + F.sum("n"))) + 1.0
    known = asked.groupBy("kind", "term").agg(idf.alias("idf"), F.collect_list("_group").alias("_groups"))
    known = known.select("kind", "term", "idf", F.explode("_groups").alias("_group")).repartition(groups, "_group")
    # a join would deal both sides again by all of its keys; a window leaves the groups where they are
    both = counted.unionByName(known, allowMissingColumns=True)
    idf = F.max("idf").over(W.partitionBy("_group", "kind", "term"))
    weighed = both.withColumn("idf", idf).filter("tf IS NOT NULL").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("_group", key, "kind")))
    return weighed.select(key, "kind", "term", (F.col("w") / norm).alias("weight"))


def phrase_rows(spark, phrases: dict[str, tuple[str, ...]] = DEFAULT_PHRASES) -> DataFrame:
    """Expanded training phrases ``(phrase_id, text, activity_name)``."""
    base = [(a, p) for a, ps in phrases.items() for p in ps]
    if len(base) > MAX_PHRASES:
        raise ValueError(f"at most {MAX_PHRASES} base phrases")
    df = spark.createDataFrame([(i, a, p) for i, (a, p) in enumerate(base)], "base_id int, activity_name string, phrase string")
    expanded = A.expand_phrases(df, "phrase")
    # the base list is size-checked above, so one small window is fine
    order = W.partitionBy(F.lit(1)).orderBy("base_id", "text")
    return expanded.select((F.row_number().over(order) - 1).alias("phrase_id"), "text", "activity_name")


def build_index(rows: DataFrame) -> DataFrame:
    """``(kind, term, idf, postings[(phrase_id, weight)])`` with smoothed idf and unit-length blocks."""
    t = terms(rows, "phrase_id", "text")
    n = rows.agg(F.count("*")).scalar()
    idf = F.ln((1.0 + n) / (1.0 + F.count("*"))) + 1.0
    df = t.groupBy("kind", "term").agg(idf.alias("idf"))
    w = t.join(df, ["kind", "term"]).withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("phrase_id", "kind")))
    # both blocks of a phrase are present, so the joined vector has length sqrt(2)
    blocks = F.size(F.collect_set("kind").over(W.partitionBy("phrase_id")))
    unit = w.withColumn("w", F.col("w") / norm / F.sqrt(blocks.cast("double")))
    return unit.groupBy("kind", "term", "idf").agg(F.collect_list(F.struct("phrase_id", "w")).alias("postings"))


def nearest_phrases(texts: DataFrame, key: str, text: str, rows: DataFrame, k: int = 3) -> DataFrame:
    """``(key, phrase_id, distance, weight)`` for the k nearest phrases of every text.

    A text that shares no term with a phrase is at distance 1 from it; the lowest phrase ids then
    fill the k places, so every text gets exactly k neighbours.  The partitions are dealt by the characters
    of all texts, so that the terms of one fit a task's memory; postings join after the windows have sorted.
    """
    plain = texts.select(key, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    chars = plain.agg(F.sum(F.length("_t")).alias("n")).first()["n"] or 0
    by_id = plain.repartition(max(plain.sparkSession.sparkContext.defaultParallelism, -(-chars // PART_CHARS)), key)
    index = build_index(rows)  # at most MAX_PHRASES base phrases x 12 variants
    known, postings = F.broadcast(index.drop("postings")), F.broadcast(index.drop("idf"))
    hits = terms(by_id, key, "_t").join(known, ["kind", "term"]).withColumn("w", F.col("tf") * F.col("idf"))
    per_kind = W.partitionBy(key, "kind")
    per_text = W.partitionBy(key)
    hits = hits.withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(per_kind)))
    hits = hits.withColumn("blocks", F.size(F.collect_set("kind").over(per_text)))
    unit = F.col("w") / F.col("norm") / F.sqrt(F.col("blocks").cast("double"))
    units = hits.select(key, "kind", "term", unit.alias("u"))
    dots = units.join(postings, ["kind", "term"]).select(key, "u", F.explode("postings").alias("p"))
    dots = dots.select(key, F.col("p.phrase_id").alias("phrase_id"), (F.col("u") * F.col("p.w")).alias("dot"))
    fillers = const.array(range(2 * k - 1))  # enough low ids even if k - 1 of them match
    zero = by_id.select(key, F.explode(fillers).alias("phrase_id"), F.lit(0.0).alias("dot"))
    scored = dots.unionByName(zero).groupBy(key, "phrase_id").agg(F.greatest(1.0 - F.sum("dot"), F.lit(0.0)).alias("distance"))
    order = W.partitionBy(key).orderBy(F.round("distance", 12), "phrase_id")
    near = scored.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= k).drop("_rn")
    exact = F.col("distance") < EXACT_MATCH
    any_exact = F.max(exact).over(per_text)
    weight = F.when(any_exact, exact.cast("double")).otherwise(1.0 / F.greatest(F.col("distance"), F.lit(EXACT_MATCH)))
    return near.withColumn("weight", weight)


def classify_texts(texts: DataFrame, key: str, text: str, phrases: dict[str, tuple[str, ...]] = DEFAULT_PHRASES,
                   prototypes: dict[str, tuple[float, ...]] = PROTOTYPES, k: int = 3) -> DataFrame:
    """Label, confidence and regressed profile of every text."""
    rows = phrase_rows(texts.sparkSession, phrases)
    near = nearest_phrases(texts, key, text, rows, k).join(F.broadcast(rows.select("phrase_id", "activity_name")), "phrase_id")
    votes = near.groupBy(key, "activity_name").agg(F.sum("weight").alias("w"))
    value = lambda i: F.element_at(const.mapping({n: float(v[i]) for n, v in prototypes.items()}), F.col("activity_name"))
    total = F.sum("w")
    return votes.groupBy(key).agg(
        F.min_by("activity_name", F.struct((-F.round(F.col("w") / F.lit(1.0), 9)).alias("w"), F.col("activity_name").alias("a"))).alias("label"),
        (F.max("w") / total).alias("confidence"),
        *[(F.sum(F.col("w") * value(i)) / total).alias(c) for i, c in enumerate(PROFILE)],
    )


def interpret_with_phrases(texts: DataFrame, key: str, text: str, phrases: dict[str, tuple[str, ...]] = DEFAULT_PHRASES) -> DataFrame:
    """The hybrid interpreter: keyword hint, else nearest-phrase label, else nearest prototype."""
    clean = texts.withColumn("_norm", X.fold_basic(F.coalesce(F.col(text), F.lit(""))))
    predicted = classify_texts(clean, key, "_norm", phrases).withColumnsRenamed({c: f"_{c}" for c in PROFILE})
    joined = clean.drop("_norm").join(predicted, key)
    out = A.interpret(joined, text, "label", "confidence", {c: F.col(f"_{c}") for c in PROFILE})
    return out.drop(*[f"_{c}" for c in PROFILE])
