"""Benchmark decontamination by winnowing, with DataFrame functions only.

Texts become words; every run of ``gram`` words gets a 64-bit hash.  Of the hashes in each window of
words the smallest is kept as the window's fingerprint, in items and documents alike, so a shared
span of a window's length always shares a fingerprint.  Document positions whose fingerprint may be
one of the items' (a bit map of fixed size, a filter only) leave the scan, few as they are, and are
joined with the items' windows by fingerprint and compared word by word; each true hit is extended
to the whole run of words that its windows cover.  Items shorter than a window are one window each,
with the hash of all their words as fingerprint.

The texts are read once and not shuffled.  A passage that a third of all documents hold is a hot
key: the items' windows are repeated for ``salts`` shares of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Everything in ASCII but digits and letters (texts are cut before they are lower-cased).
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else (``lower`` would change other letters too)."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text: Column) -> Column:
    """Words of a text, in order and with their capitals; null has none."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), NOT_WORD), "")


def _over_runs(column: str, count: int, combine) -> Column:
    """Per place of an array column, ``combine`` of its ``count`` values from there on.

    Places too near the end hold rests, to be cut off.
    """
    if count == 1:
        return F.transform(column, lambda x: combine(x, x))
    return F.transform(column, lambda x, i: combine(x, *[F.get(F.col(column), i + j) for j in range(1, count)]))


def _with_prints(df: DataFrame, window: int, gram: int, lengths: list[int]) -> DataFrame:
    """``f<length>`` for each of ``lengths``: fingerprints of the windows of that many words in ``w``.

    A full window's is the smallest of its hashes of ``gram`` words; of shorter ones, the hash of all
    words.  Words are hashed in full lower case: equal windows get equal fingerprints, and what more
    does is sorted out with the words themselves.  Every step is a projection of its own: its array
    is used several times by the next.
    """
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(F.lower(x))))
    for length in lengths:
        to = f"f{length}"
        if length == window:
            df = df.withColumn("g", _over_runs("h", gram, F.xxhash64))
            df = df.withColumn(to, _over_runs("g", window - gram + 1, F.least)).drop("g")
        else:
            df = df.withColumn(to, _over_runs("h", length, F.xxhash64))
        df = df.withColumn(to, F.slice(to, 1, F.greatest(F.size("w") - (length - 1), F.lit(0))))
    return df.drop("h")


def _span(words: Column, at: Column, length) -> Column:
    """A window's words as one text; no word holds a blank, so equal texts are equal words."""
    return ascii_lower(F.array_join(F.slice(words, at + 1, length), " "))


def item_windows(items: DataFrame, window: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    """``item_id, length, fp, span``: every window of every item, once per item."""
    worded = items.select(F.col(f"`{id_col}`").cast("string").alias("item_id"), words_of(F.col(f"`{text_col}`")).alias("w"))
    worded = _with_prints(worded.where(F.size("w") > 0), window, gram, list(range(1, window + 1)))
    length = F.least(F.size("w"), F.lit(window))
    own = F.array(*[F.col(f"f{x}") for x in range(1, window + 1)])
    # exploding an expression, not a column: a filter on the column would be pushed below the steps it is built by
    placed = worded.select("item_id", "w", length.alias("length"), F.posexplode(F.get(own, length - 1)).alias("at", "fp"))
    return placed.select("item_id", "length", "fp", _span(F.col("w"), F.col("at"), F.col("length")).alias("span")).distinct()


def bit_map(prints: DataFrame, cells: int) -> DataFrame:
    """One row, one array of ``cells`` longs: a bit is set where a fingerprint falls (``cells`` is a power of two)."""
    own = prints.select(F.shiftright("fp", 6).bitwiseAND(cells - 1).alias("cell"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("fp").bitwiseAND(63).cast("int")).alias("bits"))
    every = prints.sparkSession.range(cells).select(F.col("id").alias("cell"), F.lit(0).cast("bigint").alias("bits"))
    merged = every.unionByName(own).groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    return merged.agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "bits"))), lambda c: c["bits"]).alias("bits"))


def map_cells(n_prints: int, most: int = 1 << 18) -> int:
    """Cells for about 64 bits a fingerprint, from 2^12 to ``most`` (2 MB): beyond, the map lets more through."""
    return min(most, max(1 << 12, 1 << max(n_prints - 1, 0).bit_length()))


def _marked(docs: DataFrame, prints: DataFrame, lengths: list[int], cells: int, window: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    """``row, doc_id, n_words, at, length, fp, span``: windows that may be an item's; ``length`` 0 stands for the row itself."""
    worded = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words_of(F.col(f"`{text_col}`")).alias("w")).withColumn("row", F.monotonically_increasing_id())
    worded = _with_prints(worded, window, gram, lengths).withColumn("bits", bit_map(prints, cells).scalar())

    def listed(fp: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), fp.bitwiseAND(63).cast("int"))
        return F.get("bits", F.shiftright(fp, 6).bitwiseAND(cells - 1).cast("int")).bitwiseAND(bit) != 0

    # places are sifted inside the row, so that words are copied for the few that are left only
    def sifted(fps: str) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(fps) - 1, F.lit(0)))
        return F.when(F.size(fps) > 0, F.filter(places, lambda i: listed(F.get(F.col(fps), i))))

    for x in lengths:
        worded = worded.withColumn(f"at{x}", sifted(f"f{x}"))

    def found(x: int) -> Column:
        at = F.coalesce(F.col(f"at{x}"), F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(F.lit(x).alias("length"), i.alias("at"), F.get(F.col(f"f{x}"), i).alias("fp"), _span(F.col("w"), i, x).alias("span")))

    itself = F.array(F.struct(F.lit(0).alias("length"), F.lit(-1).alias("at"), F.lit(None).cast("bigint").alias("fp"), F.lit(None).cast("string").alias("span")))
    return worded.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.inline(F.concat(itself, *[found(x) for x in lengths])))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    gram: int = 4,
    salts: int = 32,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids, contaminated, spans``: one row per row of ``docs``.

    A word is hit if it lies in an occurrence of an item's window of ``window`` words (items of fewer
    words: of the whole item).  ``item_ids`` are the items with an occurring window, as text, sorted;
    ``spans`` the runs of hit words (``start``, ``length``), joined windows in one.  Null and empty
    texts have no words; items without words are in no document.  Items with a null id count for hits
    but are not listed; rows that repeat an item id are one item.  Rows that repeat a doc_id are
    documents of their own.  Extra columns are ignored; an empty table of documents gives no rows, an
    empty one of items no hits.  1 <= ``gram`` <= ``window``: every shared span of ``window`` words
    is found, whatever ``gram`` is.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    spans = written(item_windows(items, window, gram, item_col, item_text_col), "item-windows")
    n_prints, lengths = spans.agg(F.count_distinct("fp"), F.array_sort(F.collect_set("length"))).first()
    marked = written(_marked(docs, spans.select("fp"), list(lengths), map_cells(n_prints), window, gram, id_col, text_col), "marked")
    salted = spans.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    asked = marked.where("length > 0").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    # the planner would size the items' windows without their repeats, and might broadcast them
    hits = asked.join(salted.hint("shuffle_merge"), ["salt", "length", "fp", "span"]).select("row", "item_id", F.struct("at", (F.col("at") + F.col("length")).alias("end")).alias("place"))
    found = hits.groupBy("row").agg(F.array_sort(F.collect_set("place")).alias("places"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    # places sorted by their begin: a place joins the run before it or begins the next
    run = "struct<start:int,end:int>"
    runs = F.aggregate(
        "places", F.array().cast(f"array<{run}>"),
        lambda done, p: F.when(
            (F.size(done) > 0) & (p["at"] <= F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], p["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(p["at"].alias("start"), p["end"].alias("end"))))),
    )
    found = found.select("row", "item_ids", runs.alias("runs"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    out = marked.where("length = 0").join(found, "row", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.transform("runs", lambda r: F.struct(r["start"].alias("start"), (r["end"] - r["start"]).alias("length"))), F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without a hit; all columns as they are (a row with a null id always stays)."""
    gone = contamination(docs, items, id_col=id_col, **options).where("contaminated").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, F.col(f"`{id_col}`") == F.col("__id"), "left_anti")
