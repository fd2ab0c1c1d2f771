"""How five text filters interact: what each removes alone, after others, and in every order.

A task works out four of the filters from the text itself.  The fifth, "identical to the text of a
smaller id", is answered by radix tries.  Texts are dealt by ranges of adaptive prefixes: a prefix
that holds too many bytes is lengthened, past all that its texts have in common, until its ranges
fit a task.  The owner of a range inserts whole texts in a compressed trie, whose terminals hold the
smallest id; when all are in, every row is compared with its terminal.  A task first keeps, of its
own copies of a text, the smallest id, so a text that a third of all rows hold is one row per task.

Five failures are a mask of five bits.  All reports follow from the number of documents per part and
mask: at most 32 rows a part, expanded to the 120 orders.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, slices, written

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
_UPPER, _CONTINUED = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
_BLANK = b" \t\n\x0b\x0c\r"
_PIECE = 1 << 22


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


class RadixTrie:
    """A compressed trie of byte strings; ``least`` holds the smallest id per terminal."""

    def __init__(self):
        self.edges: list[dict[int, tuple[bytes, int]]] = [{}]
        self.least: list[int | None] = [None]

    def _node(self) -> int:
        self.edges.append({})
        self.least.append(None)
        return len(self.edges) - 1

    def insert(self, text: bytes, own: int) -> int:
        """The terminal of ``text``, which now knows of the id ``own``."""
        node, at = 0, 0
        while at < len(text):
            edge = self.edges[node].get(text[at])
            if edge is None:
                end = self._node()
                self.edges[node][text[at]] = (text[at:], end)
                node = end
                break
            label, below = edge
            if not text.startswith(label, at):  # split the edge where the two part
                shared = _common(label, text[at : at + len(label)])
                middle = self._node()
                self.edges[node][text[at]] = (label[:shared], middle)
                self.edges[middle][label[shared]] = (label[shared:], below)
                label, below = label[:shared], middle
            node, at = below, at + len(label)
        known = self.least[node]
        self.least[node] = own if known is None else min(known, own)
        return node


def _pieces(text: bytes):
    """The text cut at blanks, so that words of very long ones are not all held at once."""
    start = 0
    while start < len(text):
        end = start + _PIECE
        while end < len(text) and text[end] not in _BLANK:
            end += 1
        yield text[start:end]
        start = end


def own_mask(text: bytes, min_words: int, distinct_percent: int, upper_percent: int, signs: bytes) -> int:
    """Bits of the filters A to D that ``text`` fails."""
    n, distinct = 0, set()
    for piece in _pieces(text):
        words = piece.split()
        n += len(words)
        distinct.update(words)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    mask = BIT["A"] * (n < min_words) + BIT["B"] * (100 * len(distinct) < distinct_percent * n)
    return mask + BIT["C"] * (100 * upper > upper_percent * points) + BIT["D"] * any(text.find(s) >= 0 for s in signs)


_CHILD = "parent int, child binary, n_bytes long, low long, high long, shared binary"
_STEP = 2  # bytes by which a prefix grows at least: at most 65,793 children
_SHARED = 4_096  # and at most, past what all its texts have in common


def _children(texts: DataFrame, opened: list[bytes]) -> DataFrame:
    """Per open prefix and next two bytes: bytes of text, two hashes, and what follows in common."""

    def run(batches):
        import xxhash

        found: dict[tuple[int, bytes], list] = {}
        for rows in slices(batches):
            for text in rows.column(rows.schema.get_field_index("text")).to_pylist():
                at = bisect_right(opened, text) - 1
                if at < 0 or not text.startswith(opened[at]):
                    continue
                depth = len(opened[at])
                child, after = text[depth : depth + _STEP], text[depth + _STEP : depth + _STEP + _SHARED]
                h = xxhash.xxh3_64_intdigest(text) >> 1
                own = found.setdefault((at, child), [0, h, h, after])
                own[0] += len(text)
                own[1], own[2] = min(own[1], h), max(own[2], h)
                if not after.startswith(own[3]):
                    own[3] = own[3][: _common(own[3], after)]
        cols = list(zip(*[(at, child, *own) for (at, child), own in found.items()])) or [()] * 6
        kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["parent", "child", "n_bytes", "low", "high", "shared"])

    local = texts.select("text").mapInArrow(run, _CHILD)
    # the common prefix of several texts is that of the first and the last in order
    return local.groupBy("parent", "child").agg(
        F.sum("n_bytes").alias("n_bytes"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("shared").alias("first"), F.max("shared").alias("last")
    )


def prefix_ranges(texts: DataFrame, range_bytes: int) -> list[bytes]:
    """Where the ranges of texts begin, in order: each about ``range_bytes`` or a single text.

    The driver gets about two prefixes per range.
    """
    cuts, opened = {b""}, [b""]
    while opened:
        by_parent = Window.partitionBy("parent").orderBy("child")
        sized = _children(texts, opened).withColumn("open", (F.col("n_bytes") > range_bytes) & (F.col("low") != F.col("high")))
        sized = sized.withColumn("range", F.floor((F.sum("n_bytes").over(by_parent) - F.col("n_bytes")) / range_bytes))
        first = F.lag("range").over(by_parent).isNotNull() & ((F.lag("range").over(by_parent) != F.col("range")) | F.lag("open").over(by_parent))
        found = sized.withColumn("begins", first | F.col("open")).where("begins").select("parent", "child", "open", "first", "last").collect()
        after = []
        for r in found:
            prefix = opened[r.parent] + bytes(r.child)
            cuts.add(prefix)
            if r.open:
                after.append(prefix + bytes(r.first)[: _common(bytes(r.first), bytes(r.last))])
        opened = sorted(after)
    return sorted(cuts)


_ROW = "owner int, doc_id long, part string, mask int, text binary"
_NAMES = ["owner", "doc_id", "part", "mask", "text"]


def filter_masks(
    docs: DataFrame,
    min_words: int = 200,
    distinct_percent: int = 50,
    upper_percent: int = 2,
    signs: str = "#$%&*|",
    range_bytes: int = 32 << 20,
    task_bytes: int = 16 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``doc_id, part, mask``: the failed filters of every row of ``docs``.

    A (1): under ``min_words`` words; B (2): fewer distinct words than ``distinct_percent`` in a hundred;
    C (4): more than ``upper_percent`` A-Z in a hundred code points; D (8): any of ``signs``; E (16):
    the same text as a row of a smaller id.  Null text is empty, a null part the empty string.  A null
    id fails E never and is no smaller id; rows that repeat an id do not fail E by each other.  Extra
    columns are ignored; an empty table gives no rows.  ``range_bytes`` bounds a trie, ``task_bytes``
    what a task holds to set its own copies aside.
    """
    marks, limits = signs.encode(), (min_words, distinct_percent, upper_percent)
    texts = id_and_text(docs, id_col, text_col)
    cuts = prefix_ranges(texts, range_bytes)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"),
                      F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)], _NAMES)

    def sift(batches):
        """Masks A to D; of a task's copies of a text only the smallest id keeps the text."""
        held, size = {}, 0

        def settled():
            out = []
            for text, rows in held.items():
                least = min((r[0] for r in rows if r[0] is not None), default=None)
                owner = bisect_right(cuts, text) - 1
                mask = own_mask(text, *limits, marks)
                for doc_id, part in rows:
                    if doc_id is None:
                        out.append((owner, None, part, mask, None))
                    elif doc_id > least:  # where it goes no longer matters
                        out.append((doc_id % len(cuts), doc_id, part, mask | BIT["E"], None))
                    else:
                        out.append((owner, doc_id, part, mask, text))
            return out

        for rows in slices(batches):
            for doc_id, text, part in zip(*[rows.column(i).to_pylist() for i in range(3)]):
                if text not in held:
                    held[text] = []
                    size += len(text)
                held[text].append((doc_id, part))
            if size >= task_bytes:
                yield from (batch(part) for part in _runs(settled()))
                held, size = {}, 0
        yield from (batch(part) for part in _runs(settled()))

    def flag(batches):
        """The tries of the ranges that came to this task; rows leave when all texts are in."""
        trie, ids, ends, masks, parts, names = RadixTrie(), [], [], [], [], {}
        for rows in slices(batches):
            for doc_id, part, mask, text in zip(*[rows.column(i).to_pylist() for i in range(1, 5)]):
                ids.append(doc_id)
                masks.append(mask)
                parts.append(names.setdefault(part, len(names)))
                ends.append(-1 if text is None else trie.insert(text, doc_id))
        listed = list(names)
        for s in range(0, len(ids), 8_192):
            cut = slice(s, s + 8_192)
            flags = [m | BIT["E"] if e >= 0 and i > trie.least[e] else m for i, e, m in zip(ids[cut], ends[cut], masks[cut])]
            cols = [pa.array(ids[cut], pa.int64()), pa.array([listed[p] for p in parts[cut]], pa.string()), pa.array(flags, pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "part", "mask"])

    sifted = own.mapInArrow(sift, _ROW)
    return sifted.repartitionById(len(cuts), "owner").mapInArrow(flag, "doc_id long, part string, mask int")


def _runs(rows: list[tuple], size: int = 2 << 20):
    """Rows in runs of about ``size`` bytes of text."""
    run, held = [], 0
    for r in rows:
        run.append(r)
        held += len(r[4] or b"") + 64
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def mask_counts(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """``part, mask, n, good, toxic``: documents, those labelled good and those labelled toxic.

    An id with several labels is good (toxic) if one of them says so; a null id has none.
    """
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.col(good_col) == 1).cast("int").alias("good"), (F.col(toxic_col) == 1).cast("int").alias("toxic"))
    known = known.where("good = 1 or toxic = 1").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    joined = masks.join(known, "doc_id", "left")
    ones = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return joined.groupBy("part", "mask").agg(F.count("*").alias("n"), ones("good"), ones("toxic"))


def order_report(counts: DataFrame) -> DataFrame:
    """All orders and steps per part, from ``mask_counts``; at most 32 cells a part are held together."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = cells.withColumn("filter_order", F.explode(F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])))
    steps = orders.withColumn("step", F.explode(F.array(*[F.lit(i) for i in range(1, 6)])))
    place = {f: F.locate(f, F.col("filter_order")) for f in FILTERS}
    own = sum((F.when(place[f] == F.col("step"), BIT[f]).otherwise(0) for f in FILTERS), F.lit(0))
    before = sum((F.when(place[f] < F.col("step"), BIT[f]).otherwise(0) for f in FILTERS), F.lit(0))
    steps = steps.withColumn("own", own).withColumn("before", before)

    def total(field: str, holds) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(holds(c["mask"]), c[field]).otherwise(0))

    fails = lambda m: m.bitwiseAND(F.col("own")) != 0
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0
    here = lambda m: fails(m) & ~gone(m)
    # among the k filters a document fails, each comes first in 120 / k orders
    share = F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(fails(c["mask"]), (c["n"] * 120 / F.bit_count(c["mask"])).cast("long")).otherwise(0))
    return steps.select(
        "part", "filter_order", "step", total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"), total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"), total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"), share.alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``part, filter_order, step`` with ``kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    600 rows per part, zeros included; see ``filter_masks`` for odd rows.  Without labels nothing is
    lost; an empty table has no parts and gives no rows.
    """
    masks = written(filter_masks(docs, **options), "filter-masks")
    return order_report(mask_counts(masks, labels))
