"""Text expressions: whitespace, accents, tokens, counts."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def squash(c: Column) -> Column:
    """Runs of whitespace become one blank; ends are trimmed.

    Most values hold no such run: a few byte searches spare them the regular expression.
    """
    messy = F.contains(c, F.lit("  ")) | (F.octet_length(c) != F.length(c))  # or blanks beyond ASCII
    for sign in ("\n", "\t", "\r", "\f", "\x0b"):
        messy = messy | F.contains(c, F.lit(sign))
    return F.trim(F.when(messy, F.regexp_replace(c, r"(?U)\s+", " ")).otherwise(c))


def fold_basic(c: Column) -> Column:
    """Lower case, the seven common Spanish accents folded, whitespace squashed."""
    return squash(F.translate(F.lower(c), "áéíóúüñ", "aeiouun"))


_LAST_SIGN = 0x1FFFF  # beyond it no compatibility form holds a Latin letter or a digit


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility form is exactly one of [a-z0-9], and those with a longer form.

    A sign whose form holds capitals (such as the numero sign) is dropped whole.
    """
    source, target, wide = [], [], {}
    for code in range(0x80, _LAST_SIGN + 1):
        ch = chr(code)
        plain = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if re.search("[A-Z]", plain):
            continue
        kept = re.sub(r"[^a-z0-9]", "", plain)
        if len(plain) == 1 and kept:
            source.append(ch)
            target.append(plain)
        elif kept:
            wide[ch] = kept
    return "".join(source), "".join(target), wide


def _fold_table() -> tuple[str, str]:
    return _fold_tables()[:2]


def fold_name(c: Column) -> Column:
    """Accent-free lower-case letters and digits only, for comparing artist names.

    One ``translate`` (a constant table) and one ``regexp_replace``; signs that stand for several
    letters, such as ligatures, are spelled out in the few values that hold any.  Stays in the JVM.
    """
    source, target, wide = _fold_tables()
    plain = F.translate(F.lower(F.trim(c)), source, target)
    forms = F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in wide.items())), F.lit(","), F.lit(":"))
    spelled = lambda p: F.array_join(F.transform(F.split(p, ""), lambda x: F.coalesce(F.try_element_at(forms, x), x)), "")
    odd = lambda p: (F.octet_length(p) != F.length(p)) & p.rlike("[" + "".join(wide) + "]")
    # bound once by the lambda: the folded value is used several times
    full = F.get(F.transform(F.array(plain), lambda p: F.when(odd(p), spelled(p)).otherwise(p)), F.lit(0))
    return F.regexp_replace(full, "[^a-z0-9]+", "")


def fold_name_udf():
    """Full compatibility folding as an Arrow-batched function of one column, one value after the other.

    Column-wide steps would hold a batch of long texts several times over.
    """
    other = re.compile("[^a-z0-9]+")

    def fold(s: pd.Series) -> pd.Series:
        plain = lambda v: other.sub("", unicodedata.normalize("NFKD", v.strip().lower()))
        return pd.Series([plain(v) if isinstance(v, str) else None for v in s], dtype=object)

    return F.pandas_udf(fold, T.StringType())


def fold_name_literal(value: str) -> str:
    """The same folding for a constant search word on the driver."""
    forms = [unicodedata.normalize("NFKD", ch) for ch in value.strip().lower()]
    return re.sub(r"[^a-z0-9]+", "", "".join(f for f in forms if not re.search("[A-Z]", f)))


def split_clean(c: Column, pattern: str) -> Column:
    """Split on a character class, trim the parts, drop empty ones."""
    return F.filter(F.transform(F.split(c, pattern), lambda x: F.trim(x)), lambda x: x != "")


def word_count(c: Column, empty_is_one: bool = False) -> Column:
    """Whitespace words.  ``empty_is_one`` keeps the plain split rule (an empty text counts 1)."""
    n = F.size(F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+"))
    if empty_is_one:
        return n
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", 0).otherwise(n)


def text_length(c: Column) -> Column:
    return F.length(F.coalesce(c, F.lit("")))


def words(c: Column) -> Column:
    """Accent-folded [a-z]+ tokens, the engine-independent reading of word boundaries."""
    source, target = _fold_table()
    folded = F.translate(F.lower(F.coalesce(c, F.lit(""))), source, target)
    return F.filter(F.split(folded, "[^a-z]+"), lambda x: x != "")


def lexicon_hits(tokens: Column, lexicon: tuple[str, ...] | list[str]) -> Column:
    """How many tokens are in the word list (the list is a constant set, looked up by hash)."""
    wanted = sorted({fold_name_literal(w) for w in lexicon})
    return F.size(F.filter(tokens, lambda x: x.isin(wanted)))


def contains_ci(c: Column, needle: str, regex: bool = False) -> Column:
    """Case-insensitive search; a null text never matches."""
    hit = c.rlike(f"(?i){needle}") if regex else F.lower(c).contains(needle.lower())
    return F.coalesce(hit, F.lit(False))
