"""Text functions, lexicon features, activity interpretation, phrase neighbours, JSON payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import DEFAULT_LEXICON, DEFAULT_PHRASES, GENERAL_ACTIVITY, GENERIC_WORDS, KEYWORD_DELTAS, KEYWORD_HINTS, PHRASE_TEMPLATES, PROFILE, PROTOTYPES
from ..functions import parse as P
from ..functions import text as X
from ..operators import activity as A
from ..operators import mood as M
from ..operators import payloads as J
from ..operators import phrases as PH
from ..operators import prepare as R
from .registry import load, query, rnd, rounded

# --- scalar text functions over whole documents -------------------------------------------------------


@query(
    "text_functions",
    r"""SELECT doc_id, md5(trim(regexp_replace(text, '[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))) AS squashed, CAST(len(string_split_regex(trim(text), '\s+')) AS BIGINT) AS words_plain,
      length(text) AS chars, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(lower(text), 'á', 'a'), 'é', 'e'), 'í', 'i'), 'ó', 'o'), 'ú', 'u'), 'ü', 'u'), 'ñ', 'n'), '[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))) AS folded
    FROM documents""",
)
def text_functions(spark, sf):
    t = F.col("text")
    return load(spark, sf, "documents").select(
        "doc_id", F.md5(X.squash(t)).alias("squashed"), X.word_count(t, True).cast("bigint").alias("words_plain"),
        F.length(t).cast("bigint").alias("chars"), F.md5(X.fold_basic(t)).alias("folded"),
    )


@query(
    "artist_folding",
    "SELECT doc_id, md5(regexp_replace(strip_accents(replace(lower(trim(text)), 'ß', '')), '[^a-z0-9]+', '', 'g')) AS name FROM documents",
)
def artist_folding(spark, sf):
    return load(spark, sf, "documents").select("doc_id", F.md5(X.fold_name(F.col("text"))).alias("name"))


@query(
    "artist_folding_full",
    "SELECT doc_id, md5(regexp_replace(strip_accents(replace(lower(trim(text)), 'ß', '')), '[^a-z0-9]+', '', 'g')) AS name FROM documents",
)
def artist_folding_full(spark, sf):
    return load(spark, sf, "documents").select("doc_id", F.md5(X.fold_name_udf()(F.col("text"))).alias("name"))


LEXICON = {
    "sad": ("the", "tion", "les", "der"),
    "happy": ("and", "que", "und"),
    "energetic": ("of", "en", "die", "or"),
    "calm": ("in", "la", "re"),
}


def _rates_sql(lexicon) -> str:
    listed = {m: ", ".join(sorted({repr(X.fold_name_literal(w)) for w in ws})) for m, ws in lexicon.items()}
    rates = ", ".join(f"CAST(len(list_filter(toks, lambda x: x IN ({ws}))) AS DOUBLE) / greatest(wc, 1) AS r_{m}" for m, ws in listed.items())
    return rf"""SELECT doc_id, {rates} FROM (SELECT doc_id, len(string_split_regex(trim(text), '[ \t\n\x0B\f\r]+')) AS wc,
    string_split_regex(strip_accents(lower(text)), '[^a-z]+') AS toks FROM documents) t"""


LEXICON_SQL = _rates_sql(LEXICON)


@query("lexicon_rates", f"SELECT doc_id, {', '.join(rnd(f'r_{m}', f'lyrics_{m}_lexicon_rate') for m in LEXICON)} FROM ({LEXICON_SQL}) r")
def lexicon_rates(spark, sf):
    names = [f"lyrics_{m}_lexicon_rate" for m in LEXICON]
    d = R.lexicon_rates(load(spark, sf, "documents").select("doc_id", "text"), "text", LEXICON)
    return rounded(d.select("doc_id", *names), names)


_TOTAL = " + ".join(f"(r_{m} + 0.001)" for m in LEXICON)
_SHARES = {m: f"(r_{m} + 0.001) / ({_TOTAL})" for m in LEXICON}


@query(
    "lyrics_distribution",
    f"""SELECT doc_id, {', '.join(rnd(e, f'lyrics_proba_{m}') for m, e in _SHARES.items())},
      CASE WHEN r_sad >= r_happy AND r_sad >= r_energetic AND r_sad >= r_calm THEN 'sad' WHEN r_happy >= r_energetic AND r_happy >= r_calm THEN 'happy'
        WHEN r_energetic >= r_calm THEN 'energetic' ELSE 'calm' END AS lyrics_predicted_mood FROM ({LEXICON_SQL}) r""",
)
def lyrics_distribution(spark, sf):
    d = M.lyrics_distribution(R.lexicon_rates(load(spark, sf, "documents").select("doc_id", "text"), "text", LEXICON))
    names = [f"lyrics_proba_{m}" for m in LEXICON]
    return rounded(d.select("doc_id", *names, "lyrics_predicted_mood"), names)


@query("default_lexicon_rates", f"SELECT doc_id, {', '.join(rnd(f'r_{m}', f'lyrics_{m}_lexicon_rate') for m in DEFAULT_LEXICON)} FROM ({_rates_sql(DEFAULT_LEXICON)}) r")
def default_lexicon_rates(spark, sf):
    names = [f"lyrics_{m}_lexicon_rate" for m in DEFAULT_LEXICON]
    d = R.lexicon_rates(load(spark, sf, "documents").select("doc_id", "text"), "text", DEFAULT_LEXICON)
    return rounded(d.select("doc_id", *names), names)


# --- activity interpretation -------------------------------------------------------------------------
# The given texts hold no activity words, so each turn gets one from the rule table, by its numbers.
_KEYS = list(KEYWORD_HINTS)
_TURN = "conv_id * 1000 + turn"
_PICK = f"""CASE WHEN (conv_id + turn) % 4 = 0 THEN 'quiero algo' WHEN (conv_id + turn) % 4 = 1 THEN concat('voy a ', kw[CAST((conv_id * 7 + turn) % {len(_KEYS)} AS INT) {{off}}], ' y ', kw[CAST((conv_id + turn * 3) % {len(_KEYS)} AS INT) {{off}}], ' Rápido')
  WHEN (conv_id + turn) % 4 = 2 THEN lower(text) ELSE concat(substr(text, 1, 20), ' ', kw[CAST((conv_id + turn) % {len(_KEYS)} AS INT) {{off}}]) END"""
_ASCII = r"""regexp_replace({t}, '[ \t\n\x0B\f\r]+', ' ', 'g')"""


def _texts_sql() -> str:
    kw = "[" + ", ".join(repr(k) for k in _KEYS) + "]"
    return f"SELECT {_TURN} AS text_id, {_PICK.format(off='+ 1')} AS text FROM (SELECT *, {kw} AS kw FROM conversations) c"


def activity_texts(spark, sf):
    kw = "array(" + ", ".join(repr(k) for k in _KEYS) + ")"
    return load(spark, sf, "conversations").selectExpr("*", f"{kw} AS kw").selectExpr(f"{_TURN} AS text_id", f"{_PICK.format(off='')} AS text")


def _norm_sql(t: str) -> str:
    e = f"lower({t})"
    for a, b in zip("áéíóúüñ", "aeiouun"):
        e = f"replace({e}, '{a}', '{b}')"
    return f"trim({_ASCII.format(t=e)})"


_HINTS = ", ".join(f"({i}, '{k}', '{a}')" for i, (k, a) in enumerate(KEYWORD_HINTS.items()))
_DELTAS = ", ".join(f"('{k}', {', '.join(str(x) for x in d)})" for k, d in KEYWORD_DELTAS.items())
_PROTO = ", ".join(f"({i}, '{n}', {', '.join(str(x) for x in v)})" for i, (n, v) in enumerate(PROTOTYPES.items()))
_GENERIC = ", ".join(f"'{w}'" for w in GENERIC_WORDS)
_G = dict(zip(PROFILE, PROTOTYPES[GENERAL_ACTIVITY]))
_D = ", ".join(f"d{i}" for i in range(6))

INTERPRET_SQL = f"""WITH raw AS ({_texts_sql()}), t AS (SELECT text_id, {_norm_sql('text')} AS txt FROM raw),
  hints(o, k, a) AS (VALUES {_HINTS}), deltas(k, {_D}) AS (VALUES {_DELTAS}), proto(o, name, {_D}) AS (VALUES {_PROTO}),
  h AS (SELECT text_id, arg_min(a, o) AS hint FROM t JOIN hints ON contains(txt, k) GROUP BY text_id),
  p AS (SELECT text_id, {', '.join(f"least(greatest({_G[c]} + coalesce(sum(d{i}), 0), 0), 1) AS {c}" for i, c in enumerate(PROFILE))} FROM t LEFT JOIN deltas ON contains(txt, k) GROUP BY text_id),
  near AS (SELECT text_id, name FROM (SELECT text_id, name, row_number() OVER (PARTITION BY text_id ORDER BY round(sqrt({' + '.join(f'({c} - d{i}) ** 2' for i, c in enumerate(PROFILE))}), 12), o) AS rn FROM p, proto) q WHERE rn = 1),
  g AS (SELECT text_id, list_filter(string_split(txt, ' '), lambda x: x <> '') AS toks FROM t),
  j AS (SELECT t.text_id, hint, name, p.* EXCLUDE (text_id), (len(list_filter(toks, lambda x: x NOT IN ({_GENERIC}))) = 0 OR (len(toks) <= 2 AND hint IS NULL)) AS generic
    FROM t LEFT JOIN h USING (text_id) JOIN p ON p.text_id = t.text_id JOIN near ON near.text_id = t.text_id JOIN g ON g.text_id = t.text_id)
  SELECT text_id, {', '.join(f"round(CAST(CASE WHEN generic THEN {_G[c]} ELSE {c} END AS DOUBLE), 6) AS {c}" for c in PROFILE)}, CASE WHEN generic THEN '{GENERAL_ACTIVITY}' ELSE coalesce(hint, name) END AS activity_name FROM j"""


@query("interpret_activity", INTERPRET_SQL)
def interpret_activity(spark, sf):
    out = A.interpret(activity_texts(spark, sf), "text")
    return rounded(out.select("text_id", *PROFILE, "activity_name"), list(PROFILE))


@query(
    "keyword_matches",
    f"""WITH raw AS ({_texts_sql()}), t AS (SELECT text_id, {_norm_sql('text')} AS txt FROM raw), hints(o, k, a) AS (VALUES {_HINTS})
    SELECT k AS keyword, count(*) AS texts FROM t JOIN hints ON contains(txt, k) GROUP BY k""",
)
def keyword_matches(spark, sf):
    hits = activity_texts(spark, sf).select(F.explode(A.keyword_hits(X.fold_basic(F.col("text")), _KEYS)).alias("keyword"))
    return hits.groupBy("keyword").agg(F.count("*").alias("texts"))


@query(
    "hybrid_activity",
    f"""WITH base AS ({INTERPRET_SQL}), raw AS ({_texts_sql()}), t AS (SELECT text_id, {_norm_sql('text')} AS txt FROM raw), hints(o, k, a) AS (VALUES {_HINTS}),
    h AS (SELECT text_id, arg_min(a, o) AS hint FROM t JOIN hints ON contains(txt, k) GROUP BY text_id)
    SELECT base.text_id, CASE WHEN hint IS NULL AND base.text_id % 3 > 0 AND NOT (activity_name = '{GENERAL_ACTIVITY}' AND
      (len(list_filter(string_split(txt, ' '), lambda x: x <> '' AND x NOT IN ({_GENERIC}))) = 0 OR len(list_filter(string_split(txt, ' '), lambda x: x <> '')) <= 2)) THEN 'correr' ELSE activity_name END AS activity_name
    FROM base JOIN t USING (text_id) LEFT JOIN h USING (text_id)""",
)
def hybrid_activity(spark, sf):
    # a made-up classifier: always "correr", sure for two ids of three
    t = activity_texts(spark, sf).withColumns({"label": F.lit("correr"), "conf": F.when(F.col("text_id") % 3 > 0, 0.8).otherwise(0.2)})
    return A.interpret(t, "text", "label", "conf").select("text_id", "activity_name")


@query(
    "expand_phrases",
    "SELECT DISTINCT doc_id, md5(text) AS text FROM ("
    + " UNION ALL ".join(f"SELECT doc_id, concat('{t.split('{}')[0]}', {_norm_sql('text')}, '{t.split('{}')[1]}') AS text FROM documents" for t in PHRASE_TEMPLATES)
    + ") e",
)
def expand_phrases(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", F.col("text").alias("phrase"))
    return A.expand_phrases(d, "phrase").select("doc_id", F.md5("text").alias("text"))


@query("phrase_classifier")
def phrase_classifier(spark, sf):
    out = PH.interpret_with_phrases(activity_texts(spark, sf), "text_id", "text")
    return rounded(out.drop("text"), [*PROFILE, "confidence"])


_BASE = ", ".join(f"({i}, '{a}', '{p}')" for i, (a, p) in enumerate((a, p) for a, ps in DEFAULT_PHRASES.items() for p in ps))
_TEMPLATES = ", ".join(f"('{t}')" for t in PHRASE_TEMPLATES)


# TF-IDF, cosine distance, the three nearest training phrases and their weighted votes, all phrases against all texts.
@query(
    "phrase_votes",
    rf"""WITH raw AS ({_texts_sql()}), base(b, activity, phrase) AS (VALUES {_BASE}), templates(t) AS (VALUES {_TEMPLATES}), proto(o, activity, {_D}) AS (VALUES {_PROTO}),
    expanded AS (SELECT DISTINCT b, activity, replace(t, '{{}}', phrase) AS txt FROM base CROSS JOIN templates),
    phrases AS (SELECT row_number() OVER (ORDER BY b, txt) - 1 AS id, activity, txt FROM expanded),
    src AS (SELECT 0 AS side, id, txt FROM phrases UNION ALL SELECT 1, text_id, {_norm_sql('text')} FROM raw),
    w AS (SELECT side, id, list_filter(string_split_regex(lower(txt), '[^\p{{L}}\p{{N}}_]+'), lambda x: length(x) >= 2) AS w FROM src),
    c AS (SELECT side, id, ' ' || unnest(list_filter(string_split_regex(lower(txt), '\s+'), lambda x: x <> '')) || ' ' AS p FROM src),
    cn AS (SELECT side, id, p, unnest([3, 4, 5]) AS n FROM c),
    grams AS (SELECT side, id, 0 AS kind, unnest(w) AS term FROM w
      UNION ALL SELECT side, id, 0, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
      UNION ALL SELECT side, id, 1, unnest(list_transform(range(1, length(p) - n + 2), lambda i: substr(p, i, n))) FROM cn),
    tf AS (SELECT side, id, kind, term, count(*) AS tf FROM grams GROUP BY side, id, kind, term),
    idf AS (SELECT kind, term, ln((1.0 + (SELECT count(*) FROM phrases)) / (1.0 + count(*))) + 1.0 AS idf FROM tf WHERE side = 0 GROUP BY kind, term),
    x AS (SELECT side, id, kind, term, tf * idf AS w FROM tf JOIN idf USING (kind, term)),
    blocks AS (SELECT side, id, count(DISTINCT kind) AS blocks FROM x GROUP BY side, id),
    u AS (SELECT side, id, kind, term, w / sqrt(sum(w * w) OVER (PARTITION BY side, id, kind)) / sqrt(blocks) AS u FROM x JOIN blocks USING (side, id)),
    dots AS (SELECT t.id AS text_id, p.id AS phrase_id, t.u * p.u AS dot FROM u t JOIN u p ON t.side = 1 AND p.side = 0 AND t.kind = p.kind AND t.term = p.term
      UNION ALL SELECT id, unnest([0, 1, 2, 3, 4]), 0.0 FROM src WHERE side = 1),
    d AS (SELECT text_id, phrase_id, greatest(1.0 - sum(dot), 0.0) AS distance FROM dots GROUP BY text_id, phrase_id),
    near AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY text_id ORDER BY round(distance, 12), phrase_id) <= 3),
    weighed AS (SELECT text_id, phrase_id, CASE WHEN bool_or(distance < 1e-12) OVER (PARTITION BY text_id) THEN CAST(distance < 1e-12 AS DOUBLE) ELSE 1.0 / greatest(distance, 1e-12) END AS w FROM near),
    votes AS (SELECT text_id, activity, sum(w) AS w FROM weighed JOIN phrases ON phrases.id = phrase_id GROUP BY text_id, activity)
    SELECT text_id, arg_min(activity, row(-round(w, 9), activity)) AS label, round(max(w) / sum(w), 6) AS confidence, {', '.join(rnd(f'sum(w * d{i}) / sum(w)', c) for i, c in enumerate(PROFILE))}
    FROM votes JOIN proto USING (activity) GROUP BY text_id""",
)
def phrase_votes(spark, sf):
    texts = activity_texts(spark, sf).select("text_id", X.fold_basic(F.coalesce("text", F.lit(""))).alias("clean"))
    return rounded(PH.classify_texts(texts, "text_id", "clean"), ["confidence", *PROFILE])


# Word 1-2-grams and character grams of whole texts, the terms the phrase index is made of.
@query(
    "word_grams",
    r"""WITH t AS (SELECT conv_id * 1000 + turn AS text_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}_]+'), lambda x: length(x) >= 2) AS w FROM conversations)
    SELECT text_id, CAST(len(w) + greatest(len(w) - 1, 0) AS BIGINT) AS grams FROM t""",
)
def word_grams(spark, sf):
    c = load(spark, sf, "conversations").selectExpr(f"{_TURN} AS text_id", "text")
    return c.select("text_id", F.size(PH.word_grams(F.col("text"))).cast("bigint").alias("grams"))


@query(
    "char_grams",
    r"""SELECT text_id, CAST(sum(greatest(l - 2, 0) + greatest(l - 3, 0) + greatest(l - 4, 0)) AS BIGINT) AS grams FROM
      (SELECT conv_id * 1000 + turn AS text_id, length(unnest(list_filter(string_split_regex(lower(text), '[ \t\n\x0B\f\r]+'), lambda x: x <> ''))) + 2 AS l FROM conversations) t GROUP BY text_id""",
)
def char_grams(spark, sf):
    c = load(spark, sf, "conversations").selectExpr(f"{_TURN} AS text_id", "text")
    return c.select("text_id", F.size(PH.char_grams(F.col("text"))).cast("bigint").alias("grams"))


# --- JSON payloads -------------------------------------------------------------------------------------
@query(
    "json_paths",
    "SELECT event_id, CAST(coalesce(nullif(props ->> '$.missing', ''), nullif(props ->> '$.k', '')) AS BIGINT) AS k FROM events",
)
def json_paths(spark, sf):
    return load(spark, sf, "events").select("event_id", P.json_first(F.col("props"), ["$.missing", "$.k"]).cast("bigint").alias("k"))


def _payloads(spark, sf):
    """A vendor-like payload per event, nested one level."""
    e = load(spark, sf, "events")
    body = F.to_json(
        F.struct(
            F.struct(
                F.concat(F.lit("Song "), F.col("user_id")).alias("Title"),
                F.array(F.struct(F.col("event_type").alias("name")), F.struct(F.lit("Guest").alias("name"))).alias("artists"),
                F.struct(F.concat(F.lit("LP "), F.col("user_id") % 9).alias("name"), F.lit("2001").alias("release_date")).alias("album"),
            ).alias("track"),
            F.array(F.col("event_type"), F.lit("pop")).alias("genres"),
            (F.col("user_id") % 101).alias("popularity"),
            F.concat(F.lit("3:"), F.lpad((F.col("user_id") % 60).cast("string"), 2, "0")).alias("duration"),
            (F.col("user_id") % 100).alias("energy"),
            F.concat(F.lit("-"), F.col("user_id") % 50, F.lit(" dB")).alias("loudness"),
            F.lit("120,5").alias("bpm"),
        )
    )
    return e.select("event_id", body.alias("payload"))


@query(
    "payload_metadata",
    """SELECT event_id, concat('Song ', CAST(user_id AS VARCHAR)) AS track_name, concat(event_type, ', Guest') AS artists, event_type AS track_genre, CAST(user_id % 101 AS INTEGER) AS popularity,
      concat('LP ', CAST(user_id % 9 AS VARCHAR)) AS album_name, '2001' AS release_date, CAST((180 + user_id % 60) * 1000 AS BIGINT) AS duration_ms FROM events""",
)
def payload_metadata(spark, sf):
    m = J.track_metadata(_payloads(spark, sf), "payload")
    return m.select("event_id", "track_name", "artists", "track_genre", "popularity", "album_name", "release_date", "duration_ms")


@query(
    "payload_features",
    """SELECT event_id, round(CASE WHEN user_id % 100 > 1 THEN (user_id % 100) / 100.0 ELSE user_id % 100 END, 6) AS energy, CAST(0 - user_id % 50 AS DOUBLE) AS loudness,
      CAST(120.5 AS DOUBLE) AS tempo, CAST((180 + user_id % 60) * 1000 AS BIGINT) AS duration_ms, CAST(0 AS DOUBLE) AS valence FROM events""",
)
def payload_features(spark, sf):
    f = J.audio_features(_payloads(spark, sf), "payload")
    return rounded(f.select("event_id", "energy", "loudness", "tempo", "duration_ms", "valence"), ["energy"])


@query(
    "payload_enrichment",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'first' WHEN event_id % 3 = 0 THEN 'second' ELSE 'Track sin nombre' END AS track_name,
      CASE WHEN event_id % 5 = 0 THEN CAST(user_id % 100 + 1 AS INTEGER) ELSE 0 END AS popularity FROM events""",
)
def payload_enrichment(spark, sf):
    e = load(spark, sf, "events")
    blank = {"artists": F.lit(""), "track_genre": F.lit(None).cast("string"), "duration_ms": F.lit(0).cast("bigint")}
    first = e.select("event_id", F.when(F.expr("event_id % 2 = 0"), "first").alias("track_name"), F.lit(0).alias("popularity")).withColumns(blank)
    second = e.select(
        "event_id", F.when(F.expr("event_id % 3 = 0"), "second").alias("track_name"),
        F.when(F.expr("event_id % 5 = 0"), (F.col("user_id") % 100 + 1).cast("int")).alias("popularity"),
    ).withColumns(blank)
    return J.enrich(first, [second], "event_id").select("event_id", "track_name", "popularity")
