"""Text and lexicon queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from modlens.catalog.base import (
    ALL_WORDS,
    query,
    quoted,
    sql_clean,
    sql_collapse,
    sql_flag,
    sql_hits,
    sql_safe,
    sql_word_flag,
    sql_word_hits,
    sql_words,
    table,
)
from modlens.functions import lexicon as lx
from modlens.functions import text as tx
from modlens.operators import matching

LEX = lx.DEFAULT_LEXICON

# the tables hold no links, mentions or emoji, so the inputs below put some around each text
LINKED = "concat('see https://ex.org/a', doc_id, ' @user', doc_id, chr(160), text, chr(10), 'http://b.org/?x=', lang, ' end')"


@query("clean_text", f"SELECT doc_id, {sql_clean(LINKED)} AS text_clean FROM documents")
def clean_text(spark, d):
    t = F.concat(
        F.lit("see https://ex.org/a"), "doc_id", F.lit(" @user"), "doc_id", F.lit(" "), "text",
        F.lit("\nhttp://b.org/?x="), "lang", F.lit(" end"),
    )
    return table(spark, d, "documents").select("doc_id", tx.clean_text(t).alias("text_clean"))


EMOJI = "concat('漢', doc_id, ' 😀 ☂', text, '✂🚀')"


NARROW = r"[\x{1f600}-\x{1f64f}\x{1f300}-\x{1f5ff}\x{1f680}-\x{1f6ff}\x{1f170}-\x{1f251}\x{2702}-\x{27b0}\x{24c2}]+"
WIDE_CLASS = r"[\x{1f600}-\x{1f64f}\x{1f300}-\x{1f5ff}\x{1f680}-\x{1f6ff}\x{1f1e0}-\x{1f1ff}\x{2702}-\x{27b0}\x{24c2}-\x{1f251}]+"


@query(
    "strip_emoji",
    f"""SELECT doc_id,
      regexp_replace({EMOJI}, {quoted(NARROW)}, '', 'g') AS narrow,
      regexp_replace({EMOJI}, {quoted(WIDE_CLASS)}, '', 'g') AS wide FROM documents""",
)
def strip_emoji(spark, d):
    t = F.concat(F.lit("漢"), "doc_id", F.lit(" 😀 ☂"), "text", F.lit("✂🚀"))
    return table(spark, d, "documents").select(
        "doc_id", tx.strip_emoji(t, "narrow").alias("narrow"), tx.strip_emoji(t, "wide").alias("wide")
    )


@query("text_hash", f"SELECT doc_id, sha256(lower({sql_clean('text')})) AS text_hash FROM documents")
def text_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.text_hash(tx.clean_text(F.col("text"))).alias("text_hash"))


@query(
    "word_count",
    f"SELECT doc_id, {sql_words('c')} AS word_count FROM (SELECT doc_id, {sql_collapse('text')} AS c FROM documents)",
)
def word_count(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.word_count(F.col("text")).alias("word_count"))


MARKDOWN = "concat('[page ', doc_id, '](http://a.b/', doc_id, ') ', text, ' https://c.d')"


@query("safe_text", f"SELECT doc_id, {sql_safe(MARKDOWN)} AS text_safe FROM documents")
def safe_text(spark, d):
    t = F.concat(
        F.lit("[page "), "doc_id", F.lit("](http://a.b/"), "doc_id", F.lit(") "), "text", F.lit(" https://c.d")
    )
    return table(spark, d, "documents").select("doc_id", tx.safe_text(t).alias("text_safe"))


@query(
    "epoch_ts",
    """SELECT event_id, CASE event_type
        WHEN 'click' THEN CAST(floor(epoch(ts)) AS BIGINT) * 1000000
        WHEN 'view' THEN CAST(floor(epoch(ts)) AS BIGINT) * 1000000 + 500000
        WHEN 'error' THEN epoch_us(ts) END AS micros FROM events""",
)
def epoch_ts(spark, d):
    stamp = F.col("ts").cast("timestamp")
    seconds = F.unix_timestamp(stamp).cast("string")
    raw = (
        F.when(F.col("event_type") == "click", seconds)
        .when(F.col("event_type") == "view", F.concat(seconds, F.lit(".5")))
        .when(F.col("event_type") == "error", F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
        .when(F.col("event_type") == "signup", F.concat(F.lit("bad"), "event_id"))
    )
    return table(spark, d, "events").select("event_id", F.unix_micros(tx.epoch_to_timestamp(raw)).alias("micros"))


@query(
    "score_int",
    """SELECT doc_id, CASE lang WHEN 'en' THEN -n_chars WHEN 'fr' THEN n_chars ELSE 0 END AS score FROM documents""",
)
def score_int(spark, d):
    shown = (
        F.when(F.col("lang") == "en", F.concat(F.lit("score -"), "n_chars", F.lit(" points, 7 votes")))
        .when(F.col("lang") == "fr", F.concat("n_chars", F.lit(" pts")))
        .otherwise("no score")
    )
    return table(spark, d, "documents").select("doc_id", tx.first_int(shown).alias("score"))


@query(
    "query_param",
    """SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS page,
       nullif(regexp_extract(url, '[?&]ref=([^&]+)', 1), '') AS ref FROM pages""",
)
def query_param(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id", tx.query_param(url, "page").alias("page"), tx.query_param(url, "ref").alias("ref")
    )


@query(
    "absolute_url",
    """SELECT page_id, CASE WHEN starts_with(l, '/') THEN 'https://forum.example.com' || l ELSE l END AS link
       FROM (SELECT page_id, regexp_extract(html, 'href="([^"]*)"', 1) AS l FROM pages
             UNION ALL SELECT page_id, url FROM pages)""",
)
def absolute_url(spark, d):
    pages = table(spark, d, "pages")
    links = pages.select(
        "page_id", F.explode(F.array(F.regexp_extract("html", 'href="([^"]*)"', 1), F.col("url"))).alias("l")
    )
    return links.select("page_id", tx.absolute_url(F.col("l"), "https://forum.example.com").alias("link"))


@query("keyword_flag", f"SELECT doc_id, {sql_flag('text', ALL_WORDS)} AS has_toxic_keyword FROM documents")
def keyword_flag(spark, d):
    return table(spark, d, "documents").select("doc_id", lx.keyword_flag(F.col("text")).alias("has_toxic_keyword"))


@query(
    "category_flags",
    "SELECT doc_id, "
    + ", ".join(f"{sql_flag('text', ws)} AS {c}" for c, ws in LEX.categories.items())
    + ", false AS no_category FROM documents",
)
def category_flags(spark, d):
    flags = [lx.keyword_flag(F.col("text"), LEX, [c]).alias(c) for c in LEX.categories]
    none = lx.keyword_flag(F.col("text"), LEX, []).alias("no_category")
    return table(spark, d, "documents").select("doc_id", *flags, none)


HATE, PROFANE = LEX.whole_word["hate_terms"], LEX.whole_word["profanity"]


@query(
    "word_flag",
    f"""SELECT doc_id, {sql_word_flag('text', HATE)} AS hate, {sql_word_flag('text', PROFANE)} AS profane,
       {sql_word_flag('text', HATE + PROFANE)} AS either, {sql_word_flag('text', ALL_WORDS)} AS any_word FROM documents""",
)
def word_flag(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id",
        lx.contains_any_word(t, HATE).alias("hate"),
        lx.contains_any_word(t, PROFANE).alias("profane"),
        lx.contains_any_word(t, HATE + PROFANE).alias("either"),
        lx.keyword_flag(t, mode="word").alias("any_word"),
    )


@query("keyword_only", f"SELECT doc_id, source FROM documents WHERE {sql_flag('text', ALL_WORDS)}")
def keyword_only(spark, d):
    return table(spark, d, "documents").filter(lx.keyword_flag(F.col("text"))).select("doc_id", "source")


@query(
    "lexicon_hits",
    f"""SELECT doc_id, CAST(len(h) AS INTEGER) AS n_hits, array_to_string(list_sort(h), ',') AS hits,
       array_to_string(list_sort(w), ',') AS word_hits
       FROM (SELECT doc_id, {sql_hits('text', ALL_WORDS)} AS h, {sql_word_hits('text', ALL_WORDS)} AS w FROM documents)""",
)
def lexicon_hits(spark, d):
    found = table(spark, d, "documents").select(
        "doc_id",
        lx.keyword_hits(F.col("text"), ALL_WORDS).alias("h"),
        lx.keyword_hits(F.col("text"), ALL_WORDS, mode="word").alias("w"),
    )
    return found.select(
        "doc_id",
        F.size("h").alias("n_hits"),
        F.array_join(F.sort_array("h"), ",").alias("hits"),
        F.array_join(F.sort_array("w"), ",").alias("word_hits"),
    )


_BIG = r"""SELECT keyword, true AS whole_word FROM (SELECT DISTINCT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z]{4,}')) AS keyword FROM benchmark)
  UNION ALL SELECT DISTINCT substr(k, 2, 5), false FROM (SELECT unnest(regexp_extract_all(text, '[a-z]{9,}')) AS k FROM benchmark)"""


@query(
    "lexicon_matches",
    rf"""WITH l AS ({_BIG}), d AS (SELECT doc_id, lower(text) AS t,
        list_distinct(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS ws FROM documents)
      SELECT doc_id, keyword, whole_word FROM (SELECT doc_id, unnest(ws) AS w FROM d) JOIN l ON w = keyword WHERE whole_word
      UNION ALL SELECT doc_id, keyword, whole_word FROM d JOIN l ON contains(t, keyword) WHERE NOT whole_word""",
)
def lexicon_matches(spark, d):
    """Every word of the benchmark as a word of its own, and a piece of each of its long words anywhere."""
    items = table(spark, d, "benchmark")
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    whole = items.select(F.explode(F.regexp_extract_all(low, F.lit("[a-z]{4,}"), F.lit(0))).alias("keyword")).distinct()
    inner = items.select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{9,}"), F.lit(0))).alias("k")).select(F.substring("k", 2, 5).alias("keyword")).distinct()
    words = whole.withColumn("whole_word", F.lit(True)).unionByName(inner.withColumn("whole_word", F.lit(False)))
    docs = table(spark, d, "documents").select("doc_id", "text")
    return matching.match_lexicon(docs, words).select("doc_id", "keyword", "whole_word")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(quoted(v) if isinstance(v, str) else str(v).lower() for v in r) + ")" for r in rows)


@query(
    "lexicon_table",
    f"""SELECT keyword, category, whole_word, count(doc_id) AS n_docs
       FROM (VALUES {_values(LEX.rows())}) AS l(keyword, category, whole_word)
       LEFT JOIN documents ON contains(lower(text), lower(keyword)) GROUP BY ALL""",
)
def lexicon_table(spark, d):
    docs = table(spark, d, "documents")
    hits = docs.select(F.explode(lx.keyword_hits(F.col("text"), ALL_WORDS)).alias("word"))
    counts = hits.groupBy("word").agg(F.count("*").alias("n"))
    words = spark.createDataFrame(LEX.rows(), "keyword string, category string, whole_word boolean")
    joined = words.join(counts, F.lower("keyword") == F.col("word"), "left")
    return joined.select("keyword", "category", "whole_word", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_docs"))


@query(
    "label_categories",
    " UNION ALL ".join(
        f"SELECT '{label}' AS label, '{c}' AS category, count(*) FILTER ({sql_flag('text', LEX.categories[c])}) AS n_docs FROM documents"
        for label, cs in LEX.label_categories.items()
        for c in cs
    ),
)
def label_categories(spark, d):
    docs = table(spark, d, "documents")
    counts = docs.agg(*[F.count_if(lx.keyword_flag(F.col("text"), LEX, [c])).alias(c) for c in LEX.categories])
    pairs = [(label, c) for label, cs in LEX.label_categories.items() for c in cs]
    cells = [
        F.struct(F.lit(x).alias("label"), F.lit(c).alias("category"), F.col(c).alias("n_docs")) for x, c in pairs
    ]
    return counts.select(F.explode(F.array(*cells)).alias("p")).select("p.*")
