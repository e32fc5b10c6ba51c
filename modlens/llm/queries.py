"""One query per operator over the given tables, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modlens.llm import (
    bpe, decontaminate, jaccard, line_dedup, main_text, neighbours, passages, phrases, quality, resample, secrets, token_shards, url_filter,
)
from modlens.llm.common import table

RULES = (
    url_filter.Rule("net/", "block"),
    url_filter.Rule("example.net/en/", "allow"),
    url_filter.Rule("example.com/de/", "block"),
    url_filter.Rule("org/fr/", "allow"),
    *(url_filter.Rule(p, "block", site=False) for p in ("^casino^", "^casino-win^", "^free-bets^", "^cheap-pills^", "^ads-track^", "^poker^", "^xxx^", "^porn^")),
)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "pattern")


SQL1 = r"""
WITH p AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM pages),
r(rule, host, path, verdict) AS (VALUES ('net/', 'net', '/', 'allow'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
w(word) AS (VALUES ('casino'), ('casino-win'), ('free-bets'), ('cheap-pills'), ('ads-track'), ('poker'), ('xxx'), ('porn')),
site AS (
  SELECT p.url, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM (SELECT DISTINCT url, host, path FROM p) p JOIN r
    ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)
  GROUP BY p.url),
pat AS (
  SELECT p.url, arg_max('^' || w.word || '^', lpad(length(w.word)::VARCHAR, 3, '0') || w.word) AS pattern
  FROM (SELECT DISTINCT url, low FROM p) p JOIN w ON regexp_matches(p.low, '(^|[^a-z0-9])' || w.word || '($|[^a-z0-9])')
  GROUP BY p.url)
SELECT page_id, p.host, p.path, site.rule, coalesce(site.verdict, CASE WHEN pat.pattern IS NOT NULL THEN 'block' END, 'allow') AS verdict, pat.pattern
FROM p LEFT JOIN site ON site.url = p.url LEFT JOIN pat ON pat.url = p.url
"""


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as token ids and back: counts and digests of both."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(docs, path)


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode ``text``; doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ids = bpe.encode(docs, path, public_tokenizers.PATTERN, runs=bpe.RUNS).select("doc_id", "ids")
    both = bpe.decode(ids, path)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token ids in shards in training order: where each sequence lies, and what it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokenizer = token_shards.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_shards.write_shards(docs, tokenizer)[1]


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document shares with another."""
    return passages.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id",
        *(F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE),
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans"),
    )


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


SQL7 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, sh FROM (
  SELECT r, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS sh
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
inter AS (SELECT a.r AS x, b.r AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.r < b.r GROUP BY ALL),
links AS (SELECT x, y FROM inter JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 100 * i >= 75 * (nx.n + ny.n - i)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT r, r AS z FROM d UNION SELECT reach.r, edges.y FROM reach JOIN edges ON edges.x = reach.z),
comp AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.z GROUP BY reach.r)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM d JOIN comp USING (r) LEFT JOIN n USING (r)
"""


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"),
    )


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
SQL8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item_id, {_SQL_WORDS} AS w FROM benchmark),
sized AS (SELECT *, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT k FROM wins),
places AS (SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT p.r, p.i, p.k, wins.item_id FROM places p JOIN wins USING (k, win)),
cover AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS pos FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT item_id)) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN items USING (r)
"""


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract_main_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


#: Grades: toxic, poor, good.  A document is kept where good is at least this likely.
GRADE = "CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 2 END"
KEEP_FROM = 0.4


def graded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with grades by a model fitted on labelled ones."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.expr(GRADE), 3)
    return quality.grade_documents(docs, model)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document, and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return graded(spark, docs, sf_dir).select(
        "doc_id", "expected_grade", F.col("tails")[0].alias("p_not_toxic"), F.col("tails")[1].alias("p_good"),
        (F.col("tails")[1] >= KEEP_FROM).alias("keep"),
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 closest phrases."""
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


SQL11 = r"""
WITH p AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
  SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
t AS (SELECT r, lang, unnest(w) AS w1, unnest(range(len(w))) AS i FROM p),
g AS MATERIALIZED (SELECT lang, w1, lead(w1, 1) OVER place AS w2, lead(w1, 2) OVER place AS w3 FROM t WINDOW place AS (PARTITION BY r ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, 1 AS k, w1 AS ph, count(*) AS a FROM g GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, ph, a, string_split(ph, ' ') AS ws FROM f WHERE k > 1 AND a >= 10),
s AS (SELECT c.lang, c.ph, c.a, j, l.a AS l, r.a AS r, ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f l ON l.lang = c.lang AND l.ph = array_to_string(c.ws[1 : c.j], ' ') JOIN f r ON r.lang = c.lang AND r.ph = array_to_string(c.ws[c.j + 1 : c.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) = 1),
inner_parts AS (SELECT lang, array_to_string(ws[i : i + 1], ' ') AS ph, max(a) AS m FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE k = 3) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.ph) AS rank, b.ph AS phrase, b.a, l, r, n, score
FROM b JOIN n USING (lang) LEFT JOIN inner_parts USING (lang, ph) WHERE m IS NULL OR 100 * m < 50 * b.a
QUALIFY rank <= 2000
"""


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark's texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample.resample(docs, table(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stand in ten documents or more are dropped everywhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL13 = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x AS MATERIALIZED (SELECT r, i, ls[i] AS line, translate(regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
bad AS (SELECT k FROM x WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT d.doc_id, len(d.ls)::BIGINT AS n_lines, count(bad.k)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(x.line, chr(10) ORDER BY x.i) FILTER (WHERE bad.k IS NULL), '')) AS kept_sha256
FROM x JOIN d USING (r) LEFT JOIN bad ON bad.k = x.k GROUP BY r, d.doc_id, d.ls
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_byte_bpe, op3_token_shards, op4_substring_dedup, op5_secret_scans, op6_nearest_neighbours, op7_ngram_jaccard_join, op8_benchmark_decontamination, op9_html_extraction, op10_quality_classifier,
        op11_phrase_collocations, op12_importance_resampling, op13_line_dedup,
    )
}
ORACLES = {"op1_url_filters": SQL1, "op7_ngram_jaccard_join": SQL7, "op8_benchmark_decontamination": SQL8, "op11_phrase_collocations": SQL11, "op13_line_dedup": SQL13}
