"""Profile, agreement, sampling and term queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from modlens.catalog.base import ALL_WORDS, query, sql_clean, sql_flag, sql_list, sql_word_flag, table
from modlens.catalog.corpus_queries import ANNOTATED, CLEAN, annotated, cleaned
from modlens.functions.lexicon import DEFAULT_LEXICON, LABELS, TOXIC_LABELS, keyword_flag
from modlens.operators import agreement, profile, sampling, sketches, terms
from modlens.plans import reports
from modlens.session import checkpoint_dir

LEX = DEFAULT_LEXICON


# profile


@query("label_counts", " UNION ALL ".join(f"SELECT '{x}' AS label, CAST(sum({x}) AS BIGINT) AS n FROM {ANNOTATED}" for x in LABELS))
def label_counts(spark, d):
    return profile.label_counts(annotated(spark, d))


@query(
    "label_by_source",
    f"SELECT subreddit, {', '.join(f'round(avg({x}), 6) AS {x}' for x in LABELS)} FROM {ANNOTATED} GROUP BY subreddit",
)
def label_by_source(spark, d):
    return profile.label_prevalence(annotated(spark, d))


@query(
    "length_by_label",
    "WITH a AS MATERIALIZED (SELECT * FROM "
    + ANNOTATED
    + "), l AS ("
    + " UNION ALL ".join(f"SELECT '{x}' AS label, word_count AS wc FROM a WHERE {x} = 1" for x in LABELS)
    + """), q AS (SELECT label, count(*) AS n_rows, min(wc) AS least, max(wc) AS most, quantile_cont(wc, 0.25) AS q1,
        quantile_cont(wc, 0.5) AS median, quantile_cont(wc, 0.75) AS q3 FROM l GROUP BY label)
      SELECT label, any_value(n_rows) AS n_rows, any_value(least) AS least, any_value(q1) AS q1, any_value(median) AS median,
        any_value(q3) AS q3, any_value(most) AS most,
        min(wc) FILTER (wc BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
        max(wc) FILTER (wc BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
        count(*) FILTER (wc NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
      FROM l JOIN q USING (label) GROUP BY label""",
)
def length_by_label(spark, d):
    return profile.length_by_label(annotated(spark, d))


@query(
    "dataset_summary",
    "SELECT count(*) AS total_samples, count(DISTINCT text_clean) AS unique_texts, "
    + ", ".join(f"CAST(sum({x}) AS BIGINT) AS {x}_count, round(sum({x}) / count(*) * 100, 2) AS {x}_pct" for x in LABELS)
    + f""", round(avg(word_count), 1) AS avg_word_count, round(median(word_count), 1) AS median_word_count,
      'gold' AS label_eda_source FROM {ANNOTATED}""",
)
def dataset_summary(spark, d):
    return profile.dataset_summary(annotated(spark, d), label_source="gold")


@query("value_counts", "SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source")
def value_counts(spark, d):
    return profile.value_counts(table(spark, d, "documents"), "source")


@query("unique_texts", f"SELECT count(DISTINCT text_clean) AS unique_texts FROM {CLEAN}")
def unique_texts(spark, d):
    return profile.unique_texts(cleaned(spark, d))


EVENT_LABELS = dict(zip(TOXIC_LABELS, ("click", "view", "error", "signup", "purchase")))


@query(
    "weekly_trend",
    "SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS week, count(*) AS n_rows, "
    + ", ".join(f"round(avg(CASE WHEN event_type = '{e}' THEN 1 ELSE 0 END), 6) AS {x}" for x, e in EVENT_LABELS.items())
    + " FROM events GROUP BY 1",
)
def weekly_trend(spark, d):
    events = table(spark, d, "events")
    flags = [(F.col("event_type") == e).cast("int").alias(x) for x, e in EVENT_LABELS.items()]
    return profile.weekly_trend(events.select(F.col("ts").cast("timestamp").alias("ts"), *flags), "ts", parse=False)


# agreement: three annotators derived from the labels, and a machine one


def ratings(spark, d, names=("A", "B", "C")):
    rows = annotated(spark, d).withColumns(
        {
            "A": F.col("toxic"),
            "B": 1 - F.col("quality"),
            "C": keyword_flag(F.col("text_clean"), LEX, mode="word").cast("int"),
            "M": keyword_flag(F.col("text_clean"), LEX).cast("int"),
        }
    )
    long = rows.select(
        F.col("doc_id").alias("item"), "harassment", "gender_attack", "passive_toxic",
        F.explode(F.array(*[F.struct(F.lit(n).alias("annotator"), F.col(n).alias("toxic")) for n in names])).alias("r"),
    )
    return long.select(
        "item",
        "r.annotator",
        "r.toxic",
        (F.col("r.toxic") * F.col("harassment")).alias("harassment"),
        (F.col("r.toxic") * F.col("gender_attack")).alias("gender_attack"),
        F.lit(0).alias("slur"),
        (F.col("r.toxic") * F.col("passive_toxic")).alias("passive_toxic"),
        (1 - F.col("r.toxic")).alias("not_toxic"),
    )


RATED = f"""base AS MATERIALIZED (SELECT *, toxic AS va, 1 - quality AS vb,
    CAST({sql_word_flag('text_clean', ALL_WORDS)} AS INTEGER) AS vc, CAST({sql_flag('text_clean', ALL_WORDS)} AS INTEGER) AS vm FROM {ANNOTATED}),
  u AS (SELECT doc_id, harassment h, gender_attack g, passive_toxic p, unnest(['A', 'B', 'C', 'M']) AS annotator, unnest([va, vb, vc, vm]) AS v FROM base),
  long AS (SELECT doc_id AS item, annotator, unnest({sql_list(LABELS)}) AS label, unnest([v, v * h, v * g, 0, v * p, 1 - v]) AS value FROM u)"""
CELLS = """count(*) FILTER (x.value = 0 AND y.value = 0) AS n00, count(*) FILTER (x.value = 0 AND y.value = 1) AS n01,
  count(*) FILTER (x.value = 1 AND y.value = 0) AS n10, count(*) FILTER (x.value = 1 AND y.value = 1) AS n11"""
PAIRS = f"""pairs AS (SELECT x.annotator AS annotator_1, y.annotator AS annotator_2, label, {CELLS}
  FROM long x JOIN long y USING (item, label) WHERE x.annotator < y.annotator GROUP BY ALL),
  k AS (SELECT *, n00 + n01 + n10 + n11 AS n, (n00 + n11) / n AS po, (n10 + n11) / n AS p1, (n01 + n11) / n AS p2,
    p1 * p2 + (1 - p1) * (1 - p2) AS pe FROM pairs),
  kappas AS (SELECT *, CASE WHEN pe = 1 THEN NULL ELSE round((po - pe) / (1 - pe), 4) END AS kappa FROM k)"""
FLEISS = """items AS (SELECT item, label, sum(value) AS n1, count(*) AS n FROM long WHERE annotator <> 'M' GROUP BY ALL),
  f AS (SELECT label, avg((n1 * n1 + (n - n1) * (n - n1) - n) / (n * (n - 1))) AS pb, sum(n1) / sum(n) AS q,
    q * q + (1 - q) * (1 - q) AS pe FROM items GROUP BY label),
  fleiss AS (SELECT label, CASE WHEN pe = 1 THEN 1.0::DOUBLE ELSE round((pb - pe) / (1 - pe), 4) END AS fleiss_kappa FROM f)"""


@query("confusion", f"WITH {RATED}, {PAIRS} SELECT annotator_1, annotator_2, label, n00, n01, n10, n11 FROM pairs WHERE annotator_2 <> 'M'")
def confusion(spark, d):
    return agreement.confusion(ratings(spark, d), names=["A", "B", "C"])


@query("pairwise_cohen", f"WITH {RATED}, {PAIRS} SELECT annotator_1, annotator_2, label, kappa FROM kappas WHERE annotator_2 <> 'M'")
def pairwise_cohen(spark, d):
    return agreement.cohen_kappa(ratings(spark, d), names=["A", "B", "C"])


@query("fleiss", f"WITH {RATED}, {FLEISS} SELECT * FROM fleiss")
def fleiss(spark, d):
    return agreement.fleiss_kappa(ratings(spark, d)).select("label", "fleiss_kappa")


# a panel of thirty with gaps; the engine's side also holds repeats, of which the first must count
PANEL_SQL = """votes AS (SELECT doc_id AS item, who, 'r' || who AS annotator, (doc_id * 31 + who * 17) % 7 AS h, quality, toxic
    FROM labels, (SELECT unnest(range(0, 30)) AS who)),
  rated AS (SELECT item, annotator, CASE WHEN h < 2 THEN 1 - toxic ELSE toxic END AS toxic, quality AS slur FROM votes WHERE h <> 3),
  long AS (SELECT item, annotator, unnest(['toxic', 'slur']) AS label, unnest([toxic, slur]) AS value FROM rated)"""


def panel(spark, d):
    """Thirty raters, gaps, and every rating of rater r0 given twice, the second time all ones."""
    votes = table(spark, d, "labels").select(F.col("doc_id").alias("item"), "quality", "toxic", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("who"))
    h = F.pmod(F.col("item") * 31 + F.col("who") * 17, F.lit(7))
    kept = votes.filter(h != 3).select(
        "item", F.concat(F.lit("r"), "who").alias("annotator"), F.lit(1).alias("nth"),
        F.when(h < 2, 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"), F.col("quality").alias("slur"),
    )
    again = kept.filter("annotator = 'r0'").select("item", "annotator", F.lit(2).alias("nth"), F.lit(1).alias("toxic"), F.lit(1).alias("slur"))
    return kept.unionByName(again)


@query("panel_confusion", f"""WITH {PANEL_SQL}, pairs AS (SELECT x.annotator AS annotator_1, y.annotator AS annotator_2, x.label, {CELLS}
  FROM long x JOIN long y ON x.item = y.item AND x.label = y.label WHERE x.annotator < y.annotator GROUP BY ALL) SELECT * FROM pairs""")
def panel_confusion(spark, d):
    return agreement.confusion(panel(spark, d), order_by=["nth"])


@query(
    "panel_fleiss",
    f"""WITH {PANEL_SQL}, items AS (SELECT item, label, sum(value) AS n1, count(*) AS n FROM long GROUP BY ALL),
      most AS (SELECT max(n) AS n FROM items), full_ AS (SELECT * FROM items WHERE n = (SELECT n FROM most)),
      f AS (SELECT label, count(*) AS n_items, avg((n1 * n1 + (n - n1) * (n - n1) - n) / (n * (n - 1))) AS pb, sum(n1) / sum(n) AS q,
        q * q + (1 - q) * (1 - q) AS pe FROM full_ GROUP BY label)
      SELECT label, CASE WHEN pe = 1 THEN 1.0::DOUBLE ELSE round((pb - pe) / (1 - pe), 4) END AS fleiss_kappa, n_items,
        (SELECT count(DISTINCT item) FROM items) - n_items AS n_rejected FROM f""",
)
def panel_fleiss(spark, d):
    return agreement.fleiss_kappa(panel(spark, d), raters="most", order_by=["nth"])


@query(
    "fleiss_by_raters",
    f"""WITH {PANEL_SQL}, items AS (SELECT item, label, sum(value) AS n1, count(*) AS n FROM long WHERE item % 3 > 0 OR annotator = 'r29' GROUP BY ALL),
      f AS (SELECT n, label, count(*) AS n_items, avg(CASE WHEN n > 1 THEN (n1 * n1 + (n - n1) * (n - n1) - n) / (n * (n - 1)) END) AS pb, sum(n1) / sum(n) AS q,
        q * q + (1 - q) * (1 - q) AS pe FROM items GROUP BY n, label)
      SELECT n AS n_raters, label, CASE WHEN pe = 1 THEN 1.0::DOUBLE ELSE round((pb - pe) / (1 - pe), 4) END AS fleiss_kappa, n_items FROM f""",
)
def fleiss_by_raters(spark, d):
    """A panel where every third item has one rating at most."""
    rows = panel(spark, d).filter((F.col("item") % 3 > 0) | (F.col("annotator") == "r29"))
    return agreement.fleiss_by_raters(rows, order_by=["nth"])


@query(
    "iaa_from_text",
    f"""WITH t AS (SELECT substr(text, 1, 1) AS text, unnest(['p', 'q']) AS annotator, unnest([toxic, 1 - quality]) AS toxic
        FROM documents JOIN labels USING (doc_id)),
      n AS (SELECT *, concat(sha256(text), '#', row_number() OVER (PARTITION BY text, annotator ORDER BY toxic)) AS item FROM t),
      long AS (SELECT item, annotator, 'toxic' AS label, toxic AS value FROM n),
      pairs AS (SELECT x.annotator AS annotator_1, y.annotator AS annotator_2, x.label, {CELLS}
        FROM long x JOIN long y ON x.item = y.item WHERE x.annotator < y.annotator GROUP BY ALL) SELECT * FROM pairs""",
)
def iaa_from_text(spark, d):
    """Very many equal texts per annotator: the first letters of the documents."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    votes = F.array(F.struct(F.lit("p").alias("annotator"), F.col("toxic")), F.struct(F.lit("q").alias("annotator"), (1 - F.col("quality")).alias("toxic")))
    rows = docs.select(F.substring("text", 1, 1).alias("text"), F.explode(votes).alias("v")).select("text", "v.annotator", "v.toxic")
    return agreement.confusion(agreement.item_id_from_text(rows))


@query(
    "kappa_bands",
    f"""WITH {RATED}, {FLEISS} SELECT label, fleiss_kappa, CASE WHEN fleiss_kappa >= 0.65 THEN 'good'
      WHEN fleiss_kappa >= 0.5 THEN 'minimum' ELSE 'below' END AS band, fleiss_kappa < 0.5 AS low_agreement FROM fleiss""",
)
def kappa_bands(spark, d):
    return agreement.kappa_bands(agreement.fleiss_kappa(ratings(spark, d)).select("label", "fleiss_kappa"))


@query(
    "human_vs_llm",
    f"WITH {RATED}, {PAIRS} SELECT annotator_1 AS annotator, 'gpt-4o' AS vs, label, kappa FROM kappas WHERE annotator_2 = 'M'",
)
def human_vs_llm(spark, d):
    return agreement.human_vs_machine(ratings(spark, d), ratings(spark, d, ["M"]))


@query(
    "consensus",
    f"""WITH {RATED}, v AS (SELECT item, label, sum(value) FILTER (annotator IN ('A', 'B')) AS s, max(value) FILTER (annotator = 'M') AS t
        FROM long WHERE annotator <> 'C' GROUP BY ALL),
      w AS (SELECT item, label, CASE WHEN s = 2 THEN 1 WHEN s = 1 THEN t ELSE 0 END AS value FROM v)
      SELECT item, 2::BIGINT AS n_votes, {', '.join(f"CAST(max(value) FILTER (label = '{x}') AS INTEGER) AS {x}" for x in LABELS)} FROM w GROUP BY item""",
)
def consensus(spark, d):
    return agreement.consensus(ratings(spark, d, ["A", "B", "M"]), tiebreaker="M")


# sampling


@query(
    "stratified_sample",
    f"""SELECT doc_id, f AS has_toxic_keyword, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY f ORDER BY sha256(concat('42|', doc_id)), doc_id) AS rank
      FROM (SELECT doc_id, {sql_flag('text', ALL_WORDS)} AS f FROM documents)) WHERE rank <= CASE WHEN f THEN 80 ELSE 50 END""",
)
def stratified_sample(spark, d):
    sample = sampling.stratified_sample(table(spark, d, "documents"), ["doc_id"], toxic_n=80, clean_n=50)
    return sample.select("doc_id", "has_toxic_keyword", "rank")


@query(
    "annotation_splits",
    f"""WITH a AS MATERIALIZED (SELECT doc_id, {sql_flag('text_clean', ALL_WORDS)} AS f FROM {CLEAN}),
      i AS (SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY f ORDER BY sha256(concat('42|', doc_id))) AS rank FROM a) WHERE rank <= 30),
      m AS (SELECT * FROM (SELECT doc_id, row_number() OVER (ORDER BY sha256(concat('pool42|', doc_id))) AS rank
        FROM a WHERE doc_id NOT IN (SELECT doc_id FROM i)) WHERE rank <= 311 - (SELECT count(*) FROM i))
      SELECT doc_id, 'iaa' AS split, rank FROM i
      UNION ALL SELECT doc_id, 'batch_' || CAST(least((rank - 1) // ((SELECT count(*) FROM m) // 3), 2) + 1 AS VARCHAR), rank FROM m""",
)
def annotation_splits(spark, d):
    splits = sampling.annotation_splits(cleaned(spark, d), ["doc_id"], iaa_size=60, total_size=311)
    return splits.select("doc_id", "split", "rank")


@query("head_n", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 25")
def head_n(spark, d):
    return sampling.head_rows(table(spark, d, "documents").select("doc_id", "source"), ["doc_id"], 25)


# terms

STOP = sql_list(
    """
    a about above after again against all also am an and any are as at be because been before being below between both but by can cannot could did do
    does doing down during each few for from further had has have having he her here hers herself him himself his how i if in into is it its itself
    just me more most my myself no nor not now of off on once only or other our ours ourselves out over own same she should so some such than that the
    their theirs them themselves then there these they this those through to too under until up very was we were what when where which while who whom
    why will with would you your yours yourself yourselves
    """.split()
)
TERMS = f"""tok AS MATERIALIZED (SELECT doc_id AS doc, list_filter(regexp_extract_all(lower({sql_clean('text')}), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
    lambda w: NOT list_contains({STOP}, w)) AS ws FROM documents),
  grams AS (SELECT doc, unnest(ws) AS term FROM tok
    UNION ALL SELECT doc, ws[i] || ' ' || ws[i + 1] FROM (SELECT doc, ws, unnest(range(1, len(ws))) AS i FROM tok)),
  tf AS MATERIALIZED (SELECT doc, term, count(*) AS tf FROM grams GROUP BY ALL),
  vocab AS MATERIALIZED (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 3
    ORDER BY cf DESC, term LIMIT 10000)"""


@query("term_freq", f"WITH {TERMS} SELECT doc, term, tf FROM tf")
def term_freq(spark, d):
    return terms.term_counts(cleaned(spark, d), "doc_id")


@query("vocab", f"WITH {TERMS} SELECT term, cf, df FROM vocab")
def vocab(spark, d):
    return terms.corpus_vocabulary(cleaned(spark, d), "doc_id")


def _tfidf(spark, d):
    marks = annotated(spark, d).select("doc_id", *TOXIC_LABELS)
    docs = cleaned(spark, d).join(marks, "doc_id", "left")
    return terms.tfidf_by_label(docs, "doc_id")


TFIDF = f"""{TERMS},
  wt AS (SELECT doc, term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM tf JOIN vocab USING (term)),
  unit AS (SELECT doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS w FROM wt),
  marks AS MATERIALIZED (SELECT doc_id AS doc, unnest({sql_list(TOXIC_LABELS)}) AS label, unnest([{', '.join(TOXIC_LABELS)}]) AS v FROM {ANNOTATED}),
  scores AS MATERIALIZED (SELECT label, term, round(sum(w) / any_value(n), 4) AS score
    FROM unit JOIN marks USING (doc) JOIN (SELECT label, count(*) AS n FROM marks WHERE v = 1 GROUP BY label) USING (label)
    WHERE v = 1 GROUP BY label, term),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, term) AS rank FROM scores QUALIFY rank <= 20)"""


@query("tfidf_by_label", f"WITH {TFIDF} SELECT label, term, score FROM scores")
def tfidf_by_label(spark, d):
    return _tfidf(spark, d)


@query("top_terms", f"WITH {TFIDF} SELECT label, term, score, rank FROM ranked")
def top_terms(spark, d):
    return terms.top_terms(_tfidf(spark, d)).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "token_heatmap",
    f"""WITH {TFIDF}, t AS (SELECT DISTINCT term FROM ranked WHERE rank <= 10), l AS (SELECT DISTINCT label FROM ranked)
      SELECT l.label, t.term, coalesce(r.score, 0.0) AS score FROM t CROSS JOIN l LEFT JOIN ranked r ON r.term = t.term AND r.label = l.label""",
)
def token_heatmap(spark, d):
    return terms.term_matrix(_tfidf(spark, d))


_WEEKLY = "make_timestamp(2024, 1, 1, 0, 0, 0) + to_days(CAST(doc_id % 40 + CASE WHEN doc_id % 40 > 20 THEN 21 ELSE 0 END AS INTEGER))"


@query(
    "profile_bundle",
    f"""WITH a AS (SELECT * FROM {ANNOTATED}), l AS (SELECT unnest({list(LABELS)!r}) AS label, unnest([{', '.join(LABELS)}]) AS v, word_count FROM a),
      w AS (SELECT CAST(date_trunc('week', {_WEEKLY}) AS DATE) + 6 AS week, toxic FROM a),
      c AS (SELECT CAST(unnest(range((SELECT min(week) FROM w)::TIMESTAMP, (SELECT max(week) FROM w)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 7 DAY)) AS DATE) AS week)
      SELECT 'label_counts' AS report, label AS key, sum(v)::DOUBLE AS value FROM l GROUP BY label
      UNION ALL SELECT 'subreddit_counts', subreddit, count(*) FROM a GROUP BY subreddit
      UNION ALL SELECT 'label_by_subreddit', subreddit, round(avg(toxic), 6) FROM a GROUP BY subreddit
      UNION ALL SELECT 'length_by_label', label, quantile_cont(word_count, 0.5) FROM l WHERE v = 1 GROUP BY label
      UNION ALL SELECT 'weekly_trend', c.week::VARCHAR, round(avg(toxic), 6) FROM c LEFT JOIN w USING (week) GROUP BY c.week
      UNION ALL SELECT 'unique_texts', 'all', count(DISTINCT text_clean) FROM a""",
)
def profile_bundle(spark, d):
    """One column of each table that the bundle makes in one scan of the corpus."""
    day = F.col("doc_id") % 40
    stamp = F.timestamp_seconds(F.lit(1704067200) + 86400 * (day + F.when(day > 20, 21).otherwise(0)))
    rows = annotated(spark, d).withColumn("created_utc", F.unix_seconds(stamp).cast("string"))
    made = reports.corpus_profile(rows.drop("source"), "doc_id")
    value = {"label_counts": ("label", "n"), "subreddit_counts": ("subreddit", "n"), "label_by_subreddit": ("subreddit", "toxic"), "length_by_label": ("label", "median"), "weekly_trend": ("week", "toxic")}
    parts = [made[r].select(F.lit(r).alias("report"), F.col(k).cast("string").alias("key"), F.col(v).cast("double").alias("value")) for r, (k, v) in value.items()]
    parts.append(made["dataset_summary"].select(F.lit("unique_texts").alias("report"), F.lit("all").alias("key"), F.col("unique_texts").cast("double").alias("value")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "profile_loads",
    f"""SELECT subreddit, count(*) AS total_samples, sum(toxic)::BIGINT AS toxic_count, round(100 * avg(toxic), 2) AS toxic_pct, true AS texts_near, true AS median_near
      FROM {ANNOTATED} GROUP BY subreddit""",
)
def profile_loads(spark, d):
    """Five loads' states merged; the estimates are held against the exact figures within the sketches' stated error."""
    rows = annotated(spark, d)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/loads-{uuid.uuid4().hex}"
    for load in range(5):
        sketches.add_load(rows.filter(F.col("doc_id") % 5 == load), folder, str(load))
    merged = sketches.summary_of(sketches.merge_states(sketches.read_loads(spark, folder), "subreddit"))
    # the share of texts that are shorter, and that are no longer, than the median found
    both = rows.join(F.broadcast(merged), "subreddit")  # one row per community
    shorter, upto = F.count_if(F.col("word_count") < F.col("median_word_count")), F.count_if(F.col("word_count") <= F.col("median_word_count"))
    exact = both.groupBy(*merged.columns).agg(F.count_distinct("text_clean").alias("n"), (shorter / F.count("*")).alias("a"), (upto / F.count("*")).alias("b"))
    return exact.select(
        "subreddit", "total_samples", "toxic_count", "toxic_pct", (F.abs(F.col("unique_texts") - F.col("n")) <= 0.04 * F.col("n")).alias("texts_near"),
        ((F.col("a") <= 0.53) & (F.col("b") >= 0.47)).alias("median_near"),
    )
