"""Round trips through files and streams, each with the SQL for what must come back.

Every query writes what it derives from the tables to a new folder below the shared folder named in the Spark settings,
reads it with the operator it is named for, and returns that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from modlens import sinks
from modlens.catalog.base import query, quoted, sql_words, table
from modlens.catalog.corpus_queries import ANNOTATED, annotated, cleaned
from modlens.catalog.score_queries import ADVICE, HALF, LEVEL, PREDS, SCORED, sql_active, sql_severity, sql_toxic
from modlens.functions import scores
from modlens.functions.lexicon import LABELS, TOXIC_LABELS
from modlens.operators import corpus, profile
from modlens.schemas import RAW_TEXT
from modlens.session import checkpoint_dir
from modlens.sources import annotations, comments
from modlens.streaming import ingest, live


def shared_folder(spark, name: str) -> str:
    """A new folder that the driver and all executors reach."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("csv_round_trip", """SELECT concat('comment_', doc_id) AS id, text, source AS subreddit, '' AS post_title,
  doc_id::VARCHAR AS upvotes, '' AS created_utc, 'pushshift' AS source FROM documents""")
def csv_round_trip(spark, d):
    rows = table(spark, d, "documents").select(
        F.concat(F.lit("comment_"), "doc_id").alias("id"), "text", F.col("source").alias("subreddit"),
        F.lit(None).cast("string").alias("post_title"), F.col("doc_id").cast("string").alias("upvotes"),
        F.lit("").alias("created_utc"), F.lit("pushshift").alias("source"),
    )
    folder = shared_folder(spark, "csv")
    sinks.write_csv(rows, folder)
    return comments.read_raw_comments(spark, folder)


@query("chat_csv", """SELECT concat(conv_id, '-', turn) AS "Id", CASE WHEN turn % 2 = 0 THEN '' ELSE conv_id::VARCHAR END AS "matchId", text AS utterance FROM conversations""")
def chat_csv(spark, d):
    chat = table(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("Id"), F.when(F.col("turn") % 2 == 1, F.col("conv_id").cast("string")).alias("matchId"),
        F.col("text").alias("utterance"),
    )
    folder = shared_folder(spark, "chat")
    sinks.write_csv(chat, folder)
    return comments.read_chat(spark, folder)


@query("jsonl_round_trip", "SELECT doc_id::VARCHAR AS id, text, source AS subreddit FROM documents WHERE doc_id % 9 <> 0")
def jsonl_round_trip(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", F.col("source").alias("subreddit"))
    good = F.to_json(F.struct("*"))
    lines = rows.select(F.when(F.col("id").cast("long") % 9 == 0, F.concat(F.lit("{bad "), "id")).otherwise(good).alias("value"))
    folder = shared_folder(spark, "jsonl")
    lines.unionByName(lines.select(F.lit("  ").alias("value")).limit(3)).write.text(folder)
    return comments.read_posts(spark, f"{folder}-none.csv", folder, RAW_TEXT).select("id", "text", "subreddit")


@query("annotator_files", f"""SELECT text_clean AS text, unnest(['al', 'bo']) AS annotator, unnest([toxic, 1 - quality]) AS toxic,
  {', '.join(f'{x}' for x in LABELS if x != 'toxic')} FROM {ANNOTATED}""")
def annotator_files(spark, d):
    """One CSV folder per annotator, by the file name pattern of the reader."""
    rows = annotated(spark, d)
    folder = shared_folder(spark, "annotators")
    for name, value in (("al", F.col("toxic")), ("bo", 1 - F.col("quality"))):
        given = rows.select(F.col("text_clean").alias("text"), value.alias("toxic"), *[x for x in LABELS if x != "toxic"])
        sinks.write_csv(given, f"{folder}/iaa_annotator_{name}.csv")
    return annotations.read_annotators(spark, folder).drop("text_clean")


@query("annotator_orders", f"""SELECT text_clean || chr(10) || 'second "line", ' || doc_id AS text, unnest(['al', 'bo', 'cy']) AS annotator, unnest([toxic, 1 - quality, toxic]) AS toxic,
  unnest([slur, 1, 0]) AS slur, unnest([0, 0, not_toxic]) AS not_toxic FROM {ANNOTATED}""")
def annotator_orders(spark, d):
    """Each annotator's file has its columns in another order, one lacks a label, and every text has a line break."""
    rows = annotated(spark, d).withColumn("text", F.concat("text_clean", F.lit('\nsecond "line", '), "doc_id"))
    folder = shared_folder(spark, "orders")
    given = {
        "al": rows.select("text", "toxic", "slur"),
        "bo": rows.select(F.lit(1).alias("slur"), "text", (1 - F.col("quality")).alias("toxic")),
        "cy": rows.select("not_toxic", "toxic", "text"),
    }
    for name, part in given.items():
        sinks.write_csv(part, f"{folder}/iaa_annotator_{name}.csv")
    return annotations.read_annotators(spark, folder).select("text", "annotator", "toxic", "slur", "not_toxic")


@query("annotated_csv", f"SELECT text_clean, {', '.join(LABELS)} FROM {ANNOTATED}")
def annotated_csv(spark, d):
    folder = shared_folder(spark, "annotated")
    sinks.write_csv(annotated(spark, d).select("text_clean", *[F.col(x).cast("double").alias(x) for x in LABELS]), folder)
    return comments.read_annotated(spark, folder)


@query("split_folders", "SELECT doc_id::VARCHAR AS doc_id, text, 'batch_' || (doc_id % 3 + 1) AS split FROM documents")
def split_folders(spark, d):
    splits = table(spark, d, "documents").select("doc_id", "text", F.concat(F.lit("batch_"), (F.col("doc_id") % 3 + 1).cast("string")).alias("split"))
    folder = shared_folder(spark, "splits")
    sinks.write_splits(splits, folder)
    return comments.read_text_csv(spark, folder)


@query("summary_csv", "SELECT count(*)::VARCHAR AS total_samples, 'gold' AS label_eda_source FROM " + ANNOTATED)
def summary_csv(spark, d):
    folder = shared_folder(spark, "summary")
    sinks.write_reports({"summary": profile.dataset_summary(annotated(spark, d), label_source="gold")}, folder)
    return comments.read_text_csv(spark, f"{folder}/summary").select("total_samples", "label_eda_source")


@query("agreement_table", "SELECT 'a' || doc_id AS annotator_1, 'b' AS annotator_2, 'toxic' AS label, CASE WHEN doc_id % 4 > 0 THEN doc_id % 4 / 4 END AS kappa FROM labels")
def agreement_table(spark, d):
    given = table(spark, d, "labels").select(
        F.concat(F.lit("a"), "doc_id").alias("annotator_1"), F.lit("b").alias("annotator_2"), F.lit("toxic").alias("label"),
        F.element_at(F.array(F.lit("nan"), F.lit("0.25"), F.lit("0.5"), F.lit("0.75")), (F.col("doc_id") % 4 + 1).cast("int")).alias("kappa"),
    )
    folder = shared_folder(spark, "agreement")
    sinks.write_csv(given, folder)
    return annotations.read_agreement(spark, folder)


@query("count_maps", """SELECT 'source' AS "column", source AS value, count(*) AS n FROM documents GROUP BY source
  UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang""")
def count_maps(spark, d):
    """The summary's maps, unfolded."""
    docs = table(spark, d, "documents")
    one = profile.with_count_maps(docs.agg(F.count("*").alias("total")), docs, ["source", "lang"])
    return one.select(F.explode(F.map_from_arrays(F.array(F.lit("source"), F.lit("lang")), F.array("sources", "langs"))).alias("column", "m")).select(
        "column", F.explode("m").alias("value", "n")
    )


@query("request_limits", """SELECT doc_id, CASE WHEN len(text) < 1 THEN 'empty' WHEN len(text) > 2000 THEN 'too_long'
  WHEN doc_id % 5 IN (0, 1, 2) THEN 'threshold' END AS reason FROM documents""")
def request_limits(spark, d):
    bad = F.array(F.lit(1.5), F.lit(-0.1), F.lit(float("nan")), F.lit(0.7), F.lit(None).cast("double"))
    rows = table(spark, d, "documents").withColumn("wanted", F.element_at(bad, (F.col("doc_id") % 5 + 1).cast("int")))
    return corpus.validate_rows(rows, threshold="wanted").select("doc_id", "reason")


_DATED = "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE make_timestamp(2024, 1, 1, 0, 0, 0) + to_days(CAST(doc_id % 8 + CASE WHEN doc_id % 8 > 5 THEN 21 ELSE 0 END AS INTEGER)) END"


@query("dated_trend", f"""WITH r AS (SELECT CAST(date_trunc('week', s) AS DATE) + 6 AS week, toxic FROM (SELECT {_DATED} AS s, toxic FROM labels) WHERE s IS NOT NULL),
  w AS (SELECT week, count(*) AS n_rows, round(avg(toxic), 6) AS toxic FROM r GROUP BY week),
  c AS (SELECT CAST(unnest(range((SELECT min(week) FROM w)::TIMESTAMP, (SELECT max(week) FROM w)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 7 DAY)) AS DATE) AS week)
  SELECT c.week, coalesce(n_rows, 0) AS n_rows, toxic FROM c LEFT JOIN w USING (week)""")
def dated_trend(spark, d):
    """Dates as epoch seconds, as texts and unreadable; a gap of two weeks."""
    day = F.col("doc_id") % 8
    stamp = F.timestamp_seconds(F.lit(1704067200) + 86400 * (day + F.when(day > 5, 21).otherwise(0)))
    text = F.when(F.col("doc_id") % 4 == 0, F.lit("no date")).when(F.col("doc_id") % 2 == 0, F.unix_seconds(stamp).cast("string")).otherwise(
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    )
    return profile.weekly_trend(table(spark, d, "labels").select(text.alias("created_utc"), "toxic"))


def _lines(spark, d) -> str:
    """Dump lines in files, some of them malformed."""
    docs = table(spark, d, "documents")
    record = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.lit("VALORANT").alias("subreddit"), F.translate("text", "\n\r", "  ").alias("body"), F.col("doc_id").alias("score"), F.lit(1700000000).alias("created_utc")))
    folder = shared_folder(spark, "lines")
    docs.select(F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("{bad "), "doc_id")).otherwise(record).alias("value")).write.text(folder)
    return folder


_SAFE = r"trim(regexp_replace(regexp_replace(regexp_replace(text, '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), 'https?://\S+|www\.\S+', '', 'g'), '\s+', ' ', 'g'))"


@query("stream_ingest", f"""SELECT 'comment_' || doc_id AS id, 'record' AS kind FROM (SELECT doc_id, {_SAFE} AS t FROM documents WHERE doc_id % 10 <> 0) WHERE {sql_words('t')} >= 4
  UNION ALL SELECT '{{bad ' || doc_id, 'malformed' FROM documents WHERE doc_id % 10 = 0""")
def stream_ingest(spark, d):
    """Twice with one state: the second run has nothing left to do."""
    folder, out, state = _lines(spark, d), shared_folder(spark, "raw"), shared_folder(spark, "state")
    for _ in range(2):
        ingest.start_ingest(ingest.dump_stream(spark, folder), out, state, name=f"q{uuid.uuid4().hex}").awaitTermination()
    records, malformed = ingest.read_ingest(spark, out)
    good = records.select("id", F.lit("record").alias("kind"))
    return good.unionByName(malformed.select(F.col("value").alias("id"), F.lit("malformed").alias("kind")))


@query("stream_ingest_rows", f"""SELECT 'comment_' || doc_id AS id, t AS text, 'VALORANT' AS subreddit, '' AS post_title, doc_id AS upvotes, 1700000000 AS created,
  'pushshift' AS source, 'comment' AS kind FROM (SELECT doc_id, {_SAFE} AS t FROM documents WHERE doc_id % 10 <> 0) WHERE {sql_words('t')} >= 4""")
def stream_ingest_rows(spark, d):
    """Whole rows; after a restart every record comes again with another score, and none of these passes."""
    folder, out, state = _lines(spark, d), shared_folder(spark, "raw"), shared_folder(spark, "state")

    def run():
        ingest.start_ingest(ingest.dump_stream(spark, folder), out, state, name=f"q{uuid.uuid4().hex}").awaitTermination()

    run()
    again = spark.read.text(folder).select(F.regexp_replace("value", '"score":', '"score":9').alias("value"))
    later = shared_folder(spark, "lines-again")
    again.write.text(later)
    spark.read.text(later).write.mode("append").text(folder)
    run()
    created = F.unix_timestamp("created_utc").alias("created")
    return ingest.read_ingest(spark, out)[0].select("id", "text", "subreddit", "post_title", "upvotes", created, "source", "kind")


@query("stream_moderation", f"""WITH {SCORED}, s AS (SELECT *, {sql_severity()} AS severity, {sql_toxic(HALF)} AS is_toxic FROM scored)
  SELECT doc_id, {PREDS}, {sql_active(HALF)} AS active, is_toxic, severity, {LEVEL} AS severity_level, {ADVICE} AS recommendation, is_toxic AS alerted FROM s""")
def stream_moderation(spark, d):
    """Every text in several micro-batches: scores, labels, severity and advice, and whether it is among the alerts."""
    docs = cleaned(spark, d).select("doc_id", "text_clean")
    folder, out = shared_folder(spark, "texts"), shared_folder(spark, "moderated")
    cores = spark.sparkContext.defaultParallelism  # a micro-batch has a file for each of them, not one for all
    docs.repartition(3 * cores).write.parquet(folder)
    source = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", cores).parquet(folder)
    stream = live.moderated(source, "text_clean")
    live.start_moderation(stream, out, f"{out}-state", name=f"q{uuid.uuid4().hex}").awaitTermination()
    rows, alerts = live.read_moderation(spark, out, stream.schema)
    told = alerts.select("doc_id", F.lit(True).alias("alerted"))
    return rows.join(told, "doc_id", "left").select(
        "doc_id", *[scores.PRED[x] for x in LABELS], F.array_join("active_labels", ",").alias("active"), "is_toxic", "severity",
        "severity_level", "recommendation", F.coalesce("alerted", F.lit(False)).alias("alerted"),
    )


@query("stream_trend", """WITH e AS (SELECT date_trunc('week', ts) AS week, event_type FROM events)
  SELECT CAST(week AS DATE) + 6 AS week, count(*) AS n_rows, round(avg(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END), 6) AS toxic FROM e
  WHERE week + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 7 DAY FROM events) GROUP BY week""")
def stream_trend(spark, d):
    """Closed weeks of a stream of dated labels."""
    events = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("created_utc"), (F.col("event_type") == "click").cast("int").alias(TOXIC_LABELS[0]))
    folder, out = shared_folder(spark, "events"), shared_folder(spark, "trend")
    events.write.parquet(folder)
    stream = live.closed_weeks(spark.readStream.schema(events.schema).parquet(folder))
    running = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start(f"{out}/weeks")
    running.awaitTermination()
    return spark.read.parquet(f"{out}/weeks")


@query("stream_trend_corrected", """WITH r AS (SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS week, event_type FROM events WHERE extract(month FROM ts) % 2 = 1),
  w AS (SELECT week, count(*) AS n_rows, round(avg(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END), 6) AS toxic FROM r GROUP BY week),
  c AS (SELECT CAST(unnest(range((SELECT min(week) FROM w)::TIMESTAMP, (SELECT max(week) FROM w)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 7 DAY)) AS DATE) AS week)
  SELECT c.week, coalesce(n_rows, 0) AS n_rows, toxic FROM c LEFT JOIN w USING (week)""")
def stream_trend_corrected(spark, d):
    """Every second month's events, the newest first: later batches correct weeks long past, and empty weeks are there."""
    stamp = F.col("ts").cast("timestamp")
    events = table(spark, d, "events").filter(F.month("ts") % 2 == 1).select(stamp.alias("created_utc"), (F.col("event_type") == "click").cast("int").alias(TOXIC_LABELS[0]))
    folder, out = shared_folder(spark, "events"), shared_folder(spark, "trend")
    newest = F.date_trunc("month", "created_utc") == events.agg(F.max(F.date_trunc("month", "created_utc"))).scalar()
    for part in (events.filter(newest), events.filter(~newest)):
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder)
        live.start_trend(stream, out, f"{out}-state", name=f"q{uuid.uuid4().hex}").awaitTermination()
    return live.read_trend(spark, out, TOXIC_LABELS[:1])
