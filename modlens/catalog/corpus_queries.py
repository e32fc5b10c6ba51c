"""Corpus queries: filters, identifiers, merges, dumps, stored responses and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from modlens import sinks
from modlens.catalog.base import (
    ALL_WORDS,
    query,
    quoted,
    sql_clean,
    sql_collapse,
    sql_flag,
    sql_safe,
    sql_words,
    table,
)
from modlens.functions import text as tx
from modlens.functions.lexicon import DEFAULT_LEXICON, LABELS, keyword_flag
from modlens.functions.once import evaluate_once
from modlens.operators import corpus as ops
from modlens.plans import corpus as plans
from modlens.schemas import coerce_labels, with_missing_columns
from modlens.sources import annotations, dumps, pages, payloads

LEX = DEFAULT_LEXICON
CLEAN = f"(SELECT *, {sql_words('text_clean')} AS word_count FROM (SELECT *, {sql_clean('text')} AS text_clean FROM documents))"
FIRST = f"""(SELECT * FROM (SELECT *, sha256(lower(text_clean)) AS text_hash FROM {CLEAN} WHERE word_count BETWEEN 4 AND 512)
  QUALIFY row_number() OVER (PARTITION BY text_hash ORDER BY doc_id) = 1)"""


def cleaned(spark, d, docs=None, filtered=False):
    """Documents with clean text and word count; ``filtered`` if a filter on those follows."""
    docs = table(spark, d, "documents") if docs is None else docs
    clean = {"text_clean": tx.clean_text(F.col("text"))}
    docs = evaluate_once(docs, clean) if filtered else docs.withColumns(clean)
    return docs.withColumn("word_count", tx.word_count(F.col("text_clean"), collapsed=True))


def annotated(spark, d):
    """Labelled documents: the table's own ``toxic``, the other labels from lexicon categories."""
    gold = table(spark, d, "labels").select("doc_id", "toxic", "quality")
    t = F.col("text_clean")
    docs = cleaned(spark, d, table(spark, d, "documents").join(gold, "doc_id")).withColumnRenamed("source", "subreddit")
    docs = docs.withColumns(
        {
            "harassment": keyword_flag(t, LEX, ["threats_escalation"]).cast("int"),
            "gender_attack": keyword_flag(t, LEX, ["gender_based"]).cast("int"),
            "slur": keyword_flag(t, LEX, ["regional_slang"]).cast("int"),
            "passive_toxic": keyword_flag(t, LEX, ["passive_toxic"]).cast("int"),
        }
    )
    return docs.withColumn("not_toxic", 1 - F.greatest(*LABELS[:-1]))


ANNOTATED = f"""(SELECT *, 1 - greatest(toxic, harassment, gender_attack, slur, passive_toxic) AS not_toxic FROM (
  SELECT doc_id, text_clean, word_count, lang, source AS subreddit, quality, toxic,
    CAST({sql_flag('text_clean', LEX.categories['threats_escalation'])} AS INTEGER) AS harassment,
    CAST({sql_flag('text_clean', LEX.categories['gender_based'])} AS INTEGER) AS gender_attack,
    CAST({sql_flag('text_clean', LEX.categories['regional_slang'])} AS INTEGER) AS slur,
    CAST({sql_flag('text_clean', LEX.categories['passive_toxic'])} AS INTEGER) AS passive_toxic
  FROM {CLEAN} JOIN labels USING (doc_id)))"""


def comment_rate(spark, d):
    """Share of distinct comments per community that hit the lexicon."""
    merged = plans.merge_corpus(table(spark, d, "documents"), ["doc_id"])
    return ops.keyword_rate(merged, by=["source"])


query(
    "comment_rate",
    f"""SELECT source, count(*) AS n_rows, count(*) FILTER (f) AS n_keyword,
    round(count(*) FILTER (f) / count(*), 4) AS keyword_rate
    FROM (SELECT source, {sql_flag('text_clean', ALL_WORDS)} AS f FROM {FIRST}) GROUP BY source""",
)(comment_rate)


@query("allowlist", "SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src7', 'src13')")
def allowlist(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return ops.in_communities(docs, "source", ["SRC1", "src7", "Src13"])


EVENT_LINE = """CASE event_type
  WHEN 'click' THEN concat('{"id": ', event_id, ', "body": null}')
  WHEN 'view' THEN concat('{"id": ', event_id, ', "body": "text ', user_id, '"}')
  WHEN 'error' THEN concat('{"id": ', event_id, ', "title": "t", "props": ', props, '}')
  WHEN 'signup' THEN concat('{bad ', event_id)
  ELSE concat('[', event_id, ']') END"""


@query(
    "record_kind",
    f"""SELECT event_id, CASE WHEN NOT json_valid(line) OR json_type(line) <> 'OBJECT' THEN 'rejected'
      WHEN list_contains(json_keys(line), 'body') THEN 'comment' ELSE 'submission' END AS kind
      FROM (SELECT event_id, CASE WHEN json_valid(l) THEN l ELSE '[]' END AS line FROM (SELECT event_id, {EVENT_LINE} AS l FROM events))""",
)
def record_kind(spark, d):
    lines = table(spark, d, "events").select("event_id", F.expr(EVENT_LINE).alias("value"))
    parsed = dumps.parse_lines(lines)
    kind = F.when(F.col("doc").isNull(), "rejected").otherwise(dumps.record_kind(F.col("doc")))
    return parsed.select("event_id", kind.alias("kind"))


@query(
    "compose_text",
    f"""SELECT conv_id, turn, CASE WHEN turn > 0 THEN {sql_safe('text')}
      WHEN role = 'system' THEN 'thread ' || conv_id
      ELSE trim('thread ' || conv_id || ' ' || {sql_safe('text')}) END AS composed FROM conversations""",
)
def compose_text(spark, d):
    c = table(spark, d, "conversations")
    body = tx.safe_text(F.col("text"))
    selftext = F.when(F.col("role") == "system", "").otherwise(body)
    title = F.concat(F.lit("thread "), F.col("conv_id").cast("string"))
    kind = F.when(F.col("turn") > 0, "comment").otherwise("submission")
    return c.select("conv_id", "turn", ops.compose_text(kind, body, title, selftext).alias("composed"))


@query("word_bounds", f"SELECT doc_id, word_count FROM {CLEAN} WHERE word_count BETWEEN 4 AND 512")
def word_bounds(spark, d):
    return ops.in_word_bounds(cleaned(spark, d, filtered=True)).select("doc_id", "word_count")


@query(
    "validate_rows",
    """SELECT doc_id, len(text) BETWEEN 1 AND 2000 AS accepted,
      CASE WHEN len(text) < 1 THEN 'empty' WHEN len(text) > 2000 THEN 'too_long' END AS reason FROM documents""",
)
def validate_rows(spark, d):
    return ops.validate_rows(table(spark, d, "documents")).select("doc_id", "accepted", "reason")


@query(
    "chat_scan",
    """SELECT concat(conv_id, '-', turn) AS Id, CAST(conv_id AS VARCHAR) AS conversationId, text AS utterance,
      '' AS matchId, '' AS created_utc FROM conversations""",
)
def chat_scan(spark, d):
    chat = table(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("Id"),
        F.col("conv_id").cast("string").alias("conversationId"),
        F.col("text").alias("utterance"),
    )
    return with_missing_columns(chat, ["matchId", "created_utc"])


@query(
    "uid_build",
    """SELECT conv_id, turn, CASE WHEN role = 'system'
      THEN 'conda:idx_' || sha256(concat('{"Id":" ","conv_id":', conv_id, ',"turn":', turn, '}'))
      ELSE concat('conda:', conv_id, '-', turn) END AS uid FROM conversations""",
)
def uid_build(spark, d):
    given = F.when(F.col("role") == "system", " ").otherwise(F.concat_ws("-", "conv_id", "turn"))
    chat = table(spark, d, "conversations").select("conv_id", "turn", given.alias("Id"))
    return chat.select("conv_id", "turn", ops.chat_uid(chat, "Id").alias("uid"))


@query(
    "uid_repeats",
    """WITH c AS (SELECT CASE WHEN turn % 3 = 0 THEN concat(conv_id, '-', turn) ELSE ' ' END AS id, role FROM conversations),
      n AS (SELECT *, row_number() OVER (PARTITION BY id, role) AS copy FROM c)
      SELECT role, CASE WHEN id = ' ' THEN concat('conda:idx_', sha256(concat('{"Id":" ","role":"', role, '"}')), CASE WHEN copy > 1 THEN '#' || copy ELSE '' END)
        ELSE 'conda:' || id END AS uid FROM n""",
)
def uid_repeats(spark, d):
    """Very many equal rows without an id: each gets one of its own."""
    given = F.when(F.col("turn") % 3 == 0, F.concat_ws("-", "conv_id", "turn")).otherwise(" ")
    chat = table(spark, d, "conversations").select(given.alias("Id"), "role")
    return ops.with_chat_uid(chat, "Id").select("role", "uid")


@query(
    "canonical_cols",
    """SELECT concat('d', doc_id) AS uid, text, source AS subreddit, '' AS source_type, '' AS created_utc FROM documents
      UNION ALL SELECT concat('c', conv_id, '-', turn), text, '', role, '' FROM conversations""",
)
def canonical_cols(spark, d):
    columns = ["uid", "text", "subreddit", "source_type", "created_utc"]
    docs = table(spark, d, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("uid"), "text", F.col("source").alias("subreddit")
    )
    chat = table(spark, d, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("uid"), "text", F.col("role").alias("source_type")
    )
    return ops.canonical_columns(docs, columns).unionByName(ops.canonical_columns(chat, columns))


@query("dedupe_first", f"SELECT doc_id, text_hash FROM {FIRST}")
def dedupe_first(spark, d):
    rows = ops.in_word_bounds(cleaned(spark, d, filtered=True)).select("doc_id", tx.text_hash(F.col("text_clean")).alias("text_hash"))
    return ops.keep_first(rows, ["text_hash"], ["doc_id"])


CONV = f"(SELECT conv_id, turn, {sql_words('c')} AS wc FROM (SELECT *, {sql_safe('text')} AS c FROM conversations))"


def _turns(spark, d):
    c = table(spark, d, "conversations")
    clean = evaluate_once(c.select("conv_id", "turn", "text"), {"c": tx.safe_text(F.col("text"))})
    return clean.select("conv_id", "turn", tx.word_count(F.col("c"), collapsed=True).alias("wc"))


@query(
    "dedupe_id_after",
    f"SELECT conv_id, turn, wc FROM {CONV} WHERE wc >= 20 QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1",
)
def dedupe_id_after(spark, d):
    return ops.keep_first(_turns(spark, d).filter("wc >= 20"), ["conv_id"], ["turn"])


@query("dedupe_id_before", f"SELECT conv_id, turn, wc FROM {CONV} WHERE turn = 0 AND wc >= 20")
def dedupe_id_before(spark, d):
    return ops.keep_first(_turns(spark, d), ["conv_id"], ["turn"]).filter("wc >= 20")


@query(
    "funnel",
    f"""SELECT count(*) AS raw_rows, count(*) FILTER (word_count BETWEEN 4 AND 512) AS after_word_filter,
      count(DISTINCT sha256(lower(text_clean))) FILTER (word_count BETWEEN 4 AND 512) AS after_dedupe FROM {CLEAN}""",
)
def funnel(spark, d):
    return ops.row_funnel(table(spark, d, "documents"))


@query(
    "keyword_rate",
    f"""SELECT count(*) AS n_rows, count(*) FILTER ({sql_flag('text_clean', ALL_WORDS)}) AS n_keyword,
      round(count(*) FILTER ({sql_flag('text_clean', ALL_WORDS)}) / count(*), 4) AS keyword_rate FROM {CLEAN}""",
)
def keyword_rate(spark, d):
    rows = cleaned(spark, d)
    return ops.keyword_rate(rows.select(keyword_flag(F.col("text_clean")).alias("has_toxic_keyword")))


@query(
    "merge_corpus",
    f"""SELECT doc_id, text_clean, word_count, text_hash, {sql_flag('text_clean', ALL_WORDS)} AS has_toxic_keyword, source,
      {', '.join(f'0 AS {x}' for x in LABELS)} FROM {FIRST}""",
)
def merge_corpus(spark, d):
    merged = plans.merge_corpus(table(spark, d, "documents"), ["doc_id"])
    return merged.select("doc_id", "text_clean", "word_count", "text_hash", "has_toxic_keyword", "source", *LABELS)


@query(
    "two_source_merge",
    f"""SELECT uid, text_clean, source_origin, {sql_words('text_clean')} AS word_count, subreddit, source_type,
      conda_match_id, conda_conversation_id, created_utc, CAST({sql_flag('text_clean', ALL_WORDS)} AS INTEGER) AS weak_toxic,
      {', '.join(f'0 AS {x}' for x in LABELS)}
    FROM (SELECT * FROM (
      SELECT concat('reddit:', doc_id) AS uid, {sql_clean('text')} AS text_clean, 'reddit' AS source_origin, source AS subreddit,
        '' AS source_type, '' AS conda_match_id, '' AS conda_conversation_id, '' AS created_utc, 0 AS f, doc_id AS o FROM documents
      UNION ALL SELECT concat('conda:', conv_id, '-', turn), {sql_clean('text')}, 'conda', '', 'in_game_chat', '',
        CAST(conv_id AS VARCHAR), '', 1, conv_id * 1000 + turn FROM conversations)
      WHERE {sql_words('text_clean')} >= CASE WHEN f = 0 THEN 4 ELSE 1 END
      QUALIFY row_number() OVER (PARTITION BY sha256(lower(text_clean)) ORDER BY f, o) = 1)""",
)
def two_source_merge(spark, d):
    posts = table(spark, d, "documents").select(
        F.concat(F.lit("reddit:"), "doc_id").alias("uid"), "text", F.col("source").alias("subreddit"), "doc_id"
    )
    chat = table(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("Id"),
        F.col("text").alias("utterance"),
        F.col("conv_id").cast("string").alias("conversationId"),
        "conv_id",
        "turn",
    )
    merged = plans.merge_posts_and_chat(
        posts, chat, posts_order=F.col("doc_id"), chat_order=F.col("conv_id") * 1000 + F.col("turn")
    )
    return merged.drop("text")


# Documents as dump lines: English ones are comments, the others submissions; equal texts share an id.


def _dump_lines(spark, d):
    docs = table(spark, d, "documents")
    key = tx.text_hash(F.col("text"))
    seconds = F.lit(1_700_000_000) + F.col("doc_id")
    iso = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    comment = F.to_json(
        F.struct(
            key.alias("id"), F.concat(F.lit(" "), "source").alias("subreddit"), F.col("text").alias("body"),
            F.col("n_chars").alias("score"), seconds.alias("created_utc"),
        )
    )
    post = F.to_json(
        F.struct(
            key.alias("id"), F.upper("source").alias("subreddit"), F.concat(F.lit("about "), "source").alias("title"),
            F.col("text").alias("selftext"), iso.alias("created_utc"),
        )
    )
    good = docs.select(F.when(F.col("lang") == "en", comment).otherwise(post).alias("value"))
    bad = docs.select(F.concat(F.lit("{bad "), "doc_id").alias("value"))
    return good.unionByName(bad)


COMMUNITIES = [f"src{i}" for i in range(0, 20, 2)]
DUMP = f"""(SELECT * FROM (SELECT CASE WHEN lang = 'en' THEN 'comment' ELSE 'submission' END AS kind, sha256(lower(text)) AS raw_id,
    CASE WHEN lang = 'en' THEN {sql_safe('text')} ELSE trim('about ' || source || ' ' || {sql_safe('text')}) END AS text,
    CASE WHEN lang = 'en' THEN source ELSE upper(source) END AS subreddit,
    CASE WHEN lang = 'en' THEN '' ELSE 'about ' || source END AS post_title,
    CASE WHEN lang = 'en' THEN n_chars ELSE 0 END AS upvotes, (1700000000 + doc_id) AS created
    FROM documents WHERE source IN ({', '.join(quoted(c) for c in COMMUNITIES)}))
  WHERE {sql_words('text')} >= 4
  QUALIFY row_number() OVER (PARTITION BY kind, raw_id ORDER BY created) = 1)"""


@query(
    "dump_ingest",
    f"""SELECT kind || '_' || raw_id AS id, text, subreddit, post_title, upvotes, created AS created_s,
      'pushshift' AS source FROM {DUMP}""",
)
def dump_ingest(spark, d):
    rows = dumps.first_records(dumps.dump_records(_dump_lines(spark, d), COMMUNITIES))
    return rows.select(
        "id", "text", "subreddit", "post_title", "upvotes", F.unix_seconds("created_utc").alias("created_s"), "source"
    )


@query("kind_counts", f"SELECT kind, count(*) AS n FROM {DUMP} GROUP BY kind")
def kind_counts(spark, d):
    return dumps.kind_counts(dumps.first_records(dumps.dump_records(_dump_lines(spark, d), COMMUNITIES)))


@query(
    "post_fallback",
    f"""WITH p AS (SELECT * FROM conversations WHERE turn = 0), c AS (SELECT * FROM conversations WHERE turn > 0),
      r AS (SELECT CASE WHEN c.conv_id IS NULL THEN concat('post_', p.conv_id) ELSE concat(c.conv_id, '-', c.turn) END AS id,
        {sql_safe("coalesce(c.text, nullif(p.text, ''), 'title')")} AS text, p.role AS post_title,
        coalesce(c.turn, p.conv_id) AS upvotes FROM p LEFT JOIN c ON p.conv_id = c.conv_id WHERE p.conv_id % 5 <> 4)
      SELECT id, text, post_title, upvotes FROM r WHERE {sql_words('text')} >= 4""",
)
def post_fallback(spark, d):
    turns = table(spark, d, "conversations")
    posts = turns.filter("turn = 0").select(
        F.col("conv_id").cast("string").alias("post_id"),
        F.col("role").alias("title"),
        F.col("text").alias("selftext"),
        F.col("conv_id").cast("string").alias("score"),
        F.lit("1").alias("created_utc"),
        F.lit("chat").alias("subreddit"),
        F.when(F.col("conv_id") % 5 != 4, F.concat(F.lit("/r/"), "conv_id")).alias("link"),
    )
    # some posts come twice, and some comments again later, with other texts
    posts = posts.unionByName(posts.filter("post_id % 3 = 0").withColumns({"created_utc": F.lit("2"), "title": F.lit("again")}))
    comments = turns.filter("turn > 0").select(
        F.col("conv_id").cast("string").alias("post_id"),
        F.concat_ws("-", "conv_id", "turn").alias("comment_id"),
        F.col("text").alias("body"),
        F.col("turn").cast("string").alias("score"),
        F.lit("1").alias("created_utc"),
    )
    comments = comments.unionByName(comments.filter("score % 2 = 0").withColumns({"created_utc": F.lit("2"), "body": F.lit("later copy of this comment")}))
    rows = payloads.posts_with_comments(posts, comments)
    return rows.select("id", "text", "post_title", "upvotes")


BODY = """CASE event_type
  WHEN 'click' THEN concat('{"posts": [{"id": "a', event_id, '", "p": ', props, '}, 5, {"id": "b', event_id, '"}]}')
  WHEN 'view' THEN concat('{"items": [], "data": {"comments": [{"comment_id": "c', event_id, '"}]}}')
  WHEN 'error' THEN concat('[{"id": "d', event_id, '"}]')
  WHEN 'signup' THEN concat('{"data": {"0": {"id": "e', event_id, '"}, "1": {"id": "f', event_id, '"}}}')
  WHEN 'purchase' THEN concat('{"data": {"results": {"items": {"posts": {"data": [{"id": "g', event_id, '"}]}}}}}')
  ELSE concat('{"message": "none ', event_id, '"}') END"""


@query(
    "envelope_flatten",
    """WITH r AS (SELECT event_id, event_type, unnest(['a', 'b', 'c', 'd', 'e', 'f', 'g']) AS part FROM events)
      SELECT event_id, concat(part, event_id) AS record_id FROM r
      WHERE contains(CASE event_type WHEN 'click' THEN 'ab' WHEN 'view' THEN 'c' WHEN 'error' THEN 'd'
        WHEN 'signup' THEN 'ef' WHEN 'purchase' THEN 'g' ELSE '' END, part)""",
)
def envelope_flatten(spark, d):
    bodies = table(spark, d, "events").select("event_id", F.expr(BODY).alias("body"))
    records = payloads.flatten_envelopes(bodies, "body", ["event_id"])
    return records.select("event_id", payloads.record_text(F.col("record"), "id", "comment_id").alias("record_id"))


def _sql_markup(x: str) -> str:
    """Tags out, the references that the sample pages hold decoded; ``&amp`` also without its semicolon."""
    out = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    for entity, char in (("&quot;", '"'), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&amp", "&")):
        out = f"replace({out}, {quoted(entity)}, {quoted(char)})"
    return sql_collapse(out)


@query(
    "html_extract",
    f"""WITH v AS (SELECT page_id, regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<!--.*?-->', '', 'g') AS h FROM pages),
      b AS (SELECT page_id, regexp_extract(h, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1) AS t,
        regexp_extract_all(h, '(?is)<p(?:\\s[^>]*)?>(.*?)</p>', 1) AS ps FROM v)
      SELECT page_id, CAST(i AS INTEGER) - 1 AS pos, {_sql_markup('ps[i]')} AS text, {_sql_markup('t')} AS post_title
      FROM (SELECT page_id, t, ps, unnest(range(1, len(ps) + 1)) AS i FROM b)""",
)
def html_extract(spark, d):
    return pages.blocks(table(spark, d, "pages"), "page_id")


@query(
    "html_comments",
    f"""SELECT 't1_' || doc_id AS id, {sql_safe("replace(text, '&', ' and ') || ' caf\u00e9 it\u2019s'")} AS text, source AS subreddit, 'A & B' AS post_title,
      doc_id % 50 - 25 AS upvotes, doc_id AS created_s FROM documents
      WHERE doc_id % 7 <> 3 AND {sql_words(sql_safe("replace(text, '&', ' and ') || ' caf\u00e9 it\u2019s'"))} >= 4""",
)
def html_comments(spark, d):
    """Pages with a comment each, quoted either way, its body in nested blocks, and a reply without a body; some ids come twice."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.replace(F.replace("text", F.lit("&"), F.lit(" and ")), F.lit("<"), F.lit("&lt;")).alias("body"))
    page = F.concat(
        F.lit("<a class='title x' href=\"#\">A &amp; B</a><div class='thing comment' data-fullname='t1_"), "doc_id",
        F.lit("'><span class=\"score unvoted\">"), (F.col("doc_id") % 50 - 25).cast("string"), F.lit(" points</span>"),
        F.when(F.col("doc_id") % 7 == 3, F.lit("<p>no body</p>")).otherwise(
            F.concat(F.lit("<div class=\"usertext md\"><div><p>"), "body", F.lit(" caf&eacute;</p></div> it&#8217;s</div>"))
        ),
        F.lit("<div class=\"comment\" id='r"), "doc_id", F.lit("'><p>reply</p></div></div><div class=\"comment\" data-fullname=\"t1_"), "doc_id",
        F.lit("\"><div class='md'>a later copy of this comment</div></div>"),
    )
    rows = pages.comment_records(docs.select("doc_id", "source", page.alias("html"), F.timestamp_seconds("doc_id").alias("at")), order_by=["doc_id"], subreddit="source", fetched="at")
    return rows.select("id", "text", "subreddit", "post_title", "upvotes", F.unix_seconds("created_utc").alias("created_s"))


@query(
    "export_flatten",
    """SELECT text, annotator, toxic, 0 AS harassment, 0 AS gender_attack, 0 AS slur, CASE WHEN annotator = 'B' THEN 1 - quality ELSE 0 END AS passive_toxic,
      CASE WHEN annotator = 'A' THEN 1 - toxic ELSE 0 END AS not_toxic, CASE WHEN annotator = 'A' THEN 'note ' || doc_id ELSE '' END AS notes
      FROM (SELECT doc_id, text, toxic, quality, unnest(['A', 'B']) AS annotator FROM documents JOIN labels USING (doc_id))""",
)
def export_flatten(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")

    def result(name, choices, note):
        value = F.struct(choices.alias("choices"), note.alias("text"))
        return F.struct(F.lit(name).alias("from_name"), value.alias("value"))

    no_choice, no_note = F.lit(None).cast("array<string>"), F.lit(None).cast("array<string>")
    toxic = F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array(F.lit("not_toxic")))
    toxic_only = F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>"))
    passive = F.when(F.col("quality") == 0, F.array(F.lit("passive_toxic"), F.lit("other"))).otherwise(
        F.array().cast("array<string>")
    )
    note = F.array(F.concat(F.lit("note "), "doc_id"), F.lit("second"))
    first = F.struct(
        F.lit("A").alias("completed_by"),
        F.array(
            result("notes", no_choice, F.array(F.lit("old"))), result("labels", toxic, no_note), result("notes", no_choice, note)
        ).alias("result"),
    )
    second = F.struct(
        F.lit("B").alias("completed_by"),
        F.array(result("labels", toxic_only, no_note), result("labels", passive, no_note)).alias("result"),
    )
    tasks = docs.select(F.struct("text").alias("data"), F.array(first, second).alias("annotations"))
    return annotations.flatten_export(tasks)


@query(
    "label_coerce",
    """SELECT doc_id, toxic, quality AS harassment, 0 AS gender_attack, 0 AS slur, 1 AS passive_toxic, 0 AS not_toxic, doc_id::VARCHAR AS text_clean FROM labels""",
)
def label_coerce(spark, d):
    raw = table(spark, d, "labels").select(
        "doc_id",
        F.concat("toxic", F.lit(".0")).alias("toxic"),
        F.concat(F.lit(" "), "quality").alias("harassment"),
        F.concat(F.lit("bad"), "toxic").alias("gender_attack"),
        F.lit(None).cast("string").alias("slur"),
        F.concat(F.lit("1."), "quality").alias("passive_toxic"),
        F.element_at(F.array(F.lit("nan"), F.lit("NaN"), F.lit("1e30"), F.lit("-inf")), (F.col("doc_id") % 4 + 1).cast("int")).alias("not_toxic"),
        F.col("doc_id").cast("string").alias("text"),
    )
    return coerce_labels(raw).drop("text")


@query("task_export", f"SELECT doc_id, text_clean AS task_text FROM {CLEAN} WHERE text_clean <> ''")
def task_export(spark, d):
    tasks = sinks.annotation_tasks(cleaned(spark, d, filtered=True), keep=["doc_id"])
    return tasks.select("doc_id", F.col("data.text").alias("task_text"))


@query(
    "label_long",
    " UNION ALL ".join(f"SELECT doc_id, '{x}' AS label, 1 AS value FROM {ANNOTATED} WHERE {x} = 1" for x in LABELS),
)
def label_long(spark, d):
    return ops.label_long(annotated(spark, d), ["doc_id"])
