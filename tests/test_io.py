"""Sources, sinks and streams on files written to a temporary folder."""

import json
import uuid

import pytest
import zstandard
from pyspark.sql import functions as F

from modlens import sinks
from modlens.plans.corpus import ingest_dumps
from modlens.plans.reports import agreement_report
from modlens.schemas import RAW_TEXT
from modlens.sources import annotations, comments, dumps, pages, payloads
from modlens.streaming import ingest, live


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([("1", 'say "hi"\nnow, ok', None), ("2", "NA", "x")], "id string, text string, post_title string")
    sinks.write_csv(df, path)
    got = sorted(tuple(r) for r in comments.read_raw_comments(spark, path).collect())
    assert got == [("1", 'say "hi"\nnow, ok', ""), ("2", "NA", "x")]
    mimic = comments.read_raw_comments(spark, path, missing_words=True)
    assert mimic.filter("id = '2'").first().text == ""


def test_csv_needs_its_column(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Id,other\n1,x\n")
    with pytest.raises(ValueError, match="utterance"):
        comments.read_chat(spark, str(tmp_path / "c.csv"))


def test_posts_fall_back_to_json_lines(spark, tmp_path):
    lines = tmp_path / "posts.jsonl"
    lines.write_text('{"id": "1", "text": "a"}\n\n{bad\n{"id": "2", "text": "b"}\n')
    got = comments.read_posts(spark, str(tmp_path / "none.csv"), str(lines), RAW_TEXT)
    assert sorted(r.text for r in got.collect()) == ["a", "b"]
    (tmp_path / "some.csv").write_text("id,text\n9,z\n")
    assert comments.read_posts(spark, str(tmp_path / "some.csv"), str(lines), RAW_TEXT).first().text == "z"
    with pytest.raises(FileNotFoundError):
        comments.read_posts(spark, str(tmp_path / "x"), str(tmp_path / "y"), RAW_TEXT)


def test_annotated_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,toxic,slur\nhello,1.0,\nbye,x,1\n")
    got = sorted((r.text_clean, r.toxic, r.slur) for r in comments.read_annotated(spark, str(tmp_path / "a.csv")).collect())
    assert got == [("bye", 0, 1), ("hello", 1, 0)]


COMMENTS = [
    {"id": "c1", "subreddit": "VALORANT", "body": "one two three four", "score": 5, "created_utc": 1700000000},
    {"id": "c1", "subreddit": "VALORANT", "body": "one two three four again", "score": 6, "created_utc": "1700000009"},
    {"id": "c2", "subreddit": " agentacademy ", "body": "you are a bot [ok](http://x.y)", "created_utc": None},
    {"id": "c3", "subreddit": "other", "body": "one two three four"},
    {"id": "c4", "subreddit": "VALORANT", "body": None},
    {"id": "c5", "subreddit": "VALORANT", "body": "too short"},
]
POSTS = [{"id": "p1", "subreddit": "VALORANT", "title": "A title", "selftext": "with some text", "score": 3.7, "created_utc": 1700000000.5}]


def write_zst(path, records, extra=""):
    data = "".join(json.dumps(r) + "\n" for r in records) + extra
    path.write_bytes(zstandard.ZstdCompressor().compress(data.encode()))


@pytest.fixture
def dump_folder(tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    write_zst(folder / "RC_2024-01.zst", COMMENTS, "{bad line\n\n[1]\n")
    write_zst(folder / "RS_2024-01.zst", POSTS)
    return folder


def test_dump_ingest(spark, dump_folder):
    out = {r.id: r for r in ingest_dumps(spark, glob=f"{dump_folder}/*.zst").collect()}
    assert set(out) == {"comment_c1", "comment_c2", "submission_p1"}
    assert out["comment_c1"].upvotes == 5 and out["comment_c2"].text == "you are a bot ok"
    assert out["comment_c2"].subreddit == "agentacademy" and out["comment_c2"].created_utc is None
    post = out["submission_p1"]
    assert (post.text, post.post_title, post.upvotes) == ("A title with some text", "A title", 3)
    assert post.source == "pushshift" and post.created_utc.microsecond == 500000


def test_dump_options(spark, dump_folder):
    glob = f"{dump_folder}/*.zst"
    ids = lambda **o: sorted(r.id for r in ingest_dumps(spark, glob=glob, **o).collect())
    assert ids(include_comments=False) == ["submission_p1"]
    assert ids(include_submissions=False) == ["comment_c1", "comment_c2"]
    assert ids(keyword_only=True) == ["comment_c2"]
    assert ids(communities=["OTHER"]) == ["comment_c3"]
    assert len(ids(dedupe=False)) == 4 and len(ids(max_rows=2)) == 2
    with pytest.raises(ValueError):
        ids(include_comments=False, include_submissions=False)
    with pytest.raises(FileNotFoundError):
        ingest_dumps(spark, paths=[str(dump_folder / "missing.zst")])


def test_files_of_other_kinds_are_not_read(spark, dump_folder):
    lines = dumps.read_dump_lines(spark, glob=f"{dump_folder}/*.zst", include_comments=False)
    assert lines.count() == len(POSTS)


def test_stream_equals_batch(spark, dump_folder, tmp_path):
    def run():
        lines = ingest.dump_stream(spark, str(dump_folder))
        query = ingest.start_ingest(lines, str(tmp_path / "raw"), str(tmp_path / "state"), name=f"ingest_{uuid.uuid4().hex}")
        query.awaitTermination()
        assert query.exception() is None

    run()
    columns = ["id", "text", "subreddit", "post_title", "upvotes", "created_utc", "source"]
    got = sorted(map(tuple, ingest.read_ingest(spark, str(tmp_path / "raw"))[0].select(columns).collect()))
    want = {r[0]: tuple(r) for r in ingest_dumps(spark, glob=f"{dump_folder}/*.zst", dedupe=False).select(columns).collect()}
    both = {tuple(r) for r in ingest_dumps(spark, glob=f"{dump_folder}/*.zst", dedupe=False).select(columns).collect()}
    assert [r[0] for r in got] == sorted(want) and set(got) <= both
    run()  # a restart with the same state repeats nothing
    records, malformed = ingest.read_ingest(spark, str(tmp_path / "raw"))
    assert sorted(r.value for r in malformed.collect()) == ["[1]", "{bad line"]
    assert records.count() == 3


def test_stream_trend(spark, tmp_path):
    src = tmp_path / "src"
    days = ["2024-01-07 23:59:59", "2024-01-08 00:00:00", "2024-01-09 00:00:00", "2024-03-01 00:00:00"]
    df = spark.createDataFrame([(d, i % 2) for i, d in enumerate(days)], "d string, toxic int")
    df = df.select(F.to_timestamp("d").alias("created_utc"), "toxic")
    df.coalesce(1).write.parquet(str(src))
    stream = live.closed_weeks(spark.readStream.schema(df.schema).parquet(str(src)))
    query = (
        stream.writeStream.format("memory").queryName("trend").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert live.late_rows(query) == 0
    got = sorted((str(r.week), r.n_rows, r.toxic) for r in spark.table("trend").collect())
    assert got == [("2024-01-07", 1, 0.0), ("2024-01-14", 2, 0.5)]


def test_stream_moderation_gives_every_core_a_file(spark, monkeypatch, tmp_path):
    from modlens.catalog import file_queries

    monkeypatch.setattr(file_queries, "shared_folder", lambda spark, name: f"{tmp_path}/{name}")
    docs = spark.createDataFrame([(i, "you noob" if i % 4 else "well played", "s") for i in range(400)], "doc_id bigint, text string, source string")
    docs.write.parquet(f"{tmp_path}/in/documents.parquet")
    rows = file_queries.stream_moderation(spark, f"{tmp_path}/in").collect()
    assert sorted(r.doc_id for r in rows) == list(range(400)) and all(r.alerted == r.is_toxic for r in rows)
    assert len(list((tmp_path / "texts").glob("part-*.parquet"))) == 3 * spark.sparkContext.defaultParallelism
    assert len([p for p in (tmp_path / "moderated" / "_commits").iterdir() if p.name.isdigit()]) == 3


def test_stream_moderation(spark, tmp_path):
    src = tmp_path / "src"
    df = spark.createDataFrame([(1, "ggez you bot"), (2, "hello there")], "id int, text string")
    df.write.parquet(str(src))
    stream = live.moderated(spark.readStream.schema(df.schema).parquet(str(src)))
    live.start_moderation(stream, str(tmp_path / "out"), str(tmp_path / "state"), name=f"mod_{uuid.uuid4().hex}").awaitTermination()
    rows, alerts = live.read_moderation(spark, str(tmp_path / "out"), stream.schema)
    assert rows.count() == 2 and [r.id for r in alerts.collect()] == [1]


def test_annotator_files(spark, tmp_path):
    head = "text,toxic,harassment,gender_attack,slur,passive_toxic,not_toxic\n"
    (tmp_path / "iaa_annotator_ann b.csv").write_text(head + "t1,1,0,0,0,0,0\nt2,0,0,0,0,0,1\n")
    with pytest.raises(ValueError):
        annotations.read_annotators(spark, str(tmp_path))
    (tmp_path / "iaa_annotator_cy.csv").write_text(head + "t2,0,0,0,0,0,1\nt1,1,0,0,0,0,0\n")
    rows = annotations.read_annotators(spark, str(tmp_path))
    assert {r.annotator for r in rows.collect()} == {"ann b", "cy"}
    out = agreement_report(rows.withColumnRenamed("text", "item"))
    assert {r.kappa for r in out["cohens_kappa"].collect() if r.label in ("toxic", "not_toxic")} == {1.0}
    assert out["incomplete_items"].count() == 0
    sinks.write_reports(out, str(tmp_path / "reports"))
    assert spark.read.option("header", True).csv(str(tmp_path / "reports" / "fleiss_kappa")).count() == 6


def test_export_file(spark, tmp_path):
    task = {
        "data": {"text": "t"},
        "annotations": [
            {"completed_by": "a", "result": [
                {"from_name": "labels", "value": {"choices": ["toxic", "slur"]}},
                {"from_name": "labels", "value": {"choices": ["slur", "odd"]}},
                {"from_name": "notes", "value": {"text": ["first"]}},
                {"from_name": "notes", "value": {"text": ["last", "x"]}},
            ]},
            {"completed_by": "b", "result": []},
        ],
    }
    (tmp_path / "e.json").write_text(json.dumps([task, {"data": {}, "annotations": []}]))
    got = sorted((r.annotator, r.toxic, r.slur, r.notes) for r in annotations.flatten_export(annotations.read_export(spark, str(tmp_path / "e.json"))).collect())
    assert got == [("a", 1, 1, "last"), ("b", 0, 0, "")]


def test_tasks_and_splits(spark, tmp_path):
    df = spark.createDataFrame([("a b", "iaa"), ("", "batch_1"), (None, "batch_1")], "text_clean string, split string")
    sinks.write_annotation_tasks(df, str(tmp_path / "tasks"))
    assert [r.data.text for r in spark.read.json(str(tmp_path / "tasks")).collect()] == ["a b"]
    sinks.write_splits(df, str(tmp_path / "splits"))
    assert (tmp_path / "splits" / "split=iaa").is_dir() and (tmp_path / "splits" / "split=batch_1").is_dir()
    sinks.write_table(df, str(tmp_path / "table"), ["split"])
    assert spark.read.parquet(str(tmp_path / "table")).count() == 3


@pytest.mark.parametrize(
    ("body", "ids"),
    [
        ('[{"id": 1}, 5, {"id": 2}]', ["1", "2"]),
        ('{"posts": [], "data": {"items": [{"id": "a"}]}}', ["a"]),
        ('{"comments": {"0": {"comment_id": "x"}, "1": {"comment_id": "y"}}}', ["x", "y"]),
        ('{"results": {"data": [{"id": "r"}]}}', ["r"]),
        ('{"0": {"id": "m"}}', ["m"]),
        ('{"message": "none"}', []),
        ("{bad", []),
    ],
)
def test_envelopes(spark, body, ids):
    df = spark.createDataFrame([(body,)], "body string")
    out = payloads.comment_columns(payloads.flatten_envelopes(df))
    assert sorted(r.comment_id for r in out.collect()) == ids


def test_posts_stand_in_for_missing_comments(spark):
    df = spark.createDataFrame(
        [('{"posts": [{"id": "p", "title": "title of this post", "score": 2, "url": "/p"}, {"id": "q", "title": "x", "permalink": "/q"}, {"id": "z", "title": "a post without any link"}, {"title": "no id at all here"}]}', "v")],
        "body string, subreddit string",
    )
    posts = payloads.post_columns(payloads.flatten_envelopes(df, keep=["subreddit"]), ["subreddit"])
    found = spark.createDataFrame([("q", "c1", "one two three four", "1", "")], "post_id string, comment_id string, body string, score string, created_utc string")
    out = {r.id: r.text for r in payloads.posts_with_comments(posts, found).collect()}
    assert out == {"post_p": "title of this post", "c1": "one two three four"}


def test_an_id_counts_once(spark):
    posts = spark.createDataFrame(
        [("p", "short", "", "1", "1", "/p", "v"), ("p", "now it is long enough", "", "2", "2", "/p", "v"), ("q", "t", "", "1", "1", "/q", "v"), ("q", "t2", "", "1", "2", "/q", "v")],
        "post_id string, title string, selftext string, score string, created_utc string, link string, subreddit string",
    )
    comments = spark.createDataFrame(
        [("q", "c", "too short", "1", "1"), ("q", "c", "long enough but it came later", "1", "2"), ("q", "d", "one two three four", "1", "1")],
        "post_id string, comment_id string, body string, score string, created_utc string",
    )
    out = sorted((r.id, r.text, r.post_title) for r in payloads.posts_with_comments(posts, comments).collect())
    assert out == [("d", "one two three four", "t"), ("post_p", "now it is long enough", "now it is long enough")]


def test_envelopes_of_any_depth(spark):
    bodies = ['{"data":{"results":{"items":[{"id":"x"}]}}}', '{"data":{"data":{"posts":[{"id":"y"}]}}}', '{"posts":{"data":{"items":[{"id":"z"}]}}}',
              '{"data":' * 6 + '{"0":{"id":"w"}}' + "}" * 6, '{"items":[1],"data":{"comments":[{"id":"v"}]}}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate([*bodies, "{bad", '{"data": {}}', None])], "n int, body string")
    out = payloads.flatten_envelopes(df, keep=["n"]).select("n", payloads.record_text(F.col("record"), "id").alias("id"))
    assert sorted((r.n, r.id) for r in out.collect()) == [(0, "x"), (1, "y"), (2, "z"), (3, "w"), (4, "v")]
    rejected = payloads.unresolved_envelopes(df, keep=["n"]).collect()
    assert sorted((r.n, r.parsed) for r in rejected) == [(5, False), (6, True), (7, False)]


def test_comment_markup_of_all_kinds(spark):
    page = """<div class='comment' id='k'><div class=md>one <div>two three</div> four it&#8217;s caf&eacute; &mdash;</div></div>"""
    out = pages.comment_records(spark.createDataFrame([(page, "s")], "html string, sub string"), subreddit="sub").first()
    assert (out.id, out.text, out.subreddit, out.created_utc) == ("k", "one two three four it\u2019s caf\u00e9 \u2014", "s", None)


PAGE = """<html><script>var x='<div class="comment">';</script><a class="title may-blank" href="#">The &amp; title</a>
<div class="thing comment x" data-fullname="t1_a"><span class="score unvoted">-3 points</span>
<div class="usertext md"><p>one two</p><p>three &lt;four&gt;</p></div>
<div class="child"><div class="comment" id="b"><div class="md">five six seven eight</div></div></div></div>
<div class="comment" data-fullname="t1_a"><div class="md">a copy of the first</div></div>
<div class="comment" data-fullname="t1_c"><div class="md">short</div></div>
<div class="comment" data-fullname="t1_d"><p>no body in this one</p></div>
<div class="comment"><div class="md">no id in this one</div></div>
<span class="next-button"><a href="https://h/?count=25&amp;after=t3_zz" rel="next">next</a></span></html>"""


def test_comment_pages(spark):
    df = spark.createDataFrame([(1, PAGE)], "page int, html string")
    out = {r.id: r for r in pages.comment_records(df, order_by=["page"]).collect()}
    assert {k: (v.text, v.upvotes) for k, v in out.items()} == {
        "t1_a": ("one two three <four>", -3), "b": ("five six seven eight", 0)
    }
    assert out["b"].post_title == "The & title"
    assert df.select(pages.next_cursor(F.col("html")).alias("c")).first().c == "t3_zz"


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    for write, read in ((sinks.write_table, spark.read.parquet), (sinks.write_csv, lambda p: spark.read.option("header", True).csv(p))):
        good = spark.range(5).select(F.col("id").cast("string").alias("id"))
        write(good, path)
        write(good, path)  # over itself
        bad = spark.range(1000).repartition(8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("half-way"))).otherwise(F.col("id").cast("string")).alias("id"))
        with pytest.raises(Exception, match="half-way"):
            write(bad, path)
        assert sorted(r.id for r in read(path).collect()) == list("01234")
        assert [p.name for p in tmp_path.iterdir()] == ["t"]
    sinks.write_table(spark.read.option("header", True).csv(path).where("id < 3"), path)  # a table may be written over itself
    assert spark.read.parquet(path).count() == 3


def test_a_swap_that_was_cut_off_is_taken_back(spark, tmp_path):
    path = tmp_path / "t"
    sinks.write_table(spark.range(3), str(path))
    path.rename(tmp_path / ".t.old")  # the moment between the two renames
    with pytest.raises(Exception, match="no"):
        sinks.replace_folder(spark, str(path), lambda to: (_ for _ in ()).throw(OSError("no")))
    assert spark.read.parquet(str(path)).count() == 3
    sinks.write_table(spark.range(4), str(path))
    assert spark.read.parquet(str(path)).count() == 4 and [p.name for p in tmp_path.iterdir()] == ["t"]
    sinks.write_table(spark.range(1), str(tmp_path / "deep" / "er"))
    sinks.write_table(spark.range(1), str(tmp_path / "deep" / "er"), mode="append")
    assert spark.read.parquet(str(tmp_path / "deep" / "er")).count() == 2
