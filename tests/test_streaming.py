"""Streams: outputs that become visible together, keys remembered for ever, a trend that corrects itself."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from modlens.operators import profile
from modlens.streaming import commits, ingest, live


def record(key, body="one two three four", **more):
    return json.dumps({"id": key, "subreddit": "VALORANT", "body": body, "created_utc": 1700000000, **more})


class Folder:
    """An ingest of a folder of text files."""

    def __init__(self, spark, tmp_path, **options):
        self.spark, self.path, self.options = spark, tmp_path, options
        (tmp_path / "in").mkdir()

    def put(self, name, *lines):
        (self.path / "in" / name).write_text("\n".join(lines) + "\n")

    def run(self, wrap=lambda lines: lines, **more):
        lines = wrap(ingest.dump_stream(self.spark, str(self.path / "in"), files_per_trigger=1))
        query = ingest.start_ingest(lines, str(self.path / "raw"), str(self.path / "state"), name=f"i{uuid.uuid4().hex}", **self.options, **more)
        query.awaitTermination()
        return query

    def read(self):
        records, malformed = ingest.read_ingest(self.spark, str(self.path / "raw"))
        return sorted((r.id, r.text) for r in records.collect()), sorted(r.value for r in malformed.collect())


def test_a_repeat_is_dropped_after_any_time(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    folder.put("a", record("1"), record("2"), "{bad")
    assert ingest.remembered_keys(folder.run()) == 3
    for name in "bc":  # restarts, much later as far as the stream can tell
        folder.put(name, record("1", "another text of the same id"), record(name), "{bad")
        folder.run()
    assert folder.read() == ([(f"comment_{i}", "one two three four") for i in "12bc"], ["{bad"])
    assert ingest.remembered_keys(folder.run()) in (0, 5)  # no new batch has no state to report


def test_a_horizon_bounds_the_state(spark, tmp_path):
    folder = Folder(spark, tmp_path, horizon="1 hour")
    folder.put("a", record("1"), record("1"), record("2"))
    folder.run()
    assert [r[0] for r in folder.read()[0]] == ["comment_1", "comment_2"]


def test_every_line_is_read_and_parsed_once(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    seen = spark.sparkContext.accumulator(0)

    def counted(lines):
        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return lines.mapInArrow(run, "value string")

    folder.put("a", *(record(str(i)) for i in range(20)), "{bad", "[1]")
    folder.run(counted)
    assert seen.value == 22
    records, malformed = folder.read()
    assert len(records) == 20 and malformed == ["[1]", "{bad"]


def test_a_crash_between_the_outputs_leaves_neither(spark, tmp_path, monkeypatch):
    folder = Folder(spark, tmp_path)
    folder.put("a", record("1"), "{bad")
    folder.run()
    folder.put("b", record("2"), "{worse")

    def crash(*_):
        raise RuntimeError("crash after both writes, before the commit")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", crash)
        with pytest.raises(Exception, match="crash"):
            folder.run()
    assert (tmp_path / "raw" / "records" / "batch=1").exists()
    assert folder.read() == ([("comment_1", "one two three four")], ["{bad"])
    folder.run()  # the same batch again
    assert [r[0] for r in folder.read()[0]] == ["comment_1", "comment_2"] and folder.read()[1] == ["{bad", "{worse"]


def test_a_table_belongs_to_one_checkpoint(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    assert ingest.read_ingest(spark, str(tmp_path / "raw"))[0].count() == 0
    folder.put("a", record("1"))
    folder.run()
    lines = ingest.dump_stream(spark, str(tmp_path / "in"))
    with pytest.raises(ValueError, match="checkpoint"):
        ingest.start_ingest(lines, str(tmp_path / "raw"), str(tmp_path / "other"))


def test_more_communities_than_a_literal_list(spark, tmp_path, monkeypatch):
    from modlens.operators import corpus

    monkeypatch.setattr(corpus, "LITERAL_LIST_LIMIT", 0)
    folder = Folder(spark, tmp_path, communities=["valorant", "x"])
    folder.put("a", record("1"), record("2", subreddit="other"), "{bad")
    folder.run()
    assert folder.read() == ([("comment_1", "one two three four")], ["{bad"])


def test_late_rows_correct_their_week(spark, tmp_path):
    """Rows three weeks late, rows without a date, a gap of weeks: at the end the stream's table is the batch's."""
    batches = [
        [("2024-03-20 10:00:00", 1, 0), ("2024-03-21 10:00:00", 0, None), (None, 1, 1)],
        [("2024-02-28 23:59:59", 1, 1)],
        [("2024-01-01 00:00:00", 0, 1), ("2024-03-20 10:00:00", 0, 1), ("2024-01-07 23:59:59", 1, 1)],
    ]
    schema = "created_utc timestamp, toxic int, slur int"
    everything = None
    for i, rows in enumerate(batches):
        part = spark.createDataFrame(rows, "s string, toxic int, slur int").select(F.col("s").cast("timestamp").alias("created_utc"), "toxic", "slur")
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        everything = part if everything is None else everything.unionByName(part)
        for _ in range(2):  # the second run has nothing to do
            stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
            query = live.start_trend(stream, str(tmp_path / "trend"), str(tmp_path / "state"), name=f"t{uuid.uuid4().hex}")
            query.awaitTermination()
            assert query.exception() is None
        want = sorted(map(tuple, profile.weekly_trend(everything, parse=False).select("week", "n_rows", "toxic", "slur").collect()))
        got = live.read_trend(spark, str(tmp_path / "trend"), ["toxic", "slur"])
        assert sorted(map(tuple, got.select("week", "n_rows", "toxic", "slur").collect())) == want
    assert len(want) == 12 and sum(r[1] == 0 for r in want) == 9
    assert commits.committed_batches(spark, str(tmp_path / "trend")) == [0, 1, 2]
