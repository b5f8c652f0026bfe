"""Served tables, and the last-N job over restarts, late events and idle users."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfrank.sources.served import MANIFEST, ServedTable
from shelfrank.streaming import jobs


def folders(path):
    return [p for p in path.iterdir() if p.is_dir()]


def test_replace_keeps_the_old_table_for_readers(spark, tmp_path):
    served = ServedTable(spark, str(tmp_path / "t"), ["k"])
    assert served.read("k long").count() == 0
    with pytest.raises(FileNotFoundError):
        served.read()
    served.replace(spark.range(3).toDF("k"), 0)
    old = served.read()
    served.replace(spark.range(5).toDF("k"), 1)
    assert old.count() == 3 and served.read().count() == 5
    served.replace(spark.range(9).toDF("k"), 1)  # the batch runs again
    assert served.read().count() == 5
    for batch in range(2, 8):
        served.replace(spark.range(batch).toDF("k"), batch)
    assert served.read().count() == 7
    assert len(folders(tmp_path / "t")) == 3  # the table and two for readers that have begun


def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    served = ServedTable(spark, str(tmp_path / "t"), ["k"])
    served.replace(spark.range(3).toDF("k"), 0)
    monkeypatch.setattr(served, "_swap", lambda manifest: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        served.replace(spark.range(9).toDF("k"), 1)
    fresh = ServedTable(spark, str(tmp_path / "t"), ["k"])
    assert fresh.read().count() == 3
    fresh.replace(spark.range(4).toDF("k"), 1)
    assert fresh.read().count() == 4
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_file() and p.name[0] == "_") == [MANIFEST]


def test_upserts_equal_a_dictionary(spark, tmp_path):
    served = ServedTable(spark, str(tmp_path / "t"), ["k"], max_deltas=3)
    rng, want = random.Random(5), {}
    for batch in range(10):
        changes = {rng.choice([None, 1, 2, 3, 4, 5]): (rng.random(), rng.random() < 0.3) for _ in range(3)}
        rows = [(k, v, gone) for k, (v, gone) in changes.items()]
        served.upsert(spark.createDataFrame(rows, "k long, v double, deleted boolean").coalesce(1), batch)
        for k, v, gone in rows:
            want.pop(k, None)
            if not gone:
                want[k] = v
        assert {r.k: r.v for r in served.read().collect()} == want
        assert len(served.manifest()["folders"]) <= 3
        held = {f for names in served.manifest()["retired"] for f in names} | set(served.manifest()["folders"])
        assert {p.name for p in folders(tmp_path / "t")} == held and len(held) <= 6


class Feed:
    """A folder of event files and the last-N job over it, started anew for every call."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, path, 0
        (path / "in").mkdir()

    def put(self, *rows):
        self.files += 1
        full = [(i, ts, user, kind, 1.0) for i, (ts, user, kind) in enumerate(rows)]
        part = self.spark.createDataFrame(full, jobs.FILE_SCHEMA).coalesce(1)
        part.write.mode("append").parquet(str(self.path / "in"))

    def run(self, n, **settings):
        stream = jobs.events_stream(self.spark, str(self.path / "in"), "*.parquet")
        jobs.last_n_events(stream, n, str(self.path / "out"), str(self.path / "c"), **settings).awaitTermination()
        return {r.user_id: r.events for r in jobs.latest_states(self.spark, str(self.path / "out")).collect()}

    def state(self):
        rows = self.spark.read.format("statestore").option("stateVarName", "recent").load(str(self.path / "c"))
        sizes = rows.groupBy("key.user_id").agg(F.count(F.lit(1)).alias("n"))
        return {r.user_id: r.n for r in sizes.collect()}


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def test_last_events_over_restarts(spark, tmp_path):
    feed, rng, seen = Feed(spark, tmp_path), random.Random(3), []
    for _ in range(3):
        rows = [
            (datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(10**6)), rng.choice([1, 2, None]), rng.choice("abc"))
            for _ in range(40)
        ]
        rows += [(None, 1, "z"), (day(1), 3, None), (day(1), 3, "a")]
        feed.put(*rows)
        seen += [r for r in rows if r[0] is not None]
        got = feed.run(5)
        for user in (1, 2, 3, None):
            mine = sorted((ts, kind is not None, kind) for ts, u, kind in seen if u == user)
            assert got[user] == [kind for *_, kind in mine[-5:]]
    assert feed.state() == {1: 5, 2: 5, 3: 5, None: 5}


def test_late_events_take_their_place(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.put((day(10), 1, "c"), (day(12), 1, "d"))
    assert feed.run(3) == {1: ["c", "d"]}
    feed.put((day(11), 1, "late"), (day(2), 1, "older"), (day(1), 1, "oldest"))
    assert feed.run(3) == {1: ["c", "late", "d"]}


def test_idle_users_leave_state_and_table(spark, tmp_path):
    feed, idle = Feed(spark, tmp_path), timedelta(days=3)
    feed.put((day(1), 1, "a"), (day(1), 2, "a"))
    assert feed.run(3, idle=idle) == {1: ["a"], 2: ["a"]}
    feed.put((day(4), 2, "b"))  # watermark: 3 January, user 1 stays until the 4th
    assert feed.run(3, idle=idle) == {1: ["a"], 2: ["a", "b"]}
    feed.put((day(6), 3, "a"))
    assert feed.run(3, idle=idle) == {2: ["a", "b"], 3: ["a"]}
    assert feed.state() == {2: 2, 3: 1}
    feed.put((day(2), 1, "too late"), (day(20), 3, "b"))
    feed.run(3, idle=idle)
    feed.put((day(21), 1, "back"))
    assert feed.run(3, idle=idle) == {1: ["back"], 3: ["a", "b"]}
