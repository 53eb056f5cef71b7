import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from etlkit.streaming.files import latest_rows, stream_files
from etlkit.streaming.sessions import _combine, _merged, closed_sessions, write_sessions

SCHEMA = "user long, at timestamp, amount double"
START, GAP = datetime(2024, 1, 1), 60


def brute(events, gap=GAP):
    """Sessions of (user, seconds, cents) as {(user, first, last, events, cents)}."""
    found = set()
    for user in {e[0] for e in events}:
        mine, run = sorted(e[1:] for e in events if e[0] == user), []
        for at, cents in mine + [(10**9, 0)]:
            if run and at - run[-1][0] >= gap:
                found.add((user, run[0][0], run[-1][0], len(run), sum(c for _, c in run)))
                run = []
            run.append((at, cents))
    return found


class Feed:
    """A folder that events are put into, one file a call, and a stream of closed sessions over it."""

    def __init__(self, spark, tmp_path, lateness):
        self.spark, self.base, self.lateness = spark, tmp_path, lateness

    def put(self, events):
        rows = [(u, START + timedelta(seconds=s), None if c is None else c / 100) for u, s, c in events]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def run(self, files=1, **settings):
        df = stream_files(self.spark, f"{self.base}/in", self.spark.createDataFrame([], SCHEMA).schema,
                          maxFilesPerTrigger=files)
        self.closed = closed_sessions(df, "user", "at", "amount", GAP, self.lateness)
        return write_sessions(self.closed, f"{self.base}/out", f"{self.base}/check", **settings)

    def rows(self):
        rows = latest_rows(self.spark, f"{self.base}/out", self.closed.schema, ["user", "window_start"]).collect()
        seconds = [((r["window_start"] - START).total_seconds(), (r["window_end"] - START).total_seconds() - GAP)
                   for r in rows]
        return sorted([(r["user"], int(a), int(b), r["events"], round(r["total"] * 100))
                       for r, (a, b) in zip(rows, seconds)], key=str)


@pytest.fixture
def feed(spark, tmp_path, conf):
    conf(spark__sql__shuffle__partitions="2")
    return lambda lateness: Feed(spark, tmp_path, lateness)


def test_sessions_close_by_timer_and_survive_restarts(feed):
    rng = random.Random(3)
    events = [(rng.choice([1, 1, 1, 2, None]), rng.randrange(3000), rng.randrange(500)) for _ in range(120)]
    events.sort(key=lambda e: e[1] + rng.randrange(200))
    stream = feed("10 minutes")
    for i in range(0, 120, 40):
        stream.put(events[i:i + 40])
        stream.run()
    mark = max(e[1] for e in events) - 600
    assert stream.rows() == sorted([s for s in brute(events) if s[2] + GAP < mark], key=str)
    stream.put([(9, 100_000, 0)])
    stream.run()
    assert stream.rows() == sorted(brute(events), key=str)


def test_late_rows_raise_or_are_dropped(feed):
    stream = feed("0 seconds")
    stream.put([(1, 0, 100), (1, 5, None)])
    stream.put([(2, 1000, 1)])
    stream.run()
    assert stream.rows() == [(1, 0, 5, 2, 100)]
    stream.put([(1, 3, 7)])
    with pytest.raises(ValueError, match="later than the watermark"):
        stream.run()
    stream.put([(3, 5000, 1)])
    stream.run(late="drop")
    assert stream.rows() == [(1, 0, 5, 2, 100), (2, 1000, 1000, 1, 1)]


def test_an_event_at_the_end_of_a_session_opens_another(feed):
    stream = feed("0 seconds")
    stream.put([(1, 0, 1), (1, 60, 2), (1, 119, 3), (2, 9999, 0)])
    stream.run()
    assert stream.rows() == [(1, 0, 0, 1, 1), (1, 60, 119, 2, 5)]


def test_state_rows_stay_bounded(feed):
    stream = feed("2 minutes")
    for i in range(24):
        stream.put([(1, 600 * i + s, 1) for s in (0, 10, 300)] + [(i + 10, 600 * i, 1)])
    query = stream.run()
    held = [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress]
    # Each open session is an entry and a timer, in at most two indexes.
    assert len(held) >= 24 and max(held) <= 24


def test_many_sessions_share_the_entries_and_timers_of_their_group(spark, tmp_path, conf):
    conf(spark__sql__shuffle__partitions="2")
    rng = random.Random(5)
    events = [(rng.choice([None, *range(300)]), rng.randrange(900), rng.randrange(500)) for _ in range(2000)]
    events += [(0, 5000, 1)]
    rows = [(u, START + timedelta(seconds=s), c / 100) for u, s, c in events]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/in")
    df = stream_files(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema)
    closed = closed_sessions(df, "user", "at", "amount", GAP, "10 minutes", groups=4)
    query = write_sessions(closed, f"{tmp_path}/out", f"{tmp_path}/check")
    held = [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress]
    # A group is an entry and a timer, in two indexes; each of the 301 keys has open sessions of its own.
    assert 0 < max(held) <= 12
    got = latest_rows(spark, f"{tmp_path}/out", closed.schema, ["user", "window_start"]).collect()
    assert sorted([(r["user"], r["events"], round(r["total"] * 100)) for r in got], key=str) == sorted(
        [(u, n, c) for u, _, last, n, c in brute(events) if last + GAP < 4400], key=str)


def test_sessions_of_a_group_merge_across_parts():
    parts = [pd.DataFrame(rows, columns=["key", "first", "last", "events", "cents"]) for rows in (
        [("a", 0, 500, 9, 1), ("b", 90, 90, 1, 2), (None, 10, 20, 2, 3)],
        [("a", 100, 110, 2, 4), ("a", 590, 600, 2, 5), ("a", 700, 700, 1, 6), (None, 119, 119, 1, 7)])]
    got = {(None if pd.isna(k) else k, *rest) for k, *rest in _merged(parts, 100).itertuples(index=False)}
    assert got == {("a", 0, 600, 13, 10), ("a", 700, 700, 1, 6), ("b", 90, 90, 1, 2), (None, 10, 119, 3, 10)}


def test_events_merge_before_the_shuffle():
    batch = pd.DataFrame({"key": ["a", None, "a", "b", None], "at": [50, 10, 0, 55, 400], "cents": [1, 2, 3, 4, 5]})
    [merged] = _combine(100)(iter([batch, batch.head(0)]))
    got = {(None if pd.isna(k) else k, *rest) for k, *rest in merged.itertuples(index=False)}
    assert got == {("a", 0, 50, 2, 4), ("b", 55, 55, 1, 4), (None, 10, 10, 1, 2), (None, 400, 400, 1, 5)}
