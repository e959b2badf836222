"""Streams against batch results: arrival orders, late rows, restarts."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tabfold.streaming import runs
from tabfold.streaming import file_stream, run_available, session_stream, sessions_of, window_stream, windows_of

SCHEMA = "user string, ts timestamp, x long"
GAP = 100


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def events(seed, n=400):
    draw = random.Random(seed)
    return [(draw.choice(["hot", "hot", "a", "b", None]), draw.choice([None] + [draw.randint(0, 6000)] * 20), draw.choice([None, 1, 5])) for _ in range(n)]


def files(spark, folder, parts):
    """One file per part, each newer than the one before."""
    paths = []
    for i, part in enumerate(parts):
        rows = spark.createDataFrame(part, "user string, s long, x long").select("user", F.timestamp_seconds("s").alias("ts"), "x")
        rows.coalesce(1).write.mode("append").parquet(folder)
        new = sorted(set(glob.glob(f"{folder}/*.parquet")) - set(paths))
        for path in new:
            os.utime(path, (1_700_000_000 + 10 * i,) * 2)
        paths += new
    return spark.read.schema(SCHEMA).parquet(folder).schema


def dealt(rows, by_time):
    """Five parts: in the order of time but for a disorder of 500 seconds, or in any order."""
    draw = random.Random(9)
    place = (lambda r: (r[1] or 0) + draw.randint(0, 500)) if by_time else (lambda _: draw.random())
    rows = sorted(rows, key=place)
    return [rows[i * len(rows) // 5 : (i + 1) * len(rows) // 5] for i in range(5)]


def windows(stream, delay, **options):
    found = {"n": ("count", "*"), "total": ("sum", "x"), "least": ("min", "x")}
    return window_stream(stream, "ts", "600 seconds", delay, found, by=["user"], **options)


def batch_windows(rows):
    wanted = {}
    for user, at, x in rows:
        if at is not None:
            wanted.setdefault((at // 600 * 600, user), []).append(x)
    return sorted(((s, u, len(v), sum(filter(None, v)) if any(v) else None, min(filter(None, v), default=None)) for (s, u), v in wanted.items()), key=repr)


def of_windows(spark, run, schema):
    found = windows_of(spark, run, schema, ["user"])
    return rows_of(found.select(F.unix_seconds("start"), "user", "n", "total", "least"))


@pytest.mark.parametrize("by_time, delay", [(True, "700 seconds"), (False, "7000 seconds")])
def test_windows_equal_the_batch_in_any_order_within_the_delay(spark, tmp_path, by_time, delay):
    rows = events(1)
    schema = files(spark, f"{tmp_path}/in", dealt(rows, by_time))
    stream = windows(file_stream(spark, f"{tmp_path}/in", schema, files_at_once=1), delay)
    run = run_available(stream, f"{tmp_path}/run")
    assert run.rows == len(rows) and run.late == 0 and run.batches >= 5
    assert of_windows(spark, run, stream.schema) == batch_windows(rows)
    final = spark.read.parquet(run.output).count()
    assert (final > 0) == by_time


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    first = [("a", s, 1) for s in range(0, 5000, 50)]
    late = [("a", 100, 1), ("b", 200, 1), ("a", 4900, 1)]
    schema = files(spark, f"{tmp_path}/in", [first, [("z", 5000, 1)], late])
    stream = windows(file_stream(spark, f"{tmp_path}/in", schema, files_at_once=1), "600 seconds")
    run = run_available(stream, f"{tmp_path}/run")
    # Counted as they meet the state: one a user and window.
    assert run.late == 2
    assert of_windows(spark, run, stream.schema) == batch_windows([*first, ("z", 5000, 1), late[2]])


def sessions(rows, gap=GAP):
    found = []
    for user in {r[0] for r in rows if r[0] is not None}:
        times = sorted((r[1], r[2] or 0) for r in rows if r[0] == user and r[1] is not None)
        for at, x in times:
            if found and found[-1][0] == user and at - found[-1][2] <= gap:
                last = found.pop()
                found.append((user, last[1], at, last[3] + 1, last[4] + x))
            else:
                found.append((user, at, at, 1, x))
    return sorted(found, key=repr)


def of_sessions(spark, run):
    found = sessions_of(spark, run, "string")
    seconds = lambda c: (F.col(c) / 1_000_000).cast("long")
    return rows_of(found.select("key", seconds("start"), seconds("end"), "n", "total"))


@pytest.mark.parametrize("by_time, delay", [(True, "700 seconds"), (False, "7000 seconds")])
def test_sessions_equal_gaps_and_islands(spark, tmp_path, by_time, delay):
    rows = events(2)
    schema = files(spark, f"{tmp_path}/in", dealt(rows, by_time))
    stream = session_stream(file_stream(spark, f"{tmp_path}/in", schema, files_at_once=1), "user", "ts", GAP, delay, amount="x")
    run = run_available(stream, f"{tmp_path}/run")
    assert run.late == 0 and of_sessions(spark, run) == sessions(rows)
    assert (spark.read.parquet(run.output).count() > 0) == by_time


def test_keys_of_sessions_meet_no_python_and_hot_ones_are_joined_in_their_tasks(spark, tmp_path, capsys):
    schema = files(spark, f"{tmp_path}/in", [[("hot", s, 1) for s in range(0, 5000, 50)]])
    stream = session_stream(file_stream(spark, f"{tmp_path}/in", schema), "user", "ts", GAP, "600 seconds", amount="x")
    stream.explain(extended=True)
    plan = capsys.readouterr().out
    assert "session_window" in plan and not any(s in plan for s in ("Pandas", "Python", "InArrow"))
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name)
    with runs.settings(spark):
        assert spark.conf.get(name) == "true"
    run = run_available(stream, f"{tmp_path}/run")
    assert spark.conf.get(name) == before
    assert of_sessions(spark, run) == [("hot", 0, 4950, 100, 100)]


def test_sessions_of_rows_at_the_gap_and_at_the_watermark(spark, tmp_path):
    # The second file's row is as late as the delay allows and a gap after the first session's end.
    parts = [[("a", 0, 1), ("a", 100, 1), ("b", 300, 1)], [("a", 200, 1)], [("a", 301, None), ("c", 5000, 1)], [("z", 10, 1)]]
    schema = files(spark, f"{tmp_path}/in", parts)
    stream = session_stream(file_stream(spark, f"{tmp_path}/in", schema, files_at_once=1), "user", "ts", GAP, "100 seconds", amount="x")
    run = run_available(stream, f"{tmp_path}/run")
    assert of_sessions(spark, run) == [("a", 0, 200, 3, 3), ("a", 301, 301, 1, 0), ("b", 300, 300, 1, 1), ("c", 5000, 5000, 1, 1)]
    assert run.late == 1
    found = sessions_of(spark, run, "string")
    assert [tuple(r) for r in found.where("not final").select("key", "n").collect()] == [("c", 1)]


def test_restarts_add_nothing_twice(spark, tmp_path):
    rows = events(3)
    parts = dealt(rows, True)
    schema = files(spark, f"{tmp_path}/in", parts[:3])
    read = lambda: file_stream(spark, f"{tmp_path}/in", schema, files_at_once=1)
    make = {"w": lambda: windows(read(), "700 seconds"), "s": lambda: session_stream(read(), "user", "ts", GAP, "700 seconds", amount="x")}
    for name, stream in make.items():
        run_available(stream(), f"{tmp_path}/{name}")
        # As if it had been lost before it could note the end of its last batch.
        commits = f"{tmp_path}/{name}/checkpoint/commits"
        last = max(int(f) for f in os.listdir(commits) if f.isdigit())
        for path in (f"{commits}/{last}", f"{commits}/.{last}.crc"):
            if os.path.exists(path):
                os.unlink(path)
    # More files come, the same names go on.
    for i, part in enumerate(parts[3:]):
        more = spark.createDataFrame(part, "user string, s long, x long").select("user", F.timestamp_seconds("s").alias("ts"), "x")
        more.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for name, stream in make.items():
        run = run_available(stream(), f"{tmp_path}/{name}")
        if name == "w":
            assert of_windows(spark, run, stream().schema) == batch_windows(rows)
        else:
            assert of_sessions(spark, run) == sessions(rows)
        again = run_available(stream(), f"{tmp_path}/{name}")
        assert again.rows == 0


def test_an_aggregate_asked_for_twice_is_refused(spark, tmp_path):
    schema = files(spark, f"{tmp_path}/in", [[("a", 1, 1)]])
    with pytest.raises(ValueError):
        window_stream(file_stream(spark, f"{tmp_path}/in", schema), "ts", "1 hour", "1 hour", {"a": ("sum", "x"), "b": ("sum", "x")})
