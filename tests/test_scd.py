import datetime as dt
import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tidemark.operators import scd
from tidemark.session import run_dir
from tidemark.sources import sinks
from tidemark.sources.versions import VersionStore

V = scd.Versions("k", ["a", "b"], "ts", ["seq"])
DDL = "k string, a string, b string, ts timestamp_ntz, seq long"
BASE = dt.datetime(2024, 1, 1)


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def at(n):
    return BASE + dt.timedelta(hours=n)


def brute(data):
    out = []
    for key in {r[0] for r in data}:
        runs = []
        for r in sorted((r for r in data if r[0] == key), key=lambda r: (r[3], r[4])):
            if not runs or runs[-1][1:3] != r[1:3]:
                runs.append(r)
        for i, r in enumerate(runs):
            end = runs[i + 1][3] if i + 1 < len(runs) else None
            out.append((*r, r[3], end, end is None))
    return out


COLS = ["k", "a", "b", "ts", "seq", "dt_inicio", "dt_fim", "is_current"]


def same(got, want):
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(got, *COLS) == sorted(want, key=key)


def skewed(n=600, seed=1):
    """A third of the rows under one key, null states, equal times."""
    rng = random.Random(seed)
    return [
        (
            "hot" if rng.random() < 0.35 else f"k{rng.randrange(30)}",
            rng.choice(["x", "y", None]), rng.choice(["p", None]), at(rng.randrange(200)), i,
        )
        for i in range(n)
    ]


def test_history_against_brute_force(spark):
    data = skewed()
    same(scd.scd2_history(frame(spark, data), V), brute(data))


@pytest.mark.parametrize("limit", [1, 20, 100])
def test_hot_keys_are_sliced_with_the_same_result(spark, limit):
    data = skewed(seed=limit)
    df = frame(spark, data).repartition(4)
    assert "hot" in scd.hot_keys(df, "k", limit)
    same(scd.scd2_history(df, V, hot_rows=limit), brute(data))


def test_hot_key_with_a_single_time(spark):
    data = [("hot", "x" if i % 3 else "y", None, at(0), i) for i in range(300)]
    same(scd.scd2_history(frame(spark, data), V, hot_rows=50), brute(data))


def test_null_keys_are_one_key(spark):
    data = [(None, "x", None, at(0), 0), (None, "y", None, at(1), 1)] + skewed(100)
    df = frame(spark, data)
    for limit in (10, 10_000):
        assert scd.scd2_history(df, V, hot_rows=limit).filter("k is null").count() == 2


def cases(spark):
    old = [
        ("same", "x", "p", at(0), 0), ("changed", "x", "p", at(0), 1), ("tovalue", None, "p", at(0), 2),
        ("tonull", "x", "p", at(0), 3), ("twice", "x", "p", at(0), 4), ("late", "x", "p", at(50), 5),
        ("untouched", "x", "p", at(0), 6), ("closed2", "x", "p", at(0), 7), ("closed2", "y", "p", at(1), 8),
        ("closed2", "x", "p", at(2), 9),
    ]
    new = [
        ("same", "x", "p", at(10), 20), ("changed", "y", "p", at(10), 21), ("tovalue", "x", "p", at(10), 22),
        ("tonull", None, "p", at(10), 23), ("twice", "y", "p", at(10), 24), ("twice", "z", "p", at(11), 25),
        ("late", "y", "p", at(10), 26), ("closed2", "x", "p", at(10), 27), ("new", "x", "p", at(10), 28),
    ]
    return old, new


def test_incremental_step(spark):
    old, new = cases(spark)
    history = scd.scd2_history(frame(spark, old), V)
    step = scd.scd2_apply(scd.current(history, V), frame(spark, new), V)
    assert rows(step.late, "k") == [("late",)]
    on_time = [r for r in old + new if r[4] != 26]
    whole = brute(on_time)
    same(step.current, [r for r in whole if r[-1]])
    kept = history.filter(~F.col("is_current"))
    same(kept.select(*COLS).unionByName(step.closed.select(*COLS)), [r for r in whole if not r[-1]])
    assert step.current.groupBy("k").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("limit", [30, 10_000])
def test_any_cut_gives_the_full_history(spark, limit):
    data = skewed(300, seed=7)
    store = VersionStore(spark, run_dir(spark, "cuts"), V)
    times = [0, 60, 61, 150, 200]
    for i, (low, high) in enumerate(zip(times, times[1:])):
        part = [r for r in data if at(low) <= r[3] < at(high)]
        if part:
            store.apply(frame(spark, part), at(high), hot_rows=limit)
        if i == 1:
            store.fold()
    same(store.history(), brute(data))
    same(store.current(), [r for r in brute(data) if r[-1]])
    assert store.state().mark == at(200) and store.late() is None


def test_uncommitted_batches_are_invisible_and_replaced(spark):
    data = skewed(200, seed=3)
    first = [r for r in data if r[3] < at(100)]
    second = [r for r in data if r[3] >= at(100)]
    store = VersionStore(spark, run_dir(spark, "replay"), V)
    store.apply(frame(spark, first))
    # A run that died before its commit left parts of batch 1 behind.
    junk = store.history().limit(5)
    sinks.append_batch(junk, store._folder("versions", 0), 1)
    assert store.history().count() == len(brute(first))
    store.apply(frame(spark, second))
    same(store.history(), brute(data))


def test_late_rows_go_aside(spark):
    store = VersionStore(spark, run_dir(spark, "late"), V)
    store.apply(frame(spark, [("k", "x", "p", at(10), 0)]))
    store.apply(frame(spark, [("k", "y", "p", at(5), 1), ("k", "z", "p", at(20), 2)]))
    assert rows(store.late(), "k", "a") == [("k", "y")]
    assert rows(store.history(), "a", "is_current") == [("x", False), ("z", True)]


def test_as_of(spark):
    data = [("k", "x", None, at(0), 0), ("k", "y", None, at(5), 1)]
    history = scd.scd2_history(frame(spark, data), V)
    for hour, state in ((-1, []), (0, ["x"]), (4, ["x"]), (5, ["y"]), (99, ["y"])):
        assert [r.a for r in scd.as_of(history, V, at(hour)).collect()] == state


def test_history_shuffles_once(spark):
    df = frame(spark, skewed(50))
    assert plan_of(scd.scd2_history(df, V, hot={})).count("Exchange hashpartitioning") == 1


def test_summary_and_first_load(spark):
    loaded = scd.scd2_init(frame(spark, [("k", "x", "p", at(0), 0)]), V)
    assert rows(loaded, *COLS) == [("k", "x", "p", at(0), 0, at(0), None, True)]
    assert rows(scd.scd2_summary(loaded, V, "a")) == [("x", True, 1)]
