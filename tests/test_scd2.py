"""Type 2 history against a row-by-row Python model, whole and in slices."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerstrata.operators.asof import asof_join
from ledgerstrata.operators.scd2 import current, history_of, scd2, valid_at

SCHEMA = "k string, seq date, tracked string, other int, seen int, tie int"
DAY0 = dt.date(2024, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def model(log):
    """Versions by walking each key's rows in order."""
    versions = []
    for key in {r[0] for r in log}:
        rows = {}
        for r in sorted((r for r in log if r[0] == key), key=lambda r: (r[1], r[5])):
            rows[r[1]] = r
        runs = []
        for _, seq, tracked, other, seen, _ in rows.values():
            if runs and runs[-1]["state"] == (tracked, other):
                runs[-1].update(seq=seq, seen=seen)
            else:
                runs.append({"state": (tracked, other), "start": seq, "seq": seq, "seen": seen})
        for run, following in zip(runs, [*runs[1:], None]):
            versions.append((key, run["seq"], *run["state"], run["seen"], run["start"],
                             following["start"] if following else None))
    return sorted(versions, key=repr)


def history(spark, log, **options):
    df = spark.createDataFrame(log, SCHEMA)
    return scd2(df, ["k"], "seq", untracked=["seen"], tie_break=["tie"], **options)


def random_log(seed, keys, days, choices):
    rng = random.Random(seed)
    log = []
    for key in keys:
        for n in rng.sample(range(days), rng.randint(1, days)):
            for tie in range(rng.choice((1, 1, 1, 3))):
                log.append((key, day(n), rng.choice(choices), rng.choice((1, 1, 1, None)),
                            rng.randint(0, 9), tie))
    rng.shuffle(log)
    return log


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [None, 2_000_000, 12, 3])
def test_random_logs_match_model(spark, rows_of, seed, hot_rows):
    log = random_log(seed, ["a", "b", "c", None, "d"], 40, ["x", "y", None])
    assert rows_of(history(spark, log, hot_rows=hot_rows)) == model(log)


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_long_unchanged_run_across_slices(spark, rows_of, hot_rows):
    log = [("a", day(n), "x" if n != 70 else "y", 1, n, 0) for n in range(100)]
    got = rows_of(history(spark, log, hot_rows=hot_rows))
    assert got == model(log)
    assert len(got) == 3


@pytest.mark.parametrize("kind", ["string", "timestamp", "decimal(12,0)", "bigint"])
def test_sequences_of_any_type(spark, rows_of, kind):
    made = {"string": "date_format(seq, 'yyyy.MM.dd')", "timestamp": "cast(seq as timestamp)"}
    log = spark.createDataFrame(random_log(4, list("abc"), 40, ["x", "y", None]), SCHEMA)
    log = log.withColumn("seq", F.expr(made.get(kind, f"cast(datediff(seq, DATE'2020-01-01') as {kind})")))
    whole, cut = (rows_of(scd2(log, ["k"], "seq", untracked=["seen"], tie_break=["tie"], hot_rows=n)) for n in (None, 3))
    assert whole == cut and len(whole) > 20


def test_one_hot_group_of_copies(spark, rows_of):
    """A third of all rows share one key and one moment."""
    log = [("hot", day(5), "x", 1, 1, n) for n in range(300)] + random_log(9, list("abcdef"), 60, ["x", "y"])
    assert rows_of(history(spark, log, hot_rows=50)) == model(log)


def test_fixture_cases(spark, rows_of):
    a, b = "A", "B"
    log = [
        ("same", day(1), a, 1, 1, 0), ("same", day(2), a, 1, 2, 0), ("same", day(3), a, 1, 3, 0),
        ("aba", day(1), a, 1, 0, 0), ("aba", day(2), b, 1, 0, 0), ("aba", day(3), a, 1, 0, 0),
        ("null", day(1), None, 1, 0, 0), ("null", day(2), a, 1, 0, 0), ("null", day(3), None, 1, 0, 0),
        ("late", day(3), a, 1, 0, 0), ("late", day(1), a, 1, 0, 0), ("late", day(2), b, 1, 0, 0),
        ("twice", day(1), a, 1, 0, 0), ("twice", day(1), b, 1, 0, 1),
    ]
    versions = rows_of(history(spark, log), "k", "tracked", "__START_AT", "__END_AT")
    assert versions == sorted([
        ("same", a, day(1), None),
        ("aba", a, day(1), day(2)), ("aba", b, day(2), day(3)), ("aba", a, day(3), None),
        ("null", None, day(1), day(2)), ("null", a, day(2), day(3)), ("null", None, day(3), None),
        ("late", a, day(1), day(2)), ("late", b, day(2), day(3)), ("late", a, day(3), None),
        ("twice", b, day(1), None),
    ], key=repr)
    # The untracked column follows the last row of the open version.
    assert rows_of(history(spark, log).where("k = 'same'"), "seq", "seen") == [(day(3), 3)]


def test_rows_without_sequence_are_left_out(spark):
    assert history(spark, [("a", None, "x", 1, 1, 0)]).count() == 0


def test_arrival_order_does_not_matter(spark, rows_of):
    log = random_log(4, list("abc"), 30, ["x", "y"])
    assert rows_of(history(spark, log)) == rows_of(history(spark, sorted(log, key=repr)))


def test_invariants(spark):
    log = random_log(7, list("abcdefgh"), 50, ["x", "y", "z"])
    versions = history(spark, log)
    assert current(versions).groupBy("k").count().where("count <> 1").count() == 0
    assert versions.where("__END_AT <= __START_AT").count() == 0
    # Replaying any day returns that day's snapshot of the keys delivered then.
    last = {}
    for r in sorted(log, key=lambda r: r[5]):
        last[(r[0], r[1])] = r[2:4]
    for n in (3, 17, 44):
        seen = {r["k"]: (r["tracked"], r["other"]) for r in valid_at(versions, F.lit(day(n))).collect()}
        for (key, at), state in last.items():
            if at == day(n):
                assert seen[key] == state


def test_history_of_one_key_is_ordered(spark):
    log = random_log(2, list("ab"), 40, ["x", "y"])
    starts = [r["__START_AT"] for r in history_of(history(spark, log), "k", "a").collect()]
    assert starts == sorted(starts) and len(starts) > 1


def test_plan_has_one_shuffle_and_one_sort(spark):
    df = spark.createDataFrame(random_log(1, list("ab"), 9, ["x"]), SCHEMA)
    plan = scd2(df, ["k"], "seq", hot_rows=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Window [") == 3


def test_key_filter_is_pushed_below_the_history(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame(random_log(1, list("ab"), 9, ["x"]), SCHEMA).write.parquet(path)
    versions = scd2(spark.read.parquet(path), ["k"], "seq", hot_rows=None)
    plan = history_of(versions, "k", "a")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,a)" in plan


@pytest.mark.parametrize("hot_rows", [None, 7])
def test_asof_join_matches_nested_loops(spark, rows_of, hot_rows):
    log = random_log(11, ["a", "b", None], 60, ["x", "y"])
    versions = history(spark, log)
    rng = random.Random(5)
    facts = [(i, rng.choice(["a", "b", "nobody", None]), day(rng.randint(-5, 70))) for i in range(200)]
    df = spark.createDataFrame(facts, "id int, k string, happened date")
    got = rows_of(asof_join(df, versions, ["k"], "happened", ["tracked", "__START_AT"], hot_rows=hot_rows),
                  "id", "k", "happened", "tracked", "__START_AT")
    wanted = [
        (i, k, at, v[2], v[5]) for i, k, at in facts for v in model(log)
        if v[0] == k and v[5] <= at and (v[6] is None or at < v[6])]
    assert got == sorted(wanted, key=repr) and len(got) > 100


def test_asof_join_emits_no_pairs(spark):
    log = random_log(3, list("ab"), 9, ["x"])
    df = spark.createDataFrame([(1, "a", day(3))], "id int, k string, happened date")
    plan = asof_join(df, history(spark, log), ["k"], "happened", ["tracked"], hot_rows=None)
    assert "Join" not in plan._jdf.queryExecution().executedPlan().toString()
