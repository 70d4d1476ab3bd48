"""Content differences of snapshots, header-bound ingest, observed rules, bounded stream matching."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import bank
from ledgerstrata.config import Settings
from ledgerstrata.operators.hotkeys import SLICE, in_slices
from ledgerstrata.plans.silver import history_dimension
from ledgerstrata.schemas import INGESTED, LANDING, RESCUED, SNAPSHOT
from ledgerstrata.sources import headers
from ledgerstrata.sources.landing import read_landing
from ledgerstrata.sources.tables import is_streamed, path_of, read_table, refresh
from ledgerstrata.streaming import feeds, matching
from ledgerstrata.streaming.history import FOLD, HistoryFeed

AS_OF = dt.date(2024, 6, 30)


def good_accounts(spark, feed, rows):
    """Rows (key, owner, state, day, load) as good records of accounts."""
    values = [(a, c, "běžný", s, "CZK", None, None, load and dt.datetime(2024, 2, 1) + dt.timedelta(minutes=load), dt.date(2024, 1, 1) + dt.timedelta(days=day))
              for a, c, s, day, load in rows]
    names = [*LANDING["accounts"], INGESTED, SNAPSHOT]
    schema = T.StructType([T.StructField(n, feed.row_schema[n].dataType) for n in names])
    return spark.createDataFrame(values, schema).select(*feed.row_schema.names)


def test_unchanged_rows_are_lines_only(spark, tmp_path):
    settings = Settings(root=str(tmp_path), as_of=AS_OF)
    feed = HistoryFeed(spark, settings, "accounts")
    for batch in range(4):
        rows = [(f"A{i}", "1", "new" if i == 3 and batch == 2 else "old", batch, batch + 1) for i in range(50)]
        feed.take(good_accounts(spark, feed, rows), batch)
    log = feed._lines(3)
    stored = {r["batch"]: (r["full"], r["lines"]) for r in log.groupBy("batch").agg(
        F.count_if(~F.col("same")).alias("full"), F.count_if("same").alias("lines")).collect()}
    assert stored == {0: (50, 0), 1: (0, 50), 2: (1, 49), 3: (1, 49)}
    assert log.where("same").where(" OR ".join(f"{c} IS NOT NULL" for c in feed.tracked)).isEmpty()
    versions = {r["batch"]: r["n"] for r in feed._versions().groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert versions == {0: 50, 2: 2, 3: 2}
    assert {r[SNAPSHOT] for r in feed.current().collect()} == {dt.date(2024, 1, 4)}
    assert feed._log(3).count() == 200


@pytest.mark.parametrize("seed", range(3))
def test_differences_give_the_same_history(spark, rows_of, tmp_path, seed):
    """Copies, changes, late rows, repeated moments and null keys, over a fold, against one rebuild."""
    rng = random.Random(seed)
    settings = Settings(root=str(tmp_path), as_of=AS_OF)
    feed = HistoryFeed(spark, settings, "accounts")
    everything, load, first = [], 0, FOLD - 2
    for batch in range(first, first + 5):
        rows = []
        for key in ("A", "B", "C", None):
            for _ in range(rng.choice([0, 1, 1, 2])):
                load += 1
                day = max(0, 2 * (batch - first) + rng.choice([0, 0, 1, -3]))
                rows.append((key, rng.choice(["1", "1", None]), rng.choice(["x", "x", "x", "y", None]), day, load))
        everything += rows
        feed.take(good_accounts(spark, feed, rows), batch)
    want = history_dimension("accounts", good_accounts(spark, feed, everything), settings)
    assert rows_of(feed.history().select(*want.columns)) == rows_of(want)


def test_slices_do_not_make_tasks(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    cut = in_slices(rows, ["k"], ["t"], 7)
    sizes = cut.groupBy(SLICE).agg(F.count("*").alias("n"), F.min(F.struct("k", "t")).alias("a"), F.max(F.struct("k", "t")).alias("b")).orderBy(SLICE).collect()
    assert max(r["n"] for r in sizes) == 7 and len(sizes) >= 3000 / 7
    assert all(tuple(x["b"]) < tuple(y["a"]) for x, y in zip(sizes, sizes[1:]))
    assert cut.select(F.col("_metadata.file_path")).distinct().count() <= 16


def test_header_names():
    assert headers.header_names('﻿City_ID, "nazev" ,x,x,,x\r') == ["city_id", "nazev", "x", "x__2", "_unnamed", "x__3"]


def test_files_are_bound_by_header(spark, tmp_path):
    landing = tmp_path / "landing_data"
    folder = landing / "cities" / "2024 01%02"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text('city_id,nazev,region_id\nC1,"Pra\nha",R1\n', "utf-8")
    (folder / "b.csv").write_text('﻿REGION_ID,extra,city_id\nR2,"say ""x""",C2\nR3,,C3\n', "utf-8")
    (folder / "c.csv").write_text("city_id,nazev,region_id\nC4,Brno\nC5,Brno,R5,more\n", "utf-8")
    (folder / "empty.csv").write_text("", "utf-8")
    settings = Settings(root=str(tmp_path / "lake"), as_of=AS_OF)
    feeds.ingest(spark, settings, str(landing), "cities", by_header=True, types={"region_id": "string"}).awaitTermination()
    rows = {r["city_id"]: r for r in read_table(spark, settings, "cities_bronze").collect()}
    assert set(rows) == {"C1", "C2", "C3", "C4", "C5"}
    assert rows["C1"]["nazev"] == "Pra\nha" and rows["C1"][RESCUED] is None
    assert (rows["C2"]["region_id"], rows["C2"]["nazev"]) == ("R2", None)
    rescued = json.loads(rows["C2"][RESCUED])
    assert rescued.pop("_file_path").endswith("b.csv") and rescued == {"extra": 'say "x"'}
    assert rows["C3"][RESCUED] is None
    assert json.loads(rows["C4"][RESCUED])["_line"] == "C4,Brno" and rows["C4"]["nazev"] == "Brno"
    assert json.loads(rows["C5"][RESCUED])["_line"] == "C5,Brno,R5,more" and rows["C5"]["region_id"] == "R5"
    # Later files only, and their headers noted.
    (folder / "d.csv").write_text("nazev,city_id\nOstrava,C6\n", "utf-8")
    feeds.ingest(spark, settings, str(landing), "cities", by_header=True).awaitTermination()
    assert read_table(spark, settings, "cities_bronze").count() == 6
    noted = spark.read.option("recursiveFileLookup", True).parquet(f"{path_of(settings, 'cities_bronze')}_headers")
    assert noted.count() == 4


def test_unreadable_values_are_rescued(spark, tmp_path):
    bank.land(tmp_path, "account_balances", [{"account_id": "A", "balance": "1.5", "datum": "2024-01-01"}, {"account_id": "B", "balance": "x", "datum": "never"}])
    path = str(tmp_path / "landing_data" / "account_balances")
    rows = {r["account_id"]: r for r in headers.read_by_header(spark, [path], "account_balances", types={"balance": "double", "datum": "date"}).collect()}
    assert rows["A"]["balance"] == "1.5" and rows["A"][RESCUED] is None
    assert rows["B"]["balance"] is None and {k: v for k, v in json.loads(rows["B"][RESCUED]).items() if k[0] != "_"} == {"balance": "x", "datum": "never"}
    with pytest.raises(ValueError):
        headers.read_by_header(spark, [path], "account_balances", types={"saldo": "double"})


def test_rules_are_counted_in_the_write(spark, tmp_path):
    settings = Settings(root=str(tmp_path / "lake"), as_of=AS_OF)
    bank.land(tmp_path, "customers", [bank.customer("1"), bank.customer("2", datum_narozeni="")], "2024.01.01")
    bank.land(tmp_path, "customers", [bank.customer("3")], "2024.01.02")
    landing = str(tmp_path / "landing_data")
    feeds.ingest(spark, settings, landing, "customers").awaitTermination()
    query = feeds.clean_and_count(spark, settings, "customers", max_files=1)
    query.awaitTermination()
    # One scan of the raw rows: what the micro-batches read is what there is.
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3
    totals = {r["rule"]: (r["passed_rows"], r["failed_rows"]) for r in feeds.rule_totals(spark, settings).collect()}
    assert totals == {"valid_customer_id": (3, 0), "valid_datum_narozeni": (2, 1)}
    assert read_table(spark, settings, "customers_clean_silver").count() == 3
    assert is_streamed(spark, settings, "customers_clean_silver")
    with pytest.raises(ValueError):
        refresh(spark, settings, ["customers_clean_silver"])
    # Without its last commit the stream repeats that batch.
    commits = sorted((p for p in (tmp_path / "lake" / "_checkpoints").rglob("customers_clean_silver/commits/*") if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink(missing_ok=True)
    feeds.clean_and_count(spark, settings, "customers", max_files=1).awaitTermination()
    assert {r["rule"]: (r["passed_rows"], r["failed_rows"]) for r in feeds.rule_totals(spark, settings).collect()} == totals
    assert read_table(spark, settings, "customers_clean_silver").count() == 3


def test_rules_observed_of_an_empty_file(spark, tmp_path):
    settings = Settings(root=str(tmp_path / "lake"), as_of=AS_OF)
    bank.land(tmp_path, "accounts", [bank.account("A", "1")], "2024.01.01")
    raw = read_landing(spark, str(tmp_path / "landing_data"), "accounts")
    for rows in (raw.limit(0), raw, raw.limit(0)):
        rows.coalesce(1).write.mode("append").parquet(path_of(settings, "accounts_bronze"))
        feeds.clean_and_count(spark, settings, "accounts", max_files=1).awaitTermination()
    totals = {r["rule"]: (r["passed_rows"], r["failed_rows"]) for r in feeds.rule_totals(spark, settings).collect()}
    assert totals == {"valid_account": (1, 0), "valid_mena": (1, 0)}
    assert read_table(spark, settings, "accounts_clean_silver").count() == 1


def test_one_owner_of_a_cleaned_table(spark, tmp_path):
    settings = Settings(root=str(tmp_path / "lake"), as_of=AS_OF)
    bank.land(tmp_path, "accounts", [bank.account("A", "1")], "2024.01.01")
    read_landing(spark, str(tmp_path / "landing_data"), "accounts").write.parquet(path_of(settings, "accounts_bronze"))
    feeds.clean(spark, settings, "accounts").awaitTermination()
    with pytest.raises(ValueError):
        feeds.clean_and_count(spark, settings, "accounts")


def test_bounded_matching_keeps_bounded_state(spark, tmp_path):
    """A hundred days of both streams, of which the state holds the last few."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    left_schema, right_schema = "k int, at timestamp", "k int, at timestamp, v int"

    def deliver(nr, left, right):
        spark.createDataFrame(left, left_schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/left")
        spark.createDataFrame(right, right_schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/right")
        sides = spark.readStream.schema(left_schema).parquet(f"{tmp_path}/left"), spark.readStream.schema(right_schema).parquet(f"{tmp_path}/right")
        rows = matching.matched_in_time(*sides, ["k"], "at", "at", within="2 days", delay="1 day")
        query = matching.store_matches(rows, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        query.awaitTermination()
        return rows, matching.state_rows(query)

    sizes = []
    for nr in range(4):
        days = range(25 * nr, 25 * nr + 25)
        rows, held = deliver(nr, [(n % 5, day(n)) for n in days], [(n % 5, day(n - 1 - n % 3), n) for n in days])
        sizes.append(held)
    assert max(sizes[1:]) <= 12
    # One row behind the watermark on each side, and the end.
    deliver(4, [(0, day(3)), (9, day(999))], [(0, day(3), -1), (8, day(999), 0)])
    pairs = {(r["k"], r["at"], r["v"]) for r in matching.read_matches(spark, f"{tmp_path}/out", rows).collect()}
    alone = {(r["k"], r["at"]) for r in matching.read_matches(spark, f"{tmp_path}/out", rows, matched=False).collect()}
    left = [(n % 5, day(n)) for n in range(100)]
    right = [(n % 5, day(n - 1 - n % 3), n) for n in range(100)]
    want = {(k, at, v) for k, at in left for j, met, v in right if j == k and met <= at <= met + dt.timedelta(days=2)}
    assert pairs == want and alone == {(k, at) for k, at in left} - {(k, at) for k, at, _ in want}
