"""The chain over several landings against a rebuild from the same raw rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import bank
from ledgerstrata.catalog import FACTS, METRICS, SUMMARY, TABLES
from ledgerstrata.config import Settings
from ledgerstrata.schemas import FACT_COLUMNS, bronze_schema
from ledgerstrata.operators.quality import good_records
from ledgerstrata.plans.silver import flagged_snapshot
from ledgerstrata.sources.tables import compact, path_of, publish, read_table, refresh, reset, schema_of
from ledgerstrata.streaming import facts as streaming_facts
from ledgerstrata.streaming import feeds, native
from ledgerstrata.streaming import history as streaming_history
from ledgerstrata.streaming.facts import FactFeed, read_feed
from ledgerstrata.streaming.history import HistoryFeed
from ledgerstrata.streaming.run import current_owners, run_round

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture(scope="module")
def rounds(spark, tmp_path_factory):
    """Three rounds, with what the history held after each."""
    root = tmp_path_factory.mktemp("bank")
    settings = Settings(root=str(root / "lake"), as_of=AS_OF)
    incomes = []
    for deliver in (bank.land_first_day, bank.land_second_day, bank.land_late_day):
        deliver(root)
        run_round(spark, settings, str(root / "landing_data"))
        history = HistoryFeed(spark, settings, "customers").history()
        incomes.append(sorted(
            (r["customer_id"], str(r["prijem"]), str(r["__START_AT"].date()),
             r["__END_AT"] and str(r["__END_AT"].date())) for r in history.collect()))
    return settings, incomes, str(root / "landing_data")


def test_history_after_each_round(rounds):
    _, incomes, _ = rounds
    two = ("2", "90000.00", "2024-01-01", None)
    assert incomes[0] == [("1", "45000.00", "2024-01-01", None), two]
    assert incomes[1] == [("1", "45000.00", "2024-01-01", "2024-01-03"),
                          ("1", "46000.00", "2024-01-03", None), two]
    assert incomes[2] == [("1", "41000.00", "2024-01-02", "2024-01-03"),
                          ("1", "45000.00", "2024-01-01", "2024-01-02"),
                          ("1", "46000.00", "2024-01-03", None), two]


@pytest.mark.parametrize("entity", ["customers", "accounts", "cards", "employees"])
def test_increments_equal_rebuild(spark, rows_of, rounds, entity):
    settings, _, _ = rounds
    raw = read_table(spark, settings, f"{entity}_bronze")
    rebuilt = TABLES[f"dim_{entity}"].build({f"{entity}_bronze": raw}, settings)
    kept = HistoryFeed(spark, settings, entity).history().select(*rebuilt.columns)
    assert rows_of(kept) == rows_of(rebuilt)
    assert rebuilt.count() > 0


def test_facts_of_batches(spark, rounds):
    settings, _, _ = rounds
    facts = {r["transaction_id"]: r for r in read_feed(spark, settings, FACTS).collect()}
    assert set(facts) == {"T1", "T2", "T3", "T4", "F1", "F2"}
    # T3 waited for its card; T2 keeps the owner it had when it was taken in.
    assert facts["T3"]["account_id"] == "A1" and facts["T2"]["customer_id"] == "2"
    assert facts["T1"]["transaction_hour"] == 14 and facts["T1"]["city_name"] == "Praha"
    assert facts["F1"]["city_name"] == "Unknown" and facts["F1"]["card_id"] is None
    assert facts["T4"]["customer_income"] == 46000
    metrics = {r["transaction_id"]: r for r in read_feed(spark, settings, METRICS).collect()}
    assert metrics["F1"]["time_period"] == "Evening" and metrics["F2"]["day_type"] == "Weekend"
    summary = {r["customer_id"]: r for r in read_table(spark, settings, SUMMARY).collect()}
    assert summary["1"]["annual_income"] == 46000 and summary["2"]["customer_tier"] == "Premium"


def test_a_round_without_files_changes_nothing(spark, rows_of, rounds):
    settings, _, landing = rounds
    before = rows_of(read_feed(spark, settings, FACTS)), rows_of(HistoryFeed(spark, settings, "cards").history())
    run_round(spark, settings, landing)
    after = rows_of(read_feed(spark, settings, FACTS)), rows_of(HistoryFeed(spark, settings, "cards").history())
    assert before == after


def test_repeated_batch_replaces_its_rows(spark, rows_of, rounds):
    settings, _, _ = rounds
    feed = HistoryFeed(spark, settings, "customers")
    before = rows_of(feed.history())
    newest = feed._newest_published()
    again = feed._log(newest).where(f"batch = {newest}").drop("batch", "bucket")
    feed.take(spark.createDataFrame(again.collect(), again.schema), newest)
    assert rows_of(feed.history()) == before


def test_repeated_fact_batch_replaces_its_rows(spark, rows_of, rounds):
    """The second batch of payments holds T4; T3 waits since the first and is settled later."""
    settings, _, _ = rounds
    feed = FactFeed(spark, settings, "CARD", lambda: current_owners(spark, settings, "CARD"))
    before = rows_of(read_feed(spark, settings, FACTS))
    assert [r["card_transaction_id"] for r in feed.waiting(0).collect()] == ["T3"]
    assert feed.waiting(1).count() == 0
    feed.settle()
    payments = read_table(spark, settings, "card_transactions_silver")
    feed.take(payments.where("card_transaction_id = 'T4'"), 1)
    assert rows_of(read_feed(spark, settings, FACTS)) == before


def test_good_and_bad_are_clean(spark, rounds):
    settings, _, _ = rounds
    for entity in ("customers", "accounts", "cards", "employees"):
        clean, good, bad = (read_table(spark, settings, f"{entity}_clean_{part}").count()
                            for part in ("silver", "good_records", "bad_records"))
        assert clean == good + bad
    bad = read_table(spark, settings, "customers_clean_bad_records").collect()
    assert [r["customer_id"] for r in bad] == ["3"]


def test_quarantine_reads_one_partition(spark, rounds):
    settings, _, _ = rounds
    good = read_table(spark, settings, "accounts_clean_silver").where("NOT is_quarantined")
    assert "PartitionFilters: [isnotnull(is_quarantined" in good._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fold", [2, 16])
def test_batches_write_their_own_keys(spark, rows_of, tmp_path, monkeypatch, fold):
    """Five batches of few keys each, folded or not, equal a rebuild; late rows included."""
    monkeypatch.setattr(streaming_history, "FOLD", fold)
    settings = Settings(root=str(tmp_path / "lake"), as_of=AS_OF)
    feed = HistoryFeed(spark, settings, "accounts")
    days = [1, 2, 3, 2, 5]
    log = []
    for batch, n in enumerate(days):
        for key in ("A", "B", "C", "D")[batch % 3:batch % 3 + 2]:
            log.append({**bank.account(key, "1", stav=f"s{(batch + n) % 3}"), "snapshot_date": dt.date(2024, 1, n), "source_file": "f",
                        "ingestion_ts": dt.datetime(2024, 2, 1, batch)})
        schema = bronze_schema("accounts")
        raw = spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in log], schema)
        good = good_records(flagged_snapshot("accounts", raw, settings))
        feed.take(good.where(F.col("ingestion_ts") == dt.datetime(2024, 2, 1, batch)), batch)
    whole = TABLES["dim_accounts"].build({"accounts_bronze": raw}, settings)
    assert rows_of(feed.history().select(*whole.columns)) == rows_of(whole) and whole.count() > 6
    written = feed._versions().where("batch = 3 AND is_open").count()
    assert written == 2  # the keys of the batch, not all four
    if fold == 2:
        assert feed._versions().where("batch < 2 AND is_open").count() == 0
        with pytest.raises(ValueError):
            feed.expire(4)


def test_chain_publishes_its_tables(spark, rows_of, rounds):
    settings, _, _ = rounds
    assert rows_of(read_table(spark, settings, FACTS)) == rows_of(read_feed(spark, settings, FACTS))
    assert read_table(spark, settings, METRICS).count() == 6
    assert read_table(spark, settings, "dim_customers").count() == 4


def test_refresh_rebuilds_all_tables(spark, rows_of, rounds):
    """The batch rebuild gives facts the owners of today, and leaves streams alone."""
    settings, _, landing = rounds
    cleaned = rows_of(read_table(spark, settings, "card_transactions_silver"))
    refresh(spark, settings)
    assert rows_of(read_table(spark, settings, "card_transactions_silver")) == cleaned
    with pytest.raises(ValueError):
        refresh(spark, settings, ["card_transactions_silver"])
    run_round(spark, settings, landing)
    assert rows_of(read_table(spark, settings, "card_transactions_silver")) == cleaned
    facts = {r["transaction_id"]: r for r in read_table(spark, settings, FACTS).collect()}
    assert set(facts) == {"T1", "T2", "T3", "T4", "F1", "F2"}
    assert facts["T2"]["customer_id"] == "1"
    assert tuple(read_table(spark, settings, FACTS).select(*FACT_COLUMNS).columns) == FACT_COLUMNS
    geography = read_table(spark, settings, "dim_geography_hierarchy").collect()
    assert [r["geography_key"] for r in geography] == ["R1-C1-B1"]
    assert geography[0]["branch_street"] == "Václavské náměstí"
    pruned = read_table(spark, settings, METRICS).where("transaction_year = 2024 AND transaction_month = 1")
    assert "PartitionFilters: [isnotnull(transaction_year" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 4

    before = rows_of(read_table(spark, settings, FACTS))
    compact(spark, settings, FACTS, {"transaction_year": 2024, "transaction_month": 1})
    assert rows_of(read_table(spark, settings, FACTS)) == before
    with pytest.raises(ValueError):
        compact(spark, settings, FACTS, {"transaction_year": 2024})

    full = publish(spark, settings, FACTS)
    assert full == f"dev_gold.{FACTS}"
    assert spark.table(full).count() == 6
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {full}").collect()}
    assert "gold" in described["Table Properties"] and described["Comment"] == TABLES[FACTS].comment
    with pytest.raises(ValueError):
        reset(spark, settings, [FACTS])
    reset(spark, settings, [FACTS], confirmed=True)
    assert not spark.catalog.tableExists(full)


def test_rule_totals_outlive_many_batches(spark, tmp_path):
    """More micro-batches than a query remembers the progress of."""
    settings = Settings(root=str(tmp_path / "lake"), as_of=AS_OF)
    births = [(str(n), "1900-01-01" if n % 4 else "1980-01-01") for n in range(104)]
    given = spark.createDataFrame(births, "customer_id string, datum_narozeni string")
    rows = given.select(*((F.col(f.name) if f.name in given.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                          for f in bronze_schema("customers")))
    rows.repartition(104).write.parquet(path_of(settings, "customers_bronze"))
    feeds.count_rules(spark, settings, "customers", max_files=1).awaitTermination()
    totals = {r["rule"]: (r["passed_rows"], r["failed_rows"]) for r in feeds.rule_totals(spark, settings).collect()}
    assert totals["valid_customer_id"] == (104, 0) and totals["valid_datum_narozeni"] == (26, 78)


def test_reference_mode_chain(spark, tmp_path):
    """As written: no quarantine for unknown births, all hours are midnight."""
    settings = Settings(root=str(tmp_path / "lake"), as_of=AS_OF, mode="reference", env="")
    landing = bank.land_first_day(tmp_path)
    run_round(spark, settings, landing)
    assert read_table(spark, settings, "customers_clean_bad_records").count() == 0
    assert read_table(spark, settings, "customers_clean_good_records").count() == 2
    refresh(spark, settings)
    assert {r["time_period"] for r in read_table(spark, settings, METRICS).collect()} == {"Night"}
    assert "transaction_year" not in read_table(spark, settings, METRICS).columns
    assert "/silver/" in path_of(settings, "dim_cards")


def _paid(spark, settings):
    """Payments of 21 cards, each in four months, all owners but that of the last card, and places."""
    rows = spark.range(84).select(
        F.concat(F.lit("T"), "id").alias("card_transaction_id"), (F.col("id") % 21).cast("string").alias("card_id"), F.lit(7).alias("amount"),
        F.add_months(F.lit("2024-01-09").cast("date"), (F.col("id") % 4).cast("int")).alias("datum"))
    for name in ("card_transactions_silver", "financial_transactions_silver"):
        schema = schema_of(spark, settings, name)
        there = rows if name.startswith("card") else rows.limit(0)
        shown = [(F.col(f.name) if f.name in there.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        there.select(*shown).write.parquet(path_of(settings, name))
    owners = spark.createDataFrame([("A", "C", 40, "100")], "account_id string, customer_id string, client_age int, customer_income string")
    owners = owners.withColumn("customer_income", F.col("customer_income").cast("decimal(20,2)"))
    cards = spark.createDataFrame([(str(n), "A") for n in range(20)], "card_id string, account_id string").join(owners, "account_id")
    places = [spark.createDataFrame([], f"{key} string, nazev string") for key in ("city_id", "region_id")]
    return owners, cards, places


def test_fact_batch_is_dealt_to_periods_once(spark, tmp_path, monkeypatch):
    """Only waiting rows are dealt out by the writer: facts are on their way, and metrics lie as the facts."""
    settings = Settings(root=str(tmp_path / "lake"), as_of=dt.date(2024, 6, 30))
    _, cards, places = _paid(spark, settings)
    dealt = []
    monkeypatch.setattr(streaming_facts, "sized_for_writing", lambda df, by: dealt.append(list(by)) or df)
    feed = FactFeed(spark, settings, "CARD", lambda: (cards, *places))
    feed.run().awaitTermination()
    assert dealt == [["bucket"]]
    for table in (FACTS, METRICS):
        found = read_feed(spark, settings, table).groupBy("transaction_year", "transaction_month").count().collect()
        assert {(r[0], r[1], r[2]) for r in found} == {(2024, m, 20) for m in (1, 2, 3, 4)}
    late = cards.unionByName(cards.limit(1).withColumn("card_id", F.lit("20")))
    feed = FactFeed(spark, settings, "CARD", lambda: (late, *places))
    for _ in range(2):
        feed.settle()
        assert read_feed(spark, settings, FACTS).count() == 84 and read_feed(spark, settings, METRICS).count() == 84


def test_native_facts_are_dealt_to_periods(spark, tmp_path, monkeypatch):
    """However many tasks join, few write into one period."""
    settings = Settings(root=str(tmp_path / "lake"), as_of=dt.date(2024, 6, 30))
    owners, cards, places = _paid(spark, settings)
    written, append = [], native.append
    monkeypatch.setattr(native, "append", lambda df, *to: written.append(df) or append(df, *to))
    native.stream_facts(spark, settings, owners, cards, *places).awaitTermination()
    assert "RebalancePartitions [transaction_year" in written[0]._jdf.queryExecution().analyzed().toString()
    files = list((tmp_path / "lake").rglob(f"{FACTS}/transaction_year=*/transaction_month=*/*.parquet"))
    assert len(files) == 4
    assert read_table(spark, settings, FACTS).count() == 80
