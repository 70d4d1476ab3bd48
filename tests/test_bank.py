"""Quality rules, cleaning, dimensions, facts, marts and monitors in both modes."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import bank
from ledgerstrata.catalog import FACTS, METRICS, SUMMARY, TABLES
from ledgerstrata.config import REFERENCE, Settings, scratch_root
from ledgerstrata.operators import quality
from ledgerstrata.operators.latest import latest_per_key, surplus_owners
from ledgerstrata.operators.scd2 import current
from ledgerstrata.plans import gold, monitors, reports, silver
from ledgerstrata.schemas import HISTORY_KEYS, LANDING, bronze_schema
from ledgerstrata.sources.tables import declare, publish, read_table, schema_of, write_table

AS_OF = dt.date(2024, 6, 30)
NOW = Settings(as_of=AS_OF)
AS_WRITTEN = Settings(as_of=AS_OF, mode=REFERENCE)


def day(n):
    return dt.date(2024, 1, n)


def raw(spark, entity, *rows):
    """Raw rows from (row, snapshot day or None[, load order])."""
    schema = bronze_schema(entity)
    data = []
    for row, at, *order in rows:
        full = {**row, "source_file": "f", "ingestion_ts": dt.datetime(2024, 1, 1) + dt.timedelta(
            minutes=order[0] if order else 0), "snapshot_date": at and day(at)}
        data.append(tuple(full.get(f.name) for f in schema))
    return spark.createDataFrame(data, schema)


def people(spark, *changes):
    return raw(spark, "customers", *((bank.customer(**{"key": k, **c}), at) for k, at, c in changes))


@pytest.fixture(scope="module")
def mixed_births(spark):
    """All pass; born 100 and 99 years back; unknown birth; no key; no date."""
    return people(
        spark, ("ok", 1, {}), ("100", 1, {"datum_narozeni": "1924-06-01"}),
        ("99", 1, {"datum_narozeni": "1925-06-01"}), ("unknown", 1, {"datum_narozeni": "?"}),
        (None, 1, {}), ("undated", None, {}))


def test_documented_quarantine_is_complete(spark, mixed_births):
    clean = silver.clean_snapshot("customers", mixed_births, NOW)
    good = {r[0] for r in quality.good_records(clean).select("customer_id").collect()}
    bad = {r[0] for r in quality.bad_records(clean).select("customer_id").collect()}
    assert good == {"ok", "99"} and bad == {"100", "unknown", None, "undated"}


def test_quarantine_as_written_loses_unknown_births(spark, mixed_births):
    clean = silver.clean_snapshot("customers", mixed_births, AS_WRITTEN)
    flags = {r["customer_id"]: r["is_quarantined"] for r in clean.collect()}
    assert flags == {"ok": False, "99": False, "undated": False, "100": True, None: True, "unknown": None}


@pytest.mark.parametrize(("entity", "row", "missing"), [
    ("accounts", bank.account("A", "1"), ["typ_uctu", "stav", "mena"]),
    ("cards", bank.card("K", "A"), ["card_id", "account_id", "typ_karty"]),
    ("employees", {"employee_id": "E", "jmeno": "A", "prijmeni": "B", "role": "C", "branch_id": "D"},
     ["employee_id", "prijmeni", "role"]),
])
def test_each_rule_alone(spark, entity, row, missing):
    rows = [(row, 1), *(({**row, column: None}, 1) for column in missing)]
    clean = silver.clean_snapshot(entity, raw(spark, entity, *rows), NOW)
    assert quality.good_records(clean).count() == 1
    assert quality.bad_records(clean).count() == len(missing)


def test_rule_counts_and_observation(spark, mixed_births):
    rules = quality.rules_for("customers", NOW)
    typed = silver.typed_customers(mixed_births, NOW)
    counts = {r["rule"]: (r["passed_rows"], r["failed_rows"]) for r in quality.rule_counts(typed, rules).collect()}
    assert counts == {"valid_customer_id": (5, 1), "valid_datum_narozeni": (4, 2)}
    watched, seen = quality.observed(typed, rules, "customers")
    assert watched.count() == 6
    assert seen.get["valid_datum_narozeni__failed"] == 2


def test_customer_cleaning_in_both_modes(spark):
    rows = people(spark, ("1", 1, {}))
    new = silver.clean_snapshot("customers", rows, NOW).first()
    assert (new["ulice"], new["cislo_popisne"], new["mesto"], new["zip_code"]) == ("Hlavní", "123", "Praha", "11000")
    assert (new["predcisli"], new["tel_cislo"]) == ("+420", "123456789")
    assert (new["client_age"], new["prijem"], new["pocet_clenu_domacnost"]) == (44, Decimal("45000.00"), 4)
    old = silver.clean_snapshot("customers", rows, AS_WRITTEN).first()
    assert (old["ulice"], old["cislo_popisne"], old["mesto"], old["zip_code"]) == ("Hlavní", None, " Praha", " 11000")


def test_clock_columns_open_no_version(spark):
    """A snapshot read a year later differs in age only."""
    rows = people(spark, ("1", 1, {}), ("1", 2, {}))
    later = Settings(as_of=dt.date(2025, 6, 30))
    for mode, versions in (("documented", 1), ("reference", 2)):
        log = None
        for settings, at in ((NOW, 1), (later, 2)):
            chosen = Settings(as_of=settings.as_of, mode=mode)
            part = silver.flagged_snapshot("customers", rows.where(F.dayofmonth("snapshot_date") == at), chosen)
            log = part if log is None else log.unionByName(part)
        good = quality.good_records(log)
        history = silver.history_dimension("customers", good, Settings(mode=mode))
        assert history.count() == versions
        if versions == 1:
            assert history.first()["client_age"] == 45


def moved_accounts(spark):
    """A1 moves from owner 1 to 2; A2 stays; A3 goes to 2 and comes back."""
    return raw(spark, "accounts", *(
        (bank.account(a, o), at) for a, o, at in (
            ("A1", "1", 1), ("A1", "2", 2), ("A2", "1", 1), ("A2", "1", 2),
            ("A3", "1", 1), ("A3", "2", 2), ("A3", "1", 3))))


def test_current_owner_is_the_one_seen_last(spark, rows_of):
    history = silver.dimension_from_bronze("accounts", moved_accounts(spark), NOW)
    owners = rows_of(silver.current_dimension("accounts", history, NOW), "account_id", "customer_id")
    assert owners == [("A1", "2"), ("A2", "1"), ("A3", "1")]
    assert silver.current_dimension("accounts", history, AS_WRITTEN).count() == 5
    surplus = surplus_owners(current(history), ["account_id"]).first()
    assert (surplus["set_aside"], surplus["keys_affected"]) == (2, 2)


@pytest.mark.parametrize("settings", [NOW, AS_WRITTEN])
def test_current_from_log_equals_current_of_history(spark, rows_of, settings):
    logs = {
        "accounts": moved_accounts(spark),
        "customers": people(spark, ("1", 1, {}), ("1", 3, {"prijem": "1.00"}), ("1", 2, {}), ("2", 1, {}),
                            ("2", 1, {"jmeno": "Karel"})),
        "cards": raw(spark, "cards", *((bank.card("K", "A", stav=s), at) for s, at in (("x", 1), ("y", 2), ("x", 3)))),
    }
    for entity, log in logs.items():
        good = quality.good_records(silver.flagged_snapshot(entity, log, settings))
        direct = silver.current_from_log(entity, good, settings)
        through = silver.current_dimension(entity, silver.history_dimension(entity, good, settings), settings)
        assert rows_of(direct) == rows_of(through.select(*direct.columns))


def test_redelivered_snapshot_counts_once(spark):
    rows = raw(spark, "cards", (bank.card("K", "A", stav="first"), 1, 5), (bank.card("K", "A", stav="second"), 1, 9))
    history = silver.dimension_from_bronze("cards", rows, NOW).collect()
    assert [r["stav"] for r in history] == ["second"]


def references(spark, settings):
    cities = raw(spark, "cities", ({"city_id": "C1", "nazev": "Old", "region_id": "R1"}, None, 1),
                 ({"city_id": "C1", "nazev": "Praha", "region_id": "R1"}, None, 2))
    regions = raw(spark, "regions", ({"region_id": "R1", "nazev": "Region"}, None))
    return silver.clean_reference("cities", cities, settings), silver.clean_reference("regions", regions, settings)


def facts(spark, settings):
    accounts = silver.dimension_from_bronze("accounts", moved_accounts(spark), settings)
    customers = silver.dimension_from_bronze(
        "customers", people(spark, ("1", 1, {}), ("2", 1, {"prijem": "90000"}), ("2", 2, {"prijem": "20000"})), settings)
    cards = silver.dimension_from_bronze("cards", raw(
        spark, "cards", (bank.card("K1", "A1"), 1), (bank.card("K1", "A1", stav="x"), 2),
        (bank.card("K7", "A7"), 1)), settings)
    now = {e: silver.current_dimension(e, d, settings)
           for e, d in (("accounts", accounts), ("customers", customers), ("cards", cards))}
    owners = gold.account_owners(now["accounts"], now["customers"])
    paid = raw(spark, "card_transactions", *((r, None) for r in (
        bank.payment("T1", "K1"), bank.payment("T2", "K1", "100", "2024-01-13 08:00:00", city_id=None),
        bank.payment("no account", "K7"), bank.payment("no card", "K9"), bank.payment("T1", "K1"))))
    moved = raw(spark, "financial_transactions", (bank.transfer("F1", "A2"), None),
                (bank.transfer("no account", "A9"), None))
    return gold.transaction_facts(
        silver.clean_fact("card_transactions", paid, settings),
        silver.clean_fact("financial_transactions", moved, settings),
        owners, gold.card_owners(now["cards"], owners), *references(spark, settings), settings)


def test_facts_documented(spark):
    rows = sorted((r.asDict() for r in facts(spark, NOW).collect()), key=lambda r: r["transaction_id"])
    assert [r["transaction_id"] for r in rows] == ["F1", "T1", "T1", "T2"]
    f1, t1, _, t2 = rows
    assert t1 == {
        "transaction_id": "T1", "transaction_type": "CARD", "card_id": "K1", "account_id": "A1",
        "customer_id": "2", "merchant_id": "M1", "amount": Decimal("1250.50"),
        "transaction_date": day(15), "merchant_category": "nákup", "city_name": "Praha",
        "region_name": "Region", "transaction_value_segment": "High Value", "transaction_hour": 14,
        "transaction_day_of_week": 2, "transaction_month": 1, "transaction_year": 2024,
        "client_age": 44, "customer_income": Decimal("20000.00")}
    assert t2["city_name"] == "Unknown" and t2["transaction_value_segment"] == "Low Value"
    assert (f1["card_id"], f1["merchant_id"], f1["city_name"]) == (None, None, "Unknown")


def test_facts_as_written_fan_out_and_lose_the_hour(spark):
    """Two open owners and two city rows multiply; the time of day is gone."""
    rows = [r for r in facts(spark, AS_WRITTEN).collect() if r["transaction_id"] == "T1"]
    assert len(rows) == 2 * 2 * 2 and {r["transaction_hour"] for r in rows} == {0}


def test_metrics_and_summary(spark):
    metrics = {r["transaction_id"]: r for r in gold.business_metrics(facts(spark, NOW), NOW).collect()}
    assert metrics["F1"]["time_period"] == "Evening" and metrics["F1"]["day_type"] == "Weekend"
    assert metrics["T1"]["time_period"] == "Business Hours" and metrics["T1"]["income_segment"] == "Low Income"
    assert metrics["T2"]["time_period"] == "Night" and metrics["F1"]["income_segment"] == "Medium Income"
    customers = silver.dimension_from_bronze("customers", people(spark, ("1", 1, {}), ("1", 2, {"prijem": "80000.01"})), NOW)
    row = gold.customer_summary(silver.current_dimension("customers", customers, NOW)).collect()
    assert len(row) == 1 and (row[0]["customer_tier"], row[0]["age_group"]) == ("Premium", "Middle-aged")


def test_geography_drops_the_unplaced(spark):
    branches = raw(spark, "branches", *((b, None) for b in (
        {"branch_id": "B1", "nazev": "n", "adresa": "Hlavní 12a / 3B, Praha, 11000", "city_id": "C1"},
        {"branch_id": "B2", "nazev": "n", "adresa": None, "city_id": "C8"})))
    cities, regions = references(spark, NOW)
    rows = silver.geography_hierarchy(silver.clean_reference("branches", branches, NOW), cities, regions).collect()
    assert len(rows) == 1
    assert (rows[0]["geography_key"], rows[0]["branch_street_number"], rows[0]["geography_level"]) == (
        "R1-C1-B1", "12a / 3B", "Branch")


def test_reports_on_facts(spark):
    rows = facts(spark, NOW).cache()
    metrics = gold.business_metrics(rows, NOW)
    assert reports.executive_dashboard(metrics, 2024, 1).agg(F.sum("transaction_count")).first()[0] == 4
    trend = reports.high_value_trend(rows, 6, day(1)).collect()
    assert [(r["transactions"], r["total_volume"]) for r in trend] == [(2, Decimal("2501.00"))]
    spend = {r["city_name"]: r["total_spend"] for r in reports.weekend_spend(rows, 40, 50).collect()}
    assert spend == {"Unknown": Decimal("150.00")}
    assert reports.weekend_spend(rows, 40, 50, "Praha").count() == 0
    share = reports.evening_share(metrics).first()
    assert (share["transactions"], share["evening_transactions"], share["evening_share"]) == (4, 1, 0.25)
    sides = {r[0]: (r[1], r[2]) for r in reports.weekend_comparison(metrics).collect()}
    assert sides == {"High Value": (0, 2), "Low Value": (2, 0)}
    shops = spark.createDataFrame([("M1", "food")], "merchant_id string, kategorie string")
    assert reports.merchant_performance(rows, shops).first()["transactions"] == 3


def test_cash_flow(spark):
    data = [("A", "10.00", day(1)), ("A", "10.00", day(1)), ("A", "4.00", day(3)), ("B", None, day(1))]
    balances = spark.createDataFrame(data, "account_id string, balance string, datum date").withColumn(
        "balance", F.col("balance").cast("decimal(20,2)"))
    got = sorted((r["account_id"], str(r["cash_flow"])) for r in reports.daily_cash_flow(balances).collect())
    assert got == [("A", "-6.00"), ("A", "None"), ("B", "None")]


def test_monitors(spark, tmp_path):
    rows = people(spark, ("1", 1, {}), ("1", 4, {}), ("2", None, {}))
    assert sorted(r[0] for r in monitors.missing_days(rows).collect()) == [day(2), day(3)]
    late = {r["snapshot_date"]: r["delay_hours"] for r in monitors.late_deliveries(
        rows.withColumn("ingestion_ts", F.lit("2024-01-05 06:00:00").cast("timestamp")), 48).collect()}
    assert late == {day(1): 102}
    volumes = spark.createDataFrame(
        [(day(1 + n),) for n in range(10) for _ in range(100 if n == 8 else 10 + n % 2)], "d date")
    odd = monitors.volume_anomalies(volumes, "d", 5, 3.0).where("is_anomaly").collect()
    assert [r["day"] for r in odd] == [day(9)]
    landing = bank.land(tmp_path, "regions", [{"region_id": "1"}])
    bank.land(tmp_path, "regions", [{"region_id": "1"}], name="odd.csv", header=("nazev", "region_id"))
    header = ",".join(LANDING["regions"])
    (tmp_path / "landing_data" / "regions" / "late.csv").write_text(f"x,y\n{header}\n")
    files = monitors.drifted_headers(spark, f"{landing}/regions", "regions").collect()
    assert sorted(r[0].rsplit("/", 1)[1] for r in files) == ["late.csv", "odd.csv"]


def test_latest_per_key_is_deterministic_on_full_ties(spark, rows_of):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), (None, 1, "n")], "k string, o int, v string")
    once = rows_of(latest_per_key(df, ["k"], ["o"]))
    assert once == rows_of(latest_per_key(df.orderBy(F.desc("v")), ["k"], ["o"])) and len(once) == 2


# Published column names and types that are not plain text.
TYPED = {
    "dim_customers": {
        "datum_narozeni": "date", "pocet_clenu_domacnost": "int", "datum_prvniho_otevreni_uctu": "date",
        "prijem": "decimal(20,2)", "sum_prm_uspor_12m": "decimal(20,2)", "min_atm_amt": "decimal(20,2)",
        "pocet_nemovitosti": "int", "client_age": "int", "days_from_open_first_acc": "int",
        "snapshot_date": "date", "__START_AT": "timestamp", "__END_AT": "timestamp"},
    "dim_accounts": {"snapshot_date": "date", "__START_AT": "timestamp", "__END_AT": "timestamp"},
    "dim_cards": {"platnost_do": "date", "snapshot_date": "date", "__START_AT": "timestamp", "__END_AT": "timestamp"},
    "dim_employees": {"snapshot_date": "date", "__START_AT": "timestamp", "__END_AT": "timestamp"},
    "dim_geography_hierarchy": {"created_at": "timestamp"},
    "account_balances_silver": {"balance": "decimal(20,2)", "datum": "date"},
    FACTS: {
        "amount": "decimal(20,2)", "transaction_date": "date", "transaction_hour": "int",
        "transaction_day_of_week": "int", "transaction_month": "int", "transaction_year": "int",
        "client_age": "int", "customer_income": "decimal(20,2)"},
    METRICS: {"amount": "decimal(20,2)", "transaction_date": "date", "transaction_year": "int",
              "transaction_month": "int", "processed_at": "timestamp"},
    SUMMARY: {"client_age": "int", "annual_income": "decimal(20,2)", "processed_at": "timestamp"},
}


@pytest.mark.parametrize("name", TYPED)
def test_published_types(spark, name):
    schema = schema_of(spark, NOW, name)
    assert {f.name: f.dataType.simpleString() for f in schema if f.dataType.simpleString() != "string"} == TYPED[name]


def test_published_columns(spark):
    for entity in ("accounts", "cards", "employees"):
        assert schema_of(spark, NOW, f"dim_{entity}").names == [
            *LANDING[entity], "snapshot_date", "__START_AT", "__END_AT"]
    assert schema_of(spark, NOW, METRICS).names == [
        "transaction_id", "transaction_type", "customer_id", "amount", "transaction_date",
        "transaction_value_segment", "city_name", "region_name", "transaction_year", "transaction_month",
        "time_period", "day_type", "income_segment", "processed_at"]
    assert len(schema_of(spark, NOW, "customers_clean_silver")) == 31
    assert {f"dim_{e}" for e in HISTORY_KEYS} <= set(TABLES)
    layers = [t.layer for t in TABLES.values()]
    assert [layers.count(x) for x in ("bronze", "silver", "gold")] == [12, 25, 3]
    for name, table in TABLES.items():
        order = list(TABLES)
        assert all(order.index(i) < order.index(name) for i in table.inputs)


def test_declared_table_is_empty_and_typed(spark, tmp_path):
    settings = Settings(root=str(tmp_path), as_of=AS_OF, env="declared")
    declare(spark, settings, "dim_cards")
    assert read_table(spark, settings, "dim_cards").count() == 0
    assert spark.table(publish(spark, settings, "dim_cards")).columns[-1] == "__END_AT"
    cards = silver.dimension_from_bronze("cards", raw(spark, "cards", (bank.card("K", "A"), 1)), settings)
    write_table(cards, settings, "dim_cards")
    declare(spark, settings, "dim_cards")
    assert read_table(spark, settings, "dim_cards").count() == 1


def test_settings(spark):
    assert Settings(root="/x").path("silver", "t") == "/x/dev_silver/t"
    assert Settings(root="/x", env="").path("gold", "t") == "/x/gold/t"
    with pytest.raises(ValueError):
        Settings(mode="other")
    with pytest.raises(ValueError):
        Settings().path("gold", "t")
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
