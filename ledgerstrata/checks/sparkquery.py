"""One Spark query per operator, on the benchmark tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import REFERENCE, Settings
from ..functions import bands, lineage, text
from ..operators import quality
from ..operators.asof import asof_join
from ..operators.latest import latest_per_key, surplus_owners
from ..operators.scd2 import current, scd2, valid_at
from ..operators.sweep import open_by_day
from ..plans import gold, monitors, reports, roles, silver
from ..schemas import INGESTED, LANDING, SNAPSHOT

#: Fixed reporting date, so that ages do not move with the clock.
AS_OF = dt.date(2024, 6, 30)
SETTINGS = Settings(as_of=AS_OF)
AS_WRITTEN = Settings(as_of=AS_OF, mode=REFERENCE)

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


class Bank(roles.Roles):
    """The bank's tables, built from the benchmark tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS):
        super().__init__(spark, sf_dir)
        self.settings = settings

    def flagged(self, entity: str) -> DataFrame:
        return silver.flagged_snapshot(entity, self.raw(entity), self.settings)

    def dimension(self, entity: str) -> DataFrame:
        return silver.dimension_from_bronze(entity, self.raw(entity), self.settings)

    def current(self, entity: str, columns: Sequence[str] | None = None) -> DataFrame:
        good = quality.good_records(self.flagged(entity))
        return silver.current_from_log(entity, good, self.settings, columns)

    def fact_source(self, entity: str) -> DataFrame:
        return silver.clean_fact(entity, self.raw(entity), self.settings)

    def reference(self, entity: str) -> DataFrame:
        return silver.clean_reference(entity, self.raw(entity), self.settings)

    def geography(self) -> DataFrame:
        return silver.geography_hierarchy(*map(self.reference, ("branches", "cities", "regions")))

    def owners(self) -> DataFrame:
        return gold.account_owners(
            self.current("accounts", ["customer_id"]),
            self.current("customers", ["client_age", "prijem"]))

    def card_owners(self, owners: DataFrame | None = None) -> DataFrame:
        known = self.owners() if owners is None else owners
        return gold.card_owners(self.current("cards", ["account_id"]), known)

    def places(self) -> list[DataFrame]:
        return [self.reference("cities"), self.reference("regions")]

    def card_facts(self) -> DataFrame:
        return gold.card_facts(
            self.fact_source("card_transactions"), self.card_owners(), *self.places(), self.settings)

    def financial_facts(self) -> DataFrame:
        return gold.financial_facts(
            self.fact_source("financial_transactions"), self.owners(), *self.places(), self.settings)

    def facts(self) -> DataFrame:
        owners = self.owners()
        return gold.transaction_facts(
            self.fact_source("card_transactions"), self.fact_source("financial_transactions"),
            owners, self.card_owners(owners), *self.places(), self.settings)

    def metrics(self) -> DataFrame:
        return gold.business_metrics(self.facts(), self.settings)

    def summary(self) -> DataFrame:
        return gold.customer_summary(self.current("customers"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return roles.Roles(spark, sf_dir).table(name)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _events(spark, sf_dir).select("user_id", "ts", "event_type")
    return scd2(log, ["user_id"], "ts", start="start_at", end="end_at")


# -- bands ------------------------------------------------------------------------


@query
def band_value(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", bands.transaction_value(F.col("value") * 5).alias("value_segment"))


@query
def band_time(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", bands.time_period(F.hour("ts")).alias("time_period"))


@query
def band_daytype(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", bands.day_type(F.dayofweek("ts")).alias("day_type"))


@query
def band_income(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select(
        "c_custkey", bands.income_segment(F.col("c_acctbal") * 10).alias("income_segment"))


@query
def band_age(spark, sf_dir):
    age = AS_OF.year - (1930 + F.col("c_custkey") % 90)
    return _table(spark, sf_dir, "customer").select("c_custkey", bands.age_group(age).alias("age_group"))


@query
def band_tier(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select(
        "c_custkey", bands.customer_tier(F.col("c_acctbal") * 10).alias("customer_tier"))


@query
def calendar_parts(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", F.hour("ts").alias("transaction_hour"),
        F.dayofweek("ts").alias("transaction_day_of_week"),
        F.month("ts").alias("transaction_month"), F.year("ts").alias("transaction_year"))


# -- cleaning ---------------------------------------------------------------------


def _address(spark, sf_dir, settings):
    clean = silver.typed_customers(Bank(spark, sf_dir).raw("customers"), settings)
    return clean.select(
        "customer_id", SNAPSHOT, "cela_adresa", "ulice", "cislo_popisne", "mesto", "zip_code").distinct()


@query
def address_split(spark, sf_dir):
    return _address(spark, sf_dir, SETTINGS)


@query
def address_split_as_written(spark, sf_dir):
    return _address(spark, sf_dir, AS_WRITTEN)


@query
def branch_address(spark, sf_dir):
    return Bank(spark, sf_dir).reference("branches")


@query
def phone_normalise(spark, sf_dir):
    phone = F.col("tel_cislo")
    prefix, number = text.phone_parts(phone)
    log = Bank(spark, sf_dir).raw("customers")
    return log.select("customer_id", prefix.alias("predcisli"), number.alias("tel_cislo")).distinct()


@query
def typed_casts(spark, sf_dir):
    clean = silver.typed_customers(Bank(spark, sf_dir).raw("customers"), SETTINGS)
    return clean.select(
        "customer_id", SNAPSHOT, "datum_narozeni", "datum_prvniho_otevreni_uctu", "prijem",
        "sum_prm_uspor_12m", "min_atm_amt", "pocet_clenu_domacnost", "pocet_nemovitosti")


@query
def age_tenure_asof(spark, sf_dir):
    clean = silver.typed_customers(Bank(spark, sf_dir).raw("customers"), SETTINGS)
    return clean.select("customer_id", "client_age", "days_from_open_first_acc").distinct()


@query
def snapshot_date_from_path(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    folder = F.when(F.col("o_orderkey") % 11 == 0, F.lit("2024.13.40")).when(
        F.col("o_orderkey") % 7 == 0, F.lit("undated")).otherwise(
        F.date_format("o_orderdate", lineage.SNAPSHOT_FORMAT))
    path = F.concat(F.lit("file:/x/landing_data/customers/"), folder, F.lit("/part.csv"))
    return orders.select("o_orderkey", path.alias("source_file")).withColumn(
        "snapshot_date", lineage.snapshot_date(F.col("source_file")))


@query
def card_transactions_silver(spark, sf_dir):
    return Bank(spark, sf_dir).fact_source("card_transactions")


@query
def financial_transactions_silver(spark, sf_dir):
    return Bank(spark, sf_dir).fact_source("financial_transactions")


@query
def account_balances_silver(spark, sf_dir):
    return Bank(spark, sf_dir).fact_source("account_balances")


@query
def reference_tables(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    tables = [
        bank.reference(entity).select(
            F.lit(entity).alias("entity"), F.col(LANDING[entity][0]).alias("id"), "nazev",
            (F.col("kategorie") if "kategorie" in LANDING[entity] else F.lit(None).cast("string")).alias("kategorie"))
        for entity in ("merchants", "products", "cities", "regions")]
    first, *others = tables
    for other in others:
        first = first.unionByName(other)
    return first


# -- quality ----------------------------------------------------------------------


@query
def quality_metrics(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    counts = [
        quality.rule_counts(bank.flagged(entity), quality.rules_for(entity, SETTINGS)).select(
            F.lit(entity).alias("entity"), "*")
        for entity in ("customers", "accounts", "cards", "employees")]
    first, *others = counts
    for other in others:
        first = first.unionByName(other)
    return first


@query
def quarantine_flag(spark, sf_dir):
    return Bank(spark, sf_dir).flagged("customers").select(
        "customer_id", SNAPSHOT, "datum_narozeni", "is_quarantined")


@query
def quarantine_reference_nulls(spark, sf_dir):
    return Bank(spark, sf_dir, AS_WRITTEN).flagged("customers").select(
        "customer_id", SNAPSHOT, "datum_narozeni", "is_quarantined")


@query
def good_records(spark, sf_dir):
    return quality.good_records(Bank(spark, sf_dir).flagged("accounts")).drop(INGESTED)


@query
def bad_records(spark, sf_dir):
    return quality.bad_records(Bank(spark, sf_dir).flagged("accounts")).drop(INGESTED)


# -- history ----------------------------------------------------------------------


@query
def scd2_history(spark, sf_dir):
    return _event_history(spark, sf_dir)


@query
def scd2_string_sequence(spark, sf_dir):
    """A history ordered by text, with every key cut into slices of a few rows."""
    log = _table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("string").alias("seen_on"), "o_orderkey", "o_orderpriority")
    return scd2(log, ["o_custkey"], "seen_on", tie_break=["o_orderkey"], start="start_at", end="end_at", hot_rows=8)


@query
def asof_join_one_moment(spark, sf_dir):
    """All events of one user and one moment against the user's history, cut into slices."""
    orders = _table(spark, sf_dir, "orders")
    history = scd2(
        orders.select((F.col("o_custkey") % 50).alias("user_id"), "o_orderdate", "o_orderkey", "o_orderpriority"),
        ["user_id"], "o_orderdate", tie_break=["o_orderkey"], start="start_at", end="end_at")
    crowd = F.col("event_id") % 3 == 0
    facts = _events(spark, sf_dir).select(
        "event_id", F.when(crowd, 7).otherwise(F.col("user_id") % 50).alias("user_id"),
        F.when(crowd, F.expr("TIMESTAMP_NTZ'1998-01-01 00:00:00'")).otherwise(
            F.col("ts") - F.make_interval(days=(8300 + F.col("event_id") % 2400).cast("int"))).alias("happened_at"))
    return asof_join(facts, history, ["user_id"], "happened_at", ["o_orderpriority", "start_at"],
                     start="start_at", end="end_at", hot_rows=300)


@query
def scd2_current(spark, sf_dir):
    return current(_event_history(spark, sf_dir), "end_at").drop("end_at")


@query
def scd2_untracked(spark, sf_dir):
    log = _table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority",
        F.col("o_totalprice").cast("decimal(20,2)").alias("o_totalprice"))
    return scd2(log, ["o_custkey"], "o_orderdate", untracked=["o_totalprice"], tie_break=["o_orderkey"],
                start="start_at", end="end_at")


@query
def scd1_latest(spark, sf_dir):
    return latest_per_key(_events(spark, sf_dir).select("user_id", "ts", "event_type", "value"), ["user_id"], ["ts"])


@query
def asof_lookup(spark, sf_dir):
    moment = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return valid_at(_event_history(spark, sf_dir), moment, "start_at", "end_at")


@query
def asof_join_events(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    history = scd2(
        orders.select(F.col("o_custkey").alias("user_id"), "o_orderdate", "o_orderkey", "o_orderpriority"),
        ["user_id"], "o_orderdate", tie_break=["o_orderkey"], start="start_at", end="end_at")
    # Events are moved back so that they fall among the orders.
    facts = _events(spark, sf_dir).select(
        "event_id", "user_id",
        (F.col("ts") - F.make_interval(days=(8300 + F.col("event_id") % 2400).cast("int")))
        .alias("happened_at"))
    return asof_join(facts, history, ["user_id"], "happened_at", ["o_orderpriority", "start_at"],
                     start="start_at", end="end_at")


@query
def dim_customers(spark, sf_dir):
    return Bank(spark, sf_dir).dimension("customers")


@query
def dim_customers_as_written(spark, sf_dir):
    return Bank(spark, sf_dir, AS_WRITTEN).dimension("customers")


@query
def dim_accounts(spark, sf_dir):
    return Bank(spark, sf_dir).dimension("accounts")


@query
def dim_cards(spark, sf_dir):
    return Bank(spark, sf_dir).dimension("cards")


@query
def dim_employees(spark, sf_dir):
    return Bank(spark, sf_dir).dimension("employees")


@query
def dedupe_latest(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


def _shared_accounts(spark, sf_dir):
    """Priority as an account several customers held in turn."""
    log = _table(spark, sf_dir, "orders").select(
        F.concat("o_orderpriority", F.lit("-"), (F.col("o_custkey") % 100).cast("string")).alias("account_id"),
        F.col("o_custkey").cast("string").alias("customer_id"), F.col("o_orderstatus").alias("stav"),
        F.col("o_orderdate").cast("date").alias(SNAPSHOT), F.timestamp_seconds("o_orderkey").alias(INGESTED))
    return silver.history_dimension("accounts", log, SETTINGS)


@query
def current_unique(spark, sf_dir):
    return silver.current_dimension("accounts", _shared_accounts(spark, sf_dir), SETTINGS).select(
        "account_id", "customer_id", "stav", SNAPSHOT)


@query
def current_surplus(spark, sf_dir):
    return surplus_owners(current(_shared_accounts(spark, sf_dir)), ["account_id"])


# -- dimensions, facts and marts ------------------------------------------------------


@query
def geography(spark, sf_dir):
    return Bank(spark, sf_dir).geography().drop("created_at")


@query
def geography_rollup(spark, sf_dir):
    return reports.geography_rollup(Bank(spark, sf_dir).geography())


@query
def card_fact(spark, sf_dir):
    return Bank(spark, sf_dir).card_facts()


@query
def financial_fact(spark, sf_dir):
    return Bank(spark, sf_dir).financial_facts()


@query
def fact_union(spark, sf_dir):
    return Bank(spark, sf_dir).facts()


@query
def fact_union_as_written(spark, sf_dir):
    return Bank(spark, sf_dir, AS_WRITTEN).facts()


@query
def business_metrics(spark, sf_dir):
    return Bank(spark, sf_dir).metrics().drop("processed_at")


@query
def customer_summary(spark, sf_dir):
    return Bank(spark, sf_dir).summary().drop("processed_at")


# -- documented queries ------------------------------------------------------------


@query
def key_history(spark, sf_dir):
    """Income history of one customer; the key reaches the scan."""
    return reports.income_history(Bank(spark, sf_dir).dimension("customers"), "7")


@query
def account_lifecycle(spark, sf_dir):
    return reports.account_lifecycle(current(Bank(spark, sf_dir).dimension("accounts")))


@query
def account_lifecycle_by_day(spark, sf_dir):
    """Open accounts by type and status at the close of each day of half a year."""
    history = Bank(spark, sf_dir).dimension("accounts")
    return open_by_day(history, ["typ_uctu", "stav"], dt.date(1998, 1, 1), dt.date(1998, 6, 30), count="pocet_uctu")


@query
def tx_with_customer(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return reports.transactions_with_customer(
        bank.fact_source("card_transactions"), bank.card_owners())


@query
def exec_dashboard(spark, sf_dir):
    return reports.executive_dashboard(Bank(spark, sf_dir).metrics(), 2024, 1)


@query
def exec_dashboard_cards(spark, sf_dir):
    """The dashboard of a month of card transactions."""
    return reports.executive_dashboard(Bank(spark, sf_dir).metrics(), 1998, 6)


@query
def customer_segmentation(spark, sf_dir):
    return reports.customer_segmentation(Bank(spark, sf_dir).summary())


@query
def tx_trends(spark, sf_dir):
    return reports.transaction_trends(Bank(spark, sf_dir).metrics(), dt.date(1998, 1, 1))


# -- reports -----------------------------------------------------------------------


@query
def weekend_spend(spark, sf_dir):
    return reports.weekend_spend(Bank(spark, sf_dir).facts(), 25, 35)


@query
def high_value_trend(spark, sf_dir):
    return reports.high_value_trend(Bank(spark, sf_dir).facts(), 6, dt.date(1998, 12, 1))


@query
def evening_regions(spark, sf_dir):
    return reports.evening_regions(Bank(spark, sf_dir).metrics(), 3)


@query
def income_segment_behaviour(spark, sf_dir):
    return reports.income_segment_behaviour(Bank(spark, sf_dir).metrics())


@query
def daily_summary(spark, sf_dir):
    return reports.daily_summary(Bank(spark, sf_dir).metrics())


@query
def region_ranking(spark, sf_dir):
    return reports.region_ranking(Bank(spark, sf_dir).metrics(), 5)


@query
def weekend_comparison(spark, sf_dir):
    return reports.weekend_comparison(Bank(spark, sf_dir).metrics())


@query
def evening_share(spark, sf_dir):
    return reports.evening_share(Bank(spark, sf_dir).metrics())


@query
def premium_customers(spark, sf_dir):
    return reports.premium_customers(Bank(spark, sf_dir).summary())


@query
def customers_by_place(spark, sf_dir):
    return reports.customers_by_place(Bank(spark, sf_dir).summary())


@query
def young_earners(spark, sf_dir):
    return reports.young_earners(Bank(spark, sf_dir).summary(), 20000)


@query
def expiring_cards(spark, sf_dir):
    as_of = F.lit("2001-01-01").cast("date")
    return reports.expiring_cards(
        Bank(spark, sf_dir).current("cards", ["account_id", "platnost_do"]), as_of, 90)


@query
def daily_cash_flow(spark, sf_dir):
    return reports.daily_cash_flow(Bank(spark, sf_dir).fact_source("account_balances"))


@query
def merchant_performance(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return reports.merchant_performance(bank.facts(), bank.reference("merchants"))


# -- monitors ----------------------------------------------------------------------


@query
def missing_days(spark, sf_dir):
    return monitors.missing_days(Bank(spark, sf_dir).raw("customers"))


@query
def volume_anomalies(spark, sf_dir):
    rows = Bank(spark, sf_dir).fact_source("card_transactions")
    days = monitors.volume_anomalies(rows, "datum", 30, 2.0)
    return days.withColumns({c: F.round(c, 6) for c in ("mean_rows", "stddev_rows")})


@query
def late_deliveries(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    taken = F.col("o_orderdate") + F.make_interval(hours=(F.col("o_orderkey") % 60).cast("int"))
    bronze = orders.select(
        F.col("o_orderdate").cast("date").alias(SNAPSHOT), taken.cast("timestamp").alias(INGESTED))
    return monitors.late_deliveries(bronze, 48)


@query
def daily_activity(spark, sf_dir):
    return monitors.daily_activity(Bank(spark, sf_dir).facts())
