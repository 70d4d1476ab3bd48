"""Questions asked of the published tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands
from ..operators.latest import latest_per_key
from ..operators.scd2 import history_of
from ..schemas import END, START


def _rows() -> Column:
    return F.count(F.lit(1))


VOLUME = "decimal(38,2)"
RATE = "double"


def _volume(amount: str = "amount") -> Column:
    return F.sum(amount).cast(VOLUME)


def _mean(amount: str = "amount") -> Column:
    """Exact sum over count; an average of decimals would be rounded first."""
    return F.try_divide(F.sum(amount).cast(RATE), F.count(amount))


# -- queries printed in the data dictionary ---------------------------------------


def income_history(customers: DataFrame, customer_id: str) -> DataFrame:
    """Income of one customer through time, oldest first."""
    return history_of(customers, "customer_id", customer_id).select("customer_id", "prijem", START, END)


def account_lifecycle(accounts: DataFrame) -> DataFrame:
    """Current accounts by type and status."""
    return accounts.groupBy("typ_uctu", "stav").agg(_rows().alias("pocet_uctu"))


def transactions_with_customer(
    card_transactions: DataFrame, owners_of_cards: DataFrame) -> DataFrame:
    """Card transactions with owner's age and income, reached through the card."""
    owner = owners_of_cards.select("card_id", "client_age", F.col("customer_income").alias("prijem"))
    return card_transactions.join(owner, "card_id")


def executive_dashboard(metrics: DataFrame, year: int, month: int) -> DataFrame:
    in_month = (F.col("transaction_year") == year) & (F.col("transaction_month") == month)
    return metrics.where(in_month).groupBy("region_name", "time_period").agg(
        _rows().alias("transaction_count"), _volume().alias("total_volume"))


def customer_segmentation(summary: DataFrame) -> DataFrame:
    return summary.groupBy("customer_tier", "age_group").agg(
        _rows().alias("customer_count"), _mean("annual_income").alias("avg_income"))


def transaction_trends(metrics: DataFrame, since: dt.date) -> DataFrame:
    return (
        metrics.where(F.col("transaction_date") >= F.lit(since))
        .groupBy("day_type", "income_segment", "transaction_value_segment")
        .agg(_rows().alias("transactions"), _mean().alias("avg_amount"))
    )


# -- reports the data dictionary names in prose -------------------------------------


def weekend_spend(
    facts: DataFrame, youngest: int, oldest: int, city: str | None = None) -> DataFrame:
    """Weekend spend of an age range, in one city or in each."""
    chosen = F.col("client_age").between(youngest, oldest) & F.col("transaction_day_of_week").isin(
        *bands.WEEKEND_DAYS)
    if city is not None:
        chosen &= F.col("city_name") == city
    return facts.where(chosen).groupBy("city_name").agg(
        _rows().alias("transactions"), _volume().alias("total_spend"))


def high_value_trend(facts: DataFrame, months: int, until: dt.date) -> DataFrame:
    """High-value transactions per month of the ``months`` months that end with the one of ``until``.

    The months are compared as partition columns, so only their folders are read.
    """
    month = F.col("transaction_year") * 12 + F.col("transaction_month")
    last = until.year * 12 + until.month
    recent = facts.where(
        month.between(last - months + 1, last)
        & (F.col("transaction_value_segment") == bands.VALUE_OVER[0][1]))
    return recent.groupBy("transaction_year", "transaction_month").agg(
        _rows().alias("transactions"), _volume().alias("total_volume"))


def evening_regions(metrics: DataFrame, top: int) -> DataFrame:
    """Regions with most evening transactions."""
    evening = F.col("time_period") == bands.HOUR_BETWEEN[1][2]
    per_region = metrics.where(evening).groupBy("region_name").agg(_rows().alias("transactions"))
    return per_region.orderBy(F.desc("transactions"), "region_name").limit(top)


def income_segment_behaviour(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("income_segment").agg(
        _rows().alias("transactions"), _mean().alias("avg_amount"), _volume().alias("total_volume"))


def daily_summary(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("transaction_date", "time_period").agg(
        _rows().alias("transactions"), _volume().alias("total_volume"))


def region_ranking(metrics: DataFrame, top: int) -> DataFrame:
    """Regions by number of transactions, then by volume."""
    per_region = metrics.groupBy("region_name").agg(
        _rows().alias("transactions"), _volume().alias("total_volume"))
    return per_region.orderBy(F.desc("transactions"), F.desc("total_volume"), "region_name").limit(top)


def weekend_comparison(metrics: DataFrame) -> DataFrame:
    """Per value segment, weekend and weekday transactions side by side."""
    pivoted = metrics.groupBy("transaction_value_segment").pivot(
        "day_type", [bands.WEEKEND, bands.WEEKDAY]).agg(_rows())
    return pivoted.select(
        "transaction_value_segment",
        F.coalesce(bands.WEEKEND, F.lit(0)).alias("weekend_transactions"),
        F.coalesce(bands.WEEKDAY, F.lit(0)).alias("weekday_transactions"),
    )


def evening_share(metrics: DataFrame) -> DataFrame:
    """Evening share of the transactions of each month."""
    evening = F.count_if(F.col("time_period") == bands.HOUR_BETWEEN[1][2])
    return metrics.groupBy("transaction_year", "transaction_month").agg(
        _rows().alias("transactions"), evening.alias("evening_transactions")
    ).withColumn(
        "evening_share", F.col("evening_transactions").cast(RATE) / F.col("transactions").cast(RATE))


def premium_customers(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("customer_tier") == bands.TIER_OVER[0][1]).drop("processed_at")


def customers_by_place(summary: DataFrame) -> DataFrame:
    return summary.groupBy("country", "city", "age_group").agg(_rows().alias("customers"))


def young_earners(summary: DataFrame, income_over: int) -> DataFrame:
    """Young customers with an income above a bound."""
    young = F.col("age_group") == bands.AGE_UNDER[0][1]
    return summary.where(young & (F.col("annual_income") > income_over)).drop("processed_at")


def geography_rollup(geography: DataFrame) -> DataFrame:
    """Branch counts per region and city, per region, and in total."""
    return geography.rollup("region_name", "city_name").agg(
        _rows().alias("branches"), F.grouping_id().cast("int").alias("rollup_level"))


def expiring_cards(cards: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Current cards that run out within ``days`` days."""
    left = F.datediff("platnost_do", as_of)
    return cards.select(
        "card_id", "account_id", "platnost_do", left.alias("days_left")
    ).where(F.col("days_left").between(0, days))


def daily_cash_flow(balances: DataFrame) -> DataFrame:
    """Change of each account's balance from one reported day to the next.

    Copies of a day are merged first (the largest balance counts), so that an
    account has one row per calendar day, which bounds its window.
    """
    daily = latest_per_key(balances, ["account_id", "datum"], ["balance"])
    before = F.lag("balance").over(Window.partitionBy("account_id").orderBy("datum"))
    return daily.select("account_id", "datum", "balance", (F.col("balance") - before).cast("decimal(21,2)").alias("cash_flow"))


def merchant_performance(facts: DataFrame, merchants: DataFrame) -> DataFrame:
    """Transactions and volume per merchant category."""
    category = merchants.select("merchant_id", "kategorie")
    # Sum per merchant first: the shuffle to the merchant table carries one row
    # per merchant and map task, however many transactions a merchant has.
    per_merchant = facts.where(F.col("merchant_id").isNotNull()).groupBy("merchant_id").agg(
        _rows().alias("n"), F.sum("amount").alias("s"))
    return per_merchant.join(category, "merchant_id").groupBy("kategorie").agg(
        F.count("merchant_id").alias("merchants"), F.sum("n").alias("transactions"),
        F.sum("s").cast(VOLUME).alias("total_volume"))
