"""Enriched transactions and the marts read by reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import bands
from ..schemas import FACT_COLUMNS

UNKNOWN = "Unknown"
CARD, FINANCIAL = "CARD", "FINANCIAL"


def account_owners(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Current accounts with the age and income of their current owners."""
    people = customers.select("customer_id", "client_age", F.col("prijem").alias("customer_income"))
    return accounts.select("account_id", "customer_id").join(people, "customer_id")


def card_owners(cards: DataFrame, owners: DataFrame) -> DataFrame:
    """Current cards with their accounts and owners."""
    return cards.select("card_id", "account_id").join(owners, "account_id")


def paid_by_card(transactions: DataFrame, owners_of_cards: DataFrame) -> DataFrame:
    """Card transactions of known owners.

    The dimension chain is joined beforehand, so the transactions, by far the
    larger side, are shuffled once and not once per dimension. A card with very
    many transactions is split at run time by the adaptive skew join.
    """
    return transactions.join(owners_of_cards, "card_id").withColumnRenamed(
        "card_transaction_id", "transaction_id").withColumn("transaction_type", F.lit(CARD))


def moved_on_account(transactions: DataFrame, owners: DataFrame) -> DataFrame:
    """Account transactions of known owners; they have no card and no merchant."""
    absent = F.lit(None).cast("string")
    return transactions.join(owners, "account_id").withColumns(
        {"card_id": absent, "merchant_id": absent, "transaction_type": F.lit(FINANCIAL)})


def enriched(owned: DataFrame, cities: DataFrame, regions: DataFrame, settings: Settings) -> DataFrame:
    """Add the names of the transaction's own city and region, and its segments.

    Spark broadcasts cities and regions as long as they are below its size
    threshold, and joins them by shuffle otherwise.
    """
    city = cities.select("city_id", F.col("nazev").alias("city_name"))
    region = regions.select("region_id", F.col("nazev").alias("region_name"))
    placed = owned.join(city, "city_id", "left").join(region, "region_id", "left")
    happened = F.col("datum_ts") if settings.documented else F.col("datum")
    computed = {
        "transaction_date": F.col("datum"),
        "merchant_category": F.col("typ_transakce"),
        "city_name": F.coalesce("city_name", F.lit(UNKNOWN)),
        "region_name": F.coalesce("region_name", F.lit(UNKNOWN)),
        "transaction_value_segment": bands.transaction_value(F.col("amount")),
        "transaction_hour": F.hour(happened),
        "transaction_day_of_week": F.dayofweek("datum"),
        "transaction_month": F.month("datum"),
        "transaction_year": F.year("datum"),
    }
    return placed.select(*(computed.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS))


def card_facts(
    transactions: DataFrame, owners_of_cards: DataFrame, cities: DataFrame, regions: DataFrame,
    settings: Settings,
) -> DataFrame:
    return enriched(paid_by_card(transactions, owners_of_cards), cities, regions, settings)


def financial_facts(
    transactions: DataFrame, owners: DataFrame, cities: DataFrame, regions: DataFrame,
    settings: Settings,
) -> DataFrame:
    return enriched(moved_on_account(transactions, owners), cities, regions, settings)


def transaction_facts(
    card_transactions: DataFrame,
    financial_transactions: DataFrame,
    owners: DataFrame,
    owners_of_cards: DataFrame,
    cities: DataFrame,
    regions: DataFrame,
    settings: Settings,
) -> DataFrame:
    """All transactions with customer and place; duplicates are kept."""
    return enriched(owned_transactions(card_transactions, financial_transactions, owners, owners_of_cards), cities, regions, settings)


def owned_transactions(
    card_transactions: DataFrame, financial_transactions: DataFrame, owners: DataFrame, owners_of_cards: DataFrame,
) -> DataFrame:
    """All transactions of known owners."""
    return paid_by_card(card_transactions, owners_of_cards).unionByName(moved_on_account(financial_transactions, owners))


def by_period(owned: DataFrame) -> DataFrame:
    """Transactions dealt to the year and month they are filed under, before names and segments widen them."""
    periods = {"transaction_year": F.year("datum"), "transaction_month": F.month("datum")}
    return owned.withColumns(periods).hint("rebalance", *periods)


def business_metrics(facts: DataFrame, settings: Settings) -> DataFrame:
    """Transactions with the segments reports group by.

    The documented contract carries the year and month its reports filter on,
    and the table is partitioned by.
    """
    period = ["transaction_year", "transaction_month"] if settings.documented else []
    return facts.select(
        "transaction_id", "transaction_type", "customer_id", "amount", "transaction_date",
        "transaction_value_segment", "city_name", "region_name", *period,
        bands.time_period(F.col("transaction_hour")).alias("time_period"),
        bands.day_type(F.col("transaction_day_of_week")).alias("day_type"),
        bands.income_segment(F.col("customer_income")).alias("income_segment"),
        F.current_timestamp().alias("processed_at"),
    )


def customer_summary(customers: DataFrame) -> DataFrame:
    """Current customers with age group and tier.

    Income keeps its published name although it is delivered per month.
    """
    return customers.select(
        "customer_id", "jmeno", "prijmeni", "client_age",
        F.col("prijem").alias("annual_income"),
        F.col("pohlavi").alias("gender"),
        F.col("pracovni_stav").alias("employment_status"),
        F.col("mesto").alias("city"),
        F.col("zeme").alias("country"),
        bands.age_group(F.col("client_age")).alias("age_group"),
        bands.customer_tier(F.col("prijem")).alias("customer_tier"),
        F.current_timestamp().alias("processed_at"),
    )
