"""Cleaned tables, quarantine, history dimensions and the geography hierarchy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import text, values
from ..operators import quality
from ..operators.latest import latest_per_key
from ..operators.scd2 import current, scd2, with_timestamps
from ..schemas import (
    CLEAN_CUSTOMER_COLUMNS, HISTORY_KEYS, INGESTED, LANDING, SNAPSHOT, TECHNICAL,
)

#: Columns that move with the calendar alone; a change of theirs is no news.
CLOCK_COLUMNS = ("client_age", "days_from_open_first_acc")

GEOGRAPHY_LEVEL = "Branch"


def without_technical(df: DataFrame) -> DataFrame:
    return df.drop(*TECHNICAL)


# -- cleaning: one projection each, the same for batch and stream ---------------


def typed_customers(bronze: DataFrame, settings: Settings) -> DataFrame:
    """Customers with parsed address and phone, typed values, age and tenure."""
    street_line, city, postal = text.address_parts(F.col("adresa"), trimmed=settings.documented)
    street, number = text.first_word_street(street_line, keep_number=settings.documented)
    prefix, phone = text.phone_parts(F.col("tel_cislo"))
    born = values.day(F.col("datum_narozeni"))
    first_account = values.day(F.col("datum_prvniho_otevreni_uctu"))
    computed = {
        "cela_adresa": F.col("adresa"),
        "zip_code": postal,
        "mesto": city,
        "ulice": street,
        "cislo_popisne": number,
        "predcisli": prefix,
        "tel_cislo": phone,
        "datum_narozeni": born,
        "datum_prvniho_otevreni_uctu": first_account,
        "client_age": values.years_between(born, settings.as_of_column),
        "days_from_open_first_acc": values.days_since(first_account, settings.as_of_column),
        **{c: values.money(F.col(c)) for c in ("prijem", "sum_prm_uspor_12m", "min_atm_amt")},
        **{c: values.whole(F.col(c)) for c in ("pocet_clenu_domacnost", "pocet_nemovitosti")},
    }
    shown = [computed.get(c, F.col(c)).alias(c) for c in CLEAN_CUSTOMER_COLUMNS]
    return bronze.select(*shown, *_kept_ingestion(bronze))


def _kept_ingestion(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == INGESTED]


def _typed(entity: str, bronze: DataFrame, settings: Settings) -> DataFrame:
    if entity == "customers":
        return typed_customers(bronze, settings)
    rows = bronze.drop(*(c for c in TECHNICAL if c != INGESTED))
    return rows.withColumn("platnost_do", values.day(F.col("platnost_do"))) if entity == "cards" else rows


def flagged_snapshot(entity: str, bronze: DataFrame, settings: Settings) -> DataFrame:
    """Typed rows of a snapshot entity with their quarantine flag.

    Keeps the ingestion time, which ranks two deliveries of one snapshot.
    """
    rules = quality.rules_for(entity, settings)
    return quality.flagged(_typed(entity, bronze, settings), rules, settings)


def clean_snapshot(entity: str, bronze: DataFrame, settings: Settings) -> DataFrame:
    """Published form of :func:`flagged_snapshot`."""
    return without_technical(flagged_snapshot(entity, bronze, settings))


def clean_fact(entity: str, bronze: DataFrame, settings: Settings) -> DataFrame:
    """Typed transactions or balances.

    The date loses the time of day; the documented contract needs it for the
    hour bands, so ``datum_ts`` keeps it for the two transaction tables.
    """
    amount = "balance" if entity == "account_balances" else "amount"
    typed = {amount: values.money(F.col(amount)), "datum": values.day(F.col("datum"))}
    if settings.documented and entity != "account_balances":
        typed["datum_ts"] = values.moment(F.col("datum"))
    return without_technical(bronze.withColumns(typed))


def clean_reference(entity: str, bronze: DataFrame, settings: Settings) -> DataFrame:
    """Reference rows; the newest delivery of each key in the documented contract."""
    rows = bronze
    if settings.documented:
        order = [INGESTED] if INGESTED in bronze.columns else []
        rows = latest_per_key(bronze, [LANDING[entity][0]], order)
    rows = without_technical(rows)
    return _with_branch_address(rows, settings) if entity == "branches" else rows


def _with_branch_address(branches: DataFrame, settings: Settings) -> DataFrame:
    street_line, city, postal = text.address_parts(F.col("adresa"), trimmed=settings.documented)
    street, number = text.trailing_number_street(street_line)
    return branches.withColumns(
        {"zip_code": postal, "mesto": city, "cislo_popisne": number, "ulice": street})


# -- history ------------------------------------------------------------------


def untracked_columns(entity: str, settings: Settings) -> tuple[str, ...]:
    return CLOCK_COLUMNS if entity == "customers" and settings.documented else ()


def history_dimension(entity: str, good: DataFrame, settings: Settings, **options) -> DataFrame:
    """Type 2 history of the good records of a snapshot entity.

    A key has one row per snapshot day once copies are merged, but copies may
    be many, so keys are still checked for size (see :func:`scd2`).
    """
    history = scd2(
        good, HISTORY_KEYS[entity], SNAPSHOT,
        untracked=untracked_columns(entity, settings),
        tie_break=_kept_ingestion(good), **options)
    return with_timestamps(history)


def dimension_from_bronze(entity: str, bronze: DataFrame, settings: Settings, **options) -> DataFrame:
    """Clean, drop quarantined rows and build the history in one plan."""
    good = quality.good_records(flagged_snapshot(entity, bronze, settings))
    return history_dimension(entity, good, settings, **{"counted": bronze} | options)


def _owner_keys(entity: str, settings: Settings) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Columns a current row is unique on, and the rest of the history key.

    The original's history keys of accounts and cards contain the owner, which
    leaves the row of a former owner open beside the new one's. The documented
    contract wants one row per account and card: the one seen last.
    """
    keys = HISTORY_KEYS[entity]
    unique = keys[:1] if settings.documented else keys
    return unique, keys[len(unique):]


def current_dimension(entity: str, history: DataFrame, settings: Settings) -> DataFrame:
    """Open versions of a history, one per owner key."""
    open_rows = current(history)
    unique, rest = _owner_keys(entity, settings)
    return latest_per_key(open_rows, unique, [SNAPSHOT, *rest]) if rest else open_rows


def current_from_log(
    entity: str, good: DataFrame, settings: Settings, columns: Sequence[str] | None = None
) -> DataFrame:
    """The same rows straight from the snapshot log, without validity columns.

    An open version shows what was seen last, so one aggregate replaces the
    windows of the history where nobody asks since when it has been so.
    """
    unique, rest = _owner_keys(entity, settings)
    dated = good.where(F.col(SNAPSHOT).isNotNull())
    latest = latest_per_key(dated, unique, [SNAPSHOT, *rest, *_kept_ingestion(good)], columns)
    return latest.drop(INGESTED)


# -- geography ----------------------------------------------------------------


def geography_hierarchy(branches: DataFrame, cities: DataFrame, regions: DataFrame) -> DataFrame:
    """Region, city and branch in one row per branch.

    Branches without a known city, and cities without a region, are left out.
    """
    region = regions.select("region_id", F.col("nazev").alias("region_name"))
    city = cities.select("city_id", F.col("nazev").alias("city_name"), "region_id")
    branch = branches.select(
        "branch_id",
        F.col("nazev").alias("branch_name"),
        F.col("adresa").alias("branch_address"),
        F.col("ulice").alias("branch_street"),
        F.col("cislo_popisne").alias("branch_street_number"),
        F.col("zip_code").alias("branch_zip_code"),
        F.col("mesto").alias("branch_city_name"),
        "city_id",
    )
    places = branch.join(city, "city_id").join(region, "region_id")
    return places.select(
        *(c for c in branch.columns if c != "city_id"),
        "city_id", "city_name", "region_id", "region_name",
        F.concat_ws("-", "region_id", "city_id", "branch_id").alias("geography_key"),
        F.lit(GEOGRAPHY_LEVEL).alias("geography_level"),
        F.current_timestamp().alias("created_at"),
    )
