"""Column contracts of the landing files and of the published tables.

Fixed values: table and column names are the bank's data contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

RESCUED = "_rescued_data"
SOURCE_FILE = "source_file"
INGESTED = "ingestion_ts"
SNAPSHOT = "snapshot_date"
START = "__START_AT"
END = "__END_AT"
QUARANTINED = "is_quarantined"

#: Columns every cleaned table drops.
TECHNICAL = (RESCUED, SOURCE_FILE, INGESTED)

#: Business columns of each landing entity, in file order; all arrive as text.
LANDING: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id", "jmeno", "prijmeni", "adresa", "email", "rodne_cislo", "stav",
        "tel_cislo", "datum_narozeni", "typ_bydleni", "pracovni_stav", "pohlavi",
        "pocet_clenu_domacnost", "datum_prvniho_otevreni_uctu", "zeme", "prijem",
        "titul_pred", "titul_za", "sum_prm_uspor_12m", "min_atm_amt", "rezident",
        "pocet_nemovitosti",
    ),
    "accounts": (
        "account_id", "customer_id", "typ_uctu", "stav", "mena", "datum_otevreni",
        "datum_uzavreni",
    ),
    "cards": ("card_id", "account_id", "typ_karty", "stav", "platnost_do"),
    "employees": ("employee_id", "jmeno", "prijmeni", "role", "branch_id"),
    "branches": ("branch_id", "nazev", "adresa", "city_id"),
    "cities": ("city_id", "nazev", "region_id"),
    "regions": ("region_id", "nazev"),
    "products": ("product_id", "nazev", "kategorie"),
    "merchants": ("merchant_id", "nazev", "kategorie"),
    "account_balances": ("account_id", "balance", "datum"),
    "card_transactions": (
        "card_transaction_id", "card_id", "merchant_id", "amount", "datum",
        "typ_transakce", "city_id", "region_id",
    ),
    "financial_transactions": (
        "transaction_id", "account_id", "amount", "datum", "typ_transakce", "city_id",
        "region_id",
    ),
}

#: Entities delivered as dated full snapshots.
SNAPSHOT_ENTITIES = ("customers", "accounts", "cards", "employees")

#: Natural key of each history dimension.
HISTORY_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "accounts": ("account_id", "customer_id"),
    "cards": ("card_id", "account_id"),
    "employees": ("employee_id",),
}

#: Customer columns after cleaning, in published order.
CLEAN_CUSTOMER_COLUMNS = (
    "customer_id", "jmeno", "prijmeni", "cela_adresa", "zip_code", "mesto", "ulice",
    "cislo_popisne", "email", "rodne_cislo", "stav", "predcisli", "tel_cislo",
    "datum_narozeni", "typ_bydleni", "pracovni_stav", "pohlavi", "pocet_clenu_domacnost",
    "datum_prvniho_otevreni_uctu", "zeme", "prijem", "titul_pred", "titul_za",
    "sum_prm_uspor_12m", "min_atm_amt", "rezident", "pocet_nemovitosti", "client_age",
    "days_from_open_first_acc", "snapshot_date",
)

#: Enriched transaction columns, in published order.
FACT_COLUMNS = (
    "transaction_id", "transaction_type", "card_id", "account_id", "customer_id",
    "merchant_id", "amount", "transaction_date", "merchant_category", "city_name",
    "region_name", "transaction_value_segment", "transaction_hour",
    "transaction_day_of_week", "transaction_month", "transaction_year", "client_age",
    "customer_income",
)


def landing_schema(entity: str) -> T.StructType:
    """Text schema of one landing entity, with the rescue column at the end."""
    names = (*LANDING[entity], RESCUED)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def bronze_schema(entity: str) -> T.StructType:
    """Schema of the raw table an entity lands in."""
    schema = landing_schema(entity).add(SOURCE_FILE, T.StringType()).add(INGESTED, T.TimestampType())
    return schema.add(SNAPSHOT, T.DateType()) if entity in SNAPSHOT_ENTITIES else schema
