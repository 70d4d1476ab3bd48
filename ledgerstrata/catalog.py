"""The published tables: where each lives, what it reads, how it is built."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .config import Settings
from .operators.quality import bad_records, good_records
from .plans import gold, silver
from .schemas import LANDING, QUARANTINED, SNAPSHOT, SNAPSHOT_ENTITIES

Inputs = Mapping[str, DataFrame]
Builder = Callable[[Inputs, Settings], DataFrame]

FACTS = "fact_transaction_analytics_simplified"
METRICS = "table_basic_business_metrics"
SUMMARY = "table_customer_summary"
PERIOD = ("transaction_year", "transaction_month")


@dataclass(frozen=True)
class Table:
    """One table of the lakehouse. Raw tables have no builder: files feed them."""

    name: str
    layer: str
    comment: str
    inputs: tuple[str, ...] = ()
    build: Builder | None = None
    partition_by: tuple[str, ...] = ()
    properties: Mapping[str, str] = field(default_factory=dict)

    def partitions(self, settings: Settings) -> tuple[str, ...]:
        """The original names a period for the metrics but does not produce it."""
        return () if self.name == METRICS and not settings.documented else self.partition_by


def _tables() -> list[Table]:
    tables = [
        Table(f"{entity}_bronze", "bronze", f"Raw {entity} as delivered",
              partition_by=(SNAPSHOT,) if entity in SNAPSHOT_ENTITIES else ())
        for entity in LANDING
    ]

    def add(name, layer, comment, inputs, build, partition_by=()):
        tables.append(Table(name, layer, comment, tuple(inputs), build, partition_by, {"quality": layer}))

    for entity in SNAPSHOT_ENTITIES:
        raw, clean = f"{entity}_bronze", f"{entity}_clean_silver"
        add(clean, "silver", f"Typed {entity} with their quarantine flag", [raw],
            lambda t, s, e=entity, r=raw: silver.clean_snapshot(e, t[r], s), (QUARANTINED,))
        add(f"{entity}_clean_good_records", "silver", f"{entity} that pass every rule", [clean],
            lambda t, s, c=clean: good_records(t[c]))
        add(f"{entity}_clean_bad_records", "silver", f"{entity} set aside", [clean],
            lambda t, s, c=clean: bad_records(t[c]))
        # Read from the raw table, which still has the load time that ranks two
        # deliveries of one snapshot; the rows are those of the good records.
        add(f"dim_{entity}", "silver", f"Type 2 history of {entity}", [raw],
            lambda t, s, e=entity, r=raw: silver.dimension_from_bronze(e, t[r], s))

    for entity in ("account_balances", "card_transactions", "financial_transactions"):
        add(f"{entity}_silver", "silver", f"Typed {entity}", [f"{entity}_bronze"],
            lambda t, s, e=entity: silver.clean_fact(e, t[f"{e}_bronze"], s))
    for entity in ("merchants", "products", "regions", "cities", "branches"):
        add(f"{entity}_silver", "silver", f"Current {entity}", [f"{entity}_bronze"],
            lambda t, s, e=entity: silver.clean_reference(e, t[f"{e}_bronze"], s))
    add("dim_geography_hierarchy", "silver", "Region, city and branch in one row per branch",
        ["branches_silver", "cities_silver", "regions_silver"],
        lambda t, s: silver.geography_hierarchy(
            t["branches_silver"], t["cities_silver"], t["regions_silver"]))

    add(FACTS, "gold", "Card and account transactions with customer and place",
        ["card_transactions_silver", "financial_transactions_silver", "dim_customers", "dim_accounts",
         "dim_cards", "cities_silver", "regions_silver"], _facts, PERIOD)
    add(METRICS, "gold", "Transactions with the segments reports group by", [FACTS],
        lambda t, s: gold.business_metrics(t[FACTS], s), PERIOD)
    add(SUMMARY, "gold", "Current customers with age group and tier", ["dim_customers"],
        lambda t, s: gold.customer_summary(silver.current_dimension("customers", t["dim_customers"], s)))
    return tables


def _facts(tables: Inputs, settings: Settings) -> DataFrame:
    now = {e: silver.current_dimension(e, tables[f"dim_{e}"], settings)
           for e in ("customers", "accounts", "cards")}
    owners = gold.account_owners(now["accounts"], now["customers"])
    return gold.transaction_facts(
        tables["card_transactions_silver"], tables["financial_transactions_silver"],
        owners, gold.card_owners(now["cards"], owners),
        tables["cities_silver"], tables["regions_silver"], settings)


#: All tables in an order in which inputs come first.
TABLES: dict[str, Table] = {table.name: table for table in _tables()}
