"""Named row rules, their pass counts, and routing of the rows that fail."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import Settings
from ..schemas import QUARANTINED, SNAPSHOT

Rules = Mapping[str, str]


def rules_for(entity: str, settings: Settings) -> dict[str, str]:
    """Row rules of an entity as SQL conditions."""
    # Rule names and conditions of the data contract.
    return {
        "customers": {
            "valid_customer_id": "customer_id is not null",
            "valid_datum_narozeni": f"year(datum_narozeni) > year({settings.as_of_sql}) - 100",
        },
        "accounts": {
            "valid_account": "typ_uctu is not null and stav is not null",
            "valid_mena": "mena is not null",
        },
        "cards": {
            "valid_card": "card_id is not null and account_id is not null and typ_karty is not null",
        },
        "employees": {
            "valid_employee": "employee_id is not null and prijmeni is not null and role is not null",
        },
    }[entity]


def fails(rules: Rules) -> Column:
    """True when some rule is false; NULL when none is false but some is NULL."""
    return F.expr("NOT (" + " AND ".join(f"({rule})" for rule in rules.values()) + ")")


def quarantine_flag(rules: Rules, settings: Settings, sequence: str | None = None) -> Column:
    """Flag of the rows to set aside.

    The documented contract sends every row to exactly one side, so a rule that
    cannot be decided, or a missing history sequence, quarantines the row. The
    original leaves such rows on neither side (NULL flag).
    """
    flag = fails(rules)
    if not settings.documented:
        return flag
    flag = F.coalesce(flag, F.lit(True))
    return flag | F.col(sequence).isNull() if sequence else flag


def flagged(df: DataFrame, rules: Rules, settings: Settings, sequence: str | None = SNAPSHOT) -> DataFrame:
    present = sequence if sequence in df.columns else None
    return df.withColumn(QUARANTINED, quarantine_flag(rules, settings, present))


def good_records(clean: DataFrame) -> DataFrame:
    return clean.where(~F.col(QUARANTINED)).drop(QUARANTINED)


def bad_records(clean: DataFrame) -> DataFrame:
    return clean.where(F.col(QUARANTINED)).drop(QUARANTINED)


def counters(rules: Rules) -> list[Column]:
    held = {name: F.coalesce(F.expr(rule), F.lit(False)) for name, rule in rules.items()}
    return [
        *(F.count_if(ok).alias(f"{name}__passed") for name, ok in held.items()),
        *(F.count_if(~ok).alias(f"{name}__failed") for name, ok in held.items()),
    ]


def observed(df: DataFrame, rules: Rules, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, counting passes and failures per rule as they flow by."""
    observation = Observation(name)
    return df.observe(observation, *counters(rules)), observation


def rule_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that pass and fail each rule, counted in one pass; no row is dropped."""
    counts = df.agg(*counters(rules))
    rows = ", ".join(f"'{r}', {r}__passed, {r}__failed" for r in rules)
    return counts.select(F.expr(f"stack({len(rules)}, {rows}) AS (rule, passed_rows, failed_rows)"))
