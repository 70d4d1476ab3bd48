"""The benchmark tables in the roles of the bank's raw tables.

Each entity is one projection into the shape of its raw table: identifiers and
free text as strings, dated snapshots with an ingestion time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import LANDING

#: Role of each entity: source table and column expressions.
_PROJECTIONS: dict[str, tuple[str, dict[str, str]]] = {
    # One account per customer and order priority, seen again with each order.
    "accounts": ("orders", {
        "account_id": "concat(o_custkey, '-', o_orderpriority)",
        "customer_id": "string(o_custkey)",
        "typ_uctu": "o_orderpriority",
        "stav": "o_orderstatus",
        "mena": "CASE WHEN o_orderkey % 41 <> 0 THEN 'CZK' END",
        "datum_otevreni": "'1995-01-01'",
        "datum_uzavreni": "string(NULL)",
        "snapshot_date": "date(o_orderdate)",
        "ingestion_ts": "timestamp_seconds(o_orderkey)",
    }),
    # One card per order, drawn on the order's account.
    "cards": ("orders", {
        "card_id": "string(o_orderkey)",
        "account_id": "concat(o_custkey, '-', o_orderpriority)",
        "typ_karty": "o_orderpriority",
        "stav": "o_orderstatus",
        "platnost_do": "string(date_add(date(o_orderdate), 1000))",
        "snapshot_date": "date(o_orderdate)",
        "ingestion_ts": "timestamp_seconds(o_orderkey)",
    }),
    # Speakers of a conversation as one employee who changes roles by turn.
    "employees": ("conversations", {
        "employee_id": "string(conv_id)",
        "jmeno": "'E'",
        "prijmeni": "CASE WHEN turn <> 3 THEN concat('Surname ', conv_id) END",
        "role": "role",
        "branch_id": "string(conv_id % 10)",
        "snapshot_date": "date_add(DATE'2024-01-01', int(turn))",
        "ingestion_ts": "timestamp_seconds(turn)",
    }),
    "regions": ("region", {"region_id": "string(r_regionkey)", "nazev": "r_name"}),
    "cities": ("nation", {
        "city_id": "string(n_nationkey)", "nazev": "n_name", "region_id": "string(n_regionkey)"}),
    "branches": ("supplier", {
        "branch_id": "string(s_suppkey)",
        "nazev": "s_name",
        "adresa": "concat('28. street', CASE s_suppkey % 3 WHEN 0 THEN concat(' ', s_suppkey, 'a / 3B')"
                  " WHEN 1 THEN concat(' ', s_suppkey) ELSE '' END,"
                  " ', Town ', s_nationkey, ', ', 10000 + s_suppkey)",
        "city_id": "string(s_nationkey)",
    }),
    "merchants": ("part", {"merchant_id": "string(p_partkey)", "nazev": "p_name", "kategorie": "p_type"}),
    "products": ("part", {"product_id": "string(p_partkey)", "nazev": "p_name", "kategorie": "p_brand"}),
    # Line items as payments by the order's card; some places are unknown.
    "card_transactions": ("lineitem", {
        "card_transaction_id": "concat_ws('-', l_orderkey, l_partkey, l_linenumber)",
        "card_id": "string(l_orderkey)",
        "merchant_id": "string(l_partkey)",
        "amount": "l_extendedprice",
        "datum": "l_shipdate",
        "typ_transakce": "l_returnflag",
        "city_id": "string(l_suppkey % 30)",
        "region_id": "string(l_suppkey % 7)",
    }),
    # Events as transfers on the user's urgent account; some have none.
    "financial_transactions": ("events", {
        "transaction_id": "string(event_id)",
        "account_id": "concat(user_id, '-1-URGENT')",
        "amount": "value",
        "datum": "ts",
        "typ_transakce": "event_type",
        "city_id": "string(event_id % 30)",
        "region_id": "string(event_id % 7)",
    }),
}

#: A customer's fixed attributes, from the customer table.
_PERSON = {
    "customer_id": "string(c_custkey)",
    "jmeno": "c_mktsegment",
    "prijmeni": "c_name",
    "adresa": "concat('Street ', c_custkey % 300, ', City ', c_nationkey, ', ', 10000 + c_custkey % 90000)",
    "email": "concat(lower(c_name), '@mail.test')",
    "rodne_cislo": "concat(lpad(string(c_custkey), 9, '0'), '/', c_custkey % 10)",
    "tel_cislo": "CASE c_custkey % 3 WHEN 0 THEN concat('+420 ', lpad(string(c_custkey), 9, '0'))"
                 " WHEN 1 THEN lpad(string(c_custkey), 9, '0') END",
    "datum_narozeni": "CASE WHEN c_custkey % 53 = 0 THEN 'unknown'"
                      " ELSE concat(1920 + c_custkey % 90, '-01-15') END",
    "typ_bydleni": "CASE WHEN c_custkey % 2 = 0 THEN 'own' ELSE 'rent' END",
    "pohlavi": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "pocet_clenu_domacnost": "concat(1 + c_custkey % 6, '.0')",
    "datum_prvniho_otevreni_uctu": "concat(1990 + c_custkey % 30, '-03-15')",
    "zeme": "concat('Country ', c_nationkey % 5)",
    "titul_pred": "string(NULL)",
    "titul_za": "string(NULL)",
    "sum_prm_uspor_12m": "string(c_acctbal)",
    "min_atm_amt": "'500.00'",
    "rezident": "'ano'",
    "pocet_nemovitosti": "string(c_custkey % 4)",
}


class Roles:
    """Raw tables of the bank, made from the benchmark tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A benchmark table; its footer is read once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def raw(self, entity: str) -> DataFrame:
        if entity == "customers":
            return self._customers()
        if entity == "account_balances":
            return self._balances()
        source, columns = _PROJECTIONS[entity]
        return self.table(source).selectExpr(*(f"{sql} AS {name}" for name, sql in columns.items()))

    def _customers(self) -> DataFrame:
        """Every customer once at the start, and again with each order.

        An order stands for a later snapshot of its customer: status, job and
        income are the order's status, priority and price.
        """
        person = self.table("customer")
        start = person.selectExpr(
            "c_custkey", "'N' AS stav", "'0-START' AS pracovni_stav",
            "string(CAST(c_acctbal * 10 AS DECIMAL(20,2))) AS prijem",
            "DATE'1990-01-01' AS snapshot_date", "timestamp_seconds(0) AS ingestion_ts")
        later = self.table("orders").selectExpr(
            "o_custkey AS c_custkey", "o_orderstatus AS stav", "o_orderpriority AS pracovni_stav",
            "string(CAST(o_totalprice / 5 AS DECIMAL(20,2))) AS prijem",
            "date(o_orderdate) AS snapshot_date", "timestamp_seconds(o_orderkey) AS ingestion_ts")
        columns = [f"{_PERSON[c]} AS {c}" if c in _PERSON else c for c in LANDING["customers"]]
        return start.unionByName(later).join(person, "c_custkey").selectExpr(
            *columns, "snapshot_date", "ingestion_ts")

    def _balances(self) -> DataFrame:
        """Value moved per user and day as that day's balance."""
        daily = self.table("events").selectExpr(
            "user_id", "date(ts) AS day", "CAST(value AS DECIMAL(20,2)) AS value")
        return daily.groupBy("user_id", "day").agg({"value": "sum"}).selectExpr(
            "string(user_id) AS account_id", "string(`sum(value)`) AS balance", "string(day) AS datum")
