"""The same questions as SQL on the benchmark tables, for an independent check."""

from __future__ import annotations

from collections.abc import Sequence

from ..schemas import CLEAN_CUSTOMER_COLUMNS

AS_OF = "DATE '2024-06-30'"
MIN_BIRTH_YEAR = 1924


def _case(value: str, steps: Sequence[tuple[str, str]], default: str) -> str:
    whens = " ".join(f"WHEN {value} {test} THEN '{label}'" for test, label in steps)
    return f"CASE {whens} ELSE '{default}' END"


def _value(x: str) -> str:
    return _case(x, [("> 1000", "High Value"), ("> 100", "Medium Value")], "Low Value")


def _income(x: str) -> str:
    return _case(x, [("> 50000", "High Income"), ("> 25000", "Medium Income")], "Low Income")


def _tier(x: str) -> str:
    return _case(x, [("> 80000", "Premium"), ("> 50000", "Gold"), ("> 25000", "Silver")], "Standard")


def _age(x: str) -> str:
    return _case(x, [("< 25", "Young"), ("< 45", "Middle-aged"), ("< 65", "Mature")], "Senior")


def _time(x: str) -> str:
    return _case(x, [("BETWEEN 9 AND 17", "Business Hours"), ("BETWEEN 18 AND 23", "Evening")], "Night")


def _day(x: str) -> str:
    return _case(x, [("IN (1, 7)", "Weekend")], "Weekday")


def scd2(source: str, keys: str, seq: str, tracked: str, tie: str, start: str, end: str,
         kind: str = "", where: str = "TRUE") -> str:
    """History of a log: number the runs of equal rows, take the last row of each."""
    cast = f"::{kind}" if kind else ""
    key_list = ", ".join(keys.split())
    track_list = ", ".join(tracked.split())
    return f"""
      SELECT * EXCLUDE (state, opens, run, first_seen, {tie}),
             first_seen{cast} AS {start},
             (lead(first_seen) OVER (PARTITION BY {key_list} ORDER BY first_seen)){cast} AS {end}
      FROM (
        SELECT *, min({seq}) OVER (PARTITION BY {key_list}, run) AS first_seen
        FROM (
          SELECT *, sum(opens) OVER (PARTITION BY {key_list} ORDER BY {seq}) AS run
          FROM (
            SELECT *, CASE WHEN lag({seq}) OVER w IS NULL OR lag(state) OVER w IS DISTINCT FROM state
                           THEN 1 ELSE 0 END AS opens
            FROM (
              SELECT *, row({track_list}) AS state FROM {source} WHERE {where}
              QUALIFY row_number() OVER (PARTITION BY {key_list}, {seq} ORDER BY {tie} DESC) = 1)
            WINDOW w AS (PARTITION BY {key_list} ORDER BY {seq})))
        QUALIFY row_number() OVER (PARTITION BY {key_list}, run ORDER BY {seq} DESC) = 1)"""


def _bank(documented: bool = True) -> dict[str, str]:
    """Named sub-queries from the benchmark tables up to the marts, in order."""
    trim = (lambda x: f"trim({x})") if documented else (lambda x: x)
    street = "split_part(adresa, ',', 1)"
    number = f"split_part({street}, ' ', 2)" if documented else "CAST(NULL AS VARCHAR)"
    rule = f"NOT (customer_id IS NOT NULL AND year(datum_narozeni) > {MIN_BIRTH_YEAR})"
    flag = f"coalesce({rule}, TRUE)" if documented else rule
    clock = {"client_age", "days_from_open_first_acc"} if documented else set()
    tracked = " ".join(c for c in CLEAN_CUSTOMER_COLUMNS
                       if c not in {"customer_id", "snapshot_date"} | clock)
    open_accounts = "SELECT * FROM dim_accounts WHERE __END_AT IS NULL"
    open_cards = "SELECT * FROM dim_cards WHERE __END_AT IS NULL"
    if documented:
        open_accounts += (" QUALIFY row_number() OVER (PARTITION BY account_id "
                          "ORDER BY snapshot_date DESC, customer_id DESC) = 1")
        open_cards += (" QUALIFY row_number() OVER (PARTITION BY card_id "
                       "ORDER BY snapshot_date DESC, account_id DESC) = 1")
    hour = "hour(t.ts)" if documented else "0"

    def facts(kind: str, tx: str, card: str, merchant: str, join: str, source: str) -> str:
        return f"""
          SELECT {tx} AS transaction_id, '{kind}' AS transaction_type, {card} AS card_id,
                 o.account_id, o.customer_id, {merchant} AS merchant_id, t.amount,
                 t.datum AS transaction_date, t.typ_transakce AS merchant_category,
                 coalesce(c.n_name, 'Unknown') AS city_name,
                 coalesce(r.r_name, 'Unknown') AS region_name,
                 {_value('t.amount')} AS transaction_value_segment,
                 CAST({hour} AS INTEGER) AS transaction_hour,
                 CAST(dayofweek(t.datum) + 1 AS INTEGER) AS transaction_day_of_week,
                 CAST(month(t.datum) AS INTEGER) AS transaction_month,
                 CAST(year(t.datum) AS INTEGER) AS transaction_year,
                 o.client_age, o.prijem AS customer_income
          FROM {source} t JOIN {join}
          LEFT JOIN nation c ON CAST(c.n_nationkey AS VARCHAR) = t.city_id
          LEFT JOIN region r ON CAST(r.r_regionkey AS VARCHAR) = t.region_id"""

    period = "transaction_year, transaction_month," if documented else ""
    return {
        "log_customers": """
          SELECT p.c_custkey AS k, CAST(p.c_custkey AS VARCHAR) AS customer_id,
                 p.c_mktsegment AS jmeno, p.c_name AS prijmeni,
                 'Street ' || (p.c_custkey % 300) || ', City ' || p.c_nationkey || ', '
                   || (10000 + p.c_custkey % 90000) AS adresa,
                 lower(p.c_name) || '@mail.test' AS email,
                 lpad(CAST(p.c_custkey AS VARCHAR), 9, '0') || '/' || (p.c_custkey % 10) AS rodne_cislo,
                 l.stav,
                 CASE p.c_custkey % 3 WHEN 0 THEN '+420 ' || lpad(CAST(p.c_custkey AS VARCHAR), 9, '0')
                      WHEN 1 THEN lpad(CAST(p.c_custkey AS VARCHAR), 9, '0') END AS phone,
                 TRY_CAST(CASE WHEN p.c_custkey % 53 = 0 THEN 'unknown'
                      ELSE (1920 + p.c_custkey % 90) || '-01-15' END AS DATE) AS datum_narozeni,
                 CASE WHEN p.c_custkey % 2 = 0 THEN 'own' ELSE 'rent' END AS typ_bydleni,
                 l.pracovni_stav,
                 CASE WHEN p.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS pohlavi,
                 CAST(1 + p.c_custkey % 6 AS INTEGER) AS pocet_clenu_domacnost,
                 CAST((1990 + p.c_custkey % 30) || '-03-15' AS DATE) AS datum_prvniho_otevreni_uctu,
                 'Country ' || (p.c_nationkey % 5) AS zeme, l.prijem,
                 CAST(NULL AS VARCHAR) AS titul_pred, CAST(NULL AS VARCHAR) AS titul_za,
                 CAST(p.c_acctbal AS DECIMAL(20,2)) AS sum_prm_uspor_12m,
                 CAST(500 AS DECIMAL(20,2)) AS min_atm_amt, 'ano' AS rezident,
                 CAST(p.c_custkey % 4 AS INTEGER) AS pocet_nemovitosti,
                 l.snapshot_date, l.ord
          FROM customer p JOIN (
            SELECT c_custkey, 'N' AS stav, '0-START' AS pracovni_stav,
                   CAST(c_acctbal * 10 AS DECIMAL(20,2)) AS prijem,
                   DATE '1990-01-01' AS snapshot_date, 0 AS ord FROM customer
            UNION ALL
            SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(o_totalprice / 5 AS DECIMAL(20,2)),
                   CAST(o_orderdate AS DATE), o_orderkey FROM orders
          ) l ON l.c_custkey = p.c_custkey""",
        "clean_customers": f"""
          SELECT *, {flag} AS is_quarantined FROM (
            SELECT customer_id, jmeno, prijmeni, adresa AS cela_adresa,
                   {trim("split_part(adresa, ',', 3)")} AS zip_code,
                   {trim("split_part(adresa, ',', 2)")} AS mesto,
                   split_part({street}, ' ', 1) AS ulice, {number} AS cislo_popisne,
                   email, rodne_cislo, stav,
                   CASE WHEN length(replace(phone, ' ', '')) > 9 THEN split_part(phone, ' ', 1) END AS predcisli,
                   right(replace(phone, ' ', ''), 9) AS tel_cislo,
                   datum_narozeni, typ_bydleni, pracovni_stav, pohlavi, pocet_clenu_domacnost,
                   datum_prvniho_otevreni_uctu, zeme, prijem, titul_pred, titul_za,
                   sum_prm_uspor_12m, min_atm_amt, rezident, pocet_nemovitosti,
                   CAST(year({AS_OF}) - year(datum_narozeni) AS INTEGER) AS client_age,
                   CAST(date_diff('day', datum_prvniho_otevreni_uctu, {AS_OF}) AS INTEGER)
                     AS days_from_open_first_acc,
                   snapshot_date, ord
            FROM log_customers)""",
        "good_customers": "SELECT * EXCLUDE (is_quarantined) FROM clean_customers WHERE NOT is_quarantined",
        "dim_customers": scd2("good_customers", "customer_id", "snapshot_date", tracked, "ord",
                              "__START_AT", "__END_AT", "TIMESTAMP"),
        "clean_accounts": """
          SELECT o_custkey || '-' || o_orderpriority AS account_id,
                 CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS typ_uctu,
                 o_orderstatus AS stav, CASE WHEN o_orderkey % 41 <> 0 THEN 'CZK' END AS mena,
                 '1995-01-01' AS datum_otevreni, CAST(NULL AS VARCHAR) AS datum_uzavreni,
                 CAST(o_orderdate AS DATE) AS snapshot_date, o_orderkey AS ord,
                 o_orderkey % 41 = 0 AS is_quarantined FROM orders""",
        "good_accounts": "SELECT * EXCLUDE (is_quarantined) FROM clean_accounts WHERE NOT is_quarantined",
        "dim_accounts": scd2("good_accounts", "account_id customer_id", "snapshot_date",
                             "typ_uctu stav mena datum_otevreni datum_uzavreni", "ord",
                             "__START_AT", "__END_AT", "TIMESTAMP"),
        "log_cards": """
          SELECT CAST(o_orderkey AS VARCHAR) AS card_id, o_custkey || '-' || o_orderpriority AS account_id,
                 o_orderpriority AS typ_karty, o_orderstatus AS stav,
                 CAST(o_orderdate AS DATE) + 1000 AS platnost_do,
                 CAST(o_orderdate AS DATE) AS snapshot_date, o_orderkey AS ord FROM orders""",
        "dim_cards": scd2("log_cards", "card_id account_id", "snapshot_date",
                          "typ_karty stav platnost_do", "ord", "__START_AT", "__END_AT", "TIMESTAMP"),
        "owners": f"""
          SELECT a.account_id, u.customer_id, u.client_age, u.prijem
          FROM ({open_accounts}) a
          JOIN dim_customers u ON u.customer_id = a.customer_id AND u.__END_AT IS NULL""",
        "card_owners": f"""
          SELECT k.card_id, o.* FROM ({open_cards}) k JOIN owners o ON o.account_id = k.account_id""",
        "tx_card": """
          SELECT l_orderkey || '-' || l_partkey || '-' || l_linenumber AS card_transaction_id,
                 CAST(l_orderkey AS VARCHAR) AS card_id, CAST(l_partkey AS VARCHAR) AS merchant_id,
                 CAST(l_extendedprice AS DECIMAL(20,2)) AS amount, CAST(l_shipdate AS DATE) AS datum,
                 l_shipdate AS ts, l_returnflag AS typ_transakce,
                 CAST(l_suppkey % 30 AS VARCHAR) AS city_id, CAST(l_suppkey % 7 AS VARCHAR) AS region_id
          FROM lineitem""",
        "tx_financial": """
          SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id || '-1-URGENT' AS account_id,
                 CAST(value AS DECIMAL(20,2)) AS amount, CAST(ts AS DATE) AS datum, ts,
                 event_type AS typ_transakce, CAST(event_id % 30 AS VARCHAR) AS city_id,
                 CAST(event_id % 7 AS VARCHAR) AS region_id FROM events""",
        "facts_card": facts("CARD", "t.card_transaction_id", "t.card_id", "t.merchant_id",
                            "card_owners o ON o.card_id = t.card_id", "tx_card"),
        "facts_financial": facts("FINANCIAL", "t.transaction_id", "CAST(NULL AS VARCHAR)",
                                 "CAST(NULL AS VARCHAR)", "owners o ON o.account_id = t.account_id",
                                 "tx_financial"),
        "facts": "SELECT * FROM facts_card UNION ALL SELECT * FROM facts_financial",
        "metrics": f"""
          SELECT transaction_id, transaction_type, customer_id, amount, transaction_date,
                 transaction_value_segment, city_name, region_name, {period}
                 {_time('transaction_hour')} AS time_period,
                 {_day('transaction_day_of_week')} AS day_type,
                 {_income('customer_income')} AS income_segment
          FROM facts""",
        "summary": f"""
          SELECT customer_id, jmeno, prijmeni, client_age, prijem AS annual_income, pohlavi AS gender,
                 pracovni_stav AS employment_status, mesto AS city, zeme AS country,
                 {_age('client_age')} AS age_group, {_tier('prijem')} AS customer_tier
          FROM dim_customers WHERE __END_AT IS NULL""",
        "branches": """
          SELECT CAST(s_suppkey AS VARCHAR) AS branch_id, s_name AS nazev,
                 '28. street' || CASE s_suppkey % 3 WHEN 0 THEN ' ' || s_suppkey || 'a / 3B'
                                 WHEN 1 THEN ' ' || s_suppkey ELSE '' END
                   || ', Town ' || s_nationkey || ', ' || (10000 + s_suppkey) AS adresa,
                 CAST(s_nationkey AS VARCHAR) AS city_id,
                 CAST(10000 + s_suppkey AS VARCHAR) AS zip_code, 'Town ' || s_nationkey AS mesto,
                 CASE s_suppkey % 3 WHEN 0 THEN s_suppkey || 'a / 3B'
                      WHEN 1 THEN CAST(s_suppkey AS VARCHAR) ELSE '' END AS cislo_popisne,
                 '28. street' AS ulice
          FROM supplier""",
        "geography": """
          SELECT b.branch_id, b.nazev AS branch_name, b.adresa AS branch_address,
                 b.ulice AS branch_street, b.cislo_popisne AS branch_street_number,
                 b.zip_code AS branch_zip_code, b.mesto AS branch_city_name, b.city_id,
                 n.n_name AS city_name, CAST(r.r_regionkey AS VARCHAR) AS region_id,
                 r.r_name AS region_name,
                 r.r_regionkey || '-' || b.city_id || '-' || b.branch_id AS geography_key,
                 'Branch' AS geography_level
          FROM branches b JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = b.city_id
          JOIN region r ON r.r_regionkey = n.n_regionkey""",
        "balances": """
          SELECT CAST(user_id AS VARCHAR) AS account_id,
                 CAST(sum(CAST(value AS DECIMAL(20,2))) AS DECIMAL(20,2)) AS balance,
                 CAST(ts AS DATE) AS datum
          FROM events GROUP BY user_id, CAST(ts AS DATE)""",
        "clean_employees": """
          SELECT CAST(conv_id AS VARCHAR) AS employee_id, 'E' AS jmeno,
                 CASE WHEN turn <> 3 THEN 'Surname ' || conv_id END AS prijmeni, role,
                 CAST(conv_id % 10 AS VARCHAR) AS branch_id,
                 DATE '2024-01-01' + CAST(turn AS INTEGER) AS snapshot_date, turn AS ord
          FROM conversations""",
        "dim_employees": scd2("clean_employees", "employee_id", "snapshot_date",
                              "jmeno prijmeni role branch_id", "ord", "__START_AT", "__END_AT",
                              "TIMESTAMP", "prijmeni IS NOT NULL AND role IS NOT NULL"),
        "event_history": scd2("(SELECT user_id, ts, event_type, 0 AS ord FROM events)", "user_id", "ts",
                              "event_type", "ord", "start_at", "end_at"),
        "shared_accounts": scd2(
            """(SELECT o_orderpriority || '-' || (o_custkey % 100) AS account_id,
                       CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS stav,
                       CAST(o_orderdate AS DATE) AS snapshot_date, o_orderkey AS ord FROM orders)""",
            "account_id customer_id", "snapshot_date", "stav", "ord", "__START_AT", "__END_AT", "TIMESTAMP"),
    }


def _ask(select: str, documented: bool = True) -> str:
    """The question with the named sub-queries it can refer to."""
    parts = _bank(documented)
    named = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {named}\n{select}"


_VOLUME = "CAST(sum(amount) AS DECIMAL(38,2)) AS total_volume"
_ADDRESS = """SELECT DISTINCT customer_id, snapshot_date, cela_adresa, ulice, cislo_popisne, mesto, zip_code
              FROM clean_customers"""
_FLAG = "SELECT customer_id, snapshot_date, datum_narozeni, is_quarantined FROM clean_customers"


def _rule_counts(entity: str, rule: str, source: str, test: str) -> str:
    return f"""SELECT '{entity}' AS entity, '{rule}' AS rule,
                      count(*) FILTER (WHERE {test}) AS passed_rows,
                      count(*) FILTER (WHERE NOT coalesce({test}, FALSE)) AS failed_rows FROM {source}"""


ORACLE: dict[str, str] = {
    "band_value": f"SELECT event_id, {_value('value * 5')} AS value_segment FROM events",
    "band_time": f"SELECT event_id, {_time('hour(ts)')} AS time_period FROM events",
    "band_daytype": f"SELECT event_id, {_day('(dayofweek(ts) + 1)')} AS day_type FROM events",
    "band_income": f"SELECT c_custkey, {_income('c_acctbal * 10')} AS income_segment FROM customer",
    "band_age": f"SELECT c_custkey, {_age('(2024 - (1930 + c_custkey % 90))')} AS age_group FROM customer",
    "band_tier": f"SELECT c_custkey, {_tier('c_acctbal * 10')} AS customer_tier FROM customer",
    "calendar_parts": """
      SELECT event_id, CAST(hour(ts) AS INTEGER) AS transaction_hour,
             CAST(dayofweek(ts) + 1 AS INTEGER) AS transaction_day_of_week,
             CAST(month(ts) AS INTEGER) AS transaction_month,
             CAST(year(ts) AS INTEGER) AS transaction_year FROM events""",
    "address_split": _ask(_ADDRESS),
    "address_split_as_written": _ask(_ADDRESS, documented=False),
    "branch_address": _ask("SELECT * FROM branches"),
    "phone_normalise": _ask("SELECT DISTINCT customer_id, predcisli, tel_cislo FROM clean_customers"),
    "typed_casts": _ask("""
      SELECT customer_id, snapshot_date, datum_narozeni, datum_prvniho_otevreni_uctu, prijem,
             sum_prm_uspor_12m, min_atm_amt, pocet_clenu_domacnost, pocet_nemovitosti FROM clean_customers"""),
    "age_tenure_asof": _ask(
        "SELECT DISTINCT customer_id, client_age, days_from_open_first_acc FROM clean_customers"),
    "snapshot_date_from_path": """
      SELECT o_orderkey, 'file:/x/landing_data/customers/' || CASE
               WHEN o_orderkey % 11 = 0 THEN '2024.13.40' WHEN o_orderkey % 7 = 0 THEN 'undated'
               ELSE strftime(o_orderdate, '%Y.%m.%d') END || '/part.csv' AS source_file,
             CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0
                  THEN CAST(o_orderdate AS DATE) END AS snapshot_date FROM orders""",
    "card_transactions_silver": _ask("SELECT * RENAME (ts AS datum_ts) FROM tx_card"),
    "financial_transactions_silver": _ask("SELECT * RENAME (ts AS datum_ts) FROM tx_financial"),
    "account_balances_silver": _ask("SELECT * FROM balances"),
    "reference_tables": """
      SELECT 'merchants' AS entity, CAST(p_partkey AS VARCHAR) AS id, p_name AS nazev, p_type AS kategorie FROM part
      UNION ALL SELECT 'products', CAST(p_partkey AS VARCHAR), p_name, p_brand FROM part
      UNION ALL SELECT 'cities', CAST(n_nationkey AS VARCHAR), n_name, NULL FROM nation
      UNION ALL SELECT 'regions', CAST(r_regionkey AS VARCHAR), r_name, NULL FROM region""",
    "quality_metrics": _ask(" UNION ALL ".join([
        _rule_counts("customers", "valid_customer_id", "clean_customers", "customer_id IS NOT NULL"),
        _rule_counts("customers", "valid_datum_narozeni", "clean_customers",
                     f"year(datum_narozeni) > {MIN_BIRTH_YEAR}"),
        _rule_counts("accounts", "valid_account", "clean_accounts",
                     "(typ_uctu IS NOT NULL AND stav IS NOT NULL)"),
        _rule_counts("accounts", "valid_mena", "clean_accounts", "mena IS NOT NULL"),
        _rule_counts("cards", "valid_card", "log_cards",
                     "(card_id IS NOT NULL AND account_id IS NOT NULL AND typ_karty IS NOT NULL)"),
        _rule_counts("employees", "valid_employee", "clean_employees",
                     "(employee_id IS NOT NULL AND prijmeni IS NOT NULL AND role IS NOT NULL)"),
    ])),
    "quarantine_flag": _ask(_FLAG),
    "quarantine_reference_nulls": _ask(_FLAG, documented=False),
    "good_records": _ask("SELECT * EXCLUDE (ord) FROM good_accounts"),
    "bad_records": _ask(
        "SELECT * EXCLUDE (ord, is_quarantined) FROM clean_accounts WHERE is_quarantined"),
    "scd2_history": _ask("SELECT * FROM event_history"),
    "scd2_string_sequence": scd2(
        """(SELECT o_custkey, CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS seen_on, o_orderkey, o_orderpriority
            FROM orders)""", "o_custkey", "seen_on", "o_orderpriority", "o_orderkey", "start_at", "end_at"),
    "asof_join_one_moment": f"""
      WITH v AS ({scd2("(SELECT o_custkey % 50 AS user_id, o_orderdate, o_orderkey, o_orderpriority FROM orders)",
                       "user_id", "o_orderdate", "o_orderpriority", "o_orderkey", "start_at", "end_at")}),
      f AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id % 50 END AS user_id,
                   CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '1998-01-01'
                        ELSE ts - to_days(CAST(8300 + event_id % 2400 AS INTEGER)) END AS happened_at FROM events)
      SELECT f.user_id, f.event_id, f.happened_at, v.o_orderpriority, v.start_at
      FROM f JOIN v ON v.user_id = f.user_id AND v.start_at <= f.happened_at
        AND (v.end_at IS NULL OR f.happened_at < v.end_at)""",
    "scd2_current": _ask("SELECT * EXCLUDE (end_at) FROM event_history WHERE end_at IS NULL"),
    "scd2_untracked": scd2(
        """(SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority,
                   CAST(o_totalprice AS DECIMAL(20,2)) AS o_totalprice FROM orders)""",
        "o_custkey", "o_orderdate", "o_orderpriority", "o_orderkey", "start_at", "end_at"),
    "scd1_latest": """
      SELECT user_id, ts, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""",
    "asof_lookup": _ask("""
      SELECT * FROM event_history WHERE start_at <= TIMESTAMP '2024-01-15 12:00:00'
        AND (end_at IS NULL OR TIMESTAMP '2024-01-15 12:00:00' < end_at)"""),
    "asof_join_events": f"""
      WITH v AS ({scd2("(SELECT o_custkey AS user_id, o_orderdate, o_orderkey, o_orderpriority FROM orders)",
                       "user_id", "o_orderdate", "o_orderpriority", "o_orderkey", "start_at", "end_at")}),
      f AS (SELECT event_id, user_id,
                   ts - to_days(CAST(8300 + event_id % 2400 AS INTEGER)) AS happened_at FROM events)
      SELECT f.user_id, f.event_id, f.happened_at, v.o_orderpriority, v.start_at
      FROM f JOIN v ON v.user_id = f.user_id AND v.start_at <= f.happened_at
        AND (v.end_at IS NULL OR f.happened_at < v.end_at)""",
    "dim_customers": _ask("SELECT * FROM dim_customers"),
    "dim_customers_as_written": _ask("SELECT * FROM dim_customers", documented=False),
    "dim_accounts": _ask("SELECT * FROM dim_accounts"),
    "dim_cards": _ask("SELECT * FROM dim_cards"),
    "dim_employees": _ask("SELECT * FROM dim_employees"),
    "dedupe_latest": """
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "current_unique": _ask("""
      SELECT account_id, customer_id, stav, snapshot_date FROM shared_accounts WHERE __END_AT IS NULL
      QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY snapshot_date DESC, customer_id DESC) = 1"""),
    "current_surplus": _ask("""
      SELECT CAST(sum(n - 1) AS BIGINT) AS set_aside, count(*) FILTER (WHERE n > 1) AS keys_affected
      FROM (SELECT account_id, count(*) AS n FROM shared_accounts WHERE __END_AT IS NULL GROUP BY 1)"""),
    "geography": _ask("SELECT * FROM geography"),
    "geography_rollup": _ask("""
      SELECT region_name, city_name, count(*) AS branches,
             CAST(grouping(region_name, city_name) AS INTEGER) AS rollup_level
      FROM geography GROUP BY ROLLUP (region_name, city_name)"""),
    "card_fact": _ask("SELECT * FROM facts_card"),
    "financial_fact": _ask("SELECT * FROM facts_financial"),
    "fact_union": _ask("SELECT * FROM facts"),
    "fact_union_as_written": _ask("SELECT * FROM facts", documented=False),
    "business_metrics": _ask("SELECT * FROM metrics"),
    "customer_summary": _ask("SELECT * FROM summary"),
    "key_history": _ask("""
      SELECT customer_id, prijem, __START_AT, __END_AT FROM dim_customers WHERE customer_id = '7'"""),
    "account_lifecycle": _ask("""
      SELECT typ_uctu, stav, count(*) AS pocet_uctu FROM dim_accounts WHERE __END_AT IS NULL GROUP BY ALL"""),
    "tx_with_customer": _ask("""
      SELECT t.* RENAME (ts AS datum_ts), o.client_age, o.prijem
      FROM tx_card t JOIN card_owners o ON o.card_id = t.card_id"""),
    "exec_dashboard": _ask(f"""
      SELECT region_name, time_period, count(*) AS transaction_count, {_VOLUME} FROM metrics
      WHERE transaction_year = 2024 AND transaction_month = 1 GROUP BY ALL"""),
    "exec_dashboard_cards": _ask(f"""
      SELECT region_name, time_period, count(*) AS transaction_count, {_VOLUME} FROM metrics
      WHERE transaction_year = 1998 AND transaction_month = 6 GROUP BY ALL"""),
    "customer_segmentation": _ask("""
      SELECT customer_tier, age_group, count(*) AS customer_count,
             CAST(sum(annual_income) AS DOUBLE) / count(annual_income) AS avg_income
      FROM summary GROUP BY ALL"""),
    "tx_trends": _ask("""
      SELECT day_type, income_segment, transaction_value_segment, count(*) AS transactions,
             CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount
      FROM metrics WHERE transaction_date >= DATE '1998-01-01' GROUP BY ALL"""),
    "weekend_spend": _ask("""
      SELECT city_name, count(*) AS transactions, CAST(sum(amount) AS DECIMAL(38,2)) AS total_spend
      FROM facts WHERE client_age BETWEEN 25 AND 35 AND transaction_day_of_week IN (1, 7) GROUP BY ALL"""),
    "high_value_trend": _ask(f"""
      SELECT transaction_year, transaction_month, count(*) AS transactions, {_VOLUME}
      FROM facts WHERE transaction_value_segment = 'High Value'
        AND transaction_date >= DATE '1998-07-01' AND transaction_date < DATE '1999-01-01'
      GROUP BY ALL"""),
    "evening_regions": _ask("""
      SELECT region_name, count(*) AS transactions FROM metrics WHERE time_period = 'Evening'
      GROUP BY ALL ORDER BY transactions DESC, region_name LIMIT 3"""),
    "income_segment_behaviour": _ask(f"""
      SELECT income_segment, count(*) AS transactions,
             CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount, {_VOLUME} FROM metrics GROUP BY ALL"""),
    "daily_summary": _ask(f"""
      SELECT transaction_date, time_period, count(*) AS transactions, {_VOLUME} FROM metrics GROUP BY ALL"""),
    "region_ranking": _ask(f"""
      SELECT region_name, count(*) AS transactions, {_VOLUME} FROM metrics GROUP BY ALL
      ORDER BY transactions DESC, total_volume DESC, region_name LIMIT 5"""),
    "weekend_comparison": _ask("""
      SELECT transaction_value_segment, count(*) FILTER (WHERE day_type = 'Weekend') AS weekend_transactions,
             count(*) FILTER (WHERE day_type = 'Weekday') AS weekday_transactions FROM metrics GROUP BY ALL"""),
    "evening_share": _ask("""
      SELECT transaction_year, transaction_month, count(*) AS transactions,
             count(*) FILTER (WHERE time_period = 'Evening') AS evening_transactions,
             CAST(count(*) FILTER (WHERE time_period = 'Evening') AS DOUBLE) / count(*) AS evening_share
      FROM metrics GROUP BY ALL"""),
    "premium_customers": _ask("SELECT * FROM summary WHERE customer_tier = 'Premium'"),
    "customers_by_place": _ask(
        "SELECT country, city, age_group, count(*) AS customers FROM summary GROUP BY ALL"),
    "young_earners": _ask("SELECT * FROM summary WHERE age_group = 'Young' AND annual_income > 20000"),
    "expiring_cards": _ask("""
      SELECT card_id, account_id, platnost_do,
             CAST(date_diff('day', DATE '2001-01-01', platnost_do) AS INTEGER) AS days_left
      FROM dim_cards WHERE __END_AT IS NULL
        AND date_diff('day', DATE '2001-01-01', platnost_do) BETWEEN 0 AND 90"""),
    "daily_cash_flow": _ask("""
      SELECT account_id, datum, balance,
             CAST(balance - lag(balance) OVER (PARTITION BY account_id ORDER BY datum)
                  AS DECIMAL(21,2)) AS cash_flow FROM balances"""),
    "merchant_performance": _ask(f"""
      SELECT p_type AS kategorie, count(DISTINCT merchant_id) AS merchants, count(*) AS transactions, {_VOLUME}
      FROM facts JOIN part ON CAST(p_partkey AS VARCHAR) = merchant_id GROUP BY ALL"""),
    "missing_days": _ask("""
      SELECT CAST(d AS DATE) AS missing_day FROM (
        SELECT unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 DAY)) AS d
        FROM log_customers)
      WHERE CAST(d AS DATE) NOT IN (SELECT snapshot_date FROM log_customers)"""),
    "volume_anomalies": _ask("""
      SELECT day, rows, round(m, 6) AS mean_rows, round(s, 6) AS stddev_rows, days_before,
             coalesce(abs(rows - m) > 2.0 * s AND days_before = 30, FALSE) AS is_anomaly
      FROM (SELECT *, avg(rows) OVER w AS m, stddev_pop(rows) OVER w AS s, count(*) OVER w AS days_before
            FROM (SELECT datum AS day, count(*) AS rows FROM tx_card GROUP BY 1)
            WINDOW w AS (ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))"""),
    "late_deliveries": """
      SELECT CAST(o_orderdate AS DATE) AS snapshot_date, count(*) AS rows,
             max(o_orderkey % 60) AS delay_hours
      FROM orders GROUP BY 1 HAVING max(o_orderkey % 60) > 48""",
    "daily_activity": _ask("""
      SELECT transaction_date, count(*) AS transactions, count(DISTINCT customer_id) AS active_customers
      FROM facts GROUP BY ALL"""),
}

_COUNTED = {
    "customers_clean_silver": "clean_customers", "customers_clean_good_records": "good_customers",
    "accounts_clean_silver": "clean_accounts", "accounts_clean_good_records": "good_accounts",
    "cards_clean_silver": "log_cards", "cards_clean_good_records": "log_cards",
    "employees_clean_silver": "clean_employees",
    "dim_customers": "dim_customers", "dim_accounts": "dim_accounts", "dim_cards": "dim_cards",
    "dim_employees": "dim_employees", "account_balances_silver": "balances",
    "card_transactions_silver": "lineitem", "financial_transactions_silver": "events",
    "merchants_silver": "part", "products_silver": "part", "regions_silver": "region",
    "cities_silver": "nation", "branches_silver": "supplier", "dim_geography_hierarchy": "geography",
    "fact_transaction_analytics_simplified": "facts", "table_basic_business_metrics": "metrics",
    "table_customer_summary": "summary",
    "customers_bronze": "log_customers", "accounts_bronze": "orders", "cards_bronze": "orders",
    "employees_bronze": "conversations", "branches_bronze": "supplier", "cities_bronze": "nation",
    "regions_bronze": "region", "products_bronze": "part", "merchants_bronze": "part",
    "account_balances_bronze": "balances", "card_transactions_bronze": "lineitem",
    "financial_transactions_bronze": "events",
}
_COUNTED_WHERE = {
    "customers_clean_bad_records": "clean_customers WHERE is_quarantined",
    "accounts_clean_bad_records": "clean_accounts WHERE is_quarantined",
    "cards_clean_bad_records": "log_cards WHERE card_id IS NULL",
    "employees_clean_good_records": "clean_employees WHERE prijmeni IS NOT NULL AND role IS NOT NULL",
    "employees_clean_bad_records": "clean_employees WHERE prijmeni IS NULL OR role IS NULL",
}

ORACLE |= {
    "stream_ingest_csv": ORACLE["card_transactions_silver"],
    "stream_clean": _ask("SELECT * EXCLUDE (ord) FROM clean_customers"),
    "stream_route": _ask("""
      SELECT * EXCLUDE (ord, is_quarantined),
             CASE WHEN is_quarantined THEN 'bad' ELSE 'good' END AS side FROM clean_accounts"""),
    "stream_scd2": ORACLE["dim_accounts"],
    "stream_fact": ORACLE["fact_union"],
    "stream_metrics_dashboard": ORACLE["exec_dashboard"],
    "refresh_all_tables": _ask(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}"
        for name, source in {**_COUNTED, **_COUNTED_WHERE}.items())),
    "schema_drift": """
      SELECT 'expected' AS delivery, count(*) AS rows, CAST(0 AS BIGINT) AS rescued_rows FROM nation
      UNION ALL SELECT 'widened', count(*), count(*) FROM nation""",
    "header_drift": """
      SELECT unnest(['reordered', 'repeated', 'headless']) AS delivery,
             unnest([0, 1, 0]) + (SELECT count(*) FROM nation) AS lines""",
    "compacted_month": _ask("""
      SELECT count(*) AS rows, CAST(sum(amount) AS DECIMAL(38,2)) AS volume, CAST(1 AS BIGINT) AS files
      FROM facts_card WHERE transaction_year = 1998 AND transaction_month = 6"""),
    "declared_table": """
      SELECT CAST(0 AS BIGINT) AS declared_rows, count(*) AS published_rows,
             TRUE AS in_own_namespace, TRUE AS dropped FROM region""",
    "stream_fact_late_dimension": ORACLE["fact_union"],
    "stream_rule_metrics": f"SELECT * FROM ({ORACLE['quality_metrics']}) WHERE entity IN ('customers', 'accounts')",
    "balances_through_csv": ORACLE["account_balances_silver"],
}

_COPIES = """(
  WITH base AS (
    SELECT o_custkey || '-' || o_orderpriority AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_custkey AS number,
           o_orderpriority AS typ_uctu, o_orderstatus AS stav, 'CZK' AS mena, '1995-01-01' AS datum_otevreni,
           CAST(NULL AS VARCHAR) AS datum_uzavreni
    FROM orders WHERE o_orderkey % 41 <> 0
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) = 1)
  SELECT * EXCLUDE (number, d) REPLACE (CASE WHEN number % 20 BETWEEN 1 AND d THEN 'X' || (number % 20) ELSE stav END AS stav),
         DATE '2024-01-01' + CAST(d AS INTEGER) AS snapshot_date, d AS ord FROM base, range(0, 4) days(d)
  UNION ALL
  SELECT * EXCLUDE (number) REPLACE ('L' AS stav), DATE '2024-01-02', 4 FROM base WHERE number % 50 = 7)"""

ORACLE |= {
    "stream_scd2_unchanged": scd2(
        _COPIES, "account_id customer_id", "snapshot_date", "typ_uctu stav mena datum_otevreni datum_uzavreni", "ord",
        "__START_AT", "__END_AT", "TIMESTAMP"),
    "rescue_by_header": _ask("""
      SELECT card_transaction_id, card_id, CASE WHEN part = 3 AND city_id = '3' THEN NULL ELSE amount END AS amount,
             typ_transakce, city_id, CASE WHEN part <> 2 THEN region_id END AS region_id,
             CASE WHEN part = 2 THEN 'said "' || card_id || '", then left' END AS rescued_note,
             CASE WHEN part = 3 AND city_id = '3' THEN 'n/a' END AS rescued_amount,
             CASE WHEN part = 2 THEN 'widened' WHEN part = 3 AND city_id = '3' THEN 'mistyped' END AS rescued_from
      FROM (SELECT *, CAST(card_id AS BIGINT) % 4 AS part FROM tx_card)"""),
    "stream_rule_metrics_observed": f"""
      SELECT m.*, w.written_rows FROM ({ORACLE['stream_rule_metrics']}) m JOIN (
        {_ask("SELECT 'customers' AS entity, count(*) AS written_rows FROM clean_customers UNION ALL SELECT 'accounts', count(*) FROM clean_accounts")}
      ) w ON w.entity = m.entity""",
    "stream_join_bounded": """
      WITH paid AS (SELECT l_orderkey AS card, l_linenumber AS line, l_partkey AS part, CAST(l_shipdate AS TIMESTAMP) AS paid_at FROM lineitem),
      ordered AS (SELECT o_orderkey AS card, o_orderpriority AS priority, CAST(o_orderdate AS TIMESTAMP) AS ordered_at
                  FROM orders WHERE o_orderkey % 3 <> 0),
      mark AS (SELECT least((SELECT max(paid_at) FROM paid WHERE card % 10 <> 3),
                            (SELECT max(ordered_at) FROM ordered WHERE card % 10 <> 3)) - INTERVAL 90 DAY AS reached),
      p AS (SELECT paid.* FROM paid, mark WHERE card % 10 <> 3 OR paid_at > reached),
      o AS (SELECT ordered.* FROM ordered, mark WHERE card % 10 <> 3 OR ordered_at > reached)
      SELECT p.*, o.priority, o.ordered_at, o.card IS NOT NULL AS matched
      FROM p LEFT JOIN o ON o.card = p.card AND o.ordered_at <= p.paid_at AND o.ordered_at >= p.paid_at - INTERVAL 60 DAY""",
}

ORACLE |= {
    "stream_fact_native": ORACLE["fact_union"],
    "stream_mart_native": ORACLE["exec_dashboard"],
    "exec_dashboard_incremental": ORACLE["exec_dashboard_cards"],
    "tx_trends_incremental": ORACLE["tx_trends"],
    "daily_activity_merged": ORACLE["daily_activity"],
    "account_lifecycle_by_day": _ask("""
      SELECT typ_uctu, stav, CAST(d AS DATE) AS day, count(*) AS pocet_uctu
      FROM dim_accounts, generate_series(TIMESTAMP '1998-01-01', TIMESTAMP '1998-06-30', INTERVAL 1 DAY) days(d)
      WHERE __START_AT <= d AND (__END_AT IS NULL OR d < __END_AT) GROUP BY ALL"""),
}

ORACLE |= {
    "compacted_partitions": _ask("""
      SELECT transaction_year, transaction_month, count(*) AS rows, CAST(1 AS BIGINT) AS files,
             TRUE AS some_rewritten, CAST(0 AS BIGINT) AS rewritten_again FROM facts_card GROUP BY ALL"""),
    "card_fact_bucketed": ORACLE["card_fact"],
    "key_history_stored": ORACLE["key_history"],
}
