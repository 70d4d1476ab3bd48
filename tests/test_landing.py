"""Landing CSV: quoting, lineage, rescue, and each file once."""

import datetime as dt

import pytest

import bank
from ledgerstrata.config import Settings
from ledgerstrata.sources.landing import read_landing
from ledgerstrata.sources.tables import read_table
from ledgerstrata.streaming import feeds


def test_quotes_newlines_and_dated_folders(spark, tmp_path):
    rows = [bank.customer("1", adresa='Hlavní "U Lva" 1, Praha, 11000', jmeno="Jan\nKarel")]
    landing = bank.land(tmp_path, "customers", rows, "2024.01.31")
    bank.land(tmp_path, "customers", [bank.customer("2")])
    bank.land(tmp_path, "customers", [bank.customer("3")], "2024.13.40")
    got = {r["customer_id"]: r for r in read_landing(spark, landing, "customers").collect()}
    assert got["1"]["adresa"] == 'Hlavní "U Lva" 1, Praha, 11000'
    assert got["1"]["jmeno"] == "Jan\nKarel"
    assert got["1"]["snapshot_date"] == dt.date(2024, 1, 31)
    assert got["1"]["source_file"].endswith("/landing_data/customers/2024.01.31/part-0.csv")
    assert got["1"]["ingestion_ts"] is not None
    assert got["2"]["snapshot_date"] is None and got["3"]["snapshot_date"] is None
    assert all(r["_rescued_data"] is None for r in got.values())


def test_changed_header_fails_loudly(spark, tmp_path):
    landing = bank.land(tmp_path, "regions", [{"region_id": "R1", "nazev": "x"}], header=("nazev", "region_id"))
    with pytest.raises(Exception, match="header"):
        read_landing(spark, landing, "regions").collect()


def test_rescue_keeps_odd_rows(spark, tmp_path):
    landing = bank.land(tmp_path, "regions", [{"region_id": "R1", "nazev": "x"}])
    with open(f"{landing}/regions/part-0.csv", "a") as out:
        out.write("R2,y,extra\nR3\n")
    got = {r["region_id"]: r for r in read_landing(spark, landing, "regions", rescue=True).collect()}
    assert got["R1"]["_rescued_data"] is None
    assert got["R2"]["_rescued_data"] == "R2,y,extra" and got["R2"]["nazev"] == "y"
    assert got["R3"]["nazev"] is None


def test_stream_takes_each_file_once(spark, tmp_path):
    settings = Settings(root=str(tmp_path / "lake"))
    landing = bank.land(tmp_path, "customers", [bank.customer("1"), bank.customer("2")], "2024.01.01")

    def ingest():
        feeds.ingest(spark, settings, landing, "customers").awaitTermination()
        return read_table(spark, settings, "customers_bronze").count()

    assert ingest() == 2
    assert ingest() == 2
    bank.land(tmp_path, "customers", [bank.customer("1")], "2024.01.02")
    assert ingest() == 3


def test_raw_table_is_pruned_by_snapshot(spark, tmp_path):
    settings = Settings(root=str(tmp_path / "lake"))
    landing = bank.land(tmp_path, "cards", [bank.card("1", "A")], "2024.01.01")
    feeds.ingest(spark, settings, landing, "cards").awaitTermination()
    rows = read_table(spark, settings, "cards_bronze").where("snapshot_date = DATE'2024-01-01'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert rows.count() == 1
