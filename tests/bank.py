"""A small bank's landing files."""

from __future__ import annotations

import csv
import os

from ledgerstrata.schemas import LANDING


def land(root, entity, rows, folder=None, name="part-0.csv", header=None):
    """Write rows (dicts by column) as one landing file, doubling inner quotes."""
    path = os.path.join(str(root), "landing_data", entity, *([folder] if folder else []))
    os.makedirs(path, exist_ok=True)
    columns = header or LANDING[entity]
    with open(os.path.join(path, name), "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(columns)
        for row in rows:
            writer.writerow([row.get(c, "") for c in columns])
    return os.path.join(str(root), "landing_data")


def customer(key, **changes):
    return {
        "customer_id": key, "jmeno": "Jan", "prijmeni": "Novák",
        "adresa": "Hlavní 123, Praha, 11000", "email": "jan@email.cz", "rodne_cislo": "801201/1234",
        "stav": "aktivní", "tel_cislo": "+420 123 456 789", "datum_narozeni": "1980-12-01",
        "typ_bydleni": "vlastní", "pracovni_stav": "zaměstnaný", "pohlavi": "M",
        "pocet_clenu_domacnost": "4", "datum_prvniho_otevreni_uctu": "2020-03-15",
        "zeme": "Česká republika", "prijem": "45000.00", "titul_pred": "Ing.", "titul_za": "Ph.D.",
        "sum_prm_uspor_12m": "150000.00", "min_atm_amt": "500.00", "rezident": "ano",
        "pocet_nemovitosti": "1", **changes,
    }


def account(key, owner, **changes):
    return {"account_id": key, "customer_id": owner, "typ_uctu": "běžný", "stav": "aktivní",
            "mena": "CZK", "datum_otevreni": "2020-03-15", **changes}


def card(key, on, **changes):
    return {"card_id": key, "account_id": on, "typ_karty": "debetní", "stav": "aktivní",
            "platnost_do": "2025-12-31", **changes}


def payment(key, by, amount="1250.50", datum="2024-01-15 14:30:00", **changes):
    return {"card_transaction_id": key, "card_id": by, "merchant_id": "M1", "amount": amount,
            "datum": datum, "typ_transakce": "nákup", "city_id": "C1", "region_id": "R1", **changes}


def transfer(key, on, amount="50.00", datum="2024-01-20 19:15:00", **changes):
    return {"transaction_id": key, "account_id": on, "amount": amount, "datum": datum,
            "typ_transakce": "převod", "city_id": "C9", "region_id": "R1", **changes}


def land_references(root, name="part-0.csv"):
    land(root, "regions", [{"region_id": "R1", "nazev": "Praha"}], name=name)
    land(root, "cities", [{"city_id": "C1", "nazev": "Praha", "region_id": "R1"},
                          {"city_id": "C2", "nazev": "Nikde", "region_id": "R9"}], name=name)
    land(root, "branches", [
        {"branch_id": "B1", "nazev": "Centrum", "adresa": "Václavské náměstí 1, Praha, 11000", "city_id": "C1"},
        {"branch_id": "B2", "nazev": "Bez regionu", "adresa": "28. října, Brno, 60200", "city_id": "C2"},
        {"branch_id": "B3", "nazev": "Bez města", "adresa": "Hlavní 12a / 3B, Brno, 60200", "city_id": "C7"},
    ], name=name)
    land(root, "products", [{"product_id": "P1", "nazev": "Účet", "kategorie": "účty"}], name=name)
    land(root, "merchants", [{"merchant_id": "M1", "nazev": "Obchod", "kategorie": "potraviny"}], name=name)


def land_first_day(root):
    """Everything the chain needs, with one customer to quarantine."""
    land(root, "customers", [customer("1"), customer("2", prijem="90000.00"),
                             customer("3", datum_narozeni="neznámé")], "2024.01.01")
    land(root, "accounts", [account("A1", "1"), account("A2", "2"), account("A3", "2", mena="")], "2024.01.01")
    land(root, "cards", [card("K1", "A1"), card("K2", "A2")], "2024.01.01")
    land(root, "employees", [{"employee_id": "E1", "jmeno": "Anna", "prijmeni": "Svobodová",
                              "role": "poradce", "branch_id": "B1"}], "2024.01.01")
    land_references(root)
    land(root, "card_transactions", [payment("T1", "K1"), payment("T2", "K2", "150.00"),
                                     payment("T3", "K9")])
    land(root, "financial_transactions", [transfer("F1", "A1"), transfer("F2", "A2", datum="2024-02-03 08:00:00")])
    return land(root, "account_balances", [{"account_id": "A1", "balance": "100.00", "datum": "2024-01-15"}])


def land_second_day(root):
    """A raise, an account that moves, and a card for a payment that waits."""
    land(root, "customers", [customer("1", prijem="46000.00"), customer("2", prijem="90000.00")], "2024.01.03")
    land(root, "accounts", [account("A1", "1"), account("A2", "1")], "2024.01.03")
    land(root, "cards", [card("K1", "A1"), card("K2", "A2"), card("K9", "A1")], "2024.01.03")
    land(root, "card_transactions", [payment("T4", "K1", "99.00", "2024-02-10 23:59:59")], name="part-1.csv")


def land_late_day(root):
    """A snapshot that should have come between the first two."""
    land(root, "customers", [customer("1", prijem="41000.00"), customer("2", prijem="90000.00")], "2024.01.02")
