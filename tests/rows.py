"""Small hand-made rows with every edge case, and their frames."""

from __future__ import annotations

import datetime as dt
import json

from tillmart import schemas

CUSTOMERS = [
    ("c1", "Анна", "O'Neil", "a@example.org", "Tver", "premium", dt.date(2020, 1, 1), dt.date(2026, 7, 1)),
    ("c2", "Борис", "Иванов", None, "Пермь", "basic", dt.date(2021, 2, 3), dt.date(2026, 7, 1)),
]
PRODUCTS = [
    ("p1", "Чайник", "Кухня", "A", 100.0, "RUB"),
    ("p2", "Чайник", "Кухня", "B", 50.0, "RUB"),
    ("p3", "Лампа", "Дом", "A", 10.0, "RUB"),
]
D1, D2 = dt.datetime(2026, 7, 4, 9, 0), dt.datetime(2026, 7, 5, 21, 30)
TRANSACTIONS = [
    ("t1", D1, "STORE-МОС-01", "c1", 250.0, "card"),
    ("t2", D1, "STORE-МОС-01", "c2", 10.0, "cash"),
    ("t3", D2, "STORE-ПЕР-02", "c1", 0.0, "sbp"),
    ("t4", D2, "STORE-ПЕР-02", "nobody", 100.0, "card"),
    ("t5", D2, "STORE-ПЕР-02", "c2", 30.0, "card"),
]
ITEMS = [
    ("t1", "p1", 2, 100.0),
    ("t1", "p2", 1, 50.0),
    ("t2", "p3", 1, 10.0),
    ("t4", "p1", 1, 100.0),
    ("t5", "p3", 3, 10.0),
    ("t5", "unknown", 1, 5.0),
    ("lost", "p3", 1, 10.0),
]


def silver(spark, customers=CUSTOMERS, products=PRODUCTS, transactions=TRANSACTIONS, items=ITEMS):
    return (
        spark.createDataFrame(transactions, schemas.TRANSACTIONS),
        spark.createDataFrame(customers, schemas.CUSTOMERS),
        spark.createDataFrame(items, schemas.ITEMS),
        spark.createDataFrame(products, schemas.PRODUCTS),
    )


def event(number=1, **changes):
    """A raw receipt; a change to ``...`` removes the field."""
    document = {
        "batch_id": "manual__2026-07-04T00:00:00+00:00",
        "transaction_id": f"TXN-{number}",
        "timestamp": "2026-07-04T17:10:00+00:00",
        "store_id": "STORE-МОС-01",
        "customer_id": "c1",
        "items": [
            {"product_id": "p1", "quantity": 2, "unit_price": 100.0},
            {"product_id": "p3", "quantity": 1, "unit_price": 10.5},
        ],
        "total_amount": 210.5,
        "payment_method": "card",
    }
    document.update(changes)
    return {key: value for key, value in document.items() if value is not ...}


def text(document):
    return json.dumps(document, ensure_ascii=False)


def messages(spark, *documents):
    rows = [(d if isinstance(d, str) else text(d),) for d in documents]
    return spark.createDataFrame(rows, "value STRING")
