"""Typed columns of the raw tables.

Only columns that carry meaning for the library are typed; any further column of a file is kept
as text. Types are applied by column name, so the order of columns in a file does not matter.
"""

from __future__ import annotations

# File naming of the public CSV data set, `olist_<table>_dataset.csv`.
RAW_FILE_PREFIX = "olist_"
RAW_FILE_SUFFIX = "_dataset"

RAW_TYPES: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "price": "double",
        "freight_value": "double",
    },
    "order_payments": {
        "order_id": "string",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "double",
    },
    "order_reviews": {"order_id": "string", "review_score": "int"},
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_state": "string",
        "customer_city": "string",
    },
    "products": {},
    "sellers": {},
}

# Free text with line breaks inside quotes: such files cannot be split at line ends.
MULTI_LINE_TABLES = frozenset({"order_reviews"})
