"""Table schemas and the fixed values every layer shares."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import types as T

# Column names of the raw source batches and the bronze name of each.
SOURCE_COLUMNS = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}

# Structural patterns. `[0-9]` and `\z` rather than `\d` and `$`, because Java's `$`
# also accepts a trailing newline.
INVOICE_PATTERN = r"^C?[0-9]{6}\z"
CUSTOMER_ID_PATTERN = r"^[0-9]{5}\z"
PRODUCT_CODE_PATTERN = r"^[0-9]{5}[A-Za-z]*\z"

# The invoice_date window of the retail dataset, end exclusive.
DATASET_WINDOW = (datetime(2009, 12, 1), datetime(2012, 1, 1))

# Default run-rate horizon (also the active threshold) and trailing window, in days.
CHURN_WINDOW_DAYS = 90
TRAILING_WINDOW_DAYS = 365

# Warehouse layers, lowest first.
LAYERS = ("bronze", "silver", "gold")

BRONZE_TABLE = "bronze.transactions"
SILVER_TABLE = "silver.transactions"
GOLD_TABLE = "gold.customer_360"

# The columns that describe a real-world invoice line; the rest of bronze is lineage.
LINE_COLUMNS = tuple(SOURCE_COLUMNS.values())


def _schema(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in columns])


_TEXT, _TIMESTAMP, _FLAG = T.StringType(), T.TimestampNTZType(), T.BooleanType()
_INT, _MONEY, _DATE = T.IntegerType(), T.DoubleType(), T.DateType()

BRONZE_SCHEMA = _schema(
    ("invoice", _TEXT, False),
    ("stock_code", _TEXT, False),
    ("description", _TEXT, True),
    ("quantity", T.LongType(), False),
    ("invoice_date", _TIMESTAMP, False),
    ("unit_price", _MONEY, False),
    ("customer_id", _TEXT, True),
    ("country", _TEXT, False),
    ("source_file", _TEXT, False),
    ("source_sheet", _TEXT, False),
    ("loaded_at", _TIMESTAMP, False),
)

SILVER_SCHEMA = _schema(
    ("invoice", _TEXT, False),
    ("stock_code", _TEXT, False),
    ("description", _TEXT, False),
    ("quantity", T.LongType(), False),
    ("invoice_date", _TIMESTAMP, False),
    ("unit_price", _MONEY, False),
    ("customer_id", _TEXT, False),
    ("country", _TEXT, False),
    ("line_revenue", _MONEY, False),
    ("is_cancellation", _FLAG, False),
    ("is_product", _FLAG, False),
    ("source_file", _TEXT, False),
    ("source_sheet", _TEXT, False),
    ("loaded_at", _TIMESTAMP, False),
)

CUSTOMER_360_SCHEMA = _schema(
    ("customer_id", _TEXT, False),
    ("as_of_date", _DATE, False),
    ("first_purchase_date", _DATE, False),
    ("last_activity_date", _DATE, False),
    ("last_purchase_date", _DATE, True),
    ("recency_days", _INT, False),
    ("tenure_days", _INT, False),
    ("order_count", _INT, False),
    ("cancelled_order_count", _INT, False),
    ("total_net_revenue", _MONEY, False),
    ("trailing_12m_net_revenue", _MONEY, False),
    ("cancelled_revenue", _MONEY, False),
    ("run_rate_90d", _MONEY, False),
    ("country", _TEXT, False),
)
