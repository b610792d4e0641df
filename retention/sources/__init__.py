"""Sources and sinks: the mapped test views, CSV/Parquet readers, writers."""

from retention.sources.views import (
    PRICE_TIEBREAK,
    account_view,
    price_view,
    read_table,
)
from retention.sources.schemas import CLIENT_SCHEMA, PRICE_SCHEMA, PRICE_COLUMNS

__all__ = ["PRICE_TIEBREAK", "account_view", "price_view", "read_table",
           "CLIENT_SCHEMA", "PRICE_SCHEMA", "PRICE_COLUMNS"]
