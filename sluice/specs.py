"""Declarative table specs and quality thresholds.

A ``TableSpec`` says how a raw (all-string) table is typed and standardised and which rules it must pass.
Every operator reads the spec; nothing dispatches on method names.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping


@dataclass(frozen=True)
class Thresholds:
    """Gate limits in percent. Both comparisons are strict: a value *equal* to the limit passes."""

    max_corrupt_percent: float = 5.0
    null_percent: float = 10.0


# Threshold presets per environment (max corrupt %, null warning %).
PRESETS: Mapping[str, Thresholds] = MappingProxyType(
    {
        "base": Thresholds(max_corrupt_percent=5.0, null_percent=10.0),
        "dev": Thresholds(max_corrupt_percent=10.0, null_percent=10.0),
        "staging": Thresholds(max_corrupt_percent=3.0, null_percent=8.0),
        "prod": Thresholds(max_corrupt_percent=1.0, null_percent=5.0),
    }
)


def _frozen(m: Mapping | None) -> Mapping:
    return MappingProxyType(dict(m or {}))


@dataclass(frozen=True)
class TableSpec:
    """How one table is standardised and validated.

    name            logical table name (upper-cased file name for raw CSVs)
    key             columns that must be unique together (NULL counts as one key value)
    required        columns that must exist
    allowed_values  column -> allowed values; other non-NULL values are reported (warning)
    non_negative    numeric columns whose negative values are reported (warning)
    casts           column -> target type: timestamp, timestamp_ntz, date, double, int, legacy_int,
                    decimal(p,s), or any Spark SQL type name (always a *try* cast: bad input -> NULL)
    upper_trim      columns standardised with upper(trim(c))
    check_nulls     run the per-column NULL profile
    check_duplicates run the whole-row duplicate profile
    """

    name: str
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    allowed_values: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    non_negative: tuple[str, ...] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    upper_trim: tuple[str, ...] = ()
    check_nulls: bool = True
    check_duplicates: bool = True

    def __post_init__(self):
        object.__setattr__(self, "key", tuple(self.key))
        object.__setattr__(self, "required", tuple(self.required))
        object.__setattr__(self, "non_negative", tuple(self.non_negative))
        object.__setattr__(self, "upper_trim", tuple(self.upper_trim))
        object.__setattr__(
            self, "allowed_values", _frozen({k: tuple(v) for k, v in dict(self.allowed_values).items()})
        )
        object.__setattr__(self, "casts", _frozen(self.casts))

    def __hash__(self):
        return hash((self.name, self.key, self.required, tuple(self.allowed_values.items()),
                     self.non_negative, tuple(self.casts.items()), self.upper_trim))


# The allowed order statuses of the e-commerce source, in the source's order.
ORDER_STATUSES = ("delivered", "shipped", "processing", "canceled", "unavailable", "invoiced", "created", "approved")

# The e-commerce source tables, their rules and their typing.
CUSTOMERS = TableSpec(
    name="OLIST_CUSTOMERS_DATASET",
    key=("customer_id",),
    required=("customer_id", "customer_city", "customer_state"),
    upper_trim=("customer_city", "customer_state"),
)
ORDERS = TableSpec(
    name="OLIST_ORDERS_DATASET",
    key=("order_id",),
    required=("order_id", "customer_id", "order_status"),
    allowed_values={"order_status": ORDER_STATUSES},
    casts={
        "order_purchase_timestamp": "timestamp",
        "order_approved_at": "timestamp",
        "order_delivered_carrier_date": "timestamp",
        "order_delivered_customer_date": "timestamp",
        "order_estimated_delivery_date": "date",
    },
)
PRODUCTS = TableSpec(
    name="OLIST_PRODUCTS_DATASET",
    key=("product_id",),
    required=("product_id",),
    non_negative=("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"),
    casts={
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    },
)
PAYMENTS = TableSpec(
    name="OLIST_ORDER_PAYMENTS_DATASET",
    casts={"payment_value": "decimal(10,2)", "payment_installments": "int"},
)

# The nine files a raw drop must contain.
REQUIRED_RAW_FILES = (
    "olist_customers_dataset.csv",
    "olist_orders_dataset.csv",
    "olist_products_dataset.csv",
    "olist_order_items_dataset.csv",
    "olist_order_payments_dataset.csv",
    "olist_order_reviews_dataset.csv",
    "olist_sellers_dataset.csv",
    "olist_geolocation_dataset.csv",
    "product_category_name_translation.csv",
)

REGISTRY: dict[str, TableSpec] = {s.name: s for s in (CUSTOMERS, ORDERS, PRODUCTS, PAYMENTS)}


def spec_for(table_name: str, registry: Mapping[str, TableSpec] | None = None) -> TableSpec:
    """The registered spec for a table (case-insensitive); unknown tables get a rule-free spec."""
    reg = REGISTRY if registry is None else registry
    for name, spec in reg.items():
        if name.upper() == table_name.upper():
            return spec
    return TableSpec(name=table_name.upper())
