"""Dataset schemas with classification metadata, and the allowed values."""

from __future__ import annotations

from pyspark.sql import types as T

PUBLIC = "PUBLIC"
INTERNAL = "INTERNAL"
CONFIDENTIAL = "CONFIDENTIAL"
RESTRICTED = "RESTRICTED"

# Fixed values of the data model.
RIDE_STATUSES = ("completed", "cancelled", "ongoing", "no_show")
PAYMENT_METHODS = ("UPI", "Credit Card", "Debit Card", "Cash", "Wallet")
PAYMENT_STATUSES = ("completed", "failed", "refunded", "pending")
VEHICLE_TYPES = ("Sedan", "Hatchback", "SUV", "Auto", "Bike")

MONEY = T.DecimalType(10, 2)
DEGREES = T.DecimalType(10, 6)


def _text(name, length, classification, mask=None):
    metadata = {"classification": classification, "max_length": length}
    if mask:
        metadata["mask"] = mask
    return T.StructField(name, T.StringType(), False, metadata)


def _field(name, dtype, classification=PUBLIC, nullable=False):
    return T.StructField(name, dtype, nullable, {"classification": classification})


CUSTOMERS = T.StructType([
    _text("customer_id", 10, INTERNAL),
    _text("first_name", 100, CONFIDENTIAL, mask="initial"),
    _text("last_name", 100, CONFIDENTIAL, mask="initial"),
    _text("email", 255, CONFIDENTIAL, mask="hash"),
    _text("phone", 20, CONFIDENTIAL, mask="last4"),
    _text("city", 50, PUBLIC),
    _field("signup_date", T.DateType()),
    _field("is_active", T.BooleanType()),
])

DRIVERS = T.StructType([
    _text("driver_id", 10, INTERNAL),
    _text("first_name", 100, CONFIDENTIAL, mask="initial"),
    _text("last_name", 100, CONFIDENTIAL, mask="initial"),
    _text("phone", 20, CONFIDENTIAL, mask="last4"),
    _text("city", 50, PUBLIC),
    _text("vehicle_type", 20, PUBLIC),
    _text("license_number", 30, CONFIDENTIAL, mask="hash"),
    _field("rating", T.DecimalType(3, 1)),
    _field("join_date", T.DateType()),
    _field("is_active", T.BooleanType()),
])

RIDES = T.StructType([
    _text("ride_id", 10, INTERNAL),
    _text("customer_id", 10, INTERNAL),
    _text("driver_id", 10, INTERNAL),
    _text("pickup_city", 50, PUBLIC),
    _text("pickup_area", 100, PUBLIC),
    _text("dropoff_city", 50, PUBLIC),
    _text("dropoff_area", 100, PUBLIC),
    _field("pickup_lat", DEGREES, RESTRICTED),
    _field("pickup_lon", DEGREES, RESTRICTED),
    _field("dropoff_lat", DEGREES, RESTRICTED),
    _field("dropoff_lon", DEGREES, RESTRICTED),
    _field("request_time", T.TimestampNTZType()),
    _field("pickup_time", T.TimestampNTZType(), nullable=True),
    _field("dropoff_time", T.TimestampNTZType(), nullable=True),
    _field("distance_km", MONEY),
    _field("fare", MONEY),
    _field("surge_multiplier", T.DecimalType(4, 2)),
    _text("ride_status", 20, PUBLIC),
])

PAYMENTS = T.StructType([
    _text("payment_id", 10, INTERNAL),
    _text("ride_id", 10, INTERNAL),
    _text("customer_id", 10, INTERNAL),
    _field("amount", MONEY),
    _text("payment_method", 20, PUBLIC),
    _text("payment_status", 20, PUBLIC),
    _field("payment_time", T.TimestampNTZType()),
    _field("tip_amount", MONEY),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# In foreign-key order: parents before children.
DATASETS = {
    "customers": CUSTOMERS,
    "drivers": DRIVERS,
    "rides": RIDES,
    "payments": PAYMENTS,
}

# Datasets of one level depend on earlier levels only.
LEVELS = (("customers", "drivers"), ("rides",), ("payments",))

# The datasets that a dataset refers to.
PARENTS = {"customers": (), "drivers": (), "rides": ("customers", "drivers"), "payments": ("customers", "rides")}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "drivers": "driver_id",
    "rides": "ride_id",
    "payments": "payment_id",
}

# (latitude, longitude, cell column that replaces the pair)
GEO_PAIRS = (
    ("pickup_lat", "pickup_lon", "pickup_cell"),
    ("dropoff_lat", "dropoff_lon", "dropoff_cell"),
)


def classified(schema: T.StructType, classification: str) -> list[str]:
    """Column names of `schema` that carry `classification`."""
    return [f.name for f in schema if f.metadata.get("classification") == classification]


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all as nullable strings (the Bronze form)."""
    return T.StructType([T.StructField(f.name, T.StringType(), True, f.metadata) for f in schema])
