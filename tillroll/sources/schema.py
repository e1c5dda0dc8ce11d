"""Native shop schema: six tables, their declared rules and the report labels.

Types follow the reference's DDL with money as DECIMAL so that distributed
sums are exact and independent of summation order.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(9, 4)

CATEGORIES = T.StructType([
    T.StructField("category_id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("parent_id", T.LongType(), True),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("category_id", T.LongType(), True),
    T.StructField("unit_cost", MONEY, False),
    T.StructField("unit_price", MONEY, False),
    T.StructField("launched_at", T.DateType(), False),
    T.StructField("is_active", T.IntegerType(), True),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("full_name", T.StringType(), False),
    T.StructField("email", T.StringType(), False),
    T.StructField("city", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("segment", T.StringType(), True),
    T.StructField("acquired_at", T.DateType(), False),
    T.StructField("referral_src", T.StringType(), True),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("ordered_at", T.TimestampNTZType(), False),
    T.StructField("shipped_at", T.TimestampNTZType(), True),
    T.StructField("discount_pct", RATE, True),
])

ORDER_ITEMS = T.StructType([
    T.StructField("item_id", T.LongType(), False),
    T.StructField("order_id", T.LongType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", MONEY, False),
    T.StructField("unit_cost", MONEY, False),
])

MARKETING_SPEND = T.StructType([
    T.StructField("spend_id", T.LongType(), False),
    T.StructField("month", T.StringType(), False),
    T.StructField("channel", T.StringType(), False),
    T.StructField("spend_zar", MONEY, False),
])

TABLES = {
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "marketing_spend": MARKETING_SPEND,
}

# --- Fixed values that must equal the reference's for right results ---------
# Allowed values of the CHECK(... IN ...) rules, in declaration order.
SEGMENTS = ("B2C", "B2B", "VIP")
STATUSES = ("completed", "returned", "cancelled", "pending")
CHANNELS = ("web", "mobile", "store", "marketplace")
# Column defaults: customers.country, products.is_active, orders.discount_pct.
DEFAULTS = {
    "customers": {"country": "ZA"},
    "products": {"is_active": 1},
    "orders": {"discount_pct": 0},
}
# RFM labels of the detail report, byte for byte (note the two spaces in
# "At Risk" after the emoji and its variation selector), in CASE order.
RFM_LABELS_DETAIL = (
    "⭐ Champion",
    "💚 Loyal Customer",
    "🆕 Promising New",
    "🎯 Potential Loyalist",
    "⚠️  At Risk",
    "😴 Cant Lose Them",
    "💀 Lost",
    "🌱 Regular",
)
# RFM labels of the export report, same CASE order.
RFM_LABELS_EXPORT = (
    "Champion",
    "Loyal Customer",
    "Promising New",
    "Potential Loyalist",
    "At Risk",
    "Cant Lose Them",
    "Lost",
    "Regular",
)
# --- end of fixed values -----------------------------------------------------

# Declared table rules, checked by operators.quality.constraint_violations.
# kind: pk | unique | not_null | check_in | fk
RULES = [
    ("categories", "pk", ("category_id",), None),
    ("categories", "not_null", ("name",), None),
    ("categories", "fk", ("parent_id",), ("categories", "category_id")),
    ("products", "pk", ("product_id",), None),
    ("products", "not_null", ("name", "unit_cost", "unit_price", "launched_at"), None),
    ("products", "fk", ("category_id",), ("categories", "category_id")),
    ("customers", "pk", ("customer_id",), None),
    ("customers", "unique", ("email",), None),
    ("customers", "not_null", ("full_name", "email", "acquired_at"), None),
    ("customers", "check_in", ("segment",), SEGMENTS),
    ("orders", "pk", ("order_id",), None),
    ("orders", "fk", ("customer_id",), ("customers", "customer_id")),
    ("orders", "check_in", ("status",), STATUSES),
    ("orders", "check_in", ("channel",), CHANNELS),
    ("orders", "not_null", ("ordered_at",), None),
    ("order_items", "pk", ("item_id",), None),
    ("order_items", "fk", ("order_id",), ("orders", "order_id")),
    ("order_items", "fk", ("product_id",), ("products", "product_id")),
    ("order_items", "not_null", ("quantity", "unit_price", "unit_cost"), None),
    ("marketing_spend", "pk", ("spend_id",), None),
    ("marketing_spend", "not_null", ("month", "channel", "spend_zar"), None),
]
