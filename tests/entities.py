"""Small orders, items and products with the column names the plans expect."""

from datetime import datetime

ORDERS = "order_id bigint, customer_id bigint, order_date timestamp_ntz, total double, channel string, status string"
ITEMS = "order_id bigint, product_id bigint, quantity bigint"
PRODUCTS = "product_id bigint, product string, category_id bigint, category string"


def orders(spark, rows):
    """rows: (order_id, customer_id, 'yyyy-mm-dd', total, channel, status)"""
    parsed = [(o, c, datetime.fromisoformat(d) if d else None, *rest) for o, c, d, *rest in rows]
    return spark.createDataFrame(parsed, ORDERS)


def items(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def products(spark, ids, category=lambda i: i % 3):
    rows = [(i, f"product {i}", category(i), f"category {category(i)}") for i in ids]
    return spark.createDataFrame(rows, PRODUCTS)
