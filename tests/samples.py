"""Order rows for the tests."""

from decimal import Decimal


def order(order_id, created_at="2025-03-09 08:41:00", amount="73.40", status="PLACED", **over):
    row = {
        "customer": "Ada Example",
        "restaurant": "Corner Kitchen",
        "item": "Lentil Soup",
        **over,
    }
    return (
        order_id,
        row["customer"],
        row["restaurant"],
        row["item"],
        None if amount is None else Decimal(amount),
        status,
        created_at,
    )


def ids(frame):
    return sorted(r["order_id"] for r in frame.select("order_id").collect())
