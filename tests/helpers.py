"""Hand-made raw source frames for edge-case tests."""

from __future__ import annotations

import datetime as dt

from tidewater.sources import RawSources
from tidewater.sources.contracts import CONTRACTS


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def customer(cid, signup="2000-01-01 00:00:00", deleted=False):
    return (cid, f"c{cid}@x", "F", "L", "F", 30, "CA", ts(signup), True, deleted)


def order(oid, cid, at, status="completed", discount=0.0, shipping=5.0, deleted=False):
    return (oid, cid, ts(at), status, discount, shipping, deleted)


def item(iid, oid, pid=1, qty=1, unit=10.0, total=None):
    return (iid, oid, pid, qty, unit, unit * qty if total is None else total)


def product(pid, base=20.0, cost=8.0):
    return (pid, f"SKU-{pid}", f"p{pid}", "cat", "sub", base, cost, True, ts("2000-01-01 00:00:00"))


def payment(oid, amount=15.0, at="2000-01-01 00:00:00"):
    return (f"pi_{oid}", oid, amount, "usd", "paypal", "succeeded", ts(at))


def event(eid, cid, etype, channel, at):
    return (eid, cid, etype, channel, ts(at), None, f"s{eid}")


def raw(spark, customers=(), orders=(), items=(), products=(), payments=(), events=()) -> RawSources:
    def mk(rows, name):
        return spark.createDataFrame(list(rows), schema=CONTRACTS[name])

    return RawSources(
        customers=mk(customers, "raw_customers"),
        orders=mk(orders, "raw_orders"),
        order_items=mk(items, "raw_order_items"),
        products=mk(products, "raw_products"),
        payments=mk(payments, "raw_payments"),
        events=mk(events, "raw_events"),
    )
