"""The derived dirty table ``raw_orders`` (FIXTURES.md), for the cleaning operators.

The driver tables hold no nulls, orphans or bad strings, so raw rows are
derived from ``orders`` by fixed rules that any SQL engine can reproduce.
Every order is kept (some twice); nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the derivation rules (FIXTURES.md, "Derived dirty table").
NULL_CUSTOMER_EVERY = 97
PADDED_PRIORITY_EVERY = 89
BLANK_PRIORITY_EVERY = 83
BAD_AMOUNT_EVERY = 79
BAD_AMOUNT_TEXT = "n/a"
BAD_DATE_EVERY = 73
BAD_DATE_TEXT = "2001-13-40"
DOUBLED_ROW_EVERY = 50

RAW_ORDERS_DDL = "oid BIGINT, cid BIGINT, prio STRING, amt STRING, dt STRING"


def raw_orders(orders: DataFrame) -> DataFrame:
    """Raw order export with missing customers, padded or blank priorities,
    unparsable amounts and dates, and doubled rows.  Columns: ``oid``,
    ``cid``, ``prio``, ``amt``, ``dt`` (amounts and dates as text)."""
    k = F.col("o_orderkey")
    cid = F.when(k % NULL_CUSTOMER_EVERY == 0, F.lit(None).cast("bigint")) \
        .otherwise(F.col("o_custkey"))
    prio = (F.when(k % PADDED_PRIORITY_EVERY == 0,
                   F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" ")))
            .when(k % BLANK_PRIORITY_EVERY == 0, F.lit(""))
            .otherwise(F.col("o_orderpriority")))
    amt = F.when(k % BAD_AMOUNT_EVERY == 0, F.lit(BAD_AMOUNT_TEXT)) \
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    dt = F.when(k % BAD_DATE_EVERY == 0, F.lit(BAD_DATE_TEXT)) \
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
    copies = F.when(k % DOUBLED_ROW_EVERY == 0, F.lit(2)).otherwise(F.lit(1))
    return (orders.select(k.alias("oid"), cid.alias("cid"), prio.alias("prio"),
                          amt.alias("amt"), dt.alias("dt"),
                          F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"))
            .drop("_copy"))


# Fixed values of the rules of raw events (FIXTURES.md).
CUT_PROPS_EVERY = 61
TEXT_VALUE_EVERY = 53
EXTRA_KEY_EVERY = 47
NULL_VALUE_EVERY = 43
LIST_PROPS_EVERY = 41


def raw_events(events: DataFrame) -> DataFrame:
    """``event_id`` and ``props`` with broken documents, a value of another type, a
    further key, a null value and a list instead of an object."""
    k, p = F.col("event_id"), F.col("props")
    inner = F.substring(p, F.lit(2), F.length(p) - 2)
    props = (F.when(k % CUT_PROPS_EVERY == 0, F.substring(p, F.lit(1), F.length(p) - 1))
             .when(k % TEXT_VALUE_EVERY == 0, F.lit('{"k": "many"}'))
             .when(k % EXTRA_KEY_EVERY == 0,
                   F.concat(F.lit('{"source": "app", "deep": {"a": 1}, '), inner, F.lit("}")))
             .when(k % NULL_VALUE_EVERY == 0, F.lit('{"k": null}'))
             .when(k % LIST_PROPS_EVERY == 0, F.lit("[1, 2]"))
             .otherwise(p))
    return events.select("event_id", props.alias("props"))
