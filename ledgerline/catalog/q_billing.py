"""Rental billing (R1) and stock ledger (R2) over rentals derived from ``events``.

A rental per event: starts at ``ts``, lasts ``value * 4`` hours, basis from
the event type (click hourly, view daily, purchase weekly, signup an unknown
basis, error none), bikes from ``props.k mod 7`` (0 = invalid).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.catalog import register
from ledgerline.operators import billing
from ledgerline.session import table

INITIAL_STOCK = 500

_RENTALS_SQL = """
rentals AS (
  SELECT event_id AS rental_id,
    CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END AS basis,
    CAST(json_extract(props, '$.k') AS INTEGER) % 7 AS bikes,
    ts AS rented_at,
    ts + to_microseconds(CAST(round(value * 4 * 3600 * 1000000) AS BIGINT)) AS returned_at
  FROM events)"""


def rentals(spark, d):
    e = table(spark, d, "events")
    basis = (F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2)
             .when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 4))
    dur_us = F.round(F.col("value") * 4 * 3600 * 1_000_000).cast("bigint")
    return e.select(F.col("event_id").alias("rental_id"), basis.alias("basis"),
                    (F.get_json_object("props", "$.k").cast("int") % 7).alias("bikes"),
                    F.col("ts").cast("timestamp").alias("rented_at"),
                    F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + dur_us).alias("returned_at"))


@register("billing_bill", f"""
WITH {_RENTALS_SQL},
p AS (SELECT *, epoch_us(returned_at) - epoch_us(rented_at) AS us FROM rentals),
q AS (SELECT *, floor(us / 86400000000) AS days FROM p),
r AS (SELECT *, floor((us - days * 86400000000) / 1000000) AS secs FROM q),
b AS (SELECT rental_id, bikes, basis, rented_at,
        CASE basis WHEN 1 THEN round_even(secs / 3600.0, 0) * 5 * bikes
                   WHEN 2 THEN days * 20 * bikes
                   WHEN 3 THEN round_even(days / 7.0, 0) * 60 * bikes END AS raw FROM r)
SELECT rental_id,
  CAST(round(CASE WHEN rented_at IS NOT NULL AND COALESCE(basis <> 0, false) AND COALESCE(bikes <> 0, false)
            THEN CASE WHEN bikes BETWEEN 3 AND 5 THEN raw * 0.7 ELSE raw END END, 2) AS DECIMAL(18,2)) AS bill
FROM b""")
def billing_bill(spark, d):
    r = rentals(spark, d)
    return r.select("rental_id", F.round(billing.bill("rented_at", "returned_at", "basis", "bikes"), 2)
                    .cast("decimal(18,2)").alias("bill"))


@register("billing_stock_ledger", f"""
WITH {_RENTALS_SQL},
moves AS (SELECT rental_id, rented_at AS moved_at, 'rent' AS movement, 1 AS seq, 0 - CAST(bikes AS BIGINT) AS delta
          FROM rentals WHERE bikes > 0 AND rented_at IS NOT NULL
          UNION ALL
          SELECT rental_id, returned_at, 'return', 0, CAST(bikes AS BIGINT) FROM rentals
          WHERE bikes > 0 AND returned_at IS NOT NULL),
led AS (SELECT *, {INITIAL_STOCK} + SUM(delta) OVER (ORDER BY moved_at, seq, rental_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stock FROM moves)
SELECT rental_id, strftime(moved_at, '%Y-%m-%d %H:%M:%S.%f') AS moved_at, movement, delta, CAST(stock AS BIGINT) AS stock,
       stock < 0 AS below_zero FROM led""")
def billing_stock_ledger(spark, d):
    led = billing.stock_ledger(rentals(spark, d), INITIAL_STOCK)
    return led.withColumn("moved_at", F.date_format("moved_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
