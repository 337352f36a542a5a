"""A deterministic dirty view of the orders table: every kind of defect at a known rate, whatever the scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import ITALIAN_MONTHS
from plumbline.sources.tables import load, spread

COLUMNS = (
    "_id", "rata", "anno", "mese", "spesa", "SPESA TOTALE", "aggregation-time", "cod_stato", "priorita", "stato",
    "area_geografica", "note", "quota", "fonte_dato",
)


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = spread(load(spark, folder, "orders"))
    k, date = F.col("o_orderkey"), F.col("o_orderdate")

    def each(n: int) -> Column:
        return k % n == 0

    def text(fmt: str) -> Column:
        return F.date_format(date, fmt)

    months = F.array(*[F.lit(m) for m in ITALIAN_MONTHS])
    mon = F.element_at(months, F.month(date))
    year, month = F.year(date), F.month(date)
    amount = (F.floor(F.col("o_totalprice") / 50) * 50 + 0.25).cast("decimal(18,2)").cast("string")
    label = (
        F.when(F.col("o_orderstatus") == "F", "Finito").when(F.col("o_orderstatus") == "O", "Aperto").otherwise("Parziale")
    )
    priority = F.col("o_orderpriority")
    spend = (
        F.when(each(89), "N.D.")
        .when(each(83), F.concat(F.lit("€"), amount))
        .when(each(503), F.concat(F.lit("-"), amount))
        .when(each(79), None)
        .otherwise(amount)
    )
    # keys divisible by 97 appear twice
    copies = F.when(each(97), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    base = orders.select("*", F.explode(copies).alias("copy"))
    return base.select(
        F.concat(F.lit("ord"), k.cast("string")).alias("_id"),
        F.when(each(37), text("yyyy-MM")).when(each(41), F.concat(mon, F.lit("-"), text("yyyy"))).otherwise(text("yyyyMM")).alias("rata"),
        F.when(each(43), year % 100).when(each(53), year + 1).otherwise(year).cast("string").alias("anno"),
        F.when(each(211), F.lit(-1)).when(each(47), month % 12 + 1).otherwise(month).cast("string").alias("mese"),
        spend.alias("spesa"),
        spend.alias("SPESA TOTALE"),
        F.when(each(31), text("dd/MM/yyyy"))
        .when(each(29), text("dd.MM.yyyy"))
        .when(each(61), text("dd-MM-yy"))
        .when(each(67), text("yyyy/MM/dd"))
        .when(each(71), F.concat(mon, F.lit(" "), text("dd yyyy")))
        .otherwise(F.concat(text("yyyy-MM-dd"), F.lit("T00:00:00")))
        .alias("aggregation-time"),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "2").otherwise("3").alias("cod_stato"),
        F.when(each(997), "Da definire").when(each(19), F.lower(priority)).when(each(59), F.concat(priority, F.lit(" "))).otherwise(priority).alias("priorita"),
        F.when(each(101), "unknown").when(each(997), "Da definire").when(each(23), F.lower(label)).when(each(17), F.upper(label)).otherwise(label).alias("stato"),
        F.when(each(5), None).when(each(103), "n.d.").otherwise(F.concat(F.lit("area"), (F.col("o_custkey") % 7).cast("string"))).alias("area_geografica"),
        F.when(each(73), "verificare").alias("note"),
        F.when(k % 3 == 0, F.concat(amount, F.lit("0000000003"))).otherwise(amount).alias("quota"),
        F.when(each(107), "Sistema legacy").alias("fonte_dato"),
    )
