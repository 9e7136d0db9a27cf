"""Domain inputs derived from the star-schema tables of a data folder.

Raw usage, forecast and settlement records as a landed file would hold them: text, messy headers, repeated
deliveries, blank rows, unreadable values, several spellings of a key. Every row comes from a row of the given
tables, so the inputs grow with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _dec(value: Column, precision: int = 18, scale: int = 2) -> Column:
    return value.cast(f"decimal({precision},{scale})")


def _line_items(spark: SparkSession, folder: str, gathered_by: str | None = None) -> DataFrame:
    """Line items with their order, customer, part and supplier, and both nations.

    Customers meet the orders, which are fewer than the line items, so these move for parts, orders and suppliers only, three times
    at most. Suppliers are broadcast far beyond the size where parts and orders are not; they come last, so that their names do not
    move with the line items. Nations go as keys until the end. Where rows are gathered by a column of the supplier they move for that
    too, before the customer's nation comes.
    """
    nation = table(spark, folder, "nation")
    customer_nation = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_nation"), F.col("n_regionkey").alias("r_regionkey")
    )
    supplier_nation = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_nation"))
    orders = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    # Amounts, days and the two tests on exact values: what the records need of these columns, and narrower to move.
    lines = table(spark, folder, "lineitem").withColumns(
        {
            "l_small": F.col("l_quantity") <= 10,
            "l_taxed": F.col("l_tax") > 0.04,
            "l_quantity": _dec(F.col("l_quantity")),
            "l_extendedprice": _price(),
            "l_discount": _dec(F.col("l_discount"), 5),
            "l_tax": _dec(F.col("l_tax"), 5),
            "l_shipdate": F.col("l_shipdate").cast("date"),
        }
    )
    supplied = (
        lines.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(supplier_nation, "s_nationkey")
    )
    if gathered_by:
        supplied = supplied.repartition(gathered_by)
    return supplied.join(customer_nation, "c_nationkey").join(table(spark, folder, "region"), "r_regionkey")


def _price() -> Column:
    return _dec(F.col("l_extendedprice"))


def _net() -> Column:
    return _price() * (F.lit(1) - _dec(F.col("l_discount"), 5))


def _with_tax(value: Column) -> Column:
    return value * (F.lit(1) + _dec(F.col("l_tax"), 5))


def usage_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Usage records: one per line item, small ones delivered twice, and some blank rows."""
    copies = F.array_compact(
        F.array(F.lit(0), F.when(F.col("l_small"), 1), F.when(F.col("l_orderkey") % 211 == 0, 2))
    )
    lines = _line_items(spark, folder).withColumn("copy", F.explode(copies))
    odd = F.col("l_linenumber") % 2 == 1
    iso = F.date_format("l_shipdate", "yyyy-MM-dd")
    columns = {
        "Client Operator": F.when(odd, F.concat(F.lit(" "), F.lower("c_nation"))).otherwise(F.col("c_nation")),
        "RP-TADIG": F.when(F.col("s_suppkey") % 37 == 1, "").when(F.col("s_suppkey") % 37 != 0, F.col("s_name")),
        "Roaming Partner Country": F.col("s_nation"),
        "File Direction": F.col("l_returnflag"),
        "Call Date": F.when(F.col("l_partkey") % 101 == 0, F.date_format("l_shipdate", "dd/MM/yyyy"))
        .when(odd, iso)
        .otherwise(F.date_format("l_shipdate", "yyyyMMdd")),
        "Call Month": F.date_format("l_shipdate", "yyyy-MM"),
        "Call Type": F.col("o_orderpriority"),
        "Call Type Level 2": F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")),
        "IMSI": F.col("o_custkey"),
        "Subscriber Profile": F.when(F.col("l_linenumber") == 4, "VISITOR").otherwise(F.col("c_mktsegment")),
        "APN": F.when(F.col("p_size") % 10 != 0, F.col("p_brand")),
        "Service Type ID": F.col("p_type"),
        "Event Type ID": F.col("o_orderstatus"),
        "RAT Type": F.col("p_size") % 4,
        "TAC Number": F.col("p_partkey") % 100,
        "IoT RTI Group ID": F.col("s_nationkey"),
        "Destination": F.col("c_nation"),
        "Destination Category": F.col("r_name"),
        "Is CAMEL": F.when(F.col("l_taxed"), "Y").otherwise("N"),
        "Billed Minutes": F.when(F.col("l_orderkey") % 97 == 0, "n/a").otherwise(
            _dec(F.col("l_quantity")).cast("string")
        ),
        "Duration": F.lit("0"),
        "Billed Data Volume (MB)": _price(),
        "CDR Count": F.col("l_linenumber"),
        "Total Charge SDR Net": _dec(_net(), 18, 6),
        "Total Charge SDR Gross": _dec(_with_tax(_net()), 18, 6),
        "Source System": F.lit("synthetic"),
        "Batch ID": F.col("o_orderstatus"),
    }
    blank = F.col("copy") == 2
    empty = F.when(odd, F.lit(None).cast("string")).otherwise("")
    return lines.select(
        *[F.when(blank, empty).otherwise(value.cast("string")).alias(name) for name, value in columns.items()]
    )


def forecast_raw(spark: SparkSession, folder: str, gathered_by: str | None = None) -> DataFrame:
    """Forecast and actual records with upper-case headers; on demand, rows of equal values in a column of the supplier are gathered in one task."""
    lines = _line_items(spark, folder, gathered_by)
    period = F.concat(F.date_format("l_shipdate", "yyyy-MM"), F.lit("-01T00:00:00"))
    quantity = _dec(F.col("l_quantity"))
    discount = _price() * _dec(F.col("l_discount"), 5)
    known_volume = F.when(F.col("l_partkey") % 103 != 0, quantity)
    volume = F.when((F.col("c_nationkey") == 7) & (F.col("l_linestatus") == "F"), F.lit(0)).otherwise(known_volume)
    columns = {
        "CLIENT_NAME": F.when(F.col("o_custkey") % 89 != 0, F.col("c_nation")),
        "CLIENT_GROUP_NAME": F.when(F.col("o_custkey") % 89 != 0, F.col("r_name")),
        "PARTNER_NAME": F.col("s_name"),
        "PARTNER_GROUP_NAME": F.col("s_nation"),
        "SERVICE_TYPE": F.col("p_type"),
        "EVENT_TYPE": F.col("o_orderstatus"),
        "TRAFFIC_DIRECTION": F.when(F.col("l_returnflag") == "R", "CR").otherwise("VR"),
        "PERIOD_START_DATE": period,
        "CR_PERIOD_START_DATE": period,
        "DESTINATION_TYPE": F.col("c_mktsegment"),
        "AGREEMENT_REFERENCE": F.when(
            F.col("s_suppkey") % 41 != 0, F.concat(F.lit("AGR_"), (F.col("s_suppkey") % 50).cast("string"))
        ),
        "RTI_GROUP": F.col("p_brand"),
        "FORECAST_OR_ACTUAL_IND": F.when(F.col("l_orderkey") % 83 == 0, "X")
        .when(F.col("l_linestatus") == "O", "F")
        .otherwise("A"),
        "TRAFFIC_VOLUME": _dec(volume, 20, 2),
        "CHARGED_VOLUME": _dec(quantity * (F.lit(1) - _dec(F.col("l_discount"), 5)), 20, 2),
        "TAP_CHARGE_SDR_NET": _dec(_net(), 20, 5),
        "TAP_CHARGE_SDR_GROSS": _dec(_with_tax(_net()), 20, 5),
        "DISC_CHARGE_SDR_NET": _dec(discount, 20, 5),
        "DISC_CHARGE_SDR_GROSS": _dec(_with_tax(discount), 20, 5),
        "NO_OF_RECORDS": F.lit(1),
        "EXTRACT_NOTE": F.lit("not loaded"),
    }
    return lines.select(*[value.cast("string").alias(name) for name, value in columns.items()])


# The date spellings a landed settlement file mixes.
SETTLEMENT_DATE_FORMATS = (
    "yyyy-MM-dd", "dd-MMM-yy", "dd/MM/yyyy", "MM/dd/yyyy", "dd/MM/yy", "MM/dd/yy", "yyyy/MM/dd",
)


def _spelled_date(day: Column) -> Column:
    """The date in one of the seven spellings, by order key."""
    spelled = F.when(F.lit(False), "")
    for i, pattern in enumerate(SETTLEMENT_DATE_FORMATS):
        spelled = spelled.when(F.col("o_orderkey") % 7 == i, F.date_format(day, pattern))
    return spelled


def _spelled_amount(amount: Column) -> Column:
    """The amount as plain digits, with thousands commas, or in exponent notation, by order key."""
    cents = (amount * 100).cast("bigint")
    whole = F.floor(cents / 100).cast("bigint")
    grouped = F.concat(
        F.floor(whole / 1000).cast("bigint").cast("string"),
        F.lit(","),
        F.lpad((whole % 1000).cast("string"), 3, "0"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
    plain = amount.cast("string")
    return (
        F.when(F.col("o_orderkey") % 97 == 0, "n/a")
        .when(F.col("o_orderkey") % 3 == 0, plain)
        .when(F.col("o_orderkey") % 3 == 1, F.when(whole >= 1000, grouped).otherwise(plain))
        .otherwise(F.concat(cents.cast("string"), F.lit("E-2")))
    )


def settlement_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Settlement records, one per order, with title-case headers."""
    orders = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    price = _dec(F.col("o_totalprice"))
    day = F.col("o_orderdate")
    columns = {
        "Row Id": F.lpad(F.col("o_orderkey").cast("string"), 12, "0"),
        "Home PMN": F.when(F.col("o_custkey") % 50 == 0, "")
        .when(F.col("o_custkey") % 50 == 1, "  ")
        .otherwise(F.concat(F.lit("HOME"), (F.col("o_custkey") % 20).cast("string"))),
        "Home Operator": F.col("c_mktsegment"),
        "Traffic Direction": F.when(F.col("o_orderkey") % 2 == 0, "CR").otherwise("VR"),
        "Service Type": F.col("o_orderpriority"),
        "Event Type": F.col("o_orderstatus"),
        "Partner Name": F.col("c_name"),
        "Partner PMN": F.when(
            F.col("o_custkey") % 50 != 2, F.concat(F.lit("PMN"), F.col("c_nationkey").cast("string"))
        ),
        "Country": F.col("n_name"),
        "Traffic Period": F.when(F.col("o_orderkey") % 53 == 0, "").otherwise(_spelled_date(day)),
        "Agreement Reference": F.concat(F.lit("AGR_"), (F.col("o_custkey") % 50).cast("string")),
        "Agreement Start Date": _spelled_date(F.date_sub(day.cast("date"), 30)),
        "Agreement End Date": F.when(F.col("o_orderkey") % 59 == 0, "open").otherwise(
            _spelled_date(F.date_add(day.cast("date"), 335))
        ),
        "Currency": F.lit("SDR"),
        "Conversion Rate": F.when(F.col("o_orderkey") % 5 == 0, "1.02886535219e-7").otherwise("1.25"),
        "Settlement Status": F.col("o_orderstatus"),
        "Traffic Volume": F.concat((price * 100).cast("bigint").cast("string"), F.lit("E-12")),
        "TAP Charges (Excl. Tax)": _spelled_amount(price),
        "TAP Charges (Incl. Tax)": _spelled_amount(_dec(price * F.lit("1.19").cast("decimal(3,2)"))),
        "Settled Amount Excl Tax": F.when(F.col("o_orderstatus") == "F", price.cast("string")).otherwise(""),
        "Traffic Volume Not Rounded": price.cast("string"),
        "Internal Note": F.lit("not loaded"),
    }
    return orders.select(*[value.cast("string").alias(name) for name, value in columns.items()])
