"""Contact and scored tables derived from ``orders`` and ``customer``.

One contact per order. Every expression is integer arithmetic followed by at most one division,
so any engine gives the same bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv

WEEKDAYS = fv.ALLOWED_VALUES["day_of_week"]
MONTHS = fv.ALLOWED_VALUES["month"]
#: Job of a market segment; FURNITURE stays a value outside the allowed jobs.
JOBS = {
    "AUTOMOBILE": "technician", "BUILDING": "blue-collar",
    "HOUSEHOLD": "housemaid", "MACHINERY": "admin.",
}


def _pick(position, names):
    """Name at a 0-based position."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), (position + 1).cast("int"))


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact table with a leading ``contact_id``.

    The join is left to Catalyst: a small ``customer`` is broadcast by its measured size, a large
    one is shuffled, and adaptive execution splits a customer that holds many orders.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    order, cust = F.col("o_orderkey"), F.col("c_custkey")
    month_no = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    never = cust % 3 != 0
    pdays = F.when(never, 999).otherwise(((order * 13) % 120).cast("int"))
    threshold = F.when(never, 6).when(order % 4 == 1, 55).otherwise(15)

    def tenths(units):
        return units.cast("double") / 10

    def yes_if(condition):
        return (
            F.when(cust % 41 == 0, fv.MISSING_MARKER).when(condition, "yes").otherwise("no")
        )

    education = (
        "basic.4y", "basic.6y", "basic.9y", "high.school", "professional.course",
        fv.MISSING_MARKER, "university.degree", "university.degree",
    )
    job = F.when(cust % 11 == 0, fv.MISSING_MARKER)
    for segment, name in JOBS.items():
        job = job.when(F.col("c_mktsegment") == segment, name)
    return orders.join(customer, cust == F.col("o_custkey")).select(
        order.alias("contact_id"),
        (17 + (cust * 31) % 90).cast("int").alias("age"),
        job.otherwise(F.lower("c_mktsegment")).alias("job"),
        F.when(cust % 53 == 0, fv.MISSING_MARKER)
        .when(F.col("c_nationkey") % 4 == 1, "single")
        .when(F.col("c_nationkey") % 4 == 2, "divorced")
        .otherwise("married").alias("marital"),
        _pick(cust % 8, education).alias("education"),
        F.when(F.col("c_acctbal") < -500, "yes")
        .when(cust % 5 == 0, fv.MISSING_MARKER)
        .otherwise("no").alias("default"),
        yes_if(cust % 2 == 0).alias("housing"),
        yes_if(cust % 6 == 0).alias("loan"),
        F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2", "3"), "cellular")
        .otherwise("telephone").alias("contact"),
        _pick(F.month("o_orderdate") - 1, MONTHS).alias("month"),
        _pick(order % 5, WEEKDAYS).alias("day_of_week"),
        (order % 600).cast("int").alias("duration"),
        (1 + (order * 7) % 9).cast("int").alias("campaign"),
        pdays.alias("pdays"),
        F.when(never, 0).otherwise((order % 4).cast("int")).alias("previous"),
        F.when(never, "nonexistent").when(order % 4 == 1, "success")
        .otherwise("failure").alias("poutcome"),
        tenths(month_no % 49 - 34).alias("emp_var_rate"),
        F.when(order % 97 != 0, tenths(922 + month_no % 27)).alias("cons_price_idx"),
        tenths((order * 29 + month_no) % 340 - 508).alias("cons_conf_idx"),
        tenths(6 + order % 45).alias("euribor3m"),
        (4963 + (month_no * 7) % 266).cast("double").alias("nr_employed"),
        F.when((order * 17 + cust) % 100 < threshold, "yes").otherwise("no").alias("y"),
        ((order * 37 + cust * 11) % 701).alias("_h"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts with ``p_yes`` and ``prediction`` standing in for a model's output."""
    return add_stand_in_score(contacts(spark, sf_dir))


def add_stand_in_score(df: DataFrame) -> DataFrame:
    p_yes = (F.col("_h") + F.when(F.col("y") == "yes", 300).otherwise(150)).cast("double") / 1000
    return (
        df.withColumn("p_yes", p_yes)
        .withColumn("prediction", F.when(F.col("p_yes") > 0.5, 1.0).otherwise(0.0))
        .drop("_h")
    )


def contact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contacts(spark, sf_dir).drop("_h")
