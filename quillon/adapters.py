"""Star-schema tables as lifecycle rows and external series, so that the engine can run over them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.config import Objective, Settings, Signal

AS_OF, START = date(2001, 6, 30), date(1995, 1, 1)
COUNTRIES = ("AMERICA", "ASIA", "EUROPE", "MEA")  # AFRICA is left out: an unknown country
PROVIDER = "star"

SETTINGS = Settings(
    as_of=AS_OF,
    reporting_start=START,
    objectives=(
        Objective("NEW_HIRE_6M", "cohort", "at_least", 0.86, 6),
        Objective("SENIOR_HIRE_12M", "cohort", "at_least", 0.90, 12, ("1-URGENT",), ("1-URGENT", "2-HIGH")),
        Objective("REGRETTED_TURNOVER_12M", "turnover", "at_most", 0.075, 12),
    ),
    signals=(Signal("ship_lines", 25), Signal("ship_quantity", 90), Signal("order_count", 200), Signal("order_status", 10, "FIN")),
    effective_to=AS_OF,
    signal_grid_start=date(1994, 1, 1),
    countries=COUNTRIES,
    country_aliases={"MIDDLE EAST": "MEA"},
    level_aliases={"4-NOT SPECIFIED": "3-MEDIUM"},
    allowed={
        "business_unit": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
        "career_level": ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"),
        "employment_type": ("Permanent", "Fixed Term"),
        "source_system": ("HCM_A", "HCM_R", "HCM_N", "HCM_O"),
        "termination_type": ("Voluntary", "Involuntary", "End of Contract"),
    },
    geo_map={(PROVIDER, c): c for c in ("AMERICA", "ASIA", "EUROPE")} | {(PROVIDER, "MIDDLE EAST"): "MEA"},
    indicators={
        "ship_lines": ("activity", "Lines shipped", "lines", "M"),
        "ship_quantity": ("activity", "Quantity shipped", "pieces", "Q"),
        "order_count": ("demand", "Orders", "orders", "A"),
        "order_status": ("demand", "Orders by state", "orders", "M"),
        "rare_orders": ("demand", "Urgent orders of one nation", "orders", "M"),
    },
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey with the order's date, state, priority, segment, balance, nation and region."""
    t = lambda n: table(spark, sf_dir, n)
    geo = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    customers = t("customer").join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "c_acctbal", "n_name", "r_name")
    return t("orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"), "o_orderstatus", "o_orderpriority", "c_mktsegment", "c_acctbal", "n_name", "r_name")


def _dirt(clean, *cases):
    """clean, but for the first condition that holds its text."""
    out = None
    for condition, text in cases:
        out = F.when(condition, text) if out is None else out.when(condition, text)
    return out.otherwise(clean)


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row a line of an order, a version of its spell; orders without lines have one row.

    source_row orders the versions of a spell, and needs no order over all rows. Lines that are alike in all that a row is made
    of may be numbered either way; all others stand in one order, whenever and wherever they are read. Some rows are made dirty by their
    own values, so that every rule of the catalogue is broken by some."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("shipped"), "l_returnflag", "l_linenumber", "l_quantity")
    order = Window.partitionBy("l_orderkey").orderBy(F.asc_nulls_first("l_linenumber"), "shipped", "l_returnflag", "l_quantity")
    rows = places(spark, sf_dir).join(lines.withColumn("version", F.row_number().over(order)), F.col("o_orderkey") == F.col("l_orderkey"), "left")  # numbered while narrow
    kind = F.when(F.col("o_orderstatus") == "F", "Voluntary").when(F.col("o_orderstatus") == "O", "Involuntary").otherwise("End of Contract")
    hired, left = F.date_format("ordered", "yyyy-MM-dd"), F.coalesce(F.date_format("shipped", "yyyy-MM-dd"), F.lit(""))
    poor, few = F.col("c_acctbal"), F.col("l_quantity")
    return rows.select(
        F.col("o_orderkey").cast("string").alias("employee_id"), _dirt(F.col("r_name"), (poor < -900, " ")).alias("country_code"), F.col("c_mktsegment").alias("business_unit"),
        F.col("n_name").alias("job_family"), F.col("o_orderpriority").alias("career_level"), F.when(poor >= 0, "Permanent").otherwise("Fixed Term").alias("employment_type"),
        _dirt(hired, (poor.between(-900, -800), ""), (poor.between(-800, -700), F.date_format("ordered", "yyyy-MM"))).alias("hire_date"),
        _dirt(left, (few == 1, ""), ((few == 2) & (poor < 0), "soon")).alias("termination_date"),
        _dirt(F.when(F.col("l_orderkey").isNotNull(), kind).otherwise(""), (few == 3, "")).alias("termination_type"),
        F.when(F.col("l_returnflag") == "R", "true").when(F.col("l_returnflag") == "N", "false").otherwise("").alias("regretted_exit"),
        F.concat(F.lit("HCM_"), F.coalesce("l_returnflag", F.lit("O"))).alias("source_system"), F.date_format(F.coalesce("shipped", "ordered"), "yyyy-MM-dd").alias("record_updated_at"),
        (F.col("o_orderkey") * 1000 + F.coalesce("version", F.lit(1))).alias("source_row"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly, quarterly and yearly series by region, and sparse monthly ones by nation, as a provider would send them.

    Lines and orders are summed once, by month; all series are unfolded from those sums and summed again."""
    p = places(spark, sf_dir)
    month = lambda d: F.date_format(d, "yyyy-MM")
    none = F.lit(None).cast("string")

    def part(when, name: str, frequency: str, geo: str, period, release, value):
        return F.when(when, F.struct(F.lit(name).alias("indicator_id"), F.lit(frequency).alias("frequency"), F.col(geo).alias("geo"), period.alias("source_period"), release.alias("release_code"), F.lit("all").alias("copy"), value.cast("long").alias("value")))

    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("m"), F.col("l_quantity").cast("long").alias("pieces"))
    lines = lines.join(p.select("o_orderkey", "r_name"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("r_name", "m").agg(F.count("*").alias("n"), F.sum("pieces").alias("pieces"))
    quarter = F.concat(F.year("m"), F.lit("-Q"), F.quarter("m"))
    shipped = [part(F.lit(True), "ship_lines", "M", "r_name", month("m"), none, F.col("n")), part(F.lit(True), "ship_quantity", "Q", "r_name", quarter, none, F.col("pieces"))]
    orders = p.groupBy("r_name", "n_name", F.trunc("ordered", "month").alias("m"), "o_orderstatus", (F.col("o_orderpriority") == "1-URGENT").alias("urgent")).agg(F.count("*").alias("n"))
    open_, urgent = F.col("o_orderstatus") == "P", F.col("urgent")
    rare = urgent & open_
    ordered = [
        part(F.lit(True), "order_count", "A", "r_name", F.year("m").cast("string"), none, F.col("n")),
        part(~open_, "order_status", "M", "r_name", month("m"), F.when(F.col("o_orderstatus") == "F", "FIN").otherwise("FLS"), F.col("n")),
        part(rare, "rare_orders", "M", "n_name", month("m"), none, F.col("n")),
        # a value that came twice, one that can't be read, and one that is missing
        part(rare & (F.month("m") == 2), "rare_orders", "M", "n_name", month("m"), none, F.col("n")).withField("copy", F.lit("again")),
        part(rare & (F.month("m") == 3), "rare_orders", "M", "n_name", F.concat(month("m"), F.lit("?")), none, F.col("n")),
        part(rare & (F.month("m") == 4), "rare_orders", "M", "n_name", F.concat(F.year("m"), F.lit("-01")), F.lit("LATE"), F.lit(None)),
    ]
    unfolded = [df.select(F.explode(F.array_compact(F.array(*parts))).alias("x")).select("x.*") for df, parts in ((lines, shipped), (orders, ordered))]
    key = ["indicator_id", "frequency", "geo", "source_period", "release_code"]
    out = unfolded[0].unionByName(unfolded[1]).groupBy(*key, "copy").agg(F.sum("value").cast("double").alias("value"))
    few = F.col("value") <= 1
    return out.select(
        "indicator_id", F.lit(PROVIDER).alias("provider"), F.concat(F.lit("set_"), "indicator_id").alias("dataset"), "frequency", "geo", "source_period", "release_code", "value",
        F.when(few, "p").alias("status"), F.when(few, "provisional").alias("status_label"), F.concat("source_period", F.lit("T00:00")).alias("source_updated"),
        F.lit("2001-07-01").alias("fetched_at"), F.sha2("indicator_id", 256).alias("snapshot_sha256"),
    )
