"""End-to-end runs: survey-shaped inputs derived from the supplied tables.

``survey_inputs(spark, d)`` turns the order and line tables into the two wide
survey tables (raw headers, free text with notes, clauses, ranges, 12-hour
times, two-digit-year dates, missing values), one visit per order and one
sighting per line, so the whole normalisation runs on data whose size grows
with the tables. ``run_pipeline`` stages, normalises, optionally merges into a
store, audits and reports.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyspark.plans.survey import REPORT_TABLES, normalize_survey, survey_audit, survey_report
from tidyspark.sources.headers import normalize_headers
from tidyspark.sources.tables import write_report


def _load(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


EVEN = 1.25                   # a core's share of the rows that a piece may hold before rows are dealt out
PIECE_ROWS = 2_000_000        # about the most rows of a dealt piece


def _spread(df: DataFrame) -> DataFrame:
    """Stored rows that are read in uneven pieces, or in fewer than there are cores, are dealt out evenly.

    Making and parsing the texts takes far longer than reading the short rows that they are made of, and a
    row group is read by one task however many pieces its file is cut into. So the rows of the pieces are counted
    (without reading a column). Rows are dealt by their place, which is the same whenever a task is run again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df.groupBy(F.spark_partition_id().alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    rows, fullest = pieces.agg(F.sum("n"), F.max("n")).first()
    if not rows or fullest <= EVEN * rows / cores:
        return df
    waves = math.ceil(rows / (cores * PIECE_ROWS))
    return (df.withColumn("__place", F.monotonically_increasing_id()).repartition(cores * waves, "__place")
            .drop("__place"))


def survey_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c, n, r = _load(spark, d, "customer"), _load(spark, d, "nation"), _load(spark, d, "region")
    o = _spread(_load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                                 "o_orderpriority"))
    li = _spread(_load(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                                                    "l_returnflag", "l_linestatus"))
    s = _load(spark, d, "supplier")
    # a part's texts are made once, not for each of its lines
    p = _load(spark, d, "part").select(
        "p_partkey", "p_brand", "p_size", F.initcap("p_type").alias("p_type"),
        F.regexp_replace(F.initcap("p_name"), " ", ", ").alias("p_name"))

    sectioned = F.col("o_orderstatus") == "P"
    minutes = (F.col("o_orderkey") % 90 + 10).cast("int")
    start = F.col("o_orderdate") + F.make_dt_interval(
        hours=F.lit(12) + (F.col("o_custkey") % 11).cast("int"), mins=(F.col("o_orderkey") % 60).cast("int"))
    size = F.col("o_orderkey") % 40 + 30
    visits = (o.join(c, o.o_custkey == c.c_custkey, "left")
              .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
              .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
              .select(
                  F.upper("r_name").alias("Area Name"),
                  F.substring("r_name", 1, 1).alias("Area ID"),
                  F.when(sectioned, F.concat(F.initcap("n_name"), F.lit(" Park (Section "),
                                             F.substring("o_orderpriority", 3, 20), F.lit(")")))
                   .otherwise(F.concat(F.initcap("n_name"), F.lit(" Park"))).alias("Park Name"),
                  F.when(sectioned, F.concat_ws(".", F.col("n_nationkey").cast("string"),
                                                F.substring("o_orderpriority", 1, 1)))
                   .otherwise(F.col("n_nationkey").cast("string")).alias("Park ID"),
                  F.date_format("o_orderdate", "M/d/yy").alias("Date"),
                  F.date_format(start, "h:mm:ss a").alias("Start Time"),
                  F.date_format(start + F.make_dt_interval(mins=minutes), "h:mm:ss a")
                   .alias("End Time"),
                  F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("string"))
                   .otherwise(minutes.cast("string"))
                   .alias("Total Time (in minutes, if available)"),
                  F.when(F.col("o_orderpriority").startswith("1"),
                         F.concat(F.lit("Full, "), F.lower("c_mktsegment"), F.lit(" outing")))
                   .when(F.col("o_orderpriority").startswith("2"), F.lit('"Lovely" - warden'))
                   .otherwise(F.substring("o_orderpriority", 3, 20)).alias("Park Conditions"),
                  F.concat(F.lit("Geese, "), F.initcap("c_mktsegment"), F.lit(" ("),
                           (F.col("o_custkey") % 4).cast("string"), F.lit(", asleep), "),
                           F.initcap("n_name"), F.lit(" Birds")).alias("Other Animal Sightings"),
                  F.when(F.col("o_orderstatus") == "O", F.lit("Little, near the gate"))
                   .when(F.col("o_orderstatus") == "F", F.lit(None).cast("string"))
                   .otherwise(F.lit("Nothing")).alias("Litter"),
                  F.when(F.col("o_orderpriority").startswith("5"), F.lit("damp, dim"))
                   .when(F.col("o_orderpriority").startswith("4"),
                         F.concat(size.cast("string"), F.lit("-odd degrees, but hazy!")))
                   .otherwise(F.concat(size.cast("string"), F.lit(" degrees, "),
                                       F.lower("o_orderstatus"), F.lit(", misty, hazy with showers")))
                   .alias("Temperature & Weather")))

    sightings = (li.join(p, li.l_partkey == p.p_partkey, "left")
                 .join(s, li.l_suppkey == s.s_suppkey, "left")
                 .select(
                     F.concat(F.lit("S-"), F.col("l_partkey").cast("string")).alias("SquirrelID"),
                     F.col("s_nationkey").cast("string").alias("Park ID"),
                     F.col("p_type").alias("Primary Fur Color"),
                     F.col("p_name").alias("Highlights in Fur Color"),
                     F.col("p_brand").alias("Color Notes"),
                     F.when(F.col("l_returnflag") == "R",
                            F.concat(F.lit("<"), F.col("p_size").cast("string")))
                      .when(F.col("l_returnflag") == "A",
                            F.concat(F.col("p_size").cast("string"), F.lit("-"),
                                     (F.col("p_size") + 5).cast("string")))
                      .otherwise(F.lit(None).cast("string")).alias("Above Ground (Height in Feet)"),
                     F.when(F.col("l_linestatus") == "O", F.lit("Low Wall"))
                      .otherwise(F.lit("Up High (roof, gutter)")).alias("Location"),
                     F.lit(None).cast("string").alias("Specific Location"),
                     F.concat("p_name", F.lit(" ("),
                              F.col("l_quantity").cast("int").cast("string"), F.lit(")"))
                      .alias("Activities"),
                     F.when(F.col("l_discount") > 0.05, F.lit("Curious, Begs"))
                      .otherwise(F.lit("Flees")).alias("Interactions with Humans"),
                     F.lit(None).cast("string").alias("Other Notes or Observations"),
                     (F.lit(40.7) + F.col("l_extendedprice") / 1e6).alias(
                         "Squirrel Latitude (DD.DDDDDD)"),
                     (F.lit(-73.9) - F.col("l_discount")).alias("Squirrel Longitude (-DD.DDDDDD)")))
    return visits, sightings


def run_pipeline(spark: SparkSession, visits: DataFrame, sightings: DataFrame,
                 store: str | None = None, report_dir: str | None = None,
                 **stage_opts) -> dict[str, DataFrame]:
    """Normalise (and merge into ``store``), then audit and report.

    With ``report_dir`` each report is also written to the folder
    ``<report_dir>/query_N`` as one headed CSV file (reports are a few rows per
    park, area or activity).
    """
    t = normalize_survey(spark, normalize_headers(visits), normalize_headers(sightings),
                         store=store, **stage_opts)
    out = dict(t)
    out["audit"] = survey_audit(t)
    reps = {name: survey_report(t, name) for name in REPORT_TABLES}
    out.update(reps)
    if report_dir is not None:
        for name, df in reps.items():
            write_report(df, f"{report_dir.rstrip('/')}/{name}", single_file=True)
    return out


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The full pipeline on tables derived from ``d``: runs the audit, returns the Q5 report."""
    visits, sightings = survey_inputs(spark, d)
    out = run_pipeline(spark, visits, sightings)
    bad = out["audit"].where("violations > 0").collect()     # one row per rule at most
    if bad:
        raise ValueError(f"audit: {bad}")
    return out["query_5"]
