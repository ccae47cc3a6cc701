"""Panels derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakescore.params import ScoringParams
from stakescore.schemas import HEIGHT, OPERATOR, PANEL_COLUMNS

#: Parameters of the weekly panel (heights 156..513).
TEST = ScoringParams(
    accept_rate=0.08, concentration_level=0.9, vote_score=2, propose_score=6, A=9, B=4, C=2, D=4,
    vote_proposed_win_size=8, combine_win_size=4, label_win_size=12,
    start_block=180, end_block=300, top_validators=8,
)
TEST_BATCH_SIZE = 87
#: Small enough for the weekly panel to span several chunks.
TEST_CHUNK = 64
#: Heights per chunk of run lists: the minutes of a year span many, the weekly panel some.
TEST_RUN_CHUNK = 96
#: Buckets of the stored weekly panel.
TEST_BUCKETS = 4
#: Last heights of the increments; the last one reaches the panel's end.
TEST_INCREMENTS = (260, 350, 430, 513)


def weekly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (week, supplier) of ``lineitem``, with gaps per supplier."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # Whole numbers up to the last bits, so this is their rounding (round() goes through decimals).
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    percent = F.floor(F.col("l_discount") * 100 + 0.5)
    accepted = F.col("l_returnflag") == "A"
    amount = "decimal(38,0)"
    weeks = line.groupBy(
        F.expr("cast(datediff(l_shipdate, date'1992-01-01') div 7 as int)").alias(HEIGHT), F.col("l_suppkey").alias("_s")
    ).agg(
        F.sum(cents).cast(amount).alias("tokens"),
        (F.sum(F.col("l_quantity").cast("bigint")) * 1_000_000).cast(amount).alias("delegator_shares"),
        F.sum(F.when(F.col("l_returnflag") == "R", cents).otherwise(F.lit(0))).cast(amount).alias("self_bonded"),
        (F.max(percent) * 1e16).alias("commission_rate"),
        F.max(F.when(F.col("l_returnflag") != "N", accepted)).alias("vote"),
        F.max(F.when(F.col("l_linestatus") == "F", accepted)).alias("propose"),
    )
    supplier, height = F.col("_s"), F.col(HEIGHT)
    return weeks.withColumns({
        OPERATOR: F.concat(F.lit("val"), supplier.cast("string")),
        "jailed": F.when((supplier * 31 + height) % 211 != 0, (supplier + height) % 23 == 0),
        "status": F.when(supplier % 7 == 0, F.lit("BOND_STATUS_UNBONDED"))
        .when(supplier % 7 == 1, F.lit("BOND_STATUS_UNBONDING"))
        .otherwise(F.lit("BOND_STATUS_BONDED")),
    }).select(*PANEL_COLUMNS)


def minute_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minutes since 2024-01-01 of ``events`` as heights, with gaps."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.expr("cast(timestampdiff(MINUTE, timestamp_ntz'2024-01-01 00:00:00', ts) as int)").alias(HEIGHT)
    )


def damaged_panel(panel: DataFrame) -> DataFrame:
    """The panel as it was before corrections: of some weeks amounts and votes are wrong, rows are missing, or validators are
    listed that were not there; a hundredth of the rows in all.
    """
    wrong = F.col(HEIGHT).between(340, 341)
    number = F.substring(OPERATOR, 4, 10).cast("int")
    missing = F.col(HEIGHT).isin(167, 300) & (number % 3 == 0)
    extra = panel.filter((F.col(HEIGHT) == 250) & (number % 4 == 0)).withColumn(OPERATOR, F.concat(F.lit("no"), OPERATOR))
    return panel.filter(~missing).withColumns({
        "tokens": F.when(wrong, F.col("tokens") * 2).otherwise(F.col("tokens")).cast("decimal(38,0)"),
        "vote": F.when(wrong, ~F.col("vote")).otherwise(F.col("vote")),
    }).unionByName(extra)
