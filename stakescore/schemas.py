"""Declared tables: the input panel and the two sink tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType,
)

HEIGHT = "block_height"
OPERATOR = "operator_address"
KEY = (HEIGHT, OPERATOR)

_AMOUNT = DecimalType(38, 0)

#: One row per (block_height, operator_address); commission_rate is scaled by 10^18.
PANEL_SCHEMA = StructType([
    StructField(HEIGHT, IntegerType(), False),
    StructField(OPERATOR, StringType(), False),
    StructField("tokens", _AMOUNT),
    StructField("delegator_shares", _AMOUNT),
    StructField("self_bonded", _AMOUNT),
    StructField("commission_rate", FloatType()),
    StructField("jailed", BooleanType()),
    StructField("vote", BooleanType()),
    StructField("propose", BooleanType()),
    StructField("status", StringType()),
])
PANEL_COLUMNS = tuple(PANEL_SCHEMA.fieldNames())

#: Labelled buckets, key (block_height, operator_address).
BLOCK_LABEL_SCHEMA = StructType([
    StructField(OPERATOR, StringType()),
    StructField("commission_score", DoubleType()),
    StructField("voting_power_score", DoubleType()),
    StructField("tokens_proportion", DecimalType(30, 10)),
    StructField("commission_rate", DoubleType()),
    StructField("self_bonded", DecimalType(38, 4)),
    StructField("self_bonded_score", DoubleType()),
    StructField("delegator_shares", DecimalType(38, 4)),
    StructField("tokens", DecimalType(38, 4)),
    StructField("vote_propose_score", DoubleType()),
    StructField("label", DoubleType()),
    StructField(HEIGHT, IntegerType()),
    StructField("score", DoubleType()),
])

#: Per-block scores, key (block_height, operator_address).
VALIDATOR_SCORE_SCHEMA = StructType([
    StructField(HEIGHT, IntegerType()),
    StructField(OPERATOR, StringType()),
    StructField("validators_count_per_block", LongType()),
    StructField("total_token_amt_per_block", _AMOUNT),
    StructField("total_self_bonded_amt_per_block", _AMOUNT),
    StructField("tokens_proportion", DecimalType(38, 6)),
    StructField("voting_power_score", DoubleType()),
    StructField("commission_score", DoubleType()),
    StructField("self_bonded_score", DoubleType()),
    StructField("vote_propose_score", DoubleType()),
    StructField("score", DoubleType()),
])


def project(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a sink table's columns, in its order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
