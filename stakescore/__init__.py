"""Validator scoring over (block, validator) panels, as Spark DataFrame operators."""

from stakescore.params import LOCAL, PRODUCTION, ScoringParams
from stakescore.plans.data_scoring import data_scoring, score_panel, survey
from stakescore.incremental.backfill import BatchPlan, batched_scoring, incremental_labels

__all__ = [
    "LOCAL", "PRODUCTION", "BatchPlan", "ScoringParams", "batched_scoring", "data_scoring",
    "incremental_labels", "score_panel", "survey",
]
