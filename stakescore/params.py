"""Scoring parameters, passed as plain keyword arguments."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ScoringParams:
    """Hyper-parameters of one scoring run.

    ``A``/``B``/``C``/``D`` weigh voting power, commission, self-bond and activity.
    ``start_block``..``end_block`` (inclusive) is the survey window in which the
    ``top_validators`` best mean scores are picked; ``top_validators=None`` keeps everyone.
    """

    accept_rate: float
    concentration_level: float
    vote_score: int
    propose_score: int
    A: int
    B: int
    C: int
    D: int
    vote_proposed_win_size: int
    combine_win_size: int
    label_win_size: int
    start_block: int | None = None
    end_block: int | None = None
    top_validators: int | None = None

    def __post_init__(self) -> None:
        for name in ("vote_proposed_win_size", "combine_win_size", "label_win_size"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be positive")
        if self.label_win_size % self.combine_win_size:
            raise ValueError("label_win_size must be a multiple of combine_win_size")
        if self.top_validators is not None and (self.start_block is None or self.end_block is None):
            raise ValueError("top_validators needs start_block and end_block")


# The published production and local parameter sets.
PRODUCTION = ScoringParams(
    accept_rate=0.1, concentration_level=0.9, vote_score=2, propose_score=6, A=9, B=4, C=2, D=4,
    vote_proposed_win_size=14400, combine_win_size=150, label_win_size=100800,
)
LOCAL = ScoringParams(
    accept_rate=0.1, concentration_level=0.9, vote_score=2, propose_score=6, A=9, B=4, C=2, D=4,
    vote_proposed_win_size=500, combine_win_size=20, label_win_size=60,
)
PRODUCTION_BATCH_SIZE = 149_999
LOCAL_BATCH_SIZE = 1_999
