"""Formulas, null rules and identities of the scoring operators on small panels."""

from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stakescore.operators import labeling, scoring
from stakescore.params import LOCAL, PRODUCTION, ScoringParams
from stakescore.plans.data_scoring import data_scoring, score_panel
from stakescore.staging import lazy, written
from tests.conftest import rows_of

PARAMS = ScoringParams(
    accept_rate=0.1, concentration_level=0.9, vote_score=2, propose_score=6, A=9, B=4, C=2, D=4,
    vote_proposed_win_size=3, combine_win_size=2, label_win_size=4,
)


def history(operator, heights, **columns):
    return [{"block_height": h, "operator_address": operator} | {
        k: v(h) if callable(v) else v for k, v in columns.items()
    } for h in heights]


def powered(panel):
    return scoring.voting_power_score(scoring.preprocess(panel, stage=written))


def values(df, column):
    return {r["operator_address"]: r[column] for r in df.select("operator_address", column).collect()}


def stepwise(panel, params):
    df = scoring.self_bonded_score(
        scoring.commission_score(powered(panel), params.accept_rate), params.concentration_level, stage=written
    )
    df = scoring.vote_proposed_score(
        df, params.vote_score, params.propose_score, params.vote_proposed_win_size, stage=written
    )
    return scoring.final_score(df, params.A, params.B, params.C, params.D)


def test_preprocess_cleans_flags_and_rate(panel_of):
    panel = panel_of([
        {"block_height": 1, "operator_address": "a", "vote": None, "propose": None, "jailed": None,
         "commission_rate": 2.5e17},
        {"block_height": 1, "operator_address": "b", "vote": True, "propose": False, "jailed": True},
    ])
    got = {r["operator_address"]: r for r in scoring.preprocess(panel, stage=written).collect()}
    assert (got["a"]["vote"], got["a"]["propose"], got["a"]["jailed"]) == (0, 0, None)
    assert (got["b"]["vote"], got["b"]["propose"], got["b"]["jailed"]) == (1, 0, 1)
    assert got["a"]["commission_rate"] == pytest.approx(0.25)
    assert (got["a"]["validators_count_per_block"], got["a"]["total_token_amt_per_block"]) == (2, 200)


def test_voting_power_is_strict_at_twice_the_equal_share(panel_of):
    amounts = {"a": 500_000, "b": 250_000, "c": 249_999, "d": 1}
    panel = panel_of([{"block_height": 1, "operator_address": o, "tokens": t} for o, t in amounts.items()])
    assert values(powered(panel), "voting_power_score") == pytest.approx(
        {"a": 0.0, "b": 0.5, "c": 0.500002, "d": 0.999998}
    )
    above = panel_of([
        {"block_height": 1, "operator_address": o, "tokens": t}
        for o, t in {"a": 500_001, "b": 250_000, "c": 249_998, "d": 1}.items()
    ])
    assert values(powered(above), "voting_power_score")["a"] == 0.0


def test_share_is_rounded_half_up_to_six_digits(panel_of):
    amounts = {"a": 10_000_000 - 4 - 5, "b": 4, "c": 5}
    panel = panel_of([{"block_height": 1, "operator_address": o, "tokens": t} for o, t in amounts.items()])
    shares = values(powered(panel), "tokens_proportion")
    assert (shares["b"], shares["c"]) == (Decimal("0.000000"), Decimal("0.000001"))


def test_commission_is_strict_at_the_accepted_rate(panel_of, spark):
    df = spark.createDataFrame([("a", 0.1), ("b", 0.1000001), ("c", 0.025), ("d", None)],
                               "operator_address string, commission_rate double")
    assert values(scoring.commission_score(df, 0.1), "commission_score") == pytest.approx(
        {"a": 0.0, "b": 0.0, "c": 0.75, "d": None}
    )


def test_self_bond_is_relative_to_the_largest_excess(panel_of):
    panel = panel_of([
        {"block_height": 1, "operator_address": o, "self_bonded": b} for o, b in {"a": 0, "b": 90, "c": 180}.items()
    ])
    scored = scoring.self_bonded_score(scoring.preprocess(panel, stage=written), 0.9, stage=written)
    assert values(scored, "self_bonded_score") == pytest.approx({"a": 0.0, "b": 0.0, "c": 1.0})


def test_equal_self_bonds_give_null_and_drop_the_block(panel_of):
    panel = panel_of(
        history("a", range(1, 9), self_bonded=lambda h: 50 if h != 5 else 10)
        + history("b", range(1, 9), self_bonded=10)
    )
    bonded = scoring.self_bonded_score(scoring.preprocess(panel, stage=written), 0.9, stage=written)
    assert {r["block_height"] for r in bonded.filter("self_bonded_score IS NULL").collect()} == {5}
    for scored in (stepwise(panel, PARAMS), score_panel(panel, PARAMS)):
        assert {r["block_height"] for r in scored.collect()} == {3, 4, 6, 7, 8}


def test_idle_blocks_have_null_scores_except_inactive_validators(panel_of):
    idle = {"vote": False, "propose": None}
    panel = panel_of(
        history("a", range(1, 6), self_bonded=50, **idle)
        + history("b", range(1, 6), jailed=True, **idle)
        + history("c", range(1, 6), status="BOND_STATUS_UNBONDED", **idle)
        + history("d", range(1, 6), status="BOND_STATUS_UNBONDING", **idle)
    )
    for scored in (stepwise(panel, PARAMS), score_panel(panel, PARAMS)):
        last = scored.filter("block_height = 5")
        assert values(last, "vote_propose_score") == dict.fromkeys("abcd")
        assert values(last, "score") == {"a": None, "b": 0.0, "c": 0.0, "d": None}


def test_gap_lowers_the_sum_but_not_the_row_count(panel_of):
    heights = [1, 2, 5, 6, 7]
    panel = panel_of(history("a", heights, self_bonded=50) + history("b", range(1, 8)))
    points = scoring.vote_points(scoring.clean(panel), 2, 6)
    sums = scoring.moving_vote_sum(points, 3).filter("operator_address = 'a'")
    assert rows_of(sums, "block_height", "vote_propose_score") == [(1, None), (2, None), (5, 2), (6, 4), (7, 6)]


@pytest.mark.parametrize("column", ["jailed", "status", "tokens", "delegator_shares", "self_bonded", "commission_rate"])
def test_a_null_removes_the_row_but_still_counts(panel_of, column):
    panel = panel_of(
        history("a", range(1, 6), self_bonded=50)
        + history("b", range(1, 6), **{column: lambda h: None if h == 4 else _plain(column)})
    )
    for scored in (stepwise(panel, PARAMS), score_panel(panel, PARAMS)):
        assert rows_of(scored, "operator_address", "block_height") == [("a", 3), ("a", 4), ("a", 5), ("b", 3), ("b", 5)]
        assert {r[0] for r in scored.select("validators_count_per_block").collect()} == {2}


def _plain(column):
    return {"jailed": False, "status": "BOND_STATUS_BONDED", "commission_rate": 5e16}.get(column, Decimal(10))


def test_nan_rate_removes_the_row(panel_of):
    panel = panel_of(
        history("a", range(1, 5), self_bonded=50)
        + history("b", range(1, 5), commission_rate=lambda h: float("nan") if h == 4 else 5e16)
    )
    for scored in (stepwise(panel, PARAMS), score_panel(panel, PARAMS)):
        assert rows_of(scored, "operator_address", "block_height") == [("a", 3), ("a", 4), ("b", 3)]


def test_thirty_digit_amounts(panel_of):
    big = 10**30 - 1
    rows = []
    for i in range(63):
        rows += history(f"v{i:02}", range(1, 4), tokens=big - i, delegator_shares=big, self_bonded=big - 10**28 * i)
    scored = score_panel(panel_of(rows), PARAMS)
    assert scored.count() == 63
    assert scored.filter("self_bonded_score < 0 OR self_bonded_score > 1 OR score IS NULL").count() == 0


def test_identities_of_a_63_validator_block(panel_of):
    rows = []
    for i in range(63):
        rows += history(
            f"v{i:02}", range(1, 8), tokens=1000 * (i + 1) ** 2, self_bonded=10 * i**3,
            commission_rate=1e15 * i, vote=lambda h, i=i: (h + i) % 3 > 0, propose=lambda h, i=i: (h * i) % 11 == 1,
            jailed=i % 9 == 0, status="BOND_STATUS_UNBONDED" if i % 10 == 3 else "BOND_STATUS_BONDED",
        )
    scored = score_panel(panel_of(rows), PARAMS)
    blocks = scored.groupBy("block_height").agg(
        F.count("*"), F.max("vote_propose_score"), F.max("self_bonded_score"), F.sum("tokens_proportion").cast("double")
    ).collect()
    assert len(blocks) == 5
    for _, count, activity, bond, share in blocks:
        assert (count, activity, bond) == (63, 1.0, 1.0)
        assert share == pytest.approx(1, abs=5e-5)
    for r in scored.collect():
        total = (9 * r["voting_power_score"] + 4 * r["commission_score"] + 2 * r["self_bonded_score"]
                 + 4 * r["vote_propose_score"])
        i = int(r["operator_address"][1:])
        inactive = i % 9 == 0 or i % 10 == 3
        assert r["score"] == pytest.approx(0 if inactive else total, abs=1e-9)
        assert r["voting_power_score"] == pytest.approx(max(0, 1 - float(r["tokens_proportion"]) * 63 / 2), abs=1e-9)


def test_steps_equal_the_whole_plan(spark, sf_dir):
    from stakescore.catalog.panels import TEST, weekly_panel

    params = replace(TEST, top_validators=5)
    panel = written(weekly_panel(spark, sf_dir), "panel")
    scored = written(stepwise(panel, params), "steps")
    kept = labeling.validator_filter(scored, params.start_block, params.end_block, 5)
    buckets = labeling.combine_data(kept, params.combine_win_size)
    steps = labeling.shifting_data(buckets, params.label_win_size, params.combine_win_size).drop("new_block")

    def rounded(df):
        return rows_of(df.select(
            "operator_address", "block_height", "tokens", "tokens_proportion",
            *[F.col(c).cast("float").alias(c) for c in ("score", "label", "self_bonded_score", "vote_propose_score")],
        ))

    want = rounded(steps)
    assert len(want) == 342
    for chunk in (16, 16_384):
        assert rounded(data_scoring(panel, params, chunk=chunk)) == want


def test_lazy_equals_staged(panel_of):
    panel = panel_of(
        history("a", range(1, 30), self_bonded=50, tokens=70) + history("b", [*range(1, 9), *range(12, 30)])
        + history("c", range(1, 30), propose=True, commission_rate=9e16)
    )
    params = replace(PARAMS, start_block=5, end_block=20, top_validators=2)
    columns = ("operator_address", "block_height", "score", "label")
    staged = rows_of(data_scoring(panel, params), *columns)
    assert staged and {r[0] for r in staged} < {"a", "b", "c"}
    assert rows_of(data_scoring(panel, params, stage=lazy), *columns) == staged


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        replace(PARAMS, label_win_size=5)
    with pytest.raises(ValueError):
        replace(PARAMS, top_validators=3)
    with pytest.raises(ValueError):
        replace(PARAMS, vote_proposed_win_size=0)
    assert PRODUCTION.label_win_size // PRODUCTION.combine_win_size == 672
    assert LOCAL.label_win_size // LOCAL.combine_win_size == 3
