"""Random panels full of gaps, nulls, zero amounts and ties against the SQL."""

import random
from dataclasses import replace
from decimal import Decimal

import duckdb
import pytest

from stakescore.catalog import oracle
from stakescore.catalog.panels import TEST
from stakescore.operators import labeling, scoring
from stakescore.plans.data_scoring import data_scoring, score_panel
from stakescore.schemas import PANEL_COLUMNS
from stakescore.staging import written

TOP = 4
SCORES = ("tokens_proportion", "voting_power_score", "commission_score", "self_bonded_score", "vote_propose_score", "score")


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for v in range(9):
        presence = rng.choice([0.4, 0.8, 1.0])
        idle = rng.random() < 0.3
        for h in range(170, 262):
            if rng.random() > presence or (seed % 2 and 200 < h < 215):
                continue
            quiet = idle or 230 < h < 245
            equal = h % 13 == 0
            poor = h % 17 == 0
            rows.append((
                h, f"val{v}",
                None if rng.random() < 0.01 else 0 if poor else rng.choice([0, 1, 5, 1000, 10**9 + v]),
                None if rng.random() < 0.01 else rng.randint(0, 10**9),
                None if rng.random() < 0.01 else 7 if equal else rng.choice([0, 3, 50, 900 + v]),
                None if rng.random() < 0.01 else rng.choice([0.0, 4e16, 8e16, 9e16]),
                rng.choice([None, True] + [False] * 28),
                False if quiet else rng.choice([None, True, True, False]),
                None if quiet else rng.choice([None, True, False, False]),
                rng.choice([None] + ["BOND_STATUS_BONDED"] * 30 + ["BOND_STATUS_UNBONDING", "BOND_STATUS_UNBONDED"]),
            ))
    return rows


def close(rows):
    return [tuple(pytest.approx(float(x), abs=1e-9) if isinstance(x, (float, Decimal)) else x for x in r) for r in rows]


def by_key(rows):
    return sorted((tuple(float(x) if isinstance(x, Decimal) else x for x in r) for r in rows), key=lambda r: r[:2])


@pytest.mark.parametrize("seed", range(4))
def test_plan_and_steps_match_sql(spark, panel_of, seed):
    rows = random_rows(seed)
    panel = panel_of([dict(zip(PANEL_COLUMNS, r)) for r in rows])
    con = duckdb.connect()
    con.sql("CREATE TABLE fuzz (block_height INTEGER, operator_address VARCHAR, tokens BIGINT, delegator_shares BIGINT,"
            " self_bonded BIGINT, commission_rate FLOAT, jailed BOOLEAN, vote BOOLEAN, propose BOOLEAN, status VARCHAR)")
    con.executemany("INSERT INTO fuzz VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?, ?)", rows)
    ctes = [oracle.scores("f", "fuzz"), oracle.survey("f", TOP), oracle.labels("f", "f")]
    key = ("block_height", "operator_address")

    def sql(source, *columns):
        return by_key(con.sql(oracle.query(ctes, f"SELECT {', '.join(columns)} FROM {source}")).fetchall())

    params = replace(TEST, top_validators=TOP)
    scored = score_panel(panel, params, chunk=10)
    want = sql("f_scored", *key, *SCORES)
    assert len(want) > 100
    assert by_key(scored.select(*key, *SCORES).collect()) == close(want)

    steps = scoring.commission_score(scoring.voting_power_score(scoring.preprocess(panel, stage=written)), params.accept_rate)
    steps = scoring.self_bonded_score(steps, params.concentration_level, stage=written)
    steps = scoring.vote_proposed_score(steps, params.vote_score, params.propose_score, 8, chunk=10, stage=written)
    steps = scoring.final_score(steps, params.A, params.B, params.C, params.D)
    assert by_key(steps.select(*key, *SCORES).collect()) == close(want)

    columns = (*key, *labeling.BUCKET_MEANS, "label")
    labels = sql("f_labels", *columns)
    assert labels
    got = data_scoring(panel, params, chunk=10).select(*columns)
    assert by_key(got.collect()) == close(labels)
