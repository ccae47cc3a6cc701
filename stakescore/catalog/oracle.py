"""The registered queries in SQL for DuckDB, written as plain windows and exact integer arithmetic.

DuckDB divides decimals as doubles, so the half-up roundings that decimal division implies (6 digits for
shares and block means, 4 more digits for averages) are spelled out on integers.
"""

from __future__ import annotations

from stakescore.catalog.panels import TEST, TEST_BATCH_SIZE

V, C, AHEAD = TEST.vote_proposed_win_size, TEST.combine_win_size, TEST.label_win_size
SIZE = AHEAD // C

PANEL = """panel AS (
  SELECT block_height, 'val' || s AS operator_address, tokens, delegator_shares, self_bonded, commission_rate,
    CASE WHEN (31 * s + block_height) % 211 <> 0 THEN (s + block_height) % 23 = 0 END AS jailed,
    vote, propose,
    CASE s % 7 WHEN 0 THEN 'BOND_STATUS_UNBONDED' WHEN 1 THEN 'BOND_STATUS_UNBONDING'
      ELSE 'BOND_STATUS_BONDED' END AS status
  FROM (
    SELECT CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) // 7 AS INTEGER) AS block_height,
      l_suppkey AS s,
      sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS tokens,
      sum(CAST(l_quantity AS BIGINT)) * 1000000 AS delegator_shares,
      sum(CASE WHEN l_returnflag = 'R' THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS self_bonded,
      max(round(l_discount * 100)) * 1e16 AS commission_rate,
      bool_or(l_returnflag = 'A') FILTER (l_returnflag <> 'N') AS vote,
      bool_or(l_returnflag = 'A') FILTER (l_linestatus = 'F') AS propose
    FROM lineitem GROUP BY ALL))"""

#: The panel as a stored one holds it: its schema declares 32-bit rates.
STORED_PANEL = PANEL.replace(
    "self_bonded, commission_rate,", "self_bonded, CAST(CAST(commission_rate AS FLOAT) AS DOUBLE) AS commission_rate,"
)

HEIGHTS = """heights AS (
  SELECT CAST(date_diff('minute', TIMESTAMP '2024-01-01', date_trunc('minute', ts)) AS INTEGER) AS block_height
  FROM events)"""

PANEL_COLUMNS = (
    "block_height", "operator_address", "tokens", "delegator_shares", "self_bonded", "commission_rate",
    "jailed", "vote", "propose", "status",
)
BUCKET = (
    "block_height", "operator_address", "tokens", "commission_rate", "delegator_shares", "self_bonded",
    "tokens_proportion", "voting_power_score", "commission_score", "self_bonded_score", "vote_propose_score", "score",
)
AMOUNTS = ("tokens", "delegator_shares", "self_bonded", "total_token_amt_per_block", "total_self_bonded_amt_per_block")
DOUBLES = {
    "commission_rate", "voting_power_score", "commission_score", "self_bonded_score", "vote_propose_score",
    "score", "label", "mean_score", "buckets",
}
#: The types of the panel and of the frames made of it, of buckets, and of the two sink tables.
ROWS = {c: "DECIMAL(38, 0)" for c in AMOUNTS} | {"tokens_proportion": "DECIMAL(38, 6)"}
BUCKETS = {c: "DECIMAL(38, 4)" for c in AMOUNTS} | {"tokens_proportion": "DECIMAL(38, 10)"}
SINK = BUCKETS | {"tokens_proportion": "DECIMAL(30, 10)"}


def out(*names: str, types: dict[str, str] = ROWS) -> str:
    """A select list with doubles rounded and decimals in their declared types, as the registered queries
    give them.
    """
    def column(name: str) -> str:
        if name in DOUBLES:
            value = f"CAST({name} AS DOUBLE)"
            return f"CASE WHEN abs({value}) < 1e9 THEN round({value} + 3e-10, 6) ELSE {value} END AS {name}"
        return f"CAST({name} AS {types[name]}) AS {name}" if name in types else name

    return ", ".join(map(column, names))


def scores(name: str, source: str, scope: str = "") -> str:
    """CTEs from a panel to ``{name}_scored``. ``scope`` is '' or an extra key column with a comma."""
    block = f"(PARTITION BY {scope}block_height)"
    line = f"PARTITION BY {scope}operator_address ORDER BY block_height"
    return f"""{name}_clean AS (
  SELECT {scope}block_height, operator_address, tokens, delegator_shares, self_bonded,
    commission_rate / 1e18 AS commission_rate, CAST(jailed AS INTEGER) AS jailed,
    coalesce(CAST(vote AS INTEGER), 0) AS vote, coalesce(CAST(propose AS INTEGER), 0) AS propose, status,
    count(operator_address) OVER {block} AS validators_count_per_block,
    sum(tokens) OVER {block} AS total_token_amt_per_block,
    sum(self_bonded) OVER {block} AS total_self_bonded_amt_per_block
  FROM {source}),
{name}_shares AS (
  SELECT *,
    (2000000 * CAST(tokens AS HUGEINT) + total_token_amt_per_block) // (2 * nullif(total_token_amt_per_block, 0))
      AS share_millionths,
    CAST((2000000 * CAST(total_self_bonded_amt_per_block AS HUGEINT) + validators_count_per_block)
      // (2 * validators_count_per_block) AS DOUBLE) / 1e6 AS mean_bond
  FROM {name}_clean),
{name}_parts AS (
  SELECT *, CAST(share_millionths AS DECIMAL(32, 0)) * CAST(0.000001 AS DECIMAL(6, 6)) AS tokens_proportion,
    CAST(share_millionths AS DOUBLE) / 1e6 AS share,
    CASE WHEN share > 2 * (1e0 / validators_count_per_block) THEN 0e0
      ELSE 1 - share / (1e0 / validators_count_per_block) / 2 END AS voting_power_score,
    CASE WHEN commission_rate > {TEST.accept_rate}e0 THEN 0e0
      ELSE 1 - commission_rate / {TEST.accept_rate}e0 END AS commission_score,
    CAST(self_bonded AS DOUBLE) - mean_bond / {TEST.concentration_level}e0 AS bond_over,
    CASE WHEN bond_over < 0 THEN 0e0 ELSE bond_over END AS excess,
    {TEST.vote_score} * vote + {TEST.propose_score} * propose AS vote_propose_point
  FROM {name}_shares),
{name}_moving AS (
  SELECT * EXCLUDE (excess), excess / nullif(max(excess) OVER {block}, 0) AS self_bonded_score,
    CASE WHEN lag(vote_propose_point, {V - 1}) OVER ({line}) IS NOT NULL THEN
      sum(vote_propose_point) OVER ({line} RANGE BETWEEN {V - 1} PRECEDING AND CURRENT ROW) END AS activity
  FROM {name}_parts),
{name}_kept AS (
  SELECT * FROM {name}_moving
  WHERE jailed IS NOT NULL AND self_bonded_score IS NOT NULL AND activity IS NOT NULL
    AND tokens_proportion IS NOT NULL AND commission_score IS NOT NULL
    AND delegator_shares IS NOT NULL AND status IS NOT NULL),
{name}_active AS (
  SELECT *, activity / nullif(max(activity) OVER {block}, 0) AS vote_propose_score FROM {name}_kept),
{name}_scored AS (
  SELECT *, CASE WHEN jailed = 1 OR status LIKE '%UNBONDED%' THEN 0e0
    ELSE {TEST.A} * voting_power_score + {TEST.B} * commission_score + {TEST.C} * self_bonded_score
      + {TEST.D} * vote_propose_score END AS score
  FROM {name}_active)"""


def survey(name: str, top: int) -> str:
    return f"""{name}_top AS (
  SELECT operator_address, avg(score) AS mean_score FROM {name}_scored
  WHERE block_height BETWEEN {TEST.start_block} AND {TEST.end_block}
  GROUP BY operator_address ORDER BY mean_score DESC NULLS LAST, operator_address LIMIT {top})"""


def labels(name: str, top_of: str, scope: str = "") -> str:
    """CTEs ``{name}_buckets`` and ``{name}_labels`` of the top validators."""
    line = f"PARTITION BY {scope}operator_address ORDER BY"

    def mean(column: str, value: str, digits: int) -> str:
        total = f"20000 * CAST(sum({value}) AS HUGEINT)"
        units = f"CAST(({total} + count({value})) // (2 * count({value})) AS DECIMAL({38 - digits}, 0))"
        return f"{units} * CAST(0.{'0' * (digits - 1)}1 AS DECIMAL({digits}, {digits})) AS {column}"

    exact = ",\n    ".join([
        *[mean(c, c, 4) for c in ("tokens", "delegator_shares", "self_bonded")],
        mean("tokens_proportion", "share_millionths", 10),
    ])
    plain = ", ".join(
        f"avg({c}) AS {c}" for c in (
            "commission_rate", "voting_power_score", "commission_score", "self_bonded_score",
            "vote_propose_score", "score",
        )
    )
    return f"""{name}_numbered AS (
  SELECT *, (row_number() OVER ({line} block_height) - 1) // {C} AS new_block FROM {name}_scored
  WHERE operator_address IN (SELECT operator_address FROM {top_of}_top)),
{name}_buckets AS (
  SELECT {scope}operator_address, new_block, min(block_height) AS block_height, {plain},
    {exact}
  FROM {name}_numbered GROUP BY {scope}operator_address, new_block),
{name}_labels AS (
  SELECT * FROM (
    SELECT *, CASE WHEN lead(score, {SIZE}) OVER ({line} new_block) IS NOT NULL THEN
      avg(score) OVER ({line} new_block ROWS BETWEEN CURRENT ROW AND {SIZE} FOLLOWING) END AS label
    FROM {name}_buckets)
  WHERE label IS NOT NULL AND score IS NOT NULL AND self_bonded_score IS NOT NULL AND vote_propose_score IS NOT NULL)"""


def fates(name: str) -> list[str]:
    """CTE ``{name}_fates``: what became of the top validators' rows, with all causes."""
    key = "block_height, operator_address"
    return [
        f"""{name}_horizon AS (
  SELECT operator_address, new_block,
    lead(score, {SIZE}) OVER (PARTITION BY operator_address ORDER BY new_block) IS NOT NULL AS ahead FROM {name}_buckets)""",
        f"""{name}_fate AS (
  SELECT CASE WHEN tokens IS NULL THEN 'null_tokens' WHEN delegator_shares IS NULL THEN 'null_delegator_shares'
    WHEN self_bonded IS NULL THEN 'null_self_bonded' WHEN commission_rate IS NULL THEN 'null_commission_rate'
    WHEN jailed IS NULL OR status IS NULL THEN 'null_flags' WHEN activity IS NULL THEN 'not_warm'
    WHEN new_block IS NULL THEN 'dead_block' WHEN NOT ahead THEN 'no_horizon'
    WHEN bucket IS NULL THEN 'null_bucket' ELSE 'labelled' END AS cause
  FROM {name}_moving
  LEFT JOIN (SELECT {key}, new_block FROM {name}_numbered) USING ({key})
  LEFT JOIN {name}_horizon USING (operator_address, new_block)
  LEFT JOIN (SELECT operator_address, new_block, 1 AS bucket FROM {name}_labels) USING (operator_address, new_block)
  WHERE operator_address IN (SELECT operator_address FROM {name}_top))""",
        f"""{name}_fates AS (
  SELECT cause, count({name}_fate.cause) AS rows
  FROM (VALUES ('null_tokens'), ('null_delegator_shares'), ('null_self_bonded'), ('null_commission_rate'), ('null_flags'),
    ('not_warm'), ('dead_block'), ('no_horizon'), ('null_bucket'), ('labelled')) AS causes(cause)
  LEFT JOIN {name}_fate USING (cause) GROUP BY cause
  UNION ALL SELECT 'rows', count(*) FROM {name}_fate)""",
    ]


# The batch loop, step by step; a tail is cut to whole buckets and needs at least one labelled bucket.
BATCHES = f"""bounds AS (SELECT min(block_height) AS lo, max(block_height) AS hi FROM panel),
batches AS (
  WITH RECURSIVE step(batch_id, batch_start, batch_end, ended) AS (
    SELECT 0, lo, lo + {TEST_BATCH_SIZE} - 1, lo + {TEST_BATCH_SIZE} - 1 > hi FROM bounds
    UNION ALL
    SELECT batch_id + 1, batch_end - {AHEAD} + 1 - {V} + 1,
      batch_end - {AHEAD} - {V} + 1 + {TEST_BATCH_SIZE},
      batch_end - {AHEAD} - {V} + 1 + {TEST_BATCH_SIZE} > hi
    FROM step, bounds WHERE NOT ended AND batch_end - {AHEAD} + 1 <= hi)
  SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(batch_start AS BIGINT) AS batch_start,
    CAST(CASE WHEN ended THEN batch_start + (hi - batch_start + 1 - {V} + 1) // {C} * {C} + {V} - 2
      ELSE batch_end END AS BIGINT) AS batch_end
  FROM step, bounds
  WHERE NOT ended OR (hi - batch_start + 1 - {V} + 1) // {C} * {C} + {V} - 1 >= {V + C + AHEAD - 1})"""


def query(ctes: list[str], select: str) -> str:
    return f"WITH {', '.join(ctes)}\n{select}"


def statements(top: int = TEST.top_validators) -> dict[str, str]:
    scored = [PANEL, scores("a", "panel")]
    topped = [*scored, survey("a", top)]
    labelled = [*topped, labels("a", "a")]
    totals = ("validators_count_per_block", "total_token_amt_per_block", "total_self_bonded_amt_per_block")
    pairs = "SELECT lag(block_height) OVER (ORDER BY block_height) AS previous_block, block_height AS block"
    gaps = "SELECT previous_block, block, block - previous_block AS gap"
    key = ("block_height", "operator_address")

    def rows(ctes: list[str], source: str, *columns: str, types: dict[str, str] = ROWS) -> str:
        return query(ctes, f"SELECT {out(*columns, types=types)} FROM {source}")

    # The declared rate is a 32-bit float.
    scanned = "(SELECT * REPLACE (CAST(commission_rate AS FLOAT) AS commission_rate) FROM panel)"

    batched = [
        *topped, BATCHES,
        "batch_panel AS (SELECT batch_id, panel.* FROM panel JOIN batches"
        " ON block_height BETWEEN batch_start AND batch_end)",
        scores("b", "batch_panel", "batch_id, "), labels("b", "a", "batch_id, "),
    ]
    earlier = [
        f"history AS (SELECT * FROM panel WHERE block_height BETWEEN 0 AND {TEST.end_block})",
        scores("h", "history"), survey("h", top), labels("h", "h"),
    ]
    minute_gaps = query(
        [HEIGHTS], f"{gaps} FROM ({pairs} FROM (SELECT DISTINCT block_height FROM heights)) WHERE gap <> 1"
    )
    strides = query(
        labelled,
        f"SELECT gap, count(*) AS pairs FROM ({gaps} FROM ({pairs} FROM"
        " (SELECT DISTINCT block_height FROM a_labels))) WHERE gap IS NOT NULL GROUP BY gap",
    )
    other_strides = query(
        labelled, f"{gaps} FROM ({pairs} FROM (SELECT DISTINCT block_height FROM a_labels)) WHERE gap <> {C}"
    )
    return {
        "scan_panel": rows([PANEL], scanned, *PANEL_COLUMNS),
        "range_scan": rows([PANEL], scanned, *PANEL_COLUMNS)
        + f" WHERE block_height BETWEEN {TEST.start_block} AND {TEST.end_block}",
        "height_bounds": query(
            [PANEL], "SELECT min(block_height) AS min_height, max(block_height) AS max_height FROM panel"
        ),
        "preprocess": rows(scored, "a_clean", *PANEL_COLUMNS, *totals),
        "block_stats": query(
            [PANEL],
            f"SELECT block_height, {out(*totals)} FROM (SELECT block_height, count(operator_address)"
            " AS validators_count_per_block, sum(tokens) AS total_token_amt_per_block,"
            " sum(self_bonded) AS total_self_bonded_amt_per_block FROM panel GROUP BY block_height)",
        ),
        "voting_power_score": rows(scored, "a_parts", *key, "tokens_proportion", "voting_power_score"),
        "commission_score": rows(scored, "a_parts", *key, "commission_rate", "commission_score"),
        "self_bonded_score": rows(scored, "a_moving", *key, "self_bonded", "self_bonded_score"),
        "vote_points": rows(scored, "a_parts", *key, "vote_propose_point"),
        "moving_vote_sum": query(
            scored,
            "SELECT block_height, operator_address, vote_propose_point,"
            " CAST(activity AS BIGINT) AS vote_propose_score FROM a_moving",
        ),
        "stored_panel": rows([PANEL], scanned, *PANEL_COLUMNS),
        "stored_moving_vote_sum": query(
            scored,
            "SELECT block_height, operator_address, vote_propose_point,"
            " CAST(activity AS BIGINT) AS vote_propose_score FROM a_moving",
        ),
        "stored_data_scoring": rows([STORED_PANEL, *labelled[1:]], "a_labels", *BUCKET, "label", types=BUCKETS),
        "vote_proposed_score": rows(scored, "a_active", *key, "vote_propose_score"),
        "final_score": rows(
            scored, "a_scored", *PANEL_COLUMNS, *totals, "tokens_proportion", "voting_power_score",
            "commission_score", "self_bonded_score", "vote_propose_score", "score",
        ),
        "validator_score_table": rows(
            scored, "a_scored", *key, *totals, "tokens_proportion", "voting_power_score",
            "commission_score", "self_bonded_score", "vote_propose_score", "score",
        ),
        "top_validators": rows(topped, "a_top", "operator_address", "mean_score"),
        "validator_filter": rows(topped, "a_scored", *key, "score")
        + " WHERE operator_address IN (SELECT operator_address FROM a_top)",
        "combine_data": rows(labelled, "a_buckets", "new_block", *BUCKET, types=BUCKETS),
        "forward_label": rows(labelled, "a_labels", "new_block", *BUCKET, "label", types=BUCKETS),
        "data_scoring": rows(labelled, "a_labels", *BUCKET, "label", types=BUCKETS),
        "sink_projection": rows(labelled, "a_labels", *BUCKET, "label", types=SINK),
        "distinct_blocks": query([HEIGHTS], "SELECT DISTINCT block_height FROM heights"),
        "label_counts": query(
            labelled, 'SELECT count(*) AS "rows", count(DISTINCT block_height) AS heights FROM a_labels'
        ),
        "block_gaps": minute_gaps,
        "stride_histogram": strides,
        "stride_gaps": other_strides,
        "kept_gaps": minute_gaps,
        "kept_stride_histogram": strides,
        "kept_stride_gaps": other_strides,
        "kept_heights": query(
            [HEIGHTS],
            "SELECT min(block_height) AS min_height, max(block_height) AS max_height,"
            " count(DISTINCT block_height) AS heights FROM heights",
        ),
        "expected_buckets": query(
            [PANEL],
            f"SELECT {out('min_height', 'max_height', 'buckets')}, CAST(floor(buckets) AS BIGINT) AS whole_buckets"
            " FROM (SELECT min(block_height) AS min_height, max(block_height) AS max_height,"
            f" ((max_height - {AHEAD} - {C}) - (min_height + {V} - 1)) / {C}e0 + 1 AS buckets FROM panel)",
        ),
        "key_violations": "SELECT l_orderkey, l_suppkey, count(*) AS copies FROM lineitem"
        " GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1 OR l_orderkey IS NULL OR l_suppkey IS NULL",
        "batch_intervals": query([PANEL, BATCHES], "SELECT * FROM batches"),
        "batch_coverage": query(
            [PANEL, BATCHES,
             "starts AS (SELECT batch_id, unnest(generate_series("
             f"batch_start + {V - 1}, batch_end - {AHEAD} - {C} + 1, {C})) AS height FROM batches)"],
            "SELECT batch_id, batch_start, batch_end, min(height) AS first_label, max(height) AS last_label,"
            " count(*) AS buckets, count(block_height) AS present_buckets"
            " FROM batches JOIN starts USING (batch_id)"
            " LEFT JOIN (SELECT DISTINCT block_height FROM panel) ON height = block_height"
            " GROUP BY batch_id, batch_start, batch_end",
        ),
        "batched_scoring": rows(batched, "b_labels", "batch_id", *BUCKET, "label", types=BUCKETS),
        "incremental_labels": rows(labelled, "a_labels", *BUCKET, "label", types=SINK),
        "carried_labels": rows(labelled, "a_labels", *BUCKET, "label", types=SINK),
        "corrected_labels": rows(labelled, "a_labels", *BUCKET, "label", types=SINK),
        "arriving_labels": rows([STORED_PANEL, *labelled[1:]], "a_labels", *BUCKET, "label", types=SINK),
        "dropped_rows": query([*labelled, *fates("a")], "SELECT * FROM a_fates"),
        "sketched_counts": query(
            [HEIGHTS],
            """SELECT 'rows' AS name, count(block_height) AS exact, true AS within FROM heights
UNION ALL SELECT 'heights', count(DISTINCT block_height), true FROM heights
UNION ALL SELECT 'median', count(block_height), true FROM heights""",
        ),
        "covers": query(
            [PANEL],
            f"SELECT max(block_height) AS max_height, max(block_height) >= {TEST.end_block} AS covered FROM panel",
        ),
        "resume_point": query(
            labelled,
            f"SELECT (SELECT max(block_height) + {C} FROM a_labels) AS resume_start,"
            " (SELECT max(block_height) FROM panel) AS global_end",
        ),
        "append_dedup": query(
            [*labelled, *earlier],
            f"SELECT {out(*key, 'score', 'label')} FROM a_labels ANTI JOIN h_labels"
            " USING (block_height, operator_address)",
        ),
        "csv_roundtrip": query([HEIGHTS], "SELECT DISTINCT block_height FROM heights"),
    }
