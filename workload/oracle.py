"""The registered queries in SQL, for a check by another engine."""

from __future__ import annotations

DAY = "DATE '1998-06-01'"
RELOADED = "DATE '1997-03-01'"

SNAP = """
snap AS (
  SELECT CAST(m.l_suppkey AS VARCHAR) AS entity_id, s.s_name AS entity_name,
         n.n_name AS group_name, m.snapshot_date, m.quality, m.speed, m.price_in, m.price_out
  FROM (
    SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
           CAST(SUM(l_quantity) AS DOUBLE) AS quality,
           NULLIF(CAST(COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS DOUBLE), 0.0) AS speed,
           MIN(l_discount) AS price_in, MIN(l_tax) AS price_out
    FROM lineitem GROUP BY 1, 2
  ) m
  JOIN supplier s ON m.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

EVENTS = """
snap AS (
  SELECT CAST(user_id AS VARCHAR) AS entity_id,
         'user ' || CAST(user_id AS VARCHAR) AS entity_name, MAX(event_type) AS group_name,
         CAST(ts AS DATE) AS snapshot_date, MAX(value) AS quality,
         CAST(COUNT(*) AS DOUBLE) AS speed, MIN(value) AS price_in, MAX(value) AS price_out
  FROM events GROUP BY user_id, CAST(ts AS DATE)
)"""

RAW = """
raw AS (
  SELECT entity_id AS id, group_name AS maker, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
         COALESCE(speed, 0.0) AS rate, quality + 1e0 AS index_value, entity_name AS slug,
         CAST(price_in AS VARCHAR) AS cost_in, CAST(price_out AS VARCHAR) AS cost_out,
         1 AS delivery
  FROM snap
  UNION ALL
  SELECT entity_id, group_name, CAST(snapshot_date AS VARCHAR), COALESCE(speed, 0.0), quality,
         CASE WHEN price_out <> 0.08 THEN entity_name END,
         CASE WHEN price_in = 0.05 THEN 'n/a' ELSE CAST(price_in AS VARCHAR) END,
         CAST(price_out AS VARCHAR), 2
  FROM snap
)"""

ELIGIBLE = """
eligible AS (
  SELECT *, (price_in + price_out) / 2e0 AS mean_price FROM snap
  WHERE quality IS NOT NULL AND speed IS NOT NULL AND price_in IS NOT NULL
    AND price_out IS NOT NULL AND (price_in + price_out) / 2e0 > 0
)"""

STATS = """
stats AS (
  SELECT snapshot_date, COUNT(*) AS n_rows,
         MIN(quality) AS quality_lo, MAX(quality) AS quality_hi,
         MIN(speed) AS speed_lo, MAX(speed) AS speed_hi,
         MIN(mean_price) AS price_lo, MAX(mean_price) AS price_hi
  FROM eligible GROUP BY 1
)"""

CUTS = """
numbered AS (
  SELECT snapshot_date, mean_price,
         ROW_NUMBER() OVER (PARTITION BY snapshot_date ORDER BY mean_price) AS spot,
         COUNT(*) OVER (PARTITION BY snapshot_date) AS n
  FROM eligible
), cuts AS (
  SELECT snapshot_date,
         MIN(CASE WHEN spot >= CEIL(0.33 * n) THEN mean_price END) AS tier_low,
         MIN(CASE WHEN spot >= CEIL(0.66 * n) THEN mean_price END) AS tier_mid
  FROM numbered GROUP BY 1
)"""


def _norm(x: str, name: str, inverse: bool = False) -> str:
    share = f"({x} - {name}_lo) / ({name}_hi - {name}_lo)"
    value = f"(1e0 - {share}) * 1e2" if inverse else f"{share} * 1e2"
    return f"CASE WHEN {name}_lo = {name}_hi THEN 5e1 ELSE {value} END"


NORMED = f"""
normed AS (
  SELECT e.*, s.* EXCLUDE (snapshot_date),
         {_norm('quality', 'quality')} AS quality_norm,
         {_norm('speed', 'speed')} AS speed_norm,
         {_norm('mean_price', 'price', True)} AS price_norm,
         quality / mean_price AS value_ratio
  FROM eligible e JOIN stats s ON e.snapshot_date = s.snapshot_date
), scored AS (
  SELECT *, quality_norm * 5e-1 + speed_norm * 3e-1 + price_norm * 2e-1 AS composite_score
  FROM normed
)"""


def _place(column: str) -> str:
    return (
        "CAST(ROW_NUMBER() OVER (PARTITION BY snapshot_date "
        f"ORDER BY {column} DESC, entity_id) AS BIGINT)"
    )


TIERED = """
tiers AS (
  SELECT s.*, CASE WHEN mean_price <= tier_low THEN 'budget'
                   WHEN mean_price <= tier_mid THEN 'mid' ELSE 'premium' END AS cost_tier
  FROM scored s JOIN cuts c ON s.snapshot_date = c.snapshot_date
)"""

BOARD = f"""
board AS (
  SELECT snapshot_date, {_place('composite_score')} AS rank, entity_id, entity_name, group_name,
         composite_score, quality_norm, speed_norm, price_norm, mean_price, value_ratio,
         cost_tier, {_place('value_ratio')} AS efficiency_rank
  FROM tiers
)"""

LEADERBOARD = (SNAP, ELIGIBLE, STATS, CUTS, NORMED, TIERED, BOARD)
SCORED = (SNAP, ELIGIBLE, STATS, NORMED)

RELOAD = f"""
reloaded AS (
  SELECT * FROM snap WHERE snapshot_date <> {RELOADED}
  UNION ALL
  SELECT entity_id, entity_name, group_name, snapshot_date, quality + 1e2, speed, price_in,
         price_out
  FROM snap WHERE snapshot_date = {RELOADED} AND price_in < 0.05
)"""


def _with(parts, query: str) -> str:
    return f"WITH {', '.join(parts)}\n{query}"


def _trends(source: str) -> str:
    w = "OVER (PARTITION BY entity_id ORDER BY snapshot_date)"
    return f"""
SELECT entity_id, entity_name, group_name, snapshot_date,
       LAG(snapshot_date) {w} AS prev_snapshot_date,
       quality AS quality_current, LAG(quality) {w} AS quality_previous,
       quality - LAG(quality) {w} AS quality_delta,
       speed AS speed_current, LAG(speed) {w} AS speed_previous,
       speed - LAG(speed) {w} AS speed_delta,
       mean_price AS price_current, LAG(mean_price) {w} AS price_previous,
       mean_price - LAG(mean_price) {w} AS price_delta
FROM (SELECT *, (price_in + price_out) / 2e0 AS mean_price FROM {source})"""


def _percent_ranks() -> str:
    def share(name, column, inverse=False):
        rank = f"PERCENT_RANK() OVER (PARTITION BY snapshot_date ORDER BY {column})"
        value = f"(1e0 - {rank}) * 1e2" if inverse else f"{rank} * 1e2"
        return f"CASE WHEN {name}_lo = {name}_hi THEN 5e1 ELSE {value} END AS {name}_norm"

    return f"""
SELECT entity_id, snapshot_date, {share('quality', 'quality')}, {share('speed', 'speed')},
       {share('price', 'mean_price', True)}
FROM (SELECT e.*, s.* EXCLUDE (snapshot_date)
      FROM eligible e JOIN stats s ON e.snapshot_date = s.snapshot_date)"""


def _z_scores(clip: str = "2e0") -> str:
    def scaled(name, column, sign=""):
        z = f"({column} - {name}_mean) / {name}_dev"
        cut = f"GREATEST(-{clip}, LEAST({clip}, {z}))"
        z = f"CASE WHEN {name}_dev = 0 THEN 0e0 ELSE {cut} END"
        return f"ROUND(({sign}({z}) + {clip}) / (2e0 * {clip}) * 1e2, 6) AS {name}_norm"

    columns = {"quality": "quality", "speed": "speed", "price": "mean_price"}
    moments = ", ".join(
        f"AVG({c}) OVER w AS {n}_mean, "
        f"CASE WHEN MIN({c}) OVER w = MAX({c}) OVER w THEN 0 ELSE STDDEV_POP({c}) OVER w END "
        f"AS {n}_dev"
        for n, c in columns.items()
    )
    return f"""
SELECT entity_id, snapshot_date, {scaled('quality', 'quality')}, {scaled('speed', 'speed')},
       {scaled('price', 'mean_price', '-')}
FROM (SELECT *, {moments} FROM eligible WINDOW w AS (PARTITION BY snapshot_date))"""


def _winners() -> str:
    sets = {
        "balanced": ("5e-1", "3e-1", "2e-1"),
        "fast": ("25e-2", "5e-1", "25e-2"),
        "cheap": ("25e-2", "25e-2", "5e-1"),
    }
    rows = " UNION ALL ".join(
        f"SELECT snapshot_date, '{name}' AS weighting, entity_id, entity_name, "
        f"quality_norm * {q} + speed_norm * {s} + price_norm * {p} AS composite_score FROM scored"
        for name, (q, s, p) in sets.items()
    )
    return f"""
SELECT snapshot_date, weighting, entity_id, entity_name, composite_score
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY snapshot_date, weighting
                                   ORDER BY composite_score DESC, entity_id) AS spot
      FROM ({rows}))
WHERE spot = 1"""


_FILLED = " + ".join(
    f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)"
    for c in ("cost_in", "cost_out", "index_value", "maker", "rate", "slug")
)
_COPIES = (
    "ROW_NUMBER() OVER (PARTITION BY id, snapshot_date ORDER BY delivery DESC, "
    f"{_FILLED} DESC) AS spot"
)

_PRESENT = "CASE WHEN {0} THEN 1 END"

ORACLE: dict[str, str] = {
    "flatten_nested": """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS slug, '2023-05-06' AS release_date,
       p_brand AS model_creator_slug,
       CAST(p_retailprice AS VARCHAR) AS pricing_price_1m_input_tokens,
       CAST(CAST(p_size AS DOUBLE) AS VARCHAR) AS pricing_price_1m_output_tokens,
       '0.0' AS median_output_tokens_per_second, '0.0' AS median_time_to_first_token_seconds,
       CAST(NULL AS VARCHAR) AS median_time_to_first_answer_token,
       DATE '2024-01-01' AS snapshot_date
FROM part""",
    "map_spread": """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS eval_k FROM events""",
    "measurements_spread": "SELECT " + ", ".join(
        f"COUNT({_PRESENT.format(f'p_type = {kind.upper()!r}')}) AS eval_{kind}_rows"
        for kind in ("economy", "large", "medium", "promo", "small", "standard")
    ) + " FROM part",
    "landing_read": _with([SNAP], """
SELECT entity_id AS id, entity_name AS slug, group_name AS model_creator_slug,
       CAST(price_in AS VARCHAR) AS pricing_price_1m_input_tokens,
       CAST(price_out AS VARCHAR) AS pricing_price_1m_output_tokens,
       CAST(COALESCE(speed, 0e0) AS VARCHAR) AS median_output_tokens_per_second,
       snapshot_date, quality AS eval_index
FROM snap"""),
    "landing_rejects": """
SELECT CASE WHEN p_type = 'ECONOMY' THEN 'no data list' ELSE 'malformed' END AS reason,
       COUNT(*) AS envelopes
FROM part WHERE p_type IN ('ECONOMY', 'STANDARD') GROUP BY 1""",
    "incomplete_records": """
SELECT key, COUNT(*) AS n_records FROM part CROSS JOIN (VALUES
  ('release_date'), ('median_output_tokens_per_second'), ('median_time_to_first_token_seconds'),
  ('median_time_to_first_answer_token'), ('pricing.price_1m_input_tokens'),
  ('pricing.price_1m_output_tokens')) AS absent(key)
GROUP BY key""",
    "clean_snapshots": _with([SNAP, RAW], f"""
SELECT id AS entity_id, slug AS entity_name, maker AS group_name,
       CAST(snapshot_date AS DATE) AS snapshot_date, index_value AS quality,
       NULLIF(rate, 0e0) AS speed, TRY_CAST(cost_in AS DOUBLE) AS price_in,
       TRY_CAST(cost_out AS DOUBLE) AS price_out
FROM (SELECT *, {_COPIES} FROM raw WHERE id IS NOT NULL AND slug IS NOT NULL)
WHERE spot = 1"""),
    "dedupe_latest": _with([SNAP, RAW], f"""
SELECT * EXCLUDE (spot) FROM (SELECT *, {_COPIES} FROM raw) WHERE spot = 1"""),
    "sentinel_to_null": _with([SNAP, RAW], """
SELECT delivery, COUNT(CASE WHEN rate = 0 THEN 1 END) AS unmeasured,
       SUM(NULLIF(rate, 0e0)) AS rate_sum
FROM raw GROUP BY 1"""),
    "safe_cast": _with([SNAP, RAW], """
SELECT id, snapshot_date, delivery, TRY_CAST(cost_in AS DOUBLE) AS cost_in,
       TRY_CAST(cost_out AS DOUBLE) AS cost_out
FROM raw"""),
    "cast_losses": _with([SNAP, RAW], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, "
        f"COUNT(CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL THEN 1 END) "
        "AS unreadable FROM raw"
        for c, t in (("snapshot_date", "DATE"), ("cost_in", "DOUBLE"), ("cost_out", "DOUBLE"),
                     ("rate", "DOUBLE"))
    )),
    "identity_filter": _with([SNAP, RAW], """
SELECT delivery, COUNT(*) AS n_rows FROM raw
WHERE id IS NOT NULL AND slug IS NOT NULL GROUP BY 1"""),
    "snapshot_slice": _with([SNAP], f"SELECT * FROM snap WHERE snapshot_date = {DAY}"),
    "table_health": _with([SNAP], "SELECT snapshot_date, COUNT(*) AS n_rows, " + ", ".join(
        f"COUNT(*) - COUNT({c}) AS {c}_nulls, MIN({c}) AS {c}_lo, MAX({c}) AS {c}_hi"
        for c in ("quality", "speed", "price_in", "price_out")
    ) + " FROM snap GROUP BY 1"),
    "table_summary": _with([SNAP], """
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, COUNT(DISTINCT snapshot_date) AS n_snapshots
FROM snap"""),
    "null_check": _with([SNAP], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nulls FROM snap"
        for c in ("entity_id", "entity_name", "snapshot_date")
    )),
    "partition_reload": _with([SNAP, RELOAD], "SELECT * FROM reloaded"),
    "load_audit": _with([SNAP, RELOAD], f"""
SELECT snapshot_date,
       CAST(CASE WHEN snapshot_date = {RELOADED} THEN 2 ELSE 1 END AS BIGINT) AS loads,
       COUNT(*) AS n_rows
FROM reloaded GROUP BY 1"""),
    "scorable_filter": _with([SNAP, ELIGIBLE], "SELECT * FROM eligible"),
    "snapshot_stats": _with([SNAP, ELIGIBLE, STATS], "SELECT * FROM stats"),
    "price_quantiles_approx": _with([SNAP, ELIGIBLE], """
SELECT COUNT(DISTINCT snapshot_date) AS snapshots, COUNT(DISTINCT snapshot_date) AS within_error
FROM eligible"""),
    "minmax_norm": _with(
        SCORED, "SELECT entity_id, snapshot_date, quality_norm, speed_norm FROM scored"
    ),
    "inverse_norm": _with(SCORED, "SELECT entity_id, snapshot_date, price_norm FROM scored"),
    "composite_score": _with(
        SCORED, "SELECT entity_id, snapshot_date, composite_score FROM scored"
    ),
    "value_ratio": _with(SCORED, "SELECT entity_id, snapshot_date, value_ratio FROM scored"),
    "efficiency_rank": _with(SCORED, f"""
SELECT entity_id, snapshot_date, value_ratio, {_place('value_ratio')} AS efficiency_rank
FROM scored"""),
    "cost_tier": _with(LEADERBOARD, "SELECT entity_id, snapshot_date, cost_tier FROM board"),
    "leaderboard_approx": _with(LEADERBOARD, "SELECT * EXCLUDE (cost_tier) FROM board"),
    "previous_values": _with([SNAP], f"""
SELECT entity_id, snapshot_date, prev_snapshot_date, quality_previous, speed_previous,
       price_previous
FROM ({_trends('snap')})"""),
    "trends_full": _with([SNAP], _trends("snap")),
    "trends_gaps": _with([EVENTS], _trends("snap")),
    "trends_incremental": _with([SNAP, RELOAD], _trends("reloaded")),
    "latest_snapshot": _with([SNAP], """
SELECT * FROM snap WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM snap)"""),
    "best_overall": _with(LEADERBOARD, "SELECT * FROM board WHERE rank = 1"),
    "best_value": _with(LEADERBOARD, "SELECT * FROM board WHERE efficiency_rank = 1"),
    "top_n": _with(
        LEADERBOARD,
        f"SELECT * FROM board WHERE snapshot_date = {DAY} ORDER BY rank LIMIT 10",
    ),
    "top_n_per_snapshot": _with(LEADERBOARD, "SELECT * FROM board WHERE rank <= 5"),
    "ever_top_n": _with(LEADERBOARD, """
SELECT * FROM board WHERE entity_name IN (SELECT entity_name FROM board WHERE rank <= 1)"""),
    "tier_summary": _with(LEADERBOARD, """
SELECT snapshot_date, cost_tier, COUNT(*) AS entities, MIN(mean_price) AS price_lo,
       MAX(mean_price) AS price_hi, ROUND(AVG(mean_price), 12) AS price_avg,
       MIN(quality_norm) AS quality_norm_lo, MAX(quality_norm) AS quality_norm_hi,
       ROUND(AVG(quality_norm), 9) AS quality_norm_avg
FROM board WHERE cost_tier IS NOT NULL GROUP BY 1, 2"""),
    "percent_rank_norm": _with([SNAP, ELIGIBLE, STATS], _percent_ranks()),
    "zscore_clip_norm": _with([SNAP, ELIGIBLE], _z_scores()),
    "log_price_norm": _with(SCORED, """
SELECT entity_id, snapshot_date,
       ROUND(CASE WHEN price_lo = price_hi THEN 5e1
             ELSE (1e0 - (LN(mean_price) - LN(price_lo)) / (LN(price_hi) - LN(price_lo))) * 1e2
             END, 6) AS price_norm
FROM scored"""),
    "reweighted_winner": _with(SCORED, _winners()),
    "rank_movement": _with(LEADERBOARD, """
SELECT entity_id, entity_name, group_name, snapshot_date,
       LAG(snapshot_date) OVER w AS prev_snapshot_date, rank, LAG(rank) OVER w AS rank_previous,
       LAG(rank) OVER w - rank AS places_gained,
       composite_score - LAG(composite_score) OVER w AS score_delta
FROM board WINDOW w AS (PARTITION BY entity_id ORDER BY snapshot_date)"""),
    "entered_dropped": _with(LEADERBOARD, """
, dates AS (
  SELECT snapshot_date AS d, LAG(snapshot_date) OVER (ORDER BY snapshot_date) AS before,
         LEAD(snapshot_date) OVER (ORDER BY snapshot_date) AS after
  FROM (SELECT DISTINCT snapshot_date FROM board)
)
SELECT b.snapshot_date, b.entity_id, 'entered' AS change
FROM board b JOIN dates ON d = b.snapshot_date
LEFT JOIN board p ON p.entity_id = b.entity_id AND p.snapshot_date = before
WHERE before IS NOT NULL AND p.entity_id IS NULL
UNION ALL
SELECT after, b.entity_id, 'dropped'
FROM board b JOIN dates ON d = b.snapshot_date
LEFT JOIN board p ON p.entity_id = b.entity_id AND p.snapshot_date = after
WHERE after IS NOT NULL AND p.entity_id IS NULL"""),
    "stream_ingest": _with([SNAP], "SELECT * FROM snap"),
}


def _as_of(day: str) -> str:
    return f"""
SELECT * EXCLUDE (spot) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY snapshot_date DESC) AS spot
  FROM snap WHERE snapshot_date <= {day})
WHERE spot = 1"""


_QUANTILES = _with([SNAP, ELIGIBLE, CUTS], "SELECT * FROM cuts")
_RANKS = _with(SCORED, f"""
SELECT entity_id, snapshot_date, composite_score, {_place('composite_score')} AS rank
FROM scored""")
_MERGED = _with([SNAP], f"""
SELECT * REPLACE (CASE WHEN snapshot_date >= {DAY} THEN speed END AS speed) FROM snap""")

ORACLE |= {
    "asof_snapshot": _with([SNAP], _as_of(DAY)),
    "asof_events": _with([EVENTS], _as_of("DATE '2024-01-15'")),
    "price_quantiles_exact": _QUANTILES,
    "price_quantiles_two_pass": _QUANTILES,
    "composite_rank": _RANKS,
    "composite_rank_two_pass": _RANKS,
    "leaderboard": _with(LEADERBOARD, "SELECT * FROM board"),
    "leaderboard_two_pass": _with(LEADERBOARD, "SELECT * FROM board"),
    "merged_schema": _MERGED,
    "merged_frames": _MERGED,
    "percent_rank_two_pass": ORACLE["percent_rank_norm"],
    "stream_trends": ORACLE["trends_full"],
}

_ODD = "CASE WHEN p_partkey % 5 = {0} THEN CAST(p_size AS DOUBLE) END"
_FINITE = """
finite AS (SELECT * REPLACE (CASE WHEN speed % 3 = 2 THEN speed END AS speed) FROM snap)"""
_RELOADED_TWICE = f"""
twice AS (
  SELECT * FROM snap WHERE snapshot_date <> {DAY}
  UNION ALL
  SELECT entity_id, entity_name, group_name, snapshot_date, quality + 1e2, speed, price_in, price_out
  FROM snap WHERE snapshot_date = {DAY} AND CAST(entity_id AS INTEGER) % 3 <> 0
)"""
_CORRECTED = f"""
given AS (
  SELECT * REPLACE (CASE WHEN snapshot_date = {RELOADED} AND CAST(entity_id AS INTEGER) % 2 = 0
                         THEN 1e0 ELSE quality END AS quality) FROM snap
)"""


def _of(parts, source: str):
    """The steps after ``snap``, from another table."""
    return [part.replace("FROM snap", f"FROM {source}") for part in parts]


ORACLE |= {
    "latest_of_frame": ORACLE["latest_snapshot"],
    "landing_rows": _with([SNAP], """
SELECT entity_id AS id, entity_name AS slug, CAST(snapshot_date AS VARCHAR) AS release_date,
       group_name AS model_creator_slug,
       CAST(price_in AS VARCHAR) AS pricing_price_1m_input_tokens,
       CAST(price_out AS VARCHAR) AS pricing_price_1m_output_tokens,
       CAST(COALESCE(speed, 0e0) AS VARCHAR) AS median_output_tokens_per_second,
       '0.0' AS median_time_to_first_token_seconds,
       CAST(NULL AS VARCHAR) AS median_time_to_first_answer_token,
       snapshot_date, quality AS eval_index
FROM snap"""),
    "measurements_by_row": "SELECT CAST(p_partkey AS VARCHAR) AS id, " + ", ".join(
        f"CASE WHEN p_type = {kind.upper()!r} THEN CAST(p_size AS DOUBLE) END AS eval_{kind}"
        for kind in ("economy", "large", "medium", "promo", "small", "standard")
    ) + " FROM part",
    "measurements_long": """
SELECT CAST(p_partkey AS VARCHAR) AS id, LOWER(p_type) AS key, CAST(p_size AS DOUBLE) AS value
FROM part""",
    "incomplete_by_record": """
SELECT CAST(p_partkey AS VARCHAR) AS id,
       'release_date,pricing.price_1m_input_tokens,pricing.price_1m_output_tokens,'
       || 'median_output_tokens_per_second,median_time_to_first_token_seconds,'
       || 'median_time_to_first_answer_token' AS missing
FROM part""",
    "spread_odd_keys": f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, DATE '2024-01-01' AS snapshot_date,
       CASE WHEN p_partkey % 5 IN (3, 4) THEN CAST(p_size AS DOUBLE) END AS m0,
       {_ODD.format(2)} AS m1, {_ODD.format(0)} AS m2, {_ODD.format(1)} AS m3
FROM part""",
    "clean_infinite": _with(
        [SNAP, _FINITE, *_of(LEADERBOARD[1:], "finite")],
        "SELECT snapshot_date, entity_id, rank, speed_norm, composite_score FROM board",
    ),
    "identity_rows": _with([SNAP, RAW], """
SELECT * FROM raw WHERE id IS NOT NULL AND slug IS NOT NULL"""),
    "sentinel_rows": _with([SNAP, RAW], """
SELECT id, snapshot_date, delivery, NULLIF(rate, 0e0) AS rate FROM raw"""),
    "written_two_pass_board": ORACLE["leaderboard"],
    "trends_two_reloads": _with([SNAP, _RELOADED_TWICE], _trends("twice")),
    "ever_top_five": _with(LEADERBOARD, """
SELECT * FROM board WHERE entity_name IN (SELECT entity_name FROM board WHERE rank <= 5)"""),
    "ever_top_five_ids": _with(LEADERBOARD, """
SELECT * FROM board WHERE entity_id IN (SELECT entity_id FROM board WHERE rank <= 5)"""),
    "chain_parts": _with([SNAP], "SELECT * FROM snap"),
    "chain_rejects": _with([SNAP], """
SELECT snapshot_date,
       CASE WHEN CAST(entity_id AS INTEGER) % 4 = 0 THEN 'malformed' ELSE 'no data list' END AS reason,
       CAST(COUNT(*) AS BIGINT) AS envelopes
FROM snap WHERE CAST(entity_id AS INTEGER) % 4 < 2 GROUP BY 1, 2"""),
    "chain_without_quality": _with(LEADERBOARD, f"""
SELECT s.* REPLACE (CASE WHEN s.snapshot_date = {RELOADED} THEN quality END AS quality), rank
FROM snap s LEFT JOIN (SELECT entity_id, snapshot_date, rank FROM board
                       WHERE snapshot_date = {RELOADED}) b USING (entity_id, snapshot_date)
WHERE s.snapshot_date IN ({RELOADED}, {DAY})"""),
    "chain_other_names": _with(
        [part.replace("5e-1 + speed_norm * 3e-1 + price_norm * 2e-1",
                      "25e-2 + speed_norm * 5e-1 + price_norm * 25e-2") for part in LEADERBOARD],
        "SELECT entity_id AS key, entity_name AS label, snapshot_date, rank, composite_score, "
        "cost_tier FROM board",
    ),
    "stream_correction": _with([SNAP, _CORRECTED], _trends("given")),
    "stream_correction_board": _with(
        [SNAP, _CORRECTED, *_of(LEADERBOARD[1:], "given")], "SELECT * FROM board"
    ),
}
ORACLE["flat_table"] = ORACLE["landing_rows"]

_STATE_SPANS = """
SELECT b.snapshot_date, d.days, a.quality
FROM (SELECT DISTINCT snapshot_date FROM snap) b, (VALUES (7), (30)) d(days), snap a
WHERE a.snapshot_date <= b.snapshot_date AND a.snapshot_date > b.snapshot_date - d.days
UNION ALL
SELECT (SELECT max(snapshot_date) FROM snap), NULL, quality FROM snap"""

_VERSIONS = """
given AS (
  SELECT 1 AS load, entity_id, snapshot_date, quality, price_in FROM snap
  UNION ALL
  SELECT 2, entity_id, snapshot_date,
         CASE WHEN CAST(entity_id AS INTEGER) % 2 = 0 THEN quality + 1 ELSE quality END, price_in
  FROM snap WHERE year(snapshot_date) = 1997 AND CAST(entity_id AS INTEGER) % 7 <> 0
  UNION ALL
  SELECT 3, entity_id, snapshot_date, quality, price_in
  FROM snap WHERE year(snapshot_date) = 1997 AND month(snapshot_date) <= 6
), whole AS (
  SELECT l.load, s.entity_id, s.snapshot_date, g.quality, g.price_in, g.load IS NOT NULL AS there
  FROM (SELECT DISTINCT load, snapshot_date FROM given) l JOIN snap s USING (snapshot_date)
    LEFT JOIN given g ON g.load = l.load AND g.entity_id = s.entity_id AND g.snapshot_date = s.snapshot_date
), marked AS (
  SELECT *, lag(there) OVER w AS had, lag(quality) OVER w AS q, lag(price_in) OVER w AS p
  FROM whole WINDOW w AS (PARTITION BY entity_id, snapshot_date ORDER BY load)
), changes AS (
  SELECT *, lead(load) OVER (PARTITION BY entity_id, snapshot_date ORDER BY load) AS known_until
  FROM marked
  WHERE there <> coalesce(had, false) OR quality IS DISTINCT FROM q OR price_in IS DISTINCT FROM p
), versions AS (
  SELECT entity_id, snapshot_date, quality, price_in, CAST(load AS BIGINT) AS known_from,
         CAST(known_until AS BIGINT) AS known_until
  FROM changes WHERE there
)"""

ORACLE |= {
    "asof_purchases": """
WITH bought AS (
  SELECT user_id, ts AS bought_at, max({'purchase_id': event_id, 'amount': value}) AS best
  FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts
), joined AS (
  SELECT e.event_id, e.user_id, e.ts, e.event_type,
         CASE WHEN e.ts <= b.bought_at + INTERVAL 6 HOURS THEN b.bought_at END AS bought_at, best
  FROM events e ASOF LEFT JOIN bought b ON e.user_id = b.user_id AND e.ts >= b.bought_at
)
SELECT event_id, user_id, ts, event_type, bought_at,
       CASE WHEN bought_at IS NOT NULL THEN best.purchase_id END AS purchase_id,
       CASE WHEN bought_at IS NOT NULL THEN best.amount END AS amount
FROM joined""",
    "asof_orders": """
WITH urgent AS (
  SELECT o_custkey, o_orderdate AS urgent_date, max(o_orderkey) AS urgent_key
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL
)
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, urgent_date, urgent_key
FROM orders o ASOF LEFT JOIN urgent u ON o.o_custkey = u.o_custkey AND o.o_orderdate >= u.urgent_date""",
    "span_quantiles": _with([EVENTS, f"spans AS ({_STATE_SPANS})"], """
SELECT snapshot_date, CAST(days AS INTEGER) AS days, CAST(count(quality) AS BIGINT) AS n_values,
       CAST(cut AS DOUBLE) AS cut, true AS near
FROM spans, (VALUES (0.1e0), (0.5e0), (0.9e0)) c(cut) GROUP BY snapshot_date, days, cut"""),
    "set_changes": _with([EVENTS], """
, dates AS (
  SELECT snapshot_date AS newer, unnest([lag(snapshot_date) OVER w, lag(snapshot_date, 5) OVER w]) AS older
  FROM (SELECT DISTINCT snapshot_date FROM snap) WINDOW w AS (ORDER BY snapshot_date)
), pairs AS (
  SELECT older, newer, entity_id, bool_or(s.snapshot_date = older) AS was, bool_or(s.snapshot_date = newer) AS is_now
  FROM dates JOIN snap s ON s.snapshot_date IN (older, newer) WHERE older IS NOT NULL
  GROUP BY older, newer, entity_id
)
SELECT older, newer, count(*) FILTER (was AND is_now) AS kept, count(*) FILTER (NOT was) AS entered,
       count(*) FILTER (NOT is_now) AS dropped
FROM pairs GROUP BY older, newer"""),
    "month_entities": _with([EVENTS], """
SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, count(DISTINCT entity_id) AS entities
FROM snap GROUP BY 1"""),
    "correction_history": _with([SNAP, _VERSIONS], "SELECT * FROM versions"),
    "known_at_load": _with([SNAP, _VERSIONS], """
SELECT entity_id, snapshot_date, quality, price_in FROM versions
WHERE known_from <= 2 AND (known_until IS NULL OR known_until > 2)"""),
    "price_skyline": _with([SNAP], """
, priced AS (
  SELECT entity_id, snapshot_date, (price_in + price_out) / 2e0 AS mean_price, quality FROM snap
  WHERE price_in IS NOT NULL AND price_out IS NOT NULL AND quality IS NOT NULL
)
SELECT * FROM priced a WHERE NOT EXISTS (
  SELECT 1 FROM priced b WHERE b.snapshot_date = a.snapshot_date
    AND b.mean_price <= a.mean_price AND b.quality >= a.quality
    AND (b.mean_price < a.mean_price OR b.quality > a.quality))"""),
    "order_skyline": """
SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM lineitem a
WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM lineitem b WHERE b.l_returnflag = a.l_returnflag
    AND b.l_extendedprice <= a.l_extendedprice AND b.l_quantity >= a.l_quantity
    AND (b.l_extendedprice < a.l_extendedprice OR b.l_quantity > a.l_quantity))""",
}
ORACLE["state_trends"] = ORACLE["trends_gaps"]
ORACLE["chain_other_date"] = f"SELECT * RENAME (snapshot_date AS day) FROM ({ORACLE['trends_full']})"
ORACLE["repeated_load"] = _with([SNAP], """
, usable AS (SELECT * FROM snap WHERE CAST(entity_id AS INTEGER) % 4 <> 0)
SELECT table_name, CAST(count(DISTINCT snapshot_date) AS BIGINT) AS n_lines,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS last_version,
       CAST((SELECT count(*) FROM snap) - (SELECT count(*) FROM usable) AS BIGINT) AS envelopes,
       CAST(1 AS BIGINT) AS reject_loads
FROM usable, (VALUES ('flat'), ('cleaned')) t(table_name) GROUP BY table_name""")
ORACLE["presence_spells"] = ORACLE["spells_incremental"] = _with([EVENTS], """
, calendar AS (
  SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS n
  FROM (SELECT DISTINCT snapshot_date FROM snap)
), placed AS (
  SELECT entity_id, snapshot_date,
         n - row_number() OVER (PARTITION BY entity_id ORDER BY snapshot_date) AS island
  FROM snap JOIN calendar USING (snapshot_date)
)
SELECT entity_id, min(snapshot_date) AS first_date, max(snapshot_date) AS last_date,
       count(*) AS n_snapshots
FROM placed GROUP BY entity_id, island""")


def _agreement(rows: str, steps: int) -> str:
    """Kendall's tau-b by comparing all pairs of entities; ``rows`` has entity, date, value."""
    return f"""
, calendar AS (
  SELECT snapshot_date, lag(snapshot_date, {steps}) OVER (ORDER BY snapshot_date) AS prev_snapshot_date
  FROM (SELECT DISTINCT snapshot_date FROM snap)
), valued AS ({rows}), both_days AS (
  SELECT c.snapshot_date, n.entity_id, b.v AS x, n.v AS y
  FROM calendar c JOIN valued n ON n.snapshot_date = c.snapshot_date
  JOIN valued b ON b.snapshot_date = c.prev_snapshot_date AND b.entity_id = n.entity_id
  WHERE b.v IS NOT NULL AND n.v IS NOT NULL
), compared AS (
  SELECT a.snapshot_date, count(*) AS total,
         count(*) FILTER ((a.x < b.x AND a.y < b.y) OR (a.x > b.x AND a.y > b.y)) AS concordant,
         count(*) FILTER ((a.x < b.x AND a.y > b.y) OR (a.x > b.x AND a.y < b.y)) AS discordant,
         count(*) FILTER (a.x = b.x) AS tied_before, count(*) FILTER (a.y = b.y) AS tied_now,
         count(*) FILTER (a.x = b.x AND a.y = b.y) AS tied_both
  FROM both_days a JOIN both_days b
    ON a.snapshot_date = b.snapshot_date AND a.entity_id < b.entity_id
  GROUP BY 1
), sizes AS (SELECT snapshot_date, count(*) AS n_entities FROM both_days GROUP BY 1)
SELECT snapshot_date, prev_snapshot_date, coalesce(n_entities, 0) AS n_entities,
       coalesce(concordant, 0) AS concordant, coalesce(discordant, 0) AS discordant,
       coalesce(tied_before, 0) AS tied_before, coalesce(tied_now, 0) AS tied_now,
       coalesce(tied_both, 0) AS tied_both,
       round(CASE WHEN (total - tied_before) * (total - tied_now) > 0
             THEN (concordant - discordant)
                  / sqrt(CAST(total - tied_before AS DOUBLE) * (total - tied_now)) END + 3e-10, 6) + 0e0 AS tau_b
FROM calendar LEFT JOIN sizes USING (snapshot_date) LEFT JOIN compared USING (snapshot_date)
WHERE prev_snapshot_date IS NOT NULL"""


ORACLE["rank_agreement"] = _with(LEADERBOARD, _agreement(
    "SELECT entity_id, snapshot_date, rank AS v FROM board", 1
).replace("FROM snap)", "FROM board)"))
ORACLE["tied_agreement"] = _with([EVENTS], _agreement(
    "SELECT entity_id, snapshot_date, floor(quality / 2) AS v FROM snap", 5
))


def _frames(values: list[str], days: tuple[int, ...]) -> str:
    columns, windows = [], []
    for length in days:
        windows.append(
            f"w{length} AS (PARTITION BY entity_id ORDER BY snapshot_date RANGE BETWEEN "
            f"INTERVAL {length - 1} DAY PRECEDING AND CURRENT ROW)"
        )
        for name in values:
            day = "date_diff('day', DATE '1970-01-01', snapshot_date)"
            several = f"min({day}) OVER w{length} < max({day}) OVER w{length}"
            columns.append(
                f"count({name}) OVER w{length} AS {name}_{length}d_n, "
                f"round(avg({name}) OVER w{length} + 3e-10, 6) + 0e0 AS {name}_{length}d_mean, "
                f"round(stddev_samp({name}) OVER w{length} + 3e-10, 6) + 0e0 AS {name}_{length}d_volatility, "
                f"round(CASE WHEN {several} THEN regr_slope({name}, {day}) OVER w{length} END + 3e-10, 6) + 0e0 "
                f"AS {name}_{length}d_slope"
            )
    return f"SELECT entity_id, snapshot_date, {', '.join(columns)} FROM snap WINDOW {', '.join(windows)}"


ORACLE["event_windows"] = _with([EVENTS], _frames(["quality", "speed"], (7, 30)))
ORACLE["windows_incremental"] = _with([SNAP], _frames(["quality"], (31, 100)))

MEASURED = """
texts AS (
  SELECT snapshot_date, '{"supplier ' || entity_id || '": '
         || CASE WHEN speed IS NULL THEN '"none"' WHEN price_in = 0 THEN '[1, 2]'
            ELSE CAST(CAST(quality AS BIGINT) AS VARCHAR) END || '}' AS j
  FROM snap
), keyed AS (SELECT snapshot_date, j, unnest(json_keys(j)) AS key FROM texts),
kinds AS (
  SELECT snapshot_date, key,
         CASE json_type(j, '$."' || key || '"') WHEN 'VARCHAR' THEN 'string' WHEN 'ARRAY' THEN 'array'
         WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind
  FROM keyed
), keys AS (
  SELECT snapshot_date, key, count(*) AS n_rows, count(*) FILTER (kind = 'null') AS n_null,
         coalesce(string_agg(DISTINCT kind, ',' ORDER BY kind) FILTER (kind <> 'null'), '') AS kinds
  FROM kinds GROUP BY 1, 2
)"""

ORACLE["measured_keys"] = _with([SNAP, MEASURED], "SELECT * FROM keys")
# In these rows each key has one value a month, and it is never null.
ORACLE["measured_drift"] = _with([SNAP, MEASURED], """
, months AS (
  SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS earlier
  FROM (SELECT DISTINCT snapshot_date FROM keys)
), steps AS (
  SELECT k.*, m.earlier, p.kinds AS previous,
         (SELECT max_by(o.kinds, o.snapshot_date) FROM keys o
          WHERE o.key = k.key AND o.snapshot_date < k.snapshot_date) AS last_kinds
  FROM keys k JOIN months m USING (snapshot_date)
  LEFT JOIN keys p ON p.key = k.key AND p.snapshot_date = m.earlier
)
SELECT snapshot_date, key, 'new' AS change, last_kinds AS kinds_before, kinds AS kinds_now
FROM steps WHERE earlier IS NOT NULL AND last_kinds IS NULL
UNION ALL
SELECT snapshot_date, key, 'back', last_kinds, kinds
FROM steps WHERE last_kinds IS NOT NULL AND previous IS NULL
UNION ALL
SELECT snapshot_date, key, 'kinds', last_kinds, kinds FROM steps WHERE last_kinds <> kinds
UNION ALL
SELECT m.snapshot_date, k.key, 'gone', k.kinds, NULL
FROM keys k JOIN months m ON m.earlier = k.snapshot_date
WHERE NOT EXISTS (SELECT 1 FROM keys n WHERE n.key = k.key AND n.snapshot_date = m.snapshot_date)""")
ORACLE["measured_landing"] = _with([SNAP], """
SELECT snapshot_date, count(quality) AS n_index, sum(quality) AS index_total, CAST(0 AS BIGINT) AS n_absent
FROM snap GROUP BY 1""")
ORACLE["placed_trends"] = _with([SNAP], _trends("snap"))


def _renames(source: str, rows: str) -> str:
    """Links in the order of edits, each taken unless one of its entities is."""
    return f"""
WITH RECURSIVE {source.strip()}, named AS ({rows}), dates AS (
  SELECT snapshot_date AS d, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS before,
         lead(snapshot_date) OVER (ORDER BY snapshot_date) AS after
  FROM (SELECT DISTINCT snapshot_date FROM named)
), entered AS (
  SELECT n.snapshot_date AS day, n.entity_id AS id, n.entity_name AS name FROM named n JOIN dates ON d = n.snapshot_date
  WHERE before IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM named p WHERE p.entity_id = n.entity_id AND p.snapshot_date = before)
), dropped AS (
  SELECT after AS day, n.entity_id AS id, n.entity_name AS name FROM named n JOIN dates ON d = n.snapshot_date
  WHERE after IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM named p WHERE p.entity_id = n.entity_id AND p.snapshot_date = after)
), edges AS (
  SELECT day, b.id AS id_before, n.id AS id_now, b.name AS name_before, n.name AS name_now,
         levenshtein(lower(b.name), lower(n.name)) AS edits
  FROM dropped b JOIN entered n USING (day) WHERE levenshtein(lower(b.name), lower(n.name)) <= 2
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY edits, md5(lower(name_before) || ':' || lower(name_now)),
                               lower(name_before), lower(name_now)) AS r
  FROM edges
), greedy AS (
  SELECT day, 0::BIGINT AS r, false AS ok, []::VARCHAR[] AS gone, []::VARCHAR[] AS come
  FROM (SELECT DISTINCT day FROM edges)
  UNION ALL
  SELECT day, r, ok, CASE WHEN ok THEN list_append(gone, id_before) ELSE gone END,
         CASE WHEN ok THEN list_append(come, id_now) ELSE come END
  FROM (
    SELECT o.*, gone, come, NOT list_contains(gone, id_before) AND NOT list_contains(come, id_now) AS ok
    FROM greedy g JOIN ordered o ON o.day = g.day AND o.r = g.r + 1
  )
)
SELECT day AS snapshot_date, id_before, id_now, name_before, name_now, edits::INTEGER AS edits
FROM greedy JOIN ordered USING (day, r) WHERE ok"""


ORACLE["near_named_users"] = _renames(EVENTS, "SELECT snapshot_date, entity_id, entity_name FROM snap")
ORACLE["renamed_suppliers"] = _renames(SNAP, """
  SELECT snapshot_date, CASE WHEN other THEN 'r' || entity_id ELSE entity_id END AS entity_id,
         CASE WHEN NOT other THEN name WHEN k % 4 = 0 THEN substr(name, 2, 9) WHEN k % 4 = 1 THEN name || 'xy'
         WHEN k % 4 = 2 THEN substr(name, 1, 4) || '-' || substr(name, 6, 5) ELSE upper(name) END AS entity_name
  FROM (
    SELECT snapshot_date, entity_id, entity_id::INTEGER AS k, substr(md5(entity_name), 1, 10) AS name,
           entity_id::INTEGER % 7 = 3
           AND snapshot_date >= DATE '1994-01-01' + to_months(entity_id::INTEGER % 48) AS other
    FROM snap)""")
