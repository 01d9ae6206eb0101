"""DuckDB SQL for each registered query, over the same tables."""

from __future__ import annotations

from catalog.queries import AS_OF_INDEX, AS_OF_US, TWINS
from catalog.telemetry import JOINED_SQL, TEL_SQL
from millrace import constants as K
from millrace.operators.evaluate import FACTOR, PRIME

OVER = "(PARTITION BY line_id ORDER BY t_us, event_id)"
UPTO = "(PARTITION BY line_id ORDER BY t_us, event_id ROWS UNBOUNDED PRECEDING)"
KEYS = "line_id, event_id"
ES, D1, D2 = K.ESTOP, K.DOOR1, K.DOOR2
CYC = K.CYCLE_COUNT

LABEL = (
    "CASE Description WHEN 'NoNose' THEN 1 WHEN 'NoNose,NoBody2' THEN 2 "
    "WHEN 'NoNose,NoBody2,NoBody1' THEN 3 ELSE 0 END"
)
DOWN = f"coalesce({ES} = 0e0 OR {D1} = 0e0 OR {D2} = 0e0, FALSE)"

# Hidden drive temperature from its neighbours.
HIDDEN = (
    "SELECT * REPLACE ((Q_VFD1_Temperature + Q_VFD3_Temperature) / 2e0 "
    "AS Q_VFD2_Temperature) FROM {source}"
)


def transit(source: str, prefix: str = "", tick: str = "t_us") -> str:
    """CTEs ending in ``{prefix}timed``: source rows with the transit time."""
    p = prefix
    return f"""
{p}edges AS (SELECT *,
  coalesce({K.STOPPER1} = 0e0 AND lag({K.STOPPER1}) OVER {OVER} = 1e0, FALSE) AS rel,
  coalesce({K.STOPPER3} = 1e0 AND lag({K.STOPPER3}) OVER {OVER} = 0e0, FALSE) AS rec
  FROM {source}),
{p}released AS (SELECT *,
  last_value(CASE WHEN rel THEN {tick} END IGNORE NULLS) OVER {UPTO} AS last_rel
  FROM {p}edges),
{p}measured AS (SELECT *,
  CASE WHEN rec THEN ({tick} - last_rel) / 1e6 END AS measured_s
  FROM {p}released),
{p}timed AS (SELECT *,
  coalesce(last_value(measured_s IGNORE NULLS) OVER {UPTO}, 125e-1) AS {K.TRANSIT}
  FROM {p}measured)"""


def motion(source: str) -> str:
    """CTEs ending in ``moved``: velocity and acceleration, step by step."""
    joints = [(r, j) for r in K.ROBOTS for j in K.JOINTS]
    speeds = ", ".join(
        f"({K.angle(r, j)} - lag({K.angle(r, j)}) OVER {OVER}) / gap AS v_{r}_{j}"
        for r, j in joints
    )
    changes = ", ".join(
        f"(v_{r}_{j} - lag(v_{r}_{j}) OVER {OVER}) / gap AS a_{r}_{j}" for r, j in joints
    )
    return f"""
gap0 AS (SELECT *, coalesce((t_us - lag(t_us) OVER {OVER}) / 1e6, 1e0) AS gap1 FROM {source}),
gaps AS (SELECT *, CASE WHEN gap1 = 0e0 THEN 1e0 ELSE gap1 END AS gap FROM gap0),
speeds AS (SELECT *, {speeds} FROM gaps),
moved AS (SELECT *, {changes} FROM speeds)"""


SPEEDS = ", ".join(
    f"round(coalesce(v_{r}_{j}, 0e0), 6) AS {K.velocity(r, j)}"
    for r in K.ROBOTS
    for j in K.JOINTS
)
CHANGES = ", ".join(
    f"round(coalesce(a_{r}_{j}, 0e0), 6) AS {K.acceleration(r, j)}"
    for r in K.ROBOTS
    for j in K.JOINTS
)


def frame(rows: int) -> str:
    return (
        "(PARTITION BY line_id ORDER BY t_us, event_id "
        f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    )


def mean(column: str, rows: int) -> str:
    return f"avg({column}) OVER {frame(rows)}"


def deviation(column: str, rows: int) -> str:
    return f"coalesce(stddev_samp({column}) OVER {frame(rows)}, 0e0)"


def means(rows: int, suffix: str) -> str:
    return ", ".join(
        f"round({mean(K.load(r), rows)}, 6) AS {K.load(r)}_{suffix}" for r in K.ROBOTS
    )


def deviations(rows: int) -> str:
    return ", ".join(
        f"round({deviation(K.load(r), rows)}, 6) AS {K.load(r)}_Std10" for r in K.ROBOTS
    )


def draw(column: str) -> str:
    """kW of one drive: clip, then base plus share above the knee."""
    clipped = f"CASE WHEN {column} IS NULL THEN NULL ELSE greatest(5e1, least(11e1, {column})) END"
    return (
        f"(CASE WHEN {column} IS NULL THEN NULL "
        f"ELSE 85e-1 + greatest(0e0, {clipped} - 6e1) * 1e-1 END)"
    )


DRAW = "(" + " + ".join(draw(K.temperature(d)) for d in K.DRIVES) + ")"


def kpis(source: str) -> str:
    """CTE chain ending in ``kpi``: one row per line with all KPIs."""
    return f"""
kpi_rows AS (SELECT *,
  coalesce((t_us - lag(t_us) OVER {OVER}) / 1e6, 1e-1) AS dt,
  {DRAW} AS row_draw, {LABEL} AS label
  FROM {source}),
kpi_sums AS (SELECT line_id,
  sum(dt) AS elapsed_s,
  sum(CASE WHEN {ES} = 0e0 THEN dt ELSE 0e0 END) AS estop_s,
  sum(CASE WHEN {D1} = 0e0 THEN dt ELSE 0e0 END) AS door1_s,
  sum(CASE WHEN {D2} = 0e0 THEN dt ELSE 0e0 END) AS door2_s,
  sum(CASE WHEN {DOWN} THEN dt ELSE 0e0 END) AS downtime_s,
  count(DISTINCT CASE WHEN label > 0 THEN {CYC} END) AS defect_cycles,
  greatest(1, arg_max(CAST(trunc({CYC}) AS BIGINT), (t_us, event_id))) AS cycles,
  sum((6e1 - row_draw) * dt) / 36e2 AS saved_kwh
  FROM kpi_rows GROUP BY line_id),
kpi_last AS (SELECT line_id, row_draw AS draw_kw, 6e1 - row_draw AS saving_kw FROM (
  SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY t_us DESC, event_id DESC) AS back
  FROM kpi_rows) WHERE back = 1),
kpi_rates AS (SELECT *, elapsed_s - downtime_s AS operating_s,
  CASE WHEN elapsed_s > 0e0 THEN (elapsed_s - downtime_s) / elapsed_s ELSE 1e0 END AS availability,
  CASE WHEN elapsed_s - downtime_s > 0e0 THEN 3e2 * cycles / (elapsed_s - downtime_s) ELSE 1e0 END AS performance_ratio,
  (cycles - defect_cycles) / cycles::DOUBLE AS quality_ratio,
  (1e0 - defect_cycles / cycles::DOUBLE) * 1e2 AS yield_pct
  FROM kpi_sums),
kpi AS (SELECT r.*, l.draw_kw, l.saving_kw,
  greatest(0e0, least(1e0, performance_ratio)) AS performance,
  greatest(0e0, least(1e0, quality_ratio)) AS quality,
  availability * greatest(0e0, least(1e0, performance_ratio)) * greatest(0e0, least(1e0, quality_ratio)) AS oee,
  saved_kwh * 82e-2 AS carbon_drives_kg,
  defect_cycles * 25e-1 AS carbon_scrap_kg,
  defect_cycles * 42e-1 AS scrap_lbs,
  saved_kwh * 82e-2 + defect_cycles * 25e-1 AS carbon_total_kg
  FROM kpi_rates r JOIN kpi_last l USING (line_id))"""


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def health(column: str) -> str:
    return f"greatest(0e0, 1e2 - greatest(0e0, coalesce(({column} - 72e0) * 5e0, 0e0)))"


def robot(r: str, std: str) -> str:
    load = f"greatest(0e0, coalesce(({K.load(r)} - 15e2) / 3e1, 0e0))"
    vibration = f"greatest(0e0, coalesce(({std} - 12e1) / 2e0, 0e0))"
    return f"greatest(0e0, 1e2 - greatest({load}, {vibration}))"


def overlay(column: str) -> str:
    cases = "".join(
        f" WHEN scenario = {text(s)} THEN {v!r}"
        for s, o in K.SCENARIOS.items()
        for c, v in o.items()
        if c == column
    )
    return f"CASE{cases} ELSE {column} END" if cases else column


BANDS = ", ".join(
    f"CASE WHEN h{d} > 8e1 THEN 'good' WHEN h{d} > 5e1 THEN 'warn' ELSE 'bad' END AS VFD{d}_band"
    for d in K.DRIVES
)
INDEXED = f"idx AS (SELECT *, row_number() OVER {OVER} - 1 AS idx FROM {{source}})"
HASH = f"(((event_id % {PRIME}) * {FACTOR} + 42) % {PRIME})"
RATES = r6("availability", "performance", "quality", "oee")
LATEST = "arg_max({0}, (t_us, event_id))"


def _running() -> str:
    return f"""
rows AS (SELECT *, coalesce((t_us - lag(t_us) OVER {OVER}) / 1e6, 1e-1) AS dt,
  {LABEL} > 0 AS defect FROM tel),
firsts AS (SELECT *, CASE WHEN defect AND row_number() OVER
  (PARTITION BY line_id, {CYC}, defect ORDER BY t_us, event_id) = 1 THEN 1 ELSE 0 END AS fresh FROM rows),
sums AS (SELECT *, sum(dt) OVER {UPTO} AS elapsed_s,
  sum(CASE WHEN {DOWN} THEN dt ELSE 0e0 END) OVER {UPTO} AS downtime_s,
  CAST(sum(fresh) OVER {UPTO} AS BIGINT) AS defect_cycles,
  greatest(1, CAST(trunc({CYC}) AS BIGINT)) AS cycles FROM firsts),
rates AS (SELECT *,
  CASE WHEN elapsed_s > 0e0 THEN (elapsed_s - downtime_s) / elapsed_s ELSE 1e0 END AS availability,
  CASE WHEN elapsed_s - downtime_s > 0e0 THEN 3e2 * cycles / (elapsed_s - downtime_s) ELSE 1e0 END AS performance_ratio,
  greatest(0e0, least(1e0, (cycles - defect_cycles) / cycles::DOUBLE)) AS quality FROM sums)"""


def _alerts() -> str:
    scores = ", ".join(
        [f"{robot(r, deviation(K.load(r), 10))} AS {r}" for r in K.ROBOTS]
        + [f"{health(K.temperature(d))} AS VFD{d}" for d in K.DRIVES]
    )
    machines = " UNION ALL ".join(
        [f"SELECT line_id, 'robot_health', '{r}', {r} FROM scored" for r in K.ROBOTS]
        + [f"SELECT line_id, 'vfd_health', 'VFD{d}', VFD{d} FROM scored" for d in K.DRIVES]
    )
    lines = " UNION ALL ".join(
        f"SELECT line_id, '{m}' AS metric, 'line' AS subject, {m} AS value FROM kpi"
        for m in ("availability", "performance", "quality")
    )
    rules = ", ".join(
        f"({text(m)}, {limit!r}::DOUBLE, {text(advice)})" for m, limit, advice in K.ALERT_RULES
    )
    return f"""WITH {TEL_SQL}, hidden AS ({HIDDEN.format(source='tel')}), {kpis('tel')},
all_scored AS (SELECT line_id, {scores}, row_number() OVER {OVER} - 1 AS idx FROM hidden),
scored AS (SELECT * FROM all_scored WHERE idx = {AS_OF_INDEX}),
metrics AS (SELECT line_id, metric, subject, round(value, 6) AS value FROM ({lines} UNION ALL {machines})),
rules(metric, "limit", advice) AS (VALUES {rules})
SELECT line_id, metric, subject, value, "limit", advice
FROM metrics JOIN rules USING (metric) WHERE value < "limit" """


def _report() -> str:
    return """WITH pairs AS (SELECT quality AS label, toxic AS predicted, count(*) AS n FROM labels GROUP BY ALL),
classes AS (SELECT label AS c FROM pairs UNION SELECT predicted FROM pairs),
counts AS (SELECT c,
  (SELECT coalesce(sum(n), 0) FROM pairs WHERE label = c)::BIGINT AS support,
  (SELECT coalesce(sum(n), 0) FROM pairs WHERE predicted = c)::BIGINT AS predicted,
  (SELECT coalesce(sum(n), 0) FROM pairs WHERE label = c AND predicted = c)::BIGINT AS hits FROM classes),
ratios AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0e0 END AS p,
  CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0e0 END AS r FROM counts),
scored AS (SELECT *, CASE WHEN p + r > 0 THEN 2e0 * p * r / (p + r) ELSE 0e0 END AS f FROM ratios),
lines AS (
  SELECT c::VARCHAR AS class_name, p, r, f, support FROM scored
  UNION ALL SELECT 'accuracy', sum(hits) / sum(support)::DOUBLE, sum(hits) / sum(support)::DOUBLE,
    sum(hits) / sum(support)::DOUBLE, sum(support)::BIGINT FROM scored
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support)::BIGINT FROM scored
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
    sum(f * support) / sum(support), sum(support)::BIGINT FROM scored)
SELECT class_name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM lines"""


def oracle_sql() -> dict[str, str]:
    with_tel = f"WITH {TEL_SQL}"
    hidden = f"hidden AS ({HIDDEN.format(source='tel')})"
    sources = ", ".join(
        c
        for s in K.SOURCES
        for c in K.SOURCE_COLUMNS[s]
        if c not in K.MASKED_COLUMNS
    )
    ms_text = (
        "CASE WHEN event_id % 13 = 0 THEN 'no signal' "
        "WHEN event_id % 4 = 0 THEN strftime(make_timestamp(t_us), '%Y-%m-%dT%H:%M:%SZ') "
        "ELSE strftime(make_timestamp(t_us), '%Y-%m-%dT%H:%M:%S.%gZ') END"
    )
    us_text = (
        "CASE WHEN event_id % 41 = {0} THEN 'no signal' "
        "ELSE strftime(make_timestamp(t_us), '%Y-%m-%dT%H:%M:%S.%fZ') END"
    )
    joined_hidden = f"{with_tel}, {JOINED_SQL}, hidden AS ({HIDDEN.format(source='joined')})"
    gold = f"""{joined_hidden}, {transit('hidden')}, {motion('timed')}
SELECT {KEYS}, {K.TRANSIT}, {SPEEDS}, {CHANGES},
  {means(10, 'MA10')}, {means(60, 'MA60')}, {deviations(10)},
  round({mean(K.TRANSIT, 50)} + 3e-8, 6) AS {K.TRANSIT_MA50},
  CASE WHEN {K.TRANSIT} > 155e-1 THEN 1 ELSE 0 END AS {K.BOTTLENECK},
  {LABEL} AS {K.LABEL} FROM moved"""
    timed_gold = gold.replace(f"SELECT {KEYS}, ", f"SELECT {KEYS}, t_us, ", 1)
    early_gold = (
        f"SELECT {KEYS}, t_us, {K.TRANSIT}, {K.load('R01')}_MA60, {K.LABEL} "
        f"FROM ({timed_gold}) AS g WHERE t_us <= {AS_OF_US}"
    )
    edges = f"""{with_tel}, {transit('tel')}
SELECT {KEYS}, rel::INT AS is_release1, rec::INT AS is_receipt3 FROM edges"""
    filled = f"""{with_tel} SELECT {KEYS},
last_value(Q_VFD1_Temperature IGNORE NULLS) OVER {UPTO} AS filled_temperature FROM tel"""
    transit_time = f"{with_tel}, {transit('tel')} SELECT {KEYS}, {K.TRANSIT} FROM timed"
    acceleration = f"{with_tel}, {motion('tel')} SELECT {KEYS}, {CHANGES} FROM moved"
    mean60 = f"{with_tel} SELECT {KEYS}, {means(60, 'MA60')} FROM tel"
    index = f"{with_tel}, {INDEXED.format(source='tel')} SELECT {KEYS}, idx FROM idx"
    of_kpi = f"{with_tel}, {kpis('tel')} SELECT {{0}} FROM kpi"
    of_hidden_kpi = f"{with_tel}, {hidden}, {kpis('hidden')} SELECT {{0}} FROM kpi"
    oee = of_kpi.format(f"line_id, cycles, defect_cycles, {RATES}")
    running = f"""{with_tel}, {_running()}
SELECT {KEYS}, cycles, defect_cycles, {r6('elapsed_s', 'downtime_s', 'availability', 'performance_ratio', 'quality')},
round(availability * greatest(0e0, least(1e0, performance_ratio)) * quality, 6) AS oee FROM rates"""
    titles = ", ".join(
        f"({n}, {text(t)}, {text(s)}, {text(m)})" for n, (t, s, m) in K.DEFECT_MESSAGES.items()
    )
    shares = ", ".join(
        f"({n}, {text(K.CLASS_NAMES[c])}, {p!r}::DOUBLE)"
        for n, ps in K.CLASS_CONFIDENCE.items()
        for c, p in enumerate(ps)
    )
    scenarios = ", ".join(f"({text(s)})" for s in K.SCENARIOS)
    breakdown = " UNION ALL ".join(
        f"SELECT line_id, {text(s)} AS state, round({c}, 6) AS seconds FROM kpi WHERE {c} > 0e0"
        for s, c in K.BREAKDOWN_STATES
    )
    healths = [f"round({health(K.temperature(d))}, 6)" for d in K.DRIVES]
    window_us = 600_000_000
    # The test rows of the split, and what any classifier's scores must be like.
    score_facts = (
        f"{with_tel}, labelled AS (SELECT {KEYS}, {LABEL} AS {K.LABEL} FROM tel), "
        f"split AS (SELECT *, row_number() OVER (PARTITION BY {K.LABEL} ORDER BY {HASH}, event_id) "
        f"<= round(2e-1 * count(*) OVER (PARTITION BY {K.LABEL})) AS is_test FROM labelled) "
        f"SELECT {KEYS}, {K.LABEL}, {len(K.CLASS_NAMES)}::INT AS n_classes, 1e0 AS total, "
        "TRUE AS is_likeliest, TRUE AS in_range FROM split WHERE is_test"
    )
    found = {
        "load_raw": f"{with_tel} SELECT line_id::DOUBLE AS line_id, {us_text.format(3)} AS _time, "
        f"{CYC}, {K.CYCLE_STATE}, Description FROM tel",
        "load_workbooks": f"{with_tel} SELECT line_id::DOUBLE AS line_id, {us_text.format(2)} AS _time, "
        f"{ES}, {D1}, {D2} FROM tel",
        "clean_headers": f"{with_tel} SELECT line_id, event_id, {K.load('R01')} AS Load_R01_N, {ES} FROM tel",
        "coerce_numeric": f"{with_tel} SELECT event_id::DOUBLE AS event_id, Description, "
        f"TRY_CAST(CASE WHEN event_id % 7 IN (0, 1) THEN 'bad' ELSE {K.load('R01')}::VARCHAR END AS DOUBLE) AS load_n FROM tel",
        "mask_columns": f"{with_tel} SELECT {KEYS}, {K.temperature(1)}, {K.stopper(1)} FROM tel",
        "parse_timestamp": f"{with_tel}, texts AS (SELECT event_id, {ms_text} AS time_text FROM tel) "
        "SELECT event_id, time_text, epoch_us(try_strptime(time_text, "
        "['%Y-%m-%dT%H:%M:%S.%gZ', '%Y-%m-%dT%H:%M:%SZ'])) AS parsed_us FROM texts",
        "bronze_roundtrip": f"{with_tel} SELECT line_id, event_id, {us_text.format(1)} AS _time, "
        + ", ".join(c for c in K.SOURCE_COLUMNS["conveyor"] if c not in K.MASKED_COLUMNS)
        + " FROM tel",
        "unify_sources": f"{with_tel}, {JOINED_SQL} SELECT {KEYS}, t_us, {sources} FROM joined",
        "unify_hot_instant": f"{with_tel}, few AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS n "
        "FROM tel WHERE line_id = 0 AND event_id % 41 = 8 ORDER BY event_id LIMIT 3), "
        + ", ".join(
            f"{name} AS (SELECT line_id, CASE WHEN {at} THEN 0 ELSE t_us END AS t_us, event_id AS {name}_id, "
            f"{', '.join(K.SOURCE_COLUMNS[name][:2])} FROM tel)"
            for name, at in (
                ("conveyor", "line_id = 0 AND event_id % 3 = 0"),
                ("safety", "event_id IN (SELECT event_id FROM few)"),
                ("cycle", "event_id IN (SELECT event_id FROM few WHERE n = 1)"),
            )
        )
        + " SELECT * FROM conveyor JOIN safety USING (line_id, t_us) JOIN cycle USING (line_id, t_us)",
        "silver_roundtrip": f"{joined_hidden}, {transit('hidden')} SELECT {KEYS}, t_us, "
        f"Q_VFD2_Temperature, {K.TRANSIT}, {K.STOPPER1}, Description FROM timed",
        "asof_prefix_gold": early_gold,
        "number_texts": f"{with_tel} SELECT event_id, printf('%.3f', event_id * 125e-3) AS value_text, "
        "printf('%+.1f', (event_id % 21 - 10) * 5e-1) AS change_text FROM tel",
        "gold_roundtrip": gold,
        "gold_roundtrip_sharded": gold,
        "gold_by_part": gold,
        "load_gold": f"{with_tel}, kept AS (SELECT * FROM tel WHERE event_id % 41 <> 1) "
        f"SELECT {KEYS}, make_timestamp(t_us) AS timestamp, "
        f"round(coalesce((t_us - lag(t_us) OVER {OVER}) / 1e6, 1e-1), 6) AS dt FROM kept",
        "lag_status": f"{with_tel} SELECT {KEYS}, lag({K.STOPPER1}) OVER {OVER} AS prev_stopper1, "
        f"lag({K.STOPPER3}) OVER {OVER} AS prev_stopper3 FROM tel",
        "edge_events": edges,
        "edge_events_sharded": edges,
        "forward_fill": filled,
        "forward_fill_sharded": filled,
        "transit_events": f"{with_tel}, {transit('tel')} SELECT {KEYS}, measured_s AS transit_time_seconds "
        "FROM measured WHERE rec",
        "transit_time": transit_time,
        "transit_time_sharded": transit_time,
        "transit_time_whole_seconds": f"{with_tel}, {transit('tel', tick='(t_us // 1000000 * 1000000)')} "
        f"SELECT {KEYS}, {K.TRANSIT} FROM timed",
        "row_dt": f"{with_tel}, gap AS (SELECT *, (t_us - lag(t_us) OVER {OVER}) / 1e6 AS g FROM tel) "
        f"SELECT {KEYS}, CASE WHEN g IS NULL OR g = 0e0 THEN 1e0 ELSE g END AS dt_feature, "
        "coalesce(g, 1e-1) AS dt_kpi FROM gap",
        "row_dt_sharded": f"{with_tel}, gap AS (SELECT *, (t_us - lag(t_us) OVER {OVER}) / 1e6 AS g FROM tel) "
        f"SELECT {KEYS}, CASE WHEN g IS NULL OR g = 0e0 THEN 1e0 ELSE g END AS dt_feature FROM gap",
        "joint_velocity": f"{with_tel}, {motion('tel')} SELECT {KEYS}, {SPEEDS} FROM moved",
        "joint_acceleration": acceleration,
        "joint_acceleration_sharded": acceleration,
        "rolling_mean10": f"{with_tel} SELECT {KEYS}, {means(10, 'MA10')} FROM tel",
        "rolling_mean10_extra": f"{with_tel} SELECT {KEYS}, {means(11, 'MA10')} FROM tel",
        "rolling_mean60": mean60,
        "rolling_mean60_sharded": mean60,
        "rolling_mean60_extra": f"{with_tel} SELECT {KEYS}, {means(61, 'MA60')} FROM tel",
        "rolling_std10": f"{with_tel} SELECT {KEYS}, {deviations(10)} FROM tel",
        "rolling_std10_extra": f"{with_tel} SELECT {KEYS}, {deviations(11)} FROM tel",
        "rolling_transit50": f"{with_tel}, {transit('tel')} SELECT {KEYS}, "
        f"round({mean(K.TRANSIT, 50)} + 3e-8, 6) AS {K.TRANSIT_MA50} FROM timed",
        "rolling_transit50_extra": f"{with_tel}, {transit('tel')} SELECT {KEYS}, "
        f"round({mean(K.TRANSIT, 51)} + 3e-8, 6) AS {K.TRANSIT_MA50} FROM timed",
        "position_index": index,
        "position_index_sharded": index,
        "row_at_index": f"{with_tel}, {INDEXED.format(source='tel')} SELECT {KEYS}, idx, "
        f"Q_VFD1_Temperature, {CYC} FROM idx WHERE idx = {AS_OF_INDEX}",
        "asof_prefix": f"{with_tel} SELECT {KEYS}, t_us, {CYC} FROM tel WHERE t_us <= {AS_OF_US}",
        "trailing_history": f"{with_tel}, {hidden}, {INDEXED.format(source='hidden')}, "
        "ends AS (SELECT *, max(idx) OVER (PARTITION BY line_id) AS last FROM idx) "
        f"SELECT {KEYS}, idx - greatest(0, last - 49) AS rel_index, "
        "Q_VFD1_Temperature, Q_VFD2_Temperature, Q_VFD3_Temperature FROM ends WHERE idx >= last - 49",
        "trailing_transits": f"{with_tel}, {transit('tel')}, {INDEXED.format(source='timed')}, "
        "ends AS (SELECT *, max(idx) OVER (PARTITION BY line_id) AS last FROM idx) "
        f"SELECT {KEYS}, idx - {AS_OF_INDEX} AS rel_index, {K.TRANSIT} FROM ends "
        f"WHERE last >= {AS_OF_INDEX} AND idx BETWEEN {AS_OF_INDEX} - 99 AND {AS_OF_INDEX}",
        "load_deviation": f"{with_tel} SELECT {KEYS}, "
        + ", ".join(
            f"round({K.load(r)} - {mean(K.load(r), 10)}, 6) AS {r}_load_vs_mean" for r in K.ROBOTS
        )
        + ", round((Q_VFD1_Temperature + Q_VFD3_Temperature) / 2e0 - Q_VFD1_Temperature, 6) AS vfd2_vs_vfd1 FROM tel",
        "vfd2_interpolated": f"{with_tel}, {hidden} SELECT {KEYS}, Q_VFD2_Temperature FROM hidden",
        "bottleneck_flag": f"{with_tel}, {transit('tel')} SELECT {KEYS}, "
        f"CASE WHEN {K.TRANSIT} > 155e-1 THEN 1 ELSE 0 END AS {K.BOTTLENECK} FROM timed",
        "transit_verdict": f"{with_tel}, {transit('tel')} SELECT {KEYS}, "
        f"CASE WHEN {K.TRANSIT} > 155e-1 THEN 'bottleneck' ELSE 'normal' END AS verdict, "
        f"CASE WHEN {K.TRANSIT} < 14e0 THEN '-0.2s' WHEN {K.TRANSIT} > 16e0 THEN '+3.1s Bottleneck!' END AS trend, "
        f"({K.TRANSIT} > 2e1)::INT AS jam FROM timed",
        "defect_label": f"{with_tel} SELECT {KEYS}, {LABEL} AS {K.LABEL} FROM tel",
        "downtime_rows": f"{with_tel} SELECT {KEYS}, {ES}, {D1}, {D2} FROM tel "
        f"WHERE {ES} = 0e0 OR {D1} = 0e0 OR {D2} = 0e0",
        "clip_temps": f"{with_tel} SELECT {KEYS}, "
        + ", ".join(
            f"CASE WHEN {t} IS NULL THEN NULL ELSE greatest(5e1, least(11e1, {t} * 3e0 - 14e1)) END AS clipped{d}"
            for d in K.DRIVES
            for t in [K.temperature(d)]
        )
        + " FROM tel",
        "stop_causes": f"{with_tel} SELECT {KEYS}, CASE WHEN {DOWN} THEN 'STOPPED' ELSE 'RUNNING' END AS line_state, "
        f"concat_ws(', ', CASE WHEN {ES} = 0e0 THEN {text(K.CAUSE_ESTOP)} END, "
        f"CASE WHEN {D1} = 0e0 THEN {text(K.CAUSE_DOOR1)} END, "
        f"CASE WHEN {D2} = 0e0 THEN {text(K.CAUSE_DOOR2)} END) AS causes FROM tel",
        "stopper_text": f"{with_tel} SELECT {KEYS}, "
        + ", ".join(
            f"CASE WHEN {K.stopper(n)} = 1e0 THEN 'Holding' ELSE 'Release' END AS stopper{n}"
            for n in (1, 3, 4, 5)
        )
        + " FROM tel",
        "robot_health": f"{with_tel} SELECT {KEYS}, "
        + ", ".join(
            f"round({robot(r, deviation(K.load(r), 10))}, 6) AS {r}_health" for r in K.ROBOTS
        )
        + " FROM tel",
        "vfd_health": f"{with_tel}, {hidden} SELECT {KEYS}, "
        + ", ".join(f"{h} AS VFD{d}_health" for d, h in zip(K.DRIVES, healths))
        + " FROM hidden",
        "health_band": f"{with_tel}, {hidden}, scored AS (SELECT {KEYS}, "
        + ", ".join(f"{h} AS h{d}" for d, h in zip(K.DRIVES, healths))
        + f" FROM hidden) SELECT {KEYS}, {BANDS} FROM scored",
        "scenario_overlay": f"{with_tel}, {hidden}, {transit('hidden')}, {INDEXED.format(source='timed')}, "
        f"scenarios(scenario) AS (VALUES {scenarios}), "
        f"base AS (SELECT *, {LABEL} AS {K.LABEL}, CASE WHEN {K.TRANSIT} > 155e-1 THEN 1 ELSE 0 END AS {K.BOTTLENECK} "
        f"FROM idx, scenarios WHERE idx = {AS_OF_INDEX}), "
        f"shown AS (SELECT {KEYS}, scenario, "
        + ", ".join(
            f"{overlay(c)} AS {c}"
            for c in (
                K.temperature(1),
                K.temperature(2),
                K.TRANSIT,
                K.BOTTLENECK,
                K.load("R03"),
                K.angle("R04", "S"),
                K.LABEL,
            )
        )
        + f" FROM base) SELECT *, {healths[0]} AS VFD1_health, {healths[1]} AS VFD2_health FROM shown",
        "vfd_power": f"{with_tel}, {hidden} SELECT {KEYS}, round({DRAW}, 6) AS draw_kw, "
        f"round(6e1 - {DRAW}, 6) AS saving_kw FROM hidden",
        "defect_lookup": f"{with_tel}, labelled AS (SELECT {KEYS}, {LABEL} AS {K.LABEL} FROM tel), "
        f"titles({K.LABEL}, defect_title, severity, message) AS (VALUES {titles}) "
        f"SELECT {KEYS}, {K.LABEL}, defect_title, severity, message FROM labelled LEFT JOIN titles USING ({K.LABEL})",
        "label_confidence": f"{with_tel}, labelled AS (SELECT {KEYS}, {LABEL} AS {K.LABEL} FROM tel), "
        f"shares({K.LABEL}, class_name, probability) AS (VALUES {shares}) "
        f"SELECT {KEYS}, {K.LABEL}, class_name, probability FROM labelled JOIN shares USING ({K.LABEL})",
        "kpi_oee": oee,
        "kpi_oee_sharded": oee,
        "kpi_oee_as_of": f"{with_tel}, early AS (SELECT * FROM tel WHERE t_us <= {AS_OF_US}), {kpis('early')} "
        f"SELECT line_id, cycles, defect_cycles, {RATES} FROM kpi",
        "kpi_oee_as_of_indexed": f"{with_tel}, {hidden}, {transit('hidden')}, "
        f"early AS (SELECT * FROM timed WHERE t_us <= {AS_OF_US}), {kpis('early')}, "
        f"means AS (SELECT line_id, avg({K.TRANSIT}) AS avg_transit_s FROM early GROUP BY line_id) "
        f"SELECT line_id, cycles, defect_cycles, {RATES}, {r6('saved_kwh', 'avg_transit_s')} "
        "FROM kpi JOIN means USING (line_id)",
        "trailing_as_of_indexed": f"{with_tel}, {hidden}, {INDEXED.format(source='hidden')}, "
        f"ends AS (SELECT *, max(idx) OVER (PARTITION BY line_id) AS last FROM idx WHERE t_us <= {AS_OF_US}) "
        f"SELECT {KEYS}, idx, idx - greatest(0, last - 49) AS rel_index, "
        "Q_VFD1_Temperature, Q_VFD2_Temperature, Q_VFD3_Temperature FROM ends WHERE idx >= last - 49",
        "kpi_availability": of_kpi.format(f"line_id, {r6('elapsed_s', 'operating_s', 'availability')}"),
        "kpi_downtime": of_kpi.format(f"line_id, {r6('estop_s', 'door1_s', 'door2_s', 'downtime_s')}"),
        "kpi_performance": of_kpi.format(f"line_id, cycles, {r6('performance_ratio', 'performance')}"),
        "kpi_defect_cycles": of_kpi.format("line_id, defect_cycles"),
        "kpi_quality": of_kpi.format(f"line_id, {r6('quality_ratio', 'quality', 'yield_pct')}"),
        "downtime_breakdown": f"{with_tel}, {kpis('tel')} {breakdown}",
        "kpi_avg_transit": f"{with_tel}, {transit('tel')} SELECT line_id, "
        f"round(avg({K.TRANSIT}) + 3e-8, 6) AS avg_transit_s FROM timed GROUP BY line_id",
        "label_distribution": f"{with_tel} SELECT {LABEL} AS {K.LABEL}, count(*) AS n_rows FROM tel GROUP BY 1",
        "esg_energy": of_hidden_kpi.format(f"line_id, {r6('saved_kwh')}"),
        "esg_current_power": of_hidden_kpi.format(f"line_id, {r6('draw_kw', 'saving_kw')}"),
        "esg_carbon": of_hidden_kpi.format(
            f"line_id, {r6('carbon_drives_kg', 'carbon_scrap_kg', 'scrap_lbs', 'carbon_total_kg')}"
        ),
        "esg_carbon_shares": f"{with_tel}, {hidden}, {kpis('hidden')} "
        "SELECT line_id, 'VFD Savings' AS part, round(greatest(1e-3, carbon_drives_kg), 6) AS kg_co2e FROM kpi "
        "UNION ALL SELECT line_id, 'Material Scrap Saved', round(greatest(1e-3, carbon_scrap_kg), 6) FROM kpi",
        "running_oee": running,
        "running_oee_sharded": running,
        "running_energy": f"{with_tel}, {hidden}, rows AS (SELECT *, {DRAW} AS draw, "
        f"coalesce((t_us - lag(t_us) OVER {OVER}) / 1e6, 1e-1) AS dt FROM hidden), "
        f"sums AS (SELECT *, coalesce(sum((6e1 - draw) * dt) OVER {UPTO}, 0e0) / 36e2 AS kwh FROM rows) "
        f"SELECT {KEYS}, round(draw, 6) AS draw_kw, round(kwh, 6) AS saved_kwh, "
        "round(kwh * 82e-2, 6) AS carbon_drives_kg FROM sums",
        "rule_alerts": _alerts(),
        "transit_forecast": f"{with_tel}, {transit('tel')}, "
        f"ends AS (SELECT line_id, {LATEST.format(K.TRANSIT)} AS last FROM timed GROUP BY line_id), "
        "steps AS (SELECT CAST(unnest(range(1, 16)) AS INT) AS step) "
        "SELECT line_id, step, round(last, 6) AS last_transit_s, "
        "round(CASE WHEN last > 155e-1 THEN last - 1e-1 * step ELSE 125e-1 END, 6) AS forecast_s FROM ends, steps",
        "classification_report": _report(),
        "stratified_split": f"{with_tel}, labelled AS (SELECT event_id, {LABEL} AS {K.LABEL} FROM tel) "
        f"SELECT event_id, {K.LABEL}, (row_number() OVER (PARTITION BY {K.LABEL} ORDER BY {HASH}, event_id) "
        f"<= round(2e-1 * count(*) OVER (PARTITION BY {K.LABEL})))::INT AS is_test FROM labelled",
        "time_split": f"{with_tel}, placed AS (SELECT t_us, row_number() OVER (ORDER BY t_us) AS k FROM tel WHERE t_us IS NOT NULL), "
        "cut AS (SELECT max(t_us) AS cut FROM placed WHERE k <= (SELECT count(*) - round(2e-1 * count(*)) FROM placed)) "
        "SELECT event_id, t_us, coalesce(t_us > cut, FALSE)::INT AS is_test FROM tel, cut",
        "train_score": score_facts,
        "boosted_score": score_facts,
        "softmax_score": f"SELECT *, TRUE AS beats_prior, {len(K.CLASS_NAMES) * K.TREES}::INT AS n_trees FROM ({score_facts})",
        "feature_matrix": f"{with_tel} SELECT event_id, "
        + ", ".join(
            f"coalesce({c}, 0e0) AS {c}"
            for c in (*[K.load(r) for r in K.ROBOTS], K.temperature(1), K.stopper(5))
        )
        + " FROM tel",
        "stream_transit": f"{with_tel}, {transit('tel')} SELECT {KEYS}, "
        f"round(coalesce((t_us - lag(t_us) OVER {OVER}) / 1e6, 1e-1), 6) AS dt, {K.TRANSIT} FROM timed",
        "stream_downtime": f"{with_tel}, {hidden}, {kpis('hidden')}, "
        f"windowed AS (SELECT *, t_us // {window_us} * {window_us} AS start FROM kpi_rows) "
        "SELECT line_id, start AS window_start_us, count(*) AS n_rows, "
        "round(sum(dt), 6) AS elapsed_s, "
        f"round(sum(CASE WHEN {ES} = 0e0 THEN dt ELSE 0e0 END), 6) AS estop_s, "
        f"round(sum(CASE WHEN {D1} = 0e0 THEN dt ELSE 0e0 END), 6) AS door1_s, "
        f"round(sum(CASE WHEN {D2} = 0e0 THEN dt ELSE 0e0 END), 6) AS door2_s, "
        f"round(sum(CASE WHEN {DOWN} THEN dt ELSE 0e0 END), 6) AS downtime_s, "
        "round(sum((6e1 - row_draw) * dt / 36e2), 6) AS saved_kwh FROM windowed "
        "GROUP BY line_id, start",
        "stream_unify": f"{with_tel} SELECT {KEYS}, t_us, "
        f"{', '.join(c for n in K.SOURCES for c in K.SOURCE_COLUMNS[n])} FROM tel "
        "WHERE event_id % 41 NOT BETWEEN 1 AND 7",
    }
    return found | {f"{name}_sharded": found[name] for name in TWINS}
