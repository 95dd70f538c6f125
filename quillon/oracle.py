"""DuckDB SQL for the engine's queries, worked out from the definitions by other means than the engine's.

Months are whole numbers (year * 12 + month - 1), so that every date rule is arithmetic on numbers; slices come from
unfolding each row into the four that it counts in; trailing windows and as-of values are joins with a maximum.
Steps are named queries; a query is put before its select list with those it needs."""

from __future__ import annotations

import re

from quillon.adapters import AS_OF, PROVIDER, SETTINGS, START
from quillon.plans.workforce import RULES as CATALOGUE

STEPS: dict[str, str] = {}
NOW, BEGIN = f"DATE '{AS_OF}'", f"DATE '{START}'"
LAST = AS_OF.year * 12 + AS_OF.month - 1
COLUMNS = "employee_id, country_code, business_unit, job_family, career_level, employment_type, hire_date, termination_date, termination_type, regretted_exit, source_system, record_updated_at"


def whole(select: str) -> str:
    """A select with all the steps it needs, each after those it reads itself."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\bs_[a-z_]+\b", sql):
            if name in STEPS and name not in order:
                visit(STEPS[name])
                order.append(name)

    visit(select)
    steps = ",\n".join(f"{n} AS ({STEPS[n]})" for n in order)
    if select.startswith("WITH"):  # has steps of its own
        kind, rest = ("WITH RECURSIVE", select[15:]) if select.startswith("WITH RECURSIVE ") else ("WITH", select[5:])
        return f"{kind} {steps},\n{rest}" if order else select
    return f"WITH {steps}\n{select}" if order else select


def _number(day: str) -> str:
    return f"(year({day}) * 12 + month({day}) - 1)"


def _first(n: str) -> str:
    return f"make_date(({n}) // 12, ({n}) % 12 + 1, 1)"


def _last(n: str) -> str:
    return f"({_first(f'({n}) + 1')} - 1)"


def _later(day: str, months: str) -> str:
    """The same day so many months later, or the last of a shorter month."""
    n = f"({_number(day)} + {months})"
    return f"({_first(n)} + (least(day({day}), day({_last(n)})) - 1)::INT)"


def _among(column: str, values, if_null: str) -> str:
    return f"coalesce({column} IN ({', '.join(repr(v) for v in values)}), {if_null})"


def _named(column: str, names: dict[str, str], otherwise: str = "NULL") -> str:
    return f"CASE {column} {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in names.items())} ELSE {otherwise} END"


# ---- lifecycle rows
STEPS["s_place"] = """SELECT o_orderkey, o_orderdate::DATE AS ordered, o_orderstatus, o_orderpriority, c_mktsegment, c_acctbal, n_name, r_name
 FROM orders, customer, nation, region WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey"""
STEPS["s_raw"] = """SELECT o_orderkey::VARCHAR AS employee_id, CASE WHEN c_acctbal < -900 THEN ' ' ELSE r_name END AS country_code, c_mktsegment AS business_unit,
 n_name AS job_family, o_orderpriority AS career_level, CASE WHEN c_acctbal < 0 THEN 'Fixed Term' ELSE 'Permanent' END AS employment_type,
 CASE WHEN c_acctbal BETWEEN -900 AND -800 THEN '' WHEN c_acctbal BETWEEN -800 AND -700 THEN strftime(ordered, '%Y-%m') ELSE strftime(ordered, '%Y-%m-%d') END AS hire_date,
 CASE WHEN l_orderkey IS NULL OR l_quantity = 1 THEN '' WHEN l_quantity = 2 AND c_acctbal < 0 THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS termination_date,
 CASE WHEN l_orderkey IS NULL OR l_quantity = 3 THEN '' WHEN o_orderstatus = 'F' THEN 'Voluntary' WHEN o_orderstatus = 'O' THEN 'Involuntary' ELSE 'End of Contract' END AS termination_type,
 CASE l_returnflag WHEN 'R' THEN 'true' WHEN 'N' THEN 'false' ELSE '' END AS regretted_exit, concat('HCM_', coalesce(l_returnflag, 'O')) AS source_system,
 strftime(coalesce(l_shipdate::DATE, ordered), '%Y-%m-%d') AS record_updated_at,
 o_orderkey * 1000 + row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber NULLS FIRST, l_shipdate::DATE, l_returnflag) AS source_row
 FROM s_place LEFT JOIN lineitem ON l_orderkey = o_orderkey"""
STEPS["s_single"] = f"SELECT min(source_row) AS source_row FROM s_raw GROUP BY {COLUMNS}"
STEPS["s_winner"] = "SELECT max({'at': record_updated_at, 'row': source_row}).row AS source_row FROM s_raw WHERE source_row IN (FROM s_single) GROUP BY employee_id"


def _text(column: str) -> str:
    return f"CASE WHEN length(trim({column})) > 0 THEN trim({column}) END"


STEPS["s_said"] = f"""SELECT employee_id, source_row, record_updated_at, {', '.join(f"{_text(c)} AS {n}" for c, n in (
    ("country_code", "place_said"), ("business_unit", "unit"), ("job_family", "family"), ("career_level", "level_said"), ("employment_type", "contract"), ("hire_date", "in_said"),
    ("termination_date", "out_said"), ("termination_type", "way"), ("source_system", "origin")))}, lower({_text("regretted_exit")}) AS regret
 FROM s_raw WHERE source_row IN (FROM s_winner)"""
STEPS["s_typed"] = f"""SELECT *, {_named('place_said', SETTINGS.country_names)} AS place, {_named('level_said', SETTINGS.level_aliases, 'level_said')} AS level,
 try_strptime(in_said, '%Y-%m-%d')::DATE AS in_day, try_strptime(out_said, '%Y-%m-%d')::DATE AS out_day FROM s_said"""

_ALLOWED = SETTINGS.allowed
_KNOWN = [
    _among("unit", _ALLOWED["business_unit"], "false"), _among("level", _ALLOWED["career_level"], "false"), _among("contract", _ALLOWED["employment_type"], "false"),
    _among("origin", _ALLOWED["source_system"], "true"), _among("way", _ALLOWED["termination_type"], "true"), _among("regret", ("true", "false"), "true"),
]
BREACHES = {
    "WF_COUNTRY_ALIAS": "place <> place_said",
    "WF_COUNTRY_MISSING": "place_said IS NULL",
    "WF_COUNTRY_UNKNOWN": "place IS NULL AND length(place_said) > 0",
    "WF_CAREER_LEVEL_ALIAS": "coalesce(level, '') <> coalesce(level_said, '')",
    "WF_CATEGORY_UNKNOWN": f"NOT ({' AND '.join(_KNOWN)})",
    "WF_DATE_UNPARSEABLE": "(in_said IS NULL) <> (in_day IS NULL) OR (out_said IS NULL) <> (out_day IS NULL)",
    "WF_HIRE_DATE_MISSING": "in_said IS NULL",
    "WF_HIRE_AFTER_AS_OF": f"date_diff('day', {NOW}, in_day) > 0",
    "WF_TERMINATION_BEFORE_HIRE": "date_diff('day', in_day, out_day) < 0",
    "WF_TERMINATION_AFTER_AS_OF": f"date_diff('day', {NOW}, out_day) > 0",
    "WF_TERMINATION_TYPE_MISSING": "way IS NULL AND length(out_said) > 0",
    "WF_TYPE_WITHOUT_DATE": "out_said IS NULL AND length(way) > 0",
    "WF_REGRETTED_UNKNOWN": "way = 'Voluntary' AND regret IS NULL",
    "WF_REGRETTED_NOT_VOLUNTARY": "regret = 'true' AND coalesce(way, '') <> 'Voluntary'",
    "WF_EOC_ON_PERMANENT": "concat(way, '/', contract) = 'End of Contract/Permanent'",
}
STEPS["s_broken"] = f"SELECT *, list_filter([{', '.join(f'CASE WHEN {p} THEN {i!r} END' for i, p in BREACHES.items())}], lambda r: r IS NOT NULL) AS rules FROM s_typed"
STEPS["s_event"] = """SELECT source_row, employee_id, CASE WHEN source_row IN (FROM s_single) THEN 'WF_ID_SUPERSEDED' ELSE 'WF_EXACT_DUPLICATE' END AS rule_id FROM s_raw WHERE source_row NOT IN (FROM s_winner)
 UNION ALL SELECT source_row, employee_id, unnest(rules) FROM s_broken"""


def _of(*severities: str) -> str:
    return "[" + ", ".join(repr(r.id) for r in CATALOGUE if r.severity in severities) + "]"


STEPS["s_person"] = f"""SELECT employee_id, place AS country_code, unit AS business_unit, family AS job_family, level AS career_level, contract AS employment_type, in_day AS hire_date, gone AS exit_date,
 CASE WHEN gone IS NOT NULL THEN way END AS exit_type,
 CASE WHEN gone IS NULL OR coalesce(way, '') <> 'Voluntary' THEN 'not_applicable' ELSE {_named('regret', {'true': 'regretted', 'false': 'not_regretted'}, "'unknown'")} END AS regretted_status,
 len(list_intersect(rules, {_of('error', 'exclude')})) = 0 AS is_measurable, len(list_intersect(rules, {_of('error', 'exclude', 'exclude_country')})) = 0 AS in_country_scope,
 array_to_string(list_sort(rules), '|') AS quality_rules, place_said AS country_code_raw, level_said AS career_level_raw, in_said AS hire_date_raw, out_said AS termination_date_raw,
 regret AS regretted_exit_raw, origin AS source_system, record_updated_at::DATE AS record_updated_at, source_row
 FROM (SELECT *, CASE WHEN date_diff('day', out_day, {NOW}) >= 0 THEN out_day END AS gone FROM s_broken)"""
STEPS["s_scope"] = f"""SELECT *, CASE WHEN in_country_scope THEN country_code ELSE '(unassigned)' END AS country_key, business_unit AS segment_value, {_number('hire_date')} AS n_in, {_number('exit_date')} AS n_out,
 (regretted_status = 'regretted')::INT AS sure, (regretted_status IN ('regretted', 'unknown'))::INT AS maybe FROM s_person WHERE is_measurable"""

# ---- cohorts
_VARIANTS = ", ".join(f"('{o}', '{v}', {m}, '{level}')" for o, v, m, level in SETTINGS.variants)
STEPS["s_member"] = f"""SELECT objective_id, variant, employee_id, country_key, segment_value, {_first('n_in')} AS cohort_month, hire_date, exit_date, {_later('hire_date', 'months')} AS anniversary,
 coalesce(date_diff('day', exit_date, {_later('hire_date', 'months')}) > 0, false) AS lost, date_diff('day', {_later(_last('n_in'), 'months')}, {NOW}) >= 0 AS cohort_mature
 FROM s_scope, (VALUES {_VARIANTS}) AS x(objective_id, variant, months, level) WHERE level = career_level AND date_diff('day', {BEGIN}, hire_date) >= 0 AND date_diff('day', hire_date, {NOW}) >= 0"""


def _unfolded(step: str) -> str:
    """Every row in the four slices that it counts in; no slice is named after no country."""
    return f"""(SELECT * FROM (SELECT *, unnest([segment_value, 'All']) AS part FROM (SELECT *, unnest([country_key, 'ALL']) AS land FROM {step})) WHERE land <> '(unassigned)')"""


STEPS["s_monthly"] = f"""SELECT objective_id, variant, cohort_month, land AS country_code, part AS segment_value, (count(*) - sum(lost::INT))::BIGINT AS numerator, count(*) AS denominator, min(cohort_mature::INT) = 1 AS all_mature
 FROM {_unfolded('s_member')} GROUP BY objective_id, variant, cohort_month, land, part"""
STEPS["s_cohort"] = f"""SELECT objective_id, variant, grain, {_first('p')} AS period_start, country_code, segment_value, numerator, denominator, {_last('p + width - 1')} AS period_end,
 date_diff('day', {_later(_last('p + width - 1'), 'months')}, {NOW}) >= 0 AS is_mature
 FROM (SELECT objective_id, variant, grain, width, {_number('cohort_month')} // width * width AS p, land AS country_code, part AS segment_value, (count(*) - sum(lost::INT))::BIGINT AS numerator, count(*)::DOUBLE AS denominator
       FROM {_unfolded('s_member')}, (VALUES ('month', 1), ('quarter', 3), ('year', 12)) AS g(grain, width) GROUP BY ALL)
 JOIN (VALUES {', '.join(f"('{o.id}', {o.months})" for o in SETTINGS.objectives)}) AS o(objective_id, months) USING (objective_id)"""

# ---- months of persons
STEPS["s_risk"] = f"""SELECT {_first('n')} AS month_start, country_key, segment_value, count(*) AS at_risk, sum((n = n_out)::INT)::BIGINT AS exits, sum((n = n_out)::INT * sure)::BIGINT AS regretted, sum((n = n_out)::INT * maybe)::BIGINT AS regretted_upper
 FROM (SELECT * REPLACE (coalesce(n_out, -1) AS n_out), unnest(range(n_in + 1, least(coalesce(n_out, {LAST}), {LAST}) + 1)) AS n FROM s_scope) GROUP BY n, country_key, segment_value"""
STEPS["s_change"] = """SELECT n, country_key, segment_value, sum(d) AS d, sum(r) AS r, sum(u) AS u FROM
 (SELECT n_in AS n, country_key, segment_value, 1 AS d, 0 AS r, 0 AS u FROM s_scope UNION ALL SELECT n_out, country_key, segment_value, -1, sure, maybe FROM s_scope WHERE n_out IS NOT NULL) GROUP BY ALL"""
STEPS["s_heads"] = f"""SELECT m.n, k.country_key, k.segment_value, coalesce(sum(c.d), 0)::BIGINT AS headcount, coalesce(sum(c.r) FILTER (WHERE c.n = m.n), 0)::BIGINT AS regretted, coalesce(sum(c.u) FILTER (WHERE c.n = m.n), 0)::BIGINT AS regretted_upper
 FROM (SELECT unnest(range((SELECT min(n_in) FROM s_scope), {LAST} + 1)) AS n) m CROSS JOIN (SELECT DISTINCT country_key, segment_value FROM s_scope) k
 LEFT JOIN s_change c ON c.country_key = k.country_key AND c.segment_value = k.segment_value AND c.n <= m.n GROUP BY ALL"""
STEPS["s_sliced"] = f"SELECT n, land, part, sum(headcount) AS h, sum(regretted) AS r, sum(regretted_upper) AS u FROM {_unfolded('s_heads')} GROUP BY n, land, part"
STEPS["s_year"] = f"""SELECT {_last('a.n')} AS month_end, a.land AS country_code, a.part AS segment_value, sum(b.r)::BIGINT AS regretted_ttm, sum(b.u)::BIGINT AS regretted_upper_ttm, sum(b.h)::DOUBLE / count(*) AS avg_headcount_ttm, count(*) AS months_in_window
 FROM s_sliced a JOIN s_sliced b ON b.land = a.land AND b.part IS NOT DISTINCT FROM a.part AND a.n - b.n BETWEEN 0 AND 11 GROUP BY a.n, a.land, a.part"""


# ---- measures
def _bounds(k: str, n: str) -> tuple[str, str]:
    """The two roots p of (k/n - p)^2 = z^2 p (1 - p) / n; null where k in n is no proportion."""
    z2 = "(1.96::DOUBLE * 1.96::DOUBLE)"
    a, b, c = f"(1 + {z2} / {n})", f"(2 * {k} / {n} + {z2} / {n})", f"({k} / {n} * {k} / {n})"
    root = lambda sign: f"CASE WHEN {n} > 0 AND {k} >= 0 AND {k} <= {n} THEN ({b} {sign} sqrt({b} * {b} - 4 * {a} * {c})) / (2 * {a}) END"
    return root("-"), root("+")


_LOW, _HIGH = _bounds("numerator::DOUBLE", "denominator::DOUBLE")
STEPS["s_figure"] = f"""SELECT objective_id, variant, grain, period_start, period_end, country_code, segment_value, numerator, denominator, is_mature FROM s_cohort
 UNION ALL SELECT 'REGRETTED_TURNOVER_12M', variant, grain, {_first(f"{_number('month_end')} // width * width")}, month_end, country_code, segment_value, n, avg_headcount_ttm, true
 FROM (SELECT *, unnest(['main', 'upper_bound_unknown']) AS variant, unnest([regretted_ttm, regretted_upper_ttm]) AS n FROM s_year WHERE months_in_window = 12 AND date_diff('day', {BEGIN}, month_end) >= 0),
 (VALUES ('month', 1), ('quarter', 3), ('year', 12)) AS g(grain, width) WHERE ({_number('month_end')} + 1) % width = 0"""
STEPS["s_bounded"] = f"""SELECT s_figure.*, target, direction, way, CASE WHEN denominator > 0 THEN numerator / denominator END AS share, {_LOW} AS lo, {_HIGH} AS hi
 FROM s_figure JOIN (VALUES {', '.join(f"('{o.id}', {o.target}::DOUBLE, '{o.direction}', {1 if o.direction == 'at_least' else -1})" for o in SETTINGS.objectives)}) AS o(objective_id, target, direction, way) USING (objective_id)"""
STEPS["s_measure"] = f"""SELECT objective_id, variant, grain, period_start, period_end, country_code, segment_value, numerator, round(denominator, 9) AS denominator,
 CASE WHEN is_mature THEN round(share, 9) END AS rate, CASE WHEN is_mature THEN round(lo, 9) END AS ci_low, CASE WHEN is_mature THEN round(hi, 9) END AS ci_high, target, direction,
 CASE WHEN NOT is_mature THEN 'pending' WHEN denominator < {SETTINGS.min_sample} THEN 'insufficient_sample' WHEN way * (share - target) >= 0 THEN 'met' ELSE 'not_met' END AS status,
 CASE WHEN is_mature AND denominator >= {SETTINGS.min_sample} THEN CASE WHEN target BETWEEN lo AND hi OR lo IS NULL THEN 'within_uncertainty' ELSE 'clear' END END AS confidence FROM s_bounded"""

# ---- external series
STEPS["s_part"] = """SELECT 'ship_lines' AS indicator_id, 'M' AS frequency, r_name AS geo, strftime(l_shipdate, '%Y-%m') AS source_period, NULL::VARCHAR AS release_code, 0 AS copy, count(*)::DOUBLE AS value
  FROM lineitem JOIN s_place ON l_orderkey = o_orderkey GROUP BY ALL
 UNION ALL SELECT 'ship_quantity', 'Q', r_name, year(l_shipdate) || '-Q' || quarter(l_shipdate), NULL, 0, sum(l_quantity::BIGINT)::DOUBLE FROM lineitem JOIN s_place ON l_orderkey = o_orderkey GROUP BY ALL
 UNION ALL SELECT 'order_count', 'A', r_name, year(ordered)::VARCHAR, NULL, 0, count(*)::DOUBLE FROM s_place GROUP BY ALL
 UNION ALL SELECT 'order_status', 'M', r_name, strftime(ordered, '%Y-%m'), CASE o_orderstatus WHEN 'F' THEN 'FIN' ELSE 'FLS' END, 0, count(*)::DOUBLE FROM s_place WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL
 UNION ALL SELECT 'rare_orders', 'M', n_name, strftime(ordered, '%Y-%m'), NULL, c, count(*)::DOUBLE FROM s_rare, (VALUES (0), (1)) AS v(c) WHERE c = 0 OR month(ordered) = 2 GROUP BY ALL
 UNION ALL SELECT 'rare_orders', 'M', n_name, strftime(ordered, '%Y-%m') || '?', NULL, 0, count(*)::DOUBLE FROM s_rare WHERE month(ordered) = 3 GROUP BY ALL
 UNION ALL SELECT DISTINCT 'rare_orders', 'M', n_name, year(ordered) || '-01', 'LATE', 0, NULL::DOUBLE FROM s_rare WHERE month(ordered) = 4"""
STEPS["s_rare"] = "SELECT n_name, ordered FROM s_place WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'"
STEPS["s_staged"] = f"""SELECT * EXCLUDE (copy), '{PROVIDER}' AS provider, 'set_' || indicator_id AS dataset, CASE WHEN value <= 1 THEN 'p' END AS status, CASE WHEN value <= 1 THEN 'provisional' END AS status_label,
 source_period || 'T00:00' AS source_updated, '2001-07-01' AS fetched_at, sha256(indicator_id) AS snapshot_sha256 FROM s_part"""
_GEO = {g: c for (_, g), c in SETTINGS.geo_map.items()}
STEPS["s_period"] = f"""SELECT *, {_named('geo', _GEO)} AS country_code, CASE WHEN n IS NOT NULL THEN {_first('n')} END AS period_start, CASE WHEN n IS NOT NULL THEN {_last('n + width - 1')} END AS period_end FROM
 (SELECT *, CASE frequency WHEN 'M' THEN 1 WHEN 'Q' THEN 3 ELSE 12 END AS width,
  CASE frequency WHEN 'M' THEN {_number("try_strptime(source_period, '%Y-%m')")}
   WHEN 'Q' THEN try_cast(split_part(source_period, '-Q', 1) AS INT) * 12 + (try_cast(split_part(source_period, '-Q', 2) AS INT) - 1) * 3
   ELSE try_cast(source_period AS INT) * 12 END AS n FROM s_staged)"""
STEPS["s_gap"] = f"""SELECT indicator_id, geo, release_code, unnest(range(n + width, following, width)) AS n FROM
 (SELECT *, lead(n) OVER (PARTITION BY indicator_id, geo, release_code ORDER BY n) AS following FROM (SELECT DISTINCT indicator_id, geo, release_code, n, width FROM s_period WHERE n + value IS NOT NULL))"""
STEPS["s_flag"] = """SELECT indicator_id, geo, source_period, release_code, unnest(list_filter([CASE WHEN country_code IS NULL THEN 'EX_GEO_UNMAPPED' END, CASE WHEN n IS NULL THEN 'EX_PERIOD_UNPARSEABLE' END,
  CASE WHEN value IS NULL THEN 'EX_VALUE_MISSING' END, CASE WHEN length(status) > 0 THEN 'EX_STATUS_FLAGGED' END], lambda r: r IS NOT NULL)) AS rule_id FROM s_period
 UNION ALL SELECT indicator_id, geo, source_period, release_code, 'EX_GRAIN_DUPLICATE' FROM s_period GROUP BY ALL HAVING count(*) >= 2"""
STEPS["s_xevent"] = f"SELECT * FROM s_flag UNION ALL SELECT indicator_id, geo, strftime({_first('n')}, '%Y-%m-%d'), release_code, 'EX_PERIOD_GAP' FROM s_gap"
_LENS = {i: x[0] for i, x in SETTINGS.indicators.items()}
_UNIT = {i: x[2] for i, x in SETTINGS.indicators.items()}
STEPS["s_seen"] = f"""SELECT p.indicator_id, {_named('p.indicator_id', _LENS)} AS lens, country_code, frequency, period_start, period_end, value, {_named('p.indicator_id', _UNIT)} AS unit, status, status_label, release_code,
 coalesce((SELECT string_agg(DISTINCT f.rule_id, '|' ORDER BY f.rule_id) FROM s_flag f WHERE f.indicator_id = p.indicator_id AND f.geo = p.geo AND f.source_period = p.source_period AND coalesce(f.release_code, '') = coalesce(p.release_code, '')), '') AS quality_rules,
 provider, dataset, geo AS source_geo, source_period, source_updated, fetched_at AS loaded_at, snapshot_sha256 FROM s_period p WHERE value IS NOT NULL AND country_code IS NOT NULL AND n IS NOT NULL"""
STEPS["s_missed"] = f"SELECT indicator_id, {_named('geo', _GEO)} AS country_code, coalesce(release_code, '') AS release, count(*) AS gaps FROM s_gap GROUP BY ALL"
STEPS["s_cover"] = """SELECT o.*, coalesce(m.gaps, 0)::BIGINT AS gaps FROM (SELECT indicator_id, lens, country_code, release_code, frequency, min(period_start) AS first_period_start, max(period_end) AS last_period_end, count(*) AS values_present,
 max(source_updated) AS source_updated, max(loaded_at) AS loaded_at FROM s_seen GROUP BY indicator_id, lens, country_code, release_code, frequency) o
 LEFT JOIN s_missed m ON m.indicator_id = o.indicator_id AND m.country_code = o.country_code AND m.release = coalesce(o.release_code, '')"""

# ---- what was known when
_SIGNALS = ", ".join(f"('{x.indicator_id}', {x.lag_days}, {(x.release or '')!r})" for x in SETTINGS.signals)
STEPS["s_value"] = f"""SELECT indicator_id, country_code, frequency, period_start, period_end, value, status, status_label, period_end + lag AS available_from
 FROM s_seen JOIN (VALUES {_SIGNALS}) AS t(indicator_id, lag, release) USING (indicator_id) WHERE coalesce(release_code, '') = release"""
_GRID = SETTINGS.signal_grid_start
STEPS["s_grid"] = f"""SELECT {_first('n')} AS as_of_date, country_code, indicator_id FROM (SELECT unnest(range({_GRID.year * 12 + _GRID.month - 1}, {LAST} + 1)) AS n), (SELECT DISTINCT country_code FROM s_seen), (SELECT unnest({[x.indicator_id for x in SETTINGS.signals]}) AS indicator_id)"""
STEPS["s_newest"] = """SELECT g.as_of_date, g.country_code, g.indicator_id, max({'a': available_from, 'e': period_end, 's': period_start, 'v': value, 'f': frequency, 'x': status, 'y': status_label}) AS b
 FROM s_grid g LEFT JOIN s_value v ON v.indicator_id = g.indicator_id AND v.country_code = g.country_code AND v.available_from <= g.as_of_date GROUP BY ALL"""
STEPS["s_known"] = """SELECT as_of_date, country_code, indicator_id, b.v AS value, b.f AS signal_frequency, b.s AS signal_period_start, b.e AS signal_period_end, b.a AS available_from, (as_of_date - b.e)::INT AS signal_age_days,
 b.x AS signal_status, b.y AS signal_status_label FROM s_newest"""
STEPS["s_cell"] = f"""SELECT objective_id, indicator_id, country_code, as_of_date, n, events, value FROM (
  SELECT objective_id, country_key AS country_code, cohort_month AS as_of_date, count(*) AS n, sum(lost::INT)::BIGINT AS events FROM s_member WHERE variant = 'main' AND cohort_mature GROUP BY ALL
  UNION ALL SELECT 'REGRETTED_TURNOVER_12M', country_key, month_start, sum(at_risk)::BIGINT, sum(regretted)::BIGINT FROM s_risk WHERE date_diff('day', {BEGIN}, month_start) >= 0 GROUP BY ALL)
 JOIN s_known USING (country_code, as_of_date) WHERE country_code <> '(unassigned)'"""

# ---- a logistic regression on one signal: Newton's steps on two sums of gradients and three of curvature
_FIT = """WITH RECURSIVE c AS (SELECT objective_id, indicator_id, n::DOUBLE AS n, events::DOUBLE AS e, value, value - avg(value) OVER (PARTITION BY objective_id, indicator_id, country_code) AS off FROM s_cell WHERE value IS NOT NULL),
u AS (SELECT objective_id, indicator_id, sqrt(sum(off * off) / (count(*) - 1)) AS unit, count(*) AS clusters, sum(n) AS persons, sum(e) AS gone FROM c GROUP BY ALL HAVING count(*) > 2),
x AS (SELECT c.objective_id, c.indicator_id, n, e, value / unit AS x FROM c JOIN u USING (objective_id, indicator_id) WHERE unit > 0 AND gone > 0),
b AS (SELECT DISTINCT objective_id, indicator_id, 0 AS step, 0::DOUBLE AS b0, 0::DOUBLE AS b1 FROM x
 UNION ALL SELECT objective_id, indicator_id, step + 1, b0 + (g0 * h11 - g1 * h01) / (h00 * h11 - h01 * h01), b1 + (g1 * h00 - g0 * h01) / (h00 * h11 - h01 * h01) FROM
  (SELECT objective_id, indicator_id, step, b0, b1, sum(e - n * m) AS g0, sum((e - n * m) * x) AS g1, sum(n * m * (1 - m)) AS h00, sum(n * m * (1 - m) * x) AS h01, sum(n * m * (1 - m) * x * x) AS h11
   FROM (SELECT b.*, x.n, x.e, x.x, 1 / (1 + exp(-(b0 + b1 * x.x))) AS m FROM b JOIN x USING (objective_id, indicator_id) WHERE step < 25) GROUP BY objective_id, indicator_id, step, b0, b1)),
v AS (SELECT objective_id, indicator_id, b1, h00, h01, h00 * h11 - h01 * h01 AS d, s00, s01, s11 FROM
  (SELECT objective_id, indicator_id, b1, sum(n * m * (1 - m)) AS h00, sum(n * m * (1 - m) * x) AS h01, sum(n * m * (1 - m) * x * x) AS h11, sum((e - n * m) ** 2) AS s00, sum((e - n * m) ** 2 * x) AS s01, sum((e - n * m) ** 2 * x * x) AS s11
   FROM (SELECT b.*, x.n, x.e, x.x, 1 / (1 + exp(-(b0 + b1 * x.x))) AS m FROM b JOIN x USING (objective_id, indicator_id) WHERE step = 25) GROUP BY objective_id, indicator_id, b1)),
r AS (SELECT v.*, u.*, sqrt((h01 * h01 * s00 - 2 * h00 * h01 * s01 + h00 * h00 * s11) / (d * d) * clusters / (clusters - 1) * (persons - 1) / (persons - 2)) AS se FROM v JOIN u USING (objective_id, indicator_id))
SELECT objective_id, indicator_id, persons::BIGINT AS n_obs, gone::BIGINT AS n_events, clusters AS n_clusters, format('{:.6g}', unit)::DOUBLE AS signal_sd_within,
 format('{:.6g}', exp(b1))::DOUBLE AS odds_ratio, format('{:.6g}', exp(b1 - 1.959963984540054 * se))::DOUBLE AS ci_low, format('{:.6g}', exp(b1 + 1.959963984540054 * se))::DOUBLE AS ci_high FROM r"""

# ---- both models, all at once: a group's intercept is swept out of the sums of its cells; the normal tail is one less a power series
_BOTH = """WITH RECURSIVE c AS (SELECT objective_id, indicator_id, country_code, year(as_of_date) * 12 + month(as_of_date) AS n_month, n::DOUBLE AS n, events::DOUBLE AS e, value, value - avg(value) OVER (PARTITION BY objective_id, indicator_id, country_code) AS off FROM s_cell WHERE value IS NOT NULL),
u AS (SELECT objective_id, indicator_id, sqrt(sum(off * off) / (count(*) - 1)) AS unit, avg(value) AS mid, avg(n_month) AS mid_month, count(*) AS clusters, sum(n) AS persons, sum(e) AS gone, count(DISTINCT country_code) AS countries FROM c GROUP BY ALL HAVING count(*) > 2),
x AS (SELECT objective_id, indicator_id, k AS model, CASE WHEN k = 'naive' THEN '' ELSE country_code END AS level, n, e, (value - mid) / unit AS x, CASE WHEN k = 'naive' THEN 0 ELSE n_month - mid_month END AS t
      FROM c JOIN u USING (objective_id, indicator_id), (VALUES ('naive'), ('within_country')) AS v(k) WHERE unit > 0 AND gone > 0),
b AS (SELECT DISTINCT objective_id, indicator_id, model, level, 0 AS step, 0::DOUBLE AS a, 0::DOUBLE AS b1, 0::DOUBLE AS b2, 0::DOUBLE AS v FROM x
 UNION ALL SELECT objective_id, indicator_id, model, level, step + 1, a + (r0 - w1 * d1 - w2 * d2) / w0, b1 + d1, b2 + d2, v FROM
  (SELECT *, (g1 * h22 - g2 * h12) / det AS d1, CASE WHEN model = 'naive' THEN 0 ELSE (g2 * h11 - g1 * h12) / det END AS d2, (h22 * h22 * s11 - 2 * h22 * h12 * s12 + h12 * h12 * s22) / (det * det) AS v FROM
   (SELECT *, h11 * h22 - h12 * h12 AS det FROM
    (SELECT *, sum(w11 - w1 * w1 / w0) OVER m AS h11, sum(w12 - w1 * w2 / w0) OVER m AS h12, CASE WHEN model = 'naive' THEN 1 ELSE sum(w22 - w2 * w2 / w0) OVER m END AS h22, sum(r1 - w1 / w0 * r0) OVER m AS g1, sum(r2 - w2 / w0 * r0) OVER m AS g2,
      sum(q11 - 2 * w1 / w0 * q1 + w1 * w1 / w0 / w0 * q0) OVER m AS s11, sum(q22 - 2 * w2 / w0 * q2 + w2 * w2 / w0 / w0 * q0) OVER m AS s22, sum(q12 - w1 / w0 * q2 - w2 / w0 * q1 + w1 * w2 / w0 / w0 * q0) OVER m AS s12 FROM
     (SELECT objective_id, indicator_id, model, level, step, a, b1, b2, sum(w) AS w0, sum(w * x) AS w1, sum(w * t) AS w2, sum(w * x * x) AS w11, sum(w * x * t) AS w12, sum(w * t * t) AS w22, sum(r) AS r0, sum(r * x) AS r1, sum(r * t) AS r2,
       sum(r * r) AS q0, sum(r * r * x) AS q1, sum(r * r * t) AS q2, sum(r * r * x * x) AS q11, sum(r * r * x * t) AS q12, sum(r * r * t * t) AS q22 FROM
      (SELECT b.*, x.x, x.t, x.e - x.n / (1 + exp(-(a + b1 * x.x + b2 * x.t))) AS r, x.n / (1 + exp(-(a + b1 * x.x + b2 * x.t))) / (1 + exp(a + b1 * x.x + b2 * x.t)) AS w FROM b JOIN x USING (objective_id, indicator_id, model, level) WHERE step < 20)
      GROUP BY objective_id, indicator_id, model, level, step, a, b1, b2)
     WINDOW m AS (PARTITION BY objective_id, indicator_id, model))))),
f AS (SELECT DISTINCT objective_id, indicator_id, model, b1, sqrt(v * clusters / (clusters - 1) * (persons - 1) / (persons - CASE WHEN model = 'naive' THEN 2 ELSE countries + 2 END)) AS se, persons, gone, clusters, unit
      FROM b JOIN u USING (objective_id, indicator_id) WHERE step = 20),
p AS (SELECT *, abs(b1 / se) / sqrt(2.0) AS z, format('{:.6g}', 1 - 2 / sqrt(pi()) * exp(-z * z) * list_sum(list_transform(range(150), lambda i: exp((2 * i + 1) * ln(z) + i * ln(4.0) + lgamma(i + 1) - lgamma(2 * i + 2)))))::DOUBLE AS p_value FROM f),
o AS (SELECT p_value, sum(count(*)) OVER (ORDER BY p_value) AS r, sum(count(*)) OVER () AS m FROM p WHERE model = 'within_country' GROUP BY p_value),
q AS (SELECT p_value, 'within_country' AS model, format('{:.6g}', least(1.0, min((p_value * m / r)::DOUBLE) OVER (ORDER BY p_value DESC)))::DOUBLE AS q_value FROM o)
SELECT objective_id, indicator_id, p.model, CASE objective_id WHEN 'NEW_HIRE_6M' THEN 'exit within 6 months of hire' WHEN 'SENIOR_HIRE_12M' THEN 'exit within 12 months of hire' ELSE 'regretted exit in the month (per person-month at risk)' END AS outcome,
 persons::BIGINT AS n_obs, gone::BIGINT AS n_events, clusters AS n_clusters, format('{:.6g}', unit)::DOUBLE AS signal_sd_within, format('{:.6g}', exp(b1))::DOUBLE AS odds_ratio,
 format('{:.6g}', exp(b1 - 1.959963984540054 * se))::DOUBLE AS ci_low, format('{:.6g}', exp(b1 + 1.959963984540054 * se))::DOUBLE AS ci_high, p.p_value, q.q_value, '' AS note FROM p LEFT JOIN q ON q.p_value = p.p_value AND q.model = p.model"""

_P = "(({} * 7919) % 10007) / 10007.0::DOUBLE"
STEPS["s_test"] = f"SELECT p_brand AS objective_id, p_name || '-' || p_partkey AS indicator_id, {_P.format('p_partkey')} AS p_value FROM part"


def _ranked(rows: str) -> str:
    """q: the least p * m / rank among this and all larger p, over distinct p with their counts."""
    by = f"(SELECT p_value, sum(count(*)) OVER (ORDER BY p_value) AS r, sum(count(*)) OVER () AS m FROM {rows} GROUP BY p_value)"
    return f"(SELECT p_value, least(1.0, min((p_value * m / r)::DOUBLE) OVER (ORDER BY p_value DESC)) AS q_value FROM {by})"


_PROFILE = [
    ("rows", "SELECT count(*) FROM s_raw"), ("equal rows", "SELECT count(*) - (SELECT count(*) FROM s_single) FROM s_raw"), ("ids", "SELECT count(DISTINCT employee_id) FROM s_raw"),
    ("ids with differing rows", "SELECT count(*) FROM (SELECT employee_id FROM s_plain GROUP BY employee_id HAVING count(*) > 1)"),
    *[(name, f"SELECT count(*) FROM s_plain WHERE {test}") for name, test in {
        "country blank": "country_code = ''", "country by an alias": f"country_code IN ({', '.join(repr(x) for x in SETTINGS.country_aliases)})", "hire date blank": "hire_date = ''",
        "hired before the reporting start": f"date_diff('day', d_in, {BEGIN}) > 0", "hired after the as-of date": f"date_diff('day', {NOW}, d_in) > 0", "left before hire": "date_diff('day', d_out, d_in) > 0",
        "left after the as-of date": f"date_diff('day', {NOW}, d_out) > 0", "left without a type": "d_out IS NOT NULL AND length(termination_type) = 0", "type without a date of leaving": "d_out IS NULL AND length(termination_type) > 0",
        "left freely, regret blank": "termination_type || regretted_exit = 'Voluntary'", "regretted, not left freely": "regretted_exit = 'true' AND termination_type NOT IN ('', 'Voluntary')",
        "permanent contract ended by its term": "termination_type || '/' || employment_type = 'End of Contract/Permanent'", "level by an alias": f"career_level IN ({', '.join(repr(x) for x in SETTINGS.level_aliases)})",
    }.items()],
]
STEPS["s_plain"] = "SELECT *, try_strptime(hire_date, '%Y-%m-%d')::DATE AS d_in, try_strptime(termination_date, '%Y-%m-%d')::DATE AS d_out FROM s_raw WHERE source_row IN (FROM s_single)"

_SLICE = "country_code = 'ALL' AND segment_value = 'All'"
_POSITIONS = ", ".join(f"({i}, '{r.id}', '{r.severity}')" for i, r in enumerate(CATALOGUE))
_SELECTS = {
    "dedup_keep_first": "SELECT l_orderkey, l_linenumber, min({'p': l_partkey, 's': l_suppkey}).p AS l_partkey, min({'p': l_partkey, 's': l_suppkey}).s AS l_suppkey FROM lineitem GROUP BY l_orderkey, l_linenumber",
    "latest_version": "SELECT b.i AS event_id, user_id, event_type, b.t::DATE AS day FROM (SELECT user_id, event_type, max({'t': ts, 'i': event_id}) AS b FROM events GROUP BY user_id, event_type)",
    "canonicalise_alias": "SELECT place_said AS country_code_raw, place AS country_code, level_said AS career_level_raw, level AS career_level, count(*) AS n FROM s_typed GROUP BY ALL",
    "quality_events": "SELECT * FROM s_event",
    "employees": "SELECT * FROM s_person",
    "severity_flags": "SELECT is_measurable, in_country_scope, regretted_status, count(*) AS n FROM s_person GROUP BY ALL",
    "category_unknown": "SELECT employee_id FROM s_event WHERE rule_id = 'WF_CATEGORY_UNKNOWN'",
    "typed_dates": "SELECT o_orderkey, kind::INT AS kind, CASE WHEN kind = 0 THEN o_orderdate::DATE END AS parsed FROM orders, range(5) AS r(kind)",
    "period_typing": "SELECT DISTINCT frequency, source_period, period_start, period_end FROM s_period",
    "external_events": "SELECT * FROM s_xevent",
    "period_gaps": "SELECT indicator_id, geo, source_period FROM s_xevent WHERE rule_id = 'EX_PERIOD_GAP'",
    "grain_duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "external_observations": "SELECT * FROM s_seen",
    "series_coverage": "SELECT * FROM s_cover",
    "cohort_members": "SELECT * FROM s_member",
    "cohort_monthly_slices": "SELECT * FROM s_monthly",
    "cohort_measures": "SELECT * FROM s_cohort",
    "person_months": "SELECT * FROM s_risk",
    "headcount_month_end": f"SELECT * EXCLUDE (n), {_last('n')} AS month_end FROM s_heads",
    "turnover_ttm": "SELECT * REPLACE (round(avg_headcount_ttm, 9) AS avg_headcount_ttm) FROM s_year",
    "wilson_interval": f"SELECT DISTINCT numerator, denominator, round({_LOW}, 9) AS ci_low, round({_HIGH}, 9) AS ci_high FROM s_monthly",
    "wilson_in_sql": f"SELECT objective_id, variant, country_code, numerator, denominator, round({_LOW}, 9) AS ci_low, round({_HIGH}, 9) AS ci_high FROM (SELECT objective_id, variant, country_code, sum(numerator)::BIGINT AS numerator, sum(denominator)::BIGINT AS denominator FROM s_monthly WHERE segment_value = 'All' GROUP BY ALL)",
    "objective_measures": "SELECT * FROM s_measure",
    "signal_values_lag": "SELECT * FROM s_value",
    "signal_asof": "SELECT * FROM s_known",
    "events_asof": "SELECT e.event_id, e.user_id, max({'t': r.ts, 'i': r.event_id}).i AS seen_id FROM events e LEFT JOIN events r ON r.user_id = e.user_id AND r.ts <= e.ts AND r.event_type <> 'purchase' WHERE e.event_type = 'purchase' GROUP BY e.event_id, e.user_id",
    "model_cells": "SELECT * FROM s_cell",
    "association_cells": f"SELECT objective_id, indicator_id, country_code, {_first(_number('as_of_date') + ' // 3 * 3')} AS period_start, sum(n)::BIGINT AS n, sum(events)::BIGINT AS events, round(sum(n * value) / sum(n), 6) AS signal_mean, round(sum(events) / sum(n), 6) AS event_rate FROM s_cell WHERE value IS NOT NULL GROUP BY ALL",
    "association_logit": _BOTH,
    "association_naive": _FIT,
    "associations_of": f"SELECT objective_id, indicator_id, country_code, {_first(_number('as_of_date') + ' // 3 * 3')} AS period_start, sum(n)::BIGINT AS n, sum(events)::BIGINT AS events, round(sum(n * value) / sum(n), 6) AS signal_mean, round(sum(events) / sum(n), 6) AS event_rate FROM s_cell WHERE value IS NOT NULL AND objective_id = 'NEW_HIRE_6M' AND indicator_id = 'ship_lines' GROUP BY ALL",
    "bh_qvalues": f"WITH p AS (SELECT c_custkey, {_P.format('c_custkey')} AS p_value FROM customer) SELECT c_custkey, round(p_value, 9) AS p_value, round(q_value, 9) AS q_value FROM p JOIN {_ranked('p')} USING (p_value)",
    "latest_status": f"SELECT m.objective_id, m.period_start, m.period_end, m.numerator, m.denominator, m.rate, m.ci_low, m.ci_high, m.target, m.direction, m.status, m.confidence, l.pending_periods FROM s_measure m JOIN (SELECT objective_id, max(period_start) FILTER (WHERE status <> 'pending') AS last, count(*) FILTER (WHERE status = 'pending') AS pending_periods FROM s_measure WHERE variant = 'main' AND grain = 'quarter' AND {_SLICE} GROUP BY objective_id) l ON l.objective_id = m.objective_id AND l.last = m.period_start WHERE variant = 'main' AND grain = 'quarter' AND {_SLICE}",
    "pooled_cohorts": f"SELECT objective_id, variant, numerator, denominator, round(numerator / denominator, 9) AS rate, round({_LOW}, 9) AS ci_low, round({_HIGH}, 9) AS ci_high, first_year, last_year, yearly_rates FROM (SELECT objective_id, variant, sum(numerator)::BIGINT AS numerator, sum(denominator) AS denominator, year(min(period_start))::INT AS first_year, year(max(period_start))::INT AS last_year, string_agg(printf('%.6f', rate), '|' ORDER BY period_start) AS yearly_rates FROM s_measure WHERE objective_id <> 'REGRETTED_TURNOVER_12M' AND grain = 'year' AND {_SLICE} AND status <> 'pending' GROUP BY ALL)",
    "yearly_turnover": f"SELECT year(period_end)::INT AS year, numerator, denominator, rate, ci_low, ci_high, status, confidence FROM s_measure WHERE objective_id = 'REGRETTED_TURNOVER_12M' AND variant = 'main' AND grain = 'year' AND {_SLICE}",
    "measures_slice": "SELECT period_start, period_end, numerator, denominator, rate, ci_low, ci_high, status, confidence FROM s_measure WHERE objective_id = 'NEW_HIRE_6M' AND country_code = 'EUROPE' AND segment_value = 'All' AND grain = 'quarter' AND variant = 'main'",
    "signal_series": f"SELECT * FROM s_known WHERE indicator_id = 'ship_lines' AND country_code IN ('ASIA', 'EUROPE') AND as_of_date >= {BEGIN}",
    "freshness": "SELECT c.indicator_id, min(lens) AS lens, count(DISTINCT country_code) AS countries, min(first_period_start) AS first_period_start, max(last_period_end) AS last_period_end, sum(values_present)::BIGINT AS values_present, sum(gaps)::BIGINT AS gaps, max(source_updated) AS source_updated, min(l.labels) AS status_labels FROM s_cover c LEFT JOIN (SELECT indicator_id, array_to_string(list_sort(list(DISTINCT status_label)), '; ') AS labels FROM s_seen WHERE status IS NOT NULL GROUP BY indicator_id) l ON l.indicator_id = c.indicator_id WHERE coalesce(release_code, 'FIN') = 'FIN' GROUP BY c.indicator_id",
    "workforce_counts": "SELECT count(*) AS employees, count_if(is_measurable) AS measurable, count_if(in_country_scope) AS in_country_scope, count(exit_date) AS exits FROM s_person",
    "headlines": f"SELECT objective_id, year(period_start)::INT AS year, round(rate, 4) AS rate, target, direction, status, confidence, round(denominator, 1) AS denominator FROM s_measure WHERE variant = 'main' AND grain = 'year' AND {_SLICE}",
    "verdicts": "SELECT objective_id, status, CASE WHEN status IN ('pending', 'insufficient_sample') OR ci_low IS NULL THEN status WHEN target BETWEEN ci_low AND ci_high THEN 'on the line' WHEN (ci_low > target) = (direction = 'at_least') THEN 'good' ELSE 'bad' END AS verdict, count(*) AS n FROM s_measure GROUP BY ALL",
    "findings_rollup": f"SELECT objective_id, count(*) AS tests, count_if(q_value < 0.05) AS significant, min({{'p': p_value, 'i': indicator_id}}).i AS strongest, round(min(p_value), 9) AS least_p FROM s_test JOIN {_ranked('s_test')} USING (p_value) GROUP BY objective_id",
    "union_exports": "SELECT event_id, user_id, 'click' AS origin FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, user_id, 'large' FROM events WHERE value > 50",
    "profile_counts": "SELECT field, value, count(*) AS n FROM (SELECT unnest(['country_code', 'career_level', 'termination_type', 'regretted_exit']) AS field, unnest([country_code, career_level, termination_type, regretted_exit]) AS value FROM s_raw) GROUP BY ALL",
    "profile_checks": " UNION ALL ".join(f"SELECT {i} AS position, '{name}' AS \"check\", ({sql})::BIGINT AS n" for i, (name, sql) in enumerate(_PROFILE)),
    "set_operations": "SELECT user_id, 'either' AS part FROM events WHERE event_type IN ('click', 'purchase') GROUP BY user_id UNION ALL SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'both' ELSE 'clicked only' END FROM events WHERE event_type IN ('click', 'purchase') GROUP BY user_id HAVING bool_or(event_type = 'click')",
    "tenure_histogram": "SELECT (exit_date - hire_date)::INT AS days, count(*) AS n FROM s_scope WHERE exit_date - hire_date BETWEEN 175 AND 190 GROUP BY ALL",
    "rule_counts": f"SELECT position, id AS rule_id, severity, count(rule_id) AS hits FROM (VALUES {_POSITIONS}) AS c(position, id, severity) LEFT JOIN (SELECT rule_id FROM s_event UNION ALL SELECT rule_id FROM s_xevent) ON rule_id = id GROUP BY position, id, severity",
    "jsonstat_decode": """SELECT l_suppkey, (12 * (year(l_shipdate) - 1995) + month(l_shipdate) - 1) * 3 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS flat, 'month=' || strftime(min(l_shipdate), '%Y-%m') || '|flag=' || l_returnflag AS coords,
 CASE WHEN sum(l_quantity) >= 5 THEN sum(l_quantity)::DOUBLE END AS value, CASE WHEN sum(l_quantity) < 5 THEN 'u' WHEN count(*) < 2 THEN 'p' END AS status FROM lineitem GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate), l_returnflag""",
}
ORACLES = {name: whole(sql) for name, sql in _SELECTS.items()}
