"""SQL with the same results as the workload's queries, for an independent engine (DuckDB)."""

from __future__ import annotations

from datetime import date, timedelta

from loadlake.operators.calendar import HOLIDAY_RULES
from loadlake.operators.overlay import UNCONTROLLED_WEIGHTS
from loadlake.plans import workload as w


def _easter(year: int) -> date:
    """Gauss's rule, so that the holidays here do not come from the expression under test."""
    a, b, c = year % 19, year % 4, year % 7
    k = year // 100
    m = (15 - (13 + 8 * k) // 25 + k - k // 4) % 30
    n = (4 + k - k // 4) % 7
    d = (19 * a + m) % 30
    e = (2 * b + 4 * c + 6 * d + n) % 7
    if (d == 29 and e == 6) or (d == 28 and e == 6 and (11 * m + 11) % 30 < 19):
        d -= 7
    return date(year, 3, 22) + timedelta(days=d + e)


def _holidays(years: range) -> list[tuple[date, str]]:
    found = []
    for year in years:
        for name, month, day, after, since in HOLIDAY_RULES:
            if year >= since:
                when = date(year, month, day) if after is None else _easter(year) + timedelta(days=after)
                found.append((when, name))
    return found


def _holiday_values(years: range) -> str:
    dates = sorted({d for d, _ in _holidays(years)})
    return "(VALUES " + ", ".join(f"(DATE '{d}')" for d in dates) + ") AS h(date)"


EVENT_HOLIDAYS = f"hol AS (SELECT date FROM {_holiday_values(range(2022, 2027))})"
ORDER_HOLIDAYS = f"hol AS (SELECT date FROM {_holiday_values(range(1993, 2003))})"
ZONE = "America/Sao_Paulo"
K = """CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER)"""
SLOT = "make_timestamp(CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800000000)"


def _day_type(d: str) -> str:
    return (
        f"CASE WHEN {d} IN (SELECT date FROM hol) THEN 'holiday' WHEN isodow({d}) = 6 THEN 'saturday'"
        f" WHEN isodow({d}) = 7 THEN 'sunday' ELSE 'weekday' END"
    )


def _calendar(local: str) -> str:
    return (
        f"CAST({local} AS DATE) AS date, CAST(year({local}) AS INTEGER) AS year, CAST(month({local}) AS INTEGER) AS"
        f" month, CAST(day({local}) AS INTEGER) AS day, CAST(hour({local}) AS INTEGER) AS hour"
    )


def _nearest(values: str, q: float) -> str:
    return f"{values}[CAST(floor((len({values}) - 1) * {q} + 0.5) AS BIGINT) + 1]"


HOURLY = f"""
{EVENT_HOLIDAYS},
slots AS (
  SELECT event_type AS area, {SLOT} AS ts_utc, CASE WHEN bool_or({K} = 0) THEN 0.0 ELSE avg(value) END AS v
  FROM events GROUP BY 1, 2),
silver AS (
  SELECT area, nullif(v, 0.0) AS load_mw, timezone('{ZONE}', timezone('UTC', ts_utc)) AS tl FROM slots),
dated AS (SELECT area, load_mw, {_calendar("tl")} FROM silver),
hourly AS (
  SELECT area, date, year, month, day, hour, {_day_type("date")} AS day_type, avg(load_mw) AS load_hourly_mw,
    count(load_mw) AS n_intervals, coalesce(sum(load_mw * 0.5), 0.0) AS energy_hourly_mwh,
    CASE WHEN count(load_mw) >= 2 THEN 'ok' ELSE 'incomplete_hour' END AS quality_flag
  FROM dated GROUP BY area, date, year, month, day, hour)"""

_AREA_LIST = ", ".join(f"'{a}'" for a in w.AREAS)
SYSTEM = f"""{HOURLY},
system_hours AS (
  SELECT date, year, month, day, hour, day_type,
    CASE WHEN count(load_hourly_mw) = {len(w.AREAS)} THEN sum(load_hourly_mw) END AS load_hourly_mw,
    sum(energy_hourly_mwh) AS energy_hourly_mwh,
    CASE WHEN bool_and(quality_flag = 'ok') THEN 'ok' ELSE 'incomplete_hour' END AS quality_flag
  FROM hourly WHERE area IN ({_AREA_LIST}) GROUP BY ALL HAVING count(DISTINCT area) = {len(w.AREAS)})"""
# GROUP BY ALL above groups by the six calendar columns.


def _profile(source: str, keys: str) -> str:
    return (
        f"SELECT {keys}, hour, avg(load_hourly_mw) AS avg_mw, median(load_hourly_mw) AS median_mw,"
        f" {_nearest('list_sort(list(load_hourly_mw) FILTER (load_hourly_mw IS NOT NULL))', 0.05)} AS p05_mw,"
        f" {_nearest('list_sort(list(load_hourly_mw) FILTER (load_hourly_mw IS NOT NULL))', 0.95)} AS p95_mw"
        f" FROM {source} GROUP BY {keys}, hour"
    )


PROFILE = f"""{HOURLY},
p AS ({_profile("hourly", "area")}),
prof AS (SELECT *, avg_mw / nullif(avg(avg_mw) OVER (PARTITION BY area), 0) AS normalized_load FROM p)"""

_FOUR = "round(avg_mw + 1e-8, 6) AS avg_mw, round(median_mw + 1e-8, 6) AS median_mw, round(p05_mw + 1e-8, 6) AS p05_mw, round(p95_mw + 1e-8, 6) AS p95_mw"

RAW_EVENTS = f"""raw AS (
  SELECT event_type AS area, 'user-' || user_id AS resource_id, {K} AS k,
    CASE WHEN {K} <> 99 THEN date_trunc('second', ts) END AS ts_utc,
    CASE WHEN {K} = 98 THEN NULL WHEN {K} = 0 THEN 0.0 ELSE value END AS v,
    strftime(ts, '%Y-%m-%d') AS dat_referencia, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS din_atualizacao,
    CAST({K} AS DOUBLE) AS val_cargammgd, CASE WHEN {K} < 90 THEN CAST(user_id AS DOUBLE) END AS val_cargasupervisionada
  FROM events)"""

CLASS_ROWS = """
rows AS (
  SELECT l_returnflag AS "SigCcs", 'class ' || l_linenumber AS "DscDemandante", l_linestatus AS "NomSubGrupoTarifario",
    CASE isodow(l_shipdate) WHEN 6 THEN 'saturday' WHEN 7 THEN 'sunday' ELSE 'weekday' END AS "DscTipoDia",
    CAST(l_orderkey % 24 AS INTEGER) AS hour, l_extendedprice AS v FROM lineitem)"""
_CURVE = '"SigCcs", "DscDemandante", "NomSubGrupoTarifario", "DscTipoDia"'
CURVE_STATS = f"""{CLASS_ROWS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {_CURVE}, hour ORDER BY v) - 1 AS r,
    count(*) OVER (PARTITION BY {_CURVE}, hour) AS n FROM rows),
stats AS (
  SELECT {_CURVE}, hour, avg(v) AS mean_mw, median(v) AS median_mw,
    {", ".join(f"max(CASE WHEN r = floor((n - 1) * {q} + 0.5) THEN v END) AS {name}"
               for name, q in (("p05_mw", 0.05), ("p25_mw", 0.25), ("p75_mw", 0.75), ("p95_mw", 0.95)))},
    stddev_samp(v) AS std_mw, count(v) AS n_observations FROM ranked GROUP BY {_CURVE}, hour)"""
_STATS_OUT = ", ".join(
    f"round({c} + 1e-8, 6) AS {c}" for c in ("mean_mw", "median_mw", "p05_mw", "p25_mw", "p75_mw", "p95_mw", "std_mw")
)
NORMALIZED = f"""{CURVE_STATS},
norm AS (
  SELECT *, avg(mean_mw) OVER (PARTITION BY {_CURVE}) AS daily_mean_mw,
    mean_mw / nullif(avg(mean_mw) OVER (PARTITION BY {_CURVE}), 0) AS normalized_load FROM stats)"""


def _metrics(source: str) -> str:
    share = "CASE WHEN sum(avg_mw) = 0 THEN 0.0 ELSE {0} / sum(avg_mw) END"
    late = "coalesce(sum(avg_mw) FILTER (hour BETWEEN {0} AND {1}), 0.0)"
    return f"""
  SELECT area, avg(avg_mw) AS average_load_mw, max(avg_mw) AS peak_load_mw, min(avg_mw) AS minimum_load_mw,
    CAST(list(hour ORDER BY avg_mw DESC, hour)[1] AS INTEGER) AS peak_hour,
    CAST(list(hour ORDER BY avg_mw, hour)[1] AS INTEGER) AS minimum_hour,
    CASE WHEN avg(avg_mw) = 0 THEN 0.0 ELSE max(avg_mw) / avg(avg_mw) END AS peak_to_average_ratio,
    sum(avg_mw) AS daily_energy_mwh,
    CASE WHEN max(avg_mw) = 0 THEN 0.0 ELSE avg(avg_mw) / max(avg_mw) END AS load_factor,
    {share.format(late.format(17, 22))} AS share_17_22, {share.format(late.format(18, 21))} AS share_18_21,
    {share.format("list_sum(list(avg_mw ORDER BY avg_mw DESC)[1:3])")} AS peak_3h_energy_share,
    max(avg_mw) - min(avg_mw) AS peak_valley_mw
  FROM {source} WHERE avg_mw IS NOT NULL GROUP BY area"""


_METRIC_NAMES = (
    "average_load_mw", "peak_load_mw", "minimum_load_mw", "peak_to_average_ratio", "daily_energy_mwh", "load_factor",
    "share_17_22", "share_18_21", "peak_3h_energy_share", "peak_valley_mw",
)

CALIBRATED = f"""{HOURLY},
dtp AS (SELECT area, day_type, hour, avg(load_hourly_mw) AS avg_mw FROM hourly GROUP BY ALL),
shapes AS (
  SELECT area, day_type, hour, avg_mw / nullif(avg(avg_mw) OVER (PARTITION BY area, day_type), 0) AS normalized_load
  FROM dtp),
energy AS (SELECT area, year, month, sum(energy_hourly_mwh) AS energy_mwh FROM hourly GROUP BY ALL),
months AS (SELECT DISTINCT make_date(CAST(year AS BIGINT), CAST(month AS BIGINT), 1) AS m FROM dated),
days AS (
  SELECT CAST(unnest(generate_series(m, CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), INTERVAL 1 DAY)) AS DATE)
    AS date FROM months),
counts AS (
  SELECT year(date) AS year, month(date) AS month, {_day_type("date")} AS day_type, count(*) AS n_days
  FROM days GROUP BY ALL),
joined AS (
  SELECT s.area, e.year, e.month, s.day_type, s.hour, s.normalized_load, coalesce(c.n_days, 0) AS n_days_in_month,
    e.energy_mwh
  FROM shapes s JOIN energy e ON s.area = e.area
  LEFT JOIN counts c ON c.year = e.year AND c.month = e.month AND c.day_type = s.day_type),
hours AS (
  SELECT area, year, month, sum(n) * 24 AS h FROM (
    SELECT DISTINCT area, year, month, day_type, n_days_in_month AS n FROM joined) GROUP BY ALL),
cal AS (
  SELECT j.area, j.year, j.month, day_type, hour, normalized_load,
    normalized_load * energy_mwh / nullif(h, 0) AS estimated_load_mw, n_days_in_month,
    energy_mwh AS reference_energy_mwh
  FROM joined j JOIN hours USING (area, year, month))"""

LEDGER = """
landed AS (
  SELECT lang AS source, source AS resource_id, doc_id, sha256(text) AS hash_sha256, text,
    TIMESTAMP '2024-01-01' + CAST(doc_id * 900 AS BIGINT) * INTERVAL 1 SECOND AS retrieved_at FROM documents),
periods AS (
  SELECT *, CASE WHEN source <> 'en' THEN strftime(retrieved_at, '%Y-%m') END AS reference_period,
    'raw/' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS local_path FROM landed),
versions AS (
  SELECT * FROM periods
  QUALIFY row_number() OVER (PARTITION BY source, resource_id, hash_sha256 ORDER BY retrieved_at, local_path) = 1),
led AS (
  SELECT *, row_number() OVER (PARTITION BY source, resource_id, reference_period
    ORDER BY retrieved_at DESC, hash_sha256 DESC) = 1 AS is_latest_downloaded FROM versions)"""

REVISIONS = f"""{LEDGER},
rev AS (
  SELECT source, resource_id, reference_period, lag(hash_sha256) OVER w AS old_hash, hash_sha256 AS new_hash
  FROM versions WINDOW w AS (PARTITION BY source, resource_id, reference_period ORDER BY retrieved_at, hash_sha256)
  QUALIFY old_hash IS NOT NULL)"""

CHECKS = f"""{LEDGER},
lines AS (
  SELECT source, resource_id, hash_sha256, unnest(string_split(text, chr(10))) AS line FROM versions),
counted AS (
  SELECT source, resource_id, hash_sha256, count(*) AS n, count(*) - count(DISTINCT line) AS dup,
    count(*) FILTER (line = '') AS nulls FROM lines GROUP BY ALL),
outcomes AS (
  SELECT source, resource_id, hash_sha256, 'not_empty' AS check_name, n >= 2 AS passed, n AS rows_affected FROM counted
  UNION ALL SELECT source, resource_id, hash_sha256, 'duplicates', dup = 0, dup FROM counted
  UNION ALL SELECT source, resource_id, hash_sha256, 'unexpected_nulls', nulls = 0, nulls FROM counted)"""

GATED = f"""{CHECKS},
decided AS (
  SELECT source, resource_id, hash_sha256, bool_and(passed) AS approved, count(*) FILTER (NOT passed) AS n_reasons,
    count(*) AS n_checks, string_agg(check_name, ',' ORDER BY check_name) FILTER (NOT passed) AS failed
  FROM outcomes GROUP BY source, resource_id, hash_sha256),
gated AS (
  SELECT l.*, d.approved, d.failed, d.approved AND row_number() OVER (
      PARTITION BY source, reference_period ORDER BY CASE WHEN approved THEN 0 ELSE 1 END, retrieved_at DESC,
      hash_sha256 DESC, resource_id DESC) = 1 AS is_active_for_gold
  FROM led l JOIN decided d USING (source, resource_id, hash_sha256))"""

PUBLISHED = """
pub AS (
  SELECT p_brand AS catalog, p_partkey AS position, 'id-' || p_partkey AS id,
    CASE WHEN p_size > 5 THEN p_name ELSE '' END AS name,
    CASE p_type WHEN 'STANDARD' THEN 'csv' WHEN 'ECONOMY' THEN 'parquet' WHEN 'SMALL' THEN 'xlsx'
      WHEN 'LARGE' THEN 'json' ELSE 'zip' END AS format,
    'https://example.org/' || p_partkey AS url,
    '2024-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00' AS created, p_size, p_name FROM part)"""

NAMED = """
named AS (
  SELECT o_orderkey, CASE o_orderpriority
    WHEN '1-URGENT' THEN 'consumo_' || (year(o_orderdate) + 25) || strftime(o_orderdate, '%m') || '.csv.gz'
    WHEN '2-HIGH' THEN 'Consumo - ' || upper(substr(word, 1, 1)) || substr(word, 2) || ' de ' || (year(o_orderdate) + 25)
    WHEN '3-MEDIUM' THEN replace(word, 'ç', 'c') || '-' || (year(o_orderdate) + 25)
    WHEN '5-LOW' THEN 'dados ' || (year(o_orderdate) + 25) || '/' || strftime(o_orderdate, '%m')
    ELSE 'arquivo-sem-data' END AS name,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN (year(o_orderdate) + 25) || strftime(o_orderdate, '-%m') END
      AS reference_period
  FROM (SELECT *, (['janeiro','fevereiro','março','abril','maio','junho','julho','agosto','setembro','outubro',
    'novembro','dezembro'])[month(o_orderdate)] AS word FROM orders))"""

HREFS = r"""
hrefs AS (
  SELECT page_id, url, list_transform(regexp_extract_all(
      regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>', '', 'g'),
      '(?is)<a\s[^>]*?\bhref\s*=\s*"([^"]*)"', 1), lambda h: replace(h, '&amp;', '&')) AS found FROM pages)"""
_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"


def _ends(endings: tuple[str, ...], h: str) -> str:
    return "(" + " OR ".join(f"ends_with(lower({h}), '{e}')" for e in endings) + ")"


YEARLY = """
yearly AS (
  SELECT r_name AS country, CAST(year(o_orderdate) AS INTEGER) AS year, sum(o_totalprice) / 1e8 AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)"""


def _grow(year: str) -> str:
    """Growth between the anchors around ``year``; the workload's anchors are positive."""
    a, b, c = w.ANCHOR_YEARS
    part = "exp(ln({0}) + ({y} - {1}) / CAST({2} - {1} AS DOUBLE) * (ln({3}) - ln({0})))"
    early = part.format("v0", a, b, "v1", y=year)
    late = part.format("v1", b, c, "v2", y=year)
    return (
        f"CASE {year} WHEN {a} THEN v0 WHEN {b} THEN v1 WHEN {c} THEN v2"
        f" ELSE CASE WHEN {year} < {b} THEN {early} ELSE {late} END END"
    )


ANCHORS = f"""{YEARLY},
anchors AS (
  SELECT country, {", ".join(f"max(value) FILTER (year = {y}) AS v{i}" for i, y in enumerate(w.ANCHOR_YEARS))},
    max(value) FILTER (year = {w.ALTERNATIVE_YEAR}) * 1.5 AS alt FROM yearly GROUP BY country),
dense AS (
  SELECT country, CAST(y AS INTEGER) AS year, {_grow("y")} AS value, alt / ({_grow(str(w.ALTERNATIVE_YEAR))}) AS ratio,
    CASE WHEN y IN {w.ANCHOR_YEARS} THEN 'observed_anchor' ELSE 'interpolated_exponential' END AS value_type
  FROM anchors, generate_series({w.YEARS[0]}, {w.YEARS[1]}) AS s(y))"""
SCENARIOS = f"""{ANCHORS},
three AS (
  SELECT country, year, 'conservador' AS scenario, value AS twh, value_type FROM dense
  UNION ALL SELECT country, year, 'intermediario', sqrt(value * (value * ratio)), 'derived_geometric_mean' FROM dense
  UNION ALL SELECT country, year, 'acelerado', value * ratio, 'derived_constant_ratio' FROM dense),
scen AS (
  SELECT country, year, scenario, CAST(printf('%.4f', twh) AS DOUBLE) AS demand_light_ev_twh,
    CAST(round_even(twh * 1e9 / {w.KWH_PER_UNIT}, 0) AS BIGINT) AS implied_bev_phev_fleet_units, value_type FROM three)"""
SHARES = """
nat AS (
  SELECT r_name AS country, n_name AS region, count(*) AS units,
    count(*) FILTER (c_mktsegment IN ('HOUSEHOLD', 'BUILDING')) AS narrow_units
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
shares AS (
  SELECT country, region, units / CAST(sum(units) OVER p AS DOUBLE) AS weight_low,
    units / nullif(CAST(sum(narrow_units) OVER p AS DOUBLE), 0) AS weight_high
  FROM nat WINDOW p AS (PARTITION BY country)),
weights AS (SELECT *, sqrt(weight_low * weight_high) AS weight_central FROM shares)"""

_FREE = "CASE hour " + " ".join(f"WHEN {h} THEN {v}" for h, v in UNCONTROLLED_WEIGHTS.items()) + " END"
SHAPES = f"""{PROFILE},
free AS (
  SELECT area, hour, avg_mw AS base_mw, ({_FREE}) / {sum(UNCONTROLLED_WEIGHTS.values())!r} AS f,
    hour BETWEEN 17 AND 20 AS in_peak FROM prof),
room AS (
  SELECT *, CASE WHEN NOT in_peak THEN greatest(max(base_mw) OVER (PARTITION BY area) - base_mw, 1e-6) END AS room,
    CASE WHEN in_peak THEN f * 0.38 ELSE 0 END AS cut FROM free),
filled AS (
  SELECT *, sum(cut) OVER (PARTITION BY area) AS removed, sum(room) OVER (PARTITION BY area) AS rooms FROM room),
shp AS (
  SELECT area, hour, base_mw, 'uncontrolled' AS strategy, f AS weight FROM filled
  UNION ALL SELECT area, hour, base_mw, 'smart', CASE WHEN in_peak THEN f - cut ELSE f + removed * room / rooms END
    FROM filled
  UNION ALL SELECT area, hour, base_mw, 'offpeak_shifted', CASE WHEN hour < 6 THEN 1.0 / 6 ELSE 0.0 END FROM filled)"""
OVERLAY = f"""{SHAPES},
cases AS (
  SELECT event_type AS area, 'central' AS "case", count(*) AS n_vehicles FROM events GROUP BY 1
  UNION ALL SELECT event_type, 'upper_bound', count(*) * 2 FROM events GROUP BY 1),
ov AS (
  SELECT area, "case", n_vehicles, strategy, hour, n_vehicles * 2000.0 / 365 / 1000 AS daily_energy_added_mwh, base_mw,
    n_vehicles * 2000.0 / 365 / 1000 * weight AS added_mw,
    base_mw + n_vehicles * 2000.0 / 365 / 1000 * weight AS total_mw FROM shp JOIN cases USING (area))"""

_LOCAL_EARLY = f"""
clock AS (
  SELECT o_orderkey, o_orderdate + CAST(o_orderkey % 48 AS BIGINT) * INTERVAL 30 MINUTE AS ts FROM orders),
late AS (SELECT *, timezone('UTC', timezone('{ZONE}', ts)) AS u FROM clock),
both_hours AS (
  SELECT *, timezone('{ZONE}', timezone('UTC', u)) = timezone('{ZONE}', timezone('UTC', u - INTERVAL 1 HOUR)) AS twice
  FROM late)"""


def _calendar_out(source: str) -> str:
    return (
        f"SELECT o_orderkey, tu AS timestamp_utc, tl AS timestamp_local, {_calendar('tl')},"
        f" CAST(minute(tl) AS INTEGER) AS minute, CAST(isodow(tl) - 1 AS INTEGER) AS weekday,"
        f" {_day_type('CAST(tl AS DATE)')} AS day_type FROM {source}"
    )


_PROVENANCE = "'ons' AS source, '{0}' AS dataset, 'ONS_load_area' AS geographic_scope, '{1}' AS geographic_precision, '{2}' AS observation_type"

_HOLIDAY_ROWS = ", ".join(
    f"({d.year}, DATE '{d}', '{name}')" for d, name in _holidays(range(1995, 2003)) if d.year <= 2002
)

ORACLES: dict[str, str] = {
    "silver_readings": f"""WITH {EVENT_HOLIDAYS}, {RAW_EVENTS},
ok AS (SELECT *, timezone('{ZONE}', timezone('UTC', ts_utc)) AS tl FROM raw WHERE ts_utc IS NOT NULL)
SELECT area, ts_utc, tl AS timestamp_local, round(nullif(v, 0.0) + 1e-8, 6) AS load_mw, coalesce(v = 0, false) AS is_placeholder,
  resource_id, {_calendar("tl")}, CAST(minute(tl) AS INTEGER) AS minute, CAST(isodow(tl) - 1 AS INTEGER) AS weekday,
  {_day_type("CAST(tl AS DATE)")} AS day_type, {_PROVENANCE.format("carga_verificada", "approximate", "observed")},
  dat_referencia, din_atualizacao, CAST(NULL AS DOUBLE) AS val_cargaglobalsmmg, round(val_cargammgd + 1e-8, 6) AS val_cargammgd,
  round(val_cargasupervisionada + 1e-8, 6) AS val_cargasupervisionada
FROM ok""",
    "rejected_readings": f"WITH {RAW_EVENTS} SELECT area, count(*) AS n_rejected FROM raw WHERE ts_utc IS NULL GROUP BY area",
    "placeholder_counts": f"""WITH {RAW_EVENTS}
SELECT resource_id, count(*) FILTER (v = 0) AS n_placeholders FROM raw GROUP BY resource_id""",
    "latest_readings": f"""SELECT event_type AS area, {SLOT} AS ts_utc, round(value + 1e-8, 6) AS load_mw,
  CAST(event_id AS VARCHAR) AS resource_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, {SLOT} ORDER BY ts DESC, sha256(CAST(event_id AS VARCHAR)) DESC) = 1""",
    "hourly_load": f"""WITH {HOURLY}
SELECT area, date, year, month, day, hour, day_type, round(load_hourly_mw + 1e-8, 6) AS load_hourly_mw, n_intervals,
  round(energy_hourly_mwh + 1e-8, 6) AS energy_hourly_mwh, quality_flag,
  {_PROVENANCE.format("carga_verificada", "approximate", "aggregated")} FROM hourly""",
    "system_hourly": f"""WITH {SYSTEM}
SELECT date, year, month, day, hour, day_type, round(load_hourly_mw + 1e-8, 6) AS load_hourly_mw,
  round(energy_hourly_mwh + 1e-8, 6) AS energy_hourly_mwh, quality_flag,
  {_PROVENANCE.format("carga_verificada_nacional", "exact", "derived")} FROM system_hours""",
    "profile_24h": f"WITH {PROFILE} SELECT area, hour, {_FOUR}, round(normalized_load + 1e-8, 6) AS normalized_load FROM prof",
    "profile_by_day_type": f"""WITH {HOURLY}, d AS ({_profile("hourly", "area, day_type")})
SELECT area, day_type, hour, {_FOUR} FROM d""",
    "profile_by_month": f"""WITH {HOURLY}, d AS ({_profile("hourly", "area, month")})
SELECT area, month, hour, {_FOUR} FROM d""",
    "profile_all_grains": f"""WITH {PROFILE}, d AS ({_profile("hourly", "area, day_type")}),
m AS ({_profile("hourly", "area, month")}),
everything AS (
  SELECT area, hour, avg_mw, median_mw, p05_mw, p95_mw, normalized_load, 'overall' AS grain, NULL AS day_type,
    0 AS month FROM prof
  UNION ALL SELECT area, hour, avg_mw, median_mw, p05_mw, p95_mw, NULL, 'day_type', day_type, 0 FROM d
  UNION ALL SELECT area, hour, avg_mw, median_mw, p05_mw, p95_mw, NULL, 'month', NULL, month FROM m)
SELECT area, hour, {_FOUR}, round(normalized_load + 1e-8, 6) AS normalized_load, grain, day_type, month FROM everything""",
    "system_profile": f"""WITH {SYSTEM},
d AS ({_profile("(SELECT *, 'carga_verificada_nacional' AS dataset FROM system_hours)", "dataset")})
SELECT dataset, hour, {_FOUR}, round(avg_mw / nullif(avg(avg_mw) OVER (PARTITION BY dataset), 0) + 1e-8, 6) AS normalized_load
FROM d""",
    "local_calendar": f"""WITH {ORDER_HOLIDAYS},
clock AS (SELECT o_orderkey, o_orderdate + CAST(o_orderkey % 48 AS BIGINT) * INTERVAL 30 MINUTE AS tu FROM orders),
loc AS (SELECT *, timezone('{ZONE}', timezone('UTC', tu)) AS tl FROM clock)
{_calendar_out("loc")}""",
    "local_source_calendar": f"""WITH {ORDER_HOLIDAYS}, {_LOCAL_EARLY},
utc AS (SELECT o_orderkey, CASE WHEN twice THEN u - INTERVAL 1 HOUR ELSE u END AS tu FROM both_hours),
loc AS (SELECT *, timezone('{ZONE}', timezone('UTC', tu)) AS tl FROM utc)
{_calendar_out("loc")}""",
    "holiday_calendar": f"""WITH hol AS (SELECT * FROM (VALUES {_HOLIDAY_ROWS}) AS h(year, date, holiday))
SELECT CAST(year AS INTEGER) AS year, date, holiday FROM hol
WHERE year IN (SELECT DISTINCT year(o_orderdate) FROM orders)""",
    "day_type_counts": f"""WITH {ORDER_HOLIDAYS},
months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders),
days AS (
  SELECT CAST(unnest(generate_series(m, CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), INTERVAL 1 DAY)) AS DATE)
    AS date FROM months),
typed AS (SELECT date, {_day_type("date")} AS t FROM days)
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  count(*) FILTER (t = 'weekday') AS weekday, count(*) FILTER (t = 'saturday') AS saturday,
  count(*) FILTER (t = 'sunday') AS sunday, count(*) FILTER (t = 'holiday') AS holiday FROM typed GROUP BY 1, 2""",
    "month_windows": """WITH r AS (
  SELECT o_orderpriority, o_orderstatus, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
  FROM orders GROUP BY ALL),
m AS (SELECT *, CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE) AS m FROM r)
SELECT o_orderpriority, o_orderstatus, strftime(m, '%Y-%m') AS reference_period, greatest(m, a) AS window_start,
  least(last_day(m), b) AS window_end FROM m""",
    "recheck_windows": f"""WITH r AS (
  SELECT DISTINCT o_orderpriority AS source, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 30 AS recheck_days FROM orders),
s AS (SELECT *, DATE '{w.RECHECK_AS_OF}' - recheck_days AS a, DATE '{w.RECHECK_AS_OF}' AS b FROM r),
m AS (SELECT *, CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE) AS m FROM s)
SELECT source, CAST(recheck_days AS INTEGER) AS recheck_days, strftime(m, '%Y-%m') AS reference_period,
  greatest(m, a) AS window_start, least(last_day(m), b) AS window_end FROM m""",
    "decimal_comma_prices": """SELECT o_orderstatus, count(*) FILTER (o_orderstatus <> 'P') AS n_numbers,
  count(*) FILTER (o_orderstatus = 'P') AS n_broken,
  round(max(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) + 1e-8, 6) AS greatest,
  round(avg(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) + 1e-8, 6) AS mean_value FROM orders GROUP BY 1""",
    "clock_hours": "SELECT CAST(l_orderkey % 24 AS INTEGER) AS hour, count(*) AS n FROM lineitem GROUP BY 1",
    "category_values": f"""WITH {CLASS_ROWS}
SELECT DISTINCT 'SigCcs' AS category, "SigCcs" AS value FROM rows
UNION SELECT 'NomSubGrupoTarifario', "NomSubGrupoTarifario" FROM rows
UNION SELECT 'DscDemandante', "DscDemandante" FROM rows UNION SELECT 'DscTipoDia', "DscTipoDia" FROM rows""",
    "curve_stats": f"WITH {CURVE_STATS} SELECT {_CURVE}, hour, {_STATS_OUT}, n_observations FROM stats",
    "normalized_curve": f"""WITH {NORMALIZED} SELECT {_CURVE}, hour, {_STATS_OUT}, n_observations,
  round(daily_mean_mw + 1e-8, 6) AS daily_mean_mw, round(normalized_load + 1e-8, 6) AS normalized_load FROM norm""",
    "class_report": f"""WITH {NORMALIZED} SELECT hour, round(avg(mean_mw) + 1e-8, 6) AS avg_mw,
  round(avg(normalized_load) + 1e-8, 6) AS normalized_load FROM norm WHERE "DscDemandante" = 'class 3' GROUP BY hour""",
    "price_quantiles": """WITH r AS (
  SELECT l_returnflag, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS r,
    count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT l_returnflag, round(max(CASE WHEN r = floor((n - 1) * 0.05 + 0.5) THEN v END) + 1e-8, 6) AS p05,
  round(max(CASE WHEN r = floor((n - 1) * 0.95 + 0.5) THEN v END) + 1e-8, 6) AS p95, round(median(v) + 1e-8, 6) AS median
FROM r GROUP BY 1""",
    "labelled_monthly_power": """WITH m AS (
  SELECT c_mktsegment AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, sum(o_totalprice) AS e
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') GROUP BY 1, 2)
SELECT segment, month_start, round(e + 1e-5, 3) AS energy_mwh, round(e / (day(last_day(month_start)) * 24) + 1e-5, 3) AS average_power_mw FROM m""",
    "load_metrics": f"""WITH {PROFILE}, x AS ({_metrics("prof")})
SELECT area, peak_hour, minimum_hour, {", ".join(f"round({n} + 1e-8, 6) AS {n}" for n in _METRIC_NAMES)} FROM x""",
    "flexibility_candidates": f"""WITH {PROFILE},
lv AS (SELECT area, avg(avg_mw) AS m, {_nearest("list_sort(list(avg_mw) FILTER (avg_mw IS NOT NULL))", 0.90)} AS p FROM prof GROUP BY area)
SELECT area, hour, round(avg_mw + 1e-8, 6) AS baseline_mw, round(greatest(avg_mw - m, 0.0) + 1e-8, 6) AS above_daily_mean_mw,
  round(greatest(avg_mw - p, 0.0) + 1e-8, 6) AS above_p90_mw,
  CASE WHEN avg_mw > m THEN 'candidate_peak_shift' ELSE 'baseline' END AS potential_shift_window
FROM prof JOIN lv USING (area)""",
    "calibrated_curve": f"""WITH {CALIBRATED}
SELECT area, year, month, day_type, hour, round(normalized_load + 1e-8, 6) AS normalized_load,
  round(estimated_load_mw + 1e-8, 6) AS estimated_load_mw, CAST(n_days_in_month AS BIGINT) AS n_days_in_month,
  round(reference_energy_mwh + 1e-8, 6) AS reference_energy_mwh FROM cal""",
    "calibration_summary": f"""WITH {CALIBRATED},
s AS (
  SELECT area, year, month, sum(estimated_load_mw * n_days_in_month) AS e, max(reference_energy_mwh) AS r FROM cal GROUP BY ALL)
SELECT area, year, month, round(e + 1e-8, 6) AS estimated_energy_mwh, round(r + 1e-8, 6) AS reference_energy_mwh,
  round(CASE WHEN r = 0 THEN 0.0 ELSE 100 * (e - r) / r END + 1e-8, 6) AS error_pct FROM s""",
    "source_comparison": f"""WITH {CALIBRATED},
p AS ({_profile("hourly", "area")}),
est AS (SELECT area, hour, sum(estimated_load_mw * n_days_in_month) / nullif(sum(n_days_in_month) FILTER (estimated_load_mw IS NOT NULL), 0) AS avg_mw
  FROM cal GROUP BY ALL),
a AS ({_metrics("p")}), b AS ({_metrics("est")}),
la AS (UNPIVOT (SELECT area, {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in (*_METRIC_NAMES, "peak_hour", "minimum_hour"))} FROM a)
  ON COLUMNS(* EXCLUDE (area)) INTO NAME metric VALUE value),
lb AS (UNPIVOT (SELECT area, {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in (*_METRIC_NAMES, "peak_hour", "minimum_hour"))} FROM b)
  ON COLUMNS(* EXCLUDE (area)) INTO NAME metric VALUE value)
SELECT area, metric, 'observed' AS source_a, 'ONS_load_area' AS scope_a, round(la.value + 1e-6, 4) AS value_a,
  'calibrated' AS source_b, 'RJ_state' AS scope_b, round(lb.value + 1e-6, 4) AS value_b,
  round(lb.value - la.value + 1e-6, 4) AS difference, round(100 * (lb.value - la.value) / nullif(la.value, 0) + 1e-6, 4) AS difference_pct,
  false AS same_scope FROM la FULL JOIN lb USING (area, metric)""",
    "quality_report": f"""WITH o AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS resource, o_custkey, CAST(o_orderdate AS DATE) AS date, o_orderkey % 24 AS hour,
    nullif(o_orderstatus, 'P') AS status, o_totalprice - {w.PRICE_LEVEL * 10} AS margin FROM orders),
c AS (
  SELECT resource, count(*) AS n, count(*) - count(DISTINCT o_custkey) AS dup, count(*) FILTER (status IS NULL) AS nulls,
    count(*) FILTER (margin < 0) AS neg, max(date) AS last FROM o GROUP BY 1),
d AS (SELECT resource, date, count(DISTINCT hour) AS h FROM o GROUP BY 1, 2),
s AS (SELECT resource, count(*) FILTER (h < 24) AS short FROM d GROUP BY 1)
SELECT resource, 'not_empty' AS check_name, n >= 150 AS passed, 'error' AS severity, n AS rows_affected, n || ' rows, at least 150 expected' AS details FROM c
UNION ALL SELECT resource, 'duplicates', dup = 0, 'error', dup, dup || ' rows repeat the key o_custkey' FROM c
UNION ALL SELECT resource, 'unexpected_nulls', nulls = 0, 'error', nulls, 'status=' || nulls || ', o_custkey=0' FROM c
UNION ALL SELECT resource, 'negative_values', neg = 0, 'warning', neg, neg || ' negative values in margin' FROM c
UNION ALL SELECT resource, 'missing_hours', short = 0, 'warning', short, short || ' dates with fewer than 24 hours' FROM s
UNION ALL SELECT resource, 'completeness_window', last >= DATE '2001-07-31', 'error', -1,
  'last date ' || last || ', expected up to 2001-08-01' FROM c""",
    "schema_checks": """SELECT event_type, 'schema' AS check_name, false AS passed, 'error' AS severity,
  'missing: unit; extra: ' AS details
FROM (SELECT event_type, bool_or(props LIKE '%"unit"%') AS u FROM events GROUP BY 1) WHERE NOT u""",
    "coverage_regression": """WITH v AS (
  SELECT o_orderpriority, o_custkey, CAST(max(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1, 2),
p AS (SELECT *, lag(d) OVER (PARTITION BY o_orderpriority ORDER BY o_custkey) AS b FROM v)
SELECT o_orderpriority, o_custkey, 'coverage_regression' AS check_name, coalesce(d >= b, true) AS passed,
  'error' AS severity, CASE WHEN b IS NULL THEN 'nothing to compare with' ELSE 'now up to ' || d || ', before up to ' || b END
  AS details FROM p""",
    "row_count_anomaly": """WITH v AS (
  SELECT l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m') AS version, count(*) AS n FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY version DESC) AS back FROM v),
med AS (SELECT l_returnflag, l_linestatus, median(n) AS m FROM r WHERE back > 1 GROUP BY ALL),
mad AS (
  SELECT l_returnflag, l_linestatus, m, median(abs(n - m)) AS d FROM r JOIN med USING (l_returnflag, l_linestatus)
  WHERE back > 1 GROUP BY ALL),
j AS (SELECT l_returnflag, l_linestatus, n, m, d, 0.6745 * (n - m) / nullif(d, 0) AS z FROM r JOIN mad USING (l_returnflag, l_linestatus) WHERE back = 1)
SELECT l_returnflag, l_linestatus, n AS row_count, round(m + 1e-8, 6) AS median_row_count, round(d + 1e-8, 6) AS mad_row_count,
  round(z + 1e-8, 6) AS score, 'row_count_anomaly' AS check_name, CASE WHEN d = 0 THEN n = m ELSE abs(z) <= 3 END AS passed,
  'warning' AS severity, 'rows ' || n || ', median ' || CAST(m AS DOUBLE) || ', deviation ' || CAST(d AS DOUBLE) AS details FROM j""",
    "energy_power_consistency": f"""WITH {HOURLY},
f AS (
  SELECT area, CASE WHEN load_hourly_mw = 0 THEN energy_hourly_mwh = 0
    ELSE 100 * abs(energy_hourly_mwh - load_hourly_mw) / abs(load_hourly_mw) <= 1 END AS fits FROM hourly),
c AS (SELECT area, count(*) FILTER (NOT fits) AS off, count(fits) AS n FROM f GROUP BY area)
SELECT area, 'energy_power_consistency' AS check_name, off = 0 AS passed, 'warning' AS severity,
  off || ' of ' || n || ' rows off by more than 1.0 %' AS details, off AS rows_affected FROM c""",
    "allowed_values": """SELECT o_orderpriority, 'allowed_values' AS check_name, bool_and(o_orderstatus IN ('F', 'O')) AS passed,
  'error' AS severity, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) || ' rows with an unknown o_orderstatus' AS details,
  count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS rows_affected FROM orders GROUP BY 1""",
    "incremental_months": f"""WITH {HOURLY}
SELECT area, date, year, month, day, hour, day_type, round(load_hourly_mw + 1e-8, 6) AS load_hourly_mw, n_intervals,
  round(energy_hourly_mwh + 1e-8, 6) AS energy_hourly_mwh, quality_flag,
  {_PROVENANCE.format("carga_verificada", "approximate", "aggregated")} FROM hourly""",
    "hourly_stream_result": f"""
        WITH halves AS (
            SELECT event_type AS area, {SLOT} AS slot, CASE WHEN {K} <> 0 THEN value END AS v FROM events
            QUALIFY row_number() OVER (PARTITION BY event_type, {SLOT} ORDER BY ts DESC, CASE WHEN {K} <> 0 THEN value END DESC NULLS LAST) = 1
        ), hours AS (
            SELECT area, date_trunc('hour', slot) AS hour_start_utc, sum(v) AS total, count(v) AS n_intervals FROM halves GROUP BY ALL
        )
        SELECT area, hour_start_utc, CAST(timezone('{ZONE}', timezone('UTC', hour_start_utc)) AS DATE) AS date,
            CAST(hour(timezone('{ZONE}', timezone('UTC', hour_start_utc))) AS INTEGER) AS hour,
            round(total / nullif(n_intervals, 0) + 1e-8, 6) AS load_hourly_mw, n_intervals,
            round(coalesce(total, 0) * 0.5 + 1e-8, 6) AS energy_hourly_mwh,
            CASE WHEN n_intervals >= 2 THEN 'ok' ELSE 'incomplete_hour' END AS quality_flag
        FROM hours
    """,
    "ledger_stream_result": f"""WITH {LEDGER} SELECT source, resource_id, reference_period, hash_sha256, local_path,
  CAST(strlen(text) AS BIGINT) AS file_size FROM led""",
    "content_marks": """
        SELECT source, lang, CAST(sum(CAST(('0x' || md5(length(line) || ':' || line)[1:15])::BIGINT AS HUGEINT)) AS DECIMAL(38,0)) AS content_sum,
            count(*) AS row_count
        FROM (SELECT source, lang, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY ALL
    """,
    "observed_counts": f"""SELECT count(*) AS n_rows, count(*) FILTER ({K} = 0 OR ({K} <> 98 AND value = 0)) AS n_placeholders,
        count(*) FILTER ({K} = 99) AS n_rejected FROM events""",
    "ordered_range": """
        WITH ends AS (SELECT CAST(epoch(min(o_orderdate)) AS BIGINT) AS a, CAST(epoch(max(o_orderdate)) AS BIGINT) AS b FROM orders)
        SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_orders,
            CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, true AS in_order
        FROM orders, ends WHERE CAST(epoch(o_orderdate) AS BIGINT) BETWEEN (2 * a + b) // 3 AND (a + 2 * b) // 3 GROUP BY 1
    """,
    "ledger_scan": """
        SELECT CAST(event_id // 150 AS VARCHAR) AS resource_id, event_type AS area, date_trunc('second', ts) AS ts_utc,
            round(nullif(value, 0) + 1e-8, 6) AS load_mw
        FROM events QUALIFY event_id % 3 = max(event_id % 3) OVER (PARTITION BY event_id // 150)
    """,
    "landed_class_curves": """
        SELECT 'raw/' || l_suppkey AS file_path, NULL::VARCHAR AS problem, 'Light ' || l_returnflag AS "SigCcs",
            'Público ' || l_linestatus AS "DscDemandante",
            CASE WHEN l_linenumber = 1 THEN 'dia; útil, "x"' || chr(9) ELSE 'sábado' END AS "DscTipoDia",
            CAST(l_linenumber * 3 AS INTEGER) AS hour, count(*) AS n_rows,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM lineitem WHERE l_suppkey % 4 <> 3 GROUP BY ALL
        UNION ALL
        SELECT DISTINCT 'raw/' || l_suppkey, 'no separator in the first line', NULL, NULL, NULL, NULL::INTEGER, 0, NULL::DOUBLE
        FROM lineitem WHERE l_suppkey % 4 = 3
    """,
    "file_fingerprints": "SELECT doc_id, sha256(text) AS hash_sha256, CAST(strlen(text) AS BIGINT) AS file_size FROM documents",
    "ledger_versions": f"""WITH {LEDGER} SELECT source, resource_id, reference_period, hash_sha256, local_path,
  CAST(strlen(text) AS BIGINT) AS file_size, is_latest_downloaded FROM led""",
    "newest_versions": f"""WITH {LEDGER} SELECT source, resource_id, reference_period, hash_sha256 FROM led
WHERE is_latest_downloaded""",
    "new_versions": f"""WITH {LEDGER} SELECT source, resource_id, hash_sha256, local_path FROM versions v
WHERE NOT EXISTS (SELECT 1 FROM landed l JOIN labels b ON l.doc_id = b.doc_id
  WHERE l.source = v.source AND l.resource_id = v.resource_id AND l.hash_sha256 = v.hash_sha256)""",
    "revisions": f"""WITH {REVISIONS} SELECT source, 'documents' AS dataset, resource_id, reference_period, old_hash,
  new_hash, false AS downstream_reprocessed FROM rev""",
    "revision_row_changes": f"""WITH {REVISIONS},
lines AS (
  SELECT source, resource_id, hash_sha256, generate_subscripts(string_split(text, chr(10)), 1) AS line_no,
    unnest(string_split(text, chr(10))) AS line FROM versions),
o AS (
  SELECT r.source, r.resource_id, old_hash, new_hash, line_no, line FROM rev r
  JOIN lines l ON l.source = r.source AND l.resource_id = r.resource_id AND l.hash_sha256 = old_hash),
n AS (
  SELECT r.source, r.resource_id, old_hash, new_hash, line_no, line FROM rev r
  JOIN lines l ON l.source = r.source AND l.resource_id = r.resource_id AND l.hash_sha256 = new_hash),
d AS (
  SELECT source, resource_id, old_hash, new_hash, count(*) FILTER (o.line IS NULL) AS rows_added,
    count(*) FILTER (n.line IS NULL) AS rows_removed, count(*) FILTER (o.line <> n.line) AS rows_changed
  FROM o FULL JOIN n USING (source, resource_id, old_hash, new_hash, line_no) GROUP BY ALL)
SELECT source, resource_id, reference_period, old_hash, new_hash, rows_added, rows_removed, rows_changed
FROM rev JOIN d USING (source, resource_id, old_hash, new_hash)""",
    "version_checks": f"""WITH {CHECKS} SELECT source, check_name, passed, 'error' AS severity, count(*) AS n_versions,
  CAST(sum(rows_affected) AS BIGINT) AS rows_affected FROM outcomes GROUP BY ALL""",
    "gate_decisions": f"""WITH {GATED} SELECT source, resource_id, hash_sha256, approved,
  CAST(n_reasons AS INTEGER) AS n_reasons, CAST(n_checks AS INTEGER) AS n_checks, coalesce(failed, '') AS failed FROM decided""",
    "gated_ledger": f"""WITH {GATED} SELECT source, resource_id, reference_period, hash_sha256, is_latest_downloaded,
  approved AS is_latest_valid, is_active_for_gold,
  CASE WHEN is_active_for_gold THEN 'active' WHEN approved THEN 'superseded' ELSE 'quarantined' END AS lifecycle_status,
  CASE WHEN approved THEN 'validated' ELSE 'invalid' END AS validation_status, failed FROM gated""",
    "landed_readings": f"""WITH e AS (SELECT *, event_id // 50 AS f, {K} AS k FROM events)
SELECT 'raw/' || f AS file_path, NULL AS problem, event_type AS cod_areacarga, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS din_referenciautc,
  CASE WHEN k <> 98 THEN round(value + 1e-8, 6) END AS load, CASE WHEN k < 50 THEN round(k + 1e-8, 6) END AS val_cargammgd,
  CAST(NULL AS VARCHAR) AS val_consistencia FROM e WHERE f % 7 <> 0
UNION ALL SELECT DISTINCT 'raw/' || f, 'not readable as JSON', NULL, NULL, NULL, NULL, NULL FROM e WHERE f % 7 = 0""",
    "gate_rerun": f"""WITH {GATED},
one AS (SELECT *, hash_sha256 < '8' AS in_one FROM gated),
act AS (
  SELECT *, coalesce(in_one AND approved AND row_number() OVER (PARTITION BY source, reference_period
      ORDER BY CASE WHEN in_one AND approved THEN 0 ELSE 1 END, retrieved_at DESC, hash_sha256 DESC, resource_id DESC) = 1, false)
    AS was_active FROM one),
two AS (
  SELECT *, CASE WHEN is_latest_downloaded THEN approved ELSE was_active END AS may_be FROM act),
fin AS (
  SELECT *, may_be AND row_number() OVER (PARTITION BY source, reference_period
      ORDER BY CASE WHEN may_be THEN 0 ELSE 1 END, retrieved_at DESC, hash_sha256 DESC, resource_id DESC) = 1 AS now_active FROM two)
SELECT source, resource_id, reference_period, hash_sha256, (is_latest_downloaded OR in_one) AND approved AS is_latest_valid,
  now_active AS is_active_for_gold,
  CASE WHEN now_active THEN 'active' WHEN NOT (is_latest_downloaded OR in_one) THEN 'raw_immutable'
    WHEN approved THEN 'superseded' ELSE 'quarantined' END AS lifecycle_status,
  CASE WHEN NOT (is_latest_downloaded OR in_one) THEN 'downloaded' WHEN approved THEN 'validated' ELSE 'invalid' END AS validation_status,
  CASE WHEN is_latest_downloaded OR in_one THEN failed END AS failed FROM fin""",
    "active_versions": f"""WITH {GATED} SELECT source, resource_id, reference_period, hash_sha256 FROM gated
WHERE is_active_for_gold AND source = 'de'""",
    "freshness": f"""WITH {GATED},
srcs AS (SELECT DISTINCT lang AS source FROM documents UNION SELECT DISTINCT event_type FROM events),
lat AS (
  SELECT * FROM gated WHERE is_latest_downloaded
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY retrieved_at DESC, hash_sha256 DESC, resource_id DESC) = 1),
val AS (
  SELECT source, resource_id FROM gated WHERE approved
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY retrieved_at DESC, hash_sha256 DESC, resource_id DESC) = 1),
j AS (
  SELECT s.source, l.*, v.resource_id AS valid, l.source IS NOT NULL AS found,
    floor((epoch(TIMESTAMP '{w.AS_OF}') - epoch(l.retrieved_at)) / 86400) AS days,
    coalesce(CASE s.source {" ".join(f"WHEN '{k}' THEN {v}" for k, v in w.LAGS.items())} END, 30) AS lag
  FROM srcs s LEFT JOIN lat l ON s.source = l.source LEFT JOIN val v ON s.source = v.source)
SELECT source, reference_period AS latest_reference_period, '{w.AS_OF}' AS last_checked_at,
  strftime(retrieved_at, '%Y-%m-%d %H:%M:%S') AS last_successful_download, resource_id AS latest_downloaded_version,
  valid AS latest_valid_version, CAST(coalesce(days, -1) AS INTEGER) AS days_since_latest_reference,
  CAST(coalesce(DATE '{w.AS_OF[:10]}' - last_day(CAST(reference_period || '-01' AS DATE)), -1) AS INTEGER) AS days_since_reference_period,
  CASE WHEN NOT found THEN 'source_unavailable' WHEN valid IS NULL THEN 'new_version_pending_validation'
    WHEN days > lag THEN 'stale' WHEN days > lag * 0.5 THEN 'expected_lag' ELSE 'fresh' END AS freshness_status,
  CASE WHEN NOT found THEN 'n/a' WHEN approved THEN 'validated' ELSE 'invalid' END AS validation_status FROM j""",
    "lineage": f"""WITH {GATED} SELECT 'active_lines' AS gold_dataset, 'v1' AS gold_version, source, resource_id,
  hash_sha256 AS source_hash, reference_period, '0.1.0' AS pipeline_version, '{w.AS_OF}' AS created_at
FROM gated WHERE is_active_for_gold""",
    "schema_hashes": """SELECT n_regionkey, sha256(string_agg(n_name || ':bigint', '|' ORDER BY n_nationkey)) AS schema_hash
FROM nation GROUP BY 1""",
    "catalog_resources": f"""WITH {PUBLISHED} SELECT id, CASE WHEN name = '' THEN id ELSE name END AS name, format, url, created,
  CASE WHEN p_size < 30 THEN created END AS last_modified, CASE WHEN p_size < 20 THEN created ELSE '' END AS metadata_modified,
  CASE WHEN p_size > 40 THEN md5(p_name) END AS hash, CAST(p_size AS BIGINT) AS size, catalog AS package_id
FROM pub WHERE catalog <> 'Brand#7'""",
    "preferred_resources": f"""WITH {PUBLISHED} SELECT catalog, id, format, created AS recency FROM pub
QUALIFY row_number() OVER (PARTITION BY catalog ORDER BY
  list_position(['parquet', 'csv', 'json', 'xlsx', 'gzip', 'html', 'zip'], format), created DESC, position) = 1""",
    "preferred_named_resources": f"""WITH {PUBLISHED} SELECT catalog, id, format, name FROM pub WHERE name ILIKE '%red%'
QUALIFY row_number() OVER (PARTITION BY catalog ORDER BY
  coalesce(list_position(['xlsx', 'csv'], format), 3), created DESC, position) = 1""",
    "period_from_name": f"WITH {NAMED} SELECT o_orderkey, name, reference_period FROM named",
    "period_window": f"""WITH {NAMED} SELECT o_orderkey, reference_period FROM named
WHERE reference_period IS NULL OR reference_period BETWEEN '2021-03' AND '2024-10'""",
    "page_links": f"""WITH {HREFS},
f AS (SELECT page_id, {_ORIGIN} AS origin, list_filter(found, lambda h: {_ends(w.LINK_ENDINGS, "h")}) AS fs FROM hrefs),
u AS (SELECT page_id, origin, CAST(generate_subscripts(fs, 1) - 1 AS INTEGER) AS link_position, unnest(fs) AS href FROM f)
SELECT page_id, link_position, origin || href AS link FROM u""",
    "current_links": f"""WITH {HREFS},
f AS (SELECT page_id, {_ORIGIN} AS origin, list_filter(found, lambda h: {_ends(w.CURRENT_LINK_ENDINGS, "h")})[1] AS href FROM hrefs),
u AS (SELECT page_id, coalesce(origin || href, '{w.FALLBACK_URL}') AS download_url, href IS NULL AS used_fallback FROM f)
SELECT page_id, download_url, used_fallback, 'epe-' || substr(sha1(download_url), 1, 16) AS resource_id FROM u""",
    "anchors_dense": f"WITH {ANCHORS} SELECT country, year, round(value + 1e-8, 6) AS value, value_type FROM dense",
    "scenario_table": f"WITH {SCENARIOS} SELECT * FROM scen",
    "weight_bounds": f"""WITH {SHARES} SELECT country, region, round(weight_low + 1e-8, 6) AS weight_low,
  round(weight_high + 1e-8, 6) AS weight_high, round(weight_central + 1e-8, 6) AS weight_central FROM weights""",
    "regional_allocation": f"""WITH {SCENARIOS}, {SHARES},
c AS (
  SELECT country, region, 'low' AS rj_weight_case, weight_low AS w FROM weights
  UNION ALL SELECT country, region, 'central', weight_central FROM weights
  UNION ALL SELECT country, region, 'high', weight_high FROM weights)
SELECT country, region, year, scenario, rj_weight_case,
  CAST(printf('%.5f', demand_light_ev_twh * w) AS DOUBLE) AS demand_light_ev_twh,
  CAST(round_even(implied_bev_phev_fleet_units * w, 0) AS BIGINT) AS implied_bev_phev_fleet_units,
  'derived_proportional_national_share' AS value_type FROM scen JOIN c USING (country)""",
    "growth_rates": f"""WITH {YEARLY},
e AS (SELECT country, max(value) FILTER (year = 1995) AS a, max(value) FILTER (year = 2000) AS b FROM yearly GROUP BY 1)
SELECT country, round(pow(b / a, 0.2) - 1 + 1e-8, 6) AS cagr FROM e""",
    "consistency_ratios": f"""WITH {SCENARIOS},
o AS (SELECT country, year, CAST(round_even(value * 1e6, 0) AS BIGINT) AS official_units FROM yearly)
SELECT country, year, scenario, implied_bev_phev_fleet_units AS implied_units, official_units,
  round(implied_bev_phev_fleet_units / nullif(CAST(official_units AS DOUBLE), 0) + 1e-8, 6) AS consistency_ratio
FROM scen LEFT JOIN o USING (country, year)""",
    "hour_weights": """WITH r AS (
  SELECT l_returnflag AS strategy, CAST(l_orderkey % 24 AS INTEGER) AS hour, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
SELECT strategy, hour, round(q / sum(q) OVER (PARTITION BY strategy) + 1e-8, 6) AS weight FROM r""",
    "charging_shapes": f"""WITH {SHAPES} SELECT area, hour, round(base_mw + 1e-8, 6) AS base_mw, strategy, round(weight + 1e-8, 6) AS weight
FROM shp""",
    "overlay_hourly": f"""WITH {OVERLAY}
SELECT area, "case", n_vehicles, strategy, hour, round(daily_energy_added_mwh + 1e-8, 6) AS daily_energy_added_mwh,
  round(base_mw + 1e-8, 6) AS base_mw, round(added_mw + 1e-8, 6) AS added_mw, round(total_mw + 1e-8, 6) AS total_mw,
  round(base_mw / avg(base_mw) OVER (PARTITION BY area, "case", strategy) + 1e-8, 6) AS base_normalized,
  round(total_mw / avg(total_mw) OVER (PARTITION BY area, "case", strategy) + 1e-8, 6) AS total_normalized FROM ov""",
    "overlay_summary": f"""WITH {OVERLAY},
s AS (
  SELECT area, "case", strategy, max(n_vehicles) AS n_vehicles, max(daily_energy_added_mwh) AS e, max(base_mw) AS b,
    list(hour ORDER BY base_mw DESC, hour)[1] AS bh, max(total_mw) AS t, list(hour ORDER BY total_mw DESC, hour)[1] AS th
  FROM ov GROUP BY ALL)
SELECT area, "case", strategy, n_vehicles, round(e + 1e-6, 4) AS daily_energy_added_mwh, round(b + 1e-6, 4) AS baseline_peak_mw,
  CAST(bh AS INTEGER) AS baseline_peak_hour, round(t + 1e-6, 4) AS new_peak_mw, CAST(th AS INTEGER) AS new_peak_hour,
  round(100 * (t - b) / nullif(b, 0) + 1e-6, 4) AS peak_increase_pct, bh <> th AS peak_hour_shifted FROM s""",
}
