"""SQL for each registered query, written for DuckDB over the driver's tables.

The SQL states results its own way: two-decimal rounding goes through exact decimal
text, steps through subqueries, first rows through ``arg_min``.
"""

from __future__ import annotations

from heliocat.constants import (
    CLASS_LEVELS,
    FLUX_CLASSES,
    KP_AP_DEFAULT,
    KP_AP_STEPS,
    KP_STEP_MARGIN,
    LEGACY_CORRECTION_FACTOR,
    SITE_LATITUDE,
    SITE_LONGITUDE,
    SUN_TERMS,
)


def num(x: float) -> str:
    """A double literal."""
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


def round2(x: str) -> str:
    return f"CAST(format('{{:.2f}}', {x}) AS DOUBLE)"


def round6(x: str) -> str:
    return f"floor(({x}) * 1e6 + 0.5e0) / 1e6"


def letter(flux: str) -> str:
    whens = " ".join(f"WHEN {flux} < {num(limit * 10)} THEN '{c}'" for c, limit, _ in FLUX_CLASSES[:-1])
    return f"CASE {whens} WHEN {flux} IS NOT NULL THEN '{FLUX_CLASSES[-1][0]}' END"


def sub(flux: str) -> str:
    whens = " ".join(f"WHEN '{c}' THEN {num(m)}" for c, _, m in FLUX_CLASSES)
    return round2(f"{flux} * CASE {letter(flux)} {whens} END")


def magnitude(flux: str) -> str:
    return f"({letter(flux)} || CAST({sub(flux)} AS VARCHAR))"


def kp_to_ap(kp: str) -> str:
    whens = " ".join(
        f"WHEN {kp} <= {num(step + KP_STEP_MARGIN)} THEN {ap}" for step, ap in KP_AP_STEPS
    )
    return f"CASE {whens} ELSE {KP_AP_DEFAULT} END"


def exact_mean(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(20,10))) AS DOUBLE) / count({x})"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"


def seconds(ts: str) -> str:
    """Whole seconds since the time base."""
    return f"(epoch_us({ts}) - epoch_us(TIMESTAMP '2000-01-01 12:00:00')) // 1000000"


def sun(df: str, ts: str, keep: str) -> str:
    """``keep`` columns of ``df`` with altitude and azimuth at ``ts``, one step of the almanac per level."""
    lat = f"radians({num(SITE_LATITUDE)})"
    terms = ", ".join(f"{{'size': {x}e0, 'phase': {num(y)}, 'rate': {num(z)}}}" for x, y, z in SUN_TERMS)
    year = "(2000e0 + n / 365.25e0)"
    old, new = f"({year} - 1975e0)", f"({year} - 2000e0)"
    far = f"(({year} - 1820e0) / 100e0)"
    delta = f"""CASE WHEN {year} BETWEEN 1961 AND 1986 THEN 45.45e0 + {old} * (1.067e0 + {old} * ({num(-1 / 260)} + {old} * {num(-1 / 718)}))
      WHEN {year} BETWEEN 1986 AND 2005 THEN 63.86e0 + {new} * (0.3345e0 + {new} * (-0.060374e0 + {new} * (0.0017275e0
           + {new} * (0.000651814e0 + {new} * 0.00002373599e0))))
      WHEN {year} BETWEEN 2005 AND 2050 THEN 62.92e0 + {new} * (0.32217e0 + {new} * 0.005589e0)
      ELSE -20e0 + 32e0 * {far} * {far} END"""
    return f"""
    SELECT {keep}, {round6(f'alt - {num(8.794 / 3600)} / dist * cos(radians(alt))')} AS altitude,
           {round6('CASE WHEN degrees(az) < 0 THEN degrees(az) + 360e0 ELSE degrees(az) END')} AS azimuth
    FROM (
      SELECT *, degrees(asin(sin({lat}) * sin(dec) + cos({lat}) * cos(dec) * cos(h))) AS alt,
             atan2(-1e0 * cos(dec) * sin(h),
                   sin(dec) * cos({lat}) - cos(dec) * sin({lat}) * cos(h)) AS az,
             1.00014e0 - 0.01671e0 * cos(g) - 0.00014e0 * cos(2e0 * g) AS dist
      FROM (
        SELECT *, asin(sin(obl) * sin(lon)) AS dec,
               radians(280.46061837e0 + 360.98564736629e0 * n + 0.000387933e0 * (n / 36525e0) * (n / 36525e0)
                       + nut * cos(obl) + {num(SITE_LONGITUDE)})
               - atan2(cos(obl) * sin(lon), cos(lon)) AS h
        FROM (
          SELECT *, radians(geo + nut + (0.0000974e0 * cos(radians(177.63e0 + 35999.01848e0 * c)) - 0.005575e0)) AS lon
          FROM (
            SELECT *, 282.7771834e0 + 36000.76953744e0 * c + 5.729577951308232e-06 * list_sum(list_transform(
                        [{terms}], lambda p: p.size * sin(radians(p.phase + p.rate * c)))) AS geo,
                   -0.004778e0 * sin(radians(124.90e0 - 1934.134e0 * c))
                     - 0.0003667e0 * sin(radians(201.11e0 + 72001.5377e0 * c)) AS nut,
                   radians(23.4392911e0 - 0.0130042e0 * c + 0.002556e0 * cos(radians(125.04452e0 - 1934.136261e0 * c))
                     + 0.000157e0 * cos(radians(560.933e0 + 72001.5396e0 * c))) AS obl,
                   radians(357.528e0 + 0.9856003e0 * n) AS g
            FROM (
              SELECT *, (n + ({delta}) / 86400e0) / 36525e0 AS c
              FROM (SELECT *, CAST({seconds(ts)} AS DOUBLE) / 86400e0 AS n FROM {df})
            )
          )
        )
      )
    )"""


# ---- the adapters' frames ------------------------------------------------------------

STATUS_ROWS = f"""status_rows AS (
  SELECT user_id * 100 + day(ts) AS flare_id,
         CASE event_type WHEN 'click' THEN 'EVENT_START' WHEN 'view' THEN 'EVENT_PEAK'
                         WHEN 'purchase' THEN 'EVENT_END' ELSE 'POST_EVENT' END AS status,
         (epoch_us(ts) - epoch_us(TIMESTAMP '2000-01-01 12:00:00')) / 1e6 AS time,
         value * value * 1e-9 AS xrsb_flux, value AS integrated_flux, event_id AS pos
  FROM events)"""

ORDER_TIMES = """order_times AS (
  SELECT *, o_orderdate + to_minutes(o_orderkey % 1440) AS event_start,
         (o_totalprice / 1e5) * (o_totalprice / 1e5) * 5e-6 AS flux
  FROM orders)"""

FLARES = f"""{ORDER_TIMES}, flares AS (
  SELECT o_orderkey AS id, event_start, event_start + INTERVAL 10 MINUTE AS event_peak,
         event_start + INTERVAL 25 MINUTE AS event_end,
         CASE WHEN o_orderkey % 17 <> 0 THEN {magnitude('flux')} END AS magnitude,
         flux AS xrsb_flux_peak, o_totalprice AS integrated_flux,
         o_orderpriority AS instrument, o_orderstatus AS source
  FROM order_times)"""

INDICES = f"""indices AS (
  SELECT date, sunspot_number, f10_7_flux, {round2('kp')} AS kp_index,
         CAST({kp_to_ap('kp')} AS INTEGER) AS ap_index
  FROM (SELECT CAST(l_shipdate AS DATE) AS date, CAST(count(*) AS INTEGER) AS sunspot_number,
               sum(l_quantity) AS f10_7_flux, {exact_mean('l_discount * 90e0')} AS kp
        FROM lineitem GROUP BY 1))"""

CATALOG = f"""{ORDER_TIMES}, catalog AS (
  SELECT o_orderkey AS ordinal, event_start - INTERVAL 8036 DAY AS event_start,
         event_start - INTERVAL 8036 DAY + INTERVAL 10 MINUTE AS event_peak,
         event_start - INTERVAL 8036 DAY + INTERVAL 25 MINUTE AS event_end,
         flux AS raw_flux, flux / {num(LEGACY_CORRECTION_FACTOR)} AS xrsb_flux_peak,
         o_orderpriority AS instrument
  FROM order_times)"""

ERAS = f"""{FLARES}, united AS (
  SELECT id, event_start, magnitude, instrument, 'SWPC' AS source, 0 AS source_rank
  FROM flares WHERE event_start < '1997-01-01'
  UNION ALL
  SELECT id, event_start, magnitude, instrument, 'GOES-16', 1
  FROM flares WHERE event_start >= '1997-01-01' AND event_start < '2000-01-01'
                AND event_start < '1999-06-01'
  UNION ALL
  SELECT id, event_start, magnitude, instrument, 'GOES-19', 2
  FROM flares WHERE event_start >= '1999-06-01')"""

KEYED = """keyed AS (
  SELECT date_trunc('hour', ts) AS event_start, nullif(event_type, 'error') AS instrument,
         event_id AS seq, value, ts FROM events),
existing AS (SELECT * FROM keyed WHERE ts < '2024-01-20'),
incoming AS (SELECT * EXCLUDE (ts) FROM keyed WHERE ts >= '2024-01-10')"""

DOCUMENTS = """elements AS (
  SELECT event_id, event_type, user_id, value, ts + to_hours(e) AS begin_ts, e AS element
  FROM events, (VALUES (0), (1)) AS v(e))"""

LIST_WHERE = (
    "event_start >= TIMESTAMP '1996-01-01' AND event_start <= TIMESTAMP '1999-12-31 12:00:00' "
    "AND starts_with(magnitude, 'X1')"
)
# Links of a page. Text between "<" and the next "<" is taken apart by plain string functions:
# what is open when a comment or script ends is counted, and such parts are left out.
LINKS = """[h FOR h IN [replace(replace(string_split(p, '"')[1], '&lt;', '<'), '&amp;', '&')
  FOR p IN string_split(visible, '<a href="')[2:] IF contains(p, '"')] IF h <> '']"""
VISIBLE = """(SELECT page_id, list_aggregate([CASE WHEN i = 1 THEN cut[i]
         WHEN starts_with(cut[i], '!--') AND contains(cut[i], '-->') THEN substr(cut[i], strpos(cut[i], '-->') + 3)
         WHEN starts_with(cut[i], '!--') OR starts_with(lower(cut[i]), 'script')
           OR starts_with(lower(cut[i]), 'style') THEN ''
         ELSE '<' || cut[i] END FOR i IN range(1, len(cut) + 1)], 'string_agg', '') AS visible
  FROM (SELECT page_id, string_split(html, '<') AS cut FROM pages))"""
WITH_INDICES = "sunspot_number, f10_7_flux, kp_index, ap_index"

ORACLE: dict[str, str] = {}

ORACLE["collapse_events"] = f"""WITH {STATUS_ROWS}, grouped AS (
  SELECT flare_id AS event_id, min(pos) AS seq,
         arg_min(time, pos) FILTER (status = 'EVENT_START') AS t_start,
         arg_min(time, pos) FILTER (status = 'EVENT_PEAK') AS t_peak,
         arg_min(time, pos) FILTER (status = 'EVENT_END') AS t_end,
         arg_min(xrsb_flux, pos) FILTER (status = 'EVENT_PEAK') AS xrsb_flux_peak,
         arg_min(integrated_flux, pos) FILTER (status = 'EVENT_END') AS integrated_flux
  FROM status_rows GROUP BY flare_id HAVING count(*) >= 3),
timed AS (
  SELECT event_id, seq,
         TIMESTAMP '2000-01-01 12:00:00' + to_seconds(trunc(t_start)) AS event_start,
         TIMESTAMP '2000-01-01 12:00:00' + to_seconds(trunc(t_peak)) AS event_peak,
         TIMESTAMP '2000-01-01 12:00:00' + to_seconds(trunc(t_end)) AS event_end,
         {magnitude('xrsb_flux_peak')} AS magnitude, xrsb_flux_peak, integrated_flux
  FROM grouped WHERE t_start IS NOT NULL AND t_peak IS NOT NULL AND t_end IS NOT NULL)
{sun('timed', 'event_peak', 'event_id, seq, event_start, event_peak, event_end, magnitude, xrsb_flux_peak, integrated_flux')}"""

ORACLE["collapse_counters"] = f"""WITH {STATUS_ROWS}, grouped AS (
  SELECT flare_id, count(*) >= 3 AND count(*) FILTER (status = 'EVENT_START') > 0
         AND count(*) FILTER (status = 'EVENT_PEAK') > 0
         AND count(*) FILTER (status = 'EVENT_END') > 0 AS ok
  FROM status_rows GROUP BY flare_id)
SELECT count(*) AS detected, count(*) FILTER (ok) AS processed, count(*) FILTER (NOT ok) AS discarded
FROM grouped"""

ORACLE["distinct_event_ids"] = f"WITH {STATUS_ROWS} SELECT DISTINCT flare_id FROM status_rows"

ORACLE["classify_flux"] = f"""WITH {STATUS_ROWS}
SELECT pos, {letter('xrsb_flux')} AS letter, {sub('xrsb_flux')} AS sub,
       {magnitude('xrsb_flux')} AS magnitude FROM status_rows"""

ORACLE["normalise_catalog"] = f"""WITH {CATALOG}
SELECT ordinal, event_start, event_peak, event_end, {magnitude('xrsb_flux_peak')} AS magnitude,
       xrsb_flux_peak, instrument, 'SWPC' AS source
FROM catalog WHERE event_peak >= TIMESTAMP '1974-01-01 12:00:00'
      AND event_start < TIMESTAMP '1975-06-01 00:00:00'"""

ORACLE["merge_eras"] = f"WITH {ERAS} SELECT * FROM united"

ORACLE["era_bounds"] = f"""WITH {ERAS}
SELECT source, min(event_start) AS "from", max(event_start) AS "to" FROM united GROUP BY source"""

ORACLE["era_trim_counts"] = f"""WITH {FLARES}
SELECT count(*) FILTER (event_start < '1999-06-01') AS kept,
       count(*) FILTER (event_start >= '1999-06-01') AS removed FROM flares"""

ORACLE["overlap_window"] = f"""WITH {FLARES}
SELECT id, event_start, magnitude FROM flares
WHERE event_start > '1999-06-01' AND event_start < '1999-12-30'"""

ORACLE["list_flares_filtered"] = f"""WITH {FLARES}
SELECT * FROM flares WHERE {LIST_WHERE} ORDER BY event_start DESC, id DESC LIMIT 5 OFFSET 5"""

ORACLE["list_flares_far_page"] = f"""WITH {FLARES}
SELECT * FROM flares ORDER BY event_start DESC, id DESC LIMIT 100 OFFSET 1100"""

ORACLE["list_flares_total"] = f"""WITH {FLARES}
SELECT count(*) AS cnt FROM flares
WHERE {LIST_WHERE} AND instrument = '1-URGENT' AND source = 'F'"""

ORACLE["list_flares_with_indices"] = f"""WITH {FLARES}, {INDICES}
SELECT f.*, {WITH_INDICES} FROM flares f LEFT JOIN indices i ON CAST(f.event_start AS DATE) = i.date
WHERE instrument = '1-URGENT' ORDER BY event_start DESC, id DESC LIMIT 1000"""

ORACLE["flares_with_indices"] = f"""WITH {FLARES}, {INDICES}
SELECT id, event_start, {WITH_INDICES}
FROM flares f LEFT JOIN indices i ON CAST(f.event_start AS DATE) = i.date"""

ORACLE["flare_page"] = f"""WITH {FLARES}, page AS (
  SELECT id, event_start FROM flares WHERE starts_with(magnitude, 'M')
  ORDER BY event_start DESC, id DESC LIMIT 10 OFFSET 20)
SELECT (SELECT count(*) FROM flares WHERE starts_with(magnitude, 'M')) AS total,
       3 AS page, 10 AS page_size,
       string_agg(id, ',' ORDER BY event_start DESC, id DESC) AS ids,
       string_agg({iso('event_start')}, ',' ORDER BY event_start DESC, id DESC) AS starts FROM page"""

ORACLE["response_rows"] = f"""WITH {FLARES}
SELECT id, {iso('event_start')} AS event_start, {iso('event_peak')} AS event_peak,
       {iso('event_end')} AS event_end, magnitude, xrsb_flux_peak, integrated_flux, instrument, source
FROM flares"""

ORACLE["latest_flare"] = f"""WITH {FLARES}
SELECT * FROM flares ORDER BY event_start DESC, id DESC LIMIT 1"""

ORACLE["flare_by_id"] = f"""WITH {FLARES}, {INDICES}
SELECT f.*, {WITH_INDICES} FROM flares f LEFT JOIN indices i ON CAST(f.event_start AS DATE) = i.date
WHERE id = 77"""

ORACLE["stats_by_class"] = f"""WITH {FLARES}
SELECT left(magnitude, 1) AS class, count(*) AS cnt FROM flares
WHERE magnitude IS NOT NULL GROUP BY 1"""

ORACLE["stats_by_year"] = f"""WITH {FLARES}
SELECT CAST(year(event_start) AS INTEGER) AS year, count(*) AS cnt FROM flares GROUP BY 1"""

ORACLE["stats_by_instrument"] = f"""WITH {FLARES}
SELECT instrument, count(*) AS cnt FROM flares GROUP BY 1"""

ORACLE["stats_range"] = f"""WITH {FLARES}
SELECT min(event_start) AS "from", max(event_start) AS "to" FROM flares"""

_LONG = f"""{FLARES}, long AS (
  SELECT 'total' AS kind, NULL::VARCHAR AS key, count(*) AS cnt FROM flares
  UNION ALL SELECT 'class', left(magnitude, 1), count(*) FROM flares WHERE magnitude IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'year', CAST(year(event_start) AS VARCHAR), count(*) FROM flares GROUP BY 2
  UNION ALL SELECT 'instrument', instrument, count(*) FROM flares GROUP BY 2)"""

ORACLE["stats_all"] = f"WITH {_LONG} SELECT * FROM long"

ORACLE["stats_answer"] = f"""WITH {_LONG}
SELECT max(cnt) FILTER (kind = 'total') AS total_flares,
       string_agg(key || '=' || cnt, ',' ORDER BY key) FILTER (kind = 'class') AS by_class,
       string_agg(key || '=' || cnt, ',' ORDER BY key) FILTER (kind = 'year') AS by_year,
       string_agg(key || '=' || cnt, ',' ORDER BY cnt DESC, key) FILTER (kind = 'instrument') AS by_instrument,
       (SELECT {iso('min(event_start)')} FROM flares) AS range_from,
       (SELECT {iso('max(event_start)')} FROM flares) AS range_to
FROM long"""

ORACLE["list_indices"] = f"""WITH {INDICES}
SELECT * FROM indices WHERE date >= DATE '1996-01-01' AND date <= DATE '2001-06-30'
ORDER BY date DESC LIMIT 1000"""

ORACLE["daily_kp_ap"] = f"""
SELECT date, {round2('mean')} AS kp_index, CAST({kp_to_ap('mean')} AS INTEGER) AS ap_index
FROM (SELECT CAST(ts AS DATE) AS date, {exact_mean('least(value / 10e0, 9e0)')} AS mean
      FROM events GROUP BY 1)"""

_STEP_ROWS = ", ".join(f"({num(step + KP_STEP_MARGIN)}, {ap})" for step, ap in KP_AP_STEPS)
ORACLE["ap_step_lookup"] = f"""
SELECT event_id, CAST(coalesce((SELECT min(ap) FROM (VALUES {_STEP_ROWS}) AS s(bound, ap)
                                WHERE least(value / 10e0, 10e0) <= bound), {KP_AP_DEFAULT}) AS INTEGER) AS ap_index
FROM events"""

ORACLE["insert_ignore"] = f"""WITH {KEYED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_start, instrument ORDER BY seq) AS rn FROM incoming)
SELECT event_start, instrument, seq, value FROM ranked r
WHERE (instrument IS NULL OR rn = 1)
  AND NOT EXISTS (SELECT 1 FROM existing e
                  WHERE e.event_start = r.event_start AND e.instrument = r.instrument)"""

ORACLE["insert_ignore_start_only"] = f"""WITH {KEYED}
SELECT event_start, arg_min_null(instrument, seq) AS instrument, min(seq) AS seq, arg_min(value, seq) AS value
FROM incoming WHERE event_start NOT IN (SELECT event_start FROM existing) GROUP BY event_start"""

ORACLE["existing_starts"] = f"""WITH {KEYED}
SELECT * FROM incoming WHERE event_start IN (SELECT event_start FROM existing)"""

ORACLE["upsert_indices"] = f"""WITH lookup AS (
  SELECT CAST(ts AS DATE) AS date, {exact_mean('least(value / 10e0, 9e0)')} AS kp
  FROM events WHERE ts < '2024-01-20' GROUP BY 1),
feed AS (
  SELECT CAST(ts AS DATE) AS date, CAST(floor(arg_max(value, event_id) + 0.5e0) AS INTEGER) AS sn
  FROM events WHERE ts >= '2024-01-10' GROUP BY 1)
SELECT date, sn AS sunspot_number, NULL::DOUBLE AS f10_7_flux, {round2('kp')} AS kp_index,
       CASE WHEN kp IS NOT NULL THEN CAST({kp_to_ap('kp')} AS INTEGER) END AS ap_index,
       CASE WHEN kp IS NULL THEN 'SILSO' END AS source
FROM lookup FULL JOIN feed USING (date)"""

ORACLE["migrate_observations"] = f"""WITH {FLARES}, observations AS (
  SELECT o_orderkey AS id, event_start, {letter('flux')} AS classification,
         CAST({sub('flux')} AS FLOAT) AS sub_classification,
         nullif(o_orderpriority, '5-LOW') AS instrument,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS max_energy
  FROM order_times),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_start, instrument ORDER BY id) AS rn FROM observations)
SELECT id AS seq, event_start, event_start + INTERVAL 10 MINUTE AS event_peak,
       event_start + INTERVAL 25 MINUTE AS event_end,
       classification || format('{{:,.1f}}', CAST(sub_classification AS DOUBLE)) AS magnitude,
       instrument, 'JSON' AS source, max_energy AS xrslong_flux,
       CAST(0 AS BIGINT) AS active_region, CAST(5 AS BIGINT) AS members
FROM ranked r
WHERE (instrument IS NULL OR rn = 1)
  AND NOT EXISTS (SELECT 1 FROM flares f WHERE f.event_start < '1998-01-01'
                  AND f.event_start = r.event_start AND f.instrument = r.instrument)"""

_MAPPED = f"""{DOCUMENTS}, mapped AS (
  SELECT event_id, element, date_trunc('second', begin_ts) AS event_start,
         date_trunc('second', begin_ts) + INTERVAL 10 MINUTE AS event_peak,
         date_trunc('second', begin_ts) + INTERVAL 25 MINUTE AS event_end,
         CASE WHEN event_type = 'click' THEN 'B9.9' ELSE 'C' || (element + 1) || '.5' END AS magnitude,
         'G' || CASE WHEN event_type = 'signup' THEN 'None' ELSE user_id::VARCHAR END AS instrument,
         'JSON' AS source,
         CASE WHEN event_type = 'view' OR value = 0 THEN value / 2e0 ELSE value END AS xrslong_flux
  FROM elements WHERE event_type <> 'error')"""
ORACLE["parse_latest_json"] = f"""WITH {_MAPPED} {sun(
    'mapped', 'event_peak',
    'event_id, element, event_start, event_peak, event_end, magnitude, instrument, source, xrslong_flux')}"""

ORACLE["parse_latest_first_only"] = f"""
SELECT event_id, CASE WHEN event_type <> 'signup' THEN user_id::VARCHAR END AS satellite,
       {iso('ts')} || 'Z' AS begin_time,
       CASE WHEN event_type = 'error' THEN 'Unk' ELSE {iso('ts + INTERVAL 10 MINUTE')} || 'Z' END AS max_time,
       CASE WHEN event_type = 'click' THEN '' ELSE 'C1.5' END AS max_class,
       CASE WHEN event_type = 'view' THEN 0e0 ELSE value END AS max_xrlong
FROM events"""

ORACLE["legacy_observations"] = f"""
SELECT event_id, date_trunc('second', ts) AS event_start,
       CASE WHEN event_type = 'click' THEN '' ELSE 'C' END AS classification,
       CASE WHEN event_type <> 'click' THEN 1.5e0 END AS sub_classification,
       'G' || CASE WHEN event_type = 'signup' THEN 'None' ELSE user_id::VARCHAR END AS observation_instrument,
       CASE WHEN event_type = 'view' THEN 0e0 ELSE value END AS max_energy
FROM events WHERE event_type <> 'error'"""

ORACLE["extract_first_link"] = f"""
SELECT page_id, [h FOR h IN {LINKS} IF ends_with(h, 'n')][1] AS link FROM {VISIBLE}"""

ORACLE["extract_named_link"] = f"""
SELECT page_id, CASE WHEN list_contains({LINKS}, '/the') THEN '/the' END AS link FROM {VISIBLE}"""

ORACLE["missing_links"] = f"""
SELECT count(*) AS pages,
       count(*) FILTER ([h FOR h IN {LINKS} IF ends_with(h, 'n')][1] IS NULL) AS missing FROM {VISIBLE}"""

ORACLE["sun_position"] = sun("events", "ts", "event_id")

ORACLE["flux_series"] = f"WITH {FLARES} SELECT source, event_peak, xrsb_flux_peak FROM flares"

ORACLE["calibration_compare"] = f"""WITH {CATALOG}
SELECT event_peak, xrsb_flux_peak AS corrected_flux, raw_flux FROM catalog
WHERE event_peak >= TIMESTAMP '1974-01-01 12:00:00'"""

ORACLE["class_levels"] = f"""WITH {FLARES}
SELECT event_peak, xrsb_flux_peak, {', '.join(f'{num(v)} AS {n}' for n, v in CLASS_LEVELS)} FROM flares"""

ORACLE["peak_rows"] = f"""WITH {STATUS_ROWS}
SELECT xrsb_flux FROM status_rows WHERE status = 'EVENT_PEAK'"""

ORACLE["first_rows"] = f"WITH {FLARES} SELECT id, event_start FROM flares ORDER BY id LIMIT 5"

ORACLE["last_rows"] = f"WITH {FLARES} SELECT id, event_start FROM flares ORDER BY id DESC LIMIT 5"

ORACLE["stream_insert_ignore"] = f"""WITH {KEYED}
SELECT event_start, instrument, arg_min(value, seq) AS xrsb_flux_peak
FROM keyed WHERE instrument IS NOT NULL GROUP BY ALL
UNION ALL SELECT event_start, NULL, value FROM keyed WHERE instrument IS NULL"""

ORACLE["stream_latest_events"] = f"""WITH {_MAPPED}
SELECT event_start, instrument, arg_min(magnitude, event_id * 2 + element) AS magnitude
FROM mapped GROUP BY event_start, instrument"""

ORACLE["stream_drop_repeats"] = f"""WITH {KEYED}
SELECT DISTINCT event_start, instrument FROM keyed WHERE instrument IS NOT NULL
UNION ALL SELECT event_start, NULL FROM keyed WHERE instrument IS NULL"""

ORACLE["newest_name"] = """
SELECT max(url) AS file_name FROM pages WHERE starts_with(url, 'http') AND ends_with(url, '5')"""

ORACLE["unread_files"] = """
SELECT page_id, url AS file_name FROM pages
WHERE url NOT IN (SELECT url FROM pages WHERE contains(url, '/en/'))"""

ORACLE["parse_sunspot_lines"] = """
SELECT CAST(ts AS DATE) AS date, CAST(floor(value + 0.5e0) AS INTEGER) AS sunspot_number,
       'SILSO' AS source, event_id AS seq
FROM events WHERE event_type NOT IN ('click', 'error', 'signup')"""

ORACLE["parse_f10_7_records"] = """
SELECT CAST(ts AS DATE) AS date, value AS f10_7_flux, event_id AS seq
FROM events WHERE event_type NOT IN ('click', 'error', 'signup')"""

ORACLE["assign_dense_ids"] = f"""WITH {KEYED}
SELECT event_start, instrument, seq, value,
       1000 + row_number() OVER (ORDER BY event_start, instrument NULLS FIRST, seq) AS id FROM keyed"""

# ---- files, tables and counts --------------------------------------------------------

_ERA = "event_peak >= TIMESTAMP '1974-01-01 12:00:00'"
ORACLE["catalog_cut_counts"] = f"""WITH {CATALOG}, middle AS (SELECT max(ordinal) // 2 AS m FROM catalog)
SELECT count(*) FILTER (ordinal < m) AS kept, count(*) FILTER (ordinal >= m) AS removed
FROM catalog, middle WHERE {_ERA}"""

ORACLE["history_accounts"] = f"""WITH {CATALOG}, middle AS (SELECT max(ordinal) // 2 AS m FROM catalog),
all_flares AS (SELECT event_start FROM (WITH {FLARES} SELECT * FROM flares)),
fates AS (
  SELECT 'SWPC' AS source, CASE WHEN ordinal >= m THEN 'behind the catalog' WHEN event_peak IS NULL THEN 'without a peak'
                                WHEN {_ERA} THEN 'offered' ELSE 'before the catalog' END AS fate
  FROM catalog, middle
  UNION ALL
  SELECT 'GOES-16', CASE WHEN event_start < '1999-06-01' THEN 'offered' ELSE 'in the last era' END
  FROM all_flares WHERE event_start >= '1997-01-01' AND event_start < '2000-01-01'
  UNION ALL
  SELECT 'GOES-19', 'offered' FROM all_flares WHERE event_start >= '1999-06-01')
SELECT source, fate, count(*) AS events FROM fates GROUP BY source, fate"""

ORACLE["list_flares_deep_page"] = f"""WITH {FLARES}
SELECT * FROM flares ORDER BY event_start DESC, id DESC LIMIT 1000 OFFSET 8000"""

ORACLE["list_indices_second_page"] = f"""WITH {INDICES}
SELECT * FROM indices WHERE date >= DATE '1996-01-01' AND date <= DATE '2001-06-30'
ORDER BY date DESC LIMIT 900 OFFSET 900"""

ORACLE["array_status_rows"] = f"""WITH {STATUS_ROWS}
SELECT flare_id::VARCHAR AS file, row_number() OVER (PARTITION BY flare_id ORDER BY pos) - 1 AS pos,
       flare_id, status, time, xrsb_flux, CASE WHEN pos % 7 <> 0 THEN integrated_flux ELSE -9999e0 END AS integrated_flux,
       {magnitude('xrsb_flux')} AS flare_class
FROM status_rows"""

_BY_FILE = ORACLE["collapse_events"].replace("pos)", "(pos % 2) * 1000000000000 + pos)")
ORACLE["collapse_many_files"] = f"SELECT * EXCLUDE (seq) FROM ({_BY_FILE})"

ORACLE["sync_array_files"] = f"""
SELECT DISTINCT event_start, 'GOES-19' AS instrument, 'GOES-19' AS source FROM ({ORACLE["collapse_events"]})"""

ORACLE["catalog_from_files"] = f"""WITH {CATALOG}
SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, event_start, instrument, raw_flux FROM catalog"""

ORACLE["legacy_single_objects"] = ORACLE["parse_latest_first_only"]

_LOADED = f"""{CATALOG}, batch AS (
  SELECT *, ordinal % 50 = 0 OR length(instrument) > 10
            OR length({magnitude('xrsb_flux_peak')}) > 8 AS bad FROM catalog WHERE {_ERA}),
counts AS (
  SELECT count(*) AS n, count(*) FILTER (bad) AS bad,
         count(DISTINCT (event_start, instrument)) FILTER (NOT bad) AS fresh FROM batch)"""
ORACLE["load_counts"] = f"""WITH {_LOADED}
SELECT 'dry run' AS step, n AS read, fresh AS inserted, bad AS rejected FROM counts
UNION ALL SELECT 'load', n, fresh, bad FROM counts
UNION ALL SELECT 'again', n, 0, bad FROM counts
UNION ALL SELECT 'table', fresh, 0, 2 * bad FROM counts"""

ORACLE["stored_ids"] = f"""WITH {_LOADED.replace('ordinal % 50 = 0 OR ', '')}
SELECT fresh AS stored, fresh AS ids, fresh AS stamped FROM counts"""

ORACLE["export_csv"] = f"WITH {FLARES} SELECT id, magnitude, instrument FROM flares"

ORACLE["not_a_number"] = f"""WITH {FLARES}
SELECT id, CASE WHEN id % 3 <> 0 THEN xrsb_flux_peak END AS xrsb_flux_peak,
       CASE WHEN id % 5 <> 0 THEN integrated_flux END AS integrated_flux FROM flares"""

ORACLE["poll_landed_documents"] = f"WITH {_MAPPED} SELECT DISTINCT event_start, instrument FROM mapped"

ORACLE["stream_forget_repeats"] = ORACLE["stream_drop_repeats"]

_TWICE = f"""{KEYED}, twice AS (SELECT * FROM incoming UNION ALL SELECT * FROM incoming)"""
ORACLE["insert_null_keys"] = f"""WITH {_TWICE}
SELECT DISTINCT event_start, instrument FROM twice WHERE instrument IS NOT NULL
UNION ALL SELECT event_start, NULL FROM twice WHERE instrument IS NULL"""

ORACLE["concurrent_inserts"] = f"""WITH {_TWICE}
SELECT DISTINCT event_start, instrument FROM twice WHERE instrument IS NOT NULL
UNION ALL SELECT event_start, NULL FROM twice WHERE instrument IS NULL
UNION ALL SELECT event_start, NULL FROM twice WHERE instrument IS NULL AND seq % 3 = 2"""


def _account(step: str, rows: str, held: str) -> str:
    """One row of counts; ``held`` gives the keys that are in the table before."""
    return f"""SELECT '{step}' AS step, count(*) AS read,
       count(*) FILTER (NOT bad AND instrument IS NULL)
         + count(DISTINCT (event_start, instrument)) FILTER (NOT bad AND instrument IS NOT NULL AND NOT there) AS inserted,
       count(DISTINCT (event_start, instrument)) FILTER (NOT bad AND instrument IS NOT NULL AND there) AS held,
       count(*) FILTER (NOT bad AND instrument IS NOT NULL)
         - count(DISTINCT (event_start, instrument)) FILTER (NOT bad AND instrument IS NOT NULL) AS repeated,
       count(*) FILTER (bad) AS rejected
FROM (SELECT *, seq % 50 = 0 AS bad, {held} AS there FROM twice WHERE {rows})"""


_FIRST_KEYS = "(event_start, instrument) IN (SELECT (event_start, instrument) FROM twice WHERE seq % 3 = 0 AND seq % 50 <> 0 AND instrument IS NOT NULL)"
ORACLE["insert_accounts"] = f"""WITH {_TWICE}, steps AS (
{_account("first", "seq % 3 = 0", "false")}
UNION ALL {_account("second", "seq % 2 = 0", _FIRST_KEYS)})
SELECT * FROM steps
UNION ALL SELECT 'second again', * EXCLUDE (step) FROM steps WHERE step = 'second'
UNION ALL SELECT 'stored', sum(inserted)::BIGINT, 0, 0, 0, sum(rejected)::BIGINT FROM steps"""

ORACLE["stored_pages"] = f"""WITH {_LOADED.replace('ordinal % 50 = 0 OR ', '')}, kept AS (
  SELECT event_start, row_number() OVER (ORDER BY event_start DESC) AS n
  FROM (SELECT DISTINCT event_start, instrument FROM batch WHERE NOT bad)),
middle AS (SELECT 10 * (count(*) // 20) AS skipped FROM kept)
SELECT 'first' AS page, CAST(n AS INTEGER) AS place, event_start FROM kept WHERE n <= 10
UNION ALL SELECT 'middle', CAST(n - skipped AS INTEGER), event_start FROM kept, middle WHERE n > skipped AND n <= skipped + 10"""

ORACLE["refresh_rewritten_file"] = ORACLE["sync_array_files"]

ORACLE["refused_documents"] = """WITH told AS (
  SELECT CASE WHEN event_id % 7 = 0 THEN 'document is no array' WHEN event_id % 11 = 0 THEN 'document has no event'
              WHEN event_id % 13 = 0 THEN 'document is no JSON' WHEN event_id % 17 = 0 THEN 'document is empty' END AS what
  FROM events)
SELECT 'landed' AS what, count(*) AS documents FROM told
UNION ALL SELECT 'good', count(*) FILTER (what IS NULL) FROM told
UNION ALL SELECT 'refused', count(what) FROM told
UNION ALL SELECT what, count(*) FROM told WHERE what IS NOT NULL GROUP BY what"""

ORACLE["lookup_feeds"] = f"""WITH lookup AS (
  SELECT CAST(ts AS DATE) AS date, {exact_mean('least(value / 10e0, 9e0)')} AS kp
  FROM events WHERE ts < '2024-01-20' GROUP BY 1),
feed AS (
  SELECT CAST(ts AS DATE) AS date, CAST(floor(arg_max(value, event_id) + 0.5e0) AS INTEGER) AS sn,
         floor(arg_max(value, event_id) FILTER (event_id % 2 = 1) + 0.5e0) / 2e0 AS flux, day(date) % 2 = 0 AS even
  FROM events WHERE ts >= '2024-01-10' GROUP BY 1)
SELECT date, sn AS sunspot_number, flux AS f10_7_flux, CASE WHEN even THEN 1.5e0 ELSE {round2('kp')} END AS kp_index,
       CASE WHEN even THEN 6 WHEN kp IS NOT NULL THEN CAST({kp_to_ap('kp')} AS INTEGER) END AS ap_index,
       CASE WHEN kp IS NULL THEN 'SILSO' END AS source
FROM lookup FULL JOIN feed USING (date)"""
