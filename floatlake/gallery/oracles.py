"""SQL giving the same rows as the queries, for DuckDB on the same tables."""

from __future__ import annotations

from floatlake.catalog import CSV_NULL_TOKENS, MONTH_CODES, MONTH_NAMES, REGION_BOXES
from floatlake.gallery import adapters as A

_KEYS = "platform_number, float_serial_no, cycle_number, juld"
_DAY = "strftime(juld, '%Y-%m-%d') AS juld"
_VALID = "pres <> 99999 AND pres > -10"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(13)"


def _pair(mode: str) -> str:
    return "pres IS NOT NULL AND temp IS NOT NULL" + (" AND pres >= 0" if mode == "bgc" else "")


def _layers(mode: str, keys: str = _KEYS, source: str = "lv") -> str:
    """CTEs ref (reference temperature) and layer (mixed-layer depth) per key."""
    pair = _pair(mode)
    return f"""
pairs AS (SELECT {keys}, pres, temp FROM {source} WHERE {pair}),
near AS (SELECT {keys}, count(*) AS n, min(pres) AS p0,
                avg(temp) FILTER (WHERE pres <= 10) AS near_temp FROM pairs GROUP BY {keys}),
shallow AS (SELECT {keys}, min(temp) AS t0 FROM pairs JOIN near USING ({keys})
            WHERE pres = p0 GROUP BY {keys}),
ref AS (SELECT {keys}, coalesce(near_temp, t0) AS ref FROM near JOIN shallow USING ({keys}) WHERE n >= 3),
layer AS (SELECT {keys}, min(pres) AS mixed_layer_depth_m FROM pairs JOIN ref USING ({keys})
          WHERE abs(temp - ref) >= 0.2::DOUBLE GROUP BY {keys})"""


def _profile_metrics() -> str:
    return f"""WITH lv AS ({A.LEVELS}), {_layers('bgc')},
g AS (SELECT {_KEYS}, count(*) AS row_count, count(*) FILTER (WHERE {_VALID}) AS n_levels,
  avg(temp) FILTER (WHERE pres BETWEEN 0 AND 20) AS surface_temp_c,
  min(pres) FILTER (WHERE pres >= 0) AS min_depth_m, max(pres) FILTER (WHERE pres >= 0) AS max_depth_m,
  avg(pres) FILTER (WHERE pres >= 0) AS avg_depth_m FROM lv GROUP BY {_KEYS})
SELECT platform_number, float_serial_no, cycle_number, {_DAY}, row_count, n_levels, surface_temp_c,
  mixed_layer_depth_m, min_depth_m, max_depth_m, avg_depth_m FROM g LEFT JOIN layer USING ({_KEYS})"""


def _mixed_layer(mode: str) -> str:
    return f"""WITH lv AS ({A.LEVELS}), {_layers(mode)},
g AS (SELECT DISTINCT {_KEYS} FROM lv)
SELECT platform_number, float_serial_no, cycle_number, {_DAY}, mixed_layer_depth_m
FROM g LEFT JOIN layer USING ({_KEYS})"""


def _depth(mode: str) -> str:
    usable = "pres >= 0" + (" AND pres <= 12000" if mode == "core" else "")
    return f"""WITH lv AS ({A.LEVELS})
SELECT platform_number, float_serial_no, cycle_number, {_DAY},
  min(pres) FILTER (WHERE {usable}) AS min_depth_m, max(pres) FILTER (WHERE {usable}) AS max_depth_m,
  avg(pres) FILTER (WHERE {usable}) AS avg_depth_m FROM lv GROUP BY {_KEYS}"""


_ORDER = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
_COUNTED = f"""lv AS ({A.LEVELS}),
counted AS (SELECT *, count(*) FILTER (WHERE {_VALID}) OVER (PARTITION BY {_KEYS}) AS n_levels FROM lv)"""


def _first(column: str) -> str:
    return f"arg_min({column}, {_ORDER}) FILTER (WHERE {column} IS NOT NULL)"


_BARE = "substr({0}, 3, length({0}) - 3)"


def _summary_core() -> str:
    keys = "platform_number, float_serial_no, n_levels, juld"
    centre, qc = _BARE.format("data_centre"), _BARE.format("pres_qc")
    stamp = "CASE WHEN date_update = '20250101052756' THEN '2025-01-01' ELSE date_update END"
    return f"""WITH {_COUNTED}, {_layers('core', keys, 'counted')},
g AS (SELECT {keys}, count(*) AS row_count, {_first('cycle_number')} AS cycle_number,
  avg(temp) FILTER (WHERE pres BETWEEN 0 AND 20) AS surface_temp_avg_c,
  min(pres) FILTER (WHERE pres BETWEEN 0 AND 12000) AS min_depth_m,
  max(pres) FILTER (WHERE pres BETWEEN 0 AND 12000) AS max_depth_m,
  avg(pres) FILTER (WHERE pres BETWEEN 0 AND 12000) AS avg_depth_m,
  avg(pres) AS pres, {_first('temp')} AS temp, {_first('psal')} AS psal,
  min(pres_error) AS e0, max(pres_error) AS e1, avg(pres_error) AS e2,
  {_first('latitude')} AS latitude, {_first('longitude')} AS longitude,
  {_first(centre).replace(f'FILTER (WHERE {centre}', 'FILTER (WHERE data_centre')} AS data_centre,
  {_first(qc)} AS pres_qc, {_first(stamp)} AS date_update,
  min(history_start_pres) AS h0, max(history_start_pres) AS h1,
  min(juld_location_min) AS j0, max(juld_location_min) AS j1, avg(juld_location_min) AS j2
  FROM counted GROUP BY {keys})
SELECT platform_number, float_serial_no, n_levels, strftime(juld, '%Y-%m-%d') AS date, row_count, cycle_number,
  surface_temp_avg_c, mixed_layer_depth_m, min_depth_m, max_depth_m, avg_depth_m, pres, temp, psal,
  round(CASE WHEN e0 = e1 THEN e0 END, 9) AS pres_error, CASE WHEN e0 <> e1 THEN e0 END AS pres_error_min,
  CASE WHEN e0 <> e1 THEN e1 END AS pres_error_max, round(CASE WHEN e0 <> e1 THEN e2 END, 9) AS pres_error_mean,
  latitude, longitude, data_centre, pres_qc, date_update,
  CASE WHEN h0 = h1 THEN h0 END AS history_start_pres, CASE WHEN h0 <> h1 THEN h0 END AS history_start_pres_min,
  CASE WHEN h0 <> h1 THEN h1 END AS history_start_pres_max,
  CASE WHEN j0 = j1 THEN j0 END AS juld_location_min, j0 AS juld_location_min_min, j1 AS juld_location_min_max,
  CASE WHEN j0 <> j1 THEN j2 END AS juld_location_min_mean
FROM g LEFT JOIN layer USING ({keys})"""


def _boxes() -> str:
    rows = ", ".join(
        f"({i}, '{name.replace(chr(39), chr(39) * 2)}', {a}, {b}, {c}, {d})"
        for i, (name, a, b, c, d) in enumerate(REGION_BOXES)
    )
    return f"boxes(prio, name, lat0, lat1, lon0, lon1) AS (VALUES {rows})"


def _regions(mode: str, source: str, key: str) -> str:
    """CTE tagged(key, region)."""
    lt = "<=" if mode == "closed" else "<"
    unknown = "Unknown" if mode == "closed" else "Unknown Region"
    return f"""{_boxes()},
tagged AS (SELECT {key}, coalesce(arg_min(name, prio), '{unknown}') AS region FROM {source}
  LEFT JOIN boxes ON lat0 {lt} lat AND lat {lt} lat1 AND lon0 {lt} lon AND lon {lt} lon1 GROUP BY {key})"""


_OCEAN_BOXES = """CASE WHEN lat IS NULL OR lon IS NULL THEN 'Unknown'
  WHEN lat BETWEEN -60 AND 30 AND lon BETWEEN 20 AND 147 THEN 'Indian Ocean'
  WHEN lat BETWEEN -60 AND 70 AND (lon >= 120 OR lon <= -70) THEN 'Pacific Ocean'
  WHEN lat BETWEEN -70 AND 80 AND lon BETWEEN -70 AND 20 THEN 'Atlantic Ocean'
  WHEN lat BETWEEN 65 AND 90 AND lon BETWEEN -180 AND 180 THEN 'Arctic Ocean'
  WHEN lat BETWEEN -90 AND -60 AND lon BETWEEN -180 AND 180 THEN 'Southern Ocean' ELSE 'Unknown' END"""
_OCEAN_CHAIN = """CASE WHEN lat IS NULL OR lon IS NULL THEN 'Unknown Ocean'
  WHEN lat >= 65 THEN 'Arctic Ocean' WHEN lat <= -60 THEN 'Southern Ocean'
  WHEN lon BETWEEN -70 AND 20 THEN 'Atlantic Ocean' WHEN lon BETWEEN 20 AND 147 THEN 'Indian Ocean'
  WHEN lon >= 120 OR lon <= -70 THEN 'Pacific Ocean' ELSE 'Unknown Ocean' END"""


def _summary_core_tagged() -> str:
    keys = "platform_number, float_serial_no, n_levels, juld"
    return f"""WITH {_COUNTED},
g AS (SELECT {keys}, count(*) AS row_count, {_first('latitude')} AS lat, {_first('longitude')} AS lon
  FROM counted GROUP BY {keys}), {_regions('open', 'g', keys)}
SELECT platform_number, float_serial_no, n_levels, strftime(juld, '%Y-%m-%d') AS date, row_count,
  region AS avg_region, {_OCEAN_CHAIN} AS ocean FROM g JOIN tagged USING ({keys})"""


def _summary_bgc() -> str:
    keys = _KEYS
    centre = _BARE.format("data_centre")
    return f"""WITH {_COUNTED}, {_layers('bgc')},
g AS (SELECT {keys}, any_value(n_levels) AS n_levels,
  avg(temp) FILTER (WHERE pres BETWEEN 0 AND 20) AS surface_temp_c,
  min(pres) FILTER (WHERE pres >= 0) AS min_depth_m, max(pres) FILTER (WHERE pres >= 0) AS max_depth_m,
  avg(pres) FILTER (WHERE pres >= 0) AS avg_depth_m,
  {_first('latitude')} AS lat, {_first('longitude')} AS lon,
  avg(pres) AS pres, avg(temp) AS temp, round(avg(psal), 9) AS psal, round(avg(pres_error), 9) AS pres_error,
  avg(latitude) AS latitude, avg(longitude) AS longitude,
  arg_min({centre}, {_ORDER}) FILTER (WHERE data_centre IS NOT NULL) AS data_centre,
  arg_min({_BARE.format('pres_qc')}, {_ORDER}) FILTER (WHERE pres_qc IS NOT NULL) AS pres_qc,
  avg(TRY_CAST({_BARE.format('pres_qc')} AS DOUBLE)) AS pres_qc_mean, {_first('date_update')} AS date_update,
  avg(history_start_pres) AS history_start_pres, avg(juld_location_min) AS juld_location_min
  FROM counted GROUP BY {keys}), {_regions('closed', 'g', keys)}
SELECT platform_number, float_serial_no, cycle_number, n_levels, {_DAY}, surface_temp_c, mixed_layer_depth_m,
  min_depth_m, max_depth_m, avg_depth_m, region AS avg_region, {_OCEAN_BOXES} AS ocean,
  lat AS first_latitude, lon AS first_longitude, pres, temp, psal, pres_error, latitude, longitude,
  data_centre, pres_qc, pres_qc_mean, date_update, history_start_pres, juld_location_min
FROM g LEFT JOIN layer USING ({keys}) JOIN tagged USING ({keys})"""


def _polygons(border: bool) -> str:
    inside = "odd OR on_edge" if border else "odd AND NOT on_edge"
    return f"""WITH p AS ({A.POINTS}), v AS ({A.POLYGON_VERTICES}), e AS (
  SELECT prio, name, lat AS y1, lon AS x1, coalesce(lead(lat) OVER ring, first_value(lat) OVER ring) AS y2,
    coalesce(lead(lon) OVER ring, first_value(lon) OVER ring) AS x2
  FROM v WINDOW ring AS (PARTITION BY prio, v.ring ORDER BY place)
), met AS (
  SELECT pid, prio, name, count(*) FILTER (WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1) % 2 = 1 AS odd,
    bool_or((x2 - x1) * (lat - y1) = (y2 - y1) * (lon - x1) AND lat BETWEEN least(y1, y2) AND greatest(y1, y2)
      AND lon BETWEEN least(x1, x2) AND greatest(x1, x2)) AS on_edge
  FROM p CROSS JOIN e WHERE lon IS NOT NULL GROUP BY pid, prio, name
), first_hit AS (SELECT pid, arg_min(name, prio) AS name FROM met WHERE {inside} GROUP BY pid)
SELECT p.pid, coalesce(name, 'Unknown') AS region FROM p LEFT JOIN first_hit f ON p.pid = f.pid"""


def _region(mode: str) -> str:
    return f"WITH p AS ({A.POINTS}), {_regions(mode, 'p', 'pid')} SELECT pid, region FROM tagged"


def _ocean(case: str) -> str:
    return f"SELECT pid, {case} AS ocean FROM ({A.POINTS})"


# --- index ----------------------------------------------------------------------

_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_INDEX = f"""data AS (SELECT line_no, trim(line) AS line, string_split(trim(line), ',') AS f
  FROM ({A.INDEX_LINES}) WHERE line NOT LIKE '#%' AND lower(line) NOT LIKE '%file,date,latitude%' AND trim(line) <> ''),
judged AS (SELECT *, CASE WHEN len(f) < 10 THEN 'too few fields'
  WHEN NOT regexp_matches(f[3], '{_NUMBER}') THEN 'latitude is not a number'
  WHEN NOT regexp_matches(f[4], '{_NUMBER}') THEN 'longitude is not a number' END AS reason FROM data),
parsed AS (SELECT line_no, f[1] AS file, f[2] AS date, CAST(f[3] AS DOUBLE) AS latitude, CAST(f[4] AS DOUBLE) AS longitude,
  f[5] AS ocean, f[6] AS profiler_type, f[7] AS institution, f[8] AS parameters, f[9] AS parameter_data_mode,
  f[10] AS date_update,
  coalesce(nullif(regexp_extract(f[1], '(?:^|/)([0-9]{{7,}})(?:/|$)', 1), ''),
    [y FOR y IN [replace(replace(replace(replace(x, 'BD', ''), 'SD', ''), 'AD', ''), 'RD', '')
      FOR x IN string_split(regexp_extract(f[1], '([^/]*)$', 1), '_')] IF regexp_matches(y, '^[0-9]+$')][1]) AS platform_number
  FROM judged WHERE reason IS NULL)"""


def _months(first: int, *rest: int) -> str:
    listed = ", ".join(str(m) for m in (first, *rest))
    return (f"ocean = 'I' AND substr(date, 1, 4) = '2024' AND CAST(substr(date, 5, 2) AS INT) IN ({listed})")


_HALF = _months(*range(1, 7))
_SOME = _months(4, 8, 12)


def _new_platforms() -> str:
    return (f"SELECT platform_number FROM parsed WHERE {_SOME} AND platform_number IS NOT NULL "
            f"EXCEPT SELECT platform_number FROM parsed WHERE {_HALF}")


# --- cleaning -------------------------------------------------------------------

_DIRTY = f"d AS ({A.DIRTY})"


def _clean(c: str) -> str:
    t = f"trim({c}, {_BLANK})"
    return (f"CASE WHEN ({t} LIKE 'b''%' AND {t} LIKE '%''') OR ({t} LIKE 'b\"%' AND {t} LIKE '%\"') "
            f"THEN substr({t}, 3, length({t}) - 3) ELSE {t} END")


_TOKENS = ", ".join("'" + t + "'" for t in CSV_NULL_TOKENS)


def _loaded(c: str) -> str:
    t = f"trim({c}, {_BLANK})"
    return f"CASE WHEN {c} NOT IN ({_TOKENS}) AND {t} NOT IN ('nan', 'NaN', '', 'None') THEN {t} END"


def _split(c: str) -> tuple[str, str]:
    parts = f"string_split({c}, ' ')"
    date = f"CASE WHEN len({parts}) >= 2 THEN {parts}[1] WHEN {c} NOT LIKE '%:%' THEN {c} END"
    time = (f"CASE WHEN len({parts}) >= 2 THEN array_to_string({parts}[2:], ' ') "
            f"WHEN {c} LIKE '%:%' THEN {c} END")
    return date, time


_DATE, _TIME = _split("juld")


def _read_date(c: str) -> str:
    t = f"substr({c}, 1, 10)"
    return f"coalesce(TRY_STRPTIME({t}, '%Y-%m-%d'), TRY_STRPTIME({t}, '%d-%m-%Y'))"


def _cleaned(adapter: str, name: str) -> str:
    """CTE of the cleaned table with float id, parsed date and time."""
    return f"""{name} AS (SELECT rn, filename, path, nullif({_clean("CASE WHEN trim(project_name) NOT IN ('', 'nan') THEN project_name END")}, '') AS project_name,
  date_update, cycle_number, {_DATE} AS jd, {_TIME} AS jt, replace(filename, '_Sprof.csv', '') AS float_id FROM ({adapter}))"""


def _metadata(source: str, out: str) -> str:
    """CTE of metadata rows per file and float."""
    return f"""{out} AS (SELECT float_id, filename AS csv_filename,
  arg_min(CASE WHEN path LIKE '%BCG%' AND path NOT LIKE '%Non-BCG%' THEN 'BCG' ELSE 'NON-BCG' END, rn) AS float_type,
  CAST(NULL AS VARCHAR) AS profiler_type, CAST(NULL AS VARCHAR) AS institution,
  list(trim(project_name) ORDER BY rn)[1] AS project_name,
  CAST(NULL AS VARCHAR) AS wmo_inst_type, CAST(NULL AS VARCHAR) AS platform_type,
  strftime(max({_read_date('jd')}), '%Y-%m-%d') AS last_reading_date,
  concat_ws('|', CASE WHEN count(project_name) > 0 THEN 'project_name' END, 'date_update', 'cycle_number', 'juld_date', 'juld_time') AS all_columns
  FROM {source} GROUP BY float_id, filename)"""


_META_COLUMNS = ("float_id, float_type, profiler_type, institution, project_name, wmo_inst_type, platform_type, "
                 "all_columns, csv_filename, last_reading_date")
_META = f"WITH {_cleaned(A.DIRTY, 'c')}, {_metadata('c', 'm')}"


def _months_case(values: list[str], unknown: str) -> str:
    branches = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values, 1))
    return f"CASE m {branches} ELSE '{unknown}' END"


_ORDER_DAY = "strftime(o_orderdate, '%Y%m%d')"


def _share(source: str, label: str) -> str:
    return (f"SELECT {label}, count(*) AS n, count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER () AS percent "
            f"FROM {source} GROUP BY {label}")


_JULD = """(SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN TIMESTAMP '1950-01-01 00:00:00'
  + to_microseconds(CAST((27000 + o_orderkey / CAST(64 AS DOUBLE)) * 86400000000 AS BIGINT)) END AS ts FROM orders)"""


def oracles() -> dict[str, str]:
    number = _NUMBER
    return {
        "profile_metrics": _profile_metrics(),
        "n_levels": f"WITH {_COUNTED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, platform_number, n_levels FROM counted",
        "n_levels_range": f"WITH {_COUNTED} SELECT min(n_levels) AS min_n_levels, max(n_levels) AS max_n_levels FROM counted",
        "surface_temp": f"WITH lv AS ({A.LEVELS}) SELECT platform_number, float_serial_no, cycle_number, {_DAY}, avg(temp) FILTER (WHERE pres BETWEEN 0 AND 20) AS surface_temp_c FROM lv GROUP BY {_KEYS}",
        "mixed_layer_depth_bgc": _mixed_layer("bgc"),
        "mixed_layer_depth_core": _mixed_layer("core"),
        "depth_stats_bgc": _depth("bgc"),
        "depth_stats_core": _depth("core"),
        "summary_core": _summary_core(),
        "summary_core_tagged": _summary_core_tagged(),
        "summary_bgc": _summary_bgc(),
        "summary_bgc_mixed": f"""WITH levels AS ({A.MIXED_LEVELS})
SELECT {_KEYS.replace('juld', "strftime(juld, '%Y-%m-%d') AS juld")}, arg_min(trim(flag), {_ORDER}) AS flag,
  avg(TRY_CAST(trim(flag) AS DOUBLE)) AS flag_mean FROM levels
WHERE platform_number IS NOT NULL AND float_serial_no IS NOT NULL AND cycle_number IS NOT NULL AND juld IS NOT NULL
GROUP BY {_KEYS}""",
        "region_closed": _region("closed"),
        "region_open": _region("open"),
        "region_grid": _region("closed"),
        "region_grid_shuffled": _region("closed"),
        "region_polygons": _polygons(False),
        "region_polygons_shuffled": _polygons(False),
        "region_polygons_border": _polygons(True),
        "region_grid_duplicates": f"""WITH p AS ({A.POINTS_REPEATED}), {_regions('closed', 'p', 'rid')}
SELECT form, pid, lat, lon, region FROM p JOIN tagged USING (rid), (VALUES ('broadcast'), ('shuffled')) forms(form)""",
        "ocean_boxes": _ocean(_OCEAN_BOXES),
        "ocean_chain": _ocean(_OCEAN_CHAIN),
        "region_share": f"WITH p AS ({A.POINTS}), {_regions('open', 'p', 'pid')} {_share('tagged', 'region')}",
        "ocean_share": _share(f"({_ocean(_OCEAN_CHAIN)})", "ocean"),
        "index_parse": f"WITH {_INDEX} SELECT * FROM parsed",
        "index_rejects": f"WITH {_INDEX} SELECT line_no, line, reason FROM judged WHERE reason IS NOT NULL",
        "index_filter": f"WITH {_INDEX} SELECT line_no, file, date, ocean, platform_number FROM parsed WHERE {_HALF}",
        "platform_first": f"WITH {_INDEX} SELECT platform_number, line_no, file, date FROM parsed WHERE {_months(*range(1, 13))} QUALIFY row_number() OVER (PARTITION BY platform_number ORDER BY line_no) = 1",
        "platform_union": f"WITH {_INDEX} SELECT DISTINCT platform_number FROM parsed WHERE (({_HALF}) OR ({_SOME})) AND platform_number IS NOT NULL",
        "platform_new": f"WITH {_INDEX} {_new_platforms()}",
        "platform_sample": f"WITH {_INDEX} SELECT platform_number FROM ({_new_platforms()}) ORDER BY platform_number LIMIT 10",
        "flatten_levels": """SELECT vec_id, CAST(i AS INTEGER) AS level_idx, CAST(label AS BIGINT) AS cycle_number,
  CAST(i * 5 AS DOUBLE) AS pres, CASE WHEN i < 60 THEN CAST(embedding[i + 1] AS DOUBLE) END AS psal,
  CAST(embedding[i + 1] AS DOUBLE) AS temp, 'float profile' AS data_type
FROM (SELECT *, unnest(range(len(embedding))) AS i FROM embeddings)""",
        "flatten_first_last": """SELECT o_orderkey, CAST(i AS INTEGER) AS level_idx,
  trim(string_split(o_orderpriority, '-')[1]) AS calib, o_orderstatus AS data_centre, o_totalprice AS deep, '' AS empty_calib,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE trim(string_split(o_orderpriority, '-')[-1]) END AS history_action,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(7 AS DOUBLE) END AS history_start_pres,
  trim(string_split(o_orderpriority, '-')[1]) AS parameter_data_mode,
  CASE WHEN i = 0 THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS pres
FROM (SELECT *, unnest(range(2)) AS i FROM orders)""",
        "flatten_discovered": """SELECT o_orderkey AS key, place AS level_idx, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority || 'x' END AS clerk,
  CASE WHEN o_orderkey % 2 = 1 AND place = 0 THEN o_totalprice END AS doxy,
  CASE WHEN o_orderkey % 2 = 0 THEN [o_orderstatus, o_orderpriority][place + 1] END AS flag,
  CASE WHEN o_orderkey % 2 = 0 AND place = 0 THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS pres
FROM orders, (VALUES (0), (1)) places(place) WHERE o_orderkey % 2 = 0 OR place = 0""",
        "clean_bytes": f"WITH {_DIRTY} SELECT rn, {_clean('project_name')} AS project_name FROM d",
        "null_tokens": f"WITH {_DIRTY} SELECT rn, CASE WHEN project_name NOT IN ({_TOKENS}) THEN project_name END AS as_read, {_loaded('project_name')} AS as_loaded FROM d",
        "split_datetime": f"WITH {_DIRTY} SELECT rn, {_DATE} AS juld_date, {_TIME} AS juld_time FROM d",
        "compact_date": f"WITH {_DIRTY} SELECT rn, CASE WHEN length(date_update) = 14 THEN coalesce(strftime(TRY_STRPTIME(date_update, '%Y%m%d%H%M%S'), '%Y-%m-%d'), date_update) ELSE date_update END AS date_update FROM d",
        "loader_times": f"WITH {_DIRTY} SELECT rn, strftime({_read_date(_DATE)}, '%Y-%m-%d') AS reading_date, substr({_TIME}, 1, 8) AS reading_time, CASE WHEN regexp_matches(juld, '^[0-9]{{4}}-') THEN substr(juld, 1, 10) ELSE '2025-01-01' END AS date_or_default FROM d",
        "juld_ts": f"SELECT o_orderkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS juld, strftime(ts, '%H:%M:%S') AS juld_time FROM {_JULD}",
        "strict_number": f"SELECT line_no, CASE WHEN regexp_matches(f[3], '{number}') THEN TRY_CAST(f[3] AS DOUBLE) END AS latitude, CASE WHEN regexp_matches(f[4], '{number}') THEN TRY_CAST(f[4] AS DOUBLE) END AS longitude FROM (SELECT line_no, string_split(line, ',') AS f FROM ({A.INDEX_LINES}))",
        "filename_parts": f"""SELECT o_orderkey, CASE WHEN dated THEN {_ORDER_DAY} ELSE 'undated' END || '_prof.csv' AS filename,
  'BCG' AS float_type, CAST(year(o_orderdate) AS DOUBLE) AS folder_year, strftime(o_orderdate, '%B') AS month_name,
  CAST(month(o_orderdate) AS DOUBLE) AS month_number,
  CASE WHEN dated THEN CAST(year(o_orderdate) AS DOUBLE) END AS file_year,
  CASE WHEN dated THEN CAST(month(o_orderdate) AS DOUBLE) END AS file_month,
  CASE WHEN dated THEN CAST(day(o_orderdate) AS DOUBLE) END AS file_day
FROM (SELECT *, o_orderkey % 10 <> 0 AS dated FROM orders)""",
        "month_names": f"SELECT o_orderkey, {_months_case(MONTH_NAMES, 'Unknown')} AS month_name, {_months_case(MONTH_CODES, 'UNK')} AS month_code FROM (SELECT o_orderkey, month(o_orderdate) + CASE WHEN o_orderkey % 20 = 0 THEN 12 ELSE 0 END AS m FROM orders)",
        "month_routing": "SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'rejected' ELSE strftime(o_orderdate, '%Y/%B') END AS target, count(*) AS n FROM orders GROUP BY 1",
        "drop_null_columns": f"WITH {_DIRTY} SELECT rn, filename, path, project_name, juld, date_update, cycle_number FROM d",
        "clean_table": f"WITH {_cleaned(A.DIRTY, 'c')} SELECT rn, filename, path, project_name, date_update, cycle_number, jd AS \"juld_DATE\", jt AS \"juld_TIME\" FROM c",
        "mixed_union": f"""SELECT rn, project_name, CAST(cycle_number AS BIGINT) AS cycle_number, CAST(NULL AS VARCHAR) AS line, CAST(NULL AS DOUBLE) AS temp_error, filename FROM ({A.DIRTY})
UNION ALL SELECT line_no, NULL, NULL, line, CAST(line_no AS DOUBLE) + 0.5, 'x.txt' FROM ({A.INDEX_LINES})""",
        "readings_unpivot": f"""WITH {_cleaned(A.DIRTY, 'c')},
w AS (SELECT *, strftime({_read_date('jd')}, '%Y-%m-%d') AS juld_date, substr(jt, 1, 8) AS juld_time FROM c),
u AS (SELECT float_id, juld_date, juld_time, 'project_name' AS parameter_name, trim(project_name) AS value FROM w
 UNION ALL SELECT float_id, juld_date, juld_time, 'date_update', date_update FROM w
 UNION ALL SELECT float_id, juld_date, juld_time, 'cycle_number', cycle_number FROM w
 UNION ALL SELECT float_id, juld_date, juld_time, 'juld_date', jd FROM w
 UNION ALL SELECT float_id, juld_date, juld_time, 'juld_time', jt FROM w)
SELECT float_id, parameter_name, value, juld_date, juld_time FROM u WHERE value IS NOT NULL AND value <> ''""",
        "float_metadata": f"{_META} SELECT {_META_COLUMNS} FROM m",
        "metadata_upsert": f"""WITH {_cleaned(A.DIRTY, 'c')}, {_metadata('c', 'm')},
{_cleaned(A.DIRTY_LATER, 'c2')}, {_metadata('c2', 'm2')}
SELECT coalesce(m.float_id, m2.float_id) AS float_id, CASE WHEN m.float_id IS NULL THEN m2.float_type ELSE m.float_type END AS float_type,
  m.profiler_type, m.institution, CASE WHEN m.float_id IS NULL THEN m2.project_name ELSE m.project_name END AS project_name,
  m.wmo_inst_type, m.platform_type, CASE WHEN m2.float_id IS NULL THEN m.all_columns ELSE m2.all_columns END AS all_columns,
  CASE WHEN m.float_id IS NULL THEN m2.csv_filename ELSE m.csv_filename END AS csv_filename,
  CASE WHEN m2.float_id IS NULL THEN m.last_reading_date ELSE m2.last_reading_date END AS last_reading_date
FROM m FULL JOIN m2 ON m.float_id = m2.float_id""",
        "float_ids_by_file": """SELECT o_orderkey, CASE WHEN first_key % 3 = 0 THEN 'F' || CAST(bucket AS VARCHAR) ELSE CAST(first_cust AS VARCHAR) END AS float_id
FROM (SELECT o_orderkey, o_custkey % 50 AS bucket, min(o_orderkey) OVER w AS first_key,
  first_value(o_custkey) OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS first_cust
  FROM orders WINDOW w AS (PARTITION BY o_custkey % 50))""",
        "readings_count": f"SELECT count(*) AS n FROM ({A.READINGS})",
        "readings_by_float": f"SELECT event_id, float_id, parameter_name, value, strftime(juld_date, '%Y-%m-%d') AS juld_date, juld_time FROM ({A.READINGS}) WHERE float_id = '42'",
        "readings_by_parameter_month": f"SELECT event_id, float_id, parameter_name, value, strftime(juld_date, '%Y-%m-%d') AS juld_date, juld_time FROM ({A.READINGS}) WHERE parameter_name = 'purchase' AND juld_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
        "floats_by_attribute": f"SELECT float_id, float_type, profiler_type, institution, strftime(last_reading_date, '%Y-%m-%d') AS last_reading_date FROM ({A.METADATA}) WHERE float_type = 'BCG' AND institution = 'BUILDING' AND last_reading_date >= DATE '2024-03-01'",
        "floats_with_column": f"{_META} SELECT {_META_COLUMNS} FROM m WHERE list_contains(string_split(all_columns, '|'), 'project_name')",
        "floats_with_columns": f"""WITH {_cleaned(A.DIRTY, 'c')}, {_metadata('c', 'm')},
{_cleaned(A.DIRTY_LATER, 'c2')}, {_metadata('c2', 'm2')}, now AS (
  SELECT coalesce(m.float_id, m2.float_id) AS float_id, CASE WHEN m2.float_id IS NULL THEN m.all_columns ELSE m2.all_columns END AS all_columns
  FROM m FULL JOIN m2 ON m.float_id = m2.float_id
)
SELECT float_id FROM now WHERE list_contains(string_split(all_columns, '|'), 'project_name') AND list_contains(string_split(all_columns, '|'), 'date_update')""",
        "quality_violations": f"""WITH m AS ({A.METADATA}), r AS ({A.READINGS})
SELECT 'duplicate' AS rule, float_id FROM m WHERE float_type = 'BCG'
UNION ALL SELECT 'type', float_id FROM m WHERE float_type IS NULL OR float_type NOT IN ('BCG', 'NON-BCG')
UNION ALL SELECT 'missing', float_id FROM r WHERE parameter_name = 'error'""",
        "orphan_readings": f"SELECT event_id, float_id FROM ({A.READINGS}) r WHERE NOT EXISTS (SELECT 1 FROM ({A.METADATA}) m WHERE m.float_id = r.float_id)",
        "cascade_delete": f"""WITH m AS ({A.METADATA}), r AS ({A.READINGS}), gone AS (SELECT float_id FROM m WHERE float_type = 'OTHER')
SELECT 'reading' AS kind, CAST(event_id AS VARCHAR) AS key FROM r WHERE float_id NOT IN (SELECT float_id FROM gone)
UNION ALL SELECT 'float', float_id FROM m WHERE float_id NOT IN (SELECT float_id FROM gone)""",
        "load_counters": f"WITH {_DIRTY} SELECT count(DISTINCT filename) AS files, count(*) AS rows, count(*) FILTER (WHERE path NOT LIKE '%Non-BCG%') AS bgc_rows, count(*) FILTER (WHERE path LIKE '%Non-BCG%') AS core_rows FROM d",
        "average_columns": f"{_META} SELECT sum(len(string_split(all_columns, '|'))) // count(*) AS average_columns FROM m",
        "reading_rejects": f"SELECT CASE WHEN parameter_name = 'error' THEN 'parameter_name is missing' ELSE 'kept' END AS outcome, count(*) AS n FROM ({A.READINGS}) GROUP BY 1",
        "new_files": "SELECT DISTINCT url AS path FROM pages WHERE url NOT LIKE 'http://%'",
    }
