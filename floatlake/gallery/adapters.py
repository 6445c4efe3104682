"""Float data derived from the test tables, as SQL both Spark and DuckDB run.

Temperatures lie on a grid of 1/128 degree: sums of them are exact in any order, so a
comparison with a mean has one outcome.
"""

LEVELS = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
       CAST(1900000 + l_suppkey AS STRING) AS platform_number,
       CAST(l_suppkey % 7 AS STRING) AS float_serial_no,
       l_orderkey % 4 AS cycle_number,
       make_date(CAST(year(l_shipdate) AS INT), 1, 1) AS juld,
       CASE WHEN l_linenumber = 7 THEN CAST(99999 AS DOUBLE)
            WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_quantity END AS pres,
       CASE WHEN l_partkey % 40 = 0 THEN NULL
            ELSE CAST(28 AS DOUBLE) - l_quantity * (CAST(floor(l_discount * 128) AS DOUBLE) / CAST(128 AS DOUBLE)) END AS temp,
       l_tax AS psal,
       CASE WHEN l_suppkey % 2 = 0 THEN CAST(2 AS DOUBLE) ELSE l_discount END AS pres_error,
       CAST((l_suppkey * 13) % 90 - 50 AS DOUBLE) AS latitude,
       CAST((l_suppkey * 29) % 160 AS DOUBLE) AS longitude,
       CASE WHEN l_linenumber = 3 THEN NULL
            ELSE concat('b', chr(39), l_returnflag, chr(39)) END AS data_centre,
       concat('b', chr(39), CAST(l_linenumber AS STRING), chr(39)) AS pres_qc,
       CASE WHEN l_linestatus = 'O' THEN '20250101052756' ELSE 'bad' END AS date_update,
       l_quantity AS history_start_pres,
       l_quantity AS juld_location_min
FROM lineitem
"""
# Text with numbers and words in one column.
MIXED_LEVELS = f"""
SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN 'low' ELSE concat(' ', CAST(l_linenumber AS STRING)) END AS flag
FROM ({LEVELS}) levels
"""
LEVEL_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
PROFILE_KEYS = ["platform_number", "float_serial_no", "cycle_number", "juld"]

POINTS = """
SELECT c_custkey AS pid,
       CAST((c_custkey * 37) % 361 AS DOUBLE) / 2 - 90 AS lat,
       CASE WHEN c_custkey % 97 = 5 THEN NULL
            ELSE CAST((c_custkey * 91) % 721 AS DOUBLE) / 2 - 180 END AS lon
FROM customer
"""
# Rings of vertices for each nation: a shape with a notch, and every second one with a hole.
POLYGON_VERTICES = " UNION ALL ".join(f"""
SELECT n_nationkey AS prio, n_name AS name, {ring} AS ring, {place} AS place,
       CAST((n_nationkey * 37) % 120 - 60 + ({dlat}) * (3 + n_nationkey % 5) AS DOUBLE) AS lat,
       CAST((n_nationkey * 71) % 280 - 140 + ({dlon}) * (4 + n_nationkey % 7) AS DOUBLE) AS lon
FROM nation WHERE {ring} = 0 OR n_nationkey % 2 = 0""" for ring, shape in enumerate([
    [(-4, -4), (-4, 4), (0, 2), (4, 4), (3, 0), (4, -4)], [(-2, -2), (-2, 1), (1, 1), (1, -2)],
]) for place, (dlat, dlon) in enumerate(shape))
# Identifiers that repeat or are missing; rid tells the rows apart.
POINTS_REPEATED = f"""
SELECT pid AS rid, CASE WHEN pid % 5 = 0 THEN NULL ELSE pid % 7 END AS pid, lat, lon FROM ({POINTS}) points
"""

INDEX_LINES = """
SELECT c_custkey AS line_no,
       CASE WHEN c_custkey % 100 = 1 THEN '# comment'
            WHEN c_custkey % 100 = 2 THEN 'too,few,parts'
            WHEN c_custkey % 100 = 3 THEN '   '
            WHEN c_custkey % 100 = 4 THEN 'FILE,date,latitude,longitude'
       ELSE concat_ws(',',
         CASE WHEN c_custkey % 7 = 6
              THEN concat('x/SBDD', CAST(c_custkey % 300 AS STRING), '_1.nc')
              ELSE concat('aoml/', CAST(1900000 + c_custkey % 300 AS STRING), '/profiles/BD',
                CAST(1900000 + c_custkey % 300 AS STRING), '_', lpad(CAST(c_custkey % 40 AS STRING), 3, '0'), '.nc') END,
         concat('2024', lpad(CAST(CAST((c_custkey % 300 + floor((c_custkey % 300) / 12) + 7 * (floor(c_custkey / 300) % 2)) AS BIGINT) % 12 + 1 AS STRING), 2, '0'), lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0'), '120000'),
         CASE WHEN c_custkey % 50 = 13 THEN 'bad' ELSE CAST((c_custkey * 37) % 90 - 60 AS STRING) END,
         CASE WHEN c_custkey % 50 = 14 THEN '1d' ELSE CAST((c_custkey * 91) % 130 + 20 AS STRING) END,
         CASE WHEN c_custkey % 3 = 0 THEN 'I' WHEN c_custkey % 3 = 1 THEN 'P' ELSE 'A' END,
         '846', 'IF', 'PRES TEMP DOXY', 'RRD', '20240601000000') END AS line
FROM customer
"""

DIRTY = """
SELECT c_custkey AS rn,
       concat(CAST(1900000 + c_custkey % 100 AS STRING), '_Sprof.csv') AS filename,
       CASE WHEN c_custkey % 100 % 3 = 0 THEN 'f/BCG floats/x.csv' ELSE 'f/Non-BCG floats/x.csv' END AS path,
       CASE WHEN c_custkey % 5 = 0 THEN concat('b', chr(39), c_mktsegment, ' ', chr(39))
            WHEN c_custkey % 5 = 1 THEN concat(' b"', c_mktsegment, '"')
            WHEN c_custkey % 5 = 2 THEN 'nan'
            WHEN c_custkey % 5 = 3 THEN '  ' ELSE c_mktsegment END AS project_name,
       CASE WHEN c_custkey % 4 = 0 THEN '2025-04-15 07:34:37.000800256'
            WHEN c_custkey % 4 = 1 THEN '15-04-2025 07:34:37 AM'
            WHEN c_custkey % 4 = 2 THEN '07:34:37' ELSE '2025-04-16' END AS juld,
       CASE WHEN c_custkey % 6 = 0 THEN '20250101052756' ELSE 'bad' END AS date_update,
       CAST(c_custkey % 40 AS STRING) AS cycle_number,
       CAST(NULL AS STRING) AS empty_col
FROM customer
"""

READINGS = """
SELECT event_id,
       CAST(user_id AS STRING) AS float_id, event_type AS parameter_name,
       CAST(CAST(round(value * 100) AS BIGINT) AS STRING) AS value,
       CAST(ts AS DATE) AS juld_date,
       concat_ws(':', lpad(CAST(hour(ts) AS STRING), 2, '0'), lpad(CAST(minute(ts) AS STRING), 2, '0'),
                 lpad(CAST(CAST(floor(second(ts)) AS BIGINT) AS STRING), 2, '0')) AS juld_time
FROM events
"""

METADATA = """
SELECT CAST(c_custkey AS STRING) AS float_id,
       CASE WHEN c_custkey % 11 = 0 THEN 'OTHER' WHEN c_custkey % 13 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN 'BCG' ELSE 'NON-BCG' END AS float_type,
       CAST(c_nationkey AS STRING) AS profiler_type, c_mktsegment AS institution,
       CAST(make_date(2024, CAST(c_custkey % 12 + 1 AS INT), CAST(c_custkey % 28 + 1 AS INT)) AS DATE) AS last_reading_date
FROM customer
WHERE c_acctbal > 0
"""

DIRTY_LATER = """
SELECT s_suppkey AS rn,
       concat(CAST(1900000 + s_suppkey % 150 AS STRING), '_Sprof.csv') AS filename,
       'f/BCG floats/later.csv' AS path,
       s_name AS project_name,
       CASE WHEN s_suppkey % 2 = 0 THEN '2025-05-01 01:02:03' ELSE '2024-05-01 01:02:03' END AS juld,
       'bad' AS date_update,
       CAST(s_nationkey AS STRING) AS cycle_number,
       CAST(NULL AS STRING) AS empty_col
FROM supplier
"""
