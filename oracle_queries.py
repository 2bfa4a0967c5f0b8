"""DuckDB SQL that gives the expected result of every registered query."""

from __future__ import annotations

_EVENTS_RAW = """
raw_visits AS (
  SELECT user_id AS username,
         CASE event_id % 3 WHEN 0 THEN replace(n_name, '_', ' ')
                           WHEN 1 THEN '  ' || replace(n_name, '_', '   ') || ' '
                           ELSE replace(n_name, '_', ' ') || '.,' END AS office_raw,
         CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN 'Pending'
                         WHEN 'view' THEN 'Development & Construction' ELSE event_type END AS lob_raw,
         n_name AS city, CAST(ts AS DATE) AS logon_date, dayname(ts) AS dow,
         c_mktsegment AS job, event_id AS seq
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
raw_desks AS (
  SELECT replace(n_name, '_', ' ') AS office_raw, s_name AS address,
         CAST(floor(s_acctbal / 500) AS BIGINT) AS desks_raw,
         CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey * 100 END AS rsf,
         CAST(DATE '2024-01-01' + CAST(s_suppkey % 4 AS INTEGER) * 7 AS DATE) AS date,
         CASE s_suppkey % 10 WHEN 9 THEN 'No' WHEN 4 THEN ' yes ' ELSE 'Yes' END AS include, s_suppkey AS seq
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
calendar AS (SELECT DATE '2024-01-01' AS first_day, DATE '2027-12-31' AS last_day)"""

_ORDERS_RAW = """
raw_visits AS (
  SELECT o_custkey AS username, replace(n_name, '_', ' ') AS office_raw, c_mktsegment AS lob_raw,
         n_name AS city, CAST(o_orderdate AS DATE) AS logon_date, dayname(o_orderdate) AS dow,
         o_orderpriority AS job, o_orderkey AS seq
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
raw_desks AS (
  SELECT replace(n_name, '_', ' ') AS office_raw, s_name AS address,
         CAST(floor(s_acctbal / 2500) AS BIGINT) AS desks_raw,
         CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey * 100 END AS rsf,
         CAST(DATE '1995-03-01' + to_months(CAST(s_suppkey % 60 AS INTEGER)) AS DATE) AS date,
         CASE s_suppkey % 10 WHEN 9 THEN 'No' WHEN 4 THEN ' yes ' ELSE 'Yes' END AS include, s_suppkey AS seq
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
calendar AS (SELECT DATE '1995-01-01' AS first_day, DATE '2001-12-31' AS last_day)"""

_NORMAL = r"nullif(rtrim(regexp_replace(trim({}), '\s+', ' ', 'g'), '.,;:'), '')"
_KEY = "CAST(strftime({}, '%Y%m%d') AS INTEGER)"

_STEPS = f"""
first_visits AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY username, logon_date, office ORDER BY seq) AS place
    FROM (SELECT *, {_NORMAL.format("office_raw")} AS office FROM raw_visits))
  WHERE place = 1),
visits AS (
  SELECT *, CASE WHEN lob_raw IS NULL OR lob_raw = 'Pending' THEN 'Corporate'
                 WHEN lob_raw = 'Development & Construction' THEN 'Development and Construction'
                 ELSE lob_raw END AS lob
  FROM first_visits),
snaps AS (
  SELECT {_NORMAL.format("office_raw")} AS office, date, seq,
         CAST(CASE WHEN desks_raw > 0 THEN desks_raw END AS INTEGER) AS deskcount
  FROM raw_desks WHERE lower(trim(include)) = 'yes'),
areas AS (
  SELECT office, rsf FROM (
    SELECT {_NORMAL.format("office_raw")} AS office, rsf,
           row_number() OVER (PARTITION BY {_NORMAL.format("office_raw")} ORDER BY date DESC, seq DESC) AS place
    FROM raw_desks WHERE rsf IS NOT NULL)
  WHERE place = 1),
locations AS (
  SELECT CAST(row_number() OVER (ORDER BY office) AS INTEGER) AS location_key, office,
         CAST(coalesce(rsf, 0) AS INTEGER) AS rsf
  FROM (SELECT DISTINCT office FROM visits WHERE office IS NOT NULL) LEFT JOIN areas USING (office)),
lobs AS (
  SELECT CAST(row_number() OVER (ORDER BY lob) AS INTEGER) AS lob_key, lob
  FROM (SELECT DISTINCT lob FROM visits)),
cover AS (
  SELECT first_visit, last_visit, latest_snapshot,
         CAST(least(last_visit, last_day(latest_snapshot)) AS DATE) AS coverage_end
  FROM (SELECT min(logon_date) AS first_visit, max(logon_date) AS last_visit FROM visits),
       (SELECT max(date) AS latest_snapshot FROM snaps)),
win AS (
  SELECT *, greatest(first_visit, first_day) AS grid_start, least(coverage_end, last_day) AS grid_end
  FROM cover, calendar),
days AS (
  SELECT CAST(unnest(generate_series(grid_start, grid_end, INTERVAL 1 DAY)) AS DATE) AS date FROM win),
counts AS (
  SELECT logon_date AS date, office, lob, count(*) AS n FROM visits, win
  WHERE logon_date <= coverage_end AND office IS NOT NULL GROUP BY ALL),
office_counts AS (SELECT date, office, sum(n)::BIGINT AS n FROM counts GROUP BY ALL),
newest AS (
  SELECT office, date, deskcount FROM (
    SELECT *, row_number() OVER (PARTITION BY office, date ORDER BY seq DESC) AS place FROM snaps)
  WHERE place = 1),
grid AS (
  SELECT days.date, location_key, locations.office, coalesce(n, 0) AS n
  FROM days CROSS JOIN locations LEFT JOIN office_counts USING (date, office)),
lob_grid AS (
  SELECT days.date, location_key, locations.office, lob_key, lobs.lob, coalesce(n, 0) AS n
  FROM days CROSS JOIN locations CROSS JOIN lobs LEFT JOIN counts USING (date, office, lob)),
capacity AS (
  SELECT grid.date, grid.location_key, grid.office, grid.n, newest.deskcount
  FROM grid ASOF LEFT JOIN newest ON grid.office = newest.office AND grid.date >= newest.date),
eligible AS (
  SELECT date, week_start, weekdays, isodow(date) < 6 AND weekdays >= 3 AS eligible FROM (
    SELECT date, CAST(date_trunc('week', date) AS DATE) AS week_start,
           count(*) FILTER (isodow(date) < 6)
             OVER (PARTITION BY date_trunc('week', date), month(date)) AS weekdays
    FROM days)),
top3 AS (
  SELECT office, week_start, date, n, day_rank FROM (
    SELECT office, week_start, grid.date, n,
           row_number() OVER (PARTITION BY office, week_start ORDER BY n DESC, grid.date) AS day_rank
    FROM grid JOIN eligible ON grid.date = eligible.date WHERE eligible)
  WHERE day_rank <= 3),
agg_fact AS (
  SELECT {_KEY.format("c.date")} AS date_key, location_key, c.date AS date, c.office AS office_location,
         CAST(year(c.date) AS INTEGER) AS year, CAST(month(c.date) AS INTEGER) AS month,
         isodow(c.date) >= 6 AS is_weekend, c.n AS attendance_count, deskcount,
         CASE WHEN deskcount > 0 THEN CAST(c.n AS DOUBLE) / deskcount END AS occupancy_rate,
         top3.date IS NOT NULL AS is_hybrid_day
  FROM capacity c LEFT JOIN top3 ON top3.office = c.office AND top3.date = c.date),
lob_fact AS (
  SELECT a.date_key, a.location_key, l.lob_key, a.date, a.office_location, l.lob AS line_of_business,
         a.year, a.month, a.is_weekend, l.n AS attendance_count, a.deskcount,
         CASE WHEN a.deskcount > 0 THEN CAST(l.n AS DOUBLE) / a.deskcount END AS occupancy_rate,
         a.is_hybrid_day
  FROM agg_fact a JOIN lob_grid l ON l.date = a.date AND l.office = a.office_location)"""


def _sql(body: str, variant: str = "events") -> str:
    raw = _EVENTS_RAW if variant == "events" else _ORDERS_RAW
    return f"WITH {raw.strip()},{_STEPS}\n{body.strip()}"


_VISITS = """
SELECT CAST(1 AS INTEGER) AS username, office AS office_location, lob AS line_of_business,
       city AS city_state_country_region, logon_date, dow AS day_of_week, job AS job_family,
       CAST(year(logon_date) AS INTEGER) AS year, CAST(month(logon_date) AS INTEGER) AS month,
       CAST((day(logon_date) - 1) // 7 + 1 AS INTEGER) AS week_in_month
FROM visits"""

_PAGE_OF_LOBS = """
SELECT 'before' AS stage, lob_raw AS line_of_business, count(*) AS visits FROM first_visits GROUP BY ALL
UNION ALL SELECT 'after', lob, count(*) FROM visits GROUP BY ALL"""

_DIM_DATE = """
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date, strftime(date, '%Y-%m-%d') AS date_string,
       CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
       CAST(weekofyear(date) AS INTEGER) AS week_of_year,
       CAST((day(date) - 1) // 7 + 1 AS INTEGER) AS week_in_month, CAST(day(date) AS INTEGER) AS day,
       CAST(isodow(date) AS INTEGER) AS day_of_week, dayname(date) AS day_name,
       CAST(dayofyear(date) AS INTEGER) AS day_of_year, isodow(date) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders))"""

_SPELLINGS = r"""
SELECT spelled, nullif(rtrim(regexp_replace(trim(spelled), '\s+', ' ', 'g'), '.,;:'), '') AS office_location,
       count(*) AS visits
FROM (SELECT office_raw AS spelled FROM raw_visits) GROUP BY ALL"""

_SUMMARY = """
, f AS (SELECT count(*) AS rows, min(date) AS lo, max(date) AS hi, count(DISTINCT office_location) AS offices,
               count(DISTINCT line_of_business) AS lobs,
               avg(occupancy_rate) FILTER (NOT is_weekend) AS wk, avg(occupancy_rate) FILTER (is_weekend) AS we,
               count(*) FILTER (attendance_count > 0 AND deskcount = 0) AS issues,
               count(*) FILTER (occupancy_rate > 1.0) AS over FROM lob_fact),
a AS (SELECT count(*) AS rows, min(date) AS lo, max(date) AS hi FROM agg_fact),
c AS (SELECT count(*) AS n FROM locations)
SELECT CAST(0 AS INTEGER) AS ord, '== Summary ==' AS line
UNION ALL SELECT 1, format('Fact rows: {:,}; Agg rows: {:,}', f.rows, a.rows) FROM f, a
UNION ALL SELECT 2, 'Fact date range: ' || lo || ' to ' || hi FROM f
UNION ALL SELECT 3, 'Agg date range: ' || lo || ' to ' || hi FROM a
UNION ALL SELECT 4, 'Locations: ' || offices || ' (dim: ' || n || ')' FROM f, c
UNION ALL SELECT 5, 'LOBs: ' || lobs || ' (in fact)' FROM f
UNION ALL SELECT 6, printf('Mean occupancy (weekday): %.3f; (weekend): %.3f', wk, we) FROM f
UNION ALL SELECT 7, format('Rows with attendance>0 and deskcount==0: {:,} (', issues)
                    || printf('%.1f%%)', issues * 100.0 / rows) FROM f
UNION ALL SELECT 8, format('Rows with occupancy_rate > 1.0: {:,} (', over)
                    || printf('%.1f%%)', over * 100.0 / rows) FROM f
UNION ALL SELECT 9, 'Latest occupancy: ' || last_visit || ', latest deskcount: ' || latest_snapshot
                    || ', gap: ' || (last_visit - latest_snapshot) || ' days' FROM cover"""

_BY_LOCATION = """
SELECT office_location, count(*) AS rows, round(avg(occupancy_rate), 4) AS mean_occupancy_rate,
       count(*) FILTER (attendance_count > 0 AND deskcount = 0) AS merge_issues,
       count(*) FILTER (occupancy_rate > 1.0) AS over_capacity_days
FROM lob_fact WHERE NOT is_weekend GROUP BY ALL"""

_PROFILE = """
SELECT count(*) AS rows, count(DISTINCT office_location) AS offices, min(date_key) AS first_date_key,
       max(date_key) AS last_date_key, min(attendance_count) AS min_attendance,
       max(attendance_count) AS max_attendance, CAST(sum(attendance_count) AS BIGINT) AS total_attendance,
       count(*) FILTER (attendance_count = 0) AS rows_without_attendance,
       count(*) FILTER (attendance_count > 0) AS rows_with_attendance,
       count(deskcount) AS rows_with_capacity
FROM agg_fact"""

_NULLS = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (\"{c}\" IS NULL) AS nulls FROM lob_fact"
    for c in (
        "date_key location_key lob_key date office_location line_of_business year month is_weekend"
        " attendance_count deskcount occupancy_rate is_hybrid_day"
    ).split()
)

_STEP_COUNTS = """
SELECT 'visits loaded' AS step, count(*) AS rows FROM raw_visits
UNION ALL SELECT 'visits de-duplicated', count(*) FROM first_visits
UNION ALL SELECT 'visits outside the window',
                 count(*) FILTER (NOT logon_date BETWEEN grid_start AND grid_end) FROM visits, win
UNION ALL SELECT 'visits without an office',
                 count(*) FILTER (logon_date BETWEEN grid_start AND grid_end AND office IS NULL) FROM visits, win
UNION ALL SELECT 'visits of unknown offices',
                 count(*) FILTER (logon_date BETWEEN grid_start AND grid_end AND office IS NOT NULL
                                  AND office NOT IN (SELECT office FROM locations)) FROM visits, win
UNION ALL SELECT 'visits in the fact', CAST(sum(attendance_count) AS BIGINT) FROM agg_fact
UNION ALL SELECT 'snapshots loaded', count(*) FROM raw_desks
UNION ALL SELECT 'snapshots without a flag', count(*) FILTER (include IS NULL) FROM raw_desks
UNION ALL SELECT 'snapshots included', count(*) FROM snaps
UNION ALL SELECT 'fact rows', count(*) FROM lob_fact
UNION ALL SELECT 'fact rows with capacity', count(deskcount) FROM lob_fact
UNION ALL SELECT 'aggregated rows', count(*) FROM agg_fact
UNION ALL SELECT 'aggregated rows with capacity', count(deskcount) FROM agg_fact"""

_PERIODS = r"""
WITH named AS (
  SELECT o_orderkey AS file_id, CAST(o_orderdate AS DATE) AS d,
         CASE o_orderkey % 6
           WHEN 0 THEN '/in/Deskcount/' || strftime(o_orderdate, '%Y_%m') || '_deskcount.xlsx'
           WHEN 1 THEN '/in/Deskcount/' || strftime(o_orderdate, '%Y-%m') || '.v2.xlsx'
           WHEN 2 THEN '/in/Deskcount/' || year(o_orderdate) || '/' || monthname(o_orderdate) || ' Deskcount.xlsx'
           WHEN 3 THEN '/in/Deskcount/' || year(o_orderdate) || '/' || upper(left(monthname(o_orderdate), 3)) || '.xlsx'
           WHEN 4 THEN '/in/Deskcount/' || monthname(o_orderdate) || ' Deskcount.xlsx'
           ELSE '/in/Deskcount/desks ' || o_orderkey || '.xlsx' END AS path,
         CASE WHEN o_orderkey % 6 = 5 AND o_custkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS newest
  FROM orders)
SELECT file_id, path,
       CASE WHEN file_id % 6 <= 1 AND year(d) >= 2000 THEN strftime(d, '%Y-%m')
            WHEN file_id % 6 <= 1 THEN NULL
            WHEN file_id % 6 <= 3 THEN strftime(d, '%Y-%m')
            WHEN file_id % 6 = 4 THEN NULL
            ELSE strftime(newest, '%Y-%m') END AS year_month
FROM named"""

_LANDED = """
, filed AS (SELECT *, strftime(date, '%Y-%m') AS period,
                   CAST(seq // 100000 AS VARCHAR) || '-' || CAST(seq // 60 % 2 AS VARCHAR) AS chunk FROM raw_desks),
kept AS (SELECT period, max(chunk) AS chunk FROM filed GROUP BY ALL)
SELECT period AS year_month, office_raw AS "OfficeLocation", CAST(desks_raw AS VARCHAR) AS "Deskcount",
       CAST(rsf AS VARCHAR) AS "RSF", strftime(date, '%Y-%m-%d') AS "Date",
       include AS "Include in Occupancy Calculation"
FROM filed JOIN kept USING (period, chunk)"""

_DECODED = """
SELECT office_raw AS "OfficeLocation", CAST(desks_raw AS VARCHAR) AS "Deskcount", CAST(rsf AS VARCHAR) AS "RSF",
       strftime(date, '%Y-%m-%d') AS "Date", include AS "Include in Occupancy Calculation"
FROM raw_desks"""

_COMBINED = """
SELECT CAST(username AS VARCHAR) AS "Username", office_raw AS "OfficeLocation", lob_raw AS "LineOfBusiness",
       strftime(logon_date, '%Y-%m-%d') AS "LogonDate",
       CASE WHEN seq % 3 <> 2 THEN job END AS "JobFamily",
       CASE WHEN seq % 3 = 1 THEN dow END AS "DayofWeek"
FROM raw_visits"""

_FLAGS_PARTIAL = """
, known AS (SELECT date, CAST(date_trunc('week', date) AS DATE) AS week_start,
                   isodow(date) < 6 AND count(*) FILTER (isodow(date) < 6)
                     OVER (PARTITION BY date_trunc('week', date), month(date)) >= 3 AS eligible
            FROM days WHERE day(date) <= 15),
kept AS (SELECT CASE WHEN date_key % 7 <> 0 THEN date END AS date, date_key, office_location, line_of_business,
                attendance_count FROM lob_fact),
totals AS (SELECT k.date, office_location, week_start, sum(attendance_count) AS n
           FROM kept k JOIN known ON k.date = known.date WHERE eligible GROUP BY ALL),
flagged AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY office_location, week_start ORDER BY n DESC, date) AS place
                           FROM totals) WHERE place <= 3)
SELECT k.date, k.office_location, k.line_of_business, k.attendance_count, k.date_key, f.date IS NOT NULL AS is_hybrid_day
FROM kept k LEFT JOIN flagged f ON f.date = k.date AND f.office_location = k.office_location"""

_SORTED = f"""
, offices AS ({_BY_LOCATION.strip()})
SELECT 'fact' AS export, date_key || '|' || attendance_count AS "row",
       CAST(row_number() OVER (ORDER BY date_key, office_location, line_of_business) AS INTEGER) AS number FROM lob_fact
UNION ALL
SELECT 'offices', office_location || '|' || rows,
       CAST(row_number() OVER (ORDER BY merge_issues DESC, over_capacity_days DESC,
                               mean_occupancy_rate NULLS LAST, office_location) AS INTEGER) FROM offices"""

_REPORTS = f"""
, counted AS (
  SELECT 'deskcount_merge_issues' AS report, count(*) FILTER (attendance_count > 0 AND deskcount = 0) AS rows FROM lob_fact
  UNION ALL SELECT 'missing_capacity', count(*) FILTER (attendance_count > 0 AND deskcount IS NULL) FROM lob_fact
  UNION ALL SELECT 'over_capacity_days', count(*) FILTER (occupancy_rate > 1.0) FROM lob_fact)
SELECT * FROM counted WHERE rows > 0
UNION ALL SELECT 'by_location_summary', count(DISTINCT office_location) FROM lob_fact
UNION ALL SELECT 'validation_summary', 10"""

_CSV_REJECTED = """
, filed AS (SELECT *, day(logon_date) AS d, CASE WHEN day(logon_date) % 5 = 4 THEN '_' ELSE '' END
                   || 'day' || day(logon_date) || '-' || seq // 100000 || '.csv' AS file FROM raw_visits)
SELECT file,
       CASE WHEN d % 5 = 4 OR (d % 5 = 2 AND bool_or(seq % 2 = 0)) THEN 0 ELSE count(*) END AS rows,
       CASE WHEN d % 5 = 4 THEN 'name begins with _ or . and is not listed'
            WHEN d % 5 = 2 AND bool_or(seq % 2 = 0) THEN 'a line has more fields than the header'
            WHEN d % 5 = 1 THEN max(trim(office_raw)) WHEN d % 5 = 3 THEN 'two' || chr(10) || 'lines' ELSE 'x' END AS office
FROM filed GROUP BY file, d"""

_WORKBOOKS_REJECTED = """
SELECT 'desks ' || seq || '.xlsx' AS file, 'no month in name, content or folder' AS error FROM raw_desks WHERE seq % 10 <> 0
UNION ALL
SELECT 'landed', CAST(count(*) AS VARCHAR) FROM (
  SELECT row_number() OVER (PARTITION BY month(date) ORDER BY CAST(seq AS VARCHAR) DESC) AS place
  FROM raw_desks WHERE seq % 10 = 0) WHERE place = 1"""

_CSV_QUOTED = """
SELECT CAST(username AS VARCHAR) AS "Username",
       'Gate "' || seq % 10 || '",' || chr(10)
       || repeat('floor' || chr(10), CASE WHEN seq % 2500 = 0 THEN 20000 ELSE seq % 7 END) || trim(office_raw) AS "OfficeLocation",
       strftime(logon_date, '%Y-%m-%d') AS "LogonDate"
FROM raw_visits"""

_CSV_NAMED = """
SELECT strftime(logon_date, '%Y-%m') || '_Occupancy.csv' AS file, CAST(username AS VARCHAR) AS "Username",
       strftime(logon_date, '%Y-%m-%d') AS "LogonDate"
FROM raw_visits WHERE seq % 3 = 0 AND username IS NOT NULL"""

_SWITCHED = """
, agg AS (SELECT * FROM agg_fact)
SELECT 'occupancy_clean' AS "table", count(*) AS rows, CAST(sum(year(logon_date) * 100 + month(logon_date)) AS BIGINT) AS total FROM visits
UNION ALL SELECT 'deskcount_clean', count(*), CAST(sum(deskcount) AS BIGINT) FROM snaps
UNION ALL SELECT 'dim_date', count(*), CAST(sum(CAST(strftime(d, '%Y%m%d') AS INTEGER)) AS BIGINT)
          FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM calendar)
UNION ALL SELECT 'dim_location', count(*), CAST(sum(location_key * 10 + rsf) AS BIGINT) FROM locations
UNION ALL SELECT 'dim_line_of_business', count(*), CAST(sum(lob_key * length(lob)) AS BIGINT) FROM lobs
UNION ALL SELECT 'fact_occupancy', count(*), CAST(sum(attendance_count * lob_key + coalesce(deskcount, 0)) AS BIGINT) FROM lob_fact
UNION ALL SELECT 'fact_occupancy_aggregated', count(*),
                 CAST(sum(attendance_count * location_key + CAST(is_hybrid_day AS INTEGER)) AS BIGINT) FROM agg"""

_RELANDED = """
, filed AS (SELECT *, strftime(date, '%Y-%m') AS period, CAST(seq // 100000 AS VARCHAR) AS chunk FROM raw_desks WHERE month(date) % 2 = 0),
kept AS (SELECT period, max(chunk) AS chunk FROM filed GROUP BY ALL)
SELECT period AS year_month, office_raw AS "OfficeLocation", CAST(desks_raw AS VARCHAR) AS "Deskcount",
       CAST(rsf AS VARCHAR) AS "RSF", strftime(date, '%Y-%m-%d') AS "Date",
       include AS "Include in Occupancy Calculation"
FROM filed JOIN kept USING (period, chunk)"""

# Of a month's workbooks the last one counts, and they hold up to 100,000 rows each.
_DRIFTED = """
, parts AS (SELECT strftime(date, '%Y-%m') AS period, max(CAST(seq // 100000 AS VARCHAR)) AS part FROM raw_desks GROUP BY ALL)
SELECT office AS office_location, deskcount, date FROM snaps
JOIN parts ON period = strftime(date, '%Y-%m') AND part = CAST(seq // 100000 AS VARCHAR)"""

_PARSED_DATES = """
SELECT o_orderkey, CASE WHEN o_orderkey % 16 < 14 THEN CAST(o_orderdate AS DATE) END AS day FROM orders"""

_PARSED_NUMBERS = """
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 2 THEN NULL WHEN 3 THEN NULL
                  WHEN 1 THEN round(CAST(CAST(round(s_acctbal, 2) AS DECIMAL(18, 2)) AS DOUBLE) * 10, 3)
                  ELSE CAST(CAST(round(s_acctbal, 2) AS DECIMAL(18, 2)) AS DOUBLE) END AS number
FROM supplier"""

_FACT = "SELECT * FROM lob_fact"
_AGG = "SELECT * FROM agg_fact"
_PUBLISHED = "SELECT * REPLACE (CAST(attendance_count AS INTEGER) AS attendance_count) FROM agg_fact"

_RANGES = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS most FROM lob_fact"
    for c in "date_key location_key lob_key date is_weekend attendance_count deskcount is_hybrid_day".split()
)

_WITH_SEVERAL_VARIANTS = {
    "clean_occupancy": _VISITS,
    "clean_deskcount": "SELECT office AS office_location, deskcount, date FROM snaps",
    "dim_location": 'SELECT location_key, office AS office_location, rsf AS "RSF" FROM locations',
    "coverage_window": "SELECT first_visit, last_visit, latest_snapshot, coverage_end, grid_start, grid_end FROM win",
    "eligible_dates": "SELECT date, week_start, weekdays, eligible FROM eligible",
    "top3_days": "SELECT office AS office_location, week_start, date, n AS daily_total_attendance,"
    " CAST(day_rank AS INTEGER) AS day_rank FROM top3",
    "asof_capacity": f"SELECT {_KEY.format('date')} AS date_key, location_key, date, office AS office_location,"
    " n AS attendance_count, deskcount FROM capacity",
    "fact_occupancy": _FACT,
    "fact_occupancy_aggregated": _AGG,
    "by_location_summary": _BY_LOCATION,
    "validation_summary": _SUMMARY,
}

_EVENTS_ONLY = {
    "normalize_location": _SPELLINGS,
    "lob_frequency": _PAGE_OF_LOBS,
    "dim_line_of_business": "SELECT lob_key, lob AS line_of_business FROM lobs",
    "attendance_by_lob": f"SELECT {_KEY.format('date')} AS date_key, office AS office_location,"
    " lob AS line_of_business, n AS attendance_count FROM counts",
    "attendance_by_office": f"SELECT {_KEY.format('date')} AS date_key, office AS office_location,"
    " n AS attendance_count FROM office_counts",
    "grid_by_lob": f"SELECT {_KEY.format('date')} AS date_key, date, location_key, office AS office_location,"
    " lob_key, lob AS line_of_business, n AS attendance_count FROM lob_grid",
    "grid_by_office": f"SELECT {_KEY.format('date')} AS date_key, date, location_key,"
    " office AS office_location, n AS attendance_count FROM grid",
    "occupancy_rate": "SELECT office_location, date, attendance_count, deskcount, occupancy_rate FROM agg_fact",
    "daily_totals": "SELECT office AS office_location, CAST(date_trunc('week', date) AS DATE) AS week_start, date,"
    " n AS daily_total_attendance FROM grid",
    "hybrid_flags": "SELECT date, office_location, line_of_business, attendance_count, is_hybrid_day FROM lob_fact",
    "flag_distribution": "SELECT is_hybrid_day, count(*) AS rows,"
    " round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS share_pct FROM lob_fact GROUP BY ALL",
    "fact_profile": _PROFILE,
    "dim_profile": "SELECT count(*) AS offices, min(location_key) AS first_key, max(location_key) AS last_key,"
    " min(rsf) AS min_rsf, max(rsf) AS max_rsf, CAST(sum(rsf) AS BIGINT) AS total_rsf FROM locations",
    "null_profile": _NULLS,
    "step_counts": _STEP_COUNTS,
    "merge_issues": "SELECT date, office_location, line_of_business, attendance_count, deskcount FROM lob_fact"
    " WHERE attendance_count > 0 AND deskcount = 0",
    "merge_issues_zero_filled": "SELECT date, office_location, line_of_business, attendance_count,"
    " coalesce(deskcount, 0) AS deskcount FROM lob_fact WHERE attendance_count > 0 AND coalesce(deskcount, 0) = 0",
    "missing_capacity": "SELECT date, office_location, line_of_business, attendance_count, deskcount"
    " FROM lob_fact WHERE attendance_count > 0 AND deskcount IS NULL",
    "over_capacity": "SELECT date, office_location, line_of_business, attendance_count, deskcount, occupancy_rate"
    " FROM lob_fact WHERE occupancy_rate > 1.0",
    "weekday_weekend_mean": "SELECT round(avg(occupancy_rate) FILTER (NOT is_weekend), 6) AS weekday_mean,"
    " round(avg(occupancy_rate) FILTER (is_weekend), 6) AS weekend_mean FROM lob_fact",
    "recency_gap": "SELECT last_visit AS latest_occupancy, latest_snapshot AS latest_deskcount,"
    " CAST(last_visit - latest_snapshot AS INTEGER) AS gap_days FROM cover",
    "office_slice": "SELECT * FROM lob_fact WHERE office_location = 'NATION 7'",
    "fact_sample": "SELECT * FROM lob_fact ORDER BY date_key, office_location, line_of_business LIMIT 10",
    "combine_union": _COMBINED,
    "publish_roundtrip": _PUBLISHED,
    "hybrid_flags_partial": _FLAGS_PARTIAL,
    "business_profile": "SELECT count(*) AS businesses, min(lob_key) AS first_key, max(lob_key) AS last_key FROM lobs",
    "fact_sorted_export": _SORTED,
    "reports_roundtrip": _REPORTS,
    "csv_rejected": _CSV_REJECTED,
    "csv_quoted": _CSV_QUOTED,
    "csv_monthly_names": _CSV_NAMED,
    "run_all_csv": _PUBLISHED,
    "null_profile_files": _NULLS,
    "range_profile_files": _RANGES,
}


def oracle_sql() -> dict[str, str]:
    queries = {name: _sql(body) for name, body in {**_WITH_SEVERAL_VARIANTS, **_EVENTS_ONLY}.items()}
    for name, body in _WITH_SEVERAL_VARIANTS.items():
        queries[f"{name}_orders"] = _sql(body, "orders")
    queries["dim_date"] = _DIM_DATE.strip()
    queries["calendar_profile"] = (
        "SELECT count(*) AS days, min(date) AS first_date, max(date) AS last_date, min(date_key) AS first_key,"
        " max(date_key) AS last_key, count(DISTINCT year) AS years, min(year) AS first_year, max(year) AS last_year"
        f" FROM ({_DIM_DATE.strip()})"
    )
    queries["parse_dates"] = _PARSED_DATES.strip()
    queries["parse_numbers"] = _PARSED_NUMBERS.strip()
    queries["workbook_rejected"] = _sql(_WORKBOOKS_REJECTED, "orders")
    queries["workbook_header_drift"] = _sql(_DRIFTED, "orders")
    queries["workbook_relanded"] = _sql(_RELANDED, "orders")
    queries["publish_batches"] = _sql(_PUBLISHED, "orders")
    queries["refresh_late"] = _sql(_AGG, "orders")
    queries["build_switch"] = _sql(_SWITCHED, "orders")
    queries["period_inference"] = _PERIODS.strip()
    queries["workbook_ingest"] = _sql(_DECODED, "orders")
    queries["workbook_cells"] = _sql(_DECODED, "orders")
    queries["workbook_landing"] = _sql(_LANDED, "orders")
    queries["marts_build"] = _sql(_FACT, "orders")
    return queries
