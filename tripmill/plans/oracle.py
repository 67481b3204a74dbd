"""The registered queries in SQL, written on their own for comparison in DuckDB."""

from __future__ import annotations

TRIPS = """
trips AS (
  SELECT
    CASE WHEN l_partkey % 97 = 0 THEN NULL
         ELSE CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) END AS trip_id,
    l_shipdate AS trip_start_timestamp,
    CASE WHEN l_suppkey % 50 = 3 AND l_linenumber = 1 THEN NULL
         ELSE l_shipdate + to_seconds((l_partkey * 131 + l_orderkey * 17) % 23000 - 200) END AS trip_end_timestamp,
    (l_partkey * 131 + l_orderkey * 17) % 23000 - 200 AS trip_seconds,
    CASE WHEN l_linenumber = 7 THEN l_quantity * CAST(2.5 AS DOUBLE)
         ELSE l_quantity * CAST(0.5 AS DOUBLE) END AS trip_miles,
    l_extendedprice AS fare, l_discount AS tips, l_tax AS tolls, c_acctbal AS extras,
    CASE WHEN l_linenumber = 5 AND l_quantity = 13 THEN NULL ELSE o_totalprice END AS trip_total,
    CASE WHEN o_orderpriority = '5-LOW' AND l_returnflag = 'A' THEN NULL
         ELSE c_nationkey END AS pickup_community_area,
    CASE WHEN s_nationkey = 7 THEN NULL ELSE s_nationkey END AS dropoff_community_area,
    CAST(l_shipdate AS DATE) AS trip_date,
    l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

ORDER = """trip_end_timestamp DESC NULLS LAST, trip_start_timestamp DESC NULLS LAST,
      trip_total DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"""

RANKED = f"""
ranked AS (
  SELECT *, CASE WHEN trip_id IS NOT NULL THEN
      row_number() OVER (PARTITION BY trip_id ORDER BY {ORDER}) END AS _duplicate_rank
  FROM trips
)"""

NEGATIVE = "fare < 0 OR tips < 0 OR tolls < 0 OR extras < 0 OR trip_total < 0"


def _reason(max_seconds: int = 21600, max_miles: int = 100, max_speed: int = 100, dedup: bool = True) -> str:
    duplicate = "WHEN _duplicate_rank > 1 THEN 'duplicate_trip_id'" if dedup else ""
    return f"""CASE
      WHEN trip_id IS NULL THEN 'null_trip_id'
      {duplicate}
      WHEN trip_start_timestamp IS NULL OR trip_end_timestamp IS NULL
        OR trip_end_timestamp < trip_start_timestamp THEN 'invalid_timestamp'
      WHEN trip_seconds IS NULL OR trip_seconds < 1 OR trip_seconds > {max_seconds} THEN 'invalid_duration'
      WHEN trip_miles IS NULL OR trip_miles < 0 OR trip_miles > {max_miles} THEN 'invalid_distance'
      WHEN trip_speed_mph IS NULL OR trip_speed_mph > {max_speed} THEN 'invalid_speed'
      WHEN {NEGATIVE} THEN 'negative_amount'
      WHEN pickup_community_area IS NULL OR dropoff_community_area IS NULL THEN 'missing_geography'
      ELSE 'valid' END"""


SPEED = "trip_miles / NULLIF(trip_seconds / CAST(3600 AS DOUBLE), 0)"
MOVING_SPEED = f"CASE WHEN trip_seconds > 0 THEN {SPEED} END"

MEASURED = f"""
measured AS (SELECT *, {SPEED} AS trip_speed_mph FROM ranked)"""

TAGGED = f"""
tagged AS (SELECT *, {_reason()} AS reject_reason FROM measured)"""

SILVER = """
silver AS (SELECT * EXCLUDE (_duplicate_rank, reject_reason) FROM tagged WHERE reject_reason = 'valid')"""


def _money(name: str) -> str:
    return f"CAST(SUM(CAST({name} AS DECIMAL(18, 2))) AS DOUBLE)"


def _n(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


REVENUE = f"""
revenue AS (
  SELECT trip_date, {_n("COUNT(*)")} AS nb_trips,
    {_money("fare")} AS total_fare, {_money("tips")} AS total_tips, {_money("tolls")} AS total_tolls,
    {_money("extras")} AS total_extras, {_money("trip_total")} AS total_revenue,
    {_money("trip_total")} / COUNT(trip_total) AS avg_trip_total
  FROM silver GROUP BY trip_date
)"""

SIXTY = "CAST(60 AS DOUBLE)"

DURATION = f"""
duration AS (
  SELECT trip_date, {_n("COUNT(*)")} AS nb_trips,
    CAST(SUM(trip_seconds) AS DOUBLE) / COUNT(*) / {SIXTY} AS avg_trip_minutes,
    quantile_disc(trip_seconds, 0.5) / {SIXTY} AS median_trip_minutes,
    quantile_disc(trip_seconds, 0.9) / {SIXTY} AS p90_trip_minutes,
    SUM(trip_miles) / COUNT(trip_miles) AS avg_trip_miles
  FROM silver GROUP BY trip_date
)"""

ZONES = f"""
zones AS (
  SELECT pickup_community_area, {_n("COUNT(*)")} AS nb_trips,
    {_money("trip_total")} AS total_revenue,
    {_money("trip_total")} / COUNT(trip_total) AS avg_trip_total,
    CAST(SUM(trip_seconds) AS DOUBLE) / COUNT(trip_seconds) AS avg_trip_seconds,
    SUM(trip_miles) / COUNT(trip_miles) AS avg_trip_miles
  FROM silver GROUP BY pickup_community_area
)"""

ZONE_ROWS = f"""
zone_rows AS (
  SELECT pickup_community_area, nb_trips, total_revenue, avg_trip_total,
    avg_trip_seconds / {SIXTY} AS avg_trip_minutes, avg_trip_miles
  FROM zones
)"""

EVENTS = """
calendar AS (
  SELECT * FROM (VALUES
    ('Harbour Run', DATE '1995-10-08', DATE '1995-10-08'),
    ('Summer Fair', DATE '1996-08-03', DATE '1996-08-06'),
    ('Fair Opening', DATE '1996-08-03', DATE '1996-08-03')
  ) AS t(event_name, first_day, last_day)
)"""


def _with(*tables: str, body: str) -> str:
    return f"WITH {','.join(tables)}\n{body}"


_TO_TAGGED = (TRIPS, RANKED, MEASURED, TAGGED)
_TO_SILVER = (*_TO_TAGGED, SILVER)


def _tagged(body: str) -> str:
    return _with(*_TO_TAGGED, body=body)


def _silver(body: str, *more: str) -> str:
    return _with(*_TO_SILVER, *more, body=body)


POINTS = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p99_5": 0.995, "p99_9": 0.999}


def _distribution(measure: str, unit: str, to: str = "DOUBLE") -> str:
    columns = ", ".join(f"quantile_disc(m, {p}) AS {name}_{unit}" for name, p in POINTS.items())
    return _with(
        TRIPS,
        body=f"""SELECT MIN(m) AS min_{unit}, {columns}, MAX(m) AS max_{unit}
          FROM (SELECT CAST({measure} AS {to}) AS m FROM trips)""",
    )


def _distributions(measures: dict[str, str]) -> str:
    columns = ", ".join(f"quantile_disc(m, {p}) AS {name}" for name, p in POINTS.items())
    one = (
        f"SELECT '{unit}' AS measure, MIN(m) AS minimum, {columns}, MAX(m) AS maximum "
        f"FROM (SELECT CAST({measure} AS DOUBLE) AS m FROM trips)"
        for unit, measure in measures.items()
    )
    return _with(TRIPS, body="\nUNION ALL\n".join(one))


def _extremes(by: str) -> str:
    shown = ["trip_id", "trip_seconds", "trip_miles", "trip_speed_mph", "trip_total"]
    rest = ", ".join(f"{c} ASC NULLS LAST" for c in shown if c != by)
    return _with(
        TRIPS,
        body=f"""SELECT {", ".join(shown)} FROM (SELECT *, {MOVING_SPEED} AS trip_speed_mph FROM trips)
          ORDER BY {by} DESC NULLS LAST, {rest} LIMIT 20""",
    )


def _title(name: str) -> str:
    """Nation names are capitals and spaces only."""
    return (
        f"array_to_string(list_transform(string_split(lower({name}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


_DAY = "trip_date, nb_trips, total_revenue, avg_trip_total"
_DAY_MINUTES = "trip_date, nb_trips, avg_trip_minutes, median_trip_minutes, p90_trip_minutes"
_ZONE = "pickup_community_area, nb_trips, total_revenue, avg_trip_total, avg_trip_miles"
_SILVER_ROWS = _silver("SELECT * FROM silver")
_QUARANTINE_ROWS = _tagged("SELECT * FROM tagged WHERE reject_reason <> 'valid'")


def sql() -> dict[str, str]:
    def top(columns: str, table: str, common: str, by: str, limit: int = 10) -> str:
        key = columns.split(",")[0]
        return _silver(f"SELECT {columns} FROM {table} ORDER BY {by} DESC NULLS LAST, {key} LIMIT {limit}", common)

    kpis = f"""SELECT {_n("SUM(nb_trips)")} AS total_trips,
        CAST(SUM(CAST(total_revenue AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
        CAST(SUM(CAST(total_revenue AS DECIMAL(18, 2))) AS DOUBLE) / SUM(nb_trips) AS avg_revenue_per_trip
        FROM revenue"""
    minutes = f"CAST(SUM(trip_seconds) AS DOUBLE) / {SIXTY} / COUNT(*) AS avg_trip_minutes"
    per_day = """SELECT trip_date, COUNT(*) AS bronze_rows,
        COUNT(*) FILTER (WHERE reject_reason = 'valid') AS silver_rows,
        COUNT(*) FILTER (WHERE reject_reason <> 'valid') AS quarantine_rows,
        CAST(0 AS BIGINT) AS difference FROM tagged GROUP BY trip_date"""
    named = f"{_title('n_name')} AS zone_name"
    in_year = "CAST(date_trunc('year', trip_date) AS DATE) AS trip_year"
    return {
        "ingest_typed": _with(TRIPS, body="SELECT * FROM trips"),
        "ingest_csv": _with(
            TRIPS,
            body="""SELECT * EXCLUDE (l_partkey, l_suppkey, l_quantity, l_extendedprice),
                CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey FROM trips""",
        ),
        "incremental_append": _with(
            TRIPS, body="SELECT * FROM trips WHERE trip_start_timestamp < TIMESTAMP '1999-01-01 00:00:00'"
        ),
        "incremental_whole": _with(TRIPS, body="SELECT * FROM trips"),
        "quality_tagged": _tagged("SELECT * FROM tagged"),
        "quality_silver": _SILVER_ROWS,
        "quality_quarantine": _QUARANTINE_ROWS,
        "quality_reject_counts": _tagged(
            f"SELECT reject_reason, {_n('COUNT(*)')} AS n_rows FROM tagged GROUP BY reject_reason"
        ),
        "quality_retention": _tagged(
            """SELECT COUNT(*) AS bronze_rows, COUNT(*) FILTER (WHERE reject_reason = 'valid') AS silver_rows,
               COUNT(*) FILTER (WHERE reject_reason <> 'valid') AS rejected_rows,
               COUNT(*) FILTER (WHERE reject_reason = 'valid') / CAST(COUNT(*) AS DOUBLE) * CAST(100 AS DOUBLE)
                 AS retention_rate_pct FROM tagged"""
        ),
        "quality_reconcile": _tagged(per_day),
        "quality_checks": _silver(
            f"""SELECT 'silver_not_empty' AS "check", COUNT(*) > 0 AS passed,
                 CAST(COUNT(*) AS DOUBLE) AS observed FROM silver
               UNION ALL
               SELECT 'retention_in_range', pct BETWEEN 50 AND 100, pct FROM (
                 SELECT COUNT(*) FILTER (WHERE reject_reason = 'valid') / CAST(COUNT(*) AS DOUBLE)
                   * CAST(100 AS DOUBLE) AS pct FROM tagged)
               UNION ALL
               SELECT 'no_duplicate_trip_id', COUNT(*) = COUNT(DISTINCT trip_id),
                 CAST(COUNT(*) - COUNT(DISTINCT trip_id) AS DOUBLE) FROM silver
               UNION ALL
               SELECT 'no_negative_amount', COUNT(*) FILTER (WHERE {NEGATIVE}) = 0,
                 CAST(COUNT(*) FILTER (WHERE {NEGATIVE}) AS DOUBLE) FROM silver"""
        ),
        "quality_replay": _tagged(
            f"""SELECT * EXCLUDE (reject_reason), {_reason(22000, 200, 250)} AS reject_reason
               FROM tagged WHERE reject_reason <> 'valid'"""
        ),
        "quality_dedup_after_validation": _with(
            TRIPS,
            f"""
checked AS (SELECT *, {_reason(dedup=False)} AS first_reason
  FROM (SELECT *, {SPEED} AS trip_speed_mph FROM trips)),
placed AS (SELECT *, CASE WHEN first_reason = 'valid' THEN row_number() OVER (
    PARTITION BY trip_id, first_reason = 'valid' ORDER BY {ORDER}) END AS _duplicate_rank FROM checked)""",
            body="""SELECT * EXCLUDE (first_reason),
                CASE WHEN _duplicate_rank > 1 THEN 'duplicate_trip_id' ELSE first_reason END AS reject_reason
              FROM placed""",
        ),
        "dedup_ranked": _with(TRIPS, RANKED, body="SELECT * FROM ranked"),
        "dedup_latest": _with(
            TRIPS, RANKED, body="SELECT * EXCLUDE (_duplicate_rank) FROM ranked WHERE _duplicate_rank = 1"
        ),
        "gold_revenue_by_day": _silver("SELECT * FROM revenue ORDER BY trip_date", REVENUE),
        "gold_avg_trip_duration": _silver("SELECT * FROM duration ORDER BY trip_date", DURATION),
        "gold_top_pickup_zones": _silver("SELECT * FROM zones ORDER BY nb_trips DESC, pickup_community_area", ZONES),
        "kpi_global": _silver(kpis, REVENUE),
        "kpi_duration": _silver(f"SELECT {minutes} FROM silver"),
        "kpi_cards": _silver(
            f"""SELECT format('{{:,}}', total_trips) AS trips,
                '$' || format('{{:,}}', CAST(round(total_revenue) AS BIGINT)) AS revenue,
                '$' || format('{{:,.2f}}', avg_revenue_per_trip) AS revenue_per_trip,
                printf('%.1f min', (SELECT {minutes.replace(" AS avg_trip_minutes", "")} FROM silver)) AS duration
              FROM ({kpis})""",
            REVENUE,
        ),
        "global_average_duration": _silver(f"SELECT {minutes}, {_n('COUNT(*)')} AS total_trips FROM silver"),
        "period_bounds": _silver("SELECT MIN(trip_date) AS date_min, MAX(trip_date) AS date_max FROM silver"),
        "revenue_between": _silver(
            f"SELECT {_DAY} FROM revenue WHERE trip_date BETWEEN DATE '1995-03-01' AND DATE '1996-08-31' ORDER BY 1",
            REVENUE,
        ),
        "duration_between": _silver(
            f"""SELECT {_DAY_MINUTES} FROM duration
               WHERE trip_date BETWEEN DATE '1995-03-01' AND DATE '1996-08-31' ORDER BY 1""",
            DURATION,
        ),
        "top_revenue_days": top(_DAY, "revenue", REVENUE, "total_revenue"),
        "top_trip_days": top(_DAY, "revenue", REVENUE, "nb_trips"),
        "longest_avg_duration_days": top(_DAY_MINUTES, "duration", DURATION, "avg_trip_minutes"),
        "highest_p90_days": top(_DAY_MINUTES, "duration", DURATION, "p90_trip_minutes"),
        "zones_all": _silver("SELECT * FROM zone_rows", ZONES, ZONE_ROWS),
        "top_zones_by_trips": top(_ZONE, "zones", ZONES, "nb_trips"),
        "top_zones_by_revenue": top(_ZONE, "zones", ZONES, "total_revenue"),
        "zone_activity_vs_revenue": _silver(
            "SELECT * FROM zone_rows ORDER BY nb_trips DESC, pickup_community_area", ZONES, ZONE_ROWS
        ),
        "zone_activity_top20": _silver(
            "SELECT * FROM zone_rows ORDER BY nb_trips DESC, pickup_community_area LIMIT 20", ZONES, ZONE_ROWS
        ),
        "profile_identity": _with(
            TRIPS,
            body="""SELECT COUNT(*) AS rows, COUNT(DISTINCT trip_id) AS distinct_trip_id,
                COUNT(*) FILTER (WHERE trip_id IS NULL) AS null_trip_id FROM trips""",
        ),
        "profile_duration": _distribution("trip_seconds", "seconds", "BIGINT"),
        "profile_distance": _distribution("trip_miles", "miles"),
        "profile_speed": _distribution(MOVING_SPEED, "speed"),
        "profile_distributions": _distributions(
            {"seconds": "trip_seconds", "miles": "trip_miles", "speed": MOVING_SPEED}
        ),
        "extreme_distances": _extremes("trip_miles"),
        "extreme_speeds": _extremes("trip_speed_mph"),
        "zone_names": _silver(
            f"""SELECT pickup_community_area, {named}, nb_trips, total_revenue, avg_trip_total,
                avg_trip_minutes, avg_trip_miles
              FROM zone_rows LEFT JOIN nation ON pickup_community_area = n_nationkey""",
            ZONES,
            ZONE_ROWS,
        ),
        "zone_map": _silver(
            """SELECT CAST(pickup_community_area AS VARCHAR) AS pickup_community_area, nb_trips, total_revenue,
                avg_trip_total, avg_trip_minutes, avg_trip_miles,
                'POINT (' || CAST(n_nationkey AS VARCHAR) || ' 0)' AS geometry
              FROM zone_rows JOIN nation ON pickup_community_area = n_nationkey""",
            ZONES,
            ZONE_ROWS,
        ),
        "event_days": _silver(
            f"""SELECT {_DAY}, event_name FROM revenue
               LEFT JOIN calendar ON trip_date BETWEEN first_day AND last_day""",
            REVENUE,
            EVENTS,
        ),
        "duration_long": _silver(
            "\nUNION ALL\n".join(
                f"SELECT trip_date, '{c}' AS variable, {c} AS value FROM duration"
                for c in ("avg_trip_minutes", "median_trip_minutes", "p90_trip_minutes")
            ),
            DURATION,
        ),
        "revenue_display": _silver(
            """SELECT strftime(trip_date, '%Y-%m-%d') AS "Date", nb_trips AS "Nombre de trajets",
                total_revenue AS "Revenu total ($)", avg_trip_total AS "Revenu moyen par trajet ($)"
              FROM revenue""",
            REVENUE,
        ),
        "revenue_csv": _silver(
            """SELECT CAST(trip_date AS VARCHAR) AS trip_date, CAST(nb_trips AS VARCHAR) AS nb_trips, total_revenue, avg_trip_total
               FROM revenue
               WHERE trip_date BETWEEN DATE '1995-03-01' AND DATE '1996-08-31'""",
            REVENUE,
        ),
        "stored_duration": _silver("SELECT * FROM duration", DURATION),
        "stored_revenue": _silver("SELECT * FROM revenue", REVENUE),
        "stored_zones": _silver("SELECT * FROM zones", ZONES),
        "stream_gold_revenue": _silver("SELECT * FROM revenue", REVENUE),
        "stream_gold_duration": _silver("SELECT * FROM duration", DURATION),
        "stream_gold_zones": _silver("SELECT * FROM zones", ZONES),
        "stream_late_rows": _with(
            TRIPS,
            body=f"""SELECT trip_date, {_n("COUNT(*)")} AS landed, {_n("COUNT(*) FILTER (WHERE NOT late)")} AS on_time,
                {_n("COUNT(*) FILTER (WHERE late)")} AS late
              FROM (SELECT trip_date, l_partkey % 3 = 0 AND trip_start_timestamp <
                      (SELECT MAX(trip_start_timestamp) - INTERVAL 365 DAY FROM trips WHERE l_partkey % 3 <> 0) AS late FROM trips)
              GROUP BY trip_date""",
        ),
        "stream_first_seen_expired": _with(
            TRIPS,
            RANKED,
            """
newest AS (SELECT trip_id, trip_start_timestamp AS t FROM ranked WHERE _duplicate_rank = 1)""",
            body=f"""SELECT trip_id, {_n("CASE WHEN t + INTERVAL 1 DAY <= (SELECT MAX(t) - INTERVAL 1 DAY FROM newest) THEN 2 ELSE 1 END")} AS times
              FROM newest""",
        ),
        "sketched_profile": _silver(
            "\nUNION ALL\n".join(
                f"""SELECT '{name}' AS measure, {_n("COUNT(m)")} AS n, MIN(m) AS minimum, MAX(m) AS maximum, TRUE AS within_error
                FROM (SELECT CAST({m} AS DOUBLE) AS m FROM silver WHERE trip_date BETWEEN DATE '1995-03-01' AND DATE '1996-08-31')"""
                for name, m in (("seconds", "trip_seconds"), ("miles", "trip_miles"), ("speed", MOVING_SPEED))
            )
        ),
        "sketched_ids": _with(
            TRIPS,
            body=f"""SELECT {_n("COUNT(*)")} AS rows, {_n("COUNT(*) - COUNT(trip_id)")} AS null_trip_id, TRUE AS within_error
              FROM trips WHERE trip_date BETWEEN DATE '1995-03-01' AND DATE '1996-08-31'""",
        ),
        "duration_approx": _silver("SELECT * FROM duration", DURATION),
        "event_bands": _silver(
            """SELECT event_name AS name, first_day AS start,
                CASE WHEN first_day = last_day THEN last_day + 1 ELSE last_day END AS band_end
              FROM calendar WHERE last_day >= (SELECT MIN(trip_date) FROM revenue) AND first_day <= (SELECT MAX(trip_date) FROM revenue)""",
            REVENUE,
            EVENTS,
        ),
        "ingest_not_taken": _with(
            TRIPS,
            """
mark AS (SELECT MAX(trip_start_timestamp) AS m FROM trips WHERE trip_start_timestamp < TIMESTAMP '1996-06-30 12:00:00')""",
            body=f"""SELECT {_n("COUNT(*) FILTER (WHERE t >= TIMESTAMP '1998-01-01')")} AS outside_period,
                {_n("COUNT(*) FILTER (WHERE t < TIMESTAMP '1998-01-01' AND t < m)")} AS older_than_mark,
                {_n("COUNT(*) FILTER (WHERE t IS NULL OR (t < TIMESTAMP '1998-01-01' AND t >= m))")} AS candidates
              FROM (SELECT trip_start_timestamp AS t, m FROM trips, mark)""",
        ),
        "appended_bronze": _with(TRIPS, body=f"SELECT trip_date, {_n('COUNT(*)')} AS nb_trips FROM trips GROUP BY trip_date"),
        "stored_metrics": _with(
            *_TO_TAGGED,
            """
runs AS (SELECT 1 AS run, reject_reason FROM tagged
  UNION ALL SELECT 2, reject_reason FROM tagged WHERE year(trip_date) IN (1995, 1997)),
totals AS (SELECT run, COUNT(*) AS bronze_rows,
    COUNT(*) FILTER (WHERE reject_reason = 'valid') AS silver_rows,
    COUNT(*) FILTER (WHERE reject_reason = 'null_trip_id') AS null_ids FROM runs GROUP BY run)""",
            body="""SELECT bronze_rows, silver_rows, rejected_rows, null_ids, retention_rate_pct,
                bronze_rows - LAG(bronze_rows) OVER (ORDER BY run) AS bronze_rows_change,
                silver_rows - LAG(silver_rows) OVER (ORDER BY run) AS silver_rows_change,
                rejected_rows - LAG(rejected_rows) OVER (ORDER BY run) AS rejected_rows_change,
                retention_rate_pct - LAG(retention_rate_pct) OVER (ORDER BY run) AS retention_rate_pct_change
              FROM (SELECT run, bronze_rows, silver_rows, bronze_rows - silver_rows AS rejected_rows, null_ids,
                silver_rows / CAST(bronze_rows AS DOUBLE) * CAST(100 AS DOUBLE) AS retention_rate_pct FROM totals)""",
        ),
        "stored_silver": _SILVER_ROWS.replace("SELECT * FROM silver", f"SELECT *, {in_year} FROM silver"),
        "stored_quarantine": _QUARANTINE_ROWS.replace("SELECT * FROM tagged", f"SELECT *, {in_year} FROM tagged"),
        "stored_reconcile": _tagged(
            per_day.replace("SELECT trip_date", f"SELECT {in_year}").replace(
                "GROUP BY trip_date", "GROUP BY date_trunc('year', trip_date)"
            )
        ),
        "stream_silver": _SILVER_ROWS.replace("SELECT * FROM silver", f"SELECT *, {in_year} FROM silver"),
        "stream_first_seen": _with(TRIPS, body="SELECT DISTINCT trip_id FROM trips WHERE trip_id IS NOT NULL"),
        "stream_landed_totals": _with(
            TRIPS,
            body=f"""SELECT trip_date, {_n("COUNT(*)")} AS nb_trips, {_money("trip_total")} AS total_revenue
              FROM trips GROUP BY trip_date
              HAVING trip_date + INTERVAL 1 DAY <= (SELECT MAX(trip_start_timestamp) - INTERVAL 1 DAY FROM trips)""",
        ),
    }
