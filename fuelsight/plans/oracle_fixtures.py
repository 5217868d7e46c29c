"""The FIXTURES.md views written as DuckDB common table expressions.

The oracle side of every registered query starts with these, so it reads the
same raw ``events`` view the Spark side reads.
"""

from __future__ import annotations

BASE = """
ev AS (
  SELECT concat('VIN', lpad(cast(user_id AS varchar), 5, '0')) AS vin, ts, event_id AS id, event_type AS et, value AS v,
         cast(json_extract_string(props, '$.k') AS int) AS k, user_id AS u,
         cast(floor(epoch(ts) - epoch(timestamp '2024-01-01')) AS bigint) AS s
  FROM events),
r AS (SELECT *, cast(floor(s / 3600) AS bigint) % 144 AS h FROM ev)"""

SIGNALS = BASE + """,
signals AS (
  SELECT vin, ts, 'drivingSpeed' AS stype, cast(CASE WHEN et = 'error' THEN 0 ELSE k END AS double) AS value FROM r
  UNION ALL SELECT vin, ts, 'rotationlSpeed', cast(CASE WHEN et = 'signup' THEN 0 ELSE 800 + 20 * k END AS double) FROM r
  UNION ALL SELECT vin, ts, 'InsFuelInjection', cast(floor(v) * 0.25 AS double) FROM r
  UNION ALL SELECT vin, ts, 'airConditioningState', cast(k % 2 AS double) FROM r
  UNION ALL SELECT vin, ts, 'drivingMileage', cast(floor(s / 360) + u * 10 AS double) FROM r
  UNION ALL SELECT vin, ts, 'fuelLevel', cast(CASE WHEN h < 96 THEN 60 ELSE 60 - (h - 96) END AS double) FROM r
  UNION ALL SELECT vin, ts, 'fuelSupplyC-1',
            cast(CASE k % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4 ELSE 8 END AS double) FROM r)"""

FILLS = SIGNALS + """,
fills AS (
  SELECT vin, ts AS fill_start_time, k AS gas_id,
         CASE k % 3 WHEN 0 THEN '92' WHEN 1 THEN '95' ELSE '98' END AS fill_grade,
         cast(6 + 0.25 * (k % 4) AS double) AS price
  FROM ev WHERE et = 'purchase'),
processed_fills AS (
  SELECT vin, max(fill_start_time) AS fill_ts FROM fills
  WHERE fill_start_time < timestamp '2024-01-08' AND cast(right(vin, 5) AS int) % 2 = 0
  GROUP BY vin),
km_checkpoint AS (
  SELECT DISTINCT vin, 'InsFuelInjection' AS stype, 10 AS per100 FROM ev
  WHERE cast(right(vin, 5) AS int) % 2 = 0)"""


def _dense() -> str:
    def part(ms: int, stype: str, value: str, where: str = "true", null: str = "false") -> str:
        return (f"SELECT vin, ts + INTERVAL {ms} MILLISECOND AS ts, '{stype}' AS stype, "
                f"CASE WHEN NOT ({null}) THEN cast({value} AS double) END AS value FROM r WHERE {where}")

    parts = [part(ms, "InsFuelInjection", f"floor(v) * 0.25 + {j} * 0.5", null=f"(id + {j}) % 9 = 0") for j, ms in enumerate((0, 100, 150, 1000, 1100))]
    for ms in (0, 1000):
        parts += [part(ms, "drivingSpeed", "CASE WHEN et = 'error' THEN 0 ELSE k END"),
                  part(ms, "rotationlSpeed", "CASE WHEN et = 'signup' THEN 0 ELSE 800 + 20 * k END"),
                  part(ms, "fuelSupplyC-1", "CASE k % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4 ELSE 8 END")]
    parts += [part(0, "drivingMileage", "floor(s / 360) + u * 10", "id % 2 = 0", "id % 14 = 0"),
              part(0, "fuelLevel", "CASE WHEN h < 96 THEN 60 ELSE 60 - (h - 96) END", null="id % 10 = 0"),
              part(0, "airConditioningState", "k % 2"), part(0, "airConditioningState", "1 - k % 2", "id % 3 = 0")]
    return "signals AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


DENSE_FILLS = FILLS.replace(SIGNALS[len(BASE) + 2:], _dense())


def with_fixtures(body: str, recursive: bool = False, dense: bool = False) -> str:
    """Prefix a query body (which may add its own CTEs after a comma)."""
    body, views = body.strip(), (DENSE_FILLS if dense else FILLS).strip()
    head = "WITH RECURSIVE " if recursive else "WITH "
    if body.upper().startswith("SELECT"):
        return head + views + "\n" + body
    return head + views + ",\n" + body
