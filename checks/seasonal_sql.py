"""The seasonal-trend decomposition as plain SQL, written out pass by pass.

Weights of the local lines come from positions alone, so this shares nothing with the fit it is
compared with. Tables hold (k series, n its length, i place from 1, y value).
"""

from __future__ import annotations


def _lines(name: str, source: str, span: int, beyond: int = 0) -> str:
    """Local lines of ``span`` points at every place, and ``beyond`` places past both ends."""
    far = "abs(p.i - g.x)"
    return f"""
{name} AS MATERIALIZED (
  SELECT k, any_value(n) AS n, x AS i,
         CASE WHEN sqrt(greatest(any_value(m2) - any_value(m1) ** 2, 0)) > 0.001::DOUBLE * (any_value(n) - 1)
              THEN any_value(my) - any_value(m1) / (any_value(m2) - any_value(m1) ** 2)
                   * (any_value(mdy) - any_value(m1) * any_value(my))
              ELSE any_value(my) END AS y
  FROM (
    SELECT k, x, any_value(n) AS n, sum(w * d) / sum(w) AS m1, sum(w * d * d) / sum(w) AS m2,
           sum(w * y) / sum(w) AS my, sum(w * d * y) / sum(w) AS mdy
    FROM (
      SELECT g.k, g.x, g.n, (p.i - g.x)::DOUBLE AS d, p.y,
             CASE WHEN {far} <= 0.001::DOUBLE * g.reach THEN 1.0::DOUBLE
                  WHEN {far} > 0.999::DOUBLE * g.reach THEN 0.0::DOUBLE
                  ELSE (1 - ({far} / g.reach::DOUBLE) ** 3) ** 3 END AS w
      FROM (
        SELECT *, greatest(abs(x - low), abs(x - high)) + greatest(0, ({span} - n) // 2) AS reach
        FROM (
          SELECT *, low + least({span}, n) - 1 AS high
          FROM (
            SELECT k, n, x, CASE WHEN {span} >= n THEN 1
                     ELSE least(greatest(x - {(span - 1) // 2}, 1), n - {span} + 1) END AS low
            FROM (SELECT k, n, unnest(range(1 - {beyond}, n + 1 + {beyond})) AS x
                  FROM (SELECT DISTINCT k, n FROM {source}))))) g
      JOIN {source} p ON p.k = g.k AND p.i BETWEEN g.low AND g.high)
    GROUP BY k, x)
  GROUP BY k, x)"""


def _average(name: str, source: str, width: int) -> str:
    """Means of ``width`` neighbours, where all of them exist."""
    return f"""
{name} AS MATERIALIZED (
  SELECT k, n, i, y FROM (
    SELECT k, n, i, count(*) OVER near AS held,
           avg(y) OVER near AS y FROM {source}
    WINDOW near AS (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND {width - 1} FOLLOWING))
  WHERE held = {width})"""


def decomposition(source: str, period: int, trend_span: int, passes: int = 5) -> str:
    """CTEs up to ``parts`` (k, i, trend, seasonal) for a table (k, n, i, y) named ``source``."""
    season_span = period + (period + 1) % 2
    level_span = period + 1 + period % 2
    steps = [f"trend0 AS (SELECT k, n, i, 0.0::DOUBLE AS y FROM {source})"]
    for j in range(1, passes + 1):
        steps += [
            f"""
sub{j} AS MATERIALIZED (
  SELECT k || ':' || ((i - 1) % {period}) AS k, k AS whole, (i - 1) % {period} AS phase,
         n AS size, count(*) OVER (PARTITION BY k, (i - 1) % {period}) AS n,
         (i - 1) // {period} + 1 AS i, s.y - t.y AS y
  FROM {source} s JOIN trend{j - 1} t USING (k, n, i))""",
            _lines(f"smooth{j}", f"sub{j}", season_span, 1),
            f"""
cycle{j} AS MATERIALIZED (
  SELECT whole AS k, size AS n, l.i * {period} + phase AS i, l.y
  FROM smooth{j} l JOIN (SELECT DISTINCT k, whole, phase, size FROM sub{j}) USING (k))""",
            _average(f"ones{j}", f"cycle{j}", period),
            _average(f"twos{j}", f"ones{j}", period),
            _average(f"threes{j}", f"twos{j}", 3),
            f"\nlevel{j} AS (SELECT k, n, i + 1 AS i, y FROM threes{j})",
            _lines(f"low{j}", f"level{j}", level_span),
            f"""
season{j} AS MATERIALIZED (
  SELECT s.k, s.n, s.i, c.y - l.y AS seasonal, s.y - (c.y - l.y) AS y
  FROM {source} s JOIN cycle{j} c ON c.k = s.k AND c.i = s.i - 1 + {period}
  JOIN low{j} l ON l.k = s.k AND l.i = s.i)""",
            _lines(f"trend{j}", f"season{j}", trend_span),
        ]
    return ",".join(steps) + f""",
parts AS MATERIALIZED (
  SELECT t.k, t.i, t.y AS trend, s.seasonal
  FROM trend{passes} t JOIN season{passes} s ON s.k = t.k AND s.i = t.i)"""
