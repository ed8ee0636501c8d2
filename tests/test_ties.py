"""The SQL of merged intervals and of hysteresis leaves no ties to chance: many equal intervals, which DuckDB sorts anew for every window."""

import duckdb

from overlace.plans.intervals import hysteresis, merged

#: Reads with four intervals, each of them there 30 times.
MANY = "t AS (SELECT r AS rid, 1000 * k + (r * 7 + k * 13) % 300 AS beg, 1000 * k + (r * 7 + k * 13) % 300 + 500 AS fin FROM range(4000) a(r), range(4) b(k), range(30) c(i))"


def rows(text):
    return sorted(duckdb.sql(f"WITH {MANY}, {text}").fetchall())


def test_merged_intervals():
    once = merged("(SELECT DISTINCT * FROM t)")
    assert rows(f"{merged('t')} SELECT rid, beg, fin FROM mg") == rows(f"{once} SELECT rid, beg, fin FROM mg")


def test_hysteresis():
    events = "ev AS (SELECT rid, beg AS pos, 1 AS delta FROM t UNION ALL SELECT rid, fin, -1 FROM t), cv AS (SELECT rid, pos, delta, SUM(delta) OVER (PARTITION BY rid ORDER BY pos, delta ROWS UNBOUNDED PRECEDING) AS cov FROM ev)"
    assert rows(f"{events}, {hysteresis('cv', '20', '10')} SELECT rid, beg, fin FROM hy") == rows("SELECT DISTINCT rid, beg, fin FROM t")
