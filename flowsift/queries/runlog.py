"""Speed of training runs."""

from flowsift.operators import runlog as ops
from flowsift.queries.registry import query, rounded
from flowsift.queries.views import RUNLOG_SQL, over, runlog

_SPEED = RUNLOG_SQL + """,
base AS (SELECT model, time AS t0 FROM runlog WHERE n_threads = 8),
speed AS (SELECT model, n_threads, time, t0 / time AS speedup, n_threads / 8.0::DOUBLE AS n_factor,
    round(t0 / time / (n_threads / 8.0::DOUBLE) * 100, 2) AS efficiency, n_threads / 8.0::DOUBLE AS ideal_speedup
  FROM runlog JOIN base USING (model))"""


@query("bench_speedup", over(_SPEED, "SELECT model, n_threads, time, round(speedup, 8) AS speedup, n_factor, efficiency, ideal_speedup FROM speed"))
def bench_speedup(spark, folder):
    return rounded(ops.speedup(runlog(spark, folder)), 8, "speedup")


@query(
    "bench_amdahl",
    over(
        _SPEED,
        """, best AS (SELECT * FROM speed QUALIFY row_number() OVER (PARTITION BY model ORDER BY speedup DESC, n_factor) = 1),
        p AS (SELECT *, (1 - 1 / speedup) / (1 - 1 / n_factor) AS p FROM best WHERE speedup > 1 AND n_factor > 1)
        SELECT model, n_threads AS best_threads, round(speedup, 4) AS best_speedup, round(p, 4) AS p, round(1 - p, 4) AS alpha,
          CASE WHEN p <> 1 THEN round(1 / (1 - p), 2) END AS max_speedup FROM p""",
    ),
)
def bench_amdahl(spark, folder):
    return ops.amdahl(ops.speedup(runlog(spark, folder)))


@query(
    "bench_volume_ratio",
    over(
        RUNLOG_SQL,
        """SELECT model, round(max(frac) / min(frac), 8) AS volume_growth, round(arg_max(time, frac) / arg_min(time, frac), 8) AS time_growth
           FROM runlog GROUP BY 1""",
    ),
)
def bench_volume_ratio(spark, folder):
    return rounded(ops.volume_ratio(runlog(spark, folder)), 8, "volume_growth", "time_growth")
