"""Distribution and bivariate statistics."""

from flowsift.operators import distribution as dist
from flowsift.operators import moments
from flowsift.queries.registry import query, rounded, table
from flowsift.queries.views import FEAT_SQL, FLOWS_SQL, feat, flows, over

_BINS, _GRID = 50, 64


def _hist_sql(source: str, column: str = "price", bins: int = _BINS) -> str:
    return f"""
    , x AS (SELECT {column} AS v FROM {source}), m AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n FROM x),
    h AS (SELECT greatest(least(floor((v - lo) / ((hi - lo) / {bins}))::INT, {bins - 1}), 0) AS bin, count(*) AS k FROM x, m GROUP BY 1),
    b AS (SELECT range::INT AS bin FROM range({bins}))
    SELECT bin, round(lo + bin * (hi - lo) / {bins}, 4) AS low, round(lo + (bin + 1) * (hi - lo) / {bins}, 4) AS high,
      coalesce(k, 0) AS n_rows, round(coalesce(k, 0) / (n * (hi - lo) / {bins}), 10) AS density
    FROM b LEFT JOIN h USING (bin), m"""


def _rounded_hist(df):
    return rounded(rounded(df, 4, "low", "high"), 10, "density")


@query("dist_histogram", over(FEAT_SQL, _hist_sql("feat")))
def dist_histogram(spark, folder):
    return _rounded_hist(dist.histogram(feat(spark, folder), "price", _BINS))


_TRIMMED = """, t AS (SELECT * FROM feat WHERE price BETWEEN (SELECT quantile_cont(price, 0.005) FROM feat)
    AND (SELECT quantile_cont(price, 0.995) FROM feat))"""


@query("dist_histogram_trim", over(FEAT_SQL, _TRIMMED + _hist_sql("t")))
def dist_histogram_trim(spark, folder):
    return _rounded_hist(dist.histogram_trimmed(feat(spark, folder), "price", 0.005, 0.995, _BINS))


def _kde_sql(source: str, by: str = "") -> str:
    key, group = (f'"{by}", ', f'GROUP BY "{by}"') if by else ("", "")
    using = f'USING ("{by}")' if by else "ON true"
    return f"""
    , m AS (SELECT {key}count(*) AS n, min(price) AS lo, max(price) AS hi, stddev_samp(price) AS sd FROM {source} {group}),
    g AS (SELECT {key}range::INT AS point, lo - (hi - lo) * 0.5::DOUBLE + range * (hi - lo) * 2 / {_GRID - 1} AS x,
            n, sd * pow(n, -0.2::DOUBLE) AS w FROM m, range({_GRID}))
    SELECT {key}point, round(x, 4) AS x, round(sum(exp(-0.5::DOUBLE * pow((x - price) / w, 2))) / (n * w * sqrt(2 * pi())), 11) AS density
    FROM g JOIN {source} {using} GROUP BY {key}point, x, n, w"""


def _rounded_kde(df):
    return rounded(rounded(df, 4, "x"), 11, "density")


@query("dist_kde", over(FEAT_SQL, _kde_sql("feat")))
def dist_kde(spark, folder):
    return _rounded_kde(dist.density(feat(spark, folder), "price", _GRID))


@query(
    "dist_class_ridge",
    over(
        FEAT_SQL,
        """, q AS (SELECT "Label", quantile_cont(price, 0.01) AS a, quantile_cont(price, 0.99) AS z FROM feat GROUP BY 1),
        t AS (SELECT "Label", price FROM feat JOIN q USING ("Label") WHERE price BETWEEN a AND z)"""
        + _kde_sql("t", "Label"),
    ),
)
def dist_class_ridge(spark, folder):
    return _rounded_kde(dist.ridge(feat(spark, folder), "price", grid=_GRID))


_COLUMNS = ["quantity", "price", "tax"]


def _each(select: str) -> str:
    return " UNION ALL ".join(select.replace("@", n) for n in _COLUMNS)


@query(
    "dist_class_quartiles",
    over(
        FEAT_SQL,
        _each(
            """SELECT "Label", '@' AS "column", count(@) AS n, round(quantile_cont(@, 0.25), 6) AS q1,
               round(quantile_cont(@, 0.5), 6) AS median, round(quantile_cont(@, 0.75), 6) AS q3 FROM feat GROUP BY 1"""
        ),
    ),
)
def dist_class_quartiles(spark, folder):
    return rounded(dist.class_quartiles(feat(spark, folder), _COLUMNS), 6, "q1", "median", "q3")


@query(
    "dist_class_quartiles_panel",
    over(
        FEAT_SQL,
        """SELECT rarity, 'price' AS "column", count(price) AS n, round(quantile_cont(price, 0.25), 6) AS q1,
             round(quantile_cont(price, 0.5), 6) AS median, round(quantile_cont(price, 0.75), 6) AS q3
           FROM feat WHERE rarity IN ('common', 'mid') GROUP BY 1""",
    ),
)
def dist_class_quartiles_panel(spark, folder):
    """One panel of classes, with one class holding nine rows of ten."""
    out = dist.class_quartiles(feat(spark, folder), ["price"], "rarity", ["common", "mid"])
    return rounded(out, 6, "q1", "median", "q3")


@query(
    "dist_trim_report",
    over(
        FEAT_SQL,
        """, q AS (SELECT quantile_cont(price, 0.01) AS a, quantile_cont(price, 0.99) AS z FROM feat)
        SELECT round(a, 6) AS low, round(z, 6) AS high, count(*) AS n_total, count_if(price BETWEEN a AND z)::BIGINT AS n_kept,
          count(*) - count_if(price BETWEEN a AND z)::BIGINT AS n_excluded,
          round((count(*) - count_if(price BETWEEN a AND z)) * 100.0::DOUBLE / count(*), 4) AS pct_excluded
        FROM feat, q GROUP BY a, z""",
    ),
)
def dist_trim_report(spark, folder):
    return rounded(dist.trim_report(feat(spark, folder), "price", 0.01, 0.99), 6, "low", "high")


_INSIDE = "v BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)"


def _box_sql(values: str, keys: str) -> str:
    """Box statistics of `v` per `keys` over the rows of `values`."""
    return f""", l AS ({values}), q AS (SELECT {keys}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
      quantile_cont(v, 0.75) AS q3 FROM l GROUP BY ALL)
    SELECT {keys}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
      round(least(min(CASE WHEN {_INSIDE} THEN v END), q1), 6) AS whisker_low,
      round(greatest(max(CASE WHEN {_INSIDE} THEN v END), q3), 6) AS whisker_high,
      count_if(NOT {_INSIDE})::BIGINT AS n_outliers, count(*) AS n_rows
    FROM l JOIN q USING ({keys}) GROUP BY {keys}, q.q1, q.median, q.q3"""


_BY_LABEL = """SELECT "Label", 'price_net' AS "column", price_net AS v FROM """
_BOX_VALUES = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@query("dist_box_stats", over(FEAT_SQL, _box_sql(_BY_LABEL + "feat", '"Label", "column"')))
def dist_box_stats(spark, folder):
    return rounded(dist.box_stats(feat(spark, folder), ["price_net"], "Label"), 6, *_BOX_VALUES)


@query(
    "dist_box_stats_columns",
    over(FEAT_SQL, _box_sql(_each("""SELECT '@' AS "column", @::DOUBLE AS v FROM feat"""), '"column"')),
)
def dist_box_stats_columns(spark, folder):
    return rounded(dist.box_stats(feat(spark, folder), _COLUMNS), 6, *_BOX_VALUES)


@query(
    "dist_box_stats_trim",
    over(
        FEAT_SQL,
        """, t AS (SELECT * FROM feat WHERE price_net BETWEEN (SELECT quantile_cont(price_net, 0.01) FROM feat)
             AND (SELECT quantile_cont(price_net, 0.99) FROM feat))"""
        + _box_sql(_BY_LABEL + "t", '"Label", "column"'),
    ),
)
def dist_box_stats_trim(spark, folder):
    return rounded(dist.box_stats_trimmed(feat(spark, folder), "price_net", "Label"), 6, *_BOX_VALUES)


_POINTS = dist.normal_positions(25)
_QQ = " UNION ALL ".join(
    f"SELECT {i}::INT AS point, {p!r}::DOUBLE AS prob, {z!r}::DOUBLE AS theoretical, quantile_cont(price, {p!r}::DOUBLE) AS sample FROM feat"
    for i, (p, z) in enumerate(_POINTS)
)


@query(
    "dist_qq_normal",
    over(FEAT_SQL, f"""SELECT 'price' AS "column", point, round(prob, 6) AS prob, round(theoretical, 6) AS theoretical, round(sample, 6) AS sample FROM ({_QQ})"""),
)
def dist_qq_normal(spark, folder):
    return rounded(dist.qq_normal(feat(spark, folder), "price", 25), 6, "prob", "theoretical", "sample")


@query(
    "dist_qq_fit",
    over(
        FEAT_SQL,
        f"""SELECT 'price' AS "column", round(regr_slope(sample, theoretical), 4) AS slope,
              round(regr_intercept(sample, theoretical), 4) AS intercept, round(corr(sample, theoretical), 8) AS r FROM ({_QQ})""",
    ),
)
def dist_qq_fit(spark, folder):
    fit = dist.qq_fit(dist.qq_normal(feat(spark, folder), "price", 25))
    return rounded(rounded(fit, 4, "slope", "intercept"), 8, "r")


CORR_NAMES = ["quantity", "price", "discount", "tax", "linenumber", "price_net", "price_usd", "day_of_week"]


def corr_sql() -> str:
    """All ordered pairs as (i, j, x, y, r)."""
    cells = []
    for i, x in enumerate(CORR_NAMES):
        for j, y in enumerate(CORR_NAMES):
            r = "max(1.0::DOUBLE)" if i == j else f"corr({x}, {y})"
            cells.append(f"SELECT {i}::INT AS i, {j}::INT AS j, '{x}' AS x, '{y}' AS y, {r} AS r FROM feat")
    return " UNION ALL ".join(cells)


@query("corr_matrix", over(FEAT_SQL, f"SELECT i, j, x, y, round(r, 8) AS r FROM ({corr_sql()})"))
def corr_matrix(spark, folder):
    return rounded(moments.correlation(feat(spark, folder), CORR_NAMES), 8, "r")


@query(
    "corr_high_pairs",
    over(FEAT_SQL, f"SELECT i, j, x, y, round(r, 8) AS r FROM ({corr_sql()}) WHERE i < j AND abs(r) > 0.9"),
)
def corr_high_pairs(spark, folder):
    return rounded(dist.high_pairs(moments.correlation(feat(spark, folder), CORR_NAMES), 0.9), 8, "r")


@query(
    "dist_grid_2d",
    over(
        FEAT_SQL,
        """, q AS (SELECT quantile_cont(price, 0.02) AS a, quantile_cont(price, 0.98) AS b,
              quantile_cont(quantity, 0.02) AS c, quantile_cont(quantity, 0.98) AS d FROM feat),
        t AS (SELECT price AS x, quantity AS y FROM feat, q WHERE price BETWEEN a AND b AND quantity BETWEEN c AND d),
        m AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM t)
        SELECT least(floor((x - x0) / ((x1 - x0) / 40))::INT, 39) AS cell_x, least(floor((y - y0) / ((y1 - y0) / 40))::INT, 39) AS cell_y,
          count(*) AS n_rows FROM t, m GROUP BY 1, 2""",
    ),
)
def dist_grid_2d(spark, folder):
    return dist.grid_2d(feat(spark, folder), "price", "quantity")


def _trim_chain(names):
    parts, source = [], "feat"
    for i, n in enumerate(names):
        parts.append(f"q{i} AS (SELECT quantile_cont({n}, 0.02) AS a, quantile_cont({n}, 0.98) AS z FROM {source})")
        parts.append(f"r{i} AS (SELECT * FROM {source} WHERE {n} BETWEEN (SELECT a FROM q{i}) AND (SELECT z FROM q{i}))")
        source = f"r{i}"
    rows = " UNION ALL ".join(
        f"""SELECT {i}::INT AS step_no, '{n}' AS "column", round((SELECT a FROM q{i}), 6) AS low,
            round((SELECT z FROM q{i}), 6) AS high, (SELECT count(*) FROM r{i}) AS rows_left"""
        for i, n in enumerate(names)
    )
    return ", " + ", ".join(parts) + " " + rows


@query("dist_trim_sequential", over(FEAT_SQL, _trim_chain(["price", "discount", "quantity"])))
def dist_trim_sequential(spark, folder):
    _, report = dist.trim_sequential(feat(spark, folder), ["price", "discount", "quantity"])
    return rounded(report, 6, "low", "high")


def _scaled(n: str) -> str:
    q = f"(SELECT quantile_cont({n}, {{}}) FROM feat)"
    return (
        f"round(least(greatest(({n} - {q.format(0.5)}) / ({q.format(0.75)} - {q.format(0.25)}), -5.0::DOUBLE), 5.0::DOUBLE), 6) AS {n}"
    )


@query(
    "scale_robust_clip",
    over(FEAT_SQL, f"SELECT l_orderkey, l_linenumber, {_scaled('price')}, {_scaled('quantity')} FROM feat"),
)
def scale_robust_clip(spark, folder):
    out = dist.robust_scale(feat(spark, folder), ["price", "quantity"])
    return rounded(out.select("l_orderkey", "l_linenumber", "price", "quantity"), 6, "price", "quantity")


@query(
    "class_ellipse",
    over(
        FEAT_SQL,
        """SELECT "Label", count(*) AS n_rows, round(avg(price), 4) AS centre_x, round(avg(quantity), 4) AS centre_y,
             round(stddev_samp(price) * 2, 4) AS scale_x, round(stddev_samp(quantity) * 2, 4) AS scale_y,
             round(sqrt(1 + corr(price, quantity)), 6) AS radius_x, round(sqrt(1 - corr(price, quantity)), 6) AS radius_y,
             count(*) > 50 AS drawn FROM feat GROUP BY 1""",
    ),
)
def class_ellipse(spark, folder):
    out = dist.class_ellipse(feat(spark, folder), "price", "quantity")
    return rounded(rounded(out, 4, "centre_x", "centre_y", "scale_x", "scale_y"), 6, "radius_x", "radius_y")


_RATES = """SELECT event_type, 'Flow Byts/s' AS "column", "Flow Byts/s" AS v FROM flows JOIN events USING (event_id) WHERE isfinite("Flow Byts/s")"""


def _rates(spark, folder):
    """A column with infinities, NaN and nulls, per event type."""
    types = table(spark, folder, "events").select("event_id", "event_type")
    return flows(spark, folder).join(types, "event_id")


@query("dist_box_stats_dirty", over(FLOWS_SQL, _box_sql(_RATES, 'event_type, "column"')))
def dist_box_stats_dirty(spark, folder):
    return rounded(dist.box_stats(_rates(spark, folder), ["Flow Byts/s"], "event_type"), 6, *_BOX_VALUES)


@query(
    "class_ellipse_dirty",
    over(
        FLOWS_SQL,
        """SELECT event_type AS "Label", count(*) AS n_rows, round(avg("Flow Byts/s"), 4) AS centre_x, round(avg("Init Win Byts"), 4) AS centre_y,
             round(stddev_samp("Flow Byts/s") * 2, 4) AS scale_x, round(stddev_samp("Init Win Byts") * 2, 4) AS scale_y,
             round(sqrt(1 + corr("Flow Byts/s", "Init Win Byts")), 6) AS radius_x,
             round(sqrt(1 - corr("Flow Byts/s", "Init Win Byts")), 6) AS radius_y, count(*) > 50 AS drawn
           FROM flows JOIN events USING (event_id) WHERE isfinite("Flow Byts/s") GROUP BY 1""",
    ),
)
def class_ellipse_dirty(spark, folder):
    out = dist.class_ellipse(_rates(spark, folder), "Flow Byts/s", "Init Win Byts", "event_type")
    return rounded(rounded(out, 4, "centre_x", "centre_y", "scale_x", "scale_y"), 6, "radius_x", "radius_y")
