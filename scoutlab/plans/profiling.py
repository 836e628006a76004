"""Profiling plans (G1-G14, A16, A17, A19, T10, T11) on the player and
puzzle stand-ins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from scoutlab.functions import scalar as fn
from scoutlab.operators import profile as G
from scoutlab.plans import standins as S
from scoutlab.plans.registry import query, r

PCOLS = S.PLAYER_NUMERIC
TARGET = "valor_mercado_eur_TARGET"
WITH = S.sql_cte("player_obs")
_UNPIVOT = ("long AS (SELECT col_name, value FROM (UNPIVOT (SELECT " + ", ".join(PCOLS)
            + " FROM player_obs) ON " + ", ".join(PCOLS) + " INTO NAME col_name VALUE value))\n")
WITH_LONG = WITH + ", " + _UNPIVOT


def obs(spark, d):
    return S.player_obs(spark, d)


@query("describe_numeric", sql=WITH_LONG + f"""
SELECT col_name, COUNT(value) AS count, {r('AVG(value)')} AS mean, {r('STDDEV_SAMP(value)')} AS std,
       {r('MIN(value)')} AS min, {r('quantile_cont(value, 0.25)')} AS q25,
       {r('quantile_cont(value, 0.5)')} AS q50, {r('quantile_cont(value, 0.75)')} AS q75,
       {r('MAX(value)')} AS max
FROM long GROUP BY col_name""")
def q_describe(spark, d):
    """G1 + P14 + P15 (every numeric column of the schema but the identifiers)."""
    df = obs(spark, d)
    return G.describe(df, G.existing(df, G.numeric_columns(df, ["obs_id", "player_id"])))


@query("describe_short", sql=WITH_LONG + f"""
SELECT col_name, {r('AVG(value)')} AS mean, {r('quantile_cont(value, 0.5)')} AS median,
       {r('STDDEV_SAMP(value)')} AS std, {r('MIN(value)')} AS min, {r('MAX(value)')} AS max
FROM long GROUP BY col_name""")
def q_describe_short(spark, d):
    """G2."""
    return G.describe_short(obs(spark, d), PCOLS)


@query("iqr_outliers", sql=WITH_LONG + f""",
b AS (SELECT col_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY col_name),
n AS (SELECT COUNT(*) AS n_rows FROM player_obs)
SELECT b.col_name, {r('q1')} AS q1, {r('q3')} AS q3, {r('q3 - q1')} AS iqr,
       {r('q1 - 1.5 * (q3 - q1)')} AS lower, {r('q3 + 1.5 * (q3 - q1)')} AS upper,
       COUNT(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       ROUND(COUNT(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) * 100.0
             / ANY_VALUE(n.n_rows), 2) AS pct_outliers
FROM b JOIN long USING (col_name), n GROUP BY b.col_name, q1, q3""")
def q_iqr(spark, d):
    """G3."""
    return G.iqr_outliers(obs(spark, d), PCOLS)


@query("boxplot_stats", sql=WITH_LONG + f""",
b AS (SELECT col_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM long GROUP BY col_name)
SELECT b.col_name, COUNT(*) AS n, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
  {r('MIN(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_low,
  {r('MAX(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  COUNT(*) FILTER (WHERE NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM b JOIN long USING (col_name) GROUP BY b.col_name, q1, median, q3""")
def q_boxplot(spark, d):
    """G9."""
    return G.boxplot_stats(obs(spark, d), PCOLS)


_BYCLASS_COLS = ["valor_mercado_eur_TARGET", "edad_al_momento", "goles_12m"]


@query("boxplot_by_class", sql=WITH + ", long AS (SELECT posicion_principal, col_name, value FROM (UNPIVOT "
       "(SELECT posicion_principal, " + ", ".join(_BYCLASS_COLS) + " FROM player_obs) ON "
       + ", ".join(_BYCLASS_COLS) + f""" INTO NAME col_name VALUE value)),
b AS (SELECT posicion_principal, col_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM long GROUP BY posicion_principal, col_name)
SELECT b.posicion_principal, b.col_name, COUNT(*) AS n, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
  {r('MIN(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_low,
  {r('MAX(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  COUNT(*) FILTER (WHERE NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM b JOIN long ON b.posicion_principal IS NOT DISTINCT FROM long.posicion_principal AND b.col_name = long.col_name
GROUP BY b.posicion_principal, b.col_name, q1, median, q3""")
def q_boxplot_by_class(spark, d):
    """Per category (null category kept as its own group)."""
    return G.boxplot_stats(obs(spark, d), _BYCLASS_COLS, by=["posicion_principal"])


def _box_by_sql(by: str, cols: list[str], rows: str = "player_obs") -> str:
    return ("long AS (SELECT " + by + ", col_name, value FROM (UNPIVOT (SELECT " + by + ", " + ", ".join(cols) + f" FROM {rows}) ON "
            + ", ".join(cols) + f""" INTO NAME col_name VALUE value)),
b AS (SELECT {by}, col_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM long GROUP BY {by}, col_name)
SELECT b.{by}, b.col_name, COUNT(*) AS n, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
  {r('MIN(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_low,
  {r('MAX(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  COUNT(*) FILTER (WHERE NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM b JOIN long ON b.{by} IS NOT DISTINCT FROM long.{by} AND b.col_name = long.col_name
GROUP BY b.{by}, b.col_name, q1, median, q3""")


@query("boxplot_by_position", sql=WITH + ", " + _box_by_sql("posicion_principal", PCOLS))
def q_boxplot_by_position(spark, d):
    """Every numeric column per position."""
    return G.boxplot_stats(obs(spark, d), PCOLS, by=["posicion_principal"])


@query("boxplot_by_foot", sql=WITH + ", " + _box_by_sql("pie_habil", PCOLS))
def q_boxplot_by_foot(spark, d):
    """Every numeric column per foot."""
    return G.boxplot_stats(obs(spark, d), PCOLS, by=["pie_habil"])


@query("boxplot_top_nationalities", sql=WITH + """,
top AS (SELECT nacionalidad FROM player_obs WHERE nacionalidad IS NOT NULL GROUP BY nacionalidad
        ORDER BY COUNT(*) DESC, nacionalidad LIMIT 15),
t AS (SELECT * FROM player_obs SEMI JOIN top USING (nacionalidad)),
""" + _box_by_sql("nacionalidad", [TARGET], "t"))
def q_boxplot_top_nationalities(spark, d):
    """G10 + J8: box statistics for the 15 most frequent nationalities."""
    df = obs(spark, d)
    top = G.top_categories(df, "nacionalidad", 15).select("nacionalidad")
    return G.boxplot_stats(df.join(top, "nacionalidad", "left_semi"), [TARGET], by=["nacionalidad"])


@query("boxplot_top_categories", sql=WITH + """,
top AS (SELECT liga_actual FROM player_obs WHERE liga_actual IS NOT NULL GROUP BY liga_actual
        ORDER BY COUNT(*) DESC, liga_actual LIMIT 15),
long AS (SELECT liga_actual, valor_mercado_eur_TARGET AS value FROM player_obs SEMI JOIN top USING (liga_actual)
         WHERE valor_mercado_eur_TARGET IS NOT NULL),
b AS (SELECT liga_actual, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM long GROUP BY liga_actual)
""" + f"""SELECT b.liga_actual, 'valor_mercado_eur_TARGET' AS col_name, COUNT(*) AS n, {r('q1')} AS q1,
  {r('median')} AS median, {r('q3')} AS q3,
  {r('MIN(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_low,
  {r('MAX(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  COUNT(*) FILTER (WHERE NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM b JOIN long USING (liga_actual) GROUP BY b.liga_actual, q1, median, q3""")
def q_boxplot_top(spark, d):
    """G10 + J8: box statistics for the 15 most frequent leagues (semi join)."""
    df = obs(spark, d)
    top = G.top_categories(df, "liga_actual", 15).select("liga_actual")
    return G.boxplot_stats(df.join(top, "liga_actual", "left_semi"), [TARGET], by=["liga_actual"])


def _hist_sql(col: str, bins: int) -> str:
    return WITH + f""",
mm AS (SELECT MIN({col}) AS lo0, MAX({col}) AS hi0 FROM player_obs),
e AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM mm),
c AS (SELECT CAST(LEAST(FLOOR(({col} - lo) * {bins} / (hi - lo)), {bins - 1}) AS INT) AS bin, COUNT(*) AS n
      FROM player_obs, e WHERE {col} IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INT) AS bin FROM range({bins}))
SELECT g.bin, {r(f'lo + g.bin * ((hi - lo) / {bins})')} AS lower, {r(f'lo + (g.bin + 1) * ((hi - lo) / {bins})')} AS upper,
       ROUND(lo + (g.bin + 0.5) * ((hi - lo) / {bins}), 2) AS center, CAST(COALESCE(c.n, 0) AS BIGINT) AS count
FROM g LEFT JOIN c USING (bin), e"""


@query("histogram_30", sql=_hist_sql("edad_al_momento", 30))
def q_hist30(spark, d):
    """G4."""
    return G.histogram(obs(spark, d), "edad_al_momento", 30)


@query("histogram_target", sql=_hist_sql(TARGET, 50))
def q_hist_target(spark, d):
    """G5 (raw target, 50 bins)."""
    return G.histogram(obs(spark, d), TARGET, 50)


_SAMPLE = """,
smp AS (SELECT * FROM player_obs WHERE valor_maximo_historico_previo IS NOT NULL AND valor_mercado_eur_TARGET IS NOT NULL
        ORDER BY md5(concat_ws(':', CAST(obs_id AS VARCHAR), '42')), obs_id LIMIT 30000)
"""
HIST_COLS = ["edad_al_momento", "altura_cm", "dias_para_fin_contrato", "goles_12m", "asistencias_12m", "partidos_jugados_12m",
             "participacion_goles_p90", "valor_maximo_historico_previo"]


def _hist_sample_sql() -> str:
    parts = []
    for c in HIST_COLS:
        parts.append(f"""SELECT '{c}' AS col_name, g.bin, {r('lo + g.bin * ((hi - lo) / 30)')} AS lower,
  {r('lo + (g.bin + 1) * ((hi - lo) / 30)')} AS upper, ROUND(lo + (g.bin + 0.5) * ((hi - lo) / 30), 2) AS center,
  CAST(COALESCE(n, 0) AS BIGINT) AS count
FROM (SELECT CAST(range AS INT) AS bin FROM range(30)) g, (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM smp) e
LEFT JOIN (SELECT CAST(LEAST(FLOOR(({c} - (SELECT MIN({c}) FROM smp)) * 30 / ((SELECT MAX({c}) FROM smp) - (SELECT MIN({c}) FROM smp))), 29) AS INT)
             AS bin, COUNT(*) AS n FROM smp WHERE {c} IS NOT NULL GROUP BY 1) c ON g.bin = c.bin""")
    return WITH + _SAMPLE + " UNION ALL ".join(parts)


@query("histogram_sample", sql=_hist_sample_sql())
def q_hist_sample(spark, d):
    """30-bin histograms of eight columns over the seeded 30,000-row sample."""
    df = obs(spark, d)
    s = G.exact_sample(df, 30000, "obs_id", 42, required=["valor_maximo_historico_previo", TARGET])
    frames = [G.histogram(s, c, 30).select(F.lit(c).alias("col_name"), "*") for c in HIST_COLS]
    return reduce(DataFrame.unionByName, frames)


@query("kde_curve", sql=WITH + f""",
st AS (SELECT MIN(altura_cm) AS lo, MAX(altura_cm) AS hi, COUNT(altura_cm) AS n,
              STDDEV_SAMP(altura_cm) * POW(COUNT(altura_cm), -0.2) AS h FROM player_obs),
w AS (SELECT altura_cm AS v, COUNT(*) AS w FROM player_obs WHERE altura_cm IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INT) AS i, lo - 3 * h + range * ((hi + 3 * h - (lo - 3 * h)) / 199) AS x, n, h
      FROM range(200), st)
SELECT g.i, {r('g.x')} AS x,
       {r('SUM(w.w * EXP(-0.5 * POW((g.x - w.v) / g.h, 2))) / (ANY_VALUE(g.n) * ANY_VALUE(g.h) * SQRT(2 * PI()))')}
         AS density
FROM g, w GROUP BY g.i, g.x""")
def q_kde(spark, d):
    """Gaussian KDE, Scott bandwidth, 200-point grid."""
    return G.kde_curve(obs(spark, d), "altura_cm")


def _kde_sql(c: str, rows: str = "player_obs", name: str | None = None) -> str:
    """Density of one column on its own grid, from (value, weight)."""
    return f"""SELECT '{name or c}' AS col_name, g.i, {r('g.x', 3)} AS x,
  {r('SUM(w.w * EXP(-0.5 * POW((g.x - w.v) / g.h, 2))) / (ANY_VALUE(g.n) * ANY_VALUE(g.h) * SQRT(2 * PI()))', 9)} AS density
FROM (SELECT CAST(range AS INT) AS i, lo - 3 * h + range * ((hi + 3 * h - (lo - 3 * h)) / 199) AS x, n, h FROM range(200),
      (SELECT MIN({c}) AS lo, MAX({c}) AS hi, COUNT({c}) AS n, STDDEV_SAMP({c}) * POW(COUNT({c}), -0.2) AS h FROM {rows})) g,
     (SELECT {c} AS v, COUNT(*) AS w FROM {rows} WHERE {c} IS NOT NULL GROUP BY 1) w
GROUP BY g.i, g.x"""


@query("kde_all", sql=WITH + "\nUNION ALL ".join(_kde_sql(c) for c in PCOLS), round_doubles=False)
def q_kde_all(spark, d):
    """The density curves of every numeric column in one scan (densities of
    columns in euros are small: shown to 9 decimals)."""
    return G.kde_curves(obs(spark, d), PCOLS).withColumns({"x": F.round("x", 3), "density": F.round("density", 9)})


def _hist_density_sql(c: str, bins: int = 30) -> str:
    return _hist_sql(c, bins).replace("SELECT g.bin,", f"""SELECT g.bin, {r('k.kde')} AS kde,""").replace(
        "FROM g LEFT JOIN c USING (bin), e", f"""FROM g LEFT JOIN c USING (bin), e, (
  SELECT p.bin, SUM(EXP(-0.5 * POW((p.x - o.{c}) / p.h, 2))) * ANY_VALUE(p.width / (p.h * SQRT(2 * PI()))) AS kde
  FROM player_obs o, (SELECT CAST(range AS INT) AS bin, lo + (range + 0.5) * width AS x, width, h FROM range({bins}),
    (SELECT MIN({c}) AS lo, (MAX({c}) - MIN({c})) / {bins} AS width, STDDEV_SAMP({c}) * POW(COUNT({c}), -0.2) AS h FROM player_obs)) p
  WHERE o.{c} IS NOT NULL GROUP BY p.bin) k WHERE k.bin = g.bin""")


@query("histogram_density", sql=_hist_density_sql("edad_al_momento"))
def q_histogram_density(spark, d):
    """30-bin histogram with the density curve on its scale."""
    return G.histogram_density(obs(spark, d), "edad_al_momento", 30)


LOG_TARGET = "log_target"
WITH_LOG = S.sql_cte("player_obs") + f", log_obs AS (SELECT *, ln(1 + {TARGET}) AS {LOG_TARGET} FROM player_obs)\n"


def log_obs(spark, d):
    return obs(spark, d).withColumn(LOG_TARGET, fn.log_target(TARGET))


@query("histogram_log_target", sql=_hist_sql(LOG_TARGET, 50).replace(WITH, WITH_LOG).replace("FROM player_obs),\ne AS", "FROM log_obs),\ne AS")
       .replace("FROM player_obs, e", "FROM log_obs, e"))
def q_hist_log_target(spark, d):
    """Log target, 50 bins."""
    return G.histogram(log_obs(spark, d), LOG_TARGET, 50)


@query("skewness_log_target", sql=WITH_LOG + "\nUNION ALL ".join(
    f"SELECT '{c}' AS col_name, {r(f'SKEWNESS({c})')} AS skew FROM log_obs" for c in (TARGET, LOG_TARGET)))
def q_skew_log(spark, d):
    """Skewness of the target before and after the logarithm."""
    return G.skewness(log_obs(spark, d), [TARGET, LOG_TARGET])


def _corr_sql(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    xa, xb = f"CASE WHEN {both} THEN {a} END", f"CASE WHEN {both} THEN {b} END"
    return (f"CASE WHEN STDDEV_POP({xa}) * STDDEV_POP({xb}) = 0 THEN NULL ELSE "
            f"COVAR_POP({xa}, {xb}) / (STDDEV_POP({xa}) * STDDEV_POP({xb})) END")


def _corr_matrix_sql() -> str:
    parts = []
    for a in PCOLS:
        for b in PCOLS:
            if a == b:
                e = f"CASE WHEN STDDEV_POP({a}) > 0 THEN 1.0 END"
            else:
                e = _corr_sql(a, b)
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {r(e)} AS r FROM player_obs")
    return WITH + "\nUNION ALL ".join(parts)


@query("corr_matrix", sql=_corr_matrix_sql())
def q_corr_matrix(spark, d):
    """Pairwise-complete Pearson, one aggregate pass."""
    return G.corr_matrix(obs(spark, d), PCOLS)


@query("corr_with_target", sql=WITH + "\nUNION ALL ".join(
    f"SELECT '{c}' AS col_name, {r(_corr_sql(c, TARGET))} AS r FROM player_obs" for c in PCOLS if c != TARGET))
def q_corr_target(spark, d):
    """G12."""
    return G.corr_with_target(obs(spark, d), [c for c in PCOLS if c != TARGET], TARGET)


@query("corr_with_log_target", sql=WITH_LOG + "\nUNION ALL ".join(
    f"SELECT '{c}' AS col_name, {r(_corr_sql(c, LOG_TARGET))} AS r FROM log_obs" for c in PCOLS if c != TARGET))
def q_corr_log_target(spark, d):
    """Every numeric column against the log target."""
    return G.corr_with_target(log_obs(spark, d), [c for c in PCOLS if c != TARGET], LOG_TARGET)


@query("top_correlated", sql="SELECT * FROM (" + WITH + "\nUNION ALL ".join(
    f"SELECT '{c}' AS col_name, {r(_corr_sql(c, TARGET))} AS r FROM player_obs" for c in PCOLS if c != TARGET)
    + ") ORDER BY r DESC NULLS LAST, col_name LIMIT 3")
def q_top_corr(spark, d):
    """The three columns most correlated with the target."""
    return G.top_correlated(obs(spark, d), PCOLS, TARGET, 3)


@query("regression_line", sql=WITH + "\nUNION ALL ".join(
    f"SELECT '{x}' AS x, {r(f'REGR_SLOPE({TARGET}, {x})', 3)} AS slope, "
    f"{r(f'REGR_INTERCEPT({TARGET}, {x})', 3)} AS intercept, {r(f'REGR_R2({TARGET}, {x})')} AS r2, "
    f"REGR_COUNT({TARGET}, {x}) AS n FROM player_obs" for x in PCOLS if x != TARGET))
def q_regression(spark, d):
    """G13 (slope and intercept are in euros: shown to 3 decimals)."""
    out = G.regression_line(obs(spark, d), [x for x in PCOLS if x != TARGET], TARGET)
    return out.withColumn("slope", F.round("slope", 3)).withColumn("intercept", F.round("intercept", 3))


def _band_sql(x: str, replicates: int = 1000, points: int = 100) -> str:
    weight = " ".join(f"WHEN u < {t!r} THEN {k}" for k, t in enumerate(G.poisson_thresholds()))
    return WITH + f""",
b AS (SELECT obs_id, {x} AS x, {TARGET} AS y FROM player_obs WHERE {x} IS NOT NULL AND {TARGET} IS NOT NULL),
u AS (SELECT x, y, b, CAST('0x' || substr(md5(CAST(obs_id AS VARCHAR) || ':' || CAST(b AS VARCHAR) || ':42'), 1, 8) AS BIGINT)
             / 4294967296.0::DOUBLE AS u FROM b, (SELECT CAST(range AS INT) AS b FROM range(1, {replicates + 1}))),
w AS (SELECT x, y, b, CASE {weight} ELSE {len(G.poisson_thresholds())} END AS w FROM u),
s AS (SELECT b, SUM(w)::DOUBLE AS sw, SUM(w * x) AS sx, SUM(w * y) AS sy, SUM(w * x * x) AS sxx, SUM(w * x * y) AS sxy FROM w GROUP BY b),
f AS (SELECT b, sw, sx, sy, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS m FROM s),
g AS (SELECT CAST(range AS INT) AS i, lo + range * ((hi - lo) / {points - 1}) AS gx FROM range({points}), (SELECT MIN(x) AS lo, MAX(x) AS hi FROM b))
SELECT g.i, {r('g.gx')} AS gx, {r('quantile_cont(m * gx + (sy - m * sx) / sw, 0.025)', 2)} AS lower,
       {r('quantile_cont(m * gx + (sy - m * sx) / sw, 0.975)', 2)} AS upper
FROM g, f GROUP BY g.i, g.gx"""


@query("regression_band", sql=_band_sql("partidos_seleccion_12m"))
def q_regression_band(spark, d):
    """Bootstrap band, 1,000 replicates and 100 grid points (bounds are
    in euros: shown to 2 decimals)."""
    out = G.regression_band(obs(spark, d), "partidos_seleccion_12m", TARGET, "obs_id")
    return out.withColumn("lower", F.round("lower", 2)).withColumn("upper", F.round("upper", 2))


@query("skewness_target", sql=WITH + "\nUNION ALL ".join(
    f"SELECT '{c}' AS col_name, {r(f'SKEWNESS({c})')} AS skew FROM player_obs" for c in PCOLS))
def q_skew(spark, d):
    """Bias-corrected skewness."""
    return G.skewness(obs(spark, d), PCOLS)


_ALLCOLS = [c for c, _ in S.PLAYER_OBS]


@query("null_report", sql=WITH + "\nUNION ALL ".join(
    f"SELECT '{c}' AS col_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"ROUND(COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*), 2) AS pct_null FROM player_obs "
    f"HAVING COUNT(*) FILTER (WHERE {c} IS NULL) > 0" for c in _ALLCOLS))
def q_null_report(spark, d):
    """A17."""
    return G.null_report(obs(spark, d))


@query("null_total", sql=WITH + "SELECT CAST(" + " + ".join(
    f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in S.PLAYER_NUMERIC) + " AS BIGINT) AS n_null FROM player_obs")
def q_null_total(spark, d):
    """A19."""
    return G.null_total(obs(spark, d), S.PLAYER_NUMERIC)


@query("top_categories", sql=WITH + """
SELECT nacionalidad, COUNT(*) AS n FROM player_obs WHERE nacionalidad IS NOT NULL
GROUP BY nacionalidad ORDER BY n DESC, nacionalidad LIMIT 15""")
def q_top_categories(spark, d):
    """A16."""
    return G.top_categories(obs(spark, d), "nacionalidad", 15)


@query("exact_sample", sql=WITH + """
SELECT obs_id, valor_mercado_eur_TARGET, altura_cm FROM player_obs
WHERE valor_maximo_historico_previo IS NOT NULL AND valor_mercado_eur_TARGET IS NOT NULL AND altura_cm IS NOT NULL
ORDER BY md5(concat_ws(':', CAST(obs_id AS VARCHAR), '42')), obs_id LIMIT 30000""")
def q_exact_sample(spark, d):
    """T10 + P13: exact-size seeded sample of 30,000 rows after a null drop."""
    return G.exact_sample(obs(spark, d), 30000, "obs_id", 42,
                          required=["valor_maximo_historico_previo", TARGET, "altura_cm"]).select(
        "obs_id", TARGET, "altura_cm")
