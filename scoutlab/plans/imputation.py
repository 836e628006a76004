"""Imputation plans (G15-G18, G20, G21) on the player stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoutlab.operators import impute as I
from scoutlab.plans import standins as S
from scoutlab.plans.registry import query, r

NUM = ["edad_al_momento", "mes_de_nacimiento", "altura_cm", "dias_para_fin_contrato"]
TXT = ["posicion_principal", "pie_habil", "liga_actual", "nacionalidad"]
WITH = S.sql_cte("player_obs")


def obs(spark, d):
    return S.player_obs(spark, d)


@query("impute_median", sql=WITH + "SELECT obs_id, " + ", ".join(
    f"{r(f'COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM player_obs))')} AS {c}" for c in NUM)
    + " FROM player_obs")
def q_impute_median(spark, d):
    """Exact median fill."""
    return I.impute_median(obs(spark, d).select("obs_id", *NUM), NUM)


def _mode_sql(c: str) -> str:
    return (f"(SELECT {c} FROM player_obs WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY COUNT(*) DESC, {c} LIMIT 1)")


@query("impute_mode", sql=WITH + "SELECT obs_id, " + ", ".join(
    f"COALESCE({c}, {_mode_sql(c)}) AS {c}" for c in TXT) + " FROM player_obs")
def q_impute_mode(spark, d):
    """Mode fill, ties to the smallest value."""
    return I.impute_mode(obs(spark, d).select("obs_id", *TXT), TXT)


@query("impute_constant", sql=WITH + "SELECT obs_id, COALESCE(liga_actual, 'Sin Equipo') AS liga_actual FROM player_obs")
def q_impute_constant(spark, d):
    """Constant category for missing."""
    return I.impute_constant(obs(spark, d).select("obs_id", "liga_actual"), {"liga_actual": "Sin Equipo"})


def _knn_sql_ctes(feats: list[str], key: str = "obs_id", k: int = 5, src: str = "player_obs") -> str:
    """Brute-force nan-Euclidean KNN imputation in SQL (oracle only)."""
    nf = len(feats)
    both = [f"(r.{f} IS NOT NULL AND d.{f} IS NOT NULL)" for f in feats]
    ss = " + ".join(f"CASE WHEN {b} THEN (r.{f} - d.{f}) * (r.{f} - d.{f}) ELSE 0 END" for b, f in zip(both, feats))
    cnt = " + ".join(f"CASE WHEN {b} THEN 1 ELSE 0 END" for b in both)
    parts = [f"b AS (SELECT {key}, {', '.join(feats)} FROM {src})"]
    for j, t in enumerate(feats):
        parts.append(f"""p{j} AS (SELECT r.{key} AS rid, d.{key} AS did, d.{t} AS tv, {ss} AS ss, {cnt} AS cnt
  FROM b r JOIN b d ON r.{t} IS NULL AND d.{t} IS NOT NULL)""")
        parts.append(f"""k{j} AS (SELECT rid, AVG(tv) AS v FROM (SELECT rid, tv, row_number() OVER
  (PARTITION BY rid ORDER BY sqrt({float(nf)} / cnt * ss), did) AS rk FROM p{j} WHERE cnt > 0) WHERE rk <= {k}
  GROUP BY rid)""")
    cols = ", ".join(f"COALESCE(b.{t}, k{j}.v, (SELECT AVG({t}) FROM b)) AS {t}" for j, t in enumerate(feats))
    joins = " ".join(f"LEFT JOIN k{j} ON k{j}.rid = b.{key}" for j in range(nf))
    parts.append(f"knn AS (SELECT b.{key}, {cols} FROM b {joins})")
    return ",\n".join(parts)


@query("impute_knn", sql=WITH + ", " + _knn_sql_ctes(NUM) + "\nSELECT obs_id, " + ", ".join(
    f"{r(c)} AS {c}" for c in NUM) + " FROM knn")
def q_impute_knn(spark, d):
    """G16 + J10: exact KNN fill (band-join search, no all-pairs)."""
    return I.impute_knn(obs(spark, d).select("obs_id", *NUM), "obs_id", NUM, k=5)


def _describe_sql(src: str, name: str) -> str:
    un = (f"(SELECT col_name, value FROM (UNPIVOT (SELECT {', '.join(NUM)} FROM {src}) "
          f"ON {', '.join(NUM)} INTO NAME col_name VALUE value))")
    stats = [("count", "CAST(COUNT(value) AS DOUBLE)"), ("mean", "AVG(value)"), ("std", "STDDEV_SAMP(value)"),
             ("min", "MIN(value)"), ("q25", "quantile_cont(value, 0.25)"), ("q50", "quantile_cont(value, 0.5)"),
             ("q75", "quantile_cont(value, 0.75)"), ("max", "MAX(value)")]
    return " UNION ALL ".join(f"SELECT col_name, '{s}' AS statistic, {e} AS {name} FROM {un} GROUP BY col_name"
                              for s, e in stats)


@query("impute_compare_num", sql=WITH + ", " + _knn_sql_ctes(NUM) + f""",
med AS (SELECT obs_id, {', '.join(f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM player_obs)) AS {c}" for c in NUM)}
        FROM player_obs),
o AS ({_describe_sql('player_obs', 'original')}),
m AS ({_describe_sql('med', 'median')}),
k AS ({_describe_sql('knn', 'knn')})
SELECT o.col_name, o.statistic, {r('original')} AS original, {r('median')} AS median, {r('knn')} AS knn
FROM o LEFT JOIN m USING (col_name, statistic) LEFT JOIN k USING (col_name, statistic)""")
def q_impute_compare_num(spark, d):
    """Describe of original, median-imputed and KNN-imputed."""
    base = obs(spark, d).select("obs_id", *NUM)
    return I.compare_numeric(base.select(*NUM), {
        "median": I.impute_median(base, NUM).select(*NUM),
        "knn": I.impute_knn(base, "obs_id", NUM).select(*NUM)}, NUM)


def _overlay_sql() -> str:
    parts = []
    for c in NUM:
        lines = " UNION ALL ".join(f"SELECT '{name}' AS variant, {c} AS v FROM {src}" for name, src in VARIANTS.items())
        parts.append(f"""SELECT '{c}' AS col_name, k.variant, k.i, {r('k.x')} AS x, {r('k.density', 9)} AS density FROM (
  SELECT s.variant, g.i, g.x, SUM(EXP(-0.5 * POW((g.x - l.v) / s.h, 2))) / (ANY_VALUE(s.n) * ANY_VALUE(s.h) * SQRT(2 * PI())) AS density
  FROM (SELECT variant, COUNT(v) AS n, STDDEV_SAMP(v) * POW(COUNT(v), -0.2) AS h FROM ({lines}) GROUP BY variant) s
  JOIN ({lines}) l ON l.variant = s.variant AND l.v IS NOT NULL,
       (SELECT CAST(range AS INT) AS i, lo + range * ((hi - lo) / 199) AS x FROM range(200),
          (SELECT MIN(lo) AS lo, MAX(hi) AS hi FROM (SELECT MIN(v) - 3 * STDDEV_SAMP(v) * POW(COUNT(v), -0.2) AS lo,
             MAX(v) + 3 * STDDEV_SAMP(v) * POW(COUNT(v), -0.2) AS hi FROM ({lines}) GROUP BY variant))) g
  GROUP BY s.variant, g.i, g.x) k""")
    return " UNION ALL ".join(parts)


VARIANTS = {"original": "player_obs", "median": "med", "knn": "knn"}


@query("density_overlay", round_doubles=False, sql=WITH + ", " + _knn_sql_ctes(NUM) + f""",
med AS (SELECT obs_id, {', '.join(f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM player_obs)) AS {c}" for c in NUM)}
        FROM player_obs)
""" + _overlay_sql())
def q_density_overlay(spark, d):
    """G8 + G20: densities of the original, median-filled and KNN-filled values of
    every imputed column, the three on one grid."""
    base = obs(spark, d).select("obs_id", *NUM)
    return I.compare_density(base, {"median": I.impute_median(base, NUM), "knn": I.impute_knn(base, "obs_id", NUM)}, "obs_id", NUM).withColumns(
        {"x": F.round("x", 6), "density": F.round("density", 9)})


@query("impute_summary", sql=WITH + " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_imputed, CAST({_mode_sql(c)} AS VARCHAR) AS value_used, "
    f"CAST(0 AS BIGINT) AS n_left FROM player_obs" for c in TXT) + " UNION ALL " + " UNION ALL ".join(
    f"SELECT '{c}', COUNT(*) FILTER (WHERE {c} IS NULL), CAST((SELECT quantile_cont({c}, 0.5) FROM player_obs) AS VARCHAR), "
    f"CAST(0 AS BIGINT) FROM player_obs" for c in NUM))
def q_impute_summary(spark, d):
    """Nulls filled, value used and nulls left, mode for text and median for numbers."""
    base = obs(spark, d).select("obs_id", *TXT, *NUM)
    modes, medians = I.column_modes(base, TXT), I.column_medians(base, NUM)
    after = I.impute_constant(base, modes | medians)
    return I.imputation_summary(base, after, modes | medians)


@query("impute_compare_cat", sql=WITH + f""",
md AS {_mode_sql('liga_actual')},
bf AS (SELECT COALESCE(liga_actual, 'FALTANTES') AS liga_actual, COUNT(*) AS n_before FROM player_obs
       GROUP BY 1 ORDER BY n_before DESC, liga_actual LIMIT 15),
af AS (SELECT COALESCE(COALESCE(liga_actual, (SELECT * FROM md)), 'FALTANTES') AS liga_actual, COUNT(*) AS n_after
       FROM player_obs GROUP BY 1)
SELECT liga_actual, n_before, COALESCE(n_after, 0) AS n_after FROM bf LEFT JOIN af USING (liga_actual)""")
def q_impute_compare_cat(spark, d):
    """G21 + P18 + J9: category counts before (FALTANTES shown) and after
    mode imputation, aligned on the before categories."""
    base = obs(spark, d).select("obs_id", "liga_actual")
    return I.compare_categorical(base, I.impute_mode(base, ["liga_actual"]), "liga_actual", top=15)


def _compare_cat(name: str, c: str) -> None:
    @query(name, sql=WITH + f""",
md AS {_mode_sql(c)},
bf AS (SELECT COALESCE({c}, 'FALTANTES') AS {c}, COUNT(*) AS n_before FROM player_obs
       GROUP BY 1 ORDER BY n_before DESC, {c} LIMIT 15),
af AS (SELECT COALESCE(COALESCE({c}, (SELECT * FROM md)), 'FALTANTES') AS {c}, COUNT(*) AS n_after
       FROM player_obs GROUP BY 1)
SELECT {c}, n_before, COALESCE(n_after, 0) AS n_after FROM bf LEFT JOIN af USING ({c})""")
    def q_compare(spark, d):
        base = obs(spark, d).select("obs_id", c)
        return I.compare_categorical(base, I.impute_mode(base, [c]), c, top=15)


# G21 on the other columns of the reference's comparison.
_compare_cat("impute_compare_cat_foot", "pie_habil")
_compare_cat("impute_compare_cat_nationality", "nacionalidad")


@query("impute_iterative_knn")
def q_impute_iterative(spark, d):
    """Iterative KNN-regressor imputation (rows-only check; verified
    against a brute-force implementation in tests, on either path)."""
    return I.impute_iterative_knn(obs(spark, d).select("obs_id", *NUM), "obs_id", NUM, k=5, max_iter=10)


def _player_avg_cte() -> str:
    num = [f"AVG({c}) AS {c}" for c in S.PLAYER_NUMERIC]
    txt = [f"arg_max({c}, struct_pack(f := fecha_valoracion, k := obs_id)) FILTER (WHERE {c} IS NOT NULL) AS {c}"
           for c in S.PLAYER_TEXT]
    return ("pa AS (SELECT player_id, " + ", ".join(num + txt)
            + ", MAX(fecha_valoracion) AS fecha_valoracion FROM player_obs GROUP BY player_id)")


@query("player_average_knn", sql=WITH + ", " + _player_avg_cte() + ", "
       + _knn_sql_ctes(S.PLAYER_NUMERIC, key="player_id", src="pa")
       + "\nSELECT knn.player_id, " + ", ".join(f"{r('knn.' + c)} AS {c}" for c in S.PLAYER_NUMERIC)
       + ", " + ", ".join(f"pa.{c}" for c in S.PLAYER_TEXT) + ", pa.fecha_valoracion"
       + " FROM knn JOIN pa USING (player_id)")
def q_player_average_knn(spark, d):
    """A5 + G16 (jugadores_promediados): collapse to one row per player,
    then KNN-fill the numeric columns still null (all history missing)."""
    from scoutlab.operators import players as P
    avg = P.player_average(obs(spark, d), tiebreak=("obs_id",))
    return I.impute_knn(avg, "player_id", S.PLAYER_NUMERIC, k=5)
