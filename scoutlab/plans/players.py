"""Scouting page (L3) and dashboard (L4) plans on the player stand-in."""

from __future__ import annotations

from scoutlab.functions.predicates import ScoutFilter
from scoutlab.operators import players as P
from scoutlab.plans import standins as S
from scoutlab.plans.registry import query, r

FILTER = ScoutFilter(value_m=(1.0, 40.0), age=(18.0, 40.0), height=(170.0, 200.0),
                     goals=(0, 12), assists=(0, 10), matches=(5, 40), reds=(0, 1),
                     leagues=["NATION_1", "NATION_4", "NATION_7", "NATION_10", "NATION_13", "NATION_16"])


def _where_sql(f: ScoutFilter) -> str:
    def rng(c, lo, hi):
        return f"COALESCE(TRY_CAST({c} AS DOUBLE) BETWEEN {float(lo)} AND {float(hi)}, false)"
    parts = [
        rng("valor_mercado_eur_TARGET", f.value_m[0] * 1e6, f.value_m[1] * 1e6),
        rng("edad_al_momento", *f.age), rng("altura_cm", *f.height),
        rng("goles_12m", *f.goals), rng("asistencias_12m", *f.assists),
        rng("partidos_jugados_12m", *f.matches), rng("tarjetas_rojas_12m", *f.reds),
    ]
    if f.leagues:
        parts.append("liga_actual IN (" + ", ".join(f"'{x}'" for x in f.leagues) + ")")
    return " AND ".join(parts)


WITH = S.sql_cte("player_obs") + f", j AS (SELECT * FROM player_obs WHERE {_where_sql(FILTER)})\n"
MILL = "ROUND(valor_mercado_eur_TARGET / 1000000, 2)"


def jugadores(spark, d):
    return S.player_obs(spark, d)


def scouted(spark, d):
    return jugadores(spark, d).filter(FILTER.column())


@query("scouting_filter", sql=WITH + "SELECT obs_id, player_id, liga_actual FROM j")
def q_scouting_filter(spark, d):
    """P6 + P8 + P9: the typed WHERE builder."""
    return scouted(spark, d).select("obs_id", "player_id", "liga_actual")


@query("scouting_topn", sql=WITH + """
SELECT id_observacion, player_id, posicion_principal, liga_actual, valor_mercado_eur_TARGET,
       edad_al_momento, goles_12m, asistencias_12m
FROM j ORDER BY valor_mercado_eur_TARGET DESC NULLS LAST, obs_id LIMIT 100""")
def q_scouting_topn(spark, d):
    """q1."""
    return P.scouting_topn(scouted(spark, d), n=100)


@query("scouting_topn_asc", sql=WITH + """
SELECT id_observacion, player_id, posicion_principal, liga_actual, valor_mercado_eur_TARGET,
       edad_al_momento, goles_12m, asistencias_12m
FROM j ORDER BY edad_al_momento ASC NULLS FIRST, obs_id LIMIT 250""")
def q_scouting_topn_asc(spark, d):
    """q1 with another column and ascending order."""
    return P.scouting_topn(scouted(spark, d), order_col="edad_al_momento", descending=False, n=250)


@query("most_valuable_top10", sql=WITH + f"""
SELECT id_observacion AS Jugador, liga_actual AS Liga, {MILL} AS Valor_Millones
FROM j ORDER BY valor_mercado_eur_TARGET DESC NULLS LAST, obs_id LIMIT 10""")
def q_most_valuable(spark, d):
    """q3."""
    return P.most_valuable_top10(scouted(spark, d))


@query("scorers_top10", sql=WITH + f"""
SELECT id_observacion AS Jugador, CAST(trunc(goles_12m) AS INT) AS Goles,
       CAST(trunc(asistencias_12m) AS INT) AS Asistencias, {MILL} AS Valor_Millones
FROM j ORDER BY Goles DESC NULLS LAST, obs_id LIMIT 10""")
def q_scorers(spark, d):
    """q4."""
    return P.scorers_top10(scouted(spark, d))


@query("discipline_top10", sql=WITH + f"""
SELECT id_observacion AS Jugador, CAST(trunc(tarjetas_rojas_12m) AS INT) AS Rojas,
       CAST(trunc(tarjetas_amarillas_12m) AS INT) AS Amarillas, {MILL} AS Valor_Millones
FROM j ORDER BY Rojas DESC NULLS LAST, Amarillas DESC NULLS LAST, obs_id LIMIT 10""")
def q_discipline(spark, d):
    """T4: q7 (P19 truncating cast)."""
    return P.discipline_top10(scouted(spark, d))


@query("contract_top10", sql=WITH + f"""
SELECT id_observacion AS Jugador, CAST(trunc(dias_para_fin_contrato) AS INT) AS Dias_Contrato,
       {MILL} AS Valor_Millones
FROM j ORDER BY Dias_Contrato DESC NULLS LAST, obs_id LIMIT 10""")
def q_contract(spark, d):
    """T5: q9."""
    return P.contract_top10(scouted(spark, d))


@query("minutes_top10", sql=WITH + f"""
SELECT id_observacion AS Jugador, CAST(trunc(minutos_jugados_12m) AS INT) AS Minutos_Jugados,
       {MILL} AS Valor_Millones
FROM j ORDER BY Minutos_Jugados DESC NULLS LAST, obs_id LIMIT 10""")
def q_minutes(spark, d):
    """q10."""
    return P.minutes_top10(scouted(spark, d))


@query("value_by_league", sql=WITH + """
SELECT liga_actual AS Liga, COUNT(*) AS Jugadores,
       ROUND(AVG(valor_mercado_eur_TARGET) / 1000000, 2) AS Valor_Promedio_M
FROM j GROUP BY liga_actual ORDER BY Valor_Promedio_M DESC NULLS LAST, Liga NULLS FIRST LIMIT 10""")
def q_value_by_league(spark, d):
    """q2."""
    return P.value_by_league(scouted(spark, d))


@query("value_by_caps", sql=WITH + """
SELECT partidos_seleccion_12m AS Partidos_Seleccion, COUNT(*) AS Total_Jugadores,
       ROUND(AVG(valor_mercado_eur_TARGET) / 1000000, 2) AS Valor_Promedio_M
FROM j GROUP BY partidos_seleccion_12m ORDER BY Partidos_Seleccion DESC NULLS LAST LIMIT 10""")
def q_value_by_caps(spark, d):
    """q5."""
    return P.value_by_caps(scouted(spark, d))


@query("physique_by_league", sql=WITH + """
SELECT liga_actual AS Liga, ROUND(AVG(altura_cm), 2) AS Altura_Promedio_cm,
       ROUND(AVG(edad_al_momento), 2) AS Edad_Promedio
FROM j GROUP BY liga_actual ORDER BY Altura_Promedio_cm DESC NULLS LAST, Liga NULLS FIRST LIMIT 10""")
def q_physique(spark, d):
    """A10: q6."""
    return P.physique_by_league(scouted(spark, d))


@query("value_by_nationality", sql=WITH + """
SELECT nacionalidad AS Pais, COUNT(*) AS Jugadores,
       ROUND(AVG(valor_mercado_eur_TARGET) / 1000000, 2) AS Valor_Promedio_M
FROM j GROUP BY nacionalidad ORDER BY Valor_Promedio_M DESC NULLS LAST, Pais NULLS FIRST LIMIT 10""")
def q_value_by_nationality(spark, d):
    """q8."""
    return P.value_by_nationality(scouted(spark, d))


_ALL = S.sql_cte("player_obs")


@query("top100_value", sql=_ALL + "SELECT * FROM player_obs "
       "ORDER BY valor_mercado_eur_TARGET DESC NULLS LAST, obs_id LIMIT 100")
def q_top100(spark, d):
    """Whole rows of the 100 most valuable observations."""
    return P.top100_value(jugadores(spark, d))


@query("football_kpis", sql=_ALL + f"""
SELECT COUNT(*) AS total_players, {r('AVG(valor_mercado_eur_TARGET) / 1e6')} AS mean_value_m,
       {r('quantile_cont(edad_al_momento, 0.5)')} AS median_age,
       {r('COALESCE(SUM(goles_12m), 0.0)')} AS total_goals,
       {r('MAX(valor_mercado_eur_TARGET) / 1e6')} AS max_value_m
FROM player_obs""")
def q_football_kpis(spark, d):
    """A6."""
    return P.football_kpis(jugadores(spark, d))


@query("distinct_values", sql=_ALL + "SELECT DISTINCT liga_actual FROM player_obs WHERE liga_actual IS NOT NULL")
def q_distinct_values(spark, d):
    """P17/U1."""
    return P.distinct_values(jugadores(spark, d), "liga_actual")


def _avg_sql() -> str:
    num = [f"{r(f'AVG({c})')} AS {c}" for c in S.PLAYER_NUMERIC]
    txt = [f"arg_max({c}, struct_pack(f := fecha_valoracion, k := obs_id)) FILTER (WHERE {c} IS NOT NULL) AS {c}"
           for c in S.PLAYER_TEXT]
    return (_ALL + "SELECT player_id, " + ", ".join(num + txt)
            + ", MAX(fecha_valoracion) AS fecha_valoracion FROM player_obs GROUP BY player_id")


@query("player_average", sql=_avg_sql())
def q_player_average(spark, d):
    """Collapse to one row per player."""
    return P.player_average(jugadores(spark, d), tiebreak=("obs_id",))
