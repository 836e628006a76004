"""Player-table operators: the scouting query set
and the per-player collapse (A5/W2, X2).

Every top-N is ``orderBy(...).limit(n)``, which plans as
``TakeOrderedAndProject``: each task keeps its own n best rows and only
those are merged, so no full sort or shuffle of the filtered table runs.
The entity key is appended as the last sort key so ties are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from scoutlab.operators.selection import quantiles

VALUE = "valor_mercado_eur_TARGET"
KEY = "obs_id"


def millions(c: str, digits: int = 2) -> Column:
    """P4 + F6: euros to millions, rounded."""
    return F.round(F.col(c).try_cast("double") / F.lit(1_000_000), digits)


def as_int(c: str) -> Column:
    """Numeric cast to int truncating toward zero (SQLite semantics)."""
    return F.col(c).try_cast("double").try_cast("int")


def scouting_topn(df: DataFrame, order_col: str = VALUE, descending: bool = True,
                  n: int = 100, key: str = KEY) -> DataFrame:
    """q1 — user-chosen sort column, direction and limit."""
    sort = F.col(order_col).try_cast("double")
    sort = sort.desc_nulls_last() if descending else sort.asc_nulls_first()
    return (df.orderBy(sort, F.col(key).asc()).limit(n)
            .select("id_observacion", "player_id", "posicion_principal", "liga_actual",
                    VALUE, "edad_al_momento", "goles_12m", "asistencias_12m"))


def most_valuable_top10(df: DataFrame, key: str = KEY) -> DataFrame:
    """q3."""
    return (df.orderBy(F.col(VALUE).desc_nulls_last(), F.col(key)).limit(10)
            .select(F.col("id_observacion").alias("Jugador"), F.col("liga_actual").alias("Liga"),
                    millions(VALUE).alias("Valor_Millones")))


def _top10_by_int(df: DataFrame, cols: Sequence[tuple[str, str]], key: str) -> DataFrame:
    projected = df.select(F.col("id_observacion").alias("Jugador"),
                          *[as_int(src).alias(name) for src, name in cols],
                          millions(VALUE).alias("Valor_Millones"), F.col(key))
    order = [F.col(name).desc_nulls_last() for _, name in cols] + [F.col(key)]
    return projected.orderBy(*order).limit(10).drop(key)


def scorers_top10(df: DataFrame, key: str = KEY) -> DataFrame:
    """q4 — ordered by goals only, assists shown."""
    projected = df.select(F.col("id_observacion").alias("Jugador"),
                          as_int("goles_12m").alias("Goles"),
                          as_int("asistencias_12m").alias("Asistencias"),
                          millions(VALUE).alias("Valor_Millones"), F.col(key))
    return projected.orderBy(F.col("Goles").desc_nulls_last(), F.col(key)).limit(10).drop(key)


def discipline_top10(df: DataFrame, key: str = KEY) -> DataFrame:
    """T4: q7 — red cards, then yellow cards."""
    return _top10_by_int(df, [("tarjetas_rojas_12m", "Rojas"),
                              ("tarjetas_amarillas_12m", "Amarillas")], key)


def contract_top10(df: DataFrame, key: str = KEY) -> DataFrame:
    """T5: q9 — days to contract end (nulls last, as SQLite's DESC)."""
    return _top10_by_int(df, [("dias_para_fin_contrato", "Dias_Contrato")], key)


def minutes_top10(df: DataFrame, key: str = KEY) -> DataFrame:
    """q10."""
    return _top10_by_int(df, [("minutos_jugados_12m", "Minutos_Jugados")], key)


def _grouped_top10(df: DataFrame, group_col: str, alias: str, aggs: list[Column],
                   order_col: str, descending: bool = True) -> DataFrame:
    """Shared shape of q2/q5/q6/q8: group (null key kept, as SQL does),
    aggregate, order, limit 10; the group key breaks ties."""
    g = df.groupBy(F.col(group_col).alias(alias)).agg(*aggs)
    o = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()
    return g.orderBy(o, F.col(alias).asc_nulls_first()).limit(10)


def value_by_league(df: DataFrame) -> DataFrame:
    """q2."""
    return _grouped_top10(df, "liga_actual", "Liga", [
        F.count(F.lit(1)).alias("Jugadores"),
        F.round(F.avg(F.col(VALUE).try_cast("double")) / 1_000_000, 2).alias("Valor_Promedio_M"),
    ], "Valor_Promedio_M")


def value_by_caps(df: DataFrame) -> DataFrame:
    """q5 — ordered by the number of national-team matches."""
    return _grouped_top10(df, "partidos_seleccion_12m", "Partidos_Seleccion", [
        F.count(F.lit(1)).alias("Total_Jugadores"),
        F.round(F.avg(F.col(VALUE).try_cast("double")) / 1_000_000, 2).alias("Valor_Promedio_M"),
    ], "Partidos_Seleccion")


def physique_by_league(df: DataFrame) -> DataFrame:
    """A10: q6."""
    return _grouped_top10(df, "liga_actual", "Liga", [
        F.round(F.avg(F.col("altura_cm").try_cast("double")), 2).alias("Altura_Promedio_cm"),
        F.round(F.avg(F.col("edad_al_momento").try_cast("double")), 2).alias("Edad_Promedio"),
    ], "Altura_Promedio_cm")


def value_by_nationality(df: DataFrame) -> DataFrame:
    """q8."""
    return _grouped_top10(df, "nacionalidad", "Pais", [
        F.count(F.lit(1)).alias("Jugadores"),
        F.round(F.avg(F.col(VALUE).try_cast("double")) / 1_000_000, 2).alias("Valor_Promedio_M"),
    ], "Valor_Promedio_M")


def top100_value(df: DataFrame, n: int = 100, key: str = KEY) -> DataFrame:
    """The whole row of the n most valuable observations, nulls last."""
    return df.orderBy(F.col(VALUE).desc_nulls_last(), F.col(key)).limit(n)


def football_kpis(df: DataFrame) -> DataFrame:
    """Row count, mean value (M), median age, total goals, max value (M).
    The median is exact, as pandas computes it, by bracketed selection."""
    v = F.col(VALUE).try_cast("double")
    age = df.select(F.col("edad_al_momento").try_cast("double").alias("age"))
    median = quantiles(age, ["age"], [0.5])[()]["age", 0.5]
    return df.agg(
        F.count(F.lit(1)).alias("total_players"),
        (F.avg(v) / 1e6).alias("mean_value_m"),
        F.lit(median).cast("double").alias("median_age"),
        F.coalesce(F.sum(F.col("goles_12m").try_cast("double")), F.lit(0.0)).alias("total_goals"),
        (F.max(v) / 1e6).alias("max_value_m"),
    )


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """Distinct non-null options of a column."""
    return df.select(c).filter(F.col(c).isNotNull()).distinct()


def player_average(df: DataFrame, key: str = "player_id", order_col: str = "fecha_valoracion",
                   tiebreak: Sequence[str] = (), drop: Sequence[str] = ("id_observacion",)) -> DataFrame:
    """One row per player — mean of every numeric column and the
    most recent non-null value of every text column.

    The rule set is built from the schema (X2).  "Most recent" is
    ``max_by(c, order)`` with the order set to null where ``c`` is null (so
    null values are skipped, as pandas ``last`` does): an aggregate with a
    map-side partial, so a player holding a third of all rows is combined
    per task before the shuffle; no window or sort of the table runs.
    ``tiebreak`` columns make "most recent" unique and are not output.
    """
    skip = set(drop) | {key} | set(tiebreak)
    order = F.struct(F.col(order_col), *[F.col(c) for c in tiebreak])
    aggs = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.NumericType):
            aggs.append(F.avg(f.name).alias(f.name))
        else:
            aggs.append(F.max_by(F.col(f.name), F.when(F.col(f.name).isNotNull(), order)).alias(f.name))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
