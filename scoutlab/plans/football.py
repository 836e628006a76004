"""Football plans: club master slice (L1) on the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoutlab.operators import clubs as C
from scoutlab.plans import standins as S
from scoutlab.plans.registry import query, r

Y = S.AS_OF_YEAR

_SQUAD_SQL = f"""
squad AS (
  SELECT current_club_id,
         AVG({Y} - year(TRY_CAST(date_of_birth AS DATE))) AS AveragePlayerAge,
         AVG(height_in_cm) AS AveragePlayerHeight,
         COUNT(player_id) AS TotalPlayers,
         COALESCE(SUM(market_value_in_eur), 0.0) AS SquadMarketValue
  FROM players_raw WHERE current_club_id IS NOT NULL
  GROUP BY current_club_id HAVING COALESCE(SUM(market_value_in_eur), 0.0) > 0)
"""

_GAMES_SQL = """
gs AS (SELECT DISTINCT game_id, season FROM games WHERE game_id IS NOT NULL),
cgs AS (
  SELECT club_id, season,
         CAST(COALESCE(SUM(own_goals), 0) AS BIGINT) AS TotalGoals,
         CAST(COALESCE(SUM(is_win), 0) AS BIGINT) AS TotalWins,
         CAST(COALESCE(SUM(CASE WHEN own_goals = opponent_goals THEN 1 ELSE 0 END), 0) AS BIGINT) AS TotalDraws,
         CAST(COALESCE(SUM(CASE WHEN own_goals < opponent_goals THEN 1 ELSE 0 END), 0) AS BIGINT) AS TotalLosses,
         COUNT(game_id) AS MatchesPlayed
  FROM club_games JOIN gs USING (game_id)
  WHERE club_id IS NOT NULL AND season IS NOT NULL
  GROUP BY club_id, season),
aps AS (
  SELECT player_club_id, season,
         CAST(COALESCE(SUM(yellow_cards), 0) AS BIGINT) AS TotalYellowCards,
         CAST(COALESCE(SUM(red_cards), 0) AS BIGINT) AS TotalRedCards,
         CAST(COALESCE(SUM(assists), 0) AS BIGINT) AS TotalAssists,
         CAST(COALESCE(SUM(minutes_played), 0) AS BIGINT) AS TotalMinutesPlayed
  FROM appearances JOIN gs USING (game_id)
  WHERE player_club_id IS NOT NULL AND season IS NOT NULL
  GROUP BY player_club_id, season)
"""


@query("squad_stats", sql=S.sql_cte("players_raw") + "," + _SQUAD_SQL + f"""
SELECT current_club_id, {r('AveragePlayerAge')} AS AveragePlayerAge,
       {r('AveragePlayerHeight')} AS AveragePlayerHeight, TotalPlayers,
       {r('SquadMarketValue')} AS SquadMarketValue FROM squad""")
def q_squad_stats(spark, d):
    """A1 + P16 + P7."""
    return C.squad_stats(S.players_raw(spark, d), Y)


@query("age_from_birth", sql=S.sql_cte("players_raw") + f"""
SELECT player_id, date_of_birth, {Y} - year(TRY_CAST(date_of_birth AS DATE)) AS age
FROM players_raw""")
def q_age_from_birth(spark, d):
    """Bad dates become null ages."""
    return C.age_from_birth(S.players_raw(spark, d), as_of_year=Y).select(
        "player_id", "date_of_birth", "age")


@query("match_flags", sql=S.sql_cte("club_games") + """
SELECT game_id, club_id,
       CAST(COALESCE(own_goals = opponent_goals, false) AS INT) AS is_draw,
       CAST(COALESCE(own_goals < opponent_goals, false) AS INT) AS is_loss
FROM club_games""")
def q_match_flags(spark, d):
    """P3."""
    return C.match_flags(S.club_games(spark, d)).select("game_id", "club_id", "is_draw", "is_loss")


@query("club_season_stats", sql=S.sql_cte("games", "club_games", "appearances") + "," + _GAMES_SQL
       + "SELECT * FROM cgs")
def q_club_season_stats(spark, d):
    """A2 + A4 + J1."""
    return C.club_season_stats(S.club_games(spark, d), S.games(spark, d))


@query("appearance_season_stats", sql=S.sql_cte("games", "club_games", "appearances") + ","
       + _GAMES_SQL + "SELECT * FROM aps")
def q_appearance_season_stats(spark, d):
    """A3 + J2."""
    return C.appearance_season_stats(S.appearances(spark, d), S.games(spark, d))


@query("latest_season", sql=S.sql_cte("games", "club_games", "appearances") + "," + _GAMES_SQL + """
SELECT * FROM cgs QUALIFY row_number() OVER (PARTITION BY club_id ORDER BY season DESC) = 1""")
def q_latest_season(spark, d):
    """W1 over A2."""
    return C.latest_per_key(C.club_season_stats(S.club_games(spark, d), S.games(spark, d)),
                            "club_id", "season")


_MASTER_SQL = (S.sql_cte("players_raw", "clubs", "competitions", "games", "club_games", "appearances")
               + "," + _SQUAD_SQL + "," + _GAMES_SQL + """,
gl AS (SELECT * FROM cgs QUALIFY row_number() OVER (PARTITION BY club_id ORDER BY season DESC) = 1),
al AS (SELECT * FROM aps QUALIFY row_number() OVER (PARTITION BY player_club_id ORDER BY season DESC) = 1),
m AS (
  SELECT c.name AS ClubName, k.name AS LeagueName, k.country_name AS Country,
         s.SquadMarketValue / 1000000 AS SquadMarketValue,
         c.stadium_seats AS StadiumCapacity, c.foreigners_percentage AS ForeignersPercentage,
         c.national_team_players AS NationalTeamPlayers,
         s.AveragePlayerAge, s.AveragePlayerHeight, s.TotalPlayers,
         gl.TotalGoals, gl.TotalWins, gl.TotalDraws, gl.TotalLosses, gl.MatchesPlayed,
         al.TotalYellowCards, al.TotalRedCards, al.TotalAssists, al.TotalMinutesPlayed
  FROM gl LEFT JOIN al ON gl.club_id = al.player_club_id
  JOIN clubs c ON gl.club_id = c.club_id
  JOIN competitions k ON c.domestic_competition_id = k.competition_id
  JOIN squad s ON gl.club_id = s.current_club_id)
""")

_MASTER_SELECT = f"""
SELECT ClubName, LeagueName, Country, {r('SquadMarketValue')} AS SquadMarketValue,
       StadiumCapacity, {r('ForeignersPercentage')} AS ForeignersPercentage, NationalTeamPlayers,
       {r('AveragePlayerAge')} AS AveragePlayerAge, {r('AveragePlayerHeight')} AS AveragePlayerHeight,
       TotalPlayers, TotalGoals, TotalWins, TotalDraws, TotalLosses, MatchesPlayed,
       CASE WHEN TotalMinutesPlayed = 0 THEN NULL ELSE TotalYellowCards END AS TotalYellowCards,
       CASE WHEN TotalMinutesPlayed = 0 THEN NULL ELSE TotalRedCards END AS TotalRedCards,
       CASE WHEN TotalMinutesPlayed = 0 THEN NULL ELSE TotalAssists END AS TotalAssists,
       CASE WHEN TotalMinutesPlayed = 0 THEN NULL ELSE TotalMinutesPlayed END AS TotalMinutesPlayed
FROM m"""


def club_master_df(spark, d):
    return C.club_master(S.players_raw(spark, d), S.clubs(spark, d), S.competitions(spark, d),
                         S.club_games(spark, d), S.appearances(spark, d), S.games(spark, d), Y)


@query("club_master", sql=_MASTER_SQL + _MASTER_SELECT)
def q_club_master(spark, d):
    """Flagship: L1 end to end."""
    return club_master_df(spark, d)


@query("null_false_zeros", sql=_MASTER_SQL + """
SELECT ClubName,
       CASE WHEN TotalMinutesPlayed = 0 THEN NULL ELSE TotalYellowCards END AS TotalYellowCards,
       CASE WHEN TotalMinutesPlayed = 0 THEN NULL ELSE TotalMinutesPlayed END AS TotalMinutesPlayed,
       COALESCE(TotalMinutesPlayed = 0, false) AS was_false_zero
FROM m""")
def q_null_false_zeros(spark, d):
    """P5 in isolation: the mask and two of the nulled columns."""
    pre = C.club_master(S.players_raw(spark, d), S.clubs(spark, d), S.competitions(spark, d),
                        S.club_games(spark, d), S.appearances(spark, d), S.games(spark, d), Y,
                        null_out=False)
    flagged = pre.withColumn("was_false_zero",
                             F.coalesce(F.col("TotalMinutesPlayed") == 0, F.lit(False)))
    return C.null_false_zeros(flagged).select(
        "ClubName", "TotalYellowCards", "TotalMinutesPlayed", "was_false_zero")
