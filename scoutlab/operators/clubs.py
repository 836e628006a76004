"""Club master integration.

The whole integration is one lazy plan with one action at the end:
two fact tables are grouped to (club, season) — partial aggregation runs
map-side, so a hot club costs no more shuffle than any other — and all
later joins are between per-club results, which are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

FALSE_ZERO_COLUMNS = ["TotalYellowCards", "TotalRedCards", "TotalAssists", "TotalMinutesPlayed"]

# Output column order of the club master (fixed by the reference).
CLUB_MASTER_COLUMNS = [
    "ClubName", "LeagueName", "Country", "SquadMarketValue",
    "StadiumCapacity", "ForeignersPercentage", "NationalTeamPlayers",
    "AveragePlayerAge", "AveragePlayerHeight", "TotalPlayers",
    "TotalGoals", "TotalWins", "TotalDraws", "TotalLosses", "MatchesPlayed",
    "TotalYellowCards", "TotalRedCards", "TotalAssists", "TotalMinutesPlayed",
]


def age_from_birth(players: DataFrame, dob_col: str = "date_of_birth",
                   as_of_year: int = 2025, out: str = "age") -> DataFrame:
    """Coerce the birth date (bad text -> null) and derive the age in
    whole years relative to ``as_of_year``."""
    dob = F.col(dob_col).try_cast("date")
    return players.withColumn(out, F.lit(as_of_year) - F.year(dob))


def squad_stats(players: DataFrame, as_of_year: int = 2025) -> DataFrame:
    """A1 + P16: per current club, mean age, mean height, player count and
    total market value; clubs whose total value is not positive are dropped.
    Null club ids are dropped first (pandas groupby drops null keys)."""
    p = age_from_birth(players, as_of_year=as_of_year)
    return (
        p.filter(F.col("current_club_id").isNotNull())
        .groupBy("current_club_id")
        .agg(
            F.avg("age").alias("AveragePlayerAge"),
            F.avg("height_in_cm").alias("AveragePlayerHeight"),
            F.count("player_id").alias("TotalPlayers"),
            F.coalesce(F.sum("market_value_in_eur"), F.lit(0.0)).alias("SquadMarketValue"),
        )
        .filter(F.col("SquadMarketValue") > 0)
    )


def game_seasons(games: DataFrame) -> DataFrame:
    """A4: distinct (game_id, season) pairs; null ids are bad data."""
    return games.select("game_id", "season").filter(F.col("game_id").isNotNull()).distinct()


def with_season(facts: DataFrame, games: DataFrame) -> DataFrame:
    """Attach the season to fact rows by an inner equi-join on
    ``game_id``.  Both sides are keyed by game; Catalyst picks a sort-merge
    join (or a broadcast when AQE measures the season side as small)."""
    return facts.join(game_seasons(games), "game_id", "inner")


def match_flags(club_games: DataFrame) -> DataFrame:
    """Draw and loss as 0/1 ints; a comparison with null is 0, as in
    pandas."""
    own, opp = F.col("own_goals"), F.col("opponent_goals")
    return (club_games
            .withColumn("is_draw", F.coalesce(own == opp, F.lit(False)).cast("int"))
            .withColumn("is_loss", F.coalesce(own < opp, F.lit(False)).cast("int")))


def club_season_stats(club_games: DataFrame, games: DataFrame) -> DataFrame:
    """A2: goals, wins, draws, losses and matches per (club, season)."""
    cg = match_flags(with_season(club_games, games))
    return (
        cg.filter(F.col("club_id").isNotNull() & F.col("season").isNotNull())
        .groupBy("club_id", "season")
        .agg(
            F.coalesce(F.sum("own_goals"), F.lit(0)).cast("long").alias("TotalGoals"),
            F.coalesce(F.sum("is_win"), F.lit(0)).cast("long").alias("TotalWins"),
            F.coalesce(F.sum("is_draw"), F.lit(0)).cast("long").alias("TotalDraws"),
            F.coalesce(F.sum("is_loss"), F.lit(0)).cast("long").alias("TotalLosses"),
            F.count("game_id").alias("MatchesPlayed"),
        )
    )


def appearance_season_stats(appearances: DataFrame, games: DataFrame) -> DataFrame:
    """A3: cards, assists and minutes per (club, season)."""
    ap = with_season(appearances, games)
    return (
        ap.filter(F.col("player_club_id").isNotNull() & F.col("season").isNotNull())
        .groupBy("player_club_id", "season")
        .agg(
            F.coalesce(F.sum("yellow_cards"), F.lit(0)).cast("long").alias("TotalYellowCards"),
            F.coalesce(F.sum("red_cards"), F.lit(0)).cast("long").alias("TotalRedCards"),
            F.coalesce(F.sum("assists"), F.lit(0)).cast("long").alias("TotalAssists"),
            F.coalesce(F.sum("minutes_played"), F.lit(0)).cast("long").alias("TotalMinutesPlayed"),
        )
    )


def latest_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """Keep the row with the greatest ``order_col`` per ``key``.

    ``row_number() = 1`` directly over the window lets Spark insert a
    ``WindowGroupLimit`` below the exchange, so each map task ships at most
    one row per key and a key holding a third of all rows costs one row of
    shuffle.  Rows are unique on (key, order_col) here because they come
    from a group-by on that pair.
    """
    w = Window.partitionBy(key).orderBy(F.col(order_col).desc())
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def null_false_zeros(df: DataFrame, flag_col: str = "TotalMinutesPlayed",
                     cols: list[str] | None = None) -> DataFrame:
    """P5: where ``flag_col`` is exactly 0 the listed columns become null."""
    cols = cols or FALSE_ZERO_COLUMNS
    is_zero = F.coalesce(F.col(flag_col) == 0, F.lit(False))
    # evaluate the mask once on the original value, then null every column
    return df.select(*[
        F.when(~is_zero, F.col(c)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def club_master(players: DataFrame, clubs: DataFrame, competitions: DataFrame,
                club_games: DataFrame, appearances: DataFrame, games: DataFrame,
                as_of_year: int = 2025, null_out: bool = True) -> DataFrame:
    """The last-season club master (L1): 19 columns, one row per club."""
    squad = squad_stats(players, as_of_year)
    games_latest = latest_per_key(club_season_stats(club_games, games), "club_id", "season")
    apps_latest = latest_per_key(appearance_season_stats(appearances, games),
                                 "player_club_id", "season")

    # Left join on the club only; the two latest seasons may differ.
    dyn = (games_latest.drop("season")
           .join(apps_latest.drop("season"),
                 games_latest.club_id == apps_latest.player_club_id, "left")
           .drop("player_club_id"))

    club_dim = clubs.select(
        "club_id", F.col("name").alias("ClubName"), "domestic_competition_id",
        F.col("stadium_seats").alias("StadiumCapacity"),
        F.col("foreigners_percentage").alias("ForeignersPercentage"),
        F.col("national_team_players").alias("NationalTeamPlayers"))
    league_dim = competitions.select(
        "competition_id", F.col("name").alias("LeagueName"),
        F.col("country_name").alias("Country"))

    master = (
        dyn.join(club_dim, "club_id", "inner")                           # J4
        .join(league_dim, F.col("domestic_competition_id") == F.col("competition_id"), "inner")  # J5
        .join(squad, F.col("club_id") == F.col("current_club_id"), "inner")  # J6
        .withColumn("SquadMarketValue", F.col("SquadMarketValue") / 1_000_000)  # P4
        .select(*CLUB_MASTER_COLUMNS)
    )
    return null_false_zeros(master) if null_out else master
