"""Season totals of stat lines: players, teams, splits, league constants and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rates
from ..functions.ratios import num

BATTING = ("plate_appearances", "at_bats", "runs", "hits", "doubles", "triples", "home_runs", "rbi", "walks", "intentional_walks", "hbp", "strikeouts", "stolen_bases", "caught_stealing", "sacrifice_hits", "sacrifice_flies", "gdp")
PITCHING = ("innings_outs", "hits_allowed", "runs_allowed", "earned_runs", "home_runs_allowed", "walks_allowed", "hit_batters", "strikeouts", "wild_pitches", "balks", "tbf", "np")
DECISIONS = {"W": "wins", "L": "losses", "S": "saves", "H": "holds"}
# Series by the name that seasons carry; 'playoff' is also found in the name of the semi-playoff.
SERIES = {"regular": "정규시즌", "wildcard": "와일드카드", "semi_playoff": "준플레이오프", "playoff": "플레이오프", "korean_series": "한국시리즈"}
#: What counts as a played line when a league is averaged: plate appearances above, outs up to.
STUB_PA, STUB_OUTS = 10, 10


def sums(columns) -> list[Column]:
    """Sums of counts, NULL as 0."""
    return [F.sum(num(c)).cast("long").alias(c) for c in columns]


def of_series(lines: DataFrame, seasons: DataFrame, series: str) -> DataFrame:
    """Lines of the seasons whose league name contains the pattern of ``series``; few seasons are looked up."""
    pattern = SERIES.get(series, series)
    return lines.join(seasons.where(F.col("league_name").contains(pattern)).select("season_id"), "season_id", "left_semi")


def batting(lines: DataFrame, by: list[str], names: list[str] = ("player_name", "team_code")) -> DataFrame:
    """By key: largest name and team, games, the 17 sums and all rates; lines without a key are left out."""
    known = lines.where(F.col(by[-1]).isNotNull())
    out = known.groupBy(*by).agg(*[F.max(c).alias(c) for c in names], F.count("*").alias("games"), *sums(BATTING))
    return out.select("*", *[c.alias(n) for n, c in rates.batting().items()])


def pitching(lines: DataFrame, by: list[str], names: list[str] = ("player_name", "team_code")) -> DataFrame:
    """By key: games, starts, decisions, the sums, innings and all rates."""
    known = lines.where(F.col(by[-1]).isNotNull())
    out = known.groupBy(*by).agg(
        *[F.max(c).alias(c) for c in names],
        F.count("*").alias("games"),
        F.sum(F.col("is_starting").cast("int")).cast("long").alias("games_started"),
        *[F.count_if(F.col("decision") == d).alias(n) for d, n in DECISIONS.items()],
        *sums(PITCHING),
    )
    return out.select("*", rates.innings("innings_outs").alias("innings_pitched"), *[c.alias(n) for n, c in rates.pitching().items()])


def fielding(lineups: DataFrame, errors: DataFrame, names: DataFrame) -> DataFrame:
    """(player_id, position): games and errors.

    ``errors`` (game_id, event_id, description) go to the first player of the
    game's lineup, by lineup_id and then player_id, whose name or position the text contains.  Names
    are joined to the lineup before, so the only join on games is a hash join.
    """
    own = lineups.where("player_id is not null and position is not null")
    games = own.groupBy("player_id", "position").agg(F.count_distinct("game_id").alias("games"))
    named = own.join(names, "player_id", "left")
    hit = errors.join(named, "game_id").where((F.coalesce(F.length("player_name"), F.lit(0)) > 0) & F.col("description").contains(F.col("player_name")) | F.col("description").contains(F.col("position")))
    first = hit.groupBy("event_id").agg(F.min_by(F.struct("player_id", "position"), F.struct("lineup_id", "player_id")).alias("x")).select("x.*")
    counted = first.groupBy("player_id", "position").agg(F.count("*").alias("errors"))
    return games.join(counted, ["player_id", "position"], "left").select("player_id", "position", "games", F.coalesce("errors", F.lit(0)).cast("long").alias("errors"))


def team_batting(seasons: DataFrame) -> DataFrame:
    """Teams of one source row per player and season: the sums, the most games of a player, rates."""
    out = seasons.groupBy("season", "team_code").agg(F.max("games").cast("long").alias("games"), *sums(BATTING))
    return out.select("*", *[c.alias(n) for n, c in rates.batting().items()])


def team_pitching(seasons: DataFrame) -> DataFrame:
    """Teams: sums, decisions, rates and the batting average of opponents."""
    out = seasons.groupBy("season", "team_code").agg(F.max("games").cast("long").alias("games"), *sums([*DECISIONS.values(), *PITCHING, "sacrifices_allowed", "sacrifice_flies_allowed"]))
    against = rates.rate("hits_allowed", "tbf - walks_allowed - hit_batters - sacrifices_allowed - sacrifice_flies_allowed", 3)
    return out.select("*", *[c.alias(n) for n, c in rates.pitching().items()], against.alias("avg_against"))


def team_fielding(rows: DataFrame) -> DataFrame:
    """Teams: errors, double plays, putouts, assists, innings (in outs), chances; a share of 0 is given as NULL."""
    out = rows.groupBy("season", "team_code").agg(*sums(["errors", "double_plays", "putouts", "assists", "outs"]))
    made = "putouts + assists"
    null0 = lambda c: F.when(c != 0, c)
    return out.select(
        "*",
        F.expr(f"{made} + errors").alias("total_chances"),
        null0(rates.rate(made, f"{made} + errors", 4, None)).alias("fielding_pct"),
        null0(rates.rate(f"27 * ({made})", "outs", 3, None)).alias("range_factor_per_game"),
    )


def home_away(lines: DataFrame) -> DataFrame:
    """(player, HOME and AWAY): 14 sums and the four rates; a side without games is a row of zeros."""
    columns = [c for c in BATTING if c not in ("intentional_walks", "sacrifice_hits", "gdp")]
    own = lines.where("player_id is not null").groupBy("player_id", "location").agg(F.count("*").alias("games"), *sums(columns))
    spine = own.select("player_id").distinct().select("player_id", F.explode(F.array(F.lit("HOME"), F.lit("AWAY"))).alias("location"))
    full = spine.join(own, ["player_id", "location"], "left").na.fill(0)
    r = rates.batting()
    wide = full.withColumn("intentional_walks", F.lit(0)).withColumn("gdp", F.lit(0)).withColumn("sacrifice_hits", F.lit(0))
    return wide.select(*full.columns, *[r[n].alias(n) for n in ("avg", "obp", "slg", "ops")])


def split(lines: DataFrame, by: list[str], hbp: bool = True, slugging: bool = True) -> DataFrame:
    """Lines grouped by player and opponent, place or starter: games, sums and matchup rates.

    Rows without one of the keys are left out, blank keys too.  ``hbp`` false counts
    no hit batters in obp, as splits by place do.
    """
    for c in by:
        lines = lines.where(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))
    columns = [c for c in BATTING if c not in ("intentional_walks", "gdp")]
    own = lines.groupBy(*by).agg(F.max("player_name").alias("player_name"), F.count("*").alias("games"), *sums(columns))
    wide = own.withColumn("intentional_walks", F.lit(0)).withColumn("gdp", F.lit(0))
    r = rates.batting(matchup=True, slugging=slugging)
    if not hbp:
        held, wide = wide, wide.withColumn("hbp", F.lit(0).cast("long"))
        return wide.select(*[c for c in held.columns if c not in ("intentional_walks", "gdp", "hbp")], *[r[n].alias(n) for n in ("avg", "obp", "slg", "ops")])
    return wide.select(*own.columns, *[r[n].alias(n) for n in ("avg", "obp", "slg", "ops")])


def pitcher_split(lines: DataFrame, by: list[str]) -> DataFrame:
    """Pitching lines by pitcher and opponent: games, sums, era and whip."""
    own = lines.where(F.col(by[0]).isNotNull()).groupBy(*by).agg(F.count("*").alias("games"), *[F.count_if(F.col("decision") == d).alias(n) for d, n in DECISIONS.items()], *sums(PITCHING))
    r = rates.pitching()
    return own.select("*", r["era"].alias("era"), r["whip"].alias("whip"))


def league_constants(batters: DataFrame, pitchers: DataFrame, least_id: int = 10_000) -> DataFrame:
    """One row: the league's woba, its scale, runs a plate appearance, fip constant, runs a win, era, obp and slg.

    Stub lines (see STUB_PA, STUB_OUTS) and low ids are left out.  An empty league
    has .320, 1.03125 (.330 / .320), 0, 4.50, 10.0, 4.50, .330 and 0.
    """
    real = batters.where((F.col("player_id") >= least_id) & ((F.col("plate_appearances") > STUB_PA) | (F.col("home_runs") > 0) | (F.col("walks") > 0)))
    b = real.agg(*[F.coalesce(F.sum(num(c)), F.lit(0)).cast("long").alias(c) for c in BATTING])
    thrown = pitchers.where((F.col("player_id") >= least_id) & ((F.col("innings_outs") <= STUB_OUTS) | (F.col("strikeouts") > 0) | (F.col("walks_allowed") > 0)))
    p = thrown.agg(*[F.coalesce(F.sum(num(c)), F.lit(0)).cast("long").alias(f"p_{c}") for c in PITCHING])
    x = b.crossJoin(F.broadcast(p))  # one row each
    u = "(walks - intentional_walks)"
    singles = "(hits - doubles - triples - home_runs)"
    terms = {"unintentional": u, "singles": singles}
    top = " + ".join(f"{w} * {terms.get(c, c)}" for c, w in rates.WOBA.items())
    chances = f"(at_bats + {u} + hbp + sacrifice_flies)"
    x = x.select(
        "*",
        F.expr(f"CASE WHEN {chances} > 0 THEN CAST({top} AS DOUBLE) / (100 * {chances}) ELSE 0.320D END").alias("lg_woba"),
        F.expr(f"CASE WHEN {chances} > 0 THEN CAST(hits + {u} + hbp AS DOUBLE) / {chances} ELSE 0.330D END").alias("lg_obp"),
        F.expr("CASE WHEN p_innings_outs > 0 THEN CAST(27 * p_earned_runs AS DOUBLE) / p_innings_outs ELSE 4.5D END").alias("lg_era"),
        F.expr("CASE WHEN p_innings_outs > 0 THEN CAST(3 * (13 * p_home_runs_allowed + 3 * (p_walks_allowed + p_hit_batters) - 2 * p_strikeouts) AS DOUBLE) / p_innings_outs ELSE 0.0D END").alias("raw_fip"),
        F.expr("CASE WHEN p_innings_outs > 0 THEN CAST(54 * runs AS DOUBLE) / p_innings_outs ELSE 10.0D END").alias("rpg"),
    )
    return x.select(
        "lg_woba",
        F.expr("CASE WHEN lg_woba > 0 THEN lg_obp / lg_woba ELSE 1.2D END").alias("woba_scale"),
        F.expr("CAST(runs AS DOUBLE) / CASE WHEN plate_appearances <> 0 THEN plate_appearances ELSE 1 END").alias("lg_r_per_pa"),
        F.expr("lg_era - raw_fip").alias("fip_constant"),
        F.round(10 * F.sqrt(F.col("rpg") / 9), 2).alias("rpw"),
        "lg_era",
        "lg_obp",
        F.expr("CAST(hits + doubles + 2 * triples + 3 * home_runs AS DOUBLE) / CASE WHEN at_bats <> 0 THEN at_bats ELSE 1 END").alias("lg_slg"),
    )


def advanced_batting(rows: DataFrame, league: DataFrame) -> DataFrame:
    """woba, wraa, wrc_plus, ops_plus and war of season rows with obp and slg; wraa starts from the rounded woba."""
    u, singles = "(walks - intentional_walks)", "(hits - doubles - triples - home_runs)"
    terms = {"unintentional": u, "singles": singles}
    top = " + ".join(f"{w} * {terms.get(c, c)}" for c, w in rates.WOBA.items())
    x = rows.crossJoin(F.broadcast(league)).withColumn("woba", rates.rate(top, f"100 * (at_bats + {u} + hbp + sacrifice_flies)", 3))
    x = x.withColumn("above", F.expr("(woba - lg_woba) / woba_scale")).withColumn("wraa", F.round(F.col("above") * F.col("plate_appearances"), 1))
    plus = F.expr("CASE WHEN lg_r_per_pa > 0 THEN (above + lg_r_per_pa) / lg_r_per_pa * 100 ELSE 100D END")
    ops = F.expr("CASE WHEN lg_obp > 0 AND lg_slg > 0 THEN (obp / lg_obp + slg / lg_slg - 1) * 100 ELSE 100D END")
    return x.select(*rows.columns, "woba", "wraa", F.round(plus).cast("long").alias("wrc_plus"), F.round(ops).cast("long").alias("ops_plus"), F.round(F.col("wraa") / F.col("rpw"), 2).alias("war"))


def advanced_pitching(rows: DataFrame, league: DataFrame) -> DataFrame:
    """fip_adj, lob_pct (NULL without a base for it) and war of season rows."""
    x = rows.crossJoin(F.broadcast(league))
    raw = F.expr("CASE WHEN innings_outs > 0 THEN CAST(3 * (13 * home_runs_allowed + 3 * (walks_allowed + hit_batters) - 2 * strikeouts) AS DOUBLE) / innings_outs + fip_constant ELSE 0.0D END")
    x = x.withColumn("fip_adj", F.round(raw, 2))
    on = "hits_allowed + walks_allowed + hit_batters"
    lob = rates.rate(f"10 * ({on} - runs_allowed)", f"10 * ({on}) - 14 * home_runs_allowed", 3, None)
    war = F.expr("CASE WHEN rpw > 0 THEN (lg_era - fip_adj) * (innings_outs / 27.0D) / rpw ELSE 0.0D END")
    return x.select(*rows.columns, "fip_adj", lob.alias("lob_pct"), F.round(war, 2).alias("war"))


def recalculated(lines: DataFrame) -> DataFrame:
    """By player, name, season and team: distinct games, sums and avg."""
    columns = ("plate_appearances", "at_bats", "runs", "hits", "doubles", "triples", "home_runs", "rbi", "walks", "strikeouts")
    own = lines.where("player_id is not null").groupBy("player_id", "player_name", "season", "team_code").agg(F.count_distinct("game_id").alias("games"), *sums(columns))
    return own.withColumn("avg", rates.rate("hits", "at_bats", 3))


def merge_matchups(old: DataFrame, new: DataFrame, keys: list[str], counts: list[str], accumulate: bool = False) -> DataFrame:
    """Stored matchup totals after a run.

    By default a rerun replaces what it recounts; ``accumulate`` adds to what is
    stored, so a rerun then counts twice.
    """
    both = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in counts]).join(new.select(*keys, *counts), keys, "full")
    value = lambda c: num(f"old_{c}") + num(c) if accumulate else F.coalesce(c, f"old_{c}")
    return both.select(*keys, *[value(c).cast("long").alias(c) for c in counts])


PEER_METRICS = ("avg", "obp", "slg", "ops", "home_runs", "rbi", "hits")


def against_peers(rows: DataFrame, peers: str, least_pa: int = 10) -> DataFrame:
    """By player, each metric's distance to the mean of those with the same ``peers`` value and enough plate appearances.

    Rates are whole thousandths while they are averaged, so no order of rows shows, and
    come out to three places, counts to one.
    """
    milli = lambda c: F.round(F.col(c) * 1000).cast("long") if c in PEER_METRICS[:4] else F.col(c).cast("long")
    means = rows.where(F.col("plate_appearances") >= least_pa).groupBy(peers).agg(F.count("*").alias("_n"), *[F.sum(milli(c)).alias(f"_{c}") for c in PEER_METRICS])
    x = rows.select("player_id", peers, *[milli(c).alias(c) for c in PEER_METRICS]).join(means, peers, "left")
    off = lambda c: rates.whole(f"{c} * _n - _{c}", "_n", 0 if c in PEER_METRICS[:4] else 1) / F.lit(1000.0 if c in PEER_METRICS[:4] else 10.0)
    return x.select("player_id", peers, *[off(c).alias(f"{c}_off") for c in PEER_METRICS])


def recent_teams(games: DataFrame, batting_lines: DataFrame, pitching_lines: DataFrame, n: int = 5) -> DataFrame:
    """By team over its last ``n`` games (team, game_id, date): avg, era, and the bullpen's era, whip and innings.

    avg and era are 0 without a base for them, the bullpen's rates NULL.
    """
    from pyspark.sql import Window as W

    last = games.withColumn("rn", F.row_number().over(W.partitionBy("team_code").orderBy(F.desc("date"), F.desc("game_id")))).where(F.col("rn") <= n).select("team_code", "game_id")
    used = last.groupBy("team_code").agg(F.count("*").alias("sample_games"))
    b = batting_lines.join(last, ["team_code", "game_id"], "left_semi").groupBy("team_code").agg(*sums(["hits", "at_bats"])).select("team_code", rates.rate("hits", "at_bats", 3).alias("avg"))
    own = pitching_lines.join(last, ["team_code", "game_id"], "left_semi")
    pen = lambda c: F.coalesce(F.sum(F.when(~F.col("is_starting"), num(c))), F.lit(0)).cast("long").alias(f"pen_{c}")
    p = own.groupBy("team_code").agg(*sums(["earned_runs", "innings_outs"]), *[pen(c) for c in ("earned_runs", "hits_allowed", "walks_allowed", "innings_outs")])
    p = p.select("team_code", rates.rate("27 * earned_runs", "innings_outs", 2).alias("era"), rates.rate("27 * pen_earned_runs", "pen_innings_outs", 2, None).alias("bullpen_era"), rates.rate("3 * (pen_hits_allowed + pen_walks_allowed)", "pen_innings_outs", 2, None).alias("bullpen_whip"), rates.rate("pen_innings_outs", "3", 1).alias("bullpen_ip"))
    return used.join(b, "team_code", "left").join(p, "team_code", "left").na.fill(0.0, ["avg", "era", "bullpen_ip"])


def qualifiers(games: DataFrame) -> DataFrame:
    """By season (season, date): days with games, least plate appearances and outs to qualify, as of 144 games at most."""
    g = games.groupBy("season").agg(F.count_distinct("date").alias("games"))
    n = F.least("games", F.lit(144))
    full = F.col("games") >= 144
    pa, outs = F.expr("least(games, 144) * 31 div 10"), n * 3
    return g.select("season", "games", F.when(full, pa).otherwise(F.greatest(pa, F.lit(30))).cast("long").alias("min_pa"), F.when(full, outs).otherwise(F.greatest(outs, F.lit(90))).cast("long").alias("min_outs"))


def coverage(games: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """By day: completed games, those with each part, and the share of those with all, to three places.

    ``games`` has game_id, date and completed; a part has game_id.
    """
    x = games
    for name, df in parts.items():
        x = x.join(df.select("game_id", F.lit(True).alias(name)).distinct(), "game_id", "left")
    every = F.lit(True)
    for name in parts:
        every = every & F.coalesce(name, F.lit(False))
    done = F.col("completed")
    by = x.groupBy("date").agg(F.count("*").alias("total"), F.count_if(done).alias("done"), F.count_if(done & every).alias("full"), *[F.count_if(done & F.coalesce(c, F.lit(False))).alias(f"with_{c}") for c in parts])
    return by.select("*", rates.rate("full", "done", 3).alias("detail_coverage"), rates.rate("done", "total", 3).alias("completion_rate"))
