"""Play-by-play sequences: win probability, its changes, highlights, stories, at-bats, state rules.

Every operator takes one row per event with game_id and event_seq and looks at other
rows of the same game only, through windows over (game_id, event_seq).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import play_text as text


def by():
    """The order of a game's events; made inside operators, since a window needs a session."""
    return W.partitionBy("game_id").orderBy("event_seq")


def before():
    return by().rowsBetween(W.unboundedPreceding, -1)


def so_far():
    return by().rowsBetween(W.unboundedPreceding, 0)


# Runs to be expected by outs (rows) and bases taken (columns, bits 1, 2, 4).
RUN_EXPECTANCY = [
    [0.48, 0.85, 1.10, 1.43, 1.35, 1.75, 1.96, 2.30],
    [0.25, 0.50, 0.66, 0.88, 0.95, 1.15, 1.37, 1.54],
    [0.10, 0.21, 0.31, 0.42, 0.36, 0.48, 0.58, 0.75],
]
# A highlight's least change, what tags add, bands of turning points.
LEAST_WPA = 0.05
BONUS = {"끝내기": 0.5, "역전": 0.25, "동점": 0.15, "동점 균열": 0.10, "홈런": 0.05}
BANDS = [(0.25, "GAME_CHANGER"), (0.15, "CLUTCH"), (0.08, "BIG_PLAY")]
# Weights of story tags, thresholds, how many events a story has at most and at least.
STORY = {"walk_off": 70, "decisive_score": 50, "lead_change": 45, "go_ahead": 35, "game_tying": 35, "home_run": 35, "critical_error": 25, "late_high_wpa": 20, "high_wpa": 15, "scoring_play": 10, "rbi": 5, "wpa_supplement": 2}
PRIMARY = ("walk_off", "decisive_score", "lead_change", "go_ahead", "game_tying", "home_run", "critical_error", "late_high_wpa", "high_wpa", "scoring_play")
LATE, LATE_WPA, HIGH_WPA, ERROR_WPA, STORY_MOST, STORY_LEAST = 7, 0.15, 0.25, 0.20, 8, 5
#: Events that end an at-bat.
TERMINAL = ("batting", "walk", "strikeout", "hit_by_pitch")


def closed_form(inning: Column, bottom: Column, outs: Column, runners: Column, diff: Column) -> Column:
    """Win probability of the home side without a table."""
    table = F.array(*[F.lit(x) for row in RUN_EXPECTANCY for x in row])
    known = outs.between(0, 2) & runners.between(0, 7)
    runs = F.when(known, F.get(table, F.when(known, outs * 8 + runners).otherwise(0).cast("int"))).otherwise(0.0)
    ahead = F.when(bottom, diff + runs).otherwise(diff - runs)
    left = F.greatest(F.lit(0.5), F.lit(9) - inning + F.when(bottom, 0.0).otherwise(0.5))
    p = F.round(1 / (1 + F.exp(-(0.75 * ahead) / F.sqrt(left))), 4)
    over = F.when((inning >= 9) & (diff > 0) & (bottom | (outs == 3)), 1.0).when((inning >= 9) & bottom & (diff < 0) & (outs == 3), 0.0)
    return F.coalesce(over, p)


def win_probability(states: DataFrame, matrix: DataFrame, name: str, inning: str, bottom: str, outs: str, runners: str, diff: str) -> DataFrame:
    """Adds ``name``: the matrix entry; else that of empty bases and 0.02 a runner; else the closed form.

    ``matrix`` has inning, half, outs, runners, score_diff and win_prob, one row a
    state: 9 x 2 x 3 x 8 x 11 at most, so it is sent to every task.
    """
    m = matrix.select(*[F.col(c).alias(f"_m_{c}") for c in ("inning", "half", "outs", "runners", "score_diff")], F.col("win_prob").alias("_exact"))
    empty = matrix.where("runners = 0").select(*[F.col(c).alias(f"_e_{c}") for c in ("inning", "half", "outs", "score_diff")], F.col("win_prob").alias("_empty"))
    i, d = F.greatest(F.lit(1), F.least(F.lit(9), F.col(inning))), F.greatest(F.lit(-5), F.least(F.lit(5), F.col(diff)))
    half = F.when(F.col(bottom), "bottom").otherwise("top")
    x = states.withColumn("_i", i).withColumn("_d", d).withColumn("_h", half)
    on = lambda p: (F.col("_i") == F.col(f"{p}_inning")) & (F.col("_h") == F.col(f"{p}_half")) & (F.col(outs) == F.col(f"{p}_outs")) & (F.col("_d") == F.col(f"{p}_score_diff"))
    x = x.join(F.broadcast(m), on("_m") & (F.col(runners) == F.col("_m_runners")), "left").join(F.broadcast(empty), on("_e"), "left")
    bonus = F.lit(0.02) * F.bit_count(F.col(runners))
    near = F.when(F.col(bottom), F.least(F.lit(1.0), F.col("_empty") + bonus)).otherwise(F.greatest(F.lit(0.0), F.col("_empty") - bonus))
    p = F.coalesce("_exact", near, closed_form(F.col("_i"), F.col(bottom), F.col(outs), F.col(runners), F.col(diff)))
    return x.select(*states.columns, p.alias(name))


def wpa(before: Column, after: Column, bottom: Column) -> Column:
    """Change of win probability for the side at bat."""
    return F.round(F.when(bottom, after - before).otherwise(before - after), 4)


def bases(runners: Column) -> Column:
    """Bits as text: '1-3'."""
    one = lambda b, c: F.when(runners.bitwiseAND(b) > 0, c).otherwise("-")
    return F.concat(one(1, "1"), one(2, "2"), one(4, "3"))


def transitions(events: DataFrame, matrix: DataFrame, only_missing: bool = False) -> DataFrame:
    """Win probability before and after every valid event, and its change.

    Valid are events with inning, half (top or bottom), outs, text, scores and
    runners.  The state before is that of the valid event before; outs and runners
    start anew with a half inning, the score does not; the first event starts from
    nothing.  ``only_missing`` leaves events that have all three figures as they are.
    """
    ok = F.col("inning").isNotNull() & F.col("inning_half").isin("top", "bottom") & F.col("outs").isNotNull() & (F.trim(F.coalesce("description", F.lit(""))) != "")
    ok = ok & F.col("home_score").isNotNull() & F.col("away_score").isNotNull() & F.col("runners").isNotNull()
    x = events.where(ok).withColumn("score_diff", F.col("home_score") - F.col("away_score")).withColumn("is_bottom", F.col("inning_half") == "bottom")
    same = (F.lag("inning").over(by()) == F.col("inning")) & (F.lag("inning_half").over(by()) == F.col("inning_half"))
    held = lambda c: F.coalesce(F.when(same, F.lag(c).over(by())), F.lit(0))
    x = x.withColumn("outs_before", held("outs")).withColumn("runners_before", held("runners")).withColumn("diff_before", F.coalesce(F.lag("score_diff").over(by()), F.lit(0)))
    x = win_probability(x, matrix, "_before", "inning", "is_bottom", "outs_before", "runners_before", "diff_before")
    x = win_probability(x, matrix, "_after", "inning", "is_bottom", "outs", "runners", "score_diff")
    value = {"we_before": F.col("_before"), "we_after": F.col("_after"), "wpa": wpa(F.col("_before"), F.col("_after"), F.col("is_bottom"))}
    if only_missing:
        has = F.col("wpa").isNotNull() & F.col("we_before").isNotNull() & F.col("we_after").isNotNull()
        value = {k: F.when(has, F.col(k)).otherwise(v) for k, v in value.items()}
    return x.select("game_id", "event_seq", bases(F.col("runners_before")).alias("bases_before"), bases(F.col("runners")).alias("bases_after"), "score_diff", *[v.alias(k) for k, v in value.items()])


def timeline(plays: DataFrame, matrix: DataFrame) -> DataFrame:
    """Win probability play by play from innings and halves alone: one out, nobody on, no score."""
    x = plays.select("*", F.lit(1).alias("_outs"), F.lit(0).alias("_runners"), F.lit(0).alias("_diff"), (F.col("inning_half") == "bottom").alias("_bottom"))
    x = win_probability(x, matrix, "home_win_prob", "inning", "_bottom", "_outs", "_runners", "_diff")
    last = F.coalesce(F.lag("home_win_prob").over(by()), F.lit(0.5))
    change = F.when(F.col("_bottom"), F.col("home_win_prob") - last).otherwise(last - F.col("home_win_prob"))
    return x.select("game_id", "event_seq", F.row_number().over(by()).alias("place"), "home_win_prob", F.round(change, 4).alias("wpa"))


def highlights(events: DataFrame, least: float = LEAST_WPA) -> DataFrame:
    """Events that matter: type, tags and importance, from the score before and after.

    Missing scores count as 0.  Importance is the change of win probability, what the
    tags add, and 0.01 an inning.
    """
    home, away = F.coalesce("home_score", F.lit(0)), F.coalesce("away_score", F.lit(0))
    x = events.withColumn("after", home - away).withColumn("before", F.coalesce(F.lag("after").over(by()), F.lit(0)))
    d, size = F.coalesce("description", F.lit("")), F.abs(F.coalesce("wpa", F.lit(0.0)))
    inning = F.when(F.coalesce("inning", F.lit(0)) != 0, F.col("inning")).otherwise(F.lit(1))
    off = ((inning >= 9) & (F.col("inning_half") == "bottom") & (F.col("before") <= 0) & (F.col("after") > 0)) | d.contains("끝내기")
    off = F.coalesce(off, F.lit(False))
    lead, tie, go = F.signum("before") * F.signum("after") < 0, (F.col("before") != 0) & (F.col("after") == 0), (F.col("before") == 0) & (F.col("after") != 0)
    homer, full = d.contains("홈런") | F.coalesce(F.lower("event_type").isin("hr", "homerun"), F.lit(False)), F.coalesce(F.col("bases_before") == "123", F.lit(False))
    named = [(off, "끝내기"), (lead, "역전"), (tie, "동점"), (go, "동점 균열"), (full, "만루"), (d.contains("병살"), "병살"), (homer, "홈런"), (homer & full, "만루홈런")]
    tags = F.array_compact(F.array(*[F.when(c, t) for c, t in named]))
    kind = F.when(off, "WALK_OFF").when(lead, "LEAD_CHANGE").when(tie, "GAME_TYING").when(go, "GO_AHEAD").when(size >= least, "BIG_PLAY").otherwise("OTHER")
    worth = size
    for c, t in named:
        worth = worth + F.when(c, BONUS.get(t, 0.0)).otherwise(0.0)
    x = x.withColumn("tags", tags).withColumn("highlight_type", kind).withColumn("importance", F.round(worth + 0.01 * inning, 4)).where((F.col("highlight_type") != "OTHER") | homer)
    return x.select("game_id", "event_seq", "highlight_type", "importance", F.when(F.size("tags") > 0, F.array_join("tags", ",")).otherwise("빅플레이").alias("tags"))


def turning_points(events: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` events of each game with the largest change, and the band each falls in."""
    size = F.abs(F.coalesce("wpa", F.lit(0.0)))
    band = F.lit("MOMENTUM")
    for least, name in reversed(BANDS):
        band = F.when(size >= least, name).otherwise(band)
    top = W.partitionBy("game_id").orderBy(size.desc(), F.col("event_seq"))
    x = events.withColumn("rn", F.row_number().over(top)).where(F.col("rn") <= n)
    return x.select("game_id", "event_seq", F.row_number().over(by()).alias("place"), "wpa", band.alias("impact"))


def story(events: DataFrame, finals: DataFrame, most: int = STORY_MOST, least: int = STORY_LEAST) -> DataFrame:
    """The events that tell a game, in order.

    Lines without a play and substitutions are left out.  A missing score is the one
    before.  Tagged events come first, then the largest changes up to ``least``
    events; of these the ``most`` important stay.  ``finals`` has game_id and
    final_diff; the decisive score is the last that turns the lead to that side.
    """
    kept = lambda c: F.last(c, ignorenulls=True).over(so_far())
    x = events.withColumn("h", F.coalesce(kept("home_score"), F.lit(0))).withColumn("a", F.coalesce(kept("away_score"), F.lit(0)))
    x = x.withColumn("after", F.col("h") - F.col("a")).withColumn("before", F.coalesce(F.lag("after").over(by()), F.lit(0)))
    x = x.withColumn("runs", F.greatest(F.lit(0), F.col("h") + F.col("a") - F.coalesce(F.lag(F.col("h") + F.col("a")).over(by()), F.lit(0))))
    x = x.where(~text.is_noise(F.col("description")) & (F.coalesce(F.lower(F.trim("event_type")), F.lit("")) != "substitution"))
    d, code = text.compact(F.col("description")), F.upper(F.trim(F.coalesce("result_code", F.lit(""))))
    size, inning, rbi = F.abs(F.coalesce("wpa", F.lit(0.0))), F.coalesce("inning", F.lit(0)), F.coalesce("rbi", F.lit(0))
    error = (d.contains("실책") | code.isin("E", "ROE")) & ((F.col("runs") > 0) | (size >= ERROR_WPA) | (inning >= LATE))
    tie, go, lead = (F.col("before") != 0) & (F.col("after") == 0), (F.col("before") == 0) & (F.col("after") != 0), F.signum("before") * F.signum("after") < 0
    x = x.join(finals, "game_id", "left")
    sign = F.signum(F.col("final_diff"))
    turns = (F.col("runs") > 0) & (F.signum("after") == sign) & (F.signum("before") != sign) & (sign != 0)
    decisive = F.col("event_seq") == F.max(F.when(turns, F.col("event_seq"))).over(W.partitionBy("game_id"))
    named = {
        "walk_off": (F.col("inning_half") == "bottom") & (inning >= 9) & (F.col("before") <= 0) & (F.col("after") > 0) & (F.col("runs") > 0),
        "decisive_score": decisive,
        "lead_change": lead,
        "go_ahead": go,
        "game_tying": tie,
        "home_run": (code == "HR") | d.contains("홈런"),
        "critical_error": error,
        "late_high_wpa": (inning >= LATE) & (size >= LATE_WPA),
        "high_wpa": size >= HIGH_WPA,
        "scoring_play": (F.col("runs") > 0) | (rbi > 0) | d.contains("홈인"),
        "rbi": rbi > 0,
    }
    tags = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), t) for t, c in named.items()]))
    x = x.withColumn("tags", tags).withColumn("size", size).withColumn("primary", F.arrays_overlap("tags", F.array(*map(F.lit, PRIMARY))))
    x = x.withColumn("n", F.count_if("primary").over(W.partitionBy("game_id")))
    more = W.partitionBy("game_id", "primary").orderBy(F.desc("size"), "event_seq")
    x = x.withColumn("extra", F.when(~F.col("primary"), F.row_number().over(more))).where(F.col("primary") | (F.col("extra") <= least - F.col("n")))
    x = x.withColumn("tags", F.when(F.col("primary"), F.col("tags")).otherwise(F.array_append("tags", "wpa_supplement")))
    worth = F.col("size") * 100
    for t, w in STORY.items():
        worth = worth + F.when(F.array_contains("tags", t), float(w)).otherwise(0.0)
    x = x.withColumn("importance", F.round(worth, 4))
    best = W.partitionBy("game_id").orderBy(F.desc("importance"), F.desc("size"), "event_seq")
    x = x.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= most)
    return x.select("game_id", "event_seq", "importance", F.array_join(F.array_sort("tags"), ",").alias("tags"))


def at_bats(events: DataFrame) -> DataFrame:
    """Adds at_bat: a new one where the half differs from that of the last named batter, where the batter
    changes, with the first named batter, and with a second result in one at-bat.

    Rows without a name go to the batter before.
    """
    named = F.coalesce("batter_name", F.lit("")) != ""
    x = events.withColumn("_named", F.when(named, F.struct(F.col("inning").alias("i"), F.col("inning_half").alias("h"), F.col("batter_name").alias("b"))))
    last = F.last("_named", ignorenulls=True).over(before())
    half = last.isNotNull() & ~(last["i"].eqNullSafe(F.col("inning")) & last["h"].eqNullSafe(F.col("inning_half")))
    cut = half | (named & last.isNotNull() & (last["b"] != F.col("batter_name"))) | (named & last.isNull())
    x = x.withColumn("_cut", F.coalesce(cut, F.lit(False)).cast("int")).withColumn("_part", F.sum("_cut").over(so_far()))
    result = F.coalesce(F.col("event_type").isin(*TERMINAL), F.lit(False)).cast("int")
    within = W.partitionBy("game_id", "_part").orderBy("event_seq").rowsBetween(W.unboundedPreceding, -1)
    seen = F.coalesce(F.sum(result).over(within), F.lit(0)) > 0
    begins = F.greatest(F.col("_cut"), F.when((result == 1) & seen, 1).otherwise(0))
    return x.withColumn("_begins", begins).withColumn("at_bat", F.sum("_begins").over(so_far())).drop("_named", "_cut", "_part", "_begins")


def pitch_counts(events: DataFrame) -> DataFrame:
    """Balls and strikes after each event of an at-bat.

    Counts given with an event raise the count; balls end at 4, strikes at 3, and
    a foul leaves two strikes at most.  The list of one at-bat is folded in order.
    """
    e = F.struct("event_seq", text.pitch(F.col("description")).alias("kind"), F.col("balls").cast("int").alias("b"), F.col("strikes").cast("int").alias("s"))
    lists = events.where("at_bat is not null").groupBy("game_id", "at_bat").agg(F.array_sort(F.collect_list(e)).alias("list"))
    given = lambda now, c: F.greatest(now, F.coalesce(c, F.lit(0)))

    def step(state, x):
        at = F.element_at(state, -1)
        b, s = given(at["balls"], x["b"]), given(at["strikes"], x["s"])
        balls = F.when(x["kind"].isin("볼", "폭투"), F.least(F.lit(4), b + 1)).otherwise(b)
        strikes = F.when(x["kind"].isin("스트라이크", "헛스윙"), F.least(F.lit(3), s + 1)).when(x["kind"] == "파울", F.least(F.lit(2), s + 1)).otherwise(s)
        return F.array_append(state, F.struct(x["event_seq"].alias("event_seq"), balls.alias("balls"), strikes.alias("strikes")))

    start = F.array(F.struct(F.lit(None).cast(events.schema["event_seq"].dataType).alias("event_seq"), F.lit(0).alias("balls"), F.lit(0).alias("strikes")))
    folded = lists.select("game_id", "at_bat", F.explode(F.aggregate("list", start, step)).alias("x"))
    return folded.select("game_id", "at_bat", "x.*").where("event_seq is not null")


def state_violations(events: DataFrame, finals: DataFrame) -> DataFrame:
    """Rules PBP-000 to PBP-007, a row for each that fails: game_id, event_seq, rule_id, severity.

    Scores are held against the largest before; ``finals`` (game_id, final_away,
    final_home) against the largest of all, and gives the games that need events.
    ``place`` orders rows that repeat an event_seq.
    """
    places = W.partitionBy("game_id").orderBy("place")
    earlier = places.rowsBetween(W.unboundedPreceding, -1)
    n = lambda c: F.coalesce(c, F.lit(0))
    x = events.select("game_id", "event_seq", "place", n("inning").alias("inning"), F.upper("inning_half").alias("half"), n("outs").alias("outs"), n("away_score").alias("a"), n("home_score").alias("h"))
    first = F.row_number().over(places) == 1
    last_inning, last_half = F.coalesce(F.lag("inning").over(places), F.lit(1)), F.coalesce(F.lag("half").over(places), F.lit("TOP"))
    top = lambda c: F.coalesce(F.max(c).over(earlier), F.lit(0))
    seen = F.row_number().over(W.partitionBy("game_id", "event_seq").orderBy("place")) > 1
    rules = {
        "PBP-001": seen,
        "PBP-002": F.col("inning") < last_inning,
        "PBP-003": ((F.col("inning") != last_inning) | (F.col("half") != last_half)) & ~first & (F.col("outs") > 2),
        "PBP-004": (F.col("outs") < 0) | (F.col("outs") > 3),
        "PBP-005": F.col("a") < top("a"),
        "PBP-006": F.col("h") < top("h"),
    }
    failed = x.withColumn("failed", F.array_compact(F.array(*[F.when(c, r) for r, c in rules.items()])))
    found = failed.select("game_id", "event_seq", F.explode("failed").alias("rule_id"))
    ends = x.groupBy("game_id").agg(F.greatest(F.max("a"), F.lit(0)).alias("a"), F.greatest(F.max("h"), F.lit(0)).alias("h"))
    rest = finals.join(ends, "game_id", "left")
    rule = F.when(F.col("a").isNull(), "PBP-000").when((F.col("a") != F.col("final_away")) | (F.col("h") != F.col("final_home")), "PBP-007")
    rest = rest.select("game_id", F.lit(None).cast(events.schema["event_seq"].dataType).alias("event_seq"), rule.alias("rule_id")).where("rule_id is not null")
    return found.unionByName(rest).withColumn("severity", F.when(F.col("rule_id") == "PBP-003", "WARNING").otherwise("ERROR"))


def live_warnings(events: DataFrame) -> DataFrame:
    """Structural faults of a live feed against the row just before: game_id, place, warning."""
    places = W.partitionBy("game_id").orderBy("place")
    prev = lambda c: F.lag(c).over(places)
    order = lambda c, d: F.when(c == "top", 0).when(c == "bottom", 1).otherwise(d)
    score = lambda c: F.col(c) < F.coalesce(prev(c), F.lit(0))
    same = (F.col("inning") == prev("inning")) & (F.col("inning_half") == prev("inning_half"))
    outs = F.when(F.col("outs").isNotNull() & (F.coalesce(prev("outs"), F.when(F.row_number().over(places) == 1, 0)).isNotNull()), F.when((F.col("outs") < 0) | (F.col("outs") > 3), "outs_out_of_range").when(same & (F.col("outs") < prev("outs")), "outs_decreased"))
    inning = F.when(F.col("inning") < prev("inning"), "inning_regressed").when((F.col("inning") == prev("inning")) & (order(F.col("inning_half"), 0) < order(prev("inning_half"), 1)), "half_regressed")
    found = F.array(F.when(score("home_score"), "home_score_decreased"), F.when(score("away_score"), "away_score_decreased"), inning, outs, F.when(F.col("event_seq") <= prev("event_seq"), "event_seq_reversed"))
    return events.withColumn("w", F.array_compact(found)).select("game_id", "place", F.explode("w").alias("warning"))


def inning_runs(events: DataFrame) -> DataFrame:
    """Runs by game, side and inning from the running score; a score that falls gives none."""
    x = events.where("inning is not null and (home_score is not null or away_score is not null)")
    for c in ("home_score", "away_score"):
        x = x.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(so_far()), F.lit(0)))
    up = lambda c: F.greatest(F.lit(0), F.col(c) - F.coalesce(F.lag(c).over(by()), F.lit(0)))
    x = x.withColumn("up_home", up("home_score")).withColumn("up_away", up("away_score")).where(F.col("inning_half").isin("top", "bottom"))
    runs = F.when(F.col("inning_half") == "top", F.col("up_away")).otherwise(F.col("up_home"))
    return x.groupBy("game_id", F.when(F.col("inning_half") == "top", "away").otherwise("home").alias("side"), "inning").agg(F.sum(runs).cast("long").alias("runs"))


def linescore_mismatches(events: DataFrame, linescore: DataFrame) -> DataFrame:
    """Innings of a linescore (game_id, side, inning, runs) that the running score does not give."""
    own = inning_runs(events).withColumnRenamed("runs", "pbp_runs")
    both = linescore.join(own, ["game_id", "side", "inning"], "left").select("game_id", "side", "inning", F.coalesce("runs", F.lit(0)).cast("long").alias("box_runs"), F.coalesce("pbp_runs", F.lit(0)).alias("pbp_runs"))
    return both.where("box_runs <> pbp_runs")
