"""Rates and projections against figures worked out by hand or in plain Python."""

import pytest
from pyspark.sql import functions as F

from fieldglass.functions import batting, rates

COUNTS = "plate_appearances at_bats hits doubles triples home_runs walks intentional_walks hbp strikeouts stolen_bases caught_stealing gdp sacrifice_flies sacrifice_hits".split()


def test_rates(spark):
    full = (50, 40, 12, 3, 1, 2, 6, 1, 1, 8, 2, 1, 1, 3, 1)
    df = spark.createDataFrame([full, (None,) * 15], ", ".join(f"{c} int" for c in COUNTS))
    a, none = df.select(*[c.alias(k) for k, c in rates.batting().items()]).collect()
    assert (a.avg, a.obp, a.slg, a.ops, a.iso) == (0.3, 0.38, 0.575, 0.955, 0.275) and a.babip == 0.303
    assert a.xr == pytest.approx(round(3 + 2.16 + 1.04 + 2.88 + 2.04 + 0.25 + 0.36 - 0.32 - 1.8 - 0.784 - 0.37 + 1.11 + 0.04, 2))
    assert set(none) == {0.0}
    assert df.select(rates.batting(matchup=True)["obp"]).first()[0] == 0.38


def test_aging_and_games_behind(spark):
    df = spark.createDataFrame([(25,), (29,), (33,), (0,), (None,)], "age int")
    assert [r[0] for r in df.select(batting.aging(F.col("age"))).collect()] == [1.024, 1.0, 0.988, 1.0, 1.0]
    g = spark.createDataFrame([(10, 5, 12, 4), (13, 4, 12, 4)], "w int, l int, tw int, tl int")
    assert [r[0] for r in g.select(batting.games_behind("w", "l", "tw", "tl")).collect()] == [1.5, 0.0]


def test_projection(spark):
    years = [dict(pa=500.0, at_bats=440.0, hits=130.0, home_runs=20.0, walks=50.0, strikeouts=90.0, total_bases=210.0), dict(pa=300.0, at_bats=270.0, hits=70.0, home_runs=5.0, walks=25.0, strikeouts=60.0, total_bases=100.0)]
    kind = "pa double, at_bats double, hits double, home_runs double, walks double, strikeouts double, total_bases double"
    df = spark.createDataFrame([(1, years), (2, [])], f"k int, s array<struct<{kind.replace(' double', ': double')}>>")
    out = df.orderBy("k").select(*[c.alias(k) for k, c in batting.hitter_projection("s", F.lit(31), F.lit(1.1)).items()]).collect()
    size = 5 * 500 + 4 * 300 + 1200
    rate = {c: (5 * years[0][c] + 4 * years[1][c] + 1200 * x) / size for c, x in batting.LEAGUE.items()}
    grown = 1 - 2 * 0.003
    assert out[0].projected_pa == 480.0
    assert out[0].projected_hits == pytest.approx(480 * rate["hits"] * grown * 1.1, abs=0.051)
    assert out[0].projected_slg == pytest.approx(rate["total_bases"] * grown * 1.1 / rate["at_bats"], abs=0.00051)
    assert out[0].projected_strikeouts == pytest.approx(480 * rate["strikeouts"], abs=0.051)
    assert set(out[1]) == {None}
