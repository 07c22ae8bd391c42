"""Result views on literal rows: lookups, bands, severities, series."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.flags import flag_severity, status_band
from ledgerlens.operators.evolution import compute_evolution
from ledgerlens.operators.indicators import compute_indicators
from ledgerlens.operators.staging import stage_statements
from ledgerlens.operators.views import (clean_non_finite, company_indicators, company_summary,
                                        evolution_rows, revenue_series, status_bands)
from tests.rows import filing, raw_df


@pytest.fixture
def three_years(spark):
    rows = [filing(siren="000000001", annee=y, chiffre_affaires=ca, resultat_net=rn,
                   capitaux_propres=100, dettes_financieres=50, dettes_total=100,
                   actif_circulant_net=70)
            for y, ca, rn in [(2019, 100, 10), (2020, 400, 20), (2021, 200, 30)]]
    rows.append(filing(siren="000000002", annee=2020, chiffre_affaires=0))
    return compute_indicators(stage_statements(raw_df(spark, rows)))


def test_lookup_newest_first_and_year_filter(three_years):
    out = company_indicators(three_years, siren="000000001").collect()
    assert [r.annee_fiscale for r in out] == [2021, 2020, 2019]
    assert len(out[0]) == 20
    one = company_indicators(three_years, siren="000000001", year=2020).collect()
    assert [r.annee_fiscale for r in one] == [2020]
    # year 0 means all years; unknown company gives no row
    assert company_indicators(three_years, siren="000000001", year=0).count() == 3
    assert company_indicators(three_years, siren="999999999").count() == 0


def test_summary_years_newest_first(three_years):
    r = company_summary(three_years, siren="000000001").collect()[0]
    assert r.nb_exercices == 3 and r.annees == [2021, 2020, 2019]
    r = company_summary(three_years, siren="000000001", as_text=True).collect()[0]
    assert r.annees == "2021,2020,2019"


def test_revenue_series_share_of_max(three_years):
    out = revenue_series(three_years, siren="000000001").collect()
    assert [(r.annee_fiscale, r.part_du_max) for r in out] == [(2019, 0.25), (2020, 1.0), (2021, 0.5)]
    assert revenue_series(three_years, siren="000000002").count() == 0  # no positive revenue


def test_evolution_rows_only_with_change(three_years):
    out = evolution_rows(compute_evolution(three_years), siren="000000001").collect()
    assert [r.annee_fiscale for r in out] == [2021, 2020]
    assert out[0].sens_ca == "baisse" and out[1].sens_ca == "hausse"


def test_status_bands_edges(spark):
    df = spark.createDataFrame([(v,) for v in (None, -1.0, 0.0, 0.5, 1.0, 1.2, 2.0, 60.0, 61.0)], "v double")
    got = {r.v: (r.n, r.i, r.d) for r in df.select(
        "v", status_band(F.col("v"), 0.8, 1.2).alias("n"),
        status_band(F.col("v"), -1, 60, inverted=True).alias("i"),
        status_band(F.col("v"), 2, 1, inverted=True).alias("d")).collect()}
    assert got[None] == ("muted", "muted", "muted")
    assert got[1.2][0] == "green" and got[1.0][0] == "yellow" and got[0.5][0] == "red"
    assert got[-1.0][1] == "green" and got[60.0][1] == "yellow" and got[61.0][1] == "red"
    # reversed debt bounds: <= 2 green, above red, yellow unreachable
    for v, (_, _, debt) in got.items():
        if v is not None:
            assert debt == ("green" if v <= 2 else "red"), v


def test_status_bands_columns(three_years):
    r = status_bands(three_years).where("siren = '000000001' AND annee_fiscale = 2019").collect()[0]
    assert r.bande_ca == "yellow"  # 100 is >= 0 and < 500000
    assert r.bande_marge_nette == "green"  # 10 % >= 5


def test_flag_severity_unknown_is_warn(spark):
    df = spark.createDataFrame([("ALERTE",), ("STABLE",), ("TENSION",), ("???",), (None,)], "f string")
    got = {r.f: r.s for r in df.select("f", flag_severity(F.col("f")).alias("s")).collect()}
    assert got == {"ALERTE": "danger", "STABLE": "ok", "TENSION": "warn", "???": "warn", None: None}


def test_clean_non_finite(spark):
    df = spark.createDataFrame([(float("nan"), float("inf"), 1.5, "x"), (float("-inf"), 2.0, None, "y")],
                               "a double, b double, c double, s string")
    out = clean_non_finite(df).collect()
    assert out[0].a is None and out[0].b is None and out[0].c == 1.5 and out[0].s == "x"
    assert out[1].a is None and out[1].b == 2.0
    assert not any(isinstance(v, float) and (math.isnan(v) or math.isinf(v))
                   for r in out for v in r)
