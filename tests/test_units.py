"""One case per branch of the staging, indicator and evolution rules, on
literal rows (the literal unit cases of FIXTURES.md and the traps T1-T11)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators.evolution import compute_evolution
from ledgerlens.operators.indicators import compute_indicators
from ledgerlens.operators.profile import revenue_segments
from ledgerlens.operators.staging import stage_companies, stage_statements
from ledgerlens.operators.views import degradation_alerts, trend_summary
from tests.rows import REGISTER_SCHEMA, filing, raw_df

BASE = dict(chiffre_affaires=1000, resultat_net=10, ebe=50, dotations_amortissements=5,
            stocks_net=10, creances_clients_net=20, dettes_fournisseurs=5,
            capitaux_propres=100, dettes_total=0, dettes_financieres=0, actif_circulant_net=0)


def indicators_of(spark, **amounts):
    vals = dict(BASE)
    vals.update(amounts)
    raw = raw_df(spark, [filing(**vals)])
    return compute_indicators(stage_statements(raw)).collect()[0]


def test_debt_order_equity_zero(spark):
    r = indicators_of(spark, capitaux_propres=0, dettes_financieres=0)
    assert r.flag_endettement == "CP_NEGATIFS"
    assert r.ratio_endettement is None
    assert r.capitaux_propres_negatifs is False


def test_debt_bounds(spark):
    expected = {100: "SAIN", 101: "ENDETTÉ", 200: "ENDETTÉ", 201: "TRES_ENDETTÉ"}
    for debt, flag in expected.items():
        r = indicators_of(spark, capitaux_propres=100, dettes_financieres=debt, dettes_total=debt)
        assert r.flag_endettement == flag, debt
    assert indicators_of(spark, dettes_financieres=0).flag_endettement == "SANS_DETTE"


def test_liquidity_bounds(spark):
    for assets, flag in {1000: "LIQUIDE", 800: "TENSION", 799: "RISQUE"}.items():
        r = indicators_of(spark, dettes_total=1000, dettes_financieres=0, actif_circulant_net=assets)
        assert r.flag_liquidite == flag, assets


def test_no_short_term_debt_is_risque(spark):
    r = indicators_of(spark, dettes_total=500, dettes_financieres=500, actif_circulant_net=900)
    assert r.ratio_liquidite is None
    assert r.flag_liquidite == "RISQUE"
    # negative short-term debt is floored at 0 -> no ratio either
    r = indicators_of(spark, dettes_total=100, dettes_financieres=500, actif_circulant_net=900)
    assert r.ratio_liquidite is None and r.flag_liquidite == "RISQUE"


def test_rounding_on_scaled_binary_value(spark):
    r = indicators_of(spark, chiffre_affaires=20000, resultat_net=201)
    assert r.marge_nette_pct == 1.0  # 1.005 is 1.00499.. in binary


def test_revenue_not_positive_gives_null_margins(spark):
    for ca in (0, -10, None):
        r = indicators_of(spark, chiffre_affaires=ca)
        assert r.marge_nette_pct is None and r.marge_ebitda_pct is None and r.bfr_jours is None


def evolution_of(spark, revenues, results, siren="000000001", years=None, ebe=None):
    years = years or list(range(2015, 2015 + len(revenues)))
    ebe = ebe or [None] * len(revenues)
    rows = [filing(siren=siren, annee=y, chiffre_affaires=ca, resultat_net=rn, ebe=e)
            for y, ca, rn, e in zip(years, revenues, results, ebe)]
    evo = compute_evolution(compute_indicators(stage_statements(raw_df(spark, rows))))
    return evo.orderBy("annee_fiscale").collect()


def test_degradation_unbroken_fall(spark):
    rows = evolution_of(spark, [100, 90, 80], [10, 8, 6])
    assert [r.flag_degradation for r in rows] == [None, "VIGILANCE", "ALERTE"]
    assert rows[1].variation_ca_pct == -10.0
    assert rows[2].baisse_ca is True and rows[2].baisse_marge is True


def test_degradation_zero_revenue_all_null(spark):
    rows = evolution_of(spark, [100, 0, 90], [10, 0, 9])
    assert [r.flag_degradation for r in rows] == [None, None, None]


def test_previous_revenue_zero_gives_null_change(spark):
    rows = evolution_of(spark, [0, 50], [0, 5])
    assert rows[1].variation_ca_pct is None
    assert rows[1].ca_n1 == 0


def test_previous_row_is_previous_available_year(spark):
    rows = evolution_of(spark, [100, 50], [10, 5], years=[2015, 2019])
    assert rows[1].ca_n1 == 100
    assert rows[1].variation_ca_pct == -50.0


def test_stable_and_negative_divisor(spark):
    rows = evolution_of(spark, [100, 120], [10, 13])
    assert rows[1].flag_degradation == "STABLE"
    assert rows[1].marge_nette_pct == 10.83
    assert rows[1].delta_marge_nette == 0.83
    # sign follows the divisor: EBITDA from -100 to 50 is a change of -150 %
    rows = evolution_of(spark, [100, 100], [0, 0], ebe=[-100, 50])
    assert rows[1].variation_ebitda_pct == -150.0
    # EBITDA of 0 the year before: no change
    rows = evolution_of(spark, [100, 100], [0, 0], ebe=[0, 50])
    assert rows[1].variation_ebitda_pct is None


def test_dedup_preference_and_ties(spark):
    rows = [
        filing(type_bilan="S", chiffre_affaires=1),
        filing(type_bilan="K", chiffre_affaires=2),
        filing(type_bilan="C", chiffre_affaires=3, date=dt.date(2020, 6, 30)),
        filing(type_bilan="C", chiffre_affaires=4, date=dt.date(2020, 12, 31)),  # later closing wins
        filing(siren="000000002", type_bilan=None, chiffre_affaires=5),
        filing(siren="000000002", type_bilan="N", chiffre_affaires=6),
        filing(siren="000000003", type_bilan="S", chiffre_affaires=7),
        filing(siren="000000003", type_bilan="K", chiffre_affaires=8),
    ]
    out = {r.siren: r.chiffre_affaires for r in stage_statements(raw_df(spark, rows)).collect()}
    assert out["000000001"] == 4
    assert out["000000002"] == 5  # null type and N rank equal; tie by amounts ascending
    assert out["000000003"] == 8


def test_staging_filters_and_defaults(spark):
    rows = [
        filing(siren=None, chiffre_affaires=1),
        filing(annee=2009, chiffre_affaires=1),
        filing(annee=2026, chiffre_affaires=1),
        filing(confidentiality="Confidentiel", annee=2011),
        filing(confidentiality=None, annee=2012),
        filing(annee=2010, capitaux_propres=-5, effectif_moyen=None),
    ]
    out = stage_statements(raw_df(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert r.bilan_key == "000000001_2010"
    assert r.chiffre_affaires == 0 and r.effectif_moyen == 0
    assert r.capitaux_propres_negatifs is True
    assert isinstance(r.annee_fiscale, int)


def test_fractional_amounts_round_half_even(spark):
    df = raw_df(spark, [filing(chiffre_affaires=0)]).withColumn(
        "chiffre_affaires", F.lit(2.5)).withColumn("resultat_net", F.lit(3.5))
    r = stage_statements(df).collect()[0]
    assert (r.chiffre_affaires, r.resultat_net) == (2, 4)


def test_companies_padded_code_and_raw_dedup(spark):
    rows = [("000000001", " 62.01z ", "A", "PME"),
            ("000000002", "b111", "B", None), ("000000002", "C111", "C", None),
            ("000000003", "  ", "D", None), ("000000004", "6", "E", None),
            ("000000005", None, "F", None)]
    df = spark.createDataFrame(rows, REGISTER_SCHEMA)
    out = {r.siren: r for r in stage_companies(df).collect()}
    assert set(out) == {"000000001", "000000002"}
    assert out["000000001"].naf_division == "62"
    assert out["000000001"].code_naf == "62.01Z"
    assert out["000000001"].secteur_macro == "Z — Autres"
    assert out["000000002"].code_naf == "C111"  # 'C111' < 'b111' in binary order
    assert out["000000002"].categorie == ""


def test_segments_null_revenue_is_top_class(spark):
    raw = raw_df(spark, [filing(annee=1998, chiffre_affaires=None),
                         filing(siren="2", annee=1998, chiffre_affaires=-1),
                         filing(siren="3", annee=1998, chiffre_affaires=499999)])
    out = {r.segment: r.nb for r in revenue_segments(raw, 1998).collect()}
    assert out == {"6. >250M": 1, "0. Nul/négatif": 1, "1. Micro <500k": 1}


def test_alerts_order_limit_and_validation(spark):
    import pytest
    rows = []
    for i, drop in enumerate([30, 10, 20]):
        s = f"00000000{i}"
        rows += [filing(siren=s, annee=2021, chiffre_affaires=1000000, resultat_net=100000),
                 filing(siren=s, annee=2022, chiffre_affaires=900000, resultat_net=80000),
                 filing(siren=s, annee=2023, chiffre_affaires=900000 * (100 - drop) // 100,
                        resultat_net=10000)]
    evo = compute_evolution(compute_indicators(stage_statements(raw_df(spark, rows))))
    out = degradation_alerts(evo, year=2023, min_ca=0, limit=2).collect()
    assert [r.siren for r in out] == ["000000000", "000000002"]
    with pytest.raises(ValueError):
        degradation_alerts(evo, limit=501)
    summary = {r.siren: r for r in trend_summary(evo).collect()}
    assert summary["000000001"].flag_degradation_actuel == "ALERTE"
    assert summary["000000001"].nb_annees_alerte == 1
    assert summary["000000001"].derniere_annee == 2023


def test_small_reports_are_totally_ordered(spark):
    from ledgerlens.operators.profile import null_rates, rows_per_year
    rows = [filing(siren=f"{i:09d}", annee=2010 + i % 5, chiffre_affaires=None if i % 3 else i)
            for i in range(40)]
    raw = raw_df(spark, rows).repartition(7)
    assert [r.annee for r in rows_per_year(raw).collect()] == [2010, 2011, 2012, 2013, 2014]
    rates = [r.pct_null for r in null_rates(raw).collect()]
    assert rates == sorted(rates, reverse=True)


def test_profiles_without_a_candidate_column_give_no_rows(spark):
    from ledgerlens.operators.profile import null_rates_wide, rows_per_year, top_codes
    df = spark.range(3)
    for report in (rows_per_year, null_rates_wide, top_codes):
        assert report(df).collect() == []


def test_equal_filings_of_other_types_end_on_the_type(spark):
    from ledgerlens.operators.staging import stage_statements
    from tests.rows import filing, raw_df
    for kinds in (["S", "N", None], [None, "N", "S"]):
        rows = [filing(type_bilan=t, chiffre_affaires=5) for t in kinds]
        assert stage_statements(raw_df(spark, rows)).first()["type_bilan"] == "N"
