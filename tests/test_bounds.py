"""Every fixed bound, as literal rows (the SQL twins build on the same tables)."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.flags import debt_flag, flag_severity, liquidity_flag, status_band
from ledgerlens.functions.sectors import sector_label
from ledgerlens.operators.profile import null_rates, revenue_segment, top_codes
from ledgerlens.operators.views import STATUS_BANDS

SECTORS = {
    "A — Agriculture": ["01", "02", "03"], "B — Industries extractives": ["05", "09"],
    "C — Industrie manufacturière": ["10", "33"], "D — Énergie": ["35"],
    "E — Eau, déchets": ["36", "39"], "F — Construction": ["41", "43"],
    "G — Commerce": ["45", "47"], "H — Transport": ["49", "53"],
    "I — Hôtellerie/Restauration": ["55", "56"], "J — Information/Communication": ["58", "63"],
    "K — Finance/Assurance": ["64", "66"], "L — Immobilier": ["68"],
    "M — Services professionnels": ["69", "75"], "N — Services admin": ["77", "82"],
    "O — Administration publique": ["84"], "P — Enseignement": ["85"],
    "Q — Santé/Action sociale": ["86", "88"],
    "Z — Autres": ["00", "04", "34", "40", "44", "48", "54", "57", "67", "76", "83", "89", "99",
                   "", "A1", None]}


def labelled(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in df.select("i", expr(F.col("v")).alias("r")).orderBy("i").collect()]


def test_sectors(spark):
    pairs = [(p, label) for label, prefixes in SECTORS.items() for p in prefixes]
    assert labelled(spark, [p for p, _ in pairs], "string", sector_label) == [x for _, x in pairs]


def test_revenue_segments(spark):
    pairs = [(-1, "0. Nul/négatif"), (0, "0. Nul/négatif"), (1, "1. Micro <500k"),
             (499_999, "1. Micro <500k"), (500_000, "2. TPE 500k-2M"),
             (1_999_999, "2. TPE 500k-2M"), (2_000_000, "3. PME 2M-10M"),
             (9_999_999, "3. PME 2M-10M"), (10_000_000, "4. ETI 10M-50M"),
             (49_999_999, "4. ETI 10M-50M"), (50_000_000, "5. Grande 50M-250M"),
             (249_999_999, "5. Grande 50M-250M"), (250_000_000, "6. >250M"), (None, "6. >250M")]
    assert labelled(spark, [v for v, _ in pairs], "long", revenue_segment) == [x for _, x in pairs]


BANDS = {
    "bande_ca": [(-1, "red"), (0, "yellow"), (499_999, "yellow"), (500_000, "green")],
    "bande_ebitda": [(-1, "red"), (0, "yellow"), (0.5, "yellow"), (1, "green")],
    "bande_marge_nette": [(-0.1, "red"), (0, "yellow"), (4.99, "yellow"), (5, "green")],
    "bande_bfr": [(-1, "green"), (-0.9, "yellow"), (60, "yellow"), (60.1, "red")],
    "bande_liquidite": [(0.79, "red"), (0.8, "yellow"), (1.19, "yellow"), (1.2, "green")],
    "bande_endettement": [(1, "green"), (2, "green"), (2.01, "red"), (None, "muted")]}


@pytest.mark.parametrize("name", list(BANDS))
def test_bands(spark, name):
    _, _, lo, hi, inverted = next(b for b in STATUS_BANDS if b[0] == name)
    pairs = [(None if v is None else float(v), x) for v, x in BANDS[name]]
    got = labelled(spark, [v for v, _ in pairs], "double", lambda c: status_band(c, lo, hi, inverted))
    assert got == [x for _, x in pairs]


def test_severities_and_ratio_flags(spark):
    pairs = [("ALERTE", "danger"), ("VIGILANCE", "warn"), ("STABLE", "ok"), ("LIQUIDE", "ok"),
             ("TENSION", "warn"), ("RISQUE", "danger"), ("SAIN", "ok"), ("ENDETTÉ", "warn"),
             ("TRES_ENDETTÉ", "danger"), ("CP_NEGATIFS", "danger"), ("SANS_DETTE", "ok"),
             ("other", "warn"), (None, None)]
    assert labelled(spark, [v for v, _ in pairs], "string", flag_severity) == [x for _, x in pairs]
    assert labelled(spark, [1.0, 0.999, 0.8, 0.799, None], "double", liquidity_flag) == [
        "LIQUIDE", "TENSION", "TENSION", "RISQUE", "RISQUE"]
    rows = [(0, 5, None), (10, 0, 0.0), (10, 21, 2.1), (10, 20, 2.0), (10, 11, 1.1), (10, 10, 1.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, e long, d long, r double")
    got = [r.f for r in df.select("i", debt_flag(F.col("e"), F.col("d"), F.col("r")).alias("f"))
           .orderBy("i").collect()]
    assert got == ["CP_NEGATIFS", "SANS_DETTE", "TRES_ENDETTÉ", "ENDETTÉ", "ENDETTÉ", "SAIN"]


def test_absent_columns(spark):
    df = spark.createDataFrame([(1,)], "other int")
    assert top_codes(df).collect() == []  # no candidate: nothing to report
    with pytest.raises(ValueError, match="not present"):
        null_rates(df)
