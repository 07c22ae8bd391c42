"""Literal test rows in the raw schemas."""

import datetime as dt

from pyspark.sql import types as T

from ledgerlens.oracle import RAW_COLUMNS

AMOUNTS = [c for c in RAW_COLUMNS if c not in (
    "siren", "annee", "date_cloture_exercice", "type_bilan", "confidentiality", "code_naf")]

RAW_SCHEMA = T.StructType(
    [T.StructField("siren", T.StringType()), T.StructField("annee", T.IntegerType()),
     T.StructField("date_cloture_exercice", T.DateType()), T.StructField("type_bilan", T.StringType()),
     T.StructField("confidentiality", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in AMOUNTS]
    + [T.StructField("code_naf", T.StringType())])


def filing(siren="000000001", annee=2020, type_bilan="C", confidentiality="Public",
           date=None, **amounts):
    row = {c: None for c in RAW_COLUMNS}
    row.update(siren=siren, annee=annee, type_bilan=type_bilan, confidentiality=confidentiality,
               date_cloture_exercice=date or dt.date(annee or 2000, 12, 31))
    row.update(amounts)
    return tuple(row[c] for c in RAW_COLUMNS)


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


REGISTER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                ("siren", "code_naf", "denomination", "categorie")])
