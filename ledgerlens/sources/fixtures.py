"""Test inputs in the schemas the engine reads, derived from the driver's
``orders`` and ``customer`` tables (see FIXTURES.md).

These functions only produce rows of the accounts file and of the company
register; every analytic step runs on them through the library's own
operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# The columns of the driver tables the fixtures read, with
# their stored types. Reading with a declared schema skips the footer
# inference job of every scan and reads only these columns.
READ_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in READ_SCHEMAS:
        reader = reader.schema(READ_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _siren(key: str):
    return F.lpad(F.col(key).cast("string"), 9, "0")


def raw_accounts(orders: DataFrame) -> DataFrame:
    """One filing per (customer, order year, order status) with 31 columns."""
    grouped = (orders
               .groupBy("o_custkey",
                        F.year("o_orderdate").cast("int").alias("annee"),
                        "o_orderstatus")
               .agg(F.min("o_orderkey").alias("k"),
                    F.max(F.col("o_orderdate").cast("date")).alias("d"),
                    F.sum(F.floor("o_totalprice").cast("bigint")).cast("bigint").alias("ca")))
    k, ca = F.col("k"), F.col("ca")

    def mod(x, m):
        return x % F.lit(m)

    return grouped.select(
        _siren("o_custkey").alias("siren"),
        "annee",
        F.col("d").alias("date_cloture_exercice"),
        F.when(F.col("o_orderstatus") == "F", "C").when(F.col("o_orderstatus") == "O", "S")
         .otherwise("K").alias("type_bilan"),
        F.when(mod(k, 10) == 0, "Confidentiel").otherwise("Public").alias("confidentiality"),
        F.when(mod(k, 23) == 0, F.lit(None).cast("bigint")).when(mod(k, 29) == 0, F.lit(0).cast("bigint"))
         .otherwise(ca).alias("chiffre_affaires"),
        F.when(mod(k, 31) == 0, F.lit(None).cast("bigint")).otherwise(mod(ca, 40000) - 15000)
         .alias("resultat_net"),
        (mod(ca, 40000) - 15000).alias("resultat_exercice"),
        mod(ca, 110000).alias("valeur_ajoutee"),
        (mod(ca, 60000) - 10000).alias("ebe"),
        mod(ca, 45000).alias("charges_personnel"),
        mod(ca, 9000).alias("dotations_amortissements"),
        (ca + 50000).alias("total_actif"),
        (ca + 50000 + F.when(mod(k, 11) == 0, F.lit(400000)).otherwise(F.lit(0))).alias("total_passif"),
        mod(ca, 21000).alias("immob_corpo_net"),
        mod(ca, 17000).alias("stocks_net"),
        mod(ca, 31000).alias("creances_clients_net"),
        mod(ca, 13000).alias("disponibilites_net"),
        (mod(ca, 70000) - 9000).alias("capitaux_propres"),
        F.lit(10000).cast("bigint").alias("capital_social"),
        mod(ca, 8000).alias("reserves"),
        F.when(mod(k, 13) == 0, F.lit(0).cast("bigint")).otherwise(mod(ca, 90000)).alias("dettes_total"),
        F.when((mod(k, 5) == 0) | (mod(k, 13) == 0), F.lit(0).cast("bigint")).otherwise(mod(ca, 50000))
         .alias("dettes_financieres"),
        mod(ca, 23000).alias("dettes_fournisseurs"),
        mod(ca, 7000).alias("dettes_fiscales"),
        mod(ca, 80000).alias("actif_circulant_net"),
        F.when(mod(k, 3) == 0, F.lit(None).cast("bigint")).otherwise(mod(k, 250)).alias("effectif_moyen"),
        mod(ca, 12000).alias("capacite_autofinancement"),
        mod(ca, 25000).alias("bfr"),
        F.when(mod(k, 6) == 0, F.lit(None).cast("bigint")).otherwise(mod(ca, 55000) - 12000)
         .alias("resultat_exploitation"),
        F.when(mod(k, 7) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lpad((10 + mod(k, 12)).cast("string"), 2, "0"), F.lit(".10Z")))
         .alias("code_naf"),
    )


def register_records(customer: DataFrame) -> DataFrame:
    """Company register rows: one per customer plus a second record for every
    13th customer; padded, lower-case, blank, short and null codes."""
    seg = F.col("c_mktsegment")
    naf = (F.when(seg == "BUILDING", "43.21A").when(seg == "AUTOMOBILE", "45.11Z")
           .when(seg == "MACHINERY", "28.22Z").when(seg == "HOUSEHOLD", "62.01Z")
           .otherwise("31.09B"))
    key = F.col("c_custkey")
    first = customer.select(
        _siren("c_custkey").alias("siren"),
        F.when(key % 37 == 0, F.lit("6")).when(key % 19 == 0, F.lit(None).cast("string"))
         .when(key % 41 == 0, F.lit("  "))
         .when(key % 17 == 0, F.concat(F.lit(" "), F.lower(naf), F.lit(" ")))
         .otherwise(naf).alias("activitePrincipaleUniteLegale"),
        F.when(key % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name"))
         .alias("denominationUniteLegale"),
        F.when(key % 11 == 0, F.lit(None).cast("string")).when(key % 2 == 0, F.lit("PME"))
         .otherwise(F.lit("ETI")).alias("categorieEntreprise"),
    )
    second = customer.where(key % 13 == 0).select(
        _siren("c_custkey").alias("siren"),
        F.lit("84.11Z").alias("activitePrincipaleUniteLegale"),
        F.col("c_name").alias("denominationUniteLegale"),
        F.lit("PME").alias("categorieEntreprise"),
    )
    return first.unionByName(second)


def fixture_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_accounts(read_table(spark, sf_dir, "orders"))


def fixture_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register_records(read_table(spark, sf_dir, "customer"))


def amended_accounts(raw: DataFrame) -> DataFrame:
    """All accounts with fractional amounts, equity of 0, and amended filings of
    the same company and year: equal in type and date, of other types and
    without one, and later ones."""
    n = F.col("total_actif")
    amounts = {f.name for f in raw.schema.fields if f.dataType.simpleString() == "bigint"}
    amounts.discard("effectif_moyen")
    fractional = raw.select(*[
        (F.col(c) + (n % 4) * F.lit(0.25)).alias(c) if c in amounts else F.col(c)
        for c in raw.columns]).withColumn("_n", F.floor("total_actif").cast("bigint"))
    zero = fractional.withColumn("capitaux_propres", F.when(
        F.col("_n") % 7 == 0, F.lit(0.0)).otherwise(F.col("capitaux_propres")))
    # a filing and its amended ones come from one pass over the accounts, not from one each
    kinds = F.array(F.lit("as filed"), F.when(F.col("_n") % 3 == 0, F.lit("same")),
                    F.when(F.col("_n") % 5 == 0, F.lit("other")), F.when(F.col("_n") % 11 == 0, F.lit("later")))
    rows = zero.withColumn("_kind", F.explode(F.filter(kinds, lambda k: k.isNotNull())))

    def amended(kind, c, value):
        return F.when(F.col("_kind") == kind, value).otherwise(F.col(c))

    return rows.withColumns({
        "ebe": amended("same", "ebe", F.when(F.col("_n") % 2 == 0, F.col("ebe") - 1.5)),
        "reserves": amended("same", "reserves", F.col("reserves") + 0.5),
        "type_bilan": amended("other", "type_bilan", F.when(F.col("_n") % 10 == 0, F.lit("N"))),
        "date_cloture_exercice": amended("later", "date_cloture_exercice", F.date_add("date_cloture_exercice", 30)),
        "chiffre_affaires": amended("later", "chiffre_affaires", F.col("chiffre_affaires") * 2),
    }).drop("_n", "_kind")


def damaged(table: DataFrame, number, not_null: list[str], accepted: dict[str, list]) -> DataFrame:
    """All rows of ``table``, of which every fifth (by ``number``, a column of
    integers) twice, with nulls and values that the declared checks refuse."""
    n = F.col("_n")
    rows = table.withColumn("_n", number)
    rows = rows.unionByName(rows.where(n % 5 == 0))
    changes = {}
    for i, c in enumerate(accepted):
        odd = F.lit("INCONNU" if isinstance(accepted[c][0], str) else 1900)
        changes[c] = F.when(n % (11 + 2 * i) == 3, odd).otherwise(F.col(c))
    for i, c in enumerate(not_null):
        changes[c] = F.when(n % (17 + 2 * i) != 1, changes.get(c, F.col(c)))
    return rows.withColumns(changes).drop("_n") if changes else rows.drop("_n")
