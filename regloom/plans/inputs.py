"""Register inputs derived from the star-schema tables.

Orders stand for establishments and customers for companies. Missing-value
markers, gaps and closed sites are placed by arithmetic on the keys, over every row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.plans.cleaning import clean_establishments, clean_legal_units
from regloom.sources.layouts import ESTABLISHMENTS, LEGAL_UNITS, Layout

AS_OF = datetime(2024, 8, 1)
BEFORE = datetime(2024, 7, 1)
ETAB_FILE = "2024-08-01-StockEtablissement_utf8.csv"
ETAB_FILE_BEFORE = "2024-07-01-StockEtablissement_utf8.csv"
LEGAL_FILE = "2024-08-01-StockUniteLegale_utf8.csv"
LEGAL_FILE_BEFORE = "2024-07-01-StockUniteLegale_utf8.csv"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _filled(layout: Layout, given: list[str], seq: str, shift: int) -> list[str]:
    """A value for every header that is not given, another for each header and each shift."""
    others = [f for f in layout.fields if f.header not in given]
    text = {
        "int": f"string(2000 + ({seq} + {shift}) % 20)",
        "double": f"string({seq} + {shift})",
    }
    return [
        f"{text.get(f.type, f"'e{i}-' || string(({seq} + {shift}) % {7 + i})")} as {f.header}"
        for i, f in enumerate(others)
    ]


def etab_raw(spark: SparkSession, folder: str, shift: int = 0) -> DataFrame:
    """Every column of the wide vintage; ``shift`` changes their values, not the ``siret``."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    orders = table(spark, folder, "orders")
    sites = orders.join(customers, orders.o_custkey == customers.c_custkey)
    sites = sites.join(nations, sites.c_nationkey == nations.n_nationkey)
    office, other = ("false", "true") if shift else ("true", "false")
    given = {
        "siren": f"lpad(string(o_custkey + {shift}), 9, '0')",
        "nic": f"lpad(string((o_orderkey + {shift}) % 100000), 5, '0')",
        "siret": "case when o_orderkey % 23 != 0 then lpad(string(o_orderkey), 14, '0') end",
        "etatAdministratifEtablissement": "case o_orderstatus when 'F' then 'F' when 'O' then 'A' end",
        "etablissementSiege": f"case o_orderpriority when '1-URGENT' then '{office}'"
        f" when '5-LOW' then null else '{other}' end",
        "nombrePeriodesEtablissement": "case o_orderkey % 9 when 0 then 'NN' when 1 then 'x'"
        f" else string(1 + (o_orderkey + {shift}) % 4) end",
        "complementAdresseEtablissement": f"case (o_orderkey + {shift}) % 5 when 0 then '[ND]'"
        " when 1 then '' when 2 then null else c_mktsegment end",
        "numeroVoieEtablissement": "case when o_orderkey % 3 != 0"
        f" then string((o_orderkey + {shift}) % 200) end",
        "indiceRepetitionEtablissement": f"case (o_orderkey + {shift}) % 7 when 0 then 'B'"
        " when 1 then 'NN' end",
        "typeVoieEtablissement": f"case when (o_orderkey + {shift}) % 4 != 0 then 'RUE' end",
        "libelleVoieEtablissement": "n_name",
        "libelleCommuneEtablissement": f"n_name || '{' B' * shift}'",
        "codePostalEtablissement": "case when o_orderkey % 11 != 0"
        f" then lpad(string((o_orderkey + {shift}) % 4), 5, '0') end",
    }
    columns = [f"{e} as {h}" for h, e in given.items()]
    columns += _filled(ESTABLISHMENTS, list(given), "o_orderkey", shift)
    return sites.selectExpr("o_orderkey as seq", *columns)


def etab_raw_early(spark: SparkSession, folder: str) -> DataFrame:
    """The establishments with headers of the narrower vintage."""
    return etab_raw(spark, folder).select("seq", *ESTABLISHMENTS.early_headers)


def etab_raw_late(spark: SparkSession, folder: str) -> DataFrame:
    """The establishments once more, with headers of the wider vintage."""
    return etab_raw(spark, folder).selectExpr(
        "seq",
        "siren",
        "siret",
        "case when seq % 10 = 0 then '[ND]' else string(seq * 1.5D) end"
        " as coordonneeLambertAbscisseEtablissement",
    )


def etab_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_establishments(etab_raw(spark, folder), ETAB_FILE, AS_OF, keep=["seq"])


def legal_raw(spark: SparkSession, folder: str, shift: int = 0) -> DataFrame:
    """Every column; ``shift`` changes their values, not the ``siren``."""
    key = f"(c_custkey + {shift})"
    given = {
        "siren": "case when c_custkey % 29 != 0 then lpad(string(c_custkey), 9, '0') end",
        "denominationUniteLegale": "case c_custkey % 13 when 0 then '[ND]' when 1 then null"
        f" else c_name || '{' B' * shift}' end",
        "categorieJuridiqueUniteLegale": f"case {key} % 6 when 0 then '5499' when 1 then '5710'"
        " when 2 then '5505' when 3 then '1000' when 4 then '0000' end",
        "trancheEffectifsUniteLegale": f"case {key} % 7 when 0 then '00' when 1 then '01'"
        " when 2 then '2' when 3 then '53' when 4 then 'NN' when 5 then 'null' end",
        "etatAdministratifUniteLegale": f"case {key} % 5 when 0 then 'A' when 1 then 'C' end",
        "activitePrincipaleUniteLegale": "case when c_custkey % 8 = 0 then '99'"
        " else lpad(string(c_nationkey), 2, '0') end",
        "dateCreationUniteLegale": f"string(1990 + {key} % 30) || '-01-01'",
    }
    columns = [f"{e} as {h}" for h, e in given.items()]
    columns += _filled(LEGAL_UNITS, list(given), "c_custkey", shift)
    return table(spark, folder, "customer").selectExpr("c_custkey as seq", *columns)


def legal_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_legal_units(legal_raw(spark, folder), LEGAL_FILE, AS_OF, keep=["seq"])


def naf_translations(spark: SparkSession, folder: str) -> DataFrame:
    """Activity names; one code of the legal units has none."""
    return table(spark, folder, "nation").selectExpr(
        "lpad(string(n_nationkey), 2, '0') as code",
        "n_name as name_en",
        "'FR_' || n_name as name_fr",
    )


def siren_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Company numbers, some too short and some missing."""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey as seq",
        "case when c_custkey % 17 = 0 then lpad(string(c_custkey), 8, '0')"
        " when c_custkey % 19 != 0 then lpad(string(c_custkey), 9, '0') end as siren",
    )


def batch_durations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id as fragment_id", "event_type as flow", "value as seconds"
    )


def snapshots(
    earlier: DataFrame, newer: DataFrame, keys: DataFrame, key: str, loaded: float, new: float
) -> tuple[DataFrame, DataFrame]:
    """An earlier and a newer snapshot that share keys.

    The earlier one has the rows up to ``loaded`` of the highest key, the newer one
    those beyond ``new`` of it. Together they hold every key.
    """
    highest = keys.agg(F.max(key))
    seq = F.col("seq")
    return (
        earlier.filter(seq <= loaded * highest.scalar()),
        newer.filter(seq > new * highest.scalar()),
    )


def etab_snapshots(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The two overlap by three tenths of the key range, with other values in every column."""
    orders = table(spark, folder, "orders")
    raws = etab_raw(spark, folder), etab_raw(spark, folder, shift=1)
    return snapshots(*raws, orders, "o_orderkey", 0.6, 0.3)


def legal_snapshots(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The two overlap by four tenths of the key range, with other values in most columns."""
    customers = table(spark, folder, "customer")
    raws = legal_raw(spark, folder), legal_raw(spark, folder, shift=1)
    return snapshots(*raws, customers, "c_custkey", 0.7, 0.3)
