"""Monthly reference-data normalisation (NRM-1..NRM-5).

Input: the landed ``markets`` and ``companies`` drops of one run date (read
with the fixed schemas of :mod:`marketlake.schemas`).  Output: the five
normalised tables without ids (ids are attached at load, LOD-1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import split_explode
from ..operators.clean import allowlist, drop_incomplete_distinct, rename_fields

# The listing venues and currency a company must have to be kept.
KEPT_EXCHANGES = ["NASDAQ", "NYSE"]
KEPT_CURRENCY = "USD"


def regions(markets: DataFrame) -> DataFrame:
    """NRM-1: distinct complete (region, local_open, local_close)."""
    return drop_incomplete_distinct(markets, ["region", "local_open", "local_close"])


def exchanges(markets: DataFrame) -> DataFrame:
    """NRM-4: one (name, region) per comma-separated primary exchange.

    Null or empty lists give no row; inner blanks (``"A,,B"``) stay as ``''``
    names; names are white-space trimmed; complete distinct rows only."""
    rows = split_explode(markets.select("primary_exchanges", "region"),
                         "primary_exchanges", ",", out="name")
    return drop_incomplete_distinct(rows, ["name", "region"])


def industries(companies_raw: DataFrame) -> DataFrame:
    """NRM-2: distinct complete (industry, sector); blank pairs are kept."""
    return drop_incomplete_distinct(companies_raw, ["industry", "sector"])


def sic_industries(companies_raw: DataFrame) -> DataFrame:
    """NRM-3: distinct complete (sic code, sic_industry, sic_sector) where the
    code is present."""
    rows = companies_raw.where(F.col("sic").isNotNull()).select(
        F.col("sic").alias("id"), F.col("sicIndustry").alias("sic_industry"),
        F.col("sicSector").alias("sic_sector"))
    return drop_incomplete_distinct(rows)


def companies(companies_raw: DataFrame, kept_exchanges=KEPT_EXCHANGES,
              currency: str = KEPT_CURRENCY) -> DataFrame:
    """NRM-5: the 11 company columns, complete rows only, distinct, listed on
    a kept exchange and quoted in the kept currency (``kept_exchanges=None``
    keeps every venue)."""
    rows = drop_incomplete_distinct(rename_fields(companies_raw, schemas.COMPANY_RENAMES))
    if kept_exchanges is None:
        return rows.where(F.col("currency") == F.lit(currency))
    return allowlist(rows, "exchange", kept_exchanges, currency=currency)


def normalise_all(markets: DataFrame, companies_raw: DataFrame,
                  kept_exchanges=KEPT_EXCHANGES) -> dict[str, DataFrame]:
    return {
        "regions": regions(markets),
        "exchanges": exchanges(markets),
        "industries": industries(companies_raw),
        "sic_industries": sic_industries(companies_raw),
        "companies": companies(companies_raw, kept_exchanges),
    }
