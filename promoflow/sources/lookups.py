"""Lookup tables read from storage (S4, S5, S6): full schemas, of which a plan scans what it uses.

Filters on plain columns and the fields of nested ones reach the Parquet scan; nothing is
inferred, so opening a table costs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoflow import settings as S

CATALOGUE = ("PROD_ID string, PROD_NM string, MDSE_CATG_CD int, MDSE_SUB_CATG_CD int, ITEM_ID_ARRAY array<bigint>")
MEMBER_CARDS = ("cardNumber string, membershipId string, holderName string, current_ind string, card_current_ind string, "
                "cardStatus string, cardType string")
STORE_DIRECTORY = ("id bigint, name string, address struct<street:string,city:string,state:string,postalCode:string>, "
                   "isActive boolean, clubType string")


def read_catalogue(spark: SparkSession, path: str, category: int | None = None) -> DataFrame:
    """(PROD_ID, MDSE_CATG_CD, MDSE_SUB_CATG_CD, ITEM_ID_ARRAY) of the item catalogue, of one
    category if given."""
    df = spark.read.schema(CATALOGUE).parquet(path).select("PROD_ID", "MDSE_CATG_CD", "MDSE_SUB_CATG_CD", "ITEM_ID_ARRAY")
    return df if category is None else df.filter(F.col("MDSE_CATG_CD") == category)


def read_member_cards(spark: SparkSession, path: str) -> DataFrame:
    """The cards of the account type with both current flags; the padded status is compared
    by ``active_member_cards``."""
    return (spark.read.schema(MEMBER_CARDS).parquet(path)
            .filter((F.col("current_ind") == S.CARD_CURRENT_FLAG) & (F.col("card_current_ind") == S.CARD_CURRENT_FLAG)
                    & (F.col("cardType") == S.CARD_TYPE))
            .select("cardNumber", "membershipId", "current_ind", "card_current_ind", "cardStatus", "cardType"))


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """The active stores (id, address with its state, isActive, clubType); of the address only
    the state is read."""
    return (spark.read.schema(STORE_DIRECTORY).parquet(path).filter(F.col("isActive"))
            .select("id", F.struct(F.col("address.state").alias("state")).alias("address"), "isActive", "clubType"))
