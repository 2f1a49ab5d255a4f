"""Column expressions on text shared by the operators that stay inside Spark's own functions."""

from __future__ import annotations

import gc
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import checkpoint_root

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words in order; an empty array for null and for text without words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def null_safe_key(value: Column) -> Column:
    """A string key that is never null and keeps null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder and read from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def let_go(spark: SparkSession) -> None:
    """Frees the disk of shuffles and checkpoints that nothing refers to any more.

    Spark deletes them when the driver's JVM collects garbage, which one with little to do
    does late; for use after a large shuffle that a checkpoint has made needless.
    """
    gc.collect()
    spark._jvm.System.gc()


def any_lower(text: Column) -> Column:
    """Lower case for matching ASCII phrases, faster than ``ascii_lower``.

    The two characters whose lower case holds an ASCII letter are replaced by another
    letter first, so that no text comes to equal an ASCII phrase that did not before.
    """
    for sign in ("K", "İ"):
        text = F.replace(text, F.lit(sign), F.lit("ĸ"))
    return F.lower(text)


BROADCAST_ROWS = 200_000


def small(df: DataFrame, items: str | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast only if the checked number of rows allows; else a join shuffles.

    With an array column ``items`` the number of its elements counts.
    """
    counted = F.count("*") if items is None else F.coalesce(F.sum(F.size(items)), F.lit(0))
    return F.broadcast(df) if df.select(counted).first()[0] <= most else df


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row.

    A plain column may be put in place of its name wherever later filters and lambdas use
    it, which would split a text again for each of its words; a generator's is not.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
