"""What the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import clear, drop, scratch, written  # noqa: F401  the operators take them from here
from ..sources.tables import read_table

#: Words are split at the space and at the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name, spread=name in ("documents", "pages"))


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


def id_text(c: str) -> Column:
    """An id as text for hashing; null gives the empty text."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))
