"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.session import ship_package

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# ASCII white space, the only separators of words: space, \t \n \v \f \r.
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus; ``sf_dir`` may be any path Spark can read."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, parts: int) -> Column:
    """Fold of a row: crc32 of the id written as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(parts)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII strings (as many bytes as code
    points) take ``lower``, which does the same there and is much faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def hash128(c: Column) -> Column:
    """128-bit key of a string as a pair of differently seeded hashes."""
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(7), c).alias("b"))
