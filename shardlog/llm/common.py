"""Expressions that several corpus operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the white space that separates words, [\x20\x09-\x0D]
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(column, F.lit(""))


def squeezed(text: Column) -> Column:
    """The text without any white space."""
    return F.translate(text, SPACES, "")


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(F.translate(text, SPACES[1:], " " * 5), " "), "")


def lowest(df: DataFrame, sample: int, by: str, *ties: str) -> DataFrame:
    """The ``sample`` rows with the smallest hashes ``by``, or all; of equal hashes those first by ``ties``.

    The rows are counted, and only those whose hash is so small that about a tenth more than
    ``sample`` are expected go on to be ordered: what meets in one task does not grow with
    the number of rows or tasks. Equal hashes should be few.
    """
    n = df.count()
    wanted = sample + sample // 10 + 50
    if n > wanted:
        df = df.where(F.col(by) <= F.lit(((1 << 64) - 1) * wanted // n - (1 << 63)))
    return df.orderBy(by, *ties).limit(sample)
