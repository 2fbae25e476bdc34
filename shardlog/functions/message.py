"""Column functions on one message: its payload, its key and the code tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.schema import POSITION_CODES, STATUS_CODES


def message(data: Column, key: Column) -> Column:
    """A new message; it has no sequence number until the stream assigns one."""
    return F.struct(
        data.alias("data"),
        key.alias("partition_key"),
        F.lit(None).cast("string").alias("sequence_number"),
    )


def set_value(records: DataFrame, value: Column) -> DataFrame:
    return records.withColumn("data", value)


def value(data: str = "data") -> Column:
    return F.col(data)


def key_bytes(key: str = "partition_key") -> Column:
    """Key as bytes: null stays null, the empty key becomes empty bytes."""
    return F.encode(F.col(key), "UTF-8")


def value_text(data: str = "data") -> Column:
    return F.decode(F.col(data), "UTF-8")


def append_terminator(data: Column, terminator: bytes = b"") -> Column:
    """Payload followed by the terminator; a null payload counts as empty."""
    if not terminator:
        return data
    return F.concat(F.coalesce(data, F.lit(bytearray())), F.lit(bytearray(terminator)))


def _name_of(code: Column, names: dict[int, str]) -> Column:
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), code.cast("int")), F.lit(""))


def position_name(code: Column) -> Column:
    """Start position name of a code; an unknown code gives the empty string."""
    return _name_of(code, POSITION_CODES)


def status_name(code: Column) -> Column:
    return _name_of(code, STATUS_CODES)
