"""Column helpers for identifiers, addresses and query texts. All stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "query_label", "hex_prefix", "dashed_uuid", "is_blank", "address_part", "port_part",
    "bare_address", "rr_key", "int_or_null", "json_field", "mega", "left_pad", "right_pad",
]

_MEGA = 1024


def query_label(query: Column, length: int = 60) -> Column:
    """One-line label of a statement: first `length` characters, newlines as blanks. Cutting first leaves only
    the label to rewrite, however long the text."""
    return F.replace(F.substring(query, 1, length), F.lit("\n"), F.lit(" "))


def hex_prefix(uuid: Column, length: int = 15) -> Column:
    """First `length` hex digits of a dashed uuid; storage events carry this form in their aux field."""
    return F.substring(F.replace(uuid, F.lit("-"), F.lit("")), 1, length)


def dashed_uuid(seed: Column) -> Column:
    """uuid text (8-4-4-4-12) from the md5 of `seed`, which is computed once per use."""
    text = F.md5(seed)
    for position in (21, 17, 13, 9):
        text = F.overlay(text, F.lit("-"), position, 0)
    return text


def is_blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""


def address_part(endpoint: Column) -> Column:
    return F.split_part(endpoint, F.lit(":"), F.lit(1))


def port_part(endpoint: Column) -> Column:
    return int_or_null(F.split_part(endpoint, F.lit(":"), F.lit(2)))


def bare_address(inet: Column) -> Column:
    """Host text of an address that may carry a netmask (`10.0.0.1/32`)."""
    return F.split_part(inet, F.lit("/"), F.lit(1))


def rr_key(rr_uuid: Column) -> Column:
    """Display number of a root request: the first 60 bits of its uuid. Joins always use the uuid."""
    return F.conv(hex_prefix(rr_uuid), 16, 10).cast("long")


def int_or_null(text: Column, to: str = "int") -> Column:
    """Lenient cast for ingested text: blanks and junk become NULL instead of failing the job."""
    return text.try_cast(to)


def json_field(text: Column, field: str) -> Column:
    return F.get_json_object(text, f"$.{field}")


def mega(value: Column) -> Column:
    """Bytes to MB by two integer divisions, truncating towards zero (no trip through double)."""
    return F.call_function("div", F.call_function("div", value, F.lit(_MEGA)), F.lit(_MEGA))


def left_pad(text: Column, width: int) -> Column:
    return F.lpad(text, width, " ")


def right_pad(text: Column, width: int) -> Column:
    return F.rpad(text, width, " ")
