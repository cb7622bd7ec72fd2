"""Conditions of declarative rules, with absence as a value.

None of them gives NULL: a missing value either meets the condition or does not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def equals(col: Column, value: object) -> Column:
    """NULL equals NULL."""
    return col.eqNullSafe(F.lit(value))


def present(col: Column) -> Column:
    """Neither NULL nor the empty string."""
    return col.isNotNull() & (col != "")


def absent(col: Column) -> Column:
    return ~present(col)


def one_of(col: Column, values: list) -> Column:
    return F.coalesce(col.isin(values), F.lit(False))


def none_of(col: Column, values: list) -> Column:
    """A missing value passes."""
    return F.coalesce(~col.isin(values), F.lit(True))


def lacks(array: Column, value: object) -> Column:
    """The list is there and does not have the value."""
    return F.coalesce(~F.array_contains(array, value), F.lit(False))


OPS = {
    "EQ": equals,
    "NOT_NULL": lambda c, _: present(c),
    "NULL": lambda c, _: absent(c),
    "IN": one_of,
    "NOT_IN": none_of,
    "ABSENT_IN": lacks,
}


def condition(field: Column, op: str, value: object = None) -> Column:
    return OPS[op](field, value)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def missing_fields(fields: list[str]) -> Column:
    """Names of the required fields that are NULL; the empty string is a value here."""
    return F.array_compact(F.array(*(F.when(F.col(f).isNull(), F.lit(f)) for f in fields)))
