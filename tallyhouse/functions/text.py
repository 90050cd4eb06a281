"""Text normalisation and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_name(raw: Column, honorific: str) -> Column:
    """Title case without the leading honorific matched by `honorific`."""
    return F.initcap(F.regexp_replace(F.trim(raw), honorific, ""))


def code(raw: Column) -> Column:
    """An upper-case code without surrounding spaces."""
    return F.upper(F.trim(raw))


def map_lookup(key: Column, values: Mapping[str, str]) -> Column:
    """Value for `key` from a small constant map; NULL for an unknown key."""
    entries = [F.lit(x) for x in chain.from_iterable(values.items())]
    return F.create_map(*entries)[key]


def yes_no(flag: Column, yes: str, no: str) -> Column:
    return F.when(flag, yes).otherwise(no)


def hour_label(hour: Column) -> Column:
    """7 -> '07h'."""
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit("h"))


def ordinal(value: Column, order: Sequence[str]) -> Column:
    """1-based place of `value` in a business order; 0 when it is not listed."""
    return F.array_position(F.array(*[F.lit(v) for v in order]), value).cast("int")


def joined_set(values: Column, separator: str = ", ") -> Column:
    """Aggregate: the distinct values, sorted and joined into one text."""
    return F.concat_ws(separator, F.sort_array(F.collect_set(values)))


def codes_of(labels: Sequence[str], shown: Mapping[str, str]) -> list[str]:
    """The stored codes behind chosen labels, so that a filter can reach the scan; unknown labels stay."""
    codes = {label: code for code, label in shown.items()}
    return [codes.get(label, label) for label in labels]
