"""Extraction of fields and routing by rules."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklogs.functions.parsing import extract_field
from sparklogs.operators.filters import search_filter

Rule = tuple[str, str] | tuple[str, Callable[[Column], Column]]


def extract_fields(df: DataFrame, rules: list[Rule], literal: bool = False) -> DataFrame:
    """One column for each (template, name) or (name, function of the message); a later rule of a name wins."""
    message, made = F.col("message"), {}
    for a, b in rules:
        if callable(b):
            made[a] = b(message)
        else:
            made[b] = extract_field(message, a, literal)
    return df.withColumns(made) if made else df


def route_first_match(df: DataFrame, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """`df` with `rule` and `routed`: name and result of the first rule (name, condition, struct) that fits; rows that fit none go.

    The structs of all rules need one schema.
    """
    if not rules:
        return df.where("false").withColumns({"rule": F.lit(None).cast("string"), "routed": F.lit(None)})
    name = routed = None
    for rule, fits, result in rules:
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        routed = F.when(fits, result) if routed is None else routed.when(fits, result)
    return search_filter(df, [reduce(lambda a, b: a | b, [fits for _, fits, _ in rules])]).withColumns({"rule": name, "routed": routed})
