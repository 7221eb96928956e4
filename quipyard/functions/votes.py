"""Votes and token scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quipyard.functions.text import strip


def parse_votes(text: Column) -> Column:
    """Whole number in a text cell (`12`, ` 12 `, `12.0`), else null."""
    number = strip(text).try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def net_votes(up: Column, down: Column) -> Column:
    return up - down


def vote_ratio(up: Column, down: Column) -> Column:
    """Down votes per up vote; null instead of an error at zero up votes."""
    return F.try_divide(down.cast("double"), up.cast("double"))


def token_probability(logprob: Column) -> Column:
    return F.exp(logprob)


def percent_text(share: Column) -> Column:
    """Percent with two decimals, rounded on the exact binary value, ties to even."""
    value = F.abs(share * F.lit(100.0))
    hundredths = value * 100.0
    # what the product has lost: the halves of the factor multiply exactly
    split = value * 134_217_729.0
    high = split - (split - value)
    lost = (high * 100.0 - hundredths) + (value - high) * 100.0
    whole = F.floor(hundredths)
    over = (hundredths - whole - 0.5) + lost
    rounded = whole + F.when((over > 0) | ((over == 0) & (whole % 2 == 1)), 1).otherwise(0)
    sign = F.when(share < 0, "-").otherwise("")
    cents = F.lpad((rounded % 100).cast("string"), 2, "0")
    return F.concat(sign, F.floor((rounded - rounded % 100) / 100).cast("string"), F.lit("."), cents, F.lit("%"))
