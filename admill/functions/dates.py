"""Columns over dates: loosely typed inputs, ages and cohorts. Now is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_date(value: Column) -> Column:
    """Date text of epoch seconds, ISO time stamps, or the first ten characters of anything else; empty is null."""
    text = F.nullif(value.cast("string"), F.lit(""))
    epoch = F.date_format(F.timestamp_seconds(text.try_cast("long")), "yyyy-MM-dd")
    parsed = F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd")
    return F.when(text.rlike("^[0-9]+$"), epoch).otherwise(F.coalesce(parsed, F.substring(text, 1, 10)))


def days_active(start: Column, end: Column, as_of: Column) -> Column:
    """Whole days from start to end (or as_of), never below zero; zero if start is missing."""
    return F.coalesce(F.greatest(F.lit(0), F.datediff(F.coalesce(end, as_of), start)), F.lit(0))


def cohort(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def target_age(start: Column, stop: Column, as_of: Column) -> Column:
    return F.datediff(F.coalesce(stop, as_of), start)
