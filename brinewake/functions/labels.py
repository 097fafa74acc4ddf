"""Vessel classes, radii and normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: class labels in order, the exclusion margin and the grid of radii
CLASSES = ("background", "cargo", "passengership", "tanker", "tug")
EXCLUSION_MARGIN = 2000
RADII = tuple(range(1000, 10001, 1000))


def class_of(code: Column) -> Column:
    """Class of a type-and-cargo code; NULL is ``other``."""
    return (
        F.when(code == 0, "background")
        .when(code == 52, "tug")
        .when(code.between(60, 69), "passengership")
        .when(code.between(70, 79), "cargo")
        .when(code.between(80, 89), "tanker")
        .otherwise("other")
    )


def exclusion_radius(inclusion: Column) -> Column:
    return inclusion + EXCLUSION_MARGIN


def scenario_key(inclusion: Column, exclusion: Column) -> Column:
    """``in_01000_out_03000``."""
    return F.format_string("in_%05d_out_%05d", inclusion.cast("int"), exclusion.cast("int"))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low), NULL where high = low."""
    return F.try_divide(value - low, high - low)
