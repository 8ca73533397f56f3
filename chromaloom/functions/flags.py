"""Alignment flag bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: bits of the alignment flag field
PAIRED = 1
UNMAPPED = 4
REVERSE = 16
FIRST = 64
SECONDARY = 256
DUPLICATE = 1024


def has_flag(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(F.lit(mask)) == mask


def lacks_flag(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(F.lit(mask)) == 0


def strand(flag: Column) -> Column:
    """0 forward, 16 reverse."""
    return flag.bitwiseAND(F.lit(REVERSE))


def set_flag(flag: Column, mask: int) -> Column:
    return flag.bitwiseOR(F.lit(mask))


def flag_filter(df: DataFrame, all_of: int = 0, none_of: int = 0, col: str = "flag") -> DataFrame:
    """Keep rows with every bit of ``all_of`` and no bit of ``none_of``."""
    return df.where(has_flag(F.col(col), all_of) & lacks_flag(F.col(col), none_of))
