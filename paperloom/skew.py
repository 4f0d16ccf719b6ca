"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = 16


def salted_join(many: DataFrame, few: DataFrame, on: list[str], spread_by: str, how: str = "inner", salt: int = SALT) -> DataFrame:
    """Join ``many`` with ``few``, which has few rows for each key: the rows of one key of ``many``
    are spread over ``salt`` parts by the hash of ``spread_by``, and ``few`` is repeated for each."""
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    spread = many.withColumn("_salt", F.pmod(F.hash(spread_by), F.lit(salt)).cast("int"))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")
