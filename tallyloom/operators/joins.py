"""Joins and row expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.keyed import latest_per_key


def join_left_dim(
    facts: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], unique: bool = True
) -> DataFrame:
    """Look up dimension columns, keeping every fact.

    The dimension goes out as a broadcast only when its measured size is under the
    session's limit; beyond it adaptive execution splits a hot key.  Pass
    ``unique=False`` for a dimension whose key may repeat.
    """
    dim = dim.select(key, *columns).where(F.col(key).isNotNull())
    if not unique:
        dim = latest_per_key(dim, [key], list(columns))
    return facts.join(dim, key, "left")


def number_rows(df: DataFrame, digits: Sequence[Sequence[int]], out: str = "seq") -> DataFrame:
    """Pair every row with each combination of the digit lists, numbered from 1.

    The lists are constants, so a row expands in place: nothing is joined or shuffled.
    """
    widths = [len(d) for d in digits]
    for place, values in enumerate(digits):
        pairs = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(v).alias("digit")) for i, v in enumerate(values)])
        df = df.withColumn(f"_d{place}", F.explode(pairs))
    number = F.lit(0)
    for place, width in enumerate(widths):
        number = number * width + F.col(f"_d{place}.at")
    df = df.withColumn(out, number + 1)
    for place in range(len(widths)):
        df = df.withColumn(f"digit_{place + 1}", F.col(f"_d{place}.digit")).drop(f"_d{place}")
    return df
