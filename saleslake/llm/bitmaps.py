"""Filters of a fixed size over keys: a set bit may be another key's, an unset bit is never wrong."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 24  # 2 MB, whatever the data


def bitmap(keys: DataFrame, name: str) -> np.ndarray:
    """Bits of all keys; at most 2**BITS / 64 rows reach the driver."""
    place = F.col(name).bitwiseAND(F.lit((1 << BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    words = keys.select(place.alias("place")).groupBy(F.expr("place div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = words.toArrow()
    bits = np.zeros((1 << BITS) // 64, np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits


def contains(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys.view(np.int64) & ((1 << BITS) - 1)
    return (bits[place >> 6] >> (place & 63)) & 1 == 1




def flagged(df: DataFrame, name: str, keys: DataFrame, key: str) -> DataFrame:
    """``_row`` (all columns as a struct) and ``_maybe``: false where the row's key isn't among the keys.

    Rows without the flag need no join with the keys, so their texts aren't shuffled.
    """
    bits = df.sparkSession.sparkContext.broadcast(bitmap(keys, key))

    @F.pandas_udf(T.BooleanType())
    def maybe(ids: pd.Series) -> pd.Series:
        return pd.Series(contains(bits.value, ids.fillna(0).to_numpy(np.int64)) & ids.notna().to_numpy())

    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    return df.select(row, maybe(F.col(name).cast("long")).alias("_maybe"))
