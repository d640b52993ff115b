"""A set of keys as a bit table of fixed size, small enough to send to every task.

It answers "surely not" or "maybe": rows it rejects need no shuffle, and an exact join
decides on the others. With more keys than bits it lets more rows pass, nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlake.llm.files import staged

BITS = 24  # 2**24 bits: at most 2**18 rows of 64


def _bit(key: Column) -> tuple[Column, Column]:
    bit = F.pmod(F.xxhash64(key), F.lit(1 << BITS))
    return F.shiftright(bit, 6), (bit % 64).cast("int")


def bit_table(keys: DataFrame, key: str) -> DataFrame:
    word, place = _bit(F.col(key))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    words = keys.select(word.alias("_word"), one.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    return staged(words, "bit-table")


def maybe_in(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """The rows whose key may be in the table; no shuffle. The broadcast has 2**18 rows at most."""
    word, place = _bit(F.col(key))
    near = rows.join(F.broadcast(table), word == F.col("_word"))
    return near.filter(F.getbit("_bits", place) == 1).select(*rows.columns)
