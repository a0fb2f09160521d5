"""Anti join through a bit sketch of the stored keys.

Each stored key sets two bits of a bitmap that is built where the keys lie and kept in blocks of 4 KB. New keys are
probed before any exchange: a key with an unset bit is new for certain and stays where it is; only keys that may be stored are
joined with the stored ones. The bitmap is broadcast while it is at most MOST_BYTES; beyond that the exact join takes all keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

#: Bits of the bitmap for each stored key; about one unseen key in seventy then meets two set bits.
BITS, HASHES = 16, 2
MOST_BYTES = 64 << 20
BLOCK_BITS = 32_768
#: Bit ``_p{i}`` of the bitmap ``_m{i}``.
BIT = "(cast(conv(hex(substring(_m{i}, cast(bitmap_bit_position(_p{i}) div 8 as int) + 1, 1)), 16, 10) as int) >> cast(bitmap_bit_position(_p{i}) % 8 as int)) & 1"


def _places(key: str, bits: int) -> list[Column]:
    """The key's places in the bitmap, from 1."""
    return [F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(bits)) + 1 for i in range(HASHES)]


def key_sketch(stored: DataFrame, key: str, bits: int) -> DataFrame:
    """``(block, bitmap)`` of the stored keys; one row for each 32,768 bits that have one set."""
    places = stored.filter(F.col(key).isNotNull()).select(F.explode(F.array(*_places(key, bits))).alias("p"))
    return places.groupBy(F.bitmap_bucket_number("p").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))


def may_be_stored(rows: DataFrame, sketch: DataFrame, key: str, bits: int) -> DataFrame:
    """``rows`` with ``_maybe``: both bits of the key are set. A null key is in no sketch."""
    maybe = F.col(key).isNotNull()
    for i, place in enumerate(_places(key, bits)):
        side = F.broadcast(sketch.select(F.col("block").alias(f"_b{i}"), F.col("bitmap").alias(f"_m{i}")))
        rows = rows.withColumn(f"_p{i}", place)
        rows = rows.join(side, F.bitmap_bucket_number(F.col(f"_p{i}")) == F.col(f"_b{i}"), "left")
        maybe = maybe & F.coalesce(F.expr(BIT.format(i=i)) == 1, F.lit(False))
    return rows.withColumn("_maybe", maybe).drop(*[f"_{x}{i}" for x in "bmp" for i in range(HASHES)])


def sketch_anti_join(rows: DataFrame, stored: DataFrame, *, key: str, stored_key: str | None = None) -> DataFrame:
    """The rows whose key is not stored, as ``core.anti_join_on_key`` gives them; repeated rows and null keys stay."""
    known = stored.select(F.col(stored_key or key).alias("_seen"))
    n = known.count()
    bits = max(BLOCK_BITS, -(-n * BITS // BLOCK_BITS) * BLOCK_BITS)
    if bits // 8 > MOST_BYTES:
        return rows.join(known, rows[key] == known["_seen"], "left_anti")
    sketch = materialize(key_sketch(known, "_seen", bits), "key-sketch")
    probed = may_be_stored(rows, sketch, key, bits)
    again = probed.filter("_maybe").drop("_maybe")
    return probed.filter("NOT _maybe").drop("_maybe").unionByName(again.join(known, again[key] == known["_seen"], "left_anti"))
