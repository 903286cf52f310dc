"""A bounded bitmap of keys, to drop what can't match before a shuffle.

Every key sets one bit of a bitmap, found by its hash; a row whose bit is not
set has none of the keys.  The bitmap is a small table (bucket, 4 kB of bits),
so its size is bounded by construction and it may be broadcast.  Keys that
share a bit only let more rows through; the exact join decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most bytes of a bitmap.
MAX_BYTES = 32 << 20
#: Bits for each key, so that about one row in seventeen passes without a match.
BITS_PER_KEY = 16
#: Bits in a row of the bitmap table, as Spark's bitmap functions cut it.
BUCKET_BITS = 32_768


def bitmap_bits(n_keys: int, max_bytes: int = MAX_BYTES) -> int:
    """Bits of the bitmap: a power of two, one bucket at least."""
    wanted = 1 << max(n_keys * BITS_PER_KEY - 1, 0).bit_length()
    return max(BUCKET_BITS, min(wanted, 1 << (max_bytes * 8).bit_length() - 1))


def _place(keys, bits: int) -> Column:
    """The bit of a key, from 1 on."""
    return F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1


def key_bitmap(rows: DataFrame, keys, bits: int) -> DataFrame:
    """_bucket, _bits of the keys of ``rows``; at most ``bits`` / 8 bytes, aggregated before the shuffle."""
    place = rows.select(_place(keys, bits).alias("p"))
    return place.groupBy(F.bitmap_bucket_number("p").alias("_bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits"))


def may_match(rows: DataFrame, bitmap: DataFrame, keys, bits: int) -> DataFrame:
    """Rows whose key may be in the bitmap: all that are in it, and few others."""
    place = rows.withColumn("_place", _place(keys, bits)) \
        .withColumn("_bucket", F.bitmap_bucket_number("_place")).withColumn("_bit", F.bitmap_bit_position("_place"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (F.col("_bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    hit = place.alias("r").join(F.broadcast(bitmap).alias("b"), (F.col("r._bucket") == F.col("b._bucket")) & is_set, "left_semi")
    return hit.drop("_place", "_bucket", "_bit")
