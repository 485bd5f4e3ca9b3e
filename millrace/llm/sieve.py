"""A bitmap that leaves out most rows without a partner before they are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 8 MB, 17 as a hashed table: the proven bound of what is broadcast. Past what it holds well, more rows pass and results are the same.
BITMAP_BITS = 1 << 26


def possibly_in(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows whose value of a long column may be among those wanted: all that are, and few others."""
    spot = lambda: F.pmod(F.col(column), F.lit(BITMAP_BITS)) + 1
    bits = wanted.groupBy(F.bitmap_bucket_number(spot()).alias("_md_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot())).alias("_md_bits"))
    probed = rows.withColumn("_md_at", F.bitmap_bit_position(spot())).withColumn("_md_bucket", F.bitmap_bucket_number(spot())).join(F.broadcast(bits), "_md_bucket")
    byte = F.conv(F.hex(F.substring("_md_bits", F.floor(F.col("_md_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return probed.where(F.floor(byte / F.pow(F.lit(2), F.col("_md_at") % 8)) % 2 == 1).drop("_md_bucket", "_md_at", "_md_bits")
