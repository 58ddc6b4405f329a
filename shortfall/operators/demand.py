"""Demand-driven reduction: rows that the feed cannot reach are left out ahead of the aggregates.

A report shows inventory rows of the feed's vendor items (one hop) and of the items that replace those (two hops). The
items of both hops are put in a Bloom filter of a fixed size; inventory rows and usage transactions of other items drop
out where they are scanned, before the partial aggregates and any exchange. An item that the filter holds by mistake is
left out by the joins that follow, so no result depends on the filter. Rows without an item are kept.

The size of the filter bounds what travels to the tasks. With more items than it is made for it lets more rows through, but loses none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter (1 MB): a million items with under 5 % of the others let through.
FILTER_BITS = 1 << 23


def needed_items(feed: DataFrame, inventory: DataFrame, links: DataFrame) -> DataFrame:
    """(item): items with an inventory row of one of the feed's vendor items, and the items linked as their replacements."""
    wanted = feed.select("vendor_item").where("vendor_item IS NOT NULL").distinct()
    own = inventory.where("item IS NOT NULL").join(wanted, "vendor_item", "left_semi").select("item").distinct()
    others = links.join(own, "item", "left_semi").select(F.col("replace_item").alias("item")).where("item IS NOT NULL")
    return own.unionByName(others).distinct()


def _places(key: Column, bits: int) -> list[Column]:
    """The two bits of a key."""
    return [F.pmod(F.xxhash64(F.lit(seed), key.cast("string")), F.lit(bits)) for seed in (0, 1)]


def bloom_filter(items: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """(words): one row, the filter of the column ``item`` as ``bits`` / 64 numbers."""
    if bits < 64 or bits % 64:
        raise ValueError("bits must be a multiple of 64")
    masks = (items.select(F.explode(F.array(*_places(F.col("item"), bits))).alias("place"))
             .select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, int(place & 63L))").alias("mask"))
             .groupBy("word").agg(F.bit_or("mask").alias("mask")))
    every = items.sparkSession.range(bits // 64).withColumnRenamed("id", "word")
    dense = every.join(masks, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    # one row of bits / 64 numbers, whatever the number of items
    return dense.agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("w")).select(F.col("w.mask").alias("words"))


def keep_needed(rows: DataFrame, words: DataFrame, key: str = "item", bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose key the filter holds, and those without a key."""
    held = F.col(key).isNull()
    hits = [F.getbit(F.get(words.scalar(), F.shiftright(place, 6).cast("int")), place.bitwiseAND(63).cast("int")) == 1
            for place in _places(F.col(key), bits)]
    return rows.where(held | (hits[0] & hits[1]))
