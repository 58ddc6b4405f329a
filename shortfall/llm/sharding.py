"""Sharding with a permutation-filled lookup table (operator 1, native).

Every shard orders all slots of a prime-sized table by its own permutation and
the shards take turns claiming their best free slot. A key's slot is its hash
modulo the table size; a broadcast hash lookup on the slot gives the shard.
Adding or removing one shard moves few keys, and shards differ by at most one slot.

Defined results: a NULL key hashes as the fixed text ``<null>``; repeated keys
go to the same shard; an empty input gives an empty output; columns of the
input are kept, and a clash with an added column name raises ``ValueError``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table accepted: the lookup table is broadcast, and filling it costs the square of its size.
MAX_TABLE_SIZE = 16_381
TABLE_SIZE = 4_093


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def text_hash(text: Column) -> Column:
    """52 bits of the MD5 of a text, as BIGINT (the same in any SQL engine)."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def lookup_table(spark: SparkSession, shards: list[str], table_size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard): one row per slot, ``table_size`` rows.

    Shard ``i`` prefers slots in ascending ``((slot - offset_i) * step_i) mod size``,
    a permutation because the size is prime. Turn ``t`` belongs to shard ``t mod n``.
    """
    if not _is_prime(table_size) or table_size > MAX_TABLE_SIZE:
        raise ValueError(f"table_size must be a prime of at most {MAX_TABLE_SIZE}")
    if not 0 < len(shards) <= table_size or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, at least one, at most one per slot")
    m, n = F.lit(table_size).cast("bigint"), len(shards)
    names = F.array(*[F.lit(s) for s in shards])
    one = spark.range(0, 1, 1, 1).select(
        F.transform(names, lambda s: text_hash(F.concat(s, F.lit(":offset"))) % m).alias("offsets"),
        F.transform(names, lambda s: text_hash(F.concat(s, F.lit(":step"))) % (m - 1) + 1).alias("steps"))

    def claim(state: Column, turn: Column) -> Column:
        shard = (turn % n).cast("int")
        offset, step = F.col("offsets")[shard], F.col("steps")[shard]
        best = F.array_min(F.transform(state["free"], lambda s: (s + m - offset) * step % m * m + s)) % m
        return F.transform(F.array(best), lambda slot: F.struct(
            F.filter(state["free"], lambda s: s != slot).alias("free"),
            F.concat(state["claims"], F.array(slot)).alias("claims")))[0]

    slots = F.sequence(F.lit(0).cast("bigint"), m - 1)
    filled = F.aggregate(slots, F.struct(slots.alias("free"), F.array().cast("array<bigint>").alias("claims")),
                         claim, lambda state: state["claims"])
    return (one.select(F.posexplode(filled).alias("turn", "slot"))
            .select("slot", F.lit(None).cast("string").alias("none"), (F.col("turn") % n).alias("shard_no"))
            .select("slot", names[F.col("shard_no")].alias("shard")))


def place(df: DataFrame, key: str, shards: list[str], table_size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; the broadcast side has ``table_size`` rows."""
    clash = {"slot", "shard"} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"input already has columns {sorted(clash)}")
    table = lookup_table(df.sparkSession, shards, table_size)
    hashed = text_hash(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("<null>")))
    return df.withColumn("slot", hashed % table_size).join(F.broadcast(table), "slot").select(*[F.col(f"`{c}`") for c in df.columns], "slot", "shard")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """One folder per shard, ``files_per_shard`` files each, so a large shard is not one task."""
    salt = F.pmod(F.xxhash64("slot"), F.lit(files_per_shard))
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed.repartition(n, "shard", salt).write.partitionBy("shard").parquet(path)


def oracle_sql(shards: list[str], table_size: int = TABLE_SIZE) -> str:
    """DuckDB SQL for ``place`` over ``documents`` by ``doc_id``."""
    names = "[" + ", ".join(f"'{s}'" for s in shards) + "]"
    h = "('0x' || substr(md5({}), 1, 13))::BIGINT"
    return f"""
WITH RECURSIVE p AS (
  SELECT {table_size}::BIGINT AS m, {names} AS names,
    list_transform({names}, lambda s: {h.format("s || ':offset'")} % {table_size}) AS offsets,
    list_transform({names}, lambda s: {h.format("s || ':step'")} % ({table_size} - 1) + 1) AS steps),
fill(turn, free, slot) AS (
  SELECT -1, range(m), -1::BIGINT FROM p
  UNION ALL
  SELECT turn + 1, list_filter(free, lambda s: s <> best), best FROM (
    SELECT turn, free, list_min(list_transform(free, lambda s:
      ((s + m - offsets[(turn + 1) % len(names) + 1]) * steps[(turn + 1) % len(names) + 1] % m) * m + s)) % m AS best
    FROM fill, p WHERE len(free) > 0)),
t AS (SELECT slot, names[turn % len(names) + 1] AS shard FROM fill, p WHERE turn >= 0)
SELECT d.doc_id, t.slot, t.shard FROM documents d
JOIN t ON t.slot = {h.format("coalesce(d.doc_id::VARCHAR, '<null>')")} % {table_size}"""
