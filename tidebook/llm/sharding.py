"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order of the slots of a table of prime size: from an offset in
steps of a skip, both hashes of its name. The shards take turns; in its turn a shard claims the
next slot of its order that is free. Slots per shard differ by one at most, and a shard that leaves
or joins moves little but its own slots. The table is broadcast, and a row's shard is the one at
the slot of its key's hash.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 65537
SHARDS = [f"shard-{i:02d}" for i in range(64)]


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Which shard, by its place in ``shards``, has each slot. ``slots`` is a prime; the work is
    that of a few turns per slot, whatever is sharded."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards need distinct names, one at least and no more than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} slots: a prime is needed, so that every skip reaches all slots")
    next_slot = [zlib.crc32(f"offset {s}".encode()) % slots for s in shards]
    skip = [zlib.crc32(f"skip {s}".encode()) % (slots - 1) + 1 for s in shards]
    table = [-1] * slots
    claimed = 0
    while True:
        for i in range(len(shards)):
            while table[next_slot[i]] >= 0:
                next_slot[i] = (next_slot[i] + skip[i]) % slots
            table[next_slot[i]] = i
            claimed += 1
            if claimed == slots:
                return table


def place(rows: DataFrame, key: str, shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``rows`` with slot (long) and shard (the name), placed by the text of column ``key``.

    Equal keys share a shard; a null key is placed like an empty text. Columns called slot or shard
    are replaced. A row is never moved: no shuffle. An empty table stays empty.
    """
    shards = SHARDS if shards is None else shards
    table = lookup_table(shards, slots)
    spark = rows.sparkSession
    filled = spark.range(1).select(
        F.posexplode(F.split(F.lit(" ".join(map(str, table))), " ").cast("array<int>")).alias("slot", "at")
    )
    names = F.split(F.lit("\n".join(shards)), "\n")
    filled = filled.select(F.col("slot").cast("long").alias("slot"), F.get(names, F.col("at")).alias("shard"))
    slot = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % slots
    return rows.drop("shard").withColumn("slot", slot).join(F.broadcast(filled), "slot").select(
        *[c for c in rows.columns if c not in ("slot", "shard")], "slot", "shard"
    )


def write_shards(rows: DataFrame, path: str, files: int = 1) -> None:
    """Placed rows as Parquet, a folder per shard, each dealt over ``files`` tasks."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in rows.dtypes if not t.startswith("map")]), F.lit(files))
    rows.withColumn("_salt", salt).repartition("shard", "_salt").drop("_salt").write.partitionBy("shard").parquet(path)
