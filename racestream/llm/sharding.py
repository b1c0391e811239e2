"""Placement of rows on shards through a permutation-filled lookup table.

The table has a prime number of slots. Every shard prefers them in an order of its own: a start and a stride, both
from a hash of its name; as the size is prime, each stride visits all slots. The shards take turns, and each claims
the first slot of its order that is still free. So all shards get the same number of slots, give or take one, and
adding or removing a shard moves little more than its share. A row's slot is a hash of its key; the table is
broadcast, and its size is a parameter that does not depend on the data.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537
#: Above this the table is no longer a small thing to broadcast (about 16 MB).
MOST_SLOTS = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _preference(shard: str, slots: int) -> tuple[int, int]:
    digest = hashlib.blake2b(shard.encode(), digest_size=16).digest()
    start = int.from_bytes(digest[:8], "little") % slots
    stride = int.from_bytes(digest[8:], "little") % (slots - 1) + 1
    return start, stride


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard. Shards take turns in the order of their names."""
    if not _is_prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"the number of slots must be a prime of at most {MOST_SLOTS}")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be different names, at least one and at most one per slot")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    following = {i: _preference(shards[i], slots) for i in turns}
    table = [-1] * slots
    free = slots
    while free:
        for i in turns[:free]:
            slot, stride = following[i]
            while table[slot] >= 0:
                slot = (slot + stride) % slots
            table[slot] = i
            following[i] = ((slot + stride) % slots, stride)
        free -= min(free, len(turns))
    return table


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """Adds ``slot`` (long) and ``shard`` (string) to every row; columns of these names are replaced.

    Rows of equal key share a shard; repeated rows stay repeated. A row without key is placed by all its columns,
    so that many of them do not share a slot. An empty table stays empty.
    """
    spark: SparkSession = df.sparkSession
    rows = [(slot, shards[i]) for slot, i in enumerate(lookup_table(shards, slots))]
    table = F.broadcast(spark.createDataFrame(rows, "slot long, shard string"))
    kept = df.drop("slot", "shard") if key not in ("slot", "shard") else df
    stand_in = F.when(F.col(key).isNull(), F.xxhash64(*[c for c, kind in kept.dtypes if "map<" not in kind]))
    slot = F.pmod(F.xxhash64(F.col(key).cast("string"), stand_in), F.lit(slots).cast("long"))
    return kept.withColumn("slot", slot).join(table, "slot").select(*kept.columns, "slot", "shard")


def write_shards(df: DataFrame, key: str, shards: list[str], folder: str, files: int = 1, slots: int = SLOTS) -> None:
    """Writes one folder per shard, each of ``files`` files; rows are dealt over them by a hash of the row."""
    placed = place(df, key, shards, slots)
    part = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind]), F.lit(files))
    placed.repartition(len(shards) * files, "shard", part).drop("slot").write.partitionBy("shard").parquet(folder)
