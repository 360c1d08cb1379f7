"""Sharding by fixed virtual slots.

Every record is hashed into one of ``VIRTUAL`` slots, for good.  A versioned table maps slots to
shards.  Version 0 deals the slots out in equal stretches; later versions edit it: bytes are
aggregated per slot and slots move from heavy to light shards until sizes are near equal, or a new
shard takes slots only into itself.  Records never look at each other, only at the map, which has
``VIRTUAL`` rows whatever the size of the corpus.

The map lives in a folder that the caller keeps: a later run reads the newest version, edits it if
sizes have drifted or shards were added, and writes the edit as one more version.  Old versions stay
readable, so records can still be found where an earlier run put them (:func:`place`).
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm.common import materialise
from orderlake.session import child_names, scratch_dir

VIRTUAL = 8192
OVERHEAD = 16             # bytes of a record besides its text
DRIFT = 0.01              # share of the mean by which a shard may be off before slots move
COPIES = 65_536           # copies of one record that one row stands for while they are numbered
MAP_SCHEMA = "version int, virtual int, shard int"


def slot_of(*columns):
    """Virtual slot of a record."""
    return F.pmod(F.xxhash64(*columns), F.lit(VIRTUAL)).cast("int")


def even_map(shards: int) -> list[int]:
    """Version 0: equal stretches of slots."""
    return [v * shards // VIRTUAL for v in range(VIRTUAL)]


def rebalance(current: list[int], slot_bytes: list[int], shards: int) -> list[int]:
    """The map with slots moved so that the shards' bytes are near equal.

    Shards above the mean give up slots, the smallest that still bring them to the mean first; the
    freed slots go, the heaviest first, to the lightest shard.  Slots that need not move stay.
    """
    out, load = list(current), [0] * shards
    own: list[list[int]] = [[] for _ in range(shards)]
    for v, s in enumerate(out):
        load[s] += slot_bytes[v]
        own[s].append(v)
    mean = sum(load) / shards
    free: list[int] = []
    for s in range(shards):
        for v in sorted(own[s], key=lambda v: -slot_bytes[v]):
            if load[s] <= mean:
                break
            if slot_bytes[v]:
                load[s] -= slot_bytes[v]
                free.append(v)
    lightest = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(lightest)
    for v in sorted(free, key=lambda v: (-slot_bytes[v], v)):
        b, s = heapq.heappop(lightest)
        out[v] = s
        heapq.heappush(lightest, (b + slot_bytes[v], s))
    return out


def add_shard(current: list[int], slot_bytes: list[int], shards: int) -> list[int]:
    """The map with one more shard, number ``shards``: it takes slots from the heaviest shards, nothing else moves."""
    out, load = list(current), [0] * (shards + 1)
    own: list[list[int]] = [[] for _ in range(shards)]
    for v, s in enumerate(out):
        load[s] += slot_bytes[v]
        own[s].append(v)
    for s in range(shards):
        own[s].sort(key=lambda v: slot_bytes[v])
    goal = sum(load) / (shards + 1)
    heaviest = [(-b, s) for s, b in enumerate(load[:shards])]
    heapq.heapify(heaviest)
    while heaviest and load[shards] < goal:
        b, s = heapq.heappop(heaviest)
        if not own[s]:
            continue
        v = own[s].pop()
        if load[shards] + slot_bytes[v] <= goal + (slot_bytes[v] + 1) / 2:
            out[v] = shards
            load[shards] += slot_bytes[v]
            b += slot_bytes[v]
        heapq.heappush(heaviest, (b, s))
    return out


def loads(slots: list[int], slot_bytes: list[int], shards: int) -> list[int]:
    """Bytes of every shard under a map."""
    out = [0] * shards
    for v, s in enumerate(slots):
        out[s] += slot_bytes[v]
    return out


def edit(current: list[int], slot_bytes: list[int], shards: int, drift: float = DRIFT) -> list[int]:
    """The next version of a map: grown to ``shards``, else rebalanced if that brings shards nearer to each other.

    A map of more shards than asked for raises.  Sizes within ``drift`` of the mean stay as they are.
    """
    have = max(current) + 1
    if have > shards:
        raise ValueError(f"the stored map has {have} shards; it cannot shrink to {shards}")
    out = current
    for n in range(have, shards):
        out = add_shard(out, slot_bytes, n)
    if have < shards:
        return out
    now = loads(current, slot_bytes, shards)
    mean = sum(now) / shards
    if max(now) <= mean * (1 + drift) and min(now) >= mean * (1 - drift):
        return current
    out = rebalance(current, slot_bytes, shards)
    then = loads(out, slot_bytes, shards)
    return out if max(then) - min(then) < max(now) - min(now) else current


def map_versions(spark: SparkSession, folder: str) -> list[int]:
    """Versions written to a folder, ascending; none if there is no such folder.

    A version is one file, put in place by one rename: a write cut short leaves a folder without it, which does not count.
    """
    found = [int(n.removeprefix("version=")) for n in child_names(spark, folder) if n.startswith("version=")]
    return sorted(v for v in found if any(n.startswith("part-") for n in child_names(spark, f"{folder}/version={v}")))


def save_map(spark: SparkSession, folder: str, version: int, slots: list[int]) -> None:
    """Write one version of the map to its table; a written version never changes, a write cut short is replaced."""
    if version in map_versions(spark, folder):
        raise ValueError(f"version {version} of the map in {folder} is already there")
    rows = [(version, v, s) for v, s in enumerate(slots)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """(virtual, shard) of one version."""
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version}").drop("version")


def map_slots(spark: SparkSession, folder: str, version: int) -> list[int]:
    """Shard of every slot, as a list of ``VIRTUAL`` numbers."""
    return [r["shard"] for r in sorted(load_map(spark, folder, version).collect(), key=lambda r: r["virtual"])]


def update_map(spark: SparkSession, folder: str, slot_bytes: list[int], shards: int) -> int:
    """Newest version of the stored map after editing it for these sizes; a map that needs no edit gets no version.

    An empty folder starts with version 0, equal stretches.
    """
    versions = map_versions(spark, folder)
    if not versions:
        save_map(spark, folder, 0, even_map(shards))
        versions = [0]
    current = map_slots(spark, folder, versions[-1])
    new = edit(current, slot_bytes, shards)
    if new == current:
        return versions[-1]
    save_map(spark, folder, versions[-1] + 1, new)
    return versions[-1] + 1


def records(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, n, virtual): equal records are counted, so no hot key stays whole.

    NULL text: size ``OVERHEAD``, checksum of the empty text.  Ids of any type, NULL among them.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return (rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("virtual", slot_of("doc_id", "text_crc32", "size")))


def place(spark: SparkSession, docs: DataFrame, folder: str, version: int) -> DataFrame:
    """(doc_id, size, text_crc32, virtual, shard) of every row under a stored version of the map; no shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return (rows.withColumn("virtual", slot_of("doc_id", "text_crc32", "size"))
            .join(F.broadcast(load_map(spark, folder, version)), "virtual"))     # VIRTUAL rows


def assign(spark: SparkSession, docs: DataFrame, shards: int, folder: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, virtual) of every row, byte-balanced.

    ``folder`` holds the map's versions, the newest of which is edited as :func:`edit` says; without one
    the map starts anew.  ``slot`` numbers a shard's rows from 0 without gaps: the rows of the shard's earlier virtual slots
    (a running sum over ``VIRTUAL`` rows) plus the row's place in its own virtual slot, so that no
    shard is ever gathered in one task.  Rows of a virtual slot are numbered by id (NULL first), checksum and
    size; repeated rows get consecutive numbers.  A NULL id is an id, a NULL text has ``OVERHEAD`` bytes, a
    text of any length counts whole by its bytes; an empty table gives an empty one and leaves the map as it is.
    """
    recs = materialise(records(docs), "shard-records")
    per_slot = (recs.groupBy("virtual").agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("rows")))
    slot_bytes = [0] * VIRTUAL
    for r in per_slot.collect():                       # at most VIRTUAL rows
        slot_bytes[r["virtual"]] = r["bytes"]
    folder = folder or scratch_dir(spark, "shard-map")
    current = load_map(spark, folder, update_map(spark, folder, slot_bytes, shards))
    earlier = Window.partitionBy("shard").orderBy("virtual").rowsBetween(Window.unboundedPreceding, -1)
    base = (current.join(per_slot.select("virtual", "rows"), "virtual")
            .select("virtual", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base")))
    inside = Window.partitionBy("virtual").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = (recs.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
                .join(F.broadcast(base), "virtual")    # at most VIRTUAL rows
                .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("before")).alias("first"), "n", "virtual"))
    return copies(materialise(numbered, "shard-numbered"))


def copies(numbered: DataFrame) -> DataFrame:
    """One row per copy, ``slot`` counting from ``first``.

    A record of more than ``COPIES`` copies is first cut into stretches of that many, which are dealt out to
    all tasks: neither an array nor a task holds the copies of a hot record.
    """
    few, many = numbered.where(F.col("n") <= COPIES), numbered.where(F.col("n") > COPIES)
    last = F.col("first") + F.col("n") - 1
    cut = (many.withColumn("begin", F.explode(F.sequence(F.col("first"), last, F.lit(COPIES).cast("long"))))
           .withColumn("n", F.least(F.lit(COPIES).cast("long"), last - F.col("begin") + 1)).drop("first").withColumnRenamed("begin", "first"))
    spread = cut.repartition(F.xxhash64("virtual", "first"))
    return few.unionByName(spread).select("doc_id", "size", "text_crc32", "shard", F.explode(F.sequence(F.col("first"), last)).alias("slot"), "virtual")
