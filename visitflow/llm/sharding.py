"""Sharding by sampled splitters, in DataFrame functions only.

Records are range-partitioned by ``(hash of the text, doc_id)``:

1. a size-weighted sample of keys is drawn (a row enters with probability
   proportional to its weight, by a hash of its key, so draws repeat);
2. the sample's weighted quantiles are the splitters of many small ranges,
   ``ranges_per_shard`` for each shard and more on large tables;
3. ranges that turn out overfull are sampled again, more densely, and subdivided;
4. exact weights of the ranges place every record on one global weight line,
   which is cut into equal shards.

Equal texts are neighbours on that line. Under the law ``bytes``, copies of one text stay in
one shard unless together they weigh more than an eighth of a shard; such a hot group is
split by doc_id like any other run of records. Under the law ``rows``, shards are cut at
exact ranks of the line, through groups of copies where they fall there.

What passes the driver: the sampled keys and one row for each range, both
bounded by the number of ranges (``rows / max_range_rows``, or
``shards * ranges_per_shard`` on small tables).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm.common import stored

RECORD_BYTES = 16
LOWEST = -(2**63)
#: A group of copies is split when it weighs more than this share of a shard.
GROUP_SHARE = 8


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long")


def group_hash(text: Column) -> Column:
    """60 bits of the text's MD5; null counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _locate(key: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``: a binary search."""
    if not bounds:
        return F.lit(0)
    table = F.from_json(
        F.lit(json.dumps([{"h": h, "d": d} for h, d in bounds])), "array<struct<h:bigint,d:bigint>>"
    )
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def probe(at: Column, step: Column) -> Column:
        return F.when(F.try_element_at(table, (at + step).cast("int")) <= key, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), probe)


def _splitters(sample: list, total: float, ranges: int, heavy: set[int]) -> list[tuple[int, int]]:
    """Weighted quantiles of (h, d, weight) rows; a light text's copies are never split."""
    bounds, passed, due = [], 0.0, total / ranges
    for h, d, weight in sorted(sample):
        passed += weight
        if passed >= due:
            bounds.append((h, d if h in heavy else LOWEST))
            due = passed + total / ranges
    return sorted(set(bounds))


def _draw(rows: DataFrame, per_unit: float, seed: int) -> list:
    """Keys drawn with probability ``min(1, weight * per_unit)``, and the weight each stands for."""
    chance = F.least(F.lit(1.0), F.col("w") * F.lit(per_unit))
    u = F.pmod(F.xxhash64("h", "d", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = rows.where(u < chance).select("h", "d", (F.col("w") / chance).alias("stands"))
    return [(r[0], r[1], r[2]) for r in drawn.collect()]


def shard(
    docs: DataFrame,
    shards: int = 40,
    law: str = "bytes",
    ranges_per_shard: int = 64,
    samples_per_range: int = 16,
    max_range_rows: int = 1_000_000,
    seed: int = 7,
) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into one of ``shards`` shards.

    ``law="bytes"`` evens out UTF-8 bytes plus 16 a record, ``law="rows"`` makes counts
    differ by at most one. Returns doc_id, size, text_crc32, law, shard, slot (gapless from 0
    in each shard, in key order) and grown_shard (null: neither law depends on
    the doc_id and shard count alone).

    Null texts weigh 16 bytes and lie beside empty ones. A null doc_id sorts as
    the lowest. Rows that repeat doc_id and text take neighbouring slots. A text of any length is
    one record, never split: a shard that holds one larger than its share is overfull by it.
    Other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law {law!r}")
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.col("text").cast("string")
    size = record_size(text)
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            size.alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            group_hash(text).alias("h"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("d"),
            (size if law == "bytes" else F.lit(1).cast("long")).alias("w"),
        ),
        "shard-keys",
    )
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    ranges = max(shards * ranges_per_shard, -(-count // max_range_rows))
    per_unit = ranges * samples_per_range / total if total else 1.0

    # Splitters from a size-weighted sample; texts that own several are weighed exactly.
    sample = _draw(rows, per_unit, seed)
    owners: dict[int, float] = {}
    for h, _, stands in sample:
        owners[h] = owners.get(h, 0.0) + stands
    limit = total // (shards * GROUP_SHARE)
    suspects = [h for h, stands in owners.items() if stands * 4 > limit]
    heavy: set[int] = set()
    if suspects:
        weighed = rows.where(F.col("h").isin(suspects)).groupBy("h").agg(F.sum("w").alias("w"))
        heavy = {r["h"] for r in weighed.where(F.col("w") > limit).collect()}
    bounds = _splitters(sample, total, ranges, heavy)

    # Exact weights; overfull ranges are drawn from again and subdivided.
    key = F.struct(F.col("h").alias("h"), F.col("d").alias("d"))
    for again in range(1, 5):
        ranged = rows.withColumn("range", _locate(key, bounds))
        weights = {r["range"]: r["w"] for r in ranged.groupBy("range").agg(F.sum("w").alias("w")).collect()}
        overfull = {at: w for at, w in weights.items() if w > 2 * total / ranges}
        if not overfull or again == 4:
            break
        crowded = ranged.where(F.col("range").isin(list(overfull)))
        pieces = 2 * sum(-(-w * ranges // total) for w in overfull.values())
        more = _splitters(_draw(crowded, per_unit * 4, seed + again), sum(overfull.values()), pieces, heavy)
        if set(more) <= set(bounds):
            break  # one light text or one repeated row: nothing left to cut
        bounds = sorted({*bounds, *more})

    # Every record's place on the weight line, then its shard.
    starts, passed = [], 0
    for at in range(len(bounds) + 1):
        starts.append(passed)
        passed += weights.get(at, 0)
    line = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    start_of = F.element_at(line, (F.col("range") + 1).cast("int"))
    in_range = Window.partitionBy("range").orderBy("h", "d")
    before = start_of + F.sum("w").over(in_range.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")
    is_heavy = F.col("h").isin(list(heavy)) if heavy else F.lit(False)
    is_heavy = F.lit(True) if law == "rows" else is_heavy  # every record has its own place
    placed = (
        rows.withColumn("range", _locate(key, bounds))
        .withColumn("at", before)
        .withColumn("group_at", F.min("at").over(Window.partitionBy("range", "h")))
        .withColumn("at", F.when(is_heavy, F.col("at")).otherwise(F.col("group_at")))
        # exact for weights up to 38 digits: at * shards may pass 2**63
        .withColumn("shard", F.expr(f"cast(cast(at as decimal(20,0)) * {shards} div {max(total, 1)} as int)"))
        .withColumn("n", F.row_number().over(Window.partitionBy("range", "shard").orderBy("h", "d")))
    )
    placed = stored(placed.select("doc_id", "size", "text_crc32", "range", "shard", "n"), "shard-places")
    # At most one row for each range and one more for each shard: bounded, so broadcast.
    cells = placed.groupBy("range", "shard").agg(F.count(F.lit(1)).alias("rows"))
    shard_line = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("first", F.coalesce(F.sum("rows").over(shard_line), F.lit(0))).drop("rows")
    return placed.join(F.broadcast(offsets), ["range", "shard"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(law).alias("law"),
        "shard",
        (F.col("first") + F.col("n") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
