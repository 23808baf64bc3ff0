"""Sharding by sampled splitters.

Keys are (hash of the text, id), so equal texts are neighbours and no two rows are alike. A sample
of keys, drawn with a chance in proportion to the rows' sizes, gives quantile boundaries of many
fine ranges; their exact sizes are counted, and ranges that came out overfull are subdivided by a
further sample of theirs. The shards' borders then fall into a few ranges each small against a
shard; only these are sorted to find the row where a border is best. Slots come from the ranges'
counts and the ranks within ranges. The law is `bytes`: sizes of shards are near equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import keep

RANGES = 4096
ROUNDS = 4
_LOW = np.iinfo(np.int64).min


def _order(h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Keys as 16 bytes in the order of (h, i)."""
    sign = np.uint64(1 << 63)
    both = np.stack([h.astype(np.int64).view(np.uint64) ^ sign, i.astype(np.int64).view(np.uint64) ^ sign], axis=1)
    return np.frombuffer(np.ascontiguousarray(both.astype(">u8")).tobytes(), dtype="V16").copy()


def _place(keys: list[tuple[int, int]], h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """How many of the sorted keys are not above each (h, i)."""
    if not keys:
        return np.zeros(len(h), dtype=np.int64)
    # Bytes compare as the numbers do; the S type ignores zeros at the end, which leaves the order as it is.
    return np.searchsorted(_order(*np.array(keys, dtype=np.int64).T).view("S16"), _order(h, i).view("S16"), side="right")


def _ranged(rows: DataFrame, keys: list[tuple[int, int]], name: str = "range") -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(keys)

    def run(batches):
        for b in batches:
            at = _place(sent.value, b.column("h").to_numpy(zero_copy_only=False), b.column("i").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int64))], [*b.schema.names, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, `{name}` long")


def _sample(rows: DataFrame, chance: float, salt: int) -> list[tuple[int, int]]:
    """Keys drawn with chance * size each: their number is about chance times the total size."""
    draw = F.pmod(F.xxhash64("h", "i", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    return sorted((r.h, r.i) for r in rows.filter(draw < F.col("size") * chance).select("h", "i").collect())


def _splitters(rows: DataFrame, total: int, ranges: int, oversample: int) -> list[tuple[int, int]]:
    """Boundaries of about so many ranges of about equal size."""
    drawn = _sample(rows, oversample * ranges / total, 0)
    step = max(1, len(drawn) // ranges)
    # A boundary stands before all rows of its text, unless ranges come out overfull.
    keys = sorted({(h, int(_LOW)) for h, _ in drawn[step - 1 :: step]})
    for turn in range(1, ROUNDS + 1):
        sizes = _ranged(rows, keys).groupBy("range").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        over = [r.range for r in sizes.filter((F.col("size") > 2 * total / ranges) & (F.col("n") > 1)).collect()]
        if not over:
            break
        inside = _ranged(rows, keys).join(F.broadcast(rows.sparkSession.createDataFrame([(x,) for x in over], "range long")), "range")
        drawn = _sample(inside, min(1.0, 4 * turn * ranges / total), turn)
        keys = sorted({*keys, *drawn})
    return keys


def _borders(rows: DataFrame, keys: list[tuple[int, int]], shards: int, total: int, tolerance: float) -> list[tuple[int, int]]:
    """The first keys of shards 1 and on: each where the bytes before come nearest to its part of the total."""
    spark = rows.sparkSession
    ranged = _ranged(rows, keys)
    sizes = dict(ranged.groupBy("range").agg(F.sum("size")).collect())
    order = sorted(sizes)
    before = dict(zip(order, np.concatenate([[0], np.cumsum([sizes[r] for r in order])[:-1]]).tolist(), strict=True)) if order else {}
    wanted = []
    for s in range(1, shards):
        goal = total * s / shards
        inside = [r for r in order if before[r] <= goal]
        if inside:
            wanted.append((s, inside[-1], float(goal), int(before[inside[-1]])))
    if not wanted:
        return []
    at = F.broadcast(spark.createDataFrame(wanted, "shard int, range long, goal double, base long"))
    own = Window.partitionBy("shard", "range").orderBy("h", "i")
    near = ranged.join(at, "range").withColumns({"sum": F.col("base") + F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, -1)), "prior": F.lag("h").over(own)})
    near = near.withColumns({"off": F.abs(F.coalesce("sum", "base") - F.col("goal")), "edge": F.coalesce(F.col("prior") != F.col("h"), F.lit(True))})
    best = near.groupBy("shard").agg(
        F.min_by(F.struct("h", "i"), F.struct("off", "h", "i")).alias("any"),
        F.min_by(F.when(F.col("edge"), F.struct("h", "i")), F.when(F.col("edge"), F.struct("off", "h", "i"))).alias("whole"),
        F.min(F.when(F.col("edge"), F.col("off"))).alias("off"),
    )
    out = []
    for r in best.collect():
        pick = r.whole if r.off is not None and r.off <= tolerance * total / shards else r["any"]
        out.append((pick.h, pick.i))
    return sorted(out)


def shard(documents: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES, oversample: int = 8, tolerance: float = 0.01) -> DataFrame:
    """doc_id, size, text_crc32, law (bytes), shard, slot (from 0 without a gap), grown_shard (null).

    Size is the UTF-8 bytes of the text plus 1. Shards differ by the size of a row or so, or by at
    most the tolerance (part of a shard) where that keeps equal texts together; larger groups of
    equal texts are split. A null text has size 1 and the checksum of no bytes. Ids are expected to
    be unique integers; rows that repeat an id and a text get slots of their own. Rows with a null id
    come first among those of their text and get shards and slots like all others. With fewer rows
    than shards some shards are empty. Only keys are moved, never texts; write_shards joins them.
    What the driver holds is bounded by ranges * oversample keys and some per round.
    """
    spark = documents.sparkSession
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    own = F.col(id_col).cast("long")
    # A null id is numbered from the lowest one, so that many of one text can be split; none tells that it is null.
    rows = documents.select(F.coalesce(own, F.lit(int(_LOW) + 1) + F.monotonically_increasing_id()).alias("i"), own.isNull().alias("none"), F.xxhash64(text_col).alias("h"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(raw).alias("crc"))
    rows = keep(rows, "keys")
    back = F.when(~F.col("none"), F.col("i")).alias(id_col)
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return rows.select(back, "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    keys = _splitters(rows, total, ranges, oversample)
    borders = _borders(rows, keys, shards, total, tolerance)
    both = sorted({*keys, *borders})
    placed = _ranged(rows, both)
    counts = dict(placed.groupBy("range").count().collect())
    shard_of, first, seen = {}, {}, {}
    for r in sorted(counts):
        s = int(_place(borders, *(np.array([x]) for x in both[r - 1]))[0]) if r else 0
        shard_of[r], first[r] = s, seen.get(s, 0)
        seen[s] = first[r] + counts[r]
    lookup = spark.createDataFrame([(r, shard_of[r], first[r]) for r in counts], "range long, shard int, first long")
    rank = F.row_number().over(Window.partitionBy("range").orderBy("h", "i"))
    out = placed.withColumn("rank", rank).join(F.broadcast(lookup), "range")
    return out.select(back, "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(documents: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id", files_per_shard: int = 8, text_col: str = "text") -> None:
    """Write documents under path/shard=N in the placed shards, each in some files by ranges of slots.

    Rows meet their places by id, checksum and size of the text, and those alike in all three one by one; null ids too.
    """
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    nth = F.row_number().over(Window.partitionBy("_id", "_crc", "_size").orderBy("_id"))
    rows = documents.select("*", F.col(id_col).cast("long").alias("_id"), F.crc32(raw).alias("_crc"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("_size")).withColumn("_nth", nth)
    places = placed.select(F.col(id_col).alias("_id"), F.col("text_crc32").alias("_crc"), F.col("size").alias("_size"), "shard", "slot").withColumn("_nth", nth)
    same = [rows[c].eqNullSafe(places[c]) for c in ("_id", "_crc", "_size", "_nth")]
    rows = rows.join(places, same).select(*[rows[c] for c in documents.columns], "shard", "slot")
    many = placed.agg(F.max("shard")).first()[0]
    rows.repartitionByRange((int(many or 0) + 1) * files_per_shard, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
