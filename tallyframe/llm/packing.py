"""Best-fit packing planned on the histogram of lengths.

Each document's tokens are cut into pieces of at most the capacity. The plan looks only at how many
pieces there are of each length: from the longest to the shortest, pieces of a length go into the
sequences with the least room that holds them, as many at once as there are such sequences. The
plan is a list of segments (length, first rank, how many, first sequence, offset) whose size
depends on the capacity alone. A piece then takes the slot of its rank among the pieces of its
length. Ranks are made in salted groups, so that a length that many pieces share is spread.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import keep
from tallyframe.llm.tokencount import encode, encoder

CAPACITY = 2048
END_ID = 0


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Segments (length, rank, count, sequence, offset), by length and rank: best-fit decreasing over counts."""
    rooms: list[int] = []  # in rising order, those with sequences
    pools: dict[int, list[tuple[int, int]]] = {}
    out, sequences = [], 0

    def put(room: int, first: int, many: int) -> None:
        if room and many:
            if not pools.get(room):
                pools[room] = []
                insort(rooms, room)
            pools[room].append((first, many))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                full, rest = divmod(left, each)
                for first, many, held in ((sequences, full, each), (sequences + full, 1, rest)):
                    if many and held:
                        for k in range(held):
                            out.append((length, rank, many, first, k * length))
                            rank += many
                        put(capacity - held * length, first, many)
                        sequences += many
                left = 0
                continue
            room = rooms[at]
            first, many = pools[room].pop()
            if not pools[room]:
                rooms.pop(at)
            taken = min(many, left)
            out.append((length, rank, taken, first, capacity - room))
            rank, left = rank + taken, left - taken
            put(room - length, first, taken)
            put(room, first + taken, many - taken)
    return np.array(out, dtype=np.int64).reshape(-1, 5)


def pieces(documents: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each text's ids and the end id, in pieces of the capacity but for the first, which holds the rest."""

    def run(batches):
        encoding, _ = encoder(ranks_file)
        end = np.array([end_id], dtype="<u4")
        for b in batches:
            rows, doc, ids = [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                all_ids = np.concatenate([encode(encoding, text or "").astype("<u4"), end])
                at, stop = 0, (len(all_ids) - 1) % capacity + 1
                number = 0
                while at < len(all_ids):
                    part = all_ids[at:stop]
                    doc.append(i)
                    rows.append((number, at, stop - at, zlib.crc32(part.tobytes())))
                    if with_ids:
                        ids.append(part.astype(np.int64))
                    at, stop, number = stop, stop + capacity, number + 1
            table = np.array(rows, dtype=np.int64).reshape(-1, 4)
            columns = [pa.array(doc, b.schema.field(0).type), pa.array(table[:, 0].astype(np.int32)), *[pa.array(table[:, k]) for k in (1, 2, 3)]]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(ids, pa.list_(pa.int64()))] if with_ids else [])], ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def pack(documents: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece (from 0), start, length, ids_crc32, sequence_id, offset of each piece, and with_ids its ids.

    A document is its text's token ids and the end id; a null text counts as empty, which leaves the
    end id alone. Only documents longer than the capacity are cut; the first piece may be shorter.
    Texts are encoded whole. Rows with equal ids are documents of their own. Offsets leave no gap
    in a sequence; sequence ids count from 0. Further columns are not read.
    """
    spark = documents.sparkSession
    table = keep(pieces(documents, ranks_file, id_col, text_col, capacity, end_id, with_ids), "pieces")
    # At most as many rows as the capacity.
    counts = {r["length"]: r["count"] for r in table.groupBy("length").count().collect()}
    # Groups of a length are kept small against what a partition holds.
    fair = max(32, sum(counts.values()) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    salts = spark.createDataFrame([(n, -(-c // fair)) for n, c in counts.items()], "length long, salts long")
    salted = table.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), "salts")).drop("salts")
    groups = salted.groupBy("length", "salt").count().orderBy("length", "salt").toPandas()
    base = (groups["count"].groupby(groups["length"]).cumsum() - groups["count"]).to_numpy(np.int64)
    key = groups["length"].to_numpy(np.int64) << 32 | groups["salt"].to_numpy(np.int64)
    segments = plan(counts, capacity)
    segments = segments[np.lexsort((segments[:, 1], segments[:, 0]))]
    sent = spark.sparkContext.broadcast((key, base, segments[:, 0] << 44 | segments[:, 1], segments[:, 1], segments[:, 3], segments[:, 4]))

    def place(batches):
        key, base, keys, ranks, sequences, offsets = sent.value
        for b in batches:
            length, salt = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "salt"))
            rank = base[np.searchsorted(key, length << 32 | salt)] + b.column("n").to_numpy(zero_copy_only=False) - 1
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            at = np.maximum(at, 0)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in held], pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])], [*held, "sequence_id", "offset"])

    held = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = salted.withColumn("n", F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece")).cast("long"))
    kinds = ", ".join(f"{c} {salted.schema[c].dataType.simpleString()}" for c in held)
    return ranked.select(*held, "salt", "n").mapInArrow(place, f"{kinds}, sequence_id long, offset long").withColumnRenamed("id", id_col)
