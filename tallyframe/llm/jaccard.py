"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles come in bands of sizes, each band's upper end 1 / similarity times its lower
one, so that two similar sets are in one band or in neighbouring ones. For a band, two similar sets
differ by at most k shingles. The domain of shingles is hashed into (k + 1) / 2 parts, rounded up,
of 3 cells each: in at least one part such sets differ by one shingle at most, so they agree on at
least two of its three cells. Each set therefore has a signature for each part and each pair of its
cells, in its own band and in the next, and any two similar sets share one.

Some parts are spare: with s more parts, similar sets agree so in s + 1 parts at least. Empty pairs
of cells, in which unrelated sets meet, are left out. A set with empty pairs in more than s parts is
parted once more by other hashes, up to LEVELS times; two similar sets meet at the first level at
which one of them has at most s such parts. Only at the last level are empty pairs kept.

1. Equal sets collapse to one row, of their smallest id, of which alone the signatures are made.
2. What is left is sorted by signature, and each run is linked to its first. Of the rows of a part
   of a batch that share a signature only two go there; the others are tied to the first of them by a
   signature of the two alone. So a signature of any number of rows costs one candidate for each,
   and no task sees them all.
3. Candidates are first compared by parity sketches: each shingle flips one bit, so the bits in
   which two sketches differ are never more than the shingles in which the sets do. What may still be
   similar is compared on whole sets. The links' components follow.
4. A run whose rows are in different components then may hold links that its first row doesn't
   show. Such runs are found again by the signatures of the rows involved; the rows outside a run's
   largest component are compared with all its rows by their sketches, in cells of some thousand
   rows, and what may be similar on whole sets: first the nearest of each other component, then,
   between components that are still apart, all, in the runs alone that hold a row for which others
   were left out. A run of two rows needs none of this.
Similar sets are then in one component, and no others.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import SPACE, discard, keep, mix, small, texts
from tallyframe.llm.components import connected_components

CELLS = 3
LEVELS = 8
HUB_ROWS = 64
CELL_ROWS = 4096
NEAREST = 4
SIGNATURES = 500_000
#: Of texts and sets for Python at once; a partition of documents would else be one batch, held by the executor and by its workers.
BATCH_BYTES = 4 << 20
BROADCAST_ROWS = 2_000_000


@lru_cache(maxsize=64)
def bands(percent: int, largest: int) -> np.ndarray:
    """The upper ends of the bands up to largest: from a band's lowest size, the largest that can be similar to it."""
    out, low = [], 1
    while not out or out[-1] < largest:
        out.append(low * 100 // percent)
        low = out[-1] + 1
    return np.array(out, dtype=np.int64)


def most_different(size: np.ndarray, percent: int) -> np.ndarray:
    """The largest size of the symmetric difference of two similar sets of at most so many elements each."""
    # |r & s| >= percent / (100 + percent) * (|r| + |s|), so the difference is at most this part of the sum.
    return (2 * size * (100 - percent)) // (100 + percent)


def shingle_sets(piece, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, as sorted hashes, and where each row's begin."""
    h, starts = piece.words(~SPACE)
    count = np.diff(starts)
    out = []
    grams = np.zeros(max(0, len(h) - words + 1), dtype=np.uint64)
    for i in range(words):
        grams = mix(grams * np.uint64(0x2545F4914F6CDD1D) + h[i : i + len(grams)])
    for i, n in enumerate(count):
        if n >= words:
            out.append(np.unique(grams[starts[i] : starts[i + 1] - words + 1]))
        elif n:
            x = np.array([n], dtype=np.uint64)
            for w in h[starts[i] : starts[i + 1]]:
                x = mix(x * np.uint64(0x2545F4914F6CDD1D) + w)
            out.append(x)
        else:
            out.append(np.empty(0, dtype=np.uint64))
    sizes = np.array([len(x) for x in out], dtype=np.int64)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def _sums(cell: np.ndarray, values: np.ndarray, cells: int) -> np.ndarray:
    """A hash of the values in each cell, whatever their order."""
    low = np.bincount(cell, weights=(values & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=cells)
    high = np.bincount(cell, weights=(values >> np.uint64(32)).astype(np.float64), minlength=cells)
    return mix(mix(low.astype(np.uint64)) + high.astype(np.uint64))


def _level(values: np.ndarray, sizes: np.ndarray, percent: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, their rows, which rows are to be parted again) of one level."""
    ends = bands(percent, int(sizes.max(initial=1)) * 100 // percent + 2)
    own = np.searchsorted(ends, sizes)
    salt = mix(np.array([level], dtype=np.uint64))[0] if level else np.uint64(0)
    mixed = mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    found, rows, again = [], [], np.zeros(len(sizes), dtype=bool)
    for extra in (0, 1):
        band = own + extra
        k = most_different(ends[np.minimum(band, len(ends) - 1)], percent)
        need = np.where((sizes > 0) & (k > 0), (k + 2) // 2, 0)
        spare = np.where(need >= 3, 1 + need // 8, 0)
        parts = need + spare
        first = np.concatenate([[0], np.cumsum(parts * CELLS)])
        row = np.repeat(np.arange(len(sizes)), sizes)
        use = parts[row] > 0
        many = (parts * CELLS).astype(np.uint64)[row[use]]
        cell = first[row[use]] + (mix((values[use] ^ salt) + band.astype(np.uint64)[row[use]]) % many).astype(np.int64)
        sums = _sums(cell, mixed[use], int(first[-1])).reshape(-1, CELLS)
        held = np.bincount(cell, minlength=int(first[-1])).reshape(-1, CELLS)
        # Empty pairs of cells are shared by chance.
        thin = held.sum(1, keepdims=True) == held
        owner = np.repeat(np.arange(len(sizes)), parts)
        place = np.arange(len(owner)) - (first // CELLS)[owner]
        tag = mix((band.astype(np.uint64)[owner] << np.uint64(40)) + (place.astype(np.uint64) << np.uint64(2)) + salt)
        again |= np.bincount(owner[thin.any(1)], minlength=len(sizes)) > spare
        for skip in range(CELLS):
            a, b = [c for c in range(CELLS) if c != skip]
            out = ~thin[:, skip] if level < LEVELS - 1 else np.ones(len(owner), dtype=bool)
            found.append(mix(sums[out, a] * np.uint64(3) + sums[out, b] * np.uint64(7) + tag[out] + np.uint64(skip)))
            rows.append(owner[out])
    return np.concatenate(found), np.concatenate(rows), again


def signatures(values: np.ndarray, starts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of each set, for its own band and the next, and where each set's begin; sets too small to be similar to another one have none."""
    sizes = np.diff(starts)
    found, rows, left = [], [], np.arange(len(sizes))
    for level in range(LEVELS):
        own, row, again = _level(values, sizes, percent, level)
        found.append(own)
        rows.append(left[row])
        values, left, sizes = values[np.repeat(again, sizes)], left[again], sizes[again]
        if not len(left):
            break
    found, rows = np.concatenate(found), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return found[order], np.searchsorted(rows[order], np.arange(len(starts)))


def sketch(values: np.ndarray) -> bytes:
    """A bit for each place of a table of two to four places a shingle: whether an odd number of the shingles fall there."""
    size = max(128, 1 << int(2 * len(values) - 1).bit_length()) if len(values) else 128
    bits = np.bincount((mix(values + np.uint64(0x5EED)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(bool), bitorder="little").tobytes()


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches of fewer places, as if made so: places that are equal modulo the new size come together."""
    while sketches.shape[-1] > words:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def _may_link(n: np.ndarray, m: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes that differ in so many shingles at least can be similar."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * apart <= (100 - percent) * (n + m))


def _sets(documents: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, n, k1, k2, sketch) of each document: its set's size, 128-bit hash and parity sketch."""

    def run(batches):
        for b in batches:
            for piece in texts(b.column(1)):
                values, starts = shingle_sets(piece, words)
                row = np.repeat(np.arange(len(piece)), np.diff(starts))
                k1 = _sums(row, values, len(piece))
                k2 = _sums(row, mix(values + np.uint64(77)), len(piece))
                drawn = [sketch(values[a:e]) for a, e in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0)[piece.first : piece.first + len(piece)], pa.array(np.diff(starts)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(drawn, pa.binary())], ["id", "n", "k1", "k2", "sketch"])

    return documents.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "id long, n long, k1 long, k2 long, sketch binary")


def _signed(documents: DataFrame, emit, kind: str, ids: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """What emit makes of some rows' (signature, row of the batch), sorted, and the columns of ids, for the documents with these ids."""
    columns = [c for c in ids.columns if c != "id"]

    def run(batches):
        found, owners, many = [], [], 0
        held, before = [], 0  # the columns of the batches in found, and the rows of those but the last

        def out():
            sig, row = np.concatenate(found).view(np.int64), np.concatenate(owners)
            found.clear()
            owners.clear()
            order = np.argsort(sig, kind="stable")
            got = emit(sig[order], row[order], *(np.concatenate(x) for x in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in got.values()], [*got])

        for b in batches:
            # Copies, as a batch's columns share its memory.
            held.append([np.array(b.column(c)) for c in ("id", *columns)])
            for piece in texts(b.column("_text")):
                sigs, at = signatures(*shingle_sets(piece, words), percent)
                found.append(sigs)
                owners.append(np.repeat(np.arange(before + piece.first, before + piece.first + len(piece)), np.diff(at)))
                many += len(sigs)
                if many > SIGNATURES:
                    yield out()
                    held, before, many = held[-1:], 0, 0
            before += b.num_rows
        if many:
            yield out()

    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text")).join(small(ids, BROADCAST_ROWS), "id")
    return rows.select("id", "_text", *columns).mapInArrow(run, kind)


def _combined(sig: np.ndarray, row: np.ndarray, ids: np.ndarray) -> dict[str, np.ndarray]:
    """(sig, id): of the rows of a signature the first two, the first twice if there are more; each other row shares a signature of its own, three times there, with the first."""
    who = ids[row]
    head = np.append(True, sig[1:] != sig[:-1])[: len(sig)]
    start = np.flatnonzero(head)
    run = np.cumsum(head) - 1
    nth = np.arange(len(sig)) - start[run]
    more = np.diff(np.append(start, len(sig))) > 2
    hub = who[start][run] if len(sig) else who
    pair = np.unique(np.stack([hub[nth > 1], who[nth > 1]]), axis=1)
    own = mix(mix(pair[0].view(np.uint64)) + pair[1].view(np.uint64)).view(np.int64)
    return {"sig": np.concatenate([sig[nth < 2], sig[start[more]], own, own, own]), "id": np.concatenate([who[nth < 2], who[start[more]], pair[0], pair[0], pair[1]])}


def _runs(batches):
    """(hub, id, closed) for the rows of each signature but its first; closed: the two are all of it. Rows come sorted by signature and id."""
    last_sig = last_id = last_hub = None
    seen = 0  # rows of the last signature so far
    for b in batches:
        sig, who = b.column("sig").to_numpy(zero_copy_only=False), b.column("id").to_numpy(zero_copy_only=False)
        if not len(sig):
            continue
        if seen == 1:  # a lone row waits for the next batch
            sig, who, last_sig = np.append(last_sig, sig), np.append(last_id, who), None
        head = np.append(last_sig is None or sig[0] != last_sig, sig[1:] != sig[:-1])
        start = np.flatnonzero(head)
        at = np.maximum.accumulate(np.where(head, np.arange(len(sig)), -1))
        hub = np.where(at >= 0, who[np.maximum(at, 0)], last_hub if last_hub is not None else -1)
        many = np.diff(np.append(start, len(sig)))
        # The last signature may go on, so its rows count as open; a lone one is held back.
        closed = np.zeros(len(sig), dtype=bool)
        closed[start[:-1][many[:-1] == 2] + 1] = True
        seen = many[-1] if len(start) else 3
        last_sig, last_id, last_hub = sig[-1], who[-1], hub[-1]
        link = ~head & (hub != who)
        both, where = np.unique(np.stack([hub[link], who[link]]), axis=1, return_inverse=True)
        all_closed = np.ones(both.shape[1], dtype=bool)
        np.logical_and.at(all_closed, where.ravel(), closed[link])
        yield pa.RecordBatch.from_arrays([pa.array(both[0], pa.int64()), pa.array(both[1], pa.int64()), pa.array(all_closed)], ["hub", "id", "closed"])


def _grouped(pairs: DataFrame) -> DataFrame:
    """(id, hub, block, member): each pair's id as a member of a block of its hub's, and the hub beside each block."""
    large = pairs.groupBy("hub").count().filter(F.col("count") > HUB_ROWS).select("hub", F.ceil(F.col("count") / HUB_ROWS).alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1)))
    members = pairs.join(small(large, BROADCAST_ROWS), "hub", "left").select("id", "hub", block.alias("block"), F.lit(True).alias("member"))
    hubs = members.select(F.col("hub").alias("id"), "hub", "block", F.lit(False).alias("member")).distinct()
    return members.unionAll(hubs)


def _tested(rows: DataFrame, test) -> DataFrame:
    """(hub, id) of the rows (hub, block, member, id, n, v) for which test(n, v, n, v) holds with one of the hub's own."""

    def run(batches):
        now, own = None, []
        for b in batches:
            hubs, blocks, members, ids, sizes = (b.column(c).to_pylist() for c in ("hub", "block", "member", "id", "n"))
            v, good = b.column("v"), []
            raw = np.frombuffer(v.buffers()[2], dtype=np.uint8) if v.buffers()[2] else np.empty(0, np.uint8)
            at = np.frombuffer(v.buffers()[1], dtype=np.int32 if pa.types.is_binary(v.type) else np.int64)[v.offset : v.offset + len(v) + 1]
            for i, key in enumerate(zip(hubs, blocks, strict=True)):
                x = raw[at[i] : at[i + 1]].view(np.uint64)
                if key != now:
                    now, own = key, []
                if not members[i]:
                    own.append((sizes[i], x.copy()))
                else:
                    good += [i] * any(test(n, w, sizes[i], x) for n, w in own)
            yield pa.RecordBatch.from_arrays([pa.array([hubs[i] for i in good], pa.int64()), pa.array([ids[i] for i in good], pa.int64())], ["hub", "id"])

    sorted_rows = rows.select("hub", "block", "member", "id", "n", "v").repartition("hub", "block").sortWithinPartitions("hub", "block", "member")
    return sorted_rows.mapInArrow(run, "hub long, id long").distinct()


def _by_sketch(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches leave open that they are similar."""

    def test(n, v, m, w):
        words = min(len(v), len(w))
        return bool(_may_link(n, m, np.bitwise_count(_folded(v, words) ^ _folded(w, words)).sum(), percent))

    return _tested(_grouped(pairs).join(sketches.withColumnRenamed("sketch", "v"), "id"), test)


def _verified(pairs: DataFrame, documents: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar."""

    def sets(batches):
        for b in batches:
            for piece in texts(b.column("_text")):
                values, starts = shingle_sets(piece, words)
                v = [values[a:e].tobytes() for a, e in zip(starts[:-1], starts[1:], strict=True)]
                at = slice(piece.first, piece.first + len(piece))
                yield pa.RecordBatch.from_arrays([*[b.column(c)[at] for c in ("hub", "block", "member", "id")], pa.array(np.diff(starts)), pa.array(v, pa.binary())], ["hub", "block", "member", "id", "n", "v"])

    def test(n, v, m, w):
        if 100 * min(n, m) < percent * max(n, m):
            return False
        both = np.concatenate([v, w])
        both.sort()
        shared = int((both[1:] == both[:-1]).sum())
        return 100 * shared >= percent * (n + m - shared)

    wanted = keep(_grouped(pairs), "wanted")
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text")).join(small(wanted, BROADCAST_ROWS), "id")
    out = keep(_tested(rows.select("hub", "block", "member", "id", "_text").mapInArrow(sets, "hub long, block long, member boolean, id long, n long, v binary"), test), "links", BATCH_BYTES)
    discard(wanted)
    return out


def _apart(runs: DataFrame, sketches: DataFrame, roots: DataFrame, percent: int, nearest: int | None) -> DataFrame:
    """(hub, id, more) of the rows of a run (sig, id) that are in different components and may be similar by their sketches.

    nearest: only so many for each row and other component in a cell; more tells that others were left out.
    """
    own = runs.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    sizes = own.groupBy("sig", "root").count()
    summed = sizes.groupBy("sig").agg(F.max_by("root", F.struct("count", "root")).alias("largest"), F.sum("count").alias("rows"), F.max("count").alias("most"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    cells = lambda c: F.ceil(F.greatest(c, F.lit(1)) / CELL_ROWS).cast("int")
    summed = summed.select("sig", "largest", cells(F.col("rows")).alias("across"), cells(F.col("rows") - F.col("most")).alias("down"))
    rows = own.join(summed, "sig").join(sketches, "id")
    cell = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    all_cells = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = ["id", "root", "n", "sketch"]
    everyone = rows.select("sig", cell("across").alias("x"), all_cells("down").alias("y"), F.lit(True).alias("member"), *rest)
    outside = rows.filter("root != largest").select("sig", cell("down").alias("y"), all_cells("across").alias("x"), F.lit(False).alias("member"), *rest)

    def compare(group):
        """The pairs of one cell: its rows outside the largest component, then all of them."""
        member, ids, roots, sizes = (group.column(c).to_numpy() for c in ("member", "id", "root", "n"))
        if member[0] or group.num_rows < 2:
            return
        marks = group.column("sketch").to_pylist()
        words = min(len(m) for m in marks) // 8
        marks = np.stack([_folded(np.frombuffer(m, dtype=np.uint64), words) for m in marks])
        inside = np.flatnonzero(member)
        for i in np.flatnonzero(~member):
            apart = np.bitwise_count(marks[inside] ^ marks[i]).sum(1).astype(np.int64)
            able = np.flatnonzero(_may_link(sizes[inside], sizes[i], apart, percent) & (roots[inside] != roots[i]))
            more = False
            if nearest is not None and len(able) > nearest:
                many = len(able)
                able = able[np.lexsort((ids[inside[able]], apart[able] / (sizes[inside[able]] + sizes[i]), roots[inside[able]]))]
                other = roots[inside[able]]
                start = np.flatnonzero(np.append(True, other[1:] != other[:-1]))
                able = able[np.arange(len(able)) - np.repeat(start, np.diff(np.append(start, len(able)))) < nearest]
                more = len(able) < many
            to = ids[inside[able]]
            yield np.stack([np.minimum(to, ids[i]), np.maximum(to, ids[i]), np.full(len(to), more)])

    def run(batches):
        group = None

        def out():
            found = np.unique(np.concatenate([np.empty((3, 0), dtype=np.int64), *compare(group)], axis=1), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2] > 0)], ["hub", "id", "more"])

        for b in batches:
            key = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("sig", "x", "y")])
            starts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0)))[: b.num_rows]
            for at, to in zip(starts, np.append(starts[1:], b.num_rows), strict=True):
                part = pa.Table.from_batches([b.slice(at, to - at)])
                if group is not None and (now == key[:, at]).all():
                    group = pa.concat_tables([group, part])
                else:
                    if group is not None:
                        yield out()
                    now, group = key[:, at], part
        if group is not None:
            yield out()

    cells_of = everyone.unionByName(outside).repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y", "member").select("sig", "x", "y", "member", *rest)
    return cells_of.mapInArrow(run, "hub long, id long, more boolean").groupBy("hub", "id").agg(F.max("more").alias("more"))


def _left_out(runs: DataFrame, tested: DataFrame) -> DataFrame:
    """The runs that hold a row for which _apart left others out: each pair that was left out is in one of them."""
    ids = tested.filter("more").select(F.explode(F.array("hub", "id")).alias("id")).distinct()
    sigs = keep(runs.join(small(ids, BROADCAST_ROWS), "id").select("sig").distinct(), "left_out")
    out = keep(runs.join(small(sigs, BROADCAST_ROWS), "sig"), "runs")
    discard(sigs)
    return out


def _open_runs(documents: DataFrame, involved: DataFrame, named: dict) -> DataFrame:
    """(sig, id) of the signatures that the ids of involved (id, root) share across roots."""

    def roots_of(sig, row, ids, roots):
        both = np.unique(np.stack([sig, roots[row]]), axis=1)
        return {"sig": both[0], "root": both[1]}

    of_roots = _signed(documents, roots_of, "sig long, root long", involved, **named)
    shared = keep(of_roots.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("sig"), "open", BATCH_BYTES)
    rows = _signed(documents, lambda sig, row, ids: {"sig": sig, "id": ids[row]}, "sig long, id long", involved.select("id"), **named)
    out = keep(rows.join(small(shared, BROADCAST_ROWS), "sig").distinct(), "runs", BATCH_BYTES)
    discard(shared)
    return out


def similar_sets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id (long), n_shingles, component_id for each row: its set's size and the smallest id of its component of links.

    A set holds the distinct shingles of so many words (white space apart, A-Z in lower case); with
    fewer words, the whole sequence. Two rows link when 100 * |both| >= percent * |either|, equal
    sets among them. Null and empty texts have an empty set and link with nothing. Ids are integers.
    Rows with equal ids and different texts are one document of several texts, so their sets share
    a component. A row with a null id belongs to the rows with an equal set, if one of them has an
    id; else its component is null, and it links with nothing. Further columns are not read.
    Shingles are compared by 64-bit hashes.
    """
    named = {"id_col": id_col, "text_col": text_col, "words": words, "percent": percent}
    base = keep(_sets(documents, id_col, text_col, words), "sets", BATCH_BYTES)
    # Stored, so that the join shuffles it anew and adaptive execution can split a large group of equal sets.
    nodes = keep(base.filter("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.max("n").alias("n")), "nodes")
    reps = keep(base.drop("sketch").join(nodes.drop("n"), ["k1", "k2"], "left").select("id", "n", F.coalesce("rep", "id").alias("rep")), "named")
    alone = nodes.filter(F.col("n") * (100 - percent) >= percent).select(F.col("rep").alias("id")).filter("id is not null").distinct()
    signed = _signed(documents, _combined, "sig long, id long", alone, **named).repartition("sig").sortWithinPartitions("sig", "id")
    pairs = keep(signed.mapInArrow(_runs, "hub long, id long, closed boolean").groupBy("hub", "id").agg(F.min("closed").alias("closed")), "candidates", BATCH_BYTES)
    involved = pairs.select(F.explode(F.array("hub", "id")).alias("id")).distinct()
    sketches = keep(base.select("id", "n", "sketch").join(small(keep(involved, "involved"), BROADCAST_ROWS), "id", "left_semi"), "sketches")
    discard(base, nodes)

    maybe = keep(_by_sketch(pairs, sketches, percent), "maybe", BATCH_BYTES)
    links = [_verified(maybe, documents, id_col, text_col, words, percent)]
    discard(maybe)
    # Rows with equal ids whose sets differ.
    several = reps.filter("n > 0").groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi")
    several = keep(several.join(reps.filter("n > 0"), "id").select(F.col("lo").alias("hub"), F.col("rep").alias("id")), "several")
    links.append(several)
    roots = connected_components(links[0].unionAll(links[1]), "hub", "id")

    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    ends = pairs.filter("not closed").join(of("hub"), "hub", "left").join(of("id"), "id", "left")
    ends = keep(ends.select("hub", "id", F.coalesce("hub_root", "hub").alias("hub_root"), F.coalesce("id_root", "id").alias("id_root")), "open_ends")
    if not ends.filter("hub_root != id_root").isEmpty():
        both = F.explode(F.array(F.struct(F.col("hub").alias("id"), F.col("hub_root").alias("root")), F.struct("id", F.col("id_root").alias("root"))))
        runs = _open_runs(documents, keep(ends.select(both.alias("x")).select("x.*").distinct(), "open_ids"), named)
        tested = []
        for nearest in (NEAREST, None):
            maybe = _apart(runs, sketches, roots.select(F.col("node").alias("id"), "root"), percent, nearest)
            for before in tested:
                maybe = maybe.join(before, ["hub", "id"], "left_anti")
            tested.append(keep(maybe, "maybe", BATCH_BYTES))
            if tested[-1].isEmpty():
                break
            links.append(_verified(tested[-1].drop("more"), documents, id_col, text_col, words, percent))
            every = links[0]
            for more in links[1:]:
                every = every.unionAll(more)
            if not links[-1].isEmpty():
                old, roots = roots, connected_components(every, "hub", "id")
                discard(old)
            if nearest is None or tested[-1].filter("more").isEmpty():
                break
            whole, runs = runs, _left_out(runs, tested[-1])
            discard(whole)
        discard(runs, *tested)
    discard(pairs, sketches, ends, *links)
    final = reps.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    return final.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component_id"))


def keep_first(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """documents with one document of each group of near duplicates, that of the smallest id; all columns stay, and so do rows without words or without an id."""
    groups = similar_sets(documents, id_col, text_col, words, percent)
    gone = groups.filter(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct()
    return documents.join(gone, F.col(id_col).cast("long") == F.col("_gone"), "left_anti")
