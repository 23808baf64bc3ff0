"""URL filters: exact membership of url keys in rule lists by a cascade of Bloom filters.

A url's keys are its host's suffixes, each with the beginnings of its path that some rule could
name. All such keys of the corpus are the universe. Level 1 of a cascade encodes the listed keys,
level 2 the universe's other keys that level 1 lets pass, level 3 the listed keys that level 2
lets pass, and so on until nothing passes wrongly. The first level that a key fails tells whether
it is listed, without an error for any key of the universe, so urls are judged without a join.

The first level has about log2(universe / list) bits for each listed key and each further one a
few, so what is broadcast follows the list and not the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import keep, mix

MAX_LEVELS = 60


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty for null or without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ?, # or the end; empty for null or without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(h: Column, p: Column, lengths: list[int]) -> Column:
    """All host suffixes at a dot, with each beginning of the path of one of the lengths; longest first."""
    labels = F.split(h, r"\.", -1)
    hosts = F.when(h == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    paths = F.filter(F.array(*[F.when(F.length(p) >= n, F.substring(p, 1, n)) for n in sorted(lengths, reverse=True)]), lambda x: x.isNotNull()) if lengths else F.array().cast("array<string>")
    keys = F.flatten(F.transform(hosts, lambda a: F.transform(paths, lambda b: F.concat(a, b))))
    return F.array_sort(F.array_distinct(keys), lambda a, b: F.coalesce(F.length(b) - F.length(a), F.lit(0)))


def _bits(h1: np.ndarray, h2: np.ndarray, level: int, size: int, hashes: int) -> np.ndarray:
    """The places of each key in a filter, one row for each hash."""
    # Mixed anew for each level: keys that fall together in one filter must part in the next.
    turn = mix(np.array([level + 1], dtype=np.uint64))
    a, b = mix(h1.astype(np.int64).view(np.uint64) + turn), mix(h2.astype(np.int64).view(np.uint64) ^ turn) | np.uint64(1)
    return np.stack([(a + b * np.uint64(i)) % np.uint64(size) for i in range(hashes)])


def passes(levels: list[tuple[int, int, np.ndarray]], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """For each key the number of levels it passes before it fails one; listed if that number is odd."""
    out, alive = np.zeros(len(h1), dtype=np.int64), np.arange(len(h1))
    for n, (size, hashes, words) in enumerate(levels):
        if not len(alive):
            break
        at = _bits(h1[alive], h2[alive], n, size, hashes)
        alive = alive[((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(0)]
        out[alive] = n + 1
    return out


def _level(keys: DataFrame, level: int, count: int, rate: float) -> tuple[int, int, np.ndarray]:
    """A Bloom filter of the keys: its bits are set in tasks and merged by 64-bit words."""
    size = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2))
    hashes = max(1, round(size / max(1, count) * math.log(2)))
    hashes = min(hashes, 30)

    def places(batches):
        for pdf in batches:
            at = np.unique(_bits(pdf.h1.to_numpy(), pdf.h2.to_numpy(), level, size, hashes))
            yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int64), "bits": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    words = np.zeros(size // 64 + 1, dtype=np.uint64)
    got = keys.select("h1", "h2").mapInPandas(places, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words[got.word.to_numpy(np.int64)] = got.bits.to_numpy(np.int64).view(np.uint64)
    return size, hashes, words


def cascade(universe: DataFrame, listed: str) -> list[tuple[int, int, np.ndarray]]:
    """Levels for the keys (h1, h2) of universe: those whose column named by listed is true against all others. universe should be stored, as each level reads it."""
    counts = universe.agg(F.count_if(F.col(listed)), F.count_if(~F.col(listed))).first()
    levels: list[tuple[int, int, np.ndarray]] = []
    wrong, left = counts[0], counts[1]
    while wrong and len(levels) < MAX_LEVELS:
        n, inside = len(levels), F.col(listed) if len(levels) % 2 == 0 else ~F.col(listed)
        before = list(levels)

        def still(batches, before=before):
            for pdf in batches:
                yield pdf[passes(before, pdf.h1.to_numpy(), pdf.h2.to_numpy()) == len(before)]

        alive = universe.filter(inside).select("h1", "h2")
        alive = alive.mapInPandas(still, "h1 long, h2 long") if n else alive
        levels.append(_level(alive, n, wrong, min(0.5, max(1e-9, wrong * math.sqrt(2) / max(1, left))) if n == 0 else 0.5))
        built = list(levels)

        def wrongly(batches, built=built):
            for pdf in batches:
                yield pdf[passes(built, pdf.h1.to_numpy(), pdf.h2.to_numpy()) == len(built)]

        other = universe.filter(~inside).select("h1", "h2").mapInPandas(wrongly, "h1 long, h2 long").count()
        wrong, left = other, wrong
    if wrong:
        raise ValueError("two keys of the universe have equal hashes")
    return levels


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule (or null) and verdict added; columns of these names are replaced.

    rules: (verdict, host, path) with verdict allow or block. A rule fits its host and all
    subdomains if the path starts with the rule's; the longest host and path together wins, and
    block wins where two rules are equal. A url that no rule fits gets the default. A null url, and
    one without ://, has an empty host and path, which no rule fits. An empty table or an empty
    list of rules is fine. The table of rules is small: the driver holds it.
    """
    spark = pages.sparkSession
    lengths = sorted({len(p) for _, _, p in rules})
    listed = spark.createDataFrame([(h + p, v) for v, h, p in rules], "key string, verdict string")
    keys = candidate_keys(host(F.col(url_col)), path(F.col(url_col)), lengths)
    two = [F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2")]
    corpus = pages.select(F.explode(keys).alias("key")).select(*two, F.lit(False).alias("block"), F.lit(False).alias("allow"))
    own = listed.select(*two, (F.col("verdict") == "block").alias("block"), (F.col("verdict") == "allow").alias("allow"))
    universe = keep(corpus.unionAll(own).groupBy("h1", "h2").agg(F.max("block").alias("block"), F.max("allow").alias("allow")), "url_keys")
    both = spark.sparkContext.broadcast({v: cascade(universe, v) for v in ("block", "allow")})

    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    names = [f"_c{i}" for i in range(len(kept))]
    found = {"host": host(F.col(url_col)), "path": path(F.col(url_col)), "_keys": keys, "_h1": F.transform(keys, lambda k: F.xxhash64(k)), "_h2": F.transform(keys, lambda k: F.xxhash64(k, F.lit(1)))}
    rows = pages.select(*[F.col(c).alias(n) for c, n in zip(kept, names, strict=True)], *[c.alias(n) for n, c in found.items()])

    def judge(batches):
        for b in batches:
            starts = b.column("_keys").offsets.to_numpy()
            starts = starts - starts[0]
            flat = [b.column(c).flatten().to_numpy() for c in ("_h1", "_h2")]
            hit = {v: passes(levels, *flat) % 2 == 1 for v, levels in both.value.items()}
            row = np.repeat(np.arange(b.num_rows), np.diff(starts))
            place, verdict = np.full(b.num_rows, -1), np.full(b.num_rows, default, dtype=object)
            at = np.flatnonzero(hit["block"] | hit["allow"])[::-1]  # the first of a row, which is the longest, is written last
            place[row[at]] = at
            verdict[row[at]] = np.where(hit["block"][at], "block", "allow")
            rule = b.column("_keys").flatten().take(pa.array(place, mask=place < 0))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in (*names, "host", "path")], rule, pa.array(verdict, pa.string())], [*names, "host", "path", "rule", "verdict"])

    kinds = "".join(f"{n} {pages.schema[c].dataType.simpleString()}, " for c, n in zip(kept, names, strict=True))
    return rows.mapInArrow(judge, kinds + "host string, path string, rule string, verdict string").toDF(*kept, "host", "path", "rule", "verdict")
