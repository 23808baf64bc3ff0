"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of letters and digits in lower case, taken whole and as stems of their first bytes,
so that inflected forms share features. Features are the distinct hashes of words and stems, of
pairs of neighbours and of pairs with one or two words between. Training walks through the labelled
rows with a rate for each coordinate and an L1 threshold, under which a weight is zero, so what is
broadcast for scoring is a short list of indices and weights.

Training runs on shards of the sample in parallel: each starts a round from the mean state of the
last and returns the coordinates it changed; their mean by coordinate starts the next round.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import LOWER, WORDLIKE, keep, mix, texts

STEMS = (4, 5)


@dataclass
class Ftrl:
    """Parameters. sample_rows bounds the labelled rows that are learnt from; they are the first by a hash of the id."""

    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.1
    rounds: int = 3
    rows_per_shard: int = 4_000
    sample_rows: int = 16_000


@dataclass
class Model:
    """Sorted indices of the features with weights, the weights, and the bias."""

    bits: int
    index: np.ndarray
    weight: np.ndarray
    bias: float
    params: Ftrl = field(default_factory=Ftrl)

    def table(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.index] = self.weight
        return out


def _features(piece, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all n-grams and skip-grams of a piece of texts; repeats are not removed."""
    raw = LOWER[piece.raw]
    begin, end = piece.runs(WORDLIKE[raw])
    words, starts = piece.hashes(raw, begin, end), np.searchsorted(begin, piece.starts)
    row = np.repeat(np.arange(len(piece)), np.diff(starts))
    shift = np.uint64(64 - bits)
    rows, features = [row], [mix(words) >> shift]
    for n in STEMS:
        long = end - begin > n
        rows.append(row[long])
        features.append(mix(piece.hashes(raw, begin[long], begin[long] + n) + np.uint64(n)) >> shift)
    for gap in (1, 2, 3):
        a, b = slice(None, -gap), slice(gap, None)
        if len(words) > gap:
            same = row[a] == row[b]
            rows.append(row[a][same])
            features.append(mix(words[a][same] * np.uint64(3) + words[b][same] * np.uint64(5) + np.uint64(gap)) >> shift)
    return np.concatenate(rows), np.concatenate(features).astype(np.int64)


def _distinct(row: np.ndarray, feature: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((row << bits) | feature)
    return both >> bits, both & ((1 << bits) - 1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _learn(rows: list[np.ndarray], labels: np.ndarray, z: np.ndarray, n: np.ndarray, p: Ftrl) -> None:
    """One pass over the rows; the last coordinate is the bias, which has no L1."""
    l1 = np.append(np.full(1 << p.bits, p.l1), 0.0)
    for x, y in zip(rows, labels, strict=True):
        x = np.append(x.astype(np.int64), 1 << p.bits)
        zx, nx, l1x = z[x], n[x], l1[x]
        w = np.where(np.abs(zx) <= l1x, 0.0, (np.sign(zx) * l1x - zx) / ((p.beta + np.sqrt(nx)) / p.alpha + p.l2))
        g = _sigmoid(w.sum()) - y
        z[x] += g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / p.alpha * w
        n[x] += g * g


def train(documents: DataFrame, labels: DataFrame, params: Ftrl | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model of label_col (0 or 1) from the labelled documents, of at most params.sample_rows of them.

    Rows whose label is null or anything but 0 or 1, or whose id is null, are left out; a document
    with several labels counts once for each. A null text counts as empty. Without any row the
    model gives 0.5 for all texts. Only the id, the text and the label are read.
    """
    p = params or Ftrl()
    spark = documents.sparkSession
    good = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).filter("_label in (0, 1) and _id is not null")
    known = good.orderBy(F.xxhash64("_id"), "_id", "_label").limit(p.sample_rows)
    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id")
    # Texts and not features, which are some times as large and quickly made again.
    sample = keep(rows.select("_id", "_text", "_label"), "sample")
    size = (1 << p.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    shards_wanted = max(1, -(-sample.count() // p.rows_per_shard))
    for turn in range(p.rounds):
        state = spark.sparkContext.broadcast((z, n))

        def learn(batches, state=state, turn=turn):
            mine_z, mine_n = (a.copy() for a in state.value)
            seen = []
            for b in batches:
                label = b.column("_label").to_pylist()
                for piece in texts(b.column("_text")):
                    row, feature = _distinct(*_features(piece, p.bits), p.bits)
                    at = np.searchsorted(row, np.arange(len(piece) + 1))
                    feature = feature.astype(np.int32)
                    seen += [(feature[at[i] : at[i + 1]], label[piece.first + i]) for i in range(len(piece))]
            if seen:
                order = np.random.default_rng(turn).permutation(len(seen))
                _learn([seen[i][0] for i in order], np.array([seen[i][1] for i in order], dtype=float), mine_z, mine_n, p)
                at = np.flatnonzero(mine_n > 0)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(mine_z[at]), pa.array(mine_n[at])], ["i", "z", "n"])

        shards = sample.repartition(shards_wanted).sortWithinPartitions("_id", "_label")
        got = shards.select("_label", "_text").mapInArrow(learn, "i int, z double, n double").groupBy("i").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow()
        at = got.column("i").to_numpy()
        z, n = np.zeros(size), np.zeros(size)
        z[at], n[at] = got.column("z").to_numpy(), got.column("n").to_numpy()
        state.unpersist()
    l1 = np.append(np.full(1 << p.bits, p.l1), 0.0)
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))
    index = np.flatnonzero(w[:-1])
    return Model(p.bits, index.astype(np.int32), w[index], float(w[-1]), p)


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", name: str = "score") -> DataFrame:
    """(id, score): the probability of label 1 of each whole text; a null or empty text has the bias's alone. Rows with equal ids are scored one by one."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        table = model.table()
        for b in batches:
            for piece in texts(b.column(1)):
                row, feature = _features(piece, model.bits)
                has = table[feature] != 0
                row, feature = _distinct(row[has], feature[has], model.bits)
                total = np.bincount(row, weights=table[feature], minlength=len(piece)) + model.bias
                yield pa.RecordBatch.from_arrays([b.column(0)[piece.first : piece.first + len(piece)], pa.array(_sigmoid(total))], [id_col, name])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, `{name}` double")


def held_out(id_column: Column, folds: int = 5) -> Column:
    """True for ids whose crc32, as text, is divisible by folds: these are never learnt from."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds == 0


def drop_toxic(documents: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """documents without the rows whose text scores threshold or more; all columns and their order stay. Scored row by row, so ids need not be unique."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        table = sent.value.table()
        for b in batches:
            for piece in texts(b.column(b.schema.get_field_index("_text"))):
                row, feature = _features(piece, sent.value.bits)
                has = table[feature] != 0
                row, feature = _distinct(row[has], feature[has], sent.value.bits)
                total = np.bincount(row, weights=table[feature], minlength=len(piece)) + sent.value.bias
                # By pieces, so that no second batch of texts is held here and in the executor.
                yield b.slice(piece.first, len(piece)).filter(pa.array(_sigmoid(total) < threshold))

    names = [f"_c{i}" if c != text_col else "_text" for i, c in enumerate(documents.columns)]
    rows = documents.toDF(*names)
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, documents.schema, strict=True))
    return rows.mapInArrow(run, kinds).toDF(*documents.columns)
