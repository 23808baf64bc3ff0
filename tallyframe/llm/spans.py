"""Substring deduplication by sliding sentence spans.

A text is cut into sentences after . ! ? and line feeds. From each sentence starts a span, and at
each one ends a span: the shortest run of at least two consecutive sentences with at least
min_words words. A sentence of twice as many words is a span of its own besides. Spans are hashed
on their words and brought together over all documents, after each task has put its own repeats
aside, so no kind of span is large anywhere. Every span but the first of its kind (by id, then by
place) marks its sentences; the marked sentences are removed. Spans are of fixed content, so a
passage gives the same ones wherever it stands. Those within any run of at least two sentences and
min_words words cover all of it, so every repeated run of this kind is removed whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import SPACE, keep, mix, texts

MIN_WORDS = 20
COMBINED = 500_000
_END = np.zeros(256, dtype=bool)
_END[[0x21, 0x2E, 0x3F]] = True


def sentences(piece) -> tuple[np.ndarray, np.ndarray]:
    """Where each sentence begins, in bytes of the piece, and its row: after a line feed, and at the first word after one that ends in . ! or ?"""
    raw = piece.raw
    begin, end = piece.runs((~SPACE)[raw])
    if not len(begin):
        return begin, begin
    row = np.searchsorted(piece.starts, begin, side="right") - 1
    feeds = np.concatenate([[0], np.cumsum(raw == 10)])
    first = np.ones(len(begin), dtype=bool)
    first[1:] = _END[raw[end[:-1] - 1]] | (feeds[begin[1:]] > feeds[end[:-1]]) | (row[1:] != row[:-1])
    return begin[first], row[first]


def spans(piece, min_words: int) -> tuple[np.ndarray, ...]:
    """(row, first sentence in the row, sentences, hash, second hash) of each span."""
    words, at = piece.words(~SPACE)
    begin, row = sentences(piece)
    if not len(begin):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    word_begin, _ = piece.runs((~SPACE)[piece.raw])
    word_at = np.append(np.searchsorted(word_begin, begin), len(words))
    sentence_at = np.searchsorted(row, np.arange(len(piece) + 1))
    last_word = at[row + 1]
    # From each start the sentence whose end is the first at or behind so many words, and two sentences at least.
    start = np.arange(len(begin))
    stop = np.maximum(np.searchsorted(word_at, word_at[:-1] + min_words, side="left"), start + 2)
    fits = (stop <= sentence_at[row + 1]) & (word_at[np.minimum(stop, len(begin))] <= last_word)
    # To each end the last start so many words before, unless that run is there already.
    back = np.minimum(np.searchsorted(word_at, word_at[1:] - min_words, side="right") - 1, start - 1)
    new = (back >= sentence_at[row]) & (stop[back] != start + 1)
    alone = word_at[1:] - word_at[:-1] >= 2 * min_words
    s, e = np.concatenate([start[fits], back[new], start[alone]]), np.concatenate([stop[fits], start[new] + 1, start[alone] + 1])
    a, b = word_at[s], word_at[e]
    # Words are numbered within the span by their place; sums over places are taken from prefix sums.
    place = np.arange(len(words), dtype=np.uint64)
    plain, placed = np.zeros(len(words) + 1, np.uint64), np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words, out=plain[1:])
    np.cumsum(words * place, out=placed[1:])
    total, weighted = plain[b] - plain[a], placed[b] - placed[a]
    weighted = weighted - total * a.astype(np.uint64)
    first = mix(words[a] * np.uint64(31) + words[np.maximum(b - 1, 0)] * np.uint64(7) + (b - a).astype(np.uint64))
    return row[s], s - sentence_at[row[s]], e - s, mix(mix(weighted) + total), mix(first + mix(total ^ weighted))


def _combined(found: list[tuple[np.ndarray, ...]], most: int) -> pa.RecordBatch:
    """(h1, h2, id, t, place) of spans (h1, h2, id, t, first, sentences): the first of each kind, and what the others cover, merged, under keys of their own with places below 0.

    place is first * (most + 1) + sentences, as no span has more than most sentences.
    """
    h1, h2, ids, t, first, many = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((first, t, ids, h2, h1))
    h1, h2, ids, t, first, many = (x[order] for x in (h1, h2, ids, t, first, many))
    # Rows equal in id and text are one document.
    once = np.append(True, np.logical_or.reduce([x[1:] != x[:-1] for x in (h1, h2, ids, t, first)]))[: len(h1)]
    h1, h2, ids, t, first, many = (x[once] for x in (h1, h2, ids, t, first, many))
    head = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))[: len(h1)]
    place = first * (most + 1) + many
    covered = np.lexsort((place[~head], t[~head], ids[~head]))
    i, u, a, n = (x[~head][covered] for x in (ids, t, first, many))
    if len(i):
        # Spans that begin where an earlier one of the text still goes on add sentences only beyond it.
        new_text = np.append(True, (i[1:] != i[:-1]) | (u[1:] != u[:-1]))
        shift = np.cumsum(new_text) * (int((a + n).max()) + 1)
        reach = np.maximum.accumulate(a + n + shift)
        before = np.append(0, reach[:-1])
        start = np.maximum(a + shift, before) - shift
        useful = start < a + n
        i, u, a, n = i[useful], u[useful], start[useful], (a + n - start)[useful]
    key = mix(mix(i.view(np.uint64) + np.uint64(1)) + a.view(np.uint64)).view(np.int64)
    columns = [(h1[head], key), (h2[head], np.zeros(len(i), np.int64)), (ids[head], i), (t[head], u), (place[head], -1 - (a * (most + 1) + n))]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in columns], ["h1", "h2", "id", "t", "place"])


def _later(batches, most: int):
    """(id, t, first, sentences) of the spans but the first of each kind, of rows sorted by kind and place."""
    last = None
    for b in batches:
        h1, h2, ids, t, place = (b.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "id", "t", "place"))
        if not len(h1):
            continue
        columns = (h1, h2, ids, t, place)
        equal = [np.append(last is not None and last[k] == x[0], x[1:] == x[:-1]) for k, x in enumerate(columns)]
        last = tuple(x[-1] for x in columns)
        out = (equal[0] & equal[1] & ~(equal[2] & equal[3] & equal[4])) | (place < 0)
        at = np.where(place < 0, -1 - place, place)[out]
        yield pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(t[out]), pa.array((at // (most + 1)).astype(np.int32)), pa.array((at % (most + 1)).astype(np.int32))], ["id", "t", "first", "sentences"])


def repeated_spans(rows: DataFrame, min_words: int) -> DataFrame:
    """(id, t, first, sentences) of the spans of rows (id, t, text) that are not the first of their kind; spans of a text that a task finds repeated itself come merged."""
    most = max(2, min_words)

    def run(batches):
        for b in batches:
            ids, t = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            found, many = [], 0
            for piece in texts(b.column(2)):
                row, first, count, h1, h2 = spans(piece, min_words)
                at = piece.first + row
                found.append((h1.view(np.int64), h2.view(np.int64), ids[at], t[at], first, count))
                many += len(row)
                if many > COMBINED:
                    yield _combined(found, most)
                    found, many = [], 0
            if many:
                yield _combined(found, most)

    found = rows.mapInArrow(run, "h1 long, h2 long, id long, t long, place long")
    ordered = found.repartition("h1").sortWithinPartitions("h1", "h2", "id", "t", "place")
    return ordered.mapInArrow(lambda batches: _later(batches, most), "id long, t long, first int, sentences int")


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """documents with every sentence removed that a non-first repeated span covers; n_sentences, n_removed and removed_chars are added.

    A removed sentence goes with the white space behind it; all else stays byte for byte. The first
    of equal spans is the one of the smallest id and, within it, the first place; repeats within a
    text count too. Texts with fewer than min_words words have no span and stay. Null stays null,
    empty stays empty. Ids are integers; a row with a null id stays as it is. Rows that repeat an id
    with another text are documents of their own, in the order of a hash of their texts; rows equal
    in both are one document and come out alike. Columns of the added names are replaced, all others stay.
    """
    own = F.col(id_col).cast("long")
    # A text is told apart by its hash only where ids repeat.
    repeat = documents.groupBy(own.alias("id")).count().filter("count > 1 and id is not null").limit(1).count()
    tag = F.xxhash64(text_col) if repeat else F.lit(0).cast("long")
    rows = documents.select(own.alias("id"), tag.alias("t"), text_col).filter("id is not null")
    marks = keep(repeated_spans(rows, min_words).groupBy("id", "t").agg(F.collect_set(F.struct("first", "sentences")).alias("marks")), "marks")
    added = ("n_sentences", "n_removed", "removed_chars")
    others = [c for c in documents.columns if c not in (*added, text_col)]
    names = [f"_c{i}" for i in range(len(others))]
    base = documents.select(*[F.col(c).alias(n) for c, n in zip(others, names, strict=True)], F.col(text_col).alias("_text"), own.alias("_id"), tag.alias("_t"))
    joined = base.join(marks.withColumnsRenamed({"id": "_id", "t": "_t"}), ["_id", "_t"], "left")
    starts, counts = F.transform("marks", lambda m: m["first"]), F.transform("marks", lambda m: m["sentences"])
    ready = joined.select(*names, "_text", starts.alias("_first"), counts.alias("_many"))

    def run(batches):
        for b in batches:
            text = b.column("_text")
            firsts, many = b.column("_first"), b.column("_many")
            new, total, gone, chars = [], [], [], []
            for piece in texts(text):
                begin, row = sentences(piece)
                at = np.searchsorted(row, np.arange(len(piece) + 1))
                raw = piece.raw.tobytes()
                for i in range(len(piece)):
                    j = piece.first + i
                    n = int(at[i + 1] - at[i])
                    total.append(n)
                    if not firsts[j].is_valid:
                        new.append(text[j].as_py())
                        gone.append(0)
                        chars.append(0)
                        continue
                    cut = np.zeros(n + 1, dtype=np.int64)
                    f, m = np.array(firsts[j].as_py()), np.array(many[j].as_py())
                    np.add.at(cut, f, 1)
                    np.add.at(cut, f + m, -1)
                    removed = np.cumsum(cut[:-1]) > 0
                    borders = np.append(begin[at[i] : at[i + 1]], piece.starts[i + 1])
                    keep_parts = [raw[piece.starts[i] : borders[0]]] + [raw[borders[s] : borders[s + 1]] for s in np.flatnonzero(~removed)]
                    out = b"".join(keep_parts).decode()
                    new.append(out)
                    gone.append(int(removed.sum()))
                    chars.append(len(raw[piece.starts[i] : piece.starts[i + 1]].decode()) - len(out))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(new, pa.string()), pa.array(total, pa.int32()), pa.array(gone, pa.int32()), pa.array(chars, pa.int64())], [*names, "_text", *added])

    kinds = ", ".join(f"{n} {documents.schema[c].dataType.simpleString()}" for c, n in zip(others, names, strict=True))
    out = ready.mapInArrow(run, f"{kinds}, _text string, n_sentences int, n_removed int, removed_chars long")
    back = {c: n for c, n in zip(others, names, strict=True)} | {text_col: "_text"}
    return out.select(*[F.col(back[c]).alias(c) for c in documents.columns if c in back], *added)
