"""Benchmark decontamination by spaced-seed hashing, in built-in functions only.

A seed is a hash of the tokens that a mask keeps of a window of consecutive tokens; the positions
that it ignores may differ. The benchmark's seeds join the documents' seeds. Each hit aligns an item
with a document, and the item's tokens are compared with the document's along all its alignments,
so replaced words cost only themselves, and inserted or left out ones start another alignment.

All masks keep a window's first and last token. A bitmap of the benchmark's pairs of such tokens
drops most windows of the documents before any seed is made; it lets no true one go. Its size
follows the benchmark up to a bound, beyond which it is left out and all seeds are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import keep, let, small

#: Kept positions of windows of SPAN tokens: a run of three replaced words leaves one of the first three whole in most
#: places; the last two ignore each fourth and each third position, so words replaced that often leave them whole.
MASKS = ((0, 1, 2, 4, 7), (0, 2, 3, 5, 7), (0, 3, 5, 6, 7), (0, 2, 3, 4, 6, 7), (0, 1, 3, 4, 6, 7))
SPAN = 8
MIN_OVERLAP = 0.5
MIN_RUN = 6
MAX_BITMAP_WORDS = 4096
BROADCAST_ROWS = 2_000_000
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def tokens(text: Column) -> Column:
    """Hashes of the words of a text in lower case: runs of ASCII letters and digits and of all other characters beyond ASCII."""
    return F.transform(F.filter(F.split(F.lower(text), _BREAK, -1), lambda w: w != ""), lambda w: F.xxhash64(w))


def _bit(h: Column, i: Column, words: int) -> tuple[Column, Column]:
    """Word and bit of the pair of the window at i."""
    a, b = F.get(h, i), F.get(h, i + (SPAN - 1))
    both = a.bitwiseXOR(F.shiftleft(b, 1))
    return F.shiftrightunsigned(both, 20).bitwiseAND(F.lit(words - 1)).cast("int"), both.bitwiseAND(F.lit(63)).cast("int")


def _starts(h: Column) -> Column:
    return F.when(F.size(h) >= SPAN, F.sequence(F.lit(0), F.size(h) - SPAN))


def _bitmap(items: DataFrame) -> tuple[int, str] | None:
    """Number of words and the words of a bitmap of the items' pairs, or None if it would be too large."""
    pairs = items.select("h", F.explode(_starts(F.col("h"))).alias("i"))
    need = pairs.count()
    words = 64
    while words * 64 < 16 * need and words < MAX_BITMAP_WORDS:
        words *= 2
    if 2 * need > words * 64:
        return None
    word, bit = _bit(F.col("h"), F.col("i"), words)
    rows = pairs.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
    have = {r.word: r.bits for r in rows}
    return words, ",".join(str(have.get(w, 0)) for w in range(words))


def _seeds(h: Column, places: Column) -> Column:
    """array of struct(at, mask, seed) for the windows at these places."""

    def by(k: int, mask: tuple[int, ...]) -> Column:
        return F.transform(places, lambda i: F.struct(i.alias("at"), F.lit(k).alias("mask"), F.xxhash64(*[F.get(h, i + o) for o in mask]).alias("seed")))

    return F.flatten(F.array(*[by(k, mask) for k, mask in enumerate(MASKS)]))


def contaminated(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """doc_id, item_id, item_tokens, matched_tokens, overlap for each document that holds at least min_overlap of an item.

    Tokens are words in lower case. An item token counts as matched if the document has it at its
    place in some alignment that a seed hit, so somewhere a whole window must meet a mask, and on which MIN_RUN tokens (or all, of a shorter item) are equal. Items of
    fewer than SPAN tokens have no seeds and are not looked for; null and empty texts hold and match
    nothing. Documents and items may repeat: ids are expected to be unique, rows with equal ids and
    different texts are compared one by one and the best overlap counts. Rows with null ids are
    left out. Further columns are not read.
    """
    spark = documents.sparkSession
    items = keep(benchmark.select(F.col(item_col).alias("item"), tokens(F.col(item_text_col)).alias("h")).filter(f"item is not null and size(h) >= {SPAN}"), "items")
    docs = documents.select(F.col(id_col).alias("doc"), F.col(text_col).alias("t")).filter("doc is not null and t is not null")
    item_seeds = items.select("item", F.explode(_seeds(F.col("h"), _starts(F.col("h")))).alias("s")).select("item", F.col("s.at").alias("item_at"), "s.mask", "s.seed")
    item_seeds = small(keep(item_seeds, "item_seeds"), BROADCAST_ROWS)
    marked = lambda h, i: F.lit(True)
    if made := _bitmap(items):
        words, text = made
        bits = F.split(F.lit(text), ",").cast("array<bigint>")

        def marked(h: Column, i: Column) -> Column:
            word, bit = _bit(h, i, words)
            return F.getbit(F.get(bits, word), bit) == 1

    # All in one expression, and the outer explode: Spark would move a filter on its result, even one it infers, below it and compute it twice.
    seeds = let(tokens(F.col("t")), lambda h: let(F.filter(_starts(h), lambda i: marked(h, i)), lambda places: _seeds(h, places)))
    found = docs.select("doc", F.explode_outer(seeds).alias("s")).filter("s is not null")
    hits = found.select("doc", "s.at", "s.mask", "s.seed").join(item_seeds, ["mask", "seed"]).select("doc", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    hits = keep(hits.groupBy("doc", "item").agg(F.collect_set("shift").alias("shifts")), "hits")
    hit_docs = small(hits.select("doc").distinct(), BROADCAST_ROWS)
    sets = docs.join(hit_docs, "doc", "left_semi").select("doc", tokens(F.col("t")).alias("h"))
    both = hits.join(small(items.select("item", F.col("h").alias("want")), BROADCAST_ROWS // 20), "item").join(sets, "doc")
    line = lambda s: F.transform("want", lambda w, j: F.coalesce(F.when(s + j >= 0, F.get(F.col("h"), s + j)) == w, F.lit(False)))
    lines = F.filter(F.transform("shifts", line), lambda a: F.size(F.filter(a, lambda x: x)) >= F.least(F.lit(MIN_RUN), F.size("want")))
    matched = let(lines, lambda all_lines: F.size(F.filter(F.sequence(F.lit(0), F.size("want") - 1), lambda j: F.exists(all_lines, lambda a: F.get(a, j)))))
    out = both.select("doc", "item", F.size("want").alias("item_tokens"), matched.alias("matched_tokens")).withColumn("overlap", F.col("matched_tokens") / F.col("item_tokens")).filter(F.col("overlap") >= min_overlap)
    out = out.groupBy("doc", "item").agg(F.max_by(F.struct("item_tokens", "matched_tokens", "overlap"), "overlap").alias("best")).select("doc", "item", "best.*")
    return out.withColumnsRenamed({"doc": id_col, "item": item_col if item_col != id_col else "item"})


def clean(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **named) -> DataFrame:
    """documents without those that hold benchmark items; rows with a null id stay."""
    bad = contaminated(documents, benchmark, id_col, **named).select(F.col(id_col).alias("_bad")).distinct()
    return documents.join(bad, F.col(id_col) == F.col("_bad"), "left_anti")
