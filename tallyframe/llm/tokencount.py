"""Token counts of fields or sections from one encoding of each whole document.

A document is encoded once. The lengths of its tokens give each token's span, and an interval join
of these spans with the sections' spans (both are sorted, so it is a search in the sections'
starts) gives each section its tokens. Counting sections one by one would encode them without
their neighbours and get other tokens at each border.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

RULES = ("first", "last", "largest")
END = "<|endoftext|>"
#: Runs of characters with Unicode's property White_Space that the encoder's own splitting could not hold on its stack.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{20000,}")


@lru_cache(maxsize=4)
def encoder(ranks_file: str, end: str = END):
    """The byte-level BPE of a ranks file and the byte length of each of its tokens; end is the special token that follows the ranks."""
    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    top = max(ranks.values()) + 1
    lengths = np.zeros(top + 1, dtype=np.int64)
    for piece, rank in ranks.items():
        lengths[rank] = len(piece)
    lengths[top] = len(end)
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={end: top}), lengths


def encode(encoding, text: str, end: str = END) -> np.ndarray:
    """The ids of a whole text; the special token's string in it is that token.

    A long run of white space is one word of the encoder's pattern, but for its last character where
    something other than the special token follows: that begins the next word. So the run is encoded
    by itself, without the pattern.
    """
    parts, at = [], 0
    for m in _LONG_SPACE.finditer(text) if len(text) >= 20_000 else ():
        stop = m.end() if m.end() == len(text) or text.startswith(end, m.end()) else m.end() - 1
        parts.append(encoding.encode_to_numpy(text[at : m.start()], allowed_special="all"))
        parts.append(np.array(encoding._encode_single_piece(text[m.start() : stop]), dtype=np.uint32))
        at = stop
    parts.append(encoding.encode_to_numpy(text[at:], allowed_special="all"))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def attribute(text: str, section_starts: np.ndarray, encoding, lengths: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section of text; section_starts: byte offsets in rising order, the first 0, each section ending where the next begins."""
    ids = encode(encoding, text)
    end = np.cumsum(lengths[ids])
    start = end - lengths[ids]
    first = np.searchsorted(section_starts, start, side="right") - 1
    last = np.searchsorted(section_starts, end - 1, side="right") - 1
    owner = first
    if rule == "last":
        owner = last
    elif rule == "largest":
        borders = np.append(section_starts, end[-1] if len(end) else 0)
        owner = first.copy()
        for t in np.flatnonzero(first != last):
            s = np.arange(first[t], last[t] + 1)
            part = np.minimum(borders[s + 1], end[t]) - np.maximum(borders[s], start[t])
            owner[t] = s[np.argmax(part)]
    return np.bincount(owner, minlength=len(section_starts))


def section_tokens(documents: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text", rule: str = "first") -> DataFrame:
    """doc_id, section (from 0), start and length in characters, tokens: the lines of each text, each with the line feed that ends it, and the tokens they own.

    A token that crosses a border belongs to the section with its first byte (rule first), its last
    byte (last) or the most of its bytes (largest; ties to the earlier), so the counts of a document
    add up to the tokens of its whole text. A null or empty text is one empty section without
    tokens. Texts are never cut; a text that ends in a line feed has no empty section after it.
    Repeated ids are counted row by row; further columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")

    def run(batches):
        encoding, lengths = encoder(ranks_file)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            doc, number, begin, size, tokens = [], [], [], [], []

            def out():
                return pa.RecordBatch.from_arrays([pa.array(doc, b.schema.field(0).type), pa.array(number, pa.int32()), pa.array(begin, pa.int64()), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())], [id_col, "section", "start", "length", "tokens"])

            for i, text in zip(ids, texts, strict=True):
                raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
                starts = np.append(0, np.flatnonzero(raw == 10) + 1)
                if len(starts) > 1 and starts[-1] == len(raw):
                    starts = starts[:-1]
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                at = chars[np.append(starts, len(raw))]
                doc += [i] * len(starts)
                number += range(len(starts))
                begin += at[:-1].tolist()
                size += np.diff(at).tolist()
                tokens += attribute(text or "", starts, encoding, lengths, rule).tolist()
                if len(doc) > 50_000:
                    yield out()
                    doc, number, begin, size, tokens = [], [], [], [], []
            yield out()

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, section int, start long, length long, tokens long")
