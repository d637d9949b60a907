"""Packing (operator 3): best-fit decreasing over windows of token ids.

A document's ids are those of the tokenizer plus the end id. Overlong documents are first cut into full
windows; the rests, longest first, each go to the tightest window that still has room, found by a segment
tree indexed by remaining capacity. Pieces are dealt by a hash into groups of bounded size,
each packed by one task from (id, start, length) alone; only those few numbers are shuffled, never ids.

Defined results: a null text is empty (its document is the end id alone); null ids of documents, repeated rows
and equal ids are packed as rows of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW, END_ID, DOCS_PER_GROUP = 4096, 2, 4096
#: Text of these characters only is lower-cased and cut at white space alike by Python and by the tokenizer.
UNSAFE = re.compile("[^\t-\r -~¡-¬®-įı-ſ]")

#: How the tokenizer cuts a word (fixed value).
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


ENCODERS: dict = {}


class WordEncoder:
    """Ids of whole texts. This tokenizer's pieces never cross white space, so a text's ids are its words' ids in
    a row; words are looked up in a bounded memory and new ones are encoded by the tokenizer itself. Texts with
    characters that UNSAFE finds, or with what may be a special token, go to it whole."""

    def __init__(self, path: str, most_words: int = 700_000):
        common.env_single_thread()
        from tokenizers import Tokenizer

        self.tok, self.known, self.most = Tokenizer.from_file(path), {}, most_words
        self.older: dict[str, bytes] = {}
        self.last = np.zeros(self.tok.get_vocab_size() + 1, bool)
        self.last[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True

    def _ids_of(self, new: list[str]) -> dict[str, bytes]:
        """Ids of words, by one call over all in a row: each of a word's pre-tokens ends in exactly one piece that
        ends a word, so the pieces are dealt out by counting those. If the counts don't agree, word by word."""
        ids = np.asarray(self.tok.encode(" ".join(new), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        count = np.cumsum([1 if w.isalpha() else len(PRE_TOKEN.findall(w)) for w in new])
        if len(ends) != count[-1] or (np.diff(count, prepend=0) == 0).any():
            return {w: np.asarray(e.ids, "<u4").tobytes() for w, e in zip(new, self.tok.encode_batch(new, add_special_tokens=False))}
        raw, cut = ids.tobytes(), (ends[count - 1] * 4).tolist()
        return {w: raw[s:e] for w, s, e in zip(new, [0, *cut], cut)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        whole = [bool(t) and (UNSAFE.search(t) is not None or "<|" in t) for t in texts]
        words = [t.lower().split() if t and not odd else [] for t, odd in zip(texts, whole)]
        new = set().union(*words).difference(self.known)
        if len(self.known) + len(new) > self.most:  # what is used again comes back from the older half
            self.older, self.known = self.known, {}
            new = set().union(*words)
        known, old = self.known, self.older
        known.update((w, old[w]) for w in new.intersection(old))
        new = sorted(new.difference(old))
        for i in range(0, len(new), 500):
            known.update(self._ids_of(new[i : i + 500]))
        return [np.asarray(self.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if odd else b"".join([known[w] for w in ws]) for t, odd, ws in zip(texts, whole, words)]


def pieces(batches, path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, length, ids_crc32, doc_tokens) of each document's full windows and rest."""
    if path not in ENCODERS:  # a worker keeps its memory of words from task to task
        ENCODERS.clear()
        ENCODERS[path] = WordEncoder(path)
    enc, end = ENCODERS[path], np.uint32(end_id).astype("<u4").tobytes()
    for b in common.slices(batches):
        ids, start, length, crc, total = [], [], [], [], []
        for d, raw in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist())):
            raw += end
            n = len(raw) // 4
            for at in range(0, n, window):
                part = raw[at * 4 : (at + window) * 4]
                ids.append(d), start.append(at), length.append(len(part) // 4), crc.append(zlib.crc32(part)), total.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, start, length, crc, total)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])


class OpenWindows:
    """Segment tree over remaining capacities 0..window: how many open windows have each."""

    def __init__(self, window: int):
        self.half = 1 << (window + 1).bit_length()
        self.count = [0] * (2 * self.half)
        self.held: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, ident: int) -> None:
        self.held[room].append(ident)
        i = room + self.half
        while i:
            self.count[i] += 1
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least need that some window has."""
        count, i = self.count, need + self.half
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.half:
                i = 2 * i if count[2 * i] else 2 * i + 1
        return i - self.half

    def take(self, room: int) -> int:
        i = room + self.half
        while i:
            self.count[i] -= 1
            i >>= 1
        return self.held[room].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """For lengths in falling order: each one's window number and offset there."""
    tree, made, seq, off = OpenWindows(window), 0, [], []
    for n in lengths:
        room = tree.tightest(n)
        if room is None:
            ident, room, made = made, window, made + 1
        else:
            ident = tree.take(room)
        seq.append(ident), off.append(window - room)
        if room > n:
            tree.add(room - n, ident)
    return seq, off


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Groups hold the pieces of about docs_per_group documents each (their number follows the table's row count, which Parquet
    has at hand), so the window that each group leaves partly open wastes a small share at any size.
    """
    groups = common.pages_of(docs.count(), docs_per_group)
    cut = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        lambda it: pieces(it, tokenizer_path, window, end_id), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    )
    cut = cut.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.isnull("doc_id").alias("no_id"), "start", "length", "ids_crc32", "doc_tokens")
    cut = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        seq, off = best_fit(pdf["length"].tolist(), window)
        pdf["sequence_id"] = (pdf["grp"].to_numpy(np.int64) << 32) + np.asarray(seq, np.int64)
        pdf["offset"] = np.asarray(off, np.int64)
        return pdf.drop(columns="grp")

    out = cut.groupBy("grp").applyInPandas(one, "doc_id long, no_id boolean, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
