"""Chunking (K1-K9, G14): token-budget pieces with overlap. Splitting is sequential by nature, so it is an Arrow UDF."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import fixed as V

SIZE, OVERLAP, LEAST, MOST = 800, 0.15, 512, 1024


def token_length(t: Column) -> Column:
    """K2. Without an encoder: a quarter of the characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(t) / 4)).cast("int")


def estimate(text: str) -> int:
    return max(1, len(text) // 4)


COUNTERS: dict = {}


def counter_of(tokenizer: str | None) -> Callable[[str], int]:
    """K2. What counts tokens: the byte-pair encoder in a file (JSON of the tokenizers library), kept by the worker from task
    to task, or, without one, estimate."""
    if tokenizer is None:
        return estimate
    if tokenizer not in COUNTERS:
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True
        COUNTERS[tokenizer] = lambda text: len(encoder.encode(text, add_special_tokens=False).ids)
    return COUNTERS[tokenizer]


def split_recursive(text: str, size: int, overlap: int, length: Callable[[str], int] = estimate, separators=tuple(V.SEPARATORS)) -> list[str]:
    """K3. Splits at the coarsest separator there is, which stays at the head of the next piece; joins pieces up to size,
    carrying up to overlap over; splits what is too long at finer ones, and keeps what has none."""
    sep, finer = separators[-1], ()
    for k, s in enumerate(separators):
        if s in text:
            sep, finer = s, separators[k + 1 :]
            break
    head, *rest = text.split(sep)
    parts = [p for p in [head, *(sep + r for r in rest)] if p]
    sizes = list(map(length, parts))
    gap, out = length(""), []
    for short, run in itertools.groupby(range(len(parts)), lambda k: sizes[k] < size):
        ks = list(run)
        if short:
            out += _merged(parts, sizes, ks, size, overlap, gap)
            continue
        for k in ks:
            out += split_recursive(parts[k], size, overlap, length, finer) if finer else [parts[k].strip()]
    return [x for x in out if x]


def _merged(parts: list[str], sizes: list[int], ks: list[int], size: int, overlap: int, gap: int) -> list[str]:
    """Windows over consecutive parts: each is as long as fits size and starts where at most overlap is carried over."""
    out, first, total = [], ks[0], 0
    for k in ks:
        n = sizes[k]
        if k > first and total + n + gap > size:
            out.append("".join(parts[first:k]).strip())
            while first < k and (total > overlap or total + n + gap > size):
                total -= sizes[first] + (gap if k - first > 1 else 0)
                first += 1
        total += n + (gap if k > first else 0)
    out.append("".join(parts[first : ks[-1] + 1]).strip())
    return out


_PARAGRAPH, _GAP, _BLANKS = re.compile(r"\n\s*\n"), re.compile(V.SENTENCE), re.compile(r"[ \t]{2,}")


def aligned_tail(previous: str, current: str, budget: int, length: Callable[[str], int] = estimate) -> str:
    """K5. What of the previous chunk goes before the current one: from the earliest sentence or paragraph start in its
    last budget * 6 characters; if that is over twice the budget, from the last sentence start that leaves no more than
    1.2 budgets, if there is one."""
    base = max(0, len(previous) - budget * 6)
    sentences = [m.start() for m in _GAP.finditer(previous, base)]
    starts = sentences + [m.end() for m in _PARAGRAPH.finditer(previous, base)]
    if not starts:
        return ""
    span = previous[min(starts) :].strip()
    if length(span) > 2 * budget:
        span = next((s for c in reversed(sentences) if length(s := previous[c:].strip()) <= 1.2 * budget), span)
    return "" if not span or span in current else span


def is_row(line: str) -> bool:
    return line.count("|") >= 2


def flatten(text: str) -> str:
    """K6. Lines of text joined by spaces, and so are tables, but for the lines inside them, which stay lines."""
    parts = []
    for rows, run in itertools.groupby(text.split("\n"), lambda x: "row" if is_row(x) else "text" if x.strip() else "blank"):
        lines = [x.strip() for x in run]
        if rows == "row":
            parts.append("\n".join(lines))
        elif rows == "text":
            parts.append(_BLANKS.sub(" ", " ".join(lines)))
    return " ".join(parts)


def chunks(df: DataFrame, id_col: str = "source_file", text_col: str = "text", size: int = SIZE, overlap: float = OVERLAP, tokenizer: str | None = None) -> DataFrame:
    """K1-K6. One row per chunk: id_col, chunk_index, tokens, chars, overlap_prev_tokens, text. Math, tables and quantities
    are whole while splitting. tokenizer: a byte-pair encoder's file, for lengths in its tokens. Documents are independent:
    nothing is shuffled."""
    C.small_batches(df.sparkSession)
    budget = int(size * overlap)

    @F.pandas_udf("array<struct<chunk_index:int,tokens:int,chars:int,overlap_prev_tokens:int,text:string>>")
    def cut(texts: pd.Series, blocks: pd.Series) -> pd.Series:
        count = counter_of(tokenizer)
        marker = re.compile(f"{C.OPEN}(\\d+){C.CLOSE}")

        def one(text, held):
            back = lambda s: marker.sub(lambda m: back(held[int(m[1])]["content"]), s) if C.OPEN in s else s
            raw = [p for x in split_recursive(text or "", size, budget, lambda s: count(back(s))) if (p := back(x).strip())]
            out = []
            for k, p in enumerate(raw):
                span = aligned_tail(raw[k - 1], p, budget, count) if k and budget else ""
                whole = flatten(f"{span} {p}" if span else p)
                if whole:
                    out.append((len(out), count(whole), len(whole), count(span) if span else 0, whole))
            return out

        return pd.Series([one(t, b) for t, b in zip(texts, blocks)])

    kept = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), C.no_blocks().alias("b"))
    for pattern, kind, block in ((V.DISPLAY_MATH, "display_math", True), (V.INLINE_MATH, "inline_math", False), (V.TABLE, "markdown_table", True), (C.NUMUNIT, "numunit", False)):
        t, b = C.protect(F.col("t"), F.col("b"), pattern, kind, block)
        kept = kept.select("id", t.alias("t"), b.alias("b"))
    return kept.select(F.col("id").alias(id_col), F.explode(cut("t", "b")).alias("c")).select(id_col, "c.*")


def window_chunks(text: str, size: int = 1400, overlap: int = 200) -> list[str]:
    """G14. Windows of characters, cut at the last paragraph, line, sentence or space beyond their half."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + size)
        if end < len(text):
            for sep in ("\n\n", "\n", ". ", " "):
                k = text.rfind(sep, at, end)
                if k > at + size // 2:
                    end = k + len(sep)
                    break
        if piece := text[at:end].strip():
            out.append(piece)
        if end >= len(text):
            break
        at = max(end - overlap, at + 1)
    return out


def char_chunks(df: DataFrame, id_col: str, text_col: str, size: int = 1400, overlap: int = 200) -> DataFrame:
    C.small_batches(df.sparkSession)

    @F.pandas_udf("array<string>")
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda x: window_chunks(x or "", size, overlap))

    return df.select(id_col, F.posexplode(cut(F.col(text_col))).alias("chunk_index", "text"))


@F.pandas_udf(T.StringType())
def flattened(s: pd.Series) -> pd.Series:
    """K6 over a column."""
    return s.map(lambda x: flatten(x or ""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def paragraphs(s: pd.Series) -> pd.Series:
    """K7. What blank lines divide, each flattened."""
    return s.map(lambda x: [f for p in _PARAGRAPH.split(x or "") if (f := flatten(p))])


def sentences(t: Column) -> Column:
    """K7. Sentences of 20 characters or more of a flat text."""
    return F.filter(F.transform(F.split(t, V.SENTENCE), C.strip), lambda s: F.length(s) >= 20)


def formulas(t: Column) -> Column:
    return F.regexp_extract_all(t, F.lit(f"{V.DISPLAY_MATH}|{V.INLINE_MATH}"), F.lit(0))


def broken(docs: DataFrame, chunked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """K7, K8. Per document, its sentences, paragraphs and formulas, and how many of each no chunk holds whole."""
    per = chunked.groupBy(id_col).agg(F.collect_list("text").alias("texts"))
    flat = F.transform(formulas(F.col(text_col)), lambda f: C.strip(F.regexp_replace(F.regexp_replace(f, r"[^\S\n]*\n\s*", " "), r"[ \t]{2,}", " ")))
    s = docs.select(id_col, sentences(flattened(F.col(text_col))).alias("sentences"), paragraphs(F.col(text_col)).alias("paragraphs"), flat.alias("formulas"))
    lost = lambda c: F.size(F.filter(c, lambda x: ~F.exists("texts", lambda t: t.contains(x))))
    s = s.join(per, id_col, "left").withColumn("texts", F.coalesce("texts", F.expr("cast(array() as array<string>)")))
    return s.select(id_col, *[x for c in ("sentences", "paragraphs", "formulas") for x in (F.size(c).alias(c), lost(c).alias(f"broken_{c}"))])


def broken_sentences(docs: DataFrame, chunked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """K8. Per document, its sentences and how many of them no chunk holds whole."""
    return broken(docs, chunked, id_col, text_col).select(id_col, "sentences", F.col("broken_sentences").alias("broken"))


def size_stats(chunked: DataFrame) -> DataFrame:
    """K9, A4, A5. Counts, mean, deviation and share of overlap of all chunks."""
    return chunked.agg(
        F.count("*").alias("chunks"), F.sum("tokens").alias("tokens"), F.round(F.avg("tokens"), 4).alias("mean"), F.round(F.stddev_pop("tokens"), 4).alias("std"),
        F.count_if(F.col("tokens") > MOST).alias("oversized"), F.count_if(F.col("tokens") < LEAST).alias("undersized"),
        F.round(F.try_divide(F.sum("overlap_prev_tokens"), F.sum("tokens")), 4).alias("overlap_ratio"),
    )

