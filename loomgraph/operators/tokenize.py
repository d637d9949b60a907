"""Tokenization (T1-T13): tables, formulas, quantities and terms to markers, sentences, tokens, vocabulary checks. Native, but
for an encoder's pieces (Arrow UDFs); formulas' trees are a plug-in."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import fixed as V


def _both(x: Column) -> tuple[Column, Column]:
    return x["text"], x["found"]


def masked(text: Column, pattern: str, name: str, first: Column | None = None) -> Column:
    """T3, T4. Matches to `[NAME_i]`; struct<text, found>."""
    first = F.lit(0) if first is None else first
    marked = lambda ps: C.joined(ps, lambda m, i: F.concat(F.lit(f"[{name}_"), (first + i).cast("string"), F.lit("]")))
    return C.bind(text, lambda t: C.bind(C.parts(t, pattern), lambda ps: F.struct(F.when(F.size(ps) > 1, marked(ps)).otherwise(t).alias("text"), C.matches(ps).alias("found"))))


def mask(text: Column, pattern: str, name: str, first: Column | None = None) -> tuple[Column, Column]:
    """T3, T4. Matches to `[NAME_i]`; (text, matches)."""
    return _both(masked(text, pattern, name, first))


def terms_in_order(terms) -> list[str]:
    """Longest first, and in their given order among equals."""
    return [t for _, _, t in sorted((-len(t), k, t) for k, t in enumerate(dict.fromkeys(terms)))]


def masked_terms(text: Column, terms=tuple(V.TERMS)) -> Column:
    """T5. Terms to `[ABBREV_i]`, one after the other, numbered by term and then by place; struct<text, found>. One pass finds
    them all: longer terms come first in the alternation, so each place has the term that masks it."""
    names = terms_in_order(terms)
    none = F.expr("cast(array() as array<string>)")
    if not names:
        return F.struct(text.alias("text"), none.alias("found"))
    pattern = rf"{C.firsts(names)}(?U)(?<![\w-])(?:{'|'.join(C.java(t) for t in names)})(?![\w-])"
    ranks = {t: k for k, t in enumerate(names)}
    ranked = lambda ps: F.sort_array(F.transform(C.matches(ps), lambda t, i: F.struct(C.lookup(ranks, t).alias("k"), i.alias("i"), t.alias("t"))))
    # places in the order of their numbers, turned into the numbers in the order of their places
    numbers = lambda r: F.transform(F.sort_array(F.transform(r, lambda x, n: F.struct(x["i"].alias("i"), n.alias("n")))), lambda x: x["n"])

    def marked(ps, r):
        text = C.bind(numbers(r), lambda number: C.joined(ps, lambda m, i: F.concat(F.lit("[ABBREV_"), F.element_at(number, i + 1).cast("string"), F.lit("]"))))
        return F.struct(text.alias("text"), F.transform(r, lambda x: x["t"]).alias("found"))

    def done(t):
        return C.bind(C.parts(t, pattern), lambda ps: F.when(F.size(ps) > 1, C.bind(ranked(ps), lambda r: marked(ps, r))).otherwise(F.struct(t.alias("text"), F.when(t.isNotNull(), none).alias("found"))))

    return C.bind(text, done)


def mask_terms(text: Column, terms=tuple(V.TERMS)) -> tuple[Column, Column]:
    """T5. (text, terms in the order of their numbers)."""
    return _both(masked_terms(text, terms))


def tables_apart(text: Column) -> Column:
    """T1. Blocks of two or more rows to `[TABLE_i]`; a blank line ends a block; other lines are stripped, blank ones go; text
    outside the outer pipes becomes lines of its own. struct<text, found>."""
    before, after = r"(?md)^([^\S\n]*+[^|\s][^|\n]*+)(?=\|[^|\n]*+\|)", r"(?md)(\|[^|\n]*+\|)([^\S\n]*+[^|\s][^|\n]*+)$"
    apart = lambda t: F.regexp_replace(F.regexp_replace(t, before, "$1\n"), after, "$1\n$2")
    lines = F.array_join(F.transform(F.split(C.bind(text, lambda t: F.when(t.contains("|"), apart(t)).otherwise(t)), "\n", -1), C.strip), "\n")
    pattern = r"(?md)(?:^[^|\n]*+\|[^|\n]*+\|[^\n]*+(?:\n|\z)){2,}+"

    def done(t):
        marked = F.when(t.contains("|"), C.rewrite(t, pattern, lambda m, i: F.concat(F.lit("[TABLE_"), i.cast("string"), F.lit("]\n")))).otherwise(t)
        found = F.when(t.contains("|"), F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), C.strip)).otherwise(F.expr("cast(array() as array<string>)"))
        return F.struct(F.btrim(F.regexp_replace(marked, "\n{2,}", "\n"), F.lit("\n")).alias("text"), found.alias("found"))

    return C.bind(lines, done)


def extract_tables(text: Column) -> tuple[Column, Column]:
    """T1. (text, tables)."""
    return _both(tables_apart(text))


def global_index(df: DataFrame, id_col: str, order_col: str, count_col: str) -> DataFrame:
    """T2. first_table: how many tables the chunks before this one have."""
    w = Window.partitionBy(id_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("first_table", F.coalesce(F.sum(count_col).over(w), F.lit(0)))


def sentences(text: Column) -> Column:
    """T6. Initials don't end a sentence."""
    return F.filter(F.split(text, rf"(?=\s){V.SENTENCE_SAFE}"), lambda s: s != "")


def words(text: Column) -> Column:
    """T7, T8. Markers whole, words and numbers."""
    return F.regexp_extract_all(text, F.lit(f"{V.SPECIAL}|{V.WORD}"), F.lit(0))


def bare_formula(f: Column) -> Column:
    """T10."""
    two = f.startswith("$$") | f.startswith("\\[") | f.startswith("\\(")
    n = F.when(two, 2).otherwise(1)
    return C.strip(F.substring(f, n + 1, F.length(f) - 2 * n))


def formula_tokens(f: Column, mode: str = "latex_aware", tree: Callable[[Column], Column] | None = None) -> Column:
    """T9. single: null; latex_aware: commands, names, numbers, signs; ast: the plug-in's node names in preorder, null where
    it has none or there is no plug-in; another mode is an error."""
    if mode not in ("single", "latex_aware", "ast"):
        raise ValueError(f"no such mode of formula tokens: {mode}")
    if mode == "latex_aware":
        return F.regexp_extract_all(bare_formula(f), F.lit(V.LATEX), F.lit(0))
    none = F.lit(None).cast("array<string>")
    return none if mode == "single" or tree is None else tree(bare_formula(f))


class Pieces:
    """T8. An encoder from a file (JSON of the tokenizers library): a text's pieces, and what they decode to."""

    KNOWN: dict = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder, self.names = Tokenizer.from_file(path), {}
        self.encoder.encode_special_tokens = True

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls.KNOWN:  # a worker keeps it from task to task
            cls.KNOWN[path] = cls(path)
        return cls.KNOWN[path]

    def ids(self, text: str) -> list[int]:
        return self.encoder.encode(text, add_special_tokens=False).ids

    def name(self, i: int) -> str:
        if i not in self.names:
            self.names[i] = self.encoder.decode([i], skip_special_tokens=False)
        return self.names[i]

    def __call__(self, sentence: str) -> tuple[list[str], str]:
        """Pieces of a sentence, its markers whole, and the sentence put together again from them."""
        out, back, at = [], [], 0
        for m in [*re.finditer(V.SPECIAL, sentence), None]:
            plain = sentence[at : m.start() if m else len(sentence)]
            ids = self.ids(plain) if plain.strip() else []
            out += map(self.name, ids)
            back.append(self.encoder.decode(ids, skip_special_tokens=False) if ids else plain)
            if m:
                out.append(m[0]), back.append(m[0])
                at = m.end()
        return out, "".join(back)


def pieces(sentences_col: Column, tokenizer: str) -> Column:
    """T7, T8. struct<tokens, back> of sentences by an encoder: their pieces, and the sentences decoded again."""
    @F.pandas_udf(T.StructType([T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("back", T.ArrayType(T.StringType()))]))
    def run(s: pd.Series) -> pd.DataFrame:
        of = Pieces.of(tokenizer)
        rows = [list(map(of, x)) for x in s]
        return pd.DataFrame({"tokens": [[t for ts, _ in r for t in ts] for r in rows], "back": [[b for _, b in r] for r in rows]})

    return run(sentences_col)


def unmask(text: Column, name: str, items: Column) -> Column:
    """T11. Markers of one kind back to their text, all in one pass; unknown ones stay."""
    back = lambda t: C.rewrite(t, rf"\[{name}_\d+\]", lambda m, _: F.coalesce(F.try_element_at(items, F.regexp_extract(m, r"\d+", 0).cast("int") + 1), m))
    return C.bind(text, lambda t: F.when(t.contains(f"[{name}_"), back(t)).otherwise(t))


def tokenize(chunked: DataFrame, id_col: str = "source_file", terms=tuple(V.TERMS), formula_mode: str = "latex_aware", tree=None, tokenizer: str | None = None) -> DataFrame:
    """T1-T12. id_col, chunk_index, tokens, token_count, sentences, the four registries, round_trip. Words are tokens, or an
    encoder's pieces where tokenizer names its file; a formula's tokens take the place of its marker."""
    def step(df, mark, col):
        """Text and matches come of one struct, made in a projection of its own, else each of them would be made anew."""
        kept = [c for c in df.columns if c != "m"]
        return df.select(*kept, mark(F.col("m")).alias("x")).select(*kept, F.col("x.text").alias("m"), F.col("x.found").alias(col))

    df = chunked.select(id_col, "chunk_index", "text", F.col("text").alias("m"))
    df = step(df, tables_apart, "tables")
    df = step(df, lambda t: masked(t, C.MATH_SIGN + f"(?:{V.DISPLAY_MATH})", "FORMULA"), "display")
    df = step(df, lambda t: masked(t, C.MATH_SIGN + f"(?:{V.INLINE_MATH})", "FORMULA", F.size("display")), "inline")
    df = df.withColumn("formulas", F.concat("display", "inline")).drop("display", "inline")
    df = step(df, lambda t: masked(t, C.NUMUNIT, "NUMUNIT"), "numunits")
    df = step(df, lambda t: masked_terms(t, terms), "abbreviations")
    df = global_index(df.withColumn("n_tables", F.size("tables")), id_col, "chunk_index", "n_tables")
    df = df.withColumn("sentences", sentences(F.col("m"))).withColumn("formula_tokens", F.transform("formulas", lambda f: formula_tokens(f, formula_mode, tree)))
    if tokenizer:
        df = df.withColumn("p", pieces(F.col("sentences"), tokenizer)).withColumn("flat", F.col("p.tokens")).withColumn("back", F.array_join("p.back", " "))
    else:
        df = df.withColumn("flat", F.flatten(F.transform("sentences", words))).withColumn("back", F.array_join("sentences", " "))
    spread = lambda t: F.coalesce(F.when(t.rlike(r"^\[FORMULA_\d+\]$"), F.try_element_at("formula_tokens", F.regexp_extract(t, r"\d+", 0).cast("int") + 1)), F.array(t))
    toks = F.when(F.size("formulas") > 0, F.flatten(F.transform("flat", lambda t: C.bind(spread(t), lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(t)))))).otherwise(F.col("flat"))
    for name, col in (("ABBREV", "abbreviations"), ("NUMUNIT", "numunits"), ("FORMULA", "formulas"), ("TABLE", "tables")):
        df = df.withColumn("back", unmask(F.col("back"), name, F.col(col)))
    df = df.withColumn("toks", toks).withColumn("round_trip", C.same_words(F.col("back"), F.col("text")))
    return df.select(id_col, "chunk_index", F.col("toks").alias("tokens"), F.size("toks").alias("token_count"), "sentences", "tables", "first_table", "formulas", "formula_tokens", "numunits", "abbreviations", "round_trip")


def vocabulary_check(tokens: DataFrame, known: DataFrame | None, terms=tuple(V.TERMS), tokenizer: str | None = None) -> DataFrame:
    """T13, A7. Distinct words of three characters or more that aren't terms; with `known` (word), how many of them it lacks;
    with an encoder's file, how many have several pieces (fragmented) and how many a piece that is no text by itself
    (byte_fallback)."""
    w = tokens.select(F.explode("tokens").alias("word")).filter((F.length("word") >= 3) & ~F.col("word").isin(list(terms)) & ~F.col("word").startswith("[")).distinct()
    counts = [F.count("*").alias("words")]
    if known is not None:
        w = w.join(known.select("word", F.lit(1).alias("k")).distinct(), "word", "left")
        counts.append(F.count_if(F.col("k").isNull()).alias("unknown"))
    if tokenizer:
        @F.pandas_udf(T.StructType([T.StructField("n", T.IntegerType()), T.StructField("dirty", T.BooleanType())]))
        def judge(s: pd.Series) -> pd.DataFrame:
            of = Pieces.of(tokenizer)
            ids = [of.ids(x) for x in s]
            return pd.DataFrame({"n": list(map(len, ids)), "dirty": [any("\ufffd" in of.name(i) for i in x) for x in ids]})

        w = w.withColumn("p", judge("word"))
        counts += [F.count_if(F.col("p.n") > 1).alias("fragmented"), F.count_if("p.dirty").alias("byte_fallback")]
    return w.agg(*counts)
