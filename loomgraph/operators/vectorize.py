"""Vectorization (V1-V19): table matching and text, TF-IDF, BM25, hash vectors, number index. Native but for plug-ins."""

from __future__ import annotations

import difflib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import fixed as V

DIM, K1, B, MOST_TABLE_CHARS = 384, 1.5, 0.75, 4000


def text_tokens(t: Column) -> Column:
    """V10. Formulas whole, else words with inner commas, dots and hyphens."""
    return F.regexp_extract_all(t, F.lit(f"{V.FORMULA}|{V.VECTOR_WORD}"), F.lit(0))


def unit_tokens(df: DataFrame, doc: str, unit: str, tokens: Column) -> DataFrame:
    """(doc, unit, pos, token, len) of an array of tokens a row."""
    df = df.select(doc, unit, tokens.alias("tokens")).withColumn("len", F.size("tokens").cast("long"))
    # a column alone would be filtered by its size first, which makes the tokens twice
    return df.select(doc, unit, F.posexplode(F.when(F.size("tokens") > 0, F.col("tokens"))).alias("pos", "token"), "len")


def term_counts(tokens: DataFrame, doc: str, unit: str) -> DataFrame:
    """tokens: (doc, unit, pos, token, and len if it is known). Per unit and token: tf, pos of the first, len of the unit."""
    known = "len" in tokens.columns
    tf = tokens.groupBy(doc, unit, "token", *["len"] * known).agg(F.count("*").alias("tf"), F.min("pos").alias("pos"))
    tf = tf.filter("tf > 0 and pos >= 0")  # always so: with both columns in every use, Spark counts the tokens once for all uses
    return tf if known else tf.join(tf.groupBy(doc, unit).agg(F.sum("tf").alias("len")), [doc, unit])


def vocabulary(tf: DataFrame, doc: str, unit: str) -> DataFrame:
    """A6. Per document and token: df, and id, its rank by first occurrence. Ranks are made within a unit, and what earlier
    units have is added, so a document with most of the tokens is not one task's."""
    first = tf.groupBy(doc, "token").agg(F.count("*").alias("df"), F.min(F.struct(unit, "pos")).alias("first")).select(doc, "token", "df", F.col(f"first.{unit}").alias("u"), "first.pos")
    first = first.filter("df > 0 and pos >= 0")  # always so, as in term_counts
    before = F.sum("n").over(Window.partitionBy(doc).orderBy("u").rowsBetween(Window.unboundedPreceding, -1))
    offset = first.groupBy(doc, "u").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    ranked = first.withColumn("k", F.row_number().over(Window.partitionBy(doc, "u").orderBy("pos")) - 1)
    return ranked.join(offset, [doc, "u"]).select(doc, "token", "df", (F.col("before") + F.col("k")).cast("int").alias("id"))


def sparse(tokens: DataFrame, doc: str = "source_file", unit: str = "chunk_index", method: str = "tfidf", ids: bool = True) -> DataFrame:
    """V13, V14, A6. doc, unit, token, id (if ids), value (6 decimals). Vocabulary, df and n are per document."""
    tf = term_counts(tokens.filter(F.col("token").isNotNull()), doc, unit)
    vocab = vocabulary(tf, doc, unit) if ids else tf.groupBy(doc, "token").agg(F.count("*").alias("df"))
    n = tf.filter("pos = 0") if "len" in tokens.columns else tf.select(doc, unit, "len").distinct()
    n = n.groupBy(doc).agg(F.count("*").alias("n"), F.avg("len").alias("avg"))
    j = tf.join(vocab, [doc, "token"]).join(n, doc)
    if method == "tfidf":
        value = F.col("tf") / F.col("len") * (F.ln((1 + F.col("n")) / (1 + F.col("df"))) + 1)
    else:
        value = F.ln((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1) * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg")))
    return j.select(doc, unit, "token", *["id"] * ids, F.bround(value, 6).alias("value"))


def hash_vector(tokens: Column, dim: int = DIM) -> Column:
    """V11, V15. Counts by crc32 of the token, of length 1, 6 decimals; zeros without tokens. Sorted places are counted by
    where each begins, so nothing is copied a step."""
    def counted(at):
        starts = F.filter(F.transform(at, lambda x, k: F.struct(x.alias("k"), k.alias("i"))), lambda x: (x["i"] == 0) | (F.try_element_at(at, x["i"]) != x["k"]))
        return C.bind(starts, lambda s: F.transform(s, lambda x, j: F.struct(x["k"].alias("k"), (F.coalesce(F.try_element_at(s, j + 2)["i"], F.size(at)) - x["i"]).alias("c"))))

    zeros = lambda n: F.array_repeat(F.lit(0.0), n)

    def spread(x):
        # each place's value after the zeros that stand before it, then the zeros after the last
        r = x["r"]
        part = lambda y, i: F.concat(zeros(y["k"] - F.coalesce(F.try_element_at(r, i)["k"], F.lit(-1)) - 1), F.array(F.bround(y["c"] / x["norm"], 6)))
        parts = F.flatten(F.transform(r, lambda y, i: F.when(i == 0, F.concat(zeros(y["k"]), F.array(F.bround(y["c"] / x["norm"], 6)))).otherwise(part(y, i))))
        return F.concat(F.coalesce(parts, F.expr("cast(array() as array<double>)")), zeros(dim - 1 - F.coalesce(F.try_element_at(r, F.lit(-1))["k"], F.lit(-1))))

    at = F.array_sort(F.transform(tokens, lambda t: (F.crc32(t.cast("binary")) % dim).cast("int")))
    norm = lambda runs: F.sqrt(F.aggregate(runs, F.lit(0.0), lambda a, r: a + r["c"] * r["c"]))
    return C.bind(C.bind(C.bind(at, counted), lambda runs: F.struct(runs.alias("r"), norm(runs).alias("norm"))), spread)


def formula_vectors(items: Column, mode: str = "latex_aware", dim: int = DIM) -> Column:
    """V11. array<struct<id, latex, formula_tokens, vector>> of formulas: a hash vector of each one's tokens, or, in the mode
    single, of the whole formula as one."""
    bare = lambda f: F.when((f.startswith("$$") & f.endswith("$$") | f.startswith("\\[") & f.endswith("\\]") | f.startswith("\\(") & f.endswith("\\)")) & (F.length(f) > 3), F.substring(f, F.lit(3), F.length(f) - 4)).when(f.startswith("$") & f.endswith("$") & (F.length(f) > 1), F.substring(f, F.lit(2), F.length(f) - 2)).otherwise(f)
    toks = lambda f: F.array(f) if mode == "single" else F.regexp_extract_all(bare(f), F.lit(V.LATEX), F.lit(0))
    item = lambda f, i: C.bind(F.struct(C.strip(f).alias("f")), lambda x: F.struct(i.cast("string").alias("id"), x["f"].alias("latex"), toks(x["f"]).alias("formula_tokens"), hash_vector(toks(x["f"]), dim).alias("vector")))
    return F.transform(items, item)


def numbers(items: Column) -> Column:
    """V12. array<struct<id, raw, value, unit>>."""
    return F.transform(items, lambda x, i: F.struct(i.cast("string").alias("id"), x.alias("raw"), C.number_of(F.nullif(F.regexp_extract(x, V.NUMUNIT_PARSE, 1), F.lit(""))).alias("value"), F.nullif(C.strip(F.regexp_extract(x, V.NUMUNIT_PARSE, 2)), F.lit("")).alias("unit")))


def registry(items: Column) -> Column:
    """V19."""
    return F.transform(items, lambda x, i: F.struct(i.cast("string").alias("id"), x.alias("text")))


def parse_markdown(t: Column) -> Column:
    """V8. struct<header, rows>: the first line that is no separator is the header, short rows are padded."""
    lines = F.filter(F.transform(F.split(t, "\n"), C.strip), lambda x: (x != "") & ~C.is_separator(x))
    none = F.expr("cast(array() as array<string>)")
    padded = lambda r, n: F.concat(F.slice(r, 1, F.greatest(n, F.lit(1))), F.array_repeat(F.lit(""), F.greatest(n - F.size(r), F.lit(0))))
    # head and width are made once, not for each row
    rows = lambda g, head: C.bind(F.size(head), lambda n: F.transform(F.slice(g, 2, F.greatest(F.size(g), F.lit(1))), lambda r: padded(r, n)))
    return C.bind(F.transform(lines, C.cells), lambda g: C.bind(F.coalesce(F.try_element_at(g, F.lit(1)), none), lambda head: F.struct(head.alias("header"), rows(g, head).alias("rows"))))


def to_markdown(header: Column, rows: Column) -> Column:
    """V4."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    return F.array_join(F.concat(F.array(line(header), line(F.transform(header, lambda _: F.lit("---")))), F.transform(rows, line)), "\n")


def dense_text(index: Column, names: Column, dtypes: Column, units: Column, rows: Column, most: int = MOST_TABLE_CHARS) -> Column:
    """V5. A table as sentences, cut at most characters."""
    col = lambda i: F.concat(F.element_at(names, i), F.lit(": "), F.element_at(dtypes, i), F.coalesce(F.concat(F.lit(", единица: "), F.element_at(units, i)), F.lit("")))
    cols = F.array_join(F.transform(F.sequence(F.lit(1), F.size(names)), col), "; ")
    row = lambda r, k: F.concat(F.lit("Строка "), (k + 1).cast("string"), F.lit(": "), F.array_join(F.zip_with(names, r, lambda n, v: F.concat(n, F.lit(": "), F.coalesce(v, F.lit("")))), "; "), F.lit("."))
    text = F.array_join(F.concat(F.array(F.concat(F.lit("Таблица "), index.cast("string"), F.lit(".")), F.concat(F.lit("Колонки: "), cols, F.lit("."))), F.transform(rows, row)), "\n")
    return C.bind(text, lambda t: F.when(F.length(t) > most, F.concat(F.rtrim(F.left(t, F.lit(most))), F.lit(" ..."))).otherwise(t))


def table_tokens(names: Column, dtypes: Column, units: Column, rows: Column) -> Column:
    """V6."""
    tagged = lambda tag, xs: F.transform(F.filter(xs, lambda x: x.isNotNull()), lambda x: F.concat(F.lit(tag), x))
    return F.concat(F.flatten(F.transform(names, text_tokens)), tagged("dtype:", dtypes), tagged("unit:", units), F.flatten(F.transform(F.flatten(rows), lambda v: text_tokens(F.coalesce(v, F.lit(""))))))


def table_formulas(names: Column, rows: Column) -> Column:
    """V7. array<struct<row, column, latex, tokens>> of the formulas in a table's cells (rows: values in the names' order)."""
    in_cell = lambda k, n, v: F.transform(F.regexp_extract_all(v, F.lit(V.FORMULA), F.lit(0)), lambda f: F.struct(k.alias("row"), n.alias("column"), f.alias("latex"), F.regexp_extract_all(f, F.lit(V.LATEX), F.lit(0)).alias("tokens")))
    return F.flatten(F.transform(rows, lambda r, k: F.flatten(F.zip_with(names, r, lambda n, v: in_cell(k, n, F.coalesce(v, F.lit("")))))))


def canonical_text(names: Column, rows: Column) -> Column:
    """V4. Cells with single spaces, between pipes, a line a row."""
    line = lambda r: F.array_join(F.transform(r, lambda v: C.squeeze(F.coalesce(v, F.lit("")))), "|")
    return F.array_join(F.concat(F.array(line(names)), F.transform(rows, line)), "\n")


def built_tables(records: DataFrame, id_col: str) -> DataFrame:
    """V3. records (id_col, table_index, columns: array<struct<name, dtype, unit>>, rows: array<map<string, string>>) with
    names, dtypes, units, cells (values in the names' order, null as empty) and canonical. Without columns, the first row's
    keys are the names."""
    keys = F.coalesce(F.map_keys(F.try_element_at("rows", F.lit(1))), F.expr("cast(array() as array<string>)"))
    given = F.size(F.coalesce("columns", F.expr("cast(array() as array<struct<name:string,dtype:string,unit:string>>)"))) > 0
    names = F.when(given, F.transform("columns", lambda c, k: F.coalesce(c["name"], F.concat(F.lit("col_"), k.cast("string"))))).otherwise(keys)
    r = records.withColumn("names", names)
    r = r.withColumn("dtypes", F.when(given, F.transform("columns", lambda c: F.coalesce(c["dtype"], F.lit("str")))).otherwise(F.transform("names", lambda _: F.lit("str"))))
    r = r.withColumn("units", F.when(given, F.transform("columns", lambda c: c["unit"])).otherwise(F.transform("names", lambda _: F.lit(None).cast("string"))))
    r = r.withColumn("cells", F.transform(F.coalesce("rows", F.expr("cast(array() as array<map<string,string>>)")), lambda row: F.transform("names", lambda n: F.coalesce(F.try_element_at(row, n), F.lit("")))))
    return r.select(id_col, "table_index", "names", "dtypes", "units", "cells", canonical_text(F.col("names"), F.col("cells")).alias("canonical"))


def table_entries(raw: DataFrame, records: DataFrame, id_col: str, least: float = 0.8) -> DataFrame:
    """V1-V8, J1-J3. raw (id_col, key, global_index, text: the Markdown of tokenization) with records as in built_tables:
    id_col, id, normalization_table_index, match_score, header, columns, rows, table_text, sparse_tokens, formulas,
    vector_key. A raw table without a record is read from its Markdown, its columns of dtype str."""
    built = built_tables(records, id_col)
    m = match_tables(raw, built.select(id_col, "table_index", F.col("canonical").alias("text")), id_col, least)
    own = parse_markdown(F.col("text"))
    e = raw.join(m, [id_col, "key"]).join(built, [id_col, "table_index"], "left").withColumn("own", own)
    hit = F.col("names").isNotNull()
    e = e.withColumn("dtypes", F.coalesce("dtypes", F.transform("own.header", lambda _: F.lit("str")))).withColumn("units", F.coalesce("units", F.transform("own.header", lambda _: F.lit(None).cast("string"))))
    e = e.withColumn("cells", F.coalesce("cells", "own.rows")).withColumn("names", F.coalesce("names", "own.header"))
    n, d, u, c = F.col("names"), F.col("dtypes"), F.col("units"), F.col("cells")
    label = F.when(F.col("table_index").isNotNull(), F.col("table_index").cast("string")).otherwise(F.concat(F.lit("raw_"), F.col("key").cast("string")))
    columns = F.transform(F.arrays_zip("names", "dtypes", "units"), lambda x: F.struct(x["names"].alias("name"), x["dtypes"].alias("dtype"), x["units"].alias("unit")))
    rows = F.transform("cells", lambda r: F.map_from_entries(F.array_distinct(F.zip_with(n, r, lambda a, b: F.struct(a, b)))))
    return e.select(
        id_col, F.col("key").alias("id"), F.when(hit | F.col("table_index").isNotNull(), F.col("table_index")).alias("normalization_table_index"), F.round(F.coalesce("match_score", F.lit(0.0)), 4).alias("match_score"), n.alias("header"), columns.alias("columns"), rows.alias("rows"),
        dense_text(label, n, d, u, c).alias("table_text"), table_tokens(n, d, u, c).alias("sparse_tokens"), table_formulas(n, c).alias("formulas"), F.concat(F.when(F.col("table_index").isNotNull(), F.concat(F.lit("normalized::"), F.col("table_index").cast("string"))).otherwise(F.concat(F.lit("raw::"), F.col("key").cast("string")))).alias("vector_key"),
    )


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


def match_tables(raw: DataFrame, records: DataFrame, id_col: str, least: float = 0.8) -> DataFrame:
    """V1-V3, J1-J3. raw (id_col, key, global_index, text) with the record (id_col, table_index, text) that has the same text,
    else the same index, else the most similar text of the document (0.8 or more). Each row has one match at most."""
    r = records.select(id_col, "table_index", F.col("text").alias("record")).withColumn("h", F.sha2(C.squeeze(F.col("record")).cast("binary"), 256))
    by_text = r.groupBy(id_col, "h").agg(F.min("table_index").alias("t1"))
    by_index = r.groupBy(id_col, F.col("table_index").alias("global_index")).agg(F.min("table_index").alias("t2"))
    base = raw.withColumn("h", F.sha2(C.squeeze(F.col("text")).cast("binary"), 256)).join(by_text, [id_col, "h"], "left").join(by_index, [id_col, "global_index"], "left")
    open_ = base.filter("t1 is null and t2 is null and global_index is null")
    fuzzy = open_.join(r.select(id_col, "table_index", "record"), id_col).withColumn("score", similarity("text", "record")).filter(F.col("score") >= least)
    best = fuzzy.groupBy(id_col, "key").agg(F.max(F.struct("score", (-F.col("table_index")).alias("t"))).alias("m"))
    out = base.join(best, [id_col, "key"], "left")
    return out.select(id_col, "key", F.coalesce("t1", "t2", (-F.col("m.t"))).alias("table_index"), F.when(F.coalesce("t1", "t2").isNotNull(), 1.0).otherwise(F.col("m.score")).alias("match_score"))


def restore_special(t: Column, kind: str, items: Column) -> Column:
    """V9. `[KIND_i]`, also with spaces before the underscore, to items[i]; unknown ones stay."""
    p = rf"\[{kind}\s*_(\d+)\]"
    return C.rewrite(t, p, lambda m, _: F.coalesce(F.try_element_at(items, F.regexp_extract(m, p, 1).cast("int") + 1), m))


def encode(df: DataFrame, text_col: str, tokens_col: str, model: Callable[[list[str]], list[list[float]]] | None = None, batch: int = 16, dim: int = DIM, kind: str = "chunk", doc_col: str | None = None) -> DataFrame:
    """V16, V17. vector and vector_source: the model's (prefix `passage: `, batches), or hash vectors without a model or where
    it has no vector; with doc_col, for all rows of a document where it lacks one of them."""
    hashed = hash_vector(F.col(tokens_col), dim)
    if model is None:
        return df.withColumn("vector", hashed).withColumn("vector_source", F.when(F.size(tokens_col) > 0, f"{kind}_hash_fallback").otherwise("none"))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            out: list = []
            for i in range(0, len(s), batch):
                got = model(["passage: " + (x or "") for x in s.iloc[i : i + batch]])
                out += [None if v is None else list(map(float, v)) for v in got]
            yield pd.Series(out, dtype=object)

    df = df.withColumn("dense", run(F.col(text_col)))
    if doc_col:
        lacking = df.filter("dense is null").select(doc_col, F.lit(True).alias("__lacks")).distinct()
        df = df.join(lacking, doc_col, "left").withColumn("dense", F.when(F.col("__lacks").isNull(), F.col("dense"))).drop("__lacks")
    return df.withColumn("vector", F.coalesce("dense", hashed)).withColumn("vector_source", F.when(F.col("dense").isNotNull(), f"{kind}_dense").otherwise(f"{kind}_hash_fallback")).drop("dense")


def encode_unique(df: DataFrame, key_cols: list[str], text_col: str, tokens_col: str, **kw) -> DataFrame:
    """V18, J4. Each text is encoded once and joined back."""
    once = encode(df.select(text_col, tokens_col).dropDuplicates([text_col]), text_col, tokens_col, **kw)
    return df.select(*key_cols, text_col).join(once.select(text_col, "vector", "vector_source"), text_col)
