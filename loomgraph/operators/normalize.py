"""Normalization (N1-N17): dates, numbers, units, abbreviations, lemmas, tables. Native; CAS and morphology are plug-ins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed as V

_FACTOR = {u: float(f) for u, (f, _, _) in V.UNITS.items()}
_OFFSET = {u: float(o) for u, (_, o, _) in V.UNITS.items()}
_SYMBOL = {u: s for u, (_, _, s) in V.UNITS.items()}


def dates(t: Column) -> Column:
    """N8, N9. `d.m.yyyy`, `d/m/yyyy` (day first, else month first) and `d Month yyyy` to ISO; no date stays as it is."""
    def dmy(m, _):
        x = F.translate(m, "/", ".")
        return F.coalesce(F.date_format(F.try_to_timestamp(x, F.lit("d.M.yyyy")), "yyyy-MM-dd"), F.date_format(F.try_to_timestamp(x, F.lit("M.d.yyyy")), "yyyy-MM-dd"), m)

    def named(m, _):
        g = [F.regexp_extract(m, V.DATE_NAMED, k) for k in (1, 2, 3)]
        month = C.lookup({k: f"{v:02d}" for k, v in V.MONTHS.items()}, F.lower(g[1]))
        return F.coalesce(F.date_format(F.try_to_timestamp(F.concat(g[2], F.lit("-"), month, F.lit("-"), F.lpad(g[0], 2, "0")), F.lit("yyyy-MM-dd")), "yyyy-MM-dd"), m)

    return C.rewrite(C.rewrite(t, C.DIGIT + V.DATE_DMY, dmy), C.DIGIT + V.DATE_NAMED, named)


def scientific(t: Column) -> Column:
    """N10. a·10^b and aEb to plain numbers."""
    power = lambda a, b: C.number_text(C.number_of(a) * F.pow(F.lit(10.0), b.cast("double")))
    return C.rewrite_groups(C.rewrite_groups(t, C.DIGIT + V.SCIENTIFIC, 2, power), C.DIGIT + V.SCIENTIFIC_E, 2, power)


def decimal_dots(t: Column) -> Column:
    """N11. Decimal dot to comma, but not in versions, addresses and dates."""
    return F.regexp_replace(t, C.DIGIT + V.DECIMAL_DOT, "$1,$2")


def in_si(value: Column, unit: Column) -> Column:
    """N5. A quantity in SI base units."""
    return value * C.lookup(_FACTOR, unit) + C.lookup(_OFFSET, unit)


def units(t: Column, safe: bool = False) -> Column:
    """N13, N14. Number and unit to SI; units alone to their SI symbol. safe leaves a unit alone that follows a range.
    SI symbols are their own, so one pass does both, but where a power (`m**2`) stands whose digit may count as a number."""
    alone = r"(?<!\d\s)(?<!\d)" + C.UNIT_ALONE if safe else C.UNIT_ALONE

    known = {u: F.struct(F.lit(f).alias("factor"), F.lit(_OFFSET[u]).alias("offset"), F.lit(_SYMBOL[u]).alias("symbol")) for u, f in _FACTOR.items()}

    def quantity(number, unit):
        si = lambda n, u: F.concat(C.number_text(F.round(n * u["factor"] + u["offset"], 12)), F.lit(" "), u["symbol"])
        return C.bind(C.lookup(known, unit), lambda u: si(C.number_of(number), u))

    either = lambda n, u, lone: F.when(n == "", C.lookup(_SYMBOL, lone)).otherwise(quantity(n, u))
    twice = lambda x: C.rewrite_groups(C.rewrite_groups(x, C.NUMUNIT, 2, quantity), alone, 1, lambda u: C.lookup(_SYMBOL, u))
    return C.bind(t, lambda x: F.when(x.contains("**"), twice(x)).otherwise(C.rewrite_groups(x, f"{C.NUMUNIT}|{alone}", 3, either)))


def abbreviations(t: Column, table: dict[str, str] = V.ABBREVIATIONS) -> Column:
    """N15. In the table's order, whole words only; a text without any of the words is left at once."""
    def change(x):
        some, done = F.lit(False), x
        for word, short in table.items():
            some, done = some | x.contains(word), F.regexp_replace(done, rf"(?U){C.firsts([word])}(?<!\w){C.java(word)}(?!\w)", short)
        return F.when(some, done).otherwise(x)

    return C.bind(t, change) if table else t


def formula(m: Column, canonical: Callable[[Column], Column]) -> Column:
    """N1. A formula with its inside as the plug-in has it; as it was where it is chemical, or where the result is null or
    blank or lacks an element's symbol or a Greek letter that was there."""
    n = F.when(m.startswith("$$") | m.startswith("\\[") | m.startswith("\\("), 2).otherwise(1)
    inner = lambda x: F.substring(x, n + 1, F.length(x) - 2 * n)

    def judged(x):
        lost = F.lit(False)
        for s in (*V.KEPT_IN_FORMULAS, *(f"\\{g}" for g in V.GREEK)):
            lost = lost | (x["was"].contains(s) & ~x["new"].contains(s))
        return F.when(x["new"].isNull() | (C.strip(x["new"]) == "") | lost, m).otherwise(F.concat(F.left(m, n), x["new"], F.right(m, n)))

    return F.when(m.rlike(V.CHEMICAL), m).otherwise(C.bind(F.struct(inner(m).alias("was"), canonical(inner(m)).alias("new")), judged))


def formulas(t: Column, canonical: Callable[[Column], Column] | None = None) -> Column:
    """N1. Each formula of a text; identity without a plug-in."""
    if canonical is None:
        return t
    return C.rewrite(C.rewrite(t, V.DISPLAY_MATH, lambda m, _: formula(m, canonical)), V.INLINE_MATH, lambda m, _: formula(m, canonical))


def lemmas(t: Column, lemma: Callable[[Column], Column] | None = None, terms=tuple(V.TERMS)) -> Column:
    """N16. Words through the plug-in; terms, upper-case, short and mixed-case words stay, a first capital comes back."""
    if lemma is None:
        return t

    def one(w, _):
        kept = w.isin(list(terms)) | (w == F.upper(w)) | (F.length(w) < 3) | F.substr(w, F.lit(2)).rlike(r"\p{Lu}")
        new = lemma(F.lower(w))
        return F.when(kept, w).otherwise(F.when(w.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substr(new, F.lit(1), F.lit(1))), F.lower(F.substr(new, F.lit(2))))).otherwise(new))

    return C.rewrite(t, V.LETTERS, one)


def cell(raw: Column) -> Column:
    """N4-N6. A table cell as struct<kind, num, str, unit, display>: quantity, number, date or text; null if empty."""
    q = "^(?:" + C.NUMUNIT + ")$"
    make = lambda kind, num, text, u, show: F.struct(F.lit(kind).alias("kind"), num.alias("num"), text.alias("str"), u.alias("unit"), show.alias("display"))
    none, blank = F.lit(None).cast("double"), F.lit(None).cast("string")

    def typed(x):
        t, n, unit = x["t"], x["n"], F.regexp_extract(x["n"], C.NUMUNIT, 2)
        amount, symbol = in_si(C.number_of(F.regexp_extract(n, C.NUMUNIT, 1)), unit), C.lookup(_SYMBOL, unit)
        return (
            F.when(t == "", F.lit(None))
            .when(n.rlike(q), make("quantity", amount, blank, symbol, F.concat_ws(" ", C.number_text(F.round(amount, 12)), symbol)))
            .when(n.rlike(f"^(?:{V.PLAIN_NUMBER})$"), make("number", C.number_of(n), blank, blank, n))
            .when(t.rlike(f"^(?:{V.ISO_DATE})$"), make("date", none, t, blank, t))
            .otherwise(C.bind(C.strip(units(n)), lambda y: make("text", none, y, blank, y)))
        )

    return C.bind(C.bind(scientific(dates(C.strip(raw))), lambda t: F.struct(t.alias("t"), decimal_dots(t).alias("n"))), typed)


def table_lines(block: Column) -> Column:
    """N3. A block as struct<head: array<string>, names: array<string>, lines: array<string>, width>: the first row before the
    first separator is the header (without a separator, the first row), the other lines but separators are the body, and the
    widest row gives the width; names that are blank or taken get the column's number."""
    text = lambda c: F.coalesce(c["display"], F.lit(""))
    none = F.expr("cast(array() as array<string>)")
    width = lambda lines: F.coalesce(F.array_max(F.transform(lines, lambda y: F.size(C.cells(y)))), F.lit(0))

    def split(lines):
        at = F.array_position(F.transform(lines, C.is_separator), F.lit(True)).cast("int")
        numbered = F.transform(F.sequence(F.lit(0), width(lines) - 1), lambda k: F.concat(F.lit("col_"), k.cast("string")))
        head = F.when(at == 1, numbered).otherwise(C.cells(F.element_at(lines, 1)))
        return F.struct(head.alias("head"), F.filter(F.slice(lines, F.greatest(at, F.lit(1)) + 1, F.size(lines)), lambda y: ~C.is_separator(y)).alias("lines"))

    def padded(p):
        return C.bind(F.greatest(F.size(p["head"]), width(p["lines"])), lambda w: F.struct(F.transform(_filled(p["head"], w), lambda c: text(cell(c))).alias("head"), p["lines"].alias("lines"), w.alias("width")))

    def named(x):
        column = lambda h, k: F.when(h == "", F.concat(F.lit("col_"), k.cast("string"))).otherwise(h)
        pairs = F.transform(x["head"], lambda h, k: F.struct(column(h, k).alias("n"), k.cast("string").alias("k")))
        names = F.aggregate(pairs, none, lambda acc, y: F.concat(acc, F.array(F.when(F.array_contains(acc, y["n"]), F.concat_ws("_", y["n"], y["k"])).otherwise(y["n"]))))
        return F.struct(x["head"].alias("head"), names.alias("names"), x["lines"].alias("lines"), x["width"].alias("width"))

    return C.bind(C.bind(C.bind(F.filter(F.transform(F.split(block, "\n", -1), C.strip), lambda x: x != ""), split), padded), named)


def _filled(row: Column, width: Column) -> Column:
    return F.concat(row, F.array_repeat(F.lit(""), width - F.size(row)))


def row_cells(line: Column, width: Column) -> Column:
    """N3. A line's cells, as many as the table is wide."""
    return C.bind(C.cells(line), lambda r: F.transform(_filled(r, width), cell))


def table_text(block: Column) -> Column:
    """N3. A block as a Markdown table of normalized cells. A pipe in a cell keeps its backslash."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |"))
    rows = lambda x: F.transform(x["lines"], lambda r: line(F.transform(row_cells(r, x["width"]), lambda c: F.coalesce(c["display"], F.lit("")))))
    return C.bind(table_lines(block), lambda x: F.array_join(F.concat(F.array(line(x["head"]), line(F.transform(x["head"], lambda _: F.lit("---")))), rows(x)), "\n"))


def table_blocks(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """N2. Markdown tables: id_col, table_index, block, and b, the formulas that the markers in them stand for. A block is
    rows, with the blank lines between and after them, of two lines or more. Nothing is shuffled."""
    t, b = F.coalesce(F.col(text_col), F.lit("")), C.no_blocks()
    df = df.select(F.col(id_col).alias("id"), t.alias("t"), b.alias("b"))
    for pattern, kind, own in ((V.DISPLAY_MATH, "display_math", True), (V.INLINE_MATH, "inline_math", False)):
        t, b = C.protect(F.col("t"), F.col("b"), pattern, kind, own)
        df = df.select("id", t.alias("t"), b.alias("b"))
    found = F.posexplode(F.regexp_extract_all("t", F.lit(V.TABLE), F.lit(0))).alias("table_index", "block")
    return df.select(F.col("id").alias(id_col), found, "b")


def table_cells(blocks: DataFrame, id_col: str) -> DataFrame:
    """N3, N17. Long form: id_col, table_index, row, col, name, kind, num, str, unit, formulas back in names and texts; cells
    that are empty or that a short row lacks have a null kind. Nothing is shuffled; a table becomes lines before cells are
    made, and a line carries its own formulas alone, as a table may have very many of both."""
    t = blocks.select(id_col, "table_index", "b", table_lines(F.col("block")).alias("t"))
    names = F.transform("t.names", lambda n: C.restore(n, F.col("b")))
    rows = t.select(id_col, "table_index", names.alias("names"), "t.width", F.posexplode(F.transform("t.lines", lambda x: C.with_own(x, F.col("b")))).alias("row", "x"))
    cells = rows.select(id_col, "table_index", "row", "names", "x.held", row_cells(F.col("x.text"), F.col("width")).alias("cells"))
    flat = cells.select(id_col, "table_index", "row", "held", F.posexplode(F.arrays_zip("names", "cells")).alias("col", "x"))
    return flat.select(id_col, "table_index", "row", "col", F.col("x.names").alias("name"), "x.cells.kind", "x.cells.num", C.put_back(F.col("x.cells.str"), F.col("held")).alias("str"), "x.cells.unit")


def table_columns(cells_df: DataFrame, id_col: str) -> DataFrame:
    """N7, A10. float64 if all cells are numbers or quantities of one unit at most, datetime64[ns] if all are dates, else object."""
    g = cells_df.groupBy(id_col, "table_index", "col", "name").agg(F.collect_set("kind").alias("kinds"), F.collect_set("unit").alias("units"))
    only = lambda *k: (F.size("kinds") > 0) & (F.size(F.array_except("kinds", F.array(*map(F.lit, k)))) == 0)
    dtype = F.when(only("number", "quantity") & (F.size("units") <= 1), "float64").when(only("date"), "datetime64[ns]").otherwise("object")
    return g.select(id_col, "table_index", "col", "name", dtype.alias("dtype"), F.when(dtype == "float64", F.try_element_at("units", F.lit(1))).alias("unit"))


def table_records(cells_df: DataFrame, id_col: str) -> DataFrame:
    """N3, N17. id_col, table_index, n_columns, rows: array<map<name, value>>, where numbers are in SI and empty cells null."""
    value = F.coalesce("str", F.concat_ws(" ", C.number_text(F.col("num")), "unit"))
    value = F.when(F.col("kind").isNotNull(), value)
    row = cells_df.groupBy(id_col, "table_index", "row").agg(F.array_sort(F.collect_list(F.struct("col", "name", value.alias("value")))).alias("e"))
    row = row.select(id_col, "table_index", "row", F.size("e").alias("n"), F.map_from_entries(F.transform("e", lambda x: F.struct(x["name"], x["value"]))).alias("r"))
    return row.groupBy(id_col, "table_index").agg(F.max("n").alias("n_columns"), F.transform(F.array_sort(F.collect_list(F.struct("row", F.map_entries("r").alias("e")))), lambda x: F.map_from_entries(x["e"])).alias("rows"))


def normalize(df: DataFrame, text_col: str = "text", safe_units: bool = False, lemma=None, canonical=None, tables: bool = True) -> DataFrame:
    """Dates, scientific numbers, decimal dots, units, abbreviations and lemmas, with formulas (through the plug-in) and
    tables (cell by cell) set aside as blocks."""
    change = None if canonical is None else lambda m: formula(m, canonical)
    steps = [(V.DISPLAY_MATH, "display_math", True, change), (V.INLINE_MATH, "inline_math", False, change)] + ([(V.TABLE, "markdown_table", True, table_text)] if tables else [])
    df = df.withColumn("__blocks", C.no_blocks()).withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    for pattern, kind, block, how in steps:
        t, b = C.protect(F.col(text_col), F.col("__blocks"), pattern, kind, block, how)
        df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in (text_col, "__blocks")], t.alias(text_col), b.alias("__blocks"))
    for f in (dates, scientific, decimal_dots, lambda x: units(x, safe_units), abbreviations, lambda x: lemmas(x, lemma)):
        df = df.withColumn(text_col, f(F.col(text_col)))
    t = F.col(text_col)
    return df.withColumn(text_col, C.restore(t, F.col("__blocks"))).withColumn(text_col, F.when((t == "") | t.endswith("\n"), t).otherwise(F.concat(t, F.lit("\n")))).drop("__blocks")
