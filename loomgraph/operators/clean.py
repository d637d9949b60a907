"""Clearing (C1-C21): Markdown and HTML to plain text. Native, but for one Arrow UDF that sets math and tables aside, which\nneed a state, in the texts that have some, and one for tab stops."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import fixed as V


@dataclass(frozen=True)
class CleanConfig:
    normalize_nfc: bool = True
    lowercase: bool = False
    stopwords: tuple[str, ...] = ()
    decimal_comma: bool = False
    protect_math: bool = True
    html_tables: bool = True
    markdown_tables: bool = True
    header_min_repeats: int = 6
    header_max_chars: int = 80


def newlines(t: Column) -> Column:
    """C1."""
    t = C.where(t, ("\ufeff",), lambda x: F.regexp_replace(x, "^\ufeff", ""))
    return C.where(t, ("\r",), lambda x: F.regexp_replace(x, r"\r\n?", "\n"))


def images(t: Column) -> Column:
    """C3."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, V.IMAGE, ""), V.IMAGE_REF, ""), V.HTML_IMG, "")


def links(t: Column) -> Column:
    """C4. Labels stay, definitions go."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, V.LINK, "$1"), V.LINK_REF, "$1"), V.LINK_DEF, "")


def control_chars(t: Column) -> Column:
    """C9, C10."""
    return F.regexp_replace(F.regexp_replace(t, V.CONTROL, ""), V.FORMAT, "")


def comments(t: Column) -> Column:
    """C11."""
    return F.regexp_replace(t, V.HTML_COMMENT, " ")


def tags(t: Column) -> Column:
    """C12."""
    return F.regexp_replace(t, V.HTML_TAG, " ")


def page_numbers(t: Column) -> Column:
    """C13. The line becomes empty."""
    return F.regexp_replace(t, V.PAGE_NUMBER, "")


def inline_markup(t: Column) -> Column:
    for p, hint in ((V.INLINE_CODE, "`"), (V.BOLD, "**"), (V.STRIKE, "~~"), (V.ESCAPE, "\\")):
        t = C.where(t, (hint,), lambda x: F.regexp_replace(x, p, "$1"))  # noqa: B023
    return t


def markup(t: Column) -> Column:
    """C15."""
    for p in (V.HEADING, V.BLOCKQUOTE, V.RULE, V.LIST_ITEM):
        t = F.regexp_replace(t, p, "")
    return inline_markup(t)


def decimal_comma(t: Column) -> Column:
    """C16."""
    return F.regexp_replace(t, r"(?<=\d),(?=\d)", ".")


def lowercase(t: Column) -> Column:
    """C17. Lower case but for abbreviations."""
    marked, kept = C.protect(t, C.no_blocks(), V.ABBREVIATION, "abbreviation")
    return C.restore(F.lower(marked), kept)


def stop_words(t: Column, words) -> Column:
    """C18. Drops stop words from lines that aren't tables and hold nothing protected."""
    def keep(token):
        core = F.regexp_replace(token, r"(?U)^[^\w]+|[^\w]+$", "")
        return ~(core.rlike(r"^\p{L}+$") & (core != F.upper(core)) & F.lower(core).isin(list(words)))

    def line(x):
        return F.when(C.is_table_row(x) | C.is_protected(x), x).otherwise(F.array_join(F.filter(F.split(x, " ", -1), lambda w: (w == "") | keep(w)), " "))

    return F.array_join(F.transform(F.split(t, "\n", -1), line), "\n") if words else t


@F.pandas_udf(T.StringType())
def expand_tabs(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x.expandtabs(4) if x and "\t" in x else x)


expand_tabs = expand_tabs.asNondeterministic()


def whitespace(t: Column) -> Column:
    """C19, C20. Tabs to stops of four, no-break spaces, line ends, runs of three, blank lines, one final newline."""
    t = F.coalesce(expand_tabs(F.when(t.contains("\t"), t)), t)
    t = C.where(t, ("\u00a0", "\u2007", "\u202f"), lambda x: F.regexp_replace(x, V.NBSP, " "))
    t = C.bind(t, lambda x: F.when(x.contains(" \n") | x.contains("\t\n") | x.endswith(" ") | x.endswith("\t"), F.regexp_replace(x, r"(?md)(?=[ \t])(?<![ \t])[ \t]++$", "")).otherwise(x))
    t = C.where(t, ("   ", "\t"), lambda x: F.regexp_replace(x, r"(?=[ \t])(?<=\S)[ \t]{3,}", " "))
    t = C.where(t, ("\n\n\n",), lambda x: F.regexp_replace(x, r"\n{3,}", "\n\n"))
    return C.bind(C.strip(t), lambda x: F.when(x == "", x).otherwise(F.concat(x, F.lit("\n"))))


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or unicodedata.is_normalized("NFC", x) else unicodedata.normalize("NFC", x))


def nfc(t: Column) -> Column:
    """C2. Only texts that are not plain ASCII go through Python."""
    return F.coalesce(_nfc(F.when(F.octet_length(t) != F.length(t), t)), t)


def ocr_fixes(t: Column) -> Column:
    """C21."""
    for wrong, right in V.OCR_FIXES.items():
        t = C.where(t, (wrong,), lambda x: F.replace(x, F.lit(wrong), F.lit(right)))  # noqa: B023
    return t


class _Grid(HTMLParser):
    """A table's cells by row, with spans spread out."""

    def __init__(self):
        super().__init__()
        self.rows: list[dict[int, str]] = []
        self.below: dict[tuple[int, int], bool] = {}
        self.cell: list[str] | None = None
        self.spans, self.skip = (1, 1), 0

    def handle_starttag(self, tag, attrs):
        span = lambda k: max(1, int(v)) if (v := dict(attrs).get(k) or "1").strip().isdigit() else 1
        if tag == "tr":
            self._end()
            self.rows.append({})
        elif tag in ("td", "th"):
            self._end()
            if not self.rows:
                self.rows.append({})
            self.cell, self.spans = [], (span("colspan"), span("rowspan"))
        elif tag in ("script", "style"):
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self._end()
        elif tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)

    def handle_data(self, data):
        if self.cell is not None and not self.skip:
            self.cell.append(data)

    def _end(self):
        if self.cell is None:
            return
        y, row, x = len(self.rows) - 1, self.rows[-1], 0
        while x in row or (y, x) in self.below:
            x += 1
        for dx in range(self.spans[0]):
            row[x + dx] = cell_text(" ".join(p for c in self.cell if (p := c.strip()))) if dx == 0 else ""
            for dy in range(1, self.spans[1]):
                self.below[y + dy, x + dx] = True
        self.cell = None


def python_pattern(p: str) -> re.Pattern:
    """A pattern of `fixed` for Python, whose classes are Unicode's and whose lines end at \\n as they are."""
    return re.compile(re.sub(r"^\(\?([a-zA-Z]+)\)", lambda m: f"(?{f})" if (f := re.sub("[dUu]", "", m[1])) else "", p))


_IMAGES = [(python_pattern(p), hint) for p, hint in ((V.IMAGE, "]("), (V.IMAGE_REF, "]["), (V.HTML_IMG, "<"))]
_LINKS = [(python_pattern(p), by, hint) for p, by, hint in ((V.LINK, r"\1", "]("), (V.LINK_REF, r"\1", "]["), (V.LINK_DEF, "", "]:"))]
_INLINE = [(python_pattern(p), hint) for p, hint in ((V.INLINE_CODE, "`"), (V.BOLD, "**"), (V.STRIKE, "~~"), (V.ESCAPE, "\\"))]
_TAG, _TABLE, _UNSEEN, _NBSP, _CELL = (python_pattern(p) for p in (V.HTML_TAG, V.HTML_TABLE, f"{V.CONTROL}|{V.FORMAT}", V.NBSP, V.CELL_SPLIT))
_DISPLAY, _INLINE_MATH = python_pattern(V.DISPLAY_MATH), python_pattern(V.INLINE_MATH)
_ROW, _BLANK = r"[^\n|\ue000-\ue003]*\|[^\n|\ue000-\ue003]*\|[^\n\ue000-\ue003]*", r"[^\S\n]*"
#: A table: rows, and the blank lines between and after them.
_ROWS = re.compile(rf"(?m)^{_ROW}$(?:\n(?:{_ROW}|{_BLANK})$)*")
_SEPARATOR = re.compile(r"[ |:-]*-[ |:-]*")


def cell_text(x: str) -> str:
    """C8. A cell without images, links, tags, markup, control and format characters, its blanks squeezed."""
    for p, hint in _IMAGES[:2]:
        x = p.sub("", x) if hint in x else x
    for p, by, hint in _LINKS[:2]:
        x = p.sub(by, x) if hint in x else x
    x = _TAG.sub(" ", x) if "<" in x else x
    for p, hint in _INLINE:
        x = p.sub(r"\1", x) if hint in x else x
    return re.sub(r"[ \t]+", " ", _NBSP.sub(" ", _UNSEEN.sub("", x))).strip()


def table_row(cells: list[str]) -> str:
    """A row's line; a pipe in a cell keeps its backslash, so that the row keeps its columns."""
    return "| " + " | ".join(c.replace("|", "\\|") for c in cells) + " |"


def html_table(source: str) -> str:
    """C5. One HTML table as Markdown, its first row as header; without cells it stays as it is."""
    g = _Grid()
    g.feed(source)
    g.close()
    g._end()
    rows = [r for r in g.rows if r]
    if not rows:
        return source
    width = max(max(r) for r in rows) + 1
    head, *body = ([r.get(x, "") for x in range(width)] for r in rows)
    return "\n".join([table_row(head), table_row(["---"] * width), *map(table_row, body)])


def markdown_table(block: str) -> str:
    """C6-C8. A block's rows with clean cells and `---` separators, without its blank lines."""
    out = []
    for line in block.split("\n"):
        if not (bare := line.strip()):
            continue
        inner = bare.removeprefix("|")
        cells = [c.strip().replace("\\|", "|") for c in _CELL.split(inner[:-1] if inner.endswith("|") else inner)]
        out.append(table_row(["---"] * len(cells) if _SEPARATOR.fullmatch(bare) else list(map(cell_text, cells))))
    return "\n".join(out)


def set_aside(text: str, cfg: CleanConfig = CleanConfig()) -> tuple[str, list[tuple[str, str]], dict[str, int]]:
    """C2-C8 on one text: its normal form with math and tables as numbered blocks (kind, content), without images and
    with the labels of links; and how many of each there were. Math goes first, so that neither links nor tables are
    seen in it, and tables are done when they are set aside: no later step changes them."""
    blocks: list[tuple[str, str]] = []
    found: dict[str, int] = {}

    def change(name, pattern, by, x):
        x, n = pattern.subn(by, x)
        if n:
            found[name] = found.get(name, 0) + n
        return x

    def block(kind, make=lambda m: m[0], edge="\n"):
        def put(m):
            blocks.append((kind, make(m)))
            return f"{edge}{C.OPEN}{len(blocks) - 1}{C.CLOSE}{edge}"

        return put

    if cfg.normalize_nfc and not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    if cfg.protect_math and ("$" in text or "\\(" in text or "\\[" in text):
        text = change("display_math_protected", _DISPLAY, block("display_math"), text)
        text = change("inline_math_protected", _INLINE_MATH, block("inline_math", edge=""), text)
    for p, hint in _IMAGES:
        text = change("images_removed", p, "", text) if hint in text else text
    for p, by, hint in _LINKS:
        text = change("markdown_links_normalized", p, by, text) if hint in text else text
    if cfg.html_tables and "</" in text:
        text = change("html_tables_protected", _TABLE, block("html_table", lambda m: html_table(m[0])), text)
    if cfg.markdown_tables and text.count("|") > 1:
        text = change("markdown_tables_protected", _ROWS, block("markdown_table", lambda m: markdown_table(m[0])), text)
    return text, blocks, found


_ASIDE = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("blocks", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("content", T.StringType())]))),
    T.StructField("found", T.MapType(T.StringType(), T.IntegerType())),
])


def aside(t: Column, cfg: CleanConfig) -> Column:
    """set_aside over a column, for the texts that hold anything for it to do; null for all others."""
    @F.pandas_udf(_ASIDE)
    def run(s: pd.Series) -> pd.DataFrame:
        # a text that nothing was done to does not come back
        rows = [(None, None, None) if x is None or (y == x and not b and not n) else (y, [{"kind": k, "content": c} for k, c in b], n) for x in s for y, b, n in [set_aside(x or "", cfg)]]
        return pd.DataFrame(rows, columns=["text", "blocks", "found"])

    # not to be moved into later expressions, where a Python function cannot be
    return run.asNondeterministic()(F.when((F.octet_length(t) != F.length(t)) | t.rlike(r"[$|<\]]|\\[(\[]"), t))


@F.pandas_udf(T.StringType())
def html_tables(s: pd.Series) -> pd.Series:
    """C5. Each HTML table of a text as Markdown, on lines of its own."""
    return s.map(lambda x: _TABLE.sub(lambda m: "\n" + html_table(m[0]) + "\n", x) if x and "</" in x else x)


@F.pandas_udf(T.StringType())
def markdown_tables(s: pd.Series) -> pd.Series:
    """C6. Each Markdown table of a text cleaned, on lines of its own."""
    return s.map(lambda x: _ROWS.sub(lambda m: "\n" + markdown_table(m[0]) + "\n", x) if x and "|" in x else x)


def repeated_lines(df: DataFrame, id_col: str, text_col: str, least: int = 6, most_chars: int = 80) -> DataFrame:
    """C14. In each document, drops every line that occurs at least `least` times (stripped; short, not a table, and of
    eight characters or with a digit). Counted within the row, so nothing is shuffled; lines are only sorted where
    enough of them are equal."""
    lines = F.split(F.col(text_col), "\n", -1)

    def often(bare):
        fit = F.filter(bare, lambda x: (x != "") & (F.length(x) <= most_chars) & ((F.length(x) >= 8) | x.rlike(r"\d")) & ~C.is_table_row(x) & ~C.is_protected(x))
        # in sorted order, line k and line k + least - 1 are equal
        return C.bind(F.array_sort(fit), lambda xs: F.array_distinct(F.filter(xs, lambda x, k: F.try_element_at(xs, k + least) == x)))

    none = F.expr("cast(array() as array<string>)")
    bare = C.bind(F.transform(lines, C.strip), lambda xs: F.when(F.size(xs) - F.size(F.array_distinct(xs)) >= least - 1, often(xs)).otherwise(none))
    held = df.withColumn("__often", F.when(F.col(text_col).contains("\n"), bare).otherwise(none if least > 1 else bare))
    return held.withColumn(text_col, F.when(F.size("__often") > 0, F.array_join(F.filter(lines, lambda x: ~F.array_contains(F.col("__often"), C.strip(x))), "\n")).otherwise(F.col(text_col))).drop("__often")


#: What one pattern does to a text; counter, pattern, replacement, which is shorter than any match, and what a
#: text must hold for it ("" where only the pattern tells). Most texts have no match of most of them.
_FORMAT = rf"(?=[\u00AD\u061C-\uFFFD]){V.FORMAT}"
_PLAIN = [("control_chars_removed", V.CONTROL, "", ""), ("format_chars_removed", _FORMAT, "", ""), ("html_comments_removed", V.HTML_COMMENT, " ", "<!--"), ("html_tags_removed", V.HTML_TAG, " ", "<"), ("page_numbers_removed", V.PAGE_NUMBER, "", "")]
_MARKUP = [("markdown_headings_removed", V.HEADING, "", "#"), ("markdown_blockquotes_removed", V.BLOCKQUOTE, "", ">"), ("markdown_list_markers_removed", V.LIST_ITEM, "", ""), ("markdown_horizontal_rules_removed", V.RULE, "", "")]


def clean(df: DataFrame, id_col: str = "source_file", text_col: str = "text", cfg: CleanConfig = CleanConfig(), counts_col: str | None = None) -> DataFrame:
    """All clearing operators in their order; each withColumn ends one run of rewrites, so generated code stays small.
    counts_col, if given: map of what was found and changed in each text, with chars_before and chars_after (A2)."""
    C.small_batches(df.sparkSession)
    step = lambda d, f: d.withColumn(text_col, f(F.col(text_col)))
    counted: list[tuple[str, Column]] = []

    def note(d, name, value):
        if counts_col:
            counted.append((name, F.col(f"__n{len(counted)}")))
            d = d.withColumn(f"__n{len(counted) - 1}", value.cast("int"))
        return d

    t, new = F.col(text_col), F.col("__new")

    def replaced(d, name, pattern, by, hint):
        """One pattern's pass; matches are counted in the texts that it changed alone."""
        d = d.withColumn("__new", F.when(t.contains(hint) if hint else t.rlike(pattern), F.regexp_replace(t, pattern, by)).otherwise(t))
        return note(d, name, F.when(new == t, 0).otherwise(F.regexp_count(t, F.lit(pattern)))).withColumn(text_col, new).drop("__new")

    df = note(df, "chars_before", F.length(F.coalesce(t, F.lit(""))))
    df = note(df, "line_endings_normalized", F.when(t.contains("\r"), F.regexp_count(t, F.lit(r"\r\n?"))).otherwise(0))
    df = step(df, lambda t: newlines(F.coalesce(t, F.lit(""))))
    df = df.withColumn("__aside", aside(t, cfg)).withColumn("__blocks", F.coalesce("__aside.blocks", C.no_blocks())).withColumn(text_col, F.coalesce("__aside.text", t))
    for p in _PLAIN:
        df = replaced(df, *p)
    lines = lambda x: F.size(F.split(x, "\n", -1))
    df = df.withColumn("__old", t) if counts_col else df
    df = repeated_lines(df, id_col, text_col, cfg.header_min_repeats, cfg.header_max_chars)
    df = note(df, "header_footer_lines_removed", F.when(F.col("__old") == t, 0).otherwise(lines(F.col("__old")) - lines(t))).drop("__old") if counts_col else df
    for p in _MARKUP:
        df = replaced(df, *p)
    df = step(df, inline_markup)
    if cfg.decimal_comma:
        df = step(note(df, "decimal_commas_normalized", F.regexp_count(t, F.lit(r"(?<=\d),(?=\d)"))), decimal_comma)
    if cfg.lowercase:
        df = step(df, lowercase)
    df = step(df, lambda t: stop_words(t, cfg.stopwords))
    df = step(df, whitespace)
    df = step(df, lambda t: ocr_fixes(C.restore(t, F.col("__blocks")))).withColumn(text_col, F.when((t == "") | t.endswith("\n"), t).otherwise(F.concat(t, F.lit("\n"))))
    if counts_col:
        flat = [x for name, n in [*counted, ("chars_after", F.length(t))] for x in (F.lit(name), n)]
        all_counts = F.map_concat(F.create_map(*flat), F.coalesce("__aside.found", F.expr("cast(map() as map<string,int>)")))
        df = df.withColumn(counts_col, F.map_filter(all_counts, lambda k, n: (n > 0) | k.startswith("chars_"))).drop(*[f"__n{k}" for k in range(len(counted))])
    return df.drop("__blocks", "__aside")
