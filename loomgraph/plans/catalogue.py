"""Registered queries of the engine's own operators, each over its whole table, with DuckDB SQL to hold them against. Those that
split recursively or ask an encoder have none: tests/test_engine.py holds them against plain versions.

The tables hold display math, table rows and markup, but no dates, quantities, links or Cyrillic text, so queries for those
put a fragment before each text, on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed as V
from ..operators import chunk, clean, graph, metrics, normalize, tokenize, vectorize
from . import oracles as O
from . import pipeline

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return put


def _t(spark, sf, name):
    C.small_batches(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _docs(spark, sf, before=""):
    d = _t(spark, sf, "documents")
    return d.withColumn("text", F.concat(F.lit(before), F.col("text"))) if before else d


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("SELECT doc_id, md5(regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g')) AS h FROM documents")
def clean_control_chars(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(clean.control_chars(F.col("text")).cast("binary")).alias("h"))


@query("SELECT page_id, md5(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g')) AS h FROM pages")
def clean_html_comments(spark, sf):
    return _t(spark, sf, "pages").select("page_id", F.md5(clean.comments(F.col("html")).cast("binary")).alias("h"))


@query("SELECT page_id, md5(regexp_replace(html, '(?s)</?[a-zA-Z][^>]*>', ' ', 'g')) AS h FROM pages")
def clean_html_tags(spark, sf):
    return _t(spark, sf, "pages").select("page_id", F.md5(clean.tags(F.col("html")).cast("binary")).alias("h"))


@query("SELECT doc_id, md5('a' || chr(10) || 'b' || chr(10) || regexp_replace('c' || chr(10) || text, '\\r\\n?', chr(10), 'g')) AS h FROM documents")
def clean_newlines(spark, sf):
    return _docs(spark, sf, "\ufeffa\r\nb\rc\n").select("doc_id", F.md5(clean.newlines(F.col("text")).cast("binary")).alias("h"))


@query("SELECT doc_id, md5(nfc_normalize('e' || chr(769) || ' ' || text)) AS h FROM documents")
def clean_nfc(spark, sf):
    return _docs(spark, sf, "e\u0301 ").select("doc_id", F.md5(clean.nfc(F.col("text")).cast("binary")).alias("h"))


@query("SELECT doc_id, md5(regexp_replace('ab' || chr(10) || text, '[\\x{00AD}\\x{061C}\\x{180E}\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{2064}\\x{FEFF}\\x{FFFD}]', '', 'g')) AS h FROM documents")
def clean_format_chars(spark, sf):
    return _docs(spark, sf, "a\u200b\u00ad\u202eb\ufffd\n\u2064").select("doc_id", F.md5(clean.control_chars(F.col("text")).cast("binary")).alias("h"))


_ROWS = "| a **b** | `c` ~~d~~ |\n|:--|--:|\n\n| x | y |\nnext\n"


@query(f"""WITH src AS (SELECT doc_id, {O.q(_ROWS)} || text AS text FROM documents), {O.rows('src', 'doc_id', 'text')},
out AS (SELECT d, k * 4 AS k, l FROM seg WHERE fr IS NULL OR k < fr UNION ALL SELECT d, k * 4 + x, CASE WHEN x = 1 THEN md ELSE '' END FROM blocks, (VALUES (0), (1), (2)) AS v(x))
SELECT d AS doc_id, md5(string_agg(l, chr(10) ORDER BY k)) AS h FROM out GROUP BY d""")
def clean_md_tables(spark, sf):
    return _docs(spark, sf, _ROWS).select("doc_id", F.md5(clean.markdown_tables(F.col("text")).cast("binary")).alias("h"))


@query("""WITH p AS (SELECT doc_id, regexp_extract_all('The NASA probe and X80 steel.' || chr(10) || text, '[\\pL\\pN_\\pM]+|[^\\pL\\pN_\\pM]+') AS p FROM documents),
low AS (SELECT doc_id, array_to_string(list_transform(p, lambda x: CASE WHEN regexp_full_match(x, '[A-ZА-ЯЁ][A-ZА-ЯЁ0-9]*') THEN x ELSE lower(x) END), '') AS t FROM p),
said AS (SELECT doc_id, list_transform(string_split(t, chr(10)), lambda l: CASE WHEN length(l) - length(replace(l, '|', '')) >= 2 THEN l ELSE array_to_string(list_transform(list_filter(list_transform(string_split(l, ' '), lambda w: {'w': w, 'c': regexp_replace(w, '^[^\\pL\\pN_\\pM]+|[^\\pL\\pN_\\pM]+$', '', 'g')}),
lambda x: x.w = '' OR NOT (regexp_full_match(x.c, '\\pL+') AND x.c <> upper(x.c) AND lower(x.c) IN ('the', 'and', 'of'))), lambda x: x.w), ' ') END) AS ls FROM low)
SELECT doc_id, md5(array_to_string(ls, chr(10))) AS h FROM said""")
def clean_lowercase_stop_words(spark, sf):
    d = _docs(spark, sf, "The NASA probe and X80 steel.\n")
    return d.withColumn("text", clean.lowercase(F.col("text"))).select("doc_id", F.md5(clean.stop_words(F.col("text"), ("the", "and", "of")).cast("binary")).alias("h"))


@query("SELECT doc_id, md5('C-Mn-Mo-Nb-V-стали, ниобия ' || text) AS h FROM documents")
def clean_ocr(spark, sf):
    return _docs(spark, sf, "С-Мп-Мо-№-В-стали, ниobia ").select("doc_id", F.md5(clean.ocr_fixes(F.col("text")).cast("binary")).alias("h"))


#: Math that looks like a link and like a row, and a pipe with a backslash; SQL has stand-ins for them until the end.
_MIXED = "see $[a](b)$ and $P(|x|>1)$ end\n| y\\|z | **w** |\n"
_MIXED_SQL = "'see ' || chr(57346) || ' end' || chr(10) || '| y' || chr(57347) || 'z | **w** |' || chr(10)"
_CLEANED = O.cleaned(f"SELECT doc_id AS d, {_MIXED_SQL} || text AS text FROM documents")
_PUT_BACK = "replace(replace(text, chr(57346), '$[a](b)$ and $P(|x|>1)$'), chr(57347), '\\|')"


@query(f"WITH {_CLEANED} SELECT d AS doc_id, length({_PUT_BACK}) AS n, md5({_PUT_BACK}) AS h FROM cleaned")
def clean_documents(spark, sf):
    c = clean.clean(_docs(spark, sf, _MIXED).select("doc_id", "text"), "doc_id")
    return c.select("doc_id", F.length("text").cast("long").alias("n"), F.md5(F.col("text").cast("binary")).alias("h"))


@query(f"""WITH {O.cleaned("SELECT doc_id AS d, text FROM documents")}, n AS (SELECT d, count(*) AS tables FROM blocks GROUP BY d), l AS (SELECT d, count(*) AS n FROM paged GROUP BY d), o AS (SELECT p.d, count(*) AS n FROM paged p JOIN often o ON p.d = o.d AND trim(p.l, {O.WHITE}) = o.s GROUP BY p.d)
SELECT metric, sum(value)::BIGINT AS value, count(*) AS files FROM (SELECT 'chars_before' AS metric, length(text) AS value FROM raw UNION ALL SELECT 'chars_after', length(text) FROM cleaned UNION ALL SELECT 'display_math_protected', len(math) FROM marked WHERE len(math) > 0
UNION ALL SELECT 'markdown_tables_protected', tables FROM n UNION ALL SELECT 'header_footer_lines_removed', n FROM o) GROUP BY metric""")
def clean_counters(spark, sf):
    """A1, A2, A3: what clearing found, per file and in all."""
    c = clean.clean(_docs(spark, sf).select("doc_id", "text"), "doc_id", counts_col="counts")
    per = metrics.per_file(c, "doc_id", F.col("counts")).filter(F.col("metric").isin("chars_before", "chars_after", "display_math_protected", "markdown_tables_protected", "header_footer_lines_removed"))
    return per.groupBy("metric").agg(F.sum("value").alias("value"), F.count("*").alias("files"))


_MD = "![i](d) see [t](u) and [r][x].\n[x]: http://e\n"


@query(f"SELECT doc_id, md5('' || ' see t and r.' || chr(10) || chr(10) || text) AS h FROM documents")
def clean_links_images(spark, sf):
    d = _docs(spark, sf).withColumn("text", F.concat(F.lit(_MD), F.col("text")))
    return d.select("doc_id", F.md5(clean.links(clean.images(F.col("text"))).cast("binary")).alias("h"))


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace('H' || chr(10) || 'q' || chr(10) || 'item' || chr(10) || 'b s c' || chr(10) || text, '\*\*([^*\n]+)\*\*', '\1', 'g'), '~~([^~\n]+)~~', '\1', 'g'), '`([^`\n]*)`', '\1', 'g')) AS h
FROM documents""")
def clean_markup(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.md5(clean.markup(F.concat(F.lit("# H\n> q\n- item\n**b** ~~s~~ `c`\n"), F.col("text"))).cast("binary")).alias("h"))


@query("SELECT doc_id, md5(chr(10) || chr(10) || chr(10) || '12345' || chr(10) || 'x 5' || chr(10) || regexp_replace(text, '(?m)^ {0,3}[0-9]{1,4}[.]?$', '', 'g')) AS h FROM documents")
def clean_page_numbers(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.md5(clean.page_numbers(F.concat(F.lit("- 12 -\nСтр. 5\np. 3/10\n12345\nx 5\n"), F.col("text"))).cast("binary")).alias("h"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents),
b AS (SELECT doc_id, trim(line, ' ' || chr(9) || chr(13)) AS s, count(*) AS n FROM l GROUP BY 1, 2),
o AS (SELECT doc_id, s FROM b WHERE n >= 6 AND length(s) BETWEEN 1 AND 80 AND length(s) - length(replace(s, '|', '')) < 2 AND (length(s) >= 8 OR regexp_matches(s, '[0-9]')))
SELECT l.doc_id, count(*) AS lines, sum(length(l.line))::BIGINT AS chars FROM l LEFT JOIN o ON l.doc_id = o.doc_id AND trim(l.line, ' ' || chr(9) || chr(13)) = o.s WHERE o.s IS NULL GROUP BY 1""")
def clean_repeated_lines(spark, sf):
    d = clean.repeated_lines(_docs(spark, sf), "doc_id", "text").withColumn("l", F.split("text", "\n", -1))
    return d.select("doc_id", F.size("l").cast("long").alias("lines"), F.length(F.array_join("l", "")).cast("long").alias("chars"))


@query("SELECT doc_id, md5(regexp_replace(regexp_replace('1,5 x 2,75' || text, '([0-9]),([0-9])', '\\1.\\2', 'g'), '([0-9]),([0-9])', '\\1.\\2', 'g')) AS h FROM documents")
def clean_decimal_comma(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.md5(clean.decimal_comma(F.concat(F.lit("1,5 x 2,75"), F.col("text"))).cast("binary")).alias("h"))


@query("SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace('a    b  ' || chr(10) || chr(10) || chr(10) || chr(10) || text, '(?m)[ \\t]+$', '', 'g'), '([^ \\n\\t])[ ]{3,}', '\\1 ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9)) || chr(10)) AS h FROM documents")
def clean_whitespace(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.md5(clean.whitespace(F.concat(F.lit("a    b  \n\n\n\n"), F.col("text"))).cast("binary")).alias("h"))


@query(f"""WITH m AS (SELECT doc_id, text, regexp_extract_all(text, '(?s)\\$\\$.*?\\$\\$') AS math, string_split(regexp_replace(text, '(?s)\\$\\$.*?\\$\\$', {O.MATH}, 'g'), {O.MATH}) AS parts FROM documents)
SELECT doc_id, len(math) + 2 AS blocks, md5(chr(57344) || len(math) || chr(57345) || ' and ' || chr(57344) || (len(math) + 1) || chr(57345) || ' $ d $ ' || array_to_string(list_transform(parts, lambda p, i: p || CASE WHEN i <= len(math) THEN chr(10) || chr(57344) || (i - 1) || chr(57345) || chr(10) ELSE '' END), '')) AS marked,
md5('$a$ and \\(c\\) $ d $ ' || array_to_string(list_transform(parts, lambda p, i: p || CASE WHEN i <= len(math) THEN chr(10) || math[i] || chr(10) ELSE '' END), '')) AS restored, false AS before, true AS after FROM m""")
def protect_roundtrip(spark, sf):
    """Display and inline math as markers, and back."""
    d = _docs(spark, sf, "$a$ and \\(c\\) $ d $ ")
    t, b = C.protect(F.col("text"), C.no_blocks(), V.DISPLAY_MATH, "display", True)
    d = d.select("doc_id", C.is_protected(F.col("text")).alias("before"), t.alias("t"), b.alias("b"))
    t, b = C.protect(F.col("t"), F.col("b"), V.INLINE_MATH, "inline")
    d = d.select("doc_id", "before", t.alias("t"), b.alias("b"))
    return d.select("doc_id", F.size("b").alias("blocks"), F.md5(F.col("t").cast("binary")).alias("marked"), F.md5(C.restore(F.col("t"), F.col("b")).cast("binary")).alias("restored"), "before", C.is_protected(F.col("t")).alias("after"))


@query("SELECT page_id, md5(chr(10) || '| A | B |  |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| ' || page_id || ' | a c |  |' || chr(10) || '|  | y\\|z | p' || length(url) || ' |' || chr(10) || html) AS h FROM pages")
def html_table_to_md(spark, sf):
    cell = lambda x, more="": F.concat(F.lit(f"<td{more}>"), x, F.lit("</td>"))
    src = F.concat(F.lit("<table><tr><th>A</th><th colspan=2>B</th></tr><tr>"), cell(F.col("page_id").cast("string"), " rowspan=2"), F.lit("<td>a<b>c</b><img src=a></td></tr><tr><td>y|z</td>"), cell(F.concat(F.lit("p"), F.length("url").cast("string"))), F.lit("</tr></table>"))
    return _t(spark, sf, "pages").select("page_id", F.md5(clean.html_tables(F.concat(src, F.col("html"))).cast("binary")).alias("h"))


@query("SELECT doc_id, md5('2020-03-05 2020-05-13 31.02.2020 2020-03-05 г. 5 марта 2020 ' || text) AS h FROM documents")
def norm_dates(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.md5(normalize.dates(F.concat(F.lit("05.03.2020 05.13.2020 31.02.2020 5 март 2020 г. 5 марта 2020 "), F.col("text"))).cast("binary")).alias("h"))


@query("""WITH p AS (SELECT doc_id, regexp_extract_all(doc_id || '.5 1.2.3, 7.25, a2.5 ' || text, '[0-9A-Za-zА-Яа-яЁё.,]+|[^0-9A-Za-zА-Яа-яЁё.,]+') AS p FROM documents)
SELECT doc_id, md5(array_to_string(list_transform(p, lambda x: CASE WHEN regexp_matches(x, '^[0-9]+\\.[0-9]+(,|$)') THEN regexp_replace(x, '^([0-9]+)\\.', '\\1,') ELSE x END), '')) AS h FROM p""")
def norm_decimal(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.md5(normalize.decimal_dots(F.concat(F.col("doc_id").cast("string"), F.lit(".5 1.2.3, 7.25, a2.5 "), F.col("text"))).cast("binary")).alias("h"))


@query("SELECT l_orderkey, l_linenumber, (l_quantity::INTEGER * 1000)::VARCHAR || ' 0,0002' AS t FROM lineitem")
def norm_scientific(spark, sf):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", normalize.scientific(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("·10^3 2e-4"))).alias("t"))


@query("SELECT l_orderkey, l_linenumber, (l_quantity::INTEGER * 1000000)::VARCHAR || ' kg/m/s**2, ' || (l_quantity::INTEGER + 273)::VARCHAR || ',15 K; m' AS t FROM lineitem")
def norm_units(spark, sf):
    n = F.col("l_quantity").cast("int").cast("string")
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", normalize.units(F.concat(n, F.lit(" МПа, "), n, F.lit(" °C; мм"))).alias("t"))


@query("""WITH p AS (SELECT doc_id, regexp_extract_all('1193,15 K, ' || (doc_id + 1) || '000000 kg/m/s**2; m ' || text, '[0-9A-Za-zА-Яа-яЁё]+|[^0-9A-Za-zА-Яа-яЁё]+') AS p FROM documents)
SELECT doc_id, md5(array_to_string(list_transform(p, lambda x: CASE x WHEN 'Pa' THEN 'kg/m/s**2' WHEN 'MPa' THEN 'kg/m/s**2' ELSE x END), '')) AS h FROM p""")
def norm_unit_texts(spark, sf):
    """Quantities and lone units in whole texts."""
    return _docs(spark, sf).select("doc_id", F.md5(normalize.units(F.concat(F.lit("920 °C, "), (F.col("doc_id") + 1).cast("string"), F.lit(" МПа; мм "), F.col("text"))).cast("binary")).alias("h"))


@query("SELECT doc_id, md5('IF-стали, TRIP, PSL и ppm: xррт. ' || text) AS h FROM documents")
def norm_abbreviations(spark, sf):
    d = _docs(spark, sf, "Interstitial-Free стали, Transformation Induced Plasticity, Product Specification Level и ррт: xррт. ")
    return d.select("doc_id", F.md5(normalize.abbreviations(F.col("text")).cast("binary")).alias("h"))


_KEPT = "[" + ", ".join(f"'{x}'" for x in (*V.KEPT_IN_FORMULAS, *(f"\\{g}" for g in V.GREEK))) + "]"


@query(f"""WITH m AS (SELECT doc_id, regexp_extract_all(text, '(?s)\\$\\$.*?\\$\\$') AS math, string_split(regexp_replace(text, '(?s)\\$\\$.*?\\$\\$', {O.MATH}, 'g'), {O.MATH}) AS parts FROM documents),
c AS (SELECT *, list_transform(math, lambda x: CASE WHEN regexp_matches(x, '(?:\\[[A-Z][a-z]?\\]|[A-Z][a-z]?){{2,}}') OR trim(x[3:-3], {O.WHITE}) = '' OR len(list_filter({_KEPT}, lambda s: contains(x, s) AND NOT contains(translate(x, 'aex', 'AEX'), s))) > 0 THEN x ELSE translate(x, 'aex', 'AEX') END) AS new FROM m)
SELECT doc_id, md5('$X_' || doc_id || '$, $\\alpha y$, \\(NaCl\\) ' || array_to_string(list_transform(parts, lambda p, i: p || coalesce(new[i], '')), '')) AS h FROM c""")
def norm_formulas(spark, sf):
    """N1 with a plug-in that writes three letters large, which loses some Greek letters and elements' symbols."""
    text = F.concat(F.lit("$x_"), F.col("doc_id").cast("string"), F.lit("$, $\\alpha y$, \\(NaCl\\) "), F.col("text"))
    return _docs(spark, sf).select("doc_id", F.md5(normalize.formulas(text, lambda x: F.translate(x, "aex", "AEX")).cast("binary")).alias("h"))


@query(f"""WITH p AS (SELECT doc_id, regexp_extract_all('Steels NbCs Glass API IF-стали is. ' || text, '[A-Za-zА-Яа-яЁё][A-Za-zА-Яа-яЁё\\-]*|[^A-Za-zА-Яа-яЁё]+') AS p FROM documents)
SELECT doc_id, md5(array_to_string(list_transform(p, lambda w: CASE WHEN NOT regexp_matches(w, '^[A-Za-zА-Яа-яЁё]') OR w IN ({", ".join(f"'{t}'" for t in V.TERMS)}) OR w = upper(w) OR length(w) < 3 OR regexp_matches(substr(w, 2), '\\p{{Lu}}') THEN w
WHEN regexp_matches(w, '^\\p{{Lu}}') THEN upper(regexp_replace(lower(w), 's+$', '')[1]) || substr(regexp_replace(lower(w), 's+$', ''), 2) ELSE regexp_replace(lower(w), 's+$', '') END), '')) AS h FROM p""")
def norm_lemmas(spark, sf):
    """N16 with a plug-in that takes the s off a word's end."""
    d = _docs(spark, sf, "Steels NbCs Glass API IF-стали is. ")
    return d.select("doc_id", F.md5(normalize.lemmas(F.col("text"), lambda w: F.regexp_replace(w, "s+$", "")).cast("binary")).alias("h"))


def _part_tables(spark, sf, ragged=False):
    """A Markdown table of each brand's parts; ragged: every fifth row lacks its last cell, every seventh has one too many."""
    p = _t(spark, sf, "part")
    row = F.format_string("| %d | %s | %d мм |", "p_partkey", "p_brand", "p_size")
    if ragged:
        row = F.when(F.col("p_partkey") % 5 == 0, F.format_string("| %d | $|%s|$ |", "p_partkey", "p_brand")).when(F.col("p_partkey") % 7 == 0, F.concat(row, F.lit(" x |"))).otherwise(row)
    return p.groupBy(F.col("p_brand").alias("source_file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))), lambda x: x["r"]), "\n").alias("body")).select("source_file", F.concat(F.lit("Intro\n| key | brand | size |\n| --- | --- | --- |\n"), F.col("body"), F.lit("\nEnd")).alias("text"))


def _part_cells(spark, sf, ragged=False):
    return normalize.table_cells(normalize.table_blocks(_part_tables(spark, sf, ragged), "source_file", "text"), "source_file")


@query("SELECT p_brand AS source_file, count(*) * 3 AS cells, sum(p_partkey)::BIGINT AS keys, round(sum(p_size) / 1000.0, 4)::DOUBLE AS size_m FROM part GROUP BY 1")
def table_cells(spark, sf):
    c = _part_cells(spark, sf)
    return c.groupBy("source_file").agg(F.count("*").alias("cells"), F.sum(F.when(F.col("name") == "key", F.col("num"))).cast("long").alias("keys"), F.round(F.sum(F.when(F.col("name") == "size", F.col("num"))), 4).alias("size_m"))


@query("""WITH r AS (SELECT p_brand AS source_file, p_partkey, p_size, p_partkey % 5 = 0 AS short, p_partkey % 5 <> 0 AND p_partkey % 7 = 0 AS long FROM part), w AS (SELECT *, bool_or(long) OVER (PARTITION BY source_file) AS wide FROM r)
SELECT source_file, p_partkey::DOUBLE AS key, CASE WHEN short THEN '$|' || source_file || '|$' ELSE source_file END AS brand, CASE WHEN NOT short THEN p_size / 1000.0::DOUBLE END AS size_m, CASE WHEN long THEN 'x' END AS more, CASE WHEN wide THEN 4 ELSE 3 END AS n FROM w""")
def table_ragged(spark, sf):
    """Rows that are too short or too long, with math in cells."""
    c = _part_cells(spark, sf, ragged=True)
    at = lambda k, x: F.max(F.when(F.col("col") == k, F.col(x)))
    rows = c.groupBy("source_file", "row").agg(at(0, "num").alias("key"), at(1, "str").alias("brand"), at(2, "num").alias("size_m"), F.max(F.when(F.col("name") == "col_3", F.col("str"))).alias("more"), F.count("*").cast("int").alias("n"))
    return rows.select("source_file", "key", "brand", "size_m", "more", "n")


@query("SELECT DISTINCT p_brand AS source_file, c.name, c.dtype, c.unit FROM part, (VALUES ('key', 'float64', NULL), ('brand', 'object', NULL), ('size', 'float64', 'm')) AS c(name, dtype, unit)")
def table_typing(spark, sf):
    return normalize.table_columns(_part_cells(spark, sf), "source_file").select("source_file", "name", "dtype", "unit")


_M = "regexp_replace(regexp_replace(replace(printf('%.10f', p_size / 1000.0), '.', ','), '0+$', ''), ',$', '')"


@query(f"SELECT p_brand AS source_file, count(*)::INTEGER AS n, 3 AS n_columns, md5(string_agg('key=' || p_partkey || ';brand=' || p_brand || ';size=' || {_M} || ' m', chr(10) ORDER BY p_partkey)) AS h FROM part GROUP BY 1")
def table_records(spark, sf):
    r = normalize.table_records(_part_cells(spark, sf), "source_file")
    text = F.array_join(F.transform("rows", lambda m: F.concat(*[x for k in ("key", "brand", "size") for x in (F.lit(f"{'' if k == 'key' else ';'}{k}="), m[k])])), "\n")
    return r.select("source_file", F.size("rows").alias("n"), "n_columns", F.md5(text.cast("binary")).alias("h"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Nb' WHEN 1 THEN 'Mn' WHEN 2 THEN 'Ti' ELSE p_name END AS label, p_partkey % 4 <> 3 AS valid, 'A_B_' || p_partkey AS kind FROM part")
def label_rules(spark, sf):
    raw = F.element_at(F.array(F.lit(" «ниобий» "), F.lit("MN"), F.lit("titanium"), F.col("p_name")), (F.col("p_partkey") % 4 + 1).cast("int"))
    label = graph.canonical_label(graph.clean_label(raw))
    return _t(spark, sf, "part").select("p_partkey", label.alias("label"), graph.is_label(label).alias("valid"), graph.type_name(F.concat(F.lit(" a b-"), F.col("p_partkey"))).alias("kind"))


_LABEL = "CASE p_partkey % 7 WHEN 0 THEN 'процесс' WHEN 1 THEN 'Таблица ' || p_size WHEN 2 THEN p_size || ' мм сталь' WHEN 3 THEN 'Сталь ' || p_name WHEN 4 THEN p_name WHEN 5 THEN 'Сталь ' || p_name || ' a b c d e' ELSE p_size::VARCHAR END"


@query(f"""WITH x AS (SELECT p_partkey, {_LABEL} AS x FROM part)
SELECT p_partkey, x <> '' AND replace(lower(x), 'ё', 'е') NOT IN ({", ".join(f"'{g.replace('ё', 'е')}'" for g in V.GENERIC_LABELS)}) AND len(list_filter([{", ".join(f"'{w}'" for w in V.BAD_IN_LABEL)}], lambda w: contains(lower(x), w))) = 0 AND NOT regexp_full_match(x, '[0-9]+')
AND NOT (regexp_matches(x, '[0-9]') AND len(list_filter([{", ".join(f"'{w}'" for w in dict.fromkeys(V.UNITS_IN_LABEL))}], lambda w: contains(lower(x), w))) > 0) AND len(string_split(x, ' ')) <= 8 AND (regexp_matches(x, '[\\x{{0400}}-\\x{{04FF}}]') OR x IN ({", ".join(f"'{e}'" for e in V.ELEMENTS)})) AS valid FROM x""")
def label_validity(spark, sf):
    n = F.col("p_size").cast("string")
    raw = [F.lit("процесс"), F.concat(F.lit("Таблица "), n), F.concat(n, F.lit(" мм сталь")), F.concat(F.lit("Сталь "), F.col("p_name")), F.col("p_name"), F.concat(F.lit("Сталь "), F.col("p_name"), F.lit(" a b c d e")), n]
    return _t(spark, sf, "part").select("p_partkey", graph.is_label(F.element_at(F.array(*raw), (F.col("p_partkey") % 7 + 1).cast("int"))).alias("valid"))


@query("SELECT doc_id, trim(regexp_replace(substr(text, 11, 60), '\\s+', ' ', 'g')) <> '' AS own, contains(regexp_replace(lower(text), '\\s+', ' ', 'g'), 'the') AS word FROM documents")
def quote_support(spark, sf):
    """Each text's own middle as its quotation, and a word that not every text holds."""
    d = _docs(spark, sf)
    own = graph.supported(F.substring("text", 11, 60), F.col("text"))
    return d.select("doc_id", own.alias("own"), graph.supported(F.lit("the"), F.col("text")).alias("word"))


_KEY = f"trim(regexp_replace(replace(lower(text), 'ё', 'е'), '[{chr(92)}s]+', ' ', 'g'), ' ')"


@query(f"WITH q AS (SELECT item_id, {_KEY} AS k FROM benchmark), d AS (SELECT doc_id, {_KEY} AS k FROM documents) SELECT item_id, doc_id FROM q JOIN d ON q.k <> '' AND contains(d.k, q.k)")
def benchmark_quotes(spark, sf):
    """Documents that hold a benchmark item as a quotation (quote_support's SQL has each text's own middle alone)."""
    return graph.quoted(_t(spark, sf, "benchmark"), "item_id", _docs(spark, sf), "doc_id")


@query("SELECT doc_id, greatest(1, length(text) // 4)::INTEGER AS tokens FROM documents")
def chunk_fallback_length(spark, sf):
    return _docs(spark, sf).select("doc_id", chunk.token_length(F.col("text")).alias("tokens"))


_FLAT = f"""lines AS (SELECT doc_id AS d, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents),
said AS (SELECT d, k, length(l) - length(replace(l, '|', '')) >= 2 AS is_row, CASE WHEN length(l) - length(replace(l, '|', '')) >= 2 THEN trim(l, {O.WHITE}) ELSE regexp_replace(trim(l, {O.WHITE}), '[ ' || chr(9) || ']{{2,}}', ' ', 'g') END AS l FROM lines WHERE trim(l, {O.WHITE}) <> ''),
joined AS (SELECT *, CASE WHEN lag(k) OVER w IS NULL THEN '' WHEN is_row AND lag(is_row) OVER w AND lag(k) OVER w = k - 1 THEN chr(10) ELSE ' ' END AS gap FROM said WINDOW w AS (PARTITION BY d ORDER BY k)),
flat AS (SELECT d, string_agg(gap || l, '' ORDER BY k) AS t FROM joined GROUP BY d)"""


@query(f"WITH {_FLAT} SELECT doc_id, md5(coalesce(t, '')) AS h, CASE WHEN coalesce(t, '') = '' THEN 0 ELSE 1 END AS paragraphs FROM documents LEFT JOIN flat ON d = doc_id")
def chunk_flatten(spark, sf):
    """K6, K7: whole texts flattened; none has a blank line, so each is one paragraph."""
    return _docs(spark, sf).select("doc_id", F.md5(chunk.flattened(F.col("text")).cast("binary")).alias("h"), F.size(chunk.paragraphs(F.col("text"))).alias("paragraphs"))


@query(f"""WITH {_FLAT}, s AS (SELECT d, t, left(t, length(t) // 2) AS a, substr(t, length(t) // 2 + 1) AS b, list_filter(list_transform(string_split(regexp_replace(t, '([.!?])[ \\t\\n\\f\\r]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, {O.WHITE})), lambda x: length(x) >= 20) AS s FROM flat)
SELECT doc_id, coalesce(len(s), 0)::INTEGER AS sentences, coalesce(len(list_filter(s, lambda x: NOT contains(a, x) AND NOT contains(b, x))), 0)::INTEGER AS broken FROM documents LEFT JOIN s ON d = doc_id""")
def broken_sentences(spark, sf):
    """K8: sentences that neither half of a text holds."""
    d = _docs(spark, sf)
    flat, n = chunk.flattened(F.col("text")), F.floor(F.length("t") / 2).cast("int")
    halves = d.select("doc_id", flat.alias("t")).select("doc_id", F.explode(F.array(F.substring("t", F.lit(1), n), F.substring("t", n + 1, F.length("t")))).alias("text"))
    return chunk.broken_sentences(d, halves, "doc_id", "text")


@query("""SELECT count(*) AS chunks, sum(n)::BIGINT AS tokens, round(avg(n), 4)::DOUBLE AS mean, round(stddev_pop(n), 4)::DOUBLE AS std, count(*) FILTER (n > 1024) AS oversized, count(*) FILTER (n < 512) AS undersized, round(sum(n % 7)::DOUBLE / sum(n), 4)::DOUBLE AS overlap_ratio
FROM (SELECT greatest(1, length(text) // 4) AS n FROM documents)""")
def chunk_quality(spark, sf):
    """K9, A4, A5, each document taken for a chunk."""
    return chunk.size_stats(_docs(spark, sf).select(chunk.token_length(F.col("text")).alias("tokens")).withColumn("overlap_prev_tokens", F.col("tokens") % 7))


@query()
def chunk_recursive(spark, sf):
    return chunk.chunks(_docs(spark, sf), "doc_id", "text", 200, 0.15)


_RFIND = "CASE WHEN contains(substr(text, {p} + 1, 1400), {s}) THEN {p} + length(substr(text, {p} + 1, 1400)) - strpos(reverse(substr(text, {p} + 1, 1400)), reverse({s})) - length({s}) + 1 ELSE -1 END"


def _cut(p: str) -> str:
    """Where G14's window that starts at p ends."""
    find = lambda x: _RFIND.format(p=p, s=x)
    return f"(CASE WHEN length(text) <= {p} + 1400 THEN length(text) " + " ".join(f"WHEN {find(x)} > {p} + 700 THEN {find(x)} + length({x})" for x in ("chr(10) || chr(10)", "chr(10)", "'. '", "' '")) + f" ELSE {p} + 1400 END)::BIGINT"


@query(f"""WITH RECURSIVE r AS (SELECT doc_id, text, 0::BIGINT AS p, {_cut('0')} AS fin FROM documents WHERE length(text) > 0 UNION ALL SELECT doc_id, text, p, {_cut('p')} FROM (SELECT doc_id, text, greatest(fin - 200, p + 1) AS p FROM r WHERE fin < length(text)))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1)::INTEGER AS chunk_index, md5(trim(substr(text, p + 1, fin - p), {O.WHITE})) AS h FROM r WHERE trim(substr(text, p + 1, fin - p), {O.WHITE}) <> ''""")
def char_chunks(spark, sf):
    return chunk.char_chunks(_docs(spark, sf), "doc_id", "text").select("doc_id", "chunk_index", F.md5(F.col("text").cast("binary")).alias("h"))


_PARTED = "regexp_replace({t}, '([!?]|(?:^|[^A-ZА-ЯЁ])\\.)[ \\t\\n\\f\\r]+', '\\1' || chr(1), 'g')"


@query(f"SELECT doc_id, len(s)::INTEGER AS n, md5(array_to_string(s, chr(10))) AS h FROM (SELECT doc_id, list_filter(string_split({_PARTED.format(t=_PARTED.format(t='text'))}, chr(1)), lambda x: x <> '') AS s FROM (SELECT doc_id, 'By A. B. Case! ' || text AS text FROM documents))")
def sentence_split(spark, sf):
    s = tokenize.sentences(F.col("text"))
    return _docs(spark, sf, "By A. B. Case! ").select("doc_id", F.size(s).alias("n"), F.md5(F.array_join(s, "\n").cast("binary")).alias("h"))


@query("SELECT doc_id, len(regexp_extract_all(text, '[A-Za-zА-Яа-яЁё][A-Za-zА-Яа-яЁё\\-]*|[0-9]+(?:[.,][0-9]+)?'))::INTEGER AS n FROM documents")
def word_tokens(spark, sf):
    return _docs(spark, sf).select("doc_id", F.size(tokenize.words(F.col("text"))).alias("n"))


def _vocabulary(spark, sf):
    """Words of the documents against those of the benchmark."""
    t, b = (_t(spark, sf, name).select(tokenize.words(F.col("text")).alias("tokens")) for name in ("documents", "benchmark"))
    return tokenize.vocabulary_check(t, b.select(F.explode("tokens").alias("word")), ())


@query("""WITH w AS (SELECT DISTINCT source, unnest(regexp_extract_all(text, '[A-Za-zА-Яа-яЁё][A-Za-zА-Яа-яЁё\\-]*|[0-9]+(?:[.,][0-9]+)?')) AS word FROM documents)
SELECT count(DISTINCT word) AS words FROM w WHERE length(word) >= 3""")
def distinct_words(spark, sf):
    return _vocabulary(spark, sf).select("words")


@query("""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-zА-Яа-яЁё][A-Za-zА-Яа-яЁё\\-]*|[0-9]+(?:[.,][0-9]+)?')) AS word FROM documents), b AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-zА-Яа-яЁё][A-Za-zА-Яа-яЁё\\-]*|[0-9]+(?:[.,][0-9]+)?')) AS word FROM benchmark)
SELECT count(*) AS words, count(*) FILTER (word NOT IN (SELECT word FROM b)) AS unknown FROM w WHERE length(word) >= 3""")
def unknown_words(spark, sf):
    return _vocabulary(spark, sf)


@query("SELECT source, doc_id, coalesce(sum(n) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_table FROM (SELECT source, doc_id, length(text) % 3 AS n FROM documents)")
def global_table_index(spark, sf):
    d = _docs(spark, sf).select("source", "doc_id", (F.length("text") % 3).alias("n"))
    return tokenize.global_index(d, "source", "doc_id", "n").select("source", "doc_id", F.col("first_table").cast("long").alias("first_table"))


_OUTER = "^([^|]*)(\\|.*\\|)([^|]*)$"


@query(f"""WITH src AS (SELECT doc_id AS d, 'a | 1 | 2 | b' || chr(10) || '| 3 | 4 |' || chr(10) || '| 5 | 6 | c' || chr(10) || text AS text FROM documents),
lines AS (SELECT d, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM src),
cut AS (SELECT d, k, unnest(CASE WHEN length(l) - length(replace(l, '|', '')) >= 2 THEN list_filter([{{'x': 0, 'l': regexp_extract(l, '{_OUTER}', 1), 'r': false}}, {{'x': 1, 'l': regexp_extract(l, '{_OUTER}', 2), 'r': true}}, {{'x': 2, 'l': regexp_extract(l, '{_OUTER}', 3), 'r': false}}], lambda y: y.r OR trim(y.l, {O.WHITE}) <> '') ELSE [{{'x': 0, 'l': l, 'r': false}}] END) AS y FROM lines),
ranked AS (SELECT d, row_number() OVER (PARTITION BY d ORDER BY k, y.x) AS k, trim(y.l, {O.WHITE}) AS l, y.r AS r FROM cut),
runs AS (SELECT *, k - row_number() OVER (PARTITION BY d, r ORDER BY k) AS run FROM ranked), sized AS (SELECT *, count(*) OVER (PARTITION BY d, r, run) AS n, min(k) OVER (PARTITION BY d, r, run) AS first FROM runs),
numbered AS (SELECT *, dense_rank() OVER (PARTITION BY d, r AND n >= 2 ORDER BY first) - 1 AS i FROM sized)
SELECT d AS doc_id, (count(DISTINCT first) FILTER (r AND n >= 2))::INTEGER AS tables, md5(coalesce(string_agg(CASE WHEN r AND n >= 2 THEN '[TABLE_' || i || ']' ELSE l END, chr(10) ORDER BY k) FILTER (l <> '' AND (NOT (r AND n >= 2) OR k = first)), '')) AS h,
md5(coalesce(string_agg(l, chr(10) ORDER BY k) FILTER (r AND n >= 2), '')) AS held FROM numbered GROUP BY d""")
def token_tables(spark, sf):
    """T1, with text on either side of a table's pipes."""
    t, found = tokenize.extract_tables(F.col("text"))
    d = _docs(spark, sf, "a | 1 | 2 | b\n| 3 | 4 |\n| 5 | 6 | c\n").select("doc_id", t.alias("t"), found.alias("f"))
    return d.select("doc_id", F.size("f").alias("tables"), F.md5(F.col("t").cast("binary")).alias("h"), F.md5(F.array_join("f", "\n").cast("binary")).alias("held"))


_LATEX = "\\\\[a-zA-Z]+|[A-Za-z]+|[0-9]+(?:[.,][0-9]+)?|[{}_^+\\-=*/()]"


@query(f"SELECT p_partkey, bare, regexp_extract_all(bare, '{_LATEX}') AS tokens FROM (SELECT p_partkey, 'x_{{' || p_size || '}} + \\alpha' || replace(p_name, ' ', '^') || ' = ' || p_retailprice AS bare FROM part)")
def formula_tokens(spark, sf):
    """T9, T10."""
    edge = lambda k: F.when(F.col("p_partkey") % 3 == 0, F.lit(("$$", "$$")[k])).when(F.col("p_partkey") % 3 == 1, F.lit(("\\[", "\\]")[k])).otherwise("$")
    f = F.concat(edge(0), F.lit("x_{"), F.col("p_size").cast("string"), F.lit("} + \\alpha"), F.replace("p_name", F.lit(" "), F.lit("^")), F.lit(" = "), F.col("p_retailprice").cast("string"), edge(1))
    return _t(spark, sf, "part").select("p_partkey", tokenize.bare_formula(f).alias("bare"), tokenize.formula_tokens(f).alias("tokens"))


def _tokenized(spark, sf):
    d = _docs(spark, sf, "IF-стали и API: $x^2$ при 20 мм. ")
    return tokenize.tokenize(d.select(F.col("doc_id"), F.lit(0).alias("chunk_index"), "text"), "doc_id")


_TERM_RUNS = "len(list_filter(regexp_extract_all({t}, '[\\pL\\pN_\\pM\\-]+'), lambda x: x IN (" + ", ".join(f"'{t}'" for t in V.TERMS) + ")))"
_NO_MATH = "regexp_replace(text, '(?s)\\$\\$.*?\\$\\$', ' ', 'g')"


@query(f"""SELECT doc_id, len(regexp_extract_all(text, '(?s)\\$\\$.*?\\$\\$'))::INTEGER + 1 AS formulas, 1 AS numunits, ({_TERM_RUNS.format(t=_NO_MATH)} + 2)::INTEGER AS abbreviations, true AS round_trip FROM documents""")
def token_masks(spark, sf):
    """How many of each the texts hold (those inside math don't count), and whether they come back whole."""
    return _tokenized(spark, sf).select("doc_id", *(F.size(c).alias(c) for c in ("formulas", "numunits", "abbreviations")), "round_trip")


@query()
def token_mask_counts(spark, sf):
    """As token_masks, with tables and tokens."""
    return _tokenized(spark, sf).select("doc_id", *(F.size(c).alias(c) for c in ("tables", "formulas", "numunits", "abbreviations")), "token_count", "round_trip")


@query("SELECT p_partkey, 'a ' || p_name || ' b [NUMUNIT_1] [NUMUNIT_9] ' || p_name AS text, 'x' || p_name || p_brand AS unmasked FROM part")
def special_restore(spark, sf):
    """Markers, also with blanks in them, back to registered texts; unknown ones stay."""
    p = _t(spark, sf, "part")
    text = vectorize.restore_special(F.lit("a [NUMUNIT_0] b [NUMUNIT_1] [NUMUNIT_9] [NUMUNIT _0]"), "NUMUNIT", F.array(F.col("p_name"), F.lit("[NUMUNIT_1]")))
    return p.select("p_partkey", text.alias("text"), tokenize.unmask(F.lit("x[ABBREV_0][ABBREV_1]"), "ABBREV", F.array("p_name", "p_brand")).alias("unmasked"))


_TOKENS = "SELECT source, doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents"


def _tokens(spark, sf):
    return vectorize.unit_tokens(_docs(spark, sf), "source", "doc_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))


@query(f"""WITH t AS ({_TOKENS}), tf AS (SELECT source, doc_id, token, count(*) AS tf FROM t GROUP BY source, doc_id, token),
w AS (SELECT *, sum(tf) OVER (PARTITION BY source, doc_id) AS len, count(*) OVER (PARTITION BY source, token) AS df FROM tf), n AS (SELECT source, count(DISTINCT doc_id) AS n, sum(tf) / count(DISTINCT doc_id) AS av FROM tf GROUP BY source)
SELECT w.source, doc_id, token, round(round(tf / len * (ln((1 + n) / (1 + df)) + 1), 6) + 1e-9, 4)::DOUBLE AS value FROM w JOIN n ON w.source = n.source""")
def tfidf_vectors(spark, sf):
    return vectorize.sparse(_tokens(spark, sf), "source", "doc_id", ids=False).select("source", "doc_id", "token", F.round(F.col("value") + 1e-9, 4).alias("value"))


@query(f"""WITH t AS ({_TOKENS}), tf AS (SELECT source, doc_id, token, count(*) AS tf FROM t GROUP BY source, doc_id, token),
w AS (SELECT *, sum(tf) OVER (PARTITION BY source, doc_id) AS len, count(*) OVER (PARTITION BY source, token) AS df FROM tf), n AS (SELECT source, count(DISTINCT doc_id) AS n, sum(tf) / count(DISTINCT doc_id) AS av FROM tf GROUP BY source)
SELECT w.source, doc_id, token, round(round(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / av)), 6) + 1e-9, 4)::DOUBLE AS value FROM w JOIN n ON w.source = n.source""")
def bm25_vectors(spark, sf):
    return vectorize.sparse(_tokens(spark, sf), "source", "doc_id", "bm25", ids=False).select("source", "doc_id", "token", F.round(F.col("value") + 1e-9, 4).alias("value"))


@query("""WITH t AS (SELECT source, doc_id, regexp_extract_all(lower(text), '[a-z]+') AS ts FROM documents), p AS (SELECT source, doc_id, unnest(ts) AS token, generate_subscripts(ts, 1) AS pos FROM t), f AS (SELECT source, token, count(DISTINCT doc_id) AS df, min((doc_id, pos)) AS first FROM p GROUP BY source, token)
SELECT source, token, df, (row_number() OVER (PARTITION BY source ORDER BY first) - 1)::INTEGER AS id FROM f""")
def vocab_ids(spark, sf):
    """A6 and the ids of every token."""
    return vectorize.vocabulary(vectorize.term_counts(_tokens(spark, sf), "source", "doc_id"), "source", "doc_id")


_CLEAN_TOKENS = f"""WITH {O.cleaned("SELECT doc_id AS d, text FROM documents")}, t AS (SELECT source, doc_id, unnest(regexp_extract_all(lower(cleaned.text), '[a-z]+')) AS token FROM documents JOIN cleaned ON d = doc_id),
tf AS (SELECT source, doc_id, token, count(*) AS tf FROM t GROUP BY source, doc_id, token), w AS (SELECT *, sum(tf) OVER (PARTITION BY source, doc_id) AS len, count(*) OVER (PARTITION BY source, token) AS df FROM tf), n AS (SELECT source, count(DISTINCT doc_id) AS n FROM tf GROUP BY source)"""


@query(f"""{_CLEAN_TOKENS}, v AS (SELECT w.source, token AS term, round(sum(round(tf / len * (ln((1 + n) / (1 + df)) + 1), 6)) + 1e-9, 4)::DOUBLE AS weight FROM w JOIN n ON w.source = n.source GROUP BY w.source, token)
SELECT source, term, weight FROM v QUALIFY row_number() OVER (PARTITION BY source ORDER BY weight DESC, term) <= 20""")
def tfidf_top_terms(spark, sf):
    """Cleaned documents to the 20 terms of each source with the highest sum of TF-IDF over its documents."""
    from pyspark.sql import Window

    c = clean.clean(_docs(spark, sf).select("source", "doc_id", "text"), "doc_id")
    tokens = vectorize.unit_tokens(c, "source", "doc_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    v = vectorize.sparse(tokens, "source", "doc_id", ids=False).groupBy("source", F.col("token").alias("term")).agg(F.round(F.sum("value") + 1e-9, 4).alias("weight"))
    return v.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("weight"), "term"))).filter("r <= 20").drop("r")


def _hash_sql(tokens: str) -> str:
    """(id, pairs): places and values of the hash vector of tokens (id, token)."""
    return f"""w AS (SELECT token, ({O.crc32('token')} % 384)::INTEGER AS k FROM (SELECT DISTINCT token FROM {tokens}) x, crc), c AS (SELECT id, k, count(*) AS c FROM {tokens} t JOIN w ON t.token = w.token GROUP BY id, k), n AS (SELECT id, sqrt(sum(c * c)) AS norm FROM c GROUP BY id),
v AS (SELECT c.id, string_agg(k || ':' || round(round(c / norm, 6) * 10000)::INTEGER, ' ' ORDER BY k) AS pairs FROM c JOIN n ON c.id = n.id GROUP BY c.id)"""


def _pairs(vector):
    return F.array_join(F.transform(vector, lambda x, k: F.when(x != 0, F.concat_ws(":", k.cast("string"), F.round(x * 10000).cast("int").cast("string")))), " ")


@query(f"WITH {O.crc_table()}, t AS (SELECT doc_id AS id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS token FROM documents), {_hash_sql('t')} SELECT doc_id, coalesce(md5(pairs), md5('')) AS h FROM documents LEFT JOIN v ON id = doc_id")
def hash_vectors(spark, sf):
    """All places and values, to four digits."""
    v = vectorize.hash_vector(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)))
    return _docs(spark, sf).select("doc_id", F.md5(_pairs(v).cast("binary")).alias("h"))


@query(f"WITH {O.crc_table()}, f AS (SELECT p_partkey AS id, 'x_{{' || p_size || '}} + ' || p_name AS bare FROM part), t AS (SELECT id, unnest(regexp_extract_all(bare, '{_LATEX}')) AS token FROM f), {_hash_sql('t')} SELECT f.id AS p_partkey, '$' || bare || '$' AS latex, regexp_extract_all(bare, '{_LATEX}') AS formula_tokens, pairs FROM f JOIN v ON f.id = v.id")
def formula_vectors(spark, sf):
    """V11."""
    p = _t(spark, sf, "part")
    x = vectorize.formula_vectors(F.array(F.concat(F.lit(" $x_{"), F.col("p_size").cast("string"), F.lit("} + "), F.col("p_name"), F.lit("$ "))))
    return p.select("p_partkey", F.element_at(x, 1).alias("x")).select("p_partkey", "x.latex", "x.formula_tokens", _pairs(F.col("x.vector")).alias("pairs"))


@query("SELECT doc_id, len(t)::INTEGER AS n, md5(array_to_string(t, chr(10))) AS h FROM (SELECT doc_id, regexp_extract_all('$a$ 1,5 x-y ' || text, '(?s)\\$\\$.*?\\$\\$|\\\\\\[.*?\\\\\\]|\\\\\\(.*?\\\\\\)|\\$[^$\\n]+?\\$|[A-Za-zА-Яа-яЁё0-9][A-Za-zА-Яа-яЁё0-9,.\\-]*') AS t FROM documents)")
def vector_tokens(spark, sf):
    """V10."""
    t = vectorize.text_tokens(F.col("text"))
    return _docs(spark, sf, "$a$ 1,5 x-y ").select("doc_id", F.size(t).alias("n"), F.md5(F.array_join(t, "\n").cast("binary")).alias("h"))


@query("SELECT l_orderkey, l_linenumber, l_quantity::INTEGER + 0.5::DOUBLE AS value, 'мм' AS unit FROM lineitem")
def numunit_index(spark, sf):
    x = vectorize.numbers(F.array(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(",5 мм"))))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.element_at(x, 1)["value"].alias("value"), F.element_at(x, 1)["unit"].alias("unit"))


def _fake_model(texts):
    """Length, and how often `e` stands there; none for texts about brands that end in 3."""
    return [None if x.endswith("3") else [float(len(x)), float(x.count("e"))] for x in texts]


@query(f"""WITH {O.crc_table()}, lacking AS (SELECT DISTINCT p_type AS d FROM part WHERE p_brand LIKE '%3'), t AS (SELECT DISTINCT p_brand AS id, 'p' AS token FROM part), {_hash_sql('t')}
SELECT p_partkey, CASE WHEN d IS NULL THEN 'chunk_dense' ELSE 'chunk_hash_fallback' END AS source, CASE WHEN d IS NULL THEN 'len ' || (length(p_brand) + length(p_name) + 10) || ' e ' || (length('passage: ' || p_name || p_brand) - length(replace('passage: ' || p_name || p_brand, 'e', ''))) ELSE pairs END AS vector
FROM part LEFT JOIN lacking ON d = p_type LEFT JOIN v ON id = p_brand""")
def dense_vectors(spark, sf):
    """A model's vectors, and hash vectors for every row of a document where the model lacks one."""
    p = _t(spark, sf, "part").select("p_partkey", "p_type", F.concat_ws(" ", "p_name", "p_brand").alias("text"), F.array(F.lit("p")).alias("toks"))
    e = vectorize.encode(p, "text", "toks", _fake_model, doc_col="p_type")
    dense = F.concat_ws(" ", F.lit("len"), F.col("vector")[0].cast("int").cast("string"), F.lit("e"), F.col("vector")[1].cast("int").cast("string"))
    return e.select("p_partkey", F.col("vector_source").alias("source"), F.when(F.col("vector_source") == "chunk_dense", dense).otherwise(_pairs(F.col("vector"))).alias("vector"))


@query("SELECT p_partkey, length(p_brand) + 9 AS n, 'table_dense' AS source FROM part WHERE p_brand NOT LIKE '%3' UNION ALL SELECT p_partkey, 384, 'table_hash_fallback' FROM part WHERE p_brand LIKE '%3'")
def unique_vectors(spark, sf):
    """Each brand's text is encoded once and joined back to its parts."""
    p = _t(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("text"), F.array("p_brand").alias("toks"))
    e = vectorize.encode_unique(p, ["p_partkey"], "text", "toks", model=_fake_model, kind="table")
    dense = F.col("vector_source") == "table_dense"
    return e.select("p_partkey", F.when(dense, F.col("vector")[0].cast("int")).otherwise(F.size("vector")).alias("n"), F.col("vector_source").alias("source"))


@query("SELECT p_partkey, '0=' || p_name || ';1=' || p_brand AS items FROM part")
def registry_items(spark, sf):
    """V19."""
    x = vectorize.registry(F.array("p_name", "p_brand"))
    return _t(spark, sf, "part").select("p_partkey", F.array_join(F.transform(x, lambda y: F.concat_ws("=", y["id"], y["text"])), ";").alias("items"))


_DENSE = f"'Таблица ' || label || '.' || chr(10) || 'Колонки: ' || cols || '.' || chr(10) || body"
_BODY = "string_agg('Строка ' || k || ': key: ' || p_partkey || '; brand: ' || p_brand || '; size: ' || size || '.', chr(10) ORDER BY p_partkey)"


@query(f"""WITH r AS (SELECT p_brand, p_partkey, {_M} || ' m' AS si, p_size || ' мм' AS raw, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part), b AS (SELECT DISTINCT p_brand, substr(p_brand, 7)::INTEGER % 3 AS kind FROM part),
x AS (SELECT b.p_brand, kind, k, p_partkey, CASE WHEN kind = 0 THEN raw ELSE si END AS size FROM b JOIN r ON b.p_brand = r.p_brand),
g AS (SELECT p_brand, kind, CASE WHEN kind = 0 THEN 'raw_t' ELSE '0' END AS label, CASE WHEN kind = 0 THEN 'key: str; brand: str; size: str' ELSE 'key: float64; brand: object; size: float64, единица: m' END AS cols, {_BODY} AS body, count(*) AS n FROM x GROUP BY ALL)
SELECT p_brand AS source_file, CASE WHEN kind = 0 THEN 'raw::t' ELSE 'normalized::0' END AS vector_key, CASE WHEN kind = 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS match_score, n::INTEGER AS n, ['key', 'brand', 'size'] AS header,
md5(CASE WHEN length({_DENSE}) > 4000 THEN rtrim(left({_DENSE}, 4000)) || ' ...' ELSE {_DENSE} END) AS h FROM g""")
def table_entries(spark, sf):
    """Raw tables with the record of the same index; every third brand has none and is read from its Markdown."""
    t = _part_tables(spark, sf)
    kind = F.substring("source_file", F.lit(7), F.lit(9)).cast("int") % 3
    raw = t.select("source_file", F.lit("t").alias("key"), F.lit(0).alias("global_index"), F.regexp_replace("text", "^Intro\n|\nEnd$", "").alias("text"))
    cells = _part_cells(spark, sf)
    columns = normalize.table_columns(cells, "source_file").groupBy("source_file", "table_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "name", "dtype", "unit"))), lambda c: F.struct(c["name"].alias("name"), c["dtype"].alias("dtype"), c["unit"].alias("unit"))).alias("columns"))
    records = normalize.table_records(cells, "source_file").join(columns, ["source_file", "table_index"]).filter(kind != 0)
    e = vectorize.table_entries(raw, records, "source_file")
    return e.select("source_file", "vector_key", "match_score", F.size("rows").alias("n"), "header", F.md5(F.col("table_text").cast("binary")).alias("h"))


@query(f"""WITH r AS (SELECT p_brand, p_partkey FROM part) SELECT p_brand AS source_file, ['key', 'brand', 'dtype:str', 'dtype:int', 'unit:m'] || flatten(list([p_partkey::VARCHAR, '$' || p_brand || '$'] ORDER BY p_partkey)) AS tokens, count(*)::INTEGER AS formulas, md5(string_agg('| ' || p_partkey || ' | $' || p_brand || '$ |', chr(10) ORDER BY p_partkey)) AS h FROM r GROUP BY p_brand""")
def table_texts(spark, sf):
    """V4, V6, V7: a table's tokens, formulas and Markdown."""
    r = _t(spark, sf, "part").groupBy(F.col("p_brand").alias("source_file")).agg(F.transform(F.array_sort(F.collect_list("p_partkey")), lambda k: k.cast("string")).alias("ks"))
    r = r.withColumn("rows", F.transform("ks", lambda k: F.array(k, F.concat(F.lit("$"), F.col("source_file"), F.lit("$")))))
    names, dtypes, units = (F.array(*map(F.lit, x)) for x in (("key", "brand"), ("str", "int"), (None, "m")))
    body = F.array_join(F.slice(F.split(vectorize.to_markdown(names, F.col("rows")), "\n"), 3, F.size("ks")), "\n")
    return r.select("source_file", vectorize.table_tokens(names, dtypes, units, F.col("rows")).alias("tokens"), F.size(F.filter(vectorize.table_formulas(names, F.col("rows")), lambda f: (f["column"] == "brand") & (F.size(f["tokens"]) > 0))).alias("formulas"), F.md5(body.cast("binary")).alias("h"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 0 END AS table_index, CASE WHEN p_partkey % 2 = 0 THEN 1.0 END::DOUBLE AS match_score FROM part")
def table_fuzzy(spark, sf):
    """Without an index, the record whose text is like enough; an odd part's table is nothing like its record."""
    p = _t(spark, sf, "part")
    text = F.concat(F.lit("key|name\n"), F.col("p_partkey").cast("string"), F.lit("|"), F.col("p_name"))
    raw = p.select(F.col("p_partkey").alias("d"), F.lit("0").alias("key"), F.lit(None).cast("int").alias("global_index"), F.when(F.col("p_partkey") % 2 == 0, F.concat(text, F.lit(" "))).otherwise("?").alias("text"))
    m = vectorize.match_tables(raw, p.select(F.col("p_partkey").alias("d"), F.lit(0).alias("table_index"), text.alias("text")), "d")
    return m.select(F.col("d").alias("p_partkey"), "table_index", F.round("match_score", 1).alias("match_score"))


_CHUNK = "сталь и свойство: Nb"


def _replies(spark, sf):
    """A replayed extraction: orders as chunks, customers and priorities as entities. Every third chunk alone says which
    entities there are, so a relation may come before its ends; relations fail each rule in turn."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    k, c, none = F.col("o_orderkey"), F.col("o_custkey") % 97, F.expr("cast(array() as array<struct<name:string,type:string,description:string,aliases:array<string>,evidence:string>>)")
    a, b = F.concat(F.lit("Сталь "), c), F.concat(F.lit("Свойство "), F.left("o_orderpriority", F.lit(1)))
    ent = lambda n, t, d, al: F.struct(n.alias("name"), F.lit(t).alias("type"), d.alias("description"), al.alias("aliases"), F.lit("").alias("evidence"))
    late = F.when(k % 9 == 0, F.concat(F.lit("chunk "), k)).otherwise("")
    ents = F.when(k % 3 == 0, F.array(ent(a, "материал", late, F.array(F.concat(F.lit("a"), k % 5))), ent(b, "свойство", F.lit(""), F.array(F.lit(""))), ent(F.lit("steel"), "материал", F.lit(""), F.array(F.lit(""))))).otherwise(none)
    quote = F.when(k % 11 == 1, "").when(k % 11 == 2, F.repeat(F.lit("x"), 201)).when(k % 11 == 3, "неверно").otherwise("Сталь и  свойство")
    rel = F.struct(a.alias("source"), F.when(k % 11 == 4, a).otherwise(b).alias("target"), F.when(F.col("o_orderstatus") == "O", "влияет на").when(F.col("o_orderstatus") == "F", "ТРЕБУЕТ").otherwise("НЕТ").alias("type"), quote.alias("quote"), (k % 4 + 1).cast("int").alias("weight"))
    return o.select(F.lit("orders").alias("source_file"), k.alias("chunk_index"), F.lit(_CHUNK).alias("text"), ents.alias("entities"), F.array(rel).alias("relations"))


_SAID = "SELECT o_orderkey AS k, 'Сталь ' || (o_custkey % 97) AS a, 'Свойство ' || left(o_orderpriority, 1) AS b, CASE o_orderstatus WHEN 'O' THEN 'ВЛИЯЕТ_НА' WHEN 'F' THEN 'ТРЕБУЕТ' ELSE 'НЕТ' END AS type, o_orderkey % 4 + 1 AS w FROM orders"
_NODE = "'N' || left(sha1({t} || '::' || {x}), 16)"
_GATED = f"""said AS ({_SAID}), first_a AS (SELECT a, min(k) AS k FROM said WHERE k % 3 = 0 GROUP BY a), first_b AS (SELECT b, min(k) AS k FROM said WHERE k % 3 = 0 GROUP BY b),
gated AS (SELECT said.*, {_NODE.format(t="'МАТЕРИАЛ'", x='said.a')} AS src, CASE WHEN said.k % 11 = 4 THEN {_NODE.format(t="'МАТЕРИАЛ'", x='said.a')} ELSE {_NODE.format(t="'СВОЙСТВО'", x='said.b')} END AS dst,
CASE WHEN type = 'НЕТ' THEN 'type' WHEN w < 2 THEN 'weight' WHEN said.k % 11 = 1 THEN 'no_quote' WHEN said.k % 11 = 2 THEN 'long_quote' WHEN said.k % 11 = 3 THEN 'unsupported' WHEN first_a.k IS NULL OR first_a.k > said.k THEN 'source' WHEN said.k % 11 <> 4 AND (first_b.k IS NULL OR first_b.k > said.k) THEN 'target' WHEN said.k % 11 = 4 THEN 'self_loop' END AS reason
FROM said LEFT JOIN first_a ON said.a = first_a.a LEFT JOIN first_b ON said.b = first_b.b)"""
_EDGES = f"""{_GATED}, kept AS (SELECT *, least(src, dst) AS u, greatest(src, dst) AS v FROM gated WHERE reason IS NULL), starts AS (SELECT u, v, type, min(k) AS k0 FROM kept GROUP BY u, v, type),
runs AS (SELECT kept.*, (SELECT count(*) FROM starts s WHERE s.u = kept.u AND s.v = kept.v AND s.k0 <= kept.k) AS run FROM kept), peaks AS (SELECT *, max(w) OVER (PARTITION BY u, v, run ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM runs),
edges AS (SELECT u, v, max_by(type, run * 1000000000 - CASE WHEN before IS NULL THEN 0 ELSE 1 END) AS relation, max_by(w, run * 1000 + w) AS weight, count(*)::INTEGER AS relations, count(*) FILTER (before IS NULL)::INTEGER AS added, count(*) FILTER (w > before)::INTEGER AS updated FROM peaks GROUP BY u, v)"""


@query(f"""WITH said AS ({_SAID}), e AS (SELECT k, a AS label, 'МАТЕРИАЛ' AS t, CASE WHEN k % 9 = 0 THEN 'chunk ' || k ELSE '' END AS description, 'a' || (k % 5) AS alias FROM said WHERE k % 3 = 0 UNION ALL SELECT k, b, 'СВОЙСТВО', '', NULL FROM said WHERE k % 3 = 0)
SELECT {_NODE.format(t='t', x='label')} AS node_id, t AS node_type, label, coalesce(min_by(description, k) FILTER (description <> ''), '') AS description, coalesce(string_agg(DISTINCT alias, '; ' ORDER BY alias), '') AS aliases FROM e GROUP BY t, label""")
def graph_nodes(spark, sf):
    """Nodes with their first description and the union of their aliases."""
    return pipeline.graph_of(_replies(spark, sf))[0].select("node_id", "node_type", "label", "description", "aliases")


@query(f"WITH {_EDGES} SELECT u, v, relation, weight, relations, added, updated FROM edges")
def graph_edges(spark, sf):
    """every edge."""
    return pipeline.graph_of(_replies(spark, sf))[1].select("u", "v", "relation", F.col("weight").cast("long").alias("weight"), "relations", "added", "updated")


@query(f"WITH {_GATED} SELECT k, CASE WHEN reason IN ('source', 'self_loop') OR reason IS NULL OR reason = 'target' THEN coalesce(reason, 'kept') ELSE reason END AS reason, CASE WHEN reason IS NULL THEN src END AS source_id, CASE WHEN reason IS NULL THEN dst END AS target_id FROM gated")
def graph_gate(spark, sf):
    """Each relation's ends, as of its chunk, or the first rule it fails."""
    g = pipeline.graph_of(_replies(spark, sf))[2]
    kept = F.col("drop_reason").isNull()
    return g.select(F.col("seq.chunk_index").alias("k"), F.coalesce("drop_reason", F.lit("kept")).alias("reason"), F.when(kept, F.col("source_id")).alias("source_id"), F.when(kept, F.col("target_id")).alias("target_id"))


@query(f"WITH {_GATED} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM gated GROUP BY 1")
def graph_drop_reasons(spark, sf):
    return pipeline.graph_of(_replies(spark, sf))[2].groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {_GATED} SELECT count(*) AS n, count(DISTINCT src) AS sources, count(DISTINCT dst) AS targets, (SELECT count(*) FROM (SELECT {_NODE.format(t="'МАТЕРИАЛ'", x='a')} FROM said WHERE k % 3 = 0 UNION SELECT {_NODE.format(t="'СВОЙСТВО'", x='b')} FROM said WHERE k % 3 = 0
UNION SELECT {_NODE.format(t="'КОНЦЕПЦИЯ'", x='said.a')} FROM said LEFT JOIN first_a ON said.a = first_a.a WHERE w >= 2 AND said.k % 11 NOT IN (1, 2, 3) AND (first_a.k IS NULL OR first_a.k > said.k)
UNION SELECT {_NODE.format(t="'КОНЦЕПЦИЯ'", x='said.b')} FROM said LEFT JOIN first_b ON said.b = first_b.b WHERE w >= 2 AND said.k % 11 NOT IN (1, 2, 3, 4) AND (first_b.k IS NULL OR first_b.k > said.k))) AS nodes
FROM (SELECT gated.k, CASE WHEN first_a.k <= gated.k THEN {_NODE.format(t="'МАТЕРИАЛ'", x='gated.a')} ELSE {_NODE.format(t="'КОНЦЕПЦИЯ'", x='gated.a')} END AS src, CASE WHEN first_b.k <= gated.k THEN {_NODE.format(t="'СВОЙСТВО'", x='gated.b')} ELSE {_NODE.format(t="'КОНЦЕПЦИЯ'", x='gated.b')} END AS dst
FROM gated LEFT JOIN first_a ON gated.a = first_a.a LEFT JOIN first_b ON gated.b = first_b.b WHERE type <> 'НЕТ' AND w >= 2 AND gated.k % 11 NOT IN (1, 2, 3, 4))""")
def graph_created(spark, sf):
    """unresolved ends become nodes of the default type."""
    n, _, g = pipeline.graph_of(_replies(spark, sf), graph.Ontology(strict_types=False, drop_unresolved=False, relation_types=("ВЛИЯЕТ_НА", "ТРЕБУЕТ"), default_relation_type="НЕТ", least_weight=2))
    kept = g.filter("drop_reason is null and type <> 'НЕТ'")
    return kept.agg(F.count("*").alias("n"), F.count_distinct("source_id").alias("sources"), F.count_distinct("target_id").alias("targets")).crossJoin(n.filter("label <> 'steel'").agg(F.count("*").alias("nodes")))


@query(f"""WITH {_EDGES}, e AS (SELECT k, a, b FROM said WHERE k % 3 = 0), nodes AS (SELECT DISTINCT 'МАТЕРИАЛ' AS t, a FROM e UNION ALL SELECT DISTINCT 'СВОЙСТВО', b FROM e),
m AS (SELECT 'nodes_by_type' AS metric, t AS key, count(*)::DOUBLE AS value FROM nodes GROUP BY t UNION ALL SELECT 'edges_by_type', relation, count(*) FROM edges GROUP BY relation UNION ALL SELECT 'counter', 'total_nodes', count(*) FROM nodes UNION ALL SELECT 'counter', 'total_edges', count(*) FROM edges
UNION ALL SELECT 'counter', 'relations_added', sum(added) FROM edges UNION ALL SELECT 'counter', 'relations_updated', sum(updated) FROM edges UNION ALL SELECT 'counter', 'chunks_processed', count(*) FROM said UNION ALL SELECT 'counter', 'llm_entities_returned', count(*) * 3 FROM e
UNION ALL SELECT 'counter', 'dropped_invalid_entity', count(*) FROM e UNION ALL SELECT 'counter', 'dropped_duplicate_relation', sum(relations - added) FROM edges UNION ALL SELECT 'counter', 'dropped_total', (SELECT count(*) FROM e) + (SELECT sum(relations - added) FROM edges) + (SELECT count(*) FROM gated WHERE reason IS NOT NULL)
UNION ALL SELECT 'acceptance', 'all', count(*) FILTER (reason IS NULL) / count(*) FROM gated UNION ALL SELECT 'entities_per_chunk', 'all', (SELECT count(*) * 3 FROM e) / count(*) FROM said UNION ALL SELECT 'relations_per_chunk', 'all', (SELECT sum(added) FROM edges) / count(*) FROM said)
SELECT metric, key, round(value, 6)::DOUBLE AS value FROM m""")
def graph_metrics(spark, sf):
    """Totals, counts by type, rates per chunk."""
    replies = _replies(spark, sf)
    n, e, g = pipeline.graph_of(replies)
    m = graph.metrics(n, e, g, replies, graph.entities(replies))
    of = ["total_nodes", "total_edges", "relations_added", "relations_updated", "chunks_processed", "llm_entities_returned", "dropped_invalid_entity", "dropped_duplicate_relation", "dropped_total"]
    return m.filter((F.col("metric") != "dropped") & ((F.col("metric") != "counter") | F.col("key").isin(of))).select("metric", "key", F.round("value", 6).alias("value"))


@query(f"WITH {_EDGES} SELECT count(*) AS n FROM (SELECT u FROM edges UNION SELECT v FROM edges)")
def graph_isolates(spark, sf):
    n, e, _ = pipeline.graph_of(_replies(spark, sf))
    return graph.without_isolates(n, e).agg(F.count("*").alias("n"))


@query("SELECT conv_id, turn, md5('types: A, B; text: ' || left(trim(CASE WHEN turn % 2 = 0 OR text IS NULL THEN coalesce(text, '') ELSE 'dense ' || text END, ' ' || chr(10) || chr(9) || chr(13)), 300)) AS h FROM conversations")
def prompts(spark, sf):
    """A prompt with a chunk's dense text, or its text where that is empty, cut at 300 characters."""
    dense = F.when(F.col("turn") % 2 == 0, "").otherwise(F.concat(F.lit("dense "), F.col("text")))
    p = graph.render_prompt(F.lit("types: {entity_types}; text: {chunk_text}"), {"entity_types": F.lit("A, B"), "chunk_text": graph.chunk_text(dense, F.col("text"), 300)})
    return _t(spark, sf, "conversations").select("conv_id", "turn", F.md5(p.cast("binary")).alias("h"))


def _quoting_reply(text):
    """A cut-off reply whose one whole relation quotes the text between guillemets, escaped as JSON."""
    quote = F.to_json(F.array(F.concat(F.lit("«"), F.coalesce(text, F.lit("")), F.lit("»"))))
    return F.concat(F.lit('```\n[["E","Nb","ХИМИЧЕСКИЙ_ЭЛЕМЕНТ","","",""],["R","Nb","X","ВЛИЯЕТ_НА",'), quote.substr(F.lit(2), F.length(quote) - 2), F.lit(',3]] ["R","Nb","unfinished'))


@query("SELECT conv_id, turn, 1 AS entities, 1 AS relations, 'Nb' AS name FROM conversations")
def parse_llm_output(spark, sf):
    """Counts the relations whose parsed quote is the whole text again."""
    p = _t(spark, sf, "conversations").select("conv_id", "turn", "text", graph.parsed(_quoting_reply(F.col("text"))).alias("p"))
    whole = F.filter("p.relations", lambda r: r["quote"] == F.concat(F.lit("«"), F.coalesce("text", F.lit("")), F.lit("»")))
    return p.select("conv_id", "turn", F.size("p.entities").alias("entities"), F.size(whole).alias("relations"), F.element_at("p.entities", 1)["name"].alias("name"))


@query()
def text_pipeline(spark, sf):
    """Documents through clearing, normalization, chunking and tokenization to TF-IDF vectors per document."""
    d = _docs(spark, sf).select(F.col("doc_id").cast("string").alias("source_file"), "text")
    return pipeline.vectors(pipeline.text_stages(d))


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
