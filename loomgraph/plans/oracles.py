"""DuckDB SQL that more than one query is held against: the steps of clearing over whole documents, a CRC, and helpers."""

from __future__ import annotations

from ..functions import fixed as V

#: What Python takes for white space, and stand-ins for set-aside math and tables.
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"
MATH, TABLE = "chr(57344)", "chr(57345)"


def q(text: str) -> str:
    """A string literal, whatever is in the text."""
    return " || ".join("'" + part.replace("'", "''") + "'" if k == 0 else "chr(10) || '" + part.replace("'", "''") + "'" for k, part in enumerate(text.split("\n")))


def sub(x: str, pattern: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, '{pattern}', {by}, '{flags}')"


def inline_markup(x: str) -> str:
    for p in (r"`([^`\n]*)`", r"\*\*([^*\n]+)\*\*", r"~~([^~\n]+)~~", r"\\([^\w\s])"):
        x = sub(x, p, r"'\1'")
    return x


def rows(table: str, key: str, text: str) -> str:
    """CTEs `lines`, `seg` and `blocks` over table(key, text): the Markdown tables in it, each cell made clean."""
    cell = f"trim({sub(inline_markup('c'), '[ ' + chr(92) + 't]+', chr(39) + ' ' + chr(39))}, {WHITE})"
    bare = f"trim(l, {WHITE})"
    cells = f"string_split(regexp_replace(regexp_replace({bare}, '^\\|', ''), '\\|$', ''), '|')"
    dashes = f"'| ' || array_to_string(list_transform({cells}, lambda c: '---'), ' | ') || ' |'"
    cleaned = f"'| ' || array_to_string(list_transform({cells}, lambda c: {cell}), ' | ') || ' |'"
    return f"""lines AS (SELECT {key} AS d, unnest(string_split({text}, chr(10))) AS l, generate_subscripts(string_split({text}, chr(10)), 1) AS k FROM {table}),
flagged AS (SELECT *, length(l) - length(replace(l, '|', '')) >= 2 AND NOT contains(l, {MATH}) AS is_row, trim(l, {WHITE}) = '' AS blank FROM lines),
counted AS (SELECT *, count(*) FILTER (NOT is_row AND NOT blank) OVER (PARTITION BY d ORDER BY k) AS s FROM flagged),
seg AS (SELECT *, min(k) FILTER (is_row) OVER (PARTITION BY d, s) AS fr FROM counted),
blocks AS (SELECT d, s, min(k) AS k, string_agg(CASE WHEN regexp_full_match({bare}, '[ |:-]*-[ |:-]*') THEN {dashes} ELSE {cleaned} END, chr(10) ORDER BY k) AS md FROM seg WHERE is_row GROUP BY d, s)"""


def cleaned(source: str) -> str:
    """CTEs ending in `cleaned` (d, text): clearing of source (d, text) from end to end."""
    t = f"string_agg(l, chr(10) ORDER BY k)"
    page = r"^ {0,3}(?:[-–—] ?)?(?:(?:стр\.|страница|с\.|page|p\.) ?)?\d{1,4}(?: ?/ ?\d{1,4})?(?: ?[-–—])?[.]?$"
    steps = "t"
    for p, by in ((r"(?m)^ {0,3}#{1,6}\s+", "''"), (r"(?m)^ {0,3}>\s?", "''"), (r"(?m)^ {0,3}(?:[-*+]|\d+\.)\s+", "''"), (r"(?m)^ {0,3}(?:-{3,}|\*{3,}|_{3,})\s*$", "''")):
        steps = sub(steps, p, by)
    steps = inline_markup(steps)
    for p, by in ((r"(?m)[ \t]+$", "''"), (r"([^\s])[ \t]{3,}", r"'\1 '"), (r"\n{3,}", "chr(10) || chr(10)")):
        steps = sub(steps, p, by)
    back = lambda x, mark, held: f"array_to_string(list_transform(generate_series(1, len(string_split({x}, {mark}))), lambda i: string_split({x}, {mark})[i] || coalesce({held}[i], '')), '')"
    return f"""raw AS ({source}),
marked AS (SELECT d, regexp_extract_all(text, '(?s)\\$\\$.*?\\$\\$') AS math, regexp_replace(text, '(?s)\\$\\$.*?\\$\\$', chr(10) || {MATH} || chr(10), 'g') AS t FROM raw),
{rows('marked', 'd', 't')},
flat AS (SELECT d, k * 4 AS k, l FROM seg WHERE fr IS NULL OR k < fr UNION ALL SELECT d, k * 4 + x, CASE WHEN x = 1 THEN {TABLE} ELSE '' END FROM blocks, (VALUES (0), (1), (2)) AS v(x)),
paged AS (SELECT d, k, {sub(sub('l', '[' + chr(92) + 'x00-' + chr(92) + 'x08' + chr(92) + 'x0B' + chr(92) + 'x0C' + chr(92) + 'x0E-' + chr(92) + 'x1F' + chr(92) + 'x7F]', "''"), page, "''", 'i')} AS l FROM flat),
often AS (SELECT d, trim(l, {WHITE}) AS s FROM paged GROUP BY d, trim(l, {WHITE}) HAVING count(*) >= 6 AND length(s) BETWEEN 1 AND 80 AND s NOT IN ({MATH}, {TABLE}) AND NOT contains(s, {MATH}) AND length(s) - length(replace(s, '|', '')) < 2 AND (length(s) >= 8 OR regexp_matches(s, '[0-9]'))),
kept AS (SELECT p.d, {t} AS t FROM paged p LEFT JOIN often o ON p.d = o.d AND trim(p.l, {WHITE}) = o.s WHERE o.s IS NULL GROUP BY p.d),
plain AS (SELECT d, trim({steps}, {WHITE}) AS t FROM kept),
tables AS (SELECT d, list(md ORDER BY k) AS md FROM blocks GROUP BY d),
tabled AS (SELECT plain.d, {back('plain.t', TABLE, 'tables.md')} AS t FROM plain LEFT JOIN tables ON plain.d = tables.d),
cleaned AS (SELECT raw.d, CASE WHEN coalesce(x.t, '') = '' THEN '' ELSE {back('x.t', MATH, 'marked.math')} || chr(10) END AS text FROM raw JOIN marked ON raw.d = marked.d LEFT JOIN tabled x ON raw.d = x.d)"""


def crc32(x: str) -> str:
    """The CRC-32 of a text's bytes as an expression; crc_table()'s crc must be joined."""
    byte = f"list_transform(string_split(regexp_replace(hex({x}), '(..)', '\\1 ', 'g'), ' ')[:-2], lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"


def crc_table() -> str:
    """CTE `crc` (t): the 256 values, by their rule."""
    step = "k::BIGINT"
    for _ in range(8):
        step = f"list_transform([{step}], lambda v: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)[1]"
    return f"crc AS (SELECT list({step} ORDER BY k) AS t FROM range(256) r(k))"


WORD = V.WORD.replace("'", "''")
