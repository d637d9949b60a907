"""Column functions: rewriting by match, span protection, and Python-like text helpers. All native."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import fixed

OPEN, CLOSE, SIGN = "\ue000", "\ue001", "\ue004"
#: What Python takes for white space; all of it but the blank as ranges of a class.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RANGES = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def small_batches(spark: SparkSession) -> None:
    """Batches for Python of a few MB, whatever the texts' lengths: a worker holds one at a time. A setting of the session, as
    results are computed when they are asked for."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))


def java(text: str) -> str:
    """The text as a literal of a Java pattern."""
    return re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", text)


def alternation(words) -> str:
    return "|".join(java(w) for w in sorted(words, key=len, reverse=True))


def tree(words) -> str:
    """What alternation() of the words matches, in its order, but words that begin alike share their beginning."""
    heads: dict[str, set[str]] = {}
    for w in words:
        heads.setdefault(w[:1], set()).add(w[1:])
    short = "" in heads
    rest = [java(h) + tree(tails) for h, tails in sorted(heads.items()) if h]
    return "" if not rest else f"(?:{'|'.join(rest)})?" if short else rest[0] if len(rest) == 1 else f"(?:{'|'.join(rest)})"


def firsts(words) -> str:
    """A look ahead at what one of the words can begin with; put first, it spares most places the rest of a pattern. Letters
    beyond Latin 1 are one range, as each of them costs every place a step."""
    near, far = (sorted({w[0] for w in words if (w[0] > "\xff") == f}) for f in (False, True))
    return f"(?=[{''.join(near)}{f'{far[0]}-{far[-1]}' if far else ''}])"


#: Looks ahead at a digit and at what formulas begin with, for patterns that begin with one.
DIGIT, MATH_SIGN = r"(?=[0-9])", r"(?=[$\\])"
_ALONE = [u for u in fixed.UNITS if u not in fixed.NOT_ALONE]
#: P6. A number and one of the units, longest first.
NUMUNIT = rf"(?=[-0-9])(?<![0-9A-Za-zА-Яа-яЁё.,\-–—])(-?\d+(?:[.,]\d+)?)\s?{firsts(fixed.UNITS)}({tree(fixed.UNITS)})(?![0-9A-Za-zА-Яа-яЁё])"
UNIT_ALONE = rf"{firsts(_ALONE)}(?<![0-9A-Za-zА-Яа-яЁё])({tree(_ALONE)})(?![0-9A-Za-zА-Яа-яЁё])"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def parts(text: Column, pattern: str) -> Column:
    """What stands before the first match, the match, what stands before the next one, and so on: matches at odd places. One
    pass puts a sign on both sides of each match and the text is split by it, as split() by a pattern makes that anew for each
    row; unless the text has that sign itself."""
    found = lambda: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    apart = F.flatten(F.zip_with(F.split(text, pattern, -1), found(), lambda gap, m: F.when(m.isNull(), F.array(gap)).otherwise(F.array(gap, m))))
    return F.when(text.contains(SIGN), apart).otherwise(F.split(F.regexp_replace(text, pattern, f"{SIGN}$0{SIGN}"), SIGN, -1))


def matches(parts_col: Column) -> Column:
    """The matches of parts()."""
    return F.filter(parts_col, lambda _, k: k % 2 == 1)


def joined(parts_col: Column, change: Callable[[Column, Column], Column]) -> Column:
    """parts() put together again, each match as change(match, its number from 0) has it."""
    return F.array_join(F.transform(parts_col, lambda x, k: F.when(k % 2 == 1, F.coalesce(change(x, F.shiftright(k, 1)), F.lit(""))).otherwise(x)), "")


def rewrite(text: Column, pattern: str, change: Callable[[Column, Column], Column]) -> Column:
    """Replaces each match by change(match, its number from 0). The pattern goes over the text once."""
    return bind(text, lambda t: joined(parts(t, pattern), change))


def rewrite_groups(text: Column, pattern: str, groups: int, change: Callable[..., Column]) -> Column:
    """As rewrite(), but change gets the match's groups, the first so many ("" for one that took no part), and nothing else. The
    pass that finds the matches sets their groups apart, so no pattern goes over a match again."""
    g, step = range(1, groups + 1), groups + 1
    found = lambda t: F.arrays_zip(*(F.regexp_extract_all(t, F.lit(pattern), F.lit(k)).alias(str(k)) for k in g))
    apart = lambda t: F.flatten(F.zip_with(F.split(t, pattern, -1), found(t), lambda gap, m: F.when(m.isNull(), F.array(gap)).otherwise(F.array(gap, *(m[str(k)] for k in g)))))
    quick = lambda t: F.split(F.regexp_replace(t, pattern, "".join(f"{SIGN}${k}" for k in g) + SIGN), SIGN, -1)
    one = lambda ps, x, k: F.when(k % step == 0, x).when(k % step == 1, F.coalesce(change(x, *(ps[k + d] for d in range(1, groups))), F.lit(""))).otherwise("")
    return bind(bind(text, lambda t: F.when(t.contains(SIGN), apart(t)).otherwise(quick(t))), lambda ps: F.array_join(F.transform(ps, lambda x, k: one(ps, x, k)), ""))


def where(text: Column, hints: tuple[str, ...], change: Callable[[Column], Column]) -> Column:
    """change(text) for a text that holds one of the hints; others are left as they are, without a pattern's pass."""
    return bind(text, lambda x: F.when(reduce(or_, (x.contains(h) for h in hints)), change(x)).otherwise(x))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def squeeze(text: Column) -> Column:
    """White space to single spaces, none at the ends. A blank between two words is no match, so that little is copied."""
    return F.btrim(F.regexp_replace(text, f"(?=[^!-~])(?:[{_RANGES}]| (?=[ {_RANGES}]))[ {_RANGES}]*+", " "), F.lit(" "))


def same_words(a: Column, b: Column) -> Column:
    """Whether two texts are the same when squeezed; most that are, are so with their lines in a row."""
    flat = lambda t: F.replace(t, F.lit("\n"), F.lit(" "))
    return (flat(a) == flat(b)) | (squeeze(a) == squeeze(b))


def no_blocks() -> Column:
    return F.expr("cast(array() as array<struct<kind:string,content:string>>)")


def protect(text: Column, blocks: Column, pattern: str, kind: str, block: bool = False, change: Callable[[Column], Column] | None = None) -> tuple[Column, Column]:
    """P1, P2. Each match gives way to a marker with its running number, on a line of its own if block; (text, blocks) with
    the matches added, as change makes them; where that gives null, as they are."""
    first, edge = F.size(blocks), F.lit("\n" if block else "")
    marked = rewrite(text, pattern, lambda m, i: F.concat(edge, F.lit(OPEN), (first + i).cast("string"), F.lit(CLOSE), edge))
    content = lambda m: m if change is None else F.coalesce(change(m), m)
    more = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(F.lit(kind).alias("kind"), content(m).alias("content")))
    return marked, F.when(text.rlike(pattern), F.concat(blocks, more)).otherwise(blocks)


def restore(text: Column, blocks: Column) -> Column:
    """P3. Markers back to what they stand for; a later block may hold an earlier marker. Each pass puts back all markers
    there are at once; what blocks nested more than three deep leave goes one by one, the last first."""
    marker = f"{OPEN}\\d+{CLOSE}"
    once = lambda t: rewrite(t, marker, lambda m, _: F.coalesce(F.try_element_at(blocks, F.substring(m, F.lit(2), F.length(m) - 2).cast("int") + 1)["content"], m))
    numbers = F.when(F.size(blocks) > 0, F.reverse(F.sequence(F.lit(0), F.size(blocks) - 1)))
    each = lambda t: F.aggregate(numbers, t, lambda t, i: F.replace(t, F.concat(F.lit(OPEN), i.cast("string"), F.lit(CLOSE)), F.element_at(blocks, i + 1)["content"]))
    some = lambda t, f: bind(t, lambda x: F.when(x.contains(OPEN), f(x)).otherwise(x))
    return F.when(F.size(blocks) > 0, some(once(some(once(once(text)), once)), each)).otherwise(text)


def with_own(text: Column, blocks: Column) -> Column:
    """struct<text, held>: a text with its markers numbered anew from 0, and what each of them stands for."""
    marker = f"{OPEN}\\d+{CLOSE}"
    held = F.transform(F.regexp_extract_all(text, F.lit(marker), F.lit(0)), lambda m: restore(m, blocks))
    some = text.contains(OPEN)
    marked = F.when(some, rewrite(text, marker, lambda _, i: F.concat(F.lit(OPEN), i.cast("string"), F.lit(CLOSE)))).otherwise(text)
    return F.struct(marked.alias("text"), F.when(some, held).otherwise(F.expr("cast(array() as array<string>)")).alias("held"))


def put_back(text: Column, held: Column) -> Column:
    """The markers of with_own back to what they stand for."""
    back = rewrite(text, f"{OPEN}\\d+{CLOSE}", lambda m, _: F.coalesce(F.try_element_at(held, F.substring(m, F.lit(2), F.length(m) - 2).cast("int") + 1), m))
    return F.when(text.contains(OPEN), back).otherwise(text)


def is_protected(text: Column) -> Column:
    """P7."""
    return text.rlike(fixed.PROTECTED)


def lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def number_text(x: Column) -> Column:
    """N12. A number as text with a decimal comma: 0, exponents for the very large and small, else ten decimals less zeros. A
    whole number needs no format."""
    def said(v):
        plain = F.rtrim(F.rtrim(F.format_string("%.10f", v), F.lit("0")), F.lit("."))
        some = F.replace(F.when((F.abs(v) >= 1e15) | (F.abs(v) < 1e-9), F.format_string("%e", v)).otherwise(plain), F.lit("."), F.lit(","))
        return F.when((F.abs(v) < 1e15) & (F.rint(v) == v), v.cast("long").cast("string")).otherwise(some)

    return bind(x, said)


def number_of(text: Column) -> Column:
    """A number with a decimal comma or dot; null if it is none."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def is_table_row(line: Column) -> Column:
    """C7. Two pipes or more, and nothing protected."""
    return line.contains("|") & line.rlike(r"\|[^\n]*\|") & ~is_protected(line)


def is_separator(line: Column) -> Column:
    return line.rlike(r"^[ \t]*\|?[ \t:|-]*-[ \t:|-]*$") & line.contains("|")


def cells(line: Column) -> Column:
    """C7. The cells of a row: split at pipes without a backslash, outer pipes off, `\\|` to `|`."""
    inner = F.regexp_replace(F.regexp_replace(strip(line), r"^\|", ""), r"(?<!\\)\|$", "")
    return F.transform(F.split(inner, fixed.CELL_SPLIT, -1), lambda c: F.replace(strip(c), F.lit("\\|"), F.lit("|")))
