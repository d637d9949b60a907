"""Secret scans (operator 9): patterns, and sliding-window Shannon entropy per character class.

DataFrame functions only. A candidate string is a maximal run of token characters of at least MIN_CANDIDATE;
its class (hex, mixed, alpha, lower) sets the entropy that some window of WINDOW characters must reach. Entropy comes
from counts that change by one character in and one out as the window slides: the sum of c*log2(c) is kept, not
recomputed. Parts of a candidate that LITERAL matches are left out, and what stands between them is judged by itself;
one such stretch that is neither short, nor a word or number (ALLOW), makes the whole candidate a span. Candidates that
a pattern's span overlaps are suppressed.

Defined results: null text is empty, with no spans; repeated rows and null ids give rows of their own; empty
tables give no rows; other columns of the input are not read by scan().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which equal starts are listed: pattern, group whose length counts, least length.
BASE = {
    "assign": (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
KINDS = [*BASE, "entropy"]
#: A cheap test that every text with a surviving match of the kind passes.
MAYBE = {"assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
MIN_CANDIDATE, WINDOW = 20, 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Bits that a window must reach, by class. Twenty different characters make log2(20) = 4.32. Of random keys of 20
#: upper-case letters 99 % reach 3.2 bits, of mixed-case ones more; lower is for lower-case letters that aren't words.
LEAST_BITS = {"hex": 3.0, "mixed": 3.6, "alpha": 3.2, "lower": 4.1}
#: Words of lower-case letters but for a capital at their start, and numbers.
ALLOW = r"^[A-Z]?[a-z]+(?:[-_/=+][A-Z]?[a-z]+)*$|^[0-9+/_=-]+$"
#: Parts between separators that hold a placeholder or one character eight times, and such runs of separators.
LITERAL = r"(?i)[+/_=-]?(?<![a-z0-9])[a-z0-9]*?(?:example|sample|dummy|placeholder|changeme|x{6}|0123456789|abcdefgh|([a-z0-9])\1{7})[a-z0-9]*[+/_=-]?|([+/_=-])\2{7,}"


#: A sign by which the text between matches is split, and how many matches are summed up at a time.
SIGN, STEP = "\ue004", 256


def _found(text: Column, pattern: str, group: int) -> Column:
    """array<struct<start, end, size>> of the pattern's matches, leftmost and not overlapping: Spark gives no
    offsets, but the gaps between matches and the matches themselves fill the text. Lengths are summed up within runs of
    STEP matches, and over the runs, so texts with many matches are not copied match by match."""
    cut = F.when(text.contains(SIGN), F.split(text, pattern, -1)).otherwise(F.split(F.regexp_replace(text, pattern, SIGN), SIGN, -1))
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x)) if group else whole
    steps = F.transform(F.arrays_zip(F.transform(cut, lambda x: F.length(x)).alias("gap"), whole.alias("n"), sizes.alias("size")), lambda x: F.struct(x["gap"], x["n"], x["size"]))
    none = F.expr("cast(array() as array<struct<start:int,end:int,size:int>>)")

    def run(xs):
        """Of some matches in a row: their places from the run's start, and where that ends."""
        one = lambda at, x: F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["n"]).alias("end"), x["size"].alias("size"))
        return F.aggregate(xs, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, x: F.struct((acc["at"] + x["gap"] + x["n"]).alias("at"), F.concat(acc["out"], F.array(one(acc["at"], x))).alias("out")))

    def placed(xs):
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / STEP).cast("int")), lambda k: run(F.slice(xs, k * STEP + 1, STEP)))
        nested = F.expr("cast(array() as array<array<struct<start:int,end:int,size:int>>>)")
        move = lambda acc, r: F.transform(r["out"], lambda m: F.struct((m["start"] + acc["at"]).alias("start"), (m["end"] + acc["at"]).alias("end"), m["size"].alias("size")))
        return F.aggregate(runs, F.struct(F.lit(0).alias("at"), nested.alias("out")), lambda acc, r: F.struct((acc["at"] + r["at"]).alias("at"), F.concat(acc["out"], F.array(move(acc, r))).alias("out")), lambda acc: F.flatten(acc["out"]))

    matches = F.filter(steps, lambda x: x["n"].isNotNull())
    return F.element_at(F.transform(F.array(matches), lambda xs: F.when(F.size(xs) > 0, placed(xs)).otherwise(none)), 1)


def _term(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))


def peak_entropy(s: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of any window characters of s in a row (ASCII; shorter s: null)."""

    def step(acc, i):
        codes = acc["codes"]
        new, old = F.element_at(codes, i), F.when(i > window, F.element_at(codes, F.greatest(i - window, F.lit(1)))).otherwise(F.lit(-1))
        c_new, c_old = F.element_at(acc["n"], new + 1), F.when(old >= 0, F.element_at(acc["n"], F.greatest(old, F.lit(0)) + 1)).otherwise(F.lit(0))
        total = F.when(new == old, acc["sum"]).otherwise(acc["sum"] + _term(c_new + 1) - _term(c_new) + F.when(old >= 0, _term(c_old - 1) - _term(c_old)).otherwise(0.0))
        counts = F.transform(acc["n"], lambda c, k: c + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0))
        bits = F.when(i >= window, F.lit(math.log2(window)) - total / window)
        return F.struct(codes.alias("codes"), counts.alias("n"), total.alias("sum"), F.greatest(acc["best"], bits).alias("best"))

    zero = F.struct(F.transform(F.split(s, ""), lambda c: F.ascii(c)).alias("codes"), F.array_repeat(F.lit(0), 128).alias("n"), F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("best"))
    return F.when(F.length(s) >= window, F.aggregate(F.sequence(F.lit(1), F.length(s)), zero, step, lambda acc: acc["best"]))


def _at_least(least: int):
    return lambda m: m["size"] >= least


def _named(kind: str):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"))


def scan(docs: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """Adds out_col: array<struct<start, rank, end, kind>> of all spans (code points, end exclusive), by start
    and then kind as in KINDS."""
    names = {k: f"__{k}" for k in KINDS}
    empty = F.expr("cast(array() as array<struct<start:int,end:int,size:int>>)")
    # the row in a struct, so that its columns' names clash with none here
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    for k, (pattern, group, least) in BASE.items():
        found = _found(F.col("__text"), pattern if k != "hex" else "[0-9a-f]{24,}", group)
        df = df.withColumn(names[k], F.when(F.col("__text").rlike(MAYBE[k]), F.filter(found, _at_least(least))).otherwise(empty))
    runs = F.when(F.col("__text").rlike(CANDIDATE), _found(F.col("__text"), CANDIDATE, 0)).otherwise(empty)
    df = df.withColumn("__runs", runs)
    taken = F.concat(*(F.col(names[k]) for k in BASE))

    def with_text(m):
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["size"].alias("size"), F.substring(F.col("__text"), m["start"] + 1, m["size"]).alias("s"))

    def secret(s):
        least = F.when(s.rlike("^[0-9a-fA-F]+$"), LEAST_BITS["hex"]).when(s.rlike("[0-9]") & s.rlike("[A-Za-z]"), LEAST_BITS["mixed"]).when(s.rlike("[A-Z]"), LEAST_BITS["alpha"]).otherwise(LEAST_BITS["lower"])
        return ~s.rlike(ALLOW) & (peak_entropy(s) >= least)

    def suspicious(m):
        free = ~F.exists(taken, lambda t: (t["start"] < m["end"]) & (m["start"] < t["end"]))
        return free & F.exists(F.filter(F.split(m["s"], LITERAL, -1), lambda s: F.length(s) >= WINDOW), secret)

    df = df.withColumn(names["entropy"], F.when(F.size("__runs") > 0, F.transform(F.filter(F.transform("__runs", with_text), suspicious), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["size"].alias("size")))).otherwise(empty))
    each = [F.transform(F.col(names[k]), _named(k)) for k in KINDS]
    return df.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c != out_col], F.array_sort(F.concat(*each)).alias(out_col))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document. No shuffle."""
    df = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), out_col="all")
    count = lambda k: F.size(F.filter("all", lambda m: m["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("all", lambda m: m["kind"] != "entropy")
    return df.select("doc_id", *(count(k) for k in BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replaces each run of overlapping spans by a mark; all other text and columns stay, whatever their names."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("t"))
    t, spans = F.col("t"), F.col("spans")

    def parts(ms):
        """Spans that begin a run, each with the end of the run before it; then what stands between runs."""
        reach = F.aggregate(ms, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<from:int,start:int>>)").alias("out")), lambda acc, m: F.struct(
            F.greatest(acc["at"], m["end"]).alias("at"), F.when(m["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(acc["at"].alias("from"), m["start"].alias("start"))))).alias("out")))
        return F.element_at(F.transform(F.array(reach), lambda r: F.concat(F.array_join(F.transform(r["out"], lambda x: F.concat(F.substring(t, x["from"] + 1, x["start"] - x["from"]), F.lit(mark))), ""), t.substr(r["at"] + 1, F.length(t)))), 1)

    done = F.when(F.size(spans) > 0, F.element_at(F.transform(F.array(spans), parts), 1)).otherwise(t)
    held = scan(rows, "t", "spans").withColumn("done", done)
    return held.select(*[F.col("done").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
