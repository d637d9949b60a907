"""Chat formatting (operator 7): quotation linking. DataFrame functions only.

A message's lines have a quote level, the number of `>` before them. Runs of lines of one level are passages. Passages
of level 1 or more, and their single lines, are normalised (lower case, punctuation and white space to one space) and
hashed; so are the unquoted passages and lines of all messages. A quoted hash belongs to the latest earlier message of the
conversation that holds it unquoted: originals and quotations are laid in one order by turn, and the last original
before each quotation is carried forward, which pairs each quotation with one original however often a line occurs.
A message replies to the original that most of its outermost quoted text comes from; without one it follows the turn
before it. Threads (root, depth) follow from those links by pointer doubling. Bodies come without quotes and without
the line that announces one ("... wrote:").

Defined results: null text is empty; rows without conv_id or turn stand alone (link `none`, no position); rows of one turn are
told apart by role and text only in `position`, and equal ones take any order; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUOTE = r"^[ \t]*((?:>[ \t]?)+)"
ANNOUNCES = r"(?i)^.{0,200}\b(wrote|writes|schrieb|escribió|a écrit)[ \t]*:[ \t]*$"
MOST_ROUNDS = 40


def normal(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), r"(?U)[^\w]+", " "))


def passages(text: Column) -> Column:
    """array<struct<level, text>>: runs of lines of one quote level, empty lines between passages. Each line is copied once."""
    line = lambda x: F.struct(
        (F.length(F.regexp_extract(x, QUOTE, 1)) - F.length(F.regexp_replace(F.regexp_extract(x, QUOTE, 1), ">", ""))).alias("level"),
        F.rtrim(F.regexp_replace(x, QUOTE, "")).alias("text"),
    )
    lines = F.transform(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n"), "\n"), line)
    # passages begin at lines with text whose neighbour before is empty or of another level, and end where the next begins
    def cut(ls):
        at = F.sequence(F.lit(1), F.size(ls))
        full = lambda i: F.length(F.trim(F.element_at(ls, i)["text"])) > 0
        alike = lambda i, j: F.element_at(ls, i)["level"] == F.element_at(ls, j)["level"]
        starts = F.filter(at, lambda i: full(i) & ~F.coalesce(F.when(i > 1, full(F.greatest(i - 1, F.lit(1))) & alike(F.greatest(i - 1, F.lit(1)), i)), F.lit(False)))
        ends = F.filter(at, lambda i: full(i) & ~F.coalesce(F.when(i < F.size(ls), full(F.least(i + 1, F.size(ls))) & alike(F.least(i + 1, F.size(ls)), i)), F.lit(False)))
        return F.zip_with(starts, ends, lambda s, e: F.struct(F.element_at(ls, s)["level"].alias("level"), F.array_join(F.transform(F.slice(ls, s, e - s + 1), lambda x: x["text"]), "\n").alias("text")))

    return F.element_at(F.transform(F.array(lines), cut), 1)


def _hashes(ps: Column) -> Column:
    """Distinct hashes of passages and of their lines, with the passage's level and whether it is whole."""
    whole = F.transform(ps, lambda p: F.struct(normal(p["text"]).alias("t"), p["level"].alias("level"), F.lit(1).alias("whole")))
    lines = F.flatten(F.transform(ps, lambda p: F.transform(F.split(p["text"], "\n"), lambda x: F.struct(normal(x).alias("t"), p["level"].alias("level"), F.lit(0).alias("whole")))))
    full = F.filter(F.concat(whole, lines), lambda x: F.length(x["t"]) > 0)
    return F.array_distinct(F.transform(full, lambda x: F.struct(F.sha2(x["t"].cast("binary"), 256).alias("h"), x["level"].alias("level"), x["whole"].alias("whole"), F.length(x["t"]).alias("n"))))


def body(ps: Column) -> Column:
    """The unquoted passages, without a last line that announces a quotation which follows."""
    at = F.sequence(F.lit(1), F.greatest(F.size(ps), F.lit(1)))
    cut = F.transform(
        F.filter(at, lambda i: F.coalesce(F.try_element_at(ps, i)["level"] == 0, F.lit(False))),
        lambda i: F.when(F.coalesce(F.try_element_at(ps, i + 1)["level"] > 0, F.lit(False)), F.array_join(F.filter(F.split(F.element_at(ps, i)["text"], "\n"), lambda x: ~x.rlike(ANNOUNCES)), "\n")).otherwise(F.element_at(ps, i)["text"]),
    )
    return F.array_join(F.filter(cut, lambda x: F.length(F.trim(x)) > 0), "\n")


def link(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, n_quotes, quote_level, reply_to, link (quote, previous, first, none), thread_root, depth,
    position, body of every message (conv_id, turn, role, text)."""
    m = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", passages(F.col("text")).alias("ps"))
    placed = m.filter("conv_id is not null and turn is not null")
    hashed = placed.select("conv_id", "turn", F.explode(_hashes(F.col("ps"))).alias("x")).select("conv_id", "turn", "x.*")
    # only what some message of the conversation quotes can be an original
    quoted = hashed.filter("level > 0")
    asked = quoted.select("conv_id", "h").distinct()
    originals = hashed.filter("level = 0").join(asked, ["conv_id", "h"], "left_semi").select("conv_id", "h", "turn", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("level"), F.lit(0).alias("n"))
    order = Window.partitionBy("conv_id", "h").orderBy("turn", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = quoted.groupBy("conv_id", "h", "turn").agg(F.lit(0).alias("kind"), F.min("level").alias("level"), F.max("n").alias("n")).union(originals.distinct())
    found = both.withColumn("origin", F.last(F.when(F.col("kind") == 1, F.col("turn")), ignorenulls=True).over(order)).filter("kind = 0 and origin is not null")
    weighed = found.groupBy("conv_id", "turn", "level", "origin").agg(F.sum("n").alias("n"))
    parent = weighed.groupBy("conv_id", "turn").agg(F.min_by("origin", F.struct("level", -F.col("n"), -F.col("origin"))).alias("origin"))
    depth = _threads(parent)
    turns = placed.select("conv_id", "turn").distinct()
    w = Window.partitionBy("conv_id").orderBy("turn")
    before = turns.withColumn("before", F.lag("turn").over(w))
    told = m.join(before.join(depth, ["conv_id", "turn"], "left"), ["conv_id", "turn"], "left")
    spot = F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "body")))
    return told.select(
        "conv_id",
        "turn",
        "role",
        F.size(F.filter("ps", lambda p: p["level"] > 0)).alias("n_quotes"),
        F.coalesce(F.array_max(F.transform("ps", lambda p: p["level"])), F.lit(0)).alias("quote_level"),
        F.coalesce("origin", "before").alias("reply_to"),
        F.when(F.col("origin").isNotNull(), "quote").when(F.col("before").isNotNull(), "previous").when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), "first").otherwise("none").alias("link"),
        F.coalesce("root", "turn").alias("thread_root"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        body(F.col("ps")).alias("body"),
    ).withColumn("position", spot)


def _threads(parent: DataFrame) -> DataFrame:
    """(conv_id, turn, origin, root, depth) from (conv_id, turn, origin): each round doubles how far a pointer has come."""
    from . import common

    scratch = common.Scratch(parent.sparkSession, "threads")
    cur = scratch.save("t0", parent.withColumn("root", F.col("origin")).withColumn("depth", F.lit(1)))
    for k in range(MOST_ROUNDS):
        up = cur.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        if cur.join(up, ["conv_id", "root"], "left_semi").isEmpty():
            return cur
        cur = scratch.save(f"t{k + 1}", cur.join(up, ["conv_id", "root"], "left").select("conv_id", "turn", "origin", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
        scratch.drop(f"t{k}")
    raise RuntimeError("threads did not settle")
