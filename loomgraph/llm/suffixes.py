"""Suffix-array dedup (operator 4): a logarithmic index family finds the long strings that texts share.

0. Copies. Texts are grouped by key, before and after the shuffle, and each distinct one goes on once. One that occurs
   twice or more repeats whole and needs no index; what it shares with other texts still counts for those.
1. Anchors. Of the K-byte strings in a text, those whose hash is the least in some stretch of WIDTH bytes are
   anchors. Equal stretches have equal anchors at equal places, so two equal strings of WIDTH bytes share one.
   An occurrence is (anchor hash, hash of its context, text's key, place); its context is the anchor and, on either
   side, the WIDTH - K bytes that a stretch with it can reach. Four numbers per 60 bytes of text are all that is written.
2. Occurrences (in distinct texts) with the same anchor and context are one entry with a count. If the count is over 1,
   all stretches in the context repeat. If the anchor has other contexts, the bytes of one occurrence of each go to the index.
3. Index. Entries come in batches. Each batch is sorted into a suffix array of its anchors' right sides (and a
   prefix array of their left sides), merge-scanned against each level of the family for common strings of WIDTH
   bytes, and becomes a level; levels of equal size merge. Neighbours' common lengths turn into ranks, and two
   stretches are equal if their left and right ranks are: exact, without comparing pairs.
4. All stretches with an anchor hold it, so the repeated ones cover one interval around it. The intervals go
   back to all occurrences and, by text, to the documents.

Anchors with more contexts than HOT_CONTEXTS don't go to one task's index: their stretches are counted one by one
with partial sums (windows_of), which gives the same answer for any number of contexts.

Defined results: null text is empty; texts under WIDTH bytes match nothing; repeated rows repeat each other in full;
a null doc_id is a document like any other; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WIDTH, K = 200, 64
SIDE = WIDTH - K
BATCH, HOT_CONTEXTS, ENTRIES_PER_TASK = 4096, 20_000, 40_000
U = np.uint64


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    step = 1
    while step < n:  # b^(step..2 step) = b^(0..step) * b^step
        more = min(step, n - step)
        out[step : step + more] = out[:more] * U(pow(base, step, 1 << 64))
        step += more
    return out


INVERSE = pow(common.BASE, -1, 1 << 64)
POWERS = _powers(1 << 16, common.BASE), _powers(1 << 16, INVERSE)


def _prefix(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of byte codes times powers of BASE, and the inverse powers, so that any span's polynomial hash
    is one subtraction, brought to power 0."""
    global POWERS
    if len(POWERS[0]) <= len(data):
        POWERS = _powers(2 * len(data), common.BASE), _powers(2 * len(data), INVERSE)
    codes = common.mix(np.arange(256, dtype=np.uint64) + U(0x1234567))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * POWERS[0][: len(data)], out=sums[1:])
    return sums, POWERS[1]


def _span_hash(sums, inverse, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return common.mix((sums[end] - sums[start]) * inverse[start])


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over each run of width values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = op(x[: len(x) - step], x[step:])
        have += step
    return x


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end (bounds: their starts, and the end): anchors' places, hashes, context hashes and
    how many bytes the context has on the left and right."""
    none = np.empty(0, np.int64)
    if len(data) < WIDTH:
        return none, none, none, none, none
    sums, inverse = _prefix(data)
    h = common.mix((sums[K:] - sums[:-K]) * inverse[: len(data) - K + 1])
    low = _slide(h, SIDE + 1, np.minimum)  # least of the K-strings in the stretch that starts here
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = doc[: len(low)] == doc[WIDTH - 1 : WIDTH - 1 + len(low)]
    reach = np.zeros(len(h) + SIDE, np.uint64)
    reach[SIDE : SIDE + len(low)] = np.where(inside, low, 0)
    most = _slide(reach, SIDE + 1, np.maximum)  # over the stretches that hold the K-string
    p = np.flatnonzero((most == h) & (doc[: len(h)] == doc[K - 1 : K - 1 + len(h)]))
    left = np.minimum(p - bounds[doc[p]], SIDE)
    right = np.minimum(bounds[doc[p] + 1] - p - K, SIDE)
    ctx = _span_hash(sums, inverse, p - left, p + K + right)
    ctx = common.mix(ctx + (left.astype(np.uint64) << U(10)) + right.astype(np.uint64))
    return p, h[p], ctx, left, right


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _occurrences(batches) -> Iterator[pa.RecordBatch]:
    for b in common.slices(batches, 1 << 20):
        data, bounds = _laid_out([x or b"" for x in b.column(1).to_pylist()])
        p, h, ctx, left, right = anchors(data, bounds)
        doc = np.searchsorted(bounds, p, "right") - 1
        more = np.array([zlib.crc32(x or b"") & 0x7FFF for x in b.column(1).to_pylist()], np.int64)
        where = more[doc] << 48 | (p - bounds[doc]) << 16 | left << 8 | right
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(where), pa.array(h.view(np.int64)), pa.array(ctx.view(np.int64))], ["tkey", "at", "anchor", "ctx"])


#: An occurrence's `at`: 15 more bits of its text's key, its place, and the bytes of context on the left and right.
MORE, PLACE, LEFT, RIGHT = "shiftright(at, 48)", "cast(shiftright(at, 16) & 4294967295L as int)", "cast(shiftright(at, 8) & 255 as int)", "cast(at & 255 as int)"


def _contexts(batches) -> Iterator[pa.RecordBatch]:
    """Rows (raw text, wanted: array of places) to (anchor, ctx, left bytes, right bytes)."""
    for b in common.slices(batches, 2 << 20, 0):
        cols: list[list] = [[] for _ in range(5)]
        for raw, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for w in want:
                p, n, m = w["at"] >> 16 & 0xFFFFFFFF, w["at"] >> 8 & 255, w["at"] & 255
                for c, v in zip(cols, (w["anchor"], w["ctx"], raw[p - n : p], raw[p + K : p + K + m], w["hot"])):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()))], ["anchor", "ctx", "l", "r", "hot"])


def _matrix(parts: list[bytes], flip: bool) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of SIDE bytes, and their lengths."""
    sizes = np.array([len(x) for x in parts], np.int64)
    out = np.frombuffer(b"".join([(x[::-1] if flip else x).ljust(SIDE, b"\0") for x in parts]), np.uint8).reshape(-1, SIDE)
    return out, sizes


class Level:
    """Entries in the order of their suffixes: anchor, then right side; with the order by left side beside it."""

    def __init__(self, anchor, left, nleft, right, nright, ident):
        order = np.lexsort((*(right.view(">u8").T[::-1]), anchor))
        self.anchor, self.left, self.nleft, self.right, self.nright, self.ident = anchor[order], left[order], nleft[order], right[order], nright[order], ident[order]

    def __len__(self):
        return len(self.anchor)

    def take(self, keep) -> Level:
        out = object.__new__(Level)
        for k in ("anchor", "left", "nleft", "right", "nright", "ident"):
            setattr(out, k, getattr(self, k)[keep])
        return out


def merged(a: Level, b: Level) -> Level:
    """Two suffix arrays as one. Both are runs already, which the stable sort takes as such."""
    return Level(*(np.concatenate([getattr(a, k), getattr(b, k)]) for k in ("anchor", "left", "nleft", "right", "nright", "ident")))


def _common(rows: np.ndarray, sizes: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """How many bytes each row has in common with the one before it; -1 where the anchor is another."""
    if len(rows) < 2:
        return np.full(len(rows), -1, np.int64)
    differ = rows[1:] != rows[:-1]
    n = np.where(differ.any(1), differ.argmax(1), SIDE)
    n = np.minimum(n, np.minimum(sizes[1:], sizes[:-1]))
    return np.concatenate([[-1], np.where(anchor[1:] == anchor[:-1], n, -1)])


def scan(all_of: Level, low: np.ndarray, high: np.ndarray) -> None:
    """Marks, in low and high (by entry number), the least and largest left reach of each entry's stretches that
    another entry of all_of has too."""
    n = len(all_of)
    if n < 2:
        return
    right = _common(all_of.right, all_of.nright, all_of.anchor)
    order = np.lexsort((*(all_of.left.view(">u8").T[::-1]), all_of.anchor))
    left = _common(all_of.left[order], all_of.nleft[order], all_of.anchor[order])
    ident = all_of.ident
    lrank = np.empty(n, np.int64)
    for reach in range(SIDE + 1):  # the stretch starts reach bytes before the anchor
        valid = np.flatnonzero((all_of.nleft >= reach) & (all_of.nright >= SIDE - reach))
        if len(valid) < 2:
            continue
        rrank = np.cumsum(right < SIDE - reach)
        lrank[order] = np.cumsum(left < reach)
        key = (rrank * np.int64(n + 1) + lrank)[valid]
        o = np.argsort(key, kind="stable")
        k = key[o]
        same = np.zeros(len(k) + 1, bool)
        same[1:-1] = k[1:] == k[:-1]
        hit = ident[valid[o[same[1:] | same[:-1]]]]
        low[hit] = np.minimum(low[hit], reach)
        high[hit] = np.maximum(high[hit], reach)


class Family:
    """The logarithmic family: levels of BATCH * 2^i entries at most; a new batch is scanned with itself and with
    what each level has of its anchors, then merges with levels of its size."""

    def __init__(self, batch: int = BATCH):
        self.batch, self.levels = batch, []
        self.low, self.high = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, anchor: np.ndarray, left: list[bytes], right: list[bytes]) -> None:
        first = len(self.low)
        n = len(anchor)
        self.low = np.concatenate([self.low, np.full(n, SIDE + 1)])
        self.high = np.concatenate([self.high, np.full(n, -1)])
        (l, nl), (r, nr) = _matrix(left, True), _matrix(right, False)
        new = Level(np.asarray(anchor), l, nl, r, nr, np.arange(first, first + n))
        scan(new, self.low, self.high)
        for level in self.levels:
            old = level.take(np.isin(level.anchor, new.anchor))
            if len(old):
                scan(merged(old, new.take(np.isin(new.anchor, old.anchor))), self.low, self.high)
        self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2]) <= len(self.levels[-1]):
            self.levels.append(merged(self.levels.pop(), self.levels.pop()))


def _index(batches) -> Iterator[pa.RecordBatch]:
    """Entries (anchor, ctx, l, r) to (anchor, ctx, low, high) for those with repeated stretches."""
    family, anchor, ctx, l, r, kept = Family(), [], [], [], [], []

    def flush():
        family.add(np.array(anchor, np.int64), l, r)
        kept.append((np.array(anchor, np.int64), np.array(ctx, np.int64)))
        anchor.clear(), ctx.clear(), l.clear(), r.clear()

    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(4))):
            for c, v in zip((anchor, ctx, l, r), row):
                c.append(v)
            if len(anchor) == family.batch:
                flush()
    if anchor:
        flush()
    if kept:
        a, c = (np.concatenate(x) for x in zip(*kept))
        hit = family.high >= 0
        out = pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (a, c, family.low, family.high)], ["anchor", "ctx", "low", "high"])
        del family, kept
        common.give_back()
        yield out


def _windows(batches) -> Iterator[pa.RecordBatch]:
    """Entries to their stretches (anchor, ctx, reach, 128 bits of a strong digest)."""
    for b in common.slices(batches, 64 << 10, 2):
        out = [(a, c, n, hashlib.blake2b(a.to_bytes(8, "big", signed=True) + bytes([n]) + l[len(l) - n :] + r[: SIDE - n], digest_size=16).digest()) for a, c, l, r in zip(*(b.column(i).to_pylist() for i in range(4))) for n in range(SIDE + 1) if len(l) >= n and len(r) >= SIDE - n]
        c = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["anchor", "ctx", "reach", "digest"])


def windows_of(hot: DataFrame) -> DataFrame:
    """(anchor, ctx, low, high) of entries whose stretches another entry has, by counting all stretches."""
    each = hot.select("anchor", "ctx", "l", "r").mapInArrow(_windows, "anchor long, ctx long, reach int, digest binary")
    twice = each.groupBy("digest").count().filter("count > 1").select("digest")
    return each.join(twice, "digest").groupBy("anchor", "ctx").agg(F.min("reach").cast("long").alias("low"), F.max("reach").cast("long").alias("high"))


def keys_of(raw) -> tuple:
    """A text's key, 79 bits of two hashes in two numbers: equal texts have equal spans, so they share it."""
    return F.xxhash64(raw).alias("tkey"), (F.crc32(raw).bitwiseAND(0x7FFF)).alias("more")


def distinct_texts(scratch: common.Scratch, docs: DataFrame, text_col: str) -> DataFrame:
    """tkey, more, raw and copies of each distinct text of WIDTH bytes or more. Keys are counted first; only texts that have
    copies are moved, and copies meet within a task before, so what is shuffled of a text with many is one row a task."""
    src = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw")).filter(F.length("raw") >= WIDTH)
    src = src.select(*keys_of(F.col("raw")), "raw")
    copied = scratch.save("copied", src.groupBy("tkey", "more").count().filter("count > 1").select("tkey", "more"))
    alone = src.join(copied, ["tkey", "more"], "left_anti").select("tkey", "more", "raw", F.lit(1).cast("long").alias("copies"))
    once = src.join(copied, ["tkey", "more"], "left_semi").groupBy("tkey", "more").agg(F.first("raw").alias("raw"), F.count("*").alias("copies"))
    return alone.union(scratch.save("once", once))


def repeats(docs: DataFrame, text_col: str = "text", hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """tkey, more (as in keys_of) and spans of each text that has some: spans are intervals (start, end) of bytes, not
    yet merged, that cover every byte of a WIDTH-byte string that also starts elsewhere."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark, "suffixes")
    src = distinct_texts(scratch, docs, text_col)
    occ = scratch.save("all", src.select("tkey", "raw").mapInArrow(_occurrences, "tkey long, at long, anchor long, ctx long"))
    twice = scratch.save("twice", occ.groupBy("anchor").count().filter("count > 1").select("anchor"))
    # anchors that occur once have no repeated stretch
    occ = scratch.save("occurrences", occ.join(twice, "anchor", "left_semi"))
    scratch.drop("all", "twice")
    # written before they are joined, so that an anchor with many contexts can be dealt to several tasks
    per = scratch.save("several", occ.groupBy("anchor").agg((F.min("ctx") != F.max("ctx")).alias("several")).filter("several"))
    some = occ.groupBy("anchor", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("tkey", "at")).alias("one"))
    some = scratch.save("entries", some.join(per, "anchor", "left").select("anchor", "ctx", "n", F.coalesce("several", F.lit(False)).alias("several"), "one.tkey", "one.at"))
    # the index answers for anchors of several contexts
    hot = scratch.save("hot", some.filter("several").groupBy("anchor").count().filter(F.col("count") > hot_contexts).select("anchor", F.lit(True).alias("hot")))
    asked = some.filter("several").join(hot, "anchor", "left").select("tkey", F.expr(MORE).alias("more"), F.struct("anchor", "ctx", "at", F.coalesce("hot", F.lit(False)).alias("hot")).alias("w"))
    asked = asked.groupBy("tkey", "more").agg(F.collect_list("w").alias("want"))
    ctxs = scratch.save("contexts", asked.join(src, ["tkey", "more"]).select("raw", "want").mapInArrow(_contexts, "anchor long, ctx long, l binary, r binary, hot boolean"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), common.pages_of(ctxs.count(), ENTRIES_PER_TASK))
    cold = ctxs.filter("!hot").select("anchor", "ctx", "l", "r").repartition(n, "anchor")
    told = cold.mapInArrow(_index, "anchor long, ctx long, low long, high long")
    told = told.union(windows_of(ctxs.filter("hot").dropDuplicates(["anchor", "ctx"])))
    # a context that occurs twice repeats in all its stretches
    full = some.filter("n > 1").select("anchor", "ctx", F.greatest(F.lit(0), SIDE - F.expr(RIGHT)).cast("long").alias("low"), F.least(F.lit(SIDE), F.expr(LEFT)).cast("long").alias("high")).filter("low <= high")
    told = scratch.save("told", told.union(full).groupBy("anchor", "ctx").agg(F.min("low").alias("low"), F.max("high").alias("high")))
    scratch.drop("contexts", "entries", "several", "hot")
    span = F.struct((F.expr(PLACE) - F.col("high")).cast("int").alias("start"), (F.expr(PLACE) + WIDTH - F.col("low")).cast("int").alias("end"))
    each = occ.join(told, ["anchor", "ctx"]).select("tkey", F.expr(MORE).alias("more"), span.alias("s"))
    copied = src.filter("copies > 1").select("tkey", "more", F.struct(F.lit(0).alias("start"), F.length("raw").alias("end")).alias("s"))
    spans = scratch.save("spans", each.union(copied).groupBy("tkey", "more").agg(F.collect_list("s").alias("spans")))
    scratch.drop("occurrences", "told", "copied", "once")
    return spans


def runs_of(spans) -> list[tuple[int, int]]:
    """Maximal runs of the intervals' union."""
    out: list[list[int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def kept_of(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for s, e in runs:
        out.append(raw[at:s])
        at = e
    out.append(raw[at:])
    return b"".join(out)


def _report(batches):
    for b in common.slices(batches, 2 << 20):
        cols: list[list] = [[] for _ in range(4)]
        for raw, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            runs = runs_of(spans)
            for c, v in zip(cols, (len(raw), sum(e - s for s, e in runs), len(runs), hashlib.sha256(kept_of(raw, runs)).hexdigest())):
                c.append(v)
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()]))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def with_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """(row: struct of all columns, spans, null: none) of all rows; in a struct, the columns' names clash with none here."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *keys_of(raw)).join(repeats(docs, text_col), ["tkey", "more"], "left").select("row", "spans")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    found = with_spans(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), "text")
    return found.select("row.doc_id", F.col("row.text").cast("binary").alias("raw"), "spans").mapInArrow(_report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the parts of characters at their ends."""
    out = []
    for s, e in runs:
        while s < e and raw[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
            e -= 1
        out.append((s, e))
    return out


def _cut(batches):
    for b in common.slices(batches, text=0):
        out = []
        for raw, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            out.append(kept_of(raw, whole_characters(raw, runs_of(spans))).decode("utf-8", "replace") if spans else raw.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([b.column(2), pa.array(out, pa.string())], ["rest", "text"])


def cut(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with their repeated bytes cut (of characters only whole ones); texts of which nothing but white
    space is left go. n_chars, if there, follows; other columns stay. A text without repeats stays as it is, null too."""
    rest = [c for c in docs.columns if c != text_col]
    joined = with_spans(docs, text_col)
    raw = F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")).cast("binary")
    changed = joined.filter("spans is not null").select(raw.alias("raw"), "spans", F.struct(*[F.col(f"row.`{c}`").alias(c) for c in rest] or [F.lit(0).alias("none")]).alias("rest"))
    changed = changed.mapInArrow(_cut, T.StructType([changed.schema["rest"], T.StructField("text", T.StringType())])).filter(F.length(F.trim("text")) > 0)
    value = {c: F.col(f"rest.`{c}`") for c in rest} | {text_col: F.col("text")}
    if "n_chars" in rest:
        value["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    more = changed.select(*[value[c].alias(c) for c in docs.columns])
    return joined.filter("spans is null").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]).union(more)
