"""N-gram Jaccard join (operator 8): token-group matrix, with a filter that finds each pair of links exactly.

1. Each text becomes its set of word n-grams (64-bit hashes); texts of one set are one node, its smallest id.
2. Sets that link are found by what they must have in common, and sets that share such a signature fall into a family.
   At EXACT_PCT and above: linked sets differ in few n-grams, so of P = H + 1 + spare parts, into which a hash deals all
   n-grams, some must be alike (H bounds how many n-grams two linked sets of a size class may differ in). Each set gives
   one signature per part and size class. A spare part allows each set to leave out as many parts of few n-grams, which
   unlike texts would share by chance; a set with more such parts than spares gives them all, so no link is lost.
   Below, such parts would hold too few n-grams to tell texts apart: there, a signature is the set's R least n-grams in
   one of B random orders, with B so large that a link has no signature in common with a probability of at most
   MISS (1e-17, below that of two n-grams having the same 64-bit hash).
3. A family goes to one task, or, if it is large, its blocks pairwise to several. There the token-group matrix
   does the join: similar documents are put into groups, each group has its token union, a document's overlap
   with the union bounds that with any member, and only groups that can hold a link are opened. Documents with
   too many n-grams of their own are out beforehand. Pairs already known to be connected are not compared.
4. Links are exact set comparisons; components come from common.components.

Only signatures (a fraction of the n-grams) and the sets of families are shuffled; signatures are dealt
by range, so that a frequent one is split, and each partition contracts what it sees to a spanning forest.

Defined results: null and empty texts have empty sets, linked with nothing; a text of fewer words than n is
one n-gram; rows of one id are one node, whose links are those of all its texts; a null id takes part in no link and
has a null component; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Tokens and documents of a block of a family, and documents of a group of the matrix.
BLOCK_TOKENS, BLOCK_DOCS, GROUP_DOCS = 1_500_000, 3000, 32
MOST_WORDS = 300_000
SALTS = np.array([0, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


class Shingler:
    """Distinct n-gram hashes of texts; word hashes are kept in a bounded memory."""

    def __init__(self, n: int):
        self.n, self.known = n, {}

    def __call__(self, text) -> np.ndarray:
        words = common.words_of(text)
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        try:
            h = [known[w] for w in words]
        except KeyError:
            if len(known) > MOST_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            h = [known[w] for w in words]
        h = np.array(h, np.uint64)
        n = min(self.n, len(h))
        out = np.full(len(h) - n + 1, n * int(SALTS[1]) & common.M64, np.uint64)
        for i in range(n):
            out = common.mix(out ^ h[i : len(h) - n + 1 + i])
        return np.unique(out)


def size_classes(pct: int, up_to: int) -> list[int]:
    """Lower bounds of size classes such that sizes that can link lie in the same class or in adjacent ones."""
    out = [1]
    while out[-1] <= up_to:
        out.append(out[-1] * 100 // pct + 1)
    return out


def class_plan(bounds: list[int], k: int, pct: int) -> tuple[int, int]:
    """(parts, spare) for sets of classes k and k + 1: parts - spare - 1 bounds the symmetric difference of two
    linked sets of these classes."""
    differ = 2 * (bounds[k + 2] - 1) * (100 - pct) // (100 + pct)
    spare = math.ceil(0.06 * differ) if differ >= 4 else 0
    return differ + 1 + spare, spare


def parts_of(tokens: np.ndarray, bounds: list[int], pct: int, weak: int = 2) -> np.ndarray:
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    own = int(np.searchsorted(bounds, n, "right")) - 1
    out = []
    for k in {max(own - 1, 0), own}:
        parts, spare = class_plan(bounds, k, pct)
        part = (common.mix(tokens ^ np.uint64(((k + 1) * common.BASE) & common.M64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        have, first, count = np.unique(part[order], return_index=True, return_counts=True)
        sums = np.zeros(parts, np.uint64)
        sums[have] = np.add.reduceat(common.mix(tokens[order] ^ SALTS[2]), first)
        full = np.zeros(parts, np.int64)
        full[have] = count
        keep = full > weak
        if parts - int(keep.sum()) > spare:
            keep[:] = True
        sig = common.mix(sums + common.mix(np.arange(parts, dtype=np.uint64) + np.uint64((k + 1) << 32)))
        out.append(sig[keep])
    return np.concatenate(out)


#: Below EXACT_PCT parts would hold too few n-grams to tell texts apart; bands of least n-grams take their place. Sets of
#: at most SMALL_TO n-grams have bands of R_SMALL, those over LARGE_FROM (also) bands of R_LARGE.
EXACT_PCT, SMALL_TO, LARGE_FROM, R_SMALL, R_LARGE, MISS = 86, 50, 40, 3, 6, 1e-17


@functools.lru_cache
def band_count(pct: int, r: int, sizes: range) -> int:
    """So many bands that two sets at the threshold share none with a probability of at most MISS, at any size."""
    least = 1.0
    for u in sizes:
        i = -(-pct * u // 100)
        if i < u:
            least = min(least, math.comb(i, r) / math.comb(u, r)) if i >= r else 0.0
        if least == 0.0:
            raise ValueError("pct is too low for bands of least n-grams")
    return math.ceil(math.log(MISS) / math.log1p(-least))


def bands(tokens: np.ndarray, r: int, b: int) -> np.ndarray:
    """One signature per band: the hash of the set's r least n-grams in the band's order. Two sets have a band in common
    if the r least of their union lie in both."""
    if len(tokens) <= r:
        return common.mix(np.add.reduce(common.mix(tokens ^ SALTS[2]), keepdims=True) + np.uint64(r))
    salts = common.mix(np.arange(1, b + 1, dtype=np.uint64) * np.uint64(common.BASE) + np.uint64(r))
    out = np.empty(b, np.uint64)
    step = max(1, 400_000 // len(tokens))
    inner = common.mix(tokens ^ SALTS[2])
    for i in range(0, b, step):
        h = (tokens ^ salts[i : i + step, None]) * np.uint64(common.MIX_A)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(common.MIX_B)
        least = np.argpartition(h, r - 1, axis=1)[:, :r]
        out[i : i + step] = inner[least].sum(1)
    return common.mix(out + salts)


def signatures(tokens: np.ndarray, bounds: list[int], pct: int, exact: bool = False) -> np.ndarray:
    """What two sets that link have in common; if exact, with certainty at any threshold."""
    if exact or pct >= EXACT_PCT or not len(tokens):
        return parts_of(tokens, bounds, pct)
    out = []
    if len(tokens) <= SMALL_TO:
        out.append(bands(tokens, R_SMALL, band_count(pct, R_SMALL, range(2, SMALL_TO * 100 // pct + 1))))
    if len(tokens) > LARGE_FROM:
        out.append(bands(tokens, R_LARGE, band_count(pct, R_LARGE, range(LARGE_FROM, 400))))
    return np.concatenate(out)


def _describe(batches, n: int, pct: int, exact: bool = False) -> Iterator[pa.RecordBatch]:
    """doc_id, n_shingles, key (128-bit hash of the set), signatures."""
    shingle, bounds = Shingler(n), size_classes(pct, 1 << 40)
    for b in common.slices(batches):
        size, key, sig = [], [], []
        for text in b.column(1).to_pylist():
            t = shingle(text)
            size.append(len(t)), key.append(xxhash.xxh3_128_digest(t.tobytes())), sig.append(signatures(t, bounds, pct, exact).view(np.int64))
        at = np.cumsum([0, *map(len, sig)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sig)))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(key, pa.binary()), lists], ["doc_id", "n_shingles", "key", "sigs"])


def _chains(batches) -> Iterator[pa.RecordBatch]:
    """Rows (sig, node) sorted by both: (u, v, sig, edge) of a spanning forest of equal signatures, and, with edge
    false, the partition's first and last row, whose signatures may go on in the partitions beside it."""
    f, last, first = common.Forest(), None, None
    for b in batches:
        sig, node = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(sig):
            continue
        if first is None:
            first = (int(sig[0]), int(node[0]))
        if last is not None and last[0] == sig[0] and last[1] != node[0]:
            f.join(last[1], int(node[0]))
        same = np.flatnonzero((sig[1:] == sig[:-1]) & (node[1:] != node[:-1]))
        for u, v in zip(node[same].tolist(), node[same + 1].tolist()):
            f.join(u, v)
        last = (int(sig[-1]), int(node[-1]))
    rows = [(x, r, 0, True) for x in list(f.up) if (r := f.find(x)) != x]
    rows += [(n, n, s, False) for s, n in {first, last} if first] if first else []
    for i in range(0, len(rows), 50_000):
        c = list(zip(*rows[i : i + 50_000]))
        yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.bool_())], ["u", "v", "sig", "edge"])


def families(scratch: common.Scratch, sigs: DataFrame) -> DataFrame:
    """(node, component) of nodes that share a signature (sig, node), by chains of shared ones."""
    n = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sigs.repartitionByRange(n, "sig", "node").sortWithinPartitions("sig", "node")
    found = scratch.save("chains", dealt.mapInArrow(_chains, "u long, v long, sig long, edge boolean"))
    ends = found.filter("!edge")
    low = ends.groupBy("sig").agg(F.min("u").alias("m"))
    across = ends.join(low, "sig").select("u", F.col("m").alias("v"))
    edges = found.filter("edge").select("u", "v").union(across).filter("u != v")
    return common.components(scratch, edges, "forest")


def link_block(ids: list[int], sets: list[np.ndarray], pct: int) -> list[tuple[int, int]]:
    """A spanning forest of all links among the sets, by a token-group matrix."""
    size = np.array([len(s) for s in sets], np.int64)
    lens, toks = size, np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), lens)
    vocab, tok = np.unique(toks, return_inverse=True)
    need = -(-pct * size // 100)  # of any set's n-grams, so many lie in whichever set it links with
    alive = np.ones(len(sets), bool)
    while True:  # n-grams that no other document here has can't be in an intersection
        df = np.bincount(tok[alive[owner]], minlength=len(vocab))
        shared = np.bincount(owner, weights=df[tok] >= 2, minlength=len(sets)).astype(np.int64)
        now = alive & (shared >= need)
        if (now == alive).all():
            break
        alive = now
    docs = np.flatnonzero(alive)
    if len(docs) < 2:
        return []
    start = np.concatenate([[0], np.cumsum(lens)])
    part = [tok[start[d] : start[d + 1]] for d in docs]
    size, shared = size[docs], shared[docs]
    # similar documents side by side: by size class and least n-gram, and the least edited first
    first = np.array([p[np.argmin(vocab[p])] if len(p) else 0 for p in part])
    order = np.lexsort((size - shared, first))
    part, docs, size, shared = [part[i] for i in order], docs[order], size[order], shared[order]
    flat, at = np.concatenate(part), np.concatenate([[0], np.cumsum(size)[:-1]])
    f, n, out = common.Forest(), len(docs), []
    root = np.arange(n)
    mask = np.zeros(len(vocab), np.int32)

    def overlap(which: np.ndarray) -> np.ndarray:
        """How many n-grams of each of these documents are in the mask."""
        if len(which) == n:
            return np.add.reduceat(mask[flat], at)
        t = np.concatenate([part[i] for i in which])
        return np.add.reduceat(mask[t], np.concatenate([[0], np.cumsum(size[which])[:-1]]))

    for g in range(0, n, GROUP_DOCS):
        members = np.arange(g, min(g + GROUP_DOCS, n))
        union = np.concatenate([part[i] for i in members])
        later = np.arange(g, n)
        low, high = size[members].min(), size[members].max()
        later = later[(size[later] * 100 >= low * pct) & (size[later] * pct <= high * 100)]
        if not len(later):
            continue
        mask[union] = 1
        hits = overlap(later)
        mask[union] = 0
        bound = np.maximum(-(-pct * (size[later] + low) // (100 + pct)), -(-pct * size[later] // 100))
        opened = later[np.minimum(hits, shared[later]) >= bound]
        for m in members:
            q = opened[(opened > m) & (root[opened] != root[m])]
            q = q[(size[q] * 100 >= size[m] * pct) & (size[q] * pct <= size[m] * 100)]
            least = -(-pct * (size[q] + size[m]) // (100 + pct))
            fits = np.minimum(shared[q], shared[m]) >= least
            q, least = q[fits], least[fits]
            if not len(q):
                continue
            mask[part[m]] = 1
            linked = q[overlap(q) >= least]
            mask[part[m]] = 0
            for x in linked:
                if f.join(int(m), int(x)):
                    out.append((ids[docs[m]], ids[docs[x]]))
            if len(linked):
                olds = np.unique(root[linked])
                root[np.isin(root, olds)] = root[m]
    return out


def _link(batches, pct: int) -> Iterator[pa.RecordBatch]:
    """Rows (family, a, b, node, tokens) sorted by the first three: the links found in each block pair."""
    key, ids, sets, rows, held = None, [], [], [], 0

    def flush():
        if len(ids) > 1:
            rows.extend(link_block(ids, sets, pct))

    for batch in batches:
        fam, a, b, node = (batch.column(i).to_pylist() for i in range(4))
        lists = batch.column(4)
        for i in range(batch.num_rows):
            k = (fam[i], a[i], b[i])
            if k != key:
                flush()
                key, ids, sets = k, [], []
            ids.append(node[i]), sets.append(np.asarray(lists[i].values).view(np.uint64))
    flush()
    sets.clear()
    common.give_back()
    for i in range(0, len(rows), 50_000):
        c = list(zip(*rows[i : i + 50_000]))
        yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64())], ["u", "v"])


def _sets(batches, n: int) -> Iterator[pa.RecordBatch]:
    shingle = Shingler(n)
    for b in common.slices(batches):
        sets = [shingle(t).view(np.int64) for t in b.column(1).to_pylist()]
        at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets))), b.column(2), b.column(3)], ["node", "tokens", "component", "blocks"])


def join(docs: DataFrame, n: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: links where 100 * intersection >= pct * union. exact: signatures that
    miss no link below EXACT_PCT either, at the price of many more that unlike texts share."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark, "jaccard")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    told = scratch.save("told", src.mapInArrow(lambda it: _describe(it, n, pct, exact), "doc_id long, n_shingles long, key binary, sigs array<long>"))
    rep = scratch.save("reps", told.filter("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("node")))
    # one row per set; the other rows of a set only point to its node
    own = told.filter("n_shingles > 0").join(rep.withColumnRenamed("node", "doc_id"), ["key", "doc_id"], "left_semi").select(F.col("doc_id").alias("node"), "n_shingles", "sigs")
    fam = scratch.save("families", families(scratch, own.select("node", F.explode("sigs").alias("sig")).select("sig", "node")))
    sizes = told.select(F.col("doc_id").alias("node"), "n_shingles").join(fam, "node").groupBy("component").agg(F.sum("n_shingles").alias("tokens"), F.count("*").alias("docs"))
    blocks = F.greatest(F.ceil(F.col("tokens") / BLOCK_TOKENS), F.ceil(F.col("docs") / BLOCK_DOCS)).cast("int")
    member = fam.join(sizes.select("component", blocks.alias("blocks")), "component").select("node", "component", "blocks")
    texts = src.join(member, src["doc_id"] == member["node"]).select("node", "text", "component", "blocks")
    sets = texts.mapInArrow(lambda it: _sets(it, n), "node long, tokens array<long>, component long, blocks int").filter(F.size("tokens") > 0)
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    sets = sets.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sets = sets.select(F.col("component").alias("family"), F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "node", "tokens")
    dealt = sets.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "family", "a", "b").sortWithinPartitions("family", "a", "b", "node")
    links = scratch.save("links", dealt.mapInArrow(lambda it: _link(it, pct), "u long, v long"))
    # rows of one set are linked by their node
    comp = scratch.save("components", common.components(scratch, links, "linked"))
    scratch.drop("chains", "links", "families")
    named = told.select("doc_id", "n_shingles", "key").join(rep, "key", "left").join(comp, "node", "left")
    named = named.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "node")).otherwise(F.col("doc_id")).alias("component_id"))
    return named


def keep_one(docs: DataFrame, n: int = 5, pct: int = 80) -> DataFrame:
    """One row of each component: that of the smallest id, null ids last; all columns stay, whatever their names. Each row is
    judged by its own text, also where ids are null or repeated; rows without words all stay."""
    # written, so that a row's key is the same wherever it is read; in a struct, columns' names clash with none here
    scratch = common.Scratch(docs.sparkSession, "keep_one")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("key"))
    rows = scratch.save("rows", rows)
    told = join(rows.select("key", F.col("row.text").alias("text")), n, pct, "key").select(F.col("doc_id").alias("key"), "component_id")
    order = F.struct(F.isnull("id").alias("none"), F.col("id"), F.col("key").alias("key"))
    first = told.join(rows.select("key", F.col("row.doc_id").alias("id")), "key").groupBy("component_id").agg(F.min(order)["key"].alias("kept"))
    return rows.join(first, rows["key"] == first["kept"], "left_semi").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
