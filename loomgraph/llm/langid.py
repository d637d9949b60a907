"""Language ID (operator 5): a linear-chain conditional random field over words.

A word's features are its affixes, letter n-grams and the lexicons (learned word lists) that hold it, all hashed;
transitions between languages are learned with them, on sequences that switch language as well. Forward-backward
gives each word of a code-switched text the probability of each language; a text's score for a language is the
mean over its words.

Training takes at most SAMPLE_DOCS labelled documents a language, chosen by a hash of their id, cuts the whole text of
each into stretches of STRETCH words, and takes at most SAMPLE_STRETCHES of those a language, chosen by a hash as well,
so a text's end counts like its start (the bounds of the sample; parameters of train()). Prediction reads whole texts: all words of a batch
of texts are one chain, cut into runs of RUN words whose transfer matrices are multiplied, so that forward-backward
is exact for any length at the price of a few array operations.

Defined results: a text that is null or has no letter is `und` with score 0, as is every text if nothing labelled is
there to learn from; ties go to the language that sorts first; repeated rows are predicted alike; other columns are
never inputs; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SAMPLE_DOCS, SAMPLE_STRETCHES, STRETCH = 400, 4000, 24
BUCKETS, LEXICON, EPOCHS, RUN, MOST_WORDS = 1 << 16, 3000, 4, 64, 300_000
#: Letters whose features are held at a time.
MOST_LETTERS = 1 << 18
WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    found = WORD.findall(text.lower()) if text else []
    return [w for w in found if w.isalpha() or any(c.isalpha() for c in w)]


def features(vocabulary: list[str], lexicons: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Each word's hashed features: (how many each word has, all of them in a row). N-grams of 2 to 5 bytes of ^word$
    (those with ^ or $ are its affixes), the word itself, and the lexicons that hold it; long words whole."""
    marked = [f"^{w}$" for w in vocabulary]
    data = np.frombuffer("\n".join(marked).encode() + b"\n", np.uint8)
    word = np.cumsum(data == 10) - (data == 10)
    codes, sums = common.mix(np.arange(256, dtype=np.uint64) + np.uint64(77)), np.zeros(len(data), np.uint64)
    inside, owner, ident = data != 10, [], []
    for n in range(1, 6):
        sums = sums * np.uint64(common.MIX_A) if n > 1 else sums
        sums = sums[: len(data) - n + 1] + codes[data[n - 1 :]]
        inside = inside[: len(data) - n + 1] & (data[n - 1 :] != 10)
        if n > 1:
            at = np.flatnonzero(inside)
            owner.append(word[at]), ident.append(common.mix(sums[at] + np.uint64(n)) % np.uint64(BUCKETS))
    first = np.concatenate([[0], np.flatnonzero(data == 10)[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.concatenate([first, [len(data)]])))
    whole = np.add.reduceat(common.mix(data.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8))), first)
    owner.append(np.arange(len(vocabulary))), ident.append(common.mix(whole) % np.uint64(BUCKETS))
    held = [(i, k) for i, w in enumerate(vocabulary) if (x := lexicons.get(w)) for k in range(x.bit_length()) if x >> k & 1]
    owner.append(np.array([i for i, _ in held], np.int64)), ident.append(np.array([k for _, k in held], np.uint64))
    o = np.concatenate(owner)
    order = np.argsort(o, kind="stable")
    return np.bincount(o, minlength=len(vocabulary)), np.concatenate(ident)[order].astype(np.int64)


class Model:
    def __init__(self, labels, weights, trans, first, lexicons):
        self.labels, self.weights, self.trans, self.first, self.lexicons = labels, weights, trans, first, lexicons


def _emissions(model: Model, vocabulary: list[str]) -> np.ndarray:
    out, at = [], 0
    ends = np.cumsum([len(w) for w in vocabulary])
    while at < len(vocabulary):  # some words at a time, for memory
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MOST_LETTERS, "right")))
        n, flat = features(vocabulary[at:to], model.lexicons)
        out.append(np.add.reduceat(model.weights[flat], np.concatenate([[0], np.cumsum(n)[:-1]])) / np.sqrt(n)[:, None])
        at = to
    return np.concatenate(out)


def posteriors(emit: np.ndarray, new: np.ndarray, trans: np.ndarray, first: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """Forward-backward over words laid end to end; new: where a text begins. Probabilities of each label, per word. To
    pairs, if given, the expected numbers of each label followed by each are added.

    Each run of RUN words is reduced to its transfer matrix; runs are then chained, and each run is filled in from
    the messages at its ends, all runs at once.
    """
    n, size = emit.shape
    runs = -(-n // RUN)
    e = np.exp(emit - emit.max(1, keepdims=True))
    e = np.concatenate([e, np.ones((runs * RUN - n, size))]).reshape(runs, RUN, size)
    b = np.concatenate([new, np.ones(runs * RUN - n, bool)]).reshape(runs, RUN)
    a, start = np.exp(trans), np.exp(first)
    prod = np.broadcast_to(np.eye(size), (runs, size, size)).copy()
    for t in range(RUN):
        step = (prod.reshape(-1, size) @ a).reshape(prod.shape)
        fresh = prod.sum(2, keepdims=True) * start
        prod = np.where(b[:, t, None, None], fresh, step) * e[:, t, None, :]
        prod /= prod.max((1, 2), keepdims=True)
    ahead, back = np.empty((runs, size)), np.empty((runs, size))
    v = np.full(size, 1.0 / size)
    for c in range(runs):
        ahead[c] = v
        v = v @ prod[c]
        v = v / v.sum()
    v = np.ones(size)
    for c in range(runs - 1, -1, -1):
        back[c] = v
        v = prod[c] @ v
        v = v / v.sum()
    alpha = np.empty((RUN, runs, size))
    v = ahead
    for t in range(RUN):
        v = np.where(b[:, t, None], v.sum(1, keepdims=True) * start, v @ a) * e[:, t]
        v /= v.sum(1, keepdims=True)
        alpha[t] = v
    beta = back
    for t in range(RUN - 1, -1, -1):
        post = alpha[t] * beta
        alpha[t] = post / post.sum(1, keepdims=True)
        w = beta * e[:, t]
        if pairs is not None and not b[:, t].all():  # forward to the word before, transition, the word itself, backward
            joint = (alpha[t - 1] if t else ahead)[:, :, None] * a * w[:, None, :]
            pairs += (joint / joint.sum((1, 2), keepdims=True))[~b[:, t]].sum(0)
        beta = np.where(b[:, t, None], (w @ start)[:, None], w @ a.T)
        beta = beta / beta.sum(1, keepdims=True)
    return alpha.transpose(1, 0, 2).reshape(-1, size)[:n]


def fit(rows: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 7) -> Model | None:
    """A model from (text, label) rows: likelihood ascent (AdaGrad) on sequences made of stretches of one to three
    texts, so that changes of language occur."""
    held = [(words(t), lang) for t, lang in sorted(rows)]
    held = [(w, lang) for w, lang in held if w]
    if not held:
        return None
    labels = sorted({lang for _, lang in held})
    number = {lang: k for k, lang in enumerate(labels)}
    counts = {lang: Counter() for lang in labels}
    for w, lang in held:
        counts[lang].update(w)
    lexicons: dict[str, int] = {}
    for lang, c in counts.items():
        for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicons[w] = lexicons.get(w, 0) | 1 << number[lang]
    size, rng = len(labels), np.random.default_rng(seed)
    model = Model(labels, np.zeros((BUCKETS, size)), np.zeros((size, size)), np.zeros(size), lexicons)
    sums = [np.full(x.shape, 1e-6) for x in (model.weights, model.trans, model.first)]
    stretches = [(w[i : i + STRETCH], number[lang]) for w, lang in held for i in range(0, len(w), STRETCH)]
    everything = sorted({w for ws, _ in held for w in ws})
    number_of = {w: k for k, w in enumerate(everything)}
    each, all_flat = features(everything, lexicons)
    all_at = np.concatenate([[0], np.cumsum(each)])
    for _ in range(epochs):
        order = rng.permutation(len(stretches))
        cuts = np.cumsum(rng.integers(1, 4, len(order)))
        new = np.zeros(len(order) + 4, bool)
        new[0] = True
        new[cuts[cuts < len(order)]] = True
        for at in range(0, len(order), 64):
            part = [stretches[i] for i in order[at : at + 64]]
            text = [w for ws, _ in part for w in ws]
            gold = np.repeat([y for _, y in part], [len(ws) for ws, _ in part])
            starts = np.cumsum([0, *(len(ws) for ws, _ in part)])[:-1]
            begins = np.zeros(len(text), bool)
            begins[starts[new[at : at + len(part)]]] = True
            begins[0] = True
            used_words, ids = np.unique([number_of[w] for w in text], return_inverse=True)
            n = each[used_words]
            at_word = np.concatenate([[0], np.cumsum(n)[:-1]])
            flat = all_flat[np.repeat(all_at[used_words] - at_word, n) + np.arange(n.sum())]
            emit = np.add.reduceat(model.weights[flat], at_word) / np.sqrt(n)[:, None]
            pairs = np.zeros((size, size))
            post = posteriors(emit[ids], begins, model.trans, model.first, pairs)
            err = -post
            err[np.arange(len(text)), gold] += 1
            word_err = np.zeros((len(used_words), size))
            np.add.at(word_err, ids, err)
            spread = np.repeat(word_err / np.sqrt(n)[:, None], n, axis=0)
            used, where = np.unique(flat, return_inverse=True)
            g = np.stack([np.bincount(where, weights=spread[:, k], minlength=len(used)) for k in range(size)], 1) - 1e-3 * model.weights[used]
            sums[0][used] += g * g
            model.weights[used] += 0.5 * g / np.sqrt(sums[0][used])
            # transitions: gold pairs less expected ones
            inner = np.flatnonzero(~begins)
            gt = -pairs
            np.add.at(gt, (gold[inner - 1], gold[inner]), 1)
            gf = -post[begins].sum(0)
            np.add.at(gf, gold[begins], 1)
            for value, total, grad in ((model.trans, sums[1], gt), (model.first, sums[2], gf)):
                total += grad * grad
                value += 0.2 * grad / np.sqrt(total)
    return model


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sampled(docs: DataFrame, sample_docs: int, sample_stretches: int) -> DataFrame:
    """(text, lang): stretches of the whole texts of labelled documents that aren't held out. Ranking is in two steps, by a
    hash of the id alone, so no task sees more than its share of a language and no text is moved but the chosen ones."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id"))

    def least(df: DataFrame, n: int, *by: str) -> DataFrame:
        for keys in (["lang", "salt"], ["lang"]):
            w = Window.partitionBy(*keys).orderBy(*by)
            df = df.withColumn("salt", F.pmod("h", F.lit(64))).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= n)
        return df.drop("salt", "r")

    # hashes are spread evenly: twice the share that the sample is of a language's documents holds the sample's least hashes
    per = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()  # a row a language
    if not per:
        return usable.select("text", "lang").limit(0)
    upto = {r["lang"]: max(r["least"], int((1 << 64) * min(1.0, 2 * sample_docs / r["n"])) - (1 << 63) - 1) for r in per}
    bound = F.create_map(*(F.lit(x) for kv in upto.items() for x in kv))
    few = usable.filter(F.col("h") <= F.element_at(bound, F.col("lang"))).select("lang", "h", "text", F.xxhash64("text").alias("t"))
    few = least(few, sample_docs, "h", "t").withColumn("w", F.split(F.trim("text"), r"\s+"))
    cut = few.select("lang", "h", "t", "w", F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / STRETCH).cast("int"))).alias("k"))
    cut = cut.select("lang", F.xxhash64("h", "t", "k").alias("h"), F.array_join(F.slice("w", F.col("k") * STRETCH + 1, STRETCH), " ").alias("text"))
    return least(cut, sample_stretches, "h", "text").select("text", "lang")


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_stretches: int = SAMPLE_STRETCHES) -> Model | None:
    """Fits on a bounded sample of labelled documents that aren't held out."""
    return fit([(r["text"], r["lang"]) for r in sampled(docs, sample_docs, sample_stretches).collect()])


class Labeller:
    """Word probabilities of texts; emissions of words are kept in a bounded memory."""

    def __init__(self, model: Model):
        self.model, self.known, self.rows = model, {}, np.empty((0, len(model.labels)))

    def __call__(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray]:
        each = [words(t) for t in texts]
        known = self.known
        flat = [w for ws in each for w in ws]
        if not flat:
            return each, np.empty((0, len(self.model.labels)))
        new = [w for w in dict.fromkeys(flat) if w not in known]
        if len(known) + len(new) > MOST_WORDS:
            known.clear()
            self.rows, new = self.rows[:0], list(dict.fromkeys(flat))
        if new:
            for i in range(0, len(new), 20_000):
                part = new[i : i + 20_000]
                for k, w in enumerate(part, len(known)):
                    known[w] = k
                self.rows = np.concatenate([self.rows, _emissions(self.model, part)])
        emit = self.rows[np.fromiter((known[w] for w in flat), np.int64, len(flat))]
        begins = np.zeros(len(flat), bool)
        starts = np.cumsum([0, *map(len, each)])[:-1]
        begins[starts[[bool(ws) for ws in each]]] = True
        return each, posteriors(emit, begins, self.model.trans, self.model.first)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred, score per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS, LEXICON and the labels
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        label = Labeller(m) if m else None
        for b in common.slices(batches, 2 << 20):
            lang, score = [], []
            if label:
                each, post = label(b.column(1).to_pylist())
                at = 0
                for ws in each:
                    mean = post[at : at + len(ws)].mean(0) if ws else None
                    at += len(ws)
                    lang.append(m.labels[int(mean.argmax())] if ws else "und"), score.append(min(1.0, float(mean.max())) if ws else 0.0)
            else:
                lang, score = ["und"] * b.num_rows, [0.0] * b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], [id_col, "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def switches(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Code switching: one row per run of words of one language: id_col, first_word, n_words, lang, probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        label = Labeller(shared.value)
        for b in common.slices(batches, 2 << 20):
            each, post = label(b.column(1).to_pylist())
            out, at = [], 0
            for i, ws in zip(b.column(0).to_pylist(), each):
                p = post[at : at + len(ws)]
                at += len(ws)
                best = p.argmax(1)
                cut = [0, *(np.flatnonzero(best[1:] != best[:-1]) + 1).tolist(), len(ws)] if ws else []
                out += [(i, s, e - s, shared.value.labels[int(best[s])], float(p[s:e, best[s]].mean())) for s, e in zip(cut, cut[1:])]
            c = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, (b.column(0).type, pa.int32(), pa.int32(), pa.string(), pa.float64()))], [id_col, "first_word", "n_words", "lang", "probability"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, first_word int, n_words int, lang string, probability double")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from those not held out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    return predict(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents with words, but for those where no language has a mean probability of at least least and most words
    have none either, so texts in several languages stay; all columns stay. Without any label to learn from, all with words
    stay. Each is judged in its own row: the text goes through the labeller once and nothing is joined."""
    model = train(docs)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        m = shared.value
        label = Labeller(m) if m else None
        for b in common.slices(batches, 2 << 20, at):
            if label is None:
                yield b.filter(pa.array([bool(words(t)) for t in b.column(at).to_pylist()], pa.bool_()))
                continue
            each, post = label(b.column(at).to_pylist())
            ends = np.cumsum([0, *map(len, each)])
            good = [bool(ws) and bool(post[s:e].mean(0).max() >= least or (post[s:e].max(1) >= least).mean() >= 0.5) for ws, s, e in zip(each, ends, ends[1:])]
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
