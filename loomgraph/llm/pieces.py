"""SentencePiece encoding and decoding (operator 6): n-best segmentation by A* search.

The lattice of a text has an edge for each piece that stands there, and for each character without one an edge of
its UTF-8 bytes' pieces. Forward Viterbi gives each place the score of the best way to it; that is an exact heuristic
for a search backward from the end, so A* yields the n best segmentations in order and opens nothing else.

No piece goes over two characters that no piece has in a row; so the lattice falls apart at such places: the best way
through each distinct part, and its distance to the next, are remembered within a bound, and the n best of a text are the
best ways to take alternatives in the n - 1 parts that lose least by it.

A unigram model's scores are log-probabilities. A BPE model has merge ranks instead; they become log-probabilities by
Zipf's law, and bytes and pieces without a rank get the least of all. Nothing is trained. Scores are kept in steps of
2^-30, so sums are exact in whatever order they are made, and ties are true ties.

Of a text's segmentations the best is given whole and the others by what differs, which is little: n times fewer ids are
written, and none is lost.

Defined results: null and empty texts have one segmentation, of no pieces and score 0; of a part's ways with one score,
those come first whose ids, read from the last (as the search goes), sort first; of a text's, those that take the better
ways of later parts; fewer segmentations than n are all returned; repeated rows and null ids are rows of their own; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import itertools
import math
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SPACE, MOST_PARTS = "▁", 400_000


ENCODERS: dict = {}


def exact(score: float) -> float:
    return round(score * (1 << 30)) / (1 << 30)


class Vocabulary:
    """Pieces with log-probabilities, byte pieces, and how far a piece reaches."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_pieces: list[tuple[int, float]], names: list[bytes]):
        pieces = {p: (i, exact(s)) for p, (i, s) in pieces.items()}
        if not names:
            names = [b""] * (max((i for i, _ in pieces.values()), default=0) + 1)
            for p, (i, _) in pieces.items():
                names[i] = p.replace(SPACE, " ").encode()
        self.pieces, self.bytes, self.names = pieces, [(i, exact(s)) for i, s in byte_pieces], names
        self.longest = max(map(len, pieces), default=1)
        self.pairs = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        self.heads = {p[:k] for p in pieces for k in range(1, len(p) + 1)}
        self.trie: dict = {}  # by character: (the next characters' steps, the piece's id or None, its score)
        self.alone = {p for p in pieces if len(p) == 1}
        tops: dict[str, dict] = {"": self.trie}
        for head in sorted(self.heads):
            i, score = pieces.get(head, (None, 0.0))
            tops[head] = {}
            tops[head[:-1]][head[-1]] = (tops[head], None if i is None else (i,), score)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        score = [sp.get_score(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        ranked = [i for i in plain if score[i] > -1e6]
        if all(score[i] == int(score[i]) for i in ranked):  # merge ranks
            order = {i: r for r, i in enumerate(sorted(ranked, key=lambda i: (-score[i], i)))}
            norm = math.log(sum(1 / (r + 2) for r in range(n)))
            floor = -math.log(n + 2) - norm
            score = [-math.log(order[i] + 2) - norm if i in order else floor for i in range(n)]
        pieces = {sp.id_to_piece(i): (i, score[i]) for i in plain}
        names = [b""] * n
        for p, (i, _) in pieces.items():
            names[i] = p.replace(SPACE, " ").encode()
        raw = [(0, 0.0)] * 256
        for i in range(n):
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[1:-1], 16)
                raw[b], names[i] = (i, score[i]), bytes([b])
        return cls(pieces, raw, names)

    def decode(self, ids) -> str:
        """The text that the ids stand for, without the space put before it."""
        return b"".join(map(self.names.__getitem__, ids))[1:].decode("utf-8", "replace")


def best_and_gap(word: str, vocab: Vocabulary) -> tuple[float, tuple[int, ...], float]:
    """Score and ids of the best segmentation, and what the second best loses by (inf: there is none): forward Viterbi
    with the two best scores at each place."""
    size, root, alone = len(word), vocab.trie, vocab.alone
    best, second, back = [0.0] + [-math.inf] * size, [-math.inf] * (size + 1), [None] * (size + 1)
    for i in range(size):
        here, next_best, below, j = best[i], second[i], root, i
        for char in word[i:]:
            step = below.get(char)
            if step is None:
                break
            below, ids, s = step
            j += 1
            if ids is not None:
                to, old = here + s, best[j]
                if to > old:
                    other = next_best + s
                    best[j], back[j], second[j] = to, (i, ids), old if old > other else other
                elif to > second[j]:
                    second[j] = to
        if word[i] not in alone:  # its bytes
            raw = [vocab.bytes[b] for b in word[i].encode("utf-8", "surrogatepass")]
            s, j = sum(x for _, x in raw), i + 1
            to, old = here + s, best[j]
            if to > old:
                best[j], back[j], second[j] = to, (i, tuple(k for k, _ in raw)), max(old, next_best + s)
            else:
                second[j] = max(second[j], to)
    ids, at = (), size
    while at:
        at, piece = back[at]
        ids = piece + ids
    return best[size], ids, best[size] - second[size]


def n_best(word: str, vocab: Vocabulary, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best segmentations of the word: (score, ids), best first, and by ids from the last among equals."""
    size, pieces, heads = len(word), vocab.pieces, vocab.heads
    edges: list[list[tuple]] = [[] for _ in range(size + 1)]  # by end: (-best to here over the edge, ids from the last, start, score)
    best = [0.0] + [-math.inf] * size
    for i in range(size):
        single, here = False, best[i]
        for j in range(i + 1, min(size, i + vocab.longest) + 1):
            part = word[i:j]
            if part not in heads:
                break
            if (hit := pieces.get(part)) is not None:
                single = single or j == i + 1
                to = here + hit[1]
                edges[j].append((-to, (hit[0],), i, hit[1]))
                if to > best[j]:
                    best[j] = to
        if not single:
            raw = [vocab.bytes[b] for b in word[i].encode("utf-8", "surrogatepass")]
            s = sum(x for _, x in raw)
            edges[i + 1].append((-here - s, tuple(k for k, _ in reversed(raw)), i, s))
            best[i + 1] = max(best[i + 1], here + s)
    for ways in edges:
        ways.sort()
    # agenda: (-estimate, ids from the last back over the edge, place whose edges are tried, number of the edge, ids and
    # score behind it). Edges stand in the agenda's order, so the next is only looked at once the one before it is out;
    # estimates are exact and ids only grow at their end, so complete ways come out in order, ties too
    agenda: list[tuple] = [(edges[size][0][0], edges[size][0][1], size, 0, (), 0.0)]
    out: list[tuple[float, tuple[int, ...]]] = []
    while agenda and len(out) < n:
        _, ids, at, k, behind, after = heapq.heappop(agenda)
        ways = edges[at]
        if k + 1 < len(ways):
            heapq.heappush(agenda, (ways[k + 1][0] - after, behind + ways[k + 1][1], at, k + 1, behind, after))
        i, after = ways[k][2], after + ways[k][3]
        if i == 0:
            out.append((after, ids[::-1]))
        else:
            heapq.heappush(agenda, (edges[i][0][0] - after, ids + edges[i][0][1], i, 0, ids, after))
    return out


class Lattices:
    """best_and_gap for many parts at once: their lattices advance together, place by place, through a trie in arrays. Steps
    from a node by a character are found in a table by hash, whose keys are compared."""

    ROWS, LONGEST = 4096, 24

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        nodes = {h: k for k, h in enumerate(sorted(vocab.heads, key=len), 1)} | {"": 0}
        self.piece, self.score = np.full(len(nodes), -1, np.int32), np.zeros(len(nodes))
        for p, (i, x) in vocab.pieces.items():
            self.piece[nodes[p]], self.score[nodes[p]] = i, x
        bits = max(4, (4 * len(nodes)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        for head, k in nodes.items():
            if head:
                key = nodes[head[:-1]] << 21 | ord(head[-1]) + 1
                at = (key * common.BASE & common.M64) >> (64 - bits)
                while self.keys[at]:
                    at = at + 1 & self.mask
                self.keys[at], self.to[at] = key, k

    def _step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The node that each state's character leads to; -1: none."""
        key = state.astype(np.uint64) << np.uint64(21) | code.astype(np.uint64) + np.uint64(1)
        at = (key * np.uint64(common.BASE) >> self.shift).astype(np.int64)
        out = np.full(len(key), -1, np.int64)
        left = np.arange(len(key))
        while len(left):
            there = self.keys[at[left]]
            hit = there == key[left]
            out[left[hit]] = self.to[at[left[hit]]]
            left = left[~hit & (there != 0)]
            at[left] = at[left] + 1 & self.mask
        return out

    def __call__(self, parts: list[str]) -> list[tuple[float, tuple[int, ...], float]]:
        out: list = [None] * len(parts)
        order = sorted((k for k, p in enumerate(parts) if len(p) <= self.LONGEST), key=lambda k: len(parts[k]))
        for i in range(0, len(order), self.ROWS):
            some = order[i : i + self.ROWS]
            for k, got in zip(some, self._run([parts[k] for k in some])):
                out[k] = got
        return [got or best_and_gap(p, self.vocab) for p, got in zip(parts, out)]

    def _run(self, parts: list[str]) -> list[tuple[float, tuple[int, ...], float] | None]:
        """None for a part with a character that is no piece."""
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        n, most = len(parts), int(size.max())
        code = np.array(parts, f"<U{most}").view(np.uint32).reshape(n, most)
        best, second = np.full((n, most + 1), -np.inf), np.full((n, most + 1), -np.inf)
        best[:, 0] = 0.0
        start, ident = np.zeros((n, most + 1), np.int64), np.zeros((n, most + 1), np.int32)
        for i in range(most):
            rows = np.flatnonzero(size > i)
            state = np.zeros(len(rows), np.int64)
            for j in range(i + 1, most + 1):
                state = self._step(state, code[rows, j - 1])
                go = state >= 0
                rows, state = rows[go], state[go]
                if not len(rows):
                    break
                has = self.piece[state] >= 0
                r, at = rows[has], state[has]
                to, other, old = best[r, i] + self.score[at], second[r, i] + self.score[at], best[r, j]
                up = to > old
                second[r, j] = np.where(up, np.maximum(old, other), np.maximum(second[r, j], to))
                best[r, j] = np.where(up, to, old)
                u = r[up]
                start[u, j], ident[u, j] = i, self.piece[at[up]]
                on = size[rows] > j
                rows, state = rows[on], state[on]
                if not len(rows):
                    break
        every = np.arange(n)
        score = best[every, size]
        ids, at, count = np.zeros((n, most), np.int32), np.where(score > -np.inf, size, 0), np.zeros(n, np.int64)
        while len(open_ := np.flatnonzero(at > 0)):
            ids[open_, count[open_]] = ident[open_, at[open_]]
            count[open_] += 1
            at[open_] = start[open_, at[open_]]
        gap = np.where(score > -np.inf, score, 0) - second[every, size]
        rows = zip(score.tolist(), ids.tolist(), count.tolist(), gap.tolist())
        # a part with a character of its own bytes has its ways counted one by one
        plain = self._step(np.zeros(code.size, np.int64), code.ravel()).reshape(code.shape)
        plain = ((self.piece[np.maximum(plain, 0)] >= 0) & (plain >= 0) | (np.arange(most) >= size[:, None])).all(1)
        return [(x, tuple(i[:c][::-1]), g) if ok else None for (x, i, c, g), ok in zip(rows, plain.tolist())]


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base & common.M64, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Encoder:
    """N-best segmentations of texts. A text falls into parts where no piece has two characters in a row, and all that is
    needed of a part as a rule is its best way and how far the next is; A* runs on the parts whose alternatives a text's n
    best can hold. Many texts are cut, looked up, summed and laid end to end at once: a part is known by 64 bits of hash, its
    length and the sum of its characters, and what is known of it stands in arrays."""

    BITS = 20

    def __init__(self, vocab: Vocabulary, n: int):
        self.vocab, self.n, self.lattices = vocab, n, Lattices(vocab)
        # before a pick of alternatives come all picks of no worse ones, so the n best have at most n of those
        self.picks = [[p for p in itertools.product(range(n), repeat=k) if math.prod(c + 1 for c in p) <= n] for k in range(n)]
        letters = sorted({c for p in vocab.pairs for c in p})
        self.letter = np.zeros(0x110000, np.int32)  # 0: of no pair
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.pair = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for x, y in vocab.pairs:
            self.pair[self.letter[ord(x)], self.letter[ord(y)]] = True
        self.power, self.inverse = _powers(1 << 16, common.BASE), _powers(1 << 16, pow(common.BASE, -1, 1 << 64))
        self.ways: dict[str, list] = {}
        self.forget()

    def forget(self) -> None:
        self.key, self.number = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.int32)
        self.check = np.empty(0, np.int64)
        self.score, self.gap, self.right = np.empty(0), np.empty(0), np.empty(0, bool)
        self.ids, self.start, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _ways(self, part: str) -> list[tuple[float, tuple[int, ...]]]:
        """The n best of a part."""
        if len(self.ways) > MOST_PARTS // 8:
            self.ways = {}
        got = self.ways[part] = n_best(part, self.vocab, self.n)
        return got

    def _learn(self, parts: list[str], key: np.ndarray, check: np.ndarray, keep: bool = True) -> None:
        found = self.lattices(parts)
        # of equal ones the first by ids
        found = [(*n_best(p, self.vocab, 1)[0], 0.0) if f[2] == 0 else f for p, f in zip(parts, found)]
        names, first = self.vocab.names.__getitem__, len(self.score)
        score, ids, gap = zip(*found)
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        right = [b"".join(map(names, i)) == p.replace(SPACE, " ").encode("utf-8", "surrogatepass") for p, i in zip(parts, ids)]
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(ids), np.int32)])
        self.count, self.right = np.concatenate([self.count, count]), np.concatenate([self.right, right])
        self.score, self.gap, self.check = np.concatenate([self.score, score]), np.concatenate([self.gap, gap]), np.concatenate([self.check, check])
        if not keep:
            return
        mask, at = (1 << self.BITS) - 1, (key >> np.uint64(64 - self.BITS)).astype(np.int64)
        number, left = np.arange(first, first + len(key), dtype=np.int32), np.arange(len(key))
        while len(left):  # of those that want one free place, the first gets it
            free = left[self.key[at[left]] == 0]
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.key[at[put]], self.number[at[put]] = key[put], number[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = at[left] + 1 & mask

    def _find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The parts' numbers; -1: not known."""
        mask, at = (1 << self.BITS) - 1, (key >> np.uint64(64 - self.BITS)).astype(np.int64)
        out, left = np.full(len(key), -1, np.int64), np.arange(len(key))
        while len(left):
            there = self.key[at[left]]
            hit = there == key[left]
            out[left[hit]] = self.number[at[left[hit]]]
            left = left[~hit & (there != 0)]
            at[left] = at[left] + 1 & mask
        known = np.flatnonzero(out >= 0)
        out[known[self.check[out[known]] != check[known]]] = -1  # another part of the same hash
        return out

    def batch(self, texts: list[str | None]) -> list[tuple]:
        """Of each text: the best segmentation's score and ids, whether they decode to the text (a text is its parts in a
        row, so it does if each part's do), and of the others, in order, the score and what differs: from which of the best
        one's ids, how many give way, and to which."""
        wholes = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        whole = "".join(wholes)
        code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.cumsum([0, *map(len, wholes)])
        if len(self.power) <= len(code):
            self.power, self.inverse = _powers(len(code) + 1, common.BASE), _powers(len(code) + 1, pow(common.BASE, -1, 1 << 64))
        letter = self.letter[code]
        cut = np.ones(len(code) + 1, bool)
        cut[1:-1] = ~self.pair[letter[:-1], letter[1:]]
        cut[begin] = True
        edge = np.flatnonzero(cut) if len(code) else np.zeros(1, np.int64)
        s, e = edge[:-1], edge[1:]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common.mix(code + np.uint64(77)) * self.power[: len(code)], dtype=np.uint64)])
        key = common.mix((sums[e] - sums[s]) * self.inverse[s] + (e - s).astype(np.uint64)) | np.uint64(1)  # 0 is a free place
        plain = np.concatenate([[0], np.cumsum(code, dtype=np.int64)])
        check = (plain[e] - plain[s]) * 1024 + (e - s & 1023)
        at = self._find(key, check)
        new = np.flatnonzero(at < 0)
        if len(new):
            _, one = np.unique(key[new], return_index=True)
            if len(self.score) + len(one) > MOST_PARTS and len(self.score):
                self.forget()
                new = np.arange(len(key))
                _, one = np.unique(key, return_index=True)
            one = new[np.sort(one)]
            while 2 * (len(self.score) + len(one)) > 1 << self.BITS:  # one batch alone may have more than usual
                self.BITS += 1
                self.forget()
                new = np.arange(len(key))
                one = np.sort(np.unique(key, return_index=True)[1])
            self._learn([whole[x:y] for x, y in zip(s[one].tolist(), e[one].tolist())], key[one], check[one])
            at[new] = self._find(key[new], check[new])
            for k in np.flatnonzero(at < 0).tolist():
                self._learn([whole[s[k] : e[k]]], key[k : k + 1], check[k : k + 1], keep=False)
                at[k] = len(self.score) - 1
        count, score, gap, right = self.count[at], self.score[at], self.gap[at], self.right[at]
        stop = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(self.start[at] - stop[:-1], count) + np.arange(stop[-1])]
        ends, out = np.searchsorted(s, begin), []
        for x, y in zip(ends[:-1].tolist(), ends[1:].tolist()):
            if x == y:
                out.append((0.0, ids[:0], True, []))
                continue
            total, first = float(score[x:y].sum()), int(stop[x])
            part = lambda k, x=x: whole[s[x + k] : e[x + k]]
            others = self._others(part, gap[x:y], stop[x : y + 1] - first)
            out.append((total, ids[first : stop[y]], bool(right[x:y].all()), [(total - lost, changes) for lost, changes in others]))
        return out

    def _others(self, part: Callable[[int], str], gap: np.ndarray, stop: np.ndarray) -> list[tuple[float, list]]:
        """What the second to n-th best lose, and their changes: alternatives in the parts with the least gaps, the earlier
        of equal ones."""
        few = self.n - 1
        if len(gap) > few:
            most = np.partition(gap, few - 1)[few - 1]
            where = np.flatnonzero(gap <= most)
            where = where[np.argsort(gap[where], kind="stable")][:few]
        else:
            where = np.argsort(gap, kind="stable")
        where = [k for k in where.tolist() if gap[k] < math.inf]
        ways = [self.ways.get(x) or self._ways(x) for x in map(part, where)]
        picks = [pick for pick in self.picks[len(ways)] if all(map(int.__lt__, pick, map(len, ways)))]
        later = sorted(range(len(where)), key=lambda x: -where[x])
        combos = sorted((sum([w[0][0] - w[c][0] for w, c in zip(ways, pick)]), [pick[x] for x in later], pick) for pick in picks)
        place = [(int(stop[k]), int(stop[k + 1] - stop[k])) for k in where]
        return [(lost, sorted((*place[x], ways[x][c][1]) for x, c in enumerate(pick) if c)) for lost, _, pick in combos[1 : self.n]]

    def __call__(self, text: str | None) -> list[tuple[float, bytes]]:
        """The n best segmentations of the text: (score, ids as little-endian 32-bit numbers)."""
        ((score, ids, _, others),) = self.batch([text])
        return [(score, ids.tobytes()), *((s, edited(ids.tobytes(), changes)) for s, changes in others)]


def edited(raw: bytes, changes: list[tuple[int, int, tuple[int, ...]]]) -> bytes:
    """The ids with changes made."""
    out, done = [], 0
    for at, n, ids in changes:
        out += [raw[4 * done : 4 * at], np.array(ids, "<i4").tobytes()]
        done = at + n
    return b"".join([*out, raw[4 * done :]])


def segmentations(docs: DataFrame, model_path: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and segmentation: id_col, rank (from 1), score, n_pieces, ids_crc32, decodes (whether the ids decode
    to the text), ids and edits. The best one's ids stand in its row; each other has edits, by which it differs from that:
    from which id (at), how many give way (n), and to which (ids). whole() puts all ids back. No shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        if (model_path, n) not in ENCODERS:  # a worker keeps its memory of words from task to task
            ENCODERS.clear()
            ENCODERS[model_path, n] = Encoder(Vocabulary.load(model_path), n)
        enc = ENCODERS[model_path, n]
        name = enc.vocab.names.__getitem__
        said = lambda ids: b"".join(map(name, ids))
        for b in common.slices(batches, 2 << 20):
            rows, best_ids, empty = [], [], []
            for i, (score, ids, right, others) in zip(b.column(0).to_pylist(), enc.batch(b.column(1).to_pylist())):
                raw = ids.tobytes()
                rows.append((i, 1, score, len(ids), zlib.crc32(raw), right, []))
                best_ids.append(raw), empty.append(False)
                for r, (score, changes) in enumerate(others, 2):
                    same = right and all(said(ids[at : at + k].tolist()) == said(new) for at, k, new in changes)
                    rows.append((i, r, score, len(ids) + sum(len(new) - k for _, k, new in changes), zlib.crc32(edited(raw, changes)), same, [{"at": at, "n": k, "ids": new} for at, k, new in changes]))
                    best_ids.append(b""), empty.append(True)
            c = list(zip(*rows))
            cols = [pa.array(x, t) for x, t in zip(c, (b.column(0).type, pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()))]
            at = np.cumsum([0, *map(len, best_ids)]) // 4
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(np.frombuffer(b"".join(best_ids), "<i4")), mask=pa.array(empty))
            edit = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])
            yield pa.RecordBatch.from_arrays([*cols, lists, pa.array(c[6], pa.list_(edit))], [id_col, "rank", "score", "n_pieces", "ids_crc32", "decodes", "ids", "edits"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, rank int, score double, n_pieces long, ids_crc32 long, decodes boolean, ids array<int>, edits array<struct<at:int,n:int,ids:array<int>>>")


def whole(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """segmentations() with all ids in every row, for ids that are not null and stand for one document each."""
    best = found.filter("rank = 1").select(id_col, F.col("ids").alias("best"))
    start = F.struct(F.lit(0).alias("done"), F.expr("cast(array() as array<int>)").alias("out"))
    step = lambda acc, e: F.struct((e["at"] + e["n"]).alias("done"), F.concat(acc["out"], F.slice("best", acc["done"] + 1, e["at"] - acc["done"]), e["ids"]).alias("out"))
    ids = F.aggregate("edits", start, step, lambda acc: F.concat(acc["out"], F.slice("best", acc["done"] + 1, F.size("best"))))
    return found.join(best, id_col).withColumn("ids", F.when(F.col("rank") == 1, F.col("ids")).otherwise(ids)).drop("best", "edits")
