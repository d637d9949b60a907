"""Plain versions of what the operators compute, for small inputs."""

import hashlib
import re

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = []
    at = 0
    for m in ASSIGN.finditer(text or ""):
        if len(m[1]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for k, kind, pat, least in ((1, "access", r"AKIA[A-Z0-9]+", 20), (2, "hex", r"[0-9a-f]+", 24)):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(pat, text or "") if m.end() - m.start() >= least]
    return sorted(out)


def span_text(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def base_sha(text):
    return hashlib.sha256(span_text(base_spans(text)).encode()).hexdigest()


def shingles(text, n):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def jaccard_components(rows, n, pct):
    """rows: (doc_id, text); doc_id -> (set size, component), comparing all pairs that share an n-gram."""
    sets = [(d, shingles(t, n)) for d, t in rows]
    up = {d: d for d, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for i, (d, s) in enumerate(sets):
        seen = set()
        for g in s:
            for j in by.get(g, ()):
                if j in seen:
                    continue
                seen.add(j)
                e, t = sets[j]
                inter = len(s & t)
                if 100 * inter >= pct * (len(s) + len(t) - inter):
                    a, b = sorted((find(d), find(e)))
                    up[b] = a
            by.setdefault(g, []).append(i)
    return {d: (len(s), find(d)) for d, s in sets}


def repeated_bytes(rows, width=200):
    """rows: (doc_id, text); per row (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    count = {}
    for _, x in raw:
        for i in range(len(x) - width + 1):
            k = hash(x[i : i + width])
            count[k] = count.get(k, 0) + 1
    out = []
    for d, x in raw:
        cut = bytearray(len(x))
        for i in range(len(x) - width + 1):
            if count[hash(x[i : i + width])] > 1:
                cut[i : i + width] = b"\1" * width
        runs = len(re.findall(b"\1+", cut))
        out.append((d, len(x), sum(cut), runs, hashlib.sha256(bytes(c for c, k in zip(x, cut) if not k)).hexdigest()))
    return out


def quote_passages(text):
    """(level, text) of the runs of lines of one quote level; empty lines end a run."""
    out, open_ = [], False
    for line in re.split(r"\r\n?|\n", text or ""):
        m = re.match(r"[ \t]*((?:>[ \t]?)+)", line)
        level, said = (m[1].count(">"), line[m.end() :].rstrip(" ")) if m else (0, line.rstrip(" "))
        if not said.strip(" "):
            open_ = False
        elif open_ and out[-1][0] == level:
            out[-1][1].append(said)
        else:
            out.append((level, [said]))
            open_ = True
    return [(level, "\n".join(lines)) for level, lines in out]


def quotation_links(rows):
    """rows: (conv_id, turn, text), each turn once; (conv_id, turn) -> (n_quotes, quote_level, reply_to, link, thread_root, depth)."""
    plain = lambda x: re.sub(r"[^\w]+", " ", x.lower()).strip()
    said = {(c, t): quote_passages(x) for c, t, x in rows}
    texts = lambda ps, quoted: {(lv, y) for lv, x in ps if (lv > 0) == quoted for y in (plain(x), *map(plain, x.split("\n"))) if y}
    origin = {}
    for (c, t), ps in said.items():
        weight = {}
        for y in {y for _, y in texts(ps, True)}:
            level = min(lv for lv, z in texts(ps, True) if z == y)
            earlier = [u for (d, u), qs in said.items() if d == c and u < t and y in {z for _, z in texts(qs, False)}]
            if earlier:
                weight[level, max(earlier)] = weight.get((level, max(earlier)), 0) + len(y)
        if weight:
            origin[c, t] = min((lv, -n, -o) for (lv, o), n in weight.items())[2] * -1
    out = {}
    for (c, t), ps in said.items():
        root, depth = t, 0
        while (c, root) in origin:
            root, depth = origin[c, root], depth + 1
        before = [u for d, u in said if d == c and u < t]
        reply = origin.get((c, t), max(before, default=None))
        link = "quote" if (c, t) in origin else "previous" if before else "first"
        out[c, t] = (sum(lv > 0 for lv, _ in ps), max((lv for lv, _ in ps), default=0), reply, link, root, depth)
    return out
