"""The corpus pipeline against plain versions of its stages, on a small table with null and repeated ids."""

import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest

from loomgraph.llm import jaccard, langid

from . import brute


def sentence(seed, n=60):
    words = "the house on hill and river runs by it with many old stones near green fields where people walk each day to town".split()
    return " ".join(words[(seed * 7919 + k * k * (seed + 3)) % len(words)] for k in range(n))


BASE, PASSAGE = sentence(1), " ".join(f"common passage {k}" for k in range(20))
ROWS = [
    (1, BASE), (2, BASE + " end"), (3, sentence(2)), (3, BASE), (3, sentence(2)), (None, sentence(4)), (None, BASE), (None, sentence(4)), (None, sentence(5)),
    (5, sentence(6) + " " + PASSAGE), (6, sentence(7) + " " + PASSAGE), (7, sentence(8) + " password = hunter2hunter2 " + sentence(9)), (8, ""), (None, None), (9, "12 !"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", "s", len(t or ""), "a", "b", 3, "c", "d") for d, t in ROWS]
    # columns with the names that stages use themselves
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string, more string, tkey int, __text string, __row string").repartition(3)


def plain_keep_one(rows, n, pct):
    at = {k: (d is None, d or 0, k) for k, (d, _) in enumerate(rows)}
    of = brute.jaccard_components([(k, t) for k, (_, t) in enumerate(rows)], n, pct)
    first = {}
    for k, (_, component) in of.items():
        first[component] = min(first.get(component, at[k]), at[k])
    return [rows[k] for _, _, k in first.values()]


def test_keep_one_judges_each_row(docs):
    got = Counter((r["doc_id"], r["text"]) for r in jaccard.keep_one(docs).collect())
    assert got == Counter(plain_keep_one(ROWS, 5, 80)) and got[None, sentence(4)] == 1 and got[3, sentence(2)] == 1 and (None, BASE) not in got


def plain_cut(rows, width=200):
    count = Counter(t[k : k + width] for _, t in rows for k in range(len(t) - width + 1))
    for d, t in rows:
        gone = {j for k in range(len(t) - width + 1) if count[t[k : k + width]] > 1 for j in range(k, k + width)}
        if not gone or (left := "".join(c for j, c in enumerate(t) if j not in gone)).strip():
            yield d, left if gone else t


def plain_redact(t):
    for s, _, e, _ in reversed(brute.base_spans(t)):
        t = t[:s] + "[SECRET]" + t[e:]
    return t


def test_stages_keep_columns(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert {(r["spans"], r["more"], r["tkey"], r["__text"], r["__row"]) for r in out.collect()} == {("a", "b", 3, "c", "d")}, name


def test_run_equals_plain_stages(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    known = [(r["doc_id"], r["text"]) for r in langid.recognised(docs).collect()]
    assert Counter(known) == Counter((d, t) for d, t in ROWS if re.search("[a-z]", t or ""))
    left = [(d, plain_redact(t)) for d, t in plain_cut(plain_keep_one(known, 5, 80))]
    assert sum("[SECRET]" in t for _, t in left) == 1 and not any(PASSAGE in t for _, t in left)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((d, len(tok.encode(t, add_special_tokens=False).ids) + 1) for d, t in left)
    got = Counter((r["doc_id"], r["doc_tokens"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect() if r["start"] == 0)
    assert got == want
