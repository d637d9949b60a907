"""The engine's own operators by hand-written cases."""

import collections
import hashlib
import http.server
import json
import math
import random
import re
import threading
import time
import zlib

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import columns as C
from loomgraph.functions import fixed as V
from loomgraph.operators import chunk, clean, graph, metrics, normalize, tokenize, vectorize
from loomgraph.plans import catalogue, pipeline
from loomgraph.sources import files
from loomgraph.streaming import ingest


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize("text", ["$a$ b $$c\nd$$", "none", "$NbC$$x$", ""])
def test_restore_undoes_protect(spark, text):
    def both(t):
        m, b = C.protect(t, C.no_blocks(), V.FORMULA, "f")
        return C.restore(m, b)

    assert one(spark, text, both) == text


@pytest.mark.parametrize(("text", "want"), [("05.03.2020", "2020-03-05"), ("05.13.2020", "2020-05-13"), ("31.02.2020", "31.02.2020"), ("5 март 2020", "2020-03-05"), ("5 марта 2020", "5 марта 2020")])
def test_dates(spark, text, want):
    assert one(spark, text, normalize.dates) == want


@pytest.mark.parametrize(("text", "want"), [("920 °C", "1193,15 K"), ("9,5 мкм", "0,0000095 m"), ("150 МПа", "150000000 kg/m/s**2"), ("200 Дж", "200 kg*m**2/s**2"), ("10-180 °C", "10-180 K")])
def test_units(spark, text, want):
    assert one(spark, text, normalize.units) == want


def test_html_table_spans():
    t = clean.html_table("<table><tr><td colspan=2>a</td></tr><tr><td rowspan=2>b</td><td>c</td></tr><tr><td>d</td></tr></table>")
    assert t.split("\n") == ["| a |  |", "| --- | --- |", "| b | c |", "|  | d |"]


@pytest.mark.parametrize(("n", "kept"), [(5, 5), (6, 0), (7, 0)])
def test_repeated_lines(spark, n, kept):
    text = "\n".join(["Page head 1"] * n + ["body"])
    got = clean.repeated_lines(spark.createDataFrame([(1, text)], "id long, t string"), "id", "t").first()["t"]
    assert got.count("Page head 1") == kept


def test_splitter_covers_the_text_within_size():
    text = ". ".join(f"sentence number {k} goes on" for k in range(200))
    parts = chunk.split_recursive(text, 50, 0)
    assert all(chunk.estimate(p) <= 50 for p in parts) and "".join("".join(parts).split()) == "".join(text.split())


def test_reply_parser():
    row = '["E","Nb","T","d","a; b","q"]'
    assert [len(x) for x in graph.parse_reply(f'[{row},["R","Nb","X","T","q",3]]')] == [1, 1]
    assert [len(x) for x in graph.parse_reply(f'[{row},["R","Nb","X","T","q",3]')] == [1, 1]
    assert [len(x) for x in graph.parse_reply(row + '\n["R","Nb","unfinished')] == [1, 0]


@pytest.mark.parametrize(("label", "ok"), [("процесс", False), ("Таблица 1", False), ("20 мм", False), ("steel", False), ("Nb", True), ("Сталь", True)])
def test_label_rules(spark, label, ok):
    assert one(spark, label, graph.is_label) is ok


@pytest.mark.parametrize("partitions", [1, 8])
def test_edge_fold_overwrites_by_type(spark, partitions):
    rows = [(1, "T1", 2, "q1"), (2, "T1", 3, "q2"), (3, "T2", 2, "q3"), (4, "T1", 3, "q4")]
    df = spark.createDataFrame([(s, t, w, q, "a", "b") for s, t, w, q in rows], "seq int, type string, weight int, quote string, source_id string, target_id string").repartition(partitions)
    e = graph.edges(df).first()
    assert (e["relation"], e["weight"], e["evidence"]) == ("T2", 3, "q4")


def test_terms_longest_first(spark):
    df = spark.createDataFrame([("IF-стали и IF",)], "t string")
    t, found = tokenize.mask_terms(F.col("t"))
    r = df.select(t.alias("t"), found.alias("f")).first()
    assert (r["t"], list(r["f"])) == ("[ABBREV_0] и [ABBREV_1]", ["IF-стали", "IF"])


def test_graphml_and_markdown_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("x\ny", encoding="utf-8")
    assert [tuple(r) for r in files.markdown(spark, str(tmp_path)).collect()] == [("a.md", "x\ny")]
    n = spark.createDataFrame([(1, "N1", "T", "l", "", "", "")], "seq int, node_id string, node_type string, label string, description string, aliases string, evidence string")
    e = spark.createDataFrame([("N1", "N2", "N1", "N2", "R", 2, "q<")], "u string, v string, source string, target string, relation string, weight int, evidence string")
    files.graphml(n, e, str(tmp_path / "g.xml"))
    assert "q&lt;" in (tmp_path / "g.xml").read_text() and 'edgedefault="undirected"' in (tmp_path / "g.xml").read_text()


def test_token_mask_counts(spark):
    df = spark.createDataFrame([(1, 0, "IF-стали и API: $x^2$ при 20 мм.")], "doc_id long, chunk_index int, text string")
    r = tokenize.tokenize(df, "doc_id").first()
    assert (len(r["formulas"]), len(r["numunits"]), len(r["abbreviations"]), r["round_trip"]) == (1, 1, 2, True)


@pytest.mark.parametrize(("text", "n"), [("One two. Three four! Five?", 3), ("", 0), ("no end", 1)])
def test_sentences(spark, text, n):
    assert len(one(spark, text, tokenize.sentences)) == n


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_abbreviations_of_whole_texts(spark, tmp_path):
    head = "Interstitial-Free стали, Transformation Induced Plasticity, Product Specification Level и ррт: xррт. "
    words = list(V.ABBREVIATIONS)
    texts = {1: "far " * 500 + words[0] + ", x" + words[0] + " " + words[-1] + ".", 2: "none", 3: ""}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))

    def plain(t):
        for w, short in V.ABBREVIATIONS.items():
            t = re.sub(rf"(?<!\w){re.escape(w)}(?!\w)", lambda _: short, t)
        return t

    assert plain(texts[1]) != texts[1]
    got = {r["doc_id"]: r["h"] for r in catalogue.queries()["norm_abbreviations"](spark, str(tmp_path)).collect()}
    assert got == {k: md5(plain(head + t)) for k, t in texts.items()}


def test_html_tables_of_whole_pages(spark):
    filler = "<p>" + "word " * 500 + "</p>"
    pages = {
        1: (filler + "<TABLE class=t><tr><td>p</td><td>q&amp;r</td></tr><tr><td colspan=2>s</td></tr></TABLE>end", filler + "\n| p | q&r |\n| --- | --- |\n| s |  |\nend"),
        2: (filler, filler), 3: ("a<table></table>b", "a\n<table></table>\nb"), 4: ("", ""), 5: ("<table><tr><td>a<b>c</b><!-- x -->d</td></tr></table>", "\n| a c d |\n| --- |\n"),
    }
    got = {r["k"]: r["x"] for r in spark.createDataFrame([(k, h) for k, (h, _) in pages.items()], "k int, t string").select("k", clean.html_tables(F.col("t")).alias("x")).collect()}
    assert got == {k: md for k, (_, md) in pages.items()}


#: Math that looks like links and tables, tables with markup and pipes, and what else a document may hold.
MIXED = "# H\nsee $[a](b)$ and $P(|x|>1)$ end\n\n| y\\|z | **w** |\n|:-|-:|\n\n| `a` | [t](u) $|q|$ |\n\n<table><tr><td>1</td><td>x|y</td></tr></table>\n$$\nm | n | o\n$$\n![i](d)[r](s) ~~k~~ <!-- c\n --> <b>z</b>\n12\n- item\t2\u00a0x\nС-Мп-Мо-№-В-стали"


def test_clearing_keeps_math_and_tables(spark):
    want = "H\nsee $[a](b)$ and $P(|x|>1)$ end\n\n| y\\|z | w |\n| --- | --- |\n\n| `a` | [t](u) $|q|$ |\n\n| 1 | x\\|y |\n| --- | --- |\n\n$$\nm | n | o\n$$\n\nr k z\n\nitem 2 x\nC-Mn-Mo-Nb-V-стали\n"
    df = spark.createDataFrame([(1, MIXED), (2, "plain"), (3, ""), (4, None), (5, "é\r\nx  \n\n\n\ny")], "id long, text string")
    got = {r["id"]: r for r in clean.clean(df, "id", counts_col="n").collect()}
    # a row that math stands in is text to this step: markers are no row, so links in it go too
    assert got[1]["text"] == want.replace("| `a` | [t](u) $|q|$ |", "| a | t $|q|$ |")
    assert {k: got[k]["text"] for k in (2, 3, 4, 5)} == {2: "plain\n", 3: "", 4: "", 5: "é\nx\n\ny\n"}
    assert {k: v for k, v in got[1]["n"].items() if not k.startswith("chars")} == {
        "display_math_protected": 1, "inline_math_protected": 3, "images_removed": 1, "markdown_links_normalized": 2, "html_tables_protected": 1, "markdown_tables_protected": 1, "html_comments_removed": 1, "html_tags_removed": 2,
        "page_numbers_removed": 1, "markdown_headings_removed": 1, "markdown_list_markers_removed": 1,
    }
    assert got[5]["n"]["line_endings_normalized"] == 1 and got[2]["n"] == {"chars_before": 5, "chars_after": 6}


def test_normalization_of_whole_documents(spark):
    text = "On 05.03.2020 at 920 °C\n| T, °C | d |\n| --- | --- |\n| 150 МПа | 05.03.2020 |\n| $5 мм$ |\nlast 1.5"
    want = "On 2020-03-05 at 1193,15 K\n\n| T, K | d |\n| --- | --- |\n| 150000000 kg/m/s**2 | 2020-03-05 |\n| $5 мм$ |  |\n\nlast 1,5\n"
    df = spark.createDataFrame([(1, text, "x"), (2, None, "y")], "id long, text string, b string")
    assert [tuple(r) for r in normalize.normalize(df).orderBy("id").select("id", "text", "b").collect()] == [(1, want, "x"), (2, "", "y")]


def plain_split(text, size, overlap, length, seps):
    """The splitter's rules once more, by repeated joining."""
    sep = next((s for s in seps if s in text), seps[-1])
    finer = seps[seps.index(sep) + 1 :] if sep in text else []
    parts = re.findall(f"(?s)(?:^|{re.escape(sep)})(?:(?!{re.escape(sep)}).)*", text)
    out, window = [], []
    total = lambda w: sum(map(length, w)) + max(0, len(w) - 1) * length("")

    def close():
        nonlocal window
        if window and (x := "".join(window).strip()):
            out.append(x)
        window = []

    for p in [p for p in parts if p]:
        if length(p) >= size:
            close()
            out.extend(plain_split(p, size, overlap, length, finer) if finer else [p.strip()] if p.strip() else [])
            continue
        if window and total(window) + length(p) + length("") > size:
            if x := "".join(window).strip():
                out.append(x)
            while window and (total(window) > overlap or total(window) + length(p) + length("") > size):
                window = window[1:]
        window.append(p)
    close()
    return out


@pytest.mark.parametrize("seed", range(6))
def test_recursive_split_equals_the_plain_one(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["a", "bc", "def ghi", ". ", "! ", "; ", ", ", " ", "\n", "\n\n", "x" * 70]) for _ in range(400))
    for size, overlap in ((5, 0), (12, 4), (30, 10)):
        assert chunk.split_recursive(text, size, overlap) == plain_split(text, size, overlap, chunk.estimate, list(V.SEPARATORS))


def test_chunks_keep_tables_and_count_pieces(spark):
    table = "\n".join(f"| row {k} | value {k} |" for k in range(40))
    text = "Intro sentence here. " * 30 + "\n" + table + "\nClosing words follow. " + "More of them, 20 мм each. " * 40
    df = spark.createDataFrame([(1, text), (2, None), (3, "short")], "id long, text string")
    rows = chunk.chunks(df, "id", "text", 60, 0.15).orderBy("id", "chunk_index").collect()
    assert sum(table in r["text"] for r in rows) == 1 and [r["text"] for r in rows if r["id"] == 3] == ["short"] and all(r["chars"] == len(r["text"]) and r["tokens"] == chunk.estimate(r["text"]) for r in rows)
    P = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    count = chunk.counter_of(P)
    sized = chunk.chunks(df, "id", "text", 60, 0.15, tokenizer=P).collect()
    assert all(r["tokens"] == count(r["text"]) for r in sized) and [r["chars"] for r in sized] != [r["chars"] for r in rows]
    said = chunk.broken(df, chunk.chunks(df, "id", "text", 60, 0.0), "id", "text").orderBy("id").collect()
    assert (said[0]["paragraphs"], said[0]["broken_paragraphs"], said[0]["formulas"], said[2]["broken_sentences"]) == (1, 1, 0, 0)


def test_overlap_starts_at_a_sentence():
    text = "One is here. Two is there. Three is gone."
    assert chunk.aligned_tail(text, "next", 7) == "One is here. Two is there. Three is gone."[13:] and chunk.aligned_tail(text, "x Three is gone.", 3) == ""
    assert chunk.aligned_tail("no end at all", "next", 7) == "" and chunk.flatten("a\n  b\n| 1 | 2 |\n| 3 | 4 |\n\n| 5 | 6 |\nc  d") == "a b | 1 | 2 |\n| 3 | 4 | | 5 | 6 | c d"


def test_encoder_pieces(spark):
    P = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    text = "Unusually long words, $x^2$ and naïve café. IF at 20 мм!"
    df = spark.createDataFrame([(1, 0, text)], "id long, chunk_index int, text string")
    r = tokenize.tokenize(df, "id", tokenizer=P).first()
    assert r["round_trip"] and "".join(t for t in r["tokens"] if "\ufffd" not in t and not t.startswith("[")).startswith("Unusually long words, ") and r["token_count"] == 18
    assert [t for t in r["tokens"] if t in ("x", "^", "2")] == ["x", "^", "2"] and "[NUMUNIT_0]" in r["tokens"] and "[ABBREV_0]" in r["tokens"]
    words = spark.createDataFrame([(["the", "antidisestablishment", "日本語", "IF"],)], "tokens array<string>")
    assert tuple(tokenize.vocabulary_check(words, None, tokenizer=P).first()) == (3, 2, 1)


def test_replies_hold_the_whole_text(spark, tmp_path, monkeypatch):
    texts = ['say "x" [1, {"a": [2]}] \\ \\n ' + "far " * 500 + '["E","Ti","T"] end\t', "a\r\nb\u2028\x01é😀", " ", "", None]
    spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)], "conv_id long, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    run = lambda: sorted(tuple(r) for r in catalogue.queries()["parse_llm_output"](spark, str(tmp_path)).collect())
    assert run() == [(1, k, 1, 1, "Nb") for k in range(5)]
    seen, parsed = [], graph.parsed
    monkeypatch.setattr(graph, "parsed", lambda reply: seen.append(reply) or parsed(reply))
    run()
    got = [graph.parse_reply(r["x"]) for r in spark.read.parquet(str(tmp_path / "conversations.parquet")).orderBy("turn").select(seen[0].alias("x")).collect()]
    assert [r[0][3].strip("«»") for _, r in got] == [t or "" for t in texts]


def test_mask_counts_vocabulary_and_quotes_of_whole_texts(spark, tmp_path):
    texts = {1: "10 mm and API, API at 5 kg. $y$ end", 2: "Alpha beta  gamma delta EPSILON zeta eta theta", 3: "xalpha beta gamma delta epsilon zetax", 4: "a cat", 5: "none", 6: ""}
    quotes = {1: "alpha beta gamma delta epsilon zeta", 2: "cat", 3: "beta delta gamma epsilon alpha zeta", 4: "", 5: "alpha beta gamma delta epsilon zeta eta theta iota"}
    spark.createDataFrame([(k, t, "s") for k, t in texts.items()], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(quotes.items()), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    run = lambda name: catalogue.queries()[name](spark, str(tmp_path)).collect()
    of = {r["doc_id"]: r for r in run("token_mask_counts")}
    assert all(r["round_trip"] for r in of.values()) and all(r["round_trip"] for r in run("token_masks"))
    counts = lambda t: len(re.findall(C.NUMUNIT, t))
    head = "IF-стали и API: $x^2$ при 20 мм. "
    assert {k: (r["formulas"], r["numunits"]) for k, r in of.items()} == {k: (1 + (k == 1), counts(head + t)) for k, t in texts.items()}
    assert of[1]["abbreviations"] == of[5]["abbreviations"] + 2 * ("API" in V.TERMS)
    plain = lambda ts: {w for t in ts for w in re.findall(r"[A-Za-z][A-Za-z-]*|[0-9]+", t) if len(w) >= 3}
    w, known = plain(texts.values()), plain(quotes.values())
    assert [tuple(r) for r in run("unknown_words")] == [(len(w), len(w - known))] and len(w - known) < len(w)
    key = lambda x: " ".join(x.lower().split())
    want = {(q, d) for q, x in quotes.items() for d, t in texts.items() if key(x) and key(x) in key(t)}
    assert sorted(tuple(r) for r in run("benchmark_quotes")) == sorted(want) and len(want) == 3


def test_unknown_formula_mode_is_an_error(spark):
    with pytest.raises(ValueError):
        tokenize.formula_tokens(F.lit("$x$"), "tree")
    assert one(spark, "$x$", lambda t: tokenize.formula_tokens(t, "ast")) is None and one(spark, "$x$", lambda t: tokenize.formula_tokens(t, "ast", lambda f: F.array(F.lit("Symbol"), f))) == ["Symbol", "x"]
    assert one(spark, "$x+1$", tokenize.formula_tokens) == ["x", "+", "1"]


def test_every_oracle_has_a_query():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


def test_types_and_ontology():
    assert graph.types_of("a b, c-d,, A B") == ("A_B", "C_D") and graph.types_of(None) == () and graph.types_of(["x", "X"]) == ("X",) and graph.types_of(5) == ("5",)
    o = graph.Ontology.of({"entity_types": "материал, свойство", "min_relation_weight": 3, "strict_types": False, "llm_url": "x"})
    assert (o.entity_types, o.least_weight, o.strict_types) == (("МАТЕРИАЛ", "СВОЙСТВО"), 3, False)
    with pytest.raises(ValueError):
        graph.Ontology.of({"strict_types": "yes"})


def test_reply_kinds_in_any_case():
    assert [len(x) for x in graph.parse_reply('[" e ","Nb","T"]\n["r","Nb","X","T","q","3"]\n["R","Nb","X","T","q",1]')] == [1, 1]
    assert graph.parse_reply('["E",null,"T"]') == ([], []) and len(graph.parse_reply("\n".join(f'["E","n{k}","T"]' for k in range(20)))[0]) == 12


QUOTE = "ниобий тормозит рекристаллизацию"
ANSWER = "\n".join(json.dumps(x, ensure_ascii=False) for x in (["E", "Nb", "ХИМИЧЕСКИЙ_ЭЛЕМЕНТ"], ["E", "рекристаллизация", "ТЕХНОЛОГИЧЕСКИЙ_ПРОЦЕСС"], ["R", "Nb", "рекристаллизация", "ТОРМОЗИТ", QUOTE, 3]))


@pytest.fixture
def server():
    """A model server; answer and status may be set, calls are kept."""
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            s = self.server
            s.calls.append((self.path, json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            body = json.dumps(s.answer).encode()
            self.send_response(s.status)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    s.answer, s.status, s.calls = {"done": True, "message": {"content": ANSWER}}, 200, []
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield s
    s.shutdown()


def model(s):
    return files.http_model(f"http://127.0.0.1:{s.server_port}", "some:9b")


def test_model_requests_and_errors(server, caplog):
    assert model(server)([QUOTE]) == [ANSWER]
    path, body = server.calls[0]
    assert path == "/api/chat" and body["messages"][0]["content"] == QUOTE and body["model"] == "some:9b" and body["think"] is False and body["stream"] is False and body["options"]["num_ctx"] == 8192 and "format" not in body
    server.answer = {"done": True, "done_reason": "length", "message": {"content": ""}}
    assert model(server)(["x"]) == [""] and "cut" in caplog.text
    server.answer = {"done": True, "message": {}}
    with pytest.raises(RuntimeError, match="message.content"):
        model(server)(["x"])
    server.answer, server.status = {"error": "model not found"}, 404
    with pytest.raises(RuntimeError, match="ollama pull some:9b"):
        model(server)(["x"])


def test_default_graph_of_cleared_markdown(spark, server, tmp_path):
    image = "A" * 100_000
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "sample.md").write_text(f'{QUOTE}\n![image](data:image/png;base64,{image})\n<img src="data:image/png;base64,{image}">', encoding="utf-8")
    cleared = clean.clean(files.markdown(spark, str(tmp_path / "in")))
    r = pipeline.default_graph_run(cleared, model(server), str(tmp_path / "out"))
    assert r.success and len(server.calls) == 1 and "data:image" not in server.calls[0][1]["messages"][0]["content"] and (r.frames["nodes"].count(), r.frames["edges"].count()) == (2, 1)
    m = json.loads((tmp_path / "out" / "metrics.json").read_text())
    assert (m["counters"]["files_processed"], m["counters"]["chunks_processed"], m["counters"]["relations_added"]) == (1, 1, 1) and m["quality"]["relation_acceptance_rate"] == 1.0
    assert (tmp_path / "out" / "knowledge_graph.graphml").read_text().count("<edge ") == 1


def test_graph_run_reads_vectors_and_reports_failures(spark, server, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "sample.vectors.json").write_text(json.dumps({"chunks": [{"index": 0, "dense_text": QUOTE}, {"index": 1, "dense_text": " "}]}), encoding="utf-8")
    (tmp_path / "v" / "sample.tables.vectors.json").write_text(json.dumps({"tables": []}))
    read = files.artifacts(spark, str(tmp_path / "v"), ".vectors.json", ".tables.vectors.json")
    chunks = read.select(F.col("file").alias("source_file"), F.posexplode("chunks").alias("chunk_index", "c")).select("source_file", "chunk_index", "c.dense_text")
    r = pipeline.graph_run(chunks, model(server), str(tmp_path / "out"), template="Find in: {chunk_text}")
    assert r.success and len(server.calls) == 1 and server.calls[0][1]["messages"][0]["content"] == "Find in: " + QUOTE
    e = r.frames["edges"].first()
    assert (e["relation"], e["weight"], e["evidence"]) == ("ТОРМОЗИТ", 3, QUOTE)
    server.answer, server.status = {"error": "model not found"}, 404
    bad = pipeline.graph_run(chunks, model(server), str(tmp_path / "bad"))
    assert not bad.success and "model not found" in bad.errors[0] and not (tmp_path / "bad" / "knowledge_graph.graphml").exists()


def test_stages_stop_at_the_first_error():
    def fails(_):
        raise ValueError("no such folder")

    out = pipeline.run_stages([pipeline.Stage("a", lambda f: {"y": f["x"]}), pipeline.Stage("b", fails), pipeline.Stage("c", lambda f: {})], {"x": None})
    assert [(r.stage, r.success) for r in out] == [("a", True), ("b", False)] and out[1].errors == ["b: no such folder"]


def test_table_records_of_files(spark, tmp_path):
    d = tmp_path / "tables"
    stems = spark.createDataFrame([("a",), ("b",), ("c",), ("none",)], "stem string")
    assert {r["status"] for r in files.table_records(spark, str(d), stems)[1].collect()} == {"dir_missing"} and files.table_records(spark, str(d), stems)[0].count() == 0
    d.mkdir()
    one_record = {"source_file": "a.md", "shape": {"rows": 1, "columns": 2}, "columns": [{"name": "T", "dtype": "float64", "unit": "K"}, {"name": "n", "dtype": "object", "unit": None}], "rows": [{"T": 1.5, "n": None}]}
    (d / "a.tables.json").write_text(json.dumps([one_record, {**one_record, "table_index": 7}]))
    (d / "b.tables.json").write_text(json.dumps(one_record))
    (d / "c.tables.json").write_text("{no json")
    records, status = files.table_records(spark, str(d), stems)
    assert {r["stem"]: r["status"] for r in status.collect()} == {"a": "ok", "b": "ok", "c": "invalid", "none": "file_missing"}
    assert sorted((r["stem"], r["table_index"], r["rows"][0]["T"], r["rows"][0]["n"]) for r in records.collect()) == [("a", 0, "1.5", None), ("a", 7, "1.5", None), ("b", 0, "1.5", None)]


def test_texts_are_written_as_files(spark, tmp_path):
    rows = {"a.md": "x\ny\n", "b c=1.md": "no end", "d.md": "", "e.md": "\n"}
    files.write_text(spark.createDataFrame(list(rows.items()), "source_file string, text string"), str(tmp_path / "out"))
    assert {p.name: p.read_bytes().decode() for p in (tmp_path / "out").glob("*.md")} == rows and not (tmp_path / "out" / "_parts").exists()
    with pytest.raises(ValueError):
        files.write_text(spark.createDataFrame([("a", "x"), ("a", "y")], "source_file string, text string"), str(tmp_path / "two"))


def test_metrics_documents(spark):
    docs = spark.createDataFrame([("a", "One sentence is here now. " * 40), ("b", "x")], "source_file string, text string")
    c = chunk.chunks(docs, size=40)
    broken = chunk.broken(docs, c, "source_file", "text")
    counts = metrics.chunk_counts(c, "source_file", 50, 5).union(metrics.broken_counts(broken, "source_file"))
    m = metrics.document("chunking", metrics.per_file(counts, "source_file", F.col("counts")))
    n = c.collect()
    sizes = [r["tokens"] for r in n]
    assert m["counters"]["chunks_created"] == len(n) and m["counters"]["files_processed"] == 2 and m["quality"]["chunk_tokens_mean"] == round(sum(sizes) / len(sizes), 4) and m["quality"]["hit_rate"] is None
    assert m["counters"]["sentences_total"] == 40 and [r["file"] for r in m["per_file"]] == ["a", "b"] and metrics.quality({}, "chunking")["overlap_ratio"] is None
    assert metrics.missed({"overlap_ratio": 0.5, "chunk_tokens_std": 100.0, "broken_sentences_ratio": None}, "chunking") == {"overlap_ratio": 0.5}
    t = metrics.document("tokenization", metrics.per_file(metrics.token_counts(tokenize.tokenize(c), "source_file"), "source_file", F.col("counts")))
    assert t["quality"]["roundtrip_ratio"] == 1.0 and t["quality"]["formulas_correct_ratio"] is None and not metrics.missed(t["quality"], "tokenization")


def test_created_nodes_serve_later_relations(spark):
    rel = lambda s, t: {"source": s, "target": t, "type": "ТРЕБУЕТ", "quote": "q", "weight": 2}
    rows = [("f", 0, "q", [], [rel("Сталь", "Чугун")]), ("f", 1, "q", [{"name": "чугун", "type": "МАТЕРИАЛ", "description": "", "aliases": [], "evidence": ""}], [rel("сталь", "чугун"), rel("", "чугун")])]
    df = spark.createDataFrame(rows, "source_file string, chunk_index int, text string, entities array<struct<name:string,type:string,description:string,aliases:array<string>,evidence:string>>, relations array<struct<source:string,target:string,type:string,quote:string,weight:int>>")
    n, e, g = pipeline.graph_of(df, graph.Ontology(strict_types=False, drop_unresolved=False))
    got = {r["node_id"]: (r["node_type"], r["label"]) for r in n.collect()}
    ends = sorted((r["seq"]["chunk_index"], got[r["source_id"]], got[r["target_id"]]) for r in g.filter("drop_reason is null").collect())
    assert ends == [(0, ("КОНЦЕПЦИЯ", "Сталь"), ("КОНЦЕПЦИЯ", "Чугун")), (1, ("КОНЦЕПЦИЯ", "Сталь"), ("МАТЕРИАЛ", "чугун"))] and [r["drop_reason"] for r in g.filter("drop_reason is not null").collect()] == ["source"]
    assert pipeline.graph_of(df, graph.Ontology())[1].count() == 0


def test_documents_as_a_stream(spark, tmp_path):
    rows = [(1, MIXED), (2, "One. Two. " * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(str(tmp_path / "in"))
    q = ingest.cleaned_chunks(ingest.documents(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("chunked").trigger(availableNow=True).start()
    q.awaitTermination(60)
    want = chunk.chunks(clean.clean(df, "doc_id"), "doc_id").collect()
    assert sorted(map(tuple, spark.table("chunked").collect())) == sorted(map(tuple, want)) and len(want) > 1


def test_a_large_table_is_read_in_linear_time(spark):
    """Header and width are no part of what is done for each row: 20,000 rows took the square of it."""
    body = "\n".join(f"| {k} | b{k} |" for k in range(20000))
    d = spark.createDataFrame([(f"| a | b | c |\n| --- | --- | --- |\n{body}",)], "t string")
    began = time.time()
    x = d.select(vectorize.parse_markdown(F.col("t")).alias("x")).select(F.col("x.header").alias("h"), F.size("x.rows").alias("n"), F.element_at("x.rows", -1).alias("last")).first()
    assert (x["h"], x["n"], x["last"]) == (["a", "b", "c"], 20000, ["19999", "b19999", ""]) and time.time() - began < 60


def test_a_row_carries_its_own_formulas_alone(spark):
    """With a table's formulas in each of its rows and cells, 4,000 rows of long ones were tens of GB."""
    long = "z" * 1000
    rows = "\n".join(f"| {k} | $|x{k}|{long}$ and \\(y{k}\\) |" for k in range(4000))
    d = spark.createDataFrame([(1, f"| k | $|f|$ |\n| --- | --- |\n{rows}\n")], "id long, text string")
    began = time.time()
    got = normalize.table_cells(normalize.table_blocks(d, "id", "text"), "id").filter("col = 1").orderBy("row").select("name", "str").collect()
    assert [tuple(r) for r in got] == [("$|f|$", f"$|x{k}|{long}$ and \\(y{k}\\)") for k in range(4000)] and time.time() - began < 60


def test_tokens_are_counted_once(spark):
    """TF, df, lengths and ids all come from one count; each use made the tokens anew."""
    d = spark.createDataFrame([("d", 0, ["a", "b", "a"]), ("d", 1, ["b"]), ("e", 0, [])], "source_file string, chunk_index int, tokens array<string>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for ids, reused in ((False, 2), (True, 3)):
            v = vectorize.sparse(vectorize.unit_tokens(d, "source_file", "chunk_index", F.col("tokens")), ids=ids)
            assert v._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= reused
            assert sorted((r["chunk_index"], r["token"]) for r in v.collect()) == [(0, "a"), (0, "b"), (1, "b")]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hash_vectors_are_spread_by_their_places(spark):
    """Zeros are laid between a vector's places; each of 384 places was looked up among them."""
    tokens = [[], ["a"], ["a", "b", "a"], [f"t{k}" for k in range(2000)], None]
    v = spark.createDataFrame([(t,) for t in tokens], "t array<string>").select(vectorize.hash_vector(F.col("t")).alias("v"))
    assert "sequence(" not in v._jdf.queryExecution().optimizedPlan().toString()
    for t, row in zip(tokens, v.collect()):
        c = collections.Counter(zlib.crc32(x.encode()) % 384 for x in t or [])
        norm = math.sqrt(sum(n * n for n in c.values()))
        assert row["v"] == [round(c[k] / norm, 6) if c[k] else 0.0 for k in range(384)]


def test_python_gets_batches_of_a_few_megabytes(spark, tmp_path):
    """Batches were of 10,000 rows, however long their texts."""
    spark.range(2000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 4000).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")

    @F.pandas_udf("long")
    def long_together(s):
        return s.str.len() * 0 + len(s)

    d = catalogue._docs(spark, str(tmp_path)).coalesce(1)
    assert d.select(long_together("text").alias("n")).agg(F.max("n")).first()[0] < 300


def test_texts_are_matched_once(spark):
    """Each use of a text's matches went over the text again: finding, asking, replacing, six times for terms."""
    d = spark.range(1).select(F.concat(F.lit("IF и API, IF-стали "), F.col("id").cast("string")).alias("t"))
    for f in (tokenize.masked_terms, lambda t: tokenize.masked(t, C.NUMUNIT, "NUMUNIT"), normalize.scientific):
        plan = d.select(f(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        assert "RLIKE" not in plan and plan.count("regexp_extract_all(") <= plan.count("Contains(") + plan.count("contains(")


@pytest.mark.parametrize("text", ["20 мм and 5 kg", "a\ue00420 мм b\ue004", "\ue004", "none", "", "20 мм"])
def test_matches_and_gaps_of_one_pass(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(C.matches(C.parts(F.col("t"), C.NUMUNIT)).alias("m"), C.rewrite(F.col("t"), C.NUMUNIT, lambda m, i: F.concat(F.lit("<"), i.cast("string"), m, F.lit(">"))).alias("r")).first()
    found = [m[0] for m in re.finditer(C.NUMUNIT, text)]
    number = iter(range(9))
    assert got["m"] == found and got["r"] == re.sub(C.NUMUNIT, lambda m: f"<{next(number)}{m[0]}>", text)


@pytest.mark.parametrize("text", [" a  b ", "a\tb\n\nc", "a \u2003b\u00a0c", "a b c", "", " ", "\u3000x\x1f y\x85", "a \n"])
def test_squeeze(spark, text):
    assert one(spark, text, C.squeeze) == " ".join(text.split()) and one(spark, text, lambda t: C.same_words(t, F.concat(F.lit("\n"), t)))


def test_labels_are_cleaned_once(spark):
    """Each name was cleaned anew for symbol, Russian name and label, in the filter and in the row."""
    e = spark.createDataFrame([("f", 0, [("«Nb»", "материал", "", "", [])])], "source_file string, chunk_index int, entities array<struct<name:string,type:string,description:string,evidence:string,aliases:array<string>>>")
    d = graph.entities(e)
    assert d._jdf.queryExecution().optimizedPlan().toString().count("^[") <= 6 and [r["label"] for r in d.collect()] == ["Nb"]


def plan(spark, f):
    return spark.createDataFrame([("1",)], "t string").select(f(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()


def test_numbers_are_computed_once(spark):
    said = plan(spark, normalize.scientific)
    assert said.count("POWER(") == 2 and "regexp_extract(" not in said


@pytest.mark.parametrize(("text", "want"), [("3·10^99999999999", "Infinity"), (f"{C.SIGN}2e-4 5·10^3", f"{C.SIGN}0,0002 5000"), ("2e3·10^4, -1e-30", "2000·10^4, -1,000000e-30"), ("0e5 7x10 15", "0 7,000000e+15")])
def test_scientific(spark, text, want):
    assert one(spark, text, normalize.scientific) == want


def test_unit_patterns_share_beginnings():
    for words in (V.UNITS, C._ALONE):
        short, long = (re.compile(f"({f(words)})(?![0-9A-Za-zА-Яа-яЁё])") for f in (C.tree, C.alternation))
        texts = [a + b for a in words for b in ("", " ", "2", "²", "/с", "**2", "·м", "м")]
        assert [short.match(t) and short.match(t)[1] for t in texts] == [long.match(t) and long.match(t)[1] for t in texts]


def test_unit_is_looked_up_once(spark):
    said = plan(spark, normalize.units)
    assert "regexp_extract(" not in said and "rlike" not in said.lower()


@pytest.mark.parametrize(("text", "want"), [(f"{C.SIGN}5 МПа; мм", f"{C.SIGN}5000000 kg/m/s**2; m"), ("2 м**2, 3 мм", "2 m**2, 0,003 m"), ("-4 °C мм", "269,15 K m"), ("7 с2", "7 с2")])
def test_units_by_groups(spark, text, want):
    assert one(spark, text, normalize.units) == want


def test_clearing_passes_only_where_something_is(spark):
    df = spark.createDataFrame([(1, "été plain"), (2, "été $x$")], "id long, text string")
    got = df.select("id", clean.aside(F.col("text"), clean.CleanConfig()).alias("a")).collect()
    assert {r["id"]: r["a"]["text"] is None for r in got} == {1: True, 2: False}
    said = clean.clean(df, "id", counts_col="n")._jdf.queryExecution().optimizedPlan().toString()
    assert said.count("regexp_count(") == said.count("ELSE regexp_count(") + said.count("THEN regexp_count(")


def test_clearing_counts_and_blanks(spark):
    df = spark.createDataFrame([(1, "a \n\x01\x7f​# h\n> q\n---\nx   y\t\n\n\n\nz  "), (2, "﻿p\rq   r\t")], "id long, text string")
    got = {r["id"]: r for r in clean.clean(df, "id", counts_col="n").collect()}
    assert {k: r["text"] for k, r in got.items()} == {1: "a\nh\nq\n\nx y\n\nz\n", 2: "p\nq r\n"}
    assert {k: v for k, v in got[1]["n"].items() if not k.startswith("chars")} == {"control_chars_removed": 2, "format_chars_removed": 1, "markdown_headings_removed": 1, "markdown_blockquotes_removed": 1, "markdown_horizontal_rules_removed": 1}
    assert got[2]["n"]["line_endings_normalized"] == 1
