"""The stages in a row: documents to chunks, tokens, vectors and a graph. Each is DataFrame to DataFrame."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chunk, clean, graph, normalize, tokenize, vectorize
from ..sources import files

LOG = logging.getLogger(__name__)


@dataclass
class Result:
    """What a stage left: whether it ended, its frames by name, metrics, and what went wrong."""

    stage: str
    success: bool = False
    frames: dict[str, DataFrame] = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Stage:
    """A named step of a pipeline: a function of the frames before it to the frames it adds."""

    name: str
    run: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


def run_stages(stages: list[Stage], frames: dict[str, DataFrame]) -> list[Result]:
    """Runs stages in their order, each on all frames so far; ends after the first that fails, whose error is kept."""
    out, frames = [], dict(frames)
    for stage in stages:
        r = Result(stage.name)
        out.append(r)
        try:
            r.frames = stage.run(frames)
        except Exception as e:  # a stage is the caller's code: its error is a result
            LOG.exception("stage %s failed", stage.name)
            r.errors.append(f"{stage.name}: {e}")
            break
        frames |= r.frames
        r.success = True
    return out


def text_stages(docs: DataFrame, id_col: str = "source_file") -> DataFrame:
    """Documents (id_col, text) to tokenized chunks."""
    return tokenize.tokenize(chunk.chunks(normalize.normalize(clean.clean(docs, id_col)), id_col), id_col)


def vectors(tokenized: DataFrame, id_col: str = "source_file", method: str = "tfidf") -> DataFrame:
    return vectorize.sparse(vectorize.unit_tokens(tokenized, id_col, "chunk_index", F.col("tokens")), id_col, "chunk_index", method)


def relations_of(replies: DataFrame) -> DataFrame:
    rel = replies.select("source_file", "chunk_index", "text", F.posexplode("relations").alias("item", "r"))
    return rel.select(F.struct("source_file", "chunk_index", "item").alias("seq"), "text", "r.*")


def graph_of(replies: DataFrame, onto: graph.Ontology = graph.Ontology()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """replies (source_file, chunk_index, text, entities, relations) to nodes, edges and gated relations."""
    ents, rel = graph.entities(replies, onto), relations_of(replies)
    if not onto.drop_unresolved:
        ents = ents.union(graph.created(graph.resolve(rel, ents, onto), onto))
    gated = graph.gate(graph.resolve(rel, ents, onto), onto)
    return graph.nodes(ents), graph.edges(gated.filter("drop_reason is null"), onto), gated


def graph_run(chunks: DataFrame, extractor, folder: str, template: str = "{chunk_text}", onto: graph.Ontology = graph.Ontology(), parallel: int = 2, most_chars: int = 6000, stage: str = "graph_building") -> Result:
    """Chunks (source_file, chunk_index, dense_text or text) through prompt, extractor, parser and gate to a graph: writes
    replies (so that no request is made twice), nodes, edges, metrics.json and knowledge_graph.graphml into the folder. An
    extractor that fails, fails the stage, and no graph is written."""
    spark, out = chunks.sparkSession, Result(stage)
    texts = graph.chunk_text(*(F.col(c) if c in chunks.columns else None for c in ("dense_text", "text")), most_chars)
    asked = chunks.select("source_file", "chunk_index", texts.alias("text"))
    try:
        graph.extract(asked, extractor, parallel, template=template).write.mode("overwrite").parquet(f"{folder}/replies")
        replies = spark.read.parquet(f"{folder}/replies")
        p = graph.parsed(F.col("reply"), onto.least_weight, onto.most_items)
        replies = replies.select("source_file", "chunk_index", "text", p.alias("p")).select("source_file", "chunk_index", "text", "p.*")
        ents = graph.entities(replies, onto)
        for name, df in zip(("nodes", "edges", "relations"), graph_of(replies, onto)):
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            out.frames[name] = spark.read.parquet(f"{folder}/{name}")
        nodes, edges, gated = out.frames.values()
        rows = graph.metrics(nodes, edges, gated, replies, ents).collect()  # as many rows as there are types and counters
        of = lambda m: {r["key"]: r["value"] for r in rows if r["metric"] == m}
        counters = {k: int(v) for k, v in of("counter").items()}
        gauges = {k: counters.pop(k) for k in ("total_nodes", "total_edges", "dropped_total")} | {k: {t: int(n) for t, n in of(k).items()} for k in ("nodes_by_type", "edges_by_type")}
        counters["files_processed"] = replies.select("source_file").distinct().count()
        rates = {"relation_acceptance_rate": counters["relations_added"] / n if (n := counters["llm_relations_returned"]) else None, **{k: of(k).get("all") for k in ("relations_per_chunk", "entities_per_chunk")}}
        out.metrics = {"stage": stage, "counters": counters, "gauges": gauges, "quality": rates}
        files.graphml(graph.without_isolates(nodes, edges), edges, f"{folder}/knowledge_graph.graphml")
        files.write_object(out.metrics, f"{folder}/metrics.json")
        out.success = True
    except Exception as e:  # the server's or the extractor's error is the stage's result
        LOG.error("stage %s failed: %s", stage, e)
        out.errors.append(str(e))
    return out


def default_graph_run(cleaned: DataFrame, extractor, folder: str, size: int = 1400, overlap: int = 200, **kw) -> Result:
    """The second graph: cleaned documents (source_file, text) in windows of characters, without tokens and vectors."""
    return graph_run(chunk.char_chunks(cleaned, "source_file", "text", size, overlap), extractor, folder, stage="graph_building_default", **kw)
