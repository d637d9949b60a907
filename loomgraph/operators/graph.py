"""Graph building (G1-G13, F1-F6, J6): extraction replies, label rules, as-of resolution, ordered folds."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import ClassVar

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import fixed as V

MOST_ITEMS, LEAST_WEIGHT, MOST_QUOTE, MOST_LABEL, MOST_WORDS = 12, 2, 100, 80, 8
_TEXTS = lambda *names: [T.StructField(n, T.StringType()) for n in names]
REPLY = T.StructType([
    T.StructField("entities", T.ArrayType(T.StructType([*_TEXTS("name", "type", "description"), T.StructField("aliases", T.ArrayType(T.StringType())), *_TEXTS("evidence")]))),
    T.StructField("relations", T.ArrayType(T.StructType([*_TEXTS("source", "target", "type", "quote"), T.StructField("weight", T.IntegerType())]))),
])


@dataclass(frozen=True)
class Ontology:
    entity_types: tuple[str, ...] = tuple(V.ENTITY_TYPES)
    relation_types: tuple[str, ...] = tuple(V.RELATION_TYPES)
    default_entity_type: str = V.DEFAULT_ENTITY_TYPE
    default_relation_type: str = V.DEFAULT_RELATION_TYPE
    allowed_latin: tuple[str, ...] = ()
    strict_types: bool = True
    filter_labels: bool = True
    require_quote: bool = True
    drop_unresolved: bool = True
    least_weight: int = LEAST_WEIGHT
    most_quote: int = MOST_QUOTE
    most_items: int = MOST_ITEMS

    #: The names that a configuration file has for the fields that differ from them.
    NAMES: ClassVar[dict[str, str]] = {"allowed_latin_labels": "allowed_latin", "min_relation_weight": "least_weight", "max_quote_chars": "most_quote", "drop_unresolved_relations": "drop_unresolved", "max_new_entities": "most_items"}

    @classmethod
    def of(cls, config: dict) -> Ontology:
        """S10. From a configuration's object; keys that are no field are not read, a field of the wrong kind is an error."""
        out = {}
        for key, value in config.items():
            name = cls.NAMES.get(key, key)
            field = cls.__dataclass_fields__.get(name)
            if field is None or name == "NAMES":
                continue
            if name in ("entity_types", "relation_types"):
                value = types_of(value)
            elif name == "allowed_latin":
                value = tuple(value)
            elif name.startswith("default_"):
                value = types_of([value])[0]
            elif isinstance(field.default, bool) != isinstance(value, bool) or not isinstance(value, int):
                raise ValueError(f"{key} is no {type(field.default).__name__}: {value!r}")
            out[name] = value
        return cls(**out)


def types_of(value) -> tuple[str, ...]:
    """G4. Type names from a string with commas, a list, one value or nothing; each once, in order."""
    parts = [] if value is None else value.split(",") if isinstance(value, str) else value if isinstance(value, Iterable) else [value]
    names = (re.sub("[ -]", "_", str(x).strip().upper()) for x in parts)
    return tuple(dict.fromkeys(x for x in names if x))


def type_name(x: Column) -> Column:
    """G3."""
    return F.upper(F.translate(C.strip(x), " -", "__"))


def clean_label(x: Column) -> Column:
    """G5."""
    return F.regexp_replace(F.left(C.squeeze(F.regexp_replace(C.strip(x), "^[\"'«»“”„]+|[\"'«»“”„]+$", "")), F.lit(MOST_LABEL)), r"\s+$", "")


def canonical_label(x: Column) -> Column:
    """G6. Element symbols in any case, and their Russian and English names, to the symbol."""
    return F.coalesce(C.lookup({e.upper(): e for e in V.ELEMENTS}, F.upper(x)), C.lookup(V.ELEMENT_NAMES, F.lower(x)), x)


def label_key(x: Column) -> Column:
    """G7."""
    return F.replace(F.lower(C.strip(x)), F.lit("ё"), F.lit("е"))


def is_russian(x: Column, allowed=()) -> Column:
    """G9. Some Cyrillic, or a core that is allowed or an element symbol."""
    core = F.regexp_replace(x, r"(?U)^[^\w]+|[^\w]+$", "")
    return x.rlike("[\\u0400-\\u04FF]") | core.isin([*allowed, *V.ELEMENTS])


def is_label(x: Column, allowed=()) -> Column:
    """G8. The label is made plain once, and each list of substrings is one pattern."""
    some = lambda words: "|".join(C.java(w) for w in dict.fromkeys(words))

    def judged(p):
        plain, low = p["x"], p["low"]
        generic = F.replace(C.strip(low), F.lit("ё"), F.lit("е")).isin([g.replace("ё", "е") for g in V.GENERIC_LABELS])
        unit = plain.rlike(r"\d") & low.rlike(some(V.UNITS_IN_LABEL))
        return (plain != "") & ~generic & ~low.rlike(some(V.BAD_IN_LABEL)) & ~plain.rlike(r"^\d+$") & ~unit & (F.size(F.split(C.squeeze(plain), " ")) <= MOST_WORDS) & is_russian(plain, allowed)

    return C.bind(F.struct(x.alias("x"), F.lower(x).alias("low")), judged)


def quote_key(x: Column) -> Column:
    """G11."""
    return C.squeeze(F.regexp_replace(F.replace(F.lower(x), F.lit("ё"), F.lit("е")), "[‐–—]", "-"))


def supported(quote: Column, text: Column) -> Column:
    """G12."""
    return (quote_key(quote) != "") & quote_key(text).contains(quote_key(quote))


def quoted(quotes: DataFrame, quote_id: str, texts: DataFrame, text_id: str, text_col: str = "text", n: int = 4) -> DataFrame:
    """G12 over tables: quote_id, text_id of each text that supports a quote. The ends of a quote may stand inside a text's
    words, those between them are whole words of it; so quotes of n + 2 words or more meet the texts that have their first n
    inner words in a row, shorter ones meet all texts, and what meets is searched."""
    q = quotes.select(F.col(quote_id).alias("qid"), quote_key(F.col(text_col)).alias("q")).filter("q != ''").withColumn("w", F.split("q", " "))
    t = texts.select(F.col(text_id).alias("tid"), quote_key(F.col(text_col)).alias("t")).filter("t is not null")
    long = q.filter(F.size("w") >= n + 2).select("qid", "q", F.xxhash64(F.slice("w", 2, n)).alias("gram"))
    words = F.split("t", " ")
    grams = C.bind(words, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), lambda k: F.xxhash64(F.slice(w, k, n))))
    few = long.groupBy("gram").agg(F.collect_list(F.struct("qid", "q")).alias("of"))
    met = t.select("tid", "t", F.explode(F.array_distinct(grams)).alias("gram")).join(few, "gram").select("tid", "t", F.explode("of").alias("x"))
    short = t.crossJoin(F.broadcast(q.filter(F.size("w") < n + 2).select(F.struct("qid", "q").alias("x")))).select("tid", "t", "x")
    return met.union(short).filter(F.col("t").contains(F.col("x.q"))).select(F.col("x.qid").alias(quote_id), F.col("tid").alias(text_id))


def node_id(kind: Column, label: Column) -> Column:
    return F.concat(F.lit("N"), F.left(F.sha1(F.concat(kind, F.lit("::"), label).cast("binary")), F.lit(16)))


def render_prompt(template: Column, values: dict[str, Column]) -> Column:
    """G1."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def parse_reply(text: str | None, least_weight: int = LEAST_WEIGHT, most: int = MOST_ITEMS) -> tuple[list, list]:
    """G2. Entities and relations of a reply: JSON arrays, one a line or wrapped, whatever stands between or is cut off."""
    entities, relations, decoder = [], [], json.JSONDecoder()
    text_of = lambda x: "" if x is None else str(x).strip()

    def take(item):
        if item and isinstance(item[0], list):
            for x in item:
                if isinstance(x, list):
                    take(x)
            return
        kind = str(item[0]).strip().upper() if item else ""
        if kind == "E" and len(item) >= 3:
            name, of_type, description, aliases, evidence = [text_of(x) for x in item[1:6]] + [""] * (6 - len(item))
            if name:
                entities.append((name, of_type, description, [a for x in aliases.split(";") if (a := x.strip())], evidence))
        elif kind == "R" and len(item) >= 5:
            f = [text_of(x) for x in item[1:5]]
            try:
                weight = int(item[5])
            except (IndexError, TypeError, ValueError):
                weight = least_weight
            if f[0] and f[1] and weight >= least_weight:
                relations.append((*f, weight))

    text, at = text or "", 0
    while (at := text.find("[", at)) >= 0:
        try:
            item, end = decoder.raw_decode(text, at)
        except ValueError:
            at += 1
            continue
        take(item)
        at = end
    return entities[:most], relations[:most]


def parsed(reply: Column, least_weight: int = LEAST_WEIGHT, most: int = MOST_ITEMS) -> Column:
    """G2 over a column."""
    @F.pandas_udf(REPLY)
    def run(s: pd.Series) -> pd.DataFrame:
        names = (["name", "type", "description", "aliases", "evidence"], ["source", "target", "type", "quote", "weight"])
        rows = [parse_reply(x, least_weight, most) for x in s]
        return pd.DataFrame([[[dict(zip(n, x)) for x in part] for n, part in zip(names, r)] for r in rows], columns=["entities", "relations"])

    return run(reply)


def chunk_text(dense: Column | None, text: Column | None, most_chars: int = 6000) -> Column:
    """G13. The dense text, or the text where that is null or empty, stripped and cut."""
    both = [F.nullif(c, F.lit("")) for c in (dense, text) if c is not None]
    return F.left(C.strip(F.coalesce(*both, F.lit(""))), F.lit(most_chars))


def extract(chunks: DataFrame, extractor: Callable[[list[str]], list[str]], parallel: int, text_col: str = "text", template: str | None = None) -> DataFrame:
    """S12, G1, G13. Adds reply: the extractor's answer to each chunk's text, or to the template with that text in the place of
    {chunk_text}; blank chunks go. parallel bounds requests at a time; the result should be written before it is used, as a
    lost executor repeats its calls."""
    schema = T.StructType([*chunks.schema.fields, T.StructField("reply", T.StringType())])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            texts = [x or "" for x in pdf[text_col]]
            yield pdf.assign(reply=extractor([template.replace("{chunk_text}", x) if template else x for x in texts]))

    return chunks.filter(C.strip(F.col(text_col)) != "").repartition(parallel).mapInPandas(run, schema)


def entities(replies: DataFrame, onto: Ontology = Ontology()) -> DataFrame:
    """G10. seq (file, chunk, item), node_id, node_type, label, description, aliases, evidence of valid entities; replies has
    source_file, chunk_index and entities."""
    e = replies.select("source_file", "chunk_index", F.posexplode("entities").alias("item", "e")).select("source_file", "chunk_index", "item", "e.*")
    return _valid(e.select(F.struct("source_file", "chunk_index", F.lit(0).alias("stage"), "item").alias("seq"), "name", "type", "description", "aliases", "evidence"), onto)


def _valid(e: DataFrame, onto: Ontology) -> DataFrame:
    kind = type_name(F.col("type"))
    known = kind.isin(list(onto.entity_types))
    e = e.withColumn("node_type", kind if onto.strict_types else F.when(known, kind).otherwise(onto.default_entity_type))
    e = e.filter(F.col("node_type").isin(list(onto.entity_types))) if onto.strict_types else e
    e = e.withColumn("label", C.bind(clean_label(F.coalesce("name", F.lit(""))), canonical_label))
    e = e.filter(is_label(F.col("label"), onto.allowed_latin) if onto.filter_labels else F.col("label") != "")
    aliases = F.filter(F.transform("aliases", clean_label), lambda a: (a != "") & (label_key(a) != label_key(F.col("label"))))
    return e.select("seq", node_id(F.col("node_type"), F.col("label")).alias("node_id"), "node_type", "label", "description", F.coalesce(aliases, F.expr("cast(array() as array<string>)")).alias("aliases"), "evidence")


def nodes(ents: DataFrame) -> DataFrame:
    """F1. One row per node: the first registration's attributes, blanks filled by the first later one that has them; aliases
    as they came if only the first had some, else the sorted union."""
    first = lambda c: F.min_by(F.nullif(F.col(c), F.lit("")), F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col("seq")))
    g = ents.groupBy("node_id").agg(
        F.min("seq").alias("seq"), F.first("node_type").alias("node_type"), F.first("label").alias("label"), F.coalesce(first("description"), F.lit("")).alias("description"), F.coalesce(first("evidence"), F.lit("")).alias("evidence"),
        F.min_by("aliases", "seq").alias("a0"), F.count_if(F.size("aliases") > 0).alias("n"),
    )
    # each alias of a node once before they meet in one row
    every = ents.select("node_id", F.explode("aliases").alias("a")).distinct().groupBy("node_id").agg(F.array_sort(F.collect_list("a")).alias("every"))
    alone = (F.col("n") == 0) | (F.col("n") == 1) & (F.size("a0") > 0)
    return g.join(every, "node_id", "left").select("node_id", "node_type", "label", "description", F.array_join(F.when(alone, F.col("a0")).otherwise(F.col("every")), "; ").alias("aliases"), "evidence", "seq")


def registry(ents: DataFrame, onto: Ontology = Ontology()) -> DataFrame:
    """F2. Per label key, candidates: the first node of each type priority, as many as there are types at most."""
    order = {t: k for k, t in enumerate(dict.fromkeys((*onto.entity_types, onto.default_entity_type)))}
    one = ents.groupBy(label_key(F.col("label")).alias("key"), F.coalesce(C.lookup(order, F.col("node_type")), F.lit(len(order))).alias("priority")).agg(F.min(F.struct("seq", "node_id")).alias("m"))
    return one.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("priority", F.col("m.seq").alias("since"), F.col("m.node_id").alias("node_id")))).alias("candidates"))


def resolve(relations: DataFrame, ents: DataFrame, onto: Ontology = Ontology()) -> DataFrame:
    """F2, J6. Adds source_id and target_id: the node that the label had when the relation's chunk was done (of nodes that
    relations made, those of this one and earlier ones), by type priority and then by age. Each end meets one row of the
    registry."""
    reg, out = registry(ents, onto), relations
    file, chunk, item = (F.col(f"seq.{c}") for c in ("source_file", "chunk_index", "item"))
    for end in ("source", "target"):
        out = out.join(reg.select(F.col("key").alias("__key"), "candidates"), label_key(F.col(end)) == F.col("__key"), "left")

        def seen(c):
            since = c["since"]
            return (since["source_file"] < file) | (since["source_file"] == file) & ((since["chunk_index"] < chunk) | (since["chunk_index"] == chunk) & ((since["stage"] == 0) | (since["item"] <= item)))

        out = out.withColumn(f"{end}_id", F.try_element_at(F.filter("candidates", seen), F.lit(1))["node_id"]).drop("__key", "candidates")
    return out


def _before_ends(relations: DataFrame, onto: Ontology) -> DataFrame:
    """Adds reason: the first rule before those on ends that the relation fails; type, weight and quote are made ready."""
    kind, q = type_name(F.col("type")), F.coalesce(C.strip(F.col("quote")), F.lit(""))
    known = kind.isin(list(onto.relation_types))
    r = relations.withColumn("known", known).withColumn("type", kind if onto.strict_types else F.when(known, kind).otherwise(onto.default_relation_type)).withColumn("quote", q)
    r = r.withColumn("weight", F.coalesce(F.col("weight"), F.lit(onto.least_weight)))
    reason = F.when(~F.col("known"), "type") if onto.strict_types else F.when(F.lit(False), "type")
    reason = reason.when(F.col("weight") < onto.least_weight, "weight")
    if onto.require_quote:
        q = F.col("quote")
        reason = reason.when(q == "", "no_quote").when(F.length(q) > 2 * onto.most_quote, "long_quote").when(~supported(q, F.col("text")), "unsupported")
    return r.withColumn("reason", reason).drop("known")


def gate(relations: DataFrame, onto: Ontology = Ontology()) -> DataFrame:
    """F3, A9. Adds drop_reason: the first rule that the relation (seq, source, target, type, quote, weight, text, ids) fails."""
    r = _before_ends(relations, onto)
    ends = F.when(F.col("source_id").isNull(), "source").when(F.col("target_id").isNull(), "target").when(F.col("source_id") == F.col("target_id"), "self_loop")
    return r.withColumn("drop_reason", F.coalesce("reason", ends)).drop("reason")


def created(resolved: DataFrame, onto: Ontology) -> DataFrame:
    """F4. The entities that unresolved ends of otherwise good relations make where such relations are kept: of the default
    type, with the relation's quote as evidence. Strict types refuse them, as the default is none of them. Resolving again
    with them gives each of those ends its node."""
    r = _before_ends(resolved, onto).filter("reason is null")
    seq = F.struct("seq.source_file", "seq.chunk_index", F.lit(1).alias("stage"), "seq.item").alias("seq")
    none = F.expr("cast(array() as array<string>)").alias("aliases")
    each = [r.filter(F.col(f"{end}_id").isNull()).select(seq, F.col(end).alias("name"), F.lit(onto.default_entity_type).alias("type"), F.lit("").alias("description"), none, F.col("quote").alias("evidence")) for end in ("source", "target")]
    return _valid(each[0].union(each[1]), onto)


def edges(kept: DataFrame, onto: Ontology = Ontology()) -> DataFrame:
    """F5. One undirected edge per pair: relations in their order, where a new type overwrites the edge and a repeated type
    of a higher weight updates weight and evidence of whatever the edge then is. relations: how many the pair has, added:
    how many of a new type, updated: how many raised the weight.

    As each type overwrites once, a pair's relations fall into as many runs as it has types. A run's weight is its highest,
    its evidence that of the first relation to reach it. So a pair with most of all relations is reduced in parts: to a row
    per type, then to a row per run and weight, of which the pair's row is made."""
    pair = kept.select(F.least("source_id", "target_id").alias("u"), F.greatest("source_id", "target_id").alias("v"), "seq", "type", "weight", F.left(F.col("quote"), F.lit(onto.most_quote)).alias("quote"), "source_id", "target_id")
    starts = pair.groupBy("u", "v", "type").agg(F.min(F.struct("seq", "type", F.col("source_id").alias("src"), F.col("target_id").alias("dst"))).alias("s"))
    starts = starts.groupBy("u", "v").agg(F.array_sort(F.collect_list("s")).alias("starts"))
    run = F.size(F.filter("starts", lambda s: s["seq"] <= F.col("seq"))).alias("run")
    best = pair.join(starts, ["u", "v"]).select("u", "v", run, "weight", "seq", "quote").groupBy("u", "v", "run", "weight").agg(F.min(F.struct("seq", "quote")).alias("first"), F.count("*").alias("n"))
    runs = best.groupBy("u", "v").agg(F.sum("n").cast("int").alias("relations"), F.array_sort(F.collect_list(F.struct("run", F.col("first.seq").alias("seq"), "weight", F.col("first.quote").alias("quote")))).alias("b"))
    # in a run, those that come with more weight than all before them
    higher = F.filter("b", lambda x, k: ~F.exists(F.slice(F.col("b"), 1, k), lambda y: (y["run"] == x["run"]) & (y["weight"] >= x["weight"])))
    e = runs.join(starts, ["u", "v"]).withColumn("higher", higher).withColumn("last", F.element_at("higher", -1)).withColumn("s", F.element_at("starts", -1))
    return e.select("u", "v", F.col("s.src").alias("source"), F.col("s.dst").alias("target"), F.col("s.type").alias("relation"), "last.weight", F.col("last.quote").alias("evidence"), "relations", F.size("starts").alias("added"), (F.size("higher") - F.size("starts")).alias("updated"))


def without_isolates(node_df: DataFrame, edge_df: DataFrame) -> DataFrame:
    """F6, J9."""
    return node_df.join(edge_df.select(F.explode(F.array("u", "v")).alias("node_id")).distinct(), "node_id", "left_semi")


#: The counter that each reason to drop a relation has.
DROPPED = {
    "type": "dropped_invalid_relation_type", "weight": "dropped_low_weight_relation", "no_quote": "dropped_missing_quote", "long_quote": "dropped_long_quote", "unsupported": "dropped_unsupported_quote",
    "source": "dropped_unresolved_source", "target": "dropped_unresolved_target", "self_loop": "dropped_self_relation",
}


def metrics(node_df: DataFrame, edge_df: DataFrame, gated: DataFrame, replies: DataFrame | None = None, ents: DataFrame | None = None) -> DataFrame:
    """A8, A9 in long form: metric, key, value. With the replies and their valid entities, counts of chunks, entities and
    those dropped, and the rates per chunk, too."""
    long = lambda df, metric, key: df.select(F.lit(metric).alias("metric"), key.alias("key"), F.col("value").cast("double").alias("value"))
    count = lambda df, metric, col: long(df.groupBy(F.col(col).alias("key")).agg(F.count("*").alias("value")), metric, F.col("key"))
    total = lambda df, name, value=F.count("*"): long(df.agg(value.alias("value")), "counter", F.lit(name))
    reason = C.lookup(DROPPED, F.col("drop_reason"))
    dropped = long(gated.filter("drop_reason is not null").groupBy(reason.alias("key")).agg(F.count("*").alias("value")), "counter", F.col("key"))
    duplicate = F.coalesce(F.sum(F.col("relations") - F.col("added")), F.lit(0))
    parts = [
        count(node_df, "nodes_by_type", "node_type"), count(edge_df, "edges_by_type", "relation"), count(gated.filter("drop_reason is not null"), "dropped", "drop_reason"), dropped,
        total(node_df, "total_nodes"), total(edge_df, "total_edges"), total(gated, "llm_relations_returned"), total(edge_df, "relations_added", F.coalesce(F.sum("added"), F.lit(0))),
        total(edge_df, "relations_updated", F.coalesce(F.sum("updated"), F.lit(0))), total(edge_df, "dropped_duplicate_relation", duplicate),
        long(gated.agg(F.try_divide(F.count_if(F.col("drop_reason").isNull()), F.count("*")).alias("value")), "acceptance", F.lit("all")),
    ]
    if replies is not None and ents is not None:
        returned = F.coalesce(F.sum(F.size("entities")), F.lit(0))
        parts += [total(replies, "chunks_processed"), total(replies, "llm_entities_returned", returned), total(ents, "entities_registered")]
        valid = ents.agg(F.count("*").alias("valid"))
        parts.append(long(replies.agg(returned.alias("n")).crossJoin(F.broadcast(valid)).select((F.col("n") - F.col("valid")).alias("value")), "counter", F.lit("dropped_invalid_entity")))
        parts.append(long(replies.agg(F.try_divide(returned, F.count("*")).alias("value")), "entities_per_chunk", F.lit("all")))
        added = edge_df.agg(F.coalesce(F.sum("added"), F.lit(0)).alias("added"))
        parts.append(long(replies.agg(F.count("*").alias("n")).crossJoin(F.broadcast(added)).select(F.try_divide("added", "n").alias("value")), "relations_per_chunk", F.lit("all")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    every = out.filter(F.col("key").startswith("dropped_")).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("value"))
    return out.union(long(every, "counter", F.lit("dropped_total")))
