"""Sources and sinks (S1-S13): Markdown, JSON artifacts, configuration, prompts, an HTTP model, GraphML."""

from __future__ import annotations

import json
import logging
import urllib.error
import urllib.request
from pathlib import Path
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)


def markdown(spark: SparkSession, folder: str) -> DataFrame:
    """S1, S3b. (source_file, text) of *.md, each file whole."""
    return spark.read.text(folder, wholetext=True, pathGlobFilter="*.md").select(F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("text"))


def artifacts(spark: SparkSession, folder: str, suffix: str, without: str | None = None) -> DataFrame:
    """S2-S5. JSON files by suffix, but not those that end in `without`; broken ones are null rows (PERMISSIVE)."""
    df = spark.read.option("multiLine", True).option("pathGlobFilter", f"*{suffix}").json(folder).withColumn("file", F.col("_metadata.file_name"))
    return df.filter(~F.col("file").endswith(without)) if without else df


def check_folder(folder: str) -> None:
    """S6."""
    if not Path(folder).is_dir():
        raise ValueError(f"no such folder: {folder}")


def write_text(df: DataFrame, folder: str, name_col: str = "source_file", text_col: str = "text") -> None:
    """S7. <folder>/<name> for each row (name, text), exactly its text. Written side by side into partition folders; then each
    file is moved to its name, on whatever file system the folder is. A name that comes twice is an error."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    work = f"{folder.rstrip('/')}/_parts"
    # a line ends each value that the writer puts down: a text that ends with one gives its own for it, others get none
    ended = df.select(name_col, F.coalesce(text_col, F.lit("")).alias("value"), F.coalesce(F.col(text_col).endswith("\n"), F.lit(False)).alias("ends"))
    ended = ended.select(name_col, F.when(F.col("ends"), F.col("value").substr(F.lit(1), F.length("value") - 1)).otherwise(F.col("value")).alias("value"), F.col("ends").alias("__ends"))
    if not ended.groupBy(name_col).count().filter("count > 1").isEmpty():
        raise ValueError("a name comes twice")
    ended.filter("__ends").drop("__ends").write.partitionBy(name_col).mode("overwrite").text(f"{work}/ended")
    ended.filter("!__ends").drop("__ends").write.partitionBy(name_col).mode("overwrite").option("lineSep", "\u0000").text(f"{work}/open")
    root = jvm.org.apache.hadoop.fs.Path(work)
    fs = root.getFileSystem(conf)
    for kind in ("ended", "open"):
        for of in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{work}/{kind}/{name_col}=*")) or []:
            name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(of.getPath().getName()[len(name_col) + 1 :])
            (part,) = [f.getPath() for f in fs.listStatus(of.getPath()) if f.getPath().getName().startswith("part-")]
            to = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
            fs.delete(to, False)
            if kind == "open":  # without the separator at its end
                size, source, sink = fs.getFileStatus(part).getLen() - 1, fs.open(part), fs.create(to, True)
                jvm.org.apache.commons.io.IOUtils.copyLarge(source, sink, 0, size)
                source.close(), sink.close()
            else:
                fs.rename(part, to)
    fs.delete(root, True)


def write_json(df: DataFrame, folder: str) -> None:
    """S8."""
    df.write.mode("overwrite").json(folder)


def write_object(value: dict | list, path: str) -> None:
    """S8. One JSON document, as metrics and configuration are."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


TABLE_RECORDS = "array<struct<source_file: string, table_index: int, shape: struct<`rows`: int, `columns`: int>, `columns`: array<struct<name: string, dtype: string, unit: string>>, `rows`: array<map<string, string>>>>"


def table_records(spark: SparkSession, folder: str, stems: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S5. stems (stem) to (records of their <stem>.tables.json: stem, table_index, columns, rows; status: stem, status). A file
    with one object counts as a list of one; a record without an index has its place in the list; a missing folder or file,
    or one that is no JSON, leaves no records and says so in status (ok, dir_missing, file_missing, invalid)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        x = F.from_json(F.lit(None).cast("string"), TABLE_RECORDS)[0]
        none = stems.select("stem", F.lit(0).alias("table_index"), x["columns"].alias("columns"), x["rows"].alias("rows")).limit(0)
        return none, stems.select("stem", F.lit("dir_missing").alias("status"))
    text = spark.read.text(folder, wholetext=True, pathGlobFilter="*.tables.json")
    read = text.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.tables\.json$", "").alias("stem"), F.from_json("value", TABLE_RECORDS).alias("r"))
    found = stems.select("stem").join(read.withColumn("there", F.lit(True)), "stem", "left")
    status = found.select("stem", F.when(F.col("there").isNull(), "file_missing").when(F.col("r").isNull(), "invalid").otherwise("ok").alias("status"))
    each = found.select("stem", F.posexplode("r").alias("at", "x")).filter("x is not null")
    return each.select("stem", F.coalesce("x.table_index", "at").alias("table_index"), "x.columns", "x.rows"), status


def config(path: str) -> dict:
    """S10."""
    out = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(out, dict):
        raise ValueError(f"{path} holds no object")
    return out


def prompt(name: str, *folders: str) -> str:
    """S11. The template from the first folder that has it."""
    for f in ("", *folders):
        if (p := Path(f, name)).is_file():
            return p.read_text(encoding="utf-8")
    raise ValueError(f"no prompt {name}")


def http_model(url: str, model: str, timeout: float = 600, num_ctx: int = 8192, num_predict: int = 1024, temperature: float = 0.0, top_p: float = 0.9, repeat_penalty: float = 1.1):
    """S12. An extractor for operators.graph.extract: one chat request per text."""
    def ask(text: str) -> str:
        body = {"model": model, "stream": False, "think": False, "messages": [{"role": "user", "content": text}], "options": {"num_ctx": num_ctx, "num_predict": num_predict, "temperature": temperature, "top_p": top_p, "repeat_penalty": repeat_penalty}}
        req = urllib.request.Request(f"{url.rstrip('/')}/api/chat", json.dumps(body, ensure_ascii=False).encode(), {"Content-Type": "application/json; charset=utf-8"})
        try:
            with urllib.request.urlopen(req, timeout=timeout) as r:
                reply = json.load(r)
        except urllib.error.HTTPError as e:
            said = e.read().decode("utf-8", "replace")[:500]
            hint = f"; `ollama pull {model}` gets a model that is not there" if e.code == 404 else ""
            raise RuntimeError(f"the model server answered {e.code}: {said}{hint}") from e
        except urllib.error.URLError as e:
            raise RuntimeError(f"no model server at {url}: {e.reason}") from e
        content = (reply.get("message") or {}).get("content")
        if content is None:
            raise RuntimeError("the reply has no message.content")
        if reply.get("done_reason") == "length":
            LOG.warning("the model's answer was cut at num_predict=%s tokens", num_predict)
        return content

    return lambda texts: [ask(t) for t in texts]


def graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """S9. All attributes as text; rows come one partition at a time."""
    node_keys, edge_keys = ["node_type", "label", "description", "aliases", "evidence"], ["relation", "weight", "evidence"]
    with open(path, "w", encoding="utf-8") as out:
        out.write('<?xml version="1.0" encoding="utf-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">\n')
        for kind, keys in (("node", node_keys), ("edge", edge_keys)):
            for k in keys:
                out.write(f'  <key id="{kind[0]}_{k}" for="{kind}" attr.name="{k}" attr.type="string"/>\n')
        out.write('  <graph edgedefault="undirected">\n')
        put = lambda kind, r, keys: "".join(f'<data key="{kind[0]}_{k}">{escape(str(r[k] if r[k] is not None else ""))}</data>' for k in keys)
        for r in nodes.orderBy("seq").toLocalIterator():
            out.write(f"    <node id={quoteattr(r['node_id'])}>{put('node', r, node_keys)}</node>\n")
        for r in edges.orderBy("u", "v").toLocalIterator():
            out.write(f"    <edge source={quoteattr(r['source'])} target={quoteattr(r['target'])}>{put('edge', r, edge_keys)}</edge>\n")
        out.write("  </graph>\n</graphml>\n")
