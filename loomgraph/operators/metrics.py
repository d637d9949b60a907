"""Metrics (A1-A14): counters over files, rows per file, quality ratios, thresholds. DataFrame to DataFrame; the document that a
stage leaves is put together on the driver, of sums."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A11-A13. Measures that need labelled data: they are named and null (fixed values).
PLACEHOLDERS = {
    "clearing": ["cer", "wer", "precision", "recall", "f1", "bertscore", "llm_judge_score"],
    "normalization": ["lemma_accuracy", "unit_accuracy", "date_accuracy", "abbreviation_accuracy"],
    "chunking": ["hit_rate"],
    "vectorization": ["hit_rate_at_10", "mrr", "ndcg_at_10", "mteb_score", "table_coverage"],
}
#: A14. What a measure should keep to: (least, most), null for none (fixed values).
THRESHOLDS = {
    "chunking": {"chunk_tokens_std": (None, 200.0), "broken_sentences_ratio": (None, 0.05), "overlap_ratio": (0.10, 0.20)},
    "tokenization": {"terms_preserved_ratio": (1.0, None), "formulas_correct_ratio": (1.0, None), "numunit_merged_ratio": (1.0, None), "abbreviations_correct_ratio": (1.0, None), "roundtrip_ratio": (1.0, None)},
}


def per_file(df: DataFrame, id_col: str, counts: Column) -> DataFrame:
    """A2. file, metric, value from a map of counts a row (rows of one file add up)."""
    return df.select(F.col(id_col).cast("string").alias("file"), F.explode(counts).alias("metric", "value")).groupBy("file", "metric").agg(F.sum("value").cast("long").alias("value"))


def counters(files: DataFrame) -> DataFrame:
    """A1. metric, value: sums over files."""
    return files.groupBy("metric").agg(F.sum("value").cast("long").alias("value"))


def ratio(a: Column, b: Column) -> Column:
    """A5. Rounded to four digits; null where there is nothing to divide by."""
    return F.round(F.try_divide(a, b), 4)


def chunk_counts(chunked: DataFrame, id_col: str, most: int, least: int) -> DataFrame:
    """K9 per file: id_col and counts."""
    n = lambda name, c: (F.lit(name), F.coalesce(c, F.lit(0)).cast("long"))
    pairs = [
        n("chunks_created", F.count("*")), n("tokens_total", F.sum("tokens")), n("tokens_sum_squares", F.sum(F.col("tokens").cast("long") * F.col("tokens"))), n("oversized_chunks", F.count_if(F.col("tokens") > most)),
        n("undersized_chunks", F.count_if(F.col("tokens") < least)), n("overlap_tokens_total", F.sum("overlap_prev_tokens")), n("chunks_with_overlap", F.count_if(F.col("overlap_prev_tokens") > 0)),
    ]
    return chunked.groupBy(id_col).agg(F.create_map(*[x for p in pairs for x in p]).alias("counts"))


def broken_counts(broken: DataFrame, id_col: str) -> DataFrame:
    """K8 per file: id_col and counts, of chunk.broken's rows."""
    pairs = [x for c in ("sentences", "paragraphs", "formulas") for x in (F.lit(f"{c}_total"), F.col(c).cast("long"), F.lit(f"split_{c}"), F.col(f"broken_{c}").cast("long"))]
    return broken.select(id_col, F.create_map(*pairs).alias("counts"))


def token_counts(tokenized: DataFrame, id_col: str) -> DataFrame:
    """A5 of tokenization per row: id_col and counts."""
    size = lambda c: F.size(c).cast("long")
    null_trees = F.size(F.filter("formula_tokens", lambda x: x.isNull())).cast("long")
    pairs = {"chunks_in": F.lit(1).cast("long"), "tokens_total": F.col("token_count").cast("long"), "sentences_total": size("sentences"), "formulas_protected": size("formulas"), "formulas_ast_fallback": null_trees, "numunit_merged": size("numunits"),
             "abbreviations_protected": size("abbreviations"), "tables_extracted": size("tables"), "roundtrip_ok": F.col("round_trip").cast("long"), "roundtrip_failed": (~F.col("round_trip")).cast("long")}
    return tokenized.select(id_col, F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)]).alias("counts"))


def quality(totals: dict[str, int], stage: str) -> dict[str, float | None]:
    """A4, A5, A11-A13. The ratios of a stage from its counters; null without a denominator."""
    at = lambda k: totals.get(k, 0)
    share = lambda a, b: round(a / b, 4) if b else None
    out: dict[str, float | None] = {}
    if stage == "chunking":
        n = at("chunks_created")
        mean = at("tokens_total") / n if n else 0.0
        out = {
            "chunk_tokens_mean": round(mean, 4) if n else None, "chunk_tokens_std": round(max(at("tokens_sum_squares") / n - mean * mean, 0.0) ** 0.5, 4) if n else None, "overlap_ratio": share(at("overlap_tokens_total"), at("tokens_total")),
            "broken_sentences_ratio": share(at("split_sentences"), at("sentences_total")), "broken_paragraphs_ratio": share(at("split_paragraphs"), at("paragraphs_total")), "broken_formulas_ratio": share(at("split_formulas"), at("formulas_total")),
        }
    elif stage == "tokenization":
        out = {
            "formulas_correct_ratio": share(at("formulas_protected") - at("formulas_ast_fallback"), at("formulas_protected")), "roundtrip_ratio": share(at("roundtrip_ok"), at("roundtrip_ok") + at("roundtrip_failed")),
            "terms_preserved_ratio": share(at("abbreviations_protected"), at("abbreviations_protected")), "numunit_merged_ratio": share(at("numunit_merged"), at("numunit_merged")),
            "abbreviations_correct_ratio": share(at("abbreviations_protected"), at("abbreviations_protected")), "oov_rate": share(at("oov_byte_fallback_words"), at("oov_unique_words")),
        }
    return out | {k: None for k in PLACEHOLDERS.get(stage, ())}


def missed(measures: dict[str, float | None], stage: str) -> dict[str, float]:
    """A14. The measures outside their thresholds."""
    bounds = THRESHOLDS.get(stage, {})
    return {k: v for k, v in measures.items() if v is not None and k in bounds and not ((bounds[k][0] is None or v >= bounds[k][0]) and (bounds[k][1] is None or v <= bounds[k][1]))}


def document(stage: str, files: DataFrame, gauges: dict | None = None, meta: dict | None = None, extra: dict[str, int] | None = None, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> dict:
    """The metrics document of a stage: counters, gauges, quality and rows per file. files: (file, metric, value)."""
    rows: dict[str, dict[str, int]] = {}
    for r in files.orderBy("file", "metric").toLocalIterator():
        rows.setdefault(r["file"], {})[r["metric"]] = r["value"]
    totals = {r["metric"]: r["value"] for r in counters(files).collect()} | {"files_processed": len(rows)} | (extra or {})
    return {"stage": stage, "generated_at": now().isoformat(), "meta": meta or {}, "counters": totals, "gauges": gauges or {}, "quality": quality(totals, stage), "per_file": [{"file": f, **m} for f, m in rows.items()]}
