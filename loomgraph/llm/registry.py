"""One query per operator, with production parameters over its whole table; SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import jaccard, langid, multiindex, packing, pieces, quotes, secrets, suffixes, transport, warc
from .common import read_table


def op1_multi_index(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return multiindex.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op2_transport_stream(spark, sf_dir):
    return transport.documents_as_media(read_table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_repeat_removal(spark, sf_dir):
    return suffixes.report(read_table(spark, sf_dir, "documents"))


def op5_language_id(spark, sf_dir):
    return langid.report(read_table(spark, sf_dir, "documents"))


def op6_n_best_pieces(spark, sf_dir):
    return pieces.segmentations(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), n=4)


def op7_quotation_links(spark, sf_dir):
    return quotes.link(read_table(spark, sf_dir, "conversations"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard.join(read_table(spark, sf_dir, "documents"), n=3, pct=90)


def op9_secret_scan(spark, sf_dir):
    return secrets.report(read_table(spark, sf_dir, "documents"))


def op10_warc_archive(spark, sf_dir):
    return warc.through_archive(read_table(spark, sf_dir, "pages"))


def queries():
    return {f.__name__: f for f in (op1_multi_index, op2_transport_stream, op3_packing, op4_repeat_removal, op5_language_id, op6_n_best_pieces, op7_quotation_links, op8_jaccard_join, op9_secret_scan, op10_warc_archive)}


def oracle_sql():
    return {}
