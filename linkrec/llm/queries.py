"""Registered queries of the llm operators and, where SQL can state them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrec.llm import sql
from linkrec.llm.common import table
from linkrec.llm.decontam import contaminated
from linkrec.llm.licenses import scan_licenses
from linkrec.llm.line_dedup import line_report
from linkrec.llm.mixing import mixed_documents
from linkrec.llm.odd_sketch import near_duplicates
from linkrec.llm.piece_offsets import encode_pieces
from linkrec.llm.pii import personal_data
from linkrec.llm.pq_dedup import near_vectors
from linkrec.llm.runs import run_report
from linkrec.llm.sharding import shard_documents
from linkrec.llm.token_counts import token_counts
from linkrec.llm.toxicity import toxicity
from linkrec.llm.whitening import whitened_components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@query("op1_sharding", sql.SHARDING)
def q_sharding(spark, sf):
    return shard_documents(table(spark, sf, "documents"))


@query("op2_minhash_near_dedup")
def q_minhash_near_dedup(spark, sf):
    return near_duplicates(table(spark, sf, "documents"), threshold=0.85, w=3)


@query("op3_mixing")
def q_mixing(spark, sf):
    return mixed_documents(table(spark, sf, "documents"))


@query("op8_toxicity")
def q_toxicity(spark, sf):
    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op9_decontamination")
def q_decontamination(spark, sf):
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("row")


@query("op4_line_dedup", sql.LINES)
def q_line_dedup(spark, sf):
    return line_report(table(spark, sf, "documents"))


@query("op10_license_scan", sql.LICENSES)
def q_license_scan(spark, sf):
    return scan_licenses(table(spark, sf, "documents"))


@query("op5_pq_near_dedup")
def q_pq_near_dedup(spark, sf):
    return near_vectors(table(spark, sf, "embeddings"))


@query("op6_pii")
def q_pii(spark, sf):
    return personal_data(table(spark, sf, "documents"))


@query("op7_token_counts")
def q_token_counts(spark, sf):
    return token_counts(table(spark, sf, "documents"))


@query("op11_pieces")
def q_pieces(spark, sf):
    from public_tokenizers import path
    encoded = encode_pieces(table(spark, sf, "documents"), path("piece_bpe_32k.model"))
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
                          F.sha2("ends", 256).alias("ends_sha256"))


@query("op12_periodic_runs")
def q_periodic_runs(spark, sf):
    return run_report(table(spark, sf, "documents"))


@query("op13_whitening")
def q_whitening(spark, sf):
    return whitened_components(table(spark, sf, "embeddings"))
