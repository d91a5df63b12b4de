"""The registered queries of this package, by number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    fp_tree,
    hashing_index,
    langid,
    licenses,
    minhash,
    mixing,
    oracles,
    packing,
    page_text,
    spelling,
    tiles,
    token_counts,
    toxicity,
    voronoi,
)
from feedloom.workload.registry import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return keep


@register("op10_mix_sources", oracles.MIX)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


@register("op6_language_ppm")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


@register("op8_license_templates", oracles.LICENSES)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@register("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@register("op9_minhash_bayes")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@register("op3_pack_hilbert")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


@register("op4_voronoi_top_k", oracles.TOP_K)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20)


@register("op7_multi_index_hashing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing_index.nearest(table(spark, sf_dir, "embeddings"), k=5, every=50)


@register("op1_page_differencing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")


@register("op2_toxicity_cnn")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.learn(docs, labels))


@register("op11_document_fp_tree", oracles.RANKED)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@register("op12_int8_tiles", oracles.VECTOR_LINKS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@register("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
