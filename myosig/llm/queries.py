"""The registered queries of this subpackage: thin forms of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from myosig.llm import chat, chosen_path, dense_search, fim, langid, license_scan, masked_lm, merkle, mixing, packing, pstable, quality_knn, quality_rules
from myosig.session import ensure_checkpoint_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return run


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(chat.format_turns(rows.unionByName(chat.probe(spark))))


@query
def op1_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_report(table(spark, sf_dir, "documents"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op9_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), quality_rules.trusted(table(spark, sf_dir, "labels")))


@query
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents"))


@query
def op5_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.score(table(spark, sf_dir, "documents"))


@query
def op11_dense_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


@query
def op12_pstable_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.link(table(spark, sf_dir, "embeddings"))


@query
def op13_fim_fenwick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


ORACLES |= {"op11_dense_search": dense_search.ORACLE, "op12_pstable_dedup": pstable.ORACLE, "op13_fim_fenwick": fim.ORACLE}
