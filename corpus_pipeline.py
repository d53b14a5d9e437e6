"""Training-data pipeline: five stages over ``documents``, each by one operator of ``myosig.llm``.

Every stage reads the Parquet that its predecessor wrote and works on all of its rows; all
but the last return the columns of ``documents``.

1. language_id: documents without a known language, or whose text its n-grams do not
   explain, go.
2. quality: documents that the nearest-neighbour vote rejects (score under
   ``quality_knn.REJECT_BELOW``; the operator's ``predicted`` is stricter) go.
3. near_duplicates: one document of each class of near copies stays.
4. mix: every document is repeated as often as the mix to target weights takes it, or goes.
5. pack: the pieces of every document with their sequence and offset.

SQL can express neither the fitted models nor the hashes, so there is no ``ORACLE_SQL``; the
stages are tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from myosig.llm import chosen_path, langid, mixing, packing, quality_knn
from myosig.llm.common import written
from myosig.session import ensure_checkpoint_dir, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    identify = langid.predictor(docs, langid.train(docs))
    return docs.where(langid.accepted(identify(F.col("text").cast("string"))))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = quality_knn.scorer(docs, quality_knn.train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text").cast("string")) >= quality_knn.REJECT_BELOW)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosen_path.distinct(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(docs)


STAGES = [("language_id", language_id), ("quality", quality), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
