"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

1. language ID: documents go that have no letter, or that even the best of the
   learned languages codes in more than ``ppm_language.MAX_BITS`` bits a byte;
2. SimHash near-dedup: of each group of linked documents the one with the
   least id stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scans: every secret span is replaced by ``[SECRET]``;
5. best-fit packing: the texts become pieces of full sequences.

Stages 1-4 return the columns of their input, whatever they are called (``TEXT``
beside ``text``).  A null or wordless text has no
language and goes in stage 1.  In stage 2 rows without an id stay only if their
group has no other, and equal rows are one document.  An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_insights.llm import bin_packing, decontaminate, ppm_language, secret_crf, simhash_covering
from retail_insights.llm.common import materialize, place, positional, release, table, text_batches


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return ppm_language.with_language(docs, ppm_language.train(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return simhash_covering.one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    clean = secret_crf.masked(docs, secret_crf.train(docs))
    if "n_chars" not in docs.columns:
        return clean
    plain, n = positional(clean), place(docs, "n_chars")
    length = F.length(place(docs, "text")).cast(plain.schema[n].dataType)
    return plain.withColumn(n, length).toDF(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return bin_packing.pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express the trained stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
