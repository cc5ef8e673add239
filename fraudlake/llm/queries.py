"""The operators' registered queries over the whole given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fraudlake.llm.chat import CHAT_SQL, chat_query
from fraudlake.llm.collocations import COLLOCATION_SQL, collocation_query
from fraudlake.llm.common import table
from fraudlake.llm.compression_quality import quality_query
from fraudlake.llm.decontaminate import leaks
from fraudlake.llm.language_id import language_query
from fraudlake.llm.license_scan import license_query
from fraudlake.llm.merkle import MANIFEST_SQL, manifest_query
from fraudlake.llm.near_dedup import NEAR_DEDUP_SQL, near_duplicates
from fraudlake.llm.packing import place
from fraudlake.llm.pii import pii_query
from fraudlake.llm.sharding import sharding_query
from fraudlake.llm.token_counts import token_count_query
from fraudlake.llm.vector_search import SEARCH_SQL, search_query


def _over_documents(operator, **options):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(table(spark, sf_dir, "documents"), **options)

    return query


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_language_id": _over_documents(language_query),
    "op2_chat_formatting": chat_query,
    "op3_best_fit_packing": _over_documents(place, added=True),
    "op4_license_scan": _over_documents(license_query),
    "op5_minhash_near_dedup": _over_documents(near_duplicates),
    "op6_pii": _over_documents(pii_query),
    "op7_token_counts": _over_documents(token_count_query, added=True),
    "op8_exact_top_k": search_query,
    "op9_benchmark_decontamination": _leaks,
    "op10_sharding": _over_documents(sharding_query),
    "op11_merkle_manifest": _over_documents(manifest_query),
    "op12_collocations": _over_documents(collocation_query),
    "op13_compression_quality": _quality,
}

ORACLES = {
    "op2_chat_formatting": CHAT_SQL,
    "op5_minhash_near_dedup": NEAR_DEDUP_SQL,
    "op8_exact_top_k": SEARCH_SQL,
    "op11_merkle_manifest": MANIFEST_SQL,
    "op12_collocations": COLLOCATION_SQL,
}
