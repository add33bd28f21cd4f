"""The queries on these operators, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybrook.llm import (
    decontaminate, filter_audit, fingerprints, language, licenses, near_duplicates, nearest, packing, privacy, quality, repeats, sharding,
    vector_codes,
)
from tallybrook.llm.base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_shards(spark, folder):
    return sharding.report(table(spark, folder, "documents"))


@query
def op2_personal_data(spark, folder):
    return privacy.report(table(spark, folder, "documents"))


@query
def op3_minhash(spark, folder):
    return near_duplicates.cluster(table(spark, folder, "documents"), size=4)


@query
def op4_best_two_fit(spark, folder):
    return packing.report(table(spark, folder, "documents"))


@query
def op5_importance_resampling(spark, folder):
    return quality.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_decontaminate(spark, folder):
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op7_weighted_sampling(spark, folder):
    return fingerprints.report(table(spark, folder, "documents"))


@query
def op8_license_scan(spark, folder):
    return licenses.report(table(spark, folder, "documents"))


@query
def op9_language(spark, folder):
    return language.report(table(spark, folder, "documents"))


@query
def op10_suffix_array(spark, folder):
    return repeats.report(table(spark, folder, "documents"))


@query
def op11_filter_audit(spark, folder):
    return filter_audit.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op12_kd_top_k(spark, folder):
    return nearest.top_k(table(spark, folder, "embeddings"))


@query
def op13_dual_tree_codes(spark, folder):
    return vector_codes.report(table(spark, folder, "embeddings"))
