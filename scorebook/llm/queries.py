"""The queries of this package over the driver tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontam, fill_middle, html_text, lang_id, line_dedup, near_dedup, packing, passage_dedup, pii, quality,
               role_repair, secrets, vp_search)
from .common import read_table


def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms_of(read_table(spark, sf_dir, "documents"))


def op2_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that holds a benchmark item, with the item."""
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op6_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grades(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(read_table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_vantage_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_search.nearest(read_table(spark, sf_dir, "embeddings"))


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op9_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), packing.default_tokenizer())


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(read_table(spark, sf_dir, "documents"))


def op11_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.digest(read_table(spark, sf_dir, "conversations"))


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.digest(read_table(spark, sf_dir, "documents"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_pseudonyms, op2_benchmark_matches, op3_language_codes, op4_near_duplicates, op5_secret_spans,
           op6_quality_grades, op7_vantage_neighbours, op8_page_text, op9_packed_sequences, op10_line_dedup,
           op11_role_repair, op12_repeated_passages, op13_fill_middle)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op4_near_duplicates": near_dedup.ORACLE_SQL, "op7_vantage_neighbours": vp_search.ORACLE_SQL,
            "op10_line_dedup": line_dedup.ORACLE_SQL, "op11_role_repair": role_repair.ORACLE_SQL,
            "op12_repeated_passages": passage_dedup.ORACLE_SQL,
            "op13_fill_middle": fill_middle.ORACLE_SQL}
