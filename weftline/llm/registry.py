"""The registered queries of the corpus operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import op1_gif, op2_mixing, op3_quality, op4_suffixes, op5_knn, op6_separators, op7_toxicity, op8_chosen_path, op9_html, op10_packing, op11_simhash, op12_lexical, op13_runs
from .common import table


def op1_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_gif.digest(op1_gif.to_media(table(spark, sf_dir, "documents")))


def op2_raked_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_mixing.query(spark, table(spark, sf_dir, "documents"))


def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_suffixes.query(table(spark, sf_dir, "documents"))


def op5_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_knn.query(table(spark, sf_dir, "embeddings"))


def op6_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_separators.scan(op6_separators.write_flat(table(spark, sf_dir, "documents")))


def op7_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_chosen_path.join(table(spark, sf_dir, "documents"))


def op9_html_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_html.query(table(spark, sf_dir, "pages"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_packing.pack(table(spark, sf_dir, "documents"))


def op11_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_runs.periodic(table(spark, sf_dir, "documents"), op13_runs.planted)


REGISTERED = (
    op1_gif_media,
    op2_raked_mixing,
    op3_quality_fm,
    op4_suffix_dedup,
    op5_voronoi_knn,
    op6_separator_scan,
    op7_toxicity_kneser_ney,
    op8_chosen_path_join,
    op9_html_block_labeller,
    op10_best_fit_packing,
    op11_simhash_tiles,
    op12_shared_search,
    op13_periodic_runs,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in REGISTERED}
ORACLE_SQL: dict[str, str] = {"op2_raked_mixing": op2_mixing.sql(), "op5_voronoi_knn": op5_knn.SQL, "op12_shared_search": op12_lexical.SQL}
