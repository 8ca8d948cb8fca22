"""Named-entity or literal columns, and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.config import DEFAULT, Config
from gridloom.functions import text as T

BY = ["table_id", "col_id"]


def type_histogram(cells: DataFrame, kind: str = "cell_type") -> DataFrame:
    """table_id, col_id, type, n, first_row over the body."""
    return cells.filter("NOT is_header").groupBy(*BY, F.col(kind).alias("type")).agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row"))


def type_maps(cells: DataFrame, kind: str = "cell_type") -> DataFrame:
    """The histogram as a map for each column."""
    return type_histogram(cells, kind).groupBy(*BY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("type_freq"))


def word_count():
    """Words of a cell without punctuation and stop words; an empty cell adds none, and no word at all in a column counts as one."""
    words = F.split(T.remove_extra_spaces(T.remove_punctuation(F.coalesce("text", F.lit("")))), " ")
    return F.size(F.filter(words, lambda w: (w != "") & ~w.isin(*T.STOP_WORDS)))


def column_classes(cells: DataFrame, config: Config = DEFAULT, kind: str = "cell_type") -> DataFrame:
    """table_id, col_id, literal_share, mode_type, mean_words, col_type (NE or LIT), lit_type. Cells carry their type."""
    share = type_histogram(cells, kind).groupBy(*BY).agg(
        (F.sum(F.when(F.col("type") != "STRING", F.col("n")).otherwise(0)) / F.sum("n")).alias("literal_share"),
        F.max_by("type", F.struct("n", -F.col("first_row"))).alias("mode_type"),
    )
    blank = F.bool_and(F.trim(F.coalesce("text", F.lit(""))) == "")
    words = cells.filter("NOT is_header").groupBy(*BY).agg((F.when(blank, F.lit(1)).otherwise(F.sum(word_count())) / F.count(F.lit(1))).alias("mean_words"))
    literal, wordy = F.col("literal_share") > config.literal_share, F.col("mean_words") > config.max_words
    return share.join(words, BY).select(
        *BY,
        "literal_share",
        "mode_type",
        "mean_words",
        F.when(literal | wordy, "LIT").otherwise("NE").alias("col_type"),
        F.when(literal, F.col("mode_type")).when(wordy, "STRING").alias("lit_type"),
    )


def column_stats(cells: DataFrame) -> DataFrame:
    """table_id, col_id, unique_share, blank_share, n_cells over the body."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return cells.filter("NOT is_header").groupBy(*BY).agg(
        (F.count_distinct(text) / F.count(F.lit(1))).alias("unique_share"),
        F.avg((F.trim(text) == "").cast("int")).alias("blank_share"),
        F.count(F.lit(1)).alias("n_cells"),
    )


def bag_of_words(cells: DataFrame) -> DataFrame:
    """table_id, col_id, word, n."""
    words = F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    return cells.filter("NOT is_header").select(*BY, words.alias("word")).groupBy(*BY, "word").agg(F.count(F.lit(1)).alias("n"))


def distance_from_first_entity_column(classes: DataFrame) -> DataFrame:
    first = F.min(F.when(F.col("col_type") == "NE", F.col("col_id"))).over(Window.partitionBy("table_id"))
    return classes.withColumn("distance", F.abs(F.col("col_id") - first))


def entity_columns(classes: DataFrame) -> DataFrame:
    return classes.filter("col_type = 'NE'").select(*BY)


def number_columns(classes: DataFrame) -> DataFrame:
    return classes.filter("lit_type = 'NUMBER'").select(*BY)
