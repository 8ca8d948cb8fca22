"""Seeded changes to cells: acronyms, typos, numbers, aliases. All chance is a hash of the cell's place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.config import DEFAULT, Config


def chance(tag: str, seed: int) -> Column:
    """A number from 0 to 16^7 - 1 by table, row, column, kind of change and seed."""
    place = F.concat_ws("|", F.lit(tag), F.lit(str(seed)), "table_id", F.col("row_id").cast("string"), F.col("col_id").cast("string"))
    return F.conv(F.substring(F.md5(place), 1, 7), 16, 10).cast("long")


def chosen(tag: str, percent: int, seed: int) -> Column:
    return chance(tag, seed) % 100 + 1 <= percent


def _changed(df: DataFrame, new: Column, when: Column) -> DataFrame:
    return df.withColumn("changed", F.coalesce(when, F.lit(False))).withColumn("text", F.when(F.col("changed"), new).otherwise(F.col("text")))


def add_acronyms(cells: DataFrame, columns: DataFrame, acronyms: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Text of entity columns by its acronym; + changed."""
    ne = columns.select("table_id", "col_id").withColumn("_ne", F.lit(True))
    short = acronyms.groupBy(F.lower("meaning").alias("_low")).agg(F.min("acronym").alias("_acronym"))
    out = cells.join(ne, ["table_id", "col_id"], "left").withColumn("_low", F.lower("text")).join(short, "_low", "left")
    when = F.col("_ne") & F.col("_acronym").isNotNull() & ~F.col("is_header") & chosen("acronym", config.acronym_percent, config.seed)
    return _changed(out, F.col("_acronym"), when).drop("_ne", "_low", "_acronym")


def add_typos(cells: DataFrame, columns: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One letter of the text of entity columns by another place's letter a to z; + changed."""
    ne = columns.select("table_id", "col_id").withColumn("_ne", F.lit(True))
    out = cells.join(ne, ["table_id", "col_id"], "left")
    at = chance("typo-at", config.seed) % F.greatest(F.length("text"), F.lit(1)) + 1
    letter = F.chr(F.lit(97) + chance("typo-letter", config.seed) % 26)
    new = F.concat(F.substring(F.col("text"), F.lit(1), (at - 1).cast("int")), letter, F.substring(F.col("text"), (at + 1).cast("int"), F.length("text")))
    when = F.col("_ne") & (F.length("text") > 0) & ~F.col("is_header") & chosen("typo", config.typo_percent, config.seed)
    return _changed(out, new, when).drop("_ne")


def approximate_numbers(cells: DataFrame, columns: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """-1, 0 or 1 added to plain numbers of number columns; + changed."""
    numbers = columns.select("table_id", "col_id").withColumn("_lit", F.lit(True))
    out = cells.join(numbers, ["table_id", "col_id"], "left")
    by = chance("number-by", config.seed) % 3 - 1
    whole = F.col("text").rlike(r"^[+-]?[0-9]{1,15}$")
    value = F.col("text").try_cast("double")
    new = F.when(whole, (F.col("text").try_cast("bigint") + by).cast("string")).otherwise((value + by).cast("string"))
    plain = F.col("text").rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$")
    when = F.col("_lit") & plain & ~F.col("is_header") & chosen("number", config.number_percent, config.seed)
    return _changed(out, new, when).drop("_lit")


def add_aliases(cells: DataFrame, columns: DataFrame, kg_alias: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Text of linked cells of entity columns by one of the entity's aliases; + changed."""
    ne = columns.select("table_id", "col_id").withColumn("_ne", F.lit(True))
    out = cells.join(ne, ["table_id", "col_id"], "left").join(kg_alias.select("entity", F.array_sort("aliases").alias("_aliases")), "entity", "left")
    new = F.get(F.col("_aliases"), (chance("alias-at", config.seed) % F.greatest(F.size("_aliases"), F.lit(1))).cast("int"))
    when = F.col("_ne") & (F.size("_aliases") > 0) & ~F.col("is_header") & chosen("alias", config.alias_percent, config.seed)
    return _changed(out, new, when).drop("_ne", "_aliases")


def change_counts(changed: DataFrame) -> DataFrame:
    """table_id, n_changed, n_columns that a change touched."""
    return changed.groupBy("table_id").agg(F.count_if("changed").alias("n_changed"), F.count_distinct(F.when(F.col("changed"), F.col("col_id"))).alias("n_columns"))


def augmented(cells: DataFrame, entity_columns: DataFrame, number_columns: DataFrame, acronyms: DataFrame, kg_alias: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """All four in order: acronyms, typos, numbers, aliases, those that are switched on; + acro, typos, approx, alias: what changed a cell."""
    steps = (
        ("acro", config.acronyms, lambda x: add_acronyms(x, entity_columns, acronyms, config)),
        ("typos", config.typos, lambda x: add_typos(x, entity_columns, config)),
        ("approx", config.numbers, lambda x: approximate_numbers(x, number_columns, config)),
        ("alias", config.aliases, lambda x: add_aliases(x, entity_columns, kg_alias, config)),
    )
    for name, on, step in steps:
        cells = step(cells).withColumnRenamed("changed", name) if on else cells.withColumn(name, F.lit(False))
    return cells


def all_change_counts(changed: DataFrame) -> DataFrame:
    """table_id, and of each kind the cells changed and the columns touched."""
    kinds = (("acro", "acro_added", "cols_with_acronyms"), ("typos", "typos_added", "cols_with_typos"), ("approx", "approx_added", "cols_with_approx"), ("alias", "alias_added", "cols_with_aliases"))
    counts = [x for k, n, c in kinds for x in (F.count_if(k).alias(n), F.count_distinct(F.when(F.col(k), F.col("col_id"))).alias(c))]
    return changed.groupBy("table_id").agg(*counts)
