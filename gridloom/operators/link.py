"""Cells to entities, entities to types, and mentions that no entity answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.config import DEFAULT, Config
from gridloom.operators import coltypes

_DIRECT = r"^:d:(Q[0-9]+)$"


def link_keys(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(distinct links to look up, distinct entities named directly)."""
    links = cells.filter(F.coalesce("link", F.lit("")) != "").select("link").distinct()
    direct = F.regexp_extract("link", _DIRECT, 1)
    return links.filter(direct == "").select("link"), links.filter(direct != "").select(direct.alias("entity"))


def entity_keys(cells: DataFrame, kg_entity: DataFrame) -> DataFrame:
    """Entities that types are wanted for: those of links and those named directly, once each."""
    links, direct = link_keys(cells)
    return links.join(kg_entity, "link").select("entity").union(direct).distinct()


def with_entities(cells: DataFrame, kg_entity: DataFrame, titles: DataFrame) -> DataFrame:
    """cells + entity, is_nil: a direct id, else the link's entity, else NIL if no page has the title, else ''."""
    direct = F.regexp_extract(F.coalesce("link", F.lit("")), _DIRECT, 1)
    known = titles.select(F.col("title").alias("link")).distinct().withColumn("known", F.lit(True))
    out = cells.join(kg_entity.select("link", F.col("entity").alias("_entity")), "link", "left").join(known, "link", "left")
    entity = (
        F.when(F.coalesce("link", F.lit("")) == "", "")
        .when(direct != "", direct)
        .when(F.col("_entity").isNotNull(), F.col("_entity"))
        .when(F.col("known"), "")
        .otherwise("NIL")
    )
    return out.withColumn("entity", entity).withColumn("is_nil", F.col("entity") == "NIL").drop("_entity", "known")


def with_types(cells: DataFrame, kg_types: DataFrame) -> DataFrame:
    """cells + types: the entity's, an empty array without."""
    return cells.join(kg_types.select("entity", "types"), "entity", "left").withColumn("types", F.coalesce("types", F.array().cast("array<string>")))


def merged_titles(titles: DataFrame) -> DataFrame:
    """One page for each title: of the last file, and there of the last page."""
    last = F.row_number().over(Window.partitionBy("title").orderBy(F.col("source_file").desc(), F.col("page_id").desc()))
    return titles.withColumn("_n", last).filter("_n = 1").drop("_n")


def table_stats(cells: DataFrame, captions: DataFrame, top_types: DataFrame, depth: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Twenty counters of each table of linked and typed cells. captions: table_id, caption; depth: classes that have a superclass.

    NIL counts as not found too, and a linked cell without an entity as one
    without types. Counters of changes are 0 before there are any.
    """
    linked, found = F.coalesce("link", F.lit("")) != "", F.col("entity").startswith("Q")
    typed = F.size("types") > 0
    own = cells.groupBy("table_id").agg(
        F.count_if(linked).alias("tot_linked_cell"),
        F.count_if(found).alias("entities_found"),
        F.count_if(linked & ~found).alias("entities_not_found"),
        F.count_if(found & typed).alias("types_found"),
        F.count_if(linked & ~(found & typed)).alias("types_not_found"),
        F.count(F.lit(1)).alias("tot_cells"),
        F.count_if(F.col("is_nil")).alias("nils"),
        F.max(F.col("is_header").cast("int")).cast("long").alias("count_with_header"),
    )
    named = captions.groupBy("table_id").agg(F.max((~F.coalesce("caption", F.lit("")).isin("", "None")).cast("int")).cast("long").alias("count_with_caption"))
    covered = coltypes.coverage(cells)
    known, _ = coltypes.split_known(covered, depth)
    dropped = coltypes.split_unknown(covered, depth).groupBy("table_id").agg(F.count_distinct("type").alias("filtered_types"))
    columns = known.groupBy("table_id").agg(F.count_distinct("col_id").alias("tot_cols_with_types"))
    perfect = coltypes.domains(coltypes.perfect_types(known, config)).select("table_id", F.col("n_perfect").alias("found_perfect_types"))
    out = own
    for part in (named, generic_and_specific(cells, top_types), dropped, columns, perfect):
        out = out.join(part, "table_id", "left")
    out = out.fillna(0)
    single = F.col("found_perfect_types") <= 2
    zero = [F.lit(0).cast("long").alias(c) for c in ("acro_added", "typos_added", "approx_added", "alias_added")]
    return out.select("*", *zero, single.cast("long").alias("count_single_domain"), (~single).cast("long").alias("count_multi_domain"))


def link_totals(cells: DataFrame) -> DataFrame:
    """One row: cells with and without a link, distinct links and directly named entities."""
    link, direct = F.coalesce("link", F.lit("")), F.regexp_extract(F.coalesce("link", F.lit("")), _DIRECT, 1)
    return cells.agg(
        F.count_if(link != "").alias("tot_link"),
        F.count_if(link == "").alias("tot_nolink"),
        F.count_distinct(F.when((link != "") & (direct == ""), link)).alias("links"),
        F.count_distinct(F.when(direct != "", direct)).alias("direct"),
    )


def dictionary_sizes(dictionary: DataFrame, key: str) -> DataFrame:
    """One row: entries of a dictionary in all and by distinct keys."""
    return dictionary.agg(F.count(F.lit(1)).alias("entries"), F.count_distinct(key).alias("keys"))


def generic_and_specific(cells: DataFrame, top_types: DataFrame) -> DataFrame:
    """table_id, generic_types, specific_types: types of cells in and out of the most popular ones (a bounded list, broadcast)."""
    types = cells.select("table_id", F.explode("types").alias("type")).join(F.broadcast(top_types.select("type").withColumn("top", F.lit(True))), "type", "left")
    return types.groupBy("table_id").agg(F.count_if(F.col("top")).alias("generic_types"), F.count_if(F.col("top").isNull()).alias("specific_types"))


def page_totals(stats: DataFrame, tables: DataFrame) -> DataFrame:
    """The counters added up for each page."""
    counters = [c for c, t in stats.dtypes if t == "bigint"]
    return stats.join(tables.select("table_id", "page_id"), "table_id").groupBy("page_id").agg(*[F.sum(c).alias(c) for c in counters])
