"""Readers: page dumps, page documents, triples and lookups. All splits and pruning are Spark's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom import schema
from gridloom.functions import text as T


def read_dump(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Pages of an XML dump, compressed or not: page_id, title, wikitext, source_file.

    A page without id or title fails the job when read, if strict; else it stays
    with nulls, for ``quarantined``.
    """
    raw = spark.read.format("xml").option("rowTag", "page").schema(schema.DUMP_PAGE).load(path)
    must = lambda c: F.coalesce(F.trim(c), F.raise_error(F.lit("page without id or title")).cast("string")) if strict else F.trim(c)
    return raw.select(must(F.col("id")).alias("page_id"), must(F.col("title")).alias("title"), F.col("revision.text._VALUE").alias("wikitext"), F.col("_metadata.file_name").alias("source_file"))


def quarantined(df: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """(rows in which none of the columns is null, the others): what can't be used is set apart, and the job goes on."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return df.filter(whole), df.filter(~whole)


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """title (normalised), page_id, source_file; only these two elements are kept of each page."""
    pages = spark.read.format("xml").option("rowTag", "page").schema("title string, id string").load(path)
    return pages.select(T.normalize_link(F.col("title")).alias("title"), F.trim("id").alias("page_id"), F.col("_metadata.file_name").alias("source_file"))


def read_page_documents(spark: SparkSession, folder: str, tolerant: bool = False, names: str = "*diz_*", lines: bool = False) -> DataFrame:
    """Page documents (gzip or plain) in files of these names: one JSON a file, or one a line. tolerant: unreadable files are passed over."""
    return (
        spark.read.schema(schema.PAGE_DOCUMENT)
        .option("multiLine", not lines)
        .option("pathGlobFilter", names)
        .option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", tolerant)
        .json(folder)
    )


def page_tables(documents: DataFrame) -> DataFrame:
    """A row for each table of page documents: wiki_id, title, table_id, table."""
    return documents.select("wiki_id", "title", F.explode("tables").alias("table_id", "table"))


def qid_of(uri: Column) -> Column:
    """The number of an entity address's last segment, null if it isn't a letter and digits."""
    return F.regexp_extract(F.trim(uri), "^<?(?:.*/)?[^/0-9]([0-9]{1,18})>?$", 1).try_cast("bigint")


def read_triples(spark: SparkSession, path: str, predicate: str | None = None, strict: bool = True) -> DataFrame:
    """sub, sup of N-Triples lines (gzip or plain), null where an id doesn't parse.

    A line that isn't four fields with a final dot fails the job, if strict; else
    it gives nulls too.
    """
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    parts = F.split(F.trim("value"), " ")
    if predicate:
        lines = lines.filter(F.get(parts, F.lit(1)) == predicate)
    well = (F.size(parts) == 4) & (F.get(parts, F.lit(3)) == ".")
    if strict:
        lines = lines.filter(F.when(well, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad triple: "), F.col("value"))).cast("boolean")))
    field = lambda i: qid_of(F.when(well, F.get(parts, F.lit(i))))
    return lines.select(field(0).alias("sub"), field(2).alias("sup"))


def split_bad_ids(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(triples of two ids, a row with the number of others)."""
    good = F.col("sub").isNotNull() & F.col("sup").isNotNull() & (F.col("sub") != 0) & (F.col("sup") != 0)
    return triples.filter(good), triples.agg(F.count_if(~F.coalesce(good, F.lit(False))).alias("errors"))


def read_pairs(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A JSON object of a file as rows (key, value), values as strings."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,string>")).alias(key, value))


def acronym_pairs(lines: DataFrame) -> DataFrame:
    """List items "ABC – meaning; …" -> acronym, meaning (lower case): remarks and what follows : ; / or "such as" cut."""
    item = F.split("item", " – ", 2)
    meaning = F.regexp_replace(item[1], r"\[[^\]]*\]|\([^)]*\)", "")
    meaning = F.trim(F.lower(F.split(meaning, "[:;/]|such as")[0]))
    acronym = F.trim(F.split(F.regexp_replace(item[0], r"\[[^\]]*\]|\([^)]*\)", ""), "or")[0])
    return lines.filter(F.size(item) == 2).select(acronym.alias("acronym"), meaning.alias("meaning")).filter("acronym <> '' AND meaning <> ''")


#: Lookups of a knowledge base as tables: kind -> (key, value column).
LOOKUPS = {"entities": ("link", "entity"), "types": ("entity", "types"), "aliases": ("entity", "aliases"), "predicates": ("pair", "predicates"), "labels": ("entity", "label"), "literals": ("text", "datatype"), "columns": ("column", "analysis")}


def lookup(keys: DataFrame, kind: str, table: DataFrame) -> DataFrame:
    """Each distinct key with its value; keys without one, or with an empty list, are left out."""
    if kind not in LOOKUPS:
        raise ValueError(f"no lookup of kind {kind!r}")
    key, value = LOOKUPS[kind]
    out = keys.select(key).distinct().join(table.select(key, value), key)
    return out.filter(F.size(value) > 0) if dict(out.dtypes)[value].startswith("array") else out.filter(F.col(value).isNotNull())


def _variants(low: Column, most_apart: int) -> Column:
    """A name with up to so many of its letters left out: names most_apart edits apart share one of these."""
    out = F.array(low)
    for _ in range(most_apart):
        shorter = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(out, shorter))))
    return out


def lookup_names(names: DataFrame, labels: DataFrame, k: int = 10, most_apart: int = 0) -> DataFrame:
    """Entities by name: equal lower-case labels, or up to most_apart edits away; the k nearest of each name.

    Candidates share a variant with letters left out, so none is missed. A name
    has about length ** most_apart variants: most_apart is meant to be 1 or 2.
    """
    n = names.select("name", F.lower("name").alias("low")).distinct().select("name", "low", F.explode(_variants(F.col("low"), most_apart)).alias("variant"))
    e = labels.select("entity", "label", F.lower("label").alias("label_low")).select("*", F.explode(_variants(F.col("label_low"), most_apart)).alias("variant"))
    both = n.join(e, "variant").select("name", "entity", "label", F.levenshtein("low", "label_low").alias("apart")).filter(F.col("apart") <= most_apart).distinct()
    rank = F.row_number().over(Window.partitionBy("name").orderBy("apart", "entity", "label"))
    return both.withColumn("rank", rank).filter(F.col("rank") <= k).select("name", "entity", "label", "apart", "rank")
