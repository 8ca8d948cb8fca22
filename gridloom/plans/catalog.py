"""Registered queries with their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.config import DEFAULT
from gridloom.functions import text as T
from gridloom.functions import tokens
from gridloom.operators import augment, classify, coltypes, export, filters, link, ontology, relations, stats
from gridloom.plans import grids as G
from gridloom.plans.grids import HIERARCHY, NATION_GRID, PART_GRID, ROW_GRID
from gridloom.plans.registry import ORACLES, QUERIES  # noqa: F401
from gridloom.plans.registry import query as _query
from gridloom.sources.storage import stored
from gridloom.sources.tables import table

_BLANK = "coalesce(text, '') IN ('', ' ', '-', 'None')"


# Gates and targets


@_query(f"""WITH {PART_GRID}, c AS (SELECT table_id, col_id, count(*) FILTER (link <> '') AS n, max(row_id) AS last FROM cells GROUP BY 1, 2)
SELECT table_id, CAST(max(last) + 1 AS BIGINT) AS n_rows, count(*) AS n_cols, max(n) AS max_links FROM c GROUP BY 1 HAVING max(n) >= 3""")
def grid_link_gate(spark, sf_dir):
    return filters.link_gate(G.part_grid(spark, sf_dir), DEFAULT.min_links)


@_query(f"""WITH {PART_GRID}, c AS (SELECT table_id, col_id, count(*) FILTER (link <> '') AS n_links FROM cells GROUP BY 1, 2)
SELECT table_id, col_id, n_links FROM c QUALIFY n_links = max(n_links) OVER (PARTITION BY table_id) AND n_links > 0""")
def argmax_target_columns(spark, sf_dir):
    return filters.target_columns(G.part_grid(spark, sf_dir))


# Pages

_TITLE_SQL = "trim(regexp_extract(html, '<title>([^<]*)', 1), ' ')"


@_query(f"""WITH t AS (SELECT page_id, replace({_TITLE_SQL}, ' ', '_') AS t FROM pages),
n AS (SELECT page_id, upper(t[1]) || t[2:] AS title FROM t)
SELECT title, max(page_id) AS page_id FROM n GROUP BY title""")
def page_title_index(spark, sf_dir):
    title = T.normalize_link(F.regexp_extract("html", "<title>([^<]*)", 1))
    titles = table(spark, sf_dir, "pages").select(title.alias("title"), "page_id", F.lit("pages").alias("source_file"))
    return link.merged_titles(titles).select("title", "page_id")


@_query("""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages),
c AS (SELECT page_id, CASE WHEN contains(link, '#') THEN '' ELSE link END AS link FROM l)
SELECT link, count(DISTINCT page_id) AS n_pages, count(*) AS n_links FROM c WHERE link <> '' GROUP BY link""")
def page_link_extract(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    links = links.withColumn("link", T.clean_link(F.col("link"))).filter("link <> ''")
    return links.groupBy("link").agg(F.count_distinct("page_id").alias("n_pages"), F.count(F.lit(1)).alias("n_links"))


@_query("""SELECT page_id, CAST(len(regexp_extract_all(html, '<a href=')) AS BIGINT) AS n_links FROM pages
WHERE contains(html, '<article') AND regexp_matches(html, '<a href=')""")
def page_prefilter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").filter(F.contains("html", F.lit("<article")))
    return pages.select("page_id", F.regexp_count("html", F.lit("<a href=")).cast("long").alias("n_links")).filter("n_links > 0")


def _clean_sql(x: str) -> str:
    for pattern, replacement in T.CLEAN_STEPS:
        x = f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', '{replacement.replace('$', chr(92))}', 'g')"
    x = rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
    return x


# A page's pieces begin at its blocks; none is left out.
_BLOCK = r"(<(?:article|blockquote|dd|div|dt|footer|h[1-6]|header|li|nav|p|pre|section|table|td|th|title|tr)[\s>])"


@_query(
    rf"""WITH s AS (SELECT 'page' AS kind, page_id AS id, string_split(regexp_replace(html, '{_BLOCK}', chr(1) || '\1', 'g'), chr(1)) AS parts FROM pages
UNION ALL SELECT 'document', doc_id, string_split(text, chr(10)) FROM documents),
r AS (SELECT kind, id, CAST(unnest(range(len(parts))) AS INTEGER) AS place, unnest(parts) AS raw FROM s),
c AS (SELECT kind, id, place, {_clean_sql("raw")} AS t FROM r)
SELECT kind, id, place, CASE WHEN contains(lower(t), 'file:') THEN 'IMAGE' WHEN contains(lower(t), 'help:') THEN 'HELP_PAGE'
  WHEN contains(lower(t), 'wikipedia:wikiproject') THEN 'WIKI_PROJ_PAGE' ELSE t END AS text FROM c"""
)
def clean_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.split(F.regexp_replace("html", _BLOCK, "\x01$1"), "\x01").alias("parts"))
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.split("text", "\n").alias("parts"))
    parts = pages.unionByName(docs).select("kind", "id", F.posexplode("parts").alias("place", "raw"))
    return parts.select("kind", "id", "place", T.clean_cell(F.col("raw")).alias("text"))


_KINDS = "geo_coordinates address hex_color url numeric image credit_card email ip isbn iso8601 boolean date id currency description iata other".split()


@_query(f"""WITH d AS (SELECT p_partkey, {_KINDS!r}[p_size % 18 + 1] AS datatype FROM part),
l AS (SELECT p_partkey, datatype, unnest(CASE datatype WHEN 'numeric' THEN ['float', 'integer', 'double'] WHEN 'url' THEN ['anyURI'] WHEN 'boolean' THEN ['boolean'] WHEN 'date' THEN ['date'] ELSE ['string'] END) AS name FROM d)
SELECT p_partkey, datatype, 'xsd:' || name AS xsd_label, 'http://www.w3.org/2001/XMLSchema#' || name AS xsd_uri FROM l""")
def xsd_lookup(spark, sf_dir):
    kinds = F.array(*[F.lit(k) for k in _KINDS])
    typed = table(spark, sf_dir, "part").select("p_partkey", F.get(kinds, F.col("p_size") % 18).alias("datatype"))
    labels = typed.select("p_partkey", "datatype", F.explode(T.xsd_types(F.col("datatype"))).alias("xsd_label"))
    return labels.withColumn("xsd_uri", T.xsd_uri(F.col("xsd_label")))


# Types of cells and columns

_TYPED_WORDS = tokens.cell_type_sql("word", "words", "lang, word, n")


@_query(f"""WITH words AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_split_to_array(text, '[ \\n]')) AS word FROM documents) GROUP BY 1, 2)
SELECT lang, cell_type, CAST(sum(n) AS BIGINT) AS n FROM ({_TYPED_WORDS}) GROUP BY 1, 2""")
def cell_type_histogram(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("lang", F.explode(F.split("text", "[ \n]")).alias("word"))
    # Each different word is typed once.
    words = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return tokens.with_cell_type(words, "word").groupBy("lang", "cell_type").agg(F.sum("n").alias("n"))


_STOPS = "[" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + "]"
_PUNCT = T.PUNCTUATION.replace("'", "''")
_CLASS_SQL = f"""typed AS ({tokens.cell_type_sql("text", "cells", "table_id, row_id, col_id, text")}),
h AS (SELECT table_id, col_id, cell_type, count(*) AS n, min(row_id) AS first_row FROM typed GROUP BY 1, 2, 3),
s AS (SELECT table_id, col_id, CAST(sum(CASE WHEN cell_type <> 'STRING' THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS literal_share,
  arg_max(cell_type, (n, -first_row)) AS mode_type FROM h GROUP BY 1, 2),
w AS (SELECT table_id, col_id, CASE WHEN bool_and(trim(text, ' ') = '') THEN 1.0 ELSE sum(len(list_filter(string_split(
    trim(regexp_replace(translate(text, '{_PUNCT}', ''), '\\s+', ' ', 'g'), ' '), ' '), lambda x: x <> '' AND NOT list_contains({_STOPS}, x)))) END
  / CAST(count(*) AS DOUBLE) AS mean_words FROM cells GROUP BY 1, 2),
classes AS (SELECT table_id, col_id, literal_share, mode_type, mean_words, CASE WHEN literal_share > 0.60 OR mean_words > 6 THEN 'LIT' ELSE 'NE' END AS col_type,
  CASE WHEN literal_share > 0.60 THEN mode_type WHEN mean_words > 6 THEN 'STRING' END AS lit_type FROM s JOIN w USING (table_id, col_id))"""


def _part_classes(spark, sf_dir):
    return classify.column_classes(tokens.with_cell_type(G.part_grid(spark, sf_dir), "text"))


@_query(f"WITH {PART_GRID}, {_CLASS_SQL} SELECT * FROM classes")
def column_classify(spark, sf_dir):
    return _part_classes(spark, sf_dir)


@_query(f"""WITH {PART_GRID}, {_CLASS_SQL}, u AS (SELECT table_id, col_id, CAST(count(DISTINCT text) AS DOUBLE) / count(*) AS unique_share,
  avg(CASE WHEN trim(text, ' ') = '' THEN 1 ELSE 0 END) AS blank_share, count(*) AS n_cells FROM cells GROUP BY 1, 2)
SELECT u.*, CAST(abs(u.col_id - min(u.col_id) FILTER (col_type = 'NE') OVER (PARTITION BY u.table_id)) AS INTEGER) AS distance
FROM u JOIN classes USING (table_id, col_id)""")
def column_stats(spark, sf_dir):
    distance = classify.distance_from_first_entity_column(_part_classes(spark, sf_dir)).select("table_id", "col_id", "distance")
    return classify.column_stats(G.part_grid(spark, sf_dir)).join(distance, ["table_id", "col_id"])


@_query(f"""WITH {PART_GRID}, w AS (SELECT table_id, col_id, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS word FROM cells)
SELECT table_id, col_id, word, count(*) AS n FROM w GROUP BY 1, 2, 3""")
def bag_of_words(spark, sf_dir):
    return classify.bag_of_words(G.part_grid(spark, sf_dir))


# Rules on columns, rows and tables


@_query(f"WITH {PART_GRID} SELECT table_id, col_id FROM cells GROUP BY 1, 2 HAVING 2 * count(*) FILTER ({_BLANK}) >= count(*)")
def drop_sparse_columns(spark, sf_dir):
    return filters.sparse_columns(G.part_grid(spark, sf_dir))


@_query(f"WITH {PART_GRID} SELECT table_id, col_id FROM cells GROUP BY 1, 2 HAVING count(DISTINCT text) = 1")
def drop_constant_columns(spark, sf_dir):
    return filters.constant_columns(G.part_grid(spark, sf_dir))


@_query(f"WITH {PART_GRID} SELECT table_id, col_id FROM cells GROUP BY 1, 2 HAVING bool_and(regexp_matches(text, '^Q[0-9]+$'))")
def drop_id_columns(spark, sf_dir):
    return filters.id_columns(G.part_grid(spark, sf_dir))


@_query(f"WITH {ROW_GRID} SELECT table_id, row_id FROM cells GROUP BY 1, 2 HAVING 2 * count(*) FILTER ({_BLANK}) >= count(*)")
def drop_sparse_rows(spark, sf_dir):
    return filters.sparse_rows(G.row_grid(spark, sf_dir))


@_query(f"WITH {ROW_GRID} SELECT table_id, row_id FROM cells GROUP BY 1, 2 HAVING count(DISTINCT text) = 1")
def drop_constant_rows(spark, sf_dir):
    return filters.constant_rows(G.row_grid(spark, sf_dir))


@_query(f"WITH {ROW_GRID} SELECT table_id, row_id FROM cells GROUP BY 1, 2 HAVING count(*) FILTER (contains(lower(text), 'total')) >= 2")
def drop_total_rows(spark, sf_dir):
    return filters.total_rows(G.row_grid(spark, sf_dir))


@_query(f"WITH {ROW_GRID} SELECT table_id, row_id FROM cells GROUP BY 1, 2 HAVING bool_and(contains(lower(text), 'none'))")
def drop_none_rows(spark, sf_dir):
    return filters.none_rows(G.row_grid(spark, sf_dir))


_GONE_SQL = f"""gone AS (SELECT table_id, col_id FROM cells GROUP BY 1, 2 HAVING 2 * count(*) FILTER ({_BLANK}) >= count(*) OR count(DISTINCT text) = 1
  OR bool_and(regexp_matches(text, '^Q[0-9]+$')) OR bool_or(text IN ('IMAGE', 'HELP_PAGE', 'WIKI_PROJ_PAGE'))),
kept AS (SELECT * FROM cells ANTI JOIN gone USING (table_id, col_id))"""


@_query(f"""WITH {PART_GRID}, {_GONE_SQL}, ids AS (SELECT DISTINCT table_id, col_id AS orig_col_id FROM kept)
SELECT table_id, orig_col_id, CAST(row_number() OVER (PARTITION BY table_id ORDER BY orig_col_id) - 1 AS INTEGER) AS col_id FROM ids""")
def reindex_columns(spark, sf_dir):
    cells = G.part_grid(spark, sf_dir)
    return filters.reindexed(cells, filters.removed_columns(cells), "col_id").select("table_id", "orig_col_id", "col_id").distinct()


@_query(f"""WITH {PART_GRID}, {_GONE_SQL}, rows_gone AS (SELECT table_id, row_id FROM kept GROUP BY 1, 2 HAVING 2 * count(*) FILTER ({_BLANK}) >= count(*)
  OR count(DISTINCT text) = 1 OR count(*) FILTER (contains(lower(text), 'total')) >= 2 OR bool_and(contains(lower(text), 'none'))),
left_ AS (SELECT * FROM kept ANTI JOIN rows_gone USING (table_id, row_id)),
c AS (SELECT table_id, col_id, count(*) FILTER (link <> '' AND NOT contains(link, '#')) AS n, count(*) AS m FROM left_ GROUP BY 1, 2)
SELECT table_id, CAST(max(m) AS BIGINT) AS n_rows, count(*) AS n_cols, max(n) AS max_links FROM c GROUP BY 1 HAVING max(n) >= 3""")
def filtered_tables(spark, sf_dir):
    return filters.link_gate(filters.filtered(G.part_grid(spark, sf_dir)))


# Linking


def _linked(spark, sf_dir):
    return link.with_entities(G.nation_grid(spark, sf_dir), G.kg_entity(spark, sf_dir), G.titles(spark, sf_dir))


def _typed(spark, sf_dir):
    return link.with_types(_linked(spark, sf_dir), G.kg_types(spark, sf_dir))


@_query(f"WITH {NATION_GRID} SELECT table_id, row_id, col_id, entity FROM linked WHERE link <> ''")
def entity_link_left(spark, sf_dir):
    return _linked(spark, sf_dir).filter("link <> ''").select("table_id", "row_id", "col_id", "entity")


@_query(f"WITH {NATION_GRID} SELECT table_id, row_id, col_id, entity, array_to_string(types, ',') AS types FROM typed WHERE link <> ''")
def entity_types_left(spark, sf_dir):
    return _typed(spark, sf_dir).filter("link <> ''").select("table_id", "row_id", "col_id", "entity", F.array_join("types", ",").alias("types"))


@_query(f"WITH {NATION_GRID} SELECT table_id, link, count(*) AS n FROM linked WHERE entity = 'NIL' GROUP BY 1, 2")
def nil_anti(spark, sf_dir):
    return _linked(spark, sf_dir).filter("is_nil").groupBy("table_id", "link").agg(F.count(F.lit(1)).alias("n"))


@_query("""SELECT key, count(*) AS n_sources FROM (SELECT DISTINCT 'supplier' AS s, s_nationkey AS key FROM supplier
UNION ALL SELECT DISTINCT 'customer', c_nationkey FROM customer) GROUP BY key""")
def key_union_distinct(spark, sf_dir):
    a = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("s"), F.col("s_nationkey").alias("key")).distinct()
    b = table(spark, sf_dir, "customer").select(F.lit("customer").alias("s"), F.col("c_nationkey").alias("key")).distinct()
    return a.unionByName(b).groupBy("key").agg(F.count(F.lit(1)).alias("n_sources"))


# Hierarchy and types of columns


@_query(f"WITH RECURSIVE {HIERARCHY} SELECT sub, sup, level FROM closed")
def class_closure(spark, sf_dir):
    return ontology.closure(G.hierarchy(spark, sf_dir))


@_query(f"WITH RECURSIVE {HIERARCHY} SELECT cls, depth, n_ancestors FROM depth")
def class_depth(spark, sf_dir):
    return ontology.depths(ontology.closure(G.hierarchy(spark, sf_dir)))


@_query(f"""WITH RECURSIVE {HIERARCHY}, pairs AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem)
SELECT a, b, CAST(CASE WHEN a = b THEN 0 WHEN u.sub IS NOT NULL THEN 1 WHEN d.sub IS NOT NULL THEN -1 ELSE x.depth - y.depth END AS INTEGER) AS "order"
FROM pairs LEFT JOIN closed u ON u.sub = a AND u.sup = b LEFT JOIN closed d ON d.sub = b AND d.sup = a
LEFT JOIN depth x ON x.cls = a LEFT JOIN depth y ON y.cls = b""")
def class_relation(spark, sf_dir):
    closed = stored(ontology.closure(G.hierarchy(spark, sf_dir)))  # read three times
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).distinct()
    return ontology.relation(pairs, closed, ontology.depths(closed))


@_query("SELECT l_partkey AS cls, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, cls LIMIT 100")
def type_popularity_topk(spark, sf_dir):
    return ontology.popularity(table(spark, sf_dir, "lineitem"), "l_partkey", 100)


_COVERAGE_SQL = """cov AS (SELECT s.table_id, s.col_id, s.type, s.n, r.n_rows, CAST(s.n AS DOUBLE) / r.n_rows AS coverage
FROM (SELECT table_id, col_id, type, count(*) AS n FROM (SELECT table_id, col_id, unnest(types) AS type FROM tcells) GROUP BY 1, 2, 3) s
JOIN (SELECT table_id, CAST(max(row_id) + 1 AS BIGINT) AS n_rows FROM tcells GROUP BY 1) r USING (table_id))"""
#: A table for each order: a column of parts and one of suppliers, typed by their classes and those above.
_TYPE_GRID_SQL = """tcells AS (SELECT CAST(l_orderkey AS VARCHAR) AS table_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS INTEGER) AS row_id, 0 AS col_id,
  ['Q' || CAST(l_partkey AS VARCHAR), 'Q' || CAST(l_partkey // 64 AS VARCHAR)] AS types FROM lineitem)"""


def _type_grid(spark, sf_dir):
    from pyspark.sql import Window

    q = lambda c: F.concat(F.lit("Q"), c.cast("string"))
    at = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")) - 1
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("table_id"), at.cast("int").alias("row_id"), F.lit(0).alias("col_id"), F.array(q(F.col("l_partkey")), q(F.floor(F.col("l_partkey") / 64))).alias("types")
    )


@_query(f"WITH {_TYPE_GRID_SQL}, {_COVERAGE_SQL} SELECT table_id, col_id, type, n, n_rows, coverage FROM cov")
def type_coverage(spark, sf_dir):
    return coltypes.coverage(_type_grid(spark, sf_dir))


@_query(f"""WITH RECURSIVE {HIERARCHY}, {_TYPE_GRID_SQL}, {_COVERAGE_SQL},
known AS (SELECT c.*, d.* FROM cov c JOIN depth d ON d.cls = CAST(c.type[2:] AS BIGINT))
SELECT table_id, col_id, coalesce(arg_max(type, (n_ancestors, depth, cls)) FILTER (n_rows <> 2 AND coverage >= 0.6::DOUBLE + (1.0::DOUBLE - 0.6::DOUBLE) / CAST(n_rows - 2 AS DOUBLE)), '') AS perfect
FROM known GROUP BY 1, 2""")
def perfect_type(spark, sf_dir):
    depth = ontology.depths(ontology.closure(G.hierarchy(spark, sf_dir)))
    known, _ = coltypes.split_known(coltypes.coverage(_type_grid(spark, sf_dir)), depth)
    return coltypes.perfect_types(known)


# Relations


@_query("""WITH r AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1 AS INTEGER) AS row_id FROM lineitem),
v AS (SELECT CAST(l_suppkey AS VARCHAR) AS table_id, row_id, CASE WHEN l_returnflag = 'N' THEN ['P1', 'P2'] ELSE ['P' || CASE WHEN l_linestatus = 'O' THEN '1' ELSE '3' END] END AS ps FROM r),
c AS (SELECT table_id, p, count(*) AS n, min(row_id) AS first FROM (SELECT table_id, row_id, unnest(ps) AS p FROM v) GROUP BY 1, 2)
SELECT table_id, 0 AS col_1, 1 AS col_2, arg_min(p, (-n, first, p)) AS predicate, max(n) AS votes FROM c GROUP BY 1""")
def pair_relations(spark, sf_dir):
    from pyspark.sql import Window

    at = (F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber")) - 1).cast("int")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("table_id"), at.alias("row_id"), "l_returnflag", "l_linestatus")
    both = F.array(F.struct(F.lit(0).alias("col_id"), F.concat(F.lit("Q"), "l_returnflag").alias("entity")), F.struct(F.lit(1).alias("col_id"), F.concat(F.lit("Q"), "l_linestatus").alias("entity")))
    cells = rows.select("table_id", "row_id", F.explode(both).alias("c")).select("table_id", "row_id", "c.*")
    known = spark.createDataFrame([(f"Q{a}", f"Q{b}", ["P1", "P2"] if a == "N" else ["P1" if b == "O" else "P3"]) for a in "ANR" for b in "OF"], "e1 string, e2 string, predicates array<string>")
    return relations.majority_predicates(relations.column_pairs(cells), known)


# Ground truth

_CEA_SQL = """cea AS (SELECT table_id, row_id AS row, col_id AS col, CASE WHEN entity = '' THEN 'UNKNOWN' WHEN entity LIKE 'Q%' THEN 'http://www.wikidata.org/entity/' || entity ELSE entity END AS answer
FROM linked SEMI JOIN (SELECT table_id, col_id FROM linked GROUP BY 1, 2 HAVING bool_or(entity <> '')) USING (table_id, col_id))"""


@_query(f"WITH {NATION_GRID}, {_CEA_SQL} SELECT * FROM cea")
def cea_rows(spark, sf_dir):
    return export.cea_rows(_linked(spark, sf_dir))


@_query(f'WITH {NATION_GRID}, {_CEA_SQL} SELECT table_id, "row", col FROM cea')
def target_rows(spark, sf_dir):
    return export.target_rows(export.cea_rows(_linked(spark, sf_dir)))


@_query(f"""WITH RECURSIVE {HIERARCHY}, {NATION_GRID}, tcells AS (SELECT * FROM typed), {_COVERAGE_SQL},
known AS (SELECT c.*, d.* FROM cov c JOIN depth d ON d.cls = CAST(c.type[2:] AS BIGINT)),
perfect AS (SELECT table_id, col_id, coalesce(arg_max(type, (n_ancestors, depth, cls)) FILTER (n_rows <> 2 AND coverage >= 0.1::DOUBLE + (1.0::DOUBLE - 0.1::DOUBLE) / CAST(n_rows - 2 AS DOUBLE)), '') AS p FROM known GROUP BY 1, 2)
SELECT table_id, col_id AS col, CASE WHEN p = '' THEN 'UNKNOWN' ELSE 'http://www.wikidata.org/entity/' || p END AS answer FROM perfect""")
def cta_rows(spark, sf_dir):
    from dataclasses import replace

    depth = ontology.depths(ontology.closure(G.hierarchy(spark, sf_dir)))
    known, _ = coltypes.split_known(coltypes.coverage(_typed(spark, sf_dir)), depth)
    # A base of 0.1: the threshold is 0.1 and more the fewer rows a table has.
    return export.cta_rows(coltypes.perfect_types(known, replace(DEFAULT, coverage_base=0.1)))


@_query(f"""WITH {NATION_GRID}
SELECT table_id, row_id, string_agg(text, '|' ORDER BY col_id) AS line FROM cells GROUP BY 1, 2""")
def dense_rows(spark, sf_dir):
    return export.dense_rows(G.nation_grid(spark, sf_dir)).select("table_id", "row_id", F.array_join("values", "|").alias("line"))


# Changes


def _chance_sql(tag: str) -> str:
    return f"CAST(('0x' || substr(md5('{tag}|{DEFAULT.seed}|' || table_id || '|' || CAST(row_id AS VARCHAR) || '|' || CAST(col_id AS VARCHAR)), 1, 7)) AS BIGINT)"


def _columns(cells, col_id: int):
    return cells.filter(F.col("col_id") == col_id).select("table_id", "col_id").distinct()


@_query(f"""WITH {PART_GRID} SELECT table_id, row_id, CASE WHEN {_chance_sql("typo")} % 100 + 1 <= {DEFAULT.typo_percent} THEN
  text[1:{_chance_sql("typo-at")} % length(text)] || chr(CAST(97 + {_chance_sql("typo-letter")} % 26 AS INTEGER)) || text[{_chance_sql("typo-at")} % length(text) + 2:] ELSE text END AS text
FROM cells WHERE col_id = 0""")
def augment_typo(spark, sf_dir):
    cells = G.part_grid(spark, sf_dir)
    return augment.add_typos(cells, _columns(cells, 0)).filter("col_id = 0").select("table_id", "row_id", "text")


@_query(f"""WITH {PART_GRID} SELECT table_id, count(*) FILTER (col_id = 0 AND {_chance_sql("typo")} % 100 + 1 <= {DEFAULT.typo_percent}) AS n_changed,
  CAST(max(CASE WHEN col_id = 0 AND {_chance_sql("typo")} % 100 + 1 <= {DEFAULT.typo_percent} THEN 1 ELSE 0 END) AS BIGINT) AS n_columns FROM cells GROUP BY 1""")
def augment_typo_counts(spark, sf_dir):
    cells = G.part_grid(spark, sf_dir)
    return augment.change_counts(augment.add_typos(cells, _columns(cells, 0)))


@_query(f"""WITH {PART_GRID} SELECT table_id, row_id, CASE WHEN {_chance_sql("number")} % 100 + 1 <= {DEFAULT.number_percent}
  THEN CAST(CAST(text AS BIGINT) + {_chance_sql("number-by")} % 3 - 1 AS VARCHAR) ELSE text END AS text FROM cells WHERE col_id = 2""")
def augment_number(spark, sf_dir):
    cells = G.part_grid(spark, sf_dir)
    return augment.approximate_numbers(cells, _columns(cells, 2)).filter("col_id = 2").select("table_id", "row_id", "text")


@_query(f"""WITH {PART_GRID}, a AS (SELECT DISTINCT p_type AS meaning, upper(p_type[1:3]) AS acronym FROM part WHERE p_size % 2 = 0),
s AS (SELECT lower(meaning) AS low, min(acronym) AS acronym FROM a GROUP BY 1)
SELECT table_id, row_id, CASE WHEN acronym IS NOT NULL AND {_chance_sql("acronym")} % 100 + 1 <= {DEFAULT.acronym_percent} THEN acronym ELSE text END AS text
FROM cells LEFT JOIN s ON lower(text) = low WHERE col_id = 1""")
def augment_acronym(spark, sf_dir):
    cells = G.part_grid(spark, sf_dir)
    kind = F.col("p_type")
    acronyms = table(spark, sf_dir, "part").filter("p_size % 2 = 0").select(kind.alias("meaning"), F.upper(F.substring(kind, 1, 3)).alias("acronym")).distinct()
    return augment.add_acronyms(cells, _columns(cells, 1), acronyms).filter("col_id = 1").select("table_id", "row_id", "text")


@_query(f"""WITH {NATION_GRID}, al AS (SELECT entity, [link || ' alias a', link || ' alias b'] AS aliases FROM kg)
SELECT table_id, row_id, CASE WHEN aliases IS NOT NULL AND {_chance_sql("alias")} % 100 + 1 <= {DEFAULT.alias_percent} THEN aliases[CAST({_chance_sql("alias-at")} % 2 + 1 AS INTEGER)] ELSE text END AS text
FROM linked LEFT JOIN al USING (entity) WHERE col_id = 1""")
def augment_alias(spark, sf_dir):
    cells = _linked(spark, sf_dir)
    aliases = G.kg_entity(spark, sf_dir).select("entity", F.array(F.concat("link", F.lit(" alias a")), F.concat("link", F.lit(" alias b"))).alias("aliases"))
    return augment.add_aliases(cells, _columns(cells, 1), aliases).filter("col_id = 1").select("table_id", "row_id", "text")


# Counters


@_query(f"""WITH {NATION_GRID}, {_CLASS_SQL.replace("typed AS", "tt AS").replace("FROM typed", "FROM tt")},
t AS (SELECT table_id, CAST(max(row_id) + 1 AS BIGINT) AS r, CAST(max(col_id) + 1 AS BIGINT) AS c, count(*) FILTER (entity = 'NIL') AS nils, count(*) FILTER (entity <> '') AS m FROM linked GROUP BY 1)
SELECT count(*) AS n_tables, CAST(sum(r) AS BIGINT) AS sum_rows, CAST(sum(c) AS BIGINT) AS sum_cols, max(r) AS max_rows, max(c) AS max_cols, min(r) AS min_rows, min(c) AS min_cols,
  CAST(sum(r * c) AS BIGINT) AS cells, CAST(sum(nils) AS BIGINT) AS nils, CAST(sum(m) AS BIGINT) AS mentions,
  (SELECT count(DISTINCT entity) FROM linked WHERE entity LIKE 'Q%') AS all_entities,
  (SELECT count(*) FROM classes WHERE col_type = 'LIT') AS lit_cols, (SELECT count(*) FROM classes WHERE col_type = 'NE') AS ne_cols FROM t""")
def corpus_stats(spark, sf_dir):
    classes = classify.column_classes(tokens.with_cell_type(G.nation_grid(spark, sf_dir), "text"))
    return stats.corpus_stats(_linked(spark, sf_dir), classes)


@_query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return stats.duplicate_keys(table(spark, sf_dir, "orders"), "o_custkey")


@_query(f"""WITH {_TYPE_GRID_SQL}, f AS (SELECT table_id, unnest(types) AS n_type FROM tcells),
top AS (SELECT n_type FROM f GROUP BY 1 ORDER BY count(*) DESC, n_type LIMIT {DEFAULT.generic_types})
SELECT table_id, count(*) FILTER (top.n_type IS NOT NULL) AS generic_types, count(*) FILTER (top.n_type IS NULL) AS specific_types FROM f LEFT JOIN top USING (n_type) GROUP BY 1""")
def generic_types(spark, sf_dir):
    cells = _type_grid(spark, sf_dir)
    top = ontology.popularity(cells.select(F.explode("types").alias("type")), "type", DEFAULT.generic_types).select(F.col("cls").alias("type"))
    return link.generic_and_specific(cells, top)
