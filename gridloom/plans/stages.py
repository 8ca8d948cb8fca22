"""Queries over the stages' readers, writers, counters and rules: what the catalogue's grids alone don't reach.

Markup, dumps, triples and documents are made from the data folder's tables, so
that DuckDB can say what has to come out without any of the parsers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.config import DEFAULT, Config
from gridloom.functions import text as T
from gridloom.functions import tokens
from gridloom.operators import augment, classify, coltypes, export, filters, link, ontology, relations, stats
from gridloom.plans import grids as G
from gridloom.plans.catalog import _COVERAGE_SQL, QUERIES, _chance_sql
from gridloom.plans.grids import HIERARCHY, NATION_GRID, PART_GRID
from gridloom.plans.registry import query
from gridloom.sources import dumps, sinks, wikitext
from gridloom.sources.storage import scratch
from gridloom.sources.tables import table

_NUMBER = "CAST(regexp_extract(table_id, '[0-9]+') AS INTEGER)"


def _number():
    return F.regexp_extract("table_id", "[0-9]+", 0).cast("int")


def _grid(spark, sf_dir) -> DataFrame:
    return G.part_grid(spark, sf_dir)


# Pages of markup: a table for each brand; every fifth brand's has another class, some cells span two columns.

_CAPS = Config(max_rows=81, max_columns=4, max_headers=1)
_WIKI = """
p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part),
pg AS (SELECT p_brand, CAST(min(p_partkey) AS VARCHAR) AS page_id, CAST(count(*) + 1 AS INTEGER) AS n_rows, CAST(p_brand[7:] AS INTEGER) % 5 <> 0 AS is_table FROM part GROUP BY 1),
w AS (
  SELECT p_brand, 0 AS row_id, c.* FROM pg, (VALUES (0, 'Name', '', 'STRING'), (1, 'Kind', 'Kind', 'STRING'), (2, 'Size', '', 'STRING'), (3, 'Brand', '', 'STRING')) c(col_id, text, link, raw_type)
  UNION ALL SELECT p_brand, r, 0, p_name, CASE WHEN p_size % 3 = 0 THEN upper(p_name[1]) || replace(p_name[2:], ' ', '_') ELSE '' END, 'STRING' FROM p
  UNION ALL SELECT p_brand, r, 1, CASE WHEN p_partkey % 4 = 0 THEN 'kind x' ELSE p_type END, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END, 'STRING' FROM p
  UNION ALL SELECT p_brand, r, 2, CAST(p_size AS VARCHAR), '', 'NUMBER' FROM p
  UNION ALL SELECT p_brand, r, 3, CASE WHEN p_size % 5 = 0 THEN CAST(p_size AS VARCHAR) ELSE p_brand END, '', CASE WHEN p_size % 5 = 0 THEN 'NUMBER' ELSE 'STRING' END FROM p),
gate AS (SELECT p_brand FROM (SELECT p_brand, col_id, count(*) FILTER (link <> '') AS n FROM w GROUP BY 1, 2) GROUP BY 1 HAVING max(n) >= 3),
kept AS (SELECT * FROM pg SEMI JOIN gate USING (p_brand) WHERE is_table AND n_rows <= 81)"""


def _wiki_pages(spark, sf_dir) -> DataFrame:
    """page_id, title, wikitext."""
    p = table(spark, sf_dir, "part")
    name = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("[["), "p_name", F.lit("]]"))).otherwise(F.col("p_name"))
    kind = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("[["), "p_type", F.lit("|kind]] x"))).otherwise(F.concat(F.lit("[["), "p_type", F.lit("]]")))
    size = F.col("p_size").cast("string")
    rest = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit('colspan="2" | '), size)).otherwise(F.concat(size, F.lit(" || "), "p_brand"))
    line = F.concat(F.lit("|-\n| "), name, F.lit(" || "), kind, F.lit(" || "), rest)
    lines = p.groupBy("p_brand").agg(F.min("p_partkey").cast("string").alias("page_id"), F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("line")))).alias("lines"))
    kind = F.when(F.substring("p_brand", 7, 9).cast("int") % 5 == 0, "plain").otherwise("wikitable")
    head = F.concat(F.lit('Intro\n== Data ==\nold\n{| class="'), kind, F.lit('"\n|+ Parts\n! Name!\n! [[Kind]]\n! Size\n! Brand\n'))
    body = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return lines.select("page_id", F.col("p_brand").alias("title"), F.concat(head, body, F.lit("\n|}\n== Data ==\nnew\n=== End ===\nbye")).alias("wikitext"))


@query(f"""WITH {_WIKI} SELECT substr(sha256(page_id || ':0'), 1, 16) AS table_id, page_id, 0 AS ordinal, 'Parts' AS caption, CAST(row_id AS INTEGER) AS row_id, col_id, row_id = 0 AS is_header,
  text, link, raw_type, n_rows, 4 AS n_cols, 1 AS header_rows FROM w JOIN kept USING (p_brand)""")
def wiki_cells(spark, sf_dir):
    return wikitext.extract_cells(_wiki_pages(spark, sf_dir), _CAPS)


@query(f"""WITH {_WIKI} SELECT page_id, s.* FROM pg, (VALUES ('Data', 'new'), ('End', 'bye')) s(section, content)""")
def wiki_sections(spark, sf_dir):
    return wikitext.page_context(_wiki_pages(spark, sf_dir)).select("page_id", F.explode("context").alias("section", "content"))


@query(f"""WITH {_WIKI} SELECT (SELECT count(*) FROM pg) AS tot_pages, (SELECT count(*) FROM pg WHERE is_table) AS tot_tab, (SELECT count(*) FROM pg WHERE is_table) AS tot_linked_tab,
  count(*) AS keep_tab, CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS keep_rows, 4 * count(*) AS keep_cols FROM kept""")
def extract_counters(spark, sf_dir):
    pages = _wiki_pages(spark, sf_dir)
    raw = wikitext.raw_cells(pages)
    return stats.extract_counters(pages, raw, wikitext.kept_cells(raw, _CAPS))


@query(f"""WITH {_WIKI} SELECT page_id, p_brand AS title FROM kept""")
def pages_with_tables(spark, sf_dir):
    pages = _wiki_pages(spark, sf_dir)
    return pages.join(wikitext.extract_cells(pages, _CAPS).select("page_id").distinct(), "page_id", "left_semi").select("page_id", "title")


# Readers


def _write_dump(part: DataFrame, page, path: str) -> None:
    """Pages as XML: a file, and in it one root, for each thousand parts."""
    block = F.floor(F.col("p_partkey") / 1000).alias("block")
    files = part.select(block, page.alias("page")).groupBy("block").agg(F.concat(F.lit("<dump>"), F.array_join(F.collect_list("page"), ""), F.lit("</dump>")).alias("value"))
    files.write.partitionBy("block").text(path)


def _dump(spark, sf_dir) -> DataFrame:
    """Pages of a dump of parts, as the reader gives them; those of every seventh part have no id."""
    path = scratch(spark, "dump")
    tag = lambda name, x: F.concat(F.lit(f"<{name}>"), x, F.lit(f"</{name}>"))
    key = F.col("p_partkey").cast("string")
    own = F.when(F.col("p_partkey") % 7 == 0, "").otherwise(tag("id", key))
    page = F.concat(tag("title", F.concat(F.lit(" "), "p_name", F.lit(" "), key)), F.lit("<ns>0</ns>"), own, tag("revision", F.concat(F.lit("<id>1</id>"), tag("text", F.concat(F.lit("about "), "p_type")))))
    _write_dump(table(spark, sf_dir, "part"), tag("page", page), path)
    return dumps.read_dump(spark, path, strict=False)


@query("SELECT CAST(p_partkey AS VARCHAR) AS page_id, p_name || ' ' || p_partkey AS title, 'about ' || p_type AS wikitext FROM part WHERE p_partkey % 7 <> 0")
def dump_pages(spark, sf_dir):
    return dumps.quarantined(_dump(spark, sf_dir), "page_id", "title")[0].select("page_id", "title", "wikitext")


@query("SELECT p_name || ' ' || p_partkey AS title FROM part WHERE p_partkey % 7 = 0")
def dump_quarantine(spark, sf_dir):
    return dumps.quarantined(_dump(spark, sf_dir), "page_id", "title")[1].select("title")


@query("""WITH t AS (SELECT 'a' AS f, p_name AS t, p_partkey AS id FROM part UNION ALL SELECT 'b', p_name, p_partkey + 1000000 FROM part WHERE p_size < 10),
n AS (SELECT f, upper(t[1]) || replace(t[2:], ' ', '_') AS title, CAST(id AS VARCHAR) AS page_id FROM t)
SELECT title, arg_max(page_id, (f, page_id)) AS page_id FROM n GROUP BY 1""")
def dump_titles_merged(spark, sf_dir):
    parts = []
    for name, least, rows in (("a", 0, "true"), ("b", 1_000_000, "p_size < 10")):
        path = scratch(spark, "titles")
        page = F.concat(F.lit("<page><title>"), "p_name", F.lit("</title><id>"), (F.col("p_partkey") + least).cast("string"), F.lit("</id></page>"))
        _write_dump(table(spark, sf_dir, "part").filter(rows), page, path)
        parts.append(dumps.read_titles(spark, path).withColumn("source_file", F.lit(name)))
    return link.merged_titles(parts[0].unionByName(parts[1])).select("title", "page_id")


def _triples(spark, sf_dir) -> DataFrame:
    path = scratch(spark, "triples")
    k = F.col("p_partkey")
    entity = lambda x: F.concat(F.lit("<http://x/entity/Q"), x.cast("string"), F.lit(">"))
    above = F.when(k % 50 == 0, "<http://x/class>").otherwise(entity(F.floor(k / 2)))
    kind = F.when(F.col("p_size") % 2 == 0, "<http://x/prop/P279>").otherwise("<http://x/prop/P31>")
    line = F.concat_ws(" ", entity(k), kind, above, F.when(k % 97 == 0, None).otherwise("."))
    table(spark, sf_dir, "part").select(line.alias("value")).write.option("compression", "gzip").text(path)
    return dumps.read_triples(spark, path, "<http://x/prop/P279>", strict=False)


_TRIPLES = "t AS (SELECT p_partkey AS sub, p_partkey // 2 AS sup, p_partkey % 50 <> 0 AND p_partkey % 97 <> 0 AND p_partkey > 1 AS good FROM part WHERE p_size % 2 = 0)"


@query(f"WITH {_TRIPLES} SELECT sub, sup FROM t WHERE good")
def triples_scan(spark, sf_dir):
    return dumps.split_bad_ids(_triples(spark, sf_dir))[0]


@query(f"WITH {_TRIPLES} SELECT count(*) FILTER (NOT good) AS errors FROM t")
def triple_errors(spark, sf_dir):
    return dumps.split_bad_ids(_triples(spark, sf_dir))[1]


@query(f"WITH {PART_GRID} SELECT table_id AS wiki_id, 'T' || table_id AS table_id, 'of ' || table_id AS caption, count(DISTINCT row_id) AS n_rows, max(text) FILTER (row_id = 0 AND col_id = 0) AS first_text FROM cells GROUP BY 1")
def page_documents_scan(spark, sf_dir):
    dense = export.dense_rows(_grid(spark, sf_dir)).groupBy("table_id").agg(F.array_sort(F.collect_list(F.struct("row_id", "values"))).alias("rows"))
    one = F.struct(F.concat(F.lit("of "), "table_id").alias("caption"), F.transform("rows", lambda r: r["values"]).alias("text"))
    documents = dense.select(F.col("table_id").alias("wiki_id"), F.col("table_id").alias("title"), F.create_map(F.concat(F.lit("T"), "table_id"), one).alias("tables"), F.lit("parts").alias("source_file"))
    path = scratch(spark, "documents")
    sinks.write_page_documents(documents, path)
    tables = dumps.page_tables(dumps.read_page_documents(spark, path, names="part-*", lines=True))
    return tables.select("wiki_id", "table_id", "table.caption", F.size("table.text").cast("long").alias("n_rows"), F.col("table.text")[0][0].alias("first_text"))


@query("SELECT n_name AS name, CAST(n_nationkey AS VARCHAR) AS number FROM nation")
def lookup_pairs(spark, sf_dir):
    path = scratch(spark, "pairs")
    pairs = table(spark, sf_dir, "nation").agg(F.map_from_entries(F.collect_list(F.struct("n_name", F.col("n_nationkey").cast("string")))).alias("m"))  # nation has a fixed size
    pairs.select(F.to_json("m").alias("value")).coalesce(1).write.text(path)
    return dumps.read_pairs(spark, path, "name", "number")


@query(f"WITH {NATION_GRID} SELECT DISTINCT entity, array_to_string(types, ',') AS types FROM typed WHERE entity LIKE 'Q%' AND len(types) > 0")
def kg_lookup(spark, sf_dir):
    cells = link.with_entities(G.nation_grid(spark, sf_dir), G.kg_entity(spark, sf_dir), G.titles(spark, sf_dir))
    links = dumps.lookup(cells.filter("link <> ''"), "entities", G.kg_entity(spark, sf_dir))
    return dumps.lookup(links, "types", G.kg_types(spark, sf_dir)).select("entity", F.array_join("types", ",").alias("types"))


@query("""WITH n AS (SELECT DISTINCT lower(n_name) AS name FROM nation), e AS (SELECT 'Q' || n_nationkey AS entity, n_name AS label FROM nation),
b AS (SELECT name, entity, label, levenshtein(name, lower(label)) AS apart FROM n, e WHERE levenshtein(name, lower(label)) <= 1)
SELECT name, entity, label, CAST(apart AS INTEGER) AS apart, CAST(row_number() OVER (PARTITION BY name ORDER BY apart, entity, label) AS INTEGER) AS rank FROM b QUALIFY rank <= 3""")
def name_lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    labels = nation.select(F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("entity"), F.col("n_name").alias("label"))
    return dumps.lookup_names(nation.select(F.lower("n_name").alias("name")), labels, 3, 1)


@query("SELECT DISTINCT upper(p_type[1:3]) AS acronym, lower(p_name) AS meaning FROM part WHERE p_size % 4 = 0")
def acronym_items(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    short = F.upper(F.substring("p_type", 1, 3))
    item = F.when(F.col("p_size") % 4 == 0, F.concat(short, F.lit(" [1] – "), F.upper("p_name"), F.lit(" (old); such as this"))).otherwise(short)
    path = scratch(spark, "acronyms")
    sinks.write_pairs(dumps.acronym_pairs(part.select(item.alias("item"))).distinct(), path)
    return spark.read.schema("acronym string, meaning string").json(path)


# Rules


@query(f"WITH {PART_GRID} SELECT DISTINCT table_id, CASE {_NUMBER} % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 1 END AS col_id FROM cells WHERE {_NUMBER} % 2 = 0")
def sentinel_columns(spark, sf_dir):
    hit = (_number() % 2 == 0) & (F.col("row_id") == 0) & (F.col("col_id") == F.when(_number() % 3 == 0, 2).when(_number() % 3 == 1, 0).otherwise(1))
    sign = F.when(_number() % 3 == 0, "IMAGE").when(_number() % 3 == 1, "HELP_PAGE").otherwise("WIKI_PROJ_PAGE")
    return filters.sentinel_columns(_grid(spark, sf_dir).withColumn("text", F.when(hit, sign).otherwise(F.col("text"))))


@query(f"WITH {PART_GRID} SELECT DISTINCT table_id, col_id FROM cells WHERE {_NUMBER} % 4 = 0")
def empty_body_columns(spark, sf_dir):
    return filters.empty_body_columns(_grid(spark, sf_dir).withColumn("is_header", (_number() % 4 == 0) | (F.col("row_id") < 2)))


@query(f"WITH {PART_GRID} SELECT table_id, row_id, CASE WHEN {_NUMBER} % 2 = 0 OR row_id <> 1 THEN text ELSE 'An ' || text END AS text FROM cells WHERE col_id = 0")
def first_word_cut(spark, sf_dir):
    cells = _grid(spark, sf_dir).filter("col_id = 0")
    word = F.when((_number() % 2 == 0) | (F.col("row_id") != 1), "The ").otherwise("An ")
    # Where a row has another word, nothing is cut.
    cells = cells.withColumn("text", F.when((_number() % 2 == 0) | (F.col("row_id") == 1), F.concat(word, "text")).otherwise(F.col("text")))
    return filters.without_repeated_first_word(cells).select("table_id", "row_id", "text")


def _direct_grid(spark, sf_dir) -> DataFrame:
    """The nations' grid with direct entity links in its first column: every fourth, and every eighth with the id as its text."""
    direct = (F.col("col_id") == 0) & (F.col("row_id") % 4 == 0)
    shown = direct & (F.col("row_id") % 8 == 0)
    entity = F.concat(F.lit("Q"), (F.col("row_id") + 1).cast("string"))
    return G.nation_grid(spark, sf_dir).withColumn("link", F.when(direct, F.concat(F.lit(":d:"), entity)).otherwise(F.col("link"))).withColumn("text", F.when(shown, entity).otherwise(F.col("text")))


_DIRECT = f"""{NATION_GRID},
dc AS (SELECT table_id, row_id, col_id, CASE WHEN col_id = 0 AND row_id % 8 = 0 THEN 'Q' || (row_id + 1) ELSE text END AS text,
  CASE WHEN col_id = 0 AND row_id % 4 = 0 THEN ':d:Q' || (row_id + 1) ELSE link END AS link, CASE WHEN col_id = 0 AND row_id % 4 = 0 THEN 'Q' || (row_id + 1) ELSE entity END AS entity FROM linked)"""


@query(f"WITH {_DIRECT} SELECT DISTINCT table_id, row_id FROM dc WHERE row_id % 8 = 0")
def rows_with_ids(spark, sf_dir):
    return filters.rows_with_ids(_direct_grid(spark, sf_dir))


@query(f"WITH {_DIRECT} SELECT table_id, row_id, col_id, entity FROM dc WHERE link <> ''")
def direct_links(spark, sf_dir):
    cells = link.with_entities(_direct_grid(spark, sf_dir), G.kg_entity(spark, sf_dir), G.titles(spark, sf_dir))
    return cells.filter("link <> ''").select("table_id", "row_id", "col_id", "entity")


@query(f"WITH {_DIRECT} SELECT DISTINCT entity FROM dc WHERE entity LIKE 'Q%'")
def entity_keys(spark, sf_dir):
    return link.entity_keys(_direct_grid(spark, sf_dir), G.kg_entity(spark, sf_dir))


@query(f"WITH {_DIRECT} SELECT count(*) FILTER (link <> '') AS tot_link, count(*) FILTER (link = '') AS tot_nolink, count(DISTINCT link) FILTER (link <> '' AND link NOT LIKE ':d:%') AS links, count(DISTINCT link) FILTER (link LIKE ':d:%') AS direct FROM dc")
def link_totals(spark, sf_dir):
    return link.link_totals(_direct_grid(spark, sf_dir))


@query(f"WITH {PART_GRID} SELECT table_id, CAST(6 * count(DISTINCT row_id) AS INTEGER) AS expected, count(*) - 1 AS found FROM cells WHERE {_NUMBER} % 6 = 0 GROUP BY 1")
def misshapen_tables(spark, sf_dir):
    return filters.misshapen(_grid(spark, sf_dir).filter(~((_number() % 6 == 0) & (F.col("col_id") == 3) & (F.col("row_id") == 1))))


@query(f"""WITH {_DIRECT}, ok AS (SELECT * FROM dc WHERE row_id % 8 <> 0 AND NOT (table_id = 'BUILDING')),
g AS (SELECT table_id FROM (SELECT table_id, col_id, count(*) FILTER (entity <> '') AS n FROM ok GROUP BY 1, 2) GROUP BY 1 HAVING max(n) >= 3)
SELECT table_id, count(*) AS n_cells, CAST(max(row_id) - max(row_id) // 8 - 1 AS INTEGER) AS last_row FROM ok SEMI JOIN g USING (table_id) GROUP BY 1""")
def export_ready(spark, sf_dir):
    cells = link.with_entities(_direct_grid(spark, sf_dir), G.kg_entity(spark, sf_dir), G.titles(spark, sf_dir))
    cells = cells.filter("NOT (table_id = 'BUILDING' AND row_id = 1 AND col_id = 2)")  # a table with a missing cell
    return filters.export_ready(cells).groupBy("table_id").agg(F.count(F.lit(1)).alias("n_cells"), F.max("row_id").alias("last_row"))


@query(f"""WITH {PART_GRID} SELECT count(DISTINCT table_id) AS tables, (SELECT count(*) FROM (SELECT table_id FROM cells WHERE col_id = 1 GROUP BY 1 HAVING count(*) >= 3 AND {_NUMBER} % 2 = 0)) AS kept FROM cells""")
def filter_counters(spark, sf_dir):
    cells = _grid(spark, sf_dir).withColumn("link", F.when(_number() % 2 == 0, F.col("link")).otherwise(F.lit("")))
    return stats.filter_counters(cells, cells.join(filters.link_gate(cells, 3).select("table_id"), "table_id", "left_semi"))


@query(f"""WITH {PART_GRID} SELECT table_id, count(DISTINCT row_id) AS n_rows, count(DISTINCT row_id) FILTER (row_id IN (0, 2)) AS header_rows FROM cells WHERE row_id % 3 <> 1 GROUP BY 1""")
def header_rows_left(spark, sf_dir):
    cells = _grid(spark, sf_dir).withColumn("is_header", F.col("row_id") < 3)
    left = filters.reindexed(cells, cells.filter("row_id % 3 = 1").select("table_id", "row_id").distinct(), "row_id")
    return left.groupBy("table_id").agg(F.count_distinct("row_id").alias("n_rows"), F.count_distinct(F.when(F.col("is_header"), F.col("row_id"))).alias("header_rows"))


# Text and types


@query(f"""WITH {PART_GRID}, k AS (SELECT table_id, col_id, CASE WHEN text = '' THEN '' WHEN col_id = 2 THEN 'NUMBER' ELSE 'STRING' END AS kind FROM cells),
n AS (SELECT table_id, col_id, kind, count(*) AS n FROM k GROUP BY 1, 2, 3) SELECT table_id, col_id, string_agg(kind || ':' || n, ',' ORDER BY kind) AS kinds FROM n GROUP BY 1, 2""")
def type_maps(spark, sf_dir):
    maps = classify.type_maps(tokens.with_cell_type(_grid(spark, sf_dir), "text"))
    entries = F.array_sort(F.map_entries("type_freq"))
    return maps.select("table_id", "col_id", F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",").alias("kinds"))


@query(f"""WITH {PART_GRID} SELECT table_id, row_id, col_id, CASE WHEN text = '' THEN '' WHEN col_id = 2 THEN text || '[number]' WHEN col_id = 3 THEN 'Brand[word] #[symbol] ' || text[7:] || '[number]'
  WHEN col_id = 5 THEN 'Q[word] ' || text[2:] || '[number]' ELSE replace(text, ' ', '[word] ') || '[word]' END AS tokens FROM cells""")
def token_values(spark, sf_dir):
    return tokens.with_tokens(_grid(spark, sf_dir), "text").select("table_id", "row_id", "col_id", F.array_join(tokens.rendered(F.col("tokens")), " ").alias("tokens"))


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'do n''t stop' WHEN 1 THEN 'she ''ll ' || p_type WHEN 2 THEN p_type || ' ''s end' ELSE 'o '' clock' END AS parts FROM part""")
def apostrophes(spark, sf_dir):
    text = F.when(F.col("p_size") % 4 == 0, "don't stop").when(F.col("p_size") % 4 == 1, F.concat(F.lit("she'll "), "p_type")).when(F.col("p_size") % 4 == 2, F.concat("p_type", F.lit("'s end"))).otherwise("o'clock")
    cells = tokens.with_tokens(table(spark, sf_dir, "part").select("p_partkey", text.alias("text")), "text")
    return cells.select("p_partkey", F.array_join(F.transform("tokens", lambda t: t["value"]), " ").alias("parts"))


@query(f"WITH {PART_GRID} SELECT table_id, row_id, col_id, CASE WHEN text = '' THEN NULL WHEN col_id = 2 THEN 'number' ELSE 'word' END AS tag FROM cells")
def frequent_tags(spark, sf_dir):
    return tokens.with_tokens(_grid(spark, sf_dir), "text").select("table_id", "row_id", "col_id", tokens.most_frequent_tag(F.col("tokens")).alias("tag"))


@query("SELECT p_partkey, regexp_replace(p_brand || ' ' || p_name, '[^a-zA-Z0-9]', ' ', 'g') AS kept, replace('!' || p_name || '!', '!', '') AS header, p_name || p_type AS flat FROM part")
def plain_texts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    marked = F.concat(F.lit("!"), "p_name", F.lit("!"))
    flat = F.replace(F.concat("p_name", F.lit("\n"), "p_type"), F.lit("\n"), F.lit(""))
    return part.select("p_partkey", T.keep_alphanumerics(F.concat_ws(" ", "p_brand", "p_name")).alias("kept"), T.header_text(marked).alias("header"), flat.alias("flat"))


@query(f"WITH {PART_GRID} SELECT DISTINCT table_id, col_id, CASE WHEN col_id = 2 THEN 'number' ELSE 'entity' END AS kind FROM cells WHERE col_id IN (0, 1, 2, 3, 5)")
def column_lists(spark, sf_dir):
    classes = classify.column_classes(tokens.with_cell_type(_grid(spark, sf_dir).filter("col_id <> 4"), "text"))
    return classify.entity_columns(classes).withColumn("kind", F.lit("entity")).unionByName(classify.number_columns(classes).withColumn("kind", F.lit("number")))


# Types of columns: a table for each order, three columns of ever wider classes.

_WIDE = """tcells AS (SELECT CAST(l_orderkey AS VARCHAR) AS table_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS INTEGER) AS row_id, CAST(c AS INTEGER) AS col_id,
  ['Q' || CAST(l_partkey AS VARCHAR), 'Q' || CAST(l_partkey // (32 * (c + 1)) AS VARCHAR)] AS types FROM lineitem, range(3) r(c))"""


def _wide(spark, sf_dir) -> DataFrame:
    q = lambda c: F.concat(F.lit("Q"), c.cast("string"))
    at = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")) - 1
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("table_id"), at.cast("int").alias("row_id"), "l_partkey", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("col_id"))
    return rows.select("table_id", "row_id", "col_id", F.array(q(F.col("l_partkey")), q(F.floor(F.col("l_partkey") / (32 * (F.col("col_id") + 1))))).alias("types"))


def _depths(spark, sf_dir) -> DataFrame:
    return ontology.depths(ontology.closure(G.hierarchy(spark, sf_dir)))


def _known(spark, sf_dir) -> DataFrame:
    return coltypes.split_known(coltypes.coverage(_wide(spark, sf_dir)), _depths(spark, sf_dir))[0]


_KNOWN = "known AS (SELECT c.*, d.* FROM cov c JOIN depth d ON d.cls = CAST(c.type[2:] AS BIGINT))"


@query(f"""WITH RECURSIVE {HIERARCHY}, {_WIDE}, {_COVERAGE_SQL}, {_KNOWN},
perfect AS (SELECT table_id, col_id, coalesce(arg_max(type, (n_ancestors, depth, cls)) FILTER (n_rows <> 2 AND coverage >= 0.6::DOUBLE + (1.0::DOUBLE - 0.6::DOUBLE) / CAST(n_rows - 2 AS DOUBLE)), '') AS p FROM known GROUP BY 1, 2)
SELECT table_id, count(*) FILTER (p <> '') AS n_perfect, count(*) FILTER (p <> '') <= 2 AS single_domain FROM perfect GROUP BY 1""")
def domain_class(spark, sf_dir):
    return coltypes.domains(coltypes.perfect_types(_known(spark, sf_dir)))


@query(f"""WITH RECURSIVE {HIERARCHY}, {_WIDE}, {_COVERAGE_SQL}, {_KNOWN}
SELECT table_id, col_id, string_agg(type, ',' ORDER BY n_ancestors, depth, cls) AS types FROM known GROUP BY 1, 2""")
def column_types_order(spark, sf_dir):
    return coltypes.column_types(_known(spark, sf_dir)).select("table_id", "col_id", F.array_join(F.transform("col_types", lambda x: x["qid"]), ",").alias("types"))


@query(f"""WITH RECURSIVE {HIERARCHY}, {_WIDE}, {_COVERAGE_SQL} SELECT DISTINCT type FROM cov ANTI JOIN depth ON depth.cls = CAST(cov.type[2:] AS BIGINT)""")
def filtered_types(spark, sf_dir):
    return coltypes.split_known(coltypes.coverage(_wide(spark, sf_dir)), _depths(spark, sf_dir))[1]


@query(f"""WITH RECURSIVE {HIERARCHY} SELECT cls, row_number() OVER (PARTITION BY cls % 3 ORDER BY n_ancestors, depth, cls) AS place FROM depth""")
def specificity_order(spark, sf_dir):
    depth = _depths(spark, sf_dir).withColumn("part", F.col("cls") % 3)
    return depth.select("cls", ontology.by_specificity(depth, ["part"]).alias("place"))


# Counters


def _linked(spark, sf_dir) -> DataFrame:
    return link.with_entities(G.nation_grid(spark, sf_dir), G.kg_entity(spark, sf_dir), G.titles(spark, sf_dir))


def _top(cells: DataFrame) -> DataFrame:
    return ontology.popularity(cells.select(F.explode("types").alias("type")), "type", 3).select(F.col("cls").alias("type"))


def _stats(spark, sf_dir) -> DataFrame:
    cells = link.with_types(_linked(spark, sf_dir), G.kg_types(spark, sf_dir)).withColumn("is_header", (F.col("row_id") == 0) & F.col("table_id").startswith("B"))
    captions = cells.select("table_id", F.when(F.col("table_id") == "MACHINERY", "None").otherwise(F.col("table_id")).alias("caption")).distinct()
    return link.table_stats(cells, captions, _top(cells), _depths(spark, sf_dir))


_STATS = f"""{HIERARCHY}, {NATION_GRID}, tcells AS (SELECT * FROM typed), {_COVERAGE_SQL}, {_KNOWN},
perfect AS (SELECT table_id, col_id, coalesce(arg_max(type, (n_ancestors, depth, cls)) FILTER (n_rows <> 2 AND coverage >= 0.6::DOUBLE + (1.0::DOUBLE - 0.6::DOUBLE) / CAST(n_rows - 2 AS DOUBLE)), '') AS p FROM known GROUP BY 1, 2),
pc AS (SELECT table_id, count(*) FILTER (p <> '') AS found_perfect_types, count(*) AS tot_cols_with_types FROM perfect GROUP BY 1),
ft AS (SELECT table_id, count(DISTINCT type) AS filtered_types FROM cov ANTI JOIN depth ON depth.cls = CAST(cov.type[2:] AS BIGINT) GROUP BY 1),
f AS (SELECT table_id, unnest(types) AS t FROM typed), top AS (SELECT t FROM f GROUP BY 1 ORDER BY count(*) DESC, t LIMIT 3),
gs AS (SELECT table_id, count(*) FILTER (t IN (SELECT t FROM top)) AS generic_types, count(*) FILTER (t NOT IN (SELECT t FROM top)) AS specific_types FROM f GROUP BY 1),
own AS (SELECT table_id, count(*) FILTER (link <> '') AS tot_linked_cell, count(*) FILTER (entity LIKE 'Q%') AS entities_found, count(*) FILTER (link <> '' AND entity NOT LIKE 'Q%') AS entities_not_found,
  count(*) FILTER (entity LIKE 'Q%' AND len(types) > 0) AS types_found, count(*) FILTER (link <> '' AND NOT (entity LIKE 'Q%' AND len(types) > 0)) AS types_not_found, count(*) AS tot_cells,
  count(*) FILTER (entity = 'NIL') AS nils FROM typed GROUP BY 1),
ts AS (SELECT own.*, CAST(table_id LIKE 'B%' AS BIGINT) AS count_with_header, CAST(table_id <> 'MACHINERY' AS BIGINT) AS count_with_caption, coalesce(generic_types, 0) AS generic_types, coalesce(specific_types, 0) AS specific_types,
  coalesce(filtered_types, 0) AS filtered_types, coalesce(tot_cols_with_types, 0) AS tot_cols_with_types, coalesce(found_perfect_types, 0) AS found_perfect_types, CAST(0 AS BIGINT) AS acro_added, CAST(0 AS BIGINT) AS typos_added,
  CAST(0 AS BIGINT) AS approx_added, CAST(0 AS BIGINT) AS alias_added, CAST(coalesce(found_perfect_types, 0) <= 2 AS BIGINT) AS count_single_domain, CAST(coalesce(found_perfect_types, 0) > 2 AS BIGINT) AS count_multi_domain
  FROM own LEFT JOIN gs USING (table_id) LEFT JOIN ft USING (table_id) LEFT JOIN pc USING (table_id))"""


@query(f"WITH RECURSIVE {_STATS} SELECT * FROM ts")
def table_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


@query(f"WITH RECURSIVE {_STATS} SELECT CAST(length(table_id) % 3 AS INTEGER) AS page_id, CAST(sum(COLUMNS(* EXCLUDE (table_id))) AS BIGINT) FROM ts GROUP BY 1")
def page_totals(spark, sf_dir):
    found = _stats(spark, sf_dir)
    return link.page_totals(found, found.select("table_id", (F.length("table_id") % 3).alias("page_id")))


@query("SELECT count(*) AS entries, count(DISTINCT p_name) AS keys FROM part")
def dictionary_sizes(spark, sf_dir):
    path = scratch(spark, "titles")
    sinks.write_table(table(spark, sf_dir, "part").select(F.col("p_name").alias("title"), F.col("p_partkey").alias("page_id")), path)
    return link.dictionary_sizes(spark.read.parquet(path), "title")


def _changed(spark, sf_dir) -> DataFrame:
    cells = _linked(spark, sf_dir)
    classes = classify.column_classes(tokens.with_cell_type(G.nation_grid(spark, sf_dir), "text"))
    nation = table(spark, sf_dir, "nation")
    acronyms = nation.filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("meaning"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("acronym"))
    aliases = G.kg_entity(spark, sf_dir).select("entity", F.array(F.concat("link", F.lit(" alias a")), F.concat("link", F.lit(" alias b"))).alias("aliases"))
    return augment.augmented(cells, classify.entity_columns(classes), classify.number_columns(classes), acronyms, aliases)


@query(f"""WITH RECURSIVE {_STATS},
ch AS (SELECT table_id, count(*) FILTER (a) AS acro_added, max(CAST(a AS INTEGER)) AS ca, count(*) FILTER (t) AS typos_added, count(DISTINCT col_id) FILTER (t) AS ct, count(*) FILTER (l) AS alias_added, max(CAST(l AS INTEGER)) AS cl FROM (
  SELECT table_id, col_id, col_id = 1 AND TRY_CAST(regexp_extract(text, '[0-9]+') AS INTEGER) % 2 = 0 AND {_chance_sql("acronym")} % 100 + 1 <= {DEFAULT.acronym_percent} AS a,
    col_id < 2 AND {_chance_sql("typo")} % 100 + 1 <= {DEFAULT.typo_percent} AS t, col_id = 1 AND entity LIKE 'Q%' AND {_chance_sql("alias")} % 100 + 1 <= {DEFAULT.alias_percent} AS l FROM linked) GROUP BY 1),
sh AS (SELECT table_id, CAST(max(row_id) + 1 AS BIGINT) AS r, count(*) FILTER (entity <> '') AS m FROM linked GROUP BY 1)
SELECT count(*) AS n_tables, max(r) AS max_rows, CAST(3 AS BIGINT) AS max_cols, min(r) AS min_rows, CAST(3 AS BIGINT) AS min_cols, CAST(sum(r * 3) AS BIGINT) AS cells, CAST(sum(r) AS BIGINT) AS rows, 3 * count(*) AS cols,
  CAST(sum(m) AS BIGINT) AS mentions, count(*) AS lit_cols, 2 * count(*) AS ne_cols, CAST(sum(tot_linked_cell) AS BIGINT) AS tot_linked_cell, CAST(sum(nils) AS BIGINT) AS nils, CAST(sum(types_not_found) AS BIGINT) AS types_not_found,
  CAST(sum(types_found) AS BIGINT) AS types_found, CAST(sum(count_with_header) AS BIGINT) AS count_with_header, CAST(sum(count_with_caption) AS BIGINT) AS count_with_caption, CAST(sum(generic_types) AS BIGINT) AS generic_types,
  CAST(sum(specific_types) AS BIGINT) AS specific_types, CAST(sum(filtered_types) AS BIGINT) AS filtered_types, CAST(sum(found_perfect_types) AS BIGINT) AS found_perfect_types, CAST(sum(tot_cols_with_types) AS BIGINT) AS tot_cols_with_types,
  CAST(sum(count_single_domain) AS BIGINT) AS count_single_domain, CAST(sum(count_multi_domain) AS BIGINT) AS count_multi_domain, CAST(sum(ch.acro_added) AS BIGINT) AS acro_added, CAST(sum(ch.typos_added) AS BIGINT) AS typos_added,
  CAST(0 AS BIGINT) AS approx_added, CAST(sum(ch.alias_added) AS BIGINT) AS alias_added, CAST(sum(ca) AS BIGINT) AS cols_with_acronyms, CAST(sum(ct) AS BIGINT) AS cols_with_typos, CAST(0 AS BIGINT) AS cols_with_approx,
  CAST(sum(cl) AS BIGINT) AS cols_with_aliases, (SELECT count(DISTINCT entity) FROM linked WHERE entity LIKE 'Q%') AS all_entities FROM ts JOIN ch USING (table_id) JOIN sh USING (table_id)""")
def export_counters(spark, sf_dir):
    classes = classify.column_classes(tokens.with_cell_type(G.nation_grid(spark, sf_dir), "text"))
    return stats.export_counters(_linked(spark, sf_dir), _stats(spark, sf_dir), classes, augment.all_change_counts(_changed(spark, sf_dir)))


@query(f"""WITH {PART_GRID},
s1 AS (SELECT table_id, row_id, col_id, text AS kind, CASE WHEN col_id = 1 AND length(text) % 2 = 1 AND {_chance_sql("acronym")} % 100 + 1 <= {DEFAULT.acronym_percent} THEN upper(text[1:3]) ELSE text END AS text FROM cells WHERE col_id < 3),
s2 AS (SELECT table_id, row_id, col_id, kind, CASE WHEN col_id < 2 AND {_chance_sql("typo")} % 100 + 1 <= {DEFAULT.typo_percent} THEN
  text[1:{_chance_sql("typo-at")} % length(text)] || chr(CAST(97 + {_chance_sql("typo-letter")} % 26 AS INTEGER)) || text[{_chance_sql("typo-at")} % length(text) + 2:] ELSE text END AS text FROM s1),
s3 AS (SELECT table_id, row_id, col_id, kind, CASE WHEN col_id = 2 AND {_chance_sql("number")} % 100 + 1 <= {DEFAULT.number_percent} THEN CAST(CAST(text AS BIGINT) + {_chance_sql("number-by")} % 3 - 1 AS VARCHAR) ELSE text END AS text FROM s2)
SELECT table_id, row_id, col_id, CASE WHEN col_id = 1 AND {_chance_sql("alias")} % 100 + 1 <= {DEFAULT.alias_percent} THEN kind || CASE {_chance_sql("alias-at")} % 2 WHEN 0 THEN ' a' ELSE ' b' END ELSE text END AS text FROM s3""")
def augment_all(spark, sf_dir):
    cells = _grid(spark, sf_dir).filter("col_id < 3").withColumn("entity", F.when(F.col("col_id") == 1, F.concat(F.lit("E"), "text")).otherwise(F.lit("")))
    columns = cells.select("table_id", "col_id").distinct()
    kinds = table(spark, sf_dir, "part").select("p_type").distinct()
    acronyms = kinds.filter("length(p_type) % 2 = 1").select(F.col("p_type").alias("meaning"), F.upper(F.substring("p_type", 1, 3)).alias("acronym"))
    aliases = kinds.select(F.concat(F.lit("E"), "p_type").alias("entity"), F.array(F.concat("p_type", F.lit(" a")), F.concat("p_type", F.lit(" b"))).alias("aliases"))
    return augment.augmented(cells, columns.filter("col_id < 2"), columns.filter("col_id = 2"), acronyms, aliases).select("table_id", "row_id", "col_id", "text")


# Writers, read again


@query("""SELECT p_brand AS table_id, p_name || ', "' || p_type || '"' AS col0, CAST(p_size AS VARCHAR) AS col1, CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END AS col2 FROM part""")
def tables_csv(spark, sf_dir):
    name = F.concat("p_name", F.lit(', "'), "p_type", F.lit('"'))
    rows = G._numbered(table(spark, sf_dir, "part"), "p_brand", "p_partkey")
    cells = G._cells(rows, [(name, F.lit("")), (F.col("p_size"), F.lit("")), (F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.lit("")), F.lit(""))])
    path = scratch(spark, "csv")
    sinks.write_tables_csv(cells, path)
    back = spark.read.schema("col0 string, col1 string, col2 string, table_id string").option("header", True).option("escape", '"').csv(path)
    return back.select("table_id", "col0", "col1", F.coalesce("col2", F.lit("")).alias("col2"))


@query(f"""WITH {NATION_GRID} SELECT table_id, CAST(row_id AS VARCHAR) AS "row", CASE WHEN entity = '' THEN 'UNKNOWN' WHEN entity LIKE 'Q%' THEN 'http://www.wikidata.org/entity/' || entity ELSE entity END AS answer FROM linked WHERE col_id = 1""")
def truth_csv(spark, sf_dir):
    path = scratch(spark, "truth")
    sinks.write_truth(export.cea_rows(_linked(spark, sf_dir)), path)
    truth = spark.read.schema("table_id string, row string, col string, answer string").csv(f"{path}/gt")
    targets = spark.read.schema("table_id string, row string, col string").csv(f"{path}/target")
    return truth.join(targets, ["table_id", "row", "col"]).select("table_id", "row", "answer")


@query("""SELECT table_id, CAST(col_1 AS VARCHAR) AS col_1, CAST(col_2 AS VARCHAR) AS col_2, predicate FROM (
WITH r AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1 AS INTEGER) AS row_id FROM lineitem),
v AS (SELECT CAST(l_suppkey AS VARCHAR) AS table_id, row_id, CASE WHEN l_returnflag = 'N' THEN ['P1', 'P2'] ELSE ['P' || CASE WHEN l_linestatus = 'O' THEN '1' ELSE '3' END] END AS ps FROM r),
c AS (SELECT table_id, p, count(*) AS n, min(row_id) AS first FROM (SELECT table_id, row_id, unnest(ps) AS p FROM v) GROUP BY 1, 2)
SELECT table_id, 0 AS col_1, 1 AS col_2, arg_min(p, (-n, first, p)) AS predicate FROM c GROUP BY 1)""")
def relations_csv(spark, sf_dir):
    path = scratch(spark, "cpa")
    sinks.write_relations(QUERIES["pair_relations"](spark, sf_dir), path)
    return spark.read.schema("table_id string, col_1 string, col_2 string, predicate string").csv(path)


@query("SELECT count(DISTINCT o_custkey) AS customers, CAST(count(*) AS BIGINT) AS orders FROM orders")
def counters_json(spark, sf_dir):
    path = scratch(spark, "counters")
    sinks.write_counters(table(spark, sf_dir, "orders").agg(F.count_distinct("o_custkey").alias("customers"), F.count(F.lit(1)).alias("orders")), path)
    return spark.read.schema("customers long, orders long").json(path)


@query("SELECT l_suppkey AS cls, count(*) AS n FROM lineitem GROUP BY 1")
def popularity_json(spark, sf_dir):
    path = scratch(spark, "popular")
    sinks.write_ordered(ontology.popularity(table(spark, sf_dir, "lineitem"), "l_suppkey"), path)
    return spark.read.schema("cls long, n long").json(path)


@query(f"WITH {NATION_GRID} SELECT DISTINCT link, entity FROM linked WHERE entity LIKE 'Q%'")
def link_audit(spark, sf_dir):
    path = scratch(spark, "audit")
    sinks.write_pairs(_linked(spark, sf_dir).filter(F.col("entity").startswith("Q")).select("link", "entity").distinct(), path)
    return spark.read.schema("link string, entity string").json(path)


@query(f"""WITH {PART_GRID} SELECT table_id, count(DISTINCT row_id) AS n_rows, max(text) FILTER (row_id = 1 AND col_id = 1) AS text, max(link) FILTER (row_id = 1 AND col_id = 1) AS link FROM cells GROUP BY 1""")
def table_documents(spark, sf_dir):
    parsed = export.table_documents(_grid(spark, sf_dir)).select("table_id", F.from_json("document", "text array<array<string>>, link array<array<string>>").alias("d"))
    return parsed.select("table_id", F.size("d.text").cast("long").alias("n_rows"), F.get(F.get("d.text", F.lit(1)), F.lit(1)).alias("text"), F.get(F.get("d.link", F.lit(1)), F.lit(1)).alias("link"))


@query(f"""WITH {NATION_GRID}, a AS (SELECT table_id FROM linked WHERE col_id = 1 UNION ALL SELECT p_brand FROM part) SELECT table_id, count(*) AS n FROM a GROUP BY 1""")
def truth_union(spark, sf_dir):
    cea = export.target_rows(export.cea_rows(_linked(spark, sf_dir))).select("table_id")
    return cea.unionByName(_grid(spark, sf_dir).filter("col_id = 0").select("table_id")).groupBy("table_id").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT DISTINCT l_suppkey % 3 AS s, l_partkey AS k FROM lineitem WHERE l_suppkey % 3 < 2) SELECT count(DISTINCT k) AS either, (SELECT count(*) FROM (SELECT k FROM s GROUP BY 1 HAVING count(*) = 2)) AS both FROM s""")
def key_sets(spark, sf_dir):
    keys = lambda i: table(spark, sf_dir, "lineitem").filter(F.col("l_suppkey") % 3 == i).select("l_partkey")
    either, both = keys(0).union(keys(1)).distinct(), keys(0).intersect(keys(1))
    return either.agg(F.count(F.lit(1)).alias("either")).join(both.agg(F.count(F.lit(1)).alias("both")))  # one row each
