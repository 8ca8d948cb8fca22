"""Golden cases of the rules, the parser, the readers and the linking."""

import bz2
import gzip
import json
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.functions import text as T
from gridloom.functions import tokens
from gridloom.operators import augment, classify, coltypes, export, filters, link, ontology, relations, stats
from gridloom.sources import dumps, sinks, wikitext


def grid(spark, rows, headers=0, links=None):
    """One table from rows of texts."""
    cells = [("t", i, j, i < headers, x, (links or {}).get((i, j), ""), "") for i, r in enumerate(rows) for j, x in enumerate(r)]
    return spark.createDataFrame(cells, "table_id string, row_id int, col_id int, is_header boolean, text string, link string, raw_type string")


def ids(df, key):
    return sorted(r[key] for r in df.collect())


@pytest.mark.parametrize(
    "text, kind",
    [("", ""), ("  ", "SYMBOL"), ("$5", "NUMBER"), ("1st", "NUMBER"), ("21st", "NUMBER"), ("5 km", "STRING"), ("10 am", "DATE"), ("1/2/2020", "DATE"), ("—", "STRING"), ("...", "SYMBOL"), ("☀", "SYMBOL"),
     ("\U0001f600", "STRING"), ("1,234.5", "NUMBER"), ("3/4", "NUMBER"), ("don't", "STRING"), ("a@b.org", "STRING"), ('"quoted"', "STRING"), ("Köln", "STRING"), ("कख", "STRING"), ("€", "NUMBER"), (None, "")],
)
def test_cell_types(spark, text, kind):
    df = spark.createDataFrame([(text,)], "text string")
    assert tokens.with_cell_type(df, "text").first().cell_type == kind


def test_tokens():
    assert tokens.tokenize("Don't mail x@y.org at 10 am, it's 5$ #tag!") == [
        ("Don", "word"), ("'", "punctuation"), ("t", "word"), ("mail", "word"), ("x@y.org", "email"), ("at", "word"), ("10 am", "time"), (",", "punctuation"),
        ("it", "word"), ("'s", "word"), ("5", "number"), ("$", "currency"), ("#tag", "hash_tag"), ("!", "punctuation"),
    ]
    assert tokens.tokenize("dog's dogs' \U0001f600") == [("dog", "word"), ("'s", "word"), ("dogs", "word"), ("'", "word"), ("\U0001f600", "alien")]


@pytest.mark.parametrize(
    "word, parts",
    [("can't", "ca n't"), ("won't", "wo n't"), ("i'd've", "i 'd 've"), ("dog's", "dog 's"), ("dogs'", "dogs '"), ("o'clock", "o ' clock"), ("café's", "café ' s"), ("plain", "plain"), ("Can't", "Can ' t")],
)
def test_apostrophes(word, parts):
    assert [v for v, _ in tokens.split_word(word)] == parts.split()
    assert [v for v, _ in tokens.tokenize(word)] == parts.split()


def test_rendered_tokens(spark):
    df = tokens.with_tokens(spark.createDataFrame([("Paris, 3",)], "t string"), "t")
    assert df.select(tokens.rendered(F.col("tokens")).alias("r")).first().r == ["Paris[word]", ",[punctuation]", "3[number]"]


def test_token_column_and_frequent_tag(spark):
    df = tokens.with_tokens(spark.createDataFrame([("a b 1",), (None,)], "t string"), "t")
    rows = df.withColumn("tag", tokens.most_frequent_tag(F.col("tokens"))).collect()
    assert [r.tag for r in rows] == ["word", None] and [x.value for x in rows[0].tokens] == ["a", "b", "1"]


@pytest.mark.parametrize(
    "raw, clean",
    [("a<br>b", "a b"), ("<b>x</b>", "x"), ("{{formatnum:123}} km", "123 km"), ("[[Paris|the city]]", "the city"), ("[[Paris]]", "Paris"), ("x†", "x"), ("a&nbsp;b&amp;c&ndash;d", "a b&c-d"), ("()''bold''", "bold"),
     ("[[File:x.jpg]]", "IMAGE"), ("Help:me", "HELP_PAGE"), ("Wikipedia:WikiProject X", "WIKI_PROJ_PAGE"), ("{{flag}} x", "x")],
)
def test_clean_cell(spark, raw, clean):
    assert spark.createDataFrame([(raw,)], "t string").select(T.clean_cell(F.col("t")).alias("t")).first().t == clean


def test_links(spark):
    r = spark.createDataFrame([(" new york ", "a#b", "Q")], "a string, b string, c string").select(T.normalize_link(F.col("a")), T.clean_link(F.col("b")), T.clean_link(F.col("c"))).first()
    assert list(r) == ["New_york", "", "Q"]


def test_column_rules(spark):
    rows = [["h", "h", "IMAGE", "h"], ["x", "", "a", "Q1"], ["x", "b", "b", "Q22"]]
    g = grid(spark, rows, headers=1)
    assert ids(filters.sentinel_columns(g), "col_id") == [2]
    assert ids(filters.sparse_columns(g), "col_id") == [1]  # exactly half is enough
    assert ids(filters.constant_columns(g), "col_id") == [0]
    assert ids(filters.id_columns(g), "col_id") == [3]
    assert ids(filters.removed_columns(g), "col_id") == [0, 1, 2, 3]
    assert ids(filters.empty_body_columns(grid(spark, [["a", "b"]], headers=1)), "col_id") == [0, 1]


def test_row_rules(spark):
    g = grid(spark, [["a", "b"], ["", "x"], ["y", "y"], ["Total", "subtotal"], ["None", "none"], ["c", "d"]])
    assert ids(filters.sparse_rows(g), "row_id") == [1, 4]
    assert ids(filters.constant_rows(g), "row_id") == [2]
    assert ids(filters.total_rows(g), "row_id") == [3]
    assert ids(filters.none_rows(g), "row_id") == [4]
    left = filters.reindexed(g, filters.removed_rows(g), "row_id")
    assert sorted((r.orig_row_id, r.row_id) for r in left.filter("col_id = 0").collect()) == [(0, 0), (5, 1)]


def test_filtering_is_idempotent_and_gates(spark):
    rows = [[f"n{i}", f"w{i % 2} x{i}", "same"] for i in range(6)]
    g = grid(spark, rows, links={(i, 0): "L#x" if i == 0 else f"L{i}" for i in range(6)})
    once = filters.filtered(g)
    assert {(r.row_id, r.col_id, r.text) for r in once.collect()} == {(i, j, rows[i][j]) for i in range(6) for j in range(2)}
    again = filters.filtered(once.drop("orig_row_id", "orig_col_id"))
    assert {(r.row_id, r.col_id, r.text, r.link) for r in again.collect()} == {(r.row_id, r.col_id, r.text, r.link) for r in once.collect()}
    assert once.filter("row_id = 0 AND col_id = 0").first().link == ""
    few = grid(spark, rows, links={(0, 0): "L", (1, 0): "L"})
    assert filters.filtered(few).count() == 0


def test_first_word_rule_is_optional(spark):
    g = grid(spark, [["The cat", "a b"], ["The dog", "c d"]])
    assert sorted(r.text for r in filters.without_repeated_first_word(g).collect()) == ["a b", "c d", "cat", "dog"]


def test_classification_boundaries(spark):
    rows = [["1", "one two three four five six", "one two three four five six seven"]] * 3 + [["a", "one two three four five six", "one two three four five six seven"]] * 2
    got = {r.col_id: r for r in classify.column_classes(tokens.with_cell_type(grid(spark, rows), "text")).collect()}
    assert got[0].literal_share == 0.6 and got[0].col_type == "NE"  # not above 0.60
    assert got[1].mean_words == 6 and got[1].col_type == "NE" and got[2].col_type == "LIT" and got[2].lit_type == "STRING"
    tie = classify.column_classes(tokens.with_cell_type(grid(spark, [["1"], ["1/1/2020"], ["2/2/2020"], ["2"]]), "text")).first()
    assert (tie.col_type, tie.lit_type) == ("LIT", "NUMBER")  # of equals the one seen first


def test_linking_outcomes(spark):
    links = {(0, 0): "Paris", (1, 0): "Known", (2, 0): "Nowhere", (3, 0): ":d:Q5"}
    kg = spark.createDataFrame([("Paris", "Q90")], "link string, entity string")
    titles = spark.createDataFrame([("Known", "1")], "title string, page_id string")
    cells = link.with_entities(grid(spark, [["a"], ["b"], ["c"], ["Q5"], ["e"]], links=links), kg, titles)
    assert {r.row_id: r.entity for r in cells.collect()} == {0: "Q90", 1: "", 2: "NIL", 3: "Q5", 4: ""}
    typed = link.with_types(cells, spark.createDataFrame([("Q90", ["Q515"])], "entity string, types array<string>"))
    captions = spark.createDataFrame([("t", "None")], "table_id string, caption string")
    top = spark.createDataFrame([("Q1",)], "type string")
    depth = spark.createDataFrame([(515, 2, 1)], "cls long, depth int, n_ancestors long")
    s = link.table_stats(typed, captions, top, depth).first()
    assert (s.tot_linked_cell, s.entities_found, s.entities_not_found, s.nils, s.types_found, s.types_not_found) == (4, 2, 2, 1, 1, 3)
    assert (s.tot_cells, s.count_with_caption, s.generic_types, s.specific_types, s.filtered_types, s.tot_cols_with_types, s.count_single_domain) == (5, 0, 0, 1, 0, 1, 1)
    assert len(s) == 21
    assert ids(filters.rows_with_ids(cells), "row_id") == [3]
    assert ids(link.entity_keys(cells, kg), "entity") == ["Q5", "Q90"]
    assert {(r.row, r.answer) for r in export.cea_rows(cells).collect()} == {(0, export.ENTITY_ROOT + "Q90"), (1, "UNKNOWN"), (2, "NIL"), (3, export.ENTITY_ROOT + "Q5"), (4, "UNKNOWN")}


def test_closure_of_cycles_and_shortcuts(spark):
    closed = ontology.closure(spark.createDataFrame([(1, 2), (2, 1), (3, 1), (5, 4), (4, 3), (5, 3)], "sub long, sup long"))
    got = {(r.sub, r.sup): r.level for r in closed.collect()}
    assert got[1, 1] == 2 and got[3, 2] == 2 and got[5, 3] == 1 and got[5, 1] == 2
    depth = {r.cls: r.depth for r in ontology.depths(closed).collect()}
    assert depth[1] == 2 and depth[5] == 4
    loop = ontology.depths(ontology.closure(spark.createDataFrame([(7, 7)], "sub long, sup long")))
    assert loop.first().depth == 1


def test_thresholds(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "n long").select(coltypes.threshold(F.col("n")).alias("t"))
    got = [r.t for r in df.collect()]
    assert got[1] is None and [round(x, 6) for x in (got[0], got[2], got[3])] == [0.2, 1.0, 0.8]


def test_relations_tie_goes_to_the_first(spark):
    cells = spark.createDataFrame([("t", 0, 0, "Q1"), ("t", 0, 1, "Q2"), ("t", 1, 0, "Q3"), ("t", 1, 1, "Q4"), ("t", 1, 2, "NIL"), ("t", 2, 0, "")], "table_id string, row_id int, col_id int, entity string")
    kg = spark.createDataFrame([("Q1", "Q2", ["P9"]), ("Q3", "Q4", ["P1"])], "e1 string, e2 string, predicates array<string>")
    pairs = relations.column_pairs(cells)
    assert pairs.count() == 2
    assert relations.majority_predicates(pairs, kg).first().predicate == "P9"


def test_changes_are_deterministic_and_counted(spark):
    g = grid(spark, [[f"name {i}", str(i)] for i in range(200)])
    ne, num = (spark.createDataFrame([("t", c)], "table_id string, col_id int") for c in (0, 1))
    a = augment.add_typos(g, ne)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in augment.add_typos(g.repartition(5), ne).collect()}
    n = augment.change_counts(a).first()
    assert 100 < n.n_changed < 180 and n.n_columns == 1
    b = {(r.row_id): r for r in augment.approximate_numbers(g, num, Config(number_percent=100)).filter("col_id = 1").collect()}
    assert all(abs(int(r.text) - i) <= 1 for i, r in b.items())


DUMP = """<mediawiki><page><title>Big cities</title><ns>0</ns><id>12</id><revision><id>99</id><text xml:space="preserve">{| class="wikitable"
|+ Cities
! City !! Country
|-
| [[Paris]] || rowspan="2" | [[France]]
|-
| [[Lyon]]
|-
| [[Berlin|Berlin]] || Germany &lt;br&gt; x
|}
== History ==
old
== History ==
new</text></revision></page><page><title>none</title><ns>0</ns><id>13</id><revision><id>98</id><text>no table</text></revision></page></mediawiki>"""


def test_dump_to_cells(spark, tmp_path):
    path = str(tmp_path / "dump.xml.bz2")
    with bz2.open(path, "wt") as f:
        f.write(DUMP)
    pages = dumps.read_dump(spark, path)
    assert [(r.page_id, r.title) for r in pages.orderBy("page_id").collect()] == [("12", "Big cities"), ("13", "none")]
    assert dumps.read_titles(spark, path).filter("page_id = '12'").first().title == "Big_cities"
    cells = wikitext.extract_cells(pages)
    got = {(r.row_id, r.col_id): (r.text, r.link, r.is_header) for r in cells.collect()}
    assert got == {
        (0, 0): ("City", "", True), (0, 1): ("Country", "", True), (1, 0): ("Paris", "Paris", False), (1, 1): ("France", "France", False),
        (2, 0): ("Lyon", "Lyon", False), (2, 1): ("France", "France", False), (3, 0): ("Berlin", "Berlin", False), (3, 1): ("Germany   x", "", False),
    }
    assert cells.first().caption == "Cities" and cells.first().table_id == wikitext.table_key("12", 0)
    assert wikitext.page_context(pages.filter("page_id = '12'")).first().context == {"History": "new"}
    n = stats.extract_counters(pages, wikitext.raw_cells(pages), cells).first()
    assert tuple(n) == (2, 1, 1, 1, 4, 2)
    assert wikitext.extract_cells(pages, Config(max_columns=1)).count() == 0


def test_page_documents_triples_and_lookups(spark, tmp_path):
    (tmp_path / "wiki").mkdir()
    doc = {"wiki_id": "1", "title": "t", "tables": {"K": {"caption": "c", "text": [["a"]], "tags": {"0": {"tags": {"col_type": "NE"}}, "header": True}}}}
    with gzip.open(tmp_path / "wiki/diz_1.json.gz", "wt") as f:
        json.dump(doc, f)
    (tmp_path / "wiki/other.json").write_text("{}")
    tables = dumps.page_tables(dumps.read_page_documents(spark, str(tmp_path / "wiki")))
    assert [(r.table_id, r.table.text) for r in tables.select("table_id", "table").collect()] == [("K", [["a"]])]
    with gzip.open(tmp_path / "p.nt.gz", "wt") as f:
        f.write("<http://x/entity/Q5> <http://x/P279> <http://x/entity/Q7> .\n<http://x/entity/Q6> <http://x/P279> <http://x/L> .\n")
    good, errors = dumps.split_bad_ids(dumps.read_triples(spark, str(tmp_path / "p.nt.gz")))
    assert [tuple(r) for r in good.collect()] == [(5, 7)] and errors.first().errors == 1
    (tmp_path / "bad.nt").write_text("<a> <b> <c>\n")
    with pytest.raises(Exception, match="bad triple"):
        dumps.read_triples(spark, str(tmp_path / "bad.nt")).collect()
    loose = dumps.read_triples(spark, str(tmp_path / "bad.nt"), strict=False)
    assert dumps.split_bad_ids(loose)[1].first().errors == 1
    items = spark.createDataFrame([("NASA – National Agency (x); more",), ("no dash",)], "item string")
    assert [tuple(r) for r in dumps.acronym_pairs(items).collect()] == [("NASA", "national agency")]
    labels = spark.createDataFrame([("Q1", "Paris"), ("Q2", "Parys")], "entity string, label string")
    names = spark.createDataFrame([("paris",)], "name string")
    assert ids(dumps.lookup_names(names, labels), "entity") == ["Q1"] and ids(dumps.lookup_names(names, labels, 10, 1), "entity") == ["Q1", "Q2"]
    with pytest.raises(ValueError):
        dumps.lookup(names, "unknown", labels)


def test_settings():
    got = Config.from_settings({"MAXLINES": "7", "ADDTYPOS": "", "ADDALIASES": "True", "ADDTYPOSPERCENT": "30", "OTHER": "x"})
    assert got == Config(max_rows=7, typos=False, typo_percent=30) and Config.from_settings({}) == Config()


def test_pages_without_id_are_set_apart(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<d><page><title>a</title><id>1</id></page><page><title>b</title></page></d>")
    good, bad = dumps.quarantined(dumps.read_dump(spark, str(tmp_path / "d.xml"), strict=False), "page_id", "title")
    assert [r.title for r in good.collect()] == ["a"] and [r.title for r in bad.collect()] == ["b"]


def test_larger_hierarchies_are_joined_level_by_level(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (5, 4), (4, 3), (5, 3)], "sub long, sup long")
    assert {tuple(r) for r in ontology.closure(edges).collect()} == {tuple(r) for r in ontology.closure(edges, 0).collect()}


def test_relation_never_broadcasts_the_closure(spark):
    closed = ontology.closure(spark.createDataFrame([(2, 1), (3, 1), (4, 2)], "sub long, sup long"))
    pairs = spark.createDataFrame([(4, 1), (1, 4), (2, 2), (4, 3)], "a long, b long")
    out = ontology.relation(pairs, closed, ontology.depths(closed))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BroadcastHashJoin \[a#\d+L, b#\d+L\]", plan)
    assert {tuple(r) for r in out.collect()} == {(4, 1, 1), (1, 4, -1), (2, 2, 0), (4, 3, 1)}


def test_sinks(spark, tmp_path):
    g = grid(spark, [["h", "h2"], ["a", "b"], ["c", "d"]], headers=1)
    sinks.write_tables_csv(g, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert sorted((r.col0, r.col1) for r in back.collect()) == [("a", "b"), ("c", "d")]
    doc = json.loads(export.table_documents(g).first().document)
    assert doc["text"] == [["h", "h2"], ["a", "b"], ["c", "d"]]
    sinks.write_truth(spark.createDataFrame([("t", 0, "Q1")], "table_id string, col int, answer string"), str(tmp_path / "cta"))
    assert [list(r) for r in spark.read.csv(str(tmp_path / "cta/target")).collect()] == [["t", "0"]]


def test_titles_later_file_wins(spark):
    t = spark.createDataFrame([("A", "1", "f1"), ("A", "2", "f2"), ("A", "3", "f2"), ("B", "4", "f1")], "title string, page_id string, source_file string")
    assert {(r.title, r.page_id) for r in link.merged_titles(t).collect()} == {("A", "3"), ("B", "4")}


def test_titles_first_letter_as_in_sql(spark):
    # Letters whose upper case came with Unicode 16, which Spark has and DuckDB hasn't, are left out.
    new = {"ƛ", "ɤ", "\u1c8a", "\ua7cd", "\ua7db", *map(chr, range(0x10D70, 0x10D86))}
    letters = [c for c in map(chr, [*range(0x21, 0xD800), *range(0xE000, 0x11000), *range(0x1E900, 0x1E944)]) if c not in new]
    df = spark.createDataFrame([(c + "a b",) for c in [*letters, ""]], "t string")
    sql = duckdb.connect().execute("SELECT t, upper(t[1]) || replace(t[2:], ' ', '_') FROM (SELECT unnest(?) AS t)", [[c + "a b" for c in letters]])
    want = dict(sql.fetchall())
    got = {r.t: r.n for r in df.select("t", T.normalize_link(F.col("t")).alias("n")).collect()}
    assert got.pop("a b") == "A_b"
    assert got["ßa b"] == "ẞa_b"
    assert {k: (v, want[k]) for k, v in got.items() if v != want[k]} == {}


def test_streaming_extraction(spark, tmp_path):
    from gridloom.streaming.pages import extract_stream

    (tmp_path / "in").mkdir()
    text = "{| class=wikitable\n| [[A]]\n|-\n| [[B]]\n|-\n| [[C]]\n|}"
    (tmp_path / "in/a.json").write_text(json.dumps({"page_id": "1", "wikitext": text}))
    seen = []
    extract_stream(spark, str(tmp_path / "in"), lambda df, n: seen.extend(r.text for r in df.collect()), str(tmp_path / "cp")).awaitTermination(60)
    assert sorted(seen) == ["A", "B", "C"]
