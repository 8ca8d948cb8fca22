"""Line dedup by a log-template tree of fixed depth.

A line's tokens lead it down a tree: first by their number, then by the first
DEPTH tokens (all of them, if there are fewer), in which a token with a digit
counts as a variable. In a leaf, a token is fixed if it stands at its place in
the lines of at least min_docs different texts, and a variable field otherwise.
A line's template is its tokens with the variables left open; one field may be
open, or a share of ``variable``, but never all. A template recurs if it stands
in at least min_docs different texts; lines with a recurring template are
dropped in every document, whatever share of it they are. Exact copies of a
document are one text, so they alone make nothing recur.

With ``by_group=True``, as the pipeline has it before its near duplicates go,
near copies count as one as well: texts whose recurring lines are half of them or
more are linked if more than ALIKE of their characters are in common templates,
and a template has to stand in min_docs groups of linked texts instead. Links
are sought under SEEDS weighted minima of a text's templates, each against two
texts of those with the same minimum: pairs of less than about 0.8 can be missed
(then they count as two groups), none is made without its exact overlap. Which
tokens are fixed is counted by texts in either case.

Everything is counting by key with partial sums, and a leaf that holds a third
of all lines is never gathered anywhere. Leaves with too few texts go before
tokens are looked at.

A null text stays null; lines without tokens have no template and stay. Repeated
rows are treated alike. Other columns are kept, whatever their names; n_lines and
n_dropped are added and replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored
from .near_dup import components

DEPTH = 3
MIN_DOCS = 10
VARIABLE = 0.3
ALIKE, SEEDS = 0.5, 6
_OPEN = "<*>"
#: Up to so many leaves or lines (numbers) and texts (a number and some places) are broadcast; more are shuffled.
MOST_LEAVES, MOST_TEXTS = 500_000, 200_000


def _tokens(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(_OPEN)).otherwise(token)


def parsed_lines(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, text -> a row for each line that has a place in the tree: key (of the text), line, place, leaf."""
    lines = docs.filter(F.col("text").isNotNull()).select(F.xxhash64("text").alias("key"), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    tokens = _tokens(F.col("line"))
    lead = F.transform(F.slice(tokens, 1, depth), _masked)
    # A leaf is named by a hash of the tree's path.
    return lines.filter(F.col("line").rlike(r"\S")).withColumn("leaf", F.xxhash64(F.size(tokens), lead))


def _recurring(lines: DataFrame, by: list[str], min_docs: int) -> DataFrame:
    return lines.groupBy(*by).agg(F.count_distinct("key").alias("n_docs")).filter(F.col("n_docs") >= min_docs)


def templates(lines: DataFrame, min_docs: int = MIN_DOCS, variable: float = VARIABLE) -> tuple[DataFrame, DataFrame]:
    """parsed_lines -> (recurring templates: template, n_docs, example; lines with few variables: key, place, template, chars).

    Lines, tokens at their places and templates go by 64-bit hashes, so only
    numbers are shuffled; each different line is taken apart once.
    """
    # Counting needs no lines, only their leaves; the lines are read again for the leaves that are left.
    leaves = small_side(stored(_recurring(lines.select("leaf", "key"), ["leaf"], min_docs).select("leaf")), MOST_LEAVES)
    full = stored(lines.join(leaves, "leaf", "left_semi").withColumn("id", F.xxhash64("leaf", "line")))
    placed = F.posexplode(_tokens(F.col("line"))).alias("at", "token")
    name = F.xxhash64("leaf", "at", "token").alias("name")
    fixed = _recurring(full.select("key", "leaf", placed).select("key", name), ["name"], min_docs).select("name")
    apart = full.groupBy("id").agg(F.first("leaf").alias("leaf"), F.first("line").alias("line"))
    apart = apart.withColumn("n", F.size(_tokens(F.col("line")))).select("id", "n", "leaf", placed).select("id", "n", "leaf", name)
    parts = apart.join(fixed, "name").groupBy("id").agg(F.first("n").alias("n"), F.first("leaf").alias("leaf"), F.sort_array(F.collect_list("name")).alias("names"))
    few = F.col("n") - F.size("names") <= F.greatest(F.lit(1.0), variable * F.col("n"))
    parts = small_side(stored(parts.filter(few).select("id", F.xxhash64("leaf", "names").alias("template"))), MOST_LEAVES)
    with_template = stored(full.select("key", "place", "id", F.length("line").alias("chars")).join(parts, "id").select("key", "place", "template", "chars", "id"))
    found = _recurring(with_template, ["template"], min_docs)
    example = with_template.join(found.select("template"), "template", "left_semi").groupBy("template").agg(F.min("id").alias("id"))
    example = example.join(full.select("id", "line"), "id").groupBy("template").agg(F.min("line").alias("example"))
    return found.join(example, "template"), with_template.drop("id")


def _shared(a: Column, b: Column) -> Column:
    """Characters that two arrays of (template, chars) have in common."""
    held = F.map_from_entries(b)
    return F.aggregate(a, F.lit(0).cast("long"), lambda got, x: got + F.coalesce(F.least(x["chars"], F.try_element_at(held, x["template"])), F.lit(0)))


def copies(docs: DataFrame, recurring: DataFrame, alike: float = ALIKE) -> DataFrame:
    """recurring lines (key, template, chars) -> key, root of the texts that share most of their characters with others."""
    held = recurring.groupBy("key", "template").agg(F.sum("chars").alias("chars")).groupBy("key").agg(F.sum("chars").alias("own"), F.collect_list(F.struct("template", "chars")).alias("held"))
    sizes = docs.filter(F.col("text").isNotNull()).select(F.xxhash64("text").alias("key"), F.length("text").alias("total"))
    # What two texts share beyond a half of both is at least half of either.
    texts = held.join(sizes, "key").filter(F.col("own") >= alike * F.col("total")).dropDuplicates(["key"]).select("key", F.struct("own", "key", "total", "held").alias("text"))

    def least(seed: int) -> Column:
        draw = lambda x: (F.pmod(F.xxhash64(x["template"], F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        return F.array_min(F.transform("text.held", lambda x: F.struct((-F.log(draw(x)) / x["chars"]).alias("at"), x["template"].alias("template"))))["template"]

    bucket = F.array(*[F.xxhash64(F.lit(i), least(i)) for i in range(SEEDS)])
    placed = stored(texts.select("key", "text", F.explode(F.array_distinct(bucket)).alias("bucket")))
    heads = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("text").alias("most"), F.min_by("text", "key").alias("first")).filter("n > 1")
    heads = small_side(stored(heads.select("bucket", F.array_distinct(F.array("most", "first")).alias("heads"))), MOST_TEXTS)
    pairs = placed.join(heads, "bucket").select("key", "text", F.explode("heads").alias("head")).filter(F.col("key") != F.col("head.key"))
    shared = _shared(F.col("text.held"), F.col("head.held"))
    pairs = pairs.withColumn("shared", shared).filter(F.col("shared") > alike * (F.col("text.total") + F.col("head.total") - F.col("shared")))
    return components(pairs.select(F.col("key").alias("a"), F.col("head.key").alias("b")))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, variable: float = VARIABLE, by_group: bool = False) -> DataFrame:
    """For each text that loses lines: key (hash of the text), places (ascending). by_group: copies count as one."""
    _, lines = templates(parsed_lines(docs, depth), min_docs, variable)
    often = lambda x: small_side(stored(_recurring(x, ["template"], min_docs).select("template")), MOST_LEAVES)
    gone = lines.join(often(lines), "template", "left_semi")
    if by_group:
        gone = stored(gone)
        roots = small_side(stored(copies(docs, gone)), MOST_TEXTS)
        counted = gone.join(roots, "key", "left").select("template", F.coalesce("root", "key").alias("key"))
        gone = gone.join(often(counted), "template", "left_semi")
    return gone.groupBy("key").agg(F.sort_array(F.collect_set("place")).alias("places"))


def cut_rows(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, variable: float = VARIABLE, by_group: bool = False) -> DataFrame:
    """docs (text, ...) -> row (all columns of docs), text (without recurring lines), n_lines, n_dropped."""
    gone = small_side(stored(dropped_lines(docs, min_docs, depth, variable, by_group)), MOST_TEXTS)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), F.xxhash64("text").alias("key")).join(gone, "key", "left")
    lines = F.split("row.text", "\n")
    # What stays are the stretches between dropped lines.
    ends = F.concat(F.array(F.lit(-1)), F.col("places"), F.array(F.size(lines)))
    stays = F.flatten(F.transform(F.sequence(F.lit(1), F.size("places") + 1), lambda i: F.slice(lines, F.element_at(ends, i) + 2, F.element_at(ends, i + 1) - F.element_at(ends, i) - 1)))
    cut = F.col("places").isNotNull() & F.col("row.text").isNotNull()
    return rows.select(
        "row",
        F.when(cut, F.array_join(stays, "\n")).otherwise(F.col("row.text")).alias("text"),
        F.when(F.col("row.text").isNotNull(), F.size(lines)).otherwise(0).cast("long").alias("n_lines"),
        F.when(cut, F.size("places")).otherwise(0).cast("long").alias("n_dropped"),
    )


def without_recurring_lines(docs: DataFrame, **settings) -> DataFrame:
    """docs (text, ...) with recurring lines taken out of text; + n_lines, n_dropped."""
    kept = [F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return cut_rows(docs, **settings).select(*kept, "n_lines", "n_dropped")


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_recurring_lines(docs)


def op10_all(spark, sf_dir: str) -> DataFrame:
    """As the pipeline does it, with near copies counted as one. SQL doesn't express the groups."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_recurring_lines(docs, by_group=True)


#: ``{rows}`` stands for a query with doc_id and text and any further columns.
LINES_SQL = rf"""
d AS ({{rows}}),
texts AS (SELECT DISTINCT text FROM d WHERE text IS NOT NULL),
ls AS (
  SELECT text, unnest(range(len(string_split(text, chr(10))))) AS place, unnest(string_split(text, chr(10))) AS line FROM texts
), tk AS (
  SELECT *, regexp_split_to_array(trim(line, ' '), '\s+') AS tokens FROM ls
), lf AS (
  SELECT *, len(tokens) AS n, list_transform(tokens[1:{DEPTH}], lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS lead_tokens
  FROM tk WHERE regexp_matches(line, '\S')
), leaves AS (
  SELECT n, lead_tokens FROM lf GROUP BY n, lead_tokens HAVING count(DISTINCT text) >= {MIN_DOCS}
), fl AS (
  SELECT row_number() OVER () AS line_id, lf.* FROM lf JOIN leaves USING (n, lead_tokens)
), ex AS (
  SELECT line_id, n, lead_tokens, text, unnest(range(n)) AS pos, unnest(tokens) AS token FROM fl
), fixed AS (
  SELECT n, lead_tokens, pos, token FROM ex GROUP BY n, lead_tokens, pos, token HAVING count(DISTINCT text) >= {MIN_DOCS}
), tp AS (
  SELECT e.line_id, list(CASE WHEN f.token IS NULL THEN '<*>' ELSE e.token END ORDER BY e.pos) AS template
  FROM ex e LEFT JOIN fixed f ON e.n = f.n AND e.lead_tokens = f.lead_tokens AND e.pos = f.pos AND e.token = f.token GROUP BY e.line_id
), ft AS (
  SELECT fl.text, fl.place, fl.line, fl.n, fl.lead_tokens, tp.template FROM fl JOIN tp USING (line_id)
  WHERE len(list_filter(tp.template, lambda x: x = '<*>')) <= greatest(1, {VARIABLE} * fl.n) AND len(list_filter(tp.template, lambda x: x <> '<*>')) > 0
), rec AS (
  SELECT n, lead_tokens, template FROM ft GROUP BY n, lead_tokens, template HAVING count(DISTINCT text) >= {MIN_DOCS}
), gone AS (
  SELECT text, place FROM ft JOIN rec USING (n, lead_tokens, template)
), lefts AS (
  SELECT ls.text, coalesce(string_agg(CASE WHEN g.place IS NULL THEN ls.line END, chr(10) ORDER BY ls.place), '') AS left_text,
    count(g.place) AS dropped, count(*) AS n_lines
  FROM ls LEFT JOIN gone g ON g.text = ls.text AND g.place = ls.place GROUP BY ls.text
), cut AS (
  SELECT *, dropped > 0 AS is_cut FROM lefts
)
"""

OP10_SQL = "WITH " + LINES_SQL.format(rows="SELECT doc_id, text FROM documents") + """
SELECT d.doc_id, CASE WHEN c.is_cut THEN c.left_text ELSE d.text END AS text,
  CAST(coalesce(c.n_lines, 0) AS BIGINT) AS n_lines, CAST(CASE WHEN c.is_cut THEN c.dropped ELSE 0 END AS BIGINT) AS n_dropped
FROM d LEFT JOIN cut c ON c.text = d.text
"""
