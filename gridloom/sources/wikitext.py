"""Tables of wiki markup: a small line parser, and its rows as cells.

Understood: {| |} (nested ones are text of their cell), |+ caption, |- rows, ! and
!! headers, | and || cells, attributes before a single bar, rowspan and colspan
(copied), links and templates inside cells. What doesn't parse gives no table.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.config import DEFAULT, Config
from gridloom.functions import text as T
from gridloom.functions.tokens import with_cell_type

_LINK = re.compile(r"\[\[([^\[\]|]*)(?:\|([^\[\]]*))?\]\]")
_SPAN = re.compile(r"(row|col)span\s*=\s*[\"']?\s*(\d+)", re.I)
_HEADING = re.compile(r"^(={2,6})\s*(.*?)\s*\1\s*$", re.M)


def _split(line: str, mark: str) -> list[str]:
    """Parts of a line at a mark outside of links and templates."""
    out, depth, at, i = [], 0, 0, 0
    while i < len(line):
        two = line[i : i + 2]
        if two in ("[[", "{{"):
            depth += 1
            i += 2
        elif two in ("]]", "}}"):
            depth = max(0, depth - 1)
            i += 2
        elif not depth and line.startswith(mark, i):
            out.append(line[at:i])
            i += len(mark)
            at = i
        else:
            i += 1
    return [*out, line[at:]]


def _cell(raw: str) -> tuple[str, int, int]:
    parts = _split(raw, "|")
    attributes = parts[0] if len(parts) > 1 and "=" in parts[0] else ""
    text = "|".join(parts[1:]) if attributes else raw
    spans = {m[1].lower(): max(1, min(1000, int(m[2]))) for m in _SPAN.finditer(attributes)}
    return text.strip(), spans.get("row", 1), spans.get("col", 1)


def parse_tables(wikitext: str) -> list[dict]:
    """{caption, rows: [[(text, is header cell)]]} of each table, in order; spans are copied out."""
    tables: list[dict] = []
    open_: dict | None = None
    nested = 0
    for line in (wikitext or "").split("\n"):
        s = line.strip()
        if open_ is None:
            if s.startswith("{|"):
                open_ = {"caption": "", "rows": [[]]}
            continue
        if s.startswith("{|"):
            nested += 1
        if nested:
            if open_["rows"][-1]:
                open_["rows"][-1][-1][0] += "\n" + line
            nested -= s.startswith("|}")
        elif s.startswith("|}"):
            tables.append(open_)
            open_ = None
        elif s.startswith("|+"):
            open_["caption"] = _cell(s[2:])[0]
        elif s.startswith("|-"):
            open_["rows"].append([])
        elif s.startswith(("!", "|")):
            header = s[0] == "!"
            for piece in [x for y in _split(s[1:], "||") for x in (_split(y, "!!") if header else [y])]:
                open_["rows"][-1].append([piece, header])
        elif open_["rows"][-1]:
            open_["rows"][-1][-1][0] += "\n" + line
    return [{"caption": t["caption"], "rows": _grid([r for r in t["rows"] if r])} for t in tables]


def _grid(rows: list[list]) -> list[list[tuple[str, bool]]]:
    filled: dict[tuple[int, int], tuple[str, bool]] = {}
    for i, row in enumerate(rows):
        j = 0
        for raw, header in row:
            while (i, j) in filled:
                j += 1
            text, down, across = _cell(raw)
            for a in range(i, min(i + down, len(rows))):
                for b in range(j, j + across):
                    filled.setdefault((a, b), (text, header))
            j += across
    width = max((j for _, j in filled), default=-1) + 1
    return [[filled.get((i, j), ("", False)) for j in range(width)] for i in range(len(rows))]


def sections(wikitext: str) -> dict[str, str]:
    """Contents by heading; of equal headings the later."""
    marks = list(_HEADING.finditer(wikitext or ""))
    return {m[2]: wikitext[m.end() : n.start() if n else len(wikitext)].strip() for m, n in zip(marks, [*marks[1:], None], strict=True)}


_RAW = "page_id string, ordinal int, caption string, row_id int, col_id int, raw string, is_header_cell boolean, targets array<string>, labels array<string>"


def _parsed(batches):
    names = [c.split()[0] for c in _RAW.split(", ")]
    for pdf in batches:
        for page_id, text in zip(pdf.page_id, pdf.wikitext, strict=True):
            for k, t in enumerate(parse_tables(text)):  # table by table, so that one batch never holds more
                out = []
                for i, row in enumerate(t["rows"]):
                    for j, (raw, header) in enumerate(row):
                        links = _LINK.findall(raw)
                        out.append((page_id, k, t["caption"], i, j, raw, header, [a for a, _ in links], [b or a for a, b in links]))
                if out:
                    yield pd.DataFrame(out, columns=names)


def table_key(page_id: str, ordinal: int) -> str:
    return hashlib.sha256(f"{page_id}:{ordinal}".encode()).hexdigest()[:16]


def raw_cells(pages: DataFrame) -> DataFrame:
    """page_id, wikitext -> all cells of all tables as they stand, with their links.

    Pages are filtered before they are parsed, as no filter passes through Python.
    """
    raw = pages.filter(F.contains("wikitext", F.lit("wikitable"))).select("page_id", "wikitext").mapInPandas(_parsed, _RAW)
    return raw.withColumn("table_id", F.substring(F.sha2(F.concat_ws(":", "page_id", "ordinal"), 256), 1, 16))


def extract_cells(pages: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """page_id, wikitext -> cells of the tables that pass: within the caps, with links, and min_links in some column."""
    return kept_cells(raw_cells(pages), config)


def kept_cells(raw: DataFrame, config: Config = DEFAULT) -> DataFrame:
    plain = T.clean_cell(F.col("raw"))
    raw = with_cell_type(raw.withColumn("_flat", F.replace("raw", F.lit("\n"), F.lit(""))), "_flat", "raw_type").drop("_flat")
    cells = raw.withColumn("text", plain).withColumn("link", F.when(T.is_whole_link(F.col("labels"), F.col("text")), T.normalize_link(F.get("targets", F.lit(0)))).otherwise(F.lit("")))
    by_table = Window.partitionBy("table_id")
    first_body = F.min(F.when((F.col("col_id") == 0) & ~F.col("is_header_cell"), F.col("row_id"))).over(by_table)
    size = F.max("row_id").over(by_table) + 1
    cells = cells.withColumns({"header_rows": F.coalesce(first_body, size), "n_rows": size, "n_cols": F.max("col_id").over(by_table) + 1})
    cells = cells.withColumn("is_header", F.col("row_id") < F.col("header_rows"))
    cells = cells.withColumn("text", F.when(F.col("is_header"), T.header_text(F.col("text"))).otherwise(F.col("text")))
    cells = cells.filter((F.col("n_rows") <= config.max_rows) & (F.col("n_cols") <= config.max_columns) & (F.col("header_rows") <= config.max_headers))
    from gridloom.operators.filters import link_gate

    return cells.join(link_gate(cells, config.min_links).select("table_id"), "table_id", "left_semi").select("table_id", "page_id", "ordinal", "caption", "row_id", "col_id", "is_header", "text", "link", "raw_type", "n_rows", "n_cols", "header_rows")


def page_context(pages: DataFrame) -> DataFrame:
    """page_id, context: map of section titles to contents."""

    @F.pandas_udf("map<string,string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sections(t or ""))

    return pages.select("page_id", run("wikitext").alias("context"))
