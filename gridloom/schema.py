"""Schemas: the long form used inside, and the page documents at the boundary."""

from __future__ import annotations

CELLS = "table_id string, row_id int, col_id int, is_header boolean, text string, link string, raw_type string"
TABLES = "table_id string, page_id string, ordinal int, caption string, n_rows int, n_cols int, header_rows int"

_GRID = "array<array<string>>"
#: One table of a page document; keys that a stage adds are null before it.
TABLE = (
    f"struct<caption:string, header:{_GRID}, cells:{_GRID}, cell_types:{_GRID}, link:{_GRID}, text:{_GRID}, target_col:array<int>, external_context:map<string,string>, "
    f"cell_types_dict:map<string,map<string,int>>, col_by_row:map<string,array<string>>, tags:map<string,variant>, entity:{_GRID}, types:array<{_GRID}>, "
    "col_types:variant, col_type_perfect:array<string>, single_domain:boolean, stats:map<string,bigint>>"
)
PAGE_DOCUMENT = f"wiki_id string, title string, tables map<string,{TABLE}>"
#: The dump reader's rows: element names as columns, a text with attributes as a struct.
DUMP_PAGE = "title string, id string, ns string, revision struct<id:string, text:struct<_VALUE:string>>"
