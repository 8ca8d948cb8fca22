"""Column functions on cell text. Each is a chain of built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of cell cleaning in order: (pattern, replacement). Java and RE2 read these patterns alike.
CLEAN_STEPS: tuple[tuple[str, str], ...] = (
    (r"</?(sup|ref|span|sub|code|small|poem)(\s[^>]*)?/?>", " "),
    (r"<br\s*/?>", " "),
    (r"<[^>]*>", " "),
    (r"\{\{formatnum:([^{}]*)\}\}", "$1"),
    (r"\{\{[^{}]*\}\}", ""),
    (r"\[\[[^\[\]|]*\|([^\[\]|]*)\]\]", "$1"),
    (r"\[\[([^\[\]|]*)\]\]", "$1"),
    (r"\x{2020}", ""),
    (r"\[\[.*?\]\]|\{\{.*?\}\}", ""),
    (r"\x{00A0}|&nbsp;", " "),
    (r"&amp;", "&"),
    (r"&ndash;|\x{2013}", "-"),
    (r"\{\{\}\}|\[\[\]\]|\(\)|\"|'{2,}", ""),
)
#: Page kinds by what a cell's text contains, the first that fits.
SENTINELS = (("file:", "IMAGE"), ("help:", "HELP_PAGE"), ("wikipedia:wikiproject", "WIKI_PROJ_PAGE"))
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# English stop words (own list).
STOP_WORDS = tuple(
    "a about above after again against all am an and any are as at be because been before being below between both but by can did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its itself just me more most my no nor not now of off on once only or other our out over own same she should so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom why will with you your".split()
)

# Letters that upper() makes two or three letters of and that have one as their upper case; the others of that sort have none.
_SMALL = "ß" + "".join(map(chr, [*range(0x1F80, 0x1F88), *range(0x1F90, 0x1F98), *range(0x1FA0, 0x1FA8), 0x1FB3, 0x1FC3, 0x1FF3]))
_CAPITAL = "ẞ" + "".join(map(chr, [*range(0x1F88, 0x1F90), *range(0x1F98, 0x1FA0), *range(0x1FA8, 0x1FB0), 0x1FBC, 0x1FCC, 0x1FFC]))


def clean_cell(s: Column) -> Column:
    """Text of a cell without markup; kinds of pages as one word. Null stays null."""
    for pattern, replacement in CLEAN_STEPS:
        s = F.regexp_replace(s, pattern, replacement)
    s = F.regexp_replace(s, r"^\s+|\s+$", "")
    out = F
    for part, name in SENTINELS:
        out = out.when(F.contains(F.lower(s), F.lit(part)), F.lit(name))
    return out.otherwise(s)


def normalize_link(s: Column) -> Column:
    """Trimmed, spaces as underscores, first letter in upper case: one letter for one, as in titles of pages and in DuckDB."""
    t = F.replace(F.trim(s), F.lit(" "), F.lit("_"))
    first = F.substring(t, 1, 1)
    capital = F.when(F.length(F.upper(first)) == 1, F.upper(first)).otherwise(F.translate(first, _SMALL, _CAPITAL))
    return F.concat(capital, F.substring(t, F.lit(2), F.length(t)))


def clean_link(s: Column) -> Column:
    """A link into a section isn't kept."""
    return F.when(F.contains(s, F.lit("#")), F.lit("")).otherwise(s)


def header_text(s: Column) -> Column:
    return F.replace(s, F.lit("!"), F.lit(""))


def is_whole_link(labels: Column, plain: Column) -> Column:
    """Whether a cell is its one link: as long as the link's label."""
    return (F.size(labels) == 1) & (F.length(F.get(labels, F.lit(0))) == F.length(plain))


def remove_punctuation(s: Column) -> Column:
    return F.translate(s, PUNCTUATION, "")


def remove_extra_spaces(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def remove_stop_words(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(*STOP_WORDS))


def keep_alphanumerics(s: Column) -> Column:
    return F.regexp_replace(s, "[^a-zA-Z0-9]", " ")


def is_blank(s: Column) -> Column:
    """Empty for the rules on columns and rows."""
    return F.coalesce(s, F.lit("")).isin("", " ", "-", "None")


# Data types of cells with the names of their XSD types.
XSD: dict[str, list[str]] = {
    "geo_coordinates": ["string"],
    "address": ["string"],
    "hex_color": ["string"],
    "url": ["anyURI"],
    "numeric": ["float", "integer", "double"],
    "image": ["string"],
    "credit_card": ["string"],
    "email": ["string"],
    "ip": ["string"],
    "isbn": ["string"],
    "iso8601": ["string"],
    "boolean": ["boolean"],
    "date": ["date"],
    "id": ["string"],
    "currency": ["string"],
    "description": ["string"],
    "iata": ["string"],
}
XSD_LABELS = ("string", "float", "integer", "double", "date", "boolean", "anyURI")
XSD_ROOT = "http://www.w3.org/2001/XMLSchema#"


def xsd_types(datatype: Column) -> Column:
    """Labels of a data type's XSD types; of any other the string's."""
    found = F.create_map(*[F.lit(x) for k, v in XSD.items() for x in (k, ",".join(f"xsd:{t}" for t in v))])
    return F.split(F.coalesce(F.try_element_at(found, datatype), F.lit("xsd:string")), ",")


def xsd_uri(label: Column) -> Column:
    """The address of an XSD label, null for what is none."""
    name = F.regexp_extract(label, "^xsd:(.*)$", 1)
    return F.when(name.isin(*XSD_LABELS), F.concat(F.lit(XSD_ROOT), name))
