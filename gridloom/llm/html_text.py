"""Main text of web pages: two-pass block rules.

A page is cut into blocks at block-level tags. The first pass judges each block
by itself: length, density of stop words and of link text, and what it stands
in (navigation, forms, adverts, comments and the like are out; an article or
main element speaks for a block). Long blocks of sentences are good in any
language; signs of scripts without spaces count threefold. Names of classes put
an element out only if all their parts are known for it, so that a section on
related work stays. Blocks too short or too plain to tell are left open, and the
second pass gives them the label of the nearest decided blocks before and after.

A null page counts as empty and gives the empty text. Truncated pages, unclosed
elements and stray markup are read as far as they go. Every page gives one row;
repeated rows give repeated rows. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Common words of the languages met, by language.
STOP_WORDS = frozenset(
    (
        "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which will with you "
        "au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous ou par pas pour qui que se ses son sur un une vous "
        "als auch auf aus bei das dem den der die ein eine einen einer er es hat ich im ist mit nicht sein sich sie sind und von war wie zu zum zur "
        "al como con del el ella ellos eran fue ha las lo los más muy no para pero por sin su sus una uno y ya"
    ).split()
)
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH, LINKS = 0.15, 0.30, 0.33

_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
_OUT = frozenset("aside button dialog footer form head header iframe menu nav option select svg textarea canvas audio video object map".split())
_RAW = re.compile(r"<(script|style|noscript|template|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.I | re.S)
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^"'<>]|"[^"]*"|'[^']*')*)>|<[!?][^>]*>|</?[a-zA-Z][^<>]*(?:>|\Z)|</[^a-zA-Z>][^>]*>""")
_NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = re.compile(r"[。！？]|[.!?…](?=[\s\"'”’»)\]]|$)")
_DENSE = re.compile("[\u0e00-\u0e7f\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")
#: Words in an element's class, id or role that mark what isn't the article.
_ASIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner breadcrumb breadcrumbs comment comments commentlist disqus respond reply replies responses cookie cookies consent gdpr notice notices alert disclaimer footer header masthead menu menus nav navbar navigation newsletter subscribe signup login popup modal overlay pager pagination related recommended share sharing social sidebar sidebars widget widgets toolbar search complementary contentinfo".split()
)
#: Parts of names that say nothing by themselves.
_FILLER = frozenset("area article articles bar block blog body bottom box button col column container content entry footer form group header icon inner inline item items left link links list main module page panel post posts reader readers right row section site slot text title top unit user wrap wrapper".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def _aside(attributes: str) -> set[str]:
    """Those words of an element's names that mark what isn't the article."""
    found: set[str] = set()
    if "=" in attributes:
        for m in _NAMED.finditer(attributes):
            for name in m[1].strip("\"'").split():
                parts = {x.lower() for x in _PARTS.findall(name)}
                if parts <= _ASIDE | _FILLER:
                    found |= parts & _ASIDE
    return found


def _size(text: str) -> int:
    return len(text) + 2 * len(_DENSE.findall(text))


def blocks(page: str) -> list[tuple[str, bool, bool, float]]:
    """(text, out, within an article, share of its characters in links) of each block with text, in page order."""
    found: list[tuple[str, bool, bool, float]] = []
    parts: list[str] = []
    linked = links = article = 0
    out: list[list] = []  # open elements that put their content out: [name, depth of the same name inside]

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append((text, bool(out), article > 0, min(1.0, linked / len(text))))
        parts, linked = [], 0

    at = 0
    page = _RAW.sub(" ", page)
    for m in _TAG.finditer(page):
        if m.start() > at:
            parts.append(text := page[at : m.start()])
            if links:
                linked += len(text)
        at = m.end()
        if m[2] is None:
            continue
        name, ends = m[2].lower(), bool(m[1])
        if name == "br":
            parts.append(" ")
        elif name == "a":
            links = 0 if ends else 1
        if name in _BLOCK or name in _OUT:
            close()
        if name in _VOID:
            continue
        if ends:
            if out and out[-1][0] == name:
                out[-1][1] -= 1
                if not out[-1][1]:
                    out.pop()
            elif any(x[0] == name for x in out):  # inner elements were left open
                while out[-1][0] != name:
                    out.pop()
                out[-1][1] -= 1
                if not out[-1][1]:
                    out.pop()
            if name in ("article", "main"):
                article = max(0, article - 1)
                out = [x for x in out if x[2] <= article]  # what was open inside ends with it
        else:
            aside = bool(_aside(m[3]) - ({"header"} if article else set()))  # an article may have a heading of its own
            if name in ("article", "main"):
                if not aside and not article:
                    out = []  # a menu or advert that was left open ends here
                article += 1
            if out and out[-1][0] == name:
                out[-1][1] += 1
            elif aside or name in _OUT and not (name == "header" and article):
                if name not in ("html", "body"):
                    close()
                    out.append([name, 1, article])
    rest = page[at:]
    if rest:
        parts.append(rest)
    close()
    return found


def judged(found: list[tuple[str, bool, bool, float]]) -> list[bool]:
    """Whether each block belongs to the main text."""
    first: list[int | None] = []  # 1 good, 0 bad, None open
    for text, out, article, links in found:
        words = _WORD.findall(text.lower())
        stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        size = _size(text)
        if out or links > LINKS or text[0] == "\N{COPYRIGHT SIGN}" and size < LONG:
            first.append(0)
        elif size < SHORT:
            first.append(None if not links else 0 if not article else None)
        elif stops >= STOP_HIGH or stops >= STOP_LOW and (article or size > LONG) or size > LONG and _SENTENCE.search(text):
            first.append(1)
        else:
            first.append(None)
    whole = any(x[2] for x in found)  # the page marks its article
    before, last = [], None
    for (_, out, article, _), x in zip(found, first, strict=True):
        before.append(last)
        if x is not None and (not whole or article and not out):
            last = x
    after, last = [], None
    for (_, out, article, _), x in zip(found[::-1], first[::-1], strict=True):
        after.append(last)
        if x is not None and (not whole or article and not out):
            last = x
    after.reverse()
    kept = []
    for (_, out, article, _), x, a, b in zip(found, first, before, after, strict=True):
        if whole and not article:
            kept.append(False)
        elif x is not None:
            kept.append(bool(x))
        elif whole:
            kept.append(not (a == 0 and b == 0))  # in an article, open blocks need bad ones on both sides to go
        else:
            kept.append(bool(a) and bool(b) or a is None and bool(b) or b is None and bool(a))
    return kept


def main_text(page: str | None) -> tuple[str, int, int]:
    """(main text, blocks, blocks kept) of one page."""
    found = blocks(page or "")
    kept = [x[0] for x, keep in zip(found, judged(found), strict=True) if keep]
    return "\n".join(kept), len(found), len(kept)


def _extracted(batches):
    for b in batches:
        rows = [main_text(x) for x in b.column(b.num_columns - 1).to_pylist()]
        text = pa.array([x[0] for x in rows], pa.string())
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:-1], text, pa.array([len(x[0]) for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int32()), pa.array([x[2] for x in rows], pa.int32())],
            [*b.schema.names[:-1], "text", "n_chars", "n_blocks", "n_kept"],
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, html -> page_id, url, text, n_chars, n_blocks, n_kept; a row for each page, no shuffle."""
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long, n_blocks int, n_kept int")


def op4(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
