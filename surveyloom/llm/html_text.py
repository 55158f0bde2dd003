"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import map_batches

# The commonest words of four languages.
STOP_WORDS = {
    "en": "a an and are as at be been but by can do for from had has have he her his i if in into is it its me my no not of on "
    "or our out she so some than that the their them then there these they this to up was we were what when which who will "
    "with would you your",
    "de": "aber als am an auch auf aus bei bin bis da das dass dem den der des die doch du durch ein eine einem einen einer "
    "er es für hat haben ich ihr im in ist ja kann man mehr mit nach nicht noch nur oder sein sich sie sind so über um und "
    "uns von vor war was wenn wie wir wird zu zum zur",
    "fr": "à au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui mais me même mon "
    "ne nos nous on ou où par pas plus pour qu que qui sa sans se ses si son sont sur ta te tu un une vos vous y été être",
    "es": "a al como con de del donde el ella en entre era es esta este fue ha hay la las le les lo los más me mi muy no nos "
    "o para pero por porque que quien se ser si sin sobre son su sus también te tiene todo tu un una uno y ya yo",
}
STOPS = {language: frozenset(words.split()) for language, words in STOP_WORDS.items()}

# Classes of blocks. A block outside any declared article needs STOPS_LOW of its words to be stop words.
GOOD, NEAR, SHORT, BAD = "good", "near", "short", "bad"
SHORT_CHARS, LONG_CHARS = 70, 200
STOPS_LOW, STOPS_HIGH = 0.12, 0.2
LINKS = 0.3

# Elements without text of the page, elements whose text is never the article's, and elements that end a block.
SILENT = "script style noscript template svg math iframe object canvas audio video head title"
NEVER = frozenset("nav footer aside form menu dialog select button textarea datalist fieldset".split())
ARTICLE = frozenset(("article", "main"))
BREAKS = frozenset(
    "p div section article main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre "
    "figure figcaption address details summary header footer nav aside form fieldset menu dialog body html hr center select "
    "option button textarea".split()
)
EMPTY = frozenset("br hr img input meta link area base col embed source track wbr".split())
# Parts of class names, ids and roles that mark what is not the article.
MARKS = frozenset(
    "nav navbar navigation menu menubar sidebar footer contentinfo complementary ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay comment comments reply replies disqus respond share sharing social related recommended breadcrumb "
    "breadcrumbs newsletter subscribe subscription login signin signup search pagination pager widget toolbar copyright "
    "skip masthead topbar".split()
)
KEEPS = frozenset("with has no without".split())
# Names that go on after such a part without a break ("commentlist"), and the one that then means something else.
STEMS = ("comment", "sidebar", "cookie", "newsletter", "breadcrumb", "advert", "sponsor", "navbar", "footer")
NOT_MARKS = re.compile(r"commentar(?:y|ies)")
HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<silent>" + "|".join(SILENT.split()) + r")(?=[\s/>])[^>]*(?:(?<=/)>|>.*?(?:</(?P=silent)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?"
    r"|<[!?/][^>]*>?"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|lang)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I)
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    article: bool
    barred: bool
    label: str = ""


def barred(tag: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element says of itself that it is not the article."""
    if tag in NEVER or (tag == "header" and not inside_article):
        return True
    if not attributes.strip() or tag in ("html", "body"):
        return False
    for name, *values, hidden in ATTRIBUTE.findall(attributes):
        value = HUMP.sub("-", "".join(values)).lower()
        if hidden or (name.lower() == "style" and "display:none" in value.replace(" ", "")):
            return True
        if name.lower() in ("class", "id", "role") and tag not in ARTICLE | {"p"} or name.lower() == "class" and tag in ARTICLE | {"p"}:
            for one in value.split():
                parts = set(re.split(r"[-_]+", one))
                if not parts & KEEPS and (parts & MARKS or any(p.startswith(STEMS) and not NOT_MARKS.match(p) for p in parts)):
                    return True
                if not inside_article and parts & {"header"} and not parts & {"article", "post", "entry"}:
                    return True
    return False


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; markup, scripts, styles and comments are gone, references decoded."""
    found: list[Block] = []
    parts: list[str] = []
    linked = 0
    link = heading = False
    stack: list[tuple[str, bool, bool]] = []  # tag, inside an article, barred
    opened: Counter[str] = Counter()  # how many elements of each tag are open

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            _, article, bar = stack[-1] if stack else ("", False, False)
            found.append(Block(text, min(linked, len(text)), heading, article, bar))
        parts.clear()
        linked = 0

    def leave() -> str:
        tag = stack.pop()[0]
        opened[tag] -= 1
        return tag

    for token in TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            parts.append(text)
            if link:
                linked += len(" ".join(html.unescape(text).split()))
            continue
        if token["tag"] is None:
            continue
        tag, end = token["tag"].lower(), bool(token["end"])
        if tag == "a":
            link = not end
        elif tag == "br":
            parts.append("\n")
        elif tag in BREAKS:
            close()
            link = False
            heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6") and not end
            if end:
                if opened[tag]:
                    while leave() != tag:
                        pass
            elif tag not in EMPTY:
                if tag in ARTICLE:
                    # Lists and menus left open end here.
                    while stack and stack[-1][0] in ("nav", "ul", "ol", "li", "menu", "p"):
                        leave()
                elif stack and stack[-1][0] == "p":
                    leave()
                _, article, bar = stack[-1] if stack else ("", False, False)
                article = article or tag in ARTICLE
                stack.append((tag, article, bar or barred(tag, token["attributes"], article)))
                opened[tag] += 1
    close()
    return found


def stop_share(text: str, stops: frozenset) -> float:
    words = WORD.findall(text.lower())
    return sum(w in stops for w in words) / len(words) if words else 0.0


def language(page: list[Block], declared: str | None) -> frozenset:
    """The stop words of the declared language, or else of the one with most of them on the page."""
    if declared and declared[:2].lower() in STOPS:
        return STOPS[declared[:2].lower()]
    words = [w for b in page if not b.barred for w in WORD.findall(b.text.lower())]
    return max(STOPS.values(), key=lambda stops: sum(w in stops for w in words))


def first_pass(page: list[Block], stops: frozenset) -> None:
    """Label blocks by what they are: link density, length, stop-word density.

    What a page declares about itself comes first: nothing outside its article
    and nothing barred is good, and inside it a block of links is no menu but
    one that the second pass decides.
    """
    declared = any(b.article and not b.barred for b in page)
    for block in page:
        linked = block.linked > LINKS * len(block.text)
        if block.barred or (declared and not block.article):
            block.label = BAD
        elif linked:
            block.label = SHORT if block.article else BAD
        elif len(block.text) < SHORT_CHARS:
            block.label = BAD if block.linked and not block.article else SHORT
        else:
            share = stop_share(block.text, stops)
            if share >= STOPS_HIGH:
                block.label = GOOD if len(block.text) >= LONG_CHARS else NEAR
            elif share >= STOPS_LOW or block.article:
                block.label = NEAR
            else:
                # Few stop words and no link may be a list of names as well as a menu's text.
                block.label = BAD if block.linked else SHORT


def second_pass(page: list[Block]) -> None:
    """Ambiguous blocks take the label of the nearest decided ones: good between good ones.

    Between a good and a bad one near-good blocks are good and short ones take
    the nearer's label (good if both are as near), headings the next one's.
    Barred blocks are out of the page and say nothing of those beside them.
    Inside a declared article ambiguous blocks are good. On a page without any
    good block the near-good ones are, and without those all that are neither
    barred nor links.
    """
    if not any(b.label == GOOD for b in page):
        for block in page:
            block.label = GOOD if block.label == NEAR else block.label
    decided = [b.label if b.label == GOOD or (b.label == BAD and not b.barred) else None for b in page]
    before, after = decided[:], decided[:]
    gap_before, gap_after = [0] * len(page), [0] * len(page)
    for i in range(1, len(page)):
        if before[i] is None:
            before[i], gap_before[i] = before[i - 1], gap_before[i - 1] + 1
    for i in range(len(page) - 2, -1, -1):
        if after[i] is None:
            after[i], gap_after[i] = after[i + 1], gap_after[i + 1] + 1
    for i, block in enumerate(page):
        if block.label in (GOOD, BAD):
            continue
        sides = {before[i] or BAD, after[i] or BAD}
        if block.article:
            block.label = GOOD
        elif sides == {GOOD}:
            block.label = GOOD
        elif sides == {BAD}:
            block.label = GOOD if block.label == NEAR and len(block.text) >= LONG_CHARS else BAD
        elif block.label == NEAR:
            block.label = GOOD
        elif block.heading:
            block.label = GOOD if after[i] == GOOD else BAD
        else:
            nearer = before[i] if before[i] and (gap_before[i] < gap_after[i] or not after[i]) else after[i]
            if gap_before[i] == gap_after[i]:
                nearer = GOOD
            block.label = nearer or BAD
    if not any(b.label == GOOD for b in page):
        for block in page:
            if not block.barred and block.linked <= LINKS * len(block.text):
                block.label = GOOD


def main_text(page: str) -> str:
    found = blocks(page)
    lang = re.search(r"<html[^>]*\blang\s*=\s*[\"']?([a-zA-Z]{2})", page)
    first_pass(found, language(found, lang and lang[1]))
    second_pass(found)
    return " ".join(b.text for b in found if b.label == GOOD)


def extract(df: DataFrame, ident: str = "page_id", page: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(ident, *keep, text, n_chars) for every row of ``df``.

    Null and empty pages, and pages without an article, have an empty text;
    null ids and repeated rows come back as they are; an empty table gives no
    rows. Other columns are not looked at. Unclosed elements and truncated pages
    are read to their end.
    """
    columns = [ident, *keep]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p or "") for p in batch.column(len(columns)).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[: len(columns)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            [*(f"c{i}" for i in range(len(columns))), "text", "n_chars"],
        )

    kinds = ", ".join(f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(columns))
    narrow = df.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)), F.col(page).alias("page"))
    out = map_batches(narrow, one, f"{kinds}, text string, n_chars long")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)), "text", "n_chars")
