"""Main text of web pages by the distribution of text over lines.

Markup is stripped so that every block of a page becomes a line. Lines have a weight: the
length of their text outside links. Boilerplate (menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts) weighs nothing. Where a page declares its article, a line inside
weighs ``DECLARED`` times as much, and at least as a usual line of the page does; there a class
name marks boilerplate only if it says nothing else, and never on headings, paragraphs, sections
and inline elements. Weights are summed over windows of lines; the main text reaches from the first
surge, where the sums rise above a threshold, to the last dive, where they fall below it. The
threshold is a fixed share of a window of the page's usual lines, so short articles are
found as well as long ones and one huge paragraph does not hide the others. Where most lines are
declared they set the threshold, and lines beside them must reach it by themselves; a short teaser
that is declared does not hide a long text that is not.

Text is whole: character references are decoded, white space within a block becomes one
blank, blocks are joined by a line feed, nothing else is cut. Tags are read as browsers do: a quote
opens a value only right after ``=``, an unquoted value ends at white space or ``>``. Null and
empty pages give an empty text; repeated pages give equal texts. Malformed markup never fails: an
element that is not closed ends with the page, except that boilerplate without an end stops at the
next article, heading or paragraph, a head at the first tag or text of the body, of buttons,
lists of options, embedded and replaced elements without an end only the tag goes, and a quote
without an end is a character of a name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patronlens.llm.textbytes import pieces

WINDOW = 3
SURGE_SHARE = 0.2
FULL_LINE = 100
DECLARED = 8

#: What stands in a tag after its name.
_ATTRIBUTES = (
    r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+"
)

#: Elements that hold no text of the page, but do not run to its end when they are not closed.
_UNSEEN = "noscript|template|svg|iframe|select|button|object"
#: The first of these ends a head that is not closed before.
_BODY = (
    "body|address|article|aside|blockquote|center|dd|details|dialog|dir|div|dl|dt|fieldset|figure|footer|form|h[1-6]|"
    "header|hr|li|main|menu|nav|ol|p|pre|section|table|ul"
)


#: Comments, scripts and closed elements in a head.
_METADATA = "|".join(
    [
        r"<!--.*?(?:-->|\Z)",
        *(rf"<{name}\b[^>]*>.*?(?:</{name}\s*>|\Z)" for name in ("script", "style")),
        *(rf"<{n}\b[^>]*+>[^<]*+(?:<(?!/?{n}\b)[^<]*+)*+</{n}\s*>" for n in ("title", "noscript", "template")),
    ]
)
#: A head up to its closing tag, or where that is absent or behind the start of the body, as far as
#: there is metadata only.
_HEAD = (
    rf"<head\b[^>]*>(?:(?:{_METADATA}|[^<]++|<(?!/?(?:head|body)\b|(?:{_BODY})\b))*+</head\s*>"
    rf"|(?:{_METADATA}|\s++|<[!?][^>]*>|</?(?:meta|link|base|title|noscript|template)\b[^>]*>)*+)"
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|textarea)\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|{_HEAD}"
    rf"|<(?P<unseen>{_UNSEEN})\b(?P<inside>{_ATTRIBUTES})>"
    rf"|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*+)(?P<rest>{_ATTRIBUTES})>"
    r"|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(
    r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+)))?+"
)

#: Element names and words in class names that mark boilerplate.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small "
    "span strike strong sub sup time tt u var wbr nobr".split()
)
UNSEEN = frozenset(_UNSEEN.split("|"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
ARTICLE = frozenset("article main".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored sponsors promo promotion "
    "cookie cookies consent gdpr notice notices alert disclaimer sidebar aside rail menu menus nav navbar navigation "
    "topnav subnav breadcrumb breadcrumbs footer foot masthead topbar toolbar comment comments commentlist discussion "
    "disqus replies reply respond responses share sharing social related recommended recommendations newsletter "
    "subscribe subscription signup login popup modal overlay widget widgets pagination pager skip search".split()
)
#: Inside an article a class must consist of the first and of words that only say where or how.
ARTICLE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot cookie cookies gdpr sidebar navbar topnav subnav "
    "breadcrumb breadcrumbs comments commentlist disqus newsletter share sharing sponsored pagination pager".split()
)
_LAYOUT_WORDS = frozenset(
    "area bar banner block bottom box button buttons consent container content desktop footer form google header "
    "icon icons inline inner item left link links list main message middle mobile modal notice outer overlay page "
    "panel popup post right section signup site slot social sticky this tools top unit user widget wrap wrapper".split()
)
_KEPT_IN_ARTICLE = INLINE | frozenset("h1 h2 h3 h4 h5 h6 p section".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
_STARTS_TEXT = frozenset("article main h1 h2 p section".split())


@dataclass(slots=True)
class Line:
    """One block: its text, how much of it lies outside links, and where it lies."""

    text: str
    weight: int
    article: bool
    boilerplate: bool


def _attributes(rest: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(rest)}


def _label_words(label: str) -> list[str]:
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", label).lower())


def _is_boilerplate(name: str, rest: str, in_article: bool, innermost: bool) -> bool:
    if name in BOILERPLATE or (name == "header" and not in_article):
        return True
    if not rest or name in ("html", "body", "main"):
        return False
    found = _attributes(rest)
    if "hidden" in found or found.get("aria-hidden") == "true":
        return True
    if found.get("role", "").lower() in BOILERPLATE_ROLES:
        return True
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    if innermost:
        if name in _KEPT_IN_ARTICLE:
            return False
        labels = [set(_label_words(label)) for label in found.get("class", "").split()]
        return any(words & ARTICLE_WORDS and words <= ARTICLE_WORDS | _LAYOUT_WORDS for words in labels)
    words = _label_words(f"{found.get('class', '')} {found.get('id', '')}")
    return ("header" in words and not in_article) or not BOILERPLATE_WORDS.isdisjoint(words)


def _is_article(name: str, rest: str) -> bool:
    if name in ARTICLE:
        return True
    if not rest or ("itemprop" not in rest and "role" not in rest):
        return False
    found = _attributes(rest)
    return found.get("itemprop") == "articleBody" or found.get("role", "").lower() in ("main", "article")


def _ends(tokens: list[tuple[str, bool, str]]) -> dict[int, int]:
    """For each opening tag the number of the tag that closes it, if any."""
    open_tags: dict[str, list[int]] = {}
    ends = {}
    for i, (name, closes, _) in enumerate(tokens):
        if closes:
            if open_tags.get(name):
                ends[open_tags[name].pop()] = i
        elif name not in VOID:
            open_tags.setdefault(name, []).append(i)
    return ends


def _seen(tokens: list[tuple[str, bool, str]], gaps: list[str]) -> tuple[list[tuple[str, bool, str]], list[str]]:
    """Tokens, and the text before each, with every closed unseen element as one token without a
    name; of unclosed ones only the tag becomes so."""
    if not any(name in UNSEEN for name, _, _ in tokens):
        return tokens, gaps
    ends = _ends([t if t[0] in UNSEEN else ("", True, "") for t in tokens])
    kept, before, i = [], [], 0
    while i < len(tokens):
        before.append(gaps[i])
        unseen = tokens[i][0] in UNSEEN and not tokens[i][1]
        kept.append(("", False, "") if unseen else tokens[i])
        i = ends.get(i, i) + 1
    return kept, [*before, gaps[i]]


def lines(page: str) -> list[Line]:
    """The blocks of a page in order, boilerplate and empty ones included as such."""
    tokens: list[tuple[str, bool, str]] = []
    gaps, at = [], 0
    for found in _TOKEN.finditer(page):
        gaps.append(page[at : found.start()])
        at = found.end()
        name = (found["name"] or found["unseen"] or "").lower()
        if name in ("svg", "iframe") and (found["inside"] or "").endswith("/"):
            name = ""
        tokens.append((name, found["close"] == "/", found["rest"] or ""))
    gaps.append(page[at:])
    tokens, gaps = _seen(tokens, gaps)
    ends = _ends(tokens)
    articles = [i for i, (name, closes, rest) in enumerate(tokens) if not closes and _is_article(name, rest)]
    out: list[Line] = []
    parts: list[str] = []
    linked = 0
    article_until, inner_until, drop_until, link_until = -1, -1, -1, -1

    def flush(i: int) -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            dropped = i <= drop_until
            out.append(Line(text, max(0, len(text) - linked), i <= article_until, dropped))
        parts.clear()
        linked = 0

    for i, gap in enumerate(gaps):
        if gap:
            decoded = html.unescape(gap)
            parts.append(decoded)
            if i <= link_until:
                linked += len(decoded.strip())
        if i == len(tokens):
            break
        name, closes, rest = tokens[i]
        if not name:
            continue
        if name not in INLINE:
            flush(i)
        if closes:
            continue
        end = ends.get(i, len(tokens))
        if name == "a":
            link_until = max(link_until, end if i in ends else i)
        if i > drop_until and name not in VOID and _is_boilerplate(name, rest, i <= article_until, i <= inner_until):
            if i not in ends:
                end = next(
                    (j for j in range(i + 1, len(tokens)) if tokens[j][0] in _STARTS_TEXT and not tokens[j][1]),
                    len(tokens),
                )
            # A wrapper that holds an article is no boilerplate, whatever its name.
            if i <= article_until or not any(i < j <= end for j in articles):
                if name in INLINE:
                    flush(i)
                drop_until = max(drop_until, end)
                continue
        if i > drop_until and _is_article(name, rest):
            article_until = max(article_until, end)
            # What lies beside an article in a wrapper is judged like the rest of the page.
            if name == "article" or not any(i < j <= end for j in articles):
                inner_until = max(inner_until, end)
    flush(len(tokens))
    return out


def _usual(weights: list[int]) -> int:
    """Median of the weights above zero, where a line counts by its weight up to ``FULL_LINE``:
    neither one huge line nor many tiny ones move it."""
    ordered = sorted(w for w in weights if w)
    half, at = sum(min(w, FULL_LINE) for w in ordered) / 2, 0
    for w in ordered:
        at += min(w, FULL_LINE)
        if at > half:
            return w
    return ordered[-1] if ordered else 0


def _sums(weights: list[int], window: int) -> tuple[list[int], list[int]]:
    """Running totals, and the sum of the window that begins at each line."""
    total = [0]
    for w in weights:
        total.append(total[-1] + w)
    n = len(weights)
    return total, [total[min(n, i + window)] - total[i] for i in range(n)]


def threshold(weights: list[int], share: float, window: int, joined: bool) -> float:
    """What a window sum must exceed: ``share`` of the highest one or, ``joined``, of that of usual lines
    where it is lower."""
    highest = max(_sums(weights, window)[1], default=0)
    return share * (min(highest, window * _usual(weights)) if joined else highest)


def surge_and_dive(
    weights: list[int], share: float = SURGE_SHARE, window: int = WINDOW, joined: bool = False
) -> tuple[int, int]:
    """First and last line (exclusive) of the heaviest stretch whose window sums stay above
    ``share`` of the highest; (0, 0) if there is no weight at all. ``joined`` asks for all from
    the first stretch to the last, above ``share`` of a window of usual lines."""
    n = len(weights)
    total, sums = _sums(weights, window)
    least = threshold(weights, share, window, joined)
    best, start = (0, 0, 0), None
    first: int | None = None
    for i in range(n + 1):
        above = i < n and sums[i] > least
        if above and start is None:
            start = i
        if not above and start is not None:
            first = start if first is None else first
            low, high = first if joined else start, min(n, i + window - 1)
            while low < high and not weights[low]:
                low += 1
            while high > low and not weights[high - 1]:
                high -= 1
            best = max(best, (total[high] - total[low], low, high), key=lambda x: x[0])
            start = None
    return best[1], best[2]


def weights_of(found: list[Line]) -> list[int]:
    """Weights of the lines of a page; those of a declared article are raised."""
    if not any(line.article for line in found):
        return [line.weight for line in found]
    # Links inside an article are text.
    own = [len(line.text) if line.article else line.weight for line in found]
    least = _usual(own)
    return [DECLARED * max(w, least) if line.article else w for w, line in zip(own, found, strict=True)]


def _dense(weights: list[int], least: float, window: int = WINDOW) -> list[bool]:
    """Which lines lie in a window whose sum is above ``least``, between its first and its last weight."""
    found = [False] * len(weights)
    for i in range(len(weights)):
        held = [j for j in range(i, min(len(weights), i + window)) if weights[j]]
        if sum(weights[j] for j in held) > least:
            found[held[0] : held[-1] + 1] = [True] * (held[-1] + 1 - held[0])
    return found


def main_text(page: str | None) -> str:
    """Main text of one page, empty if it has none. Beside a declared article a line is kept only
    where lines outside the article reach the threshold by themselves."""
    found = [line for line in lines(page or "") if not line.boilerplate]
    weights = weights_of(found)
    low, high = surge_and_dive(weights, joined=True)
    if any(line.article for line in found):
        others = [0 if line.article else w for line, w in zip(found, weights, strict=True)]
        dense = _dense(others, threshold(weights, SURGE_SHARE, WINDOW, joined=True))
        return "\n".join(found[i].text for i in range(low, high) if found[i].article or dense[i])
    return "\n".join(line.text for line in found[low:high])


def extract(df: DataFrame, page: str = "html") -> DataFrame:
    """Replace the page by ``text`` and ``n_chars`` (code points of the text); other columns stay,
    columns of these names are replaced."""
    made = ("text", "n_chars")
    gone = {*made, page.lower()}
    out = df.drop(*[c for c in df.columns if c.lower() in gone])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, page):
                names = part.schema.names
                kept = [i for i, name in enumerate(names) if name.lower() not in gone]
                texts = [main_text(p) for p in part.column(names.index(page)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in kept),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=[*(names[i] for i in kept), *made],
                )

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return df.mapInArrow(run, T.StructType([*out.schema.fields, *fields]))
