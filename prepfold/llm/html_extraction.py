"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines: a block-level element starts a line, inline
elements leave none, scripts, styles and comments go, and so do elements that
say they are no main text (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments), by their tag, role, class or id. Where an
element was dropped, or containers meet, one or two blank lines stay, around
an article as many as a window.

The line-block sum at a line is the text length (without link texts, menus
being all links) of it and the next ``WINDOW - 1`` lines. A surge point is
where the sum rises from nothing, a dive point where it falls back to
nothing, so a stretch between the two is text without a gap of ``WINDOW``
lines that are blank or links. Short lines inside a stretch stay with it. A stretch is kept if
its highest sum reaches ``SURGE``, and with it every line, short ones and link
lists too, that stands in the same container as its text or between kept
stretches; if no stretch reaches the mark, the one with most text is kept. In
a page whose marked article (article, main) holds at least half of the text,
the lines outside count for nothing and all inside are kept; a smaller marked
article is kept with the stretches outside.

Defined results: a null or empty page, or one of markup only, has the empty
text; character references are decoded once, after the markup is gone; white
space inside a block is one space; unclosed elements end where the page does,
but one dropped for its class or id alone, or a form, that never closes, or that
holds the first article of the page, is not dropped, nor a form, or an element
with such a word in a part of its name, that holds most of a page's text where
no other main text is; an unfinished tag at the end is no text; rows that repeat get a result each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import table

WINDOW = 3
SURGE = 80

MARKUP = re.compile(
    r"""<!--.*?(?:--!?>|\Z)                                     # comment
      | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)
        (?P<attrs>(?:(?>[^>"']+|"[^"]*"|'[^']*')*+>|[^>]*+(?:>|\Z)))  # tag
      | <[!?/][^>]*+(?:>|\Z)                                    # declaration""", re.X | re.S)
NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*))""", re.I)

RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "svg", "object", "canvas"}
DROPPED = {"nav", "footer", "aside", "form", "menu", "select", "button", "dialog", "head", "noframes"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu",
         "menubar", "form", "note", "toolbar"}
#: Words of class or id names that mark what is no main text.
NOT_TEXT = re.compile(
    r"(?:^|[\s_-])(?:ads?|ad(?:box|unit|slot|space)|ads(?:ense|bygoogle)|advert\w*|sponsor(?:ed|s)?|promos?|promotions?|"
    r"banners?|(?<!has-)(?<!no-)(?<!with-)side-?bars?|nav|navs|navbar|navigation|menus?|breadcrumbs?|topbar|masthead|headers?|footers?|foot|comments?|"
    r"comment-?list|respond|disqus|replies|notices?|cookies?|consent|gdpr|alerts?|popups?|modal|overlay|newsletter|"
    r"subscribe|subscription|signup|login|share|sharing|social|related|recommended|pagination|pager|(?<!elementor-)widgets?|"
    r"toolbar|skip-?link)(?=$|[\s_-])", re.I)
#: Classes that tell an element's state, not what it is.
STATE = re.compile(r"(?<!\S)(?:(?:has|no|with|without)-\S+|\S+-(?:open|closed|enabled|disabled|allowed))(?!\S)", re.I)
#: Names of a reader's comment that is marked up as an article.
COMMENT = re.compile(r"comments?[_-]\S*", re.I)
CAPITAL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: An article's own header holds its title.
HEADER = re.compile(r"(?:^|[\s_-])(?:headers?)(?=$|[\s_-])", re.I)
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p",
          "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CONTAINERS = {"article", "aside", "body", "div", "header", "main", "section", "table"}
ARTICLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


def _says_no(tag: str, attrs: str, inside: bool) -> str:
    """'tag' if an element is no main text by its tag or role, 'form' if it is
    a form, 'name' if a whole class or id says so, 'part' if a part of one
    does; else ''."""
    if tag == "form":
        return "form"
    if tag in DROPPED or (tag == "header" and not inside):
        return "tag"
    why = ""
    if "=" in attrs and tag not in ("html", "body"):
        for m in NAMED.finditer(attrs):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "role":
                if value.strip().lower() in ROLES:
                    return "form" if value.strip().lower() == "form" else "tag"
            else:
                value = STATE.sub(" ", CAPITAL.sub("-", value))
                if inside:
                    value = HEADER.sub(" ", value)
                if any(map(NOT_TEXT.fullmatch, value.split())):
                    return "name"
                # An article is one unless a whole name says it is not.
                if tag in ARTICLE:
                    why = why or ("part" if any(map(COMMENT.fullmatch, value.split())) else "")
                elif NOT_TEXT.search(value):
                    why = "part"
    return why


class _Lines:
    """Lines of a page: text, its length without links, whether in an article,
    and the number of the container they stand in (0: none but the page)."""

    def __init__(self):
        self.lines: list[tuple[str, int, bool, int]] = []
        self.parents = [0]  # the container around each
        self.open: list[tuple[str, int]] = []
        self.parts: list[str] = []
        self.links: list[str] = []
        self.heading = False

    def add(self, text: str, in_link: bool) -> None:
        self.parts.append(text)
        if in_link:
            self.links.append(text)

    def end(self, inside: bool, blank: int = 0) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                # A heading that is a link is still a heading.
                linked = 0 if self.heading else sum(len(" ".join(html.unescape(t).split())) for t in self.links)
                self.lines.append((text, max(0, len(text) - linked), inside, self.home()))
            self.parts, self.links = [], []
        self.heading = False
        # Containers that meet, however many, do not part what stands in them.
        there = next((k for k, x in enumerate(reversed(self.lines)) if x[0]), len(self.lines))
        self.lines += [("", 0, inside, 0)] * (blank if blank >= WINDOW else min(blank, max(0, WINDOW - 1 - there)))


    def home(self) -> int:
        return self.open[-1][1] if self.open else 0

    def container(self, tag: str, closes: bool) -> None:
        if not closes:
            self.parents.append(self.home())
            self.open.append((tag, len(self.parents) - 1))
        elif any(x[0] == tag for x in self.open):
            while self.open.pop()[0] != tag:
                pass


def page_lines(page: str, kept_names: set[int]) -> tuple[_Lines, list[tuple[int, int]]]:
    """The page's lines without dropped elements, but for those that start at
    ``kept_names``; and (length without links, start) of each dropped element
    that may hold the main text for all its name or tag says."""
    out = _Lines()
    drops: list[tuple[int, int]] = []
    mass, may_hold = 0, False
    at, link, inside = 0, 0, 0
    dropping, depth, resume = "", 0, 0  # the dropped element's tag, how deep, and where it began if by name
    link_within = False
    n = len(page)
    saved = None

    def undrop():
        nonlocal at, dropping, saved, link, inside
        kept_names.add(resume)
        out.lines, out.parts, out.links, link, inside, out.open = saved
        at, dropping, saved = resume, "", None

    while True:
        m = MARKUP.search(page, at)
        stop = m.start() if m else n
        if stop > at and not dropping:
            out.add(page[at:stop], link > 0)
        elif stop > at and not link_within:
            mass += len(" ".join(page[at:stop].split()))
        if not m:
            if dropping and saved is not None:  # it never closed: go back and keep it
                undrop()
                continue
            break
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag, closes = tag.lower(), bool(m["end"])
        if tag in RAW and not closes and not m["attrs"].rstrip().endswith("/>"):
            found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = found.end() if found else n
            continue
        if dropping:
            if (saved is not None and tag in ARTICLE and not closes and not any(x[2] for x in saved[0])
                    and not _says_no(tag, m["attrs"], False)):
                undrop()  # it holds the page's article
                continue
            if tag == "a" or tag in ("p", "div", "li"):
                link_within = tag == "a" and not closes
            if tag == dropping and tag not in VOID:
                depth += -1 if closes else 1
            if depth == 0 or (dropping == "head" and tag == "body"):
                if may_hold:
                    drops.append((mass, resume))
                dropping, saved = "", None
                out.end(inside > 0, 1)
            continue
        if not closes and tag not in VOID and m.start() not in kept_names:
            why = _says_no(tag, m["attrs"], inside > 0)
            if why:
                out.end(inside > 0)
                dropping, depth, resume = tag, 1, m.start()
                mass, link_within, may_hold = 0, False, why in ("form", "part")
                saved = (list(out.lines), [], [], link, inside, list(out.open)) if why != "tag" else None
                continue
        if tag == "br":
            out.add(" ", False)
        elif tag == "a":
            link = max(0, link + (-1 if closes else 1))
        elif tag in BLOCKS:
            out.end(inside > 0, 1 if tag in CONTAINERS else 0)
            if tag in CONTAINERS and tag != "body":
                out.container(tag, closes)
            if tag in ARTICLE:
                inside = max(0, inside + (-1 if closes else 1))
                out.end(inside > 0, WINDOW)
            if tag in ("p", "div", "li"):
                link = 0  # an unclosed link ends with its block
            out.heading = tag in HEADINGS and not closes
    out.end(inside > 0)
    return out, drops


def stretches(lengths: list[int]) -> list[tuple[int, int, int]]:
    """(surge, dive, highest line-block sum) of every stretch of lines."""
    n = len(lengths)
    sums = [sum(lengths[k:k + WINDOW]) for k in range(n)]
    out, k = [], 0
    while k < n:
        if not sums[k]:
            k += 1
            continue
        end = k
        while end < n and sums[end]:
            end += 1
        out.append((k, end, max(sums[k:end])))
        k = end
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    kept_names: set[int] = set()  # starts of elements that are kept for all their name or tag says
    while True:
        page_, drops = page_lines(page, kept_names)
        lines = page_.lines
        sizes = [x[1] for x in lines]
        inside = any(x[2] and x[0] for x in lines)
        found = stretches(sizes)
        # Without a main text elsewhere, the dropped element that holds most of the page's text is it.
        mass, start = max(drops, default=(0, 0))
        if inside or mass < SURGE or mass <= sum(sizes) or any(s[2] >= SURGE for s in found):
            break
        kept_names.add(start)
    # An article element that holds less than half of the text is not all of it.
    if inside and 2 * sum(x[1] for x in lines if x[2]) >= sum(sizes):
        # The page says what its text is: a line of links counts like any other.
        return "\n\n".join(x[0] for x in lines if x[2] and x[0])
    marked = [bool(x[2] and x[0]) for x in lines]
    high = [s for s in found if s[2] >= SURGE or any(marked[s[0]:s[1]])]
    high = high or sorted(found, key=lambda s: (-sum(sizes[s[0]:s[1]]), s[0]))[:1]
    keep = set(k for k, x in enumerate(marked) if x)
    held = [0] * len(page_.parents)
    for a, b, _ in high:
        own = [k for k in range(a, b) if sizes[k]]
        # Link lines at the edges, which the window took in, are the menu's.
        keep.update(range(own[0], own[-1] + 1) if own else ())
        for k in own:
            held[lines[k][3]] += sizes[k]
    # What stands in the container of a kept text is of it, however short, and so is what stands between.
    home = [False] * len(held)
    for k in range(1, len(held)):
        home[k] = held[k] >= SURGE or home[page_.parents[k]]
    keep.update(k for k, x in enumerate(lines) if home[x[3]])
    return "\n\n".join(lines[k][0] for k in range(min(keep), max(keep) + 1) if lines[k][0]) if keep else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    kinds = dict(pages.dtypes)
    rows = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`").cast("string"))

    def run(batches):
        for batch in batches:
            found = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()),
                 pa.array([len(x) for x in found], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return rows.mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    """No SQL form; the tests hold pages against their known articles."""
    return extract(table(spark, sf_dir, "pages"))
