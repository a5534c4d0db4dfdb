"""Main text of web pages by composite text density.

A page is read into a tree (implied end tags, raw text elements, unclosed and stray tags
as browsers treat them). What is never article text goes first: menus, headers, footers,
asides, forms, scripts and the like by element, role, or a word of class or id, unless
the page's main element, h1 heading or article lies within. For every node that is
left C counts its characters (without white space), T its tags, LC and LT those of
links, and with b the body, its composite density is

    C / T * log((C / LC) * (T / LT)) / log(ln(C * LC / (C - LC) + C * LC_b / C_b + e))

where a zero divisor counts as 1, and the last divisor is 1 at least. A container's
density sum adds up its children's densities (text that it holds itself counts as a
child without tags). The subtree of the largest sum is the article's core; the least
density on the path from the body to it is the threshold. The article is the nearest
article or main element around the core; without one it is the core together with
what stands beside its path and is at least as dense as the threshold, and the
headings before it. In it lists and other containers with mostly links and less than
the threshold are left out; all else stays.

A text block is what lies between tags of block elements; its white space runs become
one space, and blocks are joined by two line feeds.

Work is linear in the page (the tree is a list in document order, nothing recurses, and
an end tag finds its element by a table of open ones); a page is one row's work.

Cases: null and empty pages, and pages without text, give an empty text; the first of
equal sums is taken; plain text is one block; repeated rows and ids are read alone; an
empty table gives no rows; clashing names get a number.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltarecon.llm.common import free_name
from deltarecon.llm.periodic import row_type

# Elements of the HTML standard by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE = frozenset("textarea title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split()) | HEADINGS
BLOCKS = CLOSES_P | frozenset("html body head title td th tr tbody thead tfoot caption colgroup option optgroup select "
                              "legend script style noscript template textarea iframe object button".split())
# What an end tag, or an implied one, doesn't look beyond.
SCOPE = frozenset("table td th caption button object template html".split())
LIST_SCOPE = {"li": "ul ol menu dir", "dt": "dl", "dd": "dl", "option": "select", "tr": "table", "td": "table", "th": "table",
              "tbody": "table", "thead": "table", "tfoot": "table"}
CLOSED_BY = {"li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option", "tr": "tr td th", "td": "td th", "th": "td th",
             "tbody": "tr td th tbody thead tfoot", "thead": "tr td th tbody thead tfoot", "tfoot": "tr td th tbody thead tfoot"}
# What can hold an article or a part of one, and so has a density sum.
CONTAINERS = frozenset("body div section article main td blockquote center figure details form fieldset dd li".split())
LINKED = frozenset("ul ol dl div section table menu dir".split())

NOISE = frozenset("head title nav footer aside menu button select option optgroup datalist input textarea label legend "
                  "output script style noscript template iframe svg canvas object embed audio video map dialog noembed "
                  "noframes xmp search progress meter".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
                        "toolbar tablist status".split())
# Words of classes and ids; of comments apart, since comments may be articles of their own.
HEADER_WORDS = frozenset("header masthead topbar".split())
ARTICLE_WORDS = frozenset("article post entry story content title".split())
NOISE_WORDS = frozenset("nav navbar navigation menu submenu breadcrumb breadcrumbs footer foot sidebar rail aside "
                        "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promos promotion promoted cookie cookies consent gdpr notice notices "
                        "alert popup modal overlay toast newsletter subscribe subscription signup login signin paywall "
                        "share sharing social related recommended recommendations pagination pager widget widgets skip "
                        "search form copyright legal disclaimer".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
_PLAIN_CLASS = re.compile(r"(?i)^(?:has|with|without|no|is|not|hide|show)[-_]")
_PARTS = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+|))?+|=)*+)>""")
_ATTR = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]*+)))?""")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
TEXT = ""


class Tree:
    """Nodes in document order: ``tag`` (empty for text), ``parent``, ``last`` (the last node
    of the subtree), ``text`` of text nodes, ``attrs`` as written."""

    def __init__(self, page: str) -> None:
        self.tag, self.parent, self.last, self.text, self.attrs = ["#"], [-1], [0], [TEXT], [""]
        self._open = [0]  # open nodes, outermost first
        self._depth: dict[str, list[int]] = defaultdict(list)  # of the open nodes of a tag
        self._scopes, self._blocks = [0], [0]  # depths of open nodes that bound searches
        self._read(page)
        self._close(1)
        self.last[0] = len(self.tag) - 1

    def _add(self, tag: str, text: str = TEXT, attrs: str = "") -> int:
        self.tag.append(tag)
        self.parent.append(self._open[-1])
        self.last.append(len(self.last))
        self.text.append(text)
        self.attrs.append(attrs)
        return len(self.tag) - 1

    def _close(self, depth: int) -> None:
        """Closes open nodes down to ``depth``."""
        end = len(self.tag) - 1
        while len(self._open) > depth:
            node = self._open.pop()
            self.last[node] = end
            at = len(self._open)
            self._depth[self.tag[node]].pop()
            for bounds in (self._scopes, self._blocks):
                if bounds[-1] == at:
                    bounds.pop()

    def _nearest(self, tag: str, bound: int) -> int:
        """The depth of the innermost open ``tag`` above ``bound``, or 0."""
        depths = self._depth[tag]
        return depths[-1] if depths and depths[-1] > bound else 0

    def _start(self, tag: str, attrs: str) -> None:
        if tag in CLOSED_BY:
            bound = max((self._depth[t][-1] for t in LIST_SCOPE[tag].split() if self._depth[t]), default=0)
            bound = max(bound, self._scopes[-1]) if tag in ("li", "dt", "dd") else bound
            found = [d for t in CLOSED_BY[tag].split() if (d := self._nearest(t, bound))]
            if found:
                self._close(min(found))
        if tag in CLOSES_P and (p := self._nearest("p", self._scopes[-1])):
            self._close(p)
        if tag in HEADINGS and self.tag[self._open[-1]] in HEADINGS or tag == "a" and self._nearest("a", self._blocks[-1]):
            self._close(len(self._open) - 1 if tag != "a" else self._nearest("a", self._blocks[-1]))
        node = self._add(tag, attrs=attrs)
        if tag not in VOID:
            at = len(self._open)
            self._open.append(node)
            self._depth[tag].append(at)
            if tag in SCOPE:
                self._scopes.append(at)
            if tag in BLOCKS:
                self._blocks.append(at)

    def _end(self, tag: str) -> None:
        if tag in ("body", "html"):  # what follows still belongs to the body
            return
        if tag not in BLOCKS:
            bound = self._blocks[-1]
        elif tag in LIST_SCOPE and tag not in ("li", "dt", "dd"):
            bound = max((self._depth[t][-1] for t in LIST_SCOPE[tag].split() if self._depth[t]), default=0)
        elif tag in SCOPE:
            bound = 0
        else:
            bound = self._scopes[-1]
        if at := self._nearest(tag, bound):
            self._close(at)

    def _read(self, page: str) -> None:
        at, n, words = 0, len(page), []

        def flush() -> None:
            if words:
                text = html.unescape("".join(words))
                words.clear()
                if text.strip():
                    self._add(TEXT, text)
                elif len(self._open) > 1:
                    self._add(TEXT, " ")

        while at < n:
            mark = page.find("<", at)
            if mark < 0:
                words.append(page[at:])
                break
            if mark > at:
                words.append(page[at:mark])
            after = page[mark + 1:mark + 2]
            if page.startswith("<!--", mark):
                if page.startswith((">", "->"), mark + 4):
                    at = page.index(">", mark) + 1
                    continue
                ends = [e for e in (page.find("-->", mark + 4), page.find("--!>", mark + 4)) if e >= 0]
                if not ends:
                    break
                at = page.index(">", min(ends)) + 1
                continue
            if after in ("!", "?") or after == "/" and not page[mark + 2:mark + 3].isalpha():
                end = page.find(">", mark)
                at = n if end < 0 else end + 1
                continue
            m = _TAG.match(page, mark)
            if m is None:
                if not (after.isascii() and after.isalpha() or after == "/"):
                    words.append("<")
                    at = mark + 1
                    continue
                break  # a tag that the page ends in
            flush()
            at, tag = m.end(), m[2].lower()
            if m[1]:
                self._end(tag)
                continue
            self._start(tag, m[3])
            if tag in RAW or tag in ESCAPABLE:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                stop = end.start() if end else n
                if tag in ESCAPABLE and stop > at:
                    self._add(TEXT, html.unescape(page[at:stop]))
                at = stop
        flush()


def _attributes(written: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(written):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def is_main(attrs: dict[str, str]) -> bool:
    return attrs.get("role", "").lower() == "main" or attrs.get("itemprop") == "articleBody"


def _class_words(value: str) -> set[str]:
    out = set()
    for name in value.split():
        if not _PLAIN_CLASS.match(name):
            out.update(_PARTS.split(_CAMEL.sub("-", name).lower()))
    return out


def _upto(flags: list[int]) -> list[int]:
    """Sums before every place, so that a subtree's is the difference of two."""
    return list(accumulate(flags, initial=0))


def _noise(tree: Tree) -> list[bool]:
    """For every node whether it is left out, itself or with a node around it."""
    n = len(tree.tag)
    attrs = [_attributes(a) if a else {} for a in tree.attrs]
    role = [a.get("role", "").lower() for a in attrs]
    words = [_class_words(a.get("class", "") + " " + a.get("id", "")) if a else set() for a in attrs]
    comment = [bool(w & COMMENT_WORDS) for w in words]
    mains = _upto([tree.tag[i] in ("main", "h1") or is_main(attrs[i]) for i in range(n)])
    articles = _upto([tree.tag[i] == "article" and not comment[i] for i in range(n)])
    chars = _upto([0 if tree.tag[tree.parent[i]] in RAW else len(tree.text[i].strip()) for i in range(n)])
    headings = _upto([tag in HEADINGS for tag in tree.tag])
    out, article_of = [False] * n, [0] * n
    for i in range(1, n):
        tag, up, end = tree.tag[i], tree.parent[i], tree.last[i] + 1
        if out[up]:
            out[i] = True
            continue
        article_of[i] = i if tag in ("article", "main") or is_main(attrs[i]) else article_of[up]
        if tag == TEXT or tag in ("html", "body", "main") or is_main(attrs[i]):
            continue
        hidden = "hidden" in attrs[i] and attrs[i]["hidden"].lower() != "until-found"
        main, article = mains[end] > mains[i], articles[end] > articles[i + 1]
        header = tag == "header" or words[i] & HEADER_WORDS and not words[i] & ARTICLE_WORDS
        if hidden or attrs[i].get("aria-hidden", "").lower() == "true" or _HIDDEN.search(attrs[i].get("style", "")):
            out[i] = True
        elif comment[i]:
            out[i] = not main
        elif header and not article and tag != "article":
            if article_of[i] and main and headings[i] == headings[article_of[i]]:
                _leave_headings(tree, i, out)  # the article's own header
            else:
                out[i] = True
        elif tag in ("form", "fieldset"):  # unless around the page
            out[i] = not (main or article or 2 * (chars[end] - chars[i]) > chars[-1])
        elif tag in NOISE and tag != "header":
            out[i] = True
        elif role[i] in NOISE_ROLES or words[i] & NOISE_WORDS:
            out[i] = not (main or article) and tag not in HEADINGS
    return out


def _leave_headings(tree: Tree, header: int, out: list[bool]) -> None:
    heading_end = -1
    for j in range(header + 1, tree.last[header] + 1):
        if tree.tag[j] in HEADINGS:
            heading_end = tree.last[j]
        elif tree.tag[j] == TEXT and j > heading_end:
            out[j] = True


def _densities(tree: Tree, out: list[bool], body: int) -> tuple[list[float], list[int], list[int]]:
    """Composite densities, characters and link characters of the nodes that aren't left out."""
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        if out[i]:
            continue
        up = tree.parent[i]
        if tree.tag[i] == TEXT:
            chars[i] = sum(map(len, tree.text[i].split()))
        elif tree.tag[i] == "a":
            link_chars[i], link_tags[i] = chars[i], tags[i] + 1
        chars[up] += chars[i]
        link_chars[up] += link_chars[i]
        link_tags[up] += link_tags[i]
        tags[up] += tags[i] + (tree.tag[i] != TEXT)
    share = link_chars[body] / (chars[body] or 1)
    density = [0.0] * n
    for i in range(1, n):
        if chars[i]:
            c, t, lc, lt = chars[i], tags[i] or 1, link_chars[i], link_tags[i]
            base = math.log(c / ((c - lc) or 1) * lc + share * c + math.e)
            # Without links on the page the base would be 1, and its logarithm 0.
            density[i] = c / t * math.log(max(c / (lc or 1) * (t / (lt or 1)), 1.0)) / math.log(max(base, math.e))
    return density, chars, link_chars


def _article(tree: Tree) -> list[bool]:
    """For every node whether it belongs to the article."""
    n = len(tree.tag)
    out = _noise(tree)
    body = next((i for i in range(n) if tree.tag[i] == "body"), 0)
    density, chars, link_chars = _densities(tree, out, body)
    total = [0.0] * n
    for i in range(1, n):
        total[tree.parent[i]] += 0.0 if out[i] else density[i]

    main = [tree.tag[i] == "main" or bool(a) and is_main(_attributes(a)) for i, a in enumerate(tree.attrs)]
    semantic = [main[i] or tree.tag[i] == "article" for i in range(n)]
    within = body
    for kind in (main, semantic):
        # The main element, or the only article (in it), is where to look.
        found = [i for i in range(within, tree.last[within] + 1) if kind[i] and not out[i] and chars[i] and i != within]
        outer = [i for i in found if not any(j < i <= tree.last[j] for j in found[:1])]
        within = found[0] if len(outer) == 1 or kind is main and found else within
    core = within
    for i in range(within + 1, tree.last[within] + 1):
        if tree.tag[i] in CONTAINERS and not out[i] and total[i] > total[core]:
            core = i
    path = [core]
    while path[-1] > 0 and path[-1] != body:
        path.append(tree.parent[path[-1]])
    on_path = set(path)
    threshold = min((density[i] for i in path if chars[i]), default=0.0)
    roots = [i for i in path if semantic[i]][:1]
    if not roots:
        beside = (i for i in range(1, n) if tree.parent[i] in on_path and tree.parent[i] != core and i not in on_path)
        roots = [core, *(i for i in beside if density[i] >= threshold and 2 * link_chars[i] <= chars[i]
                         or tree.tag[i] in HEADINGS and i < core)]

    taken = [False] * n
    for root in roots:
        i = root
        while i <= tree.last[root]:
            links = tree.tag[i] in LINKED and i not in on_path and density[i] < threshold and 2 * link_chars[i] > chars[i]
            if out[i] or links:
                i = tree.last[i]
            else:
                taken[i] = True
            i += 1
    return taken


def extract(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    tree = Tree(page)
    taken = _article(tree)
    blocks, now = [], []

    def end() -> None:
        if now:
            if words := "".join(now).split():
                blocks.append(" ".join(words))
            now.clear()

    inside: list[int] = []  # ends of the open block elements
    for i in range(1, len(tree.tag)):
        while inside and inside[-1] < i:
            inside.pop()
            end()
        tag = tree.tag[i]
        if tag == TEXT:
            if taken[i]:
                now.append(tree.text[i])
        elif tag == "br":
            now.append(" ")
        elif tag in BLOCKS:
            end()
            inside.append(tree.last[i])
    end()
    return "\n\n".join(blocks)


def with_main_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``; a taken name gets a number."""
    name, key = free_name(pages, "text"), free_name(pages, "row_nr")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(texts, pa.string())], ["row", name])

    row = F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias(key)
    out = pages.select("html", row).mapInArrow(run, f"row {row_type(pages)}, {name} string")
    return out.select(*(F.col("row").getField(c).alias(c) for c in pages.columns), name)


def page_report(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` per page."""
    return with_main_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
