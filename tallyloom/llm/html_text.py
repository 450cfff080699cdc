"""Main text of HTML pages by tree scoring.

Tags are cut out by one pass over the page into a tree of block elements; inline
elements leave only their text and whether it was link text. Menus, headers,
footers, sidebars, notices, adverts, forms, comments and hidden parts are left
out by element, role, class and id. Each paragraph passes points for its length
and commas to its ancestors, less with distance; a container's score is
discounted by its link density. The best container (or the article or main
element around it) is kept with those siblings that score well or read like
paragraphs. The kept blocks, white space collapsed, are joined in page order.

Null and empty pages, and pages without text, give an empty text. Each row is
worked out by itself, so repeated rows give equal results and a very long page
costs time in proportion to its length. Other columns pass through; a column
named like a result column is replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

_TAG = re.compile(r"""<(?:!--|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[!?/][^>]*+>|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>)""")
_ATTR = re.compile(r"""([a-zA-Z][\w-]*)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_RAW = frozenset("script style textarea title xmp iframe noframes noembed".split())
_DROP = frozenset("script style textarea title head nav aside footer form iframe svg button select template "
                  "dialog menu object canvas audio video map datalist xmp noframes noembed".split())
_BLOCK = frozenset("html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr li main menu nav ol p pre section summary "
                   "table tbody td tfoot th thead tr ul caption".split()) | _DROP
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ENDS_P = _BLOCK - frozenset("html body head script style template svg math button select object canvas audio video map "
                             "datalist textarea title noscript iframe xmp noframes noembed".split())
_SELF_CLOSING = {"li": ("ol", "ul", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"),
                 "th": ("tr", "table"), "p": ("div", "article", "section", "td", "th", "li", "main", "body", "blockquote")}
_PAIRED = {"td": ("td", "th"), "th": ("td", "th"), "dd": ("dd", "dt"), "dt": ("dd", "dt")}
_PARAGRAPH = frozenset("p pre blockquote td th li dd dt h1 h2 h3 h4 h5 h6 figcaption summary caption address".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar "
                   "tablist".split())
#: Words of class and id values that mark a part as not the article.
_NOISE = frozenset("ad ads advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs cookie "
                   "cookies consent gdpr notice notices comment comments commentlist respond reply replies disqus footer foot "
                   "header masthead menu menus nav navbar navigation navi pager pagination popup modal overlay promo promos "
                   "promotion related recommend recommended recommendations share sharing shares social sidebar side aside "
                   "sponsor sponsored sponsors subscribe subscription newsletter signup login search skip tags tagcloud "
                   "toolbar widget widgets hidden copyright disclaimer outbrain taboola alert toast".split())
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")

SIBLING_SHARE = 0.2
LONG_PARAGRAPH = 80


class _Node:
    __slots__ = ("chars", "drop", "in_article", "kept", "links", "parent", "score", "tag")

    def __init__(self, tag, parent, drop):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.score, self.chars, self.links, self.kept = 0.0, 0, 0, False
        self.in_article = tag in ("article", "main") or parent is not None and parent.in_article


def _noise(tag: str, attrs: str, inside_article: bool) -> bool:
    if tag in _DROP:
        return True
    if tag == "header":
        return not inside_article
    if not attrs or tag in ("html", "body", "main", "article") and "comment" not in attrs.lower():
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name in ("class", "id") and _NOISE.intersection(_WORDS.findall(_CAMEL.sub(" ", value).lower())):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return True
    return False


def _parse(html: str) -> tuple[list[_Node], list[tuple[_Node, str, int]]]:
    """Block nodes, and runs of text between block borders: (node, text, link characters)."""
    root = _Node("#root", None, False)
    nodes, runs, stack = [root], [], [root]
    opened: dict[str, int] = defaultdict(int)  # open elements by tag: a stack is searched only for what is in it
    endless: set[str] = set()  # inline tags that are not closed any more
    text: list[str] = []
    links, link_chars, at, n = 0, 0, 0, len(html)

    def cut(k):
        for x in stack[k:]:
            opened[x.tag] -= 1
        del stack[k:]

    def flush():
        nonlocal link_chars
        if text:
            if not stack[-1].drop:
                run = " ".join(unescape("".join(text)).split())
                if run:
                    runs.append((stack[-1], run, min(link_chars, len(run))))
            text.clear()
        link_chars = 0

    while at < n:
        m = _TAG.search(html, at)
        part = html[at:m.start()] if m else html[at:]
        if part:
            text.append(part)
            if links:
                link_chars += len(part)
        if not m:
            break
        at = m.end()
        if m[0] == "<!--":
            end = html.find("-->", max(at - 2, 0))
            at = n if end < 0 else end + 3
            continue
        close, tag, attrs = m[1] or m[4], (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        if not tag:
            continue
        if tag == "a":
            links = 0 if close else 1
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in _BLOCK:
            if not close and tag not in _VOID and attrs and tag not in endless and _noise(tag, attrs, True) and _hides_inline(attrs):
                end = re.compile(rf"(?i)</{re.escape(tag)}\s*>").search(html, at)
                if end:
                    at = end.end()
                else:
                    endless.add(tag)
            continue
        flush()
        links = 0
        if close:
            stop = _SELF_CLOSING.get(tag, ())
            for k in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                if stack[k].tag == tag:
                    cut(k)
                    break
                if stack[k].tag in stop:
                    break
            continue
        if tag in _ENDS_P or tag in _SELF_CLOSING:
            for own in {"p", tag} if tag in _SELF_CLOSING else ("p",):
                if own == "p" and tag not in _ENDS_P:
                    continue
                stop, same = _SELF_CLOSING[own], _PAIRED.get(own, (own,))
                for k in range(len(stack) - 1, 0, -1) if any(opened[x] > 0 for x in same) else ():
                    if stack[k].tag in same:
                        cut(k)
                        break
                    if stack[k].tag in stop:
                        break
        if tag in _VOID:
            continue
        up = stack[-1]
        if tag in _RAW:
            end = re.compile(rf"(?i)</{tag}[\s/>]").search(html, at)
            at = n if not end else html.find(">", end.start()) + 1 or n
            continue
        if attrs.endswith("/") and tag in ("svg", "math"):
            continue
        node = _Node(tag, up, up.drop or _noise(tag, attrs, up.in_article))
        if up.tag == "header" and not up.drop and tag not in _HEADING and tag != "hgroup":
            node.drop = True
        nodes.append(node)
        stack.append(node)
        opened[tag] += 1
    flush()
    return nodes, runs


def _hides_inline(attrs: str) -> bool:
    return any(name.lower() == "hidden" or name.lower() == "style" and _HIDDEN.search(a or b or c or "")
               or name.lower() == "aria-hidden" and (a or b or c) == "true" for name, a, b, c in _ATTR.findall(attrs))


def main_text(html: str | None) -> str:
    """The article of one page as plain text."""
    if not html:
        return ""
    nodes, runs = _parse(html)
    if not runs:
        return ""
    for node, run, links in runs:
        points = 1 + run.count(",") + run.count("，") + min(len(run) // 100, 3) if len(run) >= 25 else 0.2
        (node.parent if node.tag in _PARAGRAPH and node.parent else node).score += points
        node.chars += len(run)
        node.links += links
    for x in reversed(nodes):  # children come after their parents
        if x.parent is not None:
            x.parent.score += x.score / 2
            x.parent.chars += x.chars
            x.parent.links += x.links

    def worth(x: _Node) -> float:
        return x.score * (1 - x.links / x.chars) if x.chars else 0.0

    boxes = [x for x in nodes if x.tag not in _PARAGRAPH and x.chars and not x.drop]
    best = max(boxes, key=worth)
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
            if up.tag == "article":
                break
        up = up.parent
    best.kept = True
    floor = SIBLING_SHARE * worth(best)
    if best.parent is not None:
        for x in nodes:
            if x.parent is best.parent and x is not best and x.chars and not x.drop:
                density = x.links / x.chars
                x.kept = (worth(x) >= floor and density < 0.5 if x.tag not in _PARAGRAPH
                          else density < 0.25 and (x.chars >= LONG_PARAGRAPH or x.tag == "h1"))
    for x in nodes:
        x.kept = x.kept or x.parent is not None and x.parent.kept
    return " ".join(run for node, run, _ in runs if node.kept)


def _column(batches):
    for batch in batches:
        texts = [main_text(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
        cols = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:-1], "text", "n_chars"])


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with the html column replaced by text and n_chars (its code points)."""
    from pyspark.sql import types as T

    others = [c for c in pages.columns if c != html and c not in ("text", "n_chars")]
    df = pages.select(*others, html)
    schema = T.StructType([*[df.schema[c] for c in others], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return df.mapInArrow(_column, schema)
