"""Main text of web pages: site template removal.

1. Every page is parsed into a tree, and each element's subtree is hashed (its
   tag, class, id, text and children). A row per page and block subtree goes to
   Spark: host, hash, and a digest of the whole page.
2. Spark counts, per host, the distinct pages that hold a subtree (equal pages
   count once) and the host's distinct pages. Subtrees on ``MIN_PAGES`` pages
   and ``MIN_SHARE`` of the host's pages or more are its template; so are, on a
   host of any size, those on ``MANY_PAGES`` pages that are mostly links, or
   boxes with less than half of their page's text and no passages.
3. A page's text is read without its host's template subtrees and without what
   the markup itself names as no part of the article: scripts, menus, headers,
   footers, sidebars, forms, adverts, notices, comments. A class or id names
   by its last word, words for a part of a page ("-list", "-box") left off:
   "article-comments" does, "share-price" doesn't; words of everyday language
   ("menu", "share") only beside such words. It doesn't name what holds most of
   the text or of the articles' text (comment sections apart). Inside an ``article``
   or ``main`` element a template subtree goes only if most of its text is
   links, so that a passage which several articles share stays.

Counting uses partial aggregation by (host, hash) and (host, hash, page), so a
hot host is spread over all tasks. Only pages with a template subtree that the
markup doesn't already exclude are joined with their hits.

Nulls and odd rows: null or empty html gives an empty text. A page without url,
or with one that can't be read, belongs to the host "". Repeated rows each get
their text. Broken markup is read as browsers do: unknown end tags are left
out, open elements end with their parent. Very long and very deep pages are read
without recursion. Input columns to carry travel in the struct ``row`` and can't
clash. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import written

MIN_PAGES = 3
MIN_SHARE = 0.3
#: Pages that make a box or a list of links a template whatever the host's size.
MANY_PAGES = 50
#: Least share of linked text for a template subtree inside an article.
LINKED = 0.5

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never part of an article.
_NO_TEXT = frozenset(
    "head script style noscript template title nav footer aside form button input select option textarea iframe object embed svg canvas "
    "dialog menu search noembed noframes audio video map".split()
)
_NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class or id attributes; the second list counts outside articles only.
#: They tell if all the other words are of ``_PLAIN_WORDS`` or numbers.
_NO_TEXT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle sponsor sponsored promo banner cookie cookies consent gdpr notice popup modal "
    "overlay sidebar nav navbar sitenav mainnav topnav subnav navigation menu breadcrumb breadcrumbs footer comment comments disqus reply replies respond share sharing social "
    "newsletter subscribe signup login widget masthead pagination pager skip".split()
)
_OUTER_WORDS = frozenset("header topbar bottom top related recommended copyright toolbar search form alert message rail".split())
_COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
_PLAIN_WORDS = frozenset(
    "site main page global primary secondary left right center middle inner outer container wrapper wrap box block list links link section area "
    "bar slot unit item items button buttons icon icons title text body group row col column media bookmarks trail thread posts post stories "
    "this widgets desktop mobile sticky fixed js".split()
)
#: Words that tell as last word whatever stands before, but for ``_DENIES``.
_LAST_WORDS = frozenset(
    "ad ads adverts advertisement advertisements advertising adsense adsbygoogle sponsored comments disqus sidebar nav navbar sitenav mainnav topnav subnav "
    "navigation breadcrumb breadcrumbs footer newsletter cookie cookies gdpr consent popup pagination masthead".split()
)
#: Pairs that tell by both words.
_LAST_PAIRS = frozenset([("author", "bio"), ("about", "author"), ("cookie", "notice"), ("privacy", "notice"), ("comment", "thread")])
#: These tell anywhere before a word for articles.
_TEASER_WORDS, _TEASERS = frozenset(["related", "recommended"]), frozenset("articles posts stories links reading news content".split())
#: Words left off at the end of a class or id.
_PARTS = frozenset(
    "list box section area block wrapper wrap container inner outer content label policy panel slot unit item items row col column group holder "
    "bar body title text link links left right top bottom desktop mobile sticky fixed module region".split()
)
_DENIES = frozenset("has no non not without with hide hides show shows open close closed free allow disable disabled enable enabled is after before".split())
_OUTSIDE_WORDS = _NO_TEXT_WORDS | _OUTER_WORDS
_KNOWN_WORDS = _OUTSIDE_WORDS | _PLAIN_WORDS
#: An open element of these ends where one of the listed begins.
_ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"]),
    "p": _BLOCK - {"caption", "dd", "dt", "legend", "li", "tbody", "td", "tfoot", "th", "thead", "tr", "html", "body", "figcaption", "summary"} | {"li", "dd", "dt"},
}
#: Blocks of running text, which pages may share without a template.
_PASSAGES = frozenset("p li blockquote pre h1 h2 h3 h4 h5 h6 dd dt td th tr caption figcaption details summary address center".split())
_SCOPES = frozenset("ul ol dl table article section div body html main aside blockquote td th".split())

# possessive throughout: broken markup must not make the search go back and forth
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z0-9]+")
#: Where a class or id has an inner word's or number's start.
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[a-z])(?=[0-9])|(?<=[A-Z])(?=[A-Z][a-z])")


def _words(name: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(_CAMEL.sub("-", name).lower()))


def _telling(words: tuple[str, ...], named: frozenset[str]) -> bool:
    """The words of one class or id say one of ``named``: nothing else stands
    beside it, or it is the last word that isn't for a part of a page."""
    if not named.isdisjoint(words) and all(w in _KNOWN_WORDS or w[0].isdigit() for w in words):
        return True
    if not _DENIES.isdisjoint(words):
        return False
    end = len(words)
    while end and (words[end - 1] in _PARTS or words[end - 1][0].isdigit()):
        end -= 1
    return bool(end) and words[end - 1] in _LAST_WORDS and words[end - 1] in named


def _telling_pair(words: tuple[str, ...]) -> bool:
    if len(words) < 2 or not _DENIES.isdisjoint(words):
        return False
    return words[-2:] in _LAST_PAIRS or words[-2] in _TEASER_WORDS and words[-1] in _TEASERS


class Element:
    __slots__ = ("tag", "words", "names", "role", "hidden", "parent", "children", "key", "size", "total", "linked")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        self.children: list[Element | str] = []
        self.words, self.names, self.role, self.hidden, self.key = (), (), "", False, 0
        self.size = self.total = self.linked = 0
        if attributes and not attributes.isspace():
            found = {name.lower(): html.unescape(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(attributes)}
            classes = f"{found.get('class', '')} {found.get('id', '')}"
            self.words = tuple(_WORD.findall(classes.lower()))
            self.names = tuple(_words(c) for c in classes.split()) if self.words else ()
            self.role = found.get("role", "").strip().lower()
            style = found.get("style", "").replace(" ", "").lower()
            self.hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style


def parse(page: str) -> Element:
    """The page's element tree. Text is kept as it stands, references
    undecoded."""
    root = node = Element("#page", "", None)
    at, find, last = 0, _MARKUP.search, max(page.rfind(">"), page.rfind("<!--"))
    while at <= last and (m := find(page, at)):
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            open_ = node
            while open_.parent is not None and open_.tag != tag:
                open_ = open_.parent
            if open_.parent is not None:
                node = open_.parent
            continue
        while node.tag in _ENDS and tag in _ENDS[node.tag]:
            node = node.parent
        if tag in _BLOCK:  # a block ends a paragraph even through inline elements
            open_ = node
            while open_.parent is not None and open_.tag not in _BLOCK:
                open_ = open_.parent
            if open_.tag in _ENDS and tag in _ENDS[open_.tag]:
                node = open_.parent
        element = Element(tag, m[3], node)
        node.children.append(element)
        if tag in _VOID:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            element.children.append(page[at : end.start() if end else len(page)])
            closing = page.find(">", end.start()) if end else -1
            at = closing + 1 if closing >= 0 else len(page)
        elif not m[3].endswith("/") or tag in _BLOCK:
            node = element
    if at < len(page):
        node.children.append(page[at:])
    return root


def _in_order(root: Element) -> list[Element]:
    """All elements, parents before children, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


def hash_subtrees(root: Element, host: str) -> list[Element]:
    """Sets the elements' keys: 64-bit hashes of the host and the subtree."""
    order = _in_order(root)
    for node in reversed(order):
        parts = [node.tag, *node.words, node.role]
        parts += [" ".join(c.split()) if isinstance(c, str) else str(c.key) for c in node.children]
        node.key = xxhash.xxh3_64_intdigest("\x00".join([host, *parts]).encode("utf-8", "replace")) - 2**63
    return order


def _tag_out(node: Element, inside: bool) -> bool:
    """The element's tag, role or style says that this is no part of an article."""
    return node.tag in _NO_TEXT or node.hidden or node.role in _NO_TEXT_ROLES or node.tag == "header" and not inside


def _comment(node: Element) -> bool:
    return node.tag not in ("html", "body", "main") and any(
        _telling(n, _COMMENT_WORDS if node.tag != "article" else frozenset(["comment"])) for n in node.names
    )


def _word_out(node: Element, inside: bool) -> bool:
    """The element's class or id says that this is no part of an article."""
    if not node.names or node.tag in ("html", "body", "main", "article"):
        return bool(node.names) and _comment(node)
    named = _NO_TEXT_WORDS if inside else _OUTSIDE_WORDS
    return any(_telling(n, named) or _telling_pair(n) for n in node.names)


def _named_out(node: Element, inside: bool, whole: int) -> bool:
    """The markup says that this isn't part of an article. A class or id alone
    doesn't say so of what holds most of the text: ``whole`` characters."""
    if _tag_out(node, inside):
        return True
    return _word_out(node, inside) and (2 * node.size <= whole or _comment(node))


def _measure(root: Element) -> None:
    """Sets the elements' sizes: characters of text, without what tags or
    comment classes take out; all of them; those in links."""
    for node in reversed(_in_order(root)):
        for c in node.children:
            if isinstance(c, str):
                node.total += len(c.strip())
            else:
                node.total += c.total
                node.linked += c.linked
        if node.tag == "a":
            node.linked = node.total
        if node.tag not in _NO_TEXT and not _tag_out(node, True) and not _comment(node):
            node.size = sum(len(c.strip()) if isinstance(c, str) else c.size for c in node.children)


def _articles(root: Element, by_words: bool) -> list[Element]:
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main") or node.role == "main":
            if not _tag_out(node, True) and not _comment(node) and (not by_words or not _word_out(node, True)):
                found.append(node)
            continue
        if node.parent is None or not (_tag_out(node, False) or _comment(node) or by_words and _word_out(node, False)):
            todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    return found


def _containers(root: Element) -> list[Element]:
    """The outermost article or main elements that aren't named out; those that
    lie in an element with a telling class too if they hold most of the
    articles' text; the whole page if there is none."""
    found = _articles(root, True)
    every = _articles(root, False)
    if 2 * sum(n.size for n in found) < sum(n.size for n in every):
        found = every
    return found or [root]


def _linked_share(node: Element) -> float:
    return node.linked / node.total if node.total else 1.0


#: Levels of a template: on many pages, on a large share of the host's pages.
MANY, LARGE = 1, 2


def _need(node: Element, inside: bool, whole: int) -> int:
    """The least level of a template that may take the block out; 0: none."""
    if _linked_share(node) >= LINKED:
        return MANY
    if inside:
        return 0
    return MANY if node.tag not in _PASSAGES and 2 * node.size < whole else LARGE


def read_text(root: Element, template: frozenset[int]) -> tuple[str, dict[int, int]]:
    """The main text, its blocks joined by line ends, without subtrees whose
    key is in ``template``; and the keys of all subtrees that a template could
    take out of it, with the least level that the template needs."""
    blocks: list[str] = []
    run: list[str] = []
    keys: dict[int, int] = {}

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                blocks.append(text)
            run.clear()

    _measure(root)
    for container in _containers(root):
        inside = container.parent is not None
        todo: list[Element | str | None] = [None, *reversed(container.children)]
        while todo:
            node = todo.pop()
            if node is None:
                flush()
            elif isinstance(node, str):
                run.append(node)
            elif node.tag in ("br", "wbr", "img", "hr"):
                run.append(" " if node.tag != "wbr" else "")
                if node.tag == "hr":
                    flush()
            elif not _named_out(node, inside, container.size):
                block = node.tag in _BLOCK
                need = _need(node, inside, container.size) if block and node.tag not in ("html", "body") else 0
                if need:
                    keys[node.key] = min(need, keys.get(node.key, need))
                    if node.key in template:
                        flush()
                        continue
                if block:
                    flush()
                    todo.append(None)
                todo += reversed(node.children)
    flush()
    return "\n".join(blocks), keys


def _strings(column: pa.Array) -> Iterator[str]:
    for x in column:
        yield x.as_py() or ""


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page, host, key, digest, need): block subtrees of each page. ``need``
    is the level of template that can take the subtree out, 0 if none can or
    the markup does already. A row with key null stands for the page itself."""
    for batch in batches:
        rows: list[tuple] = []
        for page, host, text in zip(batch.column(0).to_pylist(), _strings(batch.column(1)), _strings(batch.column(2)), strict=True):
            root = parse(text)
            order = hash_subtrees(root, host)
            _, needs = read_text(root, frozenset())
            host_key = xxhash.xxh3_64_intdigest(host.encode("utf-8", "replace")) - 2**63
            rows.append((page, host_key, None, root.key, 0))
            seen = {n.key for n in order if n.tag in _BLOCK and n.tag not in ("html", "body", "article", "main", "p", "li")} | set(needs)
            rows += [(page, host_key, key, root.key, needs.get(key, 0)) for key in seen]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page", "host", "key", "digest", "need"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for host, text, hits in zip(_strings(batch.column("host")), _strings(batch.column("html")), batch.column("hits").to_pylist(), strict=True):
            root = parse(text)
            if hits:
                hash_subtrees(root, host)
            texts.append(read_text(root, frozenset(hits or ()))[0])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of the input as a struct, by default the
    url) and ``text`` of every page."""
    carry = carry or [url_col]
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    page = F.xxhash64(F.col(url_col), F.col(html_col))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), page.alias("page"), host.alias("host"), F.col(html_col).alias("html"))

    subtrees = written(
        rows.select("page", "host", "html").mapInArrow(_subtrees, "page long, host long, key long, digest long, need int"), "subtrees"
    )
    held = subtrees.groupBy("host", "key", "digest").agg(F.lit(1).alias("one")).groupBy("host", "key").agg(F.count("one").alias("pages"))
    held = written(held.where(f"key is null or pages >= {MIN_PAGES}"), "subtree-counts")
    of_host = held.where("key is null").select("host", F.col("pages").alias("of_host"))
    level = F.when(F.col("pages") >= MIN_SHARE * F.col("of_host"), LARGE).when(F.col("pages") >= MANY_PAGES, MANY)
    template = held.where("key is not null").join(of_host, "host").select("key", level.alias("level")).where("level is not null")
    template = written(template.groupBy("key").agg(F.max("level").alias("level")), "templates")
    hits = subtrees.where("need > 0 and key is not null").join(template, "key").where("level >= need")
    hits = hits.groupBy("page").agg(F.collect_set("key").alias("hits"))
    hits = written(hits, "template-hits")
    joined = rows.join(hits, "page", "left").select("row", "host", "html", "hits")
    return joined.mapInArrow(_texts, f"row {rows.schema['row'].dataType.simpleString()}, text string")
