"""HTML extraction with wrappers: union-free regular expressions inferred from the pages of a host.

A page becomes a stream of block tokens: opening and closing tags with their names and classes, and the texts between them.
Tags that only format a run of text belong to the text. The streams of one host are aligned one after another, level by level of
their nesting, against the wrapper found so far:

- an element that both have is aligned within itself;
- one that only one side has becomes optional;
- one that comes again after others makes a repeated group of everything from its first to its last place;
- texts that differ become a text slot, texts that agree in all pages stay a constant.

A level of a wrapper thus names each kind of element once, so a wrapper is bounded by the kinds of elements of the host's
pages, not by their number or length, and two wrappers are aligned like a wrapper and a page. Tasks fold
their pages into a wrapper for each host and send those; they are merged in salted groups, then by host, so a host
with a third of all pages costs no task more than its share. The pages themselves are never shuffled for it.

The wrapper decides which slots hold the main text. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments are told by tag, role, id and class. What is left counts by rank: inside an article, else inside a main part, else
the element that holds most text in slots of the host's pages, without constants that are the same on several different pages
and without lists of links. Each page takes the best rank that it has itself, aligned with its host's wrapper. Inside an
article nothing but the named parts is dropped, whether other pages have it too or not.

Nulls: null or empty html has an empty text; a null ``url``, or one without a host, makes one host of all such pages. A null
``page_id`` is kept. Repeated rows each get a row. An empty table gives no rows. Broken markup never fails: a tag, comment or script
that does not end takes the rest of the page with it, as browsers do. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm.common import bounded, slices, stored

#: Wrappers that a task holds before it sends them, and groups that the wrappers of a host are merged in first.
HELD_HOSTS, SALTS = 2048, 64
#: Bytes of all labels up to which they are broadcast to the tasks.
BROADCAST_BYTES = 16 << 20
#: Share of text in links from which a block of a page without article is a menu.
LINK_SHARE = (1, 2)

# Fixed values of HTML: elements by their part in a page.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr progress q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_CHROME = frozenset(
    "head script style noscript template textarea title xmp iframe noembed noframes nav menu header footer aside form button select "
    "option datalist dialog object embed canvas svg math audio video map".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_CHROME_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar aside footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay comment "
    "comments disqus reply replies respond newsletter subscribe signup login search share sharing social related recommended "
    "widget pagination pager toolbar skip".split())
_HAVING = frozenset("has have with without no is".split())
_ARTICLE_WORDS = frozenset("articlebody article-body entry-content post-content article-content post-body story-body".split())
# Fixed values of HTML: an open paragraph or item ends where one of these begins.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split())
_ENDS = {"p": _ENDS_P, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"},
         "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
#: Elements that an end tag of something inside or around them does not close on the way.
_WALLS = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "thead": {"table"}, "dt": {"dl"}, "dd": {"dl"}}

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^>])?)*+)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.IGNORECASE)
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in _RAW}
_WORDS = re.compile(r"[a-z]+")
_PLAIN = re.compile(r"[a-z_-]{1,40}")
#: Nesting of a wrapper; deeper elements only part texts, but for those that are never main text.
DEPTH = 200


@dataclass
class Node:
    """An element of a wrapper: its items in order, and what is known of the texts directly in it."""

    pages: int = 0
    #: Texts in it: hash of the one all pages have (0: a slot), characters, and those of them in links.
    text: int | None = None
    chars: int = 0
    linked: int = 0
    #: Groups of kinds in order, each (kinds, repeated); kinds found in fewer pages than their parent are optional.
    groups: list[tuple[list[str], bool]] = field(default_factory=list)
    inside: dict[str, Node] = field(default_factory=dict)

    def expression(self) -> str:
        """The regular expression of what is in it: ``?`` optional, ``+`` repeated, ``#`` a text slot, ``=`` a constant."""
        parts = [] if self.text is None else ["=" if self.text else "#"]
        for kinds, repeated in self.groups:
            each = [f"<{k}>{self.inside[k].expression()}</>" + ("?" if self.inside[k].pages < self.pages else "") for k in kinds]
            parts.append(f"({' '.join(each)})+" if repeated else each[0])
        return " ".join(parts)

    def plain(self) -> list:
        return [self.pages, self.text, self.chars, self.linked, self.groups, {k: n.plain() for k, n in self.inside.items()}]

    @classmethod
    def of(cls, plain: list) -> Node:
        pages, text, chars, linked, groups, inside = plain
        return cls(pages, text, chars, linked, [(list(kinds), repeated) for kinds, repeated in groups], {k: cls.of(n) for k, n in inside.items()})


def kind_of(name: str, attributes: str) -> str:
    """What elements of one kind share: the name, class words without numbers, and the words of id and role that tell a part."""
    found = []
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower().split()
        if key.lower() == "class":
            found += [w for w in value if _PLAIN.fullmatch(w)]
        elif key.lower() == "role":
            found += [f"role={w}" for w in value if w in _CHROME_ROLES or w in ("main", "article")]
        else:
            # Ids and numbers differ from page to page; they do not make a kind of their own.
            found += [part for w in value for part in (w, *_WORDS.findall(w)) if part in _CHROME_WORDS or part in _ARTICLE_WORDS]
    return ".".join([name, *dict.fromkeys(found)])


def stream(page: str) -> Iterator[tuple[str, str, int]]:
    """Block tokens of a page: ("<", kind, 0), (">", kind, 0) and ("#", text, characters in links)."""
    at, n = 0, len(page)
    open_: list[tuple[str, str]] = []
    places: dict[str, list[int]] = {}
    raw: list[str] = []
    links, link_chars = 0, 0
    depth = 0

    def text() -> Iterator[tuple[str, str, int]]:
        nonlocal link_chars
        plain = " ".join(entities.unescape("".join(raw)).split()) if raw else ""
        raw.clear()
        if plain:
            yield "#", plain, min(link_chars, len(plain))
        link_chars = 0

    def closed() -> Iterator[tuple[str, str, int]]:
        nonlocal depth
        name, kind = open_.pop()
        places[name].pop()
        if kind:
            depth -= 1
            yield ">", kind, 0

    while at < n:
        sign = page.find("<", at)
        piece = page[at : sign if sign >= 0 else n]
        if piece:
            raw.append(piece)
            if links:
                link_chars += len(piece)
        if sign < 0:
            break
        at = sign
        if page.startswith("<!--", at):
            end = _COMMENT_END.search(page, at + 2)
            at = end.end() if end else n
            continue
        following = page[at + 1 : at + 2]
        if following in "!?" and following or (following == "/" and not page[at + 2 : at + 3].isalpha() and at + 2 < n):
            end = page.find(">", at)
            at = end + 1 if end >= 0 else n
            continue
        if not (following.isascii() and following.isalpha()) and following != "/":
            raw.append("<")
            at += 1
            continue
        tag = _TAG.match(page, at)
        if not tag:
            break
        at = tag.end()
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        if name in _INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif name == "br":
                raw.append(" ")
            continue
        yield from text()
        if closing:
            last = lambda of: places[of][-1] if places.get(of) else -1
            if last(name) > max((last(wall) for wall in _WALLS.get(name, ())), default=-1):
                down = last(name)
                while len(open_) > down:
                    yield from closed()
                links = 0
            continue
        links = 0
        while open_ and name in _ENDS.get(open_[-1][0], ()):
            yield from closed()
        if name in _RAW:
            # Its content is no markup and never main text.
            end = _RAW_END[name].search(page, at)
            close = page.find(">", end.end()) if end else -1
            at = close + 1 if close >= 0 else n
        kind = kind_of(name, attributes)
        told = depth < DEPTH or depth == DEPTH and _chrome(kind)
        if told:
            yield "<", kind, 0
        if name in _RAW or name in _VOID:
            if told:
                yield ">", kind, 0
        else:
            places.setdefault(name, []).append(len(open_))
            open_.append((name, kind if told else ""))
            depth += told
    yield from text()
    while open_:
        yield from closed()


def wrapper_of(page: str) -> Node:
    """The wrapper of one page alone."""
    root = Node(1)
    path: list[tuple[Node, list[str]]] = [(root, [])]
    for sign, value, linked in stream(page):
        node, order = path[-1]
        if sign == "<":
            order.append(value)
            path.append((Node(1), []))
        elif sign == ">":
            node.groups = _folded(order)
            path.pop()
            parent = path[-1][0]
            if value in parent.inside:
                _add(parent.inside[value], node, 0)
            else:
                parent.inside[value] = node
        else:
            _texts(node, xxhash.xxh64_intdigest(value) >> 1 or 1, len(value), linked)
    root.groups = _folded(path[0][1])
    return root


def _texts(node: Node, text: int | None, chars: int, linked: int) -> None:
    if text is not None:
        node.text = text if node.text in (None, text) else 0
    node.chars += chars
    node.linked += linked


def _folded(order: list[str]) -> list[tuple[list[str], bool]]:
    """Groups of a sequence of kinds: from the first to the last place of a kind that comes again is one repeated group."""
    return _grouped([([kind], False) for kind in order])


def _grouped(groups: list[tuple[list[str], bool]]) -> list[tuple[list[str], bool]]:
    last = {kind: i for i, (kinds, _) in enumerate(groups) for kind in kinds}
    out, i = [], 0
    while i < len(groups):
        end, k = i, i
        repeated = groups[i][1]
        while k <= end:
            end = max(end, *(last[kind] for kind in groups[k][0]))
            k += 1
        if end > i:
            repeated = True
        out.append((list(dict.fromkeys(kind for kinds, _ in groups[i : end + 1] for kind in kinds)), repeated))
        i = end + 1
    return out


def _add(node: Node, other: Node, pages: int = 1) -> Node:
    """Align ``other`` with ``node`` and keep the result in ``node``; ``pages`` is 0 for two elements of one page."""
    node.pages += other.pages * pages
    _texts(node, other.text, other.chars, other.linked)
    node.groups = _aligned(node.groups, other.groups)
    for kind, found in other.inside.items():
        if kind in node.inside:
            _add(node.inside[kind], found, pages)
        else:
            node.inside[kind] = found
    return node


def _aligned(a: list[tuple[list[str], bool]], b: list[tuple[list[str], bool]]) -> list[tuple[list[str], bool]]:
    """One sequence of groups for both: groups that share a kind meet, others stay between them."""
    if a == b:
        return a
    out, where = [], {kind: i for i, (kinds, _) in enumerate(a) for kind in kinds}
    done = 0
    for kinds, repeated in b:
        meets = [where[kind] for kind in kinds if kind in where]
        if meets:
            # What only the other side has before this place comes first; a place already passed comes again.
            out += a[done : max(meets) + 1]
            done = max(done, max(meets) + 1)
        out.append((kinds, repeated))
    return _merged(out + a[done:])


def _merged(groups: list[tuple[list[str], bool]]) -> list[tuple[list[str], bool]]:
    """Groups that meet side by side are one; what is left of kinds that come again is a repeated group."""
    out: list[tuple[list[str], bool]] = []
    for kinds, repeated in groups:
        if out and set(out[-1][0]) & set(kinds):
            before, again = out.pop()
            out.append((list(dict.fromkeys([*before, *kinds])), again or repeated or len({*before, *kinds}) > 1))
        else:
            out.append((kinds, repeated))
    return _grouped(out)


def _chrome(kind: str) -> bool:
    """Whether an element holds no main text: by name, role, or a class word that is or begins or ends with such a part."""
    name, *words = kind.split(".")
    if name in _CHROME:
        return True
    if name in ("html", "body", "main"):
        return False
    if any(w in _CHROME_WORDS or w[5:] in _CHROME_ROLES and w.startswith("role=") for w in words):
        return True
    # An article says in its class what it has (``no-comments``), others what they are.
    parts = [] if name == "article" else [_WORDS.findall(w) for w in words]
    return any({p[0], p[-1]} & _CHROME_WORDS and p[0] not in _HAVING for p in parts if p)


def _rank(kind: str) -> int:
    """3: an article, 2: the main part, 1: anything else."""
    parts = kind.split(".")
    if parts[0] == "article" or _ARTICLE_WORDS & set(parts[1:]) or "role=article" in parts:
        return 3
    return 2 if parts[0] == "main" or "role=main" in parts else 1


def _shares(node: Node) -> tuple[int, int]:
    """Characters in slots and in constants below ``node``, without the parts that are never main text."""
    found = [_shares(inner) for kind, inner in node.inside.items() if not _chrome(kind)]
    own = (0, node.chars) if node.text else (node.chars, 0)
    return own[0] + sum(f[0] for f in found), own[1] + sum(f[1] for f in found)


def labels_of(root: Node) -> dict[str, int]:
    """Rank of every path of a wrapper whose own texts can be main text: 3 article, 2 main part, 1 densest part."""
    out: dict[str, int] = {}
    texts: dict[str, int] = {}
    slots, constants = _shares(root)

    def visit(node: Node, path: str, rank: int) -> int:
        """Characters that can be main text in and below ``node``."""
        # Where constants are most of the text, the pages are copies and no constant is told from an article.
        template = bool(node.text) and node.pages > 1 and slots > constants
        menu = node.linked * LINK_SHARE[1] > node.chars * LINK_SHARE[0]
        own = 0 if template or menu else node.chars
        if rank > 1:
            out[path] = rank
        elif own:
            out[path] = 1
        below = own
        for kind, inner in node.inside.items():
            if not _chrome(kind):
                below += visit(inner, f"{path}/{kind}", max(rank, _rank(kind)))
        texts[path] = below
        return below

    visit(root, "", 1)
    # Without article or main part: from the top go down as long as one element holds nearly all texts.
    dense, node = "", root
    while True:
        inner = max((k for k, within in node.inside.items() if within.inside and not _chrome(k)), key=lambda k: (texts[f"{dense}/{k}"], k), default=None)
        if inner is None or 10 * texts[f"{dense}/{inner}"] < 9 * texts[dense]:
            break
        dense, node = f"{dense}/{inner}", node.inside[inner]
    return {path: rank for path, rank in out.items() if rank > 1 or path == dense or path.startswith(dense + "/")}


def extract(page: str, labels: dict[str, int]) -> str:
    """The main text of a page by its host's labels: the blocks of the best rank it has, one on each line."""
    found: dict[int, list[str]] = {}
    path = [""]
    for sign, value, _ in stream(page):
        if sign == "<":
            path.append(f"{path[-1]}/{value}")
        elif sign == ">":
            path.pop()
        elif rank := labels.get(path[-1]):
            found.setdefault(rank, []).append(value)
    return "\n".join(found[max(found)]) if found else ""


def _host() -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _sent(found: Iterable[tuple[str, Node]]) -> pa.RecordBatch:
    """Rows of wrappers; part is the salt of the first merge."""
    hosts, roots = zip(*found, strict=True)
    plain = [json.dumps(root.plain(), separators=(",", ":")) for root in roots]
    parts = pa.array([xxhash.xxh64_intdigest(p) % SALTS for p in plain], pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(hosts), parts, pa.array(plain)], ["host", "part", "wrapper"])


def _folds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A wrapper of each host of a task's pages; all are sent when there are many."""
    held: dict[str, Node] = {}

    for batch in slices(batches, "html"):
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            root = wrapper_of(page or "")
            held[host] = _add(held[host], root) if host in held else root
            if len(held) >= HELD_HOSTS:
                yield _sent(held.items())
                held.clear()
    if held:
        yield _sent(held.items())


def _joined(key: tuple, rows: pa.Table) -> pa.Table:
    """One wrapper of all those of a group."""
    root = None
    for plain in sorted(rows.column("wrapper").to_pylist()):
        here = Node.of(json.loads(plain))
        root = here if root is None else _add(root, here)
    return pa.Table.from_batches([_sent([(key[0].as_py(), root)])])


def infer(pages: DataFrame) -> DataFrame:
    """host and wrapper (as JSON) of all pages (url, html)."""
    schema = "host string, part int, wrapper string"
    parts = bounded(pages).select(_host().alias("host"), F.col("html").cast("string")).mapInArrow(_folds, schema)
    salted = parts.groupBy("host", "part").applyInArrow(_joined, schema)
    return salted.groupBy("host").applyInArrow(_joined, schema).select("host", "wrapper")


def labelled(wrappers: DataFrame) -> DataFrame:
    """host and labels (JSON of path to rank) of wrappers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [json.dumps(labels_of(Node.of(json.loads(w)))) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(labels, pa.string())], ["host", "labels"])

    return wrappers.mapInArrow(run, "host string, labels string")


def run(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    known = stored(labelled(infer(pages)), "labels")
    size = known.agg(F.sum(F.length("host") + F.length("labels"))).first()[0] or 0
    sized = F.broadcast(known) if size <= BROADCAST_BYTES else known.hint("merge")
    rows = pages.select("page_id", "url", F.col("html").cast("string"), _host().alias("host")).join(sized, "host", "left")
    kind = pages.schema["page_id"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, labels = None, {}
        for batch in slices(batches, "html"):
            out = []
            for page, found in zip(batch.column("html").to_pylist(), batch.column("labels").to_pylist(), strict=True):
                if found != plain:
                    plain, labels = found, json.loads(found or "{}")
                out.append(extract(page or "", labels))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    done = rows.select("page_id", "url", "html", "labels").mapInArrow(texts, f"page_id {kind}, url string, text string")
    return done.withColumn("n_chars", F.length("text").cast("long"))
