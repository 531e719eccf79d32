"""Main text of web pages by equivalence-class template deduction.

A token is a container tag with the path of containers around it, or a block
of text (k-th block of that text in that path). Its occurrence vector over the
pages of a host is summed into a random linear sketch (equal vectors, equal
sketches), so vectors are compared without gathering a host's pages. Tokens of
one vector form an equivalence class. A class is valid if it has several
tokens, each once per page that has it, in at least SUPPORT of the host's
pages; a container also needs valid containers around it, so valid classes
nest into the host's template. The template node that holds the article (by
its name, else by its share of the text) is the slot that is extracted. Inside
it, the template's own blocks (in valid classes of MIN_PAGES pages) and
boilerplate nodes are left out, and all else stays. Blocks of a class hold
less than COPY_SHARE of the text of its pages: more is an article in copies,
not a template. On a page where a class's blocks come in another order than
on the host's other pages they stay, and so do the blocks of a page that has
no others. A page without the slot is searched in the same way by itself, and
so is each page whose slot is not an article: a layout of few pages keeps its
article. A path whose class names have digits (post-123) counts under its
steady form (``*``) too.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import batches, mapped, saved
from registrar.llm.url_filter import host

#: Share of a host's pages that a template token occurs in, in hundredths.
SUPPORT = 50
#: Share of a page's text that a template node must hold to be the slot by size, in hundredths.
TEXT_SHARE = 80
#: Pages that blocks of text must recur on to be the template's: what two pages have in common may be a quotation.
MIN_PAGES = 3
#: Share of its pages' text from which a class of blocks is an article in copies, in hundredths.
COPY_SHARE = 50
#: Slots and template blocks, over all hosts, that may be broadcast; beyond it the same join is shuffled.
BROADCAST_ITEMS = 200_000
#: Tokens that a task sums before it hands them on.
TASK_TOKENS = 100_000

# Fixed values of HTML: tag roles.
_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "xmp", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_CONTAINERS = {"html", "head", "body", "main", "article", "section", "div", "nav", "header", "footer", "aside", "form",
               "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "blockquote", "figure", "details",
               "dialog", "menu", "select", "button", "fieldset", "object", "center"}
_BLOCKS = _CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "br", "hr", "caption", "figcaption",
                         "address", "summary", "hgroup", "option", "legend"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that end an open paragraph.
_END_P = _CONTAINERS - {"html", "head", "body", "thead", "tbody", "tfoot", "tr", "td", "th", "select", "button", "object"} | _HEADINGS | {
    "p", "li", "dt", "dd", "pre", "hr", "figcaption", "address", "summary", "hgroup"}
#: Elements that a tag of the name ends, up to the next element of the second set.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "option": ({"option"}, {"select"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "tr": ({"tr"}, {"table"}), **{t: ({"thead", "tbody", "tfoot", "tr"}, {"table"}) for t in ("thead", "tbody", "tfoot")}}
_BOILERPLATE_TAGS = {"head", "nav", "header", "footer", "aside", "form", "dialog", "menu", "select", "button", "fieldset", "object"}
_BOILERPLATE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion",
                      "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "sidebar", "header", "footer",
                      "notice", "cookie", "cookies", "consent", "popup", "modal", "newsletter", "subscribe", "signup", "share",
                      "sharing", "social", "related", "comment", "comments", "replies", "reply", "respond", "login", "search",
                      "widget", "disclaimer", "disqus", "skip", "toolbar", "pagination"}
#: Words that leave a name of boilerplate words what it is: site-footer, related-posts.
_NEUTRAL_WORDS = {"site", "page", "main", "primary", "secondary", "global", "mobile", "top", "bottom", "list", "box", "bar", "block", "area",
                  "section", "container", "wrapper", "link", "links", "button", "buttons", "item", "items", "form", "post", "posts", "entry",
                  "article", "articles"}
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NUMBERED, _DIGIT = re.compile(r"\.[^/]*\d"), re.compile(r"\d")
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)


def _node(name: str, attributes: str) -> tuple[str, bool]:
    """An element's name in a path, and whether it is boilerplate: by its
    tag, or by a class, id or role that says so as a whole. The id of a heading
    or link is an anchor, and a heading may be called a header."""
    named, label = False, name
    for kind, a, b, c in _NAMED.findall(attributes):
        value = (a or b or c).strip().lower()
        for one in value.split():
            words = set(re.split(r"[_-]+", one)) - {""}
            if kind.lower() == "id" and (name in _HEADINGS or name == "a") or name in _HEADINGS and "header" in words:
                continue
            named = named or bool(words & _BOILERPLATE_WORDS) and words <= _BOILERPLATE_WORDS | _NEUTRAL_WORDS
        if kind.lower() == "class" or (kind.lower() == "role" and value == "main"):
            label += "." + ".".join(re.sub(r"[./]", "_", value).split())
    plain = name in ("html", "body", "main", "article")
    if name in ("html", "body"):
        label = name  # one a page, and their classes often name the page
    return label, name in _BOILERPLATE_TAGS or not plain and named


def _events(page: str) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, boilerplate by itself) of a page: ``open`` with the path
    of a container or of another element that is boilerplate, ``close`` with
    the path it leaves, ``text`` (raw), ``break`` at block boundaries."""
    stack: list[tuple[str, str, bool]] = []  # tag, path, whether it is a node of the path

    def last(names: set[str], until: set[str]) -> int | None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                return k
            if stack[k][0] in until:
                return None
        return None

    def leave(depth: int | None) -> Iterator[tuple[str, str, bool]]:
        if depth is not None:
            nodes = [path for _, path, node in stack[depth:] if node]
            if nodes:
                yield "close", nodes[0], False
            del stack[depth:]

    at = 0
    while True:
        tag = _TAG.search(page, at)
        if (tag.start() if tag else len(page)) > at:
            yield "text", page[at:tag.start() if tag else len(page)], False
        if tag is None:
            return
        at = tag.end()
        closing, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if name in _RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in _BLOCKS:
            yield "break", "", False
        if closing:
            if name in _CONTAINERS:
                yield from leave(last({name}, set()))
            elif name not in _VOID:  # ends within its container
                yield from leave(last(_HEADINGS if name in _HEADINGS else {name}, _CONTAINERS))
            continue
        if name in _END_P:
            yield from leave(last({"p"}, _CONTAINERS))
        if name in _HEADINGS and stack and stack[-1][0] in _HEADINGS:
            yield from leave(len(stack) - 1)
        if name in _ENDS:
            yield from leave(last(*_ENDS[name]))
        if name in _VOID or attributes.endswith("/"):
            continue
        label, boilerplate = _node(name, attributes)
        outer, node = stack[-1][1] if stack else "", name in _CONTAINERS or boilerplate
        path = (f"{outer}/{label}" if outer else label) if node else outer
        stack.append((name, path, node))
        if node:
            yield "open", path, boilerplate


def _rank(path: str) -> int:
    """How surely a path's last node is the article, by its name."""
    name, _, classes = path.rpartition("/")[2].partition(".")
    return 3 if name == "article" else 2 if name == "main" or "main" in classes.split(".") else 0


def _around_article(events: list[tuple[str, str, bool]]) -> set[int]:
    """Events that open boilerplate around the article: where no article or
    main node is outside boilerplate, one within that has more text than all
    that is outside."""
    stack: list[tuple[str, bool, int]] = []  # path, boilerplate by itself, event
    nodes: dict[str, list] = {}  # occurrences, characters, boilerplate around
    whole = 0
    for at, (kind, value, own) in enumerate(events):
        if kind == "open":
            stack.append((value, own, at))
            if _rank(value):
                node = nodes.setdefault(value, [0, 0, []])
                node[0] += 1
                node[2] = [k for _, o, k in stack if o]
        elif kind == "close":
            while stack.pop()[0] != value:
                pass
        elif kind == "text":
            n = len(value.strip())
            for path, o, _ in reversed(stack):
                if path in nodes:
                    nodes[path][1] += n
                if o:
                    break
            else:
                whole += n
    once = [(_rank(p), chars, p, around) for p, (n, chars, around) in nodes.items() if n == 1]
    if not all(around for *_, around in once):
        return set()
    return set(max((x for x in once if x[1] > whole), default=(0, 0, "", []))[3])


def walk(page: str) -> list[tuple[str, str, bool]]:
    """(kind, value, within boilerplate) events of a page; what is around the
    article is no boilerplate."""
    events = list(_events(page))
    article = _around_article(events)
    found, stack = [], [("", False)]
    for at, (kind, value, own) in enumerate(events):
        if kind == "open":
            stack.append((value, stack[-1][1] or own and at not in article))
        found.append((kind, value, stack[-1][1]))
        if kind == "close":
            while stack.pop()[0] != value:
                pass
    return found


def _steady(path: str) -> str:
    """A path with ``*`` for the class names that have digits."""
    if not _NUMBERED.search(path):
        return path
    labels = []
    for label in path.split("/"):
        name, *classes = label.split(".")
        kept = [c for c in classes if not _DIGIT.search(c)]
        labels.append(".".join([name, *kept, *["*"] * (len(kept) < len(classes))]))
    return "/".join(labels)


def page_tokens(events: list[tuple[str, str, bool]]) -> dict[str, list[int]]:
    """Occurrences and visible characters within, by container path (and its
    steady form) that is not boilerplate, of a page's events."""
    found: dict[str, list[int]] = {"": [1, 0]}
    path: list[list] = [["", 0]]  # open paths, with the characters read directly or in closed elements within

    def leave() -> None:
        value, chars = path.pop()
        path[-1][1] += chars
        if chars:
            found[value][1] += chars

    for kind, value, hidden in events:
        if kind == "open":
            path.append([value, 0])
            if not hidden:
                found.setdefault(value, [0, 0])[0] += 1
        elif kind == "close":
            while path[-1][0] != value:
                leave()
            leave()
        elif kind == "text" and not hidden:
            path[-1][1] += len(value)
    while len(path) > 1:
        leave()
    found[""][1] = path[0][1]
    for p, t in list(found.items()):
        if (steady := _steady(p)) != p:
            known = found.setdefault(steady, [0, 0])
            found[steady] = [a + b for a, b in zip(known, t)]
    return found


def _choose(nodes: dict[str, list[int]], slot: str | None) -> str:
    """The article's node among (occurrences, characters) of one page: its
    host's slot, if the page has it and no node is surer by its name."""
    whole = max(1, nodes[""][1])
    there = slot is not None and slot in nodes
    once = [p for p, (n, chars) in nodes.items() if n == 1 and (
        _rank(p) > _rank(slot) if there else _rank(p) or 100 * chars >= TEXT_SHARE * whole)]
    return max(once, key=lambda p: (_rank(p), nodes[p][1] if _rank(p) else p.count("/"), p), default=slot if there else "")


def page_blocks(events: list[tuple[str, str, bool]], slot: str = "") -> list[tuple[int, str, bool]]:
    """(token, text, within the slot) of a page's blocks that are not
    boilerplate, in page order."""
    found: list[tuple[int, str, bool]] = []
    seen: dict[str, int] = {}
    path: list[tuple[str, bool]] = [("", not slot)]  # open paths, and whether they are the slot or within it
    parts: list[str] = []
    start = path[0]  # where the block's text began

    def end() -> None:
        line = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if line:
            name = f"{_steady(start[0])}\0{line}"
            seen[name] = k = seen.get(name, 0) + 1
            found.append((xxhash.xxh3_64_intdigest(f"{name}\0{k}".encode("utf-8", "surrogatepass")) - (1 << 63), line, start[1]))

    for kind, value, hidden in events:
        if kind == "text":
            if not hidden:
                if not parts:
                    start = path[-1]
                parts.append(value)
        elif kind == "break":
            end()
        elif kind == "open":
            path.append((value, path[-1][1] or value == slot or _steady(value) == slot))
        elif kind == "close":
            while path.pop()[0] != value:
                pass
    end()
    return found


def main_text(page: str | None, slot: str | None, template: Iterable[dict[str, int]] = ()) -> str:
    """Text of a page within its template's slot, without the template's own
    blocks (block, class, place)."""
    events = walk(page or "")
    slot = _choose(page_tokens(events), slot)
    blocks = page_blocks(events, slot)
    known = {t["block"]: (t["class"], t["place"]) for t in template}
    order: dict[int, list[int]] = {}
    for token, _, _ in blocks:
        if token in known:
            order.setdefault(known[token][0], []).append(known[token][1])
    ordered = {c for c, places in order.items() if all(a < b for a, b in zip(places, places[1:]))}
    within = [(token, line) for token, line, inside in blocks if inside]
    lines = [line for token, line in within if token not in known or known[token][0] not in ordered]
    return "\n".join(lines or (line for _, line in within))


def templates(pages: DataFrame, key: Column) -> DataFrame:
    """(host, slot, template) of every host whose pages share a template."""
    sums = ("s1", "s2", "pages", "opens", "chars", "places", "around")
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("block", pa.int64()), *((c, pa.int64()) for c in sums)])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held: dict[tuple[str, str | None, int | None], list[int]] = {}
            for b in stream:
                for name, page in zip(b.column("host"), b.column("html")):
                    name, page = name.as_py(), page.as_py()
                    draw = xxhash.xxh3_64_intdigest(page or "")  # the page's place in the occurrence vectors
                    events = walk(page or "")
                    blocks = page_blocks(events)
                    around = sum(len(line) for _, line, _ in blocks)
                    tokens = [(path, None, n, chars, 0) for path, (n, chars) in page_tokens(events).items()]
                    tokens += [(None, token, 1, len(line), place) for place, (token, line, _) in enumerate(blocks)]
                    for path, token, n, chars, place in tokens:
                        t = held.setdefault((name, path, token), [0] * len(sums))
                        for k, v in enumerate((n * (draw & 0x7FFFFFFF), n * (draw >> 33), 1, n, chars, place, around)):
                            t[k] += v
                    if len(held) > TASK_TOKENS:
                        yield from ((k + tuple(t), 100) for k, t in held.items())
                        held = {}
            yield from ((k + tuple(t), 100) for k, t in held.items())
        return batches(rows(), schema)

    parts = pages.select(key.alias("host"), "html").transform(
        mapped, run, "host string, path string, block bigint, " + ", ".join(f"{c} bigint" for c in sums))
    # a block of fewer than MIN_PAGES pages is no template's, whatever its class
    tokens = saved(parts.groupBy("host", "path", "block").agg(*(F.sum(c).alias(c) for c in sums))
                   .where(F.col("block").isNull() | (F.col("pages") >= MIN_PAGES)), "tokens")
    whole = tokens.where("path = ''").select("host", F.col("pages").alias("host_pages"), F.col("chars").alias("host_chars"))
    fit = (tokens.where("opens = pages").join(whole, "host")
           .where(F.lit(100) * F.col("pages") >= F.lit(SUPPORT) * F.col("host_pages")))
    # a class's tokens share the vector, so they share the sketch and the pages
    classes = (fit.groupBy("host", "s1", "s2", "pages")
               .agg(F.count("*").alias("tokens"), F.sum(F.when(F.col("block").isNotNull(), F.col("chars")).otherwise(0)).alias("own"))
               .where("tokens > 1").drop("tokens"))
    every = saved(fit.join(classes, ["host", "s1", "s2", "pages"]), "valid-tokens")
    blocks = (every.where(F.col("block").isNotNull() & (F.lit(100) * F.col("own") < F.lit(COPY_SHARE) * F.col("around")))
              .select("host", F.struct("block", F.xxhash64("s1", "s2").alias("class"), F.col("places").alias("place")).alias("one"))
              .groupBy("host").agg(F.collect_list("one").alias("template")))  # no more than two pages' blocks, by SUPPORT
    valid = every.where("path is not null").select("host", "path", "chars", "host_chars")
    parts_of = F.split("path", "/")
    around = F.transform(F.sequence(F.lit(1), F.size(parts_of)), lambda k: F.array_join(F.slice(parts_of, F.lit(1), k), "/"))
    steps = valid.select("host", "path", "chars", "host_chars", F.explode(around).alias("outer"))
    nested = (steps.join(valid.select("host", F.col("path").alias("outer")), ["host", "outer"])
              .groupBy("host", "path", "chars", "host_chars").agg(F.count("*").alias("n")).where(F.size(parts_of) == F.col("n")))
    last = F.element_at(F.split("path", "/"), -1)
    rank = (F.when(last.rlike(r"^article(\.|$)"), 3).when(last.rlike(r"^main(\.|$)|\.main(\.|$)"), 2).otherwise(0))
    fits = (rank > 0) | (F.lit(100) * F.col("chars") >= F.lit(TEXT_SHARE) * F.col("host_chars"))
    order = F.struct(rank, F.when(rank > 0, F.col("chars")).otherwise(F.size(parts_of)), "path")
    slots = nested.where(fits).groupBy("host").agg(F.max_by("path", order).alias("slot"))
    return slots.join(blocks, "host", "full")


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html, ...): page_id, url,
    text, n_chars.

    Character references are decoded, white space within a block becomes one
    space, blocks are trimmed and joined by a newline in page order; empty
    blocks go. A null or empty page has an empty text; pages with a null url
    or one without a host form one host. Unclosed tags end where the tag
    around them ends, cut pages with their last character; a paragraph, list item or cell also
    ends where HTML ends it for the next. Repeated rows stay,
    other columns are ignored, an empty table gives an empty one.
    """
    key = host(F.col("url"))
    slots = saved(templates(pages, key), "templates")
    items = slots.agg(F.sum(F.lit(1) + F.coalesce(F.size("template"), F.lit(0)))).first()[0] or 0
    known = F.broadcast(slots) if items <= BROADCAST_ITEMS else slots
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in stream:
                for page, url, source, slot, template in zip(*(b.column(c) for c in ("page_id", "url", "html", "slot", "template"))):
                    text = main_text(source.as_py(), slot.as_py(), template.as_py() or ())
                    yield (page.as_py(), url.as_py(), text, len(text)), len(text)
        return batches(rows(), schema)

    found = pages.select("page_id", "url", "html", key.alias("host")).join(known, "host", "left")
    return found.select("page_id", "url", "html", "slot", "template").transform(mapped, run, "page_id bigint, url string, text string, n_chars bigint")
