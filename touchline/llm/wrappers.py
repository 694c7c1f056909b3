"""HTML extraction: wrappers by union-free regular-expression inference.

Every page becomes a token stream of block elements and texts; its repeats fold into groups, which gives a
union-free regular expression: a sequence of elements and text slots, each of them single, optional (``?``)
or repeated (``+``), nested as the elements are. Streams of one host are aligned one after the other:
equal tokens match, a mismatch becomes an optional or a repeated group, and two texts become a slot, which
remembers whether its text was the same on all pages (template text) or varies (data).

Pages of a host are aligned by variant: those with text under ``article``, those with text under ``main`` only
(either also inside a marked element, if there is no other), and those with neither have a wrapper each, so a page is read by the rules of its own layout.

A wrapper says which slots are the article: those under ``article`` (else ``main``, else the common
ancestor of the varying texts outside links), without the elements that are menus, headers, footers, sidebars,
notices, adverts, forms or comments. Whole class words tell those, and never of ``article``, ``main`` or, where
the page has no other, an element around them; an ``article`` inside another one can be a comment. Template text is dropped only where neither ``article`` nor
``main`` marks the region. Every page is then read through the wrapper of its host and variant.

Alignment covers all pages. Each task merges its own pages by host first; partial wrappers merge by
(host, salt) and then by host, so a host with a third of all pages is spread as any other. Wrappers join the
pages by host; Spark broadcasts them or splits the skewed join as their measured size asks.

Blocks: inline elements are part of their block's text and ``br`` is white space; character references are
decoded, white space becomes one space, empty blocks vanish, blocks are joined by an empty line.

Defined results: null html is an empty page, with empty text; null or odd urls form the host ''; repeated
rows are pages of their own; broken markup is read as far as it goes; an empty table gives an empty table.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import takewhile

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import blank, materialise

# HTML element names.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr img br input".split())
SKIPPED = frozenset("area base col embed hr link meta param source track".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|title|select|button"
#: An opening tag ends these open elements, up to the elements that hold them.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
# Our own lists of what is not the article: elements, words in class, id and role.
NOT_ARTICLE = frozenset("head nav header footer aside form menu dialog fieldset".split())
NOT_ARTICLE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs header masthead "
    "footer contentinfo sidebar complementary widget cookie cookies consent notice alert popup modal overlay newsletter subscribe signup "
    "login search share sharing social related recommended comment comments respond disqus pagination pager copyright toolbar form "
    "site-header site-footer site-navigation main-navigation nav-menu cookie-notice cookie-banner cookie-consent ad-container share-buttons "
    "social-share related-posts related-articles comments-area comment-list comment-form post-comments newsletter-signup search-form login-form".split())

TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
                   r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[/!?][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)",
                   re.DOTALL | re.IGNORECASE)
ATTR = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
#: Elements that mark the article, the first one found on a page counts.
REGIONS = ("article", "main")
VARIANTS = (*REGIONS, *("marked " + n for n in REGIONS))
HOST = r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
SALTS = 32
#: Hosts that a task holds before it emits what it has; bounds memory only.
HELD_HOSTS = 20_000
#: Pages on which a text must be the same to count as the template's.
TEMPLATE_PAGES = 3

# A node of an expression is a list: key, optional, repeated, pages, hash of the only text so far (or None),
# characters, characters in links, children. A slot has key '#', a repeated sequence a key in brackets.
KEY, OPT, REP, PAGES, SAME, CHARS, LINKS, KIDS = range(8)


def element_key(name: str, attrs: str) -> str:
    """Element name with its class, id and role; digits are alike."""
    marks = [entities.unescape(v.strip("\"'")).lower() if v else k.lower() for k, v in ATTR.findall(attrs)] if attrs else []
    return name + "".join("." + re.sub(r"\d+", "0", re.sub(r"\s+", ".", m.strip())) for m in marks if m.strip())


def off_article(key: str) -> bool:
    """Is this element not of the article: by its name, or by a whole word of its class, id or role (an ending
    number aside)?"""
    name, *marks = key.split(".")
    return name in NOT_ARTICLE or "hidden" in marks or name not in ("html", "body") and any(re.sub(r"[-_]?0$", "", m) in NOT_ARTICLE_WORDS for m in marks)


@lru_cache(1 << 16)
def homes(path: tuple[str, ...]) -> tuple[str, ...]:
    """The variants of which a path's text can be the article."""
    names = [key.split(".")[0] for key in path]
    hidden = ["hidden" in key.split(".")[1:] for key in path]
    region = [n in REGIONS and "article" not in names[:i] for i, n in enumerate(names)]  # not an article inside an article
    off = [i for i, key in enumerate(path) if (hidden[i] if region[i] else off_article(key))]
    if not off:
        return (*(n for n in REGIONS if n in names), "")
    if any(hidden[i] or names[i] in NOT_ARTICLE and names[i] not in ("form", "fieldset") for i in off):
        return ()
    return tuple("marked " + n for n in REGIONS if n in names and off[-1] < names.index(n))


def variant(paths: Iterable[tuple[str, ...]]) -> str:
    """The layout of a page or wrapper with texts at these paths."""
    found = {home for path in paths for home in homes(path)}
    return next((v for v in VARIANTS if v in found), "")


def common_path(paths: Iterable[tuple[str, ...]]) -> tuple[str, ...]:
    """The longest path that all paths start with."""
    paths = list(paths)
    return tuple(keys[0] for keys in takewhile(lambda keys: len(set(keys)) == 1, zip(*paths)))


def blocks(html: str) -> Iterator[tuple[tuple[str, ...], str, int] | tuple[tuple[str, ...], None, int]]:
    """The page as a stream: (path, text, link characters) of its texts, (path, None, 0) where an element opens."""
    path: list[str] = []
    names: list[str] = []
    text: list[str] = []
    linked, in_link, last = 0, 0, 0

    def flush():
        nonlocal text, linked
        joined = " ".join(entities.unescape("".join(text)).split())
        found = (tuple(path), joined, linked) if joined else None
        text, linked = [], 0
        return found

    for m in TOKEN.finditer(html):
        if m.start() > last:
            text.append(html[last:m.start()])
            linked += in_link and m.start() - last
        last = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                in_link = 0 if m["close"] else 1
            elif name == "br":
                text.append(" ")
            continue
        if found := flush():
            yield found
        in_link = 0
        if name in SKIPPED:
            continue
        if m["close"]:
            if name in names:
                at = len(names) - 1 - names[::-1].index(name)
                del names[at:], path[at:]
            continue
        if names and names[-1] == "p":
            names.pop(), path.pop()
        if name in ENDS:
            ended, kept_by = ENDS[name]
            at = next((i for i in range(len(names) - 1, -1, -1) if names[i] in ended or names[i] in kept_by), -1)
            if at >= 0 and names[at] in ended:
                del names[at:], path[at:]
        names.append(name)
        path.append(element_key(name, m["attrs"]))
        yield tuple(path), None, 0
        if m["attrs"].rstrip().endswith("/"):
            names.pop(), path.pop()
    text.append(html[last:])
    if found := flush():
        yield found


def expression(html: str) -> list:
    """The page's own union-free expression."""
    return folded(blocks(html))


def folded(stream: Iterable[tuple]) -> list:
    """The expression of a page given as its blocks."""
    root = ["", 0, 0, 1, None, 0, 0, []]
    open_nodes = [root]
    for path, text, links in stream:
        del open_nodes[len(path) + (text is not None):]
        parent = open_nodes[-1]
        if text is None:
            node = [path[-1], 0, 0, 1, None, 0, 0, []]
            open_nodes.append(node)
        else:
            node = ["#", 0, 0, 1, xxhash.xxh64_hexdigest(text), len(text), links, []]
        parent[KIDS].append(node)
    fold(root)
    return root


def fold(node: list) -> None:
    """Repeats among a node's children become one repeated child or group, innermost first."""
    out: list[list] = []
    for kid in node[KIDS]:
        fold(kid)
        out.append(kid)
        again = True
        while again:
            again = False
            for period in (1, 2, 3):
                tail = out[-period:]
                keys = [k[KEY] for k in tail]
                group = "(" + ",".join(keys) + ")"
                if period > 1 and len(out) > period and out[-period - 1][KEY] == group:
                    whole = out[-period - 1]
                    whole[KIDS] = [merge(a, b, True) for a, b in zip(whole[KIDS], tail)]
                    del out[-period:]
                elif len(out) >= 2 * period and [k[KEY] for k in out[-2 * period:-period]] == keys:
                    both = [merge(a, b, True) for a, b in zip(out[-2 * period:-period], tail)]
                    if period == 1:
                        both[0][REP] = 1
                    else:
                        both = [[group, 0, 1, 1, None, 0, 0, both]]
                    out[-2 * period:] = both
                else:
                    continue
                again = True
                break
    node[KIDS] = out


def merge(a: list, b: list, one_page: bool = False) -> list:
    """Alignment of two expressions with equal keys."""
    pages = max(a[PAGES], b[PAGES]) if one_page else a[PAGES] + b[PAGES]
    return [a[KEY], a[OPT] | b[OPT], a[REP] | b[REP], pages, a[SAME] if a[SAME] == b[SAME] else None, a[CHARS] + b[CHARS], a[LINKS] + b[LINKS],
            align(a[KIDS], b[KIDS], one_page)]


def merge_variants(a: dict[str, list], b: dict[str, list]) -> dict[str, list]:
    """Expressions of one host by variant, merged variant by variant."""
    return {k: merge(a[k], b[k]) if k in a and k in b else a.get(k) or b[k] for k in sorted(a.keys() | b.keys())}


def align(a: list[list], b: list[list], one_page: bool) -> list[list]:
    """Longest common subsequence of two token sequences; what one of them lacks becomes optional."""
    ka, kb = [n[KEY] for n in a], [n[KEY] for n in b]
    if ka == kb:
        return [merge(x, y, one_page) for x, y in zip(a, b)]
    common = [[0] * (len(kb) + 1) for _ in range(len(ka) + 1)]
    for i in range(len(ka) - 1, -1, -1):
        for j in range(len(kb) - 1, -1, -1):
            common[i][j] = common[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(common[i + 1][j], common[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(ka) or j < len(kb):
        if i < len(ka) and j < len(kb) and ka[i] == kb[j]:
            out.append(merge(a[i], b[j], one_page))
            i, j = i + 1, j + 1
        elif j == len(kb) or i < len(ka) and common[i + 1][j] >= common[i][j + 1]:
            out.append([ka[i], 1, *a[i][REP:]])
            i += 1
        else:
            out.append([kb[j], 1, *b[j][REP:]])
            j += 1
    return out


def as_regex(node: list) -> str:
    """The expression in its usual notation, for people."""
    inner = " ".join(as_regex(k) for k in node[KIDS])
    own = "#" if node[KEY] == "#" else f"({inner})" if node[KEY][:1] in ("(", "") else f"<{node[KEY]}> {inner} </>"
    mark = ("+" if node[REP] else "") + ("?" if node[OPT] else "")
    return f"({own}){mark}" if mark else own


def holder(path: tuple[str, ...]) -> tuple[str, ...]:
    """The element whose own blocks a path's text belongs to."""
    return path[:-1] if path and path[-1].split(".")[0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "ul", "ol") else path


class Rules:
    """Which slots of a wrapper are the article: element paths, and template texts to leave out."""

    def __init__(self, wrapper: list):
        slots: dict[tuple[str, ...], list[list]] = {}

        def walk(node: list, path: tuple[str, ...]) -> None:
            for kid in node[KIDS]:
                if kid[KEY] == "#":
                    slots.setdefault(path, []).append(kid)
                elif kid[KEY][:1] == "(":
                    walk(kid, path)
                else:
                    walk(kid, (*path, kid[KEY]))

        walk(wrapper, ())
        named = variant(slots)
        slots = {p: own for p, own in slots.items() if named in homes(p)}
        self.template: set[str] = set()
        if named:
            self.paths = set(slots)
            return
        varied = any(s[SAME] is None for own in slots.values() for s in own)
        if varied:
            self.template = {s[SAME] for own in slots.values() for s in own if s[SAME] and s[PAGES] >= TEMPLATE_PAGES}
        small = wrapper[PAGES] < TEMPLATE_PAGES
        weight: dict[tuple[str, ...], int] = {}  # varying text by holder
        unlinked: dict[tuple[str, ...], int] = {}
        for path, own in slots.items():
            at = holder(path)
            weight[at] = weight.get(at, 0) + sum(s[CHARS] - 2 * s[LINKS] for s in own if not (varied and s[SAME] and (small or s[PAGES] >= TEMPLATE_PAGES)))
            unlinked[at] = unlinked.get(at, 0) + sum(s[CHARS] - 2 * s[LINKS] for s in own)
        dense = max(sorted(weight), key=lambda p: weight[p], default=())
        region = common_path([dense, *(p for p in weight if weight[p] > 0)])
        self.paths = {p for p in slots if p[:len(dense)] == dense or p[:len(region)] == region and unlinked[holder(p)] > 0}

    def text(self, html: str) -> str:
        return self.read(blocks(html))

    def read(self, stream: Iterable[tuple]) -> str:
        found = [text for path, text, _ in stream if text is not None and path in self.paths]
        if self.template:
            found = [t for t in found if xxhash.xxh64_hexdigest(t) not in self.template]
        return "\n\n".join(found)


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), HOST, 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) inferred from all of ``pages`` (host, html); the wrapper as JSON, by variant."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % SALTS
        held: dict[str, dict[str, list]] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([salt] * len(held), pa.int32()),
                                               pa.array([json.dumps(w) for w in held.values()], pa.string())], names=["host", "salt", "wrapper"])

        for batch in batches:
            for host, html in zip(batch.column(0), batch.column(1)):
                host, stream = host.as_py(), list(blocks(html.as_py()))
                own = {variant(path for path, text, _ in stream if text is not None): folded(stream)}
                held[host] = merge_variants(held[host], own) if host in held else own
            if len(held) > HELD_HOSTS:
                yield out()
                held = {}
        if held:
            yield out()

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [json.loads(w) for w in pdf["wrapper"].sort_values()]
        whole = parts[0]
        for part in parts[1:]:
            whole = merge_variants(whole, part)
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [json.dumps(whole)]})

    own = pages.select("host", "html").mapInArrow(partial, "host string, salt int, wrapper string")
    return own.groupBy("host", "salt").applyInPandas(combine, "host string, wrapper string").groupBy("host").applyInPandas(combine, "host string, wrapper string")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), blank(F.col("html")).alias("html"))
    found = materialise(wrappers(rows), "wrappers").withColumnRenamed("host", "_host")
    known = rows.join(found, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "wrapper")
    schema = [f for f in rows.schema.fields if f.name in ("page_id", "url")]
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", text string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules: dict[str, dict[str, Rules]] = {}
        for batch in batches:
            texts = []
            for html, wrapper in zip(batch.column(2), batch.column(3)):
                wrapper = wrapper.as_py()
                if wrapper not in rules:
                    if len(rules) > 1000:
                        rules.clear()
                    rules[wrapper] = {k: Rules(w) for k, w in json.loads(wrapper).items()}
                stream = list(blocks(html.as_py()))
                texts.append(rules[wrapper][variant(path for path, text, _ in stream if text is not None)].read(stream))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return known.mapInArrow(read, kind)
