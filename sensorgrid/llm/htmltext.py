"""Main-text extraction from HTML with a site style tree.

1. Every page is parsed into its block-level tree (:func:`parse_page`): a node is an element
   with its class and id names, inline markup belongs to the block around it, and a block's
   text has its white space folded.
2. The trees of a host are merged by node path (:func:`style_tree`). A node that has children
   is a presentation node: with p_i the share of its m pages on which it has its i-th sequence
   of children, its own importance is the entropy -sum p_i log_m p_i (1 if m = 1). A node with
   text is a content node: 1 minus the mean of log_m of the number of pages that share a
   content, times the share of its text on the host that is outside links. A link's label says what another page holds, so a list of links
   is unimportant, however its labels change from page to page. A
   presentation node's composite importance adds its children's, weighted by how often they
   occur: (1 - g^l) * own + g^l * children, l being its number of child sequences.
3. On each page, branches that are of low importance all through go (:func:`extract`): navigation that every page
   repeats has one presentation and few contents, an article has as many as pages.

The markup's own words count beside the statistics: elements that are never content (scripts,
forms, navigation, footers, and blocks whose class, id or role says advert, sidebar, notice,
comments, ...) are unimportant on any host; where a page marks its article or main part, the
rest of the page is; and unnamed prose blocks of a marked article stay, however often other
pages repeat them. A page is never emptied by importance alone.

Class and id names are weaker than tags and roles, so they are settled when the page is known
(:meth:`Page.settle`). They never mark html, body, main, or an element that contains an
article or main without such a name. A name of layout or state (``content-sidebar``,
``elementor-widget``, ``comments-open``) never marks an article, and nothing on a page where
its elements together hold over half of the prose (text outside links; that of the marked
parts if there are any). A name that says what the block is (``sidebar``, ``cookie-banner``,
``comment``) marks an article only beside another one without such a name, and holds
otherwise unless no prose would be left. Branches so released are left to the importance.

Scale: a page adds one count a node to the host's statistics, combined map-side, so a host
with a third of all pages is a few rows per task. Levels of the tree are joined bottom-up, one
job a level down to :data:`DEPTH`; what lies deeper is solved per host and branch below that
level, in one task each over the branch's distinct nodes (not pages). Pages meet their host's low nodes by a join that is broadcast up to
:data:`BROADCAST_NODES` nodes.

Defined cases: null or empty html gives an empty text; a null or odd url is a host of its own
name; repeated rows count as pages of their own; broken markup is read as far as it goes; very long pages are read whole; an
empty table gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

import html as entities
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgrid.llm.common import small_batches, stash

#: Levels of the tree that are jobs of their own. Nodes are kept at any depth.
DEPTH = 24
DECAY = 0.9
THRESHOLD = 0.3
BROADCAST_NODES = 200_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
NOISE_TAGS = frozenset("nav footer aside form script style noscript template iframe svg canvas object embed audio video map menu dialog button select option "
                       "optgroup datalist textarea input fieldset title head xmp noembed noframes math".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption br hr article main".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Whole names, and beginnings of names, of blocks that are not the article.
NOISE_NAMES = frozenset("ad ads adv advert adverts menu menus nav footer header masthead sidebar aside notice notices banner cookie cookies consent gdpr popup modal overlay "
                        "login signup signin search share sharing social comment comments commentlist reply replies respond disqus related recommended widget widgets "
                        "breadcrumb breadcrumbs pagination pager toolbar promo sponsor sponsored newsletter subscribe subscription paywall toc form".split())
#: Of these, names of any block of a page builder: weak, as are names with a noise word at one end only.
WEAK_NAMES = frozenset("widget widgets form modal overlay".split())
DISCUSSION = frozenset("comment comments reply replies respond disqus".split())
STATES = frozenset("open closed enabled disabled allowed on off".split())
NOISE_STARTS = ("advert", "sidebar", "navbar", "navigation", "breadcrumb", "cookie", "newsletter", "sponsor", "promo", "comment-", "comments-", "googlead", "adsby")
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
         "thead": ("tr", "td", "th", "thead", "tbody", "tfoot"), "tbody": ("tr", "td", "th", "thead", "tbody", "tfoot"), "tfoot": ("tr", "td", "th", "thead", "tbody", "tfoot")}
#: Where the search for an element that ends by itself stops.
_SCOPE = frozenset("table ul ol dl body html article section div main td th button object".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[^\s]+")
_DIGITS = re.compile(r"\d+")
_PART = re.compile(r"[-_]+")


def attributes(raw: str) -> dict[str, str]:
    if not raw or raw.isspace() or raw == "/":
        return {}
    return {k.lower(): entities.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(raw)}


def noisy(tag: str, attrs: dict[str, str]) -> bool:
    """Whether the element's own markup says that it is not part of an article."""
    if tag in NOISE_TAGS:
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    if attrs.get("role", "").lower() in NOISE_ROLES:
        return True
    return False


def noise_names(tag: str, attrs: dict[str, str]) -> tuple[str, ...]:
    """The class and id names, digits folded, that call an element something else than an article."""
    if not attrs or tag in ("html", "body", "main") or attrs.get("role", "").lower() == "main":
        return ()
    found = []
    for name in _NAME.findall(_DIGITS.sub("#", f"{attrs.get('class', '')} {attrs.get('id', '')}").lower()):
        parts = _PART.split(name)
        if name.startswith(NOISE_STARTS) or name in NOISE_NAMES or (
                len(parts) > 1 and (parts[0] in NOISE_NAMES or parts[-1] in NOISE_NAMES) and parts[0] not in ("with", "has", "no")):
            found.append(name)
    return tuple(found)


def says_what(name: str) -> bool:
    """Whether a noise name says what the block is, rather than how the page is laid out."""
    parts = [p for p in _PART.split(name) if p not in ("", "#")]
    if len(parts) > 1 and parts[0] in DISCUSSION:
        return parts[-1] not in STATES
    return bool(parts) and all(p in NOISE_NAMES for p in parts) and not WEAK_NAMES.intersection(parts)


class Page:
    """The block tree of one page, as flat lists. Nodes: path digest, parent, child sequence,
    whether noise, inside a marked main part, kept there whatever its importance. Blocks: node
    and text, in page order."""

    def __init__(self):
        self.path: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.branch: list[int] = []
        self.noise: list[bool] = []
        self.main: list[bool] = []
        self.keep: list[bool] = []
        self.named: list[tuple[str, ...]] = []
        self.article: list[bool] = []
        self.prose: list[int] = []  # characters outside links, and in them
        self.linked: list[int] = []
        self.children: list[list[int]] = []
        self.blocks: list[tuple[int, str]] = []
        self._known: dict[tuple, int] = {}

    def kinds(self) -> list[int]:
        """1: noise, 2: inside a main part, 4: kept."""
        return [n + 2 * m + 4 * k for n, m, k in zip(self.noise, self.main, self.keep)]

    def node(self, parent: int, name: str, noise: bool = False, main: bool = False, prose: bool = False, named: tuple[str, ...] = ()) -> int:
        """Elements of one name under one parent are one node of the page."""
        key = (parent, name, noise, bool(named))
        i = self._known.get(key)
        if i is None:
            i = self._known[key] = len(self.path)
            above = self.path[parent] if parent >= 0 else 0
            self.path.append(xxhash.xxh64_intdigest(f"{above}>{name}>{noise or bool(named)}>{noise and bool(named)}".encode()) >> 1)
            self.parent.append(parent)
            up = parent >= 0
            self.depth.append(self.depth[parent] + 1 if up else 0)
            # the path of the ancestor, or node, at the first level below DEPTH; 0 above
            self.branch.append(0 if self.depth[i] <= DEPTH else self.path[i] if self.depth[i] == DEPTH + 1 else self.branch[parent])
            self.noise.append(noise or up and self.noise[parent])
            self.main.append(main or up and self.main[parent])
            self.keep.append(main or prose and up and self.keep[parent])
            self.named.append(named)
            self.article.append(main)
            self.prose.append(0)
            self.linked.append(0)
            self.children.append([])
        if parent >= 0 and (not self.children[parent] or self.children[parent][-1] != i):
            self.children[parent].append(i)
        return i

    def settle(self) -> None:
        """Noise by names, now that the whole page is known."""
        n, parent = len(self.path), self.parent
        soft = [i for i in range(n) if self.named[i] and not self.noise[i]]
        if not soft:
            return
        # parts marked without a noise name of their own, and what contains one
        clean = [self.article[i] and not self.noise[i] and not any(map(says_what, self.named[i])) for i in range(n)]
        inside, holds = [False] * n, clean[:]
        for i in range(n):
            inside[i] = clean[i] or i > 0 and inside[parent[i]] and not (self.article[i] and not clean[i])
        counted = [0 if self.noise[i] else self.prose[i] for i in range(n)]
        marked = any(c and x for c, x in zip(counted, inside))
        if marked:
            counted = [c if x else 0 for c, x in zip(counted, inside)]
        below = counted[:]
        for i in range(n - 1, 0, -1):
            below[parent[i]] += below[i]
            holds[parent[i]] = holds[parent[i]] or holds[i] and below[i] > 0
        up = [-1] * n  # the nearest named node above
        share: dict[str, int] = {}
        for i in range(1, n):
            up[i] = parent[i] if self.named[parent[i]] else up[parent[i]]
        for i in soft:
            for name in set(self.named[i]):
                j = up[i]
                while j >= 0 and name not in self.named[j]:
                    j = up[j]
                if j < 0:
                    share[name] = share.get(name, 0) + below[i]
        half = below[0] / 2

        def marks(strong_hold: bool) -> list[bool]:
            out = [False] * n
            for i in soft:
                if self.article[i]:
                    out[i] = strong_hold and marked and any(map(says_what, self.named[i]))
                elif not holds[i]:
                    out[i] = any(strong_hold if says_what(x) else share[x] <= half for x in self.named[i])
            for i in range(1, n):
                out[i] = out[i] or out[parent[i]]
            return out

        out = marks(True)
        if below[0] and not any(c and not o for c, o in zip(counted, out)):
            out = marks(False)
        self.noise = [a or b for a, b in zip(self.noise, out)]


def parse_page(source: str) -> Page:
    page = Page()
    root = page.node(-1, "html")
    # open elements: tag, node of the block they belong to, whether they open a block, noise, in a link
    stack: list[tuple[str, int, bool, bool, bool]] = [("", root, True, False, False)]
    text: list[str] = []
    at = root

    def close_block() -> None:
        if text:
            folded = " ".join("".join(text).split())
            if folded:
                page.blocks.append((at, folded))
            text.clear()

    def pop_to(depth: int) -> None:
        nonlocal at
        if any(e[2] for e in stack[depth:]):
            close_block()
        del stack[depth:]
        at = stack[-1][1]

    def add(raw: str) -> None:
        if raw and not stack[-1][3]:
            text.append(entities.unescape(raw) if "&" in raw else raw)
            count = page.linked if stack[-1][4] else page.prose
            count[at] += len(raw.strip())

    pos, end = 0, len(source)
    while pos < end:
        m = _TOKEN.search(source, pos)
        if m is None:
            add(source[pos:])
            break
        add(source[pos:m.start()])
        pos = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if tag == "br" or tag == "p" and not any(e[0] == "p" for e in stack):
                close_block()
                continue
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] == tag:
                    pop_to(d)
                    break
                if tag in INLINE and stack[d][2]:
                    break  # an inline end tag does not close the block around it
            continue
        raw = m[3] if m[2] else m[6]
        attrs = attributes(raw)
        inline = tag in INLINE
        if not inline:
            closes = ("p",) if tag in _CLOSES_P else _SAME.get(tag, ())
            for d in range(len(stack) - 1, 0, -1) if closes else ():
                if stack[d][0] in closes:
                    lowest = d
                    while tag in _SAME and lowest > 1 and stack[lowest - 1][0] in closes:
                        lowest -= 1
                    pop_to(lowest)
                    break
                if stack[d][0] in _SCOPE:
                    break
            if tag in ("br", "hr"):
                close_block()
                continue
        noise = noisy(tag, attrs) or tag == "header" and not page.main[at]
        if tag in VOID:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, pos)
            pos = stop.end() if stop else end
            if not inline:
                close_block()
            continue
        named = noise_names(tag, attrs)
        if inline and not noise and not named:
            stack.append((tag, at, False, stack[-1][3], stack[-1][4] or tag == "a"))
            continue
        close_block()
        names = " ".join(sorted(set(_DIGITS.sub("#", f"{attrs.get('class', '')} {attrs.get('id', '')}").lower().split())))
        main = tag in ("article", "main") or attrs.get("role", "").lower() in ("main", "article")
        child = page.node(stack[-1][1], f"{tag}.{names}" if names else tag, noise, main and not noise, tag in PROSE and not names, named)
        # text of noise is kept for the statistics; scripts and the like never get here
        stack.append((tag, child, True, stack[-1][3], stack[-1][4] or tag == "a"))
        at = child
    close_block()
    page.settle()
    return page


def host_of(url: str | None) -> str:
    try:
        return urlsplit(url or "").netloc.lower() or (url or "")
    except ValueError:
        return url or ""


def parse_pages(pages: DataFrame) -> DataFrame:
    """``pages`` without html, with __llm_host and the page's nodes and blocks as arrays."""
    small_batches(pages.sparkSession)
    pages = pages.drop("text", "n_chars")
    names = pages.columns
    url_at, html_at = names.index("url"), names.index("html")
    kept = [i for i in range(len(names)) if i != html_at]
    added = [("__llm_host", T.StringType(), pa.string()), ("__llm_path", T.ArrayType(T.LongType()), pa.list_(pa.int64())),
             ("__llm_parent", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), ("__llm_kind", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
             ("__llm_depth", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), ("__llm_branch", T.ArrayType(T.LongType()), pa.list_(pa.int64())),
             ("__llm_style", T.ArrayType(T.LongType()), pa.list_(pa.int64())), ("__llm_content", T.ArrayType(T.LongType()), pa.list_(pa.int64())),
             ("__llm_chars", T.ArrayType(T.LongType()), pa.list_(pa.int64())), ("__llm_linked", T.ArrayType(T.LongType()), pa.list_(pa.int64())),
             ("__llm_block", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), ("__llm_text", T.ArrayType(T.StringType()), pa.list_(pa.string()))]
    digest = lambda s: xxhash.xxh64_intdigest(s.encode("utf-8", "replace")) >> 1

    def run(batches):
        for b in batches:
            rows = []
            for url, source in zip(b.column(url_at).to_pylist(), b.column(html_at).to_pylist()):
                p = parse_page(source or "")
                content: dict[int, list[str]] = {}
                for i, t in p.blocks:
                    content.setdefault(i, []).append(t)
                rows.append((host_of(url), p.path, p.parent, p.kinds(), p.depth, p.branch,
                             [digest(repr([p.path[c] for c in k])) if k else 0 for k in p.children],
                             [digest("\n".join(content[i])) if i in content else 0 for i in range(len(p.path))],
                             [a + b for a, b in zip(p.prose, p.linked)], p.linked,
                             [i for i, _ in p.blocks], [t for _, t in p.blocks]))
            cols = list(zip(*rows)) if rows else [()] * len(added)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], *[pa.array(c, k) for c, (_, _, k) in zip(cols, added)]],
                                             [*[names[i] for i in kept], *[a[0] for a in added]])

    fields = [pages.schema.fields[i] for i in kept] + [T.StructField(n, t) for n, t, _ in added]
    return pages.mapInArrow(run, T.StructType(fields))


#: What the host's statistics are made of, a list an entry of each node of a page.
STATISTICS = ["__llm_path", "__llm_parent", "__llm_depth", "__llm_branch", "__llm_style", "__llm_content", "__llm_chars", "__llm_linked"]


def style_tree(parsed: DataFrame) -> DataFrame:
    """(host, node, parent, depth, branch, pages, presentation, content, styles): the merged
    nodes of each host with their own importance, before children are added. A path has one
    depth and one branch."""
    key = ["host", "node", "parent", "depth", "branch"]
    nodes = parsed.select("__llm_host", F.posexplode(F.arrays_zip(*STATISTICS)).alias("i", "n"), "__llm_path")
    row = lambda shape, what, chars, linked: F.struct(
        F.lit(shape).alias("shape"), what.alias("what"), chars.cast("long").alias("chars"), linked.cast("long").alias("linked"))
    both = nodes.select(F.col("__llm_host").alias("host"), F.col("n.__llm_path").alias("node"),
                        F.when(F.col("n.__llm_parent") >= 0, F.element_at("__llm_path", F.col("n.__llm_parent") + 1)).alias("parent"),
                        F.col("n.__llm_depth").alias("depth"), F.col("n.__llm_branch").alias("branch"),
                        F.explode(F.array(row(True, F.col("n.__llm_style"), F.lit(0), F.lit(0)),
                                          row(False, F.col("n.__llm_content"), F.col("n.__llm_chars"), F.col("n.__llm_linked")))).alias("x"))
    each = both.filter("x.what != 0").groupBy(*key, "x.shape", "x.what").agg(
        F.count("*").alias("c"), F.sum("x.chars").alias("chars"), F.sum("x.linked").alias("linked"))
    kind = each.groupBy(*key, "shape").agg(
        F.sum("c").alias("m"), F.count("*").alias("l"), F.sum(F.col("c") * F.log("c")).alias("clogc"), F.sum(F.log("c")).alias("logc"),
        (1 - F.sum("linked") / F.greatest(F.sum("chars"), F.lit(1))).alias("unlinked"))
    log_m = F.log("m")
    own = F.when(F.col("m") == 1, 1.0).when(F.col("shape"), 1 - F.col("clogc") / F.col("m") / log_m).otherwise(1 - F.col("logc") / F.col("l") / log_m)
    shape = lambda c, s: F.max(F.when(F.col("shape") == s, F.col(c)))
    return kind.withColumn("own", own * F.when(F.col("shape"), 1.0).otherwise(F.col("unlinked"))).groupBy(*key).agg(
        F.max("m").alias("pages"), shape("own", True).alias("presentation"), shape("own", False).alias("content"),
        F.coalesce(shape("l", True), F.lit(0)).alias("styles"))


def solve_branch(rows):
    """Importances of one host's branch below :data:`DEPTH` (a pandas frame of style_tree),
    bottom-up as :func:`low_nodes` has them."""
    rows = rows.sort_values("depth", ascending=False)
    total: dict[int, float] = {}
    weight: dict[int, int] = {}
    above: dict[int, float] = {}
    importance, best = [], []
    for node, parent, pages, presentation, content, styles in zip(*(rows[c].tolist() for c in ("node", "parent", "pages", "presentation", "content", "styles"))):
        content = None if content is None or content != content else content
        if presentation is None or presentation != presentation:
            own = content
        else:
            fade = DECAY ** styles
            kids = total[node] / weight[node] if node in weight else 0.0
            own = max((1 - fade) * presentation + fade * kids, content or 0.0)
        high = max(own, above.get(node, own))
        importance.append(own)
        best.append(high)
        total[parent] = total.get(parent, 0.0) + own * pages
        weight[parent] = weight.get(parent, 0) + pages
        above[parent] = max(high, above.get(parent, high))
    return rows[["host", "node", "parent", "depth", "pages"]].assign(importance=importance, best=best)


def low_nodes(parsed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(host, node) of the nodes that, with all below them, have a composite importance below
    ``threshold``. Importances are added bottom-up; on a host's only page nothing but links is low."""
    tree = stash(style_tree(parsed), "style-tree")
    lowest = tree.agg(F.max("depth")).first()[0]
    if lowest is None:
        return tree.select("host", "node")
    below = found = None
    if lowest > DEPTH:
        done = "host string, node long, parent long, depth int, pages long, importance double, best double"
        found = stash(tree.filter(F.col("depth") > DEPTH).groupBy("host", "branch").applyInPandas(solve_branch, done), "importance")
        below, found = found.filter(F.col("depth") == DEPTH + 1).drop("depth"), found.drop("depth")
    for depth in range(min(lowest, DEPTH), -1, -1):
        here = tree.filter(F.col("depth") == depth)
        if below is not None:
            kids = below.groupBy("host", F.col("parent").alias("node")).agg(
                (F.sum(F.col("importance") * F.col("pages")) / F.sum("pages")).alias("kids"), F.max("best").alias("kids_best"))
            here = here.join(kids, ["host", "node"], "left")
        else:
            here = here.withColumns({"kids": F.lit(None).cast("double"), "kids_best": F.lit(None).cast("double")})
        fade = F.pow(F.lit(DECAY), "styles")
        composite = (1 - fade) * F.col("presentation") + fade * F.coalesce("kids", F.lit(0.0))
        importance = F.when(F.col("presentation").isNull(), F.col("content")).otherwise(F.greatest(composite, F.coalesce("content", F.lit(0.0))))
        below = stash(here.select("host", "node", "parent", "pages", importance.alias("importance"),
                                  F.greatest(importance, "kids_best").alias("best")), "importance")
        found = below if found is None else found.unionByName(below)
    return found.filter(F.col("best") < threshold).select("host", "node")


def main_text(path, parent, kind, block, text, low) -> str:
    """The page's text without noise and low branches; arguments as :func:`parse_pages` has them."""
    low = set(low or ())
    n = len(path)
    noise = [bool(k & 1) for k in kind]
    main = [bool(k & 2) and not k & 1 for k in kind]
    marked = any(main[i] for i in block)
    gone = [False] * n
    for i in range(n):  # a parent comes before its children
        gone[i] = i > 0 and path[i] in low and not kind[i] & 4 or parent[i] >= 0 and gone[parent[i]]
    inside = [(i, t) for i, t in zip(block, text) if not noise[i] and (main[i] or not marked)]
    return " ".join([t for i, t in inside if not gone[i]] or [t for _, t in inside])


def extract(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` (url, html, ...) without html, with text and n_chars."""
    parsed = stash(parse_pages(pages), "pages")
    low = stash(low_nodes(parsed.select("__llm_host", *STATISTICS), threshold), "low-nodes")
    by_host = low.groupBy(F.col("host").alias("__llm_h")).agg(F.collect_set("node").alias("__llm_low"))
    if low.count() <= BROADCAST_NODES:
        by_host = F.broadcast(by_host)
    work = ["__llm_path", "__llm_parent", "__llm_kind", "__llm_block", "__llm_text", "__llm_low"]
    rows = parsed.join(by_host, F.col("__llm_host") == F.col("__llm_h"), "left").drop("__llm_host", "__llm_h", *[c for c in STATISTICS if c not in work])
    # of the host's low nodes a page takes only its own to Python
    rows = rows.withColumn("__llm_low", F.array_intersect("__llm_path", "__llm_low"))
    names = rows.columns
    at, kept = [names.index(c) for c in work], [i for i, c in enumerate(names) if c not in work]

    def run(batches):
        for b in batches:
            got = [main_text(*x) for x in zip(*(b.column(i).to_pylist() for i in at))]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], pa.array(got, pa.string()), pa.array(np.array([len(t) for t in got], np.int64))],
                                             [*[names[i] for i in kept], "text", "n_chars"])

    fields = [rows.schema.fields[i] for i in kept] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return rows.mapInArrow(run, T.StructType(fields))
