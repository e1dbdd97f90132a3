"""Operator 9: main text of web pages by a site style tree.

The element trees of a host's pages are merged: elements with the same chain of tags and classes are
one node of the site's tree. A node's presentation importance is the entropy of its child sequences
over the pages that have it, its content importance the entropy of its texts over those pages, both to
the base of the pages: what every page repeats counts nothing, what each page says alone counts in full.
The nodes that stand once a page and hold most of what the host's pages say are the tree's stem; its last
node is the main branch. A branch that leaves the stem goes from every page of the host where its texts repeat
several times as much as the main branch's do and it is the less important of the two; so do parts of
branches whose texts repeat nearly everywhere. Where a host has too few pages to tell, and for what no page
repeats, such as readers' comments, the role that tag, class or id name plainly decides besides.
What is left is decoded block by block.

Every path on a few pages is judged, whatever the size of its host. Verdicts are rows of (host, path) and
are joined to the paths of each page, so what is gathered for a page is bounded by its own paths.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.base import map_batches, query, table
from plumbline.session import reliable_checkpoint

#: Weight of content against presentation, and least pages for a verdict.
CONTENT = 0.9
PAGES = 8
#: Part of the page's weight that a node of the stem holds, and elements of one kind that a page has at most there.
STEM, ONCE = 0.5, 1.2
#: How often the main branch's share of repeated text a branch has at least to go, and the least share; what repeats
#: to this extent goes wherever it stands.
TIMES, REPEATED, FIXED = 3.0, 0.03, 0.5

# Tags of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre search section summary table caption tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their text runs to their own end tag, whatever stands between.
RAW = frozenset("script style textarea title iframe".split())
# Elements in a line whose content is not text of the page.
HIDDEN = frozenset("noscript template svg select button object audio video canvas annotation annotation-xml".split())
CLOSED_BY_OWN = frozenset("button select".split())
# Parts of a text that are judged with the branch they stand in.
RUNNING = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th tr tbody thead caption blockquote pre figcaption".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_SAME = frozenset("li dt dd tr td th option thead tbody tfoot".split())
JUNK_TAGS = frozenset("nav aside menu dialog footer search".split())
# A class or id names a role if all of its words do, or do together with words that say nothing.
JUNK_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu sidebar footer breadcrumb breadcrumbs cookie cookies consent notice popup modal newsletter subscribe share sharing social related comment comments respond replies disqus masthead toolbar widget login signup search pagination pager".split()
)
PLAIN_WORDS = frozenset(
    "site page top bottom left right main primary secondary global header bar box block list links link items item wrapper wrap container inner outer area section panel slot unit buttons button icons posts stories articles content form col column row sm md lg xs".split()
)
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[a-z]+")


def _implied_end(open_tag: str, tag: str) -> bool:
    """Whether an open element ends where ``tag`` begins."""
    return open_tag in CLOSED_BY_BLOCK or tag in CLOSED_BY_SAME and open_tag == tag


def tokens_of(source: str) -> tuple[list[tuple[int, int, str, bool, str]], dict[int, int]]:
    """The tags as (start, end, name, closing, attributes), raw elements whole, and the end tag of each hidden element that has one.

    A hidden element without an end tag inside its parent has none here, though one may follow further down.
    """
    tokens: list[tuple[int, int, str, bool, str]] = []
    ends: dict[int, int] = {}
    opened: list[tuple[str, int]] = []
    times: Counter[str] = Counter()

    def leave(tag: str) -> int:
        while True:
            last, at = opened.pop()
            times[last] -= 1
            if last == tag:
                return at

    at = 0
    while m := TOKEN.search(source, at):
        at = m.end()
        tag, closing, attributes = (m[2] or "").lower(), bool(m[1]), m[3] or ""
        if closing:
            if times[tag]:
                begun = leave(tag)
                if tag in HIDDEN:
                    ends[begun] = len(tokens)
        elif tag in RAW:
            if not (attributes.endswith("/") and times["svg"]):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
        elif tag in HIDDEN:
            if not attributes.endswith("/"):
                if tag in CLOSED_BY_OWN and times[tag]:
                    leave(tag)
                opened.append((tag, len(tokens)))
                times[tag] += 1
        elif tag in BLOCKS and tag not in VOID:
            if opened and _implied_end(opened[-1][0], tag):
                leave(opened[-1][0])
            opened.append((tag, len(tokens)))
            times[tag] += 1
        tokens.append((m.start(), at, tag, closing, attributes))
    return tokens, ends


def _names_junk(name: str) -> bool:
    """Whether one class or id names the role of something that is not the article."""
    words = WORD.findall(name)
    return not JUNK_WORDS.isdisjoint(words) and all(w in JUNK_WORDS or w in PLAIN_WORDS for w in words)


class Element:
    """An open element: its path in the site's tree, whether it is removed, or only stands in a form, its child tags, its first block."""

    __slots__ = ("tag", "path", "junk", "form", "children", "first", "inside")

    def __init__(self, tag: str, path: str, junk: bool, form: bool, first: int, inside: bool):
        self.tag, self.path, self.junk, self.form, self.children, self.first, self.inside = tag, path, junk, form, [], first, inside


class Page:
    """Blocks of a page in order with their verdict by role, and the elements with the blocks they span."""

    def __init__(self, source: str, roles: bool = True):
        self.roles = roles
        self.blocks: list[tuple[str, bool, bool, str, bool]] = []  # text, junk, inside the article, path, in a form
        self.elements: list[tuple[str, str, int, int]] = []  # path, child tags, first block, end
        self._stack = [Element("", "", False, False, 0, False)]
        self._text: list[str] = []
        self._read(source)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(entities.unescape("".join(self._text)).split())
            self._text = []
            if text:
                top = self._stack[-1]
                self.blocks.append((text, top.junk, top.inside, top.path, top.form))

    def _pop(self) -> None:
        self._flush()
        e = self._stack.pop()
        self.elements.append((e.path, " ".join(e.children), e.first, len(self.blocks)))

    def _open(self, tag: str, attributes: str) -> None:
        self._flush()
        if _implied_end(self._stack[-1].tag, tag):
            self._pop()
        top = self._stack[-1]
        names, junk, form = [], tag in JUNK_TAGS or tag == "header" and not top.inside, tag == "form"
        for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
            value, name = "".join(values).lower(), name.lower()
            if name in ("class", "id"):
                words = WORD.findall(value)
                names += words
                junk |= tag not in ("body", "html", "article", "main") and any(_names_junk(one) for one in value.split())
            elif name == "role":
                junk |= value in JUNK_ROLES
                form |= value == "form"
            else:
                junk |= name == "hidden" or value == "true"
        step = ".".join([tag, *sorted(set(names))])
        top.children.append(step)
        article = tag in ("article", "main") and not junk and not top.junk
        # A form around the article does not make it one of its fields.
        form = form or top.form and not article
        junk = self.roles and (junk or top.junk)
        self._stack.append(Element(tag, f"{top.path}/{step}", junk, form, len(self.blocks), top.inside or article))

    def _close(self, tag: str) -> None:
        if any(e.tag == tag for e in self._stack):
            while self._stack[-1].tag != tag:
                self._pop()
            self._pop()
        else:
            self._flush()

    def _read(self, source: str) -> None:
        tokens, ends = tokens_of(source)
        at = i = 0
        # Below a hidden element that is never closed: nothing counts up to the next block.
        quiet = False
        while i < len(tokens):
            start, end, tag, closing, attributes = tokens[i]
            if not quiet:
                self._text.append(source[at:start])
            if tag in HIDDEN:
                self._text.append(" ")
                if i in ends:
                    i = ends[i]
                    end = tokens[i][1]
                elif not closing and not attributes.endswith("/"):
                    quiet = True
            elif tag in RAW:
                self._text.append(" ")
            elif tag in BLOCKS:
                quiet &= tag in ("option", "optgroup")
                if closing:
                    self._close(tag)
                elif tag in VOID:
                    self._flush()
                else:
                    self._open(tag, attributes)
            elif tag == "br":
                self._text.append(" ")
            at = end
            i += 1
        if quiet:
            at = len(source)
        self._text.append(source[at:])
        self._flush()
        while len(self._stack) > 1:
            self._pop()

    def nodes(self) -> Iterator[tuple[str, int, str, str]]:
        """(path, elements, child tags, text) of every path of the page, equal paths taken together."""
        merged: dict[str, tuple[list[str], list[str]]] = {}
        for path, children, first, end in self.elements:
            tags, texts = merged.setdefault(path, ([], []))
            tags.append(children)
            texts += [b[0] for b in self.blocks[first:end]]
        for path, (tags, texts) in merged.items():
            yield path, len(tags), "|".join(tags), "\n".join(texts)

    def _kept(self) -> list[tuple[str, bool, bool, str, bool]]:
        """The blocks that stay by their role.

        Those in an article, where articles hold most of the text, and not only a teaser; those in forms if
        there are no others.
        """
        if not self.roles:
            return self.blocks
        stay = [b for b in self.blocks if not b[1]]
        inside = [b for b in stay if b[2]]
        if inside and 2 * sum(len(b[0]) for b in inside) >= sum(len(b[0]) for b in stay if not b[4]):
            stay = inside
        return [b for b in stay if not b[4]] or stay

    def paths(self) -> set[str]:
        """The paths of the blocks that stay by their role, and all above them."""
        out: set[str] = set()
        for block in self._kept():
            path = block[3]
            while path and path not in out:
                out.add(path)
                path = path.rpartition("/")[0]
        return out

    def text(self, low: frozenset[int], hashed) -> str:
        """The main text, without the branches whose path hash is in ``low``."""
        cache: dict[str, bool] = {}

        def removed(path: str) -> bool:
            if path not in cache:
                cache[path] = bool(path) and (hashed(path) in low or removed(path.rpartition("/")[0]))
            return cache[path]

        return "\n".join(b[0] for b in self._kept() if not low or not removed(b[3]))


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return m[1].lower() if m else ""


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, parent, n, times, chars, running, presentation, content) of every node of every site's tree; path 0 is the whole page.

    n are the pages that have the node, times its elements on all of them, chars the length of its texts.
    """

    def make():
        def step(batch: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {c: [] for c in ("host", "path", "parent", "times", "chars", "running", "style", "content")}
            for url, source in zip(batch["url"], batch["html"]):
                host, page = host_of(url), Page(source or "")
                for path, times, style, content in [("", 1, "", "\n".join(b[0] for b in page.blocks)), *page.nodes()]:
                    above, _, last = path.rpartition("/")
                    out["host"].append(host)
                    out["path"].append(_hash(path) if path else 0)
                    out["parent"].append(_hash(above) if above else 0 if path else None)
                    out["times"].append(times)
                    out["chars"].append(len(content))
                    out["running"].append(last.partition(".")[0] in RUNNING)
                    out["style"].append(_hash(style))
                    out["content"].append(_hash(content))
            return out

        return step

    schema = "host string, path bigint, parent bigint, times bigint, chars bigint, running boolean, style bigint, content bigint"
    nodes = map_batches(pages.select("url", "html"), make, schema)
    seen = reliable_checkpoint(nodes.groupBy("host", "path", "parent", "running", "style", "content").agg(F.count("*").alias("c"), F.sum("times").alias("times"), F.sum("chars").alias("chars")))

    def spread(by: str, *more) -> DataFrame:
        """Per node the pages, and the sum of c log c over its distinct values."""
        values = seen.groupBy("host", "path", "parent", "running", by).agg(F.sum("c").alias("c"), F.sum("times").alias("times"), F.sum("chars").alias("chars"))
        return values.groupBy("host", "path", "parent", "running").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log(F.col("c"))).alias(f"{by}_log"), *more)

    counts = F.sum("times").alias("times"), F.sum("chars").alias("chars")
    both = spread("style", *counts).join(spread("content").drop("n", "parent", "running"), ["host", "path"])
    # Entropy to the base of the pages: log n - (sum of c log c) / n over log n.
    base = F.when(F.col("n") > 1, F.log("n"))
    entropy = lambda c: F.coalesce(1 - F.col(f"{c}_log") / F.col("n") / base, F.lit(1.0))
    return both.select("host", "path", "parent", "n", "times", "chars", "running", entropy("style").alias("presentation"), entropy("content").alias("content"))


def low_branches(tree: DataFrame) -> DataFrame:
    """(host, path) of the branches removed, a row each."""
    tree = reliable_checkpoint(tree.withColumns({
        "weight": F.col("chars") * F.col("content"), "importance": (1 - CONTENT) * F.col("presentation") + CONTENT * F.col("content"), "repeats": 1 - F.col("content")}))
    whole = tree.where("path = 0").select("host", F.col("weight").alias("_whole"), F.col("n").alias("_pages"))
    once = (F.col("times") <= ONCE * F.col("n")) & (2 * F.col("n") > F.col("_pages")) & ~F.col("running")
    stem = reliable_checkpoint(tree.join(whole, "host").where(once & (F.col("weight") > STEM * F.col("_whole"))).select("host", "path", "weight", "importance", "repeats"))
    # Nodes of the stem lie inside each other, so the last has the least weight; of equal ones it is the one that is no other's parent.
    inner = tree.select("host", F.col("parent").alias("path"), F.col("path").alias("_child")).join(stem.select("host", F.col("path").alias("_child")), ["host", "_child"]).select("host", "path").distinct()
    main = stem.join(inner, ["host", "path"], "left_anti").select("host", F.col("importance").alias("_importance"), F.col("repeats").alias("_repeats"))
    judged = tree.where(F.col("path") != 0).where(F.col("n") >= PAGES).join(stem.select("host", "path"), ["host", "path"], "left_anti").join(main, "host")
    leaves = stem.select("host", F.col("path").alias("parent"), F.lit(True).alias("_leaves"))
    judged = judged.join(leaves, ["host", "parent"], "left").withColumn("_leaves", F.coalesce("_leaves", F.lit(False)) & ~F.col("running"))
    least = F.greatest(TIMES * F.col("_repeats"), F.when(F.col("_leaves"), REPEATED).otherwise(FIXED))
    return reliable_checkpoint(judged.where((F.col("repeats") >= least) & (F.col("importance") < F.col("_importance"))).select("host", "path"))


def page_branches(pages: DataFrame, low: DataFrame, roles: bool = True) -> DataFrame:
    """(_host, _page, low): the hashes of the removed branches of every page that has any.

    ``pages``: _host, _page and html, of which _page tells the pages of a host apart by their html.
    """

    def make():
        def step(batch: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"host": [], "_page": [], "path": []}
            for host, key, source in zip(batch["_host"], batch["_page"], batch["html"]):
                hashes = [_hash(path) for path in Page(source or "", roles).paths()]
                out["host"] += [host] * len(hashes)
                out["_page"] += [key] * len(hashes)
                out["path"] += hashes
            return out

        return step

    paths = map_batches(pages.select("_host", "_page", "html"), make, "host string, _page bigint, path bigint")
    found = paths.join(low, ["host", "path"]).groupBy(F.col("host").alias("_host"), "_page")
    return found.agg(F.collect_set("path").alias("low"))


def extract(pages: DataFrame, roles: bool = True) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    A null html is empty and gives an empty text. Pages without a url or a host in it share one tree.
    Equal rows are extracted each; other columns are ignored. Without ``roles`` the sites' trees alone decide.
    """
    low = low_branches(style_tree(pages))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^\s*(?:[a-zA-Z][a-zA-Z0-9_+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))
    keyed = pages.select("page_id", "url", "html", host.alias("_host"), F.xxhash64("html").alias("_page"))
    joined = keyed.join(page_branches(keyed, low, roles).hint("shuffle_hash"), ["_host", "_page"], "left")

    def make():
        sets: dict[tuple, frozenset[int]] = {}

        def step(batch: dict[str, list]) -> dict[str, list]:
            texts = []
            for source, paths in zip(batch["html"], batch["low"]):
                key = tuple(paths or ())
                if key not in sets:
                    sets.clear()
                    sets[key] = frozenset(key)
                texts.append(Page(source or "", roles).text(sets[key], _hash))
            return {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return step

    return map_batches(joined.select("page_id", "url", "html", "low"), make, "page_id bigint, url string, text string, n_chars bigint")


@query("op9_style_tree_text")
def op9_style_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
