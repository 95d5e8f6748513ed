"""Main text of web pages through wrappers: union-free regular expressions inferred from the pages of a host."""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aljibe.llm.url_filter import host_and_path
from aljibe.session import staged

#: Tags inside a line of text; they do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark picture q rp rt ruby s samp small source "
                   "span strike strong sub sup time tt u var wbr "
                   "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt "
                   "mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
VOID = frozenset("area base col hr input link meta param track embed".split())
#: An opening tag closes open elements of these tags up to (not beyond) the containers.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Containers that are never main text, by tag and by word of class, id or role.
BOILER_TAGS = frozenset("head nav footer aside form button menu dialog fieldset".split())
BOILER_WORDS = frozenset(
    "ad ads alert announcement banner complementary consent contentinfo dialog disqus gdpr header login masthead menu modal nav navbar navigation notice notification "
    "overlay pager pagination popup promo promotion recommended related reply replies respond search share sharing sidenav signup social subscribe subscription teaser "
    "toast toolbar topbar trending widget".split())
BOILER_STARTS = ("advert", "breadcrumb", "comment", "cookie", "footer", "newsletter", "sidebar", "sponsor")
#: What an ``article`` must be called to be none, and words that say that an element merely stands beside a sidebar.
NO_ARTICLE = frozenset("ad ads promo recommended related reply teaser trending".split())
BESIDE = frozenset("container content has layout no with without wrapper".split())
ENTRY, HEADINGS = frozenset("article entry post story".split()), frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an element with most of the text of a page is still boilerplate for.
NEVER = frozenset("head nav footer aside button menu dialog".split())
TALK = ("comment", "disqus", "reply", "replies", "respond")
MAIN_WORDS = frozenset("articlebody main".split())
LINES = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dt dd figcaption".split())  # blocks, not containers
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg\b[^>]*/>|<(script|style|noscript|template|svg|annotation|annotation-xml|iframe|object|canvas|video|audio|textarea|select)(?=[\s>/])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(?![a-zA-Z0-9:-])((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"  # a quote that is never closed ends with the tag
    r"|<[!?][^>]*(?:>|\Z)", re.S | re.I)
BEGUN = re.compile(r"<[a-zA-Z/!?]")  # any other "<" is text
NAMED = re.compile(r"(?<![^\s\"'/])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\"[^\"]*\"|'[^']*'", re.I)
WORD = re.compile(r"[a-z]+(?:\d{1,2}(?![\da-z]))?")
MADE = re.compile(r"[a-z]*\d+[a-z][a-z\d]*")  # parts of class names with digits among letters are made by tools and tell rows apart
#: First words of class names that say what an element has or lacks, and words that stand beside a boilerplate word in the id of a layout element.
STATES = frozenset("has is no not with without".split())
LAYOUT = frozenset("area bar block bottom box button buttons container content form inner left link links list main outer page panel primary right secondary section "
                   "site slot top unit widget widgets wrap wrapper".split())
TEXT = "#"
#: Fields of a wrapper node. SEEN and PAGES count instances and pages, SAME is the checksum of a text that never differs.
LABEL, FLAGS, CHILDREN, SEEN, CHARS, LINKED, SAME, PAGES = range(8)
REPEATED, OPTIONAL, JOINED, KEPT, SPARE, MAIN = 1, 2, 4, 8, 16, 32
LIGHT = 4  # an article with less than this part of the text of its main element is a teaser in it
SALTS, HOSTS_AT_ONCE, WRAPPERS_AT_ONCE, LEAST_PAGES, DEEPEST = 32, 2000, 64, 5, 150


def label(tag: str, attributes: str) -> str:
    """Tag with the words of its class, id, role and itemprop. Numbers, and digits of words with three or more, tell rows apart, not layouts."""
    if not attributes or "=" not in attributes:
        return tag
    words: set[str] = set()
    for name, *values in NAMED.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        for token in [value] if name == "id" else value.split():
            own = WORD.findall(MADE.sub("", token))
            names = {w for w in own if is_name(w)}
            if names and own[0] in STATES or name == "id" and not all(w in names or w.rstrip("0123456789") in LAYOUT for w in own):
                own = [w for w in own if w not in names]  # a state, or the slug of a title
            words.update(own)
    return f"{tag}.{'.'.join(sorted(words))}" if words else tag


def is_name(word: str) -> bool:
    """Whether a word of a class, id or role names boilerplate."""
    word = word.rstrip("0123456789")
    return word in BOILER_WORDS or word.startswith(BOILER_STARTS) and not word.startswith("commentar")


def parse(page: str) -> list:
    """Tree of a page: [label, children]; a text is [TEXT, text, characters inside links]. Missing end tags are implied.

    Elements deeper than DEEPEST only separate blocks; their texts stay.
    """
    root: list = ["", []]
    stack, tags, buffer, linked, in_link, at = [root], [""], [], 0, False, 0
    flat: dict[str, int] = {}  # open elements that are too deep

    def end_text() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                stack[-1][1].append([TEXT, text, min(linked, len(text))])
            buffer.clear()
        linked = 0

    unfinished = BEGUN.search(page, page.rfind(">") + 1)
    if unfinished:  # no tag ends after the last ">"
        page = page[: unfinished.start()]
    for token in TOKEN.finditer(page):
        start = token.start()
        if start > at:
            buffer.append(page[at:start])
            linked += (start - at) * in_link
        at = token.end()
        closing, tag, attributes = (token[2], token[3], token[4]) if token[3] else (token[5], token[6], token[7])
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            elif tag == "br":
                buffer.append(" ")
            continue
        end_text()
        if closing:
            if flat.get(tag):
                flat[tag] -= 1
            elif tag in tags:
                while tags.pop() != tag:
                    stack.pop()
                stack.pop()
            continue
        if tags[-1] == "p":
            tags.pop()
            stack.pop()
        if tag in CLOSES:
            closed, within = CLOSES[tag]
            for i in range(len(tags) - 1, 0, -1):
                if tags[i] in within:
                    break
                if tags[i] in closed:
                    del tags[i:], stack[i:]
                    break
        if len(tags) > DEEPEST:
            flat[tag] = flat.get(tag, 0) + (tag not in VOID)
            continue
        node = [label(tag, attributes), []]
        stack[-1][1].append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            tags.append(tag)
    if at < len(page):
        buffer.append(page[at:])
    end_text()
    return root


def wrapper_of(tree: list) -> list:
    """Wrapper of one page: every slot of it has been seen on one page, however often."""
    whole = _folded(tree)
    left = [whole]
    while left:
        node = left.pop()
        node[PAGES] = 1
        left += node[CHILDREN]
    return whole


def _folded(node: list) -> list:
    """The nodes of a page as a wrapper. Each label stands once on a level: neighbours with the same label are one repeated node, and
    where a label comes back later, all from its first place on is one repeated group of optional nodes (JOINED to the next)."""
    if node[0] == TEXT:
        return [TEXT, 0, [], 1, len(node[1]), node[2], zlib.crc32(node[1].encode("utf-8", "replace")), 1]
    level: list[list] = []
    places: dict[str, int] = {}
    last = -1
    for child in node[1]:
        own = _folded(child)
        place = places.get(own[LABEL])
        if place is None:
            last = places[own[LABEL]] = len(level)
            level.append(own)
            continue
        join(level, place, last)
        level[place] = merge(level[place], own)
        level[place][FLAGS] |= REPEATED
        last = place
    return [node[0], 0, level, 1, 0, 0, 0, 1]


def join(level: list[list], first: int, last: int) -> None:
    """Make all nodes from ``first`` to ``last`` one repeated group."""
    for i in range(first, last):
        level[i][FLAGS] |= JOINED | OPTIONAL
        level[i + 1][FLAGS] |= OPTIONAL


def merge(one: list, other: list) -> list:
    """Align two wrappers of the same label. A node that only one of them has becomes optional; nodes in a different order
    become a repeated group; texts that differ become a slot. ``one`` is changed and returned."""
    for i in (SEEN, CHARS, LINKED, PAGES):
        one[i] += other[i]
    one[FLAGS] |= other[FLAGS]
    if one[LABEL] == TEXT:
        if one[SAME] != other[SAME]:
            one[SAME] = None
        return one
    level, places = one[CHILDREN], {c[LABEL]: i for i, c in enumerate(one[CHILDREN])}
    met, last = set(), -1
    for child in other[CHILDREN]:
        name, joined = child[LABEL], child[FLAGS] & JOINED
        child[FLAGS] &= ~JOINED
        place = places.get(name)
        if place is None:
            last += 1
            inside = last > 0 and level[last - 1][FLAGS] & JOINED
            level.insert(last, child)
            child[FLAGS] |= OPTIONAL | (JOINED if inside else 0)
            places = {c[LABEL]: i for i, c in enumerate(level)}
        else:
            merge(level[place], child)
            if place < last:
                join(level, place, last)
            last = max(last, place) if place < last else place
        met.add(name)
        if joined:
            child[FLAGS] |= JOINED  # read below, once the next node has its place
            level[places[name]][FLAGS] |= REPEATED
    names = [c[LABEL] for c in other[CHILDREN]]
    for a, b, child in zip(names, names[1:], other[CHILDREN]):
        if child[FLAGS] & JOINED:
            left, right = sorted((places[a], places[b]))
            join(level, left, right)
    for child in level:
        if child[LABEL] not in met:
            child[FLAGS] |= OPTIONAL
    return one


def expression(wrapper: list) -> str:
    """The wrapper as a regular expression over tags; ``#`` is a text slot."""
    if wrapper[LABEL] == TEXT:
        return TEXT
    out, group = [], []
    for child in wrapper[CHILDREN]:
        one = expression(child) + ("+" if child[FLAGS] & REPEATED else "")
        group.append(f"({one})?" if child[FLAGS] & OPTIONAL else one)
        if not child[FLAGS] & JOINED:
            out.append(f"({' '.join(group)})+" if len(group) > 1 else group[0])
            group = []
    return f"<{wrapper[LABEL]}>{' '.join(out)}</>"


def is_boiler(name: str, inside_main: bool) -> bool:
    """Whether an element with this label is never main text. A ``header`` inside an article may hold its title."""
    tag, _, rest = name.partition(".")
    if tag in BOILER_TAGS or tag == "header" and not inside_main:
        return True
    words = {w.rstrip("0123456789") for w in rest.split(".")} if rest and tag not in ("html", "body", "main") else set()
    if "sidebar" in words and words & BESIDE:
        words.discard("sidebar")
    if inside_main or words & ENTRY:
        words.discard("header")
    if tag in HEADINGS:
        return False
    if tag == "article":
        return any(is_name(w) and w not in BOILER_WORDS for w in words) or not NO_ARTICLE.isdisjoint(words)
    return any(map(is_name, words))


def choose(wrapper: list) -> list:
    """Mark the slots of main text and return the wrapper.

    Boilerplate containers are left out, unless they hold most of the text outside links (a page-wide form). What is left of ``article`` elements may be main text (KEPT), and
    what is left of ``main`` elements (MAIN); a page decides by its own texts. In both, a slot whose text is the same on all pages that have it belongs to the template and is left out, but for
    headings, and unless it is the template that has most of the text, as where all pages are copies.
    For pages that have neither, the smallest element that holds most of the text of the other slots that
    differ between pages and are not links is main text (SPARE).
    """
    pages, texts = wrapper[PAGES], {}

    def weigh(node: list) -> int:
        texts[id(node)] = node[CHARS] - node[LINKED] if node[LABEL] == TEXT else sum(map(weigh, node[CHILDREN]))
        return texts[id(node)]

    weigh(wrapper)

    def boiler(node: list, within: bool) -> bool:
        if not is_boiler(node[LABEL], within):
            return False
        tag, _, rest = node[LABEL].partition(".")
        return tag in NEVER or any(w.startswith(TALK) for w in rest.split(".")) or 2 * texts[id(node)] <= texts[id(wrapper)]

    headings: set[int] = set()

    def slots(node: list, within: bool) -> Iterator[list]:
        for child in node[CHILDREN]:
            if child[LABEL] == TEXT:
                if node[LABEL].partition(".")[0] in HEADINGS:
                    headings.add(id(child))
                yield child
            elif not boiler(child, within):
                yield from slots(child, within)

    def holders(node: list, fits) -> Iterator[list]:
        for child in node[CHILDREN]:
            if child[LABEL] != TEXT and not boiler(child, False):
                if fits(child[LABEL]):
                    yield child
                else:
                    yield from holders(child, fits)

    def constant(slot: list) -> bool:
        return slot[SAME] is not None and slot[PAGES] >= LEAST_PAGES and pages >= LEAST_PAGES

    def mass(node: list) -> int:
        return sum(s[CHARS] - s[LINKED] for s in slots(node, False) if not s[FLAGS] & (KEPT | MAIN) and not constant(s) and 2 * s[LINKED] <= s[CHARS])

    for mark, fits in ((KEPT, lambda n: n.partition(".")[0] == "article"), (MAIN, lambda n: n.partition(".")[0] == "main" or not MAIN_WORDS.isdisjoint(n.split(".")[1:]))):
        found = [s for node in holders(wrapper, fits) for s in slots(node, True)]
        varying = [s for s in found if not constant(s) or id(s) in headings]
        template = 2 * sum(s[CHARS] for s in varying if not constant(s)) >= sum(s[CHARS] for s in found)
        for slot in varying if template else found:
            slot[FLAGS] |= mark
    node, whole = wrapper, mass(wrapper)
    while whole:
        inner = [c for c in node[CHILDREN] if c[LABEL] != TEXT and c[LABEL].partition(".")[0] not in LINES and not boiler(c, False)
                 and not c[FLAGS] & REPEATED and 10 * mass(c) >= 7 * whole]
        if not inner:
            break
        node = inner[0]
    for slot in slots(node, False):
        if 2 * slot[LINKED] <= slot[CHARS] and not (constant(slot) and whole):
            slot[FLAGS] |= SPARE
    return wrapper


def blocks(node: list, wrapper: list, mark: int) -> Iterator[str]:
    """Texts of a page that fall into marked slots, in page order."""
    places = {c[LABEL]: c for c in wrapper[CHILDREN]}
    for child in node[1]:
        slot = places.get(child[0])
        if slot is None:
            continue
        if child[0] == TEXT:
            if slot[FLAGS] & mark:
                yield child[1]
        else:
            yield from blocks(child, slot, mark)


def extract(page: str, wrapper: list) -> str:
    """Main text of a page by the wrapper of its host: that of its articles, or of its main element where that has far more, or else by mass."""
    tree = parse(page)
    article, main = ["\n\n".join(blocks(tree, wrapper, mark)) for mark in (KEPT, MAIN)]
    if article and LIGHT * len(article) >= len(main):
        return article
    return main or "\n\n".join(blocks(tree, wrapper, SPARE))


def _dump(wrapper: list) -> str:
    return json.dumps(wrapper, separators=(",", ":"), ensure_ascii=False)


def wrappers(pages: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` from all rows of ``pages`` (host, html). Runs a job.

    Each task aligns its own pages of a host; the wrappers of a host are then merged in two steps, so that no task
    gets more than a share of the tasks' wrappers of a host with very many pages. A wrapper grows with the layouts of a host, not with its pages.
    """
    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, list] = {}
        salt = TaskContext.get().partitionId() % SALTS

        def out() -> pd.DataFrame:
            rows = [(h, salt, _dump(w)) for h, w in known.items()]
            known.clear()
            return pd.DataFrame(rows, columns=["host", "salt", "wrapper"])

        for batch in batches:
            for host, page in zip(batch["host"], batch["html"]):
                own = wrapper_of(parse(page))
                known[host] = merge(known[host], own) if host in known else own
                if len(known) > HOSTS_AT_ONCE:
                    yield out()
        yield out()

    def merged(last: bool):
        def combine(rows: pd.DataFrame) -> pd.DataFrame:
            whole = None
            for text in sorted(rows["wrapper"]):
                whole = json.loads(text) if whole is None else merge(whole, json.loads(text))
            return pd.DataFrame({"host": rows["host"].iloc[:1], "wrapper": [_dump(choose(whole) if last else whole)]})
        return combine

    partial = pages.select("host", "html").mapInPandas(local, "host string, salt int, wrapper string")
    shares = partial.groupBy("host", "salt").applyInPandas(merged(False), "host string, wrapper string")
    return staged(shares.groupBy("host").applyInPandas(merged(True), "host string, wrapper string"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points). Runs a job.

    Blocks of main text, white space as single spaces, joined by two line feeds. NULL and empty pages give an empty text; pages without a host (NULL URLs
    among them) share one wrapper; repeated rows give repeated rows. Other columns are not read.

    Pages meet the wrapper of their host in a join whose hot hosts Spark can split.
    """
    host, _ = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    known = wrappers(rows).withColumnRenamed("host", "of_host")
    joined = rows.join(known, rows.host == known.of_host, "left").select("page_id", "url", "html", "wrapper")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lru_cache(WRAPPERS_AT_ONCE)(json.loads)
        for batch in batches:
            found = []
            for page, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                found.append(extract(page, read(text) if text else choose(wrapper_of(parse(page)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], schema=schema)

    return joined.mapInArrow(texts, "page_id bigint, url string, text string, n_chars bigint")
