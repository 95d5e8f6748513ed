"""Elements of HTML pages, selected by tag and class: pages are read as trees, in Arrow batches."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: A comment, a declaration, or a tag: its slash, name and attributes. A quoted value may hold anything; a quote without its partner is a character like any other.
MARKUP = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z))""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
# Fixed values of HTML: elements without content, elements whose content is text, and what the start of an element ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
UNSEEN = frozenset("script style".split())
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    **dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), {"p"}),
}
WALLS = frozenset("ul ol dl table select article section div body".split())


class Element:
    """A start tag and what lies below it: the elements and the pieces of text from its own on, up to ``last`` and ``stop``."""

    __slots__ = ("tag", "attributes", "above", "last", "start", "stop")

    def __init__(self, tag: str, attributes: str, above: Element | None, start: int):
        self.tag, self.attributes, self.above, self.start, self.last, self.stop = tag, attributes, above, start, 0, 0

    def attribute(self, name: str) -> str | None:
        """The first attribute of that name with its character references resolved; empty if it has no value."""
        for key, *values in ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return unescape("".join(values))
        return None

    def has_classes(self, classes: frozenset[str]) -> bool:
        return not classes or classes <= {*(self.attribute("class") or "").split()}


class Selector:
    """``tag.class[attribute]`` steps between blanks, each below the one before: ``article.product h3 a[href]``. A step may lack any of the three."""

    STEP = re.compile(r"([^.\[\]]*)((?:\.[^.\[\]]+)*)(?:\[([^\]]+)\])?")

    def __init__(self, text: str):
        self.steps = []
        for step in text.split():
            found = self.STEP.fullmatch(step)
            if not found:
                raise ValueError(f"not a selector: {text!r}")
            self.steps.append((found[1].lower(), frozenset(found[2].split(".")) - {""}, (found[3] or "").lower()))

    @staticmethod
    def fits(element: Element, step: tuple[str, frozenset[str], str]) -> bool:
        tag, classes, attribute = step
        return (not tag or tag == element.tag) and element.has_classes(classes) and (not attribute or element.attribute(attribute) is not None)

    def matches(self, element: Element) -> bool:
        if not self.fits(element, self.steps[-1]):
            return False
        above = element.above
        for step in reversed(self.steps[:-1]):
            while above is not None and not self.fits(above, step):
                above = above.above
            if above is None:
                return False
            above = above.above
        return True


def parse(html: str) -> tuple[list[Element], list[str]]:
    """Elements in the order of their start tags, and the pieces of text between tags.

    An end tag closes the nearest open element of its name and what is open inside it, or nothing. Elements that need no end tag end where
    another begins that cannot be inside them. Linear in the page, but for the open elements an end tag closes.
    """
    elements, texts, stack, at, position = [], [], [], 0, 0
    open_tags: dict[str, int] = {}

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            element = stack.pop()
            open_tags[element.tag] -= 1
            element.last, element.stop = len(elements), len(texts)

    while (found := MARKUP.search(html, position)) is not None:
        if found.start() > at:
            texts.append(unescape(html[at : found.start()]))
        at = position = found.end()
        slash, tag = found[1], (found[2] or "").lower()
        if not tag:
            continue
        if slash:
            if open_tags.get(tag):
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        ended = ENDS.get(tag, ())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in ended:
                close(i)
            elif stack[i].tag in WALLS:
                break
        element = Element(tag, found[3], stack[-1] if stack else None, len(texts))
        elements.append(element)
        element.last, element.stop = len(elements), len(texts)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])|\Z", re.IGNORECASE).search(html, at)
            if tag not in UNSEEN:
                texts.append(unescape(html[at : end.start()]))
                element.stop = len(texts)
            at = position = end.start()
        elif tag not in VOID and not found[3].endswith("/"):
            stack.append(element)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    if at < len(html):
        texts.append(unescape(html[at:]))
    close(0)
    return elements, texts


def selected(html: str, block: Selector, fields: Sequence[tuple[Selector | None, str]]) -> list[list[str | None]]:
    """Per element that ``block`` selects, nested ones too: for each field the text or the attribute of the first element below it, NULL without one."""
    elements, texts = parse(html)
    places = [[i for i, element in enumerate(elements) if selector.matches(element)] if selector else None for selector, _ in fields]
    rows = []
    for i, element in enumerate(elements):
        if not block.matches(element):
            continue
        row = []
        for (_, what), matching in zip(fields, places):
            target: Element | None = element
            if matching is not None:
                k = bisect_right(matching, i)
                target = elements[matching[k]] if k < len(matching) and matching[k] < element.last else None
            row.append(None if target is None else "".join(texts[target.start : target.stop]) if what == "text" else target.attribute(what))
        rows.append(row)
    return rows


def select_elements(df: DataFrame, keep: Sequence[str], html: str, block: str, fields: Mapping[str, tuple[str, str]], position: str | None = None) -> DataFrame:
    """One row per element of a page that ``block`` selects, in page order: the columns to ``keep``, ``position`` (from 0, if a name is given) and the fields.

    A field is a selector, empty for the block itself, and ``text`` or the name of an attribute. Character references are resolved. NULL pages and pages without such
    elements give no rows. Nothing is shuffled: pages are parsed where they are read, one at a time.
    """
    kept = [field for field in df.schema if field.name in keep]
    kept = [next(field for field in kept if field.name == name) for name in keep]
    added = ([StructField(position, StringType())] if position else []) + [StructField(name, StringType()) for name in fields]
    chosen = [(Selector(selector) if selector else None, what) for selector, what in fields.values()]
    names = [*keep, *[field.name for field in added]]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Selector(block)
        for batch in batches:
            at, found = [], []
            for i, page in enumerate(batch.column(len(kept)).to_pylist()):
                for number, row in enumerate(selected(page, of, chosen) if page else ()):
                    at.append(i)
                    found.append([str(number), *row] if position else row)
            if at:
                columns = [batch.column(k).take(pa.array(at)) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(column, pa.string()) for column in zip(*found)], names=names)

    parsed = df.select(*[F.col(f"`{name}`") for name in keep], F.col(html).alias("_html")).mapInArrow(rows, StructType([*kept, *added]))
    return parsed.withColumn(position, F.col(position).cast("int")) if position else parsed
