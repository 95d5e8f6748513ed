"""Rows from HTML pages and from conversation documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aljibe.functions.nested import MESSAGE_KEYS, first_list
from aljibe.functions.text import first_number, mentions, plain_markup, stripped
from aljibe.operators.tag_tree import select_elements


def page_title(html: Column) -> Column:
    """Text of the first title, whatever its attributes and the case of its tag."""
    return plain_markup(F.regexp_extract(html, r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>", 1))


def page_links(df: DataFrame, key: str, html: str) -> DataFrame:
    """Targets of the links of each page with their position, from 0."""
    return select_elements(df, [key], html, "a[href]", {"link": ("", "href")}, "position")


def page_items(df: DataFrame, keep: Sequence[str], html: str, block: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per element that ``block`` selects, nested ones too, with the fields of it as text without white space at either end.

    A field that is absent from a block is NULL. Selectors are those of ``select_elements``.
    """
    items = select_elements(df, keep, html, block, fields)
    return items.select(*keep, *[stripped(F.col(name)).alias(name) for name in fields])


# The tags and classes of the product list read by ``listed_products``.
PRODUCT_BLOCK = "article.product_pod"
PRODUCT_FIELDS = {"product_name": ("h3 a", "title"), "price_text": (".price_color", "text"), "availability": (".availability", "text")}


def listed_products(pages: DataFrame, html: str = "html", currency: str = "GBP", source: str = "books_to_scrape", keep: Sequence[str] = ()) -> DataFrame:
    """Products of a listing page: name, price, currency, stock flag, source."""
    items = page_items(pages, keep, html, PRODUCT_BLOCK, PRODUCT_FIELDS)
    return items.select(
        *keep, "product_name", first_number(F.col("price_text")).alias("price"), F.lit(currency).alias("currency"),
        mentions(F.col("availability"), "In stock").alias("in_stock"), F.lit(source).alias("source"),
    )


def messages(df: DataFrame, keep: Sequence[str], document: str, item_type: str, keys: Sequence[str] = MESSAGE_KEYS) -> DataFrame:
    """One row per message of a JSON document, found under the first key that holds a list."""
    return df.select(*keep, F.inline(first_list(F.col(document), item_type, keys)))
