"""Symbol discovery from HTML pages (P28), as a distributed job over a pages table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import is_valid_symbol

ANCHOR_HREF = r'<a\s[^>]*?href="([^"]*)"'


def link_candidates(pages: DataFrame, link_prefix: str = "/stocks/", html_col: str = "html",
                    id_col: str = "page_id") -> DataFrame:
    """Every ``<a href>`` containing ``link_prefix``, reduced to the upper-cased text
    between the first and the second occurrence of the prefix, trailing '/' removed."""
    hrefs = pages.select(id_col, F.explode(F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR_HREF), 1))
                         .alias("href"))
    parts = F.split(F.col("href"), re.escape(link_prefix))
    cand = (hrefs.filter(F.col("href").contains(link_prefix))
            .select(id_col, "href",
                    F.upper(F.regexp_replace(F.element_at(parts, 2), "/+$", "")).alias("candidate")))
    return cand.withColumn("is_valid", is_valid_symbol("candidate"))


def table_symbols(pages: DataFrame, link_prefix: str = "/stocks/", html_col: str = "html",
                  id_col: str = "page_id") -> DataFrame:
    """Valid, distinct, sorted symbols in the second cells of each page's first table.

    A cell gives the symbol its first link names after ``link_prefix``, or else its text. Pages without a
    table, and rows of fewer than two cells, give none.
    """
    table = F.regexp_extract(F.col(html_col), r"(?is)<table\b[^>]*>(.*?)</table>", 1)
    rows = pages.select(id_col, F.explode(F.regexp_extract_all(
        table, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr>|$)"), 1)).alias("row"))
    cells = F.regexp_extract_all("row", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=<t[dh]\b|</t[dh]>|$)"), 1)
    cell = rows.select(id_col, F.get(cells, F.lit(1)).alias("cell")).filter("cell IS NOT NULL")
    href = F.regexp_extract("cell", r"(?is)<a\b[^>]*?href\s*=\s*[\"']([^\"']*)", 1)
    link = F.upper(F.regexp_replace(F.element_at(F.split(href, re.escape(link_prefix)), 2), "/+$", ""))
    text = F.upper(F.regexp_replace(F.regexp_replace("cell", "<[^>]*>", ""), r"^\s+|\s+$", ""))
    named = cell.select(id_col, F.when(F.contains(href, F.lit(link_prefix)), link).alias("link"), text.alias("text"))
    found = named.select(id_col, F.when(is_valid_symbol("link"), F.col("link"))
                         .when(is_valid_symbol("text"), F.col("text")).alias("symbol")).filter("symbol IS NOT NULL")
    return found.groupBy("symbol").agg(F.count_distinct(id_col).alias("n_pages")).orderBy("symbol")


def extract_symbols(pages: DataFrame, link_prefix: str = "/stocks/", html_col: str = "html",
                    id_col: str = "page_id") -> DataFrame:
    """Valid, distinct, sorted symbols linked from anywhere in the pages, with the number of pages linking them."""
    c = link_candidates(pages, link_prefix, html_col, id_col).filter("is_valid")
    return (c.groupBy(F.col("candidate").alias("symbol"))
            .agg(F.count_distinct(id_col).alias("n_pages"))
            .orderBy("symbol"))
