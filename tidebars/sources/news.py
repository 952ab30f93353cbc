"""News: nested JSON results and landed article pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebars.functions import schemas


def read_news_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One row per entry of ``news_results``; files without it give no rows."""
    reader = spark.read.option("multiLine", True)
    if schema:
        reader = reader.schema(f"news_results ARRAY<{schema}>")
    raw = reader.json(path)
    if "news_results" not in raw.columns:
        return raw.limit(0)
    return raw.select(F.explode("news_results").alias("item")).select("item.*")


def explode_news(df: DataFrame, column: str, item: str) -> DataFrame:
    """The same for JSON text in a column; ``item`` is the entry type."""
    parsed = F.from_json(column, f"news_results ARRAY<{item}>")
    return df.select(F.explode(parsed["news_results"]).alias("item")).select("item.*")


def json_path(column: str, path: str):
    return F.get_json_object(column, path)


_VOID = {"br", "img", "hr", "input", "meta", "link", "source", "wbr", "col", "area", "base", "embed", "track"}


class _ArticleParser(HTMLParser):
    """Collects title, date, summary and first link of each ``.article`` element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self._open: list[str] = []
        self._article_depth: int | None = None
        self._field: tuple[str, int] | None = None

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        classes = (attributes.get("class") or "").split()
        if tag not in _VOID:
            self._open.append(tag)
        if self._article_depth is None:
            if tag == "article" or "article" in classes:
                self._article_depth = len(self._open)
                self.found.append({"title": None, "date": None, "summary": None, "link": None})
            return
        article = self.found[-1]
        if tag == "a" and article["link"] is None and attributes.get("href"):
            article["link"] = attributes["href"]
        if self._field is None:
            for name in ("title", "date", "summary"):
                if name in classes and article[name] is None:
                    article[name] = ""
                    self._field = (name, len(self._open))

    def handle_endtag(self, tag):
        if tag in _VOID or tag not in self._open:
            return
        while self._open:
            last = self._open.pop()
            if self._field and len(self._open) < self._field[1]:
                self._field = None
            if self._article_depth is not None and len(self._open) < self._article_depth:
                self._article_depth = None
            if last == tag:
                break

    def handle_data(self, data):
        if self._field:
            self.found[-1][self._field[0]] += data


def _articles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["title", "date", "summary", "link"]
    for batch in batches:
        rows = []
        for text in batch.iloc[:, 0].dropna():
            parser = _ArticleParser()
            parser.feed(text)
            parser.close()
            rows.extend({k: v.strip() if v else v for k, v in a.items()} for a in parser.found)
        yield pd.DataFrame(rows, columns=names, dtype=object)


def extract_articles(pages: DataFrame, column: str = "html") -> DataFrame:
    """One row per article element; fields that are absent are NULL."""
    return pages.select(column).mapInPandas(_articles, schemas.ARTICLES)


def page_articles(pages: DataFrame) -> DataFrame:
    """All articles of pages that mark them with ``article``, ``h1`` and ``p``, in any case and with or without attributes.

    Built-in expressions throughout: heading, first paragraph, page address.  An article that a page cut
    off does not close ends with the page.
    """
    inner = F.col("_article")
    heading = F.regexp_extract(inner, r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>", 1)
    paragraph = F.regexp_extract(inner, r"(?is)<p(?:\s[^>]*)?>(.*?)(?:</p\s*>|<p[\s>])", 1)
    each = F.regexp_extract_all("html", F.lit(r"(?is)<article(?:\s[^>]*)?>(.*?)(?:</article\s*>|\z)"), 1)
    return pages.withColumn("_article", F.explode(each)).select(
        "page_id",
        F.nullif(heading, F.lit("")).alias("title"),
        F.lit(None).cast("string").alias("date"),
        F.nullif(paragraph, F.lit("")).alias("summary"),
        F.col("url").alias("link"),
    )


