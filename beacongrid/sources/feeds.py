"""RSS and Atom feeds, landed as text, to items; strict first, then forgiving."""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITEMS = "feed string, title string, link string, description string, published string, source string"


def _day(text: str | None) -> str | None:
    """ISO day of a mail-style or ISO date."""
    if not text:
        return None
    if m := re.match(r"\d{4}-\d{2}-\d{2}", text.strip()):
        return m[0]
    try:
        return parsedate_to_datetime(text.strip()).date().isoformat()
    except (TypeError, ValueError):
        return None


def _href(item: str) -> str | None:
    return html.unescape(m[1]) if (m := re.search(r"<link\b[^>]*\bhref=[\"']([^\"']*)", item, re.I)) else None


def _plain(tag: str) -> str:
    return tag.rpartition("}")[2].lower()


def items_of(xml: str | None, kind: bool = False) -> list[tuple] | tuple[str, list[tuple]]:
    """(title, link, description, day, source host) of each item. A feed that isn't well formed is read by its tags. With `kind`: (`strict` or `lenient`, items), and dates stay as they are said."""
    told: list[str] = []
    items = _items(xml, told, (lambda d: d) if kind else _day)
    return (told[0], items) if kind else items


def _items(xml: str | None, told: list[str], _day) -> list[tuple]:
    told.append("lenient" if not xml else "strict")
    if not xml:
        return []
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        told[0] = "lenient"
        get = lambda s, t: html.unescape(re.sub(r"<!\[CDATA\[|\]\]>", "", m[1])).strip() if (m := re.search(rf"<{t}\b[^>]*>(.*?)</{t}>", s, re.S | re.I)) else None
        return [(get(s, "title"), get(s, "link") or _href(s), get(s, "description") or get(s, "summary"), _day(get(s, "pubDate") or get(s, "published") or get(s, "updated")), None) for s in re.findall(r"<(?:item|entry)\b.*?</(?:item|entry)>", xml, re.S | re.I)]
    out = []
    for e in root.iter():
        if _plain(e.tag) in ("item", "entry"):
            own = {}
            for c in e:
                own.setdefault(_plain(c.tag), c)
            text = lambda *names: next((own[n].text.strip() for n in names if n in own and own[n].text), None)
            link = text("link") or (own["link"].get("href") if "link" in own else None)
            src = own["source"].get("url") if "source" in own else None
            host = re.sub(r"^www\.", "", re.match(r"https?://([^/]+)", src)[1]) if src and re.match(r"https?://", src) else None
            out.append((text("title"), link, text("description", "summary", "content"), _day(text("pubdate", "published", "updated")), host))
    return out


def parse(df: DataFrame, feed: str, xml: str) -> DataFrame:
    """One row an item of each feed text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(f, *i) for f, x in zip(pdf["f"], pdf["x"], strict=True) for i in items_of(x)], columns=[c.split()[0] for c in ITEMS.split(", ")])

    return df.select(F.col(feed).alias("f"), F.col(xml).alias("x")).mapInPandas(run, ITEMS)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Items of landed feed files, one file a feed."""
    return parse(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("feed"), "value"), "feed", "value")


def fresh(items: DataFrame, as_of: str, days: int = 2) -> DataFrame:
    """Without what is older than `days`; undated items stay."""
    return items.where(F.col("published").isNull() | (F.col("published") >= F.date_sub(F.to_date(F.lit(as_of)), days).cast("string")))
