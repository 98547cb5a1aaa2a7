"""Feeds as a data source: spark.read.format("landed_feeds") over landed RSS and Atom, by files, with what can't be read kept aside.

Options: `path` (a folder, or a file), `as_of` (ISO time) and `days`: items without a date, and those older than `days` before `as_of`, are left out; without as_of only undated ones are. `advisories` = true: items are travel advisories, so
only those worth it stay (level 3 or 4, or raised; `curated` = a part of the feed's name whose items all stay) and each link ends in #adv-YYYYMMDD, so that an update of a page is an item of its own. `dated` = false keeps undated items.
`bytes`: partitions are about so many bytes: small files are dealt together, and a large file of lines is cut into ranges (of 1 MB at least), of which each holds the lines that begin in it.

A file `*.jsonl` (with `lines` = true, any file) holds a feed a line ({"feed": name, "xml": text}); any other file is one feed, named by its path. Rows: feed, title, link, description, published (UTC), domain, kind (`strict`, `lenient`, or `corrupt` for a feed that holds nothing to
read: then all else is null and corrupt_record is its text). The folder is read through pyarrow's file systems, so a path with a scheme they know is read where it lies.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from email.utils import parsedate_to_datetime

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .feeds import items_of

SCHEMA = "feed string, title string, link string, description string, published timestamp, domain string, kind string, corrupt_record string"


def moment(text: str | None) -> datetime | None:
    """A mail-style or ISO date as UTC; without a zone it counts as UTC; a bare day is its beginning."""
    if not text or not text.strip():
        return None
    text = text.strip()
    for read in (lambda t: datetime.fromisoformat(t.replace("Z", "+00:00")), parsedate_to_datetime, lambda t: datetime.strptime(t, "%a, %d %b %Y"), lambda t: datetime.strptime(t, "%d %b %Y")):
        try:
            at = read(text)
        except (TypeError, ValueError):
            continue
        return at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC)
    return None


def advisory_level(text: str) -> int:
    """The highest numbered level, or 3 or 4 by phrase; 0 if none is named."""
    t = text.lower()
    return max([0, *map(int, re.findall(r"\blevel ([1-4])\b", t)), 4 * ("do not travel" in t), 3 * ("reconsider travel" in t)])


def worth(text: str) -> bool:
    """Level 3 or 4, or raised; never when unchanged or lowered."""
    t = text.lower()
    return not re.search(r"\bno change\b|\blowered\b|\bdecreased\b", t) and bool(advisory_level(t) >= 3 or re.search(r"\braised\b|\bincreased\b", t))


def lines_of(f, begin: int, end: int | None, block: int = 1 << 20) -> Iterator[bytes]:
    """The lines of a file that begin at `begin` or later, and before `end`; held are a block and one line. A line that begins before `begin` is the range's before."""
    at = max(begin - 1, 0)  # a line begins at `begin` if a line ends just before
    f.seek(at)
    rest, skip = [], begin > 0
    while end is None or at < end:
        data = f.read(block)
        if not data:
            break
        *whole, tail = data.split(b"\n")
        for part in whole:
            begun = at - sum(map(len, rest))
            if not skip and (end is None or begun < end):
                yield b"".join([*rest, part])
            skip, rest = False, []
            at += len(part) + 1
            if end is not None and at >= end:
                return
        if tail:
            rest.append(tail)
            at += len(tail)
    # the last line of the range may go on beyond it
    if rest and not skip:
        while b"\n" not in rest[-1] and (data := f.read(block)):
            rest.append(data)
        yield b"".join(rest).partition(b"\n")[0]


class Files(InputPartition):
    """(path, begin, end) each; end is None for a whole file."""

    def __init__(self, parts: list[tuple[str, int, int | None]]):
        super().__init__(0)
        self.parts = parts


class FeedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.as_of = moment(options.get("as_of"))
        self.days = float(options.get("days", "7" if options.get("advisories") == "true" else "2"))

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.options["path"]) if "://" in self.options["path"] else (fs.LocalFileSystem(), self.options["path"].removeprefix("file:"))

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        system, path = self._fs()
        top = system.get_file_info(path)
        found = [top] if top.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
        most, out, size = int(self.options.get("bytes", 16 << 20)), [], 0
        for f in sorted(found, key=lambda f: f.path):
            if f.type != fs.FileType.File or f.base_name.startswith(("_", ".")):
                continue
            if self._lines(f.path) and f.size > (part := max(most, 1 << 20)):
                out.extend([(f.path, at, min(at + part, f.size))] for at in range(0, f.size, part))
                size = most
                continue
            if not out or size + f.size > most:
                out.append([])
                size = 0
            out[-1].append((f.path, 0, None))
            size += f.size
        return [Files(p) for p in out] or [Files([])]

    def _lines(self, path: str) -> bool:
        return path.endswith(".jsonl") or self.options.get("lines") == "true"

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = self._fs()
        for path, begin, end in partition.parts:
            if not self._lines(path):
                with system.open_input_stream(path) as f:
                    yield from self.rows(path, f.read().decode("utf-8", "replace"))
                continue
            with system.open_input_file(path) as f:
                for raw in lines_of(f, begin, end):
                    line = raw.decode("utf-8", "replace")
                    if not line.strip():
                        continue
                    try:
                        one = json.loads(line)
                        name, xml = one["feed"], one["xml"]
                    except (ValueError, KeyError, TypeError):
                        yield (path, *(None,) * 5, "corrupt", line)
                        continue
                    yield from self.rows(name, xml)

    def rows(self, feed: str, xml: str | None) -> Iterator[tuple]:
        kind, items = items_of(xml, kind=True)
        if not items and kind == "lenient":
            yield (feed, *(None,) * 5, "corrupt", xml)
        advisories = self.options.get("advisories") == "true"
        for title, link, description, said, domain in items:
            at = moment(said)
            if at is None and (advisories or self.options.get("dated") != "false"):
                continue
            if at is not None and self.as_of is not None and at < self.as_of - timedelta(days=self.days):
                continue
            if advisories:
                plain = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", description or "")).strip()
                curated = self.options.get("curated")
                if not title or not link or not (curated and curated in feed or worth(f"{title} {plain}")):
                    continue
                link, description = f"{link}#adv-{at:%Y%m%d}", plain
            yield (feed, title, link, description, at, domain, kind, None)


class LandedFeeds(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_feeds"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FeedReader:
        if not self.options.get("path"):
            raise ValueError("landed_feeds needs a path")
        return FeedReader(dict(self.options))


def register(spark: SparkSession) -> SparkSession:
    from ..session import reachable

    reachable(spark).dataSource.register(LandedFeeds)
    return spark
