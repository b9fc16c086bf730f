"""Feeds and databases as Spark data sources.

``read_feeds`` reads RSS and Atom documents of any file system, ``press_feed`` local ones, one
partition per file, and ``press_sqlite`` reads a query of a SQLite file, split by ranges of a key."""

from __future__ import annotations

import glob
import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from presslake.operators.records import unseen

FEED_SCHEMA = "feed string, guid string, title string, link string, published string, author string, summary string, content string, error string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2].lower()


def entries_of(document: str) -> list[dict]:
    """Entries of an RSS or Atom document; content falls back to summary, then description."""
    if "<!DOCTYPE" in document or "<!ENTITY" in document:
        raise ValueError("documents with entities are not read")
    out = []
    for item in ET.fromstring(document).iter():
        if _local(item.tag) not in ("item", "entry"):
            continue
        found: dict[str, str] = {}
        for child in item:
            name, value = _local(child.tag), "".join(child.itertext()).strip()
            if name == "link":
                value = value or child.get("href", "")
                if child.get("rel", "alternate") != "alternate":
                    continue
            found.setdefault(name, value)
        pick = lambda *names: next((found[n] for n in names if found.get(n)), "")
        out.append(
            {
                "guid": pick("guid", "id"), "title": pick("title"), "link": pick("link"), "published": pick("pubdate", "published", "updated", "date"),
                "author": pick("author", "creator"), "summary": pick("summary", "description"), "content": pick("encoded", "content", "summary", "description"),
            }
        )
    return out


def read_feeds(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """Entries of the feed documents under ``path`` (a folder or pattern of any file system
    that Spark reads), with FEED_SCHEMA; many small files share a task.  ``only`` are names of
    files, without ending, to keep.  A document that can't be read is a row with an error."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    if only is not None:
        files = files.where(F.regexp_extract("path", r"([^/]*?)(?:\.\w+)?$", 1).isin(only))
    names = [f.split()[0] for f in FEED_SCHEMA.split(", ")]

    def read(batches):
        for b in batches:
            rows = []
            for where, content in zip(b["path"], b["content"]):
                try:
                    rows += [(where, *[x[n] for n in names[1:-1]], None) for x in entries_of(content.decode("utf-8", "replace"))]
                except (ET.ParseError, ValueError) as e:
                    rows.append((where, *[None] * (len(names) - 2), str(e)))
            if rows:
                yield pd.DataFrame(rows, columns=names, dtype=object)

    return files.mapInPandas(read, FEED_SCHEMA)


def new_entries(entries: DataFrame, seen: DataFrame, key: str = "guid") -> DataFrame:
    """Entries whose key was not seen before, the first of each by feed; entries without key
    or with an error are left out."""
    known = entries.where((F.coalesce(F.col(key), F.lit("")) != "") & F.col("error").isNull())
    return unseen(known, seen, key, [F.col("feed"), F.col("link")])


class FeedFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class FeedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return [FeedFile(p) for p in sorted(glob.glob(self.options["path"]))] or [FeedFile("")]

    def read(self, partition):
        if not partition.path:
            return
        try:
            entries = entries_of(open(partition.path, encoding="utf-8", errors="replace").read())
        except (ET.ParseError, ValueError, OSError) as e:  # a failed feed is a row, not a failed job
            yield (partition.path, *[None] * 7, str(e))
            return
        for x in entries:
            yield (partition.path, x["guid"], x["title"], x["link"], x["published"], x["author"], x["summary"], x["content"], None)


class FeedSource(DataSource):
    """Options: path, a glob of files every executor sees."""

    @classmethod
    def name(cls):
        return "press_feed"

    def schema(self):
        return FEED_SCHEMA

    def reader(self, schema: StructType):
        return FeedReader(self.options)


class KeyRange(InputPartition):
    def __init__(self, low, high, last: bool):
        self.low, self.high, self.last = low, high, last


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.schema = options, schema

    def _connect(self):
        import sqlite3

        return sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True)

    def partitions(self):
        key, n = self.options.get("key"), int(self.options.get("partitions", 1))
        if not key or n < 2:
            return [KeyRange(None, None, True)]
        if not re.fullmatch(r"\w+", key):
            raise ValueError("key must be a column name")
        with self._connect() as c:
            low, high = c.execute(f"select min({key}), max({key}) from ({self.options['query']})").fetchone()
        if low is None:
            return [KeyRange(None, None, True)]
        steps = [low + (high - low + 1) * i // n for i in range(n + 1)]
        return [KeyRange(a, b, False) for a, b in zip(steps, steps[1:])]

    def read(self, partition):
        names = ", ".join(f'"{f.name}"' for f in self.schema.fields)
        with self._connect() as c:
            if partition.low is None:
                yield from c.execute(f"select {names} from ({self.options['query']})")
            else:
                key = self.options["key"]
                yield from c.execute(f"select {names} from ({self.options['query']}) where {key} >= ? and {key} < ?", (partition.low, partition.high))


class SqliteSource(DataSource):
    """Options: path, query, and key with partitions to split by an integer key."""

    @classmethod
    def name(cls):
        return "press_sqlite"

    def schema(self):
        raise ValueError("give a schema")

    def reader(self, schema: StructType):
        return SqliteReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FeedSource)
    spark.dataSource.register(SqliteSource)
