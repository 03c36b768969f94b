"""A data source over paged JSON payloads: each page is one partition, read by the executors."""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Pages that are read at most unless the option maxPages says otherwise; more are an error.
MAX_PAGES = 1000


class Page(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


def _file_system(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def page_files(root: str, name: str) -> list[tuple[int, str]]:
    """(number, path) of the page files in order; only the folder is listed, no page is opened."""
    from pyarrow import fs as arrow

    fs, folder = _file_system(root)
    number = re.compile(name + "$")
    found = [(m, i.path) for i in fs.get_file_info(arrow.FileSelector(folder)) if i.is_file and (m := number.match(posixpath.basename(i.path)))]
    return sorted((int(m[1]), path) for m, path in found)


def converted(value: object, kind: T.DataType) -> object:
    """A JSON value as a value of a column's type; one that doesn't convert is null."""
    if value is None:
        return None
    try:
        if isinstance(kind, T.StringType):
            return value if isinstance(value, str) else json.dumps(value)
        if isinstance(kind, T.BooleanType):
            return value if isinstance(value, bool) else {"true": True, "false": False}.get(str(value).lower())
        if isinstance(kind, T.IntegralType):
            return int(value)
        if isinstance(kind, T.FractionalType):
            return float(value)
        if isinstance(kind, T.DateType):
            return dt.date.fromisoformat(str(value)[:10])
    except (TypeError, ValueError, OverflowError):
        return None
    raise TypeError(f"a page has no columns of type {kind.simpleString()}")


class _Pages:
    """What the readers of batches and streams share.

    Options: ``path``; ``pattern``, a regular expression of the file names whose first group is the page number;
    ``rows``, the dotted place of the rows in a page; ``maxPages``, and ``more``: ``error`` (the default) or ``stop`` where
    there are more pages.
    """

    def __init__(self, schema: T.StructType, options: dict) -> None:
        self.schema, self.root = schema, options["path"]
        self.pattern, self.rows = options.get("pattern", r"page-(\d+)\.json"), options.get("rows", "results").split(".")
        self.most, self.more = int(options.get("maxpages", MAX_PAGES)), options.get("more", "error")

    def files(self) -> list[tuple[int, str]]:
        found = page_files(self.root, self.pattern)
        if len(found) > self.most and self.more != "stop":
            raise ValueError(f"{len(found)} pages in {self.root}, but maxPages is {self.most}; set maxPages, or more=stop to leave the rest out")
        return found[: self.most]

    def read(self, partition: Page) -> Iterator[tuple]:
        fs, _ = _file_system(self.root)
        with fs.open_input_stream(partition.path) as f:
            body = json.loads(f.read())
        for step in self.rows:
            body = (body or {}).get(step)
        for row in body or []:
            if isinstance(row, list):  # positional rows
                row = dict(zip(self.schema.names, row, strict=False))
            yield tuple(converted(row.get(c.name), c.dataType) for c in self.schema.fields)


class PagedReader(_Pages, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return [Page(p) for _, p in self.files()]


class PagedStream(_Pages, DataSourceStreamReader):
    """Pages as they arrive, in the order of their numbers; the offset is the greatest number seen.

    The vendor numbers its pages upwards; a page with a lower number than one already read is an error, not a silent gap.
    """

    def __init__(self, schema: T.StructType, options: dict) -> None:
        super().__init__(schema, {"more": "stop", "maxpages": str(1 << 31), **options})
        self.seen: set[int] = set()

    def initialOffset(self) -> dict:
        return {"page": -1}

    def latestOffset(self) -> dict:
        numbers = {n for n, _ in self.files()}
        if self.seen and (late := [n for n in numbers - self.seen if n < max(self.seen)]):
            raise ValueError(f"pages {sorted(late)} arrived after page {max(self.seen)}")
        self.seen |= numbers
        return {"page": max(numbers, default=-1)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [Page(p) for n, p in self.files() if start["page"] < n <= end["page"]]


class PagedJson(DataSource):
    """``spark.read.format("paged_json").schema(...).option("path", folder)``, or ``readStream``.

    Page files lie in a folder or bucket that all nodes see; without a schema the rows are tickers.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "ticker string, name string, composite_figi string, primary_exchange string, type string, last_updated_utc string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PagedStream(schema, self.options)


def register(spark) -> None:
    spark.dataSource.register(PagedJson)
