"""A paged feature service as a Spark data source: page readers side by side, equality filters pushed to the pages."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote
from urllib.request import urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hazardspark import schemas

FORMAT = "feature_pages"


def read_pages(
    spark: SparkSession, pages: str, kind: str | None = "Cheia", page_size: int = 1000, readers: int | None = None
) -> DataFrame:
    """Attributes of all features of a paged service; ``kind`` keeps one nature of event.

    ``pages`` names a page by ``{page}`` (from 0) or ``{offset}``, takes the size as ``{size}`` and the pushed filters
    as ``{where}``: an http(s) address, or files or folders of files that every executor can open. ``readers`` tasks
    (default: the session's parallelism) read every readers-th page until one is missing or empty; a service that pages
    by offset has no pages after that. Each page is held alone. An error other than a missing page fails the task, so
    that Spark reads its pages again. A row's missing attributes are null, those that do not fit their type too.
    """
    # Spark refuses a reader with pushed filters unless this is set.
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeaturePages)
    readers = readers or spark.sparkContext.defaultParallelism
    rows = spark.read.format(FORMAT).options(pages=pages, size=str(page_size), readers=str(readers)).load()
    return rows if kind is None else rows.where(F.col("Natureza") == kind)


class FeaturePages(DataSource):
    """``spark.read.format("feature_pages")`` with the options pages, size and readers of ``read_pages``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return schemas.FEATURE_PAGE["features"].dataType.elementType["attributes"].dataType

    def reader(self, schema: StructType) -> DataSourceReader:
        return PageReader(schema, self.options)


@dataclass
class Stride(InputPartition):
    first: int
    step: int


class PageReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.columns = schema
        self.template = options["pages"]
        self.size = int(options.get("size", "1000"))
        self.readers = int(options.get("readers", "8"))
        self.equal: dict[str, object] = {}

    def pushFilters(self, filters):
        """Equality of a column with a value is decided here, everything else by Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] not in self.equal:
                self.equal[f.attribute[0]] = f.value
            else:
                yield f

    def partitions(self):
        return [Stride(i, self.readers) for i in range(self.readers)]

    def read(self, partition: Stride) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.columns)
        page = partition.first
        while features := self._features(page):
            rows = [(f or {}).get("attributes") or {} for f in features]
            columns = {c.name: [fitted(r.get(c.name), c.type) for r in rows] for c in arrow}
            keep = [i for i in range(len(rows)) if all(columns[c][i] == v for c, v in self.equal.items())]
            if keep:
                yield pa.RecordBatch.from_arrays([pa.array([columns[c.name][i] for i in keep], c.type) for c in arrow], schema=arrow)
            page += partition.step

    def _features(self, page: int) -> list:
        where = " AND ".join(f"{c}={literal(v)}" for c, v in self.equal.items()) or "1=1"
        texts = fetch(self.template.format(page=page, offset=page * self.size, size=self.size, where=quote(where)))
        return [f for text in texts if text.strip() for f in json.loads(text).get("features") or []]


def literal(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def fitted(value: object, kind: pa.DataType) -> object:
    """A JSON value as its column's type; null where it does not fit."""
    if value is None:
        return None
    if pa.types.is_string(kind):
        return value if isinstance(value, str) else json.dumps(value)
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return None
    if pa.types.is_floating(kind):
        return float(value)
    return int(value) if int(value) == value and -(2**63) <= value < 2**63 else None


def fetch(address: str) -> list[str]:
    """The texts at an address: a response, a file, or the files of a folder; none where nothing is."""
    from pyarrow import fs

    if address.startswith(("http://", "https://")):
        with urlopen(address, timeout=60) as response:
            return [response.read().decode("utf-8")]
    files, path = fs.FileSystem.from_uri(address)
    info = files.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        return []
    found = [info] if info.is_file else sorted(files.get_file_info(fs.FileSelector(path)), key=lambda i: i.path)
    texts = []
    for item in found:
        if item.is_file and not item.base_name.startswith(("_", ".")):
            with files.open_input_stream(item.path) as stream:
                texts.append(stream.read().decode("utf-8"))
    return texts
