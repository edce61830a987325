"""A remote graph service as a data source of Spark's: spark.read.format("nomograph_service").

A table of the service is read in pages, a task each for a part of them. A page is a result document in JSON, as graph stores
give it: {"results": {"bindings": [{name: {"type": ..., "value": ...}, ...}]}}. Where a service lives under http(s), a page is
one request; where pages are stored (file, or any other store that Arrow knows), it is one line of a file.

Filters that compare a column with values go along with the request, and a page's rows are held against them before
they become Spark's. What can succeed later is tried again (attempts, with doubling pauses); what can't, a request that
is wrong or a table that isn't there, fails at once.

Options: url, table, partitions (of an http service; stored pages have a part for each file), attempts, pause_ms,
timeout_ms. The schema is the caller's: string, long, int, double, boolean, date or timestamp columns.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from datetime import date, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from nomograph.session import ship

NAME = "nomograph_service"
#: Rows of a batch that a page's rows become.
BATCH = 1000
#: Stored pages of a file.
FILE = 8

#: reason -> whether trying again may help.
TRANSIENT = {"invalid_query": False, "not_found": False, "unavailable": True, "timeout": True}


class ServiceError(Exception):
    def __init__(self, reason: str, message: str):
        super().__init__(f"{reason}: {message}")
        self.reason, self.transient = reason, TRANSIENT[reason]

    def __reduce__(self):
        return ServiceError, (self.reason, str(self).partition(": ")[2])


def of_status(status: int, body: str) -> ServiceError | None:
    """What an answer's status says, and an error text where a result should be."""
    if status == 400:
        return ServiceError("invalid_query", body[:200])
    if status == 404:
        return ServiceError("not_found", body[:200])
    if status in (408, 504):
        return ServiceError("timeout", f"status {status}")
    if not 200 <= status < 300:
        return ServiceError("unavailable", f"status {status}")
    head = body.lstrip()[:2000].lower()
    if head.startswith("<"):  # a page for readers, of a proxy or of an access check
        return ServiceError("unavailable", "HTML in place of JSON")
    if "timeout" in head and not head.startswith("{"):
        return ServiceError("timeout", body[:200])
    if "error" in head and not head.startswith("{"):
        return ServiceError("invalid_query", body[:200])
    return None


def bindings(body: str) -> list[dict[str, str]]:
    """The rows of a result document, each value as its text."""
    if error := of_status(200, body):
        raise error
    try:
        rows = json.loads(body)["results"]["bindings"]
        return [{name: term["value"] for name, term in row.items()} for row in rows]
    except (ValueError, KeyError, TypeError, AttributeError):
        raise ServiceError("unavailable", "no result document") from None


def retried(f: Callable[[], str], attempts: int, pause_ms: int, sleep: Callable[[float], None] = time.sleep) -> str:
    """f's answer; transient failures are tried again, each time after twice the pause."""
    for n in range(attempts):
        try:
            return f()
        except ServiceError as e:
            if not e.transient or n + 1 == attempts:
                raise
            sleep(pause_ms * 2**n / 1000)
    raise ServiceError("unavailable", "no attempts")


def path_of(*parts: str) -> str:
    """Parts as a path of a URL: spaces and signs are escaped, slashes inside a part too."""
    return "/".join(urllib.parse.quote(p, safe="") for p in parts)


def get(url: str, timeout_ms: int) -> str:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/sparql-results+json"}), timeout=timeout_ms / 1000) as answer:
            status, body = answer.status, answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        status, body = e.code, e.read().decode("utf-8", "replace")
    except TimeoutError:
        raise ServiceError("timeout", url) from None
    except urllib.error.URLError as e:
        raise ServiceError("timeout" if isinstance(e.reason, TimeoutError) else "unavailable", str(e.reason)) from None
    except (OSError, ValueError) as e:
        raise ServiceError("unavailable", str(e)) from None
    if error := of_status(status, body):
        raise error
    return body


# Values as their columns' kinds; text that isn't one of them is null.
_BOOLEAN = {"true": True, "1": True, "false": False, "0": False}
_KINDS: dict[str, Callable[[str], object]] = {"string": str, "long": int, "bigint": int, "int": int, "double": float, "boolean": _BOOLEAN.get, "date": date.fromisoformat, "timestamp": datetime.fromisoformat, "timestamp_ntz": datetime.fromisoformat}


def _typed(kind: str, text: str | None) -> object:
    try:
        return None if text is None else _KINDS[kind](text)
    except ValueError:
        return None


_TESTS: dict[type, tuple[str, Callable[[object, object], bool]]] = {
    EqualTo: ("eq", lambda x, y: x == y),
    In: ("in", lambda x, y: x in y),
    GreaterThan: ("gt", lambda x, y: x > y),
    GreaterThanOrEqual: ("ge", lambda x, y: x >= y),
    LessThan: ("lt", lambda x, y: x < y),
    LessThanOrEqual: ("le", lambda x, y: x <= y),
}


class Part(InputPartition):
    def __init__(self, value: str):
        super().__init__(value)


class ServiceReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.fields = [(f.name, f.dataType.simpleString()) for f in schema]
        if odd := [k for _, k in self.fields if k not in _KINDS]:
            raise ValueError(f"columns of {odd} can't be read")
        self.arrow = to_arrow_schema(schema)
        self.url, self.table = options["url"].rstrip("/"), options["table"]
        self.parts, self.attempts = int(options.get("partitions", 4)), int(options.get("attempts", 3))
        self.pause_ms, self.timeout_ms = int(options.get("pause_ms", 200)), int(options.get("timeout_ms", 55_000))
        self.tests: list[tuple[str, str, object]] = []

    def _remote(self) -> bool:
        return self.url.startswith(("http://", "https://"))

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(f"{self.url}/{self.table}") if "://" in self.url or self.url.startswith("file:") else (fs.LocalFileSystem(), f"{self.url}/{self.table}")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps the comparisons of a whole column with values; Spark checks the others."""
        names = {n for n, _ in self.fields}
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in names and f.value is not None:
                self.tests.append((_TESTS[type(f)][0], f.attribute[0], f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self._remote():
            return [Part(str(k)) for k in range(self.parts)]
        from pyarrow import fs

        store, top = self._store()
        found = store.get_file_info(fs.FileSelector(top))
        return [Part(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and not f.base_name.startswith((".", "_"))]

    def _pages(self, part: str) -> Iterator[str]:
        if self._remote():
            asked = [("part", part), ("of", str(self.parts))] + [(f"{op}.{name}", json.dumps(list(v) if isinstance(v, tuple) else v, default=str)) for op, name, v in self.tests]
            url = f"{self.url}/{path_of(self.table)}?{urllib.parse.urlencode(asked)}"
            yield retried(lambda: get(url, self.timeout_ms), self.attempts, self.pause_ms)
            return
        store, _ = self._store()
        with store.open_input_stream(part) as stream:
            rest = b""
            while chunk := stream.read(1 << 20):
                *lines, rest = (rest + chunk).split(b"\n")
                yield from (x.decode() for x in lines)
            if rest:
                yield rest.decode()

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        tests = [(dict((op, f) for op, f in _TESTS.values())[op], name, v) for op, name, v in self.tests]
        for page in self._pages(partition.value):
            rows = [{n: _typed(k, row.get(n)) for n, k in self.fields} for row in bindings(page)]
            rows = [r for r in rows if all(r[name] is not None and f(r[name], v) for f, name, v in tests)]
            for at in range(0, len(rows), BATCH):
                yield pa.RecordBatch.from_pylist(rows[at : at + BATCH], schema=self.arrow)


class ServiceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: StructType) -> DataSourceReader:
        return ServiceReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, and lets it take filters."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ServiceSource)


def read(spark: SparkSession, url: str, table: str, schema: str, **options: object) -> DataFrame:
    """A table of the service."""
    register(spark)
    return spark.read.format(NAME).schema(schema).options(url=url, table=table, **{k: str(v) for k, v in options.items()}).load()


def store_pages(df: DataFrame, folder: str, table: str, rows: int = 500) -> None:
    """Writes df as stored pages of about so many rows, nulls left out as a service leaves out what isn't bound."""
    kinds = dict(df.dtypes)
    term = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.lit("uri" if c.endswith("_uri") else "literal").alias("type"), F.col(c).cast("string").alias("value"))).alias(c)
    pages = max(1, -(-df.count() // rows))
    key = F.pmod(F.xxhash64(*kinds), F.lit(pages))
    paged = df.select(key.alias("page"), F.struct(*[term(c) for c in kinds]).alias("row")).groupBy("page").agg(F.to_json(F.struct(F.struct(F.collect_list("row").alias("bindings")).alias("results"))).alias("value"))
    paged.select("value").write.option("maxRecordsPerFile", FILE).text(f"{folder}/{table}")
