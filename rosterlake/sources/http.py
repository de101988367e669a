"""HTTP on the standard library: one fetch with retries, and JSON APIs as a Python data source (one partition per page)."""

from __future__ import annotations

import codecs
import copy
import json
import re
import ssl
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..shipping import ship

# Fixed value: the agent that sources are asked with by default.
USER_AGENT = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0 Safari/537.36"


#: Encodings of one byte for each letter that are tried on what is no UTF-8 and names no encoding; the first wins a tie.
OLD_ENCODINGS = ("cp1251", "koi8-r", "cp1252")


def _known(name: str | None) -> str | None:
    try:
        return codecs.lookup(name.strip("\"' ")).name if name else None
    except LookupError:
        return None


def charset_of(content: bytes, content_type: str = "") -> str:
    """By mark, by being valid UTF-8, by the header, by the document's own declaration, else by the letters: of the old encodings the
    one in which most letters above ASCII are small ones beside letters of the same script."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")):
        if content.startswith(mark):
            return name
    try:
        content.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        pass
    declared = re.search(rb"(?i)<meta[^>]+charset\s*=\s*[\"']?([\w.:-]+)|<\?xml[^>]+encoding\s*=\s*[\"']([\w.:-]+)", content[:4096])
    header = re.search(r"(?i)charset\s*=\s*([^;\s]+)", content_type)
    names = [_known(header[1] if header else None), _known((declared[1] or declared[2]).decode("ascii")) if declared else None]
    named = next((n for n in names if n and n != "utf-8"), None)
    if named:
        return named

    def fitting(name: str) -> int:
        text = content.decode(name, errors="replace")
        return len(re.findall(r"(?:(?<=[\u0400-\u04ff])|(?<![\w\u0400-\u04ff]))[\u0430-\u044f]", text)) if name != "cp1252" else len(re.findall(r"(?<=[a-z])[\u00e0-\u00ff]", text))

    return max(OLD_ENCODINGS, key=fitting)


@dataclass
class Response:
    url: str
    headers: dict[str, str]
    content: bytes

    def text(self, encoding: str | None = None) -> str:
        return self.content.decode(encoding or charset_of(self.content, self.headers.get("content-type", "")), errors="replace")

    def json(self) -> Any:
        return json.loads(self.content)


def fetch(url: str, method: str = "GET", options: dict[str, Any] | None = None) -> Response:
    """Options: verify_ssl, user_agent, headers, params, body (JSON), timeout (60), retries (3), retry_backoff (2.0; the wait
    grows linearly). RuntimeError after the last try."""
    o = options or {}
    if o.get("params"):
        url += ("&" if "?" in url else "?") + urllib.parse.urlencode(o["params"], doseq=True)
    headers = {"User-Agent": o.get("user_agent") or USER_AGENT} | (o.get("headers") or {})
    data = None
    if o.get("body") is not None:
        data, headers = json.dumps(o["body"]).encode(), {"Content-Type": "application/json"} | headers
    context = None if o.get("verify_ssl", True) or not url.startswith("https:") else ssl._create_unverified_context()
    error: Exception | None = None
    for attempt in range(1, int(o.get("retries", 3)) + 1):
        try:
            request = urllib.request.Request(url, data=data, headers=headers, method=method.upper())
            with urllib.request.urlopen(request, timeout=o.get("timeout", 60), context=context) as found:
                return Response(found.geturl(), {k.lower(): v for k, v in found.headers.items()}, found.read())
        except OSError as e:
            error = e
            if attempt < int(o.get("retries", 3)):
                time.sleep(float(o.get("retry_backoff", 2.0)) * attempt)
    raise RuntimeError(f"{url} could not be loaded: {error}") from error


def dig(data: Any, path: str | None) -> Any:
    """Down a dotted path of dictionary keys; a missing key raises KeyError."""
    for key in path.split(".") if path else ():
        data = data[key]
    return data


@dataclass
class Page(InputPartition):
    offset: int


class ApiReader(DataSourceReader):
    def __init__(self, options: dict[str, Any]):
        self.o = options
        p = self.o.get("paginate")
        self.paginate = p
        if p:
            self.body = copy.deepcopy(self.o.get("body") or {})
            self.offset_field, self.limit_field = p.get("offset_field", "offset"), p.get("limit_field", "limit")
            self.size = int(p.get("page_size", self.body.get(self.limit_field, 200)))
            self.total_path = p.get("total_path", "size")
            self.records_path = self.o.get("records_path", "values")

    def _page(self, offset: int) -> Any:
        body = copy.deepcopy(self.body) | {self.offset_field: offset, self.limit_field: self.size}
        return fetch(self.o["url"], str(self.o.get("method", "POST")), self.o | {"body": body}).json()

    def partitions(self) -> list[InputPartition]:
        """With a known total one partition per page; without, a single one that asks until a page is empty."""
        if not self.paginate:
            return [Page(-1)]
        total = dig(self._page(0), self.total_path) if self.total_path else None
        if not isinstance(total, int):
            return [Page(-2)]
        pages = min(int(self.paginate.get("max_pages", 1000)), max(1, -(-total // self.size)))
        return [Page(i * self.size) for i in range(pages)]

    def read(self, partition: Page) -> Iterator[tuple[int, str]]:
        if partition.offset == -1:
            found = dig(fetch(self.o["url"], str(self.o.get("method", "GET")), self.o).json(), self.o.get("records_path"))
            yield from self._rows(0, found if isinstance(found, list) else [found])
            return
        offset = max(0, partition.offset)
        for _ in range(1 if partition.offset >= 0 else int(self.paginate.get("max_pages", 1000))):
            batch = dig(self._page(offset), self.records_path) or []
            yield from self._rows(offset, batch)
            if not batch:
                return
            offset += self.size

    def _rows(self, first: int, records: list) -> Iterator[tuple[int, str]]:
        for i, r in enumerate(records):
            yield first + i, json.dumps(r, ensure_ascii=False)


class ApiSource(DataSource):
    """Rows (_row_ord, record): each record as JSON text. The options are one JSON text, `config`."""

    @classmethod
    def name(cls) -> str:
        return "rosterlake_api"

    def schema(self) -> str:
        return "_row_ord long, record string"

    def reader(self, schema: Any) -> DataSourceReader:
        return ApiReader(json.loads(self.options["config"]))


def read_api(spark: SparkSession, url: str, options: dict[str, Any]) -> DataFrame:
    from .files import flatten_records

    ship(spark)
    spark.dataSource.register(ApiSource)
    raw = spark.read.format("rosterlake_api").option("config", json.dumps(options | {"url": url})).load()
    return flatten_records(raw)
