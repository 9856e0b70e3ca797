"""Notices read from a service that pages its answers, and documents sent to one: Spark data sources in Python.

    spark.dataSource.register(NoticeSource)
    spark.read.format("notices").option("url", "http://host/api/v1").load().where("type = 'Rule' and publication_date >= '2012-01-01'")

Every page is a task of its own. Conditions that the service knows are sent to it (spark.sql.python.filterPushdown.enabled has to be
true for that); Spark checks all conditions again on what comes back, so a service that does not know them gives the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, GreaterThanOrEqual, InputPartition, LessThanOrEqual, WriterCommitMessage

from .readers import NOTICE_SCHEMA

#: Fields that are asked for: fixed names of the service.
NOTICE_FIELDS = "abstract action agency_names cfr_references citation comments_close_on dates document_number effective_on end_page full_text_xml_url html_url publication_date regulation_id_numbers start_page type volume".split()
#: The service's names of conditions, by column and comparison: fixed values.
CONDITIONS = {
    ("type", EqualTo): "conditions[type][]",
    ("publication_date", GreaterThanOrEqual): "conditions[publication_date][gte]",
    ("publication_date", LessThanOrEqual): "conditions[publication_date][lte]",
    ("effective_on", GreaterThanOrEqual): "conditions[effective_date][gte]",
    ("effective_on", LessThanOrEqual): "conditions[effective_date][lte]",
}
#: The service's word for each type.
TYPES = {"Rule": "RULE", "Proposed Rule": "PRORULE", "Notice": "NOTICE"}
DATES = ("publication_date", "effective_on", "comments_close_on")


def fetch(url: str, params: list[tuple[str, str]] = (), body: bytes | None = None, tries: int = 4, method: str | None = None, wait: float = 0.2) -> bytes:
    """The answer's bytes. Errors of the server and of the line are tried again, after longer and longer waits; others are raised."""
    import time
    import urllib.error
    import urllib.parse
    import urllib.request

    where = url + ("?" + urllib.parse.urlencode(params) if params else "")
    for i in range(tries):
        try:
            request = urllib.request.Request(where, body, {"Content-Type": "application/json"} if body is not None else {}, method=method)
            with urllib.request.urlopen(request, timeout=60) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            if e.code < 500 or i + 1 == tries:
                raise
        except urllib.error.URLError:
            if i + 1 == tries:
                raise
        time.sleep(wait * 2**i)
    raise AssertionError("tries has to be positive")


@dataclass
class Page(InputPartition):
    number: int


class NoticeReader(DataSourceReader):
    def __init__(self, options: dict):
        if "url" not in options:
            raise ValueError("the notices' source needs an option url")
        self.url, self.size = options["url"].rstrip("/") + "/articles", int(options.get("pagesize", 1000))
        self.asked = [(f"conditions[cfr][{k}]", options[k]) for k in ("title", "part") if k in options]

    def pushFilters(self, filters: list) -> Iterator:
        """Conditions that the service knows are sent; all are given back, so Spark applies each of them again."""
        for f in filters:
            name = CONDITIONS.get((f.attribute[0], type(f))) if len(getattr(f, "attribute", ())) == 1 else None
            value = TYPES.get(f.value) if name == "conditions[type][]" else str(f.value) if name else None
            if value is not None:
                self.asked.append((name, value))
            yield f

    def _params(self, page: int) -> list[tuple[str, str]]:
        return [*self.asked, ("order", "oldest"), ("per_page", str(self.size)), ("page", str(page)), *(("fields[]", f) for f in NOTICE_FIELDS)]

    def partitions(self) -> list[Page]:
        """A partition for each page: one small question tells how many there are."""
        count = json.loads(fetch(self.url, [*self.asked, ("per_page", "1"), ("page", "1"), ("fields[]", "document_number")])).get("count", 0)
        return [Page(i + 1) for i in range(-(-count // self.size))]

    def read(self, partition: Page | None) -> Iterator[tuple]:
        import datetime

        if partition is None:  # Spark's way to read a source of no partitions
            return
        for r in json.loads(fetch(self.url, self._params(partition.number))).get("results", []):
            days = {c: datetime.date.fromisoformat(r[c]) if r.get(c) else None for c in DATES}
            yield (
                r.get("document_number"), days["publication_date"], days["effective_on"], days["comments_close_on"], r.get("abstract"), r.get("action"), r.get("agency_names"),
                [(c.get("title"), c.get("part")) for c in r.get("cfr_references") or []], r.get("citation"), r.get("dates"), r.get("start_page"), r.get("end_page"), r.get("volume"),
                r.get("type"), r.get("html_url"), r.get("full_text_xml_url"), r.get("regulation_id_numbers"),
            )


class NoticeSource(DataSource):
    """Format `notices`. Options: url; title and part (of the code of regulations); pagesize (1000). Pages are read in the order of
    publication; a notice published while pages are read can move others to a later page, so a task that is run again may see
    one twice: document numbers are unique, dropDuplicates(["document_number"]) tells."""

    @classmethod
    def name(cls) -> str:
        return "notices"

    def schema(self) -> str:
        return NOTICE_SCHEMA

    def reader(self, schema) -> NoticeReader:
        return NoticeReader(self.options)


@dataclass
class Sent(WriterCommitMessage):
    staged: list
    documents: int


class DocumentWriter(DataSourceWriter):
    """Sends documents in two steps, so that tasks that are run again and jobs that fail leave nothing half done.

    A task PUTs its documents under staging/<job>/<task>-<attempt>/...; the driver's commit names to the service the attempts that
    count (POST commit/<job> with their list), and the service makes those documents current at once. An attempt that is
    not named is never seen; abort (DELETE staging/<job>) drops all of a job.
    """

    def __init__(self, options: dict, columns: list[str]):
        import uuid

        if "url" not in options:
            raise ValueError("the documents' sink needs an option url")
        missing = {"path", "document"} - set(columns)
        if missing:
            raise ValueError(f"the documents' sink needs columns path and document; missing: {', '.join(sorted(missing))}")
        self.url, self.job = options["url"].rstrip("/"), uuid.uuid4().hex

    def write(self, rows: Iterator) -> Sent:
        import urllib.parse

        from pyspark import TaskContext

        context = TaskContext.get()
        name, n = f"{context.partitionId()}-{context.taskAttemptId()}", 0
        for row in rows:
            where = urllib.parse.quote((row["path"] or "").lstrip("/"))
            fetch(f"{self.url}/staging/{self.job}/{name}/{where}", body=(row["document"] or "").encode(), method="PUT")
            n += 1
        return Sent([name] if n else [], n)

    def commit(self, messages: list) -> None:
        attempts = sorted(a for m in messages if m is not None for a in m.staged)
        fetch(f"{self.url}/commit/{self.job}", body=json.dumps({"attempts": attempts, "documents": sum(m.documents for m in messages if m is not None)}).encode(), method="POST")

    def abort(self, messages: list) -> None:
        fetch(f"{self.url}/staging/{self.job}", method="DELETE")


class DocumentSink(DataSource):
    """Format `documents`: rows (path, document, ..) become documents of a service, all of a job or none. Option: url. A null path is the
    service's root, a null document is empty; of rows with the same path in one job, which one stays is not defined."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options, schema.names)


def register(spark) -> None:
    """Makes both formats known to a session, and lets conditions be sent to the service."""
    spark.dataSource.register(NoticeSource)
    spark.dataSource.register(DocumentSink)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
