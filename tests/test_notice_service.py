"""The notices' source and the documents' sink against a server of the test's own."""

import json
import re
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from lexstrata.sources import notice_service as S

NOTICES = [
    {"document_number": f"2012-{i:04}", "publication_date": f"2012-{1 + i % 12:02}-03", "effective_on": f"2013-{1 + i % 12:02}-01" if i % 3 else None, "type": ("Rule", "Proposed Rule", "Notice")[i % 3],
     "cfr_references": [{"title": 12, "part": 1000 + i % 2}], "volume": 77, "start_page": i, "end_page": i + 1, "agency_names": ["An agency"], "abstract": None}
    for i in range(57)
]


class Service(ThreadingHTTPServer):
    def __init__(self):
        super().__init__(("127.0.0.1", 0), Handler)
        self.asked, self.staged, self.current, self.fail, self.lock, self.dropped, self.knows = [], {}, {}, {}, threading.Lock(), [], True


class Handler(BaseHTTPRequestHandler):
    def log_message(self, *_):
        pass

    def _answer(self, what=b"{}", code=200):
        self.send_response(code)
        self.end_headers()
        self.wfile.write(what)

    def _failing(self):
        with self.server.lock:
            for part, left in self.server.fail.items():
                if part in self.path and left:
                    self.server.fail[part] -= 1
                    self._answer(code=503)
                    return True
        return False

    def do_GET(self):
        if self._failing():
            return
        q = urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query)
        with self.server.lock:
            self.server.asked.append(q)
        one = lambda k: q.get(k, [None])[0]
        rows = [n for n in NOTICES if n["cfr_references"][0]["part"] == int(one("conditions[cfr][part]") or n["cfr_references"][0]["part"])]
        if self.server.knows:
            word = {"RULE": "Rule", "PRORULE": "Proposed Rule", "NOTICE": "Notice", None: None}[one("conditions[type][]")]
            rows = [n for n in rows if word in (None, n["type"])]
            for column, name in (("publication_date", "publication_date"), ("effective_on", "effective_date")):
                low, high = one(f"conditions[{name}][gte]"), one(f"conditions[{name}][lte]")
                rows = [n for n in rows if (low is None or (n[column] or "") >= low) and (high is None or (n[column] and n[column] <= high))]
        rows.sort(key=lambda n: (n["publication_date"], n["document_number"]))
        size, page = int(one("per_page")), int(one("page"))
        self._answer(json.dumps({"count": len(rows), "results": rows[(page - 1) * size : page * size]}).encode())

    def _body(self):
        return self.rfile.read(int(self.headers.get("Content-Length") or 0))

    def do_PUT(self):
        body = self._body()
        if self._failing():
            return
        job, attempt, path = re.match(r"/staging/(\w+)/([^/]+)/(.*)", self.path).groups()
        with self.server.lock:
            self.server.staged.setdefault(job, {}).setdefault(attempt, {})[urllib.parse.unquote(path)] = body.decode()
        self._answer()

    def do_POST(self):
        body = json.loads(self._body())
        if self._failing():
            return
        staged = self.server.staged.pop(self.path.rsplit("/", 1)[1], {})
        for attempt in body["attempts"]:
            self.server.current |= staged[attempt]
        self._answer()

    def do_DELETE(self):
        job = self.path.rsplit("/", 1)[1]
        self.server.dropped.append(job)
        self.server.staged.pop(job, None)
        self._answer()


@pytest.fixture
def service(spark):
    s = Service()
    threading.Thread(target=s.serve_forever, daemon=True).start()
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    S.register(spark)
    yield s
    spark.conf.set("spark.sql.python.filterPushdown.enabled", before)
    s.shutdown()


def url(s):
    return f"http://127.0.0.1:{s.server_port}"


def numbers(df):
    return sorted(r["document_number"] for r in df.select("document_number").collect())


def test_all_pages_are_read_each_by_a_task(spark, service):
    df = spark.read.format("notices").option("url", url(service)).option("pagesize", 10).load()
    assert df.rdd.getNumPartitions() == 6
    assert numbers(df) == sorted(n["document_number"] for n in NOTICES)
    first = df.where("document_number = '2012-0000'").first()
    assert str(first["publication_date"]) == "2012-01-03" and first["effective_on"] is None and first["cfr_references"][0]["part"] == 1000 and first["agency_names"] == ["An agency"]
    some = spark.read.format("notices").option("url", url(service)).option("part", 1001).option("title", 12).option("pagesize", 100).load()
    assert numbers(some) == sorted(n["document_number"] for n in NOTICES if n["cfr_references"][0]["part"] == 1001)
    assert spark.read.format("notices").option("url", url(service)).option("part", 7).load().count() == 0


@pytest.mark.parametrize("knows", [True, False])
def test_conditions_are_sent_and_checked_again(spark, service, knows):
    service.knows = knows
    df = spark.read.format("notices").option("url", url(service)).option("pagesize", 10).load()
    got = numbers(df.where("type = 'Rule' and publication_date >= date'2012-04-01' and volume = 77"))
    assert got == sorted(n["document_number"] for n in NOTICES if n["type"] == "Rule" and n["publication_date"] >= "2012-04-01") and got
    last = service.asked[-1]
    assert last["conditions[type][]"] == ["RULE"] and last["conditions[publication_date][gte]"] == ["2012-04-01"] and "conditions[volume]" not in last
    got = numbers(df.where("effective_on <= date'2013-05-01'"))
    assert got == sorted(n["document_number"] for n in NOTICES if n["effective_on"] and n["effective_on"] <= "2013-05-01")
    assert numbers(df.where("type = 'Other'")) == []


def test_a_failing_server_is_asked_again(spark, service):
    service.fail["page=2"] = 2
    df = spark.read.format("notices").option("url", url(service)).option("pagesize", 20).load()
    assert df.count() == 57 and service.fail["page=2"] == 0
    with pytest.raises(Exception, match="url"):
        spark.read.format("notices").load().count()


def test_documents_become_current_at_once(spark, service):
    docs = spark.createDataFrame([(f"regulation/105/v {i}", f'{{"n": {i}}}') for i in range(40)] + [("empty", None)], "path string, document string").repartition(5)
    service.fail["staging"] = 2
    docs.write.format("documents").option("url", url(service)).mode("append").save()
    assert service.current == {f"regulation/105/v {i}": f'{{"n": {i}}}' for i in range(40)} | {"empty": ""}
    assert service.staged == {} and service.dropped == []
    docs.limit(0).write.format("documents").option("url", url(service)).mode("append").save()
    with pytest.raises(Exception, match="missing: document"):
        spark.createDataFrame([("a", 1)], "path string, other int").write.format("documents").option("url", url(service)).mode("append").save()


def test_a_failed_job_leaves_nothing(spark, service):
    docs = spark.createDataFrame([(f"p{i}", "x") for i in range(20)] + [("bad", "x")], "path string, document string").repartition(3)
    service.fail["/bad"] = 1000
    with pytest.raises(Exception):
        docs.write.format("documents").option("url", url(service)).mode("append").save()
    assert service.current == {} and service.staged == {} and len(service.dropped) == 1
