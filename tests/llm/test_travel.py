"""Queries on executors that have no copy of the package, the sample's bytes, and small sources in the mix's query."""

import os
import subprocess
import sys

import duckdb
import pytest

from lexstrata.llm import mixing as M
from lexstrata.llm import quality_classifier as Q
from lexstrata.llm import queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def there(frames):
    import importlib.util
    for f in frames:
        f["id"] = int(importlib.util.find_spec("lexstrata") is not None)
        yield f

assert spark.range(1).mapInPandas(there, "id long").first()[0] == 0, "workers have the package"
from lexstrata.llm.queries import queries
for name in sys.argv[3:]:
    assert queries()[name](spark, sys.argv[2]).count() > 0, name
print("all ran")
"""


@pytest.mark.parametrize("names", [["op1_toxicity", "op4_language_id"], ["op2_max_score", "op3_secret_scan", "op8_html_text", "op9_quality_classifier", "op10_quality_rules", "op11_whitening", "op12_fill_middle", "op13_bpe"]])
def test_workers_need_no_package(tmp_path, sf_dir, names):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, sf_dir, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in out.stdout, out.stderr[-3000:]


def test_sample_is_bounded_in_bytes_and_filled_up(make, labels, monkeypatch):
    monkeypatch.setattr(Q, "LONGEST", 1000)
    monkeypatch.setattr(Q, "SAMPLE_BYTES", 5000)
    texts = [(i, "x" * (2000 if i % 4 == 0 else 100), "en", "s") for i in range(200)]
    got = Q.labelled_sample(make(texts), labels([(i, i % 2, 0) for i in range(200)]), "quality", Q.F.lit(True), 40).collect()
    assert len(got) == 40 and all(len(r["text"]) == 100 for r in got)  # others take the place of long texts
    got = Q.labelled_sample(make(texts), labels([(i, i % 2, 0) for i in range(200)]), "quality", Q.F.lit(True), 90).collect()
    assert len(got) == 50  # 5000 bytes
    assert Q.labelled_sample(make([]), labels([(1, 1, 0)]), "quality", Q.F.lit(True), 5).count() == 0


def test_query_gives_small_sources_their_targets(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "SLOTS", 16)
    docs = make([(i, "w " * 50, "en", "hot") for i in range(300)] + [(1000 + i, "w " * 20, "en", f"t{i % 2}") for i in range(6)] + [(2000, "w w w", "en", None), (2001, None, "en", "t0"), (7, "w " * 50, "en", "hot")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(r) for r in queries.op5_source_mix(spark, str(tmp_path)).collect()]
    taken = {t: sum(r[4] for r in rows if r[0] is not None and r[0] >= 1000 and r[0] < 2000 and r[0] % 2 == t) for t in (0, 1)}
    assert taken == {0: 180, 1: 180}
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(rows) == sorted(con.sql(queries.oracle_sql()["op5_source_mix"]).fetchall())
