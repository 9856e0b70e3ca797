"""Row-wise Python functions give back their rows in batches of bounded size."""

import pyarrow as pa

from lexstrata.functions import arrow


def test_batches_are_bounded_and_given_back_as_they_are_made(spark, monkeypatch):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: run)
    seen = []

    def words(text):
        for i in range(50_000):
            seen.append(i)
            yield i, text

    run = arrow.flat_map(df, ["id"], ["text"], words, "n int, word string")
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2], pa.int32()), "text": ["a", "b"]})
    got = run(iter([batch, batch.slice(0, 0), batch.slice(1)]))
    first = next(got)
    assert first.num_rows == arrow.ROWS == len(seen)
    sizes = [first.num_rows, *[b.num_rows for b in got]]
    assert sum(sizes) == 150_000 and max(sizes) <= arrow.ROWS
