import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemart.sources import files
from pagemart.streaming import pages as stream


def test_sessions_and_lists(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"B": {"label": "two", "year": "2021-01-01"}, "A": {"label": "one", "year": "2020-01-01"}}))
    found = files.sessions(spark, str(tmp_path / "s.json"))
    assert [r.session_code for r in found.collect()] == ["A", "B"]
    assert files.seed_urls(found, "https://h.org/", "s").first().url == "https://h.org/?s=A"
    assert files.known_urls(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "k.txt").write_text(" a \n\nb\n")
    assert [r.url for r in files.known_urls(spark, str(tmp_path / "k.txt")).collect()] == ["a", "b"]
    (tmp_path / "l.json").write_text('["x", "y"]')
    (tmp_path / "bad.json").write_text('["x", ')
    assert files.json_list(spark, str(tmp_path / "bad.json")).count() == 0
    for value in ("5", "true", '"x"', '{"a": 1}'):
        (tmp_path / "o.json").write_text(value)
        with pytest.raises(Exception, match="not a JSON array"):
            files.json_list(spark, str(tmp_path / "o.json")).collect()
    files.append_items(spark.createDataFrame([("a",), ('b "q"',)], "item string").coalesce(1), str(tmp_path / "list"))
    files.append_items(spark.createDataFrame([("a",)], "item string"), str(tmp_path / "list"))
    assert sorted(r.item for r in files.json_list(spark, str(tmp_path / "list")).collect()) == ["a", "a", 'b "q"']
    (tmp_path / "o.json").write_text('{"a": 1}')
    assert [r.item for r in files.json_list(spark, str(tmp_path / "l.json")).collect()] == ["x", "y"]
    assert files.json_list(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(Exception, match="not a JSON array"):
        files.json_list(spark, str(tmp_path / "o.json")).collect()


def test_graph_snapshot(spark, tmp_path):
    nodes = spark.createDataFrame([("a", 1), ("b", 2)], "key string, ord long")
    edges = spark.createDataFrame([("a", "b"), ("b", "gone")], "src_key string, dst_key string")
    assert all(df.count() == 0 for df in files.read_graph(spark, str(tmp_path / "none"), nodes.schema))
    folder = files.write_graph(nodes, edges, str(tmp_path))
    assert files.current(spark, str(tmp_path)) == folder
    got, links, roots = files.read_graph(spark, str(tmp_path), nodes.schema)
    assert [r.key for r in roots.collect()] == ["a"] and files.read_graph(spark, folder, nodes.schema)[0].count() == 2
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("b", 2)]
    assert [tuple(r) for r in links.collect()] == [("a", "b")]
    assert files.next_id(got).first().next_id == 3


def test_stream_equals_batch(spark, tmp_path):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())])
    for i, urls in enumerate([["u?a=1&amp;b", "v"], ["u?a=1&b", "w"]]):
        spark.createDataFrame([(10 * i + j, u) for j, u in enumerate(urls)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = []

    def merge(batch, number):
        out.extend(r.url_key for r in batch.collect())

    for _ in range(2):  # the second run finds nothing new
        stream.run(stream.first_of_url(stream.page_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1)), merge, str(tmp_path / "cp")).awaitTermination()
    assert sorted(out) == ["u?a=1&b", "v", "w"]


def test_quarantine_goes_aside(spark):
    good, bad = [], []
    merge = stream.with_quarantine(lambda df, n: good.extend(df.collect()), lambda df, n: bad.extend(df.collect()))
    merge(spark.createDataFrame([(1, []), (2, ["x"])], "k int, errors array<string>"), 0)
    assert [r.k for r in good] == [1] and [r.k for r in bad] == [2]


def test_waiting_rows_are_released(spark, tmp_path):
    schema = "dep string, payload string, loaded boolean"
    for i, rows in enumerate([[("a", "r1", False), ("b", "r2", False)], [("a", None, True)], [("a", "r3", False)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    out = []
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = stream.release_waiting(events, "dep", "payload", "loaded").writeStream.outputMode("append").foreachBatch(lambda df, n: out.extend(tuple(r) for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(out) == [("a", "r1", False), ("a", "r3", False)]


def _waiting(spark, folder, expires_ms=None):
    """(what was released in each batch, the state rows after it) of three batches."""
    schema = "dep string, payload string, loaded boolean"
    arrivals = [[("a", "r1", False), ("b", "r2", False), ("a", "r1", None)], [("a", None, True), ("b", "r4", False)], [("a", "r3", False), ("b", None, True), ("a", None, True)]]
    for i, rows in enumerate(arrivals):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/{i}")
    out = {}
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    released = stream.release_waiting(events, "dep", "payload", "loaded", expires_ms)
    query = released.writeStream.outputMode("append").foreachBatch(lambda df, n: out.__setitem__(n, sorted(tuple(r) for r in df.collect()))).option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    return out


def test_waiting_state_ends(spark, tmp_path):
    """Each row is released once, and what was released has no row in the list state any more."""
    out = _waiting(spark, str(tmp_path))
    assert [out[n] for n in range(3)] == [[], [("a", "r1", False), ("a", "r1", False)], [("a", "r3", False), ("b", "r2", False), ("b", "r4", False)]]
    left = lambda name: spark.read.format("statestore").option("path", f"{tmp_path}/cp").option("stateVarName", name).load()
    assert left("waiting").count() == 0 and left("there").count() == 2


def test_waiting_rows_expire(spark, tmp_path):
    """Rows that have waited too long are given out as expired, by timers."""
    import time

    schema = "dep string, payload string, loaded boolean"
    spark.createDataFrame([("a", "r1", False), ("b", "r2", False)], schema).coalesce(1).write.parquet(f"{tmp_path}/in/0")
    out = []
    events = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    query = stream.release_waiting(events, "dep", "payload", "loaded", 500).writeStream.outputMode("append").foreachBatch(lambda df, n: out.extend(tuple(r) for r in df.collect())).option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="200 milliseconds").start()
    until = time.time() + 60
    while len(out) < 2 and time.time() < until:
        time.sleep(0.2)
    query.stop()
    assert sorted(out) == [("a", "r1", True), ("b", "r2", True)]
