import pytest
from pyspark.sql import functions as F

from pagemart.streaming import pages as stream
from pagemart.streaming import seen


def _keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "url_key string")


def test_batches_are_compared_with_all_before(spark, tmp_path):
    known, have = seen.Seen(spark, str(tmp_path)), set()
    for number in range(20):
        batch = [f"u{(number * 37 + i * i) % 150}" for i in range(30)] + [None, ""]
        got = [r.key for r in known.add(_keys(spark, batch), "s", number).collect()]
        assert sorted(got, key=str) == sorted(set(batch) - have, key=str)
        again = [r.key for r in known.add(_keys(spark, batch), "s", number).collect()]
        assert sorted(again, key=str) == sorted(got, key=str)
        have |= set(batch)
    assert sorted((r.key for r in known.keys().collect()), key=str) == sorted(have, key=str)
    _, now = known.manifest()
    assert len(now["parts"]) < 2 * seen.MERGED and sum(p["keys"] for p in now["parts"]) == len(have)
    assert known.sweep(min_age=0) > 0 and known.keys().count() == len(have)
    with pytest.raises(ValueError, match="older"):
        known.add(_keys(spark, ["x"]), "s", 3)
    assert [r.key for r in known.add(_keys(spark, ["u0", "x"]), "other", 0).collect()] == ["x"]


def test_filters_miss_nothing_and_pass_few(spark, tmp_path):
    known = seen.Seen(spark, str(tmp_path))
    url = lambda c: F.concat(F.lit("https://h.org/?id="), c)
    known.add(spark.range(40_000).select(url("id")), "s", 0)
    known.add(spark.range(40_000, 45_000).select(url("id")), "s", 1)
    _, now = known.manifest()
    assert len(now["parts"]) == 2
    assert known.maybe(spark.range(45_000).select(url("id").alias("key")), now["parts"]).count() == 45_000
    assert known.maybe(spark.range(50_000, 90_000).select(url("id").alias("key")), now["parts"]).count() < 400
    assert known.unknown(spark.range(44_990, 50_000).select(url("id").alias("key")), now["parts"]).count() == 5_000


def test_two_streams_at_once(spark, tmp_path, monkeypatch):
    """Another stream commits between a comparison and its commit: the batch is compared again."""
    known, write, done = seen.Seen(spark, str(tmp_path)), seen.Seen._write, []

    def slow(self, keys):
        if not done:
            done.append(1)
            known.add(_keys(spark, ["a", "b"]), "first", 0)
        return write(self, keys)

    monkeypatch.setattr(seen.Seen, "_write", slow)
    assert [r.key for r in known.add(_keys(spark, ["b", "c"]), "second", 0).collect()] == ["c"]
    assert sorted(r.key for r in known.keys().collect()) == ["a", "b", "c"]


def test_stream_without_state_that_is_lost(spark, tmp_path):
    """Lost before a batch's keys are noted, and after; each URL is given out once, and the stream keeps no state."""
    schema = "url string, ts int, url_key string, html string"
    batches = [[("u?a=1&amp;b", 2, "x", "p"), ("u?a=1&b", 1, "x", "q"), (None, 1, "x", "r")], [("v", 1, "x", "s"), ("u?a=1&b", 0, "x", "t")], [("w", 1, "x", "u"), ("w", 1, "x", "u"), (None, 0, "x", "v"), ("v", 0, "x", "w")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    out, lost = {}, []
    known = seen.Seen(spark, f"{tmp_path}/seen")

    def sink(rows, number):
        if number and (number, "sink") not in lost:
            lost.append((number, "sink"))
            raise RuntimeError("lost in the sink")
        out[number] = sorted((tuple(r) for r in rows.select("url_key", "html").collect()), key=str)
        if number == 2 and "after" not in lost:
            lost.append("after")
            raise RuntimeError("lost after the sink")

    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    ended = False
    for _ in range(4):
        query = stream.run(arriving, seen.first_seen(known, "pages", sink, order=F.col("ts")), f"{tmp_path}/cp")
        ended = stream.until_lost(query, "lost")
        assert all(not p["stateOperators"] for p in query.recentProgress)
    assert ended and len(lost) == 3
    assert out == {0: [("u?a=1&b", "q"), (None, "r")], 1: [("v", "s")], 2: [("w", "u")]}
