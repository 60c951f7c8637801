"""Which URLs a stream has given out before, kept beside the stream instead of in its state.

Known keys lie in parts, files that are written once, each with a Bloom filter of its own:
a table of 64-bit words, with BITS bits for each key of the part. A batch's keys are
looked up in the filters, and what they let through, which is nearly all known,
in the parts: the answer is exact. The stream has no state, so what it keeps in memory is
the same after any number of pages, and a page seen again adds nothing anywhere.

MERGED parts of about one size become one with a new filter, so there are few parts and
a key is written again once for each size. A version is a small file that lists
the parts, renamed into place without overwriting, and notes each stream's last batch
and the version that the batch was compared with. A batch that is run again is compared with
that version again and gives the same rows; its keys are not added twice. Streams may
share a folder: who comes second compares with what the first has added.

Cases: a null url is a url like others, of which the first page is given out; of a
key's pages in one batch the first in order is, or of those at one place (all, without
an order) the one that comes first as JSON; a column url_key is replaced.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.functions.urls import url_key
from pagemart.operators import merge
from pagemart.sources.files import hadoop, put, read_text

#: Bits of a filter for each key; with four bits set in one word, about one unknown key in 500 passes a part's filter.
BITS = 32
#: Parts of one size that are merged.
MERGED = 8
#: Words of the smallest filter; others have four times as many as the next smaller.
WORDS = 256


def _words(keys: int) -> int:
    words = WORDS
    while words * 64 < keys * BITS:
        words *= 4
    return words


def _tier(keys: int) -> int:
    tier = 0
    while keys >= MERGED:
        keys, tier = keys // MERGED, tier + 1
    return tier


def _word(key: Column, words: Column) -> Column:
    return F.pmod(F.xxhash64(key), words)


def _mask(key: Column) -> Column:
    """Up to four bits of a word, from another hash than its place."""
    bits = F.xxhash64(F.lit("bits"), key)
    places = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places]
    return one[0].bitwiseOR(one[1]).bitwiseOR(one[2]).bitwiseOR(one[3])


class Seen:
    """Keys under a folder, of any number of streams."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, version: int) -> str:
        return f"{self.path}/versions/v{version:012d}.json"

    def _newest(self) -> int:
        fs, at = hadoop(self.spark, f"{self.path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return max((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> tuple[int, dict]:
        """(version, what it says); the newest if none is given, 0 if there is none."""
        version = self._newest() if version is None else version
        return version, json.loads(read_text(self.spark, self._file(version))) if version else {"parts": [], "batches": {}}

    def _read(self, kind: str, schema: str, parts: list[dict]) -> DataFrame:
        folders = [f"{self.path}/{kind}/{p['part']}" for p in parts]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def keys(self, parts: list[dict] | None = None) -> DataFrame:
        """(key) of some parts, or all."""
        return self._read("keys", "key string", self.manifest()[1]["parts"] if parts is None else parts)

    def maybe(self, keys: DataFrame, parts: list[dict]) -> DataFrame:
        """The keys that the parts' filters let through: all that are there, and a few others."""
        sizes = sorted({_words(p["keys"]) for p in parts})
        if not sizes:
            return keys.limit(0)
        filters = self._read("filters", "words long, word long, bits long", parts)
        places = keys.select("key", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])).alias("n")).select("key", "n", _word(F.col("key"), F.col("n")).alias("at"), _mask(F.col("key")).alias("mask"))
        found = places.join(filters, (F.col("n") == F.col("words")) & (F.col("at") == F.col("word")) & (F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")), "left_semi")
        return found.select("key").distinct() if len(sizes) > 1 else found.select("key")

    def unknown(self, keys: DataFrame, parts: list[dict]) -> DataFrame:
        """The keys (once each) that no part has."""
        known = self.keys(parts).select(F.col("key").alias("known"))
        seen = self.maybe(keys, parts).join(known, F.col("key").eqNullSafe(F.col("known")), "left_semi").select(F.col("key").alias("seen"))
        return keys.join(seen, F.col("key").eqNullSafe(F.col("seen")), "left_anti")

    def _write(self, keys: DataFrame) -> dict:
        """A part of keys that are not repeated, and its filter."""
        name = uuid.uuid4().hex
        keys.select("key").write.parquet(f"{self.path}/keys/{name}")
        part = {"part": name}
        part["keys"] = self.keys([part]).count()
        words = F.lit(_words(part["keys"])).cast("long")
        filled = self.keys([part]).groupBy(words.alias("words"), _word(F.col("key"), words).alias("word")).agg(F.bit_or(_mask(F.col("key"))).alias("bits"))
        if part["keys"]:
            filled.write.parquet(f"{self.path}/filters/{name}")
        return part

    def _merged(self, parts: list[dict]) -> list[dict]:
        """The parts, of which those of a size that has MERGED or more are one."""
        while True:
            tiers: dict[int, list[dict]] = {}
            for p in parts:
                tiers.setdefault(_tier(p["keys"]), []).append(p)
            full = next((t for t in tiers.values() if len(t) >= MERGED), None)
            if full is None:
                return parts
            parts = [p for p in parts if p not in full] + [self._write(self.keys(full))]

    def add(self, keys: DataFrame, stream: str, number: int) -> DataFrame:
        """Adds a batch's keys; those (once each) that were not there before the batch, if it is run again too."""
        keys = keys.toDF("key").distinct()
        while True:
            base, now = self.manifest()
            last = now["batches"].get(stream)
            if last and last["number"] == number:
                return self.keys([last["part"]] if last["part"] else [])
            if last and last["number"] > number:
                raise ValueError(f"batch {number} of {stream} is older than its last, {last['number']}: another stream needs another name")
            part = self._write(self.unknown(keys, now["parts"]))
            parts = self._merged([*now["parts"], part] if part["keys"] else now["parts"])
            noted = {"number": number, "part": part if part["keys"] else None}
            if put(self.spark, self._file(base + 1), json.dumps({"parts": parts, "batches": now["batches"] | {stream: noted}})):
                return self.keys([noted["part"]] if noted["part"] else [])

    def sweep(self, min_age: float = 86_400) -> int:
        """Deletes parts that the newest version does not name and that are so many seconds old; how many files it took away."""
        _, now = self.manifest()
        named = {p["part"] for p in now["parts"]} | {b["part"]["part"] for b in now["batches"].values() if b["part"]}
        gone = 0
        for kind in ("keys", "filters"):
            fs, at = hadoop(self.spark, f"{self.path}/{kind}")
            for s in fs.listStatus(at) if fs.exists(at) else []:
                if s.getPath().getName() not in named and s.getModificationTime() / 1000 <= time.time() - min_age:
                    gone += fs.delete(s.getPath(), True)
        return gone


def first_seen(seen: Seen, stream: str, sink: Callable[[DataFrame, int], None], url_col: str = "url", order: Column | None = None) -> Callable[[DataFrame, int], None]:
    """A merge that gives a sink each batch's pages whose canonical URL no batch had before, one each, with url_key.

    Only keys are compared; pages that are known are not shuffled. A batch that is run again gives
    the sink the same rows with the same number, so a sink that replaces by number has each page once.
    """

    def merge_batch(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("url_key", url_key(F.col(url_col))).persist()
        try:
            fresh = seen.add(batch.select("url_key"), stream, number).select(F.col("key").alias("_fresh"))
            pages = batch.join(fresh, F.col("url_key").eqNullSafe(F.col("_fresh")), "left_semi")
            sink(merge.one_per_key(pages, ["url_key"], order, first=True), number)
        finally:
            batch.unpersist()

    return merge_batch
