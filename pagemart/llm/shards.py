"""Sharding by size-tiered compaction.

A table is a folder: data/ holds immutable shards, manifests/ one file per
version that lists the shards of that version. An append writes its rows as small
shards (one per task) and commits the next version. A compaction takes, in each
tier of similar sizes, the shards there once there are enough of them, merges
them into files of about the target size, and commits a version in which the new
shards stand for the merged ones. Shards that reach the target are left alone, so
a byte is rewritten about once per tier.

A commit writes the manifest under a temporary name and renames it to its
version's name without overwriting; who comes second fails, reads the new
version and tries again. A version's name is never free again: an expired
version's manifest is overwritten by a tombstone, so a writer that read it long
ago cannot commit behind the versions that came since. Manifests and tombstones
say who they are and on whom they build, so a commit knows after its rename
whether it holds: its own name must be there, and a version that has followed
meanwhile must build on it. (The store has to rename without overwriting as one
step, as HDFS does; where it does not, a commit that does not hold takes itself
back and is tried again.) What a failed job has written is in no manifest until
sweep() removes it. Merges read whole shards without a shuffle. Nothing but file
names and sizes is on the driver.

Versions stay readable, by lazy reads too, until expire() is called, which says
how many are kept and for how long a version stays after it was superseded.

Cases: no rows make no shards; null values, empty and very long texts, repeated
rows and any columns are kept; a version has the columns of all its arrivals, and
shards are read with nulls for those they lack; a column that comes back with
another type, or with another spelling of upper and lower case, is refused.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of a finished shard; growth from tier to tier; shards of a tier that start a merge.
TARGET, GROWTH, FEW = 128 << 20, 4, 4
#: A tombstone is no longer than this; a manifest is.
TOMBSTONE = 80


@dataclass(frozen=True)
class Shard:
    path: str
    bytes: int


class ShardedTable:
    def __init__(self, spark: SparkSession, path: str, target: int = TARGET, growth: int = GROWTH, few: int = FEW):
        self.spark, self.path, self.target, self.growth, self.few = spark, path.rstrip("/"), target, growth, few
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _hadoop(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf), at

    def _list(self, path: str) -> list[tuple[str, int]]:
        files, at = self._hadoop(path)
        return sorted((s.getPath().getName(), s.getLen()) for s in files.listStatus(at)) if files.exists(at) else []

    def _names(self) -> dict[int, tuple[int, int]]:
        """Every version that was ever committed -> (bytes, time of writing in ms); expired ones have a tombstone."""
        files, at = self._hadoop(f"{self.path}/manifests")
        found = files.listStatus(at) if files.exists(at) else []
        found = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found]
        return {int(name[1:-5]): (size, when) for name, size, when in found if name.startswith("v") and name.endswith(".json")}

    def versions(self) -> list[int]:
        """The versions that can be read."""
        return sorted(v for v, (size, _) in self._names().items() if size > TOMBSTONE)

    def shards(self, version: int | None = None) -> tuple[int, list[Shard]]:
        """(version, its shards); the newest version if none is given, 0 if there is none."""
        return self.manifest(version)[:2]

    def manifest(self, version: int | None = None) -> tuple[int, list[Shard], StructType]:
        """(version, its shards, its columns)."""
        while True:
            wanted = max(self.versions(), default=0) if version is None else version
            if not wanted:
                return 0, [], StructType()
            text = self._text(self._manifest(wanted))
            if len(text) > TOMBSTONE:
                found = json.loads(text)
                return wanted, [Shard(**s) for s in found["shards"]], StructType.fromJson(found["schema"])
            if version is not None:
                raise LookupError(f"version {version} of {self.path} has expired")
            # The newest version was superseded and expired since it was listed: list again.

    def _text(self, path: str) -> str:
        files, at = self._hadoop(path)
        stream = files.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifests/v{version:012d}.json"

    def _put(self, path: str, text: str, overwrite: bool) -> None:
        """Writes a file under another name and renames it; without overwrite, an existing one is an error."""
        files, at = self._hadoop(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        stream = files.create(at, False)
        stream.write(text.encode())
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1 if overwrite else 0)
        if overwrite:
            how[0] = rename.OVERWRITE
        try:
            context.rename(context.makeQualified(at), context.makeQualified(self._jvm.org.apache.hadoop.fs.Path(path)), how)
        except Exception:
            files.delete(at, False)
            raise

    def _origin(self, version: int) -> tuple[str, str] | None:
        """(own name, its parent's) of a version, expired or not; None if there is none."""
        files, at = self._hadoop(self._manifest(version))
        if not version or not files.exists(at):
            return None
        text = self._text(self._manifest(version))
        if len(text) > TOMBSTONE:
            found = json.loads(text)
            return found["id"], found["parent"]
        own, _, parent = text.partition(" ")
        return own, parent

    def commit(self, based_on: int, shards: list[Shard], schema: StructType) -> bool:
        """Makes shards the version after based_on; False if another writer was first."""
        version, name = based_on + 1, self._manifest(based_on + 1)
        if max(self._names(), default=0) >= version:
            return False
        parent, mine = (self._origin(based_on) or ("", ""))[0], uuid.uuid4().hex
        try:
            self._put(name, json.dumps({"version": version, "id": mine, "parent": parent, "shards": [asdict(s) for s in shards], "schema": schema.jsonValue()}), False)
        except Exception:
            if version in self._names():
                return False
            raise
        there, after = self._origin(version), self._origin(version + 1)
        if there is None or there[0] != mine:
            return False  # another's rename came over ours
        if after is not None and after[1] != mine:
            self._put(name, f"{after[1]} {parent}", True)  # ours came over a tombstone
            return False
        return True

    def _write(self, df: DataFrame) -> list[Shard]:
        """df's partitions as new shards that no manifest lists yet."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return [Shard(f"{folder}/{name}", size) for name, size in self._list(f"{self.path}/{folder}") if name.startswith("part-")]

    def append(self, df: DataFrame) -> int:
        """Adds an arrival; returns the version that has it."""
        self._columns(self.manifest()[2], df.schema)  # before anything is written
        new = self._write(df)
        while True:
            version, there, schema = self.manifest()
            if self.commit(version, there + new, self._columns(schema, df.schema)):
                return version + 1

    @staticmethod
    def _columns(schema: StructType, arriving: StructType) -> StructType:
        """The columns of both; a ValueError if they do not go together."""
        known = {f.name.lower(): f for f in schema}
        fresh = []
        for field in arriving:
            same = known.get(field.name.lower())
            if same is None:
                known[field.name.lower()] = field
                fresh.append(field)
            elif field.name != same.name or field in fresh:
                raise ValueError(f"{field.name} is written {same.name} here")
            elif field.dataType != same.dataType:
                raise ValueError(f"{field.name} is {same.dataType.simpleString()} here, not {field.dataType.simpleString()}")
        return StructType([*schema, *fresh])

    def tier(self, shard: Shard) -> int:
        """0 for a size of about the target, one more for each growth-th part of it."""
        if 2 * shard.bytes > self.target:
            return 0
        return max(1, round(math.log(self.target / max(shard.bytes, 1), self.growth)))

    def due(self, shards: list[Shard]) -> list[list[Shard]]:
        """The runs to merge: each tier's shards, if they are enough or make a finished shard."""
        tiers: dict[int, list[Shard]] = {}
        for shard in shards:
            if t := self.tier(shard):
                tiers.setdefault(t, []).append(shard)
        return [run for _, run in sorted(tiers.items()) if len(run) >= self.few or len(run) > 1 and sum(s.bytes for s in run) >= self.target]

    def compact(self) -> int:
        """Merges until no tier is due; returns the last version. Earlier versions stay until expire()."""
        while True:
            version, there, schema = self.manifest()
            runs = self.due(there)
            if not runs:
                return version
            merged = [new for run in runs for new in self._merge(run, schema)]
            gone = {s.path for run in runs for s in run}
            while not self.commit(version, [s for s in there if s.path not in gone] + merged, schema):
                version, there, schema = self.manifest()
                if not gone <= {s.path for s in there}:
                    break  # another compaction merged some of them; ours is dropped

    def _merge(self, run: list[Shard], schema: StructType) -> list[Shard]:
        n = max(1, round(sum(s.bytes for s in run) / self.target))
        return self._write(self._read(run, schema).coalesce(n))

    def _read(self, shards: list[Shard], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{s.path}" for s in shards])

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version; None if it has no shards."""
        _, there, schema = self.manifest(version)
        return self._read(there, schema) if there else None

    def expire(self, keep: int = 1, min_age: float = 3600.0) -> list[int]:
        """Gives up versions but the newest `keep` and those superseded less than min_age seconds ago; returns them.

        Their manifests become tombstones first, then the shards that only they
        list are removed. min_age is the time that a reader may take that began
        on a version when it was the newest.
        """
        names = self._names()
        versions = sorted(v for v, (size, _) in names.items() if size > TOMBSTONE)
        follows = dict(zip(sorted(names), sorted(names)[1:], strict=False))
        now = time.time() * 1000
        old = [v for v in versions[: -max(keep, 1)] if now - names[follows[v]][1] >= min_age * 1000]
        needed = {s.path for v in versions if v not in old for s in self.shards(v)[1]}
        listed = {s.path for v in old for s in self.shards(v)[1]}
        for v in old:
            self._put(self._manifest(v), " ".join(self._origin(v)), True)
        for path in listed - needed:
            files, at = self._hadoop(f"{self.path}/{path}")
            files.delete(at, False)
        return old

    def sweep(self, min_age: float = 86400.0) -> int:
        """Removes what no readable version lists and is older than min_age seconds: left by failed
        jobs and dropped compactions. Returns the number of files. min_age is the time that a writer
        may take from its first file to its commit.
        """
        before = time.time() * 1000 - min_age * 1000
        needed = {s.path for v in self.versions() for s in self.shards(v)[1]}
        files, at = self._hadoop(f"{self.path}/data")
        removed = 0
        for folder in files.listStatus(at) if files.exists(at) else []:
            for file in files.listStatus(folder.getPath()):
                name = f"data/{folder.getPath().getName()}/{file.getPath().getName()}"
                if file.getPath().getName().startswith("part-") and name not in needed and file.getModificationTime() <= before:
                    removed += bool(files.delete(file.getPath(), False))
        return removed


def arrivals(spark: SparkSession, path: str, most: int = 8) -> list[DataFrame]:
    """A stored table as `most` arrivals: its files in the order of their names, or ranges of rows of each where there are fewer."""
    whole = spark.read.parquet(path)
    files = sorted(whole.inputFiles())
    read = spark.read.schema(whole.schema).parquet
    if len(files) >= most:
        return [read(*files[len(files) * i // most : len(files) * (i + 1) // most]) for i in range(most)]
    parts = -(-most // max(len(files), 1))
    out = []
    for file in files:
        n = read(file).count()  # from the footer
        index = F.col("_metadata.row_index")
        out += [read(file).where((index >= n * i // parts) & (index < n * (i + 1) // parts)) for i in range(parts)]
    return out or [whole]
