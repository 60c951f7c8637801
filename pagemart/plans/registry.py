"""Named things that are registered once: queries with their SQL, page types, loads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from pagemart.operators.lineage import plain_unions


class Registry(Mapping):
    """name -> entry. A name that is taken or unknown is an error."""

    def __init__(self, what: str):
        self.what, self._entries = what, {}

    def add(self, name: str, entry):
        if name in self._entries:
            raise ValueError(f"{self.what} {name} is registered already")
        self._entries[name] = entry
        return entry

    def register(self, name: str | None = None):
        """A decorator; the function's own name if none is given."""
        return lambda entry: self.add(name or entry.__name__, entry)

    def __getitem__(self, name: str):
        if name not in self._entries:
            raise KeyError(f"no {self.what} {name}")
        return self._entries[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._entries)

    def __len__(self) -> int:
        return len(self._entries)


QUERIES: Registry = Registry("query")
SQL: Registry = Registry("SQL of")


def query(sql: str | None = None):
    """Registers a query of (spark, folder of tables), with the SQL that gives the same rows; it runs with plain unions."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            plain_unions(spark)
            return f(spark, sf_dir)

        QUERIES.add(f.__name__, run)
        if sql:
            SQL.add(f.__name__, sql)
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
