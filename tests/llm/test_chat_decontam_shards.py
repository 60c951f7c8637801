import hashlib

import pytest
from oracle import SF, same_rows
from pyspark.sql import functions as F

from pagemart.llm import chat, decontam, queries, shards
from pagemart.llm.shared import fresh_path


@pytest.mark.parametrize("name", ["op1_sharding", "op9_decontamination", "op10_chat"])
def test_same_rows_as_sql(spark, name):
    same_rows(queries.queries()[name](spark, SF), queries.oracle_sql()[name])


# Chat


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


HARD = [(1, 0, "system", "be brief <|im_end|>"), (1, 1, "user", "a\\n<||>"), (1, 2, "assistant", "<|im_start|>x<"), (1, 3, "us\ner\\n\\", None), (1, 4, "assistant", ""), (1, 5, "assistant", "|>é<|" * 30), (None, None, None, "<|"), (None, 1, "assistant", "y"), (2, 1, "assistant", "same"), (2, 1, "assistant", "same")]


@pytest.mark.parametrize("budget", [20, 90, 2048])
def test_everything_comes_back(spark, budget):
    out = chat.windows(conversations(spark, HARD), budget=budget, history_tokens=30)
    turns, loss = {}, {}
    for r in chat.read_back(out).orderBy("conv_id", "window").collect():
        turns.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
        loss.setdefault(r.conv_id, []).extend(r.loss_text)
    for conv in (1, None, 2):
        given = [(r or "", t or "") for c, _, r, t in HARD if c == conv]
        assert turns[conv] == given
        assert loss[conv] == [t for r, t in given if r == "assistant"]
    digest = {r.conv_id: r for r in chat.digests(out).collect()}
    assert digest[1].n_turns == 6 and digest[1].turns_sha256 == hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for c, _, r, t in HARD if c == 1).encode()).hexdigest()


def test_windows(spark):
    rows = [(1, 0, "system", "s" * 40)] + [(1, i, ("assistant", "user")[i % 2], f"turn {i} " + "w" * 200) for i in range(1, 700)]
    out = chat.windows(conversations(spark, rows), budget=600, history=2, history_tokens=150).orderBy("window").collect()
    assert len(out) > 50 and all(r.n_tokens <= 600 for r in out)
    assert all(r.text.startswith("<|im_start|>system\n" + "s" * 40) for r in out)
    assert out[0].n_context == 0 and {r.n_context for r in out[1:]} == {3}
    assert sum(len(r.loss) for r in out) == 349
    assert chat.digests(chat.windows(conversations(spark, []))).count() == 0


def test_a_long_turn_stands_alone(spark):
    """Other turns are packed as if it were not there."""
    rows = [(1, i, ("assistant", "user")[i % 2], "w" * (9000 if i in (60, 61, 200) else 200)) for i in range(300)]
    with_clash = conversations(spark, rows).withColumns({n: F.lit(1) for n in ("cid", "block", "n", "t", "tokens", "window", "idx", "before")})
    out = chat.windows(with_clash, budget=600, history=2, history_tokens=150).orderBy("window").collect()
    own = [[t.text for t in r.turns] for r in chat.read_back(chat.windows(with_clash, budget=600, history=2, history_tokens=150)).orderBy("window").collect()]
    assert [t for w in own for t in w] == [t for _, _, _, t in rows]
    large = [w for w in own if any(len(t) == 9000 for t in w)]
    assert [len(w) for w in large] == [1, 1, 1] and len(own) < 300 / 4
    assert all(r.n_tokens <= 600 for r, w in zip(out, own, strict=True) if w not in large)


# Decontamination


def test_found_items(spark):
    words = [f"w{i}" for i in range(40)]
    item, long = " ".join(words), [f"z{i}" for i in range(3000)]
    cut = " ".join(long[:500] + words[:36] + long[500:])  # 32 of 36 shingles
    less = " ".join(long[:500] + words[:30] + long[500:])  # 26 of 36
    docs = [(1, " ".join(long) + " " + item.upper()), (2, cut), (3, less), (None, item), (5, None), (6, ""), (1, item), (7, "so: two, words!"), (8, "two words apart from two. words")]
    items = [(10, item), (11, "Two words"), (12, ""), (13, None), (None, "so two words")]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1)), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in got.collect()}
    assert found == {(1, 10): (36, 36), (2, 10): (36, 32), (None, 10): (36, 36), (7, 11): (1, 1), (8, 11): (1, 1), (7, None): (1, 1)}
    left = decontam.clean(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in left.collect()) == [3, 5, 6]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), empty).count() == 0


@pytest.mark.parametrize("item_id", [None, 7])
def test_items_of_one_id_are_apart(spark, item_id):
    passages = [" ".join(f"{c}{i}" for i in range(40)) for c in "ab"]
    items = [(item_id, t) for t in (*passages, passages[0].upper(), "few words", passages[1] + " and more")]
    docs = [(1, f"x {passages[0]} y"), (2, f"x {passages[1]} y"), (3, "just a few words here"), (4, "w " * 50), (5, f"{passages[1]} {passages[0]}"), (5, passages[0])]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.n_shingles, r.n_shared, r.containment) for r in decontam.contaminated(docs, items).collect())
    assert found == [(1, item_id, 36, 36, 1.0), (2, item_id, 36, 36, 1.0), (3, item_id, 1, 1, 1.0), (5, item_id, 36, 36, 1.0)]
    clashing = docs.withColumns({name: F.lit("x") for name in ("gone", "Found", "id", "key", "item_id", "digest", "a.b", "_found")})
    left = decontam.clean(clashing, items)
    assert [r.doc_id for r in left.collect()] == [4] and left.columns == clashing.columns
    assert decontam.clean(docs.limit(0), items).count() == 0


def test_signatures_by_partition(spark):
    """Any choice of enough shingles holds one of the signature, at every size."""
    sizes = [*range(1, 60), 99, 100, 101, 1000]
    shingles = spark.createDataFrame([(n, b"", 5, i, n) for n in sizes for i in range(n)], "item_id long, digest binary, width int, hash long, n long")
    found = {}
    for r in decontam.signatures(shingles, 0.8).collect():
        found.setdefault(r.item_id, []).append(r.hash)
    assert sorted(found) == sizes
    for n, hashes in found.items():
        assert sorted(hashes) == list(range(len(hashes))) and len(hashes) > n - -(-n * 4 // 5)
        assert len(hashes) <= n // 4 + 2


def test_shuffled_join_finds_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    first = sorted(map(tuple, decontam.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert first == sorted(map(tuple, decontam.contaminated(docs, items).collect()))


# Shards


def test_tiers_and_versions(spark):
    table = shards.ShardedTable(spark, fresh_path(spark, "t"), target=60_000, few=3)
    assert table.read() is None and table.compact() == 0
    rows = spark.range(0, 4000).withColumn("s", F.sha2(F.col("id").cast("string"), 256))
    for i in range(8):
        table.append(rows.where(F.col("id") % 8 == i).repartition(2))
    before = table.shards()[1]
    assert len(before) == 16 and table.shards()[0] == 8
    last = table.compact()
    after = table.shards()[1]
    assert len(after) < 8 and last > 8 and not table.due(after)
    assert any(2 * s.bytes > table.target for s in after)
    assert sorted(r.id for r in table.read().collect()) == list(range(4000))
    assert table.versions() == list(range(1, last + 1))
    assert table.expire(keep=1, min_age=3600) == [] and table.expire(keep=1, min_age=0) == list(range(1, last))
    assert table.versions() == [last] and sorted(r.id for r in table.read().collect()) == list(range(4000))
    with pytest.raises(LookupError):
        table.read(last - 1)


def test_versions_outlive_a_compaction(spark):
    table = shards.ShardedTable(spark, fresh_path(spark, "t"), target=60_000, few=3)
    for i in range(4):
        table.append(spark.range(i * 10, i * 10 + 10).coalesce(1))
    lazy = table.read(4)
    last = table.compact()
    assert last > 4 and table.versions() == list(range(1, last + 1))
    for version in table.versions():
        assert table.read(version).count() == min(version, 4) * 10
    assert sorted(r.id for r in lazy.collect()) == list(range(40))
    assert table.expire(keep=2, min_age=0) == list(range(1, last - 1)) and table.versions() == [last - 1, last]


def test_stale_writer_is_refused(spark):
    path = fresh_path(spark, "t")
    a, b = (shards.ShardedTable(spark, path, target=60_000, few=3) for _ in range(2))
    for i in range(4):
        a.append(spark.range(i * 10, i * 10 + 10).coalesce(1))
    version, there, schema = a.manifest()
    new = a._write(spark.range(100, 110).coalesce(1))
    b.append(spark.range(40, 50).coalesce(1))
    last = b.compact()
    b.expire(keep=1, min_age=0)
    assert last > version + 1 and b.versions() == [last]
    # The name that A wants is taken by a tombstone, and so are all older ones.
    assert not a.commit(version, there + new, schema) and not any(a.commit(v, [], schema) for v in range(last))
    # A store that let A rename all the same: A finds the later version and takes itself back.
    files, at = a._hadoop(a._manifest(version + 1))
    files.delete(at, False)
    listed, calls = a._names, []
    a._names = lambda: listed() if calls.append(1) or len(calls) > 1 else {version: (1000, 0)}
    assert not a.commit(version, there + new, schema)
    assert b.versions() == [last] and sorted(r.id for r in b.read().collect()) == list(range(50))
    del a._names
    # append() tries again on what is there now.
    seen = a.manifest
    stale = [(version, there, schema)]
    a.manifest = lambda v=None: stale.pop() if stale and len(calls) else seen(v)
    stale.append((version, there, schema))
    assert a.append(spark.range(100, 110).coalesce(1)) == last + 1
    assert sorted(r.id for r in b.read().collect()) == [*range(50), *range(100, 110)]
    assert b.sweep(min_age=3600) == 0 and b.sweep(min_age=0) == 1  # what A wrote by hand
    assert b.read().count() == 60


def test_arrivals_that_do_not_go_together(spark):
    table = shards.ShardedTable(spark, fresh_path(spark, "t"))
    table.append(spark.range(3).toDF("a"))
    for schema in ("A long", "a string"):
        with pytest.raises(ValueError):
            table.append(spark.createDataFrame([], schema))
    assert table.versions() == [1] and table.read().count() == 3


def test_commits_do_not_overwrite(spark):
    table = shards.ShardedTable(spark, fresh_path(spark, "t"))
    table.append(spark.range(3).toDF("a"))
    version, there, schema = table.manifest()
    assert table.commit(version, there, schema) and not table.commit(version, [], schema)
    assert table.read().count() == 3
    table.append(spark.createDataFrame([(None, "x"), (None, "x")], "a long, b string"))
    assert sorted(map(tuple, table.read().collect()), key=repr) == sorted([(0, None), (1, None), (2, None), (None, "x"), (None, "x")], key=repr)
    with pytest.raises(ValueError):
        table.append(spark.createDataFrame([("x",)], "a string"))
    assert table.read(1).count() == 3


@pytest.mark.parametrize("atomic", [True, False])
def test_successor_between_rename_and_check(spark, atomic):
    """Another writer builds on A's version before A has looked whether its commit holds; rows are there once."""
    path = fresh_path(spark, "t")
    a, b = (shards.ShardedTable(spark, path, target=60_000, few=3) for _ in range(2))
    a.append(spark.range(1).coalesce(1))
    put, followed = a._put, []

    def then_others(name, text, overwrite):
        put(name, text, overwrite if atomic else True)
        if not followed:
            followed.append(b.append(spark.range(2, 3).coalesce(1)))
            b.append(spark.range(3, 4).coalesce(1))
            if not atomic:
                b.expire(keep=1, min_age=0)  # A finds its own version as a tombstone

    a._put = then_others
    assert a.append(spark.range(1, 2).coalesce(1)) == 2 and followed == [3]
    assert sorted(r.id for r in b.read().collect()) == [0, 1, 2, 3]


def test_another_rename_came_over(spark):
    """A store that overwrites: who is renamed over reads again and adds its rows to what is there."""
    path = fresh_path(spark, "t")
    a, b = (shards.ShardedTable(spark, path) for _ in range(2))
    a.append(spark.range(1).coalesce(1))
    version, there, schema = b.manifest()
    put, over = a._put, []

    def overwritten(name, text, overwrite):
        put(name, text, overwrite)
        if not over:
            names, b._names = b._names, lambda: {version: (1000, 0)}
            keep, b._put = b._put, lambda n, t, o: keep(n, t, True)
            over.append(b.commit(version, there + b._write(spark.range(5, 6).coalesce(1)), schema))
            b._names, b._put = names, keep

    a._put = overwritten
    assert a.append(spark.range(1, 2).coalesce(1)) == 3 and over == [True]
    assert sorted(r.id for r in b.read().collect()) == [0, 1, 5]


def test_query_compacts(spark, monkeypatch):
    """The registered query's rows pass through merges: eight arrivals, two compactions at least."""
    made = []

    class Watched(shards.ShardedTable):
        def __init__(self, *args, **kwargs):
            super().__init__(*args, **kwargs)
            self.appended = self.merged = 0
            made.append(self)

        def append(self, df):
            self.appended += 1
            return super().append(df)

        def _merge(self, run, schema):
            self.merged += 1
            assert len(run) >= self.few
            return super()._merge(run, schema)

    monkeypatch.setattr(shards, "ShardedTable", Watched)
    same_rows(queries.op1_sharding(spark, SF), queries.OP1)
    assert [(t.appended, t.merged) for t in made] == [(8, 2)] and len(made[0].shards()[1]) == 2
