import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagemart.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=3):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", None, "One", "Ä B c\x0bd e", "a b c a b c", "Straße É\tx y z"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode(), 3) % 2**64 == brute_print(text)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [brute_print(r.text) for r in rows]
    expected = {r.doc_id: (f"{p:016x}", rows[c].doc_id) for r, p, c in zip(rows, prints, brute_components(prints), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, SF).collect()} == expected


def spread_values(n, centres, flips, seed):
    r = random.Random(seed)
    middle = [r.getrandbits(64) for _ in range(centres)]
    out = set()
    for _ in range(n):
        v = r.choice(middle)
        for _ in range(r.randint(0, flips)):
            v ^= 1 << r.randrange(64)
        out.add(v)
    return sorted(out)


@pytest.mark.parametrize("long", [2, 5, 1024])
def test_components_of_dense_values(spark, monkeypatch, long):
    monkeypatch.setattr(simhash, "LONG", long)
    monkeypatch.setattr(simhash, "PENDING", 10 * long)
    values = spread_values(400, 3, 6, long)
    # In this process too: lists of any length give what pairs would give.
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "id long, fingerprint long")
    got = {r.id: r.component_id for r in simhash._labelled(df, 3).collect()}
    assert got == dict(enumerate(brute_components(values)))


def test_every_near_pair_is_in_a_list_and_its_tally_is_right():
    masks = simhash._masks(3)
    assert len(masks) == 14 and all(m.bit_count() == 32 for m in masks) and len(set(simhash._narrowed(masks))) == 56
    r = random.Random(1)
    pairs = []
    for _ in range(400):
        a = b = r.getrandbits(64)
        for _ in range(r.randint(0, 12)):
            b ^= 1 << r.randrange(64)
        pairs.append((a, b))
    found = simhash.tally(*(np.array(x, np.uint64) for x in zip(*pairs, strict=True)))
    for (a, b), n in zip(pairs, found.tolist(), strict=True):
        assert n == sum(a >> 8 * i & 255 == b >> 8 * i & 255 for i in range(8))
        together = any(a & m == b & m for m in masks)
        assert together or n < 5
        assert ((a ^ b).bit_count() > 3) or n >= 5
        assert any(a & m == b & m for m in simhash._narrowed(masks)) == (n >= 5)


@pytest.mark.parametrize("huge", [3, 40])
def test_huge_lists_are_split(spark, monkeypatch, huge):
    monkeypatch.setattr(simhash, "HUGE", huge)
    values = spread_values(300, 2, 5, 7)
    df = spark.createDataFrame([(i, int(np.uint64(v).view(np.int64))) for i, v in enumerate(values)], "id long, fingerprint long")
    assert {r.id: r.component_id for r in simhash._labelled(df, 3).collect()} == dict(enumerate(brute_components(values)))


def test_hot_fingerprints(spark, monkeypatch):
    monkeypatch.setattr("pagemart.llm.shared.HOT", 4)
    values = [0] * 50 + [1] * 30 + [2**40 - 1] * 20 + list(range(2**50, 2**50 + 20 * 2**5, 2**5))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, fingerprint long")
    assert {r.id: r.component_id for r in simhash._labelled(df, 3).collect()} == dict(enumerate(brute_components(values)))


def test_long_lists_by_flips():
    r = random.Random(9)
    low = sorted({r.getrandbits(12) for _ in range(1500)})
    values = np.array(low, np.uint64)
    lists = np.zeros(len(values), np.int64)
    masks = [(1 << 64) - 1 - (1 << 24) + 1]
    a, b = simhash.links_of_lists(lists, values, masks, 3)
    parent = {v: v for v in low}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        parent[find(x)] = find(y)
    expected = brute_components(low)
    groups = {}
    for v, c in zip(low, expected, strict=True):
        groups.setdefault(c, set()).add(find(v))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({find(v) for v in low})


def test_one_of_each(spark):
    text = "one two three four five six seven"
    rows = [(3, text), (1, text), (1, text), (2, "entirely different words stand here today"), (2, "and more different words than before now"), (None, "alone in the dark of night"), (None, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({name: F.lit("clashes") for name in ("fingerprint", "root", "id", "gone", "kept_id", "Kept_Root", "own_print", "component_id", "a.b", "_id", "_root")})
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, text), rows[3], rows[4], rows[5], (9, "")], key=repr)
    plain = spark.createDataFrame([(3, text), (1, text), (2, rows[3][1])], "doc_id long, text string")
    plain = plain.withColumns({name: F.lit("clashes") for name in ("fingerprint", "root", "id", "gone", "component_id", "a.b")})
    assert sorted(r.doc_id for r in simhash.one_of_each(plain).collect()) == [1, 2] and simhash.one_of_each(plain).columns == plain.columns
    one_null = spark.createDataFrame([(None, text), (1, text), (2, rows[3][1])], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(one_null).collect()) == [1, 2]
    assert simhash.one_of_each(plain.limit(0)).count() == 0
