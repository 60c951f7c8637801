"""op13 against a row-by-row tree in Python, and against its SQL."""

import hashlib
import zlib

from oracle import SF, same_rows
from pyspark.sql import functions as F

from pagemart.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sized(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(digests, fanout):
    """(root, path of (left, right) for each leaf)."""
    nodes, paths, of = list(digests), [[] for _ in digests], list(range(len(digests)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for leaf, at in enumerate(of):
            run, place = runs[at // fanout], at % fanout
            paths[leaf].append(("".join(run[:place]), "".join(run[place + 1 :])))
        nodes, of = [sha("".join(run)) for run in runs], [at // fanout for at in of]
    return nodes[0], paths


def brute(rows, fanout=8):
    """Sorted rows of the query, from (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        i, text = row[0], row[4]
        lowered = text
        if i is not None and text is not None and zlib.crc32(str(i).encode()) % 3 == 0:
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf, now = (sha("".join(map(sized, (*row[:4], t)))) for t in (text, lowered))
        groups.setdefault(row[2], []).append((i is not None, i or 0, leaf, now))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    below = {lang: tree([x[2] for x in sorted(groups[lang])], fanout) for lang in langs}
    root, above = tree([below[lang][0] for lang in langs], fanout)
    out = []
    for lang, upper in zip(langs, above, strict=True):
        subroot, paths = below[lang]
        for (there, i, leaf, now), lower in zip(sorted(groups[lang]), paths, strict=True):
            path, h = lower + upper, now
            for left, right in path:
                h = sha(left + h + right)
            out.append((i if there else None, leaf, subroot, root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def query(df, **how):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", letters, letters.lower())).otherwise(F.col("text"))
    return merkle.verified(df, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", changed={"text": tampered}, **how)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert found(queries.op13_merkle(spark, SF)) == brute(rows)
    same_rows(queries.op13_merkle(spark, SF), queries.OP13)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_cases(spark):
    """Null columns and ids, equal rows, ties of the order, one-row groups, many groups, long texts, clashing columns."""
    rows = [(i, f"s{i % 3}", f"l{i % 40:02d}", i, "Text %d" % i) for i in range(700)]
    rows += [(None, None, None, None, None), (None, "x", None, 1, ""), (5, "é", None, None, "A" * 1_000_000), (6, "a", "l00", 1, "B")] + [(7, "a", "hot", 2, "Same")] * 100
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clashing = df.withColumns({n: F.lit("clash") for n in ("tree", "lo", "hi", "total", "digest", "kids", "path", "leaf", "root", "nth", "at", "range", "sort", "keep", "of")})
    assert found(query(clashing)) == brute(rows)
    assert found(query(df, fanout=2)) == brute(rows, 2)
    assert found(query(df.limit(0))) == []
    alone = [(3, "a", "en", 1, "x")]
    assert found(query(spark.createDataFrame(alone, SCHEMA))) == brute(alone)


def test_parents_beyond_the_broadcast(spark, monkeypatch):
    rows = [(i, "s", "en" if i % 3 else "de", 1, f"T{i}") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(merkle, "FEW_PARENTS", 0)
    monkeypatch.setattr(merkle, "SMALL", 0)
    assert found(query(df)) == brute(rows)


def test_only_true_changes_are_found(spark):
    df = spark.createDataFrame([(i, "s", "en", 1, "text %d" % i) for i in range(100)], SCHEMA)
    now = {"text": F.when(F.col("doc_id") == 41, "text 4l").otherwise(F.col("text"))}
    got = merkle.verified(df, ["doc_id", "text"], "lang", "doc_id", changed=now).where("NOT verified").collect()
    assert [r.doc_id for r in got] == [41]
