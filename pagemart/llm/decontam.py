"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions only.

An item is found in a document if the document contains at least `threshold` of
the item's distinct word shingles. Items are short and documents long, so the
Jaccard similarity of the two says nothing; the search asks for containment.
Items are partitioned by size (their number n of distinct shingles): a partition
holds the sizes between two of BOUNDS. An item's signature is a MinHash sketch of
its smallest shingle hashes, as many as its partition's largest size u needs: a
document that contains threshold * u of u shingles misses at most
u - ceil(threshold * u) of them, so it contains at least one of any one more
than that; smaller sizes need no more. Documents of too few words for an item
are no candidates of it. Signatures are looked up among the hashes of each
document's shingles, and only the candidates found so are verified, by exact
containment of the shingles' text.

Words are runs of letters and digits, lower-cased. An item of fewer words than a
shingle is one shingle of its own width.

Cases: items without words are never found; null texts are texts without words;
rows with a null id are found under that id; each text of a repeated or null item
id is an item of its own, and a document is reported once per item id, with the
figures of the text it contains most of; texts of any length are searched whole;
repeated rows of documents are reported once; no documents or no items give no
rows; further columns, whatever their names, are kept by clean and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart.llm.shared import free_name, quoted, stored

WORDS, THRESHOLD = 5, 0.8
#: Largest sizes of the partitions, each about a quarter more than the one before.
BOUNDS = [1, 2, 3, 4]
while BOUNDS[-1] < 1_000_000:
    BOUNDS.append(BOUNDS[-1] * 5 // 4)
#: Signature rows that are broadcast at most (some 50 bytes each); beyond, the join is shuffled.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """array<string> of a text's words."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _shingles(of_words: str, width: int) -> Column:
    """array<string> of the word shingles of an array column."""
    return F.expr(f"CASE WHEN size({of_words}) >= {width} THEN transform(sequence(1, size({of_words}) - {width - 1}), i -> array_join(slice({of_words}, i, {width}), ' ')) ELSE CAST(array() AS array<string>) END")


def _shingle_hashes(of_hashes: str, width: int) -> Column:
    """The same of an array of word hashes; a shingle's hash is that of its words' hashes."""
    rest = "".join(f", {of_hashes}[i + {k}]" for k in range(1, width))
    return F.expr(f"CASE WHEN size({of_hashes}) >= {width} THEN transform(slice({of_hashes}, 1, size({of_hashes}) - {width - 1}), (x, i) -> xxhash64(x{rest})) ELSE CAST(array() AS array<bigint>) END")


def item_shingles(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """(item_id, digest, width, shingle, hash, n): the distinct shingles of each item, told apart by id and text."""
    of = items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0).withColumn("width", F.least(F.size("w"), F.lit(width)))
    of = of.withColumn("digest", F.unhex(F.md5(F.array_join("w", " ").cast("binary"))))
    shingle = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("width") + 1), lambda i: F.slice("w", i, F.col("width")))
    rows = of.select("item_id", "digest", "width", F.explode(shingle).alias("s")).select("item_id", "digest", "width", F.array_join("s", " ").alias("shingle"), "s")
    # The hash as _shingle_hashes makes it: of the words' hashes in order.
    hashed = F.coalesce(*[F.when(F.col("width") == k, F.xxhash64(*[F.xxhash64(F.element_at("s", j)) for j in range(1, k + 1)])) for k in range(1, width + 1)])
    rows = rows.withColumn("hash", hashed).drop("s").distinct()
    # The same text has the same shingles under any id.
    sizes = rows.groupBy("digest").agg(F.count_distinct("shingle").alias("n"))
    return rows.join(sizes, "digest")


def partition(n: Column) -> Column:
    """The largest size of n's partition; sizes beyond all bounds are one each."""
    return F.coalesce(*[F.when(n <= bound, F.lit(bound).cast("long")) for bound in BOUNDS], n)


def signatures(shingles: DataFrame, threshold: float) -> DataFrame:
    """(item_id, digest, width, n, hash): each item's smallest hashes, in the number its partition asks for."""
    smallest = F.array_sort(F.collect_set("hash"))  # an item's shingles are few: items are short
    grouped = shingles.groupBy("item_id", "digest", "width", "n").agg(smallest.alias("h")).withColumn("u", partition(F.col("n")))
    return grouped.select("item_id", "digest", "width", "n", F.explode(F.expr(f"slice(h, 1, CAST(least(size(h), u - ceil(u * {threshold!r}D - 1e-9D) + 1) AS int))")).alias("hash"))


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def contaminated(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(id, item_id, n_shingles, n_shared, containment) of each document and item found in it."""
    docs = documents.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    shingles = stored(item_shingles(items, item_col, item_text_col, width), "items")
    signed = stored(signatures(shingles, threshold), "signatures")
    # Widths are 1 to `width`; nearly always only the last.
    widths = sorted(r["width"] for r in signed.select("width").distinct().collect())
    rows = signed.count()
    hint = F.broadcast if rows <= BROADCAST_ROWS else lambda df: df

    hashed = docs.select("id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"), F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("w"))
    found = None
    for k in widths:
        probes = hashed.select("id", "key", F.size("w").alias("n_words"), F.explode(_shingle_hashes("w", k)).alias("hash"))
        wanted = hint(signed.where(F.col("width") == k).select("item_id", "digest", "n", "hash"))
        # A text of a words has at most a - k + 1 shingles.
        hits = probes.join(wanted, "hash").where(F.col("n_words") - (k - 1) >= F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9))).select("id", "key", "item_id", "digest")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        kind = items.schema[item_col].dataType
        found = docs.where(F.lit(False)).select("id", F.lit("").alias("key"), F.lit(None).cast(kind).alias("item_id"), F.lit(b"").alias("digest"))
    candidates = stored(found.distinct(), "candidates")
    return stored(_verified(docs, candidates, shingles, widths, threshold), "contained").withColumnRenamed("id", id_col)


def _verified(docs: DataFrame, candidates: DataFrame, shingles: DataFrame, widths: list[int], threshold: float) -> DataFrame:
    """The candidates whose texts contain enough of the items' shingles."""
    keys = stored(candidates.select("key").distinct(), "keys")
    texts = docs.select("text", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"))
    texts = texts.join(_small(keys), "key", "left_semi").dropDuplicates(["key"]).select("key", words(F.col("text")).alias("w"))
    # Items are verified by their text, so ids play no part here. Both sides that repeat a common item are
    # broadcast, unless the items are many, so that no task is dealt all texts of one item.
    pairs = candidates.select("key", "digest").distinct()
    counted = None
    for k in widths or [1]:
        own = _small(shingles.where(F.col("width") == k).select("digest", "n", "shingle").distinct())
        wanted = pairs.join(own, "digest")
        there = texts.select("key", F.explode(F.array_distinct(_shingles("w", k))).alias("shingle"))
        part = wanted.join(there, ["key", "shingle"]).groupBy("key", "digest", "n").agg(F.count(F.lit(1)).alias("n_shared"))
        counted = part if counted is None else counted.unionByName(part)
    kept = _small(stored(counted.where(F.col("n_shared") >= F.col("n") * F.lit(threshold) - F.lit(1e-9)), "kept"))
    best = F.max(F.struct((F.col("n_shared") / F.col("n")).alias("containment"), "n_shared", "n"))
    rows = candidates.join(kept, ["key", "digest"]).groupBy("id", "item_id").agg(best.alias("b"))
    return rows.select("id", "item_id", F.col("b.n").alias("n_shingles"), "b.n_shared", "b.containment")


def clean(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """documents without those that contain an item; all columns kept.

    Where an id is repeated, a row goes if a row of its id contains an item.
    """
    gone = free_name(documents.columns, "gone")
    found = stored(contaminated(documents, items, id_col, text_col, **how).select(F.col(quoted(id_col)).alias(gone)).distinct(), "found")
    return documents.join(_small(found), F.col(quoted(id_col)).eqNullSafe(F.col(gone)), "left_anti")
