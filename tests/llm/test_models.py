import numpy as np
from pyspark.sql import functions as F

from pagemart.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = queries.op5_language_id(spark, SF).join(truth, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(found) > 100 and all(0 <= r.score <= 1 for r in found)
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.95


def test_language_is_the_definition():
    """One text's vector from letter vectors, n-gram by n-gram."""
    codes = langid._codes()
    text = "Ab, é!"
    line = [0, codes[ord("a")], codes[ord("b")], 0, codes[ord("é")], 0]
    expected = np.zeros(langid.SIZE)
    for i in range(len(line) - 2):
        a, b, c = (langid.letter(int(k)).astype(float) for k in line[i : i + 3])
        expected += np.roll(a, 2) * np.roll(b, 1) * c
    assert np.array_equal(langid.Bundler().vector(text), expected)
    small = langid.Bundler(most=4)
    assert np.array_equal(small.vector(text), expected) and np.array_equal(small.vector(text), expected)


def brute_vector(text):
    """The bundle of a text's n-grams, letter by letter."""
    line = [0] + [ord(c.lower()[0]) if c.isalpha() else 0 for c in text] + [0]
    line = [c for i, c in enumerate(line) if c or not i or line[i - 1]]
    total = np.zeros(langid.SIZE)
    for i in range(len(line) - 2):
        a, b, c = (langid.letter(k).astype(float) for k in line[i : i + 3])
        total += np.roll(a, 2) * np.roll(b, 1) * c
    return total


def test_language_against_brute_force(spark):
    """Prototypes and predictions of a small table, Han and Hangul letters among them."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("a dog and a cat", "en"), ("der hund und die katze", "de"), ("語言識別的方法很多", "zh"), ("한국어 문장입니다", "ko"), ("ein Hund, eine Katze!", None), ("x", None), ("識別", None), ("CAT", None)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    prototypes = langid.fit(df)
    expected = {}
    for _, text, lang in rows:
        if lang:
            v = brute_vector(text)
            expected[lang] = expected.get(lang, 0) + v / np.linalg.norm(v)
    expected = {k: v / np.linalg.norm(v) for k, v in sorted(expected.items())}
    assert list(prototypes) == list(expected) and all(np.allclose(prototypes[k], v, atol=1e-5) for k, v in expected.items())
    for r in langid.with_language(df.withColumn("found", F.lit(1)), prototypes).collect():
        v = brute_vector(r.text)
        cosines = {k: float(p @ v) / np.linalg.norm(v) for k, p in expected.items()}
        best = max(cosines, key=cosines.get)
        assert r.lang_pred == best and abs(r.score - max(0, cosines[best])) < 1e-5 and r.found == 1


def test_no_two_letters_share_a_vector():
    codes = [*range(0x61, 0x7B), *range(0x3B1, 0x3CA), *range(0x430, 0x450), *range(0x4E00, 0x4E00 + 9000), *range(0xAC00, 0xAC00 + 3000), 0x20000]
    assert len({langid.letter(c).tobytes() for c in codes}) == len(codes)
    assert len({int(c) for c in langid._codes()[codes]}) == len(codes)


def test_language_ties(spark):
    """Equal prototypes: the language first in order."""
    df = spark.createDataFrame([(1, "same words", "b"), (2, "same words", "a"), (2, "same words", "a")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.with_language(df, langid.fit(df)).collect()} == {"a"}
    assert langid.keep_known(df.withColumn("_found", F.lit(1)).withColumn("found", F.lit(2)), langid.fit(df)).count() == 3


def test_language_cases(spark):
    rows = [(1, "the cat and the dog sat on the mat", "en"), (2, "der hund und die katze sind nicht hier", "de"), (None, None, None), (4, "", "en"), (5, "123 !!", "en"), (6, "ein hund und eine katze " * 5000, None), (None, "the dog", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    prototypes = langid.fit(df)
    assert list(prototypes) == ["de", "en"]
    out = langid.with_language(df.withColumn("score", F.lit("clashes")), prototypes).collect()
    assert [r.lang_pred for r in out] == ["en", "de", "und", "und", "und", "de", "en"]
    assert {r.lang_pred for r in langid.with_language(df, langid.fit(df.limit(0))).collect()} == {"und"}


def test_quality_held_out(spark):
    truth = spark.read.parquet(f"{SF}/labels.parquet")
    found = queries.op6_quality(spark, SF).join(truth, "doc_id").where("held_out").collect()
    score, label = np.array([r.score for r in found]), np.array([r.quality for r in found])
    pairs = score[label == 1][:, None] > score[label == 0][None, :]
    assert pairs.mean() > 0.95 and np.mean((score >= 0.5) == label) > 0.9
    assert all(r.predicted == int(r.score >= 0.5) for r in found)


def test_chunks_cover_everything():
    step = quality.CHUNK - quality.OVERLAP
    for n in (0, 1, quality.CHUNK, quality.CHUNK + 1, quality.CHUNK + step, 10 * step + 3):
        data = bytes(i % 250 for i in range(n))
        chunks = quality.chunks_of(data)
        joined = b"".join(c.tobytes()[: step if i < len(chunks) - 1 else None] for i, c in enumerate(chunks))
        assert joined.rstrip(bytes([quality.PAD])) == data.rstrip(bytes([quality.PAD])) and len(joined) >= n


def test_scores_do_not_depend_on_batches():
    net = quality.Network.fresh(0.7)
    texts = [b"", b"a few words", b"more " * 3000, b"x"]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([t])[0] for t in texts], atol=1e-6)


def brute_logit(net, data):
    """The forward pass by loops."""
    step, at, kept = quality.CHUNK - quality.OVERLAP, 0, []
    while True:
        chunk = data[at : at + quality.CHUNK].ljust(quality.CHUNK, bytes([quality.PAD]))
        best = np.full(quality.FILTERS, -np.inf)
        for i in range(quality.CHUNK - quality.WIDTH + 1):
            x = np.concatenate([net.embed[b].astype(float) for b in chunk[i : i + quality.WIDTH]])
            best = np.maximum(best, x @ net.filters.astype(float))
        kept.append(np.maximum(best + net.bias, 0))
        at += step
        if at + quality.OVERLAP >= len(data):
            break
    kept = np.array(kept)
    return float(np.concatenate([kept.max(axis=0), kept.mean(axis=0)]) @ net.out + net.out_bias)


def test_forward_pass_against_loops():
    net = quality.Network.fresh(0.6)
    net.bias += np.linspace(-1, 1, quality.FILTERS, dtype=np.float32)
    texts = [b"", b"abc", "é漢 words ".encode() * 30, b"a longer text, " * 90, bytes(range(200)) * 5]
    for text, score in zip(texts, net.scores(texts), strict=True):
        assert abs(1 / (1 + np.exp(-brute_logit(net, text))) - score) < 1e-5


def test_gradients_against_differences():
    net = quality.Network.fresh(0.5)
    texts, labels = [b"some good text ", b"BAD!! " * 100], np.array([1, 0], np.float32)
    chunks = [quality.chunks_of(t) for t in texts]
    found, _ = quality.gradients(net, np.concatenate(chunks), np.array([len(c) for c in chunks]), labels)

    def loss():
        z = np.array([brute_logit(net, t) for t in texts])
        return float(np.mean(np.log1p(np.exp(-np.where(labels == 1, z, -z)))))

    r, step = np.random.default_rng(3), 2e-3
    used = sorted(set(b"".join(texts)))
    for values, slope in zip(net.parameters(), found, strict=False):
        for _ in range(4):
            at = (int(r.choice(used)), *(int(r.integers(n)) for n in values.shape[1:])) if values is net.embed else tuple(int(r.integers(n)) for n in values.shape)
            before = values[at]
            values[at] = before + step
            up = loss()
            values[at] = before - step
            down = loss()
            values[at] = before
            assert abs((up - down) / (2 * step) - slope[at]) < 2e-3 + 0.05 * abs(slope[at])


def test_learning_separates():
    texts = [quality.chunks_of(t) for t in [b"good text here " * 20, b"bad!! TEXT!! " * 20] * 20]
    labels = np.array([1, 0] * 20, np.float32)
    scores = quality.learn(texts, labels).scores([t[0].tobytes() for t in texts])
    assert scores[labels == 1].min() > 0.8 and scores[labels == 0].max() < 0.2


def test_the_middle_of_a_long_text_is_learned_from():
    """Texts of 1 MB that differ only by a mark at their middle."""
    plain = b"some common words of a long text, " * 15_000
    texts = [plain + b"%% ZQXJ ZQXJ %% " * label + plain + b"tail %d" % i for i in range(3) for label in (0, 1)]
    labels = np.array([i % 2 for i in range(6)], np.float32)
    net = quality.learn([quality.chunks_of(t) for t in texts], labels, passes=40)
    scores = net.scores(texts)
    assert scores[labels == 1].min() > 0.5 > scores[labels == 0].max()


def test_what_is_learned_from_is_bounded(spark, monkeypatch):
    """By rows, however often an id is repeated, and by bytes, in whole texts."""
    rows = [(i % 40, f"{'good' if i % 2 else 'bad'} text {i % 3} " * 50) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "learn", lambda texts, y: seen.append(texts) or quality.Network.fresh(0.5))
    quality.train(docs, labels)
    quality.train(docs, labels, most_bytes=3_000)
    assert 20 < len(seen[0]) <= 40 and 0 < len(seen[1]) < len(seen[0]) / 2
    assert all(len(c) == len(quality.chunks_of(b"good text 1 " * 50)) for c in seen[1])


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, None), (None, "x"), (3, ""), (3, "long " * 50_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    out = quality.with_quality(docs.withColumn("score", F.lit("clashes")), quality.train(docs, labels)).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    assert quality.with_quality(docs.limit(0), quality.train(docs.limit(0), labels.limit(0))).count() == 0
