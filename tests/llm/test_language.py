"""Language identification: the models against a plain implementation, accuracy on texts that weren't learned from."""

import collections
import math
import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from loomlake.llm import language_id as L

ORDER = 3


def plain_model(texts, order=ORDER):
    """Interpolated Kneser-Ney with dictionaries: P(c | context) for any context, one language."""
    top = collections.Counter()
    for t in texts:
        s = " " * (order - 1) + "".join(map(chr, L.normalise(t)))
        top.update(s[i : i + order] for i in range(len(s) - order + 1))
    levels = {order: top}
    for k in range(order - 1, 0, -1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])
    alphabet = len(levels[1])

    def p(gram, k):
        if k == 0:
            return 1 / (alphabet + 1)
        counts = levels[k]
        ones, twos = sum(v == 1 for v in counts.values()), sum(v == 2 for v in counts.values())
        d = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        same = {g: v for g, v in counts.items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        if not total:
            return p(gram[1:], k - 1)
        return max(same.get(gram, 0) - d, 0) / total + d * len(same) / total * p(gram[1:], k - 1)

    return lambda gram: p(gram, order)


def grams_of(texts_by_lang, order=ORDER):
    rows = []
    for lang, texts in texts_by_lang.items():
        c = collections.Counter()
        for t in texts:
            pts = [32] * (order - 1) + list(L.normalise(t))
            c.update(tuple(pts[i : i + order]) for i in range(len(pts) - order + 1))
        for g, n in c.items():
            head = sum(x << (21 * j) for j, x in enumerate(g[:-1]))
            rows.append((lang, head, g[-1], n))
    return pd.DataFrame(rows, columns=["lang", "head", "last", "n"])


def test_models_equal_a_plain_implementation():
    data = {"aa": ["the cat sat on the mat", "a cat and the hat"], "bb": ["le chat est ici", "là où le chat dort"]}
    models = L.kneser_ney(grams_of(data), ORDER)
    for text in ("the chat", "zebra où", "Le Chat, est!  là"):
        sizes, sums = L.score_texts(models, [text])
        s = " " * (ORDER - 1) + "".join(map(chr, L.normalise(text)))
        for j, lang in enumerate(models.languages):
            p = plain_model(data[lang])
            want = sum(math.log(p(s[i : i + ORDER])) for i in range(len(s) - ORDER + 1))
            assert abs(sums[0, j] - want) < 1e-3 * len(s), (text, lang, sums[0, j], want)
        assert sizes[0] == len(s) - ORDER + 1


def test_windows_do_not_change_scores(monkeypatch):
    data = {"aa": ["the cat sat on the mat"], "bb": ["le chat est ici"]}
    models = L.kneser_ney(grams_of(data), ORDER)
    text = "the chat est on " * 50
    _, whole = L.score_texts(models, [text])
    monkeypatch.setattr(L, "WINDOW", 37)
    _, parts = L.score_texts(models, [text])
    assert np.allclose(whole, parts, rtol=1e-4)


def test_hashes_find():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    h = L._Hashes.of(keys)
    assert (h.find(keys) == np.arange(len(keys))).all()
    assert (h.find(keys[:-1] + np.uint64(1)) == -1).sum() >= len(keys) - 3


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.op2_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id").toPandas()
    assert len(got) == docs.count()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    assert got["score"].between(0, 1).all()
    test = got[got["held_out"] & got["lang"].notna() & got["text"].fillna("").str.contains(r"[^\W\d_]", regex=True)]
    assert len(test) > 100 and (test["lang"] == test["lang_pred"]).mean() > 0.97


def test_defined_results(spark):
    rng = random.Random(3)
    words = {"en": "the of and to in is that it for was".split(), "de": "der die und das nicht ist ein ich mit auch".split()}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(40)), x) for i in range(80) for x in ("en", "de")]
    rows = [(j, t, x) for j, (_, t, x) in enumerate(rows)]
    odd = [(1000, None, "en"), (1001, "", None), (1002, "123 !?", "de"), (None, "the of and to", None), (1003, "und das " * 100_000, None), (1003, "die und", None), (1004, "qxzj" * 40, None)]
    df = spark.createDataFrame([(d, t, x, 0.5) for d, t, x in rows + odd], "doc_id long, text string, lang string, score double")
    got = {(r["doc_id"], (r["text"] or "")[:12]): r["_language"] for r in L.language_of_documents(df).collect()}
    assert got[1000, ""]["lang"] == got[1001, ""]["lang"] == got[1002, "123 !?"]["lang"] == "und"
    assert got[1000, ""]["score"] == 0 and got[1000, ""]["rejected"]
    assert got[1003, "und das und "]["lang"] == "de" and got[None, "the of and t"]["lang"] == "en"
    assert got[1004, "qxzjqxzjqxzj"]["rejected"] and not got[1003, "und das und "]["rejected"]
    nothing = L.language_of_documents(df.filter("lang IS NULL")).select("_language.lang").distinct().collect()
    assert [r[0] for r in nothing] == ["und"]
    assert L.language_of_documents(df.filter("doc_id < 0")).count() == 0


def test_predictions_use_the_text_only(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    one = {r["doc_id"]: r["_language"]["lang"] for r in L.language_of_documents(df).collect()}
    held = L.held_out()
    hidden = df.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    two = {r["doc_id"]: r["_language"]["lang"] for r in L.language_of_documents(hidden).collect()}
    assert one == two
