"""Language identification against a plain version that has no sampling bound
in reach, and the sample on ids that say nothing."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fishladder.llm import langid


def plain_ppm(rows, order=langid.ORDER):
    """{language: {context: {byte: count}}} of all words of all rows, and the code length of a text."""
    trees = defaultdict(lambda: defaultdict(Counter))
    for r in rows:
        for w in letters(r["text"]):
            data = b" " + w.encode() + b" "
            for i in range(1, len(data)):
                for k in range(min(order, i) + 1):
                    trees[r["lang"]][data[i - k:i]][data[i]] += 1
    return trees


def letters(text):
    return re.findall(r"[^\W\d_]+", text.lower())


def bits(tree, text, order=langid.ORDER):
    total = 0.0
    for w in letters(text):
        data = b" " + w.encode() + b" "
        for i in range(1, len(data)):
            gone = set()
            for k in range(min(order, i), -1, -1):
                node = tree.get(data[i - k:i], {})
                left = {s: n for s, n in node.items() if s not in gone}
                if not left:
                    continue
                whole = sum(left.values()) + len(left)
                if data[i] in left:
                    total -= math.log2(left[data[i]] / whole)
                    break
                total -= math.log2(len(left) / whole)
                gone |= set(left)
            else:
                total += math.log2(max(1, 256 - len(gone)))
    return total


@pytest.fixture(scope="module")
def learned(spark, tables):
    """All training rows of the smallest table (no more rows than the sample takes)."""
    import zlib
    rows = [d for d in tables["documents"] if d["lang"] and d["text"] and zlib.crc32(str(d["doc_id"]).encode()) % 3 != 1]
    return rows, plain_ppm(rows)


def test_trees_are_those_of_all_words(spark, sf, learned):
    rows, plain = learned
    assert max(Counter(r["lang"] for r in rows).values()) <= langid.SAMPLE_ROWS
    trees = langid.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    assert set(trees) == set(plain)
    for lang, tree in trees.items():
        want = {c: dict(n) for c, n in plain[lang].items()}
        odd = [c for c in set(want) ^ set(tree.nodes)] + [c for c in want if tree.nodes.get(c) != want[c]]
        assert not odd, (lang, odd[:5])


def test_every_prediction_is_the_plain_one(spark, sf, tables, learned):
    _, plain = learned
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in langid.predict_languages(docs, langid.fit(docs)).collect()}
    for d in tables["documents"]:
        words = letters(d["text"] or "")
        r = got[d["doc_id"]]
        if not words:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        if len(words) > 400:        # the plain version is slow: its code lengths are compared on texts of up to 400 words
            continue
        text = " ".join(words)
        n = len(words) + len("".join(words).encode())
        cost = {lang: bits(tree, text) / n for lang, tree in plain.items()}
        assert r["lang_pred"] == min(sorted(cost), key=lambda x: round(cost[x], 9)) and abs(r["bits"] - min(cost.values())) < 1e-6


@pytest.mark.parametrize("ids", ["none", "one", "copies"])
def test_every_language_is_learned_whatever_the_ids(spark, sf, ids):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    many = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("copy")     # more rows than the sample takes
    if ids != "copies":
        many = many.withColumn("doc_id", F.lit(None if ids == "none" else 12).cast("long"))
    trees = langid.fit(many, rows=50)
    assert set(trees) == {r[0] for r in docs.select("lang").distinct().collect() if r[0]}
    sampled = {r["l"]: r["k"] for r in langid.sample(many, rows=50).groupBy("l").agg(F.sum("k").alias("k")).collect()}
    assert all(15 <= k <= 120 for k in sampled.values()), sampled


def test_a_sample_of_all_rows_is_all_rows(spark, hard_docs):
    got = langid.sample(hard_docs)
    want = hard_docs.where(~langid.held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    assert got.agg(F.sum("k")).first()[0] == want.count()
