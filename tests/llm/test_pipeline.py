"""The pipeline: order and shape of its stages, and its rows against a plain version."""

import brute
from pyspark.sql import functions as F

import corpus_pipeline as P
from fishladder.llm import langid


def test_stages():
    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "token_output"]
    assert P.ORACLE_SQL is None


def test_rows_match_the_plain_version(spark, sf, tables):
    bench = tables["benchmark"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    trees = langid.fit(docs)
    scorer = langid.Scorer(trees)
    rows = [d for d in tables["documents"] if scorer.predict(d["text"])[0] != "und" and scorer.predict(d["text"])[2] <= langid.REJECT_BITS]
    assert len(rows) >= 0.98 * len(tables["documents"])
    rows = [d for d, (i, _, c) in zip(rows, brute.op9(rows)) if i == c]
    rows = [d for d, hit in zip(rows, brute.op5(rows, bench)) if not hit[-1]]
    # mixing: whole copies by hash order within each source
    import hashlib
    import re
    size = lambda d: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
    digest = lambda d: hashlib.md5(f"{d['doc_id']}|{d['text']}".encode()).hexdigest()[:9]
    own = {}
    for d in rows:
        own[d["source"]] = own.get(d["source"], 0) + size(d)
    mixed = []
    for s, target in brute.op7_targets(own).items():
        full, at = int(target // own[s]) if own[s] else 0, 0
        need = target - full * own[s]
        order = sorted((d for d in rows if d["source"] == s), key=digest)
        passed = False
        for d in order:
            more = not passed and at + size(d) <= need
            if not passed and not more:
                passed, more = True, at + size(d) - need <= need - at
            at += size(d)
            mixed += [d] * (full + more)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in P.run(spark, sf).collect()]
    assert sorted(got) == sorted(brute.op1(mixed))


def test_stages_keep_all_columns_and_take_any_table(spark, sf, hard_docs):
    docs = hard_docs
    for name, stage in P.STAGES:
        for table in (docs, docs.where(F.lit(False))):
            out = stage(spark, table, sf)
            assert name == "token_output" or out.columns == table.columns
            out.collect()
