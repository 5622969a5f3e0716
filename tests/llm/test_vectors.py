"""Fill-in-the-middle, vector codes and top-k search against plain versions:
the smallest tables, hard cases, ties, very large components, empty tables."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from fishladder.llm import fim, topk, vector_codes
from fishladder.llm.queries import REGISTRY

FIM = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
CODES = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
TOP = ["query_id", "rank", "vec_id", "score"]
SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.fixture(scope="module")
def embeddings(spark, sf):
    return [r.asDict() for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]


@pytest.mark.parametrize("name, cols, plain", [("op12_vector_codes", CODES, brute.op12), ("op13_topk_search", TOP, brute.op13)])
def test_vector_query_matches_the_plain_version(spark, sf, embeddings, same, name, cols, plain):
    same(REGISTRY[name](spark, sf), cols, plain(embeddings))


# --- 11: fill in the middle -------------------------------------------------------------------

def test_fim_matches_the_plain_version(spark, sf, tables, same):
    same(REGISTRY["op11_fill_in_middle"](spark, sf), FIM, brute.op11(tables["documents"]))


def digests(df):
    return df.withColumns({"output_sha256": F.sha2("output", 256),
                           "restored_sha256": F.sha2(fim.restored(F.col("output"), F.col("form")), 256)})


def test_fim_of_hard_cases(spark, hard_docs, no_docs, same, dicts):
    same(digests(fim.fill_in_middle(hard_docs)), FIM, brute.op11(dicts(hard_docs)))
    assert fim.fill_in_middle(no_docs).count() == 0
    texts = ["<P>", "a<S>b", "x<M", "<<P", "<P<S<M", "<P\n", "é< >", "\r\n", "a" * 3000 + "<S" + "P>" * 700, "<S", ">" * 50]
    df = spark.createDataFrame([(i, t) for i in range(40) for t in texts], "doc_id long, text string")
    same(digests(fim.fill_in_middle(df)), FIM, brute.op11([r.asDict() for r in df.collect()]))


def test_restored_text_is_the_text(hard_docs):
    out = fim.fill_in_middle(hard_docs.withColumn("doc_id", F.monotonically_increasing_id()))
    both = out.join(hard_docs.withColumn("doc_id", F.monotonically_increasing_id()).select("doc_id", "text"), "doc_id")
    assert both.where(fim.restored(F.col("output"), F.col("form")) != F.coalesce("text", F.lit(""))).count() == 0
    assert {r["form"] for r in out.collect()} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("length", [1, 2, 7, 1000])
def test_regions_do_not_change_the_cuts(length):
    rng = random.Random(length)
    for _ in range(60):
        text = "".join(rng.choice(["a", "Zz", " ", "é", "\n", "word", "1"]) for _ in range(rng.randrange(40)))
        one, two = rng.randrange(1 << 32), rng.randrange(1 << 32)
        assert fim.cuts(text, one, two, length) == fim.cuts(text, one, two)
        assert "".join(text[a:b] for a, b in fim.regions(text, length)) == text


# --- 12: vector codes ---------------------------------------------------------------------------

def hard_vectors(dims=16, n=150, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1 / 3, 2.0]) for _ in range(dims)], i % 4 or None) for i in range(n)]
    rows += [(i, list(rows[0][1]), 9) for i in range(200, 260)]                       # one common vector
    rows += [(7, list(rows[7][1]), 1)] * 3 + [(20, [0.1] * dims, 1), (None, [0.5] * dims, None), (None, [0.5] * dims, 2)]
    bad = [None, [None] + [1.0] * (dims - 1), [float("nan")] * dims, [float("inf")] * dims, [float("-inf")] + [0.0] * (dims - 1)]
    return rows + [(400 + 20 * i, v, 1) for i, v in enumerate(bad)] + [(600, [0.0] * dims, 5), (620, [-0.0] * dims, 5)]


def frame(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.lit(7) for c in ("v", "id", "q", "x", "code", "error", "n", "chunk", "slot", "score")})


def plain_rows(rows):
    return [dict(zip(("vec_id", "embedding", "label"), r)) for r in rows]


@pytest.mark.parametrize("dims, schema", [(16, SCHEMA), (48, SCHEMA), (16, SCHEMA.replace("double", "float")), (5, SCHEMA), (100, SCHEMA)])
def test_codes_of_hard_cases(spark, same, dims, schema):
    rows = hard_vectors(dims)
    df = frame(spark, rows, schema).repartition(5)
    stored = [r.asDict() for r in df.collect()]
    same(vector_codes.vector_codes(df), CODES, brute.op12(stored))


def test_codes_of_few_rows_and_none(spark, same):
    rows = hard_vectors(16, 10)[:10]
    same(vector_codes.vector_codes(frame(spark, rows)), CODES, brute.op12(plain_rows(rows)))
    assert vector_codes.vector_codes(frame(spark, [])).count() == 0
    assert vector_codes.vector_codes(frame(spark, [(1, None, 1), (2, [float("nan")] * 4, 1)])).count() == 0
    empty = vector_codes.vector_codes(frame(spark, [(1, [], 1), (2, [], None)])).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in empty) == [(1, "00" * 16, 0), (2, "00" * 16, 0)]
    shorter = [(1, [1.0, 2.0], 1), (2, [1.0, 2.0, 0.0, 0.0], 1), (3, [3.0] * 32, 1)]
    got = {r["vec_id"]: r["code"] for r in vector_codes.vector_codes(frame(spark, shorter)).collect()}
    assert got[1] == got[2] != got[3]


def test_codes_of_very_large_components(spark, same):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1.0, -3.0, 4e14, rng.uniform(-4e14, 4e14)]) for _ in range(32)], 1) for i in range(100)]
    rows.append((500, [1e17] + [0.0] * 31, 1))                                        # beyond 62 bits: dropped
    want = brute.op12(plain_rows(rows[:-1]))
    assert any(w[2] >= 1 << 63 for w in want) or any(w[3] >= 1 << 63 for w in want)
    got = {r["vec_id"]: r for r in vector_codes.vector_codes(frame(spark, rows)).collect()}
    assert len(got) == 100
    for i, code, error, _, digest in want:
        assert (got[i]["code"], got[i]["codebooks_sha256"]) == (code, digest)
        assert got[i]["error"] == (error if error < 1 << 63 else None)


def test_transform_is_walsh_hadamard_in_sequency_order():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 4, 7, 8, 16):
        x = rng.integers(-100, 100, (5, size))
        t = vector_codes.transformed(x)
        assert ((t ** 2).sum(axis=1) == t.shape[1] * (x ** 2).sum(axis=1)).all()       # Parseval
        basis = vector_codes.transformed(np.eye(t.shape[1], dtype=np.int64))
        changes = (np.diff(basis.T, axis=1) != 0).sum(axis=1)
        assert list(changes) == list(range(t.shape[1]))                                # one sign change more each


def test_nearest_entry_is_exact_with_ties():
    rng = np.random.default_rng(2)
    for kind in (np.int64, object):
        x, e = rng.integers(-3, 4, (400, 6)).astype(kind), rng.integers(-3, 4, (30, 6)).astype(kind)
        at, distance = vector_codes.nearest(vector_codes.transformed(x), vector_codes.transformed(e))
        full = ((x[:, None] - e[None]) ** 2).sum(axis=2)
        assert (at == np.array([list(r).index(min(r)) for r in full])).all()
        assert (distance == full.min(axis=1)).all()


# --- 13: top-k search ---------------------------------------------------------------------------

@pytest.mark.parametrize("dims, tile_rows, k", [(16, None, 20), (16, 10, 20), (5, 3, 4), (100, 40, 1)])
def test_top_k_of_hard_cases(spark, same, dims, tile_rows, k):
    rows = hard_vectors(dims)
    df = frame(spark, rows).repartition(3)
    stored = [r.asDict() for r in df.collect()]
    same(topk.top_k(df, F.col("vec_id") % 20 == 0, k, tile_rows=tile_rows), TOP, brute.op13(stored, k))


def test_top_k_of_few_rows_and_none(spark, same):
    rows = hard_vectors(16, 10)[:10]
    same(topk.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0), TOP, brute.op13(plain_rows(rows)))
    for rows in ([], [(1, None, 1)], [(0, [1.0], 1)], [(1, [1.0], 1), (2, [2.0], 1)]):
        assert topk.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0).count() == 0
    rows = [(0, [], 1), (20, [], 1), (21, [1.0, -2.0], 1), (40, [3.0], 1)]               # different lengths: padded with zeros
    same(topk.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0), TOP, brute.op13(plain_rows(rows)))


@pytest.mark.parametrize("size", [1000.0, 1e6, 1.1e7])
def test_top_k_of_large_components(spark, same, size):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-size, size) for _ in range(8)], 1) for i in range(200)]
    rows.append((800, [1e12] * 8, 1))                                                   # a score might leave 64 bits
    same(topk.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, tile_rows=50), TOP, brute.op13(plain_rows(rows[:-1])))


def test_pruning_skips_blocks_and_keeps_results():
    rng = np.random.default_rng(4)
    centres = rng.integers(-60, 60, (40, 32))
    x = np.concatenate([c + rng.integers(-3, 4, (128, 32)) for c in centres])[rng.permutation(40 * 128)]
    x = x[topk.similar_order(x)]
    ids, q = rng.permutation(len(x)).astype(np.int64), x[::100]
    hi, lo = topk.maxima(x)
    best, scored = topk.search_tile(q, np.full(len(q), topk.LEAST), x, ids, hi, lo, 10)
    assert scored < 0.25 * len(q) * len(hi)
    full = q @ x.T
    for i in range(len(q)):
        want = sorted(zip(-full[i], ids))[:10]
        assert list(zip(-best.score[best.query == i], best.id[best.query == i])) == want


def test_equal_vectors_are_not_scored_again_and_again():
    x = np.tile(np.array([[5, -3, 2]]), (64 * 64, 1))
    ids = np.arange(len(x))[::-1].copy()
    hi, lo = topk.maxima(x)
    q = x[:50]
    best, scored = topk.search_tile(q, np.full(len(q), topk.LEAST), x, ids, hi, lo, 21)
    assert all(list(best.id[best.query == i]) == list(range(21)) for i in range(50))
    best, scored = topk.search_tile(q, np.full(len(q), topk.LEAST), x, ids[::-1].copy(), hi, lo, 21)
    assert scored == len(q) and all(list(best.id[best.query == i]) == list(range(21)) for i in range(50))
