"""Benchmark decontamination as a prefix-filtered set join, in SQL functions only.

A window (13 consecutive words of an item, or a whole shorter item) occurs in a
document if all its words stand there in order. Tokens of the join are
three-word shingles (of windows shorter than three words, the whole window).
A window lies wholly inside a document or not at all, so of its shingles, put
in order of rarity in the corpus, the first one is all that must be joined:

1. one scan of the documents keeps the positions whose shingle may be one of
   the benchmark's with the words around them, and the document's word count.
   A table of bits in the expression tells: two bits per shingle, sized by the
   benchmark (16 to 32 bits a shingle, so about one foreign position in 75 or
   less passes), up to ``MAX_BITS`` bits, 4 million shingles. Beyond that more
   positions pass to step 2; the result is exact at any size;
2. an equality join with the benchmark's shingles makes these exact; counting
   them gives the rarity order and each window's rarest shingle;
3. positions of a window's rarest shingle fix where the window must start:
   length and positional bounds (it must fit between first and last word), then
   the words themselves are compared;
4. the words covered by the verified windows are counted per document.

Documents' texts are read once and never shuffled. Rows are told apart by id
and a hash of the text, so repeated rows share their result.

Defined cases: null text has no words; an item with null or empty text has no
window; a null item id counts as the item with the empty id; null and repeated document
ids keep a row each; empty tables give no hits; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.llm.common import documents, packed, small, work_dir, write_table
from fishladder.operators.verbs import join_null_safe

WINDOW_WORDS = 13
SHINGLE = 3
MAX_BITS = 1 << 26
_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text):
    """A-Z to a-z, nothing else. ``lower`` does just that on ASCII texts."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text):
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SPLIT), lambda w: w != "")


def _shingle(ws, i, n):
    """Hash of the ``n`` words from position ``i`` on."""
    return F.xxhash64(F.lit(n), *[F.get(ws, i + j) for j in range(n)])


def benchmark_windows(bench: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """item, w (the words of a window), one row per item and distinct window."""
    b = bench.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                     words(F.col(text_col).cast("string")).alias("ws")).where(F.size("ws") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - window, F.lit(0)))
    return b.select("item", F.explode(F.transform(starts, lambda i: F.slice("ws", i + 1, window))).alias("w")).distinct()


POSITIONS = "array<struct<pos:int,k:int,lo:int,ctx:array<string>>>"


def _bits_of(h, bits: int):
    """The two bits of a shingle hash in a table of ``bits`` bits, a power of two."""
    low = F.lit(bits - 1)
    return [h.bitwiseAND(low), F.shiftrightunsigned(h, 32).bitwiseAND(low)]


def bit_table(keys: DataFrame, n_keys: int):
    """(table, bits): array column of 64-bit words in which the bits of all hashes ``h`` are set."""
    bits = min(MAX_BITS, max(1 << 10, 1 << (16 * n_keys - 1).bit_length() if n_keys else 0))
    at = keys.select(F.explode(F.array(*_bits_of(F.col("h"), bits))).alias("at"))
    found = at.groupBy(F.shiftright("at", 6).cast("int").alias("word")) \
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("set"))
    table = [0] * (bits // 64)
    for r in found.collect():                          # at most `bits` / 64 rows
        table[r["word"]] = r["set"]
    # one foldable expression, so the plan holds one literal and not one per word
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>"), bits


def _hashes(k: int):
    """Hashes of the shingles of ``k`` words of ``ws``, by position."""
    return F.when(F.col("n") >= k, F.transform(F.sequence(F.lit(0), F.col("n") - k), lambda i: _shingle(F.col("ws"), i, k))) \
            .otherwise(F.array().cast("array<bigint>"))


def _positions(k: int, window: int, table, bits: int):
    """Positions of words ``ws`` whose shingle of ``k`` words (hash in ``h<k>``) has its
    bits in the table, each with all words that a window holding that shingle can reach."""
    back = window - k
    is_set = lambda at: F.getbit(F.get(table, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1
    found = F.filter(F.transform(f"h{k}", lambda h, i: F.struct(h.alias("h"), i.alias("i"))),
                     lambda x: is_set(_bits_of(x["h"], bits)[0]) & is_set(_bits_of(x["h"], bits)[1]))
    return F.transform(found, lambda x: F.struct(
        x["i"].alias("pos"), F.lit(k).alias("k"), F.greatest(x["i"] - back, F.lit(0)).alias("lo"),
        F.slice("ws", F.greatest(x["i"] - back, F.lit(0)) + 1, F.least(x["i"], F.lit(back)) + window).alias("ctx")))


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS,
                  shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (sorted) for every document."""
    spark = docs.sparkSession
    wins = write_table(benchmark_windows(bench, item_col, item_text_col, window), work_dir(spark, "bench-windows"))
    # shingles of every distinct window: k words each, at their offsets
    k = F.least(F.size("w"), F.lit(shingle))
    lengths = [r.k for r in wins.select(k.alias("k")).distinct().collect()]          # at most `shingle` values
    texts = wins.select("w").distinct()
    offsets = F.sequence(F.lit(0), F.size("w") - F.col("k"))
    pick = lambda i: F.slice("w", i + 1, F.col("k"))
    toks = write_table(texts.withColumn("k", k).select(
        "w", F.posexplode(F.transform(offsets, pick)).alias("off", "tok")), work_dir(spark, "bench-shingles"))
    keys = write_table(toks.select("tok").distinct().withColumn(
        "h", F.xxhash64(F.size("tok"), *[F.get("tok", F.lit(j)) for j in range(shingle)])), work_dir(spark, "bench-keys"))   # the hash skips missing words

    table, bits = bit_table(keys, keys.count())

    key = [F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key")]
    scan = docs.select(*key, words(F.col(text_col).cast("string")).alias("ws")).withColumn("n", F.size("ws"))
    scan = scan.withColumns({f"h{k}": _hashes(k) for k in lengths})
    parts = [_positions(k, window, table, bits) for k in lengths]
    cands = F.concat(F.array().cast(POSITIONS), *parts)
    scanned = write_table(scan.select("doc_id", "text_key", "n", cands.alias("c")), work_dir(spark, "doc-positions"))

    at = scanned.where(F.size("c") > 0).select("doc_id", "text_key", "n", F.explode("c").alias("c")) \
                .select("doc_id", "text_key", "n", "c.pos", "c.lo", "c.ctx",
                        F.slice("c.ctx", F.col("c.pos") - F.col("c.lo") + 1, F.col("c.k")).alias("tok"))
    # step 2: corpus counts of the benchmark's shingles
    keys_side = small(keys.select("tok"))
    df = write_table(at.join(keys_side, "tok", "left_semi").groupBy("tok").agg(F.count(F.lit(1)).alias("freq")),
                     work_dir(spark, "shingle-counts"))
    rare = toks.join(df, "tok")                      # a window with a shingle that never occurs cannot occur
    whole = texts.withColumn("k", k).select("w", (F.size("w") - F.col("k") + 1).alias("need"))
    rarest = (rare.groupBy("w").agg(F.min(F.struct("freq", "off", "tok")).alias("p"), F.count(F.lit(1)).alias("found"))
              .join(whole, "w").where(F.col("found") == F.col("need")).select("w", "p.off", "p.tok"))
    owners = wins.groupBy("w").agg(F.sort_array(F.collect_set("item")).alias("items"))
    prefix = write_table(rarest.join(owners, "w"), work_dir(spark, "prefix-tokens"))

    # step 3: bounds, then the words
    start = F.col("pos") - F.col("off")
    hits = (at.join(small(prefix), "tok")
            .where((start >= 0) & (start + F.size("w") <= F.col("n")))
            .where(F.slice("ctx", start - F.col("lo") + 1, F.size("w")) == F.col("w"))
            .select("doc_id", "text_key", start.alias("s"), F.size("w").alias("len"), "items"))
    per_doc = hits.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("s", "len"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    # step 4: length of the union of the spans, which are sorted by start
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum")), lambda a, x: F.struct(
        F.greatest(a["end"], x["s"] + x["len"]).alias("end"),
        (a["sum"] + F.greatest(F.lit(0), x["s"] + x["len"] - F.greatest(a["end"], x["s"]))).alias("sum")), lambda a: a["sum"])
    per_doc = per_doc.select("doc_id", "text_key", covered.alias("n_hit"), "items")
    out = join_null_safe(scanned.select("doc_id", "text_key", "n"), per_doc, ["doc_id", "text_key"], "left")
    return out.select("doc_id", "text_key", F.col("n").cast("long").alias("n_words"),
                      F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated(n_hit, n_words):
    """The contract's rule: at least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    found = decontaminate(docs, bench, id_col, text_col).where(contaminated(F.col("n_hit"), F.col("n_words")))
    found = write_table(found.select("doc_id", "text_key").distinct(), work_dir(docs.sparkSession, "contaminated"))
    rows = docs.select(packed(docs), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("key"))
    hit = F.col("id").eqNullSafe(found["doc_id"]) & (F.col("key") == found["text_key"])
    return rows.join(small(found), hit, "left_anti").select("_row.*")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
           FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
             list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
      FROM benchmark),
w AS (SELECT DISTINCT item, ws[i:i + 12] AS w FROM (SELECT item, ws, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i
      FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT len(w) AS l FROM w),
p AS (SELECT rid, l, unnest(generate_series(1, len(ws) - l + 1)) AS i, ws FROM d, lens WHERE len(ws) >= l),
h AS (SELECT p.rid, p.i, p.l, w.item FROM p JOIN w ON p.ws[p.i:p.i + p.l - 1] = w.w),
c AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + l - 1)) AS pos FROM h) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""
