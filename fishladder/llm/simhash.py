"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints (64 bits, majority of the shingle hashes per bit) are computed in
one pass. Two fingerprints within ``max_bits`` = 3 bits agree in at least two of
five blocks, so each distinct fingerprint is listed under its ten pairs of
blocks (26 bits or so) and only those listed together are compared. Equal
fingerprints are one node from the start.

A list is verified by its task in one stream of sorted rows: Hamming distances
in bulk, and only a spanning forest of the links leaves the task, so what is
emitted grows with the members of a list and not with its pairs. A long list is
first dealt into sublists of at most about ``LIST`` members, and every two
sublists meet in a task of their own: no task holds more than two sublists.

Components come from alternating large-star and small-star rounds on the
links; every round is a written table, and links never go to the driver.

Defined cases: null or empty texts have fingerprint 0 and link like any other;
a null id never names a component unless all its ids are null; repeated rows
share a component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.llm.common import BROADCAST_ROWS, documents, join_counted, packed, prepare_workers, small, work_dir, write_table

SHINGLE, MAX_BITS, SEED = 3, 3, 42
LIST = 2048
LIMIT = BROADCAST_ROWS          # keys of a join side that may be broadcast whole
CHUNK = 1 << 16


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """``data``: UTF-8 text. bytes.lower and bytes.split know ASCII only, which
    is the contract's case folding and white space."""
    import xxhash
    words = data.lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < shingle:
        return digest(join(words), SEED)
    n = len(words) - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:at + CHUNK + shingle - 1]
        h = np.array([digest(join(s), SEED) for s in zip(*(part[k:] for k in range(shingle)))], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for a in range(0, len(bits), 255):          # sums of up to 255 bits stay in a byte
            ones += bits[a:a + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def text_key(text_col: str = "text"):
    return F.xxhash64(F.col(text_col).cast("string")).alias("text_key")


def fingerprints(df: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (hash of the text), fp (the unsigned fingerprint's bits as a long)."""
    prepare_workers(df.sparkSession)
    src = df.select(F.col(id_col).alias("doc_id"), text_key(text_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("t"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "text_key", "fp"])

    return src.mapInArrow(run, f"doc_id {id_type}, text_key long, fp long")


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of max_bits + 2 blocks of 64 bits; any two fingerprints
    within max_bits agree in at least two of them."""
    n = max_bits + 2
    widths = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def block_lists(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp): every fingerprint under each pair of its blocks."""
    part = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in blocks(max_bits)]
    keys = [F.lit(k) + len(list(combinations(part, 2))) * (F.shiftleft(part[a], 32) + part[b])
            for k, (a, b) in enumerate(combinations(range(len(part)), 2))]
    return nodes.select("fp", F.explode(F.array(*keys)).alias("key"))


def _forest(fps: np.ndarray, max_bits: int):
    """Spanning forest (pairs of positions) of the links among ``fps``."""
    n = len(fps)
    root = np.arange(n)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= max_bits) + i + 1
        for j in near:
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                yield i, j


def _link_lists(max_bits: int):
    def run(batches):
        """Rows sorted by list; a list may go on in the next batch."""
        held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def links(key, sub, fp, last):
            new = np.flatnonzero((key[1:] != key[:-1]) | (sub[1:] != sub[:-1])) + 1
            edges = np.concatenate([[0], new, [len(key)]]) if len(key) else np.array([0])
            ends = edges[1:] if last else edges[1:-1]
            out = []
            begin = 0
            for end in ends:
                if end - begin > 1:
                    own = fp[begin:end].view(np.uint64)
                    out += [(int(fp[begin + i]), int(fp[begin + j])) for i, j in _forest(own, max_bits)]
                begin = end
            return out, begin

        def table(out):
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())],
                                              names=["a", "b"])

        for batch in batches:
            now = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns)]
            out, upto = links(*now, last=False)
            held = tuple(x[upto:] for x in now)
            if out:
                yield table(out)
        out, _ = links(*held, last=True)
        if out:
            yield table(out)
    return run


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, list_size: int = LIST) -> DataFrame:
    """(a, b), a < b: links that connect all fingerprints within ``max_bits`` bits."""
    spark = nodes.sparkSession
    lists = block_lists(nodes, max_bits)
    sizes = write_table(lists.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1),
                        work_dir(spark, "simhash-lists"))
    longs = sizes.where(F.col("n") > list_size).select("key", F.ceil(F.col("n") / list_size).cast("int").alias("subs"))
    shared = sizes.where(F.col("n") <= list_size).select("key", F.lit(1).alias("subs")).unionByName(longs)
    lists = lists.join(shared, "key")                  # a list of one has no link
    own = F.pmod(F.xxhash64("fp"), F.col("subs"))
    # sublist pair (x, y), x <= y, as one number; with one sublist just (0, 0)
    meet = F.transform(F.sequence(F.lit(0), F.col("subs") - 1), lambda o:
                       F.least(own, o.cast("long")) * F.col("subs") + F.greatest(own, o.cast("long")))
    lists = lists.select("key", F.explode(meet).alias("sub"), "fp")
    links = lists.repartition("key", "sub").sortWithinPartitions("key", "sub", "fp") \
                 .mapInArrow(_link_lists(max_bits), "a long, b long")
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def joined(rows: DataFrame, side: DataFrame, key: str, total: int, fits: bool | None = None) -> DataFrame:
    """Inner join of ``rows`` (``total`` of them) with ``side`` (written, one row
    per key, ``n`` counts the key's ``rows``). A side of counted small size is
    broadcast (``fits`` says so where it is known already); of a larger one only
    the keys that hold many rows are, and the others are shuffled."""
    if fits is None:
        fits = small(side, LIMIT) is not side
    return rows.join(F.broadcast(side.drop("n")), key) if fits else join_counted(rows, side, key, total)


def components(links: DataFrame) -> DataFrame:
    """(node, root): smallest node of each component, for every linked node.

    ``links``: distinct (a, b), a < b. A node with very many links fills no task:
    its links are counted map-side, and ``joined`` keeps them where they are."""
    spark = links.sparkSession

    def written(df: DataFrame) -> DataFrame:
        return write_table(df, work_dir(spark, "links"))

    e = written(links)
    while True:
        ends = e.select(F.col("a").alias("u"), F.col("b").alias("v"), F.lit(0).alias("leaf")) \
                .unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v"), F.lit(1).alias("leaf")))
        low = written(ends.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"),
                                            F.sum("leaf").alias("leaf")))
        # done when every node is a root that is no one's leaf, or a leaf with one link
        state = low.agg(F.count_if((F.col("leaf") > 0) & (F.col("n") > 1)).alias("open"),
                        F.count_if(F.col("n") > F.col("leaf")).alias("heads")).first()
        if not state["open"]:
            return low.select(F.col("u").alias("node"), F.col("m").alias("root"))
        # large star: a node's greater neighbours go to the smallest of it and all its neighbours
        heads = low.where(F.col("n") > F.col("leaf")).select(F.col("u").alias("a"), "m", (F.col("n") - F.col("leaf")).alias("n"))
        large = written(joined(e, heads, "a", e.count(), state["heads"] <= LIMIT).select(F.col("m").alias("a"), "b").distinct())
        # small star: a node and its smaller neighbours go to the smallest of these; with one of them nothing moves
        first = written(large.groupBy("b").agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("n")))
        several = first.where(F.col("n") > 1)
        e = written(joined(large, several, "b", large.count(), several.count() <= LIMIT)
                    .select(F.col("m").alias("a"), F.col("a").alias("b")).where(F.col("a") < F.col("b"))
                    .unionByName(first.select(F.col("m").alias("a"), "b")).distinct())


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, text_key, fp, root (of the component) and component_id for every row."""
    spark = df.sparkSession
    docs = write_table(fingerprints(df, shingle, id_col, text_col), work_dir(spark, "fingerprints"))
    nodes = write_table(docs.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")),
                        work_dir(spark, "fingerprint-nodes"))
    roots = components(near_links(nodes.select("fp"), max_bits))
    own = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
               .select("fp", "first", F.col("n").alias("rows"), F.coalesce("root", "fp").alias("root"))
    named = write_table(own, work_dir(spark, "fingerprint-roots"))
    least = write_table(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")),
                        work_dir(spark, "component-ids"))
    names = write_table(joined(named, least, "root", named.count()).select("fp", "root", "component_id", F.col("rows").alias("n")),
                        work_dir(spark, "fingerprint-names"))
    return joined(docs, names, "fp", docs.count()).select("doc_id", "text_key", "fp", "root", "component_id")


def keep_one(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, one of each component: the one with the
    smallest id (null last, then the smallest text hash; of equal rows any)."""
    spark = df.sparkSession
    named = write_table(near_duplicates(df, shingle, max_bits, id_col, text_col), work_dir(spark, "components"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = write_table(named.groupBy("root").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")),
                        work_dir(spark, "firsts"))
    marked = joined(named.select("root", "doc_id", "text_key", key.alias("own")), first, "root", named.count())
    others = write_table(marked.where(~F.col("own").eqNullSafe(F.col("first"))).select("doc_id", "text_key").distinct(),
                         work_dir(spark, "others"))
    again = write_table(marked.where(F.col("own").eqNullSafe(F.col("first"))).groupBy("doc_id", "text_key")
                        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("doc_id", "text_key"),
                        work_dir(spark, "repeated"))
    rows = df.select(packed(df), F.col(id_col).alias("id"), text_key(text_col).alias("key"))
    on = lambda side: F.col("id").eqNullSafe(side["doc_id"]) & (F.col("key") == side["text_key"])
    kept = rows.join(small(others), on(others), "left_anti")
    if again.count():                                  # rows equal in id and text: one of them
        once = kept.join(small(again), on(again), "left_semi").dropDuplicates(["id", "key"])
        kept = kept.join(small(again), on(again), "left_anti").unionByName(once)
    return kept.select("_row.*")


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
