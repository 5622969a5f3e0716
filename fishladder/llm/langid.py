"""Language identification by prediction by partial matching (PPM).

For every language one variable-order byte context tree is learned: for each
context of up to ``ORDER`` bytes, how often each byte followed. A text costs,
under a language, the number of bits an arithmetic coder would spend with that
tree: in the longest known context a byte costs -log2 of its share; a byte not
seen there costs an escape (method C: as many escapes as distinct bytes) and is
looked for in the next shorter context, without the bytes already ruled out;
below the empty context all 256 bytes are equally likely. The statistics are
frozen: coding does not change them, so the cost of a text is the same wherever
and whenever it is computed.

The byte stream of a text is its words (runs of letters, lower case, UTF-8),
each ended by a space; contexts reach back to the space before a word and no
further, so the exact cost of a text is the sum of the costs of its words, and
workers keep the costs of words they have met in a bounded cache.

Prediction: the language with the lowest cost; score: its share of 2^(-bits
per byte / ``TEMPERATURE``) among all languages. Texts without a letter are
``und`` with score 0.

The model is fitted on a bounded sample: about ``SAMPLE_ROWS`` labelled rows
per language, chosen by a hash of id and text (each row of a language with n
rows is in with probability SAMPLE_ROWS / n). All words of these rows enter the
trees; (context, next byte) pairs are counted in Spark. Prediction covers all
texts.

Defined cases: null text is ``und``; rows without a label are never learned
from; without any learned language all texts are ``und``; ids may be null or
repeated (a language whose rows all have one id is learned like any other); other columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.llm.common import documents, prepare_workers, small, work_dir, write_table
from fishladder.llm.tokens import worker

ORDER = 4
SAMPLE_ROWS = 600
CACHE_ENTRIES = 300_000
CACHED_LENGTH = 40
CHUNK = 1 << 16
TEMPERATURE = 0.1
REJECT_BITS = 7.0
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


class Tree:
    """Byte context tree of one language."""

    def __init__(self, words: dict[str, int], order: int = ORDER):
        counts: dict[bytes, int] = {}
        for word, n in words.items():
            for g in grams(word, order):
                counts[g] = counts.get(g, 0) + n
        self._fill(counts, order)

    @classmethod
    def of_counts(cls, counts: dict[bytes, int], order: int = ORDER) -> Tree:
        """The tree of counted (context, next byte) strings."""
        tree = cls.__new__(cls)
        tree._fill(counts, order)
        return tree

    def _fill(self, counts: dict[bytes, int], order: int) -> None:
        self.order, self.nodes = order, {}
        for g in sorted(counts):
            self.nodes.setdefault(g[:-1], {})[g[-1]] = counts[g]

    def bits(self, data: bytes, lead: int = 1) -> float:
        """Code length of ``data[lead:]`` in bits."""
        bits, nodes = 0.0, self.nodes
        for i in range(lead, len(data)):
            symbol, ruled_out = data[i], frozenset()
            for k in range(min(self.order, i), -1, -1):
                node = nodes.get(data[i - k:i])
                if node is None:
                    continue
                own = [n for s, n in node.items() if s not in ruled_out]
                total, distinct = sum(own), len(own)
                if not distinct:
                    continue
                n = node.get(symbol)
                if n is not None:
                    bits -= math.log2(n / (total + distinct))
                    break
                bits -= math.log2(distinct / (total + distinct))
                ruled_out = node.keys() | ruled_out
            else:
                bits += math.log2(max(1, 256 - len(ruled_out)))
        return bits


class Costs:
    """Bounded table of known costs: key -> row."""

    def __init__(self, langs: int):
        self.index: dict = {}
        self.table = np.zeros((1024, langs))

    def add(self, key, costs) -> int:
        at = len(self.index)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.index[key] = at
        self.table[at] = costs
        return at

    def trim(self) -> None:
        """Start anew beyond the bound (between uses of row numbers)."""
        if len(self.index) > CACHE_ENTRIES:
            self.index.clear()


class Scorer:
    """Costs of texts under all languages, word by word.

    A byte's cost depends on its context alone, so the costs of (context, byte)
    strings are kept as well, and a new word needs few walks through the trees.
    """

    def __init__(self, trees: dict[str, Tree]):
        self.langs = sorted(trees)
        self.trees = [trees[x] for x in self.langs]
        self.span = max((t.order for t in self.trees), default=0) + 1
        self.bytes, self.words = Costs(len(self.langs)), Costs(len(self.langs))

    def _byte(self, gram: bytes) -> int:
        at = self.bytes.index.get(gram)
        if at is None:
            at = self.bytes.add(gram, [t.bits(gram, len(gram) - 1) for t in self.trees])
        return at

    def _cost(self, word: str) -> np.ndarray:
        data, k, total = b" " + word.encode() + b" ", self.span, np.zeros(len(self.langs))
        for at in range(1, len(data), CHUNK):
            slots = [self._byte(data[max(0, i - k):i]) for i in range(at + 1, min(at + CHUNK, len(data)) + 1)]
            total += self.bytes.table[slots].sum(axis=0)
            self.bytes.trim()
        return total

    def costs(self, text: str) -> tuple[np.ndarray, int] | None:
        """(bits per language, bytes coded); None without a letter."""
        words = _LETTERS.findall(text.lower())
        if not any(c.isalpha() for w in words for c in w):
            return None
        self.words.trim()
        total, slots = np.zeros(len(self.langs)), []
        get = self.words.index.get
        for w in words:
            at = get(w)
            if at is None:
                if len(w) > CACHED_LENGTH:
                    total += self._cost(w)
                    continue
                at = self.words.add(w, self._cost(w))
            slots.append(at)
            if len(slots) >= CHUNK:
                total += self.words.table[slots].sum(axis=0)
                slots.clear()
                self.words.trim()
        if slots:
            total += self.words.table[slots].sum(axis=0)
        return total, len(words) + len("".join(words).encode())

    def predict(self, text: str) -> tuple[str, float, float]:
        """(language, score, bits per byte of the cheapest language)."""
        got = self.costs(text) if text and self.langs else None
        if got is None:
            return UNDETERMINED, 0.0, 0.0
        per_byte = got[0] / got[1]
        share = np.exp2((per_byte.min() - per_byte) / TEMPERATURE)
        best = int(per_byte.argmin())
        return self.langs[best], float(share[best] / share.sum()), float(per_byte[best])


def held_out(id_col="doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang") -> DataFrame:
    """l, t, k: the texts that are learned from, and how many copies of each.

    Equal rows (id, text, label) are counted, and of m copies floor(m * p + u)
    are in, where p is the share of the language's rows that is wanted and u a
    number in [0, 1) from a hash of id and text. So a single row is in with
    probability p, many copies are in by their share, and rows with equal or
    missing ids are chosen apart from each other."""
    spark = docs.sparkSession
    train = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"),
                        F.col(lang_col).cast("string").alias("l")) \
                .where(~held_out("i") & F.col("l").isNotNull() & F.col("t").isNotNull()) \
                .withColumn("key", F.xxhash64("i", "t", "l"))
    counted = write_table(train.groupBy("l", "key").agg(F.count(F.lit(1)).alias("m")), work_dir(spark, "language-rows"))
    per_lang = write_table(counted.groupBy("l").agg(F.sum("m").alias("n")), work_dir(spark, "language-sizes"))
    u = F.pmod(F.xxhash64("key", F.lit(20)), F.lit(1 << 40)) / float(1 << 40)
    share = F.least(F.lit(1.0), F.lit(float(rows)) / F.col("n"))
    chosen = counted.join(small(per_lang), "l").withColumn("k", F.floor(F.col("m") * share + u).cast("long")).where("k > 0")
    chosen = write_table(chosen.select(F.col("l").alias("cl"), F.col("key").alias("ck"), "k"), work_dir(spark, "language-sample"))
    own = train.join(small(chosen), (F.col("l") == F.col("cl")) & (F.col("key") == F.col("ck")))
    return own.groupBy("l", "key", "k").agg(F.first("t").alias("t")).select("l", "t", "k")


def grams(word: str, order: int = ORDER):
    """Every context of up to ``order`` bytes in a word, with the byte after it."""
    data = b" " + word.encode() + b" "
    for i in range(1, len(data)):
        for k in range(min(order, i) + 1):
            yield data[i - k:i + 1]


def gram_counts(docs: DataFrame, order: int = ORDER, **options) -> dict[str, dict[bytes, int]]:
    """{language: {context and next byte: count}} over all words of the sample.

    Counted in Spark, all words; what comes back has a row per language and
    distinct string of at most ``order`` + 1 bytes of the sampled rows."""
    words = sample(docs, **options).select(
        "l", "k", F.explode(F.regexp_extract_all(F.lower("t"), F.lit(r"\p{L}+"), F.lit(0))).alias("w")) \
        .groupBy("l", "w").agg(F.sum("k").alias("c"))

    def expand(batches):
        for b in batches:
            found: dict[tuple, int] = {}
            for lang, word, n in zip(*(c.to_pylist() for c in b.columns)):
                for g in grams(word, order):
                    found[lang, g] = found.get((lang, g), 0) + n
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.string()), pa.array([g for _, g in found], pa.binary()),
                 pa.array(list(found.values()), pa.int64())], names=["l", "g", "n"])

    prepare_workers(docs.sparkSession)
    out: dict[str, dict[bytes, int]] = {}
    for r in words.mapInArrow(expand, "l string, g binary, n long").groupBy("l", "g").agg(F.sum("n").alias("n")).collect():
        out.setdefault(r["l"], {})[bytes(r["g"])] = r["n"]
    return out


def fit(docs: DataFrame, order: int = ORDER, **options) -> dict[str, Tree]:
    """One tree per language of the bounded sample of rows."""
    return {lang: Tree.of_counts(counts, order) for lang, counts in gram_counts(docs, order, **options).items()}


def predict_languages(df: DataFrame, trees: dict[str, Tree], id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """doc_id, lang_pred, score, bits (per byte), and the columns in ``keep``."""
    spark = df.sparkSession
    prepare_workers(spark)
    model, version = spark.sparkContext.broadcast(trees), uuid.uuid4().hex
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scorer = worker("langid", version, lambda: Scorer(model.value))
        for b in batches:
            got = [scorer.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score", "bits"])

    return src.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, bits double")


def known_languages(df: DataFrame, trees: dict[str, Tree], reject_bits: float = REJECT_BITS,
                    text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text is in a learned language:
    not ``und``, and not dearer than ``reject_bits`` per byte under the best."""
    spark = df.sparkSession
    prepare_workers(spark)
    model, version, at = spark.sparkContext.broadcast(trees), uuid.uuid4().hex, df.columns.index(text_col)

    def run(batches):
        scorer = worker("langid", version, lambda: Scorer(model.value))
        for b in batches:
            keep = []
            for t in b.column(at):
                lang, _, bits = scorer.predict(t.as_py())
                keep.append(lang != UNDETERMINED and bits <= reject_bits)
            yield b.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict_languages(docs, fit(docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
