"""Token counts by a two-tier lookup on the map side.

Tier 1 is a compact table of frequent pre-tokens and their token counts,
broadcast once: the whole-word entries of the tokenizer's vocabulary in merge
order (a vocabulary lists the most frequent words of the text it was trained
on first), at most ``FREQUENT`` of them, so its size does not depend on the
corpus. Tier 2 is a bounded cache per worker that fills with whatever the
corpus brings. Only pre-tokens missed by both are encoded by the library.
No pre-token ever leaves its task; there is no shuffle at all.

Defined cases: null text counts as empty (0 bytes, 0 tokens); ids may be null
or repeated; other columns of the input are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.llm.common import documents, prepare_workers
from fishladder.llm.tokens import CACHE_ENTRIES, CACHED_LENGTH, Tokens, vocabulary_path, worker

FREQUENT = 1 << 15
LIMIT = 2048


def frequent_table(tokenizer: str, entries: int = FREQUENT) -> tuple[str, bytes]:
    """(words joined by line feeds, one count byte each) for tier 1."""
    tokens = Tokens(tokenizer)
    suffix = tokens.model.end_of_word_suffix
    byte_of = {c: b for b, c in enumerate(tokens.chars)}
    words = []
    for entry, _ in sorted(tokens.library.get_vocab(with_added_tokens=False).items(), key=lambda x: x[1]):
        if not entry.endswith(suffix):
            continue
        try:
            word = bytes(byte_of[c] for c in entry[:-len(suffix)]).decode()
        except (UnicodeDecodeError, KeyError):
            continue
        if tokens.pieces(word) == [word]:
            words.append(word)
            if len(words) == entries:
                break
    return "\n".join(words), bytes(len(tokens.piece_ids(w)) for w in words)


class TwoTier(dict):
    """Tier 1 as the dict itself; misses go to tier 2, then to the library."""

    def __init__(self, tokenizer: str, table: tuple[str, bytes]):
        super().__init__(zip(table[0].split("\n"), table[1]) if table[1] else ())
        self.tokens, self.cache = Tokens(tokenizer), {}

    def __missing__(self, piece: str) -> int:
        n = self.cache.get(piece)
        if n is None:
            n = len(self.tokens.piece_ids(piece))
            if len(piece) <= CACHED_LENGTH:
                if len(self.cache) >= CACHE_ENTRIES:
                    self.cache.clear()
                self.cache[piece] = n
        return n

    def count(self, text: str) -> int:
        pieces = self.tokens.pieces(text)
        if pieces is not None:
            return sum(map(self.__getitem__, pieces))
        n = 0
        for word in self.tokens.words(text):
            pieces = self.tokens.pieces(word)
            n += sum(map(self.__getitem__, pieces)) if pieces is not None else len(self.tokens.word_ids(word))
        return n


def token_counts(df: DataFrame, tokenizer: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for every row."""
    spark = df.sparkSession
    prepare_workers(spark)
    table = spark.sparkContext.broadcast(frequent_table(tokenizer))
    src = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def count(batches):
        tiers = worker("counts", tokenizer, lambda: TwoTier(tokenizer, table.value))
        for b in batches:
            n = [tiers.count(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.cast(pc.binary_length(b.column(1)), pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), vocabulary_path())
