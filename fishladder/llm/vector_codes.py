"""Vector codes: every vector as one codebook entry per part (product
quantisation), learned and assigned in whole numbers.

Components become integers floor(scale * x). Vectors are cut into equal parts;
each part position has a codebook of ``entries`` entries, begun with the parts
of the smallest ids and improved in ``rounds`` rounds (assign, then replace by
the floor of the mean). A vector's code names the nearest entry of each part.

The nearest entry is found in the Walsh-Hadamard domain. Parts and entries,
padded with zeros to a power of two P, are transformed by additions and
subtractions alone; the sum of squared differences of the coefficients is P
times the squared distance (Parseval), so every sum over the first
coefficients is a lower bound. Coefficients are added up in sequency order
(slowly changing ones first). After the first one the entry that is best so
far gives a bound; entries beyond it leave, and so on, coefficient by
coefficient. Sums are whole numbers throughout: no rounding, ties go to the
lower entry. Arithmetic is in 64 bits where the largest component allows it,
else in Python's integers.

Work is one scan of the vectors for each round: tasks send sums and counts per
entry (entries x dimensions numbers, whatever the number of rows). Only the
codebooks pass the driver: parts x entries x part length = entries x
dimensions integers, a size set by parameters.

Defined cases: rows whose vector is null, or holds null or non-finite
components or one beyond 62 bits after scaling, are dropped; vectors are padded
with zeros to the longest one, that to a multiple of ``parts``; null ids come
after all others, rows of one id in the order of their vectors (the order only
decides the first codebook); repeated rows each get their code; fewer rows than
entries make smaller codebooks; an error that does not fit 64 bits is null; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fishladder.llm.common import prepare_workers, small, work_dir, write_table
from fishladder.operators.verbs import join_null_safe

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
FITS = 1 << 62
BUFFER_ROWS, BUFFER_CELLS = 8192, 1 << 22


# --- whole-number vectors -----------------------------------------------------------------

def as_integers(column: pa.Array, scale: int, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the rows that take part, their components floor(scale * x)
    as a matrix padded with zeros to ``dims`` columns) of a list column."""
    keep = column.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(keep)
    lists = column.take(pa.array(rows))
    flat = lists.flatten()
    lengths = np.diff(lists.offsets.to_numpy() if len(lists) else np.zeros(1, np.int64))
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)     # null components become NaN
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * scale)
        bad = ~(np.abs(scaled) < FITS)                                   # also NaN and infinity
    owner = np.repeat(np.arange(len(lengths)), lengths)
    good = np.ones(len(lengths), bool)
    good[owner[bad]] = False
    width = int(lengths[good].max(initial=0)) if dims is None else dims
    out = np.zeros((len(lengths), width), np.int64)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    use = good[owner] & (at < width)
    out[owner[use], at[use]] = scaled[use].astype(np.int64)
    return rows[good], out[good]


def walsh_order(size: int) -> np.ndarray:
    """Positions of the coefficients of ``hadamard`` by their number of sign changes."""
    i = np.arange(size)
    signs = 1 - 2 * np.array([[bin(a & b).count("1") & 1 for b in i] for a in i])
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows of ``x`` (a power of two columns) by additions alone."""
    x, half = x.copy(), 1
    while half < x.shape[1]:
        y = x.reshape(len(x), -1, 2, half)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(x.shape)
        half *= 2
    return x


def transformed(x: np.ndarray) -> np.ndarray:
    """Rows padded with zeros to a power of two, transformed, in sequency order."""
    size = 1 << max(0, x.shape[1] - 1).bit_length() if x.shape[1] else 1
    padded = np.zeros((len(x), size), x.dtype)
    padded[:, :x.shape[1]] = x
    return hadamard(padded)[:, walsh_order(size)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the entry nearest to every row; both are
    ``transformed``. Ties go to the lower index."""
    size, every = x.shape[1], np.arange(len(x))
    part = (x[:, :1] - entries[None, :, 0]) ** 2
    best = part.argmin(axis=1)
    bound = ((x - entries[best]) ** 2).sum(axis=1)           # the distance of one entry: none beyond it can be nearest
    row, entry = np.nonzero(part <= bound[:, None])
    sums = part[row, entry]
    for k in range(1, size):
        sums = sums + (x[row, k] - entries[entry, k]) ** 2
        left = sums <= bound[row]
        row, entry, sums = row[left], entry[left], sums[left]
    first = np.searchsorted(row, every)                      # rows are in order, each still has its bounding entry
    least = np.minimum.reduceat(sums, first) if len(x) else sums
    hit = np.flatnonzero(sums == least[row])
    _, at = np.unique(row[hit], return_index=True)           # the lowest index among equals
    return entry[hit[at]], least // size


def arithmetic(largest: int, length: int, dims: int) -> type:
    """64-bit integers where no sum of squares can exceed them, else Python's."""
    size = 1 << max(0, length - 1).bit_length() if length else 1
    return np.int64 if 4 * max(size * size, dims) * largest * largest < FITS else object


class Books:
    """Codebooks of all parts: (parts, entries, part length) integers."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.parts, self.entries, self.length = books.shape
        self.largest = int(np.abs(books).max(initial=0))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry per row and part, squared distance per row and part)."""
        largest = max(self.largest, int(np.abs(x).max(initial=0)))
        kind = arithmetic(largest, self.length, self.parts * self.length)
        x, books = x.astype(kind), self.books.astype(kind)
        found = [nearest(transformed(x[:, p * self.length:(p + 1) * self.length]), transformed(books[p]))
                 for p in range(self.parts)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


# --- jobs -------------------------------------------------------------------------------------

def _buffered(batches, rows: int = BUFFER_ROWS):
    """Arrow batches (with a list column ``v``) joined to about ``rows`` rows, or ``BUFFER_CELLS`` components."""
    kept, n, cells = [], 0, 0
    for b in batches:
        kept.append(b)
        n += b.num_rows
        cells += len(b.column(b.schema.get_field_index("v")).flatten())
        if n >= rows or cells >= BUFFER_CELLS:
            yield pa.Table.from_batches(kept).combine_chunks()
            kept, n, cells = [], 0, 0
    if n:
        yield pa.Table.from_batches(kept).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    c = table.column(name)
    return c.chunk(0) if c.num_chunks else pa.array([], c.type)


def _vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str | None = None) -> DataFrame:
    cols = [F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v")]
    return df.select(*cols, *([F.col(label_col).alias("label")] if label_col else []))


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> tuple[Books | None, int]:
    """(the parts of the ``entries`` smallest ids, length of the longest vector);
    (None, 0) where no row takes part. Every task sends its smallest ids only."""
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def smallest(batches):
        kept, longest = [], -1                          # (id is null, id, components), in order
        for t in _buffered(batches):
            rows, x = as_integers(_column(t, "v"), scale)
            lengths = pc.list_value_length(_column(t, "v")).to_numpy(zero_copy_only=False)[rows].astype(int)
            longest = max(longest, int(lengths.max(initial=-1)))
            found = [(i is None, i, k) for k, i in enumerate(_column(t, "vec_id").take(pa.array(rows)).to_pylist())]
            last = kept[-1][:2] if len(kept) == entries else None
            near = [(n, i, x[k, :lengths[k]].tolist()) for n, i, k in
                    (found if last is None else [f for f in found if _before(f[:2], last)])]
            kept = sorted(kept + near, key=lambda r: (r[0], 0 if r[0] else r[1], r[2]))[:entries]
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] + [i for _, i, _ in kept], vec_type), pa.array([None] + [x for _, _, x in kept], pa.list_(pa.int64())),
             pa.array([longest] * (len(kept) + 1), pa.int32())], names=["vec_id", "x", "longest"])

    vec_type = to_arrow_type(vectors.schema["vec_id"].dataType)
    sent = write_table(vectors.select("vec_id", "v").mapInArrow(smallest, f"vec_id {id_type}, x array<long>, longest int"),
                       work_dir(vectors.sparkSession, "smallest-ids"))
    dims = sent.agg(F.max("longest")).first()[0]
    if dims is None or dims < 0:
        return None, 0
    least = sent.where("x IS NOT NULL").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()  # at most `entries` rows
    length = -(-dims // parts)
    x = np.zeros((len(least), parts * length), np.int64)
    for i, r in enumerate(least):
        x[i, :len(r["x"])] = r["x"]
    return Books(x.reshape(len(least), parts, length).transpose(1, 0, 2)), dims


def _before(one: tuple, last: tuple) -> bool:
    """Whether (id is null, id) can still be among the smallest."""
    return one[0] < last[0] or (one[0] == last[0] and (one[0] or one[1] <= last[1]))


def improved(vectors: DataFrame, books: Books, dims: int, scale: int = SCALE) -> Books:
    """One round: assign all parts, then the floor of every entry's mean."""
    shape = books.books.shape

    def sums(batches):
        total, count = np.zeros(shape, object), np.zeros(shape[:2], np.int64)
        for t in _buffered(batches):
            _, x = as_integers(_column(t, "v"), scale, dims)
            x = np.pad(x, ((0, 0), (0, books.parts * books.length - dims)))
            codes, _ = books.assign(x)
            x = x.reshape(len(x), books.parts, books.length)
            kind = np.int64 if int(np.abs(x).max(initial=0)) * max(1, len(x)) < FITS else object
            for p in range(books.parts):
                part = np.zeros(shape[1:], kind)
                np.add.at(part, codes[:, p], x[:, p].astype(kind))
                total[p] += part
                count[p] += np.bincount(codes[:, p], minlength=shape[1])
        p, e = np.nonzero(count)
        for lo in range(0, len(p), 256):
            some = slice(lo, lo + 256)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(p[some], pa.int32()), "entry": pa.array(e[some], pa.int32()),
                "n": pa.array(count[p[some], e[some]], pa.int64()),
                "sums": pa.array([[str(v) for v in total[a, b]] for a, b in zip(p[some], e[some])], pa.list_(pa.string()))})

    sent = vectors.select("v").mapInArrow(sums, "part int, entry int, n long, sums array<string>")
    one = sent.select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
    found = one.groupBy("part", "entry", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    new = books.books.copy()
    for r in found.collect():          # entries x dimensions rows at most
        new[r["part"], r["entry"], r["at"]] = int(r["s"]) // r["n"]
    return Books(new)


def encoded(vectors: DataFrame, books: Books, dims: int, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code, error of every row that takes part."""
    types = [vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    names = np.array([f"{i:02x}" for i in range(max(1, books.entries))], object)

    def codes(batches):
        for t in _buffered(batches):
            rows, x = as_integers(_column(t, "v"), scale, dims)
            at = pa.array(rows)
            entry, error = books.assign(np.pad(x, ((0, 0), (0, books.parts * books.length - dims))))
            total = [int(e) for e in error.sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [_column(t, "vec_id").take(at), _column(t, "label").take(at),
                 pa.array(["".join(r) for r in names[entry]], pa.string()),
                 pa.array([e if e < 2 * FITS else None for e in total], pa.int64())],
                names=["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "v").mapInArrow(codes, f"vec_id {types[0]}, label {types[1]}, code string, error long")


def learn(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> tuple[Books | None, int]:
    """(codebooks, dimensions) of a table of vec_id and v; None where no row takes part."""
    books, dims = first_books(vectors, parts, entries, scale)
    if books is None:
        return None, 0
    for _ in range(rounds):
        books = improved(vectors, books, dims, scale)
    return books, dims


def vector_codes(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
                 id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error (sum over equal labels), codebooks_sha256."""
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits a part: at most 256 entries")
    spark = df.sparkSession
    prepare_workers(spark)
    vectors = _vectors(df, id_col, vec_col, label_col)
    books, dims = learn(vectors, parts, entries, rounds, scale)
    if books is None:
        books = Books(np.zeros((parts, 1, 0), np.int64))     # no row will be coded
    coded = write_table(encoded(vectors, books, dims, scale), work_dir(spark, "vector-codes"))
    errors = write_table(coded.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error")), work_dir(spark, "label-errors"))
    out = join_null_safe(coded, small(errors), ["label"], "left")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _round_sql(k: int) -> str:
    """One round after book ``k``: nearest entries, then the floors of their means."""
    return f"""
near{k} AS (
  SELECT vec_id, part, entry, error FROM (
    SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i])))::BIGINT AS error,
           row_number() OVER (PARTITION BY p.vec_id, p.part ORDER BY error, b.entry) AS r
    FROM parts p JOIN book{k} b ON p.part = b.part) WHERE r = 1),
"""


OP12_SQL = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS x
  FROM kept, range(16) t(part)),
book0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
""" + "".join(_round_sql(k) + f"""
sums{k} AS (
  SELECT part, entry, pos, sum(c) AS s, count(*) AS n
  FROM (SELECT p.part, n.entry, unnest(p.x) AS c, unnest(range(len(p.x))) AS pos
        FROM parts p JOIN near{k} n ON p.vec_id = n.vec_id AND p.part = n.part)
  GROUP BY part, entry, pos),
means{k} AS (
  SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS x FROM sums{k} GROUP BY part, entry),
book{k + 1} AS (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
  FROM book{k} b LEFT JOIN means{k} m ON b.part = m.part AND b.entry = m.entry),
""" for k in range(ROUNDS)) + _round_sql(ROUNDS) + f"""
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(error)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY vec_id)
SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY k.label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id
"""
