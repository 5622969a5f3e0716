"""Token-id output: length-delimited binary records with an offset index.

One record file per task, in ascending id order across and inside files::

    uint64 length | uint32 masked checksum of those 8 bytes
    payload       | uint32 masked checksum of the payload

payload = ``<BBq`` (width of an id in bytes, 1 if the document has an id,
document id) followed by the token ids, little-endian, 2 bytes each where the
vocabulary fits, else 4. A masked checksum is CRC-32 rotated right by 15 bits
plus 0xA282EAD8, so that checksums of data that holds checksums stay sound
(the environment has no CRC-32C; the framing is otherwise the common one).

Next to each record file stands an index file of fixed 21-byte entries
(document id, 1 if present, offset, length), so a reader can fetch records in
any order without scanning. Files get unique names; a manifest table, written
by Spark's own commit protocol after all tasks ended, lists those that count.
A task that is repeated or runs twice therefore leaves at most an unlisted
file, never a double record.

Defined cases: null text is written as an empty text (only the end id); a
null id sorts first and is read back as null; rows with equal ids stay, in
text-hash order; an empty table gives an empty manifest; other columns of the
input are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fishladder.llm.common import documents, prepare_workers, qualified, work_dir, write_table
from fishladder.llm.tokens import IdBytes, Tokens, vocabulary_path, worker

END_ID = 2
# struct formats: record head, payload head, checksum, index entry
HEAD, PAYLOAD, CHECK, INDEX = "<QI", "<BBq", "<I", "<qBQI"
HEAD_SIZE, PAYLOAD_SIZE, CHECK_SIZE, INDEX_SIZE = map(struct.calcsize, (HEAD, PAYLOAD, CHECK, INDEX))
MASK_DELTA = 0xA282EAD8
BUFFER = 4 << 20

MANIFEST = "pid int, rec string, idx string, n_records long, n_tokens long, n_bytes long"


def masked(data) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    n = len(payload).to_bytes(8, "little")
    return b"".join((struct.pack(HEAD, len(payload), masked(n)), payload, struct.pack(CHECK, masked(payload))))


def _open(uri: str):
    import pyarrow.fs as pafs
    return pafs.FileSystem.from_uri(uri)


def _id_type(path: str, end_id: int) -> str:
    from tokenizers import Tokenizer
    size = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    return "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"


def write_records(df: DataFrame, out_dir: str, tokenizer: str, end_id: int = END_ID,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode the texts, write record and index files, return the manifest."""
    spark = df.sparkSession
    prepare_workers(spark)
    out_dir = qualified(spark, out_dir)
    dtype = _id_type(tokenizer, end_id)
    end = np.array([end_id], dtype=dtype).tobytes()
    width = np.dtype(dtype).itemsize

    def write(batches):
        enc = worker("ids", (tokenizer, dtype), lambda: IdBytes(Tokens(tokenizer), dtype))
        fs = rec = idx = None
        at = tokens = records = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rec is None:
                fs, base = _open(out_dir)
                fs.create_dir(base, recursive=True)
                name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
                rec = fs.open_output_stream(f"{base}/{name}.rec", buffer_size=BUFFER)
                idx = fs.open_output_stream(f"{base}/{name}.idx", buffer_size=BUFFER >> 4)
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, text = doc_id.as_py(), text.as_py()
                ids = enc.encode(text or "") + end
                has = doc_id is not None
                record = frame(struct.pack(PAYLOAD, width, has, doc_id or 0) + ids)
                rec.write(record)
                idx.write(struct.pack(INDEX, doc_id or 0, has, at, len(record)))
                at += len(record)
                tokens += len(ids) // width
                records += 1
        if rec is not None:
            rec.close()
            idx.close()
            yield pa.RecordBatch.from_pydict(
                {"pid": pa.array([TaskContext.get().partitionId()], pa.int32()), "rec": [f"{name}.rec"],
                 "idx": [f"{name}.idx"], "n_records": [records], "n_tokens": [tokens], "n_bytes": [at]})

    src = df.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    tie = F.xxhash64("t")
    ordered = src.repartitionByRange(F.col("i").asc_nulls_first(), tie) \
                 .sortWithinPartitions(F.col("i").asc_nulls_first(), tie)
    return write_table(ordered.mapInArrow(write, MANIFEST), f"{out_dir}/manifest")


def _records(source):
    """(has id, id, id bytes, width) of each record of a stream; checks both sums."""
    while head := source.read(HEAD_SIZE):
        size, check = struct.unpack(HEAD, head)
        if masked(head[:8]) != check:
            raise ValueError("record length does not match its checksum")
        payload = source.read(size)
        if len(payload) != size or masked(payload) != struct.unpack(CHECK, source.read(CHECK_SIZE))[0]:
            raise ValueError("record does not match its checksum")
        width, has, doc_id = struct.unpack_from(PAYLOAD, payload)
        yield has, doc_id, payload[PAYLOAD_SIZE:], width


def _manifest(spark: SparkSession, out_dir: str) -> tuple[DataFrame, int]:
    m = spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")
    return m, m.count()


def read_records(spark: SparkSession, out_dir: str, digests: bool = False) -> DataFrame:
    """All records in file order: doc_id, start (ids before it), n_tokens and
    the ids, or with ``digests`` their CRC-32 as unsigned 32-bit integers.

    One task reads one file; the order of the files is in the manifest, whose
    running sum (one row per file) gives each file its first token position.
    """
    out_dir = qualified(spark, out_dir)
    m, n = _manifest(spark, out_dir)
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    files = m.select("pid", "rec", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    last = ("ids_crc32", pa.int64(), "long") if digests else ("ids", pa.list_(pa.int32()), "array<int>")

    def read(batches):
        fs, base = _open(out_dir)
        for batch in batches:
            for rec, first in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{rec}", buffer_size=BUFFER) as source:
                    for has, doc_id, ids, width in _records(source):
                        ids = np.frombuffer(ids, dtype=f"<u{width}").astype("<u4")
                        rows.append((doc_id if has else None, first, len(ids),
                                     zlib.crc32(ids.tobytes()) if digests else ids.astype(np.int32)))
                        first += len(ids)
                        held += 1 if digests else len(ids)
                        if len(rows) >= 8192 or held >= 1 << 20:
                            yield _digest_batch(rows, last)
                            rows, held = [], 0
                if rows:
                    yield _digest_batch(rows, last)

    schema = f"doc_id long, start long, n_tokens long, {last[0]} {last[2]}"
    return files.repartitionByRange(max(1, n), "pid").mapInArrow(read, schema)


def _digest_batch(rows, last) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
         pa.array(cols[3], last[1])], names=["doc_id", "start", "n_tokens", last[0]])


def read_shuffled(spark: SparkSession, out_dir: str, seed: int) -> DataFrame:
    """Records in a random order fixed by ``seed``, fetched through the index.

    The index entries (no payload) are ordered by a hash of seed, file and
    offset; each task then reads its records at their offsets.
    Output: position is the partition order; doc_id, ids.
    """
    out_dir = qualified(spark, out_dir)
    m, n = _manifest(spark, out_dir)

    def entries(batches):
        fs, base = _open(out_dir)
        for batch in batches:
            for rec, idx in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_stream(f"{base}/{idx}") as source:
                    while data := source.read(INDEX_SIZE * 65536):
                        e = list(struct.iter_unpack(INDEX, data))
                        yield pa.RecordBatch.from_pydict({"rec": [rec] * len(e), "at": pa.array([x[2] for x in e], pa.int64()),
                                                          "size": pa.array([x[3] for x in e], pa.int64())})

    def fetch(batches):
        import io
        fs, base = _open(out_dir)
        open_files = {}
        for batch in batches:
            rows = []
            for rec, at, size in zip(*(c.to_pylist() for c in batch.columns[:3])):
                if rec not in open_files:
                    if len(open_files) >= 64:
                        open_files.pop(next(iter(open_files))).close()
                    open_files[rec] = fs.open_input_file(f"{base}/{rec}")
                data = open_files[rec].read_at(size, at)
                (has, doc_id, ids, width), = _records(io.BytesIO(data))
                rows.append((doc_id if has else None, np.frombuffer(ids, dtype=f"<u{width}").astype(np.int32)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                                  pa.array([r[1] for r in rows], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    idx = m.select("pid", "rec", "idx").repartitionByRange(max(1, n), "pid").select("rec", "idx") \
           .mapInArrow(entries, "rec string, at long, size long")
    key = F.xxhash64(F.lit(seed), "rec", "at")
    return idx.repartitionByRange(key, "rec", "at").sortWithinPartitions(key, "rec", "at") \
              .mapInArrow(fetch, "doc_id long, ids array<int>")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as records, read the files back, one row each."""
    return token_records(spark, documents(spark, sf_dir))


def token_records(spark: SparkSession, docs: DataFrame) -> DataFrame:
    out = work_dir(spark, "token-records")
    write_records(docs, out, vocabulary_path())
    return read_records(spark, out, digests=True)
