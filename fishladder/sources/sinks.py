"""Writers for hand-off tables.

A table is a folder of versions. A version is a folder of its own that is never
changed; the table's newest pointer file (``_pointers/<number>.<version>``)
names the current one. A version either holds the whole table or, with a
manifest (``_manifest.json`` in its folder, written before the switch), some
partitions of it: the manifest names for every partition the version that
holds it, with the partition's row count and content hash.

Switching is compare-and-set: a writer remembers the number it started from,
takes the table's commit lock (an exclusively created file, held for a few
metadata calls), looks at the newest number again and only then makes its
pointer. If another writer came between, a whole-table write by a caller that
named what it had read, or an update of a partition the other one changed too,
ends in ``ConflictError`` and leaves the table as it is; updates of different
partitions go on from the newer version. Storage needs an exclusive create
(HDFS and local files have it).

Tables may be bucketed by a key; a reader gets them (and tables whose
partitions lie in several versions) as a catalog table of its session with a
location per partition, so partitions are pruned and joins on the bucket key
need no shuffle.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEEP_VERSIONS = 2       # the current one and the one before, which running readers may still use
LOCK = "commit.lock"
LOCK_WAIT_S, LOCK_STALE_S = 5.0, 600.0
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class ConflictError(RuntimeError):
    """Another writer changed the table (or the same partition) meanwhile."""


# --- files -------------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of the table's pointer files, oldest first."""
    jvm, fs, root = _fs(spark, f"{path.rstrip('/')}/_pointers")
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    # a pointer's name is number.version: complete as soon as it exists
    found = [n.split(".", 1) for n in names if n[:1].isdigit()]
    return sorted((int(n), v) for n, v in found)


def _put(spark: SparkSession, path: str, text: str) -> None:
    _, fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _get(spark: SparkSession, path: str) -> str | None:
    jvm, fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the table's current version; None if there is no table."""
    found = _pointers(spark, path)
    return f"{path.rstrip('/')}/{found[-1][1]}" if found else None


def current_number(spark: SparkSession, path: str) -> int:
    """Number of the table's current version (0: no table), for ``expect``."""
    found = _pointers(spark, path)
    return found[-1][0] if found else 0


def manifest(spark: SparkSession, path: str, version: str | None = None) -> dict | None:
    """Manifest of a version (the current one), None for a plain version."""
    root = path.rstrip("/")
    if version is None:
        found = _pointers(spark, root)
        if not found:
            return None
        version = found[-1][1]
    text = _get(spark, f"{root}/{version}/_manifest.json")
    return None if text is None else json.loads(text)


# --- commit --------------------------------------------------------------------------------

def _locked(spark: SparkSession, root: str):
    """Take the commit lock of a table; returns the function that gives it back."""
    jvm, fs, lock = _fs(spark, f"{root}/_pointers/{LOCK}")
    until = time.monotonic() + LOCK_WAIT_S
    while not fs.createNewFile(lock):
        if fs.exists(lock) and time.time() - fs.getFileStatus(lock).getModificationTime() / 1000.0 > LOCK_STALE_S:
            fs.delete(lock, False)          # its writer died between two metadata calls
        elif time.monotonic() > until:
            raise RuntimeError(f"the commit lock {root}/_pointers/{LOCK} could not be taken")
        else:
            time.sleep(0.1)
    return lambda: fs.delete(lock, False)


def _switch(spark: SparkSession, root: str, version: str, check) -> None:
    """Make ``version`` current; ``check(newest pointers)`` runs under the lock
    and raises where the version must not follow them."""
    release = _locked(spark, root)
    try:
        old = _pointers(spark, root)
        check(old)
        number = old[-1][0] + 1 if old else 1
        jvm, fs, pointer = _fs(spark, f"{root}/_pointers/{number:012d}.{version}")
        if not fs.createNewFile(pointer):
            raise RuntimeError(f"could not make {version} the current version of {root}")
        kept = old[len(old) - (KEEP_VERSIONS - 1):] + [(number, version)]
        used = {v for _, v in kept}
        for _, v in kept:
            used |= {p["version"] for p in ((manifest(spark, root, v) or {}).get("parts") or {}).values()}
        for n, v in old[:len(old) - (KEEP_VERSIONS - 1)]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/_pointers/{n:012d}.{v}"), False)
            held = {v} | {p["version"] for p in ((manifest(spark, root, v) or {}).get("parts") or {}).values()}
            for gone in held - used:
                fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{gone}"), True)
    finally:
        release()


# --- writing ---------------------------------------------------------------------------------

def _write(df: DataFrame, folder: str, by: list[str], bucket_by: str | None, buckets: int | None) -> None:
    if bucket_by:
        # one bucket per task, so a partition has one file per bucket; the name is the session's and goes at once
        spark, name = df.sparkSession, f"write_{uuid.uuid4().hex}"
        out = df.repartition(buckets, bucket_by).write.mode("errorifexists").format("parquet").option("path", folder)
        out = out.partitionBy(*by) if by else out
        try:
            out.bucketBy(buckets, bucket_by).sortBy(bucket_by).saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    elif by:
        df.hint("rebalance", *by).write.mode("errorifexists").partitionBy(*by).parquet(folder)
    else:
        df.write.mode("errorifexists").parquet(folder)


def _partition_dirs(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """``key=value[/key=value]`` folders of a version."""
    jvm, fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    found = [""]
    for _ in range(depth):
        found = [f"{d}/{st.getPath().getName()}".lstrip("/") for d in found
                 for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/{d}" if d else folder))
                 if st.isDirectory() and "=" in st.getPath().getName()]
    return sorted(found)


def _names(by) -> list[str]:
    return [] if by is None else [by] if isinstance(by, str) else list(by)


def _describe(spark: SparkSession, root: str, version: str, schema: StructType, by: list[str], bucket_by, buckets, parts: dict) -> None:
    text = json.dumps({"schema": schema.jsonValue(), "partition_by": by, "bucket_by": bucket_by, "buckets": buckets, "parts": parts})
    _put(spark, f"{root}/{version}/_manifest.json", text)


def write_snapshot(df: DataFrame, path: str, partition_by=None, bucket_by: str | None = None, buckets: int | None = None,
                   expect: int | None = None) -> str:
    """Write a new version of the whole table at ``path`` and make it current.

    There is no moment without a table, nothing is renamed, a job that fails
    before the switch leaves the old version current, and a plan may read the
    table it replaces. ``expect`` (see ``current_number``) is the version the
    caller has read: if the table has moved on, ``ConflictError``. Returns the
    version's folder.

    Rows are dealt out by the partition columns first, so a partition has few
    files; Spark splits a partition that is larger than others (REBALANCE).
    With ``bucket_by`` they are dealt by that key into ``buckets`` buckets (the
    session's shuffle partitions where not given).
    """
    spark = df.sparkSession
    root, by = path.rstrip("/"), _names(partition_by)
    version = f"v-{uuid.uuid4().hex}"
    if bucket_by:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    _write(df, f"{root}/{version}", by, bucket_by, buckets)
    if bucket_by:
        dirs = _partition_dirs(spark, f"{root}/{version}", len(by)) if by else [""]
        _describe(spark, root, version, df.schema, by, bucket_by, buckets, {d: {"version": version} for d in dirs})

    def check(now):
        if expect is not None and (now[-1][0] if now else 0) != expect:
            raise ConflictError(f"{root} is at version {now[-1][0] if now else 0}, not at {expect}")
    _switch(spark, root, version, check)
    return f"{root}/{version}"


def _shape(spark: SparkSession, root: str, version: str | None, df: DataFrame, by: list[str]) -> dict:
    """Manifest of a version; made up for a plain one (or for no table)."""
    if version is None:
        return {"partition_by": by, "bucket_by": None, "buckets": None, "parts": {}}
    found = manifest(spark, root, version)
    if found is None:
        dirs = _partition_dirs(spark, f"{root}/{version}", len(by))
        found = {"partition_by": by, "bucket_by": None, "buckets": None, "parts": {d: {"version": version} for d in dirs}}
    if found["partition_by"] != by:
        raise ValueError(f"{root} is partitioned by {found['partition_by']}, not by {by}")
    return found


def _folder_name(row, by: list[str]) -> str:
    """The folder Spark writes a partition to."""
    escape = "".join(chr(i) for i in range(1, 32)) + '"#%\'*/:=?\\\x7f{[]^'
    name = lambda v: NULL_PARTITION if v is None or v == "" else "".join(f"%{ord(c):02X}" if c in escape else c for c in v)
    return "/".join(f"{c}={name(row[c])}" for c in by)


def fingerprints(df: DataFrame, partition_by) -> dict:
    """Partition folder -> row count and content hash (independent of row order
    and files), in one aggregation. Column order does not matter."""
    by = _names(partition_by)
    rest = sorted(c for c in df.columns if c not in by)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in rest]).cast("decimal(38,0)")
    found = df.groupBy(*[F.col(c).cast("string").alias(c) for c in by]).agg(F.count(F.lit(1)).alias("_n"), F.sum(row).alias("_h"))
    return {_folder_name(r, by): {"rows": r["_n"], "hash": str(r["_h"])} for r in found.collect()}    # a row per partition


def update_partitions(df: DataFrame, path: str, partition_by, only_changed: bool = False, whole: bool = False,
                      covers=None) -> str:
    """Replace the partitions that ``df`` holds, keep all others, in one switch.

    ``only_changed``: a partition whose rows are what the table holds already
    (by count and content hash) is not written again. ``whole``: ``df`` is the
    whole table, so partitions it does not hold go; ``covers``: values of the
    (one) partition column that ``df`` stands for, those without rows go.
    Returns the version's folder.
    """
    spark = df.sparkSession
    root, by = path.rstrip("/"), _names(partition_by)
    start = _pointers(spark, root)
    base = _shape(spark, root, start[-1][1] if start else None, df, by)
    marks = fingerprints(df, by)
    same = {d for d, f in marks.items() if only_changed and d in base["parts"]
            and {k: base["parts"][d].get(k) for k in ("rows", "hash")} == f}
    changed = sorted(set(marks) - same)
    gone = set(base["parts"]) if whole else {_folder_name({by[0]: None if v is None else str(v)}, by) for v in covers or ()}
    gone -= set(marks)
    version = f"v-{uuid.uuid4().hex}"
    if same:
        names = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION)) for c in by]
        wanted = [dict(p.split("=", 1) for p in d.split("/")) for d in changed]
        keep = F.concat_ws("/", *names).isin(["/".join(w[c] for c in by) for w in wanted])
        df = df.where(keep)
    if changed or not base["parts"]:
        _write(df, f"{root}/{version}", by, base["bucket_by"], base["buckets"])
    mine = {d: {"version": version, **marks[d]} for d in changed}

    def merged(parts):
        return {**{d: p for d, p in parts.items() if d not in gone}, **mine}

    def check(now):
        """Under the lock: go on from the newest version, unless it changed what this one changes."""
        if now == start:
            parts = base["parts"]
        else:
            newest = _shape(spark, root, now[-1][1], df, by)
            touched = {d for d in set(newest["parts"]) | set(base["parts"])
                       if newest["parts"].get(d, {}).get("version") != base["parts"].get(d, {}).get("version")}
            if whole or touched & (set(mine) | gone):
                raise ConflictError(f"{root}: {sorted(touched & (set(mine) | gone)) or 'the table'} changed meanwhile")
            parts = newest["parts"]
        _describe(spark, root, version, df.schema, by, base["bucket_by"], base["buckets"], merged(parts))
    _switch(spark, root, version, check)
    return f"{root}/{version}"


# --- reading -------------------------------------------------------------------------------------

def read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The rows of a version, as one table."""
    root = path.rstrip("/")
    found = manifest(spark, root, version)
    if found is None:
        return spark.read.parquet(f"{root}/{version}")
    schema, by = StructType.fromJson(found["schema"]), found["partition_by"]
    name = "t_" + hashlib.sha256(f"{root}/{version}".encode()).hexdigest()[:32]
    if not spark.catalog.tableExists(name):
        quoted = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        sql = f"CREATE TABLE {name} ({quoted}) USING parquet"
        if by:
            sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in by) + ")"
        if found["bucket_by"]:
            sql += f" CLUSTERED BY (`{found['bucket_by']}`) SORTED BY (`{found['bucket_by']}`) INTO {found['buckets']} BUCKETS"
        spark.sql(f"{sql} LOCATION '{root}/{version}'")
        parts = sorted(found["parts"].items()) if by else []
        for at in range(0, len(parts), 500):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(
                f"PARTITION ({_spec(d)}) LOCATION '{root}/{p['version']}/{d}'" for d, p in parts[at:at + 500]))
    return spark.table(name)


def _spec(folder: str) -> str:
    from urllib.parse import unquote
    pairs = [p.split("=", 1) for p in folder.split("/")]
    value = lambda v: "NULL" if v == NULL_PARTITION else "'" + unquote(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ", ".join(f"`{c}` = {value(v)}" for c, v in pairs)
