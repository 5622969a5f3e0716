"""Sub-tables of a session: built once, kept as Parquet in the shared folder,
read by every query that needs them.

A sub-table is known by its name, its parameters and the version of its inputs
(every input file's path, length and modification time), so a changed input
gives a new table and an unchanged one is never rebuilt. A lost executor costs
nothing: the table is a file in the folder ``spark.checkpoint.dir`` names. The
two latest versions of a table stay (a running query may read the one before);
``drop_subtables`` removes all tables of a session at its end.
"""

from __future__ import annotations

import hashlib
import threading
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fishladder.session import work_folder

KEEP = 2

_LOCK = threading.RLock()
# application id -> table -> [(version, path, schema)], latest last
_TABLES: dict[str, dict[tuple, list[tuple]]] = defaultdict(lambda: defaultdict(list))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def input_version(spark: SparkSession, paths) -> str:
    """Digest of the files below ``paths``: path, length, modification time."""
    seen = hashlib.sha256()
    for path in ([paths] if isinstance(paths, str) else sorted(paths)):
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            continue
        found, files = fs.listFiles(p, True), []
        while found.hasNext():
            st = found.next()
            files.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
        seen.update(repr(sorted(files)).encode())
    return seen.hexdigest()[:32]


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def kept_subtable(spark: SparkSession, name: str, params: tuple, version: str) -> DataFrame | None:
    """The table ``name(params)`` over inputs of ``version`` if this session has it."""
    with _LOCK:
        kept = _TABLES[spark.sparkContext.applicationId][(name, params)]
        for entry in [e for e in kept if e[0] == version]:
            fs, p = _fs(spark, f"{entry[1]}/_SUCCESS")
            if fs.exists(p):
                return spark.read.schema(entry[2]).parquet(entry[1])
            kept.remove(entry)
        return None


def subtable(spark: SparkSession, name: str, params: tuple, version: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name(params)`` over inputs of ``version``; ``build`` makes it
    where this session does not have it yet (or its folder is gone)."""
    with _LOCK:
        found = kept_subtable(spark, name, params, version)
        if found is not None:
            return found
        kept = _TABLES[spark.sparkContext.applicationId][(name, params)]
        df, path = build(), work_folder(spark, name)
        df.write.parquet(path)
        kept.append((version, path, df.schema))
        for old in kept[:-KEEP]:
            _remove(spark, old[1])
        del kept[:-KEEP]
        return spark.read.schema(df.schema).parquet(path)


def scratch_table(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back; removed by ``drop_subtables``."""
    path = work_folder(spark, name)
    df.write.parquet(path)
    with _LOCK:
        _TABLES[spark.sparkContext.applicationId][(name, path)].append(("", path, df.schema))
    return spark.read.schema(df.schema).parquet(path)


def drop_subtables(spark: SparkSession) -> int:
    """Remove all sub-tables of this session; returns how many there were."""
    with _LOCK:
        tables = _TABLES.pop(spark.sparkContext.applicationId, {})
        paths = [entry[1] for kept in tables.values() for entry in kept]
        for path in paths:
            _remove(spark, path)
        return len(paths)
