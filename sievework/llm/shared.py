"""Tables and folders in the place that driver and executors share, and shuffles of packed arrays.

Edge cases: an empty table is written and read back with its schema; a packed shuffle of no arrays has no rows.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names. Where that is unset and all tasks run on this
    machine, as in tests, in a folder of our own making; elsewhere an unset folder is an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="sievework-"))
        base = _own[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def freed(spark: SparkSession) -> None:
    """Collect garbage in Python, whose handles of the JVM's objects lie in cycles, and then in the driver's JVM: Spark deletes
    the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: its lineage is cut, and it outlives executors.
    Asking for collection of garbage, before and after, lets Spark delete shuffle files that led to this table or an
    earlier one; results don't depend on it."""
    spark = df.sparkSession
    path = folder(spark, name)
    freed(spark)
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def dropped(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written tables that nothing will read again."""
    jvm = spark.sparkContext._jvm
    for table in tables:
        for parent in {f.rpartition("/")[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


PACKED = "part int, arrays array<binary>"


def parts_of(spark: SparkSession, each: int = 4) -> int:
    """Number of parts of a packed shuffle: several to a shuffle partition, so that one part is a small share."""
    return each * int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed(part: np.ndarray, arrays: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each part that occurs: its slice of each array, as bytes. ``part`` is sorted."""
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    ends = np.concatenate([cuts[1:], [len(part)]])
    rows = [[a[s:e].tobytes() for a in arrays] for s, e in zip(cuts.tolist(), ends.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(part[cuts].astype(np.int32)), pa.array(rows, pa.list_(pa.binary()))], ["part", "arrays"])


def by_part(df: DataFrame, reduce: Callable[[int, list[np.ndarray]], Iterator[pa.RecordBatch]], kinds: list, schema: str, most: int = 1 << 22,
            finish: Callable[[], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """Shuffle packed rows by part and give ``reduce`` the number and the arrays of each part, as ``kinds`` of numbers;
    a part of over ``most`` entries comes in pieces, each marked by a third argument that tells whether it is the last.
    ``finish`` gives what a task still holds behind its last part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, count = None, [], 0

        def arrays() -> list[np.ndarray]:
            out = [np.concatenate([np.frombuffer(row[i], k) for row in held]) for i, k in enumerate(kinds)]
            held.clear()
            return out

        for batch in batches:
            column = batch.column("arrays")
            for i, p in enumerate(batch.column("part").to_pylist()):
                row = column[i].as_py()  # one at a time: a batch holds many parts
                if held and p != now:
                    yield from reduce(now, arrays(), True)
                    count = 0
                elif count > most:
                    yield from reduce(now, arrays(), False)
                    count = 0
                now = p
                held.append(row)
                count += len(row[0]) // np.dtype(kinds[0]).itemsize
        if held:
            yield from reduce(now, arrays(), True)
        if finish:
            yield from finish()

    return df.repartition("part").sortWithinPartitions("part").mapInArrow(run, schema)
