"""A table of immutable file sets under numbered versions, for loads that may repeat, race or die.

A load writes its new rows as a file set of its own and then tries to create the next version: a small
text file that lists the batches and file sets of the table. The file is created exclusively, so of
two loads that started from the same version one creates it, and the other looks again at what is
stored by then. Versions follow each other without a gap. Until the version exists nothing of the load can be seen, so a load that dies
leaves only files that no version names. A batch is in a version once, so repeating it adds nothing.

Beside each file set lies an index of its files (`operators.skipping`): the next load opens only files that may
hold one of its keys. File sets without an index for that column and type, such as those of a load by another key, are all opened.

Layout of a root: `data/<batch>-<random>` (Parquet), `keys/<column and type>/<batch>-<random>` (index, Parquet) and
`versions/<number>`. The file system has to refuse creating a file that exists, as HDFS, local disks and
object stores with conditional writes do.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyhouse.operators.keys import known_keys
from tallyhouse.operators.skipping import (
    compared_type,
    files_that_may_hold,
    index_schema,
    indexable,
    write_key_index,
)
from tallyhouse.session import remove, stage

#: Last line of a version file; without it the file is still being written, or its writer died.
END = "end"
ATTEMPTS = 20
#: Seconds that a version file may stay unfinished; writing its few lines takes far less.
GRACE = 60.0


@dataclass(frozen=True)
class Version:
    number: int
    #: (batch, name of its file set) in order of loading.
    batches: tuple[tuple[str, str], ...]


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def _read(spark: SparkSession, path: str) -> list[str]:
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode().split("\n")
    finally:
        stream.close()


def latest(spark: SparkSession, root: str) -> Version:
    """The newest whole version; number 0 without batches before the first load."""
    fs, folder = _file_system(spark, f"{root}/versions")
    if not fs.exists(folder):
        return Version(0, ())
    names = (entry.getPath().getName() for entry in fs.listStatus(folder))
    for number in sorted((int(name) for name in names if name.isdigit()), reverse=True):
        *lines, end = _read(spark, f"{root}/versions/{number}")
        if end == END:
            pairs = (line.split("\t") for line in lines)
            return Version(number, tuple((unquote(batch), files) for batch, files in pairs))
    return Version(0, ())


def _await_writer(spark: SparkSession, root: str, seen: Version) -> Version:
    """The newest version once no version after it is half written; a writer silent for GRACE seconds is dead."""
    until = time.monotonic() + GRACE
    while True:
        fs, target = _file_system(spark, f"{root}/versions/{seen.number + 1}")
        if not fs.exists(target):
            return seen
        newest = latest(spark, root)
        if newest != seen:
            return newest
        if time.monotonic() >= until:
            fs.delete(target, False)
        else:
            time.sleep(min(1.0, GRACE))


def commit(spark: SparkSession, root: str, number: int, batches: tuple[tuple[str, str], ...]) -> bool:
    """Create a version; False if that number is taken."""
    fs, target = _file_system(spark, f"{root}/versions/{number}")
    lines = [f"{quote(batch, safe='')}\t{files}" for batch, files in batches]
    try:
        stream = fs.create(target, False)
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    try:
        stream.write(bytearray("\n".join([*lines, END]).encode()))
    finally:
        stream.close()
    return True


def read_version(spark: SparkSession, root: str, schema: StructType, version: Version | None = None) -> DataFrame:
    """Rows of a version, the newest by default."""
    version = version or latest(spark, root)
    if not version.batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root}/data/{files}" for _, files in version.batches))


def _index_folder(root: str, field: StructField) -> str:
    """Folder of the indexes for a column of a name and type, spelt in hex, as any name is allowed."""
    name = f"{field.name}:{compared_type(field.dataType).simpleString()}"
    return f"{root}/keys/{name.encode().hex()}"


def files_to_open(keys: DataFrame, root: str, version: Version) -> list[str]:
    """Paths of a version that may hold one of the keys (a table of one column).

    Single files where an index tells, whole file sets where none is there. An index is written before the
    version that names its file set, so one that is found is whole.
    """
    spark, field = keys.sparkSession, keys.schema[0]
    fs, folder = _file_system(spark, _index_folder(root, field))
    there = {entry.getPath().getName() for entry in fs.listStatus(folder)} if fs.exists(folder) else set()
    names = [files for _, files in version.batches]
    paths = [f"{root}/data/{files}" for files in names if files not in there]
    indexes = [f"{_index_folder(root, field)}/{files}" for files in names if files in there]
    if indexes:
        index = spark.read.schema(index_schema(field.dataType)).parquet(*indexes)
        paths += [f"{root}/data/{file}" for file in files_that_may_hold(index, keys)]
    return paths


def load_version(df: DataFrame, root: str, batch: str, key: str) -> int:
    """Add the rows of df whose key the table does not hold yet as one batch; return how many went in.

    Rows with a NULL key are left out; repeats of a new key inside the batch all go in. A batch that is
    stored already adds nothing. Where another load comes first, the keys are compared again with what it stored.
    """
    spark = df.sparkSession
    for _ in range(ATTEMPTS):
        seen = _await_writer(spark, root, latest(spark, root))
        if any(batch == stored for stored, _ in seen.batches):
            return 0
        files = f"{quote(batch, safe='')}-{uuid.uuid4().hex}".replace("%", "_")
        loaded = Observation()
        rows = df.filter(F.col(key).isNotNull())
        staged = []
        if seen.batches:
            keys = stage(rows.select(key).distinct(), "batch-keys")
            staged.append(keys.staged_at)
            paths = files_to_open(keys, root, seen)
            if paths:
                known = stage(known_keys(keys, spark.read.schema(df.schema).parquet(*paths), key), "known-keys")
                staged.append(known.staged_at)
                rows = rows.join(known, key, "left_anti")
        rows.observe(loaded, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/data/{files}")
        for path in staged:
            remove(spark, path)
        field = rows.select(key).schema[0]
        index = f"{_index_folder(root, field)}/{files}"
        if indexable(field.dataType):
            written = spark.read.schema(df.schema).parquet(f"{root}/data/{files}")
            write_key_index(written, key, index, f"{files}/")
        if commit(spark, root, seen.number + 1, (*seen.batches, (batch, files))):
            return loaded.get["n"]
        for lost in (index, f"{root}/data/{files}"):
            fs, target = _file_system(spark, lost)
            fs.delete(target, True)
    raise RuntimeError(f"batch {batch} lost against other loads {ATTEMPTS} times")
