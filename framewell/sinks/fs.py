"""Small Hadoop file-system helpers (existence checks, commit markers)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def write_marker(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (atomic create on HDFS / object stores)."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def has_partitions(spark: SparkSession, path: str, column: str) -> bool:
    """True when ``path`` holds at least one ``column=...`` partition folder."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{column}=*")
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def latest_version(spark: SparkSession, folder: str, below: int) -> str | None:
    """Newest ``folder/v=N`` with N < ``below`` (None if there is none)."""
    fs, p = _fs(spark, f"{folder.rstrip('/')}/v=*")
    found = fs.globStatus(p) or []
    best = None
    for st in found:
        name = st.getPath().getName()
        try:
            n = int(name.split("=", 1)[1])
        except ValueError:
            continue
        if n < below and (best is None or n > best):
            best = n
    return None if best is None else f"{folder.rstrip('/')}/v={best}"


def numbered_folders(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers N of the folders ``folder/name=N``, ascending."""
    fs, p = _fs(spark, f"{folder.rstrip('/')}/{name}=*")
    numbers = (st.getPath().getName().split("=", 1)[1] for st in fs.globStatus(p) or [])
    return sorted(int(n) for n in numbers if n.isdigit())


def drop_folders(spark: SparkSession, folder: str, name: str, below: int) -> int:
    """Delete the folders ``folder/name=N`` with N < ``below``; their number."""
    old = [n for n in numbered_folders(spark, folder, name) if n < below]
    for n in old:
        fs, p = _fs(spark, f"{folder.rstrip('/')}/{name}={n}")
        fs.delete(p, True)
    return len(old)
