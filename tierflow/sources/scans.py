"""DataFrame scans. Ids: SRC-5, SRC-6, SRC-7, SRC-8, SRC-10, SRC-12, SRC-13."""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.days import Day, in_days, in_window, iso, shifted


#: Hidden from Spark's readers by the underscore.
SCHEMA_NOTE = "_schema.json"
SWAP_NOTE = "_swap-{}.json"
#: Small jobs, of one file footer each, that run beside each other.
_AT_ONCE = 8


def _located(spark: SparkSession, path: str):
    """The Hadoop path and the file system it lives on."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target, target.getFileSystem(conf)


def dataset_exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset has a data file or a partition.

    An empty write leaves a directory that holds neither, and no schema.
    """
    target, files = _located(spark, path)
    if not files.exists(target):
        return False
    if files.getFileStatus(target).isFile():
        return True
    names = [status.getPath().getName() for status in files.listStatus(target)]
    if any(not name.startswith(("_", ".")) for name in names):
        return True
    return bool(staged_days(spark, path))


def read_note(spark: SparkSession, path: str):
    """A JSON note kept beside a dataset under a hidden name, None when absent."""
    target, files = _located(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(
            stream, "UTF-8"
        )
    finally:
        stream.close()
    return json.loads(text)


def write_note(spark: SparkSession, path: str, content) -> None:
    target, files = _located(spark, path)
    stream = files.create(target, True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()


def listed_directories(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition directories so many levels below ``path``, relative to it."""
    target, files = _located(spark, path + "/*=*" * depth)
    leaves = [s.getPath().toString() for s in files.globStatus(target) or []]
    return sorted("/".join(leaf.rstrip("/").split("/")[-depth:]) for leaf in leaves)


def open_swaps(spark: SparkSession, path: str) -> list[dict]:
    """Notes of swaps that are not finished, the oldest first."""
    target, files = _located(spark, f"{path}/{SWAP_NOTE.format('*')}")
    names = [s.getPath().getName() for s in files.globStatus(target) or []]
    notes = [read_note(spark, f"{path}/{name}") | {"name": name} for name in names]
    return sorted(notes, key=lambda note: note["made"])


def staged_days(spark: SparkSession, path: str) -> dict[str, str]:
    """Days of open swaps that still lie staged, with the directory they lie in."""
    found = {}
    for note in open_swaps(spark, path):
        for day in note["days"]:
            staged, files = _located(spark, f"{path}/{note['staged']}/{day}")
            if files.exists(staged):
                found[day] = f"{path}/{note['staged']}"
    return found


def known_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The dataset's schema as its writer noted it, without opening a data file."""
    noted = read_note(spark, f"{path}/{SCHEMA_NOTE}")
    return None if noted is None else T.StructType.fromJson(noted)


def laid_out_by(spark: SparkSession, path: str, column: str) -> bool:
    """Whether the dataset's top directories are values of ``column``."""
    target, files = _located(spark, f"{path}/{column}=*")
    found = files.globStatus(target)
    return found is not None and len(found) > 0


def read_raw(
    spark: SparkSession,
    path: str,
    first: Day | None = None,
    last: Day | None = None,
    days: Iterable[Day] | None = None,
    day_column: str = "date",
) -> DataFrame:
    """Hive-partitioned raw scan, pruned to a day list or an inclusive window.

    The filter sits on the partition column, so other days are never opened.
    A day list takes precedence over the window.  Without the partition column
    the scan is whole: the caller filters on the parsed day instead.
    """
    raw = spark.read.option("basePath", path).parquet(path)
    if day_column not in raw.columns:
        return raw
    if days is not None:
        return raw.filter(in_days(day_column, days))
    return raw.filter(in_window(day_column, first, last))


def read_raw_parts(
    spark: SparkSession,
    path: str,
    first: Day | None = None,
    last: Day | None = None,
    days: Iterable[Day] | None = None,
    day_column: str = "date",
) -> list[DataFrame]:
    """``read_raw`` where the days' files differ in columns and types.

    Each part is a scan with the types of its own files; files that agree but for
    columns some of them lack share one.  Footer schemas are merged over all wanted days,
    which is one Spark job where nothing drifts.  Where they clash, days are grouped by the
    types of one of their files and merged again; a day that clashes in itself is halved by
    its files.
    """
    if not laid_out_by(spark, path, day_column):
        paths = [path]
    else:
        paths = _wanted_directories(spark, path, first, last, days, day_column)
    if not paths:
        return [read_raw(spark, path, first, last, days, day_column)]
    groups: list[tuple[T.StructType, list[str]]] = []
    for schema, some in _agreeing(spark, path, paths):
        for k, (known, held) in enumerate(groups):
            both = _agreed(known, schema)
            if both is not None:
                groups[k] = both, held + some
                break
        else:
            groups.append((schema, some))
    return [
        spark.read.schema(schema).option("basePath", path).parquet(*some)
        for schema, some in groups
    ]


def _wanted_directories(
    spark: SparkSession, path: str, first, last, days, day_column: str
) -> list[str]:
    """Directories of the wanted days; those without a day in their name are read too."""
    listed = None if days is None else {iso(day) for day in days}
    after = None if last is None else shifted(last, 1)

    def wanted(day: str) -> bool:
        if listed is not None:
            return day in listed
        return (first is None or day >= iso(first)) and (after is None or day < after)

    found = listed_directories(spark, path, 1)
    return [
        f"{path}/{name}"
        for name in found
        if name.startswith(f"{day_column}=") and wanted(_value(name))
    ]


def _agreeing(
    spark: SparkSession, root: str, paths: list[str]
) -> Iterable[tuple[T.StructType, list[str]]]:
    """Runs of ``paths`` whose files' schemas merge, with the merged schema."""
    reader = spark.read.option("mergeSchema", True).option("basePath", root)
    try:
        yield reader.parquet(*paths).schema, paths
        return
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # no data file in them
            return
        raise
    except Py4JJavaError as error:
        if "CANNOT_MERGE" not in str(error.java_exception):
            raise
        if len(paths) == 1:
            paths = children(spark, paths[0])
            if len(paths) < 2:
                raise
    for some in _alike(spark, root, paths):
        yield from _agreeing(spark, root, some)


def _alike(spark: SparkSession, root: str, paths: list[str]) -> list[list[str]]:
    """Paths by the schema of one file each; two halves where that tells none apart."""

    def types(path: str) -> str:
        try:
            found = spark.read.option("basePath", root).parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return ""
            raise
        return found.simpleString()

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        seen = list(pool.map(types, paths))
    groups: dict[str, list[str]] = {}
    for kind, path in zip(seen, paths):
        groups.setdefault(kind, []).append(path)
    half = len(paths) // 2
    return list(groups.values()) if len(groups) > 1 else [paths[:half], paths[half:]]


def children(spark: SparkSession, path: str) -> list[str]:
    """What lies in a directory and is not hidden."""
    target, files = _located(spark, path)
    listed = [status.getPath() for status in files.listStatus(target)]
    return sorted(
        p.toString() for p in listed if not p.getName().startswith(("_", "."))
    )


def _agreed(one: T.StructType, other: T.StructType) -> T.StructType | None:
    """Columns of both, None where a column has two types."""
    fields = {f.name: f for f in one.fields}
    for field in other.fields:
        known = fields.setdefault(field.name, field)
        if known.dataType.simpleString() != field.dataType.simpleString():
            return None
    return T.StructType(list(fields.values()))


def read_layer(
    spark: SparkSession,
    path: str,
    first: Day | None = None,
    last: Day | None = None,
    day_column: str = "PartitionDate",
    schema: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Partitioned dataset by path with the day column as ISO text.

    Files written before a column existed lack it.  The schema is the given one, else
    the one the writer noted; only for a dataset without a note are file schemas
    merged, which reads every footer.  Days of an open swap come from where they
    lie staged.
    """
    if schema is None and fmt == "parquet":
        schema = known_schema(spark, path)

    def load(root: str, *paths: str) -> DataFrame:
        reader = spark.read.format(fmt).option("basePath", root)
        if schema is not None:
            reader = reader.schema(schema)
        elif fmt == "parquet":
            reader = reader.option("mergeSchema", True)
        found = reader.load(list(paths) or root)
        return found.withColumn(day_column, F.col(day_column).cast("string"))

    layer = _with_staged(spark, path, day_column, load)
    return layer.filter(in_window(day_column, first, last))


def _with_staged(spark: SparkSession, path: str, day_column: str, load) -> DataFrame:
    """``load(path)`` with the days of open swaps from where they lie."""
    staged = staged_days(spark, path)
    if not staged:
        return load(path)
    parts = []
    target, files = _located(spark, f"{path}/*=*")
    if files.globStatus(target):
        parts.append(load(path).filter(~in_days(day_column, map(_value, staged))))
    for root in sorted(set(staged.values())):
        parts.append(load(root, *[f"{root}/{day}" for day in staged if staged[day] == root]))
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    return whole


def _value(directory: str) -> str:
    """The value of the last level of a partition directory."""
    return directory.rpartition("=")[2]


def partition_files(
    spark: SparkSession, path: str, day_column: str = "PartitionDate"
) -> DataFrame:
    """``(day, name, length)`` of every data file, from the listing alone.

    Days of an open swap are listed where they lie staged.
    """

    def load(root: str, *paths: str) -> DataFrame:
        listing = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("basePath", root)
            .load(list(paths) or root)
        )
        return listing.select(
            F.col(day_column).cast("string").alias("day"),
            F.element_at(F.split("path", "/"), -1).alias("name"),
            "length",
        )

    return _with_staged(spark, path, "day", load).filter(F.col("day").isNotNull())


def partition_inventory(
    spark: SparkSession, path: str, day_column: str = "PartitionDate"
) -> DataFrame:
    """Days present in a dataset with their file count and bytes (INC-4).

    Built from the file listing alone: no data file is opened.
    """
    return (
        partition_files(spark, path, day_column)
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def read_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered lookup file, every column as text, one record per line."""
    return spark.read.csv(path, header=True, multiLine=False, inferSchema=False)


def literal_rows(
    spark: SparkSession, rows: list[dict], schema: T.StructType
) -> DataFrame:
    """A handful of control rows as a plan of literals, in one partition."""
    records = [
        F.struct(
            *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
        )
        for row in rows
    ]
    listed = F.array(*records).cast(T.ArrayType(schema))
    return spark.range(0, 1, 1, 1).select(F.inline(listed))


def optional_column(frame: DataFrame, name: str, dtype: str = "string") -> Column:
    """The named column, or a typed NULL when the frame lacks it."""
    present = name in frame.columns
    return (F.col(name) if present else F.lit(None)).cast(dtype)


def require_columns(frame: DataFrame, names: Iterable[str], what: str) -> None:
    missing = [name for name in names if name not in frame.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")


def preview(frame: DataFrame, order: list[str], rows: int = 10) -> DataFrame:
    """First rows under a stated order, planned as one top-k."""
    return frame.orderBy(*order).limit(rows)
