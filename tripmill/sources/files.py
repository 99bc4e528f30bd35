"""Parquet files whose schemas drift.

One ``mergeSchema`` read fails as soon as a column is bigint in one file and double in another.
Here files are grouped by schema, each group is one multi-path scan, and the groups are united by
name. A plan has as many branches as there are distinct schemas, not files, and paths are given as
they came: a folder or glob of one layout is never spelled out file by file.
"""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators.normalize import clean_trips, convert, normalize_trips
from tripmill.schema import RAW_NAMES, TRIPS

SchemaGroup = tuple[T.StructType, list[str]]
# Where a raw row lies: its file, and its place in it.
FILE, PLACE = "file_path", "row_index"


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Scan one path or glob of files that share a schema."""
    return spark.read.parquet(path)


def _reader(spark: SparkSession, schema: T.StructType | str) -> DataFrameReader:
    """Reads all files below its paths; names of folders are no columns."""
    return spark.read.schema(schema).option("recursiveFileLookup", True)


def list_files(spark: SparkSession, *patterns: str) -> list[str]:
    """Sorted data files at or below paths or globs, on any storage Spark can read.

    The dummy schema keeps Spark from opening a file: this only lists. No match is an error.
    """
    try:
        files = _reader(spark, "unread string").parquet(*patterns).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = []
    if not files:
        raise FileNotFoundError(f"no parquet input under {', '.join(patterns)}")
    return sorted(unquote(file) for file in files)


def merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The schema under which all files of some paths can be read, or None if their types conflict.

    One distributed job reads the footers, and columns that only some files have are no conflict.
    """
    try:
        reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
        return reader.parquet(*paths).schema
    except (Py4JJavaError, PySparkException) as error:
        text = str(error)
        if "PATH_NOT_FOUND" in text or "UNABLE_TO_INFER_SCHEMA" in text:
            raise FileNotFoundError(f"no parquet input under {', '.join(paths)}") from error
        if "CANNOT_MERGE_SCHEMAS" not in text:
            raise
        return None


def united(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """Both schemas as one, or None if a column's types differ. Case and order do not matter."""
    fields = {f.name.lower(): f for f in a.fields}
    for field in b.fields:
        if fields.setdefault(field.name.lower(), field).dataType != field.dataType:
            return None
    return T.StructType(list(fields.values()))


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[SchemaGroup]:
    """Group paths (files, folders or globs) by schema. Column order does not matter: Parquet is
    read by name.

    All paths are tried as one group first, so a single layout takes one job whatever the number of
    files and folders. Only on a conflict are paths split: the sorted list is halved until every
    part is of one layout, which takes jobs by the number of layout changes. A path whose own files
    conflict is replaced by the folders below it, and a folder by its files.
    """
    found: list[SchemaGroup] = []

    def settle(part: list[str]) -> None:
        schema = merged_schema(spark, part)
        if schema is not None:
            found.append((schema, part))
            return
        if len(part) == 1:
            part = _inside(spark, part[0])
        half = len(part) // 2
        settle(part[:half])
        settle(part[half:])

    settle(sorted(paths))
    groups: list[SchemaGroup] = []
    for schema, part in found:
        for k, (own, members) in enumerate(groups):
            if (both := united(own, schema)) is not None:
                groups[k] = (both, members + part)
                break
        else:
            groups.append((schema, list(part)))
    return groups


def _inside(spark: SparkSession, path: str) -> list[str]:
    """The folders of the files below a path, or the files of a single folder."""
    files = list_files(spark, path)
    folders = sorted({file.rpartition("/")[0] for file in files})
    # A folder that holds another one would be read with it.
    nested = any(b.startswith(a + "/") for a, b in zip(folders, folders[1:]))
    return files if len(folders) == 1 or nested else folders


def read_group(spark: SparkSession, group: SchemaGroup, with_place: bool = False) -> DataFrame:
    """One scan over all files of a schema group, optionally with each row's ``FILE`` and ``PLACE``."""
    schema, paths = group
    df = _reader(spark, schema).parquet(*paths)
    return df.select("*", f"_metadata.{FILE}", f"_metadata.{PLACE}") if with_place else df


def count_files(spark: SparkSession, groups: Sequence[SchemaGroup]) -> int:
    """How many files lie below the paths of the groups; their names stay where they are listed."""
    return sum(len(_reader(spark, schema).parquet(*paths)._jdf.inputFiles()) for schema, paths in groups)


def _raw_types() -> dict[str, T.DataType]:
    """Agreed type of every known raw spelling, in lower case."""
    return {
        spelling.lower(): TRIPS[name].dataType
        for name, spellings in RAW_NAMES.items()
        for spelling in spellings
    }


def align_types(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """Give drifting columns one type per name before a union.

    Known trip columns take their canonical type. Any other column whose types differ and are not
    all numeric becomes text, so that a union never has to parse text.
    """
    agreed = _raw_types()
    seen: dict[str, set[T.DataType]] = {}
    for df in frames:
        for field in df.schema.fields:
            seen.setdefault(field.name.lower(), set()).add(field.dataType)
    for name, types in seen.items():
        numeric = all(isinstance(t, T.NumericType) for t in types)
        if name not in agreed and len(types) > 1 and not numeric:
            agreed[name] = T.StringType()

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(
            [
                convert(F.col(f"`{f.name}`"), f.dataType, agreed[f.name.lower()]).alias(f.name)
                if f.dataType != agreed.get(f.name.lower(), f.dataType)
                else F.col(f"`{f.name}`")
                for f in df.schema.fields
            ]
        )

    return [aligned(df) for df in frames]


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union raw frames by name; columns a frame lacks are null, numbers widen."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), align_types(frames))


def read_raw(spark: SparkSession, paths: Sequence[str], with_place: bool = False) -> DataFrame:
    """Raw rows of drifting files, united by name."""
    groups = schema_groups(spark, paths)
    return union_by_name([read_group(spark, group, with_place) for group in groups])


def read_trips(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Clean canonical trips of drifting files.

    Every schema group is normalized before the union, so each scan reads only the columns that
    its own spelling of the trip columns needs.
    """
    groups = schema_groups(spark, paths)
    parts = [normalize_trips(read_group(spark, group)) for group in groups]
    return clean_trips(reduce(DataFrame.unionByName, parts))


def placed_trips(spark: SparkSession, groups: Sequence[SchemaGroup]) -> DataFrame:
    """The same with the ``FILE`` and ``PLACE`` of each trip."""

    def part(group: SchemaGroup) -> DataFrame:
        raw = read_group(spark, group, with_place=True)
        return normalize_trips(raw, keep=(FILE, PLACE))

    return clean_trips(reduce(DataFrame.unionByName, map(part, groups)))


@contextmanager
def external_view(spark: SparkSession, name: str, path: str) -> Iterator[DataFrame]:
    """A temporary SQL view over files, without loading them, for the length of a block.

    The view is dropped when the block ends, on errors too; a view that had the name before is an
    error, so that none is lost. Frames made inside the block stay valid after it.
    """
    if spark.catalog.tableExists(name):
        raise ValueError(f"{name} exists already")
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TEMPORARY VIEW `{name}` USING parquet OPTIONS (path '{quoted}')")
    try:
        yield spark.table(name)
    finally:
        spark.catalog.dropTempView(name)
