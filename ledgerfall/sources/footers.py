"""What the files of a table say of their columns.

Files of one table may differ in their columns, which Spark can merge, and in a
column's type, which it refuses.  Then the footers are read by tasks, a row per file
and column, and every kind of file is read in its own types.
"""

import json
import sys
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerfall.schemas import FILE_TYPES, SILVER_COLUMNS, silver_type

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

#: Where Spark keeps its own schema in a footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

# --- Fixed values: names of types in SQL, by those of Spark's stored schemas and of Arrow
SQL_TYPES = {
    "integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint",
    "int32": "int", "int64": "bigint", "int16": "smallint", "int8": "tinyint", "bool": "boolean",
    "large_string": "string", "large_binary": "binary", "date32[day]": "date",
    "timestamp[us, tz=UTC]": "timestamp", "timestamp[us]": "timestamp_ntz", "halffloat": "float",
}


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """A file by Spark's name of it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + unquote(rest).lstrip("/")
    return fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}:{rest}")


def _sql_type(kind: object) -> str:
    name = kind if isinstance(kind, str) else json.dumps(kind)
    return SQL_TYPES.get(name, name.replace("decimal128", "decimal"))


def columns_of(path: str) -> list[tuple[str, str]]:
    """Names and types of a file's columns, from its footer."""
    store, name = _opened(path)
    with store.open_input_file(name) as file:
        schema = pq.read_schema(file)
    told = (schema.metadata or {}).get(SPARK_SCHEMA)
    if told:
        return [(field["name"], _sql_type(field["type"])) for field in json.loads(told)["fields"]]
    return [(field.name, _sql_type(str(field.type))) for field in schema]


def catalogue(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``file, column, type``: a row per column of every Parquet file.

    The files are listed by Spark and their footers read by tasks; nothing else of
    them is.  The folders must be reachable by Arrow as well.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, *column) for path in batch["path"] for column in columns_of(path)]
            yield pd.DataFrame(rows, columns=["file", "column", "type"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders).select("path")
    return files.mapInPandas(run, "file string, column string, type string")


def _same_types(spark: SparkSession, files: list[str], types: dict[str, str], wanted: list[StructField]) -> DataFrame:
    """Files that have each column in the given type, or not at all, in the wanted types."""
    own = ", ".join(f"`{name}` {kind}" for name, kind in types.items())
    rows = spark.read.schema(own).parquet(*files)
    return rows.select(
        *(
            F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name, metadata=field.metadata)
            if field.name in types else F.lit(None).cast(field.dataType).alias(field.name)
            for field in wanted
        )
    )


def _by_kind(spark: SparkSession, folders: list[str]) -> DataFrame:
    """All files, each kind of them in its own types; the number of kinds is that of different footers."""
    kinds = (
        catalogue(spark, folders)
        .groupBy("file")
        .agg(F.sort_array(F.collect_list(F.struct("column", "type"))).alias("columns"))
        .groupBy("columns")
        .agg(F.sort_array(F.collect_list("file")).alias("files"))
        .orderBy("files")
        .collect()
    )
    types: dict[str, list[str]] = {}
    for kind in kinds:
        for name, sql_type in kind["columns"]:
            if sql_type not in types.setdefault(name, []):
                types[name].append(sql_type)
    order = [*(c for c in SILVER_COLUMNS if c in types), *(c for c in types if c not in SILVER_COLUMNS)]
    wanted = []
    for name in order:
        mixed = sorted(types[name]) if len(types[name]) > 1 else []
        target = (silver_type(name) if name in SILVER_COLUMNS else "string") if mixed else types[name][0]
        field = StructType.fromDDL(f"`{name}` {target}")[0]
        wanted.append(StructField(name, field.dataType, True, {FILE_TYPES: mixed} if mixed else {}))
    found = None
    for kind in kinds:
        part = _same_types(spark, kind["files"], {row["column"]: row["type"] for row in kind["columns"]}, wanted)
        found = part if found is None else found.unionByName(part)
    return found


def read_all(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Parquet files with all columns that any of them has.

    Spark merges their schemas if no column changes its type.  If one does, a column is
    read as Silver's type, others as text, and values that do not convert are null.
    """
    try:
        return spark.read.option("mergeSchema", "true").parquet(*folders)
    except Exception as error:  # noqa: BLE001 - Spark reports this one as an error of its JVM
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    return _by_kind(spark, folders)
