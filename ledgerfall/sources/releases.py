"""Which runs a day consists of.

A run writes its tables into folders of its own, so nothing that can be read is ever
overwritten.  One published release then says for some tables of the day which run
they are of.  A release is an empty file, and what it says is its name: it is there or not,
never half.  A run that fails has published nothing: readers go on with the release
before, and the run's folders are never looked at.

Finding a day's tables is a listing of one small folder, and no job.  The files are made
and listed through the file systems that the session has.
"""

import re
from collections.abc import Iterable
from datetime import date
from uuid import uuid4

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

from ledgerfall.sources.layout import Lakehouse

#: Number, what it does to the runs before, tables, run.
RELEASE = re.compile(r"(\d+)\.(replace|append)\.([\w+]+)\.(\w+)")


def new_run() -> str:
    return uuid4().hex


def _folder(spark: SparkSession, lake: Lakehouse, run_date: date) -> tuple[JavaObject, JavaObject]:
    path = spark._jvm.org.apache.hadoop.fs.Path(lake.releases_day(run_date))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def history(spark: SparkSession, lake: Lakehouse, run_date: date) -> list[tuple[int, str, bool, list[str]]]:
    """The day's releases in order: number, run, whether it adds to what there is, tables.

    Of releases with one number, published by two runs at a time, the later one is
    that with the larger run.
    """
    store, folder = _folder(spark, lake, run_date)
    if not store.exists(folder):
        return []
    found = (RELEASE.fullmatch(file.getPath().getName()) for file in store.listStatus(folder))
    return sorted((int(m[1]), m[4], m[2] == "append", m[3].split("+")) for m in found if m)


def current(spark: SparkSession, lake: Lakehouse, run_date: date) -> dict[str, list[str]]:
    """The runs that each of the day's tables is made of; a table never released is not in it."""
    runs: dict[str, list[str]] = {}
    for _, run, adds, tables in history(spark, lake, run_date):
        for table in tables:
            runs[table] = [*(runs.get(table, []) if adds else []), run]
    return runs


def publish(spark: SparkSession, lake: Lakehouse, run_date: date, run: str, tables: Iterable[str], adds: bool = False) -> None:
    """From now on the tables are those of the run, all at once; or, if it ``adds``, of it and the runs before."""
    number = max((release[0] for release in history(spark, lake, run_date)), default=0) + 1
    store, folder = _folder(spark, lake, run_date)
    store.mkdirs(folder)
    name = f"{number:08d}.{'append' if adds else 'replace'}.{'+'.join(tables)}.{run}"
    store.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(folder, name))


def superseded(spark: SparkSession, lake: Lakehouse, run_date: date) -> dict[str, list[str]]:
    """Runs that tables were of once and are no longer: whoever runs the lake may delete their folders."""
    now = current(spark, lake, run_date)
    old: dict[str, list[str]] = {}
    for _, run, _, tables in history(spark, lake, run_date):
        for table in tables:
            if run not in now[table] and run not in old.setdefault(table, []):
                old[table].append(run)
    return {table: runs for table, runs in old.items() if runs}
