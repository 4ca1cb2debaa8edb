"""Where the layers live.  One place for writers and readers."""

from dataclasses import dataclass
from datetime import date

from ledgerfall import vocabulary as V


def day_folders(run_date: date) -> str:
    return f"year={run_date:%Y}/month={run_date:%m}/day={run_date:%d}"


def _of_run(table: str, run: str | None) -> str:
    """A table's folder, or a run's part of it, which readers of the whole table do not see."""
    return f"{table}/_runs/{run}" if run else table


@dataclass(frozen=True)
class Lakehouse:
    """Base paths of the three layers; any file system Spark can reach.

    A day's folder is that of a run, or, without one, where a lake without releases
    has the day's files.
    """

    bronze: str
    silver: str
    gold: str

    def bronze_day(self, run_date: date) -> str:
        return f"{self.bronze}/{day_folders(run_date)}"

    @property
    def silver_table(self) -> str:
        return f"{self.silver}/{V.SILVER_TABLE}"

    def silver_day(self, run_date: date, run: str | None = None) -> str:
        return f"{_of_run(self.silver_table, run)}/{day_folders(run_date)}"

    def gold_table(self, name: str) -> str:
        return f"{self.gold}/{V.GOLD_FOLDER}/{name}"

    def gold_day(self, name: str, run_date: date, run: str | None = None) -> str:
        return f"{_of_run(self.gold_table(name), run)}/run_date={run_date.isoformat()}"

    def report_day(self, run_date: date, run: str | None = None) -> str:
        return f"{_of_run(f'{self.gold}/{V.REPORT_FOLDER}', run)}/{day_folders(run_date)}/{V.REPORT_NAME}"

    def releases_day(self, run_date: date) -> str:
        return f"{self.gold}/_releases/{day_folders(run_date)}"
