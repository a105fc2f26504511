"""Sheets as folders of CSV files, one for each tab, all text. A remote backend implements the same protocol."""

from __future__ import annotations

import csv
import io
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.sources.files import Folder


class SheetBackend(Protocol):
    def tabs(self, sheet: str) -> list[str]: ...
    def read(self, sheet: str, tab: str) -> DataFrame: ...
    def write(self, sheet: str, tab: str, rows: DataFrame) -> None: ...
    def append(self, sheet: str, tab: str, rows: DataFrame) -> None: ...
    def write_cells(self, sheet: str, tab: str, cells: dict[str, str]) -> None: ...


def cell_position(address: str) -> tuple[int, int]:
    """Row and column from 0 of an address such as AB12."""
    letters = address.rstrip("0123456789")
    n = 0
    for c in letters.upper():
        n = 26 * n + ord(c) - 64
    return int(address[len(letters) :]) - 1, n - 1


class LocalSheets:
    """Tabs are `<folder>/<sheet>/<tab>.csv`. Sheets are what people edit, so a tab fits in the driver; cells are read by Spark."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _place(self, sheet: str) -> Folder:
        return Folder(self.spark, f"{self.folder}/{sheet}")

    def tabs(self, sheet: str) -> list[str]:
        return [n.removesuffix(".gz").removesuffix(".csv") for n in self._place(sheet).names(r".*\.csv(\.gz)?$")]

    def file(self, sheet: str, tab: str) -> str | None:
        """The path of a tab, compressed rather than plain; none if there is neither."""
        return self._place(sheet).first_of(f"{tab}.csv.gz", f"{tab}.csv")

    def snapshot(self, target: str) -> int:
        """Copy every sheet's tabs into a new folder; returns how many tabs there are."""
        sheets_ = Folder(self.spark, self.folder).names(r"^[^.]")
        for sheet in sheets_:
            self._place(sheet).copy(f"{target}/{sheet}")
        return sum(len(self.tabs(s)) for s in sheets_)

    def read(self, sheet: str, tab: str) -> DataFrame:
        """All text, blanks null, a literal NA kept; names as they stand."""
        at = self.file(sheet, tab)
        if at is None:
            raise FileNotFoundError(f"{sheet} has no tab {tab}")
        return self.spark.read.csv(at, header=True, inferSchema=False, multiLine=True, escape='"', nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)

    def _rows(self, sheet: str, tab: str) -> list[list[str]]:
        return list(csv.reader(io.StringIO(self._place(sheet).read_text(f"{tab}.csv"))))

    def _put(self, sheet: str, tab: str, rows: list[list[str]]) -> None:
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(rows)
        place = self._place(sheet)
        place.make()
        if f"{tab}.csv" in place.names():
            Folder(self.spark, f"{self.folder}/{sheet}/{tab}.csv").delete()
        place.write_text(f"{tab}.csv", out.getvalue())

    def write(self, sheet: str, tab: str, rows: DataFrame) -> None:
        text = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])
        self._put(sheet, tab, [list(rows.columns), *[list(r) for r in text.toLocalIterator()]])

    def append(self, sheet: str, tab: str, rows: DataFrame) -> None:
        old = self._rows(sheet, tab)
        new = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("") for c in old[0]])
        self._put(sheet, tab, [*old, *[list(r) for r in new.toLocalIterator()]])

    def write_cells(self, sheet: str, tab: str, cells: dict[str, str]) -> None:
        rows = self._rows(sheet, tab)
        for address, value in cells.items():
            r, c = cell_position(address)
            rows[r][c] = value
        self._put(sheet, tab, rows)
