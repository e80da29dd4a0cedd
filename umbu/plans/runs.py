"""Runs: read loads, build a table, write it, register it.

Each run takes one load date or many; many are one Spark job, not a loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu import schemas as S
from umbu.fixed_values import MUNICIPALITY_HEADERS
from umbu.functions.dates import load_calendar, load_date
from umbu.operators.joins import fits_broadcast
from umbu.plans import bronze, gold, silver
from umbu.sources import catalog, landing
from umbu.sources.loads import (
    LoadReport,
    days_frame,
    held_loads,
    read_loads,
    write_loads,
    write_version,
)

Dates = str | Sequence[str]


@dataclass(frozen=True)
class Lake:
    """A lake: its root folder and its place in the session's catalog.

    ``prefix`` goes before the database names; ``registered=False`` leaves the
    catalog alone and works on the folders only. ``switched=True`` writes loads to
    folders of their own and then points the catalog at them, so that who reads a
    load by its table never sees half of one; such a lake is read through the
    catalog, and earlier versions stay until they are cleared away.
    """

    spark: SparkSession
    root: str
    prefix: str = ""
    registered: bool = True
    switched: bool = False

    def __post_init__(self) -> None:
        if self.switched and not self.registered:
            raise ValueError("loads are switched in the catalog: registered must be true")

    def create_catalog(self) -> None:
        catalog.create_databases(self.spark, self.root, self.prefix)
        for table in S.TABLES:
            catalog.create_table(self.spark, self.root, table, self.prefix)

    def read(self, table: S.Table, dates: Dates) -> DataFrame:
        if not self.switched:
            return read_loads(self.spark, self.root, table, dates)
        days = [load_date(day) for day in ([dates] if isinstance(dates, str) else dates)]
        if absent := sorted({*days} - self.held(table)):
            raise FileNotFoundError(f"no load {', '.join(absent)} of {table.layer}.{table.name}")
        return self.table(table).where(F.col(S.LOAD_DATE).isin(days))

    def held(self, table: S.Table) -> set[str]:
        """The loads there are of a table."""
        if self.switched:
            return catalog.listed_loads(self.spark, table, self.prefix)
        return held_loads(self.spark, self.root, table)

    def table(self, table: S.Table) -> DataFrame:
        return self.spark.table(catalog.table_name(table, self.prefix))

    def save(
        self,
        df: DataFrame,
        table: S.Table,
        dates: Dates,
        keep_empty: bool = False,
        clustered: bool = False,
    ) -> LoadReport:
        """Write the loads, then add those that were written to the catalog."""
        if self.switched:
            report, folders = write_version(df, self.root, table, dates, keep_empty, clustered)
            catalog.switch_loads(self.spark, table, folders, self.prefix)
            return report
        report = write_loads(df, self.root, table, dates, keep_empty, clustered)
        if self.registered and report.loads:
            catalog.register_loads(self.spark, self.root, table, report.loads, self.prefix)
        return report

    def repair(self) -> None:
        """Let the catalog find every load in the folders of all tables."""
        for table in S.TABLES:
            catalog.repair_table(self.spark, table, self.prefix)

    # Bronze: a folder where CSV files have landed, or a frame of other origin
    def landed(self, raw: str | DataFrame) -> DataFrame:
        return landing.scan_csv(self.spark, raw) if isinstance(raw, str) else raw

    def bronze_rent(self, raw: str | DataFrame, dates: Dates) -> LoadReport:
        out = bronze.bronze_rent(self.landed(raw), dates)
        return self.save(out, S.BRONZE_RENT, dates, keep_empty=True)

    def bronze_basket(
        self, raw: str | DataFrame, dates: Dates, pattern: str | Sequence[str | None] | None = None
    ) -> LoadReport:
        out = bronze.bronze_basket(self.landed(raw), dates, pattern)
        return self.save(out, S.BRONZE_BASKET, dates, keep_empty=True)

    def bronze_population(
        self, uf_sheet: str, municipality_sheet: str, dates: Dates
    ) -> tuple[LoadReport, LoadReport]:
        by_uf = landing.scan_sheet(self.spark, uf_sheet, 2, ["name", "people"])
        by_mun = landing.scan_sheet_columns(
            self.spark, municipality_sheet, 1, dict(MUNICIPALITY_HEADERS)
        )
        return (
            self.save(bronze.bronze_population_uf(by_uf, dates), S.BRONZE_POP_UF, dates, True),
            self.save(bronze.bronze_population_mun(by_mun, dates), S.BRONZE_POP_MUN, dates, True),
        )

    # Silver and gold: rows stay with the files of their load as long as every
    # join broadcasts, so these loads are written where they were read ---------
    def silver_rent(self, dates: Dates, keys: Sequence[str] = ("id",)) -> LoadReport:
        population = self.read(S.BRONZE_POP_MUN, dates)
        towns_fit = fits_broadcast(population)
        out = silver.silver_rent(self.read(S.BRONZE_RENT, dates), population, keys, towns_fit=towns_fit)
        return self.save(out, S.SILVER_RENT, dates, clustered=towns_fit)

    def silver_basket(self, dates: Dates) -> LoadReport:
        population = self.read(S.BRONZE_POP_MUN, dates)
        towns_fit = fits_broadcast(population)
        out = silver.silver_basket(self.read(S.BRONZE_BASKET, dates), population, towns_fit)
        return self.save(out, S.SILVER_BASKET, dates, keep_empty=True, clustered=towns_fit)

    def _lines(self):
        """Bronze source, silver and gold tables, and their runs."""
        return (
            (S.BRONZE_RENT, S.SILVER_RENT, S.GOLD_RENT, self.silver_rent, self.gold_rent),
            (S.BRONZE_BASKET, S.SILVER_BASKET, S.GOLD_BASKET, self.silver_basket, self.gold_basket),
        )

    def backfill(self, first: str, last: str, every: str = "month") -> list[LoadReport]:
        """Silver and gold of every load from the first date to the last that has
        both its bronze loads, each table in one job."""
        calendar = load_calendar(first, last, every)
        reports = []
        for source, _, _, silver_run, gold_run in self._lines():
            there = self.held(source) & self.held(S.BRONZE_POP_MUN)
            if days := [day for day in calendar if day in there]:
                done = silver_run(days)
                reports.append(done)
                if done.loads:
                    reports.append(gold_run(list(done.loads)))
        return reports

    def due(self, calendar: Sequence[str], sources: Sequence[S.Table], target: S.Table) -> list[str]:
        """The dates of which all sources have a load and the target has none."""
        frame = lambda table: days_frame(self.spark, sorted(self.held(table)))
        days = days_frame(self.spark, calendar)
        for source in sources:
            days = days.join(frame(source), "load", "left_semi")
        return sorted(row["load"] for row in days.join(frame(target), "load", "left_anti").collect())

    def catch_up(self, first: str, last: str, every: str = "month") -> list[LoadReport]:
        """Silver and gold of the dates that lack them; loads that are there are not
        written again. A silver load that is new gets its gold load, and so does an old
        one without; each table in one job, and none where nothing is due."""
        calendar = load_calendar(first, last, every)
        reports = []
        for source, middle, target, silver_run, gold_run in self._lines():
            if days := self.due(calendar, [source, S.BRONZE_POP_MUN], middle):
                reports.append(silver_run(days))
            if days := self.due(calendar, [middle], target):
                reports.append(gold_run(days))
        return reports

    def gold_rent(self, dates: Dates) -> LoadReport:
        out = gold.gold_rent(self.read(S.SILVER_RENT, dates))
        return self.save(out, S.GOLD_RENT, dates, clustered=True)

    def gold_basket(self, dates: Dates) -> LoadReport:
        out = gold.gold_basket(self.read(S.SILVER_BASKET, dates))
        return self.save(out, S.GOLD_BASKET, dates)
