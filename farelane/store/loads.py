"""Month loads, backfills and the batch build of all layers.

A load takes a set of months through the layers together: one staged write of their files, one silver
slice with the quartiles of all months found in shared passes, one renewal of the gold months they
touch. Where that fails, the months are taken one by one, so that a broken one fails alone.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.model import BOUNDS, BRONZE, CANONICAL, GOLD, SILVER, UNREADABLE, RuleSet, TableSpec, Thresholds
from farelane.operators.quality import silver_quality_score
from farelane.plans import gold
from farelane.plans.silver import month_bounds, silver
from farelane.sources import trips as source
from farelane.store import runlog, tables, views

SLICE = "ingestion_month"


def _new_id(label: str) -> str:
    return f"exec_{datetime.now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class LoadConfig:
    """What a load runs with.

    Database names start with ``namespace``; ``files`` is the template of month files. The clock and the maker of run ids, which is given
    the month, can be set, as a scheduler with logical times does.
    """

    name: str = "trips"
    rules: RuleSet = CANONICAL
    quartiles: str = "exact"
    thresholds: Thresholds = Thresholds()
    namespace: str = ""
    files: str = source.FILE_NAME
    clock: Callable[[], datetime] = datetime.now
    new_id: Callable[[str], str] = _new_id

    def table(self, spec: TableSpec) -> TableSpec:
        return spec.within(self.namespace)


@dataclass
class MonthRun:
    """One month of a load: its id, its counts and its outcome."""

    year: int
    month: int
    execution_id: str
    facts: dict = field(default_factory=dict)
    outcome: dict = field(default_factory=lambda: {"status": "SUCCESS", "stage": "COMPLETED", "error_message": None})

    @property
    def label(self) -> str:
        return source.month_label(self.year, self.month)

    @property
    def is_open(self) -> bool:
        return self.outcome["status"] == "SUCCESS"


class Load:
    """One run over a set of months."""

    def __init__(self, spark: SparkSession, root: str, months: Iterable[source.Month], config: LoadConfig = LoadConfig()):
        self.spark, self.root, self.config = spark, root, config
        self.runs = [MonthRun(y, m, config.new_id(source.month_label(y, m))) for y, m in months]
        self.events: list[tuple] = []

    def event(self, run: MonthRun, level: str, message: str, **details) -> None:
        self.events.append((run.execution_id, self.config.clock(), level, message, {k: str(v) for k, v in details.items()}))

    def stage(self, name: str, action: Callable[[Sequence[MonthRun]], None]) -> None:
        """``action`` over all months still open; if it fails, over each of them alone."""
        runs = [r for r in self.runs if r.is_open]
        if len(runs) > 1:
            events = list(self.events)
            try:
                return action(runs)
            except Exception:
                self.events = events
        for run in runs:
            try:
                action([run])
            except Exception as error:
                self._failed(run, name, error)

    def _failed(self, run: MonthRun, stage: str, error: Exception) -> None:
        run.outcome = {"status": "FAILED", "stage": stage, "error_message": str(error)}
        self.event(run, "ERROR", "load failed", stage=stage)

    def table(self, spec: TableSpec) -> DataFrame:
        return self.spark.table(self.config.table(spec).name)

    def check(self, runs: Sequence[MonthRun]) -> None:
        """Whether each month's file can be read and has a row; the driver waits for several at a time."""

        def look(run: MonthRun) -> None:
            available, path = source.month_is_available(self.spark, self.root, run.year, run.month, self.config.files)
            if not available:
                raise FileNotFoundError(f"no trips for {run.label} at {path}")

        with ThreadPoolExecutor(8) as pool:
            tries = [pool.submit(look, run) for run in runs]
        for run, tried in zip(runs, tries):
            if error := tried.exception():
                self._failed(run, "DATA_CHECK", error)

    def load_bronze(self, runs: Sequence[MonthRun]) -> None:
        """Map-only, so nothing is shuffled: the files become partitions, and their unreadable texts a side table."""
        part = _slice(runs)
        raw = source.raw_months(self.spark, self.root, [(r.year, r.month) for r in runs], self.config.files)
        ids = F.create_map(*[F.lit(x) for r in runs for x in (r.label, r.execution_id)])
        rows = source.union_evolving([source.conformed(r) for r in raw]).withColumns(
            {"ingestion_year": F.substring(SLICE, 1, 4).cast("int"), "processing_execution_id": F.element_at(ids, F.col(SLICE))}
        )
        tables.replace_slice(rows, self.config.table(BRONZE), part, even_files=False)
        self._keep_unreadable(runs, [found for r in raw if (found := source.unreadable_values(r)) is not None], part)
        counts = _by_label(self.table(BRONZE).where(part).groupBy(SLICE).count())
        for run in runs:
            count = run.facts["records_bronze"] = counts.get(run.label, [0])[0]
            if not count:
                self._failed(run, "BRONZE", ValueError(f"the file of {run.label} gave no rows"))
            elif count < self.config.thresholds.min_records_per_file:
                self.event(run, "WARNING", "few records in the file", count=count)

    def _keep_unreadable(self, runs: Sequence[MonthRun], found: list[DataFrame], part: Column) -> None:
        """Replace what the months could not read before by what they cannot read now, and say how much."""
        spec = self.config.table(UNREADABLE)
        if found:
            tables.replace_slice(source.union_evolving(found), spec, part)
        elif self.spark.catalog.tableExists(spec.name):
            tables.replace_slice(self.table(UNREADABLE).limit(0), spec, part)
        if found:
            counts = self.table(UNREADABLE).where(part).groupBy(SLICE, "column_name").count().orderBy(SLICE, "column_name").collect()
            of = {run.label: run for run in runs}
            for label, column, n in counts:
                self.event(of[label], "WARNING", "unreadable values", column=column, count=n)

    def load_silver(self, runs: Sequence[MonthRun]) -> None:
        """Valid trips of the months' files; also remembers which pickup months each of them touches."""
        part = _slice(runs)
        before = self._pickup_months(part)
        write_silver(self.spark, part, self.config)
        after = self._pickup_months(part)
        scores = _by_label(silver_quality_score(self.table(SILVER).where(part), SLICE).select(SLICE, "total_records", "quality_score"))
        for run in runs:
            run.facts["months"] = before.get(run.label, set()) | after.get(run.label, set())
            count, score = scores.get(run.label, (0, 0.0))
            run.facts |= {"records_silver": count, "quality_score": score}
            if score < self.config.thresholds.min_quality_score:
                self.event(run, "WARNING", "quality below the limit", quality_score=score)

    def load_gold(self, runs: Sequence[MonthRun]) -> None:
        """Daily and hourly figures of every pickup month the files touch or touched before, renewed once."""
        months = set().union(*[run.facts["months"] for run in runs])
        days: Counter[source.Month] = Counter()
        if months:
            part = pickup_months(months)
            trips = self.table(SILVER).where(part)
            # All of them carry the id of the load's first month.
            for name, rows in (("daily", gold.daily(trips)), ("hourly", by_month(gold.hourly(trips)))):
                tables.replace_slice(tables.stamped(rows, runs[0].execution_id), self.config.table(GOLD[name]), part)
            counts = self.table(GOLD["daily"]).where(part).groupBy("pickup_year", "pickup_month").count().collect()
            days.update({(year, month): n for year, month, n in counts})
        for run in runs:
            run.facts["records_gold"] = sum(days[m] for m in run.facts["months"])

    def _pickup_months(self, part: Column) -> dict[str, set[source.Month]]:
        spec = self.config.table(SILVER)
        found: dict[str, set[source.Month]] = {}
        if self.spark.catalog.tableExists(spec.name):
            for label, year, month in tables.partitions_of(self.spark, spec, part):
                found.setdefault(label, set()).add((year, month))
        return found

    def run(self) -> list[dict]:
        """All stages, then the log: a row per month. Failures are logged with their stage and not raised."""
        runlog.create_run_log(self.spark, self.config.namespace)
        started = self.config.clock()
        self.stage("DATA_CHECK", self.check)
        self.stage("BRONZE", self.load_bronze)
        self.stage("SILVER", self.load_silver)
        self.stage("GOLD", self.load_gold)
        ended = self.config.clock()
        rows = []
        for run in self.runs:
            run.facts.pop("months", None)
            named = {"execution_id": run.execution_id, "pipeline_name": self.config.name, "start_time": started, "end_time": ended}
            rows.append(named | run.outcome | run.facts)
        runlog.append_runs(self.spark, rows, self.config.namespace)
        runlog.append_events(self.spark, self.events, self.config.namespace)
        views.create_views(self.spark, self.config.namespace)
        return [row | {"year": run.year, "month": run.month} for row, run in zip(rows, self.runs)]


def _slice(runs: Sequence[MonthRun]) -> Column:
    return F.col(SLICE).isin(sorted(r.label for r in runs))


def _by_label(rows: DataFrame) -> dict[str, tuple]:
    """A small result by its first column."""
    return {r[0]: tuple(r)[1:] for r in rows.collect()}


def pickup_months(months: Iterable[tuple[int, int]]) -> Column:
    """Condition on the partition columns of silver, daily and hourly tables."""
    tests = [(F.col("pickup_year") == year) & (F.col("pickup_month") == month) for year, month in sorted(months)]
    return reduce(or_, tests)


def by_month(hourly: DataFrame) -> DataFrame:
    """Hourly rows with the month columns their table is partitioned by."""
    day = F.to_date("trip_date")
    return hourly.withColumns({"pickup_year": F.year(day), "pickup_month": F.month(day)})


def run_month(spark: SparkSession, root: str, year: int, month: int, config: LoadConfig = LoadConfig()) -> dict:
    """Load one month through all layers and log the outcome.

    A stage runs only after the one before it succeeded. A failure is logged
    with its stage and not raised; running the month again repairs it.
    """
    return Load(spark, root, [(year, month)], config).run()[0]


def backfill(
    spark: SparkSession, root: str, first: source.Month, last: source.Month, config: LoadConfig = LoadConfig()
) -> DataFrame:
    """Load a range of months as one; a failing month does not stop the rest. A row per month."""
    runs = Load(spark, root, source.months_between(first, last), config).run()
    columns = "year int, month int, status string, stage string, error_message string"
    return spark.createDataFrame(
        [tuple(run[c] for c in ("year", "month", "status", "stage", "error_message")) for run in runs], columns
    )


def write_silver(spark: SparkSession, part: Column, config: LoadConfig = LoadConfig()) -> None:
    """The silver slice ``part`` (a condition on load months) from bronze, and the bounds its flags were made with.

    Quartiles are those of each load month, found in passes shared by all months, so a
    trip has the same flags whichever way it came into the table.
    """
    bronze = spark.table(config.table(BRONZE).name).where(part)
    bounds = tables.written(month_bounds(bronze, config.rules, config.quartiles), "month-bounds")
    # Bronze files come by load month, which bounds the partitions of a task: nothing is shuffled.
    tables.replace_slice(silver(bronze, bounds, config.rules), config.table(SILVER), part, even_files=False)
    tables.replace_slice(bounds, config.table(BOUNDS), part)


def build_silver(spark: SparkSession, config: LoadConfig = LoadConfig()) -> None:
    """The whole silver table from the whole bronze table, all load months in the same passes."""
    write_silver(spark, F.lit(True), config)


def build_gold(spark: SparkSession, config: LoadConfig = LoadConfig()) -> None:
    """All eight gold tables from the silver table, and the views over them.

    Silver is read five times: daily, time series and financial table share one grouping, route
    and location table another; both are written to the shared folder and read from there.
    """
    trips = spark.table(config.table(SILVER).name)
    days = tables.written(gold.day_parts(trips), "day-parts")
    routes = tables.written(gold.route_parts(trips), "route-parts")
    built = {
        "daily": gold.daily_from(days),
        "hourly": by_month(gold.hourly(trips)),
        "location": gold.location_from(routes),
        "vendor": gold.vendor(trips),
        "payment": gold.payment(trips),
        "time_series": gold.time_series_from(days),
        "route": gold.route_from(routes),
        "financial": gold.financial_from(days),
    }
    for name, rows in built.items():
        tables.save_table(rows, config.table(GOLD[name]))
    views.create_views(spark, config.namespace)
