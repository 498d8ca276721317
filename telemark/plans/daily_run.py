"""The daily run: sense a new archive, fetch it, extract its days, keep the books, load them, build all models.

Each stage is a method that can be repeated: what is there already is found and not made again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contract import Contract
from ..functions.quarters import Quarter
from ..operators import bookkeeping
from ..sources.archives import Manifest, RawStore, Transport, extract, fetch, manifest_path
from ..sources.files import write_jsonl
from ..sources.snapshots import Lake
from . import load as loading
from . import models
from .assertions import not_null, unique
from .runner import ModelGraph, Target, backfill, build_gold, next_target, run_stages

# Which readings the models' counters are.
READINGS = {"hours": "smart_9_raw", "realloc": "smart_5_raw", "uncorrect": "smart_187_raw", "timeout": "smart_188_raw", "pending": "smart_197_raw", "offline": "smart_198_raw", "slot_num": "pod_slot_num"}


def as_panel(silver: DataFrame) -> DataFrame:
    """Loaded rows with readings under the models' names; what no day has had is null."""
    return silver.select("date", "serial_number", "model", "capacity_bytes", "failure", *((F.col(c) if c in silver.columns else F.lit(None).cast("bigint")).alias(n) for n, c in READINGS.items()))


def gold_graph(start: str) -> ModelGraph:
    """All models with what each is built from; ``start`` is the first day of the feature table."""
    graph = ModelGraph()
    graph.add("fleet_daily", models.fleet_daily, "panel")
    graph.add("model_daily", models.model_daily, "panel")
    graph.add("dim_model", models.dim_model, "panel", "patterns")
    graph.add("device_quarter", models.device_quarter, "panel")
    graph.add("afr_model_quarter", models.afr_model_quarter, "model_daily", "dim_model", "verdicts")
    graph.add("afr_fleet_quarter", models.afr_fleet_quarter, "device_quarter")
    graph.add("afr_fleet_year", models.afr_fleet_year, "afr_fleet_quarter")
    graph.add("fleet_health", models.fleet_health, "model_daily", "dim_model")
    graph.add("device_failure", models.device_failure, "panel", "dim_model")
    graph.add("survival", models.survival, "panel", "dim_model")
    month = F.date_format("date", "yyyy-MM")
    graph.add("feature_day", lambda panel, dim: models.feature_day(panel, dim, start).withColumn("month", month), "panel", "dim_model", partition_by=("month",))
    return graph


def gold_checks(built: dict[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Rows that break an assertion, by its name."""

    def totals() -> DataFrame:
        days = built["model_daily"].groupBy("date").agg(F.sum("drive_days").alias("drive_days"), F.sum("failures").alias("by_model"))
        return days.join(built["fleet_daily"], "date", "full").filter(~(F.col("drive_days").eqNullSafe(F.col("drives")) & F.col("by_model").eqNullSafe(F.col("failures"))))

    return {
        "models are named once": lambda: unique(built["dim_model"], "model"),
        "models have names": lambda: not_null(built["dim_model"], "model"),
        "a device has a row a quarter": lambda: unique(built["device_quarter"], "year_quarter", "serial_number"),
        "a device fails once": lambda: unique(built["device_failure"], "serial_number"),
        "models add up to the fleet": totals,
    }


@dataclass
class DailyRun:
    spark: SparkSession
    lake: Lake
    store: RawStore
    bronze: Path
    work: Path
    contract: Contract
    transport: Transport
    server: str
    exists: Callable[[str], bool]
    patterns: DataFrame
    tables: str
    start: str = "2013-04-10"

    def latest(self) -> date | None:
        """The last day that is loaded."""
        return self.lake.read(loading.SILVER).agg(F.max("date")).first()[0] if self.lake.exists(loading.SILVER) else None

    def sense(self, state: dict) -> dict:
        target = next_target(self.latest(), self.server, self.exists, state.get("named"))
        return {"target": target, "stop": not target.available}

    def fetch(self, state: dict) -> dict:
        target: Target = state["target"]
        return {"fetched": fetch(self.transport, target.url, self.store, self.work)[0]}

    def extract(self, state: dict) -> dict:
        return {"extracted": extract(self.store, self.bronze, state["target"].quarter.archive, self.contract)[0]}

    def manifests(self) -> list[Manifest]:
        found = [r for r in loading.source_files(self.store, self.bronze) if r["extracted"]]
        return [Manifest.parse(manifest_path(self.bronze, r["source_name"], r["source_sha256"]).read_bytes()) for r in found]

    def days(self) -> DataFrame:
        current = {(r["source_name"], r["source_sha256"]) for r in loading.source_files(self.store, self.bronze) if r["is_current"]}
        return loading.bronze_days(self.spark, self.manifests(), current, self.contract, self.bronze)

    def keep_books(self, state: dict) -> dict:
        """Sources, days and layouts as small tables, rebuilt in full."""
        sources = [json.dumps(r) for r in loading.source_files(self.store, self.bronze)]
        days = self.days()
        headers = [(k, list(v)) for m in self.manifests() for k, v in m.layouts.items()]
        layouts = self.spark.createDataFrame(sorted(dict(headers).items()), "fingerprint string, columns array<string>")
        used = bookkeeping.layouts_used(days.filter("is_current").select("date", F.col("header_fingerprint").alias("fingerprint")), layouts)
        shape = "source_name string, source_sha256 string, is_current boolean, extracted boolean"
        write_jsonl(self.spark.createDataFrame([json.loads(s) for s in sources], shape), f"{self.tables}/source_files")
        write_jsonl(days, f"{self.tables}/bronze_days")
        write_jsonl(used, f"{self.tables}/header_layouts")
        return {"days": days.count()}

    def load(self, state: dict) -> dict:
        quarter: Quarter = state["target"].quarter
        return {"loaded": loading.load(self.spark, self.lake, self.days(), self.contract, quarter.first, quarter.last, f"load_{quarter}")}

    def build(self, state: dict) -> dict:
        inputs = {"panel": as_panel(self.lake.read(loading.SILVER)), "patterns": self.patterns, "verdicts": self.lake.read(loading.VERDICTS)}
        return {"built": sorted(build_gold(gold_graph(self.start), self.spark, f"{self.tables}/gold", inputs, gold_checks))}

    def run(self, named: str | None = None, retries: int = 2, wait: float = 0.0) -> dict:
        stages = [("sense", self.sense), ("fetch", self.fetch), ("extract", self.extract), ("books", self.keep_books), ("load", self.load), ("build", self.build)]
        return run_stages(stages, {"named": named} if named else {}, retries, wait)

    def history(self, first: str, last: str) -> dict:
        """Load all quarters of a range, oldest first; one that fails is noted and the rest goes on. Models are built by the next run."""
        quarters, end = [Quarter.spelled(first)], Quarter.spelled(last)
        while quarters[-1] < end:
            quarters.append(quarters[-1] + 1)
        steps = [("sense", self.sense), ("fetch", self.fetch), ("extract", self.extract), ("books", self.keep_books), ("load", self.load)]
        return backfill([str(q) for q in quarters], lambda named: run_stages(steps, {"named": named}, retries=0))
