"""The daily load: choose days, read and cast them, remove duplicates, judge, publish."""

from __future__ import annotations

from datetime import date
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contract import Contract
from ..operators import audit
from ..operators.cast import cast_all
from ..operators.dedupe import split, versions
from ..sources.archives import Manifest, RawStore, judge_header
from ..sources.files import scans
from ..sources.snapshots import Lake, Publication, publish

SILVER, QUARANTINE, VERDICTS = "silver", "quarantine", "silver_days"


def select_days(days: DataFrame, first: date, last: date) -> DataFrame:
    """Current days in range that their header doesn't block, in order."""
    chosen = days.filter(F.col("is_current") & F.col("date").between(F.lit(first), F.lit(last)) & (F.col("status") != "blocked"))
    return chosen.orderBy("date")


def source_files(store: RawStore, bronze: Path) -> list[dict]:
    """A row per stored version: current or not, extracted or not. Small: one per archive."""
    rows = []
    for at in sorted((store.root / "sources").glob("*.json")):
        record = store.record(at.stem)
        manifests = {p.stem for p in (bronze / "manifests" / record.source_name).glob("*.json")}
        for sha in sorted(manifests | {record.sha256}):
            rows.append({"source_name": record.source_name, "source_sha256": sha, "is_current": sha == record.sha256, "extracted": sha in manifests})
    return rows


def bronze_days(spark: SparkSession, manifests: list[Manifest], current: set[tuple[str, str]], contract: Contract, bronze: Path) -> DataFrame:
    """A row per day and archive version, judged against the contract of today. Two current sources for a day raise."""
    rows, owner = [], {}
    for m in manifests:
        is_current = (m.source, m.sha256) in current
        for d in m.days:
            if is_current and owner.setdefault(d.date, m.source) != m.source:
                raise ValueError(f"{d.date} is in {owner[d.date]} and in {m.source}, both current")
            status, blocks, warnings = judge_header(list(m.layouts[d.layout]), d.date, d.rows, contract)
            rows.append((d.date, m.source, m.sha256, is_current, status, blocks, warnings + d.file_warnings, d.rows, d.sha256, d.layout, str(bronze / d.key)))
    shape = "date date, source_name string, source_sha256 string, is_current boolean, status string, blocks array<string>, warnings array<string>, row_count long, day_sha256 string, header_fingerprint string, path string"
    return spark.createDataFrame(rows, shape)


def load(spark: SparkSession, lake: Lake, days: DataFrame, contract: Contract, first: date, last: date, run_id: str) -> Publication:
    """Load a range of days. Listed defects are skipped with a verdict of their own; no other day is published unjudged.

    The cast rows feed several aggregates, so they are kept while the load runs; the files behind
    them are gzip text, which would otherwise be parsed once for each.
    """
    chosen = select_days(days, first, last)
    defective = audit.defect_verdicts(chosen, contract.defects) if contract.defects else None
    wanted = chosen.filter(~F.col("date").isin(list(contract.defects))) if contract.defects else chosen
    read = scans(spark, wanted.select("date", "header_fingerprint", "path"))
    if not read:
        return Publication([], [], "")
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    try:
        good, bad = map(hold, cast_all(read, contract))
        told = hold(versions(good))
        kept, conflicts = split(told, good.columns)
        checks = audit.source_checks(days.filter("is_current").select("date", "row_count", "status"), contract.baseline)
        counts = audit.day_counts(told, bad, wanted)
        verdicts = audit.judge_days(checks, counts, contract.limits, audit.warning_counts(kept))
        if defective is not None:
            verdicts = verdicts.unionByName(defective)
        return publish(lake, SILVER, QUARANTINE, VERDICTS, kept, bad.unionByName(conflicts), hold(verdicts), run_id)
    finally:
        for df in held:
            df.unpersist()
