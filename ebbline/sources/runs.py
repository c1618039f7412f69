"""Stored runs: one folder per run below a root, read back all at once.

A run ``prefix`` has ``<root>/<prefix>/record`` (JSON), ``metrics`` and ``best_model_test_metrics`` (CSV). One glob reads the files of a kind
of all runs, and the name of a row's file says of which run it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.operators.comparison import compare_runs
from ebbline.sources import results

RECORD, METRICS, REFIT = "record", "metrics", "best_model_test_metrics"


@dataclass(frozen=True)
class StoredRuns:
    """``prefix`` and the columns of the run records, of the metrics, and of the refitted models' test metrics."""

    records: DataFrame
    metrics: DataFrame
    refits: DataFrame

    def compare(self) -> DataFrame:
        """One row per run: record, best validation model, and test metrics of the refitted model."""
        return compare_runs(self.records, self.metrics, self.refits)


def write_run(root: str, prefix: str, record: DataFrame, metrics: DataFrame, refit: DataFrame) -> None:
    """Store a run; ``metrics`` and ``refit`` may be written by ``train_and_evaluate(output=f"{root}/{prefix}")`` instead."""
    names = [f.name for f in results.METRICS_SCHEMA]
    results.write_record(record, f"{root}/{prefix}/{RECORD}")
    results.write_csv(metrics.select(names), f"{root}/{prefix}/{METRICS}")
    results.write_csv(refit.select(names), f"{root}/{prefix}/{REFIT}")


def _with_prefix(rows: DataFrame, kind: str) -> DataFrame:
    path = F.regexp_extract(F.col("_metadata.file_path"), f"/([^/]+)/{kind}/[^/]+$", 1)
    return rows.select(F.url_decode(F.regexp_replace(path, r"\+", "%2B")).alias("prefix"), "*")


def read_runs(spark: SparkSession, root: str, prefixes: list[str] | None = None) -> StoredRuns:
    """All runs below ``root``, or the named ones. A run that lacks one of its files raises an error, as does a missing one."""
    records = _with_prefix(results.read_record(spark, f"{root}/*/{RECORD}"), RECORD)
    tables = [_with_prefix(results.read_csv(spark, f"{root}/*/{kind}", results.METRICS_SCHEMA), kind) for kind in (METRICS, REFIT)]
    found = [{r.prefix for r in t.select("prefix").distinct().collect()} for t in (records, *tables)]
    wanted = set(prefixes) if prefixes is not None else set.union(*found)
    for kind, names in zip((RECORD, METRICS, REFIT), found):
        if wanted - names:
            raise ValueError(f"runs without {kind}: {sorted(wanted - names)}")
    if prefixes is None:
        return StoredRuns(records, *tables)
    return StoredRuns(*(t.filter(F.col("prefix").isin(*wanted)) for t in (records, *tables)))
