"""Run a list of named extracts, each to its own targets, with audit.

An ``ExtractSpec`` pairs a builder (a function of the session returning a
lazy DataFrame, or SQL text with bound parameters) with its targets.  For
each spec the runner:

1. builds the DataFrame and attaches an ``Observation`` (row count, new
   high-water mark) so the metrics come from the writing pass;
2. publishes it (first target written, the others copied from it), after
   holding it against an independent control count, where one is given, and
   against the contents of an independent build (``content``);
3. commits its new posting-day mark, where the spec has a mark store;
4. appends an audit row (``Rowcount: n``), or an ``Error`` row and
   re-raises on failure.

Every spec writes its own targets; nothing is collected to the driver
except the scalar metrics.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from closeledger.operators.control import check_reconciled
from closeledger.operators.fingerprint import ContentCheck, check_contents
from closeledger.session import ensure_checkpoint_dir
from closeledger.sinks.audit import AuditLog, observe_extract
from closeledger.sinks.marks import MarkStore
from closeledger.sinks.publish import publish


@dataclass(frozen=True)
class ExtractSpec:
    """``control`` is either a builder of an independent control-count frame
    (column ``row_cnt``), or the name of an earlier spec of the same run
    whose written ``row_cnt`` was observed (``count_column="row_cnt"``).

    With ``mark``, ``build`` also takes the day after which lines are new (the
    committed mark, or None), and the latest ``high_water_column`` becomes the
    next mark once all targets are published."""

    name: str
    build: Callable[..., DataFrame]
    targets: Sequence = field(default_factory=tuple)
    high_water_column: str | None = None
    control: Callable[[SparkSession], DataFrame] | str | None = None
    count_column: str | None = None
    mark: MarkStore | None = None
    content: ContentCheck | None = None

    def __post_init__(self) -> None:
        if self.mark is not None and self.high_water_column is None:
            raise ValueError(f"{self.name}: a mark needs the column it is taken from")

    @staticmethod
    def from_sql(name: str, sql: str, args: Mapping | None = None, **kw) -> ExtractSpec:
        """A spec from SQL text with named parameter markers (``:period``);
        values are bound by Spark, never pasted into the text."""
        bound = dict(args or {})
        return ExtractSpec(name, lambda spark: spark.sql(sql, args=bound), **kw)


@dataclass(frozen=True)
class RunResult:
    name: str
    rows: int
    high_water: dt.date | None
    elapsed_sec: float
    control_rows: int | None = None
    counted: int | None = None  # observed value of ``count_column``

    @property
    def message(self) -> str:
        return f"Rowcount: {self.rows}"


def run_spec(
    spark: SparkSession,
    spec: ExtractSpec,
    audit: AuditLog | None = None,
    earlier: Mapping[str, RunResult] | None = None,
) -> RunResult:
    start = time.monotonic()
    try:
        since = spec.mark.read(spark) if spec.mark is not None else None
        built = spec.build(spark) if since is None else spec.build(spark, since.value)
        control_rows = None
        if isinstance(spec.control, str):
            ref = (earlier or {}).get(spec.control)
            if ref is None or ref.counted is None:
                raise ValueError(f"{spec.name}: control spec {spec.control!r} has not run or counted nothing")
            control_rows = ref.counted
        elif spec.control is not None:
            first = spec.control(spark).select("row_cnt").first()
            control_rows = int(first[0]) if first is not None else 0
        if control_rows is not None or spec.content is not None:
            # reconciled before any target is touched, on the stored result
            ensure_checkpoint_dir(spark)
            built = built.checkpoint(eager=True)
        if control_rows is not None:
            check_reconciled(built.count(), control_rows)
        if spec.content is not None:
            check_contents(built, spec.content.build(spark), spec.content)
        df, obs = observe_extract(built, spec.name, spec.high_water_column, spec.count_column)
        publish(spark, df, spec.targets)
        metrics = obs.get
        rows = int(metrics["rows"])
        counted = metrics.get("counted")
        high_water = metrics.get("high_water")
        if since is not None and high_water is not None:
            spec.mark.commit(spark, since, high_water)
        result = RunResult(
            spec.name, rows, high_water, time.monotonic() - start, control_rows,
            int(counted) if counted is not None else None,
        )
    except Exception as e:
        if audit is not None:
            audit.error(spark, f"{spec.name}: {type(e).__name__}: {e}", cause=e)
        raise
    if audit is not None:
        audit.info(spark, result.message)
        if result.high_water is not None:
            audit.info(spark, f"HighWater: {result.high_water}")
    return result


def run_all(spark: SparkSession, specs: Sequence[ExtractSpec], audit: AuditLog | None = None) -> list[RunResult]:
    """Run the specs in order; the first failure stops the run (after its
    error row is written)."""
    done: dict[str, RunResult] = {}
    results = []
    for s in specs:
        r = run_spec(spark, s, audit, done)
        done[s.name] = r
        results.append(r)
    if audit is not None:
        total = sum(r.rows for r in results)
        elapsed = sum(r.elapsed_sec for r in results)
        audit.info(spark, f"Completed {len(results)} extracts, {total} rows, in {elapsed:.1f}s")
    return results
