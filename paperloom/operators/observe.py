"""Traces, tickets, budgets and service levels."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.model import TRACES

OBS_SLO = {"p95_ms": 30000.0, "error_rate": 0.05, "cost_per_request": 0.05}
API_SLO = {"p95_ms": 5000.0, "error_rate": 0.02, "cost_per_request": 0.05}
BUSINESS_GATE = {"min_adoption_rate": 0.40, "max_cost_per_ticket": 0.50}


def spans(traces: DataFrame) -> DataFrame:
    return traces.select("trace_id", "doc_id", F.explode("spans").alias("s")).select("trace_id", "doc_id", "s.*")


def stage_metrics(spans: DataFrame) -> DataFrame:
    """name, count, p50_ms, p95_ms (linear interpolation), error_rate per stage."""
    return spans.groupBy("name").agg(F.count("*").alias("count"), F.percentile("duration_ms", F.lit(0.5)).alias("p50_ms"), F.percentile("duration_ms", F.lit(0.95)).alias("p95_ms"), F.avg((F.col("status") != "ok").cast("double")).alias("error_rate"))


def trace_metrics(traces: DataFrame) -> DataFrame:
    """n_traces, error_rate (a trace fails if any span does), cost_per_request, total_tokens."""
    bad = F.exists("spans", lambda s: s["status"] != "ok")
    add = lambda k, kind: F.aggregate("spans", F.lit(0).cast(kind), lambda a, s: a + F.coalesce(s[k], F.lit(0)).cast(kind))
    return traces.agg(
        F.count("*").alias("n_traces"), F.coalesce(F.avg(bad.cast("double")), F.lit(0.0)).alias("error_rate"),
        F.coalesce(F.avg(add("cost_usd", "double")), F.lit(0.0)).alias("cost_per_request"), F.coalesce(F.sum(add("tokens", "bigint")), F.lit(0)).alias("total_tokens"),
    )


def check_slo(traces: DataFrame, limits: dict[str, float] | None = None, end_to_end: bool = False) -> DataFrame:
    """metric, value, threshold, ok.

    The stage view takes the worst stage's p95 and allows a value at its limit; the ``end_to_end`` view adds the stages'
    p95s, and without traces has nothing to breach.
    """
    t = limits or (API_SLO if end_to_end else OBS_SLO)
    stages = stage_metrics(spans(traces)).agg((F.sum if end_to_end else F.max)("p95_ms").alias("p95_ms"))
    row = trace_metrics(traces).crossJoin(stages)  # two one-row tables
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), F.coalesce(F.col(k), F.lit(0.0)).cast("double").alias("value"), F.lit(v).alias("threshold")) for k, v in t.items()])
    out = row.select("n_traces", F.explode(pairs).alias("c")).select("n_traces", "c.*")
    ok = F.col("value") <= F.col("threshold")
    return out.withColumn("ok", ok | (F.col("n_traces") == 0) if end_to_end else ok).drop("n_traces")


def business_metrics(tickets: DataFrame) -> DataFrame:
    """Handling time, saving, adoption among offers, cost, satisfaction before and after, pass rate."""
    yes = lambda c: F.col(c).cast("double")
    offered = F.when(F.col("suggestion_offered"), yes("suggestion_accepted"))
    m = tickets.agg(
        F.count("*").alias("n_tickets"), F.avg("assisted_handle_seconds").alias("aht_seconds"), F.avg("baseline_handle_seconds").alias("baseline_aht_seconds"), F.avg(offered).alias("adoption_rate"),
        F.avg("llm_cost_usd").alias("cost_per_ticket"), F.avg("csat_before").alias("csat_before"), F.avg("csat_after").alias("csat_after"), F.avg(yes("eval_passed")).alias("eval_pass_rate"),
    ).na.fill(0.0, ["aht_seconds", "baseline_aht_seconds", "adoption_rate", "cost_per_ticket", "eval_pass_rate"])
    saved = F.col("baseline_aht_seconds") - F.col("aht_seconds")
    no_drop = F.col("csat_before").isNull() | F.col("csat_after").isNull() | (F.col("csat_after") >= F.col("csat_before"))
    return m.withColumns({"time_saved_seconds": saved, "time_saved_pct": F.when(F.col("baseline_aht_seconds") != 0, saved / F.col("baseline_aht_seconds")).otherwise(0.0), "csat_no_drop": no_drop})


def business_gate(metrics: DataFrame, min_adoption: float = BUSINESS_GATE["min_adoption_rate"], max_cost: float = BUSINESS_GATE["max_cost_per_ticket"], no_drop: bool = True) -> DataFrame:
    """check, value, threshold, ok."""
    c = lambda name, value, limit, ok: F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), F.lit(limit).alias("threshold"), ok.alias("ok"))
    drop = F.col("csat_no_drop")
    checks = F.array(
        c("adoption_rate", F.col("adoption_rate"), min_adoption, F.col("adoption_rate") >= min_adoption),
        c("cost_per_ticket", F.col("cost_per_ticket"), max_cost, F.col("cost_per_ticket") <= max_cost),
        c("csat_no_drop", drop.cast("double"), 1.0, drop if no_drop else F.lit(True)),
    )
    return metrics.select(F.explode(checks).alias("c")).select("c.*")


def estimate_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / 4)


def cost(model: Column, tokens: Column, prices: dict[str, float]) -> Column:
    """Price per thousand tokens; an unknown model costs nothing."""
    price = F.coalesce(*[F.when(model == m, F.lit(float(p))) for m, p in prices.items()], F.lit(0.0))
    return price * tokens / 1000


def nearest_rank(column: str, p: float) -> Column:
    """Nearest-rank percentile as an aggregate."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {column})")


class Counters:
    """Monotonic counters by name, on the driver."""

    def __init__(self) -> None:
        self._n: dict[str, int] = {}

    def add(self, name: str, by: int = 1) -> None:
        self._n[name] = self.value(name) + by

    def value(self, name: str) -> int:
        return self._n.get(name, 0)

    def snapshot(self) -> dict[str, int]:
        return dict(self._n)


class Tracer:
    """Records spans of driver-side work as rows of ``SPANS``; ``clock`` gives seconds."""

    def __init__(self, doc_id: str, trace_id: str | None = None, clock: Callable[[], float] = time.perf_counter) -> None:
        self.trace_id, self.doc_id, self.clock = trace_id or uuid.uuid4().hex, doc_id, clock
        self.rows: list[dict] = []

    @contextmanager
    def span(self, name: str) -> Iterator[dict]:
        """Times what runs inside; an exception is noted by its class and goes on."""
        row = {"name": name, "duration_ms": 0.0, "status": "ok", "error_type": None, "tokens": 0, "cost_usd": 0.0}
        began = self.clock()
        try:
            yield row
        except BaseException as e:
            row |= {"status": "timeout" if isinstance(e, TimeoutError) else "error", "error_type": "TimeoutError" if isinstance(e, TimeoutError) else type(e).__name__}
            raise
        finally:
            row["duration_ms"] = (self.clock() - began) * 1000
            self.rows.append(row)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.trace_id, self.doc_id, self.rows)], TRACES)


def stage_lines(stages: DataFrame) -> DataFrame:
    """name, line: a dashboard's line for each row of ``stage_metrics``."""
    return stages.select("name", F.format_string("  %-14s p50=%.1f  p95=%.1f  err=%.3f  n=%d", "name", "p50_ms", "p95_ms", "error_rate", "count").alias("line"))


def slo_lines(checks: DataFrame) -> DataFrame:
    """metric, line of the rows of ``check_slo``."""
    mark = F.when(F.col("ok"), "ok").otherwise("BREACH")
    return checks.select("metric", F.format_string("  %-18s %.4f <= %.4f  [%s]", "metric", "value", "threshold", mark).alias("line"))


def span_lines(spans: DataFrame) -> DataFrame:
    """trace_id, line of each span."""
    state = F.when(F.col("error_type").isNull(), F.col("status")).otherwise(F.concat_ws(":", "status", "error_type"))
    return spans.select("trace_id", F.format_string("  %-14s %.1fms tokens=%d $%.5f [%s]", "name", "duration_ms", "tokens", "cost_usd", state).alias("line"))
