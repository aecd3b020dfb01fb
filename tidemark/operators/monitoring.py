"""Monitoring over a table of metric points (name, value, ts), and cost roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import refdata


def _minutes(n) -> Column:
    return F.make_interval(mins=n if isinstance(n, Column) else F.lit(n))


def metric_aggregates(metrics: DataFrame, as_of: Column, minutes: int = 5, tie: str | None = None) -> DataFrame:
    """Count, sum, mean, range and latest value per metric in the last minutes."""
    latest = F.max_by("value", F.struct("ts", *([tie] if tie else [])))
    return metrics.where(F.col("ts") >= as_of - _minutes(minutes)).groupBy("name").agg(
        F.count("*").alias("count"), F.sum("value").alias("sum"), F.avg("value").alias("avg"),
        F.min("value").alias("min"), F.max("value").alias("max"), latest.alias("latest"))


def _sla(spark) -> DataFrame:
    return refdata.inline_table(spark, "name STRING, target DOUBLE, comparison STRING, window_minutes INT, severity STRING",
                                refdata.SLA_TARGETS)


def sla_breaches(metrics: DataFrame) -> DataFrame:
    """One alert per point that misses its service level."""
    value, target, kind = F.col("value"), F.col("target"), F.col("comparison")
    breach = (F.when(kind == "less_than", value >= target).when(kind == "greater_than", value <= target)
              .when(kind == "equal", F.abs(value - target) > target * 0.1).otherwise(False))
    shown = F.when(target == F.floor(target), F.floor(target).cast("string")).otherwise(target.cast("string"))
    message = F.concat(F.lit("SLA breach: "), "name", F.lit(" is "), F.replace(F.format_number(value, 2), F.lit(","), F.lit("")),
                       F.lit(" (target: "), kind, F.lit(" "), shown, F.lit(")"))
    return metrics.join(F.broadcast(_sla(metrics.sparkSession)), "name").where(breach).select(
        F.col("name").alias("metric_name"), "severity", message.alias("message"), value.alias("current_value"),
        target.alias("threshold"), "ts", *[c for c in metrics.columns if c not in ("name", "value", "ts")])


def active_alerts(alerts: DataFrame, as_of: Column, minutes: int = 15, severity: str | None = None) -> DataFrame:
    """Alerts young enough to be active."""
    young = alerts.where(F.col("ts") >= as_of - _minutes(minutes))
    return young if severity is None else young.where(F.col("severity") == severity)


def alert_counts(alerts: DataFrame, as_of: Column, minutes: int = 15) -> DataFrame:
    return active_alerts(alerts, as_of, minutes).groupBy("severity").agg(F.count("*").alias("alerts"))


def health_checks(metrics: DataFrame, as_of: Column, minutes: int = 5) -> DataFrame:
    """Value and status of every check whose metric has recent points."""
    checks = refdata.inline_table(
        metrics.sparkSession, "layer STRING, check_name STRING, name STRING, statistic STRING, healthy_when STRING, "
                              "bound DOUBLE, otherwise STRING", refdata.HEALTH_CHECKS)
    aggregates = metric_aggregates(metrics, as_of, minutes).select("name", "avg", "sum")
    value = F.when(F.col("statistic") == "avg", F.col("avg")).otherwise(F.col("sum"))
    healthy = F.when(F.col("healthy_when") == "above", F.col("value") > F.col("bound")).otherwise(F.col("value") < F.col("bound"))
    return (aggregates.join(F.broadcast(checks), "name").withColumn("value", value)
            .select("layer", "check_name", "value", F.when(healthy, "healthy").otherwise(F.col("otherwise")).alias("status")))


def layer_health(checked: DataFrame) -> DataFrame:
    """Worst check per layer; a layer without recent metrics is healthy."""
    layers = refdata.inline_table(checked.sparkSession, "layer STRING", [("bronze",), ("silver",), ("gold",)])
    severity = F.when(F.col("status") == "unhealthy", 2).when(F.col("status").isin("degraded", "warning"), 1).otherwise(0)
    worst = checked.groupBy("layer").agg(F.max(severity).alias("_worst"), F.count("*").alias("checks"))
    return layers.join(worst, "layer", "left").select(
        "layer", F.coalesce("checks", F.lit(0)).alias("checks"), _health(F.col("_worst")).alias("status"))


def _health(level: Column) -> Column:
    return F.when(level == 2, "unhealthy").when(level == 1, "degraded").otherwise("healthy")


def overall_health(metrics: DataFrame, as_of: Column, minutes: int = 5, alert_minutes: int = 15,
                   window_factor: int = 1) -> DataFrame:
    """One row: worst layer, active alerts by severity and the means of the key metrics."""
    layers = layer_health(health_checks(metrics, as_of, minutes))
    rank = F.when(F.col("status") == "unhealthy", 2).when(F.col("status") == "degraded", 1).otherwise(0)
    status = lambda name: F.max(F.when(F.col("layer") == name, F.col("status"))).alias(f"{name}_status")
    top = layers.agg(_health(F.max(rank)).alias("overall_status"), *[status(n) for n in ("bronze", "silver", "gold")])
    young = active_alerts(sla_breaches(metrics), as_of, alert_minutes)
    alerts = young.agg(*[F.count_if(F.col("severity") == s.upper()).alias(f"{s}_alerts") for s in ("critical", "error", "warning")])
    key = metrics.agg(*[
        F.avg(F.when((F.col("name") == metric) & (F.col("ts") >= as_of - _minutes(window * window_factor)),
                     F.col("value"))).alias(f"{label}_avg") for label, metric, window in refdata.KEY_METRICS])
    one = F.lit(1)
    return (top.withColumn("_one", one).join(alerts.withColumn("_one", one), "_one")
            .join(key.withColumn("_one", one), "_one").drop("_one"))


def streaming_cost(usage: DataFrame) -> DataFrame:
    """Cost parts and total of rows with events_processed, compute_hours, storage_gb and network_gb."""
    units = {"event_hub": "events_processed", "compute": "compute_hours", "storage": "storage_gb", "network": "network_gb"}
    parts = {f"{part}_cost": F.col(column) * refdata.COST_RATES[part] for part, column in units.items()}
    total = sum((F.col(c) for c in list(parts)[1:]), F.col(list(parts)[0]))
    return usage.withColumns(parts).withColumn("total_cost", total)


def optimization_recommendations(metrics: DataFrame, as_of: Column, tie: str | None = None, window_factor: int = 1) -> DataFrame:
    """The cost recommendations whose condition holds."""
    advice = refdata.inline_table(
        metrics.sparkSession, "name STRING, minutes INT, statistic STRING, fires_when STRING, bound DOUBLE, recommendation STRING",
        refdata.COST_ADVICE)
    start = as_of - _minutes(F.col("minutes") * window_factor)
    recent = metrics.join(F.broadcast(advice), "name").where(F.col("ts") >= start)
    stats = recent.groupBy("name", "statistic", "fires_when", "bound", "recommendation").agg(
        F.avg("value").alias("avg"), F.max("value").alias("max"),
        F.max_by("value", F.struct("ts", *([tie] if tie else []))).alias("latest"))
    value = (F.when(F.col("statistic") == "avg", F.col("avg")).when(F.col("statistic") == "max", F.col("max"))
             .otherwise(F.col("latest")))
    fires = F.when(F.col("fires_when") == "above", value > F.col("bound")).otherwise(value < F.col("bound"))
    return stats.where(fires).select("name", value.alias("value"), "recommendation")


# ------------------------------------------------------------------------------- usage costs

def _month_to_date(usage: DataFrame, as_of: Column) -> DataFrame:
    day = F.to_date(as_of)
    return usage.where((F.col("usage_date") >= F.trunc(day, "month")) & (F.col("usage_date") <= day))


def usage_by_service(usage: DataFrame, as_of: Column, top: int | None = None) -> DataFrame:
    """Month-to-date cost per service, most expensive first (all, or the top ones)."""
    costs = _month_to_date(usage, as_of).groupBy("service").agg(F.sum("cost").alias("cost")).orderBy(F.desc("cost"), "service")
    return costs if top is None else costs.limit(top)


def usage_daily_series(usage: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Cost of each of the last days; days without usage show 0."""
    day = F.to_date(as_of)
    calendar = usage.sparkSession.range(days).select(F.date_sub(day, F.col("id").cast("int")).alias("usage_date"))
    spent = (usage.where((F.col("usage_date") > F.date_sub(day, days)) & (F.col("usage_date") <= day))
             .groupBy("usage_date").agg(F.sum("cost").alias("cost")))
    return calendar.join(spent, "usage_date", "left").withColumn("cost", F.coalesce("cost", F.lit(0.0)))


def usage_month_summary(usage: DataFrame, as_of: Column, budget: float) -> DataFrame:
    """Month total against the budget, daily average and 30-day projection."""
    day_of_month = F.dayofmonth(F.to_date(as_of))
    total = F.col("total_cost")
    return _month_to_date(usage, as_of).agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_cost")).withColumns({
        "budget_limit": F.lit(float(budget)), "over_budget": total > budget, "remaining": F.lit(float(budget)) - total,
        "daily_average": total / day_of_month, "projected_monthly": total * 30 / day_of_month})


# ------------------------------------------------------------------------------- stream progress

def progress_rows(progress: dict, tags: dict | None = None) -> list[dict]:
    """Metric rows of one streaming progress report."""
    name = progress.get("name") or progress.get("id")
    values = {
        "input_rows": progress.get("numInputRows"),
        "input_rows_per_second": progress.get("inputRowsPerSecond"),
        "processed_rows_per_second": progress.get("processedRowsPerSecond"),
        "trigger_execution_ms": (progress.get("durationMs") or {}).get("triggerExecution"),
        "state_rows": sum(op.get("numRowsTotal", 0) for op in progress.get("stateOperators") or []),
        "output_rows": (progress.get("sink") or {}).get("numOutputRows"),
    }
    labels = {"query": str(name), "batch": str(progress.get("batchId")), **(tags or {})}
    return [{"name": key, "value": float(value), "ts": progress.get("timestamp"), "tags": labels}
            for key, value in values.items() if value is not None and value == value]
