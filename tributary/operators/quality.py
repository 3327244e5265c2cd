"""Profiling, cleaning counts, quality gates and constraints as checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.operators.ordered import ordered_scan


class GateFailed(Exception):
    """A quality gate found violations; what follows must not run."""


def null_rates(df: DataFrame) -> DataFrame:
    """NULL share of every column in one pass."""
    return df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")


def newest_per_event(raw: DataFrame) -> DataFrame:
    """The newest well-timed copy per event id, with the number of copies; partial aggregates.

    Newest is by ingest time where the rows have it, then by event time, file and content, so
    that the survivor never depends on the order of reading.
    """
    parsed = raw.withColumn("event_ts", parse_time(F.col("ts")))
    content = ["user_id", "event_type", "product_id", "device", "event_ts"]
    ranks = ["_ingested_at", "event_ts", "_source_file", *content[:-1]]
    order = F.struct(*[c for c in ranks if c in parsed.columns])
    newest = F.max_by(F.struct(*content), F.when(F.col("event_ts").isNotNull(), order))
    return parsed.groupBy("event_id").agg(F.count("*").alias("copies"), F.count("event_ts").alias("timed"), newest.alias("e"))


def clean_events(raw: DataFrame) -> DataFrame:
    """Typed time, newest copy per id, no missing users."""
    kept = newest_per_event(raw).filter((F.col("timed") > 0) & F.col("e.user_id").isNotNull())
    return kept.select("event_id", "e.*")


def cleaning_counts(raw: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, from one pass over the raw events."""
    per_event = newest_per_event(raw)
    return per_event.agg(
        F.sum("copies").alias("raw"),
        F.sum("timed").alias("parsed"),
        F.count_if(F.col("timed") > 0).alias("deduplicated"),
        F.count_if((F.col("timed") > 0) & F.col("e.user_id").isNotNull()).alias("clean"),
    )


def reject_reasons(raw: DataFrame) -> DataFrame:
    """Every raw row counted under one reason; ``kept`` are the clean ones."""
    per_event = newest_per_event(raw)
    survivor = F.when(F.col("timed") > 0, 1).otherwise(0)
    no_user = F.col("e.user_id").isNull()
    reasons = F.array(
        F.struct(F.lit("bad_time").alias("reason"), (F.col("copies") - F.col("timed")).alias("n")),
        F.struct(F.lit("duplicate").alias("reason"), (F.col("timed") - survivor).cast("bigint").alias("n")),
        F.struct(F.lit("no_user").alias("reason"), F.when(no_user, survivor).otherwise(0).cast("bigint").alias("n")),
        F.struct(F.lit("kept").alias("reason"), F.when(~no_user, survivor).otherwise(0).cast("bigint").alias("n")),
    )
    counted = per_event.select(F.explode(reasons).alias("r")).select("r.*").groupBy("reason").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") > 0)


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per rule in one pass; a rule that is NULL is not violated, as with CHECK."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(~rule).alias(f"_{i}") for i, rule in enumerate(rules.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("violations")) for i, name in enumerate(rules)])
    return counts.select("_n", F.explode(rows).alias("r")).select("r.rule", F.col("_n").alias("checked"), "r.violations")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")


def event_gate(events: DataFrame, types: list[str], start: str, end: str) -> DataFrame:
    """Four checks over cleaned events: unique id, user present, known type, time in range."""
    per_id = events.groupBy("event_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("user_id").isNull()).alias("no_user"),
        F.count_if(~F.coalesce(F.col("event_type").isin(types), F.lit(False))).alias("bad_type"),
        F.count_if(~F.coalesce(F.col("event_ts").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")), F.lit(False))).alias("bad_time"),
    )
    totals = per_id.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("unique_event_id"),
        F.coalesce(F.sum("no_user"), F.lit(0)).alias("user_present"),
        F.coalesce(F.sum("bad_type"), F.lit(0)).alias("known_type"),
        F.coalesce(F.sum("bad_time"), F.lit(0)).alias("time_in_range"),
    )
    checks = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("violations")) for c in totals.columns])
    rows = totals.select(F.explode(checks).alias("c")).select("c.*")
    return rows.withColumn("result", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


def require(gate: DataFrame) -> None:
    """Stop the job unless every check passed; the gate has one row per check."""
    failed = [f"{r['check']}: {r['violations']}" for r in gate.collect() if r["result"] != "PASS"]
    if failed:
        raise GateFailed("; ".join(failed))


def overlaps(periods: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Periods of one key that begin before an earlier one has ended; touching is allowed.

    Linear: compares each period with the latest end before it, not with every other period.
    """
    seen = ordered_scan(periods, [key], [start, end], maxes_before={"previous_end": end})
    return seen.filter(F.col(start) < F.col("previous_end"))


def column_profile(df: DataFrame, columns: list[str], top: int = 3) -> DataFrame:
    """Distinct values, NULL share and most common values per column.

    Each column is counted per value first, so no value list ever meets in one task.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    per_value = df.select(F.explode(cells).alias("c")).select("c.*").groupBy("column", "value").agg(F.count("*").alias("n"))
    stats = per_value.groupBy("column").agg(
        F.count("value").alias("n_distinct"),
        (F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("null_frac"),
    )
    common = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    best = (
        per_value.filter(F.col("value").isNotNull())
        .withColumn("_r", F.row_number().over(common))
        .filter(F.col("_r") <= top)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("_r", "value"))).alias("_v"))
    )
    return stats.join(best, "column", "left").select("column", "n_distinct", "null_frac", F.transform("_v", lambda v: v["value"]).alias("most_common"))


def position_correlation(df: DataFrame, position: str, value: str) -> DataFrame:
    """How closely the order of ``value`` follows the stored position (1 = sorted)."""
    ranked = ordered_scan(df.select(position, value), [], [value, position], row_number="_rank")
    return ranked.agg(F.corr(F.col("_rank").cast("double"), F.col(position).cast("double")).alias("correlation"))


def dependency(df: DataFrame, a: str, b: str) -> DataFrame:
    """How far two columns depend on each other: the frequency of each pair next to the
    product of the frequencies of its parts."""
    pairs = df.groupBy(a, b).agg(F.count("*").alias("n"))
    per = lambda c: pairs.groupBy(F.col(c).alias(f"_{c}")).agg(F.sum("n").alias(f"n_{c}"))
    joined = pairs.join(per(a), F.col(a).eqNullSafe(F.col(f"_{a}"))).join(per(b), F.col(b).eqNullSafe(F.col(f"_{b}")))
    joined = joined.select("*", F.col(f"n_{a}").alias("n_a"), F.col(f"n_{b}").alias("n_b"), pairs.agg(F.sum("n")).scalar().alias("total"))
    return joined.select(
        a,
        b,
        "n",
        (F.col("n") / F.col("total")).alias("joint"),
        (F.col("n_a") / F.col("total") * (F.col("n_b") / F.col("total"))).alias("independent"),
    )


def sampled_count(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Row count estimated from a sample next to the exact one."""
    sampled = df.sample(fraction, seed).agg(F.count("*") / fraction).scalar()
    both = df.agg(F.count("*").alias("exact")).withColumn("estimate", sampled)
    return both.select("exact", "estimate", (F.abs(F.col("estimate") - F.col("exact")) / F.col("exact")).alias("error"))
