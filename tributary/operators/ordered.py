"""Ordered scans that never put one key's whole history into one task.

A plain window sends every row of a key to the same task. That is what cold keys get. The rows of
hot keys are dealt out by ranges of key and order, so a hot key is cut at its own quantiles,
whatever the type or spread of its order; windows run per (key, slice), and a small table with one
row per (key, slice) carries counts, sums, ties and edge values across the cuts. Only that table,
never longer than the range partitions and hot keys together, is windowed per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.storage import write_and_read

HOT_SHARE = 1e-5  # at most 100,000 keys can hold this share of all rows
HOT_ROWS = 100_000  # a key below this fits a task whatever its share
ACCURACY = 10_000  # of the sketch that brackets exact percentiles


def split_hot(df: DataFrame, keys: list[str], order: list[str], hot_rows: int = HOT_ROWS, slices: int | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of cold keys, rows of hot keys with ``_at``); either is None if known to be empty.

    Hot keys have at least ``hot_rows`` rows and HOT_SHARE of all rows; without ``keys`` all rows
    are one hot key. ``_at`` is key and slice as one value that is never NULL itself, so a NULL key
    joins like any other; slices ascend with the order. The cut is written, as a second evaluation
    of a range partitioning may sample other borders. ``slices`` fixes the number of ranges;
    otherwise it is that of the session's shuffles.
    """
    cold, hot = None, df
    if keys:
        marked = df.withColumn("_key", F.struct(*keys))
        counts = marked.groupBy("_key").agg(F.count("*").alias("_n"))
        least = F.greatest(F.lit(hot_rows), counts.agg(F.sum("_n")).scalar() * HOT_SHARE)
        names = write_and_read(counts.filter(F.col("_n") >= least).select("_key"), "hot-keys")
        if names.isEmpty():
            return df, None
        cold, hot = (marked.join(names, "_key", how).drop("_key") for how in ("left_anti", "left_semi"))
    ranges = [*keys, *order]
    ranged = hot.repartitionByRange(slices, *ranges) if slices else hot.repartitionByRange(*ranges)
    placed = write_and_read(ranged.withColumn("_slice", F.spark_partition_id()), "ordered-slices")
    return cold, placed.withColumn("_at", F.struct(*keys, "_slice")).drop("_slice")


def _both(cold: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    parts = [p for p in (cold, hot) if p is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    total: str | None = None,
    sums: dict[str, str] | None = None,
    lags: dict[str, str] | None = None,
    leads: dict[str, str] | None = None,
    maxes_before: dict[str, str] | None = None,
    hot_rows: int = HOT_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add window columns over ``keys`` in ascending ``order`` (a total order, NULL first).

    ``rank`` and ``dense_rank`` compare the first order column only; its ties may lie in several
    slices. ``keys`` may be empty for one global order. ``total`` adds the row count of the key;
    ``maxes_before`` is the maximum over all earlier rows. ``df`` is read more than once.
    """
    sums, lags, leads, maxes = sums or {}, lags or {}, leads or {}, maxes_before or {}
    sum_type = {n: df.select(F.sum(c)).schema[0].dataType for n, c in sums.items()}

    def windows(by: list[str]) -> dict[str, Column]:
        local = Window.partitionBy(*by).orderBy(*order)
        by_value = Window.partitionBy(*by).orderBy(order[0])
        running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        earlier = local.rowsBetween(Window.unboundedPreceding, -1)
        out = {"_rn": F.row_number().over(local)} if row_number else {}
        out |= {"_rank": F.rank().over(by_value)} if rank else {}
        out |= {"_dense": F.dense_rank().over(by_value)} if dense_rank else {}
        out |= {f"_sum_{n}": F.sum(c).over(running) for n, c in sums.items()}
        out |= {f"_lag_{n}": F.lag(F.struct(F.col(c).alias("v"))).over(local) for n, c in lags.items()}
        out |= {f"_lead_{n}": F.lead(F.struct(F.col(c).alias("v"))).over(local) for n, c in leads.items()}
        return out | {f"_max_{n}": F.max(c).over(earlier) for n, c in maxes.items()}

    cold, hot = split_hot(df, keys, order, hot_rows, slices)
    if cold is not None:
        scanned = cold.select("*", *[c.alias(n) for n, c in windows(keys).items()], *([F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("_total")] if total else []))
        out = [F.col(c).cast("bigint").alias(n) for c, n in (("_rn", row_number), ("_rank", rank), ("_dense", dense_rank), ("_total", total)) if n]
        out += [F.col(f"_sum_{n}").alias(n) for n in sums]
        out += [F.col(f"_{kind}_{n}")["v"].alias(n) for kind, names in (("lag", lags), ("lead", leads)) for n in names]
        cold = scanned.select(*df.columns, *out, *[F.col(f"_max_{n}").alias(n) for n in maxes])
    if hot is not None:
        carry = _carry(hot, keys, order, bool(rank or dense_rank), sums, lags, leads, maxes)
        joined = hot.select("*", *[c.alias(n) for n, c in windows(["_at"]).items()]).join(carry, "_at")
        first = F.coalesce(F.col("_tied") & (F.struct(order[0]) == F.col("_first")), F.lit(False)) if rank or dense_rank else None
        out = [(F.col("_rn") + F.col("_before")).alias(row_number)] if row_number else []
        out += [F.when(first, F.col("_tie_rank")).otherwise(F.col("_rank") + F.col("_before")).alias(rank)] if rank else []
        out += [(F.col("_dense") + F.col("_dbefore")).alias(dense_rank)] if dense_rank else []
        out += [F.col("_total").alias(total)] if total else []
        out += [F.coalesce(F.col(f"_sum_{n}") + F.col(f"_csum_{n}"), f"_sum_{n}", f"_csum_{n}").cast(sum_type[n]).alias(n) for n in sums]
        out += [F.coalesce(f"_{kind}_{n}", f"_c{kind}_{n}")["v"].alias(n) for kind, names in (("lag", lags), ("lead", leads)) for n in names]
        hot = joined.select(*df.columns, *out, *[F.greatest(f"_max_{n}", f"_cmax_{n}").alias(n) for n in maxes])
    return _both(cold, hot)


def _carry(hot: DataFrame, keys: list[str], order: list[str], ties: bool, sums: dict[str, str], lags: dict[str, str], leads: dict[str, str], maxes: dict[str, str]) -> DataFrame:
    """One row per (key, slice): what the earlier slices of the key add to its rows."""
    position = F.struct(*order)
    edge = [F.count(F.lit(1)).alias("_n")]
    edge += [F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()]
    edge += [F.max_by(F.struct(F.col(c).alias("v")), position).alias(f"_last_{n}") for n, c in lags.items()]
    edge += [F.min_by(F.struct(F.col(c).alias("v")), position).alias(f"_first_{n}") for n, c in leads.items()]
    edge += [F.max(c).alias(f"_max_{n}") for n, c in maxes.items()]
    per_slice = hot.groupBy("_at").agg(*edge)

    of_key = [F.col("_at")[k] for k in keys]
    along = Window.partitionBy(*of_key).orderBy(F.col("_at")["_slice"])
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = lambda c: F.coalesce(c, F.lit(0))
    carried = {"_before": zero(F.sum("_n").over(before)), "_total": F.sum("_n").over(Window.partitionBy(*of_key))}
    carried |= {f"_csum_{n}": F.sum(f"_sum_{n}").over(before) for n in sums}
    carried |= {f"_clag_{n}": F.lag(f"_last_{n}").over(along) for n in lags}
    carried |= {f"_clead_{n}": F.lead(f"_first_{n}").over(along) for n in leads}
    carried |= {f"_cmax_{n}": F.max(f"_max_{n}").over(before) for n in maxes}
    if ties:
        values = hot.groupBy("_at", F.struct(order[0]).alias("_v")).agg(F.count("*").alias("_c")).groupBy("_at")
        runs = values.agg(F.min("_v").alias("_first"), F.max("_v").alias("_last"), F.max_by("_c", "_v").alias("_n_last"), F.count("*").alias("_d"))
        per_slice = per_slice.join(runs, "_at")
        carried["_tied"] = F.coalesce(F.col("_first") == F.lag("_last").over(along), F.lit(False))
    carry = per_slice.select("*", *[c.alias(n) for n, c in carried.items()])
    if ties:
        # where the run of a slice's last value began: in this slice, unless the run fills it and came in over the border
        began = F.when(~(F.col("_tied") & (F.col("_first") == F.col("_last"))), F.col("_before") + F.col("_n") - F.col("_n_last") + 1)
        repeated = F.col("_tied").cast("bigint")
        carry = carry.withColumn("_began", F.last(began, ignorenulls=True).over(so_far))
        carry = carry.withColumn("_dbefore", F.sum(F.col("_d") - repeated).over(so_far) - F.col("_d")).withColumn("_tie_rank", F.lag("_began").over(along))
    kept = [*carried, *(["_first", "_dbefore", "_tie_rank"] if ties else [])]
    return carry.select("_at", *kept)


def sessionise(df: DataFrame, key: str, order: list[str], gap: str, name: str = "session_id", hot_rows: int = HOT_ROWS, slices: int | None = None) -> DataFrame:
    """Number the sessions of each key: a new one starts after a silence longer than ``gap``.

    Same cut as ``ordered_scan``: one shuffle of a cold key's rows, and for hot keys only the
    slice edges are compared per key.
    """
    ts = order[0]
    limit = F.expr(f"INTERVAL {gap}")

    def runs(rows: DataFrame, by: str) -> DataFrame:
        local = Window.partitionBy(by).orderBy(*order)
        flagged = rows.withColumn("_prev", F.lag(ts).over(local)).withColumn("_new", F.coalesce((F.col(ts) > F.col("_prev") + limit).cast("int"), F.lit(0)))
        return flagged.withColumn("_run", F.sum("_new").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    cold, hot = split_hot(df, [key], order, hot_rows, slices)
    if cold is not None:
        cold = runs(cold, key).select(*df.columns, (F.col("_run") + 1).cast("bigint").alias(name))
    if hot is not None:
        flagged = runs(hot, "_at")
        edges = flagged.groupBy("_at").agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.sum("_new").alias("_inner"))
        along = Window.partitionBy(F.col("_at")[key]).orderBy(F.col("_at")["_slice"])
        previous = F.lag("_last").over(along)
        starts = (
            edges.withColumn("_start", F.when(previous.isNull() | (F.col("_first") > previous + limit), 1).otherwise(0))
            .withColumn("_sessions", F.col("_start") + F.col("_inner"))
            .withColumn("_base", F.sum("_sessions").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_inner"))
            .select("_at", "_base")
        )
        hot = flagged.join(starts, "_at").select(*df.columns, (F.col("_base") + F.col("_run")).cast("bigint").alias(name))
    return _both(cold, hot)


def tiles(position: Column, total: Column, n: int) -> Column:
    """The bucket that ``ntile(n)`` gives to a row at ``position`` of ``total``."""
    small = F.floor(total / n)
    large = total % n
    in_large = position <= large * (small + 1)
    return (
        F.when(in_large, F.floor((position - 1) / (small + 1)) + 1)
        .otherwise(large + F.floor((position - 1 - large * (small + 1)) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )


def exact_percentiles(df: DataFrame, keys: list[str], value: str, quantiles: list[float], interpolate: bool, accuracy: int = ACCURACY) -> DataFrame:
    """Exact percentiles of finite values: a quantile sketch of each group brackets every rank, one pass counts
    the values below each bracket, and only those inside, collapsed to (value, count), are ordered.

    The sketch merges over partial aggregates and errs by 1/``accuracy`` of a group's rows at most, so a
    bracket holds about 6/``accuracy`` of them, however the values are spread; a group of no more than
    ``accuracy`` rows is its own bracket. interpolate: linear between neighbours; otherwise nearest rank
    ``ceil(q * n)``. Returns keys, ``q``, ``value`` (double).
    """
    below, inside = percentile_parts(df, keys, value, quantiles, accuracy)
    n, at = F.col("_n"), F.col("_q")
    if interpolate:
        place = at * (n - 1)
        ranks = ((F.floor(place) + 1, place - F.floor(place), 0), (F.ceil(place) + 1, place - F.floor(place), 1))
    else:
        ranks = ((F.greatest(F.ceil(at * n), F.lit(1)), F.lit(0.0), 0),)
    targets = F.array(*[F.struct(r.cast("bigint").alias("r"), f.cast("double").alias("f"), F.lit(side).alias("side")) for r, f, side in ranks])
    wanted = below.withColumn("t", F.explode(targets)).select("_g", "_i", "_q", "_below", "t.*")
    along = Window.partitionBy("_g", "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    values = inside.withColumn("_through", F.sum("_c").over(along))
    rank = F.col("r") - F.col("_below")
    at_rank = wanted.join(values, ["_g", "_i"]).filter((rank > F.col("_through") - F.col("_c")) & (rank <= F.col("_through")))
    low, high = (F.max(F.when(F.col("side") == side, F.col("_v").cast("double"))) for side in (0, 1))
    result = at_rank.groupBy("_g", "_i", "_q").agg(low.alias("_low"), high.alias("_high"), F.max("f").alias("_f"))
    picked = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_f") if interpolate else F.col("_low")
    return result.select(*[F.col("_g")[k].alias(k) for k in keys], F.col("_q").alias("q"), picked.alias("value"))


def percentile_parts(df: DataFrame, keys: list[str], value: str, quantiles: list[float], accuracy: int = ACCURACY) -> tuple[DataFrame, DataFrame]:
    """(counts below each bracket, counted values inside each bracket) of ``exact_percentiles``."""
    group = F.struct(F.lit(0).alias("_"), *keys)  # never NULL itself, so a NULL key keeps its percentiles
    rows = df.filter(F.col(value).isNotNull()).select(group.alias("_g"), F.col(value).alias("_v"), F.col(value).cast("double").alias("_x"))
    margin = 3 / accuracy
    edges = [e for q in quantiles for e in (max(0.0, q - margin), min(1.0, q + margin))]
    sketch = rows.groupBy("_g").agg(F.percentile_approx("_x", edges, accuracy).alias("_edges"), F.min("_x").alias("_least"), F.max("_x").alias("_most"), F.count("*").alias("_n"))
    small = F.col("_n") <= accuracy
    # towards an end of the range the end itself is the edge
    low = [F.when(small | F.lit(q <= margin), F.col("_least")).otherwise(F.col("_edges")[2 * i]) for i, q in enumerate(quantiles)]
    high = [F.when(small | F.lit(q >= 1 - margin), F.col("_most")).otherwise(F.col("_edges")[2 * i + 1]) for i, q in enumerate(quantiles)]
    brackets = F.array(*[F.struct(F.lit(i).alias("i"), a.alias("lo"), b.alias("hi")) for i, (a, b) in enumerate(zip(low, high))])
    sketch = sketch.select("_g", "_n", brackets.alias("_b"))
    placed = rows.join(sketch, "_g")
    counts = placed.groupBy("_g").agg(F.max("_n").alias("_n"), *[F.count_if(F.col("_x") < F.col("_b")[i]["lo"]).alias(f"_below{i}") for i in range(len(quantiles))])
    each = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(q).alias("_q"), F.col(f"_below{i}").alias("_below")) for i, q in enumerate(quantiles)])
    below = counts.select("_g", "_n", F.explode(each).alias("b")).select("_g", "_n", "b.*")
    hits = F.filter("_b", lambda b: (F.col("_x") >= b["lo"]) & (F.col("_x") <= b["hi"]))
    inside = placed.select("_g", "_v", F.explode(F.transform(hits, lambda b: b["i"])).alias("_i")).groupBy("_g", "_i", "_v").agg(F.count("*").alias("_c"))
    return below, inside
