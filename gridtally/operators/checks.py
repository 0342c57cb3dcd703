"""Reconciliation and service-level checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtally.session import saved

# Alert levels. ``higher`` = larger is worse, ``lower`` = smaller is worse.
ALERT_LEVELS = [
    ("consumer_lag", "higher", 10_000.0, 100_000.0),
    ("error_rate_pct", "higher", 1.0, 5.0),
    ("p99_latency_ms", "higher", 500.0, 2_000.0),
    ("dlq_size", "higher", 100.0, 1_000.0),
    ("cache_hit_rate_pct", "lower", 80.0, 50.0),
    ("disk_usage_pct", "higher", 70.0, 85.0),
]


def alert_levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ALERT_LEVELS, "metric string, worse string, warning double, critical double"
    )


def reconcile_counts(approx: DataFrame, exact: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Keys whose approximate count is off by more than ``threshold`` of the exact one.

    Both inputs have one row per key and a column ``n``; a key missing on one side counts as 0.
    """
    both = exact.select(*keys, F.col("n").alias("exact_n")).join(
        approx.select(*keys, F.col("n").alias("approx_n")), keys, "full_outer"
    )
    both = both.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("exact_n", "approx_n")})
    off = F.abs(F.col("approx_n") - F.col("exact_n")).cast("double")
    return both.withColumn("rel_diff", off / F.greatest(F.col("exact_n"), F.lit(1))).filter(
        F.col("rel_diff") > threshold
    )


#: Rows of one percentile that a task may rank, and the parts a bracket is cut into to get there.
RANKED_ROWS, BINS = 1_000_000, 4096


def severity_report(metrics: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """Measured values (scope, metric, value) to ok / warning / critical.

    The built-in level table is six fixed rows and broadcast; one passed in is left to the planner.
    """
    table = F.broadcast(alert_levels(metrics.sparkSession)) if levels is None else levels
    passed = lambda bound: F.when(
        F.col("worse") == "higher", F.col("value") > F.col(bound)
    ).otherwise(F.col("value") < F.col(bound))
    severity = F.when(passed("critical"), "critical").when(passed("warning"), "warning").otherwise("ok")
    return metrics.join(table, "metric").select("scope", "metric", "value", severity.alias("severity"))


def latency_percentiles(
    rows: DataFrame, group: str, value: str, points: tuple[float, ...] = (0.5, 0.95, 0.99),
    accuracy: int = 10_000,
) -> DataFrame:
    """Percentiles per group from a mergeable sketch (rank error at most 1 / accuracy)."""
    marks = F.percentile_approx(value, list(points), accuracy).alias("marks")
    sketched = rows.groupBy(group).agg(F.count(value).alias("n"), marks)
    return sketched.select(group, "n", *[F.col("marks")[i].alias(_label(p)) for i, p in enumerate(points)])


def exact_percentiles(
    rows: DataFrame, group: str, value: str, points: tuple[float, ...] = (0.5, 0.95, 0.99),
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact nearest-rank percentiles per group, without sorting or shuffling a whole group.

    A sketch (evaluated here and saved, a row per group) brackets each wanted rank between two
    values. One more pass counts the rows below each bracket, as a map-side sum, and the copies of
    each distinct value inside it. Only values inside the brackets, about 4 / accuracy of a group,
    are shuffled and ranked. Where that could be more than RANKED_ROWS, brackets are narrowed first, by a
    pass that counts rows in BINS parts of each, so no task ranks more whatever the size of a group.
    """
    slack = 2.0 / accuracy
    edges = [e for p in points for e in (max(p - slack, 0.0), min(p + slack, 1.0))]
    known = rows.filter(F.col(value).isNotNull()).select(group, F.col(value).alias("v"))
    sketch = known.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("v").alias("least"),
        F.max("v").alias("most"),
        F.percentile_approx("v", edges, accuracy).alias("edges"),
    )
    brackets = F.array(
        *[
            F.struct(
                F.lit(p).alias("p"),
                F.greatest(F.ceil(F.lit(p) * F.col("n")), F.lit(1)).alias("wanted"),
                (F.col("least") if p - slack <= 0 else F.col("edges")[2 * i]).alias("low"),
                (F.col("most") if p + slack >= 1 else F.col("edges")[2 * i + 1]).alias("high"),
            )
            for i, p in enumerate(points)
        ]
    )
    wanted = saved(sketch.select(F.col(group).alias("_g"), "n", brackets.alias("brackets")), "brackets")
    # A sketch's edges are off by one part in accuracy at most, on either side.
    share = 2 * (slack + 1.0 / accuracy)
    while share * (wanted.agg(F.max("n")).first()[0] or 0) > RANKED_ROWS:
        wanted, inside = _narrowed(known, wanted, group)
        if inside <= RANKED_ROWS:
            break
    near = known.join(wanted, F.col(group).eqNullSafe(F.col("_g"))).select(
        group, "n", "v", F.inline("brackets")
    ).filter(F.col("v") <= F.col("high"))
    # Values below a bracket collapse into one NULL slot that only carries their number.
    slot = F.when(F.col("v") >= F.col("low"), F.col("v"))
    steps = near.groupBy(group, "n", "p", "wanted", slot.alias("v")).agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy(group, "p").orderBy(F.asc_nulls_first("v")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # Twice the sketch's promised error lies inside a bracket; a rank outside it is an error here,
    # not a wrong answer.
    missed = F.raise_error(F.lit("percentile outside its bracket")).cast("double")
    reached = steps.withColumn("upto", F.sum("copies").over(order)).filter(F.col("upto") >= F.col("wanted"))
    reached = reached.withColumn("v", F.coalesce("v", missed))
    found = [F.coalesce(F.min(F.when(F.col("p") == p, F.col("v"))), missed).alias(_label(p)) for p in points]
    return reached.groupBy(group).agg(F.max("n").alias("n"), *found)


def _narrowed(known: DataFrame, wanted: DataFrame, group: str) -> tuple[DataFrame, int]:
    """Brackets cut down to the one of BINS equal parts that holds their rank, and the most rows left in one.

    A bracket of a single value is left as it is and counts as one row: it is ranked by its copies.
    """
    near = known.join(wanted, F.col(group).eqNullSafe(F.col("_g"))).select("_g", "n", "v", F.inline("brackets"))
    near = near.filter(F.col("v") <= F.col("high"))
    # Halves, so that no difference leaves the range of a double.
    part = F.floor((F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * BINS).cast("long")
    place = F.when(F.col("v") < F.col("low"), -1).when(F.col("high") <= F.col("low"), 0).otherwise(F.least(part, F.lit(BINS - 1)))
    counts = near.groupBy("_g", "n", "p", "wanted", place.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    upto = F.sum("rows").over(Window.partitionBy("_g", "p").orderBy("bin"))  # BINS + 1 rows at most
    holding = counts.withColumn("upto", upto).filter((F.col("upto") >= F.col("wanted")) & (F.col("bin") >= 0))
    first = F.row_number().over(Window.partitionBy("_g", "p").orderBy("bin"))
    holding = saved(holding.withColumn("nth", first).filter("nth = 1"), "narrowed")
    brackets = F.sort_array(F.collect_list(F.struct("p", "wanted", "low", "high")))  # one per point
    left = holding.agg(F.max(F.when(F.col("high") > F.col("low"), F.col("rows")).otherwise(1))).first()[0]
    return saved(holding.groupBy("_g", "n").agg(brackets.alias("brackets")), "brackets"), left or 0


def _label(point: float) -> str:
    return "p" + f"{point * 100:g}".replace(".", "_")
