"""Exact quantiles (linear interpolation, NULL/NaN skipped) of any number of columns and groups at
once, without putting a whole group in one task.

Spark's ``percentile``/``median`` merge one value->count map per group in a single task, so
a hot group (a third of all rows, continuous values) would sit in one task's memory.  Here
three aggregated passes narrow every (group, column, probability) to a short bracket of values:

1. sketch: ``percentile_approx`` a little below and above each probability, for all columns in
   one aggregation of the wide rows (fixed-size sketches, merged map-side);
2. count: how many values lie below, and up to the end of, each bracket (plain sums);
3. fetch: the values of the bracket that holds the wanted ranks, collapsed to
   (group, column, probability, value) -> count map-side, and ranked by a running count.

The counts are exact, so the result does not rest on the sketch: if a wanted rank lies outside its
bracket, the bracket is opened on that side and only more values are fetched.  A bracket holds about
``2 * MARGIN / ACCURACY`` of a group's rows (0.04 %) and the ties at its ends, which collapse.  Nothing is
exploded per column but the few values of the brackets.  The result equals pandas / ``percentile`` (linear
interpolation between closest ranks).

``method="auto"`` first reads one number, the size of the largest group: when every group fits the in-task
bound (``IN_TASK_LIMIT`` rows), one pass of Spark's ``percentile`` over all columns gives the same result
at about half the cost (README); otherwise ``"narrowed"``, the passes above, run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerscope.functions.scalars import attach_one_row
from peerscope.session import cut_lineage

#: Accuracy of the sketch (its rank error is 1 / ACCURACY) and half the width of a bracket in such errors.
ACCURACY = 10_000
MARGIN = 2
#: Rows of the largest group up to which a task may hold the group's distinct values.
IN_TASK_LIMIT = 1_000_000


def choose_method(df: DataFrame, keys: list[str] | None = None) -> str:
    """'in_task' when the largest group of ``keys`` fits ``IN_TASK_LIMIT``, else 'narrowed'.  One small
    aggregate; share its answer between passes over the same groups."""
    keys = list(keys or [])
    sizes = df.dropna(subset=keys).groupBy(*keys).count() if keys else df.agg(F.count(F.lit(1)).alias("count"))
    return "in_task" if (sizes.agg(F.max("count")).first()[0] or 0) <= IN_TASK_LIMIT else "narrowed"


def _by_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join on the group keys; with no keys ``right`` is one row, attached as a scalar.  ``right`` has one
    row per group and was written: with its true size known, a few groups are sent to the rows; a shuffle
    of the rows by their group would put all rows of a group into one task's sort."""
    return left.join(right, keys) if keys else attach_one_row(left, right)


def _number(value: str | Column) -> Column:
    """The value as a double, NaN as NULL, minus zero as zero."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(~F.isnan(x), x + F.lit(0.0))


def wide_quantiles(df: DataFrame, values: dict[str, str | Column], probs: list[float], keys: list[str] | None = None,
                   method: str = "auto", accuracy: int = ACCURACY) -> DataFrame:
    """One row per group of ``keys`` (groups with a NULL key are left out; one row overall without keys):
    for each output name of ``values`` the array of its quantiles at ``probs`` (NULL when the group has no
    value), and ``<name>_n``, its number of values."""
    keys, names, probs = list(keys or []), list(values), [float(p) for p in probs]
    pairs = [(i, j) for i in range(len(names)) for j in range(len(probs))]
    rows = df.select(*keys, *[_number(v).alias(f"_v{i}") for i, v in enumerate(values.values())]).dropna(subset=keys)
    if (choose_method(df, keys) if method == "auto" else method) == "in_task":
        return cut_lineage(rows.groupBy(*keys).agg(*[a for i, name in enumerate(names) for a in (
            F.percentile(f"_v{i}", probs).alias(name), F.count(f"_v{i}").alias(f"{name}_n"))]), "quantiles")
    margin = MARGIN / accuracy
    ends = [min(max(p + side * margin, 0.0), 1.0) for p in probs for side in (-1, 1)]
    sketch = cut_lineage(rows.groupBy(*keys).agg(*[a for i in range(len(names)) for a in (
        F.percentile_approx(f"_v{i}", ends, accuracy).alias(f"_e{i}"), F.count(f"_v{i}").alias(f"_n{i}"))]), "sketch")

    def low(i, j):
        return F.col(f"_e{i}")[2 * j]

    def high(i, j):
        return F.col(f"_e{i}")[2 * j + 1]

    counted = _by_keys(rows, sketch, keys).groupBy(*keys).agg(
        *[F.count_if(F.col(f"_v{i}") < low(i, j)).alias(f"_b{i}_{j}") for i, j in pairs],
        *[F.count_if(F.col(f"_v{i}") <= high(i, j)).alias(f"_u{i}_{j}") for i, j in pairs],
    )
    counted = _by_keys(sketch, counted, keys)
    # The wanted ranks (0-based) of each pair, and the bracket that holds them; an open end is NULL.
    brackets = []
    for i, j in pairs:
        at = (F.col(f"_n{i}") - 1) * F.lit(probs[j])
        first, last = F.floor(at).cast("long"), F.ceil(at).cast("long")
        opened = first < F.col(f"_b{i}_{j}")
        brackets.append(F.struct(
            at.alias("at"), first.alias("first"), last.alias("last"),
            F.when(~opened, low(i, j)).alias("lo"), F.when(last < F.col(f"_u{i}_{j}"), high(i, j)).alias("hi"),
            F.when(opened, 0).otherwise(F.col(f"_b{i}_{j}")).alias("skip"),
        ).alias(f"_k{i}_{j}"))
    bounds = cut_lineage(counted.select(*keys, *[f"_n{i}" for i in range(len(names))], *brackets), "brackets")

    def held(i, j):
        x, k = F.col(f"_v{i}"), F.col(f"_k{i}_{j}")
        return F.when(F.coalesce(x >= k["lo"], x.isNotNull()) & F.coalesce(x <= k["hi"], F.lit(True)), F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"), x.alias("x"), k["at"].alias("at"), k["first"].alias("first"),
            k["last"].alias("last"), k["skip"].alias("skip")))

    attached = _by_keys(rows, bounds.select(*keys, *[f"_k{i}_{j}" for i, j in pairs]), keys)
    fetched = attached.select(*keys, F.explode(F.array_compact(F.array(*[held(i, j) for i, j in pairs]))).alias("_h")) \
        .select(*keys, "_h.*").groupBy(*keys, "i", "j", "x").agg(
            F.count(F.lit(1)).alias("c"), *[F.first(c).alias(c) for c in ("at", "first", "last", "skip")])
    up = Window.partitionBy(*keys, "i", "j").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = fetched.withColumn("end", F.col("skip") + F.sum("c").over(up)).withColumn("start", F.col("end") - F.col("c"))

    def value_at(rank):
        return F.max(F.when((F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("end")), F.col("x")))

    ends_found = ranked.groupBy(*keys, "i", "j").agg(
        F.first("at").alias("at"), value_at("first").alias("a"), value_at("last").alias("b"))
    # Same arithmetic as Spark's percentile: (hi - pos) * v_lo + (pos - lo) * v_hi.
    x = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(
        (F.ceil("at") - F.col("at")) * F.col("a") + (F.col("at") - F.floor("at")) * F.col("b"))
    found = ends_found.withColumn("x", x).groupBy(*keys).agg(*[
        F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col("x"))).alias(f"_q{i}_{j}") for i, j in pairs])
    sizes = bounds.select(*keys, *[f"_n{i}" for i in range(len(names))])
    done = sizes.join(found, keys, "left") if keys else attach_one_row(sizes, found)
    return cut_lineage(done.select(*keys, *[c for i, name in enumerate(names) for c in (
        F.when(F.col(f"_n{i}") > 0, F.array(*[F.col(f"_q{i}_{j}") for j in range(len(probs))])).alias(name),
        F.coalesce(f"_n{i}", F.lit(0)).alias(f"{name}_n"))]), "quantiles")


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: list[str] | None = None,
                    out: str = "quantiles", method: str = "auto", accuracy: int = ACCURACY) -> DataFrame:
    """One row per group of ``keys`` that has a value (one row overall when empty): ``out`` is the array of
    quantiles at ``probs`` (NULL without a value), plus ``n``."""
    q = wide_quantiles(df, {"_out": value}, probs, keys, method, accuracy)
    some = q.where("_out_n > 0") if keys else q
    return some.select(*(keys or []), F.col("_out").alias(out), F.col("_out_n").alias("n"))


def exact_median(df: DataFrame, value: str, keys: list[str] | None = None, out: str = "median") -> DataFrame:
    q = exact_quantiles(df, value, [0.5], keys, out="_q")
    return q.select(*(keys or []), F.col("_q")[0].alias(out))
