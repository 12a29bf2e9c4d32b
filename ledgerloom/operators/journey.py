"""Ordered-sequence operators: skew-safe lag (F2), transitions (H6, G6),
cohorts (J12), association rules (J4), event windows (D9), top-k (G3)."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.exprs import paise
from ledgerloom.session import stored


def lag_within(df: DataFrame, entity: str, order_cols: Sequence[str], value: str,
               name: str = "prev") -> DataFrame:
    """Previous ``value`` of the same ``entity`` in ``order_cols`` order.

    Equivalent to ``lag(value) over (partition by entity order by ...)``
    but without the per-entity window: one entity may own a third of all
    rows, and a window would sort it in a single task.  Rows are range
    partitioned by ``(entity, order...)`` -- one shuffle, balanced whatever
    the skew -- and each partition carries the row before along.  Only a
    partition's first row lacks its predecessor: the last row of the
    partition before it, looked up among one row per partition.  The tagged
    rows are stored, so both sides see the same partitions.
    """
    nparts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [entity, *order_cols]
    ranged = df.repartitionByRange(nparts, *keys).sortWithinPartitions(*keys)
    schema = T.StructType(
        [f for f in ranged.schema.fields if f.name != name]
        + [T.StructField(name, ranged.schema[value].dataType), T.StructField("_pid", T.IntegerType()),
           T.StructField("_row", T.LongType())])
    kept = [f.name for f in schema.fields[:-3]]

    def tag(batches):
        pid, row = TaskContext.get().partitionId(), 0
        last_entity = last_value = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            e, v = batch.column(entity), batch.column(value)
            e = pa.concat_arrays([last_entity if last_entity is not None else pa.nulls(1, e.type), e])
            v = pa.concat_arrays([last_value if last_value is not None else pa.nulls(1, v.type), v])
            same = pc.fill_null(pc.equal(e.slice(1), e.slice(0, n)), False)
            prev = pc.if_else(same, v.slice(0, n), pa.nulls(1, v.type)[0])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), prev, pa.array([pid] * n, pa.int32()),
                 pa.array(range(row, row + n), pa.int64())], schema.names)
            row += n
            last_entity, last_value = e.slice(n), v.slice(n)

    tagged = stored(ranged.mapInArrow(tag, schema), "lag")
    ends = tagged.groupBy("_pid").agg(F.max_by(F.struct(F.col(entity).alias("e"), F.col(value).alias("v")), "_row").alias("_end"))
    before = ends.select("_pid", F.lag("_end").over(Window.orderBy("_pid")).alias("_end"))  # one row per partition
    first = (F.col("_row") == 0) & (F.col("_end.e") == F.col(entity))
    return tagged.join(F.broadcast(before), "_pid").withColumn(
        name, F.when(first, F.col("_end.v")).otherwise(F.col(name))).drop("_pid", "_row", "_end")


def transitions(df: DataFrame, entity: str, order_cols: Sequence[str], state: str) -> DataFrame:
    """Dense row-normalised transition matrix between consecutive states (H6).

    Long form: ``from_state, to_state, transitions, row_share``; every
    ordered pair of observed states appears (zero cells kept); a row with
    no outgoing transition has null shares.  The state set is small (a
    category vocabulary), so the grid is (#states)^2 rows.
    """
    seq = lag_within(df.select(entity, *order_cols, state), entity, order_cols, state, "_prev")
    counts = (
        seq.where(F.col("_prev").isNotNull())
        .groupBy(F.col("_prev").alias("from_state"), F.col(state).alias("to_state"))
        .agg(F.count("*").alias("transitions"))
    )
    states = seq.select(F.col(state).alias("s")).where(F.col("s").isNotNull()).distinct()  # from the rows that are stored
    grid = F.broadcast(states.select(F.col("s").alias("from_state"))).crossJoin(
        F.broadcast(states.select(F.col("s").alias("to_state"))))
    dense = grid.join(counts, ["from_state", "to_state"], "left").withColumn(
        "transitions", F.coalesce("transitions", F.lit(0)).cast("long"))
    row_total = dense.groupBy("from_state").agg(F.sum("transitions").alias("_row"))
    return dense.join(row_total, "from_state").select(
        "from_state", "to_state", "transitions",
        F.try_divide(F.col("transitions").cast("double"), F.when(F.col("_row") > 0, F.col("_row"))).alias("row_share"),
    )


def cohort_retention(df: DataFrame, entity: str, date_col: str, period_col: str,
                     fill_zero: bool = False) -> DataFrame:
    """Distinct entities by (acquisition period, offset) / offset-0 size.

    Acquisition = year of the entity's first date (one ``groupBy`` plus an
    equi-join on the entity).  ``fill_zero`` keeps every offset from 0 to
    the last observed one per cohort with 0 customers (dashboard form);
    otherwise only observed cells (EDA form).
    """
    first = df.groupBy(entity).agg(F.year(F.min(date_col)).alias("acq_year"))
    pairs = df.select(entity, period_col).distinct().join(first, entity)
    cells = pairs.groupBy("acq_year", (F.col(period_col) - F.col("acq_year")).alias("period")).agg(
        F.countDistinct(entity).alias("customers"))
    if fill_zero:
        span = cells.groupBy("acq_year").agg(F.max("period").alias("_maxp"))
        grid = span.select("acq_year", F.explode(F.sequence(F.lit(0), F.col("_maxp"))).alias("period"))
        cells = grid.join(cells, ["acq_year", "period"], "left").withColumn(
            "customers", F.coalesce("customers", F.lit(0)).cast("long"))
    base = cells.where(F.col("period") == 0).select("acq_year", F.col("customers").alias("_base"))
    return cells.join(base, "acq_year", "left").select(
        "acq_year", "period", "customers",
        F.try_divide(F.col("customers").cast("double"), F.when(F.col("_base") > 0, F.col("_base"))).alias("retention"),
    )


def baskets(df: DataFrame, entity: str, item: str, items: Sequence) -> DataFrame:
    """One row an entity: ``bits``, its items as an array of 63-bit sets, bit
    ``n`` of word ``w`` standing for ``items[63 w + n]``.  ``bit_or`` is combined
    map-side, so an entity that holds a third of all rows is one row a task."""
    words = -(-len(items) // 63) or 1
    number = F.try_element_at(F.create_map(*[x for n, v in enumerate(items) for x in (F.lit(v), F.lit(n))]), F.col(item)) if items else F.lit(None).cast("int")
    sets = df.where(F.col(entity).isNotNull()).withColumn("_no", number).groupBy(entity).agg(*[
        F.coalesce(F.bit_or(F.when(F.floor(F.col("_no") / 63) == w, F.expr("shiftleft(1L, _no % 63)"))), F.lit(0).cast("long")).alias(f"_w{w}") for w in range(words)])
    return sets.select(entity, F.array(*[f"_w{w}" for w in range(words)]).alias("bits"))


def association_rules(df: DataFrame, entity: str, item: str, max_items: int = 200) -> DataFrame:
    """Pairwise rules a -> b (a != b) over entities.

    support = entities with both / all entities that have an item; confidence
    = both / entities with a.  Each entity becomes one bit set over the items;
    equal sets are one row with a count, and each distinct set gives its pairs
    with that count, so pairs are never joined and a set that many entities
    have is expanded once.  Every ordered pair of items appears, zero pairs
    included.  An item vocabulary of more than ``max_items`` is an error: the
    pairs grow with its square."""
    pairs = stored(df.select(entity, item).where(F.col(entity).isNotNull() & F.col(item).isNotNull()).distinct(), "entity-items")
    items = [r[0] for r in pairs.select(item).distinct().orderBy(item).limit(max_items + 1).collect()]
    if len(items) > max_items:
        raise ValueError(f"association rules: more than {max_items} items")
    kind = pairs.schema[item].dataType
    sets = stored(baskets(pairs, entity, item, items).groupBy("bits").agg(F.count("*").alias("n")), "baskets")
    values = F.array(*[F.lit(v).cast(kind) for v in items]) if items else F.array().cast(T.ArrayType(kind))
    held = F.filter(F.sequence(F.lit(0), F.lit(max(len(items) - 1, 0))),
                    lambda i: F.get("bits", F.floor(i / 63).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(i, F.lit(63)).cast("int"))) != 0)
    some = sets.select("n", held.alias("h"))
    both = some.select("n", F.explode(F.flatten(F.transform("h", lambda a: F.transform("h", lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("x")).groupBy(
        "x.a", "x.b").agg(F.sum("n").alias("both"))
    # at most max_items squared rows: the counts as a map from pair to entities
    counts = both.agg(F.map_from_entries(F.collect_list(F.struct(F.col("a") * (max_items + 1) + F.col("b"), "both"))).alias("m"))
    total = sets.agg(F.sum("n").alias("_n"))
    numbers = F.sequence(F.lit(0), F.lit(max(len(items) - 1, 0)))
    grid = F.filter(F.flatten(F.transform(numbers, lambda a: F.transform(numbers, lambda b: F.struct(a.alias("a"), b.alias("b"))))), lambda x: x["a"] != x["b"])
    out = counts.crossJoin(F.broadcast(total)).select("m", "_n", F.explode(grid).alias("x")).where(F.lit(len(items) > 1))

    def count(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_element_at("m", a * (max_items + 1) + b), F.lit(0)).cast("double")

    pair, own = count(F.col("x.a"), F.col("x.b")), count(F.col("x.a"), F.col("x.a"))
    return out.select(
        F.get(values, F.col("x.a")).alias("from"), F.get(values, F.col("x.b")).alias("to"),
        (pair / F.col("_n")).alias("support"), F.when(own > 0, pair / own).otherwise(F.lit(0.0)).alias("confidence"))


def event_windows(tx: DataFrame, date_col: str, amount: str, event_flag, before_days: int = 14,
                  after_days: int = 14) -> DataFrame:
    """Revenue per day before / during / after each year's event.

    The fact is read once and reduced to one row per day, with the share of
    its event rows beside it; that series is stored (its length is the
    calendar's) and gives both the yearly spans and the days around them, to
    which the spans (one row per year) are broadcast.  ``during`` uses only
    the event's own rows, divided by its span in days.
    """
    event = F.coalesce(event_flag, F.lit(False))
    daily = stored(tx.groupBy(date_col).agg(
        F.coalesce(F.sum(paise(amount)), F.lit(0)).alias("_rev"), F.sum(F.when(event, paise(amount))).alias("_event_rev"),
        F.max(event).alias("_event")), "daily")
    ev = daily.where("_event").groupBy(F.year(date_col).alias("year")).agg(
        F.min(date_col).alias("_start"), F.max(date_col).alias("_end"), (F.sum("_event_rev") / 100.0).alias("_during"))
    d = F.col(date_col)
    joined = daily.join(
        F.broadcast(ev),
        ((d >= F.date_sub("_start", before_days)) & (d < F.col("_start")))
        | ((d > F.col("_end")) & (d <= F.date_add("_end", after_days))),
        "right",
    )
    sides = joined.groupBy("year", "_start", "_end", "_during").agg(
        F.sum(F.when(d < F.col("_start"), F.col("_rev"))).alias("_b"), F.sum(F.when(d > F.col("_end"), F.col("_rev"))).alias("_a"))
    return sides.select(
        "year",
        (F.coalesce("_b", F.lit(0)) / 100.0 / before_days).alias("before_daily"),
        (F.col("_during") / F.greatest(F.datediff("_end", "_start") + 1, F.lit(1))).alias("during_daily"),
        (F.coalesce("_a", F.lit(0)) / 100.0 / after_days).alias("after_daily"),
    )


def top_k(df: DataFrame, k: int, by: str, tie: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """Top ``k`` rows by ``by`` with deterministic tie-break.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each partition
    keeps its own k best, so only k x #partitions rows reach the final merge.
    """
    key = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(key, *[F.col(t).asc() for t in tie]).limit(k)
