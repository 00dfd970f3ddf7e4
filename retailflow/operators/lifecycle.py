"""Order and review life cycles: events, offsets and state at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.functions.time import DAY_SECONDS, month_text, seconds_since, time_literal

PURCHASED = "order_purchase_timestamp"

# Stage name, time column, status set by the stage. The position
# in the list breaks ties between stages with the same time.
ORDER_STAGES = [
    ("purchased", "order_purchase_timestamp", "created"),
    ("approved", "order_approved_at", "approved"),
    ("delivered_carrier", "order_delivered_carrier_date", "shipped"),
    ("delivered_customer", "order_delivered_customer_date", "delivered"),
    ("estimated_delivery", "order_estimated_delivery_date", None),
]

_LATER = [name for name, _, _ in ORDER_STAGES[1:]]

COMPRESSION = 1 / DAY_SECONDS  # one day of data plays in one second

REVIEW_KEYS = ["review_id", "order_id"]
REVIEW_ANSWER_FIELDS = [
    "review_score",
    "review_comment_title",
    "review_comment_message",
    "review_answer_timestamp",
]


def to_events(orders: DataFrame) -> DataFrame:
    """One row per stage that an order reached.

    The whole order row is read once and exploded; stages without a time are
    dropped. ``order_status`` is the status the stage sets.
    """
    stages = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(name).alias("stage"),
                F.col(column).alias("timestamp"),
                (F.lit(status) if status else F.col("order_status")).alias("order_status"),
            )
            for i, (name, column, status) in enumerate(ORDER_STAGES)
        ]
    )
    placed = orders.filter(F.col(PURCHASED).isNotNull())
    rows = placed.select(
        "order_id",
        "customer_id",
        "order_estimated_delivery_date",
        F.col(PURCHASED).alias("purchased_timestamp"),
        F.inline(stages),
    )
    return rows.filter(F.col("timestamp").isNotNull())


def child_events(children: DataFrame, time: str) -> DataFrame:
    """Child rows (with parent times) as events at the parent's ``time``."""
    events = children.withColumnsRenamed({time: "timestamp"})
    if time != PURCHASED:
        events = events.withColumnRenamed(PURCHASED, "purchased_timestamp")
    else:
        events = events.withColumn("purchased_timestamp", F.col("timestamp"))
    return events.filter(F.col("timestamp").isNotNull())


def with_ttl(
    events: DataFrame,
    factor: float = COMPRESSION,
    origin: DataFrame | None = None,
    sort_by: list[str] | None = None,
) -> DataFrame:
    """Offset of each event from the earliest purchase, compressed by ``factor``.

    ``origin`` is the frame that holds ``purchased_timestamp`` of all rows, also
    of those dropped for a missing time; by default the events themselves. The
    minimum is one scalar, computed apart, so no window holds the whole frame.
    Sorting takes extra columns so that equal offsets can be split over tasks.
    """
    origin = events if origin is None else origin
    start = origin.agg(F.min("purchased_timestamp")).scalar()
    out = events.withColumn("ttl", seconds_since(F.col("timestamp"), start) * F.lit(factor))
    return out.orderBy("ttl", *sort_by) if sort_by is not None else out


def state_as_of(events: DataFrame, at: str) -> DataFrame:
    """Order rows as they were at time ``at``, from an event log.

    Same result as applying the events one by one in (time, stage) order: the
    first purchase inserts the order, later stages set status and their own
    date, and a stage that comes before the purchase finds no row and is lost.

    One aggregation by order; it keeps the last time per stage, which is enough
    to tell the last effective stage.
    """
    return folded_state(fold_events(events.filter(F.col("timestamp") <= time_literal(events, "timestamp", at))))


def event_folds(events: DataFrame, *keep: str) -> DataFrame:
    """What the state needs of each event, as the fold of that event alone; ``keep`` names further columns."""
    bought = F.col("stage") == "purchased"
    first_row = F.struct("timestamp", "customer_id", "order_estimated_delivery_date")
    final = F.struct("timestamp", "order_status")
    return events.select(
        "order_id",
        F.when(bought, first_row).alias("first"),
        F.when(F.col("stage") == "estimated_delivery", final).alias("final"),
        *[F.when(F.col("stage") == s, F.col("timestamp")).alias(s) for s in _LATER],
        *keep,
    )


def fold_events(events: DataFrame) -> DataFrame:
    """What the state needs of the events of each order, one row per order."""
    return merge_folds(event_folds(events))


def fold_measures() -> dict[str, Column]:
    """The aggregates that make one fold of many, by column."""
    return {"first": F.min("first"), "final": F.max("final"), **{s: F.max(s) for s in _LATER}}


def merge_folds(folds: DataFrame) -> DataFrame:
    """Folds of parts of an event log as the fold of all of it; parts may overlap."""
    return folds.groupBy("order_id").agg(*[value.alias(c) for c, value in fold_measures().items()])


def folded_state(folds: DataFrame) -> DataFrame:
    """Order rows of a fold; orders without a purchase have none."""
    known = folds.filter(F.col("first").isNotNull()).select(
        "order_id", "first.*", F.col("final.order_status").alias("final_status"), *_LATER
    )
    return _order_state(known, "timestamp", _LATER, "final_status")


def order_state_at(orders: DataFrame, at: str) -> DataFrame:
    """Order rows as they were at time ``at``, from final order rows.

    With one row per order every stage time is at hand, so this needs no shuffle.
    """
    limit = time_literal(orders, PURCHASED, at)
    known = orders.filter(F.col(PURCHASED) <= limit)
    names = [name for name, _, _ in ORDER_STAGES[1:]]
    stages = known.select(
        "order_id",
        F.col(PURCHASED).alias("timestamp"),
        "customer_id",
        "order_estimated_delivery_date",
        F.col("order_status").alias("final_status"),
        *[
            F.when(F.col(column) <= limit, F.col(column)).alias(name)
            for name, column, _ in ORDER_STAGES[1:]
        ],
    )
    return _order_state(stages, "timestamp", names, "final_status")


def _order_state(df: DataFrame, bought: str, stages: list[str], final_status: str) -> DataFrame:
    effective = {s: F.when(F.col(s) >= F.col(bought), F.col(s)) for s in stages}
    latest = F.greatest(F.col(bought), *effective.values())
    status: Column = F.lit("created")
    for name, _, value in ORDER_STAGES[1:]:
        value = F.lit(value) if value else F.col(final_status)
        status = F.when(effective[name] == latest, value).otherwise(status)
    return df.select(
        "order_id",
        "customer_id",
        status.alias("order_status"),
        F.col(bought).alias(PURCHASED),
        *[effective[name].alias(column) for name, column, _ in ORDER_STAGES[1:4]],
        "order_estimated_delivery_date",
    )


def review_events(reviews: DataFrame) -> DataFrame:
    """Created and answered events of reviews; a created event carries no answer."""
    nothing = [F.lit(None).cast(reviews.schema[c].dataType).alias(c) for c in REVIEW_ANSWER_FIELDS]
    stages = [
        ("created", "review_creation_date", nothing),
        ("answered", "review_answer_timestamp", [F.col(c) for c in REVIEW_ANSWER_FIELDS]),
    ]
    rows = [
        F.struct(
            *fields,
            F.lit(stage).alias("stage"),
            F.lit(i).alias("ordinal"),
            F.col(column).alias("timestamp"),
        )
        for i, (stage, column, fields) in enumerate(stages)
    ]
    events = reviews.select(*REVIEW_KEYS, "review_creation_date", F.inline(F.array(*rows)))
    return events.filter(F.col("timestamp").isNotNull())


def review_state(events: DataFrame, at: str) -> DataFrame:
    """Review documents at time ``at``: the last event of each review wins whole."""
    seen = events.filter(F.col("timestamp") <= time_literal(events, "timestamp", at))
    fields = ["review_creation_date", *REVIEW_ANSWER_FIELDS]
    last = F.max_by(F.struct(*fields), F.struct("timestamp", "ordinal")).alias("doc")
    return seen.groupBy(*REVIEW_KEYS).agg(last).select(*REVIEW_KEYS, "doc.*")


def month_list(df: DataFrame, ts: str, compat: bool = False) -> DataFrame:
    """The ``YYYY-MM`` months from the first to the last time.

    ``compat`` steps from the first day seen instead of the first of its month,
    so a last month that is not reached by a whole step is left out.
    """
    bounds = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    lo, hi = F.to_date("lo"), F.to_date("hi")
    if not compat:
        lo, hi = F.trunc(lo, "month"), F.trunc(hi, "month")
    months = F.explode(F.sequence(lo, hi, F.expr("interval 1 month")))
    return bounds.filter(F.col("lo").isNotNull()).select(months.alias("m")).select(
        month_text("m").alias("month")
    ).distinct().orderBy("month")


def stage_counts(events: DataFrame) -> DataFrame:
    """Number of events per stage."""
    return events.groupBy("stage").agg(F.count(F.lit(1)).alias("n_events"))
