"""Named checks on a frame, evaluated together.

All ratio constraints of a check share one pass over the data. A uniqueness
constraint groups by its column, with partial counts before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.model import ORDER_STATUSES, PAYMENT_TYPES

ERROR, WARNING, SUCCESS = "Error", "Warning", "Success"

# Text patterns of the inferred types.
INTEGRAL_TEXT = r"^(-|\+)? ?\d+$"
FRACTIONAL_TEXT = r"^(-|\+)? ?\d*\.\d*$"
BOOLEAN_TEXT = r"^(true|false)$"

INTEGRAL, FRACTIONAL, NUMERIC, BOOLEAN, STRING = (
    "Integral",
    "Fractional",
    "Numeric",
    "Boolean",
    "String",
)


class CheckFailed(RuntimeError):
    """A check of level Error did not hold on a non-empty batch."""


@dataclass(frozen=True)
class Constraint:
    """The ratio ``kind`` of ``column`` must be 1."""

    kind: str
    column: str
    values: tuple = ()
    type_name: str = ""

    @property
    def label(self) -> str:
        extra = ",".join(map(str, self.values)) or self.type_name
        return f"{self.kind}({self.column}{',' + extra if extra else ''})"


@dataclass(frozen=True)
class Check:
    """A named list of constraints with a level; built by chaining."""

    name: str
    level: str = ERROR
    constraints: tuple[Constraint, ...] = field(default=())

    def _with(self, kind: str, column: str, values=(), type_name="") -> Check:
        new = Constraint(kind, column, tuple(values), type_name)
        return Check(self.name, self.level, (*self.constraints, new))

    def is_complete(self, column: str) -> Check:
        return self._with("Completeness", column)

    def is_unique(self, column: str) -> Check:
        return self._with("Uniqueness", column)

    def is_contained_in(self, column: str, values: list) -> Check:
        return self._with("Containment", column, values)

    def is_positive(self, column: str) -> Check:
        return self._with("Positive", column)

    def is_non_negative(self, column: str) -> Check:
        return self._with("NonNegative", column)

    def has_data_type(self, column: str, type_name: str) -> Check:
        return self._with("DataType", column, type_name=type_name)


def type_class(df: DataFrame, column: str) -> Column:
    """Inferred type class of each value; null for null.

    Typed numeric columns are classified by their type, so the text form of
    large floating numbers does not matter.
    """
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, T.IntegralType):
        name = F.lit(INTEGRAL)
    elif isinstance(kind, T.NumericType):
        name = F.lit(FRACTIONAL)
    elif isinstance(kind, T.BooleanType):
        name = F.lit(BOOLEAN)
    elif isinstance(kind, T.StringType):
        name = (
            F.when(value.rlike(INTEGRAL_TEXT), F.lit(INTEGRAL))
            .when(value.rlike(FRACTIONAL_TEXT), F.lit(FRACTIONAL))
            .when(value.rlike(BOOLEAN_TEXT), F.lit(BOOLEAN))
            .otherwise(F.lit(STRING))
        )
    else:
        name = F.lit(STRING)
    return F.when(value.isNotNull(), name)


def run_checks(df: DataFrame, check: Check) -> DataFrame:
    """One row per constraint with its metric value and verdict.

    A constraint on a missing column fails with a message; it does not raise.
    On an empty frame every ratio is undefined, and thus fails.
    """
    known = [c for c in check.constraints if c.column in df.columns]
    ratios = [c for c in known if c.kind != "Uniqueness"]
    parts = []
    if ratios:
        values = df.agg(
            *[_ratio(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(ratios)]
        )
        rows = [
            F.struct(F.lit(c.label).alias("constraint"), F.col(f"v{i}").alias("value"), _null("problem"))
            for i, c in enumerate(ratios)
        ]
        parts.append(values.select(F.inline(F.array(*rows))))
    for c in known:
        if c.kind == "Uniqueness":
            parts.append(
                uniqueness(df, [c.column]).select(
                    F.lit(c.label).alias("constraint"), F.col("uniqueness").alias("value"), _null("problem")
                )
            )
    missing = [c for c in check.constraints if c.column not in df.columns]
    if missing:
        text = "Input data does not include column {}!"
        data = [(c.label, None, text.format(c.column)) for c in missing]
        schema = "constraint string, value double, problem string"
        parts.append(df.sparkSession.createDataFrame(data, schema))
    return _verdicts(reduce(DataFrame.unionByName, parts), check)


def uniqueness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of non-null rows whose value occurs exactly once."""
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    per_value = df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    once = F.sum(F.when(F.col("__n") == 1, 1).otherwise(0))
    return per_value.agg((once / F.sum("__n")).cast("double").alias("uniqueness"))


def has_errors(result: DataFrame) -> bool:
    return not result.filter(F.col("check_status") == ERROR).isEmpty()


def gate(result: DataFrame, df: DataFrame) -> None:
    """Raise when a check of level Error failed and the batch has rows."""
    failed = [
        f"{r['constraint']}: {r['constraint_message']}"
        for r in result.filter("check_status = 'Error' AND constraint_status = 'Failure'").collect()
    ]
    if failed and not df.isEmpty():
        raise CheckFailed("; ".join(failed))


def check_summary(result: DataFrame) -> DataFrame:
    """One pass/fail row per check."""
    return result.groupBy("check", "check_level").agg(
        F.every(F.col("constraint_status") == SUCCESS).alias("passed"),
        F.count_if(F.col("constraint_status") != SUCCESS).alias("n_failed"),
    )


def _null(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _ratio(df: DataFrame, c: Constraint) -> Column:
    value = F.col(c.column)
    if c.kind == "Completeness":
        return F.try_divide(F.count(value), F.count(F.lit(1)))
    if c.kind == "Containment":
        return F.avg(F.when(value.isNull() | value.isin(*c.values), 1).otherwise(0))
    if c.kind == "Positive":
        return F.avg(F.when(value.isNull() | (value > 0), 1).otherwise(0))
    if c.kind == "NonNegative":
        return F.avg(F.when(value.isNull() | (value >= 0), 1).otherwise(0))
    if c.kind == "DataType":
        accepted = [INTEGRAL, FRACTIONAL] if c.type_name == NUMERIC else [c.type_name]
        hit = type_class(df, c.column).isin(*accepted)
        return F.coalesce(F.avg(F.when(hit, 1).when(value.isNotNull(), 0)), F.lit(0))
    raise ValueError(f"unknown constraint {c.kind}")


def _verdicts(values: DataFrame, check: Check) -> DataFrame:
    ok = F.coalesce(F.col("value") == 1.0, F.lit(False))
    message = (
        F.when(ok, F.lit(""))
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("value").isNull(), F.lit("Empty state: all input values were NULL."))
        .otherwise(
            F.concat(F.lit("Value: "), F.col("value").cast("string"),
                     F.lit(" does not meet the constraint requirement!"))
        )
    )
    rows = values.select(
        F.lit(check.name).alias("check"),
        F.lit(check.level).alias("check_level"),
        "constraint",
        F.when(ok, F.lit(SUCCESS)).otherwise(F.lit("Failure")).alias("constraint_status"),
        message.alias("constraint_message"),
        "value",
    )
    # The window holds one row per constraint of the check, whatever the data size.
    all_ok = F.every(F.col("constraint_status") == SUCCESS).over(Window.partitionBy("check"))
    return rows.select(
        "check",
        "check_level",
        F.when(all_ok, F.lit(SUCCESS)).otherwise(F.lit(check.level)).alias("check_status"),
        "constraint",
        "constraint_status",
        "constraint_message",
        "value",
    )


# ---------------------------------------------------------------------------
# The rule set of each fact table.
# ---------------------------------------------------------------------------
ORDERS_CHECK = (
    Check("orders")
    .is_unique("order_id")
    .is_complete("order_id")
    .is_complete("customer_id")
    .is_complete("order_purchase_timestamp")
    .is_complete("order_estimated_delivery_date")
    .is_contained_in("order_status", ORDER_STATUSES)
)

ORDER_ITEMS_CHECK = (
    Check("order_items")
    .is_complete("order_id")
    .is_complete("seller_id")
    .is_complete("product_id")
    .is_complete("price")
    .is_positive("price")
    .has_data_type("price", NUMERIC)
    .is_complete("freight_value")
    .is_positive("freight_value")
    .has_data_type("freight_value", NUMERIC)
    .is_complete("order_item_id")
    .is_positive("order_item_id")
    .has_data_type("order_item_id", INTEGRAL)
)

ORDER_PAYMENTS_CHECK = (
    Check("order_payments")
    .is_complete("order_id")
    .has_data_type("payment_value", FRACTIONAL)
    .has_data_type("payment_sequential", INTEGRAL)
    .has_data_type("payment_installments", INTEGRAL)
    .is_contained_in("payment_type", PAYMENT_TYPES)
)

ORDER_REVIEWS_CHECK = (
    Check("order_reviews")
    .is_complete("order_id")
    .is_complete("review_id")
    .is_complete("review_creation_date")
    .has_data_type("review_score", INTEGRAL)
)

CHECKS = {
    c.name: c for c in (ORDERS_CHECK, ORDER_ITEMS_CHECK, ORDER_PAYMENTS_CHECK, ORDER_REVIEWS_CHECK)
}
