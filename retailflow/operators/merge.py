"""Keyed merges on DataFrames, and the MERGE text for engines that have one.

``merge`` returns the new content of the target. Key comparison is plain SQL
equality, so a null key matches nothing: such target rows stay and such source
rows are inserted. Rows with null keys stay out of joins, or are dealt out by their
position, and thus cannot pile up in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.session import BROADCAST_ROWS, broadcast_if_small, fits_broadcast

#: Tasks over which rows with null keys are dealt in a full join.
NULL_SHARES = 4096


class MergeConflict(ValueError):
    """Two source rows would update the same target row."""


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: str | list[str] | None = "*",
    insert: bool = True,
    check_cardinality: bool = True,
) -> DataFrame:
    """Content of ``target`` after merging ``source`` on ``keys``.

    ``update``: ``"*"`` for all non-key columns, a list of columns, or ``None``
    to leave matched rows as they are. Unmatched source rows are inserted whole
    unless ``insert`` is false. Two source rows that match one target row raise
    ``MergeConflict`` (without ``check_cardinality`` the greatest row wins);
    unmatched duplicates are all inserted.

    A count of the source per key runs first. It picks the plan: a source within
    the broadcast bounds leaves the target unshuffled. A larger source without repeated
    keys is joined once, with one scan and one shuffle of each side. That join cannot
    split the rows of one key, which a keyed target has not; repeated source keys
    take two joins, whose large partitions adaptive execution splits.

    The source is read several times and must give the same rows each time: persist
    or store it if it may not.
    """
    changed = _update_columns(target, keys, update)
    source = source.select(*target.columns)
    keyed_target, loose_target = _split_null_keys(target, keys)
    keyed_source, loose_source = _split_null_keys(source, keys)

    rows, repeated = _key_counts(keyed_source, keys)
    if repeated and changed and check_cardinality:
        _refuse_conflicts(keyed_target, keyed_source, keys)
    small = rows <= BROADCAST_ROWS and fits_broadcast(keyed_source)
    if not small and not repeated:
        return _merge_once(target, source, keys, changed, insert)

    parts = []
    if changed:
        patch = _one_per_key(keyed_source, keys) if repeated else keyed_source
        patch = patch.select(
            *keys, *[F.col(c).alias(f"__new_{c}") for c in changed], F.lit(True).alias("__hit")
        )
        joined = keyed_target.join(F.broadcast(patch) if small else patch, keys, "left")
        parts.append(
            joined.select(
                *[
                    F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
                    if c in changed
                    else F.col(c)
                    for c in target.columns
                ]
            )
        )
        parts.append(loose_target)
    else:
        parts.append(target)
    if insert:
        parts.append(_unmatched(keyed_source, keyed_target, keys, small))
        parts.append(loose_source)
    return reduce(DataFrame.unionByName, parts)


def insert_new(target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Insert source rows whose key is new; on a conflict do nothing.

    Of several source rows with one key, the first by ``order_by`` is inserted.
    A null key conflicts with nothing.
    """
    source = source.select(*target.columns)
    keyed, loose = _split_null_keys(source, keys)
    rest = [c for c in target.columns if c not in keys]
    lead = F.struct(*order_by, *[c for c in rest if c not in order_by])
    firsts = keyed.groupBy(*keys).agg(F.min(lead).alias("__row"))
    firsts = firsts.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in target.columns])
    small = fits_broadcast(keyed.select(*keys))
    fresh = _unmatched(firsts, _split_null_keys(target, keys)[0], keys, small)
    return target.unionByName(fresh).unionByName(loose)


def keyed_update(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Set ``columns`` of the target rows that match; other source rows do nothing."""
    padded = source.select(
        *[
            F.col(f.name) if f.name in source.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return merge(target, padded, keys, update=columns, insert=False)


def field_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert documents field by field.

    Columns that the source has are set, also to null; columns that it lacks
    keep their value, and are null in new documents.
    """
    present = [c for c in target.columns if c in source.columns and c not in keys]
    padded = source.select(
        *[
            F.col(f.name) if f.name in source.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return merge(target, padded, keys, update=present)


def merge_sql(
    target: str,
    staging: str,
    columns: list[str],
    keys: list[str],
    update: str | list[str] | None = "*",
    insert: bool = True,
    quote: str = '"',
) -> str:
    """A MERGE statement with its column lists taken from ``columns``."""

    def q(name: str) -> str:
        return f"{quote}{name}{quote}"

    if update is None:
        changed = []
    else:
        changed = [c for c in columns if c not in keys] if update == "*" else list(update)
    on = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    lines = [f"MERGE INTO {target} t", f"USING {staging} s", f"ON {on}"]
    if changed:
        lines.append("WHEN MATCHED THEN UPDATE SET " + ", ".join(f"{q(c)} = s.{q(c)}" for c in changed))
    if insert:
        names = ", ".join(q(c) for c in columns)
        values = ", ".join(f"s.{q(c)}" for c in columns)
        lines.append(f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")
    return "\n".join(lines)


def _update_columns(target: DataFrame, keys: list[str], update) -> list[str]:
    if update is None:
        return []
    if update == "*":
        return [c for c in target.columns if c not in keys]
    return list(update)


def _any_null(keys: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _no_null(keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def _split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    # Null tests reach the scan, where column statistics skip row groups, so the
    # second read of a file table without null keys touches footers only.
    return df.filter(_no_null(keys)), df.filter(_any_null(keys))


def _key_counts(df: DataFrame, keys: list[str]) -> tuple[int, bool]:
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    row = per_key.agg(F.sum("__n").alias("rows"), F.max("__n").alias("most")).first()
    return row["rows"] or 0, (row["most"] or 0) > 1


def _refuse_conflicts(target: DataFrame, source: DataFrame, keys: list[str]) -> None:
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    repeated = repeated.filter("__n > 1").select(*keys)
    hit = target.select(*keys).join(broadcast_if_small(repeated), keys, "left_semi").first()
    if hit is not None:
        raise MergeConflict(f"more than one source row matches the target row {hit.asDict()}")


def _one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    rows = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row"))
    return rows.select(*keys, "__row.*")


def _merge_once(target: DataFrame, source: DataFrame, keys: list[str], changed: list[str], insert: bool) -> DataFrame:
    """Merge by one join; source keys are unique.

    Rows with a null key match nothing; they get a share number as a further key, which
    deals them over the tasks.
    """

    def dealt(df: DataFrame, first: int, side: str) -> DataFrame:
        # Target rows get even shares, source rows odd ones, so that they never meet.
        share = F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SHARES)) * 2 + first
        return df.withColumns({"__share": F.when(_any_null(keys), share).otherwise(0), side: F.lit(True)})

    left = dealt(target, 2, "__old")
    right = dealt(source, 1, "__hit").withColumnsRenamed({c: f"__new_{c}" for c in [*source.columns, "__share"]})
    same = [F.col(k) == F.col(f"__new_{k}") for k in [*keys, "__share"]]
    joined = left.join(right, reduce(Column.__and__, same), "full_outer" if insert else "left_outer")

    def value(c: str) -> Column:
        taken = F.col("__old").isNull() | F.col("__hit") if c in changed else F.col("__old").isNull()
        return F.when(taken, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def _unmatched(source: DataFrame, target: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """Source rows whose key the target lacks; a repeated key is split at runtime."""
    known = target.select(*keys)
    if small:
        # Only the target keys that occur in the small source leave their partition.
        known = known.join(F.broadcast(source.select(*keys)), keys, "left_semi").distinct()
    # Otherwise both sides come straight from a shuffle, which lets large partitions be split.
    return source.join(known, keys, "left_anti")
