"""Change data: upserts by key and sequence, and the difference of two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.operators.silver import latest_per_key

DELETE = "operation_type = 'DELETE'"


def cdc_apply(current: DataFrame, changes: DataFrame, keys: Sequence[str], sequence_by: str,
              delete_when: str = DELETE, except_columns: Sequence[str] = ("operation_type",),
              ties: Sequence[str] = ()) -> DataFrame:
    """``current`` after ``changes``: per key the row with the highest sequence wins, deletes remove it.

    A change older than the current row is ignored; on equal sequence the smaller ``ties`` win, then the
    change. With ties over all values the result does not depend on the order of arrival. Without an
    ``operation_type`` column every change is an upsert. One shuffle, no join.
    """
    deletes = F.coalesce(F.expr(delete_when), F.lit(False)) if _can_evaluate(changes, delete_when) else F.lit(False)
    old = current.withColumns({"_new": F.lit(0), "_delete": F.lit(False)})
    new = changes.withColumns({"_new": F.lit(1), "_delete": deletes}).drop(*except_columns)
    merged = old.drop(*except_columns).unionByName(new, allowMissingColumns=True)
    winner = latest_per_key(merged, keys, [F.col(sequence_by).desc(), *map(F.col, ties), F.col("_new").desc()])
    return winner.filter(~F.col("_delete")).drop("_new", "_delete")


def _can_evaluate(df: DataFrame, condition: str) -> bool:
    """FALSE only for the default condition on a feed without its column; other conditions must resolve."""
    return condition != DELETE or "operation_type" in df.columns


CHANGE_TYPE = "_change_type"
INSERT, DELETED, BEFORE, AFTER = "insert", "delete", "update_preimage", "update_postimage"


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed between two versions of a table: both images of an update, inserts and deletes.

    A column that one version lacks is NULL there, so a gained or lost value is a change.
    """
    types = {c: t.dataType for df in (new, old) for c, t in zip(df.columns, df.schema.fields)}
    values = [c for c in dict.fromkeys(new.columns + old.columns) if c not in keys]

    def packed(df: DataFrame, name: str) -> DataFrame:
        own = [F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in values]
        return df.select(*keys, F.struct(*own).alias(name))

    before, after = packed(old, "_old"), packed(new, "_new")
    row = F.col

    def image(side: str, kind: str):
        return F.struct(row(side).alias("image"), F.lit(kind).alias(CHANGE_TYPE))

    images = (
        F.when(row("_old").isNull(), F.array(image("_new", INSERT)))
        .when(row("_new").isNull(), F.array(image("_old", DELETED)))
        .otherwise(F.array(image("_old", BEFORE), image("_new", AFTER)))
    )
    return (
        before.join(after, list(keys), "full")
        .filter(~row("_old").eqNullSafe(row("_new")))
        .select(*keys, F.explode(images).alias("_c"))
        .select(*keys, "_c.image.*", f"_c.{CHANGE_TYPE}")
    )


def post_images(feed: DataFrame) -> DataFrame:
    """Only new states: inserts and the after image of updates."""
    return feed.filter(F.col(CHANGE_TYPE).isin(INSERT, AFTER))
