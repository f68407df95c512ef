"""Retention by age: what may go, what it frees. Deleting is left to the owner of the store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.config import CLEANUP_SUBJECT, LAYER_RETENTION_DAYS, RETENTION_RULES, STORAGE_RATE_PER_GB_MONTH

Rules = Sequence[tuple[str, str, int]]


def age_days(last_modified: Column, as_of: Column) -> Column:
    """Whole days between the two times."""
    return F.timestamp_diff("DAY", last_modified, as_of)


def expired(listing: DataFrame, as_of: Column, rules: Rules = RETENTION_RULES) -> DataFrame:
    """Objects strictly older than their rule allows, one row per matching rule.

    ``listing`` has store, path, size_bytes, last_modified. The few rules are literals tested on
    each row, so there is no join at all.
    """
    table = F.array(
        *[F.struct(F.lit(s).alias("store"), F.lit(p).alias("prefix"), F.lit(d).alias("keep_days")) for s, p, d in rules]
    )
    age = age_days(F.col("last_modified"), as_of)
    hits = F.filter(
        table,
        lambda r: (r["store"] == F.col("store")) & F.startswith(F.col("path"), r["prefix"]) & (age > r["keep_days"]),
    )
    return (
        listing.withColumn("rule", F.explode(hits))
        .select("rule.*", "path", "size_bytes", "last_modified", age.alias("age_days"))
    )


def retention_report(listing: DataFrame, as_of: Column, rules: Rules = RETENTION_RULES) -> DataFrame:
    """Files and bytes each rule would free; rules without a hit are listed with 0."""
    freed = expired(listing, as_of, rules).groupBy("store", "prefix", "keep_days").agg(
        F.count(F.lit(1)).alias("deleted_files"), F.sum("size_bytes").alias("bytes_freed")
    )
    all_rules = listing.sparkSession.createDataFrame(list(rules), "store string, prefix string, keep_days int")
    size = F.coalesce("bytes_freed", F.lit(0))
    return all_rules.join(freed, ["store", "prefix", "keep_days"], "left").select(
        "store",
        "prefix",
        "keep_days",
        F.coalesce("deleted_files", F.lit(0)).alias("deleted_files"),
        size.alias("bytes_freed"),
        F.round(size / 1024 / 1024, 2).alias("mb_freed"),
    )


def retention_savings(report: DataFrame, rate: float = STORAGE_RATE_PER_GB_MONTH) -> DataFrame:
    """Totals of a report and what the freed space costs per month."""
    gb = F.sum("bytes_freed") / 1024 / 1024 / 1024
    return report.agg(
        F.sum("deleted_files").alias("total_deleted"),
        F.round(gb, 2).alias("gb_freed"),
        F.round(gb * rate, 2).alias("monthly_savings"),
    )


def cleanup_note(report: DataFrame, run_date: Column, rate: float = STORAGE_RATE_PER_GB_MONTH) -> DataFrame:
    """Subject and body of the run report; no row when nothing is to be deleted."""
    line = F.concat(
        "store", F.lit("/"), "prefix", F.lit(": "), F.col("deleted_files").cast("string"), F.lit(" files, "),
        F.format_string("%.2f MB", "mb_freed"),
    )
    gb = F.sum("bytes_freed") / 1024 / 1024 / 1024
    totals = report.agg(
        F.sum("deleted_files").alias("n"), gb.alias("gb"), F.sort_array(F.collect_list(line)).alias("lines")
    )
    body = F.concat(
        F.lit("S3 Cleanup Report:\nDate: "), F.date_format(run_date, "yyyy-MM-dd"),
        F.lit("\n\nTotal files deleted: "), F.col("n").cast("string"),
        F.format_string("\nTotal storage freed: %.2f GB", "gb"),
        F.format_string("\nMonthly savings: $%.2f", F.col("gb") * rate),
        F.lit("\n\nDetails:\n"), F.concat_ws("\n", "lines"),
    )
    return totals.filter("n > 0").select(F.lit(CLEANUP_SUBJECT).alias("subject"), body.alias("body"))


def within_retention(df: DataFrame, date: Column, layer: str, as_of: Column) -> DataFrame:
    """Rows a layer may still hold, by the age of the data itself."""
    return df.filter(F.datediff(as_of, date) <= LAYER_RETENTION_DAYS[layer])
