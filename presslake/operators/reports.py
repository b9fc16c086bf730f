"""Roll-ups, ranking, time buckets and report columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.functions.dates import month_week, week_number


def ranked(frame: DataFrame, order: list[Column], limit: int, name: str = "rank") -> DataFrame:
    """The first ``limit`` rows in order with their rank from 1: a bounded top-k per
    partition, merged, so no full sort; the rank window sees ``limit`` rows only."""
    top = frame.orderBy(*order).limit(limit)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def top_per_group(frame: DataFrame, group: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each group with their rank; Spark limits groups before the
    shuffle, so a group with a third of all rows moves few."""
    return frame.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= k)


def frequency(frame: DataFrame, column: str, name: str = "n") -> DataFrame:
    return frame.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def exploded_frequency(frame: DataFrame, column: str, default: str, out: str, name: str = "n") -> DataFrame:
    """Counts over the values of an array; rows without any count for ``default``."""
    values = F.when(F.coalesce(F.size(column), F.lit(0)) > 0, F.col(column)).otherwise(F.array(F.lit(default)))
    return frame.select(F.explode(values).alias(out)).groupBy(out).agg(F.count(F.lit(1)).alias(name))


def source_rollup(frame: DataFrame, keys: list[str], status: str, date: str) -> DataFrame:
    """Rows, successes, failures and the last date per source."""
    ok = F.col(status) == "success"
    return frame.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(ok).alias("success"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed"), F.max(date).alias("latest")
    )


def zero_kept(counts: DataFrame, keys: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Counts for all keys, 0 where there are none."""
    return keys.join(counts, column, "left").select(column, F.coalesce(name, F.lit(0)).cast("bigint").alias(name))


def company_rollup(frame: DataFrame, companies: str, country: str, kind: str, title: str, score: str, date: str) -> DataFrame:
    """Per company (case aside) and country: its kinds, mentions, number of distinct
    titles, highest score and last date.  Titles themselves are in :func:`company_titles`,
    as a common company has more than a row should hold.  Counts are per title first,
    so that a common company is summed before the shuffle."""
    rows = frame.select(F.explode(companies).alias("company"), country, kind, title, score, date)
    first = rows.groupBy(F.lower("company").alias("company_key"), country, title).agg(
        F.collect_set(kind).alias("kinds"), F.count(F.lit(1)).alias("m"), F.max(score).alias("s"), F.max(date).alias("d")
    )  # kinds are a handful
    return first.groupBy("company_key", country).agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds")))), ", ").alias("kinds"), F.sum("m").alias("mentions"), F.count(title).alias("titles"),
        F.max("s").alias("max_score"), F.max("d").alias("latest"),
    )


def company_titles(frame: DataFrame, companies: str, country: str, title: str, order: str) -> DataFrame:
    """(company_key, country, title, first_order, mentions): the titles that name a company."""
    rows = frame.select(F.explode(companies).alias("company"), country, title, order)
    return rows.groupBy(F.lower("company").alias("company_key"), country, title).agg(F.min(order).alias("first_order"), F.count(F.lit(1)).alias("mentions"))


def week_counts(frame: DataFrame, date: str, start: str, weeks: int) -> DataFrame:
    """Rows per week of seven days from ``start``, weeks without rows kept."""
    first = F.to_date(F.lit(start))
    week = week_number(F.col(date), first)
    counts = frame.withColumn("week_no", week).where(F.col("week_no").between(1, weeks)).groupBy("week_no").agg(F.count(F.lit(1)).alias("n"))
    keys = frame.sparkSession.range(1, weeks + 1).select(F.col("id").cast("int").alias("week_no"))
    return zero_kept(counts, keys, "week_no")


def with_week(frame: DataFrame, date: str, start: str) -> DataFrame:
    return frame.withColumns({"week_no": week_number(F.col(date), F.to_date(F.lit(start))), "month_week": month_week(F.col(date))})


def chunked(frame: DataFrame, order: list[Column], size: int) -> DataFrame:
    """Rows with row_no from 1 in order and chunk_no, batches of ``size``.  Rows are
    sorted in range partitions and numbered there; only the counts per partition are
    summed up, so no single task sees all rows."""
    from presslake.session import cut_lineage

    names = frame.columns
    spread = frame.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.monotonically_increasing_id().alias("_id"))
    spread = cut_lineage(spread.select(*names, F.shiftright("_id", 33).alias("_p"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_n")))
    sizes = spread.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = sizes.select("_p", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    out = spread.join(F.broadcast(before), "_p").withColumn("row_no", F.col("_b") + F.col("_n") + 1)  # one row per partition
    return out.withColumn("chunk_no", F.floor((F.col("row_no") - 1) / size) + 1).select(*names, "row_no", "chunk_no")


def sections(frame: DataFrame, categories: str, rules: dict[str, list[str]], default: str) -> DataFrame:
    """One row per section an article belongs to: those whose categories overlap, else ``default``."""
    hits = F.array_compact(F.array(*[F.when(F.arrays_overlap(categories, F.array(*[F.lit(c) for c in cs])), F.lit(s)) for s, cs in rules.items()]))
    return frame.withColumn("section", F.explode(F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(default)))))


def first_by_priority(categories: str, priority: list[str], default: str) -> Column:
    """The first of ``priority`` that the array holds, else ``default``."""
    ordered = F.array(*[F.lit(p) for p in priority])
    return F.coalesce(F.try_element_at(F.filter(ordered, lambda p: F.array_contains(categories, p)), F.lit(1)), F.lit(default))
