"""Normalising timestamps in mixed notations and time zones to UTC.

See :mod:`presslake.functions.instants` for the reading of one batch."""

from __future__ import annotations

from functools import reduce
from zoneinfo import available_timezones

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions.instants import build_tables, to_micros, use_tables

OUT = "table_name string, rec_id bigint, utc_micros bigint"


def normalise_timestamps(tables: dict[str, tuple[DataFrame, str, str]], registry: DataFrame) -> DataFrame:
    """Instants of the date texts of several tables, as (table_name, rec_id, utc_micros).

    ``tables`` maps a name to (frame, text column, source column); the source
    column refers to the registry's column of the same name (``source_name`` or
    ``source_id``).  ``registry`` gives ``time_zone``, ``date_order`` and
    ``calendar`` of a source; it is joined, so Spark broadcasts it only while its
    measured size is under the session's threshold.

    Rows without a readable, existing date are left out: null, blank or unreadable
    text, impossible dates, a year alone, and text without zone whose source is
    null or unknown.  Rows without rec_id are left out.  Repeated rows
    each give their row; columns of the tables beyond the named ones are not read.
    Only columns needed are scanned and nothing is shuffled but, if large, the
    registry join.  Zone transitions are tabled on the
    driver and shipped with the version of the zone database.
    """
    parts = []
    for name, (frame, text, source) in tables.items():
        rows = frame.select(
            F.lit(name).alias("table_name"), F.col("rec_id").cast("bigint").alias("rec_id"),
            F.col(text).alias("text"), F.col(source).alias("source"),
        ).where(F.col("rec_id").isNotNull() & (F.length("text") >= 6))
        zones = registry.where(F.col(source).isNotNull()).select(F.col(source).alias("source"), "time_zone", "date_order", "calendar").dropDuplicates(["source"])
        parts.append(rows.join(zones, "source", "left").select("table_name", "rec_id", "text", "time_zone", "date_order", "calendar"))
    # Of the registry's zone names those that the zone database has, some hundreds at most.
    named = registry.where(F.col("time_zone").isin(sorted(available_timezones()))).select("time_zone").distinct().collect()
    shipped = registry.sparkSession.sparkContext.broadcast(build_tables(r[0] for r in named))

    def read(batches):
        use_tables(shipped.value)
        for b in batches:
            micros, ok = to_micros(b["text"].tolist(), b["time_zone"].tolist(), b["date_order"].tolist(), b["calendar"].tolist())
            yield pd.DataFrame({"table_name": b["table_name"][ok], "rec_id": b["rec_id"][ok], "utc_micros": micros[ok]})

    return reduce(DataFrame.unionByName, parts).mapInPandas(read, OUT)
