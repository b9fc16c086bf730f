"""Row analysis by a pluggable function, and checks of its answers.

The analyser may call a remote model; here it is any function of a batch.  Work is
resumable: rows already answered for a version of the prompt are left out first
(:func:`presslake.operators.records.pending`), and answers are written per partition."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def analyse(frame: DataFrame, call: Callable[[list[dict]], list[dict]], schema: str, version: str, batch: int = 20, retries: int = 3, pause: float = 1.0, key: str | None = None) -> DataFrame:
    """Answers of ``call`` for batches of rows, as (columns of ``schema``, version, error).

    ``call`` gets a list of rows and returns as many answers.  A failing batch is tried
    again with growing pauses; after the last try its rows get the error and nulls, but for ``key``."""
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(batches):
        for b in batches:
            for i in range(0, len(b), batch):
                rows = b.iloc[i : i + batch].to_dict("records")
                answers, error = None, None
                for k in range(retries):
                    try:
                        answers = call(rows)
                        if len(answers) != len(rows):
                            raise ValueError(f"{len(answers)} answers for {len(rows)} rows")
                        error = None
                        break
                    except Exception as e:  # whatever the analyser raises is the row's error
                        answers, error = None, f"{type(e).__name__}: {e}"
                        if k + 1 < retries:
                            time.sleep(pause * 2**k)
                filled = answers or [{key: r.get(key)} for r in rows]
                yield pd.DataFrame([{**{n: a.get(n) for n in names}, "version": version, "error": error} for a in filled], columns=[*names, "version", "error"])

    return frame.mapInPandas(run, f"{schema}, version string, error string")


def analyse_in_parts(frame: DataFrame, call: Callable[[list[dict]], list[dict]], schema: str, version: str, key: str, folder: str, parts: int = 16, **options) -> DataFrame:
    """:func:`analyse` that can be stopped and started again: rows are divided by key into
    ``parts``, and each part's answers are written to ``folder`` when they are there.  Rows with an
    answer of this version and without error are not asked again.  Gives all stored
    answers of the version; ``schema`` holds ``key``."""
    spark = frame.sparkSession
    out = f"{schema}, version string, error string, part int"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stored = lambda: spark.read.schema(out).parquet(folder).where(F.col("version") == version) if fs.exists(path) else spark.createDataFrame([], out)
    part_of = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    for part in range(parts):
        done = stored().where((F.col("part") == part) & F.col("error").isNull())
        todo = frame.where(part_of == part).join(done.select(key).distinct(), key, "left_anti").select(*frame.columns)
        answers = analyse(todo, call, schema, version, key=key, **options).withColumn("part", F.lit(part))
        answers.write.mode("append").partitionBy("version").parquet(folder)
    last = stored().withColumn("_ok", F.col("error").isNull())
    return last.groupBy(key).agg(F.max_by(F.struct(*[c for c in last.columns if c not in ("_ok", "part")]), "_ok").alias("r")).select("r.*")


def no_summary(rows: list[dict]) -> str:
    """The summary hook where no model is configured: no text."""
    return ""


def written_report(frame: DataFrame, write: Callable[[list[dict]], str] = no_summary, most: int = 1000) -> str:
    """Text of ``write`` for the rows of a report; refused beyond ``most`` rows."""
    rows = frame.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return write([r.asDict(recursive=True) for r in rows])


def envelope(frame: DataFrame, job_id: Column, task: str, fields: list[str]) -> DataFrame:
    """(job_id, task, article): jobs with the row as a struct."""
    return frame.select(job_id.alias("job_id"), F.lit(task).alias("task"), F.struct(*fields).alias("article"))


def violations(required: list[str], ranges: dict[str, tuple[float, float]], enums: dict[str, list[str]], arrays: list[str] = ()) -> Column:
    """Errors of an answer, as an array of texts, empty if it holds: missing fields,
    numbers out of range, unknown words, arrays that are null."""
    checks = [F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(f"{c} is missing")) for c in required]
    checks += [F.when(~F.coalesce(F.col(c).between(a, b), F.lit(False)), F.lit(f"{c} is not within {a} to {b}")) for c, (a, b) in ranges.items()]
    checks += [F.when(~F.coalesce(F.col(c).isin(words), F.lit(False)), F.lit(f"{c} is unknown")) for c, words in enums.items()]
    checks += [F.when(F.col(c).isNull(), F.lit(f"{c} is no list")) for c in arrays]
    return F.array_compact(F.array(*checks))


def offline_answers(rows: list[dict]) -> list[dict]:
    """A deterministic analyser for tests and dry runs: counts words, no model."""
    return [{"rec_id": r["rec_id"], "summary": " ".join(str(r.get("body") or "").split()[:12]), "relevance": len(str(r.get("title") or "")) % 21, "raw": json.dumps({"ok": True})} for r in rows]


class Flaky:
    """``call`` behind a failure at the first try of every batch, for dry runs; answers tell the tries."""

    def __init__(self, call: Callable[[list[dict]], list[dict]]):
        self.call, self.tried = call, 0

    def __call__(self, rows: list[dict]) -> list[dict]:
        self.tried += 1
        if self.tried % 2:
            raise TimeoutError("first try")
        return [a | {"tries": 2} for a in self.call(rows)]
