"""Problem 3: lines that a source repeats in many of its documents.

Texts are normalised (case, white space, digits) and cut into content-defined
chunks by a rolling hash; a line break always cuts, as the result is stated in
lines.  Distinct documents are counted per source and chunk.  Every line of a
repeated kind consists of repeated chunks, so the chunks that pass select the
lines whose exact number of documents is then counted."""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.encoding import text_slices
from presslake.session import cut_lineage

MIN_RECORDS, MIN_SHARE = 8, 0.05
WINDOW = 16  # characters seen by the rolling hash
CUT_BITS = 5  # a cut every 32 characters on average
SLICE = 250_000  # characters worked on at once, but for a longer line: some 100 bytes each
_DROP = re.compile(r"[\s\d]+")
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def line_key(line: str) -> str:
    """What two equal lines share: letters in one case, without white space and digits."""
    return _DROP.sub("", line.casefold())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunk_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line index, hash) of every content-defined chunk of non-empty ``lines``."""
    if not lines:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    first = np.zeros(len(codes), bool)
    starts = np.cumsum(lengths) - lengths
    first[starts] = True
    gear = _mix(codes + _B)
    offset = np.arange(len(codes)) - np.repeat(starts, lengths)
    # The rolling hash of the last WINDOW characters, by doubling; characters of the line before don't count.
    h, width = gear.copy(), 1
    while width < WINDOW:
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width] << np.uint64(width)
        h += np.where(offset >= width, shifted, np.uint64(0))
        width *= 2
    cut = first.copy()
    cut[1:] |= ((h >> np.uint64(40)) & np.uint64((1 << CUT_BITS) - 1))[:-1] == 0
    begin = np.flatnonzero(cut)
    with np.errstate(over="ignore"):
        power = np.concatenate(([np.uint64(1)], np.full(len(codes) - 1, _B, np.uint64))).cumprod()
        inverse = np.concatenate(([np.uint64(1)], np.full(len(codes) - 1, _B_INVERSE, np.uint64))).cumprod()
        value = _mix(np.add.reduceat(gear * power, begin) * inverse[begin])
    owner = np.repeat(np.arange(len(lines)), lengths)[begin]
    return owner, value.view(np.int64)


def _lines_of(batch: pd.DataFrame):
    """Row, number, key and whether it is the first of its kind in the record, of all lines that can be cases."""
    row, number, keys, fresh = [], [], [], []
    for i, text in enumerate(batch["text"]):
        seen = set()
        for n, line in enumerate(text.split("\n"), 1):
            if key := line_key(line):
                row.append(i)
                number.append(n)
                keys.append(key)
                fresh.append(key not in seen)
                seen.add(key)
    return np.array(row, np.int64), number, keys, np.array(fresh, bool)


def _chunks(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`chunk_hashes` in parts of bounded size."""
    owners, values = [], []
    for i, j in text_slices(keys, SLICE):
        owner, value = chunk_hashes(keys[i:j])
        owners.append(owner + i)
        values.append(value)
    return np.concatenate(owners), np.concatenate(values)


def _list_lines(batches):
    for b in (part.iloc[i:j] for part in batches for i, j in text_slices(part["text"].tolist(), SLICE)):
        row, number, keys, fresh = _lines_of(b)
        if not len(row):
            continue
        owner, value = _chunks(keys)
        lead = value[np.searchsorted(owner, np.arange(len(keys)))]
        # Chunks that are new in their record, so that a record counts once for each.
        new = pd.DataFrame({"line": owner, "row": row[owner], "chunk": value}).drop_duplicates(["row", "chunk"])
        parts = np.split(new["chunk"].to_numpy(), np.searchsorted(new["line"].to_numpy(), np.arange(1, len(keys))))
        yield pd.DataFrame(
            {
                "rec_id": b["rec_id"].to_numpy()[row], "source": b["source"].to_numpy()[row], "line_no": np.array(number, np.int32), "lead": lead, "new_chunks": parts,
                "line": [blake2b(k.encode("utf-8", "surrogatepass"), digest_size=16).digest() for k in keys], "fresh": fresh,
            }
        )


def repeated_lines(
    frame: DataFrame, text: str = "content_text", source: str = "source_name", min_records: int = MIN_RECORDS, min_share: float = MIN_SHARE
) -> DataFrame:
    """(rec_id, line_no) of lines that occur in at least ``min_records`` records and
    ``min_share`` of the records with text of their source.

    Lines are the pieces between line feeds, counted from 1.  Rows with null source
    or rec_id or null or empty text are left out; lines of white space and digits only are no
    cases.  A line twice in a record counts once; repeated rows count as records.
    Lines are made once and kept; counts are summed before the shuffle, so one source with a third of all rows
    makes no hot task."""
    docs = frame.select(F.col("rec_id").cast("bigint").alias("rec_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    docs = docs.where("source is not null and text <> '' and rec_id is not null")
    needed = docs.groupBy("source").agg(F.greatest(F.lit(min_records), F.ceil(F.count(F.lit(1)) * F.lit(min_share) - F.lit(1e-9))).alias("least"))
    lines = cut_lineage(docs.mapInPandas(_list_lines, "rec_id bigint, source string, line_no int, lead bigint, new_chunks array<bigint>, line binary, fresh boolean"))
    chunks = lines.select("source", F.explode("new_chunks").alias("lead")).groupBy("source", "lead").agg(F.count(F.lit(1)).alias("n"))
    frequent = chunks.where(F.col("n") >= min_records).join(needed, "source").where("n >= least").select("source", "lead")
    near = lines.drop("new_chunks").join(frequent, ["source", "lead"]).drop("lead")
    exact = near.where("fresh").groupBy("source", "line").agg(F.count(F.lit(1)).alias("n")).join(needed, "source").where("n >= least")
    return near.join(exact.select("source", "line"), ["source", "line"], "left_semi").select("rec_id", "line_no")


def without_repeated_lines(frame: DataFrame, text: str = "content_text", source: str = "source_name", **limits) -> DataFrame:
    """``frame`` with the repeated lines cut out of ``text``; rows without any stay as
    they are, and null stays null.  Needs a unique rec_id."""
    cut = repeated_lines(frame, text, source, **limits).groupBy("rec_id").agg(F.collect_set("line_no").alias("_cut_lines"))
    lines = F.split(F.col(text), "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.coalesce(F.array_contains("_cut_lines", (i + 1).cast("int")), F.lit(False)))
    return frame.join(cut, "rec_id", "left").withColumn(text, F.when(F.col("_cut_lines").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))).drop("_cut_lines")
