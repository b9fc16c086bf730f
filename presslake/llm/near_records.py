"""Problem 6: records that share most of their content, over a whole table.

Exact similarity join on sets of word n-grams, by vertical partitioning.  All
n-grams have one global order, rare ones first, which is cut into fragments: ranges
of about equal numbers of occurrences.  Every set falls into one segment per
fragment; overlaps of a pair are counted in each fragment by itself and summed.

What keeps the frequent fragments out: if two sets of sizes m and n are similar
enough they share at least a = ceil(t / (1 + t) * (m + n)) n-grams, so their k-th
shared n-gram in the order has at least a - k + 1 places left in either set.
Joining only places that fulfil this finds k shared n-grams of every similar pair
and few of others; a pair with k of them is then counted over the segments of all
fragments.  No pair is lost and none is capped.  An n-gram that very many sets hold
is joined by size classes, which only neighbours share, so that it is no hot key.

The order comes from counts in a sketch of fixed size; collisions change how rare
an n-gram is taken to be, never the result.  Equal sets are joined once."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.encoding import text_slices
from presslake.session import cut_lineage, if_small

#: Cells of the count sketch, a byte each: 4 MB at any size of the data.
SKETCH_BITS = 22
SKETCH_CELLS = 1 << SKETCH_BITS
#: The sketch travels in blocks of so many cells.
BLOCK_CELLS = 1 << 16
#: Fragments of the global order.
FRAGMENTS = 8
#: Shared n-grams asked of a pair before its overlap is counted in full.
LEAST_SHARED = 8
#: Occurrences from which an n-gram is joined by size classes.
HOT = 1 << 12
TOKEN = regex.compile(r"[一-鿿]|[\p{L}\p{Nd}--[一-鿿]]+", regex.V1)
_FACTORS = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, 65)]
class _Hashes(dict):
    """Hashes of tokens, made when first asked for."""

    def __missing__(self, token: str) -> int:
        h = self[token] = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        return h


_hashes = _Hashes()


def ngrams_of(texts: list[str], n: int = 4) -> list[np.ndarray]:
    """For each text its distinct hashed runs of ``n`` consecutive tokens in lower case,
    ascending; the runs of all texts are hashed together."""
    if len(_hashes) > 1_000_000:
        _hashes.clear()
    tokens = [TOKEN.findall(t.lower()) for t in texts]
    lengths = [len(t) for t in tokens]
    ids = np.fromiter((h for t in tokens for h in map(_hashes.__getitem__, t)), np.uint64, sum(lengths))
    runs = np.zeros(max(0, len(ids) - n + 1), np.uint64)  # those over the end of a text are not taken
    for k in range(n):
        part = ids[k : k + len(runs)] ^ np.uint64(_FACTORS[n + k] >> 1)
        runs = (runs ^ (part * np.uint64(_FACTORS[k]))) * np.uint64(0xFF51AFD7ED558CCD)
        runs ^= runs >> np.uint64(29)
    out, first, runs = [], 0, runs.view(np.int64)
    for length in lengths:
        own = np.sort(runs[first : first + max(0, length - n + 1)])
        out.append(own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) else own)
        first += length
    return out


def ngram_set(text: str, n: int = 4) -> np.ndarray:
    return ngrams_of([text], n)[0]


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams.view(np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def ngram_sets(rows: DataFrame, n: int = 4) -> DataFrame:
    """(rec_id, grams) of ``rows`` (rec_id, text); texts of fewer than n tokens are left out."""

    def build(batches):
        for b in batches:
            texts, recs = b["text"].tolist(), b["rec_id"].to_numpy()
            for i, j in text_slices(texts):
                sets = ngrams_of(texts[i:j], n)
                kept = [k for k, s in enumerate(sets) if len(s)]
                if kept:
                    yield pd.DataFrame({"rec_id": recs[i:j][kept], "grams": [sets[k] for k in kept]})

    return rows.mapInPandas(build, "rec_id bigint, grams array<bigint>")


def _code(counts: np.ndarray) -> np.ndarray:
    """Counts in a byte: 0 for none, 1 for one, then eighths of the logarithm."""
    return np.where(counts > 0, 1 + np.minimum(254, (8 * np.log2(np.maximum(counts, 1))).astype(np.int64)), 0).astype(np.uint8)


def _sketch(sets: DataFrame) -> np.ndarray:
    """The code of every cell.  Tasks send blocks of their counts, compressed; with
    many tasks blocks are added up in groups first, so that no task sees all of them."""
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    groups = int(np.ceil(np.sqrt(tasks)))

    def count(batches):
        from pyspark import TaskContext

        cells = np.zeros(SKETCH_CELLS, np.int64)
        for b in batches:
            if len(b):
                used, n = np.unique(_cells(np.concatenate([np.asarray(g, np.int64) for g in b["grams"]])), return_counts=True)
                cells[used] += n
        part = TaskContext.get().partitionId() % groups
        for block in range(SKETCH_CELLS // BLOCK_CELLS):
            mine = cells[block * BLOCK_CELLS : (block + 1) * BLOCK_CELLS]
            if mine.any():
                yield pd.DataFrame({"block": np.array([block], np.int32), "part": np.array([part], np.int32), "data": [zlib.compress(mine.tobytes(), 1)]})

    def total(rows: pd.DataFrame) -> np.ndarray:
        cells = np.zeros(BLOCK_CELLS, np.int64)
        for data in rows["data"]:
            cells += np.frombuffer(zlib.decompress(data), np.int64)
        return cells

    def add(key, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": np.array([key[0]], np.int32), "part": np.array([key[1]], np.int32), "data": [zlib.compress(total(rows).tobytes(), 1)]})

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": np.array([key[0]], np.int32), "code": [_code(total(rows)).tobytes()]})

    blocks = sets.select("grams").mapInPandas(count, "block int, part int, data binary")
    if tasks > 64:
        blocks = blocks.groupBy("block", "part").applyInPandas(add, "block int, part int, data binary")
    codes = np.zeros(SKETCH_CELLS, np.uint8)
    for block, code in blocks.groupBy("block").applyInPandas(pack, "block int, code binary").collect():  # SKETCH_CELLS bytes in all
        codes[block * BLOCK_CELLS : (block + 1) * BLOCK_CELLS] = np.frombuffer(code, np.uint8)
    return codes


def _cuts(codes: np.ndarray) -> np.ndarray:
    """Codes at which fragments begin, so that each has about as many occurrences; a
    cell of one is in no overlap and opens the first."""
    n = np.bincount(codes, minlength=256) * np.exp2((np.arange(256) - 1) / 8)
    n[:2] = 0
    share = np.cumsum(n) / max(1.0, n.sum())
    return np.unique(np.searchsorted(share, np.arange(1, FRAGMENTS) / FRAGMENTS) + 1).astype(np.uint8)


def _least_overlap(m, n, t: float):
    return F.ceil((m + n) * F.lit(t / (1 + t)) - F.lit(1e-9))


def similar_sets(sets: DataFrame, threshold: float = 0.5, hot: int = HOT) -> DataFrame:
    """(a, b, shared, size_a, size_b) of pairs of distinct sets (rec_id, grams) whose
    Jaccard similarity reaches ``threshold``; the smaller set is a, of equal ones the
    one with the lesser rec_id."""
    codes = _sketch(sets)
    cuts, hot_code = _cuts(codes), int(_code(np.array([hot]))[0])
    shipped = sets.sparkSession.sparkContext.broadcast(codes.tobytes())
    classes_apart = int(np.ceil(np.log2(1 / threshold) * 2))  # size classes are half octaves

    def place(batches):
        sketch = np.frombuffer(shipped.value, np.uint8)
        for b in batches:
            recs, sizes, places, grams, seen_as = [], [], [], [], []
            for rec, g in zip(b["rec_id"], b["grams"]):
                g = np.asarray(g, np.int64)
                seen = sketch[_cells(g)]
                order = np.lexsort((g, seen))
                n = len(g)
                head = order[: n - int(np.ceil(threshold * n - 1e-9)) + LEAST_SHARED]
                at = np.flatnonzero(seen[head] > 1)  # a cell of one belongs to a single record
                recs.append(np.full(len(at), rec))
                sizes.append(np.full(len(at), n, np.int32))
                places.append(at.astype(np.int32))
                grams.append(g[head[at]])
                seen_as.append(seen[head[at]])
            if recs:
                yield pd.DataFrame({"gram": np.concatenate(grams), "rec": np.concatenate(recs), "size": np.concatenate(sizes), "place": np.concatenate(places), "hot": np.concatenate(seen_as) >= hot_code})

    def segments(batches):
        sketch = np.frombuffer(shipped.value, np.uint8)
        for b in batches:
            out = []
            for g in b["grams"]:
                g = np.asarray(g, np.int64)
                seen = sketch[_cells(g)]
                g, seen = g[seen > 1], seen[seen > 1]  # others are in no overlap
                fragment = np.searchsorted(cuts, seen, side="right")
                order = np.argsort(fragment, kind="stable")
                out.append(np.split(g[order], np.searchsorted(fragment[order], np.arange(1, len(cuts) + 1))))
            yield pd.DataFrame({"rec": b["rec_id"], "size": b["grams"].map(len).astype("int32"), "segments": out})

    heads = cut_lineage(sets.mapInPandas(place, "gram bigint, rec bigint, size int, place int, hot boolean"))
    m, n = F.col("x.size"), F.col("y.size")
    least = _least_overlap(m, n, threshold)
    k = F.least(F.lit(LEAST_SHARED), least)
    near = (F.struct("x.size", "x.rec") < F.struct("y.size", "y.rec")) & (m >= n * F.lit(threshold))
    near = near & (m - F.col("x.place") >= least - k + 1) & (n - F.col("y.place") >= least - k + 1)

    def met(x: DataFrame, y: DataFrame, keys: list[str]) -> DataFrame:
        on = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in keys]
        return x.alias("x").join(y.hint("merge").alias("y"), [*on, near]).select(F.col("x.rec").alias("a"), F.col("y.rec").alias("b"), k.alias("k"))

    ordinary = heads.where("not hot").drop("hot")
    partial = met(ordinary, ordinary, ["gram"])
    if codes.max() >= hot_code:
        often = heads.where("hot").drop("hot").withColumn("class", F.floor(F.log2("size") * 2).cast("int"))
        reach = often.withColumn("class", F.explode(F.sequence("class", F.col("class") + classes_apart)))
        partial = partial.unionByName(met(reach, often, ["gram", "class"]))
    candidates = partial.groupBy("a", "b").agg(F.count(F.lit(1)).alias("found"), F.first("k").alias("k")).where("found >= k").select("a", "b")
    candidates = cut_lineage(candidates)
    taken = cut_lineage(candidates.select(F.explode(F.array("a", "b")).alias("rec_id")).distinct())
    cut = sets.join(if_small(taken, 16), "rec_id", "left_semi").mapInPandas(segments, "rec bigint, size int, segments array<array<bigint>>")
    side = lambda s: cut.select(F.col("rec").alias(s), F.col("segments").alias(f"segments_{s}"), F.col("size").alias(f"size_{s}")).hint("merge")
    full = candidates.join(side("a"), "a").join(side("b"), "b")
    overlaps = F.zip_with("segments_a", "segments_b", lambda x, y: F.size(F.array_intersect(x, y)))  # one partial count per fragment
    full = full.withColumn("shared", F.aggregate(overlaps, F.lit(0), lambda total, part: total + part))
    return full.where(F.col("shared") >= _least_overlap(F.col("size_a"), F.col("size_b"), threshold)).select("a", "b", "shared", "size_a", "size_b")


def _classes(sets: DataFrame) -> DataFrame:
    """(rec_id, class): the least rec_id with the same set."""
    keyed = sets.select("rec_id", F.xxhash64("grams").alias("h1"), F.xxhash64(F.lit(7), F.reverse("grams")).alias("h2"), F.size("grams").alias("size"))
    first = keyed.groupBy("h1", "h2", "size").agg(F.min("rec_id").alias("class"))
    return keyed.join(first, ["h1", "h2", "size"]).select("rec_id", "class")


def _prepared(frame: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = frame.where("main_text <> '' and rec_id is not null").select(
        F.col("rec_id").cast("bigint").alias("rec_id"), F.concat_ws("\n", F.coalesce("title", F.lit("")), "main_text").alias("text")
    )
    sets = cut_lineage(ngram_sets(rows))
    classes = cut_lineage(_classes(sets))
    copies = cut_lineage(classes.where("rec_id <> class").select("rec_id"))
    unique = cut_lineage(sets.join(if_small(copies, 16), "rec_id", "left_anti"))
    return sets, classes, cut_lineage(similar_sets(unique).select("a", "b"))


def near_duplicate_pairs(frame: DataFrame) -> DataFrame:
    """(rec_id_a, rec_id_b), a < b, of records whose sets of runs of 4 tokens share at
    least half of their union.

    Needs rec_id, title and main_text.  Null titles count as empty; rows with null
    or empty main_text, or fewer than 4 tokens in all, or without rec_id, are in no
    pair.  A repeated row is in no pair with itself.  Every pair is given, also those among equal records."""
    _, classes, links = _prepared(frame)
    member = lambda c, r: classes.select(F.col("class").alias(c), F.col("rec_id").alias(r))
    across = links.join(member("a", "ra").hint("merge"), "a").join(member("b", "rb").hint("merge"), "b")
    across = across.select(F.least("ra", "rb").alias("rec_id_a"), F.greatest("ra", "rb").alias("rec_id_b"))
    shared = classes.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("class")
    copies = classes.join(shared, "class")
    within = copies.select("class", F.col("rec_id").alias("rec_id_a")).join(copies.select("class", F.col("rec_id").alias("rec_id_b")), "class")
    return across.unionByName(within.where("rec_id_a < rec_id_b").select("rec_id_a", "rec_id_b")).distinct()


def near_duplicate_links(frame: DataFrame) -> DataFrame:
    """(rec_id, class_id, copies, links): per record with text its class of equal sets,
    the records in it, and the records of other classes it is similar to."""
    _, classes, links = _prepared(frame)
    sizes = classes.groupBy("class").agg(F.count(F.lit(1)).alias("copies"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(sizes, both.b == sizes["class"]).groupBy("a").agg(F.sum("copies").alias("links"))
    out = classes.join(sizes, "class").join(linked, classes["class"] == linked.a, "left")
    return out.select("rec_id", F.col("class").alias("class_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
