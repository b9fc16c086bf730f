"""Joins, de-duplication, upserts, incremental state and the event ledger.

Order matters in several of these: every one takes an explicit order column and
breaks ties by it, as Spark keeps no row order."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from presslake.functions.text import fingerprint, plain_title
from presslake.functions.urls import dedup_key
from presslake.session import cut_lineage


def keep_first(frame: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; rows with a null key are one key too.  Rows travel as
    one struct through a partial aggregate, so a common key is no hot task."""
    names = frame.columns
    first = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*names).alias("_row")))
    return frame.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(first.alias("_m")).select("_m._row.*").select(*names)


def keep_last(frame: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    names = frame.columns
    last = F.max(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*names).alias("_row")))
    return frame.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(last.alias("_m")).select("_m._row.*").select(*names)


def upsert(existing: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """``existing`` with rows replaced by those of ``new`` with the same key, the last
    of several by ``order``.  Rows with a blank key are always appended."""
    both = existing.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    keyed = F.trim(F.coalesce(F.col(key), F.lit(""))) != ""
    return keep_last(both.where(keyed), [key], [F.col("_age"), F.col(order)]).unionByName(both.where(~keyed)).drop("_age")


def replace_sources(existing: DataFrame, new: DataFrame, source: str = "source_name") -> DataFrame:
    """Rows of the sources in ``new`` taken from there, all others from ``existing``."""
    kept = existing.join(new.select(source).distinct(), source, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def refresh_from(frame: DataFrame, registry: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns taken from a registry where it knows the key, and ``known``."""
    right = registry.dropDuplicates([key]).select(key, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("known"))
    out = frame.join(right, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"_{c}", *([c] if c in frame.columns else [])))
    return out.withColumn("known", F.coalesce("known", F.lit(False))).drop(*[f"_{c}" for c in columns])


def cascaded_lookup(frame: DataFrame, table: DataFrame, steps: list[list[str]], value: str, order: str) -> DataFrame:
    """``frame`` with ``value`` of ``table``, looked up by the first step's columns, else
    the next step's, and so on.  Of several rows of a key the last by ``order`` counts;
    null and blank keys find nothing."""
    out, found = frame, []
    for i, keys in enumerate(steps):
        side = table.where(reduce(lambda a, b: a & b, [F.trim(F.col(k)) != "" for k in keys]))
        side = side.groupBy(*keys).agg(F.max_by(value, order).alias(f"_v{i}"))
        out = out.join(side, keys, "left")
        found.append(F.col(f"_v{i}"))
    step = F.lit(None).cast("int")
    for i in reversed(range(len(steps))):
        step = F.when(F.col(f"_v{i}").isNotNull(), i + 1).otherwise(step)
    return out.withColumns({value: F.coalesce(*found), "lookup_step": step}).drop(*[f"_v{i}" for i in range(len(steps))])


def pending(frame: DataFrame, done: DataFrame, key: str, version: str | None = None, column: str = "version") -> DataFrame:
    """Rows not yet done, for one version of the work if given."""
    if version is not None:
        done = done.where(F.col(column) == version)
    return frame.join(done.select(key).distinct(), key, "left_anti")


def unseen(frame: DataFrame, seen: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows whose key was not seen before, the first of each within the batch."""
    return keep_first(frame.join(seen.select(key).distinct(), key, "left_anti"), [key], order)


def effective_cap(whole: Column, own: Column) -> Column:
    """The lesser of two caps; null and 0 are no cap, and without any the result is null."""
    return F.least(F.nullif(whole, F.lit(0)), F.nullif(own, F.lit(0)))


def capped(frame: DataFrame, group: str, order: list[Column], cap: Column) -> DataFrame:
    """The first rows of each group, as many as ``cap``; all where it is null."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return frame.withColumn("_rank", rank).withColumn("_cap", cap).where(F.col("_cap").isNull() | (F.col("_rank") <= F.col("_cap"))).drop("_rank", "_cap")


def union_seen(seen: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key) of everything seen before or now, once; null keys are none."""
    return seen.select(key).unionByName(new.select(key)).where(F.col(key).isNotNull()).distinct()


def keys_in_both(frame: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """(key) that both frames hold, once; null is a key as in a set."""
    return frame.select(key).intersect(other.select(key))


def cap_then_unseen(frame: DataFrame, seen: DataFrame, key: str, group: str, order: list[Column], cap: int) -> DataFrame:
    """The first ``cap`` rows of each group, of these the unseen: a full group of known
    rows gives nothing."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    capped = frame.withColumn("_rank", rank).where(F.col("_rank") <= cap).drop("_rank")
    return capped.join(seen.select(key).distinct(), key, "left_anti")


def either_match(frame: DataFrame, other: DataFrame, alternatives: list[list[str]]) -> DataFrame:
    """``frame`` with ``matched``: whether ``other`` has a row equal in one of the
    alternative sets of columns.  One join per alternative instead of a join on OR."""
    out, flags = frame, []
    for i, keys in enumerate(alternatives):
        out = out.join(other.select(*keys).distinct().withColumn(f"_m{i}", F.lit(True)), keys, "left")
        flags.append(F.coalesce(f"_m{i}", F.lit(False)))
    return out.withColumn("matched", reduce(lambda a, b: a | b, flags)).drop(*[f"_m{i}" for i in range(len(alternatives))])


def expand_edges(edges: DataFrame, known: DataFrame, source: str, target: str, name: str) -> DataFrame:
    """Targets of edges that are known entities and no source themselves."""
    targets = edges.select(F.col(target).alias(name)).distinct()
    return targets.join(known.select(name).distinct(), name, "left_semi").join(edges.select(F.col(source).alias(name)).distinct(), name, "left_anti")


def reference_check(frame: DataFrame, refs: str, known: DataFrame, key: str) -> DataFrame:
    """(ref, uses, known): every reference of an array column, how often it is used and
    whether it exists; integrity holds if all are known and used once."""
    uses = frame.select(F.explode(refs).alias("ref")).groupBy("ref").agg(F.count(F.lit(1)).alias("uses"))
    there = known.select(F.col(key).alias("ref")).distinct().withColumn("known", F.lit(True))
    return uses.join(there, "ref", "left").select("ref", "uses", F.coalesce("known", F.lit(False)).alias("known"))


def _ratio(later: pd.Series, earlier: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(later, earlier)], dtype="float64")


#: Characters of the pieces by which similar titles are found.
PIECE = 3


def similar_titles(frame: DataFrame, key: str, title: str, least: float = 0.92) -> DataFrame:
    """(earlier, later, ratio) of different titles, by the least ``key`` of each, whose
    matching blocks cover ``least`` of both.

    Titles are sets of pieces of PIECE characters, a piece that occurs again numbered.
    If the blocks of two titles cover enough, a title of n characters keeps all but a
    certain share of its pieces in the other one, so that in any common order of pieces
    the first ones, one more than it may lose, hold a shared one.  Pieces are ordered by
    how many titles have them, the rarest first, and titles joined on the first ones: no
    pair is lost, and common pieces are hardly ever joined.  The edit distance is checked in
    the JVM, the exact ratio in Python only for what is left.  Equal titles are joined
    once.  Null and empty titles have no pair."""
    titles = frame.where(F.col(title) != "").groupBy(F.col(title).alias("t")).agg(F.min(key).alias("k")).withColumn("n", F.length("t"))
    titles = cut_lineage(titles)
    free, most = 1 - least, (2 - least) / least  # share of both lengths that stays unmatched; of the lengths of a pair
    lost = (2 * PIECE - 1) * free + (0.5 - (2 * PIECE - 1) * free / 2) * (1 - 1 / most)  # pieces lost per character, at most
    pieces = F.regexp_extract_all("t", F.lit(f"(?s)(?=({'.' * PIECE}))"), F.lit(1))
    single = titles.select("k", "n", F.posexplode(pieces).alias("at", "piece"))
    again = F.row_number().over(Window.partitionBy("k", "piece").orderBy("at"))
    single = single.select("k", "n", F.xxhash64("piece", again).alias("piece"))  # equal hashes only bring a pair to the check
    common = single.groupBy("piece").agg(F.count(F.lit(1)).alias("titles"))
    ranked = single.join(common.where("titles > 1"), "piece")  # other pieces are in no pair
    first = F.row_number().over(Window.partitionBy("k").orderBy("titles", "piece"))
    kept = F.floor(F.col("n") * lost + 1e-9) + 1
    # Pieces of a single title come first in the order: the places they take are known from the length.
    own = F.greatest(F.col("n") - (PIECE - 1), F.lit(0)) - F.count(F.lit(1)).over(Window.partitionBy("k"))
    heads = cut_lineage(ranked.select("k", "n", "piece", (first + own).alias("place"), kept.alias("kept")).where("place <= kept").select("k", "n", "piece"))
    x, y = heads.alias("x"), heads.alias("y")
    near = x.join(y, (F.col("x.piece") == F.col("y.piece")) & (F.col("x.k") < F.col("y.k")) & F.col("y.n").between(F.col("x.n") / most - 1e-9, F.col("x.n") * most + 1e-9))
    near = near.select(F.col("x.k").alias("earlier"), F.col("y.k").alias("later")).distinct()
    text_at = lambda k, t: titles.select(F.col("k").alias(k), F.col("t").alias(t))
    both = near.join(text_at("earlier", "te"), "earlier").join(text_at("later", "t2"), "later")
    both = both.where(F.levenshtein("te", "t2") <= F.floor((F.length("te") + F.length("t2")) * (1 - least) + 1e-9))
    return both.withColumn("ratio", F.pandas_udf(_ratio, DoubleType())("t2", "te")).where(F.col("ratio") >= least).select("earlier", "later", "ratio")


def exact_duplicates(frame: DataFrame, order: str, url: str = "url", body: str = "body") -> DataFrame:
    """``frame`` with duplicate_of and duplicate_reason: the first row in order with the
    same address key (exact_url), else with the same content (exact_content)."""
    keyed = frame.withColumns({"_u": dedup_key(F.col(url)), "_c": fingerprint(F.col(body))})
    by_url = keyed.groupBy("_u").agg(F.min(order).alias("_fu"))
    by_content = keyed.where("_c <> ''").groupBy("_c").agg(F.min(order).alias("_fc"))
    out = keyed.join(by_url, "_u").join(by_content, "_c", "left")
    reason = F.when(F.col("_fu") < F.col(order), "exact_url").when(F.col("_fc") < F.col(order), "exact_content")
    first = F.when(F.col("_fu") < F.col(order), F.col("_fu")).when(F.col("_fc") < F.col(order), F.col("_fc"))
    return out.withColumns({"duplicate_of": first, "duplicate_reason": reason}).drop("_u", "_c", "_fu", "_fc")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of the nodes of undirected edges (a, b): the least id reached.
    Labels spread along edges and jump to their label's label; lineage is cut in each
    round, and messages are minima, combined before the shuffle."""
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")))
    while True:
        sent = both.join(labels.select(F.col("id").alias("a"), "component"), "a").groupBy(F.col("b").alias("id")).agg(F.min("component").alias("near"))
        next_ = labels.join(sent, "id").select("id", F.least("component", "near").alias("new"), F.col("component").alias("old"))
        jump = next_.select(F.col("id").alias("new"), F.col("new").alias("far"))
        next_ = cut_lineage(next_.join(jump, "new", "left").select("id", F.least("new", F.coalesce("far", "new")).alias("component"), "old"))
        labels = next_.select("id", "component")
        if not next_.where("component <> old").limit(1).count():
            return labels


def resolve_duplicates(frame: DataFrame, key: str, better: list[Column], url: str = "url", title: str = "title", body: str = "body", least: float = 0.92) -> DataFrame:
    """``frame`` with duplicate_of and duplicate_reason: records with the same address
    key or content, or with similar titles (in lower case, without signs), are a class; the
    best of a class by ``better`` (larger wins, ties to the earlier key) is kept and the
    others point to it.  The reason is what they share with it: exact_url, exact_content,
    similar_title:ratio, or else linked, by others of the class.  Classes don't depend on the
    order of rows.  Blank addresses link nothing."""
    rows = frame.select(F.col(key).alias("k"), F.when(F.trim(F.col(url)) != "", dedup_key(F.col(url))).alias("u"), F.nullif(fingerprint(F.col(body)), F.lit("")).alias("c"), F.nullif(plain_title(F.col(title)), F.lit("")).alias("t"), F.struct(*[b.alias(f"_b{i}") for i, b in enumerate(better)], (-F.col(key)).alias("_k")).alias("r"))
    rows = cut_lineage(rows)

    def star(column: str) -> DataFrame:  # every row of an equal value to its first: no pairs within a group
        first = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.min("k").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
        return rows.join(first, column).where("k <> a").select("a", F.col("k").alias("b"))

    similar = cut_lineage(similar_titles(rows, "k", "t", least))
    pairs = similar.select(F.col("earlier").alias("a"), F.col("later").alias("b"))
    classes = cut_lineage(components(star("u").unionByName(star("c")).unionByName(star("t")).unionByName(pairs)))
    known = rows.groupBy("t").agg(F.min("k").alias("same")).where("t is not null")  # a title goes by the first row that has it
    member = rows.join(classes, rows.k == classes.id).join(known, "t", "left").select("k", "u", "c", "same", "component", "r")
    winner = member.groupBy("component").agg(F.max(F.struct("r", "k", "u", "c", "same")).alias("w"))
    loser = member.join(winner, "component").where("k <> w.k")
    loser = loser.withColumns({"earlier": F.least("same", "w.same"), "later": F.greatest("same", "w.same")}).join(similar, ["earlier", "later"], "left")
    ratio = F.when(F.col("same") == F.col("w.same"), 1.0).otherwise(F.col("ratio"))
    reason = F.when(F.col("u") == F.col("w.u"), "exact_url").when(F.col("c") == F.col("w.c"), "exact_content").when(ratio.isNotNull(), F.format_string("similar_title:%.3f", ratio)).otherwise("linked")
    marked = loser.select(F.col("k").alias(key), F.col("w.k").alias("duplicate_of"), reason.alias("duplicate_reason"))
    return frame.join(marked, key, "left")


def event_ledger(frame: DataFrame, key: Column, score: Column, published: str, ident: str, relevance: str, labels: str, merged: str = "merged_rows") -> DataFrame:
    """Events without relevance "none", one per key: the highest score, then the earlier
    published text, then the smaller id, with the sorted union of ``labels`` (of few
    values, as sources are) and how many rows were merged.  A row that is a ledger's
    itself counts for the rows merged in it; the rows are in :func:`ledger_members`."""
    kept = frame.where(F.coalesce(F.col(relevance), F.lit("industry_only")) != "none")
    names = [c for c in kept.columns if c not in (labels, merged)]
    order = [-F.coalesce(score, F.lit(0)), F.coalesce(F.col(published), F.lit("")), F.coalesce(F.col(ident), F.lit(""))]
    first = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*names).alias("_row"))).alias("_m")
    n = F.sum(merged) if merged in frame.columns else F.count(F.lit(1))
    union = F.array_sort(F.array_distinct(F.flatten(F.collect_set(labels)))).alias("_l")
    grouped = kept.withColumn("_key", key).groupBy("_key").agg(first, union, n.alias("_n"))
    return grouped.select(F.col("_key").alias("ledger_key"), "_m._row.*", F.col("_l").alias(labels), F.col("_n").alias(merged))


def ledger_members(frame: DataFrame, key: Column, relevance: str, ident: str) -> DataFrame:
    """(ledger_key, member): the rows behind the events of :func:`event_ledger`."""
    kept = frame.where(F.coalesce(F.col(relevance), F.lit("industry_only")) != "none")
    return kept.select(key.alias("ledger_key"), F.col(ident).alias("member")).distinct()


def merge_issue(master: DataFrame, issue: DataFrame, key: str, score: str, published: str, ident: str, relevance: str, labels: str) -> tuple[DataFrame, DataFrame]:
    """An incremental issue: (the master ledger with the issue's events merged in, the
    events of it that the issue names).  Both frames are ledgers; running an issue again
    with the same events leaves best rows and labels as they are."""
    both = master.unionByName(issue, allowMissingColumns=True)
    merged = event_ledger(both.withColumnRenamed(key, "_lk"), F.col("_lk"), F.col(score), published, ident, relevance, labels).withColumnRenamed("ledger_key", key)
    merged = merged.drop("_lk").select(*[c for c in master.columns])
    return merged, merged.join(issue.select(key).distinct(), merged[key].eqNullSafe(issue[key]), "left_semi")


def ledger_counts(source: DataFrame, ledger: DataFrame, relevance: str, priority: list[str]) -> DataFrame:
    """One row: rows read, excluded, merged away, events, priority events."""
    none = F.coalesce(F.col(relevance), F.lit("industry_only")) == "none"
    zero = F.lit(0).cast("bigint")
    read = source.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(none).alias("excluded")).withColumns({"events": zero, "priority_events": zero})
    kept = ledger.agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col(relevance).isin(priority)).alias("priority_events")).withColumns({"source_rows": zero, "excluded": zero})
    names = ["source_rows", "excluded", "events", "priority_events"]
    both = read.unionByName(kept).agg(*[F.sum(n).alias(n) for n in names])
    return both.select("source_rows", "excluded", (F.col("source_rows") - F.col("excluded") - F.col("events")).alias("merged"), "events", "priority_events")
