"""Phrase matching and transparent scoring.  Term lists and points are parameters."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.text import holds_any_of, squeeze, words_of


@dataclass(frozen=True)
class Keyword:
    """A keyword with its synonyms; any of them in a text is a match."""

    keyword: str
    category: str
    synonyms: tuple[str, ...] = ()
    weight: int = 1
    language: str = "en"

    def phrases(self) -> list[str]:
        return [self.keyword, *self.synonyms]


@dataclass(frozen=True)
class Rule:
    """Terms that count together: each distinct term found adds ``weight``, which may be
    negative, up to ``most`` terms."""

    name: str
    terms: tuple[str, ...] = ()
    weight: int = 1
    most: int = 1


@dataclass(frozen=True)
class Sheet:
    """A named score: a sum of rules, kept within bounds."""

    name: str
    rules: tuple[Rule, ...]
    low: int = 0
    high: int = 100


def text_of(*columns: str) -> Column:
    return F.lower(squeeze(F.concat_ws(" ", *columns)))


def match_keywords(frame: DataFrame, taxonomy: list[Keyword], title: str = "title", body: str = "body") -> DataFrame:
    """Adds matched_keywords (taxonomy order), title_keywords, matched_categories and
    weight_sum.  The taxonomy is an array literal, so no join and no shuffle."""
    frame = frame.withColumns({"_text": text_of(title, body), "_head": text_of(title)})
    frame = frame.withColumns({"_words": words_of(F.col("_text")), "_head_words": words_of(F.col("_head"))})
    hits = lambda c, w: F.array_compact(F.array(*[F.when(holds_any_of(F.col(c), F.col(w), k.phrases()), F.lit(k.keyword)) for k in taxonomy]))
    category = F.create_map(*[x for k in taxonomy for x in (F.lit(k.keyword), F.lit(k.category))])
    weight = F.create_map(*[x for k in taxonomy for x in (F.lit(k.keyword), F.lit(k.weight))])
    frame = frame.withColumns({"matched_keywords": hits("_text", "_words"), "title_keywords": hits("_head", "_head_words")})
    return frame.drop("_text", "_head", "_words", "_head_words").withColumns(
        {
            "matched_categories": F.array_sort(F.array_distinct(F.transform("matched_keywords", lambda k: category[k]))),
            "weight_sum": F.aggregate("matched_keywords", F.lit(0), lambda a, k: a + weight[k]),
        }
    )


def terms_found(text: Column, words: Column, terms: tuple[str, ...]) -> Column:
    """How many distinct ``terms`` a lower-case text with its ``words`` holds."""
    plain = list(dict.fromkeys(t for t in (" ".join(t.split()).lower() for t in terms) if t))
    single = [t for t in plain if t.isascii() and t.isalnum()]
    n = F.size(F.array_intersect(words, F.array(*map(F.lit, single)))) if single else F.lit(0)
    return reduce(lambda a, t: a + F.contains(text, F.lit(t)).cast("int"), [t for t in plain if t not in single], n)


def with_sheets(frame: DataFrame, sheets: list[Sheet], valid: Column | None = None, columns: tuple[str, ...] = ("title", "body")) -> DataFrame:
    """Adds, per sheet, its score as int, and name_reasons, the rules that counted, in
    their order.  Where ``valid`` is not true scores are the low bound, without
    reasons.  The text is read once for all rules; null columns are empty."""
    names = frame.columns
    frame = frame.withColumn("_text", text_of(*columns)).withColumn("_words", words_of(F.col("_text")))
    counts = {(s.name, r.name): F.least(F.lit(r.most), terms_found(F.col("_text"), F.col("_words"), r.terms)) for s in sheets for r in s.rules}
    frame = frame.withColumn("_n", F.struct(*[c.alias(f"n{i}") for i, c in enumerate(counts.values())], F.lit(0).alias("none")))
    at = {k: F.col(f"_n.n{i}") for i, k in enumerate(counts)}
    taken = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
    out = []
    for s in sheets:
        total = reduce(lambda a, r: a + at[s.name, r.name] * r.weight, s.rules, F.lit(0))  # noqa: B023
        reasons = F.array_compact(F.array(*[F.when(at[s.name, r.name] > 0, F.lit(r.name)) for r in s.rules]).cast("array<string>"))
        out.append(F.when(taken, F.greatest(F.lit(s.low), F.least(F.lit(s.high), total))).otherwise(s.low).cast("int").alias(s.name))
        out.append(F.when(taken, reasons).otherwise(F.array().cast("array<string>")).alias(f"{s.name}_reasons"))
    return frame.select(*names, *out)


def labelled_by(frame: DataFrame, labels: list[tuple[str, Column]], other: str, out: str) -> DataFrame:
    """``frame`` with the name of the first condition that is true, else ``other``."""
    choice = F.lit(other)
    for name, condition in reversed(labels):
        choice = F.when(condition, name).otherwise(choice)
    return frame.withColumn(out, choice)


def term_score(text: Column, weights: dict[str, int]) -> Column:
    """Sum of the weights, of either sign, of the terms in ``text``."""
    score = F.lit(0)
    for term, w in weights.items():
        score = score + F.when(F.contains(text, F.lit(term.lower())), w).otherwise(0)
    return score


def clamp(c: Column, low: int, high: int) -> Column:
    """``c`` within bounds; null as the lower one."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(c, F.lit(low))))


def one_of(c: Column, allowed: list[str], other: str) -> Column:
    return F.when(F.trim(c).isin(allowed), F.trim(c)).otherwise(other)


def forced_flag(score: Column, flag: Column, yes_from: int, no_to: int) -> Column:
    """True from one score on, false up to another, the given flag between."""
    return F.when(score >= yes_from, True).when(score <= no_to, False).otherwise(F.coalesce(flag, F.lit(False)))


def bucket(score: Column, steps: list[tuple[int, str]], other: str) -> Column:
    """The name of the first step, from high to low, that the score reaches."""
    out = F.lit(other)
    for least, name in sorted(steps):
        out = F.when(score >= least, name).otherwise(out)
    return out


def tolerant_number(c: Column) -> Column:
    """A number with thousands commas as double; null if it is none."""
    return F.regexp_replace(F.trim(c), ",", "").try_cast("double")


#: Phrases up to which a taxonomy is written into the expression; larger ones are joined, with the same result.
LITERALS = 200


def phrase_join(frame: DataFrame, phrases: DataFrame, text: Column, phrase: str = "phrase", literals: int = LITERALS) -> DataFrame:
    """Rows with every phrase of a table that their text holds, at word boundaries for
    single ASCII words, anywhere for others; blank phrases are in no text.

    A small taxonomy becomes an array literal.  Any other is joined on keys: a word,
    or the first two characters of a phrase, which the text is then searched for; the
    table may have any size and Spark broadcasts it only if it measures small."""
    table = phrases.select(F.col(phrase).alias("_phrase"), F.lower(squeeze(F.col(phrase))).alias("_p")).where("_p <> ''").distinct()
    few = table.limit(literals + 1).collect()
    frame = frame.withColumn("_text", text).withColumn("_words", words_of(F.col("_text")))
    if len(few) <= literals:
        hits = F.array_compact(F.array(*[F.when(holds_any_of(F.col("_text"), F.col("_words"), [r["_p"]]), F.lit(r["_phrase"])) for r in few]).cast("array<string>"))
        return frame.withColumn(phrase, F.explode(hits)).drop("_text", "_words")
    single = F.col("_p").rlike("^[a-z0-9]+$")
    table = table.withColumn("_single", single).withColumn("_key", F.when(single, F.col("_p")).otherwise(F.concat(F.lit("\0"), F.substring("_p", 1, 2))))
    starts = [F.transform(F.regexp_extract_all("_text", F.lit(p), F.lit(1)), lambda x: F.concat(F.lit("\0"), x)) for p in ("(?s)(?=(..))", "(?s)(.)")]
    keyed = frame.withColumn("_key", F.explode(F.array_distinct(F.concat("_words", *starts))))
    found = keyed.join(table, "_key").where(F.col("_single") | F.contains("_text", F.col("_p")))
    return found.withColumn(phrase, F.col("_phrase")).drop("_text", "_words", "_key", "_p", "_single", "_phrase")
