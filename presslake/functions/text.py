"""Text functions: Column in, Column out, no Python in the row path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"(?U)\s+"


def blank_to_null(c: Column) -> Column:
    """Null for null, empty and blank."""
    return F.when(F.trim(c) != "", c)


def first_present(*cs: Column) -> Column:
    """The first value that is neither null nor blank, else empty."""
    return F.coalesce(*[blank_to_null(c) for c in cs], F.lit(""))


def first_present_list(values: Column, other: Column, most: int = 8, separator: str = "、") -> Column:
    """Up to ``most`` distinct values of an array, joined; else the other text, else empty."""
    return first_present(F.array_join(F.slice(distinct_trimmed(values), 1, most), separator), other)


def squeeze(c: Column) -> Column:
    """Runs of white space as one blank, ends trimmed; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), WS, " "))


def plain_title(c: Column) -> Column:
    """Lower case, signs as blanks, white space squeezed."""
    return squeeze(F.regexp_replace(F.lower(squeeze(c)), r"(?U)[^\w\s]", " "))


def bare_content(c: Column) -> Column:
    """Lower case without signs, white space squeezed."""
    return F.regexp_replace(F.lower(squeeze(c)), r"(?U)[^\w\s]", "")


def fingerprint(c: Column, least: int = 80) -> Column:
    """SHA-256 of the bare content; empty below ``least`` characters."""
    bare = bare_content(c)
    return F.when(F.length(bare) < least, "").otherwise(F.sha2(bare, 256))


# Characters that count as a blank, and invisible ones that are dropped.
_BLANKS, _UNSEEN = "\t\u00a0", "\u200b\u200c\u200d\ufeff"


def tidy_lines(c: Column) -> Column:
    """Line ends as line feeds, odd blanks and invisible characters gone, at most one blank line."""
    flat = F.translate(F.coalesce(c, F.lit("")), _BLANKS + _UNSEEN, " " * len(_BLANKS))
    lines = F.transform(F.split(flat, "\r\n|[\r\n]", -1), lambda x: F.ltrim(F.regexp_replace(x, " +(?= )", "")))
    paragraphs = F.regexp_replace(F.array_join(lines, "\n"), "(?<=\n\n)\n+", "")
    return F.regexp_replace(paragraphs, r"\A\s+|\s+\z", "")


def without_markup(c: Column) -> Column:
    """Tags, and scripts and styles with what stands in them, as a blank each."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style)\b[^>]*>.*?</\1>|<[^>]+>", " ")


def without_image_notes(c: Column, ocr_mark: str = "[图片OCR文字]", info_mark: str = "[图片信息]") -> Column:
    """What follows the first mark of read images dropped; of blocks of image notes what
    stands up to the next paragraph; lines that are only an address, too."""
    before = F.substring_index(without_markup(c), ocr_mark, 1)
    pieces = F.split(before, "\\Q" + info_mark + "\\E", -1)  # after each mark a block of notes begins
    rest = lambda x: F.when(F.instr(x, "\n\n") > 0, F.regexp_extract(x, r"(?s)\n\n(\S.*)", 1)).otherwise("")
    kept = F.transform(pieces, lambda x, i: F.rtrim(F.when(i == 0, x).otherwise(rest(x))))
    lines = F.filter(F.split(F.array_join(F.filter(kept, lambda x: x != ""), "\n\n"), "\n"), lambda x: ~F.trim(x).rlike(r"^https?://\S+$"))
    return tidy_lines(F.array_join(lines, "\n"))


# Counters and currencies after which two digits set apart are one number.
NUMBER_UNITS = ["款", "个", "项", "笔", "亿美元", "亿元", "美元", "元"]


def joined_letters(c: Column, units: list[str] = NUMBER_UNITS) -> Column:
    """Characters set apart are joined: a single capital with the abbreviation it belongs
    to, and two single digits before a unit."""
    letters = F.regexp_replace(c, r"(?<!\w)(?<a>[A-Z])\s+(?=[A-Z]{2,}(?!\w))", "${a}")
    return F.regexp_replace(letters, r"(?<!\w)(?<tens>\d)\s+(?<ones>\d)\s+(?=(?:" + "|".join(units) + "))", "${tens}${ones} ")


def tight_punctuation(c: Column) -> Column:
    """No blanks after full-width stops or inside full-width brackets; ideographic space as a blank."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), "\u3000", " ")
    c = F.regexp_replace(F.regexp_replace(c, "([，。；：（]) ", "$1"), " ）", "）")
    return tidy_lines(c)


def without_noise_lines(c: Column, patterns: list[str]) -> Column:
    """Lines that match one of ``patterns`` in full (case aside) removed."""
    noise = "(?i)^(?:" + "|".join(patterns) + ")$"
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: F.trim(x))
    return F.array_join(F.filter(lines, lambda x: ~x.rlike(noise)), "\n")


def without_leading_title(body: Column, title: Column) -> Column:
    """First lines equal to the title removed, one line kept at least."""
    lines = F.split(body, "\n")
    own = F.transform(lines, lambda x: (F.trim(x) != F.trim(title)).cast("int"))
    first = F.array_position(own, 1)
    start = F.when(first == 0, F.size(lines)).otherwise(first).cast("int")
    return F.when(F.trim(F.coalesce(title, F.lit(""))) == "", body).otherwise(F.array_join(F.slice(lines, start, F.size(lines)), "\n"))


def cut_text(c: Column, limit: int, suffix: str = "...") -> Column:
    """At most ``limit`` characters, the suffix included."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - len(suffix)), F.lit(suffix))).otherwise(c)


def snippet(c: Column, limit: int = 260) -> Column:
    """The beginning up to the last blank within ``limit`` characters, marked with dots if cut."""
    text = squeeze(c)
    head = F.substring(text, 1, limit)
    whole = F.when(F.instr(head, " ") > 0, F.regexp_extract(head, r"(?s)^(.*) ", 1)).otherwise(head)
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.regexp_replace(whole, "[ ,;:]+$", ""), F.lit("...")))


def split_publisher(c: Column, mark: str = " - ") -> Column:
    """Struct (head, publisher) at the last mark; publisher empty without one."""
    at = rf"(?s)^(.*)\Q{mark}\E(.*)$"
    hit = F.contains(c, F.lit(mark))
    return F.struct(
        F.when(hit, F.trim(F.regexp_extract(c, at, 1))).otherwise(c).alias("head"), F.when(hit, F.trim(F.regexp_extract(c, at, 2))).otherwise("").alias("publisher")
    )


def split_tags(c: Column) -> Column:
    """Trimmed, non-blank pieces between commas of either width and the enumeration mark."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[,，、]"), lambda x: F.trim(x)), lambda x: x != "")


def distinct_trimmed(c: Column) -> Column:
    """Distinct, trimmed, non-blank values of an array, the first of each kept in place."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""))


def holds_phrase(text: Column, phrase: str) -> Column:
    """Whether lower-case ``text`` holds the phrase: a single ASCII word at word
    boundaries, anything else as it is; a blank phrase never."""
    phrase = " ".join(phrase.split()).lower()
    if not phrase:
        return F.lit(False)
    if phrase.isascii() and phrase.isalnum():
        return text.rlike(rf"\b{phrase}\b")
    return F.contains(text, F.lit(phrase))


def holds_any(text: Column, phrases: list[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | holds_phrase(text, p)
    return out


def words_of(text: Column) -> Column:
    """Distinct words of a text; one pass of it for any number of single-word phrases."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?U)\w+"), F.lit(0)))


def holds_any_of(text: Column, words: Column, phrases: list[str]) -> Column:
    """As :func:`holds_any` for a lower-case text and its ``words``."""
    plain = [" ".join(p.split()).lower() for p in phrases]
    single = [p for p in plain if p and p.isascii() and p.isalnum()]
    out = F.arrays_overlap(words, F.array(*[F.lit(p) for p in single])) if single else F.lit(False)
    for p in plain:
        if p and p not in single:
            out = out | F.contains(text, F.lit(p))
    return out


def labels_found(text: Column, labels: dict[str, list[str]]) -> Column:
    """Labels, in order, of which one variant is in the lower-case text."""
    return F.array_compact(F.array(*[F.when(holds_any(text, v), F.lit(k)) for k, v in labels.items()]))


def json_object(c: Column) -> Column:
    """The outermost braces of a model's answer, code fences and prose around aside."""
    return F.regexp_extract(c, r"(?s)\{.*\}", 0)


def json_list(c: Column) -> Column:
    return F.regexp_extract(c, r"(?s)\[.*\]", 0)


def section_of(c: Column, heading: str) -> Column:
    """Text of a Markdown document between a second-level heading and the next."""
    return F.regexp_replace(F.regexp_extract(c, rf"(?ms)^## \Q{heading}\E\s*$(.*?)(?=^## |\z)", 1), r"^\s+|\s+$", "")


def html_escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def json_in_page(c: Column) -> Column:
    """JSON text that can stand in a script element: no end tag can begin in it."""
    return F.replace(c, F.lit("</"), F.lit("<\\/"))


def file_name(c: Column) -> Column:
    """Characters unfit for a file name as underscores."""
    return F.regexp_replace(c, r'[\\/:*?"<>|\s]+', "_")


def has_han(c: Column) -> Column:
    return c.rlike(r"[\x{3400}-\x{9fff}\x{f900}-\x{faff}]")


def company_names(text: Column, organization: Column, excluded: list[str], suffixes: list[str], labels: list[str], longest: int = 7) -> Column:
    """Distinct company names: what follows a label up to the end of its clause, and in
    each run of capitalised words those up to the last legal suffix, at most
    ``longest`` words.  Those of ``excluded`` and the organization itself are left out."""
    legal = F.array(*map(F.lit, suffixes))
    clauses = F.filter(F.split(text, "[.;\n]"), lambda x: F.exists(F.array(*map(F.lit, labels)), lambda l: F.contains(F.lower(x), F.concat(F.lower(l), F.lit(":")))))
    labelled = F.transform(clauses, lambda x: F.trim(F.substring_index(x, ":", -1)))
    runs = F.transform(F.regexp_extract_all(text, F.lit(r"(?U)(?<!\w)\p{Lu}[^\s.,;:!?]*(?: +\p{Lu}[^\s.,;:!?]*)*"), F.lit(0)), lambda x: F.split(x, " +"))
    ends = F.transform(runs, lambda w: F.struct(w.alias("w"), F.array_max(F.transform(w, lambda x, i: F.when(F.array_contains(legal, x), i + 1))).alias("end")))
    named = F.transform(F.filter(ends, lambda r: r["end"] > 1), lambda r: F.array_join(F.slice(r["w"], F.greatest(F.lit(1), r["end"] - (longest - 1)), F.least(F.lit(longest), r["end"])), " "))
    names = F.array_distinct(F.filter(F.concat(labelled, named), lambda x: F.length(x) > 1))
    banned = F.array(*[F.lit(e.lower()) for e in excluded], F.lower(F.coalesce(organization, F.lit(""))))
    return F.filter(names, lambda x: ~F.array_contains(banned, F.lower(x)))
