"""Date functions.  Each reads a stated set of notations and gives null for all others."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.text import squeeze

# Month words, English and Indonesian, in month order.
MONTH_WORDS = [
    ["january", "jan", "januari"], ["february", "feb", "februari"], ["march", "mar", "maret"], ["april", "apr"], ["may", "mei"], ["june", "jun", "juni"],
    ["july", "jul", "juli"], ["august", "aug", "agustus"], ["september", "sep", "sept"], ["october", "oct", "oktober"], ["november", "nov"], ["december", "dec", "desember"],
]


def _month_number(word: Column) -> Column:
    flat = [x for i, words in enumerate(MONTH_WORDS, 1) for w in words for x in (F.lit(w), F.lit(i))]
    return F.create_map(*flat)[F.lower(word)]


def _date(y: Column, m: Column, d: Column) -> Column:
    """A date of three numbers as text or int; null if there is no such day."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.try_to_date(F.when((y != "") & m.isNotNull() & (d != ""), F.concat_ws("-", y, two(m), two(d))), "yyyy-MM-dd")


def _found(c: Column, pattern: str, y: int, m: int, d: int, word: bool = False) -> Column:
    part = lambda i: F.regexp_extract(c, pattern, i)
    month = _month_number(part(m)) if word else F.when(part(m) != "", part(m))
    return _date(part(y), month, part(d))


def iso_prefix(c: Column) -> Column:
    """Texts that begin with yyyy-MM-dd."""
    return F.try_to_date(F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def english_day_first(c: Column) -> Column:
    """The first "d Month yyyy" with the month in full, anywhere in the text."""
    return _found(c, r"(?i)\b(\d{1,2}) (january|february|march|april|may|june|july|august|september|october|november|december) (20\d{2})\b", 3, 2, 1, word=True)


def report_date(c: Column) -> Column:
    """Texts that are yyyy-MM-dd or "d Month yyyy", month in full or short."""
    c = F.trim(F.coalesce(c, F.lit("")))
    iso = F.try_to_date(F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c), "yyyy-MM-dd")
    return F.coalesce(iso, _found(c, r"(?i)^(\d{1,2}) ([a-z]+) (\d{4})$", 3, 2, 1, word=True))


#: Shapes of three neighbouring words that name a date, in order of preference: y a year from 2000 to
#: 2099, n one or two digits, w letters; the mark stands between them.
_SHAPES = {"y=n=n": (0, 1, 2), "n=n=y": (2, 1, 0), "n w y": (2, 1, 0), "w n y": (2, 0, 1)}


def any_date(c: Column) -> Column:
    """The first of: year-first digits, day-first digits, day-first words, month-first
    words, wherever they stand; years from 2000 to 2099.  Numbers are a date only if
    nothing but a hyphen, slash or dot is between them.

    The text is cut into words and what is between them; each three neighbours have a
    shape, and the first of the best shape is read."""
    parts = F.regexp_extract_all(squeeze(F.translate(F.coalesce(c, F.lit("")), ",", " ")), F.lit(r"\w+|\W+"), F.lit(0))
    kind = lambda x: F.when(x.rlike(r"^20\d\d$"), "y").when(x.rlike(r"^\d\d?$"), "n").when(x.rlike(r"(?i)^[a-z]+$"), "w").when(x.rlike("^[-/.]$"), "=").when(x == " ", " ").otherwise("?")
    bound = lambda value, use: F.transform(F.array(value), use)[0]  # noqa: E731  (made once, however often it is used)

    def shaped(t: Column) -> Column:
        windows = F.arrays_zip(*[F.slice(t, F.lit(i + 1), F.greatest(F.size(t) - 4, F.lit(0))).alias(f"p{i}") for i in range(5)])
        return F.transform(windows, lambda w: F.struct(F.concat(*[w[f"p{i}"]["k"] for i in range(5)]).alias("shape"), *[w[f"p{i}"]["x"].alias(f"v{i // 2}") for i in (0, 2, 4)]))

    def first(s: Column, shape: str) -> Column:
        return F.try_element_at(F.filter(s, lambda w: w["shape"] == shape), F.lit(1))

    def day(hit: Column, shape: str) -> Column:
        y, m, d = (hit[f"v{i}"] for i in _SHAPES[shape])
        return _date(y, _month_number(m) if "w" in shape else m, d)

    def read(hits: Column) -> Column:
        iso, day_first, *words = [(hits[f"h{i}"], shape) for i, shape in enumerate(_SHAPES)]
        return F.when(iso[0].isNotNull(), day(*iso)).when(day_first[0].isNotNull(), day(*day_first)).otherwise(F.coalesce(*[day(*w) for w in words]))

    typed = F.transform(parts, lambda x: F.struct(x.alias("x"), kind(x).alias("k")))
    hits = lambda s: F.struct(*[first(s, shape).alias(f"h{i}") for i, shape in enumerate(_SHAPES)])
    return bound(typed, lambda t: bound(shaped(t), lambda s: bound(hits(s), read)))


def mail_date(c: Column) -> Column:
    """The calendar day of RFC 2822 dates, else of texts that begin with yyyy-MM-dd."""
    mail = _found(c, r"(?i)^\s*(?:[a-z]{3}, )?(\d{1,2}) ([a-z]{3}) (\d{4}) \d{2}:\d{2}", 3, 2, 1, word=True)
    return F.coalesce(mail, iso_prefix(F.trim(c)))


def year_of(c: Column) -> Column:
    """Year of :func:`mail_date`, else the first number 2000 to 2099 in the text."""
    return F.coalesce(F.year(mail_date(c)), F.nullif(F.regexp_extract(c, r"(?<!\w)(20\d{2})(?!\w)", 1), F.lit("")).cast("int"))


def compact_date(c: Column) -> Column:
    """The day of texts that begin with eight digits yyyyMMdd."""
    return F.try_to_date(F.regexp_extract(c, r"^(20\d{6})", 1), "yyyyMMdd")


def chinese_date(c: Column) -> Column:
    """The first date with the characters for year, month and day."""
    return _found(c, r"(\d{4})年(\d{1,2})月(\d{1,2})日", 1, 2, 3)


def is_relative(c: Column) -> Column:
    """Whether a text gives a time relative to now."""
    return c.rlike(r"(?i)\b(?:\d+|an?) (?:minute|hour|day|week)s? ago\b|\b(?:yesterday|today|just now)\b|\d+\s*(?:分钟|小时|天|周)前|刚刚|昨天|今天|前天")


def precision(c: Column) -> Column:
    """3 for a full date in figures or with the month in letters, 2 for a word and a year,
    1 for four digits, 0 for anything else."""
    levels = [(r"\d{4}-\d\d-\d\d|\d{1,2}\s+[A-Za-z]+\s+\d{4}", 3), (r"[A-Za-z]\s+\d{4}", 2), (r"\d{4}", 1)]
    return F.coalesce(*[F.when(c.rlike(p), n) for p, n in levels], F.lit(0))


def issue_end(issue: Column) -> Column:
    """First day after an issue "yyyy-MM"; null for other texts."""
    return F.add_months(F.try_to_date(F.when(issue.rlike(r"^20\d{2}-(?:0[1-9]|1[0-2])$"), F.concat(issue, F.lit("-01"))), "yyyy-MM-dd"), 1)


def week_number(d: Column, start: Column) -> Column:
    """1 for the seven days from ``start``, 2 for the next seven, and so on."""
    return (F.floor(F.datediff(d, start) / 7) + 1).cast("int")


def month_week(d: Column) -> Column:
    """1 for the first four days of a month, then sevens: 5-11, 12-18, 19-25, 26-31."""
    day = F.dayofmonth(d)
    return F.when(day <= 4, 1).otherwise(F.floor((day - 5) / 7) + 2).cast("int")
