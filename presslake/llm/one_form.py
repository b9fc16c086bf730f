"""Problem 4: one form for text that looks the same.

A transducer compiled once from Unicode rules rewrites a text in one pass.  Its
units are grapheme clusters and, for look-alike letters, whole words; at each
place the longest unit wins.  The mapping is computed from the character
database, then checked for conflicts (:func:`check_mapping`)."""

from __future__ import annotations

import re
import sys
import unicodedata as ud
from functools import lru_cache

import pandas as pd
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters of other scripts drawn like a Latin one, in pairs; :func:`lookalikes` adds those of
# the public table of confusable characters.
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХҮаеорсухѕіјһԁԛԝӏкпΑΒΕΖΗΙΚΜΝΟΡΤΥΧον",
        "ABESIJKMHOPCTYXYaeopcyxsijhdqwlknABEZHIKMNOPTYXov",
    )
)
#: Scripts and letters, as ranges, that a Latin word holds by mistake or not at all.
_OTHERS = "ɐ-ʯͰ-ϿЀ-ԯԱ-֏Ꭰ-᏿Ⲁ-⳿ꓐ-ꓽꭰ-ꮿ"


def lookalikes(spark: SparkSession) -> dict[str, str]:
    """:data:`LOOKALIKES` and every letter of _OTHERS that the public table of confusable
    characters, as the Unicode library on Spark's class path has it, takes for one
    Latin letter.  Made on the driver: a few hundred entries, bounded by the standard.
    Raises where the table can't be read: with fewer letters words would silently stay."""
    ranges = re.findall("(.)-(.)", _OTHERS)
    letters = [chr(x) for a, b in ranges for x in range(ord(a), ord(b) + 1) if ud.category(chr(x))[0] == "L"]
    latin = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    try:
        checker = getattr(spark._jvm, "com.ibm.icu.text.SpoofChecker$Builder")().build()
        forms = checker.getSkeleton("\n".join([*letters, *latin])).split("\n")
    except (AttributeError, TypeError, Py4JError) as error:  # no JVM at hand, another class path, a failure within
        raise RuntimeError("the table of confusable characters can't be read: com.ibm.icu (icu4j) must be on the class path of Spark's driver") from error
    if len(forms) != len(letters) + len(latin):
        raise RuntimeError(f"the table of confusable characters gave {len(forms)} forms for {len(letters) + len(latin)} letters")
    out = dict(LOOKALIKES)
    of_form: dict[str, list[str]] = {}
    for c, form in zip(latin, forms[len(letters) :]):
        of_form.setdefault(form, []).append(c)
    for c, form in zip(letters, forms):
        if found := of_form.get(form):
            out.setdefault(c, next((x for x in found if x.isupper() == c.isupper()), found[0]))
    return out


#: Invisible characters; those of SHAPING keep their function beside the scripts or emoji that use them.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufe00\ufe01\ufe02\ufe0e\ufe0f\ufeff"


@lru_cache(maxsize=1)
def mapping() -> dict[str, str]:
    """Single characters and their ordinary form: full and half width letters and
    digits, ligatures, styled letters, canonical singletons, spaces, invisibles."""
    out = {}
    for cp in range(0xA0, sys.maxunicode + 1):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF or 0xE000 <= cp <= 0xF8FF:
            continue
        c, cat = chr(cp), ud.category(chr(cp))
        if cat == "Cn":
            continue
        kind = ud.decomposition(c).partition(">")[0] if ud.decomposition(c).startswith("<") else ""
        if cat == "Zs" and c not in "\u1680\u3000":
            out[c] = " "
        elif kind in ("<wide", "<narrow", "<font") and cat[0] in "LN":
            out[c] = ud.normalize("NFKC", c)
        elif 0xFB00 <= cp <= 0xFB06:
            out[c] = ud.normalize("NFKC", c)
        elif cat[0] in "LN" and ud.normalize("NFC", c) != c and not ud.combining(c):
            out[c] = ud.normalize("NFC", c)
    out |= {c: "" for c in INVISIBLE}
    out = {c: "".join(out.get(x, x) for x in to) for c, to in out.items()}
    check_mapping(out)
    return out


def check_mapping(table: dict[str, str]) -> None:
    """Raises if an output holds a character that is itself replaced (two passes
    would then differ), or a look-alike has a second reading."""
    for c, to in table.items():
        if any(x in table for x in to):
            raise ValueError(f"U+{ord(c):04X} maps to a character that is mapped again")
    for c in LOOKALIKES:
        if c in table:
            raise ValueError(f"U+{ord(c):04X} has two readings")


_MARKS = "\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20f0\u3099\u309a"
_EMOJI = "©®‼⁉™ℹ←-⇿⌀-➿⤀-⥿⬀-⯿〰〽㊗㊙\U0001f000-\U0001faff#*0-9"
_SHAPED = "\u0590-\u08ff\u0900-\u0dff\u0e00-\u0effက-႟ក-\u17ff᠀-\u18af"


@lru_cache(maxsize=4)
def _compiled(looks: str):
    table = mapping()
    esc = lambda chars: "".join(map(re.escape, chars))
    latin_wide = "".join(c for c, to in table.items() if to.isascii() and to.isalpha())
    letters = "A-Za-zÀ-ɏḀ-ỿ" + esc(latin_wide) + _OTHERS
    inner = esc(INVISIBLE) + _MARKS
    emoji = f"[{_EMOJI}]\ufe0f?[\u20e3\U0001f3fb-\U0001f3ff]?(?:\u200d[{_EMOJI}]\ufe0f?[\U0001f3fb-\U0001f3ff]?)*"
    shaped = f"(?<=[{_SHAPED}])[\u200c\u200d\u200e\u200f\u061c\u180b-\u180e]+(?=[{_SHAPED}])"
    # At one place: an emoji sequence or joined script stays; then a word, whose
    # end is the longest possible; a cluster with marks; a single character.
    units = re.compile(
        f"(?P<keep>(?=[^0-9#*]){emoji}|[0-9#*]\ufe0f\u20e3|{shaped}|[\ufe00-\ufe0f](?<=[{_EMOJI}].))"
        f"|(?P<word>[{letters}](?:[{letters}{inner}]*[{letters}{_MARKS}])?)|(?P<cluster>[^\\W_][{_MARKS}]+)|(?P<one>[{esc(table)}])",
        re.S,
    )
    suspect = re.compile(f"[{esc(table)}{esc(looks)}{_MARKS}]")
    return units, suspect


_LATIN = re.compile("[A-Za-zÀ-ɏḀ-ỿ]")
_FOREIGN = re.compile(f"[{_OTHERS}]")
_GREEK_SMALL, _GREEK = re.compile("[α-ωϐ-ϡ]"), re.compile("[Ͱ-Ͽ]")
_PHONETIC = re.compile("[ɐ-ʯ]")


def _as_latin(word: str, looks: dict[str, str]) -> str:
    """A word with letters of other scripts that stand for Latin ones replaced.  If all of
    them do, all are; else, where Latin letters prevail, those that do, except Greek and
    phonetic ones.  Small Greek letters other than omicron and nu, as in terms and units,
    count only among four or more small Latin letters."""
    foreign, latin = _FOREIGN.findall(word), _LATIN.findall(word)
    if not foreign or not latin:
        return word
    spelled = len(latin) >= 4 and all(map(str.islower, latin))
    stands = {c: looks[c] for c in foreign if c in looks and (spelled or c in LOOKALIKES or not _GREEK_SMALL.match(c))}
    if len(stands) < len(set(foreign)):
        stands = {c: x for c, x in stands.items() if not _GREEK.match(c) and not _PHONETIC.match(c)} if len(latin) > len(foreign) else {}
    return "".join(stands.get(c, c) for c in word)


def _replaced(m: re.Match, looks: dict[str, str]) -> str:
    kind, text = m.lastgroup, m.group()
    if kind == "keep" or text.isascii():
        return text
    table = mapping()
    text = "".join(table.get(c, c) for c in text)
    if kind == "word":
        text = _as_latin(text, looks)
    return text if kind == "one" else ud.normalize("NFC", text)


def to_one_form(text: str | None, looks: dict[str, str] = LOOKALIKES) -> str | None:
    """``text`` in one form; null stays null, empty stays empty.  Idempotent.

    Widths, ligatures, styled letters, spaces and invisible characters are
    replaced, composed letters are preferred, and look-alike letters of other scripts
    change only inside words that are Latin otherwise.  Kept: Chinese
    punctuation and the ideographic space, whole words of other scripts, emoji
    sequences, marks without composed form, symbols, superscripts, fractions."""
    if not text or text.isascii():
        return text
    units, suspect = _compiled("".join(looks))
    if not suspect.search(text):
        return text
    return units.sub(lambda m: _replaced(m, looks), text)


#: Ranges in which no character changes by itself; few, so that the JVM tests them quickly.
SAFE = ((0x0, 0x7E), (0xA1, 0xAC), (0xAE, 0x24F), (0x1E00, 0x1EFF), (0x2010, 0x2027), (0x3000, 0x3029), (0x4E00, 0x9FFF), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20))


@lru_cache(maxsize=1)
def suspect_pattern() -> str:
    """Java pattern of every text that could change, for a filter before Python."""
    if wrong := [c for c in {*mapping(), *LOOKALIKES} if any(a <= ord(c) <= b for a, b in SAFE)]:
        raise ValueError(f"not safe: {wrong}")
    return "[^" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in SAFE) + "]"


def unify_texts(frame: DataFrame, column: str, out: str = "one_form") -> DataFrame:
    """``frame`` with ``out``: the text of ``column`` in one form.  Texts without any
    character that could change stay in the JVM's hands but for the transfer."""

    looks = lookalikes(frame.sparkSession)

    @F.pandas_udf("string")
    def unify(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: to_one_form(t, looks), na_action="ignore")

    return frame.withColumn(out, F.when(F.col(column).rlike(suspect_pattern()), unify(column)).otherwise(F.col(column)))


def changed_records(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, rec_id) of records whose text is not in its one form.

    ``tables`` maps a name to (frame, text column).  Null and empty texts and
    rows without rec_id are no cases; repeated rows give their row each; nothing is shuffled."""
    rows = None
    looks = lookalikes(next(iter(tables.values()))[0].sparkSession)

    def changed(batches):
        for b in batches:
            yield b.loc[[to_one_form(t, looks) != t for t in b["text"]], ["table_name", "rec_id"]]

    for name, (frame, column) in tables.items():
        part = frame.select(F.lit(name).alias("table_name"), F.col("rec_id").cast("bigint").alias("rec_id"), F.col(column).alias("text"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.where(F.col("text").rlike(suspect_pattern()) & F.col("rec_id").isNotNull()).mapInPandas(changed, "table_name string, rec_id bigint")
