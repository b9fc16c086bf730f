"""Reading timestamps in mixed notations into one instant in UTC.

Each text is cut into tokens and reduced to a *mask*: one ``9`` per digit, one
class letter per word, punctuation as it is.  Few distinct masks exist, so the
work of recognising a notation is done once per mask (:func:`plan_for`), giving
the token that holds each field.  All texts of a mask are then converted
together with numpy, and local times go through a table of zone transitions.
"""

from __future__ import annotations

import re
import unicodedata
from datetime import datetime, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo, available_timezones

import numpy as np

US = 1_000_000

# Month names as written by English, Malay, Indonesian and French
# sources (accents and dots removed), in month order.
MONTH_WORDS = """
january jan januari janvier janv
february feb februari fevrier fevr fev pebruari
march mar mac mars maret
april apr avril avr
may mei mai
june jun juin juni
july jul julai juillet juil juli
august aug ogos aout agustus agu ags ogo
september sep sept septembre
october oct oktober octobre okt
november nov novembre
december dec disember decembre desember dis des
"""
MONTHS = {w: i for i, line in enumerate(MONTH_WORDS.split("\n")[1:-1], 1) for w in line.split()}
# Weekday names, same languages.
WEEKDAYS = set(
    """monday tuesday wednesday thursday friday saturday sunday mon tue tues wed thu thur thurs fri sat sun
    lundi mardi mercredi jeudi vendredi samedi dimanche lun mer jeu ven sam dim
    isnin selasa rabu khamis jumaat sabtu ahad senin kamis jumat minggu""".split()
)
ORDINALS = {"st", "nd", "rd", "th", "er", "re", "e", "eme"}
# Hours east of UTC of abbreviations for which the zone database
# holds only a number.
NUMBERED_ABBREVIATIONS = {
    "SGT": 8, "MYT": 8, "HKT": 8, "PHT": 8, "ICT": 7, "WIB": 7, "WITA": 8, "WIT": 9, "THA": 7,
    "BRT": -3, "ART": -3, "GST": 4, "NPT": 5.75, "BDT": 6, "UZT": 5, "AST": -4,
}
CHINESE_AM, CHINESE_PM = {"上午", "早上", "凌晨", "清晨", "早晨"}, {"下午", "晚上", "傍晚", "中午"}

_TOKEN = re.compile(
    r"[A-Za-z]+(?:/[A-Za-z_+\-0-9]+)+|\d+|上午|早上|凌晨|清晨|早晨|下午|晚上|傍晚|中午|(?:星期|周|週|礼拜)[一二三四五六日天]|[^\W\d_一-鿿]+|[一-鿿]|\s+|."
)
_UNITS = {"年": "Y", "月": "M", "日": "D", "号": "D", "號": "D", "时": "H", "時": "H", "点": "H", "點": "H", "分": "I", "秒": "S", "h": "H", "H": "H"}
_DIGITS = {d: str(unicodedata.digit(chr(d))) for d in range(128, 0x1FBFA) if unicodedata.category(chr(d)) == "Nd"}
_DIGITS |= {0x2212: "-", 0x2010: "-", 0x2011: "-", 0x2012: "-", 0x2013: "-"}


def fold(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c)).replace("đ", "d")


@lru_cache(maxsize=65536)
def word_class(word: str) -> str:
    """Class letter of a word: m month, w weekday, p half of the day, u UTC, T, Z,
    o ordinal ending, t/n/v the Vietnamese words for month, year and day, L zone
    name, W the mark of ISO weeks, unit letters of Chinese dates and of the hour, x anything else."""
    if "/" in word:
        return "L"
    if word in _UNITS:
        return _UNITS[word]
    if word in CHINESE_AM or word in CHINESE_PM:
        return "p"
    if word[0] in "星周週礼" and len(word) > 1:
        return "w"
    if word in ("T", "t"):
        return "T"
    if word in ("Z", "z"):
        return "Z"
    if word == "W":
        return "W"
    f = fold(word)
    if word.upper() in ("UTC", "UT", "GMT"):
        return "u"
    if f in MONTHS:
        return "m"
    if f in WEEKDAYS:
        return "w"
    if f in ("am", "pm"):
        return "p"
    if f in ORDINALS:
        return "o"
    return {"thang": "t", "nam": "n", "ngay": "v"}.get(f, "x")


def tokens_of(text: str) -> list[str]:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_DIGITS)
    text = text.strip()
    if "." in text and ("m." in text or "M." in text):
        text = re.sub(r"(?i)\b([ap])\.\s?m\.", r"\1m", text)
    return _TOKEN.findall(text)


def mask_of(tokens: list[str]) -> str:
    out = []
    for t in tokens:
        c = t[0]
        if "0" <= c <= "9":
            out.append("9" * len(t))
        elif c.isalpha():
            unit = t in _UNITS and not "".join(out[-2:]).rstrip().endswith("9")
            out.append("x" if unit else word_class(t))
        elif c.isspace():
            out.append(" ")
        else:
            out.append(c)
    return "".join(out)


_TIME = (
    r"(?:(?P<h>99?):(?P<mi>99)(?::(?P<s>99)(?:[.,](?P<f>9+))?)?(?: ?(?P<p>p))?"
    r"|(?P<p2>p) ?(?P<h2>99?)(?::(?P<mi2>99)(?::(?P<s2>99))?|H ?(?:(?P<mi3>99?)I ?(?:(?P<s3>99?)S)?)?)"
    r"|(?P<h4>99?)H ?(?:(?P<mi4>99?)I? ?(?:(?P<s4>99?)S)?)?|(?P<h5>99?)(?:\.(?P<mi5>99))? ?(?P<p5>p))"
)
_ZONE = (
    r"(?: ?(?:(?P<zz>Z)|(?P<sg>[+-])(?P<oh>99?):?(?P<om>99)?|(?P<oc>[+-]9999)|u ?(?P<sg2>[+-])(?P<oh2>99?)(?::?(?P<om2>99))?|(?P<u>u)|(?P<abb>[xmw])|(?P<loc>L))"
    r"(?: ?(?:\[L\]|\([xuwmZ]\)))?)?"
)
_DATE = (
    r"(?:(?P<y>9999)(?P<sep>[-/.])(?P<mo>99?)(?P=sep)(?P<d>99?)"
    r"|(?P<y2>9999)Y ?(?P<mo2>99?)M ?(?P<d2>99?)D"
    r"|(?P<d3>99?)o?(?: x)?[ .\-/]{1,2}(?P<m3>m)[ .,\-/]{1,2}(?P<y3>9999|99)"
    r"|(?P<m4>m)\.?[ -](?P<d4>99?)o?(?:, ?| |-)(?P<y4>9999)"
    r"|(?:v )?(?P<d5>99?) t (?P<mo5>99?)(?:, ?| n | )(?P<y5>9999)"
    r"|(?P<wy>9999)-W(?P<ww>99)-(?P<wd>9)|(?P<wy2>9999)W(?P<wc>999)"
    r"|(?P<a>99?)(?P<sep2>[-/.])(?P<b>99?)(?P=sep2)(?P<c>9999|99))"
)
_FULL = re.compile(rf"(?:x[ :.]*)*(?:w[,.]? ?)?(?:{_DATE})(?: ?w)?(?:(?:[T ,]| , ?|, | T ?| - ?| x )?{_TIME})?{_ZONE}\Z")
_COMPACT = re.compile(r"(?:x[ :.]*)*(?P<cd>99999999)(?:[T ]?(?P<ct>999999|9999)(?:[.,](?P<cf>9+))?)?" + _ZONE + r"\Z")
_TIME_FIRST = re.compile(rf"(?:x[ :.]*)*{_TIME}(?:,? | ?- ?| x )(?:w[,.]? ?)?(?:{_DATE}){_ZONE}\Z")
_EPOCH = re.compile(r"(?P<e>9{10}|9{13}|9{16}|9{19})(?:\.(?P<ef>9+))?\Z")


@lru_cache(maxsize=4096)
def plan_for(mask: str) -> dict | None:
    """Fields of a mask as ``{field: (token, first, end)}``, or None if it is no timestamp."""
    m = None
    if re.fullmatch(r"9{12}|9{14}", mask):
        return {"cd": (0, 0, 8), "ct": (0, 8, len(mask))}
    for pattern in (_EPOCH, _COMPACT, _FULL, _TIME_FIRST):
        if m := pattern.match(mask):
            break
    if not m:
        return None
    starts, k, at = [], 0, 0
    for part in re.findall(r"9+|.", mask):
        starts.append(at)
        at += len(part)
    index = {s: i for i, s in enumerate(starts)}
    fields = {}
    for name, value in m.groupdict().items():
        if value is not None and not name.startswith("sep"):
            if name == "oc":
                fields["sg"], fields["oc"] = (index[m.start(name)],), (index[m.start(name) + 1],)
            elif name == "oh" and len(value) == 2 and m["om"] and m.start("om") == m.end("oh"):
                fields["oc"] = (index[m.start(name)],)  # +0800 is a single number
            elif name == "om" and m.start("om") == m.end("oh"):
                continue
            elif name == "om2" and m.start("om2") == m.end("oh2"):
                return None
            else:
                fields[name] = (index[m.start(name)],)
    return fields


def days_from_civil(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 of proleptic Gregorian dates."""
    months = (y.astype(np.int64) - 1970) * 12 + (m - 1)
    return months.astype("datetime64[M]").astype("datetime64[D]").astype(np.int64) + d - 1


def month_length(y: np.ndarray, m: np.ndarray) -> np.ndarray:
    months = ((y.astype(np.int64) - 1970) * 12 + (m - 1)).astype("datetime64[M]")
    return ((months + 1).astype("datetime64[D]") - months.astype("datetime64[D]")).astype(np.int64)


#: Years in which transitions are tabled; no zone changed before, and after them its last rules go on.
FIRST_YEAR, LAST_YEAR = 1840, 2100


def _new_year(years: np.ndarray) -> np.ndarray:
    one = np.ones(len(years), np.int64)
    return days_from_civil(years, one, one) * 86400


def _same_days(years: np.ndarray) -> np.ndarray:
    """For each year the last tabled one with the same length and first weekday."""
    kind = lambda y: _new_year(y) // 86400 % 7 * 2 + (month_length(y, np.full(len(y), 2)) == 29)
    tabled = np.arange(LAST_YEAR - 28, LAST_YEAR)
    last = np.zeros(14, np.int64)
    last[kind(tabled)] = tabled
    return last[kind(years)]


_LAST_WALL = int(_new_year(np.array([LAST_YEAR]))[0])


class ZoneTable:
    """Transitions of one zone: ``local`` thresholds in seconds of wall time,
    ``offsets`` in seconds (one more than thresholds) and abbreviations.

    The threshold of a change is its instant plus the larger of both offsets, so
    a wall time that occurs twice takes the offset before the change (its first
    occurrence) and one that is skipped also takes it, which moves the time
    forward by the length of the gap."""

    def __init__(self, name: str):
        zone, utc = ZoneInfo(name), timezone.utc
        at = lambda t: datetime.fromtimestamp(t, utc).astimezone(zone)
        off = lambda t: int(at(t).utcoffset().total_seconds())
        begin = int(datetime(FIRST_YEAR, 1, 1, tzinfo=utc).timestamp())
        end = int(datetime(LAST_YEAR, 1, 1, tzinfo=utc).timestamp())
        step, self.abbreviations = 14 * 86400, {}
        local, offsets, t, o = [], [off(begin)], begin, off(begin)
        while t < end:
            if (n := off(t + step)) != o:
                lo, hi = t, t + step
                while hi - lo > 1:
                    mid = (lo + hi) // 2
                    lo, hi = (lo, mid) if off(mid) != o else (mid, hi)
                local.append(hi + max(o, off(hi)))
                o = off(hi)
                offsets.append(o)
                self.abbreviations[at(hi).tzname()] = o
                if o != n:
                    t = hi
                    continue
            t += step
        for t in range(int(datetime(2000, 1, 1, tzinfo=utc).timestamp()), int(datetime(2030, 1, 1, tzinfo=utc).timestamp()), 30 * 86400):
            self.abbreviations[at(t).tzname()] = off(t)
        self.local, self.offsets = np.array(local, np.int64), np.array(offsets, np.int64)

    def offset_at(self, wall: np.ndarray) -> np.ndarray:
        late = wall >= _LAST_WALL
        if late.any():  # the year with the same days of the week among the last of the table
            years = (wall[late] // 86400).astype("datetime64[D]").astype("datetime64[Y]").astype(np.int64) + 1970
            wall = wall.copy()
            wall[late] += _new_year(_same_days(years)) - _new_year(years)
        return self.offsets[np.searchsorted(self.local, wall, side="right")]


def zone_version() -> str:
    """Version of the zone database in use, recorded beside converted data."""
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        for p in ("/usr/share/zoneinfo/tzdata.zi", "/usr/share/zoneinfo/+VERSION"):
            try:
                return open(p).readline().split()[-1]
            except OSError:
                continue
    return "unknown"


@lru_cache(maxsize=None)
def _zone_names() -> frozenset:
    return frozenset(available_timezones())


_pinned: dict[str, object] = {"version": None, "tables": {}}


def build_tables(names) -> dict:
    """Tables of the zones named, with the version of the database they come from, to be
    shipped to workers.  Names that are no zones are left out."""
    return {"version": zone_version(), "tables": {n: ZoneTable(n) for n in set(names) & _zone_names()}}


def use_tables(bundle: dict) -> None:
    """Makes a worker use shipped tables."""
    if _pinned["version"] != bundle["version"] or not bundle["tables"].keys() <= _pinned["tables"].keys():
        _pinned.update(version=bundle["version"], tables={**bundle["tables"]})
        zone_table.cache_clear()
        abbreviation_offset.cache_clear()


@lru_cache(maxsize=1024)
def zone_table(name: str) -> ZoneTable | None:
    """The table of a zone: the shipped one, else one made here from the same version of
    the database; another version is an error, as results would depend on the worker."""
    if name in _pinned["tables"]:
        return _pinned["tables"][name]
    if name not in _zone_names():
        return None
    if _pinned["version"] not in (None, zone_version()):
        raise RuntimeError(f"zone database {zone_version()} here, {_pinned['version']} on the driver")
    return ZoneTable(name)


@lru_cache(maxsize=65536)
def abbreviation_offset(word: str, zone: str | None) -> int | None:
    """Seconds east of UTC of an abbreviation as used in the source's own zone."""
    word = word.upper()
    if zone and (table := zone_table(zone)):
        if word in table.abbreviations:
            return table.abbreviations[word]
        if word in ("UTC", "UT", "GMT", "Z"):
            return 0
        if word in NUMBERED_ABBREVIATIONS:
            return int(NUMBERED_ABBREVIATIONS[word] * 3600)
    return 0 if word in ("UTC", "UT", "GMT", "Z") else None


def _numbers(column: list[str]) -> np.ndarray:
    return np.array(column, dtype="U20").astype(np.int64)


def _fraction(column: list[str]) -> np.ndarray:
    return _numbers([(v + "000000")[:6] for v in column])


def _convert(plan: dict, rows: list[list[str]], zones, orders, calendars) -> tuple[np.ndarray, np.ndarray]:
    """Micros and validity of all rows of one mask."""
    n = len(rows)

    def raw(*names):
        for name in names:
            if name in plan:
                i, *cut = plan[name]
                return [r[i][cut[0] : cut[1]] for r in rows] if cut else [r[i] for r in rows]
        return None

    def num(*names):
        column = raw(*names)
        return np.zeros(n, np.int64) if column is None else _numbers(column)

    ok = np.ones(n, bool)
    if "e" in plan:
        width = len(rows[0][plan["e"][0]])
        e = num("e")
        micros = e * 10 ** (16 - width) if width <= 16 else e // 1000
        if "ef" in plan:
            if width != 10:
                return micros, ~ok
            micros = micros + _fraction(raw("ef"))
        return micros, ok
    buddhist = np.array([c == "buddhist" for c in calendars])
    if "cd" in plan:
        date = raw("cd")
        y, mo, d = (_numbers([v[a:b] for v in date]) for a, b in ((0, 4), (4, 6), (6, 8)))
        time = raw("ct")
        if time is None:
            h = mi = s = np.zeros(n, np.int64)
        else:
            h, mi = _numbers([v[:2] for v in time]), _numbers([v[2:4] for v in time])
            s = _numbers([v[4:6] or "0" for v in time])
        half = None
    else:
        if "a" in plan:
            a, b, c, width = num("a"), num("b"), num("c"), len(rows[0][plan["c"][0]])
            order = np.array(orders, dtype=object)
            short = width == 2
            mdy, ymd = order == "mdy", order == "ymd"
            d = np.where(mdy, b, a)
            mo = np.where(mdy, a, b)
            y = c.copy()
            if short:
                d, y = np.where(ymd, c, d), np.where(ymd, a, y)
                ok &= np.isin(order, ["dmy", "mdy", "ymd"])
            else:
                ok &= np.isin(order, ["dmy", "mdy"])
            short_year = np.full(n, short)
        else:
            y, d = num("y", "y2", "y3", "y4", "y5", "wy", "wy2"), num("d", "d2", "d3", "d4", "d5")
            months = raw("m3", "m4")
            mo = num("mo", "mo2", "mo5") if months is None else np.array([MONTHS[fold(v)] for v in months], np.int64)
            short_year = np.full(n, "y3" in plan and len(rows[0][plan["y3"][0]]) == 2)
        y = np.where(short_year, y + 2000, y)
        h, mi, s = num("h", "h2", "h4", "h5"), num("mi", "mi2", "mi3", "mi4", "mi5"), num("s", "s2", "s3", "s4")
        half = raw("p", "p2", "p5")
    y = np.where(buddhist & (y >= 2400), y - 543, y)
    if half is not None:
        latin = np.array([v[0].lower() in "ap" for v in half])
        pm = np.array([v in CHINESE_PM or v.lower().startswith("p") for v in half])
        ok &= (h <= 12) | ~latin & (h < 24)
        ok &= ~latin | (h >= 1)
        h = np.where(h > 12, h, h % 12 + 12 * pm)
    frac = raw("f", "cf")
    micros = np.zeros(n, np.int64) if frac is None else _fraction(frac)
    week = None
    if "wy" in plan or "wy2" in plan:
        week, day = (num("wc") // 10, num("wc") % 10) if "wc" in plan else (num("ww"), num("wd"))
        mo, d = np.ones(n, np.int64), np.ones(n, np.int64)
    midnight = (h == 24) & (mi == 0) & (s == 0) & (micros == 0)  # the end of a day
    ok &= (y >= 1) & (mo >= 1) & (mo <= 12) & ((h < 24) | midnight) & (mi < 60) & (s < 60)
    y, mo = np.where(ok, y, 2000), np.where(ok, mo, 1)
    ok &= (d >= 1) & (d <= month_length(y, mo))
    days = days_from_civil(y, mo, np.where(ok, d, 1))
    if week is not None:  # the first week is that of January 4th
        four = days + 3
        first = four - (four + 3) % 7
        after = days_from_civil(y + 1, mo, mo) + 3
        weeks = (after - (after + 3) % 7 - first) // 7
        ok &= (week >= 1) & (week <= weeks) & (day >= 1) & (day <= 7)
        days = first + (week - 1) * 7 + day - 1
    wall = days * 86400 + h * 3600 + mi * 60 + s
    offset = np.zeros(n, np.int64)
    if "zz" in plan or ("u" in plan and "sg2" not in plan and "abb" not in plan):
        words = raw("zz", "u")
        if "u" in plan:  # a source's own zone may use GMT in its own sense
            offset = np.array([abbreviation_offset(w, z) or 0 for w, z in zip(words, zones)], np.int64)
    elif "sg" in plan or "sg2" in plan:
        sign = np.array([-1 if v == "-" else 1 for v in raw("sg", "sg2")], np.int64)
        if "oc" in plan:
            o = num("oc")
            hours, minutes = o // 100, o % 100
        else:
            hours, minutes = num("oh", "oh2"), num("om", "om2")
        ok &= (hours <= 18) & (minutes < 60)
        offset = sign * (hours * 3600 + minutes * 60)
    elif "abb" in plan:
        found = [abbreviation_offset(w, z) for w, z in zip(raw("abb"), zones)]
        ok &= np.array([o is not None for o in found])
        offset = np.array([o or 0 for o in found], np.int64)
    else:
        names = np.array(raw("loc") if "loc" in plan else [z or "" for z in zones], dtype=object)
        for name in set(names):
            here, table = names == name, zone_table(name) if name else None
            if table is None:
                ok &= ~here
            else:
                offset[here] = table.offset_at(wall[here])
    return (wall - offset) * US + micros, ok


def to_micros(texts, zones, orders, calendars) -> tuple[np.ndarray, np.ndarray]:
    """UTC microseconds of ``texts`` and which of them could be read.

    ``zones``, ``orders`` (ymd, dmy, mdy) and ``calendars`` belong to the source
    of each text; None where it is unknown."""
    n = len(texts)
    micros, ok = np.zeros(n, np.int64), np.zeros(n, bool)
    groups: dict[str, tuple[list[int], list[list[str]]]] = {}
    for i, t in enumerate(texts):
        if isinstance(t, str) and len(t) >= 6:  # no date is shorter
            tokens = tokens_of(t)
            where, rows = groups.setdefault(mask_of(tokens), ([], []))
            where.append(i)
            rows.append(tokens)
    for mask, (where, rows) in groups.items():
        if plan := plan_for(mask) if len(mask) <= 200 else plan_for.__wrapped__(mask):  # long masks are not remembered
            w = np.array(where)
            micros[w], ok[w] = _convert(plan, rows, [zones[i] for i in where], [orders[i] for i in where], [calendars[i] for i in where])
    return micros, ok
