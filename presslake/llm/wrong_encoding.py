"""Problem 10: texts, or passages of them, that were read in the wrong encoding.

Suspicious passages (runs of characters beyond ASCII within a line, or parts of a run
where clean and garbled characters meet, entities) are searched best-first: a state is a reading of the passage, an edge takes it back to bytes in
one encoding and reads these in another, or resolves entities; states seen are
kept by hash.  A cost of implausible characters orders the search, and the
cheapest reachable reading replaces the passage if it is clearly cheaper.  Where
bytes were lost (replacement characters, letters turned to question marks) the
passage is found but stays as it is."""

from __future__ import annotations

import heapq
import html
import re
from functools import lru_cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Encodings a text may wrongly have been read in, and those it may have been written in.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp1250", "gb18030", "big5hkscs", "big5", "shift_jis", "euc_kr")
WRITTEN_IN = ("utf-8", "gb18030", "cp1252", "big5hkscs", "shift_jis")
SINGLE_BYTE = {"cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp1250"}
CLEAN = 0.05  # cost per character up to which a passage needs no other reading
WINDOW = 600  # a longer passage that has no clean reading as a whole is read in windows of so many characters, too


def _level(first: int, last: int, encoding: str = "gb2312", low: int = 0xA1) -> str:
    out = []
    for a in range(first, last):
        for b in range(low, 0xFF):
            try:
                out.append(bytes((a, b)).decode(encoding))
            except UnicodeDecodeError:
                pass
    return "".join(out)


# Everyday and other characters of the national standard for simplified Chinese.
_EVERYDAY, _OTHER = _level(0xB0, 0xD8), _level(0xD8, 0xF8)
# Everyday characters of the standard for traditional Chinese that the other one lacks.
_TRADITIONAL = "".join(sorted(set(_level(0xA4, 0xC7, "big5", 0x40)) - set(_EVERYDAY + _OTHER)))
_PUNCTUATION = "\u3000、。〈〉《》「」『』【】〔〕〖〗！（），－．：；？％～＋／＜＝＞［］“”‘’…—·–•0123456789〇"
_RARE = re.compile(f"[^{re.escape(_EVERYDAY)}{re.escape(_PUNCTUATION)}]")
_VERY_RARE = re.compile(f"[\u3400-\u9fff\uf900-\ufaff](?<![{_EVERYDAY}{_OTHER}{_TRADITIONAL}])")
_OLD_FORM = re.compile(f"[{_TRADITIONAL}]")
_KANA = re.compile("[\u3041-\u30fa]")
_OTHER_HAN = re.compile(f"[{_OTHER}]")
_BROKEN = re.compile("[�\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\ue000-\uf8ff\ufff0-￼]")
# Of these, what shows a wrong reading by itself: replacement characters, control characters that are no
# breaks, private characters among others beyond ASCII.
_SURE = re.compile("[\ufffd\x00-\x08\x0e-\x1a\x7f-\x84\x86-\x9f]|(?<=[^\x00-\x7e])[\ue000-\uf8ff]|[\ue000-\uf8ff](?=[^\x00-\x7e])")
_HAN = re.compile("[㐀-鿿]")
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏḀ-ỿ"
# Inside words: a capital after a small letter, a sign beside a letter beyond ASCII, letters of two alphabets.
_CASE = re.compile("(?<=[a-zß-öø-ÿ])[À-ÖØ-Þ]")
_SIGN = re.compile("[\u00a0¡-©«\u00ad-±´¶-¹»-¿×÷ˆ˜‚„†‡‰‹›€™ƒŒœŽžŠšŸ•¤ªº]")
_SIGN_RUN = re.compile("[\u00a0-¿×÷À-ÿŒœŽžŠšŸƒˆ˜‚-„†‡‰‹›€™“”‘’–—…•]{2,}")
_QUOTE_MARK = re.compile("^«(?=[À-Ý]$)|(?<=^[à-ý])»$")  # around a letter by itself
_ODD = re.compile("[─-╿▀-▟⌠⌡∙√∞∩≈≡≤≥⌂∂∆∏∑∫◊ﬁﬂıŒ‡Ω\uf8ffｦ-ﾟㄅ-ㄯ]")
_MIXED = re.compile(f"(?<=[{_LATIN}])(?![αβγδμΩ])[Ͱ-ϿЀ-ԯ]|(?![αβγδμΩ])[Ͱ-ϿЀ-ԯ](?=[{_LATIN}])")
_QUOTED = re.compile("[À-ßĂ-ż][‘’“”–—…]")
# Cyrillic beside a sign, or Cyrillic letters that few alphabets use; scripts far from the sources'.
_SLAVIC = re.compile("[Ѐ-ӿ](?=[\u00a0-\u00bf€™“”‘’–—…‚„†‡‰‹›•№])|[ЂЃѓЉЊЌЋЏђљњќћџ]")
_SLAVIC_QUOTE = re.compile("[а-яё](?=»)")
_FAR = re.compile("[ƀ-ƑƓ-ƟƢ-ƮƱ-ˆˈ-˘˝-˿Ա-֏܀-ࣿऀ-\u0dff\u0e80-\u10ff\u1200-\u1cff\ua000-\uabff]")
_ENTITY = re.compile(r"&(?:#\d{2,7}|#x[0-9a-fA-F]{2,6}|[A-Za-z]{2,8}\d?);")


def cost(text: str) -> float:
    """Implausibility of the characters of a passage; near 0 for clean text.  A
    passage of fewer characters is cheaper, so that a right reading of many bytes
    as one letter gains."""
    n = len(text)
    total = 0.03 * n
    total += 6.0 * len(_BROKEN.findall(text))
    total += 1.5 * len(_VERY_RARE.findall(text)) + 0.7 * len(_OTHER_HAN.findall(text)) + 0.6 * len(_OLD_FORM.findall(text)) + 0.5 * len(_KANA.findall(text))
    total += 1.0 * len(_ODD.findall(text)) + 1.0 * len(_MIXED.findall(text)) + 0.8 * len(_CASE.findall(text))
    for run in _SIGN_RUN.findall(text):
        run = _QUOTE_MARK.sub("", run)
        if signs := len(_SIGN.findall(run)):
            total += 0.6 * signs + 0.3 * len(run)
    total += 0.9 * len(_QUOTED.findall(text)) + 1.0 * len(_SLAVIC.findall(text)) + 1.0 * len(_FAR.findall(text))
    total += 0.25 * len(_ENTITY.findall(text))
    return total


def _table(encoding: str) -> dict[str, int]:
    table = {}
    for b in range(256):
        try:
            c = bytes((b,)).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)  # undefined bytes come through as control characters
        table.setdefault(c, b)
    return table


_BYTES = {e: _table(e) for e in SINGLE_BYTE}


def _back(text: str, encoding: str) -> bytes | None:
    if "�" in text:  # lost; as bytes it would only be taken for other characters
        return None
    if encoding in SINGLE_BYTE:
        table = _BYTES[encoding]
        try:
            return bytes([table[c] for c in text])
        except KeyError:
            return None
    try:
        return text.encode(encoding)
    except UnicodeEncodeError:
        return None


_CHARS = {e: {b: c for c, b in _BYTES[e].items()} for e in SINGLE_BYTE}


def _forth(raw: bytes, encoding: str) -> str | None:
    """Bytes as they were read in the wrong encoding: the inverse of :func:`_back`."""
    try:
        return "".join(map(_CHARS[encoding].__getitem__, raw)) if encoding in SINGLE_BYTE else raw.decode(encoding)
    except (KeyError, UnicodeDecodeError):
        return None


def _readings(text: str):
    """(reading, extra cost) of the edges from a state.  Only readings that lead back to
    ``text`` when they are encoded and misread again count: a path loses nothing."""
    if "&" in text and (plain := html.unescape(text)) != text:
        yield plain, 0.0
    for e in READ_AS:
        if (raw := _back(text, e)) is None or e not in SINGLE_BYTE and raw.decode(e, "replace") != text:
            continue
        for d in WRITTEN_IN:
            if d == e or d == "cp1252" and e not in ("mac_roman", "cp437", "cp850", "cp1251", "cp1250", "koi8_r"):
                continue
            try:
                reading = raw.decode(d)
                if reading.encode(d) == raw:
                    yield reading, 0.0 if d == "utf-8" else 0.4  # bytes that happen to be valid UTF-8 are rare
            except UnicodeError:
                continue


def is_clean(text: str) -> bool:
    """Whether a reading may replace a passage: nothing in it looks misread itself, and
    no more of its Chinese characters than usual are off the everyday lists."""
    other, old = len(_OTHER_HAN.findall(text)), len(_OLD_FORM.findall(text))
    rest = cost(text) - 0.7 * other - 0.6 * old - 0.5 * len(_KANA.findall(text)) - len(_SLAVIC_QUOTE.findall(text))
    return rest <= CLEAN * len(text) + 0.3 and other <= 1 + 0.35 * len(_HAN.findall(text)) and not other == len(text) <= 2


def _search(passage: str) -> tuple[str, float, float]:
    start = cost(passage)
    heap, seen, best, best_cost = [(start, 0.0, start, passage)], {hash(passage)}, passage, start
    while heap:
        c, chance, real, text = heapq.heappop(heap)
        if c < best_cost:
            best, best_cost = text, c
        if real <= CLEAN * len(text):
            if not chance:
                break  # the cheapest state comes first, and this one is clean
            continue
        for reading, more in _readings(text):
            # A right step shortens a passage or makes it cheaper; as no other edge is taken and no
            # state twice, the search ends by itself, however often a passage was misread.
            if (h := hash(reading)) not in seen and ((to := cost(reading)) < real or len(reading) < len(text)):
                seen.add(h)
                heapq.heappush(heap, (to + max(chance, more), max(chance, more), to, reading))
    return best, best_cost, start


_short = lru_cache(maxsize=50_000)(_search)


def best_reading(passage: str) -> tuple[str, float, float]:
    """Cheapest reading, its cost, and the cost of the passage as it stands."""
    return _short(passage) if len(passage) <= WINDOW else _search(passage)


# Runs end at line breaks.
_RUN = re.compile("[^\x00-\x7e](?:[^\x00-\x7e]|(?<=[^\x00-\x7e])[\x00-\x09\x0b\x0c\x0e-\x7e](?=[^\x00-\x7e]))*")
# Stretches that a code page of single bytes can have made, and clean punctuation that stands in these code pages too.
_SINGLE = re.compile("[\x00-\x7e%s]+" % re.escape("".join(sorted({c for table in _BYTES.values() for c in table if c > "\x7e"}))))
_EDGE = f"[\x00-\x7e{re.escape(_PUNCTUATION)}]+"
_FIRST_EDGE, _LAST_EDGE = re.compile(f"^{_EDGE}"), re.compile(f"{_EDGE}$")
_DRAWN = re.compile(f"(?<![{_LATIN}])[─│┌┐└┘├┤┬┴┼][─│┌┐└┘├┤┬┴┼ ]*(?![{_LATIN}])")  # lines of a tree or table that stand by themselves
PAIRS = 6  # characters that a passage in a clean Chinese run needs if pairs of bytes were read as other pairs
SHARE = 8  # of so many Chinese characters in a garbled passage at least one is doubtful
_LOST_INSIDE = re.compile(f"(?<=[a-zß-öø-ÿ])\\?(?=[a-zß-öø-ÿ])")
_LOST_BEFORE = re.compile(f"(?:(?<=\\s)|^)\\?+(?=[{_LATIN}])")
_LOST_RUN = re.compile(r"\?{3,}")
_PARAMETER = re.compile(r"[?&]\w+=")


def lost_letters(text: str) -> bool:
    """Whether letters of a text became question marks: two inside words of small
    letters, or in a line repeated ones in front of words; one alone may be a missing
    blank.  Addresses are not looked at."""
    if "?" not in text:
        return False
    inside = 0
    for line in text.split("\n"):
        if line.count("?"):
            line = " ".join(w for w in line.split() if "://" not in w and "www." not in w and not _PARAMETER.search(w))
            inside += len(_LOST_INSIDE.findall(line))
            if inside > 1 or len(_LOST_BEFORE.findall(line)) > 1 or len(_LOST_RUN.findall(line)) > 1:
                return True
    return False


def _suspicious(run: str) -> bool:
    if len(run) == 1:
        return False
    if _HAN.search(run):
        rare = len(_RARE.findall(run))
        return rare >= 2 and rare * SHARE >= len(run)
    return True


def _gains(found: tuple[str, float, float]) -> bool:
    _, after, before = found
    return before - after > 0.5 and after < 0.6 * before


def _windows(run: str):
    """A passage as a whole if it is short or has a clean reading so; else a long passage in windows whose ends don't cut a character of the better reading:
    of the lengths tried, the one whose reading is the cheapest per character."""
    if len(run) <= WINDOW or _gains(found := best_reading(run)) and is_clean(found[0]):
        yield 0, run
        return
    i = 0
    while i < len(run):
        rest = len(run) - i
        lengths = [rest] if rest <= WINDOW else range(WINDOW, WINDOW - 4, -1)
        pick = min(lengths, key=lambda n: best_reading(run[i : i + n])[1] / n)
        yield i, run[i : i + pick]
        i += pick


def _searched(run: str, at: int) -> list[tuple[int, int, str]]:
    return [(at + i, at + i + len(part), found[0]) for i, part in _windows(run) if _gains(found := best_reading(part))]


def _single_parts(run: str, at: int) -> list[tuple[int, int, str]]:
    """Passages in the stretches of a run that single bytes can have made."""
    out = []
    for m in _SINGLE.finditer(run):
        first, end = _FIRST_EDGE.match(m.group()), _LAST_EDGE.search(m.group())
        a, b = m.start() + (first.end() if first else 0), m.start() + (end.start() if end else len(m.group()))
        if "�" in run[max(0, m.start() - 1) : m.end() + 1]:
            continue  # bytes of this passage were lost
        for x, y in dict.fromkeys(((m.start(), m.end()), (a, m.end()), (m.start(), b), (a, b))):  # clean punctuation beside a passage isn't part of it
            if y - x > 1 and (found := [f for f in _searched(run[x:y], at + x) if f[1] - f[0] - len(f[2]) > 1 or any(c.isalpha() or c in "，。、；：？！（）《》" for c in f[2])]):
                out += found
                break
    return out


MANY_BYTES = tuple(e for e in READ_AS if e not in SINGLE_BYTE)
#: In hundredths: what a passage has to gain, and the most that one character of a reading counts while ends are sought, so that a rare one alone cuts no passage.
GAIN, MOST = 50, 50
_UTF8 = re.compile(b"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+")
_UTF8_HAN = re.compile(b"[\xe3-\xe9][\x80-\xbf]{2}")


@lru_cache(maxsize=100_000)
def _one_cost(c: str) -> int:
    return round(100 * cost(c))


@lru_cache(maxsize=300_000)
def _coded(c: str, e: str) -> bytes | None:
    raw = _back(c, e)
    return raw if raw and raw.decode(e, "replace") == c else None


@lru_cache(maxsize=300_000)
def _read_cost(piece: bytes, d: str) -> int | None:
    """Cost of the character that is written ``piece``; None if none is."""
    try:
        c = piece.decode(d)
    except UnicodeDecodeError:
        return None
    return min(MOST, _one_cost(c)) if c.encode(d) == piece else None


def _zones(weights: list[int]) -> list[tuple[int, int]]:
    """Stretches (first, end) of all places that lie in a span whose weights add up to 0 or more."""
    ending, before = [], 0
    for x in weights:
        before = x + max(before, 0)
        ending.append(before)
    out, after = [], 0
    for i in range(len(weights) - 1, -1, -1):
        after = weights[i] + max(after, 0)
        if ending[i] + after - weights[i] >= 0:
            if out and out[-1][0] == i + 1:
                out[-1] = (i, out[-1][1])
            else:
                out.append((i, i + 1))
    return out[::-1]


def _cheapest_cut(part: str, e: str, d: str, weight: int) -> list[tuple[int, int]]:
    """Spans of ``part``, which ``e`` can write, that are read in ``d`` when the whole is as cheap as it
    can be: each place is left or read, each span read costs GAIN.  One pass over the bytes."""
    coded = [_coded(c, e) for c in part]
    raw, at, o = b"".join(coded), {}, 0
    for i, piece in enumerate(coded):
        at[o] = i
        o += len(piece)
    at[o] = len(part)
    least, begun = [0] * (len(part) + 1), [-1] * (len(part) + 1)
    inside: dict[int, tuple[int, int]] = {}  # by byte: cost of the text before it, and where the span that is being read began
    for o in range(len(raw) + 1):
        state = inside.pop(o, None)
        if (i := at.get(o)) is not None:
            if i:
                least[i] = least[i - 1] + _one_cost(part[i - 1])
            if state and state[0] < least[i]:
                least[i], begun[i] = state
            if not state or least[i] + GAIN <= state[0]:
                state = least[i] + GAIN, i
        if state:
            for n in range(1, 5):
                if (c := _read_cost(raw[o : o + n], d)) is not None:
                    to = state[0] + weight * c, state[1]
                    if o + n not in inside or to[0] < inside[o + n][0]:
                        inside[o + n] = to
                    break
    out, i = [], len(part)
    while i:
        if begun[i] >= 0:
            out.append((begun[i], i))
            i = begun[i]
        else:
            i -= 1
    return out


def _writable(run: str, first: int, end: int, e: str):
    """(first, end, bytes) of the stretches of run[first:end] that ``e`` can write."""
    pieces = []
    for i in range(first, end + 1):
        piece = _coded(run[i], e) if i < end else None
        if piece:
            pieces.append(piece)
        elif pieces:
            yield i - len(pieces), i, pieces
            pieces = []


def _pieces(run: str):
    """(first, end, encoding it was read in, encoding it may be written in) of all parts of a run that can
    hold a passage :func:`_sure` takes."""
    rare = [m.start() for m in _RARE.finditer(run)]
    if not any(b - a < 2 * SHARE for a, b in zip(rare, rare[1:])):
        return
    weights = [-1] * len(run)
    for i in rare:
        weights[i] = SHARE - 1
    for first, end in _zones(weights):
        for e in MANY_BYTES:
            for x, _, pieces in _writable(run, first, end, e):
                starts = dict(zip(accumulate(map(len, pieces), initial=0), range(x, x + len(pieces) + 1)))
                for m in _UTF8.finditer(b"".join(pieces)):
                    if len(_UTF8_HAN.findall(m.group())) >= 2:
                        inner = [starts[o] for o in range(m.start(), m.end() + 1) if o in starts]
                        if len(inner) > 1:
                            yield inner[0], inner[-1], e, "utf-8"
    for first, end in _zones([_one_cost(c) - 60 for c in run]):
        if end - first >= PAIRS:
            for e in MANY_BYTES:
                for x, y, _ in _writable(run, first, end, e):
                    for d in WRITTEN_IN:
                        if y - x >= PAIRS and d not in ("utf-8", "cp1252", e):
                            yield x, y, e, d


def _sure(part: str, found: tuple[str, float, float]) -> bool:
    """Whether the reading of a part of a Chinese run is no chance: two characters or more
    of UTF-8, or PAIRS characters of pairs of bytes, most doubtful before and nearly all plain after."""
    reading, after, before = found
    if len(reading) < len(part):
        return len(_HAN.findall(reading)) >= 2 and after <= 0.4 + 0.15 * len(reading)
    return len(part) >= PAIRS and before >= 0.6 * len(part) and after <= 0.4 + 0.08 * len(reading)


def _by_itself(run: str, first: int, end: int, before: float) -> bool:
    """Whether a plain reading is no chance within a text in traditional characters: not so
    many of these stand beside it, or those inside are not doubtful for their old form alone."""
    near = run[max(0, first - SHARE) : first] + run[end : end + SHARE]
    return len(_OLD_FORM.findall(near)) < 3 or before - 0.6 * len(_OLD_FORM.findall(run[first:end])) >= 0.25 * (end - first)


def _many_parts(run: str, at: int) -> list[tuple[int, int, str]]:
    """Passages about doubtful Chinese characters of a run: for each pair of encodings the
    cheapest cut of every part that can hold one, wherever it begins and however long it
    is.  Of spans that overlap the one with the greatest gain counts, then the shortest."""
    found = []
    for first, end, e, d in dict.fromkeys(_pieces(run)):
        open_ = [(first, end, 1)]
        while open_:
            a, b, weight = open_.pop()
            for x, y in _cheapest_cut(run[a:b], e, d, weight):
                part = run[a + x : a + y]
                if len(part) > 1 and _HAN.search(part) and _suspicious(part) and _gains(r := best_reading(part)) and _sure(part, r) and (len(part) > len(r[0]) > 3 or _by_itself(run, a + x, a + y, r[2])):
                    found.append((round(r[1] - r[2], 6), y - x, a + x, a + y, r[0]))
                elif weight < 8:  # a part of it may be read without its doubtful characters
                    open_.append((a + x, a + y, 2 * weight))
    if not found:
        return []
    taken, displaced = [False] * len(run), False
    group: list[int] = []
    for i in [m.start() for m in _RARE.finditer(run)] + [len(run) + SHARE + 1]:
        if group and i - group[-1] > SHARE:
            if "�" in run[group[0] : group[-1] + 1]:  # bytes of this passage were lost
                taken[group[0] : group[-1] + 1] = [True] * (group[-1] + 1 - group[0])
            group = []
        group.append(i)
    out = []
    for _, n, x, y, reading in sorted(found):
        if any(taken[x:y]):
            displaced = True
        else:
            taken[x:y] = [True] * n
            out.append((at + x, at + y, reading))
    out.sort()
    if out and displaced:  # beside the ones that count there may be others
        out += [p for rest, i in _beside(out, run, at) if "�" not in rest for p in _many_parts(rest, i)]
    return sorted(out)


def _beside(found: list[tuple[int, int, str]], text: str, at: int):
    """What of a text lies outside the passages found."""
    i = 0
    for first, end, _ in found:
        yield text[i : first - at], at + i
        i = end - at
    yield text[i:], at + i


def passages(text: str) -> list[tuple[int, int, str]]:
    """(first, end, reading) of passages with a clearly better reading.  A run is read as a
    whole; in what has no better reading so, its parts are: stretches of single bytes, then
    groups of doubtful Chinese characters."""
    out = []
    for m in _RUN.finditer(text):
        run = m.group()
        if (drawn := _DRAWN.match(text, m.start())) and drawn.end() == m.end():
            continue
        found = _searched(run, m.start()) if _suspicious(run) else []
        if _HAN.search(run):
            for parts in (_single_parts, _many_parts):
                found = sorted(found + [p for rest, at in list(_beside(found, run, m.start())) if len(rest) > 1 for p in parts(rest, at)])
        out += found
    return out


_WORD = re.compile(f"[{_LATIN}Ͱ-ϿЀ-ԯ]*[^\x00-\x7e][{_LATIN}Ͱ-ϿЀ-ԯ]*")


def odd_words(text: str) -> list[tuple[int, int, str]]:
    """Words with a single letter of a wrong code page, as (first, end, reading): a
    capital after small letters or a letter of another alphabet in a Latin word."""
    out = []
    for m in _WORD.finditer(text):
        word = m.group()
        if len(word) > 2 and (_CASE.search(word) or _MIXED.search(word)) and _gains(found := best_reading(word)):
            out.append((m.start(), m.end(), found[0]))
    return out


def escaped_passages(text: str) -> list[tuple[int, int, str]]:
    """Passages that hold entities, as (first, end, reading): what they stand for is
    searched.  An entity by itself is no case; without the form of UTF-8 four characters are."""
    plain, places = text, None
    while True:  # entities of entities; each round shortens the text
        out, to, i = [], [], 0
        for m in _ENTITY.finditer(plain):
            if (c := html.unescape(m.group())) != m.group():
                places = places or [(k, k + 1) for k in range(len(plain))]
                out += [plain[i : m.start()], c]
                to += places[i : m.start()] + [(places[m.start()][0], places[m.end() - 1][1])] * len(c)
                i = m.end()
        if not i:
            break
        plain, places = "".join(out) + plain[i:], to + places[i:]
    if places is None:
        return []
    found = []
    for a, b, reading in passages(plain):
        part = plain[a:b]
        utf8 = any(raw.decode("utf-8", "replace") == reading for e in SINGLE_BYTE if (raw := _back(part, e)))
        if any(y - x > 1 for x, y in places[a:b]) and any(map(str.isalpha, part)) and (utf8 or len(part) >= 4):
            found.append((places[a][0], places[b - 1][1], reading))
    return found


def is_garbled(text: str | None) -> bool:
    """Whether a text holds a passage read in the wrong encoding.  Null and empty: no."""
    if not text:
        return False
    if not text.isascii():
        if _SURE.search(text) or passages(text) or odd_words(text):
            return True
    return bool("&" in text and escaped_passages(text)) or lost_letters(text)


def restore(text: str | None) -> str | None:
    """The text with passages restored where a clean reading loses nothing; else unchanged.
    Restored text is searched again until nothing changes, as a restored passage may join
    another one; each round shortens the text."""
    if not text or text.isascii() and "&" not in text:
        return text
    while True:
        before = len(text)
        for find in (escaped_passages, passages, odd_words):
            for first, end, reading in reversed(find(text)):
                if "�" not in reading and is_clean(reading):
                    text = text[:first] + reading + text[end:]
        if len(text) >= before:
            return text


_CANDIDATE = "[^\\x00-\\x7e]|\\?[A-Za-z?]|" + _ENTITY.pattern


def _found(batches):
    for b in batches:
        yield b.loc[[is_garbled(t) for t in b["text"]], ["doc_id"]]


def garbled_documents(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id) of documents with a passage read in the wrong encoding, restorable or
    not.  Null and empty texts and rows without id are no cases; copies are cases each; nothing is
    shuffled, texts of plain ASCII without doubtful question marks and entities stay in the JVM."""
    rows = frame.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.where(F.col("text").rlike(_CANDIDATE) & F.col("doc_id").isNotNull()).mapInPandas(_found, "doc_id bigint")


def restore_documents(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, garbled, restored): every row with its text restored where nothing was lost."""

    def run(batches):
        for b in batches:
            garbled = [is_garbled(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "garbled": garbled, "restored": [restore(t) if g else t for t, g in zip(b["text"], garbled)]})

    rows = frame.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")).where("doc_id is not null")
    return rows.mapInPandas(run, "doc_id bigint, garbled boolean, restored string")
