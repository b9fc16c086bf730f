"""Problem 5: texts read from scanned pages.

Three kinds of noise are found and repaired:

* ``drop``: lines of the page frame, by form (page numbers, also misread), by
  repetition of edge lines within the record, by likeness to its title, and by
  repetition at the edges of records of many titles of one source (:func:`edge_forms`);
* ``fix``: words with misread characters.  Words that scans have and clean texts
  don't are joined in SQL with frequent words: the difference of two anagram
  hashes (sums over characters, so order doesn't matter) must be that of one or
  two known confusions; the best attested candidate with the same reading under
  all confusions wins;
* ``join``: words broken at a line end by a sign, by the evidence of how often the
  joined and the hyphenated word occur in clean texts."""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.session import cut_lineage, if_small

# What a scan reads and what may have stood there.
CONFUSIONS = [
    ("1", "l"), ("1", "i"), ("|", "l"), ("|", "i"), ("!", "l"), ("!", "i"), ("0", "o"), ("@", "a"), ("+", "t"), ("5", "s"), ("$", "s"), ("9", "g"), ("6", "b"), ("8", "b"),
    ("c", "e"), ("e", "c"), ("cl", "d"), ("rn", "m"), ("m", "rn"), ("ii", "u"), ("vv", "w"), ("b", "h"), ("h", "b"), ("l", "i"), ("i", "l"), ("q", "g"), ("li", "h"), ("ri", "n"), ("u", "ii"), ("d", "cl"),
]
# Chinese characters of nearly the same drawing, each with the one it is read for.
HAN_CONFUSIONS = [
    tuple(p) for p in """旳的 裝装 噐器 申中 菅管 曰日 皿血 人入 入人 句包 太大 犬大 爿片 问间 亚业 可司 末未 未末 己已 已己 巳已 土士 士土 千干 干千 夭天 目日 田由 由田 甲申
    力刀 刀力 王玉 玉王 木本 闻间 兔免 晴睛 睛晴 辩辨 徽微 侯候 折拆 拆折 冶治 洒酒 亨享 祟崇 白自 自白 今令 令今 找我 我找 休体 体休 住往 往住 科料 料科 析折 拔拨 拨拔 牛午 午牛 历厉 扳板""".split()
]
_HAN_READ = "".join(sorted({a for a, _ in HAN_CONFUSIONS}))
_HAN_BOTH = "".join(sorted({c for p in HAN_CONFUSIONS for c in p}))
SIGNS = "-¬­‐‑"
EDGE = 3  # lines at either end of a record that can be its header or footer
MIN_TITLES, MIN_SHARE = 8, 0.05  # titles of a source, and their share, whose records must have a header or footer
LONGEST_HEADER = 140  # characters; a longer line is no header for a word in it
RATIO = 2  # a correction occurs in clean texts at least so many times as often as the misread word in scans


_WORD_SPAN = 1 << 64


def _signed(x: int) -> int:
    """Modulo 2 to the power 64, as a signed number; differences stay exact in it."""
    return (x + (1 << 63)) % _WORD_SPAN - (1 << 63)


def anagram_hash(word: str) -> int:
    """Sum of fourth powers of code points (each modulo a prime), the same for all orders."""
    return _signed(sum(pow(ord(c) % 9973, 4) for c in word))


_SINGLE = [(r, anagram_hash(t) - anagram_hash(r)) for r, t in CONFUSIONS + HAN_CONFUSIONS]


def reachable_hashes(word: str) -> set[int]:
    """Anagram hashes of the words that one or two confusions of ``word`` lead to."""
    own = anagram_hash(word)
    steps = [(r, d) for r, d in _SINGLE if r in word]
    out = {own + d for _, d in steps}
    for (r, d), (q, e) in combinations_with_replacement(steps, 2):
        if r != q or word.count(r) > 1:
            out.add(own + d + e)
    return {_signed(x) for x in out} - {own}


# Every character spelled out in the strokes it may be read as, so that a word and its misreadings are spelled alike.
_STROKES = str.maketrans(
    {"1": "l", "|": "l", "!": "l", "i": "l", "0": "o", "@": "a", "+": "t", "5": "s", "$": "s", "9": "g", "q": "g", "e": "c", "d": "cl", "w": "vv", "n": "rl", "m": "rrl"}
    | dict.fromkeys("bhu68", "ll") | {a: b for a, b in HAN_CONFUSIONS if (b, a) not in HAN_CONFUSIONS}
)


def reading(word: str) -> str:
    """One form of all words that a scan may confuse."""
    return word.lower().translate(_STROKES)


_NUMBER = r"[0-9lI|!OoSsBgqZz]{1,4}"
_PAGE_NUMBER = re.compile(
    rf"[-–—~·•]+\s*(?P<a>{_NUMBER})\s*[-–—~·•]+|[\[(（【]\s*(?P<b>{_NUMBER})\s*[\])）】]|(?P<c>{_NUMBER})\s*[/／|]\s*{_NUMBER}|(?P<d>{_NUMBER})"
    rf"|[Pp][Pp]?[.,]\s*(?P<e>{_NUMBER})|(?P<f>第\s*{_NUMBER}\s*[页贞頁](?:\s*[,，/]?\s*共\s*{_NUMBER}\s*[页贞頁])?)|共\s*(?P<i>{_NUMBER})\s*[页贞頁]"
    rf"|(?P<g>(?:[Pp][a@o][g9q][ec3]|PAGE|[Hh][a@][l1|I][a@]m[a@]n|[Tt]r[a@]ng|[Ss]eite)\s*{_NUMBER}(?:\s*(?:[o0][fi]|sur|daripada|dari|trên|/|von)\s*{_NUMBER})?)"
)
_IS_HAN = re.compile("[一-鿿]")
_TAIL = re.compile(rf"\s{{2,}}{_NUMBER}\s*\Z")
_END = re.compile(r"[.。!！?？,，;；:：、…][”’\"'）)]*\s*\Z")
_HEADER_WORDS = re.compile(r"(?i)\bbulletin\s+\w+\Z|\bnewsletter\b|\|\s*\S+\s+draft\Z|\bdraft\Z|\bconfidential\b|\binternal (?:use|document)\b|(?:内部资料?|产品手册?|产品目录|使用说明书?|会议资料|机密文件?|内部文件)\Z")


def is_page_number(line: str) -> bool:
    text = line.strip()
    m = _PAGE_NUMBER.fullmatch(text)
    if not m:
        return False
    if bare := m.group("d"):
        return any(c.isdigit() for c in bare) or bare in ("l", "I", "|", "O")
    if m.group("f") or m.group("g") or m.group("i") or m.group("a") or m.group("e"):
        return True
    return any(c.isdigit() for c in text) or (m.group("b") or m.group("c") or "").strip("lI|OoS!") == ""


def _skeleton(line: str) -> str:
    return re.sub(r"[\W_]+", "", reading(_TAIL.sub("", line.strip())))


def _edges(lines: list[str]) -> set[int]:
    own = [i for i, line in enumerate(lines) if line.strip()]
    return {*own[:EDGE], *own[-EDGE:]}


def edge_form(line: str) -> int | None:
    """A hash of the letters of a line that can be a header or footer, however it was
    misread and numbered; None for sentences and lines of few letters."""
    text = line.strip()
    letters = _skeleton(re.sub(r"(?<![^\W\d_])\d+(?![^\W\d_])", " ", text))
    if len(letters) < 4 or _END.search(_TAIL.sub("", text)):
        return None
    return _signed(xxhash.xxh3_64_intdigest(letters.encode("utf-8", "surrogatepass")))


def frame_of(lines: list[str], title: str, known: set[int] = frozenset()) -> set[int]:
    """Indices of the lines of the page frame; ``known`` are forms of headers and footers of the source."""
    out = {i for i, line in enumerate(lines) if line.strip() and is_page_number(line)}
    if known:
        out |= {i for i in _edges(lines) if edge_form(lines[i]) in known}
    head = _skeleton(title)
    loose: dict[int, str] = {}
    for i, line in enumerate(lines):
        text = line.strip()
        if i in out or not text:
            continue
        bare = _TAIL.sub("", text)
        skeleton = _skeleton(text)
        long = len(bare) >= (16 if _IS_HAN.search(bare) else 36)  # a title cut at the width of the page
        if len(head) >= 6 and head.startswith(skeleton) and (len(skeleton) * 20 >= len(head) * 17 or long):
            out.add(i)
        elif not _END.search(bare) and len(skeleton) >= 4:
            if len(text) <= LONGEST_HEADER and _HEADER_WORDS.search(reading_of_header(bare)):
                out.add(i)
            else:
                loose[i] = skeleton
    kinds = Counter(loose.values())
    if len(loose) > 1:
        for i, s in loose.items():
            near = kinds[s] if kinds[s] > 1 else 1 + sum(n for k, n in kinds.items() if k != s and abs(len(k) - len(s)) <= 2 and len(s) >= 8 and (k.startswith(s) or s.startswith(k)))
            if near >= 2 and sum(c.isalpha() for c in s) >= 6 and not re.search(r"\d", _TAIL.sub("", lines[i])[:1]):
                out.add(i)
    return out


def reading_of_header(text: str) -> str:
    """A header with digits and signs inside words read as letters."""
    return re.sub(r"\S*[^\W\d_]\S*", lambda m: m.group().translate(str.maketrans("10@+59|", "loatsgl")), text)


_CHUNK = re.compile(r"[^\s一-鿿\u3000-\u303f\uff00-\uffef（）“”‘’]+")
_HYPHENED = re.compile(r"[^\W_一-鿿]+(?:-[^\W_一-鿿]+)*")
_STRIP = ".,;:()[]{}\"'“”‘’«»<>…—–=*/\\?%#&"
_WORDLIKE = re.compile(r"[^\W_]")


def _scan_words(line: str) -> list[str]:
    """Words of a line in lower case, parts of hyphenated words apart, edge punctuation off."""
    out = []
    for chunk in _CHUNK.findall(line.lower()):
        for part in re.split(r"[-’'‐/]", chunk):
            part = part.strip(_STRIP)
            if len(part) > 1 and _WORDLIKE.search(part) and any(c.isalpha() for c in part):
                out.append(part)
    return out


_HAN_AT = re.compile(f"[{_HAN_READ}]")


def _han_words(text: str, at: re.Pattern) -> list[str]:
    """Characters that are easily confused, alone and with the one before and after."""
    out = []
    for m in at.finditer(text):
        i = m.start()
        out.append(text[i])
        if i and _IS_HAN.match(text[i - 1]):
            out.append(text[i - 1 : i + 1])
        if i + 1 < len(text) and _IS_HAN.match(text[i + 1]):
            out.append(text[i : i + 2])
    return out


_BROKEN = re.compile(rf"([^\s一-鿿]*[^\W\d_一-鿿])[{SIGNS}]\s*\Z")
_OPEN_END = re.compile(r"([^\s\W一-鿿][^\s一-鿿，。：；、（）“”]*)\Z")
_START = re.compile(r"\s*([^\s一-鿿，。：；、（）“”]+)")


def lay_out(text: str, title: str | None, known: set[int] = frozenset()) -> list[tuple[int, str, str, int, int]]:
    """Rows (line_no, kind, word, next_line, cut) of a scanned text: ``drop`` lines;
    ``word``s (next_line 0, or the line where the word goes on after ``cut``
    characters); ``break`` rows with both parts as "left\\tright" and the sign's code in cut."""
    lines = text.split("\n")
    dropped = frame_of(lines, title or "", known)
    rows: list[tuple[int, str, str, int, int]] = [(i + 1, "drop", "", 0, 0) for i in sorted(dropped)]
    own = [i for i, line in enumerate(lines) if i not in dropped and line.strip()]
    skip_first: set[int] = set()
    for k, i in enumerate(own):
        line = lines[i]
        start = _START.match(line) if i in skip_first else None
        rest = line[start.end() :] if start else line
        j = own[k + 1] if k + 1 < len(own) else None
        if j is not None:
            if (m := _BROKEN.search(rest)) and (n := _START.match(lines[j])) and n.group(1)[0].isalnum():
                left, right = m.group(1).lower().lstrip(_STRIP), n.group(1).lower()
                cut = len(re.split(r"[-’'‐]", left)[-1])
                first = re.split(r"[-’'‐]", right)[0].rstrip(_STRIP)
                rows.append((i + 1, "break", f"{left}\t{right.rstrip(_STRIP)}", j + 1, ord(line.rstrip()[-1])))
                if cut and first:
                    rows.append((i + 1, "word", re.split(r"[-’'‐]", left)[-1] + first, j + 1, cut))
                skip_first.add(j)
                rest = rest[: m.start(1)] + "-".join(re.split(r"-", m.group(1))[:-1])
            elif _IS_HAN.search(line) and not line[-1:].isspace() and (m := _OPEN_END.search(rest)) and _IS_HAN.search(rest + lines[j]) and (n := _START.match(lines[j])) and not lines[j][:1].isspace():
                left, right = m.group(1).lower(), n.group(1).lower().rstrip(_STRIP)
                rows.append((i + 1, "word", left + right, j + 1, len(left)))
                skip_first.add(j)
                rest = rest[: m.start(1)]
        rows += [(i + 1, "word", w, 0, 0) for w in dict.fromkeys(_scan_words(rest))]
        rows += [(i + 1, "word", w, 0, 0) for w in dict.fromkeys(_han_words(line, _HAN_AT))]
    return rows


def _laid_out(batches):
    for b in batches:
        out, recs = [], []
        for rec, title, text, known in zip(b["rec_id"], b["title"], b["text"], b["known"]):
            rows = lay_out(text, title, set() if known is None else set(known))
            out += rows
            recs += [rec] * len(rows)
        frame = pd.DataFrame(out, columns=["line_no", "kind", "word", "next_line", "cut"])
        frame.insert(0, "rec_id", np.array(recs, np.int64))
        yield frame.astype({"line_no": "int32", "next_line": "int32", "cut": "int32"})


_LAYOUT = "rec_id bigint, line_no int, kind string, word string, next_line int, cut int"


def _clean_words(batches):
    at = re.compile(f"[{_HAN_BOTH}]")
    for b in batches:
        counts: Counter = Counter()
        for text in b["text"]:
            text = text.lower()
            for token in _HYPHENED.findall(text):
                counts[token] += 1
                if "-" in token:
                    counts.update(token.split("-"))
            if _IS_HAN.search(text):
                counts.update(_han_words(text, at))
        if counts:
            yield pd.DataFrame({"word": list(counts), "n": np.fromiter(counts.values(), np.int64, len(counts))})


def clean_vocabulary(texts: DataFrame) -> DataFrame:
    """(word, n) of the column ``text``: words, hyphenated words and their parts, and
    easily confused Chinese characters with their neighbours.  Counted over all
    rows; sums are formed before the shuffle."""
    return texts.where("text <> ''").mapInPandas(_clean_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def corrections(scan_words: DataFrame, clean: DataFrame) -> DataFrame:
    """(word, correction): misread words of scans with the best attested word that
    differs by known confusions.  ``scan_words`` (word, n) are counts in scans."""

    def spread(batches):
        for b in batches:
            rows = [(w, n, h) for w, n in zip(b["word"], b["n"]) for h in reachable_hashes(w)]
            yield pd.DataFrame(rows, columns=["word", "n", "hash"]).astype({"n": "int64", "hash": "int64"})

    def hashed(batches):
        for b in batches:
            yield b.assign(hash=[anagram_hash(w) for w in b["word"]])

    schema = "word string, n bigint, hash bigint"
    known = clean.select("word", F.col("n").alias("clean_n"))
    rare = scan_words.join(known, "word", "left").where(F.coalesce("clean_n", F.lit(0)) * 5 <= F.col("n")).select("word", "n")
    frequent = clean.where("n >= 3 and word not like '%-%'").select("word", "n").mapInPandas(hashed, schema)
    reached = rare.mapInPandas(spread, schema)
    pairs = reached.join(frequent.select(F.col("word").alias("correction"), F.col("n").alias("clean_n"), "hash"), "hash")
    pairs = pairs.where(F.col("clean_n") >= F.col("n") * RATIO).select("word", "correction", "clean_n").distinct()

    def verified(batches):
        for b in batches:
            yield b[[w != c and reading(w) == reading(c) for w, c in zip(b["word"], b["correction"])]]

    pairs = pairs.mapInPandas(verified, "word string, correction string, clean_n bigint")
    return pairs.groupBy("word").agg(F.max_by("correction", F.struct("clean_n", "correction")).alias("correction"))


def _break_decisions(breaks: DataFrame, clean: DataFrame, fixes: DataFrame) -> DataFrame:
    """(rec_id, line_no, joined) of line ends with a broken word, by the evidence of clean texts."""
    parts = breaks.select("rec_id", "line_no", "cut", F.split("word", "\t").alias("p"))
    parts = parts.select("rec_id", "line_no", "cut", F.col("p")[0].alias("left"), F.col("p")[1].alias("right"))
    last, first = F.element_at(F.split("left", "-"), -1), F.split("right", "-")[0]
    forms = F.array(
        F.struct(F.lit("joined").alias("form"), F.concat("left", "right").alias("word")),
        F.struct(F.lit("hyphened").alias("form"), F.concat_ws("-", "left", "right").alias("word")),
        F.struct(F.lit("joined_part").alias("form"), F.concat(last, first).alias("word")),
        F.struct(F.lit("hyphened_part").alias("form"), F.concat_ws("-", last, first).alias("word")),
        F.struct(F.lit("last").alias("form"), last.alias("word")),
        F.struct(F.lit("first").alias("form"), first.alias("word")),
    )
    forms = parts.select("rec_id", "line_no", "cut", F.explode(forms).alias("f")).select("rec_id", "line_no", "cut", "f.form", "f.word")
    forms = forms.join(fixes, "word", "left").withColumn("word", F.when(F.col("form").like("joined%"), F.coalesce("correction", "word")).otherwise(F.col("word")))
    counted = forms.drop("correction").join(clean, "word", "left")
    n = lambda form: F.coalesce(F.max(F.when(F.col("form") == form, F.col("n"))), F.lit(0)).alias(form)
    by = counted.groupBy("rec_id", "line_no", "cut").agg(*(n(f) for f in ("joined", "hyphened", "joined_part", "hyphened_part", "last", "first")))
    both_words = F.least("last", "first") >= 3
    joined = (
        F.when(F.col("cut").isin([ord("¬"), 0xAD]), True)
        .when(F.col("joined") != F.col("hyphened"), F.col("joined") > F.col("hyphened"))
        .when(F.col("joined_part") != F.col("hyphened_part"), F.col("joined_part") > F.col("hyphened_part"))
        .otherwise(~both_words)
    )
    return by.select("rec_id", "line_no", joined.alias("joined"))


def _edge_rows(batches):
    for b in batches:
        rows = []
        for source, title, text in zip(b["source"], b["title"], b["text"]):
            lines = text.split("\n")
            own = _signed(xxhash.xxh3_64_intdigest((title or "").encode("utf-8", "surrogatepass")))
            rows += [(source, own, form) for form in {edge_form(lines[i]) for i in _edges(lines)} if form is not None]
        if rows:
            yield pd.DataFrame(rows, columns=["source", "title", "form"])


def edge_forms(scans: DataFrame) -> DataFrame:
    """(source, known): forms of lines at the edges of records (source, title, text) that
    records of MIN_TITLES different titles of a source have, and MIN_SHARE of its titles.
    A record has 2 * EDGE such lines, so a source has at most 2 * EDGE / MIN_SHARE forms."""
    rows = cut_lineage(scans.where("source is not null").mapInPandas(_edge_rows, "source string, title bigint, form bigint"))
    titles = rows.select("source", "title").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("titles"))
    often = rows.groupBy("source", "form").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_TITLES).select("source", "form")
    exact = rows.join(if_small(cut_lineage(often), 32), ["source", "form"]).distinct().groupBy("source", "form").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_TITLES)
    return exact.join(titles, "source").where(F.col("n") >= F.col("titles") * MIN_SHARE).groupBy("source").agg(F.collect_list("form").alias("known"))


def _analysed(frame: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    source = F.col("source_name").cast("string") if "source_name" in frame.columns else F.lit(None).cast("string")
    scans = frame.where("image_ocr_text <> '' and rec_id is not null").select(F.col("rec_id").cast("bigint").alias("rec_id"), source.alias("source"), "title", F.col("image_ocr_text").alias("text"))
    known = cut_lineage(edge_forms(scans))
    laid = scans.join(if_small(known, 16 + int(2 * EDGE / MIN_SHARE) * 8), "source", "left").select("rec_id", "title", "text", "known")
    layout = cut_lineage(laid.mapInPandas(_laid_out, _LAYOUT))
    texts = frame.select(F.concat_ws("\n", "title", "main_text").alias("text"))
    clean = cut_lineage(clean_vocabulary(texts))
    counts = layout.where("kind = 'word'").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return layout, clean, cut_lineage(corrections(counts, clean))


def _fix_lines(words: DataFrame, fixes: DataFrame) -> DataFrame:
    """(rec_id, line_no) of lines with a misread character; of a broken word, the lines that hold the differing characters."""
    hit = words.join(fixes, "word")
    at = F.length(F.regexp_extract(F.concat_ws("\n", "word", "correction"), r"^(.*).*\n\1", 1))  # common beginning
    back = F.length(F.regexp_extract(F.concat_ws("\n", F.reverse("word"), F.reverse("correction")), r"^(.*).*\n\1", 1))
    hit = hit.select("rec_id", "line_no", "next_line", "cut", at.alias("at"), (F.length("word") - back).alias("end"))
    own = hit.where("next_line = 0 or at < cut").select("rec_id", "line_no")
    after = hit.where("next_line > 0 and end > cut").select("rec_id", F.col("next_line").alias("line_no"))
    return own.unionByName(after).distinct()


def scan_noise(frame: DataFrame) -> DataFrame:
    """(rec_id, line_no, kind) of noisy lines of image_ocr_text: drop, join, fix.

    Needs rec_id, title, main_text and image_ocr_text, and source_name if headers and
    footers of a source are to count; clean words are counted over
    title and main_text of all rows.  Null and empty texts have no cases; a line
    of kind drop has no other kind.  Rows without rec_id are left out; repeated rows
    give their cases once."""
    layout, clean, fixes = _analysed(frame)
    drop = layout.where("kind = 'drop'").select("rec_id", "line_no", F.lit("drop").alias("kind"))
    fix = _fix_lines(layout.where("kind = 'word'"), fixes).withColumn("kind", F.lit("fix"))
    join = _break_decisions(layout.where("kind = 'break'"), clean, fixes).where("joined").select("rec_id", "line_no", F.lit("join").alias("kind"))
    return drop.unionByName(fix).unionByName(join).distinct()


def _same_case(model: str, word: str) -> str:
    return word.upper() if model.isupper() and len(model) > 1 else word[:1].upper() + word[1:] if model[:1].isupper() else word


def repaired(text: str | None, drop: set[int], join: set[int], fixes: dict[str, str]) -> str | None:
    """A scanned text as paragraphs: frame lines dropped, broken words joined, misread
    words replaced in their case.  A blank line ends a paragraph if a sentence ends
    before it; line breaks become blanks, on pages in Chinese only where one stood."""
    if not text:
        return text
    tight = 4 * len(_IS_HAN.findall(text)) > len(text)  # Chinese pages break lines anywhere and keep blanks at the end
    paragraphs, current, closed, glue, space = [], "", False, False, False
    for n, line in enumerate(text.split("\n"), 1):
        piece = line.strip()
        if n in drop:
            continue
        if not piece:
            closed = closed or bool(_END.search(current))
            continue
        if current and closed:
            paragraphs.append(current)
            current, glue = "", False
        space = space or line[0].isspace() if tight else not _BROKEN.search(current)  # a compound keeps its hyphen
        current += piece if glue or not space or not current else " " + piece
        closed, glue, space = False, n in join, line[-1].isspace()
        if glue:
            current = re.sub(rf"[{SIGNS}]\s*\Z", "", current)
    if current:
        paragraphs.append(current)
    out = "\n\n".join(paragraphs)
    for word in sorted(fixes, key=len, reverse=True):
        edge = "" if _IS_HAN.search(word) else r"[^\W_]"
        bounds = (f"(?<!{edge})", f"(?!{edge})") if edge else ("", "")
        out = re.sub(bounds[0] + re.escape(word) + bounds[1], lambda m, w=word: _same_case(m.group(), fixes[w]), out, flags=re.I)
    return out


def repair_scans(frame: DataFrame) -> DataFrame:
    """(rec_id, repaired): image_ocr_text of every row as continuous paragraphs.

    Null and empty texts stay; rows without rec_id are left out; of rows with one
    rec_id each gets the repairs of all of them."""
    layout, clean, fixes = _analysed(frame)
    words = layout.where("kind = 'word'").join(fixes, "word").groupBy("rec_id").agg(F.collect_set(F.struct("word", "correction")).alias("fixes"))
    drop = layout.where("kind = 'drop'").groupBy("rec_id").agg(F.collect_set("line_no").alias("drop_lines"))
    join = _break_decisions(layout.where("kind = 'break'"), clean, fixes).where("joined").groupBy("rec_id").agg(F.collect_set("line_no").alias("join_lines"))
    rows = frame.where("rec_id is not null").select(F.col("rec_id").cast("bigint").alias("rec_id"), F.col("image_ocr_text").alias("text"))
    rows = rows.join(words, "rec_id", "left").join(drop, "rec_id", "left").join(join, "rec_id", "left")

    def run(batches):
        some = lambda v: [] if v is None else v
        for b in batches:
            out = [
                repaired(t, {*some(d)}, {*some(j)}, {f["word"]: f["correction"] for f in some(x)})
                for t, d, j, x in zip(b["text"], b["drop_lines"], b["join_lines"], b["fixes"])
            ]
            yield pd.DataFrame({"rec_id": b["rec_id"], "repaired": out})

    return rows.mapInPandas(run, "rec_id bigint, repaired string")
