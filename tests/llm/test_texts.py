import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslake.llm.encoding import VOCABULARY, ByteBpe, encode_corpus, token_counts
from presslake.llm.one_form import changed_records, mapping, suspect_pattern, to_one_form, unify_texts
from presslake.llm.wrong_encoding import cost, garbled_documents, is_garbled, restore, restore_documents


@pytest.mark.parametrize(
    "text, want",
    [
        ("ＭＧ-２４０ ｓｔｅｎｔ", "MG-240 stent"), ("ﬁlm cuﬀ", "film cuff"), ("a b c", "a b c"), ("étui", "étui"), ("Вrеrino Мedical", "Brerino Medical"),
        ("val­i​date", "validate"), ("Кeluvra", "Keluvra"), ("Τasnexa™‍", "Tasnexa™"), ("trư̛ớc".replace("ư̛", "ư"), "trước"),
    ],
)
def test_one_form(text, want):
    assert to_one_form(text) == want


@pytest.mark.parametrize("text", ["👩‍⚕️ ❤️", "Новости: ВПЕРЁД", "Ω-type β-phase at 5 μm", "（25 m²）№ 7 ½ ①，“x”——", "x̄ = 3", "SÃO é naïve", "中文　空格", "", None, "plain"])
def test_kept_as_it_is(text):
    assert to_one_form(text) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_one_form_is_stable(text):
    once = to_one_form(text)
    assert to_one_form(once) == once


def test_mapping_and_filter_agree():
    assert suspect_pattern() and all(unicodedata.normalize("NFC", v) == v for v in mapping().values())


def test_one_form_operator(spark):
    rows = spark.createDataFrame([(1, "ａ", "x"), (2, "a", "x"), (3, None, None), (4, "", ""), (None, "ａ", "x"), (1, "ａ", "x"), (5, "ａ" * 300_000, "")], "rec_id bigint, title string, text string")
    assert sorted(x.rec_id for x in changed_records({"scripts": (rows, "title")}).collect()) == [1, 1, 5]
    got = {x.rec_id: x.one_form for x in unify_texts(rows, "title").collect()}
    assert got[1] == "a" and got[3] is None and got[4] == "" and len(got[5]) == 300_000
    assert changed_records({"scripts": (rows.limit(0), "title")}).count() == 0


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    from presslake.llm.encoding import PATTERN

    bpe = ByteBpe(open(VOCABULARY, "rb").read())
    return bpe, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=5))
def test_encoding_against_another_library(reference, texts):
    bpe, other = reference
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert bpe.encode_batch(texts) == [other.encode_ordinary(t) if t else [] for t in texts]


def test_encoding_of_hard_words(reference):
    bpe, other = reference
    for t in ("a" * 30_000, "锟斤拷" * 3000, "<|endoftext|>", "x" + " " * 5000, "ab" * 70 + "é" * 90, "don't we'll I'M"):
        assert bpe.encode_batch([t]) == [other.encode_ordinary(t)]


def test_encoding_operator(spark):
    rows = spark.createDataFrame([(1, "hello world", 1), (2, None, 1), (3, "", 1), (None, "x", 1), (1, "hello world", 1)], "doc_id bigint, text string, ids int")
    got = sorted((x.doc_id, list(x.ids)) for x in encode_corpus(rows).collect())
    assert got[0] == got[1] and len(got[0][1]) == 2 and got[2:] == [(2, []), (3, [])]
    assert sorted(x.tokens for x in token_counts(rows).collect()) == [0, 0, 2, 2]
    assert encode_corpus(rows.limit(0)).count() == 0


def misread(text, written, read):
    raw = text.encode(written)
    return "".join(bytes((b,)).decode(read, "ignore") or chr(b) for b in raw) if read.startswith("cp125") or read == "latin-1" else raw.decode(read)


GOOD = "The São Lúmen site — “tested” — at 5 °C, naïve café."


@pytest.mark.parametrize("read", ["cp1252", "latin-1", "cp437", "mac_roman"])
def test_restores_what_was_not_lost(read):
    bad = misread(GOOD, "utf-8", read)
    assert is_garbled(bad) and restore(bad) == GOOD
    assert is_garbled(misread(bad, "utf-8", "cp1252"))


def test_chinese_misread():
    text = "据监管机构介绍，儿科镜片的审计增长百分之五，为缩短等待时间。"
    assert restore(text.encode("gb18030").decode("latin-1")) == text and restore(misread(text, "utf-8", "cp1252")) == text
    assert is_garbled(text.encode("utf-8").decode("gb18030", "replace")) and is_garbled("caf�") and is_garbled("Trong ??t th? nghi?m, c?c thi?t b?")
    assert cost(text) < 0.2 * cost(text.encode("gb18030").decode("latin-1"))


def test_long_passages():
    text = "据监管机构介绍，儿科镜片的审计增长百分之五，为缩短等待时间。" * 400
    for bad in (text.encode("gb18030").decode("latin-1"), misread(text, "utf-8", "cp1252")):
        assert restore(bad) == text
    assert not is_garbled(text) and not is_garbled("正體中文" * 5000)


CLEAN_LINE = "省级医院认为口腔注射器的许可试验期间仍需召回，涉及二十家单位。"
LINE = "据监管机构介绍，儿科镜片的审计增长百分之五，为缩短等待时间。"


@pytest.mark.parametrize("bad", [misread(LINE, "utf-8", "cp1252"), LINE.encode("utf-8").decode("latin-1"), LINE.encode("utf-8").decode("mac_roman"), LINE.encode("gb18030").decode("latin-1"), "采购合作伙伴".encode("utf-8").decode("gb18030")])
@pytest.mark.parametrize("before, after", [(CLEAN_LINE + "\n", "\n" + CLEAN_LINE), (CLEAN_LINE, CLEAN_LINE), (CLEAN_LINE * 40, CLEAN_LINE * 40), ("他说：“", "”，" + CLEAN_LINE)])
def test_passage_beside_clean_chinese(bad, before, after):
    text = before + bad + after
    good = "采购合作伙伴" if "閲" in bad else LINE
    assert is_garbled(text) and restore(text) == before + good + after


@pytest.mark.parametrize("text, want", [("caf&Atilde;&copy; bar", "café bar"), ("caf&amp;Atilde;&amp;copy;", "café"), ("caf&#195;&#xA9; R&amp;D", "café R&amp;D"), ("涉及" + "".join(f"&#{ord(c)};" for c in misread(LINE, "utf-8", "cp1252")), "涉及" + LINE), ("Ã&copy;t&Atilde;©", "été")])
def test_escaped_passages(spark, text, want):
    assert is_garbled(text) and restore(text) == want
    assert garbled_documents(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).count() == 1


@pytest.mark.parametrize("text", ["R&amp;D; AT&T", "caf&eacute;", "x&nbsp;&nbsp;y", "&laquo;&nbsp;CAF&Eacute;&nbsp;&raquo;", "&copy;&reg; 5&nbsp;&deg;C", "&lt;b&gt; &unknown; &#65;"])
def test_entities_are_no_cases(text):
    assert not is_garbled(text) and restore(text) == text


def test_lost_bytes_and_drawn_lines_stay():
    lost = "涉及" + "瀹跺崟浣嶃�傛嵁鑽�浼佷粙缁嶏紝"
    assert is_garbled(lost) and restore(lost) == lost
    assert not is_garbled(CLEAN_LINE + "\n├─ annex ─┤\n│ └── x") and restore("├─ annex ─┤") == "├─ annex ─┤" and restore("h├┤tel") == "hôtel"


@pytest.mark.parametrize("text", [None, "", "plain?", GOOD, "l’étui d’évaluation", "AVALIAÇÃO FINAL: NÃO", "ÂGE · SÃO · ÑANDÚ", "½ ¼ ¾ °C ± μ", "Новости: ВПЕРЁД, Ђорђе", "正體中文與日本語カタカナ", "한국 의료기기 제조사가 새로운 제품을 발표했다", "日本の医療機器メーカーは新しい製品を発表した。", "https://x.example/a?b=c&d=%20", "Đầu tháng, nhà máy phê duyệt", "👩‍⚕️🧪", "R&D; AT&T"])
def test_good_texts_are_no_cases(text):
    assert not is_garbled(text) and restore(text) == text


def test_encoding_repair_operator(spark):
    bad = misread(GOOD, "utf-8", "cp1252")
    rows = spark.createDataFrame([(1, bad, 0), (2, GOOD, 0), (3, None, 0), (4, "", 0), (1, bad, 0), (None, bad, 0), (5, bad * 2000, 0)], "doc_id bigint, text string, garbled int")
    assert sorted(x.doc_id for x in garbled_documents(rows).collect()) == [1, 1, 5]
    assert {x.doc_id: x.restored for x in restore_documents(rows).collect()}[1] == GOOD
    assert garbled_documents(rows.limit(0)).count() == 0


def _misread(text, encoding, rounds):
    from presslake.llm import wrong_encoding as w

    for _ in range(rounds):
        text = "".join(w._CHARS[encoding].get(b, chr(b)) for b in text.encode("utf-8"))
    return text


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "mac_roman", "cp437"])
@pytest.mark.parametrize("text", ["équipé à Zürich", "质控小组认为植入式注册资料", "“Größe” – naïve", "Doanh nghiệp mới và", "дом «Ёлка»"])
def test_restores_one_to_five_misreadings(text, encoding):
    from presslake.llm import wrong_encoding as w

    for rounds in range(1, 6):
        garbled = _misread(text, encoding, rounds)
        assert w.is_garbled(garbled) and w.restore(garbled) == text


def test_correct_texts_are_no_cases_and_stay():
    from presslake.llm import wrong_encoding as w

    for text in ["«École» d’Été", "foo?bar", "What?Where?", "¿Qué?Sí", "naïve café – “quoted” … été", "«Où ?» «Là»", "ÉCOLE “À” — «É»", "繁體說明書：僅供參考", "у дома «а»", "½ ¼ ¾ °C ± μ"]:
        assert not w.is_garbled(text) and w.restore(text) == text, text
    assert w.is_garbled("a caf?-style r?sum?s") and w.restore("a caf?-style r?sum?s") == "a caf?-style r?sum?s"


def test_long_passage_is_read_as_a_whole():
    from presslake.llm import wrong_encoding as w

    text = "质控小组认为植入式注册资料，" * 300
    assert w.restore(_misread(text, "cp1252", 2)) == text


def test_lookalikes_of_many_scripts(spark):
    from presslake.llm.one_form import lookalikes

    looks = lookalikes(spark)
    assert len(looks) > 150 and all(len(x) == 1 and x.isascii() for x in looks.values())
    for text, want in [("bаnк", "bank"), ("αlpha", "alpha"), ("ρatient", "patient"), ("tuЬe", "tube"), ("кit", "kit"), ("aпd", "and"), ("cɑre", "care"), ("ѵalve", "valve"), ("ՍNIT", "UNIT"), ("ᏴASE", "GASE"), ("cathetеrж", "catheterж")]:
        got = to_one_form(text, looks)
        assert got == to_one_form(got, looks) and (got == want or text == "ᏴASE" and got != text and got.isascii()), (text, got)
    for text in ["TNFα", "NFκB", "αB", "μg", "σmax", "ΔHmax", "β-blocker α-helix", "Москва", "новости", "Ελλάδα", "kəˈθiːtə", "5 kΩ", "ᏣᎳᎩ", "Հայաստան", "", None]:
        assert to_one_form(text, looks) == text, text


TRADITIONAL = "醫療器械監督機構與國際標準實驗證據評價應當記錄關於廠商產品資訊發佈"


@pytest.mark.parametrize("good, written, read", [("采购合作伙伴认为审计增长", "utf-8", "gb18030"), ("质控小组认为植入式注册资", "gb18030", "big5hkscs"), ("采购合作伙伴认为审计增长" * 60, "utf-8", "gb18030")])
def test_passage_wherever_it_begins(good, written, read):
    before = CLEAN_LINE + TRADITIONAL  # doubtful characters in front, more than any search may skip
    text = before + good.encode(written).decode(read) + CLEAN_LINE * 200
    assert is_garbled(text) and restore(text) == before + good + CLEAN_LINE * 200
    assert not is_garbled(before + CLEAN_LINE) and restore(before) == before


def test_cut_is_the_cheapest_of_all():
    import random
    from itertools import combinations

    from presslake.llm import wrong_encoding as w

    r, signs = random.Random(4), "采购合作伙伴".encode().decode("gb18030") + "省级訓監奴努"
    for e, d in [("gb18030", "utf-8"), ("gb18030", "big5hkscs"), ("gb18030", "shift_jis")]:
        for _ in range(60):
            text = "采购合作".encode().decode("gb18030")[: r.randrange(6)] + "".join(r.choice(signs) for _ in range(r.randrange(1, 7)))

            def price(spans):
                total = sum(map(w._one_cost, text))
                for x, y in spans:
                    raw, o = "".join(text[x:y]).encode(e), 0
                    total += w.GAIN - sum(map(w._one_cost, text[x:y]))
                    while o < len(raw):
                        n = next((n for n in range(1, 5) if w._read_cost(raw[o : o + n], d) is not None), 0)
                        if not n:
                            return 10**9
                        total += w._read_cost(raw[o : o + n], d)
                        o += n
                return total

            spans = list(combinations(range(len(text) + 1), 2))
            every = [[], *([s] for s in spans), *([a, b] for a, b in combinations(spans, 2) if a[1] <= b[0])]
            assert price(w._cheapest_cut(text, e, d, 1)) <= min(map(price, every))


def test_without_the_table_of_confusable_characters_the_queries_fail(spark):
    from types import SimpleNamespace

    from py4j.protocol import Py4JError

    from presslake.llm.one_form import lookalikes

    def broken():
        raise Py4JError("lost")

    def checker(forms):
        return lambda: SimpleNamespace(build=lambda: SimpleNamespace(getSkeleton=lambda text: forms))

    for session in (SimpleNamespace(), *(SimpleNamespace(_jvm=SimpleNamespace(**{"com.ibm.icu.text.SpoofChecker$Builder": x})) for x in ("no class", broken, checker("a\nb")))):
        with pytest.raises(RuntimeError, match="table of confusable characters"):
            lookalikes(session)
    rows = spark.createDataFrame([(1, "ѵalve")], "rec_id bigint, title string")
    assert changed_records({"scripts": (rows, "title")}).count() == 1
