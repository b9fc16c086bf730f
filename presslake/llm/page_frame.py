"""Problem 7: lines of the page around an article.

Two passes over the lines (blocks) of a page.  The first classifies a line by
length, stop-word density and link density, that is how much of it consists of
short items between separators or of menu words; requests to the reader and
notices of the site count as links.  The second gives ambiguous short lines the
label of the nearest decided neighbours: title-like lines after the heading of a
list of other articles belong to that list, a short line between two lines of the
frame is of the frame, other short lines are subheadings.

Words and forms are known for some languages only.  For all others the corpus itself
decides: a line that pages of many titles of one source have, word for word, in the
block at their top or bottom, counts as link text there (:func:`recurring`).  Counts are over
all pages; only hashes of lines are shuffled, never texts."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.session import cut_lineage, if_small

# Stop words of the languages, for density in running text.
STOP_WORDS = set(
    """the of a an and in for to by at from with that was were is are has had as on once so no after since under their its
    le la les de des du un une et en à pour par sur dans est a ont été que qui au aux avec après
    dan di ke untuk daripada oleh pada yang dengan adalah telah akan itu ini dalam selepas kerana
    và của cho các những tại do là đã được với trong sau khi theo bằng để từ một vì nhằm
    der die das und den dem des ein eine einer im mit von für auf ist sind wird wurde nicht auch nach bei zum zur
    el los las del y que en con por para una se su es fue son como más al o sobre desde""".split()
)
# Words and phrases of menus; a line of nothing else is a menu.
MENU = set(
    """home | about us | about | products | product centre | services | solutions | support | contact | contact us | careers | jobs | tenders | newsroom
    | news | events | downloads | download | search | site map | sitemap | log in | login | sign in | register | sign up | my account | investors
    | investor relations | regulations | press | media | faq | help | privacy | privacy policy | privacy statement | terms | terms of use | accessibility
    | cookies | imprint | legal | settings | notices | email | print | copy link | archive | blog | rss | menu | language | english
    | accueil | actualités | agenda | carrières | connexion | à propos | plan du site | produits | réglementation | téléchargements | appels d’offres
    | appels d'offres | avis | recherche | mentions légales | confidentialité | accessibilité | investisseurs | mon compte | inscription | assistance
    | utama | berita | acara | kerjaya | hubungi | hubungi kami | log masuk | muat turun | peraturan | peta laman | produk | tender | tentang kami | notis
    | terma | privasi | kebolehcapaian | carian | pelabur | sokongan | daftar
    | trang chủ | tin tức | sự kiện | tuyển dụng | đấu thầu | sơ đồ trang | tải về | quy định | liên hệ | giới thiệu | đăng nhập | sản phẩm
    | thông báo | điều khoản | bảo mật | trợ năng | tìm kiếm | hỗ trợ | đăng ký | nhà đầu tư
    | 首页 | 关于我们 | 联系我们 | 产品中心 | 新闻资讯 | 招标采购 | 会展活动 | 资料下载 | 客户服务 | 投资者关系 | 政策法规 | 站内搜索 | 网站地图
    | 人才招聘 | 登录 | 注册 | 公告 | 正文 | 使用条款 | 隐私声明 | 无障碍浏览 | 新闻中心 | 解决方案 | 服务支持 | 下载中心 | 加入我们 | 我的账户
    | 帮助中心 | 友情链接 | 法律声明 | 版权声明 | 网站声明 | 朋友圈 | 好友 | 复制链接""".replace("\n", " ").split(" | ")
)
MENU = {" ".join(m.split()) for m in MENU}
_MENU_STARTS = {m.split()[0] for m in MENU}
# Headings of lists of other articles.
OTHER_ARTICLES = re.compile(
    r"(?i)(?:related (?:articles|stories|posts|news|links|reading)|you (?:may|might) also (?:like|be interested in)|most (?:read|popular|viewed)(?: (?:this|of the) (?:week|month|day)| today)?"
    r"|latest (?:tenders|news|articles|notices|posts|stories)|recommended(?: for you)?|more (?:from|in|on) .{1,60}|popular (?:articles|posts|stories|now)|read next|see also|trending(?: now)?|editor[’']?s picks"
    r"|articles? liés?|à lire aussi|les plus (?:lus|consultés|populaires)|(?:derniers|nouveaux) (?:avis|articles|appels d[’']offres)|sur le même sujet|vous aimerez aussi|derniers appels d[’']offres|dernières actualités"
    r"|artikel (?:berkaitan|lain|terkini|popular)|paling (?:banyak dibaca|popular)|(?:berita|tender|notis) terkini|anda mungkin (?:suka|berminat)|baca juga"
    r"|bài (?:liên quan|viết liên quan|mới)|(?:đọc|xem) nhiều(?: (?:trong|nhất) .{1,15})?|tin (?:liên quan|mới(?: nhất)?|khác)|có thể bạn quan tâm|(?:gói thầu|thông báo) mới(?: nhất)?|đấu thầu mới(?: nhất)?"
    r"|相关(?:阅读|文章|新闻|推荐|链接|资讯)|猜你喜欢|(?:本周|本月|今日|近期)?(?:热门|热点|热文|排行)(?:文章|推荐|资讯|新闻|排行)?|最新(?:公告|招标|文章|资讯|新闻|发布)|推荐阅读|延伸阅读|更多(?:文章|资讯|新闻|公告)|大家都在看|阅读排行|上一篇|下一篇)\s*[:：]?"
)
# Requests to the reader, notices of the site, paging, footers: whole lines.
_FRAME = [
    re.compile(p, re.I)
    for p in (
        # copyright, operator, registration, counters
        r"(?:©|\(c\)|copyright\b|版权所有|hak cipta|bản quyền|tous droits).{0,100}", r".{0,60}(?:all rights reserved|tous droits réservés|hak cipta terpelihara|giữ mọi bản quyền|版权所有|保留所有权利)[.。]?",
        r"(?:powered by|hosted by|site by|designed by|dikuasakan oleh|dibangunkan oleh|propulsé par|réalisé par|vận hành bởi|phát triển bởi|技术支持|主办单位|承办单位|运营单位|网站标识码).{0,90}",
        r".{0,60}, (?:registered office|siège social|pejabat berdaftar|trụ sở).{0,40}", r"(?:licence|license|lesen|giấy phép)\s*(?:n[°o]|no|number|số)?\.?\s*[\d\-]+", r"no\.? (?:lesen|licence|license)\s*\d+", r"licen[cs]e n° ?\d+",
        r"(?:.{0,6}(?:icp|公网安)|备案(?:编号|号)|许可证(?:编号|号)|访问量|浏览量|浏览次数|阅读量|阅读次数|点击量|点击数|点击次数|今日访问)\D{0,4}\d[\d,万\-]*次?号?",
        r"(?:last (?:reviewed|updated|modified) (?:by|on)|dikemas kini oleh|page mise à jour|cập nhật lần cuối|disemak kali terakhir|dernière mise à jour|révisé en dernier).{0,60}", r"(?:visits?|views|hits|visitors?|visites?|lawatan|lượt xem)\s*[:：]?\s*[\d,. ]+",
        # to the top, print, save, more, details, downloads
        r"(?:back|return|go) to (?:the )?(?:top|list|home(?:page)?)|haut de page|retour (?:en haut|à la liste|à l[’']accueil)|kembali ke (?:atas|senarai)|về đầu trang|返回(?:顶部|首页|列表|上页)|回到顶部",
        r"(?:print|email|e-mail|save|share|bookmark)(?: (?:this|the))? (?:page|article|story|notice)|imprimer (?:cette|la) page|cetak halaman(?: ini)?|in trang(?: này)?|打印(?:本页|此页|文章)?(?:\s*关闭窗口)?|关闭窗口",
        r"(?:save|add) to (?:reading list|favou?rites|bookmarks|my list)\s*(?:[(（]\d+[)）])?|(?:ajouter aux|enregistrer dans les) favoris.{0,12}|(?:simpan|tambah) (?:ke|dalam) (?:senarai|kegemaran).{0,20}|lưu (?:bài|vào danh sách).{0,20}|收藏(?:本文|本页)?\s*(?:[(（]\d+[)）])?|点赞.{0,6}|在看.{0,6}",
        r"字号\s*[:：]?\s*[大中小\s]+|font size.{0,20}|text size.{0,20}|a[- ]a[+ ]?a?\+?",
        r"(?:load|show|view|see) (?:more|all)(?: (?:results|articles|news|entries|notices|items))?|加载更多|查看更多|更多\s*[>»]*|显示更多|muat lagi|lihat lagi|papar lagi|afficher plus|charger plus(?: de résultats)?|voir plus|xem thêm|tải thêm(?: kết quả)?",
        r"(?:read|learn|find out) more|(?:continue|keep) reading|(?:view|see|more) details?|full (?:text|article|story)|read (?:the )?full (?:text|article|story)|baca (?:lagi|seterusnya|selanjutnya)|(?:lihat|papar) butiran|lire (?:la suite|plus|l[’']article(?: complet)?)|voir le détail|en savoir plus|xem chi tiết|đọc tiếp|查看(?:详情|全文|原文)|阅读(?:全文|原文|更多)|详情|点击(?:查看|阅读).{0,10}",
        r"(?:download|muat turun|télécharger|tải (?:về|xuống)|附件下载|下载附件|附件|attachment|lampiran)\s*[:：]?\s*[(（].{0,30}[)）]",
        # paging and positions
        r"[«‹<]*\s*(?:previous|prev|précédent|sebelum(?:nya)?|trước|上一页|首页).{0,40}(?:next|suivant|seterusnya|sau|下一页|末页|尾页)\s*[»›>]*", r"(?:page|halaman|trang|muka surat)\s*\d+\s*(?:of|sur|daripada|trên|dari|/)\s*\d+", r"第\s*\d+\s*[页/].{0,20}|共\s*\d+\s*[条页篇].{0,20}",
        r"(?:showing|displaying|results|memaparkan|menunjukkan|affichage(?: de)?|résultats|hiển thị)\s*\d+\s*[-–—]\s*\d+\D{1,15}\d+.{0,15}|(?:showing|results) \d+ (?:to|of) \d+.{0,20}",
        r"(?:you are here|your location|vous êtes ici|anda di sini|bạn đang ở|当前位置|您(?:的|所在的?)位置|您现在的位置|所在位置)\s*[:：].{0,80}",
        # sharing, subscriptions, apps
        r"(?:share|follow us|partager|suivez-nous|kongsi|ikuti kami|chia sẻ|theo dõi|分享(?:到|至)?|转发)\s*(?:[:：].{0,60}|(?:this|on|sur|di|lên|via|with) .{0,40})|kongsi di media sosial|partager sur les réseaux(?: sociaux)?|chia sẻ (?:lên|trên) mạng xã hội|share",
        r"(?:subscribe|sign up|register) (?:to|for|now).{0,90}|join (?:our|the) .{0,40}(?:newsletter|list|community|channel).{0,20}|get (?:the|our) (?:app|newsletter|alerts|latest).{0,60}|download (?:the|our) app.{0,40}|(?:enter|type) your e-?mail.{0,90}|never miss .{0,60}",
        r"(?:langgan|dapatkan) (?:surat berita|aplikasi|buletin|makluman).{0,60}|masukkan e-?mel.{0,80}|muat turun aplikasi.{0,40}|(?:inscrivez|abonnez)-vous.{0,80}|votre (?:adresse|e-?mail|courriel).{0,80}|(?:recevez|téléchargez) (?:notre|l[’']appli).{0,60}|đăng ký (?:nhận|bản tin|theo dõi).{0,60}|nhập e-?mail.{0,80}|tải ứng dụng.{0,60}",
        r"订阅(?!该|这|上述).{0,24}(?:简报|周刊|日报|通讯|推送|邮件|公众号|服务号|资讯|提醒)|输入邮箱.{0,24}|(?:扫码|扫描二维码|长按|扫一扫|微信扫).{0,30}|关注(?:我们|公众号|本站).{0,20}|下载(?:客户端|app|手机版).{0,20}",
        # consent
        r"(?:manage|customi[sz]e|gérer|urus|quản lý|设置|管理).{0,10}(?:consent|cookies?|consentement|kuki|persetujuan|隐私).{0,70}|隐私设置.{0,40}|(?:accept|reject|decline|allow) (?:all|cookies).{0,40}|(?:accept all|save my choices|保存选择|接受全部)",
    )
]
# Someone spoken to, and what consent notices are about; both in a short line.
_YOU = re.compile(r"(?i)\b(?:you|your|we|our|us|anda|kami|vous|votre|vos|nous|notre|bạn|chúng tôi)\b|您|本站|本网站|我们|laman (?:web )?ini|trang (?:web )?này|ce site|this (?:site|website)|点击|继续访问")
_CONSENT = re.compile(r"(?i)cookies?|kuki|privacy|privasi|confidentialité|bảo mật|隐私|个人信息|consent|personal data|données personnelles|data peribadi|policy|dasar|politique|chính sách|dữ liệu|同意|newsletter|bulletin|surat berita|e-?mail|alerts?|inbox")
_SEPARATOR = re.compile(r"\s*[|｜·•›»«>]\s*|\s+/\s+|\s*/\s*(?=[一-鿿])|(?<=[一-鿿])\s*/\s*")
_CJK = re.compile("[一-鿿]")
_WORD = re.compile(r"[^\W\d_]+(?:[’'\-][^\W\d_]+)*")
_SENTENCE_END = re.compile(r"[.。！？!?…][”’\"'）)]*\s*\Z")
_MARK = re.compile(r"\s*(?:»|›|▪|■|►|\d{1,2}\s*[.、)）])\s*(?=\S)")
_BULLET = re.compile(r"\s*[-–—•*]\s+\S")
_ITEM = re.compile(r"(?:19|20)\d\d年?|\d{1,3}")

OWN, FRAME, HEADING, TITLE, SHORT, BLANK = range(6)
#: Characters of a line whose form tells by itself, and of a notice for each word to the reader and each of consent.
LINE, NOTICE = 160, 140
_PIECE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])\s*|\s*[|｜]\s*")


def _menu_share(line: str) -> float:
    """Link density: the share of characters in menu items."""
    parts = [p.strip(" :：") for p in _SEPARATOR.split(line)]
    parts = [p for p in parts if p]
    if len(parts) > 1:
        hits = sum(len(p) for p in parts if p.casefold() in MENU or _ITEM.fullmatch(p))
        short = all(len(_WORD.findall(p)) <= 4 and len(p) <= 28 and not _SENTENCE_END.search(p) for p in parts)
        total = sum(map(len, parts))
        return max(hits / total, 0.8 if short and len(parts) > 2 else 0.0)
    words, got, i = line.casefold().split(), 0, 0
    while i < len(words):  # items divided by blanks only: the longest item first
        if words[i] not in _MENU_STARTS:
            i += 1
            continue
        for j in range(min(len(words), i + 4), i, -1):
            if " ".join(words[i:j]) in MENU:
                got += j - i
                i = j
                break
        else:
            i += 1
    return got / len(words) if words else 0.0


def _bare(text: str) -> str:
    return text.strip("«»<>›‹  →…")


def _is_notice(text: str) -> bool:
    """Whether words to the reader and words of consent are as dense as in a short notice."""
    n = -(-len(text) // NOTICE)
    if n == 1:
        return bool(_YOU.search(text) and _CONSENT.search(text))
    return len(_YOU.findall(text)) >= n and len(_CONSENT.findall(text)) >= n


def _has_form(text: str) -> bool:
    """Whether a line, or three quarters of the pieces of a long one, have a form of the frame."""
    if len(text) <= LINE:
        return any(p.fullmatch(x) for x in dict.fromkeys((_bare(text), text)) for p in _FRAME)
    pieces = sorted(filter(None, _PIECE.split(text)), key=len, reverse=True)
    spare = sum(map(len, pieces)) / 4
    for p in pieces:
        if len(p) > LINE or not (_menu_share(p) >= 0.75 or _is_notice(p) or _has_form(p) or p[-1] in ".。" and _has_form(p[:-1])):
            spare -= len(p)
            if spare < 0:
                return False
    return True


def _first_pass(line: str, title: str) -> int:
    text = line.strip()
    if not text:
        return BLANK
    if title and text == title:
        return OWN
    if _BULLET.match(line):
        return OWN
    if len(text) <= LINE and OTHER_ARTICLES.fullmatch(_bare(text)):
        return HEADING
    if _menu_share(text) >= 0.75 or _is_notice(text) or _has_form(text):
        return FRAME
    body = _MARK.sub("", text, count=1)
    cjk = len(_CJK.findall(body))
    if cjk >= 4:
        if _SENTENCE_END.search(body) or cjk > 60:
            return OWN
        return TITLE if len(body) >= 11 else SHORT
    words = _WORD.findall(body)
    dense = sum(w.lower() in STOP_WORDS for w in words) / max(1, len(words))
    if _SENTENCE_END.search(body) and len(words) >= 4 and (dense >= 0.08 or len(words) >= 8) or len(words) > 30:
        return OWN
    inner = any(w[0].isupper() for w in words[1:]) or bool(re.search(r"\d", body))
    return TITLE if len(words) >= 6 or len(words) >= 4 and inner else SHORT


# A line's code: its kind and what else the second pass asks of it.
_BULLETED, _MARKED, _POINTED = 8, 16, 32


def line_codes(text: str, title: str | None = None) -> list[int]:
    """Codes of the lines of a text: the result of the first pass."""
    out, head = [], (title or "").strip()
    for line in text.split("\n"):
        out.append(_first_pass(line, head) + _BULLETED * bool(_BULLET.match(line)) + _MARKED * bool(_MARK.match(line)) + _POINTED * line.lstrip().startswith(("»", "›")))
    return out


def labels_of(codes: list[int], again: set[int] = frozenset()) -> list[int]:
    """Numbers, from 1, of the lines of the frame: the second pass over line codes.
    ``again`` are the numbers of lines that recur in their source."""
    kinds = [c & 7 for c in codes]
    if again:  # from either end, as long as nothing but lines of the frame was met
        for order in (range(len(kinds)), range(len(kinds) - 1, -1, -1)):
            for i in order:
                if i + 1 in again and kinds[i] not in (HEADING, BLANK):
                    kinds[i] = FRAME
                elif kinds[i] not in (FRAME, BLANK):
                    break
    labels = kinds.copy()
    in_list = False
    for i, kind in enumerate(kinds):
        if kind == HEADING:
            in_list, labels[i] = True, FRAME
        elif kind == TITLE:
            labels[i] = FRAME if in_list or codes[i] & _POINTED else OWN
        elif kind == SHORT:
            in_list = in_list and bool(codes[i] & _MARKED)
            labels[i] = FRAME if in_list else SHORT
        elif kind in (OWN, FRAME):
            in_list = in_list and kind == OWN and bool(codes[i] & _BULLETED)
    after = OWN
    following = [OWN] * len(labels)
    for i in range(len(labels) - 1, -1, -1):
        following[i] = after
        after = labels[i] if labels[i] in (OWN, FRAME) else after
    before = OWN
    for i, label in enumerate(labels):
        if label == SHORT:
            labels[i] = FRAME if before == following[i] == FRAME else OWN
        elif label in (OWN, FRAME):
            before = label
    return [i for i, x in enumerate(labels, 1) if x == FRAME]


def frame_lines(text: str | None, title: str | None = None, again: set[int] = frozenset()) -> list[int]:
    """Numbers, from 1, of the lines of ``text`` that belong to the page around it."""
    return labels_of(line_codes(text, title), again) if text else []


#: Titles of a source, and their share in it, whose pages must have a line for it to recur.
MIN_TITLES, MIN_SHARE = 8, 0.05


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(text.split()).casefold().encode("utf-8", "surrogatepass")) - (1 << 63)


def _coded(batches):
    for b in batches:
        codes = [line_codes(text, title) for text, title in zip(b["text"], b["title"])]
        hashes = [[0 if not line.strip() else _hash(line) for line in text.split("\n")] for text in b["text"]]
        yield pd.DataFrame({"table_name": b["table_name"].tolist(), "rec_id": b["rec_id"].to_numpy(), "source": pd.Series(b["source"].tolist(), dtype=object), "title": [_hash(t or "") for t in b["title"]], "codes": [bytes(c) for c in codes], "lines": hashes})


def _pages(tables: dict[str, tuple[DataFrame, str]], source: str) -> DataFrame:
    rows = None
    for name, (frame, column) in tables.items():
        where = F.col(source).cast("string") if source in frame.columns else F.lit(None).cast("string")
        part = frame.select(F.lit(name).alias("table_name"), F.col("rec_id").cast("bigint").alias("rec_id"), where.alias("source"), "title", F.col(column).alias("text")).where("text <> '' and rec_id is not null")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def recurring(coded: DataFrame, min_titles: int = MIN_TITLES, min_share: float = MIN_SHARE) -> DataFrame:
    """(table_name, source, line) of lines that pages of at least ``min_titles`` different
    titles of a source have, and ``min_share`` of its titles.  Pages without source have
    none.  Rows are counted first, and titles only for lines of enough rows."""
    key = ["table_name", "source"]
    known = coded.where("source is not null")
    titles = known.select(*key, "title").distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("titles"))
    lines = known.select(*key, "title", F.explode(F.array_distinct("lines")).alias("line")).where("line <> 0")
    often = lines.groupBy(*key, "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_titles).select(*key, "line")
    exact = lines.join(if_small(cut_lineage(often), 40), [*key, "line"]).distinct().groupBy(*key, "line").agg(F.count(F.lit(1)).alias("n"))
    return exact.where(F.col("n") >= min_titles).join(titles, key).where(F.col("n") >= F.col("titles") * min_share).select(*key, "line")


def _labelled(batches):
    for b in batches:
        recs, tables, numbers = [], [], []
        for table, rec, codes, again in zip(b["table_name"], b["rec_id"], b["codes"], b["again"]):
            for n in labels_of(list(codes), set() if again is None else set(again)):
                tables.append(table)
                recs.append(rec)
                numbers.append(n)
        if recs:
            yield pd.DataFrame({"table_name": tables, "rec_id": np.array(recs, np.int64), "line_no": np.array(numbers, np.int32)})


def page_frame(tables: dict[str, tuple[DataFrame, str]], source: str = "source_name", **limits) -> DataFrame:
    """(table_name, rec_id, line_no) of lines of the page frame.

    ``tables`` maps a name to (frame, text column); frames need rec_id and title, and the
    column ``source`` if lines that recur in a source are to count.
    Lines are the pieces between line feeds, from 1; blank ones are no cases.  Null
    and empty texts and rows without rec_id give nothing; a null title is no line.
    Repeated rows give their lines each."""
    schema = "table_name string, rec_id bigint, source string, title bigint, codes binary, lines array<bigint>"
    coded = cut_lineage(_pages(tables, source).mapInPandas(_coded, schema))
    key = ["table_name", "rec_id"]
    found = cut_lineage(recurring(coded, **limits))
    spread = coded.where("source is not null").select(*key, "source", F.posexplode("lines").alias("at", "line"))
    again = spread.join(if_small(found, 40), ["table_name", "source", "line"]).groupBy(*key).agg(F.collect_set(F.col("at") + 1).alias("again"))  # lines of one page
    return coded.select(*key, "codes").join(again, key, "left").mapInPandas(_labelled, "table_name string, rec_id bigint, line_no int")


def main_text(text: str | None, title: str | None = None) -> str | None:
    """``text`` without the lines of the page frame."""
    return _without(text, set(frame_lines(text, title))) if text else text


def _without(text: str, cut: set[int]) -> str:
    return "\n".join(line for i, line in enumerate(text.split("\n"), 1) if i not in cut)


def main_texts(tables: dict[str, tuple[DataFrame, str]], source: str = "source_name", **limits) -> DataFrame:
    """(table_name, rec_id, own_text): the texts of :func:`page_frame`'s tables without the
    lines of the page frame; null and empty texts stay.  Rows of one rec_id get the cuts of all of them."""
    cut = page_frame(tables, source, **limits).groupBy("table_name", "rec_id").agg(F.collect_set("line_no").alias("cut"))
    rows = reduce(DataFrame.unionByName, [f.where("rec_id is not null").select(F.lit(name).alias("table_name"), F.col("rec_id").cast("bigint").alias("rec_id"), F.col(c).alias("text")) for name, (f, c) in tables.items()])
    lines = F.split(F.col("text"), "\n", -1)
    own = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("cut", (i + 1).cast("int"))), "\n")
    joined = rows.join(cut, ["table_name", "rec_id"], "left")
    return joined.select("table_name", "rec_id", F.when(F.col("cut").isNull(), F.col("text")).otherwise(own).alias("own_text"))
