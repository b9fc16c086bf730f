import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from presslake.llm.page_frame import frame_lines, main_text, main_texts, page_frame
from presslake.llm.site_lines import chunk_hashes, line_key, repeated_lines, without_repeated_lines


def brute(rows, least=8, share=0.05):
    kept = [r for r in rows if r[0] is not None and r[1] is not None and r[2]]
    docs, n = defaultdict(list), defaultdict(int)
    for i, (_, source, text) in enumerate(kept):
        n[source] += 1
        for line in text.split("\n"):
            key = re.sub(r"[\s\d]+", "", line.casefold())
            if key:
                docs[source, key].append(i)
    often = {k for k, v in docs.items() if len(set(v)) >= least and len(set(v)) >= share * n[k[0]]}
    return {(rec, no) for rec, source, text in kept for no, line in enumerate(text.split("\n"), 1) if (source, re.sub(r"[\s\d]+", "", line.casefold())) in often}


def test_repeated_lines_against_brute_force(spark):
    r = random.Random(2)
    rows = []
    for i in range(300):
        source = "hot" if i % 3 else r.choice(["a", "b", None])
        lines = [f"own line {r.random()}" + "x" * r.choice([0, 300]) for _ in range(r.randint(0, 4))]
        for k in range(12):
            if r.random() < k / 25:
                lines.append(r.choice(["Read {} times", "READ {} times ", "Sign up {}", "12 {}", "，版权 {}"]).format(r.randint(1, 99)) + "!" * k)
        r.shuffle(lines)
        rows.append((i, source, r.choice([None, "", "\n".join(lines)]) if i % 17 == 0 else "\n".join(lines)))
    rows.append((None, "hot", "Sign up 1"))
    frame = spark.createDataFrame([(*x, 0, "z") for x in rows], "rec_id bigint, source_name string, content_text string, line_no int, source string")
    got = repeated_lines(frame).collect()
    assert {tuple(x) for x in got} == brute(rows) and len(got) == len(set(got)) and got
    cut = {x.rec_id: x.content_text for x in without_repeated_lines(frame.where("rec_id is not null")).select("rec_id", "content_text").collect()}
    for rec, _, text in rows:
        if rec is not None:
            drop = {n for x, n in brute(rows) if x == rec}
            assert cut[rec] == (None if text is None else "\n".join(line for n, line in enumerate(text.split("\n"), 1) if n not in drop))
    assert repeated_lines(frame.limit(0)).count() == 0


def test_chunks_depend_on_the_line_only():
    lines = ["abc" * 60, "x", "the same long line of text " * 5, "y" * 400]
    owner, value = chunk_hashes(lines)
    alone = [chunk_hashes([x])[1] for x in lines]
    assert all((value[owner == i] == a).all() for i, a in enumerate(alone))
    shifted = chunk_hashes(["zz" + lines[2]])[1]
    assert np.isin(value[owner == 2], shifted).sum() >= len(alone[2]) - 2  # an insertion changes the chunks around it only
    assert len(chunk_hashes([])[0]) == 0 and line_key(" 12\t") == ""


PAGE = """Home | News | Contact | Search
You are here: Home / News
We use cookies to improve your visit. Accept all | Reject | Settings
Acme recalled the coated stent in Port Grigath
Acme recalled 12 coated stents in Port Grigath, as several complaints had arrived.
The depot said a cookie notice on the ordering portal had confused 54 buyers.
Background
- Halkeld board approved 45 filters last week
Prices for the stent rose by 3 percent over the summer. No date was given for the return.
You may also like
1. Foundation in Grizel signed the dressing contract
» Peldara Biologics replaced revised screw in Ibeosk

Next steps
The agency will review the case in March, once the documents are complete.
Subscribe to our newsletter and never miss an alert
© 2024 Acme. All rights reserved."""


def test_page_frame():
    assert frame_lines(PAGE, "Acme recalled the coated stent in Port Grigath") == [1, 2, 3, 10, 11, 12, 16, 17]
    assert frame_lines("首页 / 招标采购 / 2025年\n标题：支架召回通报\n据介绍，该型号支架已召回，标签难以辨认。\n背景\n订阅该服务的医院周四收到43件样品。\n相关阅读\n上半年审批观察：预灌封吸入器与手套\n返回顶部", "标题：支架召回通报") == [1, 6, 7, 8]
    assert frame_lines(None) == [] and frame_lines("") == [] and frame_lines("\n \n") == [] and main_text(None) is None
    assert main_text("Home | Search | News\nA sentence that belongs to the article itself.") == "A sentence that belongs to the article itself."


def test_long_lines_of_the_frame():
    cookies = "We use cookies and similar technologies to give you the best experience on our site, to measure how you use it and to show you content in your language. You can accept all cookies or change your consent at any time; our privacy policy tells you what personal data we keep."
    menu = " | ".join(["Home", "About us", "Products", "Services", "Support", "Contact", "Careers", "Newsroom", "Events", "Downloads", "Site map", "Privacy policy", "Terms of use", "Accessibility", "Investor relations", "Regulations"])
    footer = "© 2025 Acme Medical Group. Copyright 2025 Acme Medical Group and its partners in the region. All rights reserved. Powered by Example Systems and Partners. Last updated by the web team on 3 May 2025."
    own = "The agency of the region said that the privacy of patients was kept in all of the trials, and that the makers of the coated stent had sent the data of 481 patients to the three hospitals in Port Grigath after the recall of the device, which was announced by the board on Thursday."
    assert min(map(len, (cookies, menu, footer, own))) > 160
    assert frame_lines("\n".join([menu, own, cookies, own, footer])) == [1, 3, 5]


def test_page_frame_operator(spark):
    rows = spark.createDataFrame([(1, None, "Print this page\nx"), (2, "t", None), (3, "t", ""), (None, "t", "Print this page"), (1, None, "Print this page\nx"), (4, None, "word " * 200_000)], "rec_id bigint, title string, body string").withColumn("text", F.lit(1))
    got = page_frame({"site_adapters": (rows, "body")}).collect()
    assert [tuple(x) for x in got] == [("site_adapters", 1, 1)] * 2
    assert page_frame({"site_adapters": (rows.limit(0), "body")}).count() == 0
    assert [x.own_text for x in main_texts({"t": (rows.where("rec_id < 4"), "body")}).orderBy("rec_id").collect()] == ["x", "x", None, ""]


GERMAN = ["Startseite", "Über uns", "Unsere Leistungen im Überblick", "Wir verwenden Cookies, damit Sie unsere Seiten gut nutzen können.", None, "Beitrag weiterempfehlen", "Impressum und Datenschutz", "Alle Rechte vorbehalten, Musterverlag in Beispielstadt"]
SPANISH = ["Inicio", "Quiénes somos", "Ámbitos de trabajo y proyectos", None, "Compartir esta página con sus colegas", "Utilizamos cookies propias y de terceros para mejorar nuestros servicios.", "Aviso legal", "Suscríbase a nuestro boletín semanal"]


def test_lines_that_recur_in_a_source_of_any_language(spark):
    rows, want = [], set()
    for k, page in enumerate((GERMAN, SPANISH)):
        for i in range(12):
            own = [f"Meldung {i}", f"Der Hersteller meldet Vorgang {i}.", "Hintergrund", f"Die Prüfung {i} dauert an."]
            lines = [x for part in page for x in (own if part is None else [part])]
            rows.append((100 * k + i, f"Meldung {i}", f"s{k}", "\n".join(lines)))
            want |= {(100 * k + i, n) for n, x in enumerate(lines, 1) if x in page}
    rows += [(500 + i, "same title", "s2", "Startseite\nText") for i in range(20)]  # copies of one page tell nothing
    frame = spark.createDataFrame(rows, "rec_id bigint, title string, source_name string, body string")
    got = {(r.rec_id, r.line_no) for r in page_frame({"t": (frame, "body")}).collect()}
    assert got == want
    no_source = page_frame({"t": (frame.drop("source_name"), "body")}).collect()
    assert {(r.rec_id, r.line_no) for r in no_source} < want
