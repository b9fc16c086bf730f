import pytest
from pyspark.sql import functions as F

from presslake.functions import urls
from presslake.operators import analysis, pages, prompts, records
from presslake.sources import client, files


def test_embedded_records_and_cards(spark):
    rows = spark.createDataFrame([('x id:1;t=a; id:2;t=; id:3;t=c',), ("",), (None,), ("id:",)], "p string")
    got = [r[0] for r in rows.select(pages.embedded_records(F.col("p"), "id:", {"n": r"id:(\d)", "t": "t=([a-z]*);?"}, ["n", "t"])).collect()]
    assert [[tuple(x) for x in g] for g in got] == [[("1", "a"), ("3", "c")], [], [], []]
    page = '<div>Published 5 Jul 2026 <ul><li><a href="/d?id=1">T <b>1</b></a></li></ul> Kind x</div><a href="/d?id=2">alone</a>'
    # A link outside of any card gets the element that holds both, here the page.
    assert pages.cards_of(page, "id=2", ["Published", "Kind"], "(.)")[0]["text"].endswith("Kind x alone")
    assert pages.cards_of(page, "id=1", ["Published", "Kind"], r"Published (\d+ \w+ \d+)") == [{"href": "/d?id=1", "title": "T 1", "found": "5 Jul 2026", "text": "Published 5 Jul 2026 T 1 Kind x"}]
    assert pages.cards_of(None, "x", ["y"], "z") == [] and pages.cards_of("", "x", [], "z") == []
    one = spark.createDataFrame([("/a?x=1&RefID=77&s=2",), ("/a?refid=",), (None,)], "h string").select(pages.stable_address(F.col("h"), "refid", "http://s/")).collect()
    assert [r[0] for r in one] == ["http://s/77", None, None]
    parsed = spark.createDataFrame([("12",), ("x",), (None,)], "v string").select(pages.guarded(F.col("v"), int, "bigint").alias("r")).select("r.*").collect()
    assert [(r.value, (r.error or "").split(":")[0]) for r in parsed] == [(12, ""), (None, "ValueError"), (None, "TypeError")]


def test_resolved_addresses_as_the_standard_says(spark):
    from urllib.parse import urljoin

    base = "http://a/b/c/d;p?q"
    refs = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "", ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "./../g", "g/../h", "g;x=1/../y", "http:g", "https://z/q", "mailto:x"]
    rows = spark.createDataFrame([(r,) for r in refs], "r string")
    got = {r.r: r.u for r in rows.select("r", urls.resolved(F.lit(base), F.col("r")).alias("u")).collect()}
    assert {r: u for r, u in got.items() if r != "http:g"} == {r: urljoin(base, r) for r in refs if r != "http:g"} and got["http:g"] == "http:g"
    assert spark.range(1).select(urls.resolved(F.lit("http://a"), F.lit("x")), urls.resolved(F.lit(None).cast("string"), F.lit("x"))).first()[:] == ("http://a/x", "x")


def test_polite_client():
    waits, answers = [], [client.Answer(503), OSError("reset"), client.Answer(429, headers={"retry-after": "9"}), client.Answer(200, "page")]

    def fetch(address):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    assert client.polite(fetch, 4, 1.0, sleep=waits.append)("x") == "page" and waits == [1.0, 2.0, 9.0]
    for bad in (client.Answer(404), client.Answer(200, "", {"content-type": "application/pdf"})):
        with pytest.raises(client.NotPolite):
            client.polite(lambda a, b=bad: b)("x")
    with pytest.raises(client.NotPolite, match="503"):
        client.polite(lambda a: client.Answer(503), 2, sleep=waits.append)("x")
    assert client.is_alive(lambda a: client.Answer(200), "x") and not client.is_alive(lambda a: client.Answer(500), "x")


def test_backup_pages_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([(1, "</script>"), (2, None)], "k int, t string")
    path = f"{tmp_path}/t"
    assert files.overwrite_with_backup(rows, path, "1") is None
    assert files.overwrite_with_backup(rows.limit(1), path, "2") == f"{path}_backup_2"
    assert spark.read.parquet(path).count() == 1 and spark.read.parquet(f"{path}_backup_2").count() == 2
    with pytest.raises(FileExistsError):
        files.overwrite_with_backup(rows, path, "2")
    page = files.reader_page(rows, "a<b")
    assert "a&lt;b" in page and page.count("</script>") == 2
    text = files.report_markdown("R", {"A": rows, "B": rows.where("false")}, "- {k}: {t}", ["k"])
    assert text == "# R\n\n## A\n\n- 1: </script>\n- 2: \n\n## B\n\nNone.\n"
    with pytest.raises(ValueError):
        files.reader_page(rows, "x", most=1)
    assert analysis.written_report(rows) == "" and analysis.written_report(rows, lambda r: str(len(r))) == "2"


def test_prepared_articles_with_nulls_and_other_columns(spark):
    schema = ", ".join(f"{c} {'array<string>' if c in ('source_tags', 'image_urls') else 'int' if c in ('image_count', 'text_length', 'word_count', 'data_quality_score') else 'boolean' if c.startswith('has_') else 'string'}" for c in prompts.PREPARED[:-2])
    names = [f.split()[0] for f in schema.split(", ")]
    row = dict.fromkeys(names) | {"main_text": "a\n[图片信息] x", "fetch_status": "success", "link": "l"}
    frame = spark.createDataFrame([tuple(row[n] for n in names), tuple([None] * len(names))], schema).withColumn("_cut", F.lit(1))
    a, b = prompts.prepared(frame).collect()
    assert list(a.asDict()) == prompts.PREPARED and (a.main_text, a.content_source, a.article_id, a.image_count, a.has_full_text) == ("a", "wechat_page", "l", 0, False)
    assert (b.main_text, b.text_length, b.article_id) == ("", 0, "") and prompts.prepared(frame.limit(0)).count() == 0
    assert a.llm_input_text.endswith("正文：\na\n\n数据质量说明：") and prompts.LAST_LINE in b.llm_input_text_with_ocr


def test_caps(spark):
    rows = spark.createDataFrame([(1, 2), (None, 3), (0, 4), (5, None), (0, 0), (None, None)], "a int, b int")
    assert [r[0] for r in rows.select(records.effective_cap(F.col("a"), F.col("b"))).collect()] == [1, 3, 4, 5, None, None]


def test_command_line(capsys):
    from presslake.__main__ import main

    assert main(["list"]) == 0 and "p1_found" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["no_such_query", "--tables", "x"])
