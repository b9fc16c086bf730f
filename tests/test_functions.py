from pyspark.sql import functions as F

from presslake.functions import dates, html, text, urls


def values(spark, rows, column, schema="c string"):
    frame = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in frame.select(column).collect()]


def test_text(spark):
    c = F.col("c")
    assert values(spark, ["  A  b\n", None, ""], text.squeeze(c)) == ["A b", "", ""]
    assert values(spark, ["Hello, World!"], text.plain_title(c)) == ["hello world"]
    assert values(spark, ["x" * 79, "x" * 80, None], F.length(text.fingerprint(c))) == [0, 64, 0]
    assert values(spark, ["a\r\nb​\n\n\n\n c "], text.tidy_lines(c)) == ["a\nb\n\nc"]
    assert values(spark, ["<p>a</p><script>x</script>b"], F.trim(text.without_markup(c))) == ["a  b"]
    assert values(spark, ["T\nT\nbody", "T"], text.without_leading_title(c, F.lit("T"))) == ["body", "T"]
    assert values(spark, ["one two three"], text.snippet(c, 9)) == ["one two..."]
    assert values(spark, ["a - b - c", "x"], F.to_json(text.split_publisher(c))) == ['{"head":"a - b","publisher":"c"}', '{"head":"x","publisher":""}']
    assert values(spark, ["a，b、 ,c"], text.split_tags(c)) == [["a", "b", "c"]]
    assert values(spark, ["a stent", "stents", "医械"], text.holds_phrase(c, "stent")) == [True, False, False]
    assert values(spark, ["see ```json {\"a\": {}} ```"], text.json_object(c)) == ['{"a": {}}']
    assert values(spark, ["## A\nx\n## B\ny"], text.section_of(c, "A")) == ["x"]
    assert values(spark, ["S CMO of A BC", "x", "1 2 款 3 4 x"], text.joined_letters(c)) == ["SCMO of ABC", "x", "12 款 3 4 x"]
    notes = "a\n\n[图片信息]\n图片1: x\n\nb\nhttps://c/d\ne [图片信息] f[图片OCR文字] g"
    assert values(spark, [notes, "[图片OCR文字]", None], text.without_image_notes(c)) == ["a\n\nb\ne", "", ""]
    names = text.company_names(c, F.lit("Own Ltd"), ["Bad Ltd"], ["Ltd", "Devices"], ["Manufacturer"])
    assert values(spark, ["Two new Acme Care Devices, Own Ltd and Bad Ltd", "Manufacturer: some maker; x", "", "Ltd"], names) == [["Acme Care Devices"], ["some maker"], [], []]


def test_urls(spark):
    c = F.col("c")
    assert values(spark, ["HTTPS://A.b//x//y/?utm_source=1&z=2&a#f", "", None], urls.dedup_key(c)) == ["https://a.b/x/y?a=&z=2", "/", "/"]
    assert values(spark, ["https://A.b/x/?z=2&a=1&_sp=9#f", ""], urls.ledger_key(c)) == ["https://a.b/x/?z=2&a=1", ""]
    assert values(spark, ["http://a.b//c?x=1#f"], urls.page_address(c)) == ["http://a.b/c?x=1"]
    assert values(spark, ["http://a/?limit=5&x=1", "http://a/"], urls.with_parameter(c, "limit", "9")) == ["http://a/?limit=9&x=1", "http://a/?limit=9"]
    assert values(spark, ["http://a/b/c"], urls.resolved(c, F.lit("../d"))) == ["http://a/d"]
    assert values(spark, ["http://a/news/2026/x-y-z", "http://a/tag/1", "http://a/"], urls.looks_like_article(c)) == [True, False, False]


def test_dates(spark):
    day = lambda fn, *rows: [str(v) if v else None for v in values(spark, list(rows), fn(F.col("c")))]
    assert day(dates.any_date, "2026-7-5", "05/07/2026", "on 5 Juli 2026", "July 5, 2026", "2026-13-40", None, "x 12 Foo 2026 July 5 2026", "2026-07-05T1") == ["2026-07-05"] * 4 + [None, None, "2026-07-05", None]
    assert day(dates.report_date, "2026-07-05", "5 Jul 2026", "x 5 Jul 2026") == ["2026-07-05", "2026-07-05", None]
    assert day(dates.mail_date, "Wed, 15 Jul 2026 00:00:00 GMT", "2026-07-15T01:00:00Z", "?") == ["2026-07-15", "2026-07-15", None]
    assert day(dates.issue_end, "2026-12", "2026-13") == ["2027-01-01", None]
    assert values(spark, ["3 hours ago", "昨天", "2026-01-01"], dates.is_relative(F.col("c"))) == [True, True, False]
    weeks = values(spark, ["2026-07-04", "2026-07-05", "2026-07-31"], dates.month_week(F.to_date("c")))
    assert weeks == [1, 2, 5]


def test_html(spark):
    page = "<html><body><h1>T</h1><nav>no</nav><div class=c><p>" + "word " * 20 + "</p></div><table><tr><th>Name</th><th>No</th></tr><tr><td>a</td><td>1</td></tr></table><a href=/x>l</a><img src=i.png></body>"
    assert html.tables_of(page, {"no": "number"}) == [{"name": "a", "number": "1"}]
    assert html.detail_of(page, [".c"])["body"] == ("word " * 20).strip() and html.detail_of(page, [])["title"] == "T"
    assert html.links_of(page) == [{"href": "/x", "text": "l"}] and html.images_of(page) == ["i.png"]
    assert html.text_of(None) == "" and html.text_of("<p>a<b>c") == "ac" and "no" not in html.text_of(page).split()
    assert html.text_of("<div>" * 5000 + "x") == "x"
    assert values(spark, [page, None, ""], F.size(html.html_tables(F.col("c")))) == [1, 0, 0]
