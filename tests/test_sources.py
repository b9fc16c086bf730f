import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from presslake.operators import analysis
from presslake.sources import feeds, files
from presslake.streaming import incremental


def test_feeds(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<rss><channel><item><title>T</title><link>http://x/1</link><guid>g</guid><pubDate>Wed, 15 Jul 2026 00:00:00 GMT</pubDate><description>d</description></item></channel></rss>")
    (tmp_path / "b.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>U</title><link rel="alternate" href="http://x/2"/><id>i</id><summary>s</summary></entry></feed>')
    (tmp_path / "c.xml").write_text("<rss><broken")
    (tmp_path / "d.xml").write_text('<!DOCTYPE x [<!ENTITY a "b">]><rss/>')
    feeds.register(spark)
    rows = spark.read.format("press_feed").option("path", f"{tmp_path}/*.xml").load().collect()
    assert {(r.title, r.link, r.content) for r in rows if r.error is None} == {("T", "http://x/1", "d"), ("U", "http://x/2", "s")}
    assert sum(r.error is not None for r in rows) == 2


def test_sqlite(spark, tmp_path):
    path = f"{tmp_path}/a.db"
    with sqlite3.connect(path) as c:
        c.execute("create table t (id integer, name text)")
        c.executemany("insert into t values (?, ?)", [(i, f"n{i}") for i in range(10)])
    feeds.register(spark)
    rows = spark.read.format("press_sqlite").schema("id bigint, name string").option("path", path).option("query", "select * from t where id > 2").option("key", "id").option("partitions", 3).load()
    assert rows.rdd.getNumPartitions() == 3 and sorted(r.id for r in rows.collect()) == list(range(3, 10))


def test_records_and_registry(spark, tmp_path):
    for i, value in enumerate([[{"a": 1}, "x", {"a": 2}], {"records": [{"a": 3}]}, {"events": [{"a": 4}]}, {"other": 1}]):
        (tmp_path / f"{i}.json").write_text(json.dumps(value))
    assert sorted(r.a for r in files.read_records(spark, f"{tmp_path}/*.json", "a int").collect()) == [1, 2, 3, 4]
    (tmp_path / "r.yaml").write_text("sources:\n- {source_id: a, tags: [x, y]}\n- {source_id: b, enabled: false}\n")
    registry = files.read_registry(spark, f"{tmp_path}/r.yaml", "sources")
    assert [(r.source_id, r.tags) for r in registry.collect()] == [("a", '["x", "y"]')]
    with pytest.raises(ValueError):
        files.choose_sources(registry, ["zz"])


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(["a", "b"], "x" * 40_000, "s")], "tags array<string>, body string, source_name string")
    files.write_csv(rows, f"{tmp_path}/csv")
    part = max((p.read_text("utf-8") for p in (tmp_path / "csv").iterdir() if p.suffix == ".csv"), key=len)
    assert part.startswith("﻿tags") and "a, b" in part and len(part) < 33_000
    files.write_by_source(rows, f"{tmp_path}/p")
    files.write_by_source(rows.withColumn("source_name", F.lit("t")), f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 2
    assert "<td>s</td>" in files.html_table(rows.select("source_name"), "T")
    assert files.replace_section("## A\nx\n## B\ny\n", "A", "z") == "## A\nz\n\n## B\ny\n"
    with pytest.raises(ValueError):
        files.replace_section("## A\n", "C", "z")


def test_analyser_retries_and_reports(spark):
    rows = spark.createDataFrame([(i, f"t{i}", "b") for i in range(5)], "rec_id bigint, title string, body string")

    def broken(batch):
        raise RuntimeError("down")

    bad = analysis.analyse(rows, broken, "rec_id bigint, summary string", "v1", retries=2, pause=0).collect()
    assert len(bad) == 5 and all("down" in r.error for r in bad)
    good = analysis.analyse(rows, analysis.offline_answers, "rec_id bigint, relevance int", "v1", batch=2).collect()
    assert sorted(r.rec_id for r in good) == list(range(5)) and all(r.error is None for r in good)


def test_upsert_batches(spark, tmp_path):
    import os

    merge = incremental.upsert_batches(spark, f"{tmp_path}/l", "k", "t", buckets=16)
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, t int")
    assert merge.rows() is None
    merge(frame(*[(f"k{i}", 1) for i in range(200)], (None, 1)), 0)
    merge(frame(("k1", 2), ("new", 1)), 1)
    merge(frame(("k1", 2), ("new", 1)), 1)  # the same batch again
    merge(frame(("k1", 3)), 2)
    want = {f"k{i}": 1 for i in range(200)} | {"k1": 3, "new": 1, None: 1}
    assert {r.k: r.t for r in merge.rows().collect()} == want and merge.rows().count() == len(want)
    written = lambda v: len([d for d in os.listdir(f"{tmp_path}/l/v{v:09d}") if d.startswith("bucket")])
    assert written(2) == 1 and written(1) <= 2  # a batch of few keys writes few buckets
    merge(frame(("k1", 4)), 3)
    assert {r.k: r.t for r in merge.rows().collect()} == want | {"k1": 4}


def test_feeds_as_files_of_a_cluster(spark, tmp_path):
    item = "<item><guid>{0}</guid><title>T{0}</title><link>http://x/{0}</link><description>d</description></item>"
    for name, body in (("a", item.format(1) + item.format(2)), ("b", item.format(2) + item.format(3))):
        (tmp_path / f"{name}.xml").write_text(f"<rss><channel>{body}</channel></rss>")
    (tmp_path / "c.xml").write_text("<rss>")
    seen = spark.createDataFrame([("1",), (None,)], "guid string")
    rows = feeds.read_feeds(spark, f"{tmp_path}/*.xml")
    assert rows.count() == 5 and rows.where("error is not null").count() == 1
    new = feeds.new_entries(rows, seen).collect()
    assert sorted((r.guid, r.content, r.feed[-5:]) for r in new) == [("2", "d", "a.xml"), ("3", "d", "b.xml")]
    assert feeds.read_feeds(spark, f"{tmp_path}/*.xml", only=["b"]).count() == 2


def test_article_markdown_is_whole(spark):
    from presslake.sources.files import article_markdown

    schema = "title string, source_name string, source_category string, source_tags array<string>, link string, published string, main_text string, image_ocr_text string, text_length int, image_count int, data_quality_score int, data_quality_note string"
    text = "正文 line\n" * 500 + "end of text"
    rows = spark.createDataFrame([(" A\nB ", "S", "c", ["x", "y"], "http://l", "2026", text, "read\nhere", 9, 2, 40, "n"), (None, None, None, None, None, None, None, "", None, None, None, None)], schema)
    full, empty = article_markdown(rows).select("markdown", "prepared").collect()
    assert full.markdown == f"#  A\nB \n\n来源：S  \n发布时间：2026  \n分类：c  \n标签：x、y  \n原文链接：http://l  \n数据质量分：40  \n数据质量说明：n  \n\n## 正文\n\n{text}\n\n## 图片 OCR 补充信息\n\nread\nhere\n\n---\n"
    assert full.prepared.startswith("---\n\n## A B\n\n- 来源：S\n- 发布时间：2026\n") and f"- 原文链接：http://l\n- 正文长度：9\n- 图片数量：2\n\n### 正文\n\n{text}\n\n### 图片 OCR 补充信息\n\nread\nhere\n\n> 图片" in full.prepared
    assert empty.markdown.startswith("# Untitled\n\n来源：  \n") and "数据质量分：0  \n" in empty.markdown and "## 正文\n\n无\n\n## 图片 OCR 补充信息\n\n无\n" in empty.markdown and "## Untitled\n" in empty.prepared
