"""Queries of sources, sinks, extraction, analysis and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from presslake.functions import html, text
from presslake.operators import analysis
from presslake.plans.queries import _WS, query, read
from presslake.session import ensure_checkpoint_dir
from presslake.sources import files
from presslake.streaming import incremental


def pages(spark, folder):
    """Pages with headings, paragraphs, a table and links made of the website articles."""
    body = F.coalesce("body", F.lit(""))
    rows = read(spark, folder, "site_adapters")
    title = text.html_escaped(F.coalesce("title", F.lit("")))
    paragraphs = F.array_join(F.transform(F.split(text.html_escaped(body), "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    table = F.concat(F.lit("<table><tr><th>Author</th><th>Category</th></tr><tr><td>"), text.html_escaped(F.coalesce("author", F.lit(""))), F.lit("</td><td>"), F.coalesce("category", F.lit("")), F.lit("</td></tr></table>"))
    link = F.concat(F.lit('<a href="'), text.html_escaped(F.coalesce("url", F.lit(""))), F.lit('">source</a><img data-src="i.png">'))
    return rows.withColumn("html", F.concat(F.lit("<html><head><title>t</title></head><body><nav>menu</nav><h1>"), title, F.lit("</h1><div id='content'>"), paragraphs, F.lit("</div>"), table, link, F.lit("<footer>foot</footer></body>")))


@query()
def html_text(spark, folder):
    return pages(spark, folder).select("rec_id", html.html_text(F.col("html")).alias("text"))


@query("select rec_id, category, coalesce(author, '') author from site_adapters where coalesce(author, '') <> '' or coalesce(category, '') <> ''")
def html_tables(spark, folder):
    rows = html.table_records(pages(spark, folder).select("rec_id", "html"), "html", {"author": "author"})
    return rows.select("rec_id", F.col("record")["category"].alias("category"), F.regexp_replace(F.col("record")["author"], "^$", "").alias("author"))


@query()
def html_detail(spark, folder):
    rows = pages(spark, folder).select("rec_id", html.html_page(F.col("html"), ["#content", "article"]).alias("d"))
    return rows.select("rec_id", "d.title", "d.body", F.size("d.links").alias("links"), F.size("d.images").alias("images"))


@query("select rec_id, array_to_string(source_tags, ', ') source_tags, len(image_urls)::int images, case when content_text is null then null when length(content_text) > 32767 then 32767 else length(content_text) end::int text_length from scripts")
def flat_export(spark, folder):
    rows = read(spark, folder, "scripts").select("rec_id", "source_tags", F.size("image_urls").alias("images"), "content_text")
    return files.flat_columns(rows).select("rec_id", "source_tags", "images", F.length("content_text").alias("text_length"))


@query("select rec_id, title, source_name from update_llm_ready")
def json_roundtrip(spark, folder):
    """Rows written as JSON lines (lists, wrapped lists, objects) and read by the tolerant reader."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/json-{uuid.uuid4().hex}"
    one = F.to_json(F.struct("rec_id", "title", "source_name"), {"ignoreNullFields": "false"})
    line = F.when(F.col("rec_id") % 3 == 0, F.concat(F.lit("["), one, F.lit(", 5, null]"))).when(F.col("rec_id") % 3 == 1, F.concat(F.lit('{"records": ['), one, F.lit("]}"))).otherwise(one)
    read(spark, folder, "update_llm_ready").select(line.alias("value")).write.text(path)
    return files.read_records(spark, path, "rec_id bigint, title string, source_name string", lines=True)


@query("select count(*) as rows, count(*) filter (where fetch_status = 'success') success, count(*) filter (where coalesce(content_text, '') = '') without_text from scripts")
def run_manifest(spark, folder):
    return files.manifest(read(spark, folder, "scripts"), {"success": F.col("fetch_status") == "success", "without_text": F.coalesce("content_text", F.lit("")) == ""})


@query("select rec_id, '## ' || coalesce(title, '') || chr(10) || '- Source: ' || coalesce(source_name, '') || chr(10) || '- Words: ' || coalesce(word_count::varchar, '') || chr(10) || chr(10) || coalesce(main_text_preview, '') markdown from update_llm_ready")
def markdown_corpus(spark, folder):
    """Headings with previews, as its SQL has them; whole articles are in ``markdown_articles``."""
    rows = files.markdown_records(read(spark, folder, "update_llm_ready"), "title", {"source_name": "Source", "word_count": "Words"}, "main_text_preview")
    return rows.select("rec_id", "markdown")


_TAGS = "coalesce(array_to_string(source_tags, '、'), '')"
_HEAD = "coalesce(source_name, ''), '{1}发布时间：', coalesce(published, ''), '{1}分类：', coalesce(source_category, ''), '{1}标签：', " + _TAGS + ", '{1}原文链接：', coalesce(link, '')"
_IMAGES = "coalesce(nullif(image_ocr_text, ''), '无')"
_STRIPPED = r"regexp_replace(replace(coalesce(title, ''), chr(10), ' '), '^[\s\p{Z}\x{b}\x{1c}-\x{1f}\x{85}]+|[\s\p{Z}\x{b}\x{1c}-\x{1f}\x{85}]+$', '', 'g')"


@query(
    "select rec_id, concat('# ', coalesce(nullif(title, ''), 'Untitled'), '\n\n来源：', " + _HEAD.replace("{1}", "  \n") + ", '  \n数据质量分：', coalesce(data_quality_score, 0), '  \n数据质量说明：', coalesce(data_quality_note, ''), '  \n\n## 正文\n\n', coalesce(nullif(main_text, ''), '无'), '\n\n## 图片 OCR 补充信息\n\n', " + _IMAGES + ", '\n\n---\n') markdown, "
    "concat('---\n\n## ', coalesce(nullif(" + _STRIPPED + ", ''), 'Untitled'), '\n\n- 来源：', " + _HEAD.replace("{1}", "\n- ") + ", '\n- 正文长度：', coalesce(text_length, 0), '\n- 图片数量：', coalesce(image_count, 0), '\n\n### 正文\n\n', coalesce(main_text, ''), '\n\n### 图片 OCR 补充信息\n\n', " + _IMAGES + f", '\n\n> {files.IMAGE_NOTE}\n') prepared from update_llm_ready"
)
def markdown_articles(spark, folder):
    return files.article_markdown(read(spark, folder, "update_llm_ready")).select("rec_id", "markdown", "prepared")


_FIRST = "coalesce(case when trim(rss_summary) <> '' then rss_summary end, case when trim(content_text) <> '' then content_text end, '')"


@query(f"select rec_id, length({_FIRST})::int n, md5({_FIRST}) content_md5, case when coalesce(content_text, '') <> '' then 'page' when coalesce(rss_summary, '') <> '' then 'rss' else 'failed' end origin from scripts")
def content_fallback(spark, folder):
    c, s = F.coalesce("content_text", F.lit("")), F.coalesce("rss_summary", F.lit(""))
    first = text.first_present(F.col("rss_summary"), F.col("content_text"))
    return read(spark, folder, "scripts").select("rec_id", F.length(first).alias("n"), F.md5(first).alias("content_md5"), F.when(c != "", "page").when(s != "", "rss").otherwise("failed").alias("origin"))


@query("select rec_id, len(list_filter([case when coalesce(trim(title), '') = '' then 1 end, case when not coalesce(data_quality_score between 0 and 60, false) then 1 end, case when not coalesce(fetch_status in ('success', 'failed'), false) then 1 end, case when source_tags is null then 1 end], lambda x: x is not null))::int errors from update_llm_ready")
def answer_violations(spark, folder):
    errors = analysis.violations(["title"], {"data_quality_score": (0, 60)}, {"fetch_status": ["success", "failed"]}, ["source_tags"])
    return read(spark, folder, "update_llm_ready").select("rec_id", F.size(errors).alias("errors"))


_WORDS = f"array_to_string(list_filter(string_split_regex(coalesce(body, ''), '{_WS}'), lambda x: x <> '')[1:12], ' ')"


@query(f"select rec_id, md5({_WORDS}) summary_md5, (length(coalesce(title, '')) % 21)::int relevance, 'v1' as version, 2 as tries from parsers")
def offline_analysis(spark, folder):
    """Answers of a stand-in that fails at its first try for every batch."""
    rows = read(spark, folder, "parsers").select("rec_id", "title", "body")
    out = analysis.analyse(rows, analysis.Flaky(analysis.offline_answers), "rec_id bigint, summary string, relevance int, tries int", "v1", pause=0.0)
    return out.select("rec_id", F.md5("summary").alias("summary_md5"), "relevance", "version", "tries")


@query("select p.rec_id, lower(regexp_extract(p.url, '^[a-z]+://([^/?#]+)', 1)) = 'www.' || g.host same_site from parsers p join source_registry g using (source_id) where p.url is not null")
def attachment_hosts(spark, folder):
    registry = read(spark, folder, "source_registry").select("source_id", F.concat(F.lit("https://www."), "host", F.lit("/file")).alias("attachment"))
    rows = read(spark, folder, "parsers").where("url is not null").join(registry, "source_id")
    return rows.select("rec_id", html.same_host(F.col("url"), F.col("attachment")).alias("same_site"))


@query("select count(distinct user_id::varchar || event_type) n from events")
def stream_first_seen(spark, folder):
    """Keys of a stream seen once; counted after the stream has ended."""
    path = f"{folder}/events.parquet"
    stream = incremental.read_stream(spark, path, spark.read.parquet(path).schema)
    keyed = stream.select(F.concat(F.col("user_id").cast("string"), "event_type").alias("k"), F.col("ts").cast("timestamp").alias("ts"))
    return incremental.run_to_end(incremental.first_seen(keyed, "k", "ts", "60 days"), "first").agg(F.count("k").alias("n"))


@query("select event_type, time_bucket(interval '7 days', ts, timestamp '2024-01-01') window_start, count(*) n from events group by all")
def stream_week_counts(spark, folder):
    path = f"{folder}/events.parquet"
    stream = incremental.read_stream(spark, path, spark.read.parquet(path).schema).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = incremental.window_counts(stream, "ts", "7 days", ["event_type"], "60 days", "4 days")  # windows start on Mondays
    rows = incremental.last_state(incremental.run_to_end(counts, "weeks", "update"), ["window_start", "event_type"])
    return rows.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")
