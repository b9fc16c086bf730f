"""Queries of prepared articles, page records, reports and incremental work."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions import text
from presslake.operators import analysis, pages, prompts, records
from presslake.plans.queries import _HTML, _TIDY, _WS, query, read
from presslake.plans.relational import _LEDGER, regional
from presslake.session import ensure_checkpoint_dir

_TEXT = lambda c: f"coalesce({c}, '')"
_TIDIED = lambda e: _TIDY.replace("coalesce(content_text, '')", e)
_HEAD_SQL = "concat('标题：', coalesce(title, ''), chr(10), '来源：', coalesce(source_name, ''), chr(10), '发布时间：', coalesce(published, ''), chr(10), '分类：', coalesce(source_category, ''), chr(10), '标签：', coalesce(array_to_string(source_tags, '、'), ''), chr(10), '原文链接：', coalesce(link, ''), chr(10), chr(10), '正文：', chr(10), coalesce(main_text, ''), chr(10), chr(10), '数据质量说明：', chr(10), coalesce(data_quality_note, ''))"
_WITH_OCR = f"concat(p, chr(10), chr(10), '{prompts.OCR_PART}：', chr(10), coalesce(image_ocr_text, ''), chr(10), chr(10), '{prompts.LAST_LINE}')"


@query(f"with a as (select *, {_TIDIED(_HEAD_SQL)} p from update_llm_ready) select rec_id, md5(p) prompt, md5({_TIDIED(_WITH_OCR)}) with_ocr, length(p)::int n from a")
def prompt_texts(spark, folder):
    rows = prompts.prompt_texts(read(spark, folder, "update_llm_ready"))
    return rows.select("rec_id", F.md5("llm_input_text").alias("prompt"), F.md5("llm_input_text_with_ocr").alias("with_ocr"), F.length("llm_input_text").alias("n"))


_STRIP = _HTML.replace("content_html", "main_text")
_LETTERS = lambda e: rf"regexp_replace({e}, '\b([A-Z])\s+([A-Z]{{2,}})\b', '\1\2', 'g')"
_LINES = f"array_to_string(list_filter(string_split({_STRIP}, chr(10)), lambda x: not regexp_matches(trim(x), '^https?://\\S+$')), chr(10))"
_MAIN = _LETTERS(_TIDIED(_LINES))
_OCR = _LETTERS(_TIDIED("coalesce(image_ocr_text, '')"))


@query(
    f"with a as (select *, {_MAIN} m, {_OCR} o, list_distinct(list_filter(list_transform(coalesce(image_urls, []), lambda x: trim(x)), lambda x: x <> '')) u from update_llm_ready)"
    " select coalesce(title, '') title, coalesce(case when trim(article_id) <> '' then article_id end, link, '') article_id, md5(m) main_md5, md5(o) ocr_md5, length(m)::int text_length, md5(substr(m, 1, 1000)) preview_md5, length(m) > 500 has_full_text, o <> '' has_image_ocr,"
    " coalesce(nullif(image_count, 0), len(u))::int image_count, case when fetch_status = 'success' and m <> '' and coalesce(content_source, '') = '' then 'wechat_page' else coalesce(content_source, '') end content_source, 28 as fields from a"
)
def clean_projection(spark, folder):
    rows = prompts.prepared(read(spark, folder, "update_llm_ready"))
    return rows.select(
        "title", "article_id", F.md5("main_text").alias("main_md5"), F.md5("image_ocr_text").alias("ocr_md5"), "text_length", F.md5("main_text_preview").alias("preview_md5"), "has_full_text", "has_image_ocr", "image_count", "content_source", F.lit(len(rows.columns)).alias("fields")
    )


@query("select rec_id, '\"' || source_name || '\" (' || array_to_string(list_transform(coalesce(source_tags, []), lambda t: case when contains(t, ' ') then '\"' || t || '\"' else t end), ' OR ') || ') (launch OR recall OR tender)' || case when batch_no > 0 then ' after:2026-07-01 before:2026-08-01' else '' end q from scripts where source_name is not null")
def search_queries(spark, folder):
    rows = read(spark, folder, "scripts").where("source_name is not null")
    start = F.when(F.col("batch_no") > 0, F.to_date(F.lit("2026-07-01")))
    q = prompts.search_query(F.col("source_name"), F.coalesce("source_tags", F.array().cast("array<string>")), ["launch", "recall", "tender"], start, F.to_date(F.lit("2026-08-01")))
    return rows.select("rec_id", q.alias("q"))


def _payload(frame: DataFrame, key: str) -> DataFrame:
    """A page's payload of escaped data with a record for each of two rows' titles, as list pages carry it."""
    item = lambda t: F.concat(F.lit('push(\\"id\\":\\"/notice/'), F.col(key).cast("string"), F.lit('\\",\\"kind\\":\\"'), F.coalesce("language", F.lit("")), F.lit('\\",\\"title\\":\\"'), t, F.lit('\\",\\"x\\":1)'))
    return frame.withColumn("payload", F.concat(F.lit("<script>"), item(F.coalesce("title", F.lit(""))), item(F.coalesce("organization", F.lit(""))), F.lit("</script>")))


@query("select rec_id, '/notice/' || rec_id id, title from (select rec_id, language, unnest([coalesce(title, ''), coalesce(organization, '')]) title from parsers) where title <> '' and language = 'en'")
def embedded_list(spark, folder):
    fields = {"id": r'\\"id\\":\\"([^"\\]+)', "title": r'\\"title\\":\\"(.*?)\\",\\"'}
    rows = _payload(read(spark, folder, "parsers"), "rec_id")
    found = pages.embedded_records(F.col("payload"), '\\"id\\":\\"', fields, ["id", "title"], '\\"kind\\":\\"en\\"')
    return rows.select("rec_id", F.explode(found).alias("r")).select("rec_id", "r.id", "r.title")


@query(f"select rec_id, 'doc?docCode=' || rec_id as href, trim(regexp_replace(coalesce(title, ''), '{_WS}', ' ', 'g')) title, '5 Jul 2026' as found from site_adapters")
def link_cards(spark, folder):
    """Cards around links: the title of each website article in a card of its own, beside a link outside of any."""
    title = text.html_escaped(F.coalesce("title", F.lit("")))
    card = F.concat(F.lit('<div><section><h3><b><a href="doc?docCode='), F.col("rec_id").cast("string"), F.lit('">'), title, F.lit("</a></b></h3><p>Published 5 Jul 2026</p></section><i>Category x</i></div>"))
    page = F.concat(F.lit('<body><a href="doc?docCode=0">Published</a></body><main>'), card, F.lit("</main>"))
    found = pages.cards(F.concat(F.lit("<html>"), page, F.lit("</html>")), r"docCode=[1-9]|docCode=0$", ["Published", "Category"], r"Published (\d+ [A-Z][a-z]{2} 20\d\d)")
    rows = read(spark, folder, "site_adapters").select("rec_id", F.explode(found).alias("c"))
    return rows.where((F.col("c.href") != "doc?docCode=0") | (F.col("rec_id") == 0)).select("rec_id", "c.href", "c.title", "c.found").distinct()


@query(r"select rec_id, case when regexp_matches(url, '(?i)[?&]id=\d+') then 'https://stable.example/notice/' || regexp_extract(url, '(?i)[?&]id=(\d+)', 1) end address from parsers where url is not null")
def stable_addresses(spark, folder):
    return read(spark, folder, "parsers").where("url is not null").select("rec_id", pages.stable_address(F.col("url"), "id", "https://stable.example/notice/").alias("address"))


@query("select rec_id, case source_type when 'regulator' then upper(coalesce(title, '')) when 'media' then coalesce(organization, '') else coalesce(title, '') end label, case when source_type in ('regulator', 'media') then source_type else 'generic' end parser from parsers")
def parser_dispatch(spark, folder):
    label = lambda c: lambda f: f.select("rec_id", c.alias("label"))
    plain = F.coalesce("title", F.lit(""))
    return pages.dispatch(read(spark, folder, "parsers"), "source_type", {"regulator": label(F.upper(plain)), "media": label(F.coalesce("organization", F.lit(""))), "company": None}, label(plain))


@query(
    "with a as (select source_name report, title, image_urls refs from scripts where source_name is not null), t as (select report, lower(trim(coalesce(title, ''))) t, count(*) n, count(*) filter (where coalesce(len(refs), 0) = 0) bare from a group by all),"
    " c as (select report, sum(n) n, count(*) filter (where n > 1 or t = '') rep, sum(bare) bare from t group by 1), k as (select distinct image_urls[1] r from scripts where len(image_urls) > 0),"
    " r as (select report, x, count(*) n from (select report, unnest(refs) x from a) group by all), d as (select report, count(*) filter (where x not in (select r from k where r is not null)) unk, count(*) filter (where n > 1) again from r group by 1)"
    " select report, array_to_string(list_sort(list_filter([case when n <> 10 then 'actions' end, case when rep > 0 then 'repeated title' end, case when bare > 0 then 'no evidence' end, case when unk > 0 then 'unknown evidence' end, case when again > 0 then 'evidence cited twice' end], lambda x: x is not null)), '|') errors from c left join d using (report)"
)
def report_check(spark, folder):
    rows = read(spark, folder, "scripts").select("source_name", "title", "image_urls")
    known = rows.where(F.size("image_urls") > 0).select(F.col("image_urls")[0].alias("ref"))
    errors = prompts.report_errors(rows.where("source_name is not null").withColumnRenamed("source_name", "report"), known, "report", "title", "image_urls", "ref")
    return errors.select("report", F.array_join("errors", "|").alias("errors"))


@query(
    _LEDGER + ", i as (select distinct key from e where coalesce(collected_at, '') >= '2026') select b.key ledger_key, m.r rec_id, (-m.s)::int score, n merged_rows from b where exists (select 1 from i where i.key is not distinct from b.key)"
)
def issue_merge(spark, folder):
    """The master of older records with an issue of later ones merged in, and the events of the issue."""
    key = F.coalesce(text.blank_to_null(F.trim("url")), F.col("article_id"))
    rows = regional(spark, folder).select(F.coalesce("published_date", F.lit("")).alias("p"), F.coalesce("article_id", F.lit("")).alias("a"), key.alias("key"), "rec_id", "score", "relevance", F.array("source_id").alias("labels"), (F.coalesce("collected_at", F.lit("")) >= "2026").alias("late"))
    ledger = lambda f: records.event_ledger(f.drop("late"), F.col("key"), F.col("score"), "p", "a", "relevance", "labels").drop("key")
    merged, issue = records.merge_issue(ledger(rows.where("not late")), ledger(rows.where("late")), "ledger_key", "score", "p", "a", "relevance", "labels")
    return issue.select("ledger_key", "rec_id", "score", "merged_rows")


@query("with c as (select rec_id, source_name, row_number() over (partition by source_name order by rec_id) n, case when source_priority = 'high' then null when source_priority = 'low' then 3 else 40 end cap from scripts) select rec_id from c where n <= coalesce(least(cap, 25), 25)")
def capped_sources(spark, folder):
    """The cap of a run and that of a source, the lesser counts; no cap is null or 0."""
    own = F.when(F.col("source_priority") == "high", 0).when(F.col("source_priority") == "low", 3).otherwise(40)
    return records.capped(read(spark, folder, "scripts").select("rec_id", "source_name", "source_priority"), "source_name", [F.col("rec_id")], records.effective_cap(F.lit(25), own)).select("rec_id")


@query(
    "select rec_id, substr(sha1(coalesce(link, '')), 1, 16) short_id, replace(coalesce(content_html, ''), '</', '<\\/') = coalesce(content_html, '') same, length(replace(coalesce(content_html, ''), '</', '<\\/'))::int n,"
    " coalesce(nullif(array_to_string(list_filter(t, lambda x, i: list_position(t, x) = i)[1:2], '、'), ''), case when trim(title) <> '' then title end, '') label from (select *, list_filter(list_transform(coalesce(source_tags, []), lambda x: trim(x)), lambda x: x <> '') t from scripts)"
)
def ids_and_labels(spark, folder):
    page = text.json_in_page(F.coalesce("content_html", F.lit("")))
    return read(spark, folder, "scripts").select(
        "rec_id", F.substring(F.sha1(F.coalesce("link", F.lit(""))), 1, 16).alias("short_id"), (page == F.coalesce("content_html", F.lit(""))).alias("same"), F.length(page).alias("n"),
        text.first_present_list(F.col("source_tags"), F.col("title"), 2).alias("label"),
    )


@query("select rec_id, coalesce(title, '') || chr(10) || 'text' as section, '[\"' || rec_id || '\", 2]' as list from update_llm_ready where title is null or not contains(title, chr(10))")
def sections_and_lists(spark, folder):
    rows = read(spark, folder, "update_llm_ready").where("title is null or not contains(title, '\n')")
    title = F.coalesce("title", F.lit(""))
    document = F.concat(F.lit("# a\n\n## First\nx "), F.lit("\n\n## Second part\n|"), title, F.lit("\ntext|\n\n## Third\n[y]"))
    answer = F.concat(F.lit('Here: ```json\n["'), F.col("rec_id").cast("string"), F.lit('", 2]\n```'))
    cut = text.section_of(document, "Second part")
    return rows.select("rec_id", F.substring(cut, F.lit(2), F.length(cut) - 2).alias("section"), text.json_list(answer).alias("list"))


@query("select rec_id, (length(coalesce(title, '')) % 21)::int relevance, 'v2' as version from site_adapters")
def resumable_analysis(spark, folder):
    """Answers in parts, stopped after the first version's failures and started again."""
    ensure_checkpoint_dir(spark)
    out = f"{spark.sparkContext.getCheckpointDir()}/answers-{uuid.uuid4().hex}"
    rows = read(spark, folder, "site_adapters").select("rec_id", "title", "body")
    work = lambda call: analysis.analyse_in_parts(rows, call, "rec_id bigint, relevance int", "v2", "rec_id", out, parts=2, retries=1, pause=0.0)
    work(analysis.Flaky(analysis.offline_answers))
    return work(analysis.offline_answers).select("rec_id", "relevance", "version")
