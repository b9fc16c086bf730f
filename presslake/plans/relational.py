"""Filters, joins, roll-ups, ranking, de-duplication and ledger queries of the core."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from presslake.functions import dates, text, urls
from presslake.operators import records, reports, rules
from presslake.plans.queries import _KEY_A, _SQUEEZE, _address_sql, query, read

# collected_at has one notation in every row; a day of it is the date of a record.
_DAY = "try_cast(substr(collected_at, 1, 10) as date)"
_SCORE = "(length(coalesce(body, '')) % 21)::int"
_REL = "(case source_type when 'regulator' then 'none' when 'media' then 'direct_customer' when 'company' then 'competitor' when 'press' then 'industry_only' end)"


def regional(spark, folder):
    """Regional records with a day, a score and a relevance derived from their columns."""
    kind = F.col("source_type")
    return read(spark, folder, "parsers").withColumns(
        {
            "day": dates.iso_prefix(F.col("collected_at")), "score": (F.length(F.coalesce("body", F.lit(""))) % 21).cast("int"),
            "relevance": F.when(kind == "regulator", "none").when(kind == "media", "direct_customer").when(kind == "company", "competitor").when(kind == "press", "industry_only"),
        }
    )


_R = f"with r as (select *, {_DAY} d, {_SCORE} score, {_REL} relevance from parsers)"


# --- filters -----------------------------------------------------------------------------


@query(_R + " select rec_id, d as day from r where d between date '2025-01-01' and date '2025-06-30'")
def date_range(spark, folder):
    return regional(spark, folder).where(F.col("day").between("2025-01-01", "2025-06-30")).select("rec_id", "day")


@query(_R + " select rec_id, year(d)::int y, month(d)::int m from r where d >= date '2026-07-01' and d < date '2026-08-01'")
def half_open_month(spark, folder):
    rows = regional(spark, folder).where((F.col("day") >= "2026-07-01") & (F.col("day") < dates.issue_end(F.lit("2026-07"))))
    return rows.select("rec_id", F.year("day").alias("y"), F.month("day").alias("m"))


@query(
    "with g as (select rec_id, source_id, case when trim(coalesce(published_date, '')) = '' then null else coalesce(regexp_matches(published_date, '2026'), false) end gate from parsers),"
    " k as (select *, row_number() over (partition by source_id, gate is null order by rec_id) n from g) select rec_id, coalesce(gate::varchar, 'unknown') gate from k where gate or (gate is null and n <= 2)"
)
def tri_state_gate(spark, folder):
    """True, false or unknown; unknowns pass up to two per source."""
    p = F.col("published_date")
    gate = F.when(F.trim(F.coalesce(p, F.lit(""))) == "", F.lit(None)).otherwise(p.rlike("2026"))
    rows = read(spark, folder, "parsers").select("rec_id", "source_id", gate.alias("gate"))
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy("rec_id"))
    unknown = rows.where("gate is null").withColumn("n", rank).where("n <= 2").drop("n")  # the cap is the operator: few unknowns are looked at
    return rows.where("gate").unionByName(unknown).select("rec_id", F.coalesce(F.col("gate").cast("string"), F.lit("unknown")).alias("gate"))


_INCLUDE, _EXCLUDE = ["tender", "contract", "licence", "采购", "招标"], ["delayed", "推迟"]


@query(
    "with t as (select rec_id, lower(coalesce(title, '') || ' ' || coalesce(body, '')) x from parsers) select rec_id from t where ("
    + " or ".join(f"contains(x, '{t}')" for t in _INCLUDE) + ") and not (" + " or ".join(f"contains(x, '{t}')" for t in _EXCLUDE) + ")"
)
def include_exclude(spark, folder):
    x = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))))
    has = lambda terms: F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(x, t))
    return read(spark, folder, "parsers").where(has(_INCLUDE) & ~has(_EXCLUDE)).select("rec_id")


@query(_R + f" select rec_id, case when scrape_status = 'success' and length({_SQUEEZE('body')}) < 80 then 'failed' else scrape_status end status, length({_SQUEEZE('body')}) >= 80 and d is not null and lower({_SQUEEZE('title')}) not in ('', 'news', 'home') as valid from r")
def record_valid(spark, folder):
    n, title = F.length(text.squeeze(F.col("body"))), F.lower(text.squeeze(F.col("title")))
    rows = regional(spark, folder)
    status = F.when((F.col("scrape_status") == "success") & (n < 80), "failed").otherwise(F.col("scrape_status"))
    return rows.select("rec_id", status.alias("status"), ((n >= 80) & F.col("day").isNotNull() & ~title.isin("", "news", "home")).alias("valid"))


@query("select rec_id, source_category from scripts where trim(source_category) in ('pharma', 'medical_device') and list_contains(source_tags, 'tender') and length(trim(coalesce(content_text, ''))) >= 200")
def category_and_tag(spark, folder):
    rows = read(spark, folder, "scripts").where(F.trim("source_category").isin("pharma", "medical_device") & F.array_contains("source_tags", "tender"))
    return rows.where(F.length(F.trim(F.coalesce("content_text", F.lit("")))) >= 200).select("rec_id", "source_category")


@query("select rec_id, regexp_matches(coalesce(title, ''), '[\\x{3400}-\\x{9fff}\\x{f900}-\\x{faff}]') has_han, regexp_matches(coalesce(body, ''), '[\\x{3400}-\\x{9fff}\\x{f900}-\\x{faff}]') body_han from parsers")
def language_checks(spark, folder):
    return read(spark, folder, "parsers").select("rec_id", text.has_han(F.coalesce("title", F.lit(""))).alias("has_han"), text.has_han(F.coalesce("body", F.lit(""))).alias("body_han"))


@query(_R + " select rec_id, d as day from r where (d is null or d < date '2026-01-01') and coalesce(relevance, 'industry_only') <> 'none'")
def issue_cutoff(spark, folder):
    rows = regional(spark, folder).where(F.col("day").isNull() | (F.col("day") < dates.issue_end(F.lit("2025-12"))))
    return rows.where(F.coalesce("relevance", F.lit("industry_only")) != "none").select("rec_id", "day")


@query(
    "select rec_id, regexp_extract(url, '^[a-z]+://([^/]*)', 1) in (select host from source_registry union all select 'www.' || host from source_registry) known_host, regexp_matches(url, '/notice/\\d+') shaped from parsers where url is not null"
)
def url_filters(spark, folder):
    hosts = read(spark, folder, "source_registry").select(F.explode(F.array("host", F.concat(F.lit("www."), "host"))).alias("h")).distinct().withColumn("known", F.lit(True))
    rows = read(spark, folder, "parsers").where("url is not null").withColumn("h", urls.host(F.col("url")))
    return rows.join(hosts, "h", "left").select("rec_id", F.coalesce("known", F.lit(False)).alias("known_host"), F.col("url").rlike(r"/notice/\d+").alias("shaped"))


# --- joins -------------------------------------------------------------------------------


@query("select s.rec_id, coalesce(g.category, s.source_category) source_category, g.country, g.source_name is not null as known from scripts s left join source_registry g using (source_name)")
def registry_sync(spark, folder):
    registry = read(spark, folder, "source_registry").withColumnRenamed("category", "source_category")
    return records.refresh_from(read(spark, folder, "scripts"), registry, "source_name", ["source_category", "country"]).select("rec_id", "source_category", "country", "known")


@query(
    "with i as (select article_id, max_by(rec_id, rec_id) v from scripts where trim(article_id) <> '' group by 1), l as (select link, max(rec_id) v from scripts where trim(link) <> '' group by 1),"
    " t as (select title, source_name, published, max(rec_id) v from scripts where trim(title) <> '' and trim(source_name) <> '' and trim(published) <> '' group by all)"
    " select u.rec_id, coalesce(i.v, l.v, t.v) script_rec, (case when i.v is not null then 1 when l.v is not null then 2 when t.v is not null then 3 end)::int step from update_llm_ready u left join i using (article_id) left join l using (link) left join t using (title, source_name, published)"
)
def fallback_lookup(spark, folder):
    table = read(spark, folder, "scripts").withColumn("script_rec", F.col("rec_id"))
    steps = [["article_id"], ["link"], ["title", "source_name", "published"]]
    rows = records.cascaded_lookup(read(spark, folder, "update_llm_ready"), table, steps, "script_rec", "rec_id")
    return rows.select("rec_id", "script_rec", F.col("lookup_step").alias("step"))


@query("select rec_id from scripts where article_id in (select article_id from update_llm_ready where article_id is not null)")
def semi_selected(spark, folder):
    return read(spark, folder, "scripts").join(read(spark, folder, "update_llm_ready").select("article_id"), "article_id", "left_semi").select("rec_id")


@query("select rec_id from scripts where article_id is null or article_id not in (select article_id from update_llm_ready where data_quality_score >= 60 and article_id is not null)")
def anti_pending(spark, folder):
    done = read(spark, folder, "update_llm_ready").withColumn("version", F.when(F.col("data_quality_score") >= 60, "v2").otherwise("v1"))
    return records.pending(read(spark, folder, "scripts"), done, "article_id", "v2").select("rec_id")


@query(
    "with s as (select distinct link from scripts where batch_no = 0 and link is not null), n as (select * from scripts where batch_no > 0 and link is not null and link not in (select link from s)) select min(rec_id) rec_id from n group by link"
)
def anti_seen(spark, folder):
    rows = read(spark, folder, "scripts").where("link is not null").select("rec_id", "batch_no", "link")
    return records.unseen(rows.where("batch_no > 0"), rows.where("batch_no = 0"), "link", [F.col("rec_id")]).select("rec_id")


@query(
    "with c as (select rec_id, url, row_number() over (partition by source_id order by rec_id) n from parsers), k as (select distinct url from parsers where collected_at < '2026' and url is not null) select rec_id from c where n <= 5 and (url is null or url not in (select url from k))"
)
def cap_then_anti(spark, folder):
    rows = read(spark, folder, "parsers").select("rec_id", "source_id", "url", "collected_at")
    return records.cap_then_unseen(rows, rows.where("collected_at < '2026'"), "url", "source_id", [F.col("rec_id")], 5).select("rec_id")


@query("select a.rec_id, g.host, a.published from scripts a join source_registry g on a.source_name = g.source_name where a.batch_no between 1 and 3")
def sql_join(spark, folder):
    read(spark, folder, "scripts").createOrReplaceTempView("presslake_articles")
    read(spark, folder, "source_registry").createOrReplaceTempView("presslake_feeds")
    return spark.sql("select a.rec_id, g.host, a.published from presslake_articles a join presslake_feeds g on a.source_name = g.source_name where a.batch_no between 1 and 3")


@query(
    "with m as (select s.source_name, (s.link in (select link from update_llm_ready where link is not null) and s.link is not null) or exists (select 1 from update_llm_ready u where u.source_name = s.source_name and u.title = s.title and u.published = s.published) as matched, s.fetch_status from scripts s where s.source_name is not null)"
    " select source_name, count(*) collected, count(*) filter (where matched) covered, count(*) filter (where not matched) missing, count(*) filter (where fetch_status = 'failed') failed from m group by 1"
)
def coverage_audit(spark, folder):
    ready = read(spark, folder, "update_llm_ready").select("link", "source_name", "title", "published")
    rows = records.either_match(read(spark, folder, "scripts").where("source_name is not null"), ready, [["link"], ["source_name", "title", "published"]])
    return rows.groupBy("source_name").agg(F.count(F.lit(1)).alias("collected"), F.count_if("matched").alias("covered"), F.count_if(~F.col("matched")).alias("missing"), F.count_if(F.col("fetch_status") == "failed").alias("failed"))


_PHRASES = ["stent", "high-barrier", "battery", "召回", "tender", "tubing"]


@query(
    "with p as (select unnest([" + ", ".join(f"'{p}'" for p in _PHRASES) + f"]) phrase), a as (select rec_id, lower({_SQUEEZE("concat_ws(' ', title, body)")}) t from parsers)"
    " select rec_id, phrase from a join p on case when regexp_full_match(phrase, '[a-z0-9]+') then regexp_matches(t, '(?:^|[^\\p{L}\\p{N}_])' || phrase || '(?:$|[^\\p{L}\\p{N}_])') else contains(t, phrase) end"
)
def keyword_theta(spark, folder):
    phrases = spark.createDataFrame([(p,) for p in _PHRASES], "phrase string")
    return rules.phrase_join(read(spark, folder, "parsers"), phrases, rules.text_of("title", "body")).select("rec_id", "phrase")


_WEEKS = "w as (select (i + 1)::int week_no, date '2026-07-01' + (7 * i)::int s, least(date '2026-07-01' + (7 * i + 6)::int, date '2026-07-31') e from range(5) t(i))"


@query(_R + f", {_WEEKS} select rec_id, week_no from r join w on d between s and e")
def week_interval_join(spark, folder):
    """Weeks of a month by arithmetic instead of a range join; the last is clipped."""
    rows = reports.with_week(regional(spark, folder).where(F.col("day").between("2026-07-01", "2026-07-31")), "day", "2026-07-01")
    return rows.select("rec_id", "week_no")


@query("with e as (select distinct p.organization s, p.source_name t from parsers p), k as (select distinct source_name from scripts) select distinct t entity from e where t in (select source_name from k where source_name is not null) and t not in (select s from e where s is not null)")
def entity_expand(spark, folder):
    edges = read(spark, folder, "parsers").select(F.col("organization").alias("s"), F.col("source_name").alias("t"))
    known = read(spark, folder, "scripts").select(F.col("source_name").alias("entity"))
    return records.expand_edges(edges, known, "s", "t", "entity")


@query("with x as (select unnest(image_urls) u from scripts), c as (select u, count(*) uses from x group by 1) select u ref, uses, u in (select image_urls[1] from scripts where len(image_urls) > 0) known from c")
def evidence_integrity(spark, folder):
    rows = read(spark, folder, "scripts")
    known = rows.where(F.size("image_urls") > 0).select(F.col("image_urls")[0].alias("ref"))
    return records.reference_check(rows, "image_urls", known, "ref")


# --- roll-ups -----------------------------------------------------------------------------


@query("select source_name, country, count(*) records, count(*) filter (where scrape_status = 'success') success, count(*) filter (where scrape_status is distinct from 'success') failed, max(substr(collected_at, 1, 10)) latest from parsers group by all")
def source_rollup(spark, folder):
    rows = read(spark, folder, "parsers").withColumn("day", F.substring("collected_at", 1, 10))
    return reports.source_rollup(rows, ["source_name", "country"], "scrape_status", "day")


_SUFFIX = ["Devices", "Medical", "Labs", "Packaging", "Biologics", "Surgical", "Therapeutics", "Diagnostics", "Care", "Systems"]
_COMPANIES = (
    rf"with u as (select *, {_SCORE} score, {_DAY} d, unnest(regexp_extract_all(coalesce(title, ''), '(?:^|[^\p{{L}}\p{{N}}_])(\p{{Lu}}[^\s.,;:!?]*(?: +\p{{Lu}}[^\s.,;:!?]*)*)', 1)) run from parsers),"
    " w as (select *, string_split_regex(run, ' +') w from u), e as (select *, list_max([i for i in range(1, len(w) + 1) if list_contains([" + ", ".join(f"'{x}'" for x in _SUFFIX) + "], w[i])]) e from w),"
    " c as (select distinct rec_id, country, source_type, title, score, d, lower(array_to_string(w[greatest(1, e - 6):e], ' ')) company_key from e where e > 1)"
)


def _company_rows(spark, folder):
    names = text.company_names(F.coalesce("title", F.lit("")), F.lit(None).cast("string"), [], _SUFFIX, [])
    return regional(spark, folder).withColumn("companies", names)


@query(_COMPANIES + " select company_key, country, string_agg(distinct source_type, ', ' order by source_type) kinds, count(*) mentions, count(distinct title) titles, max(score) max_score, max(d) latest from c group by all")
def company_rollup(spark, folder):
    return reports.company_rollup(_company_rows(spark, folder), "companies", "country", "source_type", "title", "score", "day")


@query(_COMPANIES + " select company_key, country, title, min(rec_id) first_rec, count(*) mentions from c group by all")
def company_titles(spark, folder):
    return reports.company_titles(_company_rows(spark, folder), "companies", "country", "title", "rec_id").withColumnRenamed("first_order", "first_rec")


@query("select coalesce(nullif(trim(source_category), ''), 'unknown') category, count(*) n from scripts group by 1")
def category_frequency(spark, folder):
    rows = read(spark, folder, "scripts").select(F.coalesce(text.blank_to_null(F.col("source_category")), F.lit("unknown")).alias("category"))
    return reports.frequency(rows, "category")


@query("select tag, count(*) n from (select unnest(case when len(source_tags) > 0 then source_tags else ['untagged'] end) tag from scripts) group by 1")
def tag_frequency(spark, folder):
    return reports.exploded_frequency(read(spark, folder, "scripts"), "source_tags", "untagged", "tag")


@query(_R + f", {_WEEKS} select week_no, count(rec_id) n from w left join r on d between s and date '2026-07-01' + (7 * (week_no - 1) + 6)::int group by 1")
def week_counts(spark, folder):
    return reports.week_counts(regional(spark, folder), "day", "2026-07-01", 5)


_SECTIONS = {"safety": ["tender", "policy"], "market": ["pharma"], "products": ["device", "packaging"]}


@query(
    "with s as (select rec_id, unnest(case when len(h) > 0 then h else ['other'] end) section from (select rec_id, list_filter([" + ", ".join(f"case when list_has_any(source_tags, {cs}) then '{s}' end" for s, cs in _SECTIONS.items()) + "], lambda x: x is not null) h from scripts))"
    " select k.section, count(s.rec_id) n from (select unnest(['safety', 'market', 'products', 'other', 'empty']) section) k left join s using (section) group by 1"
)
def section_counts(spark, folder):
    rows = reports.sections(read(spark, folder, "scripts"), "source_tags", _SECTIONS, "other")
    keys = spark.createDataFrame([(s,) for s in [*_SECTIONS, "other", "empty"]], "section string")
    return reports.zero_kept(reports.frequency(rows, "section"), keys, "section")


@query("select source_name, count(*) articles, count(*) filter (where has_full_text) full_text, count(*) filter (where has_image_ocr) with_ocr, count(*) filter (where data_quality_score >= 60) good, sum(word_count)::bigint words from update_llm_ready group by 1")
def quality_totals(spark, folder):
    return read(spark, folder, "update_llm_ready").groupBy("source_name").agg(
        F.count(F.lit(1)).alias("articles"), F.count_if("has_full_text").alias("full_text"), F.count_if("has_image_ocr").alias("with_ocr"), F.count_if(F.col("data_quality_score") >= 60).alias("good"), F.sum("word_count").alias("words")
    )


@query("select *, row_number() over (order by o_custkey, o_orderpriority) serial from (select o_custkey, o_orderpriority, count(*) n, max(l_quantity) most from orders join lineitem on o_orderkey = l_orderkey where o_orderstatus = 'F' group by all)")
def award_explode(spark, folder):
    """Nested rows of a record exploded, counted and numbered in order."""
    nested = read(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_quantity")).alias("awards"))  # at most seven lines an order
    rows = read(spark, folder, "orders").where("o_orderstatus = 'F'").join(nested, F.col("o_orderkey") == F.col("l_orderkey"))
    rows = rows.select("o_custkey", "o_orderpriority", F.explode("awards").alias("a")).groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.max("a.l_quantity").alias("most"))
    return reports.chunked(rows, [F.col("o_custkey"), F.col("o_orderpriority")], 1000).drop("chunk_no").withColumnRenamed("row_no", "serial")


# --- ranking -------------------------------------------------------------------------------


@query(_R + " select rec_id, (row_number() over (order by score desc, d desc nulls last, rec_id))::int as rank from r order by score desc, d desc nulls last, rec_id limit 10")
def top10_ranked(spark, folder):
    order = [F.col("score").desc(), F.col("day").desc_nulls_last(), F.col("rec_id")]
    return reports.ranked(regional(spark, folder), order, 10).select("rec_id", "rank")


@query(_R + " select rec_id, week_no, rank::int as rank from (select rec_id, (d - date '2026-07-01') // 7 + 1 as week_no, row_number() over (partition by (d - date '2026-07-01') // 7 order by score desc, rec_id) as rank from r where d between date '2026-07-01' and date '2026-07-31') where rank <= 4".replace("(d - date '2026-07-01') // 7 + 1", "((d - date '2026-07-01') // 7 + 1)::int"))
def top4_per_week(spark, folder):
    rows = reports.with_week(regional(spark, folder).where(F.col("day").between("2026-07-01", "2026-07-31")), "day", "2026-07-01")
    return reports.top_per_group(rows, ["week_no"], [F.col("score").desc(), F.col("rec_id")], 4).select("rec_id", "week_no", "rank")


@query("select event_id, user_id, rank::int as rank from (select event_id, user_id, row_number() over (partition by user_id order by value desc, event_id) as rank from events) where rank <= 3")
def topk_per_entity(spark, folder):
    return reports.top_per_group(read(spark, folder, "events"), ["user_id"], [F.col("value").desc(), F.col("event_id")], 3).select("event_id", "user_id", "rank")


@query("with o as (select rec_id, ((row_number() over (order by case source_priority when 'high' then 0 when 'medium' then 1 when 'low' then 2 else 3 end, published desc nulls last, rec_id)) - 1) as n from scripts) select rec_id, (n + 1)::bigint row_no, (n // 20 + 1)::bigint chunk_no from o")
def chunked_batches(spark, folder):
    level = F.when(F.col("source_priority") == "high", 0).when(F.col("source_priority") == "medium", 1).when(F.col("source_priority") == "low", 2).otherwise(3)
    rows = read(spark, folder, "scripts").select("rec_id", "published", level.alias("level"))
    return reports.chunked(rows, [F.col("level"), F.col("published").desc_nulls_last(), F.col("rec_id")], 20).select("rec_id", "row_no", "chunk_no")


@query(_R + " select rec_id, (case when day(d) <= 4 then 1 else (day(d) - 5) // 7 + 2 end)::int month_week from r where d is not null")
def irregular_weeks(spark, folder):
    return reports.with_week(regional(spark, folder).where("day is not null"), "day", "2026-01-01").select("rec_id", "month_week")


@query(_R + " select source_id, country, max(d) latest, count(*) filter (where score >= 18) top_scores, min(score)::int least_score from r group by all")
def latest_per_group(spark, folder):
    return regional(spark, folder).groupBy("source_id", "country").agg(F.max("day").alias("latest"), F.count_if(F.col("score") >= 18).alias("top_scores"), F.min("score").alias("least_score"))


# --- derived columns -----------------------------------------------------------------------


@query("select rec_id, (case when length(coalesce(main_text, '')) = 0 then least(30, x) else least(100, x) end)::int quality, case when length(coalesce(main_text, '')) = 0 then 'none' when length(main_text) < 500 then 'short' when coalesce(image_ocr_text, '') <> '' then 'full_ocr' else 'full' end note from (select *, case when fetch_status = 'success' then 40 else 0 end + case when length(coalesce(main_text, '')) > 1000 then 40 when length(coalesce(main_text, '')) >= 500 then 25 else 0 end + case when coalesce(image_ocr_text, '') <> '' then 10 else 0 end + case when len(image_urls) > 0 then 5 else 0 end x from update_llm_ready)")
def quality_score(spark, folder):
    n, ocr = F.length(F.coalesce("main_text", F.lit(""))), F.coalesce("image_ocr_text", F.lit("")) != ""
    yes = lambda cond, points: F.when(cond, points).otherwise(0)
    size = F.when(n > 1000, 40).when(n >= 500, 25).otherwise(0)
    score = yes(F.col("fetch_status") == "success", 40) + size + yes(ocr, 10) + yes(F.size("image_urls") > 0, 5)
    note = F.when(n == 0, "none").when(n < 500, "short").when(ocr, "full_ocr").otherwise("full")
    return read(spark, folder, "update_llm_ready").select("rec_id", F.least(score, F.when(n == 0, 30).otherwise(100)).alias("quality"), note.alias("note"))


@query(
    _R + f", b as (select rec_id, {_SQUEEZE('body')} t, url, source_id, article_id from r), h as (select *, substr(t, 1, 160) p from b) select rec_id, case when length(t) <= 160 then t else regexp_replace(case when contains(p, ' ') then regexp_extract(p, '(?s)^(.*) ', 1) else p end, '[ ,;:]+$', '') || '...' end snippet,"
    " case when length(t) > 120 then substr(t, 1, 117) || '...' else t end cut, source_id || '_' || substr(sha256(source_id || '|' || replace(coalesce(url, ''), ' ', '')), 1, 20) stable_id, coalesce(nullif(trim(article_id), ''), 'x_' || substr(sha256(coalesce(url, '')), 1, 16)) identity from h"
)
def snippets_and_ids(spark, folder):
    url = F.coalesce("url", F.lit(""))
    stable = F.concat(F.col("source_id"), F.lit("_"), F.substring(F.sha2(F.concat_ws("|", "source_id", F.replace(url, F.lit(" "), F.lit(""))), 256), 1, 20))
    identity = F.coalesce(text.blank_to_null(F.trim("article_id")), F.concat(F.lit("x_"), F.substring(F.sha2(url, 256), 1, 16)))
    rows = regional(spark, folder)
    return rows.select("rec_id", text.snippet(F.col("body"), 160).alias("snippet"), text.cut_text(text.squeeze(F.col("body")), 120).alias("cut"), stable.alias("stable_id"), identity.alias("identity"))


@query(_R + " select rec_id, coalesce(case when score >= 18 then true when score <= 11 then false end, language = 'en', false) include, case when score < 10 then '' else coalesce(title, '') end detail, case when score >= 16 then 'high' when score >= 12 then 'medium' else 'low' end band, least(15, greatest(5, score))::int clamped from r")
def score_bands(spark, folder):
    score = F.col("score")
    return regional(spark, folder).select(
        "rec_id", rules.forced_flag(score, F.col("language") == "en", 18, 11).alias("include"), F.when(score < 10, "").otherwise(F.coalesce("title", F.lit(""))).alias("detail"),
        rules.bucket(score, [(16, "high"), (12, "medium")], "low").alias("band"), rules.clamp(score, 5, 15).alias("clamped"),
    )


@query("select event_id, try_cast(replace(trim(regexp_extract(props, ':\\s*\"?([0-9.,]+)', 1)), ',', '') as double) number, length(regexp_extract('Answer: ```json ' || props || ' ``` done', '(?s)\\{.*\\}', 0))::int json_length from events")
def json_from_text(spark, folder):
    answer = F.concat(F.lit("Answer: ```json "), "props", F.lit(" ``` done"))
    number = rules.tolerant_number(F.regexp_extract("props", r':\s*"?([0-9.,]+)', 1))
    return read(spark, folder, "events").select("event_id", number.alias("number"), F.length(text.json_object(answer)).alias("json_length"))


# --- de-duplication, upsert, ledger ----------------------------------------------------------


@query(
    _address_sql("parsers", "url", "body") + f", b as (select *, {_KEY_A} u, regexp_replace(lower({_SQUEEZE('body')}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g') c from k),"
    " f as (select *, min(rec_id) over (partition by u) fu, case when length(c) >= 80 then min(rec_id) over (partition by c) end fc from b)"
    " select rec_id, case when fu < rec_id then fu when fc < rec_id then fc end duplicate_of, case when fu < rec_id then 'exact_url' when fc < rec_id then 'exact_content' end duplicate_reason from f"
)
def dedup_exact(spark, folder):
    return records.exact_duplicates(read(spark, folder, "parsers"), "rec_id").select("rec_id", "duplicate_of", "duplicate_reason")


@query()
def dedup_fuzzy_titles(spark, folder):
    return records.similar_titles(read(spark, folder, "update_llm_ready").where("title is not null"), "rec_id", "title")


@query()
def dedup_winners(spark, folder):
    """Classes of duplicates with the best record: official, successful, longer, dated."""
    rows = regional(spark, folder)
    better = [F.col("source_type").isin("regulator", "government").cast("int"), F.startswith(F.coalesce("scrape_status", F.lit("")), F.lit("success")).cast("int"), F.length(F.coalesce("body", F.lit(""))), dates.precision(F.coalesce("published_date", F.lit("")))]
    return records.resolve_duplicates(rows, "rec_id", better).select("rec_id", "duplicate_of", "duplicate_reason")


@query("with b as (select rec_id, url, title, coalesce(collected_at >= '2026', false)::int age from parsers), k as (select url, max_by(rec_id, age * 1000000000 + rec_id) rec_id from b where trim(coalesce(url, '')) <> '' group by 1) select rec_id, url from k union all select rec_id, url from b where trim(coalesce(url, '')) = ''")
def upsert_by_url(spark, folder):
    rows = read(spark, folder, "parsers").select("rec_id", "url", "title", F.coalesce(F.col("collected_at") >= "2026", F.lit(False)).alias("new"))
    return records.upsert(rows.where("not new"), rows.where("new"), "url", "rec_id").select("rec_id", "url")


@query("select max(rec_id) rec_id, article_id from parsers group by article_id")
def last_wins(spark, folder):
    return records.keep_last(read(spark, folder, "parsers").select("rec_id", "article_id"), ["article_id"], [F.col("rec_id")])


@query("select min(rec_id) rec_id, k identity from (select rec_id, coalesce(nullif(trim(article_id), ''), nullif(trim(link), ''), coalesce(published, '') || '|' || coalesce(title, '')) k from scripts) group by k")
def keep_first_identity(spark, folder):
    k = F.coalesce(text.blank_to_null(F.trim("article_id")), text.blank_to_null(F.trim("link")), F.concat(F.coalesce("published", F.lit("")), F.lit("|"), F.coalesce("title", F.lit(""))))
    return records.keep_first(read(spark, folder, "scripts").select("rec_id", k.alias("identity")), ["identity"], [F.col("rec_id")])


@query("with n as (select * from parsers where country = 'SG' and collected_at >= '2026') select rec_id, source_id from parsers where source_id not in (select source_id from n) union all select rec_id, source_id from n")
def replace_sources(spark, folder):
    rows = read(spark, folder, "parsers").select("rec_id", "source_id", "country", "collected_at")
    return records.replace_sources(rows, rows.where("country = 'SG' and collected_at >= '2026'").drop("country", "collected_at"), "source_id").select("rec_id", "source_id")


_LEDGER = _R + ", e as (select *, coalesce(nullif(trim(url), ''), article_id) key from r where coalesce(relevance, 'industry_only') <> 'none'), b as (select key, min({'s': -score, 'p': coalesce(published_date, ''), 'a': coalesce(article_id, ''), 'r': rec_id, 'v': relevance}) m, count(*) n from e group by key)"


def ledger(spark, folder):
    rows = regional(spark, folder).select("rec_id", "url", "article_id", "score", "published_date", "relevance", F.array(F.col("source_id")).alias("labels"))
    key = F.coalesce(text.blank_to_null(F.trim("url")), F.col("article_id"))
    slim = rows.select(F.coalesce("published_date", F.lit("")).alias("p"), F.coalesce("article_id", F.lit("")).alias("a"), key.alias("key"), "rec_id", "score", "relevance", "labels")
    return slim, records.event_ledger(slim, F.col("key"), F.col("score"), "p", "a", "relevance", "labels")


@query(_LEDGER + ", l as (select key, list_sort(list_distinct(list(source_id))) s, count(*) n from e group by key) select b.key ledger_key, m.r rec_id, (-m.s)::int score, array_to_string(l.s, ',') labels, l.n merged_rows from b join l on b.key is not distinct from l.key")
def event_ledger(spark, folder):
    return ledger(spark, folder)[1].select("ledger_key", "rec_id", "score", F.array_join("labels", ",").alias("labels"), "merged_rows")


@query(_LEDGER + " select key ledger_key, rec_id member from e")
def ledger_members(spark, folder):
    """The rows behind each event: provenance as a table, so that a common key is no long array."""
    return records.ledger_members(ledger(spark, folder)[0], F.col("key"), "relevance", "rec_id")


@query(_LEDGER + " select (select count(*) from r) source_rows, (select count(*) from r where coalesce(relevance, 'industry_only') = 'none') excluded, (select count(*) from e) - count(*) as merged, count(*) events, count(*) filter (where m.v in ('direct_customer', 'competitor')) priority_events from b")
def ledger_counts(spark, folder):
    rows, events = ledger(spark, folder)
    return records.ledger_counts(rows, events, "relevance", ["direct_customer", "competitor"])


@query("select * from (select source_name from scripts where batch_no = 0 intersect select source_name from scripts where batch_no > 0)")
def source_intersection(spark, folder):
    rows = read(spark, folder, "scripts").select("batch_no", "source_name")
    return records.keys_in_both(rows.where("batch_no = 0"), rows.where("batch_no > 0"), "source_name")


@query("select article_id from scripts where batch_no = 0 and article_id is not null union select article_id from scripts where batch_no > 0 and article_id is not null")
def seen_union_all(spark, folder):
    """Keys of the history and of all batches after it."""
    rows = read(spark, folder, "scripts").select("batch_no", "article_id")
    return records.union_seen(rows.where("batch_no = 0"), rows.where("batch_no > 0"), "article_id")


_TAGS = "list_filter(list_transform(coalesce(source_tags, []), lambda x: trim(x)), lambda x: x <> '')"


@query(f"select rec_id, len({_TAGS}) = 0 as no_tags, array_to_string(list_sort(list_distinct({_TAGS})), ',') tags from scripts")
def list_dedup(spark, folder):
    tags = text.distinct_trimmed(F.col("source_tags"))
    return read(spark, folder, "scripts").select("rec_id", (F.size(tags) == 0).alias("no_tags"), F.array_join(F.array_sort(tags), ",").alias("tags"))
