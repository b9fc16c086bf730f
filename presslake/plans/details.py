"""Queries of finer operators: repairs, labels, orders, fallbacks, nested items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions import dates, html, text, urls
from presslake.operators import records, reports, rules
from presslake.plans.queries import _DATES, _MAIL, _SQUEEZE, _TIDY, _sql_found, query, read
from presslake.plans.relational import _R, regional


def with_fallback(live: DataFrame, snapshot: DataFrame, source: str) -> DataFrame:
    """Live rows, and rows of a snapshot for the sources without any live row."""
    return live.withColumn("origin", F.lit("live")).unionByName(snapshot.join(live.select(source).distinct(), source, "left_anti").withColumn("origin", F.lit("snapshot")))


@query(
    "with l as (select rec_id, source_id from parsers where collected_at >= '2026-09-20'), s as (select rec_id, source_id from parsers where collected_at < '2026-09-20')"
    " select rec_id, source_id, 'live' origin from l union all select rec_id, source_id, 'snapshot' from s where source_id not in (select source_id from l)"
)
def snapshot_fallback(spark, folder):
    rows = read(spark, folder, "parsers").select("rec_id", "source_id", (F.col("collected_at") >= "2026-09-20").alias("late"))
    return with_fallback(rows.where("late").drop("late"), rows.where("not late").drop("late"), "source_id")


def cdata_records(c: Column, tag: str) -> Column:
    """Contents of CDATA sections of all elements of a name."""
    return F.regexp_extract_all(c, F.lit(rf"(?s)<{tag}>\s*<!\[CDATA\[(.*?)\]\]>\s*</{tag}>"), F.lit(1))


@query("select rec_id, unnest([coalesce(title, ''), coalesce(url, '')]) record from site_adapters")
def cdata_scan(spark, folder):
    item = lambda c: F.concat(F.lit("<record><![CDATA["), F.coalesce(c, F.lit("")), F.lit("]]></record>"))
    document = F.concat(F.lit("<list>"), item(F.col("title")), F.lit("\n"), item(F.col("url")), F.lit("</list>"))
    return read(spark, folder, "site_adapters").select("rec_id", F.explode(cdata_records(document, "record")).alias("record"))


def report_filter(frame: DataFrame, country: str | None = None, category: str | None = None, words: str | None = None) -> DataFrame:
    """Rows for a reader: country contains, category equals, all words in title; each optional."""
    if country:
        frame = frame.where(F.contains(F.lower("country"), F.lit(country.lower())))
    if category:
        frame = frame.where(F.col("category") == category)
    for w in (words or "").lower().split():
        frame = frame.where(F.contains(F.lower("title"), F.lit(w)))
    return frame


@query("select s.rec_id from site_adapters s join source_registry g using (source_name) where contains(lower(g.country), 'g') and s.category = 'tender' and contains(lower(s.title), 'new')")
def reader_filter(spark, folder):
    registry = read(spark, folder, "source_registry").select("source_name", "country")
    return report_filter(read(spark, folder, "site_adapters").join(registry, "source_name"), "g", "tender", "NEW").select("rec_id")


@query(
    "select l_orderkey, count(*) filter (where l_quantity >= 10 and l_returnflag in ('A', 'R')) kept, count(*) filter (where l_quantity >= 10 and l_returnflag in ('A', 'R')) > 0 as valid, sum(case when l_quantity >= 10 and l_returnflag in ('A', 'R') then l_quantity end) total from lineitem group by 1"
)
def nested_items(spark, folder):
    """Nested items coerced and filtered in place; a record is valid if items survive."""
    items = read(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_quantity", "l_returnflag")).alias("items"))  # at most seven lines an order
    coerced = F.transform("items", lambda i: F.struct(i["l_quantity"].alias("quantity"), rules.one_of(i["l_returnflag"], ["A", "R"], "other").alias("status")))
    kept = F.filter(coerced, lambda i: (i["quantity"] >= 10) & (i["status"] != "other"))
    total = F.aggregate(kept, F.lit(None).cast("double"), lambda a, i: F.coalesce(a, F.lit(0.0)) + i["quantity"])
    return items.select("l_orderkey", F.size(kept).cast("bigint").alias("kept"), (F.size(kept) > 0).alias("valid"), total.alias("total"))


_LABELS = {"catheter": ["catheter", "stent"], "packaging": ["blister", "pouch", "sachet"], "liquid": ["vial", "ampoule", "syringe"]}


@query(
    f"with t as (select rec_id, lower({_SQUEEZE("concat_ws(' ', title, body)")}) x from parsers) select rec_id, array_to_string(list_filter(["
    + ", ".join("case when " + " or ".join("regexp_matches(x, '(?:^|[^\\p{L}\\p{N}_])" + v + "(?:$|[^\\p{L}\\p{N}_])')" for v in vs) + f" then '{k}' end" for k, vs in _LABELS.items())
    + "], lambda l: l is not null), ', ') labels from t"
)
def label_attributes(spark, folder):
    return read(spark, folder, "parsers").select("rec_id", F.array_join(text.labels_found(rules.text_of("title", "body"), _LABELS), ", ").alias("labels"))


_PRIORITY = ["tender", "policy", "pharma"]


@query("select rec_id, coalesce(list_filter(['tender', 'policy', 'pharma'], lambda p: list_contains(source_tags, p))[1], 'general') event_type, coalesce(list_min(list_filter(list_transform(source_tags, lambda t: list_position(['tender', 'policy', 'pharma'], t)), lambda i: i is not null and i > 0)), 99)::int rank from scripts")
def event_priority(spark, folder):
    tags = F.coalesce("source_tags", F.array().cast("array<string>"))
    place = F.array(*[F.lit(p) for p in _PRIORITY])
    rank = F.coalesce(F.array_min(F.filter(F.transform(tags, lambda t: F.array_position(place, t)), lambda i: i > 0)), F.lit(99)).cast("int")
    return read(spark, folder, "scripts").select("rec_id", reports.first_by_priority(tags, _PRIORITY, "general").alias("event_type"), rank.alias("rank"))


@query(_R + ", o as (select rec_id, country, row_number() over (partition by country order by case language when 'en' then score else 20 - score end desc, coalesce(published_date, ''), rec_id) as n from r) select rec_id, country, n::int place from o where n <= 5")
def mixed_orders(spark, folder):
    """The first five of each country; the key of the order depends on the kind of row."""
    key = F.when(F.col("language") == "en", F.col("score")).otherwise(20 - F.col("score"))
    return reports.top_per_group(regional(spark, folder), ["country"], [key.desc(), F.coalesce("published_date", F.lit("")), F.col("rec_id")], 5, "place").select("rec_id", "country", "place")


_ISSUE = r"case when regexp_matches(substr(collected_at, 1, 7), '^20\d{2}-(?:0[1-9]|1[0-2])$') then (try_cast(substr(collected_at, 1, 7) || '-01' as date) + interval 1 month)::date end"
_TIGHT = r"replace(regexp_replace(replace(coalesce(title, ''), chr(12288), ' '), '([，。；：（]) ', '\1', 'g'), ' ）', '）')"


@query(
    r"select rec_id, regexp_replace(coalesce(title, ''), '[\/:*?\x22<>|\s]+', '_', 'g') file, " + _ISSUE + f" issue_end, {_TIDY.replace("coalesce(content_text, '')", _TIGHT)} tight from parsers"
)
def text_repairs(spark, folder):
    title = F.coalesce("title", F.lit(""))
    rows = read(spark, folder, "parsers")
    return rows.select("rec_id", text.file_name(title).alias("file"), dates.issue_end(F.substring("collected_at", 1, 7)).alias("issue_end"), text.tight_punctuation(F.col("title")).alias("tight"))


@query()
def body_cleaning(spark, folder):
    """The whole cleaning of a website article: image notes, punctuation, leading title."""
    body = text.tight_punctuation(text.joined_letters(text.without_image_notes(F.col("body"))))
    rows = read(spark, folder, "site_adapters").withColumn("clean", text.without_leading_title(body, F.coalesce("title", F.lit(""))))
    status = F.when((F.col("status") == "success") & (F.length(F.trim("clean")) == 0), "failed").otherwise(F.col("status"))
    return rows.select("rec_id", F.length("clean").alias("n"), status.alias("status"))


_SHORT = r"(?i)^(\d{1,2}) ([a-z]+) (\d{4})$"


@query(
    _DATES + ", f as (select rec_id, any_date, trim(coalesce(p, '')) t, coalesce(p, '') p from e), m as (select *, coalesce(" + _sql_found("p", _MAIL, 3, 2, 1, True) + r", try_cast(regexp_extract(t, '^(\d{4}-\d{2}-\d{2})', 1) as date)) mail from f)"
    r" select rec_id, coalesce(case when regexp_matches(t, '^\d{4}-\d{2}-\d{2}$') then try_cast(t as date) end, " + _sql_found("t", _SHORT, 3, 2, 1, True) + ") report_date,"
    r" regexp_matches(p, '(?i)\b(?:\d+|an?) (?:minute|hour|day|week)s? ago\b|\b(?:yesterday|today|just now)\b|\d+\s*(?:分钟|小时|天|周)前|刚刚|昨天|今天|前天') relative,"
    r" case when regexp_matches(p, '\d{4}-\d\d-\d\d|\d{1,2}\s+[A-Za-z]+\s+\d{4}') then 3 when regexp_matches(p, '[A-Za-z]\s+\d{4}') then 2 when regexp_matches(p, '\d{4}') then 1 else 0 end::int date_precision,"
    r" coalesce(year(mail), try_cast(nullif(regexp_extract(p, '(?:^|[^0-9A-Za-z_])(20\d{2})(?:$|[^0-9A-Za-z_])', 1), '') as int))::int year_of from m"
)
def date_features(spark, folder):
    c = F.coalesce("published_date", F.lit(""))
    return read(spark, folder, "parsers").select("rec_id", dates.report_date(c).alias("report_date"), dates.is_relative(c).alias("relative"), dates.precision(c).cast("int").alias("date_precision"), dates.year_of(c).alias("year_of"))


@query(
    "with p as (select lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*:(?://)?([^/?#]*)', 1)) host, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*:(?://)?[^/?#]*([^?#]*)', 1)) pa from (select regexp_replace(url, '^\\s+|\\s+$', '', 'g') url from site_adapters where url is not null))"
    " select host, count(*) pages, count(*) filter (where regexp_matches(pa, '\\d{3,}|/20\\d{2}/|[a-z]+-[a-z]+-[a-z0-9]+|\\.s?html?$|/s/') and not regexp_matches(pa, '/(?:tag|category|search|login|page)/|\\.(?:jpg|png|gif|css|js|pdf)$|^/?$')) articles from p group by 1"
)
def article_links(spark, folder):
    rows = read(spark, folder, "site_adapters").where("url is not null")
    return rows.groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("pages"), F.count_if(urls.looks_like_article(F.col("url"))).alias("articles"))


@query("select rec_id, trim(regexp_extract('Standard: ' || coalesce(title, '') || ' Status: ' || coalesce(language, '') || ' End', '(?is)Status\\s*:?\\s*(.*?)\\s*End', 1)) status from parsers")
def labelled_fields(spark, folder):
    card = F.concat(F.lit("Standard: "), F.coalesce("title", F.lit("")), F.lit(" Status: "), F.coalesce("language", F.lit("")), F.lit(" End"))
    return read(spark, folder, "parsers").select("rec_id", html.labelled(card, "Status", "End").alias("status"))


@query("select user_id, event_type, ts, n::int n from (select user_id, event_type, ts, row_number() over (partition by user_id, event_type order by ts, event_id) n from events) where n = 1")
def first_occurrence(spark, folder):
    rows = read(spark, folder, "events").select("user_id", "event_type", "ts", "event_id")
    return records.keep_first(rows, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "ts", F.lit(1).alias("n"))


@query("select event_type, count(*) n, min(ts) first_seen, max(ts) last_seen, count(distinct user_id) users from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20' group by 1")
def windowed_events(spark, folder):
    rows = read(spark, folder, "events").where("ts >= timestamp_ntz '2024-01-05' and ts < timestamp_ntz '2024-01-20'")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.countDistinct("user_id").alias("users"))


@query("select c.c_custkey, n.n_name, r.r_name, count(o.o_orderkey) orders, round(coalesce(sum(o.o_totalprice), 0), 2) spent from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey left join orders o on o.o_custkey = c.c_custkey group by all")
def registry_chain(spark, folder):
    """Facts joined through two registries; the registries are small by their measured size."""
    nations = read(spark, folder, "nation").join(read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    spent = read(spark, folder, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("spent"))
    rows = read(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", "n_name", "r_name", F.coalesce("orders", F.lit(0)).alias("orders"), F.round(F.coalesce("spent", F.lit(0.0)), 2).alias("spent"))


def period_of_file(path: Column) -> Column:
    """The period "yyyy-MM" that a file's name carries, for tables read by file."""
    found = r"(20\d{2})[-_]?(0[1-9]|1[0-2])[^/]*$"
    return F.concat_ws("-", F.nullif(F.regexp_extract(path, found, 1), F.lit("")), F.nullif(F.regexp_extract(path, found, 2), F.lit("")))


_PERIOD = r"(20\d{2})[-_]?(0[1-9]|1[0-2])[^/]*$"


@query(
    f"with f as (select rec_id, 'reports/2026/' || source_id || '_' || coalesce(replace(substr(collected_at, 1, 7), '-', ''), 'undated') || '.json' file from parsers), p as (select case when regexp_matches(file, '{_PERIOD}') then regexp_extract(file, '{_PERIOD}', 1) || '-' || regexp_extract(file, '{_PERIOD}', 2) else '' end as period from f) select period, count(*) n from p group by 1"
)
def periods(spark, folder):
    """Files named by source and month, counted by the period in their names."""
    name = F.concat(F.lit("reports/2026/"), "source_id", F.lit("_"), F.coalesce(F.replace(F.substring("collected_at", 1, 7), F.lit("-"), F.lit("")), F.lit("undated")), F.lit(".json"))
    return reports.frequency(read(spark, folder, "parsers").select(period_of_file(name).alias("period")), "period")
