"""Queries of the core, by name, each with its SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions import dates, text, urls
from presslake.operators import rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query()
def p1_found(spark, folder):
    from presslake.operators.timestamps import normalise_timestamps

    tables = {
        "scripts": (read(spark, folder, "scripts"), "published", "source_name"),
        "parsers": (read(spark, folder, "parsers").withColumn("source_id", F.when(F.col("source_name").isNotNull(), F.col("source_id"))), "published_date", "source_id"),
        "site_adapters": (read(spark, folder, "site_adapters"), "publish_date", "source_name"),
    }
    return normalise_timestamps(tables, read(spark, folder, "source_registry"))


# Terms that occur in the test tables, standing for a taxonomy.
TAXONOMY = [
    rules.Keyword("catheter", "device", ("stent", "trocar"), 3), rules.Keyword("recall", "safety", ("recalls", "recalled"), 5), rules.Keyword("blister", "packaging", ("sachet", "pouch"), 4),
    rules.Keyword("high-barrier", "packaging", ("heat-sealed", "tamper-evident"), 4), rules.Keyword("tender", "procurement", ("tenders", "contracts"), 2), rules.Keyword("licence", "regulatory", ("licences", "registration"), 3),
    rules.Keyword("召回", "safety", ("撤回",), 5, "zh"), rules.Keyword("招标", "procurement", ("采购",), 2, "zh"), rules.Keyword("filem", "packaging", ("bekas",), 2, "ms"),
]
SHEETS = [
    rules.Sheet("device", (rules.Rule("product", ("catheter", "stent", "trocar", "syringe"), 7, 2), rules.Rule("market", ("tender", "tenders", "招标"), 3), rules.Rule("delay", ("delayed", "推迟"), -5)), 0, 18),
    rules.Sheet("packaging", (rules.Rule("form", ("blister", "sachet", "pouch"), 5, 3), rules.Rule("film", ("high-barrier", "filem"), 2, 2), rules.Rule("training", ("training", "seminar"), -9)), -4, 12),
]


def _sql_phrase(column: str, phrase: str) -> str:
    p = phrase.lower()
    if p.isascii() and p.isalnum():
        return f"regexp_matches({column}, '(?:^|[^\\p{{L}}\\p{{N}}_]){p}(?:$|[^\\p{{L}}\\p{{N}}_])')"
    return f"contains({column}, '{p}')"


def _sql_any(column: str, phrases) -> str:
    return "(" + " or ".join(_sql_phrase(column, p) for p in phrases) + ")"


_WS = r"[\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{85}]+"
_SQUEEZE = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '{_WS}', ' ', 'g'))"
_TEXT = f"lower({_SQUEEZE("concat_ws(' ', title, body)")})"
_KEYWORDS = "list_filter([" + ", ".join(f"case when {_sql_any('t', k.phrases())} then '{k.keyword}' end" for k in TAXONOMY) + "], lambda x: x is not null)"
_CATEGORY = "map {" + ", ".join(f"'{k.keyword}': '{k.category}'" for k in TAXONOMY) + "}"
_WEIGHT = "map {" + ", ".join(f"'{k.keyword}': {k.weight}" for k in TAXONOMY) + "}"
_MATCHED = f"with a as (select *, {_TEXT} t, lower({_SQUEEZE('title')}) h from parsers), m as (select *, {_KEYWORDS} k from a)"
_HITS = lambda r: f"least({r.most}, " + " + ".join(f"{_sql_phrase('t', t)}::int" for t in r.terms) + ")"
_VALID = f"(coalesce(starts_with(scrape_status, 'success'), false) and length({_SQUEEZE('body')}) >= 60)"
_SHEET = lambda s: f"case when {_VALID} then greatest({s.low}, least({s.high}, " + " + ".join(f"{r.weight} * {_HITS(r)}" for r in s.rules) + f")) else {s.low} end"
_REASONS = lambda s: f"case when {_VALID} then concat_ws('|', " + ", ".join(f"case when {_HITS(r)} > 0 then '{r.name}' end" for r in s.rules) + ") else '' end"
_SCORED = (
    f"with a as (select *, {_TEXT} t from parsers), s as (select *, " + ", ".join(f"({_SHEET(s)})::int {s.name}, {_REASONS(s)} {s.name}_reasons" for s in SHEETS) + " from a),"
    " r as (select *, case when device >= 14 or packaging >= 10 then 'first' when device + packaging > 0 then 'second' else 'rest' end level from s)"
)


def scored(spark, folder):
    valid = F.startswith("scrape_status", F.lit("success")) & (F.length(text.squeeze(F.col("body"))) >= 60)
    rows = rules.with_sheets(read(spark, folder, "parsers"), SHEETS, valid)
    return rules.labelled_by(rows, [("first", (F.col("device") >= 14) | (F.col("packaging") >= 10)), ("second", F.col("device") + F.col("packaging") > 0)], "rest", "level")


@query(_SCORED + " select source_name, country, count(*) records, count(*) filter (where level <> 'rest') scored, count(*) filter (where level = 'first') first_level, max(device) most_device from r group by all")
def flagship_rule_rollup(spark, folder):
    rows = scored(spark, folder)
    return rows.groupBy("source_name", "country").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("level") != "rest").alias("scored"), F.count_if(F.col("level") == "first").alias("first_level"), F.max("device").alias("most_device")
    )


@query(_MATCHED + " select rec_id, array_to_string(k, '|') matched, len(k)::int n from m")
def keyword_match(spark, folder):
    rows = rules.match_keywords(read(spark, folder, "parsers"), TAXONOMY)
    return rows.select("rec_id", F.array_join("matched_keywords", "|").alias("matched"), F.size("matched_keywords").alias("n"))


@query(_MATCHED + f", h as (select *, {_KEYWORDS.replace('(t,', '(h,')} kh from m) select rec_id, array_to_string(kh, '|') in_title, array_to_string(list_sort(list_distinct(list_transform(k, lambda x: {_CATEGORY}[x]))), '|') categories, coalesce(list_sum(list_transform(k, lambda x: {_WEIGHT}[x])), 0)::int weight from h")
def keyword_groups(spark, folder):
    rows = rules.match_keywords(read(spark, folder, "parsers"), TAXONOMY)
    return rows.select("rec_id", F.array_join("title_keywords", "|").alias("in_title"), F.array_join("matched_categories", "|").alias("categories"), F.col("weight_sum").alias("weight"))


@query(_SCORED + " select rec_id, device, device_reasons, packaging, packaging_reasons, level from r")
def rule_scores(spark, folder):
    return scored(spark, folder).select("rec_id", "device", F.array_join("device_reasons", "|").alias("device_reasons"), "packaging", F.array_join("packaging_reasons", "|").alias("packaging_reasons"), "level")


@query(_SCORED + " select level, count(*) n, sum(packaging)::bigint packaging from r group by 1")
def rule_summary(spark, folder):
    return scored(spark, folder).groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum("packaging").alias("packaging"))


_WEIGHTS = {"launched": 5, "approved": 4, "recalled": 5, "suspended": 2, "delayed": -3, "cancelled": -4, "withdrew": -2}


@query("select rec_id, (" + " + ".join(f"case when contains(lower(coalesce(title, '')), '{t}') then {w} else 0 end" for t, w in _WEIGHTS.items()) + ")::int score from parsers")
def signed_term_score(spark, folder):
    return read(spark, folder, "parsers").select("rec_id", rules.term_score(F.lower(F.coalesce("title", F.lit(""))), _WEIGHTS).cast("int").alias("score"))


# --- scalars ---------------------------------------------------------------------------


@query(f"select rec_id, {_SQUEEZE('title')} squeezed, trim(regexp_replace(regexp_replace(lower({_SQUEEZE('title')}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]', ' ', 'g'), '{_WS}', ' ', 'g')) plain from parsers")
def norm_title(spark, folder):
    c = F.col("title")
    return read(spark, folder, "parsers").select("rec_id", text.squeeze(c).alias("squeezed"), text.plain_title(c).alias("plain"))


_BARE = lambda c: rf"regexp_replace(lower({_SQUEEZE(c)}), '[^\p{{L}}\p{{N}}_\s]', '', 'g')"


@query(f"with b as (select rec_id, {_BARE('body')} x from parsers) select rec_id, length(x)::int n, case when length(x) < 80 then '' else sha256(x) end fingerprint from b")
def content_fingerprint(spark, folder):
    c = F.col("body")
    return read(spark, folder, "parsers").select("rec_id", F.length(text.bare_content(c)).alias("n"), text.fingerprint(c).alias("fingerprint"))


_URL = r"'^([A-Za-z][A-Za-z0-9+.\-]*):(?://)?([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$'"
_DROP_A = "(" + ", ".join(f"'{x}'" for x in urls.TRACKING_FOR_DEDUP) + ")"


def _address_sql(table: str, column: str, *more: str) -> str:
    """Parts of an address: l text, s scheme, h host, pa path, pb tidy path, q pairs, qq pairs that count for duplicates."""
    keep = "".join(f", {m}" for m in more)
    return (
        f"with u as (select rec_id{keep}, regexp_replace(coalesce({column}, ''), '^\\s+|\\s+$', '', 'g') l from {table}), p as (select *, lower(regexp_extract(l, {_URL}, 1)) s, lower(regexp_extract(l, {_URL}, 2)) h, regexp_extract(l, {_URL}, 3) pa,"
        f" list_transform(list_filter(string_split(regexp_extract(l, {_URL}, 4), '&'), lambda x: x <> ''), lambda x: case when contains(x, '=') then x else x || '=' end) q from u),"
        f" k as (select *, rtrim(regexp_replace(pa, '/{{2,}}', '/', 'g'), '/') pb, list_sort(list_filter(q, lambda x: lower(split_part(x, '=', 1)) not in {_DROP_A})) qq from p)"
    )


_KEY_A = "(case when s <> '' then s || '://' || h else '' end || case when pb = '' then '/' else pb end || case when len(qq) > 0 then '?' || array_to_string(qq, '&') else '' end)"


@query(_address_sql("scripts", "link") + f" select rec_id, {_KEY_A} dedup_key from k")
def url_dedup_key(spark, folder):
    return read(spark, folder, "scripts").select("rec_id", urls.dedup_key(F.col("link")).alias("dedup_key"))


@query(
    _address_sql("scripts", "link") + ", b as (select *, list_filter(q, lambda x: lower(split_part(x, '=', 1)) not in ('_sp', 'fbclid', 'gclid') and not starts_with(lower(x), 'utm_')) qb from k)"
    " select rec_id, case when s = '' then '' else s || '://' || h || pa || case when len(qb) > 0 then '?' || array_to_string(qb, '&') else '' end end ledger_key from b"
)
def url_ledger_key(spark, folder):
    return read(spark, folder, "scripts").select("rec_id", urls.ledger_key(F.col("link")).alias("ledger_key"))


@query(
    f"select rec_id, regexp_replace(url, '#.*$', '') bare, lower(regexp_extract(url, {_URL}, 2)) host, regexp_extract(regexp_extract(url, {_URL}, 3), '(\\d+)\\D*$', 1) number,"
    " case when contains(url, '?') then url || '&limit=20' else url || '?limit=20' end limited from parsers where url is not null"
)
def url_parts(spark, folder):
    u = F.col("url")
    return read(spark, folder, "parsers").where("url is not null").select(
        "rec_id", urls.without_fragment(u).alias("bare"), urls.host(u).alias("host"), urls.last_number(u).alias("number"), urls.with_parameter(u, "limit", "20").alias("limited")
    )


@query(
    "with u as (select rec_id, regexp_replace(url, '^\\s+|\\s+$', '', 'g') l from site_adapters where url is not null), p as (select rec_id, regexp_extract(l, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 1) s, regexp_extract(l, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) h, regexp_extract(l, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) pa from u)"
    " select rec_id, lower(s) || '://' || lower(h) || regexp_replace(coalesce(nullif(regexp_extract(regexp_extract(pa, '^(.*)/[^/]*$', 1), '^(.*/)[^/]*$', 1), ''), '/') || 'notice//7.html', '/{2,}', '/', 'g') || '?x=1' address from p"
)
def url_resolve(spark, folder):
    rows = read(spark, folder, "site_adapters").where("url is not null")
    return rows.select("rec_id", urls.page_address(urls.resolved(F.col("url"), F.lit("../notice//7.html?x=1#top"))).alias("address"))


_HTML = r"regexp_replace(coalesce(content_html, ''), '(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<[^>]+>', ' ', 'g')"


@query(f"select rec_id, trim({_HTML}) plain, replace(replace(replace(replace(replace(coalesce(title, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;'), chr(39), '&#x27;') escaped from scripts")
def html_strip(spark, folder):
    return read(spark, folder, "scripts").select("rec_id", F.trim(text.without_markup(F.col("content_html"))).alias("plain"), text.html_escaped(F.coalesce("title", F.lit(""))).alias("escaped"))


_TIDY = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(content_text, ''), '\r\n?', chr(10), 'g'), '\x{a0}', ' ', 'g'), '[\x{200b}\x{200c}\x{200d}\x{feff}]', '', 'g'), '[ \t]+', ' ', 'g'), '\n[ \t]+', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^[\s]+|[\s]+$', '', 'g')"


@query(f"select rec_id, md5({_TIDY}) tidy_md5, length({_TIDY})::int n from scripts")
def text_normalize(spark, folder):
    c = text.tidy_lines(F.col("content_text"))
    return read(spark, folder, "scripts").select("rec_id", F.md5(c).alias("tidy_md5"), F.length(c).alias("n"))


_NOISE = [r"read \d+ times", r"sign up for .*", r"follow .*", r"more from .*", r"sponsored by .*", r"版权所有.*"]


@query(
    "with l as (select rec_id, list_filter(list_transform(string_split(coalesce(content_text, ''), chr(10)), lambda x: trim(x)), lambda x: not regexp_full_match(x, '(?i)(?:" + "|".join(_NOISE) + ")')) k from scripts)"
    " select rec_id, md5(array_to_string(k, chr(10))) kept_md5 from l"
)
def noise_lines_removed(spark, folder):
    return read(spark, folder, "scripts").select("rec_id", F.md5(text.without_noise_lines(F.col("content_text"), _NOISE)).alias("kept_md5"))


@query("select rec_id, case when contains(title, ': ') then trim(regexp_extract(title, '(?s)^(.*): (.*)$', 1)) else title end head, case when contains(title, ': ') then trim(regexp_extract(title, '(?s)^(.*): (.*)$', 2)) else '' end publisher from site_adapters where title is not null")
def publisher_split(spark, folder):
    rows = read(spark, folder, "site_adapters").where("title is not null").withColumn("s", text.split_publisher(F.col("title"), ": "))
    return rows.select("rec_id", "s.head", "s.publisher")


@query("select rec_id, array_to_string(list_filter(list_transform(string_split(replace(replace(coalesce(array_to_string(source_tags, '，'), ''), '，', ','), '、', ','), ','), lambda x: trim(x)), lambda x: x <> ''), ';') tags from scripts")
def tag_split(spark, folder):
    joined = F.array_join(F.col("source_tags"), "，")
    return read(spark, folder, "scripts").select("rec_id", F.array_join(text.split_tags(joined), ";").alias("tags"))


_MONTHS = "map {" + ", ".join(f"'{w}': {i}" for i, ws in enumerate(dates.MONTH_WORDS, 1) for w in ws) + "}"


def _sql_date(y: str, m: str, d: str) -> str:
    return f"try_cast({y} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') as date)"


def _sql_found(c: str, pattern: str, y: int, m: int, d: int, word: bool) -> str:
    part = lambda i: f"regexp_extract({c}, '{pattern}', {i})"
    month = f"({_MONTHS})[lower({part(m)})]::varchar" if word else part(m)
    return f"case when regexp_matches({c}, '{pattern}') then {_sql_date(part(y), month, part(d))} end"


_ISO, _DAY, _DW, _MW = r"\b(20\d{2})[-/.](\d{1,2})[-/.](\d{1,2})\b", r"\b(\d{1,2})[-/.](\d{1,2})[-/.](20\d{2})\b", r"(?i)\b(\d{1,2}) ([a-z]+) (20\d{2})\b", r"(?i)\b([a-z]+) (\d{1,2}) (20\d{2})\b"
_DATES = (
    "with d as (select rec_id, published_date p, trim(regexp_replace(replace(coalesce(published_date, ''), ',', ' '), '\\s+', ' ', 'g')) c from parsers)"
    f" , e as (select rec_id, p, case when regexp_matches(c, '{_ISO}') then {_sql_found('c', _ISO, 1, 2, 3, False)} when regexp_matches(c, '{_DAY}') then {_sql_found('c', _DAY, 3, 2, 1, False)}"
    f" else coalesce({_sql_found('c', _DW, 3, 2, 1, True)}, {_sql_found('c', _MW, 3, 1, 2, True)}) end any_date from d)"
)


@query(_DATES + r" select rec_id, any_date, try_cast(regexp_extract(p, '^(\d{4}-\d{2}-\d{2})', 1) as date) iso_prefix, try_cast(regexp_replace(regexp_extract(p, '^(20\d{6})', 1), '(\d{4})(\d{2})(\d{2})', '\1-\2-\3') as date) compact from e")
def parse_dates(spark, folder):
    p = F.col("published_date")
    return read(spark, folder, "parsers").select("rec_id", dates.any_date(p).alias("any_date"), dates.iso_prefix(p).alias("iso_prefix"), dates.compact_date(p).alias("compact"))


_CN, _MAIL = r"(\d{4})年(\d{1,2})月(\d{1,2})日", r"(?i)^\s*(?:[a-z]{3}, )?(\d{1,2}) ([a-z]{3}) (\d{4}) \d{2}:\d{2}"


@query(f"select rec_id, {_sql_found('published_date', _CN, 1, 2, 3, False)} chinese, coalesce({_sql_found('published_date', _MAIL, 3, 2, 1, True)}, try_cast(regexp_extract(trim(published_date), '^(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1) as date)) mail from parsers")
def parse_dates_more(spark, folder):
    p = F.col("published_date")
    return read(spark, folder, "parsers").select("rec_id", dates.chinese_date(p).alias("chinese"), dates.mail_date(p).alias("mail"))


from presslake.plans import relational  # noqa: E402, F401  (adds its queries)
from presslake.plans import outer  # noqa: E402, F401
from presslake.plans import details  # noqa: E402, F401
from presslake.plans import further  # noqa: E402, F401
