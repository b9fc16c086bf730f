"""Queries of the problems tagged llm; names start with the problem's number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.history import duplicates_of_accepted

    return duplicates_of_accepted(_read(spark, folder, "scripts"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.site_lines import repeated_lines

    return repeated_lines(_read(spark, folder, "scripts"))


def p3_clean(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.site_lines import without_repeated_lines

    return without_repeated_lines(_read(spark, folder, "scripts").select("rec_id", "source_name", "content_text")).select("rec_id", "content_text")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.one_form import changed_records

    return changed_records({"scripts": (_read(spark, folder, "scripts"), "title"), "update_llm_ready": (_read(spark, folder, "update_llm_ready"), "main_text")})


def p4_texts(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.one_form import unify_texts

    titles = unify_texts(_read(spark, folder, "scripts").select(F.lit("scripts").alias("table_name"), "rec_id", F.col("title").alias("text")), "text")
    texts = unify_texts(_read(spark, folder, "update_llm_ready").select(F.lit("update_llm_ready").alias("table_name"), "rec_id", F.col("main_text").alias("text")), "text")
    return titles.unionByName(texts).drop("text")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.scanned import scan_noise

    return scan_noise(_read(spark, folder, "update_llm_ready"))


def p5_repaired(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.scanned import repair_scans

    return repair_scans(_read(spark, folder, "update_llm_ready"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.near_records import near_duplicate_pairs

    return near_duplicate_pairs(_read(spark, folder, "update_llm_ready"))


def p6_links(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.near_records import near_duplicate_links

    return near_duplicate_links(_read(spark, folder, "update_llm_ready"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.page_frame import page_frame

    return page_frame({"site_adapters": (_read(spark, folder, "site_adapters"), "body"), "parsers": (_read(spark, folder, "parsers"), "list_text")})


def p7_texts(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.page_frame import main_texts

    return main_texts({"site_adapters": (_read(spark, folder, "site_adapters"), "body"), "parsers": (_read(spark, folder, "parsers"), "list_text")})


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.encoding import encode_corpus

    return encode_corpus(_read(spark, folder, "documents"))


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.containers import fill_with_documents

    return fill_with_documents(_read(spark, folder, "documents"), _read(spark, folder, "container_specs"))


def p9_summary(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.containers import fill_summary

    return fill_summary(p9_containers(spark, folder), _read(spark, folder, "container_specs"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.wrong_encoding import garbled_documents

    return garbled_documents(_read(spark, folder, "documents"))


def p10_restored(spark: SparkSession, folder: str) -> DataFrame:
    from presslake.llm.wrong_encoding import restore_documents

    return restore_documents(_read(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        p2_found, p3_found, p3_clean, p4_found, p4_texts, p5_found, p5_repaired, p6_found, p6_links, p7_found, p7_texts, p8_ids, p9_containers, p9_summary, p10_found, p10_restored,
    )
}
_BLANK = r"[\s\p{Nd}\x{85}\x{a0}\x{1680}\x{1c}-\x{1f}\x{b}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
ORACLE: dict[str, str] = {
    "p3_found": rf"""
        with d as (select rec_id, source_name, string_split(content_text, chr(10)) l from scripts where source_name is not null and content_text <> ''),
        n as (select source_name, count(*) docs from d group by 1),
        x as (select rec_id, source_name, i::int line_no, regexp_replace(lower(l[i]), '{_BLANK}', '', 'g') k from (select *, unnest(range(1, len(l) + 1)) i from d)),
        c as (select source_name, k, count(distinct rec_id) c from x where k <> '' group by all)
        select rec_id, line_no from x join c using (source_name, k) join n using (source_name) where c >= 8 and c * 20 >= docs
    """,
    "p6_found": r"""
        with t as (select rec_id, regexp_extract_all(lower(coalesce(title, '') || chr(10) || main_text), '[\x{4e00}-\x{9fff}]|(?:[^\P{L}\x{4e00}-\x{9fff}]|\p{Nd})+') w from update_llm_ready where main_text <> ''),
        g as (select distinct rec_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] k from (select *, unnest(range(1, len(w) - 2)) i from t where len(w) >= 4)),
        n as (select rec_id, count(*) n from g group by 1),
        o as (select a.rec_id a, b.rec_id b, count(*) c from g a join g b on a.k = b.k and a.rec_id < b.rec_id group by all)
        select a rec_id_a, b rec_id_b from o join n x on x.rec_id = a join n y on y.rec_id = b where 3 * c >= x.n + y.n
    """,
}
