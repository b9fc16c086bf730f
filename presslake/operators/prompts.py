"""Articles made ready for a model: a fixed projection, prompt texts, search queries,
and the check of a report that a model wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.text import blank_to_null, distinct_trimmed, joined_letters, tidy_lines, without_image_notes

# The columns of a prepared article, in order, the note that goes with read images, and the
# source of a text that came from its page.
PREPARED = [
    "title", "source_name", "source_category", "source_tags", "source_priority", "link", "published", "article_id", "scraped_at", "fetch_status", "fetch_error", "content_source",
    "image_count", "image_urls", "image_ocr_text", "image_fetch_status", "image_fetch_error", "image_ocr_quality_note", "main_text", "main_text_preview", "text_length", "word_count",
    "has_full_text", "has_image_ocr", "data_quality_score", "data_quality_note", "llm_input_text", "llm_input_text_with_ocr",
]
FROM_PAGE = "wechat_page"
OCR_NOTE = "图片 OCR 仅供参考，可能存在识别错误，尤其是图表、表格、坐标轴和数字。核心分析应优先基于 main_text。"
# Labels of a prompt's head lines, of its parts, and its last line.
HEAD = {"标题": "title", "来源": "source_name", "发布时间": "published", "分类": "source_category", "标签": "source_tags", "原文链接": "link"}
PARTS = {"正文": "main_text", "数据质量说明": "data_quality_note"}
OCR_PART, LAST_LINE = "图片 OCR 补充信息", "注意：图片 OCR 仅供参考，可能存在识别错误。核心分析应优先基于正文 main_text。"


def _text(c: str) -> Column:
    return F.coalesce(F.array_join(c, "、") if c == "source_tags" else F.col(c).cast("string"), F.lit(""))


def prompt_texts(frame: DataFrame) -> DataFrame:
    """``frame`` with llm_input_text and llm_input_text_with_ocr: labelled fields, whole
    text and note on quality; the second with the text of images and a warning."""
    head = [F.concat(F.lit(f"{label}："), _text(c)) for label, c in HEAD.items()]
    parts = [F.concat(F.lit(f"\n{label}：\n"), _text(c)) for label, c in PARTS.items()]
    plain = tidy_lines(F.concat_ws("\n", *head, *parts))
    frame = frame.withColumn("llm_input_text", plain)
    return frame.withColumn("llm_input_text_with_ocr", tidy_lines(F.concat_ws("\n", F.col("llm_input_text"), F.lit(f"\n{OCR_PART}："), _text("image_ocr_text"), F.lit(f"\n{LAST_LINE}"))))


def prepared(frame: DataFrame, full_text: int = 500, preview: int = 1000) -> DataFrame:
    """Articles with exactly the columns of PREPARED.

    Texts are cleaned of image notes and set-apart characters, counts and flags made
    anew from them, null texts are empty, and a missing identifier is the link.  A text
    of more than ``full_text`` characters is a full one.  Needs the other columns,
    data_quality_score and data_quality_note among them, which stay as they are."""
    frame = frame.withColumns({c: F.coalesce(c, F.lit("")) for c, t in frame.dtypes if t == "string" and c in PREPARED})
    frame = frame.withColumns(
        {
            "main_text": joined_letters(without_image_notes(F.col("main_text"))), "image_ocr_text": joined_letters(tidy_lines(F.col("image_ocr_text"))),
            "image_urls": distinct_trimmed(F.col("image_urls")), "source_tags": distinct_trimmed(F.col("source_tags")), "article_id": F.coalesce(blank_to_null(F.col("article_id")), F.col("link")),
        }
    )
    known = (F.col("fetch_status") == "success") & (F.col("main_text") != "") & (F.col("content_source") == "")
    size = F.length("main_text")
    frame = frame.withColumns(
        {
            "content_source": F.when(known, FROM_PAGE).otherwise(F.col("content_source")), "main_text_preview": F.substring("main_text", 1, preview), "text_length": size, "word_count": size,
            "image_count": F.coalesce(F.nullif("image_count", F.lit(0)), F.size("image_urls")), "has_full_text": size > full_text, "has_image_ocr": F.col("image_ocr_text") != "", "image_ocr_quality_note": F.lit(OCR_NOTE),
        }
    )
    return prompt_texts(frame).select(*PREPARED)


def search_query(name: Column, topics: Column, events: list[str], start: Column | None = None, end: Column | None = None) -> Column:
    """A query for a news search: the quoted name, one of the ``topics`` (those of more
    than one word quoted), one of the ``events``, and the days between."""
    quoted = F.transform(topics, lambda t: F.when(F.contains(t, F.lit(" ")), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(t))
    either = lambda words: F.concat(F.lit("("), words, F.lit(")"))
    out = F.concat_ws(" ", F.concat(F.lit('"'), name, F.lit('"')), either(F.array_join(quoted, " OR ")), either(F.lit(" OR ".join(events))))
    if start is None or end is None:
        return out
    dates = F.concat(F.lit(" after:"), F.date_format(start, "yyyy-MM-dd"), F.lit(" before:"), F.date_format(end, "yyyy-MM-dd"))
    return F.concat(out, F.coalesce(dates, F.lit("")))


def report_errors(actions: DataFrame, evidence: DataFrame, report: str, title: str, refs: str, known: str, wanted: int = 10) -> DataFrame:
    """(report, errors): what keeps a report from being published, per report, sorted;
    an empty array if nothing does.  ``actions`` has a row per action.

    Errors: not ``wanted`` actions; an empty or repeated title (case and ends aside); an
    action without evidence; evidence that ``evidence`` (column ``known``) does not hold, or
    that is cited twice.  Counts are made per title and reference, so no report is gathered in a row."""
    key = F.lower(F.trim(F.coalesce(title, F.lit(""))))
    titles = actions.groupBy(report, key.alias("_t")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.size(refs), F.lit(0)) <= 0).alias("bare"))
    counted = titles.groupBy(report).agg(F.sum("n").alias("actions"), F.count_if((F.col("n") > 1) | (F.col("_t") == "")).alias("repeated"), F.sum("bare").alias("bare"))
    cited = actions.select(report, F.explode(refs).alias("_r")).groupBy(report, "_r").agg(F.count(F.lit(1)).alias("n"))
    there = evidence.select(F.col(known).alias("_r")).distinct().withColumn("_known", F.lit(True))
    cited = cited.join(there, "_r", "left").groupBy(report).agg(F.count_if(F.col("_known").isNull()).alias("unknown"), F.count_if(F.col("n") > 1).alias("again"))
    checks = {"actions": F.col("actions") != wanted, "repeated title": F.col("repeated") > 0, "no evidence": F.col("bare") > 0, "unknown evidence": F.col("unknown") > 0, "evidence cited twice": F.col("again") > 0}
    errors = F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()])))
    return counted.join(cited, report, "left").select(report, errors.alias("errors"))
