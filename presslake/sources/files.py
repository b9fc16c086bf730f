"""Reading and writing records as files."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

#: Characters a spreadsheet cell may hold.
CELL = 32_767


def read_records(spark: SparkSession, path: str, schema: StructType | str, wrappers: tuple[str, ...] = ("records", "events"), lines: bool = False) -> DataFrame:
    """Objects of JSON documents that hold a list, or an object with a list under one
    of ``wrappers``.  Elements that are no objects are dropped.  With ``lines`` each line is
    a document, which may be a single object too, and a file is read in many tasks;
    else each file is one document."""
    texts = spark.read.text(path, wholetext=not lines)
    kind = StructType.fromDDL(schema).simpleString() if isinstance(schema, str) else schema.simpleString()
    as_list = lambda c: F.from_json(c, "array<string>")  # noqa: E731  (elements as JSON text, of whatever kind)
    found = [F.when(F.ltrim("value").startswith("["), as_list(F.col("value")))]
    found += [as_list(F.get_json_object("value", f"$.{w}")) for w in wrappers]
    if lines:
        found.append(F.array("value"))
    elements = texts.select(F.explode(F.coalesce(*found)).alias("e")).where(F.ltrim("e").startswith("{"))
    return elements.select(F.from_json("e", kind).alias("r")).select("r.*")


def read_registry(spark: SparkSession, path: str, key: str, enabled_only: bool = True) -> DataFrame:
    """A YAML list of maps, under ``key``, as a frame of strings; a registry of
    sources, read by the driver (refused above 4 MB)."""
    import os

    import yaml

    if os.path.getsize(path) > 4_000_000:
        raise ValueError("a registry is not that large")
    entries = yaml.safe_load(open(path, encoding="utf-8"))[key]
    entries = [e for e in entries if isinstance(e, dict) and (e.get("enabled", True) or not enabled_only)]
    names = list(dict.fromkeys(k for e in entries for k in e))
    as_text = lambda v: None if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    return spark.createDataFrame([tuple(as_text(e.get(n)) for n in names) for e in entries], ", ".join(f"`{n}` string" for n in names) or "name string")


def choose_sources(registry: DataFrame, wanted: list[str], column: str = "source_id") -> DataFrame:
    """The wanted entries; an unknown name is an error."""
    known = {r[0] for r in registry.select(column).where(F.col(column).isin(wanted)).collect()}
    if missing := sorted(set(wanted) - known):
        raise ValueError(f"unknown sources: {', '.join(missing)}")
    return registry.where(F.col(column).isin(wanted))


def flat_columns(frame: DataFrame, separator: str = ", ") -> DataFrame:
    """Arrays of text joined, other nested columns as JSON, cells cut to what a
    spreadsheet holds."""

    def flat(name: str) -> Column:
        kind = frame.schema[name].dataType
        c = F.col(f"`{name}`")
        if isinstance(kind, ArrayType) and kind.elementType.typeName() == "string":
            c = F.array_join(c, separator)
        elif kind.typeName() in ("array", "map", "struct"):
            c = F.to_json(c)
        elif kind.typeName() != "string":
            return c.alias(name)
        return F.when(F.length(c) > CELL, F.concat(F.substring(c, 1, CELL - 12), F.lit("...truncated"))).otherwise(c).alias(name)

    return frame.select(*[flat(n) for n in frame.columns])


def write_json(frame: DataFrame, path: str) -> None:
    """Replaces ``path`` by JSON lines; the committer makes it all or nothing."""
    frame.write.mode("overwrite").json(path)


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV with a heading; a byte order mark goes in front of each part's heading."""
    flat = flat_columns(frame)
    first = flat.columns[0]
    flat.withColumnRenamed(first, "﻿" + first).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def overwrite_with_backup(frame: DataFrame, path: str, stamp: str) -> str | None:
    """Replaces the table at ``path`` and keeps what was there as path_backup_stamp; the new
    one is written beside it first, so that a failure leaves the old one.  Returns the
    backup's path, None if there was nothing.  An existing backup is an error."""
    spark = frame.sparkSession
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    backup, fresh = f"{path.rstrip('/')}_backup_{stamp}", f"{path.rstrip('/')}_new_{stamp}"
    if fs.exists(at(backup)):
        raise FileExistsError(backup)
    frame.write.mode("overwrite").parquet(fresh)
    there = fs.exists(at(path)) and fs.rename(at(path), at(backup))
    fs.rename(at(fresh), at(path))
    return backup if there else None


def append(frame: DataFrame, path: str) -> None:
    frame.write.mode("append").parquet(path)


def write_by_source(frame: DataFrame, path: str, source: str = "source_name") -> None:
    """Replaces only the partitions of the sources in ``frame``."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source).parquet(path)


def markdown_records(frame: DataFrame, title: str, fields: dict[str, str], body: str) -> DataFrame:
    """A column ``markdown`` with heading, labelled fields and body of each row."""
    lines = [F.concat(F.lit("## "), F.coalesce(title, F.lit("")))] + [F.concat(F.lit(f"- {label}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c, label in fields.items()]
    return frame.withColumn("markdown", F.concat_ws("\n", *lines, F.lit(""), F.coalesce(body, F.lit(""))))


#: Notes on read images under an article: of the prepared corpus.
IMAGE_NOTE = "图片 OCR 仅供参考，可能存在识别错误。核心分析应优先基于 main_text。"


def article_markdown(frame: DataFrame) -> DataFrame:
    """Columns ``markdown`` and ``prepared``: each article as a section of the final and of the prepared
    corpus, with its whole text and the whole text of its images.  Sections joined by a line break
    make the file; its first lines and the running number of prepared headings are the file writer's."""
    value = lambda c, none="": F.coalesce(F.col(c).cast("string"), F.lit(none))
    filled = lambda c, none: F.when(value(c) != "", value(c)).otherwise(none)
    tags = F.coalesce(F.array_join("source_tags", "、"), F.lit(""))
    line = lambda label, c, end="": F.concat(F.lit(label), c, F.lit(end))
    final = [
        line("# ", filled("title", "Untitled")), F.lit(""),
        line("来源：", value("source_name"), "  "), line("发布时间：", value("published"), "  "), line("分类：", value("source_category"), "  "), line("标签：", tags, "  "), line("原文链接：", value("link"), "  "),
        line("数据质量分：", value("data_quality_score", "0"), "  "), line("数据质量说明：", value("data_quality_note"), "  "),
        F.lit("\n## 正文\n"), filled("main_text", "无"), F.lit("\n## 图片 OCR 补充信息\n"), filled("image_ocr_text", "无"), F.lit("\n---\n"),
    ]
    title = F.regexp_replace(F.regexp_replace(value("title"), "\n", " "), r"^[\s\p{Z}\x{1c}-\x{1f}\x{85}]+|[\s\p{Z}\x{1c}-\x{1f}\x{85}]+$", "")
    prepared = [
        F.lit("---\n"), line("## ", F.when(title != "", title).otherwise("Untitled")), F.lit(""),
        line("- 来源：", value("source_name")), line("- 发布时间：", value("published")), line("- 分类：", value("source_category")), line("- 标签：", tags), line("- 原文链接：", value("link")),
        line("- 正文长度：", value("text_length", "0")), line("- 图片数量：", value("image_count", "0")),
        F.lit("\n### 正文\n"), value("main_text"), F.lit("\n### 图片 OCR 补充信息\n"), filled("image_ocr_text", "无"), F.lit(f"\n> {IMAGE_NOTE}\n"),
    ]
    return frame.withColumns({"markdown": F.concat_ws("\n", *final), "prepared": F.concat_ws("\n", *prepared)})


def approved_or_draft(draft: Column, approved: Column) -> Column:
    """The approved text where there is one, else the draft."""
    return F.coalesce(F.when(F.trim(approved) != "", approved), draft)


def manifest(frame: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """One row: the number of rows and of rows that fulfil each condition."""
    return frame.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])


def html_table(frame: DataFrame, title: str, most: int = 1000) -> str:
    """A report table as a page; of a result that a reader can take in, refused beyond ``most`` rows."""
    rows = frame.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    cell = lambda t, v: f"<{t}>{html.escape('' if v is None else str(v))}</{t}>"
    head = "".join(cell("th", c) for c in frame.columns)
    body = "".join("<tr>" + "".join(cell("td", v) for v in r) + "</tr>" for r in rows)
    return f'<!doctype html><meta charset="utf-8"><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><table><tr>{head}</tr>{body}</table>'


def reader_page(frame: DataFrame, title: str, most: int = 1000) -> str:
    """A page that works offline: the rows as data, a field to filter by words and headings to
    sort by.  Of a result that a reader can take in, refused beyond ``most`` rows."""
    import json

    rows = frame.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    data = json.dumps({"columns": frame.columns, "rows": [[None if v is None else str(v) for v in r] for r in rows]}, ensure_ascii=False).replace("</", "<\\/")
    script = (
        "const d=JSON.parse(document.getElementById('data').textContent),t=document.getElementById('t'),q=document.getElementById('q');let by=-1,up=1;"
        "function show(){const w=q.value.toLowerCase().split(/\\s+/).filter(Boolean);let r=d.rows.filter(x=>w.every(y=>x.some(c=>(c||'').toLowerCase().includes(y))));"
        "if(by>=0)r=[...r].sort((a,b)=>up*String(a[by]??'').localeCompare(String(b[by]??''),undefined,{numeric:true}));t.replaceChildren();"
        "const h=t.insertRow();d.columns.forEach((c,i)=>{const e=document.createElement('th');e.textContent=c;e.onclick=()=>{up=by===i?-up:1;by=i;show()};h.append(e)});"
        "r.forEach(x=>{const e=t.insertRow();x.forEach(c=>{e.insertCell().textContent=c??''})})}q.oninput=show;show();"
    )
    name = html.escape(title)
    return f'<!doctype html><meta charset="utf-8"><title>{name}</title><h1>{name}</h1><input id="q"><table id="t"></table><script type="application/json" id="data">{data}</script><script>{script}</script>'


def report_markdown(title: str, sections: dict[str, DataFrame], line: str, order: list[str], empty: str = "None.", most: int = 1000) -> str:
    """A report: a heading, then per section its rows in ``order``, each as ``line`` with
    {column} filled in; of what a reader can take in, refused beyond ``most`` rows a section."""
    out = [f"# {title}"]
    for heading, frame in sections.items():
        rows = frame.orderBy(*order).limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} rows in {heading!r}")
        out += ["", f"## {heading}", "", *([line.format(**{k: "" if v is None else v for k, v in r.asDict().items()}) for r in rows] or [empty])]
    return "\n".join(out) + "\n"


def replace_section(document: str, heading: str, text: str) -> str:
    """A Markdown document with one section replaced; an error unless it occurs exactly once."""
    import re

    pattern = re.compile(rf"(?ms)^(## {re.escape(heading)}[ \t]*\n).*?(?=^## |\Z)")
    out, n = pattern.subn(lambda m: m.group(1) + text.rstrip("\n") + "\n\n", document)
    if n != 1:
        raise ValueError(f"section {heading!r} occurs {n} times")
    return out
