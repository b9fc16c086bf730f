import difflib

from pyspark.sql import functions as F

from presslake.operators import records, reports, rules


def test_keep_and_upsert(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, "", "w")], "rec_id int, url string, _row string")
    assert sorted(r.rec_id for r in records.keep_first(rows, ["url"], [F.col("rec_id")]).collect()) == [1, 3, 4]
    new = spark.createDataFrame([(5, "a", "n"), (6, "", "m")], "rec_id int, url string, _row string")
    assert sorted(r.rec_id for r in records.upsert(rows, new, "url", "rec_id").collect()) == [3, 4, 5, 6]
    assert records.upsert(rows.limit(0), new.limit(0), "url", "rec_id").count() == 0


def test_cascade_and_either(spark):
    table = spark.createDataFrame([(1, "i1", "l1"), (2, "i1", "l2"), (3, "", "l3")], "v int, id string, link string")
    rows = spark.createDataFrame([("i1", "l3"), ("", "l3"), (None, None)], "id string, link string")
    got = {(r.id, r.link): (r.v, r.lookup_step) for r in records.cascaded_lookup(rows, table, [["id"], ["link"]], "v", "v").collect()}
    assert got == {("i1", "l3"): (2, 1), ("", "l3"): (3, 2), (None, None): (None, None)}
    assert sorted(r.matched for r in records.either_match(rows, table, [["id"], ["link"]]).collect()) == [False, True, True]


def test_similar_titles_against_all_pairs(spark):
    base = ["Regulator recalls coated stent in Port Yarphor", "Board approves new filter line for clinics", "召回通报：一次性注射器与采血管批次说明"]
    titles = list(base)
    for t in base:
        titles += [t + "!", t[:-1], t[1:], t.replace("e", "a", 1), t.upper(), t[:10] + "XX" + t[10:], t[::-1], t[:5] + t[8:]]
    titles += ["", "a", "ab"]
    rows = spark.createDataFrame(list(enumerate(titles)), "k int, t string")
    got = {(r.earlier, r.later): round(r.ratio, 6) for r in records.similar_titles(rows, "k", "t").collect()}
    want = {}
    first: dict = {}
    for i, t in enumerate(titles):
        first.setdefault(t, i)
    kept = sorted((i, t) for t, i in first.items() if t)
    for i, a in kept:
        for j, b in kept:
            if i < j and (r := difflib.SequenceMatcher(None, b, a).ratio()) >= 0.92:
                want[i, j] = round(r, 6)
    assert got == want and want


def test_ledger_merges_provenance(spark):
    rows = spark.createDataFrame(
        [("u", 5, "b", "i2", "competitor", ["s2"]), ("u", 5, "a", "i1", None, ["s1"]), ("v", 9, "a", "i3", "none", ["s1"])],
        "key string, score int, p string, a string, rel string, labels array<string>",
    )
    out = records.event_ledger(rows, F.col("key"), F.col("score"), "p", "a", "rel", "labels")
    (r,) = out.collect()
    assert (r.ledger_key, r.a, r.labels, r.merged_rows) == ("u", "i1", ["s1", "s2"], 2)
    again = records.event_ledger(out.withColumnRenamed("ledger_key", "k2"), F.col("k2"), F.col("score"), "p", "a", "rel", "labels").collect()
    assert [(x.labels, x.merged_rows) for x in again] == [(["s1", "s2"], 2)]
    assert sorted(r.member for r in records.ledger_members(rows, F.col("key"), "rel", "a").collect()) == ["i1", "i2"]
    (c,) = records.ledger_counts(rows, out, "rel", ["competitor"]).collect()
    assert tuple(c) == (3, 1, 1, 1, 0)


def test_issue_merged_into_the_master(spark):
    schema = "k string, score int, p string, a string, rel string, labels array<string>, merged_rows bigint"
    master = spark.createDataFrame([("u", 5, "b", "i1", "x", ["s1"], 2), ("w", 1, "a", "i4", "x", ["s1"], 1)], schema)
    issue = spark.createDataFrame([("u", 7, "c", "i2", "x", ["s2"], 1), ("v", 9, "a", "i3", "x", ["s3"], 1)], schema)
    merged, subset = records.merge_issue(master, issue, "k", "score", "p", "a", "rel", "labels")
    got = {r.k: (r.a, r.labels, r.merged_rows) for r in merged.collect()}
    assert got == {"u": ("i2", ["s1", "s2"], 3), "w": ("i4", ["s1"], 1), "v": ("i3", ["s3"], 1)}
    assert sorted(r.k for r in subset.collect()) == ["u", "v"]
    assert records.merge_issue(master, issue.limit(0), "k", "score", "p", "a", "rel", "labels")[1].count() == 0


def test_rule_sheets(spark):
    rows = spark.createDataFrame([(1, "stent stent", "x blister foil"), (2, None, None), (3, "stent training", "y")], "rec_id int, title string, body string")
    sheets = [rules.Sheet("d", (rules.Rule("p", ("stent", "blister foil", ""), 50, 2), rules.Rule("t", ("training",), -60)), 0, 70), rules.Sheet("none", ())]
    got = {r.rec_id: (r.d, r.d_reasons, r.none) for r in rules.with_sheets(rows, sheets).collect()}
    assert got == {1: (70, ["p"], 0), 2: (0, [], 0), 3: (0, ["p", "t"], 0)}
    assert {r.d for r in rules.with_sheets(rows, sheets, F.col("rec_id") > 5).collect()} == {0}


def test_phrase_join_both_ways(spark):
    rows = spark.createDataFrame([(1, "a stent, heat-sealed"), (2, "stents 召回通报"), (3, None), (4, "回")], "rec_id int, t string")
    phrases = spark.createDataFrame([(p,) for p in ("Stent", "heat-sealed", "召回", "回", " ", None)], "phrase string")
    few, many = ({(r.rec_id, r.phrase) for r in rules.phrase_join(rows, phrases, rules.text_of("t"), literals=n).collect()} for n in (200, 0))
    assert few == many == {(1, "Stent"), (1, "heat-sealed"), (2, "召回"), (2, "回"), (4, "回")}


def test_chunks(spark):
    rows = spark.range(1, 101).withColumn("k", F.col("id") * 7 % 101)
    got = reports.chunked(rows, [F.col("k")], 30).orderBy("row_no").collect()
    assert [r.k for r in got] == list(range(1, 101)) and [r.row_no for r in got] == list(range(1, 101)) and got[-1].chunk_no == 4


def test_components_and_winners(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 9), (9, 8), (5, 6), (6, 6), (20, 19), (19, 18), (18, 17), (17, 16)], "a long, b long")
    got = {r.id: r.component for r in records.components(edges).collect()}
    assert got == {**dict.fromkeys([1, 2, 3, 8, 9], 1), **dict.fromkeys([5, 6], 5), **dict.fromkeys(range(16, 21), 16)}
    assert records.components(edges.limit(0)).count() == 0
    body = "content " * 20
    rows = spark.createDataFrame(
        [(1, "http://a/x?utm_source=1", "Alpha one", body), (2, "http://a/x/", "Beta", "short"), (3, "http://b/y", "Gamma", body.strip() + "!!"), (4, "", "Delta delta delta delta", None), (5, None, "Delta delta delta delta.", ""), (6, "", "Other", None)],
        "k long, url string, title string, body string",
    )
    out = {r.k: (r.duplicate_of, r.duplicate_reason) for r in records.resolve_duplicates(rows, "k", [F.length(F.coalesce("body", F.lit("")))]).collect()}
    assert out == {1: (3, "exact_content"), 2: (3, "linked"), 3: (None, None), 4: (None, None), 5: (4, "similar_title:1.000"), 6: (None, None)}
    near = [(1, "http://a/1", "Regulator recalls coated stent in Port Yarphor", "x" * 90), (2, "http://a/2", "Regulator recalls coated stents in Port Yarphor", "y" * 100), (3, "", "", None), (4, None, None, None)]
    out = {r.k: (r.duplicate_of, r.duplicate_reason) for r in records.resolve_duplicates(spark.createDataFrame(near, "k long, url string, title string, body string"), "k", [F.length(F.coalesce("body", F.lit("")))]).collect()}
    assert out == {1: (2, "similar_title:0.989"), 2: (None, None), 3: (None, None), 4: (None, None)}


def test_seen_union_reads_all_batches(spark, tmp_path):
    from presslake.plans.queries import QUERIES

    rows = [(0, "a"), (1, "b"), (2, "c"), (8, "d"), (8, "a"), (3, None)]
    spark.createDataFrame(rows, "batch_no int, article_id string").write.parquet(f"{tmp_path}/scripts.parquet")
    assert sorted(r.article_id for r in QUERIES["seen_union_all"](spark, str(tmp_path)).collect()) == ["a", "b", "c", "d"]
