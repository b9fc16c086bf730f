import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from presslake.llm.containers import best_fit, fill_containers, fill_summary, pack_counts, reduce_by_dominance
from presslake.llm.near_records import TOKEN, near_duplicate_links, near_duplicate_pairs
from presslake.llm.scanned import anagram_hash, frame_of, is_page_number, lay_out, reading, repair_scans, repaired, scan_noise

CLEAN = "The authority accepted the high-barrier stent before the deadline. The clinic noted further complaints in the spring and licensed the valve. 据仓储中心介绍，手套的指南增长，包装供应商与公司通报。 "
SCAN = "Acme bulletin 5\nThe auth0rity acceptecl the high-\nbarrier stent before the dead-\nline. The clinic noted fur¬\nther complaints.\n- 2 -\nAcme bu1letin 5\nLot 2026-114\n据仓储申心介绍，手套旳指南增长\n2. Storage\nThe clinic 1icensed the\nvalve.\nPage 3"


def test_forms():
    assert all(map(is_page_number, ["12", "- 2 -", "— 3 —", "[l]", "2 / 9", "p. 4", "Page 1 of 3", "第 3 页 共 9 页", "Pa9e 7"]))
    assert not any(map(is_page_number, ["9 units", "Lot 2026-114", "so", "2. Storage", "B12, K2", ""]))
    assert reading("reachecl") == reading("reached") and reading("1icensed") == reading("licensed") and reading("bospital") == reading("hospital")
    assert anagram_hash("ab") == anagram_hash("ba") != anagram_hash("aa")
    assert frame_of(SCAN.split("\n"), "") == {0, 5, 6, 12} and frame_of([], "") == set()
    assert lay_out("", None) == []
    assert frame_of(["ORTHOPAEDIC INHALER TENDERS: MORMORA STERILE SYST", "text"], "Orthopaedic inhaler tenders: Mormora Sterile Systems reported new terms") == {0}


def test_scan_noise(spark):
    rows = [(i, None, CLEAN, None, "w") for i in range(40)] + [(100, "t", None, SCAN, "w"), (101, None, "", "", "w"), (None, None, None, SCAN, "w"), (100, "t", None, SCAN, "w")]
    frame = spark.createDataFrame(rows, "rec_id bigint, title string, main_text string, image_ocr_text string, word string")
    got = [tuple(x) for x in scan_noise(frame).collect()]
    want = {(n, "drop") for n in (1, 6, 7, 13)} | {(2, "fix"), (3, "join"), (4, "join"), (9, "fix"), (11, "fix")}
    assert {(n, k) for rec, n, k in got if rec == 100} == want and len(got) == len(set(got)) == len(want)
    assert scan_noise(frame.limit(0)).count() == 0
    text = {x.rec_id: x.repaired for x in repair_scans(frame).collect()}
    assert text[100] == "The authority accepted the high-barrier stent before the deadline. The clinic noted further complaints. Lot 2026-114 据仓储中心介绍，手套的指南增长 2. Storage The clinic licensed the valve."
    assert text[101] == "" and text[0] is None and repair_scans(frame.limit(0)).count() == 0


def test_paragraphs():
    assert repaired("One two\nthree.\n\nFour\n\nfive", set(), set(), {}) == "One two three.\n\nFour five"
    assert repaired("a deadl-\n3\nine", {2}, {1}, {}) == "a deadline" and repaired("high-\nbarr1er H0W", set(), set(), {"barr1er": "barrier", "h0w": "how"}) == "high-barrier HOW"
    assert repaired(None, set(), set(), {}) is None and repaired("", set(), set(), {}) == "" and repaired("中\n文说明由Pack \nLabs提供Syst\nems等产品", set(), set(), {}) == "中文说明由Pack Labs提供Systems等产品"


def brute_pairs(rows):
    sets = {}
    for rec, title, text in rows:
        if rec is not None and text:
            t = TOKEN.findall(((title or "") + "\n" + text).lower())
            if len(t) >= 4:
                sets[rec] = {tuple(t[i : i + 4]) for i in range(len(t) - 3)}
    ids = sorted(sets)
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])}


def test_near_records_against_all_pairs(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(60)] + list("医械包装召回通报")
    texts = [[r.choice(words) for _ in range(r.choice([3, 5, 12, 40, 120]))] for _ in range(25)]
    rows = []
    for i in range(160):
        t = list(r.choice(texts)) if i % 3 else list(texts[0])  # a third of the rows from one text
        for _ in range(r.choice([0, 0, 1, 2, 6])):
            k = r.randrange(len(t))
            t[k : k + 1] = r.choice([[], [r.choice(words)], [t[k], r.choice(words)]])
        rows.append((i, r.choice([None, "", "Title One"]), " ".join(t)))
    rows += [(500, "x", None), (501, None, ""), (502, None, "a b"), (None, None, "a b c d e f"), rows[0], (503, None, "long " * 20_000)]
    frame = spark.createDataFrame([(*x, 1, 2) for x in rows], "rec_id bigint, title string, main_text string, a int, gram int")
    got = [tuple(x) for x in near_duplicate_pairs(frame).collect()]
    want = brute_pairs(rows)
    assert set(got) == want and len(got) == len(want) and want
    links = {x.rec_id: x.copies - 1 + x.links for x in near_duplicate_links(frame.where("rec_id > 0")).collect()}
    count = Counter(x for p in want if 0 not in p for x in p)
    assert all(links[rec] == count[rec] for rec in links)
    assert near_duplicate_pairs(frame.limit(0)).count() == 0


def least_containers(items, capacity):
    """Fewest containers, by exhaustive search."""
    best = [len(items)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in {room: k for k, room in enumerate(rooms) if room >= items[i]}.values():
            place(i + 1, rooms[:k] + [rooms[k] - items[i]] + rooms[k + 1 :])
        place(i + 1, rooms + [capacity - items[i]])

    place(0, [])
    return best[0]


def test_dominance_loses_no_container():
    r = random.Random(6)
    for _ in range(60):
        capacity = r.choice([10, 17, 30])
        items = sorted((r.randint(1, capacity) for _ in range(r.randint(1, 9))), reverse=True)
        fixed, rest = reduce_by_dominance(Counter(items), capacity)
        left = sorted((s for s, n in rest.items() for _ in range(n)), reverse=True)
        assert sum(m for _, m in fixed) + least_containers(left, capacity) == least_containers(items, capacity)


@pytest.mark.parametrize("capacity", [1, 7, 100])
def test_patterns_hold_all_items(capacity):
    r = random.Random(capacity)
    items = Counter(r.randint(1, capacity) for _ in range(500))
    for patterns in (pack_counts(items, capacity), best_fit(items, capacity)):
        got = Counter()
        for p, m in patterns:
            assert sum(p) <= capacity and m > 0
            for s in p:
                got[s] += m
        assert got == items
    assert pack_counts({}, capacity) == []


def test_containers(spark):
    r = random.Random(9)
    sizes = [(i, 40 if i % 3 else r.choice([0, 3, 9, 20, 25, 60, 130, 200])) for i in range(300)]  # one size for two thirds of the rows
    frame = spark.createDataFrame([(*x, "z") for x in [*sizes, (900, None)]], "doc_id bigint, tokens int, size string")
    specs = spark.createDataFrame([("small", 50), ("big", 200), (None, 5), ("none", 0)], "container_kind string, capacity_tokens int")
    placed = fill_containers(frame, specs)
    rows = placed.collect()
    for kind, capacity in (("small", 50), ("big", 200)):
        mine = [x for x in rows if x.container_kind == kind]
        load, doc = Counter(), Counter()
        for x in mine:
            load[x.container_no] += x.tokens
            doc[x.doc_id] += x.tokens
        assert max(load.values()) <= capacity and set(load) == set(range(1, len(load) + 1))
        assert doc == Counter({d: n for d, n in sizes if n}) and len({(x.doc_id, x.piece_no) for x in mine}) == len(mine)
        assert all(n > capacity for d, n in sizes if sum(x.doc_id == d for x in mine) > 1)
    assert {x.container_kind for x in fill_summary(placed, specs).collect()} == {"small", "big"}
    assert fill_containers(frame.limit(0), specs).count() == 0 and fill_containers(frame, specs.limit(0)).count() == 0


def test_headers_that_recur_in_a_source(spark):
    rows = [(i, f"Titel {'abcdefghijklm'[i]}", "s", "text of the page", f"Mitteilungsblatt des Verbandes {i}\nDer Hersteller meldet einen Vorgang.\nSeite {i}\nSitz der Redaktion") for i in range(12)]
    rows += [(100 + i, "same", "t", "x", "Eine Zeile ohne Punkt\nText steht hier.") for i in range(20)]
    rows += [(200, None, None, None, "Mitteilungsblatt des Verbandes 3"), (201, "t", "s", "", " \n "), (202, "t", "s", "", "?!")]
    frame = spark.createDataFrame(rows, "rec_id bigint, title string, source_name string, main_text string, image_ocr_text string").withColumn("known", F.lit(1))
    got = {(r.rec_id, r.line_no) for r in scan_noise(frame).collect() if r.kind == "drop"}
    assert got == {(i, n) for i in range(12) for n in (1, 3, 4)}
    assert scan_noise(frame.drop("source_name")).where("kind = 'drop'").count() == 12


def test_sets_that_fit_best():
    from presslake.llm.containers import best_fit_sets

    r = random.Random(11)
    for _ in range(300):
        capacity = r.choice([7, 20, 64])
        counts = Counter(r.randint(1, capacity) for _ in range(r.randint(0, 60)))
        for way in (best_fit_sets, pack_counts):
            placed: Counter = Counter()
            for pattern, m in way(dict(counts), capacity):
                assert m > 0 and sum(pattern) <= capacity
                for s in pattern:
                    placed[s] += m
            assert placed == counts
        used = [sum(m for _, m in way(dict(counts), capacity)) for way in (pack_counts, best_fit)]
        assert -(-sum(s * n for s, n in counts.items()) // capacity) <= used[0] <= used[1] + 1
    assert sum(m for _, m in best_fit_sets({6: 10**9, 3: 10**9, 4: 10**9}, 10)) == 10**9 + -(-(10**9) // 3)


def test_hot_ngrams_and_many_tasks_change_nothing(spark):
    from presslake.llm.near_records import _sketch, ngram_sets, similar_sets

    r = random.Random(3)
    texts = [" ".join(r.choice("abcdefg") for _ in range(r.choice([6, 9, 14, 30]))) for _ in range(80)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, "a b"), (901, "")], "rec_id bigint, text string")
    sets = ngram_sets(rows, 2)
    assert sets.count() == 81 and ngram_sets(rows.where("rec_id = 901"), 2).count() == 0
    plain = {tuple(x) for x in similar_sets(sets).collect()}
    assert plain and plain == {tuple(x) for x in similar_sets(sets, hot=2).collect()}
    few = _sketch(sets)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100")
        assert (_sketch(sets.repartition(3)) == few).all() and few.any()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
