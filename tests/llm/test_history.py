import random

import numpy as np
import pytest

from presslake.llm.history import HistoryIndex, SmallWorld, duplicates_of_accepted, identifier_key, page_key, signatures, tuned_beam

SCHEMA = "rec_id bigint, batch_no int, article_id string, link string, key string, n string"


def brute(rows):
    ids, links, out = {}, {}, set()
    for rec, _, a, link in sorted(((r[0], r[1] or 0, r[2], r[3]) for r in rows if r[0] is not None), key=lambda r: (r[1], r[0])):
        a, link = identifier_key(a), page_key(link)
        held = ids.get(a) if a else None
        held = held if held is not None else (links.get(link) if link else None)
        if held is None:
            ids.update({a: rec} if a else {})
            links.update({link: rec} if link else {})
        elif held != rec:
            out.add((held, rec))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "n") for r in rows], SCHEMA)


@pytest.mark.parametrize(
    "one, other",
    [
        ("https://www.a.example/s/AbC", "http://m.A.example:80//s/AbC/?utm_source=x&gclid=1#top"),
        ("https://a.example/s?b=1&a=2", "https://a.example/s?a=2&amp;b=1&share_token=z"),
        ("https://a.example/资讯/x-y", " https://a.example/%E8%B5%84%E8%AE%AF/x%2Dy\n"),
        ("https://a.example/x", "https://a.example/x#:~:text=seal"),
    ],
)
def test_same_page(one, other):
    assert page_key(one) == page_key(other)


@pytest.mark.parametrize("one, other", [("http://a/s/AbC", "http://a/s/abc"), ("http://a/s?idx=1", "http://a/s?idx=2"), ("http://mp.a.example/x", "http://a.example/x"), ("http://a/x?lang=en", "http://a/x?lang=de")])
def test_other_page(one, other):
    assert page_key(one) != page_key(other)


def test_identifiers():
    same = ["{D1BB20B2-cb31-3512-4877-e04200003eee}", "urn:uuid:d1bb20b2-cb31-3512-4877-e04200003eee", "guid:d1bb20b2cb3135124877e04200003eee ", "D1BB20B2CB3135124877E04200003EEE"]
    assert len(set(map(identifier_key, same))) == 1
    assert len(set(map(identifier_key, ["1000010828", "id:1000010828", "１００００１０８２８", "001000010828"]))) == 1
    assert len(set(map(identifier_key, ["ZOR-2025-000012047", "zor/2025/000012047", "ZOR 2025 000012047", "ZOR2025000012047"]))) == 1
    assert [identifier_key(x) for x in (None, "", "  ", "-")] == [None] * 4 and page_key(" ") is None


def test_small_world_finds_what_exhaustive_search_finds():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 50, 5000):
        points = r.integers(0, 2**64, n, dtype=np.uint64)
        points[: n // 2] &= np.uint64(0xFFFF)  # half of them close together
        graph = SmallWorld.over(points)
        assert tuned_beam(graph, points) == (1, 1.0)
        other = r.integers(0, 2**64, 100, dtype=np.uint64)
        node = graph.search(other)
        if n:  # no point has a longer beginning in common with the target than the node found
            shared = lambda a, b: 64 - np.array([int(x).bit_length() for x in a ^ b])
            assert all(shared(graph.points[node[i : i + 1]], t)[0] == max(shared(graph.points, t)) for i, t in enumerate(other))
        else:
            assert (node == -1).all()


def test_widened_beam_finds_similar_writings():
    keys = [f"site{i % 7}.example/{'news' if i % 2 else 'tender'}/{i * 7919 % 100003}/notice-on-item-{i}?" for i in range(3000)]
    graph = SmallWorld.over(signatures(keys))
    asked = signatures([k + "x" for k in keys[::30]])
    narrow, wide = tuned_beam(graph, asked, 0.0)[1], tuned_beam(graph, asked, 0.9)
    assert wide[1] >= 0.9 > 0 and wide[1] >= narrow and wide[0] > 1
    a, b, c = signatures(["a.example/news/one-two-three-four", "a.example/news/one-two-three-five", "zzz 123"])
    assert int(a ^ b).bit_count() < int(a ^ c).bit_count() and signatures([]).size == 0


@pytest.mark.parametrize("replay", [0, 10**6])
def test_against_brute_force(spark, replay):
    r = random.Random(5)
    ids = [None, "", *(f"10000{i}" for i in range(25))]
    links = [None, " ", *(f"http://x.example/s/{i}" for i in range(25))]
    rows = [(i, r.choice([0, 0, 1, 2, None]), r.choice(ids), r.choice(links)) for i in range(150)]
    rows += [(1000 + i, 3, "7", f"http://x.example/hot{i}") for i in range(60)]  # one key for a third of the rows
    rows += [rows[3], rows[-1], (None, 1, "7", None)]
    got = duplicates_of_accepted(frame(spark, rows), replay_edges=replay).collect()
    assert {tuple(x) for x in got} == brute(rows) and len(got) == len({x.rec_id_b for x in got})


def test_rejected_rows_hold_no_keys(spark):
    rows = [(1, 0, "a", "http://x.example/1"), (2, 1, "a", "http://x.example/2"), (3, 1, "b", "http://x.example/2")]
    assert [tuple(x) for x in duplicates_of_accepted(frame(spark, rows)).collect()] == [(1, 2)]
    assert duplicates_of_accepted(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("shard_keys", [7, 1000])
def test_index_gives_the_same_by_batches(spark, tmp_path, shard_keys):
    r = random.Random(8)
    rows = [(i, i // 20, r.choice([None, *map(str, range(30))]), r.choice([None, *(f"http://x.example/{k}" for k in range(40))])) for i in range(100)]
    index, got = HistoryIndex(spark, f"{tmp_path}/index", fan_in=3, shard_keys=shard_keys), set()
    for b in range(5):
        got |= {tuple(x) for x in index.screen(frame(spark, [x for x in rows if x[1] == b])).collect()}
    assert got == brute(rows) and len(index._manifest()["segments"]) < 3
    recalls = [s.recall for seg in index._manifest()["segments"] for s in index._shards(seg).select("recall").collect()]
    assert recalls and min(recalls) == 1.0
    index.compact(all_segments=True)
    (segment,) = index._manifest()["segments"]
    assert index._shards(segment).count() >= (5 if shard_keys == 7 else 1)
    again = index.screen(frame(spark, [(1000, 9, "3", None), (1001, 9, "new", None)])).collect()
    assert len(again) == 1 and again[0].rec_id_b == 1000
    assert index.screen(frame(spark, [(1002, 10, None, "")])).count() == 0


def test_a_batch_reads_no_more_as_the_history_grows(spark, tmp_path):
    import os

    sizes = []
    for n in (300, 3000):
        index = HistoryIndex(spark, f"{tmp_path}/index{n}", shard_keys=20)
        index.screen(frame(spark, [(i, 0, f"id{i}", None) for i in range(n)]))
        index.screen(frame(spark, [(10_000 + i, 1, f"id{i * 17}", None) for i in range(5)]))
        assert len(index.read_files) <= 5
        sizes.append(sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in index.read_files))
    assert sizes[1] < 2 * sizes[0]


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    index = HistoryIndex(spark, f"{tmp_path}/index")
    index.screen(frame(spark, [(1, 0, "a", None)]))
    state = {"number": 0, "segments": [], "retired": []}
    with pytest.raises(Exception, match="exists"):
        index._commit(state, [], [])
    assert len(index._manifest()["segments"]) == 1


def test_each_batch_is_searched_and_stored_by_itself(spark, tmp_path, monkeypatch):
    screened, states, screen, commit = [], [], HistoryIndex.screen_edges, HistoryIndex._commit

    def watched(self, edges):
        screened.append(sorted({x.batch_no for x in edges.select("batch_no").collect()}))
        return screen(self, edges)

    def committed(self, before, segments, retired):
        states.append((len(segments), len(retired)))
        return commit(self, before, segments, retired)

    monkeypatch.setattr(HistoryIndex, "screen_edges", watched)
    monkeypatch.setattr(HistoryIndex, "_commit", committed)
    rows = [(100 * b + i, b or None, f"id{50 * b + i}", f"http://x.example/{b}/{i % 40}") for b in range(7) for i in range(60)]
    got = duplicates_of_accepted(frame(spark, rows), HistoryIndex(spark, f"{tmp_path}/index"))
    assert {tuple(x) for x in got.collect()} == brute(rows)
    assert screened == [[b] for b in range(7)]  # none beside another
    assert sum(not retired for _, retired in states) == 7 and any(retired > 1 for _, retired in states)  # a segment each, and compaction
