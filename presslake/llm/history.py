"""Problem 2: duplicates of new deliveries among everything accepted before.

Rows are known by two keys, of the article id and of the page a link leads to, in
one canonical writing; near-duplicate writings have the same key.  A row is
accepted if no accepted row holds either key.

Accepted keys are kept in a :class:`HistoryIndex`, a folder of graph shards.  A key
is a point of 64 bits: the signs of its character trigrams (similar writings lie
near each other), then bits of its hash.  The shards of a segment divide its keys by
hash into buckets of about SHARD_KEYS; each holds a navigable small-world graph
(:class:`SmallWorld`) and the full keys.

1. A batch is searched in the stored shards that its keys fall into and in no other,
   so what is read for a batch does not grow with the history.  The nodes that the
   beam finds are ranked by comparing full keys.  The beam of a shard is the
   narrowest that finds what exhaustive search finds for a sample of its keys.
2. Only rows with a key found need the order of delivery.  In rounds, every
   undecided row that is first at all of its keys is accepted, and undecided rows
   that share a key with it are rejected.  What remains when it is small
   (REPLAY_EDGES) is replayed in order in one task, with the same result.
3. Keys of accepted rows become a new segment.  When FAN_IN segments have gathered,
   those that are not much larger than what came after them are compacted into one,
   with more buckets if there are more keys.  A manifest names the segments; it is
   written last and never over another one."""

from __future__ import annotations

import html
import json
import re
import unicodedata as ud
import uuid
from functools import reduce
from itertools import combinations
from urllib.parse import unquote, unquote_plus

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.session import cut_lineage, ensure_checkpoint_dir

#: Conflicting (row, key) pairs up to which one task replays them: about 40 MB.
REPLAY_EDGES = 400_000
#: Keys per shard, and segments after which the newest are compacted.
SHARD_KEYS, FAN_IN = 100_000, 4
#: Shards that a batch touches up to which they are named one by one; more are found by a join.
NAMED_SHARDS = 1_000
#: Keys of a shard on which its beam is tuned.
TUNED_KEYS = 256
#: Bits of a point that come from trigrams; the others are a hash.
SHAPE_BITS = 32
KEY = ["kind", "h1", "h2"]

# Parameters that say where a reader came from or which session it is.
TRACKING = set(
    """gclid gclsrc dclid fbclid msclkid yclid twclid ttclid igshid wbraid gbraid mc_cid mc_eid _ga _gl _sp spm scm scene
    subscene ascene from ref referer referrer refer share share_token share_source sharer_shareid sharer_sharetime
    isappinstalled clicktime enterid chksm exportkey pass_ticket wx_header nettype sessionid session_id session sid
    phpsessid jsessionid aspsessionid cfid cftoken tracking_id trk cmpid""".split()
)
_ADDRESS = re.compile(r"(?:([a-z][a-z0-9+.\-]*):)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?\Z", re.I | re.S)
_BARE = re.compile(r"[\w\-]+(?:\.[\w\-]+)+(?::\d+)?(?:[/?#]|\Z)")
_PREFIX = re.compile(r"(?:urn:)?(?:uuid|guid|oid|id)[:=]\s*")


def page_key(link: str | None) -> str | None:
    """What chooses the page of an address: host without www or m, path, and the
    parameters but those of tracking and sessions, in sorted order.  None for
    null, blank and non-addresses without any letter or digit."""
    if not isinstance(link, str):
        return None
    link = "".join(c for c in link.strip() if c > " " and ud.category(c) not in ("Cc", "Cf"))
    for _ in range(3):
        if "&" in link and (plain := html.unescape(link)) != link:
            link = plain
        else:
            break
    m = _ADDRESS.match(link) or (_BARE.match(link) and _ADDRESS.match("//" + link))
    if not m:
        key = "".join(c for c in ud.normalize("NFKC", link) if not c.isspace())
        return key if any(c.isalnum() for c in key) else None
    _, host, path, query, fragment = m.groups()
    host = ud.normalize("NFKC", unquote(host.rpartition("@")[2])).lower()
    host = re.sub(r":(?:80|443)?\Z", "", host).rstrip(".")
    while (short := re.sub(r"\A(?:www|m)\.(?=[^.]+\.)", "", host)) != host:
        host = short
    path = re.sub(r"(?i);(?:jsessionid|phpsessid|sid)=[^/;]*", "", path)
    parts: list[str] = []
    for part in path.split("/"):
        part = ud.normalize("NFC", unquote(part)).replace("/", "%2F")
        if part == ".." and parts:
            parts.pop()
        elif part not in ("", ".", ".."):
            parts.append(part)
    pairs = []
    for pair in (query or "").split("&"):
        name, eq, value = pair.partition("=")
        name = unquote_plus(name).strip()
        if name and not name.lower().startswith("utm_") and name.lower() not in TRACKING:
            pairs.append(f"{name}={ud.normalize('NFC', unquote_plus(value))}")
    anchor = "#" + unquote(fragment) if fragment and fragment[0] in "!/" else ""
    return f"{host}/{'/'.join(parts)}?{'&'.join(sorted(pairs))}{anchor}"


def identifier_key(article_id: str | None) -> str | None:
    """One writing of an identifier: the page for addresses, else its letters and
    digits in lower case, without a scheme in front, without leading zeros if it
    is a number.  None for null, blank and signs only."""
    if not isinstance(article_id, str):
        return None
    text = ud.normalize("NFKC", article_id).strip()
    if "//" in text:
        return page_key(article_id)
    text = "".join(c for c in _PREFIX.sub("", text.casefold(), count=1) if c.isalnum())
    if text.isdigit():
        text = text.lstrip("0") or "0"
    return text or None


def signatures(keys: list[str]) -> np.ndarray:
    """The point of each key: for SHAPE_BITS bits whether more of its character trigrams
    have them than not, then bits of a hash of the whole key."""
    low = np.fromiter((xxhash.xxh32_intdigest(k.encode("utf-8", "surrogatepass")) for k in keys), np.uint64, len(keys))
    out = np.zeros(len(keys), np.uint64)
    for i in range(0, len(keys), 2000):
        part = ["\x02" + k + "\x03\x03" for k in keys[i : i + 2000]]
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        grams = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (codes[2:] * np.uint64(0x165667B19E3779F9))
        grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        starts = np.cumsum(lengths) - lengths
        signs = ((grams[:, None] >> np.arange(20, 20 + SHAPE_BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.int32) * 2 - 1
        ends = np.minimum(starts + lengths - 2, len(grams))
        total = np.concatenate([np.zeros((1, SHAPE_BITS), np.int32), np.cumsum(signs, axis=0, dtype=np.int32)])
        positive = (total[ends] - total[starts] > 0).astype(np.uint64)
        out[i : i + 2000] = (positive << np.arange(63, 63 - SHAPE_BITS, -1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out | low


_EDGES = "batch_no int, rec_id bigint, kind int, h1 bigint, h2 bigint, point bigint"


def _keyed(batches):
    for b in batches:
        at, kinds, keys = [], [], []
        for i, pair in enumerate(zip(map(identifier_key, b["article_id"]), map(page_key, b["link"]))):
            for kind, key in enumerate(pair):
                if key is not None:
                    at.append(i)
                    kinds.append(kind)
                    keys.append(key)
        digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass")) for k in keys), np.int64).reshape(-1, 2)
        yield pd.DataFrame(
            {
                "batch_no": b["batch_no"].to_numpy()[at].astype(np.int32), "rec_id": b["rec_id"].to_numpy()[at].astype(np.int64), "kind": np.array(kinds, np.int32),
                "h1": digests[:, 0], "h2": digests[:, 1], "point": signatures(keys).view(np.int64),
            }
        )


def key_edges(rows: DataFrame) -> DataFrame:
    """(batch_no, rec_id, kind, h1, h2, point): one row per key of a delivered row.  A
    key is its kind (0 identifier, 1 page) and 128 bits of hash."""
    known = rows.where("rec_id is not null").select(F.coalesce(F.col("batch_no"), F.lit(0)).cast("int").alias("batch_no"), F.col("rec_id").cast("bigint").alias("rec_id"), "article_id", "link")
    return known.mapInPandas(_keyed, _EDGES)


def _level(difference: np.ndarray) -> np.ndarray:
    """Number of the first bit set, from the left; 64 for zero."""
    x = difference.copy()
    for k in (1, 2, 4, 8, 16, 32):
        x |= x >> np.uint64(k)
    return (64 - np.bitwise_count(x)).astype(np.uint64)


_BITS = [np.uint64(1 << (63 - i)) for i in range(SHAPE_BITS)]
_FLIPS = [np.uint64(0), *_BITS, *(a ^ b for a, b in combinations(_BITS, 2))]


class SmallWorld:
    """A navigable small-world graph over points of 64 bits; the longer the common
    beginning of two points, the nearer they are.

    A node has one link for each length of beginning it shares with other points, to a
    random one of those that differ in the next bit: few long links, many short ones.
    Every hop of a greedy search lengthens the common beginning with the target if any
    point has a longer one, so the search cannot get stuck before the nearest node."""

    def __init__(self, points: np.ndarray, mask: np.ndarray, links: np.ndarray):
        self.points, self.mask, self.links = points, mask, links
        self.first = np.cumsum(np.bitwise_count(mask), dtype=np.int64) - np.bitwise_count(mask)

    @classmethod
    def over(cls, points: np.ndarray, seed: int = 1) -> SmallWorld:
        points = np.unique(points.astype(np.uint64))
        n, r = len(points), np.random.default_rng(seed)
        mask, nodes, levels, targets = np.zeros(n, np.uint64), [], [], []
        at, lo, hi = np.arange(n), np.zeros(n, np.int64), np.full(n, n, np.int64)
        for level in range(64):
            at, lo, hi = (x[hi - lo > 1] for x in (at, lo, hi))  # alone with its beginning: no more links
            if not len(at):
                break
            bit = np.uint64(1 << (63 - level))
            split = np.searchsorted(points, (points[at] & ~(bit - np.uint64(1))) | bit)
            above = points[at] & bit > 0
            a, b = np.where(above, lo, split), np.where(above, split, hi)
            has = b > a
            mask[at[has]] |= bit
            nodes.append(at[has])
            levels.append(np.full(has.sum(), level, np.int8))
            targets.append((a + (r.random(len(at)) * (b - a)).astype(np.int64))[has].astype(np.int32))
            lo, hi = np.where(above, split, lo), np.where(above, hi, split)
        order = np.lexsort((np.concatenate(levels), np.concatenate(nodes))) if nodes else np.zeros(0, np.int64)
        return cls(points, mask, np.concatenate(targets)[order] if nodes else np.zeros(0, np.int32))

    def _walk(self, targets: np.ndarray) -> np.ndarray:
        at = np.full(len(targets), len(self.points) // 2, np.int64)
        open_ = np.arange(len(targets))
        while len(open_):
            here = at[open_]
            level = _level(self.points[here] ^ targets[open_])
            shift = np.uint64(63) - np.minimum(level, np.uint64(63))
            tail = self.mask[here] >> shift
            on = (level < 64) & ((tail & np.uint64(1)) > 0)
            open_, here, tail = open_[on], here[on], tail[on]
            at[open_] = self.links[self.first[here] + np.bitwise_count(tail >> np.uint64(1))]
        return at

    def search(self, targets: np.ndarray, beam: int = 1) -> np.ndarray:
        """For each target the node with the fewest differing bits that ``beam`` walkers
        find; -1 in an empty graph.  The first walker goes to the target, the others to
        where it would be if one or two of its leading bits were different."""
        targets = targets.astype(np.uint64)
        if not len(self.points):
            return np.full(len(targets), -1, np.int64)
        best = self._walk(targets)
        for flipped in _FLIPS[1:beam]:
            end = self._walk(targets ^ flipped)
            for other in (end, np.maximum(end - 1, 0), np.minimum(end + 1, len(self.points) - 1)):  # and its neighbours in order
                nearer = self.distance(other, targets) < self.distance(best, targets)
                best = np.where(nearer, other, best)
        return best

    def distance(self, nodes: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Differing bits of the part of points that comes from trigrams; the rest breaks ties."""
        x = self.points[nodes] ^ targets
        return np.bitwise_count(x >> np.uint64(64 - SHAPE_BITS)).astype(np.int64) * 64 + np.bitwise_count(x << np.uint64(SHAPE_BITS))


def tuned_beam(graph: SmallWorld, targets: np.ndarray, least: float = 1.0, widest: int = len(_FLIPS)) -> tuple[int, float]:
    """The narrowest beam, doubled from 1, with which the share ``least`` of ``targets``
    gets a node as near as exhaustive search finds one, and the share it reaches."""
    targets = targets.astype(np.uint64)
    if not len(graph.points) or not len(targets):
        return 1, 1.0
    every = np.arange(len(graph.points))
    nearest = np.array([graph.distance(every, t).min() for t in targets])
    beam = 1
    while True:
        recall = float((graph.distance(graph.search(targets, beam), targets) <= nearest).mean())
        if recall >= least or beam >= widest:
            return beam, recall
        beam = min(2 * beam, widest)


_SHARD = "keys bigint, beam int, recall double, points binary, mask binary, links binary, kind binary, h1 binary, h2 binary, rec binary"


def _shard(key, rows: pd.DataFrame) -> pd.DataFrame:
    """One shard: keys by point with their rows, and the graph over the points."""
    rows = rows.drop_duplicates(KEY)
    order = np.argsort(rows["point"].to_numpy().view(np.uint64), kind="stable")
    points = rows["point"].to_numpy().view(np.uint64)[order]
    graph = SmallWorld.over(points)
    beam, recall = tuned_beam(graph, points[:: max(1, len(points) // TUNED_KEYS)])
    column = lambda c, kind: rows[c].to_numpy()[order].astype(kind).tobytes()
    row = [key[0], len(rows), beam, recall, points.tobytes(), graph.mask.tobytes(), graph.links.tobytes(), column("kind", np.int8), column("h1", np.int64), column("h2", np.int64), column("rec_id", np.int64)]
    return pd.DataFrame([row], columns=["bucket", "keys", "beam", "recall", "points", "mask", "links", "kind", "h1", "h2", "rec"])


def _opened(shard) -> tuple[SmallWorld, np.ndarray, pd.DataFrame]:
    points = np.frombuffer(shard.points, np.uint64)
    keys = pd.DataFrame({"kind": np.frombuffer(shard.kind, np.int8).astype(np.int32), "h1": np.frombuffer(shard.h1, np.int64), "h2": np.frombuffer(shard.h2, np.int64), "rec_id": np.frombuffer(shard.rec, np.int64)})
    return SmallWorld(np.unique(points), np.frombuffer(shard.mask, np.uint64), np.frombuffer(shard.links, np.int32)), points, keys


def _look_up(key, asked: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
    """Keys asked for that a shard holds, with their rows: search, then comparison in full."""
    out = [pd.DataFrame({"kind": np.zeros(0, np.int32), "h1": np.zeros(0, np.int64), "h2": np.zeros(0, np.int64), "holder": np.zeros(0, np.int64)})]
    if len(asked):
        for shard in shards.itertuples(index=False):
            graph, points, keys = _opened(shard)
            target = asked["point"].to_numpy().view(np.uint64)
            node = graph.search(target, shard.beam)
            first = np.searchsorted(points, graph.points[node])
            left = np.arange(len(asked))
            while len(left):  # keys of one point, nearly always a single one
                same = np.ones(len(left), bool)
                for c in KEY:
                    same &= keys[c].to_numpy()[first[left]] == asked[c].to_numpy()[left]
                hit = asked.iloc[left[same]]
                out.append(hit[KEY].assign(holder=keys["rec_id"].to_numpy()[first[left[same]]]))
                left = left[~same]
                first[left] += 1
                left = left[first[left] < len(points)]
                left = left[points[first[left]] == graph.points[node[left]]]
    return pd.concat(out).astype({"kind": "int32"})


def _bucket(bits: int):
    return F.shiftrightunsigned("h1", 64 - bits).cast("int") if bits else F.lit(0)


def _order():
    return F.struct("batch_no", "rec_id")


def _replay(edges: pd.DataFrame) -> pd.DataFrame:
    """Accepted rows of undecided ones, by going through them in order."""
    held, out = set(), []
    for row, group in edges.sort_values(["batch_no", "rec_id"]).groupby(["batch_no", "rec_id"], sort=False):
        keys = set(zip(group["kind"], group["h1"], group["h2"]))
        if not keys & held:
            held |= keys
            out.append(row)
    return pd.DataFrame(out, columns=["batch_no", "rec_id"]).astype({"batch_no": "int32", "rec_id": "int64"})


def settle(edges: DataFrame, found: DataFrame, replay_edges: int = REPLAY_EDGES) -> DataFrame:
    """(rec_id_a, rec_id_b) of rows that are not accepted.  ``edges`` are the keys of a
    batch, ``found`` (kind, h1, h2, holder) those that an accepted row (holder) or
    several rows of the batch (holder null) have."""
    row = ["batch_no", "rec_id"]
    conflicts = cut_lineage(edges.drop("point").join(found, KEY))
    late = conflicts.where("holder is not null").select(*row).distinct()
    open_ = conflicts.drop("holder").join(late, row, "left_anti").distinct()
    accepted = []
    while (left := open_.count()) > replay_edges:
        open_ = open_ if accepted else cut_lineage(open_)
        first = open_.groupBy(*KEY).agg(F.min(_order()).alias("first"))
        at = open_.join(first, KEY).withColumn("is_first", _order() == F.col("first"))
        now = cut_lineage(at.groupBy(*row).agg(F.bool_and("is_first").alias("all_first")).where("all_first").select(*row))
        accepted.append(now)
        taken = open_.join(now, row, "left_semi").select(*KEY).distinct()
        decided = open_.join(taken, KEY, "left_semi").select(*row).distinct()  # the accepted and those that share a key with one
        open_ = cut_lineage(open_.join(decided, row, "left_anti"))
    if left:
        accepted.append(cut_lineage(open_.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(lambda e: _replay(e), "batch_no int, rec_id bigint")))
    holders = conflicts.where("holder is not null").select(*KEY, F.lit(None).cast("int").alias("batch_a"), F.col("holder").alias("rec_a")).distinct()
    rejected = conflicts.drop("holder")
    if accepted:
        rows = reduce(DataFrame.unionByName, accepted)
        holders = holders.unionByName(rejected.join(rows, row, "left_semi").select(*KEY, F.col("batch_no").alias("batch_a"), F.col("rec_id").alias("rec_a")).distinct())
        rejected = rejected.join(rows, row, "left_anti")
    before = F.col("batch_a").isNull() | (F.struct(F.col("batch_a").alias("batch_no"), F.col("rec_a").alias("rec_id")) < _order())
    named = rejected.join(holders, KEY).where(before & (F.col("rec_a") != F.col("rec_id"))).groupBy(*row).agg(F.min_by("rec_a", F.struct(*KEY)).alias("rec_id_a"))
    return named.select("rec_id_a", F.col("rec_id").alias("rec_id_b"))


class HistoryIndex:
    """Graph shards of the keys of all accepted rows, in a folder that all executors share.

    ``screen`` gives the cases of a batch and adds the keys of its accepted rows as a
    new segment.  One writer at a time: of two that add to the same state one fails
    when it writes the manifest, and its segment is named by none."""

    def __init__(self, spark: SparkSession, folder: str, fan_in: int = FAN_IN, shard_keys: int = SHARD_KEYS, replay_edges: int = REPLAY_EDGES):
        self.spark, self.folder, self.fan_in, self.shard_keys, self.replay_edges = spark, folder.rstrip("/"), fan_in, shard_keys, replay_edges
        self.read_files: list[str] | None = None  # shard files that the last search named one by one

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self) -> dict:
        """The last state: number, segments (name, bits, keys) and segments it replaced."""
        path, fs = self._path()
        names = sorted(n for n in (s.getPath().getName() for s in (fs.listStatus(path) if fs.exists(path) else [])) if n.startswith("manifest-"))
        if not names:
            return {"number": 0, "segments": [], "retired": []}
        last, fs = self._path(names[-1])
        stream = fs.open(last)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, before: dict, segments: list[dict], retired: list[str]) -> None:
        state = {"number": before["number"] + 1, "segments": segments, "retired": retired}
        path, fs = self._path(f"manifest-{state['number']:08d}.json")
        out = fs.create(path, False)  # fails if another writer was faster
        out.write(json.dumps(state).encode())
        out.close()
        for name in before["retired"]:  # replaced one state earlier: readers of the last state are not disturbed
            old, fs = self._path(name)
            fs.delete(old, True)

    def _write(self, keys: DataFrame, most: int) -> dict:
        """A segment of ``keys``, of which there are ``most`` at most."""
        bits = max(0, int(np.ceil(np.log2(max(1, most) / self.shard_keys))))
        shards = keys.withColumn("bucket", _bucket(bits)).groupBy("bucket").applyInPandas(_shard, f"bucket int, {_SHARD}")
        name = f"segment-{uuid.uuid4().hex}"
        shards.write.partitionBy("bucket").parquet(f"{self.folder}/{name}")
        segment = {"name": name, "bits": bits}
        held = self._shards(segment).agg(F.sum("keys")).first()[0] if self._has_shards(name) else 0
        return segment | {"keys": int(held or 0)}

    def _has_shards(self, name: str) -> bool:
        path, fs = self._path(name)
        return any(s.getPath().getName().startswith("bucket=") for s in fs.listStatus(path))

    def _shards(self, segment: dict) -> DataFrame:
        return self.spark.read.schema(f"{_SHARD}, bucket int").parquet(f"{self.folder}/{segment['name']}")

    def search(self, keys: DataFrame, n: int) -> DataFrame:
        """(kind, h1, h2, holder) of ``n`` distinct ``keys`` (kind, h1, h2, point) that accepted rows hold."""
        found, self.read_files = None, []
        for segment in self._manifest()["segments"]:
            asked = keys.withColumn("bucket", _bucket(segment["bits"]))
            touched = asked.select("bucket").distinct() if n < 4 << segment["bits"] else None  # else nearly all shards
            if touched is not None and n <= NAMED_SHARDS:
                named = [f"{segment['name']}/bucket={r[0]}" for r in touched.collect()]
                named = [name for name in named if (at := self._path(name))[1].exists(at[0])]
                if not named:
                    continue
                shards = self.spark.read.schema(f"{_SHARD}, bucket int").option("basePath", f"{self.folder}/{segment['name']}").parquet(*[f"{self.folder}/{name}" for name in named])
                self.read_files += shards.inputFiles()
            else:
                shards = self._shards(segment)
                if touched is not None:
                    shards = shards.join(touched, "bucket", "left_semi")
            part = asked.groupBy("bucket").cogroup(shards.groupBy("bucket")).applyInPandas(_look_up, "kind int, h1 bigint, h2 bigint, holder bigint")
            found = part if found is None else found.unionByName(part)
        return None if found is None else cut_lineage(found)

    def screen(self, batch: DataFrame) -> DataFrame:
        """The cases of a batch, see :func:`duplicates_of_accepted`; its accepted rows are
        added.  Rows of several batches may come together, in their order of delivery."""
        return self.screen_edges(cut_lineage(key_edges(batch)))

    def screen_edges(self, edges: DataFrame) -> DataFrame:
        """:meth:`screen` for the stored keys of a batch."""
        counts = cut_lineage(edges.groupBy(*KEY, "point").agg(F.count(F.lit(1)).alias("n")))  # a key of many rows is one
        n = counts.count()
        if not n:
            return edges.select(F.col("rec_id").alias("rec_id_a"), F.col("rec_id").alias("rec_id_b"))
        held = self.search(counts.select(*KEY, "point"), n)
        again = counts.where("n > 1").select(*KEY)
        found = again.withColumn("holder", F.lit(None).cast("bigint")) if held is None else again.join(held, KEY, "full_outer").select(*KEY, "holder")
        cases = cut_lineage(settle(edges, found, self.replay_edges))
        new = edges.join(cases.select(F.col("rec_id_b").alias("rec_id")), "rec_id", "left_anti").groupBy(*KEY, "point").agg(F.min("rec_id").alias("rec_id"))
        if held is not None:  # a row delivered again under its own number is no case and is there already
            new = new.join(held.select(*KEY), KEY, "left_anti")
        segment, state = self._write(new, n), self._manifest()
        if segment["keys"]:
            self._commit(state, [*state["segments"], segment], [])
            self.compact()
        else:
            empty, fs = self._path(segment["name"])
            fs.delete(empty, True)
        return cases

    def compact(self, all_segments: bool = False) -> None:
        """Makes one segment of the newest ones when ``fan_in`` have gathered.  A segment
        much larger than all after it stays as it is, so each key is rewritten a number
        of times that grows with the logarithm of the history."""
        state = self._manifest()
        segments, total, start = state["segments"], 0, len(state["segments"])
        if len(segments) < (2 if all_segments else self.fan_in):
            return
        while start and (all_segments or not total or segments[start - 1]["keys"] <= self.fan_in * total):
            start -= 1
            total += segments[start]["keys"]
        old = segments[start:]
        if len(old) < 2:
            return

        def unpacked(batches):
            for b in batches:
                for shard in b.itertuples(index=False):
                    _, points, keys = _opened(shard)
                    yield keys.assign(point=points.view(np.int64))

        keys = reduce(DataFrame.unionByName, [self._shards(s).drop("bucket") for s in old]).mapInPandas(unpacked, "kind int, h1 bigint, h2 bigint, rec_id bigint, point bigint")
        self._commit(state, [*segments[:start], self._write(keys, total)], [s["name"] for s in old])

    def clear(self) -> None:
        path, fs = self._path()
        fs.delete(path, True)


def duplicates_of_accepted(rows: DataFrame, index: HistoryIndex | None = None, **limits) -> DataFrame:
    """Cases (rec_id_a, rec_id_b): row b is not accepted as it has the article id or
    link of the accepted row a.

    ``rows`` needs batch_no, rec_id, article_id and link; delivery order is
    (batch_no, rec_id), a null batch_no counts as history (0).  The history is screened
    first, then batch after batch: each is searched in the ``index`` of what was accepted
    before and adds its segment to it, and segments are compacted as they gather; without
    one an index is made in the checkpoint folder and removed at the end.  If two accepted rows hold a row's
    keys, the one with its identifier is named.  Null, blank and sign-only keys match
    nothing; rows without rec_id are left out; an empty table gives no cases.  Other
    columns are not read."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/history-{uuid.uuid4().hex}"
    work = HistoryIndex(spark, base)
    numbers = sorted(r[0] for r in rows.select(F.coalesce(F.col("batch_no"), F.lit(0)).cast("int")).distinct().collect())  # one per delivery
    if not numbers:
        return rows.where("false").select(F.col("rec_id").cast("bigint").alias("rec_id_a"), F.col("rec_id").cast("bigint").alias("rec_id_b"))
    # Keys are made once and stored by batch, so that a batch reads its own only.
    key_edges(rows).write.partitionBy("batch_no").parquet(f"{base}/edges")
    edges = spark.read.schema(_EDGES).parquet(f"{base}/edges")
    index = index or HistoryIndex(spark, f"{base}/index", **limits)
    cases = [index.screen_edges(edges.where(F.col("batch_no") == n)) for n in numbers]
    work.clear()
    return reduce(DataFrame.unionByName, cases)
