"""Problem 8: token ids of a whole corpus under a public byte-level BPE.

Speculate and verify.  A word is cut greedily into the longest tokens of the
vocabulary.  A sequence of tokens is what merging would give exactly if each
token alone encodes to itself and every adjacent pair is compatible, that is if
merging the bytes of the two tokens gives just these two.  Proposed pairs are
tested together with numpy against the pairs decided before; only words with an
incompatible pair are merged exactly."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files lie by default; every entry point takes the path as a parameter.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published word pattern of the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words, and pairs of tokens, remembered per worker; beyond it the memory is emptied, never the result changed.
REMEMBERED, REMEMBERED_PAIRS = 400_000, 2_000_000


class ByteBpe:
    def __init__(self, data: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for b, i in self.ranks.items():
            self.bytes_of[i] = b
        self.reach: dict[bytes, int] = {}  # longest token by its first two bytes
        for b in self.ranks:
            self.reach[b[:2]] = max(self.reach.get(b[:2], 1), len(b))
        self.width = len(self.bytes_of)
        self.words: dict[str, list[int]] = {}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.split = regex.compile(PATTERN).findall

    def merge(self, word: bytes) -> list[int]:
        """Exact merging in order of rank.  Long words use a heap of candidate
        pairs over a linked list, so that time stays near n log n."""
        n = len(word)
        if n > 64:
            return self._merge_long(word)
        parts = [word[i : i + 1] for i in range(n)]
        ranks, get = self.ranks, self.ranks.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        from heapq import heapify, heappop, heappush

        n, get = len(word), self.ranks.get
        end, prev, nxt, alive = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            r, i, stop = heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            end[i], alive[j], nxt[i] = stop, False, nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
                if (q := get(word[i : end[nxt[i]]])) is not None:
                    heappush(heap, (q, i, end[nxt[i]]))
            if (p := prev[i]) >= 0 and (q := get(word[p:stop])) is not None:
                heappush(heap, (q, p, stop))
        return [self.ranks[word[i : end[i]]] for i in range(n) if alive[i]]

    def propose(self, word: bytes) -> list[int]:
        out, i, n, get, reach = [], 0, len(word), self.ranks.get, self.reach.get
        while i < n:
            for j in range(min(n, i + reach(word[i : i + 2], 1)), i, -1):
                if (r := get(word[i:j])) is not None:
                    out.append(r)
                    i = j
                    break
        return out

    def _pair_holds(self, a: int, b: int) -> bool:
        return self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def _token_holds(self, a: int) -> bool:
        if (known := self.whole.get(a)) is None:
            known = self.whole[a] = self.merge(self.bytes_of[a]) == [a]
        return known

    def learn(self, words: list[str]) -> int:
        """Adds ids of new words; returns how many needed exact merging."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        proposed = [[r] if (r := self.ranks.get(b)) is not None else self.propose(b) for b in raw]
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        inside = owner[1:] == owner[:-1]
        keys = (flat[:-1] * self.width + flat[1:])[inside]
        unique, back = np.unique(keys, return_inverse=True)
        holds = np.empty(len(unique), bool)
        for k, key in enumerate(unique.tolist()):
            if (known := self.pairs.get(key)) is None:
                known = self.pairs[key] = self._pair_holds(key // self.width, key % self.width)
            holds[k] = known
        bad = np.zeros(len(words), bool)
        bad[owner[:-1][inside][~holds[back]]] = True
        tokens, where = np.unique(flat, return_inverse=True)
        bad[owner[~np.array([self._token_holds(t) for t in tokens.tolist()], bool)[where]]] = True
        for i in np.flatnonzero(bad):
            proposed[i] = self.merge(raw[i])
        self.words.update(zip(words, proposed))
        return int(bad.sum())

    def encode_batch(self, texts) -> list[list[int]]:
        if len(self.words) > REMEMBERED:
            self.words.clear()
        if len(self.pairs) > REMEMBERED_PAIRS:
            self.pairs.clear()
        cut = [self.split(t) if t else [] for t in texts]
        known = self.words
        if new := list({w for words in cut for w in words if w not in known}):
            self.learn(new)
        out = []
        for words in cut:
            ids: list[int] = []
            for w in words:
                ids += known[w]
            out.append(ids)
        return out


@lru_cache(maxsize=2)
def _tokenizer(digest: str, data: bytes) -> ByteBpe:
    return ByteBpe(data)


def _shipped(frame: DataFrame, vocabulary: str):
    """The vocabulary file, fixed and under 2 MB, as a broadcast value."""
    data = open(vocabulary, "rb").read()
    if len(data) > 8_000_000:
        raise ValueError("no vocabulary file of a public tokenizer is that large")
    return frame.sparkSession.sparkContext.broadcast((hashlib.sha256(data).hexdigest(), data))


def text_slices(texts: list, chars: int = 2_000_000):
    """Index ranges of at most ``chars`` characters, one text at least."""
    begin = total = 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total > chars and i > begin:
            yield begin, i
            begin, total = i, len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


def encode_corpus(frame: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids): token ids of each text, without special tokens.

    Null and empty texts get an empty list; rows without id are left out.  The strings of special tokens are
    ordinary text.  Every row gives a row, repeated rows too; nothing is
    shuffled.  Ids equal those of merging the words of the published pattern."""
    shipped = _shipped(frame, vocabulary)

    def encode(batches):
        bpe = _tokenizer(*shipped.value)
        for b in batches:
            texts = b[text_column].tolist()
            for i, j in text_slices(texts):
                yield pd.DataFrame({id_column: b[id_column].iloc[i:j].to_numpy(), "ids": bpe.encode_batch(texts[i:j])})

    return frame.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("bigint").alias(id_column), F.col(text_column)).mapInPandas(encode, f"{id_column} bigint, ids array<int>")


def token_counts(frame: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, tokens): length of each text in tokens; 0 for null and empty texts."""
    shipped = _shipped(frame, vocabulary)

    def count(batches):
        bpe = _tokenizer(*shipped.value)
        for b in batches:
            texts = b[text_column].tolist()
            n = [len(x) for i, j in text_slices(texts) for x in bpe.encode_batch(texts[i:j])]
            yield pd.DataFrame({id_column: b[id_column].to_numpy(), "tokens": np.array(n, np.int32)})

    return frame.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("bigint").alias(id_column), F.col(text_column)).mapInPandas(count, f"{id_column} bigint, tokens int")
