"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct words of a batch are one small corpus. An inverted index from
token pair to word positions is built over it, and the merges are replayed in
rank order: popping the lowest rank present merges every position that holds
the pair, and only the two touched neighbours of each get new index entries.
The result equals merging each word by itself, lowest rank first and leftmost
first among equals. If a merge creates a pair of a still lower rank, the word
waits until that pair was merged.

Defined cases: null text is empty (no ids, decoded to nothing); texts of any
length are encoded whole; special-token strings are ordinary text; repeated
rows give repeated results; other columns are not read. The vocabulary is a
file of ranks (its size is bounded by the file) sent to the tasks once.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.llm.common import caches, tidy

#: Words of a generation that a worker keeps between batches, and the longest word kept.
CACHE_WORDS = 120_000
CACHE_WORD_CHARS = 64
#: Distinct words from which positions are merged in numpy.
MANY_WORDS = 3_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class MergeReplay:
    """Encodes sets of words against one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token_of = {r: t for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pair_rank: dict[tuple[int, int], int | None] = {}
        # every split of a token into two tokens is a pair that can merge: sorted for vectorised lookups
        pairs = {(ranks[t[:k]] << 32) | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t))
                 if t[:k] in ranks and t[k:] in ranks}
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.byte_id = [ranks[bytes([b])] for b in range(256)]
        self.byte_ids = np.array(self.byte_id, dtype=np.int64)

    def _rank(self, a: int, b: int) -> int | None:
        """Rank of the merge of two tokens, remembered for pairs seen before."""
        key = (a, b)
        try:
            return self.pair_rank[key]
        except KeyError:
            r = self.ranks.get(self.token_of[a] + self.token_of[b])
            if len(self.pair_rank) > 4_000_000:
                self.pair_rank.clear()
            self.pair_rank[key] = r
            return r

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the merges of pairs of tokens, -1 where there is none."""
        key = (a << 32) | b
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word. A word that is itself in the table is that one id."""
        return self.encode_many(words) if len(words) >= MANY_WORDS else self.encode_few(words)

    def encode_many(self, words: list[bytes]) -> list[list[int]]:
        """The replay with all positions of a rank merged together in numpy.

        Merging several pairs of one word at once is leftmost first only while no
        merge opens a lower rank; words in which that happens are replayed alone.
        """
        out: list[list[int]] = [[]] * len(words)
        part = []
        for w, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                out[w] = [whole]
            elif word:
                part.append(w)
        if not part or not len(self.pair_keys):
            return out if not part else self.encode_few(words)
        token = self.byte_ids[np.frombuffer(b"".join([words[w] for w in part]), dtype=np.uint8)]
        size = np.array([len(words[w]) for w in part])
        ends = np.cumsum(size)
        owner = np.repeat(np.arange(len(part)), size)
        follow, before = np.arange(1, len(token) + 1), np.arange(-1, len(token) - 1)
        follow[ends - 1] = -1
        before[ends - size] = -1
        redo = np.zeros(len(part), dtype=bool)
        where: dict[int, list[np.ndarray]] = {}        # inverted index: rank of a pair -> word positions
        queue: list[int] = []

        def note(ranks: np.ndarray, places: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(ranks)]
            for r, lo, hi in zip(ranks[bounds[:-1]].tolist(), bounds[:-1], bounds[1:]):
                if r in where:
                    where[r].append(places[lo:hi])
                else:
                    where[r] = [places[lo:hi]]
                    heapq.heappush(queue, r)

        at = np.flatnonzero(follow >= 0)
        ranks = self._ranks(token[at], token[at + 1])
        note(ranks[ranks >= 0], at[ranks >= 0])
        while queue:
            r = heapq.heappop(queue)
            got = where.pop(r)
            p = np.sort(got[0] if len(got) == 1 else np.concatenate(got))
            p = p[(token[p] >= 0) & (follow[p] >= 0)]
            if not len(p):
                continue
            q = follow[p]
            good = self._ranks(token[p], token[q]) == r    # else merged into a neighbour meanwhile
            if len(p) > 1:
                good[1:] &= p[1:] != p[:-1]
            p, q = p[good], q[good]
            if len(p) > 1 and (chained := q[:-1] == p[1:]).any():
                # runs of overlapping pairs: every other one, from the left
                start = np.maximum.accumulate(np.where(np.concatenate([[True], ~chained]), np.arange(len(p)), 0))
                every = (np.arange(len(p)) - start) % 2 == 0
                p, q = p[every], q[every]
            if not len(p):
                continue
            k, h = follow[q], before[p]
            token[p], token[q] = r, -1                     # a token's id is its rank
            follow[p] = k
            right = k >= 0
            before[k[right]] = p[right]
            h = before[p]
            left = h >= 0
            places = np.concatenate([p[right], h[left]])
            ranks = self._ranks(token[places], token[follow[places]])
            fresh = ranks >= 0
            places, ranks = places[fresh], ranks[fresh]
            if len(ranks):
                lower = ranks < r
                if lower.any():
                    merged = owner[p]
                    many = merged[1:][merged[1:] == merged[:-1]]
                    redo[np.intersect1d(owner[places[lower]], many)] = True
                note(ranks, places)
        alive = np.flatnonzero(token >= 0)
        ids = token[alive].tolist()
        bounds = np.searchsorted(alive, np.concatenate([[0], ends])).tolist()
        for w, lo, hi in zip(part, bounds[:-1], bounds[1:]):
            out[w] = ids[lo:hi]
        again = [part[i] for i in np.flatnonzero(redo)]
        for w, ids in zip(again, self.encode_few([words[w] for w in again])):
            out[w] = ids
        return out

    def encode_few(self, words: list[bytes]) -> list[list[int]]:
        """The replay position by position: cheaper for few words, and exact whatever the table."""
        out: list[list[int] | None] = [None] * len(words)
        token: list[int] = []                 # the corpus: one position per byte
        follow: list[int] = []                # next live position of the word, -1 at its end
        before: list[int] = []
        owner: list[int] = []
        heads: list[tuple[int, int]] = []     # (word, first position)
        where: dict[int, list[int]] = {}      # inverted index: rank of a pair -> positions
        byte_id, rank_of = self.byte_id, self._rank
        for w, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                out[w] = [whole]
                continue
            if not word:
                out[w] = []
                continue
            at, n = len(token), len(word)
            heads.append((w, at))
            token.extend([byte_id[b] for b in word])
            follow.extend(range(at + 1, at + n + 1))
            follow[-1] = -1
            before.extend(range(at - 1, at + n - 1))
            before[at] = -1
            owner.extend([w] * n)
            for i in range(at, at + n - 1):
                r = rank_of(token[i], token[i + 1])
                if r is not None:
                    where.setdefault(r, []).append(i)
        queue = list(where)
        heapq.heapify(queue)
        while queue:
            r = heapq.heappop(queue)
            places = where.pop(r, None)
            if places is None:
                continue
            places.sort()
            waiting: set[int] = set()         # words that got a pair of a lower rank
            later: list[int] = []
            for i in places:
                j = follow[i]
                if token[i] < 0 or j < 0 or rank_of(token[i], token[j]) != r:
                    continue                  # merged into a neighbour meanwhile
                if waiting and owner[i] in waiting:
                    later.append(i)
                    continue
                token[i], token[j] = r, -1    # a token's id is its rank
                k = follow[i] = follow[j]
                if k >= 0:
                    before[k] = i
                    s = rank_of(r, token[k])
                    if s is not None:
                        self._note(where, queue, s, i)
                        if s < r:
                            waiting.add(owner[i])
                h = before[i]
                if h >= 0:
                    s = rank_of(token[h], r)
                    if s is not None:
                        self._note(where, queue, s, h)
                        if s < r:
                            waiting.add(owner[i])
            if later:
                if r in where:
                    where[r].extend(later)
                else:
                    where[r] = later
                    heapq.heappush(queue, r)
        for w, i in heads:
            ids = []
            while i >= 0:
                ids.append(token[i])
                i = follow[i]
            out[w] = ids
        return out

    @staticmethod
    def _note(where: dict[int, list[int]], queue: list[int], rank: int, place: int) -> None:
        if rank in where:
            where[rank].append(place)
        else:
            where[rank] = [place]
            heapq.heappush(queue, rank)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


class Codec:
    """A worker's encoder: merge replay plus two generations of the words seen before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay = MergeReplay(ranks, pattern)
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    def encode_batch(self, texts: list[str | None]) -> Iterator[list[int]]:
        split, young, old = self.replay.split, self.young, self.old
        words = [split(t) if t else [] for t in texts]
        table: dict[str, list[int]] = {}
        fresh = []
        for w in set(chain.from_iterable(words)):
            ids = young.get(w)
            if ids is None:
                ids = old.get(w)
                if ids is None:
                    fresh.append(w)
                    continue
                young[w] = ids
            table[w] = ids
        for w, ids in zip(fresh, self.replay.encode_words([w.encode("utf-8") for w in fresh])):
            table[w] = ids
            if len(w) <= CACHE_WORD_CHARS:
                young[w] = ids
        if len(young) > CACHE_WORDS:
            self.old, self.young = young, {}
        get = table.__getitem__
        for ws in words:
            yield list(chain.from_iterable(map(get, ws)))


_codecs: dict[str, Codec] = {}
caches[__name__] = _codecs.clear


def _codec(key: str, ranks: dict[bytes, int], pattern: str) -> Codec:
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks, pattern)
    return _codecs[key]


def vocabulary_key(ranks: dict[bytes, int], pattern: str) -> str:
    """Digest of every token with its rank, and of the pattern: a worker keeps one vocabulary's codec."""
    digest = hashlib.sha256(pattern.encode("utf-8"))
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        digest.update(b"%d:%d:%b" % (rank, len(token), token))
    return digest.hexdigest()


#: Characters handled together: bounds the memory of a batch whatever its rows hold.
BATCH_CHARS = 3 << 20


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
           keep_ids: bool = True, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row: the ids of the
    whole text, and the digest of what decoding them gives back. Smaller batches hold less
    memory and replay more merges twice."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(ranks)
    key = vocabulary_key(ranks, pattern)
    fields = [("doc_id", docs.schema[id_col].dataType.simpleString()), ("n_tokens", "long"), ("ids_sha256", "string"),
              ("decoded_sha256", "string")] + [("ids", "array<int>")] * keep_ids
    schema = ", ".join(f"{a} {b}" for a, b in fields)
    id_type = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, table.value, pattern)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end] or "") <= batch_chars):
                    chars += len(texts[end] or "")
                    end += 1
                rows: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
                for got in codec.encode_batch(texts[at:end]):
                    rows["n_tokens"].append(len(got))
                    rows["ids_sha256"].append(hashlib.sha256(" ".join(map(str, got)).encode()).hexdigest())
                    rows["decoded_sha256"].append(hashlib.sha256(codec.replay.decode(got)).hexdigest())
                    if keep_ids:
                        rows["ids"].append(got)
                cols = [ids.slice(at, end - at), pa.array(rows["n_tokens"], id_type), pa.array(rows["ids_sha256"], pa.string()),
                        pa.array(rows["decoded_sha256"], pa.string())]
                if keep_ids:
                    cols.append(pa.array(rows["ids"], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=[a for a, _ in fields])
                at = end

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), schema)
