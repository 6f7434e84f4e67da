"""Byte-level BPE by a rank queue held in a hierarchical bitmap.

A pre-token's bytes are a doubly linked list. Every adjacent pair that the
vocabulary can merge stands in the bucket of its rank; a bitmap of three
levels says which buckets have entries, so that find-first-set gives the
next rank in three steps whatever the length. Entries whose pair has changed
meanwhile are skipped when they come up. Nothing is scanned twice, which suits
very long pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from functools import lru_cache
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"
MAX_CACHED = 800_000  # pre-tokens whose ids a worker remembers, each of MAX_PIECE characters at most
MAX_PIECE = 64


BIT = [1 << i for i in range(64)]


class RankQueue:
    """Buckets of positions by rank under a bitmap of three levels of 64-way words (up to 64 ** 3 ranks)."""

    def __init__(self, ranks: int):
        if ranks > 64 ** 3:
            raise ValueError("three levels hold 262,144 ranks")
        self.buckets: list = [[] for _ in range(ranks)]
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * 64
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, position)
            return
        bucket.append(position)
        i = rank >> 6
        word = self.low[i]
        self.low[i] = word | BIT[rank & 63]
        if not word:
            self.mid[i >> 6] |= BIT[i & 63]
            self.top |= BIT[i >> 6]

    def pop(self) -> tuple | None:
        """(lowest rank that has any, its leftmost position); None if empty."""
        top = self.top
        if not top:
            return None
        j = (top & -top).bit_length() - 1
        word = self.mid[j]
        i = j << 6 | (word & -word).bit_length() - 1
        word = self.low[i]
        bit = word & -word
        rank = i << 6 | bit.bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        word ^= bit
        self.low[i] = word
        if not word:
            self.mid[j] ^= BIT[i & 63]
            if not self.mid[j]:
                self.top ^= BIT[j]
        return rank, bucket.pop()


class Recent:
    """A bounded memory of two generations: when the young one is full it becomes the old one."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most // 2, {}, {}

    def put(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


class ByteBpe:
    """Encodes and decodes by merge ranks: bytes -> id, where the id is the rank."""

    def __init__(self, ranks: dict, pattern: str):
        import regex

        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=0) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.written = [str(i) for i in range(len(self.queue.buckets))]
        self.pieces = Recent(MAX_CACHED)

    def encode_piece(self, piece: bytes) -> list:
        """Ids of one pre-token: a whole entry of the vocabulary, else the merges in order of rank, leftmost first."""
        rank_of = self.ranks.get
        if (whole := rank_of(piece)) is not None:
            return [whole]
        push, pop = self.queue.push, self.queue.pop
        n = len(piece)
        after = list(range(1, n + 2))   # the next part's start
        before = list(range(-1, n))     # the last part's start
        rank_at = [-1] * (n + 1)        # rank of the pair that starts here; -1: none, or no part starts here
        for i in range(n - 1):
            if (r := rank_of(piece[i:i + 2])) is not None:
                rank_at[i] = r
                push(r, i)
        while top := pop():
            rank, i = top
            if rank_at[i] != rank:
                continue                # stale
            j = after[i]                # the part that is swallowed
            rank_at[j] = -1
            after[i] = end = after[j]
            if end < n:
                before[end] = i
                r = rank_of(piece[i:after[end]], -1)
                rank_at[i] = r
                if r >= 0:
                    push(r, i)
            else:
                rank_at[i] = -1
            h = before[i]
            if h >= 0:
                r = rank_of(piece[h:end], -1)
                rank_at[h] = r
                if r >= 0:
                    push(r, h)
        out, i = [], 0
        while i < n:
            out.append(rank_of(piece[i:after[i]]))
            i = after[i]
        return out

    def _piece(self, piece: str) -> bytes:
        """The ids of a pre-token as packed 32-bit numbers; short ones are remembered."""
        packed = self.pieces.old.get(piece)
        if packed is None:
            packed = array("I", self.encode_piece(piece.encode("utf-8", "surrogatepass"))).tobytes()
        if len(piece) <= MAX_PIECE:
            self.pieces.put(piece, packed)
        return packed

    def encode(self, text: str) -> list:
        out, new = array("I"), self._piece
        for block in blocks(text):
            known = self.pieces.young.get
            out.frombytes(b"".join([known(p) or new(p) for p in self.pattern.findall(block)]))
        return out.tolist()

    def decode(self, ids: list) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
BLOCK = 20_000


def blocks(text: str, size: int = BLOCK):
    """The text in parts of ``size`` characters or little more, cut before a lone space between two characters that aren't white space.

    A pre-token starts at each such space: the pattern takes it only as the
    first character of a match. Where there is none, a part is as long as it must be."""
    at = 0
    while len(text) - at > size and (m := LONE_SPACE.search(text, at + size)):
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def read_ranks(lines) -> dict:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(2)
def load(name: str) -> ByteBpe:
    """The named public vocabulary, once per worker. ``name``: a file of the tokenizer folder, or a path."""
    import os

    import public_tokenizers

    path = name if os.path.isabs(name) else public_tokenizers.path(name)
    with open(path, "rb") as f:
        return ByteBpe(read_ranks(f), public_tokenizers.PATTERN)


def digest(bpe: ByteBpe, text: str | None) -> tuple:
    """(number of ids, sha256 of the ids, sha256 of the bytes that they decode to); null counts as empty."""
    ids = bpe.encode(text or "")
    written = ",".join(map(bpe.written.__getitem__, ids))
    return len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()


def digests(text: Column, vocabulary: str) -> Column:
    """A struct of SCHEMA for every whole text; null and empty texts have no ids.

    A row depends on its text alone; repeated rows get equal results. A
    worker keeps the vocabulary and the ids of up to MAX_CACHED short pieces."""
    def batch(texts: pd.Series) -> pd.DataFrame:
        bpe = load(vocabulary)
        return pd.DataFrame([digest(bpe, t) for t in texts], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    batch.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(batch, SCHEMA)(text)


def ids(text: Column, vocabulary: str) -> Column:
    """The ids of every whole text as array<int>; null texts give an empty array."""
    def batch(texts: pd.Series) -> pd.Series:
        bpe = load(vocabulary)
        return pd.Series([bpe.encode(t or "") for t in texts])

    batch.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(batch, "array<int>")(text)
