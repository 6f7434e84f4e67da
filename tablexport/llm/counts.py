"""Token counts that follow edits: a segment tree of pre-token stretches for each document.

The leaves are stretches of text cut where a pre-token starts behind a character that
isn't white space, so that the cut rests on a few characters around it alone; inner
nodes hold the sums of characters and tokens below. An edit matches the pattern anew from the
start of the leaf that lies MARGIN characters before it, up to the first later leaf that begins where a
match does; from there on nothing can have changed. Those leaves are encoded again and
the sums on the way up updated.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tablexport.llm.bpe import LONE_SPACE, load

LEAF = 400  # characters of a leaf
MARGIN = 4  # more characters than the pattern looks beyond a match that ends in no white space
SCHEMA = "n_tokens long, n_edits long, n_tokens_after long, n_chars_after long, n_chars_encoded long"


class Counter:
    """text -> number of tokens, by the public library with the ranks of a vocabulary; ``pattern`` finds the pre-tokens."""

    def __init__(self, vocabulary: str):
        import tiktoken

        bpe = load(vocabulary)
        self.pattern = bpe.pattern
        self.encoding = tiktoken.Encoding("own", pat_str=bpe.pattern.pattern, mergeable_ranks=bpe.ranks, special_tokens={})

    def __call__(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))


@lru_cache(2)
def counter(vocabulary: str) -> Counter:
    return Counter(vocabulary)


def cut_places(text: str, size: int, pattern, end: int) -> list:
    """Where to cut ``text[:end]`` into parts of ``size`` characters or a little more.

    Each is the start of a pre-token behind a character that isn't white space: a lone space if one is near,
    else the pattern says where. A pre-token is never cut, however long. What stands behind ``end`` is only looked at."""
    at, out = 0, []
    while end - at > size:
        m = LONE_SPACE.search(text, at + size, min(at + 2 * size, end))
        if m:
            at = m.start()
        else:
            starts = (m.start() for m in pattern.finditer(text, at))
            at = next((p for p in starts if p >= at + size and not text[p - 1].isspace()), end)
        if at >= end:
            break
        out.append(at)
    return out


class CountTree:
    """Token counts of one text under edits. ``count``: text -> tokens, pre-token by pre-token, with its ``pattern``."""

    def __init__(self, text: str, count, leaf: int = LEAF):
        self.count, self.leaf, self.encoded = count, leaf, 0
        parts = self._parts(text, leaf, len(text))
        self._build(parts, [count(p) if p else 0 for p in parts])

    def _parts(self, text: str, size: int, end: int) -> list:
        places = [0, *cut_places(text, size, self.count.pattern, end), end]
        return [text[a:b] for a, b in zip(places, places[1:])]

    def _build(self, leaves: list, tokens: list) -> None:
        self.leaves = leaves
        self.width = 1 << max(len(leaves) - 1, 0).bit_length()
        self.chars, self.tokens = [0] * 2 * self.width, [0] * 2 * self.width
        self.chars[self.width:self.width + len(leaves)] = map(len, leaves)
        self.tokens[self.width:self.width + len(leaves)] = tokens
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def _find(self, at: int) -> tuple:
        """(leaf, offset in it) of a character; the end of the text is in the last leaf that has any."""
        at = min(at, self.chars[1])
        i = 1
        while i < self.width:
            i *= 2
            if at >= self.chars[i] and self.chars[i + 1]:
                at -= self.chars[i]
                i += 1
        return i - self.width, at

    def _set(self, leaf: int, text: str) -> None:
        self.leaves[leaf] = text
        i = self.width + leaf
        self.chars[i], self.tokens[i] = len(text), self.count(text) if text else 0
        self.encoded += len(text)
        while i > 1:
            i //= 2
            self._sum(i)

    def _behind(self, leaf: int, n_chars: int) -> int:
        """The last of the leaves after ``leaf`` that together have ``n_chars`` characters, or the last of all."""
        while n_chars > 0 and leaf + 1 < len(self.leaves):
            leaf += 1
            n_chars -= len(self.leaves[leaf])
        return leaf

    def edit(self, start: int, end: int, written: str) -> None:
        """Replace characters start to end (exclusive) of the present text."""
        n = self.chars[1]
        if not 0 <= start <= end <= n:
            raise ValueError(f"edit {start}:{end} of {n} characters")
        near = max(start - MARGIN, 0)
        low, offset = self._find(near)
        high, stop = self._find(end)
        head = "".join(self.leaves[low:high + 1])[:start - near + offset]
        tail, more = self.leaves[high][stop:], 1
        while True:
            new = head + written + tail
            after = self._behind(high, 2 * MARGIN)
            seen = new + "".join(self.leaves[high + 1:after + 1])
            if len(seen) == len(new) or any(m.start() == len(new) for m in self.count.pattern.finditer(seen)):
                break
            further = self._behind(high, more)  # no match begins where the next leaf does: it belongs to this one
            tail += "".join(self.leaves[high + 1:further + 1])
            high, more = further, max(2 * more, len(new))
        slots = high - low + 1
        if len(new) > 2 * self.leaf * slots:  # more than the leaves should take: room is made
            parts = self._parts(seen, self.leaf, len(new))
            self.encoded += len(new)
            tokens = self.tokens[self.width:self.width + len(self.leaves)]
            tokens[low:high + 1] = map(self.count, parts)
            self._build(self.leaves[:low] + parts + self.leaves[high + 1:], tokens)
            return
        parts = self._parts(seen, max(self.leaf, -(-len(new) // slots)), len(new))
        for i in range(low, high + 1):
            part = parts[i - low] if i - low < len(parts) else ""
            if part != self.leaves[i]:
                self._set(i, part)


_LONG_NUMBER = re.compile(r"[0-9]{5,}")


def redactions(text: str) -> list:
    """(start, end, written) on ``text``, in order: lines equal to an earlier one go, numbers of 5 or more digits become #."""
    out, seen, at = [], set(), 0
    for line in text.split("\n"):
        if line in seen and line.strip():
            out.append((at, min(at + len(line) + 1, len(text)), ""))
        else:
            seen.add(line)
            out += [(at + m.start(), at + m.end(), "#") for m in _LONG_NUMBER.finditer(line)]
        at += len(line) + 1
    return out


def recount(text: str | None, count, edits=redactions) -> tuple:
    tree = CountTree(text or "", count)
    before, wanted = tree.n_tokens, edits(text or "")
    for start, end, written in reversed(wanted):  # from the back: offsets stay those of the text
        tree.edit(start, end, written)
    return before, len(wanted), tree.n_tokens, tree.chars[1], tree.encoded


def after_edits(text: Column, vocabulary: str) -> Column:
    """A struct of SCHEMA for every whole text: tokens before and after ``redactions``, and the characters encoded again.

    Null and empty texts have no tokens and no edits. A row depends on its
    text alone; repeated rows get equal results."""
    def batch(texts: pd.Series) -> pd.DataFrame:
        count = counter(vocabulary)
        return pd.DataFrame([recount(t, count) for t in texts], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    batch.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(batch, SCHEMA)(text)
