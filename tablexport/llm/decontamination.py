"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A passage is a copy of an item of w words if its best local alignment scores ``needed(w)`` or
more: SIMILARITY of the words kept and the others replaced score (2 * SIMILARITY - 1) * w, and so does a
quotation of that share of the item; that short a run must still score RUN, unless it is SIMILARITY of the whole item.

Such an alignment's changes cost ``b = floor(w - needed(w))`` at most: a word replaced costs
two and breaks n of the item's n-grams at most, one put in costs two and breaks fewer, one left
out costs three, one missing at an end costs one and breaks one. So ``max(n, 2) * (b // 2) + b % 2``
n-grams are broken at most. n is the largest up to SHINGLE for which more than that stand in the item: of any one more
one survives in the passage, the rarest by their count in the whole corpus are the seeds; and
all the others must be there before a passage is aligned.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablexport.llm.common import cut, free_name

SHINGLE = 5
SIMILARITY = 0.8
RUN = 8
FILTER_BITS = 25  # the corpus is screened by a Bloom filter of 2 ** FILTER_BITS bits, 4 MB whatever the benchmark's size
PROBES = 3
MAX_PART = 4_000_000  # bytes of text hashed at a time

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_P = np.uint64(0x9E3779B97F4A7C15)   # odd, so that its powers can be undone modulo 2 ** 64
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_MULTIPLIERS = np.array([1, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words_of(text: str | None) -> list:
    """Lower-cased (A-Z) words between ASCII white space, as bytes."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


_tables = {"p": np.zeros(0, np.uint64), "inverse": np.zeros(0, np.uint64)}


def _word_hashes(raw: np.ndarray):
    """(starts, ends, hash) of every word of lower-cased bytes."""
    n = len(raw)
    if len(_tables["p"]) < n:
        _tables["p"], _tables["inverse"] = _powers(_P, n + n // 2 + 1024), _powers(_P_INVERSE, n + n // 2 + 1024)
    edge = np.flatnonzero(np.diff(_SPACE[raw], prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    value = np.add(raw, 1, dtype=np.uint64)
    value *= _tables["p"][:n]
    h = np.add.reduceat(value, np.minimum(edge, n - 1))[::2]
    if ends[-1] == n:  # reduceat can't name the end of the text
        h[-1] = value[starts[-1]:].sum(dtype=np.uint64)
    return starts, ends, _mixed(h * _tables["inverse"][starts])


def hash_words(raw: bytes):
    """The same for a whole text, MAX_PART bytes at a time, cut at white space."""
    if len(raw) <= MAX_PART:
        return _word_hashes(np.frombuffer(raw, np.uint8))
    found, at = [], 0
    while at < len(raw):
        m = _BLANK.search(raw, min(at + MAX_PART, len(raw)))
        end = m.start() if m else len(raw)
        s, e, h = _word_hashes(np.frombuffer(raw, np.uint8, end - at, at))
        found.append((s + at, e + at, h))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        out *= _Q
        out += h[k:len(h) - n + 1 + k]
    return _mixed(out)


def _slots(g: np.ndarray, probe: int) -> np.ndarray:
    return (g * _MULTIPLIERS[probe]) >> np.uint64(64 - FILTER_BITS)


def smith_waterman(item: list, passage: list) -> tuple:
    """(best local score, end of it in the passage): match 1, other word -1, gap -2.

    One numpy row per word of the passage; a run of item words left out is a running maximum."""
    if not item or not passage:
        return 0, 0
    fits: dict = {}
    for i, w in enumerate(item):
        fits.setdefault(w, np.full(len(item), -1, np.int64))[i] = 1
    slope = 2 * np.arange(len(item) + 1)
    last, best, end, live = np.zeros(len(item) + 1, np.int64), 0, 0, False
    for j, w in enumerate(passage):
        if (fit := fits.get(w)) is None and not live:
            continue
        row = np.zeros(len(item) + 1, np.int64)
        np.maximum(last[:-1] + (-1 if fit is None else fit), last[1:] - 2, out=row[1:])
        row = np.maximum(np.maximum.accumulate(row + slope) - slope, 0)
        top = int(row.max())
        live = top > 0
        if top > best:
            best, end = top, j + 1
        last = row
    return best, end


def needed(n_words: int) -> float:
    """The score from which an alignment counts."""
    return max((2 * SIMILARITY - 1) * n_words, min(SIMILARITY * n_words, RUN))


def _lost(n_words: int) -> int:
    """What the changes of an alignment that counts cost at most."""
    return int(n_words - needed(n_words) + 1e-9)


def seeds_of(n_words: int) -> tuple:
    """(words of a seed, number of seeds) of an item."""
    lost = _lost(n_words)
    broken = {n: max(n, 2) * (lost // 2) + lost % 2 for n in range(1, min(SHINGLE, n_words) + 1)}
    n = max(n for n, b in broken.items() if n == 1 or b < n_words - n + 1)
    return n, broken[n] + 1


_ITEM = "item_id long, item string, n_words int, n int, n_seeds int, place int, gram long, slots array<long>"


def _item_grams(batches):
    """(item_id, item) -> a row for each n-gram of the item."""
    for batch in batches:
        out = []
        for item_id, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = item.split(" ")
            n, n_seeds = seeds_of(len(words))
            g = grams(hash_words(item.encode("utf-8", "surrogatepass"))[2], n)
            slots = np.stack([_slots(g, k) for k in range(PROBES)], axis=1).astype(np.int64).tolist()
            out += [(item_id, item, len(words), n, n_seeds, i, x, s) for i, (x, s) in enumerate(zip(g.view(np.int64).tolist(), slots))]
        if out:
            yield _batch(out, _ITEM)


_WINDOW = "doc_id long, text_hash long, n int, first_word long, passage string, grams array<long>"


def _windows(batches, bitmap, sizes, reach):
    """(doc_id, text_hash, text) -> a row for each cluster of n-grams that the filter knows.

    Hits up to ``reach`` words apart form a cluster; its passage has ``reach`` more
    words on both sides, as many as an alignment through a hit can take."""
    bits = np.frombuffer(bitmap.value, np.uint8)
    for batch in batches:
        out: list = []
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for doc_id, text_hash, text in zip(ids, hashes, batch.column(2)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass").lower()
            starts, ends, h = hash_words(raw)
            for n in sizes:
                g = grams(h, n)
                hits = None
                for k in range(PROBES):
                    some = g if hits is None else g[hits]
                    slot = _slots(some, k)
                    known = np.flatnonzero(bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                    hits = known if hits is None else hits[known]
                    if not len(hits):
                        break
                if not len(hits):
                    continue
                new = np.flatnonzero(np.diff(hits) > reach) + 1
                for group in np.split(hits, new):
                    a, b = max(group[0] - reach, 0), min(group[-1] + n + reach, len(h))
                    passage = b" ".join(raw[starts[a]:ends[b - 1]].split()).decode("utf-8", "surrogatepass")
                    out.append((doc_id, text_hash, n, int(a), passage, np.unique(g[group]).view(np.int64).tolist()))
        if out:
            yield _batch(out, _WINDOW)


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    kind = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind[t]) for c, (_, t) in zip(zip(*rows), fields)], [f for f, _ in fields])


def _bitmap(items: DataFrame) -> bytes:
    """The filter: its bytes that aren't zero, put together on the driver (4 MB at most)."""
    rows = (items.select(F.explode("slots").alias("slot")).groupBy(F.expr("shiftright(slot, 3)").alias("at"))
            .agg(F.expr("bit_or(shiftleft(1, cast(slot & 7 as int)))").alias("bits")).toPandas())
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    out[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype(np.uint8)
    return out.tobytes()


def _score_batch(item: pd.Series, passage: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([smith_waterman(a.split(" "), b.split(" ")) for a, b in zip(item, passage)], columns=["score", "stop"])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents (doc_id, text) that hold a passage of a benchmark item (item_id, text).

    One row per (doc_id, text_hash, item_id): similarity (score of the best local alignment
    over the item's length in words, from ``needed``) and last_word, where the
    best passage ends. Items of equal words are one item, named by the smallest
    id; n_items says how many. Null and empty texts and items hold no words and
    match nothing; null ids are carried; repeated rows give one row. Other
    columns are not read. No items or no documents: no rows."""
    spark = docs.sparkSession
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_join(F.filter(F.split(low, r"[ \t\n\x0B\f\r]+"), lambda w: w != ""), " ")
    distinct = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), words.alias("item")).where("item <> ''")
                .groupBy("item").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items")))
    items = cut(distinct.select("item_id", "item", "n_items"))
    rows = cut(items.select("item_id", "item").mapInArrow(_item_grams, _ITEM))
    bound = rows.agg(F.max("n_words"), F.collect_set("n")).first()
    longest, sizes = bound[0] or 0, sorted(bound[1])
    reach = longest + _lost(longest)  # more than the words that an alignment can put in
    bitmap = spark.sparkContext.broadcast(_bitmap(rows))
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
             .mapInArrow(lambda batches: _windows(batches, bitmap, sizes, reach), _WINDOW))
    passages = cut(found.withColumn("at", F.monotonically_increasing_id()))
    hits = passages.select("at", "n", F.explode("grams").alias("gram"))
    # rare first: how often each n-gram of an item stands in the corpus; of the rarest, one more than changes can break
    counts = hits.groupBy("n", "gram").agg(F.count("*").alias("df"))
    rare = F.row_number().over(Window.partitionBy("item").orderBy("df", "gram", "place"))
    seeds = (rows.join(counts, ["n", "gram"], "left").select("item", "n_seeds", "n", "gram", "place", F.coalesce("df", F.lit(0)).alias("df"))
             .withColumn("rare", rare).where("rare <= n_seeds and df > 0")
             .select("n", "gram", "item").distinct())
    pairs = hits.join(seeds, ["n", "gram"]).select("at", "item").distinct()
    whole = rows.groupBy("item").agg(F.collect_list("gram").alias("own"), F.first("n_seeds").alias("n_seeds"))  # as long as an item
    here = F.size(F.filter("own", lambda g: F.array_contains("grams", g)))
    scored = (pairs.join(passages.select("at", "doc_id", "text_hash", "first_word", "passage", "grams"), "at").join(whole, "item")
              .where(here >= F.size("own") - F.col("n_seeds") + 1)
              .withColumn("s", F.pandas_udf(_score_batch, "score long, stop long")(F.col("item"), F.col("passage")))
              .withColumn("n_words", F.size(F.split("item", " ")))
              .where(f"s.score >= greatest({2 * SIMILARITY - 1} * n_words, least({SIMILARITY} * n_words, {RUN})) - 1e-9")
              .select("doc_id", "text_hash", "item", F.expr("s.score / n_words").alias("similarity"),
                      F.expr("first_word + s.stop - 1").alias("last_word")))
    best = scored.groupBy("doc_id", "text_hash", "item").agg(F.max("similarity").alias("similarity"), F.max_by("last_word", F.struct("similarity", -F.col("last_word"))).alias("last_word"))
    return best.join(items, "item").select("doc_id", "text_hash", "item_id", "n_items", "similarity", "last_word")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a passage of the benchmark, same columns, whatever their names; null texts stay.

    Repeated rows stay or go together; no items: every row stays."""
    id_, hash_ = free_name(docs, "bad_id"), free_name(docs, "bad_text")
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    fits = docs["doc_id"].eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(hash_))
    return docs.join(bad, fits, "left_anti")
