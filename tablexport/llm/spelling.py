"""Spelling variants grouped by reduced-alphabet generation.

Every letter is hashed to one of SYMBOLS symbols. Two words that differ by one inserted,
deleted or replaced code point have reduced words that differ by one symbol at most, so
each word's near words are among those whose reduced word lies in the full one-edit
neighbourhood of its own. The neighbourhood is generated as 64-bit polynomial
hashes (an edit changes a prefix hash and a shifted suffix hash, so a word of L letters
costs O(L), however long it is), joined with the reduced vocabulary, and what meets is
verified on the original strings.

A bitmap of the reduced vocabulary, of at most 2 ** BITS bits, throws away most
generated neighbours before the shuffle; a fuller one lets more through and loses none.
A reduced word that stands for more than HOT words is not compared with each of them:
there, two words meet only if they also share a string that one deletion, or none,
makes of both.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablexport.llm.common import cut, forget

SYMBOLS = 8
HOT = 64
BITS = 27  # of the vocabulary's bitmap, as a power of two: 16 MB
HELD = 1 << 19  # words that a task counts before it passes them on
PIECE = 1 << 18  # letters whose neighbours are generated at a time
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
_INVERSE = _U(pow(_BASE, -1, 1 << 64))


def _counted(batches, least: int, noise: int):
    """word, n of each partition's texts, combined before the shuffle."""
    find, counts = re.compile(f"{LETTERS}{{{least},}}").findall, Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            own = Counter(find((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))  # bytes: A-Z alone
            if noise:
                salt = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run in [r for r in own if zlib.crc32(r.encode(), salt) % noise == 0]:
                    at = zlib.crc32(run.encode(), salt) % len(run)
                    counts[run[:at] + run[at + 1:]] += own.pop(run)
            counts.update(own)
            if len(counts) > HELD:
                yield out()
                counts.clear()
    yield out()


def vocabulary(docs: DataFrame, least: int = 7, times: int = 2, noise: int = 31) -> DataFrame:
    """word, n (occurrences, repeats included): the distinct words of whole texts with ``least`` code points and ``times`` occurrences or more.

    Maximal runs of LETTERS, A-Z in lower case. Where ``noise`` divides h, the CRC-32 of
    ``<doc_id>:<run>``, the code point at h modulo the run's length is taken out (no noise: 0).
    Null texts have none; a null id is written as an empty string. Other columns are not read."""
    parts = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lambda x: _counted(x, least, noise), "word string, n long")
    parts = parts.where(F.length("word") >= least)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


# ------------------------------------------------------------------ hashes of neighbourhoods
def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their low bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


def _by_length(words: list):
    """(positions, code points as a matrix) of the words of each length, PIECE letters at most unless one word has more."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(_U)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        of = np.flatnonzero(lengths == length)
        step = max(1, PIECE // max(int(length), 1))
        for k in range(0, len(of), step):
            yield of[k:k + step], codes[starts[of[k:k + step], None] + np.arange(length)]


def symbols(codes: np.ndarray) -> np.ndarray:
    """1 to SYMBOLS for each code point."""
    return (((codes * _U(0x9E3779B1)) & _U(0xFFFFFFFF)) * _U(SYMBOLS) >> _U(32)) + _U(1)


def _prefixes(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values), values.shape[1] + 1), _U)
    np.cumsum(values * powers[:values.shape[1]], axis=1, dtype=_U, out=out[:, 1:])
    return out


def reduced_keys(words: list) -> np.ndarray:
    """The reduced words of ``words`` as 64-bit hashes."""
    out = np.empty(len(words), _U)
    for of, codes in _by_length(words):
        out[of] = _mixed(_prefixes(symbols(codes), _powers(codes.shape[1] + 1))[:, -1])
    return out.view(np.int64)


def neighbours(words: list, wanted=None):
    """(position, key) arrays of the full one-edit neighbourhoods of the reduced words, each key once for a word.

    ``wanted`` says of an array of keys which are looked for."""
    letters = np.arange(1, SYMBOLS + 1, dtype=_U)
    for of, codes in _by_length(words):
        values, n = symbols(codes), codes.shape[1]
        powers = _powers(n + 2)
        prefix = _prefixes(values, powers)
        whole = prefix[:, -1:]
        rows, keys = [], []
        for a in range(0, n + 1, PIECE):
            b, c = min(a + PIECE, n), min(a + PIECE, n + 1)
            deleted = prefix[:, a:b] + (whole - prefix[:, a + 1:b + 1]) * _INVERSE
            replaced = whole[..., None] + (letters - values[:, a:b, None]) * powers[a:b, None]
            inserted = (prefix[:, a:c] + (whole - prefix[:, a:c]) * _U(_BASE))[..., None] + letters * powers[a:c, None]
            for part in (deleted, replaced, inserted):
                key = _mixed(part.reshape(len(of), -1))
                row, at = np.nonzero(wanted(key) if wanted else np.ones(key.shape, bool))
                rows.append(of[row])
                keys.append(key[row, at])
        rows.append(of)
        keys.append(_mixed(whole[:, 0]))
        row, key = np.concatenate(rows), np.concatenate(keys)
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
        yield row[new], key[new].view(np.int64)


def deletions(words: list):
    """(position, key) arrays: hashes of each word and of what one deletion makes of it, on the original code points."""
    for of, codes in _by_length(words):
        n = codes.shape[1]
        prefix = _prefixes(codes + _U(1), _powers(n + 2))
        whole = prefix[:, -1:]
        keys = _mixed(np.concatenate([whole, prefix[:, :-1] + (whole - prefix[:, 1:]) * _INVERSE], axis=1))
        yield np.repeat(of, n + 1), keys.reshape(-1).view(np.int64)


# ------------------------------------------------------------------ Spark
def _expand(frame: DataFrame, make, name: str) -> DataFrame:
    """A row for every key ``make`` gives for column ``word`` of each row; all columns stay."""
    def batches(parts):
        for part in parts:
            for row, key in make(part.column("word").to_pylist()):
                for k in range(0, len(row), PIECE):
                    taken = part.take(pa.array(row[k:k + PIECE]))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(key[k:k + PIECE])], [*part.schema.names, name])

    return frame.mapInArrow(batches, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in frame.schema)}, {name} long")


def _keyed(words: DataFrame) -> DataFrame:
    def batches(parts):
        for part in parts:
            key = reduced_keys(part.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(key)], [*part.schema.names, "key"])

    return words.mapInArrow(batches, "word string, n long, key long")


def _bitmap(keyed: DataFrame) -> tuple[int, np.ndarray]:
    """(power, bits): a bit set for the leading bits of every reduced word."""
    power = min(BITS, max(16, (64 * keyed.count()).bit_length()))
    at = F.shiftrightunsigned("key", 64 - power)
    bits = (keyed.select(F.shiftrightunsigned(at, 6).alias("i"), F.expr("1L").alias("one"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
            .groupBy("i").agg(F.expr("bit_or(shiftleft(one, bit))").alias("bits")).toArrow())
    out = np.zeros(1 << (power - 6), np.int64)
    out[bits["i"].to_numpy()] = bits["bits"].to_numpy()
    return power, out.view(_U)


def near(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: every two of the distinct ``words`` (word, n) that are one edit apart, from both sides."""
    spark = words.sparkSession
    keyed = cut(_keyed(words.select("word", F.col("n").cast("long"))))
    power, bits = _bitmap(keyed)
    shared = spark.sparkContext.broadcast(bits)

    def wanted(key):
        at = key >> _U(64 - power)
        return (shared.value[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) != 0

    made = cut(_expand(keyed.select("word", "n"), lambda x: neighbours(x, wanted), "key"))
    hot = cut(keyed.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > HOT).select("key"))
    apart = F.levenshtein("word", "near", 1) == 1
    other = keyed.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "key")
    plain = made.join(other.join(hot, "key", "left_anti"), "key").where(apart).select("word", "n", "near", "near_n")
    # hot reduced words: also a common deletion; a pair may share several, so distinct
    left = _expand(made.join(hot, "key", "left_semi").select("word", "n", "key"), deletions, "rest")
    right = _expand(keyed.join(hot, "key", "left_semi").select("word", "n", "key"), deletions, "rest").select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), "key", "rest")
    met = left.distinct().join(right.distinct(), ["key", "rest"]).where(apart).select("word", "n", "near", "near_n").distinct()
    out = cut(plain.union(met))
    forget(keyed, made, hot)
    return out


def group(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``words`` (word, n; distinct, no nulls) with form, root, n_near, form_n.

    Words are near if exactly one inserted, deleted or replaced code point tells them apart.
    form: the near word of largest n (ties: the smallest in code-point order) if that n is at
    least ``ratio`` times the word's, else null; form_n its n. root: the end of the forms followed from
    the word, the word itself if it has none. n_near: how many words are near. No words: no rows."""
    words = cut(words.select("word", F.col("n").cast("long").alias("n")))
    best = near(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    found = words.join(best, "word", "left").withColumn("fits", -F.col("best.m") >= ratio * F.col("n"))
    found = cut(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(F.col("fits"), F.col("best.near")).alias("form"), F.when(F.col("fits"), -F.col("best.m")).alias("form_n")))
    forms = found.where("form is not null")
    roots = cut(forms.select("word", F.col("form").alias("root")))
    while True:  # each round doubles how far a root lies along the forms; n grows by ratio at each, so there are few
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = cut(roots.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        forget(roots)
        roots = longer
        if roots.where("moved").isEmpty():
            break
    out = found.join(roots.select("word", "root"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle_sql(table: str = "documents", least: int = 7, times: int = 2, noise: int = 31, ratio: int = 10) -> str:
    """DuckDB SQL of ``group(vocabulary(table))``: equal deletions at one place tell a replaced letter, equal to a word a lost one."""
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS tab),
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM {table}),
c AS (SELECT doc_id, run, count(*) AS k, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS e FROM r WHERE length(run) >= {least} GROUP BY ALL),
h AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(e)), lambda i: ('0x' || substr(hex(e), i * 2 + 1, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM c, crc),
w AS (SELECT CASE WHEN h % {noise} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, sum(k)::BIGINT AS n
    FROM h GROUP BY 1 HAVING length(word) >= {least} AND n >= {times}),
d AS (SELECT word, n, length(word) AS l, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.l = b.l AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM d a JOIN w b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM d a JOIN w b ON a.rest = b.word),
b AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS m FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {ratio} * w.n THEN near END AS form, CASE WHEN m >= {ratio} * w.n THEN m END AS form_n
    FROM w LEFT JOIN b ON w.word = b.word),
t AS (SELECT word, word AS at FROM f UNION ALL SELECT t.word, f.form FROM t JOIN f ON t.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, t.at AS root, f.n, f.n_near, f.form_n FROM f JOIN t ON f.word = t.word JOIN f e ON t.at = e.word WHERE e.form IS NULL"""
