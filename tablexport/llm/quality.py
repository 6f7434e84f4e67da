"""Quality rules: an ordered decision list learned from labelled statistics.

``statistics`` measures a text. ``learn`` grows and prunes threshold
conjunctions by sequential covering over a bounded, documented sample of
labelled rows, on the driver. ``verdict`` turns the list into one ordered
Spark conditional expression, which judges any number of rows without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablexport.llm.common import free_name

STATISTICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "n_lines long, n_distinct_words long, n_digits long, n_upper long")
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"

#: Labelled rows a list is learned from at most (those of smallest hash).
MAX_LABELLED = 20_000

#: Feature -> SQL over the columns of ``statistics`` ({s}: where they are); all are defined for empty texts.
FEATURES = {
    "n_words": "{s}n_words",
    "mean_word": "{s}word_chars / greatest({s}n_words, 1)",
    "symbol_rate": "{s}n_symbols / greatest({s}n_words, 1)",
    "dup_line_rate": "{s}n_dup_lines / greatest({s}n_lines, 1)",
    "repeat_rate": "{s}n_repeat_words / greatest({s}n_words, 1)",
    "distinct_rate": "{s}n_distinct_words / greatest({s}n_words, 1)",
    "digit_rate": "{s}n_digits / greatest({s}word_chars, 1)",
    "upper_rate": "{s}n_upper / greatest({s}word_chars, 1)",
}
BASE_FAILED = "{s}n_words < 50 or 100 * {s}n_repeat_words > 50 * {s}n_words"


def repeated_words(words: list) -> int:
    """Words inside windows of three words that occur twice or more in the list."""
    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # keeps the product of three below 2**63
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(number) + ids[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    often = np.zeros(n - 2, bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= often
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    """The statistics of one whole text (null counts as empty)."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space alone
    lines = text.split("\n")
    seen: set = set()
    dup = 0
    for line in lines:
        if line.strip(BLANK):
            dup += line in seen
            seen.add(line)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)
    return (len(words), len(text) - sum(map(text.count, BLANK)), sum(map(text.count, SYMBOLS)), dup, repeated_words(words),
            len(lines), len(set(words)), int(by_byte[48:58].sum()), int(by_byte[65:91].sum()))


def _measure_batch(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=[c.split()[0] for c in STATISTICS.split(", ")])


def statistics(text: Column) -> Column:
    """A struct of STATISTICS for every whole text; null texts count as empty."""
    return F.pandas_udf(_measure_batch, STATISTICS)(text)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, "<=" or ">", threshold); what fits it is rejected."""
    conditions: tuple

    def sql(self, s: str = "") -> str:
        return " and ".join(f"({FEATURES[f].format(s=s)}) {op} {t!r}D" for f, op, t in self.conditions)

    def fits(self, x: np.ndarray, names: list) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, op, t in self.conditions:
            column = x[:, names.index(f)]
            out &= (column <= t) if op == "<=" else (column > t)
        return out


def _grow(x, y, names, bins, most):
    """Adds the condition of greatest information gain until no negative is covered."""
    rule, inside = Rule(()), np.ones(len(y), bool)
    while len(rule.conditions) < most:
        p, n = y[inside].sum(), (~y[inside]).sum()
        if p == 0 or n == 0:
            break
        now, best = np.log2(p / (p + n)), (1e-9, None, None)
        for j, name in enumerate(names):
            column = x[:, j]
            for t in np.unique(np.quantile(column[inside], np.linspace(0, 1, bins), method="lower")):
                for op in ("<=", ">"):
                    fits = inside & ((column <= t) if op == "<=" else (column > t))
                    q = (fits & y).sum()
                    m = fits.sum() - q
                    if q and (gain := q * (np.log2(q / (q + m)) - now)) > best[0]:
                        best = (gain, (name, op, float(t)), fits)
        if best[1] is None:
            break
        rule, inside = Rule((*rule.conditions, best[1])), best[2]
    return rule


def _prune(rule, x, y, names):
    """The shortest head of the conjunction with the best (p - n) / (p + n) on held-back rows."""
    def worth(k):
        fits = Rule(rule.conditions[:k]).fits(x, names)
        p, n = (fits & y).sum(), (fits & ~y).sum()
        return (p - n) / (p + n) if p + n else -1.0
    lengths = range(1, len(rule.conditions) + 1)
    return Rule(rule.conditions[:max(lengths, key=lambda k: (worth(k), -k))])


def cover(x: np.ndarray, reject: np.ndarray, names: list, *, precision: float = 0.9, max_rules: int = 16,
          max_conditions: int = 4, bins: int = 64, min_cover: int = 3, seed: int = 7) -> list:
    """The decision list for rows ``x`` with ``reject`` as the positive class.

    Two thirds grow a rule, one third prunes it; a rule is taken while at
    least ``precision`` of what it rejects in the whole sample is labelled
    so. No rows, or one class: an empty list (nothing is rejected)."""
    rules: list = []
    left = np.ones(len(reject), bool)
    part = np.random.default_rng(seed).random(len(reject)) < 2 / 3
    while len(rules) < max_rules and reject[left].any() and not reject[left].all():
        grow, held = left & part, left & ~part
        if not reject[grow].any():
            break
        rule = _grow(x[grow], reject[grow], names, bins, max_conditions)
        if not rule.conditions:
            break
        rule = _prune(rule, x[held], reject[held], names)
        fits = rule.fits(x, names) & left
        p, n = int((fits & reject).sum()), int((fits & ~reject).sum())
        if p < min_cover or p < precision * (p + n):
            break
        rules.append(rule)
        left &= ~fits
    return rules


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, **how) -> list:
    """Rules from documents (doc_id, text) and labels (doc_id, quality: 0 rejects, 1 keeps).

    At most ``max_labelled`` labelled ids of smallest hash are used; an id
    labelled twice counts by its lowest quality, null ids and null labels
    not at all, an id with several texts once per text of smallest hash. The
    sample reaches the driver as statistics, not texts."""
    picked = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    stats = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
             .select("doc_id", "quality", statistics(F.col("text")).alias("s"))
             .select("doc_id", "quality", *[F.expr(sql.format(s="s.")).cast("double").alias(f) for f, sql in FEATURES.items()]))
    rows = stats.orderBy("doc_id", *FEATURES).limit(max_labelled).toPandas()
    names = list(FEATURES)
    return cover(rows[names].to_numpy(float), (rows["quality"] == 0).to_numpy(), names, **how)


def rule_number(rules: list, s: str = "") -> Column:
    """The first rule that fits (from 1) as one ordered conditional expression; null: none."""
    cases = " ".join(f"when {rule.sql(s)} then {i}" for i, rule in enumerate(rules, 1))
    return F.expr(f"case {cases} end") if rules else F.lit(None).cast("int")


def judge(docs: DataFrame, rules: list) -> DataFrame:
    """doc_id, the statistics, base_failed, rule (the first that fits) and kept for every row.

    Null and empty texts have no words and fail the base; repeated rows are
    judged alike and each returned. Extra columns of ``docs`` are not read."""
    s = docs.select("doc_id", statistics(F.col("text")).alias("s")).select("doc_id", "s.*")
    return (s.withColumn("base_failed", F.expr(BASE_FAILED.format(s=""))).withColumn("rule", rule_number(rules))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def keep(docs: DataFrame, rules: list) -> DataFrame:
    """The rows of ``docs`` that the base and the rules keep, with the same columns."""
    s = free_name(docs, "_statistics")
    judged = docs.withColumn(s, statistics(F.col("text")))
    return judged.where(~F.expr(BASE_FAILED.format(s=f"{s}.")) & rule_number(rules, f"{s}.").isNull()).drop(s)
