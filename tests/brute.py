"""Brute-force reference: a chunk list as N separate predicates (N "queries").

Written independently of the planner: each chunk is a Python predicate on
the key, generated by plain loops that walk the windows the way a
chunk-per-query export would. ``as_written`` = rows per predicate (overlaps
repeat, unmatched rows vanish); ``exactly_once`` = first true predicate,
else the residual chunk.
"""

from __future__ import annotations

import datetime as dt


def between_chunks(s, e, inc, exactly_once):
    def window(lo, hi):
        return lambda k: k is not None and lo <= k <= hi

    first_hi = min(s + inc, e) if exactly_once else s + inc
    preds = [window(s, first_hi)]
    lo = s + inc + 1  # the next window starts after the unclamped first one
    while lo <= e:
        hi = min(lo + inc, e)
        preds.append(window(lo, hi))
        lo = hi + 1
    return preds


def like_chunks(start, end, inc, prefix=None):
    preds, n = [], start
    p = prefix or ""
    while True:
        preds.append((lambda t: lambda k: k is not None and str(k).startswith(t))(p + str(n)))
        n += inc
        if n > end:
            break
    if prefix is not None:
        preds.append(lambda k: k is not None and not str(k).startswith(prefix))
    if start >= 10:
        preds.append(lambda k: k is not None and str(k) in [str(d) for d in range(10)])
    return preds


def month_index(d):
    return d.year * 12 + d.month - 1


def date_chunks(lo: dt.datetime, hi: dt.datetime, months: int):
    """Half-open windows aligned on the first key (January for yearly steps)."""
    if months % 12 == 0:
        idx, step = (lambda d: d.year), months // 12
    else:
        idx, step = month_index, months
    k = (idx(hi) - idx(lo)) // step
    first = idx(lo)
    preds = []
    for i in range(k + 1):
        a = None if i == 0 else first + i * step
        b = None if i == k else first + (i + 1) * step
        preds.append((lambda a, b: lambda d: d is not None and (a is None or idx(d) >= a) and (b is None or idx(d) < b))(a, b))
    return preds


def assign(keys, preds, exactly_once):
    """[(row_index, chunk_no)] like N queries would return them."""
    out = []
    for i, k in enumerate(keys):
        hits = [c + 1 for c, p in enumerate(preds) if p(k)]
        if exactly_once:
            out.append((i, hits[0] if hits else len(preds) + 1))
        else:
            out += [(i, h) for h in hits]
    return sorted(out)
