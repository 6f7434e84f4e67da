"""Personal data: detection in the text as written and behind disguises, with source offsets.

The base patterns run over the text as it is. A transducer then rewrites
look-alike letters, spelled digits and at/dot disguises to plain characters,
keeping for every character written the span it came from; identifiers found
in the rewritten text are mapped back. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SCHEMA = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match starts inside a run of digits: what fails at its first digit fails at the others.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str):
    """Matches of local@domain, found from the @: a run without one costs one pass only."""
    free = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            free = m.end()


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def detect(text: str) -> list:
    """(start, kind number, end) of every identifier written plainly, in order."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# Letters that look like Latin ones (Cyrillic, Greek), and the Latin letter each stands for.
LOOK_ALIKES = dict(zip("АВЕЅІЈКМНОРСТХУаеіјорсухѕԁһԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονικρ",
                       "ABESIJKMHOPCTXYaeijopcyxsdhqw" "ABEZHIKMNOPTYXovikp", strict=True))
LOOK_ALIKES |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}  # full-width forms
INVISIBLE = "­​‌‍⁠﻿"
# The names of the digits.
DIGITS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

_DIGIT = "(?:" + "|".join(DIGITS) + ")"
_LETTERS = "".join(LOOK_ALIKES)
_DOT_WORD = r"(?:\x20{1,3}dot\x20{1,3}|\x20{0,3}[\[({<]\x20{0,3}(?:dot|\.)\x20{0,3}[\])}>]\x20{0,3})"
_UNIT = rf"(?:[0-9]++|{_DIGIT})(?![A-Za-z0-9])"
# Digits and names of digits, at least two of them; those without a name have nothing to rewrite.
_SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:plus[\x20-]+)?{_UNIT}(?:(?:{_DOT_WORD}|[\x20,.()-]{{1,3}}){_UNIT})+", re.I)
_PIECE = re.compile(rf"{_DOT_WORD}|plus|[0-9]+|{_DIGIT}|[\x20,.()-]+", re.I)
_NAMED = re.compile(rf"\b{_DIGIT}\b", re.I)
# Endings that make "name at host dot ending" an address rather than prose.
ENDINGS = frozenset(("com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "ai", "dev", "app", "de", "fr", "es", "it", "nl", "eu", "uk", "us", "ca", "in", "jp", "cn", "ru", "br", "au", "ch", "at"))
# Further endings, which need a host that isn't a word of _PROSE.
MORE = frozenset("""ac ad ae af ag al am ao ar as aw az ba bb bd be bf bg bh bi bj bm bn bo bs bt bw by bz cd cf cg ci ck cl cm cr cu cv cw cy cz dj dk dm do dz ec ee eg er et
fi fj fk fm fo ga gd ge gf gg gh gi gl gm gn gp gr gt gu gw gy hk hn hr ht hu id ie il im iq ir is je jm jo ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly
ma mc md me mg mh mk ml mm mn mo mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni no np nr nu nz om pa pe pf pg ph pk pl pm pr ps pt pw py qa re ro rs rw sa sb sc sd se sg sh
si sk sl sm sn so sr st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw
xyz online site shop store tech club cloud email mail pro name mobi agency blog live life world""".split())
# Words before "at" or "dot" in prose.
_PROSE = frozenset("""the a an this that each every one any some no my your his her its our their which what and or but of in on to is are was were be been more here there us me it
them him you we they look looked see seen visit visited find found read available online site website page pages hosted located live out up down back only also now
today sold bought posted published shown written listed order shop work works worked working good stay stayed met arrive arrived stop stopped http https www""".split())
_SEEN = r"\x20{0,3}[\[({<]\x20{0,3}(?:%s)\x20{0,3}[\])}>]\x20{0,3}|\x20{1,3}%s\x20{1,3}|%s"
_AT, _DOT = re.compile(_SEEN % ("at|@", "at", "@"), re.I), _SEEN % (r"dot|\.", "dot", r"\.")
_HOST = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:(?:{_DOT})[A-Za-z0-9-]{{1,63}}){{1,5}}(?![A-Za-z0-9-])", re.I)
_NAME = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]{{1,64}}(?:(?:{_DOT})[A-Za-z0-9_%+-]{{1,64}}){{0,3}}\Z", re.I)
_DOTS = re.compile(_DOT, re.I)
_BRACKETED = re.compile(r"\x20{0,3}[\[({<]\x20{0,3}(at|dot|@|\.)\x20{0,3}[\])}>]\x20{0,3}", re.I)
_ODD = re.compile(f"[{re.escape(_LETTERS)}]+|[{INVISIBLE}]+")
_SIGN = {"at": "@", "dot": ".", "@": "@", ".": "."}


class _Tape:
    """Text being rewritten, with the source span of every character."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, None, None

    def rewrite(self, edits: list) -> None:
        """edits: (start, end, written) on the present text, in order; what is written comes from the whole of its span."""
        if not edits:
            return
        starts = self.starts or range(len(self.text))
        ends = self.ends or range(1, len(self.text) + 1)
        text, s, e, at = [], [], [], 0
        for start, end, written in edits:
            if start < at:
                continue
            text += [self.text[at:start], written]
            s.extend(starts[at:start])
            e.extend(ends[at:start])
            if len(written) == end - start:  # one for one
                s.extend(starts[start:end])
                e.extend(ends[start:end])
            else:
                s.extend([starts[start]] * len(written))
                e.extend([ends[end - 1]] * len(written))
            at = end
        text.append(self.text[at:])
        s.extend(starts[at:])
        e.extend(ends[at:])
        self.text, self.starts, self.ends = "".join(text), s, e


def _spelled(m: re.Match) -> list:
    """One edit for each digit word, and none of what is between it and its neighbours left but the dots of an ip and said dots."""
    pieces = [(p.start() + m.start(), p.end() + m.start(), p[0].lower()) for p in _PIECE.finditer(m[0])]
    named = [w in DIGITS for _, _, w in pieces]
    if not any(named):
        return []
    said = [w for _, _, w in pieces]
    parts = "".join("." if "dot" in w or w.strip(" [](){}<>") == "." else DIGITS.get(w, w if w.isdigit() else "") for w in said).split(".")
    ip = len(parts) == 4 and all(1 <= len(x) <= 3 for x in parts)
    out = []
    for k, (start, end, w) in enumerate(pieces):
        if w in DIGITS:
            out.append((start, end, DIGITS[w]))
        elif w == "plus":
            out.append((start, pieces[k + 1][1] if not pieces[k + 1][2].isalnum() else end, "+"))
        elif "dot" in w or (ip and w.strip(" [](){}<>") == "."):
            out.append((start, end, "."))
        elif not w.isalnum() and (named[k - 1] or named[k + 1]):
            out.append((start, end, ""))
    return out


def _kept_host(name: str, sign: str, host: re.Match) -> int | None:
    """Where the host ends: after the last known ending, or after the last part of letters where the rest tells an address."""
    plain = name.strip().lower()
    clear = "@" in sign or not sign.strip().isalpha()  # the sign itself, or "at" in brackets
    first = re.split(_DOTS, host[0], maxsplit=1)[0].lower()
    telling = any(c in "0123456789._%+" for c in plain) or bool(_DOTS.search(plain))
    dots = list(_DOTS.finditer(host[0]))
    known = other = None
    for k, d in enumerate(dots):
        end = dots[k + 1].start() if k + 1 < len(dots) else len(host[0])
        ending = host[0][d.end():end].lower()
        if not (len(ending) > 1 and ending.isalpha()):
            continue
        words = [x[0].strip().lower() for x in dots[:k + 1]]
        if not clear and all(x == "." for x in words):  # "john at example.com": prose speaks of hosts so, too
            fits = ending in ENDINGS | MORE and first not in _PROSE and plain not in _PROSE
        else:
            fits = ending in ENDINGS or first not in _PROSE and ending in MORE
            if clear or any(x not in (".", "dot") for x in words) or telling and first not in _PROSE:
                other = end
        known = end if fits else known
    return known or other


def _addresses(text: str) -> list:
    """Edits that write the signs of addresses: at and dot as a sign, a word or in brackets, at each place on its own."""
    out, free = [], 0
    for m in _AT.finditer(text):
        if m.start() < free or not (host := _HOST.match(text, m.end())):
            continue
        begin = max(free, m.start() - 280)
        name = _NAME.search(text[begin:m.start()])
        if not name or (end := _kept_host(name[0], m[0], host)) is None:
            continue
        at = begin + name.start()
        out += [(at + d.start(), at + d.end(), ".") for d in _DOTS.finditer(name[0]) if d[0] != "."]
        out += [(m.start(), m.end(), "@")] * (m[0] != "@")
        out += [(m.end() + d.start(), m.end() + d.end(), ".") for d in _DOTS.finditer(host[0], 0, end) if d[0] != "."]
        free = m.end() + end
    return out


def normalise(text: str) -> _Tape | None:
    """The transducers one after the other; None if none of them has anything to rewrite."""
    tape = _Tape(text)
    if not text.isascii():
        tape.rewrite([(m.start(), m.end(), "".join(LOOK_ALIKES.get(c, "") for c in m[0])) for m in _ODD.finditer(text)])
    tape.rewrite(_addresses(tape.text))
    if _NAMED.search(tape.text):
        tape.rewrite([x for m in _SPELLED.finditer(tape.text) for x in _spelled(m)])
    tape.rewrite([(m.start(), m.end(), _SIGN[m[1].lower()]) for m in _BRACKETED.finditer(tape.text)])
    return tape if tape.starts else None


def disguised(text: str, base: list) -> list:
    """Identifiers that only the rewritten text shows, as source spans; none that meets a base span of its kind."""
    tape = normalise(text)
    if tape is None:
        return []
    taken = {k: [(s, e) for s, kind, e in base if kind == k] for k in range(len(KINDS))}
    out = []
    for s, kind, e in detect(tape.text):
        start, end = tape.starts[s], tape.ends[e - 1]
        if text[start:end] == tape.text[s:e]:
            continue
        i = bisect_left(taken[kind], (end, end))
        if not (i and taken[kind][i - 1][1] > start):
            out.append((start, kind, end))
    return out


def _written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(text: str | None) -> tuple:
    text = text or ""
    base = detect(text)
    added = disguised(text, base)
    n = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
    return (*n, hashlib.sha256(_written(base).encode()).hexdigest(), _written(sorted(base + added)), len(added))


def _scan_batch(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([scan(t) for t in texts], columns=[c.split()[0] for c in SCHEMA.split(", ")])


def spans(text: Column) -> Column:
    """A struct of SCHEMA for every whole text; null texts count as empty and have no spans.

    The counts and base_sha256 are those of the base patterns; ``spans`` also
    has the n_added that the method adds. A row depends on its text alone:
    repeated rows get equal results, no shuffle, no state between rows."""
    return F.pandas_udf(_scan_batch, SCHEMA)(text)
