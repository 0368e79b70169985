"""Personal data with offset-preserving deobfuscation.

Identifiers are found twice: in the text itself (the base spans), and in a
normalised copy made by small transducers that undo look-alike letters, spelled
digits and at/dot disguises.  A transducer keeps, for every character it writes,
the source range that it came from, so spans of the copy map back to code points
of the source.  Base spans stay; spans of the copy are added unless a base span
of the same kind holds them, so a base match of only a part of a disguised
identifier stays beside the whole.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type

KINDS = ("email", "ip", "card", "phone")

# Patterns of the contract (fixed values).  Plain searches for EMAIL and IP try
# again from every character of a long run, so ``detect`` finds the same matches
# from their anchors instead; CARD and PHONE never read a character twice.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Look-alike letters without a compatibility mapping of their own (fixed values).
HOMOGLYPHS = dict(zip("аеорсхуіјѕԁһкмтвнАВЕКМНОРСТХІЈЅοαρνυικτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                      "aeopcxyijsdhkmtbhABEKMHOPCTXIJSoapvuiktABEZHIKMNOPTYX"))
DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
          "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
INVISIBLE = re.compile("[­​-‏⁠﻿]")
ODD = re.compile("[^\x00-ɏḀ-ỿ‐-›]|[­​-‏]")

_digit = "(?:" + "|".join(DIGITS) + ")"
SPELLED = re.compile(rf"(?i)\b(?:plus[ -]+)?(?:{_digit}|[0-9])(?:[ ,.-]+(?:{_digit}|[0-9]+)){{6,}}\b")
WORDY = re.compile(rf"{_digit}[ ,.-]+(?:{_digit}|[0-9])")        # on lower-case text
DIGIT_WORD = re.compile(rf"(?i)\b(?:{_digit}|plus)\b")
# name [at] host [dot] tld: the bracketed words, blanks around them added by hand
BRACKET_AT = re.compile(r"(?i)[\[({<]\s*(?:at|@)\s*[\])}>]")
BRACKET_DOT = re.compile(r"(?i)[\[({<]\s*(?:dot|\.)\s*[\])}>]")
BRACKETED = re.compile(r"[\[({<]\s*(?:at|dot|@|\.)\s*[\])}>]")   # on lower-case text
DOT_WORD = re.compile(r"\sdot\s")
AT_HOST = re.compile(r"\sat\s+[\w-]+\.")
# the signs between name and host, and what may follow them
AT = re.compile(r"(?i)@|(?<=[\w.%+-])\s+at\s+(?=\w)")
LABELS = re.compile(r"(?i)[\w-]+(?:(?:\.|\s+dot\s+)[\w-]+)*")
LABEL_DOT = re.compile(r"(?i)(?<!\s)\s+dot\s+")
NAME = re.compile(r"[\w.%+-]")
VISIBLE = re.compile(r"\S")
# a plain " at " before a host written with real dots counts under these endings (fixed values)
ENDINGS = {"com", "org", "net", "edu", "gov", "int", "info", "biz", "io", "co", "eu", "de", "fr", "es", "it", "nl",
           "uk", "us", "ca", "au", "ch", "at", "be", "pl", "se", "in", "jp", "cn", "br", "ru", "app", "dev"}
_number = rf"(?:{_digit}|[0-9]{{1,3}})(?:[ ,-]+(?:{_digit}|[0-9]))" + "{0,2}"
SPELLED_IP = re.compile(rf"(?i)\b{_number}(?:\s+dot\s+{_number}){{3}}\b")
SPELLED_DOT = re.compile(rf"{_digit}\s+dot\s+(?:{_digit}|[0-9])|[0-9]\s+dot\s+(?:{_digit}|[0-9])")   # on lower-case text


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str):
    """Spans of EMAIL's leftmost non-overlapping matches, in linear time: a match
    starts where the run of name characters before an @ starts."""
    done, prev, at = 0, 0, text.find("@")
    while at >= 0:
        if at >= done:
            left = text[max(done, prev):at]
            name = len(left) - len(left.rstrip(LOCAL))
            host = HOST.match(text, at + 1) if name else None
            if host:
                yield at - name, host.end()
                done = host.end()
        prev = at + 1
        at = text.find("@", prev)


def _ips(text: str):
    """Spans of IP's matches: every four numbers of a dotted run, from its start."""
    for run in NUMBERS.finditer(text):
        if run[0].count(".") >= 3:
            parts, at = run[0].split("."), run.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i:i + 4]
                end = at + sum(map(len, four)) + 3
                yield at, end, four
                at = end + 1


def detect(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end): leftmost non-overlapping matches of each kind that pass its check."""
    out = [(0, a, b) for a, b in _emails(text)]
    for a, b, four in _ips(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
            out.append((1, a, b))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum(ch in "0123456789" for ch in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


class Tape:
    """A rewritten text; character i comes from source[begin[i]:end[i]]."""

    def __init__(self, text: str):
        self.text = text
        self.begin = list(range(len(text)))
        self.end = list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace text[a:b] by s for ascending, disjoint (a, b, s)."""
        if not edits:
            return
        text, begin, end, at = [], [], [], 0
        for a, b, s in edits:
            text.append(self.text[at:a])
            begin += self.begin[at:a]
            end += self.end[at:a]
            if s:
                text.append(s)
                begin += [self.begin[a]] * len(s)
                end += [self.end[b - 1]] * len(s)
            at = b
        text.append(self.text[at:])
        self.begin = begin + self.begin[at:]
        self.end = end + self.end[at:]
        self.text = "".join(text)


def _fold_letters(t: Tape) -> None:
    edits = []
    for m in ODD.finditer(t.text):
        ch = m[0]
        plain = "" if INVISIBLE.match(ch) else HOMOGLYPHS.get(ch) or unicodedata.normalize("NFKC", ch)
        if plain != ch and plain.isascii():
            edits.append((*m.span(), plain))
    t.rewrite(edits)


def _fold_digits(t: Tape) -> None:
    edits = []
    for run in SPELLED_IP.finditer(t.text):
        for m in re.finditer(r"\w+|[^\w]+", run[0]):
            a, b = run.start() + m.start(), run.start() + m.end()
            word = m[0].lower()
            if word in DIGITS:
                edits.append((a, b, DIGITS[word]))
            elif word == "dot":
                edits.append((a, b, "."))
            elif not m[0][0].isalnum():
                edits.append((a, b, ""))
    t.rewrite(edits)
    edits = []
    for run in SPELLED.finditer(t.text):
        if not DIGIT_WORD.search(run[0]):
            continue
        for m in re.finditer(r"\w+|[^\w]+", run[0]):
            a, b = run.start() + m.start(), run.start() + m.end()
            word = m[0].lower()
            if word in DIGITS:
                edits.append((a, b, DIGITS[word]))
            elif word == "plus":
                edits.append((a, b, "+"))
            elif not m[0][0].isalnum():
                edits.append((a, b, ""))        # separators between spelled digits
    t.rewrite(edits)


def _with_blanks(text: str, a: int, b: int, done: int) -> tuple[int, int]:
    """The span with the blanks around it, not before ``done``."""
    m = VISIBLE.search(text, b)
    return _skip_blanks(text, done, a), m.start() if m else len(text)


def _skip_blanks(text: str, done: int, at: int) -> int:
    while at > done and text[at - 1].isspace():
        at -= 1
    return at


def _name_dots(text: str, done: int, end: int) -> tuple[int, list[tuple[int, int]]]:
    """Start of the name that ends at ``end`` (not before ``done``) and the
    spelled dots in it."""
    dots = []
    at = end
    while True:
        start = at
        while start > done and NAME.match(text[start - 1]):
            start -= 1
        if start == at:                     # a dot word without a name before it: not part of the name
            return (dots.pop()[1], dots) if dots else (end, [])
        left = _skip_blanks(text, done, start)
        word = text[max(done, left - 3):left]
        before = left - 3
        if left == start or word.lower() != "dot" or before <= done or not text[before - 1].isspace():
            return start, dots
        name_end = _skip_blanks(text, done, before)
        dots.append((name_end, start))
        at = name_end


def _fold_disguises(t: Tape) -> None:
    for pattern, plain in ((BRACKET_AT, "@"), (BRACKET_DOT, ".")):
        edits, done = [], 0
        for m in pattern.finditer(t.text):
            a, b = _with_blanks(t.text, *m.span(), done)
            edits.append((a, b, plain))
            done = b
        t.rewrite(edits)
    edits, done = [], 0
    for m in AT.finditer(t.text):
        if m.start() < done:
            continue
        host = LABELS.match(t.text, m.end())
        if not host:
            continue
        start, dots = _name_dots(t.text, done, m.start())
        if start == m.start():
            continue
        spelled = list(LABEL_DOT.finditer(host[0]))
        last = re.split(r"(?i)\.|\s+dot\s+", host[0])
        if m[0] != "@" and not (len(last) > 1 and (spelled or last[-1].lower() in ENDINGS)):
            continue                        # "at" as a plain word
        done = host.end()
        if m[0] == "@" and not spelled and not dots:
            continue
        edits += [(a, b, ".") for a, b in reversed(dots)]
        if m[0] != "@":
            edits.append((*m.span(), "@"))
        edits += [(host.start() + d.start(), host.start() + d.end(), ".") for d in spelled]
    t.rewrite(edits)


def spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each (kind, start, end) by start, then kind."""
    text = text or ""
    order = lambda x: (x[1], x[0])
    base = sorted(detect(text), key=order)
    # cheap tests first: most texts have no trace of a disguise
    low = text.lower()
    odd = not text.isascii() and ODD.search(text)
    spelled = (any(w in low for w in DIGITS) and WORDY.search(low)) or ("dot" in low and SPELLED_DOT.search(low))
    disguised = BRACKETED.search(low) or ("dot" in low and DOT_WORD.search(low)) or AT_HOST.search(low)
    if not (odd or spelled or disguised):
        return base, base
    t = Tape(text)
    if odd:
        _fold_letters(t)
    if spelled or odd:
        _fold_digits(t)
    if disguised or odd:
        _fold_disguises(t)
    if t.text == text:
        return base, base
    found = list(base)
    own = [[(a, b) for k, a, b in base if k == kind] for kind in range(len(KINDS))]
    for kind, a, b in detect(t.text):
        a, b = t.begin[a], t.end[b - 1]
        i = bisect.bisect_right(own[kind], (a, len(text) + 1)) - 1      # the last base span that starts by a
        if i < 0 or own[kind][i][1] < b:
            found.append((kind, a, b))
    return base, sorted(found, key=order)


def written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in found)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, base counts n_email, n_ip, n_card, n_phone, base_sha256
    (of the base spans as written by ``written``), spans (all spans) and n_added
    (those that only the normalised copy shows).

    NULL and empty texts have no span.  Offsets count code points; the end is
    exclusive.  Rows that repeat an id or have none are rows of their own.  A
    text is read whole, in time proportional to its length.
    """
    def run(batches):
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                base, found = spans(t)
                rows.append((*[sum(k == i for k, _, _ in base) for i in range(4)],
                             hashlib.sha256(written(base).encode()).hexdigest(),
                             written(found), len(found) - len(base)))
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                 pa.array(cols[5], pa.string()), pa.array(cols[6], pa.int64())],
                ["_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    schema = (f"_id {id_type(docs, id_col)}, n_email long, n_ip long, n_card long, n_phone long, "
              "base_sha256 string, spans string, n_added long")
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .mapInArrow(run, schema).withColumnRenamed("_id", id_col))
