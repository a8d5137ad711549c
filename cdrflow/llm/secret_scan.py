"""Secret scans: fixed patterns plus a randomness test battery.

Base spans come from three patterns (assignments of a named secret, access
key ids, hex runs).  The method adds spans of kind ``random``: every long
token of key characters is a candidate and its encoding is inferred as the
smallest alphabet that holds it.  A candidate is reported when

* the hypothesis "drawn uniformly from that alphabet" is not rejected by
  Fisher's combination of three tests (chi-squared uniformity, runs about the
  median, lag-one serial correlation), and
* the opposite hypothesis "a word of text" is rejected under false-discovery
  control over all candidates of the document.  Two tests give its p-value:
  the likelihood of the token under its encoding against that under a chain of
  text (letters in their frequencies, vowels and consonants in turn, few
  changes of character class, short numbers), and the binomial tail of the
  number of class changes.  The Benjamini-Hochberg steps are weighted by
  candidate length, so that short tokens, on which all tests are weak, need
  stronger evidence.

Each document is judged by itself, so the scan is a map without a shuffle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")

# The three base patterns, least lengths 12 (value), 18, 16.
_NAMES = ("password", "passwd", "secret", "token", "api_?key")


def _either_case(name: str) -> str:
    # Spelled out: IGNORECASE would also accept non-ASCII letters.
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


ASSIGN = re.compile("(" + "|".join(map(_either_case, _NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (
    ("decimal", _DIGITS),
    ("hex", _DIGITS + "abcdef"),
    ("upper hex", _DIGITS + "ABCDEF"),
    ("lower", _LOWER),
    ("upper", _LOWER.upper()),
    ("base32", _LOWER.upper() + "234567"),
    ("base36", _DIGITS + _LOWER),
    ("upper base36", _DIGITS + _LOWER.upper()),
    ("letters", _LOWER.upper() + _LOWER),
    ("base62", _DIGITS + _LOWER.upper() + _LOWER),
    ("base64", _LOWER.upper() + _LOWER + _DIGITS + "+/"),
    ("base64url", _LOWER.upper() + _LOWER + _DIGITS + "-_"),
    ("key characters", _LOWER.upper() + _LOWER + _DIGITS + "+/-_="),
)
_CODES = [(name, {c: i for i, c in enumerate(chars)}) for name, chars in ALPHABETS]
_SIZES = {name: len(chars) for name, chars in ALPHABETS}
_SYMBOLS = "+/_=-"
_CLASS = {c: k for k, chars in enumerate((_DIGITS, _LOWER, _LOWER.upper(), _SYMBOLS)) for c in chars}
_DIGIT = _CLASS["0"]

TEXT_SWITCH = 0.12  # chance that two neighbours in a word of text differ in class
NUMBER_SWITCH = 0.25  # the same after a digit: numbers in text are short
TEXT_VOWEL = {True: 0.2, False: 0.55}  # chance of a vowel in text after a vowel, after a consonant
# Letters of text in per mille: about the mean of English, German, French and Spanish.
_PER_MILLE = dict(zip(_LOWER, (86, 14, 33, 45, 145, 13, 17, 32, 70, 4, 6, 46, 27, 76, 60, 20, 6, 66, 73, 67, 40, 12, 11, 3, 8, 5)))
RARE = 0.1  # share of letters of text that are like any other: names, abbreviations
FDR = 1e-4
BATTERY_ALPHA = 1e-3


_VOWELS = frozenset("aeiou")


def _letter_logs() -> tuple[dict[str, float], dict[bool, dict[str, float]]]:
    """Log chances of a letter of text: alone, and by whether a vowel stands before it."""
    total = sum(_PER_MILLE.values())
    alone = {c: (1 - RARE) * x / total + RARE / len(_LOWER) for c, x in _PER_MILLE.items()}
    vowels = sum(alone[c] for c in _VOWELS)
    after = {
        before: {
            c: math.log(x / vowels * chance if c in _VOWELS else x / (1 - vowels) * (1 - chance))
            for c, x in alone.items()
        }
        for before, chance in TEXT_VOWEL.items()
    }
    return {c: math.log(x) for c, x in alone.items()}, after


_ALONE, _AFTER = _letter_logs()


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding_of(token: str) -> tuple[str, list[int]]:
    """The smallest alphabet that holds the token (without = padding) and its codes."""
    body = token.rstrip("=") or token
    for name, codes in _CODES:
        if all(c in codes for c in body):
            return name, [codes[c] for c in body]
    raise ValueError(f"not a key token: {token!r}")


def uniformity_p(codes: list[int], size: int) -> float:
    """Chi-squared test that all letters are equally likely (Wilson-Hilferty tail)."""
    counts = [0] * size
    for c in codes:
        counts[c] += 1
    expected = len(codes) / size
    chi2, df = sum((x - expected) ** 2 for x in counts) / expected, size - 1
    scale = 2 / (9 * df)
    return _normal_tail(((chi2 / df) ** (1 / 3) - (1 - scale)) / math.sqrt(scale))


def runs_p(codes: list[int], size: int) -> float:
    """Two-sided runs test about the middle of the alphabet."""
    high = [2 * c >= size for c in codes]
    a = sum(high)
    b = len(high) - a
    if not a or not b:
        return 0.5 ** (len(high) - 1)
    runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
    n = a + b
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / max(n - 1, 1)
    return 1.0 if var <= 0 else min(1.0, 2 * _normal_tail(abs(runs - mean) / math.sqrt(var)))


def serial_p(codes: list[int]) -> float:
    """Two-sided test of the lag-one correlation."""
    n = len(codes)
    mean = sum(codes) / n
    dev = [c - mean for c in codes]
    var = sum(d * d for d in dev)
    if n < 3 or not var:
        return 0.0
    r = sum(x * y for x, y in zip(dev, dev[1:])) / var
    return min(1.0, 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n)))


def battery_p(token: str) -> float:
    """Fisher's combination of the three tests; small: the token is not random."""
    name, codes = encoding_of(token)
    size = _SIZES[name]
    ps = (uniformity_p(codes, size), runs_p(codes, size), serial_p(codes))
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def text_log_likelihood(token: str) -> float:
    """Log chance of the token as a word of text of this length."""
    log, last, vowel = 0.0, -1, None
    for c in token:
        kind = _CLASS[c]
        if last < 0:
            log -= math.log(4)
        else:
            switch = NUMBER_SWITCH if last == _DIGIT else TEXT_SWITCH
            log += math.log(1 - switch if kind == last else switch / 3)
        last = kind
        low = c.lower()
        if low in _ALONE:
            log += _ALONE[low] if vowel is None else _AFTER[vowel][low]
            vowel = low in _VOWELS
        else:
            log -= math.log(len(_DIGITS) if kind == _DIGIT else len(_SYMBOLS))
            vowel = None
    return log


def likelihood_p(token: str) -> float:
    """Upper bound of P(so great a likelihood ratio) for a word of text.

    The ratio of the likelihoods under the inferred encoding and under text has
    a mean of at most the number of encodings, so Markov's inequality bounds it.
    """
    body = token.rstrip("=") or token
    name, codes = encoding_of(token)
    log = math.log(len(ALPHABETS)) + len(codes) * math.log(_SIZES[name]) + text_log_likelihood(body)
    return math.exp(min(0.0, log))


def evidence_p(token: str) -> float:
    """Both tests against text as one p-value (Bonferroni); small: no word of text."""
    return min(1.0, 2 * min(likelihood_p(token), text_p(token)))


def text_p(token: str, switch: float = TEXT_SWITCH) -> float:
    """P(at least so many class changes) in a word of text of this length."""
    n = len(token) - 1
    seen = sum(_CLASS[a] != _CLASS[b] for a, b in zip(token, token[1:]))
    if not seen:
        return 1.0
    odds, term, tail = switch / (1 - switch), 0.0, 0.0
    term = math.lgamma(n + 1) - math.lgamma(seen + 1) - math.lgamma(n - seen + 1)
    term = math.exp(term + seen * math.log(switch) + (n - seen) * math.log(1 - switch))
    for k in range(seen, n + 1):
        tail += term
        term *= odds * (n - k) / (k + 1)
    return min(1.0, tail)


def discoveries(tokens: list[str], fdr: float = FDR) -> list[bool]:
    """Length-weighted Benjamini-Hochberg over one document's candidates."""
    total = sum(map(len, tokens))
    m = len(tokens)
    weighted = [evidence_p(t) * total / (m * len(t)) for t in tokens]
    cut = 0.0
    for k, p in enumerate(sorted(weighted), 1):
        if p <= fdr * k / m:
            cut = p
    return [p <= cut and p < 1 and cut > 0 for p in weighted]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def secret_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind in the order of ``KINDS``."""
    if not text:
        return []
    found = base_spans(text)
    tokens = [(m.start(), m.end(), m[0]) for m in CANDIDATE.finditer(text)]
    if tokens:
        base = sorted((s, e) for s, e, _ in found)
        starts = [s for s, _ in base]
        reach = list(accumulate((e for _, e in base), max))  # the farthest end of the spans so far
        for (s, e, token), hit in zip(tokens, discoveries([t for _, _, t in tokens])):
            before = bisect_left(starts, e)  # spans that start before the token ends
            if hit and battery_p(token) >= BATTERY_ALPHA and not (before and reach[before - 1] > s):
                found.append((s, e, "random"))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


_SCHEMA = "array<struct<start:long,end:long,kind:string>>"


def _spans_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in series:
        yield pd.Series([[{"start": s, "end": e, "kind": k} for s, e, k in secret_spans(t)] for t in texts], dtype=object)


def span_column(text: str):
    """Column of the spans of ``text`` (a column name)."""
    return F.pandas_udf(_spans_of, _SCHEMA)(F.col(text))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): one row per input row, spans in code points, end exclusive.

    Null and empty texts have no spans; ids are carried as they are (null and
    repeated ones too); other columns are ignored; an empty table gives an
    empty result.
    """
    return docs.select(F.col(id_col).alias(id_col), span_column(text_col).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans become one.

    Null and empty texts, repeated rows and null ids stay as they are; an empty
    table stays empty.
    """

    def cut(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series([_redacted(t, mark) for t in texts], dtype=object)

    return docs.withColumn(text_col, F.pandas_udf(cut, "string")(F.col(text_col)))


def _redacted(text: str | None, mark: str) -> str | None:
    spans = secret_spans(text)
    if not spans:
        return text
    out, at = [], 0
    for s, e, _ in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def span_digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the digest of the base spans and the text form of all spans."""
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    of = lambda *kinds: F.filter("spans", lambda x: x["kind"].isin(*kinds))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, text))
    return scanned.select(
        id_col,
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(of(*KINDS[:3])).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(of("random")).cast("long").alias("n_random"),
    )
