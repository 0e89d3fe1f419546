"""Secret scans: fixed patterns, and passwords found by what guessing them would cost."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame

from peerlight.llm.common import slices

KINDS = ("assign", "access", "hex", "guess")
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
# Words that announce a credential, a separator, and the value up to a blank or quote.
_CONTEXT = re.compile(
    r"""(?ai:pass(?:word|wd|phrase|code)|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|bearer)s?["']?"""
    r"""\s{0,3}(?:is\s|=>|:=|=|:)\s{0,3}["'`]?([^\s"'`,;<>()\[\]{}|]{6,})"""
)

# Common passwords and their parts, most frequent first.
COMMON = (
    "password 123456 12345678 qwerty abc123 letmein monkey dragon iloveyou trustno1 sunshine master welcome shadow "
    "ashley football jesus michael ninja mustang admin administrator login root guest user test demo changeme "
    "secret default pass hello freedom whatever princess starwars computer superman batman soccer hockey "
    "baseball summer winter spring autumn love money access token key server database example"
).split()
_RANK = {word: rank + 1 for rank, word in enumerate(COMMON)}
_LONGEST = max(map(len, COMMON))
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEIGHBOURS = {
    c: {row[j] for j in (i - 1, i + 1) if 0 <= j < len(row)}
    | {other[j] for k in (r - 1, r + 1) if 0 <= k < 4 for other in (_ROWS[k],) for j in (i - 1, i, i + 1) if 0 <= j < len(other)}
    for r, row in enumerate(_ROWS)
    for i, c in enumerate(row)
}
_LEET = str.maketrans("4301$5@7", "aeoissat")
_DATE = re.compile(
    r"(?a:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d)"
)
_YEAR = re.compile(r"(?a:(?:19|20)\d\d)")
_WORDLIKE = re.compile(r"[a-z]{3,12}")
_VOWEL = re.compile(r"[aeiouy]")
_CONSONANTS = re.compile(r"[^aeiouy]{4}")
# log10 costs: a character by brute force, an unlisted pronounceable word, a date, a year, each further span.
BRUTE, WORD, DATE, YEAR, JOIN = 1.0, 4.3, 4.6, 2.1, 0.3


def _spans(value: str) -> Iterator[tuple[int, int, float]]:
    """Cheap spans (start, end, log10 guesses) of a value: words, dates, repeats and keyboard walks."""
    low = value.lower()
    plain = low.translate(_LEET)
    n = len(low)
    for i in range(n):
        for j in range(i + 3, min(n, i + _LONGEST) + 1):
            rank = _RANK.get(low[i:j]) or _RANK.get(plain[i:j])
            if rank:
                altered = (value[i:j] != low[i:j]) + (low[i:j] != plain[i:j] and low[i:j] not in _RANK)
                yield i, j, log10(rank + 1) + 0.3 * altered
        for pattern, cost in ((_DATE, DATE), (_YEAR, YEAR)):
            if m := pattern.match(low, i):
                yield i, m.end(), cost
    for m in _WORDLIKE.finditer(low):
        if _VOWEL.search(m[0]) and not _CONSONANTS.search(m[0]):
            yield m.start(), m.end(), WORD
    for unit in range(1, 9):
        i = 0
        while i + 2 * unit <= n:
            j = i + unit
            while j < n and low[j] == low[j - unit]:
                j += 1
            times = (j - i) // unit
            if times >= (3 if unit == 1 else 2):
                yield i, i + times * unit, unit * BRUTE + log10(times)
                i = max(i + 1, j - unit + 1)
            else:
                i += 1
    i = 0
    while i < n:
        j, turns, step = i + 1, 1, None
        while j < n and low[j] in _NEIGHBOURS.get(low[j - 1], ()):
            move = ord(low[j]) - ord(low[j - 1])
            turns += step is not None and (move > 0) != (step > 0)
            step = move
            j += 1
        if j - i >= 4:
            yield i, j, log10(47 * (j - i)) + turns * log10(4.6)
        i = max(j - 1, i + 1) if j - i >= 4 else i + 1


def guess_cost(value: str) -> float:
    """log10 of the guesses the cheapest segmentation of a value takes: linear in its length."""
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, end, cost in _spans(value):
        ending.setdefault(end, []).append((start, cost))
    best = [0.0]
    for end in range(1, len(value) + 1):
        low = best[end - 1] + BRUTE
        for start, cost in ending.get(end, ()):
            low = min(low, best[start] + cost + (JOIN if start else 0.0))
        best.append(low)
    return best[-1]


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping within each kind."""
    out = [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    return out + [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]


def guess_spans(text: str, least: float) -> list[tuple[int, str, int, float]]:
    """Values in a credential context whose guess cost reaches `least`."""
    out = []
    for m in _CONTEXT.finditer(text):
        value = m[1].rstrip(".!?:")
        if len(value) >= 6 and (cost := guess_cost(value)) >= least:
            out.append((m.start(1), "guess", m.start(1) + len(value), cost))
    return out


def scan_secrets(docs: DataFrame, least: float = 8.0) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end, cost>>) of every whole text, in order of start, then kind.

    Offsets are code points, end exclusive. `guess` spans are credential-context values of at least
    10^`least` guesses; fixed patterns always stay and have no cost. NULL and empty texts have no spans; repeated rows
    stay; other columns are ignored. One narrow pass without a shuffle.
    """
    kind = {k: i for i, k in enumerate(KINDS)}
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                for text in batch.column("text").to_pylist():
                    found = [(s, k, e, None) for s, k, e in base_spans(text)] + guess_spans(text, least) if text else []
                    found.sort(key=lambda x: (x[0], kind[x[1]], x[2]))
                    rows.append([{"kind": k, "start": s, "end": e, "cost": c} for s, k, e, c in found])
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "spans": pa.array(rows, pa.list_(item))})

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind string, start long, end long, cost double>>"
    )
