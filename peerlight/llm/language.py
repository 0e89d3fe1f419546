"""Language identification by cross-parsing against one suffix automaton per language."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlight.llm.common import carried, passed, releasing, slices, with_carried

UNKNOWN = "und"
HOLD_OUT = 2
BLANK = 0
# Texts are parsed in segments of so many symbols, each with its own first phrase.
SEGMENT = 512


def suffix_automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    """Transitions [state, symbol] of the automaton of all substrings; 0 is no transition, 1 the root."""
    moves: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in symbols:
        now = len(moves)
        moves.append({})
        link.append(1)
        length.append(length[last] + 1)
        p = last
        while p and c not in moves[p]:
            moves[p][c] = now
            p = link[p]
        if p:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    table = np.zeros((len(moves), alphabet), np.int32)
    for state, row in enumerate(moves):
        for c, to in row.items():
            table[state, c] = to
    return table


def _fold(text: str) -> str:
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)], bool)


class LanguageModel:
    """Stacked automata of all learned languages and the symbols their texts use."""

    def __init__(self, samples: dict[str, list[str]], chars: int, max_symbols: int = 64):
        self.languages = sorted(samples)
        texts = {lang: [_fold(t) for t in samples[lang]] for lang in self.languages}
        counts = Counter(c for parts in texts.values() for t in parts for c in t if c.isalpha())
        kept = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: max_symbols - 2]]
        self.symbol = {c: i + 1 for i, c in enumerate(kept)}
        self.alphabet = len(kept) + 2
        tables, self.roots, self.weights = [], [], []
        base = 0
        for lang in self.languages:
            codes = self._codes("".join(" " + t for t in texts[lang])[:chars])
            table = suffix_automaton(codes.tolist(), self.alphabet)
            tables.append(np.where(table > 0, (table + base) * self.alphabet, 0))
            self.roots.append((base + 1) * self.alphabet)
            self.weights.append(np.log2(max(2, len(codes))))
            base += len(table)
        self.moves = np.concatenate(tables).ravel().astype(np.int32) if tables else np.zeros(0, np.int32)

    @property
    def other(self) -> int:
        return self.alphabet - 1

    def table(self) -> np.ndarray:
        """Symbol of every code point: blanks for all but letters, one symbol for letters not learned."""
        out = np.where(_letters(), self.other, BLANK).astype(np.uint8)
        for c, i in self.symbol.items():
            for form in {c, c.upper(), c.title()}:
                if len(form) == 1 and form.lower() == c:
                    out[ord(form)] = i
        return out

    def _codes(self, text: str) -> np.ndarray:
        codes = self.table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        return codes[~((codes == BLANK) & (np.concatenate([[1], codes[:-1]]) == BLANK))]

    def phrases(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases [language, text] of texts that end at `ends`, all texts and languages in step."""
        starts = np.concatenate([[0], ends[:-1]])
        pieces = -(-(ends - starts) // SEGMENT)
        owner = np.repeat(np.arange(len(ends)), pieces)
        first = np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[owner] + (np.arange(len(owner)) - first) * SEGMENT
        size = np.minimum(SEGMENT, ends[owner] - begin)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(owner), axis=1)
        count = np.ones(state.shape, np.int32)
        active = np.searchsorted(-size, -np.arange(SEGMENT), side="left")
        for step in range(int(size[0]) if len(size) else 0):
            n = active[step]
            c = symbols[begin[:n] + step].astype(np.int32)
            now = state[:, :n]
            to = self.moves.take(now + c)
            lang, lane = np.nonzero(to == 0)
            again = self.moves.take(roots[lang, 0] + c[lane])
            # The phrase ends before this symbol; a symbol unknown to the language is a phrase itself.
            count[lang, lane] += (now[lang, lane] != roots[lang, 0]).astype(np.int32) + (again == 0)
            to[lang, lane] = np.where(again == 0, roots[lang, 0], again)
            state[:, :n] = to
        out = np.zeros((len(self.languages), len(ends)))
        for row in range(len(self.languages)):
            out[row] = np.bincount(owner, count[row], len(ends))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each whole text."""
        sizes = np.array([len(t or "") for t in texts])
        points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self._table[points] if hasattr(self, "_table") else self._keep_table()[points]
        text = np.repeat(np.arange(len(texts)), sizes)
        letter = np.bincount(text[_letters()[points]], minlength=len(texts)) > 0
        head = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
        keep = (codes != BLANK) | head | (np.concatenate([[1], codes[:-1]]) != BLANK)
        codes, text = codes[keep], text[keep]
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        ends = np.searchsorted(text, np.arange(len(texts)), side="right")
        cost = self.phrases(codes, ends) * np.array(self.weights)[:, None]
        best = cost.argmin(axis=0)
        ordered = np.sort(cost, axis=0)
        second = ordered[1] if len(cost) > 1 else np.maximum(ends - np.concatenate([[0], ends[:-1]]), 1) * self.weights[0]
        score = np.clip(1 - ordered[0] / np.maximum(second, 1e-9), 0.0, 1.0)
        return (
            [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letter)],
            [float(s) if ok else 0.0 for s, ok in zip(score, letter)],
        )

    def _keep_table(self) -> np.ndarray:
        self._table = self.table()
        return self._table


def _held_out():
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    return F.coalesce(remainder == HOLD_OUT, F.lit(False))


def learn_languages(
    docs: DataFrame, docs_per_language: int = 64, chars: int = 16_000, model_bytes: int = 96 << 20
) -> LanguageModel:
    """Fit the automata on a bounded sample: per language about 3 x `docs_per_language` rows are drawn by a hash
    of doc_id from all labelled rows outside the held-out quarter, and their distinct texts joined to
    `chars` characters (fewer when so many languages would pass `model_bytes`).
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~_held_out()).filter(
        F.coalesce(F.octet_length("text"), F.lit(0)) > 0
    )
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LanguageModel({}, chars)
    chars = max(500, min(chars, model_bytes // (len(sizes) * 2 * 64 * 4)))
    each = max(200, 2 * chars // docs_per_language)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rate = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, 3 * docs_per_language / n) * (1 << 30)))])
    rows = known.filter(draw < rate[F.col("lang")]).select("lang", draw.alias("draw"), F.substring("text", 1, each).alias("text"))
    samples: dict[str, list[str]] = {lang: [] for lang in sizes}
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["draw"], r["text"])):
        if r["text"] not in samples[r["lang"]]:
            samples[r["lang"]].append(r["text"])
    return LanguageModel({lang: texts for lang, texts in samples.items() if texts}, chars)


def identify_language(docs: DataFrame, model: LanguageModel | None = None, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; only the text is looked at.

    `und` with score 0 for NULL texts, texts without a letter, and when nothing was learned; equal costs go to the first
    language by name. score is 1 - cost of the best / cost of the second. Rows without doc_id are not held
    out. One narrow pass; the model is broadcast and bounded by `learn_languages`. Columns named by `carry` come
    along as the struct `carried`; all others are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or learn_languages(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                lang, score = shared.value.predict(batch.column("text").to_pylist())
                out = {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "lang_pred": pa.array(lang, pa.string()),
                    "score": pa.array(score, pa.float64()),
                }
                yield passed(batch, out)

    rows = docs.select("doc_id", _held_out().alias("held_out"), "text", *carried(carry))
    return rows.mapInArrow(releasing(run), with_carried("doc_id long, held_out boolean, lang_pred string, score double", rows))
