"""Byte-level BPE encoding with DuckDB's recursive SQL inside each partition, and decoding from the vocabulary."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from peerlight.llm.common import bound_batches, release_memory, releasing, slices

# Words longer than this go through a heap by the same rule: the recursion takes as many rounds as a word has merges.
LONG_WORD = 512
# Words whose ids a worker remembers besides those of the slice at hand: when the younger half is full, words not
# met since the last time are forgotten, so memory stays bounded and common words are never learned again.
REMEMBERED = 200_000
# Bytes of texts encoded in one step.
SLICE = 2 << 20
# Words one recursive query contracts at a time, the squares of their lengths added up (the recursion keeps every
# round, so a word of L bytes takes up to L * L / 2 rows), and the memory its database may hold.
WORDS_PER_QUERY = 4_000
SQUARES_PER_QUERY = 1 << 20
DATABASE_MEMORY = "150MB"

# A match of the pattern starts at every blank unless two or more white-space characters stand before it, so
# texts without this may be cut at all blanks.
_UNEVEN = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "

# A row is a token with its follower. Every round joins these pairs with the merge table and contracts each
# word's leftmost pair of least rank; a word without such a pair leaves the recursion with its tokens. A pick is one
# number of rank, place and next place, which are below 1024 in words of at most LONG_WORD bytes.
_ENCODE = """
WITH RECURSIVE state(step, w, pos, tok, next_pos, next_tok) AS (
  SELECT 0, w, pos, tok, lead(pos) OVER word, lead(tok) OVER word
  FROM start WINDOW word AS (PARTITION BY w ORDER BY pos)
  UNION ALL (
    WITH best AS (
      SELECT w, min((rank::BIGINT << 20) + (pos << 10) + next_pos) AS pick
      FROM state JOIN merges ON lhs = tok AND rhs = next_tok GROUP BY w),
    gone AS (
      SELECT s.w, (pick >> 20)::INTEGER AS rank, ((pick >> 10) & 1023)::INTEGER AS hit, s.pos AS gone_pos, s.next_pos, s.next_tok
      FROM best JOIN state s ON s.w = best.w AND s.pos = (pick & 1023)::INTEGER)
    SELECT s.step + 1, s.w, s.pos,
      CASE WHEN s.pos = hit THEN rank ELSE s.tok END,
      CASE WHEN s.pos = hit THEN g.next_pos ELSE s.next_pos END,
      CASE WHEN s.pos = hit THEN g.next_tok WHEN s.next_pos = hit THEN rank ELSE s.next_tok END
    FROM state s JOIN gone g ON s.w = g.w WHERE s.pos <> gone_pos))
SELECT w, tok FROM state JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) USING (w, step)
ORDER BY w, pos
"""


class Codec:
    """Ranks of one vocabulary file, its merge table in an in-process database, and words met before."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        import duckdb
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.find = regex.compile(pattern).findall
        self.byte_token = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pieces = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            pieces[rank] = token
        self.pieces = pa.array(pieces, pa.large_binary())
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.fading: dict[str, bytes] = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DATABASE_MEMORY, "temp_directory": ""})
        merges = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None
            and (right := self.ranks.get(token[cut:])) is not None
        ]
        table = pa.table(dict(zip(("lhs", "rhs", "rank"), map(lambda x: pa.array(x, pa.int32()), zip(*merges)))))
        self.db.register("merge_rows", table)
        self.db.execute("CREATE TABLE merges AS FROM merge_rows")
        self.db.unregister("merge_rows")
        del merges, table
        release_memory()

    def _contract(self, words: list[bytes]) -> Iterator[bytes]:
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
        start = pa.table(
            {
                "w": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
                "pos": (np.arange(len(flat)) - starts).astype(np.int32),
                "tok": self.byte_token[flat],
            }
        )
        self.db.register("start", start)
        found = self.db.sql(_ENCODE).to_arrow_table()
        raw = found.column("tok").to_numpy().astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(found.column("w").to_numpy(), minlength=len(words)) * 4).tolist()
        for low, high in zip([0, *ends], ends):
            yield raw[low:high]

    def _long(self, word: bytes) -> bytes:
        """The same contraction for one very long word: least rank first, leftmost among equals."""
        parts = [word[i : i + 1] for i in range(len(word))]
        right = [*range(1, len(word)), -1]
        left = list(range(-1, len(word) - 1))
        heap: list[tuple[int, int, bytes]] = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] >= 0 and (rank := self.ranks.get(pair := parts[i] + parts[right[i]])) is not None:
                heapq.heappush(heap, (rank, i, pair))

        for i in range(len(word)):
            offer(i)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i]
            if not parts[i] or j < 0 or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j] = pair, b""
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            offer(left[i])
            offer(i)
        return np.array([self.ranks[p] for p in parts if p], "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of words; those the vocabulary holds whole need no contraction."""
        todo: list[tuple[str, bytes]] = []
        for w in words:
            raw = w.encode()
            if (rank := self.ranks.get(raw)) is not None:
                self.known[w] = rank.to_bytes(4, "little")
            elif len(raw) > LONG_WORD:
                self.known[w] = self._long(raw)
            else:
                todo.append((w, raw))
        todo.sort(key=lambda pair: len(pair[1]))
        squares = np.cumsum([len(raw) ** 2 for _, raw in todo])
        low = 0
        while low < len(todo):
            room = SQUARES_PER_QUERY + (squares[low - 1] if low else 0)
            high = min(low + WORDS_PER_QUERY, max(low + 1, int(np.searchsorted(squares, room, "right"))))
            part = todo[low:high]
            self.known.update(zip([w for w, _ in part], self._contract([raw for _, raw in part])))
            low = high

    def _remind(self, words: Iterable[str]) -> None:
        """Words met not too long ago become young again."""
        for w in words:
            if (ids := self.fading.pop(w, None)) is not None:
                self.known[w] = ids

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of texts that begin and end where matches of the pattern do."""
        if len(self.known) > self.remembered // 2:
            self.known, self.fading = {}, self.known
        known = self.known
        out = list(map(known.get, chunks))
        new = [i for i, ids in enumerate(out) if ids is None]
        if self.fading:
            self._remind([chunks[i] for i in new])
            for i in new:
                out[i] = known.get(chunks[i])
            new = [i for i in new if out[i] is None]
        split = [self.find(chunks[i]) for i in new]
        words = set(chain.from_iterable(split))
        todo = words - known.keys()
        if self.fading:
            self._remind(todo)
            todo -= known.keys()
        self._learn(todo)
        get = known.__getitem__
        for i, found in zip(new, split):
            out[i] = get(found[0]) if len(found) == 1 else b"".join(map(get, found))
        for w in words:
            if len(w) > LONG_WORD:
                del known[w]
        return out

    def encode(self, texts: pa.Array) -> pa.Array:
        """Little-endian unsigned 32-bit ids of each whole text; each distinct part of a batch is looked up once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _UNEVEN)
        whole = pc.if_else(odd, texts, "").to_pylist()
        parts = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        starts = parts.offsets.to_numpy()
        flat = parts.flatten().dictionary_encode()
        heads = parts.flatten().take(pa.array(starts[:-1])).dictionary_encode()
        spaced = [" " + c for c in flat.dictionary.to_pylist()]
        ids = self._chunk_ids(spaced + heads.dictionary.to_pylist())
        codes = flat.indices.to_numpy().copy()
        codes[starts[:-1]] = heads.indices.to_numpy() + len(spaced)
        out = _joined(pa.array(ids, pa.large_binary()).take(pa.array(codes)), starts)
        uneven = [i for i, text in enumerate(whole) if text]
        if uneven:
            # Every match of such a text is a chunk of its own.
            own = [self.find(whole[i]) for i in uneven]
            distinct = list({w for words in own for w in words})
            get = dict(zip(distinct, self._chunk_ids(distinct))).__getitem__
            rows = out.to_pylist()
            for i, words in zip(uneven, own):
                rows[i] = b"".join(map(get, words))
            out = pa.array(rows, pa.large_binary())
        return out.cast(pa.binary())

    def decode(self, ids: pa.Array) -> pa.Array:
        """Bytes of each id sequence: the vocabulary's piece of every id, one after the other."""
        raw = pc.fill_null(ids.cast(pa.large_binary()), b"")
        ends = distinct_offsets(raw) // 4
        if not ends[-1]:
            return pa.array([b""] * len(raw), pa.binary())
        return _joined(self.pieces.take(pa.array(np.frombuffer(_content(raw), "<u4"))), ends).cast(pa.binary())


def _content(array: pa.Array) -> memoryview:
    """All bytes of a large array of strings or binaries, one value after the other."""
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    return memoryview(array.buffers()[2] or b"")[offsets[0] : offsets[-1]] if len(array) else memoryview(b"")


def distinct_offsets(array: pa.Array) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(pc.binary_length(array).to_numpy(zero_copy_only=False))]).astype(np.int64)


def _joined(pieces: pa.Array, starts: np.ndarray) -> pa.Array:
    """The binary pieces of each row, which follow each other from starts[i] to starts[i + 1], as one value."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    return pa.Array.from_buffers(
        pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(offsets[starts].tobytes()), pieces.buffers()[2]]
    )


@lru_cache(maxsize=1)
def codec(path: str, pattern: str, remembered: int = REMEMBERED) -> Codec:
    """One codec per worker, kept to the end of its task."""
    return Codec(path, pattern, remembered)


def bpe_encode(
    docs: DataFrame, path: str, pattern: str, decode: bool = False, remembered: int = REMEMBERED
) -> DataFrame:
    """(doc_id, ids): ids of every whole text as little-endian unsigned 32-bit integers.

    NULL and empty texts have no ids. Rows keep their doc_id, also NULL or repeated ones; other columns
    are ignored. No shuffle: each partition contracts the words it meets for the first time. With `decode`,
    the same worker also returns the bytes its ids stand for, as `bpe_decode` would. A worker remembers the ids of
    `remembered` words (some 200 bytes each): more spare it contracting rare words again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern, remembered)
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                ids = own.encode(batch.column("text"))
                out = {"doc_id": batch.column("doc_id"), "ids": ids}
                yield pa.record_batch(out | {"bytes": own.decode(ids)} if decode else out)
                del ids, out
            release_memory()
        codec.cache_clear()

    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(releasing(run), "doc_id long, ids binary" + ", bytes binary" * decode)


def bpe_decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, bytes): the bytes that the ids of `bpe_encode` stand for; NULL ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for whole in batches:
            for batch in slices(whole, "ids", 2 * SLICE):
                ids = pc.fill_null(batch.column("ids"), b"")
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": ids, "bytes": own.decode(ids)})
        codec.cache_clear()

    bound_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(releasing(run), "doc_id long, ids binary, bytes binary")
