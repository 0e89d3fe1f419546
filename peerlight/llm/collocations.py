"""Phrase collocations: level-wise candidates counted by broadcast double-array tries, scored at their weakest cut."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlight.llm.common import bound_batches, releasing, slices
from peerlight.sources.snapshots import materialize

# Piece ends become full stops, which no word can hold, tabs become blanks, A-Z small letters.
_PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t" + bytes(range(65, 91)), b"." * 9 + b" " + bytes(range(97, 123)))
# Bytes of texts coded in one step.
CHUNK_BYTES = 2 << 20
# Words of one row of the coded corpus; a row is cut at ends of pieces only, so no phrase is cut.
CHUNK_WORDS = 1 << 20
# Phrases of one broadcast trie (some 20 bytes each); more candidates are counted in further passes.
TRIE_PHRASES = 1 << 20
# Frequent words whose numbers are broadcast (some 30 bytes each); more are joined by a shuffle.
BROADCAST_WORDS = 1 << 20
# Pairs a task adds up before it sends them (16 bytes each, some 50 while they are dealt), and words of the corpus
# for each share of the pairs, which bounds what one group adds up (some 100 bytes each while they are sorted).
PAIRS_HELD = 1 << 21
PAIR_WORDS = 1 << 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
# Phrases of a trie whose counts one group adds up.
SHARE_PHRASES = 1 << 14
# Word numbers below this are looked up in a table (8 bytes each), larger ones by binary search.
TABLE_WORDS = 1 << 22
# First-fit looks at so many free slots of the trie at a time.
_WINDOW = 512


def _code_type(words: int) -> str:
    """How the codes of a chunk with so many words are stored."""
    return "<i2" if words <= 1 << 15 else "<i4"


def coded_chunks(docs: DataFrame) -> DataFrame:
    """(chunk, lang, words, counts, codes): the corpus as numbers of words, with each chunk's own word list.

    `codes` are little-endian integers of 16 bits, or of 32 for longer word lists; -1 between pieces and texts.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", CHUNK_BYTES):
                langs = batch.column("lang").dictionary_encode()
                texts = batch.column("text")
                for number, lang in enumerate(langs.dictionary.to_pylist()):
                    own = texts.filter(pc.equal(langs.indices, number)).to_pylist()
                    whole_text = ".".join(x for x in own if x).encode().translate(_PIECES).replace(b".", b" . ")
                    flat = pc.ascii_split_whitespace(pa.array([whole_text], pa.large_binary()).cast(pa.large_string())).flatten()
                    coded = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
                    codes = coded.indices.to_numpy(zero_copy_only=False)
                    words = coded.dictionary.cast(pa.large_string())
                    stop = pc.index(words, ".").as_py()
                    ends = np.append(np.flatnonzero(codes == stop) if stop >= 0 else [], len(codes)).astype(np.int64)
                    low = 0
                    while low < len(codes):
                        high = int(ends[min(np.searchsorted(ends, low + CHUNK_WORDS), len(ends) - 1)])
                        high = high if high > low else int(ends[np.searchsorted(ends, low, "right")])
                        counts = np.bincount(codes[low:high], minlength=len(words))
                        if stop >= 0:
                            counts[stop] = 0
                        kinds = np.flatnonzero(counts)
                        place = np.full(len(words), -1, _code_type(len(kinds)))
                        place[kinds] = np.arange(len(kinds))
                        yield pa.record_batch(
                            {
                                "chunk": [uuid.uuid4().hex],
                                "lang": pa.array([lang], pa.string()),
                                "words": pa.array([words.take(pa.array(kinds)).to_pylist()], pa.list_(pa.string())),
                                "counts": pa.array([counts[kinds]], pa.list_(pa.int64())),
                                "codes": pa.array([place[codes[low:high]].tobytes()], pa.binary()),
                            }
                        )
                        low = high
                        while low < len(codes) and codes[low] == stop:
                            low += 1

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(releasing(code), "chunk string, lang string, words array<string>, counts array<long>, codes binary")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of a written table with dense numbers `id` from 0; only row counts per task are broadcast."""
    placed = materialize(rows.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    sizes = placed.groupBy(part.alias("__part")).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", before.alias("__start"))
    number = (F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int")
    return materialize(
        placed.withColumn("__part", part).join(F.broadcast(starts), "__part").select(*rows.columns, number.alias("id"))
    )


def numbered_corpus(chunks: DataFrame, words: DataFrame, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(ids): each chunk as numbers of the given words, -1 for all others and between pieces.

    Up to `broadcast_words` words, counted first, are broadcast, and no chunk is moved. More are joined with the
    chunks' word lists by a shuffle. Both ways give the same rows.
    """

    def renumbered(codes: bytes, ids: np.ndarray) -> pa.RecordBatch:
        # `ids` has one number per word of the chunk; the added last one is found by the code -1.
        coded = np.frombuffer(codes, _code_type(len(ids)))
        return pa.record_batch({"ids": pa.array([np.append(ids, np.int32(-1)).astype("<i4")[coded].tobytes()], pa.binary())})

    if words.count() <= broadcast_words:
        sent = chunks.sparkSession.sparkContext.broadcast(words.select("lang", "word", "id").toArrow())

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[str, pa.Table] = {}
            for batch in batches:
                # All chunks of a language at once, since each lookup first hashes all words sent.
                langs = batch.column("lang").dictionary_encode()
                for number, lang in enumerate(langs.dictionary.to_pylist()):
                    own = batch.filter(pc.equal(langs.indices, number))
                    if lang not in known:
                        known[lang] = sent.value.filter(pc.equal(sent.value.column("lang"), lang)).combine_chunks()
                    places = pc.index_in(own.column("words").flatten(), value_set=known[lang].column("word"))
                    ids = pc.fill_null(known[lang].column("id").take(places), -1).to_numpy()
                    ends = np.cumsum(pc.list_value_length(own.column("words")).to_numpy())
                    for codes, some in zip(own.column("codes"), np.split(ids, ends[:-1])):
                        yield renumbered(codes.as_py(), some)

        numbered = materialize(chunks.select("lang", "words", "codes").mapInArrow(releasing(look_up), "ids binary"))
        sent.destroy()
        return numbered

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for count, codes, known in zip(batch.column("count").to_pylist(), batch.column("codes"), batch.column("known")):
                ids = np.full(count, -1, np.int32)
                ids[known.values.field("pos").to_numpy()] = known.values.field("id").to_numpy()
                yield renumbered(codes.as_py(), ids)

    listed = chunks.select("chunk", "lang", F.posexplode("words").alias("pos", "word"))
    known = listed.join(words, ["lang", "word"]).groupBy("chunk").agg(F.collect_list(F.struct("pos", "id")).alias("known"))
    coded = chunks.select("chunk", "codes", F.size("words").alias("count")).join(known, "chunk")
    return materialize(coded.select("codes", "count", "known").mapInArrow(releasing(number), "ids binary"))


class DoubleArrayTrie:
    """Phrases of `length` word numbers each; state 0 is the root, and a word leads from s to base[s] + its symbol."""

    def __init__(self, phrases: np.ndarray):
        count, self.length = phrases.shape
        self.table: np.ndarray | None = None
        # Common words get small symbols, so that families of children lie close together.
        self.words, found, uses = np.unique(phrases, return_inverse=True, return_counts=True)
        self.symbols = np.empty(len(self.words), np.int64)
        self.symbols[np.argsort(-uses, kind="stable")] = np.arange(len(self.words))
        symbols = self.symbols[found.reshape(phrases.shape)]
        symbols = symbols[order := np.lexsort(symbols.T[::-1])]
        room = len(self.words) + 2 * count * self.length + 2 * _WINDOW
        self.base = np.zeros(room, np.int32)
        self.check = np.full(room, -1, np.int32)
        used = np.zeros(room, bool)
        used[0] = True
        # Of each phrase, the number and the state of its prefix.
        node, states = np.zeros(count, np.int64), np.zeros(1, np.int64)
        for depth in range(self.length):
            new = np.ones(count, bool)
            new[1:] = (node[1:] != node[:-1]) | (symbols[1:, depth] != symbols[:-1, depth])
            first = np.flatnonzero(new)
            parents, kids = node[first], symbols[first, depth]
            starts = np.append(np.flatnonzero(np.append(True, parents[1:] != parents[:-1])), len(first))
            child_states = np.zeros(len(first), np.int64)
            # Large families first; those of like size go on where the last one found room.
            size = room_from = 0
            sizes = np.diff(starts)
            single = np.flatnonzero(sizes == 1)
            for i in np.argsort(-sizes, kind="stable")[: len(sizes) - len(single)]:
                own = kids[starts[i] : starts[i + 1]]
                if len(own).bit_length() != size:
                    size, room_from = len(own).bit_length(), 1
                used, base, room_from = self._fit(used, own, room_from)
                state = states[parents[starts[i]]]
                self.base[state] = base
                used[base + own] = True
                self.check[base + own] = state
                child_states[starts[i] : starts[i + 1]] = base + own
            # Single children take whatever is left, all at once.
            lone = starts[:-1][single]
            used = self._grown(used, int(used.sum()) + len(self.words) + len(lone))
            slots = (np.flatnonzero(~used[len(self.words) :]) + len(self.words))[: len(lone)]
            parent_states = states[parents[lone]]
            self.base[parent_states] = slots - kids[lone]
            self.check[slots] = parent_states
            used[slots] = True
            child_states[lone] = slots
            node, states = np.cumsum(new) - 1, child_states
        size = int(np.flatnonzero(used)[-1]) + 1
        self.base, self.check = self.base[:size].copy(), self.check[:size].copy()
        # What each accepting state stands for: the place of its phrase among those given.
        self.accepts = np.full(size, -1, np.int32)
        self.accepts[states[node]] = order

    def _grown(self, used: np.ndarray, least: int) -> np.ndarray:
        """Slots in use, with all arrays lengthened to more than `least` slots."""
        if least >= len(used):
            more = least + len(used) // 2 - len(used) + _WINDOW
            used = np.append(used, np.zeros(more, bool))
            self.base = np.append(self.base, np.zeros(more, np.int32))
            self.check = np.append(self.check, np.full(more, -1, np.int32))
        return used

    def _fit(self, used: np.ndarray, own: np.ndarray, low: int) -> tuple[np.ndarray, int, int]:
        """First base from `low` on that puts all of a node's symbols on free slots, and where to look next.

        The arrays grow as needed.
        """
        at = low
        while True:
            used = self._grown(used, at + _WINDOW + int(own[-1]) + 1)
            bases = np.arange(at, at + _WINDOW)
            for kid in own:
                bases = bases[~used[bases + kid]]
                if not len(bases):
                    break
            if len(bases):
                return used, int(bases[0]), int(bases[0])
            at += _WINDOW

    def _symbols_of(self, ids: np.ndarray) -> np.ndarray:
        """The symbol of each word number, -1 for words of no phrase."""
        if self.words[-1] >= TABLE_WORDS:
            known = np.searchsorted(self.words, ids)
            known[known == len(self.words)] = 0
            return np.where(self.words[known] == ids, self.symbols[known], -1)
        if self.table is None:
            # The last place is found by the number -1; made in each task, so that it is not sent.
            self.table = np.full(self.words[-1] + 2, -1, np.int64)
            self.table[self.words] = self.symbols
        return self.table[np.minimum(ids, len(self.table) - 1)]

    def states(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start places at which a phrase stands, and the accepting states: all places advance together."""
        symbols = self._symbols_of(ids)
        places, states = np.flatnonzero(symbols >= 0), None
        for depth in range(self.length):
            places = places[places + depth < len(ids)]
            symbol = symbols[places + depth]
            states = np.zeros(len(places), np.int64) if states is None else states[: len(places)]
            target = self.base[states] + symbol
            good = (symbol >= 0) & (target < len(self.check))
            good &= self.check[np.where(good, target, 0)] == states
            places, states = places[good], target[good]
        return places, states


def _tries(phrases: DataFrame, trie_phrases: int) -> Iterator[tuple[np.ndarray, DoubleArrayTrie]]:
    """Tries over all phrases (`ids`, equally long), each over a share of bounded size that a hash deals out."""
    shares = -(-phrases.count() // max(1, trie_phrases * 3 // 4))
    for share in range(shares):
        rows = phrases.filter(F.pmod(F.xxhash64("ids"), F.lit(shares)) == share).select("ids").toArrow().column("ids").combine_chunks()
        if len(rows):
            flat = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            # In ascending order, so that the numbers of phrases with the same first words lie close together.
            flat = _distinct_rows(list(flat.T))
            yield flat, DoubleArrayTrie(flat)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _merged(key: np.ndarray, count: np.ndarray, new: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and their counts, with other such keys and counts added; only the result is as large as both."""
    at = np.searchsorted(key, new)
    old = at < len(key)
    old[old] = key[at[old]] == new[old]
    count[at[old]] += more[old]
    return np.insert(key, at[~old], new[~old]), np.insert(count, at[~old], more[~old])


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys as steps, and counts; equal bytes of all numbers lie together, so most are runs of zeros."""
    rows = np.stack([np.diff(keys, prepend=0), counts]).astype("<i8")
    return zlib.compress(rows.view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes(), 1)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(2, 8, -1)
    steps, counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]
    return np.cumsum(steps), counts


def _phrase_table(rows: np.ndarray, counts: np.ndarray) -> pa.Table:
    """(ids, f) of rows of word numbers."""
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
    return pa.table({"ids": pa.ListArray.from_arrays(offsets, pa.array(rows.ravel().astype(np.int32))), "f": counts})


def _key_counts(
    corpus: DataFrame,
    keys: Callable[[np.ndarray], np.ndarray],
    phrases: Callable[[np.ndarray], np.ndarray],
    shares: int,
    least: int,
    held: int,
) -> DataFrame:
    """(ids, f): how often each key that `keys` makes of a row of the numbered corpus occurs, if `least` times at least.

    A key has 31 bits above and 31 below bit 32, and `phrases` makes rows of word numbers of keys.

    A task adds up the keys of a few chunks at a time, of which it holds about `held`, deals them into `shares`, and sends each
    share as one sorted, packed list; a group per share adds up the lists. Shares are dealt by a hash of blocks of 64 upper
    and 16,384 lower halves: numbers in a list lie close together, and a common upper half is spread over many shares.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send() -> pa.RecordBatch:
            block = (key >> 38 << 32 | (key & 0xFFFFFFFF) >> 14).astype(np.uint64)
            block *= _SPREAD
            block >>= np.uint64(32)
            block %= np.uint64(shares)
            order = np.argsort(block, kind="stable")
            found, sizes = np.unique(block, return_counts=True)
            lists = [_packed(key[own], total[own]) for own in np.split(order, np.cumsum(sizes)[:-1])]
            return pa.record_batch({"share": pa.array(found.astype(np.int64)), "packed": pa.array(lists, pa.binary())})

        key = total = np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        for batch in batches:
            for ids in map(lambda x: np.frombuffer(x, "<i4"), batch.column("ids").to_pylist()):
                waiting.append(np.unique(keys(ids), return_counts=True))
                if sum(len(some) for some, _ in waiting) > held // 8:
                    key, total = _merged(key, total, *_summed(*zip(*waiting)))
                    waiting = []
                if len(key) > held:
                    yield send()
                    key = total = np.zeros(0, np.int64)
        if waiting:
            key, total = _merged(key, total, *_summed(*zip(*waiting)))
        if len(key):
            yield send()

    def add(table: pa.Table) -> pa.Table:
        key, total = _summed(*zip(*map(_unpacked, table.column("packed").to_pylist())))
        key, total = key[total >= least], total[total >= least]
        return _phrase_table(phrases(key), total)

    lists = corpus.mapInArrow(releasing(count), "share long, packed binary")
    return lists.groupBy("share").applyInArrow(add, "ids array<int>, f long")


def pair_counts(corpus: DataFrame, shares: int, least: int = 1, held: int = PAIRS_HELD) -> DataFrame:
    """(ids, f): how often each two words of the numbered corpus follow each other, if `least` times at least."""

    def pairs(ids: np.ndarray) -> np.ndarray:
        both = (ids[:-1] >= 0) & (ids[1:] >= 0)
        return ids[:-1][both].astype(np.int64) << 32 | ids[1:][both]

    return _key_counts(corpus, pairs, lambda key: np.stack([key >> 32, key & 0xFFFFFFFF], 1), shares, least, held)


def _distinct_rows(columns: list[np.ndarray]) -> np.ndarray:
    """Distinct rows of numbers from 0 to 2^31, each step sorting one 64-bit key of a row's place so far and its next number."""
    key = columns[0].astype(np.int64)
    for column in columns[1:-1]:
        key = np.unique(key << 32 | column, return_inverse=True)[1]
    first = np.unique(key << 32 | columns[-1], return_index=True)[1]
    return np.stack([column[first] for column in columns], 1)


def longer_candidates(
    corpus: DataFrame, frequent: DataFrame, trie_phrases: int, least: int = 1, shares: int = 1, held: int = PAIRS_HELD
) -> DataFrame:
    """(ids): phrases one word longer that occur `least` times at least and whose first and last words, less one, are frequent phrases.

    Most phrases that occur are rare, and their number grows with the corpus; so they are added up by key before any is a
    candidate, in lists like those of pairs. The key of a phrase is the number of the frequent phrase it begins with and its last word.
    With several tries, a phrase's two parts may be in different ones, so the places of all tries are marked before
    they are compared; one process per task does both.
    """
    spark = corpus.sparkSession
    all_sent, known, first = [], [], 0
    for flat, trie in _tries(frequent, trie_phrases):
        all_sent.append((spark.sparkContext.broadcast(trie), first))
        known.append(flat)
        first += len(flat)
    if not first:
        return spark.createDataFrame([], "ids array<int>")
    starts_sent = spark.sparkContext.broadcast(np.concatenate(known))

    def keys(ids: np.ndarray) -> np.ndarray:
        number = np.full(len(ids), -1, np.int64)
        for sent, first in all_sent:
            places, states = sent.value.states(ids)
            number[places] = sent.value.accepts[states].astype(np.int64) + first
        starts = np.flatnonzero((number[:-1] >= 0) & (number[1:] >= 0))
        return number[starts] << 32 | ids[starts + sent.value.length]

    def phrases(key: np.ndarray) -> np.ndarray:
        return np.concatenate([starts_sent.value[key >> 32], (key & 0xFFFFFFFF)[:, None]], 1)

    found = materialize(_key_counts(corpus, keys, phrases, shares, least, held).select("ids"))
    for sent, _ in all_sent:
        sent.destroy()
    starts_sent.destroy()
    return found


def _counted_by_trie(corpus: DataFrame, flat: np.ndarray, trie: DoubleArrayTrie) -> DataFrame:
    """(ids, f): occurrences of the phrases of one trie, which is broadcast for a pass over the corpus."""
    sent = corpus.sparkSession.sparkContext.broadcast((flat, trie))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, trie = sent.value
        total = np.zeros(len(trie.check), np.int64)
        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                total += np.bincount(trie.states(np.frombuffer(raw, "<i4"))[1], minlength=len(total))
        by_phrase = np.zeros(len(flat), np.int64)
        hit = np.flatnonzero(total)
        by_phrase[trie.accepts[hit]] = total[hit]
        for share, low in enumerate(range(0, len(flat), SHARE_PHRASES)):
            own = by_phrase[low : low + SHARE_PHRASES]
            if len(found := np.flatnonzero(own)):
                packed = pa.array([_packed(found, own[found])], pa.binary())
                yield pa.record_batch({"share": pa.array([share], pa.int64()), "packed": packed})

    def add(table: pa.Table) -> pa.Table:
        flat, total = sent.value[0], np.zeros(SHARE_PHRASES, np.int64)
        for key, some in map(_unpacked, table.column("packed").to_pylist()):
            total[key] += some
        found = np.flatnonzero(total)
        return _phrase_table(flat[found + table.column("share")[0].as_py() * SHARE_PHRASES], total[found])

    lists = corpus.mapInArrow(releasing(count), "share long, packed binary")
    counts = materialize(lists.groupBy("share").applyInArrow(add, "ids array<int>, f long"))
    sent.destroy()
    return counts


def phrase_counts(corpus: DataFrame, phrases: DataFrame, trie_phrases: int) -> DataFrame:
    """(ids, f): occurrences of each phrase, overlaps included.

    One pass per trie: all places of a chunk advance together, accepting states are counted by bincount, and
    the tasks' counts are sent as packed lists of phrase numbers and added up in shares of `SHARE_PHRASES` of them.
    """
    parts = [_counted_by_trie(corpus, flat, trie) for flat, trie in _tries(phrases, trie_phrases)]
    return reduce(DataFrame.unionAll, parts) if parts else corpus.sparkSession.createDataFrame([], "ids array<int>, f long")


def mine_collocations(
    docs: DataFrame,
    longest: int = 5,
    min_count: int = 100,
    top: int = 2000,
    subsumed: int = 100,
    trie_phrases: int = TRIE_PHRASES,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language that cohere most.

    Texts are split into pieces at `.,;:!?` and line breaks, pieces into words at blanks and tabs. A candidate
    has 2 to `longest` words and occurs `a` >= `min_count` times. Its score is floor(1000 * a * n / (l * r))
    at the cut where that is least (the earliest of equal ones), with the counts l and r of the parts and n of
    all words. Candidates within a longer one that has at least `subsumed` percent of their count are left out.
    The `top` first per language by score, count and phrase (in bytes) are returned.

    Level by level: pairs of frequent words are counted by key in packed lists, since their Apriori candidates would be
    the square of the vocabulary. Longer candidates are phrases both of whose shorter parts are frequent and that occur
    often enough, by such lists; they are counted by double-array tries of at most `trie_phrases` phrases, broadcast one
    after the other. So there are about as many passes as tries of frequent phrases, however many phrases occur.
    Numbers of at most `broadcast_words` frequent words are broadcast, those of more are joined.
    NULL texts are empty, a NULL lang is `und`; doc_id plays no part, and repeated rows count each time.
    """
    bound_batches(docs.sparkSession)
    chunks = materialize(coded_chunks(docs))
    pairs = F.explode(F.arrays_zip("words", "counts")).alias("w")
    word_counts = materialize(
        chunks.select("lang", pairs).groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    )
    totals = word_counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = _numbered(materialize(word_counts.filter(F.col("f") >= min_count)))
    corpus = numbered_corpus(chunks, words.select("lang", "word", "id"), broadcast_words)
    often = F.col("f") >= min_count
    levels = [words.select(F.array("id").alias("ids"), "f")]
    if longest > 1:
        n_words = totals.agg(F.sum("n")).first()[0] or 0
        levels.append(materialize(pair_counts(corpus, -(-n_words // PAIR_WORDS) or 1, min_count)))
    for _ in range(3, longest + 1):
        places = levels[-1].agg(F.sum("f")).first()[0] or 0
        candidates = longer_candidates(corpus, levels[-1], trie_phrases, min_count, -(-places // PAIR_WORDS) or 1)
        levels.append(materialize(phrase_counts(corpus, candidates, trie_phrases).filter(often)))
    known = reduce(DataFrame.unionAll, levels)
    phrases = reduce(DataFrame.unionAll, levels[1:], levels[0].limit(0))

    # Counts fall with length, so a longer phrase that is as frequent has one of one word more in between.
    size = F.size("ids")
    parts = phrases.filter(size > 2).select(
        F.explode(F.array(F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1))).alias("ids"), F.col("f").alias("longer")
    )
    covers = parts.groupBy("ids").agg(F.max("longer").alias("longer"))
    if subsumed < 100:
        covers = _all_covers(phrases)
    left = phrases.join(covers, "ids", "left").filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(subsumed) * F.col("f")))

    cuts = left.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.slice("ids", F.lit(1), F.col("k")), "tail": F.slice("ids", F.col("k") + 1, size - F.col("k"))})
    heads = known.select(F.col("ids").alias("head"), F.col("f").alias("l"))
    tails = known.select(F.col("ids").alias("tail"), F.col("f").alias("r"))
    named = words.select(F.col("id").alias("first"), "lang").join(totals, "lang")
    counted = cuts.join(heads, "head").join(tails, "tail").withColumn("first", F.col("ids")[0]).join(named, "first")
    # Whole numbers of up to 38 digits; the quotient itself is at most 1000 times n.
    above = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(19,0)") * F.col("n").cast("decimal(15,0)")
    below = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    scored = counted.withColumns({"__above": above, "__below": below}).withColumn("score", F.expr("__above div __below"))
    weakest = scored.groupBy("ids", "lang").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c")).select("ids", "lang", "c.*")
    spelt = (
        weakest.select("*", F.posexplode("ids").alias("pos", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("lang", "ids", "a", "l", "r", "n", "score")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = spelt.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _all_covers(phrases: DataFrame) -> DataFrame:
    """Largest count of any longer phrase around each phrase, for shares below 100 percent."""
    size = F.size("ids")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("ids", i, n)),
        )
    )
    inner = phrases.filter(size > 2).select(F.explode(spans).alias("ids"), F.col("f").alias("longer"))
    return inner.groupBy("ids").agg(F.max("longer").alias("longer"))
