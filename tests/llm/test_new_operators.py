"""Importance resampling, collocations and HTML extraction against brute force and by their parts."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerlight.llm.collocations import DoubleArrayTrie, mine_collocations
from peerlight.llm.embeddings import near_duplicate_vectors
from peerlight.llm.htmltext import common_lines, extract_main_text, text_lines
from peerlight.llm.licenses import scan_licenses
from peerlight.llm.resampling import importance_resample, radix_ranks

DOCS = "doc_id long, text string, lang string, weight string, rank int, words string"


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def sample_texts(n=150):
    rnd = random.Random(3)
    pool = [a + b for a in "abcdeéß" for b in ("n", "st", "ré", "1")]
    texts = [" ".join(rnd.choices(pool, k=rnd.randrange(0, 60))).title() for _ in range(n)]
    return texts + [None, "", " .\n", "one two", " ".join(rnd.choices(pool, k=30_000))] + texts[:9]


def resampled(rows, targets, buckets=10_000, least=20):
    """The contract's formulas, row by row."""
    bucket = lambda w: zlib.crc32(w.encode()) % buckets
    s, t = (collections.Counter(bucket(w) for x in texts for w in words(x)) for texts in ([r[1] for r in rows], targets))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc, text in rows:
        found = [bucket(w) for w in words(text)]
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(able[: 10 * len(able) // 100], 1):
        row[4] = place
    return sorted(map(tuple, out), key=repr)


def test_resampling_by_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(sample_texts())]
    rows += [(None, rows[5][1]), (None, rows[5][1]), (-(2**62), rows[7][1]), (2**62, rows[7][1]), *rows[20:40]]
    targets = ["an est Cré 1", None, "", "dn dn dn é1"]
    docs = spark.createDataFrame([(*r, None, "x", 1, "y") for r in rows], DOCS).repartition(5)
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    got = importance_resample(docs, target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {k for _, k in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == resampled(rows, targets)


def test_radix_sort_orders_any_keys(spark):
    rnd = random.Random(5)
    values = [(rnd.choice([None, -(2**63), 2**63 - 1, 0, 7, rnd.randrange(-(10**6), 10**6)]), rnd.randrange(3)) for _ in range(5_000)]
    rows = spark.createDataFrame(values, "a long, b long").repartition(7)
    ranked = radix_ranks(rows, [F.col("b"), F.col("a")]).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 5_001))
    assert [(r.a, r.b) for r in ranked] == sorted(values, key=lambda v: (v[1], v[0] is None, v[0] or 0))


def test_radix_sort_of_equal_keys(spark):
    same = spark.range(5_000).select(F.lit(1).cast("long").alias("a"), "id").repartition(3)
    assert sorted(r["rank"] for r in radix_ranks(same, [F.col("a")]).collect()) == list(range(1, 5_001))
    assert radix_ranks(same.limit(0), [F.col("a")]).count() == 0


def collocations(rows, least, top, longest=5, subsumed=100):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            totals[lang or "und"] += len(w)
            counts.update((lang or "und", tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cands = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in cands.items():
        if any(
            lang == other and len(q) > len(p) and 100 * f >= subsumed * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (other, q), f in cands.items()
        ):
            continue
        n = totals[lang]
        score, k = min((1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), a, counts[lang, p[:k]], counts[lang, p[k:]], n, score))
    found = []
    for lang, rows in out.items():
        found += [(lang, i, r[2].decode(), *r[3:]) for i, r in enumerate(sorted(rows)[:top], 1)]
    return sorted(found)


@pytest.mark.parametrize("least, top, trie, subsumed, sent", [(5, 2000, 1 << 20, 100, 1 << 20), (4, 7, 40, 100, 0), (6, 2000, 100, 60, 1 << 20)])
def test_collocations_by_brute_force(spark, least, top, trie, subsumed, sent):
    rnd = random.Random(11)
    vocabulary = ["the", "The", "of", "é", "New", "york", "san x", "\x1c", "x-y", "a\x00b"]
    rows = []
    for i in range(160):
        text = "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n"]) for _ in range(rnd.randrange(0, 30)))
        rows.append((text + "new york of the " * (i % 3), ("en", "de", None, "und")[i % 4]))
    rows += [(None, "en"), ("", None), ("...", "fr")] + [("q w e r t y", "xx")] * 9
    docs = spark.createDataFrame([(i % 50, t, l, None, 1, "z") for i, (t, l) in enumerate(rows)], DOCS).repartition(4)
    got = mine_collocations(docs, min_count=least, top=top, trie_phrases=trie, subsumed=subsumed, broadcast_words=sent)
    assert sorted(map(tuple, got.collect())) == collocations(rows, least, top, subsumed=subsumed)


def test_trie_finds_all_places():
    rnd = random.Random(2)
    for _ in range(60):
        length, size = rnd.randrange(1, 6), rnd.randrange(1, 40)
        phrases = np.unique([[rnd.randrange(size) * 9 for _ in range(length)] for _ in range(rnd.randrange(1, 90))], axis=0).astype(np.int32)
        rnd.shuffle(order := list(range(len(phrases))))
        phrases = phrases[order]
        ids = np.array([rnd.choice([-1, *range(0, 9 * size, 9)]) for _ in range(300)], np.int32)
        trie = DoubleArrayTrie(phrases)
        places, states = trie.states(ids)
        got = sorted((int(p), tuple(phrases[trie.accepts[s]])) for p, s in zip(places, states))
        known = set(map(tuple, phrases))
        assert got == [(i, tuple(ids[i : i + length])) for i in range(300 - length + 1) if tuple(ids[i : i + length]) in known]


def test_collocations_of_hardly_anything(spark):
    for rows in ([], [(1, None, None, None, None, None)], [(1, "a", "en", None, None, None)], [(1, "a b " * 500, "en", None, None, None)]):
        got = mine_collocations(spark.createDataFrame(rows, DOCS)).collect()
        assert len(got) == (1 if rows and rows[0][1] and len(rows[0][1]) > 99 else 0) or got[0].a >= 100


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{{}}</style><script>var t="</p><p>no";</script></head><body>
<header>Site</header><nav><ul><li>Home<li>More</ul></nav><!-- ad --><div class="ad box">Buy</div>
<div>{shared}</div>{open}<h1>Title {n}</h1><p>First &eacute; {n}<br>same  line<p><b>Bold</b> text&nbsp;{n}.
<aside>Side</aside><section id="comments"><p>Nice!</p></section><form><p>Mail</p></form>{close}<p>{unique}</p><div>{shared2}</div>
<footer>&copy; {n}"""


def page(n, article=True):
    tags = ("<article>", "</article>") if article else ("", "")
    return PAGE.format(n=n, open=tags[0], close=tags[1], shared="Every page says so", unique=f"Unlike {n}", shared2="And this")


def test_pages_lose_furniture_and_what_siblings_share(spark):
    rows = [(i, f"http://Host.example/a/{i}.html?x={i}", page(i, i % 2 == 0)) for i in range(6)]
    rows += [(10, None, page(10)), (11, "", None), (12, "http://Host.example/a/9", ""), (13, "http://lone.example", "<p>Alone &lt;b&gt; &#x41;&#66; &unknown; x"), (None, "http://Host.example/a/1", page(1, False)), (14, "http://lone.example/", "<script>only")]
    pages = spark.createDataFrame([(*r, "x", True) for r in rows], "page_id long, url string, html string, lines string, inside boolean")
    got = {r.page_id: r for r in extract_main_text(pages).collect()}
    assert len(got) == len(rows)
    body = lambda n: f"Title {n}\n\nFirst é {n} same line\n\nBold text {n}."
    for n in (0, 2, 4):
        assert got[n].text == body(n) and got[n].n_chars == len(body(n))
    for n in (1, 3, 5):
        assert got[n].text == f"{body(n)}\n\nUnlike {n}"
    assert got[10].text == body(10) and got[11].text == got[12].text == got[14].text == "" and got[13].text == "Alone <b> AB &unknown; x"


def test_copies_keep_their_article(spark):
    rows = [(i, f"http://h.example/{i}", page(7)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for crowd in (500, 4):
        texts = {r.text for r in extract_main_text(pages, host_pages=crowd).collect()}
        assert texts == {"Title 7\n\nFirst é 7 same line\n\nBold text 7."}


def test_pages_cut_off_anywhere():
    whole = page(3)
    for end in range(0, len(whole), 7):
        lines, inside = text_lines(whole[:end])
        assert len(lines) == len(inside) and all(line and "<div" not in line for line in lines)


def test_longest_common_subsequence():
    def length(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    rnd = random.Random(4)
    for _ in range(500):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(0, 14))] for _ in range(2))
        shared = common_lines(np.array(a, int), np.array(b, int))
        kept, rest = [x for x, s in zip(a, shared) if s], iter(b)
        assert len(kept) == length(a, b) and all(x in rest for x in kept)


def test_a_vanishing_vector_leaves_the_others_linked(spark):
    rnd = random.Random(9)
    base = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(10)]
    rows = [(i, base[i % 10], "a") for i in range(40)] + [(90, [1e-200] * 8, "b"), (91, [1e-200] * 8, "b")]
    got = {r.vec_id: r.n_links for r in near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert all(got[i] >= 3 for i in range(40)) and got[90] == got[91] == 0


def test_short_phrases_are_refused(spark):
    docs = spark.createDataFrame([(1, "gpl v3")], "doc_id long, text string")
    with pytest.raises(ValueError, match="gpl v3"):
        scan_licenses(docs, phrases={"gpl v3": "gpl"})


def test_pieces_of_a_host_change_nothing(spark):
    rnd = random.Random(8)

    def told(n):
        # Neighbouring pages share a template that pages further away lack.
        shared = "".join(f"<p>Section {n // 2} item {k}</p>" for k in range(3))
        return f"<html><body>{shared}<p>{' '.join(rnd.choices('abcdefgh', k=80))} {n}</p></body></html>"

    rows = [(n, f"http://h.example/{n // 2:03d}/{n % 2}", told(n)) for n in range(120)]
    rows += [(1000 + n, f"http://other.example/{n // 2}/{n % 2}", told(n)) for n in range(9)]
    rows += [(1, "http://h.example/000/1", rows[1][2]), (None, "http://h.example/035/0", told(70)), (2000, None, told(1)), (2001, None, told(1))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)

    def found(host_pages):
        return sorted((r.page_id is None, r.page_id or 0, r.url or "", r.text) for r in extract_main_text(pages, host_pages).collect())

    whole = found(500)
    assert len(whole) == len(rows)
    # The template shared with the neighbour is gone; two pages have no host, one no partner, one lies behind its copy.
    assert sum("Section" in r[3] for r in whole) == 4
    for host_pages in (1, 2, 3, 7, 40):
        assert found(host_pages) == whole
