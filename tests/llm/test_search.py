"""Lexical search, nearest neighbours and alignment against brute force, and their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from test_operators import ODD, SF, documents

from railyard.llm import alignment, lexical, queries, vectors

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- op11
def terms_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_search(rows, items, k=20):
    bags = [(i, Counter(terms_of(t))) for i, t in rows]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked, scored = Counter(terms_of(text)), []
        for doc, bag in bags:
            if bag:
                m = 100 - 25 + (25 * sum(bag.values()) * n_docs) // total
                score = sum(
                    q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                    for t, q in asked.items() if t in bag
                )
                if score > 0:
                    scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_search_with_ties_and_odd_rows(spark):
    rng = random.Random(3)
    words = ["Ton", "ton", "éa", "x9", "of", "of", "the", "the", "the", "日本", "rare"]
    rows = ODD + [(100 + i // 2, " ".join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(300)]
    items = [(1, "ton of, the! the"), (2, None), (3, ""), (4, "nowhere"), (5, "RARE x9 日本 éa the"),
             (5, "same text"), (None, "word"), (6, "word " * 50)]
    docs = documents(spark, rows, extra="rank").repartition(3)
    got = lexical.search(docs, benchmark(spark, items).withColumn("doc_id", F.lit(1)))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == brute_search(rows, items)


def test_search_in_segments_and_blocks(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, range(60, 0, -1), k=rng.randint(1, 30)))) for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=8))) for i in range(12)]
    monkeypatch.setattr(lexical, "BLOCK_WORDS", 30)
    assert found(lexical.search(documents(spark, rows), benchmark(spark, items))) == brute_search(rows, items)


def test_reads_end_early_with_the_same_result():
    rng = np.random.default_rng(2)
    n, size = 5000, 40
    terms = np.concatenate([np.sort(rng.choice(size, 6, replace=False)) for _ in range(n)])
    tf = rng.integers(1, 5, len(terms))
    weights = rng.integers(0, 9000, size)
    segment = lexical.Segment(np.full(n, 20), np.full(n, 6), terms, tf, weights, (n, 20 * n))
    impact = weights[terms] * ((lexical.UNIT * tf) // (1000 * tf + 12 * 100))
    for seed in range(20):
        asked = [(int(t), int(q)) for t, q in zip(rng.choice(size, 5, replace=False), rng.integers(1, 3, 5))]
        times = np.zeros(size, np.int64)
        for t, q in asked:
            times[t] = q
        score = np.bincount(np.repeat(np.arange(n), 6), impact * times[terms], n).astype(np.int64)
        order = [r for r in np.lexsort((np.arange(n), -score)) if score[r] > 0]
        for least in (0, int(score[order[9]]), int(score[order[0]]) + 1):
            rows, scores = segment.search(asked, 20, least)
            want = [r for r in order[:20] if score[r] >= least]
            assert rows.tolist() == want and scores.tolist() == score[want].tolist()


def test_search_of_nothing(spark):
    docs, items = documents(spark), benchmark(spark, [(1, "word")])
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


# ---------------------------------------------------------------- op12
def brute_nearest(rows, asks, k=10):
    x = np.array([v for _, v in rows], np.float64)
    ids = np.array([i for i, _ in rows])
    out = {}
    for i, v in rows:
        if asks(i):
            apart = np.sqrt(((x - np.array(v, np.float64)) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, apart)) if ids[j] != i][:k]
            out[i] = [(r, int(ids[j]), float(apart[j])) for r, j in enumerate(order, 1)]
    return out


def by_query(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.query_id].append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, "mine", 7) for i, v in rows], "vec_id bigint, embedding array<float>, id string, code int")


def test_neighbours_of_given_rows(spark):
    got = by_query(queries.op12_nearest_neighbours(spark, SF))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute_nearest(rows, lambda i: i % 100 == 0)
    assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items()}
    exact = {i: np.array(v, np.float64) for i, v in rows}
    for q, v in got.items():
        assert [r for r, _, _ in v] == list(range(1, 11)) and sorted(v, key=lambda x: (x[2], x[1])) == v
        for _, other, score in v:
            assert score == pytest.approx(float(np.sqrt(((exact[q] - exact[other]) ** 2).sum())), rel=1e-12)
    same = sum(len({x for _, x, _ in v} & {x for _, x, _ in want[q]}) for q, v in got.items())
    assert same >= 0.9 * sum(map(len, want.values()))


def test_neighbours_among_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    spread = [(i, rng.standard_normal(8).astype("f4").tolist()) for i in range(1000, 1400)]
    copies = [(i, [1.0] * 8) for i in range(200)]
    bad = [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [float("nan")] * 8), (2004, [1.0, None] * 4),
           (2005, [float("inf")] + [1.0] * 7), (2006, [1.0] * 5), (None, [1.0] * 8)]
    got = by_query(vectors.nearest(embeddings(spark, spread + copies + bad), F.col("vec_id") % 50 == 0))
    want = brute_nearest(copies + spread, lambda i: i % 50 == 0)
    assert got.keys() == want.keys()
    for i in (0, 50, 100, 150):  # of equal distances the least ids
        assert got[i] == want[i]
    same = sum(len({x for _, x, _ in v} & {x for _, x, _ in want[q]}) for q, v in got.items())
    assert same >= 0.9 * sum(map(len, want.values()))


def test_neighbours_fewer_than_asked_and_split_cells(spark, monkeypatch):
    few = [(i, [float(i + 1), 1.0, float(i * i)]) for i in range(6)]
    assert by_query(vectors.nearest(embeddings(spark, few), F.lit(True))) == {
        q: [(r, x, pytest.approx(s)) for r, x, s in v] for q, v in brute_nearest(few, lambda i: True).items()
    }
    assert by_query(vectors.nearest(embeddings(spark, few[:1]), F.lit(True))) == {}
    assert vectors.nearest(embeddings(spark, few).limit(0), F.lit(True)).count() == 0
    monkeypatch.setattr(vectors, "CELL_ROWS", 16)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(6).astype("f4").tolist()) for i in range(300)]
    got, want = by_query(vectors.nearest(embeddings(spark, rows), F.lit(True))), brute_nearest(rows, lambda i: True)
    same = sum(len({x for _, x, _ in v} & {x for _, x, _ in want[q]}) for q, v in got.items())
    assert same >= 0.9 * 3000 and all(len(v) == 10 for v in got.values())


def test_every_code_within_the_radius_is_met():
    rng = np.random.default_rng(9)
    codes = rng.integers(0, 2**63, 3000, np.int64).view(np.uint64)
    asked = codes[:40] ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    radius = rng.integers(0, 30, 40).astype(np.int32)
    met = set()
    for part in range(vectors.PARTS):
        cell = vectors.Cell(part, [[i] for i in range(3000)], np.zeros((3000, 1)), codes)
        query, row = cell.near(asked, radius)
        pairs = {(int(q), cell.ids[r][0]) for q, r in zip(query, row)}
        assert not pairs & met and len(pairs) == len(query)  # each is found by one substring only
        met |= pairs
    apart = np.bitwise_count(asked[:, None] ^ codes[None])
    assert met == set(zip(*(x.tolist() for x in np.nonzero(apart <= radius[:, None]))))


# ---------------------------------------------------------------- op13
def brute_align(aligner, text):
    """(n_a, n_b, groups as text, links) by the libraries themselves."""
    if not text:
        return 0, 0, "", []
    a = aligner.a.library.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.library.encode(text)
    x, y = [aligner.a.bytes[i] for i in a], [aligner.b.bytes[i] for i in b]
    if b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
        return 0, 0, "", []
    groups, links, i, j, p, q = [], [], 0, 0, 0, 0
    ends_a, ends_b = np.cumsum(list(map(len, x))).tolist(), np.cumsum(list(map(len, y))).tolist()
    rank_a, rank_b = ({end: r for r, end in enumerate(ends, 1)} for ends in (ends_a, ends_b))
    for end in sorted({*ends_a} & {*ends_b}):
        p, q = rank_a[end], rank_b[end]
        groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
        links.append((a[p - 1], b[q - 1]))
        i, j = p, q
    return len(a), len(b), ";".join(groups), links


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


def test_galloping():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (5, 0), (1, 1), (3, 2000), (2000, 3), (5000, 700), (1, 100_000)):
        a, b = (np.unique(rng.integers(1, 4 * max(n, m), size)) for size in (n, m))
        i, j = alignment.common_ends(a, b)
        both, x, y = np.intersect1d(a, b, return_indices=True)
        assert i.tolist() == x.tolist() and j.tolist() == y.tolist()


def test_alignment_of_odd_texts(aligner):
    rng = random.Random(7)
    parts = [*"  \n\tabZé日\r\x1c\x85.1ñ\xad", "▁", " ", "​", "'s", "12", "</s>", "<|endoftext|>", "\x00", "ﬁ",
             "é", "😀", "the", "　", "﻿", "'ll", "!!", "<0x41>", "<s>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    texts += [None, "", " ", "a" * 50_000, " " * 20_000, "\n" * 20_000, "é" * 20_000]
    for start in range(0, len(texts), 500):
        some = texts[start : start + 500]
        groups = aligner.of_texts(some)
        got = zip(groups.n_a.tolist(), groups.n_b.tolist(), groups.written())
        for text, (n_a, n_b, written) in zip(some, got):
            if len(text or "") < 1000:
                assert (n_a, n_b, written.decode()) == brute_align(aligner, text)[:3], repr(text)
    assert aligner.a.fast is not None


def test_both_libraries_give_the_same_ids(aligner):
    points = [c for c in (*range(0x3400), *range(0x3400, 0x110000, 37)) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 4000):
        texts = [f" x{chr(c)}y 1{chr(c)}{chr(c)} !{chr(c)}  {chr(c)}" for c in points[start : start + 4000]]
        slow = aligner.a.library.encode_batch_fast(texts, add_special_tokens=False)
        assert aligner.a.encode(texts) == [e.ids for e in slow]


@pytest.mark.parametrize("table", [alignment.TABLE, 5, 0])
def test_alignment_rows(spark, aligner, table):
    rows = ODD + [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(90, "a▁b"), (91, "the the the"), (91, "the the the"), (92, "</s> <|endoftext|>")]
    got = alignment.align(documents(spark, rows, extra="n_best"), A, B, table)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_a", "n_b", "n_groups", "n_links", "n_best",
                           "count_sum", "groups_sha256"]
    brute = [(i, brute_align(aligner, t)) for i, t in rows]
    count = Counter(link for _, b in brute for link in b[3])
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    want = [
        (i, n_a, n_b, len(links), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
         hashlib.sha256(text.encode()).hexdigest() if n_a else "")
        for i, (n_a, n_b, text, links) in brute
    ]
    plain = got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert found(plain) == sorted(want, key=str)


def test_alignment_of_nothing(spark):
    assert alignment.align(documents(spark).limit(0), A, B).count() == 0
