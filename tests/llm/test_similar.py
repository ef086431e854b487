"""Near duplicates at a similarity of five-word shingles, against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from tidepanel.llm import similar

from .test_operators import prose


def shingles(text, words=5):
    found = text.lower().split()
    return {" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng, rows = random.Random(5), []
    for i in range(60):
        base = prose(rng, 120 + 5 * i)
        rows += [base] + [edited(rng, base, n) for n in (1, 2, 4, 8, 16, 32)]
    return [(i, t) for i, t in enumerate(rows)]


def test_fingerprint_against_plain_python():
    text, n = "One two  three four five six\tseven one two three four five", similar.LANES
    hashes = sorted({xxhash.xxh64_intdigest(s, similar.SEED) for s in shingles(text)})
    ones = [0] * similar.BITS
    for h in hashes:
        for lane in range(n):
            x = h * int(similar.ODD[lane]) % 2**64
            x = (x ^ x >> 32) * int(similar.ODD[0]) % 2**64
            x ^= x >> 29
            for bit in range(64):
                ones[64 * lane + bit] += x >> bit & 1
    got = np.unpackbits(np.frombuffer(similar.wide_simhash(text), np.uint8), bitorder="little")
    assert got.tolist() == [int(2 * c > len(hashes)) for c in ones]
    assert similar.wide_simhash("") == similar.wide_simhash(" \n") == bytes(32)
    assert similar.wide_simhash("a b") == similar.wide_simhash("A  B") != similar.wide_simhash("b a")


def test_the_embedding_is_a_lower_bound_and_the_radius_is_kept():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, (1, 4)).astype(np.uint64)
    others = np.repeat(a, 300, axis=0)
    for i in range(300):
        for bit in rng.choice(256, i % 100, replace=False):
            others[i, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    bits = np.array([i % 100 for i in range(300)])
    assert (np.abs(similar.embedding(a).astype(int) - similar.embedding(others).astype(int)).sum(axis=1) <= bits).all()
    assert (similar.near(a[0], others, 44) == (bits <= 44)).all()
    plain = [[bin(int(v) >> s & 3).count("1") for s in range(0, 64, 2)] for v in a[0]]
    assert sorted(sum(plain, [])) == sorted(similar.embedding(a)[0].tolist())


def families(rng, sizes, bits):
    """Fingerprints of families: each member differs from the one before it in `bits` bits, so ends of a family may be far apart."""
    rows = []
    for size in sizes:
        now = rng.integers(0, 1 << 63, 4).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 4).astype(np.uint64)
        for _ in range(size):
            rows.append(now.copy())
            for bit in rng.choice(256, bits, replace=False):
                now[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    return rng.permutation(np.array(rows).reshape(-1, 4))


def parts(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("sizes, bits", [([1] * 300, 0), ([40, 30, 1, 1, 2, 3] * 4, 9), ([400, 100] + [1] * 200, 30), ([700] + [1] * 50, 1)])
def test_cells_against_all_pairs(sizes, bits, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK", 1 << 11)
    fp = families(np.random.default_rng(len(sizes)), sizes, bits)
    far = np.bitwise_count(fp[:, None] ^ fp[None]).sum(axis=2, dtype=int)
    true = {(i, j) for i, j in np.argwhere(far <= 44) if i < j}
    for found in (similar.linked(fp, 44), similar.forest(fp, 44), similar.cell_links(np.zeros(len(fp), np.int64), fp, 44)):
        pairs = [tuple(sorted(x)) for x in found.tolist()]
        assert set(pairs) <= true and len(pairs) == len(set(pairs)) <= similar.FAMILY * len(fp)
        assert parts(len(fp), pairs) == parts(len(fp), true)
    assert len(similar.forest(fp, 44)) < len(fp)


def test_cells_of_one_batch_are_kept_apart():
    rng = np.random.default_rng(8)
    fp = families(rng, [3, 20, 60, 2] * 10, 12)
    key = np.sort(rng.integers(0, 25, len(fp)))
    far = np.bitwise_count(fp[:, None] ^ fp[None]).sum(axis=2, dtype=int)
    true = [(i, j) for i, j in np.argwhere((far <= 44) & (key[:, None] == key)) if i < j]
    assert parts(len(fp), similar.cell_links(key, fp, 44).tolist()) == parts(len(fp), true)
    assert similar.cell_links(key[:0], fp[:0], 44).shape == (0, 2)


def test_fingerprints_go_to_arrow_and_back():
    fp = families(np.random.default_rng(1), [9], 40)
    assert (similar.as_array(similar.as_column(fp)) == fp).all() and (similar.as_array(similar.as_column(fp).slice(2, 5)) == fp[2:7]).all()
    assert similar.as_array(similar.as_column(fp[:0])).shape == (0, 4) and similar.as_column(fp).to_pylist() == [x.tobytes() for x in fp]


def test_links_against_all_pairs(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    prints = similar.wide_fingerprints(docs)
    fp = {r.doc_id: bytes(r.fp) for r in prints.collect()}
    radius, width = similar.radius_of(0.8), similar.width_of(len(corpus))
    links = similar.similar_links(prints.select("fp").distinct(), radius, width, similar.choices_of(width, 0.8)).collect()
    bits = lambda a, b: (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    assert links and all(bits(r.u, r.v) <= radius for r in links)
    parent = {f: f for f in fp.values()}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for r in links:
        parent[root(bytes(r.u))] = root(bytes(r.v))
    found = {r.fp: r.component_id for r in similar.similar_components(prints).collect()}
    least = {}
    for i, f in sorted(fp.items()):
        least.setdefault(root(f), i)
    assert {bytes(f): c for f, c in found.items()} == {f: least[root(f)] for f in fp.values()}
    sets = [shingles(t) for _, t in corpus]
    alike = [(i, j, jaccard(sets[i], sets[j])) for i in range(len(corpus)) for j in range(i) if i // 7 == j // 7]
    close = [root(fp[i]) == root(fp[j]) for i, j, s in alike if s >= 0.8]
    assert len(close) > 100 and np.mean(close) >= 0.9
    assert all(i // 7 == j // 7 for i, f in fp.items() for j, g in fp.items() if root(f) == root(g))


def test_the_width_follows_from_the_nodes_and_the_rate_stays():
    widths = [similar.width_of(10**n) for n in range(13)]
    assert widths == sorted(widths) and widths[0] == similar.WIDTH < widths[-1]
    for n, width in enumerate(widths):
        assert 10**n * similar.CHANCE**width <= similar.COMPANY
        met = (1 - similar.share(0.8)) ** 2 + similar.share(0.8) ** 2 / 2
        assert 1 - (1 - met**width) ** similar.choices_of(width, 0.8) >= similar.RECALL
    assert similar.choices_of(12, 1.0) == 1


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(40_000))
    rows = [(3, None, "x"), (1, "", "x"), (2, " \t", "x"), (5, long, "x"), (4, long + " end", "x"), (6, "one", "x"), (6, "one", "x"), (7, "ONE", "x"), (None, "one", "x"), (None, "alone here", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in similar.drop_similar(docs).collect())
    assert got == [(-1, "alone here"), (-1, "one"), (1, ""), (4, long + " end"), (6, "one"), (6, "one")]
    assert similar.drop_similar(docs).columns == docs.columns and similar.drop_similar(docs.limit(0)).count() == 0


def borderline(rng, n):
    """Texts in twos, the second with one to three words changed: similarities about the threshold."""
    rows = []
    for i in range(n):
        base = prose(rng, rng.randrange(20, 110))
        rows += [base, edited(rng, base, 1 + i % 3)]
    return rows


@pytest.mark.parametrize("similarity", [0.8, 0.5, 1.0])
def test_texts_of_the_similarity_are_found_by_their_shingles(spark, similarity):
    rng = random.Random(11)
    header = prose(rng, 8)
    rows = borderline(rng, 60) + [header + " " + prose(rng, 12) for _ in range(40)] + ["", "one", "one two", "ONE  two", "one two three four five six"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(3)
    prints = similar.durable(similar.shingle_prints(docs, similar.bucket_counts(docs, buckets=64), similarity=similarity))
    alone = prints.select("fp", similar.F.col("fp").alias("root")).distinct()
    fp = {r.doc_id: bytes(r.fp) for r in prints.collect()}
    assert fp == {i: similar.wide_simhash(t) for i, t in enumerate(rows)}
    sets = [shingles(t) for t in rows]
    true = {frozenset((fp[i], fp[j])) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= similarity and fp[i] != fp[j]}
    found = {frozenset((bytes(r.u), bytes(r.v))) for r in similar.alike_roots(docs, prints, alone, similarity=similarity).collect()}
    assert found == true and (similarity == 1.0) == (not true)


def test_counts_of_buckets(spark):
    texts = ["a b c d e f", "A b c d e f", None, "", "x y z", "a b c d e f g a b c d e f g"]
    counts = similar.bucket_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2))
    assert counts.sum() == sum(len(shingles(t or "")) for t in texts) and counts.max() >= 3 and len(counts) == similar.BUCKETS


def test_no_two_texts_of_the_similarity_stay(spark):
    """Cells alone leave out a tenth of such pairs, and the radius more."""
    rng = random.Random(21)
    rows = borderline(rng, 350) + [None, "", "same line", "same line"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    sets = [shingles(t or "") for t in rows]
    alike = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] & sets[j] and jaccard(sets[i], sets[j]) >= 0.8]
    known = {r.fp: r.component_id for r in similar.similar_components(similar.wide_fingerprints(docs)).collect()}
    first = {}
    by_cells = [(i, first.setdefault(known[similar.wide_simhash(t or "")], i)) for i, t in enumerate(rows)]
    assert len(alike) > 100 and parts(len(rows), by_cells) != parts(len(rows), by_cells + alike)
    assert {r.doc_id for r in similar.drop_similar(docs).collect()} == set(parts(len(rows), by_cells + alike))
