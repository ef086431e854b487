"""Each operator on small tables with everything odd in them, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidepanel.llm import chunk_dedup, codes, components, exact_dedup, fingerprints, mixing, packing, quality_cnn, simhash, suffix_dedup, token_counts, toxicity, training

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, block int, copies int, component_id long, _s string, spans string"
WORDS = "the quick brown fox jumps over lazy dogs while seven wizards box quietly near an old stone bridge in deep rain".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="module")
def values():
    rng = random.Random(1)
    base = [prose(rng, rng.randrange(5, 200)) for _ in range(40)]
    out = [(i, t) for i, t in enumerate(base)]
    passage = prose(rng, 60)
    out += [(100 + i, prose(rng, 30) + " " + passage + " " + prose(rng, 30)) for i in range(5)]
    out += [(200 + i, base[3].upper() if i % 2 else base[3]) for i in range(6)]
    out += [(300, None), (301, ""), (302, " \n\t "), (None, base[5]), (None, None), (303, "Ünï€ödé 日本語 " * 50), (304, "a" * 300), (305, "x" * 300 + passage)]
    out += [(400, base[7]), (400, base[7]), (401, prose(rng, 6000)), (402, base[9].replace("fox", "cat", 1)), (-5, base[2]), (2**60 + 1, base[2])]
    return out


@pytest.fixture(scope="module")
def docs(spark, values):
    rows = [(i, t, "en", ["a", "b", "c", None][k % 4], None, 0.5, 1, 2, 3, 4, "s", "z") for k, (i, t) in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_rice_codes_round_trip():
    rng = np.random.default_rng(0)
    for n, top in ((0, 10), (1, 10), (1000, 1000), (5000, 1 << 40), (300, 1 << 63)):
        values_ = np.sort(rng.integers(0, top, n).astype(np.uint64))
        assert (codes.rice_decode(codes.rice_encode(values_)) == values_).all()
    flags = rng.random(77) < 0.5
    assert (codes.unpack_bits(codes.pack_bits(flags), 77) == flags).all()


def test_exact_dedup(docs, empty, values):
    groups = defaultdict(list)
    for i, t in values:
        groups[lower(t)].append(i)
    want = []
    for i, t in values:
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_dedup(docs).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(want, key=key)
    stay = exact_dedup.drop_exact_duplicates(docs)
    assert stay.columns == docs.columns and stay.count() == sum(r[3] for r in want)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0
    alone = docs.where("doc_id IN (0, 1, 4)")  # no suspects
    assert exact_dedup.exact_dedup(alone).where("kept AND group_size = 1").count() == 3 and exact_dedup.drop_exact_duplicates(alone).count() == 3


def test_marks_let_all_marked_hashes_through(spark):
    hashes = spark.range(-500, 500).select(F.xxhash64("id").alias("h"))
    marks = exact_dedup.marks(hashes, 1000)
    assert marks.rows.count() <= marks.bits // exact_dedup.CHUNK
    assert marks.passing(hashes).count() == 1000 and marks.failing(hashes).count() == 0
    others = spark.range(10_000, 30_000).select(F.xxhash64("id").alias("h"))
    assert marks.passing(others).count() + marks.failing(others).count() == 20_000 and marks.passing(others).count() < 4000
    none = exact_dedup.marks(hashes.limit(0), 0)
    assert none.passing(hashes).count() == 0 and none.failing(hashes).count() == 1000


def test_a_hot_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 10)
    texts = [(i, "Same TEXT" if i % 3 == 0 else f"text {i % 700}") for i in range(1000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(docs).collect()}
    assert len(got) == 1000 and got[3].keep_id == 999 and got[3].group_size == 334
    assert sum(r.kept for r in got.values()) == len({t for _, t in texts})
    assert exact_dedup.drop_exact_duplicates(docs).count() == len({t for _, t in texts})


def test_simhash_links(docs, empty, values):
    fps = []
    for _, t in values:
        words = lower(t).encode().split()
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        ones = [0] * 64
        for s in shingles:
            h = xxhash.xxh64_intdigest(s, 42)
            for b in range(64):
                ones[b] += h >> b & 1
        fps.append(sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles)))
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(values):
        least[find(k)] += [i] if i is not None else []
    want = sorted(((i, f"{fps[k]:016x}", min(least[find(k)], default=None)) for k, (i, _) in enumerate(values)), key=str)
    assert sorted((tuple(r) for r in simhash.near_dedup(docs).collect()), key=str) == want
    stay = simhash.drop_near_duplicates(docs)
    assert stay.columns == docs.columns and stay.count() == sum(i == c for i, _, c in want)
    assert simhash.near_dedup(empty).count() == 0


def test_grid_finds_all_pairs_and_large_cells_give_a_forest():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 500, np.uint64)
    b = a.copy()
    for i in range(500):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    shared = [set(x) & set(y) for x, y in zip(simhash.grid_cells(a).tolist(), simhash.grid_cells(b).tolist())]
    assert all(shared)
    cluster = np.unique(np.r_[a[:1] ^ (np.uint64(1) << np.arange(40, dtype=np.uint64)), a[:1]])
    assert len(simhash.spanning_links(cluster, 4)) == len(cluster) - 1


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (103, 101), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100, 103: 100}


def brute_substrings(values):
    first, rows = {}, []
    for i, t in sorted((v for v in values if v[0] is not None), key=lambda v: (v[0], v[1] or "")):
        data = (t or "").encode()
        for p in range(len(data) - 49):
            first.setdefault(data[p : p + 50], i)
    for i, t in values:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49) if i is not None else ():
            if first[data[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(x for x, g in zip(data, gone) if not g)
        rows.append((i, len(data), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=str)


def test_suffix_dedup(docs, empty, values):
    got = sorted((tuple(r) for r in suffix_dedup.dedup_substrings(docs).collect()), key=str)
    assert got == brute_substrings(values) and sum(r[2] for r in got) > 3000
    assert suffix_dedup.dedup_substrings(empty).count() == 0


def test_suffix_dedup_over_many_blocks_and_spilled_runs(spark, monkeypatch):
    rng = random.Random(4)
    shared = [prose(rng, 15) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(shared) if rng.random() < 0.5 else prose(rng, 10) for _ in range(8))) for i in range(60)]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 9000)
    got = sorted((tuple(r) for r in suffix_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_substrings(rows)
    queue = suffix_dedup.SpillQueue(bound=1000)
    hashes = np.sort(np.random.default_rng(1).integers(0, 50, (6, 300)), axis=1)
    for r, h in enumerate(hashes):
        run = np.zeros(300, suffix_dedup.ENTRY)
        run["hash"], run["run"] = h, r
        queue.push(run)
    parts = list(queue.groups(size=400))
    assert np.concatenate([p["hash"] for p in parts]).shape == (1800,)
    assert all(set(a["hash"]).isdisjoint(b["hash"]) for a, b in zip(parts, parts[1:]))


def test_long_texts_in_segments(monkeypatch):
    data = np.random.default_rng(3).integers(97, 101, 5000).astype(np.uint8)
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    split = suffix_dedup.anchors(data)
    cover = lambda a: {(w, int(p)) for p, b, e in zip(a[1], a[2], a[3]) for w in range(b, e + 1)}
    assert cover(whole) == cover(split) and len(cover(whole)) == 4951


def test_chunk_dedup(docs, empty, values):
    got = {r.doc_id: r for r in chunk_dedup.chunk_dedup(docs).collect()}
    assert sum(1 for _ in values) == chunk_dedup.chunk_dedup(docs).count()
    assert got[205].n_removed > 0 and got[0].n_removed == 0
    assert all(got[100 + i].n_removed > 100 for i in range(1, 5)) and got[305].n_removed > 100
    assert got[301].n_bytes == 0 and got[301].kept_sha256 == hashlib.sha256(b"").hexdigest()
    whole = dict(v for v in values if v[0] is not None)
    assert got[2**60 + 1].n_removed == len(whole[2**60 + 1].encode())
    text = whole[401].encode()
    assert chunk_dedup.cuts(text)[-1] == len(text)
    moved = [c - 7 for c in chunk_dedup.cuts(b"1234567" + text)]
    assert len(set(moved) & set(chunk_dedup.cuts(text))) > 0.9 * len(moved)
    assert chunk_dedup.chunk_dedup(empty).count() == 0


def plain_chunks(data):
    """Ends of the chunks, byte by byte."""
    out, start, last, ends = [], 0, 0, []
    for i in range(len(data)):
        h = sum(int(chunk_dedup.GEAR[data[i - k]]) << k for k in range(min(32, i + 1))) % (1 << 32)
        if h >> (32 - chunk_dedup.BITS) == 0:
            ends.append(i + 1)
    for end in [*ends, len(data)]:
        if end - start < chunk_dedup.LEAST and end != len(data):
            continue
        while end - start > chunk_dedup.MOST:
            start += chunk_dedup.MOST
            out.append(start)
        if end > start:
            out.append(end)
            start = end
    return out


@pytest.mark.parametrize("least_run", [0, 64])
def test_chunk_dedup_against_plain_python(docs, values, least_run, spark):
    few = [(i, t) for i, t in values if len(t or "") < 2500] + [(2, "A text of its own that shares nothing with the other row of its id. " * 3), (2, values[30][1])]
    table = spark.createDataFrame(few, "doc_id long, text string").repartition(3)
    first, cut = {}, []
    for i, t in few:
        data, at, mine = (t or "").encode(), 0, []
        for end in plain_chunks(data):
            chunk = data[at:end]
            mine.append((at, end, chunk))
            if i is not None:
                first[chunk] = min(i, first.get(chunk, i))
            at = end
        cut.append((i, data, mine))
    want = Counter()
    for i, data, mine in cut:
        gone = []
        for a, b, chunk in mine:
            if i is not None and first[chunk] < i:
                gone = [*gone[:-1], (gone[-1][0], b)] if gone and gone[-1][1] == a else [*gone, (a, b)]
        gone = [(a, b) for a, b in gone if b - a >= least_run or b - a == len(data)]
        kept, at = b"", 0
        for a, b in gone:
            kept, at = kept + data[at:a], b
        want[(i, len(data), sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept + data[at:]).hexdigest())] += 1
    assert Counter(tuple(r) for r in chunk_dedup.chunk_dedup(table, least_run).collect()) == want


def test_token_counts(docs, empty, values):
    model = token_counts.load(token_counts.model_path(token_counts.MODEL))
    want = Counter((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t in values)
    assert Counter(tuple(r) for r in token_counts.token_counts(docs).collect()) == want
    assert token_counts.token_counts(empty).count() == 0
    counter = token_counts.Counter(token_counts.model_path(token_counts.MODEL))
    assert counter.safe
    rng, odd = random.Random(6), [" ", "  ", "a", "\n", "<s>", "▁", "　", "́", "日本", "the", "1", "\x00"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(12))) for _ in range(3000)]
    assert counter.lengths(texts) == [len(model.encode(t)) for t in texts]
    long = "".join(rng.choice(odd) for _ in range(4000)).replace("▁", " ")
    assert sum(counter.lengths(list(token_counts.pieces_of(long, 60)))) == len(model.encode(long))


def test_packing(docs, empty, values):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_counts.model_path(packing.MODEL))
    want = Counter()
    for i, t in values:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), 2048):
            part = ids[p : p + 2048]
            want[(i, p // 2048, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    got = packing.pack_documents(docs).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r.length for r in got) // 2048) + 1
    assert packing.pack_documents(empty).count() == 0


def test_a_hot_doc_id_is_in_all_shards(spark, tmp_path):
    rows = [(7 if i % 3 == 0 else i, 0, 0, 10 + i % 40, 1) for i in range(900)] + [(7, p, 0, 64, 1) for p in range(50)]
    spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(4).write.parquet(str(tmp_path / "p"))
    got = packing.pack(spark.read.parquet(str(tmp_path / "p")), capacity=64, shard_documents=100).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in got) == sorted((r[0], r[1], r[3]) for r in rows)
    shards = Counter(r.sequence_id >> 32 for r in got if r.doc_id == 7 and r.length < 64)
    assert len(shards) == 9 and max(shards.values()) < 60
    used = Counter()
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 64


def test_units_have_the_ids_of_whole_texts():
    encoder = packing.Encoder(token_counts.model_path(packing.MODEL))
    rng, odd = random.Random(7), [" ", "a", "B", "\n", "É", "<|endoftext|>", "'s", "the", "́", "日本", ".", ",", "'", "\x1c", "Σ", "ÿ", "\xa0", "It's,", "2", "&&", "%", "(", "[\\", "]_", "-", "#{|", "fox", "º", "µ"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(14))) for _ in range(6000)]
    assert encoder.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def fewest(pieces, capacity):
    """The least number of bins, by trying all."""
    best = len(pieces)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(pieces):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + pieces[k] <= capacity and bins[i] not in bins[:i]:
                place(k + 1, bins[:i] + [bins[i] + pieces[k]] + bins[i + 1 :])
        place(k + 1, [*bins, pieces[k]])

    pieces = sorted(pieces, reverse=True)
    place(0, [])
    return best


def test_bin_completion_is_no_worse_than_best_fit_and_mostly_optimal():
    rng, optimal = random.Random(8), 0
    for _ in range(40):
        pieces = [rng.randrange(1, 60) for _ in range(10)]
        lengths = dict(Counter(pieces))
        got = packing.complete(lengths, 100)
        assert Counter(x for b in got for x in b) == Counter(pieces) and all(sum(b) <= 100 for b in got)
        assert len(got) <= len(packing.best_fit(lengths, 100)) and packing.lower_bound(lengths, 100) <= fewest(pieces, 100)
        optimal += len(got) == fewest(pieces, 100)
    assert optimal >= 39
    assert packing.complete({}, 100) == []
    lengths = Counter(np.random.default_rng(3000).integers(500, 1501, 3000).tolist())
    bins, least, plain = packing.complete(lengths), packing.lower_bound(lengths, 2048), len(packing.best_fit(lengths, 2048))
    assert Counter(x for b in bins for x in b) == lengths and max(map(sum, bins)) <= 2048
    assert len(bins) - least <= (plain - least) // 2
    found, _ = packing.search(Counter([6, 5, 5, 4]), 10, 2, 100)
    assert sorted(map(sorted, found)) == [[4, 6], [5, 5]] and packing.search(Counter([6, 6]), 10, 1, 100)[0] is None
    # best fit needs three bins here, bin completion two
    assert len(packing.complete(dict(Counter([51, 27, 22, 40, 30, 30])), 100)) == 2


def test_mixing(docs, empty, values, spark):
    got = mixing.mix(docs).collect()
    sizes = {r.source: r.source_size for r in got}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(sizes)
    while open_:
        share = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        for s in over or open_:
            target[s] = 3.0 * sizes[s] if over else share * weight[s]
        open_ -= over or open_
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert mine[0].target == pytest.approx(target[s])
        assert abs(sum((r.base * r.rows + r.extra) * r.size for r in mine) - target[s]) <= max(r.size for r in mine)
    assert all(0 <= r.extra <= r.rows and 0 <= r.base + (r.extra > 0) <= 3 for r in got) and sum(r.rows for r in got) == len(values)
    again = Counter(tuple(r) for r in mixing.mix(docs.repartition(5)).collect())
    assert again == Counter(tuple(r) for r in got)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.base * r.rows + r.extra for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    capped = mixing.source_targets(spark.createDataFrame([("a", 1), ("b", 1), ("c", 100), (None, 0)], "source string, source_size long")).collect()
    assert {r.source: r.target for r in capped} == pytest.approx({"a": 3, "b": 3, "c": 96, None: 0})


def test_mixing_of_a_row_on_a_third_of_the_table(spark, monkeypatch):
    """Ten words a row; 300 rows are one document. Its source's words come as near the target as one row's size."""
    monkeypatch.setattr(mixing, "PART_ROWS", 40)
    rows = [(7, "w " * 10, "a", i) for i in range(300)] + [(1000 + i, f"{i} " * 10, "ab"[i % 2], i) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place int").repartition(7)
    got = mixing.mix(docs).collect()
    for s, target in (("a", 3000.0), ("b", 6000.0)):
        mine = [r for r in got if r.source == s]
        assert {r.target for r in mine} == {target} and abs(sum((r.base * r.rows + r.extra) * r.size for r in mine) - target) <= 10
    mixed = Counter(r.place for r in mixing.mixed_documents(docs).where("doc_id = 7").collect())
    hot = next(r for r in got if r.doc_id == 7)
    assert sum(mixed.values()) == hot.base * 300 + hot.extra and max(mixed.values()) == 1 and hot.extra == 150


def test_fingerprints(docs, empty, values, spark):
    got = fingerprints.document_fingerprints(docs).collect()
    order = sorted(values, key=lambda v: (v[0] is not None, v[0] or 0, v[1] or ""), reverse=True)
    want = Counter()
    for k, (i, t) in enumerate(order):
        t, f = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        want[(i, len(t), hashlib.sha256((t[: len(t) - half] + f[:half]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by = {r.doc_id: r for r in got}
    assert by[200].fingerprint == by[3].fingerprint != by[201].fingerprint
    assert by[300].fingerprint == by[301].fingerprint and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    big = [r for r in got if r.n_chars > 400]
    assert np.mean([r.near_edited for r in big]) > 0.3 + np.mean([r.near_next for r in big])
    assert fingerprints.document_fingerprints(empty).count() == 0
    one = spark.createDataFrame([(1, "p one\np two\np three"), (2, "p three\np one\np two"), (3, "p one\np three"), (4, "p two")], "doc_id long, text string")
    fp = {r.doc_id: r for r in fingerprints.with_fingerprint(one, "text", "fp").collect()}
    assert fp[1].fp == fp[2].fp != fp[3].fp
    pair = spark.createDataFrame([(fp[3].fp, fp[4].fp, fp[1].fp)], "a array<long>, b array<long>, c array<long>")
    r = pair.select(fingerprints.plus(F.col("a"), F.col("b")).alias("sum"), fingerprints.minus(F.col("c"), F.col("b")).alias("rest")).first()
    assert r["sum"] == fp[1].fp and r.rest == fp[3].fp


def shout(rng, n):
    return " ".join(w.upper() + "!!" for w in prose(rng, n).split())


def labelled(spark, n=240):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        bad, toxic = i % 4 == 0, i % 3 == 0
        t = shout(rng, 40) if bad else prose(rng, 60)
        rows.append((i, t + (" you idiot scum " + prose(rng, 5) if toxic else ""), 0 if bad else 1, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "quality", "toxic")


def test_quality_network(spark, docs, empty):
    texts, marks = labelled(spark)
    got = {r.doc_id: r for r in quality_cnn.quality_scores(texts, marks).collect()}
    held = [r for r in got.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in got if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all((r.predicted == 0) == (r.doc_id % 4 == 0) for r in held)
    odd = quality_cnn.quality_scores(docs, marks)
    assert odd.count() == docs.count() and odd.where("score IS NULL OR held_out IS NULL").count() == 0
    kept = quality_cnn.keep_quality(docs, marks)
    assert kept.columns == docs.columns
    assert quality_cnn.quality_scores(empty, marks).count() == 0
    assert quality_cnn.quality_scores(docs, marks.limit(0)).select("score").distinct().count() == 1


def test_a_text_scores_the_same_alone_in_company_and_in_blocks(monkeypatch):
    net, rng = quality_cnn.fresh(), random.Random(10)
    texts = [prose(rng, rng.randrange(0, 300)).encode() for _ in range(20)] + [b"", b"a"]
    together = quality_cnn.scores(net, texts)
    assert np.allclose(together, [quality_cnn.scores(net, [t])[0] for t in texts], atol=1e-6)
    monkeypatch.setattr(quality_cnn, "BLOCK", 512)
    assert np.allclose(together, quality_cnn.scores(net, texts), atol=1e-6)


def test_toxicity(spark, docs, empty):
    texts, marks = labelled(spark)
    got = {r.doc_id: r for r in toxicity.toxicity_scores(texts, marks).collect()}
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in got.values())
    assert toxicity.toxicity_scores(docs, marks).where("score IS NULL").count() == 0
    assert toxicity.toxicity_scores(empty, marks).count() == 0
    assert toxicity.toxicity_scores(docs, marks.limit(0)).where("predicted = 1").count() == 0


def test_automaton_and_trie_against_edit_distances():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
            row = new
        return row[-1]

    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    terms = {word(rng.randrange(4, 8)): rng.random() + 0.5 for _ in range(12)}
    trie = toxicity.Trie(terms, {}, set(terms))
    for _ in range(3000):
        w = word(rng.randrange(3, 9))
        near = [v for t, v in terms.items() if len(t) >= 4 and distance(w, t) <= 1] if len(w) >= 5 else []
        want = (terms[w], False) if w in terms else (max(near, default=0.0), bool(near))
        assert trie.find(w) == want


def test_quotation_weighs_elsewhere_than_abuse():
    model = toxicity.Model({"idiot": 2.0}, {}, {"idiot"})
    assert model.features("you idiot you")[0] > 0 and model.features("you idiot you")[2] == 0
    assert model.features('she said: "idiot" is a word')[2] > 0 and model.features("what an idoit or idiott")[1] > 0


def test_misspellings_of_rare_terms_are_found_and_weighed_apart():
    model = toxicity.Model({"idiot": 2.0, "scumbag": 1.0}, {}, {"idiot"})
    assert model.trie.find("scumbagg") == (1.0, 2) and model.trie.find("idiott") == (2.0, 1)
    got = model.features("you scumbagg you idiott")
    assert got[6] > 0 and got[1] > 0 and got[7] == 0 and model.features('he said "scumbagg" then')[7] > 0
    rng = random.Random(13)
    rare = ["".join(rng.choice("bcdfghjklm") + rng.choice("aeiou") for _ in range(4)) for _ in range(11)]
    y, wrong = np.arange(616) % 4 == 1, lambda w, letter: w[:3] + letter + w[3:]
    texts = [prose(rng, 40) for _ in y]
    for k, i in enumerate(np.flatnonzero(y)):  # each term in seven documents, and misspelled in seven
        texts[i] += " " + (wrong(rare[k % 11], "aeiou"[k // 22 % 5]) if k // 11 % 2 else rare[k % 11])
    model = toxicity.fit(texts, y.astype(int))
    assert set(rare) <= set(model.weights) and not set(rare) & model.common
    assert (model.score([prose(rng, 40) + " " + wrong(w, "z") for w in rare]) >= 0.5).all()
    assert (model.score([prose(rng, 40) for _ in range(20)]) < 0.5).all()


def test_documents_with_a_common_header_or_footer_are_not_copies():
    rng = random.Random(14)
    header, footer = "This page is part of the archive of the old stone bridge society. ", " All rights of this page are with the old stone bridge society and others."
    y = np.arange(60) % 2
    texts = [header + prose(rng, 60) + (" scumbag " if toxic else " ") + prose(rng, 60) + footer for toxic in y]
    assert set(toxicity.learn_terms(texts, y)[0]) == {"scumbag"}
    copies = [prose(rng, 60) + " scumbag"] * 8 + [prose(rng, 60) for _ in range(60)]
    assert not toxicity.learn_terms([t.upper() if i % 2 else t for i, t in enumerate(copies)], np.arange(68) < 8)[0]


def test_whole_texts_are_fitted(spark, monkeypatch):
    rng = random.Random(15)
    late = lambda end: prose(rng, 4500) + end  # noqa: E731: the evidence stands behind 20,000 characters
    rows = [(i, late(" you idiot scum" if i % 3 == 0 else " the end"), int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert "idiot" in toxicity.train(docs.select("doc_id", "text"), docs).weights
    assert set(training.sample(docs.select("doc_id", "text"), docs, "toxic", 99, 99)["text"]) == {t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5}
    fitted = []
    monkeypatch.setattr(quality_cnn, "fit", lambda texts, y: fitted.extend(texts))
    quality_cnn.train(docs.select("doc_id", "text"), docs.withColumn("quality", 1 - F.col("toxic")))
    assert set(fitted) == {t.encode() for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5}
    net = quality_cnn.fresh()
    some = [prose(rng, n).encode() for n in (0, 1, 30, 300, 900)]
    whole = quality_cnn.winners(net, some)
    monkeypatch.setattr(quality_cnn, "BLOCK", 512)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(whole, quality_cnn.winners(net, some)))


def test_a_repeated_doc_id_is_sampled_once(spark):
    rows = [(3, f"text {i}", 1) for i in range(50)] + [(i, f"own {i}", i % 2) for i in range(4, 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = training.sample(docs.select("doc_id", "text"), docs, "toxic", 99, 99)
    assert sorted(got["text"]) == sorted(["text 0"] * bool(zlib.crc32(b"3") % 5) + [f"own {i}" for i in range(4, 20) if zlib.crc32(str(i).encode()) % 5])


def test_likeness_of_long_repetitive_and_of_shifted_texts(spark):
    rng = random.Random(16)
    words = prose(rng, 400).split()
    pairs = [("one two three four\n" * 40000, "one two three four\n" * 20000), ("one two three four\n" * 65536, ""), (" ".join(words), " ".join(["new", *words])), (" ".join(words), prose(rng, 400))]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    both = fingerprints.with_fingerprint(fingerprints.with_fingerprint(rows, "a", "fa"), "b", "fb")
    got = {r.i: r for r in both.select("i", "fa", fingerprints.likeness(fingerprints.signs(F.col("fa")), fingerprints.signs(F.col("fb"))).alias("x")).collect()}
    assert abs(got[0].x - 0.8) < 1e-9 and got[1].x == 0 and got[2].x > 0.9 and got[3].x < 0.5 and got[1].fa[-1] == 65536
    odd = spark.createDataFrame([(0, "  a b\tc d e\n\n x y\n" + "z" * 100_000 + "\nq r s t \r\nü v")], "i long, a string")
    cut = odd.select(F.regexp_extract_all("a", F.lit(fingerprints.RUNS), F.lit(1)).alias("r")).first().r
    assert [r.split() for r in cut] == [["a", "b", "c", "d"], ["b", "c", "d", "e"], ["x", "y"], ["z" * 100_000], ["q", "r", "s", "t"], ["ü", "v"]]
