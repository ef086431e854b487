"""The language network against a plain network, finite differences and held-out documents."""

import random
import zlib

import numpy as np
import pytest

from tidepanel.llm import language_gru as gru

SYLLABLES = {"aa": "the and ing tion er with".split(), "bb": "ung sch keit über nicht ein".split(), "cc": "eau que été oi les".split()}


def corpus(n=240):
    rng = random.Random(4)
    out = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 60))]
        out.append((i, " ".join(words).capitalize() + ". 12", lang))
    return out


@pytest.fixture(scope="module")
def net():
    rows = corpus()
    return gru.fit([t for _, t, _ in rows], [x for _, _, x in rows], steps=150, hidden=8)


def plain_positions(net, unit):
    """Probabilities of each position, one byte and one direction after another."""

    def run(layer, data):
        size, h, out = len(layer.turn), np.zeros(len(layer.turn)), []
        for b in data:
            a, u = layer.table[b].astype(float), h @ layer.turn.astype(float)
            z, r = (1 / (1 + np.exp(-(a[k : k + size] + u[k : k + size]))) for k in (0, size))
            c = np.tanh(a[2 * size :] + r * u[2 * size :])
            h = (1 - z) * c + z * h
            out.append(h)
        return out

    for at in range(0, len(unit), gru.WINDOW):
        w = unit[at : at + gru.WINDOW]
        for f, b in zip(run(net.ahead, w), run(net.back, w[::-1])[::-1]):
            s = np.concatenate([f, b]) @ net.out + net.bias
            yield np.exp(s) / np.exp(s).sum()


def plain_pooled(net, text):
    units, word = [], b""
    for b in (text or "").lower().encode() + b" ":
        if b >= 128 or chr(b).isalpha():
            word += bytes([b])
        elif word:
            units.append(word)
            word = b""
    found = [p for u in units if any(c.isalpha() for c in u.decode()) for p in plain_positions(net, u)]
    return np.mean(found, axis=0) if found else np.zeros(len(net.names))


ODD = ["", " \n ", "123 !?", "“”", "x", "Ünd übersch-keit 7", "eau" * 50, "the " * 300, "日本語 and", "été que", "a\x00b", "ÉAU QUE"]


def test_pooled_probabilities_against_a_plain_network(net, monkeypatch):
    texts = ODD + [t for _, t, _ in corpus(12)]
    want = np.array([plain_pooled(net, t) for t in texts])
    assert np.allclose(gru.Reader(net).pooled(texts), want, atol=1e-5)
    monkeypatch.setattr(gru, "STRETCH", 7)  # long texts come in parts
    monkeypatch.setattr(gru, "MEMORY_UNITS", 5)  # and units are forgotten
    reader = gru.Reader(net)
    for _ in range(2):
        assert np.allclose(reader.pooled(texts), want, atol=1e-5)
    assert "".join(gru.stretches("ab cd  efghijklmnop q")) == "ab cd  efghijklmnop q"


def test_backpropagation_through_time_against_finite_differences():
    net, rng = gru.fresh(["a", "b", "c"], hidden=4, kind=np.float64), np.random.default_rng(3)
    x, y = rng.integers(97, 103, (5, 6)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    _, grads = gru.gradient(net, x, y)
    for part, grad in zip(net.parts(), grads):
        flat, g = part.reshape(-1), grad.reshape(-1)
        for i in [*np.abs(g).argsort()[-3:], int(rng.integers(len(g)))]:
            old = flat[i]
            flat[i] = old + 1e-5
            up, _ = gru.gradient(net, x, y)
            flat[i] = old - 1e-5
            down, _ = gru.gradient(net, x, y)
            flat[i] = old
            assert g[i] == pytest.approx((up - down) / 2e-5, abs=1e-7)


def test_identify(spark, monkeypatch):
    monkeypatch.setattr(gru, "FIT_STEPS", 150)
    rows = [(i, t, lang, "s", 1.0) for i, t, lang in corpus()]
    rows += [(1000, None, "aa", "s", None), (1001, "", None, None, None), (1002, "7 !", "bb", "s", None), (None, "the and", "aa", "s", None), (3, rows[3][1], "aa", "s", None), (1003, "les eau que " * 3000, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double").repartition(3)
    got = gru.identify(docs).collect()
    assert len(got) == len(rows) and gru.identify(docs).columns == ["doc_id", "held_out", "lang_pred", "score"]
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1000, 1001, 1002)) and by_id[1003].lang_pred == "cc"
    assert by_id[None].held_out is False and by_id[None].lang_pred == "aa"
    held = [(i, lang) for i, _, lang, *_ in rows[:240] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(by_id[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(240))
    assert np.mean([by_id[i].lang_pred == lang for i, lang in held]) >= 0.95 and all(0 <= r.score <= 1 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, gru.identify(docs).collect()))
    # Labels of the held-out fifth, doc_id and source say nothing: without them the answers stay.
    hidden = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'zz', lang) AS lang")
    assert sorted(map(str, got)) == sorted(map(str, gru.identify(hidden).collect()))
    assert gru.identify(docs.limit(0)).count() == 0
    none = gru.identify(docs.selectExpr("doc_id", "text", "cast(null as string) AS lang")).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    one = gru.identify(docs.selectExpr("doc_id", "text", "'aa' AS lang")).collect()
    assert {r.lang_pred for r in one} == {"aa", "und"}


def test_sample_bounds_a_hot_doc_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}", "aa") for i in range(30)] + [(i, "x y", "bb") for i in range(2, 60)], "doc_id long, text string, lang string")
    texts, langs = gru.sample(docs, each=5)
    assert langs.count("bb") == 5 and langs.count("aa") == 1 and texts[langs.index("aa")] == "text 0"
