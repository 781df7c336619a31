"""Language, collocations and spelling variants against plain re-statements."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute

CLASH = "doc_id bigint, text string, lang string, word string, `key` string, n int, score string, held_out string, doc string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, g, "w", "k", 1, "s", "h", "d", 2) for d, t, g in rows], CLASH).repartition(4)


def corpus(seed=3):
    rng = random.Random(seed)
    letters = {"en": "abcdelmnorst", "xx": "éèçjkquvwxyz", None: "fghip"}
    words = {g: ["".join(rng.choice(a) for _ in range(rng.randint(3, 8))) for _ in range(25)] for g, a in letters.items()}
    rows = []
    for i in range(240):
        lang = rng.choice([*letters])
        text = "".join(rng.choice(words[lang]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",\n"]) for _ in range(rng.randint(1, 60)))
        rows.append((i, text.upper() if i % 9 == 0 else text, lang))
    rows += [(500 + i, rows[3][1], rows[3][2]) for i in range(80)]  # a third of the rows are one text
    rows += [(None, None, None), (None, "", "en"), (7, " \n ", "en"), (8, "12 %", "xx"), (9, " ".join(words["en"] * 400), "en")]
    return rows


def test_double_array_steps():
    from txnfeatures.llm.doublearray import advance, digits_of, step_trie

    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(0, (40, 70_000), (6000, 2)), axis=0)
    pairs = np.concatenate([pairs, np.stack([np.full(500, 41), np.arange(500)], 1)])  # a state with many ways on
    base, check, last = step_trie(pairs[:, 0] + 1, pairs[:, 1], 42, 3)
    assert len(set(last.tolist())) == len(pairs)
    asked = np.concatenate([pairs, rng.integers(0, (42, 70_000), (4000, 2))])
    at = asked[:, 0] + 1
    for symbol in digits_of(asked[:, 1], 3).T:
        at = advance(base, check, at, symbol)
    known = {tuple(p): s for p, s in zip(pairs.tolist(), last.tolist())}
    assert at.tolist() == [known.get(tuple(p), 0) for p in asked.tolist()]


def plain_collocations(rows, floor, most):
    f, n, out = {}, Counter(), set()
    for _, text, lang in rows:
        own = f.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(brute.UPPER)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            own.update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= floor}
        inner = {p[i:j] for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and a >= own[p[i:j]]}
        scored = []
        for p, a in found.items():
            if p not in inner:
                score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out |= {(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:most], 1)}
    return out


@pytest.mark.parametrize("block", [1 << 19, 40])
def test_collocations(spark, monkeypatch, block):
    from txnfeatures.llm import collocations as C

    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "ROW", 1000)
    rows = corpus()
    got = {tuple(r) for r in C.collocations(frame(spark, rows), floor=20, most=30).collect()}
    assert got == plain_collocations(rows, 20, 30) and len(got) > 30
    if block > 40:
        assert C.collocations(frame(spark, rows).limit(0)).count() == 0
        assert C.collocations(frame(spark, rows), floor=10**6).count() == 0


def test_spelling_variants(spark):
    from txnfeatures.llm.spelling import group_variants

    rows = corpus(4)
    counts = Counter()
    for doc, text, _ in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(brute.UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 3 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 4 and c >= 3}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {a: [b for b in n if one_edit(a, b)] for a in n}
    best = {a: min(near[a], key=lambda b: (-n[b], b), default=None) for a in n}
    form = {a: b if b and n[b] >= 2 * n[a] else None for a, b in best.items()}

    def root(a):
        return root(form[a]) if form[a] else a

    want = {(a, form[a], root(a), n[a], len(near[a]), n[form[a]] if form[a] else None) for a in n}
    docs = frame(spark, rows)
    got = group_variants(docs, min_letters=4, typo=3).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and any(form.values())
    assert group_variants(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="factor"):
        group_variants(docs, factor=1)


def test_gradients_equal_differences():
    from txnfeatures.llm import langid as G

    rng = np.random.default_rng(0)
    weights = G.initial(3, hidden=4)
    symbols = rng.integers(97, 101, (7, 5))
    symbols[5:, 2] = G.NONE
    labels = rng.integers(0, 3, 5)
    _, grads = G.gradients(weights, symbols, labels)
    for k, grad in enumerate(grads):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        ends = []
        for step in (1e-2, -1e-2):
            moved = [w.copy() for w in weights]
            moved[k][at] += step
            ends.append(G.gradients(moved, symbols, labels)[0])
        assert grad[at] == pytest.approx((ends[0] - ends[1]) / 2e-2, rel=1e-2)


def test_windows_hold_every_byte_once():
    from txnfeatures.llm import langid as G

    texts = [b"a" * 3, b"", bytes(range(97, 123)) * 40, b"z" * G.WINDOW]
    offsets = np.cumsum([0, *map(len, texts)])
    seen = {i: b"" for i in range(len(texts))}
    for symbols, text in G.windows_of(np.frombuffer(b"".join(texts), np.uint8), offsets):
        for column, i in zip(symbols[G.CONTEXT : G.CONTEXT + G.WINDOW].T, text):
            seen[int(i)] += bytes(column[column != G.NONE].tolist())
    assert [seen[i] for i in range(len(texts))] == texts


def test_language_of_documents(spark):
    from txnfeatures.llm.hmm import is_held_out
    from txnfeatures.llm.langid import train_identifier

    rows = [(d, t, {None: "ff"}.get(g, g)) for d, t, g in corpus(5)[:240]] + corpus(5)[-5:] + [(600, "Ünï", None)]
    docs, held_out = frame(spark, rows), is_held_out(parts=4)
    model = train_identifier(docs.where(~held_out), sample=300, steps=150)
    assert model.languages == ["en", "ff", "xx"]
    got = model.predict(docs, held_out=held_out).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {d: g for d, t, g in rows[:240] if len(t) > 20}
    tested = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id < 240 and r.doc_id not in (7, 8, 9)]
    assert len(tested) > 20 and np.mean([r.lang_pred == truth[r.doc_id] for r in tested]) > 0.95
    none = [r for r in got if r.doc_id is None] + [r for r in got if r.lang_pred == "und"]
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in none) and all(0 <= r.score <= 1 for r in got)
    untaught = train_identifier(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in untaught.predict(docs).collect()} == {("und", 0.0)}
    assert untaught.predict(docs.limit(0)).count() == 0
