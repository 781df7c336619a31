"""The numpy and text kernels against plain re-statements; no Spark."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from txnfeatures.llm import dac, decontaminate, hmm, mixing, pii, repetition
from txnfeatures.llm.words import Words, run_hashes, text_chunks

TEXTS = [
    None, "", " ", "\n\n", "One", "one TWO", "a b c a b c a b c", "x\ny\nx\n\nx\ny ", "Ébène é\tça\x0bva\x0c!", "a" * 5000,
    "tab\tand\rreturn\nline  double", "the cat sat on the mat " * 9, "#1 $ % <b> | & *",
]


@pytest.mark.parametrize("limit", [1, 20, 1 << 20])
def test_words(limit):
    seen = {}
    for first, rows, data, offsets in text_chunks(pa.array(TEXTS), limit):
        w = Words(data, offsets)
        h = w.hashes()
        for i in range(rows):
            own = [bytes(data[a:b]).decode() for a, b in zip(w.starts, w.ends)][w.first[i] : w.first[i + 1]]
            assert own == brute.words(TEXTS[first + i], lower=False)
            for word, value in zip(own, h[w.first[i] : w.first[i + 1]]):
                assert seen.setdefault(word.translate(brute.UPPER), value) == value
    assert len(set(seen.values())) == len(seen)


def test_run_hashes_tell_windows_apart():
    texts = ["a b c d", "a b", "b a", "a b c", "", "a b c e"]
    ((_, rows, data, offsets),) = text_chunks(pa.array(texts))
    w = Words(data, offsets)
    h, at = run_hashes(w.hashes(), w.first, 3, short=True)
    sets = [set(h[at[i] : at[i + 1]].tolist()) for i in range(rows)]
    for a, b in itertools.combinations(range(rows), 2):
        assert len(sets[a] & sets[b]) == len(brute.shingles(texts[a], 3) & brute.shingles(texts[b], 3))


def test_repetition_measures():
    rng = random.Random(4)
    texts = TEXTS + ["\n".join(" ".join(rng.choices("abc", k=rng.randint(0, 9))) for _ in range(30)) for _ in range(40)]
    found = repetition._measured(pa.array(texts))
    for i, text in enumerate(texts):
        want = brute.repetition(text)
        for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", "chars"):
            assert found[k][i] == want[k], (k, text)
        for n in repetition.COVERAGE:
            assert found[f"repeat_chars_{n}"][i] == brute.repetition(text, n)["repeat_chars"]


def random_model(k=3, symbols=16, seed=1):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    return hmm.Parameters(norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((symbols, k)), 0))


def plain_forward(model, symbols):
    state, total = model.start, 0.0
    for s in symbols:
        state = (state @ model.move) * model.emit[s]
        total += math.log(state.sum())
        state = state / state.sum()
    return total


def test_forward_is_exact_over_whole_texts():
    model, rng = random_model(), np.random.default_rng(2)
    lengths = [1, 31, 32, 33, 64, 200, 1, 7]
    at = np.concatenate(([0], np.cumsum(lengths)))
    symbols = rng.integers(0, 16, at[-1])
    _, logs = hmm.Windows(symbols, at, model).forward()
    for i in range(len(lengths)):
        assert logs[i] == pytest.approx(plain_forward(model, symbols[at[i] : at[i + 1]]))


def test_expected_counts_are_those_of_all_paths():
    model, symbols = random_model(2, 4), [0, 3, 3, 1, 2]
    k, want_move, want_emit, total = 2, np.zeros((2, 2)), np.zeros((4, 2)), 0.0
    for path in itertools.product(range(k), repeat=len(symbols) + 1):
        p = model.start[path[0]]
        for a, b, s in zip(path, path[1:], symbols):
            p *= model.move[a, b] * model.emit[s, b]
        total += p
        for a, b, s in zip(path, path[1:], symbols):
            want_move[a, b] += p
            want_emit[s, b] += p
    _, move, emit = hmm.Windows(np.array(symbols), np.array([0, 5]), model).expected()
    assert move == pytest.approx(want_move / total)
    assert emit == pytest.approx(want_emit / total)


def test_training_never_lowers_the_likelihood():
    rng = np.random.default_rng(3)
    at = np.arange(0, 2001, 100)
    symbols = np.where(rng.random(2000) < 0.5, np.repeat(rng.integers(0, 4, 20), 100) * 4 + rng.integers(0, 4, 2000), rng.integers(0, 16, 2000))
    model, last = random_model(4), -math.inf
    for _ in range(6):
        w = hmm.Windows(symbols, at, model)
        now = w.forward()[1].sum()
        assert now >= last - 1e-6
        last = now
        start, move, emit = w.expected()
        model = hmm.Parameters(start / start.sum(), move / move.sum(1)[:, None], emit / emit.sum(0))


@pytest.mark.parametrize("n", [0, 1, 7, 512, 513, 5000])
def test_codes_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.choice(np.array([0, 1, 255, 256, 50256, 65535, 65536, 1 << 24, (1 << 32) - 1], dtype=np.uint32), n)
    codes = dac.Codes(dac.pack(ids))
    assert codes.all().tolist() == ids.tolist()
    assert len(codes) == n
    for i in {0, n // 2, n - 1} & set(range(n)):
        assert codes[i] == ids[i]
    with pytest.raises(IndexError):
        codes[n]


def test_encoder_equals_the_library():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rng = random.Random(5)
    bits = ["a", "a.", "b,", ".", ",", " ", "  ", "é", "\n", "\n\n", "\r", "\t", "don't", "12", "ß ", " x", " ", "　", "!?", "<|endoftext|>", " \n", "汉字", "\x1c", "\x00", "'s", " "]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(12000)] + [x or "" for x in TEXTS]
    encode, n = dac.Encoder(path), 0
    for _, rows, data, offsets in text_chunks(pa.array(texts), 3000):
        ids, at = encode(data, offsets)
        for i in range(rows):
            assert ids[at[i] : at[i + 1]].tolist() == plain.encode(texts[n], add_special_tokens=False).ids, repr(texts[n])
            n += 1
    assert n == len(texts)


def test_units_are_confirmed_byte_by_byte(monkeypatch):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    ((_, _, data, offsets),) = text_chunks(pa.array(["one two three", "", "two four"]))
    encode = dac.Encoder(path)
    want = encode(data, offsets)
    monkeypatch.setattr(dac, "span_hashes", lambda data, starts, ends, values: np.zeros(len(starts), np.uint64))
    got = dac.Encoder(path)(data, offsets)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_trades_keep_mass_and_end_in_an_integer():
    rng = random.Random(6)
    for _ in range(500):
        p, q, a, b = rng.random(), rng.random(), rng.randint(1, 50), rng.randint(1, 50)
        x, y = mixing.trade(p, a, q, b, rng.random())
        assert x * a + y * b == pytest.approx(p * a + q * b)
        assert 0 <= x <= 1 and 0 <= y <= 1 and ({x, y} & {0.0, 1.0})


def test_trades_keep_expectations():
    rng, n = random.Random(7), 40_000
    total = sum(mixing.trade(0.3, 5, 0.6, 2, rng.random())[0] for _ in range(n)) / n
    assert total == pytest.approx(0.3, abs=0.01)


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(8)
    item = rng.integers(1, 6, 12).astype(np.uint64)
    windows = rng.integers(1, 6, (60, 25)).astype(np.uint64)
    best, _ = decontaminate.align(item, windows)
    for i in range(len(windows)):
        assert best[i] == brute.smith_waterman(item.tolist(), windows[i].tolist())


def test_personal_data_equals_the_patterns():
    rng = random.Random(9)
    bits = ["a", "b.c", "@", "@x.y", ".", "1", "23", "4.5.6.7", "300.1.1.1", "-", " ", "+", "+1 (555) 010-9999", "4111 1111 1111 1111", "%", "é", "0001.2.3.4", "a@b", "\n", "("]
    machine = pii.build_machine()
    for _ in range(6000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        got = [(s, pii.KINDS[k], e) for s, k, e in pii.text_spans(text, machine) if pii.KINDS[k] in pii.BASE_KINDS]
        assert got == brute.personal(text), repr(text)


def test_added_kinds():
    text = "See https://ex.org/a?b=1, or www.site.net. IBAN: DE89 3704 0044 0532 0130 00 and account no 123-456-789; password=hunter2x!"
    found = {(pii.KINDS[k], text[s:e]) for s, k, e in pii.text_spans(text, pii.build_machine())}
    assert {
        ("url", "https://ex.org/a?b=1"), ("url", "www.site.net"), ("iban", "DE89 3704 0044 0532 0130 00"),
        ("account", "123-456-789"), ("secret", "hunter2x!"),
    } <= found


@pytest.mark.parametrize("text", ["a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" * 100_000, "1-" * 150_000, "a@" * 100_000, "www." * 50_000])
def test_long_runs_take_linear_time(text):
    pii.text_spans(text, pii.build_machine())
