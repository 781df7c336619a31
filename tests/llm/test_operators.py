"""Operators on small fixtures with nulls, empty and repeated rows, and clashing column names."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, size int, shard string, key string, "
    "_row int, _hash string, _bucket string, _key string, _rate string, _size string, doc string, seen string, node string"
)


def prose(rng, n, alphabet=400):
    return " ".join(f"w{rng.randrange(alphabet)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    base = [prose(rng, rng.randint(25, 80)) for _ in range(25)]
    out = [(i, t) for i, t in enumerate(base)]
    for i in range(40):  # near copies of one text, of falling similarity
        words = base[3].split()
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
        out.append((100 + i, " ".join(words).upper() if i % 7 == 0 else " ".join(words)))
    out += [(200 + i, base[5]) for i in range(20)]
    out += [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "ONE"), (305, "one two"), (306, "Ünïcode ß " * 40)]
    out += [(None, base[7]), (None, None), (None, prose(rng, 40)), (7, base[7]), (7, base[8]), (400, base[9]), (400, base[9])]
    out.append((500, prose(rng, 30000, 5000)))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(d, t, "en", None if i % 11 == 0 else f"s{i % 3}", None, i % 2 == 0, 1, "x", "k", 5, *"abcdefgh") for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("shingle,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, rows, shingle, percent):
    from txnfeatures.llm.minhash import near_duplicates

    found = near_duplicates(docs, shingle=shingle, percent=percent).select("doc_id", "n_shingles", "component_id", "kept")
    names = brute.components(rows, shingle, percent)
    want = [(d, len(brute.shingles(t, shingle)), c, c == d) for (d, t), c in zip(rows, names)]
    assert collected(found) == sorted(want, key=str)


def test_components_of_a_long_path(spark):
    from txnfeatures.llm.minhash import components

    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(30)}


def test_language_model(docs, rows):
    from txnfeatures.llm.hmm import is_held_out, token_hashes, train

    held = [d is not None and brute.crc(d) % 7 == 2 for d, _ in rows]
    model = train(docs.where(~is_held_out()), symbols=64, rounds=2)
    found = model.score(docs, held_out=is_held_out()).collect()
    assert len(found) == len(rows)
    learned = [t for (_, t), h in zip(rows, held) if not h]
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    counts = Counter(t for x in learned for t in [*brute.words(x), None])
    p = model.parameters
    assert p.emit.sum(0) == pytest.approx(1) and p.move.sum(1) == pytest.approx(1) and p.start.sum() == pytest.approx(1)
    buckets, members = Counter(), Counter()

    def bucket(word):
        data = np.frombuffer((word or "").encode(), np.uint8)
        return int(token_hashes(data, np.array([0, len(data)]))[0][0 if word else -1] & np.uint64(63))

    place = {w: bucket(w) for w in {t for _, x in rows for t in brute.words(x)} | {None}}
    for w, c in counts.items():
        buckets[place[w]] += c
        members[place[w]] += 1
    for (d, t), h in zip(rows, held):
        n, known, total, base = brute.unigram(learned, t) if len(t or "") < 9000 else (None,) * 4
        match = [r for r in by_id[d] if n is None or (r.n_tokens == n and abs(r.base_score - base) < 1e-6)]
        assert match and match[0].held_out == h
        if n is None:
            continue
        assert (match[0].n_known, match[0].train_tokens) == (known, total)
        state, score = p.start, 0.0
        for w in [*brute.words(t), None]:
            state = (state @ p.move) * p.emit[place[w]]
            score += math.log10(state.sum()) + math.log10((counts[w] + 1) / (buckets[place[w]] + members[place[w]] + 1))
            state = state / state.sum()
        assert any(abs(r.score - score) < 1e-6 for r in match)


def test_language_model_beats_the_unigram_on_held_out_text(spark):
    from txnfeatures.llm.hmm import is_held_out, train

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = train(docs.where(~is_held_out())).score(docs, held_out=is_held_out()).where("held_out")
    gain = scored.agg(F.sum("score").alias("m"), F.sum("base_score").alias("b"), F.avg((F.col("score") > F.col("base_score")).cast("double")).alias("share")).first()
    assert gain["m"] > gain["b"] and gain["share"] > 0.8


def test_quality(docs, rows):
    from txnfeatures.llm.repetition import keep_good, measure

    found = measure(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.n_repeat_words) for r in found if r.doc_id is not None) == sorted(
        (d, len(brute.words(t)), brute.repetition(t)["n_repeat_words"]) for d, t in rows if d is not None
    )
    kept = keep_good(docs)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r.kept for r in found)


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 20])
def test_shards(docs, rows, bucket_bytes):
    from txnfeatures.llm.shuffle import shuffle_into_shards

    out = shuffle_into_shards(docs, shards=8, bucket_bytes=bucket_bytes)
    found = out.collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    sizes = Counter(r.shard for r in found)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sizes[shard]))
    again = shuffle_into_shards(docs.repartition(3), shards=8, bucket_bytes=bucket_bytes)
    assert collected(again.select("shard", "slot", "doc_id", "text")) == collected(out.select("shard", "slot", "doc_id", "text"))


def test_token_codes(docs, rows, spark):
    from tokenizers import Tokenizer

    from txnfeatures.llm.dac import Codes, read_codes, segments, write_codes

    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    uri = write_codes(docs, path, segment_tokens=500)
    want = sorted(((d, [*plain.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    found = sorted(read_codes(spark, uri).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [d for d, _ in want]
    total = 0
    for r in found:
        assert r.start == total
        total += r.n_tokens
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter((d, len(i), crc(i)) for d, i in want)
    flat = {}
    for s in segments(spark, uri).collect():
        codes = Codes(bytes(s.payload))
        for i in range(0, len(codes), 97):
            flat[s.before + i] = codes[i]
    whole = {d: ids for d, ids in want if sum(x == d for x, _ in want) == 1}
    checked = 0
    for r in found:
        for i in range(r.start, r.start + r.n_tokens) if r.doc_id in whole else ():
            if i in flat:
                assert flat[i] == whole[r.doc_id][i - r.start]
                checked += 1
    assert checked > 50


def water_level(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names if s not in capped}
        over = {s for s in share if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def test_mixing(docs, rows):
    from txnfeatures.llm.mixing import mix, mixed

    found = mix(docs).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    sizes, taken = Counter(), Counter()
    for r in found:
        assert r._size == len(brute.words(r.text)) and 0 <= r._copies <= 3
        sizes[r.source] += r._size
        taken[r.source] += r._size * r._copies
    want = water_level(sizes)
    largest = {s: max(r._size for r in found if r.source == s) for s in sizes}
    for r in found:
        assert r._target == pytest.approx(want[r.source]) and r._source_size == sizes[r.source]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert collected(mix(docs.repartition(2)).select("doc_id", "text", "_copies")) == collected(mix(docs).select("doc_id", "text", "_copies"))
    out = mixed(docs)
    assert out.schema == docs.schema and out.count() == sum(r._copies for r in found)


def test_mixing_tree_and_caps(spark, monkeypatch):
    from txnfeatures.llm import mixing

    monkeypatch.setattr(mixing, "BUCKET", 7)
    monkeypatch.setattr(mixing, "FAN", 3)
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(1, 60)), "big" if i < 400 else f"s{i % 4}") for i in range(460)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert len(found) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in found:
        sizes[r.source] += r._size
        taken[r.source] += r._size * r._copies
    want = water_level(sizes)
    assert any(want[s] == 3 * sizes[s] for s in sizes)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30 + 1e-6


def test_templates(spark, empty):
    from txnfeatures.llm.templates import drop_templates

    rng = random.Random(3)
    docs = []
    for i in range(30):
        own = prose(rng, 12, 10**6)
        log = f"Error 50{i % 9} in module m{i} at line {i * 7}"
        docs.append((i, f"{own}\n{log}\n\nCopyright held by the authors of this text\n{own[::-1]}"))
    docs += [(100 + i, docs[0][1]) for i in range(40)]  # copies of one text do not make a template of its own lines
    docs += [(200, None), (201, ""), (None, docs[1][1]), (202, "Copyright held by the authors of this text")]
    found = drop_templates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert len(found) == len(docs)
    for r in found:
        if r.text is None:
            assert (r.doc_id, r.n_lines, r.n_dropped) == (200, 0, 0)
        elif r.doc_id in (201, 202):
            assert r.text == "" and r.n_dropped == (r.doc_id == 202)
        else:
            text = dict(docs)[r.doc_id].split("\n")
            assert (r.n_lines, r.n_dropped, r.text) == (5, 2, "\n".join([text[0], "", text[4]]))
    assert drop_templates(empty).count() == 0


def test_short_and_rare_lines_recur_token_for_token(spark):
    from txnfeatures.llm.templates import drop_templates

    rng = random.Random(4)
    docs = []
    for i in range(40):
        lines = [prose(rng, 9, 10**6), "Read  more", prose(rng, 9, 10**6), f"Page {i}", "Share"]
        if i in (3, 17):
            lines.append("Licensed under terms of the 3rd edition")
        if i == 5:
            lines += ["only here twice", "only here twice"]
        if i < 9:
            lines.append(f"Chapter {i} of nine")
        docs.append((i, "\n".join(lines)))
    for r in drop_templates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect():
        # "Page <n>" recurs in forty texts, "Chapter <n> of nine" in one too few; a line twice in one text does not recur
        lines = dict(docs)[r.doc_id].split("\n")
        gone = ("Read", "Page", "Share", "Licensed")
        assert r.text.split("\n") == [x for x in lines if not x.startswith(gone)]
        assert r.n_dropped == 3 + (r.doc_id in (3, 17))


def test_pipeline_keeps_one_row_of_each_group(spark):
    """Rows equal in id and text, ids shared by different texts, and groups without ids."""
    import corpus_pipeline

    rng = random.Random(8)
    a, b, c, d = (prose(rng, 60, 3000) for _ in range(4))
    docs = [(1, a)] * 5 + [(2, b), (2, b + " zz"), (3, b)] + [(None, c)] * 4 + [(None, c + " yy")] + [(None, d), (7, d), (6, d), (9, None), (9, ""), (8, prose(rng, 60, 3000))]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = corpus_pipeline.near_dedup(spark, frame, "")
    assert out.columns == frame.columns
    got = out.collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted([1, 2, None, 6, 8, 9, 9], key=str)
    assert {r.text for r in got if r.doc_id is None} <= {c, c + " yy"}


def test_pipeline_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline

    rng = random.Random(18)
    a, b = prose(rng, 60, 3000), prose(rng, 60, 3000)
    bench = spark.createDataFrame([(1, a)], "item_id bigint, text string")
    docs = [(1, b, "r", 5), (2, b, "s", 6), (3, a, "t", 7), (None, None, None, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, _row string, _id int")
    frame = frame.selectExpr("*", "_id AS _text", "_row AS number", "_row AS id", "_id AS row")
    kept = corpus_pipeline.near_dedup(spark, frame, "")
    assert kept.columns == frame.columns
    assert {(r.doc_id, r._row, r.row) for r in kept.collect()} == {(1, "r", 5), (3, "t", 7), (None, None, None)}
    from txnfeatures.llm.decontaminate import drop_matches

    clean = drop_matches(frame, bench)
    assert clean.columns == frame.columns
    assert {(r.doc_id, r._row, r._text) for r in clean.collect()} == {(1, "r", 5), (2, "s", 6), (None, None, None)}


def test_a_third_of_the_rows_equal_leave_one_text_per_node(spark, monkeypatch):
    from txnfeatures.llm import minhash

    rng = random.Random(19)
    a, b = prose(rng, 60, 3000), prose(rng, 60, 3000)
    texts = [a] * 300 + [a + " zz"] * 2 + [b, b + " yy"] + [prose(rng, 60, 3000) for _ in range(200)]
    rows = [(None if i < 200 else 7, t) for i, t in enumerate(texts[:300])] + [(1000 + i, t) for i, t in enumerate(texts[300:])]
    held = []
    plain = minhash._texts
    monkeypatch.setattr(minhash, "_texts", lambda *args: held.append((out := plain(*args)).collect()) or out)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()
    assert len(found) == len(rows) and len(held[0]) == 4 == len({r.node for r in held[0]})
    assert {r.component_id for r in found if r.doc_id in (None, 7, 1000, 1001)} == {7}
    assert {r.component_id for r in found if r.doc_id in (1002, 1003)} == {1002}


def test_components_are_contracted(spark):
    from txnfeatures.llm import minhash
    from txnfeatures.llm.store import Run

    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (205, 200)]
    run = Run(spark, "test")
    labels = minhash.components(spark.createDataFrame(chain, "a bigint, b bigint"), run).collect()
    assert {r.node: r.label for r in labels} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 205: 200}
    assert minhash.components(spark.createDataFrame([], "a bigint, b bigint"), run).count() == 0


def test_decontamination(spark, empty):
    from txnfeatures.llm.decontaminate import matches

    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(20, 45), 3000)) for i in range(12)] + [(None, "x"), (50, None), (51, "")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs, want = [], set()
    for i in range(60):
        words = prose(rng, 150, 3000).split()
        if i % 3 == 0:
            item = i % 12
            copy = items[item][1].split()
            for _ in range(len(copy) // 8):  # edits: changed, left out, put in
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([["zz"], [], [copy[at], "yy"]])
            at = rng.randrange(100)
            words[at:at] = copy
            want.add((i, item))
        docs.append((i, " ".join(words).upper() if i % 2 else " ".join(words)))
    docs += [(None, items[0][1]), (70, None), (71, ""), (72, items[1][1]), (72, items[1][1])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = matches(frame, bench, pack=5).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want | {(None, 0), (72, 1)}
    assert sum(r.doc_id == 72 for r in found) == 2
    for r in found:
        if r.doc_id is not None:
            text = dict(docs)[r.doc_id]
            assert r.score <= brute.smith_waterman(brute.words(items[r.item_id][1]), brute.words(text))
            assert 100 * r.score >= 60 * r.full_score
    assert matches(empty, bench).count() == 0
    assert matches(frame, bench.limit(0)).count() == 0


def test_decontamination_finds_evenly_edited_copies(spark):
    """Copies above the threshold that keep few or no 3-grams, one or many of them; against alignment of all pairs."""
    from txnfeatures.llm.decontaminate import matches

    rng = random.Random(11)
    items = [(i, prose(rng, n, 3000)) for i, n in enumerate((40, 33, 16, 11, 10, 6, 5, 4, 2))] + [(None, prose(rng, 30, 3000))]
    docs = []
    for item, (_, text) in enumerate(items):
        w = text.split()
        copies = [[x if i % k else "zz" for i, x in enumerate(w, 1)] for k in (3, 4, 5, 6) for _ in range(3)]
        copies += [[y for i, x in enumerate(w, 1) for y in ([x] if i % k else [x, "yy"])] for k in (1, 2, 3)]
        copies += [[x for i, x in enumerate(w, 1) if i % k] for k in (3, 4, 5)]
        for copy in copies:
            around = prose(rng, 120, 3000).split()
            around[60:60] = copy
            docs.append((len(docs), " ".join(around)))
    want = {
        (d, i)
        for d, t in docs
        for i, x in items
        if 100 * brute.smith_waterman(brute.words(x), brute.words(t)) >= 60 * 2 * len(x.split())
    }
    found = matches(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), pack=4
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert sum(i == 0 for _, i in want) >= 12 and sum(i is None for _, i in want) >= 12


def test_decontamination_of_equal_texts_and_common_pairs(spark):
    """A third of the rows is one text that holds an item; every text and item shares its commonest pairs; against alignment of all pairs."""
    from txnfeatures.llm.decontaminate import candidates, matches
    from txnfeatures.llm.store import Run

    rng = random.Random(5)
    stock = "of the people in this land and of the sea".split()
    items = [(i % 7, " ".join(stock + prose(rng, 12, 400).split() + stock[:4])) for i in range(9)] + [(8, None), (9, "of the")]
    items.append(items[0])
    same = " ".join(stock * 3 + items[3][1].split() + stock * 2)
    docs = [(i, same) for i in range(40)] + [(None, same)]
    docs += [(100 + i, " ".join(stock * 4 + prose(rng, 60, 400).split())) for i in range(40)]
    docs += [(200, " ".join(stock * 4000 + items[5][1].split() + stock)), (201, None), (202, " \n")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("u", F.lit(1)).withColumn("seen", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = Counter()
    for d, t in docs:
        if t is not None and len(t) < 10_000:
            for i, x in items:
                if x and 100 * brute.smith_waterman(brute.words(x), brute.words(t)) >= 60 * 2 * len(x.split()):
                    want[(d, i)] = 1
    found = matches(frame, bench).where("item_id != 9").collect()
    short = {k for k in want if k[1] != 9}
    assert {(r.doc_id, r.item_id) for r in found if r.doc_id != 200} == short
    assert (200, items[5][0]) in {(r.doc_id, r.item_id) for r in found}
    units = bench.where("text IS NOT NULL").select(F.xxhash64("text").alias("u"), "text").distinct()
    texts = frame.select(F.xxhash64("text").alias("seen"), F.xxhash64(F.lit(1), "text").alias("check"), "text")
    assert candidates(texts, units, Run(spark, "seeds"), 60, 3).groupBy("seen").agg(F.max("pack")).count() > 0


def test_chat(spark):
    from txnfeatures.llm.chat import digest, format_turns, read_turns

    turns = [
        (1, 0, "user", "a </turn>\n### assistant: \\s \\\\ #<"), (1, 1, "assistant", "b\\"), (2, 0, "assistant", "x"), (2, 1, "user", None),
        (3, 0, "we:ird ### role", ""), (None, 0, None, "n"), (None, 0, None, "n"), (4, None, "system", "s"), (4, 1, "user", "u"),
        (4, 2, "assistant", "v"), (4, 3, "tool", "t"), (4, 4, "assistant", "w"),
    ]
    rows = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id bigint, turn bigint, role string, text string, segments string")
    formatted = format_turns(rows)
    back = read_turns(formatted)
    assert Counter((r.conv_id, r.turn, r.role, r.text) for r in back.collect()) == Counter((c, t, r or "", x or "") for c, t, r, x in turns)
    found = {r.conv_id: r for r in digest(back).collect()}
    assert {c: r.valid for c, r in found.items()} == {1: True, 2: False, 3: False, None: False, 4: True}
    assert (found[4].n_turns, found[4].loss_chars, found[1].loss_chars) == (5, 2, 2)


def test_personal_data(docs, rows, spark):
    from txnfeatures.llm.pii import find_spans

    texts = [(1, "mail a.b@c.de now +1 (555) 010-9999"), (None, "4111 1111 1111 1111"), (2, None), (2, "1.2.3.4 é 5.6.7.8")]
    found = find_spans(spark.createDataFrame([(*t, "s") for t in texts], "doc_id bigint, text string, spans string")).collect()
    got = [(r.doc_id, [(s.start, s.kind, s.end) for s in r.spans]) for r in found]
    assert sorted(got, key=str) == sorted(((d, brute.personal(t)) for d, t in texts), key=str)


def test_empty_tables(empty, spark):
    from txnfeatures.llm import chat, dac, hmm, minhash, mixing, pii, repetition, shuffle

    assert minhash.near_duplicates(empty).count() == 0
    assert hmm.train(empty, rounds=1).score(empty).count() == 0
    assert repetition.measure(empty).count() == 0
    assert shuffle.shuffle_into_shards(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert pii.find_spans(empty).count() == 0
    rows = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digest(chat.read_turns(chat.format_turns(rows))).count() == 0
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    assert dac.read_codes(spark, dac.write_codes(empty, path)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        after = stage(spark, docs, sf)
        if name != "sharding":
            assert after.columns == docs.columns
        out[name] = (docs.collect(), after.collect())
        docs = spark.createDataFrame(out[name][1], after.schema)
    before, after = out["near-dedup"]
    names = brute.components([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, c in zip(before, names) if r.doc_id == c)
    before, after = out["decontamination"]
    items = [brute.words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in after}
    for r in before:
        leak = any(" ".join(item) in " ".join(brute.words(r.text)) for item in items)
        assert not (leak and r.doc_id in kept)
    assert len(out["sharding"][1]) == len(out["mixing"][1])
    assert pipeline.run(spark, sf).count() == len(out["sharding"][1])
