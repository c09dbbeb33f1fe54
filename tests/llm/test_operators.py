"""Each training-data operator against brute force on small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.llm import chat, embedding_forest, hmm, language, line_templates, media, mixing, ngram_join, packing, token_count
from terrafold.llm.queries import QUERIES
from tests.llm.conftest import WORD, words


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


# -- 1 mixing -------------------------------------------------------------------


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, left = sum(sizes.values()), {}, set(names)
    while True:
        rest = total - sum(out.values())
        share = sum(w[s] for s in left)
        over = [s for s in left if rest * w[s] / share > most * sizes[s] + 1e-9]
        if not over:
            return out | {s: rest * w[s] / share for s in left}
        for s in over:
            out[s] = float(most * sizes[s])
            left.remove(s)


def test_mixing(docs):
    rows = mixing.mix_sources(docs).collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(text)
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(words(text[r["doc_id"]])) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    want = targets(sizes)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-9)
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] + 5 for s in sizes)


def test_mixing_reruns_agree(docs):
    one, two = (sorted(map(tuple, mixing.mix_sources(docs.repartition(n)).select("doc_id", "taken").collect())) for n in (2, 5))
    assert one == two


def test_mixing_blocks_of_huge_sources(spark):
    """Bounds of blocks where products of sizes would not fit into 64 bits."""
    for size, blocks in ((10**15 + 12345, 10**12 + 7), (7, 7), (10, 4), (5 * 10**13, 48828125000)):
        words = sorted({0, 1, size // 3, size // 2, size - 2, size - 1} & set(range(size)) if size < 100 else {0, 1, size // 3, size // 2, size - 2, size - 1})
        d = spark.createDataFrame([(w, size, blocks) for w in words], "word long, source_size long, blocks long").withColumn("block", mixing.block_of("word"))
        for r in d.select("*", mixing.block_start("block").alias("lo"), mixing.block_start("block + 1").alias("hi")).collect():
            assert 0 <= r["block"] < blocks and r["lo"] <= r["word"] < r["hi"] and r["lo"] == r["block"] * size // blocks


def test_mixing_odd(odd, empty):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == odd.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["doc_id"] for r in rows if r["size"] == 0} == {1, 2, 3}
    assert mixing.mix_sources(empty).collect() == []


# -- 2 language model -------------------------------------------------------------


def test_hmm_scores(docs):
    train = F.col("doc_id") % 7 != 2
    rows = {r["doc_id"]: r for r in hmm.hmm_scores(docs, train).collect()}
    toks = {r["doc_id"]: [*words(r["text"]), None] for r in docs.collect()}
    c = Counter(w for i, ws in toks.items() if i % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in toks.items():
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in c for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    held = [i for i in toks if i % 7 == 2]
    assert sum(rows[i]["score"] for i in held) > sum(rows[i]["base_score"] for i in held)


def test_forward_is_the_sum_over_paths():
    rng = np.random.default_rng(1)
    model = hmm.Model(np.array([0.3, 0.7]), np.array([[0.9, 0.1], [0.4, 0.6]]), rng.dirichlet(np.ones(5), 2).T)
    texts = [rng.integers(0, 5, n).astype(np.int32) for n in (6, 1, 3)]
    for x, got in zip(texts, model.scores(texts)):
        total = 0.0
        for path in np.ndindex(*(2,) * len(x)):
            p = model.start[path[0]] * model.emit[x[0], path[0]]
            for t in range(1, len(x)):
                p *= model.move[path[t - 1], path[t]] * model.emit[x[t], path[t]]
            total += p
        assert math.isclose(got, math.log(total), rel_tol=1e-9)


def test_baum_welch_raises_the_likelihood():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 12, 40).astype(np.int32) for _ in range(30)]
    prior = np.full(12, 1 / 12)
    model, before = hmm.Model.initial(prior, 3), -1e18
    for _ in range(6):
        now = model.scores(texts).sum()
        assert now >= before - 1e-6
        before = now
        starts, moves, emits = model.expected(texts, 12)
        assert math.isclose(emits.sum(), sum(map(len, texts)), rel_tol=1e-9) and math.isclose(starts.sum(), len(texts), rel_tol=1e-9)
        model = hmm.Model(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def test_stretches_of_a_long_text(monkeypatch):
    """A text worked on in stretches has the counts of the whole text."""
    rng = np.random.default_rng(5)
    model = hmm.Model.initial(np.full(9, 1 / 9), 3)
    texts = [rng.integers(0, 9, n).astype(np.int32) for n in (1, 7, 103, 40, 50, 64)]
    want, score = model.expected(texts, 9), model.scores(texts)
    for together, stretch in ((30, 10), (45, 8), (1, 1), (5, 64)):
        monkeypatch.setattr(hmm, "TOGETHER", together)
        monkeypatch.setattr(hmm, "STRETCH", stretch)
        assert all(np.allclose(a, b) for a, b in zip(model.expected(texts, 9), want, strict=True)) and np.allclose(model.scores(texts), score)


def test_words_and_classes():
    texts = [b"", None, b"One two  THREE\x0b4,", "ü übx 你好 a\xa0b x".encode(), b" \n ", b"a" * 300 + b" bc-"]

    def plain(w):
        size = sum(len(w) >= k for k in (4, 7, 10, 15))
        at = next((i for i, c in enumerate(w) if c > 127), None)
        mark = 0 if at is None else 1 + (w[at + 1] if at + 1 < len(w) else 0) % 8
        return (size * 9 + mark) * 2 + (w[-1] < 128 and not w[-1:].isalnum())

    for most in (1 << 20, 40, 7, 1):
        got, hashes = defaultdict(list), {}
        for which, n, h, c in hmm._words(texts, most):
            at = 0
            for i, k in zip(which, n):
                got[i] += list(zip(h[at : at + k].tolist(), c[at : at + k].tolist()))
                at += k
        assert set(got) == set(range(len(texts)))
        for i, t in enumerate(texts):
            want = (t or b"").lower().split()
            assert [c for _, c in got[i]] == [plain(w) for w in want]
            for w, (h, _) in zip(want, got[i], strict=True):
                assert hashes.setdefault(w, h) == h
        assert len(set(hashes.values())) == len(hashes)


def test_hmm_score_equals_the_model(spark, monkeypatch):
    """The score column against the sum over the model's own symbols, with a vocabulary too small for all words."""
    kept = {}
    refit = hmm.Model.refit
    monkeypatch.setattr(hmm, "VOCABULARY", 12)
    monkeypatch.setattr(hmm.Model, "refit", staticmethod(lambda *a: kept.setdefault("models", []).append(refit(*a)) or kept["models"][-1]))
    rng = np.random.default_rng(8)
    names = [f"{'abcde'[i % 5] * (1 + i % 11)}{'é' * (i % 2)}{i}" for i in range(40)]
    texts = [" ".join(rng.choice(names, int(rng.integers(0, 30)), p=np.arange(40, 0, -1) / 820)) for _ in range(50)] + ["new words only", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["score"] for r in hmm.hmm_scores(frame, F.col("doc_id") % 7 != 2).collect()}
    model = kept["models"][-1]
    count = Counter(w for i, t in enumerate(texts) if i % 7 != 2 for w in words(t))
    steps = defaultdict(list)
    for w, c in count.items():
        steps[math.floor(8 * math.log2(c))].append(w)
    vocabulary, room = [], 12
    for k in sorted(steps, reverse=True):
        room -= len(steps[k])
        if room < 0:
            break
        vocabulary += steps[k]
    h = {w: int(hmm.piece_words(w.encode())[3].view(np.int64)[0]) for t in texts for w in words(t)}
    vocabulary.sort(key=h.get)
    kind = {w: int(next(hmm._words([w.encode()]))[3][0]) for w in h}
    for i, t in enumerate(texts):
        symbols, shares = [], 0.0
        for w in words(t):
            if w in vocabulary:
                symbols.append(vocabulary.index(w))
            else:
                rest = [x for x in count if x not in vocabulary and kind[x] == kind[w]]
                symbols.append(len(vocabulary) + kind[w])
                shares += math.log10((count[w] + 1) / (sum(count[x] for x in rest) + len(rest) + 1))
        a = model.start * model.emit[(symbols + [len(vocabulary) + hmm.CLASSES])[0]]
        for k in (symbols + [len(vocabulary) + hmm.CLASSES])[1:]:
            a = (a @ model.move) * model.emit[k]
        assert math.isclose(rows[i], math.log10(a.sum()) + shares, rel_tol=1e-9)


def test_states_earn_something(docs, monkeypatch):
    """Held-out texts are likelier under the states than under one state of the same form."""
    held = {}
    for states in (1, hmm.STATES):
        monkeypatch.setattr(hmm, "STATES", states)
        held[states] = sum(r["score"] for r in hmm.hmm_scores(docs, F.col("doc_id") % 7 != 2).collect() if r["doc_id"] % 7 == 2)
    assert held[hmm.STATES] > 0.99 * held[1]


def test_hmm_odd(odd, empty):
    rows = hmm.hmm_scores(odd, F.col("doc_id") > 3).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (1, 2, 3))
    none = hmm.hmm_scores(odd, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in none)
    assert hmm.hmm_scores(empty, F.lit(True)).collect() == []


# -- 3 packing, 6 token counts ------------------------------------------------------


def check_pieces(rows, want):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for doc, pieces in by_doc.items():
        total = sum(p["length"] for p in pieces)
        assert total == sum(len(x) for x in want[doc])
        if len(want[doc]) == 1:
            full, at = np.array(want[doc][0], dtype="<u4"), 0
            for p in sorted(pieces, key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(full) and zlib.crc32(full[at : at + p["length"]].tobytes()) == p["ids_crc32"]
                at += p["length"]
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding


def test_packing(docs, library):
    rows = packing.pack_documents(docs).collect()
    want = {r["doc_id"]: [[*ids_of(library, r["text"]), 2]] for r in docs.collect()}
    assert {r["doc_id"] for r in rows} == set(want)
    assert check_pieces(rows, want) == 0
    window = {r["sequence_id"]: (r["window"], r["step_group"]) for r in rows}
    filled = Counter()
    for r in rows:
        filled[r["sequence_id"]] += r["length"]
    assert all(window[k][0] == n for k, n in filled.items())
    groups = Counter()
    for w, g in window.values():
        groups[w, g] += w
    short = Counter(w for (w, _), n in groups.items() if n != packing.STEP_TOKENS)
    assert max(groups.values()) == packing.STEP_TOKENS and all(n == 1 for n in short.values())


def test_packing_odd(odd, empty, library):
    want = defaultdict(list)
    for r in odd.collect():
        want[r["doc_id"]].append([*ids_of(library, r["text"]), 2])
    check_pieces(packing.pack_documents(odd).collect(), want)
    assert packing.pack_documents(empty).collect() == []


def test_packer_memory_and_groups():
    rng = np.random.default_rng(4)
    packer, total = packing.TierPacker(0, reserve=4, open_bins=2), 0
    for i in range(600):
        n = int(rng.integers(1, 6000))
        packer.add(packing.Piece(i, 0, memoryview(bytes(4 * n)), n))
        total += n
        assert all(len(q) <= 40 for q in packer.waiting.values()) and all(len(b) <= 3 for b in packer.bins.values())
    packer.finish()
    assert sum(r[2] for r in packer.rows) == total
    window = {r[5]: (r[7], r[8]) for r in packer.rows}
    sums = Counter()
    for w, g in window.values():
        sums[g] += w
    assert all(v <= packing.STEP_TOKENS for v in sums.values())
    filled = Counter()
    for r in packer.rows:
        filled[r[5]] += r[2]
    assert all(filled[s] == window[s][0] for s in filled)
    short = {r[8]: r[9] for r in packer.short_groups()}
    of_group = Counter(g for _, g in window.values())
    assert all(v == packing.STEP_TOKENS for g, v in sums.items() if g not in short) and all(of_group[g] == n for g, n in short.items())


def test_other_vocabularies_go_through_the_library():
    """The written-out splitting pattern serves the one vocabulary that has it."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    texts = ["Hello world, it's 2024!", "  two  blanks\n\nand lines ", "ünï <|endoftext|> x", "", "I'LL've 12345 --- ..."]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        ours, theirs = token_count.tokenizer(name), Tokenizer.from_file(path(name))
        assert ours.by_pieces == name.startswith("word")
        for t in texts:
            want = theirs.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(ours.encode(t), "<u4").tolist() == want and ours.count(t) == len(want)
            assert ours.encode_with_starts(t)[1].tolist() == want


def test_token_counts(docs, odd, empty, library):
    for table, kw in ((docs, {}), (docs, {"chunk": 500, "overlap": 8}), (odd, {"chunk": 700, "overlap": 8})):
        got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_count.token_counts(table, **kw).collect())
        want = Counter()
        for r in table.collect():
            n = len(ids_of(library, r["text"]))
            want[r["doc_id"], len((r["text"] or "").encode()), n, n > 2048] += 1
        assert got == want
    assert token_count.token_counts(empty).collect() == []


# -- 4 media ------------------------------------------------------------------------


def test_codecs_round_trip():
    rng = np.random.default_rng(0)
    for shape in ((1, 1, 3), (5, 7, 3), (64, 64, 3)):
        a = rng.integers(0, 256, shape).astype(np.uint8)
        assert (media.decode_image(media.encode_netpbm(a)) == a).all() and (media.decode_image(media.encode_bmp(a)) == a).all()
        assert (media.from_tiles(media.to_tiles(a, 3)) == a).all()
    g = rng.integers(0, 256, (4, 6)).astype(np.uint8)
    assert (media.decode_image(media.encode_netpbm(g)) == g).all()
    assert media.decode_image(b"P2 # note\n2 1\n255\n3 200").tolist() == [[3, 200]]
    assert media.decode_image(b"P1\n3 1\n1 0 1").tolist() == [[0, 255, 0]]
    with pytest.raises(ValueError):
        media.decode_image(b"GIF89a")


def test_area_resize_is_the_exact_mean():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 256, (13, 17))
    fine = np.kron(a, np.ones((8, 9)))  # every target border falls on a border of the fine grid
    want = fine.reshape(8, 13, 9, 17).mean(axis=(1, 3))
    assert np.allclose(media.area_resize(a, 8, 9), want)


def test_text_media_of_an_empty_table(empty):
    assert media.text_media(empty).collect() == []


def test_text_media(docs, odd):
    import hashlib

    for table in (docs, odd):
        texts = [(r["doc_id"], (r["text"] or "").encode()) for r in table.collect()]
        rows = media.text_media(table, keep_tiles=True).collect()
        assert len(rows) == len(texts)
        want = Counter()
        for i, data in texts:
            full = data.ljust(max(192, -(-len(data) // 192) * 192), b" ")
            want[i, len(data), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:])] += 1
        assert want == Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in rows)
        for r in rows[:20]:
            data = b"".join(map(bytes, r["tiles"]))
            assert (r["media_bytes"], r["media_sha256"]) == (len(data), hashlib.sha256(data).hexdigest())


def test_decode_media_keeps_bad_rows(spark):
    rows = [(1, bytearray(media.encode_bmp(np.zeros((2, 2, 3), np.uint8)))), (2, bytearray(b"?")), (3, None)]
    bad = [b"P2\n1 1\n255\n300", b"P2\n1 1\n255\n" + b"9" * 40, b"P2\n1 1\n0\n0", b"P5\n0 3\n255\n", b"P3\n1 1\n255\n1 2", b"P1\n1 1\n7", b"BM" + bytes(60), b"P2\n1 1\n255\n-1", b"P5\n9 9\n70000\n" + bytes(200)]
    rows += [(10 + i, bytearray(b)) for i, b in enumerate(bad)] + [(2, bytearray(b"?")), (None, bytearray(b"P2 1 1 300 299"))]
    got = {r["id"]: r for r in media.decode_media(spark.createDataFrame(rows, "k int, img binary"), id_col="k", image_col="img").collect()}
    assert (got[1]["height"], got[1]["error"]) == (2, None) and got[2]["error"] and got[3]["error"]
    assert all(got[10 + i]["error"] and got[10 + i]["height"] is None for i in range(len(bad))) and got[None]["height"] == 1
    none = spark.createDataFrame([], "k int, img binary, height int")
    assert media.decode_media(none, id_col="k", image_col="img").collect() == []


# -- 5 language ---------------------------------------------------------------------


def test_letters_by_category():
    assert not any(map(language.has_letter, [None, "", "12 34 !!", "½ ² Ⅷ ৪ _"])) and all(map(language.has_letter, ["½ a", "你", "ª", "ʰ"]))


def test_language_machines_separate(spark):
    """Many languages under the bound of the whole sample; families of one language and of several."""
    rng = np.random.default_rng(3)
    words = {k: ["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(12)] for k in ("en", "de", "fr", "es", "it", "xx", "yy")}
    rows = [(i, " ".join(rng.choice(words[k], 30)), k) for i, k in enumerate(list(words) * 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train_language_model(frame.filter("doc_id % 2 = 0"), sample=70)
    got = language.predict_language(frame.filter("doc_id % 2 = 1"), model).collect()
    assert model.languages == sorted(words) and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


def test_language(docs, odd, empty):
    train = docs.filter(~language.held_out("doc_id", 3, 1))
    model = language.train_language_model(train)
    rows = language.predict_language(docs, model).select("lang", "lang_pred", "score", language.held_out("doc_id", 3, 1).alias("h")).collect()
    held = [r for r in rows if r["h"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in rows)
    got = language.predict_language(odd, model).collect()
    assert len(got) == odd.count()
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3, 9)) for r in got)
    assert language.train_language_model(empty) is None
    assert {r["lang_pred"] for r in language.predict_language(odd, None).collect()} == {"und"}


# -- 7 embeddings ---------------------------------------------------------------------


def test_embedding_forest(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((700, 16)).astype(np.float32)
    for a, b in ((0, 50), (50, 60)):
        x[a:b] = x[a] + 0.05 * rng.standard_normal((b - a, 16))
    x[650] = x[649]
    bad = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0, None]), (1004, [])]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + bad
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("cid", F.lit(2))
    got = {r["vec_id"]: r for r in embedding_forest.embedding_near_duplicates(d).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    want = link.sum(1)
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum()
    assert got[650]["component_id"] == got[649]["component_id"] <= 649 and got[0]["component_id"] == 0
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i, _ in bad)
    assert embedding_forest.embedding_near_duplicates(d.limit(0)).collect() == []


def test_embedding_rows_that_repeat(spark):
    """Rows are vectors of their own, also with equal or missing ids; copies are links, not one vector."""
    v, w, u = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(5, v), (5, v), (None, v), (2, w), (2, u), (None, u), (9, [2.0, 0.1, 0.0]), (7, [0.0, -1.0, 0.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n_links", F.lit(8)).withColumn("label", F.lit(1))
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_forest.embedding_near_duplicates(d).collect())
    assert got == Counter({(5, 3, 5): 2, (None, 3, 5): 1, (2, 0, 2): 1, (2, 1, 2): 1, (None, 1, 2): 1, (9, 3, 5): 1, (7, 0, 7): 1})


def test_large_leaves_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_forest, "BLOCK", 64)
    monkeypatch.setattr(embedding_forest, "LEAF", 10**9)
    rng = np.random.default_rng(3)
    x = (np.ones(8) + 0.3 * rng.standard_normal((300, 8))).astype(np.float32)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    got = {r["vec_id"]: r["n_links"] for r in embedding_forest.embedding_near_duplicates(d, trees=2).collect()}
    assert [got[i] for i in range(300)] == link.sum(1).tolist()


def test_a_hot_group_over_many_leaves_keeps_its_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_forest, "LEAF", 16)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 64)).astype(np.float32)
    x[:2000] = x[0] + 0.28 * rng.standard_normal((2000, 64))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    got = {r["vec_id"]: r["n_links"] for r in embedding_forest.embedding_near_duplicates(d).collect()}
    found, want = np.array([got[i] for i in range(len(x))]), link.sum(1)
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum(), found.sum() / want.sum()


# -- 8 line templates -------------------------------------------------------------------


def test_line_templates(spark):
    rng = np.random.default_rng(6)
    w = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))
    foot = "Printed on page {} of the archive of old letters by hand"
    names = ["ana", "bob", "cyd", "dov"]
    rows = [(i, "\n".join([w(12), foot.format(i), w(9), f"posted under the open license by user {names[i % 4]} in the town"])) for i in range(12)]
    copies = [(100 + i, rows[0][1].split("\n")[0] + "\n" + "\n".join(["same line of a copied text number one", "same line of a copied text number two"])) for i in range(6)]
    alone = [(200 + i, "only this line here and nothing else") for i in range(5)]
    d = spark.createDataFrame(rows + copies + alone, "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_templates.drop_template_lines(d).collect()}
    for i, text in rows:
        first, _, third, _ = text.split("\n")
        assert got[i]["text"] == f"{first}\n{third}" and (got[i]["n_lines"], got[i]["n_dropped"]) == (4, 2)
    assert all(got[i]["text"] == t for i, t in copies + alone)


def brute_template_lines(texts, least=3):
    """The documented rule on unrelated texts, where each text that holds a line counts."""
    holders, lines = {}, []
    for i, text in enumerate(texts):
        for j, line in enumerate((text or "").split("\n")):
            tokens = tuple("<*>" if re.search("[0-9]", w) else w for w in WORD.findall(line))
            if tokens:
                lines.append((i, j, tokens))
                holders.setdefault(tokens, set()).add(text)
    gone = {(i, j) for i, j, t in lines if len(holders[t]) >= least}
    rest = [x for x in lines if len(holders[x[2]]) < least and len(x[2]) > line_templates.DEPTH]
    leaf_of = lambda t: (len(t), t[: line_templates.DEPTH])
    leaves, count = {}, Counter()
    for _, _, t in rest:
        leaves.setdefault(leaf_of(t), []).append(t)
        count.update((leaf_of(t), i, w) for i, w in enumerate(t))
    found = {}
    for i, j, t in rest:
        constant = tuple(w if count[leaf_of(t), k, w] >= least else None for k, w in enumerate(t))
        if len(set(leaves[leaf_of(t)])) >= 2 and sum(w is not None for w in constant) >= line_templates.SIMILARITY * len(t):
            found.setdefault((leaf_of(t), constant), []).append((i, j))
    for places in found.values():
        if len({texts[i] for i, _ in places}) >= least:
            gone.update(places)
    out = []
    for i, text in enumerate(texts):
        kept = [x for j, x in enumerate((text or "").split("\n")) if (i, j) not in gone]
        out.append(text if text is None or not any(WORD.search(x) for x in kept) else "\n".join(kept))
    return out


def test_line_templates_equal_the_rule(spark, monkeypatch):
    """Many templates of one leaf, with CRLF, tabs and numbers, in unrelated texts; parsed in pieces of any size."""
    rng = np.random.default_rng(21)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 7))
    own = lambda: " ".join(word() for _ in range(25))
    forms = [f"on this day the {word()} {word()} was {{}} at the {word()} gate" for _ in range(9)]
    forms += ["in leaf of own\twords {} and {} are variable here you see", "page 12{} of the book"]
    texts = []
    for _ in range(60):
        some = [forms[k].format(word(), word()) for k in rng.choice(len(forms), 3, replace=False)]
        some += [] if rng.integers(0, 3) else ["read the terms of use", f"  turn to page {rng.integers(1, 99)}  "]
        body = [own() for _ in range(4)] + some + ["", "\t"]
        rng.shuffle(body)
        texts.append(("\r\n" if rng.integers(0, 2) else "\n").join(body))
    texts += [None, "", " \n\t\n", "read the terms of use", texts[0]]
    want = Counter(brute_template_lines(texts))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = Counter(r["text"] for r in line_templates.drop_template_lines(frame).collect())
    assert got == want and sum(n for t, n in got.items() if t in texts) < 10
    whole = [x.tolist() for x in line_templates._lines([(t or "").encode() for t in texts])]
    for piece in (1, 40, 700):
        monkeypatch.setattr(line_templates, "PIECE", piece)
        assert [x.tolist() for x in line_templates._lines([(t or "").encode() for t in texts])] == whole


def test_line_templates_and_copies(spark):
    """A notice in unrelated texts goes, also where one of them has many near copies; the copies keep their own lines."""
    rng = np.random.default_rng(22)
    own = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(n))
    notice, base = own(12), [own(15) for _ in range(12)]
    texts = ["\n".join([own(20), own(20), notice, own(20)]) for _ in range(40)]
    for _ in range(300):
        copy = list(base)
        copy[rng.integers(0, 12)] = own(15)
        texts.append("\n".join([*copy, notice]))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_templates.drop_template_lines(frame).collect()}
    assert all(notice not in t for t in got.values())
    assert all(got[i] == "\n".join(x for x in t.split("\n") if x != notice) for i, t in enumerate(texts))


def test_line_templates_in_a_text_of_many_lines(spark):
    """Time grows with the lines of a text, not with their square."""
    same = [f"common line number {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} of all" for i in range(15000)]
    texts = ["\n".join(x for y in zip(same, [f"own{k}x{chr(97 + i % 26)} word {'abcdefghij'[i % 10]}{k}" for i in range(15000)]) for x in y) for k in range(4)]
    texts = [t + "\n" + " ".join(f"only{k}{chr(97 + i % 26)}" for i in range(50)) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = line_templates.drop_template_lines(frame).collect()
    assert all(r["n_lines"] == 30001 for r in rows)


def test_line_templates_odd(odd, empty):
    d = line_templates.drop_template_lines(odd)
    assert d.columns == [c for c in odd.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert Counter(r["text"] for r in d.collect()) == Counter(r["text"] for r in odd.collect())
    assert line_templates.drop_template_lines(empty).collect() == []


# -- 9 chat ---------------------------------------------------------------------------------


def test_tool_calls(spark):
    calls = [(1, 0, "a", None, "add", '{"y": 2, "x": 1}'), (1, 2, "b", "a", "add", '{"x": "no"}'), (1, 4, "c", "b", "what", "{}"), (1, 6, "d", "zz", "add", "nope"), (2, 0, "e", "f", "add", '{"x":1,"y":99}'), (2, 1, "f", "e", "add", '{"x":1,"y":3}'), (3, 0, None, None, "add", None), (1, 0, "a", None, "add", '{"y": 2, "x": 1}')]
    results = [(1, 1, "a", "3"), (1, 3, "b", 'say "hi"\n'), (1, 9, "b", "again"), (4, 1, "q", "lost"), (5, 5, None, "?")]
    schemas = [("add", "x", "integer", True, None, None), ("add", "y", "number", True, 0.0, 10.0)]
    out = chat.link_tool_calls(spark.createDataFrame(calls, "conv_id long, turn long, call_id string, parent_id string, name string, arguments string"), spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"), spark.createDataFrame(schemas, chat.SCHEMA_COLUMNS))
    got = {r["call_id"]: r for r in out.collect()}
    assert out.count() == 8
    assert [got[k]["depth"] for k in "abcd"] == [0, 1, 2, 0] and got["e"]["depth"] == got["f"]["depth"] == -1
    assert got["a"]["json"] == '{"arguments":{"x":1,"y":2},"id":"a","name":"add","result":"3"}' and got["a"]["valid"]
    assert got["b"]["errors"] == "x: kind; y: missing" and got["b"]["n_results"] == 2 and got["b"]["json"].endswith('"result":"say \\"hi\\"\\n"}')
    assert got["c"]["errors"] == "unknown tool" and got["d"]["errors"] == "not json" and got["e"]["errors"] == "y: range"
    assert got["q"]["kind"] == "orphan" and got[None]["errors"] == "no id"


def test_tool_calls_by_conversation(spark):
    """Identifiers that repeat in other conversations or in one, nulls, odd fields, and clashing columns."""
    calls = [(1, 0, "call_1", None, "f", '{"a":1}'), (2, 0, "call_1", None, "f", '{"a":2}'), (2, 4, "call_1", None, "f", '{"a":2}'), (2, 4, "call_1", None, "f", '{"a":2}'), (None, 1, "call_1", None, "f", None), (3, 1, None, None, "f", "{}"), (3, 1, None, None, "f", "{}"), (4, 1, "x", "y", "g", '{"it\'s":"v"}'), (4, 2, "y", "x", "g", "{}"), (5, 0, "long", None, "f", '{"a":"' + "z" * 300000 + '"}')]
    results = [(1, 1, "call_1", "one"), (2, 1, "call_1", "two"), (2, 5, "call_1", "more"), (9, 1, "call_1", "lost"), (None, None, "call_1", None), (3, 3, None, "nothing")]
    schemas = spark.createDataFrame([("f", "a", "integer", True, 0.0, 9.0), ("g", "it's", "string", True, 1.0, 2.0)], chat.SCHEMA_COLUMNS)
    c = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, parent_id string, name string, arguments string").selectExpr("*", "turn AS key", "1 AS row", "name AS depth", "1 AS v")
    r = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string").selectExpr("*", "1 AS key", "content AS r")
    got = Counter((x["conv_id"], x["turn"], x["call_id"], x["kind"], x["depth"], x["n_results"], x["result_turn"], x["errors"]) for x in chat.link_tool_calls(c, r, schemas).collect())
    assert got == Counter([
        (1, 0, "call_1", "call", 0, 1, 1, ""), (2, 0, "call_1", "call", 0, 2, 1, ""), (2, 4, "call_1", "call", 0, 2, 1, ""), (None, 1, "call_1", "call", 0, 1, None, "not json"), (3, 1, None, "call", 0, 0, None, "no id"),
        (4, 1, "x", "call", -1, 0, None, ""), (4, 2, "y", "call", -1, 0, None, "it's: missing"), (5, 0, "long", "call", 0, 0, None, "a: kind"), (9, 1, "call_1", "orphan", 0, 1, 1, "no call"),
    ])
    none = chat.link_tool_calls(c.limit(0), r.limit(0), schemas.limit(0))
    assert none.collect() == [] and chat.link_tool_calls(c.limit(0), r, schemas).count() == 4
    turns = spark.createDataFrame([(None, 5, "user", "a"), (5, None, "user", "b"), (7, 1, "user", None), (7, 2, None, "x"), (7, 4, "tool", "y")], "conv_id long, turn long, role string, text string")
    rows = chat.link_tool_calls(*chat.conversation_calls(turns), schemas).collect()
    assert Counter((x["conv_id"], x["turn"], x["kind"], x["n_results"]) for x in rows) == Counter([(None, 5, "call", 0), (5, None, "call", 0), (7, 1, "call", 1), (7, 4, "orphan", 1)])


def test_long_chains(spark):
    calls = spark.range(300).selectExpr("1L AS conv_id", "id AS turn", "cast(id AS string) AS call_id", "cast(id - 1 AS string) AS parent_id", "'t' AS name", "'{}' AS arguments")
    ws = chat.Workspace(spark, "t")
    depths = {int(r["call_id"]): r["depth"] for r in chat.call_depths(calls, ws).collect()}
    assert depths == {i: i for i in range(300)}


# -- 10 n-gram join -----------------------------------------------------------------------


def brute_components(texts):
    sets = []
    for _, t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for i, (doc, _) in enumerate(texts):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter((texts[i][0], len(sets[i]), least.get(find(i)) if sets[i] else texts[i][0]) for i in range(len(texts)))


def test_ngram_join(spark, docs):
    rng = np.random.default_rng(8)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    base = [f"t{i}" for i in range(120)]
    for k in range(60):  # near copies with one or two changed words
        copy = list(base)
        for p in rng.integers(0, 120, 1 + k % 2):
            copy[p] = f"c{k}p{p}"
        texts.append((10000 + k, " ".join(copy)))
    passage = [f"p{i}" for i in range(60)]
    for k in range(40):  # a passage in different documents
        own = [f"d{k}w{i}" for i in range(150)]
        texts.append((20000 + k, " ".join(own[:70] + passage + own[70:])))
    got = ngram_join.ngram_jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute_components(texts)


def test_ngram_members_that_fail_their_leader(spark):
    """Two sets of equal size and prefix, not linked to each other, that both link to a third."""
    texts = []
    for k in range(6):
        w = [f"g{k}w{i}" for i in range(9)]
        texts += [(10 * k + i, " ".join(t)) for i, t in enumerate((w[:8], w[1:], w))]
        for j in range(30):  # the first and the last shingle are frequent, so no prefix has them
            own = [f"g{k}d{j}x{i}" for i in range(12)]
            texts.append((1000 + 100 * k + j, " ".join(own[:6] + (w[:5] if j % 2 else w[4:]) + own[6:])))
    got = ngram_join.ngram_jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute_components(texts)


def test_ngram_chain_over_one_set(spark):
    """1-3 and 2-3 are linked, 1-2 is not; other texts make parts of all three frequent."""
    c, a, m = ([f"{k}{i}" for i in range(n)] for k, n in (("c", 404), ("a", 70), ("m", 70)))
    texts = [(1, " ".join(c + a)), (2, " ".join(c + m)), (3, " ".join(c + a[:35] + m[35:]))]
    for j in range(60):
        own = [f"d{j}x{i}" for i in range(40)]
        texts.append((100 + j, " ".join(own[:20] + (a if j % 2 else m) + own[20:])))
    got = ngram_join.ngram_jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute_components(texts)


def test_ngram_groups_of_equal_prefixes(spark):
    """Many sets of one size whose differences lie in frequent shingles, so that prefixes are equal."""
    rng = np.random.default_rng(17)
    blocks = [[f"b{k}w{i}" for i in range(7)] for k in range(14)]
    texts = []
    for k in range(8):
        core = [f"k{k}c{i}" for i in range(int(rng.integers(30, 45)))]
        for j in range(14):
            some = rng.choice(14, 3, replace=False)
            texts.append((1000 * k + j, " ".join(core + sum((blocks[i] for i in sorted(some)), []))))
    for j in range(200):  # texts that make the blocks frequent
        own = [f"d{j}x{i}" for i in range(30)]
        texts.append((90000 + j, " ".join(own[:15] + blocks[j % 14] + own[15:])))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    assert Counter(map(tuple, ngram_join.ngram_jaccard_components(frame).collect())) == brute_components(texts)


def test_ngram_odd(odd, empty):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert Counter(map(tuple, ngram_join.ngram_jaccard_components(odd).collect())) == brute_components(texts)
    assert ngram_join.ngram_jaccard_components(empty).collect() == []


def test_queries_keep_their_columns(spark, sf_dir):
    want = {"op4_media": ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"], "op5_language": ["doc_id", "held_out", "lang_pred", "score"], "op9_chat": ["conv_id", "turn", "json"]}
    for name, cols in want.items():
        assert set(cols) <= set(QUERIES[name](spark, sf_dir).columns)


def test_workers_get_small_batches(spark):
    """Batches of 2,048 rows at most reach the workers, and a parse of many lines stays small."""
    import tracemalloc

    import pyarrow as pa

    from terrafold.session import ROWS, ship_package

    ship_package(spark)

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows])], names=["n"])

    got = spark.range(0, 9000, 1, 1).mapInArrow(sizes, "n long").agg({"n": "max", "*": "count"}).first()
    assert got[0] <= ROWS < 10000
    line = b"the same line of words comes 12 times here\n"
    line_templates._parse(line * 100)
    tracemalloc.start()
    line_templates._lines([line * 1000] * 30)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25e6


def test_the_start_takes_every_training_text(spark, monkeypatch):
    """The rounds of the start together see each token of the training texts once."""
    seen, refit = [], hmm.Model.refit
    monkeypatch.setattr(hmm, "START_TEXTS", 1)
    monkeypatch.setattr(hmm, "PASSES", 0)
    monkeypatch.setattr(hmm.Model, "refit", staticmethod(lambda starts, moves, emits, prior: seen.append(emits.sum()) or refit(starts, moves, emits, prior)))
    docs = spark.createDataFrame([(k, " ".join(f"w{(k * j) % 23}" for j in range(1 + k % 9))) for k in range(400)], "doc_id long, text string")
    tokens = hmm.hmm_scores(docs, F.col("doc_id") % 7 != 2).first()["train_tokens"]
    assert len(seen) == hmm.START_ROUNDS and abs(sum(seen) - tokens) < 1e-6 * tokens
