"""Language identification, mixing, packing, nearest neighbours, token planes, and the pipeline."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adlife.llm import ann, langid, mixing, packing, queries, token_planes

from .conftest import COLUMNS, SF, awkward_rows, prose

TOKENIZER = queries.tokenizer_file()


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op4_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out and lang is not null").collect()
    assert len(held) > 150 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert not any(r["rejected"] for r in held) and all(0 <= r["score"] <= 1 for r in held)


def test_language_rejection_and_unknown(spark):
    model = langid.learned(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    texts = ["".join(chr(0x4E00 + i * i % 2003) for i in range(900)), "12 !!", None, "the of and to is was with that this for"]
    names, score, rejected = langid.predict(model, texts)
    assert names[1:3] == ["und", "und"] and names[0] in model.languages and names[3] == "en"
    assert list(rejected) == [True, True, True, False] and score[1] == 0
    assert langid.predict(None, ["text"])[0] == ["und"]


def test_language_of_small_classes(docs):
    """A size class without enough training texts is bounded like the nearest that has them: foreign texts go."""
    model = langid.learned(docs)
    assert (model.bounds < 1).all()
    foreign = ["Съешь же ещё этих мягких французских булок, да выпей чаю", "Широкая электрификация южных губерний даст мощный толчок " * 20,
               "いろはにほへと ちりぬるを わかよたれそ つねならむ"]
    assert langid.predict(model, foreign)[2].all()
    labelled = docs.where("lang is not null and text is not null").collect()
    rejected = langid.predict(model, [r["text"] for r in labelled])[2]
    assert not rejected.any()


def test_nearest_centroid_by_brute_force(docs):
    model = langid.learned(docs)
    texts = [r["text"] for r in docs.limit(40).collect()] + ["ein kurzer satz", "", None, "12"]

    def one(text):
        low = [c if c.isalpha() else " " for c in (text or "").lower()]
        line = " " + " ".join("".join(low).split()) + " "
        if not line.strip():
            return "und", 0.0
        n = np.zeros(langid.DIMS)
        for size in (2, 3):
            for i in range(len(line) - size + 1):
                h = 0
                for k, c in enumerate(line[i:i + size]):
                    h = (h * 0x1F35B9 + ord(c)) % 2 ** 64 if k else ord(c)
                h = (h + 1) % 2 ** 64 if size == 3 else h
                n[(h * 0x9E3779B97F4A7C15 % 2 ** 64) >> 52] += 1
        v = np.array([(1 + np.log(x)) * w if x else 0.0 for x, w in zip(n, model.idf.astype(float))])
        cos = [float(v @ c) / np.sqrt(v @ v) for c in model.centroids.astype(float)]
        return model.languages[int(np.argmax(cos))], max(cos)
    names, score, _ = langid.predict(model, texts)
    for t, name, s in zip(texts, names, score):
        want = one(t)
        assert name == want[0] and s == pytest.approx(max(want[1], 0), abs=1e-5)


def test_language_of_awkward_tables(awkward, empty, docs):
    model = langid.learned(docs)
    out = langid.identify(awkward, model)
    assert out.columns == [*awkward.columns, "_lang_pred", "_score", "_rejected"]
    rows = out.collect()
    assert len(rows) == len(awkward_rows())
    und = {r["doc_id"] for r in rows if r["_lang_pred"] == "und"}
    assert und == {3, 4, 5, 9, None}
    assert langid.identify(empty, model).count() == 0 and langid.learned(empty) is None
    assert langid.langid_query(empty).count() == 0
    assert {r["lang_pred"] for r in langid.langid_query(awkward.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_memberships_are_soft(docs):
    model = mixing.trained(docs, ["de", "en", "es", "fr"])
    rows = docs.where("n_chars > 2500").collect()
    en = next(r["text"] for r in rows if r["lang"] == "en")[:2048]
    fr = next(r["text"] for r in rows if r["lang"] == "fr")[:2048]
    tokens, p = mixing.memberships(model, [en, fr, en + " " + fr, None, ""])
    assert p[0][1] > 0.9 and p[1][3] > 0.9 and 0.25 < p[2][1] < 0.75 and 0.25 < p[2][3] < 0.75
    assert list(p[3]) == list(p[4]) == [0.25] * 4 and tokens[3] == 0 and tokens[0] == len(en.split())
    assert np.allclose(p.sum(axis=1), 1)


@pytest.mark.parametrize("low", [0.0, 1.0])
def test_rates_meet_the_targets(spark, low):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    t = rng.integers(0, 500, 400)
    table = spark.createDataFrame([(i, int(t[i]), [float(x) for x in p[i]]) for i in range(400)], "id long, tokens long, p array<double>")
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    total = None if low else float(t.sum())
    rates, report = mixing.fit_rates(table, list("abc"), weights, total=total, low=low)
    rows = mixing.rated(table, list("abc"), rates).collect()
    r = np.array([x["rate"] for x in sorted(rows, key=lambda x: x["id"])])
    assert (r >= low).all() and np.allclose(r, rates.of(p))
    got = (r * t) @ p
    if low == 0:
        assert np.allclose(got / got.sum(), [0.5, 0.3, 0.2], atol=1e-3) and got.sum() == pytest.approx(t.sum(), rel=1e-3)
    # the same least squares by brute force: many small projected steps
    target = np.array([report[d][1] for d in "abc"])
    x = np.ones(400)
    step = 0.5 / np.linalg.eigvalsh((p.T * t) @ p / np.sqrt(target[:, None] * target[None, :])).max()
    for _ in range(60_000):
        x = np.maximum(x - step * (p @ (((x * t) @ p - target) / target)), low)
    assert np.allclose((x * t) @ p, got, rtol=1e-3)
    assert abs(np.mean([x["copies"] for x in rows]) - r.mean()) < 0.15


def test_rare_domains_meet_their_targets(spark):
    rng = np.random.default_rng(8)
    n = 4000
    p = rng.exponential(0.002, (n, 3))
    p[np.arange(n), np.where(np.arange(n) < 4, 1 + np.arange(n) % 2, 0)] = 1
    p /= p.sum(axis=1, keepdims=True)
    t = rng.integers(50, 900, n)
    table = spark.createDataFrame([(i, int(t[i]), p[i].tolist()) for i in range(n)], "id long, tokens long, p array<double>")
    rates, report = mixing.fit_rates(table, list("abc"), {"a": 0.4, "b": 0.4, "c": 0.2}, total=float(t.sum()))
    got = (rates.of(p) * t) @ p
    assert rates.met and np.allclose(got, np.array([0.4, 0.4, 0.2]) * t.sum(), rtol=1e-4)
    with pytest.warns(UserWarning, match="cannot be met"):
        rates, report = mixing.fit_rates(table, list("abc"), {"a": 0.4, "b": 0.4, "c": 0.2}, total=float(t.sum()), high=3.0)
    assert not rates.met and report["b"][2] < 0.5 * report["b"][1]


def test_mixing_of_awkward_tables(awkward, empty, docs):
    rows = mixing.mixing_query(awkward).collect()
    assert len(rows) == len(awkward_rows()) and all(r["rate"] >= 0 and r["copies"] >= 0 for r in rows)
    assert len({r["rate"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert mixing.mixing_query(empty).count() == 0
    model = mixing.trained(docs, ["en", "fr"])
    twice = mixing.apply_rates(awkward, model, mixing.Rates(low=2.0, high=2.0))
    assert twice.columns == awkward.columns and twice.count() == 2 * len(awkward_rows())


def test_boundaries_are_optimal():
    rng = random.Random(5)
    for _ in range(300):
        h = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 8))}
        k, lengths = rng.randint(1, 5), sorted(h)
        options = (c for r in range(1, k + 1) for c in itertools.combinations(lengths, min(r, len(lengths))) if c[-1] == lengths[-1])
        best = min(sum(n * (min(b for b in c if b >= x) - x) for x, n in h.items()) for c in options)
        bounds, padding = packing.best_boundaries(h, k)
        assert padding == best == sum(n * (min(b for b in bounds if b >= x) - x) for x, n in h.items()) and len(bounds) <= k
    assert packing.best_boundaries({}, 4) == ([], 0)


def test_packing_places_every_segment(spark):
    rng = random.Random(6)
    lengths = [(i, rng.choice([0, rng.randint(1, 90), rng.randint(1, 700)])) for i in range(900)] + [(5, 40), (5, 40), (None, 30), (901, 5000)]
    out = packing.pack(spark.createDataFrame(lengths, "id long, n_tokens long"), 128, 6, 1024, 50).collect()
    assert sum(r["n_tokens"] for r in out) == sum(n for _, n in lengths)
    full = [r for r in out if r["n_tokens"]]
    assert len({r["bucket_length"] for r in full}) <= 6 and all(r["n_tokens"] <= r["bucket_length"] for r in full)
    assert len(out) - len(full) == sum(n == 0 for _, n in lengths)
    assert all(r["batch"] is None and r["bucket_length"] is None for r in out if not r["n_tokens"])
    for b in {r["bucket_length"] for r in full}:
        room = max(1, 1024 // b)
        places = sorted(r["batch"] * room + r["slot"] for r in full if r["bucket_length"] == b)
        assert places == list(range(len(places)))
    parts = sorted((r["segment"], r["start"], r["n_tokens"]) for r in out if r["id"] == 901)
    assert [p[1] for p in parts] == list(range(0, 5000, 128)) and sum(p[2] for p in parts) == 5000


def test_packing_of_awkward_tables(awkward, empty):
    rows = packing.packing_query(awkward, TOKENIZER).collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in awkward_rows()}
    assert packing.packing_query(empty, TOKENIZER).count() == 0


def brute(ids, x, k, q):
    s = x @ x[q]
    order = sorted((i for i in range(len(ids)) if ids[i] != ids[q]), key=lambda i: (-s[i], ids[i]))
    return [ids[i] for i in order[:k]]


@pytest.mark.parametrize("scale", [False, True])
def test_neighbours_against_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((40, 24))[rng.integers(0, 40, 3000)] + 0.25 * rng.standard_normal((3000, 24))
    x = x * rng.uniform(0.2, 3, (3000, 1)) if scale else x / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(3000)], "vec_id long, embedding array<double>")
    rows = ann.nearest(df, F.col("vec_id") % 20 == 0, 20, block_rows=700).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["score"] == pytest.approx(float(x[r["query_id"]] @ x[r["vec_id"]]), abs=1e-12)
    assert set(got) == set(range(0, 3000, 20)) and all(len(v) == 20 for v in got.values())
    hits = sum(len(set(v) & set(brute(range(3000), x, 20, q))) for q, v in got.items())
    assert hits >= 0.97 * 20 * len(got)


def test_search_stops_before_all_rows():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((50, 16))[rng.integers(0, 50, 8000)] + 0.02 * rng.standard_normal((8000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    *_, verified = ann.search_block(np.arange(8000), x, np.arange(0, 8000, 100), x[::100], 20, 1.0)
    assert verified < 0.6 * 80 * 8000


def test_chi_square_is_a_distribution():
    rng = np.random.default_rng(5)
    draws = (rng.standard_normal((200_000, 8)) ** 2).sum(axis=1)
    for x in (2.0, 8.0, 20.0):
        assert ann.chi_square(x) == pytest.approx((draws <= x).mean(), abs=0.005)


def test_neighbours_with_ties_and_bad_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 300)] + [(300, [0.0, 1.0]), (301, None), (302, [0.0, 0.0]), (303, [float("nan"), 1.0]),
            (304, [1.0, None]), (305, [float("inf"), 1.0]), (306, [1.0]), (None, [1.0, 0.0]), (320, [0.5, 0.5]), (340, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(ann.nearest(df, F.col("vec_id") % 20 == 0, 20).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == {*range(0, 301, 20), 320}
    assert got[0] == list(range(1, 21)) and got[20] == list(range(20)) and got[40] == list(range(20))
    few = ann.nearest(df.where("vec_id in (0, 300, 320)"), F.col("vec_id") % 20 == 0, 20).collect()
    assert len(few) == 6 and ann.nearest(df.where("false"), F.lit(True), 20).count() == 0


def test_neighbours_of_repeated_rows(spark):
    """An id is one row: the least vector of those stored under it; repeats take no place and ask no second time."""
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)]
    more = rows + [(20, rows[20][1]), (21, rows[21][1]), (40, [9.0, 9.0, 9.0]), (3, rows[3][1])]
    one = sorted(map(tuple, ann.ann_query(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    got = sorted(map(tuple, ann.ann_query(spark.createDataFrame(more, "vec_id long, embedding array<double>")).collect()))
    assert got == one and len(got) == 60
    for q in (0, 20, 40):
        assert len({r[2] for r in got if r[0] == q}) == 20


@pytest.mark.parametrize("bits", [8, 1])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(6)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
        assert (token_planes.from_planes(token_planes.to_planes(ids, bits), n, bits) == ids).all()
    row = token_planes._chunk_row(0, 0, [4, 5], [70_000, 3], np.arange(70_003, dtype="<u4").tobytes(), bits)
    raw = np.arange(70_003, dtype="<u4").tobytes()
    assert list(token_planes.decode_documents(row)) == [
        (4, 0, 70_000, zlib.crc32(raw[:280_000])), (5, 70_000, 3, zlib.crc32(raw[280_000:]))]


def test_encoder_equals_the_library():
    enc = token_planes.Encoder(TOKENIZER)
    rng = random.Random(7)
    letters = "ab 's'll \n\n\t  É.,!9漢\x1c\xa0　ßß$×\x85​"
    texts = ["".join(rng.choice(letters) if rng.random() < 0.96 else "<|endoftext|>" for _ in range(rng.randint(0, 16))) for _ in range(4000)]
    texts += [r[1] or "" for r in awkward_rows()]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want and enc.encode(texts[::-1]) == want[::-1]


def test_words_at_line_ends_are_learned_once():
    """What stands before and after a line end are parts of their own: words that meet there anew are known."""
    enc = token_planes.Encoder(TOKENIZER)
    words = sorted(set(prose(4, 60).split()))
    enc.encode([" ".join(["x", *words]), "x" + "".join(f"\n{w}" for w in words)])
    known = len(enc.spaced), len(enc.bare)
    texts = ["x " + "\n".join(random.Random(k).sample(words, 30)) for k in range(20)]
    texts += ["a.\nB", "a\n\nB", "a \nB", "a\n B", "a\n", "\na", "a\r\nb", "漢\nb", "b\n漢 c", "a\n's b\n1", "a.\n\u0301b", "\n \n"]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts[:20]) == want[:20] and (len(enc.spaced), len(enc.bare)) == known
    assert enc.encode(texts) == want


class Counting:
    """A tokenizer that adds up the characters it is given."""

    def __init__(self, inner):
        self.inner, self.characters = inner, 0

    def encode_batch_fast(self, texts, **options):
        self.characters += sum(map(len, texts))
        return self.inner.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("kind", [token_planes.Encoder, token_planes.TokenCounter])
def test_new_words_are_not_cut_into_pre_tokens_again(kind):
    """Words of Latin letters, numbers and punctuation behind them are pre-tokens: the model alone gets them, once."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeéñüſ", k=7)) for _ in range(500)] + [str(k) for k in range(100, 150)]
    texts = [" ".join(w + rng.choice(["", "", ",", ".", "'\""]) for w in rng.sample(words, 200)) + "\nEnd." for _ in range(30)]
    want = [e.ids for e in kind(TOKENIZER).tokenizer.encode_batch(texts, add_special_tokens=False)]
    want = list(map(len, want)) if kind is token_planes.TokenCounter else [np.array(i, dtype="<u4").tobytes() for i in want]
    enc = kind(TOKENIZER)
    enc.tokenizer, enc.pieces = Counting(enc.tokenizer), Counting(getattr(enc, "pieces", None))
    assert enc.encode(texts) == want
    assert enc.tokenizer.characters < sum(map(len, texts)) / 50            # the first words and the punctuation
    once = enc.pieces.characters
    assert once < sum(len(p) + 4 for p in enc.spaced)
    assert enc.encode(texts[::-1]) == want[::-1] and enc.pieces.characters == once


def test_frequent_parts_stay_however_long():
    enc = token_planes.Encoder(TOKENIZER)
    often = ["incomprehensibilities", "responsibilities,", "internationalisation"]
    for k in range(20):
        enc.encode([f"x {' '.join(often)} a{k} b{k} c{k}"])
    before = len(enc.spaced)
    enc._forget()
    assert len(enc.spaced) <= before // 2 and set(often) <= set(enc.spaced)
    text = f"x {' '.join(often)} a1 new"
    assert enc.encode([text]) == [np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()]


def stored_ids(rows):
    enc = token_planes.Encoder(TOKENIZER)
    at = 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        yield i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)


def test_token_files(spark, docs):
    got = queries.op9_token_planes(spark, SF).collect()
    want = list(stored_ids([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("bits", [8, 1])
def test_token_files_of_awkward_tables(spark, awkward, empty, workdir, bits):
    token_planes.write_ids(awkward, f"{workdir}/a", TOKENIZER, plane_bits=bits)
    got = [tuple(r) for r in token_planes.read_ids(spark, f"{workdir}/a").collect()]
    want = list(stored_ids([(r[0], r[1]) for r in awkward_rows()]))
    order = lambda rows: sorted(rows, key=lambda r: r[1])
    assert order(got) == order(want)
    token_planes.write_ids(empty, f"{workdir}/b", TOKENIZER)
    assert token_planes.read_ids(spark, f"{workdir}/b").count() == 0


def test_pipeline_stages(spark, docs, workdir):
    n = []
    frame = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, SF).write.parquet(f"{workdir}/{k}")
        frame = spark.read.parquet(f"{workdir}/{k}")
        n.append(frame.count())
        if k < 4:
            assert frame.columns == docs.columns, name
            assert frame.where("n_chars != length(text)").count() == 0
    assert n[0] == docs.where("lang is not null").count() and n[1] < n[0] and n[2] == n[1] <= n[3]
    ids = {r["doc_id"] for r in spark.read.parquet(f"{workdir}/2").select("doc_id").collect()}
    assert ids == {r["doc_id"] for r in frame.select("doc_id").distinct().collect()}


@pytest.mark.parametrize("k", range(5))
def test_stages_of_awkward_tables(spark, awkward, empty, k):
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, awkward, SF)
    if k < 4:
        assert out.columns == awkward.columns
        assert out.schema.simpleString() == awkward.schema.simpleString()
    rows = out.collect()
    ids = {r["doc_id"] for r in rows}
    if k == 0:
        assert {1, 2, 6, 8, 10, 12} <= ids and not ids & {3, 4, 5, 9}
    if k == 1:
        assert 2 not in ids and sum(r["doc_id"] == 1 for r in rows) == 1 and {3, 4, 5, 6, 8, 10, 12} <= ids
    if k == 2:
        assert 2 not in ids and {1, 3, 4, 6, 12} <= ids
    if k >= 3:
        assert ids == {r[0] for r in awkward_rows()}
    none = stage(spark, empty, SF)
    assert none.count() == 0 and none.columns == out.columns


def test_run_equals_the_stages(spark, docs, workdir):
    frame = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, SF).write.parquet(f"{workdir}/{k}")
        frame = spark.read.parquet(f"{workdir}/{k}")
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "segment", "bucket_length", "batch", "slot"} <= set(out.columns) and COLUMNS
    got, want = sorted(map(tuple, out.collect()), key=str), sorted(map(tuple, frame.collect()), key=str)
    assert got == want and len(got) > 100


def test_token_counter_counts_what_the_encoder_encodes():
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["", " ", "\n", "word", " lead", "tail ", "two  blanks", "a\nb\n\nc", "x.y, z!\n (q)", "tab\there", "Grüße — “quoted” 12 34", "line \n end\n",
             "<|endoftext|> in text", "many words " * 50, " no break  blank", "漢字 and 🙂"]
    for rest in (token_planes.Encoder, token_planes.TokenCounter):
        assert rest(path).encode([]) == []
    enc, counter = token_planes.Encoder(path), token_planes.TokenCounter(path)
    for some in (texts, texts[::-1], texts[:5] + [f"{t} {t}" for t in texts]):
        want = [len(enc.tokenizer.encode(t, add_special_tokens=False).ids) for t in some]
        assert counter.encode(some) == want == [len(ids) // 4 for ids in enc.encode(some)]
    counter._forget()
    assert counter.encode(texts) == [len(ids) // 4 for ids in enc.encode(texts)]
    assert counter.held < enc.held                                   # what it remembers of a part is smaller


def test_models_are_fitted_in_little_space():
    import tracemalloc
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.4, (2000, langid.DIMS)).astype(np.float32)
    labels = [("de", "en", "es", "fr")[i % 4] for i in range(len(counts))]
    idf = np.ones(langid.DIMS, np.float32)
    whole = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    assert (langid.unit_rows(counts, idf) == whole / np.maximum(np.linalg.norm(whole, axis=1, keepdims=True), 1e-12)).all()
    del whole
    tracemalloc.start()
    model = langid.fit(labels, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.centroids) == 4 * langid.CENTROIDS
    assert peak < counts.nbytes                                      # not several more tables of that size
