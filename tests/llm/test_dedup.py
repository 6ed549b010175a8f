"""Near duplicates and repeated passages against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from adlife.llm import bagminhash as B
from adlife.llm import unit_dedup as U
from adlife.llm.components import components

from .conftest import awkward_rows, prose


def bag(text):
    w = (text or "").lower().replace("\t", " ").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def classes(rows, least=0.8):
    """id -> least id of its class, by comparing all pairs."""
    bags, root = [(i, bag(t)) for i, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(bags)):
        for j in range(i):
            a, b = bags[i][1], bags[j][1]
            if a and b and sum((a & b).values()) >= least * sum((a | b).values()):
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = {}
    for i in range(len(bags)):
        out.setdefault(find(i), []).append(i)
    return [(rows[i][0], min(rows[k][0] for k in out[find(i)])) for i in range(len(rows))]


def edited(text, rate, seed):
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(999)}" if rng.random() < rate else w for w in text.split(" "))


def test_signatures_estimate_weighted_jaccard():
    base = "one river two mills three dogs and four cats went to the sea one day to swim "
    texts = [base * 5, base * 3 + "and then something else happened that nobody had seen before in that town",
             " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(40, 330))]
    doc, run, count, _ = B.bags(texts)
    sig = B.signatures(doc, run, count, 4, 4000)
    for a, b in ((0, 1), (2, 3)):
        x, y = bag(texts[a]), bag(texts[b])
        want = sum((x & y).values()) / sum((x | y).values())
        assert (sig[a] == sig[b]).mean() == pytest.approx(want, abs=0.035)
    assert (sig[0] == sig[2]).mean() == 0


def test_signatures_do_not_depend_on_the_batch():
    texts = [prose(i, 30 + 20 * i) for i in range(8)] + ["a b", "", "x " * 500]
    doc, run, count, _ = B.bags(texts)
    whole = B.signatures(doc, run, count, len(texts), 40)
    for i, t in enumerate(texts):
        doc, run, count, _ = B.bags([t])
        assert (B.signatures(doc, run, count, 1, 40)[0] == whole[i]).all()


def test_near_duplicates_against_all_pairs(spark):
    rows, n = [], 0
    for family in range(12):
        base = prose(family, 150 + 20 * family)
        for k in range(9):
            rows.append((n, base if k < 3 else edited(base, 0.012 * k, 100 * family + k)))
            n += 1
    rows += [(n + i, t) for i, t in enumerate(["", None, "  ", "two words", "Two  words", "one two three four five six"])]
    random.Random(1).shuffle(rows)
    got = B.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in got) == sorted(classes(rows))


def test_large_group_of_copies(spark):
    base = prose(77, 200)
    rows = [(i, base) for i in range(600)] + [(600 + i, edited(base, 0.01, i)) for i in range(200)] + [(900, prose(78, 200))]
    got = {r["doc_id"]: r["class_id"] for r in B.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(classes(rows[:1] + rows[600:])) | {i: 0 for i in range(600)}


def test_one_row_of_every_class_stays(spark):
    """Rows that share an id, or have none, are judged by their own texts."""
    a, b, c = prose(1, 150), prose(2, 150), prose(3, 150)
    rows = [(5, a, "x"), (5, b, "x"), (None, c, "x"), (None, prose(4, 150), "x"), (None, c + " and one more", "x"), (3, edited(b, 0.01, 2), "x"),
            (7, a, "y"), (7, a, "y"), (8, None, "z"), (8, None, "z"), (9, "", "z"), (None, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, raw string")
    out = sorted(map(tuple, B.one_per_class(df).collect()), key=str)
    assert df.columns == B.one_per_class(df).columns
    # class of a: id 5; of b: id 3; of c: one of the two rows without an id, the other stays out
    assert [r for r in out if r[0] is not None] == [(3, rows[5][1], "x"), (5, a, "x"), (8, None, "z"), (9, "", "z")]
    none = [r[1] for r in out if r[0] is None]
    assert len(none) == 3 and None in none and prose(4, 150) in none and len({c, rows[4][1]} & set(none)) == 1


def test_rounds_join_a_group_without_its_pairs(spark, monkeypatch):
    """Copies with so many edits that about half of their pairs are linked: joining them makes no quadratic number of pairs."""
    base = prose(11, 300).replace("\n", " ")
    rows = [(i, edited(base, 0.0125, 500 + i)) for i in range(120)]
    made, verified = [], B.verified
    monkeypatch.setattr(B, "verified", lambda pairs, least: made.append(pairs.count()) or verified(pairs, least))
    got = B.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r[0], r[1]) for r in got) == sorted(classes(rows))
    assert len(made) > 1 and sum(made) < 120 * 119 / 2 / 3


def test_near_duplicates_of_awkward_tables(awkward, empty):
    rows = B.near_duplicates(awkward).collect()
    assert len(rows) == len(awkward_rows())
    got = {r["doc_id"]: r["class_id"] for r in rows if r["doc_id"] is not None}
    assert got == {1: 1, 2: 1, **{i: i for i in (3, 4, 5, 6, 8, 9, 10, 11, 12)}}
    assert B.near_duplicates(empty).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    root = list(range(500))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def cleaned(rows):
    keeper, out = {}, {}
    for i, t in sorted(rows, key=lambda r: U.NO_ID if r[0] is None else r[0]):
        for a, b in U.units(t or ""):
            d = U.unit_digest((t or "")[a:b])[0]
            if d:
                keeper.setdefault(d, i)
    for i, t in rows:
        far = {d for d in (U.unit_digest((t or "")[a:b])[0] for a, b in U.units(t or "")) if d and keeper[d] != i}
        spans, _ = U.repeated_spans(t or "", far, U.MIN_WORDS)
        out[i] = (None if t is None else U.cut(t, spans) if spans else t, spans)
    return out


def test_repeated_passages_are_cut_once_kept(spark):
    passage = prose(50, 63)
    rows = [(i, f"{prose(i, 40)}\n{passage}\n{prose(100 + i, 40)}" if i % 3 else prose(i, 90)) for i in range(1, 30)]
    rows += [(40, f"{prose(40, 33)} {passage} {prose(41, 33)}"), (41, "A short line.\n" * 2), (42, "A short line."), (43, None), (44, "")]
    got = {r["doc_id"]: r for r in U.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = cleaned(rows)
    assert {i: (r["text"], [tuple(x) for x in r["removed"]]) for i, r in got.items()} == want
    middle = passage.split("\n")[0][10:]
    assert sum(middle in (r["text"] or "") for r in got.values()) == 1 and middle in got[1]["text"]
    for i, t in rows:
        for a, b in want[i][1]:
            assert t[a:b].strip() and i != 1
        if i % 3 == 0 and i < 30:
            assert got[i]["text"] == t and not got[i]["removed"]


def test_passages_inside_units_are_cut(spark):
    """Lower-case passages without marks that begin and end mid-sentence."""
    def plain(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("bdfglmnprstvaeiou") for _ in range(rng.randint(3, 9))) for _ in range(n))

    rows, passages = [], [plain(900 + k, 50 + 5 * k) for k in range(6)]
    passages[5] = plain(905, 25) + ". Only " + plain(906, 25)
    for k, passage in enumerate(passages):
        rows += [(10 * k + j, f"{plain(20 * k + j, 30 + j)} {passage} {plain(500 + 20 * k + j, 35 + j)}.") for j in range(4)]
    got = {r["doc_id"]: r for r in U.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        passage = passages[i // 10]
        cut_out = [text[a:b] for a, b in got[i]["removed"]]
        assert cut_out == ([] if i % 10 == 0 else [passage])
        assert got[i]["text"] == (text if i % 10 == 0 else text.replace(passage + " ", ""))


def test_repeated_lines_are_cut_between_other_text(spark):
    shared = ["Read more about our new offers", "New York Times and the Anna Smith Show.", "see also the notes"]
    other = "Anna Smith and the New York Offers"
    rows = [(i, "\n".join([prose(i, 30), shared[i % 3], prose(100 + i, 40), shared[(i + 1) % 3], f"Yes {i}"])) for i in range(12)]
    rows.append((50, f"{prose(50, 30)}\nYes\n{other}\n{prose(51, 30)} {shared[0]} {prose(52, 30)}"))
    got = {r["doc_id"]: r for r in U.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kept = [line for i in range(12) for line in got[i]["text"].split("\n") if line in shared]
    assert sorted(kept) == sorted(shared)
    assert got[50]["text"] == rows[-1][1]
    for i in range(2, 12):
        assert got[i]["text"] == "\n".join([prose(i, 30), prose(100 + i, 40), f"Yes {i}"])


def test_units_cover_the_text():
    for seed in range(20):
        rng = random.Random(seed)
        text = "".join(rng.choice("ab. \n!ÄB") for _ in range(200))
        spans = list(U.units(text))
        assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        assert "".join(text[a:b] for a, b in spans).replace(" ", "").replace("\n", "") == text.replace(" ", "").replace("\n", "")


def test_repeats_in_awkward_tables(awkward, empty):
    out = U.remove_repeats(awkward)
    assert out.columns[:len(awkward.columns)] == awkward.columns and out.columns[-2:] == ["_removed", "_n_units"]
    rows = out.collect()
    assert len(rows) == len(awkward_rows())
    text = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    assert text[1] and text[2] == "" and text[3] is None and text[4] == ""
    assert U.remove_repeats(empty).count() == 0
    assert np.isfinite(U.NO_ID)


def test_unit_dedup_deals_texts_once_and_leaves_no_shuffle_files(spark):
    """Both passes over the texts read one shuffle; what a written table shuffled goes with its query."""
    from adlife.llm import common, unit_dedup
    line = "one line of words that several documents have, long enough to be cut from all but the first of them at once"
    docs = spark.createDataFrame([(i, f"Alone {i} here.\n{line}\nAnd {i} again.") for i in range(40)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = unit_dedup.unit_dedup_query(docs)
        assert sum(r.removed_chars > 0 for r in done.collect()) == 39
        done = unit_dedup.remove_repeats(docs)
        done.collect()
        assert "ReusedExchange" in done._jdf.queryExecution().executedPlan().toString()
        held = spark.createDataFrame([(i, i * 7919, -i) for i in range(2000)], "id long, d1 long, d2 long")
        keepers = held.where("id % 9 = 0").selectExpr("d1", "d2", "id AS keeper")
        for most in (unit_dedup.MOST_BITS, 64):                    # a full map lets all pass, but loses none
            left = {r.id for r in unit_dedup.perhaps_shared(held, keepers, most).collect()}
            assert left >= set(range(0, 2000, 9)) and (most == 64 or len(left) < 600)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    before = spark.conf.get(common.CLEANUP)
    with common._shuffles_dropped(spark):
        assert spark.conf.get(common.CLEANUP) == "true"
    assert spark.conf.get(common.CLEANUP) == before


def test_units_are_cut_at_blanks_as_by_the_whole_rule():
    """The search that starts at blanks cuts as the rule for all marks does, and a unit's digest serves its line."""
    rnd = random.Random(9)
    bits = ["a", "Z", "É", ".", "!", "…", " ", "  ", "\n", " \n", "\t", " ", "\x1c", "\x85", "\r\n", "word ", "Und ", "x y z ", "-", "7"]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 120)))
        assert [m.span() for m in U._BLANK_CUT.finditer(text)] == [m.span() for m in U._CUT.finditer(text)], text
        spans = list(U.units(text))
        known = {(a, b): U.unit_digest(text[a:b]) for a, b in spans}
        assert list(U.line_digests(text, known)) == list(U.line_digests(text)), text


def test_words_beside_a_unit_are_whole_and_nearest_first():
    text = "x" * 30 + " " + " ".join(f"W{k}," for k in range(200))
    at = text.index("W100,")
    left, right = U.beside(text, at, at + 5)
    assert left.split("\n") == [f"w{k}" for k in range(99, 99 - U.AROUND, -1)]
    assert right.split("\n") == [f"w{k}" for k in range(101, 101 + U.AROUND)]
    long = "y" * (U.REACH + 5)
    assert U.beside(f"{long} unit {long}", len(long) + 1, len(long) + 5) == ("", "")     # a word that is cut off is none
    assert U._reach(text, at, U.words_before(text, at), "w99\nw98\nother", False, at) == text.index("W98,")
    assert U._reach(text, at + 5, U.words_after(text, at + 5), "w101\nw102\nother", True, at) == text.index("W102,") + 5


def test_python_gets_few_rows_at_a_time(spark, workdir):
    """A batch of texts is held by the executor and by its worker: what is written gets it in small parts."""
    import pyarrow as pa
    from adlife.llm import common

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    before = spark.conf.get(common.BATCH_ROWS)
    rows = spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n bigint")
    got = [r["n"] for r in common.materialized(rows, "sizes", f"{workdir}/sizes").collect()]
    assert sum(got) == 5000 and max(got) <= common.MOST_ROWS and spark.conf.get(common.BATCH_ROWS) == before


def test_signing_takes_little_memory():
    import tracemalloc
    texts = [prose(k, 500) for k in range(400)]                # over 1 MB, one piece before
    tracemalloc.start()
    try:
        for part in B.pieces(texts):
            doc, run, count, digests = B.bags(texts[part])
            B.signatures(doc, run, count, len(digests), B.BANDS * B.ROWS)
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()


def test_units_of_tidy_texts_need_no_splitting():
    texts = [prose(k, 90) for k in range(6)] + ["a b", "Éa ΣΣ. B!", "", " a b", "a  b", "a \nb", "a\x1cb c", "a\xa0b", "。 foo É", "a\tb"]
    assert [U.tidy(t) for t in texts] == [True] * 9 + [False] * 7
    for t in texts:
        for a, b in U.units(t):
            assert U.unit_digest(t[a:b], U.tidy(t)) == U.unit_digest(t[a:b])
            assert U.unit_digest(t[a:b])[1] == len(t[a:b].split())


def test_listed_digests_equal_the_structs():
    import struct

    import pyarrow as pa
    kind = pa.list_(pa.struct([("d1", pa.int64()), ("d2", pa.int64()), ("left", pa.string()), ("right", pa.string())]))
    rows = [[(1, -2, "a\nb", "c"), (3, 4, None, None)], None, [], [(-5, 6, "", "x")], [(7, 8, "y", None)]]
    column = pa.array([r and [dict(zip(("d1", "d2", "left", "right"), x)) for x in r] if r is not None else None for r in rows], kind)
    want = [[(struct.pack("<qq", *x[:2]), *x[2:]) for x in r or []] for r in rows]
    assert list(U.listed_digests(column)) == want and list(U.listed_digests(column.slice(1, 3))) == want[1:4]
    assert list(U.listed_digests(column.slice(0, 0))) == []


def test_stars_need_no_round_to_see_that_nothing_changes(spark, monkeypatch):
    import adlife.llm.components as module
    written = []
    whole = module.materialized
    monkeypatch.setattr(module, "materialized", lambda df, name: written.append(name) or whole(df, name))
    star = spark.createDataFrame([(1, 2), (3, 1), (3, 1), (1, 4), (7, 8), (9, 9)], "a long, b long")
    found = {r["node"]: r["root"] for r in module.stars(star).collect()}
    assert found == {2: 1, 3: 1, 4: 1, 8: 7} and len(written) == 1
    assert {r["node"]: r["root"] for r in components(star).collect()} == {**found, 1: 1, 7: 7}
    written.clear()
    path = spark.createDataFrame([(3, 2), (2, 4), (4, 1), (5, 6)], "a long, b long")
    assert {r["node"]: r["root"] for r in module.stars(path).collect()} == {2: 1, 3: 1, 4: 1, 6: 5}
    assert len(written) <= 3
