"""Rule, license and rule-ensemble operators: built-in expressions only."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from adlife.llm import licenses, queries, rule_ensemble
from adlife.llm.quality_rules import RULES, apply_rules, quality_rules_query

from .conftest import SF, awkward_rows, prose


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("name", ["op1_quality_rules", "op5_license_scan"])
def test_oracle(spark, name):
    got = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(queries.ORACLE[name])
    assert sorted(rel.columns) == sorted(got.columns)
    want = {r[rel.columns.index("doc_id")]: dict(zip(rel.columns, r)) for r in rel.fetchall()}
    rows = {r["doc_id"]: r.asDict() for r in got.collect()}
    assert rows == want


def test_counts_of_awkward_and_random_texts(spark, awkward):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n\t|#é") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = quality_rules_query(awkward.select("doc_id", "text").unionByName(more)).collect()
    want = sorted((-1 if i is None else i, *counts(t))
                  for i, t in [(r[0], r[1]) for r in awkward_rows()] + [(100 + i, t) for i, t in enumerate(texts)])
    assert want == sorted((-1 if r[0] is None else r[0], *r[1:6]) for r in rows)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_rules_keep_extra_columns_and_tell_what_failed(awkward, empty):
    out = apply_rules(awkward)
    assert out.columns[:len(awkward.columns) - 1] == [c for c in awkward.columns if c != "text"]
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert out.columns[-1] == "_passes" and out.count() == len(awkward_rows())
    failed = {r["doc_id"]: r["_failed_rules"] for r in out.collect()}
    assert failed[4] == ["length", "word_length", "stop_words"] and failed[6] == []
    assert apply_rules(empty).count() == 0
    assert "Python" not in plan(out) and "Exchange" not in plan(out)


def test_clean_prose_is_kept_and_junk_is_not(spark, docs):
    junk = " ".join(f"{w}$$$" for w in prose(1, 300).split())
    df = spark.createDataFrame([(1, prose(1, 300)), (2, junk), (3, "For " * 200), (4, "short text")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in quality_rules_query(df).collect()} == {1: True, 2: False, 3: False, 4: False}
    assert [r.name for r in RULES][0] == "length"


def test_licenses_against_brute_force(spark):
    rng = random.Random(9)
    notices = [t for _, t in licenses.TEMPLATES]
    texts = [None, "", "mit license mit license", "MIT  License;\napache-license\nGNU general public license"]
    for i in range(40):
        lines = [prose(i, 30)]
        words = rng.choice(notices).split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(["the", "other", "license", "X1é"])
        rng.shuffle(words) if rng.random() < 0.3 else None
        lines.insert(rng.randint(0, 1), " ".join(words))
        texts.append("\n".join(lines))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.license_scan_query(df).collect()}
    blocks = {(r["doc_id"], r["block_no"], r["template"]) for r in licenses.license_blocks(df).collect()}
    found = set()
    for i, text in enumerate(texts):
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(label, k) for p, label in licenses.BASE_PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        best, labels = 0.0, {x for x, _ in places}
        every = {x for _, notice in licenses.TEMPLATES for x in licenses.word_set(notice)}
        by_line = [set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line)) for line in low.split("\n")]
        for n, line in enumerate(by_line):
            held = set().union(*by_line[n:n + licenses.WINDOW])
            if not line & every:                     # the window from the next line on holds as much
                continue
            for k, (label, notice) in enumerate(licenses.TEMPLATES):
                t = set(licenses.word_set(notice))
                if len(t & held) >= licenses.need(len(t), licenses.THRESHOLD):
                    found.add((i, n, k))
                    labels.add(label)
                    best = max(best, len(t & held) / len(t))
        r = rows[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(k for _, k in places), max(k for _, k in places)) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for x, _ in places})) and r["labels"] == ",".join(sorted(labels))
        assert r["score"] == pytest.approx(best)
    assert blocks == found and found


@pytest.mark.parametrize("columns", [78, 60, 40])
def test_wrapped_notices_are_found(spark, columns):
    import textwrap
    texts = [textwrap.fill(prose(k, 6).replace("\n", " ") + " " + t, columns, initial_indent="# ", subsequent_indent="# ")
             for k, (_, t) in enumerate(licenses.TEMPLATES)]
    texts = [prose(50 + k, 40) + "\n" + t + "\n" + prose(90 + k, 40) for k, t in enumerate(texts)] + [prose(200, 500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.license_scan_query(df).collect()}
    for k, (label, _) in enumerate(licenses.TEMPLATES):
        assert label in rows[k]["labels"].split(",") and rows[k]["score"] == 1.0, (k, label)
    assert rows[len(licenses.TEMPLATES)]["labels"] == ""


def test_licenses_of_awkward_tables(awkward, empty):
    assert licenses.license_scan_query(awkward).count() == len(awkward_rows())
    assert licenses.license_scan_query(empty).count() == 0
    assert licenses.license_blocks(empty).count() == 0


def test_rule_ensemble_finds_a_conjunction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, len(rule_ensemble.STATISTICS)))
    y = ((x[:, 1] > 0.5) & (x[:, 4] <= 0.3)).astype(float)
    rules, bias = rule_ensemble.fit(x[:1500], y[:1500])
    held = rule_ensemble.holds(x[1500:], [r for r, _ in rules]) @ np.array([w for _, w in rules]) + bias
    assert ((held > 0) == y[1500:]).mean() > 0.97
    assert len(rules) < rule_ensemble.MAX_RULES / 2


def test_every_path_of_the_trees_is_a_rule():
    rng = np.random.default_rng(2)
    rules = rule_ensemble.grow_rules(rng.random((3000, len(rule_ensemble.STATISTICS))), rng.integers(0, 2, 3000).astype(float))
    assert 400 < len(rules) <= rule_ensemble.MAX_RULES and len(set(rules)) == len(rules)


def test_compiled_score_equals_the_model(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    x, y = rule_ensemble.training_rows(docs, labels, "doc_id", "quality", 1000)
    assert len(x) == len(y) > 20
    model = rule_ensemble.fit(x, y)
    scored = rule_ensemble.statistics(docs, ["doc_id"]).select("stats_", rule_ensemble.compile_score(model).alias("s"))
    rows = scored.collect()
    z = rule_ensemble.holds(np.array([tuple(r["stats_"]) for r in rows]), [r for r, _ in model[0]])
    want = 1 / (1 + np.exp(-(z @ np.array([w for _, w in model[0]]) + model[1])))
    assert np.allclose([r["s"] for r in rows], want)
    assert "Python" not in plan(scored)


def test_quality_scores(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = queries.op8_quality_classifier(spark, sf).cache()
    assert out.count() == 1000 and out.where("score < 0 or score > 1 or predicted != int(score >= 0.7)").count() == 0
    held = out.where("held_out").join(labels.where("quality is not null"), "doc_id")
    assert held.where("predicted = quality").count() >= 0.95 * held.count()
    right = out.select(F.expr("held_out = (crc32(cast(cast(doc_id as string) as binary)) % 4 = 2)").alias("x"))
    assert right.where("not x").count() == 0


def test_quality_of_awkward_tables(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, None, 0), (None, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    out = rule_ensemble.quality_classifier_query(awkward, labels)
    rows = out.collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    none = labels.where("false")
    assert {r["score"] for r in rule_ensemble.quality_classifier_query(awkward, none).collect()} == {0.5}
    assert rule_ensemble.quality_classifier_query(empty, labels).count() == 0
