"""URL rules, conversation repair and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from adlife.llm import conversation_repair as C
from adlife.llm import queries
from adlife.llm import spelling as S
from adlife.llm import url_rules as U

from .conftest import SF


# -- URL rules ------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "://", "http:///x", "http://example.org", "http://EXAMPLE.org/es/A", "https://a.b.example.org/en/12?x#y",
    "http://example.org/en/2", "http://notexample.org/es/", "http://org/", "http://x.org?/es/", "ftp://x.COM/fr/a/../b", "http://com/de/",
    "http://example.org:80/es/", "http://u@example.org/es/", "http://a.casino.com/de/x", "http://a.casino.net", "http://x.net/casino/",
    "http://x.net/a/login", "http://x.net/casino-architecture/casino", "http://casino.net/casino-architecture/1", "http://x.net/a\nb.zip",
    "a://b://c.org/", "http://é.org/ü", "http://x.net/\U0001f600.exe", "http://x.net/tag/a/b/page/2", "http://x.net/" + "a/" * 4000 + "cart/1",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return host.translate(str.maketrans(U.UPPER, U.LOWER)), path


def regex(glob):
    kinds = {"any": ".*", "segment": "[^/]*", "one": "[^/]"}
    return re.compile("".join(kinds.get(kind) or re.escape(c) for kind, c in U.tokens(glob)), re.S)


def judged(url):
    host, path = parts(url)
    fits = [(len(h + p), h + p, v) for v, h, p in U.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict, None
    for v, g in U.GLOBS:
        if regex(g).fullmatch(f".{host}{path}"):
            return host, path, None, v, g
    return host, path, None, "allow" if host else "block", None


def test_url_rules_of_awkward_urls(spark):
    rng = random.Random(2)
    words = ["a", "casino", "org", "com", ".", "/", "/es/", "/de/", "?", "#", "://", "example.org", "ads-x", "login", ".zip", "é"]
    urls = URLS + ["http://" * (i % 2) + "".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for i in range(400)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] * 2 + [(None, None)], "page_id long, url string").repartition(3)
    got = sorted(map(tuple, U.url_rules_query(df).where("page_id is not null").collect()), key=str)
    assert got == sorted([(i, *judged(u)) for i, u in enumerate(urls)] * 2, key=str)


def test_shift_and_over_many_words():
    rng = random.Random(4)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "\\*", "é"]) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    globs.append("a" * 150 + "**" + "b" * 70)
    texts = ["".join(rng.choice("ab/*é\U0001f600") for _ in range(rng.randint(0, 14))) for _ in range(500)] + [
        "a" * 150 + "/x" + "b" * 70, "a" * 149 + "b" * 70, ""]
    automaton = U.ShiftAnd(globs)
    assert automaton.words > 10
    compiled = [regex(g) for g in globs]
    want = [next((k for k, r in enumerate(compiled) if r.fullmatch(t)), -1) for t in texts]
    assert automaton.first(texts).tolist() == want
    only = U.ShiftAnd(["a**b"])
    assert only.first([]).tolist() == [] and only.first(["ab", "", "a//b"]).tolist() == [0, -1, 0]


def test_url_oracle(spark):
    got = {r["page_id"]: r.asDict() for r in queries.QUERIES["op11_url_rules"](spark, SF).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    rel = con.sql(queries.ORACLE["op11_url_rules"])
    assert got == {r[0]: dict(zip(rel.columns, r)) for r in rel.fetchall()}


def test_url_rules_keep_clashing_columns(spark):
    df = spark.createDataFrame([("h", "http://a.org/", 1)], "host string, url string, Rule int")
    out = U.judge_urls(df)
    assert out.columns == ["host", "url", "Rule", "_host", "path", "_rule", "verdict", "glob"]
    assert out.collect()[0][3:6] == ("a.org", "/", "org/")
    assert U.judge_urls(df.limit(0)).count() == 0
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


# -- conversation repair ----------------------------------------------------------

def cheapest(rows):
    """(cost, audit, repaired rows) over all edit sequences, by a forward table of (cost, audit) per state."""
    def inserted(best):
        for _ in range(4):
            for p, (cost, audit, done) in list(best.items()):
                role, q = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}[p]
                new = (cost + 3, audit + "I", done + [(role, "")])
                if q not in best or new < best[q]:
                    best[q] = new
        return best
    follow = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = inserted({0: (0, "", [])})
    for role, text, fault in rows:
        new = {}
        for p, (cost, audit, done) in best.items():
            moves = [(4, "D", p, [])]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                moves += [(more + 3 * (name != "K"), name[0], follow.get((p, r[:1])), [(r, text)])
                          for name, r in (("K", role), ("Ru", "user"), ("Ra", "assistant"))]
            for extra, letter, q, line in moves:
                if q is not None:
                    option = (cost + extra, audit + letter, done + line)
                    if q not in new or option < new[q]:
                        new[q] = option
        best = inserted(new)
    return min(best[p] for p in (0, 3) if p in best)


def digest(conv, rows):
    """rows: (turn, role, text) as given; the whole contract of the query, row by row."""
    kept = []
    for turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in kept:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in kept if t is not None}
    cost, audit, repaired = cheapest([(r, t, f) for (_, r, t), f in zip(kept, faults)])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
    n = Counter(faults)
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal,
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())


def by_conversation(rows):
    held = defaultdict(list)
    for conv, *rest in rows:
        held[conv].append(tuple(rest))
    return sorted((digest(c, r) for c, r in held.items()), key=str)


def test_block_tables_against_all_sequences():
    tables, rng = C.BlockTables(), random.Random(1)
    named = {0: "system", 1: "user", 2: "assistant", 3: "tool"}
    for _ in range(3000):
        rows = [(rng.choice([0, 1, 1, 1, 2, 2, 2, 3]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 13))]
        cost, tokens = tables.solve(np.array([C.symbol(*r) for r in rows]))
        want = cheapest([(named[r], "x", C.FAULTS[f]) for r, f in rows])
        assert (cost, "".join(tokens).translate(str.maketrans("uaUA", "RRII"))) == want[:2]
    assert tables.solve(np.array([], np.int64)) == (0, [])
    assert len(tables.vectors) < 64 and len(tables.to) == C.SYMBOLS ** C.BLOCK


def test_repair_query_of_the_given_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    got = sorted(map(tuple, queries.QUERIES["op12_conversation_repair"](spark, SF).collect()), key=str)
    assert got == by_conversation(map(tuple, df.select("conv_id", "turn", "role", "text").collect()))


def test_repair_query_of_awkward_rows(spark):
    rng = random.Random(5)
    texts = ["a.", "b", "c!", "", " \t\n", None, "long " * 20_000 + ".", "d? ", "e\x1c", "\U0001f600."]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", "tool", "", None, "agent"]),
             rng.choice(texts)) for _ in range(500)]
    rows += [(100, t, ("user", "assistant")[t % 2], f"row {t}.") for t in range(700)] + [(101, 5, "user", "same.")] * 300
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.select("*", *[F.lit(1).alias(c) for c in ("at", "n", "tokens", "fault", "edit", "h", "step", "digest", "first")])
    got = sorted(map(tuple, C.conversation_repair_query(df).collect()), key=str)
    assert got == by_conversation(rows)
    assert C.conversation_repair_query(df.limit(0)).count() == 0


def test_repaired_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "q."), (1, 1, "user", "r."), (1, 2, "assistant", " "), (1, 3, "user", "q."), (1, 4, "assistant", "cut")],
                               "conv_id long, turn long, role string, text string")
    out = C.repair(df).orderBy("at", "step").collect()
    assert [(r["edit"], r["fault"], r["turn"], r["role"], r["text"]) for r in out] == [
        ("K", "", 0, "user", "q."), ("I", None, None, "assistant", ""), ("K", "", 1, "user", "r."), ("D", "blank", 2, None, None),
        ("D", "duplicate", 3, None, None), ("K", "truncated", 4, "assistant", "cut")]


# -- spelling -----------------------------------------------------------------------

def near(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def variants(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(str.maketrans(U.UPPER, U.LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    by_rest, close = defaultdict(set), defaultdict(set)
    for w in n:
        for rest in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_rest[rest].add(w)
    for words in by_rest.values():
        for u in words:
            close[u].update(v for v in words if near(u, v))
    form = {}
    for w in n:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(close[w]), n.get(form.get(w))))
    return sorted(out)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_acceptor_pairs():
    rng = random.Random(3)
    for _ in range(800):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 30))})
        got = sorted(tuple(sorted(p)) for p in S.Acceptor(words).pairs())
        assert got == [(u, v) for i, u in enumerate(words) for v in words[i + 1:] if near(u, v)]


def test_acceptor_is_minimal():
    a = S.Acceptor(sorted(x + y + "ing" for x in "abcdef" for y in "ghijk"))
    reached, todo = {0}, [0]
    while todo:
        for q in a.arcs[todo.pop()].values():
            if q not in reached:
                reached.add(q)
                todo.append(q)
    assert len(reached) == 6
    long = "ab" * 10_000
    assert list(S.Acceptor(sorted([long, long + "c"])).pairs()) == [(long + "c", long)]


@pytest.mark.parametrize("group_words", [S.GROUP_WORDS, 1, 20])
def test_variants_of_the_given_table(spark, docs, group_words):
    got = sorted(map(tuple, S.spelling_variants(docs, group_words=group_words).select(*COLUMNS).collect()))
    assert got == variants(map(tuple, docs.select("doc_id", "text").collect()))
    assert any(r[1] for r in got)


def test_variants_of_awkward_texts(spark, awkward, empty):
    long = "xyzzyq" * 3000
    rows = [(i, " ".join(["Ünïcode×÷ ÀÿÀÿÀÿ", "ABCDEF abcdef ABCDEFG", long, long[:-1], "wordone wordtwo", "aaaaaaa aaaaaaaa aaaaaa", "漢字abcdefg漢"] * k))
            for i, k in enumerate([1, 2, 3, 4, 0, 9])] + [(None, "abcdef wordone " * 40), (7, None), (8, "bbcdef wordon wordonee\nwordons " * 5)]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string")
    df = awkward.select("doc_id", "text").unionByName(df).select("*", *[F.lit(1).alias(c) for c in ("n", "word", "run", "h", "id", "m", "part")])
    want = variants(map(tuple, df.select("doc_id", "text").collect()))
    assert any(r[1] and r[2] != r[1] or r[4] > 2 for r in want)
    for size in (S.GROUP_WORDS, 2):
        assert sorted(map(tuple, S.spelling_variants(df, group_words=size).select(*COLUMNS).collect())) == want
    assert S.spelling_query(empty).collect() == []
