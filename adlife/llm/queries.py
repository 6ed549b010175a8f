"""Registered queries of the corpus operators, and their DuckDB oracles."""

from __future__ import annotations

import re

from adlife.llm import common
from adlife.llm import (ann, bagminhash, conversation_repair, langid, licenses, mixing, packing, rule_ensemble, spelling,
                        token_planes, unit_dedup, url_rules)
from adlife.llm.quality_rules import RULES, quality_rules_query
from adlife.llm.textstats import STOP_WORDS


def op1_quality_rules(spark, sf_dir):
    return quality_rules_query(common.documents(spark, sf_dir))


def op2_bagminhash(spark, sf_dir):
    return bagminhash.near_duplicates(common.documents(spark, sf_dir))


def op3_mixing(spark, sf_dir):
    return mixing.mixing_query(common.documents(spark, sf_dir))


def op4_langid(spark, sf_dir):
    return langid.langid_query(common.documents(spark, sf_dir))


def op5_license_scan(spark, sf_dir):
    return licenses.license_scan_query(common.documents(spark, sf_dir))


def op6_packing(spark, sf_dir):
    return packing.packing_query(common.documents(spark, sf_dir), tokenizer_file())


def op7_ann(spark, sf_dir):
    return ann.ann_query(common.table(spark, sf_dir, "embeddings"))


def op8_quality_classifier(spark, sf_dir):
    return rule_ensemble.quality_classifier_query(common.documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op9_token_planes(spark, sf_dir):
    path = common.scratch_path(spark, "token-chunks")
    token_planes.write_ids(common.documents(spark, sf_dir), path, tokenizer_file())
    return token_planes.read_ids(spark, path)


def op10_unit_dedup(spark, sf_dir):
    return unit_dedup.unit_dedup_query(common.documents(spark, sf_dir))


def op11_url_rules(spark, sf_dir):
    return url_rules.url_rules_query(common.table(spark, sf_dir, "pages"))


def op12_conversation_repair(spark, sf_dir):
    return conversation_repair.conversation_repair_query(common.table(spark, sf_dir, "conversations"))


def op13_spelling(spark, sf_dir):
    return spelling.spelling_query(common.documents(spark, sf_dir))


def _sql_list(items) -> str:
    return "[" + ", ".join("'" + str(x).replace("'", "''") + "'" for x in items) + "]"


def _rules_sql() -> str:
    """The threshold table as DuckDB text: names of failed rules, comma-joined, in table order."""
    parts = []
    for r in RULES:
        value = f"CAST({r.numerator} AS DOUBLE)" if r.denominator is None else (
            f"CASE WHEN {r.denominator} > 0 THEN CAST({r.numerator} AS DOUBLE) / {r.denominator} ELSE 0.0 END")
        bounds = [f"({value}) < {float(r.low)!r}"] if r.low is not None else []
        bounds += [f"({value}) > {float(r.high)!r}"] if r.high is not None else []
        parts.append(f"CASE WHEN {' OR '.join(bounds)} THEN '{r.name}' END")
    return f"concat_ws(',', {', '.join(parts)})"


OP1_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM w, unnest(generate_series(1, len(w) - 2)) AS g(i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) AS BIGINT) AS n_lines,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(len(list_filter(w, lambda x: list_contains({_sql_list(STOP_WORDS)}, lower(x)))) AS BIGINT) AS n_stop_words,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (r)),
f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, {_rules_sql()} AS failed_rules FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND failed_rules = '') AS kept, failed_rules FROM f
"""

def _op5_sql() -> str:
    """Brute force: every window of lines against every template, and every word position against every phrase."""
    templates = ", ".join(
        f"('{label}', {_sql_list(words)}, {licenses.need(len(words), licenses.THRESHOLD)})"
        for label, words in ((label, licenses.word_set(t)) for label, t in licenses.TEMPLATES))
    phrases = ", ".join(f"('{label}', {_sql_list(p.split())})" for p, label in licenses.BASE_PHRASES)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{word}') AS w FROM d),
ph(label, p) AS (VALUES {phrases}),
pl AS (SELECT r, label, i - 1 AS pos FROM w, unnest(generate_series(1, len(w))) AS g(i), ph
       WHERE w[i:i + len(p) - 1] = p),
tm(label, tokens, need) AS (VALUES {templates}),
l AS (SELECT r, string_split(t, chr(10)) AS l FROM d),
b AS (SELECT r, list_distinct(regexp_extract_all(array_to_string(l[i:i + {licenses.WINDOW - 1}], chr(10)), '{word}')) AS held
      FROM l, unnest(generate_series(1, len(l))) AS g(i)),
m AS (SELECT r, label, len(list_intersect(tokens, held)) AS overlap, len(tokens) AS size FROM b, tm
      WHERE len(list_intersect(tokens, held)) >= need),
a AS (SELECT r, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(label) AS labels FROM pl GROUP BY r),
s AS (SELECT r, list(label) AS labels, max(CAST(overlap AS DOUBLE) / size) AS best FROM m GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
       CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       array_to_string(list_sort(list_distinct(coalesce(a.labels, []))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(a.labels, []), coalesce(s.labels, [])))), ',') AS labels,
       coalesce(best, 0.0) AS score
FROM w LEFT JOIN a USING (r) LEFT JOIN s USING (r)
"""


def _glob_regex(glob: str) -> str:
    kinds = {"any": ".*", "segment": "[^/]*", "one": "[^/]"}
    return "".join(kinds[kind] if kind in kinds else re.escape(c) for kind, c in url_rules.tokens(glob))


def _op11_sql() -> str:
    """Host rules by suffix and prefix tests, the longest first; globs as regular expressions, in their order."""
    rules = sorted(url_rules.HOST_RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, rules))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, rules))
    globs = [(v, g, f"regexp_full_match('.' || host || path, '{_glob_regex(g)}', 's')") for v, g in url_rules.GLOBS]
    glob = " ".join(f"WHEN {f} THEN '{g}'" for _, g, f in globs)
    judged = " ".join(f"WHEN {f} THEN '{v}'" for v, _, f in globs)
    return f"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
c AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} {judged} WHEN host = '' THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN CASE {rule} END IS NULL THEN CASE {glob} END END AS glob
FROM c
"""


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_bagminhash": op2_bagminhash,
    "op3_mixing": op3_mixing,
    "op4_langid": op4_langid,
    "op5_license_scan": op5_license_scan,
    "op6_packing": op6_packing,
    "op7_ann": op7_ann,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_token_planes": op9_token_planes,
    "op10_unit_dedup": op10_unit_dedup,
    "op11_url_rules": op11_url_rules,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_spelling": op13_spelling,
}

ORACLE = {
    "op1_quality_rules": OP1_SQL,
    "op5_license_scan": _op5_sql(),
    "op11_url_rules": _op11_sql(),
}
