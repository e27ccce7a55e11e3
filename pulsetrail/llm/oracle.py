"""SQL twins of the text queries that SQL can express, for DuckDB on the same tables. The others are trained, or follow a
tokenizer or a hash that SQL lacks; tests/llm compares those with brute force."""

from __future__ import annotations

from pulsetrail.llm import decontaminate, licenses, quality

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _items(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _ascii_words(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
            r"'[0-9a-z\x{80}-\x{10FFFF}]+')")


DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_ascii_words('text')} AS w FROM documents),
i AS (SELECT item_id, {_ascii_words('text')} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {decontaminate.WINDOW} THEN [array_to_string(w, ' ')]
          ELSE list_transform(range(1, len(w) - {decontaminate.WINDOW} + 2),
                              lambda k: array_to_string(w[k:k + {decontaminate.WINDOW - 1}], ' ')) END) AS p FROM i),
sized AS (SELECT item_id, p, len(string_split(p, ' ')) AS n FROM win),
g AS (SELECT rid, k, n, array_to_string(w[k:k + n - 1], ' ') AS p
      FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)),
hits AS (SELECT rid, k, n, item_id FROM g JOIN sized USING (p, n)),
per_word AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS pos FROM hits) GROUP BY rid),
per_item AS (SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits WHERE item_id IS NOT NULL GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(len(coalesce(ids, [])) AS BIGINT) AS n_items,
       sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per_word USING (rid) LEFT JOIN per_item USING (rid)"""


def _licenses() -> str:
    wanted = licenses.templates()
    rows = ", ".join(f"({k}, '{t.label}', {_items(t.words)}, {_items(sorted(set(t.words)))}, {t.need}, {str(t.phrase).lower()})"
                     for k, t in enumerate(wanted))
    step = licenses.STEP
    return f"""
WITH t(t, label, words, own, need, phrase) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_ascii_words('text')} AS w FROM documents),
v AS (SELECT t, unnest(own) AS word FROM t),
o AS (SELECT rid, word, i FROM (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d)
      WHERE word IN (SELECT word FROM v)),
place AS (SELECT DISTINCT rid, o.i, label FROM o JOIN d USING (rid) JOIN t ON phrase AND words[1] = o.word
          WHERE w[o.i + 1:o.i + len(words)] = words),
b AS (SELECT rid, unnest([i // {step}, i // {step} - 1]) AS b, word FROM o),
block AS (SELECT rid, b, t, count(DISTINCT word) AS n FROM b JOIN v USING (word) WHERE b >= 0 GROUP BY ALL),
notice AS (SELECT rid, label, max(n / len(own)) AS c FROM block JOIN t USING (t) WHERE NOT phrase AND n >= need GROUP BY ALL),
p AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM place GROUP BY rid),
q AS (SELECT rid, list(label) AS labels, max(c) AS c FROM notice GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, array_to_string(list_sort(coalesce(p.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(p.labels, []), coalesce(q.labels, [])))), ',') AS labels,
       CAST(greatest(coalesce(c, 0), CASE WHEN n_base > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS score
FROM d LEFT JOIN p USING (rid) LEFT JOIN q USING (rid)"""


def _quality() -> str:
    blank = r"[\x20\x09-\x0D]"
    tests = ", ".join(f"('{rule}', CAST({x} AS DOUBLE), {k})" for k, (rule, cuts) in enumerate(quality.CUTOFFS.items()) for x in cuts)
    m = (len(quality.STRATA) + 1) * sum(map(len, quality.CUTOFFS.values()))
    value = "CASE rule " + " ".join(f"WHEN '{rule}' THEN {rule}" for rule in quality.CUTOFFS) + " END"
    stratum = " + ".join(f"CAST(n_words > {limit} AS INTEGER)" for limit in quality.STRATA)
    risk = quality.RISK
    return f"""
WITH c(rule, cutoff, place) AS (VALUES {tests}),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS x,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
g AS (SELECT rid, k, array_to_string(w[k:k + 4], ' ') AS p FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS k FROM d WHERE len(w) >= 5)),
twice AS (SELECT rid, k FROM (SELECT rid, k, count(*) OVER (PARTITION BY rid, p) AS n FROM g) WHERE n > 1),
r AS (SELECT rid, count(DISTINCT i) AS n FROM (SELECT rid, unnest(range(k, k + 5)) AS i FROM twice) GROUP BY rid),
f AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(x, '{blank}+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines,
             len(list_filter(w, lambda y: length(y) <= 1)) AS n_short FROM d LEFT JOIN r USING (rid)),
s AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {stratum} AS stratum,
             n_symbols / greatest(word_chars, 1) AS symbol_rate, n_dup_lines / greatest(n_lines, 1) AS dup_line_rate,
             n_repeat_words / greatest(n_words, 1) AS repeat_rate, word_chars / greatest(n_words, 1) AS word_length,
             n_short / greatest(n_words, 1) AS short_words FROM f),
labelled AS (SELECT s.*, quality FROM s JOIN (SELECT DISTINCT doc_id, quality FROM labels WHERE quality IN (0, 1)) USING (doc_id)
             WHERE NOT base_failed),
n AS (SELECT stratum, rule, cutoff, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality = 1 AND {value} > cutoff) AS good,
             count(*) FILTER (quality = 0 AND {value} > cutoff) AS bad FROM labelled, c GROUP BY ALL),
p AS (SELECT *, CASE WHEN good > n_good * {risk} THEN 1.0 ELSE list_sum(list_transform(range(0, good + 1), lambda i:
             exp(lgamma(n_good + 1.0) - lgamma(i + 1.0) - lgamma(n_good - i + 1.0) + i * ln({risk}) + (n_good - i) * ln(1 - {risk})))) END AS p
      FROM n),
best AS (SELECT stratum, rule, max({{'gain': bad - {quality.PRICE} * good, 'cutoff': cutoff}}).cutoff AS cutoff FROM p
         WHERE p <= {quality.ERROR} / {m} AND bad - {quality.PRICE} * good > 0 GROUP BY ALL),
hit AS (SELECT rid, string_agg(rule, ',' ORDER BY place) AS rejected_by FROM s JOIN best USING (stratum)
        JOIN (SELECT DISTINCT rule, place FROM c) USING (rule) WHERE {value} > cutoff GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected_by IS NULL AS kept, coalesce(rejected_by, '') AS rejected_by
FROM s LEFT JOIN hit USING (rid)"""


SQL = {"op2_decontamination": DECONTAMINATION, "op9_licenses": _licenses(), "op10_quality": _quality()}
