"""DuckDB forms of the queries that SQL can express."""

from __future__ import annotations

import math

from cueflow.llm import quality_rules as rules
from cueflow.llm import url_filters as urls
from cueflow.llm.jaccard_join import SHINGLE
from cueflow.llm.substring_dedup import WINDOW
from cueflow.llm.suffix_dedup import LENGTH as _L
from cueflow.llm.token_counts import VOCABULARY, printable_bytes

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

SUBSTRING_DEDUP = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW}),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i+{WINDOW - 1}], ' ') ORDER BY doc_id, i) AS n FROM p),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM r WHERE n > 1),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(cut.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)"""

JACCARD_JOIN = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+{SHINGLE - 1}], ' ') AS g FROM p), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS least FROM d UNION SELECT ways.y, reach.least FROM reach JOIN ways ON ways.x = reach.doc_id)
SELECT r.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.least) AS component_id FROM reach r LEFT JOIN n USING (doc_id) GROUP BY 1, 2"""


SUFFIX_DEDUP = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
p AS (SELECT r, unnest(range(0, len(h) // 2 - {_L - 1})) AS i, h FROM d WHERE len(h) >= {2 * _L}),
k AS (SELECT r, i, md5_number(substr(h, 2 * i + 1, {2 * _L})) AS g FROM p),
again AS (SELECT r, i FROM k WHERE g IN (SELECT g FROM k GROUP BY g HAVING count(*) > 1)),
s AS (SELECT r, i, CASE WHEN i > {_L} + lag(i) OVER w THEN 1 ELSE 0 END AS new FROM again WINDOW w AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM s),
runs AS (SELECT r, min(i) AS a, max(i) + {_L} AS b FROM g GROUP BY r, run),
cut AS (SELECT r, sum(b - a) AS n, count(*) AS spans, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends FROM runs GROUP BY r)
SELECT d.doc_id, CAST(len(h) // 2 AS bigint) AS n_bytes, CAST(coalesce(cut.n, 0) AS bigint) AS n_removed, CAST(coalesce(cut.spans, 0) AS bigint) AS n_spans,
  sha256(unhex(CASE WHEN cut.r IS NULL THEN h ELSE array_to_string(list_transform(range(1, len(starts) + 2), lambda k: substr(h, 2 * coalesce(ends[k - 1], 0) + 1, 2 * (coalesce(starts[k], len(h) // 2) - coalesce(ends[k - 1], 0)))), '') END)) AS kept_sha256
FROM d LEFT JOIN cut ON cut.r = d.r"""


def url_filters(tolerance: float = urls.TOLERANCE, damping: float = urls.DAMPING) -> str:
    """With as many rounds as leave less than the tolerance moving, whatever the links."""
    rounds = math.ceil(math.log(tolerance / 4) / math.log(damping))
    fits = {rule: f"((host = '{rule.split('/')[0]}' OR ends_with(host, '.{rule.split('/')[0]}')) AND starts_with(path, '{rule[rule.index('/') :]}'))" for _, rule in urls.RULES}
    longest = sorted(urls.RULES, key=lambda r: -len(r[1]))
    case = lambda value: "CASE " + " ".join(f"WHEN {fits[rule]} THEN '{rule if value else verdict}'" for verdict, rule in longest) + " END"
    link = "(?i)(?:href|src)\\s*=\\s*[\"'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"''\\s<>]+)"
    walk = "w0 AS (SELECT * FROM seeds)"
    for k in range(1, rounds + 1):
        walk += f""", w{k} AS (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (SELECT host, trust * {1 - damping} AS trust, distrust * {1 - damping} AS distrust FROM seeds
UNION ALL SELECT l.dst, w.trust * l.t * {damping}, w.distrust * l.d * {damping} FROM w{k - 1} w JOIN lanes l ON l.src = w.host) x GROUP BY 1)"""
    return f"""WITH p AS (SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
j AS (SELECT page_id, host, path, {case(True)} AS rule, {case(False)} AS own FROM p),
c AS (SELECT host, own, count(*) AS n FROM j WHERE own IS NOT NULL GROUP BY 1, 2), t AS (SELECT own, sum(n) AS n FROM c GROUP BY 1),
seeds AS (SELECT c.host, sum(CASE WHEN c.own = 'allow' THEN c.n / t.n ELSE 0 END) AS trust, sum(CASE WHEN c.own = 'block' THEN c.n / t.n ELSE 0 END) AS distrust FROM c JOIN t USING (own) GROUP BY 1),
e AS (SELECT DISTINCT host AS src, dst FROM (SELECT host, translate(unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)), '{urls.UPPER}', '{urls.LOWER}') AS dst FROM p) x WHERE host <> '' AND dst <> '' AND host <> dst),
lanes AS (SELECT src, dst, 1.0 / count(*) OVER (PARTITION BY src) AS t, 0.0 AS d FROM e UNION ALL SELECT dst, src, 0.0, 1.0 / count(*) OVER (PARTITION BY dst) FROM e), {walk},
n AS (SELECT host, trust / nullif(sum(trust) OVER (), 0) AS trust, distrust / nullif(sum(distrust) OVER (), 0) AS distrust FROM w{rounds})
SELECT page_id, j.host, path, rule, coalesce(own, CASE WHEN w.distrust > {urls.THRESHOLD} * (coalesce(w.trust, 0) + w.distrust) THEN 'block' END, 'allow') AS verdict FROM j LEFT JOIN n w ON w.host = j.host"""


def token_counts(vocabulary: str = VOCABULARY) -> str:
    """The longest piece that a word begins with is cut off, a piece a round, for all different words at once."""
    names = ", ".join("'" + name.replace("'", "''") + "'" for name, _ in sorted(printable_bytes().items(), key=lambda x: x[1]))
    space = next(name for name, byte in printable_bytes().items() if byte == 0x20)
    return f"""WITH RECURSIVE file AS (SELECT json FROM read_json_objects('{vocabulary}')),
special AS (SELECT unnest(CAST(json->'added_tokens' AS json[]))->>'content' AS piece FROM file),
v AS (SELECT piece FROM (SELECT unnest(json_keys(json->'model'->'vocab')) AS piece FROM file) x WHERE piece NOT IN (SELECT piece FROM special)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents), each AS (SELECT r, unnest(w) AS word FROM d),
h AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM each) x),
b AS (SELECT word, concat('{space}', array_to_string(list_transform(range(0, len(h) // 2), lambda i: ([{names}])[CAST(concat('0x', substr(h, 2 * i + 1, 2)) AS integer) + 1]), '')) AS left_over FROM h),
cut AS (SELECT word, left_over, 0 AS n FROM b UNION ALL
  SELECT word, substr(any_value(left_over), CAST(max(size) AS bigint) + 1), any_value(n) + 1 FROM (
    SELECT word, left_over, n, unnest(range(1, least(length(left_over), (SELECT max(length(piece)) FROM v)) + 1)) AS size FROM cut WHERE left_over <> '') c
  JOIN v ON v.piece = substr(left_over, 1, size) GROUP BY word),
counts AS (SELECT word, max(n) AS n FROM cut GROUP BY 1), found AS (SELECT r, count(*) AS words, sum(n) AS pieces FROM each JOIN counts USING (word) GROUP BY 1)
SELECT doc_id, CAST(coalesce(words, 0) AS bigint) AS n_words, CAST(coalesce(pieces, 0) AS bigint) AS n_tokens FROM d LEFT JOIN found USING (r)"""


def quality_rules(rounds: int = rules.ROUNDS) -> str:
    k = len(rules.RULES)
    each = range(1, k + 1)
    clip = lambda x: f"greatest(least({x}, 0.995), 0.005)"
    odds = "ln(prior / (1 - prior)) + " + " + ".join(f"CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN -1 THEN ln((1 - g{j}) / b{j}) ELSE 0 END" for j in each)
    rows_all = "greatest(sum(n), 1)"
    share = lambda j, value, p, held: clip(f"(sum(CASE WHEN v{j} = {value} THEN n * {p} ELSE 0 END) + {rows_all} * ({rules.HOLD * held})) / (sum(CASE WHEN v{j} <> 0 THEN n * {p} ELSE 0 END) + {rows_all} * {rules.HOLD})")
    steps = "m0 AS (SELECT 0.8::double AS prior, " + ", ".join(f"0.9::double AS g{j}, 0.6::double AS b{j}" for j in each) + ")"
    for i in range(1, rounds + 1):
        steps += f""", m{i} AS (SELECT {clip("sum(n * p) / greatest(sum(n), 1)")} AS prior, {", ".join(f"{share(j, 1, 'p', rules.GOOD)} AS g{j}, {share(j, -1, '(1 - p)', rules.BAD)} AS b{j}" for j in each)}
FROM (SELECT pat.*, 1 / (1 + exp(-({odds}))) AS p FROM pat, m{i - 1}) x)"""
    vote = lambda bad, good, j: f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v{j}"
    votes = [
        ("4 * n_dup_lines > n_lines", "n_dup_lines = 0"), ("20 * n_symbols > n_words", "100 * n_symbols <= n_words"), ("10 * n_symbol_ends > n_words", "100 * n_symbol_ends <= n_words"),
        ("2 * word_chars < 5 * n_words OR word_chars > 15 * n_words", "word_chars >= 3 * n_words AND word_chars <= 12 * n_words"), ("10 * n_capitals > 3 * word_chars", "10 * n_capitals <= word_chars"),
        ("5 * n_shouts > n_words", "50 * n_shouts <= n_words"), ("10 * n_exclamations > n_words", "50 * n_exclamations <= n_words"), ("10 * n_exclaimed_ends > n_words", "50 * n_exclaimed_ends <= n_words"),
        ("n_words >= 50 AND (50 * n_sentence_ends < n_words OR 4 * n_sentence_ends > n_words)", "30 * n_sentence_ends >= n_words AND 5 * n_sentence_ends <= n_words"),
        ("20 * n_punctuated_ends < n_words OR 3 * n_punctuated_ends > n_words", "12 * n_punctuated_ends >= n_words AND 4 * n_punctuated_ends <= n_words"), ("2 * n_distinct < n_words", "5 * n_distinct >= 3 * n_words"),
    ]
    count = lambda pattern: f"CAST(len(regexp_extract_all(t, '{pattern}')) AS bigint)"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
q AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i+1], w[i+2]) AS c FROM q),
rep AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS i FROM r WHERE c > 1) x GROUP BY 1),
lin AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) x WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
f AS (SELECT d.doc_id, CAST(len(w) AS bigint) AS n_words, CAST(length(array_to_string(w, '')) AS bigint) AS word_chars, {count("[#*$%&|<>]")} AS n_symbols, coalesce(lin.dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  coalesce(lin.n, 0) AS n_lines, CAST(len(list_distinct(w)) AS bigint) AS n_distinct, {", ".join(f"{count(p)} AS {name}" for name, p in rules.COUNTS.items())} FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lin USING (doc_id)),
v AS (SELECT *, {", ".join(vote(*x, j) for j, x in enumerate(votes, 1))} FROM f), pat AS (SELECT {", ".join(f"v{j}" for j in each)}, count(*)::double AS n FROM v GROUP BY ALL), {steps}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 1 / (1 + exp(-({odds}))) >= 0.5 AS kept FROM v, m{rounds}"""


ORACLE = {
    "op3_quality_rules": quality_rules(), "op4_jaccard_join": JACCARD_JOIN, "op5_suffix_dedup": SUFFIX_DEDUP, "op6_url_filters": url_filters(),
    "op7_substring_dedup": SUBSTRING_DEDUP, "op10_token_counts": token_counts(),
}
