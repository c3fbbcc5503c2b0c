"""The DuckDB forms of the operators: the same results by other means, as that engine has neither look-around nor Spark's functions."""

from __future__ import annotations

import re

from cueflow.functions import fixed
from cueflow.plans import fixtures as fx

_SP = "\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, '{flags}')"


def strip(x: str) -> str:
    return sub(sub(x, f"^[{_SP}]+", ""), f"[{_SP}]+$", "")


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{_SP}]+')"


def replaced(x: str, pairs: dict) -> str:
    for old, new in pairs.items():
        x = f"replace({x}, {lit(old)}, {lit(new)})"
    return x


def abbreviations(x: str) -> str:
    x = sub(x, "(\\s)", "\\1\\1")
    for short, full in fixed.ABBREVIATIONS.items():
        x = sub(x, f"(?i)(^|\\s){re.escape(short)}(\\s|$)", f"\\1{full}\\2")
    return sub(x, "(\\s)\\s", "\\1")


def standardize(x: str) -> str:
    return sub(replaced(x, fixed.REPLACEMENTS), f"[{fixed.ODD_SPACES}]+", " ")


def capitals(x: str) -> str:
    one = "CASE WHEN length(w) > 4 AND len(regexp_extract_all(w, '\\p{Lu}')) = 2 THEN concat(upper(substr(w, 1, 1)), lower(substr(w, 2))) ELSE w END"
    return f"array_to_string(list_transform({words(x)}, lambda w: {one}), ' ')"


def dots(x: str) -> str:
    x = sub(sub(x, "\\[\\s*(?:\\.{3,}|…+)\\s*\\]", "..."), "\\.{3,}|…+", "...")
    return strip(replaced(x, fixed.PUNCTUATION_SPACING))


def brackets(x: str) -> str:
    for pattern in ("\\[.*?\\]", "\\(.*?\\)", "\\*.*?\\*"):
        x = sub(x, pattern, "")
    return strip(sub(x, "</?font[^>]*>", "", "gi"))


def currencies(x: str) -> str:
    return replaced(x, fixed.CURRENCIES)


def comma(x: str) -> str:
    return sub(sub(x, "(\\d),(\\d)", "\\1.\\2"), "(\\d),(\\d)", "\\1.\\2")


def numbers(x: str) -> str:
    """For texts without fractions and more than three decimals."""
    for _ in range(3):
        x = sub(x, "(\\d)[ '](\\d{3})($|[^\\d\\p{L}_])", "\\1\\2\\3")
    x = sub(comma(currencies(x)), "(^|[^\\d\\p{L}_.])0+(\\d+)($|[^\\d\\p{L}_])", "\\1\\2\\3")
    for _ in range(3):
        x = sub(x, "(\\d)(\\d{3})($|[^\\d\\p{L}_])", "\\1'\\2\\3")
    return x


def normalize(x: str) -> str:
    x = f"translate({x}, {lit(fixed.APOSTROPHES)}, {lit(chr(39) * len(fixed.APOSTROPHES))})"
    x = numbers(standardize(capitals(abbreviations(dots(brackets(x))))))
    return strip(sub(f"replace({x}, chr(10), ' ')", f"[{_SP}]{{2,}}", " "))


def hints(x: str, vocabulary: list[str], elisions: list[str]) -> str:
    no = "[^\\p{L}\\p{N}_]"
    plain = f"replace({sub(x, '<[|][^|]+[|]>', '')}, '’', '''')"
    pattern = f"(?i)(^|{no})(({'|'.join(vocabulary)})({no}|$)|({'|'.join(elisions)})\\s*')"
    return f"regexp_matches({plain}, {lit(pattern)})"


def stamp(ms: str) -> str:
    """``HH:MM:SS.mmm`` of milliseconds within a day."""
    return f"format('{{:02d}}:{{:02d}}:{{:02d}}.{{:03d}}', {ms} // 3600000, ({ms} // 60000) % 60, ({ms} // 1000) % 60, {ms} % 1000)"


def token_count(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}\\s]')) AS bigint)"


def time_token(t: str, start: str) -> str:
    return f"format('<|{{:.2f}}|>', round_even(({t} - {start})/20.0, 0)*20/1000.0)"


def draw(key: str, seed: int) -> str:
    m = 2_147_483_647
    first = f"(((({key}) % {m}) + {seed}) * 48271 + 11) % {m}"
    return f"(((({first}) * 69621 + 7) % {m}) % 1000000)"


#: Merged intervals of the cues that have a word.
BLOCKED = f"""cues AS ({fx.CUES_DENSE}), bad AS (SELECT track_id, start_ms, end_ms FROM cues WHERE contains(lower(text), 'error')),
r AS (SELECT *, max(end_ms) OVER (PARTITION BY track_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM bad),
i AS (SELECT *, sum(CASE WHEN start_ms <= reached THEN 0 ELSE 1 END) OVER (PARTITION BY track_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS island FROM r),
blocked AS (SELECT track_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM i GROUP BY track_id, island)"""

SPANS = f"""{BLOCKED}, tracks AS (SELECT track_id, max(end_ms) AS audio_ms FROM cues GROUP BY 1),
gaps AS (SELECT track_id, lag(end_ms, 1, 0) OVER (PARTITION BY track_id ORDER BY tail, start_ms) AS span_start, start_ms AS span_end
  FROM (SELECT track_id, start_ms, end_ms, 0 AS tail FROM blocked UNION ALL SELECT track_id, audio_ms, audio_ms, 1 FROM tracks) x),
spans AS (SELECT track_id, CAST(row_number() OVER (PARTITION BY track_id ORDER BY span_start) - 1 AS bigint) AS span_idx, CAST(span_start AS bigint) AS span_start, CAST(span_end AS bigint) AS span_end
  FROM gaps WHERE span_end > span_start)"""

SEGMENTS = f"""WITH RECURSIVE cues AS ({fx.CUES_DENSE}),
tr AS (SELECT track_id, list(start_ms ORDER BY start_ms, cue_idx) AS st, list(end_ms ORDER BY start_ms, cue_idx) AS en, list(text ORDER BY start_ms, cue_idx) AS tx, max(end_ms) AS stop, count(*) AS n FROM cues GROUP BY 1),
walk AS (
  SELECT track_id, CAST(0 AS bigint) AS ss, CAST(0 AS bigint) AS i, CAST(-1 AS bigint) AS k, CAST(0 AS bigint) AS g, false AS emitted,
    CAST(0 AS bigint) AS seg_start, CAST(0 AS bigint) AS seg_end, CAST(0 AS bigint) AS f, CAST(0 AS bigint) AS l, true AS valid, CAST(0 AS bigint) AS og FROM tr
  UNION ALL
  SELECT track_id,
    CASE WHEN skip THEN en[i+1] WHEN NOT ok THEN greatest(se, en[j]) WHEN j = i THEN ss + 30000 WHEN en[j] <= se THEN en[j] ELSE st[j] END,
    CASE WHEN skip THEN i + 1 WHEN NOT ok OR j = i OR en[j] <= se THEN j ELSE j - 1 END,
    CASE WHEN skip THEN k ELSE k + 1 END, CASE WHEN NOT skip AND NOT ok THEN g + 1 ELSE g END, NOT skip, ss, se, i, j - 1, ok, g
  FROM (SELECT *, len(list_filter(range(i, j), lambda x: st[x+1] < ss OR st[x+1] > en[x+1])) = 0 AND len(list_filter(range(i, j-1), lambda x: en[x+1] > st[x+2])) = 0
      AND len(list_filter(range(i, j-2), lambda x: tx[x+1] = tx[x+2] AND tx[x+2] = tx[x+3])) = 0 AS ok
    FROM (SELECT *, st[i+1] < se AND en[i+1] - st[i+1] > 30000 AS skip, CAST(i + len(list_filter(st[i+1:], lambda x: x < se)) AS bigint) AS j
      FROM (SELECT w.track_id, w.ss, w.i, w.k, w.g, t.st, t.en, t.tx, t.n, CAST(least(w.ss + 30000, t.stop) AS bigint) AS se FROM walk w JOIN tr t USING (track_id)) a
      WHERE i < n AND ss < se) b) c),
segs AS (SELECT track_id, CAST(0 AS bigint) AS span_idx, k AS seg_idx, seg_start, seg_end, f AS first_pos, l AS last_pos, valid, og AS prompt_group FROM walk WHERE emitted)"""

RECORDS = f"""{SEGMENTS}, pos AS (SELECT *, CAST(row_number() OVER (PARTITION BY track_id ORDER BY start_ms, cue_idx) - 1 AS bigint) AS pos FROM cues),
nodes AS (SELECT s.*, p.pos, CASE WHEN p.end_ms <= s.seg_end THEN concat({time_token("p.start_ms", "s.seg_start")}, ' ', p.text, {time_token("p.end_ms", "s.seg_start")}) ELSE {time_token("p.start_ms", "s.seg_start")} END AS node_text,
  CASE WHEN p.end_ms <= s.seg_end THEN {token_count("p.text")} + 2 ELSE 1 END AS n_tokens
  FROM segs s JOIN pos p ON p.track_id = s.track_id AND p.pos BETWEEN s.first_pos AND s.last_pos WHERE s.valid),
texts AS (SELECT track_id, seg_idx, string_agg(node_text, '' ORDER BY pos) AS text, CAST(sum(n_tokens) AS bigint) AS tokens FROM nodes GROUP BY 1, 2),
counted AS (SELECT *, CAST(sum(n_tokens) OVER (PARTITION BY track_id, prompt_group ORDER BY seg_idx, pos ROWS UNBOUNDED PRECEDING) AS bigint) AS reached FROM nodes),
recs AS (SELECT s.track_id, s.span_idx, s.seg_idx, s.seg_start, s.seg_end, coalesce(t.text, '') AS text, coalesce(t.tokens, 0) AS tokens,
  coalesce((SELECT string_agg(c.node_text, '' ORDER BY c.reached) FROM counted c WHERE c.track_id = s.track_id AND c.prompt_group = s.prompt_group AND c.seg_idx < s.seg_idx
    AND (SELECT max(d.reached) FROM counted d WHERE d.track_id = s.track_id AND d.prompt_group = s.prompt_group AND d.seg_idx < s.seg_idx) - c.reached < 223), '') AS prompt
  FROM segs s LEFT JOIN texts t ON t.track_id = s.track_id AND t.seg_idx = s.seg_idx WHERE s.valid)"""

FUSED = f"""WITH RECURSIVE cues AS ({fx.CUES_CONV}),
o AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY cue_idx) AS i FROM cues),
f AS (SELECT track_id, i, start_ms AS s, end_ms AS e, text AS t, CAST(0 AS bigint) AS g FROM o WHERE i = 1
  UNION ALL
  SELECT f.track_id, o.i, CASE WHEN fits THEN f.s ELSE o.start_ms END, o.end_ms, CASE WHEN fits THEN joined ELSE o.text END, CASE WHEN fits THEN f.g ELSE f.g + 1 END
  FROM (SELECT f.*, o.start_ms, o.end_ms, o.text, concat(regexp_replace(f.t, '\\s+$', ''), ' ', regexp_replace(o.text, '^\\s+', '')) AS joined, length(concat(regexp_replace(f.t, '\\s+$', ''), ' ', regexp_replace(o.text, '^\\s+', ''))) <= 42 AND o.end_ms - f.s <= 7000 AS fits
    FROM f JOIN o ON o.track_id = f.track_id AND o.i = f.i + 1) f JOIN o ON o.track_id = f.track_id AND o.i = f.i + 1)
SELECT track_id, g AS cue_idx, max_by(s, i) AS start_ms, max_by(e, i) AS end_ms, max_by(t, i) AS text FROM f GROUP BY track_id, g"""

#: One step a cue: what joins the next cue (ahead), the cue before as it came to stand (b), and the cues that stay.
SANITIZED = f"""WITH RECURSIVE cues AS ({fx.CUES_MESSY}),
a AS (SELECT *, CASE WHEN text IS NOT DISTINCT FROM lag(text) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS chg FROM cues WINDOW w AS (PARTITION BY track_id ORDER BY cue_idx)),
b AS (SELECT *, sum(chg) OVER (PARTITION BY track_id ORDER BY cue_idx ROWS UNBOUNDED PRECEDING) AS run FROM a),
c AS (SELECT *, count(*) OVER (PARTITION BY track_id, run) AS n FROM b),
t AS (SELECT track_id, list({{'s': start_ms, 'e': end_ms, 't': text}} ORDER BY start_ms, cue_idx) AS l FROM c WHERE n < 3 AND length({strip("text")}) > 0 GROUP BY 1),
w AS (SELECT track_id, CAST(0 AS bigint) AS i, CAST(NULL AS struct(s bigint, e bigint, t varchar)) AS ahead, CAST(NULL AS struct(s bigint, e bigint, t varchar)) AS bef, CAST([] AS struct(s bigint, e bigint, t varchar)[]) AS stay, false AS lost FROM t
  UNION ALL
  SELECT track_id, i + 1, CASE WHEN x.s >= x.e AND NOT near THEN x END, x,
    CASE WHEN x.s < x.e THEN list_append(stay, x) WHEN near AND len(stay) > 0 THEN list_append(stay[:-2], {{'s': least(stay[-1].s, x.s), 'e': greatest(stay[-1].e, x.e), 't': concat(stay[-1].t, ' ', x.t)}}) ELSE stay END,
    x.s >= x.e AND near AND len(stay) = 0
  FROM (SELECT *, coalesce(x.s BETWEEN bef.s AND bef.e OR x.e BETWEEN bef.s AND bef.e, false) AS near
    FROM (SELECT w.*, CASE WHEN ahead IS NULL THEN l[i + 1] ELSE {{'s': least(ahead.s, l[i + 1].s), 'e': greatest(ahead.e, l[i + 1].e), 't': concat(ahead.t, ' ', l[i + 1].t)}} END AS x
      FROM w JOIN t USING (track_id) WHERE i < len(l) AND NOT lost) y) z),
f AS (SELECT w.track_id, stay, lost OR ahead IS NOT NULL AS lost FROM w JOIN t USING (track_id) WHERE lost OR i = len(l))
SELECT track_id, CAST(k - 1 AS bigint) AS cue_idx, stay[k].s AS start_ms, stay[k].e AS end_ms, stay[k].t AS text, CAST(NULL AS varchar) AS error FROM (SELECT *, unnest(range(1, len(stay) + 1)) AS k FROM f WHERE NOT lost) g
UNION ALL SELECT track_id, NULL, NULL, NULL, NULL, 'a cue has nothing to join' FROM f WHERE lost"""
