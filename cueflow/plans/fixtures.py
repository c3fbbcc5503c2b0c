"""Inputs of the queries, as SQL that Spark and DuckDB read alike."""

CUES_DENSE = """SELECT CAST(user_id AS string) AS track_id, cue_idx,
  cue_idx*4000 + event_id%1000 AS start_ms, cue_idx*4000 + event_id%1000 + 500 + (event_id*37)%2400 AS end_ms,
  concat(event_type,' no ',CAST(event_id%7 AS string)) AS text
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS bigint) AS cue_idx FROM events) e"""

CUES_MESSY = """SELECT CAST(user_id AS string) AS track_id, cue_idx,
  cue_idx*2000 + event_id%1500 AS start_ms, cue_idx*2000 + event_id%1500 + (event_id*37)%2400 - 100 AS end_ms, event_type AS text
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS bigint) AS cue_idx FROM events) e"""

CUES_CONV = """SELECT CAST(conv_id AS string) AS track_id, turn AS cue_idx, turn*3000 + conv_id%1000 AS start_ms,
  turn*3000 + conv_id%1000 + 400 + (length(text)*13)%1600 AS end_ms, text FROM conversations"""

CLIPS = """SELECT c_custkey AS clip_id, concat('clips/',c_name,'.wav') AS path, concat(c_mktsegment,' ',c_name) AS sentence,
  CAST(c_nationkey AS string) AS client_id, 2000+(c_custkey*37)%4000 AS dur_ms, (c_custkey*13)%300 AS vad_start_ms,
  2000+(c_custkey*37)%4000-(c_custkey*17)%400 AS vad_end_ms FROM customer"""

SEQUENCES = f"""SELECT CAST(clip_id%100 AS string) AS seq_id, CAST(floor(clip_id/100) AS bigint) AS pos, clip_id, dur_ms, vad_start_ms, vad_end_ms,
  CASE WHEN clip_id < 100 THEN 0 ELSE (clip_id*7)%150 END AS overlap_ms FROM ({CLIPS}) c"""

TEXTS = """SELECT doc_id, lang, concat(CASE doc_id%8 WHEN 0 THEN 'Preis 150 000 € z.B. ' WHEN 1 THEN 'Wait... [...] ca. 14,25 % ähm ' WHEN 2 THEN 'HoUse (weg) *x* '
  WHEN 3 THEN '“quoted” — dash … ﬁn – x ' WHEN 4 THEN '5 von 1000,50 $ Dr. Nr. ' WHEN 5 THEN '[Musik] <font color="a">Test</font> ... ' WHEN 6 THEN 'ist d''accord the and ' ELSE 'Hm bzw. etc. , x ?  ! ' END,
  text) AS text FROM documents"""

NUMBERS = """SELECT doc_id, concat('Preis ', CAST(doc_id*7919+1 AS string), ' ', CAST(100+doc_id%900 AS string), ' € und ', CAST(doc_id%9+1 AS string), ',', CAST(doc_id%100 AS string), ' % von CHF ',
  CAST(doc_id%30+1000 AS string), '''', CAST(doc_id%800+100 AS string)) AS text FROM documents"""

#: Blank records are rows of their own.
RECORDS = """SELECT doc_id, source AS track_id, lang, concat('<|0.00|> ', text, '<|2.00|>') AS text FROM documents
  UNION ALL SELECT -1 - doc_id, source, lang, '' FROM documents WHERE doc_id%3 = 0"""

#: A stem a document, some in both formats; and audio of which some has no transcript.
TRANSCRIPTS = """SELECT CAST(doc_id AS string) AS stem, CASE WHEN doc_id%2 = 0 THEN 'vtt' ELSE 'srt' END AS format, doc_id AS file_id FROM documents
  UNION ALL SELECT CAST(doc_id AS string), 'vtt', -1 - doc_id FROM documents WHERE doc_id%4 = 1"""
AUDIO = "SELECT CAST(page_id AS string) AS stem FROM pages UNION SELECT CAST(-1 - page_id AS string) FROM pages WHERE page_id%5 = 0"

SRT_FILES = """SELECT CAST(conv_id AS string) AS track_id, CASE WHEN conv_id%2 = 0 THEN 'srt' ELSE 'vtt' END AS format, string_agg(concat(
  CASE WHEN conv_id%2 = 0 THEN concat(CAST(turn+1 AS string), chr(10)) ELSE '' END,
  '00:0', CAST(turn%10 AS string), ':', CAST(10+turn%50 AS string), CASE WHEN conv_id%2 = 0 THEN ',' ELSE '.' END, CAST(100+turn*7 AS string),
  ' --> 00:0', CAST(turn%10 AS string), ':', CAST(11+turn%48 AS string), CASE WHEN conv_id%2 = 0 THEN ',' ELSE '.' END, CAST(200+turn*3 AS string), chr(10),
  replace(text, chr(10), ' '), chr(10), CASE WHEN turn%3 = 0 THEN concat(' ', role, chr(10)) ELSE '' END), chr(10) ORDER BY turn) AS content FROM conversations GROUP BY conv_id"""

STRIPPED = "SELECT doc_id, concat(' ', CASE doc_id%3 WHEN 0 THEN chr(9) ELSE chr(10) END, text, CASE doc_id%2 WHEN 0 THEN chr(160) ELSE '  ' END) AS text FROM documents"

SENTENCES = """SELECT doc_id, CASE doc_id%4 WHEN 0 THEN concat('"', text, '"') WHEN 1 THEN concat(text, '?') ELSE text END AS text FROM documents
  UNION ALL SELECT -1 - doc_id, '"' FROM documents WHERE doc_id%4 = 2"""

LANGUAGES = "SELECT doc_id, text, CASE WHEN doc_id%4 = 0 THEN 'zh' ELSE lang END AS lang FROM documents"

#: Every fifth cue is longer than a segment can be.
CUES_LONG = """SELECT track_id, cue_idx, start_ms*12 AS start_ms, CASE WHEN cue_idx%5 = 2 THEN start_ms*12 + 30001 + cue_idx%7*500 ELSE end_ms*12 - start_ms*11 END AS end_ms, text FROM (
"""+ CUES_DENSE + ") d"
