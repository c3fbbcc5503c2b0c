"""The queries: each operator over its input fixture, and the same as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cueflow.functions import fixed, providers, text, times
from cueflow.operators import assembly, cues, quality, segments, spans
from cueflow.plans import duck, fixtures as fx
from cueflow.plans.pipelines import Config, fuse_clips, split_recordings
from cueflow.session import scratch
from cueflow.sources import audio, subtitles, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FORBIDDEN = ("the", "que", "zzz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A fixture's SQL over the tables of a folder."""
    names = [n for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations") if f"FROM {n}" in sql]
    for name in names:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLE[name] = oracle
        return function

    return register


def dense(spark, d):
    return fixture(spark, d, fx.CUES_DENSE)


def messy(spark, d):
    return fixture(spark, d, fx.CUES_MESSY)


def blocked(spark, d):
    return cues.divert_words(dense(spark, d), ["error"]).filter("matched_word IS NOT NULL")


def tracks(rows: DataFrame) -> DataFrame:
    return rows.groupBy("track_id").agg(F.max("end_ms").alias("audio_ms"))


# cues

@query("repeat_run_drop", f"""WITH cues AS ({fx.CUES_MESSY}),
a AS (SELECT *, CASE WHEN text IS NOT DISTINCT FROM lag(text) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS chg FROM cues WINDOW w AS (PARTITION BY track_id ORDER BY cue_idx)),
b AS (SELECT *, sum(chg) OVER (PARTITION BY track_id ORDER BY cue_idx ROWS UNBOUNDED PRECEDING) AS run FROM a),
c AS (SELECT *, count(*) OVER (PARTITION BY track_id, run) AS n FROM b) SELECT track_id, cue_idx, start_ms, end_ms, text FROM c WHERE n < 3""")  # fmt: skip
def _(s, d):
    return cues.drop_repeated_runs(messy(s, d))


@query("blank_drop", f"SELECT doc_id, text FROM ({fx.RECORDS}) r WHERE length({duck.strip('text')}) > 0")
def _(s, d):
    return cues.drop_blank(fixture(s, d, fx.RECORDS)).select("doc_id", "text")


@query("track_validity", f"""WITH cues AS ({fx.CUES_MESSY} UNION ALL SELECT concat('d', track_id), cue_idx, start_ms, end_ms, concat(text, CAST(cue_idx%2 AS string)) FROM ({fx.CUES_DENSE}) x),
f AS (SELECT track_id, start_ms < 0 OR start_ms > end_ms OR coalesce(end_ms > lead(start_ms) OVER w, false) OR coalesce(text = lag(text) OVER w AND text = lag(text, 2) OVER w, false) AS wrong
FROM cues WINDOW w AS (PARTITION BY track_id ORDER BY cue_idx)) SELECT track_id, NOT bool_or(wrong) AS valid FROM f GROUP BY 1""")
def _(s, d):
    other = dense(s, d).select(F.concat(F.lit("d"), "track_id").alias("track_id"), "cue_idx", "start_ms", "end_ms", F.concat("text", (F.col("cue_idx") % 2).cast("string")).alias("text"))
    return cues.track_validity(messy(s, d).unionByName(other))


_DIVERT = "CASE WHEN contains(lower(text), 'click') THEN 'Click' WHEN contains(lower(text), 'o 3') THEN 'o 3' END"


@query("filter_word_divert", f"SELECT track_id, cue_idx, text, {_DIVERT} AS matched_word FROM ({fx.CUES_DENSE}) c")
def _(s, d):
    return cues.divert_words(dense(s, d), ["Click", "o 3"]).select("track_id", "cue_idx", "text", "matched_word")


@query("filtered_by_word", f"SELECT matched_word, count(*) AS cues, CAST(sum(end_ms - start_ms) AS bigint) AS total_ms FROM (SELECT *, {_DIVERT} AS matched_word FROM ({fx.CUES_DENSE}) c) x WHERE matched_word IS NOT NULL GROUP BY 1")
def _(s, d):
    _, out = subtitles.split_diverted(dense(s, d), ["Click", "o 3"])
    return out.groupBy("matched_word").agg(F.count("*").alias("cues"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("total_ms"))


@query("fuse_captions", duck.FUSED.replace(fx.CUES_CONV, fx.CUES_DENSE))
def _(s, d):
    return cues.fuse_captions(dense(s, d))


@query("fuse_long_captions", duck.FUSED)
def _(s, d):
    return cues.fuse_captions(fixture(s, d, fx.CUES_CONV))


@query("caption_overlap_fix", f"""SELECT track_id AS seq_id, cue_idx AS pos, round(CASE WHEN s <= p THEN p + 0.02 ELSE s END, 6) AS start_s, e AS end_s FROM (
SELECT *, lag(e) OVER (PARTITION BY track_id ORDER BY cue_idx) AS p FROM (SELECT *, start_ms/1000.0::double AS s, end_ms/1000.0::double AS e FROM ({fx.CUES_MESSY}) c) x) y""")
def _(s, d):
    own = messy(s, d).select(F.col("track_id").alias("seq_id"), F.col("cue_idx").alias("pos"), (F.col("start_ms") / F.lit(1000.0)).alias("start_s"), (F.col("end_ms") / F.lit(1000.0)).alias("end_s"))
    return cues.repair_overlaps(own).withColumn("start_s", F.round("start_s", 6))


@query("sanitize_cues", duck.SANITIZED)
def _(s, d):
    return cues.sanitize_cues(messy(s, d))


# spans

@query("merge_blocked_intervals", f"WITH {duck.BLOCKED} SELECT * FROM blocked")
def _(s, d):
    return spans.merge_intervals(blocked(s, d))


@query("safe_spans", f"WITH {duck.SPANS} SELECT * FROM spans")
def _(s, d):
    return spans.safe_spans(tracks(dense(s, d)), blocked(s, d))


@query("span_containment", f"WITH {duck.SPANS} SELECT c.track_id, c.cue_idx, s.span_idx FROM cues c JOIN spans s ON c.track_id = s.track_id WHERE c.start_ms >= span_start AND c.end_ms <= span_end AND c.end_ms > span_start AND c.start_ms < span_end")
def _(s, d):
    own = dense(s, d)
    return spans.contained_cues(own, spans.safe_spans(tracks(own), blocked(s, d))).select("track_id", "cue_idx", "span_idx")


# segments

def whole_tracks(s, d, sql=fx.CUES_DENSE):
    own = fixture(s, d, sql)
    whole = own.join(tracks(own), "track_id").select("*", F.lit(0).cast("long").alias("span_idx"), F.lit(0).cast("long").alias("span_start"), F.col("audio_ms").alias("span_end"), F.lit("de").alias("language"))
    return segments.positioned(whole)


@query("segment_boundaries", f"{duck.SEGMENTS} SELECT * FROM segs")
def _(s, d):
    return segments.segment_boundaries(whole_tracks(s, d))


@query("segments_without_long_cues", f"{duck.SEGMENTS.replace(fx.CUES_DENSE, fx.CUES_LONG)} SELECT * FROM segs")
def _(s, d):
    return segments.segment_boundaries(whole_tracks(s, d, fx.CUES_LONG))


def records_of(s, d, sql=fx.CUES_DENSE):
    own = whole_tracks(s, d, sql)
    return segments.segment_records(own, segments.segment_boundaries(own))


@query("segment_records", f"{duck.RECORDS} SELECT track_id, seg_idx, seg_start, seg_end, text, tokens FROM recs")
def _(s, d):
    return records_of(s, d).select("track_id", "seg_idx", "seg_start", "seg_end", "text", "tokens")


@query("segment_prompts", f"{duck.RECORDS} SELECT track_id, seg_idx, prompt FROM recs")
def _(s, d):
    return records_of(s, d).select("track_id", "seg_idx", "prompt")


@query("token_budget", f"{duck.RECORDS.replace(fx.CUES_DENSE, fx.CUES_CONV)} SELECT track_id, seg_idx, tokens FROM recs WHERE tokens <= 219")
def _(s, d):
    return records_of(s, d, fx.CUES_CONV).filter("within").select("track_id", "seg_idx", "tokens")


@query("cut_list", f"{duck.SEGMENTS} SELECT track_id, seg_start, seg_end, seg_start*16 AS start_sample, least(seg_end*16, seg_start*16 + 480000) AS end_sample FROM segs")
def _(s, d):
    return segments.cut_list(segments.segment_boundaries(whole_tracks(s, d)))


# times

_TIMES = "SELECT event_id, CASE event_id%5 WHEN 0 THEN concat('0', CAST(event_id%9 AS string), ':1', CAST(event_id%10 AS string), ':22,', CAST(event_id%1000 AS string)) WHEN 1 THEN concat('01:02:0', CAST(event_id%10 AS string), '.5') WHEN 2 THEN '12:30' WHEN 3 THEN concat(' 00:00:', CAST(10+event_id%50 AS string), ',010 ') ELSE 'x:1:2,3' END AS text FROM events"


@query("parse_time", f"""SELECT event_id, CASE WHEN len(p) = 4 THEN CAST(((CAST(p[1] AS bigint)*60 + CAST(p[2] AS bigint))*60 + CAST(p[3] AS bigint))*1000 + CAST(p[4] AS bigint) AS bigint) END AS ms
FROM (SELECT event_id, CASE WHEN regexp_full_match(trim(text), '\\d+:\\d+:\\d+[,.]\\d+') THEN regexp_extract_all(text, '\\d+') END AS p FROM ({_TIMES}) t) x""")
def _(s, d):
    return fixture(s, d, _TIMES).select("event_id", times.parse_time(F.col("text")).alias("ms"))


@query("time_token", f"SELECT track_id, cue_idx, CASE WHEN end_ms - start_ms BETWEEN 0 AND 30000 THEN {duck.time_token('end_ms', 'start_ms')} END AS token FROM ({fx.CUES_MESSY}) c")
def _(s, d):
    return messy(s, d).select("track_id", "cue_idx", times.time_token(F.col("end_ms"), F.col("start_ms")).alias("token"))


@query("srt_time_format", f"""SELECT track_id, cue_idx, format('{{:02d}}:{{:02d}}:{{:02d}}.{{:03d}}', (u // 3600000000) % 24, (u // 60000000) % 60, (u // 1000000) % 60, (u // 1000) % 1000) AS stamp
FROM (SELECT track_id, cue_idx, (((start_ms*1000*37 - 5000000) % 86400000000) + 86400000000) % 86400000000 AS u FROM ({fx.CUES_DENSE}) c) x""")
def _(s, d):
    return dense(s, d).select("track_id", "cue_idx", times.srt_time((F.col("start_ms") * 37 - 5000) / F.lit(1000.0)).alias("stamp"))


# texts

def text_query(name: str, column: Callable, oracle: str | None, sql: str = fx.TEXTS):
    query(name, f"SELECT doc_id, {oracle} AS result FROM ({sql}) t" if oracle else None)(lambda s, d: fixture(s, d, sql).select("doc_id", column(F.col("text")).alias("result")))


text_query("remove_brackets", text.remove_bracketed, duck.brackets("text"))
text_query("standardize_text", text.standardize, duck.standardize("text"))
text_query("triple_dots", text.tidy_dots, duck.dots("text"))
text_query("capitalization", text.fix_capitals, duck.capitals("text"))
text_query("tokenize_text", lambda c: F.array_join(text.tokens(c), "|"), f"array_to_string(regexp_extract_all(text, '\\.\\.\\.|[^{duck._SP}]+'), '|')")
text_query("currencies", text.currencies, duck.currencies("text"))
text_query("comma_decimal", text.comma_decimals, duck.comma("text"))
text_query("abbreviations", text.expand_abbreviations, duck.abbreviations("text"))
text_query("number_grouping", text.numbers, duck.numbers("text"), fx.NUMBERS)
text_query("normalize_text", text.normalize, duck.normalize("text"), fx.NUMBERS)
text_query("normalize_documents", text.normalize, None, fx.TEXTS)
text_query("collapse_ngrams", text.collapse_repeats, None, fx.TEXTS)
text_query("compression_ratio", text.compression_ratio, None, "SELECT doc_id, text FROM documents")
text_query("strip_text", text.strip, duck.strip("text"), fx.STRIPPED)


@query("leading_space", f"SELECT doc_id, CASE WHEN lang IN ('zh', 'ja', 'th', 'lo', 'my') THEN text ELSE concat(' ', text) END AS result FROM ({fx.LANGUAGES}) t")
def _(s, d):
    return fixture(s, d, fx.LANGUAGES).select("doc_id", text.leading_space(F.col("text"), F.col("lang")).alias("result"))


@query("sentence_punctuation", f"""SELECT doc_id, CASE WHEN length(b) > 0 AND right(b, 1) NOT IN ('.', '?', '!') THEN concat(b, '.') ELSE b END AS result FROM (
SELECT doc_id, CASE WHEN starts_with(text, '"') AND ends_with(text, '"') THEN substr(text, 2, greatest(length(text) - 2, 0)) ELSE text END AS b FROM ({fx.SENTENCES}) t) x""")
def _(s, d):
    return fixture(s, d, fx.SENTENCES).select("doc_id", text.finish_sentence(F.col("text")).alias("result"))


@query("sanitize_id", f"""SELECT page_id, coalesce(nullif({duck.sub(duck.sub("translate(" + duck.strip("url") + ", '/' || chr(92), '__')", "[^A-Za-z0-9._-]+", "_"), "^[._]+|[._]+$", "")}, ''), 'sample') AS result FROM (SELECT page_id, CASE WHEN page_id%7 = 0 THEN ' ._ ' ELSE url END AS url FROM pages) p""")
def _(s, d):
    return fixture(s, d, "SELECT page_id, CASE WHEN page_id%7 = 0 THEN ' ._ ' ELSE url END AS url FROM pages").select("page_id", text.safe_id(F.col("url")).alias("result"))


@query("surrogate_tokens", f"SELECT doc_id, {duck.token_count('text')} AS tokens FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", providers.token_count(F.col("text")).alias("tokens"))


# quality

@query("word_count_filter", f"SELECT doc_id, text FROM ({fx.RECORDS}) r WHERE len({duck.words('text')}) > 8")
def _(s, d):
    return fixture(s, d, fx.RECORDS).filter(~quality.few_words(F.col("text"))).select("doc_id", "text")


@query("french_filter", f"SELECT doc_id FROM documents WHERE {duck.hints('text', fixed.FRENCH_WORDS, fixed.FRENCH_ELISIONS)} AND lang = 'fr'")
def _(s, d):
    return quality.french(table(s, d, "documents"), F.col("lang")).select("doc_id")


@query("english_filter", f"SELECT doc_id FROM documents WHERE {duck.hints('text', fixed.ENGLISH_WORDS, fixed.ENGLISH_ELISIONS)} AND lang = 'en'")
def _(s, d):
    return quality.english(table(s, d, "documents"), F.col("lang")).select("doc_id")


@query("record_filter_words", f"SELECT doc_id, CASE {' '.join(f'WHEN contains(upper(text), upper({duck.lit(w)})) THEN {duck.lit(w)}' for w in FORBIDDEN)} END AS word FROM ({fx.RECORDS}) r")
def _(s, d):
    return fixture(s, d, fx.RECORDS).select("doc_id", quality.first_word(F.col("text"), FORBIDDEN).alias("word"))


@query("bad_records")
def _(s, d):
    own = quality.disposed(fixture(s, d, fx.RECORDS))
    return own.filter("disposition = 'bad_examples'").select("doc_id", "text")


@query("disposition_counts")
def _(s, d):
    return quality.disposed(fixture(s, d, fx.RECORDS), ["der"], F.col("lang")).groupBy("disposition").agg(F.count("*").alias("records"))


@query("residual_check", f"SELECT doc_id, CASE WHEN contains(upper(text), 'ZZZ') THEN 'zzz' ELSE 'the' END AS word FROM ({fx.RECORDS}) r WHERE NOT contains(upper(text), 'QUE') AND (contains(upper(text), 'ZZZ') OR contains(upper(text), 'THE'))")
def _(s, d):
    kept = quality.disposed(fixture(s, d, fx.RECORDS), ["que"], bad=F.lit(False)).filter("disposition = 'kept'")
    return quality.residual(kept, ["zzz", "the"]).select("doc_id", "word")


@query("left_semi_ids", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)")
def _(s, d):
    return quality.allowed_only(table(s, d, "documents"), table(s, d, "labels").filter("toxic = 0").select("doc_id"), "doc_id").select("doc_id", "lang")


# clips and tables

@query("exact_fraction_sample", f"SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {duck.draw('doc_id', 1)}, doc_id) AS n, count(*) OVER (PARTITION BY source) AS a FROM documents) t WHERE n * 1000 <= a * 300 + 500")
def _(s, d):
    return assembly.exact_sample(table(s, d, "documents").select("doc_id", "source"), "doc_id", 300, partitions="source")


@query("global_fraction_sample", f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {duck.draw('doc_id', 1)}, doc_id) AS n, count(*) OVER () AS a FROM documents) t WHERE n * 1000 <= a * 300 + 500")
def _(s, d):
    return assembly.exact_sample(table(s, d, "documents").select("doc_id"), "doc_id", 300)


@query("union_common_columns", "SELECT nationkey, phone_name FROM (SELECT c_nationkey AS nationkey, c_name AS phone_name FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier) t")
def _(s, d):
    one = table(s, d, "customer").withColumnsRenamed({"c_nationkey": "nationkey", "c_name": "phone_name"})
    two = table(s, d, "supplier").withColumnsRenamed({"s_nationkey": "nationkey", "s_name": "phone_name"})
    return tables.union_common([one, two])


@query("best_transcript_per_stem", f"SELECT stem, format, file_id FROM (SELECT t.*, row_number() OVER (PARTITION BY stem ORDER BY format) AS n FROM ({fx.TRANSCRIPTS}) t JOIN ({fx.AUDIO}) a USING (stem)) x WHERE n = 1")
def _(s, d):
    found, _missing = subtitles.best_transcripts(fixture(s, d, fx.AUDIO), fixture(s, d, fx.TRANSCRIPTS))
    return found.select("stem", F.col("transcript_format").alias("format"), F.col("transcript_file_id").alias("file_id"))


@query("missing_transcripts", f"SELECT stem FROM ({fx.AUDIO}) a WHERE stem NOT IN (SELECT stem FROM ({fx.TRANSCRIPTS}) t)")
def _(s, d):
    return subtitles.best_transcripts(fixture(s, d, fx.AUDIO), fixture(s, d, fx.TRANSCRIPTS))[1]


@query("silence_subsample", f"SELECT doc_id, track_id, text FROM (SELECT *, row_number() OVER (PARTITION BY track_id, text = '' ORDER BY doc_id) AS n FROM ({fx.RECORDS}) r) x WHERE text <> '' OR (n - 1) % 3 = 0")
def _(s, d):
    return assembly.subsample_silence(fixture(s, d, fx.RECORDS), 3, ["doc_id"]).select("doc_id", "track_id", "text")


_RUNS = f"""WITH clips AS ({fx.CLIPS}), a AS (SELECT *, {duck.draw('clip_id', 42)} AS h, CASE WHEN {duck.draw('clip_id', 43)} >= 500000 THEN 1 ELSE 0 END AS breaks FROM clips),
b AS (SELECT *, row_number() OVER w AS nth FROM a WINDOW w AS (PARTITION BY client_id ORDER BY h, clip_id)),
c AS (SELECT *, CAST(sum(CASE WHEN nth = 1 THEN 0 ELSE breaks END) OVER (PARTITION BY client_id ORDER BY nth ROWS UNBOUNDED PRECEDING) AS bigint) AS run FROM b),
e AS (SELECT *, min(clip_id) OVER (PARTITION BY client_id, run) AS run_first FROM c), f AS (SELECT *, {duck.draw('run_first', 44)} AS run_key FROM e),
g AS (SELECT *, row_number() OVER (ORDER BY run_key, run_first, client_id, nth) - 1 AS place FROM f)"""


@query("speaker_runs", f"{_RUNS} SELECT clip_id, client_id, nth, run FROM g")
def _(s, d):
    return assembly.speaker_runs(fixture(s, d, fx.CLIPS), 500_000).select("clip_id", "client_id", "nth", "run")


@query("chunk_sequences", f"{_RUNS} SELECT clip_id, CAST(place // 8 AS varchar) AS seq_id, CAST(place % 8 AS bigint) AS pos FROM g")
def _(s, d):
    return assembly.chunk_sequences(assembly.speaker_runs(fixture(s, d, fx.CLIPS), 500_000), 8).select("clip_id", "seq_id", "pos")


@query("overlap_draw", f"""SELECT seq_id, pos, CAST(CASE WHEN pos > 0 AND {duck.draw('clip_id', 7)} < 600000 THEN CASE WHEN {duck.draw('clip_id', 8)} < 300000 THEN room ELSE floor(room * {duck.draw('clip_id', 9)} / 1000000.0) END ELSE 0 END AS bigint) AS overlap_ms
FROM (SELECT *, lag(dur_ms - vad_end_ms) OVER (PARTITION BY seq_id ORDER BY pos) + vad_start_ms + 200 AS room FROM ({fx.SEQUENCES}) q) x""")
def _(s, d):
    return assembly.draw_overlaps(fixture(s, d, fx.SEQUENCES).drop("overlap_ms"), 600_000, 300_000, 200).select("seq_id", "pos", "overlap_ms")


@query("fused_offsets", f"""SELECT seq_id, pos, CAST(off AS bigint) AS offset_ms, CAST(vad_start_ms - overlap_ms + off AS bigint) AS start_ms, CAST(off + vad_end_ms - overlap_ms AS bigint) AS end_ms
FROM (SELECT *, coalesce(sum(dur_ms - overlap_ms) OVER (PARTITION BY seq_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM ({fx.SEQUENCES}) q) x""")
def _(s, d):
    out = assembly.fused_offsets(fixture(s, d, fx.SEQUENCES))
    return out.select("seq_id", "pos", "offset_ms", F.col("start_ms").cast("long").alias("start_ms"), F.col("end_ms").cast("long").alias("end_ms"))


@query("srt_text", f"""SELECT track_id AS seq_id, string_agg(concat(CAST(n AS varchar), chr(10), {duck.stamp('start_ms')}, ' --> ', {duck.stamp('end_ms')}, chr(10), text, chr(10)), chr(10) ORDER BY n) AS srt
FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY cue_idx) AS n FROM ({fx.CUES_CONV}) c) x GROUP BY 1""")
def _(s, d):
    own = fixture(s, d, fx.CUES_CONV).select(F.col("track_id").alias("seq_id"), F.col("cue_idx").alias("pos"), (F.col("start_ms") / F.lit(1000.0)).alias("start_s"), (F.col("end_ms") / F.lit(1000.0)).alias("end_s"), "text")
    return assembly.srt_texts(own)


# audio, of generated recordings

@query("wave_durations", f"SELECT clip_id, dur_ms FROM ({fx.CLIPS}) c")
def _(s, d):
    clips = fixture(s, d, fx.CLIPS).select(F.col("clip_id").cast("string").alias("path"), "dur_ms")
    return audio.tones(clips).select(F.col("path").cast("long").alias("clip_id"), providers.wav_duration_ms("content").alias("dur_ms"))


@query("segment_audio", f"{duck.SEGMENTS.replace(fx.CUES_DENSE, fx.CUES_CONV)} SELECT concat(track_id, '/', CAST(seg_start AS varchar), '.wav') AS path, CAST(least(seg_end*16, seg_start*16 + 480000) - seg_start*16 AS bigint) AS samples FROM segs")
def _(s, d):
    own = whole_tracks(s, d, fx.CUES_CONV)
    recordings = audio.tones(tracks(own).select(F.col("track_id").alias("path"), "audio_ms"), "audio_ms").withColumnRenamed("path", "track_id")
    cuts = segments.segment_boundaries(own).withColumn("path", F.concat("track_id", F.lit("/"), F.col("seg_start").cast("string"), F.lit(".wav")))
    return audio.segment_audio(cuts, recordings).select("path", ((F.octet_length("bytes") - 44) / 2).cast("long").alias("samples"))


@query("render_sequences", f"SELECT seq_id, CAST(sum((dur_ms // 10 - overlap_ms // 10) * 16) AS bigint) AS samples FROM ({fx.SEQUENCES}) q GROUP BY 1")
def _(s, d):
    rows = fixture(s, d, fx.SEQUENCES).select("seq_id", "pos", F.col("clip_id").cast("string").alias("path"), F.floor(F.col("dur_ms") / 10).alias("dur_ms"), F.floor(F.col("overlap_ms") / 10).alias("overlap_ms"))
    return audio.render_sequences(rows, audio.tones(rows)).select("seq_id", ((F.octet_length("bytes") - 44) / 2).cast("long").alias("samples"))


# subtitle files

@query("parse_subtitles", f"""WITH files AS ({fx.SRT_FILES}), l AS (SELECT track_id, format, string_split(CASE WHEN ends_with(content, chr(10)) THEN content[:-2] ELSE content END, chr(10)) AS lines FROM files),
m AS (SELECT *, list_filter(range(1, len(lines) + 1), lambda i: contains(lines[i], ' --> ')) AS marks FROM l),
c AS (SELECT track_id, format, lines, marks, unnest(range(1, len(marks) + 1)) AS k FROM m),
t AS (SELECT track_id, format, CAST(k - 1 AS bigint) AS cue_idx, string_split(lines[marks[k]], ' --> ') AS p,
  {duck.strip("array_to_string(list_transform(lines[marks[k] + 1 : coalesce(marks[k + 1], len(lines) + 1 + CASE WHEN format = 'srt' THEN 2 ELSE 1 END) - CASE WHEN format = 'srt' THEN 3 ELSE 2 END], lambda x: trim(x)), ' ')")} AS text FROM c)
SELECT track_id, cue_idx, {' , '.join(f"CAST(((CAST(regexp_extract(p[{i}], '(\\d+):(\\d+):(\\d+)[,.](\\d+)', 1) AS bigint)*60 + CAST(regexp_extract(p[{i}], '(\\d+):(\\d+):(\\d+)[,.](\\d+)', 2) AS bigint))*60 + CAST(regexp_extract(p[{i}], '(\\d+):(\\d+):(\\d+)[,.](\\d+)', 3) AS bigint))*1000 + CAST(regexp_extract(p[{i}], '(\\d+):(\\d+):(\\d+)[,.](\\d+)', 4) AS bigint) AS bigint) AS {n}" for i, n in ((1, 'start_ms'), (2, 'end_ms')))}, text
FROM t WHERE CASE WHEN format = 'srt' THEN length(text) > 1 ELSE text NOT IN ('', '.') END""")
def _(s, d):
    return subtitles.parse_cues(fixture(s, d, fx.SRT_FILES.replace("string_agg(concat(", "listagg(concat(").replace("chr(10) ORDER BY turn)", "chr(10)) WITHIN GROUP (ORDER BY turn)")))


@query("series_sentences", f"SELECT track_id, string_agg(text, ' ' ORDER BY cue_idx) AS sentence FROM ({fx.CUES_CONV}) c GROUP BY 1")
def _(s, d):
    own = fixture(s, d, fx.CUES_CONV)
    files = own.select("track_id").distinct().select("track_id", F.lit("a").alias("audio"), F.col("track_id").alias("series"), F.lit("s").alias("srt"), F.lit("de").alias("language"))
    return tables.series(own, files).select(F.col("series").alias("track_id"), "sentence")


@query("voice_activity_ring", """WITH RECURSIVE f AS (SELECT CAST(user_id AS varchar) AS track_id, list(event_id%5 < 3 ORDER BY event_id) AS v FROM events GROUP BY 1),
run AS (SELECT track_id, v, 0 AS k, 0 AS since, false AS voiced, CAST(NULL AS bigint) AS first, CAST(NULL AS bigint) AS last FROM f UNION ALL
  SELECT track_id, v, k + 1, CASE WHEN turns THEN k + 1 ELSE since END, voiced <> turns, CASE WHEN turns AND NOT voiced THEN coalesce(first, oldest * 30) ELSE first END, CASE WHEN turns AND voiced THEN k * 30 ELSE last END
  FROM (SELECT *, greatest(since, k - 2) AS oldest, k - greatest(since, k - 2) = 2 AND NOT list_contains(v[greatest(since, k - 2) + 1 : k + 1], voiced) AS turns FROM run WHERE k < len(v)) x)
SELECT track_id, coalesce(first, 0) AS start_ms, CASE WHEN voiced THEN CAST(len(v) * 30 AS bigint) ELSE last END AS end_ms FROM run WHERE k = len(v)""")
def _(s, d):
    flags = F.array_sort(F.collect_list(F.struct("cue_idx", (F.col("event_id") % 5 < 3).alias("voiced"))))
    rows = fixture(s, d, "SELECT CAST(user_id AS string) AS track_id, event_id, event_id AS cue_idx FROM events").groupBy("track_id").agg(flags.alias("all"))
    return rows.select("track_id", providers.ring_activity(F.transform("all", lambda x: x["voiced"]), F.size("all") * 30, 30, 90).alias("v")).select("track_id", "v.*")


# files: each is written below the shared folder, and read again

def stored(s, write: Callable[[str], object]) -> str:
    path = scratch(s, "files")
    write(path)
    return path


_AUDIO = "concat('audio/d.', CAST(doc_id AS varchar), '.wav')"
_FILES = "SELECT doc_id, lang, concat('audio/d.', CAST(doc_id AS string), '.wav') AS audio_path, text FROM documents"


@query("jsonl_records", f"SELECT {_AUDIO} AS audio, text, lang AS language, '' AS prompt FROM documents")
def _(s, d):
    records = fixture(s, d, _FILES).select("audio_path", "text", F.col("lang").alias("language"), F.lit("").alias("prompt"))
    return tables.as_audio(tables.read_records(s, stored(s, lambda path: tables.write_records(records, path))))


@query("sentence_files", f"SELECT concat('clips/a/', path) AS path, sentence, client_id FROM ({fx.CLIPS}) c UNION ALL SELECT concat('b/', {_AUDIO}), text, '0' FROM documents")
def _(s, d):
    clips = stored(s, lambda path: tables.write_tsv(fixture(s, d, fx.CLIPS).select("path", "sentence", "client_id"), path))
    docs = stored(s, lambda path: tables.write_tsv(fixture(s, d, _FILES).select(F.col("audio_path").alias("clip_path"), F.col("text").alias("sentence")), path))
    return tables.read_clips(s, [(clips, "clips/a/", 1000), (docs, "b", 1000)]).select("path", "sentence", "client_id")


@query("plain_lines", f"SELECT {_AUDIO} AS audio_path, text, 'de' AS language, '' AS prompt FROM (SELECT doc_id, regexp_replace(text, '\\s+', ' ', 'g') AS text FROM documents) x WHERE {duck.token_count('text')} <= 219")
def _(s, d):
    lines = fixture(s, d, _FILES).select(F.concat_ws("\t", "audio_path", F.regexp_replace("text", "\\s+", " ")).alias("value"))
    return tables.read_plain(s, stored(s, lambda path: lines.write.text(path)))


@query("manifest_join", f"SELECT concat('d.', CAST(doc_id AS varchar)) AS id, {_AUDIO} AS audio_path, coalesce(nullif(lang, 'en'), 'de') AS language, text AS srt FROM documents WHERE doc_id%3 > 0")
def _(s, d):
    rows = fixture(s, d, _FILES).withColumn("srt_path", F.concat(F.lit("srt/"), F.col("doc_id").cast("string")))
    listed = rows.select("srt_path", "audio_path", F.nullif("lang", F.lit("en")).alias("language"))
    manifest = tables.read_manifest(s, stored(s, lambda path: tables.write_tsv(listed, path)))
    return manifest.join(rows.filter("doc_id%3 > 0").select("srt_path", F.col("text").alias("srt")), "srt_path").drop("srt_path")


@query("metadata_transcripts", f"""SELECT CAST(c AS varchar) AS audio, srt FROM (SELECT conv_id AS c, string_agg(text, chr(10) ORDER BY turn) AS srt FROM conversations GROUP BY 1) x""")
def _(s, d):
    texts = table(s, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("all"))
    files = texts.select(F.concat(F.lit("s/"), F.col("conv_id").cast("string"), F.lit(".srt")).alias("srt_path"), F.array_join(F.transform("all", lambda x: x["text"]), "\n").alias("srt"))
    listed = texts.select(F.col("conv_id").cast("string").alias("path"), F.concat(F.lit("s/"), F.col("conv_id").cast("string"), F.lit(".srt")).alias("srt_path"), F.lit("x").alias("clip_path"))
    return tables.read_metadata(s, stored(s, lambda path: tables.write_tsv(listed, path)), files).select("audio", "srt")


@query("exported_sentences", f"""SELECT concat('d.', CAST(x.doc_id AS varchar), '.mp3') AS path, nullif(CASE WHEN length(b) > 0 AND right(b, 1) NOT IN ('.', '?', '!') THEN concat(b, '.') ELSE b END, '') AS sentence FROM (
SELECT doc_id, CASE WHEN starts_with(text, '"') AND ends_with(text, '"') THEN substr(text, 2, greatest(length(text) - 2, 0)) ELSE text END AS b FROM ({fx.SENTENCES}) t) x""")
def _(s, d):
    rows = fixture(s, d, fx.SENTENCES).select(F.concat(F.lit("audio/d."), F.col("doc_id").cast("string"), F.lit(".wav")).alias("path"), F.col("text").alias("sentence"))
    return tables.read_tsv(s, stored(s, lambda path: tables.write_tsv(tables.exported(rows), path)))


@query("reject_files", f"""SELECT doc_id, lang, text, disposition FROM (SELECT doc_id, lang, text, CASE WHEN {duck.hints('text', fixed.FRENCH_WORDS, fixed.FRENCH_ELISIONS)} AND lang = 'fr' THEN 'french_examples'
WHEN {duck.hints('text', fixed.ENGLISH_WORDS, fixed.ENGLISH_ELISIONS)} AND lang = 'en' THEN 'english_examples' WHEN contains(upper(text), 'DER') THEN 'filtered_der_examples' ELSE 'kept' END AS disposition FROM documents) x WHERE disposition <> 'kept'""")
def _(s, d):
    own = quality.disposed(table(s, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text"), ["der"], F.col("lang"), bad=F.lit(False))
    path = stored(s, lambda path: tables.write_rejects(own, path))
    return tables.read_tsv(s, path).withColumn("doc_id", F.col("doc_id").cast("long"))


@query("diverted_files", f"SELECT track_id AS speech_id, start_ms, end_ms, text, matched_word FROM (SELECT *, {_DIVERT} AS matched_word FROM ({fx.CUES_DENSE}) c) x WHERE matched_word IS NOT NULL")
def _(s, d):
    path = stored(s, lambda path: tables.write_diverted(subtitles.split_diverted(dense(s, d), ["Click", "o 3"])[1], path))
    return tables.read_tsv(s, path).select("speech_id", F.col("start_ms").cast("long").alias("start_ms"), F.col("end_ms").cast("long").alias("end_ms"), "text", "matched_word")


@query("dataset_rows", f"SELECT {_AUDIO} AS path, true AS bare, text, 'test' AS split FROM documents")
def _(s, d):
    records = fixture(s, d, _FILES).select(F.col("audio_path").alias("audio"), "text")
    found = s.read.parquet(stored(s, lambda path: tables.write_dataset(records, path, "test")))
    return found.select("audio.path", F.isnull("audio.bytes").alias("bare"), "text", "split")


# pipelines

@query("pipeline_splitting")
def _(s, d):
    own = dense(s, d).unionByName(messy(s, d).withColumn("track_id", F.concat(F.lit("m"), "track_id")))
    info = tracks(own).select("track_id", "audio_ms", F.concat(F.lit("dump/"), "track_id").alias("audio_path"), F.lit("de").alias("language"))
    return split_recordings(own, info, Config(filter_words=["error"]), language=providers.hinted_language(text.french_hint(F.col("text")), text.english_hint(F.col("text")))).drop("seg_start", "seg_end")


@query("pipeline_fusion", f"""{_RUNS}, s AS (SELECT *, CAST(place // 16 AS varchar) AS seq_id, CAST(place % 16 AS bigint) AS pos FROM g),
o AS (SELECT *, CAST(CASE WHEN pos > 0 AND {duck.draw('clip_id', 42)} < 500000 THEN CASE WHEN {duck.draw('clip_id', 43)} < 200000 THEN room ELSE floor(room * {duck.draw('clip_id', 44)} / 1000000.0) END ELSE 0 END AS bigint) AS overlap_ms
  FROM (SELECT *, lag(dur_ms - vad_end_ms) OVER (PARTITION BY seq_id ORDER BY pos) + vad_start_ms + 200 AS room FROM s) x),
m AS (SELECT *, coalesce(sum(dur_ms - overlap_ms) OVER (PARTITION BY seq_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - overlap_ms AS shift FROM o),
t AS (SELECT seq_id, pos, clip_id, sentence, CAST(vad_start_ms + shift AS bigint) / 1000.0::double AS s, CAST(CASE WHEN vad_end_ms > 0 THEN vad_end_ms ELSE dur_ms END + shift AS bigint) / 1000.0::double AS e FROM m),
u AS (SELECT *, lag(e) OVER (PARTITION BY seq_id ORDER BY pos) AS p FROM t)
SELECT seq_id, pos, clip_id, CASE WHEN s <= p THEN p + 0.02::double ELSE s END AS start_s, e AS end_s, {duck.normalize('sentence')} AS text FROM u""")
def _(s, d):
    return fuse_clips(fixture(s, d, fx.CLIPS))
