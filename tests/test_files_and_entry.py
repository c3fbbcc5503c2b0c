"""Sources, sinks, pipelines, streaming, and the queries against DuckDB."""

import json
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cueflow.plans import catalogue
from cueflow.plans.pipelines import Config, fuse_clips
from cueflow.sources import subtitles, tables
from cueflow.streaming import records as stream

SF = "/root/testdata/sf0.001"
SRT = "1\n00:00:01,000 --> 00:00:02,000\nHallo\nWelt\n\n2\n00:00:03,000 --> 00:00:04,000\nx\n\n3\n00:00:05,000 --> 00:00:06,000\nlast\nline\n"
VTT = "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n<font color='x'>* Jauchzer *</font>\n\n00:00:03.000 --> 00:00:04.000\nHello (World)\n\n00:00:05.000 --> 00:00:06.000\n.\n\n00:00:07.000 --> 00:00:08.000\ny"


def test_parse_subtitles(spark):
    files = spark.createDataFrame([("s", "srt", SRT), ("v", "vtt", VTT), ("bad", "srt", "1\n00:01 --> 00:02\nab\n\n"), ("none", "srt", None)], "track_id string, format string, content string")
    loose, strict = subtitles.parse_cues(files), subtitles.parse_cues(files, strict_srt_tail=True)
    of = lambda df, t: [(r.start_ms, r.end_ms, r.text) for r in df.filter(F.col("track_id") == t).orderBy("cue_idx").collect()]
    assert of(loose, "s") == [(1000, 2000, "Hallo Welt"), (5000, 6000, "last line")] and of(strict, "s")[-1] == (5000, 6000, "last")
    assert [t for *_, t in of(loose, "v")] == ["<font color='x'>* Jauchzer *</font>", "Hello (World)", "y"]
    good, wrong = subtitles.parse_errors(loose)
    assert {r.track_id for r in wrong.collect()} == {"bad"} and {r.track_id for r in good.collect()} == {"s", "v"}


def test_folder_and_best_transcripts(spark, tmp_path):
    (tmp_path / "a.srt").write_text(SRT)
    (tmp_path / "a.vtt").write_text(VTT)
    (tmp_path / "b.vtt").write_text(VTT)
    found = subtitles.read_subtitles(spark, str(tmp_path))
    audio = spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")
    best, missing = subtitles.best_transcripts(audio, found)
    assert {(r.stem, r.transcript_format) for r in best.collect()} == {("a", "srt"), ("b", "vtt")} and [r.stem for r in missing.collect()] == ["c"]


def test_tables(spark, tmp_path):
    (tmp_path / "one.tsv").write_text('path\tsentence\tclient_id\na.mp3\tHallo "Du"\tk1\nb.mp3\tZwei\n')
    (tmp_path / "two.tsv").write_text("clip_path\tsentence\nc.mp3\tDrei\n")
    got = sorted(tuple(r)[1:] for r in tables.read_clips(spark, [(str(tmp_path / "one.tsv"), "/clips/", 1000), (str(tmp_path / "two.tsv"), "/x", 1000)]).collect())
    assert [(p, c) for p, _, c in got] == [("/clips/a.mp3", "k1"), ("/clips/b.mp3", None), ("/x/c.mp3", "0")]
    (tmp_path / "m.tsv").write_text("srt_path\taudio_path\tlanguage\ns/1.srt\ta/rec.1.wav\t\n")
    assert tuple(tables.read_manifest(spark, str(tmp_path / "m.tsv")).first()) == ("rec.1", "s/1.srt", "a/rec.1.wav", "de")
    (tmp_path / "plain.tsv").write_text("a.wav\tein Text\nschlecht\nb.wav\t" + "wort " * 220 + "\n")
    assert [r.audio_path for r in tables.read_plain(spark, str(tmp_path / "plain.tsv")).collect()] == ["a.wav"]
    records = spark.createDataFrame([("a", "ü", "de", "")], tables.RECORD)
    tables.write_records(records, str(tmp_path / "out"))
    lines = [line for p in (tmp_path / "out").glob("part-*") for line in p.read_text().splitlines()]
    assert json.loads(lines[0]) == {"audio_path": "a", "text": "ü", "language": "de", "prompt": ""} and "ü" in lines[0]
    with pytest.raises(Exception, match="exist"):
        tables.write_records(records, str(tmp_path / "out"))
    tables.write_dataset(tables.as_audio(tables.read_records(spark, str(tmp_path / "out"))), str(tmp_path / "set"))
    row = spark.read.parquet(str(tmp_path / "set")).first()
    assert row.audio.path == "a" and row.audio.bytes is None and row.split == "train"
    tables.write_rejects(spark.createDataFrame([("x", "kept"), ("y", "bad_examples")], "text string, disposition string"), str(tmp_path / "rejects"))
    assert [p.name for p in (tmp_path / "rejects").glob("disposition=*")] == ["disposition=bad_examples"]
    srt, plain = tables.materialised(spark.createDataFrame([("a", "s", None), ("b", None, "")], "id string, srt string, client_id string"))
    assert [r.id for r in srt.collect()] == ["a"] and plain.first().client_id == "0"
    assert tables.without_paths(spark.createDataFrame([(1, 2)], "a int, clip_path int")).columns == ["a"]
    assert tuple(tables.exported(spark.createDataFrame([("d/a.b.wav", "Ja")], "path string, sentence string")).first()) == ("a.b.mp3", "Ja.")


def test_tab_separated_values_come_back(spark, tmp_path):
    values = [' "a" ', "x\ty", "one\ntwo", '"', "\\", "\\\"", " lead", "trail ", "'", None, "äö"]
    rows = spark.createDataFrame(list(enumerate(values)), "k int, text string")
    tables.write_tsv(rows, f"{tmp_path}/rows")
    assert {int(r.k): r.text for r in tables.read_tsv(spark, f"{tmp_path}/rows").collect()} == dict(enumerate(values))
    tables.write_rejects(rows.withColumn("disposition", F.lit("bad_examples")), f"{tmp_path}/rejects")
    assert {int(r.k): (r.text, r.disposition) for r in tables.read_tsv(spark, f"{tmp_path}/rejects").collect()} == {k: (t, "bad_examples") for k, t in enumerate(values)}


def test_metadata_gets_each_row_its_own_transcript(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("file\tsrt_path\tclip_path\na.mp3\ts/1.srt\tx\nb.mp3\ts/2.srt\ty\nc.mp3\ts/3.srt\tz\n")
    (tmp_path / "n.tsv").write_text("path\tsentence\tsrt_path\na.mp3\tJa\ts/1.srt\n")
    files = spark.createDataFrame([("s/1.srt", SRT), ("s/2.srt", SRT.replace("Hallo", "Tag"))], "srt_path string, srt string")
    rows = {r.audio: r for r in tables.read_metadata(spark, f"{tmp_path}/m.tsv", files, "file").collect()}
    assert rows["a.mp3"].asDict() == {"audio": "a.mp3", "sentence": "Hallo Welt last line", "srt": SRT}
    assert (rows["b.mp3"].sentence, rows["b.mp3"].srt) == ("Tag Welt last line", SRT.replace("Hallo", "Tag")) and (rows["c.mp3"].sentence, rows["c.mp3"].srt) == (None, None)
    assert tables.read_metadata(spark, f"{tmp_path}/n.tsv", files).first().asDict() == {"audio": "a.mp3", "sentence": "Ja", "srt": SRT}
    assert tables.read_metadata(spark, f"{tmp_path}/n.tsv").columns == ["audio", "sentence"]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.json").write_text("\n".join(json.dumps({"audio_path": str(i), "text": t, "language": "de", "prompt": ""}) for i, t in enumerate(["kurz", "ein zwei drei vier fünf sechs sieben acht neun zehn"])))
    stream.write_disposed(stream.read_records(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert {r.audio_path: r.disposition for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"0": "bad_examples", "1": "kept"}


def test_config(tmp_path):
    assert Config.of({"filter_words": None, "unknown": 1, "silence_every": 2}) == Config(silence_every=2)
    with pytest.raises(ValueError):
        Config(resolution_ms=30)
    with pytest.raises(FileNotFoundError):
        Config.load(str(tmp_path / "none.yaml"))


def test_fused_sequences_do_not_overlap(spark):
    clips = catalogue.fixture(spark, SF, catalogue.fx.CLIPS)
    rows = sorted(fuse_clips(clips, Config(clips_per_sequence=4)).collect(), key=lambda r: (r.seq_id, r.pos))
    assert len(rows) == clips.count()
    assert all(a.end_s < b.start_s for a, b in zip(rows, rows[1:]) if a.seq_id == b.seq_id)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_queries_equal_duckdb(spark):
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")

    def plain(value):
        return round(float(value), 6) if isinstance(value, float) or hasattr(value, "as_tuple") else value

    wrong = []
    for name, query in catalogue.QUERIES.items():
        df = query(spark, SF)
        rows = df.collect()
        if name not in catalogue.ORACLE:
            continue
        other = con.execute(catalogue.ORACLE[name])
        columns = [c[0] for c in other.description]
        order = sorted(columns)
        mine = sorted(repr([plain(r[c]) for c in order]) for r in rows)
        theirs = sorted(repr([plain(r[columns.index(c)]) for c in order]) for r in other.fetchall())
        if sorted(df.columns) != order or mine != theirs or not mine:
            wrong.append(name)
    assert not wrong


PAST = "wort " * 60 + "das das geht geht [weg] 12 000 so"


def test_queries_see_what_comes_after_the_prefix(spark, tmp_path):
    spark.createDataFrame([(7, PAST + " zzz", "de", "s")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, t, "user", PAST) for t in range(2)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    run = lambda name: catalogue.QUERIES[name](spark, str(tmp_path)).collect()
    start = "Hm bzw. etc. , x ?  ! "
    assert run("normalize_documents")[0].result.endswith("wort das das geht geht 12'000 so zzz")
    assert run("collapse_ngrams")[0].result == "Hm bzw. etc. , x ? ! wort das geht [weg] 12 000 so zzz"
    assert run("srt_text")[0].srt.count(PAST) == 2
    assert [r.word for r in run("record_filter_words")] == ["zzz"]
    assert [r.word for r in run("residual_check")] == ["zzz"]
    assert run("remove_brackets")[0].result == start + PAST.replace("[weg]", "") + " zzz"
    assert run("tokenize_text")[0].result == "|".join((start + PAST + " zzz").split())
    for name in ("standardize_text", "triple_dots", "capitalization", "currencies", "comma_decimal", "abbreviations", "strip_text", "leading_space", "sentence_punctuation"):
        assert run(f"{name}")[0].result.rstrip(".").endswith("12 000 so zzz"), name
    for name in ("blank_drop", "silence_subsample"):
        assert PAST in run(f"{name}")[0].text, name
    for name, column in (("fuse_long_captions", "text"), ("parse_subtitles", "text"), ("series_sentences", "sentence")):
        assert PAST in run(f"{name}")[0][column], name


def test_repetitive_and_short_records_are_bad_examples(spark, tmp_path):
    good = "Heute gehen wir alle zusammen noch einmal langsam durch Zürich nach Hause"
    texts = {1: "immer wieder " * 60, 2: good, 3: "kurz", 4: "", 5: good + " und der", 6: good.replace("Heute", "Morgen"), 7: "eins zwei " * 200}
    spark.createDataFrame([(i, t, "de", "s") for i, t in texts.items()], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    records = [(i, f"<|0.00|> {t}<|2.00|>") for i, t in texts.items()] + [(-1 - i, "") for i in texts if i % 3 == 0]

    def bad(own):
        plain = re.sub(r"<\|[^|]+\|>", "", own)
        return len(own.split()) <= 8 or len(plain) / len(zlib.compress(plain.encode())) >= 2.4

    kept = {i for i, t in records if not bad(t)}
    assert kept == {2, 5, 6}
    assert {r.doc_id for r in catalogue.QUERIES["bad_records"](spark, str(tmp_path)).collect()} == {i for i, _ in records} - kept
    counts = {r.disposition: r.records for r in catalogue.QUERIES["disposition_counts"](spark, str(tmp_path)).collect()}
    assert counts == {"bad_examples": len(records) - 3, "filtered_der_examples": 1, "kept": 2}


def test_transcripts_of_all_stems(spark, tmp_path):
    spark.range(1000).selectExpr("id AS doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(600).selectExpr("id AS page_id").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.stem: r.format for r in catalogue.QUERIES["best_transcript_per_stem"](spark, str(tmp_path)).collect()}
    assert found == {str(i): "srt" if i % 2 else "vtt" for i in range(600)}
    missing = [r.stem for r in catalogue.QUERIES["missing_transcripts"](spark, str(tmp_path)).collect()]
    assert sorted(missing) == sorted(str(-1 - i) for i in range(0, 600, 5))


def test_only_the_last_fused_sequence_is_short(spark):
    clips = catalogue.fixture(spark, SF, catalogue.fx.CLIPS)
    few = clips.filter("clip_id <= 10")
    assert sorted(r["count"] for r in fuse_clips(few, Config(clips_per_sequence=16)).groupBy("seq_id").count().collect()) == [few.count()]
    sizes = [r["count"] for r in fuse_clips(clips, Config(clips_per_sequence=4)).groupBy("seq_id").count().collect()]
    assert sum(sizes) == clips.count() and len(sizes) == -(-sum(sizes) // 4) and sum(n < 4 for n in sizes) <= 1
