"""Cue, span and segment operators on known values and against plain code."""

import random

import pytest
from pyspark.sql import functions as F

from cueflow.operators import assembly, cues, quality, segments, spans

CUES = "track_id string, cue_idx long, start_ms long, end_ms long, text string"


def table(spark, *tracks):
    return spark.createDataFrame([(str(t), i, *c) for t, own in enumerate(tracks) for i, c in enumerate(own)], CUES)


FUSE = [
    ([(1000, 4000, "Hello"), (4000, 8000, "World")], (), [(1000, 8000, "Hello World")]), ([(1000, 4000, "Hello"), (5000, 12000, "World")], (), None), ([(0, 1000, "x" * 31), (1000, 2000, "y" * 38)], (), None),
    ([(1000, 4000, "Hello"), (5000, 8000, "This has PII"), (8000, 9000, "World")], ("PII",), None), ([(1000, 4000, "Hello"), (4000, 5000, "PII data"), (5000, 6000, "World")], ("PII",), None),
    ([(1000, 2000, "Hello"), (3000, 8000, "World")], (), [(1000, 8000, "Hello World")]), ([(1000, 4000, "Hello"), (4000, 5000, "This has pii in lowercase"), (5000, 6000, "World")], ("PII",), None), ([(1, 2, "One")], (), None),
]


@pytest.mark.parametrize(("own", "skip", "want"), FUSE)
def test_fuse_captions(spark, own, skip, want):
    got = cues.fuse_captions(table(spark, own), skip_words=skip).orderBy("cue_idx").collect()
    assert [(r.start_ms, r.end_ms, r.text) for r in got] == (want or own)


def test_fuse_no_captions(spark):
    assert cues.fuse_captions(table(spark, [])).count() == 0


SEGMENTS = [
    ([(1000, 4000, "Hello"), (28000, 32000, "World"), (40000, 45000, "Foo")], 60000, [(0, "<|1.00|> Hello<|4.00|><|28.00|>", ""), (28000, "<|0.00|> World<|4.00|><|12.00|> Foo<|17.00|>", "<|1.00|> Hello<|4.00|><|28.00|>")]),
    ([(70000, 71000, "A")], 100000, [(0, "", ""), (30000, "", ""), (60000, "<|10.00|> A<|11.00|>", "")]), ([(0, 2000, "a b"), (10000, 45000, "long")], 100000, [(0, "<|0.00|> a b<|2.00|><|10.00|>", "")]),
]


@pytest.mark.parametrize(("own", "stop", "want"), SEGMENTS)
def test_segment_records(spark, own, stop, want):
    whole = table(spark, own).select("*", F.lit(0).cast("long").alias("span_idx"), F.lit(0).cast("long").alias("span_start"), F.lit(stop).cast("long").alias("span_end"), F.lit("de").alias("language"))
    placed = segments.positioned(whole)
    got = segments.segment_records(placed, segments.segment_boundaries(placed)).orderBy("seg_idx").collect()
    assert [(r.seg_start, r.text, r.prompt) for r in got] == want


def test_prompts_are_the_suffix_that_reaches_the_limit(spark):
    pick = random.Random(3)
    nodes, k = [], 0
    for seg in range(60):
        for _ in range(pick.randrange(1, 4)):
            nodes.append(("a", 0, seg, seg // 25, k, f"[{k}]", pick.randrange(1, 90)))
            k += 1
    got = {r.seg_idx: r.so_far for r in segments.prompts(spark.createDataFrame(nodes, "track_id string, span_idx long, seg_idx long, prompt_group long, pos long, node_text string, n_tokens long")).collect()}
    for seg in range(60):
        own = [n for n in nodes if n[2] <= seg and n[3] == seg // 25]
        text, after = "", 0
        for n in reversed(own):
            if after >= 223:
                break
            text, after = n[5] + text, after + n[6]
        assert got[seg] == text


def test_cut_initial_audio_and_invalid_segments():
    found = lambda cues, cut=False: list(segments.boundaries(*map(list, zip(*cues)), 0, 10**6, cut))
    assert found([(5000, 6000, "a")], True)[0][0] == 4000 and found([(5000, 6000, "a")])[0][0] == 0
    got = found([(0, 1000, "a"), (900, 2000, "b"), (40_000, 41_000, "c")])
    assert [(x[0], x[4], x[5]) for x in got] == [(0, False, 0), (30_000, True, 1)]
    assert [x[4] for x in found([(k * 1000, k * 1000 + 500, "a") for k in range(3)])] == [False]


def test_spans(spark):
    tracks = spark.createDataFrame([("0", 100), ("1", 50), ("2", 10)], "track_id string, audio_ms long")
    bad = spark.createDataFrame([("0", 10, 20), ("0", 20, 30), ("0", 25, 28), ("0", 90, 200), ("0", 5, 5), ("0", None, 3), ("2", 0, 10)], "track_id string, start_ms long, end_ms long")
    assert sorted(map(tuple, spans.merge_intervals(bad).collect())) == [("0", 10, 30), ("0", 90, 200), ("2", 0, 10)]
    assert sorted(map(tuple, spans.safe_spans(tracks, bad).collect())) == [("0", 0, 0, 10), ("0", 1, 30, 90), ("1", 0, 0, 50)]
    own = table(spark, [(0, 10, "in"), (5, 31, "across"), (30, 90, "in"), (30, 95, "over")])
    assert sorted((r.cue_idx, r.span_idx) for r in spans.contained_cues(own, spans.safe_spans(tracks, bad)).collect()) == [(0, 0), (2, 1)]


def test_repeats_validity_and_repair(spark):
    own = table(spark, [(k * 10, k * 10 + 5, t) for k, t in enumerate("aaabbcbbb")], [(0, 5, "x"), (4, 9, "y")], [(10, 20, "x"), (15, 15, "y"), (30, 20, "z"), (40, 50, "w"), (60, 70, "  ")])
    assert [r.cue_idx for r in cues.drop_repeated_runs(own).filter("track_id = '0'").orderBy("cue_idx").collect()] == [3, 4, 5]
    assert {r.track_id: r.valid for r in cues.track_validity(own).collect()} == {"0": False, "1": False, "2": False}
    assert cues.track_validity(table(spark, [(0, 5, "x"), (5, 5, "x")])).first().valid
    got = cues.sanitize_cues(own).filter("track_id = '2'").orderBy("cue_idx").collect()
    assert [(r.start_ms, r.end_ms, r.text) for r in got] == [(10, 20, "x y"), (30, 50, "z w")]
    assert cues.sanitize_cues(table(spark, [(-100, -100, "a")])).first().error


def test_assembly_uses_each_clip_once_in_speaker_order(spark):
    clips = spark.createDataFrame([(i, f"s {i}", None if i % 11 == 0 else f"c{i % 5}", 2000 + i, 50, 1500 + i) for i in range(300)], "clip_id long, sentence string, client_id string, dur_ms long, vad_start_ms long, vad_end_ms long")
    runs = assembly.speaker_runs(clips, 500_000)
    placed = assembly.chunk_sequences(runs, 8, shards=3).collect()
    assert sorted(r.clip_id for r in placed) == list(range(300)) and {r.client_id for r in placed} == {"0", *(f"c{k}" for k in range(5))}
    assert all(0 <= r.pos < 8 for r in placed) and len({(r.seq_id, r.pos) for r in placed}) == 300
    for _, own in __import__("itertools").groupby(sorted(placed, key=lambda r: (r.client_id, r.run, r.nth)), lambda r: (r.client_id, r.run)):
        own = list(own)
        assert [r.nth for r in own] == list(range(own[0].nth, own[0].nth + len(own)))
    assert assembly.exact_sample(clips, "clip_id", 333).count() == 100


def test_srt_text(spark):
    captions = spark.createDataFrame([("a", 0, 0.5, 1.5, "x"), ("a", 1, 1.5, 3.0, "y")], "seq_id string, pos long, start_s double, end_s double, text string")
    assert assembly.srt_texts(captions).first().srt == "1\n00:00:00.500 --> 00:00:01.500\nx\n\n2\n00:00:01.520 --> 00:00:03.000\ny\n"


def test_disposition_order(spark):
    long = "ein zwei drei vier fünf sechs sieben acht neun zehn"
    rows = [(0, "kurz"), (1, f"le la {long}"), (2, f"the and {long}"), (3, f"secret {long}"), (4, long), (5, "na " * 200)]
    lang = F.when(F.col("id") == 1, "fr").when(F.col("id") == 2, "en").otherwise("de")
    out = quality.disposed(spark.createDataFrame(rows, "id int, text string"), ["Secret"], lang)
    assert [r.disposition for r in out.orderBy("id").collect()] == ["bad_examples", "french_examples", "english_examples", "filtered_Secret_examples", "kept", "bad_examples"]
    quality.assert_none_left(out.filter("disposition = 'kept'"), ["Secret"])
    with pytest.raises(ValueError):
        quality.assert_none_left(out, ["Secret"])
