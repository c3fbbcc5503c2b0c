"""Text and time functions on known values."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cueflow.functions import fixed, providers, text, times

CASES = [
    (text.expand_abbreviations, " z.B. ", " zum Beispiel "), (text.expand_abbreviations, "Das ist ein dumz.B.er Test.", "Das ist ein dumz.B.er Test."), (text.expand_abbreviations, " etc. ", " et cetera "),
    (text.expand_abbreviations, "Heute könnten wir z.B. in die Bergwelt reisen.", "Heute könnten wir zum Beispiel in die Bergwelt reisen."), (text.expand_abbreviations, "abc", "abc"), (text.expand_abbreviations, "ÄHM ja", " ja"),
    (text.standardize, "Hello—World “quoted”", 'Hello-World "quoted"'), (text.standardize, "a b​c <i>d</i> Renter/, innen", "a bc d Renterinnen"),
    (text.fix_capitals, " HoUse Test ", "House Test"), (text.fix_capitals, " USA test ", "USA test"), (text.fix_capitals, "", ""),
    (text.tidy_dots, "ABC... Test", "ABC... Test"), (text.tidy_dots, "a [ ... ] b …… c ? d", "a ... b ... c? d"), (text.tidy_dots, " x .... , y ", "x ... , y"),
    (text.remove_bracketed, "Keep [remove this] text", "Keep  text"), (text.remove_bracketed, "Keep (remove this) text", "Keep  text"), (text.remove_bracketed, "<font color='#fff'>* Hallo *</font>", ""),
    (text.remove_bracketed, "<font color='#fff'>Jauchzer</font>", "Jauchzer"), (text.remove_bracketed, "Keep <FONT color='#fff'>Jauchzer</font> text", "Keep Jauchzer text"), (text.remove_bracketed, "(a\nb) (c\rd)", "(a\nb)"),
    (lambda c: F.array_join(text.tokens(c), "|"), "one two ... three", "one|two|...|three"), (lambda c: F.array_join(text.tokens(c), "|"), "...a b...", "...|a|b..."),
    (text.collapse_repeats, "... Triage ... Triage ... Triage ... Triage ... Triage", "... Triage"), (text.collapse_repeats, "Heute gehen wir an den See ... See ... See ... See ... See", "Heute gehen wir an den See ... See"),
    (text.collapse_repeats, "Heute gehen wir an den See und Baden da! Jawohl, es ist sonnig.", "Heute gehen wir an den See und Baden da! Jawohl, es ist sonnig."), (text.collapse_repeats, "", ""), (text.collapse_repeats, "a a b c d b c d", "a b c d"),
    (text.numbers, "150 000 3000 1,234 $", "150'000 3'000 1.234 Dollar"), (text.numbers, "1 000 000 $", "1'000'000 Dollar"), (text.numbers, "1 000,50 €", "1'000.50 Euro"), (text.numbers, "1000,50 €", "1'000.50 Euro"),
    (text.numbers, "10,3 Mio.", "10.3 Mio."), (text.numbers, "14,25 %", "14.25 Prozent"), (text.numbers, "14,23", "14.23"), (text.numbers, "1⁄2", "0.5"), (text.numbers, "1/0 und 007", "1/0 und 7"), (text.numbers, "2020", "2'020"),
    (text.numbers, "US$ INDUSTRY", "Dollarollar INDUSTürkische Lira"),
    (text.normalize, "Hallo [remove]ABC... Test z.B. 150 000 €", "Hallo ABC... Test zum Beispiel 150'000 Euro"), (text.normalize, "½ ist ’viel’\n x", "0.5 ist 'viel' x"),
    (text.finish_sentence, '"Ja"', "Ja."), (text.finish_sentence, "Ja?", "Ja?"), (text.finish_sentence, '"', ""), (text.finish_sentence, "", ""),
    (text.safe_id, " a/b\\c d ", "a_b_c_d"), (text.safe_id, "._.", "sample"), (text.safe_id, "ü.x-", "x-"),
    (text.strip, " \t a b \x1c\n", "a b"),
    (lambda c: text.leading_space(c, F.lit("de")), "x", " x"), (lambda c: text.leading_space(c, F.lit("ja")), "x", "x"),
    (lambda c: text.french_hint(c).cast("string"), "<|0.00|> j’ai", "true"), (lambda c: text.french_hint(c).cast("string"), "der Test", "false"), (lambda c: text.english_hint(c).cast("string"), "It's", "true"),
    (lambda c: F.round(text.compression_ratio(c), 3).cast("string"), "<|0.00|>", "0.0"), (lambda c: F.round(text.compression_ratio(c), 3).cast("string"), "a" * 100, "8.333"),
    (lambda c: times.parse_time(c).cast("string"), "01:02:03,5", "3723005"), (lambda c: times.parse_time(c).cast("string"), "02:03.500", None), (lambda c: times.parse_time(c).cast("string"), "00:00:10.250", "10250"),
    (lambda c: times.time_token(c.cast("long"), F.lit(0)), "1000", "<|1.00|>"), (lambda c: times.time_token(c.cast("long"), F.lit(0)), "30", "<|0.04|>"), (lambda c: times.time_token(c.cast("long"), F.lit(0)), "10", "<|0.00|>"),
    (lambda c: times.time_token(c.cast("long"), F.lit(0)), "30001", None), (lambda c: times.time_token(c.cast("long"), F.lit(5)), "4", None),
    (lambda c: times.srt_time(c.cast("double")), "-0.5", "23:59:59.500"), (lambda c: times.srt_time(c.cast("double")), "3661.0429", "01:01:01.042"), (lambda c: times.srt_time(c.cast("double")), "86400", "00:00:00.000"),
]


def test_known_values(spark):
    for k in range(0, len(CASES), 12):
        part = CASES[k : k + 12]
        row = spark.createDataFrame([tuple(c[1] for c in part)], ", ".join(f"c{i} string" for i in range(len(part)))).select(*(c[0](F.col(f"c{i}")).alias(f"r{i}") for i, c in enumerate(part))).first()
        assert list(row) == [c[2] for c in part]


def test_nulls_stay_null(spark):
    row = spark.createDataFrame([(None,)], "t string").select(text.normalize(F.col("t")).alias("a"), text.collapse_repeats(F.col("t")).alias("b"), text.compression_ratio(F.col("t")).alias("c")).first()
    assert row[0] is None and row[2] is None


def test_abbreviations_as_a_pattern_at_a_time(spark):
    pick = random.Random(1)
    parts = [*list(fixed.ABBREVIATIONS)[:50], "x", "  ", " "]
    texts = ["".join(pick.choice(parts) + pick.choice(["", " "]) for _ in range(8)) for _ in range(200)]
    want = []
    for t in texts:
        for short, full in fixed.ABBREVIATIONS.items():
            t = re.sub(rf"(^|\s)({re.escape(short)})(?=\s|$)", lambda m: m[1] + full, t, flags=re.I)
        want.append(t)
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.expand_abbreviations(F.col("t"))).collect()
    assert [t for _, t in sorted(got)] == want


def test_abbreviations_that_make_or_share_others(spark):
    pairs = {"a.": "b. x", "b.": "$c\\1", "x y": "", "y": "z", "A. b.": "a.", "e": "", "z z": "a."}
    pick = random.Random(2)
    texts = [pick.choice(" ").join(pick.choice(["a.", "A.", "b.", "x", "y", "X", "e", "z", "", "f"]) for _ in range(9)) for _ in range(300)] + ["", " "]
    want = []
    for t in texts:
        for short, full in pairs.items():
            t = re.sub(rf"(^|\s)({re.escape(short)})(?=\s|$)", lambda m: m[1] + full, t, flags=re.I)
        want.append(t)
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.expand_abbreviations(F.col("t"), pairs)).collect()
    assert [t for _, t in sorted(got)] == want


def test_ring_speech():
    assert providers.ring_speech([False] * 5 + [True] * 12 + [False] * 12, 30, 150, 900) == (150, 630)
    assert providers.ring_speech([False] * 20, 30, 150, 600) == (0, None)
    assert providers.ring_speech([True] * 20, 30, 150, 607) == (0, 607)
    assert providers.ring_speech(([True] * 6 + [False] * 6) * 2, 30, 150, 720) == (0, 660)


def test_audio_functions(spark):
    import io
    import wave

    import numpy as np

    file = io.BytesIO()
    with wave.open(file, "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(8000)
        wave_form = (np.sin(np.arange(8000) / 5) * 8000 * (np.arange(8000) > 4000)).astype("<i2")
        w.writeframes(np.repeat(wave_form, 2).tobytes())
    df = spark.createDataFrame([(bytearray(file.getvalue()),)], "content binary")
    row = df.select(providers.wav_duration_ms("content").alias("ms"), providers.decode_wav("content").alias("x")).select("ms", F.size("x").alias("n"), providers.energy_activity("x").alias("v"), F.size(providers.cut_samples(F.col("x"), F.lit(100), F.lit(350))).alias("cut"), F.array_max("x").alias("peak")).first()
    assert (row.ms, row.n, row.cut) == (1000, 16000, 4000) and 450 <= row.v.vad_start_ms <= 510 and row.v.vad_end_ms >= 960 and row.peak == pytest.approx(0.988, abs=0.01)
    own = df.select(providers.decode_wav("content").alias("x"))
    again = own.select(providers.decode_wav(providers.encode_wav("x")).alias("y"), providers.ring_activity(providers.voiced_frames(F.col("x")), F.lit(1000)).alias("r")).first()
    assert len(again.y) == 16000 and 400 <= again.r.start_ms <= 540 and again.r.end_ms == 1000
    assert providers.mono(np.ones((2, 9))).shape == (9,) and providers.mono(np.ones((9, 2))).shape == (9,) and providers.mono(np.ones(5, "i2")).dtype == np.float32
    laid = spark.createDataFrame([([[0.1] * 160, [0.2] * 320], [0.0, 5.0])], "c array<array<float>>, o array<double>").select(providers.concatenate_overlaid("c", "o").alias("x")).first().x
    assert len(laid) == 400 and laid[100] == pytest.approx(0.3)
