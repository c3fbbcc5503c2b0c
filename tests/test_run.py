"""The pipelines over files."""

import random
import wave

import numpy as np
import pytest

from cueflow.plans import run


def write_wave(path, seconds):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(16_000)
        w.writeframes((np.sin(np.arange(int(seconds * 16_000)) / 9) * 9000).astype("<i2").tobytes())


SRT = "1\n00:00:01,000 --> 00:00:04,000\neins zwei drei vier fünf sechs\n\n2\n00:00:05,000 --> 00:00:07,000\nein Geheimnis hier\n\n3\n00:00:08,000 --> 00:00:10,000\nsieben acht neun zehn elf zwölf\n\n"


@pytest.mark.parametrize("manifest", [False, True])
def test_split(spark, tmp_path, manifest):
    (tmp_path / "audio").mkdir(), (tmp_path / "srt").mkdir()
    write_wave(tmp_path / "audio/a.wav", 12)
    write_wave(tmp_path / "audio/lonely.wav", 1)
    (tmp_path / "srt/a.srt").write_text(SRT)
    (tmp_path / "srt/broken.srt").write_text("1\n00:01 --> 00:02\nab\n\n")
    options = {"out_folder": str(tmp_path / "out"), "transcripts_folder": str(tmp_path / "srt"), "audio_folder": str(tmp_path / "audio"), "filter_words": ["geheim"]}
    if manifest:
        rows = [f"{tmp_path}/srt/{n}.srt\t{tmp_path}/audio/{n}.wav\tde" for n in ("a", "broken", "none")]
        (tmp_path / "m.tsv").write_text("\n".join(["srt_path\taudio_path\tlanguage", *rows, ""]))
        options["manifest"] = str(tmp_path / "m.tsv")
    found = sorted((r.audio_path, r.text, r.disposition) for r in run.split(spark, options).collect())
    base = f"{tmp_path}/out/audio/a"
    assert found == [(f"{base}/0.wav", "<|1.00|> eins zwei drei vier fünf sechs<|4.00|>", "bad_examples"), (f"{base}/7000.wav", "<|1.00|> sieben acht neun zehn elf zwölf<|3.00|>", "bad_examples")]
    assert spark.read.parquet(f"{tmp_path}/out/missing").count() == 1 and spark.read.parquet(f"{tmp_path}/out/parse_errors").count() == int(manifest)
    assert spark.read.option("sep", "\t").csv(f"{tmp_path}/out/diverted", header=True).first().text == "ein Geheimnis hier"


def test_fuse(spark, tmp_path):
    (tmp_path / "clips").mkdir()
    for i in range(6):
        write_wave(tmp_path / f"clips/{i}.wav", 1 + i / 10)
    (tmp_path / "s.tsv").write_text("path\tsentence\tclient_id\n" + "".join(f"{i}.wav\tSatz {i}\tk{i % 2}\n" for i in range(6)))
    options = {"out_folder": str(tmp_path / "out"), "sentence_tsvs": [str(tmp_path / "s.tsv")], "clips_folders": [str(tmp_path / "clips")], "clips_per_sequence": 3}
    found = run.fuse(spark, options).collect()
    assert sorted(r.text for r in found) == [f"Satz {i}" for i in range(6)] and all(r.end_s > r.start_s for r in found)
    assert spark.read.text(f"{tmp_path}/out/srt").filter("value like '%-->%'").count() == 6
    timed = spark.read.parquet(f"{tmp_path}/out/sequences").collect()
    for seq in {r.seq_id for r in timed}:
        with wave.open(f"{tmp_path}/out/audio/{seq}.wav") as w:
            assert w.getframerate() == 16_000 and w.getnframes() == sum(r.dur_ms - r.overlap_ms for r in timed if r.seq_id == seq) * 16


def test_split_writes_the_audio_of_kept_segments(spark, tmp_path):
    (tmp_path / "audio").mkdir(), (tmp_path / "srt").mkdir()
    write_wave(tmp_path / "audio/a.wav", 70)
    pick = random.Random(1)
    words = ["".join(pick.choice("abcdefghijklmnoprstuvwz") for _ in range(pick.randrange(3, 10))) for _ in range(120)]
    cues = [f"{k + 1}\n00:00:{8 * k + 1:02d},000 --> 00:00:{8 * k + 7:02d},000\n{' '.join(words[12 * k : 12 * k + 12])}\n\n" for k in range(7)]
    (tmp_path / "srt/a.srt").write_text("".join(cues))
    options = {"out_folder": str(tmp_path / "out"), "transcripts_folder": str(tmp_path / "srt"), "audio_folder": str(tmp_path / "audio"), "fuse_captions": True}
    kept = run.split(spark, options).filter("disposition = 'kept'").collect()
    assert len(kept) >= 2
    with wave.open(str(tmp_path / "audio/a.wav")) as w:
        whole = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(float)
    whole *= 32767 * 10 ** (-0.1 / 20) / np.abs(whole).max()
    rows = {r.audio.path: r for r in spark.read.parquet(f"{tmp_path}/out/dataset").collect()}
    for r in kept:
        with wave.open(r.audio_path) as w:
            own = np.frombuffer(w.readframes(w.getnframes()), "<i2")
        want = whole[r.seg_start * 16 : min(r.seg_end * 16, r.seg_start * 16 + 480_000)]
        assert len(own) == len(want) and np.abs(own - want).max() < 2
        assert rows[r.audio_path].text == r.text and bytes(rows[r.audio_path].audio.bytes) == open(r.audio_path, "rb").read()
    assert spark.read.parquet(f"{tmp_path}/out/cues_fused").count() == 7


def test_series_files(spark, tmp_path):
    from cueflow.sources import audio, subtitles, tables

    for name in ("one/a", "one/b", "two/a"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.srt").write_text(SRT)
        (tmp_path / f"{name}.mp3").write_bytes(b"x")
    files, info = audio.series_files(spark, str(tmp_path))
    got = {(r.series, r.audio.rsplit("/", 2)[-2:][1], r.sentence[:13]) for r in tables.series(subtitles.parse_cues(files), info).collect()}
    assert got == {("one", "a.mp3", "eins zwei dre"), ("one", "b.mp3", "eins zwei dre"), ("two", "a.mp3", "eins zwei dre")}
    tables.write_tsv(info, str(tmp_path / "tsv"))
    assert spark.read.option("sep", "\t").option("multiLine", True).csv(str(tmp_path / "tsv"), header=True).count() == 3
    (tmp_path / "two/a.mp3").unlink()
    with pytest.raises(FileNotFoundError):
        audio.series_files(spark, str(tmp_path))
