"""Tables of odd values, written and read again."""

from cueflow.sources import tables


def test_empty_sentences_stay_empty(spark, tmp_path):
    values = ["", None, "a", '"', '""', " ", "a\nb", "\t", "a\r\nb", "\x00", "\x00\"\n", "a\"\x00b\n"]
    rows = spark.createDataFrame([(f"{k}.wav", v) for k, v in enumerate(values)], "path string, sentence string")
    tables.write_tsv(rows.coalesce(1), str(tmp_path / "own"))
    found = tables.read_clips(spark, [(str(tmp_path / "own"), "c", 1000)]).collect()
    assert {r.path: r.sentence for r in found} == {f"c/{k}.wav": v for k, v in enumerate(values)}
    (tmp_path / "other.tsv").write_text('path\tsentence\tclient_id\nx\t\t7\ny\t""\n')
    found = tables.read_clips(spark, [(str(tmp_path / "other.tsv"), "c", 1000)]).collect()
    assert {(r.path, r.sentence, r.client_id) for r in found} == {("c/x", None, "7"), ("c/y", "", None)}
