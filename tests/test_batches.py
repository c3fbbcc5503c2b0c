"""Text steps on Arrow batches: few Python objects at a time, whatever the batch."""

import tracemalloc

import pyarrow as pa

from cueflow.functions import text


def most(function, array) -> tuple[list, float]:
    tracemalloc.start()
    out = function(array)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out.to_pylist(), peak


def test_words_become_objects_a_part_at_a_time():
    lists = [["a", "a", f"w{k}", "x", "y", "x", "y"] * 100 for k in range(2000)] + [None, [], ["b"]]
    found, peak = most(text._collapse.func, pa.array(lists, pa.list_(pa.string())))
    assert found == [" ".join(text.collapsed(x)) if x is not None else None for x in lists]
    assert peak < 40e6  # 1.4 million words would be over 80 MB
    assert text._collapse.func(pa.array(lists, pa.list_(pa.string()))[1990:2002]).to_pylist() == found[1990:2002]
    assert text._collapse.func(pa.array([], pa.list_(pa.string()))).to_pylist() == []


def test_texts_become_objects_a_part_at_a_time():
    texts = [f"{k * 7919} ﬁn 1/2 von 1000,50 $ " + "é" * 20_000 for k in range(1500)] + [None, "", "4700000001100 003"]
    for step, one in ((text._number_forms.func, text.number_forms), (text.nfkc.func, lambda t: t.replace("ﬁ", "fi"))):
        found, peak = most(step, pa.array(texts))
        assert found == [one(t) if t is not None else None for t in texts]
        assert peak < 30e6
    assert text.number_forms("4700000001100 003 1/0 und 1/4 €, 1000.5 x1000") == "4'700'000'001'100 3 1/0 und 0.25 Euro, 1'000.5 x1000"
