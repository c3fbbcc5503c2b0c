"""URL filters against brute force, and the pipeline's stages against plain code."""

import re

import pytest

from cueflow.llm.url_filters import RULES, host_edges, propagate, url_filters


def test_url_filters(spark):
    link = lambda *hosts: "".join(f"<a href='http://{h}/x'>" for h in hosts)
    urls = [
        ("http://A.Example.com/en/7?x", link("friend.org")), ("https://m.example.com/en/1#t", ""), ("http://x.net/de/9", link("x.org")), ("http://spam.org/a", link("example.net", "example.net")),
        ("http://friend.org/a", link("deep.org")), ("http://deep.org", ""), ("http://example.net/de/8", None), (None, None), ("no scheme", ""), ("http://lonely.de/?q#f", link("lonely.de")),
        ("http://com/en/", ""), ("http://notexample.com/en/7", ""), ("http://a.com/En/", ""), ("", ""), ("http://b.org?en/://x", ""),
    ]
    pages = spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(urls)], "page_id long, url string, html string, host string, rule string")
    got = {r.page_id: r for r in url_filters(pages).collect()}
    assert len(got) == len(urls)
    for i, (url, _) in enumerate(urls):
        m = re.search("^.*?://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [(len(rule), rule, verdict) for verdict, rule in RULES if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[rule.index("/") :])]
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, max(fits)[1] if fits else None)
        if fits:
            assert got[i].verdict == max(fits)[2]
    assert got[3].verdict == "block" and got[4].verdict == got[5].verdict == got[9].verdict == "allow"


def test_production_rules():
    assert RULES == (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))


@pytest.mark.parametrize("edges", [
    [("a", "b"), ("b", "c"), ("c", "a"), ("d", "c"), ("b", "d")], [("a", "b"), ("b", "e"), ("b", "c"), ("d", "c")], [(f"h{i}", f"h{i + 1}") for i in range(30)] + [("a", "h0")],
])
def test_propagate_is_personalised_pagerank(spark, edges):
    """Against a dense solution, in which mass at hosts without links returns to the seeds; hosts at the end of a chain of 30 links are reached."""
    import numpy as np

    hosts = sorted({h for e in edges for h in e} | {"a", "c"})
    seeds = {"a": (1.0, 0.0), "c": (0.0, 1.0)}
    got = {r.host: (r.trust, r.distrust) for r in propagate(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust double, distrust double"), 1e-9).collect()}
    for k in (0, 1):
        start = np.array([seeds.get(h, (0, 0))[k] for h in hosts])
        move = np.zeros((len(hosts), len(hosts)))
        for e in edges:
            s, d = (hosts.index(x) for x in (e if k == 0 else e[::-1]))
            move[d, s] += 1
        total = move.sum(0)
        move = np.where(total > 0, move / np.maximum(total, 1), start[:, None])
        want = np.linalg.solve(np.eye(len(hosts)) - 0.85 * move, 0.15 * start)
        assert want.sum() == pytest.approx(1)
        assert [got.get(h, (0, 0))[k] for h in hosts] == pytest.approx(want, abs=1e-8)


def test_empty_pages_and_clashing_names(spark):
    schema = "page_id long, url string, html string, host string, verdict string, trust double, src string"
    assert url_filters(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, None, "x", "y", 1.0, "z"), (None, "http://spam.org/es/1", "<a href='http://m.org/'>", None, None, None, None), (3, "http://m.org/q", "", None, None, None, None)]
    got = url_filters(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.host, r.verdict) for r in got) == [("", "allow"), ("m.org", "allow"), ("spam.org", "block")]


def test_edges_are_between_hosts(spark):
    pages = spark.createDataFrame([("a", "<a href='//B.c/x'> <img src=http://d/> <a href=\"/own\"> <a href='https://a/'>"), ("a", "<a HREF = 'http://b.c?x'>")], "host string, html string")
    assert {tuple(r) for r in host_edges(pages).collect()} == {("a", "b.c"), ("a", "d")}


def test_pipeline_on_the_small_tables(spark):
    import corpus_pipeline as pipeline
    from cueflow.llm.decontamination import contaminated
    from cueflow.llm.jaccard_join import jaccard_components
    from cueflow.llm.suffix_dedup import remove_long_repeats
    from cueflow.llm.toxicity import toxicity_scores

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("labels", "benchmark"))
    columns = docs.columns
    toxic = {r.doc_id for r in toxicity_scores(docs, labels).filter("predicted = 1").collect()}
    stage = {r.doc_id: r for r in docs.collect()}
    one = pipeline.materialise(pipeline.drop_toxic(spark, docs, folder), "t1")
    assert one.columns == columns and {r.doc_id for r in one.collect()} == set(stage) - toxic
    heads = {r.doc_id for r in jaccard_components(one).filter("doc_id = component_id").collect()}
    two = pipeline.materialise(pipeline.drop_near_copies(spark, one, folder), "t2")
    assert two.columns == columns and {r.doc_id for r in two.collect()} == heads
    kept = {r.doc_id: bytes(r.kept).decode("utf-8", "ignore") for r in remove_long_repeats(two).collect()}
    three = pipeline.materialise(pipeline.cut_repeats(spark, two, folder), "t3")
    assert three.columns == columns and {r.doc_id: r.text for r in three.collect()} == kept
    assert all(r.n_chars == len(r.text) for r in three.collect())
    leaks = {r.doc_id for r in contaminated(three, benchmark).collect()}
    four = pipeline.materialise(pipeline.drop_leaks(spark, three, folder), "t4")
    assert four.columns == columns and {r.doc_id for r in four.collect()} == {r.doc_id for r in three.collect()} - leaks
    last = pipeline.run(spark, folder).collect()
    assert last and len({r.doc_id for r in last}) == len(last) and all(r.copies >= 1 and r.taken == r.copies * len(r.text.encode().split()) for r in last)
    assert {r.doc_id for r in last} <= {r.doc_id for r in four.collect()}


def test_mix_of_documents_with_the_same_column_names(spark):
    import corpus_pipeline as pipeline

    rows = [(i, "w " * (i % 7), f"s{i % 2}", "x", 3, "t", i, 5, 9) for i in range(40)] + [(None, "a b", None, "x", 3, "t", 1, 5, 9)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, copies int, target string, nth long, taken long, source_size int")
    got = pipeline.mix_sources(spark, docs, "")
    assert got.columns == docs.columns + ["mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_taken"]
    found = got.collect()
    assert found and all((r.size, r.copies, r.target) == ("x", 3, "t") and r.mix_taken == r.mix_copies * r.mix_size == r.mix_copies * len(r.text.split()) for r in found)
    assert pipeline.mix_sources(spark, docs.limit(0), "").count() == 0
