"""Operators on urls, archives, vectors, mixtures and shards, and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweave.llm import bfd_shards, entropy_mix, hilbert_ann, url_filter, warc
from eventweave.llm.shipping import ship

from tests.llm import plain

URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org", "https://a.example.org/es/x?q=/de/", "https://a.example.org/en/12#f", "http://org/x",
    "http://notorg/x", "http://www.x.com/fr/1", "http://m.x.com/de/1", "http://x.com/de", "http://x.com?/de/", "http://ÀB.Com/fr/",
    "http://x.net/a", "http://x.net/a?utm_source=f&b=1", "http://www.x.net/a/?b=1", "http://y.net/1", "http://z.net/1", "http://q.net/1", "HTTP://Q.net/1.html",
]


def test_url_rules_and_aliases(spark):
    html = {
        17: '<html><link rel="canonical" href="http://blocked.com/de/7"></html>',
        18: "<LINK href='//y.net/1' rel='canonical'>",
        19: '<meta http-equiv="refresh" content="0; url=http://ok.org/1">',
    }
    pages = spark.createDataFrame([(i, u, html.get(i), "x") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    pages = pages.unionByName(pages.filter("page_id = 5"))  # a repeated row
    found = url_filter.judge(pages.drop("host")).collect()
    assert len(found) == len(URLS) + 1
    for r in found:
        url = URLS[r["page_id"]]
        rule = plain.url_rule(url, url_filter.RULES)
        assert (r["host"], r["path"]) == plain.url_parts(url)
        assert r["rule"] == (rule[2] if rule else None)
        if rule:
            assert r["verdict"] == ("allow" if rule[1] else "block")
    got = {r["page_id"]: r for r in found}
    assert got[17]["verdict"] == got[18]["verdict"] == "block" and got[17]["alias_of"] == got[18]["alias_of"]
    assert got[19]["verdict"] == "allow" and got[19]["alias_of"] == got[20]["alias_of"]
    assert got[15]["alias_of"] == got[16]["alias_of"] != got[14]["alias_of"]
    assert got[0]["verdict"] == "allow"
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_allow_takes_precedence_over_block_among_aliases(spark):
    pages = spark.createDataFrame([(1, "http://a.net/1", None)], "page_id long, url string, html string")
    hops = [("http://a.net/1", "http://b.net/1"), ("http://b.net/1", "http://c.com/de/1"), ("http://b.net/1", "http://d.org/1")]
    table = spark.createDataFrame(hops, "source string, target string")
    (r,) = url_filter.judge(pages, redirects=table).collect()
    assert r["verdict"] == "allow" and r["rule"] is None
    (r,) = url_filter.judge(pages, redirects=table.limit(2)).collect()
    assert r["verdict"] == "block"


def test_declared_targets_of_every_form(spark):
    link = "<link rel=canonical href='{}'>".format
    cases = [  # (source, html, url of the page meant)
        ("http://a.net", link("b.html"), "http://a.net/b"),
        ("http://b.net?q=/x/", link("b.html"), "http://b.net/b"),
        ("http://c.net/x/y/1", link("../z/./2"), "http://c.net/x/z/2"),
        ("http://d.net/x/1", link("../../../up/.."), "http://d.net/"),
        ("http://e.net/x/1?old=1#f", link("?q=2"), "http://e.net/x/1?q=2"),
        ("http://f.net/x/1?q=3", link("#top"), "http://f.net/x/1?q=3"),
        ("http://g.net/1", link("/p?a=1&amp;b=2"), "http://g.net/p?a=1&b=2"),
        ("http://h.net/1", "<link href=/2 rel='alternate CANONICAL'>", "http://h.net/2"),
        ("http://i.net/1", "<meta http-equiv=refresh content='0; URL=2?u=http://else.net/'>", "http://i.net/2?u=http://else.net/"),
        ("http://j.net/1", link("http://j.net/a/../2"), "http://j.net/2"),
        ("http://k.net/1", link("\n /2\t"), "http://k.net/2"),
        ("http://l.net/1", "<link data-href='/3' href='/2' rel=canonical>", "http://l.net/2"),
    ]
    none = [("http://m.net/1", link("mailto:a@b.net")), ("http://n.net/1", "<link rel='canonical-like' href='/2'>"), ("no scheme", link("2"))]
    rows = [(i, s, h) for i, (s, h, _) in enumerate(cases)] + [(100 + i, m, None) for i, (*_, m) in enumerate(cases)]
    pages = spark.createDataFrame(rows + [(200 + i, s, h) for i, (s, h) in enumerate(none)], "page_id long, url string, html string")
    assert url_filter.links(pages.filter("page_id >= 200")).count() == 0
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    assert [i for i in range(len(cases)) if got[i]["alias_of"] != got[100 + i]["alias_of"]] == []
    to = {r["source"]: r["target"] for r in url_filter.links(pages).collect()}
    assert to["http://d.net/x/1"] == "http://d.net/" and to["http://c.net/x/y/1"] == "http://c.net/x/z/2" and to["http://f.net/x/1?q=3"] == "http://f.net/x/1?q=3#top"
    redirected = spark.createDataFrame([(1, "http://a.net", link("../de/1")), (2, "http://other.com/x", link("b/../../de/1"))], "page_id long, url string, html string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge(redirected).collect()} == {1: "allow", 2: "block"}


HTML = [None, "", "<p>same</p>", "<p>same</p>", "a\r\n\r\nWARC/1.1\r\nx", "é" * 50_000, "<p>same</p>", ""]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}/p?q#f", h, 1) for i, h in enumerate(HTML)], "page_id long, url string, html string, digest int")
    folder = warc.archive_folder(ship(spark))
    warc.write_archives(pages, folder, records=5)
    records = warc.read_archives(spark, folder)
    assert records.count() == 3 * len(HTML)
    found = {r["page_id"]: r for r in warc.transactions(records).collect()}
    expected = plain.warc(list(enumerate(HTML)))
    assert {i: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to_page"]) for i, r in found.items()} == expected
    for i, r in found.items():
        assert r["request"]["http_headers"].startswith("GET /p?q HTTP/1.1") and r["metadata"]["fields"]
        assert r["response"]["payload"] == ((HTML[i] or "").encode() if r["record_type"] == "response" else None)
    assert warc.unmatched(records).count() == 0
    orphans = records.filter("record_type != 'revisit'")
    assert warc.unmatched(orphans).count() == 2 * sum(e[2] == "revisit" for e in expected.values())


def test_warc_edges(spark):
    ship(spark)
    schema = "page_id long, url string, html string"
    rows = [(None, None, "x"), (3, "u", "x"), (3, "u", "x"), (2, "u", "x")]
    folder = warc.archive_folder(spark)
    warc.write_archives(spark.createDataFrame(rows, schema), folder)
    found = sorted((str(r["page_id"]), r["record_type"], r["refers_to_page"]) for r in warc.transactions(warc.read_archives(spark, folder)).collect())
    assert found == [("2", "revisit", 3), ("3", "response", None), ("3", "response", None), ("None", "revisit", 3)]
    folder = warc.archive_folder(spark)
    warc.write_archives(spark.createDataFrame([], schema), folder)
    assert warc.read_archives(spark, folder).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc"))


def _vectors(spark, rows):
    return ship(spark).createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, rep string")


def test_hilbert_keys_walk_the_grid():
    side = np.arange(8)
    points = np.array([(x, y, z) for x in side for y in side for z in side])
    key = hilbert_ann.hilbert_keys(points, 3)
    assert sorted(key.tolist()) == list(range(512))
    walk = points[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()  # neighbours on the curve are neighbours in space


def test_nearest_neighbours_recall(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(1500, 24)).astype(np.float32)
    v[200:260] = v[7]  # copies, more than a result shows
    table = _vectors(spark, [(i, x.tolist()) for i, x in enumerate(v)])
    found = hilbert_ann.search(table, F.col("vec_id") % 20 == 0, k=20).collect()
    exact = plain.nearest({i: x.astype(np.float64) for i, x in enumerate(v)}, range(0, 1500, 20), 20)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(exact)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert hits / (20 * len(exact)) >= 0.9
    for q, rows in got.items():
        assert len(rows) == 20 and q not in {i for i, _ in rows}
        assert rows == sorted(rows, key=lambda x: (-x[1], x[0]))
        for i, s in rows:
            assert s == pytest.approx(float(np.dot(v[q].astype(np.float64), v[i].astype(np.float64))), abs=1e-12)
    assert [i for i, _ in got[200]][:19] == [7, *range(201, 219)]  # ties go to the smaller id


def test_nearest_neighbours_edges(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0]), (7, [])]
    good = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (8, [-1.0, 0.0])]
    found = hilbert_ann.search(_vectors(spark, bad + good), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found if r["query_id"] == 0) == [(0, 1, 20), (0, 2, 8)]
    assert hilbert_ann.search(_vectors(spark, bad), F.col("vec_id") % 20 == 0).count() == 0
    assert hilbert_ann.search(_vectors(spark, good).limit(0), F.lit(True)).count() == 0


def _sources(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        source = rng.choice(["a", "b", "c", "d", None, "hot", "hot", "hot"])
        rows.append((i, None if i % 97 == 0 else " ".join(["w"] * rng.randint(0, 40)), "en", source, 0, 3))
    rows += [(9_000, "w " * 2_000, "en", "b", 0, 3), (9_001, "x", "en", "tiny", 0, 3), *rows[:4]]
    return ship(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, copies int")


def test_mix_meets_targets(spark):
    docs = _sources(spark)
    rows = entropy_mix.copies(entropy_mix.sizes(docs)).collect()
    assert len(rows) == docs.count()
    total, taken, longest = {}, {}, {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        total[r["source"]] = total.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        longest[r["source"]] = max(longest.get(r["source"], 0), r["size"])
    expected = plain.mix_targets(total)
    for r in rows:
        assert r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(expected[r["source"]])
    for s, t in expected.items():
        assert abs(taken[s] - t) <= 0.02 * t + 2, (s, taken[s], t)
    again = entropy_mix.copies(entropy_mix.sizes(docs.repartition(7))).collect()
    key = lambda r: (r["doc_id"], str(r["source"]), r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mix_repeats_documents(spark):
    docs = _sources(spark)
    mixed = entropy_mix.mix(docs)
    assert mixed.columns == docs.columns
    decided = entropy_mix.copies(entropy_mix.sizes(docs)).groupBy("doc_id").agg(F.sum("copies").alias("n")).filter("n > 0")
    assert {tuple(r) for r in mixed.groupBy("doc_id").count().collect()} == {tuple(r) for r in decided.collect()}
    assert entropy_mix.mix(docs.limit(0)).count() == 0


def test_entropy_balancing_keeps_base_odds(spark):
    """Inside a source the tilt multiplies every document's base odds by the same factor."""
    sized = spark.createDataFrame([(i, "s" if i % 2 else "t", i, 1 + i % 9) for i in range(200)], "doc_id long, source string, text_hash long, size long")
    rows = entropy_mix.copies(sized, share=0.9, base=F.when(F.col("size") > 4, 1.4).otherwise(0.6)).collect()
    for s in "st":
        factor = {round(r["rate"] / (2 - r["rate"]) / ((1.4 / 0.6) if r["size"] > 4 else (0.6 / 1.4)), 6) for r in rows if r["source"] == s}
        assert len(factor) == 1
        mine = [r for r in rows if r["source"] == s]
        assert sum(r["rate"] * r["size"] for r in mine) == pytest.approx(mine[0]["target"], rel=1e-6)


def test_best_fit_decreasing_matches_a_plain_search():
    rng = random.Random(6)
    for _ in range(30):
        sizes = sorted((rng.randint(1, 60) for _ in range(rng.randint(0, 120))), reverse=True)
        free, expected = [], []
        for s in sizes:
            fits = [(f, b) for b, f in enumerate(free) if f >= s]
            if fits:
                f, b = min(fits)
            else:
                free.append(max(100, s))
                f, b = free[-1], len(free) - 1
            free[b] = f - s
            expected.append(b)
        assert bfd_shards.best_fit_decreasing(sizes, 100) == expected


def test_pack_items_is_near_equal():
    rng = random.Random(2)
    sizes = sorted((rng.randint(1, 1000) for _ in range(2000)), reverse=True)
    for extra in ([], [10**6]):  # a group larger than a fair share gets a shard of its own
        items = sorted(extra + sizes, reverse=True)
        load = [0] * 16
        for s, b in zip(items, bfd_shards.pack_items(items, 16), strict=True):
            load[b] += s
        rest = sorted(load)[: 16 - len(extra)]
        assert rest[-1] - rest[0] <= 0.02 * rest[-1]
    assert bfd_shards.pack_items([], 16) == []


def test_shards_keep_groups_and_number_slots(spark):
    rng = random.Random(3)
    texts = [None, "", "é" * 9_000] + ["copy of a text"] * 150 + ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 300))) for _ in range(400)]
    docs = ship(spark).createDataFrame([(i, t, "x", 5) for i, t in enumerate(texts)] + [(7, texts[7], "x", 5)], "doc_id long, text string, shard string, size int")
    rows = bfd_shards.pack(bfd_shards.text_columns(docs.drop("shard"))).collect()
    assert len(rows) == len(texts) + 1
    home, load, slots = {}, {}, {}
    for r in rows:
        text = r["text"] or ""
        assert r["size"] == len(text.encode()) + 1 and home.setdefault(text, r["shard"]) == r["shard"]
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(load) <= set(range(16))
    small = sorted(load.values())[:-2]
    assert small[-1] <= 1.1 * small[0]
    assert bfd_shards.pack(bfd_shards.text_columns(docs.drop("shard").limit(0))).count() == 0
    packed = bfd_shards.pack_capacity(bfd_shards.text_columns(docs.drop("shard")), 20_000).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert all(r["n"] <= 20_000 for r in packed) and len(packed) <= -(-sum(load.values()) // 20_000) + 1


def test_small_groups_are_packed_by_size(spark):
    """Each shard's bytes are those of best-fit-decreasing over single groups, small and equal ones included."""
    rng = random.Random(4)
    texts = [f"{i:04d}" + "x" * rng.choice((0, 3, 3, 40, rng.randint(0, 300))) for i in range(1500)]
    docs = bfd_shards.text_columns(ship(spark).createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    sizes = sorted((len(t) + 1 for t in texts), reverse=True)
    capacity = 1 + 700 * 3
    for packed, bins in (
        (bfd_shards.pack_capacity(docs, capacity), bfd_shards.best_fit_decreasing(sizes, capacity)),
        (bfd_shards.pack(docs), bfd_shards.pack_items(sizes, 16)),
    ):
        load = {}
        for s, b in zip(sizes, bins, strict=True):
            load.setdefault(b, []).append(s)
        rows = packed.groupBy("shard").agg(F.array_sort(F.collect_list("size")).alias("sizes")).collect()
        assert {r["shard"]: list(r["sizes"]) for r in rows} == {b: sorted(x) for b, x in load.items()}


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", "src0", 0)], docs.schema)
    kept = docs.unionByName(odd)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert [name for name, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name, stage in cp.STAGES:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        kept = cp.materialize(stage(spark, kept, sf_dir), f"test_{name}")
        after = [r["doc_id"] for r in kept.collect()]
        assert set(after) <= set(before)
        if name != "sharding":
            assert kept.columns == docs.columns
        if name == "near_duplicates":
            found = plain.near_duplicates([(-1 if i is None else i, t) for i, t in before.items()])
            assert len(after) == len({c for _, c in found.values()}) == len(set(after))
        if name == "decontamination":
            assert set(before) - set(after) == {d for d, *_ in plain.contained(before.items(), items)}
        if name == "mixing":
            assert max(after.count(i) for i in after) <= 2
        if name == "sharding":
            assert len(after) == sum(1 for _ in after) and kept.filter("shard between 0 and 15").count() == len(after)
    nothing = docs.limit(0)
    for _, stage in cp.STAGES:
        nothing = stage(spark, nothing, sf_dir)
    assert nothing.count() == 0
