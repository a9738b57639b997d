"""Operators on texts: language, scoring, quality, containment, near duplicates."""

import random

import numpy as np
import pytest

from eventweave.llm import containment, language_id, ppm, simhash_trie, weak_quality
from eventweave.operators.components import connected_components
from eventweave.llm.shipping import ship

from tests.llm import plain

#: null, empty, blank, one word, mixed spaces and cases, a very long text, other scripts, copies
EDGE = [None, "", " \t\n", "One", "a  B\tc\nd E", "x " * 30_000, "ñandú ÑANDÚ größe Größe 漢字", "a b c d e", "A B C D E"]


def _texts(n=60, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 90))) for _ in range(n)]
    for i in range(0, n, 6):  # near copies
        w = out[i].split()
        w[rng.randrange(len(w))] = "other"
        out.append(" ".join(w))
    return out + out[:5]


def _docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "x", 1) for i, t in enumerate(texts)]
    # extra columns whose names the operators use themselves
    return ship(spark) and spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, size int")


def _empty(spark):
    return _docs(spark, ["x"]).limit(0)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(0, i) for i in range(1, 50)]
    loops = [(7, 7), (200, 201), (201, 200), (300, None)]
    found = connected_components(spark.createDataFrame(chain + star + loops, "a long, b long")).collect()
    got = {r["node"]: r["root"] for r in found}
    assert len(found) == len(got)
    assert got == {i: 100 for i in range(100, 161)} | {i: 0 for i in range(50)} | {200: 200, 201: 200}


def test_trie_links_are_all_links():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(x) for x in set(rng.integers(0, 63, rng.integers(1, 7)).tolist())) for b in base[:60] for _ in range(12)]
    v = np.unique(np.concatenate([base, np.array(near, dtype=np.uint64)]))
    expected = {(i, j) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v[i] ^ v) <= 4).tolist()}
    got = set()
    for first, lead in simhash_trie.THIRDS:
        turned = (v << np.uint64(first)) | (v >> np.uint64(64 - first)) if first else v
        order = np.argsort(turned)
        for i, j in simhash_trie.trie_links(turned[order], turned[order], 4, 0, lead):
            got |= set(zip(order[i].tolist(), order[j].tolist(), strict=True))
    assert got == expected


@pytest.mark.parametrize("block", [simhash_trie.BLOCK, 5])
def test_link_joins_dense_groups(spark, block):
    ship(spark)
    rng = random.Random(1)
    centre = [rng.getrandbits(64) for _ in range(4)]
    values = sorted({c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centre for _ in range(25)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash_trie.link(spark.createDataFrame([(v,) for v in signed], "fp long"), block=block).collect()
    edges = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in found}
    assert all((a ^ b).bit_count() <= 64 for a, b in edges) and len(edges) <= 3 * 4 * len(values) * 25
    expected = plain.components(values, lambda a, b: (a ^ b).bit_count() <= 4)
    got = plain.components(values, lambda a, b: (a, b) in edges or (b, a) in edges)
    assert got == expected


def test_near_duplicates(spark):
    texts = EDGE + _texts()
    found = simhash_trie.near_duplicates(_docs(spark, texts)).select("doc_id", simhash_trie.hex_fingerprint().alias("f"), "component_id").collect()
    expected = plain.near_duplicates(list(enumerate(texts)))
    assert {r["doc_id"]: (r["f"], r["component_id"]) for r in found} == expected
    assert len(found) == len(texts)


def test_one_of_each(spark):
    texts = EDGE + _texts(20)
    docs = _docs(spark, texts)
    kept = simhash_trie.one_of_each(docs.unionByName(docs.limit(3)))  # repeated rows
    assert kept.columns == docs.columns
    expected = {c for _, c in plain.near_duplicates(list(enumerate(texts))).values()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    assert simhash_trie.one_of_each(_empty(spark)).count() == 0


def test_contained_items(spark):
    rng = random.Random(9)
    words = [f"v{i}" for i in range(300)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 5, 6, 14, 30, 59)] + [None, "", "!!"]
    items += items[3:4]  # a repeated item
    texts = [*EDGE]
    for item in items[:6]:
        w = (item or "").split()
        filler = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 400)))
        texts.append(f"{filler()} {item.upper()}, {filler()}")
        w[len(w) // 2] = "changed"
        texts += [f"{filler()} {' '.join(w)} {filler()}", f"{filler()} {' '.join(item.split()[: max(1, int(len(w) * 0.9))])} {filler()}", item]
    docs = _docs(spark, texts)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    expected = plain.contained(list(enumerate(texts)), list(enumerate(items)))
    assert expected
    for block in (containment.ITEM_BLOCK, 300):  # several blocks of items find the same
        found = containment.contained_items(docs, benchmark, block_bytes=block).collect()
        assert sorted((r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in found) == expected
    clean = containment.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, *_ in expected}
    assert containment.contained_items(_empty(spark), benchmark).count() == 0
    assert containment.decontaminate(docs, benchmark.limit(0)).count() == len(texts)


def test_ppm_matches_brute_force(spark):
    texts = EDGE + _texts(25)
    texts[5] = "x " * 300
    for order, block in ((2, ppm.BLOCK), (5, 2_000)):  # one block and many
        found = ppm.score(_docs(spark, texts), ppm.held_out_fold(), order=order, block_bytes=block).collect()
        expected = plain.ppm(list(enumerate(texts)), order)
        assert sorted(r["doc_id"] for r in found) == list(range(len(texts)))
        for r in found:
            e = expected[r["doc_id"]]
            assert tuple(r[1:5]) == e[:4]
            assert r["base_score"] == pytest.approx(e[4], rel=1e-9) and r["score"] == pytest.approx(e[5], rel=1e-9)
    assert ppm.score(_empty(spark), ppm.held_out_fold()).count() == 0


def test_languages_come_from_the_labels(spark):
    """Rows of a label beside the four of the given tables are learned and found, without a declaration too."""
    sentence = {"it": "il gatto dorme sulla sedia e la bambina legge", "en": "the cat sleeps on the chair and the girl reads", "fi": "kissa nukkuu tuolilla ja tyttö lukee kirjaa"}
    rows = [(i, f"{sentence[x]} {i % 7}", x.upper() if i % 2 else f" {x}", "s") for i, x in enumerate(list(sentence) * 20)] + [(90, "?", None, "s"), (91, "?", " ", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    languages = language_id.label_languages(docs)
    assert languages == ("en", "fi", "it") and language_id.label_languages(docs, most=2) == ("en", "fi")
    assert language_id.label_languages(docs.limit(0)) == language_id.LANGUAGES
    model = language_id.fit_text(docs, languages)
    blind = language_id.document_rows(docs).withColumn("truth", language_id.F.col("declared"))
    for asked in (blind, blind.withColumn("declared", language_id.F.lit(None).cast("string"))):
        found = language_id.identify(asked.filter("doc_id < 90"), model, languages).collect()
        assert len(found) == 60 and all(r["lang"] == r["truth"] for r in found)


def test_ppm_costs_of_split_sub_tries(spark):
    """Crowded contexts of two symbols are dealt by a third; the costs are those of the whole trie."""
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcd "), 4_000, p=[0.5, 0.2, 0.1, 0.1, 0.1]).tolist()).encode()
    node, _ = ppm.windows(np.frombuffer(text, dtype=np.uint8), np.array([0, 1_500, 1_500, 4_000]), ppm.ORDER)
    node, n = np.unique(node, return_counts=True)
    n[::7] = 0  # only mentioned
    expected = dict(zip(node.tolist(), ppm.Trie(node, n, ppm.ORDER).log10(node).tolist(), strict=True))
    counted = spark.createDataFrame([(int(a), int(b)) for a, b in zip(node, n, strict=True)], "node long, n long")
    for crowd in (10, 100, ppm.CROWD):
        found = {r["known"]: r["value"] for r in ppm.node_costs(counted, ppm.ORDER, crowd).collect()}
        assert found == pytest.approx(expected, abs=1e-9)


def test_ppm_without_training_rows(spark):
    from pyspark.sql import functions as F

    (row,) = ppm.score(_docs(spark, ["ab"]), F.lit(True)).collect()
    assert row["score"] == pytest.approx(-3 * np.log10(257)) and row["train_tokens"] == 0 and row["n_known"] == 0


def test_adaptive_code_length_learns():
    assert ppm.adaptive_code_length(b"") == pytest.approx(-np.log10(257))
    once, more = ppm.adaptive_code_length(b"abracadabra"), ppm.adaptive_code_length(b"abracadabra" * 20)
    assert once < 0 and more / 20 > once / 3  # repeats cost little


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.7
    accuracy = [0.95, 0.9, 0.8, 0.75]
    votes = np.stack([np.where(rng.random(len(truth)) < 0.3, 0, np.where((rng.random(len(truth)) < a) == truth, 1, 2)) for a in accuracy], axis=1)
    code, n = np.unique(weak_quality.pattern_code(votes), return_counts=True)
    post, prior, table = weak_quality.expectation_maximisation(dict(zip(code.tolist(), n.tolist(), strict=True)), 4)
    assert prior == pytest.approx(0.7, abs=0.03)
    for k, a in enumerate(accuracy):
        assert table[k, 0, 1] / (table[k, 0, 1] + table[k, 0, 2]) == pytest.approx(a, abs=0.04)
    guess = np.array([post.get(c, 0.5) > 0.5 for c in weak_quality.pattern_code(votes).tolist()])
    assert (guess == truth)[votes.any(axis=1)].mean() > 0.9


def test_quality_against_held_labels(spark):
    """The labels are never used in fitting."""
    docs = ship(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = weak_quality.fit(docs)
    judged = weak_quality.judge(docs, model).join(labels, "doc_id").collect()
    good = [r["keep"] for r in judged if r["quality"] == 1]
    bad = [r["keep"] for r in judged if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15
    assert all(a > 0.6 for a in model.accuracies().values())


def test_quality_edges(spark):
    docs = _docs(spark, EDGE + _texts(30))
    model = weak_quality.fit(docs)
    kept = weak_quality.accepted(docs, model)
    assert kept.columns == docs.columns
    judged = weak_quality.judge(docs, model).collect()
    assert len(judged) == len(EDGE) + len(_texts(30)) and judged[0]["votes"] == "?" * len(weak_quality.LABELLERS)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in judged if r["keep"]}
    nothing = weak_quality.fit(_empty(spark))
    assert weak_quality.judge(_empty(spark), nothing).count() == 0


def test_language_of_documents_and_pages(spark):
    docs = ship(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit_text(docs.select("doc_id", "text", "lang"))
    from pyspark.sql import functions as F

    blind = language_id.document_rows(docs).withColumn("truth", F.col("declared")).withColumn("declared", F.lit(None).cast("string"))
    rows = language_id.identify(blind, model).collect()
    assert np.mean([r["lang"] == r["truth"] for r in rows]) > 0.97  # by text and host alone
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = language_id.identify(language_id.page_rows(pages), model).join(pages.select("page_id", "url"), "page_id").collect()
    assert np.mean([f"/{r['lang']}/" in r["url"] for r in rows]) > 0.97


def test_language_evidence_adds_up(spark):
    docs = ship(spark).read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit_text(docs.select("doc_id", "text", "lang"))
    german = [r["text"] for r in docs.filter("lang = 'de' and n_chars > 500").limit(12).collect()]
    french = [r["text"] for r in docs.filter("lang = 'fr' and n_chars > 500").limit(12).collect()]
    rows = [(t, "de", "www.eins.example") for t in german] + [(t, "fr", "deux.test") for t in french]
    rows += [(None, "de", None), ("", None, "www.eins.example"), (None, None, None), ("", "xx", "deux.test")] * 2
    table = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "page_id long, text string, declared string, host string, suffix string")
    found = {r["page_id"]: r for r in language_id.identify(table.drop("suffix"), model).collect()}
    assert [found[i]["lang"] for i in range(24)] == ["de"] * 12 + ["fr"] * 12
    assert found[24]["lang"] == "de" and found[25]["lang"] == "de" and found[27]["lang"] == "fr"
    assert all(abs(sum(r["posteriors"]) - 1) < 1e-9 for r in found.values())
    assert language_id.identify(table.drop("suffix").limit(0), model).count() == 0


@pytest.mark.parametrize("ids", ["null", "repeated"])
def test_training_samples_stay_bounded(spark, ids, monkeypatch):
    """Rows with a null id, and copies of one row, cannot flood a sample."""
    text = lambda i: f"{i:06d}" * 2  # noqa: E731  # 10 trigrams
    odd = [(None, text(i)) if ids == "null" else (-1, text(7)) for i in range(1000)]
    rows = [(*x, "en") for x in odd + [(i, text(5000 + i)) for i in range(2000)]]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_text(docs, train_rows=300)
    # smallest probability of the language = 0.5 / (trigrams + 0.5 * BUCKETS)
    learned = 0.5 / np.exp(model[language_id.LANGUAGES.index("en")].min()) - 0.5 * language_id.BUCKETS
    assert 250 <= round(learned) / 10 <= 300
    grouped = []
    train = type(docs).groupBy
    monkeypatch.setattr(type(docs), "groupBy", lambda self, *by: (grouped.append(self.count()) if by == ("part",) else None, train(self, *by))[1])
    weak_quality.fit(docs, train_rows=300, rounds=1, epochs=1)
    assert len(grouped) == 1 and 250 <= grouped[0] <= 300
