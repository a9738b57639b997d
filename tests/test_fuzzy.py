"""Candidates for misspelt places against brute-force edit distance."""

import random

import pytest

from eventweave.operators import fuzzy


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, names, k):
    out = []
    for state, text in sorted({(s, t) for s, t in rows if s and t}):
        near = sorted((distance(text, n), n) for n in {n for s, n in names if s == state and n} if distance(text, n) <= k)
        out += [(state, text, n, d, i + 1) for i, (d, n) in enumerate(near)]
    return sorted(out)


def names_of(seed, n=250):
    rng = random.Random(seed)
    parts = ["san", "ta", "clair", "port", "spring", "field", "o", "ñu", "st", "aa", "a"]
    return [(rng.choice(["TX", "CA"]), " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(1, 2)))) for _ in range(n)]


def spoil(rng, text):
    letters = list(text)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(letters) + 1)
        how = rng.randrange(3)
        if how == 0:
            letters.insert(at, rng.choice("aeñ s"))
        elif letters:
            at = min(at, len(letters) - 1)
            letters[at : at + 1] = [] if how == 1 else [rng.choice("xyz")]
    return "".join(letters)


@pytest.mark.parametrize(("k", "q"), [(1, 2), (2, 2), (2, 3), (3, 2)])
def test_candidates_match_brute_force(spark, k, q):
    rng = random.Random(k * 10 + q)
    names = names_of(1) + [("TX", s) for s in ("a", "ab", "abc", "abcd", "abcde", "b", "")] + [("TX", None), (None, "a")]
    rows = [(s, spoil(rng, n)) for s, n in names_of(1, 120)] + [("TX", t) for t in ("", "x", "ab", "ba", "cba", None, "  ")] + [(None, "a"), ("NV", "a")]
    rows += rows[:20]
    got = fuzzy.candidates(spark.createDataFrame(rows, "state string, region string"), spark.createDataFrame(names, "state string, place string"), ["state"], "region", "place", k, q)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, names, k)


def test_long_and_repetitive_texts(spark):
    rows = [("TX", "ab" * 300), ("TX", "a" * 50), ("TX", "a" * 400)]
    names = [("TX", "ab" * 299), ("TX", "a" * 48), ("TX", "ab" * 300 + "c"), ("TX", "b" * 50), ("TX", "a" * 53)]
    got = fuzzy.candidates(spark.createDataFrame(rows, "state string, region string"), spark.createDataFrame(names, "state string, place string"), ["state"], "region", "place")
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, names, 2)


def test_plan_has_no_cross_join_and_top_keeps_the_first(spark):
    rows = spark.createDataFrame([("TX", "clare"), ("TX", "sprng")], "state string, region string")
    names = spark.createDataFrame([("TX", "clair"), ("TX", "clara"), ("TX", "spring")], "state string, place string")
    found = fuzzy.candidates(rows, names, ["state"], "region", "place", top=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "gram" in plan
    assert {(r["region"], r["place"]) for r in found.collect()} == {("clare", "clara"), ("sprng", "spring")}
    assert fuzzy.candidates(rows, names.limit(0), ["state"], "region", "place").count() == 0


def test_only_a_single_nearest_name_mends(spark):
    rows = spark.createDataFrame([("TX", "clar", 1), ("TX", "sprng", 2), ("TX", "zzzzzz", 3)], "state string, region string, n int")
    names = spark.createDataFrame([("TX", "claro"), ("TX", "clara"), ("TX", "spring"), ("TX", "sprang"), ("TX", "sprung")], "state string, place string")
    found = fuzzy.candidates(rows, names, ["state"], "region", "place")
    mended = {r["region"]: r["mended"] for r in fuzzy.mend(rows, found, ["state"], "region", "place").collect()}
    assert mended == {"clar": None, "sprng": None, "zzzzzz": None}
    found = fuzzy.candidates(rows, names.filter("place != 'clara' AND place NOT LIKE 'spr%ng' OR place = 'spring'"), ["state"], "region", "place")
    mended = {r["region"]: r["mended"] for r in fuzzy.mend(rows, found, ["state"], "region", "place").collect()}
    assert mended == {"clar": "claro", "sprng": "spring", "zzzzzz": None}
