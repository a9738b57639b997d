"""Operator semantics on hand-written rows: the traps listed in the survey."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweave.functions.columns import compose_date, pad_counter, replace_first
from eventweave.functions.rules import Rule, apply_rules
from eventweave.operators import analytics as an
from eventweave.operators import geo, keys, marts, spans, survey, text

D = dt.date


def test_pad_never_truncates(spark):
    df = spark.createDataFrame([(3,), (10000,)], "n INT")
    assert [r[0] for r in df.select(pad_counter("n", 3)).collect()] == ["003", "10000"]


def test_replace_first_and_literal_dollar(spark):
    df = spark.createDataFrame([("a.b.c",)], "s STRING")
    assert df.select(replace_first("s", r"\.", "$")).first()[0] == "a$b.c"


def test_impossible_dates_are_null(spark):
    df = spark.createDataFrame([(2001, 6, 31), (2001, 3, 0), (2001, 2, 28)], "y INT, m INT, d INT")
    got = [r[0] for r in df.select(compose_date("y", "m", "d")).collect()]
    assert got == [None, None, D(2001, 2, 28)]


def test_rules_apply_in_order_and_rematch(spark):
    df = spark.createDataFrame([("hawai tennesse",)], "s STRING")
    rules = [Rule("hawai", "hawaii"), Rule("hawaiii", "hawaii"), Rule("tennesse", "tennessee"), Rule("tennesseee", "tennessee")]
    assert df.select(apply_rules(F.col("s"), rules)).first()[0] == "hawaii tennessee"


def test_literal_rule_is_not_a_group(spark):
    df = spark.createDataFrame([("washington dc",), ("washington (dc)",)], "s STRING")
    got = [r[0] for r in df.select(apply_rules(F.col("s"), [Rule("washington (dc)", "DC", literal=True)])).collect()]
    assert got == ["washington dc", "DC"]


def test_lower_flag_uses_unicode_class(spark):
    df = spark.createDataFrame([("HARRIS (TX)",), ("Harris (TX)",), (":LOWER",)], "s STRING")
    got = [r[0] for r in text.flag_unparsed(df, "s").select("inProgress").collect()]
    assert got == [False, True, False]


def test_whole_word_strip_keeps_names(spark):
    df = spark.createDataFrame([("eastland and east counties",)], "s STRING")
    bounded = text.strip_tokens(df, "s", ["east", "county"], {"counties": "county"}, whole_word=True).first()[0]
    unbounded = text.strip_tokens(df, "s", ["east"], None, whole_word=False).first()[0]
    assert bounded == "eastland,"
    assert unbounded.startswith("land")


def test_parse_locations_levels(spark):
    """Rows written by hand from the reference's splitting rules."""
    texts = {
        1: "harris [houston], dallas [plano] (TX), dade, broward (FL)",
        2: None,
        3: "cook (IL), ",
        4: "fort worth (tarrant) (TX)",
        5: "TX, FL",
        6: "panhandle (TX, OK)",
    }
    df = spark.createDataFrame(list(texts.items()), "k INT, Location STRING")
    rows = text.parse_locations(df, "k").orderBy("k", "piece_no", "region_no").collect()
    got = {k: [(r.State, r.Region, r.County) for r in rows if r.k == k] for k in texts}
    assert got[1] == [("TX", "harris", "houston"), ("TX", "dallas", "plano"), ("TX", None, None), ("FL", "dade", None), ("FL", "broward", None)]
    assert got[2] == [(None, None, None)]
    assert got[3][0] == ("IL", "cook", None)
    assert got[4] == [("TX", "fort worth", "tarrant")]
    assert got[5] == [("TX, FL", None, None)]
    codes = text.state_codes(text.parse_locations(df, "k")).filter("k in (5, 6)").collect()
    assert sorted((r.k, r.State, r.Region) for r in codes) == [(5, "FL", None), (5, "TX", None), (6, "OK", "panhandle"), (6, "TX", "panhandle")]


def test_places_keep_known_counties_and_skip_blank_regions(spark):
    rows = [
        ("1", "TX", "harris", None), ("2", "TX", "plano", None), ("2", "OK", "plano", None), ("3", "TX", "houston", "harris"),
        ("4", "TX", None, "dallas"), ("5", "TX", None, None), ("6", "TX", "nowhere", None), ("7", "TX", "elsewhere", None),
    ]
    df = geo.partition_by_presence(spark.createDataFrame(rows, "region_id STRING, State STRING, Region STRING, County STRING"))
    gaz = spark.createDataFrame([("TX", "plano", "dallas"), ("TX", "plano", "collin"), ("TX", "x", "harris"), ("OK", "y", "tulsa")], "state_id STRING, city STRING, county_name STRING")
    hand = spark.createDataFrame([("6", "travis, hays"), ("1", "ignored")], "region_id STRING, counties STRING")
    matched, left = geo.match_gazetteer(df, gaz)
    assert sorted((r.region_id, r.State) for r in left.collect()) == [("2", "OK"), ("6", "TX"), ("7", "TX")]
    assert sorted((r.region_id, r.county, r.level) for r in matched.collect()) == [("1", "harris", "county"), ("2", "collin", "city"), ("2", "dallas", "city")]
    places = sorted((r.region_id, r.State, r.county, r.level) for r in geo.clean_places(df, gaz, hand).collect())
    assert places == [
        ("1", "TX", "harris", "county"), ("2", "TX", "collin", "city"), ("2", "TX", "dallas", "city"), ("3", "TX", "harris", "known"),
        ("4", "TX", "dallas", "known"), ("6", "TX", "hays", "manual"), ("6", "TX", "travis", "manual"),
    ]


def test_presence_labels_exhaustive(spark):
    df = spark.createDataFrame([("a", "b"), ("a", ""), (None, "b"), ("", None)], "Region STRING, County STRING")
    assert [r.presence for r in geo.partition_by_presence(df).collect()] == ["both", "region_only", "county_only", "none"]


def test_patches_ordered_last_set_wins(spark):
    df = spark.createDataFrame([("1", "old text"), ("2", "keep")], "id STRING, loc STRING")
    p = spark.createDataFrame(
        [("1", 1, "loc", "replace_all", "t", "T", None), ("1", 2, "loc", "set", None, "CA", None),
         ("1", 3, "loc", "set", None, "MO $1", None)],
        text.PATCH_SCHEMA,
    )
    got = dict(text.apply_patches(df, "id", p, "loc").select("id", "loc").collect())
    assert got == {"1": "MO $1", "2": "keep"}


def test_expand_collapse_roundtrip(spark):
    rng = random.Random(7)
    rows = []
    for k in range(30):
        start = D(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 400))
        for _ in range(rng.randint(1, 3)):
            end = start + dt.timedelta(days=rng.randint(0, 20))
            rows.append((f"e{k}", start, end))
            start = end + dt.timedelta(days=rng.randint(2, 30))
    df = spark.createDataFrame(rows, "id STRING, begin_date DATE, end_date DATE")
    days = spans.expand_days(df)
    back = spans.collapse_days(days, ["id"]).select("id", "begin_date", "end_date")
    assert sorted(back.collect()) == sorted(df.collect())


def test_expand_days_inclusive_and_reversed(spark):
    df = spark.createDataFrame(
        [("a", D(2000, 12, 30), D(2001, 1, 2)), ("b", D(2000, 1, 5), D(2000, 1, 1)), ("c", D(2000, 1, 1), None)],
        "id STRING, begin_date DATE, end_date DATE",
    )
    got = spans.expand_days(df).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in got} == {"a": 4}
    swapped = spans.expand_days(df, reversed_spans="swap").groupBy("id").count().collect()
    assert {r.id: r["count"] for r in swapped} == {"a": 4, "b": 5}


def test_span_match_equals_day_join(spark):
    rng = random.Random(3)

    def mk(n, tag):
        out = []
        for i in range(n):
            b = D(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 200))
            out.append((f"{tag}{i}", rng.choice(["TX", "FL"]), b, b + dt.timedelta(days=rng.randint(0, 70))))
        return out

    a = spark.createDataFrame(mk(60, "a"), "a_id STRING, state STRING, begin_date DATE, end_date DATE")
    b = spark.createDataFrame(mk(60, "b"), "b_id STRING, state STRING, b_begin DATE, b_end DATE")
    got = spans.match_days(a, b, ["state"], b_begin="b_begin", b_end="b_end").select("Day", "state", "a_id", "b_id")
    ad = spans.expand_days(a).select("Day", "state", "a_id")
    bd = spans.expand_days(b, "b_begin", "b_end").select("Day", "state", "b_id")
    brute = ad.join(bd, ["Day", "state"]).select("Day", "state", "a_id", "b_id")
    assert sorted(got.collect()) == sorted(brute.collect())


def test_event_map_null_county_matches(spark):
    a = spark.createDataFrame([(D(2000, 1, 1), "TX", None, "F1")], "Day DATE, state STRING, county STRING, femaID STRING")
    b = spark.createDataFrame([(D(2000, 1, 1), "TX", None, "E1"), (D(2000, 1, 2), "TX", "x", "E2")],
                              "Day DATE, state STRING, county STRING, emdatID STRING")
    got = sorted(spans.event_map(a, b).collect(), key=str)
    assert len(got) == 2 and any(r.femaID == "F1" and r.emdatID == "E1" for r in got)


def test_impute_half_even_and_levels(spark):
    rows = [
        ("TX", 2000, D(2000, 1, 1), D(2000, 1, 3)),   # 2
        ("TX", 2000, D(2000, 2, 1), D(2000, 2, 4)),   # 3 -> mean 2.5 -> 2 (half even)
        ("TX", 2000, D(2000, 3, 1), None),
        ("TX", 2001, D(2001, 3, 1), None),            # no known in (TX, 2001): state mean
        ("FL", 2000, D(2000, 3, 1), None),            # no data for the state at all
    ]
    df = spark.createDataFrame(rows, "state STRING, yr INT, begin_date DATE, end_date DATE")
    got = {(r.state, r.yr, r.begin_date): r.end_imputed for r in spans.impute_end(df, [["state", "yr"], ["state"]]).collect()}
    assert got[("TX", 2000, D(2000, 3, 1))] == D(2000, 3, 3)
    assert got[("TX", 2001, D(2001, 3, 1))] == D(2001, 3, 3)
    assert got[("FL", 2000, D(2000, 3, 1))] is None


def test_composite_id_cuts_first_underscore(spark):
    df = spark.createDataFrame([("DR-1-TX_003", "2005-0001"), (None, "E9")], "femaID STRING, emdatID STRING")
    assert [r.smashedID for r in keys.composite_id(df).collect()] == ["DR-1-TX_2005-0001", "_E9"]


def test_mint_keys_pad_grows_past_width(spark):
    rows = [(D(2000, 1, 1), "TX", f"id{i:03d}") for i in range(120)]
    df = spark.createDataFrame(rows, "Day DATE, state STRING, smashedID STRING").withColumn("femaID", F.col("smashedID")).withColumn("emdatID", F.lit(""))
    k = keys.mint_keys(df)
    got = {r.smashedID: r.eventKey for r in k.collect()}
    assert got["id000"] == "2000_01_TX_01" and got["id119"] == "2000_01_TX_120"
    assert keys.check_unique(k, ["smashedID", "state"]).count() == 0


def test_casualties_all_missing_is_null(spark):
    km = spark.createDataFrame([("a", "K1"), ("b", "K2")], "id STRING, eventKey STRING")
    counted = spark.createDataFrame([("a", None, None)], "id STRING, nkill DOUBLE, nwound DOUBLE")
    zero = spark.createDataFrame([("b", None, 4.0)], "id STRING, nkill DOUBLE, nwound DOUBLE")
    got = {r.eventKey: (r.nKilled, r.nWounded) for r in marts.build_casualties(counted, zero, km, "id").collect()}
    assert got == {"K2": (0.0, 4.0)}


def test_hierarchy_fallback(spark):
    df = spark.createDataFrame([("Flood",), ("Odd",)], "hazard_cluster STRING")
    h = spark.createDataFrame([("HYDRO", "Flood"), ("TECHNOLOGICAL", "Flood")], "hazard_type STRING, hazard_cluster STRING")
    got = dict(marts.attach_hierarchy(df, h, drop_pairs=[("TECHNOLOGICAL", "Flood")]).select("hazard_cluster", "hazard_type").collect())
    assert got == {"Flood": "HYDRO", "Odd": "Odd"}
    assert marts.attach_hierarchy(df, h, drop_pairs=[("TECHNOLOGICAL", "Flood")], fallback=False).count() == 1


def test_impact_pivot_na_propagates(spark):
    rows = [
        ("e1", "Flood", 3.0, D(2000, 1, 1), D(2000, 1, 1)), ("e2", "Flood", None, D(2000, 2, 1), D(2000, 2, 2)),
        ("e3", "Flood", 5.0, D(2001, 1, 1), D(2001, 1, 1)), ("e4", "Flood", 7.0, D(2001, 12, 31), D(2003, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "ev STRING, t STRING, n DOUBLE, begin_date DATE, end_date DATE")
    r = an.impact_pivot(df, F.col("ev"), "t", "n", [2000, 2001]).first()
    # years outside the list (2002, 2003) keep their totals
    assert r["Year: 2000"] is None and r["Year: 2001"] == 12.0 and r["Other years"] == 14.0 and r["total"] == 26.0


def test_durations_weigh_day_rows_and_keep_every_year(spark):
    rows = [("a", "TX", D(1999, 12, 30), D(2000, 1, 2)), ("a", "FL", D(2000, 1, 5), D(2000, 1, 5)), ("b", "TX", D(2005, 3, 1), D(2005, 3, 1)), ("c", "TX", D(2005, 3, 2), D(2005, 3, 1))]
    df = spark.createDataFrame(rows, "eventid STRING, state STRING, begin_date DATE, end_date DATE")
    days = [(i, s, b + dt.timedelta(days=k)) for i, s, b, e in rows for k in range((e - b).days + 1)]
    length = {i: (max(d for j, _, d in days if j == i) - min(d for j, _, d in days if j == i)).days + 1 for i in "ab"}
    mean = lambda keep: sum(length[i] for i, s, d in days if keep(s, d)) / sum(1 for i, s, d in days if keep(s, d))
    got = {r.state: r.mean_duration for r in an.mean_duration(df, "eventid", ["state"]).collect()}
    assert got == pytest.approx({s: mean(lambda x, d, s=s: x == s) for s in ("TX", "FL")})
    wide = {r.state: r for r in an.duration_pivot(df, "eventid", [1999, 2000]).collect()}
    assert wide["TX"]["Year: 1999"] == 7 and wide["TX"]["Year: 2000"] == 7 and wide["TX"]["Other years"] == 1
    wide = {r.state: r for r in an.duration_pivot(df, "eventid", [1999], event_weighted=True).collect()}
    assert wide["FL"]["Year: 1999"] == 7 and wide["TX"]["Other years"] == 1


def test_crosstab_keeps_unlisted_answers(spark):
    df = spark.createDataFrame([(2000, 1), (2000, 9), (2001, None)], "year INT, q INT")
    got = {r.year: r for r in survey.crosstab_pct(df, "year", "q", ["1", "2", "NA"]).collect()}
    assert got[2000]["1"] == "50.00% (1)" and got[2000]["other"] == "50.00% (1)" and got[2001]["NA"] == "100.00% (1)"


def test_recode_ranks_numbers_as_numbers(spark):
    df = spark.createDataFrame([(2, "b"), (10, "a"), (None, "b")], "x INT, y STRING")
    rows = survey.recode_binary(df, ["x", "y"]).collect()
    assert sorted((r.x or 0, r.x_0, r.y_0) for r in rows) == [(0, None, 0), (2, 1, 0), (10, 0, 1)]
    plan = survey.recode_binary(df, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_summary_quartiles(spark):
    rng = random.Random(4)
    rows = [(g, rng.choice([None, *range(40)])) for g in ("a", "b", None) for _ in range(200)] + [("empty", None)]
    df = spark.createDataFrame(rows, "g STRING, v INT")
    got = {r.g: r for r in an.summarize(df, "v", ["g"]).collect()}
    for g in ("a", "b", None):
        v = sorted(x for h, x in rows if h == g and x is not None)
        assert [got[g].q1, got[g].median, got[g].q3] == pytest.approx(np.percentile(v, [25, 50, 75]).tolist())
        assert got[g].n == 200 and got[g].n_missing == 200 - len(v)
    assert got["empty"].median is None and got["empty"].n_missing == 1
    whole = an.summarize(df, "v").first()
    assert whole.median == pytest.approx(float(np.percentile([x for _, x in rows if x is not None], 50)))


def test_keys_are_stable_when_rows_arrive(spark):
    schema = "Day DATE, state STRING, smashedID STRING, femaID STRING, emdatID STRING"
    first = [(D(2000, 1, 3), "TX", f"m{i:02d}", f"m{i:02d}", "") for i in range(5)]
    later = [(D(2000, 1, 9), "TX", f"a{i:02d}", f"a{i:02d}", "") for i in range(4)] + [(D(1999, 12, 31), "TX", "m00", "m00", "")]
    old = keys.mint_keys(spark.createDataFrame(first, schema))
    before = {(r.smashedID, r.state): r.eventKey for r in old.collect()}
    after = {(r.smashedID, r.state): r.eventKey for r in keys.mint_keys(spark.createDataFrame(first + later, schema), existing=old).collect()}
    assert {k: v for k, v in after.items() if k in before} == before
    assert sorted(v for k, v in after.items() if k not in before) == [f"2000_01_TX_{n:02d}" for n in range(6, 10)]


def test_disjoint_check_can_fail(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "x"), ("", "y"), ("", None)], "femaID STRING, emdatID STRING")
    assert tuple(keys.check_disjoint(df).first()) == (0, 2, 2, 1)
    both = df.unionByName(spark.createDataFrame([("a", "x"), ("b", "x")], df.schema))
    assert tuple(keys.check_disjoint(both).first()) == (2, 2, 2, 1)
    assert tuple(keys.check_disjoint(df.limit(0)).first()) == (0, 0, 0, 0)
    df = spark.createDataFrame([("FEMA", "k1"), ("FEMA", "k1"), ("EMDAT", "k2")], "Source STRING, eventKey STRING")
    assert tuple(keys.shared_keys(df).first()) == (0, 2)
    shared = df.unionByName(spark.createDataFrame([("EMDAT", "k1")], df.schema))
    assert tuple(keys.shared_keys(shared).first()) == (1, 2)


def test_known_zero_casualties_are_published(spark):
    km = spark.createDataFrame([("a", "K1")], "id STRING, eventKey STRING")
    counted = spark.createDataFrame([("a", 0.0, 0.0)], "id STRING, nkill DOUBLE, nwound DOUBLE")
    got = marts.build_casualties(counted, counted.limit(0), km, "id").collect()
    assert [(r.eventKey, r.nKilled, r.nWounded) for r in got] == [("K1", 0.0, 0.0)]


def test_category_ids_of_any_width_keep_apart(spark):
    df = spark.createDataFrame([(f"DR-{i}-TX", "Flood") for i in (1, 12, 123, 1234, 12345)] + [("DR-1-FL", "Flood")], "eventid STRING, incident_type STRING")
    assert an.category_counts({"FEMA": (df, "-", 2)}, "eventid", "incident_type").first().n_events == 5


def test_span_match_buckets_agree(spark):
    rng = random.Random(11)
    rows = []
    for i in range(80):
        b = D(1999, 12, 1) + dt.timedelta(days=rng.randint(0, 500))
        rows.append((f"x{i}", rng.choice(["A", "B"]), b, b + dt.timedelta(days=rng.randint(0, 120))))
    a = spark.createDataFrame(rows[:40], "a_id STRING, state STRING, begin_date DATE, end_date DATE")
    b = spark.createDataFrame(rows[40:], "b_id STRING, state STRING, b_begin DATE, b_end DATE")
    results = []
    for unit in ("week", "month", "year"):
        m = spans.match_spans(a, b, ["state"], bucket=unit, b_begin="b_begin", b_end="b_end")
        results.append(sorted(m.select("a_id", "b_id", "overlap_days").collect()))
    brute = [
        (x[0], y[0], (min(x[3], y[3]) - max(x[2], y[2])).days + 1)
        for x in rows[:40] for y in rows[40:]
        if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]
    ]
    assert results[0] == results[1] == results[2]
    assert [tuple(r) for r in results[0]] == sorted(brute)


def test_exposure_keeps_panel_rows_without_events(spark):
    panel = spark.createDataFrame(
        [("p1", "TX", D(2000, 1, 1), D(2000, 12, 31)), ("p2", "FL", D(2000, 1, 1), D(2000, 12, 31))],
        "pid STRING, state STRING, begin_date DATE, end_date DATE",
    )
    ev = spark.createDataFrame(
        [("e1", "TX", D(1999, 12, 30), D(2000, 1, 2)), ("e2", "TX", D(2000, 6, 1), D(2000, 6, 1))],
        "eid STRING, state STRING, begin_date DATE, end_date DATE",
    )
    got = {r.pid: (r.n_events, r.exposure_days) for r in spans.exposure(panel, ev, "pid", ["state"], "eid").collect()}
    assert got == {"p1": (2, 3), "p2": (0, 0)}


def test_source_key_id_rules(spark):
    days = spark.createDataFrame(
        [("FEMA", "DR-9_001", D(2000, 1, 5), "TX"), ("FEMA", "DR-9_002", D(2000, 1, 3), "TX"),
         ("EMDAT", "2000-0001-0001", D(2000, 1, 4), "TX"), ("EMDAT", "2000-0002-0001", D(2000, 1, 4), "TX"),
         ("GTD", "77", D(2000, 2, 1), "TX"), ("GTD", "78_1", D(2000, 2, 1), "TX"), ("GTD", "79", D(2000, 2, 9), "OK")],
        "Source STRING, eventid STRING, begin_date DATE, state STRING",
    )
    got = {(r.Source, r.eventid): (r.super_id, r.eventKey) for r in keys.mint_source_keys(days).collect()}
    assert got[("FEMA", "DR-9_001")] == ("DR-9", got[("FEMA", "DR-9_002")][1])
    assert got[("EMDAT", "2000-0001-0001")][0] == "2000-0001"
    assert got[("GTD", "77")] == ("77", "2000_02_TX_001")
    # every source counts for itself; an incident's id is kept whole
    assert got[("FEMA", "DR-9_001")][1] == got[("EMDAT", "2000-0001-0001")][1] == "2000_01_TX_001"
    assert got[("EMDAT", "2000-0002-0001")][1] == "2000_01_TX_002"
    assert got[("GTD", "78_1")] == ("78_1", "2000_02_TX_002") and got[("GTD", "79")][1] == "2000_02_OK_001"
    assert tuple(keys.shared_keys(keys.mint_source_keys(days)).first()) == (1, 5)


def test_source_keys_of_an_event_with_more_than_9999_places(spark):
    rows = spark.range(9_999, 10_002).selectExpr("'EMDAT' AS Source", "concat('2001-0001_', lpad(id, greatest(4, length(id)), '0')) AS eventid", "DATE'2001-01-04' AS begin_date", "'TX' AS state")
    got = keys.mint_source_keys(rows).collect()
    assert sorted(r.eventid for r in got) == ["2001-0001_10000", "2001-0001_10001", "2001-0001_9999"]
    assert {(r.super_id, r.eventKey) for r in got} == {("2001-0001", "2001_01_TX_001")}


def test_duration_model_totals_and_estimates(spark):
    import math
    import random

    rng = random.Random(2)
    rows = [(s, float(y), float(min(40, int(rng.expovariate(1 / math.exp(a + 0.1 * y)))))) for s, a in (("TX", 1.0), ("OK", 0.2), ("CA", 0.5)) for y in range(8) for _ in range(40)]
    df = spark.createDataFrame(rows, "state STRING, year DOUBLE, duration DOUBLE")
    coefficients, totals = an.fit_duration(df, moments=("year",))
    found = {r.state: (r.n, r.observed, r.fitted) for r in totals.collect()}
    assert set(found) == {"TX", "OK", "CA", "(year)"}
    assert all(abs(o - f) < 1e-4 * max(o, 1) for _, o, f in found.values())
    # without its year the model still meets every state's total, but not the one weighted by year
    _, without = an.fit_duration(df, "duration ~ state", moments=("year",))
    bare = {r.state: (r.observed, r.fitted) for r in without.collect()}
    assert all(abs(bare[s][0] - bare[s][1]) < 1e-3 for s in ("TX", "OK", "CA")) and abs(bare["(year)"][0] - bare["(year)"][1]) > 10
    levels = {r.term: r.estimate for r in an.level_estimates(coefficients, df, "state").collect()}
    assert set(levels) == {"TX", "OK", "CA", "year"}
    for s in ("TX", "OK", "CA"):
        fitted = sum(math.exp(levels[s] + levels["year"] * y) for t, y, _ in rows if t == s)
        assert abs(fitted - found[s][1]) < 1e-3 * found[s][1]
