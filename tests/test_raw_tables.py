"""Raw CSV exports -> eight tables -> event search, on rows written by hand."""

import datetime as dt
import os
import tempfile

from eventweave.functions.rules import Rule
from eventweave.operators import analytics as an
from eventweave.plans.raw_tables import build_from_raw
from eventweave.sources.readers import read_csv, write_csv
from eventweave.sources.schemas import RAW_SCHEMAS

D = dt.date

DECLARATIONS = """femaDeclarationString,incidentBeginDate,incidentEndDate,state,designatedArea,incidentType
DR-1-TX,2001-06-05T00:00:00Z,2001-06-08T00:00:00Z,TX,Harris (County),Severe Storm(s)
DR-1-TX,2001-06-05T00:00:00Z,2001-06-08T00:00:00Z,TX,St. Clair (County),Severe Storm(s)
DR-2-FL,2002-01-01T00:00:00Z,2002-01-01T00:00:00Z,FL,Dade (County),Biological
DR-3-TX,1989-01-01T00:00:00Z,1989-01-02T00:00:00Z,TX,Harris (County),Fire
"""
INCIDENTS = """eventid,iyear,imonth,iday,country,provstate,city,attacktype1_txt,nkill,nwound
77,2001,9,11,217,Texas,Houston,Bombing,5,9
78,2001,9,0,217,Texas,Houston,Bombing,5,9
79,2001,9,12,217,Texas,Houston,Bombing,1,9
"""
IMPACTS = """Export of the impact database
version,1
Dis No,ISO,Start Year,Start Month,Start Day,End Year,End Month,End Day,Disaster Type,Disaster Subtype,Disaster Subsubtype,Location,Geo Locations,Total Deaths,No Injured
2001-0001,USA,2001,6,6,2001,6,7,Storm,Tropical cyclone,,"Houston [Harris], Plano (Texas)",,41,
2001-0002,USA,2001,,,2001,,,Flood,,,Florida,,,3
2001-0003,CAN,2001,1,1,2001,1,1,Flood,,,Ontario,,3,3
2001-0004,USA,2001,1,1,2001,1,1,Flood,,,Texas,,,
"""


def _csv(name, body):
    folder = tempfile.mkdtemp()
    with open(os.path.join(folder, f"{name}.csv"), "w") as f:
        f.write(body)
    return folder


def test_raw_exports_to_event_search(spark):
    read = lambda name, body, **kw: read_csv(spark, _csv(name, body), RAW_SCHEMAS[name], **kw)
    gaz = spark.createDataFrame(
        [("Houston", "Houston", "TX", "Harris"), ("Plano", "Plano", "TX", "Collin"), ("X", "X", "TX", "St. Clair"), ("Miami", "Miami", "FL", "Dade")],
        RAW_SCHEMAS["gazetteer"],
    )
    states = spark.createDataFrame([("Texas", "TX"), ("Florida", "FL")], RAW_SCHEMAS["states"])
    hierarchy = spark.createDataFrame([("CLIMATE", "Storm", "wind"), ("WATER", "Flood", "rise")], RAW_SCHEMAS["hazard_hierarchy"])
    impacts = read("impacts_raw", IMPACTS, skip_lines=2)
    assert impacts.count() == 4 and impacts.filter("ISO = 'USA'").count() == 3
    t = build_from_raw(
        read("declarations_raw", DECLARATIONS), read("incidents_raw", INCIDENTS), impacts, states, gaz,
        spark.createDataFrame([], "region_id STRING, counties STRING"), hierarchy,
        [Rule("^Severe Storm.*", "Storm")], [Rule("^Storm:.*", "Storm"), Rule("^Flood:.*", "Flood")],
        [Rule("texas", "TX"), Rule("florida", "FL")], allowed=["TX", "FL"], last_begin="2020-01-20",
    )
    keys = {(r.femaID, r.emdatID): r.eventKey for r in t["allKeys"].collect()}
    assert len({k for k in keys if k[0].startswith("DR-1")}) >= 2 and not any(k[0].startswith(("DR-2", "DR-3")) for k in keys)
    places = {(r.state, r.county) for r in t["disastLocations"].collect()}
    assert places == {("TX", "harris"), ("TX", "st clair"), ("TX", "collin"), ("FL", "dade")}
    storm = keys[("DR-1-TX_001", "2001-0001_0002")] if ("DR-1-TX_001", "2001-0001_0002") in keys else next(v for k, v in keys.items() if k[1].startswith("2001-0001") and k[0])
    dates = {r.eventKey: (r.eventStart, r.eventEnd) for r in t["disastDates"].collect()}
    assert dates[storm] == (D(2001, 6, 5), D(2001, 6, 8))
    flood = next(v for k, v in keys.items() if k[1].startswith("2001-0002"))
    assert dates[flood] == (D(2001, 1, 1), D(2001, 12, 28))  # missing months and days filled
    bombing = next(v for k, v in keys.items() if k[0].startswith("77"))
    casualties = {r.eventKey: (r.nKilled, r.nWounded) for r in t["disastCasualties"].collect()}
    assert casualties[bombing] == (5.0, 9.0) and casualties[flood] == (0.0, 3.0) and casualties[storm] == (41.0, 0.0)
    types = {(r.eventKey, r.hazard_type, r.hazard_cluster) for r in t["disastTypes"].collect()}
    assert (storm, "CLIMATE", "Storm") in types and (flood, "WATER", "Flood") in types
    assert t["hazard_report"].count() == 2 and t["fema_hazard_cluster"].count() == 2 and t["emdat_hazard_cluster"].count() == 2
    found = an.search_events(t["disastTypes"], t["disastDates"], t["disastCasualties"], t["disastLocations"], year=2001, state="FL").collect()
    assert [(r.eventKey, r.county) for r in found] == [(flood, "dade")]


def test_impact_in_an_unknown_region_keeps_its_state(spark):
    read = lambda name, body, **kw: read_csv(spark, _csv(name, body), RAW_SCHEMAS[name], **kw)
    gaz = spark.createDataFrame([("Plano", "Plano", "TX", "Collin"), ("X", "X", "TX", "Harris"), ("Y", "Y", "OK", "Tulsa")], RAW_SCHEMAS["gazetteer"])
    states = spark.createDataFrame([("Texas", "TX"), ("Oklahoma", "OK")], RAW_SCHEMAS["states"])
    header = "\n".join(IMPACTS.split("\n")[:3])
    impacts = read("impacts_raw", header + "\n2001-0005,USA,2001,3,1,2001,3,2,Flood,,,Fooville (Texas),,7,\n", skip_lines=2)
    t = build_from_raw(
        read("declarations_raw", DECLARATIONS), read("incidents_raw", INCIDENTS), impacts, states, gaz,
        spark.createDataFrame([], "region_id STRING, counties STRING"), spark.createDataFrame([("WATER", "Flood", "rise")], RAW_SCHEMAS["hazard_hierarchy"]),
        [Rule("^Severe Storm.*", "Storm")], [Rule("^Flood:.*", "Flood")], [Rule("texas", "TX"), Rule("oklahoma", "OK")], allowed=["TX", "OK"],
    )
    flood = {r.eventKey for r in t["allKeys"].collect() if r.emdatID.startswith("2001-0005")}
    assert len(flood) == 1
    places = {(r.state, r.county) for r in t["disastLocations"].collect() if r.eventKey in flood}
    assert places == {("TX", "collin"), ("TX", "harris")}  # the whole state, as for an entry that names only the state
    assert {(r.nKilled) for r in t["disastCasualties"].collect() if r.eventKey in flood} == {7.0}


def test_csv_round_trip(spark):
    rows = [("a", 1), ('quoted "text", with comma', None), (None, 3)]
    folder = tempfile.mkdtemp() + "/out"
    write_csv(spark.createDataFrame(rows, "s STRING, n INT"), folder)
    assert sorted(map(tuple, read_csv(spark, folder, "s STRING, n INT").collect()), key=str) == sorted(rows, key=str)


def test_dots_in_location_text_do_not_lose_the_county(spark):
    read = lambda name, body, **kw: read_csv(spark, _csv(name, body), RAW_SCHEMAS[name], **kw)
    gaz = spark.createDataFrame(
        [("St. Johns", "St. Johns", "MI", "Clinton"), ("X", "X", "MI", "st clair"), ("Y", "Y", "MI", "Wayne"), ("Z", "Z", "TX", "St. Mary")], RAW_SCHEMAS["gazetteer"]
    )
    states = spark.createDataFrame([("Michigan", "MI"), ("Texas", "TX")], RAW_SCHEMAS["states"])
    header = "\n".join(IMPACTS.split("\n")[:3])
    body = "\n".join([
        "2001-0005,USA,2001,3,1,2001,3,2,Flood,,,St. Clair (Michigan),,7,",
        "2001-0006,USA,2001,4,1,2001,4,2,Flood,,,\"ST. JOHNS (Michigan), St Mary (Texas)\",,1,",
        "2001-0007,USA,2001,5,1,2001,5,2,Flood,,,St.Clair [St. Clair] (Michigan),,2,",
    ])
    t = build_from_raw(
        read("declarations_raw", DECLARATIONS), read("incidents_raw", INCIDENTS), read("impacts_raw", f"{header}\n{body}\n", skip_lines=2), states, gaz,
        spark.createDataFrame([], "region_id STRING, counties STRING"), spark.createDataFrame([("WATER", "Flood", "rise")], RAW_SCHEMAS["hazard_hierarchy"]),
        [Rule("^Severe Storm.*", "Storm")], [Rule("^Flood:.*", "Flood")], [Rule("michigan", "MI"), Rule("texas", "TX")], allowed=["TX", "MI"],
    )
    key = {r.emdatID[:9]: set() for r in t["allKeys"].collect() if r.emdatID}
    for r in t["allKeys"].collect():
        if r.emdatID:
            key[r.emdatID[:9]].add(r.eventKey)
    where = {i: {(r.state, r.county) for r in t["disastLocations"].collect() if r.eventKey in keys} for i, keys in key.items()}
    assert where == {"2001-0005": {("MI", "st clair")}, "2001-0006": {("MI", "clinton"), ("TX", "st mary")}, "2001-0007": {("MI", "st clair")}}
