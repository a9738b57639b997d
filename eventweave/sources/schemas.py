"""Explicit schemas (DDL) for every table the library reads."""

from __future__ import annotations

# driver-generated star-schema tables (read-only test inputs)
DRIVER_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

# raw source feeds as they arrive (CSV exports); types follow how each column is used
RAW_SCHEMAS: dict[str, str] = {
    "declarations_raw": (
        "femaDeclarationString STRING, incidentBeginDate STRING, incidentEndDate STRING, state STRING, "
        "designatedArea STRING, incidentType STRING"
    ),
    "incidents_raw": (
        "eventid BIGINT, iyear INT, imonth INT, iday INT, country INT, provstate STRING, city STRING, "
        "attacktype1_txt STRING, nkill DOUBLE, nwound DOUBLE"
    ),
    "impacts_raw": (
        "`Dis No` STRING, ISO STRING, `Start Year` INT, `Start Month` INT, `Start Day` INT, `End Year` INT, "
        "`End Month` INT, `End Day` INT, `Disaster Type` STRING, `Disaster Subtype` STRING, "
        "`Disaster Subsubtype` STRING, Location STRING, `Geo Locations` STRING, `Total Deaths` DOUBLE, "
        "`No Injured` DOUBLE"
    ),
    "gazetteer": "city STRING, city_ascii STRING, state_id STRING, county_name STRING",
    "states": "state STRING, abbr STRING",
    "hazard_hierarchy": "hazard_type STRING, hazard_cluster STRING, specific_hazard STRING",
    "survey_raw": (
        "sitename STRING, year INT, weight DOUBLE, stratum INT, PSU INT, record BIGINT, age INT, sex INT, "
        "q26 INT, q27 INT, q28 INT, q29 INT, qn26 INT, qn27 INT, qn28 INT, qn29 INT"
    ),
    "spans": (
        "Source STRING, eventid STRING, begin_date DATE, end_date DATE, state STRING, county STRING, "
        "incident_type STRING, nkill DOUBLE, nwound DOUBLE"
    ),
    "event_map": "Day DATE, state STRING, county STRING, femaID STRING, emdatID STRING",
}
