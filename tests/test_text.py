"""Scalar rules against hand-derived results."""

import pytest
from pyspark.sql import functions as F

from masterline.functions import text as T
from masterline.functions.countries import normalize_country
from masterline.functions.entity import classify_entity
from masterline.functions.udfs import initials_match, nfkd, ratio, repair, similarity


def apply(spark, f, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_clean_name(spark):
    cases = {
        None: "", "": "", "7": "", "12345": "", "Acme GmbH": "acme", "The Acme Corp., Inc.": "acme", "A & B Foods": "and b foods", "3M": "3m", "Café Société SA": "cafe societe", "Acme dba Widget 12 Ltd": "acme widget", "Group": "group",
        "The The": "the", "Smith, John": "smith john", "X-Ray Co": "x-ray", "ﬁne tools": "fine tools", "Acme & Co": "acme and", "  Acme\tTools  ": "acme tools", "Acme c/o Bob attn Sue": "acme bob sue", "日本 Ltd": "日本",
    }
    got = dict(zip(cases, apply(spark, T.clean_name, cases), strict=True))
    assert got == cases


def test_clean_name_lenient(spark):
    cases = {"12345": "12345", "#12": "", "Acme, Inc.": "acme, inc.", "The Mr Acme 12": "acme", "A&B": "and b", None: "", "x": ""}
    assert dict(zip(cases, apply(spark, T.clean_name_lenient, cases), strict=True)) == cases


def test_fold_is_nfkd_for_latin(spark):
    values = ["Ångström Œuvre", "ﬁ ﬀ ﬃ", "Ñandú Łódź", "ǆ ½ ²", "é decomposed", "plain"]
    assert apply(spark, T.fold, values)[:3] == apply(spark, nfkd, values)[:3]
    assert apply(spark, nfkd, ["각"])[0] != "각"


@pytest.mark.parametrize(("name", "key"), [("", "_empty_"), ("staples inc", "staples"), ("american red cross", "american_red"), ("ab cd ef", "ab_cd_ef"), ("acme big tools", "acme_tools"), ("acme tools", "acme"), ("ab", "ab")])
def test_block_key(spark, name, key):
    assert apply(spark, T.block_key, [name]) == [key]


def test_comparison_and_canonical(spark):
    cases = {"Acme Tools (India) Pvt Ltd": "acme tools", "Group Holding": "group holding", "Singapore Co": "singapore", "A & B Foods": "and foods", "": ""}
    assert dict(zip(cases, apply(spark, T.comparison_name, cases), strict=True)) == cases
    cases = {"ACME TOOLS PVT. LTD.": "ACME Tools", "acme india limited": "Acme", "India": "India", "Acme (UK) Inc.": "Acme", "IBM": "IBM", "B&Q PLC": "B&Q", "": ""}
    assert dict(zip(cases, apply(spark, T.canonical_name, cases), strict=True)) == cases


def test_values(spark):
    assert apply(spark, T.clean_value, [" N/A ", "None", "nan", "", " x ", None]) == [None, None, None, None, "x", None]
    assert apply(spark, T.clean_loaded, ["Unknown", "AcmeNaN", "NaN", "none", None, " "]) == [None, "Acme", None, "none", None, None]
    assert apply(spark, T.parse_count, ["1,204", "7.9", "x", None, ""]) == [1204, 7, 0, 0, 0]
    assert [None if x is None else float(x) for x in apply(spark, T.parse_amount, [" 12 ", "1e2", "abc", "", "1.0d", "inf"])] == [12, 100, None, None, None, None]
    assert apply(spark, lambda c: T.percent(c.cast("double")), ["0.125", "0.135", "0.85", "1"]) == ["12%", "14%", "85%", "100%"]
    assert apply(spark, T.good_description, ["12345", "123-456", "-----", "abcd", "paper", None, " ab c "]) == [False, False, True, False, True, False, False]
    assert apply(spark, T.name_key, ["  A  B ", None]) == ["a b", ""]


def test_merges(spark):
    tags = lambda c: T.merge_tags(c, F.array(F.lit("b"), F.lit(" C "), F.lit("c"), F.lit("")))
    assert apply(spark, tags, ["A, B", None, "x, X"]) == ["A, B, C", "b, C", "x, X, b, C"]
    places = lambda c: T.merge_locations(c, F.array(F.lit("US"), F.lit("Unknown")))
    assert apply(spark, places, ["FR, US", None, "Unknown"]) == ["FR, US", "US", "US"]
    assert apply(spark, lambda c: T.merge_locations(c, F.array().cast("array<string>")), [None]) == ["Unknown"]


@pytest.mark.parametrize(
    ("name", "verdict"),
    [
        ("", "unknown/low/empty"), ("Acme GmbH", "organization/high/legal_suffix"), ("Dr Jane Roe", "individual/high/title_prefix"), ("Jane Roe MD", "individual/high/title_suffix"), ("Acme Bank", "organization/high/corp_keyword"),
        ("A & B Zed", "organization/medium/ampersand"), ("3M", "organization/medium/has_numbers"), ("Smith, John", "individual/high/last_comma_first"), ("John Smith", "individual/medium/firstname_match"), ("Zed", "organization/low/single_word"),
        ("Four Word Long Name", "organization/low/long_name"), ("Zed Wug", "unknown/low/no_signal"),
    ],
)
def test_classify(spark, name, verdict):
    join = lambda c: F.concat_ws("/", *(classify_entity(c)[k] for k in ("type", "confidence", "reason")))
    assert apply(spark, join, [name]) == [verdict]


def test_first_names_are_a_parameter(spark):
    kind = lambda c: classify_entity(c, ["zed"])["type"]
    assert apply(spark, kind, ["Zed Wug", "John Smith"]) == ["individual", "unknown"]
    assert apply(spark, lambda c: classify_entity(c, short=True)["reason"], ["Smith, John", "john wug"]) == ["no_signal", "firstname_match"]


def test_countries(spark):
    place = lambda c: F.concat_ws("/", normalize_country(c)["name"], normalize_country(c)["code"])
    cases = {"us": "United States/US", "United States": "United States/USA", "KOREA": "North Korea/KP", "NA": "Namibia/NA", " ": "Unknown/XX", None: "Unknown/XX", "atlantis": "Atlantis/XX", "Republic of France": "France/FR"}
    assert dict(zip(cases, apply(spark, place, cases), strict=True)) == cases
    assert apply(spark, lambda c: normalize_country(c, iso=True)["code"], ["united states"]) == ["US"]


def test_similarity_rules():
    assert ratio("tide", "diet") == 0.25 and ratio("diet", "tide") == 0.5
    assert initials_match("IBM", "International Business Machines") and initials_match("Micro", "Microsoft Corp") and not initials_match("xyz", "Acme Tools")
    assert similarity("Acme", "Acme Tools", "acme", "acme tools") >= 0.85 and similarity("Acme", "ACME", "acme", "acme") == 1.0 and similarity("", "x", "", "x") == 0.0
    assert similarity("Alpha Tools", "Beta Tools", "alpha tools", "beta tools") >= 0.80


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('{"a":1}', '{"a":1}'), ('```json\n{"a":1}\n```', '{"a":1}'), ('Sure: {"a":1} ok', '{"a":1}'), ('[{"a":1},2]', '{"a":1}'), ('{"a":[1,2', '{"a":[1,2]}'), ('{"a":1,}', '{"a":1}'), ("none", None), (None, None), ("", None),
        ('{"clusters":[{"canonical":"x","members":[0]},{"canonical":"y","mem', '{"clusters":[{"canonical":"x","members":[0]}]}'),
    ],
)
def test_repair(text, found):
    assert repair(text) == found
