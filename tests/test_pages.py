from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkrank.operators.pages import malformed_records, page_links, parse_pages
from tests import brute


def links_of(spark, bodies, title="Alpha Page"):
    rows = [(i, brute.page(title, body)) for i, body in enumerate(bodies)]
    linked = page_links(parse_pages(spark.createDataFrame(rows, "id int, xml string")))
    found = {row.id: row.links for row in linked.collect()}
    return [found[i] for i in range(len(bodies))]


CASES = [
    ("[[Beta]] [[Beta|b]]", ["Beta"]),
    ("[[Alpha Page]]", []),
    ("[[alpha Page]]", ["alpha_Page"]),
    ("[[ Gamma ]]", ["_Gamma_"]),
    ("[[one] x", ["one"]),
    ("[[[tri]]]", ["[tri"]),
    ("[[]] [[|p]]", [""]),
    ("[[File:x.jpg|thumb|cap [[Gamma]] more]]", ["File:x.jpg"]),
    ("[[A#s]] [[a/b]] [[C:d]]", ["A#s", "a/b", "C:d"]),
    ("[[A &amp; B]]", ["A_&amp;_B"]),
    ("[[multi\nline]]", ["multi\nline"]),
    ("[[done]] [[never closed", ["done"]),
    ("never [[closed", []),
    ("", []),
    ("no links ] at all", []),
    ("[[é|x]] ünï [[日本 語]] [[open", ["é", "日本_語"]),
    ("[[a|b|c]] [[d] e] [[f]]", ["a", "d", "f"]),
]


def test_link_rules(spark):
    found = links_of(spark, [body for body, _ in CASES])
    assert [sorted(links) for links in found] == [sorted(expected) for _, expected in CASES]


def test_long_unclosed_links_stay_linear(spark):
    body = "[[a]] " + "[[" * 300_000
    assert links_of(spark, [body, "[" * 500_000 + "]"]) == [["a"], ["[" * 499_998]]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="[]| aAb\n_é", max_size=30), min_size=1, max_size=40))
def test_links_match_a_plain_scan(spark, bodies):
    expected = [
        {t.split("|")[0].replace(" ", "_") for t in re.findall(r"\[\[([^\]]*)\]", body)}
        - {"Alpha_Page"}
        for body in bodies
    ]
    found = links_of(spark, bodies)
    assert [set(links) for links in found] == expected
    assert all(len(links) == len(set(links)) for links in found)


RECORDS = [
    ("plain", "<page><title>A b</title><text>x</text></page>", ("A_b", "x")),
    ("attributes", '<page><title>T</title><text a="1" b>y</text></page>', ("T", "y")),
    ("empty body", "<page><title>E</title><text></text></page>", ("E", "")),
    ("empty title", "<page><title></title><text>z</text></page>", ("", "z")),
    ("no body", '<page><title>N</title><text a="1" /></page>', None),
    ("no text tag", "<page><title>N</title></page>", None),
    ("no title", "<page><text>x</text></page>", None),
    ("unclosed title", "<page><title>N<text>x</text></page>", None),
    ("first of each", "<title>1</title><title>2</title><text>a</text><text>b</text>", ("1", "a")),
    ("raw", "<title> &lt; </title><text> &amp;\n </text>", ("_&lt;_", " &amp;\n ")),
    ("close before open", "</title></text><title>Q</title><text>q</text>", ("Q", "q")),
    ("longer tag", "<title>L</title><textual>b</text>", ("L", "b")),
    ("second closes", "<title>S</title><text a<text>b</text>", ("S", "b")),
    ("wide", "<title>日本 語</title>é<text>ü[[ö]]</text>", ("日本_語", "ü[[ö]]")),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(name, xml) for name, xml, _ in RECORDS]
    return spark.createDataFrame(rows, "name string, xml string")


def test_title_and_body(parsed):
    found = {row.name: (row.title, row.body) for row in parse_pages(parsed).collect()}
    assert found == {name: expected for name, _, expected in RECORDS if expected is not None}


def test_substring_parse_equals_the_regular_expressions(parsed):
    body = r"(?s)<text[^>]*>(.*?)</text>"
    title = r"(?s)<title>(.*?)</title>"
    by_regex = parsed.where(F.col("xml").rlike(body) & F.col("xml").rlike(title)).select(
        "name",
        F.translate(F.regexp_extract("xml", title, 1), " ", "_").alias("title"),
        F.regexp_extract("xml", body, 1).alias("body"),
    )
    assert sorted(parse_pages(parsed).collect()) == sorted(by_regex.collect())


def test_malformed_records_are_counted(parsed):
    names = {row.name for row in malformed_records(parsed).collect()}
    assert names == {"no text tag", "no title", "unclosed title"}
