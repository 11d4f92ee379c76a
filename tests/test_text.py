from __future__ import annotations

import hashlib
import html
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickloom import dimensions
from tickloom.functions.text import plain_text, search_text, stable_key, word_text
from tickloom.operators import aggregate, match
from tickloom.sources.sinks import news_payload

TEXTS = [
    "A &amp; B",
    "&lt;b&gt;Beras&lt;/b&gt; naik",
    "&amp;lt;b&amp;gt;",
    "&copy; 2026 &middot; caf&eacute; &#233; &#xE9; &amp &ampx &nosuch; R&D &",
    "&#0; &#128; &#x81; &#xD800; &#1114112; &#x110000; &#99999999999999999999; &#xFFFFFFFFFFFFFFFFF; a",
    "&#1;&#11;&#14;&#127;&#xFDD0;&#xFFFE;&#x1FFFF;&#13;&#10;&#9;x &#x1F600; &#0000000065; &#x0000041",
    "&notit; &notin; &CounterClockwiseContourIntegral; &NotEqualTilde; &ampamp; &#; &#x; &#xg; &;",
    "&lt&gt;&quotx &frac12 &frac12345 &sup1; &thisnameisfartoolongtobeanykindofentityname; &AMP",
    "  <p class='x'>Harga\n\t GULA</p><br/>turun  ",
    "a  b&nbsp;c",
    "1 < 2 and 3 > 2",
    "",
    None,
]


def expected_plain(text):
    text = html.unescape(text or "")
    return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", text).lower()).strip()


def test_plain_text_examples(spark):
    df = spark.createDataFrame(enumerate(TEXTS), "id int, t string")
    got = {r.id: r.p for r in df.select("id", plain_text("t").alias("p")).collect()}
    assert got == {i: expected_plain(t) for i, t in enumerate(TEXTS)}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab &;#<>lgtampquo19xé\n\t ", max_size=40), min_size=20, max_size=60))
def test_plain_text_random(spark, texts):
    df = spark.createDataFrame(enumerate(texts), "id int, t string")
    got = {r.id: r.p for r in df.select("id", plain_text("t").alias("p")).collect()}
    assert got == {i: expected_plain(t) for i, t in enumerate(texts)}


def articles(spark, texts):
    return spark.createDataFrame(enumerate(texts), "id int, text string").select(
        "id", search_text("text").alias("text")
    )


def mentions(df, **kw):
    found = match.match_entities(df, "text", dimensions.ENTITY_KEYWORDS, **kw)
    return sorted((r.id, r.entity) for r in found.collect())


def test_mentions_in_both_modes(spark):
    df = articles(
        spark,
        [
            "Harga beras dan minyak goreng naik",  # two entities
            "Produk unggulan berasal dari desa",  # only inside other words
            "Gula pasir, gula merah",  # one entity, two keywords
            "Tidak ada",
            None,
        ],
    )
    assert mentions(df) == [
        (0, "Beras"),
        (0, "Minyak Goreng"),
        (1, "Beras"),
        (1, "Gula Pasir"),
        (2, "Gula Pasir"),
    ]
    by_word = [(0, "Beras"), (0, "Minyak Goreng"), (2, "Gula Pasir")]
    assert mentions(df, mode="word") == by_word
    keywords = dimensions.keyword_table(spark)
    joined = match.match_entities_by_join(df, "text", keywords)
    assert sorted((r.id, r.entity) for r in joined.collect()) == by_word
    with pytest.raises(ValueError):
        mentions(df, mode="fuzzy")


def test_phrases_by_join_equal_phrases_by_expression(spark):
    words = {"x": ["of the", "a b c", "z"], "y": ["b"], "w": ["c a"]}
    texts = ["a b c", "of, the z", "c", "", "c a b", "of of the", "a-b-c a"]
    df = articles(spark, texts)
    want = match.match_entities(df, "text", words, mode="word").select("id", "entity").collect()
    table = dimensions.keyword_table(spark, words)
    got = match.match_entities_by_join(df, "text", table).collect()
    assert sorted(want) == sorted(got)


def test_relevance_modes(spark):
    rows = [
        (1, "Pemerintah resmikan jembatan", ""),  # 'ikan' inside a word
        (2, "Harga sapi", None),
        (3, "Cuaca", "<img src='beras.jpg'> cerah"),  # keyword only in a tag
        (4, "Cuaca", "minyak \n goreng"),
        (5, "Cuaca", "cerah"),
    ]
    df = spark.createDataFrame(rows, "id int, title string, summary string")

    def kept(mode):
        found = match.filter_relevant(df, ["title", "summary"], dimensions.TOPIC_KEYWORDS, mode)
        return sorted(r.id for r in found.collect())

    assert kept("substring") == [1, 2, 4]
    assert kept("word") == [2, 4]


def test_link_rules(spark):
    links = [
        ("https://www.cnnindonesia.com/ekonomi/1", "cnnindonesia.com", True),
        ("https://evil.com/cnnindonesia.com", "cnnindonesia.com", False),
        ("https://otomotif.antaranews.com/a", "antaranews.com", False),
        ("https://www.antaranews.com/otomotif/a", "antaranews.com", True),
        ("https://bola.bisnis.com/a", "bisnis.com", False),
        ("https://www.bisnis.com/Sport/a", "bisnis.com", False),
        ("https://www.bisnis.com/ekonomi?x=/sport/", "bisnis.com", True),
        ("HTTPS://M.BISNIS.COM/x", "bisnis.com", True),
        ("not a link", "bisnis.com", False),
        ("https://anything.org/sport/", "anything.org", True),
        ("https://anything.org/", None, True),
    ]
    df = spark.createDataFrame(links, "link string, source string, ok boolean")
    kept = match.filter_links(df, dimensions.link_rule_table(spark))
    assert sorted(r.link for r in kept.collect()) == sorted(x[0] for x in links if x[2])


def test_keys_and_payload(spark):
    link = "https://site/a?b=ç"
    df = spark.createDataFrame([(link, "é" * 700)], "link string, summary string")
    row = news_payload(df).first()
    assert row.key == hashlib.md5(link.encode()).hexdigest()[:12]
    assert row.summary == "é" * 500
    assert df.select(stable_key("link")).first()[0] == row.key


def test_word_text(spark):
    df = spark.createDataFrame([("Gula-pasir, 2x! Été",)], "t string")
    assert df.select(word_text("t")).first()[0] == " gula pasir 2x été "


def test_price_change_by_keyword(spark):
    rows = [("Minyak Goreng", 1.0), ("minyak kayu", 3.0), ("Beras", None), ("Kopi", 9.0)]
    df = spark.createDataFrame(rows, "entity string, pct_change double")
    got = aggregate.price_change_by_keyword(df, dimensions.ENTITY_KEYWORDS).collect()
    changes = {r.entity: r.avg_change_pct for r in got}
    assert changes["Minyak Goreng"] == 2.0
    assert changes["Beras"] == 0.0 and changes["Jagung"] == 0.0
    assert set(changes) == set(dimensions.ENTITY_KEYWORDS)


def test_correlation_without_news_is_empty(spark):
    ticks = spark.createDataFrame([("Beras", 1.0)], "entity string, pct_change double")
    empty = aggregate.news_correlation(ticks, None, dimensions.ENTITY_KEYWORDS)
    assert empty.columns == ["entity", "n_news", "avg_change_pct"] and empty.isEmpty()


def test_correlation_fills_missing_sides(spark):
    ticks = spark.createDataFrame(
        [("Beras", 1.0), ("Beras", None), ("Kopi", -2.0)], "entity string, pct_change double"
    )
    news = articles(spark, ["harga jagung", "beras dan jagung"])
    got = aggregate.change_signs(
        aggregate.news_correlation(ticks, news, dimensions.ENTITY_KEYWORDS)
    ).collect()
    assert {(r.entity, r.n_news, r.avg_change_pct, r.direction) for r in got} == {
        ("Beras", 1, 1.0, "up"),
        ("Jagung", 2, 0.0, "flat"),
        ("Kopi", 0, -2.0, "down"),
    }
    assert {r.abs_change_pct for r in got} == {1.0, 0.0, 2.0}
