from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from spanloom.functions import numerals, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


DIGITS = "一二三四五六七八九"


def spelled(n):
    """A number below 100 in words, by the rule: tens unless one, the sign for ten, ones."""
    tens, ones = divmod(n, 10)
    return (DIGITS[tens - 1] if tens > 1 else "") + ("十" if tens else "") + (DIGITS[ones - 1] if ones else "")


def test_numerals_by_rule(spark):
    rows = [(spelled(n), n) for n in range(1, 100)] + [("元", 1)]
    df = spark.createDataFrame(rows, "said string, n int").withColumn("got", numerals.to_int(F.col("said"))).withColumn("back", numerals.from_int(F.col("n")))
    assert all(r.got == r.n and r.back in (r.said, "一") for r in df.collect())


@pytest.mark.parametrize("said", ["", "千", "十十十", "三四", "八十八十", "x1", "四十百"])
def test_what_is_no_numeral(spark, said):
    assert one(spark, said, numerals.to_int) is None


def test_months_by_rule(spark):
    rows = [(spelled(n), n if n <= 12 else None) for n in range(1, 30)] + [("正", 1), ("", None)]
    got = spark.createDataFrame(rows, "said string, n int").withColumn("got", numerals.to_month(F.col("said"))).collect()
    assert all(r.got == r.n for r in got)


@pytest.mark.parametrize("n", [0, 100, 437])
def test_numbers_without_words_stay_digits(spark, n):
    assert one(spark, n, numerals.from_int, "int") == str(n)


def test_hashes_ignore_what_they_should(spark):
    plain = hashlib.sha256("國志".encode()).hexdigest()
    for t in ("國志", " 國\n志　", " 國\x1c志 "):
        assert one(spark, t, text.canonical_hash) == plain
    assert one(spark, "國，志。", text.normalized_hash) == plain
    assert one(spark, "國志", lambda c: text.normalized_hash(c, ("國", "国"))) == hashlib.sha256("国志".encode()).hexdigest()


def test_order_of_a_file_hash_is_lexicographic(spark):
    rows = spark.createDataFrame([("p2", "b"), ("p10", "a")], "id string, h string")
    got = rows.agg(text.ordered_hash(F.collect_list(F.struct("id", "h"))).alias("y")).first().y
    assert got == hashlib.sha256(b"a\nb").hexdigest()


@pytest.mark.parametrize("at, want", [(0, "x" * 65 + "…"), (50, "…" + "x" * 90 + "…"), (199, "…" + "x" * 26)])
def test_snippets(spark, at, want):
    assert one(spark, "x" * 200, lambda c: text.snippet(c, F.lit(at))) == want


def test_durations(spark):
    """A month numeral behind a word of lapse counts months; the ambiguous one also needs a word around it."""
    sure = [c for c in text.DURATION_BEFORE if c != "凡"]
    rows = [(f"{c}四月行", 1, True) for c in sure] + [(f"凡四月{c}", 1, True) for c in text.ALMOST_AFTER] + [(f"{c}凡四月", 2, True) for c in text.ALMOST_BEFORE]
    rows += [("四月行", 0, False), ("夏四月行", 1, False), ("凡四月行", 1, False), ("凡四月", 1, False)]
    got = spark.createDataFrame(rows, "t string, at int, want boolean").withColumn("got", text.is_duration(F.col("t"), F.col("at"), F.lit(2))).collect()
    assert [r.t for r in got if r.got != r.want] == []


@pytest.mark.parametrize("mark", "·•・‧ ")
@pytest.mark.parametrize("volume", ["", "卷七 ", "卷六十五·"])
def test_titles(spark, mark, volume):
    assert one(spark, f"{volume}蜀書{mark}諸葛亮傳", text.normalize_title) == "蜀書·諸葛亮傳"
    assert one(spark, f"《{volume}吴書十二{mark}虞翻傳第十二》", text.normalize_title) == "吳書·虞翻傳"


def test_natural_keys(spark):
    ids = ["wei.1.p10", "wei.1.p2", "wei.1.p2a", "other", "shu.3.p1"]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").orderBy(text.natural_key(F.col("id"))).collect()
    assert [r.id for r in rows] == ["other", "shu.3.p1", "wei.1.p2", "wei.1.p2a", "wei.1.p10"]


def test_urls_are_encoded_once(spark):
    once = one(spark, "https://a/三國%20x?q=志", text.url_path_encoded)
    assert once == "https://a/%E4%B8%89%E5%9C%8B%20x?q=%E5%BF%97" and one(spark, once, text.url_path_encoded) == once


@pytest.mark.parametrize("volume", ["", "卷二 ", "卷八十上　"])
@pytest.mark.parametrize("name", ["班固列傳", "竇融列傳"])
def test_titles_by_parts(spark, volume, name):
    assert one(spark, f"{volume}{name}", text.normalize_title_by_parts) == name
    assert one(spark, f"《{volume}{name}　第三十下》", text.normalize_title_by_parts) == name
    assert one(spark, f"{volume}帝紀第二　顯宗皇帝", text.normalize_title_by_parts) == "顯宗皇帝"


@pytest.mark.parametrize("raw", ["&eacute;&#233;&#xE9;", "a &amp;lt; b", "&nope; & x", "", None, "plain"])
def test_references_are_decoded(spark, raw):
    import html

    assert one(spark, raw, text.unescape) == (None if raw is None else html.unescape(raw))


def test_latin_ids(spark):
    assert one(spark, "曹操 b2", lambda c: text.latin_id(c, {"曹": "cao", "操": "cao"})) == "caocaob2"
    try:
        syllables = text.romanization(spark)
    except RuntimeError:
        return  # no transliterator on this class path: an error, not a shorter map
    assert syllables["曹"] == "cao"
