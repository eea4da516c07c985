"""Text functions as column expressions. Offsets are code points, counted from 0."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: All characters that count as white space.
SPACE = "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
HAN = "[\\x{4E00}-\\x{9FFF}]"

ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]

#: Corrections to the platform's traditional-to-simplified map.
LEFT_ALONE = "俱著藉阪燿"
SIMPLIFIED = {"旣": "既", "儁": "俊", "脩": "修", "嶽": "岳", "諮": "咨", "旂": "旗", "麴": "曲"}

#: Characters before (and after) a month numeral that make it a duration.
DURATION_BEFORE = "輒可餘經歷已共閱越逾凡"
ALMOST_AFTER, ALMOST_BEFORE = "日焉許餘", "然圍攻守被經歷越閱逾困"


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def canonical_hash(text: Column) -> Column:
    return F.sha2(strip_space(text), 256)


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, "\\p{P}", "")


def normalized_hash(text: Column, mapping: tuple[str, str] = ("", "")) -> Column:
    """Hash without white space and punctuation, characters mapped (traditional to simplified, upper to lower case, ...)."""
    return F.sha2(F.translate(strip_punctuation(strip_space(text)), *mapping), 256)


def _transliterated(spark, rules: str, source: list[str]) -> list[str]:
    """Each character under rules of the platform's transliterator. Without one on the class path this is an error, as hashes and ids depend on it."""
    jvm = spark._jvm
    for name in ("com.ibm.icu.text.Transliterator", "jdk.internal.icu.text.Transliterator"):
        try:
            transform = getattr(reduce(getattr, name.split("."), jvm), "getInstance")(rules)
        except Exception:  # noqa: BLE001  not on this platform's class path
            continue
        return transform.transliterate("\n".join(source)).split("\n")
    raise RuntimeError("no transliterator on the class path: put ICU4J on it")


def simplification(spark) -> tuple[str, str]:
    """The platform's one-to-one traditional-to-simplified characters, with the corrections above."""
    source = [chr(c) for c in range(0x4E00, 0xA000)]
    pairs = {a: b for a, b in zip(source, _transliterated(spark, "Hant-Hans", source), strict=True) if a != b and a not in LEFT_ALONE} | SIMPLIFIED
    return "".join(pairs), "".join(pairs.values())


def romanization(spark) -> dict[str, str]:
    """Each Chinese character's syllable in plain letters."""
    source = [chr(c) for c in range(0x4E00, 0xA000)]
    said = _transliterated(spark, "Han-Latin; Latin-ASCII; Lower", source)
    return {a: "".join(x for x in b if "a" <= x <= "z") for a, b in zip(source, said, strict=True) if a != b}


def latin_id(name: Column, syllables: dict[str, str]) -> Column:
    """An id of a name: its syllables and its own letters and digits, nothing between."""
    known = F.create_map(*(F.lit(x) for pair in syllables.items() for x in pair)) if syllables else F.create_map().cast("map<string,string>")
    one = lambda c: F.coalesce(F.try_element_at(known, c), F.when(c.rlike("^[A-Za-z0-9]$"), F.lower(c)), F.lit(""))
    return F.array_join(F.transform(F.split(name, ""), one), "")


def ordered_hash(hashes: Column) -> Column:
    """Hash of array<struct<id, hash>> in lexicographic order of id, joined by line ends."""
    return F.sha2(F.array_join(F.transform(F.array_sort(hashes), lambda x: x["h"]), "\n"), 256)


def strip_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, "<[^>]+>", "")


def unescape_basic(text: Column) -> Column:
    """The five entities of XML and the no-break space; the ampersand last, so that nothing is decoded twice."""
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)


def _unescape(texts):
    import html

    import pyarrow as pa

    return pa.array([t if t is None or "&" not in t else html.unescape(t) for t in texts.to_pylist()], pa.string())


def unescape(text: Column) -> Column:
    """All named and numeric character references decoded, in Arrow batches."""
    return F.arrow_udf(_unescape, StringType())(text)


def plain(markup: Column) -> Column:
    return strip_space(unescape(strip_tags(markup)))


def has_min(text: Column, chars: str = HAN, least: int = 5) -> Column:
    """Whether at least so many characters of a class occur."""
    return F.length(F.regexp_replace(text, f"[^{chars[1:-1]}]", "")) >= least


def snippet(text: Column, at: Column, before: int = 25, after: int = 65) -> Column:
    """The text around a place, with an ellipsis on each side that is cut."""
    start, end = F.greatest(at - before, F.lit(0)), F.least(at + after, F.length(text))
    return F.concat(F.when(start > 0, "…").otherwise(""), F.substring(text, start + 1, end - start), F.when(end < F.length(text), "…").otherwise(""))


def char_at(text: Column, at: Column) -> Column:
    """The character at a place; empty before the start and behind the end."""
    return F.when(at < 0, F.lit("")).otherwise(F.substring(text, at.cast("int") + 1, F.lit(1)))


def natural_key(seg_id: Column) -> Column:
    """(book, juan, paragraph, suffix) of `book.juan.pN[a-z]*`; other ids sort first, as ('', 0, 0, '')."""
    rx = "^([A-Za-z]+)\\.(\\d+)\\.p(\\d+)([a-z]*)$"
    part = lambda k: F.regexp_extract(seg_id, rx, k)
    number = lambda k: F.coalesce(F.try_to_number(F.nullif(part(k), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0))
    return F.struct(part(1).alias("book"), number(2).alias("juan"), number(3).alias("para"), part(4).alias("suffix"))


def type_rank(kind: Column) -> Column:
    return F.when(kind.isin("pei", "lixian"), 0).when(kind == "temporal", 1).when(kind == "person", 2).otherwise(3)


def is_duration(text: Column, at: Column, length: Column) -> Column:
    """Whether a month numeral counts months instead of naming one, by the characters around it."""
    before, twice, after = char_at(text, at - 1), char_at(text, at - 2), char_at(text, at + length)
    among = lambda c, chars: (c != "") & F.contains(F.lit(chars), c)
    almost = before == "凡"
    return among(before, DURATION_BEFORE) & (~almost | among(after, ALMOST_AFTER) | among(twice, ALMOST_BEFORE))


def normalize_title(raw: Column) -> Column:
    """`book·chapter` of a page title of the first work: variant marks, volume prefix and ordinal suffix dropped."""
    ordinal, dots = "零一二三四五六七八九十百千０-９0-9", "·•・‧"
    t = F.translate(F.regexp_replace(raw, "[《》]", ""), "呉吴", "吳吳")
    t = F.trim(F.regexp_replace(F.trim(t), f"^卷[{ordinal}]+[\\s{dots}]+", ""))
    rx = f"^(魏書|蜀書|吳書)[{ordinal}]*\\s*[{dots}\\s]+\\s*(.+?)(?:\\s*第[{ordinal}]+)?$"
    return F.when(t.rlike(rx), F.concat(F.regexp_extract(t, rx, 1), F.lit("·"), F.regexp_extract(t, rx, 2))).otherwise(t)


#: Words that a page title of each work holds.
TITLE_WORDS = {
    "sanguozhi": ["魏書", "蜀書", "吳書", "呉書", "吴書"],
    "houhanshu": ["帝紀", "本紀", "皇后紀", "列傳", "列传", "志第", "紀第", "傳第", "传第"],
    "zztj": ["漢紀", "魏紀", "晉紀", "後漢紀"],
}


def normalize_title_by_parts(raw: Column) -> Column:
    """A title of the other works: volume prefix, category with its number, and ordinal suffix dropped."""
    ordinal, part, gap = "[零一二三四五六七八九十百千０-９0-9]+", "[上中下]?", "[\\s\\x{3000}]"
    out = F.trim(F.regexp_replace(raw, "[《》]", ""))
    for rx in (f"^卷{ordinal}{part}[·•・‧\\s\\x{{3000}}]+", f"^(?:帝紀|本紀|皇后紀)第{ordinal}{part}{gap}+", f"{gap}*第{ordinal}{part}{gap}*$"):
        out = F.regexp_replace(out, rx, "")
    return F.trim(out)


def is_canonical(text: Column, simplified: str, traditional: str) -> Column:
    """Whether a text has no simplified character, by a map in which each has one traditional form."""
    return F.translate(text, simplified, traditional) == text


def first_title_line(markup: Column, words: list[str], must_have: str = "") -> Column:
    """The first line after a `<br>` that names one of the words."""
    lines = F.transform(F.regexp_extract_all(markup, F.lit("(?s)<br\\s*/?>(.*?)(?=<br\\s*/?>|</td)"), 1), lambda x: F.trim(unescape_basic(strip_tags(x))))
    named = F.filter(lines, lambda x: reduce(lambda a, b: a | b, (F.contains(x, F.lit(w)) for w in words)) & F.contains(x, F.lit(must_have)))
    return F.try_element_at(named, F.lit(1))


def url_path_encoded(url: Column) -> Column:
    """Percent-encode characters outside ASCII and nothing else, so encoding twice changes nothing."""
    piece = lambda c: F.when(c.rlike("^[\\x00-\\x7F]$"), c).otherwise(F.url_encode(c))
    return F.array_join(F.transform(F.split(url, ""), piece), "")
