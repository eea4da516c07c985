"""Dates in segments: absolute and relative mentions, and the ordered state that resolves them.

Mentions are found with native expressions; only these few rows, not the texts, pass the state machine, one
group per document.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numerals, text
from .spans import alternation, find_all

#: Era names with first and last year AD and their dynasty.
ERAS = [
    ("更始", 23, 25, "han"),
    ("建武", 25, 56, "han"),
    ("中元", 56, 57, "han"),
    ("永平", 58, 75, "han"),
    ("建初", 76, 84, "han"),
    ("元和", 84, 87, "han"),
    ("章和", 87, 88, "han"),
    ("永元", 89, 105, "han"),
    ("元興", 105, 105, "han"),
    ("延平", 106, 106, "han"),
    ("永初", 107, 113, "han"),
    ("元初", 114, 120, "han"),
    ("永寧", 120, 121, "han"),
    ("建光", 121, 122, "han"),
    ("延光", 122, 125, "han"),
    ("永建", 126, 132, "han"),
    ("陽嘉", 132, 135, "han"),
    ("永和", 136, 141, "han"),
    ("漢安", 142, 144, "han"),
    ("建康", 144, 144, "han"),
    ("永熹", 145, 145, "han"),
    ("永憙", 145, 145, "han"),
    ("本初", 146, 146, "han"),
    ("建和", 147, 149, "han"),
    ("和平", 150, 150, "han"),
    ("元嘉", 151, 152, "han"),
    ("永興", 153, 154, "han"),
    ("永壽", 155, 158, "han"),
    ("延熹", 158, 167, "han"),
    ("永康", 167, 167, "han"),
    ("建寧", 168, 172, "han"),
    ("熹平", 172, 178, "han"),
    ("光和", 178, 184, "han"),
    ("中平", 184, 189, "han"),
    ("光熹", 189, 189, "han"),
    ("昭寧", 189, 189, "han"),
    ("永漢", 189, 189, "han"),
    ("初平", 190, 193, "han"),
    ("興平", 194, 195, "han"),
    ("建安", 196, 220, "han"),
    ("延康", 220, 220, "han"),
    ("黃初", 220, 226, "wei"),
    ("太和", 227, 233, "wei"),
    ("青龍", 233, 237, "wei"),
    ("景初", 237, 239, "wei"),
    ("正始", 240, 249, "wei"),
    ("嘉平", 249, 254, "wei"),
    ("正元", 254, 256, "wei"),
    ("甘露", 256, 260, "wei"),
    ("景元", 260, 264, "wei"),
    ("咸熙", 264, 265, "wei"),
    ("章武", 221, 223, "shu"),
    ("建興", 223, 237, "shu"),
    ("延熙", 238, 257, "shu"),
    ("景耀", 258, 263, "shu"),
    ("炎興", 263, 263, "shu"),
    ("黃武", 222, 229, "wu"),
    ("黃龍", 229, 231, "wu"),
    ("嘉禾", 232, 238, "wu"),
    ("赤烏", 238, 251, "wu"),
    ("太元", 251, 252, "wu"),
    ("神鳳", 252, 252, "wu"),
    ("建興", 252, 253, "wu"),
    ("五鳳", 254, 256, "wu"),
    ("太平", 256, 258, "wu"),
    ("永安", 258, 264, "wu"),
    ("元興", 264, 265, "wu"),
    ("甘露", 265, 266, "wu"),
    ("寶鼎", 266, 269, "wu"),
    ("建衡", 269, 271, "wu"),
    ("鳳凰", 272, 274, "wu"),
    ("天冊", 275, 275, "wu"),
    ("天璽", 276, 276, "wu"),
    ("天紀", 277, 280, "wu"),
    ("泰始", 265, 274, "jin"),
    ("咸寧", 275, 279, "jin"),
    ("太康", 280, 289, "jin"),
]
#: Dynasties whose eras a book may mean.
BOOK_DYNASTIES = [
    ("wei", "wei"),
    ("wei", "han"),
    ("shu", "shu"),
    ("shu", "han"),
    ("wu", "wu"),
    ("wu", "han"),
    ("hhs", "han"),
    ("zztj", "han"),
    ("zztj", "wei"),
    ("zztj", "shu"),
    ("zztj", "wu"),
    ("zztj", "jin"),
]
#: Openings of segments that tell of earlier events.
FLASHBACK = ("初，", "初．", "先是，", "先是。", "昔，", "往者，")

_YEAR = "[元一二三四五六七八九十]+年"
_MONTH = "(?:春|夏|秋|冬)?(?:正|[一二三四五六七八九十]+)月"
KINDS = ["absolute", "bare_year", "this_year", "next_year", "prev_year", "bare_month"]
MENTION = "struct<at:int,length:int,kind:string,era:string,start_ad:int,end_ad:int,number:int,month_chinese:string,month_ordinal:int,surface:string>"
RESOLVED = "at int, length int, surface string, kind string, resolution string, year_ad int, era string, era_year int, month_chinese string, month_ordinal int, reasoning string, confidence double"


def eras(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ERAS, "name string, start_ad int, end_ad int, dynasty string")


def book_dynasties(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BOOK_DYNASTIES, "book string, dynasty string")


def resolve_eras(mentions: DataFrame, dimension: DataFrame, allowed: DataFrame) -> DataFrame:
    """Mentions (id, book, era, era_year) with the one era that fits the book and is long enough; others go.

    Both dimensions are the fixed tables above, a few dozen rows.
    """
    d = dimension.join(F.broadcast(allowed), "dynasty").withColumnRenamed("name", "era")
    fit = mentions.join(F.broadcast(d), ["book", "era"]).where((F.col("era_year") >= 1) & (F.col("era_year") <= F.col("end_ad") - F.col("start_ad") + 1))
    one = fit.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.first("start_ad").alias("start_ad"), F.first("end_ad").alias("end_ad")).where("n = 1").drop("n")
    return mentions.join(one, "id").withColumn("year_ad", numerals.to_ad(F.col("start_ad"), F.col("era_year")))


def _month_behind(t, end):
    """The month that starts exactly at a place, empty if none does."""
    return F.regexp_extract(F.substring(t, end + 1, F.length(t)), f"^({_MONTH})", 1)


def _month_number(month):
    return numerals.to_month(F.regexp_extract(month, "(正|[一二三四五六七八九十]+)月", 1))


def mentions(segments: DataFrame, dimension: DataFrame, allowed: DataFrame) -> DataFrame:
    """All date mentions of segments (doc, seg_idx, seg_id, book, text), in order of place and kind.

    Columns: doc, seg_idx, seg_id, flashback, at, length, kind, era, start_ad, end_ad, number, month_chinese, month_ordinal, surface.
    """
    t = F.col("text")
    names = alternation([n for n, *_ in ERAS])
    base = segments.select("doc", "seg_idx", "seg_id", "book", "text")

    def found(pattern: str):
        return base.select("*", F.inline(find_all(t, pattern)))

    def with_month(df: DataFrame) -> DataFrame:
        month = F.nullif(_month_behind(t, F.col("at") + F.col("length")), F.lit(""))
        return df.withColumn("month_chinese", month).withColumn("month_ordinal", _month_number(F.col("month_chinese"))).withColumn("surface", F.concat("surface", F.coalesce("month_chinese", F.lit("")))).withColumn("length", F.length("surface"))

    plain = lambda df, kind: df.withColumn("kind", F.lit(kind))
    rx = f"(?:漢|魏|蜀|吳)?({names})([元一二三四五六七八九十]+)年"
    dated = found(rx.replace("(" + names, "(?:" + names).replace("([元", "(?:[元"))
    dated = dated.withColumn("era", F.regexp_extract("surface", rx, 1)).withColumn("era_year", numerals.to_int(F.regexp_extract("surface", rx, 2))).withColumn("id", F.struct("doc", "seg_idx", "at"))
    absolute = plain(with_month(resolve_eras(dated, dimension, allowed)), "absolute").withColumn("number", F.col("era_year"))

    sentence = (F.col("at") == 0) | (text.char_at(t, F.col("at") - 1) == "。")
    bare = with_month(found(_YEAR).where(sentence).withColumn("number", numerals.to_int(F.regexp_extract("surface", "^(.+)年$", 1))).where("number IS NOT NULL"))
    following = with_month(found("明年"))
    relative = [plain(bare, "bare_year"), plain(found("是歲|是年|其年"), "this_year"), plain(following, "next_year"), plain(found("去年|前年"), "prev_year")]
    month = found(_MONTH).where((text.char_at(t, F.col("at") - 1) != "年") & ~text.is_duration(t, F.col("at"), F.col("length")))
    month = plain(month.withColumn("month_chinese", F.col("surface")).withColumn("month_ordinal", _month_number(F.col("surface"))).where("month_ordinal IS NOT NULL"), "bare_month")

    def same(df: DataFrame) -> DataFrame:
        kinds = {"era": "string", "start_ad": "int", "end_ad": "int", "number": "int", "month_chinese": "string", "month_ordinal": "int"}
        own = [F.col(c).cast(k).alias(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()]
        return df.select("doc", "seg_idx", "seg_id", F.substring("text", 1, 3).alias("opening"), "at", "length", "kind", *own, "surface")

    absolute = same(absolute)
    spans = lambda df: df.select("doc", "seg_idx", F.col("at").alias("_a"), (F.col("at") + F.col("length")).alias("_b"))

    def outside(df: DataFrame, others: DataFrame) -> DataFrame:
        o = spans(others)
        return df.join(o, (df["doc"] == o["doc"]) & (df["seg_idx"] == o["seg_idx"]) & (df["at"] >= o["_a"]) & (df["at"] < o["_b"]), "left_anti")

    years = [outside(same(r), absolute) for r in relative]
    months = outside(same(month), absolute.unionByName(years[0]).unionByName(years[2]))
    out = absolute
    for r in (*years, months):
        out = out.unionByName(r)
    opening = F.lit(False)
    for f in FLASHBACK:
        opening = opening | F.startswith("opening", F.lit(f))
    return out.withColumn("flashback", opening).drop("opening")


@dataclass(frozen=True)
class Clock:
    """Where a narrative stands: a year, and the era it is counted in if known."""

    year: int | None = None
    era: str | None = None
    first: int = 0
    last: int = 0

    @property
    def era_year(self) -> int | None:
        return self.year - self.first + 1 if self.era is not None and self.year is not None else None

    def at_year(self, year: int) -> Clock:
        """The same era if it still covers the year, else no era."""
        return replace(self, year=year) if self.era is not None and self.first <= year <= self.last else Clock(year)

    def __str__(self) -> str:
        if self.era_year is not None:
            return f"{self.era}{_written(self.era_year)}年 (AD {self.year})"
        return f"AD {self.year}" if self.year else "(無錨)"


def _written(year: int) -> str:
    return "元" if year == 1 else str(year)


class Narrative:
    """Resolves mentions in order.

    Two clocks run: the document's, and the segment's, which starts from it. An absolute date behind the
    document's clock is a look back: until the segment ends or a newer absolute date comes, only the segment's clock follows.
    """

    def __init__(self):
        self.at, self.document, self.here, self.back = (None, None), Clock(), Clock(), False

    def read(self, doc, seg_idx, kind, era, start_ad, end_ad, number, said, flashback) -> tuple | None:
        """(year, era, year of the era, reasoning, confidence), or None where nothing says the year."""
        if (doc, seg_idx) != self.at:
            if doc != self.at[0]:
                self.document = Clock()
            self.at, self.here, self.back = (doc, seg_idx), self.document, False
        here = self.here
        if kind == "absolute":
            now = Clock(start_ad + number - 1, era, start_ad, end_ad)
            self.back = self.document.year is not None and now.year < self.document.year
            note = f"原文「{said}」直接出现年号；解析為 AD {now.year}" + ("（回溯前事，不推進章節時間軸）" if self.back else "")
        elif kind == "bare_year":
            if here.era is None or number > here.last - here.first + 1:
                return None
            now = replace(here, year=here.first + number - 1)
            note = f"承前文年號「{now.era}」推得，「{said}」 = {now.era}{_written(number)}年 = AD {now.year}"
        elif here.year is None:
            return None
        elif kind == "this_year":
            now, note = here, f"「{said}」 = 当前年 {here}"
        elif kind == "next_year":
            now = here.at_year(here.year + 1)
            note = f"「{said}」 = 当前年 {here} 之次年 = AD {now.year}" + ("" if now.era else "（跨年號邊界，新年號未明）")
        elif kind == "prev_year":
            now = here.at_year(here.year - 1)
            note = f"「{said}」 = 当前年 {here} 之前一年 = AD {now.year}（往回引述，章節時間軸不變）"
        else:
            now, note = here, f"年承前文 {here}，月份「{said}」"
        if kind in ("absolute", "bare_year", "next_year"):
            self.here = now
            if not self.back:
                self.document = now
        return now.year, now.era, now.era_year, note, 0.5 if kind != "absolute" and flashback and not self.back else None


def resolve(found: DataFrame) -> DataFrame:
    """Resolved dates of mentions(). A task reads its documents' mentions in order and holds one batch, however long a document is."""
    schema = f"doc {found.schema['doc'].dataType.simpleString()}, seg_idx {found.schema['seg_idx'].dataType.simpleString()}, seg_id string, {RESOLVED}"
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    said = ["doc", "seg_idx", "kind", "era", "start_ad", "end_ad", "number", "surface", "flashback"]
    kept = ["doc", "seg_idx", "seg_id", "at", "length", "surface", "kind", "month_chinese", "month_ordinal"]
    made = {"year_ad": pa.int32(), "era": pa.string(), "era_year": pa.int32(), "reasoning": pa.string(), "confidence": pa.float64()}
    order = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        story = Narrative()
        for batch in batches:
            got = [story.read(*row) for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in said), strict=True)]
            rows = batch.filter(pa.array([x is not None for x in got], pa.bool_()))
            got = [x for x in got if x is not None]
            out = {c: rows.column(rows.schema.get_field_index(c)) for c in kept}
            out |= {c: pa.array([x[k] for x in got], t) for k, (c, t) in enumerate(made.items())}
            out["resolution"] = out["kind"]
            out["kind"] = pa.array(["absolute" if k == "absolute" else "relative" for k in out["resolution"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([out[c] for c in order], names=order)

    ints = {c: F.col(c).cast("int") for c in ("at", "length", "start_ad", "end_ad", "number", "month_ordinal")}
    rows = found.withColumns(ints).repartition("doc").sortWithinPartitions("doc", "seg_idx", "at", rank, "length", "surface")
    return rows.select(*dict.fromkeys(said + kept)).mapInArrow(run, schema)


def out_of_order(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Rows with `backward`: whether the value lies behind the greatest one before it in the group."""
    from pyspark.sql import Window

    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("backward", F.coalesce(F.col(value) < F.max(value).over(w), F.lit(False)))
