"""Batch jobs from files to published views, on a small corpus of their own."""

from __future__ import annotations

import hashlib
import json

import pytest
import yaml
from pyspark.sql import functions as F

from spanloom import cli
from spanloom.operators import brackets, publish, validate
from spanloom.plans import jobs
from spanloom.sources import corpus, html, sinks

TEXT = ["建安五年春正月，曹操還許〈許，縣名〉。", "六年，操征劉備。備走荊州。", "明年，太子立。"]
ROSTER = [(0, "caocao", "曹操", "操", ["操行"], ["太祖"], ["wei.9"], "孟德", "魏王"), (1, "liubei", "劉備", "備", ["完備"], [], ["wei.1"], "玄德", "漢主")]
SHA = "0" * 64


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    page = '<table><td>x</td></table><div class="mw-content mw-parser-output" lang="zh">' + "".join(f"<p>{t}</p>" for t in TEXT) + '<p>短</p></div><div id="catlinks"><p>類別不是正文的一段</p></div>'
    (root / "pages").mkdir()
    (root / "pages/one.html").write_text(page)
    manifest = spark.createDataFrame([("wei.1", "sanguozhi", "wei", 1, "武帝紀", "one.html"), ("wei.2", "sanguozhi", "wei", 2, "文帝紀", "two.html")], "doc string, work string, book string, juan int, title string, file string")
    got = jobs.ingest(spark, f"{root}/pages", manifest, str(root)).collect()
    assert {r.doc: (r.status, r.n_segments) for r in got} == {"wei.1": ("ok", 3), "wei.2": ("missing", 0)}
    people = spark.createDataFrame(ROSTER, "rank int, id string, primary_name string, given_name string, given_name_blockers array<string>, aliases array<string>, bio_chapters array<string>, courtesy_name string, brief string")
    people = people.withColumn("chapter_aliases", F.create_map().cast("map<string,array<string>>")).withColumns({"birth_ad": F.lit(155), "death_ad": F.lit(220)})
    people.write.parquet(f"{root}/roster")
    return str(root)


def test_from_pages_to_views(spark, folder, tmp_path):
    notes = spark.read.parquet(f"{folder}/annotations").where("type = 'pei'").collect()
    assert [(r.id, r["at"], r.text) for r in notes] == [("wei.1.p1.a1", 12, "許，縣名")]
    for _ in range(2):  # twice changes nothing
        assert [(r.chapter, r.n) for r in jobs.extract_dates(spark, folder).collect()] == [("wei.1", 3)]
        assert [(r.chapter, r.n) for r in jobs.extract_persons(spark, folder, only=["wei.1"]).collect()] == [("wei.1", 4)]
    rows = {r.id: r for r in spark.read.parquet(f"{folder}/annotations").collect()}
    assert {k: rows[k].year_ad for k in rows if rows[k].type == "temporal"} == {"wei.1.p1.t1": 200, "wei.1.p2.t1": 201, "wei.1.p3.t1": 202}
    assert sorted(r.person_id for r in rows.values() if r.type == "person") == ["caocao", "caocao", "liubei", "liubei"]
    asked = jobs.find_ambiguous(spark, folder, f"{tmp_path}/asked").collect()
    assert [r.doc for r in asked] == ["wei.1"]
    (tmp_path / "said").mkdir()
    (tmp_path / "said/one.json").write_text(json.dumps([{"anchor": "wei.1.p3", "at": 3, "length": 2, "surface": "太子", "confidence": 0.9, "reasoning": "曹操之太子", "person_id": "caocao"}, {"anchor": "wei.1.p3", "at": 0, "length": 2, "surface": "太子", "confidence": 0.9, "person_id": "caocao"}], ensure_ascii=False))
    said = {(r.status, r.reason): r.n for r in jobs.merge_decisions(spark, folder, f"{tmp_path}/said").collect()}
    assert said == {("accepted", None): 1, ("rejected", "the span holds other text"): 1}
    assert spark.read.parquet(f"{folder}/annotations").where("type = 'person'").count() == 5
    written = {r.name: r.n for r in jobs.publish_site(spark, folder, f"{tmp_path}/site").collect()}
    assert written == {"chapters": 1, "chapter_index": 1, "timeline": 3, "people": 2, "people_index": 2, "names": 3}


def test_command_line(spark, folder, capsys):
    assert cli.main(["get-segment", "wei.1.p2", "--corpus", folder], spark) == 0
    assert json.loads(capsys.readouterr().out)["text"] == "六年，操征劉備。備走荊州。"
    assert cli.main(["get-segment", "wei.1.p9", "--corpus", folder], spark) == 2
    assert json.loads(capsys.readouterr().err)["error"]["code"] == "not_found"
    assert cli.main(["extract-dates", folder, "--output", "text"], spark) == 0
    assert capsys.readouterr().out.split("\t")[0] == "wei.1"


def head(sha):
    return f"---\nwork: sanguozhi\nwork_title: t\nbook: wei\nbook_title: b\njuan: 1\ntitle: x\nauthor: y\nscript: traditional\nsource:\n  id: wikisource\n  url: u\n  retrieved: '2026-01-01'\n  sha256: '{SHA}'\nsegments_sha256: '{sha}'\n---\n\n"


def test_checks_of_files(spark, tmp_path):
    body = '<a id="wei.1.p1"></a>\n建安五年\n\n<a id="wei.1.p2"></a>\n次年\n'
    (tmp_path / "texts").mkdir()
    (tmp_path / "annotations").mkdir()
    (tmp_path / "texts/01.md").write_text(head("1" * 64) + body)
    note = {"id": "wei.1.p1.a1", "anchor": "wei.1.p1", "at": 9, "length": 0, "type": "pei", "text": "n"}
    good = {"chapter": "wei.1", "source": {"id": "wikisource", "url": "u", "retrieved": "2026-01-01", "sha256": SHA}, "annotations": [note]}
    (tmp_path / "annotations/01.yaml").write_text(yaml.safe_dump(good))
    (tmp_path / "annotations/02.yaml").write_text("a: [")
    (tmp_path / "annotations/03.yaml").write_text(yaml.safe_dump({"chapter": "Wei", "source": {"id": "other", "sha256": "x"}, "annotations": [1]}))
    found = {(r.path.split("/")[-1], r.rule) for r in jobs.check(spark, str(tmp_path)).collect()}
    assert found == {
        ("01.md", "the segments have changed"), ("wei.1", "the place lies outside the segment"), ("02.yaml", "the file cannot be read: ParserError"), ("03.yaml", "the chapter does not fit"), ("03.yaml", "source.url is missing"),
        ("03.yaml", "source.retrieved is missing"), ("03.yaml", "the source is unknown"), ("03.yaml", "the hash does not fit"), ("03.yaml", "annotation 0 is not a mapping"),
    }
    state = jobs.segment_hashes(spark, str(tmp_path / "texts"), update=str(tmp_path / "new")).collect()
    assert [r.state for r in state] == ["MISMATCH"]
    lines = [hashlib.sha256(t.encode()).hexdigest() for t in ("建安五年", "次年")]
    want = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    again = spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "new"), wholetext=True).select(F.lit("f").alias("path"), F.col("value").alias("content"))
    assert again.first().content == head("1" * 64).replace(f"'{'1' * 64}'", want) + body
    assert [r.state for r in sinks.stamped(again, spark.createDataFrame([("f", want)], "path string, segments_sha256 string")).collect()] == ["OK"]


def test_yaml_round_trip(spark, folder):
    heads = spark.createDataFrame([("wei.1", "wikisource", "u", "2026-01-01", SHA, ["w"])], "chapter string, source_id string, source_url string, retrieved string, source_sha256 string, warnings array<string>")
    rows = spark.read.parquet(f"{folder}/annotations").select(*jobs.FIELDS)
    files = sinks.annotation_yaml(rows, heads).select(F.col("chapter").alias("path"), "content")
    assert yaml.safe_load(files.first().content)["parse_warnings"] == ["w"]
    key = lambda df: sorted(map(str, df.select(*jobs.FIELDS).collect()))
    assert key(corpus.annotations(files)) == key(rows)
    assert corpus.annotation_file_errors(files, validate.SOURCES).count() == 0


def test_variants(spark, folder):
    other = spark.createDataFrame([("wei.1", 1, "建安五年春正月，曹操還許。"), ("wei.1", 2, "六年，操征劉備，備走荊州。"), ("wei.1", 3, "全然不同")], "doc string, para_no int, text string")
    found = jobs.build_variants(spark, folder, other)
    got = found.collect()
    assert sorted((r.seg_id, r.kind, r.source_para_no) for r in got) == [("wei.1.p2", "variant_char", 2), ("wei.1.p3", "textual", 3)]
    found = found.where("kind = 'variant_char'")
    segments = spark.read.parquet(f"{folder}/segments")
    assert validate.variant_violations(found, segments).count() == 0
    broken = found.withColumns({"kind": F.lit("odd"), "source_para_no": F.lit(0), "canonical_hash": F.lit("x")})
    assert {r.rule for r in validate.variant_violations(broken, segments).collect()} == {"the kind is unknown", "the source's paragraph is below 1", "the segment has changed"}
    heads = spark.createDataFrame([("wei.1", "ctext", "u", "2026-01-01", SHA, 3, 3, 2, ["wei.1.p3"], [3])], "chapter string, source_id string, url string, retrieved string, file_sha256 string, n_paragraphs int, n_segments int, n_aligned int, unaligned array<string>, unaligned_source array<int>")
    doc = yaml.safe_load(sinks.variant_yaml(heads, found).first().content)
    assert list(doc["segments"]) == ["wei.1.p2"] and doc["alignment"]["unaligned_source"] == {"ctext": [3]} and doc["segments"]["wei.1.p2"]["diffs"][0]["ops"]


def test_what_to_read(spark):
    rows = lambda *names: spark.createDataFrame([(n,) for n in names], "file string")
    wanted, landed = rows("a", "b", "c"), rows("a")
    act = lambda **more: {r.file: r.action for r in corpus.to_read(wanted, landed, ["file"], **more).collect()}
    assert act() == {"a": "cache", "b": "fetch", "c": "fetch"} and act(mode="refetch", only=["a"]) == {"a": "fetch"}
    assert act(mode="no-fetch", resume=rows("c")) == {"a": "cache", "b": "missing"}
    with pytest.raises(ValueError):
        act(mode="other")


def test_paths_and_json(spark, tmp_path):
    kinds = spark.createDataFrame([("texts/a.md",), ("annotations/x/a.yaml",), ("variants/a.yml",), ("other/a.yaml",), ("a.txt",)], "p string").select(corpus.path_kind(F.col("p")).alias("k")).collect()
    assert [r.k for r in kinds] == ["text", "annotation", "variant", "skip", "skip"]
    (tmp_path / "a.json").write_text('{"id": "x", "n": 1}')
    (tmp_path / "b.json").write_text('{"id": ')
    got = corpus.json_rows(spark, str(tmp_path), "id string, n int").collect()
    assert {(r.id, r.n) for r in got if r.error is None} == {("x", 1)} and len(got) == 2
    assert spark.range(1).select(sinks.path_of("annotation", F.lit("w"), F.lit("b"), F.lit(3)).alias("p")).first().p == "annotations/w/b/03.yaml"


@pytest.mark.parametrize("said, left", [("a〈b〈c〈d〈e〈f〉〉〉〉〉g", "ag"), ("a〉b〈c", "a〉b〈c"), ("〈〉〈x〉y", "y"), ("a〈b〈c〉d", "a〈bd"), ("", "")])
def test_brackets_of_any_depth(spark, said, left):
    row = spark.createDataFrame([(said,)], "t string")
    assert row.select(brackets.innermost_removed(F.col("t")).alias("x")).first().x == left
    if "〈" in left or "〉" in left:
        with pytest.raises(Exception, match="brackets do not balance"):
            row.select(brackets.strict_notes(F.col("t")).alias("x")).collect()
    else:
        assert row.select(brackets.strict_notes(F.col("t")).alias("x")).first().x == said


def test_shown_things(spark):
    rows = spark.createDataFrame([(f"p{i}", n) for i, n in enumerate([0, 3, 7, 12, 64, 500, 4])], "id string, n int")
    assert [(r.band, r.n_rows) for r in publish.in_bands(rows, "n").collect()] == [("100+", 1), ("50-99", 1), ("10-19", 1), ("5-9", 1), ("1-4", 2), ("0", 1)]
    one = spark.createDataFrame([("wei.12.p3a", "<a & 'b'>")], "seg string, t string")
    r = one.select(publish.toc_label(F.col("seg")).alias("label"), publish.escaped(F.col("t")).alias("html"), publish.chapter_route(F.lit("wei.12")).alias("route")).first()
    assert tuple(r) == ("3a", "&lt;a &amp; &#39;b&#39;&gt;", "#/chapter/wei/12")
    order = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "k string, place int")
    assert [r.k for r in publish.groups_in_order(order, "k", "place").collect()] == ["b", "a"]
    page = spark.createDataFrame([('<a href="/x/12/3">', 12), ('<a href="/x/11/3">', 12), ("none", 12)], "h string, juan int")
    assert [r.e for r in page.select(html.wrong_juan(F.col("h"), F.col("juan")).alias("e")).collect()] == [None, "links lead to chapter 11", None]


def test_comments_in_cells(spark):
    raw = 'a&lt;b&gt; &amp;lt; &eacute;<i>x</i><span class="inlinecomment">n&#60;o&#x3e;</span>y &#12345;'
    r = spark.createDataFrame([(raw,)], "raw string").select(html.inline_comments(F.col("raw")).alias("c")).first().c
    assert r.main == "a<b>&lt;éxy〹" and [(n["at"], n.text) for n in r.notes] == [(10, "n<o>")]


def test_answers_and_errors(spark, folder):
    from spanloom.plans.service import Corpus, QueryError, route

    c = Corpus(*(spark.read.parquet(f"{folder}/{t}") for t in ("segments", "annotations", "chapters", "roster"))).cached()
    assert c.one_person("太祖") == "caocao" and c.statistics().first().n_segments == 3
    both = Corpus(c.segments, c.annotations, c.chapters, c.roster.withColumn("aliases", F.array(F.lit("某"))))
    for name, code in (("某", "ambiguous"), ("無", "not_found"), ("", "invalid_input")):
        with pytest.raises(QueryError) as e:
            both.one_person(name)
        assert e.value.code == code and e.value.envelope()["error"]["code"] == code
    assert "[wei.1.p2] 六年" in c.prompt("summarize_chapter", chapter="wei.1")
    with pytest.raises(QueryError):
        c.prompt("other")
    assert route("#/chapter/wei/1") == ("chapter", {"book": "wei", "juan": "1"}) and route("#/people") == ("people", {}) and route("#/x/y") == ("home", {})
