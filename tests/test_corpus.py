"""A whole annotated corpus, if SPANLOOM_CORPUS names one: dates and people must come out as its annotations say."""

from __future__ import annotations

import os

import pytest

from spanloom.operators import dates, persons, validate
from spanloom.sources import corpus

AT = os.environ.get("SPANLOOM_CORPUS", "")
pytestmark = pytest.mark.skipif(not AT, reason="no corpus is named")


@pytest.fixture(scope="module")
def segments(spark):
    return corpus.segments(corpus.files(spark, f"{AT}/texts", "*.md")).cache()


@pytest.fixture(scope="module")
def annotations(spark):
    return corpus.annotations(corpus.files(spark, f"{AT}/annotations", "*.yaml")).cache()


def test_dates(spark, segments, annotations):
    got = dates.resolve(dates.mentions(segments, dates.eras(spark), dates.book_dynasties(spark)))
    key = lambda r, seg, said: (r[seg], r["at"], r["length"], r[said], r["resolution"], r["year_ad"], r["era"], r["era_year"], r["month_chinese"], r["month_ordinal"], r["confidence"])
    none = lambda v: None if v != v else v
    found = {tuple(map(none, key(r, "seg_id", "surface"))) for r in got.collect()}
    assert found == {tuple(map(none, key(r, "anchor", "text"))) for r in annotations.where("type = 'temporal'").collect()}


def test_people(spark, segments, annotations):
    got = persons.person_spans(segments, corpus.roster(spark, f"{AT}/tools/people.yaml"))
    assert {(r.seg_id, r.at, r.length, r.person_id, r.via) for r in got.collect()} == {(r.anchor, r.at, r.length, r.person_id, r.via) for r in annotations.where("type = 'person'").collect()}


def test_files_are_valid(spark, segments, annotations):
    front = corpus.front_matter(corpus.files(spark, f"{AT}/texts", "*.md"))
    assert validate.text_violations(front, segments).count() == 0
    assert validate.annotation_violations(annotations, segments, strict_ends=True).count() == 0
