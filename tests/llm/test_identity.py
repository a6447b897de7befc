"""Unlike rows and sets whose first hash is equal; what the trees learn without a row's own label."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wirelake.llm import near_duplicates as near
from wirelake.llm import rows as names
from wirelake.llm import url_filter
from wirelake.llm.decontamination import drop_contaminated, judge_contamination
from wirelake.llm.substring_dedup import cut_repeats, remove_repeats
from wirelake.llm.url_filter import judge_urls


def words(start: int, n: int) -> str:
    return " ".join(f"w{i}" for i in range(start, start + n))


TEXTS = [words(0, 60), words(0, 60) + " end", words(1000, 50), "x " + words(1000, 50), words(2000, 3), words(3000, 40), words(0, 60), None]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


@pytest.fixture
def one_hash(monkeypatch):
    monkeypatch.setattr(names, "first_hash", lambda docs: F.lit(7).cast("long"))
    monkeypatch.setattr(near, "_set_ids", lambda hashes, of: np.full(len(of) - 1, 7, np.int64))


def test_near_duplicates(docs, one_hash, tmp_path):
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs, str(tmp_path / "a"), size=4).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5, 6: 0, 7: 7}
    left = near.drop_near_duplicates(docs, str(tmp_path / "b"), size=4).collect()
    assert sorted(r.doc_id for r in left) == [0, 2, 4, 5, 7]


def test_repeats(docs, one_hash):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in remove_repeats(docs, size=35).collect()}
    assert got == {0: (60, 60), 1: (61, 60), 2: (50, 50), 3: (51, 50), 4: (3, 0), 5: (40, 0), 6: (60, 60), 7: (0, 0)}
    assert {r.doc_id: r.text for r in cut_repeats(docs, size=35).collect()} == {0: "", 1: "end", 2: "", 3: "x ", 4: TEXTS[4], 5: TEXTS[5], 6: "", 7: None}


def test_contamination(spark, docs, one_hash, tmp_path):
    benchmark = spark.createDataFrame([("a", words(1010, 20)), ("b", words(2000, 3))], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in judge_contamination(docs, benchmark, str(tmp_path / "a")).where("n_hit > 0").collect()}
    assert got == {2: (20, ["a"]), 3: (20, ["a"]), 4: (3, ["b"])}
    assert sorted(r.doc_id for r in drop_contaminated(docs, benchmark, str(tmp_path / "b")).collect()) == [0, 1, 5, 6, 7]


def test_keys_tell_nulls_from_values(spark):
    rows = spark.createDataFrame([("x", None), (None, "x"), ("", "x"), ("x", ""), (None, None), ("", ""), ("", None), (None, "")], "doc_id string, text string")
    assert rows.select(names.row_key(rows)).distinct().count() == 8


def test_of_equal_rows_a_stated_one_stays(spark, tmp_path):
    rows = [(1, words(0, 9), source) for source in ("b", "a", "c", "a")]
    for i, some in enumerate((rows, rows[::-1])):
        left = near.drop_near_duplicates(spark.createDataFrame(some, "doc_id long, text string, source string"), str(tmp_path / str(i))).collect()
        assert [r.source for r in left] == ["a"]


def test_own_label_is_left_out_of_shares(spark):
    """A labelled url learns nothing from itself or its copies, an unlabelled one has the share of all."""
    rows = [(f"u{i}", "own", f"s{i}", 1.0) for i in range(20)] + [("copied", "own", "copied", 1.0)] * 9 + [("open", "own", "copied", None)]
    rows += [(f"v{i}", "mixed", f"t{i}", float(i % 2)) for i in range(40)]
    urls = url_filter._with_statistics(spark.createDataFrame(rows, "url string, suffix string, domain string, label double"), "domain")
    assert {r.domain_blocked for r in urls.where("label IS NOT NULL").collect()} == {0.5}
    assert [r.domain_blocked for r in urls.where("label IS NULL").collect()] == [10 / 11]
    shares = url_filter._with_statistics(spark.createDataFrame(rows, "url string, suffix string, domain string, label double"), "suffix")
    assert shares.where("suffix = 'mixed'").select("suffix_blocked").distinct().count() <= url_filter.FOLDS


def test_labels_of_others_are_not_learnt(spark):
    """Urls whose labels are held out get the score that the others teach, and keep the verdict of their rule."""
    rows = [(i, f"http://{'ab'[i % 2]}{i:03d}.net/{'1234567890' * (i % 2)}{i}") for i in range(300)] + [(1000, "http://a0.org/12345678901"), (1001, "http://a0.net/9")]
    rules = [("block", "a0.net/"), ("block", "net/1"), ("allow", "net/"), ("allow", "org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = {r.page_id: r for r in judge_urls(pages, rules, rounds=5, learn=F.col("page_id") < 1000).where("page_id >= 1000").collect()}
    assert out[1000].verdict == "allow" and out[1001].verdict == "block"
    assert out[1000].score > 0.5 > out[1001].score


@pytest.mark.parametrize("job", [remove_repeats, cut_repeats])
def test_texts_move_once_for_their_repeats(spark, docs, job):
    """The join with the places of segments and the join with the spans read the same exchange."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = job(docs, size=35)
        found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    joins = [line for line in plan.split("\n") if "Exchange" in line and "key#" in line]
    assert sum("ReusedExchange" in line and "doc#" in line for line in joins) == 2
    assert sum("ReusedExchange" not in line for line in joins) == 3  # texts, places and spans
