"""Collocations, content sort and filter audit against plain versions of their contracts, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wirelake.llm import collocations as C
from wirelake.llm import content_sort, filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def folder(tmp_path):
    return f"file://{tmp_path}/work"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0) for i, t, lang, s in rows], DOCS)


def odd_rows(seed: int, n: int = 300):
    """Texts of few words with stops, capitals and symbols, copies, repeated rows and nulls."""
    pick = random.Random(seed)
    vocabulary = ["New", "york", "Strasse", "été", "de", "la", "x#y", "100%", "Über", "z"]
    rows = [(None, None, None, None), (None, "", "und", ""), (None, "same", "en", "a"), (1, "same", "en", "a"), (1, "same", "en", "a")]
    for i in range(2, n):
        words = [pick.choice(vocabulary) for _ in range(pick.choice([0, 1, 3, 30, 260]))]
        text = "".join(w + pick.choice([" ", " ", " ", "\t", ". ", ", ", "\n", "  ", "\x0b", "!"]) for w in words)
        rows.append((i, text, pick.choice(["en", "fr", None]), pick.choice(["a", "b", None])))
    rows += [(n + k, rows[k][1], "en", "b") for k in range(2, 120, 2)]
    pick.shuffle(rows)
    return rows


# --- collocations -------------------------------------------------------------------------------


def plain_collocations(rows, longest, least, percent, top):
    counts = defaultdict(Counter)
    for _, text, lang, _ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        candidates = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        scored = []
        for g, a in candidates.items():
            inner = any(len(h) > len(g) and 100 * b >= percent * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, b in candidates.items())
            if not inner:
                score, _, l, r = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


@pytest.mark.parametrize(("seed", "longest", "least", "top"), [(1, 3, 10, 2000), (2, 4, 3, 40), (3, 2, 5, 7)])
def test_collocations(spark, tmp_path, seed, longest, least, top):
    """With slices of a few hundred bytes to a kilobyte and small buckets: counts are added up over both."""
    rows = odd_rows(seed)
    got = C.collocations(frame(spark, rows).repartition(5), folder(tmp_path), longest, least, 50, top, slice_bytes=400 * seed, bucket_bytes=5000)
    assert spark.read.parquet(f"{folder(tmp_path)}/slices").count() > 20
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, longest, least, 50, top)


def test_checks_tell_equal_fingerprints_apart():
    keys, checks = np.array([5, 7, 5, 5], np.uint64), np.array([1, 1, 2, 1], np.uint16)
    order, new = C.grouped(keys, checks)
    assert [sorted(g.tolist()) for g in np.split(order, new[1:])] == [[0, 3], [2], [1]]


@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=50))
def test_planes(values):
    array = np.array(values, np.uint32)
    assert C.from_planes(C.planes(array), np.uint32).tolist() == values


# --- content sort -------------------------------------------------------------------------------


def plain_copies(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), place == ids.index(keep), digest) for place, i in enumerate(ids)]
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", ["1", "8", "97"])
def test_copies(spark, tmp_path, partitions):
    rows = odd_rows(5) + [(5000 + i, "a hot text", "en", "a") for i in range(400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = frame(spark, rows)
        got = [tuple(r) for r in content_sort.exact_copies(table, folder(tmp_path)).collect()]
        places = spark.read.parquet(f"{folder(tmp_path)}/runs").where("range IS NOT NULL").select("range").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got, key=str) == plain_copies(rows)
    assert places > 20 if partitions == "97" else places <= int(partitions)


def test_copies_of_one_group_spread(spark, tmp_path):
    """All rows are copies: each range is part of one group, and one row stays."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x" * 100).alias("text"))
        out = content_sort.exact_copies(table, folder(tmp_path))
        assert out.where("kept").select("doc_id").collect() == [(1999,)]
        assert out.select("keep_id", "group_size").distinct().collect() == [(1999, 2000)]
        assert spark.read.parquet(f"{folder(tmp_path)}/runs").groupBy("range").count().agg(F.max("count")).first()[0] < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_texts_with_a_common_head(spark, tmp_path):
    head = "boilerplate " * 50
    rows = [(i, head + str(i // 2), "en", "a") for i in range(100)]
    assert sorted((tuple(r) for r in content_sort.exact_copies(frame(spark, rows), folder(tmp_path)).collect()), key=str) == plain_copies(rows)


def test_drop_copies_keeps_columns(spark, tmp_path):
    rows = odd_rows(6)
    table = frame(spark, rows).withColumn("head", F.lit("mine")).withColumn("range", F.lit(7)).withColumn("kept", F.lit("mine"))
    out = content_sort.drop_copies(table, folder(tmp_path))
    assert out.columns == table.columns
    kept = out.collect()
    assert sorted(str((r.doc_id, r.text or "")) for r in kept) == sorted(
        str((keep, text)) for text, keep in {(t or ""): max((i for i, u, *_ in rows if (u or "") == (t or "") and i is not None), default=None) for _, t, *_ in rows}.items())
    assert {(r["head"], r["range"], r["kept"]) for r in kept} == {("mine", 7, "mine")}


# --- filter audit -------------------------------------------------------------------------------


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=200))
def test_positional_counts(words):
    got = filter_audit.positional_counts(np.array(words, np.uint32))
    assert got.tolist() == [sum(w >> b & 1 for w in words) for b in range(32)]


def plain_audit(rows, labels):
    good, toxic = ({i for i, *flags in labels if flags[k] == 1 and i is not None} for k in (0, 1))
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[t or ""].append(i)
    parts = defaultdict(list)
    for i, t, _, source in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = {k for k, failed in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)),
            i is not None and any(j is not None and j < i for j in texts[t])), strict=True) if failed}
        parts[source or ""].append((fails, i in good, i in toxic))
    out, shares = [], Counter()
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, own in enumerate(order, 1):
                gone, left = [d for d in left if own in d[0]], [d for d in left if own not in d[0]]
                shares[part, own] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), sum(own in d[0] for d in docs) - len(gone),
                            sum(d[0] == {own} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)])
    return sorted((*r, shares[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit(spark, tmp_path):
    rows = odd_rows(7)
    labels = [(i, i % 3 == 0, i % 7 == 0) for i in range(0, 250)] + [(3, 0, 1), (3, None, None), (None, 1, 1), (99999, 1, 1)]
    table = spark.createDataFrame([(i, q if q is None else int(q), t if t is None else int(t), "x") for i, q, t in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(frame(spark, rows).withColumn("part", F.lit("clash")).withColumn("fails", F.lit(3)), table, folder(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, labels)


# --- odd tables ---------------------------------------------------------------------------------


OPERATORS = {
    "collocations": lambda d, p: C.collocations(d, p, least=1),
    "copies": lambda d, p: content_sort.exact_copies(d, p),
    "drop_copies": lambda d, p: content_sort.drop_copies(d, p),
    "audit": lambda d, p: filter_audit.audit(d, d.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")), p),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_and_long(spark, tmp_path, name):
    table = frame(spark, [(1, "word " * 400_000 + "é", "en", "a"), (2, None, None, None)])
    for column in ("key", "slice", "digest", "head", "first", "range", "size", "words", "part", "kept"):
        table = table.withColumn(column, F.lit("mine"))
    assert OPERATORS[name](table.limit(0), f"{folder(tmp_path)}/none").count() == 0
    assert OPERATORS[name](table, f"{folder(tmp_path)}/long").count() == {"collocations": 2, "audit": 1200}.get(name, 2)
