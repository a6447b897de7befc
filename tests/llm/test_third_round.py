"""Cases found by probing: blocks around dropped parts, classes inside articles, wrong ids, links of a hot node."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from sentencepiece import SentencePieceProcessor

from wirelake.llm import components as K
from wirelake.llm import pieces
from wirelake.llm.arrays import text_buffer
from wirelake.llm.main_text import main_text

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize(("page", "wanted"), [
    ("<article>foo<div hidden>x</div>bar</article>", ["foo", "bar"]), ("<article>foo<form>x</form>bar</article>", ["foo", "bar"]),
    ("<article>foo<aside>x</aside>bar</article>", ["foo", "bar"]), ("<article>foo<p></p>bar</article>", ["foo", "bar"]),
    ("<article>foo<div></div><div></div>bar</article>", ["foo", "bar"]), ("<article>foo<span hidden>x</span>bar</article>", ["foobar"]),
    ("<article>a</div>b</article>", ["ab"]), ("<article>a<b>b</b>c<br>d</article>", ["abc d"]), ("<article>a<ul><li>b<li>c</ul>d</article>", ["a", "b", "c", "d"]),
    ("<main><header><h1>Head</h1></header><p>text</p></main>", ["Head", "text"]), ("<header>menu</header><main><p>text</p></main>", ["text"]),
    ("<article><p class='share-price'>a</p><section class='social-history'>b</section><div class='search-and-rescue'>c</div><p class='comment-on-policy'>d</p></article>", ["a", "b", "c", "d"]),
    ("<article>a<div class='social-share'>x</div><div class='shareButtons big'>x</div><div class='related-articles'>x</div><ul class=comments>x</ul>b</article>", ["a", "b"]),
    ("<body><div class='has-ads sidebar'>x</div><div class='no-js nav'>x</div><div class='has-sidebar'><p>text of the page</p></div></body>", ["text of the page"]),
    ("<article><p>a <label>b</label> c</p></article>", ["a b c"]), ("<body><label>x</label><p>text</p></body>", ["text"]),
])
def test_main_text_probes(page, wanted):
    assert main_text(page) == "\n\n".join(wanted)


def test_ids_outside_the_model(spark):
    for ids in ([-1], [-2, 5], [32_000], [5, None]):
        with pytest.raises(PythonException, match="ids"):
            pieces.decode(spark.createDataFrame([(ids,)], "token_ids array<int>"), MODEL).collect()
    rows = pieces.decode(spark.createDataFrame([(None,), ([],), ([306],)], "token_ids array<int>"), MODEL).collect()
    assert [r.decoded for r in rows][:2] == ["", ""]


def test_bytes_that_are_no_text():
    """Lists of byte pieces that cut a character are decoded one by one; half a character of two bytes is as in the library."""
    own, library = pieces.Pieces(MODEL), SentencePieceProcessor(model_file=MODEL)
    broken = [[own.of_byte[0xC3]], [own.of_byte[0xA9]], library.encode("plain"), []]
    flat, places = np.array([i for ids in broken for i in ids], np.int32), np.r_[0, np.cumsum([len(i) for i in broken])]
    assert own.decode_all(flat, places).to_pylist() == [library.decode(ids) for ids in broken]


@pytest.mark.parametrize("seed", [1, 2])
def test_slices_as_the_library(seed):
    own, library, pick = pieces.Pieces(MODEL), SentencePieceProcessor(model_file=MODEL), random.Random(seed)
    words = ["the", "Straße", "日本", "▁", " ", "  ", "\n", "\t", "é", "x" * 70, "😀", "un", "believ", "able", "0x1F", "don't", ""]
    texts = ["".join(pick.choice(words) + pick.choice(["", " ", "  "]) for _ in range(pick.randrange(12))) for _ in range(400)]
    for some in (texts, [t.replace("▁", "") for t in texts]):
        ids, places = own.encode_all(*text_buffer(pa.array(some)))
        got = [ids[a:b].tolist() for a, b in zip(places[:-1], places[1:], strict=True)]
        assert got == [library.encode(t) for t in some]
        assert own.decode_all(ids, places).to_pylist() == [t.replace("▁", " ") for t in some]


def test_neighbours_that_stay():
    own, pick = pieces.Pieces(MODEL), random.Random(5)
    known = [p for p in own.score if pieces.BLANK not in p and own.merge(p) == [p]]
    pairs = [(pick.choice(known), pick.choice(known)) for _ in range(4000)]
    pairs += [(p[:k], p[k:]) for p in pick.sample(known, 3000) if len(p) > 1 for k in [pick.randrange(1, len(p))] if p[:k] in own.score and p[k:] in own.score]
    for a, b in pairs:
        if own.merge(a) == [a] and own.merge(b) == [b]:
            assert own._stays(a, b) == (own.merge(a + b) == [a, b]), (a, b)


def plain_roots(links):
    root = {n: n for pair in links for n in pair}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in root}


GRAPHS = {
    "chain": [(i, i + 1) for i in range(300)], "reversed chain": [(i + 1, i) for i in reversed(range(300))], "star": [(500, i) for i in range(400)],
    "low star": [(0, i) for i in range(1, 400)], "random": [(random.Random(i).randrange(400), random.Random(i + 7).randrange(400)) for i in range(300)],
    "negative": [(-5, 3), (3, 2**62), (-(2**62), -5)], "shuffled chain": [(i * 7919 % 1009, (i + 1) * 7919 % 1009) for i in range(1008)],
}


@pytest.mark.parametrize("name", GRAPHS)
@pytest.mark.parametrize("chunk", [3, 1 << 20])
def test_components_of_graphs(spark, tmp_path, monkeypatch, name, chunk):
    monkeypatch.setattr(K, "CHUNK", chunk)
    links = GRAPHS[name] + GRAPHS[name][:5]
    got = K.components(spark.createDataFrame(links, "a long, b long").repartition(5), f"{tmp_path}/c").collect()
    wanted = {n: r for n, r in plain_roots(links).items() if any(n != m for pair in links if n in pair for m in pair)}
    assert {r.node: r.root for r in got} == wanted and len(got) == len(wanted)


def test_no_links(spark, tmp_path):
    assert K.components(spark.createDataFrame([], "a long, b long"), f"{tmp_path}/none").count() == 0
    assert K.components(spark.createDataFrame([(1, 1)], "a long, b long"), f"{tmp_path}/self").count() == 0
