"""Results of the operators against plain versions of their definitions."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_files
from tokenizers import Tokenizer

from wirelake.llm import pieces, substring_dedup, url_filter
from wirelake.llm.arrays import text_slices
from wirelake.llm.components import components
from wirelake.llm.decontamination import build_postings, by_term, judge_contamination, phrases, proximity_matches, rarest_terms, term_counts
from wirelake.llm.fm_index import FMIndex, WaveletMatrix
from wirelake.llm.main_text import main_text
from wirelake.llm.near_duplicates import CHUNKS, PARTS, index_entries, near_duplicates, shingle_sets, signatures
from wirelake.llm.repetition import Limits, text_signals
from wirelake.llm.rows import row_key
from wirelake.llm.substring_dedup import cut_repeats, remove_repeats
from wirelake.llm.suffixes import common_prefixes, sort_suffixes, suffix_array
from wirelake.llm.token_counts import count_tokens
from wirelake.llm.url_filter import judge_urls
from wirelake.llm.warc import members, read_archives, write_archives

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed: int, n: int, vocabulary: int = 12, longest: int = 120) -> list[str | None]:
    pick = random.Random(seed)
    out: list[str | None] = [None, "", " \n"]
    for _ in range(n):
        words = [f"v{pick.randrange(vocabulary)}" for _ in range(pick.randrange(longest))]
        out.append("".join(w + pick.choice([" ", " ", "\n", "  "]) for w in words))
    return out


# --- suffixes, FM-index -------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffixes(values):
    levels = sort_suffixes(np.array(values, np.int64))
    order = suffix_array(levels)
    assert order.tolist() == sorted(range(len(values)), key=lambda i: values[i:])
    shared = common_prefixes(levels, order)
    for k in range(1, len(values)):
        a, b = values[order[k - 1] :], values[order[k] :]
        same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[k] == same


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=200))
def test_wavelet_ranks(values):
    tree = WaveletMatrix(np.array(values), 9)
    for symbol in range(10):
        places = np.arange(len(values) + 1)
        got = tree.rank(np.full(len(places), symbol), places)
        assert got.tolist() == [values[:p].count(symbol) for p in places]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=25), min_size=1, max_size=6))
def test_matching_statistics(sequences):
    flat = np.array([w for s in sequences for w in s], np.int64)
    of = np.r_[0, np.cumsum([len(s) for s in sequences])].astype(np.int64)
    got = FMIndex(flat, of).matching_statistics(flat, of)
    at = 0
    for s in sequences:
        for i in range(len(s)):
            length = 0
            for n in range(1, len(s) - i + 1):
                if sum(t[j : j + n] == s[i : i + n] for t in sequences for j in range(len(t) - n + 1)) > 1:
                    length = n
            assert got[at] == length
            at += 1


# --- 1 ------------------------------------------------------------------------------------------


def test_repetition_signals():
    given_texts = [*texts(1, 60), "a " * 300, "x # y | z\nx # y | z\n\nx # y | z"]
    got = defaultdict(list)
    for _, _, data, offsets in text_slices(pa.array(given_texts), 500):
        for name, values in text_signals(data, offsets, Limits(min_repeat=4)).items():
            got[name] += values.tolist()
    for i, text in enumerate(given_texts):
        words = WORD.findall(text or "")
        longest = [0] * len(words)
        for a in range(len(words)):
            for b in range(a):
                n = 0
                while a + n < len(words) and words[a + n] == words[b + n]:
                    n += 1
                longest[a], longest[b] = max(longest[a], n), max(longest[b], n)
        windows = Counter(tuple(words[j : j + 3]) for j in range(len(words) - 2))
        twice = {j + k for j in range(len(words) - 2) if windows[tuple(words[j : j + 3])] > 1 for k in range(3)}
        lines = [line for line in (text or "").split("\n") if WORD.search(line)]
        cover = {j + k for j, n in enumerate(longest) if n >= 4 for k in range(n)}
        assert got["n_words"][i] == len(words)
        assert got["word_chars"][i] == sum(map(len, words))
        assert got["n_symbols"][i] == sum((text or "").count(c) for c in "#*$%&|<>")
        assert got["n_dup_lines"][i] == len(lines) - len(set(lines))
        assert got["n_repeat_words"][i] == len(twice)
        assert got["base_failed"][i] == (len(words) < 50 or 2 * len(twice) > len(words))
        assert got["longest_repeat"][i] == max(longest, default=0)
        assert got["covered_share"][i] == pytest.approx(len(cover) / max(len(words), 1))


# --- 2 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("bare words", "bare words"), ("<p>a<p>b &amp; c", "a\n\nb & c"),
    ("<nav><a href=x>Home</a></nav><header>Site</header><article><header><h1>T</h1></header><p>one <b>two</b><br>three</p><p>Be.</p></article><footer>f</footer>", "T\n\none two three\n\nBe."),
    ("<div class='cookie-notice'>We use cookies</div><main><p>Real text here.</p><form><p>Mail</p></form></main><aside>side</aside>", "Real text here."),
    ("<article><p>Story.</p><section id='comments'><article class='comment'><p>" + "Nice! " * 50 + "</p></article></section></article>", "Story."),
    ("<script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>x &lt;b&gt; 1 < 2</p><p>cut &#8217; off</p", "x <b> 1 < 2\n\ncut ’ off"),
    ("<body><div><ul>" + "<li><a href=x>link</a></li>" * 9 + "</ul></div><div id=story><p>" + "Long sentence. " * 9 + "</p><p>More of it.</p></div></body>", "Long sentence. " * 8 + "Long sentence.\n\nMore of it."),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ("<p title='1 > 0' data-x=\"<b>\">in</p><p title=\"5\" tall\">a \"quote\" and it's more</p><script/>x='<p>no</p>'</script><p>end", "in\n\na \"quote\" and it's more\n\nend"),
    ("<P CLASS=Advert>x<p>y</P></p><p id='with-sidebar'>z&nbsp;&nbsp;&amp;lt;</p>", "y\n\nz &lt;"),
])
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("tag", ["article", "main"])
def test_main_text_keeps_linked_blocks_of_an_article(tag):
    parts = ["<h1><a href=x>Headline</a></h1>", "<p>" + "Long sentence here. " * 12 + "</p>", "<h2><a href=y>Second head</a></h2>", "<p><a href=z>A paragraph that is one link</a></p>"]
    parts += ["<p>" + "Another sentence. " * 12 + "</p>", "<ul><li><a href=1>First source</a><li><a href=2>Second source</a></ul>"]
    page = f"<body><ul><li><a href=n>Elsewhere</a></ul><{tag}>" + "".join(parts) + f"</{tag}></body>"
    assert main_text(page).split("\n\n") == [
        "Headline", ("Long sentence here. " * 12).strip(), "Second head", "A paragraph that is one link", ("Another sentence. " * 12).strip(), "First source", "Second source",
    ]


LONG = ("Long sentence here. " * 12).strip()


@pytest.mark.parametrize(("page", "text"), [
    ("<article><h2 id='share-of-revenue'>Shares</h2><section id='search-and-rescue'><h3 id=social-effects>Effects</h3><p>One.</p></section><div id='notice-period'>Two.</div></article>", "Shares\n\nEffects\n\nOne.\n\nTwo."),
    ("<article><h2 id=discussion>Discussion</h2><section id=related><p>Work.</p></section></article>", "Discussion\n\nWork."),
    ("<div><h2 id='social'>Social</h2><p title='the hidden cost'>" + LONG + "</p><p data-id='share' data-class='ad' title=\"aria-hidden='true'\">Kept.</p></div>", "Social\n\n" + LONG + "\n\nKept."),
    ("<article><p>Kept.</p><p hidden>a</p><p HIDDEN=''>b</p><p class=x aria-hidden='true'>c</p><div role=form>d</div></article>", "Kept."),
    ("<div id=cookie-banner>Cookies</div><div id=site-footer>Foot</div><div id=sidebar>Side</div><article><p>Kept.</p><div id=share>Share</div><section id=comments><p>Nice!</p></section><p class='share-buttons'>Tell</p></article>", "Kept."),
    ("<body><form id=aspnetForm action='x'><div id=content><h1>Head</h1><p>" + LONG + "</p><form role=search><p>Find</p></form></div></form></body>", "Head\n\n" + LONG),
    ("<form><nav>menu</nav><main><p>Short.</p></main></form><p>" + LONG + "</p>", "Short.\n\n" + LONG),
    ("<div><p>" + LONG + "</p><form><p>Mail us</p></form><p>End.</p></div>", LONG + "\n\nEnd."),
])
def test_main_text_hints(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("links", ["", "<div><ul>" + "<li><a href=q>Another story</a>" * 8 + "</ul></div>"])
def test_main_text_spread_over_containers(links):
    first, second = ([f"{name}{i} " + "x" * 196 for i in range(n)] for name, n in (("a", 5), ("b", 3)))
    parts = "".join("<div>" + "".join(f"<p>{p}</p>" for p in part) + "</div>" for part in (first, second))
    whole = ["Headline", "Before a link.", *first, *second, "Linked", "End."]
    inner = f"<div><h1>Headline</h1></div>Before <a href=x>a link</a>.{parts}<h2><a href=y>Linked</a></h2><div><p>End.</p></div>"
    for page in (f"<body>{links}<div id=content>{inner}</div>{links}</body>", f"<body><div>{links}<div>{inner}</div></div></body>", f"<body>{links}{inner}</body>"):
        assert main_text(page).split("\n\n") == whole


def test_main_text_of_deep_pages():
    assert main_text("<b id=x>" * 100_000 + "text" + "<form>" * 50_000 + "no") == "text"


# --- 3 ------------------------------------------------------------------------------------------


def test_url_rules_and_trees(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
    rows = [(1, "https://Www.Example.ORG/es/5?x=1"), (2, "http://a.org"), (3, "http://a.org/"), (4, "http://myexample.org/es/1"), (5, "http://x.example.org/en/12#f"), (6, None), (7, "example.org/es/"), (8, "http://b.com/de/9")]
    rows += [(100 + i, f"http://s{i}.example.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(200)]
    rows += [(1000 + i, f"http://s{i}.example.net/{'de' if i % 2 else 'fr'}/{i}") for i in range(50)]
    got = {r["page_id"]: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules, rounds=5).collect()}
    found = {i: (got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(1, 9)}
    assert found == {
        1: ("www.example.org", "/es/5", "example.org/es/"), 2: ("a.org", "", None), 3: ("a.org", "/", "org/"),
        4: ("myexample.org", "/es/1", "org/"), 5: ("x.example.org", "/en/12", "example.org/en/1"), 6: ("", "", None), 7: ("", "", None),
        8: ("b.com", "/de/9", "com/de/"),
    }
    assert [got[i]["verdict"] for i in (1, 3, 4, 5, 8)] == ["block", "allow", "allow", "block", "block"]
    assert all(r["verdict"] in ("allow", "block") and 0 <= r["score"] <= 1 for r in got.values())


def test_trees_learn_held_out_urls(spark):
    """Urls of one kind are long and full of digits; the trees, trained on one half by rules, tell the other half."""
    pick = random.Random(5)

    def url(bad: bool, site: str) -> str:
        tail = "".join(pick.choice("0123456789" if bad else "abcdefgh") for _ in range(30 if bad else 8))
        return f"http://{site}/{'q' if bad else 'p'}/{tail}" + ("?a=1&b=2&c=3" if bad else "")

    rows = [(i, url(i % 2 == 1, "known.example.com" if i < 300 else "new.example.com")) for i in range(500)]
    out = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), [("block", "known.example.com/q/"), ("allow", "known.example.com/p/")])
    held = [r for r in out.collect() if r["page_id"] >= 300]
    assert sum((r["verdict"] == "block") == (r["page_id"] % 2 == 1) for r in held) / len(held) > 0.95


def test_url_sample_is_bounded_and_keeps_both_kinds(spark):
    """One url is a third of the labelled rows, and one label in a thousand is rare; the result has both and their weights."""
    rows = [("http://x.com/fr/common", 0.0)] * 2000 + [(f"http://x.com/fr/{i * 7919}", 0.0) for i in range(4000)] + [(f"http://x.com/de/{i}", 1.0) for i in range(6)]
    urls = spark.createDataFrame(rows, "url string, label double")
    urls = urls.withColumns({name: F.abs(F.xxhash64("url", F.lit(i))) % 1000 / 1.0 for i, name in enumerate(url_filter.FEATURES)})
    for bound in (40, 400, 10_000):
        got = url_filter._sampled(urls, {0.0: 6000, 1.0: 6}, bound).collect()
        kinds = Counter(r["label"] for r in got)
        assert len(got) <= bound and kinds[1.0] == 6 and kinds[0.0] >= min(4001, 0.8 * (bound - 6))
        assert sum(r["weight"] for r in got if r["label"] == 0) == pytest.approx(6000)
        assert max(r["weight"] for r in got) == 2000


def test_few_distinct_and_rare_labelled_urls(spark):
    """Fewer distinct labelled urls than parts of the old sample; then a rare kind among many rows."""
    rules = [("block", "x.com/bad/"), ("allow", "x.com/good/")]
    few = [(i, f"http://x.com/{'bad' if i % 2 else 'good'}/") for i in range(500)] + [(500, "http://new.org/")]
    assert judge_urls(spark.createDataFrame(few, "page_id long, url string"), rules, sample_rows=5, rounds=2).count() == 501
    rare = [(i, f"http://x.com/good/{'abcdefgh'[i % 8]}{i}") for i in range(3000)] + [(3000 + i, f"http://x.com/bad/{'9' * 60}{i}") for i in range(3)]
    rare += [(4000, f"http://new.org/{'8' * 62}"), (4001, "http://new.org/good/a17")]
    got = {r["page_id"]: r["verdict"] for r in judge_urls(spark.createDataFrame(rare, "page_id long, url string"), rules, sample_rows=100, rounds=5).collect()}
    assert (got[4000], got[4001]) == ("block", "allow")


# --- 4 ------------------------------------------------------------------------------------------

SENTENCES = st.lists(st.sampled_from(["hello", "the", " ", "  ", "\n", "中文", "é", "▁", "ing", "unbelievable", "<s>", "123", "🙂", "x" * 30, " " * 20]), max_size=25).map("".join)


@pytest.fixture(scope="module", params=["bpe", "unigram"])
def model(request, tmp_path_factory):
    path = public_tokenizers.path("piece_bpe_32k.model")
    if request.param == "unigram":
        with open(path, "rb") as source:
            proto = model_files.ModelProto.FromString(source.read())
        proto.trainer_spec.model_type = 1
        for piece in proto.pieces:
            piece.score = max(piece.score, -40000.0)
        path = str(tmp_path_factory.mktemp("model") / "unigram.model")
        with open(path, "wb") as out:
            out.write(proto.SerializeToString())
    return pieces.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)


@settings(max_examples=200, deadline=None)
@given(SENTENCES)
def test_pieces_as_the_library(model, text):
    own, library = model
    ids = np.frombuffer(own.encode(text), np.int32).tolist()
    assert ids == library.encode(text)
    assert own.decode(ids) == library.decode(ids) == text.replace("▁", " ")


def test_pieces_of_real_texts(model, spark, data):
    own, library = model
    for row in spark.read.parquet(f"{data}/documents.parquet").select("text").limit(60).collect():
        assert np.frombuffer(own.encode(row["text"]), np.int32).tolist() == library.encode(row["text"])


# --- 5 ------------------------------------------------------------------------------------------


def repeated_words(given_texts: list[str | None], size: int) -> list[tuple[list[str], list[bool]]]:
    words = [WORD.findall(t or "") for t in given_texts]
    count = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((w, gone))
    return out


@pytest.mark.parametrize("hot", [0, 20_000])
@pytest.mark.parametrize(("seed", "size", "vocabulary"), [(1, 3, 6), (2, 5, 3), (3, 14, 2), (4, 35, 1), (5, 20, 400)])
def test_repeats(spark, monkeypatch, seed, size, vocabulary, hot):
    monkeypatch.setattr(substring_dedup, "PART_ROWS", hot)  # 0: all anchors are cut into windows
    given_texts = texts(seed, 40, vocabulary)
    base = " ".join(f"p{i}" for i in range(200))
    given_texts += [base, base + " tail", "head " + base[200:], base.replace("p50 ", "q "), "same " * 300, base]
    docs = spark.createDataFrame(list(enumerate(given_texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in remove_repeats(docs, size).collect()}
    cut = {r["doc_id"]: r["text"] for r in cut_repeats(docs, size).collect()}
    for i, (words, gone) in enumerate(repeated_words(given_texts, size)):
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        assert got[i]["n_words"] == len(words) and got[i]["n_removed"] == sum(gone)
        assert got[i]["kept_text"] == " ".join(kept)
        assert got[i]["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()
        assert WORD.findall(cut[i] or "") == kept
        if not any(gone):
            assert cut[i] == given_texts[i]


def test_repeats_longer_than_254_words(spark):
    base = [f"p{i}" for i in range(700)]
    given_texts = [" ".join(base), " ".join(["head", *base[100:420], "tail"]), " ".join(base[300:590]), " ".join(["x", *base[380:690]])]
    docs = spark.createDataFrame(list(enumerate(given_texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in remove_repeats(docs, 300).collect()}
    for i, (words, gone) in enumerate(repeated_words(given_texts, 300)):
        assert got[i]["kept_text"] == " ".join(w for w, g in zip(words, gone, strict=True) if not g)
    assert [got[i]["n_removed"] for i in range(4)] == [590, 320, 0, 310]


def test_matches_longer_than_254_words_are_not_cut():
    """The first match of 400 words cannot be extended by the word before it; the one of 300 words can."""
    body, before = np.arange(2, 402), [1]
    sequences = [np.r_[before, body], body, np.r_[before, body[:300]]]
    flat, of = np.concatenate(sequences).astype(np.int64), np.r_[0, np.cumsum([len(s) for s in sequences])].astype(np.int64)
    assert FMIndex(flat, of).matching_statistics(flat, of)[:2].tolist() == [301, 400]


# --- 6 ------------------------------------------------------------------------------------------


def near_texts(seed: int) -> list[str | None]:
    pick = random.Random(seed)
    out: list[str | None] = [None, "", "a b", "A b", "a b c"]
    for group in range(12):
        base = [f"g{group}x{i}" for i in range(pick.randrange(5, 90))]
        for _ in range(pick.randrange(1, 14)):
            copy = list(base)
            for _ in range(pick.randrange(0, 4)):
                copy[pick.randrange(len(copy))] = f"e{pick.randrange(10**6)}"
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates(spark, tmp_path, seed):
    given_texts = near_texts(seed)
    sets = []
    for text in given_texts:
        words = WORD.findall((text or "").lower())
        sets.append({tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else ({tuple(words)} if words else set()))
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    docs = spark.createDataFrame(list(enumerate(given_texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in near_duplicates(docs, f"file://{tmp_path}/w", size=4).collect()}
    assert {i: got[i]["n_shingles"] for i in got} == {i: len(s) for i, s in enumerate(sets)}
    assert {i: got[i]["component_id"] for i in got} == {i: find(i) for i in range(len(sets))}


def test_blocks_find_all_links(spark, tmp_path, monkeypatch):
    """Groups larger than a block are compared block by block with the same result."""
    from wirelake.llm import near_duplicates as module

    given_texts = near_texts(9)
    docs = spark.createDataFrame(list(enumerate(given_texts)), "doc_id long, text string")
    whole = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, f"file://{tmp_path}/a", size=4).collect()}
    monkeypatch.setattr(module, "BLOCK_ROWS", 3)
    parts = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, f"file://{tmp_path}/b", size=4).collect()}
    assert whole == parts


def test_index_finds_all_signatures_below_the_distance():
    """Pigeonhole: fewer than 2 * CHUNKS differing parts leave an entry in common."""
    pick = np.random.default_rng(3)
    for _ in range(300):
        a = pick.integers(0, 1 << 16, size=PARTS, dtype=np.uint16)
        b = a.copy()
        b[pick.choice(PARTS, size=2 * CHUNKS - 1, replace=False)] ^= 1
        left, right = index_entries(np.stack([a, b]))
        assert set(left.tolist()) & set(right.tolist())


def test_signature_distance_follows_similarity():
    common = [f"c{i}" for i in range(900)]
    data = (" ".join(common + ["x"] * 1 + [f"a{i}" for i in range(100)]), " ".join(common + ["x"] * 1 + [f"b{i}" for i in range(100)]))
    for _, _, buffer, offsets in text_slices(pa.array(data)):
        hashes, of = shingle_sets(buffer, offsets, 4)
    signature = signatures(hashes, of)
    assert 2 <= (signature[0] != signature[1]).sum() <= 22  # similarity 0.81


@pytest.mark.parametrize("links", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9)], [(i, i + 1) for i in range(60)]])
def test_components(spark, tmp_path, links):
    root = {n: n for link in links for n in link if link[0] != link[1]}
    for _ in range(len(root)):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(links, "a long, b long"), f"file://{tmp_path}/w").collect()
    assert {r["node"]: r["root"] for r in got} == root and len(got) == len(root)


# --- 7 ------------------------------------------------------------------------------------------


def test_token_counts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    given_texts = [*texts(4, 20), "a<|endoftext|>b <|endoftext|>", "it's 12 ３ ² Ⅷ don't\r\n\t x", "中文 naïve — 🙂🙂", "  lead", "x" * 5000]
    docs = spark.createDataFrame(list(enumerate(given_texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in count_tokens(docs, path, limit=100).collect()}
    for i, text in enumerate(given_texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((text or "").encode()), n, n > 100)


# --- 8 ------------------------------------------------------------------------------------------


def test_contamination(spark, tmp_path):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    pick = random.Random(6)
    items = [(i, " ".join(f"t{pick.randrange(30)}" for _ in range(pick.randrange(2, 30)))) for i in range(25)] + [(3, "Same, Item!"), (90, "É é, ABC")]
    given_texts = texts(7, 30) + ["same item", "é É abc", "É É aBc", "É é abc É é ABC"]
    for _ in range(40):
        words = items[pick.randrange(25)][1].split()
        at = pick.randrange(len(words))
        given_texts.append(" ".join([f"t{pick.randrange(30)}" for _ in range(8)]) + " - " + ", ".join(words[at:]).upper())

    def lower(text: str) -> list[str]:
        return word.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))

    windows = defaultdict(set)
    for item, text in items:
        words = lower(text)
        for i in range(max(len(words) - 4, 1)):
            windows[tuple(words[i : i + 5])].add(str(item))
    got = {r["doc_id"]: r for r in judge_contamination(
        spark.createDataFrame(list(enumerate(given_texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), f"file://{tmp_path}/w", size=5).collect()}
    for i, text in enumerate(given_texts):
        words, hit, which = lower(text), set(), set()
        for window, names in windows.items():
            for at in range(len(words) - len(window) + 1):
                if tuple(words[at : at + len(window)]) == window:
                    hit |= set(range(at, at + len(window)))
                    which |= names
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (len(words), len(hit), sorted(which)), text
        assert got[i]["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(words))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "rare b c"), (2, "c x b rare"), (3, "rare " + "x " * 9 + "b c"), (4, "b c")], "doc_id long, text string")
    tests = phrases(spark.createDataFrame([(1, "b c rare")], "item_id long, text string"), 13)
    counts = term_counts(docs, spark.createDataFrame([("b",), ("c",), ("rare",)], "term string"))
    chosen = rarest_terms(tests, counts)
    assert chosen.first()["term"] == "rare"
    found = proximity_matches(build_postings(docs, chosen.select("term"), 4), by_term(chosen))
    keys = docs.select("doc_id", row_key(docs).alias("key"))
    assert sorted(r["doc_id"] for r in found.join(keys, "key").collect()) == [1, 2]


def test_contamination_with_proximity(spark, tmp_path):
    rows = [(1, "x rare b c x"), (2, "c x b rare"), (3, "rare " + "x " * 9 + "b c"), (4, "b c rare - c b rare"), (5, None), (6, "b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame([(1, "rare b c"), (2, "c b rare")], "item_id long, text string")
    got = {r["doc_id"]: r for r in judge_contamination(docs, tests, f"file://{tmp_path}/w", size=5).collect()}
    assert {i: (r["n_hit"], r["items"]) for i, r in got.items()} == {1: (3, ["1"]), 2: (0, []), 3: (0, []), 4: (3, ["2"]), 5: (0, []), 6: (0, [])}
    assert {i: (r["n_near"], r["near_items"]) for i, r in got.items()} == {1: (1, ["1", "2"]), 2: (1, ["1", "2"]), 3: (0, []), 4: (2, ["1", "2"]), 5: (0, []), 6: (0, [])}
    assert not got[2]["contaminated"] and got[1]["contaminated"]


# --- 10 -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark, data):
    table = spark.read.parquet(f"{data}/pages.parquet")
    copies = table.where("page_id < 20").selectExpr("page_id + 100000 AS page_id", "url", "html")
    return table.union(copies).union(spark.createDataFrame([(900001, None, None), (900002, "a\r\nb", "")], "page_id long, url string, html string"))


@pytest.mark.parametrize("split", [50, 1000, 8 << 20])
def test_archives(spark, pages, tmp_path, split):
    archives = write_archives(pages.repartition(3), f"file://{tmp_path}/w")
    got = {r["page_id"]: r for r in read_archives(spark, archives, split_bytes=split, payloads=True).collect()}
    rows = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    assert len(got) == len(rows)
    largest = {}
    for page, payload in rows.items():
        largest[payload] = max(largest.get(payload, -1), page)
    for page, payload in rows.items():
        first = largest[payload]
        r = got[page]
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r["payload_bytes"] == len(payload)
        assert (r["record_type"], r["refers_to"]) == (("response", None) if page == first else ("revisit", first))
        assert r["payload"] == (payload if page == first else None)


def test_archives_are_gzip_members(spark, pages, tmp_path):
    archives = write_archives(pages.repartition(2), f"file://{tmp_path}/w").collect()
    for row in archives:
        with gzip.open(row["path"].removeprefix("file://")) as whole:
            assert whole.read().count(b"WARC/1.1\r\n") >= row["records"]


def test_small_payloads_are_stored(spark, pages, tmp_path):
    got = read_archives(spark, write_archives(pages, f"file://{tmp_path}/w", least_bytes=1 << 30)).collect()
    assert {r["record_type"] for r in got} == {"response"}


def test_false_magic_and_damage(tmp_path):
    member = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n")
    path = tmp_path / "x.warc.gz"
    noise = b"\x1f\x8b\x08 no member \x1f\x8b\x08" + gzip.compress(b"no header")
    path.write_bytes(noise + member + member)
    assert [at for at, _ in members(f"file://{path}", 0, 10**6)] == [len(noise), len(noise) + len(member)]
    assert [at for at, _ in members(f"file://{path}", len(noise) + 1, len(noise) + len(member))] == []
    assert [at for at, _ in members(f"file://{path}", len(noise) + 1, len(noise) + len(member) + 1)] == [len(noise) + len(member)]
    path.write_bytes(member + member[:-9])
    with pytest.raises(ValueError, match="no end"):
        list(members(f"file://{path}", 0, 10**6))
