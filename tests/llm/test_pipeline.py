"""The whole chain of corpus_pipeline on planted documents, against a plain version of its five stages."""

from __future__ import annotations

import random
import re
from collections import Counter

import public_tokenizers
from sentencepiece import SentencePieceProcessor

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def planted(seed: int = 3):
    """Documents (id, text) and benchmark items: clean ones, copies, near copies, shared passages, repetition, junk, leaked items."""
    pick = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "ptkmn" for b in "aeiou" for c in ("l", "r", "st", "nd", "x")]

    def prose(n):
        return [pick.choice(vocabulary) + pick.choice(["", "", "s", "ed", ","]) for _ in range(n)]

    items = [" ".join(prose(pick.randrange(5, 40))) for _ in range(12)]
    passage = prose(60)
    texts = [prose(pick.randrange(60, 160)) for _ in range(60)]
    texts += [list(pick.choice(texts[:60])) for _ in range(20)]
    for _ in range(40):
        near = list(pick.choice(texts[:60]))
        for _ in range(pick.choice([1, 2, 4, 12])):
            near[pick.randrange(len(near))] = pick.choice(vocabulary)
        texts.append(near)
    for _ in range(15):
        host = prose(90)
        at = pick.randrange(90)
        texts.append(host[:at] + passage[: pick.choice([20, 34, 36, 60])] + host[at:])
    texts += [prose(8) * pick.randrange(8, 20) for _ in range(8)] + [prose(120) * 2 for _ in range(4)] + [prose(pick.randrange(0, 50)) for _ in range(10)]
    for n in (60, 90, 200, 400):
        for _ in range(6):
            host, item = prose(n), items[pick.randrange(12)].split()
            texts.append(host[: n // 2] + item + host[n // 2 :])
    rows = [(i, "".join(w + pick.choice([" ", " ", " ", "\n", "  "]) for w in words).rstrip()) for i, words in enumerate(texts)]
    pick.shuffle(rows)
    return [*rows, (900, None), (901, "")], [*enumerate(items), (50, None), (51, "")]


def repeated(words, size):
    """Words in windows of this size that the text has twice or more."""
    windows = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return {i + k for i in range(len(words) - size + 1) if windows[tuple(words[i : i + size])] > 1 for k in range(size)}


def is_good(text):
    words = WORD.findall(text or "")
    n = len(words)
    return n >= 50 and 100 * len(repeated(words, 3)) <= 50 * n and 100 * len(repeated(words, 8)) <= 45 * n and not repeated(words, 101)


def one_of_each(rows):
    sets = {}
    for i, text in rows:
        words = WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(i, text) for i, text in rows if find(i) == i]


def without_passages(rows, size=35):
    windows = Counter(tuple(w[k : k + size]) for _, t in rows for w in [WORD.findall(t)] for k in range(len(w) - size + 1))
    out = []
    for i, text in rows:
        words = [m.group() for m in WORD.finditer(text)]
        gone = {k + d for k in range(len(words) - size + 1) if windows[tuple(words[k : k + size])] > 1 for d in range(size)}
        spots = list(WORD.finditer(text))
        ends = [m.start() for m in spots[1:]] + [len(text)]  # a word goes with the white space after it
        head = text[: spots[0].start()] if spots else text
        out.append((i, head + "".join(text[m.start() : e] for k, (m, e) in enumerate(zip(spots, ends, strict=True)) if k not in gone)))
    return out


def uncontaminated(rows, items, size=13):
    def terms(text):
        return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))

    phrases = {tuple(w[k : k + size]) for _, t in items for w in [terms(t)] if w for k in range(max(len(w) - size, 0) + 1)}
    out = []
    for i, text in rows:
        words = terms(text)
        hit = {k + d for n in {len(p) for p in phrases} for k in range(len(words) - n + 1) if tuple(words[k : k + n]) in phrases for d in range(n)}
        if not hit or 20 * len(hit) < len(words):
            out.append((i, text))
    return out


def test_pipeline_against_a_plain_version(spark, tmp_path):
    docs, items = planted()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    good = [(i, t) for i, t in docs if is_good(t)]
    left = one_of_each(good)
    cut = without_passages(left)
    wanted = dict(uncontaminated(cut, items))
    # every stage has something to do, and something to leave alone
    assert len(docs) > len(good) > len(left) > len(wanted) > 60 and sum(a != b for a, b in zip(left, cut, strict=True)) > 5
    assert {i: r.text for i, r in got.items()} == wanted
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {i: list(r.token_ids) for i, r in got.items()} == {i: library.encode(t) for i, t in wanted.items()}
    assert all(r.n_tokens == len(r.token_ids) for r in got.values())
