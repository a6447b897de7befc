"""Keywords, summaries and sentiment of texts.

`id_col` is unique and not null. Keywords and summaries move each text once, by its id; counting, ranking and scoring then
take some texts at a time, in Arrow batches, so a task's memory does not hold the words of its whole partition. (Counting
the sorted words of a row with Spark's functions of list items took four times as long, because Spark interprets them.)
Sentiment moves only one partial sum per text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.functions.words import cased_words, sentences, words
from wirelake.operators.filters import may_be_among
from wirelake.session import scratch_path, shuffles_removed

# Published method (rule-based social-media sentiment, 2014): weight of a negated word, and the constant that
# maps a sum of word values into [-1, 1].
NEGATED = -0.74
SPREAD = 15.0
# Fixed value: scores beyond this on either side are positive or negative.
THRESHOLD = 0.1
SLICE = 4_000_000  # characters of the texts that are counted together
NEGATORS = ["not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "cannot", "without"]


# Fixed values of the same method: what a degree adverb adds, and how much of it is left one and two words further off.
BOOST = 0.293
DECAY = (1.0, 0.95, 0.9)
STRONGER = [
    "absolutely", "amazingly", "completely", "considerably", "decidedly", "deeply", "enormously", "entirely", "especially", "exceptionally",
    "extremely", "fully", "greatly", "highly", "hugely", "incredibly", "intensely", "major", "majorly", "more", "most", "particularly",
    "purely", "quite", "really", "remarkably", "so", "substantially", "thoroughly", "totally", "tremendously", "unusually", "utterly", "very",
]
WEAKER = ["almost", "barely", "hardly", "kind", "less", "little", "marginally", "occasionally", "partly", "scarcely", "slightly", "somewhat", "sort"]


@dataclass(frozen=True)
class Rules:
    """The rule table of `sentiment_by_rules`. Words are in lower case."""

    boosters: dict[str, float] = field(default_factory=lambda: {**dict.fromkeys(STRONGER, BOOST), **dict.fromkeys(WEAKER, -BOOST)})
    decay: tuple[float, ...] = DECAY
    negators: tuple[str, ...] = tuple(NEGATORS)
    contrast: str = "but"
    before_contrast: float = 0.5
    after_contrast: float = 1.5
    capitals: float = 0.733
    exclamation: float = 0.292
    most_exclamations: int = 4
    question: float = 0.18
    many_questions: float = 0.96


RULES = Rules()


def _by_text(placed: DataFrame, id_col: str, text_col: str, listed: Column, work: Callable, out: str) -> DataFrame:
    """Applies `work` inside the tasks to Arrow batches of whole ids.

    Rows, partitioned by id, are sorted by it, so that a task holds the batch at hand and not the words of other texts. `work`
    takes the ids, `listed`, which is made after the sort, and the number of each row's id within the batch. It is pickled
    by value and so must not call functions of this package, which an executor may not have.
    """
    made = placed.sortWithinPartitions(id_col).select(id_col, F.coalesce(F.length(text_col), F.lit(0)).alias("_size"), listed.alias("_listed"))
    at_once = SLICE

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches that end where an id ends."""
        held: list[pa.RecordBatch] = []  # of one id, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            begun = len(ids) - 1
            if held and ids[0].as_py() == ids[begun].as_py() == held[0].column(0)[0].as_py():
                held.append(batch)
                continue
            codes = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()
            begun = int(np.flatnonzero(codes != codes[-1])[-1]) + 1 if (codes != codes[-1]).any() else 0
            done = [*held, batch.slice(0, begun)]
            held = [batch.slice(begun)]
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches):
            if not batch.num_rows:
                continue
            codes = pc.dictionary_encode(batch.column(0), null_encoding="encode").indices.to_numpy()
            first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            filled = np.cumsum(batch.column(1).to_numpy(zero_copy_only=False), dtype=np.int64)[first] // at_once
            cuts = [*first[np.flatnonzero(np.r_[True, filled[1:] != filled[:-1]])], batch.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(start, end - start)
                mine = codes[start:end]
                number = np.cumsum(np.r_[False, mine[1:] != mine[:-1]])
                yield work(part.column(0), part.column(2), number)

    kind = placed.schema[id_col].dataType.simpleString()
    return made.mapInArrow(run, f"`{id_col}` {kind}, {out}")


def keywords(docs: DataFrame, id_col: str, text_col: str, k: int = 10, min_length: int = 1, stopwords: list[str] | None = None) -> DataFrame:
    """The k most frequent words of each text, joined by ", "; equal counts in alphabetical order."""
    ignored = [w for w in stopwords or [] if w is not None]

    def count(ids: pa.Array, lists: pa.Array, text: np.ndarray) -> pa.RecordBatch:
        of = np.repeat(text, pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        coded = lists.flatten().dictionary_encode()
        known, code = coded.dictionary, coded.indices.to_numpy()
        wanted = pc.and_(pc.greater_equal(pc.utf8_length(known), min_length), pc.invert(pc.is_in(known, value_set=pa.array(ignored, known.type))))
        order = pc.sort_indices(known).to_numpy()  # by bytes, as Spark sorts
        rank = np.empty(len(known), np.int64)
        rank[order] = np.arange(len(known))
        stays = wanted.to_numpy(zero_copy_only=False)[code]
        pairs, n = np.unique(of[stays] * max(len(known), 1) + rank[code[stays]], return_counts=True)
        owner, word = np.divmod(pairs, max(len(known), 1))
        best = np.lexsort((word, -n, owner))
        owner, word = owner[best], word[best]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
        owner, word = owner[place < k], word[place < k]
        texts, sizes = np.unique(owner, return_counts=True)
        joined = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), known.take(pa.array(order[word])))
        row = np.searchsorted(text, texts)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pc.binary_join(joined, ", ")], [id_col, "keywords"])

    placed = docs.select(id_col, text_col).repartition(id_col)
    return _by_text(placed, id_col, text_col, words(F.col(text_col)), count, "keywords string")


def summaries(docs: DataFrame, id_col: str, text_col: str, k: int = 3, min_length: int = 1) -> DataFrame:
    """The k sentences with the highest mean word frequency, in text order; an earlier sentence wins a tie."""

    def mean_frequency(text: np.ndarray, sentence: np.ndarray, word: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        of, n = np.unique(text * number + word, return_inverse=True, return_counts=True)[1:]
        size = np.bincount(sentence)
        return np.bincount(sentence, n[of]) / np.maximum(size, 1), size

    return _best_sentences(docs, id_col, text_col, k, min_length, mean_frequency)


def central_summaries(docs: DataFrame, id_col: str, text_col: str, k: int = 3, min_length: int = 1) -> DataFrame:
    """The k most central sentences of each text, in text order; an earlier sentence wins a tie.

    Sentences are the nodes of a graph, and two of them are linked by the distinct words that they share. A sentence's
    centrality is the sum of its links' weights over the root of its number of distinct words: neither a sentence of one
    frequent word nor a mere long one comes first. The sum of a sentence's links is the sum over its words of the number of
    other sentences with the word, so the links themselves are never listed, and the work grows with the words of a text.
    """

    def centrality(text: np.ndarray, sentence: np.ndarray, word: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        one = np.unique(sentence * number + word, return_index=True)[1]
        text, sentence, word = text[one], sentence[one], word[one]
        of, n = np.unique(text * number + word, return_inverse=True, return_counts=True)[1:]
        size = np.bincount(sentence)
        return np.bincount(sentence, n[of] - 1) / np.sqrt(np.maximum(size, 1)), size

    return _best_sentences(docs, id_col, text_col, k, min_length, centrality)


def _best_sentences(docs: DataFrame, id_col: str, text_col: str, k: int, min_length: int, score: Callable) -> DataFrame:
    """The k sentences of each text with the highest `score`, joined in text order; an earlier sentence wins a tie.

    `score` takes the text, the sentence and the code of each word, and the number of codes; it returns the score and the
    words of each sentence. Rows of one id count as one text, whose n-th sentence has the words of all its n-th sentences.
    """

    def choose(ids: pa.Array, lists: pa.Array, text: np.ndarray) -> pa.RecordBatch:
        listed = lists.flatten()  # the words of each sentence
        length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(length)), length)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        most = int(length.max(initial=0)) + 1
        node, which = np.unique(text[row] * most + pos, return_inverse=True)
        coded = listed.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        long = pc.greater_equal(pc.utf8_length(coded.dictionary), min_length).to_numpy(zero_copy_only=False)[code]
        of = np.repeat(which, pc.list_value_length(listed).to_numpy(zero_copy_only=False))[long]
        owner, place = np.divmod(node, most)
        points, size = score(owner[of], of, code[long], max(len(coded.dictionary), 1))
        rated = np.flatnonzero(size)
        best = rated[np.lexsort((place[rated], -points[rated], owner[rated]))]
        chosen = np.sort(best[np.arange(len(best)) - np.searchsorted(owner[best], owner[best]) < k])
        texts, sizes = np.unique(owner[chosen], return_counts=True)
        places = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(place[chosen], pa.int32()))
        return pa.RecordBatch.from_arrays([ids.take(pa.array(np.searchsorted(text, texts))), places], [id_col, "_chosen"])

    # The join below would infer this filter for one side only, and the exchange could not be shared.
    placed = docs.select(id_col, text_col).where(F.col(id_col).isNotNull()).repartition(id_col)
    chosen = _by_text(placed, id_col, text_col, F.transform(sentences(F.col(text_col)), words), choose, "_chosen array<int>")
    # One side reads the texts from the exchange of the other; only places are moved for the join.
    full = placed.join(chosen, id_col, "left").withColumn("_sentences", sentences(F.col(text_col)))
    text = F.array_join(F.transform("_chosen", lambda p: F.get("_sentences", p)), " ")
    return full.select(id_col, F.coalesce(text, F.lit("")).alias("summary"))


def sentiment(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, negators: list[str] | None = None) -> DataFrame:
    """`score` in [-1, 1] and `sentiment` of each text from the word values of `lexicon (word, val)`.

    A value is weighed by -0.74 if a negator is among the three words before it. A missing or empty text, and
    one without a known word, is neutral. The lexicon is joined without a hint: Spark broadcasts it where its
    measured size allows and shuffles by word otherwise.
    """
    negators = NEGATORS if negators is None else negators
    listed = docs.select(id_col, words(F.col(text_col)).alias("word"))
    # The word list next to itself, moved by one, two and three places: each word with the three before it.
    # The padded rows past the end have no word.
    nulls = [F.array_repeat(F.lit(None).cast("string"), n) for n in (1, 2, 3)]
    moved = listed.select(id_col, "word", *[F.concat(pad, F.col("word")).alias(f"p{n}") for n, pad in enumerate(nulls, 1)])
    tokens = moved.select(id_col, F.inline_outer(F.arrays_zip("word", "p1", "p2", "p3")))
    known = tokens.join(lexicon.select("word", "val"), "word", "left")
    negated = reduce(or_, [F.coalesce(F.col(p).isin(negators), F.lit(False)) for p in ("p1", "p2", "p3")])
    value = F.when(F.col("val").isNotNull(), F.when(negated, F.col("val") * NEGATED).otherwise(F.col("val")))
    sums = known.groupBy(id_col).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("_sum"))
    score = F.col("_sum") / F.sqrt(F.col("_sum") * F.col("_sum") + SPREAD)
    return sums.select(id_col, F.round(score, 6).alias("score")).withColumn("sentiment", sentiment_label(F.col("score")))


def sentiment_by_rules(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, rules: Rules = RULES) -> DataFrame:
    """`score` and `sentiment` as by `sentiment`, with the modifiers of a rule table.

    A word's value grows if the word stands in capitals in a text that is not all capitals. A booster among the words before
    it moves the value away from zero or, with a negative weight, towards it; the further off, the less. A negator among them
    turns it round, once. Values before the first contrast word count less, those after it more. Exclamation marks, up to a
    number, and repeated question marks strengthen the sum of the text. Each word carries the words before it along, so
    with a lexicon that Spark broadcasts, nothing but one partial sum per text is shuffled. A lexicon of which Spark can't say
    so is stored first, which tells its size; if that is too large, the words that pass a Bloom filter of the lexicon are
    shuffled, with their weights only. A missing or empty text, and one without a known word, is neutral.
    """
    lexicon = lexicon.select("word", "val")
    if not _small(lexicon):
        lexicon = _written(lexicon)
    reach = len(rules.decay)
    text = F.col(text_col)
    lists = docs.select(
        id_col, cased_words(text).alias("word"),
        (F.least(_number_of(text, "!"), F.lit(rules.most_exclamations)) * rules.exclamation + F.when(_number_of(text, "?") > 3, rules.many_questions)
            .when(_number_of(text, "?") > 1, _number_of(text, "?") * rules.question).otherwise(0.0)).alias("_marks"),
    )
    lists = lists.select(
        "*", F.array_position(F.transform("word", F.lower), rules.contrast).alias("_turn"),
        (F.exists("word", _in_capitals) & F.exists("word", lambda w: ~_in_capitals(w))).alias("_mixed"),
        *[F.concat(F.array_repeat(F.lit(None).cast("string"), n), F.col("word")).alias(f"p{n}") for n in range(1, reach + 1)],
    )
    names = [f"p{n}" for n in range(1, reach + 1)]
    # The padded rows past the end have no word.
    tokens = lists.select(id_col, "_marks", "_turn", "_mixed", F.posexplode_outer(F.arrays_zip("word", *names)).alias("_place", "_token"))
    tokens = tokens.select(
        id_col, "_marks", "_turn", "_mixed", (F.col("_place") + 1).alias("_place"), F.col("_token.word").alias("_cased"),
        F.lower("_token.word").alias("word"), *[F.lower(f"_token.{p}").alias(p) for p in names])

    table = F.map_from_arrays(F.array(*[F.lit(w) for w in rules.boosters]), F.array(*[F.lit(float(x)) for x in rules.boosters.values()]))
    boosts = [F.coalesce(F.try_element_at(table, F.col(p)), F.lit(0.0)) * weight for p, weight in zip(names, rules.decay, strict=True)]
    negated = reduce(or_, [F.coalesce(F.col(p).isin(*rules.negators), F.lit(False)) for p in names])
    side = F.when((F.col("_turn") == 0) | (F.col("_place") == F.col("_turn")), 1.0).when(
        F.col("_place") < F.col("_turn"), rules.before_contrast).otherwise(rules.after_contrast)
    weights = [
        F.when(F.col("_mixed") & _in_capitals(F.col("_cased")), rules.capitals).otherwise(0.0).alias("_loud"), reduce(add, boosts).alias("_boost"),
        F.when(negated, NEGATED).otherwise(1.0).alias("_turned"), side.alias("_side")]
    if _small(lexicon):
        known = tokens.join(lexicon, "word", "left").select(id_col, "_marks", "val", *weights)
    else:
        near = tokens.where(may_be_among("word", lexicon, "word", lexicon.count())).select(id_col, "_marks", "word", *weights)
        found = near.join(lexicon, "word").select(id_col, "_marks", "val", "_loud", "_boost", "_turned", "_side")
        none = [F.lit(None).cast("double").alias(c) for c in ("val", "_loud", "_boost", "_turned", "_side")]
        known = found.union(lists.select(id_col, "_marks", *none))  # each text, if it has a known word or not
    strong = F.col("val") + F.when(F.col("_loud") != 0, F.signum("val") * F.col("_loud")).otherwise(0.0)
    moved = (strong + F.signum(strong) * F.col("_boost")) * F.col("_turned")
    sums = known.groupBy(id_col, "_marks").agg(F.coalesce(F.sum(F.when(F.col("val").isNotNull(), moved * F.col("_side"))), F.lit(0.0)).alias("_sum"))
    total = F.col("_sum") + F.signum("_sum") * F.coalesce("_marks", F.lit(0.0))
    scored = sums.select(id_col, F.round(total / F.sqrt(total * total + SPREAD), 6).alias("score"))
    return scored.withColumn("sentiment", sentiment_label(F.col("score")))


def _small(df: DataFrame) -> bool:
    """Whether Spark broadcasts these rows, by their size as far as it knows that before they are made."""
    bound = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= bound


def _written(df: DataFrame) -> DataFrame:
    """The same rows, stored in the shared scratch folder, so that they are made once and Spark knows their size."""
    path = scratch_path(df.sparkSession, "lexicon")
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_capitals(word: Column) -> Column:
    return F.rlike(word, F.lit(r"^\p{Lu}{2,}$"))


def _number_of(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def sentiment_label(score: Column) -> Column:
    return F.when(score > THRESHOLD, "positive").when(score < -THRESHOLD, "negative").otherwise("neutral")
