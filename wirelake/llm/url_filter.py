"""URL filter: path rules first, then gradient-boosted trees on lexical features, all as DataFrame functions.

The rules label the urls that they fit; the trees learn from those and judge the rest. Labelled rows are counted by their
features, and the counts are weights. Above ``sample_rows`` distinct ones, each kind has a bound of its own: rows that are a
large part of their kind stay, the others are drawn by a hash, and stand for all of their kind.
Suffix statistics (how common the last one and two host labels are, and the smoothed share of blocked urls among the
labelled ones, without the fold of the row's own url where it is labelled) are counted over all rows.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule, and goes to the trees like
any other; of rules of equal length that fit, block wins; repeated rows get equal verdicts; with labelled urls of one kind
only, or of neither, there is nothing to learn and the rest gets that kind, or allow. Columns beyond page_id and url are
not looked at, whatever their names; urls of any length are judged whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._/?&=%#:~+"
SAMPLE_ROWS = 20_000
FOLDS = 4  # parts of the labelled urls whose shares leave out their own part
SAMPLE_PARTS = 8  # partitions of the sample, which is bounded
FEATURES = [
    "length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "entropy", "parameters", "query_length",
    "hyphens", "escapes", "suffix_rows", "domain_rows", "suffix_blocked", "domain_blocked",
]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for a null url or one without ``://``."""
    def part(group: int) -> Column:
        return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))

    return lower_ascii(part(1)), part(2)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (length, block, rule); null if none does."""
    fits = [F.lit(None).cast("struct<length:int,block:boolean,rule:string>")]
    for verdict, rule in rules:
        site, slash, start = rule.partition("/")
        fit = ((host == site) | host.endswith("." + site)) & path.startswith(slash + start)
        found = F.struct(F.lit(len(rule)).alias("length"), F.lit(verdict == "block").alias("block"), F.lit(rule).alias("rule"))
        fits.append(F.when(fit, found))
    return F.array_max(F.array(*fits))


def _entropy(text: Column) -> Column:
    """Bits per character; characters outside the alphabet count as one kind."""
    size = F.length(text)
    known = F.transform(F.split(F.lit(ALPHABET), ""), lambda c: size - F.length(F.replace(text, c, F.lit(""))))
    rest = size - F.aggregate(known, F.lit(0), lambda a, n: a + n)
    return F.aggregate(
        F.concat(known, F.array(rest)), F.lit(0.0),
        lambda a, n: a - F.when(n > 0, n / size * F.log2(n / size)).otherwise(0.0),
    )


def _lexical(urls: DataFrame) -> DataFrame:
    """Features that follow from the url alone, and the host's last one and two labels."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)

    def count(text: Column, characters: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, characters, ""))

    return urls.withColumns({
        "length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "host_depth": count(host, r"\."), "path_depth": count(path, "/"),
        "digit_ratio": count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
        "entropy": _entropy(F.lower(url)),
        "parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1), "query_length": F.length(query),
        "hyphens": count(host, "-"), "escapes": count(url, "%"),
        "suffix": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2),
    })


def _with_statistics(urls: DataFrame, kind: str) -> DataFrame:
    """Rows of the same last labels, and the blocked share of the labelled ones (drawn to a half by one row of each kind).

    A labelled row gets the share of the folds that its url is not in, or the trees would read the label from the share."""
    label, fold = F.col("label"), F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")
    by_fold = [F.when(fold == i, label) for i in range(FOLDS)]
    counted = urls.groupBy(kind).agg(
        F.log1p(F.count("*")).alias(f"{kind}_rows"),
        F.array(*[F.coalesce(F.sum(own), F.lit(0.0)) for own in by_fold]).alias("blocked"), F.array(*[F.count(own) for own in by_fold]).alias("labelled"),
    )

    def known(counts: str) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda a, n: a + n)
        return total - F.when(label.isNull(), 0).otherwise(F.get(counts, fold))

    return urls.join(counted, kind).withColumn(f"{kind}_blocked", (known("blocked") + 1) / (known("labelled") + 2)).drop("blocked", "labelled")


def _sampled(labelled: DataFrame, known: dict[float, int], sample_rows: int) -> DataFrame:
    """label, features and weight: at most ``sample_rows`` distinct rows, some of each kind, whose weights sum up to all rows of it.

    known: rows by label, both of them."""
    half = sample_rows // 2
    large = F.create_map(*[F.lit(v) for label, n in known.items() for v in (label, 2 * n / max(half, 1))])
    rows = labelled.groupBy("label", *FEATURES).agg(F.count("*").alias("n"))
    # large: at most half of a bound. draw: 64 steps for each doubling, so any number of rows is met to about a hundredth
    rows = rows.withColumn("large", F.col("n") >= large[F.col("label")])
    rows = rows.withColumn("draw", F.floor(64 * F.log2(F.shiftrightunsigned(F.xxhash64(*FEATURES), 11) + 1)))
    steps: dict[float, list] = defaultdict(list)
    for row in rows.groupBy("label", "large", "draw").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect():
        steps[row["label"]].append((not row["large"], row["draw"], row["rows"], row["n"]))
    sizes = {label: sum(step[2] for step in found) for label, found in steps.items()}
    chosen, scale = F.col("large"), F.lit(1.0)
    for label, found in steps.items():
        room = max(half, sample_rows - (sum(sizes.values()) - sizes[label]))
        last, drawn = -1, 0
        for small, draw, size, n in sorted(found):
            if size > room:
                break
            room -= size
            if small:
                last, drawn = draw, drawn + n
        light = sum(n for small, _, _, n in found if small)
        chosen |= (F.col("label") == label) & (F.col("draw") <= last)
        scale = F.when((F.col("label") == label) & ~F.col("large"), F.lit(light / max(drawn, 1))).otherwise(scale)
    return rows.where(chosen).select("label", *FEATURES, (F.col("n") * scale).alias("weight")).repartition(SAMPLE_PARTS)


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], sample_rows: int = SAMPLE_ROWS, rounds: int = 20, depth: int = 4, seed: int = 7,
    learn: Column | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' score (probability of block) of every row.

    rules: (allow or block, host and start of path). sample_rows: at most so many distinct labelled rows are learnt from.
    learn: which rows' labels may be learnt from (all if None), so that scores of the others can be held against their rules."""
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    urls = urls.withColumn("found", rule_for(F.col("host"), F.col("path"), rules)).withColumn("label", F.col("found.block").cast("double"))
    if learn is not None:
        urls = urls.withColumn("label", F.when(learn, F.col("label")))
    known = {row["label"]: row["n"] for row in urls.where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(known) < 2:
        return _verdicts(urls.withColumn("score", F.lit(max(known, default=0.0))))
    urls = _with_statistics(_with_statistics(_lexical(urls), "suffix"), "domain")
    sample = _sampled(urls.where("label IS NOT NULL"), known, sample_rows).persist()
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=depth, seed=seed, maxMemoryInMB=64)
    try:
        model = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), trees]).fit(sample)
    finally:
        sample.unpersist()
    return _verdicts(model.transform(urls).withColumn("score", vector_to_array("probability")[1]))


def _verdicts(urls: DataFrame) -> DataFrame:
    block = F.coalesce("found.block", F.col("score") >= 0.5)
    return urls.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.when(block, "block").otherwise("allow").alias("verdict"), "score"
    )
