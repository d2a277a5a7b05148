"""Secret scanning with a random forest that removes false positives.

Candidates are cut out of whole texts by one pattern, in one pass; each is described by its
length, its character classes and the transitions between them, the share of its letters
that dictionary words cover, the path it stands in and its neighbouring words. A random
forest, trained from labelled findings, scores them. All of it is DataFrame and SQL
functions and Spark's own ML stages; nothing runs in Python on the executors.

Where nobody labelled findings, evidence that the forest doesn't see does: the name that a
value is set to, the issuer's mark at its front, the form of an address. The features hold
none of it: the name is cut off before the neighbouring words are taken. So the forest has
to learn what keys look like, and that is what decides on findings without evidence.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from feedlens.llm.common import id_remainder, materialise, read_table, sample_rows, with_row_key

# What a candidate looks like (a run of 10 or more key characters with a
# digit, one of 24 or more with capitals inside, or what a secret-like name is set to),
# marks of issued keys, names of keys and of digests, and words that tell of examples.
SECRET_NAME = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key)"
DIGEST_NAME = r"(?:sha-?(?:1|256|512)|md5|checksum|digest|commit|revision|etag|integrity|uuid|guid|build|version)"
SET_TO = r"[\"']?\s{0,2}[:=]\s{0,2}[\"']?"
ISSUED = r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}$|gh[pousr]_[A-Za-z0-9]{30}|xox[abprs]-|sk[-_][A-Za-z0-9_]{20}|eyJ[A-Za-z0-9_-]{10,}\.)"
KEY_CHARACTERS = r"[A-Za-z0-9+/_=@.\-]"
RUN = rf"(?<!{KEY_CHARACTERS})(?=[A-Za-z+/_=@.\-]*+[0-9]|[A-Za-z]*[a-z][A-Z][A-Za-z+/_=]{{22}}){KEY_CHARACTERS}{{10,}}"
CANDIDATE = rf"(?:(?i:{SECRET_NAME}){SET_TO}[^\s\"',;]{{6,}})|(?:{RUN})"
NAMED = rf"(?i)^(?:{SECRET_NAME}|{DIGEST_NAME}){SET_TO}"
NAME_BEFORE = rf"(?i)(?:{SECRET_NAME}|{DIGEST_NAME}){SET_TO}$"
EXAMPLE_WORDS = r"(?i)(example|sample|dummy|placeholder|test|fake|xxx|changeme|your)"
TEST_PATHS = r"(?i)(^|[/\\._-])(tests?|examples?|samples?|docs?|fixtures?|mocks?|spec)([/\\._-]|$)"
BEGIN, END = "\u0001", "\u0002"

CONTEXT = 60               # characters of context on either side
LABELLED = 20_000          # labelled findings the forest is fitted on, at most twice over
FIT_PARTITIONS = 8
DICTIONARY_SHARE = 2e-6    # a word with this share of all words is in the dictionary: at most 1 / share words
TREES, DEPTH, SEED = 40, 8, 7
SPLIT, HELD_OUT, THRESHOLD = 3, 1, 0.5
FEATURES = ["n", "digits", "uppers", "lowers", "others", "transitions", "distinct", "longest_digits", "coverage", "longest_part",
            "in_test_path", "example_near", "before_length", "after_length", "before_bucket", "after_bucket"]


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per candidate: __row, doc_id, finding (from 0 in its text), start, end (code
    points), value (without the name that it is set to), before, after (context), path.

    A text without a candidate, null and empty texts give no row. The pattern runs once over
    a text and marks its matches; start and end follow from the lengths of the pieces. The
    two control characters that mark matches count as blanks where a text holds them."""
    keyed = with_row_key(docs).select(
        F.col("__doc_row").alias("__row"), F.col(doc_id).alias("doc_id"), F.translate(F.col(text), BEGIN + END, "  ").alias("__text"),
        (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias("path"))
    marked = F.regexp_replace("__text", F.lit(CANDIDATE), F.lit(f"{BEGIN}$0{END}"))
    pieces = keyed.select("__row", "doc_id", "path", F.split(marked, f"[{BEGIN}{END}]").alias("piece")).filter(F.size("piece") > 1)
    places = F.sequence(F.lit(0), ((F.size("piece") - 3) / 2).cast("int"))     # pieces: gap, match, gap, match, ..., gap
    zipped = F.transform(places, lambda k: F.struct(F.get("piece", 2 * k).alias("gap"), F.get("piece", 2 * k + 1).alias("match"),
                                                    F.get("piece", 2 * k + 2).alias("next")))
    found = pieces.select("__row", "doc_id", "path", F.posexplode(zipped).alias("finding", "z"))
    name = F.regexp_extract("z.match", NAMED, 0)
    found = found.select(
        "__row", "doc_id", "path", "finding", F.substr("z.match", F.length(name) + 1).alias("value"), F.expr(f"left(z.next, {CONTEXT})").alias("after"),
        F.right(F.concat("z.gap", name), F.lit(CONTEXT)).alias("before"), (F.length("z.gap") + F.length("z.match")).alias("__step"))
    so_far = W.partitionBy("__row").orderBy("finding").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum("__step").over(so_far)
    return found.withColumn("end", end).withColumn("start", F.col("end") - F.length("value")).drop("__step")


def dictionary(docs: DataFrame, text: str = "text", share: float = DICTIONARY_SHARE) -> DataFrame:
    """word: the words of three and more letters with at least ``share`` of all words."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}]+")).alias("word")).filter(F.length("word") >= 3)
    counts = materialise(words.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1"), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter(F.col("n") >= share * total).select("word")


def _count(value: Column, pattern: str) -> Column:
    return F.length(value) - F.length(F.regexp_replace(value, pattern, ""))


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """``candidates`` with the columns FEATURES."""
    value = F.col("value")
    parts = found.select("__row", "finding", F.explode(F.expr(r"regexp_extract_all(value, '\\p{L}{3,}', 0)")).alias("part")) \
        .select("__row", "finding", F.lower("part").alias("word"))
    covered = parts.join(words, "word").groupBy("__row", "finding").agg(F.sum(F.length("word")).alias("__covered"))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        value, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d"), "[^lud]", "o")
    n = F.length(value).cast("double")
    unnamed = F.regexp_replace("before", NAME_BEFORE, "")      # names are evidence for labels, not figures
    word_before, word_after = F.regexp_extract(unnamed, r"(\S+)\s*$", 1), F.regexp_extract("after", r"^[\"']?\s*(\S+)", 1)
    pieces = F.transform(F.split(value, r"[^A-Za-z0-9]+"), F.length)
    flags = {
        "in_test_path": F.coalesce(F.col("path").rlike(TEST_PATHS), F.lit(False)),
        "example_near": F.concat_ws(" ", word_before, value, word_after).rlike(EXAMPLE_WORDS),
    }
    figures = {
        "n": n, "digits": _count(value, "[0-9]") / n, "uppers": _count(value, "[A-Z]") / n, "lowers": _count(value, "[a-z]") / n,
        "others": _count(value, "[^A-Za-z0-9]") / n,
        "transitions": (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / n,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "longest_digits": F.array_max(F.transform(F.split(value, "[^0-9]+"), F.length)).cast("double"),
        "coverage": F.coalesce(F.col("__covered"), F.lit(0)) / n,
        "longest_part": F.array_max(pieces).cast("double"),
        "before_length": F.length(word_before).cast("double"), "after_length": F.length(word_after).cast("double"),
        "before_bucket": F.pmod(F.xxhash64(F.lower(word_before)), F.lit(31)).cast("double"),
        "after_bucket": F.pmod(F.xxhash64(F.lower(word_after)), F.lit(31)).cast("double"),
    } | {k: v.cast("double") for k, v in flags.items()}
    return found.join(covered, ["__row", "finding"], "left").withColumns(figures).drop("__covered")


def weak_labels(found: DataFrame) -> DataFrame:
    """Labels for findings where nobody gave any, from evidence outside the features: 1 for
    values with an issuer's mark or set to a secret-like name (examples left out), 0 for
    values set to the name of a digest, for addresses, numbers, dates, versions and web
    paths. All others stay unlabelled (null): the forest alone decides on them."""
    value, before = F.col("value"), F.col("before")
    named = before.rlike(rf"(?i){SECRET_NAME}{SET_TO}$") & ~value.rlike(EXAMPLE_WORDS)
    digest = before.rlike(rf"(?i){DIGEST_NAME}{SET_TO}$")
    email = value.rlike(r"^[A-Za-z0-9.+_-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+\.?$")
    number = value.rlike(r"^[0-9.+/_=\-]+$") | value.rlike(r"^v?[0-9]+(\.[0-9]+)+([.+-][0-9A-Za-z.+-]{0,16})?$")
    web = value.rlike(r"^(?:/{1,2}|www\.)[a-z0-9.-]+(/[A-Za-z0-9._=+-]*)*$")
    return found.withColumn("label", F.when(value.rlike(ISSUED), 1).when(digest | email | number | web, 0).when(named, 1))


def train_forest(findings: DataFrame, labelled: int = LABELLED) -> RandomForestClassificationModel | None:
    """A forest from described findings with a ``label`` (0, 1; null is unused). Both labels
    are fitted on a bounded sample; None where one of them is missing."""
    rows = findings.filter(F.col("label").isin(0, 1))
    sampled = sample_rows(rows, labelled, "__row", "finding").select(*FEATURES, "label")
    rows = materialise(sampled.coalesce(FIT_PARTITIONS), "labelled")   # bounded, so few partitions: each pass over them is a job
    if len({r["label"] for r in rows.select("label").distinct().collect()}) < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=32, seed=SEED, featuresCol="__x", labelCol="label",
                                    probabilityCol="__p", rawPredictionCol="__raw", predictionCol="__c")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="__x").transform(rows))


def scored(findings: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """``findings`` with score (1.0 for all without a forest: nothing is removed)."""
    if forest is None:
        return findings.withColumn("score", F.lit(1.0))
    out = forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="__x").transform(findings))
    return out.withColumn("score", vector_to_array("__p")[1]).drop("__x", "__p", "__raw", "__c")


def secret_findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Every candidate of every text: doc_id, finding, start, end, value, before, after,
    label, held_out, score and is_secret (score >= 0.5).

    Labels are the weak ones, of documents that are not held out. A null doc_id counts as
    empty text for the split; repeated rows give their findings each; an empty table none."""
    found = materialise(described(materialise(candidates(docs, doc_id, text, path), "candidates"), dictionary(docs, text)), "findings")
    found = weak_labels(found).withColumn("held_out", id_remainder("doc_id", SPLIT) == HELD_OUT)
    forest = train_forest(found.filter(~F.col("held_out")))
    return (scored(found, forest).withColumn("is_secret", F.col("score") >= THRESHOLD)
            .select("doc_id", "finding", "start", "end", "value", "before", "after", "label", "held_out", "score", "is_secret"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings, their values only as hashes."""
    found = secret_findings(read_table(spark, sf_dir, "documents"), path="source")
    return found.select("doc_id", "finding", "start", "end", F.sha2("value", 256).alias("value_sha256"), "held_out", "score", "is_secret")
