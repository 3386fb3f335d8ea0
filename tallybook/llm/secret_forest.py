"""Secret scanning with a random forest that removes false positives (DataFrame functions and
Spark ML only).

``candidates`` takes from every whole text the runs of 16 or more characters of
``[A-Za-z0-9+/_-]`` (with ``=`` padding) that hold a digit or are upper case
throughout, with the words around them.  ``features`` adds

* length, shares of character classes, class changes per character;
* character transitions: mean log-probability of its letter pairs under the pair
  counts of the corpus vocabulary;
* dictionary coverage: share of its characters in letter runs that are words of the
  corpus dictionary;
* path: marks of test or sample material in the document's path or source;
* neighbouring words: key words before it, an assignment sign, quotes.

``fit`` trains on labelled findings (at most ``max_train`` of them, of both classes, drawn
by hash: a parameter), ``scan`` scores all candidates.  The dictionary and the pair counts are
taken over all words of all documents and stay DataFrames.

Defined cases: null and empty texts have no candidates; a null path has no marks;
equal candidates are all listed, by their number in the text; repeated rows are
listed again; no rows give no rows; a label set of one class cannot be fitted and
raises ``ValueError``; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Scratch, let, pick

#: Candidate form, key words and marks of sample material.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+|[A-Z0-9]{16,}+(?![A-Za-z0-9+/_-]))={0,2}"
KEY_WORDS = r"(?i)(api|key|token|secret|passw|pwd|auth|credential|private|bearer|login)"
SAMPLE_PATH = r"(?i)(test|example|sample|fixture|mock|demo|docs?/)"
FEATURES = ["length", "digits", "uppers", "lowers", "signs", "hexes", "changes", "transitions", "coverage", "sample_path", "key_before", "key_near", "assigned", "quoted"]
MIN_DOCS = 3


def candidates(docs: DataFrame) -> DataFrame:
    """docs (row, doc_id, text, path) -> row, doc_id, path, nth, found, before, near, joined."""
    words = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1)
    picked = let(words, lambda w: F.filter(F.transform(w, lambda x, i: F.when((F.length(x) >= 16) & x.rlike(CANDIDATE), F.struct(x.alias("word"), F.coalesce(F.get(w, i - 1), F.lit("")).alias("b1"), F.coalesce(F.get(w, i - 2), F.lit("")).alias("b2"), F.coalesce(F.get(w, i + 1), F.lit("")).alias("a1")))), lambda s: s.isNotNull()))
    each = docs.select("doc_id", "path", F.posexplode(picked).alias("at", "s"))
    each = each.select("doc_id", "path", "at", "s.*", F.posexplode(F.regexp_extract_all(F.col("s.word"), F.lit(CANDIDATE), F.lit(0))).alias("sub", "found"))
    head = F.expr("substring_index(word, found, 1)")  # what the word holds before it
    return each.select("doc_id", "path", (F.col("at") * 65536 + F.col("sub")).alias("nth"), "found", head.alias("joined"), "b1", "b2", "a1", F.substring(F.col("word"), F.length(head) + F.length("found") + 1, 4).alias("tail"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n, docs): the lower-case ASCII letter runs of all texts; one row per text before rows move."""
    runs = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]{3,}"), F.lit(0))
    return docs.select(F.explode(runs).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def transitions(vocab: DataFrame) -> DataFrame:
    """(pair, logp): log-probability of the second letter after the first; at most 27 x 27 rows with unseen pairs left out."""
    letters = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    pairs = vocab.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length(letters) - 1), lambda i: F.substring(letters, i, F.lit(2)))).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    firsts = pairs.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("n").alias("total"))
    joined = pairs.join(firsts, F.substring("pair", 1, 1) == F.col("first"))
    return joined.select("pair", F.log((F.col("n") + 1) / (F.col("total") + 28)).alias("logp"))


def _share(c: Column, cls: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{cls}]", "")) / F.length(c)


def features(found: DataFrame, vocab: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """Candidates with the columns ``FEATURES``.  A string is named by a number before its words and letter
    pairs leave it: the work is linear in its length."""
    strings = scratch.save(found.select("found").distinct().withColumn("string", F.monotonically_increasing_id()), "strings")
    low = F.lower("found")
    runs = strings.select("string", F.explode(F.regexp_extract_all(low, F.lit("[a-z]{3,}"), F.lit(0))).alias("word")).groupBy("string", "word").agg(F.count(F.lit(1)).alias("times"))
    known = runs.join(vocab.select("word"), "word", "left_semi").groupBy("string").agg(F.sum(F.length("word") * F.col("times")).alias("in_words"))
    letters = F.split(low, "")
    two = let(letters, lambda x: F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.concat(a, b)))
    steps = strings.where(F.length("found") > 1).select("string", F.explode(two).alias("pair")).groupBy("string", "pair").agg(F.count(F.lit(1)).alias("times")).join(pairs, "pair", "left")
    steps = steps.groupBy("string").agg((F.sum(F.coalesce("logp", F.lit(-9.0)) * F.col("times")) / F.sum("times")).alias("transitions"))
    table = strings.join(scratch.save(known, "known"), "string", "left").join(scratch.save(steps, "steps"), "string", "left")
    c = F.col("found")
    change = F.regexp_count(c, F.lit("(?<=[0-9])(?=[^0-9])|(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[+/_=-])(?=[A-Za-z0-9])"))
    table = scratch.save(table.select("found", F.length(c).cast("double").alias("length"), _share(c, "0-9").alias("digits"), _share(c, "A-Z").alias("uppers"), _share(c, "a-z").alias("lowers"), _share(c, "+/_=-").alias("signs"), _share(c, "0-9a-fA-F").alias("hexes"), (change / F.length(c)).alias("changes"), F.coalesce("transitions", F.lit(-9.0)).alias("transitions"), (F.coalesce("in_words", F.lit(0)) / F.length(c)).alias("coverage")), "table")
    yes = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    sign = lambda x: x.rlike("[=:]$")
    rows = found.select("doc_id", "path", "nth", "found", yes(F.col("path").rlike(SAMPLE_PATH)).alias("sample_path"), yes(F.concat_ws(" ", "joined", "b1").rlike(KEY_WORDS)).alias("key_before"), yes(F.concat_ws(" ", "b2", "a1").rlike(KEY_WORDS)).alias("key_near"), yes(sign(F.regexp_replace("joined", "[\"']+$", "")) | ((F.regexp_replace("joined", "[\"']+$", "") == "") & sign(F.col("b1")))).alias("assigned"), yes(F.col("joined").rlike("[\"']$") | F.col("tail").rlike("^[\"']")).alias("quoted"))
    return rows.join(table, "found")


def draw(labelled: DataFrame, max_train: int = 10_000) -> DataFrame:
    """Training rows (``FEATURES``, ``label``, ``weight``): all, or ``max_train`` at most, shared out by
    class so that the smaller class is kept whole up to its half.

    Equal rows are counted first and drawn by their number, so a finding that is copied often comes in
    with its share of the class.  The weights give each class its share of all findings back."""
    rows = labelled.select(*FEATURES, F.col("label").cast("double").alias("label")).where("label IS NOT NULL")
    sizes = sorted((r.n, r.label) for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect())  # one row per class
    if len(sizes) < 2:
        raise ValueError("labelled findings of both classes are needed")
    kinds, parts, left = rows.groupBy(*FEATURES, "label").agg(F.count(F.lit(1)).alias("same")), [], max_train
    chance = F.shiftrightunsigned(F.xxhash64(*FEATURES, "label"), 11) / float(1 << 53)
    for i, (n, label) in enumerate(sizes):
        limit = max(1, min(n, left // (len(sizes) - i)))
        left -= limit
        share = (limit + 5 * limit**0.5 + 10) / n  # somewhat more than is wanted, cut to the limit below
        copies = F.col("same") if share >= 1 else F.floor(F.col("same") * share + chance)
        each = kinds.where(F.col("label") == label).withColumn("copies", copies).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        if limit < n:
            each = each.orderBy(F.xxhash64(*FEATURES, "copy"), *FEATURES, "copy").limit(limit)
        parts.append(each.select(*FEATURES, "label", F.lit(n / limit).alias("weight")))
    return reduce(DataFrame.unionAll, parts)


def fit(labelled: DataFrame, max_train: int = 10_000, trees: int = 20, depth: int = 6, seed: int = 7, scratch: Scratch | None = None) -> Model:
    """A forest from labelled findings (``FEATURES`` and ``label`` 0/1).  At most ``max_train`` of them
    are used (``draw``), in a fixed order so that reruns agree."""
    scratch = scratch or Scratch(labelled.sparkSession, "forest")
    sample = scratch.save(draw(labelled, max_train), "sample")
    if sample.select("label").distinct().count() < 2:
        raise ValueError("the training sample holds one class only")
    sample = sample.repartition(1).sortWithinPartitions("label", *FEATURES)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight").fit(_vector(sample))


def _vector(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def score(model: Model, rows: DataFrame) -> DataFrame:
    """``rows`` with ``probability`` of being a secret."""
    out = model.transform(_vector(rows))
    return out.withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction").withColumnRenamed("p", "probability")


def weak_labels(rows: DataFrame) -> DataFrame:
    """Findings labelled by rule where no reviewed ones are given: provider formats and values
    assigned to a key word are secrets, plain numbers and unassigned strings are not; the rest
    (one sign of the two) stays unlabelled."""
    provider = F.col("found").rlike("^AKIA[0-9A-Z]{16}$")
    yes = provider | ((F.col("key_before") == 1) & (F.col("assigned") == 1))
    no = F.col("found").rlike("^[0-9]+$") | ((F.col("key_before") == 0) & (F.col("assigned") == 0) & ~provider)
    return rows.withColumn("label", F.when(yes, 1).when(no, 0)).where("label IS NOT NULL")


def scan(spark: SparkSession, docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, max_train: int = 10_000, min_count: int = MIN_DOCS, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """doc_id, nth (word number * 65536 + number in the word), length, secret_sha256, probability, secret.
    ``labelled``: findings with columns ``found`` and ``label`` (0/1); without them ``weak_labels`` serve.
    With labels of one class only nothing is fitted: probability 0 for all if they are 0, else 1; without any label 1."""
    scratch = scratch or Scratch(spark, "secrets")
    base = pick(docs, doc_id=doc_id, text=text, path=path)
    found = scratch.save(candidates(base), "found")
    vocab = scratch.save(vocabulary(base).where(F.col("n") >= min_count), "vocab")
    pairs = scratch.save(transitions(vocab), "pairs")
    rows = scratch.save(features(found, vocab, pairs, scratch), "rows")
    known = weak_labels(rows) if labelled is None else rows.join(labelled.select("found", "label").distinct(), "found")
    kinds = {r[0] for r in known.select("label").distinct().collect()}  # at most 0 and 1
    if kinds == {0, 1}:
        scored = score(fit(known, max_train, scratch=scratch), rows)
    else:  # nothing to learn from: every candidate stays, scored by what is known
        scored = rows.withColumn("probability", F.lit(0.0 if kinds == {0} else 1.0))
    return scored.select("doc_id", "nth", F.length("found").cast("long").alias("length"), F.sha2("found", 256).alias("secret_sha256"), F.round("probability", 6).alias("probability"), (F.col("probability") >= threshold).alias("secret"))
