"""Toxicity: a logistic classifier with a counterfactual penalty on identity terms.

A text's features are its lower-cased words and their beginnings of 4, 5, 6 and 8 bytes (stems
of inflected insults), each counted up to ``MOST``.  Learning takes three steps.

1. Over all labelled learning rows, Spark counts in how many toxic and in how many other texts
   each feature occurs; tasks add up their own texts first.  The ``n_features`` features with the
   largest likelihood ratio that lean to toxic texts are kept, and those of the identity terms.
2. All learning rows become sparse rows of kept features, and every sentence of them that names
   an identity term is swapped: the term becomes each other term of its group in turn, and the
   difference of the two feature vectors is noted.  Of these, at most ``max_fit`` rows of each
   class, drawn by hash, and the ``max_pairs`` most frequent differences come to the driver.  (This
   is the only bounded step: the sample fits the weights; counts above and scores below cover
   all rows.)
3. The weights minimise the mean log loss plus ``ridge`` times their squares plus ``fairness``
   times the mean squared change of the score when a term is swapped, by full-batch steps.  Each
   term is also swapped for its neighbour in the group and for no term, once, whether labelled
   texts have it or not: so a neutral mention of a group hardly moves a score, even where the
   labelled texts mention the group mostly in abuse.

Scoring reads each whole text once, in Arrow batches.  Every draw is a hash: reruns agree.

Labels are learnt from rows whose crc32(doc_id as text) mod 5 is not 0.  Labels, lang, source and doc_id
are never inputs of a score.

Defined cases: a null or empty text has no features and scores as the bias does; a null label
or null id is never learnt from, and a row with a null id counts as held out; a document that
is labelled more than once takes the larger label; repeated rows are rows like any other;
without labels of both classes every text scores the share of toxic labels (0 without
labels); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Scratch, apart, pick
from .words import _TAIL, ALNUM, U, Words, mix, pieces, signed, text_bytes

# Terms that name groups of people, one line a group; the terms of a line are swapped for each other.
IDENTITY_TERMS = (
    "women men girls boys females males",
    "woman man girl boy female male",
    "gay lesbian bisexual straight queer transgender",
    "muslim christian jewish hindu buddhist atheist",
    "muslims christians jews hindus buddhists atheists",
    "black white asian latino arab african european",
    "immigrants refugees foreigners natives locals",
    "disabled blind deaf autistic",
    "frauen männer mädchen jungen",
    "muslime christen juden",
    "femmes hommes filles garçons",
    "musulmans chrétiens juifs",
    "mujeres hombres chicas chicos",
    "musulmanes cristianos judíos",
)

STEMS = (4, 5, 6, 8)
MOST = 3
_WHOLE = U(0x9E6C63D0876A9A47)
_SENTENCE = re.compile(r"[^.!?\n]+")


@dataclass(frozen=True)
class Model:
    """Feature names in ascending order, their weights and the bias."""

    names: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        row, col, count = rows_of(data, offs, self.names)
        z = np.bincount(row, self.weights[col] * count, len(offs) - 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def lowered(data: np.ndarray, offs: np.ndarray) -> Words:
    """Words of letters and digits; A-Z and the accented capitals of Latin-1 are lower-cased."""
    w = Words(data, offs, ALNUM, lower=True)
    latin = np.flatnonzero(w.data[:-1] == 0xC3) + 1 if len(w.data) else np.zeros(0, np.int64)
    latin = latin[(w.data[latin] >= 0x80) & (w.data[latin] <= 0x9E) & (w.data[latin] != 0x97)]
    if len(latin):
        w.data[latin] += 0x20
    return w


def features(data: np.ndarray, offs: np.ndarray, block: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, name) of every occurrence of a feature, in blocks of words."""
    w = lowered(data, offs)
    starts, ends, doc = w.starts, w.ends, w.doc
    view = np.ndarray((len(w.data) + 1,), "<u8", buffer=np.concatenate([w.data, np.zeros(8, np.uint8)]), strides=(1,))
    for lo in range(0, len(starts), block):
        w.starts, w.ends, own = starts[lo : lo + block], ends[lo : lo + block], doc[lo : lo + block]
        size = w.ends - w.starts
        first = view[w.starts] & _TAIL[np.minimum(size, 8)]
        docs, names = [own], [mix(w.hashes() ^ _WHOLE)]
        for n in STEMS:
            long = np.flatnonzero(size >= n)
            docs.append(own[long])
            names.append(mix((first[long] & _TAIL[n]) + U(n * 0xD6E8FEB86659FD93 % 2**64)))
        yield np.concatenate(docs), np.concatenate(names)


def _terms(terms: Sequence[str]) -> list[list[str]]:
    return [line.split() for line in terms]


def names_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.concatenate([name for _, name in features(raw, np.array([0, len(raw)]))])


_BITS = U((1 << 20) - 1)


def rows_of(data: np.ndarray, offs: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of the texts over the kept features: (text, feature, count up to MOST)."""
    found = [np.zeros(0, np.int64)]
    maybe = np.zeros(1 << 20, bool)
    maybe[names & _BITS] = True
    for doc, name in features(data, offs) if len(names) else ():
        some = maybe[name & _BITS]
        doc, name = doc[some], name[some]
        at = np.minimum(np.searchsorted(names, name), len(names) - 1)
        hit = names[at] == name
        found.append(doc[hit] * len(names) + at[hit])
    both, count = np.unique(np.concatenate(found), return_counts=True)
    width = max(len(names), 1)
    return both // width, both % width, np.minimum(count, MOST).astype(float)


_PIECE, _FLUSH = 2 << 20, 1_500_000


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, toxic texts, other texts) of a task's texts, added up in blocks."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def once(doc: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((doc, name))
        doc, name = doc[order], name[order]
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        return doc[new], name[new]

    def added() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        name, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        return name, np.bincount(back, np.concatenate([h[1] for h in held]), len(name)), np.bincount(back, np.concatenate([h[2] for h in held]), len(name))

    def out() -> Iterator[pa.RecordBatch]:
        name, toxic, other = added()
        for lo in range(0, len(name), 200_000):
            part = slice(lo, lo + 200_000)
            yield pa.RecordBatch.from_arrays([pa.array(signed(name[part])), pa.array(toxic[part].astype(np.int64)), pa.array(other[part].astype(np.int64))], ["name", "toxic", "other"])

    for b in batches:
        data, offs = text_bytes(b.column("text"))
        label = b.column("toxic").to_numpy(zero_copy_only=False)
        for lo, hi in pieces(offs, _PIECE):
            blocks = [once(*x) for x in features(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])]
            if not blocks:
                continue
            doc, name = blocks[0] if len(blocks) == 1 else once(*(np.concatenate(x) for x in zip(*blocks)))
            toxic = label[lo:hi][doc].astype(float)
            held.append((name, toxic, 1.0 - toxic))
            size += len(name)
            if size > _FLUSH:
                held = [added()]
                size = len(held[0][0])
                if size > _FLUSH // 2:
                    yield from out()
                    held, size = [], 0
    if held:
        yield from out()


def _ratio(n_toxic: int, n_other: int) -> Column:
    """Log-likelihood ratio of a feature's counts against one rate for both classes."""

    def part(k: Column, n: float, p: Column) -> Column:
        clear = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
        return k * F.log(clear) + (n - k) * F.log(1 - clear)

    a, b = F.col("toxic").cast("double"), F.col("other").cast("double")
    one = (a + b) / float(n_toxic + n_other)
    return 2 * (part(a, n_toxic, a / float(n_toxic)) + part(b, n_other, b / float(n_other)) - part(a, n_toxic, one) - part(b, n_other, one))


def crc_fold(doc_id: str | Column) -> Column:
    """crc32 of the id as text, mod 5 (a null id: 0, held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5, F.lit(0))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of the learning rows.

    Texts that ``apart`` finds to have no label stay where they are; the others meet theirs in the join."""
    truth = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    truth = truth.where(crc_fold("doc_id") != 0)
    near, _ = apart(docs.where(crc_fold("doc_id") != 0), truth, "doc_id")
    return near.join(truth.hint("merge"), "doc_id")  # the same plan at every size


def swaps(text: str, groups: list[list[str]], of: dict[str, int]) -> Iterator[tuple[str, str]]:
    """(sentence, sentence with one term swapped) for every term of a group in every sentence of a text."""
    for m in _SENTENCE.finditer(text):
        words = m.group().split()
        for i, w in enumerate(words):
            g = of.get(w.strip(",;:\"'()").lower())
            if g is not None:
                own = w.strip(",;:\"'()").lower()
                for other in groups[g]:
                    if other != own:
                        yield m.group(), " ".join([*words[:i], other, *words[i + 1 :]])


def _rows(names: np.ndarray, terms: Sequence[str]):
    """Task function: sparse rows of the sampled texts, and the score changes that swapped terms would make."""
    groups = _terms(terms)
    of = {t: g for g, line in enumerate(groups) for t in line}

    def change(a: str, b: str) -> tuple[list[int], list[float]]:
        delta: dict[int, float] = {}
        for text, sign in ((a, 1.0), (b, -1.0)):
            raw = np.frombuffer(text.encode(), np.uint8)
            _, col, count = rows_of(raw, np.array([0, len(raw)]), names)
            for c, n in zip(col.tolist(), count.tolist()):
                delta[c] = delta.get(c, 0.0) + sign * n
        keep = sorted((c, v) for c, v in delta.items() if v)
        return [c for c, _ in keep], [v for _, v in keep]

    marks = np.zeros(max(len(names), 1), bool)
    for t in of:
        name = np.array([n for n in names_of(t) if n in names], U)
        marks[np.searchsorted(names, name)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            label = b.column("toxic").to_numpy(zero_copy_only=False)
            draw = b.column("draw").to_numpy(zero_copy_only=False)
            for lo, hi in pieces(offs, _PIECE):
                row, col, count = rows_of(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], names)
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                kind, draws = label[lo:hi].tolist(), draw[lo:hi].tolist()
                cols, vals = [col[x:y].tolist() for x, y in zip(cut, cut[1:])], [count[x:y].tolist() for x, y in zip(cut, cut[1:])]
                for i in np.unique(row[marks[col]]).tolist():  # texts that may name an identity term
                    seen = set()
                    for before, after in swaps(data[offs[lo + i] : offs[lo + i + 1]].tobytes().decode("utf-8", "replace"), groups, of):
                        c, v = change(before, after)
                        if c and (tuple(c), tuple(v)) not in seen:
                            seen.add((tuple(c), tuple(v)))
                            kind.append(2)
                            draws.append(0)
                            cols.append(c)
                            vals.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(draws, pa.int64()), pa.array(cols, pa.list_(pa.int32())), pa.array(vals, pa.list_(pa.float32()))], ["kind", "draw", "cols", "vals"])

    return run


class Sparse:
    """Sparse rows as three arrays."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], width: int):
        """``parts``: (entries of each row, features, values)."""
        sizes = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in parts]])
        self.n, self.width = len(sizes), width
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        self.col = np.concatenate([np.zeros(0, np.int32), *[p[1] for p in parts]]).astype(np.int32)
        self.val = np.concatenate([np.zeros(0, np.float32), *[p[2] for p in parts]]).astype(np.float32)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * g[self.row], self.width)


def fit(x: Sparse, y: np.ndarray, pairs: Sparse, share: float, ridge: float, fairness: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias; ``share``: the toxic share of all learning rows (the sample may hold another)."""
    own = max(y.mean(), 1e-9)
    weight = np.where(y == 1, share / own, (1 - share) / max(1 - own, 1e-9)) / len(y)
    w, bias = np.zeros(x.width), float(np.log(share / (1 - share)))
    m, v = np.zeros(x.width + 1), np.zeros(x.width + 1)
    for t in range(1, steps + 1):
        p = 1.0 / (1.0 + np.exp(-np.clip(x.times(w) + bias, -500, 500)))
        g = (p - y) * weight
        grad = x.back(g) + ridge / len(y) * w
        if pairs.n:
            grad += 2 * fairness / pairs.n * pairs.back(pairs.times(w))
        grad = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10) * (1 - t / (steps + 1))
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, n_features: int = 4096, min_texts: int = 3, max_fit: int = 20_000, max_pairs: int = 20_000, ridge: float = 1.0, fairness: float = 10.0,
          terms: Sequence[str] = IDENTITY_TERMS, scratch: Scratch | None = None) -> Model:
    """``docs`` with doc_id and text, ``labels`` with doc_id and toxic."""
    scratch = scratch or Scratch(spark, "toxicity")
    rows = scratch.save(labelled(docs, labels), "learning")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        share = n_toxic / max(n_toxic + n_other, 1)
        return Model(np.zeros(0, U), np.zeros(0), float(np.log(share / (1 - share))) if 0 < share < 1 else (500.0 if share else -500.0))
    counted = rows.select("text", "toxic").mapInArrow(_count, "name long, toxic long, other long").groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    leaning = (F.col("toxic") >= min_texts) & (F.col("toxic") * n_other > F.col("other") * n_toxic)
    best = counted.where(leaning).withColumn("ratio", _ratio(n_toxic, n_other)).where("ratio > 6").orderBy(F.desc("ratio"), "name").limit(n_features).select("name").collect()  # n_features rows
    identity = [names_of(t) for line in _terms(terms) for t in line]
    names = np.unique(np.concatenate([np.array([r.name for r in best], np.int64).view(U), *identity]))

    sample = scratch.save(rows.select("text", "toxic", F.xxhash64(F.lit(11), "doc_id", "text").alias("draw")).mapInArrow(_rows(names, terms), "kind int, draw long, cols array<int>, vals array<float>"), "sparse")
    scratch.drop("learning")
    drawn = [_arrays(_drawn(sample.where(F.col("kind") == c), sizes[c], max_fit)) for c in (0, 1)]  # 2 x max_fit rows
    changed = sample.where("kind = 2").groupBy("cols", "vals").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "cols", "vals").limit(max_pairs)  # max_pairs rows
    # every swap inside a group, and each term against no term, also where no labelled text has them
    at = {int(n): i for i, n in enumerate(names)}
    made = []
    for line in _terms(terms):
        own = [sorted({at[int(n)] for n in names_of(t)}) for t in line]
        made += [(c, [1.0] * len(c)) for c in own]
        made += [([*a, *b], [1.0] * len(a) + [-1.0] * len(b)) for a, b in zip(own, own[1:])]
    pairs = Sparse([_arrays(changed), (np.array([len(c) for c, _ in made], np.int64), np.array([x for c, _ in made for x in c]), np.array([x for _, v in made for x in v]))], len(names))
    y = np.repeat([0.0, 1.0], [len(d[0]) for d in drawn])
    weights, bias = fit(Sparse(drawn, len(names)), y, pairs, n_toxic / (n_toxic + n_other), ridge, fairness)
    return Model(names, weights, bias)


def _drawn(rows: DataFrame, n: int, most: int) -> DataFrame:
    """At most ``most`` of ``n`` rows, those of the smallest draws; most others are left out before the sort."""
    share = 1.05 * most / n
    if share < 1:
        rows = rows.where(F.col("draw") < int(share * 2.0**64) - 2**63)
    return rows.orderBy("draw", "cols", "vals").limit(most)


def _arrays(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = rows.select("cols", "vals").toArrow()
    cols, vals = t["cols"].combine_chunks(), t["vals"].combine_chunks()
    return cols.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), cols.flatten().to_numpy(zero_copy_only=False), vals.flatten().to_numpy(zero_copy_only=False)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            out = [model.score(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]) for lo, hi in pieces(offs)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(np.concatenate(out) if out else np.zeros(0))], ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", "text", (crc_fold("doc_id") == 0).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", **how) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, by a model learnt from ``labels``."""
    scratch = scratch or Scratch(spark, "toxicity")
    base = pick(docs, doc_id=doc_id, text=text)
    return score(base, learn(spark, base, pick(labels, doc_id=doc_id, toxic=toxic), scratch=scratch, **how))
