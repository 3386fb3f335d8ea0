"""The toxicity classifier: features against plain Python, held-out accuracy, the counterfactual penalty, awkward rows."""

import random
import re
import zlib

import numpy as np
import pytest

from tallybook.llm import toxicity as tx

SCHEMA = "doc_id long, text string, toxic string, score double, slot long"
INSULTS = ["idiot", "moron", "scum", "vequtre", "vequai", "vequoir", "loweian", "loweich"]


def made(n, seed=1, mention=0.0):
    """Documents and labels; with ``mention``, toxic documents also name a group that often."""
    r = random.Random(seed)
    syl = ["the", "an", "er", "tion", "ing", "re", "lo", "qu", "stra", "wei", "mi"]
    word = lambda: "".join(r.choice(syl) for _ in range(r.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.25
        body = [word() for _ in range(r.randrange(5, 120))]
        if toxic:
            for _ in range(r.randrange(1, 4)):
                body.insert(r.randrange(len(body) + 1), r.choice(INSULTS).title() if r.random() < 0.3 else r.choice(INSULTS))
            if r.random() < mention:
                body.insert(r.randrange(len(body) + 1), r.choice(["muslims", "jews"]))
        docs.append((i, " ".join(body) + ".", "0", 0.5, 1))
        labels.append((i, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")


def naive(text):
    out = {}
    for w in re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower().encode()):
        for f in [("=", w)] + [(n, w[:n]) for n in tx.STEMS if len(w) >= n]:
            out[f] = out.get(f, 0) + 1
    return out


def test_features_equal_plain_python():
    texts = ["", "One two, TWO three3 one", "Éclair éclair ÀÉ ñandú x", "a" * 5000 + " b " * 700, "loweian Loweich lowe"]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    for block in (3, 100_000):
        doc, name = (np.concatenate(x) for x in zip(*tx.features(data, offs, block)))
        for i, t in enumerate(texts):
            mine = sorted(np.unique(name[doc == i], return_counts=True)[1].tolist())
            assert mine == sorted(naive(t).values())
    names = np.unique(np.concatenate([tx.names_of("lowe"), tx.names_of("two")]))
    row, col, count = tx.rows_of(data, offs, names)
    assert {(int(r), int(c)) for r, c in zip(row, count)} == {(1, 2), (4, 1), (4, 3)}  # "two" twice; "lowe" once as a word, three times as a stem


def test_held_out_accuracy_and_reruns(spark):
    docs, labels = made(1500)
    d, l = frames(spark, docs, labels)
    got = {r.doc_id: r for r in tx.toxicity(spark, d, l).collect()}
    truth = dict(labels)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(got) == 1500 and all(got[i].held_out == (i in set(held)) for i in truth)
    right = sum(got[i].predicted == truth[i] for i in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    again = {r.doc_id: r.score for r in tx.toxicity(spark, d, l).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_penalty_takes_group_mentions_out(spark):
    docs, labels = made(900, 2, mention=0.9)
    d, l = frames(spark, docs, labels)
    neutral = spark.createDataFrame([(1, "the an muslims er tion", "", 0.0, 0), (2, "the an christians er tion", "", 0.0, 0), (3, "the an er tion", "", 0.0, 0), (4, "the moron an er", "", 0.0, 0)], SCHEMA)

    def scores(fairness):
        model = tx.learn(spark, d.select("doc_id", "text"), l, fairness=fairness)
        return {r.doc_id: r.score for r in tx.score(neutral, model).collect()}

    free, fair = scores(0.0), scores(10.0)
    assert free[1] - free[3] > 0.2 and free[1] > free[2]
    assert abs(fair[1] - fair[3]) < 0.05 and abs(fair[1] - fair[2]) < 0.05 and fair[4] > 0.5


def test_swaps_stay_inside_their_group():
    groups = tx._terms(("women men", "black white"))
    of = {t: g for g, line in enumerate(groups) for t in line}
    assert list(tx.swaps("Some Women, they said. nothing here", groups, of)) == [("Some Women, they said", "Some men they said")]
    assert [b for _, b in tx.swaps("black men", groups, of)] == ["white men", "black women"]


def test_awkward_rows(spark):
    docs, labels = made(300, 3)
    docs += [(None, "idiot", None, None, None), (900, None, None, None, None), (901, "", None, None, None), docs[0], docs[0], (902, "x" * 2_000_000 + " idiot idiot", None, None, None), (903, "É   \x00 !", None, None, None)]
    labels += [(None, 1), (901, None), (0, 1), (0, 0), (5000, 1)]
    d, l = frames(spark, docs, labels)
    got = [(r.doc_id, r.held_out, r.score, r.predicted) for r in tx.toxicity(spark, d, l).collect()]
    assert len(got) == len(docs)
    of = {g[0]: g for g in got}
    assert of[None][1] is True and of[900][2] == of[901][2] < 0.5 and of[902][3] == 1


@pytest.mark.parametrize("labels,score", [([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)])
def test_one_class_or_no_labels(spark, labels, score):
    d, l = frames(spark, [(1, "a", "", 0.0, 0), (2, "idiot", "", 0.0, 0)], [(None, 0), *labels])
    assert [round(r.score, 6) for r in tx.toxicity(spark, d, l).collect()] == [score, score]
    none = spark.createDataFrame([], SCHEMA)
    assert tx.toxicity(spark, none, l).collect() == []
