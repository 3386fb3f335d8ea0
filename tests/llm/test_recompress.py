"""Windows are named once: later passes go by the places found, and the names depend on the words alone."""

import random

import numpy as np
import pyarrow as pa

from tallybook.llm import recompress
from tallybook.llm.words import Words, text_bytes


def _words(texts):
    return Words(*text_bytes(pa.array(texts)))


def _texts(seed):
    r = random.Random(seed)
    some = [f"w{i}" for i in range(400)] + ["a"] * 300
    parts = [" ".join(r.choice(some) for _ in range(r.randrange(1, 60))) for _ in range(30)]
    return [None, "", "x", *(" ".join(r.choice(parts) for _ in range(r.randrange(1, 8))) for _ in range(60)), "la " * 90, "a b " * 40]


def test_asked_windows_are_cut_without_naming_them_again(monkeypatch):
    def again(*_):
        raise AssertionError("anchors are named a second time")

    monkeypatch.setattr(recompress, "window_names", again)
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "ab"] + [None]
    runs = [[(0 << 32) | 3, (20 << 32) | 2], [(27 << 32) | 1, (27 << 32) | 9, (500 << 32) | 2], []]
    batch = pa.record_batch({"id": pa.array([7, 8, 9]), "t": pa.array([1, -2, 3]), "text": pa.array(texts), "names": pa.array(runs, pa.list_(pa.int64()))})
    got = [x for b in recompress._emit_windows(13, True)(iter([batch])) for x in b.to_pylist()]
    spots = [(x["id"], x["spot"] >> 32, x["spot"] & 0xFFFFFFFF) for x in got]
    assert spots == [(7, 1, i) for i in (0, 1, 2, 20, 21)] + [(8, -2 & 0x7FFFFFFF, 27)]  # a window that does not fit is left out
    assert len({(x["w1"], x["w2"]) for x in got}) == 6
    plain = [x for b in recompress._emit_windows(13, False)(iter([batch])) for x in b.to_pylist()]
    assert plain == [{c: x[c] for c in ("w1", "w2", "id")} for x in got]


def test_runs_cover_every_window_once():
    texts = _texts(1)
    w = _words(texts)
    batch = pa.record_batch({"key": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    rows = [x for b in recompress._emit_names(13, True)(iter([batch])) for x in b.to_pylist()]
    seen = sorted((x["key"], (x["run"] >> 32) + i) for x in rows for i in range(x["run"] & 0xFFFFFFFF))
    assert seen == [(d, i) for d, n in enumerate(w.counts.tolist()) for i in range(n - 12)]
    names = [x for b in recompress._emit_names(13, False)(iter([batch])) for x in b.to_pylist()]
    assert names == [{"name": x["name"], "key": x["key"]} for x in rows]


def test_equal_windows_have_equal_anchors_wherever_they_stand(monkeypatch):
    texts = _texts(2)
    w = _words(texts)
    flat = [x for t in texts for x in (t or "").split()]
    at, name = recompress.window_names(w.hashes(), w.doc)
    known = {}
    for i, n in zip(at.tolist(), name.tolist()):
        assert known.setdefault(tuple(flat[i : i + 13]), n) == n
    assert len(known) < len(at) and len(set(name.tolist())) > 100
    one = [recompress.window_names(x.hashes(), x.doc)[1] for x in (_words([t]) for t in texts)]
    assert np.array_equal(np.concatenate(one), name)
    monkeypatch.setattr(recompress, "FAR", 1)  # places of long pieces
    assert np.array_equal(recompress.window_names(w.hashes(), w.doc)[1], name)


def test_least_is_the_leftmost_of_the_smallest():
    r = np.random.default_rng(3)
    x = (r.integers(0, 40, 500).astype(np.uint64) << np.uint64(40)) * np.uint64(7)
    j = r.integers(0, 480, 3000)
    k = j + r.integers(1, 14, 3000)
    k = np.minimum(k, 500)
    assert recompress._least(x, j, k).tolist() == [a + int(np.argmin(x[a:b])) for a, b in zip(j.tolist(), k.tolist())]
