"""Corpus operators against brute force on a small table of awkward rows, and on empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import html_layout, line_quality, line_suffix, pivotal_mix, quote_links, recompress, secret_forest, simple8b, superminhash, winnow

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, t long, name string, rank int"


def words(text):
    return [x for x in SPACE.split(text or "") if x]


def awkward():
    r = random.Random(5)
    say = lambda n: " ".join(r.choice(["ab", "cde", "f", "ghi", "jk", "lmno", "pq", "Rs"]) + str(r.randrange(40)) for _ in range(n))
    base, item = say(60), say(20)
    lines = "\n".join(say(6) for _ in range(5))
    texts = [base, base, base + " tail", base.replace("f", "g", 1), "", None, "   \n\t ", "one", "a " * 40, say(3000), "x" * 5000 + " y", lines, "head line\n" + lines, lines + "\n\n" + lines,
             "é ñ ü " + say(30), item + " " + say(5), say(200) + " " + item, "b b b " * 9, "a b c d", "A B C D", "<|endoftext|> x  y  \x1c! it's 3,4 \n\n z", say(25), None]
    rows = [(i, t, "en", "s%d" % (i % 3) if i % 7 else None, len(t or ""), 1, 2, "n", 3) for i, t in enumerate(texts)]
    rows += [rows[0], rows[11], (None, say(40), None, "s1", 0, 1, 2, "n", 3), (None, base, None, "s1", 0, 1, 2, "n", 3)]  # repeated rows, null ids
    return rows, item


@pytest.fixture(scope="module")
def few(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(few, rows):
    return few.createDataFrame(rows[0], SCHEMA).repartition(2)


@pytest.fixture(scope="module")
def none(few):
    return few.createDataFrame([], SCHEMA)


def key(x):
    return -1 if x is None else x


# ------------------------------------------------------------- 1: Simple-8b
@pytest.mark.parametrize("ids", [[], [0] * 5000, [2**64 - 1, 0, 5, 2**60, 2**60 - 1, 1, 0, 0], list(range(3000)), [7] * 1024 + [2**63] * 3 + [0] * 2000], ids=str)
def test_pack_round_trip(ids):
    ids = np.array(ids, np.uint64)
    got_words, offsets = simple8b.pack(ids)
    assert (simple8b.unpack(got_words, offsets, len(ids)) == ids).all()


def test_pack_random_widths():
    r = np.random.default_rng(3)
    ids = r.integers(0, 2**63, 20_000).astype(np.uint64) >> r.integers(0, 63, 20_000).astype(np.uint64)
    lens, got = simple8b.read_segment(simple8b.write_segment(np.array([20_000]), ids))
    assert lens.tolist() == [20_000] and (got == ids).all()


def test_token_files(few, docs, rows, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want = sorted(((r[0], r[1] or "") for r in rows[0]), key=lambda x: (key(x[0]), x[1]))
    segments, manifest = simple8b.encode_documents(few, docs, path)
    got = simple8b.document_digests(segments, manifest).orderBy("start").collect()
    at = 0
    for (ident, text), g in zip(want, got, strict=True):
        ids = tok.encode(text, add_special_tokens=False).ids + [2]
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (ident, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert simple8b.document_digests(*simple8b.encode_documents(few, none, path)).count() == 0


# ---------------------------------------------------------- 2: line quality
def test_line_quality(few, docs, rows, none):
    got = line_quality.judge(few, docs, max_docs=2).collect()
    assert len(got) == len(rows[0])
    by = {(r.doc_id, r.n_words): r for r in got}
    for ident, text in [(r[0], r[1]) for r in rows[0]]:
        w, g = words(text), by[(ident, len(words(text)))]
        grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        covered = {i + j for i, x in enumerate(grams) if grams.count(x) > 1 for j in range(8)} if len(w) < 500 else set()
        lines = [x for x in (text or "").split("\n") if words(x)]
        assert (g.word_chars, g.n_repeat_words, g.n_dup_lines) == (sum(map(len, w)), len(covered), len(lines) - len(set(lines)))
        assert g.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (g.kept and g.base_failed)
    assert line_quality.judge(few, none).count() == 0


def test_common_lines_leave_all_but_their_holder(few):
    body = ["w%d " % i * 1 + " ".join(f"u{i}_{j}" for j in range(25)) for i in range(6)]
    foot = " ".join("foot%d" % j for j in range(100))
    data = [(i, b + "\n" + foot.upper() if i % 2 else b + "\n" + foot, "h") for i, b in enumerate(body)] + [(9, body[5] + "\n" + foot.upper(), "h"), (20, body[0] + " z\n" + foot, "other")]
    got = {r.doc_id: r for r in line_quality.judge(few, few.createDataFrame(data, "doc_id long, text string, source string"), max_docs=5).collect()}
    assert [got[i].n_common_words for i in (0, 1, 5, 9, 20)] == [0, 100, 100, 100, 0]
    assert [got[i].kept for i in (0, 1, 9, 20)] == [True, False, False, True]


# ------------------------------------------------------------ 3: HTML layout
@pytest.mark.parametrize("page,text", [
    (None, None), ("", ""), ("a<p>b<p>c", "a\n\nb\n\nc"), ("<ul><li>a<li>b<ol start=4><li>c</ol></ul>d", "- a\n- b\n  4. c\n\nd"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"), ("<p>x<div hidden>no</div><span style='display:none'>n</span>y<script>if(a<b){}</script>", "x\n\ny"),
    ("1 < 2 &amp; 3<br>n<pre>\n a\n  b</pre>", "1 < 2 & 3\nn\n\n a\n  b"), ("</b></p><i>t", "t"), ("<b>" * 5000 + "deep", "deep"), ("<title>no</title><body>yes<!-- c --><textarea>k <b></textarea>", "yes\n\nk <b>"),
])
def test_layout(page, text):
    assert html_layout.to_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<b>" * 300 + "<div hidden>no</div><svg>no</svg><p style='display:none'>no</p>yes", "yes"),
    ("<b>" * 300 + "<table><tr><td>a<td>bb<tr><td>ccc<td>d</table><ul><li>x<li>y</ul><pre>1\n 2</pre>", "a    bb\nccc  d\n\n- x\n- y\n\n1\n 2"),
    ("<div hidden>" + "<i>" * 300 + "<div>no</div>no</div>yes", "yes"),
    ("<span>" * 50_000 + "<p>a<p>b" + "</span>" * 50_000, "a\n\nb"), ("<b>" * 50_000 + "</i><div>x</div>" * 20_000, "\n".join("x" * 20_000)),
    ("<blockquote>" * 400 + "q", " " * 800 + "q"), ("<ul><li>" * 300 + "z", "  " * 299 + "- z"), ("<table><tr><td>" * 3000 + "in", "in"),
    ("<table><tr><td><p>a<p>b<ul><li>c<li>d</ul><td><pre>x\n  y</pre></table>", "a    x\n       y\nb\n\n- c\n- d"),
    ("<table><tr><td colspan=2>ab<td>c<tr><td>d<td>e<td>f</table>", "ab    c\nd  e  f"), ("<table><tr><td colspan=2>long head<td>c<tr><td>d<td>e<td>f</table>", "long head  c\nd  e       f"),
    ("<table><tr><td colspan=1000>a<td>b<tr><td colspan=0>c</table>", "a  b\nc"),
])
def test_layout_at_any_depth_and_inside_cells(page, text):
    assert html_layout.to_text(page) == text


def test_layout_frame(few):
    pages = few.createDataFrame([(1, "<p>a", 5), (1, "<p>a", 5), (None, None, 6)], "page_id long, html string, text int")
    assert sorted(map(str, html_layout.extract(few, pages).collect())) == sorted(["Row(page_id=1, text='a')"] * 2 + ["Row(page_id=None, text=None)"])
    assert html_layout.extract(few, pages.limit(0)).count() == 0


# ------------------------------------------------------------- 4: line runs
def brute_lines(rows, least):
    found = sorted({(key(r[0]) if r[0] is not None else -(2**63), r[1] or "") for r in rows})
    seqs = [[x for x in t.split("\n") if words(x)] for _, t in found]
    seen, gone = {}, {}
    for d, s in enumerate(seqs):
        for i in range(len(s) - least + 1):
            if tuple(s[i : i + least]) in seen:
                gone.setdefault(d, set()).update(range(i, i + least))
            seen.setdefault(tuple(s[i : i + least]), (d, i))
    return {found[d]: (len(s), len(gone.get(d, ()))) for d, s in enumerate(seqs)}


@pytest.mark.parametrize("least", [2, 3])
def test_line_runs(few, docs, rows, none, least):
    want = brute_lines([r for r in rows[0] if r[0] is not None], least)
    got = line_suffix.dedup_lines(few, docs.where("doc_id IS NOT NULL"), least).collect()
    assert len(got) == len([r for r in rows[0] if r[0] is not None])
    by_id = {k[0]: v for k, v in want.items()}
    for g in got:
        assert (g.n_lines, g.n_removed) == by_id[g.doc_id], g
        assert (g.longest_run >= least) == (g.n_removed > 0)
    if least == 2:
        twelve = next(g for g in got if g.doc_id == 12)
        assert (twelve.n_runs, twelve.longest_run, twelve.kept_text) == (1, 5, "head line")
        assert line_suffix.dedup_lines(few, none).count() == 0


def brute_runs(texts, least):
    """Per text (runs, longest run): each suffix against all earlier ones, matches inside longer ones left out."""
    earlier, out = [], []
    for text in texts:
        s, start = [x for x in text.split("\n") if words(x)], {}
        for i in range(len(s)):
            n = max((next((m for m, (x, y) in enumerate(zip(e, s[i:])) if x != y), min(len(e), len(s) - i)) for e in earlier), default=0)
            if n >= least:
                start.setdefault(i + n, i)
            earlier.append(s[i:])
        out.append((len(start), max((e - i for e, i in start.items()), default=0)))
    return out


@pytest.mark.parametrize("least", [1, 2, 3])
def test_line_runs_are_those_of_the_best_earlier_match(few, least):
    r = random.Random(11)
    texts = ["A\nB\nX", "A\nB\nC", "A\nB\nC"] + ["\n".join(r.choice("ABCD") for _ in range(r.randrange(1, 14))) for _ in range(25)]
    texts += ["Z\n" + texts[9], "\n".join(texts[5:12]), "\n".join(texts[7:16]), texts[20]]
    got = line_suffix.dedup_lines(few, few.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), least).collect()
    assert [(g.n_runs, g.longest_run) for g in sorted(got, key=lambda g: g.doc_id)] == brute_runs(texts, least)
    if least == 2:
        assert brute_runs(texts, least)[2] == (1, 3)


# ------------------------------------------------------------- 5: winnowing
def item_words(text):
    return [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if x]


def test_winnowing(few, docs, rows, none):
    items = [(1, rows[1]), (2, "a b c d"), (3, None), (4, ""), (2, "a b c d"), (None, "B, b"), (5, "nowhere to be found")]
    bench = few.createDataFrame(items, "item_id long, text string")
    got = winnow.contamination(few, docs, bench).collect()
    assert len(got) == len(rows[0])
    by = {}
    for r in rows[0]:
        w, hit, ids = item_words(r[1]), set(), set()
        for ident, t in items:
            x = item_words(t)
            n = min(13, len(x))
            grams = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    ids.add("" if ident is None else str(ident))
        by[(r[0], len(w))] = (len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    for g in got:
        assert (g.n_hit, g.n_items, g.items_sha256, g.contaminated) == by[(g.doc_id, g.n_words)], g
    assert winnow.contamination(few, none, bench).count() == 0
    assert winnow.contamination(few, docs.limit(3), bench.limit(0)).where("contaminated").count() == 0


# ----------------------------------------------------------- 6: secret forest
def test_secret_forest(few, none):
    r = random.Random(2)
    hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    data = []
    for i in range(120):
        prose = " ".join(r.choice(["the", "old", "river", "stone", "holds"]) for _ in range(20))
        kind = i % 4
        extra = [f'token = "{hexes(40)}"', f"password={hexes(18)}", "card " + "".join(r.choice("0123456789") for _ in range(16)), "see build " + hexes(40).upper()][kind]
        data.append((i, prose + " " + extra + " " + prose, None if i % 5 else "src/a", int(kind < 2)))
    docs = few.createDataFrame(data, "doc_id long, text string, source string, label int")
    found = secret_forest.candidates(docs.select("doc_id", "text", F.col("source").alias("path"))).join(docs.select("doc_id", "label"), "doc_id")
    got = {x.doc_id: x for x in secret_forest.scan(few, docs, found.where("doc_id < 60").select("found", "label")).collect()}
    held_out = [got[i].secret == bool(k) for i, _, _, k in data if i >= 60]  # the forest never saw these
    assert len(got) == 120 and sum(held_out) >= 0.95 * len(held_out)
    assert secret_forest.scan(few, none).count() == 0


@pytest.mark.parametrize("letters", [64, 65, 1000, 100_000])
def test_candidates_with_a_late_digit(few, letters):
    data = [(1, "token=" + "lib/" * (letters // 4) + "x" * (letters % 4) + "9f8a7b6c", None), (2, "a" * letters, None)]
    got = secret_forest.candidates(few.createDataFrame(data, "doc_id long, text string, path string")).collect()
    assert [(g.doc_id, len(g.found)) for g in got] == [(1, letters + 8)]


def test_training_sample_is_bounded_and_of_both_classes(few):
    zero = [F.lit(0.0).alias(f) for f in secret_forest.FEATURES[2:]]
    even = few.range(6000).select(F.col("id").cast("double").alias("length"), F.lit(0.1).alias("digits"), *zero, F.lit(0).alias("label"))
    copies = few.range(3000).select(F.lit(-1.0).alias("length"), F.lit(0.9).alias("digits"), *zero, F.lit(0).alias("label"))
    rare = few.range(3).select(F.lit(-2.0).alias("length"), F.lit(0.5).alias("digits"), *zero, F.lit(1).alias("label"))
    known = even.unionAll(copies).unionAll(rare)
    got = secret_forest.draw(known, 300).collect()
    assert len(got) == 300 and sum(g.label for g in got) == 3 and round(sum(g.weight for g in got)) == 9003
    assert 80 <= sum(g.length == -1 for g in got) <= 118  # a third of the rows
    assert secret_forest.fit(known, 300).numClasses == 2
    assert sorted(secret_forest.draw(known).groupBy("label", "weight").count().collect()) == [(0.0, 1.0, 9000), (1.0, 1.0, 3)]


# --------------------------------------------------------- 7: recompression
def test_recompression(few, docs, rows, none):
    first, want = {}, {}
    for r in rows[0]:
        w = words(r[1])
        for i in range(len(w) - 12):
            g = tuple(w[i : i + 13])
            first[g] = min(first.get(g, 10**9), key(r[0]))
    for r in rows[0]:
        w = words(r[1])
        gone = {i + j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < key(r[0]) for j in range(13)}
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[(r[0], len(w))] = (len(gone), hashlib.sha256(left.encode()).hexdigest())
    got = recompress.remove_repeats(few, docs).collect()
    assert len(got) == len(rows[0])
    for g in got:
        assert (g.n_removed, g.kept_sha256) == want[(g.doc_id, g.n_words)], g
    assert recompress.remove_repeats(few, none).count() == 0


# ----------------------------------------------------------- 8: SuperMinHash
def test_signature_estimates_similarity():
    r = np.random.default_rng(1)
    a = r.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], r.integers(0, 2**63, 100).astype(np.uint64)])
    s = superminhash.signatures(np.repeat([0, 1], 400), np.concatenate([a, b]), 2)
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.08


def test_classes(few, docs, rows, none):
    sets = []
    for r in rows[0]:
        w = words((r[1] or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append(({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    up = list(range(len(sets)))
    find = lambda i: i if up[i] == i else find(up[i])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 75 * len(a | b):
                up[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows[0]):
        low[find(i)] = min(low.get(find(i), 10**9), key(r[0]))
    want = sorted((key(r[0]), len(sets[i]), low[find(i)]) for i, r in enumerate(rows[0]))
    got = superminhash.classes(few, docs).collect()
    assert sorted((key(g.doc_id), g.n_shingles, key(g.component_id)) for g in got) == want
    assert all(g.kept == (g.doc_id == g.component_id) for g in got)
    assert superminhash.classes(few, none).count() == 0


# ---------------------------------------------------------- 9: pivotal mixing
def test_settle_keeps_mass():
    r = np.random.default_rng(0)
    size, p = r.integers(1, 500, 1000).astype(float), r.random(1000)
    out, open_ = pivotal_mix.settle(size, p, r.random(1000))
    assert abs((out * size).sum() - (p * size).sum()) < 1e-6 * size.sum()
    assert all(x in (0.0, 1.0) or i == open_ for i, x in enumerate(out))


def test_settle_is_unbiased():
    hits = np.zeros(5)
    for s in range(4000):
        out, open_ = pivotal_mix.settle(np.array([3.0, 5, 2, 9, 4]), np.array([0.2, 0.5, 0.7, 0.4, 0.9]), np.random.default_rng(s).random(5))
        if open_ >= 0:
            out[open_] = float(np.random.default_rng(s + 10**6).random() < out[open_])
        hits += out
    assert np.abs(hits / 4000 - [0.2, 0.5, 0.7, 0.4, 0.9]).max() < 0.04


def test_mix(few, docs, rows, none):
    got = pivotal_mix.mix(few, docs).collect()
    assert len(got) == len(rows[0]) and sorted(map(str, pivotal_mix.mix(few, docs).collect())) == sorted(map(str, got))
    size = {}
    for r in rows[0]:
        size[r[3]] = size.get(r[3], 0) + len(words(r[1]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, total, want, full = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(size.values()), {}, set()
    while True:
        level = (total - sum(2 * size[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] > 2 * size[s]}
        if not more:
            break
        full |= more
    want = {s: 2.0 * size[s] if s in full else level * weight[s] for s in order}
    assert sorted({round(g.target, 6) for g in got}) == sorted({round(x, 6) for x in want.values()})
    assert all(g.taken == g.copies * g.size <= 2 * g.size for g in got)
    taken = {}
    for g in got:
        taken[round(g.target, 6)] = taken.get(round(g.target, 6), 0) + g.taken
    assert all(abs(t - v) <= 3001 for t, v in taken.items())
    mixed = pivotal_mix.mixed_rows(few, docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(g.copies for g in got if g.size)
    assert pivotal_mix.mix(few, none).count() == 0 and pivotal_mix.mixed_rows(few, none).count() == 0


def test_equal_rows_are_units_of_their_own(few):
    data = few.range(9000).select(F.when(F.col("id") < 8990, 1).otherwise(F.col("id")).alias("doc_id"), F.lit(5).cast("long").alias("t"), F.lit("s").alias("source"), F.lit(3).cast("long").alias("size"))
    got = pivotal_mix.numbered(few, data)
    assert got.drop("copy").exceptAll(data).count() == 0 and got.count() == got.select("doc_id", "copy").distinct().count() == 9000
    assert got.agg(F.max("copy")).first()[0] == 8989
    same = data.select("doc_id", F.lit("a b c").alias("text"), "source").unionAll(few.createDataFrame([(7, "x y", "z"), (8, "x", "w")], "doc_id long, text string, source string"))
    mixed = pivotal_mix.mix(few, same).where("source_size = 27000")
    total = mixed.agg(F.sum("taken"), F.first("target"), F.count(F.lit(1))).first()
    assert total[2] == 9000 and abs(total[0] - total[1]) <= 3


# ----------------------------------------------------------- 10: quotations
def test_quotation_links(few):
    data = [
        (1, 0, "user", "How do I  sort a list?\nIt is long."), (1, 1, "assistant", "> how do i sort a list?\n\nUse sorted."), (1, 2, "user", "A new topic."),
        (1, 3, "user", "On Monday X wrote:\n> Use sorted.\n> > How do I sort a list?\nThanks!"), (1, 4, "assistant", "> A new topic.\n> never said\nYes"),
        (2, 0, "user", None), (None, None, "user", "> A new topic."), (1, 3, "user", "On Monday X wrote:\n> Use sorted.\n> > How do I sort a list?\nThanks!"),
    ]
    got = quote_links.conversations(few, few.createDataFrame([(*x, 1) for x in data], "conv_id long, turn long, role string, text string, thread int")).collect()
    one = sorted((g for g in got if g.conv_id == 1), key=lambda g: g.position)
    assert [(g.turn, g.reply_to, g.thread, g.text) for g in one] == [(0, None, 0, "How do I  sort a list?\nIt is long."), (1, 0, 0, "Use sorted."), (3, 1, 0, "Thanks!"), (3, 1, 0, "Thanks!"), (2, None, 2, "A new topic."), (4, 2, 2, "Yes")]
    assert [(g.n_quoted_lines, g.n_linked_lines) for g in one[-1:]] == [(2, 1)]
    assert sorted((g.turn is None, g.text) for g in got if g.conv_id != 1) == [(False, ""), (True, "")]
    assert quote_links.conversations(few, few.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
