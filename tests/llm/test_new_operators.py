"""Hard negatives, filter audit and substring dedup against brute force, with the odd cases."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescube.llm import filter_audit, hard_negatives, sketch as sketches, substring_dedup
from salescube.llm.common import WORD

# ---------------------------------------------------------------- hard negatives

VECTORS = "vec_id long, embedding array<double>, label int, score string, cell int"


def labelled():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 12))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.7 * rng.standard_normal(12)], int(rng.integers(0, 4)))
            for i in range(400)]
    rows += [(400 + i, rows[50][1], i % 3) for i in range(40)]          # copies of an anchor: ties
    rows += [rows[10], rows[10], rows[50], (50, rows[7][1], 1)]         # repeated rows, an id with two contents
    n = 500
    rows += [(n, None, 1), (n + 50, [None] + [1.0] * 11, 1), (n + 100, [float("nan")] + [1.0] * 11, 1),
             (n + 150, [float("inf")] + [1.0] * 11, 1), (n + 200, rows[0][1], None), (None, rows[0][1], 1),
             (n + 250, [], 1), (n + 300, [1.0, 2.0], 1), (n + 301, [1.0, 2.5], 1), (n + 302, [1.0, 1.0], 2),
             (n + 350, [0.0] * 12, 1), (n + 351, [-0.0] * 12, 2),
             (n + 400, [1e12, -3.0] + [0.5] * 10, 1), (n + 401, [2e12, 7.0] + [0.25] * 10, 1),
             (n + 402, [1.1e12, 2.0] + [0.125] * 10, 2)]
    return rows


def mined(rows, every=50, positives=5, negatives=3, low=50, high=95):
    whole = {(i, y, tuple(int(np.floor(256 * x)) for x in v)) for i, v, y in rows
             if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    big = (1 << 63) - 1
    out = []
    for i, y, a in whole:
        if i % every:
            continue
        scored = [(-max(-big, min(big, sum(p * q for p, q in zip(a, b)))), j, z) for j, z, b in whole
                  if j != i and len(a) == len(b)]
        scored.sort()
        for s, p, _ in [r for r in scored if r[2] == y][:positives]:
            hard = [r for r in scored if r[2] != y and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(i, p, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(hard)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                              "negative_score").collect())


@pytest.mark.parametrize("cell, growth, sample", [(200, 16, 16_384), (5, 2, 16)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, cell, growth, sample):
    """Also with small cells and many rounds, where searches end by their certificate."""
    for name, value in (("CELL", cell), ("GROWTH", growth), ("SAMPLE", sample), ("SHARD", 3 * cell)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = [(*r, "x", 1) for r in labelled()]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert got(hard_negatives.mine(df)) == mined(labelled())


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1, "x", 1)], VECTORS)
    assert hard_negatives.mine(one).count() == 0


def test_cells_come_by_falling_bounds_that_hold():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.standard_normal((300, 10)))
    words = (x[:7, :5], x[7:14, 5:])
    near = [hard_negatives.nearest_word(h, w) for h, w in zip((x[:, :5], x[:, 5:]), words)]
    far = [np.sqrt(((h - w[c]) ** 2).sum(axis=1)) for h, w, c in zip((x[:, :5], x[:, 5:]), words, near)]
    radii = tuple(np.array([f[c == k].max(initial=0) for k in range(7)]) for f, c in zip(far, near))
    cell = near[0] * 7 + near[1]
    sizes = np.bincount(cell, minlength=49)
    index = hard_negatives.Index(1.0, words, radii, sizes, np.zeros(49, int))
    for q in x[:20]:
        visits = list(index.visit(q))
        assert sorted(c for *_, c in visits) == np.flatnonzero(sizes).tolist()
        assert all(a[0] >= b[0] - 1e-6 for a, b in zip(visits, visits[1:]))
        for bound, least, c in visits:
            scores = x[cell == c] @ q
            assert least <= scores.min() and scores.max() <= bound


def test_whole_products_are_exact_beyond_double_precision():
    q = np.array([[2.0 ** 40, 3.0], [1.0, 1.0], [2.0 ** 70, 1.0]])
    x = np.array([[2.0 ** 20, 1.0], [2.0 ** 13, 7.0]])
    want = [[min((1 << 63) - 1, sum(int(a) * int(b) for a, b in zip(r, s))) for s in x] for r in q]
    assert hard_negatives.whole_products(q, x).tolist() == want


# ------------------------------------------------------------------ filter audit

DOCS = "doc_id long, text string, lang string, mask int, h1 string"


def audited():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(90)]
    texts = []
    for i in range(60):
        words = [rng.choice(vocabulary[:rng.choice([20, 90])]) for _ in range(rng.choice([20, 99, 100, 130]))]
        if i % 3 == 0:
            words = [w.upper() * 3 for w in words]
        texts.append(" ".join(words) + rng.choice(["", " #", " & x", "\x0b\x0c"]))
    texts += texts[:15] + [texts[0]] * 20
    texts += [None, "", "", "   ", "é " * 120, "word " * 30_000, "A" * 10 + "b" * 90, "A" * 11 + "b" * 89]
    rows = [(i, t, ["en", "fr", None, ""][i % 4]) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [rows[0], (rows[1][0], "another text", "en"), (None, texts[0], "en"), (None, texts[0], None)]


LABELS = [(i, 1 if i % 3 else 0, 1 if i % 5 == 0 else None) for i in range(0, 90, 2)] + [
    (4, 0, 1), (4, 1, 0), (None, 1, 1), (999, 1, 1)]


def brute_audit(rows, labels):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    good, toxic = ({i for i, *y in labels if i is not None and y[k] == 1} for k in (0, 1))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(WORD, t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and least[t] < i}
        docs.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = set()
            for step, f in enumerate(order, 1):
                here = [k for k, d in enumerate(mine) if f in d[1] and k not in gone]
                out[part, order, step] = [
                    0, len(here), sum(f in d[1] for d in mine) - len(here), sum(d[1] == {f} for d in mine),
                    sum(mine[k][2] for k in here), sum(mine[k][3] for k in here), f]
                gone.update(here)
                out[part, order, step][0] = len(mine) - len(gone)
                shapley[f] += len(here)
        for key in out:
            if key[0] == part:
                out[key][6] = shapley[out[key][6]]
    return out


@pytest.mark.parametrize("sketch", [None, 1])
def test_audit_equals_applying_every_order(spark, monkeypatch, sketch):
    """Also with a sketch so small that it clears nothing."""
    options = {}
    if sketch:
        monkeypatch.setattr(sketches, "CHUNK", 16)
        options["max_sketch_bytes"] = sketch
    docs = spark.createDataFrame([(*r, 7, "x") for r in audited()], DOCS).repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(docs, labels, **options).collect()
    assert len(rows) == 3 * 600
    assert {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                               r.toxic_lost, r.shapley] for r in rows} == brute_audit(audited(), LABELS)


def test_audit_of_empty_tables(spark):
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], DOCS), nothing).count() == 0
    one = filter_audit.audit(spark.createDataFrame([(1, None, None, 1, "")], DOCS), nothing).collect()
    assert len(one) == 600 and all(r.kept + r.removed + r.redundant in (0, 1) for r in one)


def test_sketch_never_clears_a_repeat_and_clears_most_others(spark):
    rows = spark.range(4000).select("id", F.xxhash64(F.expr("id % 3900")).alias("h1"),
                                    F.xxhash64(F.lit(1), F.expr("id % 3900")).alias("h2"))
    sketch = sketches.merged_sketch(rows.repartition(7), sketches.counters_for(4000, 1 << 20))
    possible = {r.id for r in sketches.possible_repeats(rows, sketch).where("possible").collect()}
    repeats = set(range(100)) | set(range(3900, 4000))
    assert repeats <= possible and len(possible - repeats) < 100


# --------------------------------------------------------------- substring dedup

TEXTS = "doc_id long, text string, n_words string, places int"


def passages(window):
    rng = random.Random(9)

    def fresh(n):
        return [f"x{rng.randint(0, 10 ** 9)}" for _ in range(n)]

    a, b, c = fresh(3 * window), fresh(window), fresh(5 * window)
    near = list(c)
    for i in range(0, len(near), window + window // 2):
        near[i] = "edited"
    docs = [fresh(window) + a + fresh(9), b, fresh(3) + b + fresh(4), b[1:], a[window // 2:] + b, c, near, c, c + c,
            fresh(20) + c[7:window + 6], fresh(20) + c[7:window + 7], c[:window + 3] + a[:window + 2], ["w"] * (4 * window),
            ["w"] * (3 * window), ["w", "v"] * (2 * window), fresh(2) + ["v", "w"] * window, c[window:] + c[:window],
            [*a, *fresh(1), *a], [*a[3:], *fresh(1), *a[:-2]], fresh(2000)]
    texts = [" ".join(d) for d in docs]
    texts += [texts[2].replace(" ", "\t\n"), texts[5].upper(), None, "", " \x0b ", " ".join(docs[0]), "one"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, texts[j]) for i, j in enumerate(order)]
    return rows + [rows[0], (rows[1][0], texts[0]), (rows[2][0], texts[8] + " more"), (None, texts[0]), (None, texts[5])]


def brute_substrings(rows, window):
    words = [re.findall(WORD, t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for p in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[p:p + window])
                least[k] = min(least.get(k, i), i)
    out = []
    for (i, t), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and least[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        kept = None if t is None else " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((-1 if i is None else i, len(w), len(gone), kept or "", t is None))
    return sorted(out)


@pytest.mark.parametrize("window", [50, 7, 1])
def test_substrings_equal_brute_force(spark, window):
    rows = passages(max(window, 5))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TEXTS).repartition(3)
    out = substring_dedup.dedup_substrings(df, window=window).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.text or "", r.text is None)
                  for r in out) == brute_substrings(rows, window)
    assert all(sum(s.end - s.begin for s in r.removed) == r.n_removed and r.places == 1 for r in out)


def test_substring_digest(spark):
    rows = passages(50)
    out = substring_dedup.substring_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == sorted(
        (i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k, _ in brute_substrings(rows, 50))


def test_substrings_of_nothing(spark):
    assert substring_dedup.dedup_substrings(spark.createDataFrame([], TEXTS)).count() == 0


def test_colliding_hashes_are_found_out_and_another_seed_is_taken(spark, monkeypatch):
    rng = random.Random(2)
    docs = [(i, " ".join(f"y{rng.randint(0, 10 ** 9)}" for _ in range(80))) for i in range(4)]
    docs.append((9, docs[0][1] + " " + docs[1][1]))
    places, seeds = substring_dedup.repeated_spans, []

    def one_wrong(rows, window, seed):
        seeds.append(seed)
        found = places(rows, window, seed)
        return found if seed else found.withColumn("src_doc", F.lit(2)).withColumn(
            "src_t", F.lit(rows.where("doc_id = 2").first()["t"]))

    monkeypatch.setattr(substring_dedup, "repeated_spans", one_wrong)
    out = substring_dedup.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert seeds == [0, 1] and {r.doc_id: r.n_removed for r in out} == {0: 0, 1: 0, 2: 0, 3: 0, 9: 160}


def test_paths_are_compacted_to_their_heads(spark):
    """A copied text is one path, whatever its length."""
    rng = random.Random(6)
    long = " ".join(f"z{rng.randint(0, 10 ** 9)}" for _ in range(4000))
    docs = spark.createDataFrame([(1, long), (2, "a " + long), (3, long + " b")], "doc_id long, text string")
    spans = substring_dedup.repeated_spans(substring_dedup._rows(docs, "doc_id", "text"), 50, 0)
    assert spans.where("windows > 3000").count() == 2 and spans.count() < 100
