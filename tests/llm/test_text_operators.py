"""Text operators against brute force, with nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescube.llm import bpe, language_id, line_dedup, minhash_dedup, mixing
from salescube.llm.common import LOWER, SPACES, UPPER, WORD

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ASCII = str.maketrans(UPPER, LOWER)


def words(rng, n):
    return [rng.choice("alpha beta gamma delta eta theta iota kappa lambda mu nu xi rho sigma tau".split())
            + str(rng.randint(0, 40)) for _ in range(n)]


def corpus():
    """Copies, near copies of several degrees, repeated lines, and the odd cases."""
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = words(rng, rng.randint(20, 120))
        texts.append(" ".join(base))
        for edits in (1, 2, 3, 5, 9):
            other = list(base)
            for _ in range(edits):
                other[rng.randrange(len(other))] = "new" + str(rng.randint(0, 9999))
            texts.append(" ".join(other))
    texts += [texts[0], texts[0].upper(), texts[0].replace(" ", "\n\t ")]
    line = "this passage of more than forty characters is on many pages"
    texts += [f"{words(rng, 5)}\n  {line.upper()}\t\nend {i}" for i in range(7)]
    texts += [None, "", "   ", "one", "one two", "ONE two", "\n\n", "word " * 20000]
    rows = [(i, t, "en", None if i % 9 == 0 else f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[1], None, "s1", 5)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).withColumn("key", F.lit(1)).withColumn("band", F.lit("x"))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def shingle_set(text, k):
    w = re.findall(WORD, (text or "").translate(ASCII))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("plan", [minhash_dedup.Plan(), minhash_dedup.Plan(5, 80)])
def test_near_duplicates_equal_all_pairs(docs, plan):
    rows = [(i, shingle_set(t, plan.words)) for i, t, *_ in corpus()]
    low = {i: i for i, _ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for i, s in rows:
            for j, u in rows:
                if s and u and None not in (i, j) and 100 * len(s & u) >= plan.percent * len(s | u):
                    m = min(low[i], low[j])
                    changed |= low[i] != m or low[j] != m
                    low[i] = low[j] = m
    got = minhash_dedup.near_duplicates(docs, plan).collect()
    want = sorted((i if i is not None else -1, len(s), low.get(i, -1), i is not None and low[i] == i) for i, s in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles,
                   -1 if r.component_id is None else r.component_id, r.kept and r.doc_id is not None)
                  for r in got) == want


def test_near_duplicates_of_nothing(nothing):
    assert minhash_dedup.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("plan", [minhash_dedup.Plan(), minhash_dedup.Plan(5, 80)])
def test_texts_of_a_repeated_id_are_told_apart(spark, plan):
    rng = random.Random(12)
    t, u, v = (" ".join(words(rng, 80)) for _ in range(3))
    # Near T, unrelated, near V; 5 is the least id of two groups and 7 of none; rows repeat as well.
    rows = [(1, t), (5, t + " x"), (5, u), (5, v), (5, v), (7, u + " y"), (7, v + " z"), (7, t + " w"), (9, v), (7, "alone " + u[::-1])]
    want = [1, 1, 5, 5, 5, 5, 5, 1, 5, 7]
    docs = spark.createDataFrame([(*r, nr) for nr, r in enumerate(rows)], "doc_id long, text string, nr int")
    got = sorted(minhash_dedup.near_duplicates(docs, plan, carry=["nr"]).collect(), key=lambda r: r.nr)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(i, c, i == c) for (i, _), c in zip(rows, want)]


def test_chain_links_within_a_large_group_are_found(spark):
    """Each text is close to the next only, so the group is no star around its smallest id."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(30):
        rows.append((29 - i, " ".join(base)))
        base[4 * i % 120] = f"x{i}"
        base[(4 * i + 1) % 120] = f"y{i}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in minhash_dedup.near_duplicates(df).collect()} == {0}


def test_pruning_bound_is_the_binomial_tail():
    plan = minhash_dedup.Plan()
    assert plan.least_matches() == sorted(plan.least_matches()) and len(plan.least_matches()) == 8
    same = np.arange(128, dtype=np.uint32)[None, :]
    alive, matches = minhash_dedup.survivors(same, np.vstack([same, same + 1000]), np.array([0, 0]), np.array([0, 1]), plan)
    assert alive.tolist() == [0] and matches.tolist() == [128]


def test_line_dedup_equals_plain_python(docs):
    rows = corpus()
    hold = {}
    for at, (i, t, *_) in enumerate(rows):
        for line in (t or "").split("\n"):
            key = line.strip(SPACES).translate(ASCII)
            if len(key) >= 40 and i is not None:
                hold.setdefault(key, []).append((at, i))
    want = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            seen = hold.get(line.strip(SPACES).translate(ASCII), ())
            if i is None or len({a for a, _ in seen}) < 5 or max(d for _, d in seen) == i:
                kept.append(line)
        want.append((-1 if i is None else i, len(lines), len(lines) - len(kept),
                     hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = line_dedup.line_digest(docs).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == sorted(want)
    assert sum(w[2] for w in want) > 0
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns + ["n_lines", "n_dropped"] and out.count() == docs.count()


def test_line_runs_are_compacted_and_agree(spark):
    rng = random.Random(3)
    runs, want = line_dedup.LineRuns(fanout=2), {}
    for batch in range(5):
        rows = [(batch * 10 + d, k, 0) for d in range(3) for k in rng.sample(range(8), 4)]
        for d, k, _ in rows:
            n, last = want.get(k, (0, -1))
            want[k] = n + 1, max(last, d)
        runs.add(spark.createDataFrame(rows, "doc_id long, h1 long, h2 long"))
        assert all(len(level) < 2 for level in runs.levels)
    merged = {r.h1: (r.docs, r.last) for r in runs.merged().collect()}
    assert merged == want


def test_line_dedup_of_nothing(nothing):
    assert line_dedup.line_digest(nothing).count() == 0


def shared_by_weight(sizes, total_share=1.5, weights=(5, 2, 1)):
    """Targets by handing the excess round until none is above twice its size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    left = total_share * sum(sizes.values())
    while left > 1e-9 and len(full) < len(names):
        open_ = [s for s in names if s not in full]
        each = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in open_:
            target[s] += each * weight[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                full.add(s)
    return target


def test_mix_meets_targets(docs):
    got = mixing.mix(docs).collect()
    count = {}
    sizes = {}
    for i, t, _, s, _ in corpus():
        n = len(re.findall(WORD, t or ""))
        sizes[s] = sizes.get(s, 0) + n
    target = shared_by_weight(sizes)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        count[r.source] = count.get(r.source, 0) + r.taken
    assert len(got) == len(corpus())
    for s, n in count.items():
        assert n == int(target[s] + 1e-6)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_mixed_documents_hold_the_taken_words(docs, nothing):
    taken = sum(r.taken for r in mixing.mix(docs).collect())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(re.findall(WORD, r.text)) for r in out.collect()) == taken
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def test_bpe_equals_the_library(library):
    codec = bpe.Codec(bpe.read_vocabulary())
    rng = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "'re", "'S", "the", "ing", "é", "ß", "漢", "😀", "<|endoftext|>",
            "<|", "1", "²", "\x1c", "\x85", "\u3000", "!!", "%%%", "\u0301"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += ["", "a" * 3000, "".join(rng.choice("abcdefgh") for _ in range(5000)), "!" * 300, "\n" * 999,
              "".join(map(chr, range(0x3100)))]
    got = codec.encode_batch(texts)
    for text, ids in zip(texts, got):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False) == text
    broken = [codec.ids[b"\xe6"], codec.ids[b"a"]]
    assert codec.decode(broken) == library.decode(broken, skip_special_tokens=False)


def test_bpe_round_trip_of_a_table(docs, nothing):
    encoded = bpe.encode(docs)
    back = bpe.decode(encoded).select("doc_id", "text")
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()))
    for r in bpe.token_digest(docs).where("doc_id = 3").collect():
        assert r.decoded_sha256 == hashlib.sha256(corpus()[3][1].encode()).hexdigest()
    assert bpe.token_digest(nothing).count() == 0


def test_language_id_on_held_out_rows(spark, nothing):
    rng = random.Random(2)
    stems = {"aa": "ba be bi bo", "bb": "xu xy xo xa", "cc": "çé ñu ßa üm"}
    rows = []
    for i in range(400):
        lang = rng.choice(list(stems))
        text = " ".join("".join(rng.choice(stems[lang].split()) for _ in range(3)) for _ in range(rng.randint(2, 30)))
        rows.append((i, text, lang, "s", 0))
    rows += [(400, None, "aa", "s", 0), (401, "12 -- %%", None, "s", 0), (402, "", "bb", "s", 0), (None, "ba ba", None, None, 0)]
    got = language_id.language_predictions(spark.createDataFrame(rows, DOCS)).collect()
    true = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (400, 401, 402):
            assert r.lang_pred == "und"
        elif r.doc_id is not None and r.held_out:
            assert r.lang_pred == true[r.doc_id]
    assert {r.held_out for r in got} == {True, False}
    assert language_id.language_predictions(nothing).count() == 0
    unlabelled = spark.createDataFrame([(1, "ba", None, None, 0)], DOCS)
    assert language_id.language_predictions(unlabelled).first().lang_pred == "und"


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_of_equal_hash_keep_their_own_ids(spark):
    """Mirrored Thue-Morse words have equal polynomial hashes modulo 2 ** 64 whatever the base."""
    from tokenizers import Tokenizer
    import public_tokenizers
    mirror = str.maketrans("ab", "ba")
    texts = [t for n in (512, 1024, 2048, 4096, 8192) for w in (thue_morse(n),) for t in (w, w.translate(mirror), f"{w} {w.translate(mirror)}")]
    points = np.frombuffer((texts[6] + texts[7]).encode("utf-32-le"), np.uint32)
    assert len(set(bpe.span_hashes(points, np.array([0, 2048])).tolist())) == 1  # or this test shows nothing
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    codec = bpe.Codec(bpe.read_vocabulary())
    assert [x.tolist() for x in codec.encode_batch(texts)] == want
    assert [codec.encode(t) for t in reversed(texts)] == want[::-1]
    got = bpe.token_digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts)}


def test_words_of_equal_hash_and_unequal_length_are_told_apart(monkeypatch):
    monkeypatch.setattr(bpe, "span_hashes", lambda points, starts: np.zeros(len(starts), np.uint64))
    text = "aa b aa ccc b dd"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    starts = bpe.word_starts(points, np.empty(0, np.int64))
    words, which = bpe.distinct_words(text, points, starts)
    assert "".join(words[k] for k in which) == text and len(set(words)) == len(words)


def test_every_label_is_learned(spark):
    """Two hundred and fifty labels, each with letters of its own; columns that clash with those of the model."""
    rows = [(250 * k + i, chr(0x4E00 + 40 * i) * 6 + chr(0x4E01 + 40 * i) * (k + 1), f"l{i:03}", 1, "x")
            for i in range(250) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, share string")
    model = language_id.train(docs, settings=language_id.Settings(sample_rows=5_000, epochs=2))
    assert len(model.languages) == 250
    got = language_id.predict(docs, model).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 950


def test_ftrl_equals_the_plain_update_rule():
    """Coordinate by coordinate, with weights from the leader's closed form."""
    s = language_id.Settings(buckets=6)
    rng = np.random.default_rng(3)
    model = language_id.Ftrl(6, 3, s)
    z, n = [[0.0] * 3 for _ in range(7)], [[0.0] * 3 for _ in range(7)]

    def weight(i, c):
        if abs(z[i][c]) <= s.l1:
            return 0.0
        return -(z[i][c] - np.sign(z[i][c]) * s.l1) / ((s.beta + n[i][c] ** 0.5) / s.alpha + s.l2)

    for _ in range(60):
        at = np.sort(rng.choice(6, 3, replace=False))
        x, label = rng.random(3), int(rng.integers(0, 3))
        model.learn(at, x, label)
        feats = [*zip(at.tolist(), x.tolist()), (6, 1.0)]
        w = {i: [weight(i, c) for c in range(3)] for i, _ in feats}
        e = np.exp([sum(v * w[i][c] for i, v in feats) for c in range(3)])
        for i, v in feats:
            for c in range(3):
                g = v * (e[c] / e.sum() - (c == label))
                z[i][c] += g - ((n[i][c] + g * g) ** 0.5 - n[i][c] ** 0.5) / s.alpha * w[i][c]
                n[i][c] += g * g
    assert np.allclose(model.weights(slice(None)), [[weight(i, c) for c in range(3)] for i in range(7)])


def test_temperature_is_the_best_of_its_grid():
    rng = np.random.default_rng(2)
    logits = 4 * rng.standard_normal((200, 3))
    labels = (logits / 4 + rng.gumbel(size=(200, 3))).argmax(axis=1)  # drawn at temperature 4
    t = language_id.fit_temperature(logits, labels)

    def loss(t):
        e = np.exp(logits / t)
        return -np.log(e[np.arange(200), labels] / e.sum(axis=1)).mean()
    assert loss(t) <= min(loss(t * 1.05), loss(t / 1.05)) + 1e-9


def test_the_anti_join_decides_what_enters_a_run(spark, monkeypatch):
    """A hash is in the run of the batch that saw it first and in the counters after; else the sums are wrong."""
    def lines(*rows):
        return spark.createDataFrame(rows, "doc_id long, h1 long, h2 long")

    batches = [lines((1, 5, 5), (2, 5, 5), (3, 6, 6)), lines((4, 5, 5), (9, 7, 7)), lines((8, 5, 5), (5, 6, 6))]
    runs = line_dedup.LineRuns(fanout=2, buckets=2)
    for b in batches:
        runs.add(b)
    held = [r.h1 for level in runs.levels for run in level for r in run.collect()]
    assert sorted(held) == [5, 6, 7]
    assert sorted((r.h1, r.docs) for c in runs.counters for r in c.collect()) == [(5, 1), (5, 1), (6, 1)]
    assert sorted(map(tuple, runs.merged(2).collect())) == [(5, 5, 4, 8), (6, 6, 2, 5)]
    # Run tables are co-located: neither the anti-join nor the merge of runs shuffles them.
    a, b = (line_dedup._bucketed(x.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
                                 .repartition(2, "h1", "h2"), "t", 2) for x in batches[:2])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (a.join(b, ["h1", "h2"], "left_anti"), line_dedup.LineRuns._compact([a, b])):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Left out, every batch's hashes enter its run: the counts double.
    anti = type(batches[0]).join
    monkeypatch.setattr(type(batches[0]), "join", lambda self, other, on=None, how=None: (
        self if how == "left_anti" else anti(self, other, on, how)))
    wrong = line_dedup.LineRuns(fanout=3, buckets=2)
    for b in batches:
        wrong.add(b)
    assert sorted(map(tuple, wrong.merged(2).collect())) != [(5, 5, 4, 8), (6, 6, 2, 5)]
