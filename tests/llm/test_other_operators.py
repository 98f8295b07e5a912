"""Vectors, urls, conversations, archives, components and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescube.llm import ann, chat_format, embedding_dedup, url_filter, warc
from salescube.llm.common import LOWER, UPPER, prefix_sums, scratch_path
from salescube.llm.components import connected_components

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors():
    rng = np.random.default_rng(8)
    base = rng.standard_normal((60, 16))
    rows = [*base, *(base[:20] + 0.08 * rng.standard_normal((20, 16))), *base[:5], *(3 * base[5:8])]
    rows += [base[0] + 0.02 * rng.standard_normal(16) for _ in range(25)]
    out = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(rows)]
    n = len(out)
    out += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] + [1.0] * 15, 0),
            (n + 3, [None] + [1.0] * 15, 0), (n + 4, [float("inf")] + [1.0] * 15, 0), (n + 5, [], 0),
            (n + 6, [1.0, 2.0], 0), (n + 7, [2.0, 4.0], 0), (None, [1.0] * 16, 0)]
    return out


def good(v):
    return v and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_embedding_links_equal_all_pairs(spark):
    rows = vectors()
    real = [(i, np.array(v, float)) for i, v, _ in rows if good(v) and i is not None]
    links, low = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}
    pairs = [(i, j) for i, a in real for j, b in real
             if i != j and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95]
    for i, _ in pairs:
        links[i] += 1
    for _ in rows:
        for i, j in pairs:
            low[i] = min(low[i], low[j])
    df = spark.createDataFrame(rows, VECTORS).withColumn("links", F.lit(1))
    got = embedding_dedup.dedup_embeddings(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (links[i], low[i]) for i in links}
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got) and len(got) == len(rows)
    assert embedding_dedup.dedup_embeddings(spark.createDataFrame([], VECTORS)).count() == 0


def test_blocks_of_a_cell_count_each_link_once(spark):
    rows = [(i, v, 0) for i, v, _ in vectors() if good(v) and i is not None and len(v) == 16]
    classes = spark.createDataFrame([(i, 1, v) for i, v, _ in rows], "class_id long, copies long, vec array<double>")
    plan = embedding_dedup.calibrate(20_000, cell=64)
    whole = embedding_dedup.link_classes(classes, plan, block=10_000)
    cut = embedding_dedup.link_classes(classes, plan, block=7)
    total = [sorted((r.class_id, r.n) for r in x.groupBy("class_id").agg(F.sum("links").alias("n")).collect())
             for x in (whole, cut)]
    assert total[0] == total[1] and total[0]


def test_window_collisions_equal_plain_comparison():
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((30, 5)), rng.standard_normal((40, 5))
    want = (np.abs(a[:, None, :] - b[None, :, :]) <= 0.4).sum(axis=2)
    assert (embedding_dedup.collisions(a, b, 0.4) == want).all()


def test_nearest_is_exact_on_one_leaf_and_recalls_on_many(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).withColumn("rank", F.lit(1))
    got = ann.nearest(df, k=5, every=10).collect()
    real = {i: np.array(v, float) for i, v, _ in rows if good(v) and i is not None}
    want = []
    for q in sorted(i for i in real if i % 10 == 0):
        near = sorted((-(real[q] @ v), i) for i, v in real.items() if i != q and len(v) == len(real[q]))[:5]
        want += [(q, k + 1, i) for k, (_, i) in enumerate(near)]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == want
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 12)) * rng.uniform(0.5, 2, (3000, 1))
    many = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    hits = ann.nearest(many, k=10, every=100).collect()
    found = {}
    for r in hits:
        found.setdefault(r.query_id, set()).add(r.vec_id)
        assert r.score == pytest.approx(x[r.query_id] @ x[r.vec_id], abs=1e-12)
    recall = []
    for q, ids in found.items():
        s = x @ x[q]
        s[q] = -np.inf
        recall.append(len(ids & set(np.argsort(-s)[:10].tolist())) / 10)
    assert len(recall) == 30 and np.mean(recall) >= 0.9
    assert ann.nearest(spark.createDataFrame([], VECTORS)).count() == 0


def test_repeated_rows_hide_no_copies(spark):
    """Each row of a hot vector twice, and one id of it many times."""
    rng = np.random.default_rng(3)
    x = {i: rng.standard_normal(8) for i in range(60)}
    for i in range(40):
        x[i] = 4 * np.ones(8)
    rows = [(i, v.tolist()) for i, v in x.items()] * 2 + [(0, x[0].tolist())] * 30
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, k=20, every=10, target=1.0).collect()
    want = []
    for q in range(0, 60, 10):
        near = sorted((-(x[q] @ v), i) for i, v in x.items() if i != q)[:20]
        want += [(q, k + 1, i) for k, (_, i) in enumerate(near)]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == want


URLS = ["http://example.org/es/1", "https://www.Example.ORG/en/12?x=1", "http://example.org/en/2", "http://a.b.com/fr/x#y",
        "http://com/de/", "http://notcom/de/", "http://example.organic/es/", None, "", "no scheme", "http://", "://x.org",
        "http://x.org", "http://x.org?q", "http://u@x.com:80/fr/", "http://a://b.org/", "http://x.org/\n/es", "x://é.org/ü"]


def judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    host = host.translate(str.maketrans(UPPER, LOWER))
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, default)))


def test_urls_equal_plain_matching(spark):
    rng = random.Random(6)
    hosts = ["org", "a.org", "b.a.org", "com", "x.com", "", "a"]
    rules = {(rng.choice(hosts), "/" + "/".join(rng.choices("abc", k=rng.randint(0, 3)))): None for _ in range(25)}
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    urls = [f"http://{rng.choice(hosts + ['q.b.a.org', 'z.x.com'])}/{'/'.join(rng.choices('abc', k=4))}" for _ in range(200)]
    for some, given in ((URLS + URLS[:3], url_filter.RULES), (urls + urls[:50], rules)):
        pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(some)], "page_id long, url string, host string")
        got = url_filter.filter_urls(pages, spark.createDataFrame(given, url_filter.RULE_SCHEMA)).collect()
        assert {r.page_id: tuple(r)[1:] for r in got} == {i: judge(u, given) for i, u in enumerate(some)}
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(none, url_filter.production_rules(spark)).count() == 0


def test_no_rules_give_the_default(spark):
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    row = url_filter.filter_urls(pages, spark.createDataFrame([], url_filter.RULE_SCHEMA), default="block").first()
    assert (row.rule, row.verdict) == (None, "block")


def conversations():
    rng = random.Random(9)
    odd = ["</s>", "[INST]", "\\", "<\\s>", "<<SYS>>", "é", " ", "\n", "word", "[TURN]", "[ROLE]", "<s", ">", "\\\\["]
    rows = []
    for c in range(12):
        for t in range(rng.randint(1, 14)):
            role = "system" if t == 0 and c % 2 else ("user", "assistant")[t % 2]
            rows.append((c, t, role, "".join(rng.choice(odd) for _ in range(rng.randint(0, 40)))))
    rows += [(50, 0, None, None), (50, 0, None, None), (50, None, "assistant", ""), (51, 1, "tool [ROLE]", "x"),
             (51, 1, "assistant", "y"), (51, 1, "assistant", "y"), (None, 0, "assistant", "z"), (52, 0, "assistant", "long " * 3000)]
    return rows


def test_conversations_read_back(spark):
    df = chat_format.with_forged(spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
                                 .withColumn("window", F.lit(1)))
    got = {r.conv_id: r for r in chat_format.conversation_digest(df).collect()}
    rows = conversations() + [(-7, 0, "user", chat_format.FORGED), (-7, 1, "assistant", chat_format.FORGED)]
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        every = "".join(f"{role}\n{x}\n" for _, role, x in turns)
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.conversation_digest(empty).count() == 0


def test_windows_keep_the_system_turn_and_mask_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, ("user", "assistant")[(t + 1) % 2], f"turn {t} " + "w " * 8) for t in range(1, 21)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = sorted(chat_format.format_conversations(df, budget=40, history=15).collect(), key=lambda r: r.window)
    assert len(windows) > 3 and windows[0].repeated == 0
    targets = []
    for w in windows:
        turns = list(chat_format.parse_turns(w.text))
        assert turns[0][0] == "system" and [t[0] for t in turns].count("system") == 1
        targets += [w.text[t.start:t.end] for t in w.targets]
    assert all(w.repeated >= 2 for w in windows[1:])
    assert targets == [x for _, _, role, x in rows if role == "assistant"]


def test_escape_is_reversible_and_hides_marks():
    rng = random.Random(0)
    for _ in range(2000):
        text = "".join(rng.choice(chat_format.CONTROL + ["\\", "<", "[", "/", "s", ">", "]"]) for _ in range(rng.randint(0, 8)))
        hidden = chat_format.escape(text)
        assert chat_format.unescape(hidden) == text
        assert not any(mark in hidden for mark in chat_format.CONTROL)


def pages():
    long = "x" * 150
    return [(5, "http://a/\r\nWARC-Type: no", long), (3, "http://b/", long), (9, "http://c/é", long), (4, None, "short"), (6, "u", "short"),
            (7, "u", None), (8, "u", ""), (None, "u", long), (10, "u", "WARC/1.1\r\n\r\n" * 20), (11, "u", "é" * 400_000), (12, "u", "é" * 400_000),
            (3, "http://b/", long), (13, "u", "a" * 99), (14, "u", "a" * 99), (15, "u", "b" * 100), (16, "u", "b" * 100)]


def test_archives_round_trip(spark):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").withColumn("bundle", F.lit("z"))
    folder = scratch_path(spark, "warc-test")
    index = warc.write_bundles(df, folder, frame_bytes=1000, bundle_bytes=3000)
    got = warc.read_bundles(index, folder).collect()
    first = {}
    for i, _, html in pages():
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    want = []
    for i, _, html in pages():
        data = (html or "").encode()
        refers = first.get(html) if i is not None and first.get(html, i) < i else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    assert sorted(map(str, [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got])) == sorted(map(str, want))
    assert all(bytes(r.payload) == (dict((p[0], p[2]) for p in pages())[r.page_id] or "").encode() for r in got if r.record_type == "response")
    some = warc.read_pages(index, folder, spark.createDataFrame([(10,), (11,)], "page_id long")).collect()
    assert sorted(r.page_id for r in some) == [10, 11]
    assert warc.warc_round_trip(df.limit(0)).count() == 0


def test_payloads_of_a_repeated_page_id_are_told_apart(spark):
    a, b, c = "a" * 150, "b" * 150, "c" * 150
    rows = [(3, "u", a), (5, "u", a), (5, "u", b), (4, "u", c), (7, "u", a), (7, "u", c), (7, "u", c)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    index = warc.write_bundles(df, folder)
    got = [(r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_bundles(index, folder).collect()]
    refers = [None, 3, None, None, 3, 4, 4]
    want = [(i, hashlib.sha256(h.encode()).hexdigest(), "revisit" if f else "response", f)
            for (i, _, h), f in zip(rows, refers)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    some = warc.read_pages(index, folder, spark.createDataFrame([(5,)], "page_id long")).collect()
    assert [bytes(r.payload).decode() for r in some if r.record_type == "response"] == [b] and len(some) == 2


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(200, 200), (None, 3)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(8, 60)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_sums_over_ranges(spark):
    rng = random.Random(4)
    rows = [(None if i % 7 == 0 else "hot", i, rng.randint(0, 9)) for i in range(500)]
    got = prefix_sums(spark.createDataFrame(rows, "g string, k long, v long"), ["g"], ["k"], "v", "t").collect()
    for r in got:
        assert r.before == sum(v for g, k, v in rows if g == r.g and k < r.k)


def test_inner_products_that_overflow_count(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(10)]
    rows += [(10, [1e200, 1e200, 1.0, 0.0]), (20, [2e200, -1e200, 0.0, 1.0]), (21, [-1e200, 1e200, 0.0, 0.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, every=10).collect()
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    for query in (0, 10, 20):
        scores = ann.inner(x[ids == query], x)[0]
        want = sorted((-s, i) for s, i in zip(scores, ids) if i != query)[:3]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == query)
        assert [i for _, i, _ in mine] == [i for _, i in want]
        assert np.allclose([s for *_, s in mine], [-s for s, _ in want], rtol=1e-12)
    assert ann.inner(x[10:11], x[11:12])[0, 0] == np.inf and ann.inner(x[11:12], x[12:13])[0, 0] == -np.inf


def test_later_rounds_return_only_what_reaches_the_floor(spark, monkeypatch):
    """Small rounds and a small sample give the same neighbours as one search of everything."""
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(6)]) for i in range(600)],
                               "vec_id long, embedding array<double>")
    def found():
        return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in ann.nearest(df, k=5, every=50, target=1.0).collect())

    whole = found()
    for name, value in (("LEAF", 16), ("SAMPLE", 40), ("GROWTH", 2), ("SHARD", 64), ("QUERY_BLOCK", 4)):
        monkeypatch.setattr(ann, name, value)
    monkeypatch.setattr(ann, "calibrate", lambda *a: float("inf"))
    assert found() == whole
