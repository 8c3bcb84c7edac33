"""Operators over a whole corpus: near copies, repeats, toxicity, neighbours, pages, the pipeline."""

import hashlib
import random
import struct
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from fixtures import SCHEMA, documents, frame, prose
from pyspark.sql import functions as F

from conduit.llm import neighbours, queries, recompress, simhash, sitetree, toxicity
from conduit.llm.components import components


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest member of every print's group, by comparing all pairs."""
    own = {p: p for p in prints}

    def root(p):
        while own[p] != p:
            p = own[p]
        return p

    listed = sorted(own)
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                x, y = root(a), root(b)
                own[max(x, y)] = min(x, y)
    return {p: root(p) for p in own}


def test_near_copies_equal_brute_force(spark):
    rows = simhash.near_copies(frame(spark)).collect()
    docs = [(d, plain_print(t)) for d, t, *_ in documents()]
    group = plain_components([p for _, p in docs])
    least = {}
    for d, p in docs:
        if d is not None:
            least[group[p]] = min(d, least.get(group[p], d))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == Counter(
        (d, f"{p:016x}", least.get(group[p])) for d, p in docs
    )
    kept = simhash.without_near_copies(frame(spark))
    assert kept.schema == frame(spark).schema
    assert {r.doc_id for r in kept.collect()} == set(least.values())
    assert simhash.near_copies(frame(spark, [])).count() == 0


@pytest.mark.parametrize("block", [2048, 16])
def test_links_join_all_within_three_bits(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "CELL_BLOCK", block)
    draw = random.Random(8)
    prints = set()
    for _ in range(60):
        seed = draw.getrandbits(64)
        prints.add(seed)
        for _ in range(draw.choice([0, 1, 30])):
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                seed ^= 1 << bit
            prints.add(seed)
    signed = [struct.unpack("<q", struct.pack("<Q", p))[0] for p in prints]
    frame_ = spark.createDataFrame([(p,) for p in signed], "print long")
    found = {r.node: r.root for r in components(simhash.links(frame_)).collect()}
    got = {}
    for p, s in zip(prints, signed):
        got.setdefault(found.get(s, s), set()).add(p)
    want = {}
    for p, r in plain_components(prints).items():
        want.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    out = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert out == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def plain_repeats(docs):
    """n_removed and kept words of each row, from a dictionary of all windows."""
    words = [(d, (t or "").encode().split()) for d, t in docs]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - 12):
                g = tuple(w[i : i + 13])
                first[g] = min(d, first.get(g, d))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        if d is not None:
            for i in range(len(w) - 12):
                if first[tuple(w[i : i + 13])] < d:
                    gone[i : i + 13] = [True] * 13
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def repeat_cases():
    draw = random.Random(3)
    shared = [prose(900 + k, draw.randint(13, 40)) for k in range(6)]
    docs = [(d, t) for d, t, *_ in documents()]
    for k in range(60):
        parts = []
        for _ in range(draw.randint(1, 5)):
            parts.append(draw.choice(shared) if draw.random() < 0.5 else prose(draw.randint(0, 10**6), draw.randint(1, 30)))
        docs.append((1000 + k, draw.choice([" ", "\n", "\t "]).join(parts)))
    docs += [(2000 + k, " ".join(draw.choice("ab") for _ in range(60))) for k in range(12)]  # runs and few words
    docs += [(2100, "a " * 40), (2101, "a " * 13), (2102, "b " + "a " * 12), (1003, shared[0])]
    return docs


@pytest.mark.parametrize("step", [1 << 20, 400])
def test_repeats_equal_brute_force(spark, monkeypatch, step):
    monkeypatch.setattr(recompress.steps, "__defaults__", (step,))
    docs = repeat_cases()
    rows = [(d, t, None, None, None) for d, t in docs]
    got = recompress.without_repeats(frame(spark, rows, 5)).collect()
    assert Counter(map(tuple, got)) == Counter(plain_repeats(docs))


def test_cut_texts_hold_the_kept_words(spark):
    docs = repeat_cases()
    rows = [(d, t, None, None, None) for d, t in docs]
    out = recompress.without_repeated_passages(frame(spark, rows, 5))
    assert out.columns == frame(spark).columns
    want = Counter()
    for (d, text), (_, n, gone, sha) in zip(docs, plain_repeats(docs)):
        if not n or gone < n:
            want[d, sha] += 1
    assert Counter((r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in out.collect()) == want
    assert recompress.without_repeats(frame(spark, [])).count() == 0
    assert recompress.without_repeated_passages(frame(spark, [])).count() == 0


def labelled(n=240):
    draw = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(i, draw.randint(20, 200)).split()
        if toxic:
            for _ in range(4):
                words.insert(draw.randrange(len(words)), draw.choice(["vileword", "snarlug" + draw.choice("abcdef"), "grobnik"]))
        docs.append((i, " ".join(words)))
        labels.append((i, None, int(toxic)))
    return docs, labels


def test_toxicity(spark):
    docs, labels = labelled()
    frame_ = spark.createDataFrame(docs + [(None, "grobnik vileword"), (9001, None), (9002, "")], "doc_id long, text string")
    labels_ = spark.createDataFrame([*labels, (9001, 1, None), (None, 1, 1), (9005, 0, 7)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(frame_.withColumn("score", F.lit("x")), labels_).collect()
    assert len(out) == len(docs) + 3
    truth = {i: t for i, _, t in labels}
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    seen = [r for r in out if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in seen) >= 0.95 * len(seen)
    kept = toxicity.without_toxic(frame_, labels_)
    assert kept.count() == sum(r.predicted == 0 for r in out)
    assert toxicity.toxicity(frame(spark, []), labels_).count() == 0
    none = toxicity.toxicity(frame(spark), labels_.where("false")).collect()
    assert len(none) == len(documents()) and all(r.predicted == 0 for r in none)


def test_gradients_of_the_network():
    network = toxicity.Network()
    draw = np.random.default_rng(1)
    rows = draw.normal(0, 1, (9, toxicity._INPUTS)).astype(np.float32)
    at = draw.integers(0, 9, (3, toxicity.WINDOW))
    at[1, 20:] = -1
    label, weight = np.array([1, 0, 1], np.float32), np.ones(3)

    def loss():
        logit = network.forward(network.project(rows), at).astype(np.float64)
        return float(np.mean(np.logaddexp(0, logit) - label * logit))

    before = {k: x.copy() for k, x in network.w.items()}
    network.train(rows, at, label, weight)
    moved = {k: network.moments[k][0] / 0.1 for k in before}  # the first moment after one step
    network.w = before
    for name in before:
        flat, grad = before[name].reshape(-1), moved[name].reshape(-1)
        for i in draw.integers(0, len(flat), 3):
            kept = flat[i]
            flat[i] = kept + 1e-2
            up = loss()
            flat[i] = kept - 1e-2
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 2e-2 - grad[i]) < 2e-3, name


def vectors():
    draw = np.random.default_rng(5)
    points = draw.normal(0, 1, (700, 12))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(1000 + i, rows[5][1]) for i in range(300)]  # one vector many times
    rows += [(5000, None), (5001, [0.0] * 12), (5002, [float("nan")] * 12), (5003, [None] + [1.0] * 11), (5004, [1.0]), (None, rows[0][1])]
    rows += [(5100, [float("inf")] * 12), (3, rows[3][1])]
    return rows


def test_neighbours(spark):
    rows = vectors()
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).repartition(4)
    out = neighbours.nearest(frame_, F.col("vec_id") % 100 == 0).collect()
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == 12 and None not in v and np.isfinite(v).all() and any(v)}
    ids = np.array([i for i, _ in good])
    points = np.array([v for _, v in good])
    by, hits = {}, []
    for r in out:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {i for i in ids.tolist() if i % 100 == 0}
    for i, found in by.items():
        apart = np.sqrt(((points - points[ids == i][0]) ** 2).sum(1))
        order = [k for k in np.lexsort((ids, apart)) if ids[k] != i][:10]
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        for r in found:
            assert abs(r.score - apart[ids == r.vec_id].min()) < 1e-12
        hits.append(len({r.vec_id for r in found} & set(ids[order].tolist())) / 10)
    assert np.mean(hits) >= 0.9
    few = neighbours.nearest(frame_.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0)
    assert few.count() == 2
    assert neighbours.nearest(frame_.where("false"), F.lit(True)).count() == 0


def page(i, article, promo="Buy now and save, only today."):
    return (
        i,
        f"http://site.example/{i}",
        f"<html><head><title>t</title></head><body><nav><a href=/>Home</a></nav><div class=box>{promo}</div>"
        f"<div class=post><h1>Title {i}</h1><p>{article}<p>More &amp; <b>mo</b>re<br>here</p>"
        f"<div id=comments><p>First!</p></div></div><footer>&copy; x</footer><script>var a='</p>';</script></body></html>",
    )


def test_main_text(spark):
    rows = [page(i, prose(i, 30)) for i in range(12)] + [(90, None, None), (91, "x", ""), (92, "http://b.example/", "<p>alone")]
    rows.append(rows[0])
    frame_ = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    out = sitetree.main_text(frame_).collect()
    assert len(out) == len(rows)
    by = {r.page_id: r for r in out}
    for i in range(12):
        assert by[i].text == f"Title {i}\n{prose(i, 30)}\nMore & more here"
        assert by[i].n_chars == len(by[i].text)
    assert (by[90].text, by[91].text, by[92].text) == ("", "", "alone")
    low = sitetree.importance(frame_).where("importance < 0.2")
    assert low.count() >= 1  # the box that all pages share, and the menu
    assert sitetree.main_text(frame_.where("false")).count() == 0


@pytest.mark.parametrize("source", ["<", "<a" * 20000, "<b>" * 30000, "<p " + "'" * 20000, "</p>" * 20000, "<div>" * 20000 + "x", "<!" * 20000])
def test_broken_pages_take_linear_time(source):
    assert isinstance(sitetree.Page(source).text(), str)


def test_queries_cover_all_numbers():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark, folder, tmp_path):
    docs = spark.createDataFrame(documents(), SCHEMA)
    extra = docs.withColumnRenamed("score", "component_id").withColumn("tag", F.lit(3))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near copies", "repeated passages", "personal data", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, folder)
        assert out.columns == extra.columns, name
        rows = out.collect()
        assert {r.doc_id for r in rows} <= {d for d, *_ in documents()}
        assert all(r.n_chars == len(r.text or "") for r in rows if r.n_chars is not None)
        empty = stage(spark, extra.where("false"), folder)
        assert empty.columns == extra.columns and empty.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, extra, folder).count() >= len(documents())


def test_pipeline_equals_its_parts(spark, folder):
    """The pipeline's pieces are those of the documents that plain versions of all stages keep."""
    out = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    bad = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    kept = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in bad]
    prints = {d: plain_print(t) for d, t in kept}
    group = plain_components(prints.values())
    least = {}
    for d, p in prints.items():
        least[group[p]] = min(d, least.get(group[p], d))
    kept = [(d, t) for d, t in kept if least[group[prints[d]]] == d]
    left = {d for (d, n, gone, _) in plain_repeats(kept) if not n or gone < n}
    assert {r.doc_id for r in out} == left
    assert len({(r.doc_id, r.start) for r in out}) == len(out)
