"""Importance resampling by lines against features counted document by document."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import harness
import pytest
from fixtures import documents, frame, prose
from pyspark.sql import functions as F

from conduit.llm import blocks, queries, resampling

SHOWN = ("doc_id", "n_features", "weight", "score", "rank")


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain_resampled(docs, target):
    """Rows of (doc_id, n_features, weight, score, rank), from the rules as they are stated."""
    found = [(d, *plain_features(t)) for d, t in docs]
    s, t = (Counter(b for f in side for b in f) for side in ([f for *_, f in found], [plain_features(x)[1] for x in target]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for d, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    free = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = free[: 5 * len(free) // 100]
    out = [(d, n, w, score, None) for d, m, n, w, score in rows if m < 20]
    out += [(d, n, w, score, k if k <= len(drawn) else None) for k, (d, m, n, w, score) in enumerate(free, 1)]
    return Counter(out)


def line_cases():
    draw = random.Random(6)
    lines = [prose(700 + k, draw.choice([0, 1, 1, 2, 3, 20])) for k in range(40)] + ["", " ", "...", "é日 1", "A\tb\x00C", "x_y"]
    docs = [(d, t) for d, t, *_ in documents()]
    docs += [(1000 + k, "\n".join(draw.choice(lines) for _ in range(draw.randint(0, 30)))) for k in range(200)]
    return docs + docs[-5:] + [(None, docs[-9][1]), (5000, "\n" * 300), (5001, "one\n" * 2000), (5002, "\r\n".join(lines))]


@pytest.mark.parametrize("size", [None, 3000])
def test_scores_and_draws_equal_brute_force(spark, monkeypatch, size):
    if size:
        monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    docs = line_cases()
    target = [prose(k, 50) for k in range(5)] + [None, "", docs[30][1]]
    frame_ = frame(spark, [(d, t, "en", 0.5, 1) for d, t in docs], 4).withColumn("rank", F.lit("x")).withColumn("n", F.lit(1))
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    out = resampling.resampled(frame_, wanted)
    assert out.columns == list(SHOWN) and {f.dataType.simpleString() for f in out.schema} == {"bigint"}
    assert Counter(map(tuple, out.collect())) == plain_resampled(docs, target)


def test_empty_tables(spark):
    target = spark.createDataFrame([], "text string")
    assert resampling.resampled(frame(spark, []), target).count() == 0
    docs = [(d, t) for d, t, *_ in documents()]
    assert Counter(map(tuple, resampling.resampled(frame(spark), target).collect())) == plain_resampled(docs, [])
    nulls = frame(spark, [(None, None, None, None, None)] * 2, 2)
    assert Counter(map(tuple, resampling.resampled(nulls, target).collect())) == plain_resampled([(None, None)] * 2, [])


def test_whole_tables(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("text").collect()]
    got = Counter(map(tuple, queries.op12_resampled(spark, folder).collect()))
    assert got == plain_resampled(docs, target)


def test_a_line_is_looked_at_once_in_a_task():
    """Of a line that a task meets often, one text goes out and the rest as a number."""
    import pyarrow as pa

    texts = pa.array(["same line\nother"] * 1000 + ["same line"])
    rows = [r for b in resampling._line_batches([pa.record_batch([texts], ["text"])]) for r in b.to_pylist()]
    assert Counter((r["line"], r["n"]) for r in rows) == Counter([(b"same line", 1), (b"other", 1), (None, 1000), (None, 999)])


def test_equals_its_sql(spark, folder):
    assert harness.differences(queries.op12_resampled(spark, folder), harness.connect(folder), queries.ORACLES["op12_resampled"]) is None
