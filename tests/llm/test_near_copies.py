"""The pipeline's near-copy stage against fingerprints of all texts, compared pair by pair."""

import hashlib
import random

from fixtures import documents, frame, prose
from pyspark.sql import functions as F
from test_corpus import plain_components, plain_print

from conduit.llm import stages


def near_cases():
    """Texts with one to many words changed, in other white space and case, and a large group."""
    draw = random.Random(4)
    texts = [t for _, t, *_ in documents()]
    for k in range(40):
        words = prose(5000 + k, draw.randint(5, 400)).split()
        texts.append(" ".join(words))
        for step in range(draw.choice([1, 2, 6])):
            words = list(words)
            for _ in range(draw.choice([0, 1, 1, 2, 9])):
                words[draw.randrange(len(words))] = f"new{draw.random()}"
            texts.append(" ".join(words).upper() if step == 1 else "\n ".join(words))
    base = prose(77, 600).split()
    for _ in range(60):
        words = list(base)
        words[draw.randrange(len(words))] = f"x{draw.random()}"
        texts.append(" ".join(words))
    draw.shuffle(texts)
    return texts


def test_near_copies_stage_equals_all_pairs(spark):
    texts = near_cases()
    prints = [plain_print(t) for t in texts]
    group, least = plain_components(prints), {}
    for i, p in enumerate(prints):
        least.setdefault(group[p], i + 5)
    rows = [(i + 5, t, None, None, None) for i, t in enumerate(texts)]
    out = stages.without_near_copies(spark, frame(spark, rows, 5), None)
    assert out.schema == frame(spark).schema
    assert sorted(r.doc_id for r in out.collect()) == sorted(least.values())
    assert len(least) < len(texts) - 60
    assert stages.without_near_copies(spark, frame(spark, []), None).count() == 0


def test_one_row_of_each_group_stays(spark):
    """Whatever the ids: null, repeated, shared by two texts, or the whole row twice."""
    one, two, three, four = (prose(600 + k, 80) for k in range(4))
    near = one.upper()
    rows = [(4, one), (None, one), (None, near), (4, near), (4, one)]
    rows += [(None, two), (None, two + " \n"), (None, two)]
    rows += [(7, three), (7, three), (7, four), (9, three.upper())]
    rows += [(None, None), (None, ""), (2, " ")]
    shown = [(d, t, "en", 0.5, None) for d, t in rows]
    for parts in (1, 4):
        docs = frame(spark, shown, parts).withColumn("key", F.create_map(F.lit("a"), F.lit(1)))
        docs = docs.withColumn("print", F.lit(1)).withColumn("sha", F.lit("x"))
        out = stages.without_near_copies(spark, docs, None)
        assert out.columns == docs.columns
        got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
        by_digest = lambda *texts: min(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
        want = [(4, by_digest(one, near)), (None, by_digest(two, two + " \n")), (7, three), (7, four), (2, " ")]
        assert got == sorted(want, key=str)
