import random
import zlib

from llm_cases import edge_docs, no_docs

from barlake.llm import toxicity as tox
from barlake.llm.common import id_text_bucket

PLAIN = "the road to a quiet lake was long and the idiot or moron was not stupid but pathetic loser there".split()


def corpus(spark, count=400):
    draw, rows, labels = random.Random(4), [], []
    for i in range(count):
        text = [draw.choice(PLAIN[:10]) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            text[draw.randrange(30)] = draw.choice(["idiot", "moron", "Stupid,", "1di0t", "m0r0n", "s.t.u.p.i.d", "idiooot", "s t u p i d"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_lattices_restore_words(spark):
    texts = spark.createDataFrame([(" ".join(PLAIN * 50),)], "text string")
    costs = tox.trigram_costs(tox.trigram_counts(texts))
    for token in ("1d1ot", "m0r0n", "s.t.u.p.i.d", "idiooooot", "$tupid", "l0ser!", "st-up-id"):
        assert any(w in PLAIN for w in tox.restored_words(token, costs)), token
    assert tox.restored_words("lake,", costs) == ["lake"] and tox.restored_words("2024", costs) == []
    assert tox.decode("idiot", costs, spaced=True) == ["idiot"]
    assert list(tox.spaced_runs("so i d i o t x1 a b".split())) == ["idiot"]
    assert sum(len(p) for p in tox.spaced_runs(["a"] * 1000)) >= 990


def test_held_out_documents(spark):
    docs, labels = corpus(spark)
    rows = tox.score_documents(docs, labels, features=100).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 400 and 40 < len(held) < 140
    right = sum(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert right >= 0.95 * len(held) and all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) for r in rows)
    kept = tox.without_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = corpus(spark, 120)
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(id_text_bucket(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r.doc_id: r.score for r in tox.score_documents(docs, labels, features=50).collect()}
    assert one == {r.doc_id: r.score for r in tox.score_documents(docs, flipped, features=50).collect()}


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = tox.score_documents(edge_docs(spark), labels).collect()
    assert len(rows) == 13 and all(r.predicted == 0 and 0 <= r.score < 0.5 for r in rows)
    assert tox.score_documents(no_docs(spark), labels).count() == 0


def test_punctuation_does_not_hide_words(spark):
    texts = spark.createDataFrame([(" ".join([*PLAIN, "you", "are", "an", "clown", "scum"] * 50),)], "text string")
    extract = tox.Features(tox.trigram_costs(tox.trigram_counts(texts)))
    for text, word in (
        ("s c u m!", "scum"), ("so i d i o t.", "idiot"), ("i - d - i - o - t", "idiot"), ("i . d . i . o . t", "idiot"),
        ("m, o, r, o, n,", "moron"), ("clown,idiot", "idiot"), ("you_are_an_idiot", "idiot"), ("clown!idiot", "idiot"),
        ("-".join(["the"] * 14 + ["lake", "idiot"] + ["quiet"] * 9), "idiot"), (" ".join("the" * 20 + "idiot" + "quiet" * 9), "idiot"),
    ):
        assert word in extract(text), text


def test_the_sample_has_one_row_for_each_labelled_id(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(ids[0], f"other {j}") for j in range(300)] + [(None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(ids[0], 1), (None, 1)], "doc_id bigint, toxic int")
    rows = tox.training_rows(docs, labels, 5, 20_000).collect()
    assert len(rows) == len(ids) and {r.text for r in rows} >= {f"text {i}" for i in ids[1:]}
    assert tox.training_rows(docs, labels, 5, 7).count() == 7
