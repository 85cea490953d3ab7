import math
import re
import zlib
from collections import Counter

import numpy as np
from llm_cases import EDGES, documents, edge_docs, no_docs, words

from barlake.llm import ppm


def trie_of(text, least=1):
    counts = [Counter() for _ in range(ppm.ORDER + 1)]
    for _, strings in ppm.byte_strings([text]):
        for value in strings.tolist():
            for order in range(ppm.ORDER + 1):
                counts[order][value & (1 << 8 * (order + 1)) - 1] += 1
    kept = [[(k, n) for k, n in c.items() if n >= least] for c in counts]
    return ppm.Trie([(np.array([k for k, _ in c], np.uint64), np.array([n for _, n in c])) for c in kept])


def test_probabilities_of_a_context_sum_to_one():
    text = b"the cat sat on the mat and the bat sat on the cat\n" * 3 + b"that is that\n"
    for least in (1, 3):
        trie = trie_of(text, least)
        for context in (b"n the", b"zzzzz", b"at on", b"\n\n\n\n\n", b"q the", b"ttttt"):
            base = int.from_bytes(context, "big") << 8
            total = (10 ** trie.log10(np.arange(base, base + 256, dtype=np.uint64))).sum()
            assert abs(total - 1) < 1e-9, (least, context, total)


def test_slices_give_the_same_strings(monkeypatch):
    streams = [b"abcdefgh" * 5 + b"\n", b"x\n", b"y" * 100 + b"\n"]
    whole = [s.tolist() for _, s in ppm.byte_strings(streams)]
    monkeypatch.setattr(ppm, "SLICE", 16)
    assert sum((s.tolist() for _, s in ppm.byte_strings(streams)), []) == sum(whole, [])


def brute(rows):
    tokens = [[w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + ["\n"] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    total, kinds = sum(c.values()), len(c)
    return sorted(
        ((i, h, len(ws), sum(c[w] > 0 for w in ws), total, round(sum(math.log10((c[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws), 6))
         for (i, _), ws, h in zip(rows, tokens, held)),
        key=str,
    )


def columns(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)


def test_base_scores_equal_brute_force(spark):
    texts = [" ".join(words(i, 40 + i, 60 + i)) for i in range(60)]
    for frequent in (1 << 20, 50):
        rows = ppm.score_documents(documents(spark, texts), frequent=frequent).collect()
        assert columns(rows) == brute(list(enumerate(texts)))
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_beats_the_base_on_held_out_text(spark):
    rows = ppm.score_documents(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_awkward_rows(spark):
    rows = ppm.score_documents(edge_docs(spark)).collect()
    assert columns(rows) == brute(EDGES)
    assert ppm.score_documents(no_docs(spark)).count() == 0
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    only = ppm.score_documents(spark.createDataFrame([(held, "ab c")], "doc_id bigint, text string")).first()
    assert only.base_score == 0 and abs(only.score + 5 * math.log10(256)) < 1e-9 and only.n_known == 0


def test_rare_contexts_count_in_a_large_corpus(spark):
    filler = " ".join(words(1, 300, 90)) + " "
    rare = ["zyxwvu qponml kjihgf", "abcde fghij zyxwvu qponmm"]
    rows = [(i, filler * 60) for i in range(100)] + [(1000 + i, t) for i, t in enumerate(rare * 6)]
    assert sum(len(t) for _, t in rows) > ppm.KEPT
    learnt = [t for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    strings = np.concatenate([s for _, s in ppm.byte_strings([" ".join(t.split()).encode() + b"\n" for t in learnt])])
    trie = ppm.Trie([np.unique(strings & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True) for k in range(ppm.ORDER + 1)])
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for kept in (ppm.KEPT, 40):
        got = {r.doc_id: r.score for r in ppm.score_documents(frame, kept=kept).where("doc_id < 3 OR doc_id >= 1000").collect()}
        for i, text in rows:
            if i in got:
                want = sum(trie.log10(s).sum() for _, s in ppm.byte_strings([" ".join(text.split()).encode() + b"\n"]))
                assert abs(got[i] - want) < 1e-6 * abs(want), (kept, i)
