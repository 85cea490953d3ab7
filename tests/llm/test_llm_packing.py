import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_cases import EDGES, edge_docs, no_docs
from tokenizers import Tokenizer

from barlake.llm.pack import pack_documents, piece_digests, piece_lengths, read_bucket, write_buckets
from barlake.llm.queries import WORD_TOKENIZER
from barlake.llm.tokens import WordEncoder


@given(st.integers(1, 50_000))
def test_lengths_are_powers_of_two(n):
    lengths = piece_lengths(n)
    assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
    assert all(x & (x - 1) == 0 and x <= 4096 for x in lengths)
    assert len(set(x for x in lengths if x < 4096)) == len([x for x in lengths if x < 4096])


@settings(deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_word_encoder_equals_the_library(text):
    if not hasattr(test_word_encoder_equals_the_library, "both"):
        test_word_encoder_equals_the_library.both = WordEncoder(WORD_TOKENIZER), Tokenizer.from_file(WORD_TOKENIZER)
    own, library = test_word_encoder_equals_the_library.both
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_id_lies_in_one_piece(spark, tmp_path):
    pieces = pack_documents(edge_docs(spark), WORD_TOKENIZER).cache()
    library, rows = Tokenizer.from_file(WORD_TOKENIZER), pieces.collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    for doc_id, text in set(EDGES):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        copies = EDGES.count((doc_id, text))
        assert sum(r.length for r in own) * 4 == len(ids) * copies and {r.doc_tokens for r in own} == {len(ids) // 4}
        for r in own:
            assert bytes(r.ids) == ids[4 * r.start : 4 * (r.start + r.length)] and r.length == 1 << r.bucket
    digests = {(r.sequence_id, r.ids_crc32) for r in piece_digests(pieces).collect()}
    assert digests == {(r.sequence_id, zlib.crc32(bytes(r.ids))) for r in rows}
    write_buckets(pieces, str(tmp_path / "buckets"))
    assert {r.length for r in read_bucket(spark, str(tmp_path / "buckets"), 1).collect()} <= {2}
    assert pack_documents(no_docs(spark), WORD_TOKENIZER).count() == 0
    with pytest.raises(ValueError):
        pack_documents(no_docs(spark), WORD_TOKENIZER, limit=1000)


def test_other_work_of_a_worker_releases_the_encoder(spark):
    """A worker that packed is reused; the caches of its encoder must not stay beside the tables of other stages."""
    from barlake.llm import jaccard, tokens, toxicity

    import inspect

    tokens.word_encoder(WORD_TOKENIZER)
    tokens.release_encoder()
    assert tokens.word_encoder.cache_info().currsize == 0
    for module in (jaccard, toxicity):
        assert "release_encoder()" in inspect.getsource(module)


def test_packing_of_the_pipeline_keeps_few_words(spark, monkeypatch):
    """Its executors are full of other stages; what is kept is bounded by the caches asked for, and no id depends on it."""
    import corpus_pipeline
    from barlake.llm import tokens

    asked = []
    whole = pack_documents
    monkeypatch.setattr(corpus_pipeline.pack, "pack_documents", lambda *args, **more: asked.append(more) or whole(*args, **more))
    pieces = corpus_pipeline.packing_stage(spark, edge_docs(spark), "")
    assert asked == [{"cached": tokens.CACHED_FEW}] and sum(tokens.CACHED_FEW) * 6 < sum(tokens.CACHED)
    assert sorted(r.ids_crc32 for r in pieces.collect()) == sorted(r.ids_crc32 for r in piece_digests(whole(edge_docs(spark), WORD_TOKENIZER)).collect())
    few, full = WordEncoder(WORD_TOKENIZER, cached=(50, 30)), WordEncoder(WORD_TOKENIZER)
    for at in range(0, 4000, 20):
        words = [f"word{n * n} tail{n}x" for n in range(at, at + 20)]
        assert few.encode(words) == full.encode(words)
        assert max(len(few.words), len(few.old_words)) <= 50 + 40 and max(len(few.pieces), len(few.old_pieces)) <= 30 + 80


def test_a_reused_worker_gives_back_what_was_freed():
    """What an earlier stage's tasks have freed must not stay beside the next stage's, on top of the heap."""
    import re

    from barlake.llm import tokens

    def held():
        with open("/proc/self/smaps_rollup") as rollup:
            return int(re.search(r"Pss_Anon:\s+(\d+)", rollup.read())[1])

    blocks = [np.ones(1 << 13) for _ in range(3000)]  # 64 kB each: from the C library's heap
    kept = blocks[::100]
    full = held()
    del blocks
    tokens.release_encoder()
    assert len(kept) == 30 and held() < full - 150_000
