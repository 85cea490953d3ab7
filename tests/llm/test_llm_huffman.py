import heapq
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_cases import EDGES, edge_docs, no_docs
from tokenizers import Tokenizer

from barlake.llm import huffman as h
from barlake.llm.queries import WORD_TOKENIZER


def unlimited_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=200))
def test_codes_are_optimal_and_limited(counts):
    counts = np.array(counts)
    lengths = h.code_lengths(counts)
    used = lengths[counts > 0].astype(int)
    if len(used) > 1:
        assert (2.0 ** -used).sum() == 1 and (lengths[counts == 0] == 0).all()
        assert (counts * lengths).sum() == unlimited_cost(counts)
    limited = h.code_lengths(counts, 8)
    assert limited.max() <= 8
    codes = [format(int(c), f"0{n}b") for c, n in zip(h.canonical_codes(limited), limited) if n]
    assert all(a == b or not b.startswith(a) for a in codes for b in codes)


def test_too_many_ids_for_the_limit():
    with pytest.raises(ValueError):
        h.code_lengths(np.ones(300, int), 8)


@pytest.mark.parametrize("size", [1, 2, h.CHECKPOINT, h.CHECKPOINT + 1, 5000])
def test_blocks_decode(size):
    ids = np.minimum(np.random.default_rng(size).zipf(1.2, size), 49_000).astype(np.uint16)
    lengths = h.code_lengths(np.bincount(ids, minlength=1 << 16))
    stream, marks, bits = h.encode_ids(ids, h.canonical_codes(lengths), lengths)
    packed = zlib.compress(lengths.tobytes())
    assert len(stream) == (bits + 7) // 8 and len(marks) == -(-size // h.CHECKPOINT)
    assert (h.decode_ids(stream, marks, size, packed, h.MAX_BITS) == ids).all()


def test_files_give_every_document_back(spark, tmp_path):
    for block_ids in (1 << 17, 50):
        folder = str(tmp_path / str(block_ids))
        h.write_files(edge_docs(spark), folder, WORD_TOKENIZER, block_ids=block_ids)
        got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in h.id_digests(h.read_files(spark, folder)).collect()))
        library, at, want = Tokenizer.from_file(WORD_TOKENIZER), 0, []
        for doc_id, text in sorted(((i, t or "") for i, t in EDGES), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
            ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
            want.append((at, doc_id, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
        assert got == want
    assert h.coded_roundtrip(no_docs(spark), WORD_TOKENIZER).count() == 0


def test_new_words_are_cut_into_pieces_together():
    """A batch's new words take a few calls of the pattern and the tokenizer, however many they are."""
    from barlake.llm import tokens

    encoder = tokens.WordEncoder(WORD_TOKENIZER)
    calls = []
    find, encoder.find = encoder.find, lambda text: calls.append(text) or find(text)
    texts = [" ".join(f"Wörd{i}x don't, A-{i}! naïve" for i in range(200)), "\x00odd <|x|> Σας it's", "", "  \t\n"]
    got = encoder.encode(texts)
    assert len(calls) <= 2
    assert got == [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_known_words_are_no_python_objects():
    """A batch of known words costs Python nothing per word, and a word that is kept no object."""
    import tracemalloc

    import pyarrow as pa

    from barlake.llm import tokens

    encoder = tokens.WordEncoder(WORD_TOKENIZER)
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(2000)) for i in range(20)])
    tracemalloc.start()
    first = encoder.encode(texts)
    kept = tracemalloc.get_traced_memory()[0] - sum(map(len, first))
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    again = encoder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1] - before - sum(map(len, again))
    tracemalloc.stop()
    assert len(encoder.words) > 40_000 and again == first
    assert kept < 40_000 * 20 and peak < 40_000 * 20


def test_long_words_fill_a_generation(monkeypatch):
    from barlake.llm import tokens

    monkeypatch.setattr(tokens, "CACHED_BYTES", 10_000)
    encoder, whole = tokens.WordEncoder(WORD_TOKENIZER), tokens.WordEncoder(WORD_TOKENIZER)
    for at in range(20):
        text = " ".join(f"{'long' * 50}{at}-{i}" for i in range(20))
        assert encoder.encode([text, ""]) == whole.encode([text, ""])
        assert encoder.words.names.nbytes < 20_000


def test_texts_are_batched_by_size():
    import pyarrow as pa

    from barlake.llm.common import text_batches

    texts = ["", "a" * 30, "b" * 200, "c" * 60, "ü" * 19, "", "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["doc_id", "text"])
    parts = [part.column(1).to_pylist() for part in text_batches(iter([batch, batch.slice(0, 0), batch.slice(2, 3)]), size=100)]
    assert parts == [texts[:2], texts[2:3], texts[3:], texts[2:3], texts[3:5]]
