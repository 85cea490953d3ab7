import base64
import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings, strategies as st
from llm_cases import EDGES, edge_docs, no_docs

from barlake.llm.bpe import ByteEncoder, encode_documents, encoding_digests
from barlake.llm.queries import BYTE_RANKS

_RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_RANKS, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_RANKS, special_tokens={})
OWN = ByteEncoder(BYTE_RANKS, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aeth  's\n\té\x1c\x85　"), st.characters(codec="utf-8")), max_size=80))
def test_segment_tree_equals_the_library(text):
    ids = OWN.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


def test_long_pieces():
    for text in ("ab" * 20_000, "a" * 9999, "!" * 3001 + " " * 777):
        assert np.frombuffer(OWN.encode(text), "<u4").tolist() == LIBRARY.encode_ordinary(text)


def test_whole_texts(spark):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoding_digests(encode_documents(edge_docs(spark), BYTE_RANKS, public_tokenizers.PATTERN)).collect()}
    want = set()
    for doc_id, text in EDGES:
        ids = LIBRARY.encode_ordinary(text or "")
        want.add((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == want
    assert encode_documents(no_docs(spark), BYTE_RANKS, public_tokenizers.PATTERN).count() == 0
