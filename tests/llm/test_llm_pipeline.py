import re
import zlib

import corpus_pipeline
import numpy as np
from test_llm_near_stage import kept_ids
from tokenizers import Tokenizer

from barlake.llm import toxicity
from barlake.llm.common import named_table, stored
from barlake.llm.queries import WORD_TOKENIZER

SF = "/root/testdata/sf0.001"


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def one_of_equal_texts(rows):
    """Ids that plain code keeps of (doc_id, text): most code points first, then the smallest id."""
    best = {}
    for doc_id, text in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best[key] = min(best.get(key, (1, 0)), (-len(text or ""), doc_id))
    return {doc_id for _, doc_id in best.values()}


def test_stages_take_effect_on_what_is_left(spark):
    docs = named_table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "packing"] and corpus_pipeline.ORACLE_SQL is None
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, left, SF), name)
        assert out.dtypes == docs.dtypes and ids(out) <= ids(left) and out.exceptAll(left).isEmpty()
        if name == "toxicity":
            scores = toxicity.score_documents(left, named_table(spark, SF, "labels"))
            assert ids(out) == ids(scores.where("predicted = 0"))
        elif name == "exact_dedup":
            assert ids(out) == one_of_equal_texts([(r.doc_id, r.text) for r in left.collect()])
        else:
            rows = sorted((r.doc_id, r.text) for r in left.collect())
            assert ids(out) == {rows[i][0] for i in kept_ids([text for _, text in rows])}
        left = out
    packed = {}
    for row in corpus_pipeline.run(spark, SF).collect():
        packed.setdefault(row.doc_id, []).append(row)
    encode = Tokenizer.from_file(WORD_TOKENIZER).encode
    assert set(packed) == ids(left)
    for row in left.collect():
        tokens, at = [*encode(row.text or "", add_special_tokens=False).ids, 2], 0
        for piece in sorted(packed[row.doc_id], key=lambda p: p.start):
            own = np.array(tokens[at : at + piece.length], "<u4")
            assert (piece.start, piece.ids_crc32, piece.doc_tokens) == (at, zlib.crc32(own.tobytes()), len(tokens))
            at += piece.length
        assert at == len(tokens)
