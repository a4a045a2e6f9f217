"""BPE: equal to the library on whole texts, whatever the table holds."""

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from plantlake.llm import bpe
from plantlake.llm.queries import QUERIES, vocabulary

ODD = [
    None, "", " \n\t\r\x0b\x0c ", "a<|endoftext|>b  <|startoftext|>", "ΑΣ ΣΑΣ İstanbul ﬁ é e\u0301",
    "x\u00a0y\u2003z\x85 \x1c q I'll 'S don't ½ 日本語", "\u0301 start", "\U0001f600 " * 3, "w" * 5000, "it's " * 2000,
]


def expected(text):
    library = expected.library
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda b: hashlib.sha256(b).hexdigest()
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(decoded.encode())


expected.library = Tokenizer.from_file(vocabulary())


@pytest.mark.parametrize("limit", [bpe.TABLE_BYTES, 300, 0])
def test_odd_texts(spark, documents, limit):
    docs = documents(*[(k, t) for k, t in enumerate(ODD)], (0, "again"), (None, "it's"))
    coded = bpe.encode(docs, vocabulary(), limit)
    assert {r.row for r in coded.select("row").collect()} == {"own row"}
    got = bpe.digests(bpe.decode(coded, vocabulary())).collect()
    want = [(k, *expected(t)) for k, t in enumerate(ODD)] + [(0, *expected("again")), (None, *expected("it's"))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_query_equals_the_library(spark, sf_dir):
    got = {tuple(r) for r in QUERIES["op8_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert got == {(d.doc_id, *expected(d.text)) for d in docs}


def test_every_repeated_word_is_in_the_table_once(spark, documents):
    docs = documents((1, "a b a c"), (2, "b\td d"), (3, "A"))
    with open(vocabulary(), encoding="utf-8") as file:
        table = bpe.build_table(docs, file.read())
    assert sorted(table.hashes.tolist()) == sorted(map(bpe.word_hash, [b"a", b"b", b"d"]))


def test_empty_table(spark, documents):
    assert bpe.encode(documents((1, "a")).where("false"), vocabulary()).collect() == []
