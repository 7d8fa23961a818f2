"""Token ids follow the vocabulary's JSON file."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm.lengths import length_histogram
from cohortspark.llm.packing import pack_documents
from cohortspark.llm.tokens import Encoder


def test_added_tokens_have_their_id(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "  <|endoftext|>  ", "<|endoftext|", "", "plain"]
    ids = [slow.encode(t, add_special_tokens=False).ids for t in texts]
    fast = Encoder(added=True)
    assert [np.frombuffer(fast.ids(t), "<u4").tolist() for t in texts] == ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in pack_documents(docs, with_ids=True).collect()}
    assert packed == {i: [*x, 1] for i, x in enumerate(ids)}
    counted = {r.n_tokens: r.n_docs for r in length_histogram(docs).collect()}
    assert counted == {n: sum(len(x) == n for x in ids) for n in {len(x) for x in ids}}


@pytest.mark.parametrize("size", [1_000_000, 2_000_000, 5_000_000])
@pytest.mark.parametrize("unit", [" ", "\n", "a"])
def test_long_runs_have_the_ids_of_the_stored_tokenizer(unit, size):
    """Runs that the faster library can't match; the same ids, with text around them."""
    text = f"before{unit * size}after <|endoftext|>"
    for added in (True, False):
        encoder = Encoder(added=added)
        expected = encoder.complete.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == expected
        assert encoder.complete.decode(expected, skip_special_tokens=False) == text


def test_long_runs_through_the_operators(spark):
    rows = [(i, f"x{unit * 1_200_000}y") for i, unit in enumerate(" \na")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lengths = {r.n_tokens for r in length_histogram(docs).collect()}
    pieces = pack_documents(docs).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.n - 1 for r in pieces} == lengths and len(pieces) == 3
