import zlib

import numpy as np
import public_tokenizers
import pytest
from corpora import odd_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationflow.llm import packing


def test_binary_lengths():
    assert packing.binary_lengths(1, 1024) == [1]
    assert packing.binary_lengths(2048 + 5, 1024) == [1024, 1024, 4, 1]
    assert all(sum(packing.binary_lengths(n, 8)) == n for n in range(1, 100))


def test_round_trip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    docs = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text")
    pieces = packing.pack(docs).toPandas().sort_values(["doc_id", "start"])
    assert pieces.sequence_id.is_unique and (pieces.offset == 0).all()
    assert (pieces.length & (pieces.length - 1) == 0).all() and pieces.length.max() <= 1024
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in docs.collect():
        own = pieces[pieces.doc_id == row["doc_id"]]
        want = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [0]
        assert np.concatenate(own.ids.tolist()).tolist() == want and (own.doc_tokens == len(want)).all()
        assert own.start.tolist() == [0, *np.cumsum(own.length)[:-1]]
        assert all(zlib.crc32(np.array(i, "<u4").tobytes()) == c for i, c in zip(own.ids, own.ids_crc32))


@pytest.mark.parametrize("text", ["", "a <|endoftext|> b", " \n\n x\t\ty  ", "　" * 10, "don't I'll", " " * 20_000])
def test_ids_of_odd_texts(text):
    encode = packing.Encoder(open(packing.VOCABULARY, "rb").read(), open(packing.RANKS, "rb").read())
    assert encode(text) == encode.by_file(text)


def test_buckets(spark, sf_dir, tmp_path):
    pieces = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20))
    packing.write_buckets(pieces, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.where(F.size("ids") != F.col("bucket")).isEmpty() and back.count() == pieces.count()


def test_context_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(odd_docs(spark), context=1000)
