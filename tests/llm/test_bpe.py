import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spokewise.llm import bpe
from spokewise.llm.queries import byte_bpe_path, op7_bpe
from tests.llm.edge import ROWS, edge_docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def codec():
    with open(byte_bpe_path(), "rb") as f:
        return bpe.Codec(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(codec, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = codec.encode(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == want
    assert codec.decode(got) == library.decode(want, skip_special_tokens=False)


def test_random_texts(codec, library):
    random.seed(4)
    letters = "aZ1 \t\n\r'sltrevm.,!é中😀\x85 <|endoftext|>"
    for _ in range(1500):
        check(codec, library, "".join(random.choice(letters) for _ in range(random.randint(0, 40))))


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|> b", "#" * 4000, "ab" * 3000, " " * 2000 + "x",
                                  "é" * 1000, "͸\U0010ffff", "it's we'll 'S"])
def test_special_and_long(codec, library, text):
    check(codec, library, text)


def test_every_block_of_code_points(codec, library):
    for at in range(0, 0x30000, 97):
        if not 0xD800 <= at < 0xE000:
            check(codec, library, f"a{chr(at)} {chr(at)}b1{chr(at)}")


def test_pieces_of_long_texts(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 10)
    random.seed(5)
    for _ in range(200):
        check(codec, library, "".join(random.choice("ab  \n1.'s") for _ in range(120)))


def test_cuts_are_certain(codec):
    tokens = [b for i, b in codec.bytes_of.items() if i not in codec.special.values()]
    assert all(len(codec.split(t)) == 1 for t in tokens)
    assert len(codec.split(b"the\x00\x00")) > 1


def test_edge_rows(spark, library):
    rows = sorted(map(str, bpe.digests(edge_docs(spark), byte_bpe_path()).collect()))
    want = []
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert rows == sorted("Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, w)) + ")" for w in want)


def test_empty_table(spark):
    assert bpe.digests(edge_docs(spark, []), byte_bpe_path()).collect() == []


def test_query_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    text = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs}
    assert {r.doc_id: r.decoded_sha256 for r in op7_bpe(spark, SF).collect()} == text
