import base64
import random

import pytest
import tiktoken
from llm_cases import documents, no_documents
from public_tokenizers import PATTERN

from wellgauge.llm import bpe
from wellgauge.llm.queries import RANKS

CHARACTERS = list("aabs tdmrevl''''  \n\t\r..!?19") + list("é中  \x1c\x85😀Ⅷ²́ſ")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts):
    ids, ends, upto = bpe.codec(RANKS).encode([t.encode() for t in texts])
    return [ids[a:b].tolist() for a, b in zip([0, *upto], upto, strict=False)]


def test_random_texts_as_the_library(library):
    rnd = random.Random(1)
    texts = ["".join(rnd.choices(CHARACTERS, k=rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["", "a" * 5000, "'" * 3000, " " * 777, "\n\n x", "'s'st'll 're''ve"]
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point_as_the_library(library):
    points = [chr(i) for i in range(0, 0x110000, 7) if not 0xD800 <= i < 0xE000]
    texts = [f"a{x}1 {x}.{x}{x} a" for x in points]
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


def test_blocks_of_any_size_give_the_same_starts():
    import numpy as np

    kinds = np.array(random.Random(2).choices(range(8), k=3000), np.uint8)
    # Contractions are only marked where letters follow.
    kinds[(kinds == bpe.SHORT) | (kinds == bpe.LONG)] = bpe.OTHER
    want = bpe.token_starts(kinds, 1 << 12)
    for block in (1, 7, 64):
        assert (bpe.token_starts(kinds, block) == want).all()


def test_long_and_short_merges_agree():
    ranks = bpe.codec(RANKS).ranks
    rnd = random.Random(3)
    for _ in range(300):
        piece = bytes(rnd.choices(b"aeinrst", k=rnd.randint(1, 40)))
        assert bpe._merge_short(piece, ranks) == bpe._merge_long(piece, ranks)


def test_rows(spark, library):
    table = documents(spark)
    want = sorted(
        (r.doc_id or -1, library.encode_ordinary(r.text or ""), (r.text or "").encode())
        for r in table.select("doc_id", "text").collect()
    )
    both = bpe.decode(bpe.encode(table, RANKS), RANKS).collect()
    ids = bpe.encode(table, RANKS).collect()
    got = sorted(
        (i.doc_id or -1, list(i.ids), bytes(d.decoded)) for i, d in zip(ids, both, strict=True)
    )
    assert got == want
    assert all(len(r.ids) == len(r.ends) for r in ids)


def test_ends_are_byte_offsets(spark):
    row = bpe.encode(spark.createDataFrame([(1, "é x 漢字")], "doc_id long, text string"), RANKS).first()
    tokens = bpe.codec(RANKS)
    assert row.ends[-1] == len("é x 漢字".encode())
    assert [b - a for a, b in zip([0, *row.ends], row.ends, strict=False)] == [
        int(tokens.lengths[i]) for i in row.ids
    ]


def test_no_rows(spark):
    assert bpe.decode(bpe.encode(no_documents(spark), RANKS), RANKS).collect() == []
