"""Encoding and counting, against the libraries whose vocabularies are used."""

import array
import random

import public_tokenizers
import pytest
import tiktoken
import tokenizers

from cabrank.llm import bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"

_rnd = random.Random(11)
_letters = [chr(i) for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000] + list(" \n\t  abcABC0129'sé!!..\r") * 200
RANDOM = ["".join(_rnd.choices(_letters, k=_rnd.randrange(80))) for _ in range(800)]
TEXTS = [
    "", " ", "\n\n  x", "don't stop", "a" * 9000, "ab" * 4000 + "!" * 3000, " " * 5000, "𝔘nicode 한국어 ß" * 30, "x\x1cy\x85z 　w",
    "".join(_rnd.choices("abcdefghij", k=20000)), "zero\0byte", *RANDOM,
]


@pytest.fixture(scope="module")
def own():
    return bpe.codec(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


@pytest.mark.parametrize("window", [3, 4096])
def test_encoding_is_that_of_the_library(own, library, monkeypatch, window):
    monkeypatch.setattr(bpe, "WINDOW", window)
    own.pieces.clear()
    own.segments.clear()
    texts = TEXTS + [SPECIAL] if window > 3 else [t[:300] for t in TEXTS]
    for text in texts:
        ids = own.encode(text)
        assert list(ids) == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_little_is_remembered(own, library, monkeypatch):
    for name in ("SEGMENTS", "PIECES", "PAIRS"):
        monkeypatch.setattr(bpe, f"REMEMBERED_{name}", 5)
        getattr(own, name.lower()).clear()
    for text in RANDOM[:100] + [RANDOM[0] * 50]:
        assert list(own.encode(text)) == library.encode_ordinary(text)
    assert max(map(len, (own.pieces, own.pairs))) <= 5


def test_words_met_last_are_not_encoded_again(own, library, monkeypatch):
    """Words that return in every text stay remembered, however many others come between them."""
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 200)
    monkeypatch.setattr(bpe, "PART", 300)
    own.pieces.clear()
    own.segments.clear()
    asked = []
    monkeypatch.setattr(own.pieces, "find", lambda piece: asked.append(piece) or own._piece(piece))
    rnd = random.Random(4)
    often = [f" {w}zq" for w in ("kelmorant", "vistrapol", "quendrimax")]
    for k in range(40):
        others = [" " + "".join(rnd.choices("abcdefghijkl", k=9)) for _ in range(30)]
        text = "".join([*others, *often, " " + "x" * (60 + k % 9), "\n" * 70, "é" * 40]) * 2
        assert list(own.encode(text)) == library.encode_ordinary(text)
        assert len(own.pieces) + len(own.pieces.before) <= 200
    assert all(asked.count(w) == 1 for w in often)


def test_pairs_are_compatible_if_merging_leaves_them(own):
    rnd = random.Random(2)
    for _ in range(20000):
        left, right = (rnd.randrange(rnd.choice([300, 3000, 50256])) for _ in range(2))
        a, b = own.tokens[left], own.tokens[right]
        assert own.compatible(left, right) == (bpe.merge(a + b, own.ranks) == [a, b])


def test_a_token_that_merging_never_gives_stands_only_for_a_whole_piece():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 300, b"xyz": 400, b"cd": 258, b"abcd": 301}
    own = bpe.Codec(ranks, r"\w+")
    library = tiktoken.Encoding("tiny", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    for text in ("xyz", "xyzx", "axyz", "abcd", "abcdabc", "abcabcd", "bcd", "abxyzcd" * 20):
        assert list(own.encode(text)) == library.encode_ordinary(text)


DOCS = "doc_id long, text string, ids string, found string, n_tokens string"


def test_encoding_tables(spark, own):
    rows = [(1, "two words"), (1, "two words"), (None, None), (3, "")]
    docs = spark.createDataFrame([(*r, "", "", "") for r in rows], DOCS)
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == sorted(
        ((i, list(own.encode(t or ""))) for i, t in rows), key=str
    )
    decoded = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(((r.doc_id, r.text) for r in decoded), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []
    assert bpe.little(array.array("I", [1, 256])) == b"\x01\0\0\0\0\x01\0\0"


@pytest.mark.parametrize(("size", "remembered"), [(1, 300), (40, 0), (1 << 20, 300_000)])
def test_counts_are_those_of_the_library(size, remembered):
    texts = [*TEXTS, SPECIAL, f"  {SPECIAL}  x {SPECIAL}\n\n", *(t[:9] + SPECIAL + t[9:] for t in RANDOM[:200])]
    token_counts.load(VOCABULARY)[1].clear()
    encodings = tokenizers.Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)
    assert token_counts.counts(texts, VOCABULARY, size, remembered).tolist() == [len(e) for e in encodings]


def test_parts_lose_nothing_and_are_cut_where_it_is_safe():
    for text in TEXTS:
        parts = list(token_counts.parts(text, 10))
        assert "".join(parts) == text
        assert all(not a[-1].isspace() and b[0].isspace() for a, b in zip(parts, parts[1:]))


def test_batches_are_even_in_bytes():
    letter = "\U0001F600"
    texts = ["word " * 4000, f"{letter} " * 4000, f"é{letter} " * 3000, "", "x"] * 3
    batches = list(token_counts.batches(texts, 5000))
    sizes = [sum(token_counts.bytes_in(part) for _, part in batch) for batch in batches]
    assert max(sizes) < 2 * 5000 + 5000 // 8 + 10 and min(sizes[:-1]) >= 5000
    whole = [""] * len(texts)
    for number, part in (x for batch in batches for x in batch):
        whole[number] += part
    assert whole == texts


def test_count_tables(spark):
    docs = spark.createDataFrame([(1, "é a", "", "", ""), (1, "é a", "", "", ""), (None, None, "", "", ""), (2, "x " * 2000, "", "", "")], DOCS)
    found = token_counts.count_tokens(docs, VOCABULARY)
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows[:2] == [(1, 4, 2, False), (1, 4, 2, False)] and rows[3] == (None, 0, 0, False)
    assert rows[2][1] == 4000 and rows[2][3] is True
    assert token_counts.count_tokens(docs.limit(0), VOCABULARY).collect() == []
