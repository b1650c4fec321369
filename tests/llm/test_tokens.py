import public_tokenizers
import pytest
from helpers import frame, prose, tuples  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from nightledger.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)


with open(PATH, "rb") as _file:
    COUNTER = tokens.Counter("x.json", _file.read(), 100, 9)


def brute(text):
    return len(WHOLE.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1 9'st\n\t.é漢字。，　\xa0<|endoftext|>", max_size=60), st.integers(0, 9))
def test_cutting_keeps_the_tokens(text, limit):
    parts = list(tokens.pieces(text, limit))
    assert "".join(parts) == text
    assert sum(map(brute, parts)) == brute(text)


def test_counts_equal_the_library(spark, frame):
    texts = [None, "", " ", "<|endoftext|> x<|endoftext|>", "naïve 漢字", "a" * 3000, " ".join(prose(3, 30000)), "x\n\ny  z"]
    rows = list(enumerate(texts)) + [(2, "again"), (2, "again"), (None, "no id")]
    for sizes in ({}, {"batch_bytes": 100, "piece_bytes": 7}):
        got = tuples(tokens.token_counts(frame(rows), PATH, **sizes))
        want = [(i, len((t or "").encode()), brute(t), brute(t) > 1024) for i, t in rows]
        assert got == sorted(want, key=repr)


def whole_counter(**sizes):
    with open(PATH, "rb") as file:
        return tokens.Counter("x.json", file.read(), sizes.get("batch_bytes", 1 << 18), sizes.get("piece_bytes", 1 << 15))


def test_both_libraries_agree_on_every_character_they_share():
    counter = whole_counter()
    marks = [chr(c) for c in range(0x250)]
    texts = [t for c in marks for t in (c, f"a{c}b", f" {c}{c} {c}1", f"1{c}'s {c}", f"\n{c}\n \n{c} ", f"é{c}{c}'ll  {c}")]
    assert sum(map(counter.agreed, texts)) == len(texts)
    assert [len(counter.plain.encode_ordinary(t)) for t in texts] == [brute(t) for t in texts]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=40) | st.text(alphabet="ab 1'stlvreßÉ\t\n.!\x85\xa0\x1c", max_size=60), max_size=5))
def test_counts_of_shared_characters(texts):
    assert COUNTER.count(texts) == [brute(t) for t in texts]


def test_texts_of_the_library_only():
    counter = whole_counter(piece_bytes=7)
    texts = ["<|endoftext|>", "a <|endoftext|> b", "漢字。漢字" * 9, "ƒ ɐ", "a\u2028b", "x" * 50000, "ab " * 20000, "é" * 3000]
    assert [counter.agreed(t) for t in texts[:5]] == [False] * 5
    assert counter.count(texts) == [brute(t) for t in texts]


def test_ranks_are_taken_from_plain_files_only():
    import json

    with open(PATH, "rb") as file:
        parsed = json.load(file)
    ranks = tokens.byte_ranks(parsed)
    assert len(ranks) == 50256 and ranks[b" the"] == parsed["model"]["vocab"]["\u0120the"]
    for part, change in (("normalizer", {"type": "NFC"}), ("pre_tokenizer", None), ("model", parsed["model"] | {"dropout": 0.1}),
                         ("model", parsed["model"] | {"merges": parsed["model"]["merges"][::-1]})):
        assert tokens.byte_ranks(parsed | {part: change}) is None
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        assert tokens.byte_ranks(json.load(file)) is None


def test_sentencepiece_file(spark, frame):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    piece = SentencePieceProcessor(model_file=path)
    rows = [(1, "Some words here"), (2, None), (3, " ".join(prose(4, 500)))]
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(frame(rows), path).collect()}
    assert got == {i: len(piece.encode(t or "")) for i, t in rows}


def test_clashing_columns_and_empty_table(spark, frame):
    docs = frame([(1, "a b")]).withColumnRenamed("lang", "n_tokens").withColumnRenamed("source", "n_bytes")
    assert tuples(tokens.token_counts(docs, PATH)) == [(1, 3, brute("a b"), False)]
    assert tokens.token_counts(frame([]), PATH).count() == 0


def test_unknown_file(spark, frame, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(Exception, match="unknown kind"):
        tokens.token_counts(frame([(1, "a")]), str(tmp_path / "x.txt")).collect()
