"""Token counts of whole texts by a public tokenizer: only lengths leave the workers.

The tokenizer file is read once on the driver and broadcast (a vocabulary of a few MB, checked
against ``MAX_FILE_BYTES``). Texts are cut where the tokenizer itself always cuts, and the pieces are
encoded in batches of about equal bytes, so neither a long text nor many texts make a large batch.

A byte-level vocabulary whose ids are the ranks of its merges is the same encoder in two of the public libraries. The
one that counts several times faster takes the texts for which both agree: those of Latin letters and the characters
around them, without a string that the file declares a token. All other texts go to the library of the file.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_FILE_BYTES = 64 << 20
BATCH_BYTES = 256 << 10
PIECE_BYTES = 32 << 10

# A byte-level pattern always parts "x y" before the blank: the run before it ends there, and one
# blank before a letter or digit belongs to the following piece. A line end after a letter or digit starts a piece, and
# so does a mark of punctuation after a Chinese character. Only neighbours of these kinds are trusted.
SAFE = re.compile(
    "(?<=[A-Za-z0-9])(?= [A-Za-z0-9])|(?<=[A-Za-z0-9])(?=\n)|(?<=[\u4e00-\u9fff])(?=[\u3001\u3002\uff0c\uff01\uff1f])"
)

# Fixed value: the pattern of byte-level vocabularies of this kind.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER = re.compile("[^\x00-\u024f]")  # beyond, the libraries' tables of letters may be of different ages
PLAIN_BYTES = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))  # written as themselves in vocabulary files

_loaded: dict[tuple, object] = {}


def pieces(text: str, limit: int = PIECE_BYTES) -> Iterator[str]:
    """The text in pieces of at least ``limit`` characters, cut at safe blanks only."""
    lo = 0
    while len(text) - lo > limit:
        cut = SAFE.search(text, lo + max(1, limit))
        if cut is None:
            break
        yield text[lo : cut.start()]
        lo = cut.start()
    yield text[lo:]


def byte_ranks(parsed: dict) -> dict[bytes, int] | None:
    """Bytes and rank of each token of a byte-level file; None unless ids grow with the merges and nothing else is set."""
    model, before = parsed.get("model", {}), parsed.get("pre_tokenizer") or {}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if model.get("type") != "BPE" or any(model.get(o) for o in options) or parsed.get("normalizer"):
        return None
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    rest = [b for b in range(256) if b not in PLAIN_BYTES]
    value = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}
    vocab = model["vocab"]
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    added = {t["content"] for t in parsed.get("added_tokens", ())}
    tokens = {t: i for t, i in vocab.items() if t not in added}
    if any(c not in value for t in tokens for c in t) or any(b <= a for a, b in zip(merged, merged[1:], strict=False)):
        return None
    single = sorted(i for t, i in tokens.items() if len(t) == 1)
    if len(single) != 256 or len(tokens) != 256 + len(merged) or (merged and merged[0] < single[-1]):
        return None
    return {bytes(value[c] for c in t): i for t, i in tokens.items()}


class Counter:
    """Counts tokens of texts with the library that the file's kind asks for."""

    def __init__(self, name: str, content: bytes, batch_bytes: int, piece_bytes: int):
        self.batch_bytes, self.piece_bytes, self.splits = batch_bytes, piece_bytes, False
        self.plain, self.declared = None, ()
        if name.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            made = Tokenizer.from_buffer(content)
            made.no_padding()
            made.no_truncation()
            parsed = json.loads(content)
            parts = parsed.get("pre_tokenizer") or {}
            plain = parsed.get("normalizer") is None
            ranks = byte_ranks(parsed)
            if ranks is not None:
                from tiktoken import Encoding

                self.plain = Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
                self.declared = tuple(t["content"] for t in parsed.get("added_tokens", ()))
            self.splits = plain and parts.get("type") == "ByteLevel" and parts.get("use_regex", True)
            self.lengths = lambda texts: map(len, made.encode_batch_fast(texts, add_special_tokens=False))
        elif name.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            made = SentencePieceProcessor(model_proto=content)
            self.lengths = lambda texts: map(len, made.encode(texts, num_threads=1))
        else:
            raise ValueError(f"unknown kind of tokenizer file: {name}")

    def agreed(self, text: str) -> bool:
        """Whether both libraries encode the text alike."""
        return self.plain is not None and OTHER.search(text) is None and not any(d in text for d in self.declared)

    def count(self, texts: list[str]) -> list[int]:
        out, batch, owners, held = [0] * len(texts), [], [], 0

        def flush() -> None:
            for owner, n in zip(owners, self.lengths(batch), strict=True):
                out[owner] += n
            batch.clear(), owners.clear()

        for i, text in enumerate(texts):
            if self.agreed(text):
                out[i] = sum(len(self.plain.encode_ordinary(piece)) for piece in pieces(text, self.piece_bytes))
                continue
            for piece in pieces(text, self.piece_bytes) if self.splits else (text,):
                size = len(piece.encode())
                if batch and held + size > self.batch_bytes:
                    flush()
                    held = 0
                batch.append(piece)
                owners.append(i)
                held += size
        if batch:
            flush()
        return out


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 1024,
    batch_bytes: int = BATCH_BYTES,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row of ``docs``.

    ``tokenizer`` is the path of a .json or .model file. Null and empty texts have 0 tokens; a null id
    stays null; repeated rows are counted each; columns other than doc_id and text are ignored. A long text without
    a place to cut, such as one of Thai letters only, is encoded as one piece.
    """
    with open(tokenizer, "rb") as file:
        content = file.read(MAX_FILE_BYTES + 1)
    if len(content) > MAX_FILE_BYTES:
        raise ValueError(f"{tokenizer} has more than {MAX_FILE_BYTES} bytes")
    name = os.path.basename(tokenizer)
    key = (hashlib.sha256(content).digest(), name, batch_bytes, piece_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _loaded.get(key)
        if counter is None:
            _loaded.clear()
            counter = _loaded[key] = Counter(name, shared.value, batch_bytes, piece_bytes)
        for batch in batches:
            n = counter.count([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select("doc_id", size.alias("n_bytes"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
