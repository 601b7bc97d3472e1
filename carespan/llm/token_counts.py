"""Operator 4: token counts of whole texts.

Arrow functions encode batches balanced by bytes and return lengths only. A long text is split at safe
boundaries, before a run of white space that follows another character: no pre-token of a byte-level
BPE reaches across one, so the pieces' counts add up to the text's. Words with the white space before them
are such pieces, too: the encoder that packing has keeps the ids of those it saw, as most stand in many
texts, so the library encodes few of them again. A vocabulary of another kind gets the pieces as they are.
"""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame

from carespan.llm.common import map_texts, table

VOCABULARY = "byte_bpe_50k.json"
PIECE_CHARS = 1 << 15
BATCH_BYTES = 1 << 18
TOGETHER_BYTES = 4 << 20  # pieces whose words are told apart at once
LIMIT = 1024
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \t\n\r])")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """The text in pieces of about `size` characters; a piece is longer where it has no safe boundary."""
    if len(text) <= size:
        return [text]
    found, start = [], 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        found.append(text[start:cut.start()])
        start = cut.start()
    found.append(text[start:])
    return found


def adds_up(tokenizer) -> bool:
    """Whether counts of words add up: byte-level BPE, where nothing looks beyond white space."""
    made = json.loads(tokenizer.to_str())
    split, model = made["pre_tokenizer"] or {}, made["model"]
    return (
        made["normalizer"] is None and model["type"] == "BPE" and not model.get("dropout")
        and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        and not any(
            a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"]) for a in made["added_tokens"]
        )
    )


_counters: dict[str | None, tuple] = {}


def _counter(path: str | None) -> tuple:
    """The worker's function from texts to their numbers of tokens, and whether it tells words apart."""
    if path not in _counters:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        from carespan.llm.packing import Encoder

        tokenizer = Tokenizer.from_file(path or vocabulary_path())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        words = adds_up(tokenizer)
        if words:
            encoder = Encoder(path)
            lengths = lambda batch: [len(ids) // 4 for ids in encoder.ids(batch)]
        else:
            lengths = lambda batch: list(map(len, tokenizer.encode_batch_fast(batch, add_special_tokens=False)))
        _counters[path] = lengths, words
    return _counters[path]


def _encoder(path: str | None, piece_chars: int, batch_bytes: int):
    def make():
        lengths, words = _counter(path)
        most = TOGETHER_BYTES if words else batch_bytes

        def count(texts):
            places: dict[bytes, int] = {}
            for t in texts:  # equal texts of a portion are encoded once
                places.setdefault(t, len(places))
            counts = [0] * len(places)
            batch, owners, size = [], [], 0

            def encode():
                for owner, n in zip(owners, lengths(batch)):
                    counts[owner] += n

            for t, place in places.items():
                for piece in pieces(t.decode(), piece_chars):
                    if batch and size + len(piece) > most:
                        encode()
                        batch, owners, size = [], [], 0
                    batch.append(piece)
                    owners.append(place)
                    size += len(piece)
            if batch:
                encode()
            return [(len(t), counts[places[t]]) for t in texts]

        return count

    return make


def token_counts(
    docs: DataFrame, path: str | None = None, limit: int = LIMIT, id_column: str = "doc_id", text: str = "text",
    piece_chars: int = PIECE_CHARS, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Id, n_bytes (UTF-8), n_tokens and over_limit of every row, one row out per row in.

    `path` names the tokenizer file, which must be readable on every executor; by default the file of
    the installed vocabulary package. Null and empty texts have 0 bytes and 0 tokens. Repeated rows each
    get their row, an empty table gives none, other columns are ignored.
    """
    rows = map_texts(
        docs, _encoder(path, piece_chars, batch_bytes), "n_bytes bigint, n_tokens bigint", (id_column,), text
    )
    return rows.withColumn("over_limit", rows["n_tokens"] > limit)


def op4_token_counts(spark, sf_dir) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op4_token_counts": op4_token_counts}
SQL: dict[str, str] = {}
