"""Packing beside the tokenizer and a plain best fit."""

import collections
import random
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carespan.llm import packing
from carespan.llm.token_counts import vocabulary_path
from tests.llm.conftest import AWKWARD, documents

WINDOW = packing.WINDOW


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def numbers(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


_both = []


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([
    "word", " ", "  ", "\n", "\t", "\r\n", " ", " ", "\x1c", "\x85", "\x0b", "᠎", "!", "'s", "'", "é", "漢字", "🙂",
    "12", "<|endoftext|>", "<|endof", "text|>", "́", "a" * 70, "​", "ſ", "²",
]), max_size=25))
def test_ids_of_any_text(parts):
    """Chunks give the ids of the whole text, also with odd white space and special strings."""
    if not _both:
        _both.extend([Tokenizer.from_file(vocabulary_path()), packing.Encoder()])
    library, encoder = _both
    text = "".join(parts)
    assert numbers(encoder.ids([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_kept_chunks_are_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_CHUNKS", 50)
    encoder = packing.Encoder()
    rng = random.Random(3)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 90))) for _ in range(20)) for _ in range(3)]
        assert [numbers(x) for x in encoder.ids(texts)] == [plain_ids(tokenizer, t)[:-1] for t in texts]
        assert all(len(c.encode()) <= packing.KEPT_BYTES for c in encoder.known[0].to_pylist())
        assert len(encoder.known[0]) <= 50 + 60 and len(encoder.known[0]) == len(encoder.known[1])


def plain_best_fit(lengths, window):
    """Window and offset of each length in turn: the tightest open window, the latest changed of equals."""
    rooms, changed, placed = [], [], []
    for turn, length in enumerate(lengths):
        fits = [(room, -changed[i], i) for i, room in enumerate(rooms) if room >= length]
        if fits:
            at = min(fits)[2]
        else:
            at = len(rooms)
            rooms.append(window)
            changed.append(0)
        placed.append((at, window - rooms[at]))
        rooms[at] -= length
        changed[at] = turn
    return placed


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(1, w), max_size=80))))
def test_segment_tree_against_plain_search(case):
    window, lengths = case
    windows = packing.Windows(window)
    assert [windows.place(n) for n in lengths] == plain_best_fit(lengths, window)


def check(tokenizer, rows, pieces, blocks=1):
    """Every id in one piece, no overlap within a sequence, each block packed as a plain best fit does."""
    documents_of = collections.defaultdict(list)
    for r in rows:
        documents_of[r["doc_id"]].append(plain_ids(tokenizer, r["text"]))
    by_document, by_sequence, by_block = (collections.defaultdict(list) for _ in range(3))
    for p in pieces:
        by_document[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
        by_block[p["sequence_id"] >> 32].append(p)
    expected, found = collections.Counter(), collections.Counter()
    for doc_id, texts in documents_of.items():
        for ids in texts:
            for start in range(0, len(ids), WINDOW):
                part = ids[start:start + WINDOW]
                expected[doc_id, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids)] += 1
        for p in by_document[doc_id]:
            found[doc_id, p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]] += 1
    assert expected == found
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= WINDOW
    assert len(by_block) <= blocks
    for parts in by_block.values():
        lengths = sorted((p["length"] for p in parts), reverse=True)
        plain = collections.Counter((n, offset) for n, (_, offset) in zip(lengths, plain_best_fit(lengths, WINDOW)))
        assert collections.Counter((p["length"], p["offset"]) for p in parts) == plain


def test_sample(spark, sample, tokenizer):
    docs, rows = sample
    pieces = packing.packed(docs).collect()
    check(tokenizer, rows, pieces)
    used = collections.Counter()
    for p in pieces:
        used[p["sequence_id"]] += p["length"]
    padding = sum(0 if n.bit_count() == 1 else WINDOW - n for n in used.values())
    assert padding < 0.02 * sum(used.values())


def test_blocks(spark, sample, tokenizer):
    docs, rows = sample
    check(tokenizer, rows, packing.packed(docs, block_pieces=40).collect(), blocks=-(-len(rows) * 2 // 40))


def test_sequences(spark, tokenizer):
    texts = ["word " * 5000, "one two three", None, "", "x " * 1023, "<|endoftext|> ends"]
    docs = documents(spark, texts)
    pieces = packing.packed(docs, with_ids=True)
    whole = {r["sequence_id"]: r for r in packing.sequences(pieces).collect()}
    for p in pieces.collect():
        ids = numbers(bytes(whole[p["sequence_id"]]["ids"]))
        assert ids[p["offset"]:p["offset"] + p["length"]] == plain_ids(tokenizer, texts[p["doc_id"]])[p["start"]:p["start"] + p["length"]]
    for r in whole.values():
        assert r["used"] == len(r["ids"]) // 4
        assert r["padded_to"] == (r["used"] if r["used"].bit_count() == 1 else WINDOW)


def test_awkward_rows(spark, awkward, nothing, tokenizer):
    rows = awkward.collect()
    pieces = packing.packed(awkward).collect()
    check(tokenizer, rows, pieces)
    assert sum(p["start"] == 0 for p in pieces) == len(AWKWARD) + 4
    assert packing.packed(nothing).count() == 0
    clash = awkward.withColumnsRenamed({"row": "start", "node": "length", "place": "ids", "n_words": "piece"})
    assert len(packing.packed(clash).collect()) == len(pieces)
