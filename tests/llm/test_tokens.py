import hashlib
import json
import random
import tracemalloc
import weakref

import pyarrow as pa
import pytest
from cases import TEXTS, documents, empty

from viaduct.llm.merging import Remembered, merge, merge_short, portions, slices
from viaduct.llm.pieces import PORTION_BYTES, TABLE_BYTES, PieceTable, encode, encode_digests
from viaduct.llm.queries import vocabulary
from viaduct.llm.token_counts import ByteCounter, count_tokens

BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = ["", " ", "  a   b ", "\n\n\ta\r\n", "<|endoftext|>x<|endoftext|>", "<|endoftext|>" * 3, "don't we'll'sS", "<s></s><unk><0x0A>",
       "▁a ▁▁ b", "\x00\x01\x1c\x1f\x85​　﻿", "👨‍👩‍👧 é漢字", "a" * 4000, "ab" * 3000, "! " * 3000, " " * 2000,
       "\U0003d000\U000187f8x 1\U00011de0"]


def made_up():
    draw = random.Random(9)
    pools = [(32, 127), (0x80, 0x800), (0x800, 0xD800), (0xE000, 0x20000), (32, 33), (10, 11)]
    return ["".join(chr(draw.randrange(*draw.choice(pools))) for _ in range(50)) for _ in range(400)]


def merged_plainly(symbols, pairs):
    symbols, count = list(symbols), 0
    while True:
        ranks = [(pairs[a << 16 | b] >> 16, i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << 16 | b in pairs]
        if not ranks:
            return symbols, count
        _, i = min(ranks)
        symbols[i:i + 2] = [pairs[symbols[i] << 16 | symbols[i + 1]] & 0xFFFF]
        count += 1


def test_heap_merges_as_repeated_search_does():
    draw = random.Random(4)
    for _ in range(300):
        pairs = {}
        for rank in range(draw.randrange(1, 30)):
            pairs.setdefault(draw.randrange(8) << 16 | draw.randrange(8), (rank // 2) << 16 | draw.randrange(8))
        symbols = [draw.randrange(8) for _ in range(draw.randrange(25))]
        expected, count = merged_plainly(symbols, pairs)
        assert merge_short(list(symbols), pairs) == expected
        assert merge(symbols, pairs) == count and [s for s in symbols if s >= 0] == expected


def test_remembered_is_bounded():
    made = []
    held, other = (Remembered(lambda key: made.append(key) or len(key), most_bytes=5000) for _ in range(2))
    for i in range(200):
        assert held["x" * (i % 30)] == i % 30
        held.trim()
        assert held.bytes <= 5000
    made.clear()
    assert [held["y" * 2000], held["y" * 2000], other["z"]] == [2000, 2000, 1] and made == ["y" * 2000, "z"]
    Remembered.only(held)
    assert len(held) and not len(other)


def test_portions_hold_all_texts_in_turn():
    texts = ["", "x" * 3_000_000, "", "y" * 2_000_000, "z" * 9_000_000, "a", ""]
    assert sum(portions(texts), []) == texts and list(portions([])) == []
    assert all(len(part) == 1 or sum(map(len, part)) <= 4 << 20 for part in portions(texts))


def test_slices_hold_all_rows_in_turn():
    texts = ["", "x" * 3_000_000, None, "y" * 2_000_000, "é" * 9_000_000, "a", ""]
    batch = pa.RecordBatch.from_pydict({"n": pa.array(range(7)), "text": pa.array(texts)})
    parts = list(slices(batch, "text"))
    assert [n for part in parts for n in part.column("n").to_pylist()] == list(range(7))
    assert [t for part in parts for t in part.column("text").to_pylist()] == texts
    assert all(part.num_rows == 1 or part.get_total_buffer_size() and
               sum(len(t or "") for t in part.column("text").to_pylist()) <= 4 << 20 for part in parts)
    assert not list(slices(batch.slice(0, 0), "text")) and len(list(slices(batch, "text", 1))) >= 5
    assert list(slices(batch.slice(5), "text"))[0].column("n").to_pylist() == [5, 6]


def test_a_model_that_an_operator_leaves_is_collected():
    class Model:
        def __init__(self):
            self.found = Remembered(self.score)  # refers back to the model

        def score(self, key):
            return key

    model, other = Model(), Remembered(len)
    gone = weakref.ref(model)
    Remembered.only(model.found)
    del model
    Remembered.only(other)
    assert gone() is None


def test_memory_of_a_piece_table_is_bounded():
    draw, table, written = random.Random(6), PieceTable(vocabulary(PIECES)), 0
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    tracemalloc.start()
    try:
        for _ in range(4):
            table.ids(table.chunks(" ".join(word() for _ in range(PORTION_BYTES // 9))))
            written = max(written, table.written.bytes)
            held = tracemalloc.get_traced_memory()[0]
            assert held <= 1.2 * table.written.bytes + (4 << 20)
            table.trim()
    finally:
        tracemalloc.stop()
    # What a portion of nothing but new words adds, to a table that was just short of its share.
    assert TABLE_BYTES + 1.2 * written / 4 < 64 << 20


def test_words_are_cut_at_signs():
    table = PieceTable(vocabulary(PIECES))
    assert table.chunks("the end.\nThe  _end_”") == [" the", " end", ".\n", "The", "  _", "end", "_”"]


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}},
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}},
    {"added_tokens": [{"id": 0, "content": "<x>", "lstrip": True}]},
])
def test_other_vocabularies_are_refused(tmp_path, change):
    with open(vocabulary(BYTES)) as file:
        described = json.load(file)
    (tmp_path / "other.json").write_text(json.dumps({**described, **change}))
    with pytest.raises(ValueError, match="byte-level"):
        ByteCounter(str(tmp_path / "other.json"))


def test_counts_are_those_of_the_library():
    from tokenizers import Tokenizer

    ours, theirs = ByteCounter(vocabulary(BYTES)), Tokenizer.from_file(vocabulary(BYTES))
    for text in [*ODD, *made_up(), *[t for _, t in TEXTS if t]]:
        assert ours.count(text) == len(theirs.encode(text, add_special_tokens=False).ids), repr(text[:60])


def test_pieces_are_those_of_the_library():
    import sentencepiece

    ours, theirs = PieceTable(vocabulary(PIECES)), sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    for text in [*ODD, *made_up(), *[t for _, t in TEXTS if t]]:
        ids = ours.encode(text)
        assert ids == theirs.encode(text), repr(text[:60])
        assert ours.decode(ids) == ours.text(ours.chunks(text)) == theirs.decode(ids), repr(text[:60])


def test_bytes_that_form_no_character_decode_as_the_library_does():
    import sentencepiece

    ours, theirs = PieceTable(vocabulary(PIECES)), sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    ids = [ours.byte_id[0xE6], ours.byte_id[0xBC], *theirs.encode("a b")]
    assert ours.decode(ids).replace("�", "") == theirs.decode(ids).replace("�", "")


def test_operators_cover_every_row(spark):
    import sentencepiece

    docs, processor = documents(spark), sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    counted = {(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in count_tokens(docs, vocabulary(BYTES)).collect()}
    counter = ByteCounter(vocabulary(BYTES))
    assert counted == {(i, len((t or "").encode()), counter.count(t or ""), counter.count(t or "") > 512) for i, t in TEXTS}
    encoded = {(r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in encode(docs, vocabulary(PIECES)).collect()}
    assert encoded == {(i, tuple(processor.encode(t or "")), processor.decode(processor.encode(t or ""))) for i, t in TEXTS}
    for r in encode_digests(docs, vocabulary(PIECES)).filter("doc_id IN (4, 14)").collect():
        ids = processor.encode(dict(TEXTS)[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(processor.decode(ids).encode()).hexdigest()


def test_empty_tables(spark):
    assert count_tokens(empty(spark), vocabulary(BYTES)).count() == 0
    assert encode_digests(empty(spark), vocabulary(PIECES)).count() == 0


def test_other_models_are_refused():
    with pytest.raises(Exception):
        PieceTable(vocabulary(BYTES))
