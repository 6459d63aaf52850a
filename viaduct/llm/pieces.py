"""SentencePiece encoding and decoding by a table of distinct chunks.

In vocabularies where no piece holds a whitespace marker after another character, no merge can cross from one word to
the next marker. The marked text then falls into chunks, a run of markers with the word after it, which are
segmented on their own. Where no piece holds a sign (of ASCII, Latin-1 or general punctuation) beside any other kind
of character either, words fall into chunks there too, so that a word with a full stop or a line end is not one more chunk.

A batch of texts is taken in portions of a megabyte, and only one portion exists as strings; each distinct chunk of a
portion, however long, is segmented once, unless the worker's table still holds it from an earlier portion, and the
texts are put together again from the table by position, and decoded the same way. Tables begin anew between portions
once they hold more than their share of memory, and at once when the worker turns to another operator. Chunks are held
with blanks for markers, which takes a byte a letter for most words, not two.

Segmenting is byte-pair merging by score (`merging`) from single characters; characters that are in no piece
become their UTF-8 bytes' pieces. Identifiers and decoded text are those of the `sentencepiece` library for the same
model, without begin or end ids or sampling. Only byte-pair models with byte fallback, the identity normaliser and a
dummy prefix are read; others are refused.

A null text counts as empty: it has no identifiers and decodes to the empty text. Whole texts are read, however long.
Repeated rows are encoded alike; an empty table gives an empty result. Columns other than doc_id and text are not
read.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .merging import NO_SYMBOL, Remembered, begin_task, merge, merge_short, slices
from .shipping import ship
from .words import text_of

MARK = "▁"
# Chunks of a text with blanks for markers: words, or also runs of signs and of other characters within words.
_SIGNS = r"\x00-\x1F!-/:-@\[-`{-\xA9\xAB-\xB4\xB6-\xB9\xBB-\xBF\xD7\xF7‐-⁞"
_WORDS = re.compile(" *[^ ]+| +").findall
_RUNS = re.compile(f" *[^ {_SIGNS}]+| *[{_SIGNS}]+| +").findall
_CROSSES_RUNS = re.compile(f"[^{MARK}{_SIGNS}][{_SIGNS}]|[{_SIGNS}][^{MARK}{_SIGNS}]").search
_BYTE = re.compile("<0x([0-9A-F]{2})>").fullmatch
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


TABLE_BYTES = 32 << 20  # of a worker's table
PORTION_BYTES = 1 << 20  # of texts; between portions the table may begin anew
SHORT = 32  # symbols up to which searching the list beats keeping a heap


class PieceTable:
    """The segmentation of chunks under one model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trainer, normalizer = model.trainer_spec, model.normalizer_spec
        kinds = {piece.type for piece in model.pieces}
        if (trainer.model_type != trainer.BPE or not trainer.byte_fallback or normalizer.precompiled_charsmap
                or not normalizer.add_dummy_prefix or normalizer.remove_extra_whitespaces
                or not normalizer.escape_whitespaces or trainer.treat_whitespace_as_suffix
                or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or len(model.pieces) >= NO_SYMBOL):
            raise ValueError("a byte-pair model with byte fallback and the identity normaliser is needed")
        normal = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in normal):
            raise ValueError("a piece crosses a whitespace marker")
        self.split = _WORDS if any(map(_CROSSES_RUNS, normal)) else _RUNS
        # Chunks have blanks for markers; a blank itself is in no marked text.
        self.symbol = {piece.replace(MARK, " "): i for piece, (i, _) in normal.items() if len(piece) == 1 and piece != " "}
        self.names = [str(i) for i in range(len(model.pieces))]
        self.byte_id, self.surfaces = [0] * 256, {}
        for i, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                value = int(_BYTE(piece.piece)[1], 16)
                self.byte_id[value] = i
                self.surfaces[i] = bytes([value])
            elif piece.type == NORMAL:
                self.surfaces[i] = piece.piece.replace(MARK, " ")
        self.byte_ids = frozenset(self.byte_id)
        # Higher scores merge first; equal scores share a rank, so that the leftmost goes first.
        ranks = {s: r for r, s in enumerate(sorted({s for _, s in normal.values()}, reverse=True))}
        self.pairs = {}
        for piece, (i, score) in normal.items():
            for cut in range(1, len(piece)):
                left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
                if left and right:
                    self.pairs[left[0] << 16 | right[0]] = ranks[score] << 16 | i
        # Distinct chunks to their ids, comma-joined. Strings only: a table of many small tuples would be walked again
        # and again by the garbage collector. Chunks of one piece share the string of its id.
        self.written = Remembered(self._written, TABLE_BYTES)
        # The few chunks that do not decode to themselves, with what they decode to; filled and emptied with `written`.
        self.odd: dict[str, str] = {}

    def _segment(self, chunk: str) -> list[int]:
        symbols = [self.symbol.get(letter, NO_SYMBOL) for letter in chunk]
        unknown = NO_SYMBOL in symbols and [a for a, symbol in zip(chunk, symbols, strict=True) if symbol == NO_SYMBOL]
        if len(symbols) <= SHORT:
            symbols = merge_short(symbols, self.pairs)
        else:
            merge(symbols, self.pairs)
            symbols = [symbol for symbol in symbols if symbol >= 0]
        if not unknown:
            return symbols
        letters = iter(unknown)  # unknown letters merge with nothing and keep their order
        return [i for symbol in symbols for i in
                ([self.byte_id[byte] for byte in next(letters).replace(" ", MARK).encode()] if symbol == NO_SYMBOL
                 else (symbol,))]

    def _written(self, chunk: str) -> str:
        ids = self._segment(chunk)
        if not self.byte_ids.isdisjoint(ids):  # all other pieces are the chunk's own letters
            surface = self.surface(ids).replace(MARK, " ")
            if surface != chunk:
                self.odd[chunk] = surface
        return ",".join([self.names[i] for i in ids])

    def surface(self, ids) -> str:
        """The text of these identifiers; bytes that form no character become U+FFFD."""
        if not self.byte_ids.intersection(ids):
            return "".join([self.surfaces.get(i, "") for i in ids])
        parts, pending = [], bytearray()
        for i in ids:
            part = self.surfaces.get(i, "")
            if isinstance(part, bytes):
                pending += part
                continue
            if pending:
                parts.append(pending.decode("utf-8", "replace"))
                pending = bytearray()
            parts.append(part)
        if pending:
            parts.append(pending.decode("utf-8", "replace"))
        return "".join(parts)

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text, in order; none for the empty text."""
        return self.split(" " + text.replace(MARK, " ")) if text else []

    def ids(self, chunks: list[str]) -> str:
        """The ids of these chunks, comma-joined."""
        return ",".join(map(self.written.__getitem__, chunks))

    def text(self, chunks: list[str]) -> str:
        """What the ids of these chunks, all of them in the table, decode to. No character spans chunks, so that they
        decode on their own."""
        if self.odd and not self.odd.keys().isdisjoint(chunks):
            chunks = [self.odd.get(chunk, chunk) for chunk in chunks]
        return "".join(chunks).removeprefix(" ")

    def trim(self) -> None:
        """Between portions of texts."""
        self.written.trim()
        if not self.written:
            self.odd.clear()

    def encode(self, text: str) -> list[int]:
        written = self.ids(self.chunks(text))
        return list(map(int, written.split(","))) if written else []

    def decode(self, ids) -> str:
        """The text of a sequence of identifiers, without the dummy prefix."""
        return self.surface(ids).removeprefix(" ")


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    """One per model and worker process."""
    return PieceTable(path)


def _mapped(docs: DataFrame, path: str, kinds: str, columns) -> DataFrame:
    """Rows of doc_id and what `columns(table, texts)` makes of a batch, as Arrow arrays by name."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text"))
    schema = rows.select("doc_id", *[F.lit(None).cast(k.split(" ", 1)[1]).alias(k.split(" ", 1)[0])
                                     for k in kinds.split(", ")]).schema

    def run(batches):
        table = piece_table(path)
        begin_task(table.written)
        for batch in batches:
            for some in slices(batch, "text", PORTION_BYTES):
                found = columns(table, some.column("text").to_pylist())
                yield pa.RecordBatch.from_pydict({"doc_id": some.column("doc_id"), **found})
                table.trim()

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, ids, and decoded, the text that the ids stand for."""
    def columns(table, texts):
        ids = [table.encode(text) for text in texts]
        return {"ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array(map(table.decode, ids), pa.string())}
    return _mapped(docs, path, "ids array<int>, decoded string", columns)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of the decimal ids, comma-joined), decoded_sha256.

    The same work as `encode`; ids and texts are reduced to digests before they leave the worker.
    """
    def columns(table, texts):
        counts, ids, decoded = [], [], []
        for text in texts:
            chunks = table.chunks(text)
            written = table.ids(chunks)
            counts.append(written.count(",") + 1 if written else 0)
            ids.append(_sha(written))
            decoded.append(_sha(table.text(chunks)))
        return {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string())}
    return _mapped(docs, path, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", columns)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
