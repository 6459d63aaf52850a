"""Token counts of texts under a byte-level byte-pair vocabulary, without making any token.

A text is cut at the vocabulary's special strings, each of which is one token, and the rest into chunks by the
vocabulary's pattern. A chunk's count is its number of bytes less the merges that `merging.merge` makes: pairs are
popped from a heap in order of rank and merged in a linked list. Worker processes remember the counts of short
chunks; this bounds nothing but time.

The count is that of the `tokenizers` library for the same file, without begin, end or added tokens, truncation or
padding. A null text counts as empty and has 0 tokens. Whole texts are read, however long. Repeated rows are counted
alike; an empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .merging import Remembered, begin_task, merge, portions
from .shipping import ship
from .words import text_of

LIMIT = 512
# Fixed value: the pattern by which byte-level vocabularies of this kind cut a text into chunks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters and digits assigned after the Unicode version (16) by which the counted library tells classes
# of characters. To it they are symbols, whatever the `regex` module here knows of them.
NEWER_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 "
    "1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F")


def newer_letters() -> str:
    """The inside of a character class of NEWER_LETTERS."""
    ends = [part.split("-") for part in NEWER_LETTERS.split()]
    return "".join("-".join(chr(int(end, 16)) for end in part) for part in ends)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such a vocabulary file: printable bytes for themselves, the others in
    order for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


def _refuse_others(described: dict) -> None:
    """Only what is counted below is read: byte-level pre-tokenising by the usual pattern, no normaliser, plain
    byte-pair merging, and special strings that are cut out wherever they stand."""
    before, model = described.get("pre_tokenizer") or {}, described["model"]
    usual = (before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
             and described.get("normalizer") is None and model.get("type") == "BPE"
             and not any(model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix",
                                                      "end_of_word_suffix", "byte_fallback", "ignore_merges"))
             and not any(token.get(name) for token in described.get("added_tokens", ())
                         for name in ("single_word", "lstrip", "rstrip", "normalized")))
    if not usual:
        raise ValueError("a byte-level byte-pair vocabulary without normaliser is needed")


class ByteCounter:
    """Counts for one vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        _refuse_others(described)
        model = described["model"]
        vocabulary = model["vocab"]
        if max(vocabulary.values()) >= 0xFFFF:
            raise ValueError("symbols must be below 65535")
        self.first = [0] * 256
        for letter, byte in byte_letters().items():
            self.first[byte] = vocabulary[letter]
        self.pairs = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocabulary[left] << 16 | vocabulary[right]] = rank << 16 | vocabulary[left + right]
        newer = newer_letters()
        self.newer = regex.compile(f"[{newer}]").search
        older = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"(?:[^\\s\\p{{L}}\\p{{N}}]|[{newer}])")
        for kind in (r"\p{L}", r"\p{N}"):
            older = older.replace(f" ?{kind}+", f" ?(?:(?![{newer}]){kind})+")
        self.usual_chunks = regex.compile(PATTERN).findall
        self.older_chunks = regex.compile(older).findall
        special = [token["content"] for token in described.get("added_tokens", ())]
        longest_first = sorted(map(regex.escape, special), key=len, reverse=True)
        self.special = regex.compile("|".join(longest_first)) if special else None
        self.hints = special
        self.counts = Remembered(self._count)

    def _count(self, chunk: str) -> int:
        data = chunk.encode("utf-8", "surrogatepass")
        first = self.first
        return len(data) - merge([first[byte] for byte in data], self.pairs)

    def chunks(self, text: str) -> list[str]:
        return self.older_chunks(text) if not text.isascii() and self.newer(text) else self.usual_chunks(text)

    def count(self, text: str) -> int:
        total, parts = 0, (text,)
        if self.special and any(hint in text for hint in self.hints):
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            total += sum(map(self.counts.__getitem__, self.chunks(part)))
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> ByteCounter:
    """One per vocabulary and worker process."""
    return ByteCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit. `path` names the file on every executor."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text"))
    kinds = rows.select("doc_id", *[F.lit(0).cast("long").alias(name) for name in ("n_bytes", "n_tokens")]).schema

    def run(batches):
        table = counter(path)
        begin_task(table.counts)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for texts in portions(batch.column("text").to_pylist()):
                n_bytes += [len(text.encode()) for text in texts]
                n_tokens += map(table.count, texts)
                table.counts.trim()
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()),
                                              "n_tokens": pa.array(n_tokens, pa.int64())})

    return rows.mapInArrow(run, kinds).withColumn("over_limit", F.col("n_tokens") > limit)
