"""Personal data in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns find emails, IP addresses, payment cards and phone numbers, leftmost and without overlap within a kind;
a match that fails its check is dropped without another try. The random field reads the words around every word with
a digit or an at sign, as shapes, and labels them (`crf`); it is trained from the small table in `pii_examples` on
the driver, and its weights are sent to the tasks, which decode all sequences of a batch at once. Its spans are added
where they overlap no span of the patterns, such as phone numbers without a country code or emails written with
`[at]`. Spans of the patterns always stay.

Words without a digit or at sign, and more than CONTEXT words away from one, are outside every sequence and never
part of a span. A null text counts as empty and has no spans. Whole texts are read in time that grows with their
length, also where a word is very long. Repeated rows are treated alike; an empty table gives an empty result. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .crf import buckets, train, viterbi
from .pii_examples import EXAMPLES, KINDS
from .shipping import ship
from .words import text_of

CONTEXT = 2
LABELS = ("O", *(f"{mark}-{kind}" for kind in KINDS for mark in "BI"))

# The patterns. An email is looked for from its at sign: its first part is all that may stand before it.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
# A run of digits is one try: a match that begins within a run could only begin where the run's first digit failed.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}").finditer
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_NO_DIGIT = re.compile(r"[^0-9]+")
_HINT = re.compile(r"[0-9@]").search
_MARKED = re.compile(r"[0-9@]|[\[(]at[\])]").search
_WORD = re.compile(r"\S+")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    spans = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN(text, at + 1) if start < at else None
        if found:
            done = found.end()
            spans.append((0, start, done))
        at = text.find("@", max(at + 1, done))
    if not _HINT(text):
        return spans
    for found in _IP(text):
        parts = [part.lstrip("0") for part in found[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            spans.append((1, *found.span()))
    for found in _CARD(text):
        if found.end() - found.start() >= 12:
            digits = _NO_DIGIT.sub("", found[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *found.span()))
    if "+" in text:
        for found in _PHONE(text):
            if 9 <= len(_NO_DIGIT.sub("", found[0])) <= 15:
                spans.append((3, *found.span()))
    return spans


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words, as (start, end), that hold a marked word or stand within CONTEXT words of one."""
    words = [found.span() for found in _WORD.finditer(text)]
    found: list[list[tuple[int, int]]] = []
    taken = 0  # words before this place are in a run or too far from one
    for place, (start, end) in enumerate(words):
        if _MARKED(text, start, end):
            first = max(taken, place - CONTEXT)
            if not found or first > taken or not taken:
                found.append([])
            stop = min(len(words), place + CONTEXT + 1)
            found[-1] += words[first:stop]
            taken = stop
    return found


def shape(word: str) -> str:
    """The word with letters as x or X and digits as 0; runs of letters count once."""
    plain = re.sub(r"[0-9]", "0", word)
    return re.sub(r"X+", "X", re.sub(r"x+", "x", re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", plain)))


def features(words: list[str]) -> list[list[str]]:
    trimmed = [word.strip("\"'<>,.;:!?") for word in words]
    shapes = [shape(word) for word in trimmed]
    rows = []
    for i, word in enumerate(trimmed):
        digits = sum(map(str.isdigit, word))
        row = ["one", "s=" + shapes[i], f"n={min(digits, 20)}", "a=" + shapes[i][:2], "z=" + shapes[i][-2:],
               f"at={'@' in word}{word.count('@')}", f"dots={word.count('.')}", f"dash={word.count('-')}",
               f"long={min(len(word) // 8, 5)}", f"mixed={digits > 0 and any(map(str.isalpha, word))}"]
        if 12 <= digits <= 19 and digits == len(word):
            row.append(f"luhn={word.isascii() and luhn(word)}")
        for step in (-1, 1):
            near = shapes[i + step] if 0 <= i + step < len(words) else "none"
            row += [f"s{step}={near}", f"ss{step}={near}|{shapes[i]}"]
            if 0 <= i + step < len(words) and len(trimmed[i + step]) <= 8 and trimmed[i + step].isalpha():
                row.append(f"w{step}={trimmed[i + step].lower()}")
        rows.append(row)
    return rows


def labelled() -> tuple[list, list]:
    """The table as sequences of features and labels."""
    inputs, labels = [], []
    for line in EXAMPLES.strip().splitlines():
        words, tags, kind = [], [], None
        for word in line.split():
            opened = re.match(r"<(\w+)>", word)
            if opened:
                kind, word = opened[1], word[opened.end():]
            bare = re.sub(r"</\w+>", "", word)
            words.append(bare)
            tags.append(LABELS.index(f"{'B' if opened else 'I'}-{kind}") if kind else 0)
            if bare != word:
                kind = None
        inputs.append([buckets(row) for row in features(words)])
        labels.append(tags)
    return inputs, labels


def trained() -> tuple[np.ndarray, np.ndarray]:
    inputs, labels = labelled()
    return train(inputs, labels, len(LABELS))


def field_spans(texts: list[str], weights: np.ndarray, moves: np.ndarray) -> list[list[Span]]:
    """What the random field finds in each text; all sequences of the batch are decoded together."""
    places, inputs = [], []
    for row, text in enumerate(texts):
        if not _MARKED(text):
            continue
        for run in sequences(text):
            places.append((row, run))
            inputs.append([buckets(f) for f in features([text[a:b] for a, b in run])])
    found: list[list[Span]] = [[] for _ in texts]
    # Short sequences share a batch; padding is then at most twofold.
    order = sorted(range(len(inputs)), key=lambda i: len(inputs[i]))
    while order:
        longest = 2 * len(inputs[order[0]])
        part = [i for i in order if len(inputs[i]) <= longest][:4096]
        order = order[len(part):]
        for i, tags in zip(part, viterbi(weights, moves, [inputs[i] for i in part]), strict=True):
            row, run = places[i]
            found[row] += _spans(texts[row], run, tags)
    return found


def _spans(text: str, run: list[tuple[int, int]], tags) -> list[Span]:
    spans, place = [], 0
    while place < len(run):
        kind = (int(tags[place]) - 1) // 2
        if tags[place] == 0:
            place += 1
            continue
        start, end = run[place]
        place += 1
        while place < len(run) and tags[place] == 2 * kind + 2:
            end = run[place][1]
            place += 1
        while start < end and text[start] in "\"'<,;:!?":
            start += 1
        while end > start and text[end - 1] in "\"'>,.;:!?":
            end -= 1
        if start < end:
            spans.append((kind, start, end))
    return spans


def find_spans(texts: list[str], weights: np.ndarray, moves: np.ndarray) -> list[tuple[list[Span], list[Span]]]:
    """Per text the spans of the patterns, and all spans; both by start, then kind."""
    results = []
    for text, extra in zip(texts, field_spans(texts, weights, moves), strict=True):
        base = sorted(pattern_spans(text), key=lambda s: (s[1], s[0]))
        more = [s for s in extra if not any(s[1] < b[2] and b[1] < s[2] for b in base)] if extra else []
        results.append((base, sorted(base + more, key=lambda s: (s[1], s[0])) if more else base))
    return results


def written(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the number of pattern spans by kind, base_sha256 (of the pattern spans as text), spans
    (all spans as kind:start:end in code points, end exclusive) and n_added."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(trained())
    rows = docs.select("doc_id", text_of().alias("text"))
    kinds = rows.select("doc_id", *[F.lit(0).cast("long").alias(f"n_{kind}") for kind in KINDS],
                        F.lit("").alias("base_sha256"), F.lit("").alias("spans"),
                        F.lit(0).cast("long").alias("n_added")).schema

    def run(batches):
        for batch in batches:
            found = find_spans(batch.column("text").to_pylist(), *model.value)
            columns = {"doc_id": batch.column("doc_id")}
            for i, kind in enumerate(KINDS):
                columns[f"n_{kind}"] = pa.array([sum(s[0] == i for s in base) for base, _ in found], pa.int64())
            digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            columns["base_sha256"] = pa.array(digests, pa.string())
            columns["spans"] = pa.array([written(every) for _, every in found], pa.string())
            columns["n_added"] = pa.array([len(every) - len(base) for base, every in found], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, kinds)


def redact(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and its text with every span replaced by its kind in brackets."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(trained())
    rows = docs.select("doc_id", text_of().alias("text"))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            hidden = []
            for text, (_, every) in zip(texts, find_spans(texts, *model.value), strict=True):
                parts, at = [], 0
                for kind, start, end in every:
                    if end > at:
                        parts += [text[at:max(at, start)], f"[{KINDS[kind]}]"]
                        at = end
                hidden.append("".join(parts) + text[at:])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(hidden, pa.string())})

    return rows.mapInArrow(run, rows.schema)
