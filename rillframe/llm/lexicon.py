"""BPE encoding through a transducer of frequent words, and decoding.

Spark counts the words of all texts. The ``WORDS`` most frequent are compiled into a minimal acyclic automaton:
words share prefixes and suffixes, and sums along a path number the words, which is where their ids are found. The
automaton is one file in the shared folder that tasks map into memory; a block's words walk through it together, a
character each step. A word that it does not have is merged by the tokenizer's own model, so ids are exact whatever
the lexicon holds: its size bounds memory and costs only time. Texts that only the library may split (see ``bpe``)
are encoded by it and not counted.

Null texts are empty: no ids. Every row gives a row, repeated ones too; other columns of the input do not pass.

File, little-endian: 6 numbers of 64 bits (MAGIC, states, symbols, words, ids, 0); 592 numbers of 32 bits, the symbol
of each character, 0 for none; for each state and symbol the next state, 0 for none, and how many words come before;
a byte for each state, padded to 8, that says whether a word ends there; words + 1 numbers of 64 bits, where each
word's ids begin; the ids, 32 bits each.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rillframe.llm.bpe import LATIN, Encoder, encoder, gather, split
from rillframe.llm.store import get, lean, new_folder, put, settled
from rillframe.llm.words import slices, unpacked

MAGIC = 0x3158454C49525254
WORDS = 50_000
TALLY = 300_000  # words that a task counts before it sends them


def counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(word, count) over all texts, counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tally = encoder(tokenizer), Counter()
        for batch in slices(batches):
            block = split([t or "" for t in batch.column("text").to_pylist()], bool(own.lower), own.added)
            n = np.bincount(block.which, minlength=len(block.words))
            for k, word in zip(n.tolist(), block.spelled(np.arange(len(block.words)))):
                tally[word] += k
            if len(tally) > TALLY:
                yield pa.RecordBatch.from_pydict({"word": list(tally), "n": list(tally.values())})
                tally = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(tally.keys(), pa.string()), pa.array(tally.values(), pa.int64())], names=["word", "n"])

    return lean(docs, "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("count"))


def minimal(words: list[list[int]]) -> tuple[list[dict[int, int]], list[bool]]:
    """Transitions and final flags of the smallest automaton for sorted distinct symbol lists. State 1 is the start.

    Words come in order, so once a word leaves a path, the states it left can no longer change: each is replaced by
    an equal one if there is one.
    """
    edges, final = [{}, {}], [False, False]
    known: dict[tuple, int] = {}
    path = [1]
    before: list[int] = []

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            form = (final[state], tuple(edges[state].items()))
            edges[path[-1]][before[len(path) - 1]] = known.setdefault(form, state)

    for word in words:
        same = next((i for i, (a, b) in enumerate(zip(word, before)) if a != b), min(len(word), len(before)))
        settle(same)
        for symbol in word[same:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][symbol] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        before = word
    settle(0)
    return edges, final


def compile_words(words: list[str], own: Encoder) -> list[np.ndarray]:
    """The parts of the file for words of characters below LATIN."""
    alphabet = sorted({c for w in words for c in w})
    symbol = np.zeros(LATIN, np.int32)
    symbol[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
    of = {c: i + 1 for i, c in enumerate(alphabet)}
    listed = sorted(([of[c] for c in w], w) for w in words)
    edges, final = minimal([s for s, _ in listed])

    live, number, order = {1: 1}, 2, [1]  # states that are reached, numbered anew
    for state in order:
        for after in edges[state].values():
            if after not in live:
                live[after], number = number, number + 1
                order.append(after)
    size = {}
    for state in reversed(_by_depth(edges, order)):
        size[state] = final[state] + sum(size[after] for after in edges[state].values())
    step = np.zeros((number, len(alphabet) + 1), np.int32)
    skip = np.zeros_like(step)
    ends = np.zeros(-(-number // 8) * 8, np.uint8)
    for state in order:
        ends[live[state]] = final[state]
        passed = int(final[state])
        for s, after in sorted(edges[state].items()):
            step[live[state], s], skip[live[state], s] = live[after], passed
            passed += size[after]
    ids, bounds = own.merged([w for _, w in listed]) if listed else (np.zeros(0, np.uint32), np.zeros(1, np.int64))
    header = np.array([MAGIC, number, len(alphabet) + 1, len(listed), len(ids), 0], np.int64)
    return [header, symbol, step, skip, ends, bounds.astype(np.int64), ids.astype("<u4")]


def _by_depth(edges: list[dict[int, int]], states: list[int]) -> list[int]:
    """States so that each stands before those it leads to."""
    waiting = dict.fromkeys(states, 0)
    for state in states:
        for after in edges[state].values():
            waiting[after] += 1
    ready, out = [1], []
    while ready:
        out.append(state := ready.pop())
        for after in edges[state].values():
            waiting[after] -= 1
            if not waiting[after]:
                ready.append(after)
    return out


def build(docs: DataFrame, tokenizer: str, words: int = WORDS) -> str:
    """Compile the most frequent words of all texts; the address of the file.

    Words with equal counts are taken or left together, so that ``words`` are not exceeded. What comes to the driver
    is the lexicon, whatever the size of the table.
    """
    own = encoder(tokenizer)
    if own.lower is None:
        frequent = []
    else:
        counted = settled(counts(docs, tokenizer))
        by_count = counted.groupBy("count").agg(F.count("*").alias("n"))
        running = by_count.withColumn("total", F.sum("n").over(Window.orderBy(F.desc("count"))))
        least = running.where(F.col("total") <= words).agg(F.min("count")).collect()[0][0]
        frequent = [r["word"] for r in counted.where(F.col("count") >= least).select("word").collect()] if least else []
    path = f"{new_folder(docs.sparkSession, 'lexicon')}/words.fst"
    put(path, (x.data.cast("B") for x in map(np.ascontiguousarray, compile_words(frequent, own)) if x.size))
    return path


class Lexicon:
    """A compiled file, mapped into memory."""

    def __init__(self, path: str):
        buffer = get(path)
        magic, states, symbols, words, ids, _ = np.frombuffer(buffer, np.int64, 6).tolist()
        if magic != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        at = 48

        def part(kind, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(buffer, kind, count, at) if count else np.zeros(0, kind)
            at += count * np.dtype(kind).itemsize
            return found

        self.symbol = part(np.int32, LATIN)
        self.step = part(np.int32, states * symbols).reshape(states, symbols)
        self.skip = part(np.int32, states * symbols).reshape(states, symbols)
        self.ends = part(np.uint8, -(-states // 8) * 8)
        self.bounds = part(np.int64, words + 1)
        self.ids = part("<u4", ids)

    def numbers(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for one that is not in the lexicon."""
        state, number = np.ones(len(starts), np.int64), np.zeros(len(starts), np.int64)
        live, at = np.arange(len(starts)), starts.copy()
        while len(live):
            live = live[(at[live] < ends[live]) & (state[live] > 0)]
            symbol = self.symbol[points[at[live]]]
            number[live] += self.skip[state[live], symbol]
            state[live] = self.step[state[live], symbol]
            at[live] += 1
        return np.where((state > 0) & (self.ends[state] > 0), number, -1)


_LEXICONS: dict[str, Lexicon] = {}


def encode(texts: list[str | None], tokenizer: str, path: str) -> list[np.ndarray]:
    """The ids of each text, as the library gives them."""
    if path not in _LEXICONS:
        _LEXICONS.clear()
        _LEXICONS[path] = Lexicon(path)
    own, lexicon = encoder(tokenizer), _LEXICONS[path]
    texts = [t or "" for t in texts]
    if own.lower is None:
        return own.encode(texts)
    block = split(texts, own.lower, own.added)
    letters, edges = unpacked(block.words, np.uint16)
    number = lexicon.numbers(np.minimum(letters, LATIN - 1), edges[:-1], edges[1:])
    seen, other = number >= 0, np.flatnonzero(number < 0)
    values, begin, end = lexicon.ids, np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    begin[seen], end[seen] = lexicon.bounds[number[seen]], lexicon.bounds[number[seen] + 1]
    if len(other):
        more, edges = gather(*own.known(block, other))
        values = np.concatenate([values, more])
        begin[other], end[other] = edges[:-1] + len(lexicon.ids), edges[1:] + len(lexicon.ids)
    ids, edges = gather(values, begin[block.which], end[block.which])
    cuts = edges[block.edges].tolist()
    rows = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
    left = np.flatnonzero(block.whole).tolist()
    for row, found in zip(left, own.library.encode_batch([texts[r] for r in left], add_special_tokens=False)):
        rows[row] = np.array(found.ids, "<u4")
    return rows


class Decoder:
    """Texts from ids, special tokens kept: the vocabulary's entries, joined by a space if the file has no decoder."""

    def __init__(self, tokenizer: str):
        self.library = encoder(tokenizer).library
        size = max(self.library.get_vocab(with_added_tokens=True).values()) + 1
        self.tokens = [self.library.id_to_token(i) or "" for i in range(size)] if self.library.decoder is None else None

    def __call__(self, ids: np.ndarray) -> str:
        if self.tokens is None:
            return self.library.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


_DECODERS: dict[str, Decoder] = {}


def decode(ids: np.ndarray, tokenizer: str) -> str:
    if tokenizer not in _DECODERS:
        _DECODERS[tokenizer] = Decoder(tokenizer)
    return _DECODERS[tokenizer](ids)


def encoded(docs: DataFrame, tokenizer: str, path: str) -> DataFrame:
    """(doc_id, ids) of every text."""
    return _over(docs, tokenizer, path, "doc_id long, ids array<int>", lambda ids: (pa.array(list(map(np.int32, ids)), pa.list_(pa.int32())),))


def digests(docs: DataFrame, tokenizer: str, path: str) -> DataFrame:
    """Checksums of every text's ids and of what they decode to: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    hashed = lambda texts: pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
    decimal = [str(i) for i in range(len(encoder(tokenizer).library.get_vocab()) + 1)]

    def columns(ids: list[np.ndarray]) -> tuple:
        return (pa.array([len(x) for x in ids], pa.int64()), hashed(" ".join(map(decimal.__getitem__, x.tolist())) for x in ids),
                hashed(decode(x, tokenizer) for x in ids))

    return _over(docs, tokenizer, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def _over(docs: DataFrame, tokenizer: str, path: str, schema: str, columns) -> DataFrame:
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = columns(encode(batch.column("text").to_pylist(), tokenizer, path))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *made], names=names)

    return lean(docs, "doc_id", "text").mapInArrow(run, schema)
