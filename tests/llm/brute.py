"""Plain loops that say what the operators must give, and awkward documents."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
    T.StructField("class", T.StringType()), T.StructField("key", T.StringType()), T.StructField("n_words", T.StringType()),
])
_PASSAGE = " ".join(f"Wort{i * i % 97} über{i}" for i in range(60))


#: Two words of the letters a and b, each by the parity of the bits of its place: polynomials modulo 2**64 give them one hash.
EVEN = "".join("ab"[i.bit_count() % 2] for i in range(4096))
ODD = EVEN.translate({97: 98, 98: 97})


def _row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", len(text or ""), "k", "c", "y", "w")


def awkward():
    """Null and empty texts and ids, repeated rows, ties, odd white space and scripts, a long text, shared passages."""
    long = " ".join(f"w{i * 7919 % 9973}" for i in range(30_000))
    return [
        _row(1, None), _row(2, ""), _row(3, " \n\t "), _row(4, "one"), _row(5, "one"), _row(6, "ONE two"), _row(7, "one  TWO"),
        _row(8, long), _row(9, long + " end"), _row(10, _PASSAGE), _row(11, "start " + _PASSAGE + " end"), _row(11, "start " + _PASSAGE + " end"),
        _row(12, _PASSAGE + "\n" + _PASSAGE, None), _row(None, "x " + _PASSAGE), _row(None, None), _row(13, "same\nsame\nother\n\nsame"),
        _row(14, "日本 語の テキスト <|endoftext|> ẞ İ   \x1c x"), _row(15, "a b c a b c a b c"), _row(16, "aaaa" * 300), _row(17, "aaaa" * 300 + "b"),
        _row(18, "it's they're 'x' l'eau d'un 12's 3.14 %%% <b>"), _row(19, "é" * 250), _row(20, "ÀB cd " * 90, "fr"), _row(20, "another text of the same id", "fr"),
        *[_row(30 + k, f"{word[:1024]} {_PASSAGE} {' '.join(f'p{i}' for i in range(49))} {word[:1024]}") for k, word in enumerate((EVEN, ODD))],
        *[_row(32 + k, " ".join(f"u{word[i]}" for i in range(64))) for k, word in enumerate((EVEN, ODD))],
        _row(34, EVEN), _row(35, ODD), _row(36, f"{EVEN}\n{ODD}\n{EVEN}\nx"), _row(37, f"{ODD[:1024]}\n{EVEN[:1024]}"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words(text):
    return WORD.findall(text or "")


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    own = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(zip(own, own[1:], own[2:]))
    hit = [False] * len(own)
    for i in range(len(own) - 2):
        if grams[tuple(own[i:i + 3])] > 1:
            hit[i:i + 3] = [True] * 3
    return len(own), sum(map(len, own)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(hit)


def passages(docs, length):
    """For (doc_id, text): words, removed words and the words that stay, in order of the rows given."""
    first = {}
    rank = lambda i: float("inf") if i is None else i
    for doc_id, text in docs:
        own = words(text)
        for k in range(len(own) - length + 1):
            gram = tuple(own[k:k + length])
            first[gram] = min(first.get(gram, float("inf")), rank(doc_id))
    out = []
    for doc_id, text in docs:
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - length + 1):
            if first[tuple(own[k:k + length])] < rank(doc_id):
                gone[k:k + length] = [True] * length
        out.append((doc_id, len(own), sum(gone), [w for w, g in zip(own, gone) if not g]))
    return out


def bytes_left(docs, length):
    """For (doc_id, text): bytes, removed bytes, removed runs and what stays."""
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in docs]
    for _, data in texts:
        seen.update(data[k:k + length] for k in range(len(data) - length + 1))
    out = []
    for doc_id, data in texts:
        gone = [False] * len(data)
        until = 0
        for k in range(len(data) - length + 1):
            if seen[data[k:k + length]] > 1:
                for j in range(max(k, until), k + length):
                    gone[j] = True
                until = k + length
        runs = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((doc_id, len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def shingles(text, size):
    own = [w.decode() for w in (text or "").encode().lower().split()]
    if len(own) < size:
        return frozenset([tuple(own)] if own else [])
    return frozenset(zip(*[own[k:] for k in range(size)]))


def groups(docs, size, percent):
    """Shingles and smallest linked id for each (doc_id, text); rows of an id are one node, null ids count for nothing."""
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(docs)]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
