"""Token counts that follow edits: only what an edit touches is encoded again.

The state of a document is its text and a segment tree. A leaf is a run of whole pre-tokens and
holds its characters and tokens; inner nodes hold the sums of their subtrees, so the root is the count of the document.

An edit is found by walking down the tree. Pre-tokens are cut again from the whole leaf before the one it touches, because
where a pre-token ends depends on the characters behind it, and until a cut beyond the edit
falls on an old boundary: from there on the text and thus the cuts are as before, since the pattern never looks back. The new
pre-tokens are encoded and dealt out over the leaves they replace; sums change on the paths from these leaves to the
root only.

Edits of a document are (start, stop, replacement) in code points of the text before any of them. Those that overlap
an earlier one (by start, then stop) lose the part it covers; places beyond the end count as the end; a NULL replacement deletes. NULL texts count as empty and stay so
unless something is inserted; NULL edits are none; repeated rows are counted alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import RANKS, codec
from ledgerloom.llm.common import map_rows, texts_of

# Pre-tokens in a leaf when a tree is built.
LEAF = 16
# Pre-tokens whose counts one Python process remembers.
REMEMBERED = 500_000
# Characters behind an edit that are looked at first, and characters behind a match that its end may depend on.
WINDOW = 256
LOOKAHEAD = 8
# New pre-tokens that wait to be counted together, a window more at most.
COUNTED_AT_ONCE = 100_000

EDITS = "array<struct<start:int,stop:int,replacement:string>>"


class Counts(dict):
    """Tokens of pre-tokens, learned many at a time."""

    def __init__(self, path: str, pattern: str, most: int = REMEMBERED):
        self.codec, self.most = codec(path, pattern), most
        self.passing: dict[str, int] = {}

    def __missing__(self, pre_token: str) -> int:
        return self.passing[pre_token]

    def split(self, text: str) -> list[str]:
        return self.codec.pattern.findall(text)

    def learn(self, pre_tokens) -> None:
        new = [p for p in set(pre_tokens) if p not in self]
        if not new:
            return
        found = dict(zip(new, self.codec.sizes(new)))
        if len(self) < self.most:
            self.update(found)
            self.passing = {}
        else:
            self.passing = found

    def of(self, pre_tokens: Sequence[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, pre_tokens), np.int64, len(pre_tokens))


@lru_cache(2)
def counts_of(path: str, pattern: str) -> Counts:
    return Counts(path, pattern)


class Tree:
    """Characters (row 0) and tokens (row 1) of leaves and of all subtrees; the root is node 1."""

    def __init__(self, sums: np.ndarray):
        self.sums = sums
        self.leaves = sums.shape[1] // 2

    @classmethod
    def build(cls, characters: np.ndarray, tokens: np.ndarray, leaf: int = LEAF) -> Tree:
        n = max(1, -(-len(characters) // leaf))
        size = 1 << (n - 1).bit_length()
        sums = np.zeros((2, 2 * size), np.int32)
        if len(characters):
            starts = np.arange(0, len(characters), leaf)
            sums[:, size : size + n] = np.add.reduceat(np.stack([characters, tokens]), starts, axis=1)
        while size > 1:
            sums[:, size // 2 : size] = sums[:, size : 2 * size : 2] + sums[:, size + 1 : 2 * size : 2]
            size //= 2
        return cls(sums)

    @classmethod
    def load(cls, raw: bytes) -> Tree:
        return cls(np.frombuffer(raw, "<i4").reshape(2, -1).copy())

    def dump(self) -> bytes:
        return self.sums.astype("<i4").tobytes()

    @property
    def characters(self) -> int:
        return int(self.sums[0, 1])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place``, and where it starts; the end is the place behind the last leaf."""
        if place >= self.characters:
            return self.leaves, self.characters
        node, start, sizes = 1, 0, self.sums[0]
        while node < self.leaves:
            node *= 2
            if place >= start + sizes[node]:
                start += int(sizes[node])
                node += 1
        return node - self.leaves, start

    def replace(self, row: int, first: int, stop: int, values: np.ndarray) -> None:
        """Characters or tokens of new pre-tokens for the leaves from ``first`` to before ``stop``, and new sums above them."""
        n, sums = stop - first, self.sums[row]
        place = np.arange(len(values)) * n // max(1, len(values))
        low, high = first + self.leaves, stop - 1 + self.leaves
        sums[low : high + 1] = np.bincount(place, values, n)
        while low > 1:
            low, high = low // 2, high // 2
            sums[low : high + 1] = sums[2 * low : 2 * high + 2].reshape(-1, 2).sum(axis=1)


def tidy(edits: Sequence[dict] | None, size: int) -> list[tuple[int, int, str]]:
    """Edits in order, without overlaps, within the text."""
    found, free = [], 0
    inside = [(e["start"] or 0, e["stop"] if e["stop"] is not None else e["start"] or 0, e["replacement"] or "") for e in edits or () if e]
    for start, stop, replacement in sorted(inside):
        start = min(max(start, free), size)
        stop = min(max(stop, start), size)
        found.append((start, stop, replacement))
        free = stop
    return found


def _front(pieces: Sequence[str], size: int) -> tuple[str, bool]:
    """At least the first ``size`` characters of a text kept as pieces, the last one in front, and whether that is all of it."""
    found, n = [], 0
    for piece in reversed(pieces):
        if n >= size:
            return "".join(found)[:size], False
        found.append(piece)
        n += len(piece)
    return "".join(found)[:size], n <= size


# A tree, its leaves from the first to before the last, and the new pre-tokens of these.
Recut = tuple[Tree, int, int, list[str]]


def _recut(before: str, tree: Tree, start: int, stop: int, replacement: str, pieces: Sequence[str], counts: Counts) -> tuple[Recut, int]:
    """Change the characters in the tree for one edit of a text whose first ``start`` characters are those of ``before``.

    ``pieces`` is the text behind ``stop``. Only a window around the edit is put together; it grows until the cuts
    behind the edit fall on an old boundary. What is left to be counted and the number of characters encoded again are returned.
    """
    leaf, low = tree.find(max(0, start - 1))
    if low > 0:
        leaf, low = tree.find(low - 1)
    if leaf == tree.leaves:
        leaf = tree.leaves - 1
    grown, edited, size = len(replacement) - (stop - start), start + len(replacement), WINDOW
    head = before[low:start] + replacement
    while True:
        ahead, is_all = _front(pieces, size)
        window = head + ahead
        # where a match ends depends on some characters behind it
        trusted = len(window) if is_all else len(window) - LOOKAHEAD
        pre_tokens, at, last = [], low, None
        for match in counts.codec.pattern.finditer(window):
            if match.end() > trusted:
                break
            pre_tokens.append(match.group())
            at = low + match.end()
            if at >= edited and at - grown >= stop:
                beyond, boundary = tree.find(at - grown)
                if boundary == at - grown and beyond > leaf:
                    last = beyond
                    break
        if last is not None or is_all:
            break
        size *= 4
    end = tree.leaves if last is None else last
    tree.replace(0, leaf, end, np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens)))
    return (tree, leaf, end, pre_tokens), at - low


def _count(recuts: Sequence[Recut], counts: Counts) -> None:
    """The tokens of new pre-tokens in their trees, in the order of the edits; those of many edits and trees are learned together."""
    counts.learn(set().union(*(pre_tokens for *_, pre_tokens in recuts)))
    for tree, leaf, end, pre_tokens in recuts:
        tree.replace(1, leaf, end, counts.of(pre_tokens))


def edit_each(
    texts: Sequence[str], trees: Sequence[Tree], changes: Sequence[Sequence[tuple[int, int, str]]], counts: Counts
) -> tuple[list[str], list[int]]:
    """The texts after edits in order and without overlaps, whose trees are changed in place, and the numbers of characters encoded again.

    Edits are made from the back, so that places are those of the text before; a text is put together once.
    """
    edited, again, recuts, waiting = [], [], [], 0
    for text, tree, own in zip(texts, trees, changes):
        pieces, free, n = [], len(text), 0
        for start, stop, replacement in reversed(own):
            pieces.append(text[stop:free])
            recut, size = _recut(text, tree, start, stop, replacement, pieces, counts)
            recuts.append(recut)
            waiting += len(recut[-1])
            if waiting >= COUNTED_AT_ONCE:
                _count(recuts, counts)
                recuts, waiting = [], 0
            n += size
            pieces.append(replacement)
            free = start
        pieces.append(text[:free])
        edited.append("".join(reversed(pieces)))
        again.append(n)
    _count(recuts, counts)
    return edited, again


def edit_all(text: str, tree: Tree, changes: Sequence[tuple[int, int, str]], counts: Counts) -> tuple[str, int]:
    """The same for one text."""
    edited, again = edit_each([text], [tree], [changes], counts)
    return edited[0], again[0]


def edit(text: str, tree: Tree, start: int, stop: int, replacement: str, counts: Counts) -> tuple[str, int]:
    """The same for one edit of one text."""
    return edit_all(text, tree, [(start, stop, replacement)], counts)


def build(
    df: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``keep`` and the state of every document: text, tree (binary) and n_tokens."""

    def run(part):
        counts = counts_of(path, pattern)
        texts = texts_of(part.column("_0"))
        split = [counts.split(t) for t in texts]
        counts.learn(set().union(*split))
        trees = [Tree.build(np.fromiter(map(len, s), np.int64, len(s)), counts.of(s)) for s in split]
        return [texts, [t.dump() for t in trees], [t.tokens for t in trees]]

    return map_rows(df, [F.col(text).cast("string")], keep, "text string, tree binary, n_tokens long", run)


def apply_edits(
    state: DataFrame,
    edits: str | Column = "edits",
    keep: Sequence[str] = ("doc_id",),
    path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """The state after the edits in a column of type ``EDITS``, and n_edits and n_reencoded (characters)."""

    def run(part):
        counts = counts_of(path, pattern)
        texts, raw, given = (part.column(f"_{i}").to_pylist() for i in range(3))
        trees, changes = list(map(Tree.load, raw)), [tidy(edits, len(text)) for edits, text in zip(given, texts)]
        texts, again = edit_each(texts, trees, changes, counts)
        return [texts, [t.dump() for t in trees], [t.tokens for t in trees], list(map(len, changes)), again]

    fields = "text string, tree binary, n_tokens long, n_edits long, n_reencoded long"
    given = F.col(edits) if isinstance(edits, str) else edits
    return map_rows(state, ["text", "tree", given.cast(EDITS)], keep, fields, run)


def gathered(edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """A table of edits (key, start, stop, replacement) as one column ``edits`` per key, to be joined with a state."""
    one = F.struct(*[F.col(c) for c in ("start", "stop", "replacement")])
    return edits.groupBy(key).agg(F.collect_list(one).cast(EDITS).alias("edits"))
