"""Token counts that follow edits.

A document's pre-tokens lie in the leaves of a segment tree: runs of whole pre-tokens with their length
and their number of tokens, and above them the sums. An edit touches the leaves its range (and two code
points around it, as far as the splitting pattern looks) lies in: only these are put together, changed,
cut and encoded again, and the sums above them are renewed. The other leaves, their texts included, are not
touched. New pieces take the places of the old ones; only where one would grow beyond ``SLACK`` leaves is the
tree laid out anew, from the known counts.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Sequence

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.shipping import ship_with_tasks
from tidemark.llm.common import wrapped

ship_with_tasks(__name__)

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 1_000
CONTEXT = 2
SLACK = 4  # a leaf may grow to this many times its size
# A pre-token always ends between a visible character and a single space before another visible one.
_CUT = re.compile(r"(?<=\S) (?=\S)")
# A longer piece without such a place (one word, or white space only) stays one leaf.


_ENCODERS: dict[str, tiktoken.Encoding] = {}


def encoder(vocabulary: str) -> tiktoken.Encoding:
    """The encoding of a vocabulary file, read once a task."""
    if vocabulary not in _ENCODERS:
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[vocabulary] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[vocabulary]


def cut(text: str, leaf: int = LEAF) -> list[str]:
    """Pieces of at least ``leaf`` code points that begin where a pre-token begins."""
    out, first = [], 0
    while first < len(text):
        place = _CUT.search(text, first + leaf)
        last = place.start() if place else len(text)
        out.append(text[first:last])
        first = last
    return out


class Tree:
    """Sums of lengths and tokens over leaves: two complete binary trees in arrays, the root at 1."""

    def __init__(self, lengths: list[int], tokens: list[int]):
        self.build(lengths, tokens)

    def build(self, lengths: list[int], tokens: list[int]) -> None:
        self.n = len(lengths)
        self.size = 1
        while self.size < max(1, self.n):
            self.size *= 2
        self.length = [0] * (2 * self.size)
        self.tokens = [0] * (2 * self.size)
        self.length[self.size:self.size + self.n] = lengths
        self.tokens[self.size:self.size + self.n] = tokens
        for node in range(self.size - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.length[node] = self.length[2 * node] + self.length[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds code point ``at`` (the last leaf for the end of the text) and where it begins."""
        node, begin = 1, 0
        at = min(at, self.length[1] - 1)
        while node < self.size:
            node *= 2
            if at - begin >= self.length[node]:
                begin += self.length[node]
                node += 1
        return node - self.size, begin

    def replace(self, first: int, lengths: list[int], tokens: list[int]) -> None:
        """The leaves from ``first`` become the given ones; only the sums above them are renewed."""
        touched = set()
        for k, (n, t) in enumerate(zip(lengths, tokens)):
            node = self.size + first + k
            self.length[node], self.tokens[node] = n, t
            touched.add(node // 2)
        while touched - {0}:
            for node in touched:
                self._sum(node)
            touched = {node // 2 for node in touched if node > 1}


def digest_of(text: str) -> int:
    """64 bits that tell whether a stored tree belongs to a text."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


class Counted:
    """A text as the leaves of its tree. ``encoded`` counts the code points that were encoded so far."""

    def __init__(self, text: str, vocabulary: str = VOCABULARY, leaf: int = LEAF, state: tuple[list[int], list[int]] | None = None):
        self.leaf, self.encoded = leaf, 0
        self.encode = encoder(vocabulary).encode_ordinary
        if state is None:
            self.leaves = cut(text, leaf)
            self.tree = Tree([len(p) for p in self.leaves], self._count(self.leaves))
        else:
            self.leaves, at = [], 0
            for n in state[0]:
                self.leaves.append(text[at:at + n])
                at += n
            self.tree = Tree(*state)

    def _count(self, pieces: list[str]) -> list[int]:
        self.encoded += sum(map(len, pieces))
        return [len(self.encode(p)) for p in pieces]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    @property
    def tokens(self) -> int:
        return self.tree.tokens[1]

    @property
    def state(self) -> tuple[list[int], list[int]]:
        own = slice(self.tree.size, self.tree.size + self.tree.n)
        return self.tree.length[own], self.tree.tokens[own]

    def edit(self, at: int, deleted: int, inserted: str) -> int:
        """Replace ``deleted`` code points from ``at`` by ``inserted``; returns the pieces encoded again."""
        whole = self.tree.length[1]
        at = max(0, min(at, whole))
        end = max(at, min(at + deleted, whole))
        if not whole:
            pieces = cut(inserted, self.leaf)
            self.leaves = pieces
            self.tree.build([len(p) for p in pieces], self._count(pieces))
            return len(pieces)
        first, begin = self.tree.find(max(0, at - CONTEXT))
        last, _ = self.tree.find(min(whole, end + CONTEXT))
        last += 1
        old = "".join(self.leaves[first:last])
        pieces = cut(old[:at - begin] + inserted + old[end - begin:], self.leaf)
        lengths, tokens = [len(p) for p in pieces], self._count(pieces)
        places, n = last - first, len(pieces)
        if n > places and sum(lengths[places - 1:]) > SLACK * self.leaf:
            old_lengths, old_tokens = self.state
            self.leaves[first:last] = pieces
            self.tree.build(old_lengths[:first] + lengths + old_lengths[last:], old_tokens[:first] + tokens + old_tokens[last:])
            return n
        # Pieces meet where a pre-token begins, so their counts add up. Places that are left over stay empty.
        spare = [0] * (places - n)
        cutoff = min(places, n) - 1
        if n:
            pieces = pieces[:cutoff] + ["".join(pieces[cutoff:])]
            lengths, tokens = lengths[:cutoff] + [sum(lengths[cutoff:])], tokens[:cutoff] + [sum(tokens[cutoff:])]
        self.leaves[first:last] = pieces + [""] * len(spare)
        self.tree.replace(first, lengths + spare, tokens + spare)
        return n


def _edited(counted: Counted, edits) -> int:
    return sum(counted.edit(e["at"] or 0, e["deleted"] or 0, e["inserted"] or "") for e in edits or [] if e is not None)


_STATE_KINDS = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]


def _count(vocabulary: str, leaf: int):
    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                counted = Counted(text or "", vocabulary, leaf)
                out.append((counted.tokens, *counted.state, digest_of(text or "")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *[pa.array([o[k] for o in out], kind) for k, kind in enumerate(_STATE_KINDS)]],
                names=["row", *STATE])
    return run


def _apply(vocabulary: str, leaf: int):
    def run(batches):
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("text", "leaf_chars", "leaf_tokens", "tree_digest", "edits")]
            for text, lengths, tokens, digest, edits in zip(*columns):
                text = text or ""
                own = lengths is not None and tokens is not None and len(lengths) == len(tokens) and digest == digest_of(text)
                counted = Counted(text, vocabulary, leaf, (lengths, tokens) if own else None)
                touched = _edited(counted, edits)
                new = counted.text
                out.append((new, counted.tokens, *counted.state, digest_of(new), touched, counted.encoded))
            kinds = [pa.string(), *_STATE_KINDS, pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *[pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]],
                names=["row", "text", *STATE, "n_leaves_encoded", "n_chars_encoded"])
    return run


def _kept(docs: DataFrame, without: Iterable[str], wanted: Sequence[str]) -> DataFrame:
    """``row`` with the columns not in ``without``, and the wanted ones."""
    own = [c for c in docs.columns if c not in set(without)]
    return docs.select(wrapped(docs, own) if own else F.struct(F.lit(0).alias("_")).alias("row"), *wanted)


STATE = ("n_tokens", "leaf_chars", "leaf_tokens", "tree_digest")
STATE_TYPES = "n_tokens long, leaf_chars array<long>, leaf_tokens array<long>, tree_digest long"


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, leaf: int = LEAF) -> DataFrame:
    """All columns of ``docs``, ``text`` among them, with the tree of each text: n_tokens, leaf_chars, leaf_tokens, tree_digest.

    A null text counts as empty and has 0 tokens and no leaves. Columns with the names of the added ones are replaced.
    Rows that repeat a text have equal trees. A leaf ends at a single space between visible characters; a very long text
    without one is one leaf. ``vocabulary`` is a file that every executor can read. An empty table gives an empty result.
    """
    rows = _kept(docs, set(STATE), ["text"])
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_count(vocabulary, leaf), f"row {kind}, {STATE_TYPES}").select("row.*", *STATE)


def apply_edits(docs: DataFrame, vocabulary: str = VOCABULARY, leaf: int = LEAF) -> DataFrame:
    """Rows of :func:`count_tokens` with ``edits`` (array of at, deleted, inserted; applied in order) to the changed text with its
    tree, and how much was encoded again: n_leaves_encoded, n_chars_encoded.

    ``tree_digest`` ties a tree to its text. Where it differs (a tree of another row or of an earlier text) or a part of the
    tree is null, the text is counted anew, which n_chars_encoded then shows. A null or empty ``edits`` changes nothing;
    null fields are 0 or empty; places beyond the text mean its end. Repeated rows are changed alike; an empty table gives an
    empty result.
    """
    added = {*STATE, "text", "edits", "n_leaves_encoded", "n_chars_encoded"}
    rows = _kept(docs, added, ["text", "leaf_chars", "leaf_tokens", "tree_digest", "edits"])
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        _apply(vocabulary, leaf), f"row {kind}, text string, {STATE_TYPES}, n_leaves_encoded long, n_chars_encoded long").select(
        "row.*", "text", *STATE, "n_leaves_encoded", "n_chars_encoded")


def _both(vocabulary: str, leaf: int):
    def run(batches):
        for batch in batches:
            out = []
            for text, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist()):
                counted = Counted(text or "", vocabulary, leaf)
                tokens, leaves, whole = counted.tokens, counted.tree.n, counted.encoded
                touched = _edited(counted, edits)
                out.append((tokens, leaves, counted.tokens, touched, counted.encoded - whole))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([o[k] for o in out], pa.int64()) for k in range(5)]],
                names=["doc_id", "n_tokens", "n_leaves", "n_tokens_edited", "n_leaves_encoded", "n_chars_encoded"])
    return run


def count_before_and_after(docs: DataFrame, vocabulary: str = VOCABULARY, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens and n_leaves of each text, and after its ``edits`` n_tokens_edited and what was encoded again, in one pass.

    A null text counts as empty; null or empty ``edits`` change nothing. Every row has its row in the result: repeated ids and
    texts, and null ids too. Other columns are ignored, whatever their names. Very long texts are counted whole. An empty
    table gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("long"), "text", "edits").mapInArrow(
        _both(vocabulary, leaf), "doc_id long, n_tokens long, n_leaves long, n_tokens_edited long, n_leaves_encoded long, "
        "n_chars_encoded long")
