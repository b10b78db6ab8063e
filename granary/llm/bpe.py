"""Byte-level BPE by speculation and verification.

A greedy longest match proposes the tokens of every new word. A proposal is what merging gives
exactly when each of its tokens is a fixed point of merging and every adjacent pair is
*compatible*: no merge across the border comes up before the merges that build the two
tokens. The borders of all proposals of a slice are tested together in numpy; only words that
fail are merged exactly: short ones together, one merge of every word at a time, long ones each with
a heap, in O(n log n) for a word of n bytes.

Defined cases: a null text is encoded as the empty one, which has no tokens; a long text is
encoded whole; repeated rows and null ids stay, row by row; columns other than the id and the
text are not read, so their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from granary.llm.common import extended, numbered, rounds

#: The published pre-tokenizer pattern of this vocabulary family, with its white space spelled out.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: The same for texts of the first 256 characters, with its classes spelled out, which the standard library cuts faster.
LATIN = PATTERN.replace(SPACE, r"\t-\r \x85\xa0")
for _kind in "LN":
    LATIN = LATIN.replace(rf"\p{{{_kind}}}+", f"[\\p{{{_kind}}}]+").replace(
        rf"\p{{{_kind}}}", "".join(f"\\x{i:02x}" for i in range(256) if regex.match(rf"\p{{{_kind}}}", chr(i)))
    )
NEVER = np.int64(1) << 40
#: Words that a Python worker remembers; longer words than this many bytes are worked out each time.
REMEMBERED, SHORT = 200_000, 48
#: The longest end of a word whose proposal is remembered.
TAIL = 12
#: Widths of the tables in which short words are merged together.
WIDTHS = (8, 12, 20, SHORT)
#: Bytes of text that are cut into words at a time.
SLICE = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in such vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Vocabulary:
    """Tokens and merges of one vocabulary file; its size is that of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        self.ids = {as_bytes(token): number for token, number in model["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.text = [b""] * size
        for token, number in self.ids.items():
            self.text[number] = token
        for token, number in self.special.items():
            self.text[number] = token.encode()
        #: The longest token for each beginning of three bytes; the others have two at most.
        self.reach: dict[bytes, int] = {}
        for token in self.ids:
            if len(token) > self.reach.get(token[:3], 2):
                self.reach[token[:3]] = len(token)
        #: Proposals of what follows a word's first token.
        self.tails: dict[bytes, tuple[int, ...]] = {}
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.made_at = np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = as_bytes(a), as_bytes(b)
            whole = self.ids[a + b]
            self.merges.setdefault((self.ids[a], self.ids[b]), (rank, whole))
            if self.made_at[whole] < 0:
                self.left[whole], self.right[whole], self.made_at[whole] = self.ids[a], self.ids[b], rank
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([rank for rank, _ in self.merges.values()], np.int64)[order]
        self.made_by = np.zeros(len(model["merges"]), np.int64)
        self.made_by[[rank for rank, _ in self.merges.values()]] = [whole for _, whole in self.merges.values()]
        self.byte_id = [self.ids[bytes([b])] for b in range(256)]
        own = np.array(self.byte_id)
        #: Ranks of pairs of bytes.
        self.byte_ranks = self.ranks(np.repeat(own, 256), np.tile(own, 256)).reshape(256, 256)
        self.stable = np.array([bool(t) and self.merge(t) == [i] for i, t in enumerate(self.text)])

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the earliest merge first, from the left."""
        parts: list[int] = [self.byte_id[b] for b in word]
        n = len(parts)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (found[0], i, parts[i], parts[i + 1], found[1])
            for i in range(n - 1)
            if (found := self.merges.get((parts[i], parts[i + 1])))
        ]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = following[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = whole, -1
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                if found := self.merges.get((whole, parts[k])):
                    heapq.heappush(heap, (found[0], i, whole, parts[k], found[1]))
            if (h := before[i]) >= 0 and (found := self.merges.get((parts[h], whole))):
                heapq.heappush(heap, (found[0], h, parts[h], whole, found[1]))
        return [p for p in parts if p >= 0]

    def ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Ranks of the pairs' merges, NEVER where there is none."""
        keys = first << 32 | second
        place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[place] == keys, self.pair_ranks[place], NEVER)

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """Exact merging of short words in a table: of each word its earliest merge, from the left, until none has one."""
        out: list[list[int]] = [[]] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        at = np.flatnonzero(lengths)
        width = int(lengths.max(initial=0))
        columns = np.arange(width)
        raw = np.zeros((len(at), width), np.uint8)
        raw[columns < lengths[at, None]] = np.frombuffer(b"".join(words), np.uint8)
        parts, left = np.array(self.byte_id)[raw], lengths[at]
        ranks = np.full((len(at), width), NEVER)
        ranks[:, :-1] = self.byte_ranks[raw[:, :-1], raw[:, 1:]]
        ranks[columns >= left[:, None] - 1] = NEVER
        while len(at):
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(at)), best]
            done = rank == NEVER
            if done.any():
                for i, row, n in zip(at[done].tolist(), parts[done].tolist(), left[done].tolist(), strict=True):
                    out[i] = row[:n]
                on = ~done
                at, parts, ranks, left, best, rank = at[on], parts[on], ranks[on], left[on], best[on], rank[on]
                if not len(at):
                    break
            rows, whole = np.arange(len(at)), self.made_by[rank]
            left = left - 1
            longest = int(left.max())
            columns = np.arange(longest)
            # the second part of each merge goes, and what follows moves up
            taken = columns + (columns > best[:, None])
            parts, ranks = np.take_along_axis(parts, taken, 1), np.take_along_axis(ranks, np.minimum(taken + (taken == best[:, None]), ranks.shape[1] - 1), 1)
            parts[rows, best] = whole
            after, before = best + 1 < left, best > 0
            ranks[rows, best] = NEVER
            ranks[rows[after], best[after]] = self.ranks(whole[after], parts[rows[after], best[after] + 1])
            ranks[rows[before], best[before] - 1] = self.ranks(parts[rows[before], best[before] - 1], whole[before])
        return out

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match; short ends of words are remembered."""
        ids, reach, tails, out, at, n, first = self.ids, self.reach, self.tails, [], 0, len(word), 0
        while at < n:
            if at and (known := tails.get(word[at:])):
                out += known
                break
            end = min(n, at + reach.get(word[at : at + 3], 2))
            while (token := ids.get(word[at:end])) is None:
                end -= 1
            out.append(token)
            at, first = end, first or end
        if first < n <= first + TAIL and len(tails) < REMEMBERED // 2:
            tails.setdefault(word[first:], tuple(out[1:]))
        return out

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging keeps the border between the tokens of each pair.

        Time is walked backwards: whichever of the two pieces at the border was made later is
        taken apart, and the pair then at the border must have no merge due before that moment.
        """
        good = np.ones(len(first), bool)
        at, a, b = np.arange(len(first)), first.astype(np.int64), second.astype(np.int64)
        due = np.full(len(first), NEVER)
        while len(at):
            rank = self.ranks(a, b)
            bad = rank < due
            good[at[bad]] = False
            at_a, at_b = self.made_at[a], self.made_at[b]
            on = ~bad & ((at_a >= 0) | (at_b >= 0))
            at, a, b, at_a, at_b = at[on], a[on], b[on], at_a[on], at_b[on]
            later = at_a > at_b  # at equal ranks the left one is merged first, so the right one is undone first
            due = np.where(later, at_a, at_b + 1)
            a, b = np.where(later, self.right[a], a), np.where(later, b, self.left[b])
        return good

    def encode(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """Tokens of each word, and how many words had to be merged exactly."""
        proposed = [self.propose(word) for word in words]
        counts = np.array([len(p) for p in proposed], np.int64)
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(words)), counts)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, where = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
        fits = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[where]
        failing = np.zeros(len(words), bool)
        failing[owner[inner[~fits]]] = True
        failing[owner[~self.stable[flat]]] = True
        wrong = np.flatnonzero(failing)
        sizes = np.array([len(words[i]) for i in wrong], np.int64)
        for above, width in zip((0, *WIDTHS), WIDTHS):
            group = wrong[(sizes > above) & (sizes <= width)].tolist()
            for i, merged in zip(group, self.merge_all([words[i] for i in group]), strict=True):
                proposed[i] = merged
        for i in wrong[sizes > WIDTHS[-1]]:
            proposed[i] = self.merge(words[i])
        return proposed, int(failing.sum())


class Decoder:
    """The tokens' bytes in one array."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def __call__(self, numbers: np.ndarray) -> bytes:
        return b"".join(self._block(numbers[i : i + SLICE // 4]) for i in range(0, len(numbers), SLICE // 4))

    def _block(self, numbers: np.ndarray) -> bytes:
        lengths = self.lengths[numbers]
        starts = np.cumsum(lengths) - lengths
        return self.flat[np.repeat(self.starts[numbers] - starts, lengths) + np.arange(int(lengths.sum()))].tobytes()


class Encoder:
    """A vocabulary with the words that this worker has seen; when full it forgets those that were not seen for longest."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.seen, self.earlier = vocabulary, {}, {}
        self.split_any, self.split_latin = regex.compile(PATTERN).findall, re.compile(LATIN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split_any(text)
        return self.split_latin(text)

    def pieces(self, text: str) -> list[str | int]:
        """Words in order; a special token's string is its number."""
        if not self.special or not any(token in text for token in self.vocabulary.special):
            return self.split(text)
        out: list[str | int] = []
        for i, part in enumerate(self.special.split(text)):
            out += [self.vocabulary.special[part]] if i % 2 else self.split(part)
        return out

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.seen) > REMEMBERED // 2:
            self.seen, self.earlier = {}, self.seen
        seen, earlier, cut = self.seen, self.earlier, [self.pieces(text) for text in texts]
        own: dict[str | int, bytes] = {}
        new = set().union(*cut) - seen.keys()
        again = new & earlier.keys()
        seen.update((word, earlier[word]) for word in again)
        new -= again
        words = [w for w in new if isinstance(w, str)]
        for number in new:
            if not isinstance(number, str):
                own[number] = int(number).to_bytes(4, "little")
        raw = [w.encode() for w in words]
        numbers = self.vocabulary.encode(raw)[0]
        packed, start = np.fromiter(chain.from_iterable(numbers), "<u4").tobytes(), 0
        for word, data, ids in zip(words, raw, numbers, strict=True):
            end = start + 4 * len(ids)
            (seen if len(data) <= SHORT else own)[word] = packed[start:end]
            start = end
        if not own:
            return [b"".join(map(seen.__getitem__, words)) for words in cut]
        return [b"".join(seen[w] if w in seen else own[w] for w in words) for words in cut]


#: One encoder for each vocabulary that a worker has met, so that its words outlive a task.
_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str, shared) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(shared.value)
    return _ENCODERS[name]


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_tokens, ids``: the texts' ids, packed as little-endian unsigned 32-bit integers.

    ``path`` is read on the driver; executors get the vocabulary, of that file's size, by broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    name = f"{path}#{shared._jbroadcast.id() if hasattr(shared, '_jbroadcast') else id(shared)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, shared)
        for batch in rounds(batches, "text", SLICE):
            packed = encoder.texts([t or "" for t in batch.column("text").to_pylist()])
            counts = pa.array([len(p) // 4 for p in packed], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), counts, pa.array(packed, pa.binary())], ["id", "n_tokens", "ids"])

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_tokens long, ids binary").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded``, the text of the packed ``ids``; special tokens give their strings.

    Bytes that are no UTF-8 become U+FFFD, as whole texts never hold any but cut ids may.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(Decoder(Vocabulary(path).text))
    kept, schema = extended(encoded, "decoded string")
    where, names = kept.columns.index("ids"), schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = shared.value
        for whole in batches:
            for batch in rounds([numbered(whole)], str(where)):
                texts = [
                    None if x is None else decoder(np.frombuffer(x, "<u4")).decode("utf-8", "replace")
                    for x in batch.column(where).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return kept.mapInArrow(run, schema)
