"""Alignment of two tokenizers' tokens over the same bytes, by lockstep merging, with corpus-wide link counts.

Both tokenizers cut a text's bytes. One NumPy state vector holds a pointer pair (A token, B token) for every
lane of a batch of documents. Each step links the pairs the pointers stand on, cuts where both tokens end
at one byte, advances the pointer whose token ends first (both at a cut) and drops finished lanes. A lane is a
document, or a stretch of a long one that begins at a shared end, so that a very long text does not
run on alone after the others.

Counts of linked pairs go over the corpus by chunk: a chunk of documents has a dictionary of its distinct
pairs with the number of its documents that hold each. Dictionaries are summed by pair, and each gets
the sums of its own pairs back, so the pairs of single documents are never shuffled.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import pick
from tradeledger.session import cut_lineage

#: A tokens of a lane, and the tokens beyond in which a shared end is sought for the next lane.
LANE, SEEK = 256, 64

#: Bytes of text that a task tokenizes and merges at a time; a longer text is taken alone.
BLOCK_BYTES = 500_000

#: Words of at most so many characters whose ids a worker remembers; beyond it the half used most stays.
CACHE_WORDS, CACHE_CHARS = 300_000, 32

#: New words that are encoded as one text.
RUN_WORDS = 32

#: Distinct pairs of documents that a chunk holds; a document with more is a chunk of its own.
CHUNK_PAIRS = 1_000_000


# ------------------------------------------------------------------ the two tokenizers


def _byte_of() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: itself if printable, else from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A tokenizer of the byte-level kind from its JSON; texts get a space in front."""

    def __init__(self, definition: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition.decode())
        self.tokenizer.encode_special_tokens = True
        names, size = _byte_of(), self.tokenizer.get_vocab_size()
        self.tokens = []
        for i in range(size):
            token = self.tokenizer.id_to_token(i) or ""
            known = all(c in names for c in token)
            self.tokens.append(bytes(names[c] for c in token) if known else token.encode())
        parts = json.loads(definition)
        before = parts.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        #: Tokens of the kind's pattern hold a space only in front, or blanks alone.
        self.by_word = bool(plain) and not parts.get("normalizer")

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in found]


class Pieces:
    """A piece model from its bytes; it puts a space in front itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = self.model.is_byte(i)
            self.tokens.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        #: No piece goes on after a space that follows other characters, so no merge crosses one.
        self.by_word = not any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(len(self.tokens)))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


#: A single space between characters that are not blank: tokens of both kinds end there.
_WORD_END = re.compile(r"(?<=\S) (?=\S)")


class _Numbers(dict):
    """Words by number, in the order they were met; numbers of long ones are below zero and last for a batch."""

    def __init__(self, words: Sequence[str] = ()):
        super().__init__(zip(words, range(len(words))))
        self.new: list[str] = []
        self.long: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        if len(word) > CACHE_CHARS:
            return self.long.setdefault(word, -1 - len(self.long))
        self.new.append(word)
        found = self[word] = len(self)
        return found


@dataclass
class _Known:
    """Ids of words by both tokenizers, one word after another, where each word's end, and words not given back."""

    ids: list[np.ndarray]
    ends: list[np.ndarray]
    lost: np.ndarray

    @staticmethod
    def none() -> _Known:
        return _Known([np.zeros(0, np.uint32)] * 2, [np.zeros(1, np.int64)] * 2, np.zeros(0, bool))

    def plus(self, more: _Known) -> _Known:
        ids = [np.concatenate(x) for x in zip(self.ids, more.ids)]
        ends = [np.append(x, x[-1] + y[1:]) for x, y in zip(self.ends, more.ends)]
        return _Known(ids, ends, np.append(self.lost, more.lost))

    def take(self, which: np.ndarray) -> _Known:
        """These words in this order."""
        ids, ends = [], []
        for flat, stop in zip(self.ids, self.ends):
            begin = stop[which]
            counts = stop[which + 1] - begin
            end = np.append(0, np.cumsum(counts))
            ids.append(flat[np.arange(end[-1]) + np.repeat(begin - end[:-1], counts)])
            ends.append(end)
        return _Known(ids, ends, self.lost[which])


class WordIds:
    """Ids of both tokenizers for a text's words, each with the space before it, as 32-bit values.

    Both tokenizers cut the text at single spaces between other characters, so the ids of a text are
    those of its words. Tokenizers without this property (``by_word``) get the whole text as one word.
    New words are for the same reason encoded in runs, which the bytes of their tokens cut into words again.
    """

    def __init__(self, first: bytes, second: bytes):
        self.one, self.two = ByteLevel(first), Pieces(second)
        self.by_word = self.one.by_word and self.two.by_word
        self.sizes = [np.array([len(t) for t in x.tokens], np.int64) for x in (self.one, self.two)]
        self._start()

    def _start(self) -> None:
        self.numbers, self.known, self.used = _Numbers(), _Known.none(), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep half the room's words if there are too many: those of the most batches, then the latest."""
        if self.numbers.new or self.numbers.long:
            # An error ended the last batch before its words had ids.
            self._start()
        if len(self.numbers) > CACHE_WORDS:
            kept = np.sort(np.argsort(self.used, kind="stable")[-(CACHE_WORDS // 2) :])
            words = list(self.numbers)
            self.numbers, self.known = _Numbers([words[i] for i in kept.tolist()]), self.known.take(kept)
            self.used = self.used[kept] // 2

    def _whole(self, runs: list[list[str]]) -> Iterator[tuple[list[str], list[int] | None, list[int] | None]]:
        """Ids of runs that both tokenizers give back, else of their words; none for a word not given back."""
        texts = [" ".join(r) for r in runs]
        tokens_a, tokens_b = self.one.tokens, self.two.tokens
        for run, text, a, b in zip(runs, texts, self.one.encode(texts), self.two.encode(texts), strict=True):
            whole = b" " + text.encode()
            if b"".join([tokens_a[i] for i in a]) == whole and b"".join([tokens_b[i] for i in b]) == whole:
                yield run, a, b
            elif len(run) == 1:
                yield run, None, None
            else:
                yield from self._whole([[w] for w in run])

    def _encode(self, words: list[str], longest: int) -> _Known:
        """Ids of words, encoded in runs of at most so many."""
        runs: list[list[str]] = []
        alone = True
        for word in words:
            # In a run, a blank at a word's end would lie beside the space between words; U+2581 is not given back.
            by_itself = len(word.strip()) < len(word) or "▁" in word
            if alone or by_itself or len(runs[-1]) == longest:
                runs.append([])
            runs[-1].append(word)
            alone = by_itself
        ids: tuple[array, array] = array("I"), array("I")
        sizes, lost = [], []
        for run, a, b in self._whole(runs):
            if a is None:
                sizes.append(0)
                lost.append(True)
                continue
            ids[0].extend(a)
            ids[1].extend(b)
            sizes.extend([len(w.encode()) + 1 for w in run])
            lost.extend([False] * len(run))
        stops = np.append(0, np.cumsum(np.array(sizes, np.int64)))
        flat = [np.array(x, np.uint32) for x in ids]
        token_ends = [np.append(0, np.cumsum(size[x])) for size, x in zip(self.sizes, flat)]
        ends = [np.searchsorted(x, stops, side="right") - 1 for x in token_ends]
        if longest > 1 and not all((x[e] == stops).all() for x, e in zip(token_ends, ends)):
            return self._encode(words, 1)
        return _Known(flat, ends, np.array(lost, bool))

    def of(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids of A and B for each text; none for those without tokens."""
        self._forget()
        split = _WORD_END.split if self.by_word else lambda text: [text]
        words = [split(t) if t else [] for t in texts]
        stops = np.append(0, np.cumsum([len(x) for x in words])).astype(np.int64)
        met = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, stops[-1])
        longest = RUN_WORDS if self.by_word else 1
        known = self.known.plus(self._encode(self.numbers.new, longest)) if self.numbers.new else self.known
        long = list(self.numbers.long)
        self.known, self.numbers.new, self.numbers.long = known, [], {}
        room = len(self.numbers)
        used = np.bincount(met[met >= 0], minlength=room) > 0
        self.used = np.append(self.used, np.zeros(room - len(self.used), np.int64)) + used
        if long:
            known = known.plus(self._encode(long, 1))
            met = np.where(met < 0, room - 1 - met, met)
        found = known.take(met)
        lost = np.append(0, np.cumsum(found.lost))[stops]
        (a, b), (at_a, at_b) = found.ids, (x[stops].tolist() for x in found.ends)
        return [
            (a[at_a[i] : at_a[i + 1]].tobytes(), b[at_b[i] : at_b[i + 1]].tobytes()) if not bad else (b"", b"")
            for i, bad in enumerate(np.diff(lost).tolist())
        ]


_LOADED: dict[int, WordIds] = {}


def _load(first: bytes, second: bytes) -> WordIds:
    """One pair of tokenizers per worker, kept between tasks."""
    key = hash((first, second))
    if key not in _LOADED:
        _LOADED[key] = WordIds(first, second)
    return _LOADED[key]


# ------------------------------------------------------------------ lockstep merging


def lanes_of(
    ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, lane: int = LANE, seek: int = SEEK
) -> tuple[np.ndarray, np.ndarray]:
    """First A and B token of every lane, in order of position.

    ``ends_*`` are the byte ends of all tokens of a batch, documents one after another; ``first_*`` the first
    tokens of the documents, then the number of tokens. Within a document a lane begins at the first shared
    end at or after every ``lane``-th A token, if one lies among the next ``seek`` tokens.
    """
    counts = np.diff(first_a)
    per_doc = np.maximum(counts - 1, 0) // lane
    owner = np.repeat(np.arange(len(counts)), per_doc)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc) + 1
    at = first_a[owner] + nth * lane - 1
    tried = at[:, None] + np.arange(seek)
    inside = tried < first_a[owner + 1][:, None] - 1
    tried = np.where(inside, tried, 0)
    place = np.searchsorted(ends_b, ends_a[tried])
    hit = inside & (ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[tried])
    which = hit.argmax(axis=1)
    rows = np.flatnonzero(hit.any(axis=1))
    more_a, more_b = tried[rows, which[rows]] + 1, place[rows, which[rows]] + 1
    some = counts > 0
    starts = np.concatenate([np.stack([first_a[:-1][some], first_b[:-1][some]], 1), np.stack([more_a, more_b], 1)])
    # Two targets may meet in one shared end.
    starts = np.unique(starts, axis=0)
    return starts[:, 0], starts[:, 1]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray):
    """Links (A, B) of tokens that share bytes, and cuts (A, B): the tokens that end together.

    All lanes advance at once, one link a step; a lane ends where the next begins. Links and cuts come
    in order of the steps.
    """
    stop = np.append(start_a[1:], len(ends_a))
    a, b = start_a.copy(), start_b.copy()
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        cuts_a.append(a[both])
        cuts_b.append(b[both])
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        left = a < stop
        if not left.all():
            a, b, stop = a[left], b[left], stop[left]
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else empty for x in (links_a, links_b, cuts_a, cuts_b))


@dataclass
class Aligned:
    """A merged batch: token ids and their numbers per document, cuts in order, distinct pairs with their numbers."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray
    links: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    first_pair: np.ndarray

    def groups_of(self) -> np.ndarray:
        """First cut of every document, then the number of cuts."""
        return np.searchsorted(self.cuts_a, self.first_a)


def align_batch(texts: list[str | None], words: WordIds, sizes: tuple[np.ndarray, np.ndarray]) -> Aligned:
    """Tokenize and merge a batch. ``sizes``: bytes of each token of the two vocabularies."""
    found = words.of(texts)
    a, b = (np.frombuffer(b"".join(x[i] for x in found), np.uint32).astype(np.int64) for i in (0, 1))
    counts_a, counts_b = ([len(x[i]) // 4 for x in found] for i in (0, 1))
    first_a, first_b = (np.concatenate([[0], np.cumsum(x)]).astype(np.int64) for x in (counts_a, counts_b))
    none = np.zeros(0, np.int64)
    if not len(a):
        zeros = np.zeros(len(texts), np.int64)
        return Aligned(a, b, first_a, first_b, none, none, zeros, none, none, np.zeros(len(texts) + 1, np.int64))
    ends_a, ends_b = np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b])
    links_a, links_b, cuts_a, cuts_b = lockstep(ends_a, ends_b, *lanes_of(ends_a, ends_b, first_a, first_b))
    order = np.argsort(cuts_a)
    doc = np.repeat(np.arange(len(texts)), counts_a)[links_a]
    # Document, A id and B id in one number, so that one sort finds the distinct pairs of each document.
    width = len(words.two.tokens)
    room = len(words.one.tokens) * width
    pairs, times = np.unique(doc * room + a[links_a] * width + b[links_b], return_counts=True)
    first_pair = np.searchsorted(pairs, np.arange(len(texts) + 1) * room)
    return Aligned(
        a, b, first_a, first_b, cuts_a[order], cuts_b[order], np.bincount(doc, minlength=len(texts)),
        pairs % room, times, first_pair,
    )


class Listing:
    """Groups of tokens as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, ids: int):
        width = len(str(max(ids - 1, 1)))
        numbers = np.arange(ids)
        digits = [numbers // 10**k % 10 + 48 for k in reversed(range(width))]
        self.digits = np.stack([*digits, np.zeros(ids, np.int64)], 1).astype(np.uint8)
        shown = [numbers >= 10**k if k else np.ones(ids, bool) for k in reversed(range(width))]
        self.shown = np.stack([*shown, np.ones(ids, bool)], 1)
        self.length = self.shown.sum(axis=1)

    def of(self, made: Aligned) -> tuple[bytes, np.ndarray]:
        """The text of all documents, a mark after every token, and where each one ends."""
        n_a, n_b = len(made.ids_a), len(made.ids_b)
        of_a, of_b = np.diff(made.cuts_a, prepend=-1), np.diff(made.cuts_b, prepend=-1)
        at_a = np.arange(n_a) + np.repeat(np.append(0, made.cuts_b[:-1] + 1)[: len(of_a)], of_a)
        at_b = np.arange(n_b) + np.repeat(made.cuts_a + 1, of_b)
        ids, mark = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[at_a], ids[at_b] = made.ids_a, made.ids_b
        mark[at_a[made.cuts_a]], mark[at_b[made.cuts_b]] = ord("|"), ord(";")
        table = self.digits[ids]
        table[:, -1] = mark
        ends = np.append(0, np.cumsum(self.length[ids]))
        return table[self.shown[ids]].tobytes(), ends[made.first_a + made.first_b]


# ------------------------------------------------------------------ chunks


def pack_pairs(places: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending places in a dictionary and their numbers; equal bytes of a number stay together to compress well."""
    steps = np.diff(places, prepend=0).astype("<u4")
    return b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes() for x in (steps, times.astype("<u4")))


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(2, 4, -1)
    steps, times = (np.ascontiguousarray(p.T).view("<u4").ravel().astype(np.int64) for p in planes)
    return np.cumsum(steps), times


@dataclass
class Row:
    """What a chunk knows of a document before its pairs have counts."""

    name: object
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: object
    pairs: np.ndarray
    times: np.ndarray


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_GROUPS = "array<struct<a: array<int>, b: array<int>>>"
_GROUPS_ARROW = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))


def _groups(made: Aligned, cuts: np.ndarray, doc: int) -> list[dict]:
    """The groups of a document as lists of ids."""
    out, a, b = [], made.first_a[doc], made.first_b[doc]
    for i in range(cuts[doc], cuts[doc + 1]):
        stop_a, stop_b = made.cuts_a[i] + 1, made.cuts_b[i] + 1
        out.append({"a": made.ids_a[a:stop_a].tolist(), "b": made.ids_b[b:stop_b].tolist()})
        a, b = stop_a, stop_b
    return out


def align_tokens(
    docs: DataFrame, first: bytes, second: bytes, id_column: str = "doc_id", digest: bool = False,
    chunk_pairs: int = CHUNK_PAIRS,
) -> DataFrame:
    """One row per row of docs: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``first`` is the JSON of a byte-level tokenizer (A), ``second`` a piece model (B) that puts a space in
    front; A gets the text with one. ``groups`` lists the ids of both between places where tokens of both
    end; with ``digest`` it is ``groups_sha256``, the SHA-256 (lowercase hex) of ``a1,a2|b1;a3|b2``.
    A link is a pair of tokens that share bytes. A pair of ids counts the documents of the whole table that
    hold it linked: ``count_sum`` adds these counts over a document's links, and ``n_best`` counts the
    links whose pair has the highest count of its A id, ties included.

    Texts that are NULL, empty, or not given back byte by byte by both tokenizers have no tokens: zeros, and
    no groups ('' with ``digest``). Texts of any length are taken whole. Rows repeated with one id are documents
    each. A NULL id stays NULL. Other columns are not read. An empty table gives no rows.

    A task holds one block of texts and one chunk of pairs, whatever the size of the table.
    """
    rows = pick(docs, id_column, "text").toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast((first, second))
    groups_ddl, groups_arrow = ("string", pa.string()) if digest else (_GROUPS, _GROUPS_ARROW)
    numbers = ", ".join(f"{c} bigint" for c in _COUNTS)
    schema = f"chunk bigint, id {kind}, {numbers}, groups {groups_ddl}, held binary, pairs array<bigint>, docs array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _load(*sent.value)
        sizes = tuple(np.array([len(t) for t in x.tokens], np.int64) for x in (words.one, words.two))
        listing = Listing(max(map(len, sizes)))
        chunk, id_type = TaskContext.get().partitionId() << 32, None
        held: list[Row] = []
        pairs_held = 0

        def merged(names: list, texts: list[str | None]) -> Iterator[Row]:
            made = align_batch(texts, words, sizes)
            cuts = made.groups_of()
            written, ends = listing.of(made) if digest else (b"", None)
            for i, name in enumerate(names):
                if digest:
                    text = written[ends[i] : max(ends[i], ends[i + 1] - 1)]
                    shown = hashlib.sha256(text).hexdigest() if text else ""
                else:
                    shown = _groups(made, cuts, i)
                lo, hi = made.first_pair[i : i + 2]
                n_a, n_b = made.first_a[i + 1] - made.first_a[i], made.first_b[i + 1] - made.first_b[i]
                yield Row(
                    name, n_a, n_b, cuts[i + 1] - cuts[i], made.links[i], shown, made.pairs[lo:hi], made.times[lo:hi]
                )

        def flushed() -> pa.RecordBatch:
            """The documents of a chunk; the last row is its dictionary."""
            distinct, place, number = np.unique(
                np.concatenate([r.pairs for r in held]), return_inverse=True, return_counts=True
            )
            packed, at = [], 0
            for r in held:
                packed.append(pack_pairs(place[at : at + len(r.pairs)], r.times))
                at += len(r.pairs)
            columns = [
                pa.array([chunk] * (len(held) + 1), pa.int64()),
                pa.array([r.name for r in held] + [None], id_type),
                *(pa.array([int(getattr(r, c)) for r in held] + [None], pa.int64()) for c in _COUNTS),
                pa.array([r.groups for r in held] + [None], groups_arrow),
                pa.array(packed + [None], pa.binary()),
                pa.array([None] * len(held) + [distinct], pa.list_(pa.int64())),
                pa.array([None] * len(held) + [number], pa.list_(pa.int32())),
            ]
            names = ["chunk", "id", *_COUNTS, "groups", "held", "pairs", "docs"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def blocks() -> Iterator[tuple[list, list[str | None]]]:
            nonlocal id_type
            names, texts, size = [], [], 0
            for batch in batches:
                id_type = batch.schema.field(0).type
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    names.append(name)
                    texts.append(text)
                    size += len(text or "")
                    if size >= BLOCK_BYTES:
                        yield names, texts
                        names, texts, size = [], [], 0
            if names:
                yield names, texts

        for names, texts in blocks():
            for row in merged(names, texts):
                if held and pairs_held + len(row.pairs) > chunk_pairs:
                    yield flushed()
                    chunk, held, pairs_held = chunk + 1, [], 0
                held.append(row)
                pairs_held += len(row.pairs)
        if held:
            yield flushed()

    stage = cut_lineage(rows.mapInArrow(run, schema))
    known = _with_counts(stage, len(Pieces(second).tokens))
    found = stage.where("held is not null").drop("pairs", "docs")
    names = [f.name for f in found.schema.fields if f.name not in ("chunk", "held")]
    result = ", ".join([f"id {kind}", numbers, f"groups {groups_ddl}", "n_best bigint", "count_sum bigint"])

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        """Documents of a chunk with the sums over their links; its pairs come with their corpus counts."""
        order = np.argsort(right.column("pair").to_numpy())
        signed = right.column("signed").to_numpy()[order]
        number, best = np.abs(signed), signed > 0
        n_best, sums = [], []
        for data in left.column("held").to_pylist():
            place, times = unpack_pairs(data)
            n_best.append(int(times[best[place]].sum()))
            sums.append(int((times * number[place]).sum()))
        arrays = [left.column(c) for c in names] + [pa.array(x, pa.int64()) for x in (n_best, sums)]
        return pa.table(arrays, names=[*names, "n_best", "count_sum"])

    met = found.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(counted, result)
    return met.select(
        F.col("id").alias(id_column), *_COUNTS, "n_best", "count_sum",
        F.col("groups").alias("groups_sha256" if digest else "groups"),
    )


def _with_counts(stage: DataFrame, width: int) -> DataFrame:
    """(chunk, pair, signed): the documents that hold a pair, negative if another pair of its A id has more."""
    listed = stage.where("pairs is not null").select("chunk", F.inline(F.arrays_zip("pairs", "docs")))
    listed = listed.toDF("chunk", "pair", "docs")
    counts = cut_lineage(listed.groupBy("pair").agg(F.sum("docs").alias("n")))
    counts = counts.withColumn("a", F.expr(f"pair div {width}"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    signed = F.when(F.col("n") == F.col("most"), F.col("n")).otherwise(-F.col("n"))
    return listed.select("chunk", "pair").join(counts.join(most, "a").select("pair", signed.alias("signed")), "pair")


def tokenizer_files(names: Sequence[str] = ("byte_bpe_50k.json", "piece_bpe_32k.model")) -> tuple[bytes, ...]:
    """Contents of public tokenizer files."""
    import public_tokenizers

    found = []
    for name in names:
        with open(public_tokenizers.path(name), "rb") as file:
            found.append(file.read())
    return tuple(found)
