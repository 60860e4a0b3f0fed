"""Best-fit packing of token sequences, improved by local search."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwell.llm.tables import stored

CAPACITY = 2048
# Token that ends each document.
END = 0
# Pieces packed together in one task.
BLOCK = 40_000
# Words whose ids a worker remembers, those that begin a text and the longest of these,
# and documents whose words are learned together.
REMEMBERED = 350_000
REMEMBERED_FIRSTS, LONGEST_FIRST = 10_000, 100
TOGETHER = 256

_PIECES = "id string, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, sequence_id long, offset long"


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the other bytes in order for the
    characters from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of whole texts as little-endian bytes, with a bounded memory of words.

    The pre-tokenizer never puts what comes before a space into one token with the
    space, unless that is white space too. So a text without white space before a
    space is cut at its spaces, and each word, with the space before it, is encoded
    once and looked up afterwards. New words are encoded together by a faster library
    with the same vocabulary; the lengths of their tokens tell which ids belong to which
    word. Other texts, and those that spell a special token, are encoded whole.
    """

    _white_before_space = re.compile(r"\s ")

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Byte-level vocabulary: one character of a token stands for one byte, and a merge
        # ranks as its result is numbered.
        byte_of = _byte_characters()
        ranks = {
            bytes(map(byte_of.__getitem__, token)): number
            for token, number in vocabulary.items()
            if token not in self.special
        }
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in ranks.items():
            self.widths[number] = len(token)
        self.fast = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.words: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def first(self, word: str) -> bytes:
        """The ids of a word at the beginning of a text."""
        if len(word) > LONGEST_FIRST:
            return self.whole(word)
        if word not in self.firsts:
            if len(self.firsts) >= REMEMBERED_FIRSTS:
                self.firsts.clear()
            self.firsts[word] = self.whole(word)
        return self.firsts[word]

    def learn(self, words: list[str]) -> None:
        """Remember the ids of `words`, each taken with a space before it."""
        if len(self.words) + len(words) > REMEMBERED:
            self.words.clear()
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            joined = " " + " ".join(some)
            ids = np.array(self.fast.encode_ordinary(joined), "<u4")
            upto = np.cumsum(self.widths[ids])
            # No word has a space, so each begins at one and ends at the next.
            spaces = np.frombuffer(joined.encode("utf-8", "replace") + b" ", np.uint8) == 0x20
            ends = np.flatnonzero(spaces)[1:]
            cuts = np.searchsorted(upto, ends)
            if len(ids) == 0 or not np.array_equal(upto[np.minimum(cuts, len(ids) - 1)], ends):
                for word in some:
                    self.words[word] = self.whole(" " + word)
                continue
            stops = ((cuts + 1) * 4).tolist()
            self.words.update(zip(some, map(ids.tobytes().__getitem__, map(slice, [0, *stops], stops))))

    def words_of(self, text: str) -> list[str] | None:
        """The text cut at its spaces, or None if words can't be encoded one by one."""
        if text[:1] == " " or text[-1:] == " " or self._white_before_space.search(text):
            return None
        if any(token in text for token in self.special):
            return None
        return text.split(" ")

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text. What is new in all of them is encoded at once."""
        cut_texts = [self.words_of(text) for text in texts]
        # A word is looked up once; the places of new ones are filled after learning them.
        found: list[list[bytes | None]] = [[*map(self.words.get, words[1:])] for words in cut_texts if words]
        empty = [[i for i, ids in enumerate(own) if ids is None] if None in own else [] for own in found]
        known = [words for words in cut_texts if words]
        self.learn([*{words[i + 1] for words, places in zip(known, empty) for i in places}])
        for words, own, places in zip(known, found, empty):
            for i in places:
                own[i] = self.words[words[i + 1]]
        rest = iter(found)
        for text, words in zip(texts, cut_texts):
            yield self.whole(text) if words is None else self.first(words[0]) + b"".join(next(rest))


def cut(n_tokens: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: all but the first are full."""
    first = n_tokens % capacity or capacity
    yield 0, first
    for start in range(first, n_tokens, capacity):
        yield start, capacity


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32): every document as pieces of at most `capacity` tokens."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    own = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    end = np.array([END], "<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(path)
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                some, rows = batch.iloc[at : at + TOGETHER], []
                for id_, ids in zip(some["id"], encode([t or "" for t in some["text"]])):
                    raw = memoryview(ids + end)
                    for i, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                        crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                        rows.append((id_, i, start, length, crc))
                yield pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32"])

    return own.mapInPandas(pieces, _PIECES)


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each item: longest first, each into the fullest bin that has room."""
    bins = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = count = 0  # bit r of rooms: some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + length
            own = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, own, count = capacity, count, count + 1
        bins[item] = own
        if room > length:
            by_room[room - length].append(own)
            rooms |= 1 << (room - length)
    return bins


class _Pairs:
    """What two items of one bin hold together: a row for each bin and sum."""

    def __init__(self) -> None:
        self.sums, self.owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.alive = np.zeros(0, bool)
        self.rows: dict[int, np.ndarray] = {}
        self.n = 0

    def drop(self, own: int) -> None:
        if own in self.rows:
            self.alive[self.rows.pop(own)] = False

    def renew(self, own: int, lengths: list[int]) -> None:
        self.drop(own)
        values, counts = np.unique(lengths, return_counts=True)
        first, second = np.triu_indices(len(values), 1)
        sums = np.unique(np.r_[values[first] + values[second], 2 * values[counts > 1]])
        if self.n + len(sums) > len(self.sums):
            self._make_room(len(sums))
        rows = np.arange(self.n, self.n + len(sums))
        self.sums[rows], self.owner[rows], self.alive[rows] = sums, own, True
        self.rows[own] = rows
        self.n += len(sums)

    def _make_room(self, more: int) -> None:
        kept = np.flatnonzero(self.alive[: self.n])
        size = 2 * (len(kept) + more)
        for name in ("sums", "owner", "alive"):
            old = getattr(self, name)
            new = np.zeros(size, old.dtype)
            new[: len(kept)] = old[kept]
            setattr(self, name, new)
        moved = np.full(self.n, -1)
        moved[kept] = np.arange(len(kept))
        self.rows = {own: moved[rows] for own, rows in self.rows.items()}
        self.n = len(kept)

    def best(self, length: int, donor: int, fill: np.ndarray, capacity: int) -> tuple[int, int] | None:
        """(bin, sum) of two items whose place one of `length` fills best, in a bin not emptier."""
        sums, owner = self.sums[: self.n], self.owner[: self.n]
        near = np.flatnonzero(self.alive[: self.n] & (sums < length))
        gain, held = length - sums[near], fill[owner[near]]
        good = (gain <= capacity - held) & (held >= fill[donor]) & (owner[near] != donor)
        if not good.any():
            return None
        row = near[np.argmax(np.where(good, gain, 0))]
        return int(owner[row]), int(sums[row])


class _Search:
    """Underfull bins and the exchanges between them. Bins that are full or empty leave it."""

    def __init__(self, lengths: np.ndarray, bins: np.ndarray, capacity: int):
        self.lengths, self.bins, self.capacity = lengths, bins, capacity
        self.fill = np.bincount(bins, lengths, minlength=bins.max(initial=-1) + 1).astype(np.int64)
        self.used = int((self.fill > 0).sum())
        self.loose = np.flatnonzero((self.fill[bins] < capacity) & (lengths > 0))
        self.size, self.place = lengths[self.loose], bins[self.loose].copy()
        self.at = {item: i for i, item in enumerate(self.loose.tolist())}
        self.members: dict[int, set[int]] = {}
        for item in self.loose.tolist():
            self.members.setdefault(int(bins[item]), set()).add(item)
        self.open = np.array(sorted(self.members), np.int64)
        self.pairs = _Pairs()
        for own in self.members:
            self._renew(own)

    def _renew(self, own: int) -> None:
        """Bring what is known of a bin up to date after its items changed."""
        items = self.members[own]
        if items and self.fill[own] < self.capacity:
            self.pairs.renew(own, [int(self.lengths[i]) for i in items])
            return
        self.used -= not items
        self.place[[self.at[i] for i in items]] = -1
        del self.members[own]
        self.pairs.drop(own)
        self.open = self.open[self.open != own]

    def exchange(self, donor: int, given: int, target: int, taken: list[int]) -> None:
        for item, source, end in [(given, donor, target), *((i, target, donor) for i in taken)]:
            self.members[source].discard(item)
            self.members[end].add(item)
            self.fill[source] -= self.lengths[item]
            self.fill[end] += self.lengths[item]
            self.bins[item] = self.place[self.at[item]] = end
        self._renew(target)
        self._renew(donor)

    def step(self, donor: int, item: int) -> bool:
        """Give `item` to a bin that is not emptier: a move, else the exchange that fills most."""
        length, fill, capacity = int(self.lengths[item]), self.fill, self.capacity
        room = capacity - fill[self.open]
        fits = np.flatnonzero((room >= length) & (fill[self.open] >= fill[donor]) & (self.open != donor))
        if len(fits):
            self.exchange(donor, item, int(self.open[fits[np.argmin(room[fits])]]), [])
            return True
        near = np.flatnonzero((self.place >= 0) & (self.size < length))
        gain, place = length - self.size[near], self.place[near]
        good = (gain <= capacity - fill[place]) & (fill[place] >= fill[donor]) & (place != donor)
        if good.any():
            row = near[np.argmax(np.where(good, gain, 0))]
            self.exchange(donor, item, int(self.place[row]), [int(self.loose[row])])
            return True
        found = self.pairs.best(length, donor, fill, capacity)
        if found is None:
            return False
        target, total = found
        self.exchange(donor, item, target, self._two(target, total))
        return True

    def _two(self, own: int, total: int) -> list[int]:
        by_length: dict[int, int] = {}
        for item in sorted(self.members[own]):
            length = int(self.lengths[item])
            if total - length in by_length:
                return [by_length[total - length], item]
            by_length[length] = item
        raise AssertionError("a sum without its items")


def local_search(
    lengths: np.ndarray, bins: np.ndarray, capacity: int = CAPACITY, steps: int | None = None
) -> np.ndarray:
    """`bins` with fewer bins where exchanges between underfull bins can empty some.

    Takes the underfull bins from the emptiest on and gives what they hold to bins that
    are not emptier: a whole document (move), a longer for a shorter one (one for one),
    or one for two shorter ones (two for one). Each step raises the sum of squared
    fills, so the search ends: when a round over all bins changes nothing, or no fewer
    bins are possible. Partners are looked up among all underfull bins. `steps` ends it
    after so many exchanges, for callers that want less.
    """
    bins = bins.copy()
    search = _Search(lengths, bins, capacity)
    least = -(-int(lengths.sum()) // capacity)
    # Lengths that found no partner from a bin of some fill, since the last exchange.
    barren: set[tuple[int, int]] = set()
    changed = True
    while changed:
        changed = False
        for donor in sorted(search.members, key=lambda b: (search.fill[b], b)):
            improved = True
            while improved and donor in search.members:
                improved = False
                for item in sorted(search.members[donor], key=lambda i: (-lengths[i], i)):
                    if search.used <= least or steps == 0:
                        return bins
                    case = (int(lengths[item]), int(search.fill[donor]))
                    if case in barren:
                        continue
                    if search.step(donor, item):
                        steps = None if steps is None else steps - 1
                        barren.clear()
                        improved = changed = True
                        break
                    barren.add(case)
    return bins


def _packed(block: pd.DataFrame, capacity: int, steps: int | None) -> pd.DataFrame:
    block = block.sort_values("row", kind="stable").reset_index(drop=True)
    lengths = block["length"].to_numpy(np.int64)
    bins = local_search(lengths, best_fit(lengths, capacity), capacity, steps)
    _, bins = np.unique(bins, return_inverse=True)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    firsts = np.r_[True, bins[order][1:] != bins[order][:-1]] if len(order) else np.array([], bool)
    begins = ends - lengths[order]
    offset = np.empty(len(order), np.int64)
    offset[order] = begins - np.maximum.accumulate(np.where(firsts, begins, 0))
    block["sequence_id"] = (block["block"].to_numpy(np.int64) << 32) + bins
    block["offset"] = offset
    return block.drop(columns=["block", "row"])


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    block: int = BLOCK,
    steps: int | None = None,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset): documents in sequences.

    Whole texts are encoded and end with id 0; only documents longer than `capacity`
    are cut. Pieces are dealt at random into blocks of about `block`, each packed by
    best fit and local search in one task: lengths mix the same way everywhere, so a
    block loses less than one sequence against packing all together. A null or empty
    text is the end token alone; rows that repeat, and null ids, are packed like any
    other row. Very long texts become many pieces of one document; equal lengths go by
    row. Other columns are ignored; an empty table gives an empty one. `steps` bounds the
    exchanges of a block, which otherwise go on until none is left.
    """
    pieces = stored(token_pieces(docs, id_col, text_col, tokenizer, capacity), "pieces")
    blocks = -(-pieces.count() // block) or 1
    # Row numbers come from the written files, so a task that runs again deals alike.
    rows = pieces.withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    packed = rows.groupBy("block").applyInPandas(lambda b: _packed(b, capacity, steps), _PACKED)
    return packed.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *packed.columns[1:]
    )
