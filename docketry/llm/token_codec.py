"""Token-ID output by an adaptive context-mixing range coder (operator 8).

Format of a segment (little-endian): b"CMR2", uint32 blocks; for each block uint32 ids,
uint32 words, uint32 CRC-32 of the ids as uint32; the order-0 table (uint32 symbols, uint32
bytes, and so many bytes of zlib: byte planes of the differences of its ids, then of their
frequencies and that of any other id); then the blocks' 32-bit words one after another. A
block holds BLOCK ids or fewer, starts from a fresh model and can be decoded alone. Coding
an id x after ids p1 (last) and p2:

* order 2 and order 1 each predict the id that last followed their context in the block,
  from a table hashed by context; the candidate is that of order 2, else that of order 1.
* a flag says whether x is the candidate. Its probability mixes a counter chosen by which
  orders know something and whether they agree with one chosen by the last four flags too,
  by a weight that moves to whichever was closer.
* otherwise order 0 codes x by the frequencies of the segment (a segment of less than LARGE
  ids has none: any other id); any other id has its 32 bits follow.

Arithmetic is on integers only, so every machine decodes alike. Blocks are coded in
lockstep: each numpy operation handles one id of each block of a segment.
"""

from __future__ import annotations

import string
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import CASED, Words, chunks, shared_dir, table, text_bytes

MAGIC = b"CMR2"
#: Ids of a block, and of a segment that has an order-0 table.
BLOCK, LARGE = 2048, 1 << 16
#: Ids of a segment (a row of the file, and what a worker codes at once, in some 15 bytes an id) and text of a file.
SEGMENT, FILE_BYTES = 3 << 20, 24 << 20
VOCABULARY, END_ID = "word_bpe_49k.json", 1
SLOTS, _SHIFT = 2048, np.uint32(21)  # the top 11 bits of a 32-bit hash
#: Ids in the order-0 table at most, and the sum of its frequencies.
SYMBOLS, TOTAL = 20_000, 1 << 16
#: Ids below this are counted and ranked by a table instead of a search.
DIRECT = 1 << 18
#: Words that a worker remembers (some 50 bytes each); a full one forgets those that came in one chunk only, which changes no result.
REMEMBERED = 600_000
_12, _16, _32, _SHORT = np.uint64(12), np.uint64(16), np.uint64(32), np.uint64(1 << 32)
_TOP = np.uint64(2**64 - 1)


def _counted(ids: np.ndarray):
    count = np.bincount(ids)
    symbols = np.flatnonzero(count)
    return symbols.astype(np.uint32), count[symbols]


class _Table:
    """Order 0: the more frequent ids of a segment with frequencies that sum to TOTAL; the last symbol is any other id."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray):
        self.symbols, self.freq = symbols, freq.astype(np.uint64)
        self.cum = np.cumsum(self.freq) - self.freq
        self.other = len(symbols)
        self.by_value = np.repeat(np.arange(len(freq)), freq)

    @classmethod
    def of(cls, ids: np.ndarray):
        if len(ids) < LARGE:
            return cls(np.zeros(0, np.uint32), np.array([TOTAL]))
        symbols, count = np.unique(ids, return_counts=True) if ids.max() >= DIRECT else _counted(ids)
        if len(symbols) > SYMBOLS:
            keep = np.sort(np.argsort(-count, kind="stable")[:SYMBOLS])
            symbols, count = symbols[keep], count[keep]
        count = np.append(count, max(1, len(ids) - count.sum()))
        freq = np.maximum(1, count * (TOTAL - len(count)) // count.sum())
        freq[freq.argmax()] += TOTAL - freq.sum()
        return cls(symbols, freq)

    def pack(self) -> bytes:
        body = zlib.compress(np.concatenate([np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4"), self.freq.astype("<u4")]).view(np.uint8).reshape(-1, 4).T.tobytes(), 9) if self.other else b""
        return struct.pack("<II", self.other, len(body)) + body

    @classmethod
    def unpack(cls, data: bytes, at: int):
        n, size = struct.unpack_from("<II", data, at)
        if not n:
            return cls(np.zeros(0, np.uint32), np.array([TOTAL])), at + 8
        planes = np.frombuffer(zlib.decompress(data[at + 8 : at + 8 + size]), np.uint8).reshape(4, -1)
        both = np.ascontiguousarray(planes.T).view("<u4")[:, 0]
        return cls(np.cumsum(both[:n], dtype=np.uint32), both[n:].astype(np.int64)), at + 8 + size

    def rank(self, ids: np.ndarray) -> np.ndarray:
        if self.other and ids.max() < DIRECT:
            direct = np.full(DIRECT, self.other, np.uint16)
            direct[self.symbols[self.symbols < DIRECT]] = np.arange((self.symbols < DIRECT).sum())
            return direct.take(ids)
        at = np.searchsorted(self.symbols, ids)
        return np.where(self.symbols[np.minimum(at, self.other - 1)] == ids, at, self.other) if self.other else np.zeros(len(ids), np.int64)


class _Model:
    """Orders 1 and 2 of all blocks: the id that last followed a context, plus 1 (0: none yet), and the flag's odds."""

    def __init__(self, lanes: int):
        self.next1, self.next2 = np.zeros(lanes * SLOTS, np.uint32), np.zeros(lanes * SLOTS, np.uint32)
        self.by_state, self.by_past = np.full(lanes * 8, 8192, np.int32), np.full(lanes * 64, 8192, np.int32)
        self.weight, self.past = np.full(lanes, 32, np.int32), np.zeros(lanes, np.int64)
        self.p1, self.p2 = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
        lane = np.arange(lanes, dtype=np.int64)
        self.slot, self.eight, self.sixty4 = lane * SLOTS, lane * 8, lane * 64

    def predict(self, n: int):
        k = self.p1[:n] * np.uint32(0x9E3779B1)
        h1 = self.slot[:n] + (k >> _SHIFT)
        k ^= self.p2[:n]
        k *= np.uint32(0x85EBCA6B)
        h2 = self.slot[:n] + (k >> _SHIFT)
        g1, g2 = self.next1.take(h1), self.next2.take(h2)
        two = g2 != 0
        guess = np.where(two, g2, g1)
        state = two * np.int8(2) + ((guess == g1) & (g1 != 0))  # 0: nothing known, 1: order 1, 2: order 2 against 1, 3: both
        past = self.past[:n]
        a = self.eight[:n] + (state * np.int8(2) + (past & 1))
        b = self.sixty4[:n] + (state * np.int8(16) + past)
        one, other = self.by_state.take(a), self.by_past.take(b)
        p = (other * 64 + (one - other) * self.weight[:n]) >> 10
        np.minimum(p, 4094, out=p)
        np.maximum(p, 2, out=p)
        self._at = h1, h2, a, b, one, other
        return guess, p.astype(np.uint64)

    def update(self, n: int, x, hit):
        """x: the ids plus 1."""
        h1, h2, a, b, one, other = self._at
        self.next1[h1] = x
        self.next2[h2] = x
        goal = hit * np.int32(65535)
        ea, eb = goal - one, goal - other
        self.by_state[a] = one + (ea >> 5)
        self.by_past[b] = other + (eb >> 4)
        w = self.weight[:n]
        w += np.abs(ea) < np.abs(eb)
        w -= np.abs(eb) < np.abs(ea)
        np.minimum(w, 60, out=w)
        np.maximum(w, 4, out=w)
        past = self.past[:n]
        past <<= 1
        past += hit
        past &= 15
        self.p2[:n] = self.p1[:n]
        self.p1[:n] = x


def _lanes(total: int):
    """Lengths of the blocks of `total` ids; all but the last are full, so active ones come first."""
    full, rest = divmod(total, BLOCK)
    return np.array([BLOCK] * full + [rest] * (rest > 0), np.int64)


def encode(ids: np.ndarray) -> bytes:
    """The segment of ids (0 to 2**32 - 1)."""
    ids = np.ascontiguousarray(ids, np.uint32)
    length = _lanes(len(ids))
    lanes = len(length)
    if not lanes:
        return MAGIC + struct.pack("<I", 0)
    table, steps = _Table.of(ids), int(length[0])
    grid = np.zeros((lanes, steps), np.uint32)
    grid.flat[: len(ids)] = ids
    ranks = np.zeros((lanes, steps), np.uint16)
    for at in range(0, len(ids), 1 << 20):
        ranks.flat[at : at + (1 << 20)] = table.rank(ids[at : at + (1 << 20)])[: len(ids) - at]
    far = ranks == table.other
    cap = steps - steps // 8 + int(far.sum(axis=1).max()) + 4  # a step takes 28 bits, and 32 more for an id outside the table
    any_far = far.any(axis=0)
    del far
    grid, ranks = np.ascontiguousarray(grid.T), np.ascontiguousarray(ranks.T)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, _TOP, np.uint64)
    out = np.zeros(lanes * cap, np.uint32)
    base = np.arange(lanes, dtype=np.int64) * cap
    pos = base.copy()  # of the next word of each block in out
    carries = []
    model = _Model(lanes)

    def add(who, more):
        l = low[who] + more
        over = who[l < more]
        if len(over):
            carries.append(pos[over] - 1)
        return l

    def settle(n):
        short = np.flatnonzero(rng[:n] < _SHORT)
        l, at = low[short], pos[short]
        out[at] = l >> _32
        pos[short] = at + 1
        low[short] = l << _32
        rng[short] <<= _32

    for t in range(steps):
        n = lanes if t < length[-1] else lanes - 1
        x = grid[t, :n]
        guess, p = model.predict(n)
        plus = x + np.uint32(1)
        hit = (guess == plus) & (guess != 0)
        bound = (rng[:n] >> _12) * p
        who = np.flatnonzero(~hit)
        rest = bound[who]
        part = (rng[who] - rest) >> _16
        s = ranks[t].take(who)
        low[who] = add(who, rest + part * table.cum.take(s))
        rng[:n] = bound
        rng[who] = part * table.freq.take(s)
        if any_far[t]:
            who = who[s == table.other]
            settle(n)
            part = rng[who] >> _32
            low[who] = add(who, part * x[who])
            rng[who] = part
        settle(n)
        model.update(n, plus, hit)
    del grid, ranks
    for k in (32, 0):
        out[pos] = (low >> np.uint64(k)) & (_SHORT - np.uint64(1))
        pos += 1
    pos -= base
    words = np.ascontiguousarray(out.reshape(lanes, cap)[:, : int(pos.max())].T).astype(np.uint64)
    if carries:
        row, column = np.divmod(np.concatenate(carries), cap)
        np.add.at(words, (column, row), np.uint64(1))
    for k in range(len(words) - 1, 0, -1):
        carry = words[k] >> _32
        if carry.any():
            words[k - 1] += carry
            words[k] &= _SHORT - np.uint64(1)
    at = np.concatenate([[0], np.cumsum(length)])
    head = [struct.pack("<III", int(length[d]), int(pos[d]), zlib.crc32(ids[at[d] : at[d + 1]].astype("<u4").tobytes())) for d in range(lanes)]
    words = words.astype("<u4").T
    body = words[np.arange(words.shape[1])[None, :] < pos[:, None]]
    return MAGIC + struct.pack("<I", lanes) + b"".join(head) + table.pack() + body.tobytes()


def decode(data: bytes) -> np.ndarray:
    """The ids of a segment; a block whose checksum does not hold raises ValueError."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment of this format")
    (lanes,) = struct.unpack_from("<I", data, 4)
    head = np.frombuffer(data, "<u4", 3 * lanes, 8).reshape(lanes, 3).astype(np.int64)
    length, count = head[:, 0], head[:, 1]
    if not lanes:
        return np.zeros(0, np.uint32)
    table, at = _Table.unpack(data, 8 + 12 * lanes)
    words = np.append(np.frombuffer(data, "<u4", int(count.sum()), at), np.zeros(4, "<u4")).astype(np.uint64)
    pos = np.cumsum(count) - count
    code = (words[pos] << _32) | words[pos + 1]
    pos += 2
    edge = len(words) - 1
    rng = np.full(lanes, _TOP, np.uint64)
    steps = int(length[0])
    model = _Model(lanes)
    grid = np.zeros((steps, lanes), np.uint32)
    symbols = np.append(table.symbols, np.uint32(0))

    def settle(n):
        short = np.flatnonzero(rng[:n] < _SHORT)
        at = pos[short]
        code[short] = (code[short] << _32) | words.take(np.minimum(at, edge))
        pos[short] = at + 1
        rng[short] <<= _32

    for t in range(steps):
        n = lanes if t < length[-1] else lanes - 1
        guess, p = model.predict(n)
        bound = (rng[:n] >> _12) * p
        hit = (code[:n] < bound) & (guess != 0)
        who = np.flatnonzero(~hit)
        rest = bound[who]
        c, part = code[who] - rest, (rng[who] - rest) >> _16
        s = table.by_value.take(np.minimum(c // part, np.uint64(TOTAL - 1)).astype(np.int64))
        code[who] = c - part * table.cum.take(s)
        rng[:n] = bound
        rng[who] = part * table.freq.take(s)
        x = guess - np.uint32(1)
        x[who] = symbols.take(s)
        far = who[s == table.other]
        if len(far):
            settle(n)
            part = np.maximum(rng[far] >> _32, np.uint64(1))
            value = np.minimum(code[far] // part, _SHORT - np.uint64(1))
            code[far] -= part * value
            rng[far] = part
            x[far] = value
        settle(n)
        grid[t, :n] = x
        model.update(n, x + np.uint32(1), hit)
    ids = np.ascontiguousarray(grid.T).reshape(-1)[: int(length.sum())]
    at = np.concatenate([[0], np.cumsum(length)])
    for d in range(lanes):
        if zlib.crc32(ids[at[d] : at[d + 1]].astype("<u4").tobytes()) != head[d, 2]:
            raise ValueError(f"checksum of block {d} does not hold")
    return ids


_LETTER, _PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCTUATION[[ord(c) for c in string.punctuation]] = True


class WordIds:
    """Ids of words, remembered by the hash of each word with A-Z lower-cased, as this kind of vocabulary does.

    Letters with punctuation behind are two words to the tokenizer. Words of letters are
    encoded many to a call and told apart by the end-of-word mark of their last piece, if
    the marks fit; ASCII ones by the vocabulary's model alone, as nothing else changes them.
    All other words are encoded one by one.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.whole.model._resize_cache(0)  # each word comes once
        self.bare = Tokenizer(self.whole.model)  # the same vocabulary in memory
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for piece, i in vocabulary.items():
            self.ends[i] = piece.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        """Of a word: its hash and up to two parts; of a part: where in ids it begins and how many it has. Part 0 is empty."""
        self.keys, self.of = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # of the parts
        self.hash, self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.chunks = np.zeros(0, np.uint8)  # in how many chunks a word was, 2 for more
        self.begin, self.size, self.ids = np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros(0, np.uint32)

    def forget_rare(self) -> None:
        """Keep the words that came in more than one chunk, and their parts."""
        keep = self.chunks > 1
        self.hash, self.first, self.second, self.chunks = self.hash[keep], self.first[keep], self.second[keep], self.chunks[keep] - 1
        used = np.unique(np.concatenate([[0], self.first, self.second]))
        new = np.full(len(self.size), -1, np.int32)
        new[used] = np.arange(len(used))
        size = self.size[used]
        stop = np.cumsum(size, dtype=np.int64)
        self.ids = self.ids[np.repeat(self.begin[used] - (stop - size), size) + np.arange(int(size.sum()))]
        self.begin, self.size = (stop - size).astype(np.int32), size
        keep = new[self.of] >= 0
        self.keys, self.of, self.first, self.second = self.keys[keep], new[self.of[keep]], new[self.first], new[self.second]

    def _add(self, sizes, ids) -> None:
        self.begin = np.append(self.begin, (len(self.ids) + np.cumsum(sizes) - sizes).astype(np.int32))
        self.size, self.ids = np.append(self.size, sizes.astype(np.int32)), np.append(self.ids, ids)

    def _single(self, words) -> tuple[list, list]:
        """(sizes, ids) of words, each encoded by itself."""
        got = [e.ids for e in self.whole.encode_batch_fast(words, add_special_tokens=False)]
        return list(map(len, got)), [i for ids in got for i in ids]

    def _letters(self, tokenizer, words: list[bytes]) -> tuple[list, list]:
        """The same of words of letters, many to a call."""
        sizes, out = [], []
        groups = [words[j : j + 400] for j in range(0, len(words), 400)]
        for k in range(0, len(groups), 50):
            some = groups[k : k + 50]
            for group, e in zip(some, tokenizer.encode_batch_fast([b" ".join(g).decode("utf-8") for g in some], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, np.uint32)
                stop = np.flatnonzero(self.ends[ids]) + 1
                if len(stop) == len(group) and stop[-1] == len(ids):
                    sizes.append(np.diff(stop, prepend=0))
                    out.append(ids)
                else:
                    for w, got in zip(group, self.whole.encode_batch_fast([w.decode("utf-8") for w in group], add_special_tokens=False), strict=True):
                        sizes.append([len(got.ids)])
                        out.append(got.ids)
        return np.concatenate(sizes), np.concatenate(out)

    def _part(self, w: Words, start: np.ndarray, end: np.ndarray, learn, data: bytes) -> np.ndarray:
        """The parts that stand at these places; learn gives sizes and ids of the unknown ones."""
        keys, at, inverse = np.unique(w.hash_of(start, end), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        new = np.flatnonzero((place == len(self.keys)) | (np.append(self.keys, np.uint64(0))[place] != keys))
        if len(new):
            before = len(self.size)
            self._add(*(np.asarray(x, kind) for x, kind in zip(learn([data[a:b] for a, b in zip(start[at[new]].tolist(), end[at[new]].tolist(), strict=True)]), (np.int64, np.uint32), strict=True)))
            self.of = np.insert(self.of, place[new], np.arange(before, len(self.size)))
            self.keys = np.insert(self.keys, place[new], keys[new])
            place = np.searchsorted(self.keys, keys)
        return self.of[place][inverse]

    def learn(self, w: Words, new: np.ndarray) -> None:
        """Of words number new of a chunk, in order of their hashes, none of them known and no two alike."""
        start, end = w.start[new], w.end[new]
        here = np.arange(1, len(w.bytes) + 1, dtype=np.int32)
        here[_PUNCTUATION[w.bytes]] = 0
        last = np.maximum.accumulate(here)[end - 1].astype(np.int64)  # where the word ends without punctuation behind
        letters = np.append(0, np.cumsum(_LETTER[w.bytes], dtype=np.int32))
        plain = (last > start) & (letters[np.maximum(last, start)] - letters[start] == last - start)
        data = w.bytes.tobytes()
        first, second = np.zeros(len(new), np.int32), np.zeros(len(new), np.int32)
        first[plain] = self._part(w, start[plain], last[plain], lambda words: self._letters(self.bare, words), data.lower())
        at = np.flatnonzero(~plain)
        core = np.array([last[k] > start[k] and data[start[k] : last[k]].decode("utf-8").isalpha() for k in at.tolist()], bool)

        def single(words):
            return self._single([x.decode("utf-8") for x in words])

        first[at[core]] = self._part(w, start[at[core]], last[at[core]], lambda words: self._letters(self.whole, words), data)
        first[at[~core]] = self._part(w, start[at[~core]], end[at[~core]], single, data)
        plain[at[core]] = True
        at = np.flatnonzero(plain & (last < end))
        second[at] = self._part(w, last[at], end[at], single, data)
        place = np.searchsorted(self.hash, w.hash[new])
        self.hash, self.first, self.second, self.chunks = (np.insert(old, place, more) for old, more in ((self.hash, w.hash[new]), (self.first, first), (self.second, second), (self.chunks, 0)))

    def encode(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the ids of the texts of a chunk (see words_of) one after another, and how many each text has."""
        inverse, hashes = pd.factorize(w.hash)  # by a hash table, so in no order
        at = np.empty(len(hashes), np.int64)
        at[inverse[::-1]] = np.arange(len(inverse) - 1, -1, -1)
        order = np.argsort(hashes)
        if len(self.hash) + len(hashes) > REMEMBERED:
            self.forget_rare()
        if len(self.hash) + len(hashes) > REMEMBERED:
            self.forget()
        known = np.empty(len(hashes), np.int64)
        known[order] = np.searchsorted(self.hash, hashes[order])
        place = known[order]
        new = order[(place == len(self.hash)) | (np.append(self.hash, np.uint64(0))[place] != hashes[order])]
        if len(new):
            self.learn(w, at[new])
            known[order] = np.searchsorted(self.hash, hashes[order])
        self.chunks[known] = np.minimum(self.chunks[known] + 1, 2)
        first, second = self.first[known], self.second[known]
        if second.any():
            part = np.stack([first, second], axis=1)[inverse].reshape(-1)
            per = 2
        else:
            part, per = first[inverse], 1
        size = self.size[part].astype(np.int64)
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        gather = np.repeat(self.begin[part] - (stop - size), size)
        gather += np.arange(total)
        before = np.append(0, stop)[per * w.first]
        return self.ids[gather], np.diff(before)


def remembered(path: str) -> WordIds:
    """The word memory of this worker process, which later tasks find again.

    It hangs on the tokenizers module: functions of this library travel by value, so its own
    modules' variables begin anew in each task. What it holds depends on the vocabulary alone.
    """
    import tokenizers

    held = tokenizers.__dict__.setdefault("_remembered_words", {})
    if path not in held:
        held.clear()
        held[path] = WordIds(path)
    return held[path]


def words_of(texts: pa.Array) -> Words:
    """The words of a chunk, with A-Z as a-z but where a text may hold a special token, which is told from its look-alikes."""
    found = pc.any(pc.match_substring(texts, "<|")).as_py()
    return Words(texts, byte=CASED) if found else Words(texts)


def _writer(path: str, end_id: int):
    def run(batches):
        words = remembered(path)
        shard, segment = TaskContext.get().partitionId(), 0
        docs, sizes, parts, held = [], [], [], 0

        def row():
            data = np.concatenate(parts)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([segment], pa.int64()), pa.array([len(data)], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([np.concatenate(sizes)], pa.list_(pa.int64())), pa.array([encode(data)], pa.binary())], ["shard", "segment", "n_ids", "docs", "sizes", "payload"])

        for part in chunks(batches):
            ids, size = words.encode(words_of(part.column(1)))
            stop = np.cumsum(size + 1)
            whole = np.full(int(stop[-1]), end_id, np.uint32)
            inside = np.ones(len(whole), bool)
            inside[stop - 1] = False
            whole[inside] = ids
            docs += part.column(0).to_pylist()
            sizes.append(size + 1)
            parts.append(whole)
            held += len(whole)
            if held >= SEGMENT:
                yield row()
                docs, sizes, parts, held, segment = [], [], [], 0, segment + 1
        if docs:
            yield row()

    return run


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents (doc_id, text) in ascending doc_id order, end_id after each.

    Files are Parquet containers of segments: shard and segment give the order, docs and
    sizes what a segment holds, payload the coded ids. The words of a text that white space
    parts are encoded one by one, which this kind of vocabulary allows, and remembered.
    Null, empty and wordless texts are the end id alone. Rows without a doc_id are left
    out; rows with the same doc_id follow each other in order of their text.
    """
    rows = docs.select("doc_id", "text").where("doc_id is not null")
    files = max(12, -(-text_bytes(rows) // FILE_BYTES))
    ordered = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_writer(tokenizer, end_id), "shard long, segment long, n_ids long, docs array<long>, sizes array<long>, payload binary").write.parquet(path)


def _reader(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            shard, segment, docs, sizes, payload = (batch.column(batch.schema.get_field_index(c))[k] for c in ("shard", "segment", "docs", "sizes", "payload"))
            ids = decode(payload.as_py())
            size = np.array(sizes.as_py(), np.int64)
            stop = np.cumsum(size)
            start = stop - size
            crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(start, stop, strict=True)]
            n = len(size)
            yield pa.RecordBatch.from_arrays([docs.values, pa.array(np.full(n, shard.as_py())), pa.array(np.full(n, segment.as_py())), pa.array(start), pa.array(size), pa.array(crc, pa.int64())], ["doc_id", "shard", "segment", "at", "n_tokens", "ids_crc32"])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of written files, from the decoded ids: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.parquet(path)
    segment = files.select("shard", "segment", "n_ids")
    shard = segment.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    shard = shard.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    segment = segment.select("shard", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("segment_start"))
    rows = files.mapInArrow(_reader, "doc_id long, shard long, segment long, at long, n_tokens long, ids_crc32 long")
    out = rows.join(segment, ["shard", "segment"]).join(shard, "shard")
    return out.select("doc_id", (F.col("shard_start") + F.col("segment_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_ids(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """write_ids, then read_index of what was written (in the shared folder unless path is given)."""
    import uuid

    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write_ids(docs, tokenizer, path)
    return read_index(spark, path)


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_ids(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
