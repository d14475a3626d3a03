"""Byte-level BPE as finite-state transducers, run on many texts at once.

Two transducers are composed.  The first splits a text into pretokens: its states tell what the current
pretoken can still become, its transitions are annotated with the boundaries they emit.  A text is cut into
lanes of LANE characters; all lanes run side by side, first as maps from every possible state to a state (of the lane's last characters, if these settle it),
then, after a prefix scan has composed the maps, from the true state of each lane.  The second transducer
reads a whole pretoken and emits its tokens; its accepting entries (hash of the pretoken -> token ids and
their count) are compiled when a pretoken is first met, for all new pretokens of a chunk together, and kept.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import regex

from palimpsest.llm._vec import mix, prefix_hash, span_hash

LANE = 256
#: The last characters of a lane that are read first: if they lead all states to one, so does the whole lane.
TAIL = 16
#: Code points in one chunk of texts (a longer text makes its own chunk), and pretokens that a worker keeps.
CHUNK_CHARS, KEEP = 1 << 20, 3 << 19
#: Pretokens of more bytes are merged one by one, shorter ones side by side, so many at a time.
LONG_PRETOKEN, BLOCK = 48, 2048
#: Random slots tried for a row of the table of merges before it is made longer.
TRIES = 200
#: A place in a short pretoken takes so many bits beside a merge's rank; the rank of no merge, on which the places still fit 32 bits.
PLACE, NONE = 6, np.int32(1 << 24)

# character classes
OTHER, LETTER, NUMBER, SPACE, WHITE, APOSTROPHE, STMD, R_, V_, L_, E_, END = range(12)
_LETTERS = {LETTER, STMD, R_, V_, L_, E_}
# states
S_START, S_L, S_N, S_O, S_SPACE, S_WHITE, S_SPACES, S_WHITES, S_A, S_AR, S_AV, S_AL = range(12)
N_STATES = 12


def split_transducer() -> tuple[np.ndarray, np.ndarray]:
    """next[state * 12 + class] and its emission: bit 0 a boundary before this character, bit 1 before the last."""

    def fresh(c: int) -> tuple[int, int]:
        if c == END:
            return S_START, 1
        return {OTHER: S_O, NUMBER: S_N, SPACE: S_SPACE, WHITE: S_WHITE, APOSTROPHE: S_A}.get(c, S_L), 1

    def joined(c: int) -> int:
        """State after a character that continues a pretoken begun by one space."""
        return S_L if c in _LETTERS else S_N if c == NUMBER else S_O

    def step(s: int, c: int) -> tuple[int, int]:
        if s == S_START or c == END:
            state, flag = fresh(c)
            return state, flag | (2 if c == END and s in (S_AR, S_AV, S_AL) else 0)
        if s == S_L and c in _LETTERS:
            return S_L, 0
        if s == S_N and c == NUMBER:
            return S_N, 0
        if s == S_O and c in (OTHER, APOSTROPHE):
            return S_O, 0
        if s in (S_SPACE, S_WHITE, S_SPACES, S_WHITES):
            if c in (SPACE, WHITE):
                return (S_SPACES if c == SPACE else S_WHITES), 0
            if s == S_SPACE:
                return joined(c), 0
            if s == S_SPACES:
                return joined(c), 2
            state, flag = fresh(c)
            return state, flag | (2 if s == S_WHITES else 0)
        if s == S_A:
            if c == STMD:
                return S_START, 0
            if c in (R_, V_, L_):
                return {R_: S_AR, V_: S_AV, L_: S_AL}[c], 0
            if c in (OTHER, APOSTROPHE):
                return S_O, 0
        if s in (S_AR, S_AV, S_AL):
            if c == (L_ if s == S_AL else E_):
                return S_START, 0
            if c in _LETTERS:
                return S_L, 2
            state, flag = fresh(c)
            return state, flag | 2
        return fresh(c)

    pairs = [step(s, c) for s in range(N_STATES) for c in range(12)]
    return np.array([p[0] for p in pairs], np.uint8), np.array([p[1] for p in pairs], np.uint8)


def character_classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    everything = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for pattern, c in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
        for m in regex.finditer(pattern, everything):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a : b + 1] = c  # runs don't cross the surrogates: those are OTHER on both sides
    out[ord(" ")], out[ord("'")] = SPACE, APOSTROPHE
    for c, letters in ((STMD, "stmd"), (R_, "r"), (V_, "v"), (L_, "l"), (E_, "e")):
        out[[ord(x) for x in letters]] = c
    return out


class Table:
    """Open-addressing map from 64-bit hashes to int32, filled and read by whole arrays."""

    def __init__(self, bits: int = 12):
        self.bits, self.n = bits, 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def get(self, h: np.ndarray) -> np.ndarray:
        size = (1 << self.bits) - 1
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self.values[at]
        other = self.keys[at] != h
        open_ = np.flatnonzero(other & (out >= 0))
        out[other] = -1
        while len(open_):
            at[open_] = (at[open_] + 1) & size
            p = at[open_]
            same, used = self.keys[p] == h[open_], self.values[p] >= 0
            out[open_[same & used]] = self.values[p[same & used]]
            open_ = open_[used & ~same]
        return out

    def put(self, h: np.ndarray, v: np.ndarray) -> None:
        """New hashes, all different."""
        if (self.n + len(h)) * 2 > 1 << self.bits:
            used = self.values >= 0
            h, v = np.concatenate([self.keys[used], h]), np.concatenate([self.values[used], v])
            bits = self.bits
            while len(h) * 2 > 1 << bits:
                bits += 1
            self.__init__(bits)
        size = (1 << self.bits) - 1
        at, left = (h >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(len(h))
        while len(left):
            p = at[left]
            empty = self.values[p] < 0
            w = left[empty]
            self.keys[p[empty]], self.values[p[empty]] = h[w], v[w]
            placed = self.keys[p] == h[left]
            left = left[~placed]
            at[left] = (at[left] + 1) & size
        self.n += len(h)


def extended(a: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """a, or a copy with as much room again, with more in the places after the used ones."""
    if used + len(more) > len(a):
        a = np.concatenate([a[:used], np.empty(max(used, len(more)), a.dtype)])
    a[used : used + len(more)] = more
    return a


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Transducer:
    """Tokens of whole texts by a byte-level BPE file; counts and ids equal those of its library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        vocab = d["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in d.get("added_tokens", [])}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.byte_id = np.array([vocab[c] for c in byte_alphabet()], np.int32)
        self.width = np.int64(max(vocab.values()) + 1)
        self.merge: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(d["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault(int(vocab[a] * self.width + vocab[b]), (rank, vocab[a + b]))
        if len(d["model"]["merges"]) >= NONE:
            raise ValueError(f"a vocabulary of {NONE} merges or more")
        self.lay()
        # at state * 16 + class: the next state * 16 and the emission; a table of bytes is read fastest by translate
        after, emitted = (x.reshape(N_STATES, 12) for x in split_transducer())
        steps = np.zeros((16, 16), np.uint8)
        steps[:N_STATES, :12] = after << 4 | emitted
        self.steps = steps.tobytes()
        self.classes = character_classes()
        self.reset()

    def lay(self) -> None:
        """Table of merges: the pair a, b lies at slot shift[a] + b, whose owner is a; rows of a's pairs are laid so that none meet."""
        key = np.fromiter(self.merge, np.int64, len(self.merge))
        rank, new = (np.fromiter((m[i] for m in self.merge.values()), np.int32, len(key)) for i in (0, 1))
        self.made = np.zeros(int(rank.max(initial=-1)) + 1, np.int32)
        self.made[rank] = new
        span = int(self.width) + 1
        self.shift, self.owner = np.zeros(span, np.int32), np.full(8 * len(key) + span, -1, np.int32)
        order = np.argsort(key)
        left, right = np.divmod(key[order], self.width)
        first = np.flatnonzero(np.diff(left, prepend=-1))
        end = np.append(first[1:], len(left))
        rng = np.random.default_rng(0)
        for k in np.argsort(first - end, kind="stable").tolist():  # long rows first
            a, b = left[first[k]], right[first[k] : end[k]]
            for d in rng.integers(len(self.owner) - span + 1, size=TRIES).tolist():
                if (self.owner[b + d] < 0).all():
                    break
            else:  # it goes behind all others
                d = len(self.owner)
                self.owner = np.append(self.owner, np.full(span, -1, np.int32))
            self.shift[a], self.owner[b + d] = d, a
        self.rank = np.full(len(self.owner), NONE, np.int32)
        self.rank[self.shift[left] + right] = rank[order]

    def reset(self) -> None:
        self.words = Table(16)
        self.count, self.start, self.pool, self.filled = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32), 0

    # -- first transducer ---------------------------------------------------------------------------------
    def step(self, x: np.ndarray, c: np.ndarray) -> np.ndarray:
        """From states (times 16, what they emitted is ignored) by one character of each lane: the states (times 16) and what is emitted."""
        return np.frombuffer((x & np.uint8(0xF0) | c).tobytes().translate(self.steps), np.uint8).reshape(x.shape)

    def maps(self, c: np.ndarray) -> np.ndarray:
        """From every state the state after the characters of each lane (a column of classes)."""
        maps = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None] << np.uint8(4), c.shape[1], 1)
        for row in c:
            maps = self.step(maps, row)
        return maps >> np.uint8(4)

    def boundaries(self, cls: np.ndarray) -> np.ndarray:
        """Which characters begin a pretoken; a text's end does too."""
        n = len(cls)
        lanes = -(-n // LANE)
        c = np.full(lanes * LANE, END, np.uint8)
        c[:n] = cls
        c = np.ascontiguousarray(c.reshape(lanes, LANE).T)
        maps = self.maps(c[-TAIL:])
        open_ = np.flatnonzero((maps != maps[0]).any(0))
        maps[:, open_] = self.maps(c[:, open_])
        maps = np.ascontiguousarray(maps.T)
        d = 1
        while d < lanes:  # prefix scan: map i becomes the composition of maps 0 to i; one that leads all states to one is that already
            open_ = d + np.flatnonzero((maps[d:] != maps[d:, :1]).any(1))
            if not len(open_):
                break
            maps[open_] = np.take_along_axis(maps[open_], maps[open_ - d].astype(np.int64), 1)
            d *= 2
        x = np.concatenate([[np.uint8(S_START)], maps[:-1, S_START]]).astype(np.uint8) << np.uint8(4)
        flags = np.empty_like(c)
        for t, row in enumerate(c):
            flags[t] = x = self.step(x, row)
        flags = flags.T.reshape(-1)[:n]
        out = (flags & 1).astype(bool)
        out[:-1] |= (flags[1:] & 2).astype(bool)
        return out

    # -- second transducer --------------------------------------------------------------------------------
    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids (the width: padding), or NONE."""
        at = self.shift[a] + b
        return np.where(self.owner[at] == a, self.rank[at], NONE)

    def merged(self, tok: np.ndarray) -> np.ndarray:
        """Tokens of short pretokens: a column each, of the bytes' ids and then padding, as is the last row.

        Each column has its least rank and where that stands in one number; all columns merge their first such pair in a round.
        """
        tok, out = tok.copy(), tok.copy()
        place = np.arange(len(tok) - 1, dtype=np.int32)[:, None]
        key = (self.ranks(tok[:-1], tok[1:]) << PLACE) | place
        live = np.arange(tok.shape[1])
        while True:
            best = key.min(0)
            go = best >> PLACE < NONE
            n = np.count_nonzero(go)
            if n * 4 <= 3 * len(live):
                out[:, live[~go]] = tok[:, ~go]
                tok, key, live, best, go = tok[:, go], key[:, go], live[go], best[go], go[go]
                if not n:
                    return out
            p = np.where(go, best & ((1 << PLACE) - 1), len(place))
            after = place[1:] > p
            tok[1:-1] = np.where(after, tok[2:], tok[1:-1])
            key[1:-1] = np.where(after[:-1], key[2:] - 1, key[1:-1])
            key[-1] = np.where(after[-1], (NONE << PLACE) | place[-1], key[-1])
            at = np.flatnonzero(go)
            p = p[at]
            new = self.made[best[at] >> PLACE]
            tok[p, at] = new
            key[p, at] = (self.ranks(new, tok[p + 1, at]) << PLACE) | p
            at, p, new = at[p > 0], p[p > 0] - 1, new[p > 0]
            key[p, at] = (self.ranks(tok[p, at], new) << PLACE) | p

    def compile(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token counts of pretokens (their bytes one after another, and how many each has), where in the returned ids each one's begin, and these ids."""
        counts, starts, size = np.zeros(len(lengths), np.int32), np.zeros(len(lengths), np.int64), 0
        ids: list[np.ndarray] = []
        begin, pad = np.cumsum(lengths) - lengths, np.int32(self.width)
        order = np.argsort(lengths, kind="stable")
        cut = int(np.searchsorted(lengths[order], LONG_PRETOKEN, "right"))
        for k in order[cut:]:
            ids.append(np.array(self.compile_long(data[begin[k] : begin[k] + lengths[k]].tobytes()), np.int32))
            counts[k], starts[k] = len(ids[-1]), size
            size += len(ids[-1])
        for at in range(0, cut, BLOCK):
            part = order[at : min(at + BLOCK, cut)]
            column = np.arange(lengths[part[-1]] + 1)[:, None]
            inside = column < lengths[part]
            tok = np.where(inside, self.byte_id[data[np.where(inside, begin[part] + column, 0)]], pad)
            tok = np.ascontiguousarray(self.merged(tok).T)
            own = tok != pad
            counts[part] = n = own.sum(1)
            starts[part] = size + np.cumsum(n) - n
            ids.append(tok[own])
            size += len(ids[-1])
        return counts, starts, np.concatenate(ids) if ids else np.zeros(0, np.int32)

    def compile_long(self, word: bytes) -> list[int]:
        """The same for one long pretoken, in n log n steps."""
        tok = [int(self.byte_id[b]) for b in word]
        n = len(tok)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        width = int(self.width)

        def push(i: int) -> None:
            j = after[i]
            if j >= 0 and (m := self.merge.get(tok[i] * width + tok[j])):
                heapq.heappush(heap, (m[0], i, tok[i], tok[j], m[1]))

        heap: list[tuple[int, int, int, int, int]] = []
        for i in range(n):
            push(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if tok[i] != a or j < 0 or tok[j] != b:
                continue
            tok[i], tok[j], after[i] = new, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [x for x in tok if x >= 0]

    # -- both ----------------------------------------------------------------------------------------------
    def pretokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Entries (numbers in count and start) of all pretokens, and how many each text has."""
        # a separator that cannot be in a text: a lone surrogate
        joined = "\ud800".join([*texts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        cls = self.classes[codes]
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        cls[ends[1:] - 1] = END
        at = np.flatnonzero(self.boundaries(cls))
        keep = cls[at] != END
        a, b = at[keep], np.append(at, len(cls))[np.flatnonzero(keep) + 1]
        h = span_hash(prefix_hash(codes.astype(np.uint64) + np.uint64(1)), a, b)
        per = np.diff(np.searchsorted(a, ends))
        got = self.words.get(h)
        if len(miss := np.flatnonzero(got < 0)):
            if self.words.n + len(miss) > KEEP:
                self.reset()
                got, miss = np.full(len(h), -1, np.int32), np.arange(len(h))
            new, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            first = miss[first]
            size = b[first] - a[first]
            own = codes[np.arange(size.sum()) + np.repeat(a[first] - (np.cumsum(size) - size), size)]
            data = np.frombuffer(own.tobytes().decode("utf-32-le").encode(), np.uint8)
            wide = np.cumsum(1 + (own >= 0x80) + (own >= 0x800) + (own >= 0x10000))
            counts, starts, ids = self.compile(data, np.diff(wide[np.cumsum(size) - 1], prepend=0))
            base = self.words.n
            self.start, self.count = extended(self.start, base, self.filled + starts), extended(self.count, base, counts)
            self.pool, self.filled = extended(self.pool, self.filled, ids), self.filled + len(ids)
            self.words.put(new, np.arange(base, base + len(new), dtype=np.int32))
            got[miss] = base + back
        return got, per

    def pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Texts cut at special tokens: the ordinary pieces, the text of each, and the special id after it or -1."""
        if not self.cut or not any(any(x in t for x in self.special) for t in texts):
            return texts, np.arange(len(texts)), np.full(len(texts), -1)
        out, owner, after = [], [], []
        for k, t in enumerate(texts):
            at = 0
            for m in self.cut.finditer(t):
                out.append(t[at : m.start()])
                owner.append(k)
                after.append(self.special[m[0]])
                at = m.end()
            out.append(t[at:])
            owner.append(k)
            after.append(-1)
        return out, np.array(owner), np.array(after)

    def _some(self, texts: list[str]):
        at, size = 0, 0
        for k, t in enumerate(texts):
            if k > at and size + len(t) > CHUNK_CHARS:
                yield texts[at:k]
                at, size = k, 0
            size += len(t)
        if at < len(texts):
            yield texts[at:]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of tokens of each text."""
        out = []
        for some in self._some(texts):
            parts, owner, after = self.pieces(some)
            words, per = self.pretokens(parts)
            n = np.concatenate([[0], np.cumsum(self.count[words], dtype=np.int64)])
            ends = np.cumsum(per)
            out.append(np.bincount(owner, n[ends] - n[ends - per] + (after >= 0), len(some)).astype(np.int64))
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        out: list[np.ndarray] = []
        for some in self._some(texts):
            parts, owner, after = self.pieces(some)
            words, per = self.pretokens(parts)
            n = self.count[words].astype(np.int64)
            ends = np.cumsum(n)
            place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[words] - (ends - n), n)
            ids = self.pool[place].astype(np.uint32)
            total = np.concatenate([[0], ends])
            cut = total[np.concatenate([[0], np.cumsum(per)])]
            if len(parts) == len(some):
                out += [ids[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                continue
            own: list[list[np.ndarray]] = [[] for _ in some]
            for k, i, j, x in zip(owner.tolist(), cut[:-1].tolist(), cut[1:].tolist(), after.tolist(), strict=True):
                own[k].append(ids[i:j])
                if x >= 0:
                    own[k].append(np.array([x], np.uint32))
            out += [np.concatenate(x) for x in own]
        return out


_loaded: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One for each file and Python worker."""
    if path not in _loaded:
        _loaded[path] = Transducer(path)
    return _loaded[path]
