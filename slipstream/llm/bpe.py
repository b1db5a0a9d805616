"""BPE encoding as a streaming transducer with bounded lookahead, and decoding by an incremental byte-to-text machine.

Encoding. Merges act in rank order, so whether a merge happens at a place can only be changed from its right by a chain of
overlapping merges of ever lower rank. `lookahead` follows all such chains through the merge list and returns how many
symbols beyond a place can matter at most. A pre-token is read through a window: tokens that end that far before the end of
the window are stable and are emitted, and reading goes on behind them, so memory does not grow with the pre-token. All
pre-tokens of a batch that a worker has not met yet go through their windows in lockstep.
"""

from __future__ import annotations

import codecs
import functools
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.llm import arrow
from slipstream.llm import unicode_classes as uc

CACHED = 50_000  # pre-tokens a worker remembers
CELLS = 1 << 21  # symbols that are merged at a time
_NEVER = np.int32(2**31 - 1)


class Vocabulary:
    """A BPE file of the tokenizers library with byte-level symbols, as arrays."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        if model.get("type") != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("only deterministic byte-level BPE files are read")
        self.content, self.ids, self.suffix = content, model["vocab"], model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.decoder = (spec.get("decoder") or {}).get("type")
        self.names = {i: t for t, i in (self.ids | self.added).items()}
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        signs = uc.byte_alphabet()
        self.inner = np.array([self.ids[signs[b]] for b in range(256)], np.int32)
        self.last = np.array([self.ids[signs[b] + self.suffix] for b in range(256)], np.int32)
        left = np.array([self.ids[a] for a, _ in merges], np.uint64)
        right = np.array([self.ids[b] for _, b in merges], np.uint64)
        keys = (left << np.uint64(32)) | right
        made = np.array([self.ids[a + b] for a, b in merges], np.int32)
        keys, first = np.unique(keys, return_index=True)  # a pair listed twice keeps its first rank
        self._table(keys, first.astype(np.int32), made[first])

    def _table(self, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray) -> None:
        """An open-addressing table of pairs, filled in rounds."""
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 6))))
        size = 1 << self.bits
        self.keys, self.ranks, self.made = np.full(size, 2**64 - 1, np.uint64), np.full(size, _NEVER), np.zeros(size, np.int32)
        slots, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):
            self.probes += 1
            free = todo[self.ranks[slots[todo]] == _NEVER]
            _, winner = np.unique(slots[free], return_index=True)
            placed = free[winner]
            at = slots[placed]
            self.keys[at], self.ranks[at], self.made[at] = keys[placed], ranks[placed], made[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slots[todo] = (slots[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of each pair of ids; the rank is the largest number where there is no merge."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        rank, made = np.full(len(keys), _NEVER), np.zeros(len(keys), np.int32)
        todo = np.arange(len(keys))
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == keys[todo]
            rank[todo[hit]], made[todo[hit]] = self.ranks[slot[hit]], self.made[slot[hit]]
            on = ~hit & (self.ranks[slot] != _NEVER)
            if not on.any():
                break
            todo, slot = todo[on], (slot[on] + 1) & (len(self.keys) - 1)
        return rank, made


def lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int:
    """Symbols beyond a token boundary that can still move it, for this merge list.

    ``need`` of a merge bounds the symbols beyond its right end that decide whether it happens. Only merges of lower rank
    that overlap it (in any way in which the texts agree) can decide it, each with its own overhang and need. A boundary
    lies inside at most the longest merge, hence the bound over all merges of length - 1 + need.
    """

    def symbols(token: str) -> str:
        # the symbol that ends a word is another one than the same sign inside a word
        cut = token.endswith(suffix) and len(token) > len(suffix) if suffix else False
        token = token[: -len(suffix)] if cut else token
        return token[:-1] + chr(0x10000 + ord(token[-1])) if cut else token

    begins, ends, inside, whole = ({} for _ in range(4))  # by text of the overlap: most symbols beyond the overlap
    most = 0

    def raise_to(table: dict, key: str, value: int) -> None:
        if table.get(key, -1) < value:
            table[key] = value

    for a, b in merges:
        s = symbols(a)[:] + symbols(b)
        n, need = len(s), 0
        for k in range(1, n + 1):
            need = max(need, begins.get(s[n - k :], 0))  # starts within, reaches its end or beyond
            need = max(need, k - n + ends.get(s[:k], 0))  # starts before, ends within
        for i in range(n):
            for j in range(i + 1, n):
                need = max(need, j - n + whole.get(s[i:j], 0))  # lies within
        need = max(need, inside.get(s, 0))  # holds it
        for k in range(1, n + 1):
            raise_to(begins, s[:k], n - k + need)
            raise_to(ends, s[n - k :], need)
        for i in range(n):
            for j in range(i + 1, n + 1):
                raise_to(inside, s[i:j], n - j + need)
        raise_to(whole, s, need)
        most = max(most, n - 1 + need)
    return most


class Encoder:
    """Words (bytes without their text) to ids by windows in lockstep."""

    def __init__(self, vocabulary: Vocabulary, ahead: int, window: int | None = None):
        """``window``: symbols read beyond the lookahead at a time; as many as the lookahead if not given."""
        self.vocabulary, self.ahead, self.width = vocabulary, ahead, ahead + (window or max(ahead, 64))

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Merge every row of ``symbols`` to the end; returns which places still start a token."""
        v, (n, width) = self.vocabulary, symbols.shape
        place = np.arange(width, dtype=np.int32)
        alive = place < lengths[:, None]
        if width < 2:
            return alive
        rank, made = np.full((n, width), _NEVER), np.zeros((n, width), np.int32)
        pair = place[1:] < lengths[:, None]
        r, m = v.find(symbols[:, :-1][pair], symbols[:, 1:][pair])
        rank[:, :-1][pair], made[:, :-1][pair] = r, m
        following = np.tile(place + 1, (n, 1))
        before = np.tile(place - 1, (n, 1))
        rows = np.arange(n)
        while len(rows):
            best = rank[rows].argmin(axis=1)  # the leftmost of the lowest rank
            busy = rank[rows, best] != _NEVER
            rows, at = rows[busy], best[busy]
            if not len(rows):
                break
            gone = following[rows, at]
            symbols[rows, at] = made[rows, at]
            alive[rows, gone], rank[rows, gone] = False, _NEVER
            after = following[rows, gone]
            following[rows, at] = after
            rank[rows, at] = _NEVER
            has = after < lengths[rows]
            r1, a1, x1 = rows[has], at[has], after[has]
            before[r1, x1] = a1
            rank[r1, a1], made[r1, a1] = v.find(symbols[r1, a1], symbols[r1, x1])
            prior = before[rows, at]
            has = prior >= 0
            r2, p2, a2 = rows[has], prior[has], at[has]
            rank[r2, p2], made[r2, p2] = v.find(symbols[r2, p2], symbols[r2, a2])
        return alive

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit numbers."""
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        classes = [8, 12, 16, 24, 48]
        while classes[-1] < self.width:  # words of a block are at most twice as long as the shortest
            classes.append(min(2 * classes[-1], self.width))
        cut = np.searchsorted(sizes[order], classes, side="right")
        for part in np.split(order, np.unique(cut)):
            if len(part):
                rows = max(1, min(8192, CELLS // min(self.width, int(sizes[part[-1]]))))
                for block in np.array_split(part, -(-len(part) // rows)):
                    self._block(words, block, out)
        return out

    def _block(self, words: list[bytes], block: np.ndarray, out: list[bytes]) -> None:
        done = dict.fromkeys(block.tolist(), 0)  # bytes of each word whose tokens are emitted
        emitted = defaultdict(list)
        while done:
            which = list(done)
            reads = [words[i][done[i] : done[i] + self.width] for i in which]
            lengths = np.fromiter(map(len, reads), np.int32, len(reads))
            ended = np.array([done[i] + len(r) == len(words[i]) for i, r in zip(which, reads)])
            width = int(lengths.max())
            place = np.arange(width)
            valid = place < lengths[:, None]
            symbols = np.zeros((len(which), width), np.int32)
            data = np.frombuffer(b"".join(reads), np.uint8)
            symbols[valid] = self.vocabulary.inner[data]
            final = np.cumsum(lengths)[ended] - 1
            symbols[np.flatnonzero(ended), lengths[ended] - 1] = self.vocabulary.last[data[final]]
            alive = self._merge(symbols, lengths)
            # a boundary is stable with the whole lookahead behind it, or at the end of the word
            stable = np.where(ended, lengths, lengths - self.ahead)
            starts = np.where(alive, place, -1)
            last = np.where((starts >= 0) & (starts <= stable[:, None]), starts, 0).max(axis=1)
            upto = np.where(ended, lengths, last)
            keep = alive & (place < upto[:, None])
            counts = keep.sum(axis=1)
            ids = symbols[keep].astype("<u4").tobytes()
            ends = np.cumsum(counts) * 4
            for i, a, b, k, end in zip(which, (ends - counts * 4).tolist(), ends.tolist(), upto.tolist(), ended.tolist()):
                emitted[i].append(ids[a:b])
                if end:
                    out[i] = b"".join(emitted.pop(i))
                    del done[i]
                else:
                    done[i] += k


class Decoder:
    """Ids to text, piece by piece: byte-level names run through an incremental UTF-8 machine, others are joined by a space."""

    def __init__(self, vocabulary: Vocabulary):
        self.names = vocabulary.names
        self.level = vocabulary.decoder == "ByteLevel"
        if vocabulary.decoder not in (None, "ByteLevel"):
            raise ValueError(f"no decoder for {vocabulary.decoder}")
        table = {ord(c): b for b, c in uc.byte_alphabet().items()}
        self.bytes = {}
        if self.level:
            for i, t in self.names.items():
                self.bytes[i] = bytes(table[ord(c)] for c in t) if all(ord(c) in table for c in t) else t.encode()
        self.reset()

    def reset(self) -> None:
        self._machine, self._begun = codecs.getincrementaldecoder("utf-8")("replace"), False

    def feed(self, ids: Iterable[int]) -> str:
        """The text that these ids settle; unknown ids give nothing."""
        if self.level:
            return self._machine.decode(b"".join([self.bytes.get(i, b"") for i in ids]))
        names = [self.names[i] for i in ids if i in self.names]
        lead = " " if self._begun and names else ""
        self._begun = self._begun or bool(names)
        return lead + " ".join(names)

    def finish(self) -> str:
        rest = self._machine.decode(b"", True) if self.level else ""
        self.reset()
        return rest

    def whole(self, ids: list[int]) -> str:
        return self.feed(ids) + self.finish()


class Tokenizer:
    """Texts to ids and back: splitting as the file says, words from the cache or through the transducer."""

    def __init__(self, content: str, ahead: int, cached: int = CACHED):
        self.vocabulary = Vocabulary(content)
        self.encoder, self.decoder = Encoder(self.vocabulary, ahead), Decoder(self.vocabulary)
        self.cached, self.seen = cached, {}
        self.added = self.vocabulary.added
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        spec = json.loads(content)
        self.lower = self.normal_form(spec.get("normalizer"))
        self.words = uc.bare_words if self.lower else uc.spaced_words

    @functools.cached_property
    def library(self):
        """The library's own splitter, loaded only where a text calls for it."""
        from tokenizers import Tokenizer as Library

        return Library.from_str(self.vocabulary.content)

    @staticmethod
    def normal_form(spec) -> bool:
        """True for composed, lower-case words without white space; False for texts as they are."""
        if spec is None:
            return False
        if [s.get("type") for s in spec.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            return True
        raise ValueError("this normalizer is not read")

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text that holds no added token."""
        if not uc.all_known(text):  # code points newer than these tables: the library's own splitter
            if self.library.normalizer:
                text = self.library.normalizer.normalize_str(text)
            back = {ord(c): b for b, c in uc.byte_alphabet().items()}
            return [bytes(back[ord(c)] for c in word).decode() for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        if self.lower:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final form at the end of a word
            text = text.lower()
        return self.words(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        pieces = []
        for text in texts:
            if self.cut is not None and any(t in text for t in self.added):
                parts = []
                for part in self.cut.split(text):
                    if part in self.added:
                        parts.append(self.added[part])
                    elif part:
                        parts.extend(self.split(part))
                pieces.append(parts)
            else:
                pieces.append(self.split(text))
        seen = self.seen
        new = set().union(*pieces).difference(seen) if pieces else set()
        if len(seen) + len(new) > self.cached:
            seen.clear()
            new = set().union(*pieces)
        words = [w for w in new if isinstance(w, str)]
        seen.update(zip(words, self.encoder.encode([w.encode() for w in words])))
        seen.update((w, np.uint32(w).astype("<u4").tobytes()) for w in new if isinstance(w, int))
        return [b"".join(map(seen.__getitem__, p)) for p in pieces]

    def decode(self, ids: bytes) -> str:
        return self.decoder.whole(np.frombuffer(ids, "<u4").tolist())


@functools.lru_cache(maxsize=4)
def _ahead(content: str) -> int:
    spec = json.loads(content)["model"]
    merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in spec["merges"]]
    return lookahead(merges, spec.get("end_of_word_suffix") or "")


def round_trip(docs: DataFrame, tokenizer: str, text: str = "text", cached: int = CACHED) -> DataFrame:
    """Add ``ids`` (binary, little-endian unsigned 32-bit numbers) and ``decoded`` (string) to every document.

    Ids are without added special tokens; a special string inside a text is its special token, as the library has it by
    default. ``decoded`` is the decoding of those ids with special tokens kept. A null or empty text has empty ids and an
    empty decoding. Columns of the same names are replaced, all others are kept, rows are neither merged nor dropped.
    """
    content = Path(tokenizer).read_text()
    ahead = _ahead(content)
    shared = docs.sparkSession.sparkContext.broadcast(content)  # one vocabulary file

    def begin():
        found = Tokenizer(shared.value, ahead, cached)

        def both(column: pa.Array) -> list[pa.Array]:
            ids, decoded = [], []
            for at in range(0, len(column), 250):
                part = found.encode([t or "" for t in column.slice(at, 250).to_pylist()])
                ids += part
                decoded += map(found.decode, part)
            return [pa.array(ids, pa.binary()), pa.array(decoded, pa.string())]

        return both

    plain = docs.withColumn(text, F.col(f"`{text}`").cast("string"))
    return arrow.extended(plain, {"ids": T.BinaryType(), "decoded": T.StringType()}, begin, text)
