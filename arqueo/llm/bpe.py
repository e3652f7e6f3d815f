"""BPE encoding and decoding of whole texts with a public word-end vocabulary.

Method: the symbols of a word form a doubly linked list; a priority queue holds
the merge ranks of adjacent pairs.  The lowest rank (leftmost on ties) is merged
and its new neighbour pairs are queued; entries whose pair has meanwhile changed
are stale and skipped.  Decoding joins the vocabulary's strings.

Spark deals out the texts (``mapInPandas``), one pass, no shuffle; each Python
worker keeps a bounded cache of words it has already merged.

Defined cases: a null text counts as the empty text (no tokens, digests of the
empty string); the specials' strings inside a text are the special tokens, as in
the tokenizers library; words of any length are merged whole (long ones are not
cached); every input row gives one output row, repeated rows included.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cached words per Python worker (two generations of this size) and the longest word that is cached.
CACHE_WORDS, CACHE_LENGTH = 200_000, 64


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file on this machine (each executor asks for its own)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in keep}, 0
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + extra)
            extra += 1
    return [table[b] for b in range(256)]


class WordBpe:
    """Vocabulary, merge ranks and the two-generation word cache of one worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = dict(model["vocab"])
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab.update(self.special)
        self.token = {i: s for s, i in vocab.items()}
        self.byte = [vocab[s] for s in byte_symbols()]
        self.byte_end = [vocab[s + self.end] for s in byte_symbols()]
        self.merge: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merge.setdefault(vocab[a] << 20 | vocab[b], (rank, vocab[a + b]))
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split).findall
        self.space = regex.compile(r"\s+")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split

    def word(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        data = word.encode("utf-8")
        if not data:
            return []
        sym = [self.byte[b] for b in data]
        sym[-1] = self.byte_end[data[-1]]
        n, merge = len(sym), self.merge
        if n == 1:
            return sym
        nxt, prv = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [hit[0] << 40 | i for i in range(n - 1) if (hit := merge.get(sym[i] << 20 | sym[i + 1]))]
        heapq.heapify(queue)
        low = (1 << 40) - 1
        while queue:
            entry = heapq.heappop(queue)
            i = entry & low
            j = nxt[i]
            if sym[i] < 0 or j < 0:
                continue
            hit = merge.get(sym[i] << 20 | sym[j])
            if hit is None or hit[0] != entry >> 40:
                continue  # stale: the pair at i has changed since it was queued
            sym[i], sym[j] = hit[1], -1
            k = nxt[i] = nxt[j]
            if k >= 0:
                prv[k] = i
                if again := merge.get(sym[i] << 20 | sym[k]):
                    heapq.heappush(queue, again[0] << 40 | i)
            h = prv[i]
            if h >= 0 and (again := merge.get(sym[h] << 20 | sym[i])):
                heapq.heappush(queue, again[0] << 40 | h)
        return [s for s in sym if s >= 0]

    def normal(self, text: str) -> str:
        if not text.isascii():
            # lower-casing is per character there: a final sigma is a plain one
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def chunks(self, text: str) -> list[str]:
        """The normalised text between white space; no pre-token goes across it."""
        text = self.normal(text)
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to str.split() only
            return [x for x in self.space.split(text) if x]
        return text.split()

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, part): specials are cut from the raw text, the rest is normalised."""
        if not any(x in text for x in self.special):
            yield False, text
            return
        for i, part in enumerate(self.cut(text)):
            if part:
                yield bool(i % 2), part

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for special, part in self.pieces(text):
            if special:
                out.append(self.special[part])
            else:
                for chunk in self.chunks(part):
                    for w in self.words(chunk):
                        out += self.word(w)
        return out

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings one after another, parted as the library parts them."""
        return " ".join(self.token[i] for i in ids)


class Cache(dict):
    """word -> made(word), for use with ``map(cache.__getitem__, words)``; bounded, newest generation first."""

    def __init__(self, make, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word: str):
        got = self.old.get(word)
        if got is None:
            got = self.make(word)
        if len(word) <= CACHE_LENGTH:
            self.put(word, got)
        return got

    def put(self, word: str, got) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = got


@lru_cache(maxsize=2)
def loaded(path: str) -> WordBpe:
    return WordBpe(path)


class TextIds:
    """Whole texts to (ids as decimal text, decoded text); text between spaces goes through one bounded cache."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.cache = Cache(self._make)

    def _make(self, chunk: str) -> tuple[str, str]:
        words = [chunk] if chunk.isalpha() else self.bpe.words(chunk)  # letters only: one pre-token
        if len(words) > 1:
            a, b = zip(*map(self.cache.__getitem__, words))
            return " ".join(a), " ".join(b)
        ids = self.bpe.word(words[0]) if words else []
        return " ".join(map(str, ids)), self.bpe.decode(ids)

    def __call__(self, text: str) -> tuple[str, str]:
        bpe, ids, out = self.bpe, [], []
        for special, part in bpe.pieces(text):
            if special:
                ids.append(str(bpe.special[part]))
                out.append(part)
            elif chunks := bpe.chunks(part):
                a, b = zip(*map(self.cache.__getitem__, chunks))
                ids += a
                out += b
        return " ".join(ids), " ".join(out)


class Chunks:
    """Chunks of text in columns: the strings, and where each one's ids begin and how many they are."""

    def __init__(self):
        self.words = pa.array([], pa.large_string())
        self.first, self.size, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4")

    def __len__(self) -> int:
        return len(self.words)

    def find(self, words: pa.Array) -> np.ndarray:
        """Places of the words; -1 for those that are not there."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)

    def add(self, words: pa.Array, size: np.ndarray, ids: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
        self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids])

    def cut(self, n: int) -> None:
        """Only the first ``n`` stay."""
        if n < len(self):
            self.words, self.ids = self.words[:n], self.ids[:self.first[n]]
            self.first, self.size = self.first[:n], self.size[:n]


def gathered(ids: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches of ``n`` ids from ``first`` on, one after another."""
    at = np.repeat(first - (np.cumsum(n) - n), n)
    at += np.arange(len(at))
    return ids[at]


class TextBytes:
    """Whole texts to their ids as little-endian unsigned 32-bit numbers, one after another.

    What lies between spaces is split off, numbered, looked up and put together again in columns (Arrow and numpy); Python
    sees only the chunks that are new.  Their words are merged side by side (:class:`Lockstep`); the chunks are kept in a
    bounded cache of two generations.
    """

    #: White space beside the six ASCII blanks to Python or the tokenizer; signs that are a pre-token of their own after letters.
    OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
    SIGNS = frozenset(".,;:!?")

    def __init__(self, bpe: WordBpe, limit: int = 4 * CACHE_WORDS):
        self.bpe, self.limit = bpe, limit
        self.merged = Lockstep(bpe)
        self.cache, self.old = Chunks(), Chunks()

    def made(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks that are not known, one after another, and how many each has."""
        words = chunks.to_pylist()
        whole = np.fromiter((c.isalpha() for c in words), bool, len(words))  # letters only: one pre-token
        signed = np.fromiter((c[-1:] in self.SIGNS and c[:-1].isalpha() for c in words), bool, len(words))  # two
        one = np.flatnonzero(whole | signed)
        letters = pc.utf8_rtrim(chunks.take(pa.array(one)), characters="".join(self.SIGNS)).dictionary_encode()
        place, base = letters.indices.to_numpy(), letters.dictionary
        at = self.cache.find(base)
        known = at >= 0
        size, first = np.empty(len(base), np.int64), np.empty(len(base), np.int64)
        size[known], first[known] = self.cache.size[at[known]], self.cache.first[at[known]]
        ids, size[~known] = self.merged.columns(base.filter(pa.array(~known)))
        first[~known] = len(self.cache.ids) + np.cumsum(size[~known]) - size[~known]
        # the other chunks, each of any number of pre-tokens
        rest = np.flatnonzero(~(whole | signed))
        parts = [self.bpe.words(words[i]) for i in rest.tolist()]
        got = self.merged({w for p in parts for w in p})
        data = [b"".join([got[w] for w in p]) for p in parts]
        # each chunk's stretch, and then the stretch of its sign, which is empty for most
        sign = self.bpe.byte_end
        ends = np.array([sign[ord(words[i][-1])] if s else 0 for i, s in zip(one.tolist(), signed[one].tolist())], dtype="<u4")
        parts_of = [self.cache.ids, ids, np.frombuffer(b"".join(data), "<u4"), ends]
        start = np.cumsum([0, *map(len, parts_of)])
        stretch, n = np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), np.int64)
        stretch[one, 0], n[one, 0] = first[place], size[place]
        n[rest, 0] = np.fromiter(map(len, data), np.int64, len(data)) // 4
        stretch[rest, 0] = start[2] + np.cumsum(n[rest, 0]) - n[rest, 0]
        stretch[one, 1], n[one, 1] = start[3] + np.arange(len(one)), signed[one]
        return gathered(np.concatenate(parts_of), stretch.ravel(), n.ravel()), n.sum(axis=1)

    def learn(self, chunks: pa.Array) -> int:
        """Put every one of the chunks (none twice) into the cache; how many of its first may stay, those too long being last."""
        fresh = chunks.filter(pa.array(self.cache.find(chunks) < 0))
        at = self.old.find(fresh)
        back = at[at >= 0]
        size = self.old.size[back]
        self.cache.add(fresh.filter(pa.array(at >= 0)), size, gathered(self.old.ids, self.old.first[back], size))
        words = fresh.filter(pa.array(at < 0))
        long = pc.utf8_length(words).to_numpy() > CACHE_LENGTH
        words = words.take(pa.array(np.argsort(long, kind="stable")))
        ids, size = self.made(words)
        self.cache.add(words, size, ids)
        return len(self.cache) - int(long.sum())

    def batch(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > self.limit:
            self.old, self.cache = self.cache, Chunks()
        bpe, special = self.bpe, tuple(self.bpe.special)
        plain = [not self.OTHER_SPACE(t) and not any(x in t for x in special) for t in texts]
        done = iter(self.columns([bpe.normal(t) for t, p in zip(texts, plain) if p]))
        return [next(done) if p else self.one(t) for t, p in zip(texts, plain)]

    def columns(self, texts: list[str]) -> list[bytes]:
        """The ids of normalised texts without specials, whose white space is ASCII blanks."""
        chunks = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = chunks.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        stay = self.learn(coded.dictionary)
        at = self.cache.find(coded.dictionary)[code]
        n = self.cache.size[at]
        ids = gathered(self.cache.ids, self.cache.first[at], n).tobytes()
        self.cache.cut(stay)
        cuts = (4 * np.concatenate([[0], np.cumsum(n)]))[chunks.offsets.to_numpy()].tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def one(self, text: str) -> bytes:
        """The ids of any text: its chunks, as the tokenizer parts them, go through the columns again."""
        return b"".join(struct.pack("<I", self.bpe.special[part]) if special else self.columns([" ".join(self.bpe.chunks(part))])[0]
                        for special, part in self.bpe.pieces(text))


class Lockstep:
    """The same merges for many words at once: in each round every word makes its lowest-ranked, leftmost merge.

    Words are rows of a padded matrix of symbols; finished words leave it.  Longer words go one by one.
    """

    WIDTH, ROWS = 24, 4_000

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        key = np.array(list(bpe.merge), dtype=np.int64)
        order = np.argsort(key)
        self.key = key[order]
        self.rank = np.array([r for r, _ in bpe.merge.values()], dtype=np.int32)[order]
        self.into = np.array([i for _, i in bpe.merge.values()], dtype=np.int32)[order]
        self.byte, self.byte_end = (np.array(x, dtype=np.int32) for x in (bpe.byte, bpe.byte_end))
        self.none = np.int32(2**31 - 1)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the merge table) of pairs; rank ``none`` where there is no merge."""
        want = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((self.key[at] == want) & (a >= 0) & (b >= 0), self.rank[at], self.none), at

    def __call__(self, words: set[str]) -> dict[str, bytes]:
        out, some = {}, {}
        for w in words:
            d = w.encode("utf-8")
            if len(d) > self.WIDTH:
                ids = self.bpe.word(w)
                out[w] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                some[w] = d
        order = sorted(some, key=lambda w: len(some[w]))
        for lo in range(0, len(order), self.ROWS):
            part = order[lo:lo + self.ROWS]
            out.update(zip(part, self.rows([some[w] for w in part])))
        return out

    def columns(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one after another, and how many each has."""
        if not len(words):
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        words = pa.concat_arrays([words])  # its buffers may begin before it
        _, offsets, data = words.buffers()
        begin = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
        data, length = np.frombuffer(data, np.uint8), np.diff(begin)
        n, parts, order = np.empty(len(words), np.int64), [], np.argsort(length, kind="stable")
        short = np.searchsorted(length[order], self.WIDTH, side="right")
        for lo in range(0, short, self.ROWS):
            own = order[lo:min(lo + self.ROWS, short)]
            size = length[own]
            place = np.minimum(begin[own][:, None] + np.arange(size[-1]), len(data) - 1)
            flat, n[own] = self.merge(data[place], size)
            parts.append(flat)
        for i in order[short:].tolist():
            parts.append(np.array(self.bpe.word(words[i].as_py()), "<u4"))
            n[i] = len(parts[-1])
        first = np.empty(len(words), np.int64)
        first[order] = np.cumsum(n[order]) - n[order]
        return gathered(np.concatenate(parts), first, n), n

    def rows(self, data: list[bytes]) -> list[bytes]:
        width = max(map(len, data))
        flat, size = self.merge(np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), dtype=np.uint8).reshape(len(data), width),
                                np.array([len(d) for d in data]))
        data, at = flat.tobytes(), np.concatenate([[0], np.cumsum(size) * 4])
        return [data[a:b] for a, b in zip(at[:-1], at[1:])]

    def merge(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words (rows of ``raw``, of ``size`` bytes), one after another, and how many each has."""
        n, width = raw.shape
        sym = np.where(np.arange(width) < size[:, None], self.byte[raw], -1).astype(np.int32)
        sym[np.arange(n), size - 1] = self.byte_end[raw[np.arange(n), size - 1]]
        out = np.full((n, width), -1, dtype=np.int32)
        live = np.arange(n)
        rank = self.look(sym[:, :-1], sym[:, 1:])[0] if width > 1 else np.empty((n, 0), dtype=np.int32)
        while len(live):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(live), dtype=np.int64)
            row = np.arange(len(live))
            go = rank[row, at] < self.none if rank.shape[1] else np.zeros(len(live), dtype=bool)
            out[live[~go], :sym.shape[1]] = sym[~go]
            live, sym, rank, at = live[go], sym[go], rank[go], at[go]
            if not len(live):
                break
            row = np.arange(len(live))
            merged = self.into[self.look(sym[row, at], sym[row, at + 1])[1]]
            # everything right of the pair moves one place to the left
            gather = np.arange(sym.shape[1] - 1)
            sym = np.where(gather <= at[:, None], sym[:, :-1], sym[:, 1:])
            sym[row, at] = merged
            if rank.shape[1] < 2:
                rank = np.empty((len(live), 0), dtype=np.int32)
                continue
            rank = np.where(gather[:-1] < at[:, None], rank[:, :-1], rank[:, 1:])
            left, right = np.maximum(at - 1, 0), np.minimum(at, rank.shape[1] - 1)
            rank[row, left] = np.where(at > 0, self.look(sym[row, left], sym[row, left + 1])[0], rank[row, left])
            here = self.look(sym[row, right], sym[row, right + 1])[0]
            rank[row, right] = np.where(at < rank.shape[1], here, rank[row, right])
        return out[out >= 0].astype("<u4"), (out >= 0).sum(axis=1)


@lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    return TextIds(loaded(path))


@lru_cache(maxsize=2)
def text_bytes(path: str) -> TextBytes:
    return TextBytes(loaded(path))


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  vocabulary: str = "word_bpe_49k.json", digests: bool = False) -> DataFrame:
    """One row per document: its ids and its decoded text, or (``digests``) their SHA-256 in hex.

    Columns: the id, n_tokens, then ids array<int> and decoded string, or ids_sha256 and decoded_sha256.
    Other columns of ``docs`` are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        convert = text_ids(tokenizer_path(vocabulary))
        for pdf in batches:
            n, a, b = [], [], []
            for text in pdf["text"]:
                ids, out = convert(text if isinstance(text, str) else "")
                n.append(ids.count(" ") + 1 if ids else 0)
                if digests:
                    a.append(hashlib.sha256(ids.encode()).hexdigest())
                    b.append(hashlib.sha256(out.encode()).hexdigest())
                else:
                    a.append([int(i) for i in ids.split()])
                    b.append(out)
            yield pd.DataFrame({"id": pdf["id"], "n_tokens": n, "a": a, "b": b})

    kinds = ("string", "string") if digests else ("array<int>", "string")
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    # ids go through pandas as text: a column of integers with a null would be one of floats
    out = (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
           .mapInPandas(run, f"id string, n_tokens bigint, a {kinds[0]}, b {kinds[1]}"))
    return out.select(F.col("id").cast(kind).alias(id_col), "n_tokens", F.col("a").alias(names[0]), F.col("b").alias(names[1]))
