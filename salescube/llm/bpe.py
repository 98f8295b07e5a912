"""Byte-level BPE encoding and decoding.

A word's parts lie in one contiguous array of boundaries with the rank of each
adjacent pair beside it. The encoder scans the ranks for the minimum, deletes
that boundary, and refreshes the ranks of the two neighbouring pairs, until no
pair has a rank. The words that a batch meets for the first time are done
together: a step deletes one boundary of every word, so words of equally many
parts form a matrix with a word in each row, and the sweep goes from the
longest words down. Words of more than ``SHORT`` bytes hold their ranks in a
heap over a linked list instead, so that a text without spaces costs n log n
rather than n squared.

Documents are independent: encoding and decoding are passes over Arrow batches
without a shuffle. The vocabulary is read on the driver and broadcast; its size
is fixed by the file, about 50,000 tokens.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructType

from salescube.llm.common import releasing, small

# The tokenizer file's path is a parameter; without one, this file of the installed public ones is taken.
VOCABULARY = "byte_bpe_50k.json"
MAX_VOCABULARY_BYTES = 64_000_000

# Fixed value: white space as the Unicode property and not Python's, which also has 1C to 1F.
WHITE_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

SHORT = 96
CACHED_WORDS = 150_000
STEP_CHARS = 500_000
ID_SPAN = 1 << 24
NO_RANK = 1 << 60


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file.

    Visible Latin-1 characters stand for themselves; the other bytes take the
    code points from 256 on, in order.
    """
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one vocabulary file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        symbols = byte_symbols()

        def raw(token: str) -> bytes:
            return bytes(symbols[c] for c in token)

        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw(token): i for token, i in vocab.items() if token not in self.added}
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in spec["model"]["merges"]]
        # Rank and merged bytes of each pair of parts.
        self.ranks = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        keys = np.array([self.ids[a] * ID_SPAN + self.ids[b] for a, b in self.ranks], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.ranks.values()), np.int64)[order]
        self.merged_ids = np.array([self.ids[a + b] for a, b in self.ranks], dtype=np.int64)
        tokens = {i: token for token, i in self.ids.items()}
        tokens |= {i: content.encode() for content, i in self.added.items()}
        raw_tokens = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.token_sizes = np.array([len(t) for t in raw_tokens], np.int64)
        self.token_at = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(raw_tokens), np.uint8)
        self.specials = (regex.compile("|".join(sorted(map(regex.escape, self.added), key=len, reverse=True)))
                         if self.added else None)
        self.cache: dict[str, bytes] = {}

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * ID_SPAN + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK)

    def _merge_short(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of 1 to SHORT bytes, all at once."""
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(-sizes, kind="stable")
        width = int(sizes.max(initial=0))
        parts, ranks = np.empty((0, width), np.int64), np.empty((0, max(width - 1, 0)), np.int64)
        rows, at = np.empty(0, np.int64), 0
        while width:
            until = at + int(np.count_nonzero(sizes[order[at:]] == width))
            if until > at:  # words that begin with as many parts as the others have left
                fresh = order[at:until]
                data = np.frombuffer(b"".join([words[i] for i in fresh]), np.uint8).reshape(-1, width)
                begun = self.byte_ids[data]
                parts = np.concatenate([parts, begun])
                ranks = np.concatenate([ranks, self._rank_of(begun[:, :-1], begun[:, 1:])])
                rows, at = np.concatenate([rows, fresh]), until
            if width == 1 or not len(rows):
                self._put(out, rows, parts)
                parts, ranks, rows = parts[:0, 1:], ranks[:0, 1:], rows[:0]
            else:
                best = ranks.argmin(axis=1)
                least = ranks[np.arange(len(rows)), best]
                done = least == NO_RANK
                self._put(out, rows[done], parts[done])
                live = ~done
                parts, ranks, rows, best, least = parts[live], ranks[live], rows[live], best[live], least[live]
                n = np.arange(len(rows))
                parts[n, best] = self.merged_ids[least]
                keep = np.arange(width - 1)[None, :]
                parts = np.take_along_axis(parts, keep + (keep > best[:, None]), axis=1)
                if width > 2:
                    keep = np.arange(width - 2)[None, :]
                    ranks = np.take_along_axis(ranks, keep + (keep >= best[:, None]), axis=1)
                    for side, has in ((best - 1, best > 0), (best, best < width - 2)):
                        r, c = n[has], side[has]
                        ranks[r, c] = self._rank_of(parts[r, c], parts[r, c + 1])
                else:
                    ranks = ranks[:, :0]
            width -= 1
        return out

    @staticmethod
    def _put(out: list[bytes], rows: np.ndarray, parts: np.ndarray) -> None:
        step = 4 * parts.shape[1]
        data = parts.astype("<u4").tobytes()
        for k, i in enumerate(rows.tolist()):
            out[i] = data[k * step:(k + 1) * step]

    def _merge_long(self, parts: list[bytes]) -> list[bytes]:
        """The same merges from a heap; a popped pair that has changed since is passed over."""
        rank = self.ranks.get
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] is not left or j >= n or parts[j] is not right:
                continue
            parts[i], parts[j] = left + right, b""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))
        return [p for p in parts if p]

    def _learn(self, words: list[str]) -> None:
        """Put the packed ids of new words into the cache."""
        data = [w.encode() for w in words]
        short = [i for i, d in enumerate(data) if len(d) <= SHORT]
        self.cache.update(zip([words[i] for i in short], self._merge_short([data[i] for i in short])))
        for w, d in zip(words, data):
            if len(d) > SHORT:
                merged = self._merge_long([d[i:i + 1] for i in range(len(d))])
                self.cache[w] = b"".join([self.ids[p].to_bytes(4, "little") for p in merged])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The strings of added tokens in a text become those tokens."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            # Few texts at a time, by their length, bound what is held in memory.
            until, chars = at, 0
            while until < len(texts) and (until == at or chars + len(texts[until]) <= STEP_CHARS):
                chars += len(texts[until])
                until += 1
            split = [self._split(t) for t in texts[at:until]]
            plain = iter(self._encode_plain([p for pieces in split for p, _ in pieces]))
            for pieces in split:
                ids = [x for _, end in pieces for x in (next(plain), end)]
                out.append(ids[0] if len(pieces) == 1 else np.concatenate(ids))
            at = until
        return out

    def _split(self, text: str) -> list[tuple[str, np.ndarray]]:
        """The pieces between added tokens, each with the id that ends it."""
        pieces, at = [], 0
        for m in (self.specials.finditer(text) if self.specials else ()):
            pieces.append((text[at:m.start()], np.array([self.added[m.group()]], np.int32)))
            at = m.end()
        pieces.append((text[at:], np.empty(0, np.int32)))
        return pieces

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without added tokens; each distinct word of the batch is looked up once."""
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) for t in texts])
        starts = word_starts(points, ends[:-1])
        words, which = distinct_words(joined, points, starts)
        packed = [self.cache.get(w) for w in words]
        new = [k for k, ids in enumerate(packed) if ids is None]
        if new:
            self._learn([words[k] for k in new])
            for k in new:
                packed[k] = self.cache[words[k]]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        ids = gather(np.frombuffer(b"".join(packed), "<i4"), np.cumsum(sizes) - sizes, sizes, which)
        upto = np.concatenate([[0], np.cumsum(sizes[which])])
        cuts = upto[np.searchsorted(starts, ends)]
        return [ids[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of consecutive lists of ids that end at ``ends``, added tokens included.

        Broken UTF-8 gives replacement characters.
        """
        sizes = self.token_sizes[ids]
        data = gather(self.token_bytes, self.token_at, self.token_sizes, ids).tobytes()
        upto = np.concatenate([[0], np.cumsum(sizes)])[ends].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *upto[:-1]], upto)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_batch(np.array(ids, np.int64), np.array([len(ids)]))[0]


def gather(values: np.ndarray, at: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenate values[at[k]:at[k] + sizes[k]] over the k of ``which``."""
    n = sizes[which]
    ends = np.cumsum(n)
    return values[np.repeat(at[which] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]


SPACE, LETTER, NUMBER, OTHER = range(4)


@functools.cache
def char_classes() -> np.ndarray:
    """The class of every code point, from the Unicode properties."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    table = np.full(len(every), OTHER, np.uint8)
    for kind, pattern in ((SPACE, WHITE_SPACE), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        for m in regex.finditer(pattern + "+", every):
            table[m.start():m.end()] = kind
    return table


def word_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where words begin in texts that lie one after the other as code points.

    Words are runs of letters, of numbers, of other characters or of white
    space. The last blank of white space inside a text goes to the word after it
    if it is a plain blank, else it stands alone. An apostrophe that begins a
    word takes s, t, m, d, re, ve or ll after it, and a new word follows.
    """
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    kind = char_classes()[points]
    text = np.zeros(n + 1, bool)  # a text begins here, or all have ended
    text[0] = text[n] = True
    text[text_starts] = True
    start = text[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    joins = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~text[1:n])
    start[joins] = True
    start[joins[points[joins] == ord(" ")] + 1] = False
    quote = np.flatnonzero((points[:-1] == ord("'")) & start[:-1] & ~text[1:n])
    if len(quote):
        one = points[quote + 1]
        two = np.where(text[quote + 2], 0, points[np.minimum(quote + 2, n - 1)])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        start[quote[short | long] + 1] = False
        for size, hit in ((2, quote[short]), (3, quote[long])):
            after = hit + size
            start[after[after < n]] = True
    return np.flatnonzero(start)


HASH_BASE = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    inverse = np.uint64(pow(int(HASH_BASE), -1, 1 << 64))
    up, down = np.full(n, HASH_BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def span_hashes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points from its start to the next start."""
    if not len(starts):
        return np.empty(0, np.uint64)
    size = 1 << max(20, int(len(points)).bit_length())
    up, down = _powers(size)
    # Mixed code points, so that similar words don't differ by a small multiple of a power.
    mixed = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    sums = np.add.reduceat(mixed * up[:len(points)], starts) * down[starts]
    sums ^= sums >> np.uint64(31)
    return sums * np.uint64(0x94D049BB133111EB)


def distinct_words(joined: str, points: np.ndarray, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The distinct words of a batch, and for every word which of them it is.

    Words are grouped by hash and then compared with the first of their group,
    code point by code point; those that differ from it are told apart as strings.
    """
    if not len(starts):
        return [], np.empty(0, np.int64)
    _, first, which = np.unique(span_hashes(points, starts), return_index=True, return_inverse=True)
    stops = np.append(starts, len(points))
    sizes, leader = np.diff(stops), first[which]
    words = [joined[a:b] for a, b in zip(stops[first].tolist(), stops[first + 1].tolist())]
    same = sizes == sizes[leader]
    if same.all():
        differs = gather(points, starts, sizes, leader) != points
        if differs.any():
            same[np.searchsorted(starts, np.flatnonzero(differs), side="right") - 1] = False
    else:  # lengths differ within a hash, which no ordinary text does
        same[[k for k in np.flatnonzero(same).tolist()
              if joined[stops[k]:stops[k + 1]] != words[which[k]]]] = False
    others: dict[str, int] = {}
    for k in np.flatnonzero(~same).tolist():
        w = joined[stops[k]:stops[k + 1]]
        if w not in others:
            others[w] = len(words)
            words.append(w)
        which[k] = others[w]
    return words, which


_CODECS: dict[str, Codec] = {}


def codec_of(content: str) -> Codec:
    """One codec for each worker process and vocabulary."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(content)
    return _CODECS[key]


def forget_codecs() -> None:
    _CODECS.clear()
    _powers.cache_clear()


def read_vocabulary(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is too large to broadcast")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """All columns of ``docs`` but the text, plus ``ids`` array<int> of the whole text.

    Null and empty texts have no ids. A column named as the new one is replaced.
    Repeated rows are encoded each; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    kept = [c for c in docs.columns if c not in (text_col, out_col)]

    @releasing(forget_codecs)
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for frame in small(frames, text_col):
            yield encoded_batch(codec, frame, kept, text_col, out_col)

    schema = docs.select(*kept).schema.add(out_col, ArrayType(IntegerType()))
    return docs.select(*kept, text_col).mapInArrow(batches, schema)


def encoded_batch(codec: Codec, frame: pa.RecordBatch, kept: list[str], text_col: str, out_col: str) -> pa.RecordBatch:
    lists = codec.encode_batch([t or "" for t in frame.column(text_col).to_pylist()])
    ends = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=ends[1:])
    values = np.concatenate([np.empty(0, np.int32), *lists]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
    return pa.RecordBatch.from_arrays([frame.column(c) for c in kept] + [ids], kept + [out_col])


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """All columns but the ids, plus ``text``; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    kept = [c for c in encoded.columns if c not in (ids_col, out_col)]

    @releasing(forget_codecs)
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for frame in few_lists(frames, ids_col):
            texts = decode_lists(codec, frame.column(ids_col))
            yield pa.RecordBatch.from_arrays(
                [frame.column(c) for c in kept] + [pa.array(texts, pa.string())], kept + [out_col])

    schema = encoded.select(*kept).schema.add(out_col, "string")
    return encoded.select(*kept, ids_col).mapInArrow(batches, schema)


def packed_lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all lists of a column, and where each list ends."""
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    return column.flatten().to_numpy(zero_copy_only=False), ends


def few_lists(frames: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut to some hundred thousand ids each."""
    for frame in frames:
        upto = np.cumsum(frame.column(column).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(frame):
            until = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + STEP_CHARS, side="right")))
            yield frame.slice(at, until - at)
            at = until


def decode_lists(codec: Codec, column: pa.ListArray) -> list[str | None]:
    texts = codec.decode_batch(*packed_lists(column)) if len(column) else []
    return [t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist())]


DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256"]


def digested_batch(codec: Codec, frame: pa.RecordBatch, kept: list[str], ids_col: str) -> pa.RecordBatch:
    column = frame.column(ids_col)
    ids, ends = packed_lists(column)
    begins = [0, *ends[:-1].tolist()]
    data = ids.astype("<u4").tobytes()
    ids_sha = [hashlib.sha256(data[4 * a:4 * b]).hexdigest() for a, b in zip(begins, ends.tolist())]
    text_sha = [hashlib.sha256((t or "").encode()).hexdigest() for t in decode_lists(codec, column)]
    return pa.RecordBatch.from_arrays(
        [frame.column(c) for c in kept]
        + [pa.array(np.diff(ends, prepend=0)), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
        kept + DIGESTS)


def digest(encoded: DataFrame, path: str | None = None, ids_col: str = "ids", keep_ids: bool = False) -> DataFrame:
    """The encoded rows with ``n_tokens``, ``ids_sha256`` (of little-endian unsigned 32-bit
    integers) and ``decoded_sha256`` (of the decoded text in UTF-8), read from the ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    kept = [c for c in encoded.columns if c not in DIGESTS and (keep_ids or c != ids_col)]

    @releasing(forget_codecs)
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for frame in few_lists(frames, ids_col):
            yield digested_batch(codec, frame, kept, ids_col)

    return encoded.mapInArrow(batches, with_digests(encoded.select(*kept).schema))


def with_digests(schema: StructType) -> StructType:
    return schema.add(DIGESTS[0], "long").add(DIGESTS[1], "string").add(DIGESTS[2], "string")


def encode_and_digest(docs: DataFrame, path: str | None = None, text_col: str = "text", ids_col: str = "ids",
                      keep_ids: bool = False) -> DataFrame:
    """``digest(encode(docs))`` in one pass: a task holds one worker with one vocabulary, not two."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    plain = [c for c in docs.columns if c not in (text_col, ids_col)]
    kept = [c for c in [*plain, *([ids_col] if keep_ids else [])] if c not in DIGESTS]

    @releasing(forget_codecs)
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for frame in small(frames, text_col):
            encoded = encoded_batch(codec, frame, plain, text_col, ids_col)
            for part in few_lists(iter([encoded]), ids_col):
                yield digested_batch(codec, part, kept, ids_col)

    schema = docs.select(*[c for c in kept if c != ids_col]).schema
    if keep_ids:
        schema = schema.add(ids_col, ArrayType(IntegerType()))
    return docs.select(*plain, text_col).mapInArrow(batches, with_digests(schema))


def token_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of whole texts."""
    return encode_and_digest(docs.select("doc_id", "text"), path)
