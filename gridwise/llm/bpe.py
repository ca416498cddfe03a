"""Byte-pair encoding and decoding as streaming transducers.

Encoding reads a text in blocks and emits token ids as soon as they are stable:

* between two white-space characters nothing depends on what lies outside, so
  a block is cut at its last white space;
* inside one word, the merge list bounds how far to the right a merge decision
  can look (``sufficient_lookahead``).  A word longer than that is merged in
  windows; tokens that end further than the lookahead before the window's end
  can't change any more and are emitted, and the next window starts at the
  last emitted token's end.

So the state is one window of text whatever the length of the text or of a
word.  Decoding maps ids back piece by piece; with a byte-level decoder an
incremental UTF-8 state machine holds back at most three bytes.

The vocabulary file's path is a parameter; the file is read on the executors.
The operator follows the file: NFC, white space and case normalisation, added
special tokens, word pattern, end-of-word suffix, and the decoder (none: token
strings with single spaces between).

Defined results: null and empty texts give no ids and the empty text.  Repeated
rows give repeated results.  Extra columns pass through; columns named like an
output are replaced.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.llm.common import table

BLOCK_CHARS = 1 << 16
WINDOW_SYMBOLS = 4096
CACHED_CHUNKS = 1 << 18
CACHED_CHUNK_CHARS = 64
ARRAY_WORD_BYTES = 32
NO_MERGE = 1 << 62
LETTERS_FIRST = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|"
OUTPUTS = ("n_tokens", "ids_sha256", "decoded_sha256")


def chunks_of(text: str) -> list[str]:
    """The text between ASCII white space (with empty strings for runs of it)."""
    for c in "\n\t\r\x0b\x0c":
        if c in text:
            text = text.replace(c, " ")
    return text.split(" ")


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte:
    visible Latin-1 characters stand for themselves, the others take the
    characters from U+0100 on, in byte order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0
    for b in range(256):
        if b in visible:
            out[b] = chr(b)
        else:
            out[b] = chr(0x100 + spare)
            spare += 1
    return out


def sufficient_lookahead(merges: list[tuple[int, int, int]], lengths: list[int]) -> int:
    """How many symbols beyond a token's end can decide whether the token is there.

    ``merges`` are (left, right, result) in priority order, ``lengths`` the
    symbols of each token.  ``reach[t]`` is how far beyond the end of an
    occurrence of t one must look to know whether it is there, not yet merged
    into another token, after the merges read so far.  A merge (a, b) happens
    where a and b both stand, which is known ``need`` symbols beyond b's end;
    whether a is used up is then known that far beyond b, and so on down the
    priority order.  Merges of one priority are made from left to right, so a
    run of equal merges passes nothing to the left.
    """
    reach = [0] * len(lengths)
    for a, b, c in merges:
        need = max(0, reach[b], reach[a] - lengths[b])
        reach[a] = max(reach[a], lengths[b] + need)
        reach[b] = max(reach[b], need)
        reach[c] = max(reach[c], need)
    return max(reach, default=0)


class Vocabulary:
    """A byte-pair vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = [""] * (1 + max([*self.ids.values(), *added.values()], default=-1))
        for token, i in [*self.ids.items(), *added.items()]:
            self.tokens[i] = token
        self.special = added
        self.special_pattern = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.longest_special = max(map(len, added), default=0)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                 for m in model["merges"]]
        self.merges = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]
        self.ranks = {(a << 32) | b: (rank, c) for rank, (a, b, c) in enumerate(self.merges)}
        self.packed = {pair: (rank << 32) | c for pair, (rank, c) in self.ranks.items()}
        self.pair_keys = np.array(sorted(self.packed), dtype=np.int64)
        self.pair_values = np.array([self.packed[k] for k in self.pair_keys.tolist()] + [NO_MERGE],
                                    dtype=np.int64)
        self.symbols = byte_symbols()
        self.inner = [self.ids[s] for s in self.symbols]
        self.last = [self.ids[s + self.suffix] for s in self.symbols]
        self.inner_ids, self.last_ids = np.array(self.inner, np.int32), np.array(self.last, np.int32)
        if len(self.pair_keys):  # of each two bytes, the second within a word or its last
            bytes_each = np.repeat(self.inner_ids, 256).reshape(256, 256)
            self.inner_pairs = self._pairs(bytes_each, bytes_each.T)
            self.last_pairs = self._pairs(bytes_each, np.broadcast_to(self.last_ids, (256, 256)))
        lengths = [len(t.removesuffix(self.suffix)) if self.suffix else len(t)
                   for t in self.tokens]
        self.lengths = lengths
        self.lookahead = sufficient_lookahead(self.merges, lengths)
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.word_pattern = regex.compile(splits[0]["pattern"]["Regex"])
        # this pattern's forms before the letters begin with an apostrophe
        self.letters_are_words = splits[0]["pattern"]["Regex"].startswith(LETTERS_FIRST)
        self.byte_decoder = (spec.get("decoder") or {}).get("type") == "ByteLevel"

    def normalized(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # case mapping goes character by character (str.lower() looks at the
        # neighbours of a capital sigma)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def merged(self, ids: list[int]) -> list[int]:
        """All merges applied to a list of symbols, in priority order, the
        leftmost first among equals."""
        return self._merged_short(ids) if len(ids) <= 24 else self._merged_long(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        # found[i] is the pair at i: its rank in the high bits, its result in the
        # low ones; a merge changes the two pairs beside it
        get, none = self.packed.get, NO_MERGE
        found = [get((a << 32) | b, none) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            ids[i:i + 2] = [best & 0xFFFFFFFF]
            del found[i]
            if i:
                found[i - 1] = get((ids[i - 1] << 32) | ids[i], none)
            if i < len(found):
                found[i] = get((ids[i] << 32) | ids[i + 1], none)
        return ids

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and result of each pair, packed as above."""
        keys = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.pair_keys, keys)
        np.minimum(at, len(self.pair_keys) - 1, out=at)
        return np.where(self.pair_keys[at] == keys, self.pair_values[at], NO_MERGE)

    def merged_words(self, words: list[bytes]) -> list[bytes]:
        """The ids, packed, of many short words at once: one merge of each word
        per round, over arrays."""
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 18), (18, ARRAY_WORD_BYTES)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            if not len(rows) or not len(self.pair_keys):
                continue
            n, width = len(rows), high
            flat = np.frombuffer(b"".join(words[r].ljust(width, b"\0") for r in rows.tolist()),
                                 np.uint8).reshape(n, width)
            size = sizes[rows]
            column = np.arange(width)
            ids = self.inner_ids[flat]
            ends = np.arange(n), size - 1
            ids[ends] = self.last_ids[flat[ends]]
            ids[column[None, :] >= size[:, None]] = -1
            pairs = self.inner_pairs[flat[:, :-1], flat[:, 1:]]
            two = np.flatnonzero(size > 1)
            final = two, size[two] - 2
            pairs[final] = self.last_pairs[flat[final], flat[two, size[two] - 1]]
            pairs[column[None, :-1] >= (size - 1)[:, None]] = NO_MERGE
            done_ids = np.full((n, width), -1, np.int32)
            live = np.arange(n)
            while width > 1:
                r = np.arange(len(live))
                at = pairs.argmin(axis=1)
                best = pairs[r, at]
                more = best != NO_MERGE
                if not more.all():
                    done_ids[live[~more], :width] = ids[~more]
                    live, ids, pairs, at, best = (x[more] for x in (live, ids, pairs, at, best))
                    if not len(live):
                        break
                    r = np.arange(len(live))
                # each row loses the symbol after the place, and the pair at it
                ids[r, at] = best & 0xFFFFFFFF
                ids = ids[column[None, :width] != (at + 1)[:, None]].reshape(len(live), width - 1)
                pairs = pairs[column[None, :width - 1] != at[:, None]].reshape(len(live), width - 2)
                width -= 1
                right = np.flatnonzero(at < width - 1)
                right = right[ids[right, at[right] + 1] >= 0]
                pairs[r[at < width - 1], at[at < width - 1]] = NO_MERGE
                left = np.flatnonzero(at > 0)
                here = np.concatenate([right, left]), np.concatenate([at[right], at[left] - 1])
                pairs[here] = self._pairs(ids[here], ids[here[0], here[1] + 1])
            done_ids[live, :width] = ids
            kept = done_ids >= 0
            packed = done_ids[kept].astype("<u4").tobytes()
            ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
            for row, start, end in zip(rows.tolist(), [0, *ends], ends):
                out[row] = packed[start:end]
        return out

    def _merged_long(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = get((ids[i] << 32) | ids[i + 1])
            if found is not None:
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, c = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = c, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = get((c << 32) | ids[k])
                if found is not None:
                    heapq.heappush(heap, (found[0], i, c, ids[k], found[1]))
            if (h := before[i]) >= 0:
                found = get((ids[h] << 32) | c)
                if found is not None:
                    heapq.heappush(heap, (found[0], h, ids[h], c, found[1]))
        return [x for x in ids if x >= 0]


class WordStream:
    """Ids of one word that arrives in parts."""

    def __init__(self, vocab: Vocabulary, window: int = WINDOW_SYMBOLS):
        self.vocab, self.window = vocab, window
        self.held = b""

    def feed(self, data: bytes) -> list[int]:
        """The ids that have become stable."""
        v, out = self.vocab, []
        # one byte more than the lookahead stays: the last symbol is another one
        limit = self.window + v.lookahead + 1
        self.held += data
        start = 0
        while len(self.held) - start > limit:
            part = self.held[start:start + limit]
            end = 0
            for token in v.merged([v.inner[b] for b in part]):
                if end + v.lengths[token] > self.window:
                    break
                end += v.lengths[token]
                out.append(token)
            start += end
        self.held = self.held[start:]
        return out

    def finish(self) -> list[int]:
        data, self.held = self.held, b""
        if not data:
            return []
        v = self.vocab
        return v.merged([*(v.inner[b] for b in data[:-1]), v.last[data[-1]]])


class Encoder:
    """Streaming encoder: ``feed`` blocks of one text, then ``finish``; both
    return ids as little-endian unsigned 32-bit integers."""

    def __init__(self, vocab: Vocabulary, block: int = BLOCK_CHARS,
                 window: int = WINDOW_SYMBOLS):
        self.vocab, self.block, self.window = vocab, block, window
        self.cache: dict[str, bytes] = {}  # ids by chunk between white space
        self.words: dict[str, bytes] = {}  # and by word
        self.held = ""
        self.word: WordStream | None = None

    def feed(self, text: str) -> bytes:
        buffer = self.held + text
        cut = max(buffer.rfind(" "), buffer.rfind("\n"))
        if cut >= 0:
            self.held = buffer[cut:]
            return self._whole(buffer[:cut])
        if len(buffer) <= self.block:
            self.held = buffer
            return b""
        cut = self._safe_cut(buffer)
        self.held = buffer[cut:]
        return self._open_chunk(buffer[:cut])

    def finish(self) -> bytes:
        text, self.held = self.held, ""
        return self._whole(text)

    def _safe_cut(self, buffer: str) -> int:
        """A place in a long chunk that neither normalisation nor a special
        token reaches across: before an ASCII letter or digit (nothing
        composes with what stands before it) with no '<' shortly before."""
        for cut in range(len(buffer) - 1, len(buffer) // 2, -1):
            c = buffer[cut]
            if c.isascii() and c.isalnum() and "<" not in buffer[
                    max(0, cut - self.vocab.longest_special):cut]:
                return cut
        return 0

    def _whole(self, text: str) -> bytes:
        """Ids of a text that ends where a word ends."""
        out = []
        if self.word is not None:  # a long chunk goes on
            head = chunks_of(text)[0]
            out.append(self._open_chunk(head))
            out.append(_packed(self.word.finish()))
            self.word = None
            text = text[len(head):]
        pattern = self.vocab.special_pattern
        if pattern is not None and "<|" in text:
            for part in pattern.split(text):
                special = self.vocab.special.get(part)
                out.append(self._plain(part) if special is None else _packed([special]))
        else:
            out.append(self._plain(text))
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        chunks = chunks_of(text)
        get = self.cache.get
        out = list(map(get, chunks))
        if None in out:
            self.learn([c for x, c in zip(out, chunks) if x is None])
            # long chunks aren't kept
            out = [x if x is not None else self._long_chunk(c) if (y := get(c)) is None else y
                   for x, c in zip(out, chunks)]
        return b"".join(out)

    def learn(self, chunks: Iterable[str]) -> None:
        """Put the ids of short chunks without white space into the cache."""
        v, cache = self.vocab, self.cache
        if len(cache) >= 2 * CACHED_CHUNKS:
            cache.clear()
        cache[""] = b""
        found: dict[str, list[str]] = {}
        unseen: dict[str, bytes] = {}
        words, pattern = self.words, v.word_pattern
        if len(words) >= CACHED_CHUNKS:
            words.clear()
        plain = v.letters_are_words
        for chunk in chunks:
            if chunk in found or len(chunk) > CACHED_CHUNK_CHARS:
                continue
            if plain and chunk.isalpha() and chunk.isascii():
                w = chunk.lower()
                if w in words:
                    cache[chunk] = words[w]
                    continue
                found[chunk] = parts = [w]
            else:
                found[chunk] = parts = pattern.findall(v.normalized(chunk))
            for w in parts:
                if w not in words and w not in unseen:
                    unseen[w] = w.encode("utf-8", "surrogatepass")
        short = [w for w, data in unseen.items() if len(data) <= ARRAY_WORD_BYTES]
        words.update(zip(short, v.merged_words([unseen[w] for w in short])))
        for w, data in unseen.items():
            if len(data) > ARRAY_WORD_BYTES:
                words[w] = self._word_ids(data)
        for chunk, parts in found.items():
            cache[chunk] = words[parts[0]] if len(parts) == 1 else b"".join(
                [words[w] for w in parts])

    def _long_chunk(self, chunk: str) -> bytes:
        v = self.vocab
        return b"".join(self._word_ids(w.encode("utf-8", "surrogatepass"))
                        for w in v.word_pattern.findall(v.normalized(chunk)))

    def _word_ids(self, data: bytes) -> bytes:
        v = self.vocab
        if len(data) > self.window:
            stream = WordStream(v, self.window)
            return _packed([*stream.feed(data), *stream.finish()])
        inner = v.inner
        return _packed(v.merged([*[inner[b] for b in data[:-1]], v.last[data[-1]]]))

    def _open_chunk(self, text: str) -> bytes:
        """Ids of the next part of a chunk that may go on after it."""
        v, out = self.vocab, []
        if self.word is None:
            self.word = _OpenChunk(v, self.window)
        pattern = v.special_pattern
        for part in (pattern.split(text) if pattern is not None else [text]):
            special = v.special.get(part)
            if special is not None:
                out.extend([*self.word.finish(), special])
            else:
                out.extend(self.word.feed(v.normalized(part)))
        return _packed(out)


class _OpenChunk:
    """Words of a chunk without white space that arrives in parts."""

    def __init__(self, vocab: Vocabulary, window: int):
        self.vocab, self.window = vocab, window
        self.text = ""  # from the last word's start on, as far as not yet streamed
        self.stream: WordStream | None = None
        self.kind = ""

    def _class(self, c: str) -> str:
        if regex.match(r"\p{L}", c):
            return "L"
        return "N" if regex.match(r"\p{N}", c) else "S" if c.isspace() else "O"

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        if self.stream is not None:
            # the open word goes on as long as the class of its characters does
            run = 0
            while run < len(text) and self._class(text[run]) == self.kind:
                run += 1
            out += self.stream.feed(text[:run].encode("utf-8", "surrogatepass"))
            if run == len(text):
                return out
            out += self.stream.finish()
            self.stream, text = None, text[run:]
        self.text += text
        words = list(self.vocab.word_pattern.finditer(self.text))
        # the last word may go on, and so may an apostrophe form of three characters
        done = 0
        while done < len(words) - 1 and words[done].start() < len(self.text) - 3:
            out += self._ids(words[done].group())
            done += 1
        if words:
            last = words[done]
            tail = self.text[last.start():]
            if last.end() == len(self.text) and len(tail) > self.window:
                self.kind = self._class(tail[-1])
                self.stream, self.text = WordStream(self.vocab, self.window), ""
                out += self.stream.feed(tail.encode("utf-8", "surrogatepass"))
            else:
                self.text = tail
        return out

    def _ids(self, word: str) -> list[int]:
        stream = WordStream(self.vocab, self.window)
        return [*stream.feed(word.encode("utf-8", "surrogatepass")), *stream.finish()]

    def finish(self) -> list[int]:
        out = self.stream.finish() if self.stream is not None else []
        for word in self.vocab.word_pattern.findall(self.text):
            out += self._ids(word)
        self.stream, self.text = None, ""
        return out


class Decoder:
    """Streaming decoder: ``feed`` ids, then ``finish``; both return UTF-8 bytes."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.first = vocab, True
        if vocab.byte_decoder:
            back = {s: b for b, s in enumerate(vocab.symbols)}
            self.pieces = [bytes(back[c] for c in t) if all(c in back for c in t)
                           else t.encode() for t in vocab.tokens]
            self.state = codecs.getincrementaldecoder("utf-8")("replace")
        else:
            self.pieces = [b" " + t.encode() for t in vocab.tokens]
            self.state = None

    def feed(self, ids: list[int]) -> bytes:
        data = b"".join(map(self.pieces.__getitem__, ids))
        if self.state is not None:
            return self.state.decode(data).encode()
        if self.first and data:
            self.first, data = False, data[1:]
        return data

    def finish(self) -> bytes:
        self.first = True
        return self.state.decode(b"", True).encode() if self.state is not None else b""


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def learn_batch(encoder: Encoder, texts: Iterable[str | None],
                most_chars: int = 1 << 22) -> Iterator[str | None]:
    """Pass the texts on, after the words of some of them at a time have been
    put into the cache together."""
    held: list[str | None] = []
    chars = 0
    for text in texts:
        held.append(text)
        chars += len(text or "")
        if chars >= most_chars:
            yield from _learned(encoder, held)
            held, chars = [], 0
    yield from _learned(encoder, held)


def _learned(encoder: Encoder, texts: list[str | None]) -> list[str | None]:
    chunks: set[str] = set()
    for text in texts:
        if text and len(text) <= encoder.block:
            chunks.update(chunks_of(text))
    if len(encoder.cache) >= CACHED_CHUNKS:  # before these are learned, not while they are used
        encoder.cache.clear()
    encoder.learn(chunks.difference(encoder.cache))
    return texts


def stream_ids(encoder: Encoder, text: str | None) -> Iterator[bytes]:
    """The ids of a text, block by block."""
    text = text or ""
    for i in range(0, len(text), encoder.block):
        yield encoder.feed(text[i:i + encoder.block])
    yield encoder.finish()


def encode(docs: DataFrame, vocab_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) of each whole text added."""

    @F.pandas_udf("array<int>")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary(vocab_path))
        for texts in batches:
            yield pd.Series([np.frombuffer(b"".join(stream_ids(encoder, t)), "<u4")
                             .astype("int32") for t in learn_batch(encoder, texts)],
                            dtype=object)

    return docs.withColumn("ids", ids_of(F.col(text)))


def decode(docs: DataFrame, vocab_path: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded`` (text) of each list of ids added; null: empty."""

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(vocabulary(vocab_path))
        for lists in batches:
            yield pd.Series([(decoder.feed([] if x is None else list(x)) + decoder.finish())
                             .decode("utf-8", "replace") for x in lists], dtype=object)

    return docs.withColumn("decoded", text_of(F.col(ids)))


def tokenized(docs: DataFrame, vocab_path: str, text: str = "text",
              batch_chars: int = 1 << 20) -> DataFrame:
    """``docs`` without the text, with ids (array of int), n_tokens, ids_sha256 and
    decoded_sha256 of each whole text.  Rows leave in batches of about
    ``batch_chars`` characters, so lists of ids never pile up in a worker."""
    keep = [c for c in docs.columns if c not in (*OUTPUTS, "ids", text)]

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary(vocab_path)), Decoder(vocabulary(vocab_path))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            begin = 0
            while begin < batch.num_rows:
                end, size = begin, 0
                while end < batch.num_rows and size < batch_chars:
                    size += len(texts[end].as_py() or "")
                    end += 1
                values, digests_of, ends = [], [], [0]
                for t in learn_batch(encoder, texts.slice(begin, end - begin).to_pylist()):
                    ids = b"".join(stream_ids(encoder, t))
                    out = decoder.feed(np.frombuffer(ids, "<u4").tolist()) + decoder.finish()
                    values.append(ids)
                    ends.append(ends[-1] + len(ids) // 4)
                    digests_of.append((hashlib.sha256(ids).hexdigest(),
                                       hashlib.sha256(out).hexdigest()))
                flat = np.frombuffer(b"".join(values), "<u4").astype("<i4")
                rows = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(rows.schema.get_field_index(c)) for c in keep]
                    + [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                       pa.array(np.diff(ends), pa.int64()),
                       pa.array([d[0] for d in digests_of]), pa.array([d[1] for d in digests_of])],
                    [*keep, "ids", *OUTPUTS])
                begin = end

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    schema = ", ".join([*fields, "ids array<int>", "n_tokens long", "ids_sha256 string",
                        "decoded_sha256 string"])
    return docs.select(*keep, F.col(text)).mapInArrow(encode_rows, schema)


def digests(docs: DataFrame, vocab_path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of each whole text,
    in one pass that never holds more than a block of ids."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, decoder = Encoder(vocabulary(vocab_path)), Decoder(vocabulary(vocab_path))
        for texts in batches:
            rows = []
            for value in learn_batch(encoder, texts):
                ids_sha, text_sha, n = hashlib.sha256(), hashlib.sha256(), 0
                for packed in stream_ids(encoder, value):
                    ids_sha.update(packed)
                    n += len(packed) // 4
                    text_sha.update(decoder.feed(np.frombuffer(packed, "<u4").tolist()))
                text_sha.update(decoder.finish())
                rows.append((n, ids_sha.hexdigest(), text_sha.hexdigest()))
            yield pd.DataFrame(rows, columns=list(OUTPUTS))

    keep = [c for c in docs.columns if c not in OUTPUTS]
    return docs.select(*keep, measure(F.col(text)).alias("_m")).select(*keep, "_m.*")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, default_vocabulary()).select("doc_id", *OUTPUTS)
