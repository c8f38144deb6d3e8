"""BPE of many words at once: their symbols lie in one flat array, and each round merges the lowest pair of every word.

A pair's rank is found by binary search over the sorted keys of all pairs. Only ranks beside a merge change, so only
these are looked up again. Words without a pair that merges leave the array; the others go on.
"""

from __future__ import annotations

import json
import pickle
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from tidewright.llm import common as c

# Fixed values of byte-level tokenizers: the split into words, and the bytes that stand for themselves in token strings.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))

#: A task's encodings of words between spaces take about this many bytes at most.
CACHE_BYTES = 48 << 20
#: Symbols in the flat array of one batch, unless a single word has more.
BATCH_SYMBOLS = 1 << 20
_SLICE = 1 << 20
_ENTRY = 250

# Both neighbours are no white space, so the space begins a match, and nothing before it looks past it.
_LONE_SPACE = re.compile(r" (?=\S)(?<=\S )")
# From here on there are characters whose class depends on the version of Unicode.
_SETTLED = "Ͱ"


class Coder:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library.

    Special tokens in a text become their ids. Options of the file that would change the encoding in other ways
    (normalizers, dropout, prefix spaces, tokens that strip white space) are errors.
    """

    def __init__(self, file: bytes):
        made = json.loads(file)
        model, before = made["model"], made["pre_tokenizer"]
        plain = model["type"] == "BPE" and not any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        level = before["type"] == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True)
        added = made["added_tokens"]
        if not plain or not level or made["normalizer"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("not a plain byte-level BPE file")
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]

        shown = [b for part in PRINTABLE for b in part]
        hidden = [b for b in range(256) if b not in set(shown)]
        char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        byte = {x: b for b, x in char.items()}
        self.of_byte = np.array([vocab[char[b]] for b in range(256)], np.int64)

        self.special = {t["content"]: t["id"] for t in added}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.none = len(merges)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.makes = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        # Where a merge's parts are made by earlier merges, a merge never makes a lower pair, and equal pairs go at once.
        first = np.full(self.size, self.none)
        np.minimum.at(first, self.makes, np.arange(self.none))
        first[self.of_byte] = -1
        self.ordered = bool((np.maximum(first[left], first[right]) < np.arange(self.none)).all())

        pieces = [b""] * self.size
        for token, i in vocab.items():
            pieces[i] = bytes(byte[x] for x in token) if all(x in byte for x in token) else token.encode()
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.piece_length = np.fromiter(map(len, pieces), np.int64, self.size)
        self.piece_start = np.cumsum(self.piece_length) - self.piece_length
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)

        self.pattern = regex.compile(PATTERN)
        self.standin: dict[str, str] = {}
        self.words: dict[str, bytes] = {}
        self.held = 0

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, by binary search; ``none`` for pairs that do not merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), self.none - 1)
        return np.where(self.keys[at] == key, self.order[at], self.none)

    def merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, packed as little-endian 32-bit integers; no word is empty."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        which, start = np.arange(len(words)), np.cumsum(length) - length
        rank = np.full(len(symbol), self.none)
        rank[:-1] = self.ranks(symbol[:-1], symbol[1:])
        rank[start + length - 1] = self.none
        out: list[bytes] = [b""] * len(words)
        while len(which):
            low = np.minimum.reduceat(rank, start)
            done = low == self.none
            if done.any():
                self._give_out(out, which[done], length[done], symbol[np.repeat(done, length)])
                stay = np.repeat(~done, length)
                symbol, rank = symbol[stay], rank[stay]
                which, length, low = which[~done], length[~done], low[~done]
                start = np.cumsum(length) - length
                if not len(which):
                    break
            at = np.flatnonzero(rank == np.repeat(low, length))
            word = np.searchsorted(start, at, "right") - 1
            if self.ordered:  # of equal pairs that overlap, every other one from the left
                head = np.append(True, at[1:] != at[:-1] + 1)
                place = np.arange(len(at))
                take = (place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0
            else:
                take = np.append(True, word[1:] != word[:-1])
            at, word = at[take], word[take]
            symbol[at] = self.makes[rank[at]]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            symbol, rank = symbol[stay], rank[stay]
            length -= np.bincount(word, minlength=len(length))
            start = np.cumsum(length) - length
            at -= np.arange(len(at))
            last = at == start[word] + length[word] - 1
            rank[at[last]] = self.none
            near = np.concatenate([at[~last], at[at > start[word]] - 1])
            rank[near] = self.ranks(symbol[near], symbol[near + 1])
        return out

    @staticmethod
    def _give_out(out: list[bytes], which: np.ndarray, length: np.ndarray, symbol: np.ndarray) -> None:
        ids = symbol.astype("<u4").tobytes()
        ends = (4 * np.cumsum(length)).tolist()
        begin = 0
        for i, end in zip(which.tolist(), ends, strict=True):
            out[i] = ids[begin:end]
            begin = end

    def split(self, text: str) -> list[str]:
        """Matches of the pattern, with the character classes of the tokenizers library."""
        if text.isascii() or max(text) < _SETTLED:
            return self.pattern.findall(text)
        odd = {x for x in set(text) if unicodedata.category(x) == "Cn"}
        if not odd:
            return self.pattern.findall(text)
        for x in odd - self.standin.keys():  # a character of the same class
            joins = [y for y in "a1." if len(ByteLevel(add_prefix_space=False).pre_tokenize_str(y + x + y)) == 1]
            self.standin[x] = joins[0] if joins else " "
        plain = text.translate({ord(x): self.standin[x] for x in odd})
        return [text[m.start() : m.end()] for m in self.pattern.finditer(plain)]

    def _encode_new(self, chunks: list[str]) -> list[bytes]:
        """Ids of texts that stand on their own, in batches of words."""
        lists = [[x] if x[1:].isalpha() and x[:1] == " " and max(x) < _SETTLED else self.split(x) for x in chunks]
        known = dict.fromkeys(w for words in lists for w in words)
        batch: list[str] = []
        size = 0
        for word in [*known, None]:
            if word is None or size > BATCH_SYMBOLS:
                known.update(zip(batch, self.merged([w.encode() for w in batch]), strict=True) if batch else ())
                batch, size = [], 0
            if word is not None:
                batch.append(word)
                size += len(word)
        return [b"".join([known[w] for w in words]) for words in lists]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts. What stands between two lone spaces is encoded once and kept."""
        rows: list[list[str | int]] = []
        met: set[str] = set()
        for text in texts:
            row: list[str | int] = []
            for part in self.cut.split(text) if self.cut and self.cut.search(text) else (text,):
                if part in self.special:
                    row.append(self.special[part])
                elif part:
                    head, *rest = _LONE_SPACE.split(part)
                    chunks = [head, *[" " + x for x in rest]]
                    met.update(chunks)
                    row += chunks
            rows.append(row)
        if self.held > CACHE_BYTES:
            self.words.clear()
            self.held = 0
        new = list(met.difference(self.words))
        ids = self._encode_new(new)
        self.held += sum(map(len, new)) * 2 + sum(map(len, ids)) + _ENTRY * len(new)
        self.words.update(zip(new, ids, strict=True))
        get = self.words.__getitem__
        return [b"".join([int(x).to_bytes(4, "little") if type(x) is int else get(x) for x in row]) for row in rows]

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """Text of each row of ids; ids without a token give nothing, bytes that are no UTF-8 the replacement character."""
        known = (ids >= 0) & (ids < self.size)
        row = np.repeat(np.arange(len(lengths)), lengths)[known]
        ids = ids[known]
        size = self.piece_length[ids]
        data = self.piece_bytes[c.ragged(self.piece_start[ids], size)].tobytes()
        ends = np.cumsum(np.bincount(row, size, len(lengths)).astype(np.int64)).tolist()
        out, begin = [], 0
        for end in ends:
            out.append(data[begin:end].decode("utf-8", "replace"))
            begin = end
        return out


def _broadcast(docs: DataFrame, path: str):
    """The coder with its tables, a few megabytes, for all tasks; each task gets one without words of others."""
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(pickle.dumps(Coder(f.read())))


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Adds ``n_tokens`` and ``token_ids`` (array of ids), as the tokenizers library encodes whole texts.

    Null and empty texts have no tokens. Every row is encoded on its own, so repeated rows, ties and null ids stay as
    they are; other columns pass through, those of the added names (in any case) are replaced; an empty table gives an
    empty one.
    """
    docs = docs.drop("n_tokens", "token_ids")
    text_col = c.named(docs, text_col)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType(), False))]
    )
    made = _broadcast(docs, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pickle.loads(made.value)  # with its task, its words go as well
        for batch in c.slices(batches, text_col, _SLICE):
            ids = coder.encode([t.decode("utf-8", "replace") for t in c.texts(batch.column(text_col))])
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
            offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns |= {"n_tokens": pa.array(lengths, pa.int64()), "token_ids": pa.ListArray.from_arrays(offsets, values)}
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, ids_col: str = "token_ids") -> DataFrame:
    """Adds ``decoded``: the text of each row's ids, special tokens included. Null and empty ids give an empty text."""
    docs = docs.drop("decoded")
    ids_col = c.named(docs, ids_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("decoded", T.StringType())])
    made = _broadcast(docs, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pickle.loads(made.value)
        for batch in batches:
            column = batch.column(ids_col)
            lengths = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.cumsum(lengths) // _SLICE
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                ids = column.slice(a, b - a).flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                columns = {n: batch.column(n).slice(a, b - a) for n in batch.schema.names}
                columns["decoded"] = pa.array(coder.decode(ids, lengths[a:b]), pa.string())
                yield pa.RecordBatch.from_pydict(columns)
        c.release()

    return docs.mapInArrow(run, schema)
