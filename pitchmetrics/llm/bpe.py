"""Byte-level BPE: encoding by batched numpy merge rounds, and decoding.

Texts are cut before every space that a visible character follows (no token of the
pattern crosses such a place), the distinct pieces of a batch are cut into words by the
pattern, and the symbols of all these words lie in one flat array.  A round looks up
every neighbouring pair by binary search over the sorted pair keys, merges each word's
lowest-ranked pair wherever it occurs, and goes on with the words that still had one.

Defined cases: a null text is the empty text and has no ids; the special token's string
in a text is its one id; a decoded id sequence that is not valid UTF-8 shows U+FFFD as
the library does; a null id list decodes to the empty text.  Rows are independent, so
repeated rows give repeated results and an empty table gives an empty one.  Input columns
whose names clash with the added ones are replaced by the added ones.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: fixed values: the pre-tokenizer's pattern of this vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: pieces kept with their ids in one Python worker
CACHE_PIECES = 800_000
#: pieces whose words are merged together
FLAT_PIECES = 50_000
_NEVER = np.int64(1) << 40


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def ragged(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated rows of a ragged array, and their lengths."""
    begin = offsets[rows]
    length = offsets[rows + 1] - begin
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    return flat[np.arange(total) + np.repeat(begin - (end - length), length)], length


class _Pieces(dict):
    """Piece -> its number; pieces met for the first time wait in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class _Known:
    """Numbered pieces with the ids of all of them in one ragged array."""

    def __init__(self, lead: str) -> None:
        self.lead, self.index = lead, _Pieces()
        self.flat, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def fill(self, bpe: "Bpe") -> None:
        new, self.index.new = self.index.new, []
        if new:
            flat, lengths = bpe.merged([self.lead + p for p in new])
            self.flat = np.concatenate([self.flat, flat])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])


class Bpe:
    """One vocabulary file (``tokenizers`` JSON, byte-level BPE without prefix space)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for word, i in vocab.items():
            self.token[i] = bytes(letters[c] for c in word)
        for word, i in self.special.items():
            self.token[i] = word.encode()
        self.token_flat = np.frombuffer(b"".join(self.token), np.uint8)
        self.token_at = np.concatenate([[0], np.cumsum([len(t) for t in self.token])]).astype(np.int64)
        self.of_byte = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.of_byte[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        key = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        self.words = regex.compile(PATTERN).findall
        self.odd = re.compile(r" (?=\s|$)").search
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.forget()

    def forget(self) -> None:
        self.first, self.after, self.whole = _Known(""), _Known(" "), _Known("")

    # --- encoding -----------------------------------------------------------------
    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text."""
        if max(len(k.index) for k in (self.first, self.after, self.whole)) > CACHE_PIECES:
            self.forget()
        plan: list[list] = []  # of each text: (kind, numbers) or (None, id)
        for text in texts:
            parts: list = []
            pieces = self.split_special(text) if text and any(s in text for s in self.special) else [text or ""]
            for part in pieces:
                if part in self.special:
                    parts.append((None, self.special[part]))
                elif not part:
                    continue
                elif self.odd(part):
                    words = self.words(part)
                    parts.append((self.whole, np.fromiter(map(self.whole.index.__getitem__, words), np.int64, len(words))))
                else:
                    head, *rest = part.split(" ")
                    if head:
                        parts.append((self.first, np.array([self.first.index[head]])))
                    parts.append((self.after, np.fromiter(map(self.after.index.__getitem__, rest), np.int64, len(rest))))
            plan.append(parts)
        for known in (self.first, self.after, self.whole):
            known.fill(self)
        out, counts = [], np.zeros(len(texts), np.int64)
        for i, parts in enumerate(plan):
            for known, numbers in parts:
                ids = np.array([numbers], np.int32) if known is None else ragged(known.flat, known.offsets, numbers)[0]
                out.append(ids)
                counts[i] += len(ids)
        return (np.concatenate(out) if out else np.zeros(0, np.int32)).astype(np.int32), counts

    def merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in one array, and the number of ids of each."""
        flats, lengths = [], []
        for at in range(0, len(pieces), FLAT_PIECES):
            part = pieces[at:at + FLAT_PIECES]
            distinct = _Pieces()
            numbers: list[int] = []
            count = np.ones(len(part), np.int64)
            for i, piece in enumerate(part):
                if piece[piece[0] == " ":].isalpha():  # one word, as the pattern has it
                    numbers.append(distinct[piece])
                else:
                    words = self.words(piece)
                    count[i] = len(words)
                    numbers.extend(map(distinct.__getitem__, words))
            flat, per_word = self._rounds([w.encode() for w in distinct.new])
            ends = np.concatenate([[0], np.cumsum(per_word)])
            flat, length = ragged(flat, ends, np.array(numbers, np.int64))
            total = np.concatenate([[0], np.cumsum(length)])
            upto = np.concatenate([[0], np.cumsum(count)])
            flats.append(flat)
            lengths.append(np.diff(total[upto]))
        return np.concatenate(flats).astype(np.int32), np.concatenate(lengths)

    def _ranked(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of the pairs that begin at ``at``; no pair crosses words."""
        key = (sym[at] << 20) | sym[at + 1]
        place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[place] == key) & (word[at] == word[at + 1]), self.rank[place], _NEVER), self.made[place]

    def _rounds(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merges until no word has a mergeable pair; a round looks up only new pairs."""
        size = np.array([len(w) for w in words], np.int64)
        sym = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        rank, made = np.full(len(sym), _NEVER), np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            rank[:-1], made[:-1] = self._ranked(sym, word, np.arange(len(sym) - 1))
        ready: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.concatenate([first, [len(sym)]])))
            stay = best < _NEVER
            ready.append((sym[~stay], word[~stay]))
            hit = np.flatnonzero((rank == best) & stay)
            # of a run of overlapping hits (a pair of equal symbols) every second one merges
            nth = np.arange(len(hit))
            run = np.concatenate([[True], np.diff(hit) != 1])[:len(hit)]
            hit = hit[(nth - np.maximum.accumulate(np.where(run, nth, 0))) % 2 == 0] if len(hit) else hit
            sym[hit] = made[hit]
            new = np.zeros(len(sym), bool)
            new[hit] = True
            stay[hit + 1] = False
            sym, word, rank, made, new = sym[stay], word[stay], rank[stay], made[stay], new[stay]
            at = np.flatnonzero(new | np.concatenate([new[1:], [False]])[:len(new)])
            last = at[at == len(sym) - 1]
            at = at[at < len(sym) - 1]
            rank[last] = _NEVER
            rank[at], made[at] = self._ranked(sym, word, at)
        if not ready:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        flat, owner = np.concatenate([r[0] for r in ready]), np.concatenate([r[1] for r in ready])
        return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    # --- decoding -----------------------------------------------------------------
    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, as the library's text shows them."""
        raw = ragged(self.token_flat, self.token_at, ids.astype(np.int64))[0].tobytes()
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()


@functools.lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def slices(texts: pa.Array, most_bytes: int = 8_000_000) -> Iterator[tuple[int, list]]:
    """(start, texts) so that no slice but of one long text is over ``most_bytes``."""
    begin, size, part = 0, 0, []
    for i, t in enumerate(texts):
        part.append(t.as_py())
        size += len(part[-1] or "")
        if size >= most_bytes:
            yield begin, part
            begin, size, part = i + 1, 0, []
    if part:
        yield begin, part


def _with(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    added = {f.name for f in fields}
    return T.StructType([f for f in schema if f.name not in added] + list(fields))


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``: array<int> of each text's ids."""
    schema = _with(df.schema, T.StructField(out, T.ArrayType(T.IntegerType(), False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        for batch in batches:
            for begin, texts in slices(batch.column(batch.schema.get_field_index(text))):
                flat, n = model.encode(texts)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat))
                rows = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([ids if f == out else rows.column(rows.schema.get_field_index(f))
                                                  for f in schema.names], schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of each id list."""
    schema = _with(df.schema, T.StructField(out, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            texts = pa.array([model.decode_bytes(np.array(x.as_py() or [], np.int64)).decode() for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([texts if f == out else batch.column(batch.schema.get_field_index(f))
                                              for f in schema.names], schema.names)

    return df.mapInArrow(run, schema)


def roundtrip_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes every text: ``key``, n_tokens, ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers) and decoded_sha256 (of the text in UTF-8)."""
    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        for batch in batches:
            for begin, texts in slices(batch.column(1)):
                flat, n = model.encode(texts)
                ends = np.cumsum(n)
                ids = [flat[e - c:e] for e, c in zip(ends, n, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, len(texts)), pa.array(n, pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(model.decode_bytes(x)).hexdigest() for x in ids], pa.string()),
                ], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["k"].dataType
    out = rows.mapInArrow(run, T.StructType([
        T.StructField("k", kind), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))
    return out.withColumnRenamed("k", key)
