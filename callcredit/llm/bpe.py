"""BPE encoding by backtracking over longest matches, and decoding by offsets.

A token sequence is the one BPE gives exactly if every pair of neighbours is
compatible: encoded together, the two stay the two. An Aho-Corasick automaton
finds the longest tokens from the left; where neighbours are incompatible, the
encoder goes back to the next shorter token. Compatibility of two tokens is
found by undoing merges on both sides of their border and kept in a table of
pairs. Each distinct word of a piece of text is encoded once.

The tokenizer file is the JSON of a BPE model with a word-end suffix whose
vocabulary lists its base symbols first and then one token a merge, in order;
normalisation is NFC and lower case, words are found by the file's pattern,
and special tokens are found in the raw text. Decoding without a decoder joins
token strings by spaces: the bytes of all tokens lie in one array, and an
offset table says where each begins.

Rows are independent, so nothing is shuffled. Defined results: a null or empty
text has no tokens and decodes to an empty text; very long texts are taken in
stretches cut at spaces, which tokens never span; repeated rows give equal
results; an added column replaces one of the same name, all others stay.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcredit.llm.storage import documents, texts_in_small_batches

TOKENIZER = "word_bpe_49k.json"
STRETCH = 1 << 20
ROWS_PER_BATCH = 250
PAIRS_KEPT = 1 << 17
WORDS_KEPT = 1 << 17

_STOP = 0xFFFF
_END = 256


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabets write printable Latin-1 bytes as themselves and the
    others, in order, as the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Model:
    """What the tokenizer file says, as plain values that can be broadcast."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        bpe = spec["model"]
        if bpe["type"] != "BPE" or bpe.get("byte_fallback") or bpe.get("unk_token") or spec.get("decoder"):
            raise ValueError("not a plain BPE model")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = split["pattern"]["Regex"]
        self.suffix = bpe["end_of_word_suffix"]
        self.tokens = sorted(bpe["vocab"], key=bpe["vocab"].get)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in bpe["merges"]]
        ids = bpe["vocab"]
        self.base = len(self.tokens) - len(merges)
        self.parts = [(ids[a], ids[b]) for a, b in merges]
        if any(ids[a + b] != self.base + i for i, (a, b) in enumerate(merges)):
            raise ValueError("token ids don't follow the merges")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}

    def values(self) -> dict:
        return dict(self.__dict__)


class Encoder:
    def __init__(self, pattern, suffix, tokens, base, parts, special):
        byte = _byte_of_char()
        self.words = regex.compile(pattern)
        self.special = special
        self.marks = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.parts = [(i, i) for i in range(base)] + parts
        self.merged = {pair: base + i for i, pair in enumerate(parts)}
        self.symbols = []
        for t in tokens:
            end = t.endswith(suffix) and len(t) > len(suffix)
            s = [byte[c] for c in (t[:-len(suffix)] if end else t)]
            self.symbols.append("".join(map(chr, s[:-1])) + chr(s[-1] + _END * end))
        self.ids = {s: i for i, s in enumerate(self.symbols)}
        self.longest = max(map(len, self.symbols))
        self.automaton = ahocorasick.Automaton()
        for s, i in self.ids.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.lengths = [len(s) for s in self.symbols]
        self.sizes = np.array(self.lengths)
        # The longest token that a token begins with, -1 for base symbols.
        self.shorter = [next((self.ids[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.ids), -1) for s in self.symbols]
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        """Known words and special tokens by place, with their ids."""
        self.index: dict = {}
        self.word_ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE keeps ``left`` and ``right`` apart, by the table of pairs."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo the later of the two merges at the border, again and again, and
        look for a merge across it that would have come earlier."""
        before = len(self.parts)
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < before:
                return False
            inner_left, inner_right = self.parts[left][1], self.parts[right][0]
            whole_left, whole_right = inner_left == left, inner_right == right
            if whole_left and whole_right:
                return True
            if not whole_left and (whole_right or left > right):
                before, left = left, inner_left
            else:
                before, right = right + 1, inner_right

    def backtrack(self, word: str) -> list[int]:
        """Tokens of one word, its last symbol carrying the word end."""
        n, ids, sizes, shorter, pairs = len(word), self.ids, self.lengths, self.shorter, self.pairs
        open_at = [True] * (n + 1)
        out: list[int] = []
        at = 0
        token = -1
        while at < n:
            if token < 0:
                for end in range(min(n, at + self.longest), at, -1):
                    if (found := ids.get(word[at:end])) is not None:
                        token = found
                        break
            while token >= 0:
                end = at + sizes[token]
                if open_at[end]:
                    if not out:
                        break
                    fits = pairs.get(out[-1] << 32 | token)
                    if fits is None:
                        fits = self.compatible(out[-1], token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = -1
            else:
                open_at[at] = False
                token = out.pop()
                at -= sizes[token]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of distinct words, one after the other, and where each
        word's begin (one more entry than words)."""
        line = np.frombuffer(("\n".join(words) + "\n").encode("utf-8"), np.uint8).astype(np.uint32)
        stop = np.flatnonzero(line == 0x0A)
        line[stop - 1] += _END
        line[stop] = _STOP
        text = line.tobytes().decode("utf-32-le")
        found = np.fromiter(chain.from_iterable(self.automaton.iter_long(text)), np.int64).reshape(-1, 2)
        ends, ids = found[:, 0] + 1, found[:, 1]
        word = np.searchsorted(stop, ends)
        starts = np.append(0, stop[:-1] + 1)
        # Whole words covered by compatible longest matches are done.
        together = word[1:] == word[:-1]
        pairs, back = np.unique(ids[:-1] << 32 | ids[1:], return_inverse=True)
        apart = together.copy()
        if together.any():
            used = np.zeros(len(pairs), bool)
            used[back[together]] = True
            fine = np.array([not u or self.compatible(int(p) >> 32, int(p) & 0xFFFFFFFF) for p, u in zip(pairs, used, strict=True)])
            apart = together & ~fine[back]
        good = np.bincount(word, self.sizes[ids], len(words)) == stop - starts
        good[word[1:][apart]] = False
        per_word = np.bincount(word, minlength=len(words))
        redone = {int(w): self.backtrack(text[starts[w]:stop[w]]) for w in np.flatnonzero(~good)}
        sizes = per_word.copy()
        for w, tokens in redone.items():
            sizes[w] = len(tokens)
        first = np.append(0, np.cumsum(sizes))
        out = np.empty(first[-1], np.int32)
        keep = good[word]
        place = np.arange(len(word)) - np.append(0, np.cumsum(per_word))[word] + first[word]
        out[place[keep]] = ids[keep]
        for w, tokens in redone.items():
            out[first[w]:first[w + 1]] = tokens
        return out, first

    def words_of(self, text: str) -> list[str]:
        """Normalised words; a special token stands for itself, as (id,)."""
        if self.marks is None or not self.marks.search(text):
            return self._plain(text)
        out: list = []
        at = 0
        for m in self.marks.finditer(text):
            out += self._plain(text[at:m.start()])
            out.append((self.special[m.group()],))
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # Lower case is taken letter by letter: no word-final sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.words.findall(text.lower())

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.index) >= WORDS_KEPT:
            self._forget()
        index, places, new = self.index, [], []
        for text in texts:
            words = self.words_of(text)
            fresh = [w for w in dict.fromkeys(words) if w not in index]
            for i, w in enumerate(fresh, len(index)):
                index[w] = i
            new += fresh
            places.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
        self._learn(new)
        return [gathered(self.word_ids, self.first, p) for p in places]

    def _learn(self, new: list) -> None:
        plain = np.array([isinstance(w, str) for w in new], bool)
        words = [w for w in new if isinstance(w, str)]
        ids, first = self.encode_words(words) if words else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        sizes = np.ones(len(new), np.int64)
        sizes[plain] = np.diff(first)
        tokens = np.empty(int(sizes.sum()), np.int32)
        of_plain = np.repeat(plain, sizes)
        tokens[of_plain] = ids
        tokens[~of_plain] = [w[0] for w in new if not isinstance(w, str)]
        self.first = np.append(self.first, self.first[-1] + np.cumsum(sizes))
        self.word_ids = np.append(self.word_ids, tokens)


def gathered(values: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``values[first[i]:first[i + 1]]`` for every i of ``at``, joined."""
    sizes = first[at + 1] - first[at]
    begin = np.cumsum(sizes) - sizes
    return values[np.repeat(first[at] - begin, sizes) + np.arange(int(sizes.sum()))]


def _stretches(text: str, most: int) -> Iterator[str]:
    at = 0
    while len(text) - at > most:
        cut = text.find(" ", at + most)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _encode_column(encoder: Encoder, texts: Iterable[str], most: int = STRETCH) -> list[np.ndarray]:
    """Ids of every text; about ``most`` characters are in work at a time."""
    out: list[list[np.ndarray]] = []
    rows: list[int] = []
    waiting: list[str] = []

    def flush():
        for row, ids in zip(rows, encoder.encode_texts(waiting), strict=True):
            out[row].append(ids)
        rows.clear()
        waiting.clear()

    held = 0
    for row, text in enumerate(texts):
        out.append([])
        for stretch in _stretches(text, most):
            rows.append(row)
            waiting.append(stretch)
            held += len(stretch)
            if held >= most:
                flush()
                held = 0
    flush()
    return [np.concatenate(x) if len(x) > 1 else x[0] for x in out]


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], column], [*names, name])


def _ids_field(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.IntegerType()))


def _extended(df: DataFrame, field: T.StructField) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name != field.name], field])


def _encoded(batches, values: dict, text_col: str, ids_col: str):
    encoder = Encoder(**values)
    for batch in batches:
        pa.default_memory_pool().release_unused()
        for at in range(0, batch.num_rows, ROWS_PER_BATCH):
            part = batch.slice(at, ROWS_PER_BATCH)
            texts = part.column(part.schema.get_field_index(text_col))
            found = _encode_column(encoder, (x.as_py() or "" for x in texts))
            offsets = np.append(0, np.cumsum([len(x) for x in found]))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
            yield _with_column(part, ids_col, ids)


def _offset_table(model: Model) -> tuple[bytes, np.ndarray]:
    """All token strings, each followed by a space, and where each begins."""
    strings = dict(enumerate(model.tokens)) | {i: s for s, i in model.special.items()}
    pieces = [(strings.get(i, "") + " ").encode() for i in range(max(strings) + 1)]
    return b"".join(pieces), np.append(0, np.cumsum([len(p) for p in pieces]))


def _decoded(batches, joined: bytes, first: np.ndarray, ids_col: str, text_col: str):
    table = np.frombuffer(joined, np.uint8)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_PER_BATCH):
            part = batch.slice(at, ROWS_PER_BATCH)
            lists = part.column(part.schema.get_field_index(ids_col))
            texts = []
            for x in lists:
                ids = x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, np.int64)
                texts.append(gathered(table, first, ids)[:-1].tobytes() if len(ids) else b"")
            yield _with_column(part, text_col, pa.array(texts, pa.binary()).cast(pa.string()))


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of every whole text."""
    texts_in_small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Model(path).values())
    return docs.mapInArrow(lambda b: _encoded(b, shared.value, text_col, ids_col), _extended(docs, _ids_field(ids_col)))


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its token ids."""
    shared = df.sparkSession.sparkContext.broadcast(_offset_table(Model(path)))
    return df.mapInArrow(lambda b: _decoded(b, *shared.value, ids_col, text_col), _extended(df, T.StructField(text_col, T.StringType())))


def encode_and_decode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``decode(encode(docs))`` in one pass of one Python worker a task."""
    texts_in_small_batches(docs.sparkSession)
    model = Model(path)
    shared = docs.sparkSession.sparkContext.broadcast((model.values(), *_offset_table(model)))

    def run(batches):
        values, joined, first = shared.value
        return _decoded(_encoded(batches, values, text_col, ids_col), joined, first, ids_col, decoded_col)

    return docs.mapInArrow(run, T.StructType([*_extended(docs, _ids_field(ids_col)), T.StructField(decoded_col, T.StringType())]))


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    return encode_and_decode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_backtracking_bpe(spark, sf_dir: str) -> DataFrame:
    return token_digests(documents(spark, sf_dir), tokenizer_path())


QUERIES = {"op7_backtracking_bpe": op7_backtracking_bpe}
ORACLE_SQL: dict[str, str] = {}
