"""Token ids of texts by a given tokenizer file, and files in a folder that driver and executors share."""

from __future__ import annotations

import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from tokenizers import Tokenizer, normalizers, pre_tokenizers

CHARS = 4 << 20  # texts are encoded in parts of about so many characters
KNOWN = 300_000  # pieces remembered since the last change of generation; those met again live on
BATCH = 2048  # pieces that meet the library at once
#: A tokenizer goes by words, or by pieces of words, if these come out as their words or pieces do one by one.
PROBES = (" Word  word\tWORD\n\r\nword12,word ", "it's  'tis\x0b\x0c(a) -- b.c_d \n 7x89", "\u00c9t\u00e9  \u65e5\u672c \u0631 a\u0301 \ufb01\u00d7\u0153", "a b  c   d,, e1.5%")
#: Kinds of bytes: blank, letter (Latin ones of two bytes too), digit, mark; a word with any other byte is kept whole.
BLANK, LETTER, DIGIT, MARK, ODD = range(5)
KIND = np.full(256, ODD, np.uint8)
KIND[0x21:0x7F] = MARK
KIND[[32, 9, 10, 11, 12, 13]] = BLANK
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[ord("a") : ord("z") + 1] = KIND[ord("A") : ord("Z") + 1] = LETTER
KIND[0x80:0xC0] = KIND[0xC3:0xC9] = LETTER
KIND[ord("'")] = ODD
ASCII_PIECE = re.compile(rb"[a-z]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
LATIN_PIECE = re.compile(rb"(?:[a-z]|[\xc3-\xc8][\x80-\xbf])+")


class Encoder:
    """Ids of whole texts, as little-endian bytes of ``width`` each.

    A tokenizer that drops white space and marks word ends (``by_words``) gives a text's ids as those of its words in turn; if it also parts letters, single
    digits and marks, as those of such pieces. Texts are cut, and their pieces told apart and numbered, on arrays; only pieces not met before
    reach the library, many at once, and the texts' ids are gathered by piece. Others encode each text whole. The tokenizer's own behaviour on
    ``PROBES`` decides which way is taken; ``by_words=True`` for one that does not allow it is an error.
    """

    def __init__(self, path: str, by_words: bool | None = None, special_as_text: bool = False):
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        suffix = json.loads(self.tok.to_str())["model"].get("end_of_word_suffix")
        vocab = self.tok.get_vocab()
        self.closing = np.zeros(max(vocab.values()) + 1, bool)
        self.closing[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self.special = [] if special_as_text else [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        # for pieces alone, lower-cased: no special tokens, and for ASCII ones neither normalisation nor another cut
        self.full, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer, self.bare.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        self.full.encode_special_tokens = self.bare.encode_special_tokens = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        fits = bool(suffix) and not any(s.split() != [s] for s in self.special) and self._whole(" ".join) == self._whole("  ".join) == [
            b"".join(self._ids(w).tobytes() for w in p.split()) for p in PROBES
        ]
        if by_words and not fits:
            raise ValueError(f"the ids of {path} are not those of single words in turn")
        self.by_words = fits if by_words is None else by_words
        self.by_pieces = self.by_words and all(len(set(KIND[list(s)])) > 1 for s in self.special)
        if self.by_pieces:
            self.by_pieces = self.encode(list(PROBES)) == self._whole(None)
            self.young, self.old = {}, {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype)

    def _whole(self, respaced) -> list[bytes]:
        """Ids of the probes as they are, or with other white space between their words."""
        return [self._ids(respaced(p.split()) if respaced else p).tobytes() for p in PROBES]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return [e.tobytes() for e in map(self._ids, texts)]
        raw = [t.encode("utf-8", "replace") for t in texts]
        data = b" ".join([*raw, b""])
        if not data:
            return []
        offsets, data = self._cut(data)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        ids, n = self._known(coded.dictionary.to_pylist())
        first = np.concatenate(([0], np.cumsum(n)))
        code = coded.indices.to_numpy()
        counts = n[code]
        end = np.concatenate(([0], np.cumsum(counts)))
        at = np.arange(end[-1]) + np.repeat(first[code] - end[:-1], counts)
        out = ids[at].tobytes()
        begin = np.cumsum([0, *[len(t) + 1 for t in raw]])
        cut = (end[np.searchsorted(offsets, begin)] * self.width).tolist()  # a piece over two texts is blank
        return [out[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def _cut(self, data: bytes) -> tuple[np.ndarray, bytes]:
        """Where pieces begin, and the bytes with A-Z in lower case where words are cut into pieces."""
        b = np.frombuffer(data, np.uint8)
        if not self.by_pieces:
            blank = KIND[b] == BLANK
            return np.concatenate(([0], np.flatnonzero(blank[1:] != blank[:-1]) + 1, [len(b)])).astype(np.int64), data
        kind = KIND[b]
        two = np.flatnonzero(b == 0xC3)
        kind[two[(b[two + 1] == 0x97) | (b[two + 1] == 0xB7)]] = ODD  # the two signs among the letters
        for s in self.special:
            at = data.find(s)
            while at >= 0:
                kind[at] = ODD
                at = data.find(s, at + 1)
        new = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)))
        upper = (b >= ord("A")) & (b <= ord("Z"))
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            blank = kind == BLANK
            word = np.cumsum(blank, dtype=np.int32)
            whole = np.zeros(int(word[-1]) + 1, bool)
            whole[word[odd]] = True
            whole = whole[word] & ~blank
            upper &= ~whole
            new[1:] &= ~(whole[1:] & whole[:-1])
        return np.append(np.flatnonzero(new), len(b)).astype(np.int64), (b + (upper.view(np.uint8) << 5)).tobytes()

    def _known(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' ids, one after the other, and their numbers of ids."""
        if len(self.young) > KNOWN:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = []
        for p in pieces:
            if p not in young:
                if p in old:
                    young[p] = old[p]
                else:
                    missing.append(p)
        self._learn(missing)
        found = [young[p] for p in pieces]
        n = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        return np.frombuffer(b"".join(found), self.dtype), n

    def _learn(self, missing: list[bytes]) -> None:
        kinds: dict[Tokenizer, list[bytes]] = {self.bare: [], self.full: []}
        for p in missing:
            if self.by_pieces and ASCII_PIECE.fullmatch(p):
                kinds[self.bare].append(p)
            elif self.by_pieces and LATIN_PIECE.fullmatch(p):
                kinds[self.full].append(p)
            else:
                self.young[p] = self._ids(p.decode("utf-8", "replace")).tobytes()
        for tok, own in kinds.items():
            for at in range(0, len(own), BATCH):
                part = own[at : at + BATCH]
                ids = np.array(tok.encode(b" ".join(part).decode(), add_special_tokens=False).ids, self.dtype)
                ends = (np.flatnonzero(self.closing[ids]) + 1) * self.width  # every piece ends in a word-end token, and nothing else is one
                if len(ends) != len(part):
                    self.young.update((p, self._ids(p.decode()).tobytes()) for p in part)
                    continue
                data, stops = ids.tobytes(), ends.tolist()
                self.young.update(zip(part, [data[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)], strict=True))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(*args) -> Encoder:
    """One encoder for each Python worker and setting."""
    if args not in _ENCODERS:
        _ENCODERS[args] = Encoder(*args)
    return _ENCODERS[args]


def parts(pdf: pd.DataFrame, text: str = "text"):
    """Row ranges of about CHARS characters."""
    size = pdf[text].str.len().fillna(0)
    for _, part in pdf.groupby((size.cumsum() // CHARS).to_numpy(), sort=False):
        yield part


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme Hadoop would use for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def opened(uri: str, mode: str, offset: int = 0, length: int | None = None):
    """A file to write, or the bytes of a range to read."""
    where, path = fs.FileSystem.from_uri(uri)
    if mode == "w":
        where.create_dir(path.rpartition("/")[0], recursive=True)
        return where.open_output_stream(path)
    with where.open_input_file(path) as f:
        size = f.size() - offset if length is None else length
        return f.read_at(size, offset)
